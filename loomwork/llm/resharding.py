"""Resharding by minimum-cost flow.

Old shards supply their bytes, new shards take up to their capacity, and a
byte costs 1 if it leaves its shard number. The cheapest flow says how many
bytes go from each old shard to each new one; an old shard's documents, in
hash order, are cut into those runs. A run cannot cut a document, so the small
documents flow last, to what room the others have left: shard sizes then differ
by little more than a small document. Only shards that lose or gain rows are
rewritten.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import materialize, prefix_sum

OLD_SHARDS = 16
NEW_SHARDS = 24
#: Bytes that a document adds besides its text.
ROW_BYTES = 8
SEED = 29
#: Share of all bytes that the small documents make up, at least.
SMALL_SHARE = 0.25
_BUCKETS = 256


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Cheapest flow[i][j] that ships every supply within the capacities.

    Successive shortest paths with potentials; needs sum(supply) to be at most
    sum(capacity) and costs of 0 or more. Nodes: the source, suppliers,
    takers, the sink.
    """
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    graph: list[list[list[int]]] = [[] for _ in range(n + m + 2)]  # [to, room, cost, place of the reverse edge]

    def edge(a: int, b: int, room: int, price: int) -> None:
        graph[a].append([b, room, price, len(graph[b])])
        graph[b].append([a, 0, -price, len(graph[a]) - 1])

    for i in range(n):
        edge(source, i, supply[i], 0)
        for j in range(m):
            edge(i, n + j, supply[i], cost[i][j])
    for j in range(m):
        edge(n + j, sink, capacity[j], 0)
    potential, left = [0] * len(graph), sum(supply)
    while left:
        far = [None] * len(graph)
        via: list[tuple[int, int] | None] = [None] * len(graph)
        far[source], queue = 0, [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for k, (b, room, price, _) in enumerate(graph[a]):
                if room and (far[b] is None or d + price + potential[a] - potential[b] < far[b]):
                    far[b], via[b] = d + price + potential[a] - potential[b], (a, k)
                    heapq.heappush(queue, (far[b], b))
        if far[sink] is None:
            raise ValueError("the new shards have too little room")
        potential = [p + (f if f is not None else 0) for p, f in zip(potential, far)]
        path, at = [], sink
        while at != source:
            path.append(via[at])
            at = via[at][0]
        pushed = min(left, *(graph[a][k][1] for a, k in path))
        for a, k in path:
            graph[a][k][1] -= pushed
            graph[graph[a][k][0]][graph[a][k][3]][1] += pushed
        left -= pushed
    return [[graph[n + j][graph[i][1 + j][3]][1] for j in range(m)] for i in range(n)]


def room_left(loads: list[int], total: int) -> list[int]:
    """Capacities that raise the lowest loads to one level and add up to ``total``."""
    order = sorted(range(len(loads)), key=lambda j: (loads[j], j))
    level, left = loads[order[0]], total
    for k, j in enumerate(order):
        step = (loads[j] - level) * k
        if step >= left:
            break
        left -= step
        level = loads[j]
    lowest = [j for j in order if loads[j] <= level]
    out = [max(0, level - x) for x in loads]
    for place, j in enumerate(lowest):
        out[j] += left // len(lowest) + (place < left % len(lowest))
    return out


def transfer_plan(old_sizes: list[int], new_shards: int, loads: list[int] | None = None) -> list[tuple[int, int, int, int]]:
    """(old, new, from_byte, to_byte): which run of each old shard goes where.

    Loads, none at first, and runs together differ by one byte at most where
    the runs have enough bytes for that. The run that stays comes first, the
    others follow by new shard; runs of an old shard leave no gap.
    """
    capacity = room_left(loads or [0] * new_shards, sum(old_sizes))
    cost = [[0 if i == j else 1 for j in range(new_shards)] for i in range(len(old_sizes))]
    runs = []
    for i, flows in enumerate(min_cost_flow(old_sizes, capacity, cost)):
        at = 0
        for j in sorted(range(new_shards), key=lambda j: (j != i, j)):
            if flows[j]:
                runs.append((i, j, at, at + flows[j]))
                at += flows[j]
    return runs


def small_size(sized: DataFrame, share: float = SMALL_SHARE) -> int:
    """Size up to which documents are small: they hold ``share`` of the bytes, from a histogram of a few hundred classes."""
    grade = F.floor(F.log2(F.col("size").cast("double")) * 8)
    classes = sized.groupBy(grade.alias("grade")).agg(F.max("size").alias("largest"), F.sum("size").alias("bytes")).orderBy("grade").collect()
    total, seen = sum(r["bytes"] for r in classes), 0
    for r in classes:
        seen += r["bytes"]
        if seen >= share * total:
            return r["largest"]
    return 0


def sized_documents(docs: DataFrame, id_col: str, text_col: str, old_col: str | None, old_shards: int) -> DataFrame:
    """Scratch table of (row, doc_id, size, text_crc32, old, stray, h, bucket).

    A row without a valid old shard is a stray: it is planned from the shard of its hash.
    """
    spread = F.xxhash64(F.lit(SEED), F.col(id_col).cast("long"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = F.pmod(spread, F.lit(old_shards)).cast("int")
    known = F.col(old_col).cast("int") if old_col else hashed
    stray = ~F.coalesce(known.between(0, old_shards - 1), F.lit(False))
    old = F.when(stray, hashed).otherwise(known)
    return materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            old.alias("old"),
            stray.alias("stray"),
            spread.alias("h"),
            F.pmod(F.shiftrightunsigned(spread, 16), F.lit(_BUCKETS)).alias("bucket"),
        )
    )


def reshard(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    old_col: str | None = None,
    old_shards: int = OLD_SHARDS,
    new_shards: int = NEW_SHARDS,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, old_shard, moved).

    Law ``bytes``: shard sizes are equal but for the small documents at the
    ends of runs. Old shards are the values 0..old_shards-1 of ``old_col``, or a hash of the id.
    A row whose ``old_col`` is null or no such value is new: it is placed like a row of the
    shard that its id's hash gives, its old_shard is null and it has moved.
    Documents move one by one: rows of equal text carry the same checksum but may
    lie in different shards, as a group of copies can exceed a shard.
    A null text has no bytes and the checksum of an empty one; repeated rows
    are placed one by one; a null id hashes like any other; an empty table
    gives an empty result.
    """
    sized = sized_documents(docs, id_col, text_col, old_col, old_shards)
    small = (F.col("size") <= small_size(sized)).cast("int").alias("small")
    graded = materialize(sized.select("*", small))
    order = [F.col("h"), F.col("doc_id"), F.col("row")]
    placed = materialize(prefix_sum(graded, ["old", "small"], "bucket", order, "size", "begin").withColumn("middle", F.expr("begin + size div 2")))
    sizes = {(r["old"], r["small"]): int(r["s"]) for r in placed.groupBy("old", "small").agg(F.sum("size").alias("s")).collect()}
    runs: list[tuple] = []
    loads = [0] * new_shards
    for k in (0, 1):  # the small documents last
        mine = [(k, *run) for run in transfer_plan([sizes.get((i, k), 0) for i in range(old_shards)], new_shards, loads)]
        runs += mine
        for r in _assign(placed.where(F.col("small") == k), mine).groupBy("shard").agg(F.sum("size").alias("s")).collect():
            loads[r["shard"]] += int(r["s"])
    assigned = _assign(placed, runs)
    fixed = materialize(
        assigned.select("row", "doc_id", "size", "text_crc32", "old", "stray", "h", "shard", (F.col("old") * _BUCKETS + F.col("bucket")).alias("cell"), F.lit(1).cast("long").alias("one"))
    )
    slotted = prefix_sum(fixed, ["shard"], "cell", order, "one", "slot")
    return slotted.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.when(~F.col("stray"), F.col("old")).alias("old_shard"),
        (F.col("stray") | (F.col("old") != F.col("shard"))).alias("moved"),
    )


def _assign(placed: DataFrame, runs: list[tuple]) -> DataFrame:
    """Each document with the shard of the run that holds its middle."""
    table = placed.sparkSession.createDataFrame(runs, "r_small int, r_old int, shard int, from_byte long, to_byte long")
    inside = (F.col("middle") >= F.col("from_byte")) & (F.col("middle") < F.col("to_byte"))
    return placed.join(F.broadcast(table), (F.col("old") == F.col("r_old")) & (F.col("small") == F.col("r_small")) & inside)  # a row a run


def rewrite_shards(docs: DataFrame, plan: DataFrame, path: str, id_col: str = "doc_id", files_per_shard: int = 8) -> list[int]:
    """Write the shards that the plan changes to ``path``/shard=N; returns them.

    A shard changes if it loses or gains a document. Repeated ids are joined
    once, so each of their rows goes to the shard of the first.
    """
    moved = plan.where("moved").select(F.explode(F.array("old_shard", "shard")).alias("shard")).where("shard IS NOT NULL").distinct()
    affected = sorted(r[0] for r in moved.collect())  # shard numbers, as many as there are shards
    where = plan.groupBy(F.col("doc_id").alias("_id")).agg(F.min("shard").alias("shard")).where(F.col("shard").isin(affected))
    rows = docs.join(where, docs[id_col].cast("long").eqNullSafe(F.col("_id"))).drop("_id")
    spread = rows.withColumn("_file", F.pmod(F.xxhash64(F.col(id_col)), F.lit(files_per_shard))).repartition("shard", "_file").drop("_file")
    spread.write.mode("overwrite").partitionBy("shard").parquet(path)
    return affected
