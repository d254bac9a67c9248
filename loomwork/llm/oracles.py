"""DuckDB SQL of what SQL can say about the operators.

Two operators have SQL as a whole: the links of a small table of vectors, and
the main text of pages whose article element holds it, as those of the test
tables. Of others SQL gives the columns that no hash, model or search decides.
"""

_WORD = r"[^\x20\x09-\x0D]+"
_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: All pairs of the table; components by following links.
EMBEDDING_LINKS = """WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    good AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / a.norm / b.norm >= 0.9),
    reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
    SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links, least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id,
      vec_id = least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS kept FROM v"""

_DECODED = "b"
for _name, _char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
    _DECODED = f"regexp_replace({_DECODED}, '&{_name};?', '{_char}', 'g')"
_ARTICLE = "regexp_extract(coalesce(html, ''), '<article>(.*?)(?:</article>|$)', 1, 's')"
_BLOCKS = f"string_split(regexp_replace(regexp_replace({_ARTICLE}, '</?b>', '', 'g'), '</?(?:p|h1)>', chr(1), 'g'), chr(1))"
_LINES = f"list_filter(list_transform(list_transform({_BLOCKS}, lambda b: replace(b, '<br>', ' ')), lambda b: trim(regexp_replace({_DECODED}, '\\s+', ' ', 'g'))), lambda b: b <> '')"
#: The article element, block by block; the pages hold these four references.
MAIN_TEXT = f"SELECT page_id, url, text, length(text) AS n_chars FROM (SELECT page_id, url, array_to_string({_LINES}, chr(10)) AS text FROM pages)"

#: Sources filled up to three times their size: the level is that of the first source it does not fill.
MIX_TARGETS = f"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
    r AS (SELECT *, 3.0 * source_size AS cap, 3.0 * source_size / w AS full_at FROM s),
    c AS (SELECT *, (SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER before, 0) AS rest, sum(w) OVER (ORDER BY full_at, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open, row_number() OVER (ORDER BY full_at, source) AS k FROM r
      WINDOW before AS (ORDER BY full_at, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    l AS (SELECT coalesce(arg_min(rest / open, k) FILTER (rest / open <= full_at), max(full_at)) AS level FROM c)
    SELECT doc_id, size, source_size, round(least(cap, w * level), 3) AS target FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source, l"""

_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def _starts(phrase: str) -> str:
    words = phrase.split()
    test = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words))
    return f"list_transform(list_filter(range(1, len(w) - {len(words) - 2}), lambda i: {test}), lambda i: {{'at': i - 1, 'label': '{_PHRASES[phrase]}'}})"


_ALL_STARTS = "list_concat(" + ", ".join(_starts(p) for p in list(_PHRASES)[:2]) + ")"
for _phrase in list(_PHRASES)[2:]:
    _ALL_STARTS = f"list_concat({_ALL_STARTS}, {_starts(_phrase)})"
LICENSE_BASE = f"""SELECT doc_id, len(w)::BIGINT AS n_words, len(p)::BIGINT AS n_base, list_min(list_transform(p, lambda x: x.at))::BIGINT AS first_word, list_max(list_transform(p, lambda x: x.at))::BIGINT AS last_word,
    array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label))), ',') AS base_labels
    FROM (SELECT doc_id, w, {_ALL_STARTS} AS p FROM (SELECT doc_id, regexp_extract_all({_AZ}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents))"""

#: Words of three-word windows that a text has twice.
QUALITY_BASE = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{_WORD}') AS w FROM d),
    win AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest([w[j] || ' ' || w[j + 1] || ' ' || w[j + 2] for j in range(1, len(w) - 1)]) AS x FROM w),
    again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM win) WHERE n > 1), hit AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) v(k) GROUP BY r),
    m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
      list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines, coalesce(hit.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN hit USING (r))
    SELECT doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m"""

RESHARD_SIZES = "SELECT doc_id, (octet_length(encode(coalesce(text, ''))) + 8)::BIGINT AS size, 'bytes' AS law FROM documents"
