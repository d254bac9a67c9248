"""Text cleaning, codes and parsing over the document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import codes, markup, parse, text, urls
from loomwork.queries.registry import ORACLES, query, table

_WS = r"[\s\p{Z}\x{0b}\x{85}\x{1c}-\x{1f}]"
_BOM = text.BOM_CHARS


def _sql_ensure(e: str) -> str:
    return f"nullif(trim({e}, '{_BOM}'), '')"


def _sql_strip(e: str) -> str:
    return f"regexp_replace({e}, '^{_WS}+|{_WS}+$', '', 'g')"


def _sql_squash(e: str) -> str:
    return _sql_strip(f"regexp_replace({e}, '{_WS}+', ' ', 'g')")


#: White space, marks and dashes around every text, so that each rule has work.
_RAW = "chr(65279) || '  ' || text || chr(9) || ' – ' || chr(13) || chr(10) || lang || chr(160)"


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    around = F.concat(F.lit("﻿  "), "text", F.lit("\t – \r\n"), "lang", F.lit(" "))
    return table(spark, sf_dir, "documents").select("doc_id", around.alias("raw"))


@query(f"SELECT doc_id, nullif({_sql_squash(_sql_ensure(_RAW))}, '') AS cleaned FROM documents")
def sanitize_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select("doc_id", text.sanitize_string(F.col("raw")).alias("cleaned"))


@query(f"SELECT doc_id, nullif({_sql_squash(f'replace({_sql_ensure(_RAW)}, chr(13), {chr(39) * 2})')}, '') AS cleaned FROM documents")
def sanitize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select("doc_id", text.sanitize_name(F.col("raw")).alias("cleaned"))


@query(f"SELECT doc_id, nullif({_sql_squash(f'translate({_sql_ensure(_RAW)}, chr(10) || {chr(39)}–—{chr(39)} || chr(13), {chr(39)} --{chr(39)})')}, '') AS cleaned FROM documents")
def sanitize_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select("doc_id", text.sanitize_title(F.col("raw")).alias("cleaned"))


@query(
    f"""SELECT doc_id, nullif(array_to_string(list_filter(list_transform(string_split(replace({_sql_ensure(_RAW)}, chr(13), ''), chr(10)),
      lambda p: {_sql_squash('p')}), lambda p: p <> ''), chr(10)), '') AS cleaned FROM documents"""
)
def sanitize_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select("doc_id", text.sanitize_content(F.col("raw")).alias("cleaned"))


@query("SELECT page_id, nullif(replace(replace(regexp_replace('  ' || url || chr(13) || chr(10), '^\\s+|\\s+$', '', 'g'), chr(13), ''), chr(10), ''), '') AS cleaned FROM pages")
def sanitize_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("  "), "url", F.lit("\r\n"))
    return table(spark, sf_dir, "pages").select("page_id", text.sanitize_url(raw).alias("cleaned"))


@query()
def clean_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with references decoded, known tags removed, white space collapsed."""
    return table(spark, sf_dir, "pages").select("page_id", markup.clean_markup(F.col("html")).alias("cleaned"))


#: What the pages hold, said tag by tag: these four references, links and bold vanish, blocks part words, all else stays.
_SAID = "html"
for _ in range(3):
    for _name, _char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")):
        _SAID = f"replace({_SAID}, '{_name}', '{_char}')"
for _tag in ("<b>", "</b>", "</a>"):
    _SAID = f"replace({_SAID}, '{_tag}', '')"
_SAID = f"regexp_replace({_SAID}, '<a href=\"[^\"<>]*\">', '', 'g')"
for _tag in "<p> </p> <br> <ul> </ul> <li> </li> <h1> </h1> </div> <body> </body> <title> </title>".split():
    _SAID = f"replace({_SAID}, '{_tag}', ' ')"
_SAID = f"regexp_replace({_SAID}, '<div class=\"[^\"<>]*\">', ' ', 'g')"
_ONE_SPACE = "array_to_string(list_filter(string_split(translate({}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda w: w <> ''), ' ')"
ORACLES["clean_html"] = f"SELECT page_id, {_ONE_SPACE.format(_SAID)} AS cleaned FROM pages"


@query()
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with planted references and markup cleaned."""
    planted = F.concat(F.lit("CO&amp;lt;sub&amp;gt;2 &#x41;&#8364;&nbsp;&Eacute;&unknown; x &lt; 3 "), "text", F.lit(" <p>a<br/>b</p> <b>c</b> <Background>"))
    return table(spark, sf_dir, "documents").select("doc_id", markup.clean_markup(planted).alias("cleaned"))


#: The planted parts as they should come out; the documents hold neither references nor tags.
_EXPECTED = "'CO2 A€ É&unknown; x < 3 ' || text || ' a b c <Background>'"
ORACLES["clean_text"] = f"SELECT doc_id, {_ONE_SPACE.format(_EXPECTED)} AS cleaned FROM documents"


@query(
    """SELECT sum(len(regexp_extract_all(html, '&[a-zA-Z#][a-zA-Z0-9]*;')))::BIGINT AS refs_before, sum(len(regexp_extract_all(html, '</?[a-zA-Z][^<>]*>')))::BIGINT AS tags_before,
      0::BIGINT AS refs_after, sum(len(regexp_extract_all(html, '</?(?:html|head|meta|style|script|article|nav|footer)(?:[ >][^<>]*)?>|</?(?:html|head|meta|style|script|article|nav|footer)>')))::BIGINT AS tags_after FROM pages"""
)
def clean_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residual patterns before and after cleaning: references go, tags outside the lists stay."""
    count = lambda c, p: F.size(F.regexp_extract_all(c, F.lit(p), F.lit(0)))
    refs, tags = "&[a-zA-Z#][a-zA-Z0-9]*;", "</?[a-zA-Z][^<>]*>"
    both = table(spark, sf_dir, "pages").select("html", markup.clean_markup(F.col("html")).alias("cleaned"))
    sums = [F.sum(count(c, p)).alias(f"{name}_{when}") for c, when in (("html", "before"), ("cleaned", "after")) for p, name in ((refs, "refs"), (tags, "tags"))]
    return both.agg(*sums)


_PLAIN, _MARKED = text.accent_pairs()


@query(
    f"""SELECT doc_id, trim(regexp_replace(lower(translate(text, '{_MARKED}', '{_PLAIN}')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || '|' || lower(lang) AS name_key FROM documents"""
)
def name_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised key of a name and its country code."""
    return table(spark, sf_dir, "documents").select("doc_id", text.name_key(F.col("text"), F.col("lang")).alias("name_key"))


@query(
    """SELECT p_partkey AS id, nullif(lower(regexp_replace(trim(raw), '^(?:https?://(?:dx\\.)?doi\\.org/|doi:\\s*)', '', 'i')), '') AS doi
    FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'https://doi.org/10.1/' || p_name WHEN 1 THEN ' HTTP://DX.DOI.ORG/10.2/' || p_name WHEN 2 THEN 'doi: 10.3/' || p_name ELSE ' ' END AS raw FROM part)"""
)
def norm_doi(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_partkey") % 4
    raw = (
        F.when(kind == 0, F.concat(F.lit("https://doi.org/10.1/"), "p_name"))
        .when(kind == 1, F.concat(F.lit(" HTTP://DX.DOI.ORG/10.2/"), "p_name"))
        .when(kind == 2, F.concat(F.lit("doi: 10.3/"), "p_name"))
        .otherwise(" ")
    )
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), text.norm_doi(raw).alias("doi"))


@query(
    """WITH k AS (SELECT c_custkey AS id, regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') AS a FROM customer),
    z AS (SELECT id, a, regexp_replace(a, '^0+', '') AS z FROM k), p AS (SELECT *, regexp_replace(z, '^[a-z]+0*', '') AS p FROM z)
    SELECT id, CASE WHEN length(a) >= 4 THEN a END AS k_alnum, CASE WHEN length(z) >= 4 THEN z END AS k_zeros, CASE WHEN length(p) >= 4 THEN p END AS k_prefix FROM p"""
)
def grant_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested identifier keys with their least lengths."""
    c = F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), text.key_alnum(c).alias("k_alnum"), text.key_zeros(c).alias("k_zeros"), text.key_prefix(c).alias("k_prefix")
    )


#: Two letters for each nation key of the test tables, some of them invalid on purpose.
_CODES = "DZ AR BR CA EG ET FR DE IN ID IR IQ JP JO KE MA MZ PE CN RO SA VN UK EL ZZ".split()


@query()
def norm_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(x) for x in _CODES]), F.col("n_nationkey") + 1)
    raw = F.concat(F.lit(" "), F.lower(code))
    return table(spark, sf_dir, "nation").select("n_nationkey", codes.norm_country(raw, codes.iso_countries(spark)).alias("code"))


_ISO = "AR BR CA CN DE DZ EG ET FR GB GR ID IN IQ IR JO JP KE MA MZ PE RO SA VN".split()
ORACLES["norm_country"] = (
    f"SELECT n_nationkey, {codes.norm_country_sql('raw', _ISO)} AS code FROM (SELECT n_nationkey, ' ' || lower(({_CODES!r})[n_nationkey + 1]) AS raw FROM nation)"
)


@query(
    f"""SELECT doc_id, CASE WHEN c IN ('und', '') THEN NULL ELSE coalesce(MAP {codes.LANGUAGE_REMAP!r}[c], c) END AS language
    FROM (SELECT doc_id, lower(split_part(CASE lang WHEN 'en' THEN 'ENG' WHEN 'de' THEN 'ger/deu' WHEN 'fr' THEN 'fre' ELSE 'und' END, '/', 1)) AS c FROM documents)"""
)
def norm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("lang") == "en", "ENG").when(F.col("lang") == "de", "ger/deu").when(F.col("lang") == "fr", "fre").otherwise("und")
    return table(spark, sf_dir, "documents").select("doc_id", codes.norm_language(raw).alias("language"))


_FX = ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in codes.UNITS_PER_EUR.items())
_CURRENCIES = ["EUR", "USD", "$", "JPY", "GBP", "XXX"]


@query(
    f"""WITH fx(currency, rate) AS (VALUES {_FX}), o AS (SELECT o_orderkey, o_totalprice * CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE 1 END AS amount,
      CASE WHEN o_orderkey % 11 = 0 THEN 'CHF' ELSE CASE WHEN ({_CURRENCIES!r})[o_orderkey % 6 + 1] = '$' AND o_orderkey % 2 = 0 THEN 'AUD' WHEN ({_CURRENCIES!r})[o_orderkey % 6 + 1] = '$' THEN 'USD'
      ELSE ({_CURRENCIES!r})[o_orderkey % 6 + 1] END END AS currency FROM orders)
    SELECT o_orderkey AS id, o.currency, round(CASE WHEN amount > 0 AND amount / rate <= 1e9 THEN amount / rate END, 2) AS amount_eur FROM o LEFT JOIN fx ON fx.currency = o.currency"""
)
def fx_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts in euro: currency by funder rule, cap, unknown rates null."""
    key = F.col("o_orderkey")
    cur = F.when(key % 11 == 0, None).otherwise(F.element_at(F.array(*[F.lit(c) for c in _CURRENCIES]), (key % 6 + 1).cast("int")))
    funders = F.when(key % 11 == 0, F.array(F.lit("SNSF"))).when(key % 2 == 0, F.array(F.lit("NHMRC")))
    amount = F.when(key % 7 == 0, 0.0).otherwise(F.col("o_totalprice"))
    rows = table(spark, sf_dir, "orders").select(key.alias("id"), codes.norm_currency(cur, funders).alias("currency"), amount.alias("amount"))
    return codes.with_euros(rows, "amount", "currency").select("id", "currency", F.round("amount_eur", 2).alias("amount_eur"))


@query(
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN true WHEN event_id % 3 = 1 THEN false END AS flag, event_id AS n, round(value, 4) AS x,
      CASE WHEN event_id % 90 <= 90 THEN round((event_id % 90)::DOUBLE, 1) END AS lat, round((event_id % 170)::DOUBLE, 1) AS lon FROM events"""
)
def parse_primitives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Booleans, numbers and points parsed from text."""
    e = table(spark, sf_dir, "events")
    key = F.col("event_id")
    flag = F.when(key % 3 == 0, " Yes").when(key % 3 == 1, "0").otherwise("perhaps")
    point = parse.parse_point(F.concat(F.lit("["), key % 170, F.lit(", "), key % 90, F.lit("]")), longitude_first=True)
    return e.select(
        "event_id",
        parse.parse_bool(flag).alias("flag"),
        parse.parse_long(F.concat(F.lit(" "), key.cast("string"))).alias("n"),
        F.round(parse.parse_double(F.col("value").cast("string")), 4).alias("x"),
        point["lat"].alias("lat"),
        point["lon"].alias("lon"),
    )


def _instances() -> F.Column:
    one = lambda access, *urls_: F.struct(
        F.struct(F.lit(access).alias("label")).alias("accessRight"),
        F.array(*urls_).alias("urls"),
        F.array(F.struct(F.lit("doi").alias("scheme"), F.concat(F.lit("https://doi.org/10.9/"), F.col("page_id").cast("string")).alias("value"))).alias("pids"),
    )
    odd = F.col("page_id") % 2 == 1
    plain = F.col("url")
    return F.array(one("CLOSED", plain, F.concat("url", F.lit(".PDF?x=1&amp;y=2"))), one("OPEN", F.when(odd, F.concat("url", F.lit("/pdf/1"))).otherwise(plain)))


@query(
    """SELECT page_id, CASE WHEN page_id % 2 = 1 OR contains(lower(url), '/pdf') THEN replace(CASE WHEN page_id % 2 = 1 THEN url || '/pdf/1' ELSE url END, '&amp;', '&')
      WHEN regexp_matches(lower(split_part(url || '.PDF?x=1&amp;y=2', '?', 1)), '\\.pdf$') THEN replace(url || '.PDF?x=1&amp;y=2', '&amp;', '&') END AS pdf_url,
      'https://doi.org/10.9/' || page_id AS landing_url FROM pages"""
)
def work_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PDF and landing links chosen by rule from nested instances."""
    pids = F.array(F.struct(F.lit("handle").alias("scheme"), F.lit("1/2").alias("value")))
    return table(spark, sf_dir, "pages").withColumn("i", _instances()).select("page_id", urls.pdf_url(F.col("i")).alias("pdf_url"), urls.landing_url(pids, F.col("i")).alias("landing_url"))


@query(
    """SELECT doc_id, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) >= 10 AND length(regexp_replace(text, '[^A-Z]', '', 'g')) >= 0.8 * length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS shouting,
      length(text) > 3 * length(split_part(text, chr(10), 1)) + 40 AS too_long FROM documents"""
)
def text_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guards before and after translation."""
    first = F.split_part("text", F.lit("\n"), F.lit(1))
    return table(spark, sf_dir, "documents").select("doc_id", text.is_shouting(F.col("text")).alias("shouting"), text.hallucinated(first, F.col("text")).alias("too_long"))
