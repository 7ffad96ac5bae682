"""All queries of the reference's operators over the driver's tables, and their SQL oracles.

The driver's tables hold no orders, so where an operator needs titles, addresses or citations both sides derive the same
strings from real columns by the same SQL (``TITLES`` and the like). Every query runs over its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ident, text
from ..operators import graph
from ..operators import relational as rel
from ..sources.tables import probe_class as probe

# Terms of office.
TERMS = [
    (1974, 1977, "Beame"), (1978, 1989, "Koch"), (1990, 1993, "Dinkins"), (1994, 2001, "Giuliani"), (2002, 2013, "Bloomberg"),
    (2014, 2021, "de Blasio"), (2022, 2025, "Adams"), (2026, 2029, "Mamdani"),
]
# creators' names.
CREATORS = {
    "abraham d. beame": "Beame", "abraham beame": "Beame", "beame": "Beame", "edward i. koch": "Koch", "ed koch": "Koch", "koch": "Koch",
    "david n. dinkins": "Dinkins", "dinkins": "Dinkins", "rudolph w. giuliani": "Giuliani", "rudolph giuliani": "Giuliani",
    "giuliani": "Giuliani", "michael r. bloomberg": "Bloomberg", "michael bloomberg": "Bloomberg", "bloomberg": "Bloomberg",
    "bill de blasio": "de Blasio", "de blasio": "de Blasio", "deblasio": "de Blasio", "eric adams": "Adams", "eric l. adams": "Adams",
    "adams": "Adams", "zohran mamdani": "Mamdani", "zohran kwame mamdani": "Mamdani", "mamdani": "Mamdani", "john v. lindsay": "Lindsay",
    "robert f. wagner": "Wagner", "wagner": "Wagner", "vincent r. impellitteri": "Impellitteri", "william o’dwyer": "O'Dwyer",
    "william o'dwyer": "O'Dwyer",
}

TITLES = """CASE o_orderkey % 9 WHEN 0 THEN 'Emergency Executive Order ' || CAST(o_orderkey AS STRING)
  WHEN 1 THEN 'Executive Order No. ' || CAST(o_orderkey % 90 AS STRING) || '.' || CAST(o_custkey % 50 AS STRING)
  WHEN 2 THEN 'Designation of the Mayor Office' WHEN 3 THEN 'EEO ' || CAST(o_orderkey AS STRING) || ' - Storm  relief..'
  WHEN 4 THEN '  EO No. 0' || CAST(o_orderkey AS STRING) || ' - Heat' WHEN 5 THEN 'Executive Orders and Memoranda, 1974'
  WHEN 6 THEN 'On travel, Emergency Executive  Order ' || CAST(o_orderkey AS STRING) WHEN 7 THEN 'See E.O. ' || CAST(o_custkey AS STRING) || ' below.'
  ELSE 'executive order ' || CAST(o_orderkey AS STRING) || ', 2020' END"""
URLS = """CASE o_orderkey % 8 WHEN 0 THEN 'http://www1.nyc.gov/html/records/pdf/' || CAST(2000 + o_orderkey % 20 AS STRING) || 'EO' || CAST(o_custkey AS STRING) || '.pdf'
  WHEN 1 THEN 'https://h.example/assets/executive-orders/2016/eeo-' || CAST(o_custkey AS STRING) || '.pdf?x=1#p'
  WHEN 2 THEN 'https://h.example/assets/executive-orders/2018/EO_' || CAST(o_custkey AS STRING) || '.PDF'
  WHEN 3 THEN 'https://h.example/assets/executive-orders/2016/mpo-2016-' || CAST(o_custkey AS STRING) || '.pdf'
  WHEN 4 THEN 'https://h.example/designation-of-agencies.pdf' WHEN 5 THEN 'https://h.example/x/2011EEO-' || CAST(o_custkey AS STRING) || '.5.pdf/'
  WHEN 6 THEN 'https://h.example/assets/executive-orders/2014/eo-45.pdf.105' ELSE '' END"""
BODIES = """CASE o_orderkey % 7
  WHEN 0 THEN '§ 1. Executive Order No. ' || CAST(o_custkey % 300 AS STRING) || ', dated March 7, ' || CAST(1990 + o_custkey % 20 AS STRING) || ', is hereby REVOKED. § 2.'
  WHEN 1 THEN 'Section 4. Executive Order ' || CAST(o_custkey % 300 AS STRING) || ' of ' || CAST(1990 + o_custkey % 20 AS STRING) || ' is hereby amended. Section 5.'
  WHEN 2 THEN 'Text. Emergency Executive Order ' || CAST(o_custkey % 300 AS STRING) || ' of ' || CAST(1990 + o_custkey % 20 AS STRING) || ' is extended for five days.'
  WHEN 3 THEN 'Section 8 of Executive Order No. ' || CAST(o_custkey % 300 AS STRING) || ' of ' || CAST(1990 + o_custkey % 20 AS STRING) || ' is repealed.'
  WHEN 4 THEN 'Executive Order No. ' || CAST(o_custkey % 300 AS STRING) || ' is hereby superseded.'
  WHEN 5 THEN 'Executive Order No. ' || CAST(o_custkey % 300 AS STRING) || ' of 1474 is rescinded.'
  ELSE 'This order takes effect at once.' END"""
#: Orders as a corpus: year, number and whether an emergency order; ids repeat, so rows are made distinct by the least key.
CORPUS = "1990 + o_orderkey % 20 AS year, CAST(o_orderkey % 300 AS STRING) AS number, o_orderkey % 5 = 0 AS is_emergency"
HEADERS = """CASE WHEN o_orderkey % 3 = 0 THEN 'CITY XREF: AMENDED BY ''EO ' || CAST(o_custkey % 300 AS STRING) || ') ' || CAST(1990 + o_custkey % 20 AS STRING) || '"'
  ELSE 'CITY OF NEW YORK' END"""
LINES = """CASE p_partkey % 6 WHEN 0 THEN '37-' || CAST(p_size AS STRING) WHEN 1 THEN 'nl-' || CAST(p_size AS STRING)
  WHEN 2 THEN '(a)' WHEN 3 THEN '[ps ' || CAST(p_size AS STRING) || '-&]' WHEN 4 THEN '§' || CAST(p_size AS STRING) ELSE p_name END"""
DATES = """CASE o_orderkey % 6 WHEN 0 THEN 'DATED MARCH ' || CAST(1 + o_custkey % 33 AS STRING) || ', ' || CAST(1970 + o_orderkey % 3 AS STRING)
  WHEN 1 THEN '08/' || CAST(1 + o_custkey % 31 AS STRING) || '/71' WHEN 2 THEN 'on 2-31-1971 or' WHEN 3 THEN 'Februapyel3; 1971'
  WHEN 4 THEN 'Sept. 9, 1970 and 1/2/1971' ELSE '' END"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import jobs  # noqa: F401 - its queries are kept here

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import jobs  # noqa: F401

    return dict(ORACLES)


# Identity ---------------------------------------------------------------------------------------------------------

_PAD = "CASE WHEN length({0}) >= 3 THEN {0} ELSE lpad({0}, 3, '0') END"
_MINT = "CAST({y} AS VARCHAR) || CASE WHEN {e} THEN '-EEO-' || {n} ELSE '-EO-' || CASE WHEN length({n}) >= 3 THEN {n} ELSE lpad({n}, 3, '0') END END"


@query("mint_id", f"SELECT o_orderkey, {_MINT.format(y='1990 + o_orderkey % 30', n='CAST(o_orderkey % 2000 AS VARCHAR)', e='o_orderkey % 4 = 0')} AS eo_id FROM orders")
def mint_id(spark, sf_dir):
    d = read(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderkey % 4 = 0 AS e", "CAST(o_orderkey % 2000 AS STRING) AS n", "1990 + o_orderkey % 30 AS y")
    return d.select("o_orderkey", ident.mint_id(F.col("y"), F.col("n"), F.col("e")).alias("eo_id"))


@query("parse_number", f"""WITH d AS (SELECT o_orderkey, {TITLES} AS t FROM orders)
  SELECT o_orderkey, nullif(regexp_extract(t, '(?i)order\\s+(?:no\\.?\\s*)?(\\d+(?:\\.\\d+)?)', 1), '') AS number,
  lower(t) LIKE '%executive order%' AS is_order, lower(trim(t)) LIKE 'emergency%' AS is_emergency FROM d""")
def parse_number(spark, sf_dir):
    d = read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{TITLES} AS t")
    t = F.col("t")
    return d.select("o_orderkey", ident.parse_number(t).alias("number"), ident.is_order(t).alias("is_order"), ident.is_emergency(t).alias("is_emergency"))


@query("parse_article_date", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_signed FROM orders""")
def parse_article_date(spark, sf_dir):
    d = read(spark, sf_dir, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 4 = 0 THEN 'Soon, 2024' ELSE date_format(o_orderdate, 'MMMM d, yyyy') END AS t")
    return d.select("o_orderkey", ident.parse_article_date(F.col("t")).alias("date_signed"))


_BASE = "regexp_replace(regexp_extract(regexp_replace(regexp_replace(u, '[?#].*$', ''), '/+$', ''), '[^/]*$'), '(?i)\\.pdf$', '')"


@query("filename_identity", f"""WITH d AS (SELECT o_orderkey, {URLS} AS u FROM orders), s AS (SELECT o_orderkey, {_BASE} AS s FROM d),
  m AS (SELECT *, '(?i)(\\d{{4}})[-_ ]?(EEO|EO)[-_ ]?(\\d+(?:\\.\\d+)?)' AS rx FROM s)
  SELECT o_orderkey, try_cast(regexp_extract(s, '(?i)(\\d{{4}})[-_ ]?(EEO|EO)[-_ ]?(\\d+(?:\\.\\d+)?)', 1) AS INT) AS year,
  nullif(regexp_extract(s, '(?i)(\\d{{4}})[-_ ]?(EEO|EO)[-_ ]?(\\d+(?:\\.\\d+)?)', 3), '') AS number,
  CASE WHEN regexp_matches(s, rx) THEN upper(regexp_extract(s, '(?i)(\\d{{4}})[-_ ]?(EEO|EO)[-_ ]?(\\d+(?:\\.\\d+)?)', 2)) = 'EEO' END AS emergency FROM m""")
def filename_identity(spark, sf_dir):
    d = read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{URLS} AS u")
    return d.withColumn("i", ident.filename_identity(F.col("u"))).select("o_orderkey", "i.year", "i.number", "i.emergency")


@query("assets_identity", f"""WITH d AS (SELECT o_orderkey, {URLS} AS u FROM orders), s AS (SELECT o_orderkey, {_BASE} AS s,
  try_cast(nullif(regexp_extract(regexp_replace(u, '\\?.*$', ''), '(?i)/executive-orders/(\\d{{4}})/', 1), '') AS INT) AS y FROM d),
  k AS (SELECT *, regexp_matches(s, '(?i)^(eeo|eo)[-_]?(\\d+(?:\\.\\d+)?)$') AND y IS NOT NULL AND NOT starts_with(lower(s), 'mpo-') AS ok FROM s)
  SELECT o_orderkey, CASE WHEN ok THEN y END AS year, CASE WHEN ok THEN regexp_extract(s, '(?i)^(eeo|eo)[-_]?(\\d+(?:\\.\\d+)?)$', 2) END AS number,
  CASE WHEN ok THEN lower(regexp_extract(s, '(?i)^(eeo|eo)[-_]?(\\d+(?:\\.\\d+)?)$', 1)) = 'eeo' END AS emergency FROM k""")
def assets_identity(spark, sf_dir):
    d = read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{URLS} AS u")
    return d.withColumn("i", ident.assets_identity(F.col("u"))).select("o_orderkey", "i.year", "i.number", "i.emergency")


_PDF = "'/content/dam/nycgov/mayors-office/downloads/pdf/executive-orders/2022/eo-' || CAST(page_id AS VARCHAR) || '.pdf'"


@query("candidate_urls", f"""WITH d AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE url END AS u, page_id % 6 = 0 AS none FROM pages),
  p AS (SELECT page_id, CASE WHEN u IS NOT NULL THEN regexp_extract(u, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) WHEN NOT none THEN {_PDF} END AS path FROM d)
  SELECT page_id, 'https://www.nyc.gov' || path AS public_url,
  'https://www.nyc.gov/assets/home/downloads/pdf/executive-orders/2022/' || lower(regexp_extract(regexp_replace(path, '/+$', ''), '[^/]*$')) AS legacy_url FROM p""")
def candidate_urls(spark, sf_dir):
    d = read(spark, sf_dir, "pages").selectExpr("page_id", "CASE WHEN page_id % 3 = 0 THEN NULL ELSE url END AS u", "CASE WHEN page_id % 6 <> 0 THEN CAST(page_id AS STRING) END AS n")
    c = ident.candidate_urls(F.col("u"), F.lit(2022), F.col("n"), F.lit(False))
    return d.withColumn("c", c).select("page_id", F.try_element_at("c", F.lit(1)).alias("public_url"), F.try_element_at("c", F.lit(2)).alias("legacy_url"))


_N = "(\\d+(?:\\.\\d+)?)"


@query("title_kind", f"""WITH d AS (SELECT o_orderkey, {TITLES} AS t FROM orders), k AS (SELECT o_orderkey, t,
  CASE WHEN regexp_matches(t, '(?i)executive orders and memoranda') THEN 1 WHEN regexp_matches(t, '(?i)^\\s*(E?)EO\\s+(?:No\\.?\\s*)?{_N}\\b') THEN 2
  WHEN regexp_matches(t, '(?i)^\\s*(Emergency\\s+)?Executive\\s+Order[,\\s]*(?:No\\.?\\s*)?\\s*{_N}\\b') THEN 3
  WHEN regexp_matches(t, '(?i)Emergency\\s+Executive\\s+Order\\s*(?:No\\.?\\s*)?{_N}') THEN 4 WHEN regexp_matches(t, '\\bE\\.?O\\.?\\s*(?:No\\.?\\s*)?{_N}\\b') THEN 5 ELSE 6 END AS k FROM d)
  SELECT o_orderkey, CASE k WHEN 1 THEN 'volume' WHEN 4 THEN 'eeo' WHEN 5 THEN 'eo' WHEN 6 THEN 'unparsed'
    WHEN 2 THEN CASE WHEN regexp_matches(t, '(?i)^\\s*EEO') THEN 'eeo' ELSE 'eo' END ELSE CASE WHEN regexp_matches(t, '(?i)^\\s*Emergency') THEN 'eeo' ELSE 'eo' END END AS kind,
  CASE k WHEN 2 THEN regexp_extract(t, '(?i)^\\s*(E?)EO\\s+(?:No\\.?\\s*)?{_N}\\b', 2) WHEN 3 THEN regexp_extract(t, '(?i)^\\s*(Emergency\\s+)?Executive\\s+Order[,\\s]*(?:No\\.?\\s*)?\\s*{_N}\\b', 2)
    WHEN 4 THEN regexp_extract(t, '(?i)Emergency\\s+Executive\\s+Order\\s*(?:No\\.?\\s*)?{_N}', 1) WHEN 5 THEN regexp_extract(t, '\\bE\\.?O\\.?\\s*(?:No\\.?\\s*)?{_N}\\b', 1) END AS number,
  regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(t, '\\s+', ' ', 'g')), '\\.+$', ''), '\\s+$', ''), '^\\s+', '') AS title FROM k""")
def title_kind(spark, sf_dir):
    d = read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{TITLES} AS t")
    return d.withColumn("k", ident.title_kind(F.col("t"))).select("o_orderkey", "k.kind", "k.number", ident.clean_title(F.col("t")).alias("title"))


@query("norm_number", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber % 3 WHEN 0 THEN CAST(l_partkey AS VARCHAR) || '.07' WHEN 1 THEN CAST(l_partkey AS VARCHAR) ELSE 'A' || CAST(l_partkey AS VARCHAR) END AS number FROM lineitem""")
def norm_number(spark, sf_dir):
    d = read(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "CASE l_linenumber % 3 WHEN 0 THEN '00' || l_partkey || '.07' WHEN 1 THEN ' 0' || l_partkey ELSE 'A' || l_partkey END AS n")
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ident.norm_number(F.col("n")).alias("number"))


# Windows, joins, sets ----------------------------------------------------------------------------------------------


@query("best_capture", "SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id) = 1")
def best_capture(spark, sf_dir):
    d = rel.latest(read(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], "ts", "event_id")
    return d.select("user_id", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("best_capture_identity", """WITH d AS (SELECT *, CASE WHEN event_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) || '-' || event_type END AS id FROM events)
  (SELECT id, event_type, event_id FROM d WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id) = 1)
  UNION ALL (SELECT id, event_type, event_id FROM d WHERE id IS NULL QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) = 1)""")
def best_capture_identity(spark, sf_dir):
    d = read(spark, sf_dir, "events").selectExpr("CASE WHEN event_id % 10 <> 0 THEN concat(user_id, '-', event_type) END AS id", "event_type", "event_id", "ts")
    return rel.latest_by_identity(d, "id", "event_type", "ts", "event_id").select("id", "event_type", "event_id")


_ITEMS = "SELECT l_orderkey AS id, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_partkey % 5 END AS url, l_linenumber, l_partkey, l_suppkey FROM lineitem"


@query("dedupe_rows", f"WITH d AS ({_ITEMS}) SELECT id, url, l_linenumber FROM d QUALIFY row_number() OVER (PARTITION BY id, url ORDER BY l_linenumber, l_partkey, l_suppkey) = 1")
def dedupe_rows(spark, sf_dir):
    return rel.collapse_duplicates(_items(spark, sf_dir), "id", "url", ["l_linenumber", "l_partkey", "l_suppkey"])[0].select("id", "url", "l_linenumber")


@query("dedupe_conflicts", f"""WITH d AS ({_ITEMS}), k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY id, url ORDER BY l_linenumber, l_partkey, l_suppkey) = 1),
  f AS (SELECT id, url, first_value(url) OVER (PARTITION BY id ORDER BY l_linenumber, l_partkey, l_suppkey) AS first_value FROM k)
  SELECT id, first_value, url FROM f WHERE url IS DISTINCT FROM first_value""")
def dedupe_conflicts(spark, sf_dir):
    return rel.collapse_duplicates(_items(spark, sf_dir), "id", "url", ["l_linenumber", "l_partkey", "l_suppkey"])[1]


def _items(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS id", "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_partkey % 5 END AS url", "l_linenumber", "l_partkey", "l_suppkey")


@query("merge_prefer_live", """WITH l AS (SELECT o_custkey AS id, 'live' AS source, o_orderkey FROM orders WHERE o_orderpriority LIKE '1%'),
  w AS (SELECT o_custkey AS id, 'archive' AS source, o_orderkey FROM orders WHERE o_orderpriority NOT LIKE '1%')
  SELECT * FROM l UNION ALL SELECT * FROM w WHERE id NOT IN (SELECT id FROM l)""")
def merge_prefer_live(spark, sf_dir):
    d = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey", F.col("o_orderpriority").startswith("1").alias("l"))
    live, other = d.filter("l").withColumn("source", F.lit("live")), d.filter("NOT l").withColumn("source", F.lit("archive"))
    return rel.prefer_first(live.drop("l"), other.drop("l"), "id")[0].select("id", "source", "o_orderkey")


@query("missing_numbers", """WITH d AS (SELECT DISTINCT year(o_orderdate)::INT AS year, o_orderstatus, o_custkey AS n FROM orders WHERE o_custkey % 10 <> 3),
  b AS (SELECT year, o_orderstatus, min(n) AS lo, max(n) AS hi FROM d GROUP BY ALL)
  SELECT year, o_orderstatus, m AS missing FROM (SELECT year, o_orderstatus, unnest(range(lo, hi + 1)) AS m FROM b) g
  WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.year = g.year AND d.o_orderstatus = g.o_orderstatus AND d.n = g.m)""")
def missing_numbers(spark, sf_dir):
    d = read(spark, sf_dir, "orders").selectExpr("year(o_orderdate) AS year", "o_orderstatus", "CASE WHEN o_custkey % 10 = 3 THEN o_custkey || '.5' ELSE CAST(o_custkey AS STRING) END AS n")
    return rel.missing_numbers(d, ["year", "o_orderstatus"], F.col("n"))


_CASE = "CASE " + " ".join(f"WHEN {{0}} BETWEEN {a} AND {b} THEN '{m}'" for a, b, m in TERMS) + " END"


@query("mayor_range", f"SELECT o_orderkey, {_CASE.format('1970 + o_orderkey % 64')} AS mayor FROM orders")
def mayor_range(spark, sf_dir):
    return rel.in_range(read(spark, sf_dir, "orders"), 1970 + F.col("o_orderkey") % 64, TERMS, "mayor").select("o_orderkey", "mayor")


_CR = """CASE o_custkey % 5 WHEN 0 THEN 'Nobody; Ed Koch , x' WHEN 1 THEN 'BEAME' WHEN 2 THEN 'Unknown' WHEN 3 THEN 'Bill de Blasio, Koch' ELSE '' END"""


@query("creator_lookup", f"""SELECT o_orderkey, coalesce(CASE o_custkey % 5 WHEN 0 THEN 'Koch' WHEN 1 THEN 'Beame' WHEN 3 THEN 'de Blasio' END, {_CASE.format('1970 + o_orderkey % 64')}) AS mayor FROM orders""")
def creator_lookup(spark, sf_dir):
    d = read(spark, sf_dir, "orders").withColumn("cr", F.expr(_CR))
    parts = F.transform(F.split("cr", "[;,]"), lambda p: F.lower(ident.strip(p)))
    d = rel.in_range(d, 1970 + F.col("o_orderkey") % 64, TERMS, "term")
    return d.select("o_orderkey", F.coalesce(rel.first_known(parts, CREATORS), F.col("term")).alias("mayor"))


_GROUPS = "SELECT doc_id % 700 AS k, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE lang END AS g, count(*) AS n FROM documents GROUP BY 1, 2"
_HELD = "SELECT doc_id % 900 + 1 AS k, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE 'en' END AS g, quality = 1 AS has_file FROM labels"


@query("classify_dispositions", f"""WITH g AS ({_GROUPS}), c AS (SELECT k, g, bool_or(has_file) AS f FROM ({_HELD}) GROUP BY ALL)
  SELECT g.k, g.g, g.n::BIGINT AS n, CASE WHEN g.k % 97 = 5 AND g.g = 'en' THEN 'ledger' WHEN f THEN 'dual' WHEN f IS NOT NULL THEN 'gap-existing' WHEN g.k % 10 = 1 AND g.g = 'fr' THEN 'gap-mint' ELSE 'net-new' END AS disposition
  FROM g LEFT JOIN c ON g.k IS NOT DISTINCT FROM c.k AND g.g IS NOT DISTINCT FROM c.g""")
def classify_dispositions(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").selectExpr("doc_id % 700 AS k", "CASE WHEN doc_id % 11 = 0 THEN NULL ELSE lang END AS g")
    groups = docs.groupBy("k", "g").agg(F.count("*").alias("n"))
    held = read(spark, sf_dir, "labels").selectExpr("doc_id % 900 + 1 AS k", "CASE WHEN doc_id % 13 = 0 THEN NULL ELSE 'en' END AS g", "quality = 1 AS has_file")
    lost = groups.filter("k % 10 = 1 AND g = 'fr'").select("k", "g")
    ledger = groups.filter("k % 97 = 5 AND g = 'en'").select("k", "g", F.lit("ledger").alias("disposition"))
    return rel.classify(groups, held, ledger, ["k", "g"], lost).select("k", "g", "n", "disposition")


@query("staging_reconcile", """WITH e AS (SELECT DISTINCT doc_id FROM documents), p AS (SELECT doc_id + 50 AS doc_id, quality = 1 AS v FROM labels)
  SELECT coalesce(e.doc_id, p.doc_id) AS doc_id, CASE WHEN e.doc_id IS NULL THEN 'extra' WHEN p.v IS NULL THEN 'missing' WHEN v THEN 'present' ELSE 'corrupt' END AS state
  FROM e FULL JOIN p ON e.doc_id = p.doc_id""")
def staging_reconcile(spark, sf_dir):
    staged = read(spark, sf_dir, "labels").selectExpr("doc_id + 50 AS doc_id", "quality = 1 AS ok")
    return rel.reconcile(read(spark, sf_dir, "documents").select("doc_id"), staged, "doc_id", "ok")


@query("priority_fallback", """WITH h AS (SELECT user_id, max(event_id) AS event_id FROM events WHERE event_id % 3 = 0 GROUP BY 1),
  a AS (SELECT c_custkey, unnest([c_custkey, c_custkey + 1]) AS c, unnest([0, 1]) AS pos FROM customer),
  b AS (SELECT a.*, h.event_id FROM a JOIN h ON h.user_id = a.c QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY pos) = 1)
  SELECT customer.c_custkey, b.c AS candidate, b.event_id FROM customer LEFT JOIN b USING (c_custkey)""")
def priority_fallback(spark, sf_dir):
    asked = read(spark, sf_dir, "customer").select("c_custkey")
    hits = read(spark, sf_dir, "events").filter("event_id % 3 = 0").select("user_id", "event_id")
    return rel.first_candidate(asked, F.array("c_custkey", F.col("c_custkey") + 1), hits, "user_id", "event_id")


@query("presence_gap", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def presence_gap(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", "source").join(read(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


_NORM = "trim(regexp_replace(regexp_replace(lower({0}), '^\\s*(the|a|an)\\s+', ''), '[^a-z0-9]+', ' ', 'g'))"


@query("registry_ambiguity", f"""WITH r AS (SELECT {_NORM.format('p_name')} AS k, p_brand AS id FROM part), i AS (SELECT k, min(id) AS id, min(id) <> max(id) AS many FROM r GROUP BY k),
  n AS (SELECT p_partkey, {_NORM.format("'The ' || upper(p_name) || CASE WHEN p_partkey % 9 = 0 THEN ' x' ELSE '' END")} AS k FROM part)
  SELECT p_partkey, CASE WHEN i.k IS NULL THEN 'no-match' WHEN many THEN 'ambiguous' ELSE 'match' END AS status, CASE WHEN NOT many THEN id END AS match_id FROM n LEFT JOIN i USING (k)""")
def registry_ambiguity(spark, sf_dir):
    norm = ident.norm_entity
    part = read(spark, sf_dir, "part")
    reg = part.select(norm(F.col("p_name")).alias("reg"), F.col("p_brand").alias("id"))
    names = part.select("p_partkey", norm(F.expr("concat('The ', upper(p_name), CASE WHEN p_partkey % 9 = 0 THEN ' x' ELSE '' END)")).alias("name"))
    return rel.lookup_unique(names, "name", reg, "reg", "id").select("p_partkey", "status", "match_id")


# Text --------------------------------------------------------------------------------------------------------------

_WS = r"trim(regexp_replace(regexp_replace(regexp_replace({0}, '[ \t]+', ' ', 'g'), '[^\S\n]+(\n|$)', '\1', 'g'), '\n[ \t]*\n[ \t]*(?:\n[ \t]*)+', chr(10) || chr(10), 'g'), E' \n\t\r')"
_HY = r"regexp_replace(replace({0}, 'tion ', E'tio-\n  n'), '([\p{{L}}\p{{N}}_])-\n([a-z])', '\1\2', 'g')"
_DIRTY = "concat('  ', replace(replace(text, 'the ', concat('th-', chr(10), 'e  ')), '. ', concat('.', chr(9), chr(10), ' ', chr(10), chr(10))), ' ')"


@query("clean_text", rf"WITH d AS (SELECT doc_id, {_DIRTY} AS t FROM documents), h AS (SELECT doc_id, regexp_replace(t, '([\p{{L}}\p{{N}}_])-\n([a-z])', '\1\2', 'g') AS t FROM d) SELECT doc_id, {_WS.format('t')} AS text FROM h")
def clean_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").selectExpr("doc_id", f"{_DIRTY} AS t").select("doc_id", text.clean_text(F.col("t")).alias("text"))


@query("normalize_ws", rf"WITH d AS (SELECT doc_id, {_DIRTY} AS t FROM documents) SELECT doc_id, {_WS.format('t')} AS text FROM d")
def normalize_ws(spark, sf_dir):
    return read(spark, sf_dir, "documents").selectExpr("doc_id", f"{_DIRTY} AS t").select("doc_id", text.normalize_ws(F.col("t")).alias("text"))


_RATIOS = r"""WITH w AS (SELECT doc_id, lang, text, list_filter(regexp_extract_all(text, '[A-Za-z]+'), lambda x: length(x) >= 2) AS w FROM documents),
  r AS (SELECT doc_id, lang, CASE WHEN len(w) = 0 THEN 1.0 ELSE len(list_filter(w, lambda x: length(x) <= 20 AND regexp_matches(lower(x), '[aeiou]') AND NOT regexp_matches(lower(x), '[^aeiou]{5}'))) / len(w) END::DOUBLE AS word_ratio,
  CASE WHEN length(text) = 0 THEN 0.0 ELSE length(regexp_replace(text, '[\p{L}\p{N} \t\n.,;:''"()\-&/$%§#’“”]', '', 'g')) / length(text) END::DOUBLE AS junk_ratio FROM w)"""
_TIER = "CASE WHEN word_ratio < 0.70 OR junk_ratio > 0.15 THEN 'needs-review' WHEN word_ratio >= 0.90 AND junk_ratio <= 0.05 THEN 'clean' ELSE 'minor-noise' END"


def _ratios(spark, sf_dir):
    t = F.col("text")
    return read(spark, sf_dir, "documents").select("doc_id", "lang", text.word_ratio(t).alias("word_ratio"), text.junk_ratio(t).alias("junk_ratio"))


def _tiered(d):
    return text.tier(F.lit(True), F.lit(False), F.lit(0), d["word_ratio"], d["junk_ratio"], F.lit(False)).alias("tier")


@query("text_ratios", f"{_RATIOS} SELECT doc_id, round(word_ratio, 4) AS word_ratio, round(junk_ratio, 4) AS junk_ratio, {_TIER} AS tier FROM r")
def text_ratios(spark, sf_dir):
    d = _ratios(spark, sf_dir)
    return d.select("doc_id", F.round("word_ratio", 4).alias("word_ratio"), F.round("junk_ratio", 4).alias("junk_ratio"), _tiered(d))


@query("quality_tier", f"{_RATIOS} SELECT lang, {_TIER} AS tier, count(*)::BIGINT AS n FROM r GROUP BY ALL")
def quality_tier(spark, sf_dir):
    d = _ratios(spark, sf_dir)
    return d.select("lang", _tiered(d)).groupBy("lang", "tier").agg(F.count("*").alias("n"))


@query("file_marks", rf"""WITH d AS (SELECT p_partkey, {LINES} AS line FROM part), s AS (SELECT *, trim(regexp_replace(trim(line), '^[\[\]()]+|[\[\]()]+$', '', 'g')) AS s FROM d)
  SELECT p_partkey, line, s <> '' AND length(s) <= 8 AND regexp_matches(s, '\d') AND NOT regexp_matches(s, '(?i)^\(?[a-z0-9]{{1,3}}\)?[.)]?$') AND NOT starts_with(s, '§')
  AND (regexp_matches(s, '^\d{{1,3}}-\d{{1,3}}$') OR regexp_matches(s, '(?i)^[a-z]{{1,3}}[ \-]\d{{1,3}}[ \-]?[&\w]{{0,2}}$')) AS is_mark FROM s""")
def file_marks(spark, sf_dir):
    d = read(spark, sf_dir, "part").selectExpr("p_partkey", f"{LINES} AS line")
    return d.select("p_partkey", "line", text.is_file_mark(F.col("line")).alias("is_mark"))


@query("extract_date", """WITH d AS (SELECT o_orderkey, o_orderkey % 6 AS k, 1 + o_custkey % 33 AS day, 1 + o_custkey % 31 AS d8, 1970 + o_orderkey % 3 AS y FROM orders)
  SELECT o_orderkey, CASE k WHEN 0 THEN CASE WHEN y = 1971 AND day <= 31 THEN '1971-03-' || lpad(CAST(day AS VARCHAR), 2, '0') END
  WHEN 1 THEN '1971-08-' || lpad(CAST(d8 AS VARCHAR), 2, '0') WHEN 2 THEN '1971-02-31' WHEN 4 THEN '1971-01-02' END AS date_signed FROM d""")
def extract_date(spark, sf_dir):
    d = read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{DATES} AS t")
    return d.select("o_orderkey", text.extract_date(F.split("t", "\n"), F.lit(1971)).alias("date_signed"))


_LEX = ["steel", "blue", "green", "small", "order", "city", "bronx", "covid", "modernize", "policy"]


@query("lexicon_gate", f"""WITH w AS (SELECT DISTINCT unnest(string_split(p_name || ' ' || p_type || 'S cities XIV ordered', ' ')) AS w FROM part),
  f AS (SELECT w, unnest([lower(w), CASE WHEN lower(w) LIKE '%ies' AND length(w) >= 5 THEN left(lower(w), length(w) - 3) || 'y' END, CASE WHEN lower(w) LIKE '%es' AND length(w) >= 4 THEN left(lower(w), length(w) - 2) END,
   CASE WHEN lower(w) LIKE '%s' AND length(w) >= 3 THEN left(lower(w), length(w) - 1) END, CASE WHEN lower(w) LIKE '%ing' AND length(w) >= 5 THEN left(lower(w), length(w) - 3) END,
   CASE WHEN lower(w) LIKE '%ing' AND length(w) >= 5 THEN left(lower(w), length(w) - 3) || 'e' END, CASE WHEN lower(w) LIKE '%ed' AND length(w) >= 4 THEN left(lower(w), length(w) - 2) END,
   CASE WHEN lower(w) LIKE '%ed' AND length(w) >= 4 THEN left(lower(w), length(w) - 2) || 'e' END, CASE WHEN lower(w) LIKE '%ation' AND length(w) >= 7 THEN left(lower(w), length(w) - 5) || 'ate' END,
   CASE WHEN lower(w) LIKE '%ations' AND length(w) >= 8 THEN left(lower(w), length(w) - 6) || 'ate' END]) AS f FROM w)
  SELECT w AS word, bool_or(coalesce(regexp_matches(w, '^[A-Za-z]+$') AND (f IN ({", ".join(f"'{x}'" for x in _LEX)}) OR regexp_matches(lower(w), '^m{{0,4}}(cm|cd|d?c{{0,3}})(xc|xl|l?x{{0,3}})(ix|iv|v?i{{0,3}})$')), false)) AS known FROM f GROUP BY w""")
def lexicon_gate(spark, sf_dir):
    words = read(spark, sf_dir, "part").select(F.explode(F.split(F.expr("concat(p_name, ' ', p_type, 'S cities XIV ordered')"), " ")).alias("word")).distinct()
    return text.recognized(words, "word", spark.createDataFrame([(w,) for w in _LEX], "word string"))


_HEAD = """CASE o_orderkey % 6 WHEN 0 THEN 'RXECUTIVE ORDER NO. ' || o_orderkey WHEN 1 THEN 'operce oF THE MAYOR' WHEN 2 THEN 'THE CITY 0F NEW YORK'
  WHEN 3 THEN 'WHEREAS, the agency' WHEN 4 THEN 'VOTER ASSISTANCE PROGRAM' ELSE 'OFFICE OF THE MAY0R' END"""


@query("anchor_label", f"""SELECT o_orderkey, {_HEAD} AS line, CASE o_orderkey % 6 WHEN 0 THEN 'executive-order' WHEN 1 THEN 'office-of-the-mayor' WHEN 2 THEN 'city-of-new-york' WHEN 5 THEN 'office-of-the-mayor' END AS anchor FROM orders""")
def anchor_label(spark, sf_dir):
    d = read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_HEAD} AS line")
    return text.label_lines(d).select("o_orderkey", "line", "anchor")


@query("extract_title", """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 3 THEN NULL WHEN 4 THEN 'VOTER ASSISTANCE PROGRAM' ELSE upper('program of ' || o_orderpriority) END AS title FROM orders""")
def extract_title(spark, sf_dir):
    d = read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"explode(array({_HEAD}, 'April 1, 1974', upper(concat('program of ', o_orderpriority)), 'By virtue of')) AS line", "monotonically_increasing_id() AS seq")
    rows = text.label_lines(d).groupBy("o_orderkey").agg(F.array_sort(F.collect_list(F.struct("seq", "line", "anchor"))).alias("lines"))
    return rows.select("o_orderkey", text.title_candidate(F.col("lines")).alias("title"))


# Citation graph ----------------------------------------------------------------------------------------------------

_ORD = f"SELECT o_orderkey, o_custkey, {CORPUS} FROM orders"
_ID = _MINT.format(y="year", n="number", e="is_emergency")
_DOCS = f"""o AS ({_ORD}), m AS (SELECT *, {_ID} AS eo_id FROM o), docs AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY eo_id ORDER BY o_orderkey) = 1)"""
_CITED = f"""WITH {_DOCS}, c AS (SELECT eo_id AS actor, o_orderkey % 7 AS k, o_custkey % 300 AS n, 1990 + o_custkey % 20 AS y, is_emergency FROM docs WHERE o_orderkey % 7 < 6),
  t AS (SELECT *, CASE k WHEN 0 THEN 'revoked' WHEN 1 THEN 'amended' WHEN 2 THEN 'extended' WHEN 3 THEN 'repealed' WHEN 4 THEN 'superseded' ELSE 'rescinded' END AS verb, k = 3 AS partial,
   CASE WHEN k >= 4 THEN 'EO-' || CAST(n AS VARCHAR) WHEN k = 2 THEN CAST(y AS VARCHAR) || '-EEO-' || CAST(n AS VARCHAR) ELSE CAST(y AS VARCHAR) || '-EO-' || {_PAD.format('CAST(n AS VARCHAR)')} END AS target FROM c),
  r AS (SELECT actor, target, verb, partial, CASE WHEN k = 2 THEN 'extension' WHEN k = 4 THEN 'no-year' WHEN k = 5 THEN 'implausible-year' WHEN target = actor THEN 'self'
   WHEN target NOT IN (SELECT eo_id FROM docs) THEN 'not-in-corpus' ELSE 'edge' END AS outcome FROM t)"""
_STAMPS = """, h AS (SELECT CAST(1990 + o_custkey % 20 AS VARCHAR) || '-EO-' || CASE WHEN length(CAST(o_custkey % 300 AS VARCHAR)) >= 3 THEN CAST(o_custkey % 300 AS VARCHAR) ELSE lpad(CAST(o_custkey % 300 AS VARCHAR), 3, '0') END AS actor, eo_id AS target FROM docs WHERE o_orderkey % 3 = 0),
  x AS (SELECT actor, target, 'amended' AS verb, CASE WHEN actor IN (SELECT eo_id FROM docs) THEN 'edge' ELSE 'not-in-corpus' END AS outcome FROM h WHERE actor <> target)"""
_EDGES = """, e AS (SELECT DISTINCT actor, target, verb, 'body-citation' AS source, partial FROM r WHERE outcome = 'edge' UNION ALL SELECT DISTINCT actor, target, verb, 'header-xref', false FROM x WHERE outcome = 'edge')"""


def corpus(spark, sf_dir) -> DataFrame:
    """The orders table as a corpus: eo_id, is_emergency, full_text, dropped_header."""
    d = read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "1990 + o_orderkey % 20 AS year", "CAST(o_orderkey % 300 AS STRING) AS number", "o_orderkey % 5 = 0 AS is_emergency",
        f"{BODIES} AS full_text", f"{HEADERS} AS dropped_header",
    )
    d = d.withColumn("eo_id", ident.mint_id(F.col("year"), F.col("number"), F.col("is_emergency"))).withColumn("_z", F.lit(0))
    return rel.latest(d, ["eo_id"], "_z", "o_orderkey").select("eo_id", "is_emergency", "full_text", "dropped_header")


@query("body_edges", f"{_CITED} SELECT actor, target, verb, partial FROM r WHERE outcome = 'edge'")
def body_edges(spark, sf_dir):
    return graph.body_citations(corpus(spark, sf_dir)).filter("outcome = 'edge'").select("actor", "target", "verb", "partial")


_CLAUSE = """CASE l_linenumber % 4 WHEN 0 THEN '§ 1. Executive Order No. ' || n || ', dated March 7, ' || y || ', is hereby REVOKED. '
  WHEN 1 THEN '§ 2. Section 4 of Executive Order ' || n || ' of ' || y || ' and Executive Order ' || m || ' of ' || y || ' are amended. '
  WHEN 2 THEN '§ 3. Emergency Executive Order ' || n || ' of ' || y || ' is extended. ' ELSE '§ 4. Executive Order ' || n || ' is repealed. ' END"""


@query("long_order_citations", f"""WITH {_DOCS}, l AS (SELECT 'S' || l_suppkey::VARCHAR AS actor, l_linenumber % 4 AS k, (l_partkey % 300)::VARCHAR AS n, (l_partkey % 300 + 1)::VARCHAR AS m, (1990 + l_partkey % 20)::VARCHAR AS y FROM lineitem),
  c AS (SELECT actor, 'revoked' AS verb, false AS partial, n, y FROM l WHERE k = 0 UNION ALL SELECT actor, 'amended', true, n, y FROM l WHERE k = 1 UNION ALL SELECT actor, 'amended', false, m, y FROM l WHERE k = 1
   UNION ALL SELECT actor, 'extended', false, n, y FROM l WHERE k = 2 UNION ALL SELECT actor, 'repealed', false, n, NULL FROM l WHERE k = 3),
  t AS (SELECT *, CASE WHEN y IS NULL THEN 'EO-' || n WHEN verb = 'extended' THEN y || '-EEO-' || n ELSE y || '-EO-' || {_PAD.format('n')} END AS target FROM c)
  SELECT actor, verb, partial, target, CASE WHEN verb = 'extended' THEN 'extension' WHEN y IS NULL THEN 'no-year' WHEN target IN (SELECT eo_id FROM docs) THEN 'edge' ELSE 'not-in-corpus' END AS outcome, count(*)::BIGINT AS n
  FROM t GROUP BY ALL""")
def long_order_citations(spark, sf_dir):
    """A supplier's items as the clauses of one long order."""
    items = read(spark, sf_dir, "lineitem").selectExpr(
        "concat('S', l_suppkey) AS eo_id", "l_orderkey", "l_linenumber", "CAST(l_partkey % 300 AS STRING) AS n", "CAST(l_partkey % 300 + 1 AS STRING) AS m", "CAST(1990 + l_partkey % 20 AS STRING) AS y"
    ).selectExpr("eo_id", "l_orderkey", "l_linenumber", f"{_CLAUSE} AS clause")
    clauses = F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", "clause")))
    docs = items.groupBy("eo_id").agg(F.array_join(F.transform(clauses, lambda c: c["clause"]), "").alias("full_text"))
    rows = graph.body_citations(docs, corpus(spark, sf_dir))
    return rows.groupBy("actor", "verb", "partial", "target", "outcome").agg(F.count("*").alias("n"))


@query("dangles", f"{_CITED} SELECT outcome AS reason, verb, count(*)::BIGINT AS n, count(DISTINCT target)::BIGINT AS targets FROM r WHERE outcome NOT IN ('edge', 'self') GROUP BY ALL")
def dangles(spark, sf_dir):
    d = graph.body_citations(corpus(spark, sf_dir)).filter("outcome NOT IN ('edge', 'self')")
    return d.groupBy(F.col("outcome").alias("reason"), "verb").agg(F.count("*").alias("n"), F.countDistinct("target").alias("targets"))


@query("xref_edges", f"{_CITED}{_STAMPS} SELECT actor, target, verb, outcome FROM x")
def xref_edges(spark, sf_dir):
    return graph.header_citations(corpus(spark, sf_dir)).select("actor", "target", "verb", "outcome")


@query("in_effect", f"""{_CITED}{_STAMPS}{_EDGES}, s AS (SELECT actor, string_agg(DISTINCT target, ',' ORDER BY target) AS supersedes FROM e GROUP BY 1),
  b AS (SELECT target, string_agg(DISTINCT actor, ',' ORDER BY actor) AS superseded_by, bool_or(verb <> 'amended' AND NOT partial) AS gone FROM e GROUP BY 1)
  SELECT eo_id, coalesce(supersedes, '') AS supersedes, coalesce(superseded_by, '') AS superseded_by, CASE WHEN gone AND NOT is_emergency THEN false END AS in_effect
  FROM docs LEFT JOIN s ON eo_id = s.actor LEFT JOIN b ON eo_id = b.target""")
def in_effect(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    d = graph.annotate(docs, graph.edges(docs))
    return d.select("eo_id", F.array_join("supersedes", ",").alias("supersedes"), F.array_join("superseded_by", ",").alias("superseded_by"), "in_effect")


@query("verb_source_crosstab", f"""{_CITED}{_STAMPS}{_EDGES} SELECT coalesce(verb, 'total') AS verb, count(*) FILTER (source = 'body-citation')::BIGINT AS body, count(*) FILTER (source = 'header-xref')::BIGINT AS header, count(*)::BIGINT AS n
  FROM e GROUP BY ROLLUP (verb)""")
def verb_source_crosstab(spark, sf_dir):
    d = graph.edges(corpus(spark, sf_dir)).rollup("verb").agg(
        F.count_if(F.col("source") == "body-citation").alias("body"), F.count_if(F.col("source") == "header-xref").alias("header"), F.count("*").alias("n")
    )
    return d.withColumn("verb", F.coalesce("verb", F.lit("total")))


@query("entities", """SELECT p_partkey::VARCHAR AS eo_id, 'Office of ' || p_brand || ' ' || p_name AS raw_name FROM part WHERE p_partkey % 4 <> 0""")
def entities(spark, sf_dir):
    d = read(spark, sf_dir, "part").selectExpr("CAST(p_partkey AS STRING) AS eo_id", "p_partkey % 4 = 0 AS is_emergency",
        "concat('There is hereby established, within the office, the Office of ', p_brand, ' ', p_name, ' which shall report.') AS full_text")
    return graph.established_entities(d)


# Aggregates, samples, sources --------------------------------------------------------------------------------------


@query("status_counts", """SELECT event_type, count(*)::BIGINT AS n, count(*) FILTER (value > 50)::BIGINT AS high, count(DISTINCT user_id)::BIGINT AS users, min(event_id) AS first_id FROM events GROUP BY 1""")
def status_counts(spark, sf_dir):
    d = read(spark, sf_dir, "events")
    return d.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("high"), F.countDistinct("user_id").alias("users"), F.min("event_id").alias("first_id"))


@query("stratified_sample", """WITH e AS (SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) <= 10), h AS (SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25)
  SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM h) THEN 'heavy' ELSE 'per-lang' END AS label FROM (SELECT doc_id FROM e UNION SELECT doc_id FROM h)""")
def stratified_sample(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    heavy = d.orderBy(F.desc("n_chars"), "doc_id").limit(25)
    return rel.first_label([("heavy", heavy), ("per-lang", rel.top_by_group(d, "lang", [F.desc("n_chars"), F.col("doc_id")], 10))], "doc_id")


@query("first_pdf_href", """WITH d AS (SELECT page_id, regexp_replace(html, '<!--.*?-->', '', 'gs') || CASE WHEN page_id % 2 = 0 THEN '<a href=" executive-orders/' || CAST(page_id AS VARCHAR) || '.PDF?x ">' ELSE '' END AS h FROM pages),
  a AS (SELECT page_id, list_filter(list_transform(regexp_extract_all(h, '(?i)<a\\s[^>]*?href="([^"]*)"', 1), lambda x: trim(x)), lambda x: regexp_matches(x, '(?i)executive-orders/.*\\.pdf(?:[?#].*)?$'))[1] AS u FROM d)
  SELECT page_id, CASE WHEN u LIKE 'http%' THEN u WHEN u LIKE '/%' THEN 'https://www.nyc.gov' || u ELSE 'https://www.nyc.gov/' || u END AS pdf_url FROM a""")
def first_pdf_href(spark, sf_dir):
    d = read(spark, sf_dir, "pages").select("page_id", F.expr("""concat(html, CASE WHEN page_id % 2 = 0 THEN concat('<a href=" executive-orders/', page_id, '.PDF?x ">') ELSE '' END)""").alias("h"))
    return d.select("page_id", ident.first_pdf_href(F.col("h")).alias("pdf_url"))


@query("json_props", "SELECT event_id, array_to_string(list_sort(json_keys(props)), ',') AS keys FROM events")
def json_props(spark, sf_dir):
    d = read(spark, sf_dir, "events").select("event_id", F.json_object_keys("props").alias("k"))
    return d.select("event_id", F.array_join(F.array_sort("k"), ",").alias("keys"))


@query("probe_class", """WITH d AS (SELECT doc_id, n_chars, doc_id % 40 AS pages FROM documents), c AS (SELECT *, CASE WHEN pages = 0 THEN 'error' WHEN n_chars / pages > 100 THEN 'text' ELSE 'scanned' END AS class FROM d)
  SELECT class, count(*)::BIGINT AS n, sum(n_chars)::BIGINT AS chars FROM c GROUP BY 1""")
def probe_class(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("n_chars", (F.col("doc_id") % 40).alias("pages"))
    return d.groupBy(probe(F.col("pages"), F.col("n_chars")).alias("class")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
