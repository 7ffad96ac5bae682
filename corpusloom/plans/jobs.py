"""Queries of the jobs over the driver's tables, with their SQL. Inputs are derived from real columns by SQL that both sides share."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ident, lexicon
from ..jobs import corpus as build
from ..jobs import harvest, integrate, reports
from ..operators import cleaning, graph
from ..sources import tables
from .registry import CREATORS, TERMS, TITLES, URLS, _CASE, _PAD, query, read


def _orders(spark, sf_dir, *columns):
    return read(spark, sf_dir, "orders").selectExpr(*columns)


# Sources -----------------------------------------------------------------------------------------------------------


@query("search_url", """SELECT DISTINCT year(o_orderdate)::INT AS year, 'https://www.nyc.gov/bin/nyc/articlesearch.json?types=executive-orders&fromDate=' || year(o_orderdate)::VARCHAR
  || '-01-01&toDate=' || year(o_orderdate)::VARCHAR || '-12-31&pageSize=100&currentPage=' || (o_orderkey % 5 + 1)::BIGINT::VARCHAR AS url FROM orders""")
def search_url(spark, sf_dir):
    d = _orders(spark, sf_dir, "year(o_orderdate) AS year", "CAST(o_orderkey % 5 + 1 AS BIGINT) AS page").distinct()
    day = lambda s: F.concat(F.col("year").cast("string"), F.lit(s))
    return d.select("year", ident.search_url(day("-01-01"), day("-12-31"), F.lit(100), F.col("page")).alias("url"))


_RESULTS = f"o_orderkey, {TITLES} AS t, CASE WHEN o_orderkey % 4 = 0 THEN 'soon' ELSE {{d}} END AS articleDate, CASE WHEN o_orderkey % 3 = 0 THEN '/news/' || CAST(o_orderkey AS STRING) ELSE 'news/' || CAST(o_orderkey AS STRING) END AS link"


@query("feed_entries", f"""WITH d AS (SELECT {_RESULTS.format(d="strftime(o_orderdate, '%B %-d, %Y')")}, o_orderdate FROM orders)
  SELECT trim(t) AS title, nullif(regexp_extract(t, '(?i)order\\s+(?:no\\.?\\s*)?(\\d+(?:\\.\\d+)?)', 1), '') AS number, lower(trim(t)) LIKE 'emergency%' AS is_emergency,
  CASE WHEN o_orderkey % 4 = 0 THEN 2031 ELSE year(o_orderdate) END::INT AS year, CASE WHEN o_orderkey % 4 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date_signed,
  'https://www.nyc.gov/news/' || o_orderkey::VARCHAR AS article_url FROM d WHERE lower(t) LIKE '%executive order%'""")
def feed_entries(spark, sf_dir):
    d = _orders(
        spark, sf_dir, "o_orderkey", f"{TITLES} AS title", "CASE WHEN o_orderkey % 4 = 0 THEN 'soon' ELSE date_format(o_orderdate, 'MMMM d, yyyy') END AS articleDate",
        "CASE WHEN o_orderkey % 3 = 0 THEN '/news/' || CAST(o_orderkey AS STRING) ELSE 'news/' || CAST(o_orderkey AS STRING) END AS link",
    )
    pages = d.groupBy(F.lit(1).alias("page"), (F.col("o_orderkey") % 50).alias("k")).agg(F.collect_list(F.struct("link", "title", "articleDate")).alias("results"))
    return tables.feed_entries(tables.feed_results(pages), F.lit(2031))


_CAP_SQL = f"""c AS (SELECT o_orderkey, {URLS} AS original, o_orderdate, CASE WHEN o_orderkey % 4 = 3 THEN 'text/html' ELSE 'application/pdf' END AS mimetype, CASE WHEN o_orderkey % 7 = 6 THEN 404 ELSE 200 END AS statuscode FROM orders)"""


def _captures(spark, sf_dir):
    return _orders(
        spark, sf_dir, "CAST(o_orderkey AS STRING) AS urlkey", "CAST(o_orderdate AS TIMESTAMP) AS timestamp", f"{URLS} AS original", "CASE WHEN o_orderkey % 4 = 3 THEN 'text/html' ELSE 'application/pdf' END AS mimetype",
        "CASE WHEN o_orderkey % 7 = 6 THEN 404 ELSE 200 END AS statuscode", "CAST(o_orderkey AS STRING) AS digest", "CAST(o_custkey AS BIGINT) AS length",
    )


@query("archive_scan", f"""WITH {_CAP_SQL} SELECT original, strftime(o_orderdate, '%Y-%m-%d') AS day FROM c
  WHERE original LIKE 'http://www1.nyc.gov/html/records/%' AND mimetype = 'application/pdf' AND statuscode = 200 AND year(o_orderdate) BETWEEN 1993 AND 1996""")
def archive_scan(spark, sf_dir):
    found = tables.captures(_captures(spark, sf_dir), "nyc.gov/html/records/", 1993, 1996)
    return found.select("original", F.date_format("timestamp", "yyyy-MM-dd").alias("day"))


_ADDRESS = """CASE o_orderkey % 5 WHEN 0 THEN 'HTTP://WWW' || CAST(o_orderkey % 4 AS {text}) || '.NYC.gov:80/html/Records/' || CAST(o_custkey AS {text}) || '.PDF' WHEN 1 THEN 'https://nyc.gov/html/records/' || CAST(o_custkey AS {text}) || '/?b=2&a=' || CAST(o_orderkey AS {text}) || '#top'
  WHEN 2 THEN 'http://www.nyc.gov/html/recordsets/' || CAST(o_custkey AS {text}) WHEN 3 THEN 'https://me@a.nyc.gov/html/records/' || CAST(o_custkey AS {text}) ELSE 'www1.nyc.gov./html/records/' END"""


@query("archive_keys", f"""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'gov,nyc)/html/records/' || o_custkey::VARCHAR || '.pdf' WHEN 1 THEN 'gov,nyc)/html/records/' || o_custkey::VARCHAR || '?a=' || o_orderkey::VARCHAR || '&b=2'
  WHEN 2 THEN 'gov,nyc)/html/recordsets/' || o_custkey::VARCHAR WHEN 3 THEN 'gov,nyc,a)/html/records/' || o_custkey::VARCHAR ELSE 'gov,nyc)/html/records' END AS urlkey FROM orders""")
def archive_keys(spark, sf_dir):
    return _orders(spark, sf_dir, "o_orderkey", f"{_ADDRESS.format(text='STRING')} AS u").select("o_orderkey", ident.url_key(F.col("u")).alias("urlkey"))


@query("archive_prefix", f"""SELECT {_ADDRESS.format(text='VARCHAR')} AS original, count(*)::BIGINT AS n FROM orders WHERE o_orderkey % 5 < 2 AND year(o_orderdate) >= 1994 GROUP BY 1""")
def archive_prefix(spark, sf_dir):
    rows = _orders(
        spark, sf_dir, "CAST(o_orderdate AS TIMESTAMP) AS timestamp", f"{_ADDRESS.format(text='STRING')} AS original", "'application/pdf' AS mimetype", "200 AS statuscode",
    ).withColumn("urlkey", ident.url_key(F.col("original")))
    return tables.captures(rows, "https://www.nyc.gov/html/records/", from_year=1994, keyed=True).groupBy("original").agg(F.count("*").alias("n"))


@query("archive_rows", f"""WITH {_CAP_SQL}, b AS (SELECT *, regexp_replace(regexp_extract(regexp_replace(regexp_replace(original, '[?#].*$', ''), '/+$', ''), '[^/]*$'), '(?i)\\.pdf$', '') AS s FROM c),
  m AS (SELECT *, '(?i)(\\d{{4}})[-_ ]?(EEO|EO)[-_ ]?(\\d+(?:\\.\\d+)?)' AS rx, regexp_extract(s, '(?i)(\\d{{4}})[-_ ]?(EEO|EO)[-_ ]?(\\d+(?:\\.\\d+)?)', 3) AS n FROM b)
  SELECT original, CASE WHEN regexp_matches(s, rx) THEN 'row' ELSE 'flagged' END AS fate, CASE WHEN regexp_matches(s, rx) THEN regexp_extract(s, '(?i)(\\d{{4}})[-_ ]?(EEO|EO)[-_ ]?(\\d+(?:\\.\\d+)?)', 1)
  || CASE WHEN upper(regexp_extract(s, '(?i)(\\d{{4}})[-_ ]?(EEO|EO)[-_ ]?(\\d+(?:\\.\\d+)?)', 2)) = 'EEO' THEN '-EEO-' || n ELSE '-EO-' || CASE WHEN regexp_matches(n, '^\\d+$') THEN {_PAD.format('n')} ELSE n END END END AS eo_id,
  'https://web.archive.org/web/' || strftime(o_orderdate, '%Y%m%d') || '000000/' || original AS wayback_url FROM m""")
def archive_rows(spark, sf_dir):
    rows, flagged = harvest.archive_rows(_captures(spark, sf_dir), ident.filename_identity, ident.ARCHIVE)
    good = rows.select("original", F.lit("row").alias("fate"), "eo_id", F.col("source_pdf_url").alias("wayback_url"))
    return good.unionByName(flagged.select(F.col("original_url").alias("original"), F.lit("flagged").alias("fate"), F.lit(None).cast("string").alias("eo_id"), "wayback_url"))


# Harvest -----------------------------------------------------------------------------------------------------------

_INDEX = """CAST(1990 + o_orderkey % 20 AS INT) AS year, CAST(o_orderkey AS STRING) AS number, o_orderkey % 5 = 0 AS is_emergency"""
_EID = f"CAST(1990 + o_orderkey % 20 AS VARCHAR) || CASE WHEN o_orderkey % 5 = 0 THEN '-EEO-' || o_orderkey::VARCHAR ELSE '-EO-' || {_PAD.format('o_orderkey::VARCHAR')} END"


def _entries(spark, sf_dir):
    d = _orders(spark, sf_dir, "o_orderkey", "o_custkey", "CAST(1990 + o_orderkey % 20 AS INT) AS year", "CAST(o_orderkey AS STRING) AS number", "o_orderkey % 5 = 0 AS is_emergency",
                "CASE WHEN o_orderkey % 6 = 1 THEN NULL ELSE 'https://h.example/' || CAST(o_orderkey AS STRING) || '.pdf' END AS source_pdf_url")
    none = F.lit(None).cast("string")
    return d.withColumns({"date_signed": none, "title": F.lit("t"), "article_url": F.lit("a")})


@query("process_entries", f"""SELECT {_EID} AS eo_id, o_orderkey % 6 <> 1 AS pdf_resolved, CASE WHEN o_orderkey % 6 = 1 THEN 'error' WHEN o_orderkey % 3 = 0 THEN 'cached' WHEN o_orderkey % 3 = 1 THEN 'downloaded' ELSE 'error' END AS download_status,
  CASE WHEN o_orderkey % 6 = 1 THEN 'pdf URL not resolved' WHEN o_orderkey % 3 = 2 THEN 'HTTP 500' END AS download_error,
  CASE WHEN o_orderkey % 6 <> 1 AND o_orderkey % 3 <> 2 THEN 'pdfs/' || (1990 + o_orderkey % 20)::INT::VARCHAR || '/' || {_EID} || '.pdf' END AS pdf_path FROM orders""")
def process_entries(spark, sf_dir):
    return _processed(spark, sf_dir).select("eo_id", "pdf_resolved", "download_status", "download_error", "pdf_path")


def _processed(spark, sf_dir):
    e = _entries(spark, sf_dir)
    done = e.filter("source_pdf_url IS NOT NULL").select(
        ident.mint_id(F.col("year"), F.col("number"), F.col("is_emergency")).alias("eo_id"), "source_pdf_url",
        F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'cached' WHEN 1 THEN 'downloaded' ELSE 'error' END").alias("status"), F.expr("CASE WHEN o_orderkey % 3 = 2 THEN 'HTTP 500' END").alias("error"),
    )
    return harvest.process_entries(e, done)


@query("harvest_counts", """SELECT count(*)::BIGINT AS enumerated, count(*) FILTER (o_orderkey % 6 <> 1)::BIGINT AS resolved, count(*) FILTER (o_orderkey % 6 <> 1 AND o_orderkey % 3 = 1)::BIGINT AS downloaded,
  count(*) FILTER (o_orderkey % 3 = 0)::BIGINT AS cached, count(*) FILTER (o_orderkey % 6 = 1 OR o_orderkey % 3 = 2)::BIGINT AS errors FROM orders""")
def harvest_counts(spark, sf_dir):
    return harvest.status_counts(_processed(spark, sf_dir))


@query("manifest_rows", f"""SELECT {_EID} AS eo_id, o_orderkey::VARCHAR AS number, '' AS article_url, o_orderkey % 6 <> 1 AS pdf_resolved, CASE WHEN o_orderkey % 4 = 0 THEN 'cached' ELSE 'skipped' END AS download_status FROM orders""")
def manifest_rows(spark, sf_dir):
    index = harvest.index_of(_index(spark, sf_dir))
    return harvest.manifest_of(index).select("eo_id", "number", "article_url", "pdf_resolved", "download_status")


def _index(spark, sf_dir):
    e = _entries(spark, sf_dir).withColumn("eo_id", ident.mint_id(F.col("year"), F.col("number"), F.col("is_emergency")))
    return e.withColumn("pdf_path", F.expr("CASE WHEN o_orderkey % 4 = 0 THEN 'pdfs/x.pdf' WHEN o_orderkey % 4 = 1 THEN '' END")).withColumn("source", F.lit(ident.LIVE)).drop("article_url")


_HELD = "o_custkey % 3 = 0"


@query("reconcile_paths", f"""SELECT {_EID} AS eo_id, CASE WHEN o_orderkey % 4 = 0 THEN 'pdfs/x.pdf' WHEN {_HELD} THEN 'pdfs/' || (1990 + o_orderkey % 20)::INT::VARCHAR || '/' || {_EID} || '.pdf' WHEN o_orderkey % 4 = 1 THEN '' END AS pdf_path,
  CASE WHEN o_orderkey % 4 = 0 OR {_HELD} THEN 'cached' ELSE 'skipped' END AS download_status FROM orders""")
def reconcile_paths(spark, sf_dir):
    index = _index(spark, sf_dir)
    rows = harvest.manifest_of(harvest.index_of(index))
    return harvest.reconcile_paths(rows, _files(index)).select("eo_id", "pdf_path", "download_status")


def _files(index):
    return index.filter(_HELD).select(ident.pdf_dest("pdfs", F.col("year"), F.col("eo_id")).alias("path"))


@query("gaps", f"SELECT {_EID} AS eo_id FROM orders WHERE NOT ({_HELD})")
def gaps(spark, sf_dir):
    index = _index(spark, sf_dir)
    return harvest.gaps(harvest.index_of(index), _files(index)).select("eo_id")


def _recover(spark, sf_dir):
    e = _entries(spark, sf_dir).withColumn("eo_id", ident.mint_id(F.col("year"), F.col("number"), F.col("is_emergency")))
    e = e.withColumn("number", F.expr("CASE WHEN o_orderkey % 6 = 1 AND o_custkey % 2 = 0 THEN NULL ELSE number END"))
    index = harvest.index_of(e.withColumns({"pdf_path": F.lit(None).cast("string"), "source": F.lit(ident.LIVE)}))
    hits = _orders(
        spark, sf_dir, "'k' AS urlkey", "CAST(o_orderdate AS TIMESTAMP) AS timestamp", "CASE WHEN o_orderkey % 2 = 0 THEN 'http://www1.nyc.gov/' || CAST(o_orderkey AS STRING) || '.pdf' ELSE 'https://www.nyc.gov/assets/home/downloads/pdf/executive-orders/' || CAST(1990 + o_orderkey % 20 AS STRING) || '/' || CAST(o_orderkey AS STRING) || '.pdf' END AS original",
        "CASE WHEN o_orderkey % 5 = 4 THEN 'text/html' ELSE 'application/pdf' END AS mimetype", "200 AS statuscode", "'d' AS digest", "CAST(1 AS BIGINT) AS length",
    )
    return harvest.recover(index, hits, spark.createDataFrame([], "path string"))[0]


_RECOVERY = """WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 1 THEN CASE WHEN o_custkey % 2 = 0 THEN 'no-candidate-url' ELSE 'no-snapshot' END
  WHEN o_orderkey % 5 = 4 THEN 'no-snapshot' ELSE 'would-recover' END AS status FROM orders)"""


@query("recovery_outcomes", f"{_RECOVERY.replace('SELECT o_orderkey,', f'SELECT {_EID} AS eo_id, o_orderkey, strftime(o_orderdate, ' + chr(39) + '%Y%m%d' + chr(39) + ') AS day,')} SELECT eo_id, status, CASE WHEN status = 'would-recover' THEN 'https://web.archive.org/web/' || day || '000000/' || CASE WHEN o_orderkey % 2 = 0 THEN 'http://www1.nyc.gov/' || o_orderkey::VARCHAR ELSE 'https://www.nyc.gov/assets/home/downloads/pdf/executive-orders/' || (1990 + o_orderkey % 20)::INT::VARCHAR || '/' || o_orderkey::VARCHAR END || '.pdf' END AS wayback_url FROM r")
def recovery_outcomes(spark, sf_dir):
    return _recover(spark, sf_dir).select("eo_id", "status", "wayback_url")


@query("recovery_counts", f"""{_RECOVERY} SELECT count(*)::BIGINT AS gaps, 0::BIGINT AS recovered, 0::BIGINT AS cached, count(*) FILTER (status = 'would-recover')::BIGINT AS would_recover,
  count(*) FILTER (status <> 'would-recover')::BIGINT AS unrecoverable, 0::BIGINT AS errors FROM r""")
def recovery_counts(spark, sf_dir):
    return harvest.recovery_counts(_recover(spark, sf_dir))


_REPEATS = (
    "CAST(1990 + o_custkey % 20 AS INT) AS year", "CAST(o_custkey AS {text}) AS number",
    "CASE WHEN o_orderkey % 3 > 0 THEN 'https://h.example/F-' || CAST(o_orderkey % 4 AS {text}) || '-' || CAST(o_custkey AS {text}) || '.pdf?v=1' END AS u",
    "'http://WWW1.nyc.gov:80/f-' || CAST(o_orderkey % 4 AS {text}) || '-' || CAST(o_custkey AS {text}) || '.PDF' AS original",
    "o_orderkey % 3 > 0 AND (o_custkey + o_orderkey % 4) % 2 = 0 AS archived",
)


@query("recovery_repeats", f"""WITH d AS (SELECT {', '.join(_REPEATS).format(text='VARCHAR')} FROM orders)
  SELECT year::VARCHAR || '-EO-' || {_PAD.format('number')} AS eo_id, u AS source_pdf_url, CASE WHEN archived THEN year::VARCHAR || '-EO-' || {_PAD.format('number')} || ' from ' || original END AS pdf_path,
  CASE WHEN archived THEN 'wayback-gap' ELSE 'live-nycgov' END AS source FROM d""")
def recovery_repeats(spark, sf_dir):
    """Many rows of one id, each recovered from its own address and none multiplied."""
    d = _orders(spark, sf_dir, *(c.format(text="STRING") for c in _REPEATS))
    none = F.lit(None).cast("string")
    index = d.select(
        ident.mint_id(F.col("year"), F.col("number"), F.lit(False)).alias("eo_id"), "number", "year", F.lit(False).alias("is_emergency"), none.alias("date_signed"), F.lit("t").alias("title"),
        F.col("u").alias("source_pdf_url"), none.alias("pdf_path"), F.lit(ident.LIVE).alias("source"),
    )
    hits = d.filter("archived").select(
        F.lit("k").alias("urlkey"), F.expr("TIMESTAMP '2020-01-01 00:00:00'").alias("timestamp"), "original", F.lit("application/pdf").alias("mimetype"), F.lit(200).alias("statuscode"),
        F.lit("d").alias("digest"), F.lit(1).cast("long").alias("length"),
    )
    outcomes = harvest.recover(index, hits, spark.createDataFrame([], "path string"))[0]
    said = F.when(F.col("status") == "would-recover", F.concat("eo_id", F.lit(" from "), F.regexp_extract("wayback_url", "http://.*$", 0)))
    done = outcomes.withColumn("pdf_path", said).withColumn("status", F.when(F.col("status") == "would-recover", "recovered").otherwise(F.col("status")))
    return harvest.apply_outcomes(index, done).select("eo_id", "source_pdf_url", "pdf_path", "source")


# Corpus ------------------------------------------------------------------------------------------------------------

_DISPATCH = """CASE WHEN doc_id % 9 = 0 THEN 'none' WHEN doc_id % 9 = 1 THEN 'unreadable' WHEN doc_id % 9 < 5 THEN CASE WHEN trim(coalesce(text, '')) = '' THEN 'unreadable' ELSE 'born-digital' END
  WHEN doc_id % 9 = 5 THEN 'ocr-failed' WHEN trim(coalesce(text, '')) = '' THEN 'ocr-failed' ELSE 'ocr' END"""


def _parsed(spark, sf_dir, ocr=True):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = F.concat(F.lit("p/"), F.col("doc_id").cast("string"))
    none = F.lit(None).cast("string")
    records = docs.select(
        F.concat(F.lit("2001-EO-"), F.col("doc_id").cast("string")).alias("eo_id"), F.col("doc_id").cast("string").alias("number"), (1970 + F.col("doc_id") % 64).cast("int").alias("year"),
        (F.col("doc_id") % 5 == 0).alias("is_emergency"), none.alias("date_signed"), F.lit("T").alias("title"), none.alias("source_pdf_url"), path.alias("pdf_path"), F.lit(ident.LIVE).alias("source"),
    )
    k = F.col("doc_id") % 9
    kind = F.when(k == 1, "error").when(k < 5, "text").otherwise("scanned")
    probes = docs.filter("doc_id % 9 <> 0").select(path.alias("path"), kind.alias("classification"), k.cast("int").alias("page_count"), "text")
    seen = docs.filter("doc_id % 9 > 4").select(path.alias("path"), "text", F.lit(7).alias("page_count"), F.when(k == 5, "ocr-failed").otherwise("ocr").alias("text_source"))
    return build.dispatch(records, probes, None, seen, ocr)


@query("parse_dispatch", f"""WITH d AS (SELECT doc_id, text, {_DISPATCH} AS text_source FROM documents) SELECT '2001-EO-' || doc_id::VARCHAR AS eo_id, text_source,
  CASE WHEN doc_id % 9 = 0 THEN NULL WHEN text_source = 'ocr' THEN 7 ELSE doc_id % 9 END::INT AS page_count, length(CASE WHEN text_source IN ('born-digital', 'ocr') THEN text ELSE '_No text available_' END)::BIGINT AS chars FROM d""")
def parse_dispatch(spark, sf_dir):
    return _parsed(spark, sf_dir).select("eo_id", "text_source", "page_count", F.length("body").cast("long").alias("chars"))


@query("text_source_counts", f"WITH d AS (SELECT {_DISPATCH} AS text_source FROM documents) SELECT text_source, count(*)::BIGINT AS n FROM d GROUP BY 1")
def text_source_counts(spark, sf_dir):
    return build.source_counts(_parsed(spark, sf_dir))


@query("enrich", f"""SELECT o_orderkey, {_CASE.format('1970 + o_orderkey % 64')} AS mayor, {_CASE.format('1970 + o_orderkey % 64')} AS administration,
  CASE WHEN 1970 + o_orderkey % 64 NOT BETWEEN 1974 AND 2029 THEN 'signing year past the last mayoral term on record' END AS admin_note, 0::INT AS links, true AS unknown FROM orders""")
def enrich(spark, sf_dir):
    d = build.enrich(_orders(spark, sf_dir, "o_orderkey", "1970 + o_orderkey % 64 AS year"), TERMS)
    return d.select("o_orderkey", "mayor", "administration", "admin_note", (F.size("supersedes") + F.size("superseded_by")).alias("links"), (F.col("in_effect").isNull() & F.col("establishes_entity").isNull()).alias("unknown"))


@query("corpus_manifest", """SELECT eo_id, year, text_source, CASE text_source WHEN 'born-digital' THEN 'text' WHEN 'none' THEN '' ELSE 'scanned' END AS classification, length(text)::INT AS char_count,
  CASE WHEN doc_id % 4 = 0 THEN '' ELSE (doc_id % 9)::VARCHAR END AS page_count, 'corpus/' || year::VARCHAR || '/' || eo_id || '.md' AS md_path FROM
  (SELECT *, (1990 + doc_id % 30)::INT AS year, doc_id::VARCHAR AS eo_id, ['born-digital', 'ocr', 'ocr-failed', 'ocr-skipped', 'none'][doc_id % 5 + 1] AS text_source FROM documents)""")
def corpus_manifest(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("eo_id"), (1990 + F.col("doc_id") % 30).cast("int").alias("year"), F.col("text").alias("full_text"),
        F.element_at(F.array(*map(F.lit, ("born-digital", "ocr", "ocr-failed", "ocr-skipped", "none"))), (F.col("doc_id") % 5 + 1).cast("int")).alias("text_source"),
        F.when(F.col("doc_id") % 4 != 0, F.col("doc_id") % 9).alias("page_count"),
    )
    return build.manifest(d)


_HEADS = """CASE o_orderkey % 8 WHEN 0 THEN 'x7' || chr(10) || 'RXECUTIVE ORDER NO. 5' || chr(10) || 'March 7, 1974' || chr(10) || chr(10) || 'VOTER ASSISTANCE PROGRAM' || chr(10) || 'nl-8' || chr(10) || 'By virtue  of the power '
  WHEN 1 THEN 'WHEREAS the law' || chr(10) || 'THE CITY OF NEW YORK' || chr(10) || 'says so' WHEN 2 THEN 'no header here' || chr(10) || '37-' || CAST(o_custkey % 90 + 10 AS STRING) || chr(10) || 'text'
  WHEN 3 THEN repeat('abc ', 300) || chr(10) || 'EXECUTIVE ORDER' || chr(10) || '3/9/74' WHEN 4 THEN 'OFFICE OF THE MAYOR' || chr(10) || 'CRAY OFFICE MATTERS' || chr(10) || 'Section 1'
  WHEN 5 THEN 'EXECUTIVE ORDER' || chr(10) || 'STORM WATER PERMITS' || chr(10) || 'PURSUANT to' WHEN 6 THEN '' ELSE 'EXECUTIVE ORDER' || chr(10) || 'kept as it is  ' END"""


def _cleaned(spark, sf_dir, *fields):
    d = _orders(spark, sf_dir, "CAST(o_orderkey AS STRING) AS eo_id", f"{_HEADS} AS body", "1974 AS year", "CASE WHEN o_orderkey % 8 = 5 AND o_custkey % 2 = 0 THEN 'Kept' END AS title", "CAST(NULL AS STRING) AS date_signed",
                "CASE WHEN o_orderkey % 8 = 7 THEN 'born-digital' ELSE 'ocr' END AS text_source")
    return cleaning.clean_records(d, lexicon.words(spark), fields=fields)


_CLEAN_SQL = """c AS (SELECT o_orderkey, o_custkey, (o_orderkey % 8)::INT AS k FROM orders), e AS (SELECT o_orderkey::VARCHAR AS eo_id, k,
  CASE k WHEN 0 THEN 'x7' ELSE '' END AS dropped_header, CASE k WHEN 0 THEN 'nl-8' WHEN 2 THEN '37-' || (o_custkey % 90 + 10)::VARCHAR ELSE '' END AS dropped_marks,
  CASE k WHEN 0 THEN 'VOTER ASSISTANCE PROGRAM' WHEN 5 THEN CASE WHEN o_custkey % 2 = 0 THEN 'Kept' ELSE 'STORM WATER PERMITS' END END AS title,
  CASE k WHEN 0 THEN '1974-03-07' WHEN 3 THEN '1974-03-09' END AS date_signed, CASE k WHEN 0 THEN 'executive-order' WHEN 4 THEN 'office-of-the-mayor' WHEN 5 THEN 'executive-order' WHEN 7 THEN 'executive-order' END AS anchor_label,
  CASE k WHEN 0 THEN 'minor-noise' WHEN 5 THEN 'clean' WHEN 7 THEN 'clean' ELSE 'needs-review' END AS text_quality,
  CASE k WHEN 1 THEN 'anchor-after-body-start' WHEN 2 THEN 'no-anchor-found' WHEN 3 THEN 'large-header-trim-skipped' WHEN 6 THEN 'no-anchor-found' WHEN 4 THEN 'title-uncertain' WHEN 7 THEN 'title-not-extracted' ELSE '' END AS first_flag FROM c)"""


@query("clean_record", f"WITH {_CLEAN_SQL} SELECT eo_id, dropped_header, dropped_marks, title, date_signed, anchor_label, CASE WHEN k = 0 THEN 'clean' ELSE text_quality END AS text_quality, CASE WHEN k = 0 THEN '' WHEN k = 5 THEN 'date-not-extracted' ELSE first_flag END AS first_flag FROM e")
def clean_record(spark, sf_dir):
    c = F.col("clean")
    first = F.regexp_replace(F.coalesce(F.try_element_at(c["flags"], F.lit(1)), F.lit("")), ":.*", "")
    d = _cleaned(spark, sf_dir, "dropped_header", "dropped_marks", "title", "date_signed", "anchor_label", "text_quality", "flags")
    return d.select("eo_id", c["dropped_header"].alias("dropped_header"), F.array_join(c["dropped_marks"], ",").alias("dropped_marks"), c["title"].alias("title"), c["date_signed"].alias("date_signed"),
                    c["anchor_label"].alias("anchor_label"), c["text_quality"].alias("text_quality"), first.alias("first_flag"))


@query("clean_counts", """SELECT count(*)::BIGINT AS records, count(*) FILTER (k IN (0, 5, 7))::BIGINT AS clean, 0::BIGINT AS minor_noise, count(*) FILTER (k NOT IN (0, 5, 7))::BIGINT AS needs_review,
  count(*) FILTER (k = 0 OR k = 5 AND o_custkey % 2 = 1)::BIGINT AS titles, count(*) FILTER (k IN (0, 3))::BIGINT AS dates, count(*) FILTER (k = 4)::BIGINT AS titles_held FROM (SELECT *, (o_orderkey % 8)::INT AS k FROM orders)""")
def clean_counts(spark, sf_dir):
    return reports.clean_counts(_cleaned(spark, sf_dir, "text_quality", "title_extracted", "date_extracted", "flags"))


_WORDS_SQL = "(VALUES " + ", ".join(f"('{w}')" for w in sorted({*lexicon.DOMAIN, *lexicon.ABBREVIATIONS, *lexicon.FALLBACK})) + ") AS w(word)"


@query("word_list", f"""SELECT word FROM (SELECT lower(unnest(string_split(p_name || ' ' || p_type || ' x1 ' || p_brand, ' '))) AS word FROM part UNION SELECT word FROM {_WORDS_SQL}) WHERE regexp_matches(word, '^[a-z]+$')""")
def word_list(spark, sf_dir):
    words = read(spark, sf_dir, "part").select(F.explode(F.split(F.expr("concat(p_name, ' ', p_type, ' x1 ', p_brand)"), " ")).alias("value"))
    return lexicon.frozen(words)


_PHRASES = """CASE o_orderkey % 6 WHEN 0 THEN 'STORM WATER PERMITS ' || o_orderpriority WHEN 1 THEN 'CONTRACT AND REVIEW OF' WHEN 2 THEN 'MARY' WHEN 3 THEN 'CITIES ' || 'AND AGENCIES XIV' WHEN 4 THEN 'THE CRAY OFFICE' ELSE 'OFFICE  ' || 'ORDER' END"""


@query("title_gate", f"""SELECT t AS title, o_orderkey % 6 IN (3, 5) OR (o_orderkey % 6 = 0 AND lower(regexp_replace(o_orderpriority, '[^A-Za-z]+', '', 'g')) IN (SELECT word FROM {_WORDS_SQL})) AS ok
  FROM (SELECT DISTINCT ON (t) t, o_orderkey, o_orderpriority FROM (SELECT *, {_PHRASES} AS t FROM orders))""")
def title_gate(spark, sf_dir):
    return lexicon.trusted(_orders(spark, sf_dir, f"{_PHRASES} AS t"), "t", lexicon.words(spark))


@query("paths", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN '/abs/' || o_orderkey::VARCHAR ELSE '/root/rel/' || o_orderkey::VARCHAR END AS resolved,
  CASE WHEN o_orderkey % 3 = 1 THEN '/abs/' || o_orderkey::VARCHAR WHEN o_orderkey % 3 = 2 THEN 'rel/' || o_orderkey::VARCHAR END AS relative,
  's/' || (1970 + o_orderkey % 60)::INT::VARCHAR || '/e--' || o_custkey::VARCHAR || '.pdf' AS dual, 's/volumes/' || o_custkey::VARCHAR || '.pdf' AS volume,
  CASE WHEN 1970 + o_orderkey % 60 BETWEEN 1974 AND 2001 THEN '1974-2001' WHEN 1970 + o_orderkey % 60 BETWEEN 2002 AND 2021 THEN '2002-2021' WHEN 1970 + o_orderkey % 60 BETWEEN 2022 AND 2026 THEN '2022-2026' ELSE 'other' END AS era FROM orders""")
def paths(spark, sf_dir):
    d = _orders(spark, sf_dir, "o_orderkey", "CAST(o_custkey AS STRING) AS c", "CAST(1970 + o_orderkey % 60 AS INT) AS y", "CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '/abs/' || CAST(o_orderkey AS STRING) ELSE 'rel/' || CAST(o_orderkey AS STRING) END AS p")
    at = ident.resolved(F.col("p"), "/root/")
    return d.select("o_orderkey", at.alias("resolved"), ident.relative(at, "/root").alias("relative"), ident.dual_dest("s", F.col("y"), F.lit("e"), F.col("c")).alias("dual"),
                    ident.volume_dest("s/", F.col("c")).alias("volume"), ident.era(F.col("y")).alias("era"))


@query("year_limit", "SELECT doc_id FROM documents WHERE doc_id % 30 = 7 ORDER BY doc_id LIMIT 5")
def year_limit(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 30).alias("year"))
    return build.select(d, 7, 5, "doc_id").select("doc_id")


# Second source -----------------------------------------------------------------------------------------------------

#: Orders as an inventory: one item an order, several of a key.
_INV = """CAST(o_orderkey AS STRING) AS id, CASE WHEN o_orderkey % 11 = 0 THEN 'Executive Orders and Memoranda' WHEN o_orderkey % 11 = 1 THEN 'Annual report' WHEN o_orderkey % 2 = 0 THEN 'EEO ' || CAST(o_custkey % 200 AS STRING) ELSE 'EO ' || CAST(o_custkey % 200 AS STRING) || '.' END AS t,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(1974 + o_custkey % 200 % 50 AS STRING) || '-01-02' END AS dp, CASE WHEN o_orderkey % 5 = 0 THEN 'Nobody; Ed Koch' ELSE '' END AS cr,
  CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE ' f' || CAST(o_orderkey AS STRING) || ', g' || CAST(o_custkey AS STRING) END AS fs, 'd' AS desc"""
_INV_SQL = f"""v AS (SELECT o_orderkey AS k, o_custkey, o_orderkey::VARCHAR AS gpp_id, CASE WHEN o_orderkey % 11 = 0 THEN 'volume' WHEN o_orderkey % 11 = 1 THEN CASE WHEN o_orderkey % 30 = 1 THEN 'rescued' ELSE 'unparsed' END ELSE 'order' END AS r,
  o_orderkey % 2 = 0 AS even, (o_custkey % 200)::VARCHAR AS n, CASE WHEN o_orderkey % 13 <> 0 THEN (1974 + o_custkey % 200 % 50)::INT END AS year, o_orderkey % 5 = 0 AS koch, o_orderkey % 17 <> 0 AS files FROM orders),
  i AS (SELECT *, CASE WHEN k % 19 = 3 THEN 'excluded' WHEN r = 'rescued' THEN 'order' ELSE r END AS route, coalesce(CASE WHEN koch THEN 'Koch' END, {_CASE.format('year')}) AS mayor, CASE WHEN r = 'rescued' THEN '77' WHEN r = 'order' THEN n END AS number,
  CASE WHEN r = 'rescued' THEN false ELSE r = 'order' AND even END AS is_emergency FROM v)"""


def _items(spark, sf_dir):
    inv = _orders(spark, sf_dir, *_split(_INV))
    out = integrate.items(inv, TERMS, CREATORS, {}, ())
    # the rescue and exclusion tables are short lists of ids; here they follow a rule, so they are applied as the operator does
    k = F.col("gpp_id").cast("long")
    rescued = (k % 11 == 1) & (k % 30 == 1)
    excluded = k % 19 == 3
    route = F.when(excluded, "excluded").when(rescued, "order").otherwise(F.col("route"))
    return out.withColumns({
        "rescued": rescued, "label": F.when(rescued, F.lit("77")).otherwise(F.col("label")), "number": F.when(rescued, F.lit("77")).otherwise(F.col("number")), "route": route,
    })


def _split(columns: str) -> list[str]:
    """Top-level expressions of a select list."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(columns):
        depth += (c == "(") - (c == ")")
        word = columns[i : i + 4].upper()
        depth += (word == "CASE") - (word[:3] == "END" and not columns[i - 1].isalnum() and not columns[i + 3 : i + 4].isalnum())
        if c == "," and not depth and columns[:i].count("'") % 2 == 0:
            out.append(columns[at:i].strip())
            at = i + 1
    return [*out, columns[at:].strip()]


@query("source_items", f"WITH {_INV_SQL} SELECT gpp_id, route, mayor, year, is_emergency, number, CASE WHEN files THEN 'f' || k::VARCHAR || ',g' || o_custkey::VARCHAR ELSE '' END AS filesets FROM i")
def source_items(spark, sf_dir):
    return _items(spark, sf_dir).select("gpp_id", "route", "mayor", "year", "is_emergency", "number", F.array_join("fileset_ids", ",").alias("filesets"))


_ORDERS_SQL = f"""{_INV_SQL}, o AS (SELECT mayor, is_emergency, number, first(year ORDER BY gpp_id COLLATE C) FILTER (year IS NOT NULL) AS year, string_agg(gpp_id, ',' ORDER BY gpp_id COLLATE C) AS gpp_ids FROM i WHERE route = 'order' GROUP BY ALL)"""


@query("source_orders", f"WITH {_ORDERS_SQL} SELECT * FROM o")
def source_orders(spark, sf_dir):
    d = integrate.orders(_items(spark, sf_dir))
    return d.select("mayor", "is_emergency", "number", "year", F.array_join("gpp_ids", ",").alias("gpp_ids"))


#: The corpus to match: customers as records.
_HAVE = "CASE WHEN c_custkey % 3 = 0 THEN 'Koch' WHEN c_custkey % 3 = 1 THEN 'Bloomberg' END"


def _have(spark, sf_dir):
    d = read(spark, sf_dir, "customer").selectExpr("c_custkey", f"{_HAVE} AS mayor", "c_custkey % 4 = 0 AS is_emergency", "lpad(CAST(c_custkey % 150 AS STRING), 4, '0') AS number", "'1981-EO-' || CAST(c_custkey AS STRING) AS eo_id",
                                                   "CASE WHEN c_custkey % 5 = 0 THEN 'p' WHEN c_custkey % 5 = 1 THEN '' END AS pdf_path")
    return d


_PLAN_SQL = f"""{_ORDERS_SQL}, h AS (SELECT {_HAVE} AS m, c_custkey % 4 = 0 AS e, (c_custkey % 150)::VARCHAR AS n, min('1981-EO-' || c_custkey::VARCHAR) AS first_id, count(*) AS ids, bool_or(c_custkey % 5 = 0) AS held,
   max(CASE WHEN c_custkey % 50 = 9 THEN '1981-EO-' || c_custkey::VARCHAR END) AS dummy FROM customer GROUP BY ALL),
  g AS (SELECT {_HAVE} AS m, c_custkey % 4 = 0 AS e, (c_custkey % 150)::VARCHAR AS n, min('1981-EO-' || c_custkey::VARCHAR) AS prior_id FROM customer WHERE c_custkey % 50 = 9 GROUP BY ALL),
  p AS (SELECT o.*, h.ids, g.prior_id, CASE WHEN g.prior_id IS NOT NULL THEN 'net-new' WHEN h.held THEN 'dual' WHEN h.ids IS NOT NULL THEN 'gap-closer-existing' WHEN o.mayor = 'de Blasio' AND NOT o.is_emergency AND o.number IN ('40', '41', '42') THEN 'gap-closer-mint' ELSE 'net-new' END AS disposition,
   coalesce(g.prior_id, h.first_id, CASE WHEN o.year IS NOT NULL THEN o.year::VARCHAR || CASE WHEN o.is_emergency THEN '-EEO-' || o.number ELSE '-EO-' || {_PAD.format('o.number')} END END) AS eo_id
   FROM o LEFT JOIN h ON o.mayor IS NOT DISTINCT FROM h.m AND o.is_emergency = h.e AND o.number = h.n LEFT JOIN g ON o.mayor IS NOT DISTINCT FROM g.m AND o.is_emergency = g.e AND o.number = g.n)"""
_MISSING = [("de Blasio", False, n) for n in ("40", "41", "42")]


def _plan(spark, sf_dir):
    have = _have(spark, sf_dir)
    ledger = have.filter("c_custkey % 50 = 9").select("eo_id", F.lit("net-new").alias("disposition"))
    return integrate.plan(_items(spark, sf_dir), have, ledger, _MISSING)


@query("integration_plan", f"WITH {_PLAN_SQL} SELECT mayor, is_emergency, number, disposition, eo_id, CASE WHEN prior_id IS NOT NULL THEN 0 ELSE coalesce(ids, 0) END::INT AS matched, prior_id IS NOT NULL AS already_integrated FROM p")
def integration_plan(spark, sf_dir):
    return _plan(spark, sf_dir).select("mayor", "is_emergency", "number", "disposition", "eo_id", F.size("corpus_eo_ids").alias("matched"), "already_integrated")


@query("disposition_counts", f"WITH {_PLAN_SQL} SELECT disposition, count(*)::BIGINT AS n FROM (SELECT disposition FROM p UNION ALL SELECT CASE route WHEN 'volume' THEN 'volume' ELSE 'excluded' END FROM i WHERE route <> 'order') GROUP BY 1")
def disposition_counts(spark, sf_dir):
    return integrate.disposition_counts(_plan(spark, sf_dir), _items(spark, sf_dir))


def _staged(spark, sf_dir):
    return _orders(spark, sf_dir, "'f' || CAST(o_orderkey AS STRING) AS fileset_id", "'/s/gpp-f' || CAST(o_orderkey AS STRING) || '.pdf' AS path", "o_custkey % 4 <> 0 AS valid").filter("fileset_id NOT LIKE '%7'")


_STAGED = "s AS (SELECT 'f' || o_orderkey::VARCHAR AS fs, o_custkey % 4 <> 0 AS ok FROM orders WHERE o_orderkey % 10 <> 7)"


@query("staging_summary", f"""WITH {_INV_SQL}, {_STAGED}, w AS (SELECT DISTINCT unnest(['f' || k::VARCHAR, 'g' || o_custkey::VARCHAR]) AS fs FROM i WHERE files AND route IN ('order', 'volume')),
  j AS (SELECT w.fs AS a, s.fs AS b, ok FROM w FULL JOIN s ON w.fs = s.fs)
  SELECT count(a)::BIGINT AS expected, count(*) FILTER (a IS NOT NULL AND ok)::BIGINT AS present, count(*) FILTER (b IS NULL)::BIGINT AS missing, count(*) FILTER (a IS NOT NULL AND NOT ok)::BIGINT AS corrupt,
  count(*) FILTER (a IS NULL)::BIGINT AS extra, false AS complete FROM j""")
def staging_summary(spark, sf_dir):
    parsed = _items(spark, sf_dir)
    return integrate.staging_summary(integrate.staging(integrate.orders(parsed), parsed, _staged(spark, sf_dir)))


_FILES_SQL = f"""{_PLAN_SQL}, {_STAGED}, fo AS (SELECT p.eo_id, p.disposition, p.year, i.gpp_id, unnest(['f' || k::VARCHAR, 'g' || o_custkey::VARCHAR]) AS fs, unnest([0, 1]) AS pos FROM p JOIN i ON i.route = 'order' AND i.files
   AND p.mayor IS NOT DISTINCT FROM i.mayor AND p.is_emergency = i.is_emergency AND p.number = i.number),
  fv AS (SELECT fo.*, coalesce(s.ok, false) AS ok FROM fo LEFT JOIN s ON fo.fs = s.fs),
  pr AS (SELECT eo_id, first(fs ORDER BY gpp_id COLLATE C, pos) AS primary_fs FROM fv WHERE ok AND disposition <> 'dual' AND eo_id IS NOT NULL GROUP BY 1)"""


@query("mint_rows", f"""WITH {_FILES_SQL} SELECT p.eo_id, p.year, p.is_emergency, 'https://a860-gpp.nyc.gov/downloads/' || primary_fs AS source_pdf_url, 'pdfs/' || CASE WHEN p.prior_id IS NOT NULL THEN '1981' ELSE p.year::VARCHAR END || '/' || p.eo_id || '.pdf' AS pdf_path
  FROM p JOIN pr ON p.eo_id = pr.eo_id WHERE p.disposition IN ('net-new', 'gap-closer-mint') AND NOT EXISTS (SELECT 1 FROM p q WHERE q.eo_id = p.eo_id AND (q.mayor IS DISTINCT FROM p.mayor))""")
def mint_rows(spark, sf_dir):
    planned = _plan(spark, sf_dir)
    one = planned.groupBy("eo_id").agg(F.count("*").alias("_n")).filter("_n = 1").select("eo_id")
    placed = integrate.placements(planned, _items(spark, sf_dir), _staged(spark, sf_dir), _have(spark, sf_dir))
    return integrate.mint_rows(planned, placed).join(one, "eo_id", "left_semi").select("eo_id", "year", "is_emergency", "source_pdf_url", "pdf_path")


@query("file_roles", f"""WITH {_FILES_SQL} SELECT role, count(*)::BIGINT AS n, count(*) FILTER (ok)::BIGINT AS staged FROM (SELECT CASE WHEN fv.disposition = 'dual' THEN 'dual' WHEN pr.primary_fs = fv.fs AND fv.ok THEN 'primary' ELSE 'secondary' END AS role, ok
   FROM fv LEFT JOIN pr ON fv.eo_id = pr.eo_id WHERE fv.eo_id IS NOT NULL AND fv.eo_id NOT IN (SELECT eo_id FROM p WHERE eo_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
   UNION ALL SELECT 'volume', coalesce(s.ok, false) FROM (SELECT unnest(['f' || k::VARCHAR, 'g' || o_custkey::VARCHAR]) AS fs FROM i WHERE route = 'volume' AND files) x LEFT JOIN s ON x.fs = s.fs) GROUP BY 1""")
def file_roles(spark, sf_dir):
    planned = _plan(spark, sf_dir)
    one = planned.filter("eo_id IS NOT NULL").groupBy("eo_id").agg(F.count("*").alias("_n")).filter("_n = 1").select("eo_id")
    placed = integrate.placements(planned.join(one, "eo_id", "left_semi"), _items(spark, sf_dir), _staged(spark, sf_dir), _have(spark, sf_dir))
    return placed.groupBy("role").agg(F.count("*").alias("n"), F.count_if(F.col("src").isNotNull()).alias("staged"))


@query("volume_manifest", f"""WITH {_INV_SQL}, {_STAGED} SELECT gpp_id, CASE WHEN year IS NOT NULL THEN year::VARCHAR || '-01-02' END AS date_published, CASE WHEN files AND coalesce(s.ok, false) THEN 'sources/volumes/f' || k::VARCHAR || '.pdf' ELSE '' END AS local_paths,
  files AND coalesce(s.ok, false) AS staged, CASE WHEN files THEN 2 ELSE 0 END::INT AS urls FROM i LEFT JOIN s ON s.fs = 'f' || i.k::VARCHAR WHERE route = 'volume'""")
def volume_manifest(spark, sf_dir):
    parsed = _items(spark, sf_dir)
    placed = integrate.placements(_plan(spark, sf_dir), parsed, _staged(spark, sf_dir), _have(spark, sf_dir))
    v = integrate.volumes(parsed, placed)
    return v.select("gpp_id", "date_published", F.array_join("local_paths", ",").alias("local_paths"), "staged", F.size("download_urls").alias("urls"))


# Reports -----------------------------------------------------------------------------------------------------------


@query("force_counts", """SELECT CASE WHEN l_linenumber % 3 = 0 THEN false END AS in_effect, count(*)::BIGINT AS n, count(*) FILTER (l_suppkey % 2 = 0)::BIGINT AS regular FROM lineitem GROUP BY 1""")
def force_counts(spark, sf_dir):
    d = read(spark, sf_dir, "lineitem").selectExpr("CASE WHEN l_linenumber % 3 = 0 THEN false END AS in_effect", "l_suppkey % 2 <> 0 AS is_emergency")
    return reports.force_counts(d)


@query("most_cited", """SELECT l_partkey::VARCHAR AS target, count(*)::BIGINT AS n, min(l_orderkey) AS first FROM lineitem WHERE l_linenumber % 2 = 1 GROUP BY 1""")
def most_cited(spark, sf_dir):
    d = read(spark, sf_dir, "lineitem").selectExpr("CAST(l_partkey AS STRING) AS target", "CASE WHEN l_linenumber % 2 = 1 THEN 'not-in-corpus' ELSE 'no-year' END AS reason", "l_orderkey")
    return reports.most_cited(d, "l_orderkey")


@query("dangle_reasons", """SELECT CASE l_linenumber % 3 WHEN 0 THEN 'no-year' WHEN 1 THEN 'not-in-corpus' ELSE 'implausible-year' END AS reason, count(*)::BIGINT AS n FROM lineitem GROUP BY 1""")
def dangle_reasons(spark, sf_dir):
    return reports.dangle_counts(read(spark, sf_dir, "lineitem").selectExpr("CASE l_linenumber % 3 WHEN 0 THEN 'no-year' WHEN 1 THEN 'not-in-corpus' ELSE 'implausible-year' END AS reason"))


_NAMES = "CASE WHEN p_partkey % 7 = 0 THEN 'Café ' WHEN p_partkey % 7 = 1 THEN 'The ' ELSE '' END || p_name"
_KEYED = "trim(regexp_replace(regexp_replace(lower(strip_accents({0})), '^\\s*(the|a|an)\\s+', ''), '[^a-z0-9]+', ' ', 'g'))"


@query("entity_matches", f"""WITH r AS (SELECT p_brand AS id, {_KEYED.format(_NAMES)} AS k FROM part WHERE p_partkey % 2 = 0), x AS (SELECT k, count(DISTINCT id) AS ids, min(id) AS id FROM r GROUP BY 1),
  n AS (SELECT (p_partkey % 500)::VARCHAR AS eo_id, {_NAMES} AS raw_name FROM part), s AS (SELECT n.*, CASE WHEN x.k IS NULL THEN 'no-match' WHEN ids > 1 THEN 'ambiguous' ELSE 'match' END AS status, CASE WHEN ids = 1 THEN x.id END AS registry_id FROM n LEFT JOIN x ON {_KEYED.format('n.raw_name')} = x.k)
  SELECT eo_id, raw_name, status, registry_id, CASE WHEN status <> 'match' THEN status WHEN count(*) FILTER (status = 'match') OVER (PARTITION BY eo_id) = 1 THEN 'auto' ELSE 'multiple-in-order' END AS fate FROM s""")
def entity_matches(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    reg = part.filter("p_partkey % 2 = 0").selectExpr("p_brand AS id", f"{_NAMES} AS name")
    names = part.selectExpr("CAST(p_partkey % 500 AS STRING) AS eo_id", f"{_NAMES} AS raw_name")
    return reports.split_matches(graph.match_entities(names, reg))


@query("entities_found", """SELECT p_partkey::VARCHAR AS eo_id, 'Office of ' || replace(p_brand, '#', ' ') || ' ' || p_name AS raw_name FROM part WHERE p_partkey % 4 <> 0""")
def entities_found(spark, sf_dir):
    d = read(spark, sf_dir, "part").selectExpr("CAST(p_partkey AS STRING) AS eo_id", "p_partkey % 4 = 0 AS is_emergency",
        "concat('There is hereby established, within the office, the Office of  ', replace(p_brand, '#', ' '), ' ', p_name, CASE WHEN p_partkey % 3 = 0 THEN ' within the City, as said.' ELSE ' which shall report.' END) AS full_text")
    return graph.established_entities(d)


@query("sample_strata", """WITH c AS (SELECT o_orderkey::VARCHAR AS eo_id, (o_orderkey % 8)::INT AS k, o_custkey FROM orders), z AS (SELECT *, CASE WHEN k = 0 THEN 2 ELSE 0 END AS noise FROM c WHERE k <> 7),
  a AS (SELECT eo_id FROM z ORDER BY noise DESC, eo_id COLLATE C LIMIT 25), b AS (SELECT eo_id FROM z WHERE k IN (1, 3) ORDER BY eo_id COLLATE C LIMIT 10), e AS (SELECT eo_id FROM z ORDER BY noise DESC, eo_id COLLATE C LIMIT 10),
  t AS (SELECT eo_id FROM z WHERE NOT (k = 5 AND o_custkey % 2 = 0) ORDER BY eo_id COLLATE C LIMIT 10), l AS (SELECT eo_id, 0 AS r, 'heavy-noise' AS label FROM a UNION ALL SELECT eo_id, 1, 'ambiguous' FROM b UNION ALL SELECT eo_id, 2, 'era-1974-2001' FROM e UNION ALL SELECT eo_id, 3, 'empty-title' FROM t)
  SELECT eo_id, min_by(label, r) AS label FROM l GROUP BY 1 UNION ALL (SELECT eo_id, 'extra-control' FROM c WHERE k = 7 ORDER BY eo_id COLLATE C LIMIT 1)""")
def sample_strata(spark, sf_dir):
    return reports.sample(_cleaned(spark, sf_dir, "dropped_header", "flags"))


@query("probe_report", """SELECT count(*) FILTER (doc_id % 3 = 0)::BIGINT AS text, count(*) FILTER (doc_id % 3 > 0)::BIGINT AS scanned, 0::BIGINT AS error FROM documents""")
def probe_report(spark, sf_dir):
    return reports.probe_report(read(spark, sf_dir, "documents").selectExpr("CASE WHEN doc_id % 3 = 0 THEN 'text' ELSE 'scanned' END AS classification"))


@query("intake_new_rows", """SELECT eo_id, source_pdf_url FROM (SELECT o_custkey::VARCHAR AS eo_id, 'u' || (o_orderkey % 3)::VARCHAR AS source_pdf_url, o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 4 = 0))
  QUALIFY row_number() OVER (PARTITION BY eo_id, source_pdf_url ORDER BY o_orderkey) = 1""")
def intake_new_rows(spark, sf_dir):
    from ..streaming.intake import new_rows

    batch = _orders(spark, sf_dir, "CAST(o_custkey AS STRING) AS eo_id", "'u' || CAST(o_orderkey % 3 AS STRING) AS source_pdf_url", "o_orderkey AS seq")
    known = read(spark, sf_dir, "customer").filter("c_custkey % 4 = 0").selectExpr("CAST(c_custkey AS STRING) AS eo_id")
    return new_rows(batch, known, ["seq"]).select("eo_id", "source_pdf_url")
