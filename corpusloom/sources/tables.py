"""Readers of the published forms: JSON arrays, feed pages, Markdown records, tab-separated lists, PDF files, archive captures."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ident
from . import frontmatter

# Fixed field lists: their order is part of the format.
INDEX = "eo_id string, number string, year int, is_emergency boolean, date_signed string, title string, source_pdf_url string, pdf_path string, source string"
FEED = "pageSize int, currentPage int, totalResults int, totalPages int, results array<struct<link string, title string, articleDate string>>"


CAPTURE = "urlkey string, timestamp timestamp, original string, mimetype string, statuscode int, digest string, length long"
INVENTORY = "id string, t string, dp string, cr string, fs string, desc string"
#: Fields of a corpus record, in order; the first 21 are its frontmatter.
FRONTMATTER = (
    "eo_id number year is_emergency date_signed mayor administration admin_note title source source_pdf_url pdf_path supersedes"
    " superseded_by establishes_entity in_effect text_source page_count text_quality dropped_header dropped_marks"
).split()
CORPUS = (
    "eo_id string, number string, year int, is_emergency boolean, date_signed string, mayor string, administration string, admin_note string,"
    " title string, source string, source_pdf_url string, pdf_path string, supersedes array<string>, superseded_by array<string>,"
    " establishes_entity string, in_effect boolean, text_source string, page_count int, text_quality string, dropped_header string,"
    " dropped_marks array<string>, full_text string, full_text_raw string"
)
#: Mean characters a page above which a PDF has a text layer.
PAGE_CHARS = 100


def _there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_index(spark: SparkSession, path: str, split: int | None = None) -> DataFrame:
    """A JSON array of index rows; unknown keys are ignored, a null title is empty. A path that isn't there has no rows. With ``split``
    a file is read by ranges of so many bytes, each a task (``json_splits``); else a file is one task."""
    if not _there(spark, path):
        return spark.createDataFrame([], INDEX)
    if split:
        from .json_splits import read_json_array

        return read_json_array(spark, path, INDEX, split).withColumn("title", F.coalesce("title", F.lit("")))
    return spark.read.schema(INDEX).json(path, multiLine=True).withColumn("title", F.coalesce("title", F.lit("")))


def feed_results(pages: DataFrame) -> DataFrame:
    """(link, title, articleDate, is_order) of feed pages (FEED)."""
    rows = pages.select(F.explode("results").alias("r")).select("r.*")
    return rows.withColumn("title", ident.strip(F.coalesce("title", F.lit("")))).withColumn("is_order", ident.is_order(F.col("title")))


def feed_entries(results: DataFrame, window_year: Column) -> DataFrame:
    """Entries of the results that are orders: the year of the date or else of the window."""
    signed = ident.parse_article_date(F.coalesce("articleDate", F.lit("")))
    return results.filter("is_order").select(
        ident.parse_number(F.col("title")).alias("number"), ident.is_emergency(F.col("title")).alias("is_emergency"),
        F.coalesce(ident.year_of(signed), window_year).alias("year"), signed.alias("date_signed"), "title",
        ident.absolute(F.coalesce("link", F.lit(""))).alias("article_url"),
    )


def read_feed(spark: SparkSession, path: str, window_year: int) -> DataFrame:
    """Saved feed pages to entries."""
    return feed_entries(feed_results(spark.read.schema(FEED).json(path, multiLine=True)), F.lit(window_year))


def excluded_results(spark: SparkSession, path: str) -> DataFrame:
    """Results of saved feed pages that are no orders, which the entries leave out."""
    return feed_results(spark.read.schema(FEED).json(path, multiLine=True)).filter("NOT is_order")


def read_records(spark: SparkSession, path: str, schema: str, key: str, split: int | None = None) -> DataFrame:
    """Rows (``schema``) of a JSON file that is a list or an object with the list under ``key``; anything else is an error. With ``split``
    the file must be a list, which is read by ranges of so many bytes."""
    if split:
        from .json_splits import read_json_array

        return read_json_array(spark, path, schema, split)
    raw = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    listed = F.when(F.col("v").startswith("["), F.from_json("v", f"array<struct<{schema}>>")).otherwise(
        F.from_json("v", f"struct<{key}: array<struct<{schema}>>>")[key]
    )
    bad = F.raise_error(F.concat(F.lit(f"no list under {key} in "), F.lit(path)))
    return raw.select(F.explode(F.coalesce(listed, bad.cast(f"array<struct<{schema}>>"))).alias("r")).select("r.*")


def read_inventory(spark: SparkSession, path: str, split: int | None = None) -> DataFrame:
    """Second source's items (id, t, dp, cr, fs, desc)."""
    return read_records(spark, path, INVENTORY, "records", split)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """(id, name) for every name of every entity: its name, short name and other names, be these text or {name, note}."""
    raw = read_records(spark, path, "id string, name string, short_name string, other_names array<string>", "entities")
    other = F.transform(F.coalesce("other_names", F.array().cast("array<string>")), lambda o: F.when(o.startswith("{"), F.get_json_object(o, "$.name")).otherwise(o))
    names = F.array_compact(F.concat(F.array("name", "short_name"), other))
    return raw.filter("id IS NOT NULL AND id <> ''").select("id", F.explode(names).alias("name")).filter("name <> ''").distinct()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(eo_id, disposition) of a provenance file; none if it is missing or broken."""
    empty = spark.createDataFrame([], "eo_id string, disposition string")
    if not _there(spark, path):
        return empty
    raw = spark.read.text(path, wholetext=True)
    orders = F.from_json(F.get_json_object("value", "$.orders"), "map<string, struct<disposition: string>>")
    return raw.select(F.explode(orders).alias("eo_id", "o")).select("eo_id", "o.disposition")


def read_markdown(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Records of ``---`` frontmatter and a body: scalar fields as text (folded and quoted ones too), lists joined by newlines
    where a field is one, null where it is null or missing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                got = [frontmatter.split(t) for t in batch.column(0).slice(lo, 256).to_pylist()]
                heads = [frontmatter.parse(h) for h, _ in got]
                said = lambda v: "\n".join(x or "" for x in v) if isinstance(v, list) else v
                cols = [pa.array([said(h.get(f)) for h in heads], pa.string()) for f in fields]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([b for _, b in got], pa.string())], names=[*fields, "full_text"])

    schema = ", ".join(f"`{f}` string" for f in [*fields, "full_text"])
    return spark.read.text(path, wholetext=True).mapInArrow(run, schema)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Corpus records (CORPUS) from their Markdown files; full_text_raw isn't in the files, so it is the text."""
    rows = read_markdown(spark, path, FRONTMATTER)
    cells = {"year": "int", "page_count": "int", "is_emergency": "boolean", "in_effect": "boolean"}
    lists = lambda f: F.when(F.coalesce(F.col(f), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(f, "\n"))
    typed = [
        lists(f).alias(f) if f in ("supersedes", "superseded_by", "dropped_marks") else F.col(f).try_cast(cells[f]).alias(f) if f in cells else F.col(f)
        for f in FRONTMATTER
    ]
    return rows.select(*typed, "full_text", F.col("full_text").alias("full_text_raw"))


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep="\t", header=True)


def pdf_state(files: DataFrame) -> DataFrame:
    """(path, valid) of a ``binaryFile`` scan: not empty, and a PDF by its first bytes."""
    return files.select("path", is_pdf(F.col("content")).alias("valid"))


def is_pdf(content: Column) -> Column:
    return F.coalesce(F.substring(content, 1, 4) == F.lit(b"%PDF"), F.lit(False))


def staged_files(spark: SparkSession, folder: str) -> DataFrame:
    """(fileset_id, path, valid) of the staged files ``gpp-<id>.pdf`` of a folder; none if the folder isn't there."""
    if not _there(spark, folder):
        return spark.createDataFrame([], "fileset_id string, path string, valid boolean")
    name = r"(?i)/gpp-([^/]+)\.pdf$"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "gpp-*.pdf").load(folder)
    read = files.select(ident.found(F.col("path"), name).alias("fileset_id"), "path", is_pdf(F.col("content")).alias("valid"))
    # a scan leaves out empty files, which are there but no PDFs; a folder's listing is the driver's anyway
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    empty = [(x.getPath().toString(),) for x in listed if x.getLen() == 0 and x.getPath().getName().startswith("gpp-") and x.getPath().getName().endswith(".pdf")]
    rows = spark.createDataFrame(empty, "path string").select(ident.found(F.col("path"), name).alias("fileset_id"), "path", F.lit(False).alias("valid"))
    return read.unionByName(rows)


def probe_class(pages: Column, chars: Column, threshold: int = PAGE_CHARS) -> Column:
    """text, scanned or error of a PDF: its mean characters a page against the threshold; no pages are an error."""
    return F.when(F.coalesce(pages, F.lit(0)) == 0, "error").when(F.try_divide(chars, pages) > threshold, "text").otherwise("scanned")


def probe_pdfs(files: DataFrame, extract: Callable[[bytes], list[str]] | None = None) -> DataFrame:
    """(path, classification, page_count, total_chars, chars_per_page, error, pages) of ``binaryFile`` rows.

    ``extract`` gives the pages' texts of a PDF's bytes; by default PyMuPDF, where it is installed. A file that can't be read is
    an error row, never a failure.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages_of = extract or _pymupdf()
        for batch in batches:
            paths, contents = batch.column("path").to_pylist(), batch.column("content").to_pylist()
            for path, content in zip(paths, contents, strict=True):
                pages, error = [], None
                try:
                    pages = pages_of(content)
                    error = None if pages else "zero pages"
                except Exception as e:  # any broken file is a row
                    error = str(e)
                cols = [pa.array([path]), pa.array([len(pages)], pa.int32()), pa.array([sum(map(len, pages))], pa.int64()), pa.array([error], pa.string()), pa.array([pages], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, names=["path", "page_count", "total_chars", "error", "pages"])

    rows = files.select("path", "content").mapInArrow(run, "path string, page_count int, total_chars long, error string, pages array<string>")
    mean = F.coalesce(F.try_divide("total_chars", "page_count"), F.lit(0.0))
    return rows.select("path", probe_class(F.col("page_count"), F.col("total_chars")).alias("classification"), "page_count", "total_chars", mean.alias("chars_per_page"), "error", "pages")


def _pymupdf() -> Callable[[bytes], list[str]]:
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("reading PDF text needs PyMuPDF, or an extract function") from e

    def pages(content: bytes) -> list[str]:
        with fitz.open(stream=content, filetype="pdf") as doc:
            return [page.get_text("text") for page in doc]

    return pages


def pdf_text(pages: Column) -> Column:
    """Full text of a PDF's pages: joined by blank lines and cleaned."""
    from ..functions.text import clean_text

    return clean_text(F.array_join(pages, "\n\n"))


def ocr_pdfs(files: DataFrame, recognize: Callable[[bytes], list[str]]) -> DataFrame:
    """(path, text, page_count, text_source) of scanned ``binaryFile`` rows by a local recogniser; any failure is ``ocr-failed``
    with an empty text, and nothing else is tried."""
    rows = probe_pdfs(files, recognize)
    good = F.col("error").isNull()
    text = F.when(good, pdf_text(F.col("pages"))).otherwise(F.lit(""))
    source = F.when(good, "ocr").otherwise("ocr-failed")
    return rows.select("path", text.alias("text"), F.when(good, F.col("page_count")).otherwise(F.lit(0)).alias("page_count"), source.alias("text_source"))


def captures(rows: DataFrame, prefix: str, from_year: int | None = None, to_year: int | None = None, limit: int | None = None, keyed: bool = False) -> DataFrame:
    """Archive captures (CAPTURE) under an address prefix, scheme, ``www`` host and case left out: PDFs answered with 200, of a window of
    capture years if there is one. A limit keeps the first in order of key and time.

    The prefix is a range of archive keys. ``keyed`` tells that urlkey is ``ident.url_key`` (``write_captures``); then the range is a plain
    comparison with the column, which a sorted table's files are pruned by. Else the keys are made from the addresses.
    """
    low, high = ident.key_range(prefix)
    key = F.col("urlkey") if keyed else ident.url_key(F.col("original"))
    out = rows.filter((key >= low) & (key < high) & (F.col("mimetype") == "application/pdf") & (F.col("statuscode") == 200))
    if from_year is not None:
        out = out.filter(F.col("timestamp") >= F.make_timestamp(F.lit(from_year), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    if to_year is not None:
        out = out.filter(F.col("timestamp") < F.make_timestamp(F.lit(to_year + 1), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    return out if limit is None else out.orderBy(key, "timestamp", "original").limit(limit)


def write_captures(rows: DataFrame, path: str) -> None:
    """Captures (CAPTURE) as a table range-sorted by archive key and time, for ``captures(..., keyed=True)``."""
    order = ["urlkey", "timestamp", "original"]
    keyed = rows.withColumn("urlkey", ident.url_key(F.col("original")))
    keyed.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def playback(capture_time: Column, original: Column) -> Column:
    """Address at which the archive plays a capture."""
    return F.concat(F.lit("https://web.archive.org/web/"), F.date_format(capture_time, "yyyyMMddHHmmss"), F.lit("/"), original)
