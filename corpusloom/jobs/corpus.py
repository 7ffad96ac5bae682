"""Corpus build: probe and text of each index row, cleaning, derived columns, the locked projection and the build's guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ident
from ..operators import relational as rel
from ..operators.cleaning import clean_stage
from ..sources.sinks import guard_shrink
from ..sources.tables import FRONTMATTER

NO_TEXT = "_No text available_"
PENDING = "signing year past the last mayoral term on record"
#: Class of a PDF by where its text came from; others have none.
CLASSES = {"born-digital": "text", "ocr": "scanned", "ocr-failed": "scanned", "ocr-skipped": "scanned"}


def select(records: DataFrame, year: int | None = None, limit: int | None = None, order: str = "eo_id") -> DataFrame:
    """Records of one year, the first ``limit`` in order."""
    rows = records if year is None else records.filter(F.col("year").cast("int") == year)
    return rows if limit is None else rows.orderBy(order).limit(limit)


def dispatch(records: DataFrame, probes: DataFrame, texts: DataFrame | None = None, recognized: DataFrame | None = None, ocr: bool = True, root: str = "") -> DataFrame:
    """``records`` with body, text_source, classification and page_count.

    ``probes`` (path, classification, page_count, text) are of files that are there; ``recognized`` (path, text, page_count,
    text_source) of those read by OCR. Text: born-digital if it has any, else unreadable. Scanned: the recogniser's result
    (ocr-failed without text), or ocr-skipped. Broken: unreadable. No file: none. Whatever has no text has the stub body.
    """
    read = probes if texts is None else probes.join(texts.select("path", "text"), "path", "left")
    probe = read.select(F.col("path").alias("_p"), "classification", F.col("page_count").alias("_n"), F.col("text").alias("_t"))
    rows = records.withColumn("_at", ident.resolved(F.col("pdf_path"), root) if root else F.nullif("pdf_path", F.lit("")))
    rows = rows.join(probe, F.col("_at") == F.col("_p"), "left")
    if recognized is not None:
        seen = recognized.select(F.col("path").alias("_q"), F.col("text").alias("_o"), F.col("page_count").alias("_m"), F.col("text_source").alias("_s"))
        rows = rows.join(seen, F.col("_at") == F.col("_q"), "left")
    else:
        rows = rows.withColumns({"_q": F.lit(None).cast("string"), "_o": F.lit(None).cast("string"), "_m": F.lit(None).cast("int"), "_s": F.lit(None).cast("string")})
    has = lambda c: ident.strip(F.coalesce(F.col(c), F.lit(""))) != ""
    scanned = F.when(F.lit(not ocr), "ocr-skipped").when((F.col("_s") == "ocr") & has("_o"), "ocr").otherwise("ocr-failed")
    source = (
        F.when(F.col("classification").isNull(), "none").when(F.col("classification") == "text", F.when(has("_t"), "born-digital").otherwise("unreadable"))
        .when(F.col("classification") == "scanned", scanned).otherwise("unreadable")
    )
    rows = rows.withColumn("text_source", source)
    body = F.when(F.col("text_source") == "born-digital", F.col("_t")).when(F.col("text_source") == "ocr", F.col("_o")).otherwise(F.lit(NO_TEXT))
    pages = F.when((F.col("text_source") == "ocr") & (F.coalesce("_m", F.lit(0)) > 0), F.col("_m")).otherwise(F.col("_n"))
    return rows.withColumn("body", body).withColumn("page_count", pages).drop("_at", "_p", "_n", "_t", "_q", "_o", "_m", "_s")


def enrich(records: DataFrame, terms: list[tuple[int, int, str]]) -> DataFrame:
    """``records`` with mayor, administration, admin_note (where no term holds the year) and the graph's four fields, empty."""
    rows = rel.in_range(records, F.col("year").cast("int"), terms, "mayor")
    none = F.array().cast("array<string>")
    return rows.withColumns({
        "administration": F.col("mayor"), "admin_note": F.when(F.col("mayor").isNull(), PENDING), "supersedes": none, "superseded_by": none,
        "establishes_entity": F.lit(None).cast("string"), "in_effect": F.lit(None).cast("boolean"),
    })


def project(cleaned: DataFrame, terms: list[tuple[int, int, str]]) -> DataFrame:
    """The locked columns of cleaned records (``clean_stage``), then full_text and full_text_raw."""
    rows = enrich(cleaned.drop("mayor", "administration", "admin_note", "supersedes", "superseded_by", "establishes_entity", "in_effect"), terms)
    rows = rows.withColumns({"year": F.col("year").cast("int"), "is_emergency": F.coalesce(F.col("is_emergency"), F.lit(False))})
    for c in ("title", "date_signed", "text_quality", "dropped_header", "dropped_marks"):
        rows = rows.withColumn(c, F.col("out")[c])
    return rows.select(*FRONTMATTER, F.col("out.body").alias("full_text"), F.col("out.raw_body").alias("full_text_raw"), *(["classification"] if "classification" in rows.columns else []))


def manifest(corpus: DataFrame) -> DataFrame:
    """(eo_id, year, text_source, classification, char_count, page_count, md_path): char_count of the cleaned body, stubs too."""
    text = F.col("text_source")
    known = F.coalesce(*(F.when(text == k, v) for k, v in CLASSES.items()))
    kind = F.coalesce(F.col("classification"), F.lit("")) if "classification" in corpus.columns else F.coalesce(known, F.lit(""))
    path = F.concat(F.lit("corpus/"), F.col("year").cast("string"), F.lit("/"), F.col("eo_id"), F.lit(".md"))
    return corpus.select(
        "eo_id", "year", "text_source", kind.alias("classification"), F.length("full_text").alias("char_count"),
        F.coalesce(F.col("page_count").cast("string"), F.lit("")).alias("page_count"), path.alias("md_path"),
    )


def build(records: DataFrame, probes: DataFrame, lexicon: DataFrame, terms: list[tuple[int, int, str]], recognized: DataFrame | None = None, ocr: bool = True,
          existing: DataFrame | None = None, allow_shrink: bool = False, year: int | None = None, limit: int | None = None) -> DataFrame:
    """The corpus of index rows: dispatch, clean, enrich, project. Refuses to have fewer records than ``existing``."""
    chosen = select(records, year, limit)
    guard_shrink(chosen, existing, "corpus", allow_shrink)
    return project(clean_stage(dispatch(chosen, probes, None, recognized, ocr), lexicon), terms)


def reclean(corpus: DataFrame, lexicon: DataFrame, terms: list[tuple[int, int, str]]) -> DataFrame:
    """The corpus cleaned anew from its raw texts (from the text where there is no raw one), so a second run changes nothing.
    The graph's fields are empty then and must be found again."""
    raw = F.coalesce(F.nullif("full_text_raw", F.lit("")), "full_text", F.lit(""))
    rows = corpus.withColumn("body", raw).withColumn("text_source", F.coalesce(F.nullif("text_source", F.lit("")), F.lit("none")))
    return project(clean_stage(rows.drop("full_text", "full_text_raw", "text_quality", "dropped_header", "dropped_marks", "classification"), lexicon), terms)


def source_counts(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("text_source").agg(F.count("*").alias("n"))
