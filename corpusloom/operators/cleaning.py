"""The cleaning record: header trim, file marks, title and date gaps filled, quality tier. Nothing is dropped but relocated.

A line's fuzzy anchor depends on its words only, so it is found once for each different line of a batch of records; per record just the
anchored lines' words come back, as a map, and all else is decided within the row, so lines are neither shuffled nor joined.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lex
from ..functions import text
from ..functions.ident import strip

OCR, BORN_DIGITAL = "ocr", "born-digital"


def _first(flags: Column) -> Column:
    """Place of the first true, 0-based; null without one."""
    at = F.array_position(flags, F.lit(True))
    return F.when(at > 0, (at - 1).cast("int"))


def clean_records(
    records: DataFrame, lexicon: DataFrame, key: str = "eo_id", body: str = "body", lexicon_label: str = "", fields: Iterable[str] | None = None
) -> DataFrame:
    """``records`` (key, body, year, title, date_signed, text_source, ...) with a struct column ``clean``.

    Bodies whose text_source is ``ocr`` are edited: what stands before the earliest anchor goes to dropped_header (unless the
    order's text begins above it, or it is longer than 900 characters: then all is kept and flagged), isolated file marks go
    to dropped_marks, white space is normalised. Others pass byte for byte. A title or date that is there is never replaced;
    an empty one is filled from the cleaned body if it can be trusted, else flagged. A null body counts as empty; repeated
    keys keep their own rows. full_text_raw holds the body as it came. With ``fields``, ``clean`` has those only: Spark makes a struct
    whole where a function takes a field of it, so fields that nobody reads would be worked out too.
    """
    raw = F.coalesce(F.col(body), F.lit(""))
    # partitions aren't merged by their size: cleaning is much work for few bytes
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = records.repartition(parts, key).withColumn("_raw", raw)
    lines = F.split("_raw", "\n", -1)
    rows = rows.withColumn("_lines", lines).withColumn("_words", F.transform(lines, text.token_text))
    rows = rows.withColumn("anchors", text.anchors_of(F.col("_words")))
    label = lambda w: F.try_element_at(F.col("anchors"), w)
    rows = rows.withColumn("_at", _first(F.transform("_words", lambda w: F.coalesce(label(w), F.lit("")) != "")))
    edits = F.coalesce(F.col("text_source") == OCR, F.lit(False))
    found = F.when(F.col("_at").isNotNull(), label(F.try_element_at("_words", F.col("_at") + 1)))
    header = F.array_join(F.slice("_lines", F.lit(1), F.coalesce("_at", F.lit(0))), "\n")
    after = edits & F.exists(F.slice("_words", F.lit(1), F.col("_at")), lambda w: w.rlike(text._STARTS))
    large = edits & ~F.coalesce(after, F.lit(False)) & (F.length("_header") > text.MAX_HEADER)
    rows = rows.withColumn("_label", found).withColumn("_header", header).withColumn("_after", F.coalesce(after, F.lit(False)))
    rows = rows.withColumn("_large", F.coalesce(large, F.lit(False)) & F.col("_at").isNotNull())
    trims = edits & F.col("_at").isNotNull() & ~F.col("_after") & ~F.col("_large")
    rest = F.array_join(F.slice("_lines", F.col("_at") + 1, F.greatest(F.size("_lines"), F.lit(1))), "\n")
    rows = rows.withColumn("_trims", trims).withColumn("_edits", edits)
    rows = rows.withColumn("_marks", F.when(F.col("_edits"), text.strip_file_marks(F.when(F.col("_trims"), rest).otherwise(F.col("_raw")))))
    rows = rows.withColumn("_clean", F.when(F.col("_edits"), text.normalize_ws(F.col("_marks.text"))).otherwise(F.col("_raw")))
    rows = rows.withColumn("_dropped", F.when(F.col("_trims"), strip(F.col("_header"))).otherwise(F.lit("")))
    rows = rows.withColumn("_body", F.split("_clean", "\n", -1))
    empty = strip(F.coalesce("title", F.lit(""))) == ""
    candidate = text.title_among(F.col("_body"), lambda x: x, lambda x, words: label(words).isNotNull())
    rows = rows.withColumn("_candidate", F.when(empty, candidate))
    gate = lex.trusted(rows, "_candidate", lexicon).withColumnsRenamed({"title": "_t", "ok": "_ok"})
    rows = rows.join(gate, F.col("_candidate") == F.col("_t"), "left").withColumn("_ok", F.coalesce("_ok", F.lit(False)))
    dated = F.coalesce("date_signed", F.lit("")) != ""
    rows = rows.withColumn("_date", F.when(~dated, text.extract_date(F.col("_body"), F.col("year").cast("int"))))
    kept_label = F.when(~F.col("_after") & ~F.col("_large"), F.col("_label"))
    title = F.when(~empty, F.col("title")).when(F.col("_ok"), F.col("_candidate"))
    date = F.when(dated, F.col("date_signed")).otherwise(F.col("_date"))
    flags = F.array_compact(F.array(
        F.when(F.col("_edits") & F.col("_at").isNull(), "no-anchor-found"),
        F.when(F.col("_after"), "anchor-after-body-start"),
        F.when(F.col("_large"), F.concat(F.lit("large-header-trim-skipped: "), F.length("_header").cast("string"), F.lit(" chars"))),
        F.when(F.col("_candidate").isNotNull() & ~F.col("_ok"), F.concat(F.lit("title-uncertain: "), F.col("_candidate"))),
        F.when(empty & F.col("_candidate").isNull(), "title-not-extracted"),
        F.when(~dated & F.col("_date").isNull(), "date-not-extracted"),
    ))
    rows = rows.withColumn("_anchor", kept_label).withColumn("_flags", flags).withColumn("_titled", title).withColumn("_dated", date)
    review = F.col("_after") | F.col("_large") | (F.col("_candidate").isNotNull() & ~F.col("_ok"))
    noise, marks = F.length("_dropped"), F.coalesce("_marks.dropped", F.array().cast("array<string>"))
    born = F.coalesce(F.col("text_source") == BORN_DIGITAL, F.lit(False))
    words, junk = text.word_ratio(F.col("_clean")), text.junk_ratio(F.col("_clean"))
    quality = text.tier(born, F.col("_anchor").isNotNull(), noise, words, junk, review)
    metrics = F.struct(
        noise.alias("leading_noise_chars"), F.round(words, 4).alias("english_word_ratio"), F.round(junk, 4).alias("junk_char_ratio"),
        F.col("_anchor").isNotNull().alias("anchor_found"), F.col("_titled").isNotNull().alias("title_resolved"),
        F.col("_dated").isNotNull().alias("date_resolved"), F.size(marks).alias("dropped_mark_count"), F.length("_raw").alias("raw_chars"),
        F.length("_clean").alias("clean_chars"), F.lit(lexicon_label).alias("lexicon_source"),
    )
    clean = {
        "full_text": F.col("_clean"), "full_text_raw": F.col("_raw"), "dropped_header": F.col("_dropped"), "dropped_marks": marks, "title": F.col("_titled"),
        "date_signed": F.col("_dated"), "text_quality": quality, "anchor_found": F.col("_anchor").isNotNull(), "anchor_label": F.col("_anchor"),
        "title_extracted": empty & F.col("_ok"), "date_extracted": F.col("_date").isNotNull(), "metrics": metrics, "flags": F.col("_flags"),
    }
    return rows.select(*records.columns, F.struct(*(clean[n].alias(n) for n in (clean if fields is None else fields))).alias("clean"))


def clean_stage(records: DataFrame, lexicon: DataFrame, key: str = "eo_id", body: str = "body") -> DataFrame:
    """(columns of ``records``, out): out has body, raw_body, title, date_signed, text_quality, dropped_header and
    dropped_marks. OCR and born-digital texts are cleaned; any other source has no text and passes as ``no-text``."""
    has = F.col("text_source").isin(OCR, BORN_DIGITAL)
    wanted = ["full_text", "full_text_raw", "title", "date_signed", "text_quality", "dropped_header", "dropped_marks"]
    done = clean_records(records.filter(has), lexicon, key, body, fields=wanted)
    c = F.col("clean")
    done = done.withColumn("out", F.struct(
        c["full_text"].alias("body"), c["full_text_raw"].alias("raw_body"), c["title"].alias("title"), c["date_signed"].alias("date_signed"),
        c["text_quality"].alias("text_quality"), c["dropped_header"].alias("dropped_header"), c["dropped_marks"].alias("dropped_marks"),
    )).drop("clean")
    rest = records.filter(~F.coalesce(has, F.lit(False))).withColumn("out", F.struct(
        F.col(body).alias("body"), F.col(body).alias("raw_body"), F.col("title").alias("title"), F.col("date_signed").alias("date_signed"),
        F.lit("no-text").alias("text_quality"), F.lit("").alias("dropped_header"), F.array().cast("array<string>").alias("dropped_marks"),
    ))
    return done.unionByName(rest)
