"""Harvest jobs: live entries to index and manifest rows, archive captures to rows, merging, and recovery of gaps.

Every job gives tables; nothing is written unless the caller writes it, and what would be fetched is a column (``skipped`` where
``download`` is false). Fetching runs in the tasks, a row's failure is its status.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ident
from ..operators import relational as rel
from ..sources.tables import captures, playback

INDEX_FIELDS = "eo_id number year is_emergency date_signed title source_pdf_url pdf_path source".split()
MANIFEST_FIELDS = "eo_id number year is_emergency date_signed title article_url source_pdf_url pdf_path pdf_resolved download_status download_error".split()
#: Outcomes of a gap that leave it open.
UNRECOVERABLE = ("no-snapshot", "not-a-pdf", "no-candidate-url", "error")


def fetch_bytes(rows: DataFrame, url: str, make: Callable) -> DataFrame:
    """``rows`` with content binary and fetch_error string: what a fetcher, made once a task, gets from the address; a null
    address isn't asked."""
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetcher = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, 16):  # a file is a few MB
                part = batch.slice(lo, 16)
                content, errors = [], []
                for u in part.column(url).to_pylist():
                    try:
                        content.append(None if u is None else fetcher.get_bytes(u))
                        errors.append(None)
                    except Exception as e:
                        content.append(None)
                        errors.append(f"{type(e).__name__}: {e}")
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(content, pa.binary()), pa.array(errors, pa.string())], names=[*columns, "content", "fetch_error"])

    schema = rows.withColumn("content", F.lit(None).cast("binary")).withColumn("fetch_error", F.lit(None).cast("string")).schema
    return rows.mapInArrow(run, schema)


def store(rows: DataFrame, path: str = "dest") -> DataFrame:
    """``rows`` (dest, content, ...) without content, each content written to its path by its task, under another name first."""
    from pyarrow import fs
    from pyspark import TaskContext

    columns = [c for c in rows.columns if c != "content"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, content in zip(batch.column(path).to_pylist(), batch.column("content").to_pylist(), strict=True):
                if at is None or content is None:
                    continue
                system, place = fs.FileSystem.from_uri(at if "://" in at else f"file://{at}")
                system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                temp = f"{place}.{TaskContext.get().taskAttemptId()}"
                with system.open_output_stream(temp) as out:
                    out.write(content)
                system.move(temp, place)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns], names=columns)

    return rows.mapInArrow(run, rows.drop("content").schema)


def download(rows: DataFrame, url: str, dest: str, present: DataFrame, make: Callable) -> DataFrame:
    """``rows`` with download_status (downloaded, cached or error) and download_error: files that are there (path) aren't
    fetched again."""
    held = present.select(F.col("path").alias("_p")).distinct()
    known = rows.join(held, F.col(dest) == F.col("_p"), "left")
    cached = known.filter("_p IS NOT NULL").drop("_p").withColumn("download_status", F.lit("cached")).withColumn("download_error", F.lit(None).cast("string"))
    got = store(fetch_bytes(known.filter("_p IS NULL").drop("_p"), url, make), dest)
    status = F.when(F.col("fetch_error").isNull(), "downloaded").otherwise("error")
    return cached.unionByName(got.withColumn("download_status", status).withColumnRenamed("fetch_error", "download_error"))


def process_entries(entries: DataFrame, downloads: DataFrame | None = None, pdf_dir: str = "pdfs") -> DataFrame:
    """One wide row an entry (number, is_emergency, year, date_signed, title, article_url, source_pdf_url[, html]).

    Without ``downloads`` (eo_id, source_pdf_url, status, error) nothing was to be fetched: status ``skipped``. With them an
    entry whose PDF address isn't known is an error, the others have their download's status; only fetched files have a path.
    """
    url = ident.first_pdf_href(F.col("html")) if "html" in entries.columns else F.col("source_pdf_url")
    rows = entries.withColumn("source_pdf_url", url).withColumn("eo_id", ident.mint_id(F.col("year"), F.col("number"), F.col("is_emergency")))
    rows = rows.withColumn("pdf_resolved", F.col("source_pdf_url").isNotNull()).withColumn("source", F.lit(ident.LIVE))
    nothing = F.lit(None).cast("string")
    if downloads is None:
        return rows.withColumns({"download_status": F.lit("skipped"), "download_error": nothing, "pdf_path": nothing})
    best = F.min(F.struct("status", "error")).alias("_b")  # cached, then downloaded, then error
    done = downloads.groupBy(F.col("eo_id").alias("_e"), F.col("source_pdf_url").alias("_u")).agg(best).select("_e", "_u", F.col("_b.status").alias("_s"), F.col("_b.error").alias("_x"))
    rows = rows.join(done, (F.col("eo_id") == F.col("_e")) & (F.col("source_pdf_url") == F.col("_u")), "left")
    missing = ~F.col("pdf_resolved")
    status = F.when(missing, "error").otherwise(F.coalesce("_s", F.lit("error")))
    error = F.when(missing, "pdf URL not resolved").otherwise(F.when(F.col("_s").isNull(), "not fetched").otherwise(F.col("_x")))
    path = F.when(status.isin("downloaded", "cached"), ident.pdf_dest(pdf_dir, F.col("year"), F.col("eo_id")))
    return rows.withColumns({"download_status": status, "download_error": error, "pdf_path": path}).drop("_e", "_u", "_s", "_x")


def index_of(rows: DataFrame) -> DataFrame:
    """The nine index columns."""
    return rows.select(*INDEX_FIELDS)


def manifest_of(rows: DataFrame, *more: str) -> DataFrame:
    """The manifest columns of wide rows, and ``more``; of index rows, those that can be told: cached where there is a file, else skipped, and
    resolved where there is an address."""
    add = {}
    if "article_url" not in rows.columns:
        add["article_url"] = F.lit("")
    if "download_status" not in rows.columns:
        add["download_status"] = F.when(F.coalesce("pdf_path", F.lit("")) != "", "cached").otherwise("skipped")
    if "pdf_resolved" not in rows.columns:
        add["pdf_resolved"] = F.col("source_pdf_url").isNotNull()
    if "download_error" not in rows.columns:
        add["download_error"] = F.lit(None).cast("string")
    return rows.withColumns(add).select(*MANIFEST_FIELDS, *more)


def index_from_corpus(corpus: DataFrame) -> DataFrame:
    """The index of corpus records: a null title is empty, a missing source is the live one."""
    kept = corpus.withColumn("title", F.coalesce("title", F.lit(""))).withColumn("source", F.coalesce(F.nullif("source", F.lit("")), F.lit(ident.LIVE)))
    return index_of(kept.withColumn("year", F.col("year").cast("int")))


def status_counts(rows: DataFrame) -> DataFrame:
    """One row of counters: enumerated, resolved, downloaded, cached, errors."""
    of = lambda s: F.count_if(F.col("download_status") == s)
    return rows.agg(
        F.count("*").alias("enumerated"), F.count_if("pdf_resolved").alias("resolved"), of("downloaded").alias("downloaded"), of("cached").alias("cached"), of("error").alias("errors")
    )


@dataclass
class Harvest:
    """rows: wide rows, repeats collapsed; conflicts: (eo_id, first_value, source_pdf_url); flagged: captures without identity;
    dropped: ids left to the live index; counts: one row."""

    rows: DataFrame
    conflicts: DataFrame
    counts: DataFrame
    flagged: DataFrame | None = None
    dropped: DataFrame | None = None


def run_harvest(entries: DataFrame, order: list[str], downloads: DataFrame | None = None, pdf_dir: str = "pdfs") -> Harvest:
    """Live entries to rows: statuses, exact repeats collapsed, same id with another address kept and reported."""
    rows = process_entries(entries, downloads, pdf_dir)
    kept, conflicts = rel.collapse_duplicates(rows, "eo_id", "source_pdf_url", order)
    return Harvest(kept, conflicts, status_counts(rows))


def archive_rows(found: DataFrame, identity: Callable[[Column], Column], source: str, statuses: DataFrame | None = None, pdf_dir: str = "pdfs") -> tuple[DataFrame, DataFrame]:
    """(rows, flagged) of captures: ``identity`` reads year, number and series from an address; a capture without is flagged,
    with its address, name and playback address. Without ``statuses`` (eo_id, status, error) nothing was to be fetched."""
    rows = found.withColumn("_i", identity(F.col("original"))).withColumn("source_pdf_url", playback(F.col("timestamp"), F.col("original")))
    flagged = rows.filter("_i IS NULL").select(F.col("original").alias("original_url"), ident.basename(F.col("original")).alias("basename"), F.col("source_pdf_url").alias("wayback_url"))
    good = rows.filter("_i IS NOT NULL").select("*", "_i.year", "_i.number", F.col("_i.emergency").alias("is_emergency")).drop("_i")
    nothing = F.lit(None).cast("string")
    good = good.withColumn("eo_id", ident.mint_id(F.col("year"), F.col("number"), F.col("is_emergency")))
    good = good.withColumns({"date_signed": nothing, "title": F.lit(""), "article_url": F.lit(""), "pdf_resolved": F.lit(True), "source": F.lit(source)})
    if statuses is None:
        return good.withColumns({"download_status": F.lit("skipped"), "download_error": nothing, "pdf_path": nothing}), flagged
    best = F.min(F.struct("status", "error")).alias("_b")
    done = statuses.groupBy(F.col("eo_id").alias("_e")).agg(best).select("_e", F.col("_b.status").alias("_s"), F.col("_b.error").alias("_x"))
    good = good.join(done, F.col("eo_id") == F.col("_e"), "left")
    status = F.coalesce("_s", F.lit("error"))
    path = F.when(status.isin("downloaded", "cached"), ident.pdf_dest(pdf_dir, F.col("year"), F.col("eo_id")))
    return good.withColumns({"download_status": status, "download_error": F.col("_x"), "pdf_path": path}).drop("_e", "_s", "_x"), flagged


def reconcile_paths(rows: DataFrame, present: DataFrame, pdf_dir: str = "pdfs") -> DataFrame:
    """``rows`` with pdf_path filled where it is empty and the file is there (path); a manifest status of skipped or error is
    then cached."""
    dest = ident.pdf_dest(pdf_dir, F.col("year"), F.col("eo_id"))
    held = present.select(F.col("path").alias("_p")).distinct()
    out = rows.withColumn("_d", dest).join(held, F.col("_d") == F.col("_p"), "left")
    fill = (F.coalesce("pdf_path", F.lit("")) == "") & F.col("_p").isNotNull()
    if "download_status" in rows.columns:
        out = out.withColumn("download_status", F.when(fill & F.col("download_status").isin("skipped", "error"), "cached").otherwise(F.col("download_status")))
    return out.withColumn("pdf_path", F.when(fill, F.col("_d")).otherwise(F.col("pdf_path"))).drop("_d", "_p")


def _archive(found: DataFrame, identity, source: str, live: DataFrame, statuses: DataFrame | None, present: DataFrame | None, pdf_dir: str, order: list[str]) -> Harvest:
    rows, flagged = archive_rows(found, identity, source, statuses, pdf_dir)
    kept, conflicts = rel.collapse_duplicates(rows, "eo_id", "source_pdf_url", order)
    wide = [*MANIFEST_FIELDS, "source"]
    merged, dropped = rel.prefer_first(manifest_of(live, "source"), kept.select(*wide), "eo_id")
    if present is not None:
        merged = reconcile_paths(merged, present, pdf_dir)
    return Harvest(merged, conflicts, status_counts(rows), flagged, dropped)


def run_archive(rows: DataFrame, live: DataFrame, from_year: int | None = None, to_year: int | None = None, limit: int | None = None, statuses: DataFrame | None = None, present: DataFrame | None = None, pdf_dir: str = "pdfs") -> Harvest:
    """Historical captures (the year stands in the name): one a URL, the newest; merged behind the live index, which wins."""
    found = captures(rows, ident.HISTORICAL_PREFIX, from_year, to_year, limit)
    found = rel.latest(found.withColumn("_q", F.xxhash64("urlkey", "digest")), ["original"], "timestamp", "_q").drop("_q")
    return _archive(found, ident.filename_identity, ident.ARCHIVE, live, statuses, present, pdf_dir, ["timestamp", "original"])


def run_archive_folders(rows: DataFrame, live: DataFrame, low: int = 2014, high: int = 2021, limit: int | None = None, statuses: DataFrame | None = None, present: DataFrame | None = None, pdf_dir: str = "pdfs") -> Harvest:
    """Captures whose year is the folder: the window is of that year, never of the capture; hosts collapse to one capture an id."""
    found = captures(rows, ident.FOLDERS_PREFIX, limit=limit)
    found = found.filter(ident.path_year(F.col("original")).between(low, high))
    i = ident.assets_identity(F.col("original"))
    found = found.withColumn("_i", i).withColumn("_id", F.when(i.isNotNull(), ident.mint_id(F.col("_i.year"), F.col("_i.number"), F.col("_i.emergency"))))
    found = found.withColumn("_b", ident.basename(F.col("original"))).withColumn("_q", F.xxhash64("urlkey", "digest"))
    found = rel.latest_by_identity(found, "_id", "_b", "timestamp", "_q").drop("_i", "_id", "_b", "_q")
    return _archive(found, ident.assets_identity, ident.ARCHIVE_FOLDERS, live, statuses, present, pdf_dir, ["timestamp", "original"])


def gaps(index: DataFrame, present: DataFrame, pdf_dir: str = "pdfs") -> DataFrame:
    """Index rows whose file isn't there, whatever path they record."""
    held = present.select(F.col("path").alias("_p")).distinct().select("_p", F.xxhash64("_p").alias("_px"))
    rows = index.withColumn("_d", ident.pdf_dest(pdf_dir, F.col("year"), F.col("eo_id"))).withColumn("_dx", F.xxhash64("_d"))
    return rows.join(held, (F.col("_dx") == F.col("_px")) & (F.col("_d") == F.col("_p")), "left_anti").drop("_d", "_dx")


def fetch_pdfs(rows: DataFrame, url: str, dest: str, order: list[str], make: Callable) -> DataFrame:
    """``rows`` with fetched (recovered, cached, not-a-pdf or error) and fetch_error: PDFs from ``url`` written to ``dest`` by the tasks,
    under another name first. Rows of one file come to one task in ``order``; once it is there, the others are cached, without a request. A null
    address isn't asked."""
    from pyarrow import fs
    from pyspark import TaskContext

    columns = rows.columns

    def get(fetcher, address: str, at: str) -> tuple[str, str | None]:
        try:
            content = fetcher.get_bytes(address)
        except Exception as e:
            return "error", f"{type(e).__name__}: {e}"
        if content[:4] != b"%PDF":
            return "not-a-pdf", None
        system, place = fs.FileSystem.from_uri(at if "://" in at else f"file://{at}")
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        temp = f"{place}.{TaskContext.get().taskAttemptId()}"
        with system.open_output_stream(temp) as out:
            out.write(content)
        system.move(temp, place)
        return "recovered", None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetcher, last, there = make(), None, False
        for batch in batches:
            told = []
            for address, at in zip(batch.column(url).to_pylist(), batch.column(dest).to_pylist(), strict=True):
                last, there = at, there and at == last
                told.append((None, None) if address is None or at is None else ("cached", None) if there else get(fetcher, address, at))
                there = there or told[-1][0] == "recovered"
            status, errors = zip(*told, strict=True) if told else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(status, pa.string()), pa.array(errors, pa.string())], names=[*columns, "fetched", "fetch_error"])

    schema = rows.withColumn("fetched", F.lit(None).cast("string")).withColumn("fetch_error", F.lit(None).cast("string")).schema
    return rows.repartition(dest).sortWithinPartitions(dest, *order).mapInArrow(run, schema)


def recover(index: DataFrame, rows: DataFrame, present: DataFrame, make: Callable | None = None, pdf_dir: str = "pdfs", order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(outcomes, index): each gap's outcome (eo_id, year, candidate_url, status, wayback_url, pdf_path, reason, source_pdf_url), and the
    index with what was recovered; rows that share an id have outcomes of their own.

    A gap's candidate addresses are looked up in order; the first with a usable capture wins, by its newest. Without ``make`` (a
    fetcher) nothing is fetched and the status is would-recover. What is fetched must be a PDF by its first bytes. Of rows with
    the same file the first in ``order`` (address) whose fetch gives a PDF is recovered, those after it are cached.
    """
    index = reconcile_paths(index, present, pdf_dir)
    asked = gaps(index, present, pdf_dir).withColumn("_c", ident.candidate_urls(F.col("source_pdf_url"), F.col("year"), F.col("number"), F.col("is_emergency")))
    found = rel.first_hit(asked, F.col("_c"), rows).withColumn("wayback_url", playback(F.col("timestamp"), F.col("original")))
    found = found.withColumn("dest", ident.pdf_dest(pdf_dir, F.col("year"), F.col("eo_id")))
    status = F.when(F.size("_c") == 0, "no-candidate-url").when(F.col("candidate").isNull(), "no-snapshot")
    if make is None:
        found = found.withColumn("status", F.coalesce(status, F.lit("would-recover"))).withColumn("fetch_error", F.lit(None).cast("string"))
    else:
        found = fetch_pdfs(found, "wayback_url", "dest", order or ["source_pdf_url"], make).withColumn("status", F.coalesce(status, "fetched"))
    reason = (
        F.when(F.col("status") == "no-candidate-url", "no recorded address and no number to build one from")
        .when(F.col("status") == "no-snapshot", "the archive has no PDF answered with 200 under either address")
        .when(F.col("status") == "not-a-pdf", "what the archive holds isn't a PDF").when(F.col("status") == "error", F.col("fetch_error"))
    )
    path = F.when(F.col("status").isin("recovered", "cached"), F.col("dest"))
    played = F.when(F.col("status") != "cached", F.col("wayback_url"))
    outcomes = found.select(
        "eo_id", "year", F.coalesce("candidate", F.try_element_at("_c", F.lit(1))).alias("candidate_url"), "status", played.alias("wayback_url"), path.alias("pdf_path"),
        reason.alias("reason"), "source_pdf_url",
    )
    return outcomes, apply_outcomes(index, outcomes)


def apply_outcomes(index: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``index`` with the path and source of what was recovered or is cached; an address is filled only where there was none. A row
    has the outcome of its id and address, and rows stay as many as they are. Ids and addresses begin alike, so a hash goes before them
    in the sorts."""
    row = F.xxhash64("eo_id", "source_pdf_url")
    done = outcomes.filter(F.col("status").isin("recovered", "cached")).groupBy(row.alias("_x"), F.col("eo_id").alias("_e"), F.col("source_pdf_url").alias("_u"))
    done = done.agg(F.min("pdf_path").alias("_p"), F.min("wayback_url").alias("_w")).withColumn("_hit", F.lit(True))
    same = (F.col("_y") == F.col("_x")) & F.col("eo_id").eqNullSafe(F.col("_e")) & F.col("source_pdf_url").eqNullSafe(F.col("_u"))
    rows = index.withColumn("_y", row).join(done, same, "left")
    hit = F.coalesce("_hit", F.lit(False))
    url = F.when(hit & (F.coalesce("source_pdf_url", F.lit("")) == ""), F.coalesce("_w", "source_pdf_url")).otherwise(F.col("source_pdf_url"))
    return rows.withColumns({
        "pdf_path": F.when(hit, F.col("_p")).otherwise(F.col("pdf_path")), "source": F.when(hit, ident.ARCHIVE_GAP).otherwise(F.col("source")), "source_pdf_url": url,
    }).drop("_y", "_x", "_e", "_u", "_p", "_w", "_hit")


def recovery_counts(outcomes: DataFrame) -> DataFrame:
    """One row: gaps, recovered, cached, would_recover, unrecoverable (errors too), errors."""
    of = lambda *s: F.count_if(F.col("status").isin(*s))
    return outcomes.agg(
        F.count("*").alias("gaps"), of("recovered").alias("recovered"), of("cached").alias("cached"), of("would-recover").alias("would_recover"),
        of(*UNRECOVERABLE).alias("unrecoverable"), of("error").alias("errors"),
    )
