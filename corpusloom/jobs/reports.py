"""Numbers of the reports as tables, and their Markdown. Rendered texts are the driver's, so they are for reports that fit there; long
ones are written by the tasks (``write_gaps``)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import relational as rel
from ..sources.sinks import write_file


def force_counts(corpus: DataFrame) -> DataFrame:
    """(in_effect, n, regular): records by in_effect, null too, all and regular ones."""
    return corpus.groupBy("in_effect").agg(F.count("*").alias("n"), F.count_if(~F.coalesce("is_emergency", F.lit(False))).alias("regular"))


def dangle_counts(dangles: DataFrame) -> DataFrame:
    return dangles.groupBy("reason").agg(F.count("*").alias("n"))


def most_cited(dangles: DataFrame, order: str) -> DataFrame:
    """(target, n, first): targets that no record has, the most cited first, equals by where they are seen first."""
    own = dangles.filter("reason = 'not-in-corpus'").groupBy("target").agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return own.orderBy(F.desc("n"), "first")


def split_matches(matches: DataFrame) -> DataFrame:
    """``matches`` with fate: auto (the order's only match), multiple-in-order, or the status of one that didn't match."""
    many = F.count_if(F.col("status") == "match").over(Window.partitionBy("eo_id"))
    return matches.withColumn("_m", many).withColumn(
        "fate", F.when(F.col("status") != "match", F.col("status")).when(F.col("_m") == 1, "auto").otherwise("multiple-in-order")
    ).drop("_m")


def clean_counts(cleaned: DataFrame) -> DataFrame:
    """One row of the sweep's counters: records, tiers, titles and dates filled, titles held."""
    c = F.col("clean")
    tier = lambda t: F.count_if(c["text_quality"] == t)
    return cleaned.agg(
        F.count("*").alias("records"), tier("clean").alias("clean"), tier("minor-noise").alias("minor_noise"), tier("needs-review").alias("needs_review"),
        F.count_if(c["title_extracted"]).alias("titles"), F.count_if(c["date_extracted"]).alias("dates"),
        F.count_if(F.exists(c["flags"], lambda f: f.startswith("title-uncertain"))).alias("titles_held"),
    )


def _flagged(*names: str) -> Column:
    def begins(f: Column) -> Column:
        out = F.lit(False)
        for n in names:
            out = out | f.startswith(n)
        return out

    return F.exists("clean.flags", begins)


def sample(cleaned: DataFrame, listed: list[tuple[str, list[str]]] | None = None, heavy: int = 25, few: int = 10, eras: dict[str, int] | None = None) -> DataFrame:
    """(eo_id, label) of the sample: the ids listed by label; the ``heavy`` OCR records with the longest dropped header; the first
    ``few`` that were kept for want of a safe anchor; of each era its noisiest; the first ``few`` without a title; and the first
    born-digital record that isn't in yet. An id in several strata has the first's label."""
    from ..functions.ident import era

    rows = cleaned.select(
        "eo_id", era(F.col("year").cast("int")).alias("era"), "text_source", F.length("clean.dropped_header").alias("noise"), (F.trim(F.coalesce("title", F.lit(""))) == "").alias("untitled"),
        _flagged("anchor-after-body-start", "large-header-trim-skipped").alias("ambiguous"),
    )
    rows = rows.persist()  # a short row a record, read by every stratum
    ocr = rows.filter("text_source = 'ocr'")
    worst = [F.desc("noise"), F.col("eo_id")]
    strata = [(name, rows.filter(F.col("eo_id").isin(*ids))) for name, ids in listed or []]
    strata += [("heavy-noise", ocr.orderBy(*worst).limit(heavy)), ("ambiguous", ocr.filter("ambiguous").orderBy("eo_id").limit(few))]
    quota = {"1974-2001": 10, "2002-2021": 6, "2022-2026": 12} if eras is None else eras
    for name, n in quota.items():
        strata.append((f"era-{name}", ocr.filter(F.col("era") == name).orderBy(*worst).limit(n)))
    strata.append(("empty-title", ocr.filter("untitled").orderBy("eo_id").limit(few)))
    chosen = rel.first_label(strata, "eo_id")
    extra = rows.filter("text_source = 'born-digital'").join(chosen, "eo_id", "left_anti").orderBy("eo_id").limit(1)
    return chosen.unionByName(extra.select("eo_id", F.lit("extra-control").alias("label")))


def sample_counts(cleaned: DataFrame, chosen: DataFrame) -> DataFrame:
    """(label, n, ocr, untitled, accepted, held, undated, dated): a sample's strata and outcomes."""
    rows = cleaned.join(chosen, "eo_id")
    untitled = F.trim(F.coalesce("title", F.lit(""))) == ""
    ocr = F.col("text_source") == "ocr"
    undated = F.coalesce("date_signed", F.lit("")) == ""
    return rows.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(ocr).alias("ocr"), F.count_if(ocr & untitled).alias("untitled"), F.count_if(ocr & untitled & F.col("clean.title_extracted")).alias("accepted"),
        F.count_if(ocr & untitled & _flagged("title-uncertain")).alias("held"), F.count_if(ocr & undated).alias("undated"), F.count_if(ocr & undated & F.col("clean.date_extracted")).alias("dated"),
    )


def body_diff(raw: Column, clean: Column, most: int = 100) -> Column:
    """Unified diff of two bodies, at most ``most`` lines and a note that more were left out (an Arrow UDF; a report's feature)."""
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        import difflib

        def one(a: str | None, b: str | None) -> str:
            lines = list(difflib.unified_diff((a or "").splitlines(), (b or "").splitlines(), "raw", "cleaned", lineterm=""))
            return "\n".join(lines[:most] + (["... (truncated)"] if len(lines) > most else []))

        for a, b in parts:
            yield pd.Series([one(x, y) for x, y in zip(a, b, strict=True)])

    return F.pandas_udf(run, "string")(raw, clean)


#: Numbers of a line of a report at most.
LINE = 1000


def gap_tables(manifest: DataFrame) -> dict[str, DataFrame]:
    """missing (year, series, part, numbers), unparsed, unresolved and errors of a manifest; a series has a row for every ``LINE`` numbers."""
    series = F.when(F.coalesce("is_emergency", F.lit(False)), "emergency").otherwise("regular")
    missing = rel.missing_numbers(manifest.withColumn("series", series), ["year", "series"], F.col("number"))
    missing = missing.groupBy("year", "series", F.floor(F.col("missing") / LINE).alias("part"))
    return {
        "missing": missing.agg(F.array_join(F.array_sort(F.collect_list("missing")), ", ").alias("numbers")),
        "unparsed": manifest.filter("number IS NULL"), "unresolved": manifest.filter(~F.coalesce("pdf_resolved", F.lit(False))), "errors": manifest.filter("download_status = 'error'"),
    }


def _gap_sections(manifest: DataFrame, outcomes: DataFrame | None) -> list[tuple[str, list[str], DataFrame]]:
    """(title, table head, lines as value in _order) of each section of the gaps' report."""
    t = gap_tables(manifest)
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    table = lambda df, order, *cells: df.select(F.struct(*order).alias("_order"), F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, cells)), F.lit(" |")).alias("value"))
    item = F.concat(F.lit("- "), cell("eo_id"), F.lit(" — "), cell("title"), F.lit(" ("), cell("article_url"), F.lit(")"))
    listed = lambda df: df.select(F.struct("eo_id", "title", "article_url").alias("_order"), item.alias("value"))
    out = [
        ("Missing numbers within a year's sequence", ["year", "series", "missing numbers"], table(t["missing"], ["year", "series", "part"], "year", "series", "numbers")),
        ("Orders with an unparsed EO number", [], listed(t["unparsed"])), ("Orders whose PDF URL could not be resolved", [], listed(t["unresolved"])),
        ("Download errors", ["eo_id", "source_pdf_url", "error"], table(t["errors"], ["eo_id", "source_pdf_url"], "eo_id", "source_pdf_url", "download_error")),
    ]
    if outcomes is not None:
        from .harvest import UNRECOVERABLE

        good = outcomes.filter(F.col("status").isin("recovered", "cached")).withColumn("wayback_url", F.coalesce("wayback_url", F.lit("(on disk)")))
        bad = outcomes.filter(F.col("status").isin(*UNRECOVERABLE)).withColumn("reason", F.coalesce("reason", "status"))
        out.append(("Recovered via the archive", ["eo_id", "archive address", "pdf_path"], table(good, ["eo_id", "wayback_url"], "eo_id", "wayback_url", "pdf_path")))
        out.append(("Unrecoverable", ["eo_id", "candidate_url", "reason"], table(bad, ["eo_id", "candidate_url"], "eo_id", "candidate_url", "reason")))
    return out


def _head(head: list[str]) -> list[str]:
    return [f"| {' | '.join(head)} |", "|" + "---|" * len(head)] if head else []


def _table(head: list[str], rows: list[tuple], none: str = "_None._") -> list[str]:
    if not rows:
        return [none, ""]
    cell = lambda v: "" if v is None else str(v)
    return [f"| {' | '.join(head)} |", "|" + "---|" * len(head), *(f"| {' | '.join(map(cell, r))} |" for r in rows), ""]


TITLE = "# Harvest gaps & errors"


def render_gaps(manifest: DataFrame, outcomes: DataFrame | None = None) -> str:
    """Markdown of a manifest's gaps: missing numbers, rows without number, without address, with errors; and, with
    ``outcomes`` of a recovery, what it recovered and what it couldn't. The text is the driver's: ``write_gaps`` writes it at any size."""
    lines = [TITLE, ""]
    for title, head, rows in _gap_sections(manifest, outcomes):
        own = [r.value for r in rows.orderBy("_order").select("value").collect()]
        lines += [f"## {title}", "", *([*_head(head), *own] if own else ["_None._"]), ""]
    return "\n".join(lines)


def write_gaps(spark: SparkSession, path: str, manifest: DataFrame, outcomes: DataFrame | None = None) -> None:
    """The report of ``render_gaps`` as a file, whose lines are written in parts by the tasks."""
    sections, before = [], f"{TITLE}\n\n"
    for title, head, rows in _gap_sections(manifest, outcomes):
        none = rows.isEmpty()
        sections.append(("\n".join([f"{before}## {title}", "", *([] if none else _head(head)), ""]), rows, "\n", "_None._\n\n" if none else "\n\n"))
        before = ""
    write_file(spark, path, [(*s[:3], s[3].removesuffix("\n") if i == len(sections) - 1 else s[3]) for i, s in enumerate(sections)])


def render_graph(corpus: DataFrame, edges: DataFrame, dangles: DataFrame, extensions: int, matches: DataFrame, order: str = "target") -> str:
    """Markdown of the graph: edges by verb and source, in_effect, dangles, entities."""
    cross = edges.groupBy("verb").agg(F.count_if(F.col("source") == "body-citation").alias("b"), F.count_if(F.col("source") == "header-xref").alias("x"), F.count("*").alias("n"), F.count_if("partial").alias("p")).orderBy("verb").collect()
    total = [sum(r[k] for r in cross) for k in ("b", "x", "n", "p")]
    force = {r.in_effect: (r.n, r.regular) for r in force_counts(corpus).collect()}
    reasons = [tuple(r) for r in dangle_counts(dangles).orderBy("reason").collect()]
    fates = split_matches(matches)
    auto = [tuple(r) for r in fates.filter("fate = 'auto'").orderBy("eo_id").select("eo_id", "raw_name", "registry_id").collect()]
    review = [tuple(r) for r in fates.filter("fate <> 'auto'").orderBy("eo_id", "raw_name").select("eo_id", "raw_name", "fate").collect()]
    lines = ["# Supersession graph", "", f"Records {sum(v[0] for v in force.values())}, edges {total[2]}, dangling citations {sum(n for _, n in reasons)}, extensions skipped {extensions}.", ""]
    lines += ["## Edges by verb and provenance", "", *_table(["verb", "body-citation", "header-xref", "total"], [*((r.verb, r.b, r.x, r.n) for r in cross), ("**all**", *total[:3])]), f"Partial edges, which leave their target in force: {total[3]}.", ""]
    lines += ["## `in_effect`", "", *_table(["value", "all", "regular only"], [(str(k).lower() if k is not None else "null", *force.get(k, (0, 0))) for k in (False, None, True)])]
    lines += ["## Dangling citations", "", *_table(["reason", "count"], reasons), *_table(["target that no record has", "cited"], [(r.target, r.n) for r in most_cited(dangles, order).collect()])]
    lines += ["## Established entities", "", *_table(["eo_id", "name", "registry id"], auto), *_table(["eo_id", "name", "reason for review"], review)]
    return "\n".join(lines)


def render_integration(counts: DataFrame, states: DataFrame, before: int, result: dict | None = None) -> str:
    """Markdown of the second source: dispositions, staging, and, after a run, what it did."""
    from .integrate import MINTED, staging_summary

    n = {r.disposition: r.n for r in counts.collect()}
    s = staging_summary(states).first()
    order = ("net-new", "gap-closer-mint", "gap-closer-existing", "dual", "volume", "excluded")
    minted = sum(n.get(d, 0) for d in MINTED) if result is None else result["minted"]
    lines = ["# Second-source integration", "", "## Dispositions", "", *_table(["disposition", "orders"], [(d, n.get(d, 0)) for d in order])]
    lines += [f"Corpus: {before} → {before + minted} ({minted} minted).", "", "## Staging", ""]
    lines += [f"{s.present} of {s.expected} files present; missing {s.missing}, corrupt {s.corrupt}, extra {s.extra}.", ""]
    if result is not None:
        lines += ["## This run", "", *(f"- {k}: {v}" for k, v in result.items()), ""]
    return "\n".join(lines)


def probe_report(probes: DataFrame) -> DataFrame:
    """(text, scanned, error) counts of probed files, zero where there are none."""
    of = lambda c: F.count_if(F.col("classification") == c)
    return probes.agg(of("text").alias("text"), of("scanned").alias("scanned"), of("error").alias("error"))
