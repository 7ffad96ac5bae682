"""Second source: its items to orders, dispositions against the corpus, staged files, and the additive merge with provenance."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ident
from ..operators import relational as rel
from ..sources.state import State, merged

# Items whose titles defeat the parser (id: kind, number); items that are no orders; orders known to be missing.
RESCUED = {"f1881n57p": ("eeo", "99"), "jw827d19v": ("eo", "55"), "3b591d01g": ("eeo", "526")}
EXCLUDED = ("bz60d0174", "3f4628695", "n296x281t", "kd17cz294", "6682x8019", "4m90f205b", "nz8063533")
KNOWN_MISSING = [("de Blasio", False, str(n)) for n in (23, 25, 29, 30, 31, 33, 37, 38, 46, 48, 56, 61, 68, 69, 80, 82, 86, 87, 88)] + [("Koch", False, "9")]
KEYS = ["mayor", "is_emergency", "number"]
MINTED = ("net-new", "gap-closer-mint")


class LostRecords(RuntimeError):
    """An additive merge lost records."""


def items(inventory: DataFrame, terms: list[tuple[int, int, str]], creators: dict[str, str], rescued: dict[str, tuple[str, str]] | None = None,
          excluded: tuple[str, ...] = EXCLUDED) -> DataFrame:
    """Items (gpp_id, title, date_published, creators, description, fileset_ids, kind, label, rescued, mayor, year, is_emergency,
    number, route, reason) of an inventory (id, t, dp, cr, fs, desc).

    The rescue table replaces what the title says; the mayor is the first creator known, else the year's. route: excluded,
    volume, unparsed or order, in this precedence.
    """
    table = RESCUED if rescued is None else rescued
    parsed = ident.title_kind(F.col("t"))
    if table:
        known = F.create_map(*(x for k, (kind, n) in table.items() for x in (F.lit(k), F.struct(F.lit(kind).alias("kind"), F.lit(n).alias("number")))))
        fixed = F.try_element_at(known, F.col("id"))
    else:
        fixed = F.lit(None).cast("struct<kind: string, number: string>")
    rows = inventory.withColumn("_k", F.coalesce(fixed, parsed)).withColumn("rescued", fixed.isNotNull()).withColumn("year", ident.year_of(F.col("dp")))
    parts = F.transform(F.split(F.coalesce("cr", F.lit("")), "[;,]"), lambda p: F.lower(ident.strip(p)))
    rows = rel.in_range(rows, F.col("year"), terms, "_term").withColumn("mayor", F.coalesce(rel.first_known(parts, creators), "_term"))
    kind = F.col("_k.kind")
    route = F.when(F.col("id").isin(*excluded), "excluded").when(kind == "volume", "volume").when(kind == "unparsed", "unparsed").otherwise("order")
    rows = rows.withColumn("route", route)
    reason = F.when(route == "excluded", "no order, or without a file").when(route == "unparsed", F.concat(F.lit("unparseable title: "), F.substring(F.coalesce("t", F.lit("")), 1, 80)))
    return rows.select(
        F.col("id").alias("gpp_id"), F.coalesce("t", F.lit("")).alias("title"), F.col("dp").alias("date_published"), F.coalesce("cr", F.lit("")).alias("creators"),
        F.coalesce("desc", F.lit("")).alias("description"), ident.fileset_ids(F.col("fs")).alias("fileset_ids"), kind.alias("kind"), F.col("_k.number").alias("label"),
        "rescued", "mayor", "year", (kind == "eeo").alias("is_emergency"), ident.norm_number(F.col("_k.number")).alias("number"), "route", reason.alias("reason"),
    )


def orders(parsed: DataFrame) -> DataFrame:
    """Distinct orders of items routed to one: keys, year (of the first item by id that has one), primary (its item: rescued last, then by
    id), gpp_ids and fileset_ids in order of items, distinct. An order's items are scans of one document, so a row holds them."""
    own = F.struct("gpp_id", "fileset_ids", "year")
    sorted_items = F.array_sort(F.collect_list(own))
    rows = parsed.filter("route = 'order'").groupBy(*KEYS).agg(
        sorted_items.alias("items"), F.min_by(F.struct("title", "label", "date_published", "gpp_id"), F.struct("rescued", "gpp_id")).alias("primary")
    )
    years = F.filter(F.transform("items", lambda i: i["year"]), lambda y: y.isNotNull())
    return rows.select(
        *KEYS, F.try_element_at(years, F.lit(1)).alias("year"), "primary", F.transform("items", lambda i: i["gpp_id"]).alias("gpp_ids"),
        F.array_distinct(F.flatten(F.transform("items", lambda i: i["fileset_ids"]))).alias("fileset_ids"),
        F.flatten(F.transform("items", lambda i: F.transform(i["fileset_ids"], lambda f: F.struct(i["gpp_id"].alias("gpp_id"), f.alias("fileset_id"))))).alias("files"),
    )


def plan(parsed: DataFrame, corpus: DataFrame, ledger: DataFrame | None = None, known_missing: list[tuple[str, bool, str]] | None = None) -> DataFrame:
    """``orders`` with disposition, eo_id, corpus_eo_ids and already_integrated.

    A prior disposition of one of the matched ids (or of the id to be minted) stands, and then a minted order has no matched
    ids. Else: dual where a matched record has a file, gap-closer-existing where none has, gap-closer-mint where the order is
    known to be missing, net-new otherwise. Null keys match null keys.
    """
    key = lambda c: ident.norm_number(F.col(c).cast("string"))
    held = corpus.select(F.col("mayor").alias("_m"), F.coalesce("is_emergency", F.lit(False)).alias("_e"), key("number").alias("_n"), "eo_id", "pdf_path")
    held = held.groupBy("_m", "_e", "_n").agg(
        F.array_sort(F.collect_list("eo_id")).alias("_ids"), F.bool_or(F.coalesce("pdf_path", F.lit("")) != "").alias("_file")
    )
    on = F.col("mayor").eqNullSafe(F.col("_m")) & (F.col("is_emergency") == F.col("_e")) & F.col("number").eqNullSafe(F.col("_n"))
    rows = orders(parsed).join(held, on, "left").withColumn("minted", ident.mint_known_id(F.col("year"), F.col("number"), F.col("is_emergency")))
    rows = rows.withColumn("_asked", F.when(F.col("_ids").isNotNull(), F.col("_ids")).otherwise(F.array_compact(F.array("minted"))))
    rows = rows.withColumn("_row", F.xxhash64(*KEYS))
    if ledger is not None:
        asked = rows.select(*(F.col(k).alias(f"_{k}") for k in KEYS), F.posexplode("_asked").alias("_at", "_id"))
        hit = asked.join(ledger.select(F.col("eo_id").alias("_l"), "disposition"), F.col("_id") == F.col("_l"))
        hit = hit.groupBy(*(f"_{k}" for k in KEYS)).agg(F.min_by(F.struct("_id", "disposition"), "_at").alias("_prior"))
        rows = rows.join(hit, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS], "left")
    else:
        rows = rows.withColumn("_prior", F.lit(None).cast("struct<_id: string, disposition: string>"))
    listed = KNOWN_MISSING if known_missing is None else known_missing
    lost = F.lit(False)
    for mayor in sorted({m for m, _, _ in listed}):
        for series in (True, False):
            numbers = [n for m, e, n in listed if m == mayor and e == series]
            if numbers:
                lost = lost | ((F.col("mayor") == mayor) & (F.col("is_emergency") == series) & F.col("number").isin(*numbers))
    fresh = F.when(F.col("_file"), "dual").when(F.col("_ids").isNotNull(), "gap-closer-existing").when(F.coalesce(lost, F.lit(False)), "gap-closer-mint").otherwise("net-new")
    disposition = F.coalesce(F.col("_prior.disposition"), fresh)
    prior = F.col("_prior").isNotNull()
    none = F.array().cast("array<string>")
    ids = F.when(prior & disposition.isin(*MINTED), none).otherwise(F.coalesce("_ids", none))
    eo_id = F.when(prior, F.col("_prior._id")).when(F.col("_ids").isNotNull(), F.element_at("_ids", 1)).otherwise(F.col("minted"))
    return rows.select(*KEYS, "year", "primary", "gpp_ids", "fileset_ids", "files", disposition.alias("disposition"), eo_id.alias("eo_id"), ids.alias("corpus_eo_ids"), prior.alias("already_integrated"))


def disposition_counts(planned: DataFrame, parsed: DataFrame) -> DataFrame:
    """(disposition, n): orders by disposition, volumes, and what was excluded (unparsed titles too)."""
    aside = parsed.filter("route <> 'order'").select(F.when(F.col("route") == "volume", "volume").otherwise("excluded").alias("disposition"))
    return planned.select("disposition").unionByName(aside).groupBy("disposition").agg(F.count("*").alias("n"))


def staging(planned: DataFrame, parsed: DataFrame, staged: DataFrame) -> DataFrame:
    """(fileset_id, state): present, missing, corrupt or extra, of what orders and volumes need against what is staged."""
    wanted = planned.select(F.explode("fileset_ids").alias("fileset_id")).union(parsed.filter("route = 'volume'").select(F.explode("fileset_ids")))
    return rel.reconcile(wanted, staged.groupBy("fileset_id").agg(F.bool_or("valid").alias("valid")), "fileset_id", "valid")


def staging_summary(states: DataFrame) -> DataFrame:
    """One row: expected, present, missing, corrupt, extra, complete (nothing missing, nothing corrupt)."""
    of = lambda s: F.count_if(F.col("state") == s)
    return states.agg(
        F.count_if(F.col("state") != "extra").alias("expected"), of("present").alias("present"), of("missing").alias("missing"), of("corrupt").alias("corrupt"),
        of("extra").alias("extra"), (of("missing") + of("corrupt") == 0).alias("complete"),
    )


def placements(planned: DataFrame, parsed: DataFrame, staged: DataFrame, corpus: DataFrame, pdfs: str = "pdfs", sources: str = "sources") -> DataFrame:
    """(disposition, eo_id, gpp_id, fileset_id, role, src, dest) of every file an order or volume has.

    role: primary (the first staged, valid file of an order that is minted or closes a gap), secondary (its others), dual,
    volume. src is null where the file isn't staged or isn't a PDF; such a row has no dest.
    """
    valid = staged.filter("valid").groupBy("fileset_id").agg(F.min("path").alias("src"))
    year = F.coalesce("year", ident.id_year(F.col("eo_id")))
    files = planned.select("disposition", "eo_id", year.alias("year"), F.col("files").alias("_f")).select("disposition", "eo_id", "year", F.posexplode("_f").alias("_at", "_x"))
    files = files.select("disposition", "eo_id", "year", "_at", "_x.gpp_id", "_x.fileset_id").join(valid, "fileset_id", "left")
    first = F.row_number().over(Window.partitionBy("eo_id").orderBy(F.col("src").isNull(), "_at"))
    role = F.when(F.col("disposition") == "dual", "dual").when((F.col("_first") == 1) & F.col("src").isNotNull(), "primary").otherwise("secondary")
    files = files.withColumn("_first", first).withColumn("role", role)
    # one fileset of an order is its primary, whichever of its items names it
    own = files.filter("role = 'primary'").select(F.col("eo_id").alias("_e"), F.col("fileset_id").alias("_p"))
    files = files.join(own, F.col("eo_id") == F.col("_e"), "left").withColumn("role", F.when(F.col("fileset_id") == F.col("_p"), "primary").otherwise(F.col("role")))
    held = corpus.select(F.col("eo_id").alias("_c"), ident.id_year(F.col("eo_id")).alias("_y"))
    files = files.join(held, F.col("eo_id") == F.col("_c"), "left")
    main = ident.pdf_dest(pdfs, F.coalesce("_y", "year"), F.col("eo_id"))
    dest = F.when(F.col("src").isNotNull(), F.when(F.col("role") == "primary", main).otherwise(ident.dual_dest(sources, F.col("year"), F.col("eo_id"), F.col("fileset_id"))))
    files = files.select("disposition", "eo_id", "gpp_id", "fileset_id", "role", "src", dest.alias("dest"))
    volumes = parsed.filter("route = 'volume'").select("gpp_id", F.explode("fileset_ids").alias("fileset_id")).join(valid, "fileset_id", "left")
    volumes = volumes.select(
        F.lit("volume").alias("disposition"), F.lit(None).cast("string").alias("eo_id"), "gpp_id", "fileset_id", F.lit("volume").alias("role"), "src",
        F.when(F.col("src").isNotNull(), ident.volume_dest(sources, F.col("fileset_id"))).alias("dest"),
    )
    return files.unionByName(volumes)


def deferred(planned: DataFrame, placed: DataFrame) -> DataFrame:
    """(eo_id, gpp_id, reason) of what a later run must complete: an order without year, without a staged primary file, a dual or
    volume file that isn't staged."""
    minted = planned.filter(F.col("disposition").isin(*MINTED) & F.col("eo_id").isNull()).select("eo_id", F.element_at("gpp_ids", 1).alias("gpp_id"), F.lit("no signing year").alias("reason"))
    closers = planned.filter((F.col("disposition") != "dual") & F.col("eo_id").isNotNull() & ~F.col("already_integrated"))
    has = placed.filter("role = 'primary'").select(F.col("eo_id").alias("_e")).distinct()
    lacking = closers.join(has, F.col("eo_id") == F.col("_e"), "left_anti").select("eo_id", F.element_at("gpp_ids", 1).alias("gpp_id"), F.lit("primary file not staged").alias("reason"))
    files = placed.filter(F.col("src").isNull() & F.col("role").isin("dual", "volume")).select("eo_id", "gpp_id", F.concat(F.lit("file not staged: "), "fileset_id").alias("reason"))
    return minted.unionByName(lacking).unionByName(files)


def mint_rows(planned: DataFrame, placed: DataFrame) -> DataFrame:
    """Index rows of the orders to be minted that have a primary file; titles tidied, the documented address as source."""
    first = placed.filter("role = 'primary'").groupBy(F.col("eo_id").alias("_e")).agg(F.min("fileset_id").alias("_f"), F.min("dest").alias("_d"))
    rows = planned.filter(F.col("disposition").isin(*MINTED)).join(first, F.col("eo_id") == F.col("_e"))
    return rows.select(
        "eo_id", F.col("primary.label").alias("number"), "year", "is_emergency", F.col("primary.date_published").alias("date_signed"),
        ident.clean_title(F.col("primary.title")).alias("title"), F.lit(ident.SECOND).alias("source"), ident.download_url(F.col("_f")).alias("source_pdf_url"), F.col("_d").alias("pdf_path"),
    )


def provenance(planned: DataFrame, placed: DataFrame) -> DataFrame:
    """(eo_id, disposition, corpus_eo_ids, gpp_ids, primary_pdf, files) of every order with a place: one file entry a (item, fileset),
    sorted."""
    each = placed.filter("role <> 'volume'").withColumn("download_url", ident.download_url(F.col("fileset_id")))
    file = F.struct("gpp_id", "fileset_id", "download_url", F.col("dest").alias("local_path"), F.col("src").isNotNull().alias("staged"))
    files = each.groupBy(F.col("eo_id").alias("_e")).agg(F.array_sort(F.collect_list(file)).alias("files"), F.min(F.when(F.col("role") == "primary", F.col("dest"))).alias("primary_pdf"))
    placed_at_all = (F.col("disposition") == "dual") | F.col("primary_pdf").isNotNull() | F.col("already_integrated")
    return planned.drop("files").join(files, F.col("eo_id") == F.col("_e")).filter(placed_at_all).select("eo_id", "disposition", "corpus_eo_ids", "gpp_ids", "primary_pdf", "files")


def volumes(parsed: DataFrame, placed: DataFrame) -> DataFrame:
    """The volumes' manifest, by date (null first): paths and addresses of their files and whether any is staged."""
    file = F.struct("fileset_id", "dest")
    of = placed.filter("role = 'volume'").groupBy(F.col("gpp_id").alias("_g")).agg(F.array_sort(F.collect_list(file)).alias("_f"))
    rows = parsed.filter("route = 'volume'").join(of, F.col("gpp_id") == F.col("_g"), "left")
    paths = F.array_compact(F.transform("_f", lambda x: x["dest"]))
    return rows.select(
        "gpp_id", "title", "date_published", "description", "fileset_ids", F.coalesce(paths, F.array().cast("array<string>")).alias("local_paths"),
        F.transform("fileset_ids", ident.download_url).alias("download_urls"), (F.coalesce(F.size(paths), F.lit(0)) > 0).alias("staged"),
    ).orderBy(F.coalesce("date_published", F.lit("")), "gpp_id")


@dataclass
class Integration:
    """records: the merged corpus; plan, placed, deferred, provenance, volumes: tables as their functions say; counts: one row."""

    records: DataFrame
    plan: DataFrame
    placed: DataFrame
    deferred: DataFrame
    provenance: DataFrame
    volumes: DataFrame
    counts: DataFrame


def integrate(parsed: DataFrame, corpus: DataFrame, staged: DataFrame, parse: Callable[[DataFrame], DataFrame], ledger: DataFrame | None = None,
              known_missing: list[tuple[str, bool, str]] | None = None, check: bool = True) -> Integration:
    """Fold the second source into the corpus: orders that close a gap get their file and are parsed again in place, minted ones
    are appended, all others pass unchanged. ``parse`` makes corpus records of index rows. Never fewer records (``check``). Each
    result reads the tables given anew, so hand it tables that are written."""
    planned = plan(parsed, corpus, ledger, known_missing)
    placed = placements(planned, parsed, staged, corpus)
    primary = placed.filter("role = 'primary'").groupBy(F.col("eo_id").alias("_e")).agg(F.min("dest").alias("_d"))
    closing = planned.filter("disposition = 'gap-closer-existing'").select(F.col("eo_id").alias("_o"), "already_integrated").join(primary, F.col("_o") == F.col("_e")).drop("_e")
    touched = corpus.join(closing, F.col("eo_id") == F.col("_o")).filter(~F.col("already_integrated") | (F.coalesce("pdf_path", F.lit("")) == ""))
    again = parse(touched.withColumn("pdf_path", F.col("_d")).drop("_o", "_d", "already_integrated"))
    known = corpus.select(F.col("eo_id").alias("_k"))
    fresh = mint_rows(planned, placed)
    fresh = fresh.join(known, F.col("eo_id") == F.col("_k"), "left_anti").dropDuplicates(["eo_id"])
    new = parse(fresh)
    columns = corpus.columns
    rest = corpus.join(touched.select(F.col("eo_id").alias("_t")), F.col("eo_id") == F.col("_t"), "left_anti")
    merged = rest.unionByName(again.select(*columns)).unionByName(new.select(*columns))
    if check and merged.count() < corpus.count():
        raise LostRecords("the merge has fewer records than the corpus")
    counts = planned.agg(F.count_if(F.col("disposition") == "dual").alias("dual_orders")).crossJoin(
        fresh.agg(F.count("*").alias("minted"))).crossJoin(closing.agg(F.count("*").alias("gap_closed"))).crossJoin(placed.agg(
            F.count_if((F.col("role") == "dual") & F.col("src").isNotNull()).alias("dual_files"), F.count_if((F.col("role") == "volume") & F.col("src").isNotNull()).alias("volume_files")))
    return Integration(merged, planned, placed, deferred(planned, placed), provenance(planned, placed), volumes(parsed, placed), counts)


LEDGER = "eo_id string, disposition string"


def integrate_kept(state: State, parsed: DataFrame, corpus: DataFrame, staged: DataFrame, parse: Callable[[DataFrame], DataFrame],
                   known_missing: list[tuple[str, bool, str]] | None = None, allow_shrink: bool = False) -> Integration:
    """A run of ``integrate`` over kept state: tables records, ledger, deferred and waiting of ``state``, a new version of all four.

    The items that a run defers wait, and the next run takes them up together with its own (an item that is given again replaces
    the waiting one), so a file that is staged later completes its order. Decisions of earlier runs stand. The first run starts from ``corpus``, later
    ones from the kept records. Fewer records than before are an error and leave the old version.
    """
    known = state.pointer()["version"] > 0
    items = merged(state.read("waiting", parsed.schema), parsed, ["gpp_id"])
    ledger = state.read("ledger", LEDGER)
    done = integrate(items, state.read("records", corpus.schema) if known else corpus, staged, parse, ledger, known_missing, check=False)
    late = done.deferred.select("gpp_id").distinct()
    own = done.plan.select(F.explode("gpp_ids").alias("gpp_id"), F.col("gpp_ids").alias("_all")).join(late, "gpp_id").select(F.explode("_all").alias("gpp_id"))
    waiting = items.join(late.union(own).distinct(), "gpp_id", "left_semi")
    decided = merged(ledger, done.provenance.select("eo_id", "disposition"), ["eo_id"])
    state.save({"records": done.records, "ledger": decided, "deferred": done.deferred, "waiting": waiting}, ("records",) if known else (), allow_shrink)
    return done
