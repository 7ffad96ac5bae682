"""Joins, windows, gaps and set operations of the corpus jobs, as DataFrame functions.

Where "first seen" decides, the caller names the ordering columns: Spark rows have no order of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ident

#: Numbers of a slice of a gap, and slices that a row is cut into at a time.
SLICE, MANY = 1 << 16, 1 << 16
#: Bits of a number's place in its slot.
SLOT = 15


def latest(df: DataFrame, keys: list[str], newest: str, seq: str) -> DataFrame:
    """The newest row of each key, ties to the earliest seen. One shuffle on the keys, rows pre-aggregated."""
    row = F.struct(F.col(newest), (-F.col(seq)).alias("_s"), F.struct("*").alias("_row"))
    return df.groupBy(*keys).agg(F.max(row).alias("_best")).select("_best._row.*")


def latest_by_identity(df: DataFrame, identity: str, fallback: str, newest: str, seq: str) -> DataFrame:
    """``latest`` over rows with an identity, and the first seen of each fallback name among the rest."""
    good = latest(df.filter(F.col(identity).isNotNull()), [identity], newest, seq)
    first = Window.partitionBy(fallback).orderBy(seq)
    bad = df.filter(F.col(identity).isNull()).withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
    return good.unionByName(bad)


def collapse_duplicates(df: DataFrame, key: str, value: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, conflicts): the first row of each (key, value), null values equal; and one row (key, first_value,
    value) for each later distinct value of a key."""
    same = Window.partitionBy(key, value).orderBy(*order)
    kept = df.withColumn("_n", F.row_number().over(same)).filter("_n = 1").drop("_n")
    own = Window.partitionBy(key).orderBy(*order)
    first = kept.withColumn("_first", F.first(value).over(own))
    conflicts = first.filter(~F.col("_first").eqNullSafe(F.col(value))).select(key, F.col("_first").alias("first_value"), value)
    return kept, conflicts


def prefer_first(live: DataFrame, other: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(merged, dropped): all of ``live`` and the rows of ``other`` whose key it lacks; the keys dropped."""
    merged = live.unionByName(other.join(live.select(key).distinct(), key, "left_anti"))
    return merged, other.join(live.select(key).distinct(), key, "left_semi").select(key)


def missing_numbers(df: DataFrame, keys: list[str], number: Column) -> DataFrame:
    """(keys, missing): each number between a group's least and largest that it lacks. Labels that aren't all
    digits don't count.

    A group's numbers are bits of slots, added up before they are shuffled, so a long or hot series is as many rows as it has slots. The zero bits
    between a slot's least and largest number are missing, and what lies between neighbouring slots.
    """
    label = ident.strip(number.cast("string"))
    rows = df.withColumn("_n", F.when(label.rlike(r"^\d+$"), label.try_cast("long"))).filter("_n IS NOT NULL")
    bit = F.col("_n").bitwiseAND(F.lit((1 << SLOT) - 1))
    slots = rows.groupBy(*keys, F.shiftright("_n", SLOT).alias("_slot")).agg(
        F.bitmap_construct_agg(bit).alias("_map"), F.min("_n").alias("_lo"), F.max("_n").alias("_hi")
    )
    base = F.shiftleft("_slot", SLOT)
    byte = lambda i: F.conv(F.hex(F.substring("_map", F.floor(i / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    zero = lambda i: F.floor(byte(i) / F.element_at(F.array(*(F.lit(1 << k) for k in range(8))), (i % 8).cast("int") + 1)) % 2 == 0
    inner = slots.select(*keys, base.alias("_base"), F.explode(F.filter(F.sequence(F.col("_lo") - base, F.col("_hi") - base), zero)).alias("_i"))
    inner = inner.select(*keys, (F.col("_base") + F.col("_i")).alias("missing"))
    after = F.lead("_lo").over(Window.partitionBy(*keys).orderBy("_slot"))  # a row a slot
    gaps = slots.select(*keys, F.col("_hi").alias("_n"), after.alias("_next")).filter("_next > _n + 1")
    # a wide gap is cut into slices, so that no row holds more than SLICE numbers
    slices = gaps.select(*keys, "_n", "_next", F.explode(F.sequence(F.lit(0), F.least(F.floor((F.col("_next") - F.col("_n") - 2) / SLICE), F.lit(MANY)).cast("int"))).alias("_s"))
    slices = slices.withColumn("_s", F.col("_s").cast("long"))
    # past MANY slices, each of them takes every MANY + 1st one more
    further = F.sequence(F.col("_s"), F.floor((F.col("_next") - F.col("_n") - 2) / SLICE), F.lit(MANY + 1).cast("long"))
    slices = slices.select(*keys, "_n", "_next", F.explode(further).alias("_s"))
    low = F.col("_n") + 1 + F.col("_s") * SLICE
    return inner.unionByName(slices.select(*keys, F.explode(F.sequence(low, F.least(low + SLICE - 1, F.col("_next") - 1))).alias("missing")))


def in_range(df: DataFrame, value: Column, ranges: list[tuple[int, int, str]], name: str) -> DataFrame:
    """Label of the first range that holds ``value`` (a fixed table of a few rows, so a CASE, not a join)."""
    label = F.lit(None).cast("string")
    for lo, hi, text in reversed(ranges):
        label = F.when(value.between(lo, hi), F.lit(text)).otherwise(label)
    return df.withColumn(name, label)


def first_known(parts: Column, known: dict[str, str]) -> Column:
    """The label of the first part that the fixed table knows."""
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    return F.try_element_at(F.filter(F.transform(parts, lambda p: F.try_element_at(table, p)), lambda x: x.isNotNull()), F.lit(1))


def reconcile(expected: DataFrame, present: DataFrame, key: str, valid: str) -> DataFrame:
    """(key, state): present, corrupt, missing or extra, by a full outer join."""
    e = expected.select(F.col(key), F.lit(True).alias("_e")).distinct()
    p = present.select(F.col(key), F.col(valid).alias("_v"))
    state = (
        F.when(F.col("_e").isNull(), "extra").when(F.col("_v").isNull(), "missing").when(F.col("_v"), "present").otherwise("corrupt")
    )
    return e.join(p, key, "full_outer").select(key, state.alias("state"))


def _first_of(rows: DataFrame, candidates: Column, best: DataFrame, key: Callable[[Column], Column], found: list[str]) -> DataFrame:
    """``rows`` with candidate and ``found`` of the first of its candidates whose ``key`` is an ``_h`` of ``best``, one row a key.

    Each different list of candidates is looked up once and joined back by the list, so rows need no identity and stay as many as
    they are, repeated and null ids too. A list that is empty or null has no hit.

    Keys come out of an explosion: as expressions of a join's condition they would be worked out again for every comparison of its sort, and as plain
    columns by each filter that is pushed to them. Keys, and lists, begin alike, so a hash goes before each, by which most comparisons are settled.
    """
    hashed = lambda name: F.xxhash64(name).alias(f"{name}x")
    asked = rows.withColumn("_c", candidates)
    asked = asked.select("*", hashed("_c"))
    lists = asked.select(F.col("_cx").alias("_lx"), F.col("_c").alias("_l")).distinct()  # an empty one gives no candidate
    each = lists.select("_lx", "_l", F.posexplode(F.transform("_l", lambda c: F.struct(c.alias("candidate"), key(c).alias("_k")))).alias("_pos", "_e"))
    each = each.select("_lx", "_l", "_pos", "_e.*")
    each, best = each.select("*", hashed("_k")), best.select("*", hashed("_h"))
    got = each.join(best, (F.col("_kx") == F.col("_hx")) & (F.col("_k") == F.col("_h")))
    pick = got.groupBy("_lx", "_l").agg(F.min(F.struct("_pos", "candidate", *found)).alias("_p"))
    back = (F.col("_cx") == F.col("_lx")) & (F.col("_c") == F.col("_l"))
    return asked.join(pick, back, "left").select(*rows.columns, "_p.candidate", *(f"_p.{c}" for c in found))


def first_hit(rows: DataFrame, candidates: Column, hits: DataFrame) -> DataFrame:
    """``first_candidate`` over archive captures: PDFs answered with 200 only, the newest of the first candidate that has one,
    ties to the least address, then digest; adds candidate, timestamp and original. An address and a candidate are the same if
    their archive keys are."""
    good = hits.filter((F.col("mimetype") == "application/pdf") & (F.col("statuscode") == 200))
    good = good.select("timestamp", "original", "digest", F.explode(F.array(ident.url_key(F.col("original")))).alias("_h"))
    newest = F.struct((-F.unix_micros("timestamp")).alias("_age"), "original", "digest", "timestamp")
    best = good.groupBy(F.xxhash64("_h").alias("_x"), "_h").agg(F.min(newest).alias("_b")).select("_h", "_b.timestamp", "_b.original")
    return _first_of(rows, candidates, best, ident.url_key, ["timestamp", "original"])


def first_candidate(rows: DataFrame, candidates: Column, hits: DataFrame, hit_key: str, newest: str) -> DataFrame:
    """``rows`` with the first of its ordered candidates that has a hit, and that candidate's newest hit."""
    best = hits.groupBy(F.col(hit_key).alias("_h")).agg(F.max(newest).alias(newest))
    return _first_of(rows, candidates, best, lambda c: c, [newest])


def lookup_unique(names: DataFrame, name: str, registry: DataFrame, reg_name: str, reg_id: str) -> DataFrame:
    """Exact lookup that tells ambiguity: status match, ambiguous or no-match, and the id of a match."""
    index = registry.filter(F.col(reg_name) != "").groupBy(F.col(reg_name).alias("_k")).agg(
        F.min(reg_id).alias("_id"), (F.min(reg_id) != F.max(reg_id)).alias("_many")
    )
    out = names.join(index, F.col(name) == F.col("_k"), "left")
    status = F.when(F.col("_k").isNull(), "no-match").when(F.col("_many"), "ambiguous").otherwise("match")
    return out.withColumn("status", status).withColumn("match_id", F.when(F.col("status") == "match", F.col("_id"))).drop("_k", "_id", "_many")


def classify(groups: DataFrame, corpus: DataFrame, ledger: DataFrame, keys: list[str], known_missing: DataFrame) -> DataFrame:
    """Disposition of each group: the ledger's if it has one, else by whether the corpus has the key with a file.

    dual (any match with a file), gap-existing (matches, none with a file), gap-mint (a key known to be missing),
    net-new. Null keys match null keys.
    """
    held = corpus.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.bool_or("has_file").alias("_file"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    out = groups.join(held, on, "left").drop(*(f"_{k}" for k in keys))
    lost = known_missing.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct().withColumn("_lost", F.lit(True))
    out = out.join(lost, on, "left").drop(*(f"_{k}" for k in keys))
    prior = ledger.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("disposition").alias("_prior"))
    out = out.join(prior, on, "left").drop(*(f"_{k}" for k in keys))
    fresh = F.when(F.col("_file"), "dual").when(F.col("_file").isNotNull(), "gap-existing").when(F.col("_lost"), "gap-mint").otherwise("net-new")
    return out.withColumn("disposition", F.coalesce("_prior", fresh)).drop("_file", "_lost", "_prior")


def backfill(df: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """``column`` filled from ``updates`` (key, column) where it is null or empty; of several updates of a key the least counts."""
    new = updates.groupBy(F.col(key).alias("_k")).agg(F.min(column).alias("_v"))
    kept = F.when(F.coalesce(F.col(column), F.lit("")) == "", F.coalesce("_v", F.col(column))).otherwise(F.col(column))
    return df.join(new, F.col(key) == F.col("_k"), "left").withColumn(column, kept).drop("_k", "_v")


def top_by_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_n") <= n).drop("_n")


def first_label(strata: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Union of strata; a key in several keeps the label of the earliest."""
    parts = [d.select(key).withColumn("_r", F.lit(i)).withColumn("label", F.lit(n)) for i, (n, d) in enumerate(strata)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(key).agg(F.min_by("label", "_r").alias("label"))
