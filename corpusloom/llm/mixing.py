"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1 (piecewise linear). Its integral up to t, scaled so
that it ends at the source's target, is the source's cumulative token demand D(t). The source's documents stand
in a fixed pseudo-random order, pass after pass until the target is met; a document that begins after c words
gets the position t with D(t) = c, and the mix is range-sorted by position. The range-sorted plan is a table, whose
rows are numbered by their partition's offset; ``mix`` and ``taken`` both read it.

The order within a source is cut into buckets by a hash of the id (as many as its rows need), and ``FAN`` buckets make a
stretch; sums over stretches, then over the buckets of a stretch, give each bucket's start, and only a bucket's rows meet
in a window. A hot source is many buckets, so no task holds a source. Texts are never shuffled for planning: only ids,
sources and sizes are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textkit import WORD, materialize

#: Weights by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
#: A source's target is at most so many times its size: no document is taken more often.
MOST = 3
#: Rows of a bucket, about.
BUCKET = 4096
#: Buckets of a stretch.
FAN = 1024
#: Schedules by rank of the source, repeating: knots (time, weight relative to the source's mean). Early,
#: even and late sources; each integrates to 1, so a schedule moves words in time and keeps the target.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))


def size_of(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def area(knots) -> list[tuple[float, float, float, float]]:
    """Segments (t0, t1, w0, slope) of a schedule."""
    return [(a[0], b[0], a[1], (b[1] - a[1]) / (b[0] - a[0])) for a, b in zip(knots, knots[1:], strict=False)]


def inverse_demand(share: Column, knots) -> Column:
    """Time at which the schedule's integral reaches ``share`` (0..1) of its whole."""
    parts = area(knots)
    sums = [0.0]
    for t0, t1, w, k in parts:
        sums.append(sums[-1] + w * (t1 - t0) + k * (t1 - t0) ** 2 / 2)
    need = share * F.lit(sums[-1])
    out = F.lit(knots[-1][0])
    for (t0, _t1, w, k), low, high in reversed(list(zip(parts, sums, sums[1:], strict=False))):
        rest = need - F.lit(low)
        if k:
            inner = (F.sqrt(F.greatest(F.lit(0.0), F.lit(w * w) + F.lit(2 * k) * rest)) - F.lit(w)) / F.lit(k)
        else:
            inner = rest / F.lit(w or 1.0)
        out = F.when(need < F.lit(high), F.lit(t0) + inner).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0)).cast("double")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, n, source_size, rank, target) from (source, n, source_size), one row a source.

    Sources rank by code point, null last. All of the sizes are shared by weight; no target exceeds ``most``
    times its source's size, and the excess is shared again by weight until none is above. In closed form:
    sources are capped in order of cap / weight as long as the cap is below the level that the rest would get.
    """
    everything = Window.partitionBy(F.lit(0))  # one row a source
    ranked = sizes.withColumn("rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*(F.lit(x) for x in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("w", w.cast("long")).withColumn("cap", F.col("source_size") * most)
    ratio = everything.orderBy(F.col("cap") / F.col("w"), "rank")
    ranked = ranked.withColumn("total", F.sum("source_size").over(everything)).withColumn("ws", F.sum("w").over(everything))
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("cb", F.coalesce(F.sum("cap").over(before), F.lit(0)))
    ranked = ranked.withColumn("wb", F.coalesce(F.sum("w").over(before), F.lit(0)))
    # capped if its cap is at most its share of what earlier (capped) sources leave
    capped = F.col("cap") / F.col("w") <= (F.col("total") - F.col("cb")) / (F.col("ws") - F.col("wb"))
    ranked = ranked.withColumn("capped", capped)
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    share = F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything)
    level = F.col("w").cast("double") * left.cast("double") / share.cast("double")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level)
    return ranked.select("source", "n", "source_size", "rank", target.alias("target"))


def plan(sized: DataFrame, weights=WEIGHTS, most: int = MOST, schedules=SCHEDULES, bucket: int = BUCKET) -> DataFrame:
    """(doc, source, size, source_size, target, pass, position), one row for each time a document is taken.

    A whole document is taken in the last, partial pass if the target reaches at
    least half of it, so a source ends within half a document of its target. Documents without words take no part
    in the mix (no row). Rows of ``sized`` stand for copies that are the same in all columns; each copy is planned apart, one after
    the other, with a number from 1.
    """
    sources = source_sizes(sized)
    goal = targets(sources, weights, most).withColumnRenamed("source", "_source")
    rows = sized.join(goal, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").filter("size > 0")
    draw = F.md5(F.coalesce(F.col("doc").cast("string"), F.lit("")).cast("binary"))
    rows = rows.withColumn("draw", draw)
    first = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("bucket", F.shiftright(first * F.ceil(F.col("n") / bucket).cast("long"), 32))
    words = F.col("size") * F.col("copies")
    held = materialize(rows.groupBy("rank", "bucket").agg(F.sum(words).alias("held")), "mixing-buckets")
    held = held.withColumn("stretch", F.floor(F.col("bucket") / FAN))
    earlier = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    stretches = held.groupBy("rank", "stretch").agg(F.sum("held").alias("whole"))
    before = F.coalesce(F.sum("whole").over(earlier("rank").orderBy("stretch")), F.lit(0))
    sums = held.join(stretches.select("rank", "stretch", before.alias("before")), ["rank", "stretch"])
    base = F.col("before") + F.coalesce(F.sum("held").over(earlier("rank", "stretch").orderBy("bucket")), F.lit(0))
    sums = sums.select(F.col("rank").alias("_rank"), F.col("bucket").alias("_bucket"), base.alias("base"))
    rows = rows.join(sums, (F.col("rank") == F.col("_rank")) & (F.col("bucket") == F.col("_bucket"))).drop("_rank", "_bucket")
    within = Window.partitionBy("rank", "bucket").orderBy("draw", "doc", "size", "mark").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.col("base") + F.coalesce(F.sum(words).over(within), F.lit(0)))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).withColumn("start", F.col("start") + (F.col("copy") - 1) * F.col("size"))
    passes = F.floor((F.col("target") - F.col("start") - F.col("size") / 2.0) / F.col("source_size")) + 1
    rows = rows.withColumn("passes", F.least(F.greatest(passes, F.lit(0)), F.lit(most)).cast("int")).filter("passes > 0")
    rows = rows.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    share = F.least((F.col("start") + F.col("pass") * F.col("source_size")) / F.col("target"), F.lit(1.0))
    position = inverse_demand(share, schedules[0])
    for i in range(1, len(schedules)):
        position = F.when(F.col("rank") % len(schedules) == i, inverse_demand(share, schedules[i])).otherwise(position)
    return rows.select("doc", "source", "size", "mark", "copies", "copy", "source_size", "target", "pass", position.alias("position"))


def _mark(docs: DataFrame) -> Column:
    """96 bits of hashes of a row's columns (but for maps, which have no hash): rows with the same mark are copies."""
    own = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    return F.concat_ws(":", F.xxhash64(*own).cast("string"), F.hash(*own).cast("string"))


def sized_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc, source, size, mark, copies) of the different rows, as a table: the texts are read once for planning."""
    rows = docs.select(F.col(id_col).alias("doc"), F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"), _mark(docs).alias("mark"))
    return materialize(rows.groupBy("doc", "source", "size", "mark").agg(F.count("*").alias("copies")), "mixing-sizes")


def source_sizes(sized: DataFrame) -> DataFrame:
    """(source, n, source_size) of ``sized``."""
    return sized.groupBy("source").agg(F.sum("copies").alias("n"), F.sum(F.col("size") * F.col("copies")).alias("source_size"))


def ordered(sized: DataFrame, **options) -> DataFrame:
    """``plan`` range-sorted by position (ties by doc, source, size, mark, copy, pass) as a table, with place: 0 for the first of the mix.

    A partition's first place is the number of rows before it; only one count for each partition reaches the driver.
    """
    keys = ["position", "doc", "source", "size", "mark", "copy", "pass"]
    rows = plan(sized, **options).repartitionByRange(*(F.col(k).asc_nulls_first() for k in keys)).sortWithinPartitions(*(F.col(k).asc_nulls_first() for k in keys))
    own = F.monotonically_increasing_id()
    rows = materialize(rows.select("*", F.shiftright(own, 33).alias("_part"), own.bitwiseAND(F.lit((1 << 33) - 1)).alias("_own")), "mixing-order")
    counts = {r["_part"]: r["n"] for r in rows.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    offsets, total = [], 0
    for part in sorted(counts):
        offsets.append((part, total))
        total += counts[part]
    offsets = sized.sparkSession.createDataFrame(offsets, "_of long, _offset long")
    rows = rows.join(F.broadcast(offsets), F.col("_part") == F.col("_of"))  # a row for each partition
    return rows.withColumn("place", F.col("_offset") + F.col("_own")).drop("_part", "_own", "_of", "_offset")


def _same(names: list[str], prefix: str = "_") -> Column:
    """Rows whose columns equal those of the same names behind ``prefix``, nulls equal."""
    on = F.lit(True)
    for c in names:
        on = on & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return on


KEY = ["doc", "source", "size", "mark"]
#: Copies whose places stand in one cell.
TOGETHER = 1024


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is taken, range-sorted by training position.

    Null text has no words and is not taken. A null source is a source of its own, the last. Rows that repeat an id, null ones too,
    are rows of their own, whatever their texts; copies that are the same in all columns are planned apart and one of them is put
    wherever one is taken. No rows give no rows. Columns keep their names.
    """
    sized = sized_rows(docs, id_col, source_col, text_col)
    order = ordered(sized, **options)
    places = order.groupBy(*KEY, F.floor(F.col("copy") / TOGETHER).alias("_part")).agg(F.collect_list("place").alias("_at"), F.max("copies").alias("_copies"))
    places = places.select(*(F.col(c).alias(f"_{c}") for c in KEY), "_at", "_copies")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    own = docs.select(F.col(id_col).alias("doc"), F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"), _mark(docs).alias("mark"), row)
    lone = own.join(places.filter("_copies = 1"), _same(KEY))
    many = sized.filter("copies > 1").select(*(F.col(c).alias(f"_{c}") for c in KEY))
    first = own.join(many, _same(KEY), "left_semi").dropDuplicates(KEY)
    rows = lone.unionByName(first.join(places.filter("_copies > 1"), _same(KEY)))
    rows = rows.select("_row", F.explode("_at").alias("_place"))
    return rows.repartitionByRange("_place").sortWithinPartitions("_place").select("_row.*")


def taken(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, times, first_place) for every row of ``docs``, from the range-sorted mix;
    first_place is the place of its first copy in the mix, null if it isn't taken.

    Null text has size 0 and is not taken; a null source is a source of its own; rows that repeat, in their id or in all columns,
    have rows of their own; other columns only tell rows apart; no rows give no rows.
    """
    sized = sized_rows(docs)
    order = ordered(sized, **options)
    sums = order.groupBy(*KEY, "copy").agg(F.count("*").alias("times"), F.min("place").alias("first_place"))
    sums = sums.select(*(F.col(c).alias(f"_{c}") for c in (*KEY, "copy")), "times", "first_place")
    goal = targets(source_sizes(sized), **{k: v for k, v in options.items() if k in ("weights", "most")})
    goal = goal.select(F.col("source").alias("_s"), "source_size", "target")
    out = sized.join(goal, F.col("source").eqNullSafe(F.col("_s"))).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    out = out.join(sums, _same([*KEY, "copy"]), "left")
    times = F.coalesce("times", F.lit(0))
    return out.select(
        F.col("doc").alias("doc_id"), "size", "source_size", "target", (times * F.col("size")).cast("long").alias("taken"),
        times.cast("long").alias("times"), "first_place",
    )
