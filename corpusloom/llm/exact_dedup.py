"""Exact deduplication by progressive refinement, in DataFrame functions only.

1. One read of the texts gives a narrow table: id, byte length, hash of a prefix.
2. Of it, only rows of a length that occurs twice are grouped by (length, prefix).
3. Only texts of a (length, prefix) that occurs twice have their full content hashed, and are grouped by that hash.

What survives a step reaches the next one's scan as a bit table, sized by the number of its keys up to ``TABLE_BITS``; a
set bit may be shared by another key, which costs a hash and changes no result. (Beyond some 16 million keys the table
fills up, and in the end every text is hashed.) No text is shuffled for deciding: only ids, lengths and hashes are.
Groups are aggregated before they are joined, and read back from a table, so that a group of a third of all rows is one
row on one side of the join and is split on the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import bits_for, materialize

#: Characters of a text that the second step hashes.
PREFIX = 64
#: Most bits of a table: 32 MB.
TABLE_BITS = 1 << 28
#: Bits of the table of lengths, exact below so many bytes.
LENGTH_BITS = 1 << 24


def bit_table(keys: DataFrame, bit: Column) -> DataFrame:
    """(_slot, _map): one bitmap of 4 KB for each slot that has bits."""
    return (
        keys.select(bit.alias("_bit"))
        .groupBy(F.bitmap_bucket_number("_bit").alias("_slot"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_map"))
    )


def test_bit(df: DataFrame, bit: Column, table: DataFrame, name: str) -> DataFrame:
    """``df`` with the boolean ``name``: whether the bit is set in the (broadcast, size-bounded) table."""
    df = df.withColumn("_bit", bit).withColumn("_at", F.bitmap_bucket_number("_bit"))
    df = df.join(F.broadcast(table), F.col("_at") == F.col("_slot"), "left")
    position = F.bitmap_bit_position("_bit")
    byte = F.conv(F.hex(F.substring(F.col("_map"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
    return df.withColumn(name, held).drop("_bit", "_at", "_slot", "_map")


def _slot(bits: int, *keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def _table(keys: DataFrame, columns: list[str], most: int) -> tuple[DataFrame, int]:
    """The bit table of ``keys`` (read twice: they are counted first) and its number of bits."""
    bits = min(most, bits_for(keys.count()))
    return bit_table(keys, _slot(bits, *map(F.col, columns))), bits


def _refined(docs: DataFrame, id_col: str, text_col: str, extra: list[Column], digest: bool, most: int) -> DataFrame:
    """The rows of ``docs`` as (_id, _len, extra columns, _maybe, _sha): _sha where the text may have an equal, or with ``digest`` always."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    length, prefix = F.octet_length(text).cast("long"), F.xxhash64(F.substring(text, 1, PREFIX))
    narrow = materialize(docs.select(length.alias("_len"), prefix.alias("_pre")), "exact-narrow")
    lengths = narrow.groupBy("_len").agg(F.count("*").alias("_n")).filter("_n > 1")
    at = F.pmod(F.col("_len"), F.lit(LENGTH_BITS))
    second = test_bit(narrow, at, bit_table(lengths, at), "_again").filter("_again")
    second = second.groupBy("_len", "_pre").agg(F.count("*").alias("_n")).filter("_n > 1").select("_len", "_pre")
    table, bits = _table(materialize(second, "exact-prefixes"), ["_len", "_pre"], most)
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), length.alias("_len"), prefix.alias("_pre"), *extra)
    rows = test_bit(rows, _slot(bits, F.col("_len"), F.col("_pre")), table, "_maybe")
    sha = F.sha2(F.col("_text"), 256)
    return rows.withColumn("_sha", sha if digest else F.when(F.col("_maybe"), sha)).drop("_text", "_pre")


def _groups(rest: DataFrame, least: int = 2) -> DataFrame:
    """(_glen, _gsha, keep_id, group_size, _same) of the texts that ``least`` rows have; _same is how many of them have keep_id."""
    by_id = rest.groupBy("_len", "_sha", "_id").agg(F.count("*").alias("_n"))
    groups = by_id.groupBy(F.col("_len").alias("_glen"), F.col("_sha").alias("_gsha")).agg(
        F.max("_id").alias("keep_id"),
        F.sum("_n").alias("group_size"),
        F.coalesce(F.max_by("_n", "_id"), F.sum("_n")).alias("_same"),
    )
    return materialize(groups.filter(F.col("group_size") >= least), "exact-groups")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, table_bits: int = TABLE_BITS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept[, text_sha256]) for every row of ``docs``.

    Null text equals the empty text. The largest id of a group of equal texts stays; a null id stays
    only where the group has no other. Repeated rows (same id, same text) all show kept = true here;
    ``drop_exact_duplicates`` keeps one of them. No rows give no rows; columns other than the two
    named are not read. ``digest`` adds the SHA-256 of every text, single ones included.
    """
    rows = materialize(_refined(docs, id_col, text_col, [], digest, table_bits), "exact-rows")
    rest = rows.filter("_maybe")
    joined = rest.join(_groups(rest), (F.col("_len") == F.col("_glen")) & (F.col("_sha") == F.col("_gsha")), "left")
    single = F.col("group_size").isNull()
    more = [F.col("_sha").alias("text_sha256")] if digest else []
    out = rows.filter("NOT _maybe").select("_id", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), *more)
    out = out.unionByName(joined.select("_id", F.when(single, F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"), *more))
    kept = F.col("_id").eqNullSafe(F.col("keep_id"))
    return out.select(F.col("_id").alias("doc_id"), "keep_id", "group_size", kept.alias("kept"), *(["text_sha256"] if digest else []))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bits: int = TABLE_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct text, with all their columns.

    Null and empty texts are one text; the row with the largest id stays (null is less than any), one of them if several have it. No rows
    give no rows; extra columns, whatever their names, stay with their row. Which stays is decided on the narrow rows. Of the texts that may have an equal only those that stay are shuffled, to be
    joined with that decision: other copies are left out where they are read, by a bit table of (length, hash, id).
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    refined = _refined(docs, id_col, text_col, [row], False, table_bits)
    rest = materialize(refined.filter("_maybe").select("_id", "_len", "_sha"), "exact-rows")
    stays = _groups(rest, 1).select("_glen", "_gsha", F.col("keep_id").alias("_gid"), "_same")
    table, bits = _table(stays, ["_glen", "_gsha", "_gid"], table_bits)
    found = test_bit(refined.filter("_maybe"), _slot(bits, F.col("_len"), F.col("_sha"), F.col("_id")), table, "_stays").filter("_stays")
    on = (F.col("_len") == F.col("_glen")) & (F.col("_sha") == F.col("_gsha")) & F.col("_id").eqNullSafe(F.col("_gid"))
    found = found.join(stays, on)
    once = found.filter("_same = 1").select("_row")
    repeated = found.filter("_same > 1").dropDuplicates(["_glen", "_gsha"]).select("_row")
    return refined.filter("NOT _maybe").select("_row").unionByName(once).unionByName(repeated).select("_row.*")
