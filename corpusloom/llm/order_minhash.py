"""Order MinHash fingerprints.

Character k-mers are numbered by occurrence, so repeats count. For each of ``SKETCHES`` hash orders the
``TUPLE`` least (k-mer, occurrence) pairs are selected, put back in text order, and their k-mers are hashed
as one tuple to a 32-bit value. The share of equal values of two fingerprints estimates how likely both texts
have the same selected k-mers in the same order, which falls with edit distance, not only with overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import SpanHash, mix64, random_words

KMER = 8
TUPLE = 2
SKETCHES = 48
_A = (random_words(31, SKETCHES) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_X = (random_words(37, SKETCHES) >> np.uint64(32)).astype(np.uint32)
_SEED = random_words(41, TUPLE + 1)
_BLOCK = 4096


def _occurrences(kmers: np.ndarray) -> np.ndarray:
    """How often the same k-mer came before."""
    order = np.argsort(kmers, kind="stable")
    s = kmers[order]
    first = np.concatenate([[True], s[1:] != s[:-1]])
    at = np.flatnonzero(first)
    out = np.empty(len(kmers), dtype=np.int64)
    out[order] = np.arange(len(kmers)) - np.repeat(at, np.diff(np.append(at, len(kmers))))
    return out


def sketch(text: str | None) -> np.ndarray:
    """``SKETCHES`` 32-bit values. A text shorter than a k-mer is one k-mer; a text without TUPLE k-mers
    hashes the tuple of those it has; the empty text has a value of its own."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = len(codes)
    spans = SpanHash(mix64(codes + np.uint64(1)))
    if n <= KMER:
        kmers = spans.spans(np.array([0]), np.array([n]))
    else:
        start = np.arange(n - KMER + 1)
        kmers = spans.spans(start, start + KMER)
    m = len(kmers)
    seen = _occurrences(kmers).astype(np.uint64)
    key = (mix64(kmers + seen * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
    take = min(TUPLE, m)
    best = np.full((SKETCHES, take), 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    lines = np.arange(SKETCHES)
    for lo in range(0, m, _BLOCK):
        ranks = (key[lo : lo + _BLOCK][None, :] ^ _X[:, None]) * _A[:, None]
        got = []
        for _ in range(min(take, ranks.shape[1])):
            at = ranks.argmin(axis=1)
            got.append(ranks[lines, at].astype(np.uint64) << np.uint64(32) | (at + lo).astype(np.uint64))
            ranks[lines, at] = 0xFFFFFFFF
        best = np.sort(np.concatenate([best, np.array(got).T], axis=1), axis=1)[:, :take]
    at = np.sort(best & np.uint64(0xFFFFFFFF), axis=1).astype(np.int64)  # back in text order
    value = np.full(SKETCHES, _SEED[TUPLE] + np.uint64(min(n, 1)), dtype=np.uint64)
    for i in range(take):
        value = mix64(value * _SEED[i] + kmers[at[:, i]])
    return (value >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def to_hex(s: np.ndarray) -> str:
    return s.astype(">u4").tobytes().hex()


def edited(text: str | None, following: str | None) -> str:
    """The last floor(n / 2) code points replaced by the first as many (or all) of ``following``."""
    text = text or ""
    half = len(text) // 2
    return text[: len(text) - half] + (following or "")[:half]


def with_next(docs: DataFrame, id_col: str, text_col: str, rows, schema: str) -> DataFrame:
    """``rows((id, text) pairs, in order)`` over documents beside the next one in ascending id.

    The ids are cut into ranges; a range's rows meet in one sorted run, and the first document of the next
    range (the very first one for the last range) follows it as a guest that is read but not answered. Text
    is shuffled once, and one task holds one batch and one document more.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    place = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    base = docs.select(F.col(id_col).cast("long").alias("id"), place.alias("place"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = base.select(F.percentile_approx("place", [i / parts for i in range(1, parts)] or [0.5], 10000)).first()[0] or []
    cuts = sorted(set(cuts))
    number = sum((F.when(F.col("place") >= c, 1).otherwise(0) for c in cuts), F.lit(0)) if len(cuts) < 8 else F.size(
        F.filter(F.array(*(F.lit(c).cast("long") for c in cuts)), lambda c: c <= F.col("place"))
    )
    placed = base.withColumn("range", number)
    # one head for each range: at most as many rows as partitions
    heads = sorted(map(tuple, placed.groupBy("range").agg(F.min("place")).collect()))
    sent = [(place, heads[i - 1][0]) for i, (_, place) in enumerate(heads)]
    sent = spark.createDataFrame(sent, "place long, to int")
    guests = base.filter(F.col("place").isin([h[1] for h in heads])).groupBy("place").agg(F.min("text").alias("text"))
    guests = guests.join(F.broadcast(sent), "place").select(
        F.lit(None).cast("long").alias("id"), "place", "text", F.col("to").alias("range"), F.lit(True).alias("guest")
    )
    run = placed.withColumn("guest", F.lit(False)).unionByName(guests)
    run = run.repartitionById(parts, F.col("range").cast("int")).sortWithinPartitions("range", "guest", "place", "text")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)))

    return run.select("range", "guest", "id", "text").mapInArrow(go, schema)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) for every row; null text equals the empty one. Equal texts get equal
    fingerprints, whatever else their rows hold."""
    of = F.pandas_udf(lambda s: s.map(lambda t: to_hex(sketch(t))), "string")
    return docs.select(F.col(id_col).alias("doc_id"), of(F.col(text_col)).alias("fingerprint"))


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Next is the next row in ascending (id, text), after the last the first; null ids come first. A lone
    document is its own next. Null text is the empty text. Repeated rows are rows of their own. Ids are whole numbers
    (anything that casts to long). No rows give no rows; other columns, whatever their names, are not read.
    """
    import hashlib

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double"
    )
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [x.split()[0] for x in schema.split(",")]

    def rows(run) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = None
        pack = lambda: pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names
        )
        for at, guest, doc, text in run:
            own = sketch(text)
            if held is not None:
                last, before, theirs = held[1:]
                new = edited(before, text)
                other = sketch(new)
                out.append(
                    (last, len(before), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), to_hex(theirs),
                     to_hex(other), likeness(theirs, other), likeness(theirs, own))
                )
                if len(out) >= 500:
                    yield pack()
                    out.clear()
            held = None if guest else (at, doc, text, own)
        if out:
            yield pack()

    return with_next(docs, id_col, text_col, rows, schema)
