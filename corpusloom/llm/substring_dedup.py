"""Substring deduplication with difference-cover anchors.

A word window of ``WINDOW`` words is a repeat if the same words also start in a document with a smaller
id. Words at positions that lie in a difference cover modulo ``PERIOD`` are anchors: the cover's residues
have every difference modulo the period, so wherever two equal windows stand, some offset below the
period puts an anchor of both at the same word. An anchor is keyed by the hash of the words that are then
certain to lie in both windows (``WINDOW - PERIOD + 1``). Only about a fifth of all positions are keyed.

1. Keys that occur in two documents are found by one aggregation over (key, document), each key once a document.
2. Around anchors with such a key the match is extended to whole windows, which get a 128-bit hash of their words.
   While the keys are few enough (``TABLE_BITS``), they reach the scan as a bit table of bounded size and no anchor
   is shuffled again; beyond it, anchors are joined with the keys. A bit that another key shares only adds windows
   that have no match.
3. The least document of each window that two documents have is found by aggregation, before anything is joined, so a
   passage that a third of all documents share is one row on the joined side; the other side, read back from a table,
   is split where it is skewed. Words covered by a window with a smaller document are removed.

No pairs of documents are made. Phases end as tables in the shared folder. Windows are equal if two 64-bit hashes, of
word codes that have nothing in common, are: n compared windows collide with probability of about n*n / 2**129.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import SpanHash, bits_for, collect_bits, materialize, test_bits

#: Words of a window.
WINDOW = 50
#: Difference covers by period: the residues have all differences modulo the period. Fixed values.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (1, 5, 11, 24, 25, 27)}
PERIOD = 31
#: Most bits of the table of repeated keys: 32 MB, for 16 million keys.
TABLE_BITS = 1 << 28


def period_for(window: int) -> int:
    """The largest period of which the key still has 3 words; 1 for very short windows."""
    return max([1, *(p for p in COVERS if window - p + 1 >= 3)])


def anchor_positions(n: int, window: int) -> tuple[np.ndarray, int]:
    """Anchor positions in a document of ``n`` words, and the words of a key."""
    period = period_for(window)
    length = window - period + 1
    if n < window:
        return np.zeros(0, dtype=np.int64), length
    at = np.arange(n - length + 1)
    return (at if period == 1 else at[np.isin(at % period, COVERS[period])]), length


def windows_with(anchors: np.ndarray, n: int, window: int) -> np.ndarray:
    """Starts of the windows of an n-word document that hold the whole key of one of ``anchors``."""
    length = window - period_for(window) + 1
    edge = np.zeros(n + 2, dtype=np.int64)
    np.add.at(edge, np.maximum(anchors + length - window, 0), 1)
    np.add.at(edge, anchors + 1, -1)
    return np.flatnonzero(np.cumsum(edge)[: max(0, n - window + 1)] > 0)


class Words:
    """Words of a text, and hashes of runs of them in O(1) each."""

    def __init__(self, text: str | None):
        words = (text or "").encode().split()
        self.n = len(words)
        self.codes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), dtype="<u8").reshape(-1, 2)

    def runs(self, first: np.ndarray, length: int, part: int = 0) -> np.ndarray:
        """64-bit hash of words ``first .. first + length - 1`` for each entry of ``first``; parts 0 and 1 are independent."""
        return SpanHash(self.codes[:, part]).spans(first, first + length)


def _rows(ids: list, names: list[str], *columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each entry of the documents' arrays: doc, then ``names``, of which at is a place and others are hashes."""
    join = lambda c, t: np.concatenate(c).astype(t, copy=False) if c else np.zeros(0, t)
    made = [pa.array(join(c, np.int32) if n == "at" else join(c, np.uint64).view(np.int64)) for n, c in zip(names, columns, strict=True)]
    docs = np.repeat(np.array(ids, dtype=np.int64), [len(x) for x in columns[0]])
    return pa.RecordBatch.from_arrays([pa.array(docs), *made], names=["doc", *names])


def _sliced(batch: pa.RecordBatch, rows: int = 256) -> Iterator[list[tuple]]:
    for lo in range(0, batch.num_rows, rows):
        yield list(zip(*(c.to_pylist() for c in batch.slice(lo, rows).columns), strict=True))


def repeated_starts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, table_bits: int = TABLE_BITS) -> DataFrame:
    """(doc, starts array<int>): for documents that have any, the starts of windows whose words also start in
    a document with a smaller id."""
    texts = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    texts = texts.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))

    def anchors(once: bool):
        """Keys of each document, once each or with their places."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in _sliced(batch):
                    ids, hashes, at = [], [], []
                    for doc, text in part:
                        words = Words(text)
                        p, length = anchor_positions(words.n, window)
                        if len(p):
                            h = words.runs(p, length)
                            ids.append(doc), hashes.append(np.unique(h) if once else h), at.append(p)
                    yield _rows(ids, ["h"], hashes) if once else _rows(ids, ["h", "at"], hashes, at)

        return run

    def shared(found: DataFrame, keys: list[str], name: str) -> DataFrame:
        ends = found.groupBy(*keys).agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
        ends = ends.filter("least < most").select(*(F.col(k).alias(f"_{k}") for k in keys), "least")
        return materialize(ends, name)

    keyed = shared(texts.mapInArrow(anchors(True), "doc long, h long"), ["h"], "substring-keys")
    bits = bits_for(keyed.count())
    if bits <= table_bits:
        table = docs.sparkSession.sparkContext.broadcast(collect_bits(keyed, F.col("_h"), bits))
        near = texts.withColumn("anchors", F.lit(None).cast("array<int>"))
    else:
        table = None
        found = texts.mapInArrow(anchors(False), "doc long, h long, at int").join(keyed, F.col("h") == F.col("_h"), "left_semi")
        found = found.groupBy("doc").agg(F.collect_list("at").alias("anchors")).withColumnRenamed("doc", "of")
        near = texts.join(materialize(found, "substring-anchors"), F.col("doc") == F.col("of")).select("doc", "text", "anchors")

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _sliced(batch):
                ids, low, high, at = [], [], [], []
                for doc, text, own in part:
                    words = Words(text)
                    if table is not None:
                        p, length = anchor_positions(words.n, window)
                        own = p[test_bits(words.runs(p, length), table.value)] if len(p) else p
                    p = windows_with(np.array(own, dtype=np.int64), words.n, window)
                    if len(p):
                        ids.append(doc), low.append(words.runs(p, window)), high.append(words.runs(p, window, 1)), at.append(p)
                yield _rows(ids, ["h", "g", "at"], low, high, at)

    windows = near.mapInArrow(extended, "doc long, h long, g long, at int")
    least = shared(windows, ["h", "g"], "substring-windows")
    on = (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g")) & (F.col("doc") > F.col("least"))
    repeats = windows.join(least, on, "left_semi")
    repeats = repeats.groupBy("doc").agg(F.sort_array(F.collect_set("at")).alias("starts"))
    return materialize(repeats, "substring-starts")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, table_bits: int = TABLE_BITS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, kept_sha256) for every row of ``docs``.

    Null and empty texts have no words and lose none. A text shorter than the window loses nothing. Rows that
    repeat an id count as one document: they remove nothing from each other, and each loses the windows that
    any of them repeats at the same place. Rows with a null id neither remove nor lose words. Ids are whole numbers
    (anything that casts to long). No rows give no rows; other columns are not read.
    """
    starts = repeated_starts(docs, id_col, text_col, window, table_bits).withColumnRenamed("doc", "of")
    base = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    joined = base.join(starts, F.col("doc") == F.col("of"), "left").select("doc", "text", "starts")
    schema = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _sliced(batch):
                out: list[list] = [[], [], [], [], []]
                for doc, text, at in part:
                    words = (text or "").encode().split()
                    n = len(words)
                    if at:
                        edge = np.zeros(n + window + 1, dtype=np.int64)
                        at = np.array([a for a in at if a + window <= n], dtype=np.int64)
                        edge[at] += 1
                        edge[at + window] -= 1
                        kept = [w for w, c in zip(words, np.cumsum(edge)[:n].tolist(), strict=True) if not c]
                    else:
                        kept = words
                    joined = b" ".join(kept)
                    for c, v in zip(out, (doc, n, n - len(kept), joined.decode(), hashlib.sha256(joined).hexdigest()), strict=True):
                        c.append(v)
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                names = ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    return joined.mapInArrow(cut, schema)
