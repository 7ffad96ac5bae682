"""Phrase collocations of each language: merged count-min sketches, exact counts of survivors, scores, subsumption.

First pass: every task adds the hashes of its words and phrases to count-min rows whose cells stop at the least count; the rows of all
tasks are added up, and a cell that has reached the least count is one bit of the merged table. A sum that stops there is never
below it where the true one isn't, so a phrase whose bits aren't all set is not frequent: nothing frequent is
lost. The table has a fixed size (``ROWS`` times ``CELLS`` bits, 8 MB), which is all that is sent to the driver and broadcast.

Second pass: words and phrases whose bits are set are counted exactly, by their text: each task adds up its own, then they are
shuffled by text. When there are far more different phrases than cells, more of the rare ones are let through and counted too; the
result is the same.

A task numbers its words and packs three numbers into 63 bits, so counting in it is exact as well; it starts anew after some
``WORDS`` different words. It takes long texts in slices, so no text is held as phrases at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import HEAVY, heavy_keys, join_heavy, materialize, mix64, release_memory

#: Count-min rows, cells of a row (a power of two), and the largest least count: a cell is a byte, and so is a sum of two.
ROWS, CELLS, FULL = 2, 1 << 25, 127
#: Cells of a block of a row, the unit in which tasks' rows are added up.
BLOCK = 1 << 15
#: Words of phrases.
SHORTEST, LONGEST = 2, 3
#: Different words of a task's numbering, which takes 21 bits; words of a slice of a text; words that a task holds at a time.
WORDS, SLICE, HELD = 1 << 19, 1 << 18, 1 << 21
_MANY = (1 << 21) - 1
_SPLIT = bytes.maketrans(b"\t.,;:!?\x0b\x0c\r", b" \n\n\n\n\n\n\n\n\n")


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Reader:
    """Words of a task's texts as numbers: 0 ends a piece, others are words in order of their first use."""

    END = b"\xff"  # no byte of UTF-8

    def __init__(self) -> None:
        self.restart()

    def restart(self) -> None:
        self.numbers = _Numbers({self.END: 0})
        self.codes = np.zeros(0, dtype=np.uint64)
        self.langs: dict[str, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        self.held = 0

    def words(self, text: str) -> list[bytes]:
        return [*text.encode().lower().translate(_SPLIT).replace(b"\n", b" \xff ").split(), self.END]

    def add(self, lang: str, words: list[bytes], at: int) -> None:
        """The slice of a text's words from ``at`` on: phrases that begin in it, which the words after it complete."""
        own = words[at : at + SLICE + LONGEST - 1]
        parts, begins = self.langs.setdefault(lang, ([], []))
        parts.append(np.fromiter(map(self.numbers.__getitem__, own), dtype=np.int64, count=len(own)))
        begins.append(np.arange(len(own)) < SLICE)
        self.held += len(own)

    def full(self) -> bool:
        return self.held >= HELD or len(self.numbers) >= WORDS

    def hashes(self, lang: str, packed: np.ndarray, size: int) -> np.ndarray:
        """A 64-bit hash of each phrase of ``size`` words, from the hashes of its words."""
        if len(self.codes) < len(self.numbers):
            new = list(self.numbers)[len(self.codes) :]
            self.codes = np.concatenate([self.codes, np.fromiter((xxhash.xxh64_intdigest(w) for w in new), dtype=np.uint64, count=len(new))])
        h = np.full(len(packed), xxhash.xxh64_intdigest(lang.encode(), size), dtype=np.uint64)
        for k in range(size):
            h = mix64(h + self.codes[(packed >> (21 * k)) & _MANY])
        return h

    def phrases(self) -> Iterator[tuple[str, int, np.ndarray]]:
        """(lang, words, occurrences as packed numbers, the first word lowest) of all texts held, which are then let go."""
        for lang, (parts, begins) in self.langs.items():
            ids = np.concatenate(parts)
            inside, packed = np.concatenate(begins) & (ids > 0), ids
            yield lang, 1, ids[inside]
            for size in range(2, LONGEST + 1):
                inside = inside[:-1] & (ids[size - 1 :] > 0)
                packed = packed[:-1] | ids[size - 1 :] << (21 * (size - 1))
                yield lang, size, packed[inside]
        self.langs, self.held = {}, 0

    def texts(self, packed: np.ndarray, size: int) -> list[str]:
        words = list(self.numbers)
        columns = [[words[i] for i in ((packed >> (21 * k)) & _MANY).tolist()] for k in range(size)]
        return [b" ".join(x).decode() for x in zip(*columns, strict=True)]


def _read(batches: Iterator[pa.RecordBatch], use: Callable[[Reader], Iterator]) -> Iterator:
    """Reads (lang, text) and hands the reader to ``use`` whenever it is full, and at the end."""
    reader = Reader()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = reader.words(text)
            for at in range(0, len(words), SLICE):
                reader.add(lang, words, at)
                if reader.full():
                    yield from use(reader)
                    if len(reader.numbers) >= WORDS // 2:
                        reader.restart()
    yield from use(reader)


def cells_of(hashes: np.ndarray, row: int, cells: int = CELLS) -> np.ndarray:
    return (mix64(hashes + np.uint64(row)) & np.uint64(cells - 1)).astype(np.uint32)


def add_cells(counts: np.ndarray, cells: np.ndarray, full: int) -> None:
    """Add one to a cell for each time it is named; cells stop at ``full``, also within a call."""
    cells = np.sort(cells)
    at = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, np.int64)
    times = np.diff(np.append(at, len(cells)))
    own = cells[at]
    counts[own] = np.minimum(counts[own] + np.minimum(times, full), full)


def pack(counts: np.ndarray) -> bytes:
    """A block of cells, compressed: how many aren't 0, a bit for each of the cells, and the counts of those."""
    some = counts > 0
    return int(some.sum()).to_bytes(4, "little") + pa.compress(np.packbits(some).tobytes() + counts[some].tobytes(), codec="zstd", asbytes=True)


def add_packed(counts: np.ndarray, packed: bytes, full: int) -> None:
    """Add a packed block to ``counts``, which stop at ``full``."""
    bits = -(-len(counts) // 8)
    raw = np.frombuffer(pa.decompress(packed[4:], bits + int.from_bytes(packed[:4], "little"), codec="zstd"), dtype=np.uint8)
    at = np.flatnonzero(np.unpackbits(raw[:bits], count=len(counts)))
    counts[at] = np.minimum(counts[at] + raw[bits:], full)


def sketch(texts: DataFrame, least: int, rows: int = ROWS, cells: int = CELLS) -> np.ndarray:
    """The merged table of ``texts`` (lang, text): bytes of ``rows`` times ``cells`` bits, set where a cell reached ``least``."""
    block = min(BLOCK, cells)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(cells, dtype=np.uint8) for _ in range(rows)]

        def use(reader: Reader) -> Iterator:
            for lang, size, packed in reader.phrases():
                for lo in range(0, len(packed), HELD):
                    h = reader.hashes(lang, packed[lo : lo + HELD], size)
                    for row in range(rows):
                        add_cells(counts[row], cells_of(h, row, cells), least)
            return iter(())

        for _ in _read(batches, use):
            pass
        for row in range(rows):
            table = counts[row].reshape(-1, block)
            for lo in range(0, len(table), 64):
                own = [i for i in range(lo, min(lo + 64, len(table))) if table[i].any()]
                if own:
                    cols = [pa.array([row * len(table) + i for i in own], pa.int32()), pa.array([pack(table[i]) for i in own], pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, names=["block", "counts"])
        del counts
        release_memory()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i not in sums:
                    sums[i] = np.zeros(block, dtype=np.uint8)
                add_packed(sums[i], counts, least)
        for i, own in sums.items():
            bits = np.packbits(own >= least, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([bits], pa.binary())], names=["block", "bits"])

    parts = texts.mapInArrow(partial, "block int, counts binary").repartition("block")
    table = np.zeros((rows * cells // block, block // 8 or 1), dtype=np.uint8)
    for r in parts.mapInArrow(merge, "block int, bits binary").collect():  # bits of the table
        table[r["block"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return table.reshape(rows, -1)


def passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether all cells of each hash are set in the merged table."""
    found = np.ones(len(hashes), dtype=bool)
    for row, bits in enumerate(table):
        at = cells_of(hashes, row, max(8 * len(bits), 1))
        found &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return found


def counted(docs: DataFrame, least: int, lang_col: str = "lang", text_col: str = "text", rows: int = ROWS, cells: int = CELLS) -> DataFrame:
    """(lang, words, phrase, count) as a table: exact counts of every word and phrase with at least ``least`` occurrences, and for each
    language with words a row of 0 words, whose count is that of all word occurrences."""
    if not 0 < least <= FULL:
        raise ValueError(f"a least count from 1 to {FULL}")
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    table = sketch(texts, least, rows, cells)
    shared = docs.sparkSession.sparkContext.broadcast(table)  # of a fixed size

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        names = ["lang", "words", "phrase", "count"]

        def use(reader: Reader) -> Iterator[pa.RecordBatch]:
            for lang, size, packed in reader.phrases():
                if size == 1 and len(packed):
                    cols = [pa.array([lang]), pa.array([0], pa.int32()), pa.array([""]), pa.array([len(packed)], pa.int64())]
                    yield pa.RecordBatch.from_arrays(cols, names=names)
                packed = np.concatenate([p[passes(bits, reader.hashes(lang, p, size))] for p in np.split(packed, range(HELD, len(packed), HELD))])
                own, n = np.unique(packed, return_counts=True)
                for lo in range(0, len(own), 1 << 16):
                    found = reader.texts(own[lo : lo + (1 << 16)], size)
                    cols = [pa.array([lang] * len(found)), pa.array([size] * len(found), pa.int32()), pa.array(found), pa.array(n[lo : lo + (1 << 16)])]
                    yield pa.RecordBatch.from_arrays(cols, names=names)

        yield from _read(batches, use)
        release_memory()

    parts = texts.mapInArrow(exact, "lang string, words int, phrase string, count long")
    sums = parts.groupBy("lang", "words", "phrase").agg(F.sum("count").alias("count"))
    return materialize(sums.filter(f"words = 0 OR count >= {least}"), "collocations-counts")


def scored(counts: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(lang, words, phrase, a, l, r, score) of every phrase of ``counts``: score is floor(1000000 a a / (l r)) of the cut with the least
    one (ties: the earliest cut), l and r the counts of its parts. Products are decimals of 38 digits, so counts up to 10**15 are exact."""
    phrases = counts.filter(F.col("words") >= SHORTEST)
    word = F.split("phrase", " ")
    part = lambda lo, n: F.array_join(F.slice(word, lo, n), " ")
    cuts = phrases.select("lang", "words", "phrase", F.col("count").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    total = phrases.agg(F.coalesce(F.sum(F.col("words") - 1), F.lit(0))).first()[0]
    for side, name in (("head", "l"), ("tail", "r")):
        own = counts.filter("words > 0").select("lang", F.col("phrase").alias(side), F.col("count").alias(name))
        uses = cuts.groupBy("lang", side).agg(F.count("*").alias("uses"))
        hot = materialize(own.join(heavy_keys(uses, "uses", total, heavy).drop("uses"), ["lang", side]), f"collocations-{side}")
        cuts = join_heavy(cuts, own, ["lang", side], hot)
    exact = lambda c: F.col(c).cast("decimal(16,0)")
    million = F.lit(1000000).cast("decimal(7,0)")
    least = (million * (exact("a") * exact("a")).cast("decimal(31,0)")).cast("decimal(38,0)")
    cuts = cuts.withColumn("_up", least).withColumn("_down", exact("l") * exact("r")).withColumn("score", F.expr("_up div _down"))
    best = F.min(F.struct("score", "k", "l", "r", "a")).alias("b")
    return cuts.groupBy("lang", "words", "phrase").agg(best).select("lang", "words", "phrase", "b.a", "b.l", "b.r", "b.score")


def kept(phrases: DataFrame, share: int = 50) -> DataFrame:
    """The rows of ``phrases`` (lang, words, phrase, a, ...) that don't lie in a longer one with at least ``share`` percent of their count."""
    word = F.split("phrase", " ")
    size, count = F.col("words"), F.col("a")
    inner = F.expr("filter(flatten(transform(sequence(1, words), i -> transform(sequence(1, words), n -> struct(i, n)))), x -> x.i + x.n <= words + 1 AND x.n < words)")
    longer = phrases.filter(size > SHORTEST).select("lang", count.alias("_a"), word.alias("_w"), F.explode(inner).alias("_x")).filter(F.col("_x.n") >= SHORTEST)
    longer = longer.select("lang", F.array_join(F.slice("_w", F.col("_x.i"), F.col("_x.n")), " ").alias("phrase"), "_a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("_a").alias("_most"))
    rows = phrases.join(longer, ["lang", "phrase"], "left")
    return rows.filter(F.coalesce(F.lit(100) * F.col("_most") < F.lit(share) * count, F.lit(True))).drop("_most")


def ranked(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language by score and count, both descending, and phrase, with their rank from 1.

    All rows are range-sorted by language and that order. A partition's rows of a language get their number from its earlier partitions'
    counts, so a language is as many partitions as it needs.
    """
    order = [F.col("lang"), F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = phrases.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "collocations-order")
    parts = rows.groupBy("lang", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))  # partitions and languages
    earlier = F.sum("_n").over(_before("lang", "_part"))
    parts = parts.select("lang", "_part", "_first", F.coalesce(earlier, F.lit(0)).alias("_base")).filter(F.col("_base") < top)
    rows = rows.join(parts, ["lang", "_part"]).withColumn("rank", (F.col("_base") + F.col("_at") - F.col("_first") + 1).cast("long"))
    return rows.filter(F.col("rank") <= top).drop("_part", "_at", "_first", "_base")


def _before(group: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 10, share: int = 50, top: int = 2000,
    rows: int = ROWS, cells: int = CELLS, heavy: int = HEAVY,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language.

    Texts, A-Z lower-cased, are cut at ``.,;:!?`` and line ends into pieces and those at spaces and tabs into words. a is the count of
    a phrase of two or three words, within pieces, overlaps included, from ``least`` on; n is that of all words. Phrases inside a longer one
    with ``share`` percent of their count are dropped, also if that one is dropped itself. Null text counts as empty, null language as
    'und'; repeated rows count again; other columns are not read; languages without phrases, and no rows, give no rows.
    """
    counts = counted(docs, least, lang_col, text_col, rows, cells)
    found = ranked(kept(scored(counts, heavy), share), top)
    totals = counts.filter("words = 0").select("lang", F.col("count").alias("n"))  # a row for each language
    return found.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
