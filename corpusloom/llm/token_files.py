"""Corpus to token-id files and back (file format: ``idcoder``).

Documents are range-partitioned by id, so file k holds ids before file k + 1, each in ascending order. A task
tokenizes its run, codes it segment by segment and writes one file under a temporary name that is then moved, so
a repeated or speculative task leaves one whole file. Files go to the folder that all executors share, through
pyarrow's file systems. Only one manifest row for each file reaches the driver.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .idcoder import decode_segment, segments
from .textkit import shared_folder, worker_memory

#: Bytes of text, about, that are tokenized at a time, and words of a text that is made of new words.
BYTES, WORDS = 16 << 20, 500
# RE2 patterns. ASCII marks but for apostrophes that end a word of plain letters or digits; words of plain letters, whose
# case and normal form stay single letters; capitals that a mark after them could change.
_PLAIN = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}"
_MARK = rf"([0-9{_PLAIN}])([!-&(-/:-@\[-`{{-~]+)([\t-\r ]|$)"
_LETTERS = rf"^[{_PLAIN}]+$"
_MARKED = r"[A-Z]\pM"


class WordTokenizer:
    """Ids of a ``tokenizers`` file whose pre-tokenizer never crosses ASCII white space.

    Such a text's ids are those of its words in turn, so of a batch of texts each different word is encoded once. If the file
    has the needed rules, which is tried on samples, words are lower-cased first, a mark after a word is a word of its own, and
    words of plain letters are encoded many at a time, as one text in which the ends of pre-tokens (an end-of-word suffix) tell
    them apart. All other words are encoded alone.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(1 << 16, dtype=bool)
        if suffix:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        #: Texts of added tokens are found before anything else is done.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        same = lambda x, y: np.array_equal(self._alone([x])[0], self._alone([y])[0])
        self.lowers = all(same(x, x.lower()) for x in ("ABC", "Zebra", "McX3", "\u00dcBer"))
        self.parts = all(same(x + y, f"{x} {y}") for x in ("ab", "Y2K", "3", "\u00e9") for y in (*"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", "...", "&&&", ">=$", "|!"))
        self.together = bool(suffix) and self._together(pa.array(["Stra\u00dfe", "ab", "\u00c9t\u00e9", "internationalisation"])) is not None

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        """The worker's own, kept from task to task."""
        kept = worker_memory("token_files")
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def _ids(self, texts: list[str], step: int) -> Iterator[np.ndarray]:
        for lo in range(0, len(texts), step):
            for e in self.tokenizer.encode_batch_fast(texts[lo : lo + step], add_special_tokens=False):
                yield np.array(e.ids, dtype=np.uint16)

    def _alone(self, words: list[str]) -> list[np.ndarray]:
        return list(self._ids(words, 4096))

    def _together(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids, number of each word's) of words of one pre-token each; None if the marks don't tell them apart."""
        cuts = np.append(np.arange(0, len(words), WORDS), len(words)).astype(np.int32)
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words), " ").to_pylist()
        ids = np.concatenate([np.zeros(0, np.uint16), *self._ids(texts, 16)])
        stops = np.flatnonzero(self.ends[ids]) + 1
        return (ids, np.diff(stops, prepend=0)) if len(stops) == len(words) and (not len(ids) or stops[-1] == len(ids)) else None

    def _words(self, texts: pa.Array) -> pa.ListArray:
        low = pc.ascii_lower(texts)
        keep = pc.equal(pc.binary_length(texts), -1)
        for t in self.added:
            keep = pc.or_(keep, pc.match_substring(low, t.lower()))
        if self.lowers:
            texts = pc.if_else(pc.or_(keep, pc.match_substring_regex(texts, _MARKED)), texts, low)
        if self.parts:
            texts = pc.if_else(keep, texts, pc.replace_substring_regex(texts, _MARK, r"\1 \2\3"))
        return pc.ascii_split_whitespace(texts)

    def encode(self, texts: pa.Array, end: int) -> list[np.ndarray]:
        """Ids of each text, with ``end`` after them; null has none but ``end``."""
        lists = self._words(pc.fill_null(texts, ""))
        found = lists.flatten().dictionary_encode()
        kinds, use = found.dictionary, found.indices.to_numpy().astype(np.int64)
        plain = pc.match_substring_regex(kinds, _LETTERS).to_numpy(zero_copy_only=False) & self.together
        first = self._together(kinds.filter(pa.array(plain)))
        if first is None:
            plain[:], first = False, (np.zeros(0, np.uint16), np.zeros(0, np.int64))
        alone = self._alone(kinds.filter(pa.array(~plain)).to_pylist())
        sizes = np.zeros(len(kinds) + 1, dtype=np.int64)
        starts = np.zeros(len(kinds) + 1, dtype=np.int64)
        for own, n, base in ((plain, first[1], 0), (~plain, np.array([len(x) for x in alone], dtype=np.int64), len(first[0]))):
            sizes[:-1][own] = n
            starts[:-1][own] = base + np.cumsum(n) - n
        ids = np.concatenate([first[0], *alone, np.array([end], np.uint16)])
        sizes[-1], starts[-1] = 1, len(ids) - 1
        stops = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        use = np.insert(use, stops, len(kinds))  # the end of each text
        n = sizes[use]
        ends = np.cumsum(n)
        out = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[use] - ends + n, n)]
        return np.split(out, ends[stops + np.arange(len(stops))][:-1]) if len(stops) else []


def batches_of(batches: Iterator[pa.RecordBatch], size: int = BYTES) -> Iterator[pa.RecordBatch]:
    """The rows (id, text) in batches of about ``size`` bytes of text."""
    held, total = [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            held.append(part)
            total += pc.sum(pc.binary_length(part.column(1))).as_py() or 0
            if total >= size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, total = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared folder given as a URI or an absolute path."""
    return fs.FileSystem.from_uri(uri)


def write_ids(docs: DataFrame, encoder: Callable[[], Callable[[pa.Array], list[np.ndarray]]], folder: str, id_col: str = "doc_id", text_col: str = "text") -> list[dict]:
    """Write files ``part-<n>.ids``; the manifest: one dict (part, name, docs, ids, sizes) a file, in order.

    ``encoder`` is called once in a task and makes the function from texts to their ids.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(parts, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    schema = "part int, name string, docs long, ids long, seg_at array<long>, seg_bytes array<long>, seg_ids array<long>"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = encoder()
        name, final = f"part-{part:06d}.ids", None
        system, root = open_folder(folder)
        temp = f"{root}/.{name}.{uuid.uuid4().hex}"
        coded = (r for x in batches_of(batches) for r in zip(x.column(0).to_pylist(), encode(x.column(1)), strict=True))
        at, total, docs_in, sizes = 0, 0, 0, []
        out = None
        for data, n_docs, n_ids in segments(coded):
            if out is None:
                system.create_dir(root, recursive=True)
                out = system.open_output_stream(temp)
            out.write(data)
            sizes.append((at, len(data), n_ids))
            at, total, docs_in, final = at + len(data), total + n_ids, docs_in + n_docs, f"{root}/{name}"
        if out is not None:
            out.close()
            system.move(temp, final)
            cols = [[part], [name], [docs_in], [total], *([[s[k] for s in sizes]] for k in range(3))]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3]
            names = ["part", "name", "docs", "ids", "seg_at", "seg_bytes", "seg_ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    found = [r.asDict() for r in rows.mapInArrow(write, schema).collect()]  # one row for each file
    return sorted(found, key=lambda r: r["part"])


def read_ids(spark: SparkSession, folder: str, manifest: list[dict], with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files, checksums verified."""
    jobs, start = [], 0
    for f in manifest:
        for at, size, ids in zip(f["seg_at"], f["seg_bytes"], f["seg_ids"], strict=True):
            jobs.append((f["name"], at, size, start))
            start += ids
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        for batch in batches:
            for name, at, size, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with system.open_input_file(f"{root}/{name}") as f:
                    f.seek(at)
                    seg = decode_segment(f.read(size))
                ends = np.cumsum(seg.lengths)
                begins = ends - seg.lengths
                wide = seg.ids.astype("<u4")
                crc = [zlib.crc32(wide[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                cols = [pa.array(seg.doc_ids, pa.int64()), pa.array(begins + base), pa.array(seg.lengths), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    offsets = pa.array(np.append(0, ends), pa.int32())
                    cols.append(pa.ListArray.from_arrays(offsets, pa.array(seg.ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    frame = spark.createDataFrame(jobs, "name string, at long, size long, base long")
    return frame.repartition(max(1, len(jobs))).mapInArrow(read, schema) if jobs else spark.createDataFrame([], schema)


def encode_corpus(docs: DataFrame, tokenizer_path: str, end_id: int = 2, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all ``docs`` and read them back: (doc_id, start, n_tokens, ids_crc32[, ids]).

    Null text equals the empty one: its document is the end id alone. Rows of one id stand in text order, null ids
    first. No rows give no files and no rows. Other columns are not read.
    """
    folder = shared_folder(docs.sparkSession, "token-ids")

    def encoder():
        words = WordTokenizer.of(tokenizer_path)
        return lambda texts: words.encode(texts, end_id)

    return read_ids(docs.sparkSession, folder, write_ids(docs, encoder, folder, id_col, text_col), with_ids)
