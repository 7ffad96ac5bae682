"""SentencePiece encoding and decoding as a max-plus parallel scan.

A BPE model's segmentation of a text is the one path through the lattice of its pieces on which every two
neighbouring pieces are compatible: encoding just the two side by side gives the two. (While no merge crosses a
border, each side merges as it would alone, in the same order; so a border is never crossed in the text exactly
if it isn't crossed between its two pieces.) So encoding is a max-plus problem: a compatible step scores 0 for
its border and any other is ruled out; the state is the last piece.

A document is cut into chunks of at most ``CHUNK`` characters. A chunk's state at its edge is the piece that
covers the character before the edge, given by how far it reaches back and over the edge. For every state a
chunk may be entered in, the forward pass gives the states it may be left in: a boundary-state transfer matrix
in the (max, +) semiring, with -inf for what can't be. Matrices are multiplied associatively, in blocks and
over blocks, which fixes each chunk's entry and exit state; the chunks are then backtraced independently.
Where a chunk has a word edge (pieces never reach over one), the two sides of it are independent, so most
matrices are nearly of rank one and word segmentations are remembered.

Ids equal those of the sentencepiece library. Decoding joins pieces, byte pieces by their bytes.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import materialize, worker_memory

#: Characters of a chunk.
CHUNK = 1 << 16
#: Chunks whose matrices are multiplied in one task before blocks are.
GROUP = 64
SPACE = "\u2581"
_MEMO = 300_000
#: A text's words: a run of spaces with what follows it. No piece has a space after another character.
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

State = tuple[int, int]  # (characters before the edge, characters after it) of the piece over an edge


class Lattice:
    """Pieces of a model, their compatibility and the segmentation of strings."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        usual = [not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)) for i in range(self.size)]
        self.ids = {p: i for i, p in enumerate(pieces) if usual[i]}
        self.rank = {p: (-self.model.get_score(i), i) for p, i in self.ids.items()}
        #: The one string object of each piece that tables keep.
        self.names = {p: p for p in self.ids}
        self.longest = max(map(len, self.ids))
        self.byte = {}
        for i, p in enumerate(pieces):
            if self.model.is_byte(i):
                self.byte[int(p[3:-1], 16)] = i
        #: Bytes that a piece stands for, by id.
        self.raw = [p.encode() for p in pieces]
        for value, i in self.byte.items():
            self.raw[i] = bytes([value])
        ways: dict[str, set[int]] = {}
        for p in self.ids:
            ways.setdefault(p[:2], {1}).add(len(p))
        self.lengths = {k: tuple(sorted(v, reverse=True)) for k, v in ways.items()}
        self.fits: dict[str, dict[str, bool]] = {}
        self.held = 0
        self.alone = {p for p in self.ids if self.merge(p) == [p]}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Lattice:
        """The worker's own, kept from task to task."""
        kept = worker_memory("sentencepieces")
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def merge(self, text: str) -> list[str]:
        """Greedy merging of a short string: the best-scored neighbouring pair first, leftmost on ties."""
        parts = list(text)
        while True:
            best = None
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r[0] < best[0]):
                    best = (r[0], i)
            if best is None:
                return parts
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    def compatible(self, a: str, b: str) -> bool:
        after = self.fits.get(a)
        if after is None:
            if self.held > 2 * _MEMO:
                self.fits.clear()
                self.held = 0
            after = self.fits[self.names.get(a, a)] = {}
        got = after.get(b)
        if got is None:
            self.held += 1
            got = after[self.names.get(b, b)] = self.merge(a + b) == [a, b]
        return got

    def whole(self, piece: str) -> bool:
        """Whether a piece is what its own text merges to."""
        return len(piece) == 1 or piece in self.alone

    def candidates(self, text: str, end: int) -> Iterator[int]:
        """Starts of the pieces that end at ``end``, longest first; a single character always is one."""
        for start in range(max(0, end - self.longest), end):
            if start == end - 1 or text[start:end] in self.ids:
                yield start

    def forward(self, text: str, begin: int, stop: int, first: str | None) -> list[int]:
        """``back[e - begin]``: start of the last piece of text[begin:e], or -1, given the piece before."""
        back = [-1] * (stop - begin + 1)
        for end in range(begin + 1, stop + 1):
            for start in self.candidates(text, end):
                if start < begin:
                    continue
                piece = text[start:end]
                if start == begin:
                    before = first
                elif back[start - begin] >= 0:
                    before = text[back[start - begin] : start]
                else:
                    continue
                if self.whole(piece) and (before is None or self.compatible(before, piece)):
                    back[end - begin] = start
                    break
        return back

    def path(self, text: str, begin: int, stop: int, first: str | None) -> list[str]:
        """The one compatible path over text[begin:stop] after the piece ``first``.

        Longest pieces are tried first. A position from which no piece leads on is no border of the path, for
        whatever led there is the only compatible path to it, so it is never tried again.
        """
        alone, lengths, fits, dead = self.alone, self.lengths, self.fits, set()
        out: list[str] = []
        at, last = begin, first
        while at < stop:
            known = fits.get(last) or {}
            for n in lengths.get(text[at : at + 2], (1,)):
                end = at + n
                if end > stop or end in dead:
                    continue
                piece = text[at:end]
                if n > 1 and piece not in alone:
                    continue
                fit = last is None or known.get(piece)
                if fit is None:
                    fit = self.compatible(last, piece)
                if fit:
                    out.append(piece)
                    at, last = end, piece
                    break
            else:
                if not out:
                    raise ValueError("no segmentation")
                dead.add(at)
                at -= len(out.pop())
                last = out[-1] if out else first
        return out

    def word(self, text: str) -> bytes:
        """Ids, as little-endian 32-bit integers, of a word that starts and ends at word edges."""
        got = self.memo.get(text)
        if got is None:
            if len(self.memo) > _MEMO:  # the less recent generation is forgotten
                self.older, self.memo = self.memo, {}
            got = self.older.get(text)
            if got is None:
                got = self.to_ids(self.path(text, 0, len(text), None))
            self.memo[text] = got
        return got

    def to_ids(self, parts: list[str]) -> bytes:
        ids = self.ids
        try:
            out = [ids[p] for p in parts]
        except KeyError:  # a character without a piece
            out = [i for p in parts for i in ((ids[p],) if p in ids else [self.byte[b] for b in p.encode()])]
        return struct.pack(f"<{len(out)}i", *out)


def escaped(text: str | None) -> str:
    """What the model segments: a space before the text, spaces as their mark; empty for no text."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def edges(text: str) -> list[int]:
    """Positions before a space mark that follows another character: no piece reaches over them."""
    return [m.start() + 1 for m in re.finditer(f"[^{SPACE}]{SPACE}", text)]


def states_at(lattice: Lattice, text: str, edge: int) -> list[State]:
    """Every piece that could cover the character before ``edge``, as (before, after)."""
    if edge == 0:
        return [(0, 0)]
    out = []
    for start in range(max(0, edge - lattice.longest), edge):
        for end in range(edge, min(len(text), start + lattice.longest) + 1):
            piece = text[start:end]
            if len(piece) == 1 or (piece in lattice.ids and lattice.whole(piece)):
                out.append((edge - start, end - edge))
    return out


def transfer(lattice: Lattice, text: str, lo: int, hi: int) -> dict[State, list[State]]:
    """Of the chunk text[lo:hi] in its surroundings ``text``: the exit states with score 0 for each entry state;
    all others are -inf."""
    inner = [e for e in edges(text[lo - 1 if lo else 0 : hi + 1]) if lo < e + (lo - 1 if lo else 0) < hi]
    inner = [e + (lo - 1 if lo else 0) for e in inner]
    out: dict[State, list[State]] = {}
    exits = states_at(lattice, text, hi)

    def leave(begin: int, first: str | None, back: list[int]) -> list[State]:
        ok = []
        for before, after in exits:
            start, piece = hi - before, text[hi - before : hi + after]
            if start < begin:
                continue
            if start == begin:
                last = first
            elif back[start - begin] >= 0:
                last = text[back[start - begin] : start]
            else:
                continue
            if last is None or lattice.compatible(last, piece):
                ok.append((before, after))
        return ok

    tail = leave(inner[-1], None, lattice.forward(text, inner[-1], hi, None)) if inner else None
    for before, after in states_at(lattice, text, lo):
        begin, first = lo + after, text[lo - before : lo + after] or None
        if begin > hi:  # a piece over the whole chunk
            out[before, after] = [(before + hi - lo, begin - hi)]
        elif begin == hi:
            out[before, after] = [(before + hi - lo, 0)]
        elif inner:
            head = lattice.forward(text, begin, inner[0], first) if begin < inner[0] else [begin]
            if begin > inner[0]:
                continue
            out[before, after] = tail if begin == inner[0] or head[-1] >= 0 else []
        else:
            out[before, after] = leave(begin, first, lattice.forward(text, begin, hi, first))
    return {k: v for k, v in out.items() if v}


def multiply(a: dict[State, list[State]], b: dict[State, list[State]]) -> dict[State, list[State]]:
    """Max-plus product of two transfer matrices (associative)."""
    out = {}
    for k, mids in a.items():
        got = sorted({e for m in mids for e in b.get(m, ())})
        if got:
            out[k] = got
    return out


def backtrace(lattice: Lattice, text: str, lo: int, hi: int, entry: State, exit_: State) -> np.ndarray:
    """Ids of the pieces that end in text[lo:hi], or reach over its end, on the path between the two states."""
    begin, stop = lo + entry[1], hi - exit_[0]
    if stop < lo:
        return np.zeros(0, dtype="<i4")
    first = text[lo - entry[0] : begin] or None
    own = lattice.to_ids([text[stop : hi + exit_[1]]]) if exit_[0] else b""
    inner = [e for e in edges(text[: stop + 1]) if begin <= e <= stop]
    if not inner:
        parts = [lattice.to_ids(lattice.path(text, begin, stop, first))]
    else:
        parts = [lattice.to_ids(lattice.path(text, begin, inner[0], first))]
        parts += map(lattice.word, _WORDS.findall(text[inner[0] : inner[-1]]))
        parts.append(lattice.to_ids(lattice.path(text, inner[-1], stop, None)))
    return np.frombuffer(b"".join([*parts, own]), dtype="<i4")


def encode_text(lattice: Lattice, text: str | None, chunk: int = CHUNK) -> np.ndarray:
    """All of the scan in one process, for texts that fit one: matrices, products, backtraces."""
    s = escaped(text)
    cuts = [*range(0, len(s), chunk), len(s)]
    if len(cuts) <= 2:
        return np.frombuffer(b"".join(map(lattice.word, _WORDS.findall(s))), dtype="<i4")
    spans = list(zip(cuts, cuts[1:], strict=False))
    chain = resolve([transfer(lattice, s, a, b) for a, b in spans], [(0, 0)])
    return np.concatenate([backtrace(lattice, s, a, b, x, y) for (a, b), (x, y) in zip(spans, chain, strict=True)])


def resolve(mats: list[dict], entries: list[State], exit_: State | None = None) -> list[tuple[State, State]]:
    """(entry, exit) of every chunk on the one path from an entry to ``exit_`` (or to a state that ends there)."""
    reach = [set(entries)]
    for m in mats:
        reach.append({e for s in reach[-1] for e in m.get(s, ())})
    ends = [e for e in reach[-1] if (e == exit_ if exit_ is not None else e[1] == 0)]
    if not ends:
        raise ValueError("no segmentation")
    at, out = sorted(ends)[0], []
    for i in range(len(mats) - 1, -1, -1):
        start = min(s for s in reach[i] if at in mats[i].get(s, ()))
        out.append((start, at))
        at = start
    return out[::-1]


def decode_ids(lattice: Lattice, ids: list[int]) -> str:
    """The text of ids: pieces joined, runs of byte pieces as UTF-8 (bad bytes replaced), the first space dropped."""
    return b"".join([lattice.raw[i] for i in ids]).decode("utf-8", "replace").replace(SPACE, " ")[1:]


def _lists(got: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(g) for g in got])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*got, np.zeros(0, "<i4")]).astype(np.int32)))


def _digests(lattice: Lattice, keys: pa.Array, got: list[np.ndarray]) -> pa.RecordBatch:
    """Digests of each document's ids and of the text decoded from them."""
    crc, chars, sha = [], [], []
    for ids in got:
        text = decode_ids(lattice, ids.tolist())
        chars.append(len(text))
        crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
        sha.append(hashlib.sha256(text.encode()).hexdigest())
    count = pa.array([len(ids) for ids in got], pa.int64())
    cols = [keys, count, pa.array(crc, pa.int64()), pa.array(chars, pa.int64()), pa.array(sha, pa.string())]
    return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_crc32", "n_chars", "text_sha256"])


def _encoder(model_path: str, chunk: int, out: Callable[[Lattice, pa.Array, list[np.ndarray]], pa.RecordBatch]):
    """Encodes batches (doc, text) of documents of one chunk and hands keys and ids to ``out``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice.of(model_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                got = [encode_text(lattice, t, chunk) for t in part.column(1).to_pylist()]
                yield out(lattice, part.column(0), got)

    return run


def _divided(docs: DataFrame, id_col: str, text_col: str, chunk: int) -> tuple[DataFrame, DataFrame]:
    """(doc, text) of the documents of one chunk, and of giant ones."""
    base = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    giant = F.coalesce(F.length("text"), F.lit(0)) + 1 > chunk
    return base.filter(~giant), base.filter(giant)


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(doc, ids array<int>) for every row.

    Null and empty texts have no ids. Documents of one chunk are encoded where they stand, giant ones by ``encode_giants``.
    Repeated rows and repeated ids stay apart, for giant texts are encoded once for each different text.
    """
    few, giants = _divided(docs, id_col, text_col, chunk)

    def listed(lattice: Lattice, keys: pa.Array, got: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([keys, _lists(got)], names=["doc", "ids"])

    coded = few.mapInArrow(_encoder(model_path, chunk, listed), f"doc {few.schema['doc'].dataType.simpleString()}, ids array<int>")
    return coded.unionByName(encode_giants(giants, model_path, chunk))


def longest_piece(model_path: str) -> int:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return max(len(model.id_to_piece(i)) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i)))


def encode_giants(giants: DataFrame, model_path: str, chunk: int = CHUNK) -> DataFrame:
    """(doc, ids array<int>) of rows (doc, text), by the parallel scan.

    Chunks with their surroundings (the longest piece on both sides) are dealt out as a table; matrices of ``GROUP`` chunks are
    multiplied in a task, the products of a document in the next, and chunks are backtraced on their own.
    """
    width = longest_piece(model_path)
    big = materialize(giants.withColumn("key", F.sha2(F.col("text"), 256)), "pieces-giants")
    once = big.groupBy("key").agg(F.first("text").alias("text"))
    s = F.concat(F.lit(SPACE), F.translate("text", " ", SPACE))
    cut = once.select("key", s.alias("s"), F.length(s).alias("n"))
    cut = cut.select("key", "s", "n", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / chunk).cast("int") - 1)).alias("k"))
    lo = F.col("k") * chunk
    left = F.greatest(lo - width, F.lit(0))
    cut = cut.select(
        "key", "k", (lo - left).alias("lo"), (F.least(lo + chunk, F.col("n")) - left).alias("hi"),
        F.substring(F.col("s"), left + 1, F.lit(chunk + 2 * width)).alias("s"), (lo + chunk >= F.col("n")).alias("last"),
    )
    cut = cut.withColumn("s", F.when(F.col("last"), F.substring(F.col("s"), F.lit(1), F.col("hi"))).otherwise(F.substring(F.col("s"), F.lit(1), F.col("hi") + width)))
    cut = materialize(cut, "pieces-chunks").repartition("key", "k")
    load = lambda x: {tuple(k): [tuple(e) for e in v] for k, v in json.loads(x)}
    dump = lambda m: json.dumps([[k, v] for k, v in sorted(m.items())])

    def matrices(batches):
        lattice = Lattice.of(model_path)
        for b in batches:
            b["m"] = [dump(transfer(lattice, s, lo, hi)) for s, lo, hi in zip(b["s"], b["lo"], b["hi"], strict=True)]
            yield b[["key", "k", "m"]]

    mats = cut.mapInPandas(matrices, "key string, k int, m string")
    grouped = mats.withColumn("g", F.floor(F.col("k") / GROUP).cast("int"))

    def product(pdf):
        import pandas as pd

        rows = pdf.sort_values("k")
        m = load(rows["m"].iloc[0])
        for x in rows["m"].iloc[1:]:
            m = multiply(m, load(x))
        return pd.DataFrame({"key": [rows["key"].iloc[0]], "g": [rows["g"].iloc[0]], "p": [dump(m)]})

    def over_blocks(pdf):
        import pandas as pd

        rows = pdf.sort_values("g")
        chain = resolve([load(p) for p in rows["p"]], [(0, 0)])
        return pd.DataFrame({"key": rows["key"], "g": rows["g"], "x": [json.dumps(c) for c in chain]})

    def in_block(pdf):
        import pandas as pd

        rows = pdf.sort_values("k")
        entry, exit_ = (tuple(e) for e in json.loads(rows["x"].iloc[0]))
        chain = resolve([load(m) for m in rows["m"]], [entry], exit_)
        return pd.DataFrame({"key": rows["key"], "k": rows["k"], "x": [json.dumps(c) for c in chain]})

    blocks = grouped.groupBy("key", "g").applyInPandas(product, "key string, g int, p string")
    ends = blocks.groupBy("key").applyInPandas(over_blocks, "key string, g int, x string")
    chains = grouped.join(ends, ["key", "g"]).groupBy("key", "g").applyInPandas(in_block, "key string, k int, x string")

    def trace(batches):
        lattice = Lattice.of(model_path)
        for b in batches:
            ids = []
            for s, lo, hi, x in zip(b["s"], b["lo"], b["hi"], b["x"], strict=True):
                entry, exit_ = (tuple(e) for e in json.loads(x))
                ids.append(backtrace(lattice, s, lo, hi, entry, exit_))
            b["ids"] = [i.tolist() for i in ids]
            yield b[["key", "k", "ids"]]

    traced = cut.join(chains, ["key", "k"]).mapInPandas(trace, "key string, k int, ids array<int>")
    whole = traced.groupBy("key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda c: c["ids"])).alias("ids"))
    return big.select("doc", "key").join(whole, "key").select("doc", "ids")


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, n_chars, text_sha256) of ids and of the text decoded from them.

    ids_crc32 is the unsigned CRC-32 of the ids as little-endian 32-bit integers. Null and empty texts have no ids
    and decode to the empty text; every other text decodes to itself, but that U+2581 becomes a space. Rows that repeat give rows that
    repeat; null ids pass; other columns are not read; no rows give no rows.
    """
    few, giants = _divided(docs, id_col, text_col, chunk)
    schema = f"doc_id {few.schema['doc'].dataType.simpleString()}, n_tokens long, ids_crc32 long, n_chars long, text_sha256 string"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice.of(model_path)
        for batch in batches:
            lists = batch.column(1)
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            yield _digests(lattice, batch.column(0), [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)])

    # A worker that has a document's ids decodes them too: no second worker with a lattice of its own.
    small = few.mapInArrow(_encoder(model_path, chunk, _digests), schema)
    return small.unionByName(encode_giants(giants, model_path, chunk).mapInArrow(decode, schema))
