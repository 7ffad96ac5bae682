"""Token-id files: an adaptive context-mixing range coder over independently reset, checksummed blocks.

A file is a run of segments; a segment holds whole documents. Its ids are cut into blocks, each coded from a
reset state: an order-1 and an order-2 table (last id after the previous one or two ids) each predict an id, and
their predictions are mixed with the order-0 distribution by weights that follow how often each was right. The
mixed interval of an id drives a carry-less range coder with 64-bit state and 32-bit words. All blocks of a
segment are coded in step, one array lane each, so the coder is vectorised without giving up that a block
decodes alone (with the segment's header). Each block has a CRC-32 of its ids.

Order 0 adapts to each segment, not within a block: its counts over the segment stand in the header. A table of some
50,000 counts that each block learns anew would need a few hundred KB a lane, and a block of a few thousand ids could not
fill it. Orders 1 and 2 and the weights are learnt in the block.

Layout of a segment, little-endian: magic ``CLI2``; u32 docs, u64 ids, u32 ids of a block, u32 blocks, u32 bytes
of the zlib-compressed tables; the tables (i64 document ids, u8 null flags, u64 lengths, u16 order-0 symbols,
u32 order-0 counts, u32 words and u32 CRC-32 of each block); the blocks' u32 words.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

MAGIC = b"CLI2"
_HEAD = struct.Struct("<4sIQIII")
#: Ids of a block at most, and blocks that are coded in step.
BLOCK_IDS = 4096
LANES = 4096
#: A segment is closed once it has so many ids.
SEGMENT_IDS = 16 << 20
_NONE = 65535
_WORD = np.uint64(32)
_LOW32 = np.uint64((1 << 32) - 1)
_M, _T0 = 22, 18
#: Ids of all lanes whose contexts and order-0 intervals are looked up ahead of the encoder's steps, about.
_AHEAD = 1 << 20
_SLOTS1, _SLOTS2 = 1024, 2048


class CorruptBlock(ValueError):
    """A block's ids don't have its checksum, or a segment isn't one."""


def _order0(symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cumulative frequencies by id, and the id of each of the 2**18 slots."""
    total = 1 << _T0
    freq = 1 + counts.astype(np.uint64) * np.uint64(total - len(counts)) // np.uint64(max(1, int(counts.sum())))
    freq[freq.argmax()] += np.uint64(total) - freq.sum()
    cdf = np.zeros(65537, dtype=np.int64)
    cdf[symbols.astype(np.int64) + 1] = freq
    return np.cumsum(cdf), np.repeat(symbols.astype(np.uint16), freq.astype(np.int64))


class _Model:
    """The lanes' predictions: tables, mixing weights and their updates."""

    def __init__(self, lanes: int):
        self.row1 = np.arange(lanes, dtype=np.int64) * _SLOTS1
        self.row2 = np.arange(lanes, dtype=np.int64) * _SLOTS2
        self.t1 = np.full(lanes * _SLOTS1, _NONE, dtype=np.uint16)
        self.t2 = np.full(lanes * _SLOTS2, _NONE, dtype=np.uint16)
        self.hit1 = np.full(lanes, 1 << 13, dtype=np.int64)
        self.hit2 = np.full(lanes, 1 << 14, dtype=np.int64)

    def slots(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the contexts (a) and (a, b), a being the id before and b the one before that."""
        h = a * 40503
        return (h >> 3 & _SLOTS1 - 1) + self.row1, ((h + b * 30103) >> 2 & _SLOTS2 - 1) + self.row2

    def predict(self, at1: np.ndarray, at2: np.ndarray) -> None:
        self.p1 = self.t1.take(at1)
        self.p2 = self.t2.take(at2)
        self.have1, self.have2 = self.p1 != _NONE, self.p2 != _NONE
        self.w2 = (self.hit2 << _M - 16) * self.have2
        rest = (1 << _M) - self.w2
        self.w1 = (rest * self.hit1 >> 16) * self.have1
        self.w0 = rest - self.w1

    def update(self, at1: np.ndarray, at2: np.ndarray, x: np.ndarray, same1: np.ndarray, same2: np.ndarray) -> None:
        self.t1[at1] = x
        self.t2[at2] = x
        # both follow their hits between 256 and 49152 of 65536, so the order-0 part keeps at least a sixteenth
        self.hit1 += ((same1 * 48896 + 256 - self.hit1) >> 4) * self.have1
        self.hit2 += ((same2 * 48896 + 256 - self.hit2) >> 4) * self.have2


def _lanes(ids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    count = -(-len(ids) // block)
    grid = np.zeros(count * block, dtype=np.uint16)
    grid[: len(ids)] = ids
    sizes = np.full(count, block)
    if count:
        sizes[-1] = len(ids) - (count - 1) * block
    return grid.reshape(count, block), sizes


def encode_blocks(ids: np.ndarray, block: int, cdf: np.ndarray) -> list[np.ndarray]:
    """The words of each block."""
    grid, sizes = _lanes(ids, block)
    out: list[np.ndarray] = []
    for base in range(0, len(grid), LANES):
        part, steps = grid[base : base + LANES], sizes[base : base + LANES]
        out += _encode(part, steps, cdf)
    return out


def _encode(grid: np.ndarray, sizes: np.ndarray, cdf: np.ndarray) -> list[np.ndarray]:
    lanes = len(grid)
    model = _Model(lanes)
    columns = np.ascontiguousarray(grid.T)
    low = np.zeros(lanes, dtype=np.uint64)
    span = np.full(lanes, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    words = np.zeros((lanes, len(columns) + 4), dtype=np.uint32)
    at = np.zeros(lanes, dtype=np.int64)
    last = int(sizes[-1])
    ahead = max(1, _AHEAD // lanes)
    before = np.zeros((2, lanes), dtype=np.int64)
    for step, x in enumerate(columns):
        if step % ahead == 0:
            wide = columns[step : step + ahead].astype(np.int64)
            start, stop = cdf[wide], cdf[wide + 1]
            past = np.concatenate([before, wide])
            slots1, slots2 = model.slots(past[1:-1], past[:-2])
            before = past[-2:]
        if step == last and lanes > 1:  # the last block may be shorter: its lane is left
            done = (low[-1].copy(), at[-1].copy())
        k = step % ahead
        model.predict(slots1[k], slots2[k])
        same1, same2 = model.p1 == x, model.p2 == x
        first = start[k] * model.w0 >> _T0
        size = (stop[k] * model.w0 >> _T0) - first + model.w1 * same1 + model.w2 * same2
        first += model.w1 * (model.p1 < x) + model.w2 * (model.p2 < x)
        unit = span >> np.uint64(_M)
        low += unit * first.view(np.uint64)
        span = unit * np.maximum(size, 1).view(np.uint64)
        go = np.flatnonzero(span <= _LOW32)
        if len(go):
            here, width = low[go], span[go]
            words[go, at[go]] = here >> _WORD
            at[go] += 1
            low[go], span[go] = _shifted(here, width)
        model.update(slots1[k], slots2[k], x, same1, same2)
    if last < len(columns) and lanes > 1:
        low[-1], at[-1] = done
    for _ in range(2):
        words[np.arange(lanes), at] = low >> _WORD
        low <<= _WORD
        at += 1
    return [words[i, : at[i]].copy() for i in range(lanes)]


def _shifted(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State after its upper word is out. A span of at most one word that crosses into the next is cut at the border."""
    over = (low + span - np.uint64(1) ^ low) > _LOW32
    span = np.where(over, (~low & _LOW32) + np.uint64(1), span)
    return low << _WORD, span << _WORD


def decode_blocks(words: list[np.ndarray], sizes: np.ndarray, cdf: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The ids of blocks, of which all but the last have the same size."""
    out = [_decode(words[i : i + LANES], sizes[i : i + LANES], cdf, slots) for i in range(0, len(words), LANES)]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint16)


def _decode(words: list[np.ndarray], sizes: np.ndarray, cdf: np.ndarray, slots: np.ndarray) -> np.ndarray:
    lanes, steps = len(words), int(sizes.max())
    model = _Model(lanes)
    grid = np.zeros((lanes, max(map(len, words)) + steps + 4), dtype=np.uint32)
    for i, w in enumerate(words):
        grid[i, : len(w)] = w
    flat, row = grid.ravel(), np.arange(lanes, dtype=np.int64) * grid.shape[1]
    code = grid[:, 0].astype(np.uint64) << _WORD | grid[:, 1].astype(np.uint64)  # less low
    at = row + 2
    low = np.zeros(lanes, dtype=np.uint64)
    span = np.full(lanes, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    out = np.empty((steps, lanes), dtype=np.uint16)
    a, b = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64)
    most = np.uint64((1 << _M) - 1)
    for step in range(steps):
        at1, at2 = model.slots(a, b)
        model.predict(at1, at2)
        p1, p2, w0, w1, w2 = model.p1, model.p2, model.w0, model.w1, model.w2
        unit = span >> np.uint64(_M)
        v = np.minimum(code // unit, most).view(np.int64)
        # where the shares of the two predicted ids begin and end among all ids' intervals
        low1, low2 = cdf.take(p1) * w0 >> _T0, cdf.take(p2) * w0 >> _T0
        high1, high2 = cdf[1:].take(p1) * w0 >> _T0, cdf[1:].take(p2) * w0 >> _T0
        low1 += w2 * (p2 < p1)
        low2 += w1 * (p1 < p2)
        high1 += w1 + w2 * (p2 <= p1)
        high2 += w2 + w1 * (p1 <= p2)
        over1, over2 = v >= high1, v >= high2
        is1, is2 = (v >= low1) & ~over1 & model.have1, (v >= low2) & ~over2 & model.have2
        rest = v - w1 * over1 - w2 * over2
        x = slots.take(((rest + 1 << _T0) - 1) // w0, mode="clip")
        x = np.where(is1, p1, np.where(is2, p2, x))
        same1, same2 = p1 == x, p2 == x
        wide = x.astype(np.int64)
        first = cdf.take(wide) * w0 >> _T0
        size = (cdf.take(wide + 1) * w0 >> _T0) - first + w1 * same1 + w2 * same2
        first += w1 * (p1 < x) + w2 * (p2 < x)
        move = unit * first.view(np.uint64)
        low += move
        code -= move
        span = unit * np.maximum(size, 1).view(np.uint64)
        go = np.flatnonzero(span <= _LOW32)
        if len(go):
            low[go], span[go] = _shifted(low[go], span[go])
            code[go] = code[go] << _WORD | flat.take(at[go], mode="clip")
            at[go] += 1
        model.update(at1, at2, x, same1, same2)
        out[step] = x
        a, b = wide, a
    return np.concatenate([out[: sizes[i], i] for i in range(lanes)])


def encode_segment(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One segment of whole documents; ids must be below 65535."""
    every = np.concatenate(ids) if ids else np.zeros(0, dtype=np.uint16)
    if len(every) and (every.min() < 0 or every.max() >= _NONE):
        raise ValueError("ids must be from 0 to 65534")
    block = int(np.clip(-(-len(every) // LANES), 256, BLOCK_IDS))
    symbols, counts = np.unique(every, return_counts=True)
    words: list[np.ndarray] = []
    if len(every):
        words = encode_blocks(every, block, _order0(symbols, counts)[0])
    crcs = [zlib.crc32(every[i * block : (i + 1) * block].astype("<u4").tobytes()) for i in range(len(words))]
    tables = b"".join(
        np.asarray(x, dtype=t).tobytes()
        for x, t in (
            ([d or 0 for d in doc_ids], "<i8"), ([d is None for d in doc_ids], "u1"), ([len(x) for x in ids], "<u8"),
            (symbols, "<u2"), (counts, "<u4"), ([len(w) for w in words], "<u4"), (crcs, "<u4"),
        )
    )
    packed = zlib.compress(struct.pack("<I", len(symbols)) + tables, 6)
    head = _HEAD.pack(MAGIC, len(doc_ids), len(every), block, len(words), len(packed))
    return b"".join([head, packed, *(w.astype("<u4").tobytes() for w in words)])


@dataclass
class Segment:
    doc_ids: list[int | None]
    lengths: np.ndarray
    ids: np.ndarray


def decode_segment(data: bytes) -> Segment:
    """Raises CorruptBlock if a block's checksum is wrong."""
    if len(data) < _HEAD.size or data[:4] != MAGIC:
        raise CorruptBlock("not a segment")
    _, docs, total, block, blocks, packed = _HEAD.unpack_from(data)
    raw = zlib.decompress(data[_HEAD.size : _HEAD.size + packed])
    (kinds,) = struct.unpack_from("<I", raw)
    at, got = 4, []
    for count, kind in ((docs, "<i8"), (docs, "u1"), (docs, "<u8"), (kinds, "<u2"), (kinds, "<u4"), (blocks, "<u4"), (blocks, "<u4")):
        got.append(np.frombuffer(raw, dtype=kind, count=count, offset=at))
        at += got[-1].nbytes
    names, nulls, lengths, symbols, counts, sizes, crcs = got
    stream = np.frombuffer(data, dtype="<u4", offset=_HEAD.size + packed)
    words = np.split(stream, np.cumsum(sizes.astype(np.int64))[:-1]) if blocks else []
    held = np.full(blocks, block, dtype=np.int64)
    if blocks:
        held[-1] = total - (blocks - 1) * block
    ids = decode_blocks(words, held, *_order0(symbols, counts)) if blocks else np.zeros(0, dtype=np.uint16)
    for i, crc in enumerate(crcs.tolist()):
        if zlib.crc32(ids[i * block : (i + 1) * block].astype("<u4").tobytes()) != crc:
            raise CorruptBlock(f"block {i} of {blocks}")
    return Segment([None if z else int(n) for n, z in zip(names, nulls, strict=True)], lengths.astype(np.int64), ids)


def segments(rows: Iterable[tuple[int | None, np.ndarray]], limit: int = SEGMENT_IDS) -> Iterator[tuple[bytes, int, int]]:
    """(bytes, documents, ids) of each segment of a run of documents."""
    names: list[int | None] = []
    ids: list[np.ndarray] = []
    held = 0
    for name, own in rows:
        names.append(name)
        ids.append(own)
        held += len(own)
        if held >= limit:
            yield encode_segment(names, ids), len(names), held
            names, ids, held = [], [], 0
    if names:
        yield encode_segment(names, ids), len(names), held
