"""JSON arrays read by byte ranges, so that one large file is as many tasks as it needs.

Whether a byte stands in a string, and how deep in brackets, depends on all bytes before it. So each range first tells what it does to
that state: how many quotes it holds, odd or even, and how much deeper it leads if it begins outside a string and if it begins in one.
These are composed in order, which gives every range its state at the begin. Then each range finds the commas between the array's elements
and gives the elements that begin in it; the last one is read on past the range's end.

A range begins at a byte that follows no backslash, so escapes never cross from one to the next. Files are read through
pyarrow's file systems. Only a row of numbers for each range reaches the driver; elements are parsed by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import _fs

#: Bytes of a range, and of a read past its end.
STEP, FURTHER = 32 << 20, 1 << 16
QUOTE, OPEN, SHUT, COMMA, BACKSLASH = 34, (91, 123), (93, 125), 44, 92
_WEIGHT = np.zeros(256, dtype=np.int64)
_WEIGHT[list(OPEN)], _WEIGHT[list(SHUT)] = 1, -1
_MARK = np.zeros(256, dtype=bool)
_MARK[[QUOTE, COMMA, *OPEN, *SHUT]] = True


class NotAnArray(ValueError):
    """A file holds no JSON array."""


def _source(path: str) -> pa.NativeFile:
    system, at = fs.FileSystem.from_uri(path if "://" in path else path if path.startswith("file:") else f"file://{path}")
    return system.open_input_file(at)


def _begin(source: pa.NativeFile, at: int, size: int) -> int:
    """The first place from ``at`` on that follows no backslash."""
    while 0 < at < size:
        before = source.read_at(min(FURTHER, size - at + 1), at - 1)
        own = np.flatnonzero(np.frombuffer(before, dtype=np.uint8) != BACKSLASH)
        if len(own):
            return min(size, at + int(own[0]))
        at += len(before)
    return min(at, size)


def marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, bytes) of quotes that aren't escaped, brackets and commas; ``data`` follows no backslash."""
    at = np.flatnonzero(_MARK[data])
    kinds = data[at]
    slashes = np.flatnonzero(data == BACKSLASH)
    if len(slashes):
        first = np.concatenate([[True], np.diff(slashes) > 1])
        run = slashes - np.maximum.accumulate(np.where(first, slashes, 0)) + 1  # backslashes up to each, in its run
        near = np.searchsorted(slashes, at - 1)
        follows = (near < len(slashes)) & (slashes[np.minimum(near, len(slashes) - 1)] == at - 1)
        escaped = follows & (run[np.minimum(near, len(slashes) - 1)] % 2 == 1) & (kinds == QUOTE)
        at, kinds = at[~escaped], kinds[~escaped]
    return at, kinds


def effect(data: np.ndarray) -> tuple[int, int, int]:
    """(quotes modulo 2, change of depth if it begins outside a string, if it begins in one)."""
    _, kinds = marks(data)
    inside = np.cumsum(kinds == QUOTE) % 2 == 1
    weight = _WEIGHT[kinds]
    return int((kinds == QUOTE).sum() % 2), int(weight[~inside].sum()), int(weight[inside].sum())


def cuts(data: np.ndarray, in_string: bool, depth: int) -> np.ndarray:
    """Places of the array's own brackets and of the commas between its elements."""
    at, kinds = marks(data)
    outside = (np.cumsum(kinds == QUOTE) + in_string) % 2 == 0
    at, kinds = at[outside], kinds[outside]
    after = depth + np.cumsum(_WEIGHT[kinds])
    return at[((kinds == COMMA) & (after == 1)) | ((_WEIGHT[kinds] == 1) & (after == 1)) | ((_WEIGHT[kinds] == -1) & (after == 0))]


def _state(data: np.ndarray, in_string: bool, depth: int) -> tuple[bool, int]:
    odd, out, inner = effect(data)
    return bool(in_string ^ odd), depth + (inner if in_string else out)


def elements(source: pa.NativeFile, begin: int, end: int, size: int, in_string: bool, depth: int) -> Iterator[bytes]:
    """Texts of the elements that begin in bytes ``begin`` to ``end``."""
    text = source.read_at(end - begin, begin)
    data = np.frombuffer(text, dtype=np.uint8)
    own = cuts(data, in_string, depth)
    for a, b in zip(own[:-1].tolist(), own[1:].tolist(), strict=True):
        yield text[a + 1 : b]
    if not len(own):
        return
    state = _state(data, in_string, depth)
    if state == (False, 0) and data[own[-1]] in SHUT:
        return  # the array's end
    tail, at = [text[own[-1] + 1 :]], end
    while at < size:
        stop = _begin(source, min(size, at + FURTHER), size)
        text = source.read_at(stop - at, at)
        data = np.frombuffer(text, dtype=np.uint8)
        found = cuts(data, *state)
        if len(found):
            tail.append(text[: found[0]])
            break
        tail.append(text)
        state, at = _state(data, *state), stop
    yield b"".join(tail)


def split_array(spark: SparkSession, path: str, step: int = STEP) -> DataFrame:
    """(value) the elements' texts of the JSON arrays in the files at ``path``, which may be a pattern; one task for every ``step`` bytes.

    An empty array and an empty file have no rows. A file whose first character isn't ``[`` is an error. Elements come in no order.
    """
    system, at = _fs(spark, path)
    files = [(x.getPath().toString(), x.getLen()) for x in system.globStatus(at) or [] if x.isFile() and x.getLen() > 0]
    pieces = [(f, size, lo) for f, size in files for lo in range(0, size, step)]
    schema = "file string, size long, at long"
    if not pieces:
        return spark.createDataFrame([], "value string")
    # a row of numbers for each range
    ranges = spark.createDataFrame(pieces, schema).repartition(len(pieces))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with _source(r["file"]) as source:
                    lo, hi = (_begin(source, x, r["size"]) for x in (r["at"], r["at"] + step))
                    text = source.read_at(hi - lo, lo)
                if not r["at"] and text.lstrip(b" \t\r\n\xef\xbb\xbf")[:1] not in (b"[", b""):
                    raise NotAnArray(r["file"])
                row = (r["file"], r["size"], lo, hi, *effect(np.frombuffer(text, dtype=np.uint8)))
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["file", "size", "lo", "hi", "odd", "out", "inner"])

    seen = ranges.mapInArrow(look, "file string, size long, lo long, hi long, odd long, out long, inner long").collect()
    begun, last, state = [], None, (False, 0)
    for r in sorted(seen, key=lambda r: (r["file"], r["lo"], r["hi"])):
        if r["file"] != last:
            last, state = r["file"], (False, 0)
        begun.append((r["file"], r["size"], r["lo"], r["hi"], *state))
        state = (bool(state[0] ^ r["odd"]), state[1] + (r["inner"] if state[0] else r["out"]))
    known = spark.createDataFrame(begun, "file string, size long, lo long, hi long, in_string boolean, depth long").repartition(len(begun))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                held, size = [], 0
                with _source(r["file"]) as source:
                    for text in elements(source, r["lo"], r["hi"], r["size"], r["in_string"], r["depth"]):
                        text = text.strip(b" \t\r\n")
                        if text:
                            held.append(text.decode("utf-8", "replace"))
                            size += len(text)
                        if size > 1 << 22 or len(held) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])
                            held, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])

    return known.mapInArrow(read, "value string")


def read_json_array(spark: SparkSession, path: str, schema: str, step: int = STEP) -> DataFrame:
    """Rows (``schema``) of the JSON arrays at ``path``; unknown keys are ignored, missing ones null, elements that are no objects too."""
    return split_array(spark, path, step).select(F.from_json("value", schema).alias("r")).select("r.*")
