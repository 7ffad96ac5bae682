"""SimHash near-duplicate detection by bit-sliced comparison.

Fingerprints come from word shingles; equal fingerprints collapse to one row. Candidate buckets:

* 64-bit fingerprints, small radius: exact. The bits are cut into ``radius + 2`` blocks, and two fingerprints within
  the radius agree on at least two whole blocks, so there is one table for each pair of blocks. A bucket above ``BLOCK``
  fingerprints is cut again by further agreeing bits until it fits (``radius + 1`` sub-blocks of its free bits, of which
  one must agree), so no group is collected unbounded and no link is lost.
* 256-bit fingerprints, wide radius (similarity 0.8 of texts is about 39 differing bits): ``TABLES`` tables, each keyed by
  ``KEY_BITS`` sampled bits, whatever the number of fingerprints. Two texts of similarity 0.8 agree on a bit with probability
  0.85 and so meet in some table with probability 0.97; of those that meet the radius keeps nearly all. A bucket above
  ``CELL`` is compared block against block, so no pair that shares a key is skipped.

In a bucket the fingerprints stand as bit planes; every fingerprint is compared with 64 others per machine word, distances
are kept in carry-save bit counters, and a word of 64 is abandoned as soon as all of it is beyond the radius. Links leave
a bucket as one edge from each member to the least member of its component, never as all pairs; of wide fingerprints, as a
spanning forest of links. These are checked on the texts: only a Jaccard similarity of the shingle sets of at least
``similarity`` joins. Where a link of a component fails, its members are compared again, now with their shingles beside them,
and in the task every link between parts that aren't joined yet is checked, nearest first, so the result is that of checking
all links, and only links that join leave the task. Components are then joined by alternating star contraction over edge
tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import materialize, mix64, random_words, release_memory, worker_memory

BITS = 64
#: Most fingerprints that are compared in one bucket, about; 2**10, so a cut to 10 free bits always fits.
BLOCK = 1024
#: Of wide fingerprints: 64-bit words, tables and bits of a key.
WIDE, TABLES, KEY_BITS = 4, 48, 16
#: Wide fingerprints of a block of a crowded bucket, about.
CELL = 2048
#: Shingles of a block of a component whose members are compared again, about (64 MB), and members above which its buckets are.
CELL_SHINGLES, MEMBERS = 8 << 20, 16384
#: So many crowded buckets (16 bytes each) are broadcast at most; more are joined by a shuffle.
FEW_BUCKETS = 100_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SALT = random_words(51, WIDE)
#: The bits of each table's key, sampled by a fixed rule.
_KEYS = np.array([np.argsort(random_words(61 + t, 64 * WIDE))[:KEY_BITS] for t in range(TABLES)])
_KEY_MASKS = np.array([np.packbits(np.isin(np.arange(64 * WIDE), k), bitorder="little").view("<u8") for k in _KEYS])


def _shingles(text: str | None, words: int) -> np.ndarray:
    """Unsigned XXH64 (seed 42) of every shingle, repeats included; the whole sequence if it is shorter."""
    parts = (text or "").encode().translate(_LOWER).split()
    n = len(parts)
    digest = xxhash.xxh64_intdigest
    if not n:
        return np.zeros(0, dtype="<u8")
    if n <= words:
        return np.array([digest(b" ".join(parts), 42)], dtype="<u8")
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate([[0], ends[: n - words]]).tolist()
    ends = (ends[words - 1 :] - 1).tolist()
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends, strict=True)), dtype="<u8", count=len(starts))


def _majority(hashes: np.ndarray) -> np.ndarray:
    """The word whose bits are set in over half the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 14):
        part = hashes[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")


def fingerprint(text: str | None, words: int = 3) -> int:
    """Unsigned 64-bit SimHash; 0 for a text without words."""
    return int(_majority(_shingles(text, words))[0])


def wide_fingerprint(text: str | None, words: int = 5) -> np.ndarray:
    """``WIDE`` words of SimHash: each shingle's hash is mixed with as many salts."""
    hashes = _shingles(text, words)
    return np.concatenate([_majority(mix64(hashes ^ salt).astype("<u8")) for salt in _SALT])


def _digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(np.unique(hashes).tobytes())


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int, wide: bool, keyed: bool = False) -> DataFrame:
    """(doc, fp) for every row, with row, the text's xxhash64, if wide or keyed; null text counts as empty. fp is long or, if wide, the fingerprint and a digest of the set of
    shingles, as texts of one fingerprint may differ in these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("simhash")
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = part.column(1).to_pylist()
                if wide:
                    fps = pa.array([wide_fingerprint(t, words).tobytes() + _digest(_shingles(t, words)) for t in texts], pa.binary())
                else:
                    fps = pa.array(np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), fps, *part.columns[2:]], names=["doc", "fp", *also])
        release_memory()

    also = ["row"] if wide or keyed else []
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), *(F.xxhash64(F.col(text_col)).alias(c) for c in also))
    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, fp {'binary' if wide else 'long'}" + "".join(f", {c} long" for c in also))


def adjacency(fps: np.ndarray, starts: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i > j, of rows of one group within ``radius``; ``fps`` is n x words, groups begin at ``starts``.

    ``planes[b]`` holds bit b of all fingerprints, 64 to a word. A lane is a fingerprint against one word of its
    group. The counters are bit-sliced too: counter plane c has bit c of every running distance.
    """
    n, wide = fps.shape
    total = 64 * wide
    width = -(-n // 64)
    pad = np.zeros((width * 64, total), dtype=np.uint8)
    pad[:n] = np.unpackbits(np.ascontiguousarray(fps).astype("<u8").view(np.uint8).reshape(n, 8 * wide), axis=1, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(np.ascontiguousarray(pad.T), axis=1, bitorder="little")).view("<u8")
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    begin, own = starts[group], np.arange(n)
    first = begin // 64
    words = np.where(own > begin, (own - 1) // 64 - first + 1, 0)  # those that hold earlier rows of the group
    depth = (radius + 1).bit_length()
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    lo = 0
    while lo < n:
        hi = lo + max(1, int(np.searchsorted(np.cumsum(words[lo:]), 1 << 14)))
        count = words[lo:hi]
        r = np.repeat(np.arange(lo, hi), count)
        w = np.repeat(first[lo:hi], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        lo = hi
        below = np.maximum(begin[r] - 64 * w, 0).astype(np.uint64)
        above = np.maximum(64 * w + 64 - r, 0).astype(np.uint64)
        far = ~((full << below) & (full >> above))  # other groups' rows, the row itself and later ones
        counter = [np.zeros(len(r), dtype=np.uint64) for _ in range(depth)]
        for b in range(total):
            carry = planes[b][w] ^ (np.uint64(0) - pad[r, b].astype(np.uint64))
            for c in range(depth):
                counter[c], carry = counter[c] ^ carry, counter[c] & carry
            far |= carry
            if b % 16 == 15 or b == total - 1:
                over = np.zeros(len(r), dtype=np.uint64)
                same = np.full(len(r), full)
                for c in reversed(range(depth)):  # counter > radius, bit by bit from the top
                    if radius >> c & 1:
                        same = same & counter[c]
                    else:
                        over |= same & counter[c]
                        same = same & ~counter[c]
                far |= over
                live = far != full
                if not live.all():
                    r, w, far = r[live], w[live], far[live]
                    counter = [c[live] for c in counter]
        near = np.unpackbits((~far).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        k, bit = np.nonzero(near)
        yield r[k], w[k] * 64 + bit


def _united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels after the links (a, b) join components, and the numbers of those links that joined two: a spanning forest."""
    used = [np.zeros(0, dtype=np.int64)]
    while True:
        x, y = label[a], label[b]
        apart = np.flatnonzero(x != y)
        if not len(apart):
            return label, np.concatenate(used)
        high, low = np.maximum(x, y)[apart], np.minimum(x, y)[apart]
        order = np.lexsort((low, high))
        kinds, at = np.unique(high[order], return_index=True)
        parent = np.arange(len(label))
        parent[kinds] = low[order][at]
        used.append(apart[order[at]])
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]


def forest(fps: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j) within ``radius`` that span each component of each group, near ones rather than far ones; memory
    doesn't grow with the number of links."""
    label, links = np.arange(len(fps)), [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for a, b in adjacency(fps, starts, radius):
        apart = np.bitwise_count(fps[a] ^ fps[b]).sum(axis=1)
        for low, high in ((-1, radius // 2), (radius // 2, 3 * radius // 4), (3 * radius // 4, radius)):
            own = np.flatnonzero((apart > low) & (apart <= high))
            label, at = _united(label, a[own], b[own])
            links.append((a[own][at], b[own][at]))
    a, b = (np.concatenate(x) for x in zip(*links, strict=True))
    return a, b


def components(fps: np.ndarray, starts: np.ndarray, radius: int) -> np.ndarray:
    """For each row the first row of its component: links join rows of one group. Memory doesn't grow with the links."""
    label = np.arange(len(fps))
    for a, b in adjacency(fps, starts, radius):
        label, _ = _united(label, a, b)
    return label


def _first_table(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first table whose key two fingerprints share."""
    out = np.full(len(x), TABLES)
    for t in reversed(range(TABLES)):
        out[(((x ^ y) & _KEY_MASKS[t]) == 0).all(axis=1)] = t
    return out


def _shared(sets: list[np.ndarray], group: np.ndarray) -> np.ndarray:
    """How many shingles of each row another row of its group has too."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    flat = np.concatenate(sets)
    order = np.lexsort((flat, group[owner]))
    same = (flat[order][1:] == flat[order][:-1]) & (group[owner[order]][1:] == group[owner[order]][:-1])
    both = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    return np.bincount(owner[order][both], minlength=len(sets))


def verified_forest(fps: np.ndarray, starts: np.ndarray, root: np.ndarray, sets: list[np.ndarray], radius: int, similarity: float) -> tuple[list[int], list[int]]:
    """Links (i, j) of at least ``similarity`` that join rows of different ``root`` as far as any such links do.

    Links are those of rows of one group that share a table's key, within the radius. A pair that can't reach the similarity,
    by the rows' sizes and by how many of their shingles any other row has, isn't checked; nor is one that is joined by then.
    """
    kinds, part = np.unique(root, return_inverse=True)
    parent = np.arange(len(kinds))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(fps))))
    size, shared = np.array([len(x) for x in sets]), _shared(sets, group)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    one: list[int] = []
    two: list[int] = []
    for a, b in adjacency(fps, starts, radius):
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]
        may = (parent[part[a]] != parent[part[b]]) & (np.minimum(shared[a], shared[b]) >= similarity / (1 + similarity) * (size[a] + size[b]) - 1e-9)
        a, b = a[may], b[may]
        meet = _first_table(fps[a], fps[b]) < TABLES
        a, b = a[meet], b[meet]
        order = np.argsort(np.bitwise_count(fps[a] ^ fps[b]).sum(axis=1), kind="stable")
        for i, j in zip(a[order].tolist(), b[order].tolist(), strict=True):
            x, y = find(part[i]), find(part[j])
            if x == y:
                continue
            at = np.searchsorted(sets[i], sets[j])
            both = int((sets[i][np.minimum(at, size[i] - 1)] == sets[j]).sum()) if size[i] else 0
            if both >= similarity * (size[i] + size[j] - both) - 1e-9:
                parent[max(x, y)] = min(x, y)
                one.append(i), two.append(j)
    return one, two


def compared(rows: DataFrame, radius: int, similarity: float | None = None) -> DataFrame:
    """Edges (a, b) within the groups (g1, g2) of ``rows``, which also have node long and fp binary (the node if not).

    A task streams its sorted groups and compares about 4096 rows of whole groups at a time. Edges of wide fingerprints are
    links within the radius that span their components, those of others lead to the least member. If ``rows`` have root and
    set (array<long>, sorted), edges join nodes of different roots and are of at least ``similarity``.
    """
    wide, checked = "fp" in rows.columns, "set" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush(upto: bool):
            group, node, raw, root = (np.concatenate([h[k] for h in held]) for k in range(4))
            sets = [x for h in held for x in h[4]]
            held.clear()
            cut = np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1
            stop = len(node) if not upto else int(cut[-1]) if len(cut) else 0
            if stop < len(node):
                held.append((group[stop:], node[stop:], raw[stop:], root[stop:], sets[stop:]))
            if not stop:
                return
            starts = np.concatenate([[0], cut[cut < stop]]).astype(np.int64)
            node = node[:stop]
            if checked:
                a, b = verified_forest(raw[:stop], starts, root[:stop], sets[:stop], radius, similarity)
            elif wide:
                a, b = forest(raw[:stop], starts, radius)
            else:
                label = components(raw[:stop], starts, radius)
                a = np.flatnonzero(label != np.arange(stop))
                b = label[a]
            a, b = np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 1024 if checked else 4096):
                part = batch.slice(lo, 1024 if checked else 4096)
                g = np.stack([part.column(0).to_numpy(), part.column(1).to_numpy()], axis=1)
                node = part.column(2).to_numpy()
                raw = np.frombuffer(b"".join(part.column(3).to_pylist()), dtype="<u8") if wide else node.view("<u8")
                sets: list[np.ndarray] = []
                if checked:
                    ends, flat = part.column(5).offsets.to_numpy(), part.column(5).values.to_numpy()
                    sets = [flat[x:y].copy() for x, y in zip(ends, ends[1:], strict=False)]
                held.append((g, node, raw.reshape(len(g), -1), part.column(4).to_numpy() if checked else node, sets))
                if sum(len(h[1]) for h in held) >= 4096 or sum(len(x) for h in held for x in h[4]) >= CELL_SHINGLES:
                    yield from flush(True)
        if held:
            yield from flush(False)
        release_memory()

    rows = rows.select("g1", "g2", "node", *(["fp"] if wide else []), *(["root", "set"] if checked else []))
    return rows.repartition("g1", "g2").sortWithinPartitions("g1", "g2", "node").mapInArrow(run, "a long, b long")


def _blocks(positions: list[int], parts: int) -> list[list[int]]:
    cut = [round(i * len(positions) / parts) for i in range(parts + 1)]
    return [positions[a:b] for a, b in zip(cut, cut[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _mask(positions: list[int]) -> int:
    return sum(1 << p for p in positions)


def _crowded(keyed: DataFrame, name: str) -> DataFrame:
    """Rows (g1, g2, ...) of groups of two or more, with the group's size n."""
    sizes = keyed.groupBy("g1", "g2").agg(F.count("*").alias("n")).filter("n > 1")
    return materialize(keyed.join(sizes, ["g1", "g2"]), name)


def links(fps: DataFrame, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that join every two distinct 64-bit fingerprints within the radius into one component.
    ``fps`` has one column fp with distinct values, which are the nodes."""
    spark = fps.sparkSession
    blocks = _blocks(list(range(BITS)), radius + 2)
    masks = [_mask(sum((blocks[i] for i in keep), [])) for keep in combinations(range(radius + 2), 2)]
    rows = fps.select("fp", F.explode(F.array(*(F.lit(_signed(m)) for m in masks))).alias("g1"))
    edges = None
    while True:
        joined = _crowded(rows.withColumn("g2", F.col("fp").bitwiseAND(F.col("g1"))), "simhash-buckets")
        fine = joined.filter(F.col("n") <= block).select("g1", "g2", F.col("fp").alias("node"))
        more = compared(fine, radius)
        edges = more if edges is None else edges.unionByName(more)
        big = joined.filter(F.col("n") > block)
        wide = [x["g1"] for x in big.select("g1").distinct().collect()]  # at most some hundred masks
        if not wide:
            return edges.distinct()
        deeper = []
        for m in wide:
            free = [p for p in range(BITS) if not m >> p & 1]
            deeper += [(m, _signed((m & ((1 << 64) - 1)) | _mask(s))) for s in _blocks(free, radius + 1) if s]
        finer = spark.createDataFrame(deeper, "g1 long, finer long")
        rows = big.select("fp", "g1").join(F.broadcast(finer), "g1").select("fp", F.col("finer").alias("g1"))


def _buckets(keyed: DataFrame, block: int) -> tuple[DataFrame, bool]:
    """(g1, g2, n) of the buckets above ``block``, for a join; and whether there are any."""
    crowded = materialize(keyed.groupBy("g1", "g2").agg(F.count("*").alias("n")).filter(F.col("n") > block), "simhash-crowded")
    count = crowded.count()
    return F.broadcast(crowded) if count <= FEW_BUCKETS else crowded, count > 0


def _cells(rows: DataFrame, blocks: Column) -> DataFrame:
    """``rows`` (g1, g2, node, ...) with groups of more than one block cut: each node stands in a cell with every other block."""
    own = F.pmod(F.xxhash64("node"), blocks)
    cell = lambda j: F.xxhash64("g2", F.least(own, j), F.greatest(own, j))
    others = F.filter(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda j: j != own)
    cells = F.when(F.coalesce(blocks, F.lit(1)) <= 1, F.array("g2")).otherwise(F.transform(others, cell))
    return rows.select("g1", F.explode(cells).alias("g2"), *(c for c in rows.columns if c not in ("g1", "g2", "n")))


def wide_links(fps: DataFrame, radius: int, block: int = CELL, similarity: float | None = None) -> DataFrame:
    """Edges that join all nodes (node long, fp binary) within the radius that share a table's key; each is such a link.
    With columns root and set as for ``compared``, of at least ``similarity``."""
    also = ["root", "set"] if "set" in fps.columns else []

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = 1 << np.arange(KEY_BITS, dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64 if also else 1024):
                part = batch.slice(lo, 64 if also else 1024)
                raw = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint8).reshape(part.num_rows, 8 * WIDE)
                bits = np.unpackbits(raw, axis=1, bitorder="little")
                table = np.repeat(np.arange(TABLES, dtype=np.int64), part.num_rows)
                key = np.concatenate([bits[:, k].astype(np.int64) @ weight for k in _KEYS])
                again = pa.array(np.tile(np.arange(part.num_rows), TABLES))
                columns = [pa.array(table), pa.array(key), *(c.take(again) for c in part.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=["g1", "g2", "node", "fp", *also])
        release_memory()

    rows = fps.select("node", F.substring("fp", 1, 8 * WIDE).alias("fp"), *also)
    rows = rows.mapInArrow(keys, "g1 long, g2 long, node long, fp binary" + (", root long, set array<long>" if also else ""))
    crowded, some = _buckets(rows, block)
    if some:
        rows = _cells(rows.join(crowded, ["g1", "g2"], "left"), F.ceil(F.col("n") / block))
    return compared(rows, radius, similarity).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node of its component.

    Large-star and small-star steps alternate until the edge set stands still; each round is a table
    in the shared folder, and only a count and a checksum reach the driver.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        # read back, so that the join can split the edges of a node that has very many
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m")), "simhash-least")
        large = both.join(least, both["a"] == least["u"]).filter("b > u").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.distinct(), "simhash-large")
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u"), "simhash-low")
        small = large.join(low, large["a"] == low["u"]).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = materialize(small.union(low.select(F.col("u"), F.col("m"))).distinct(), "simhash-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct()
            )
        state = now


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= FEW_BUCKETS else df


def shingle_sets(docs: DataFrame, text_col: str, wanted: DataFrame, words: int) -> DataFrame:
    """(node, set array<long>) for the nodes of ``wanted`` (node, row): the shingles of the text whose xxhash64 is row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("simhash")
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                sets = [np.unique(_shingles(t, words).view(np.int64)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "set"])
        release_memory()

    rows = docs.select(F.xxhash64(F.col(text_col)).alias("row"), F.col(text_col).alias("text")).join(_few(wanted), "row")
    return materialize(rows.select("node", "text").mapInArrow(run, "node long, set array<long>").dropDuplicates(["node"]), "simhash-sets")


def checked(edges: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``edges`` (a, b) with ok: whether the Jaccard similarity of the two sets is at least ``similarity``."""
    one, two = sets.toDF("a", "x"), sets.toDF("b", "y")
    both = F.size(F.array_intersect("x", "y"))
    ok = both >= similarity * (F.size("x") + F.size("y") - both) - 1e-9
    return materialize(edges.join(one, "a").join(two, "b").select("a", "b", ok.alias("ok")), "simhash-checked")


def verified_links(classes: DataFrame, docs: DataFrame, text_col: str, words: int, radius: int, similarity: float) -> DataFrame:
    """Edges that join all ``classes`` (node, fp, row) which share a table's key, are within the radius and of at least ``similarity``."""
    first = materialize(wide_links(classes, radius), "simhash-candidates")
    nodes = _few(first.select(F.col("a").alias("node")).union(first.select("b")).distinct())
    sets = shingle_sets(docs, text_col, materialize(classes.join(nodes, "node").select("node", "row"), "simhash-wanted"), words)
    found = checked(first, sets, similarity)
    good = found.filter("ok").select("a", "b")
    failed = found.filter("NOT ok").select("a").distinct()
    if failed.isEmpty():
        return good
    candidates = connected(first)
    torn = candidates.join(failed, candidates["node"] == failed["a"]).select(F.col("root").alias("torn")).distinct()
    members = materialize(candidates.join(torn, candidates["root"] == torn["torn"]).select("node", "torn"), "simhash-torn")
    parts = connected(good).toDF("of", "part")
    again = members.join(parts, F.col("node") == F.col("of"), "left").select("node", "torn", F.coalesce("part", "node").alias("root"))
    again = again.join(sets, "node").join(classes.select(F.col("node").alias("of"), "fp"), F.col("node") == F.col("of"))
    again = materialize(again.select("node", "torn", F.substring("fp", 1, 8 * WIDE).alias("fp"), "root", "set"), "simhash-again")
    sizes = again.groupBy("torn").agg(F.count("*").alias("n"), F.sum(F.size("set")).alias("shingles"))
    sizes = materialize(sizes.withColumnRenamed("torn", "of"), "simhash-sizes")
    again = again.join(sizes, F.col("torn") == F.col("of"))
    whole = again.filter(F.col("n") <= MEMBERS).select(F.lit(0).cast("long").alias("g1"), F.col("torn").alias("g2"), "node", "fp", "root", "set", "n", "shingles")
    blocks = F.greatest(F.ceil(F.col("n") / CELL), F.ceil(F.col("shingles") / CELL_SHINGLES))
    good = good.union(compared(_cells(whole, blocks).drop("shingles"), radius, similarity))
    rest = again.filter(F.col("n") > MEMBERS).select("node", "fp", "root", "set")
    return good if rest.isEmpty() else good.union(wide_links(rest, radius, similarity=similarity))


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2, wide: bool = False,
    similarity: float = 0.8, keyed: bool = False,
) -> DataFrame:
    """(doc, fp, component) for every row of ``docs``; if wide, links are of texts of at least ``similarity``. If keyed, row (the
    text's xxhash64) stands before the component.

    Defined results: null text and text without words get fingerprint 0 and link like any other; repeated rows and equal
    texts share a component; a null id takes part, but a component's name is its least non-null id (null if it has none);
    no rows give no rows. Only the two named columns are read, so other columns may have any names.
    """
    prints = materialize(with_fingerprints(docs, id_col, text_col, words, wide, keyed), "simhash-prints")
    classes = prints.groupBy("fp").agg(F.min("doc").alias("least"), *([F.min("row").alias("row")] if wide else []))
    node = F.xxhash64("fp") if wide else F.col("fp")
    classes = classes.withColumn("node", node)
    if wide:
        classes = materialize(classes, "simhash-classes")
    if wide:
        edges = verified_links(classes, docs, text_col, words, radius, similarity)
    else:
        edges = links(classes.select("fp"), radius)
    roots = connected(edges)
    roots = roots.withColumnRenamed("node", "of")
    named = classes.join(roots, F.col("node") == F.col("of"), "left")
    named = materialize(named.select("fp", "least", F.coalesce("root", "node").alias("root")), "simhash-classes")
    names = materialize(named.groupBy("root").agg(F.min("least").alias("component")), "simhash-names")
    by_class = named.select("fp", "root").join(names, "root").select(F.col("fp").alias("class"), "component")
    return prints.join(by_class, F.col("fp") == F.col("class")).select("doc", "fp", *(["row"] if keyed else []), "component")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, radius: int = 56, wide: bool = True
) -> DataFrame:
    """The rows of ``docs`` whose id names their component: one document of each group (of rows of a group that
    repeat its id, all stay; rows with a null id stay only in components without any id). Each row is judged by its own text,
    whatever other rows have its id. Null, empty and wordless texts are near each other; no rows give no rows; columns, extra ones too,
    keep their names."""
    groups = simhash_groups(docs, id_col, text_col, words, radius, wide, keyed=True)
    gone = groups.filter(~F.col("doc").eqNullSafe(F.col("component"))).select(F.col("doc").alias("_gone"), F.col("row").alias("_row"))
    return docs.join(gone.distinct(), docs[id_col].eqNullSafe(gone["_gone"]) & (F.xxhash64(docs[text_col]) == gone["_row"]), "left_anti")
