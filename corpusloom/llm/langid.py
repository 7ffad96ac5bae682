"""Language identification by nearest centroid.

Texts become TF-IDF vectors of hashed character n-grams (1 to 3, lower-cased letters, words edged by a
space), log-damped and L2-normalised. Each language has several centroids from spherical k-means, so
distinct styles of one language don't blur. A text goes to the language of the most similar centroid by
cosine; it is rejected if it is farther from that centroid than nearly all held-out texts of its length were,
times a slack, and never accepted beyond ``CAP``.

The classifier is fitted on a bounded sample: at most about ``SAMPLE`` labelled rows for each language,
chosen by a hash of the id. Document frequencies, then centroids and held-out distances are found by one task a
language, so a task's memory doesn't grow with the number of languages. Prediction reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .textkit import materialize, mix64, random_words, worker_memory

DIM = 4096
ORDERS = (1, 2, 3)
#: Labelled rows of a language that training reads, about.
SAMPLE = 1000
#: Centroids of a language.
CLUSTERS = 4
#: Least share of a language's rows that a cluster has.
LEAST_SHARE = 0.02
#: Of held-out distances of a language: quantile, factor on it, most that a limit can be, and least texts for a limit of its own.
QUANTILE, SLACK, CAP, LEAST = 0.98, 1.1, 0.8, 50
#: Letters from which a limit of its own holds; shorter texts have ``CAP``.
LENGTHS = (16, 64, 256, 1024)
#: Languages that training accepts; more are an error.
LANGUAGES = 256
UND = "und"
_TABLE = random_words(23, 4)
_CHUNK = 1 << 18


def _codes(text: str | None) -> np.ndarray:
    """Lower-cased letters as code points, every run of anything else as one 0; empty if no letters."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    low = text.lower()
    a = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = (a >= 97) & (a <= 122)
    high = np.flatnonzero(a >= 128)
    if len(high):
        kinds, back = np.unique(a[high], return_inverse=True)
        letter[high] = np.array([chr(k).isalpha() for k in kinds])[back]
    if not letter.any():
        return np.zeros(0, dtype=np.uint64)
    keep = letter | np.concatenate([[True], letter[:-1]])
    out = np.where(letter, a, 0)[keep].astype(np.uint64)
    return out if out[0] == 0 else np.concatenate([np.zeros(1, np.uint64), out])


def features(text: str | None, most: int | None = None) -> np.ndarray | None:
    """Counts of hashed n-grams over the whole text or its first ``most`` letters, about; None without letters."""
    codes = _codes(text if most is None or not text else text[: 4 * most])[:most]
    if not len(codes):
        return None
    counts = np.zeros(DIM)
    for lo in range(0, len(codes), _CHUNK):
        part = codes[lo : lo + _CHUNK + max(ORDERS) - 1]
        for order in ORDERS:
            n = min(len(part) - order + 1, _CHUNK)
            if n > 0:
                h = sum(part[i : i + n] * _TABLE[i] for i in range(order)) + np.uint64(order)
                counts += np.bincount((mix64(h) % np.uint64(DIM)).astype(np.int64), minlength=DIM)
    return counts


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(v, axis=-1, keepdims=True)
    return v / np.where(norm > 0, norm, 1)


@dataclass
class Model:
    """``langs[k]``, ``centroids[k]`` and ``radii[k]`` (most cosine distance by length) of each centroid; idf weights."""

    langs: list[str]
    centroids: np.ndarray
    radii: np.ndarray
    idf: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine 0..1, rejected). Without letters: und, 0, rejected."""
        counts = features(text)
        if counts is None or not self.langs:
            return UND, 0.0, True
        near = self.centroids @ _unit(np.log1p(counts) * self.idf).astype(np.float32)
        k = int(near.argmax())
        score = min(1.0, max(0.0, float(near[k])))
        return self.langs[k], score, bool(1 - score > self.radii[k][_length(counts)])


def _length(counts: np.ndarray) -> int:
    return int(np.searchsorted(LENGTHS, counts.sum() / len(ORDERS), side="right"))


def _clusters(own: np.ndarray) -> np.ndarray:
    """Centroids of the rows by spherical k-means. Seeds are drawn with probability by squared distance (k-means++, a fixed
    generator); clusters of fewer than ``LEAST_SHARE`` of the rows, which would be outliers, are given up."""
    draw, c = np.random.default_rng(7), _unit(own.mean(axis=0, keepdims=True))
    if len(own) > CLUSTERS:
        c = own[[draw.integers(len(own))]]
        while len(c) < CLUSTERS:
            far = np.maximum(0.0, 1 - (own @ c.T).max(axis=1)).astype(float) ** 2
            if far.sum() <= 1e-9:
                break
            c = np.vstack([c, own[[draw.choice(len(own), p=far / far.sum())]]])
    for _ in range(10):
        at = (own @ c.T).argmax(axis=1)
        held = np.bincount(at, minlength=len(c))
        stay = np.flatnonzero(held >= max(1, LEAST_SHARE * len(own)))
        c = _unit(np.array([own[at == k].mean(axis=0) for k in stay]))
    return c


def _vectors(texts: list[str], idf: np.ndarray | None) -> tuple[np.ndarray, list[str]]:
    """Unit vectors (counts damped only, if there is no idf yet) of the texts that have letters, and these texts, sorted."""
    rows = [(f.astype(np.float32), t) for t in sorted(texts) if (f := features(t)) is not None]
    x = np.log1p(np.array([f for f, _ in rows], dtype=np.float32).reshape(len(rows), DIM))
    if idf is not None:
        x *= idf.astype(np.float32)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return x, [t for _, t in rows]


def _frequencies(texts: list[str]) -> tuple[int, np.ndarray]:
    """Texts with letters, and in how many of them each n-gram is."""
    x, _ = _vectors(texts, None)
    return len(x), np.count_nonzero(x, axis=0)


def _idf(counts: list[tuple[int, np.ndarray]]) -> np.ndarray:
    n = sum(c for c, _ in counts)
    return np.log((1 + n) / (1 + sum((d for _, d in counts), np.zeros(DIM)))) + 1


def _language(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, list[list[float]]]:
    """Centroids of a language, and held-out distances by length: of up to 400 rows, cut to the least length, from the
    centroids of the other half of the rows."""
    x, kept = _vectors(texts, idf)
    far: list[list[float]] = [[] for _ in LENGTHS]
    if len(x) < 2:
        return (_clusters(x) if len(x) else np.zeros((0, DIM), np.float32)), far
    halves = [_clusters(x[k::2]) for k in (0, 1)]
    for i, text in enumerate(kept[:400]):
        for b, most in enumerate(LENGTHS):
            f = features(text, most + 1)
            if f is not None and _length(f) > b:
                far[b].append(1 - float((halves[1 - i % 2] @ _unit(np.log1p(f) * idf).astype(np.float32)).max()))
    return _clusters(x), far


def _model(idf: np.ndarray, found: dict[str, tuple[np.ndarray, list[list[float]]]]) -> Model:
    """Limits by length from the held-out distances, from all languages' where one has few; longer texts without enough
    have the limit of the length before."""
    names, centroids, radii = [], [], []
    for g, (c, own) in sorted(found.items()):
        limit = np.full(len(LENGTHS) + 1, CAP)
        for b in range(len(LENGTHS)):
            pool = own[b] if len(own[b]) >= LEAST else [d for _, other in found.values() for d in other[b]]
            limit[b + 1] = min(limit[b], float(np.quantile(pool, QUANTILE)) * SLACK) if len(pool) >= LEAST else limit[b]
        names += [g] * len(c)
        centroids += list(c)
        radii += [limit] * len(c)
    return Model(names, np.array(centroids, dtype=np.float32).reshape(-1, DIM), np.array(radii).reshape(-1, len(LENGTHS) + 1), idf)


def fit(langs: list[str], texts: list[str]) -> Model:
    """Deterministic in the set of rows."""
    by: dict[str, list[str]] = {}
    for g, t in zip(langs, texts, strict=True):
        by.setdefault(g, []).append(t)
    idf = _idf([_frequencies(t) for t in by.values()])
    return _model(idf, {g: _language(t, idf) for g, t in by.items()})


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Fit on rows with a non-null label; null or empty texts teach nothing. More than ``LANGUAGES`` labels are an error, as
    the model is sent to every worker."""
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("g")
    )
    counts = rows.groupBy("g").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "g").limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to train; raise langid.LANGUAGES")
    spark = labelled.sparkSession
    share = spark.createDataFrame([(r["g"], min(1.0, sample / r["n"])) for r in counts], "g string, share double")
    draw = F.pmod(F.xxhash64("i", "t"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.join(F.broadcast(share), "g").filter(draw < F.col("share")).select("g", "t")
    chosen = materialize(chosen, "langid-sample")  # some SAMPLE rows a language

    def frequencies(pdf: pd.DataFrame) -> pd.DataFrame:
        n, held = _frequencies(pdf["t"].tolist())
        return pd.DataFrame({"n": [n], "held": [held.astype("<f8").tobytes()]})

    back = chosen.groupBy("g").applyInPandas(frequencies, "n long, held binary").collect()
    idf = _idf([(r["n"], np.frombuffer(r["held"], dtype="<f8")) for r in back])

    def language(pdf: pd.DataFrame) -> pd.DataFrame:
        c, far = _language(pdf["t"].tolist(), idf)
        return pd.DataFrame({"g": [pdf["g"].iloc[0]], "c": [c.astype("<f4").tobytes()], "far": [far]})

    back = chosen.groupBy("g").applyInPandas(language, "g string, c binary, far array<array<double>>").collect()
    return _model(idf, {r["g"]: (np.frombuffer(r["c"], dtype="<f4").reshape(-1, DIM), r["far"]) for r in back})


def with_language(docs: DataFrame, model: Model, text_col: str = "text", name: str = "language") -> DataFrame:
    """``docs`` with a struct column ``name`` (lang, score, rejected).

    Null text or text without letters: und, 0.0, rejected. Equal texts get equal results; a model of no
    languages answers und. Only the text is read; other columns pass, whatever their names. No rows give no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # at most LANGUAGES * CLUSTERS vectors of DIM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        worker_memory("langid")
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                got = [m.predict(t) for t in part.column(0).to_pylist()]
                lang, score, gone = zip(*got, strict=True)
                told = pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(gone, pa.bool_())], names=["lang", "score", "rejected"])
                yield pa.RecordBatch.from_arrays([*part.columns[1:], told], names=columns)

    columns = [*docs.columns, name]
    schema = StructType([*docs.schema.fields, StructField(name, StructType.fromDDL("lang string, score double, rejected boolean"))])
    text = F.col(text_col)
    return docs.select(text, *(F.col(f"`{c}`") for c in docs.columns)).mapInArrow(run, schema)
