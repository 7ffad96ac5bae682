"""Collocations against a plain count of all phrases and against the SQL; the sketch loses nothing; edge cases."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from corpusloom.llm import collocations as c
from corpusloom.llm.queries import ORACLES

SCHEMA = "doc_id long, text string, lang string, count long, phrase string, a string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least=10, share=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(w)
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items() if set(p) <= set(q)):
                continue
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def texts(n, seed, vocab=25):
    r = random.Random(seed)
    words = ["The", "of", "New", "york", "CITY", "Ü", "ü", "日本", "a\x1cb", "x" * 400] + [f"w{i}" for i in range(vocab)]
    weights = [1 / (i + 1) for i in range(len(words))]
    gap = lambda: r.choice([" ", " ", " ", " ", "  ", "\t", ", ", ".", "!\n", "\r\n", "\x0b"])
    one = lambda: "".join(w + gap() for w in r.choices(words, weights, k=r.randint(0, 60)))
    return [(one() + ("new york city hall" if r.random() < 0.4 else ""), r.choice(["en", "en", "de", None])) for _ in range(n)]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, g, 1, "p", "a") for i, (t, g) in enumerate(docs)], SCHEMA)


def found(df, **options):
    return sorted(tuple(r) for r in c.collocations(df, **options).collect())


ODD = [(None, None), ("", "en"), (" \t ", "en"), ("...", "fr"), ("word", "fr"), ("same same " * 12, "it"), ("same same " * 12, "it"), ("lone pair\n" * 9, "pt")]


@pytest.mark.parametrize("rows,cells", [(2, 1 << 25), (2, 1 << 8), (1, 8), (3, 1 << 17)])
def test_equals_plain(spark, rows, cells):
    docs = texts(240, 1) + ODD + [texts(1, 9)[0]] * 15
    assert found(frame(spark, docs), rows=rows, cells=cells) == plain(docs)


def test_options_and_ranks_over_partitions(spark):
    docs = texts(400, 2, vocab=60)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for least, share, top, heavy in ((3, 30, 50, 2), (12, 100, 7, 256), (1, 50, 100000, 3)):
            assert found(frame(spark, docs), least=least, share=share, top=top, heavy=heavy) == plain(docs, least, share, top)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    with pytest.raises(ValueError):
        c.collocations(frame(spark, docs), least=128)


def test_empty(spark):
    assert found(frame(spark, [])) == [] and found(frame(spark, [(None, None), ("one two", "en")])) == []


def test_slices_and_restarts_lose_nothing(spark, monkeypatch):
    docs = [("a b a b c " * 300 + "end. " + "x y z " * 50, "en"), ("a b c", "en")] * 3
    want = plain(docs)
    reader = c.Reader()
    monkeypatch.setattr(c, "SLICE", 7)
    for size, kinds in ((5, 3), (50, 2), (10000, 100)):
        monkeypatch.setattr(c, "HELD", size)
        monkeypatch.setattr(c, "WORDS", kinds)
        got = Counter()

        def use(reader):
            for lang, n, packed in reader.phrases():
                got.update((lang, n, t) for t in reader.texts(packed, n))
            return iter(())

        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays([pa.array([g for _, g in docs]), pa.array([t for t, _ in docs])], names=["lang", "text"])
        list(c._read(iter([batch]), use))
        for lang, _, p, a, left, right, n, _ in want:
            assert got[lang, len(p.split()), p] == a
            assert n == sum(v for (g, k, _), v in got.items() if g == lang and k == 1)
    assert reader.END not in reader.words("plain")[:-1]


def test_sketch_never_loses(spark):
    r = np.random.default_rng(5)
    counts = np.zeros(64, dtype=np.uint8)
    true = np.zeros(64, dtype=np.int64)
    for _ in range(30):
        cells = r.integers(0, 64, 500).astype(np.uint32) ** 2 // 64
        c.add_cells(counts, cells, 100)
        np.add.at(true, cells, 1)
    assert np.array_equal(counts, np.minimum(true, 100))
    for share in (0.02, 0.9):
        a, b = (np.where(r.random(1000) < share, r.integers(0, 128, 1000), 0).astype(np.uint8) for _ in range(2))
        held = a.copy()
        c.add_packed(held, c.pack(b), c.FULL)
        assert np.array_equal(held, np.minimum(a.astype(int) + b, c.FULL))


def test_query_equals_sql(spark, tmp_path):
    from corpusloom.llm.queries import op12_collocations

    docs = texts(500, 7) + ODD
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = sorted(con.sql(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({ORACLES['op12_collocations']})").fetchall())
    assert sorted(tuple(r) for r in op12_collocations(spark, str(tmp_path)).collect()) == want == plain(docs)
