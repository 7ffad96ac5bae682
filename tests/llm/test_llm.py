"""Operators against brute force, round trips and held-out accuracy; edge cases of every operator."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row

public_tokenizers = pytest.importorskip("public_tokenizers")

from corpusloom.llm import (  # noqa: E402
    exact_dedup, idcoder, langid, licenses, mixing, order_minhash, sentencepieces, simhash, substring_dedup, token_files,
)

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
RND = random.Random(5)
VOCAB = ["".join(RND.choice("abcdefgh") for _ in range(RND.randint(1, 7))) for _ in range(300)]
LONG = " ".join(RND.choice(VOCAB) for _ in range(400))
ODD = ["", None, "a", " ", "\n\t", "x" * 3000, LONG, LONG, LONG + " tail", "é̈🙂  zz 3.14!", "日本語" * 50, "The The the, the!", "." * 40]
SCHEMA = "doc_id long, text string, lang string, source string, keep_id string, _size int, fp string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, [None, "b", "a"][i % 3], "c", 1, "f") for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[6], (None, "null id", None, None, None, None, None)], SCHEMA)


def prose(n, seed, alphabet="abcdefgh"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(1, 7))) for _ in range(n))


def test_pieces_equal_library(spark, odd):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    lattice = sentencepieces.Lattice(PIECES)
    for t in ODD:
        for chunk in (1, 5, 40, 1 << 16):
            assert sentencepieces.encode_text(lattice, t and t[:600], chunk).tolist() == sp.encode((t or "")[:600])
    got = sentencepieces.encode_documents(odd, PIECES, chunk=64).collect()  # giants go through the distributed scan
    assert len(got) == odd.count()
    want = {i: sp.encode(t or "") for i, t in enumerate(ODD)} | {None: sp.encode("null id")}
    assert all(list(r.ids) == want[r.doc] for r in got)
    assert all(sentencepieces.decode_ids(lattice, sp.encode(t)) == t for t in ODD if t)
    for r in sentencepieces.round_trip(odd, PIECES, chunk=64).collect():
        text = "null id" if r.doc_id is None else ODD[r.doc_id] or ""
        raw = np.array(want[r.doc_id], "<u4").tobytes()
        assert (r.n_tokens, r.ids_crc32, r.n_chars) == (len(want[r.doc_id]), zlib.crc32(raw), len(text))
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_transfer_matrices_are_associative():
    lattice = sentencepieces.Lattice(PIECES)
    s = sentencepieces.escaped("internationalisation of thethethe words")
    m = [sentencepieces.transfer(lattice, s, a, b) for a, b in ((0, 9), (9, 17), (17, len(s)))]
    mul = sentencepieces.multiply
    assert mul(mul(m[0], m[1]), m[2]) == mul(m[0], mul(m[1], m[2]))


def test_order_minhash(spark, odd):
    a = order_minhash.sketch(LONG)
    words = LONG.split()
    near = order_minhash.likeness(a, order_minhash.sketch(" ".join(words[:200] + ["new"] + words[200:])))
    swapped = order_minhash.likeness(a, order_minhash.sketch(" ".join(words[200:] + words[:200])))
    assert near > 0.8 > swapped  # order counts, not only overlap
    got = order_minhash.edit_report(odd, "doc_id", "text").collect()
    assert len(got) == odd.count() and all(0 <= r.near_edited <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[0].fingerprint == by[1].fingerprint and by[6].fingerprint == by[7].fingerprint
    assert order_minhash.edit_report(odd.limit(0)).count() == 0
    lone = order_minhash.edit_report(odd.filter("doc_id = 8")).collect()
    assert len(lone) == 1 and lone[0].near_next == 1.0


def plain_sketch(text):
    """Order MinHash with whole numbers and sorting only."""
    m = (1 << 64) - 1

    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & m
        x = (x ^ x >> 27) * 0x94D049BB133111EB & m
        return x ^ x >> 31

    letters, base = [mix(ord(c) + 1) for c in text], 0x9E3779B97F4A7C15
    k = min(order_minhash.KMER, len(letters))
    kmers = [mix(sum(v * pow(base, j, 1 << 64) for j, v in enumerate(letters[i : i + k])) & m) for i in range(len(letters) - k + 1)]
    seen, keys = {}, []
    for x in kmers:
        keys.append(mix(x + seen.get(x, 0) * base & m) >> 32)
        seen[x] = seen.get(x, 0) + 1
    out = []
    for a, x in zip(order_minhash._A.tolist(), order_minhash._X.tolist()):
        least = sorted(range(len(kmers)), key=lambda i: ((keys[i] ^ x) * a & 0xFFFFFFFF, i))[: order_minhash.TUPLE]
        value = int(order_minhash._SEED[order_minhash.TUPLE]) + min(len(text), 1) & m
        for n, i in enumerate(sorted(least)):
            value = mix(value * int(order_minhash._SEED[n]) + kmers[i] & m)
        out.append(value >> 32)
    return out


def test_order_minhash_equals_brute_force(spark):
    r = random.Random(4)
    texts = ["", "a", "abcdefgh", "abcdefghi", "ab" * 40, *("".join(r.choice("abc d\u00e9\U0001f600") for _ in range(r.randint(1, 400))) for _ in range(60)), prose(900, 5)]
    assert all(order_minhash.sketch(t).tolist() == plain_sketch(t) for t in texts)
    rows = [(7 * i - 50, t) for i, t in enumerate(texts)]
    got = {x.doc_id: x for x in order_minhash.edit_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        new = t[: len(t) - half] + after[:half]
        own, other, following = plain_sketch(t), plain_sketch(new), plain_sketch(after)
        hexed = lambda s: b"".join(v.to_bytes(4, "big") for v in s).hex()
        near = lambda s: sum(x == y for x, y in zip(own, s)) / len(own)
        want = (i, len(t), hashlib.sha256(new.encode()).hexdigest(), hexed(own), hexed(other), near(other), near(following))
        assert tuple(got[i]) == want


def test_language(spark):
    rows = [(i, prose(40, i, "abcde" if i % 2 else "vwxyz"), "aa" if i % 2 else "zz") for i in range(200)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(d.filter("doc_id < 150"))
    got = langid.with_language(d.filter("doc_id >= 150").unionByName(spark.createDataFrame([(900, None, None), (901, "12 !", None)], d.schema)), model).collect()
    held = [r for r in got if r.doc_id < 900]
    assert sum(r.lang == r.language.lang for r in held) >= 0.98 * len(held) and not any(r.language.rejected for r in held)
    assert all(r.language.lang == "und" and r.language.rejected for r in got if r.doc_id >= 900)
    assert langid.with_language(d.limit(1), langid.train(d.limit(0))).first().language.lang == "und"
    clash = d.limit(3).withColumnsRenamed({"lang": "_text"})
    assert langid.with_language(clash, model).columns == [*clash.columns, "language"] and langid.with_language(clash.limit(0), model).count() == 0
    assert langid.with_language(clash, model).filter("language.lang IN ('aa', 'zz')").count() == 3


def test_mix_loses_no_row(spark):
    """Null and repeated ids with different texts of equal size, rows that differ in another column only, and whole copies."""
    texts = ["aa bb cc", "dd ee ff", "gg hh ii", "jj kk ll", "mm nn oo"]
    rows = [(None, t, "s", "x", 1, None) for t in texts[:3]] + [(7, t, "s", "x", 1, None) for t in texts[3:]]
    rows += [(8, "one two", None, "x", 1, "p"), (8, "one two", None, "x", 2, "p")] + [(9, "pp qq rr", "s", "x", 1, None)] * 2100 + [(None, None, "s", "x", 1, None), (1, "", "t", "x", 1, None)]
    schema = "doc_id long, text string, source string, mark string, copies int, size string"
    d = spark.createDataFrame(rows, schema).repartition(3)
    want = Counter()
    for r in mixing.taken(d).collect():
        want[r.doc_id, r["size"]] += r.times
    assert sum(1 for _ in mixing.taken(d).collect()) == len(rows)
    got = Counter(tuple(r) for r in mixing.mix(d).collect())
    by_id = Counter()
    for r, n in got.items():
        assert r in set(rows) and n <= 3 * rows.count(r)
        by_id[r[0], len((r[1] or "").split())] += n
    assert by_id == +want
    even = spark.createDataFrame([r for r in rows if r[3] == "x" and r[1] and r[0] != 9], schema)  # one source each, all taken once
    assert Counter(tuple(r) for r in mixing.mix(even, weights=(5, 1)).collect()).keys() >= {r for r in rows if r[1] in texts or r[4] == 2}


def test_mixing(spark, odd):
    rows = [(i, prose(1 + i % 50, i), ["a", "b", "c", "d", None][min(4, i % 9)]) for i in range(900)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.taken(d).collect()
    names = {i: s for i, _, s in rows}
    assert len(got) == 900 and sum({names[r.doc_id]: r.target for r in got}.values()) == pytest.approx(sum(r.size for r in got))
    for name in set(names.values()):
        own = [r for r in got if names[r.doc_id] == name]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) and all(r.taken <= 3 * r.size for r in own)
    assert {(r.doc_id, r.taken) for r in mixing.taken(d).collect()} == {(r.doc_id, r.taken) for r in got}
    assert mixing.mix(d).count() == sum(r.times for r in got)
    assert mixing.taken(odd).count() == odd.count() and mixing.mix(odd).columns == odd.columns and mixing.mix(odd.limit(0)).count() == 0


def test_inverse_demand(spark):
    knots = ((0.0, 1.5), (0.4, 1.5), (1.0, 0.2))
    shares = [i / 20 for i in range(21)]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in shares], "s double").select(mixing.inverse_demand(__import__("pyspark").sql.functions.col("s"), knots)).collect()]
    t = np.linspace(0, 1, 200001)
    w = np.interp(t, [k[0] for k in knots], [k[1] for k in knots])
    c = np.cumsum(w) / w.sum()
    assert np.allclose(got, np.interp(shares, c, t), atol=1e-4)


def test_token_files(spark, odd):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(WORDS)
    got = token_files.encode_corpus(odd, WORDS, 2, with_ids=True).collect()
    assert len(got) == odd.count()
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        text = "null id" if r.doc_id is None else ODD[r.doc_id] or ""
        assert list(r.ids) == tk.encode(text, add_special_tokens=False).ids + [2]
        assert (r.start, r.ids_crc32) == (start, zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        start += r.n_tokens
    assert token_files.encode_corpus(odd.limit(0), WORDS).count() == 0
    rng = np.random.default_rng(0)
    for n, hi in ((0, 2), (1, 2), (257, 3), (9000, 65535)):
        x = rng.integers(0, hi, n)
        data = idcoder.encode_segment([None, 7], [x[: n // 2], x[n // 2 :]])
        assert (idcoder.decode_segment(data).ids == x).all()
    broken = bytearray(data)
    broken[-9] ^= 8
    with pytest.raises(idcoder.CorruptBlock):
        idcoder.decode_segment(bytes(broken))


def test_ids_equal_library():
    """Random strings over letters that change under case or normal form, marks, added tokens and white space."""
    from tokenizers import Tokenizer

    points = [*range(32, 127), *range(0xA0, 0x180), 0x130, 0x131, 0x307, 0x301, 0x30C, 0x327, 0x331, 0x345, 0x1F0, 0x1E9E, 0x3A3, 0x3C2, 0x4E00, 0x661, 0x2028, 0x85, 0x1C, 0x200B, 0x1F600, 0xFB01, 0x3000]
    letters = [*map(chr, points), "'s", "'t", "'re", "<|endoftext|>", "<|STARTOFTEXT|>", "J\u030c", "\t", "\n", ". ", ", "]
    r = random.Random(12)
    texts = ["\u0130|", "a. b, <|endoftext|>.", "J\u030c.", None, *("".join(r.choice(letters) for _ in range(r.randint(0, 9))) for _ in range(20_000))]
    ours = token_files.WordTokenizer(WORDS)
    assert ours.lowers and ours.parts and ours.together
    want = [e.ids + [2] for e in Tokenizer.from_file(WORDS).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in ours.encode(pa.array(texts), 2)] == want
    other = token_files.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))  # no marks of word ends, case matters
    assert not other.lowers and not other.together


def test_blocks_decode_and_compress():
    """Predictable ids take fewer bits than their order-0 entropy, and every shape of segment comes back."""
    r = np.random.default_rng(3)
    motif = r.integers(0, 500, 40)
    ids = np.concatenate([motif if k % 8 else r.integers(0, 500, 40) for k in range(3000)]).astype(np.uint16)
    data = idcoder.encode_segment([1], [ids])
    p = np.bincount(ids) / len(ids)
    assert (idcoder.decode_segment(data).ids == ids).all()
    assert 8 * len(data) / len(ids) < 0.8 * -(p[p > 0] * np.log2(p[p > 0])).sum()
    for n in (0, 1, 255, 256, 257, 5000):
        assert (idcoder.decode_segment(idcoder.encode_segment([1], [ids[:n]])).ids == ids[:n]).all()


@pytest.mark.parametrize("block", [4, 1024])  # small blocks make buckets be cut further
def test_links_equal_brute_force(spark, block):
    r = random.Random(9)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = {b ^ sum(1 << r.randrange(64) for _ in range(k)) & (2**64 - 1) for b in base for k in (0, 0, 1, 1, 2, 2, 3)} | {0}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2, block)
    got = {x.node: x.root for x in simhash.connected(edges).collect()}
    label = {f: f for f in signed}
    for _ in range(len(signed)):
        new = {a: min(label[b] for b in signed if bin((a ^ b) & (2**64 - 1)).count("1") <= 2) for a in signed}
        if new == label:
            break
        label = new
    groups = lambda m: {frozenset(k for k in signed if m.get(k, k) == v) for v in {m.get(k, k) for k in signed}}
    assert groups(got) == groups(label)


def test_language_rejects_foreign():
    """Limits stay well below 1 with outliers in training; foreign scripts and random letters go, short clean texts stay."""
    r = random.Random(8)
    lexicon = {g: ["".join(r.choice(s) for _ in range(r.randint(1, 3))) for _ in range(80)] for g, s in (("aa", ["ba", "mi", "tor", "en"]), ("zz", ["ku", "sha", "ly", "oo"]))}
    text = lambda g, n: " ".join(r.choice(lexicon[g]) for _ in range(n))
    noise = lambda n: " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 8))) for _ in range(n))
    rows = [(g, text(g, r.randint(5, 300))) for g in lexicon for _ in range(300)] + [("aa", "日本語の文章" * 9), ("zz", "Ψευδής λόγος " * 9)]
    model = langid.fit(*map(list, zip(*rows)))
    assert model.radii.max() <= 0.8
    foreign = ["这是一个中文句子它不应该被接受" * 4, "Это предложение написано по-русски " * 4, *(noise(n) for n in (30, 100, 300) for _ in range(20))]
    assert sum(not model.predict(t)[2] for t in foreign[2:]) == 0 and model.predict(foreign[1])[2]
    clean = [(g, text(g, n)) for g in lexicon for n in (8, 20, 200) for _ in range(50)]
    found = [model.predict(t) for _, t in clean]
    assert sum(p[0] == g and not p[2] for p, (g, _) in zip(found, clean)) >= 0.97 * len(clean)


def test_too_many_languages(spark, monkeypatch):
    d = spark.createDataFrame([(i, prose(9, i), g) for i, g in enumerate("abc")], "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    with pytest.raises(ValueError, match="more than 2 languages"):
        langid.train(d)


def test_near_duplicates(spark, odd):
    words = prose(300, 77).split()
    rows = [(0, " ".join(words)), (1, " ".join(words[:150] + ["changed"] + words[151:])), (2, prose(300, 78)), (3, None), (4, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(d).collect()) == [0, 2, 3]
    got = simhash.simhash_groups(odd).collect()
    by = {r.doc: r for r in got}
    assert len(got) == odd.count() and by[1].component == by[0].component == 0 and by[7].component == 6
    assert simhash.simhash_groups(odd.limit(0)).count() == 0


def test_near_duplicates_by_row(spark):
    """Rows with a null or repeated id stay or go by their own text."""
    words = prose(300, 79).split()
    a, b, near, other = prose(300, 80), " ".join(words), " ".join([*words[:150], "changed", *words[151:]]), prose(300, 81)
    rows = [(3, near), (5, a), (5, b), (None, near + " more"), (None, other), (None, None)]
    got = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, got)) == sorted(str(Row(doc_id=i, text=t)) for i, t in (rows[0], rows[1], rows[4], rows[5]))


def test_adjacency_equals_brute_force():
    r = np.random.default_rng(4)
    for n, groups, flips in ((1, 1, 0), (64, 1, 9), (65, 3, 40), (400, 30, 46), (300, 300, 0)):
        fps = np.repeat(r.integers(0, 2**63, (1, 4)), n, axis=0).astype("<u8")
        bits = np.unpackbits(fps.view(np.uint8).reshape(n, 32), axis=1) ^ (r.random((n, 256)) < flips / 256)
        fps = np.packbits(bits, axis=1).view("<u8")
        starts = np.concatenate([[0], np.sort(r.choice(np.arange(1, n), groups - 1, replace=False))]).astype(np.int64) if n > 1 else np.zeros(1, np.int64)
        group = np.searchsorted(starts, np.arange(n), side="right")
        want = {(i, j) for i in range(n) for j in range(i) if group[i] == group[j] and (bits[i] != bits[j]).sum() <= 46}
        got = [(int(i), int(j)) for a, b in simhash.adjacency(fps, starts, 46) for i, j in zip(a, b, strict=True)]
        assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("block", [8, 1024])  # small blocks make buckets be lengthened and dealt out
def test_wide_links(spark, block):
    r = np.random.default_rng(5)
    base = r.random((12, 256)) < 0.5
    rows = []
    for i in range(600):
        bits = base[i % 12] ^ (r.random(256) < 0.02)
        rows.append((i, bytearray(np.packbits(bits, bitorder="little").tobytes())))
    edges = simhash.wide_links(spark.createDataFrame(rows, "node long, fp binary"), 46, block)
    root = {x.node: x.root for x in simhash.connected(edges).collect()}
    assert all(root.get(i, i) == i % 12 for i in range(600))


def test_crowded_bucket_loses_no_pair(spark):
    """Texts in two halves of one bucket: a pair is found however many others share its keys."""
    r = np.random.default_rng(6)
    common = np.unique(simhash._KEYS[0][:16])
    shared, rows, pairs = r.random(256) < 0.5, [], []
    for i in range(400):  # all agree in table 0 only, pairs differ in 40 of the other bits
        bits = r.random(256) < 0.5
        bits[common] = shared[common]
        other = bits.copy()
        other[r.choice(np.setdiff1d(np.arange(256), common), 40, replace=False)] ^= True
        rows += [(2 * i, bits), (2 * i + 1, other)]
    rows = [(i, bytearray(np.packbits(b, bitorder="little").tobytes())) for i, b in rows]
    edges = {(max(e), min(e)) for e in simhash.wide_links(spark.createDataFrame(rows, "node long, fp binary"), 46, 50).collect()}
    assert edges == {(2 * i + 1, 2 * i) for i in range(400)}


def test_wide_recall(spark):
    """Pairs of similarity 0.8 to 0.86, just over the threshold."""
    r, rows, pairs = random.Random(3), [], 0
    for i in range(150):
        w = prose(200, 1000 + i).split()
        v = list(w)
        for k in range(3 + i % 2):
            v[r.randrange(50 * k, 50 * k + 40)] = "zzz"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
        pairs += 1
    groups = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string"), words=5, radius=46, wide=True).collect()
    component = {x.doc: x.component for x in groups}
    met = sum(component[2 * i] == component[2 * i + 1] for i in range(150))
    print("met", met, "of", pairs)
    assert met >= 0.9 * pairs
    assert len(set(component.values())) >= 150


def test_wide_links_are_verified(spark):
    """Links of under 0.8 don't join, be it by the radius, by equal fingerprints or through a chain; those of 0.8 do."""
    rows, want, sets = [], [], []
    for i in range(60):
        w, k = prose(200, 3000 + i).split(), 2 + i % 5  # 2 to 6 changed words: similarity 0.90 to 0.73
        v = [f"zz{j}" if j % 33 == 16 and j // 33 < k else x for j, x in enumerate(w)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
    junk = " ".join(["spam"] * 3000)
    rows += [(500, junk), (501, junk + " " + prose(60, 9)), (502, junk + " " + prose(60, 10))]
    for i, t in rows:
        w = t.split()
        sets.append((i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)}))
    want = {(a, b) for a, x in sets for b, y in sets if a < b and 5 * len(x & y) >= 4 * len(x | y)}
    groups = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string"), words=5, radius=56, wide=True).collect()
    component = {x.doc: x.component for x in groups}
    assert 0 < len(want) < 60
    assert {(a, b) for a in component for b in component if a < b and component[a] == component[b]} == want


def test_licenses(spark, odd):
    index = licenses.Index(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        (m,) = index.scan(prose(50, 1) + " " + text + " " + prose(50, 2))
        assert m[:4] == (name, 1.0, len(licenses.words_of(text)[0]), 50)
    mit = licenses.TEMPLATES["mit"]
    (m,) = index.scan(mit.replace("persons", "people").replace("deal in", "deal freely in"))
    assert m[0] == "mit" and m[2] == len(licenses.words_of(mit)[0]) - 1
    words = mit.split()
    (m,) = index.scan(" ".join([*words[:60], *prose(20, 3).split(), *words[60:]]))  # words put in
    assert m[:2] == ("mit", 1.0)
    (m,) = index.scan(" ".join(words[: 7 * len(words) // 10]))  # cut off
    assert m[0] == "mit" and 0.65 < m[1] < 0.75
    assert [x[0] for x in index.scan(f"{mit} and {mit}")] == ["mit", "mit"]
    assert [x[0] for x in index.scan("Licensed under CC BY-ND 4.0.")] == ["cc-by-nd-4.0-short"] and index.scan("Licensed under CC BY-XX 4.0.") == []
    assert index.scan(LONG) == [] == index.scan(None) == index.scan("permission is hereby granted free " * 9000)
    assert licenses.scan_licenses(odd).count() == 0 and licenses.scan_licenses(odd.limit(0)).count() == 0
    d = spark.createDataFrame([(1, mit), (1, mit), (None, "Released under the MIT License."), (2, None)], "doc_id long, text string")
    assert sorted((str(x.doc_id), x.license) for x in licenses.scan_licenses(d).collect()) == [("1", "mit"), ("1", "mit"), ("None", "mit-short")]


def test_alignment_equals_brute_force():
    """Cell by cell: the band's states after each word of the template, one path each."""
    r = np.random.default_rng(2)

    def plain(template, text, shift, band):
        base = shift - band
        cells = [(0.0, (0, base + j, base + j, 0, 0)) for j in range(2 * band + 1)]
        cells = [(s, (0, 0, 0, 0, 0)) for s, _ in cells]
        for i, word in enumerate(template):
            new = []
            for j in range(2 * band + 1):
                at, (s, (k, a, b, c, d)) = base + i + j, cells[j]
                took = (-1e9, (k, a, b, c, d))
                if 0 <= at < len(text):
                    hit = text[at] == word
                    took = (s + 1, (k + 1, a if k else at, at + 1, c if k else i, i + 1)) if hit else (s - 0.5, (k, a, b, c, d))
                skip = (cells[j + 1][0] - 0.5, cells[j + 1][1]) if j < 2 * band else (-1e9 - 0.5, took[1])
                best = skip if skip[0] > took[0] else took
                if new and new[-1][0] - 0.5 > best[0]:
                    best = (new[-1][0] - 0.5, new[-1][1])
                new.append(best)
            cells = new
        return max(range(len(cells)), key=lambda j: (cells[j][1][0], cells[j][0], j)), cells

    for _ in range(300):
        template, text = (r.integers(0, 5, r.integers(1, 12)).astype(np.uint64) for _ in range(2))
        shift, band = int(r.integers(-3, 6)), int(r.integers(1, 5))
        at, cells = plain(template.tolist(), text.tolist(), shift, band)
        assert licenses.align([(template, text, shift)], band)[0] == cells[at][1]
    many = [(r.integers(0, 5, n).astype(np.uint64), r.integers(0, 5, 30).astype(np.uint64), n % 4) for n in range(1, 40)]
    assert licenses.align(many, 4) == [licenses.align([x], 4)[0] for x in many]  # pieces of a batch don't mix


def test_license_scan_equals_whole_alignment():
    """Coverage of damaged templates: what the pieces find is what an alignment over the whole text finds, nearly."""
    r, index = random.Random(6), licenses.Index(licenses.TEMPLATES)
    for name in ("mit", "bsd-3-clause", "zlib", "unlicense", "apache-2.0"):
        words = licenses.words_of(licenses.TEMPLATES[name])[0]
        for damage in (0.0, 0.05, 0.1):
            text = [prose(1, r.randrange(9999)) if r.random() < damage else w for w in words]
            template, codes = licenses.codes_of(words), licenses.codes_of([*prose(30, 1).split(), *text, *prose(30, 2).split()])
            want = licenses.align([(template, codes, 30)], band=40)[0][0]
            (m,) = index.scan(" ".join([*prose(30, 1).split(), *text, *prose(30, 2).split()]))
            assert m[0] == name and want - 3 <= m[2] <= want


def test_license_matches_do_not_depend_on_other_text():
    """A damaged notice has the same match in a text of its own, among some hundred others, and beside a copy."""
    r, index = random.Random(7), licenses.Index(licenses.TEMPLATES)
    around = prose(licenses.GAP + 10, 1, "xyz")
    texts = []
    for name, template in licenses.TEMPLATES.items():
        for damage in (0.0, 0.1, 0.2, 0.3):
            words = [prose(1, r.randrange(9999), "xyz") if r.random() < damage else w for w in licenses.words_of(template)[0]]
            texts.append(" ".join([around, *words, around]))
    alone, want, at, chars = [index.scan(t) for t in texts], [], 0, 0
    for text, found in zip(texts, alone, strict=True):
        want += [(*m[:3], m[3] + at, m[4] + at, m[5] + chars, m[6] + chars) for m in found]
        at, chars = at + len(text.split()), chars + len(text) + 1
    assert index.scan(" ".join(texts)) == want and len(want) > 64
    assert index.scan_all(texts) == alone
    r = random.Random(2)
    isc = " ".join(w if r.random() > 0.1 else "zz" for w in licenses.words_of(licenses.TEMPLATES["isc"])[0])
    (m,) = index.scan(f"{around} {isc} {around}")
    for copies in (2, 70):
        assert [x[:3] for x in index.scan(" ".join([around, *[isc, prose(10, 3, "xyz")] * copies, around]))] == [m[:3]] * copies


def test_damaged_licenses_alone_and_beside_copies():
    """Up to 40 % of a notice's words replaced, at least COVERAGE of them kept: it is found, with the same match alone, beside an intact copy and
    beside half a copy. Where siblings differ by a word or two, one of them may stand for the other."""
    r, index = random.Random(3), licenses.Index(licenses.TEMPLATES)
    noise = lambda n: [prose(1, r.randrange(1 << 30), "xyzq") for _ in range(n)]
    family = lambda name: name.split("-")[0].lstrip("al")
    for name, template in licenses.TEMPLATES.items():
        words = licenses.words_of(template)[0]
        n = len(words)
        if n < licenses.SHORT:
            continue
        for damage in (0.0, 0.1, 0.2, 0.3, 0.36, 0.36, 0.4, 0.4):
            kept = []
            while sum(a == b for a, b in zip(kept, words, strict=False)) < licenses.COVERAGE * n:
                kept = [w if r.random() >= damage else noise(1)[0] for w in words]
            before, between, after = noise(80), noise(20), noise(80)
            alone = [m[:5] for m in index.scan(" ".join(before + kept + after))]
            assert len(alone) == 1 and family(alone[0][0]) == family(name) and alone[0][3] < 80 + n and alone[0][4] > 80
            beside = index.scan(" ".join(before + kept + between + words + after))
            assert [m[:5] for m in beside if m[3] < 80 + n + 10] == alone and beside[-1][:3] == (name, 1.0, n)
            off = n // 2 + 20
            half = index.scan(" ".join(before + words[: n // 2] + between + kept + after))
            assert [(*m[:3], m[3] - off, m[4] - off) for m in half if m[4] - off > 80] == alone


def test_exact(spark, odd):
    got = exact_dedup.exact_duplicates(odd, digest=True).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert (by[0].keep_id, by[0].group_size, by[0].kept, by[1].kept) == (1, 2, False, True)
    assert (by[6].keep_id, by[6].group_size, by[8].group_size) == (7, 3, 1)
    twice = odd.filter("doc_id = 7").unionByName(odd.filter("doc_id = 7"))
    assert exact_dedup.drop_exact_duplicates(twice).count() == 1
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns and sorted(x.doc_id for x in kept.collect() if x.doc_id is not None) == [1, *range(2, 6), *range(7, 13)]
    assert exact_dedup.exact_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [0, 1 << 28])  # without room for a table anchors are joined
@pytest.mark.parametrize("window", [3, 9, 50])
def test_substring(spark, window, bits, odd):
    r = random.Random(window)
    shared = [prose(window + 7, 500 + k).split() for k in range(3)]
    texts = []
    for i in range(30):
        w = prose(r.randint(0, 90), i).split()
        for s in r.sample(shared, 2):
            a = r.randrange(4)
            w[r.randint(0, len(w)) : 0] = s[a:]
        texts.append(" ".join(w))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    first, want = {}, {}
    for i, t in enumerate(texts):
        w = t.split()
        gone, own = set(), {}
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            if first.get(k, i) < i:
                gone |= set(range(p, p + window))
            own.setdefault(k, i)
        for k in own:
            first.setdefault(k, i)
        want[i] = " ".join(x for p, x in enumerate(w) if p not in gone)
    got = substring_dedup.remove_repeats(d, window=window, table_bits=bits).collect()
    assert {x.doc_id: x.kept_text for x in got} == want
    assert substring_dedup.remove_repeats(odd, window=window, table_bits=bits).count() == odd.count()
    assert substring_dedup.remove_repeats(odd.limit(0), window=window, table_bits=bits).count() == 0


def test_words_rule():
    from corpusloom.llm.textkit import WORD

    t = "a b\x0bc\x1cd e  f\n"
    assert t.encode().split() == [w.encode() for w in re.findall(WORD, t)]
