"""Each stage of the pipeline against a brute-force version of it, on its own input."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from corpusloom.llm import simhash  # noqa: E402
from corpusloom.llm.textkit import materialize, read_table  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string"


def prose(n, seed, alphabet):
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(2, 7))) for _ in range(n))


def corpus():
    """Two languages, exact copies, near copies, and texts of no language."""
    rows = [(i, prose(120 + i % 40, i, "abcdefg" if i % 2 else "tuvwxyz"), "aa" if i % 2 else "zz", "abc"[i % 3]) for i in range(120)]
    rows += [(200 + i, rows[i % 7][1], rows[i % 7][2], "a") for i in range(25)]
    for i in range(10):
        words = rows[30 + i][1].split()
        words[50] = "altered"
        rows.append((300 + i, " ".join(words), rows[30 + i][2], "b"))
    return rows + [(400, None, None, "a"), (401, "", "aa", None), (402, "12 34 !", None, "c"), (403, "1 2", None, "c")]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(corpus(), COLUMNS).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    docs, kept = read_table(spark, folder, "documents"), []
    kept.append(docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, folder), "pipeline-test")
        kept.append(docs.collect())
    whole = corpus_pipeline.run(spark, folder).collect()
    return kept, whole


def test_language(stages):
    before, after = stages[0][0], stages[0][1]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert gone == {400, 401, 402, 403} and set(after) <= set(before)


def test_exact(stages):
    before, after = stages[0][1], stages[0][2]
    stays = {}
    for r in before:
        stays[r.text] = max(stays.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(stays.values()) and set(after) <= set(before)


def test_near(stages):
    before, after = stages[0][2], stages[0][3]
    prints = {r.doc_id: int.from_bytes(simhash.wide_fingerprint(r.text).tobytes(), "little") for r in before}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= corpus_pipeline.RADIUS:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert sorted(r.doc_id for r in after) == sorted(i for i in prints if find(i) == i) and set(after) <= set(before)
    assert not {300 + i for i in range(10)} & {r.doc_id for r in after}


def test_mixture(stages):
    before, after = stages[0][3], stages[0][4]
    size = {r.doc_id: len(r.text.split()) for r in before}
    share, taken, most = defaultdict(int), defaultdict(int), max(size.values())
    for r in before:
        share[r.source] += size[r.doc_id]
    for r in after:
        taken[r.source] += size[r.doc_id]
    left, total, goal = dict(zip(sorted(share), (5, 2, 1))), sum(share.values()), {}
    while left:  # water-filling, step by step
        level = (total - sum(goal.values())) / sum(left.values())
        full = [s for s in left if left[s] * level > 3 * share[s]]
        goal |= {s: 3 * share[s] for s in full} if full else {s: w * level for s, w in left.items()}
        left = {s: w for s, w in left.items() if full and s not in full}
    assert all(abs(taken[s] - goal[s]) <= most for s in goal) and set(after) <= set(before)
    assert max(after.count(r) for r in set(after)) <= 3


def test_pieces(stages):
    import sentencepiece

    before, after, whole = stages[0][4], stages[0][5], stages[1]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for r in before:
        ids = sp.encode(r.text)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((r.doc_id, len(ids), zlib.crc32(raw), len(r.text), hashlib.sha256(r.text.encode()).hexdigest()))
    assert sorted(map(tuple, after)) == sorted(want) == sorted(map(tuple, whole))
