"""Byte-level BPE against the library whose ranks it uses: ids, offsets, decoding, edge cases."""

import base64
import hashlib
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from corpusloom.llm import byte_bpe  # noqa: E402

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, ids string, starts int"
ODD = [
    "", None, " ", "\n\t \n", "a", "don't we'll I'M it's", "x" * 5000, "ab " * 3000, "🙂🙃 👩‍👩‍👧 é̈ ｆｕｌｌ", "日本語のテキスト。" * 200, "١٢٣ 3.14 ½", "a\x00b\x1c\x1dc\x85d e",
    "<|endoftext|> stays text", "   three   spaces   ", "� ﻿x", "𝒜" * 9 + "́" * 5, "- -- --- ---- -----", "=" * 97, "line\r\nline\r\n\r\n  line",
]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.ByteBPE(PATH, PATTERN)


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[7], (None, "null id", None, None)], SCHEMA)


def random_texts(library, n):
    r = random.Random(3)
    tokens = [library.decode_single_token_bytes(i) for i in range(library.n_vocab)]
    for i in range(n):
        if i % 3 == 0:
            yield b"".join(r.choice(tokens) for _ in range(r.randint(1, 14))).decode("utf-8", "ignore")
        elif i % 3 == 1:
            letters = r.choice(["ab", "- ", "aA'", "=-", "xyz0", "01", "  \n", "ée", "'s ", "日本 "])
            yield "".join(r.choice(letters) for _ in range(r.randint(1, 80)))
        else:
            yield r.choice(tokens).decode("utf-8", "ignore") * r.randint(1, 40)


def test_ids_equal_the_library(coder, library):
    texts = [t or "" for t in ODD] + list(random_texts(library, 6000))
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert ids == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_every_code_point(coder, library):
    for lo in range(0, 0x110000, 4096):
        text = "".join(f"a{c}1{c}. {c}b {c}{c} x\n" for c in map(chr, range(lo, lo + 4096, 7)) if not "\ud800" <= c <= "\udfff")
        assert coder.encode([text])[0] == library.encode_ordinary(text)


def test_parts_of_texts_change_nothing(coder, library, monkeypatch):
    r = random.Random(4)
    spaces = [" ", "  ", "\n", "\t", "\r\n ", "\u00a0 ", "\u2003\n", "\x1c ", "\x85 ", "\u200b ", "\u3000 \n"]
    texts = ["".join(r.choice(["word", "it's", "é", "12", "...", " a", "x" * 70, *spaces]) for _ in range(300)) for _ in range(200)]
    want = [library.encode_ordinary(t) for t in texts]
    assert coder.encode(texts) == want
    monkeypatch.setattr(byte_bpe, "BATCH", 40)
    monkeypatch.setattr(byte_bpe, "KEPT", 20)
    assert [ids for lo in range(0, 200, 9) for ids in coder.encode(texts[lo : lo + 9])] == want


def test_offsets(coder, library):
    texts = [t or "" for t in ODD] + list(random_texts(library, 600))
    for text in texts:
        found = coder.tokenizer.encode(text, add_special_tokens=False)
        starts, ends, split = coder.offsets(text, found.ids)
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == found.offsets
        at, inside = 0, 0
        for i in found.ids:  # byte by byte
            inside += at < len(text.encode()) and text.encode()[at] & 0xC0 == 0x80
            at += len(coder.bytes[i])
        assert split == inside


def test_decoding_split_characters(coder):
    ids = coder.encode(["a🙂é日"])[0]
    pieces = coder.pieces(ids)
    assert "".join(pieces) == "a🙂é日" and len(pieces) == len(ids) and "" in pieces
    half = coder.encode(["🙂"])[0][:1]
    assert coder.pieces(half) == ["�"] and coder.decode(half) == "🙂".encode()[: len(coder.decode(half))]
    assert coder.decode([50256, -1, None, 0]) == "���!".encode() and coder.pieces([]) == []


def test_documents(spark, table, library):
    want = {i: library.encode_ordinary(t or "") for i, t in enumerate(ODD)} | {None: library.encode_ordinary("null id")}
    texts = {i: t or "" for i, t in enumerate(ODD)} | {None: "null id"}
    coded = byte_bpe.encode_documents(table, PATH, PATTERN)
    rows = coded.collect()
    assert len(rows) == table.count() and all(list(r.ids) == want[r.doc] for r in rows)
    for r in rows:
        assert all(texts[r.doc][a:b] for a, b in zip(r.starts, r.ends, strict=True))
    assert {(r.doc, r.text) for r in byte_bpe.decode_documents(coded, PATH, PATTERN).collect()} == set(texts.items())
    got = byte_bpe.round_trip(table, PATH, PATTERN).collect()
    assert len(got) == table.count()
    for r in got:
        shown = " ".join(map(str, want[r.doc_id]))
        assert (r.n_tokens, r.n_chars) == (len(want[r.doc_id]), len(texts[r.doc_id]))
        assert r.ids_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert byte_bpe.round_trip(table.limit(0), PATH, PATTERN).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [1 << 30, None, -5])], "doc long, ids array<int>")
    assert {r.doc: r.text for r in byte_bpe.decode_documents(odd, PATH, PATTERN).collect()} == {1: "", 2: "", 3: "���"}


def test_query_on_the_whole_table(spark, library):
    from corpusloom.llm.queries import op11_byte_bpe

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op11_byte_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (r.n_tokens, r.decoded_sha256) == (len(ids), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
