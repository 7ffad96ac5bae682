"""Byte-level BPE with the tokenizers library over Arrow batches, offsets, and decoding.

A rank file lists byte strings by rank. The library's model works on characters, so each byte stands for one printable
character (``byte_chars``); the vocabulary and its merges are written in those. A rank file names no merges: every cut of
an entry into two entries is one, by the entry's rank, and a piece that is an entry as a whole is not merged at all. The
pattern's matches are the pieces.

Texts are cut where a character that is no white space meets a space or a line end. The pattern must end a match there and must
not look back, as patterns of this kind do; then the ids are those of the whole text. Most parts are single words, so a worker
keeps the ids of short ones and the library encodes each but once, with others in a batch of about ``BATCH`` characters.

Offsets are in characters. They come from the byte lengths of the ids and the place of each byte's character; a token that
holds part of a character has that character in its span, as its neighbour has. Decoding turns an id's characters back into
bytes; a character that several tokens hold part of comes with the last of them.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
import re

import numpy as np
from pyspark.sql import DataFrame

from .textkit import map_rows, worker_memory

#: Characters of a batch of the library, about; parts that a worker keeps, and how long they are at most.
BATCH, KEPT, SHORT = 1 << 19, 1 << 19, 64
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
#: Bytes of an id that the table doesn't have: the replacement character.
UNKNOWN = "�".encode()


def byte_chars() -> list[str]:
    """The character of each byte: its own if that is printable, else the next one from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class ByteBPE:
    """A rank file (base64 bytes, a space, the rank, a line each) with the pattern that splits text before merging."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        chars = byte_chars()
        shown = {token: "".join(chars[b] for b in token) for token in ranks}
        merges = []
        for token in sorted(ranks, key=ranks.__getitem__):
            cuts = [(ranks[a], ranks[b], a, b) for i in range(1, len(token)) if (a := token[:i]) in ranks and (b := token[i:]) in ranks]
            merges += [(shown[a], shown[b]) for _, _, a, b in sorted(cuts)]
        self.tokenizer = Tokenizer(models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
        pieces = pre_tokenizers.Split(Regex(pattern), "isolated")
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pieces, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        back = {c: b for b, c in enumerate(chars)}
        #: Bytes of each id, by reversing the table of characters.
        self.bytes = [UNKNOWN] * (max(ranks.values(), default=-1) + 1)
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = bytes(back[c] for c in token)
        self.sizes = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.shown = [str(i) for i in range(len(self.bytes))]
        self.kept: dict[str, list[int]] = {}

    @classmethod
    def of(cls, path: str, pattern: str) -> ByteBPE:
        """The worker's own, kept from task to task."""
        kept = worker_memory("byte_bpe")
        if (path, pattern) not in kept:
            kept[path, pattern] = cls(path, pattern)
        return kept[path, pattern]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; null has none."""
        parts = [_CUT.split(t) if t else [] for t in texts]
        if len(self.kept) > KEPT:
            self.kept.clear()
        known, long = self.kept, {}
        held, size = [], 0
        for part in set().union(*parts).difference(known):
            held.append(part)
            size += len(part)
            if size >= BATCH:
                self._learn(held, long)
                held, size = [], 0
        self._learn(held, long)
        if not long:
            return [[i for part in own for i in known[part]] for own in parts]
        return [[i for part in own for i in (known[part] if len(part) <= SHORT else long[part])] for own in parts]

    def _learn(self, parts: list[str], long: dict[str, list[int]]) -> None:
        for part, e in zip(parts, self.tokenizer.encode_batch_fast(parts, add_special_tokens=False), strict=True):
            (self.kept if len(part) <= SHORT else long)[part] = e.ids

    def offsets(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray, int]:
        """(first character, end character) of each id's span, and how many ids begin within a character."""
        ends = np.cumsum(self.sizes[np.array(ids, dtype=np.int64)])
        starts = ends - self.sizes[np.array(ids, dtype=np.int64)]
        if not len(ends) or ends[-1] == len(text):  # a byte a character
            return starts, ends, 0
        first = (np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0) != 0x80
        char = np.cumsum(first) - 1
        return char[starts], char[ends - 1] + 1, int((~first[starts]).sum())

    def decode(self, ids: list[int]) -> bytes:
        table, n = self.bytes, len(self.bytes)
        try:
            return b"".join([table[i] for i in ids]) if min(ids, default=0) >= 0 else self._guarded(ids)
        except (IndexError, TypeError):
            return self._guarded(ids)

    def _guarded(self, ids: list[int | None]) -> bytes:
        return b"".join(self.bytes[i] if i is not None and 0 <= i < len(self.bytes) else UNKNOWN for i in ids)

    def pieces(self, ids: list[int]) -> list[str]:
        """The text that each id completes: a character held in parts comes with its last part, '' before it. What isn't UTF-8
        is the replacement character; what the end leaves incomplete comes with the last id."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        return [reader.decode(self.decode([i]), final=k == len(ids) - 1) for k, i in enumerate(ids)]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, ids, starts, ends) of every row: ids and the character spans of their text.

    Null and empty texts have no ids; repeated rows repeat; null ids pass; other columns are not read; no rows give no rows.
    """
    schema = f"doc {docs.schema[id_col].dataType.simpleString()}, ids array<int>, starts array<int>, ends array<int>"

    def rows(part: list[tuple]) -> list[tuple]:
        coder = ByteBPE.of(path, pattern)
        found = coder.encode([t for _, t in part])
        return [(d, ids, *(x.tolist() for x in coder.offsets(t or "", ids)[:2])) for (d, t), ids in zip(part, found, strict=True)]

    return map_rows(docs, [id_col, text_col], schema, rows, step=64)


def decode_documents(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc", ids_col: str = "ids") -> DataFrame:
    """(doc, text) of every row of ids. Null has the text ''; null, negative and unknown ids and bytes that aren't UTF-8 are replacement
    characters; repeated rows repeat; other columns are not read; no rows give no rows."""
    schema = f"doc {encoded.schema[id_col].dataType.simpleString()}, text string"

    def rows(part: list[tuple]) -> list[tuple]:
        coder = ByteBPE.of(path, pattern)
        return [(d, coder.decode(ids or []).decode("utf-8", "replace")) for d, ids in part]

    return map_rows(encoded, [id_col, ids_col], schema, rows, step=64)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, n_chars, n_split) of every row: digests of the ids in decimal, joined by one space,
    and of the bytes decoded from them; n_split ids begin within a character.

    Each task encodes and decodes its own rows, so nothing is shuffled. Null counts as empty; repeated rows repeat; null ids pass;
    other columns, whatever their names, are not read; no rows give no rows.
    """
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_chars long, n_split long"

    def rows(part: list[tuple]) -> list[tuple]:
        coder = ByteBPE.of(path, pattern)
        out = []
        for (d, text), ids in zip(part, coder.encode([t for _, t in part]), strict=True):
            shown = " ".join([coder.shown[i] for i in ids])
            digests = (hashlib.sha256(x).hexdigest() for x in (shown.encode(), coder.decode(ids)))
            out.append((d, len(ids), *digests, len(text or ""), coder.offsets(text or "", ids)[2]))
        return out

    return map_rows(docs, [id_col, text_col], schema, rows, step=64)
