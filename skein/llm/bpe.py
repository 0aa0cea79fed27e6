"""Byte-level BPE encoding and decoding in linear time.

Bytes stand as Latin-1 characters in a pyahocorasick automaton over the vocabulary, which gives the longest token at each
place. Encoding takes the longest match while the token fits its left neighbour, else the next shorter token, and steps
back when none fits. Two adjacent tokens fit if merging their bytes from scratch would give just those two; that is read
off the merges that made them and memoised. The only sequence all of whose neighbours fit is the one that the merges give.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.chunks import arrow_map

VOCABULARY = "byte_bpe_50k.tiktoken"
#: For texts below U+0180 the built-in engine gives the same pieces, faster: the letters and numbers there.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_NUMBERS = "0-9²³¹¼-¾"
#: What \s means to the Unicode standard; Python's engine adds U+001C to U+001F.
_SPACES = "\\x09-\\x0d\\x20\u0085 "


def _fast_pattern(pattern: str) -> re.Pattern | None:
    if pattern != public_tokenizers.PATTERN:
        return None
    p = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{_SPACES}{_LETTERS}{_NUMBERS}]").replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", f"[{_NUMBERS}]")
    return re.compile(p.replace(r"\s", f"[{_SPACES}]").replace(r"\S", f"[^{_SPACES}]"))


class ByteBpe:
    """Encoder and decoder of one rank file; pieces of a text that the pattern matches are encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, cache: int = 300_000):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.tokens[i] = t
        self.slow, self.fast = regex.compile(pattern), _fast_pattern(pattern)
        self.pieces: dict[str, bytes] = {}
        self.cache = cache
        self.fits: dict[tuple[int, int], bool] = {}
        self.latin = {t.decode("latin-1"): i for t, i in ranks.items()}
        self.width = max(map(len, self.latin))
        self.automaton = ahocorasick.Automaton()
        for t, i in self.latin.items():
            self.automaton.add_word(t, i)
        self.shorter = {}  # the longest token that is a proper prefix of a token
        for t, i in ranks.items():
            n = len(t) - 1
            while n and t[:n] not in ranks:
                n -= 1
            self.shorter[i] = ranks[t[:n]] if n else -1
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for i in sorted(ranks.values()):
            t, left = self.tokens[i], self.shorter[i]
            while left >= 0:
                right = ranks.get(t[len(self.tokens[left]) :], -1)
                if left < i and 0 <= right < i and self._fit(left, right):
                    self.merged[left, right] = i
                    self.halves[i] = left, right
                    break
                left = self.shorter[left]
            else:
                self.halves[i] = i, i

    @classmethod
    def load(cls, path: str | None = None, **more) -> ByteBpe:
        """path: a rank file, base64 token and rank a line; default: the public vocabulary VOCABULARY."""
        with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, **more)

    def _fit(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes before the merges that closed both tokens.

        The border's tokens are undone, the later-made first; a merge of the two that was possible before then would have
        been taken.
        """
        bound = len(self.tokens) + 1
        while True:
            if self.merged.get((left, right), bound) < bound:
                return False
            if left > right:
                bound, half = left, self.halves[left][1]
                if half == left:
                    bound, half = right + 1, self.halves[right][0]
                    if half == right:
                        return True
                    right = half
                else:
                    left = half
            else:
                bound, half = right + 1, self.halves[right][0]
                if half == right:
                    bound, half = left, self.halves[left][1]
                    if half == left:
                        return True
                    left = half
                else:
                    right = half

    def _fits(self, left: int, right: int) -> bool:
        key = left, right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            known = self.fits[key] = self._fit(left, right)
        return known

    def _longest(self, text: str, at: int) -> int:
        rest = text[at : at + self.width]
        rest = rest[: self.automaton.longest_prefix(rest)]  # a prefix of some token; the longest whole token is in it
        while rest not in self.latin:
            rest = rest[:-1]
        return self.latin[rest]

    def encode_piece(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        text, tokens, shorter = piece.decode("latin-1"), self.tokens, self.shorter
        out: list[int] = []
        dead = bytearray(len(piece) + 1)  # places from which no way to the end exists
        at, token = 0, self._longest(text, 0)
        while True:
            to = at + len(tokens[token])
            if not dead[to] and (not out or self._fits(out[-1], token)):
                out.append(token)
                at = to
                if at == len(piece):
                    return out
                token = self._longest(text, at)
            elif shorter[token] >= 0:
                token = shorter[token]
            else:  # back: the token before is tried shorter
                dead[at] = 1
                token = out.pop()
                at -= len(tokens[token])

    def packed(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        fast = self.fast is not None and (text.isascii() or max(text) < "ƀ")
        pieces = (self.fast if fast else self.slow).findall(text)
        out = list(map(self.pieces.get, pieces))
        if None in out:
            for i, ids in enumerate(out):
                if ids is None:
                    out[i] = self._packed_piece(pieces[i])
        return b"".join(out)

    def _packed_piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = array("I", self.encode_piece(piece.encode())).tobytes()
            if len(piece) < 64:
                if len(self.pieces) >= self.cache:
                    self.pieces.clear()
                self.pieces[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> ByteBpe:
    """One encoder a Python worker and rank file."""
    return ByteBpe.load(path)


def bpe_encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids array<int>) of each row; one pass, no shuffle.

    A null text is empty and has no ids. The sums are of the ids as little-endian unsigned 32-bit integers and of the bytes
    that decoding them gives. Ids, ties and repeated rows need no care, as rows are independent; other columns take no part.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for b in batches:
            n, ids_sum, text_sum, lists = [], [], [], []
            for x in b.column(1):
                packed = bpe.packed(x.as_py() or "")
                ids = np.frombuffer(packed, "<u4")
                n.append(len(ids))
                ids_sum.append(hashlib.sha256(packed).hexdigest())
                text_sum.append(hashlib.sha256(bpe.decode(ids.tolist())).hexdigest())
                lists.append(ids.astype(np.int32) if keep_ids else None)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sum, pa.string()), pa.array(text_sum, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(lists, pa.list_(pa.int32()))] * keep_ids, ["k", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids)

    return arrow_map(docs.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{text_col}`").cast("string").alias("t")), run, f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids).withColumnRenamed("k", id_col)
