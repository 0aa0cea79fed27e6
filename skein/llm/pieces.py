"""SentencePiece BPE encoding and decoding by a table of prefixes, in linear time.

Every prefix of a text has one encoding, so one last token. Going from left to right, an automaton over the vocabulary gives
the tokens that end at each place; the one that fits the last token of the prefix before it is stored. The ids are then read
off backwards. Two neighbours fit if merging their characters from scratch gives just those two: that is read off the merges
that made them and memoised. Pieces of equal score (the runs of blanks) merge from the left, which no order of merges
states, so pairs with one of those are merged from scratch once.

A text is cut where no piece of the vocabulary reaches across; what lies between cuts is encoded once and remembered.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from skein.llm.bpe import ByteBpe
from skein.llm.chunks import arrow_map

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
#: Types of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


class PieceBpe:
    """Encoder and decoder of one model file of BPE type with byte fallback and identity normalisation.

    Other models (unigram, normalisation rules, pieces of the user's own) are refused by a ValueError.
    """

    _fit = ByteBpe._fit

    def __init__(self, model: bytes, cache: int = 400_000):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, kinds = proto.normalizer_spec, Counter(p.type for p in proto.pieces)
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback or kinds[BYTE] != 256 or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("a BPE model with byte fallback and without pieces of the user's own is needed")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not (norm.add_dummy_prefix and norm.escape_whitespaces):
            raise ValueError("a model that only escapes blanks and adds one in front is needed")
        self.end = proto.trainer_spec.eos_id
        self.kind = [p.type for p in proto.pieces]
        of_byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        #: Bytes of each id when decoded; control pieces have none.
        self.out = [{NORMAL: p.piece.replace(BLANK, " ").encode(), UNKNOWN: proto.trainer_spec.unk_surface.encode(), CONTROL: b"", BYTE: bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else b""}[p.type] for p in proto.pieces]
        self.out_text = {str(i): b for i, b in enumerate(self.out)}

        normal = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        many = sorted((t for t in normal if len(t) > 1), key=lambda t: (-normal[t][1], t))
        chars = sorted({c for t in normal for c in t})
        self.score = {t: normal[t][1] for t in many}
        shared = {s for s, n in Counter(self.score.values()).items() if n > 1}
        #: Tokens in the order in which they can be made: characters, then pieces by score.
        self.tokens = chars + many
        self.number = {t: i for i, t in enumerate(self.tokens)}
        self.tied = {self.number[t] for t in many if self.score[t] in shared}
        self.ids_of = [str(normal[t][0]) if t in normal else " ".join(str(of_byte[b]) for b in t.encode()) for t in self.tokens]
        self.of_byte = {b: str(i) for b, i in of_byte.items()}

        self.merged: dict[tuple[int, int], int] = {}
        self.halves = {i: (i, i) for i in range(len(self.tokens))}
        self.fits: dict[tuple[int, int], bool] = {}
        made = set(range(len(chars)))
        for t in many:
            i = self.number[t]
            if i in self.tied:
                if self._from_scratch(t) == [t]:
                    made.add(i)
                continue
            for at in range(1, len(t)):
                left, right = self.number.get(t[:at], i), self.number.get(t[at:], i)
                if left < i and right < i and {left, right} <= made and self._fits(left, right):
                    self.merged[left, right] = i
                    self.halves[i] = left, right
                    made.add(i)
                    break
            else:
                if self._from_scratch(t) == [t]:
                    raise ValueError(f"piece {t!r} is made of a piece with a lower score than its own")
        self.automaton = ahocorasick.Automaton()
        for i in made:  # other pieces are never the result of merges
            self.automaton.add_word(self.tokens[i], (i, len(self.tokens[i])))
        self.automaton.make_automaton()
        self.pattern = re.compile(self._cuts(many))
        #: Ids of pieces seen; those seen since the last time it was full stay.
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.cache = cache

    @classmethod
    def load(cls, path: str | None = None, **more) -> PieceBpe:
        """path: a model file; default: the public model MODEL."""
        with open(path or public_tokenizers.path(MODEL), "rb") as f:
            return cls(f.read(), **more)

    @staticmethod
    def _cuts(many: list[str]) -> str:
        """Pattern of the pieces between cuts: no token has the last character of one and the first of the next side by side.

        Marks are a set of characters that come in tokens after blanks and other marks only, so that a cut is before a mark
        that follows anything else.
        """
        pairs = {(a, b) for t in many for a, b in zip(t, t[1:], strict=False)}
        joining = {c for t in many for c in t if c != BLANK}
        every = "".join(map(re.escape, sorted(joining)))
        if any(b == BLANK and a != BLANK for a, b in pairs):
            return f"[{BLANK}{every}]+|[^{BLANK}{every}]"
        marks = {c for c in joining if not c.isalnum()}
        while more := {a for a, b in pairs if b in marks and a != BLANK} - marks:
            marks |= more
        first, then = ("".join(map(re.escape, sorted(s))) for s in (marks, joining - marks))
        if not first or not then:
            return f"{BLANK}*[{every}]+|{BLANK}+|[^{BLANK}{every}]"
        return f"{BLANK}*[{first}]*[{then}]+|{BLANK}*[{first}]+|{BLANK}+|[^{BLANK}{every}]"

    def _from_scratch(self, text: str) -> list[str]:
        """Merge by merge, the best score first, of equals the leftmost: for the few short strings that scores alone don't settle."""
        parts = list(text)
        while True:
            best = max(((self.score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.score), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _fits(self, left: int, right: int) -> bool:
        key = left, right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            if left in self.tied or right in self.tied:
                known = self._from_scratch(self.tokens[left] + self.tokens[right]) == [self.tokens[left], self.tokens[right]]
            else:
                known = self._fit(left, right)
            self.fits[key] = known
        return known

    def last_tokens(self, piece: str) -> list[int]:
        """The last token of each prefix of a piece, all of whose characters are in the vocabulary; -1 for the empty prefix."""
        last, fits = [-1] * (len(piece) + 1), self.fits
        for at, (token, size) in self.automaton.iter(piece):
            if last[at + 1] < 0:
                before = last[at + 1 - size]
                if before < 0:
                    last[at + 1] = token
                else:
                    ok = fits.get((before, token))
                    if self._fits(before, token) if ok is None else ok:
                        last[at + 1] = token
        return last

    def _encode_piece(self, piece: str) -> str:
        """Decimal ids of a piece between two cuts, joined by blanks."""
        if len(piece) == 1 and piece not in self.number:
            return " ".join(self.of_byte[b] for b in piece.encode())
        last, at, ids = self.last_tokens(piece), len(piece), []
        while at:
            ids.append(self.ids_of[last[at]])
            at -= len(self.tokens[last[at]])
        return " ".join(reversed(ids))

    def _new(self, piece: str) -> str:
        ids = self.known.get(piece) or self.older.get(piece) or self._encode_piece(piece)
        if len(piece) < 64:
            if len(self.known) >= self.cache:
                self.older, self.known = self.known, {}
            self.known[piece] = ids
        return ids

    def encode_text(self, text: str) -> str:
        """Decimal ids of a text with the end id, joined by blanks."""
        if not text:
            return str(self.end)
        pieces = self.pattern.findall(BLANK + text.replace(" ", BLANK))
        out = list(map(self.known.get, pieces))
        if None in out:
            for i, ids in enumerate(out):
                if ids is None:
                    out[i] = self._new(pieces[i])
        out.append(str(self.end))
        return " ".join(out)

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.encode_text(text).split()))

    def decode(self, ids: Iterable[int | str]) -> str:
        """The text of ids, numbers or decimal strings. The blank in front goes; a byte that is no part of a character becomes U+FFFD."""
        ids = ids if isinstance(ids, list) and ids and isinstance(ids[0], str) else list(map(str, ids))
        raw = list(map(self.out_text.__getitem__, ids))
        first = next((i for i, b in enumerate(raw) if b), len(raw))
        if raw[first : first + 1] and raw[first].startswith(b" ") and self.kind[int(ids[first])] == NORMAL:
            raw[first] = raw[first][1:]
        try:
            return b"".join(raw).decode()
        except UnicodeDecodeError:
            return "".join(self._mended(raw, [self.kind[int(i)] == BYTE for i in ids]))

    def _mended(self, raw: list[bytes], is_byte: list[bool]) -> Iterator[str]:
        at = 0
        while at < len(raw):
            if not is_byte[at]:
                yield raw[at].decode()
                at += 1
                continue
            to = at
            while to < len(raw) and is_byte[to]:
                to += 1
            run = b"".join(raw[at:to])
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        yield run[:n].decode()
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    n = 1
                    yield "�"
                run = run[n:]
            at = to


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> PieceBpe:
    """One encoder a Python worker and model file."""
    return PieceBpe.load(path)


def piece_encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids array<int>) of each row; one pass, no shuffle.

    Ids end with the end id. A null text is empty and has that id alone; an empty table gives an empty one. A very long text is
    worked on in one task, in time and memory in proportion to it. Ids, ties and repeated rows need no care, as rows are
    independent; other columns take no part. The sums are of the decimal ids joined by blanks and of the decoded text.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for b in batches:
            n, ids_sum, text_sum, lists = [], [], [], []
            for x in b.column(1):
                joined = bpe.encode_text(x.as_py() or "")
                ids = joined.split(" ")
                n.append(len(ids))
                ids_sum.append(hashlib.sha256(joined.encode()).hexdigest())
                text_sum.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                lists.append(list(map(int, ids)) if keep_ids else None)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sum, pa.string()), pa.array(text_sum, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(lists, pa.list_(pa.int32()))] * keep_ids, ["k", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids)

    return arrow_map(docs.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{text_col}`").cast("string").alias("t")), run, f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids).withColumnRenamed("k", id_col)
