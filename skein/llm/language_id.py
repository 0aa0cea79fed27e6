"""Language ID by error-correcting output codes.

Each language has a codeword; for each bit a linear classifier over hashed character n-grams (1 to 3 letters, words
padded by a space) is trained to predict it. Decoding is loss-weighted: a classifier's logistic loss against a codeword's
bit counts as much as it was right on that language's training rows, and the codeword of least total loss wins. A text is
flagged ambiguous when the runner-up is nearly as close.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.chunks import arrow_map

#: The bound of the training sample: at most SAMPLE distinct texts of each language, and at most ROWS in all (at least one a language).
SAMPLE, ROWS, WIDTH = 500, 1 << 15, 1 << 12
UND = "und"


def _letters() -> np.ndarray:
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


_TABLE: list[np.ndarray] = []


def features(texts: list[str | None], width: int = WIDTH, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Square roots of n-gram shares, a row of unit length a text, and whether the text has letters."""
    if not _TABLE:
        _TABLE.append(_letters())
    out, lettered = np.zeros((len(texts), width), np.float32), np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        total = np.zeros(width, np.int64)
        last = np.zeros(1, np.uint32)  # what the piece before ended with: two characters, or the gap before the text
        for at in range(0, len(text or ""), piece):  # bounded memory; n-grams that end in a piece are counted with it
            c = _TABLE[0][np.frombuffer(text[at : at + piece].encode("utf-32-le", "surrogatepass"), np.uint32)]
            lettered[i] |= bool(c.any())
            n = len(last)
            c = np.concatenate((last, c, [0] if at + piece >= len(text) else [])).astype(np.uint32)
            keep = np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]  # one gap between words
            n, c = int(keep[:n].sum()), c[keep]
            two = c[:-1] * np.uint32(0x9E3779B1) + c[1:]
            three = (two[:-1] * np.uint32(0xC2B2AE35)) ^ (c[2:] * np.uint32(0x27D4EB2F))
            one = c[n:]
            for h in (one[one != 0] * np.uint32(3), two[n - 1 :] * np.uint32(0x85EBCA6B), three[max(0, n - 2) :]):
                h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                total += np.bincount((h >> np.uint32(20)).astype(np.int64) & (width - 1), minlength=width)
            last = c[-2:]
        if lettered[i]:
            out[i] = np.sqrt(total)
            out[i] /= np.linalg.norm(out[i])
    return out, lettered


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of -1 and 1: all splits of the languages up to 6 of them, else random ones far from each other."""
    if n <= 6:
        return np.array([(1, *rest) for rest in product((1, -1), repeat=n - 1) if -1 in rest], np.int8).T.reshape(n, -1)
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(12 * np.log2(n)))
    tries = [rng.choice(np.array([-1, 1], np.int8), (n, bits)) for _ in range(200)]
    return max(tries, key=lambda m: -int((m.astype(int) @ m.T - 2 * bits * np.eye(n, dtype=int)).max()))


@dataclass
class EcocModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray  # languages x bits: share of a language's training rows on which a bit was right, summing to 1

    def losses(self, x: np.ndarray) -> np.ndarray:
        margin = x @ self.weights + self.bias
        return np.einsum("lb,nlb->nl", self.trust, np.logaddexp(0, -self.code[None] * margin[:, None, :]))

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the language, its share of trust among all (0 to 1), and the lead over the runner-up."""
        loss = self.losses(x) * max(1, self.code.shape[1])
        p = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        top = np.sort(p, axis=1)
        return p.argmax(axis=1), top[:, -1], top[:, -1] - (top[:, -2] if p.shape[1] > 1 else 0)


def fit(x: np.ndarray, y: list[str], steps: int = 300, rate: float = 20.0, decay: float = 1e-6) -> EcocModel | None:
    """Logistic regression for all bits at once, languages weighted alike; None without rows."""
    languages = sorted(set(y))
    if not languages:
        return None
    code = codewords(len(languages)) if len(languages) > 1 else np.ones((1, 1), np.int8)
    number = np.array([languages.index(v) for v in y])
    target = code[number].astype(np.float32)
    weight = (1 / np.bincount(number)[number] / len(languages)).astype(np.float32)[:, None]
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    mw, mb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        g = -target / (1 + np.exp(np.clip(target * (x @ w + b), -30, 30))) * weight
        mw = 0.9 * mw + x.T @ g + decay * w
        mb = 0.9 * mb + g.sum(axis=0)
        w -= rate * mw
        b -= rate * 0.1 * mb
    right = (np.sign(x @ w + b) == target).astype(float)
    trust = np.array([right[number == i].mean(axis=0) for i in range(len(languages))]) + 1e-6
    return EcocModel(languages, code, w, b, trust / trust.sum(axis=1, keepdims=True))


def train(docs: DataFrame, predicate: str, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, most: int = ROWS) -> EcocModel | None:
    """Fit on rows for which predicate holds and lang is not null, of every language: its `sample` distinct texts of least hash.

    With n languages it is at most max(1, most // n) texts a language, so that at most `most` rows (or one a language) come
    to the driver, as sparse features of WIDTH. Copies of a text count once, folded before the shuffle; distinct texts are
    estimated over all rows, and a language of few is taken whole. No rows, or no languages, give None.
    """
    lang, text = F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("t")
    rows = docs.filter(F.expr(predicate)).select(lang, text).filter("lang is not null and t is not null").withColumn("at", F.xxhash64("t"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").agg(F.approx_count_distinct("at")).collect()}
    if not counts:
        return None
    sample = max(1, min(sample, most // len(counts)))
    share = F.create_map(*(F.lit(v) for k, n in sorted(counts.items()) for v in (k, min(1.0, (2 * sample + 64) / (0.8 * n)))))
    near = rows.filter(F.shiftrightunsigned("at", 34).cast("double") < F.element_at(share, F.col("lang")) * float(1 << 30))
    folded = near.groupBy("lang", "at").agg(F.min("t").alias("t"))
    first = Window.partitionBy("lang").orderBy("at")  # some 2 * sample rows a language
    picked = folded.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= sample).select("lang", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                x, ok = features(part.column(1).to_pylist())
                places = [np.flatnonzero(r).astype(np.int32) for r in x[ok]]
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(ok)), pa.array([p.tobytes() for p in places], pa.binary()), pa.array([r[p].tobytes() for r, p in zip(x[ok], places, strict=True)], pa.binary())], ["lang", "places", "values"])

    found = arrow_map(picked, run, "lang string, places binary, values binary").collect()
    found.sort(key=lambda r: (r["lang"], r["places"], r["values"]))
    x = np.zeros((len(found), WIDTH), np.float32)
    for i, r in enumerate(found):
        x[i, np.frombuffer(r["places"], np.int32)] = np.frombuffer(r["values"], np.float32)
    return fit(x, [r["lang"] for r in found])


def identify(docs: DataFrame, model: EcocModel | None, text_col: str = "text", ambiguous: float = 0.1) -> DataFrame:
    """docs with lang_pred, score (0 to 1) and lang_ambiguous; one pass, no shuffle.

    lang_pred is `und` with score 0 where the text is null or has no letters, or nothing could be learned. All other columns
    pass through unchanged; rows are independent, so ties and repeated rows need no care.
    """
    names = docs.columns
    fields = [(f"c{i}", f.dataType.simpleString()) for i, f in enumerate(docs.schema.fields)]
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for k in range(0, big.num_rows, 512):
                b = big.slice(k, 512)
                x, ok = features(b.column(at).cast(pa.string()).to_pylist())
                pred, score, doubt = np.array([UND] * b.num_rows, object), np.zeros(b.num_rows), np.zeros(b.num_rows, bool)
                if model is not None and ok.any():
                    i, s, lead = model.decode(x[ok])
                    pred[ok], score[ok], doubt[ok] = np.array(model.languages, object)[i], s, lead < ambiguous
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score.astype(float)), pa.array(doubt)], [*(n for n, _ in fields), "lang_pred", "score", "lang_ambiguous"])

    schema = ", ".join([*(f"{n} {t}" for n, t in fields), "lang_pred string, score double, lang_ambiguous boolean"])
    out = arrow_map(docs.toDF(*(n for n, _ in fields)), run, schema)
    return out.toDF(*names, *(c if c not in names else f"{c}_id" for c in ("lang_pred", "score", "lang_ambiguous")))
