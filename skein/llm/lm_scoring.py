"""LM scoring: a smoothed bigram model whose counts sit in a log-frequency Bloom filter, a segment a bucket of bigrams.

Counts are quantised to levels, level = 1 + floor(log_BASE(count)); a bigram of level L is put into the filter as the keys
(bigram, 1) .. (bigram, L). A reader probes level after level until one is missing and takes the least count of the last
level found. Every bigram of the training rows is in the filter, from level 1 on: bigrams are 64-bit hashes of both words,
dealt to buckets, and a bucket's segment has BITS_A_KEY bits for each of its measured keys. Number and content of the buckets
follow from the rows alone, so that a score is the same in any session and however the rows are dealt. Chunks send their bigrams to the
buckets and get levels back, so that a task holds one segment at a time. Words have their exact counts, which are summed over the
whole corpus in hash buckets and sent back in the same way.

log10 P(w | h) = log10((c'(h, w) + T(h) P0(w)) / (c(h) + T(h))), with T(h) the number of different successors of h (Witten
and Bell) and P0 the additive unigram estimate; a word after a word that was never learned has P0 alone.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.chunks import groups, map_chunks, read_chunk, total_bytes, write_chunks
from skein.llm.words import LOWER, SPACE, all_words, mix, shard
from skein.storage import materialize, shuffle_partitions

BASE = 1.5
FILTER_BITS = 1 << 27  # of a filter whose size isn't given
PROBES = 5
BITS_A_KEY = 16
END = np.uint64(0x0A)  # no word has this hash but by chance
_SECOND = np.uint64(0x9E3779B97F4A7C1B)  # what the second word of a bigram counts in its key
ADD = 0.1
#: Text a task holds at a time; its tokens take some thirty times as much while they are scored.
CHUNK_BYTES = 8 << 20
#: Text whose words and bigrams share a bucket, and the least number of buckets. The rows alone settle it, and with it each filter segment.
BUCKET_BYTES, BUCKETS = 24 << 20, 64


def levels(counts: np.ndarray) -> np.ndarray:
    return (1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(BASE) + 1e-9)).astype(np.int64)


def least_count(level: np.ndarray) -> np.ndarray:
    """The smallest whole count of a level; 0 for level 0."""
    return np.where(level > 0, np.ceil(BASE ** (np.maximum(level, 1) - 1.0) - 1e-9), 0.0)


class LogFrequencyBloom:
    """Segments of one Bloom filter; a key's segment is given with it."""

    def __init__(self, segments: int, bits: int = FILTER_BITS, data: np.ndarray | None = None):
        self.size = max(64, bits // segments // 8 * 8)
        self.data = np.zeros((segments, self.size // 8), np.uint8) if data is None else data

    def _places(self, keys: np.ndarray, level: np.ndarray) -> Iterator[np.ndarray]:
        h = mix(keys * np.uint64(0x9E3779B97F4A7C15) + level.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
        for i in range(PROBES):
            yield ((a + b * np.uint64(i)) & np.uint64(0xFFFFFFFF)) % np.uint64(self.size)

    def add(self, segment: int, keys: np.ndarray, level: np.ndarray, low: int) -> None:
        """Put in levels low..level of each key; nothing for keys below low."""
        bits = np.zeros(self.size, bool)
        for j in range(low, int(level.max(initial=0)) + 1):
            for p in self._places(keys[level >= j], np.full(int((level >= j).sum()), j)):
                bits[p] = True
        self.data[segment] |= np.packbits(bits)

    def level(self, segment: np.ndarray, keys: np.ndarray, low: int) -> np.ndarray:
        """Highest level found, probing from low upwards; 0 if none."""
        out = np.zeros(len(keys), np.int64)
        at, j = np.arange(len(keys)), low
        while len(at):
            ok = np.ones(len(at), bool)
            for p in self._places(keys[at], np.full(len(at), j)):
                ok &= (self.data[segment[at], p >> np.uint64(3)] >> (7 - (p & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
            at = at[ok]
            out[at] = j
            j += 1
        return out


def _tokens(uri: str):
    """A chunk: table, hashes of all tokens (each text's words, then END), tokens of each text."""
    table = read_chunk(uri).combine_chunks()
    h, counts = all_words(table.column("t"), SPACE, LOWER)
    out = np.full(len(h) + len(counts), END, np.uint64)
    ends = np.cumsum(counts + 1) - 1
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep] = h
    return table, out, counts + 1


def lm_score(docs: DataFrame, train: DataFrame | str = "true", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    train: a SQL predicate; rows for which it is true are learned from, all others (also where it is null) are held out. A
    null text is empty and has the one token END. Rows repeated in the table count as often as they stand there. With no
    training rows, train_tokens is 0 and both scores are those of a vocabulary of the one unknown word. Other columns take
    no part. An empty table gives an empty one; a very long text makes a chunk of
    its own. Learning gathers counts of all words and of all bigrams. Bigrams are dealt by their first word, those of a word
    with more than a bucket's share of the tokens by both words; at most 64 words a bucket come to the driver for that.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{text_col}`").cast("string").alias("t"), F.coalesce(F.expr(train), F.lit(False)).alias("train"))
    manifest = write_chunks(rows, "lm", CHUNK_BYTES)
    buckets = max(BUCKETS, total_bytes(manifest) // BUCKET_BYTES)
    tasks = min(buckets, max(parts, -(-buckets // 4)))

    def sorted_words(uri: str):
        table, tok, counts = _tokens(uri)
        u, inverse = np.unique(tok, return_inverse=True)
        return table, counts, u, inverse, np.searchsorted(shard(u, buckets), np.arange(buckets + 1))

    def count_words(uri: str) -> Iterator[pa.RecordBatch]:
        table, counts, u, inverse, ends = sorted_words(uri)
        train_row = np.repeat(table.column("train").to_numpy(zero_copy_only=False), counts)
        c = np.bincount(inverse[train_row], minlength=len(u)).astype(np.int64)
        for b in np.flatnonzero(np.diff(ends)):
            s = slice(ends[b], ends[b + 1])
            yield pa.RecordBatch.from_pydict({"chunk": [uri], "bucket": pa.array([int(b)], pa.int32()), "hashes": [u[s].tobytes()], "counts": [zlib.compress(c[s].tobytes(), 1)]})

    def sum_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, found in groups(batches, "bucket"):
            h = [np.frombuffer(r["hashes"], np.uint64) for r in found]
            u, inverse = np.unique(np.concatenate(h), return_inverse=True)
            c = np.zeros(len(u), np.int64)
            np.add.at(c, inverse, np.concatenate([np.frombuffer(zlib.decompress(r["counts"]), np.int64) for r in found]))
            ends = np.cumsum([0, *map(len, h)])
            top = np.lexsort((u, -c))[:64]
            chunk = [r["chunk"] for r in found] + [None]
            sums = [zlib.compress(c[inverse[x:y]].tobytes(), 1) for x, y in zip(ends, ends[1:], strict=False)] + [None]
            last = lambda x: [None] * len(found) + [x]
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(chunk, pa.string()), "bucket": pa.array([b] * len(chunk), pa.int32()), "sums": pa.array(sums, pa.binary()), "tokens": pa.array(last(int(c.sum())), pa.int64()), "words": pa.array(last(int((c > 0).sum())), pa.int64()), "hot": pa.array(last(u[top].tobytes()), pa.binary()), "hot_counts": pa.array(last(c[top].tobytes()), pa.binary())})

    def dealt(df: DataFrame, key: str, n: int) -> DataFrame:
        part = df.repartitionById(n, F.pmod("bucket", F.lit(n))) if key == "bucket" else df.repartitionByRange(n, key)
        return part.sortWithinPartitions(key)

    words = map_chunks(manifest, count_words, "chunk string, bucket int, hashes binary, counts binary")
    sums = materialize(dealt(words, "bucket", tasks).mapInArrow(sum_words, "chunk string, bucket int, sums binary, tokens long, words long, hot binary, hot_counts binary"), "lm-words")
    per_bucket = sums.filter("chunk is null").select("tokens", "words", "hot", "hot_counts").collect()  # at most 64 words a bucket
    N, V = sum(r["tokens"] for r in per_bucket), sum(r["words"] for r in per_bucket)
    hot_count = np.frombuffer(b"".join(r["hot_counts"] for r in per_bucket), np.int64)
    #: Words whose bigrams are dealt by both words; this settles the bucket alone, not what is counted.
    hot = np.sort(np.frombuffer(b"".join(r["hot"] for r in per_bucket), np.uint64)[hot_count * buckets > N])
    shared_hot = spark.sparkContext.broadcast(hot)

    def sorted_pairs(counts: np.ndarray, u: np.ndarray, inverse: np.ndarray):
        """Distinct bigrams of a chunk (END is before the first word of a text), sorted by bucket and first word: their
        keys, number of the first word in u, where each bucket ends; and the bigram of each token."""
        head = np.r_[0, inverse[:-1]]
        head[np.r_[0, np.cumsum(counts)[:-1]]] = np.searchsorted(u, END)
        keys, first, pair = np.unique(mix(u[head] + u[inverse] * _SECOND), return_index=True, return_inverse=True)
        head = head[first]
        bucket = np.where(np.isin(u[head], shared_hot.value), shard(keys, buckets), shard(u[head], buckets))
        by = np.lexsort((head, bucket))
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        return keys[by], head[by], np.searchsorted(bucket[by], np.arange(buckets + 1)), place[pair]

    def runs(head: np.ndarray) -> np.ndarray:
        """Where each run of equal numbers begins."""
        return np.flatnonzero(np.r_[True, head[1:] != head[:-1]])

    def count_pairs(uri: str) -> Iterator[pa.RecordBatch]:
        table, counts, u, inverse, _ = sorted_words(uri)
        keys, head, ends, pair = sorted_pairs(counts, u, inverse)
        c = np.bincount(pair[np.repeat(table.column("train").to_numpy(zero_copy_only=False), counts)], minlength=len(keys)).astype(np.int64)
        for b in np.flatnonzero(np.diff(ends)):
            s = slice(ends[b], ends[b + 1])
            at = runs(head[s])
            yield pa.RecordBatch.from_pydict({"chunk": [uri], "bucket": pa.array([int(b)], pa.int32()), "heads": [u[head[s][at]].tobytes()], "runs": [zlib.compress(np.diff(np.r_[at, ends[b + 1] - ends[b]]).tobytes(), 1)], "keys": [keys[s].tobytes()], "counts": [zlib.compress(c[s].tobytes(), 1)]})

    of_hot = pa.map_(pa.int32(), pa.int64())

    def answer_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, found in groups(batches, "bucket"):
            heads = [np.frombuffer(r["heads"], np.uint64) for r in found]
            keys = [np.frombuffer(r["keys"], np.uint64) for r in found]
            ends = np.cumsum([0, *map(len, keys)])
            u, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            head = np.concatenate([np.repeat(h, np.frombuffer(zlib.decompress(r["runs"]), np.int64)) for h, r in zip(heads, found, strict=True)])[first]
            c = np.zeros(len(u), np.int64)
            np.add.at(c, inverse, np.concatenate([np.frombuffer(zlib.decompress(r["counts"]), np.int64) for r in found]))
            learned = c > 0
            level = levels(c[learned])
            segment = LogFrequencyBloom(1, BITS_A_KEY * int(level.sum()))
            segment.add(0, u[learned], level, 1)
            level = segment.level(np.zeros(len(u), np.int64), u, 1).astype(np.uint8)
            names, kinds = np.unique(head[learned], return_counts=True)

            def kinds_of(h: np.ndarray) -> np.ndarray:
                if not len(names):
                    return np.zeros(len(h), np.int64)
                at = np.minimum(np.searchsorted(names, h), len(names) - 1)
                return np.where(names[at] == h, kinds[at], 0)

            for r, h, x, y in zip(found, heads, ends, ends[1:], strict=False):
                yield pa.RecordBatch.from_pydict({"chunk": [r["chunk"]], "bucket": pa.array([b], pa.int32()), "levels": [zlib.compress(level[inverse[x:y]].tobytes(), 1)], "kinds": [zlib.compress(kinds_of(h).tobytes(), 1)], "hot_kinds": pa.array([None], of_hot)})
            n = kinds_of(shared_hot.value)
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([None], pa.string()), "bucket": pa.array([b], pa.int32()), "levels": pa.array([None], pa.binary()), "kinds": pa.array([None], pa.binary()), "hot_kinds": pa.array([[(int(i), int(n[i])) for i in np.flatnonzero(n)]], of_hot)})

    pairs = map_chunks(manifest, count_pairs, "chunk string, bucket int, heads binary, runs binary, keys binary, counts binary")
    answers = materialize(dealt(pairs, "bucket", tasks).mapInArrow(answer_pairs, "chunk string, bucket int, levels binary, kinds binary, hot_kinds map<int,long>"), "lm-bigrams")
    #: Fewer hot words than buckets, as each has more than a bucket's share.
    hot_kinds = np.zeros(len(hot), np.int64)
    for r in answers.filter("chunk is null").select(F.explode("hot_kinds").alias("hot", "kinds")).groupBy("hot").agg(F.sum("kinds").alias("n")).collect():
        hot_kinds[r["hot"]] = r["n"]
    shared_kinds = spark.sparkContext.broadcast(hot_kinds)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri, found in groups(batches, "chunk"):
            table, counts, u, inverse, ends = sorted_words(uri)
            keys, head, pair_ends, pair = sorted_pairs(counts, u, inverse)
            c, kinds, level = np.zeros(len(u), np.int64), np.zeros(len(u), np.int64), np.zeros(len(keys), np.uint8)
            for r in found:
                b = r["bucket"]
                if r["sums"] is not None:
                    c[ends[b] : ends[b + 1]] = np.frombuffer(zlib.decompress(r["sums"]), np.int64)
                else:
                    s = slice(pair_ends[b], pair_ends[b + 1])
                    level[s] = np.frombuffer(zlib.decompress(r["levels"]), np.uint8)
                    kinds[head[s][runs(head[s])]] = np.frombuffer(zlib.decompress(r["kinds"]), np.int64)
            _, at, of = np.intersect1d(u, shared_hot.value, assume_unique=True, return_indices=True)
            kinds[at] = shared_kinds.value[of]
            p = ((c + ADD) / (N + ADD * (V + 1)))[inverse]
            h = head[pair]
            total, kind = c[h].astype(float), kinds[h].astype(float)
            q = np.where(total > 0, (np.minimum(least_count(level.astype(np.int64))[pair], total) + kind * p) / np.maximum(total + kind, 1), p)
            at = np.r_[0, np.cumsum(counts)[:-1]]
            train_row = table.column("train").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([table.column("k").combine_chunks(), pa.array(~train_row), pa.array(counts, pa.int64()), pa.array(np.add.reduceat((c > 0)[inverse].astype(np.int64), at)), pa.array(np.full(len(counts), N), pa.int64()), pa.array(np.add.reduceat(np.log10(p), at)), pa.array(np.add.reduceat(np.log10(q), at))], ["k", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = rows.schema["k"].dataType.simpleString()
    none = F.lit(None).cast("binary")
    replies = sums.filter("chunk is not null").select("chunk", "bucket", "sums", none.alias("levels"), none.alias("kinds")).union(answers.filter("chunk is not null").select("chunk", "bucket", none.alias("sums"), "levels", "kinds"))
    n = max(1, min(100_000, max(manifest.count(), parts)))
    return dealt(replies, "chunk", n).mapInArrow(score, f"k {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double").withColumnRenamed("k", id_col)
