"""Phrase collocations: frequent phrases by merged count-min sketches and an exact second pass, then scored and subsumed.

Pass one: each chunk of texts counts its phrases into a count-min sketch of ROWS rows, whose width follows the corpus (so that a
cell has a bounded mean load at any size). Sketches are merged by segments of cells, as no task could hold a whole one: a
merged cell is the sum over all phrases in it, so at least the count of each. Each chunk gets back, for each of its cells, whether
the sum reaches the least count. Pass two: a phrase survives if all its cells do; survivors, and they alone, are
counted by their words over the whole corpus. No frequent phrase is lost, and what survives by mistake falls to its exact count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.chunks import groups, map_chunks, read_chunk, total_bytes, write_chunks
from skein.llm.words import LOWER, gram_hashes, mix, pieces, scan
from skein.storage import materialize

#: Bytes that end a piece, and those that end a word.
STOPS = np.zeros(256, bool)
STOPS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAPS = STOPS.copy()
GAPS[[0x20, 0x09]] = True
BLANKS = LOWER.copy()
BLANKS[0x09] = 0x20
LONGEST = 4
ROWS = 2
#: Bytes of text for each cell of a row; a cell then holds about five occurrences of phrases.
BYTES_A_CELL = 8
#: Cells of a segment, which one task sums at a time.
SEGMENT = 1 << 22
CHUNK_BYTES = 5 << 20
#: Chunks whose survivors one task counts.
TOGETHER = 12
_ROW = np.uint64(0xD6E8FEB86659FD93)
_GROUP = np.uint64(0x9E3779B97F4A7C15)


class Phrases:
    """A chunk's phrases of 1 to LONGEST words inside pieces, distinct by group: hashes in order, counts, and where each first stands."""

    def __init__(self, table: pa.Table, group: str, text: str):
        names = table.column(group).combine_chunks().dictionary_encode()
        if isinstance(names, pa.ChunkedArray):
            names = names.combine_chunks()
        self.groups = names.dictionary.to_pylist()
        of_row = names.indices.to_numpy(zero_copy_only=False)
        bufs, hashes, starts, ends, rows, runs, base = [], [], [], [], [], [], 0
        for first, buf, offsets in pieces(table.column(text)):
            w = scan(buf, offsets, GAPS, LOWER)
            row = first + np.repeat(np.arange(len(w.counts)), w.counts)
            bufs.append(BLANKS[w.buf])
            stops = np.cumsum(STOPS[w.buf])[w.start] if len(w.start) else np.empty(0, np.int64)
            new = np.ones(len(row), np.int64)  # 1 where a word begins a piece
            new[1:] = (row[1:] != row[:-1]) | (stops[1:] != stops[:-1])
            for to, part in ((hashes, w.hash), (starts, w.start + base), (ends, w.end + base), (rows, row), (runs, new)):
                to.append(part)
            base += len(w.buf)
        join = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
        self.buf, h, self.start, self.end = join(bufs, np.uint8), join(hashes, np.uint64), join(starts, np.int64), join(ends, np.int64)
        self.group = of_row[join(rows, np.int64)] if len(h) else np.empty(0, np.int64)
        run = np.cumsum(join(runs, np.int64))
        self.words = np.bincount(self.group, minlength=len(self.groups))
        seed = np.array([xxhash.xxh64_intdigest(g.encode()) for g in self.groups], np.uint64) * _GROUP
        keys, places = [], []
        for k in range(1, LONGEST + 1):
            at = np.flatnonzero(run[: len(run) - k + 1] == run[k - 1 :])
            keys.append(mix(gram_hashes(h, k)[at] + seed[self.group[at]]) if len(at) else np.empty(0, np.uint64))
            places.append(at * LONGEST + k - 1)
        place = np.concatenate(places)
        self.keys, first, self.counts = np.unique(np.concatenate(keys), return_index=True, return_counts=True)
        self.first, self.size = place[first] // LONGEST, place[first] % LONGEST + 1

    def cells(self, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each row of the sketch: the chunk's distinct cells in order, and the number of each phrase's cell among them."""
        for r in range(ROWS):
            h = self.keys if r == 0 else mix(self.keys * _ROW + np.uint64(r))
            cell = (h >> np.uint64(32)) * np.uint64(width)
            low = (h & np.uint64(0xFFFFFFFF)) * np.uint64(width) >> np.uint64(32)
            yield np.unique((cell + low) >> np.uint64(32), return_inverse=True)

    def strings(self, which: np.ndarray) -> pa.Array:
        """The words of phrases, joined by single blanks."""
        begin, last = self.start[self.first[which]], self.first[which] + self.size[which] - 1
        span = self.end[last] - begin
        total = np.r_[0, np.cumsum(self.end - self.start)]
        plain = span == total[last + 1] - total[self.first[which]] + self.size[which] - 1  # one blank between words
        offsets = np.r_[0, np.cumsum(span)]
        data = self.buf[np.repeat(begin - offsets[:-1], span) + np.arange(offsets[-1])]
        out = pa.Array.from_buffers(pa.large_string(), len(which), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.string())
        odd = np.flatnonzero(~plain)
        if len(odd):
            mended = [" ".join(x.split(" ")) if "  " not in x else " ".join(y for y in x.split(" ") if y) for x in out.take(pa.array(odd)).to_pylist()]
            out = pa.compute.replace_with_mask(out, pa.array(~plain), pa.array(mended, pa.string()))
        return out


def _pack(cells: np.ndarray) -> bytes:
    """Rising numbers below 2**32 as their differences, byte by byte, compressed."""
    d = np.diff(cells, prepend=np.uint64(0)).astype("<u4")
    return pa.compress(d.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, n * 4, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.cumsum(planes.T.copy().view("<u4").ravel(), dtype=np.int64)


def frequent_phrases(docs: DataFrame, least: int = 30, group_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, phrase, k, a): phrases of k = 1 to 4 words that occur `least` or more times in their group, with their count a; and
    one row with phrase null and k 0 for each group with words, a being how many.

    A-Z are lower-cased; pieces end at `[.,;:!?\\x0A-\\x0D]`, words are `[^\\x20\\x09]+` in pieces, and a phrase is words in a row in one
    piece, joined by single blanks. A null group is `und`, a null text is empty. Repeated rows count as often as they stand. An
    empty table gives no row. A very long text makes a chunk of its own. Two phrases of a chunk with one 64-bit hash would count as one.
    """
    rows = docs.select(F.coalesce(F.col(f"`{group_col}`").cast("string"), F.lit("und")).alias("g"), F.col(f"`{text_col}`").cast("string").alias("t"))
    manifest = write_chunks(rows, "phrases", CHUNK_BYTES)
    segments = max(1, -(-total_bytes(manifest) // BYTES_A_CELL // SEGMENT))
    width, buckets = segments * SEGMENT, segments * ROWS

    def sketch(uri: str) -> Iterator[pa.RecordBatch]:
        found = Phrases(read_chunk(uri), "g", "t")
        for r, (cells, of) in enumerate(found.cells(width)):
            counts = np.minimum(np.bincount(of, found.counts, len(cells)), least).astype(np.uint16)
            ends = np.searchsorted(cells, np.arange(segments + 1, dtype=np.uint64) * np.uint64(SEGMENT))
            for s in np.flatnonzero(np.diff(ends)):
                part = slice(ends[s], ends[s + 1])
                yield pa.RecordBatch.from_pydict({"chunk": [uri], "bucket": pa.array([r * segments + int(s)], pa.int32()), "n": pa.array([int(ends[s + 1] - ends[s])], pa.int64()), "cells": [_pack(cells[part] - np.uint64(int(s) * SEGMENT))], "counts": [pa.compress(counts[part].tobytes(), codec="zstd", asbytes=True)]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of a segment's cells over all chunks, then for each chunk which of its cells reach the least count."""
        for b, found in groups(batches, "bucket"):
            total = np.zeros(SEGMENT, np.int64)
            for x in found:
                total[_unpack(x["cells"], x["n"])] += np.frombuffer(pa.decompress(x["counts"], x["n"] * 2, codec="zstd", asbytes=True), np.uint16)
            large = total >= least
            for x in found:
                yield pa.RecordBatch.from_pydict({"chunk": [x["chunk"]], "bucket": pa.array([b], pa.int32()), "large": [pa.compress(np.packbits(large[_unpack(x["cells"], x["n"])]).tobytes(), codec="zstd", asbytes=True)]})

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri, answers in groups(batches, "chunk"):
            found = Phrases(read_chunk(uri), "g", "t")
            large = {x["bucket"]: x["large"] for x in answers}
            alive = np.ones(len(found.keys), bool)
            for r, (cells, of) in enumerate(found.cells(width)):
                ends = np.searchsorted(cells, np.arange(segments + 1, dtype=np.uint64) * np.uint64(SEGMENT))
                bits = np.zeros(len(cells), bool)
                for s in np.flatnonzero(np.diff(ends)):
                    n = int(ends[s + 1] - ends[s])
                    bits[ends[s] : ends[s + 1]] = np.unpackbits(np.frombuffer(pa.decompress(large[r * segments + int(s)], -(-n // 8), codec="zstd", asbytes=True), np.uint8), count=n)
                alive &= bits[of]
            which = np.flatnonzero(alive)
            names = pa.array(found.groups, pa.string())
            yield _batch(names.take(pa.array(np.arange(len(found.groups)))), pa.array([None] * len(found.groups), pa.string()), np.zeros(len(found.groups)), found.words)
            for at in range(0, len(which), 50_000):
                w = which[at : at + 50_000]
                yield _batch(names.take(pa.array(found.group[found.first[w]])), found.strings(w), found.size[w], found.counts[w])

    def _batch(lang: pa.Array, phrase: pa.Array, k: np.ndarray, a: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([lang, phrase, pa.array(k.astype(np.int32)), pa.array(a.astype(np.int64))], ["lang", "phrase", "k", "a"])

    sketches = map_chunks(manifest, sketch, "chunk string, bucket int, n long, cells binary, counts binary")
    answers = materialize(sketches.repartitionById(buckets, F.pmod("bucket", F.lit(buckets))).sortWithinPartitions("bucket").mapInArrow(merge, "chunk string, bucket int, large binary"), "phrases-cells")
    chunks = manifest.count()
    # several chunks a task, so that a phrase's counts are summed over them before they are shuffled
    tasks = max(1, min(chunks, 2 * docs.sparkSession.sparkContext.defaultParallelism), min(100_000, -(-chunks // TOGETHER)))
    counted = answers.repartitionByRange(tasks, "chunk").sortWithinPartitions("chunk").mapInArrow(survivors, "lang string, phrase string, k int, a long")
    return counted.groupBy("lang", "phrase", "k").agg(F.sum("a").alias("a")).filter((F.col("a") >= least) & (F.col("k") > 0) | (F.col("k") == 0) & (F.col("a") > 0))


def collocations(frequent: DataFrame, most: int = 2000, cover: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of what frequent_phrases gives: each group's first `most` phrases of two words or more.

    A phrase is scored by its weakest cut, floor(2,000,000 a / (l + r)), l and r being the counts of what is before and after it; of
    equal cuts the first counts. It is dropped if a longer frequent phrase, itself dropped or not, holds its words in a row in at least `cover` per cent
    as many places. Order: score, then count, both falling, then the phrase in byte order. All arithmetic is exact.
    """
    frequent = materialize(frequent, "phrases-frequent")
    found = frequent.filter("k > 0").select("lang", "phrase", "a")
    many = frequent.filter("k > 1").select("lang", "phrase", "k", "a", F.split("phrase", " ").alias("w"))
    part = lambda at, n: F.array_join(F.slice("w", at, n), " ")
    cuts = many.select("lang", "phrase", "k", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"]).join(found.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    score = F.expr("cast(a as decimal(19,0)) * 2000000BD div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("x"))
    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("k") - n + 1), lambda at: part(at, n)))))
    covers = many.filter("k > 2").select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    kept = scored.join(covers, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (exact("longer") * 100 < exact("a") * cover))
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("x.score"), F.desc("a"), "phrase")).cast("long")).filter(F.col("rank") <= most)
    words = frequent.filter("k = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "x.l", "x.r", "n", "x.score")
