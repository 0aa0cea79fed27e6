"""SimHash near-dup: 64-bit fingerprints of word shingles, linked when few bits differ, compared bit-sliced.

Two fingerprints that differ in at most RADIUS bits agree in all bits of at least BLOCKS - RADIUS of BLOCKS bit blocks, so
each distinct fingerprint is dealt to one bucket for each choice of that many blocks (10 keys of about 26 bits for radius
3). A bucket above BUCKET fingerprints is cut into parts that meet two at a time, so no task holds an unbounded group.
Fingerprints lie as bit planes, a lane each, which are made once a bucket; distances to 64 lanes a word are counted by
carry-save bitwise counters, and a block of lanes is abandoned once all of them exceed the radius. In a large bucket a search
from one fingerprint to all it reaches yields a star of links for each group; small buckets lie side by side in common planes
and are compared with those shifted by 1, 2, ... lanes. Connected components over the links do the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.chunks import arrow_map
from skein.operators.graph import connected_components
from skein.storage import materialize

RADIUS, BLOCKS, BUCKET = 3, 5, 4096
#: Lanes of a block, which is abandoned as one; buckets of at most SMALL fingerprints are compared many at a time.
LANES, SMALL = 512, 24
ALL = ~np.uint64(0)
_HASH = xxhash.xxh64_intdigest


def fingerprint(text: str | None, width: int = 3) -> int:
    """Bits set in over half of the shingles' XXH64 (seed 42), shingles counted as often as they occur; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - width + 1)
    last = ends[-n:] if len(words) >= width else ends[-1:]
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = [_HASH(flat[a:z], 42) for a, z in zip(starts[at : min(n, at + (1 << 16))].tolist(), last[at : at + (1 << 16)].tolist(), strict=False)]
        ones += np.unpackbits(np.array(part, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def planes(fps: np.ndarray) -> np.ndarray:
    """64 bit planes of fingerprints, 64 lanes a word, words filled up to whole blocks of lanes."""
    bits = np.zeros((64, -(-len(fps) // LANES) * LANES), np.uint8)
    bits[:, : len(fps)] = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _packed(flags: np.ndarray, words: int) -> np.ndarray:
    bits = np.zeros(words * 64, np.uint8)
    bits[: len(flags)] = flags
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _lanes(words: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(words.view(np.uint8), bitorder="little")[:n].astype(bool)


class Distances:
    """Carry-save counters of many blocks of lanes, a row a block: planes of differing bits are added one after another."""

    def __init__(self, open_lanes: np.ndarray, radius: int):
        self.radius, self.over, self.rows = radius, ~open_lanes, np.arange(len(open_lanes))
        self.counter = [np.zeros_like(open_lanes) for _ in range(radius.bit_length())]

    def add(self, carry: np.ndarray) -> None:
        for c in self.counter:
            c ^= carry  # sum bit; what was set in both goes on
            carry &= ~c
        self.over |= carry

    def abandon(self) -> bool:
        """Give up blocks all of whose lanes exceed the radius; whether any is left. `rows` names those left."""
        alive = (self.over != ALL).any(axis=1)
        if not alive.all():
            self.rows, self.over, self.counter = self.rows[alive], self.over[alive], [c[alive] for c in self.counter]
        return len(self.rows) > 0

    def within(self) -> np.ndarray:
        """Lanes of the blocks left that are within the radius; counters are compared with it from the high bit down."""
        more, same = np.zeros_like(self.over), ~np.zeros_like(self.over)
        for i in reversed(range(len(self.counter))):
            r = ALL if self.radius >> i & 1 else np.uint64(0)
            more |= same & self.counter[i] & ~r
            same &= ~(self.counter[i] ^ r)
        return ~(self.over | more)


def near(lanes: np.ndarray, queries: np.ndarray, radius: int, open_lanes: np.ndarray) -> np.ndarray:
    """Open lanes, as packed bits, within radius of any of the queries; every query meets every block of lanes."""
    blocks = lanes.reshape(64, -1, LANES // 64)
    n = blocks.shape[1]
    found = np.zeros(blocks.shape[1:], np.uint64)
    masks = open_lanes.reshape(n, -1)
    width = max(1, (1 << 12) // n)
    for at in range(0, len(queries), width):
        q = queries[at : at + width]
        query, block = np.repeat(np.arange(len(q)), n), np.tile(np.arange(n), len(q))
        d = Distances(masks[block], radius)
        for bit in range(64):
            flip = np.uint64(0) - ((q >> np.uint64(bit)) & np.uint64(1))
            d.add(blocks[bit][block[d.rows]] ^ flip[query[d.rows], None])
            if bit % 8 == 7 and not d.abandon():
                break
        if len(d.rows):
            np.bitwise_or.at(found, block[d.rows], d.within())
    return found.ravel()


def stars(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(fingerprint, centre) for each group that links of at most radius bits connect inside one bucket.

    The bucket's planes are made once; a lane closes when its fingerprint is reached.
    """
    out, lanes, left = [], planes(fps), np.ones(len(fps), bool)
    for c in range(len(fps)):
        if left[c]:
            left[c] = False
            frontier = fps[c : c + 1]
            while len(frontier) and left.any():
                hit = _lanes(near(lanes, frontier, radius, _packed(left, lanes.shape[1])), len(fps))
                left &= ~hit
                frontier = fps[hit]
                out += [(int(f), int(fps[c])) for f in frontier]
    return out


def shifted_links(fps: np.ndarray, bucket: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (a, b) inside many small buckets that lie one after another: their planes, made once, are held against
    themselves shifted by 1, 2, ... lanes, so that one step counts the distance of each lane to its n-th successor."""
    lanes = planes(fps)
    after = np.concatenate([lanes[:, 1:], np.zeros((64, 1), np.uint64)], axis=1)
    for by in range(1, SMALL):
        same = bucket[:-by] == bucket[by:]
        if not same.any():
            return
        shifted = (lanes >> np.uint64(by)) | (after << np.uint64(64 - by))
        d = Distances(_packed(same, lanes.shape[1]).reshape(-1, LANES // 64), radius)
        if not d.abandon():
            continue
        blocks = (lanes ^ shifted).reshape(64, -1, LANES // 64)
        for bit in range(64):
            d.add(blocks[bit][d.rows])
            if bit % 8 == 7 and not d.abandon():
                break
        if len(d.rows):
            found = np.zeros((blocks.shape[1], LANES // 64), np.uint64)
            found[d.rows] = d.within()
            at = np.flatnonzero(_lanes(found.ravel(), len(fps)))
            yield fps[at], fps[at + by]


def _bucket_links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(src, dst) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.asarray(src, np.uint64).view(np.int64)), pa.array(np.asarray(dst, np.uint64).view(np.int64))], ["src", "dst"])

        for batch in batches:
            lists = batch.column("fps")
            values, offs = np.asarray(lists.flatten()).view(np.uint64), np.diff(np.asarray(lists.offsets))
            ends, owner = np.r_[0, np.cumsum(offs)], np.repeat(np.arange(len(offs)), offs)
            small = (offs <= SMALL)[owner]
            for at in range(0, int(small.sum()), 1 << 17):  # a bucket across two of these parts is met twice, by both parts
                part = slice(max(0, at - SMALL), at + (1 << 17))
                for a, b in shifted_links(values[small][part], owner[small][part], radius):
                    yield out(a, b)
            for x in np.flatnonzero(offs > SMALL):
                links = stars(values[ends[x] : ends[x + 1]], radius)
                if links:
                    yield out(*zip(*links, strict=True))

    return run


def _keys(radius: int, blocks: int) -> list[int]:
    """Masks of the bits kept in each table."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    part = [sum(1 << b for b in range(a, z)) for a, z in zip(cuts, cuts[1:], strict=False)]
    return [sum(part[i] for i in c) for c in combinations(range(blocks), blocks - radius)]


def link_fingerprints(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """Links (src, dst) among distinct fingerprints (column fp, long) that connect just those within radius of each other."""
    signed = [m - (1 << 64) if m >> 63 else m for m in _keys(radius, blocks)]
    dealt = fps.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in signed))).alias("table", "key"))
    large = dealt.groupBy("table", "key").count().filter(F.col("count") > bucket).select("table", "key", F.ceil(F.col("count") / (bucket // 2)).cast("int").alias("n"))
    large = materialize(large, "simhash-large")  # at most 2 * tables * rows / bucket
    spread = dealt.join(large, ["table", "key"], "left")
    part = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    meets = F.when(F.col("n").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda x: F.struct(F.least(x, part).alias("i"), F.greatest(x, part).alias("j"))))
    grouped = spread.select("fp", "table", "key", F.explode(meets).alias("m")).groupBy("table", "key", "m.i", "m.j").agg(F.collect_list("fp").alias("fps"))
    return arrow_map(grouped.filter(F.size("fps") > 1).select("fps"), _bucket_links(radius), "src long, dst long")


def _prints(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """docs with columns c0, c1, ... in place of their names and fp, written to the shared folder."""
    at = docs.columns.index(text_col)
    fields = [(f"c{i}", f.dataType.simpleString()) for i, f in enumerate(docs.schema.fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(x.as_py()) for x in b.column(at).cast(pa.string())), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps.view(np.int64))], [*(n for n, _ in fields), "fp"])

    mapped = arrow_map(docs.toDF(*(n for n, _ in fields)), run, ", ".join([*(f"{n} {t}" for n, t in fields), "fp long"]))
    return materialize(mapped.withColumn("row", F.monotonically_increasing_id()), name)


def _components(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, least): for each fingerprint of prints(k, fp) the least k (nulls last) of its component."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("k").alias("own")), "simhash-distinct")
    components = connected_components(link_fingerprints(distinct.select("fp"), radius))
    named = distinct.join(components.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "own", F.coalesce("component", "fp").alias("c"))
    return named.join(named.groupBy("c").agg(F.min("own").alias("least")), "c").select("fp", "least")


def simhash_near_dups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(id_col, fp long, fingerprint as 16 hex digits, component_id) of each row.

    component_id is the smallest id reachable over links of at most radius differing bits, the row's own included. A null
    or wordless text has fingerprint zero and is linked like any other; texts of one or two words have one shingle. Equal
    rows are linked with one another; null ids are never a component's id unless the component has no other (then null).
    Rows of a hot fingerprint are folded by min() before any shuffle; they meet its component in a join that AQE may split.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{text_col}`").cast("string").alias("t"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(x.as_py()) for x in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["k", "fp"])

    prints = materialize(arrow_map(rows, run, f"k {kind}, fp long"), "simhash")
    ids = _components(prints, radius)
    return prints.join(ids, "fp").select(F.col("k").alias(id_col), "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("least").alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """docs without near-duplicates: of each component the row of the smallest id stays, rows without an id coming last.

    Every row is a document of its own, whatever its id: of unlike texts under one id all stay, of equal rows one. docs is
    written once with a number for each row, by which rows are told apart.
    """
    prints = _prints(docs, text_col, "simhash-rows")
    k = F.col(f"c{docs.columns.index(id_col)}")
    rank = F.struct(k.isNull().alias("no_id"), k.alias("id"), F.col("row"))
    chosen = _components(prints.select(rank.alias("k"), "fp"), radius).select(F.col("least.row").alias("chosen")).distinct()
    return prints.join(chosen, F.col("row") == F.col("chosen"), "left_semi").drop("fp", "row").toDF(*docs.columns)
