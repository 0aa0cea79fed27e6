"""Substring dedup: relative Lempel-Ziv parsing of documents against an index of all documents before them.

The reference text is every document of a smaller id. Its index holds each window of `window` words with its source, the
smallest id that has it, and its place there, and is cut by hash into reference blocks; each document is looked up in every
block. A document is then factored from left to right: a factor opens at the first window with a source, and goes on as long as
windows in a row have that source at places in a row; the words in between are literals. So a factor's words stand in its source,
from its place on. Windows that straddle the end of a factor have been looked up
like all others, so that the boundaries are checked, and factors that overlap or touch become one span: the spans are
exactly the words in windows that start in an earlier document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from skein.llm.chunks import arrow_map, groups, map_chunks, read_chunk, total_bytes, write_chunks
from skein.llm.words import all_words, gram_hashes, gram_mask, pieces, scan, shard
from skein.storage import materialize, shuffle_partitions

NONE = np.iinfo(np.int64).max
BLOCK_BYTES = 32 << 20
FAR = np.int32(np.iinfo(np.int32).max)


def _windows(uri: str, window: int):
    """A chunk in ascending id: table, ids, windows of each row, hashes of all windows in that order."""
    table = read_chunk(uri)
    ids = np.array([NONE if x is None else x for x in table.column("k").to_pylist()], np.int64)
    order = np.argsort(ids, kind="stable")
    table = table.take(pa.array(order)).combine_chunks()
    h, counts = all_words(table.column("t"))
    return table, ids[order], np.maximum(counts - (window - 1), 0), gram_hashes(h, window)[gram_mask(counts, window)]


def _places(counts: np.ndarray) -> np.ndarray:
    """Place in its document of each window."""
    return (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.int32)


def _first(H: np.ndarray):
    """Equal windows of a chunk: their order, where each group begins in it, and which places are the first of a group."""
    by = np.argsort(H, kind="stable")
    s = H[by]
    starts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(H) else np.empty(0, np.int64)
    first = np.zeros(len(H), bool)
    first[by[starts]] = True
    return by, starts, first


def factors(covered: np.ndarray, source: np.ndarray, place: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """(start, end, source, place) of a document's factors, in words; for each window: whether the index has it, in which document, and where there."""
    at = np.flatnonzero(covered)
    if not len(at):
        return []
    own, there = source[at], place[at]
    cut = np.flatnonzero((np.diff(at) > 1) | (own[1:] != own[:-1]) | (np.diff(there) != 1))
    first, last = np.r_[0, cut + 1], np.r_[cut, len(at) - 1]
    return [(int(a), int(z) + window, int(s), int(p)) for a, z, s, p in zip(at[first], at[last], own[first], there[first], strict=True)]


def spans_of(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """The words of factors as spans (start, end) that neither overlap nor touch."""
    out: list[tuple[int, int]] = []
    for a, z, *_ in found:
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(z, out[-1][1])
        else:
            out.append((a, z))
    return out


def relative_lz_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, carry: list[str] | None = None, locate: bool = True) -> DataFrame:
    """Per row: the carried columns (default: the id), n_words, n_removed, factors (word ranges, half open, the id of their source and their first word's place in it) and kept_text.

    A null text has no words. A null id counts as larger than every id; equal ids are not earlier than one another, so
    rows repeated under one id keep their text. Very short texts have no window. kept_text joins the kept words by one
    space, or is the unchanged text where nothing goes (null stays null). Other columns take no part; a carried text column becomes
    kept_text, and result columns whose name is carried get an underscore. docs is read once; an empty table gives
    an empty one, and a very long text is a chunk of its own. Ids are whole numbers of up to 64 bits; others are a TypeError.
    locate=False is for who wants the kept text alone: places are not carried along, and factors are null.
    """
    carry = carry or [id_col]
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be a whole number")
    spark = docs.sparkSession
    names = {c: f"c{i}" for i, c in enumerate(carry)}  # in the chunks, so that no name clashes
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("k"), F.col(f"`{text_col}`").cast("string").alias("t"), *(F.col(f"`{c}`").alias(n) for c, n in names.items() if c != text_col))
    manifest = write_chunks(rows, "rlz")
    # 8 bytes a word make 1.5 times the text; a task has as many blocks as any other, some 100 MB in all
    blocks = max(shuffle_partitions(spark), total_bytes(manifest) * 2 // BLOCK_BYTES)
    tasks = max(shuffle_partitions(spark), -(-blocks // 4))
    blocks = tasks * -(-blocks // tasks)

    def look_up(uri: str) -> Iterator[pa.RecordBatch]:
        _, ids, counts, H = _windows(uri, window)
        first = _first(H)[2]
        h, d = H[first], np.repeat(np.arange(len(ids)), counts)[first]
        p = _places(counts)[first]
        b = shard(h, blocks)
        by = np.argsort(b, kind="stable")
        ends = np.searchsorted(b[by], np.arange(blocks + 1))
        for k in np.flatnonzero(np.diff(ends)):
            part = by[ends[k] : ends[k + 1]]
            own, inverse = np.unique(d[part], return_inverse=True)  # ascending, as part is
            packed = zlib.compress(np.packbits(np.diff(inverse, prepend=0).astype(bool)).tobytes(), 1)  # a bit where the next document begins
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((uri, pa.string()), (int(k), pa.int32()), (h[part].tobytes(), pa.binary()), (packed, pa.binary()), (zlib.compress(np.diff(ids[own], prepend=0).tobytes(), 1), pa.binary()), (zlib.compress(np.diff(p[part], prepend=0).astype(np.int32).tobytes(), 1) if locate else None, pa.binary()))], ["chunk", "block", "hashes", "next", "ids", "places"])

    def in_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, found in groups(batches, "block"):
            h = [np.frombuffer(r["hashes"], np.uint64) for r in found]
            d = []
            for r in found:
                ids = np.cumsum(np.frombuffer(zlib.decompress(r["ids"]), np.int64))
                d.append(ids[np.cumsum(np.unpackbits(np.frombuffer(zlib.decompress(r["next"]), np.uint8), count=len(r["hashes"]) // 8), dtype=np.int64)])
            H, D = np.concatenate(h), np.concatenate(d)
            P = np.concatenate([np.cumsum(np.frombuffer(zlib.decompress(r["places"]), np.int32), dtype=np.int32) for r in found]) if locate else None
            by = np.argsort(H, kind="stable")
            starts = np.flatnonzero(np.r_[True, H[by][1:] != H[by][:-1]])
            least = np.minimum.reduceat(D[by], starts)
            size = np.diff(np.r_[starts, len(H)])
            source, place = np.empty(len(H), np.int64), np.empty(len(H), np.int32)
            source[by] = np.repeat(least, size)
            if locate:
                place[by] = np.repeat(np.minimum.reduceat(np.where(D == source, P, FAR)[by], starts), size)
            hit = D > source
            ends = np.cumsum([0, *map(len, h)])
            cuts = list(zip(ends, ends[1:], strict=False))
            yield pa.RecordBatch.from_pydict({"chunk": [r["chunk"] for r in found], "block": pa.array([k] * len(found), pa.int32()), "hits": [np.packbits(hit[a:b]).tobytes() for a, b in cuts], "sources": [zlib.compress(source[a:b][hit[a:b]].tobytes(), 1) for a, b in cuts], "places": pa.array([zlib.compress(np.diff(place[a:b][hit[a:b]], prepend=np.int32(0)).tobytes(), 1) if locate else None for a, b in cuts], pa.binary())})

    looked = map_chunks(manifest, look_up, "chunk string, block int, hashes binary, next binary, ids binary, places binary")
    hits = materialize(arrow_map(looked.repartitionById(tasks, F.pmod("block", F.lit(tasks))).sortWithinPartitions("block"), in_block, "chunk string, block int, hits binary, sources binary, places binary"), "rlz-hits")

    kinds = {f.name: f.dataType for f in docs.schema.fields}
    schema = ", ".join([*(f"{n} {kinds[c].simpleString()}" for c, n in names.items() if c != text_col), "n_words long, n_removed long, factors array<struct<start: int, end: int, source: bigint, place: int>>, kept_text string"])
    kept = [n for c, n in names.items() if c != text_col]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("source", pa.int64()), ("place", pa.int32())]))
        for uri, found in groups(batches, "chunk"):
            table, ids, counts, H = _windows(uri, window)
            by, starts, first = _first(H)
            b = shard(H[first], blocks)
            order = np.argsort(b, kind="stable")
            ends = np.searchsorted(b[order], np.arange(blocks + 1))
            hit, of, at = np.zeros(len(b), bool), np.zeros(len(b), np.int64), np.zeros(len(b), np.int32)
            for r in found:
                if r["hits"] is not None:
                    part = order[ends[r["block"]] : ends[r["block"] + 1]]
                    part = part[np.unpackbits(np.frombuffer(r["hits"], np.uint8), count=len(part)).astype(bool)]
                    hit[part] = True
                    of[part] = np.frombuffer(zlib.decompress(r["sources"]), np.int64)
                    if locate:
                        at[part] = np.cumsum(np.frombuffer(zlib.decompress(r["places"]), np.int32), dtype=np.int32)
            covered, source, there = np.empty(len(H), bool), np.empty(len(H), np.int64), np.empty(len(H), np.int32)
            if len(H):
                owner = np.repeat(ids, counts)[by]
                size = np.diff(np.r_[starts, len(H)])
                one = np.cumsum(first)[by[starts]] - 1  # the first of each group of equal windows of the chunk
                covered[by] = np.repeat(hit[one], size) | (owner > np.repeat(owner[starts], size))
                source[by] = np.repeat(np.where(hit[one], of[one], owner[starts]), size)
                there[by] = np.repeat(np.where(hit[one], at[one], _places(counts)[by[starts]]), size)
            ends = np.r_[0, np.cumsum(counts)]
            out: dict[str, list] = {"n": [], "r": [], "s": [], "t": []}
            size, since = 0, 0

            def batch(upto: int) -> pa.RecordBatch:
                rows = table.slice(since, upto - since).select(kept).combine_chunks()
                cols = [c.combine_chunks() for c in rows.columns]
                return pa.RecordBatch.from_arrays([*cols, pa.array(out["n"], pa.int64()), pa.array(out["r"], pa.int64()), pa.array(out["s"], factor_type), pa.array(out["t"], pa.string())], [*kept, "n_words", "n_removed", "factors", "kept_text"])

            for row, buf, offsets in pieces(table.column("t")):
                w = scan(buf, offsets)
                at = w.ends
                for k in range(len(w.counts)):
                    i = row + k
                    text = table.column("t")[i].as_py()
                    own = slice(ends[i], ends[i + 1])
                    parsed = factors(covered[own], source[own], there[own], window)
                    spans = spans_of(parsed)
                    if spans:
                        raw = text.encode()
                        zero = int(offsets[k] - offsets[0])
                        keep = np.ones(w.counts[k], bool)
                        for a, z in spans:
                            keep[a:z] = False
                        a, z = w.start[at[k] : at[k + 1]][keep] - zero, w.end[at[k] : at[k + 1]][keep] - zero
                        text = b" ".join(raw[x:y] for x, y in zip(a.tolist(), z.tolist(), strict=True)).decode()
                    out["n"].append(int(w.counts[k]))
                    out["r"].append(sum(z - a for a, z in spans))
                    out["s"].append([{"start": a, "end": z, "source": d, "place": p} for a, z, d, p in parsed] if locate else None)
                    out["t"].append(text)
                    size += len(text or "")
                    if size > 8 << 20:
                        yield batch(i + 1)
                        out, size, since = {x: [] for x in out}, 0, i + 1
            if out["n"]:
                yield batch(table.num_rows)

    every = manifest.select("chunk", F.lit(None).cast("int").alias("block"), F.lit(None).cast("binary").alias("hits"), F.lit(None).cast("binary").alias("sources"), F.lit(None).cast("binary").alias("places"))
    ready = hits.unionByName(every)  # a chunk without any window is parsed as well
    done = arrow_map(ready.repartitionByRange(max(1, min(100_000, max(manifest.count(), shuffle_partitions(spark)))), "chunk").sortWithinPartitions("chunk"), parse, schema)
    result = ["n_words", "n_removed", "factors", "kept_text"]
    free = {c: c + "_" * sum(x.rstrip("_") == c for x in carry) for c in result}
    return done.select(*((F.col("kept_text").alias(c) if c == text_col else F.col(names[c]).alias(c)) for c in carry), *(F.col(c).alias(f) for c, f in free.items()))
