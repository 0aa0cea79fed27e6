"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Documents fall into size partitions by their number of distinct shingles, u; items into classes by theirs, q. A MinHash
signature has one hash and many bins (one-permutation MinHash): the least hash of each bin. For each partition and class
the number of bins is the least power of two at which an item with a share of THRESHOLD of its shingles in a document has
a common signature entry with it but for MISS of the cases, however long the document. Any common entry makes a candidate.
The items lie in the shared folder in blocks of bounded size, and each block is met by one pass over the documents, whose
tasks load it themselves: the driver knows the names of blocks only, and no document is shuffled.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.chunks import arrow_map, read_chunk, write_chunks
from skein.llm.words import LOWER, PUNCT, all_words, gram_hashes, gram_mask
from skein.storage import materialize

WIDTH, THRESHOLD, MISS = 5, 0.8, 1e-7
BLOCK_BYTES = 16 << 20


def extra_bits(q: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """log2(bins / u): with bins = u * 2**s, a common shingle is its bin's least in the document with chance (1 - exp(-c)) / c, c = 2**-s."""
    need = max(1, math.ceil(threshold * q - 1e-9))
    return next(s for s in range(64) if (1 - (1 - math.exp(-(2.0**-s))) * 2.0**s) ** need <= miss)


def signature(u: np.ndarray, bits: int) -> np.ndarray:
    """Least hash of each of 2**bits bins; u: ascending distinct hashes."""
    if bits >= 64 or not len(u):
        return u
    b = u >> np.uint64(64 - bits) if bits else np.zeros(len(u), np.uint64)
    return u[np.r_[True, b[1:] != b[:-1]]]


def shingle_sets(texts: pa.Array | pa.ChunkedArray, width: int, short: bool) -> list[np.ndarray]:
    """Ascending distinct shingle hashes of each text; short: texts of fewer words have one shingle of all of them."""
    h, counts = all_words(texts, PUNCT, LOWER)
    grams = gram_hashes(h, width)[gram_mask(counts, width)]
    ends, word_ends = np.r_[0, np.cumsum(np.maximum(counts - (width - 1), 0))], np.r_[0, np.cumsum(counts)]
    out = []
    for a, z in zip(ends, ends[1:], strict=False):
        u = np.sort(grams[a:z])
        out.append(u[np.r_[True, u[1:] != u[:-1]]] if len(u) else u)
    if short:
        for i in np.flatnonzero((counts > 0) & (counts < width)):
            out[i] = gram_hashes(h[word_ends[i] : word_ends[i + 1]], int(counts[i]))
    return out


class ItemIndex:
    """Items of one block by shingle width, and their signatures, made when a document's size first needs them."""

    def __init__(self, items: list[tuple[object, str, int, np.ndarray]], threshold: float, kind: pa.DataType | None = None):
        self.items, self.threshold, self.kind = items, threshold, kind
        self.classes: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for i, (_, _, width, u) in enumerate(items):
            if len(u):
                self.classes[width][extra_bits(len(u), threshold)].append(i)
        self.made: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]] = {}

    def candidates(self, width: int, u: np.ndarray) -> set[int]:
        out: set[int] = set()
        part = max(1, len(u)).bit_length()
        for s, members in self.classes[width].items():
            bits = min(64, part + s)
            if (width, s, bits) not in self.made:
                sigs = [signature(self.items[i][3], bits) for i in members]
                values, owner = np.concatenate(sigs), np.repeat(members, [len(x) for x in sigs])
                by = np.argsort(values, kind="stable")
                self.made[width, s, bits] = values[by], owner[by]
            values, owner = self.made[width, s, bits]
            sig = signature(u, bits)
            a = np.searchsorted(values, sig)
            hit = np.flatnonzero((a < len(values)) & (values[np.minimum(a, len(values) - 1)] == sig))
            for k in hit:
                out.update(owner[a[k] : np.searchsorted(values, sig[k], "right")].tolist())
        return out


def _item_blocks(items: DataFrame, item_col: str, item_text: str, block_bytes: int, min_words: int) -> list[str]:
    """Names of files of items of at least min_words words; a file has about half of block_bytes of text."""
    source = items.select(F.col(f"`{item_col}`").alias("i"), F.col(f"`{item_text}`").cast("string").alias("t")).filter("t is not null")
    size = source.agg(F.sum(F.octet_length("t"))).first()[0] or 0

    def long_enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(all_words(b.column(1), PUNCT, LOWER)[1] >= min_words))

    n = max(1, -(-size * 2 // block_bytes))  # hashes make about the size of the text again
    kept = arrow_map(source.repartition(n), long_enough, f"i {source.schema['i'].dataType.simpleString()}, t string")
    return sorted(r["chunk"] for r in write_chunks(kept, "items", max(1, block_bytes // 2)).select("chunk").collect())


@lru_cache(maxsize=1)
def _index(uri: str, threshold: float, width: int) -> ItemIndex:
    """A block's index, one a Python worker."""
    table = read_chunk(uri).combine_chunks()
    counts = all_words(table.column("t"), PUNCT, LOWER)[1]
    rows = zip(table.column("i").to_pylist(), table.column("t").to_pylist(), np.clip(counts, 1, width).tolist(), shingle_sets(table.column("t"), width, True), strict=True)
    return ItemIndex(list(rows), threshold, table.schema.field("i").type)


def _hits(index: ItemIndex, texts: pa.Array, threshold: float) -> Iterator[tuple]:
    """(row, item, shingles of the item, shared ones, containment) of all items in texts."""
    for w in index.classes:
        for r, u in enumerate(shingle_sets(texts, w, False)):
            found = sorted(index.candidates(w, u)) if len(u) else []
            if found:
                text = shingles(texts[r].as_py(), w)
                for i in found:
                    own = shingles(index.items[i][1], w)
                    n = len(own & text)
                    if n >= threshold * len(own) - 1e-9:
                        yield r, index.items[i][0], len(own), n, n / len(own)


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, width: int = WIDTH, block_bytes: int = BLOCK_BYTES, min_words: int = 1) -> DataFrame:
    """(id_col, item_col, n_item, n_shared, containment): pairs with at least `threshold` of an item's shingles in a document.

    Shingles are sets of `width` words; words are runs of ASCII letters and digits and of other characters, A-Z lower-cased.
    An item of fewer words has one shingle of all its words, looked for anywhere, so one of a single common word is found in
    most documents; items below min_words, without words or null are nowhere. A null text has no shingles. Rows repeated on
    either side give their pairs again; null ids stay null; other columns take no part. Containment is counted on the words
    themselves, for each candidate. Documents are read once a block of items.
    """
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{text_col}`").cast("string").alias("t"))
    schema = f"k {kind}, i {item_kind}, n_item long, n_shared long, containment double"

    def search(uri: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(uri, threshold, width)
            for big in batches:
                for at in range(0, big.num_rows, 256):
                    b = big.slice(at, 256)
                    out = list(_hits(index, b.column(1), threshold))
                    if out:
                        r, i, *rest = zip(*out, strict=True)
                        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(r)), pa.array(i, index.kind), *map(pa.array, rest)], ["k", "i", "n_item", "n_shared", "containment"])

        return run

    blocks = _item_blocks(items, item_col, item_text, block_bytes, min_words)
    found = [arrow_map(rows, search(uri), schema) for uri in blocks] or [docs.sparkSession.createDataFrame([], schema)]
    return reduce(DataFrame.union, found).toDF(id_col, item_col, "n_item", "n_shared", "containment")


def without_items(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, width: int = WIDTH, block_bytes: int = BLOCK_BYTES, min_words: int = WIDTH) -> DataFrame:
    """The rows of docs that contain no item, by the rule of contained_items; items below min_words are looked for nowhere.

    Rows are judged one by one by their text, so null and repeated ids need no care, and all columns stay as they are. Each
    block of items takes one pass; between blocks the rows left are written to the shared folder.
    """
    names, at = docs.columns, docs.columns.index(text_col)
    fields = [(f"c{i}", f.dataType.simpleString()) for i, f in enumerate(docs.schema.fields)]
    left = docs.toDF(*(n for n, _ in fields))

    def keep(uri: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(uri, threshold, width)
            for big in batches:
                for k in range(0, big.num_rows, 256):
                    b = big.slice(k, 256)
                    clean = np.ones(b.num_rows, bool)
                    for hit in _hits(index, b.column(at).cast(pa.string()), threshold):
                        clean[hit[0]] = False
                    yield b.filter(pa.array(clean))

        return run

    for n, uri in enumerate(_item_blocks(items, item_col, item_text, block_bytes, min_words)):
        left = arrow_map(materialize(left, "uncontaminated") if n else left, keep(uri), ", ".join(f"{c} {t}" for c, t in fields))
    return left.toDF(*names)


_TABLE = bytes(0x20 if PUNCT[b] else LOWER[b] for b in range(256))


def shingles(text: str | None, width: int) -> set[bytes]:
    """Shingles as words joined by a space."""
    w = (text or "").encode().translate(_TABLE).split(b" ")
    w = [x for x in w if x]
    return {b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)}
