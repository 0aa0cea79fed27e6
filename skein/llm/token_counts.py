"""Token counts: a separator scan over flat token files.

A flat file is nothing but unsigned 16- or 32-bit little-endian token ids, documents one after another, each closed by an
end-of-document id, without an index. Files are read in blocks of fixed size, all in parallel; a vectorised search finds
the separators of a block. A prefix scan over block summaries (how many separators, where the last one is) then tells each
block how many documents closed before it and where its first document began.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.bpe import encoder
from skein.llm.chunks import arrow_map
from skein.storage import make_dir, materialize, open_fs, scratch

SEPARATOR, BLOCK_BYTES, FILE_BYTES, GROUP = 50_256, 4 << 20, 256 << 20, 1024


def write_token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 2, separator: int = SEPARATOR, file_bytes: int = FILE_BYTES, path: str | None = None) -> DataFrame:
    """Encode texts into flat files in the shared folder; (file, ordinal, id_col) says which document is where.

    A null text is a document without tokens. Ids that don't fit, or that are the separator, are an error. A file's name is new in each attempt; only files named here count.
    """
    root = make_dir(docs.sparkSession, scratch(docs.sparkSession, "tokens"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = encoder(path), np.array([separator], f"<u{width}").tobytes()
        out = uri = None
        size = ordinal = 0
        for b in batches:
            files, ordinals = [], []
            for x in b.column(1):
                if out is None or size >= file_bytes:
                    if out is not None:
                        out.close()
                    uri, size, ordinal = f"{root}/{uuid.uuid4().hex}.tokens", 0, 0
                    fs, at = open_fs(uri)
                    out = fs.open_output_stream(at, buffer_size=1 << 20)
                tokens = np.frombuffer(bpe.packed(x.as_py() or ""), "<u4")
                if len(tokens) and (int(tokens.max()) >> 8 * width or (tokens == separator).any()):
                    raise ValueError(f"a token is the separator {separator} or needs more than {width} bytes")
                ids = tokens.astype(f"<u{width}").tobytes()
                out.write(ids + end)
                files.append(uri)
                ordinals.append(ordinal)
                size += len(ids) + width
                ordinal += 1
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(ordinals, pa.int64()), b.column(0)], ["file", "ordinal", "k"])
        if out is not None:
            out.close()

    rows = arrow_map(docs.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{text_col}`").cast("string").alias("t")), run, f"file string, ordinal long, k {kind}")
    return materialize(rows, "token-manifest").withColumnRenamed("k", id_col)


def _prefix_scan(blocks: DataFrame) -> DataFrame:
    """blocks(file, block, n, last) with `before`, separators in earlier blocks, and `open`, the place after the last of them.

    In two levels: totals of groups of blocks are scanned first, then blocks inside their group, so that a file of any
    length puts at most a GROUP-th of its blocks into one task.
    """
    blocks = blocks.withColumn("group", F.floor(F.col("block") / GROUP))
    sums = blocks.groupBy("file", "group").agg(F.sum("n").alias("gn"), F.max("last").alias("glast"))
    past = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = sums.select("file", "group", F.coalesce(F.sum("gn").over(past), F.lit(0)).alias("g_before"), F.max("glast").over(past).alias("g_open"))
    inside = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = blocks.select("*", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("b_before"), F.max("last").over(inside).alias("b_open"))
    return own.join(groups, ["file", "group"]).select("file", "block", "seps", "tail", (F.col("g_before") + F.col("b_before")).alias("before"), (F.coalesce("b_open", "g_open", F.lit(-1)) + 1).alias("open"))


def scan_token_files(spark: SparkSession, files: DataFrame, width: int = 2, separator: int = SEPARATOR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed) of every document in flat files; files has a column `file` of their URIs.

    start is the document's first token in its file, n_tokens does not count the separator. Tokens after the last separator
    make a last document that is not closed; an empty file has none. Bytes beyond a whole token at the end are an error.
    """
    block_bytes -= block_bytes % width

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column("file").to_pylist():
                fs, at = open_fs(uri)
                size = fs.get_file_info(at).size
                if size % width:
                    raise ValueError(f"{uri} has {size} bytes, not a multiple of {width}")
                n = -(-size // block_bytes)
                for k in range(0, n, 10_000):
                    ks = np.arange(k, min(n, k + 10_000))
                    yield pa.RecordBatch.from_pydict({"file": [uri] * len(ks), "block": pa.array(ks, pa.int64()), "bytes": pa.array(np.minimum(block_bytes, size - ks * block_bytes), pa.int64())})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, k, size in zip(*(b.column(c).to_pylist() for c in ("file", "block", "bytes")), strict=True):
                fs, at = open_fs(uri)
                with fs.open_input_file(at) as f:
                    tokens = np.frombuffer(f.read_at(size, k * block_bytes), f"<u{width}")
                seps = np.flatnonzero(tokens == separator) + k * (block_bytes // width)
                last = int(seps[-1]) if len(seps) else None
                end = k * (block_bytes // width) + len(tokens)
                yield pa.RecordBatch.from_pydict({"file": [uri], "block": pa.array([k], pa.int64()), "n": pa.array([len(seps)], pa.int64()), "last": pa.array([last], pa.int64()), "tail": pa.array([end if last != end - 1 else None], pa.int64()), "seps": pa.array([seps], pa.list_(pa.int64()))})

    cuts = materialize(files.select("file").distinct().mapInArrow(cut, "file string, block long, bytes long"), "token-blocks")
    n = max(1, min(100_000, cuts.count()))
    found = materialize(cuts.repartitionByRange(n, "file", "block").mapInArrow(search, "file string, block long, n long, last long, tail long, seps array<long>"), "token-separators")
    stitched = _prefix_scan(found)
    docs = stitched.select("file", "before", "open", F.posexplode("seps").alias("i", "sep"), "seps")
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.get("seps", F.col("i") - 1) + 1)
    closed = docs.select("file", (F.col("before") + F.col("i")).alias("ordinal"), start.alias("start"), (F.col("sep") - start).alias("n_tokens"), F.lit(True).alias("closed"))
    totals = found.groupBy("file").agg(F.sum("n").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"), F.max_by("tail", "block").alias("tail"))
    rest = totals.filter("tail is not null and tail > start").select("file", "ordinal", "start", (F.col("tail") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.union(rest)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 2) -> DataFrame:
    """(id_col, n_tokens, file_start) of each row, by writing flat token files and scanning them; file_start is the document's first token in its file.

    Null and empty texts have 0 tokens; repeated rows each have a row; null ids stay null; other columns take no part.
    """
    manifest = write_token_files(docs, id_col, text_col, width)
    counted = scan_token_files(docs.sparkSession, manifest.select("file"), width)
    return manifest.join(counted, ["file", "ordinal"]).select(id_col, "n_tokens", F.col("start").alias("file_start"))
