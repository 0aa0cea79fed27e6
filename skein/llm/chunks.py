"""Immutable chunks of a table in the shared folder, so that later passes see the same rows in the same order.

A chunk is an Arrow stream file of whole rows, about CHUNK_BYTES long (one very long row makes a longer one). Files get a
new name in each task attempt; the manifest, written once, names the files of the attempts that counted.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.storage import make_dir, materialize, open_fs, scratch

CHUNK_BYTES = 8 << 20
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"

Batches = Iterator[pa.RecordBatch]


@lru_cache(maxsize=1)
def _libc() -> ctypes.CDLL | None:
    """The C library, told to hand blocks of 1 MB or more back as soon as they are free; None where it isn't glibc."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
    except (OSError, AttributeError):
        return None
    return libc


def give_back() -> None:
    """Return freed memory to the system, as Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if (libc := _libc()) is not None:
        libc.malloc_trim(0)


def arrow_map(df: DataFrame, f: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """df.mapInArrow in batches of at most BATCH_BYTES (or one longer row), unless the session sets a size of its own. Memory is given back after each task."""
    conf = df.sparkSession.conf
    if BATCH not in conf.getAll:
        conf.set(BATCH, BATCH_BYTES)

    def run(batches: Batches) -> Batches:
        give_back()
        yield from f(batches)
        give_back()

    return df.mapInArrow(run, schema)


def row_bytes(batch: pa.RecordBatch) -> int:
    """Bytes of a batch's values, however its rows are cut into batches: those of strings, and 8 for any other value."""
    total = 0
    for c in batch.columns:
        text = pa.types.is_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_string(c.type) or pa.types.is_large_binary(c.type)
        total += (pa.compute.sum(pa.compute.binary_length(c)).as_py() or 0) if text else 8 * len(c)
    return total


def write_chunks(df: DataFrame, name: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Manifest (chunk string, rows long, bytes long) of df's rows. An empty table gives an empty manifest."""
    root = make_dir(df.sparkSession, scratch(df.sparkSession, name))

    def dump(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            uri = f"{root}/{uuid.uuid4().hex}.arrow"
            fs, path = open_fs(uri)
            with fs.open_output_stream(path) as out, pa.ipc.new_stream(out, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                for b in held:
                    w.write_batch(b)
            return pa.RecordBatch.from_pydict({"chunk": [uri], "rows": [sum(b.num_rows for b in held)], "bytes": [sum(map(row_bytes, held))]})

        for batch in batches:
            step = max(1, int(batch.num_rows * min(1.0, chunk_bytes / 4 / max(batch.nbytes, 1))))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                held.append(part)
                size += part.nbytes
                if size >= chunk_bytes:
                    yield flush()
                    held, size = [], 0
        if size or held:
            yield flush()

    return materialize(arrow_map(df, dump, "chunk string, rows long, bytes long"), f"{name}-manifest")


def spread(manifest: DataFrame, most: int = 100_000) -> DataFrame:
    """The manifest with about one chunk a task."""
    return manifest.repartitionByRange(max(1, min(most, manifest.count())), "chunk")


def total_bytes(manifest: DataFrame) -> int:
    """Bytes of all rows by row_bytes; the same for the same rows, whatever the session's settings."""
    return manifest.agg(F.sum("bytes")).first()[0] or 0


def read_chunk(uri: str) -> pa.Table:
    fs, path = open_fs(uri)
    with fs.open_input_stream(path) as src, pa.ipc.open_stream(src) as r:
        return r.read_all()


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[dict]]]:
    """Rows of each key, from batches sorted by it; one group is held at a time."""
    last, rows = None, []
    for batch in batches:
        keys = batch.column(batch.schema.get_field_index(key))
        for i in range(batch.num_rows):
            k = keys[i].as_py()
            if rows and k != last:
                yield last, rows
                rows = []
            last = k
            rows.append({n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)})
    if rows:
        yield last, rows


def map_chunks(manifest: DataFrame, f: Callable[[str], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """f over each chunk of a spread manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column("chunk").to_pylist():
                yield from f(uri)
                give_back()

    return arrow_map(spread(manifest), run, schema)
