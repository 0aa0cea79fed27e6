"""Parallel scan of large JSON arrays: blocks of bytes, a prefix scan of string and depth state, items across block borders.

A file is cut into blocks of bytes, whatever stands at the cuts. Each block says how many quotes it has and how much deeper it
ends, once for a begin outside a string and once for one inside. A prefix sum over a file's blocks then gives each
block the state at its begin, so that borders of items are known everywhere at once. The task in whose block an item begins
reads on to the item's end. Files are UTF-8; a file that ends inside a string or a bracket is an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.storage import make_dir, materialize, open_fs

BLOCK = 16 << 20
_QUOTE, _BACKSLASH, _COMMA, _COLON = b'"\\,:'
_STEP = np.zeros(256, np.int8)
_STEP[[*b"[{"]] = 1
_STEP[[*b"]}"]] = -1
_SPACE = b" \t\n\r"


class _File:
    """Byte ranges of a file; the end of a range may lie behind the file's."""

    def __init__(self, uri: str):
        fs, path = open_fs(uri)
        self.file = fs.open_input_file(path)
        self.size = self.file.size()

    def read(self, at: int, to: int) -> bytes:
        to = min(to, self.size)
        return self.file.read_at(to - at, at) if to > at else b""

    def backslashes_before(self, at: int) -> int:
        """How many backslashes in a row end right before a place."""
        n, window = 0, 64
        while at - n > 0:
            part = self.read(max(0, at - n - window), at - n)
            run = len(part) - len(part.rstrip(b"\\"))
            n += run
            if run < len(part):
                break
            window *= 2
        return n


def _quotes(data: np.ndarray, before: int) -> np.ndarray:
    """Places of the quotes that begin or end a string; before: backslashes in a row before the data."""
    at = np.flatnonzero(data == _QUOTE)
    if not len(at):
        return at
    other = np.where(data != _BACKSLASH, np.arange(len(data)), -1)
    last = np.maximum.accumulate(other)  # the last place up to here that is no backslash
    prior = np.where(at > 0, last[at - 1], -1)
    run = np.where(prior >= 0, at - 1 - prior, at + before)
    return at[run % 2 == 0]


def _outside(data: np.ndarray, quotes: np.ndarray, inside: int) -> np.ndarray:
    """Whether each byte is outside strings; the quotes themselves count as inside."""
    toggles = np.zeros(len(data), np.int64)
    toggles[quotes] = 1
    count = np.cumsum(toggles) + inside
    out = count % 2 == 0
    out[quotes] = False
    return out


def _summary(f: _File, at: int, to: int) -> tuple[int, int, int]:
    """Parity of quotes, and change of depth for a begin outside and inside a string."""
    data = np.frombuffer(f.read(at, to), np.uint8)
    quotes = _quotes(data, f.backslashes_before(at))
    outside = _outside(data, quotes, 0)
    step = _STEP[data].astype(np.int64)
    step[quotes] = 0
    deeper = int(step[outside].sum())
    return len(quotes) % 2, deeper, int(step.sum()) - deeper


def _borders(f: _File, at: int, to: int, inside: int, depth: int):
    """(place, byte, depth after it) of commas and brackets outside strings, and the state after them."""
    data = np.frombuffer(f.read(at, to), np.uint8)
    quotes = _quotes(data, f.backslashes_before(at))
    outside = _outside(data, quotes, inside)
    step = np.where(outside, _STEP[data], 0).astype(np.int64)
    after = depth + np.cumsum(step)
    which = np.flatnonzero(outside & ((step != 0) | (data == _COMMA)))
    return which + at, data[which], after[which], (inside + len(quotes)) % 2, depth + int(step.sum())


def _key_before(f: _File, at: int) -> str | None:
    """The key of the value that begins at a place; None where there is none."""
    window = 256
    while True:
        part = f.read(max(0, at - window), at).rstrip(_SPACE)
        if part.endswith(b":"):
            part = part[:-1].rstrip(_SPACE)
            if part.endswith(b'"'):
                data = np.frombuffer(part, np.uint8)
                quotes = _quotes(data, f.backslashes_before(max(0, at - window)))
                if len(quotes) >= 2:
                    import json

                    return json.loads(part[quotes[-2] :])
        elif part and (len(part) > 1 or window >= at):
            return None
        if window >= at:
            return None
        window *= 4


def _blocks(spark: SparkSession, paths: str | list[str], block: int) -> DataFrame:
    """(path, length, n, at, upto) of all blocks, about one a task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path", "length")
    cut = files.filter("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block).cast("long"))).alias("at"))
    cut = cut.select("path", "length", (F.col("at") / block).cast("long").alias("n"), "at", F.least(F.col("at") + block, "length").alias("upto"))
    blocks = cut.agg(F.count("*")).first()[0]
    return cut.repartition(max(1, min(100_000, blocks)), "path", "n")


def block_states(spark: SparkSession, paths: str | list[str], block: int = BLOCK) -> DataFrame:
    """(path, length, n, at, upto, inside, depth): the state at the begin of each block.

    A file that is no whole document ends the query.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_summary(_File(p), a, z) for p, a, z in zip(*(b.column(c).to_pylist() for c in ("path", "at", "upto")), strict=True)]
            cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, pa.int64()) for c in cols)], [*b.schema.names, "quotes", "out", "within"])

    summed = _blocks(spark, paths, block).mapInArrow(run, "path string, length long, n long, at long, upto long, quotes long, out long, within long")
    before = Window.partitionBy("path").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)  # a short row a block
    state = summed.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    state = state.withColumn("step", F.when(F.col("inside") == 0, F.col("out")).otherwise(F.col("within")))
    state = state.withColumn("depth", F.coalesce(F.sum("step").over(before), F.lit(0)))
    whole = (F.col("upto") < F.col("length")) | ((F.col("depth") + F.col("step") == 0) & ((F.col("inside") + F.col("quotes")) % 2 == 0))
    checked = state.filter(F.when(whole, True).otherwise(F.raise_error(F.concat("path", F.lit(" is no whole JSON document"))).cast("boolean")))
    return checked.select("path", "length", "n", "at", "upto", "inside", "depth")


def _sections(states: DataFrame, field: str) -> DataFrame:
    """(path, open, close): the places of the brackets of each file's array under a key of its outermost object; of several the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[str, int, bool]] = []
            for p, a, z, inside, depth in zip(*(b.column(c).to_pylist() for c in ("path", "at", "upto", "inside", "depth")), strict=True):
                f = _File(p)
                place, byte, after, *_ = _borders(f, a, z, inside, depth)
                for i in np.flatnonzero((after == 2) & (byte == ord("["))).tolist():
                    if _key_before(f, int(place[i])) == field:
                        out.append((p, int(place[i]), True))
                out += [(p, int(place[i]), False) for i in np.flatnonzero((after == 1) & (_STEP[byte] < 0)).tolist()]
            cols = list(zip(*out, strict=True)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.bool_())], ["path", "place", "opens"])

    marks = materialize(states.mapInArrow(run, "path string, place long, opens boolean"), "json-sections")
    opened = marks.filter("opens").groupBy("path").agg(F.max("place").alias("open"))
    return marks.filter("not opens").join(opened, "path").filter("place > open").groupBy("path", "open").agg(F.min("place").alias("close"))


def json_items(spark: SparkSession, paths: str | list[str], field: str | None = None, block: int = BLOCK) -> DataFrame:
    """(path, offset, item): the items of each file's JSON array, as their text, and where each begins.

    The array is the whole file, or what the outermost object has under `field`; a file without that field, an empty file and
    an empty array have no items. Items are of any kind and may be longer than a block. Folders are read with all below them.
    """
    states = materialize(block_states(spark, paths, block), "json-states")
    if field is None:
        work = states.withColumn("open", F.lit(-1).cast("long")).withColumn("close", F.col("length"))
    else:
        work = states.join(_sections(states, field), "path").filter("upto > open and at < close")
    work = work.select("path", "at", "upto", "inside", "depth", "open", "close")
    inner = 1 if field is None else 2

    def items(f: _File, at: int, to: int, inside: int, depth: int, opened: int, close: int) -> Iterator[tuple[int, str]]:
        place, byte, after, inside, depth = _borders(f, at, to, inside, depth)
        first = (after == inner) & (byte == ord("[")) & ((place == opened) | (opened < 0))
        cut = first | (after == inner) & (byte == _COMMA) | (after == inner - 1) & (_STEP[byte] < 0)
        cut &= (place >= opened) & (place <= close)
        places, last = place[cut].tolist(), (after[cut] == inner - 1).tolist()
        for i, p in enumerate(places):
            if last[i]:
                continue
            end = places[i + 1] if i + 1 < len(places) else None
            upto = to
            while end is None:  # the item goes on behind the block
                more, byte, after, inside, depth = _borders(f, upto, upto + max(1 << 16, to - at), inside, depth)
                found = np.flatnonzero((after == inner) & (byte == _COMMA) | (after == inner - 1) & (_STEP[byte] < 0))
                if len(found):
                    end = int(more[found[0]])
                elif upto >= f.size:
                    return
                upto += max(1 << 16, to - at)
            text = f.read(p + 1, end).strip(_SPACE)
            if text:
                yield p + 1, text.decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, *rest in zip(*(b.column(c).to_pylist() for c in b.schema.names), strict=True):
                held: list[tuple[int, str]] = []
                size = 0
                for x in items(_File(p), *rest):
                    held.append(x)
                    size += len(x[1])
                    if size > 4 << 20:
                        yield batch(p, held)
                        held, size = [], 0
                yield batch(p, held)

    def batch(path: str, held: list[tuple[int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path] * len(held), pa.string()), pa.array([x[0] for x in held], pa.int64()), pa.array([x[1] for x in held], pa.string())], ["path", "offset", "item"])

    return work.mapInArrow(run, "path string, offset long, item string")


def write_json_arrays(df: DataFrame, path: str, field: str | None = None) -> None:
    """df's rows as JSON arrays below a folder, a file a partition; under `field` of an object, if one is given. Each task writes under a new name and renames at its end."""
    make_dir(df.sparkSession, path)
    head, tail = (b"[", b"]\n") if field is None else (b'{"%s": [' % field.encode(), b"]}\n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, n = f"{path}/part-{uuid.uuid4().hex}.json", 0
        fs, at = open_fs(name)
        with fs.open_output_stream(f"{at}.tmp") as out:
            out.write(head)
            for b in batches:
                rows = b.column(0).to_pylist()
                if rows:
                    out.write((b",\n" if n else b"") + ",\n".join(rows).encode())
                    n += len(rows)
            out.write(tail)
        fs.move(f"{at}.tmp", at)
        yield pa.RecordBatch.from_pydict({"path": [name], "rows": pa.array([n], pa.int64())})

    written = materialize(df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("j")).mapInArrow(run, "path string, rows long"), "json-written")
    written.count()


def json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of all JSON files below a path, each one object or an array of objects; fields of another kind than the schema's are null."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("multiLine", True).schema(schema).json(path)
    return raw.filter(" or ".join(f"{c} is not null" for c in raw.columns))
