"""WARC: writing, reading and revisit resolution.

Archives are WARC/1.1 files of gzip members, one a record, and are read as streams from front to back. Resolution shuffles
headers only, by payload digest, joins every record of a digest to the one that stays a response, and writes new archives:
responses are copied with fresh headers, the others become revisit records that name the response's record and page. Of a
hot digest the shuffle has one short header row a record; AQE splits its partition in that join, which is a left join.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.chunks import groups
from skein.storage import make_dir, materialize, open_fs, scratch, shuffle_partitions

ARCHIVE_BYTES, MIN_BYTES = 64 << 20, 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EPOCH = "1970-01-01T00:00:00Z"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))]) + "\r\n"
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress(head.encode()) + c.compress(block) + c.compress(b"\r\n\r\n") + c.flush()


def http_block(payload: bytes | None, size: int) -> bytes:
    """HTTP response headers, which state the full payload's size, and the payload; None leaves it out."""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")


def read_records(f) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, compressed size, headers, block) of the records of an open stream, read once from front to back."""
    at, used, data, out = 0, 0, b"", []
    d = zlib.decompressobj(31)
    while True:
        if not data:
            data = f.read(1 << 16)
            if not data:
                if used:
                    raise EOFError(f"a record is cut off at {at}")
                return
        out.append(d.decompress(data))
        used += len(data) - len(d.unused_data)
        data = d.unused_data
        if d.eof:
            raw = b"".join(out)
            cut = raw.index(b"\r\n\r\n")
            headers = dict(line.split(": ", 1) for line in raw[:cut].decode().split("\r\n")[1:])
            yield at, used, headers, raw[cut + 4 : cut + 4 + int(headers["Content-Length"])]
            at, used, out, d = at + used, 0, [], zlib.decompressobj(31)


def _stream(uri: str):
    fs, path = open_fs(uri)
    return fs.open_input_stream(path, compression=None, buffer_size=4 << 20)


class Archives:
    """Files of records, a new one from ARCHIVE_BYTES on; their names are new in each task attempt."""

    def __init__(self, root: str, most: int = ARCHIVE_BYTES):
        self.root, self.most, self.out, self.size, self.uri = root, most, None, 0, ""

    def add(self, data: bytes) -> tuple[str, int]:
        """Where the record is: file and offset."""
        if self.out is None or self.size >= self.most:
            self.close()
            self.uri, self.size = f"{self.root}/{uuid.uuid4().hex}.warc.gz", 0
            fs, path = open_fs(self.uri)
            self.out = fs.open_output_stream(path, compression=None, buffer_size=1 << 20)
        at = self.size
        self.out.write(data)
        self.size += len(data)
        return self.uri, at

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Manifest (file, records) of archives with a response record for each row; a null html is an empty payload."""
    root = make_dir(pages.sparkSession, scratch(pages.sparkSession, "warc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, count = Archives(root), {}
        for b in batches:
            for k, u, h in zip(b.column(0), b.column(1), b.column(2), strict=True):
                payload = (h.as_py() or "").encode()
                key = k.as_py()
                head = [("WARC-Type", "response"), ("WARC-Record-ID", _urn("record", key, uuid.uuid4())), ("WARC-Date", _EPOCH), ("WARC-Target-URI", " ".join((u.as_py() or "").split())), ("WARC-Payload-Digest", f"sha1:{hashlib.sha1(payload).hexdigest()}"), ("Content-Type", "application/http; msgtype=response")]
                uri, _ = files.add(record([*head, *([("X-Page-ID", str(key))] if key is not None else [])], http_block(payload, len(payload))))
                count[uri] = count.get(uri, 0) + 1
        files.close()
        if count:
            yield pa.RecordBatch.from_pydict({"file": list(count), "records": list(count.values())})

    rows = pages.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{url_col}`").cast("string").alias("u"), F.col(f"`{html_col}`").cast("string").alias("h"))
    return materialize(rows.mapInArrow(run, "file string, records long"), "warc-manifest")


def _spread(manifest: DataFrame) -> DataFrame:
    return manifest.repartitionByRange(max(1, min(100_000, manifest.count())), "file")


def read_headers(manifest: DataFrame) -> DataFrame:
    """(file, at, size, page_id string, record_id, type, digest, payload_bytes, refers, refers_page) of every record of archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column("file").to_pylist():
                out: dict[str, list] = {c: [] for c in schema.names}
                with _stream(uri) as f:
                    for at, size, h, block in read_records(f):
                        http = block[: block.index(b"\r\n\r\n")].decode().split("\r\n")
                        length = next(int(x[16:]) for x in http if x.startswith("Content-Length: "))
                        for c, v in zip(out, (uri, at, size, h.get("X-Page-ID"), h["WARC-Record-ID"], h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha1:"), length, h.get("WARC-Refers-To"), h.get("X-Refers-To-Page-ID")), strict=True):
                            out[c].append(v)
                        if len(out["at"]) >= 10_000:
                            yield pa.RecordBatch.from_pydict(out, schema=schema)
                            out = {c: [] for c in out}
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    text, number = pa.string(), pa.int64()
    schema = pa.schema([("file", text), ("at", number), ("size", number), ("page_id", text), ("record_id", text), ("type", text), ("digest", text), ("payload_bytes", number), ("refers", text), ("refers_page", text)])
    return _spread(manifest).mapInArrow(run, "file string, at long, size long, page_id string, record_id string, type string, digest string, payload_bytes long, refers string, refers_page string")


def resolve_revisits(spark: SparkSession, manifest: DataFrame, min_bytes: int = MIN_BYTES, id_kind: str = "bigint") -> DataFrame:
    """Manifest of new archives: of records with equal payloads of at least min_bytes, that of the largest page id stays.

    Records of one id and payload keep the one of the largest record id. Records without a page id come before all others.
    """
    root = make_dir(spark, scratch(spark, "warc-deduplicated"))
    heads = materialize(read_headers(manifest), "warc-headers").withColumn("rank", F.struct(F.col("page_id").cast(id_kind).alias("n"), "page_id", "record_id"))
    large = heads.filter(F.col("payload_bytes") >= min_bytes)
    stay = large.groupBy("digest", "payload_bytes").agg(F.max("rank").alias("r"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "payload_bytes", F.col("r.record_id").alias("to_record"), F.col("r.page_id").alias("to_page"))
    moved = heads.join(stay, ["digest", "payload_bytes"], "left").select("file", "at", F.when(F.col("record_id") != F.col("to_record"), F.col("to_record")).alias("to_record"), F.when(F.col("record_id") != F.col("to_record"), F.col("to_page")).alias("to_page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, count = Archives(root), {}
        now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        for uri, rows in groups(batches, "file"):
            moves = {r["at"]: r for r in rows}
            with _stream(uri) as f:
                for at, _, h, block in read_records(f):
                    r = moves[at]
                    h.pop("Content-Length")
                    head = h | {"WARC-Record-ID": _urn("deduplicated", h["WARC-Record-ID"]), "WARC-Date": now}
                    if r["to_record"] is not None:
                        block = block[: block.index(b"\r\n\r\n") + 4]
                        head |= {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "WARC-Refers-To": _urn("deduplicated", r["to_record"])}
                        if r["to_page"] is not None:
                            head["X-Refers-To-Page-ID"] = str(r["to_page"])
                    to, _ = out.add(record(list(head.items()), block))
                    count[to] = count.get(to, 0) + 1
        out.close()
        if count:
            yield pa.RecordBatch.from_pydict({"file": list(count), "records": list(count.values())})

    n = max(1, min(100_000, max(manifest.count(), shuffle_partitions(spark))))
    return materialize(moved.repartition(n, "file").sortWithinPartitions("file").mapInArrow(run, "file string, records long"), "warc-manifest")


def warc_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """(id_col, payload_bytes, payload_digest, record_type, refers_to) as read back from the deduplicated archives.

    Every row is a record, repeated rows too. A null html has 0 bytes; a null url is an empty target; null ids stay null and
    are never preferred to others. An empty table writes no archive. A revisit says itself which page it refers to.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    archives = resolve_revisits(pages.sparkSession, write_archives(pages, id_col, url_col, html_col), min_bytes, kind)
    page, to = F.col("page_id").cast(kind), F.col("refers_page").cast(kind)
    return read_headers(archives).select(page.alias(id_col), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), to.alias("refers_to"))
