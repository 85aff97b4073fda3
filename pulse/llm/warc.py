"""Deterministic sharded WARC writer and the reader of its archives.

Pages are cut into shards by ranges of page_id that hold about the same number of bytes, sorted
inside a shard, and written as gzip members of WARC/1.1 records; a file is closed at the first record
beyond ``roll_bytes`` of compressed size. Ranges come from exact byte counts per id bucket (at most
``BUCKETS`` rows on the driver), not from a sample, so the same pages give the same files, byte for byte.
A bucket larger than a shard (one id, or null, with very many rows) is divided further by digest.

Equal payloads of at least ``revisit_bytes`` bytes are stored once: by the largest page_id; the other
pages become revisit records that refer to it. Who that is, is found on (page_id, digest) rows alone; the
decisions travel through the same shuffle and sort as the pages and meet them there, so the html moves
once.

Commit: a task writes under a temporary name of its own attempt and returns a manifest row per
file; only rows of attempts that Spark commits reach the manifest; then every listed file is renamed
and the manifest of final names is written last. A lost task leaves only temporary files, and a
repeated rename finds its work done. Readers go by the final manifest.

Defined results: null html is an empty payload; a null url becomes ``about:blank``; control characters
and spaces of a url are percent-encoded; a null page_id stays null and never is the largest; of
repeated equal rows the first is the response; an empty table gives archives without records; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.common import ensure_columns, map_arrow, shared_dir, written

BUCKETS = 1 << 16
SHARD_BYTES, ROLL_BYTES = 64 << 20, 64 << 20
DATE = "2024-01-15T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_M64 = (1 << 64) - 1


# --- records -------------------------------------------------------------------------------

def record_id(page_id: int | None, digest: str, copy: int = 0) -> str:
    """A version 8 UUID that holds the page_id (64 bits), whether it is null, 32 bits of the
    payload digest and the number of the copy (25 bits)."""
    bits = ((page_id or 0) & _M64) << 58 | (page_id is None) << 57 | int(digest[:8], 16) << 25 | copy & 0x1FFFFFF
    high, mid, low = bits >> 74, bits >> 62 & 0xFFF, bits & (1 << 62) - 1
    return f"<urn:uuid:{uuid.UUID(int=high << 80 | 8 << 76 | mid << 64 | 2 << 62 | low)}>"


def page_of(record: str) -> int | None:
    """The page_id inside a :func:`record_id`."""
    n = uuid.UUID(record.strip("<>").rpartition(":")[2]).int
    bits = (n >> 80) << 74 | (n >> 64 & 0xFFF) << 62 | n & (1 << 62) - 1
    if bits >> 57 & 1:
        return None
    page = bits >> 58
    return page - (1 << 64) if page >> 63 else page


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record, headers made anew from the block, as a gzip member without a time stamp."""
    lines = [("WARC-Type", kind), ("WARC-Date", DATE), *headers,
             ("WARC-Block-Digest", "sha1:" + _base32(hashlib.sha1(block).hexdigest())), ("Content-Length", str(len(block)))]
    raw = b"".join([b"WARC/1.1\r\n", *(f"{k}: {v}\r\n".encode() for k, v in lines), b"\r\n", block, b"\r\n\r\n"])
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: tuple[int | None] | None, copy: int) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", record_id(page_id, digest, copy)), ("WARC-Target-URI", _url(url)),
               ("WARC-Payload-Digest", "sha1:" + _base32(digest)), ("Content-Type", "application/http;msgtype=response")]
    if refers is None:
        return record("response", headers, http + payload)
    return record("revisit", [*headers, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers[0], digest))], http)


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records (headers, block) of one file, a record in memory at a time."""
    unpack, data = zlib.decompressobj(31), bytearray()
    for chunk in chunks:
        while chunk:
            data += unpack.decompress(chunk)
            chunk = unpack.unused_data
            if unpack.eof:
                yield _record(bytes(data))
                data.clear()
                unpack = zlib.decompressobj(31)
    if data:
        raise ValueError("a record is cut off")


def _record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    size = int(headers["Content-Length"])
    if not lines[0].startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return headers, rest[:size]


# --- writing -------------------------------------------------------------------------------

def _filesystem(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def write(pages: DataFrame, root: str | None = None, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
          revisit_bytes: int = 0) -> str:
    """Writes ``pages`` (page_id, url, html) below ``root`` (default: a new shared folder) and
    returns it. ``root`` must be writable by all executors (any file system pyarrow opens)."""
    spark = pages.sparkSession
    root = (root or shared_dir(spark, "warc")).rstrip("/")
    pages = (ensure_columns(pages, {"page_id": "long", "url": "string", "html": "binary"})
             .withColumn("html", F.coalesce("html", F.lit(b""))).withColumn("digest", F.sha1("html")))
    slim = written(pages.select("page_id", "digest", F.octet_length("html").alias("size")), "payloads")

    # who holds a payload: only groups of several pages need a decision
    holders = slim.groupBy("digest").agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    holders = written(holders.where((F.col("n") > 1) & (F.col("size") >= revisit_bytes)).select("digest", "holder"), "holders")
    decisions = slim.select("page_id", "digest").join(holders, "digest").distinct()

    low, high = slim.agg(F.min("page_id"), F.max("page_id")).first()
    width = max(1, ((high or 0) - (low or 0)) // (BUCKETS - 2) + 1)
    bucket = F.coalesce(F.expr(f"page_id div {width}"), F.lit((low or 0) // width - 2))
    sizes = slim.groupBy(bucket.alias("bucket")).agg(F.sum(F.col("size") + 512).alias("size")).orderBy("bucket").collect()
    plan, shard, filled = [], 0, 0
    for b, size in sizes:  # cumulative bytes, at most BUCKETS rows
        if filled and filled + size > shard_bytes:
            shard, filled = shard + 1, 0
        filled += size
        plan.append((b, shard, max(1, -(-size // shard_bytes))))
    ranges = F.broadcast(spark.createDataFrame(plan, "bucket long, shard int, parts int"))  # at most BUCKETS rows

    def placed(df: DataFrame) -> DataFrame:
        return df.join(ranges, bucket == F.col("bucket")).withColumn("part", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int")).drop("bucket", "parts")

    rows = placed(pages.withColumn("holder", F.lit(None).cast("long")).withColumn("kind", F.lit(1))).unionByName(
        placed(decisions.withColumn("kind", F.lit(0))), allowMissingColumns=True)
    # as many tasks as shards, unless the session asks for more
    shards = sum(max(p for _, s, p in plan if s == k) for k in {s for _, s, _ in plan})
    rows = rows.repartition(max(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard", "part").sortWithinPartitions("shard", "part", "page_id", "kind", "digest", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        fs, base = _filesystem(root)
        fs.create_dir(f"{base}/_temporary", recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        out, place, files = None, None, []
        decided: dict[str, int | None] = {}
        page, copies = object(), {}

        def close():
            nonlocal out
            if out is not None:
                out["file"].close()
                files.append({k: out[k] for k in ("name", "temporary", "records", "bytes", "sha256")} | {"sha256": out["sha256"].hexdigest()})
                out = None

        def put(data: bytes):
            out["file"].write(data)
            out["sha256"].update(data)
            out["bytes"] += len(data)

        for batch in batches:
            for shard_, part, page_id, kind, digest, url, html, holder in zip(*(batch.column(c).to_pylist() for c in ("shard", "part", "page_id", "kind", "digest", "url", "html", "holder"))):
                if page_id != page or (shard_, part) != place:
                    page, decided, copies = page_id, {}, {}
                if kind == 0:
                    decided[digest] = holder
                    if (shard_, part) != place:
                        close()
                        place, number = (shard_, part), 0
                    continue
                if (shard_, part) != place or out is not None and out["bytes"] >= roll_bytes:
                    close()
                    number = number + 1 if (shard_, part) == place else 0
                    place = (shard_, part)
                if out is None:
                    name = f"{shard_:06d}-{part:04d}-{number:05d}.warc.gz"
                    temporary = f"_temporary/{name}.{attempt}"
                    out = {"name": name, "temporary": temporary, "records": 0, "bytes": 0, "sha256": hashlib.sha256(),
                           "file": fs.open_output_stream(f"{base}/{temporary}", compression=None)}
                    info = f"software: pulse\r\nformat: WARC File Format 1.1\r\nfile: {name}\r\n".encode()
                    put(record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
                                            ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], info))
                copy = copies[digest] = copies.get(digest, -1) + 1
                keeps = digest not in decided or decided[digest] == page_id and copy == 0
                put(page_record(page_id, url, html, digest, None if keeps else (decided[digest],), copy))
                out["records"] += 1
            if files:
                yield pa.RecordBatch.from_pylist(files, MANIFEST)
                files = []
        close()
        if files:
            yield pa.RecordBatch.from_pylist(files, MANIFEST)

    staged = f"{root}/_staged"
    map_arrow(rows, run, MANIFEST_DDL).write.parquet(staged)

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileType
        fs, base = _filesystem(root)
        for batch in batches:
            for row in batch.to_pylist():
                temporary, final = f"{base}/{row['temporary']}", f"{base}/{row['name']}"
                if fs.get_file_info(temporary).type == FileType.File:
                    fs.move(temporary, final)
                elif fs.get_file_info(final).size != row["bytes"]:
                    raise OSError(f"{final} is neither staged nor committed")
            yield batch

    schema = spark.createDataFrame([], MANIFEST_DDL).schema
    map_arrow(spark.read.schema(schema).parquet(staged), rename, MANIFEST_DDL).write.parquet(f"{root}/_manifest")
    fs, base = _filesystem(root)
    from pyarrow.fs import FileType
    if fs.get_file_info(f"{base}/_temporary").type == FileType.Directory:
        fs.delete_dir(f"{base}/_temporary")  # what lost attempts left
    return root


MANIFEST_DDL = "name string, temporary string, records long, bytes long, sha256 string"
MANIFEST = pa.schema([("name", pa.string()), ("temporary", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


# --- reading -------------------------------------------------------------------------------

READ_DDL = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                  ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.large_binary())])


def manifest(spark: SparkSession, root: str) -> DataFrame:
    schema = spark.createDataFrame([], MANIFEST_DDL).schema
    return spark.read.schema(schema).parquet(f"{root}/_manifest").drop("temporary")


def read(spark: SparkSession, root: str, payloads: bool = False) -> DataFrame:
    """The page records of all committed files; digests are checked on the way. One file is one
    unit of work and is read as a stream."""
    names = [*READ.names[:6], *(["payload"] if payloads else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(root)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                    for headers, block in records(iter(lambda: f.read(1 << 20), b"")):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = int(re.search(rb"(?i)\r\ncontent-length: (\d+)", http)[1])
                        refers = None
                        if headers["WARC-Type"] == "response":
                            if size != len(payload) or _base32(hashlib.sha1(payload).hexdigest()) != digest:
                                raise ValueError(f"{name}: {headers['WARC-Record-ID']} doesn't match its digest")
                        else:
                            refers, payload = page_of(headers["WARC-Refers-To"]), None
                        row = (page_of(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], size, digest, headers["WARC-Type"], refers, payload)
                        rows.append(dict(zip(names, row)))
                        held += len(payload or b"") if payloads else 256
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, pa.schema([READ.field(n) for n in names]))
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema([READ.field(n) for n in names]))

    files = manifest(spark, root).select("name")
    files = files.repartition(max(1, min(files.count(), 100_000)))  # a task per file: the rows are tiny, the files are not
    return map_arrow(files, run, READ_DDL + (", payload binary" if payloads else ""))
