"""Deterministic sharded WARC writer and reader.

1. Payload digests (SHA-1, and SHA-256 beside it to tell equal payloads apart) are computed by Spark
   functions; of equal payloads of at least ``MIN_REVISIT`` bytes the row with the largest id is the
   response and the others revisit it. Groups are aggregated before they are shuffled, and the revisits are
   sent back to their input partitions: a hot group of copies is never brought together.
2. Records are range-sorted by id, payload digest, URL and a number among rows that are equal in all of them (a
   revisit without its payload). The ranges' borders come from a sample chosen by a hash of this key, so they, the order
   and the record ids follow from the rows alone: however the input is dealt to partitions, the same
   number of shards gives the same bytes. The number also lets a border cut a group of equal rows.
3. Every range writes its own files, a gzip member per record, rolled when a file passes ``ROLL_BYTES`` compressed.
   Headers and digests are made anew from the bytes; nothing depends on the clock or on the task.
4. A file is written under a temporary name and moved to its own when complete; the manifest (a Parquet
   table, written last) lists the files that count, with sizes and digests. Readers read what it lists, and what lost
   attempts left under temporary names goes.

Files are opened with ``pyarrow.fs`` by the shared folder's URI.

Cases: a null or empty payload has zero bytes; a null URL gives a record without a target; a null id one without
an id (it sorts first, and is never preferred as a response); of repeated rows one is the response (of equal ids that with the greatest URL); an empty table gives an empty manifest;
columns beside those named are ignored; a damaged file or a digest that does not fit raises an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from aerostat.llm.common import new_folder, sliced, table, utf8, written
from aerostat.llm import sidefiles
from aerostat.llm.sidefiles import proof, received, send_back
from aerostat.operators.windows import join_on_keys

MIN_REVISIT = 1000
ROLL_BYTES = 64 << 20
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
#: rows per shard, about, that place the borders of the ranges
BORDER_SAMPLE = 16
_SHIFT = 33  # of the partition's number in monotonically_increasing_id()
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line: control characters percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page: int | None, number: int, url: str | None, size: int, sha1: str, payload: bytes | None,
           refers_to: int | None, refers_url: str | None, date: str = DATE) -> bytes:
    """One WARC/1.1 record, uncompressed; ``payload`` None makes a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()
    name = lambda p: f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'page {p}'.encode()).digest()[:16], version=5)}>"
    head = [("WARC-Type", "response" if payload is not None else "revisit"), ("WARC-Record-ID", name(f"{page} {sha1} {url} {number}")), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    head += [("Content-Type", "application/http; msgtype=response"), ("WARC-Block-Digest", _sha1(block)), ("WARC-Payload-Digest", digest)]
    if page is not None:
        head.append(("X-Page-Id", str(page)))
    if payload is None:
        head.append(("WARC-Profile", _PROFILE))
        if refers_url is not None:
            head.append(("WARC-Refers-To-Target-URI", _clean(refers_url)))
        head += [("WARC-Refers-To-Date", date), ("X-Refers-To-Page-Id", str(refers_to))]
    head.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


class RollingFiles:
    """Files of one range: written under temporary names, moved to their own when complete."""

    def __init__(self, uri: str, shard: int, roll: int, level: int):
        self.store, self.root = fs.FileSystem.from_uri(uri)
        self.shard, self.roll, self.level, self.number = shard, roll, level, 0
        self.attempt, self.out = uuid.uuid4().hex, None

    def add(self, page: int | None, data: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.root}/_temporary/{self.attempt}-{self.name}"
            self.out = self.store.open_output_stream(self.temporary, compression=None)
            self.sha, self.size, self.records, self.first = hashlib.sha1(), 0, 0, page
        member = gzip.compress(data, self.level, mtime=0)
        self.out.write(member)
        self.sha.update(member)
        self.size, self.records, self.last = self.size + len(member), self.records + 1, page
        if self.size >= self.roll:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.out is None:
            return
        self.out.close()
        self.store.move(self.temporary, f"{self.root}/{self.name}")
        yield self.name, self.records, self.size, self.sha.hexdigest(), self.first, self.last
        self.out, self.number = None, self.number + 1


def _digests(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Place and digests of every row, and the number of those that equal an earlier row in id, URL and payload.

    An input partition's copies of a row are counted before they are shuffled, and only copies get numbers.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    every = written(pages.select("page", "url", "place", F.sha1(body).alias("one"), F.sha2(body, 256).alias("two"), F.octet_length(body).alias("size"),
                                 F.shiftright("place", _SHIFT).cast("int").alias("part")), "warc-digests")
    equal = ["page", "url", "one", "two"]
    counts = written(every.groupBy(*equal, "part").agg(F.count("*").alias("n")), "warc-copies")
    group = Window.partitionBy(*equal)
    before = F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    copied = counts.withColumns({"before": F.coalesce(before, F.lit(0)), "total": F.sum("n").over(group)}).where("total > 1").drop("n", "total")
    here = F.row_number().over(Window.partitionBy(*equal, "part").orderBy("place"))
    numbers = join_on_keys(every, copied, [*equal, "part"], "inner").withColumn("number", here + F.col("before") - 1)
    return every, written(numbers.where("number > 0").select("place", "number"), "warc-numbers")


def _sent(every: DataFrame, numbers: DataFrame) -> DataFrame:
    """``part, seq`` with ``one, refers_to, refers_url`` of the rows that revisit another, and the ``number`` of copies."""
    rows = every.where(F.col("size") >= MIN_REVISIT)
    # of equal rows the first by place, which has no number
    best = F.max(F.struct(F.col("page").isNotNull().alias("named"), "page", "url", (-F.col("place")).alias("back"))).alias("best")
    # written, so that both sides of the join are shuffled for it and Spark can split a hot payload's rows
    groups = written(rows.groupBy("one", "two", "size").agg(best, F.count("*").alias("n")).where("n > 1").drop("n"), "warc-groups")
    revisits = (rows.join(groups, ["one", "two", "size"]).where("place != -best.back")
                .select("place", "one", F.col("best.page").alias("refers_to"), F.col("best.url").alias("refers_url")))
    return (revisits.unionByName(numbers, allowMissingColumns=True).groupBy("place")
            .agg(*[F.max(c).alias(c) for c in ("one", "refers_to", "refers_url", "number")])
            .withColumns({"part": F.shiftright("place", _SHIFT).cast("int"), "seq": F.col("place").bitwiseAND((1 << _SHIFT) - 1)}).drop("place"))


def _key(page: int | None, sha1: str, url: str | None, number: int) -> tuple:
    """Sorts as Spark sorts these columns."""
    return page is not None, page or 0, sha1, url is not None, (url or "").encode(), number


def _borders(every: DataFrame, numbers: DataFrame, shards: int) -> list[tuple]:
    """The first keys of all ranges but the first, from a sample of about ``BORDER_SAMPLE`` rows a range."""
    key = ["page", "one", "url", "number"]
    rows = every.join(numbers, "place", "left").select("page", "one", "url", F.coalesce("number", F.lit(0)).alias("number"))
    share = int((1 << 30) * min(1.0, shards * BORDER_SAMPLE / max(1, every.count())))
    picked = sorted(_key(*r) for r in rows.where(F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < share).collect())
    return [picked[i * len(picked) // shards] for i in range(1, shards)] if picked else []


def _records(pages: DataFrame, sent: str, borders: list[tuple]) -> DataFrame:
    """Every page with its digest and shard; a revisit has its target in place of the payload."""
    def read(batches):
        back = None
        for b in sliced(batches, "html"):
            place = b.column("place").to_pylist()
            if back is None:
                held = received(sent, place[0] >> _SHIFT, ["seq", "refers_to", "refers_url", "one", "number"])
                back = {r["seq"]: r for r in held.rows.to_pylist()}
            held.seen(b.column("mark"))
            body = [t or b"" for t in utf8(b.column("html"))]
            sha = [hashlib.sha1(t).hexdigest() for t in body]
            hits = [back.get(p & ((1 << _SHIFT) - 1)) or {} for p in place]
            again = [h.get("one") is not None for h in hits]
            if any(a and h["one"] != s for a, h, s in zip(again, hits, sha)):
                raise RuntimeError(sidefiles.MOVED)
            numbers = [h.get("number") or 0 for h in hits]
            keys = map(_key, b.column("page").to_pylist(), sha, b.column("url").to_pylist(), numbers)
            yield pa.RecordBatch.from_pydict({
                "page": b.column("page"), "url": b.column("url"), "number": pa.array(numbers, pa.int64()),
                "size": pa.array([len(t) for t in body], pa.int64()), "sha1": pa.array(sha, pa.string()),
                "payload": pa.array([None if a else t for a, t in zip(again, body)], pa.binary()),
                "refers_to": pa.array([h.get("refers_to") for h in hits], pa.int64()),
                "refers_url": pa.array([h.get("refers_url") for h in hits], pa.string()),
                "shard": pa.array([bisect_right(borders, k) for k in keys], pa.int32())})
        if back is not None:
            held.check()

    return pages.mapInArrow(read, "page long, url string, number long, size long, sha1 string, payload binary, refers_to long, refers_url string, shard int")


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               shards: int | None = None, roll: int = ROLL_BYTES, level: int = LEVEL, date: str = DATE) -> DataFrame:
    """Write all pages below ``folder`` (a URI that all executors reach) and return the manifest."""
    spark = pages.sparkSession
    source = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"),
                          F.col(html_col).cast("string").alias("html"), F.monotonically_increasing_id().alias("place"), sidefiles.mark(sidefiles.seq(), F.col(id_col).cast("long")).alias("mark"))
    every, numbers = _digests(source)
    held = proof(every.select("part", F.col("place").bitwiseAND((1 << _SHIFT) - 1).alias("seq"), F.col("page").alias("id")))
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    records = _records(source, send_back(_sent(every, numbers), "warc-sent", held), _borders(every, numbers, shards))
    ranged = records.repartitionById(shards, "shard").sortWithinPartitions("page", "sha1", "url", "number")

    def write(batches):
        files = None
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        names = ["file", "records", "bytes", "sha1", "first_id", "last_id"]
        done = []
        for b in filter(len, batches):
            files = files or RollingFiles(folder, b.column("shard")[0].as_py(), roll, level)
            for row in zip(*(b.column(c).to_pylist() for c in ("page", "number", "url", "size", "sha1", "payload", "refers_to", "refers_url"))):
                done.extend(files.add(row[0], record(*row, date)))
        if files:
            done.extend(files.close())
        cols = list(zip(*done)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{root}/_temporary", recursive=True)
    manifest = ranged.mapInArrow(write, "file string, records long, bytes long, sha1 string, first_id long, last_id long")
    manifest.write.parquet(f"{folder}/manifest")  # the commit: what is not listed here does not count
    store.delete_dir_contents(f"{root}/_temporary")
    return spark.read.parquet(f"{folder}/manifest")


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, decompressed one by one."""
    unzip, out = zlib.decompressobj(31), []
    while data := stream.read(size):
        while data:
            out.append(unzip.decompress(data))
            data = unzip.unused_data
            if unzip.eof:
                yield b"".join(out)
                unzip, out = zlib.decompressobj(31), []
    if any(out):
        raise ValueError("the file ends inside a record")


class Hashed:
    """A stream whose size and SHA-1 are known when it has been read."""

    def __init__(self, stream):
        self.stream, self.size, self.sha = stream, 0, hashlib.sha1()

    def read(self, size: int) -> bytes:
        data = self.stream.read(size)
        self.size += len(data)
        self.sha.update(data)
        return data


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP head and payload of one record; its digests are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or _sha1(block) != fields["WARC-Block-Digest"]:
        raise ValueError("a record's block does not fit its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    if fields["WARC-Type"] == "response" and _sha1(payload) != fields["WARC-Payload-Digest"]:
        raise ValueError("a record's payload does not fit its digest")
    return fields, http, payload


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the files that the manifest lists: ``page_id, url, payload_bytes, payload_digest, record_type,
    refers_to`` and, if asked for, ``payload`` (null for revisits)."""
    listed = spark.read.parquet(f"{folder}/manifest").select("file", "records", "bytes", "sha1")
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def read(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for b in batches:
            for name, *listed_as in zip(*(b.column(c).to_pylist() for c in ("file", "records", "bytes", "sha1"))):
                rows, held, count = [], 0, 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as opened:
                    stream = Hashed(opened)
                    for data in members(stream):
                        count += 1
                        f, http, payload = parse(data)
                        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                        known = lambda key, kind: kind(f[key]) if key in f else None
                        rows.append((known("X-Page-Id", int), known("WARC-Target-URI", str), size, base64.b32decode(f["WARC-Payload-Digest"][5:]).hex(),
                                     f["WARC-Type"], known("X-Refers-To-Page-Id", lambda x: None if x == "None" else int(x)),
                                     payload if payloads and f["WARC-Type"] == "response" else None))
                        held += len(payload) if payloads else 200
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                if [count, stream.size, stream.sha.hexdigest()] != listed_as:
                    raise ValueError(f"{name} is not the file that the manifest lists")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return listed.repartition(n, "file").mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    folder = new_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH t AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
b AS (SELECT body, max(page_id) AS best FROM t WHERE payload_bytes >= 1000 GROUP BY body)
SELECT t.page_id, t.payload_bytes, sha1(t.body) AS payload_digest,
       CASE WHEN b.best IS NULL OR b.best = t.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN b.best <> t.page_id THEN b.best END AS refers_to
FROM t LEFT JOIN b ON t.body = b.body
"""
