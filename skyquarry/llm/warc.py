"""WARC archives of web pages, and one globally ordered capture index over them.

Archives are written by Spark's text writer: a record is its head and block, and the writer's line separator is the
blank line that ends a record, so that a gzip file holds plain WARC. Each archive, read back, gives a run of index
rows sorted by URL key and timestamp; the runs of a key range are merged by a loser tree.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyquarry.llm.common import map_arrow, prepared, saved, scratch_path

#: Records of an archive at most, and copies of one row that one task writes.
RECORDS = 20_000
BLOCK = 10_000
#: Second of a capture with page_id 0; pages carry no time of their own, so theirs is this plus the id.
EPOCH = 1_700_000_000

INDEX = "url_key string, timestamp long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, offset long, length long, archive string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def escaped(url: str) -> str:
    """A url on one header line: its control characters and blanks percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id, url, payload: bytes | None, size: int, code: str, refers_to, stamp: int) -> bytes:
    """Head and block of a record, without the blank line that ends it. A revisit keeps the HTTP head and leaves the payload out."""
    from datetime import datetime, timezone

    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.0",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {datetime.fromtimestamp(stamp, timezone.utc):%Y-%m-%dT%H:%M:%SZ}",
        *([f"WARC-Target-URI: {escaped(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{code}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block


def records(stream: io.BufferedIOBase) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, head fields, block) of every record of an archive."""
    offset = 0
    while line := stream.readline():
        if line != b"WARC/1.0\r\n":
            raise ValueError(f"no record at {offset}: {line[:40]!r}")
        size, head = len(line), {}
        while (line := stream.readline()) != b"\r\n":
            size += len(line)
            name, _, value = line.decode().partition(":")
            head[name.lower()] = value.strip()
        block = stream.read(int(head["content-length"]))
        if len(block) != int(head["content-length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"the record at {offset} is cut off")
        yield offset, size + 2 + len(block) + 4, head, block
        offset += size + 2 + len(block) + 4


def url_key(url: str | None) -> str:
    """The sort-friendly key of a url: host labels from the right, then path and query, lower-cased."""
    if not url or "://" not in url:
        return (url or "").lower()
    rest = url.split("://", 1)[1].split("#", 1)[0].lower()
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    return ",".join(reversed(rest[:cut].split("."))) + ")" + (rest[cut:] or "/")


def loser_tree(runs: list[Iterator], key: Callable) -> Iterator:
    """The rows of sorted runs in one order. An inner node keeps the loser of its match; the winner rises."""
    k = len(runs)
    heads = [next(r, None) for r in runs]
    keys = [(0, key(h)) if h is not None else (1,) for h in heads]
    losers = [-1] * max(k, 1)

    def replay(run: int) -> None:
        winner, at = run, (run + k) // 2
        while at > 0:
            if losers[at] < 0:
                losers[at] = winner
                return
            if keys[losers[at]] < keys[winner]:
                winner, losers[at] = losers[at], winner
            at //= 2
        losers[0] = winner

    for run in range(k):
        replay(run)
    while k and keys[losers[0]][0] == 0:
        run = losers[0]
        yield heads[run]
        heads[run] = next(runs[run], None)
        keys[run] = (0, key(heads[run])) if heads[run] is not None else (1,)
        replay(run)


def write(pages: DataFrame, path: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rows_per_archive: int = RECORDS) -> None:
    """One record per row in gzip archives under path. Of equal payloads of at least least_bytes, that of the largest id is the response.

    Null html is an empty payload. Ids are decided by id, then by url, so that a task that runs again decides alike; rows that
    repeat an id, a url and a payload are one response and revisits of it, written by their number and not row by row.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    # without payloads: how often each row occurs, and of each payload the last row
    alike = rows.where(F.col("size") >= least_bytes).groupBy("sha1", "page_id", "url", "size").agg(F.count("*").alias("copies"))
    last = F.max(F.struct(F.col("page_id").isNotNull().alias("named"), "page_id", F.col("url").isNotNull().alias("linked"), "url", "copies")).alias("last")
    groups = saved(alike.groupBy("sha1", "size").agg(last, F.sum("copies").alias("n")).where("n > 1").select("sha1", "size", "last"), "payloads")
    dealt = rows.join(groups.drop("size"), "sha1", "left")
    first = F.col("page_id").eqNullSafe(F.col("last.page_id")) & F.col("url").eqNullSafe(F.col("last.url"))
    single = dealt.where(F.col("last").isNull() | ~first | (F.col("last.copies") == 1))
    kind = F.when(F.col("last").isNull() | first, "response").otherwise("revisit")
    made = single.select("page_id", "url", F.when(kind == "response", F.col("payload")).alias("payload"), "size", "sha1", kind.alias("kind"), F.col("last.page_id").alias("refers_to"))
    repeated = groups.where("last.copies > 1")
    if not repeated.isEmpty():
        one = dealt.where(F.col("last").isNotNull() & first & (F.col("last.copies") > 1)).groupBy("sha1").agg(F.first("payload").alias("payload"), F.first("page_id").alias("page_id"), F.first("url").alias("url"), F.first("size").alias("size"))
        made = made.unionByName(one.select("page_id", "url", "payload", "size", "sha1", F.lit("response").alias("kind"), F.col("page_id").alias("refers_to")))
        # the copies beyond the first, in blocks that are dealt to tasks
        blocks = repeated.select("sha1", "size", "last.page_id", "last.url", (F.col("last.copies") - 1).alias("left"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("last.copies") - 2) / BLOCK))).alias("block"))
        again = blocks.repartition("sha1", "block").select("*", F.explode(F.array_repeat(F.lit(0), F.least(F.lit(BLOCK).cast("long"), F.col("left") - F.col("block") * BLOCK).cast("int"))))
        made = made.unionByName(again.select("page_id", "url", F.lit(None).cast("binary").alias("payload"), "size", "sha1", F.lit("revisit").alias("kind"), F.col("page_id").alias("refers_to")))

    def kernel(it):
        for b in it:
            made = []
            for name, url, payload, size, sha1, kind, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                code = base64.b32encode(bytes.fromhex(sha1)).decode()
                made.append(record(name, url, payload, size, code, (refers if refers is not None else "none") if kind == "revisit" else None, EPOCH + max(0, min(name or 0, 10**10))))
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()).cast(pa.string())], names=["value"])

    map_arrow(made, kernel, "value string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", rows_per_archive).text(path)


def index(spark, path: str) -> DataFrame:
    """The capture index of the archives under path, in the order of url_key, timestamp and page_id.

    Payload sizes and digests of responses are taken from the payload as read; those of revisits from their heads.
    """
    prepared(spark)

    def read(it):
        names = [f.split()[0] for f in INDEX.split(", ")]
        for b in it:
            for archive, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                stream = io.BufferedReader(_Gunzip(memoryview(content.as_buffer())), 1 << 18)
                for offset, length, head, block in records(stream):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind = head["warc-type"]
                    said = head["warc-payload-digest"].removeprefix("sha1:")
                    size = int(http.lower().rpartition(b"content-length:")[2])
                    if kind == "response" and (len(payload) != size or digest(payload) != said):
                        raise ValueError(f"{archive} is damaged at {offset}")
                    stamp = _seconds(head["warc-date"])
                    rows.append((url_key(head.get("warc-target-uri")), stamp, _page(head["warc-record-id"]), size, said, kind, _page(head["warc-refers-to"]) if kind == "revisit" else None, offset, length, archive))
                rows.sort(key=_order)
                for i in range(0, max(1, len(rows)), 10_000):
                    part = list(zip(*rows[i : i + 10_000], strict=True)) or [()] * len(names)
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64() if n in ("timestamp", "page_id", "payload_bytes", "refers_to", "offset", "length") else pa.string()) for n, c in zip(names, part, strict=True)], names=names)

    def merge(it):
        runs: dict[str, list] = {}
        schema = None
        for b in it:
            schema = b.schema
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                runs.setdefault(row[-1], []).append(row)
        merged = loser_tree([iter(r) for r in runs.values()], _order)
        while part := [row for _, row in zip(range(10_000), merged, strict=False)]:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for f, c in zip(schema, zip(*part, strict=True), strict=True)], schema=schema)

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    runs = map_arrow(archives, read, INDEX)
    ranges = runs.repartitionByRange("url_key", "timestamp", F.coalesce("page_id", F.lit(-1))).sortWithinPartitions("archive", "url_key", "timestamp", F.coalesce("page_id", F.lit(-1)), "offset")
    return map_arrow(ranges, merge, INDEX)


def _order(row):
    return row[0], row[1], -1 if row[2] is None else row[2], row[9], row[7]


def _page(text: str) -> int | None:
    name = text.removeprefix("<urn:page:").removesuffix(">")
    return None if name in ("None", "none") else int(name)


def _seconds(text: str) -> int:
    from datetime import datetime, timezone

    return int(datetime.strptime(text, "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc).timestamp())


class _Gunzip(io.RawIOBase):
    """A gzip file, one member after another, decompressed as it is read."""

    def __init__(self, data: memoryview):
        self.data, self.at, self.left, self.z = data, 0, b"", zlib.decompressobj(31)

    def readable(self):
        return True

    def readinto(self, out):
        while not self.left:
            if self.z.eof:
                rest = self.z.unused_data
                if not rest and self.at >= len(self.data):
                    return 0
                self.z = zlib.decompressobj(31)
                self.left = self.z.decompress(rest) if rest else b""
                if self.left or self.z.eof:
                    continue
            if self.at >= len(self.data):
                return 0
            piece = self.data[self.at : self.at + (1 << 16)]
            self.at += len(piece)
            self.left = self.z.decompress(piece)
        n = min(len(out), len(self.left))
        out[:n], self.left = self.left[:n], self.left[n:]
        return n


def archived(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes pages to archives and returns the merged index of what is read back. An empty table gives an empty index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write(pages, path, least_bytes)
    return index(spark, path)
