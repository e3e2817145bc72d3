"""WARC archives with a two-level capture index.

Every page becomes a record, each a gzip member of its own, in one archive for
each task. The index lists captures by reversed-host key (``com,example,www)/path``)
in sorted order: lines lie in compressed blocks, and a sparse directory beside
every index file names each block's first key, offset and length. A lookup
bisects the index files' first keys (one for each file, the only table that
goes to every task), then the directory, then the lines of one block, and reads
the records by byte range.

Files lie in a folder all executors share and are written by tasks under names
of their own attempt. Only what a finished task reports is ever read, so a task
that is run again, or twice, leaves at most a file that no index names.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.sources.io import stage_root

from .common import frame, shipped, stage

#: Payloads below are never stored as revisits.
LEAST_BYTES = 1000
#: Captures in a block of the index.
BLOCK = 1500
DATE = "1970-01-01T00:00:00Z"
_END = b"\r\n"


def surt(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, lower case, then path and query; no scheme, port, user or fragment."""
    if not url:
        return ""
    rest = url.partition("://")[2] or url
    rest = rest.partition("#")[0]
    cut = min((k for k in map(rest.find, "/?") if k >= 0), default=len(rest))
    host, path = rest[:cut].rpartition("@")[2].partition(":")[0].lower(), rest[cut:] or "/"
    return ",".join(reversed(host.split("."))) + ")" + "".join(c if c > " " else f"%{ord(c):02X}" for c in path)


def _folder(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """A response, or a revisit that holds the response's headers alone."""
    digest = base64.b32encode(hashlib.sha1(payload).digest())
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + _END + _END)
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
            b"WARC-Record-ID: <urn:uuid:" + str(uuid.uuid4()).encode() + b">", b"WARC-Date: " + DATE.encode(),
            b"WARC-Payload-Digest: sha1:" + digest]
    if url is not None:
        clean = "".join(c if c >= " " else f"%{ord(c):02X}" for c in url)
        head.append(b"WARC-Target-URI: " + clean.encode("utf-8", "replace"))
    if page_id is not None:
        head.append(b"Page-ID: " + page_id.encode())
    if refers_to is not None:
        head.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(b"Refers-To-Page-ID: " + refers_to.encode())
        payload = b""
    block = http + payload
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: " + str(len(block)).encode()]
    return _END.join(head) + _END + _END + block + _END + _END


def parse(data: bytes) -> dict:
    """Fields of a record; payload_bytes from the stored response headers, payload None in a revisit."""
    head, _, rest = data.partition(_END + _END)
    fields = dict(line.split(b": ", 1) for line in head.split(_END)[1:])
    block = rest[:int(fields[b"Content-Length"])]
    http, _, payload = block.partition(_END + _END)
    size = next(int(x[16:]) for x in http.split(_END) if x.lower().startswith(b"content-length: "))
    text = lambda name: fields[name].decode() if name in fields else None
    kind = text(b"WARC-Type")
    return {"page_id": text(b"Page-ID"), "url": text(b"WARC-Target-URI"), "record_type": kind,
            "refers_to": text(b"Refers-To-Page-ID"), "payload_bytes": size,
            "payload_digest": base64.b32decode(fields[b"WARC-Payload-Digest"][5:]).hex(),
            "payload": payload if kind == "response" else None}


def deduplicated(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, html, refers_to: the page whose equal payload a revisit refers to.

    Rows that share the largest id are all responses; null ids are below all
    others. Groups are counted before the shuffle and only those of several
    rows are joined back.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumns({"sha": F.sha1("html"), "size": F.octet_length("html")})
    groups = stage(rows.where(F.col("size") >= least_bytes).groupBy("sha", "size").agg(
        F.max("page_id").alias("kept_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    rows = rows.join(groups, ["sha", "size"], "left")
    return rows.select("page_id", "url", "html", F.when(
        F.col("kept_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept_id")), F.col("kept_id")).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write records of page_id, url, html, refers_to; key, page_id, file, offset, length of each."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        store, root = _folder(folder)
        name = f"pages-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        at, out = 0, None
        for batch in batches:
            if out is None and len(batch):
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{root}/{name}", compression=None)
            lines = []
            for page, url, html, refers in zip(batch["page_id"], batch["url"], batch["html"], batch["refers_to"]):
                member = gzip.compress(record(page, url, html.encode(), refers), 6, mtime=0)
                out.write(member)
                lines.append((surt(url), page, name, at, len(member)))
                at += len(member)
            yield frame(lines, ["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    return shipped(rows).select(
        F.col("page_id").cast("string").alias("page_id"), "url", "html",
        F.col("refers_to").cast("string").alias("refers_to")).mapInPandas(
        write, "key string, page_id string, file string, offset long, length long")


def write_index(entries: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """Write index files and their directories; file, low, high (first and last key) of each."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        store, root = _folder(folder)
        name = f"index-{task.partitionId():05d}-{task.taskAttemptId()}"
        out, at, held, directory = None, 0, [], []
        low = high = None

        def flush():
            nonlocal at
            data = gzip.compress("\n".join("\t".join(x) for x in held).encode(), 6, mtime=0)
            out.write(data)
            directory.append(f"{held[0][0]}\t{at}\t{len(data)}")
            at += len(data)
            held.clear()

        for batch in batches:
            if out is None and len(batch):
                out = store.open_output_stream(f"{root}/{name}.gz", compression=None)
                low = batch["key"].iloc[0]
            for key, file, offset, length in zip(batch["key"], batch["file"], batch["offset"], batch["length"]):
                held.append((key, file, str(offset), str(length)))
                high = key
                if len(held) == block:
                    flush()
        if out is not None:
            if held:
                flush()
            out.close()
            with store.open_output_stream(f"{root}/{name}.dir.gz", compression=None) as side:
                side.write(gzip.compress("\n".join(directory).encode(), 6, mtime=0))
            yield frame([(name, low, high)], ["file", "low", "high"])

    # Ties of a key spread over ranges by place, so no key fills one index file.
    order = ("key", "file", "offset")
    return entries.select(*order, "length").repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        write, "file string, low string, high string")


class Archive:
    """Archives and index of one folder. ``top``: file, first and last key of each index file, sorted."""

    def __init__(self, spark: SparkSession, folder: str, top: list[tuple[str, str, str]]):
        self.spark, self.folder, self.top = spark, folder, sorted(top, key=lambda x: (x[1], x[2]))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """file, offset, length of every capture of the distinct keys in column ``key``."""
        folder, top = self.folder, self.top
        lows = [low for _, low, _ in top]
        ends, high = [], ""
        for _, _, x in top:
            high = max(high, x)
            ends.append(high)

        def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for key in batch["key"]:
                    k = bisect.bisect_left(ends, key)
                    while k < len(top) and lows[k] <= key:
                        if top[k][2] >= key:
                            out.append((top[k][0], key))
                        k += 1
                yield frame(out, ["index_file", "key"])

        def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            store, root = _folder(folder)
            name, at, stream, firsts, places, keys, lines = None, None, None, [], [], [], []
            for batch in batches:
                out = []
                for file, key in zip(batch["index_file"], batch["key"]):
                    if file != name:
                        name, at = file, None
                        with store.open_input_stream(f"{root}/{file}.dir.gz", compression=None) as side:
                            listed = [x.split("\t") for x in gzip.decompress(side.read()).decode().split("\n")]
                        firsts = [x[0] for x in listed]
                        places = [(int(x[1]), int(x[2])) for x in listed]
                        stream = store.open_input_file(f"{root}/{file}.gz")
                    b = max(0, bisect.bisect_left(firsts, key) - 1)
                    while b < len(firsts) and firsts[b] <= key:
                        if at != b:
                            stream.seek(places[b][0])
                            lines = [x.split("\t") for x in gzip.decompress(stream.read(places[b][1])).decode().split("\n")]
                            keys, at = [x[0] for x in lines], b
                        k = bisect.bisect_left(keys, key)
                        while k < len(keys) and keys[k] == key:
                            out.append((lines[k][1], int(lines[k][2]), int(lines[k][3])))
                            k += 1
                        b += 1
                yield frame(out, ["file", "offset", "length"])

        asked = keys.select("key").distinct().mapInPandas(route, "index_file string, key string")
        return asked.repartition("index_file").sortWithinPartitions("index_file", "key").mapInPandas(
            find, "file string, offset long, length long")

    def read(self, places: DataFrame) -> DataFrame:
        """The records at file, offset, length, read by byte range in the order of the archives."""
        folder = self.folder
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]

        def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            store, root = _folder(folder)
            name, stream = None, None
            for batch in batches:
                out, held = [], 0
                for file, offset, length in zip(batch["file"], batch["offset"], batch["length"]):
                    if file != name:
                        name, stream = file, store.open_input_file(f"{root}/{file}")
                    stream.seek(offset)
                    got = parse(gzip.decompress(stream.read(length)))
                    out.append(tuple(got[n] for n in names))
                    held += got["payload_bytes"]
                    if held > 16_000_000:
                        yield frame(out, names)
                        out, held = [], 0
                yield frame(out, names)

        return places.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInPandas(
            fetch, "page_id string, url string, record_type string, refers_to string, payload_bytes long, "
                   "payload_digest string, payload binary")

    def captures(self, urls: DataFrame) -> DataFrame:
        """All records whose key is that of a URL in column ``url``, once each."""
        key = _column(surt)
        return self.read(stage(self.lookup(urls.select(key("url").alias("key")))))


def _column(of: Callable[[str | None], str]):
    @F.pandas_udf("string")
    def column(values: pd.Series) -> pd.Series:
        return values.map(of, na_action=None)

    return column


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> Archive:
    """Write the pages' archives and index to the shared folder.

    Null htmls are empty payloads, null urls have the empty key, null ids no id
    in the record. Repeated rows are captures of their own. An empty table
    makes an empty index. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = f"{stage_root(spark).rstrip('/')}/subscope/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    entries = stage(write_archives(deduplicated(pages, id_col, url_col, html_col), folder))
    top = stage(write_index(entries, folder)).collect()
    return Archive(spark, folder, [tuple(r) for r in top])


ORACLE = f"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM p),
k AS (SELECT *, CASE WHEN payload_bytes >= {LEAST_BYTES}
              THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS kept FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN kept IS DISTINCT FROM page_id AND kept IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept IS DISTINCT FROM page_id THEN kept END AS refers_to
FROM k
"""
