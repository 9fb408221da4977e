"""WARC archives with a two-level capture index (operator 2).

``write`` turns pages into archives of one gzip member a record, at most ``ARCHIVE`` bytes each before the
last record, written by the tasks themselves into the shared folder. Pages with equal payloads of at
least ``LEAST`` bytes share one response, that of the largest id; the others become revisit records.

``build_index`` sorts the captures by their key, the URL with its host reversed and then the page id,
into compressed blocks of ``BLOCK`` lines (level one), and returns the sparse directory of
blocks, a row each with the first and last key (level two).

``lookup`` sends each key by way of a top level to the directory segment that can hold it, where a binary search finds the
block, and reads that block's range alone. ``fetch`` then reads the records' ranges, file by file.

Retries are safe: a file's name holds a token of its own attempt, and only files named in the
written table of captures count. All reads and writes of archives go through ``pyarrow.fs``, so the
folder may be any that it opens (local or shared disk, HDFS, S3, GCS).

Defined results: a null html is an empty payload; a null URL is stored as ``urn:x-page:<id>``. Pages with a null id
get records and come back. Repeated rows get a record each. An empty table gives no archives and an empty result. Control characters
and blanks in URLs are percent-encoded. Further columns are passed over.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith.llm.common import column, materialise, scratch

LEAST = 1000
ARCHIVE = 64_000_000
BLOCK = 512
#: Directory rows searched together.
SEGMENT = 64
#: Segments under one row of the top level.
FAN = 64
#: Groups of equal payloads that are sent to all tasks, at most; more meet their pages in a shuffle.
SENT = 100_000
CAPTURES = "key string, path string, offset long, length long"
DIRECTORY = "segment string, first_key string, last_key string, path string, offset long, length long, lines long"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, intact boolean"


def _clean(url: str | None, page: int | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if url else f"urn:x-page:{page}"


def surt(url: str) -> str:
    """The URL with its host reversed: ``com,example,blog)/path?query``."""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url
    if not host:
        return url
    default = {"http": 80, "https": 443}.get(parts.scheme)
    number = ":" in host or re.fullmatch(r"[0-9.]+", host)  # an address of numbers is read from the left as it is
    return (host if number else ",".join(reversed(host.split(".")))) + (f":{port}" if port and port != default else "") + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def capture_key(url: str | None, page: int | None) -> str:
    """Sorts by reversed host, path, then page id (shifted to be positive; null ids first)."""
    return f"{surt(_clean(url, page))} {0 if page is None else page + (1 << 63) + 1:020d}"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    length = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = length if revisit else length + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{page}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_clean(url, page)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields of one record, lower-cased names, and its payload (without the HTTP head)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[: int(fields["content-length"])].partition(b"\r\n\r\n")[2]


def _number(urn: str) -> int | None:
    tail = urn.strip("<>").rpartition(":")[2]
    return None if tail == "None" else int(tail)


def _open(url: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(url)


class _Files:
    """Files of one task, each closed when ``most`` bytes are full."""

    def __init__(self, folder: str, kind: str, most: int):
        self.folder, self.kind, self.most, self.file, self.count = folder, kind, most, None, 0
        self.stem = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"

    def put(self, data: bytes) -> tuple[str, int, int]:
        if self.file is None:
            system, path = _open(self.folder)
            if self.count == 0:
                system.create_dir(path, recursive=True)
            self.name, self.at = f"{self.stem}-{self.count:04d}.{self.kind}", 0
            self.file = system.open_output_stream(f"{path}/{self.name}", compression=None)
            self.count += 1
        self.file.write(data)
        place = self.name, self.at, len(data)
        self.at += len(data)
        if self.at >= self.most:
            self.close()
        return place

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def with_originals(pages: DataFrame, least: int = LEAST, sent: int = SENT) -> DataFrame:
    """``page_id, url, html, size, digest, refers_to``.

    Groups of equal payloads are found by digest and size, without the payloads. Where they are few they are sent to
    the pages, which then move nowhere; else pages are dealt by digest, those of a large group in parts of even size.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.octet_length(html).alias("size"), F.sha1(html.cast("binary")).alias("digest"))
    shared = own.where(F.col("size") >= least).groupBy("digest", "size").agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialise(shared, "shared")
    groups, rows = shared.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if groups <= sent:
        joined = own.join(F.broadcast(shared), ["digest", "size"], "left")
    else:
        fair = max(rows // 256, 1000)
        hot = shared.where(F.col("n") > fair).select("digest", "size", F.ceil(F.col("n") / fair).cast("int").alias("parts"))  # under 256
        cut = lambda df: df.join(F.broadcast(hot), ["digest", "size"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        each = cut(shared).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        joined = cut(own).withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.col("parts")).cast("int")).join(each, ["digest", "size", "part"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original")).alias("refers_to")
    return joined.select("page_id", "url", "html", "size", "digest", refers)


def write(pages: DataFrame, folder: str, least: int = LEAST, archive: int = ARCHIVE, level: int = 3, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write archives to ``folder``; returns the table of captures (``CAPTURES``), already written."""

    def run(batches):
        files = _Files(folder, "warc.gz", archive)
        for b in batches:
            out = []
            for page, url, html, digest, refers in zip(*(column(b, c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")), strict=True):
                member = zlib.compressobj(level, wbits=31)
                raw = record(page, url, html.encode("utf-8", "surrogatepass"), digest, refers, date)
                out.append((capture_key(url, page), *files.put(member.compress(raw) + member.flush())))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["key", "path", "offset", "length"])
        files.close()

    return materialise(with_originals(pages, least).mapInArrow(run, CAPTURES), "captures")


def build_index(captures: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """Write the sorted, compressed blocks to ``folder``; returns their directory (``DIRECTORY``), already written."""

    def run(batches):
        files, held, done = _Files(folder, "cdx.zz", ARCHIVE), [], 0
        task = TaskContext.get().partitionId()

        def put(lines):
            nonlocal done
            done += 1
            text = "\n".join(f"{k} {p} {o} {n}" for k, p, o, n in lines).encode("utf-8", "surrogatepass")
            return f"{task:06d}-{done // SEGMENT:06d}", lines[0][0], lines[-1][0], *files.put(zlib.compress(text, 6)), len(lines)

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=[x.split()[0] for x in DIRECTORY.split(", ")])

        for b in batches:
            held += zip(*(column(b, c).to_pylist() for c in ("key", "path", "offset", "length")), strict=True)
            full = len(held) // block * block
            if full:
                yield batch([put(held[a : a + block]) for a in range(0, full, block)])
                held = held[full:]
        if held:
            yield batch([put(held)])
        files.close()

    return materialise(captures.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(run, DIRECTORY), "directory")


def keys(pages: DataFrame) -> DataFrame:
    """The capture key of each page, each once."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([capture_key(u, p) for u, p in zip(column(b, "url").to_pylist(), column(b, "page_id").to_pylist(), strict=True)], pa.string())], names=["key"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(run, "key string").distinct()


def lookup(wanted: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """The captures (``CAPTURES``) of the keys in ``wanted``, by binary search and range reads of blocks.

    The ends of the top level alone are sent to tasks: a row for ``FAN * SEGMENT * BLOCK`` captures (2 million), and one for each task
    that wrote the index. Keys meet the segments under their top row in a join by that row.
    """
    name = F.split("segment", "-")
    ends = directory.groupBy("segment").agg(F.min("first_key").alias("a"), F.max("last_key").alias("b"))
    ends = materialise(ends.withColumn("top", F.concat_ws("-", name[0], F.floor(name[1].cast("long") / FAN).cast("string"))), "segments")
    tops = sorted(tuple(r) for r in ends.groupBy("top").agg(F.min("a").alias("a"), F.max("b").alias("b")).select("a", "b", "top").collect())
    sent = wanted.sparkSession.sparkContext.broadcast(([e[0] for e in tops], [e[1] for e in tops], [e[2] for e in tops]))

    def deal(batches):
        first, last, names = sent.value
        for b in batches:
            out = [(names[i], k) for k in column(b, "key").to_pylist() for i in range(bisect_left(last, k), bisect_right(first, k))]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.string()) for i in (0, 1)], names=["top", "key"])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = sorted(right.select(["first_key", "last_key", "path", "offset", "length"]).to_pylist(), key=lambda r: r["first_key"])
        first, last = [r["first_key"] for r in rows], [r["last_key"] for r in rows]
        by_block: dict[int, set[str]] = {}
        for k in left["key"].to_pylist():
            for i in range(bisect_left(last, k), bisect_right(first, k)):
                by_block.setdefault(i, set()).add(k)
        system, root = _open(folder)
        out = []
        for i, own in sorted(by_block.items()):
            with system.open_input_file(f"{root}/{rows[i]['path']}") as f:
                text = zlib.decompress(f.read_at(rows[i]["length"], rows[i]["offset"])).decode("utf-8", "surrogatepass")
            for line in text.split("\n"):
                key, path, offset, length = line.rsplit(" ", 3)
                if key in own:
                    out.append((key, path, int(offset), int(length)))
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
        return pa.table({n: pa.array([x[i] for x in out], kinds[i]) for i, n in enumerate(("key", "path", "offset", "length"))})

    dealt = wanted.mapInArrow(deal, "top string, key string").join(ends, "top").where("key between a and b").select("segment", "key")
    return dealt.groupBy("segment").cogroup(directory.groupBy("segment")).applyInArrow(search, CAPTURES)


def fetch(captures: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """The records (``RECORD``, with ``payload`` its bytes too) at the captures' ranges.

    ``intact`` says whether a response's payload has its digest; a revisit's size and digest are those it names.
    """

    def run(batches):
        system, root = _open(folder)
        here = file = None
        for b in batches:
            out = []
            for path, offset, length in zip(*(column(b, c).to_pylist() for c in ("path", "offset", "length")), strict=True):
                if path != here:
                    if file is not None:
                        file.close()
                    here, file = path, system.open_input_file(f"{root}/{path}")
                fields, body = parse(zlib.decompress(file.read_at(length, offset), wbits=31))
                named = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
                full = fields["warc-type"] == "response"
                digest = hashlib.sha1(body).hexdigest() if full else named
                size = len(body) if full else int(fields["warc-payload-length"])
                refers = None if full else _number(fields["warc-refers-to"])
                out.append((_number(fields["warc-record-id"]), fields["warc-target-uri"], fields["warc-type"], size, digest, refers, digest == named, *[body] * payload))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), *[pa.binary()] * payload]
            names = [x.split()[0] for x in RECORD.split(", ")] + ["payload"] * payload
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kinds[i]) for i in range(len(kinds))], names=names)
        if file is not None:
            file.close()

    ordered = captures.repartition("path").sortWithinPartitions("path", "offset")
    return ordered.mapInArrow(run, RECORD + ", payload binary" * payload)


def archive(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """Write and index ``pages`` under ``folder`` (by default a fresh one in the shared folder): the directory, and the folder."""
    folder = folder or scratch(pages.sparkSession, "warc")
    return build_index(write(pages, f"{folder}/archive"), f"{folder}/index"), folder


def read_back(spark: SparkSession, wanted: DataFrame, directory: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """The records of the pages in ``wanted`` (``page_id``, ``url``), by way of the index."""
    return fetch(lookup(keys(wanted), directory, f"{folder}/index"), f"{folder}/archive", payload)
