"""WARC archives of pages, and a two-level capture index over them.

Writing: every page is one gzip member of an archive. Pages with equal payloads are written once,
as a response; the others are revisit records that refer to it.

Index: captures are sorted by key (the URL with its host reversed) and written in shards, each a run
of compressed blocks of lines; beside a shard lies its sparse directory with the first key of every
block. A search finds the shard, then the block in the shard's directory, both by bisection, reads
that byte range, and bisects its lines. Captures are read from the archives by their byte ranges.

Tasks write files under names of their own and report them in their rows; only files in the rows of
successful tasks exist for later steps, so lost or repeated tasks leave nothing that counts. All
files lie in the shared folder and are opened by URI.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import uuid
import zlib
from collections import OrderedDict
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.work import column, partitions, steps, stored
from millrace.session import fresh_dir

# --- fixed values of the formats ------------------------------------------------------------------
WARC_VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# --------------------------------------------------------------------------------------------------
_ARCHIVE_BYTES = 256 << 20
_READ_BYTES = 4 << 20
_SAFE = "!$%&'()*+,-./:;=?@[]_~#{}|^`<>\"\\"


def _opened(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a full URI of the file system that Spark resolves it to."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = str(target.makeQualified(system.getUri(), system.getWorkingDirectory()))
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def surt_key(url: str | None) -> str:
    """Sort key of a URL: reversed host, then path and query; control characters are escaped.

    ``http://www.example.com:80/a?b#c`` gives ``com,example,www)/a?b``. What is no URL is its own key,
    null is the empty key.
    """
    url = "".join(c if ord(c) > 32 and ord(c) != 127 else quote(c) for c in url or "")
    try:
        parts = urlsplit(url)
        host = parts.hostname
    except ValueError:
        return url
    if not host:
        return url
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str
) -> bytes:
    """One uncompressed WARC record: an HTTP response, or a revisit with the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}"
    head = [
        WARC_VERSION.decode(), f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{name}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe=_SAFE)}", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC header, HTTP header, payload) of one record; header names in lower case."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != WARC_VERSION.decode():
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    warc = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    answer = {k.lower(): v for k, v in (line.split(": ", 1) for line in http.decode().split("\r\n")[1:])}
    return warc, answer, payload


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _plain(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


def write_archives(
    pages: DataFrame, folder: str, least: int = 100, date: str = "2020-01-01T00:00:00Z",
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """Write a record per page below ``folder``; (page_id, key, file, offset, length) of each.

    Of pages whose equal payload has at least ``least`` bytes the smallest id is the response (all
    its rows if it is repeated); rows with a null id can only refer. A null html is an empty payload.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("text"),
        F.sha2(payload, 256).alias("digest"),
    )
    first = (
        rows.where(F.octet_length("text") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "first")
    )
    rows = rows.join(first, "digest", "left").select(
        "id", "url", "text", "digest", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("refers")
    )

    def written(batches):
        out, at, name, system = None, 0, "", None
        try:
            for batch in steps(batches):
                found = []
                names = ("id", "url", "text", "digest", "refers")
                for doc, url, text, digest, refers in zip(*(column(batch, c).to_pylist() for c in names)):
                    if out is None or at > _ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        system, path = _opened(f"{folder}/{name}")
                        system.create_dir(path.rpartition("/")[0])
                        out = system.open_output_stream(path, compression=None)
                    data = _member(record(doc, url, text.encode("utf-8", "surrogatepass"), digest, refers, date))
                    out.write(data)
                    found.append((doc, surt_key(url), name, at, len(data)))
                    at += len(data)
                if found:
                    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), kind) for c, kind in zip(zip(*found), kinds)],
                        ["page_id", "key", "file", "offset", "length"],
                    )
        finally:
            if out is not None:
                out.close()

    schema = "page_id long, key string, file string, offset long, length long"
    return stored(rows.mapInArrow(written, schema), "captures")


def write_index(captures: DataFrame, folder: str, block_lines: int = 3000) -> list[dict]:
    """Sort captures into shards of compressed blocks below ``folder``; the shards with their key ranges.

    The list has an entry per written partition, so its length follows the number of partitions, not
    of captures. Equal keys may span blocks and shards.
    """
    n = partitions(captures.sparkSession)
    order = ["key", "file", "offset"]
    rows = captures.select(*order, "length").repartitionByRange(n, *order).sortWithinPartitions(*order)

    def written(batches):
        name, lines, blocks, at = uuid.uuid4().hex, [], [], 0
        out = None

        def flush(some):
            nonlocal at, out
            if out is None:
                system, path = _opened(f"{folder}/{name}.idx.gz")
                system.create_dir(path.rpartition("/")[0])
                out = system.open_output_stream(path, compression=None)
            data = _member("\n".join(some).encode("utf-8", "surrogatepass"))
            out.write(data)
            blocks.append((some[0].split("\t", 1)[0], at, len(data)))
            at += len(data)

        last = ""
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                lines.append("\t".join(map(str, row)))
                last = row[0]
                if len(lines) == block_lines:
                    flush(lines)
                    lines = []
        if lines:
            flush(lines)
        if out is None:
            return
        out.close()
        system, path = _opened(f"{folder}/{name}.dir.gz")
        with system.open_output_stream(path, compression=None) as directory:
            directory.write(_member(json.dumps(blocks).encode()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([blocks[0][0]]), pa.array([last])], ["shard", "first", "last"]
        )

    found = stored(rows.mapInArrow(written, "shard string, first string, last string"), "index-shards")
    return sorted((r.asDict() for r in found.collect()), key=lambda r: (r["first"], r["last"]))


class _Directories:
    """Directories of a few shards, as sorted first keys with byte ranges."""

    def __init__(self, folder: str, keep: int = 4):
        self.folder, self.keep = folder, keep
        self.known: OrderedDict[str, tuple[list[str], list]] = OrderedDict()

    def blocks(self, shard: str, key: str) -> list[tuple[int, int]]:
        """Byte ranges of the blocks that may hold ``key``."""
        if shard not in self.known:
            system, path = _opened(f"{self.folder}/{shard}.dir.gz")
            with system.open_input_file(path) as file:
                found = json.loads(_plain(file.read()))
            self.known[shard] = [b[0] for b in found], found
            if len(self.known) > self.keep:
                self.known.popitem(last=False)
        firsts, found = self.known[shard]
        low, high = max(0, bisect.bisect_left(firsts, key) - 1), bisect.bisect_right(firsts, key)
        return [(offset, length) for _, offset, length in found[low:high]]


def lookup(keys: DataFrame, shards: list[dict], folder: str, key_col: str = "key") -> DataFrame:
    """(key, file, offset, length) of all captures of the distinct keys."""
    spark = keys.sparkSession
    wanted = keys.select(F.col(key_col).alias("key")).where("key IS NOT NULL").distinct()
    wanted = wanted.repartitionByRange(partitions(spark), "key").sortWithinPartitions("key")
    firsts = [s["first"] for s in shards]

    def located(batches):
        directories = _Directories(folder)
        for batch in batches:
            found = []
            for key in column(batch, "key").to_pylist():
                # A shard begins no later than the key it holds and ends no earlier.
                at = bisect.bisect_right(firsts, key) - 1
                while at >= 0 and shards[at]["last"] >= key:
                    found += [(key, shards[at]["shard"], *block) for block in directories.blocks(shards[at]["shard"], key)]
                    at -= 1
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c)) for c in zip(*found)], ["key", "shard", "at", "size"]
                )

    ranges = keys.sparkSession.createDataFrame([], "key string, file string, offset long, length long")
    if not shards:
        return ranges
    # The distinct keys of one block are at most its lines.
    blocks = (
        wanted.mapInArrow(located, "key string, shard string, at long, size long")
        .groupBy("shard", "at", "size").agg(F.collect_set("key").alias("keys"))
    )

    def searched(batches):
        for batch in batches:
            for shard, at, size, keys_of in zip(*(c.to_pylist() for c in batch.columns)):
                system, path = _opened(f"{folder}/{shard}.idx.gz")
                with system.open_input_file(path) as file:
                    lines = _plain(file.read_at(size, at)).decode("utf-8", "surrogatepass").split("\n")
                found = []
                for key in keys_of:
                    low = bisect.bisect_left(lines, f"{key}\t")
                    while low < len(lines) and lines[low].startswith(f"{key}\t"):
                        _, file_name, offset, length = lines[low].split("\t")
                        found.append((key, file_name, int(offset), int(length)))
                        low += 1
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c)) for c in zip(*found)], ["key", "file", "offset", "length"]
                    )

    return blocks.select("shard", "at", "size", "keys").mapInArrow(searched, ranges.schema)


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) read by byte ranges.

    Neighbouring ranges of an archive are read together, up to a few megabytes at once. A response's
    size and digest are those of the bytes read and must agree with its header.
    """
    part = F.floor(F.col("offset") / _READ_BYTES)
    rows = captures.select("file", "offset", "length", part.alias("part"))
    rows = rows.repartition(partitions(captures.sparkSession), "file", "part").sortWithinPartitions("file", "offset")

    def read(batches):
        for batch in batches:
            table = list(zip(*(column(batch, c).to_pylist() for c in ("file", "offset", "length"))))
            at = 0
            while at < len(table):
                name, start, _ = table[at]
                end = at
                while end < len(table) and table[end][0] == name and (
                    end == at or sum(table[end][1:]) - start <= _READ_BYTES
                ):
                    end += 1
                system, path = _opened(f"{folder}/{name}")
                with system.open_input_file(path) as file:
                    data = file.read_at(sum(table[end - 1][1:]) - start, start)
                found = [_row(_plain(data[offset - start : offset - start + length])) for _, offset, length in table[at:end]]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), kind) for c, kind in zip(zip(*found), kinds)],
                    ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )
                at = end

    return rows.mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def _page(name: str | None) -> int | None:
    return int(name[len("<urn:page:") : -1]) if name and name.startswith("<urn:page:") else None


def _row(data: bytes) -> tuple:
    warc, http, payload = parse_record(data)
    digest, kind = warc["warc-payload-digest"].removeprefix("sha256:"), warc["warc-type"]
    size = int(http["content-length"])
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {warc['warc-record-id']} differs from its digest")
    return _page(warc["warc-record-id"]), warc["warc-target-uri"], size, digest, kind, _page(warc.get("warc-refers-to"))


def round_trip(pages: DataFrame, folder: str | None = None, **columns) -> DataFrame:
    """Write and index the pages, look all their keys up again and read the records back."""
    spark = pages.sparkSession
    folder = qualified(spark, folder or fresh_dir(spark, "llm-warc"))
    captures = write_archives(pages, f"{folder}/archive", **columns)
    shards = write_index(captures, f"{folder}/index")
    return read_records(lookup(captures, shards, f"{folder}/index"), f"{folder}/archive")
