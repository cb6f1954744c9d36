"""WARC archives with a two-level capture index: sorted host keys in compressed blocks under a sparse block directory."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import fresh_dir, settle

BLOCK_LINES = 3_000
#: Index lines and archive bytes for which one task is planned; small inputs get the session's shuffle partitions.
PART_LINES = 300_000
TASK_BYTES = 64 << 20
LEVEL = 4
URN = "urn:page:"
NO_URL = "about:blank"

CAPTURE = "surt string, page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, file string, offset bigint, length bigint"
CAPTURES = pa.schema(
    [("surt", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64())]
    + [("payload_digest", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)
DIRECTORY = "part int, first_key string, last_key string, n_lines bigint, file string, offset bigint, length bigint"
RECORD = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
RECORDS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    + [("refers_to", pa.int64()), ("payload", pa.binary())]
)
DATE = "2000-01-01T00:00:00Z"


def surt(url: Column) -> Column:
    """Sort key of a URL: host labels reversed and lower-cased, then port, path and query; scheme, user and fragment go.

    A null URL or one without a host gets the whole text (null: empty) after a closing bracket, so it still has a key.
    """
    url = F.coalesce(url.cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    port = F.regexp_extract(url, r"^[^/]*//[^/?#]*?(:[0-9]+)(?:[/?#]|$)", 1)
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), port, F.lit(")"), F.when(rest == "", "/").otherwise(rest))
    return F.when(host == "", F.concat(F.lit(")"), url)).otherwise(key)


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class Output:
    """A file that appears under its final name only when complete, so that a task attempt that dies leaves none."""

    def __init__(self, folder: str, name: str) -> None:
        self.store, root = open_store(folder)
        self.store.create_dir(root, recursive=True)
        self.final, self.draft = f"{root}/{name}", f"{root}/_draft-{uuid.uuid4().hex}"
        self.stream, self.at = self.store.open_output_stream(self.draft, compression=None), 0

    def write(self, data: bytes) -> int:
        at, self.at = self.at, self.at + len(data)
        self.stream.write(data)
        return at

    def close(self) -> None:
        self.stream.close()
        self.store.move(self.draft, self.final)


def own_name() -> str:
    """A file name of this task attempt alone: what a retried or speculative attempt writes is never mixed in."""
    task = TaskContext.get()
    return f"part-{task.partitionId():06d}-{task.taskAttemptId()}"


def header_text(value: str) -> str:
    """A header value on one line: control characters, blanks and percent signs are percent-encoded."""
    return "".join(c if c > " " and c not in "%\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def header_value(text: str) -> str:
    from urllib.parse import unquote

    return unquote(text, errors="strict")


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, refers_url: str | None) -> bytes:
    """One gzip member. A revisit keeps the HTTP header, which tells the payload's size, and leaves the payload out."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>"]
    lines += [f"WARC-Date: {DATE}", f"WARC-Target-URI: {NO_URL if url is None else header_text(url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{URN}{refers_to}>"]
        lines += [f"WARC-Refers-To-Target-URI: {NO_URL if refers_url is None else header_text(refers_url)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", LEVEL, mtime=0)


def parse(member: bytes) -> dict:
    """The fields of one record; checks lengths and, for a response, the payload's digest."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    length = int(fields["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's length does not fit its content")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    size = int(http.decode().rpartition("Content-Length: ")[2])
    number = lambda text: int(x) if (x := text.removeprefix(f"<{URN}").removesuffix(">")) else None
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError("a payload does not fit its digest")
    url = fields["WARC-Target-URI"]
    return {
        "page_id": number(fields["WARC-Record-ID"]), "url": None if url == NO_URL else header_value(url), "record_type": fields["WARC-Type"], "payload_bytes": size,
        "payload_digest": digest, "refers_to": number(fields["WARC-Refers-To"]) if revisit else None, "payload": None if revisit else payload,
    }


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_responses(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages with ``refers_to``: the greatest page_id of those with an equal payload, null for that page itself.

    Payloads under ``least`` bytes refer to none. Only digests are grouped, and only payloads of several pages are
    joined back, so a payload that many pages share is one row on the joined side.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.encode("html", "UTF-8")))).withColumn("size", F.octet_length("html").cast("bigint"))
    shared = rows.where(F.col("size") >= least).groupBy(F.col("digest").alias("of"), F.col("size").alias("of_size"))
    shared = shared.agg(F.max(F.struct("page_id", "url")).alias("top"), F.count("*").alias("n")).where("n > 1")
    joined = rows.join(settle(shared, "responses"), (F.col("digest") == F.col("of")) & (F.col("size") == F.col("of_size")), "left")
    other = F.col("top.page_id") != F.coalesce("page_id", F.col("top.page_id") - 1)
    return joined.select("page_id", "url", "html", surt(F.col("url")).alias("surt"), *[F.when(other, F.col(f"top.{c}")).alias(n) for c, n in (("page_id", "refers_to"), ("url", "refers_url"))])


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Writes one archive per task below ``folder`` and returns the captures, one row per record, as a written table.

    A null html is an empty payload. Pages that repeat the id of their payload's response are responses as well; pages
    without an id can only refer. Captures name the archives of the attempts that counted; others are never read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out = f"{own_name()}.warc.gz", None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                done = []
                for r in batch.slice(at, 500).to_pylist():
                    out = out or Output(folder, name)
                    payload = r["html"].encode()
                    digest = digest_of(payload)
                    member = record(r["page_id"], r["url"], payload, len(payload), digest, r["refers_to"], r["refers_url"])
                    kind = "response" if r["refers_to"] is None else "revisit"
                    done.append({"surt": r["surt"], "page_id": r["page_id"], "url": r["url"], "record_type": kind, "payload_bytes": len(payload), "payload_digest": digest, "refers_to": r["refers_to"], "file": name, "offset": out.write(member), "length": len(member)})
                yield pa.RecordBatch.from_pylist(done, schema=CAPTURES)
        if out:
            out.close()

    return settle(with_responses(pages, least).mapInArrow(write, CAPTURE), "captures")


def _tasks(df: DataFrame, least: float) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(least))


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sorts captures by key into compressed blocks of ``block_lines`` lines; returns the block directory, written.

    Keys are cut into ranges over all tasks; a key with very many captures is spread by page id. A directory row has
    the first and last key of a block and where it lies, so a reader finds a key's blocks without touching others.
    """
    fields = [f.name for f in CAPTURES]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, lines = TaskContext.get().partitionId(), None, []
        schema = pa.schema([("part", pa.int32()), ("first_key", pa.string()), ("last_key", pa.string()), ("n_lines", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(lines).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, CAPTURES) as stream:
                stream.write_table(table)
            data = zlib.compress(sink.getvalue().to_pybytes(), LEVEL)
            keys = table["surt"]
            row = {"part": part, "first_key": keys[0].as_py(), "last_key": keys[-1].as_py(), "n_lines": len(keys), "file": name, "offset": out.write(data), "length": len(data)}
            lines.clear()
            return pa.RecordBatch.from_pylist([row], schema=schema)

        name = f"{own_name()}.cdx"
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                out = out or Output(folder, name)
                lines.append(batch.slice(at, block_lines - sum(b.num_rows for b in lines)).cast(CAPTURES))
                at += lines[-1].num_rows
                if sum(b.num_rows for b in lines) == block_lines:
                    yield flush()
        if lines:
            yield flush()
        if out:
            out.close()

    ordered = captures.select(*fields).repartitionByRange(_tasks(captures, captures.count() / PART_LINES), "surt", "page_id").sortWithinPartitions("surt", "page_id", "file", "offset")
    return settle(ordered.mapInArrow(write, DIRECTORY), "directory")


def _read_at(stores: dict, folder: str, name: str, offset: int, length: int) -> bytes:
    if name not in stores:
        store, root = open_store(folder)
        stores.clear()  # one open file at a time; rows come by file
        stores[name] = store.open_input_file(f"{root}/{name}")
    return stores[name].read_at(length, offset)


def captures_in(directory: DataFrame, folder: str) -> DataFrame:
    """All captures of the directory's blocks, read by range."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores: dict = {}
        for batch in batches:
            for r in batch.to_pylist():
                yield from _block(stores, folder, r).to_batches()

    return directory.mapInArrow(read, CAPTURE)


def _block(stores: dict, folder: str, r: dict) -> pa.Table:
    return pa.ipc.open_stream(zlib.decompress(_read_at(stores, folder, r["file"], r["offset"], r["length"]))).read_all()


def captures_of(directory: DataFrame, folder: str, keys: DataFrame) -> DataFrame:
    """Captures of the keys (column surt), found by three binary searches: part of the index, block, line.

    The first and last key of each part of the index (as many rows as the index has files) go to all tasks, which send
    every key to the parts that can hold it. There a key's blocks are found in the part's directory rows, and its lines
    in each such block. Blocks without a key that falls between their first and last are never read. A key with
    captures in several blocks or parts gets them all; repeated keys count once, null and unknown ones find nothing.
    """
    ends = directory.groupBy("part").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high")).orderBy("part").collect()
    low, high, parts = ([r[c] for r in ends] for c in ("low", "high", "part"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, str]] = []
            for key in batch["surt"].to_pylist():
                # Parts are in order of keys, so those that can hold one are neighbours.
                out += [(parts[p], key) for p in range(bisect_left(high, key), bisect_right(low, key))]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int32()), pa.array([k for _, k in out], pa.string())], names=["part", "surt"])

    def search(wanted: pa.Table, blocks: pa.Table) -> pa.Table:
        rows = blocks.sort_by("offset").to_pylist()
        first, last, asked = [r["first_key"] for r in rows], [r["last_key"] for r in rows], {}
        for key in sorted(set(wanted["surt"].to_pylist())):
            for b in range(bisect_left(last, key), bisect_right(first, key)):
                asked.setdefault(b, []).append(key)
        stores: dict = {}
        out = []
        for b, own in sorted(asked.items()):
            table = _block(stores, folder, rows[b])
            lines = table["surt"].to_pylist()
            at = [i for key in own for i in range(bisect_left(lines, key), bisect_right(lines, key))]
            out.append(table.take(pa.array(at, pa.int64())))
        return pa.concat_tables(out) if out else pa.Table.from_batches([], CAPTURES)

    routed = keys.select("surt").where("surt IS NOT NULL").distinct().mapInArrow(route, "part int, surt string")
    return routed.groupBy("part").cogroup(directory.groupBy("part")).applyInArrow(search, CAPTURE)


def records_at(captures: DataFrame, folder: str) -> DataFrame:
    """Parsed records of captures, a written table, by range reads ordered by archive and offset.

    The number of tasks follows from the bytes to be read, not from the size of the rows that name them.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores: dict = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500).to_pylist()
                yield pa.RecordBatch.from_pylist([parse(_read_at(stores, folder, r["file"], r["offset"], r["length"])) for r in rows], schema=RECORDS)

    size = captures.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    places = captures.select("file", "offset", "length").repartitionByRange(_tasks(captures, size / TASK_BYTES), "file", "offset")
    return places.sortWithinPartitions("file", "offset").mapInArrow(read, RECORD)


def lookup(directory: DataFrame, index_folder: str, archive_folder: str, urls: DataFrame) -> DataFrame:
    """Records of the given URLs (column url): part, block and line of the index, then archive ranges. Revisits have no
    payload of their own."""
    found = captures_of(directory, index_folder, urls.select(surt(F.col("url")).alias("surt")))
    return records_at(settle(found, "found"), archive_folder)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes archives and index of all pages to the shared folder and reads every record back by its key.

    Null URLs have a key like others and null payloads are empty; rows that repeat are records of their own; an empty
    table gives an empty one. Rows of one key are found together, however many they are.
    """
    root = fresh_dir(pages.sparkSession, "warc")
    captures = write_archives(pages, f"{root}/archives")
    directory = write_index(captures, f"{root}/index")
    found = lookup(directory, f"{root}/index", f"{root}/archives", pages.select(F.col("url").cast("string").alias("url")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
