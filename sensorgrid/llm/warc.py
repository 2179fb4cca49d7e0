"""Web archives: written as one gzip stream, normalised to a member a record, and read back by index."""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgrid.llm.common import staged
from sensorgrid.session import remove_path, ship_package, work_path

#: An archive is closed at the record with which it passes so many bytes before compression.
ARCHIVE_BYTES = 256 << 20
_READ = 1 << 20
#: Gzip level of the archive as one stream, and of records by themselves.
_STREAM_LEVEL, _MEMBER_LEVEL = 1, 4
_DATE = "2024-01-01T00:00:00Z"

_WRITTEN = "archive string, seq bigint, page_id bigint, digest string, size bigint"
_READ_BACK = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a path as Hadoop writes it."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    for scheme in ("s3a://", "s3n://"):
        if uri.startswith(scheme):
            uri = "s3://" + uri.removeprefix(scheme)
    return fs.FileSystem.from_uri(uri)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _from_urn(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(
    kind: str, page_id: int | None, url: str | None, digest: str, size: int, payload: bytes, refers_to: int | None = None
) -> bytes:
    """A record whose block is an HTTP answer; a revisit has the answer's head alone.

    The head tells the full payload's size in both. Line ends in a URL are percent-encoded.
    """
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {_DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_urn(refers_to)}")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """A record's fields, the fields of its HTTP head, and the payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(": ") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.lower(): value for name, _, value in pairs}


def _write_streams(folder: str, archive_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        # Names are an attempt's own. Those of attempts that failed appear in no committed table.
        stem = f"{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}"
        number, out, size, seq, name = 0, None, 0, 0, ""
        gz = None
        for batch in batches:
            rows = []
            columns = [batch.column(k).to_pylist() for k in ("page_id", "url")]
            for page_id, url, html in zip(*columns, batch.column("html").cast(pa.binary()), strict=True):
                payload = html.as_py() or b""
                if out is None:
                    name, seq, size = f"{stem}-{number}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                    gz = zlib.compressobj(_STREAM_LEVEL, wbits=31)
                digest = digest_of(payload)
                data = record("response", page_id, url, digest, len(payload), payload)
                out.write(gz.compress(data))
                rows.append((f"{folder}/{name}", seq, page_id, digest, len(payload)))
                seq, size = seq + 1, size + len(data)
                if size >= archive_bytes:
                    out.write(gz.flush())
                    out.close()
                    out, number = None, number + 1
            if rows:
                yield _batch(rows, _WRITTEN)
        if out is not None:
            out.write(gz.flush())
            out.close()

    return run


_TYPES = {"string": pa.string(), "bigint": pa.int64()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [part.split() for part in schema.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _TYPES[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        [name for name, _ in fields],
    )


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write each page as a response; an archive is one gzip stream. (archive, seq, page_id, digest, size).

    The result is what was written, and is staged: reading it again writes nothing again.
    """
    ship_package(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return staged(pages.mapInArrow(_write_streams(folder, archive_bytes), _WRITTEN), "archived")


def revisits(written: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(archive, seq, refers_to) of records whose payload an earlier record has.

    Of equal payloads of at least ``least_bytes`` bytes, the record with the smallest page_id is
    the earlier one, a null id last; if ids repeat, the first by archive and place.
    """
    key = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "archive", "seq")
    large = written.filter(F.col("size") >= least_bytes)
    firsts = large.groupBy("digest", "size").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = staged(firsts.filter("n > 1").select("digest", "size", "first"), "originals")
    again = large.join(firsts, ["digest", "size"]).filter(
        (F.col("archive") != F.col("first.archive")) | (F.col("seq") != F.col("first.seq"))
    )
    return again.select("archive", "seq", F.col("first.page_id").alias("refers_to"))


def _records(stream) -> Iterator[bytes]:
    """Records of an archive, inflated once and in order, whether one gzip member or many."""
    inflate, buffer, need = zlib.decompressobj(31), bytearray(), 0
    while True:
        data = stream.read(_READ)
        if not data:
            break
        while data:
            buffer += inflate.decompress(data)
            data = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)
        while len(buffer) >= max(need, 1):
            if not need:
                cut = buffer.find(b"\r\n\r\n")
                if cut < 0:
                    break
                need = cut + 8 + int(_fields(bytes(buffer[:cut]))["content-length"])
            if len(buffer) < need:
                break
            yield bytes(buffer[:need])
            del buffer[:need]
            need = 0
    if buffer:
        raise ValueError("the archive ends amid a record")


def _normalise(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in ("archive", "again"))
            for archive, again in zip(*columns, strict=True):
                known = {x["seq"]: x["refers_to"] for x in again or []}
                source, path = _open(archive)
                name = f"{attempt}-{archive.rpartition('/')[2]}"
                offset = 0
                with (
                    source.open_input_stream(path, compression=None) as stream,
                    store.open_output_stream(f"{base}/{name}", compression=None) as out,
                    store.open_output_stream(f"{base}/{name}.idx") as index,
                ):
                    for seq, data in enumerate(_records(stream)):
                        if seq in known:
                            fields, http, _ = parse(data)
                            data = record(
                                "revisit",
                                _from_urn(fields["warc-record-id"]),
                                fields.get("warc-target-uri"),
                                fields["warc-payload-digest"].removeprefix("sha1:"),
                                int(http["content-length"]),
                                b"",
                                known[seq],
                            )
                        gz = zlib.compressobj(_MEMBER_LEVEL, wbits=31)
                        member = gz.compress(data) + gz.flush()
                        out.write(member)
                        index.write((json.dumps({"offset": offset, "length": len(member)}) + "\n").encode())
                        offset += len(member)
                yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"]})

    return run


def normalise(archives: DataFrame, again: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives so that every record is a gzip member of its own; (archive) of the new ones.

    Each archive is inflated once, as a stream. Records named in ``again`` (archive, seq,
    refers_to) become revisits. Beside each new archive stands its index, a line a record with its
    offset and length. The list of new archives is staged.
    """
    lists = again.groupBy("archive").agg(F.collect_list(F.struct("seq", "refers_to")).alias("again"))
    jobs = archives.select("archive").distinct().join(lists, "archive", "left")
    jobs = staged(jobs, "normalise")
    spread = jobs.repartition(max(1, jobs.count()))
    return staged(spread.mapInArrow(_normalise(folder), "archive string"), "normalised")


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.column("archive").to_pylist():
            store, path = _open(archive)
            rows = []
            with store.open_input_file(path) as data, store.open_input_stream(f"{path}.idx") as index:
                for place in map(json.loads, _lines(index)):
                    data.seek(place["offset"])
                    fields, http, payload = parse(zlib.decompress(data.read(place["length"]), wbits=31))
                    digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
                    kind, refers_to = fields["warc-type"], None
                    if kind == "revisit":
                        refers_to = _from_urn(fields["warc-refers-to"])
                    elif (digest_of(payload), len(payload)) != (digest, size):
                        raise ValueError(f"{archive}, offset {place['offset']}: the payload is damaged")
                    rows.append((_from_urn(fields["warc-record-id"]), size, digest, kind, refers_to))
                    if len(rows) == 1000:
                        yield _batch(rows, _READ_BACK)
                        rows = []
            if rows:
                yield _batch(rows, _READ_BACK)


def _lines(stream) -> Iterator[bytes]:
    rest = b""
    while data := stream.read(_READ):
        *lines, rest = (rest + data).split(b"\n")
        yield from lines


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record by the indexes: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Responses are checked against their digest and size. Archives are spread over tasks.
    """
    archives = archives.select("archive")
    return archives.repartition(max(1, archives.count())).mapInArrow(_read, _READ_BACK)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Archive every page, normalise the archives, and read them back.

    A null html is an empty payload. Pages come back each, also if they repeat or have no id.
    No pages give no archives and no rows.
    """
    spark = pages.sparkSession
    streams, members = work_path(spark, "warc-streams"), work_path(spark, "warc")
    written = write_archives(pages, streams)
    new = normalise(written, revisits(written, least_bytes), members)
    remove_path(spark, streams)  # the normalised archives have all of it
    return read_archives(new)
