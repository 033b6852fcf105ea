"""WARC archives: writing, normalising monolithic gzip files, and reading by an offset index.

write_archives puts a record for each page into gzip files of a single stream, as many tools do; such
files can only be read from their start. normalise inflates each of them once, in chunks, and rewrites
every record as a gzip member of its own, beside a sidecar index with a JSON line for each record
(offset and length of its member, ids, type, digest). read_records needs only the index and the members that
it asks for.

Of pages with equal payloads of at least min_bytes the first (least page_id) is a response; the others
are revisits, which name it and carry the payload's digest and, in the HTTP header, its length.

Defined cases: a null html is an empty payload, a null url an empty target; line breaks in a url are
percent-encoded; payloads of any length are streamed record by record; of rows equal in page_id and payload one (of the least
url) is a response and the others revisits of the same id; a null page_id comes after all others, and where a payload has no other,
each such row is a response; an empty table gives no archives; other columns are ignored. Archives that are cut
off or whose lengths don't add up raise an error.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import BATCH_BYTES, bounded_batches, fresh_path, open_shared, tidy, written

CHUNK = 1 << 20
#: Uncompressed bytes after which a task starts its next archive.
ARCHIVE_BYTES = 256 << 20
MAX_BROADCAST_PAYLOADS = 500_000
ID = "urn:linkwright:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"  # pages carry no date; a fixed one keeps archives reproducible
INDEX_SCHEMA = "archive string, offset long, length long, id string, type string, digest string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool, serial: str) -> bytes:
    """A response or revisit record. serial makes ids of equal pages differ."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}:{serial}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url.replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head[4:4] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID}{refers_to}:>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _page(record_id: str) -> int | None:
    text = record_id.strip("<>").removeprefix(ID).split(":")[0]
    return int(text) if text else None


def inflated(file) -> Iterator[bytes]:
    """The bytes of a gzip file of any number of members, in chunks."""
    engine, open_member = zlib.decompressobj(31), False
    data = file.read(CHUNK)
    while data:
        out = engine.decompress(data, CHUNK)
        open_member = True
        if out:
            yield out
        if engine.eof:
            data, engine, open_member = engine.unused_data, zlib.decompressobj(31), False
        else:
            data = engine.unconsumed_tail
        if not data:
            data = file.read(CHUNK)
    if open_member:
        out = engine.flush()
        if out:
            yield out
        if not engine.eof:
            raise ValueError("the archive is cut off")


class _Stream:
    """Reads up to marks and lengths from an iterator of chunks."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.held = chunks, b""

    def more(self) -> bool:
        part = next(self.chunks, b"")
        self.held += part
        return bool(part)

    def until(self, mark: bytes) -> bytes | None:
        """The bytes before mark, which is passed over; None at the end."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                if self.held.strip():
                    raise ValueError("the archive is cut off")
                return None
        out, self.held = self.held[:at], self.held[at + len(mark) :]
        return out

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise ValueError("the archive is cut off")
            out, self.held = self.held[:n], self.held[n:]
            n -= len(out)
            yield out


def split_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Headers and bytes (in parts, header included) of each record; parts must be used up in turn."""
    stream = _Stream(chunks)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = headers_of(head)

        def parts(head=head, n=int(fields["content-length"])):
            yield head + b"\r\n\r\n"
            yield from stream.exactly(n)
            end = b"".join(stream.exactly(4))
            if end != b"\r\n\r\n":
                raise ValueError("a record's length is wrong")
            yield end

        yield fields, parts()


def normalise_file(source: str, target: str, index: str, level: int = 6) -> int:
    """Rewrite one archive; the number of its records."""
    n = offset = 0
    with open_shared(source, "rb") as f, open_shared(target, "wb") as out, open_shared(index, "wb") as side:
        for fields, parts in split_records(inflated(f)):
            engine, length = zlib.compressobj(level, zlib.DEFLATED, 31), 0
            for part in parts:
                length += out.write(engine.compress(part))
            length += out.write(engine.flush())
            line = {"archive": target, "offset": offset, "length": length, "id": fields["warc-record-id"], "type": fields["warc-type"], "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:")}
            side.write(json.dumps(line).encode() + b"\n")
            offset, n = offset + length, n + 1
    return n


def _revisits(rows: DataFrame, min_bytes: int) -> DataFrame:
    """page_id, url, payload, refers_to and revisit of every row. Rows equal in id, url and payload can't be told apart, so
    where the first of a payload is one of several such rows, it is made anew as a response and revisits."""
    big = F.octet_length("payload") >= min_bytes
    rows = rows.withColumn("sha", F.sha1("payload"))
    each = rows.filter(big).groupBy("sha", "page_id", "url").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id", "url", "n")).alias("first")
    again = each.groupBy("sha").agg(first, F.sum("n").alias("n")).filter("n > 1 and first.page_id is not null")
    again = written(again.select("sha", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("first_url"), F.col("first.n").alias("copies")), "warc-payloads")
    found = F.broadcast(again) if again.count() <= MAX_BROADCAST_PAYLOADS else again
    rows = rows.join(found, "sha", "left").withColumn("is_first", F.coalesce((F.col("page_id") == F.col("refers_to")) & (F.col("url") == F.col("first_url")), F.lit(False)))
    columns = ["page_id", "url", "payload", "refers_to"]
    alone = ~F.col("is_first") | (F.col("copies") == 1)
    out = rows.filter(alone).select(*columns, (F.col("refers_to").isNotNull() & ~F.col("is_first")).alias("revisit"))
    if again.filter("copies > 1").head(1):
        one = rows.filter(~alone).dropDuplicates(["sha", "page_id", "url"])
        out = out.unionByName(one.select(*columns, F.explode(F.transform(F.sequence(F.lit(1).cast("long"), "copies"), lambda k: k > 1)).alias("revisit")))
    return out


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write pages as monolithic archives below folder; path and n_records of each."""
    html = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url"), F.lit("")).alias("url"), html.alias("payload"))
    rows = _revisits(rows, min_bytes)
    schema = pa.schema([("path", pa.string()), ("n_records", pa.int64())])

    def write(batches):
        out, done, size, n, path = None, [], 0, 0, ""

        def close():
            out.write(engine.flush())
            out.close()
            done.append((path, n))

        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(5))):
                page_id, url, payload, refers_to, revisit = (x.as_py() for x in row)
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out, engine, size, n = open_shared(path, "wb"), zlib.compressobj(3, zlib.DEFLATED, 31), 0, 0
                data = record(page_id, url, payload, refers_to, bool(revisit), uuid.uuid4().hex if revisit or page_id is None else "")
                out.write(engine.compress(data))
                size, n = size + len(data), n + 1
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], schema.types[i]) for i in range(2)], schema=schema)

    return written(rows.mapInArrow(tidy(write), "path string, n_records long"), "warc-raw")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Normalise every archive of the column path, dealt evenly, one to a task; archive, index and n_records of each.
    A task that runs again writes files of its own, and only the files it reports count."""
    schema = pa.schema([("archive", pa.string()), ("index", pa.string()), ("n_records", pa.int64())])

    def run(batches):
        for batch in batches:
            for source in batch.column("path").to_pylist():
                name = uuid.uuid4().hex
                target, index = f"{folder}/archives/{name}.warc.gz", f"{folder}/index/{name}.json"
                n = normalise_file(source, target, index)
                yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([index]), pa.array([n])], schema=schema)

    dealt = archives.select("path").repartition(max(1, archives.count()))
    return written(dealt.mapInArrow(tidy(run), "archive string, index string, n_records long"), "warc-normalised")


def read_index(spark: SparkSession, archives: DataFrame, folder: str) -> DataFrame:
    """The sidecar lines of the archives named (others in the folder are of tasks that ran again)."""
    if not archives.head(1):
        return spark.createDataFrame([], INDEX_SCHEMA)
    lines = spark.read.schema(INDEX_SCHEMA).json(f"{folder}/index")
    return lines.join(archives.select("archive"), "archive", "left_semi")


RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
_KINDS = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}


def _parsed(data: bytes) -> dict:
    """The fields of RECORD from a record's bytes. The digest of a payload is computed and compared."""
    head, _, block = data[:-4].partition(b"\r\n\r\n")
    fields = headers_of(head)
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    said = fields["warc-payload-digest"].removeprefix("sha1:")
    digest = said if revisit else base32_sha1(payload)
    if digest != said:
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    http_fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode().split("\r\n"))}
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": fields["warc-target-uri"],
        "record_type": fields["warc-type"],
        "refers_to": _page(fields["warc-refers-to"]) if revisit else None,
        "payload_bytes": int(http_fields["content-length"]) if revisit else len(payload),
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


def read_records(index: DataFrame, columns: tuple[str, ...] = tuple(RECORD.names)) -> DataFrame:
    """Columns of RECORD (payload is null for revisits) of the records in the index, each read from its own member. Only the
    columns asked for leave the worker, and rows leave as soon as they are some 4 MB."""
    schema = pa.schema([RECORD.field(c) for c in columns])

    def read(batches):
        name, file, rows, held = None, None, [], 0

        def out():
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != name:
                    if file is not None:
                        file.close()
                    name, file = archive, open_shared(archive, "rb")
                file.seek(offset)
                row = _parsed(zlib.decompress(file.read(length), 31))
                rows.append({c: row[c] for c in columns})
                held += len(rows[-1].get("payload") or b"")
                if held > BATCH_BYTES or len(rows) >= 2000:
                    yield out()
                    rows, held = [], 0
        yield out()
        if file is not None:
            file.close()

    kinds = ", ".join(f"{f.name} {_KINDS[f.type]}" for f in schema)
    return index.sortWithinPartitions("archive", "offset").mapInArrow(tidy(read), kinds)


def through_archives(pages: DataFrame, min_bytes: int = 0, columns: tuple[str, ...] = tuple(RECORD.names)) -> DataFrame:
    """Write pages as archives, normalise them, and read the records back by their index."""
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = fresh_path(spark, "warc")
    raw = write_archives(pages, f"{folder}/raw", min_bytes)
    archives = normalise(raw, folder)
    return read_records(read_index(spark, archives, folder), columns)
