"""WARC archives: written as monolithic gzip, normalised to a member a record with a sidecar offset index, and read back."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_dir

END = b"\r\n\r\n"
GZIP = 31  # zlib's window bits for gzip members
SALTS = 16
#: Up to so many repeated payloads (a digest and an id each) are broadcast; more are joined over a shuffle.
BROADCAST_ROWS = 100_000


def file_system(uri: str):
    """(pyarrow file system, path in it) of a folder or file of Spark's."""
    from pyarrow import fs

    if re.match(r"file:/(?!//)", uri):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def base32_sha1(data: str | Column) -> Column:
    """The SHA-1 of a column as bare upper-case base32: four times 40 bits, that is 10 hex digits or 8 of base 32."""
    parts = [F.lpad(F.conv(F.substring(F.sha1(data), 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_roles(pages: DataFrame, id_col: str, payload: Column, least_bytes: int = 0) -> DataFrame:
    """pages with payload, digest, n_bytes and refers_to: the smallest id of the equal payloads, null for that row itself.

    The smallest ids are found on digests alone, and only those of repeated payloads come back. They are counted: few are
    broadcast, so no payload moves; many are spread over salts, so one payload may be any share of the rows. Payloads under
    least_bytes, and those without any id, refer to none.
    """
    rows = pages.withColumn("payload", payload).withColumn("digest", base32_sha1("payload")).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    first = cut(rows.groupBy("digest").agg(F.min(id_col).alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n"))
    if first.count() <= BROADCAST_ROWS:
        joined = rows.withColumn("salt", F.lit(0)).join(F.broadcast(first), "digest", "left")
    else:
        spread = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int")).join(spread, ["digest", "salt"], "left")
    refers = F.when((F.col("n_bytes") >= least_bytes) & ~F.col(id_col).eqNullSafe(F.col("first_id")), F.col("first_id"))
    return joined.withColumn("refers_to", refers).drop("salt", "first_id")


def record(id_col: str, url_col: str) -> Column:
    """The text of a row's WARC record but for its last line feed. A revisit has no payload, only that of its response named."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(F.col("refers_to").isNull(), F.concat(http, "payload")).otherwise(http)
    url = F.regexp_replace(F.coalesce(url_col, F.lit("urn:x-none")), r"[\r\n]", "%0A")
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(F.col("refers_to").isNull(), F.lit("response")).otherwise(F.lit("revisit")),
        F.lit("\r\nWARC-Record-ID: <urn:x-page:"), name, F.lit(">\r\nWARC-Date: 2000-01-01T00:00:00Z\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), "digest",
        F.lit("\r\nWARC-Payload-Length: "), F.col("n_bytes").cast("string"),
        F.when(F.col("refers_to").isNull(), F.lit("")).otherwise(
            F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:x-page:"), F.col("refers_to").cast("string"), F.lit(">"))
        ),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, block, F.lit("\r\n\r"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> None:
    """A WARC record for every row, in files that are each one gzip stream: Spark's text writer makes them, on any file system."""
    rows = with_roles(pages.select(id_col, url_col, html_col), id_col, F.coalesce(html_col, F.lit("")), least_bytes)
    rows.select(record(id_col, url_col).alias("value")).write.option("lineSep", "\n").option("compression", "gzip").text(folder)


def inflated(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a gzip file of one member or several, piece by piece; a file that is cut short raises an error."""
    z, inside = zlib.decompressobj(GZIP), False
    while data := stream.read(size):
        while data:
            inside = True
            yield z.decompress(data)
            if not z.eof:
                break
            data, z, inside = z.unused_data, zlib.decompressobj(GZIP), False
    if inside:
        raise EOFError("the gzip stream is cut short")


def records(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, whole record) of each WARC record, holding little more than one record at a time."""
    held = bytearray()
    need, fields = 0, None
    for part in parts:
        held += part
        while True:
            if fields is None:
                end = held.find(END)
                if end < 0:
                    break
                fields = dict(line.split(": ", 1) for line in held[:end].decode().split("\r\n")[1:])
                need = end + len(END) + int(fields["Content-Length"]) + len(END)
            if len(held) < need:
                break
            yield fields, bytes(held[:need])
            del held[:need]
            fields = None
    if held:
        raise EOFError("the last record is cut short")


def normalise(spark: SparkSession, folder: str, out: str) -> None:
    """Every gzip file of folder anew in out, with a gzip member for each record and a sidecar, its name plus .idx: lines of
    offset, length, record id and type. Each file is inflated once, as a stream. A file is written under another name
    and then moved, so a repeated or doubled task leaves whole files only."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path")

    def run(batches):
        for b in batches:
            done = []
            for path in b.column(0).to_pylist():
                source, at = file_system(path)
                target, root = file_system(out)
                name, trial = at.rsplit("/", 1)[-1].split(".")[0] + ".warc.gz", f".{uuid.uuid4().hex}"
                offset, lines = 0, []
                with source.open_input_stream(at, compression=None) as stream, target.open_output_stream(f"{root}/{trial}", compression=None) as sink:
                    for fields, whole in records(inflated(stream)):
                        z = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                        member = z.compress(whole) + z.flush()
                        sink.write(member)
                        lines.append(f"{offset}\t{len(member)}\t{fields['WARC-Record-ID']}\t{fields['WARC-Type']}\n")
                        offset += len(member)
                with target.open_output_stream(f"{root}/{trial}.idx", compression=None) as sink:
                    sink.write("".join(lines).encode())
                target.move(f"{root}/{trial}", f"{root}/{name}")
                target.move(f"{root}/{trial}.idx", f"{root}/{name}.idx")
                done.append((name, len(lines)))
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["archive", "n"])

    target, root = file_system(out)
    target.create_dir(root)
    files.mapInArrow(run, "archive string, n long").write.format("noop").mode("overwrite").save()


def read_archives(spark: SparkSession, folder: str, id_kind: str = "bigint") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and payload for every record that the sidecars of folder list.

    Each record is read at its offset and inflated on its own; a response's digest and size are those of the bytes read and
    must be those written in it. A revisit's are those of the payload it refers to, and its payload is null.
    """
    index = spark.read.schema("value string").option("pathGlobFilter", "*.idx").text(folder).select("value", F.col("_metadata.file_path").alias("path"))
    found = index.select("path", F.split("value", "\t").alias("f")).select("path", F.col("f")[0].cast("long").alias("offset"), F.col("f")[1].cast("long").alias("length"))

    def run(batches):
        for b in batches:
            out, last, source = [], None, None
            for path, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                if path != last:
                    if source:
                        source.close()
                    fs, at = file_system(path.removesuffix(".idx"))
                    source, last = fs.open_input_file(at), path
                source.seek(offset)
                fields, whole = next(records(iter([zlib.decompress(source.read(length), GZIP)])))
                block = whole[whole.index(END) + len(END) : -len(END)]
                digest, size, payload = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["WARC-Payload-Length"]), None
                if fields["WARC-Type"] == "response":
                    payload = block[block.index(END) + len(END) :]
                    if (base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)) != (digest, size):
                        raise ValueError(f"{path}: the record at {offset} isn't what it says")
                names = [fields[k][12:-1] or None if k in fields else None for k in ("WARC-Record-ID", "WARC-Refers-To")]
                out.append((names[0], size, digest, fields["WARC-Type"], names[1], payload))
            if source:
                source.close()
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds], ["p", "b", "d", "t", "r", "payload"])

    got = found.mapInArrow(run, "p string, b long, d string, t string, r string, payload binary")
    return got.select(F.col("p").cast(id_kind).alias("page_id"), F.col("b").alias("payload_bytes"), F.col("d").alias("payload_digest"), F.col("t").alias("record_type"), F.col("r").cast(id_kind).alias("refers_to"), "payload")


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """pages written as monolithic archives, normalised in the shared folder, and read back; see read_archives.

    A null payload is empty. Null ids come back null and refer to the smallest id of an equal payload. Rows with the
    same id and payload are responses both. Other columns are not archived. An empty table gives no rows.
    """
    spark, place = pages.sparkSession, f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, f"{place}/whole", id_col, url_col, html_col, least_bytes)
    normalise(spark, f"{place}/whole", f"{place}/members")
    fs, root = file_system(f"{place}/whole")
    fs.delete_dir(root)
    return read_archives(spark, f"{place}/members", pages.schema[id_col].dataType.simpleString())
