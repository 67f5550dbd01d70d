"""WARC archives: a writer with identical-payload revisits and a sequential reader.

Each record is a gzip member of its own. The reader inflates a member a piece at a time: the header first (HEAD_BYTES at most), then as many bytes as its Content-Length says and
no more, so a member never fills more memory than the record it announces (MOST_BYTES at most) and whatever goes on beyond its record raises. Block and payload digests are checked,
so a damaged archive raises instead of giving wrong rows.

Defined results: a null payload is empty; a null url becomes "urn:none"; rows with the same id are records of their own. Of equal payloads one record is a response: of the smallest
id (null ids last), then of the least url; rows that are equal in id, url and payload are one response and revisits of it. An empty table gives no archives and no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "file string, n_records long, n_bytes long"
RECORDS = (
    "record_id string, target_uri string, record_type string, refers_to_id string, payload_bytes long, "
    "payload_digest string, payload binary, file string"
)
READ_BYTES = 1 << 16
HEAD_BYTES = 1 << 20
MOST_BYTES = 1 << 31
CHUNK = 1 << 12


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _text(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n]+", " ", value)


def record(kind: str, key: str, uri: str, date: str, payload: bytes | None, n_bytes: int, digest: str, refers_to: str | None) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP headers only; n_bytes and digest are the full payload's."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    if kind == "response":
        block += payload or b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:x-record:{key}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_text(uri)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-record:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class WarcError(ValueError):
    pass


class Member:
    """One gzip member of a stream, inflated as far as it is asked for. rest: what was read of the stream and not yet inflated."""

    def __init__(self, stream: BinaryIO, rest: bytes, size: int = READ_BYTES):
        self.stream, self.rest, self.size, self.inflate, self.held = stream, rest, size, zlib.decompressobj(31), bytearray()

    def more(self, most: int) -> bool:
        """Inflates most bytes at most, one piece of input at a time; False at the member's end."""
        if self.inflate.eof:
            return False
        data = self.rest or self.stream.read(self.size)
        if not data:
            raise WarcError("the archive ends within a gzip member")
        try:
            self.held += self.inflate.decompress(data, most)
        except zlib.error as e:
            raise WarcError(f"damaged gzip member: {e}") from e
        self.rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        return True

    def until(self, mark: bytes, most: int) -> bytes:
        """What comes before the mark, which is dropped."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(len(self.held) - len(mark) + 1, 0)
            if len(self.held) >= most or not self.more(most - len(self.held)):
                raise WarcError("no record header")
        out = bytes(self.held[:at])
        del self.held[: at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more(n - len(self.held)):
                raise WarcError("the block is not as long as Content-Length says")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def close(self) -> bytes:
        """The rest of the stream that was read, after a record's last line ends and the member's checksum."""
        if self.take(4) != b"\r\n\r\n" or self.held:
            raise WarcError("the block is not as long as Content-Length says")
        while self.more(1):
            if self.held:
                raise WarcError("the member goes on after its record")
        return self.rest


def framed(stream: BinaryIO, size: int = READ_BYTES) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record: a member at a time, in order."""
    rest = b""
    while rest := rest or stream.read(size):
        member = Member(stream, rest, size)
        first, *lines = member.until(b"\r\n\r\n", HEAD_BYTES).decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise WarcError("no record header")
        head = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}
        n = int(head["content-length"])
        if not 0 <= n <= MOST_BYTES:
            raise WarcError(f"a block of {n} bytes")
        block = member.take(n)
        rest = member.close()
        yield head, block


def records(stream: BinaryIO) -> Iterator[dict]:
    for head, block in framed(stream):
        if f"sha1:{base32_sha1(block)}" != head["warc-block-digest"]:
            raise WarcError("block digest differs")
        end = block.index(b"\r\n\r\n")
        length = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", block[: end + 2])[1])
        digest, payload = head["warc-payload-digest"].removeprefix("sha1:"), None
        if head["warc-type"] == "response":
            payload = block[end + 4 :]
            if len(payload) != length or base32_sha1(payload) != digest:
                raise WarcError("payload digest or length differs")
        strip = lambda x: x and x.removeprefix("<urn:x-record:").removesuffix(">")
        yield {
            "record_id": strip(head["warc-record-id"]),
            "target_uri": head["warc-target-uri"],
            "record_type": head["warc-type"],
            "refers_to_id": strip(head.get("warc-refers-to")),
            "payload_bytes": length,
            "payload_digest": digest,
            "payload": payload,
        }


def write(
    df: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 0,
    roll_bytes: int = 256 << 20,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row below the shared folder; gives the archives, one row each.

    The revisit join carries a payload once and splits hot digests: the side with the first ids holds a row for each digest
    that occurs more than once, is written first, and so leaves a plain join that adaptive execution can split.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(url_col), F.lit("urn:none")).alias("uri"),
        F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "n_bytes": F.octet_length("payload")})
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("uri").alias("uri"))
    equal = rows.where(F.col("n_bytes") >= min_revisit_bytes).groupBy("digest", "n_bytes", order.alias("f")).agg(F.count("*").alias("n"))
    first = store.cut(
        equal.groupBy("digest", "n_bytes").agg(F.min(F.struct("f", "n")).alias("least"), F.sum("n").alias("n"))
        .where("n > 1")
        .select("digest", F.col("n_bytes").alias("size"), F.col("least.f.id").alias("first_id"), F.col("least.f.uri").alias("first_uri"), F.col("least.n").alias("equal"), F.lit(True).alias("shared")),
        "warc-first",
    )
    is_first = F.col("shared").isNull() | (F.col("id").eqNullSafe(F.col("first_id")) & (F.col("uri") == F.col("first_uri")))
    joined = rows.join(first, "digest", "left").withColumn("revisits", ~is_first)
    columns = ["id", "uri", "digest", "n_bytes", "revisits", "first_id", F.when(~F.col("revisits"), F.col("payload")).alias("payload")]
    several = F.coalesce(F.col("equal") > 1, F.lit(False)) & ~F.col("revisits")
    marked = joined.where(~several).select(*columns)
    again = first.where("equal > 1")
    if not again.isEmpty():  # rows equal in all: one response, and as many revisits as there are others
        marked = marked.unionByName(joined.where(several).dropDuplicates(["digest"]).select(*columns))
        parts = F.sequence(F.lit(1).cast("long"), F.col("equal") - 1, F.lit(CHUNK).cast("long"))
        others = again.withColumn("_from", F.explode(parts)).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        others = others.withColumn("_nth", F.explode(F.sequence("_from", F.least(F.col("equal") - 1, F.col("_from") + CHUNK - 1))))
        marked = marked.unionByName(others.select(F.col("first_id").alias("id"), F.col("first_uri").alias("uri"), "digest", F.col("size").alias("n_bytes"), F.lit(True).alias("revisits"), "first_id", F.lit(None).cast("binary").alias("payload")))
    folder = store.fresh(spark, "warc")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n, done = None, 0, []

        def close():
            out.commit()
            done.append({"file": out.uri, "n_records": n, "n_bytes": out.size})

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    out, n = store.AtomicFile(f"{folder}/{uuid.uuid4().hex}.warc.gz"), 0
                digest = base64.b32encode(bytes.fromhex(r["digest"])).decode()
                kind = "revisit" if r["revisits"] else "response"
                out.write(record(kind, str(r["id"]), r["uri"], date, r["payload"], r["n_bytes"], digest, str(r["first_id"])))
                n += 1
                if out.size >= roll_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("file", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]))

    return store.cut(marked.mapInArrow(put, FILES), "warc-files")


def read(files: DataFrame, *, payloads: bool = True, batch_rows: int = 512) -> DataFrame:
    """The records of the archives named in column file, read in order within each archive."""

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema(
            [("record_id", pa.string()), ("target_uri", pa.string()), ("record_type", pa.string()), ("refers_to_id", pa.string()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("file", pa.string())]
        )
        for batch in batches:
            for name in batch.column("file").to_pylist():
                fs, path = store.filesystem(name)
                held, size = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for r in records(stream):
                        held.append(r | {"file": name} | ({} if payloads else {"payload": None}))
                        size += len(r["payload"] or b"") if payloads else 0
                        if len(held) >= batch_rows or size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=kinds)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=kinds)

    spark = files.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return files.select("file").repartition(n, "file").mapInArrow(get, RECORDS)


def digest_table(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per page what its record in the archives says."""
    got = read(write(pages), payloads=False)
    number = lambda c: F.expr(f"try_cast({c} as bigint)")
    return got.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to_id").alias("refers_to"),
    )
