"""WARC archives: written by Spark, indexed first, then read by coalesced byte ranges.

Writing: a record ends with two line ends, so Spark's text writer with that line
separator writes valid uncompressed WARC 1.1 files, with Spark's own commit
protocol.  Of records with equal payloads of at least ``min_bytes`` bytes, that with
the smallest page id is the response; the others are revisits without a payload.
Digests are computed twice, by expressions, so that only digests and ids are
shuffled to find the repeated ones; payloads are written where they are read.

Reading: a pass over the files in blocks writes one index row per record (file,
offset, length, type, record id, page id, URL, digest) without keeping
payloads.  Selected records are grouped by file and by offset range, sorted, and
neighbours no more than ``GAP`` bytes apart are fetched in one read of at most
``READ`` bytes (a longer record is read alone).  Every payload is held against
its digest.  Archives of other writers can be read too: records of any type and id, and files
of gzip members, one a record.

Defined results: a null html is an empty payload; rows that tie on the smallest
page id of a payload are each a response; a null page id is never the smallest
unless all are null; a null URL is written as empty and read back as null; a foreign
record id gives a null page id, a record without a digest a null ``intact``; a payload of any length that one
string may have is written and read whole; an empty table gives no rows; other columns of the pages are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.textkit import arrow_schema, load
from tessera.session import discard, materialize, new_path

END = "\r\n\r\n"
GAP, READ = 64 << 10, 4 << 20
#: Records of one file that one task reads lie in a range of this many bytes.
TASK_BYTES = 16 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


#: A table looked up by digest is broadcast up to this size, at DIGEST_BYTES a row; beyond it, it is joined by a shuffle.
BROADCAST_BYTES, DIGEST_BYTES = 32 << 20, 128
#: Parts into which a digest's rows are dealt where they are shuffled, as one payload may be that of very many pages.
SALTS = 16


def payload_digest(payload: Column) -> Column:
    """SHA-1 in upper-case base32: 10 hexadecimal digits are 8 of base 32."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, at, 10), 16, 32), 8, "0") for at in range(1, 41, 10)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def look_up(rows: DataFrame, table: DataFrame, digest: str, salt: str) -> DataFrame:
    """Left join of ``rows`` with a written table of one row for each ``__digest``; ``salt`` deals out the rows of a digest."""
    if table.count() * DIGEST_BYTES <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), F.col(digest) == F.col("__digest"), "left")
    salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(salted, (F.col(digest) == F.col("__digest")) & (F.pmod(F.xxhash64(salt), F.lit(SALTS)) == F.col("__salt")), "left").drop("__salt")


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> None:
    """Write a record per row below ``path``, one WARC file per partition."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("payload_digest", payload_digest(F.col("html")))
    repeated = rows.where(F.octet_length("html") >= min_bytes).groupBy(F.col("payload_digest").alias("__digest")).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = materialize(repeated.where("n > 1").drop("n"), "repeated", kept := [])
    joined = look_up(rows, repeated, "payload_digest", "page_id")
    revisit = F.col("__digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    clean_url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", clean_url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", name(F.col("first"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
    )
    joined.select(record.alias("value")).write.option("lineSep", END).text(path)
    discard(pages.sparkSession, kept)


#: Schemes of Hadoop's file systems that Arrow knows by another name.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def open_file(path: str):
    """A random-access file by its URI on a file system that Arrow reaches (local, HDFS, S3, GCS), or a local path."""
    scheme, mark, rest = path.partition("://")
    if not mark:
        return pafs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    system, rest = pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
    return system.open_input_file(rest)


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def index_file(f, block: int = 1 << 20) -> Iterator[tuple]:
    """(offset, length, head length, fields) of each record; payloads are skipped by seeking.

    In a file of gzip members, offsets and lengths are those of the members.
    """
    if f.read_at(2, 0) == GZIP:
        yield from _index_members(f, block)
        return
    size, at = f.size(), 0
    held, start = b"", 0
    while at < size:
        if not start <= at < start + len(held):
            f.seek(at)
            start, held = at, f.read(block)
        while (end := held.find(b"\r\n\r\n", at - start)) < 0:
            more = f.read_at(block, start + len(held))
            if not more:
                raise ValueError(f"record at {at} is cut short")
            held += more
        fields = parse_head(held[at - start : end])
        head = end + 4 - (at - start)
        length = head + int(fields["content-length"]) + len(END)
        if at + length > size:
            raise ValueError(f"record at {at} is cut short")
        yield at, length, head, fields
        at += length
        held, start = held[at - start :], at
        if len(held) > 4 * block:
            held = held[:block]


GZIP = b"\x1f\x8b"


def _index_members(f, block: int) -> Iterator[tuple]:
    size, at = f.size(), 0
    while at < size:
        member, head, pos, rest = zlib.decompressobj(31), b"", at, b""
        while not member.eof:
            data = rest or f.read_at(block, pos)
            if not data:
                raise ValueError(f"record at {at} is cut short")
            pos += 0 if rest else len(data)
            text = member.decompress(data, block)
            rest = member.unconsumed_tail
            if END.encode() not in head:  # no more than the head is kept
                head += text
        pos -= len(member.unused_data)
        end = head.index(END.encode())
        yield at, pos - at, end + 4, parse_head(head[:end])
        at = pos


INDEX = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()), T.StructField("head", T.LongType()),
    T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()), T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.LongType()),
])


_PAGE = re.compile(r"<urn:page:(-?\d+)>")


def _page(name: str | None) -> int | None:
    found = _PAGE.fullmatch(name or "")
    return int(found[1]) if found else None


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the archives below a folder, by the session's own file system; metadata only."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)
    return sorted(s.getPath().toString() for s in found if not s.getPath().getName().startswith(("_", ".")) and s.getLen() > 0)


def build_index(spark: SparkSession, path: str, opener: Callable = open_file) -> DataFrame:
    """One row per record of the archives below ``path``; ``opener`` gives a file with ``size, seek, read, read_at`` for a path."""
    files = list_files(spark, path)
    schema = arrow_schema(INDEX)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for b in batches:
            for path in b.column(0).to_pylist():
                rows: list[tuple] = []
                with opener(path) as f:
                    for at, length, head, x in index_file(f):
                        digest = x.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        rows.append((path, at, length, head, x["warc-type"], x["warc-record-id"], _page(x["warc-record-id"]), x.get("warc-target-uri") or None, digest, _page(x.get("warc-refers-to"))))
                        if len(rows) >= 4096:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)

    if not files:
        return spark.createDataFrame([], INDEX)
    listed = spark.createDataFrame([(f,) for f in files], "file string").repartitionByRange(len(files), "file")
    return listed.mapInArrow(scan, INDEX)


def coalesce_ranges(places: list[tuple[int, int]], gap: int = GAP, most: int = READ) -> list[tuple[int, int, list[int]]]:
    """(offset, length, positions) of the reads that cover (offset, length) pairs sorted by offset."""
    reads: list[tuple[int, int, list[int]]] = []
    for i, (at, n) in enumerate(places):
        if reads:
            start, length, inside = reads[-1]
            end = max(start + length, at + n)
            if at - (start + length) <= gap and end - start <= most:
                inside.append(i)
                reads[-1] = (start, end - start, inside)
                continue
        reads.append((at, n, [i]))
    return reads


def read_payloads(selected: DataFrame, with_payload: bool = True, opener: Callable = open_file) -> DataFrame:
    """Payloads of selected index rows: appends ``payload_bytes``, whether the digest ``intact``, and the ``payload``.

    Records of one file and offset range go to one task, sorted, so that each read is one range of the file.
    """
    extra = [T.StructField("payload_bytes", T.LongType()), T.StructField("intact", T.BooleanType())] + ([T.StructField("payload", T.BinaryType())] if with_payload else [])
    schema = T.StructType([*INDEX.fields, *extra])
    names = schema.names

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            at = 0
            while at < len(rows):
                to = at
                while to < len(rows) and rows[to]["file"] == rows[at]["file"]:
                    to += 1
                with opener(rows[at]["file"]) as f:
                    for start, length, inside in coalesce_ranges([(r["offset"], r["length"]) for r in rows[at:to]]):
                        data = f.read_at(length, start)
                        out = []
                        for r in (rows[at + i] for i in inside):
                            record = data[r["offset"] - start : r["offset"] - start + r["length"]]
                            if record[:2] == GZIP:
                                record = zlib.decompress(record, 31)
                            payload = record[r["head"] : -len(END)]
                            ok = not payload if r["record_type"] == "revisit" else base32_sha1(payload) == r["payload_digest"] if r["payload_digest"] else None
                            out.append([*r.values(), len(payload), ok] + ([payload] if with_payload else []))
                        yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(zip(*out, strict=True), target, strict=True)], names=names)
                at = to

    target = arrow_schema(schema)
    ordered = selected.select(*INDEX.names).withColumn("__at", F.floor(F.col("offset") / TASK_BYTES))
    ordered = ordered.repartition("file", "__at").sortWithinPartitions("file", "offset").drop("__at")
    return ordered.mapInArrow(fetch, schema)


def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, kept = new_path(spark, "warc"), []
    write_warc(load(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    index = materialize(build_index(spark, path), "warc-index", kept)
    read = materialize(read_payloads(index, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"), "warc-read")
    discard(spark, [path, *kept])
    # A revisit's payload is that of the response with its digest.
    referred = read.where("record_type = 'revisit'").select("payload_digest").distinct()
    held = read.where("record_type = 'response'").join(referred, "payload_digest", "left_semi").groupBy(F.col("payload_digest").alias("__digest")).agg(F.max("payload_bytes").alias("__bytes"))
    whole = read.where("record_type = 'response'")
    again = look_up(read.where("record_type = 'revisit'"), materialize(held, "held"), "payload_digest", "page_id")
    again = again.select("page_id", F.col("__bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", (F.col("intact") & F.col("__bytes").isNotNull()).alias("intact"))
    return whole.union(again)


QUERIES = {"op8_warc_archive": op8_warc_archive}

_BITS = " + ".join(f"(substr(b, 5 * i + {j}, 1) = '1')::int * {1 << (5 - j)}" for j in range(1, 6))
ORACLE = {
    "op8_warc_archive": f"""
with p as (select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, unhex(sha1(coalesce(html, '')))::bit::varchar as b from pages),
d as (select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', {_BITS} + 1, 1)), '') as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest, payload_bytes) as first from d)
select page_id, payload_bytes, payload_digest, case when page_id is not distinct from first then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from first then first end as refers_to, true as intact from f
"""
}
