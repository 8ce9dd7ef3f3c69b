"""WARC archives: a writer with revisit records and a splittable reader.

The writer makes one gzip member per record and lets Spark's text writer commit them: the members are
the lines and their last byte is the line separator. (A member ends with its length in four bytes, so the last is zero
below 16 MB; a larger one gets an empty member appended, which ends with zeros.)

The reader is Spark's text source with the gzip magic as line separator: every task scans its byte range and
gets the candidates that start inside it, the last one to its end beyond the range. Candidates are validated by
inflating them and decoding the record's header. The magic also occurs by chance inside members; such pieces
are appended to the member they belong to, and where the range ends within one, the pieces of both
tasks meet in a second step, which is the only shuffle and nearly always empty. A member that is broken or not a
WARC record is returned with ``valid`` false and the reason, never dropped. Every candidate that arrives while a member is open is
validated on its own: if the open member turns out to be damaged (it does not inflate, inflates to more than its header
says, or has no end), reading goes on at the first candidate after its beginning that is a record. Bytes between records that are
no record give one such row for each run of them.

A null payload is written as an empty one; a null url leaves out the target; a null id is written as
``null``. Rows with equal id and payload are equal records. An empty table gives an empty archive, and an empty
archive no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulbook.llm.common import new_folder, skew_join, slices, written

MAGIC = b"\x1f\x8b\x08"
MIN_REVISIT_BYTES = 100
URN = "urn:haulbook:record:"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 6
CHECKED = 512  # bytes of a candidate that show whether it begins a record
PADDING = 1024  # bytes that a member may have beyond its record
# Hadoop looks up a file's codec by the longest ending in order; one for "!.gz" hides that of ".gz" and does nothing itself.
# The second name of its option is that of Hadoop's shaded client, which Spark ships.
READ_RAW = {
    "lineSep": MAGIC.decode("latin-1"),
    "encoding": "ISO-8859-1",
    "io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec",
    "io.compress.passthrough.extension": "!.gz",
    "org.apache.hadoop.shaded.io.compress.passthrough.extension": "!.gz",
}
RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("valid", T.BooleanType()),
        T.StructField("problem", T.StringType()),
    ]
)


# --- writing


def record(
    id: str, payload: bytes, digest: str, url: str | None = None, refers_to: str | None = None, date: str = DATE
) -> bytes:
    """One gzip member: a response, or a revisit of ``refers_to`` with the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{URN}{id}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    out = _gzip(data)
    return out if out[-1] == 0 else out + _gzip(b"")


def _gzip(data: bytes) -> bytes:
    maker = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return maker.compress(data) + maker.flush()


def with_first_copies(
    pages: DataFrame, id_column: str, payload: str, min_bytes: int = MIN_REVISIT_BYTES
) -> DataFrame:
    """(id, url, payload, digest, refers_to): null ``refers_to`` where the record is a response.

    Payloads are grouped by digest on narrow rows. The join back can be split, so a payload that a third
    of the pages have is no hot spot.
    """
    digests = pages.select("id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("bytes"))
    groups = digests.filter(F.col("bytes") >= min_bytes).groupBy("digest")
    groups = groups.agg(F.min("id").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    joined = skew_join(pages.withColumn("digest", F.sha2("payload", 256)), groups, ["digest"], "left")
    return joined.withColumn("refers_to", F.when(F.col("id") != F.col("first"), F.col("first"))).drop("first", "copies")


def write_warc(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    payload: str = "html",
    url: str | None = "url",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> None:
    """Write a record per row to a folder of archives. Of rows with equal payloads of at least ``min_bytes``
    those with the smallest id are responses (usually one), the others revisits of it."""
    link = F.col(url) if url else F.lit(None).cast("string")
    data = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_column).alias("id"), link.alias("url"), data.alias("payload"))
    rows = with_first_copies(rows, "id", "payload", min_bytes).select(
        F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("id"),
        "url",
        "payload",
        "digest",
        F.col("refers_to").cast("string").alias("refers_to"),
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "payload"):
                found = [
                    record(r["id"], r["payload"], r["digest"], r["url"], r["refers_to"])[:-1] for r in part.to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["member"])

    members = rows.mapInArrow(make, "member binary")
    members.select(F.col("member").cast("string")).write.option("lineSep", "\x00").text(path)


# --- reading


def parse(data: bytes) -> tuple | None:
    """The fields of RECORD from an inflated record; None if this is none."""
    head, found, block = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        return None
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        return None
    length = int(fields["content-length"])
    problem = None if len(block) >= length else f"block of {len(block)} bytes instead of {length}"
    block = block[:length]
    kind, declared = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
    payload, size = block, len(block)
    if fields.get("content-type", "").lower().startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        said = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
        if kind == "revisit" and said:
            size = int(said[1])
    digest = declared
    if kind != "revisit":
        digest = sha256(payload).hexdigest()
        if declared and len(declared) == 64 and declared != digest:
            problem = problem or "payload digest differs"
    strip = lambda x: x.strip("<>") if x else None
    return (
        strip(fields.get("warc-record-id")),
        kind,
        fields.get("warc-target-uri"),
        strip(fields.get("warc-refers-to")),
        size,
        digest,
        payload if kind != "revisit" else None,
        problem is None,
        problem,
    )


class _Member:
    """A gzip member that is being put together from pieces."""

    def __init__(self, piece: bytes):
        self.inflater, self.pieces, self.out = zlib.decompressobj(31), [], []
        self.size, self.most = 0, None
        self.add(piece)

    def add(self, piece: bytes) -> None:
        self.pieces.append(piece)
        self.out.append(self.inflater.decompress(piece))
        self.size += len(self.out[-1])
        if self.most is None:
            self.out = [b"".join(self.out)]
            head, found, _ = self.out[0].partition(b"\r\n\r\n")
            said = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head) if found else None
            if said:
                self.most = len(head) + 4 + int(said[1]) + PADDING
        if self.most is not None and self.size > self.most:
            raise zlib.error("more bytes than its header says")

    @property
    def ended(self) -> bool:
        return self.inflater.eof

    def starts_record(self) -> bool:
        """Whether what is inflated so far begins with a record's header, or is an empty member."""
        data = b"".join(self.out)
        return data.startswith(b"WARC/") if data else self.ended


def _broken(reason: str) -> tuple:
    return (*[None] * 7, False, reason)


def _begins(piece: bytes) -> bool:
    """Whether a piece by itself begins with a record's header, or is too short to tell."""
    try:
        data = zlib.decompressobj(31).decompress(piece[:CHECKED], 5)
    except zlib.error:
        return False
    return data == b"WARC/" or len(piece) < CHECKED and b"WARC/".startswith(data)


def members(pieces: Iterator[bytes], whole: bool) -> Iterator[tuple[str, object]]:
    """Records, and the fragments at either end, of the pieces that start inside one byte range.

    Yields ("record", fields), ("head", bytes) for pieces before the first member, and ("tail", bytes) for
    a member without its end. With ``whole`` the pieces are all there are, and both are broken records.
    """
    member, started, lost = None, False, False
    again: list[bytes] = []  # pieces to be read anew, the next one last
    later: list[bytes] = []  # pieces of the open member from the first that is a record by itself

    def damaged(reason: object) -> Iterator[tuple[str, object]]:
        nonlocal member, later, lost
        if not lost:
            yield "record", _broken(f"broken member: {reason}")
        again.extend(reversed(later))
        member, later, lost = None, [], True

    while True:
        piece = again.pop() if again else next(pieces, None)
        if piece is None:
            if member is None:
                return
            if not whole:
                yield "tail", b"".join(member.pieces)
                return
            yield from damaged("without end")
            continue
        try:
            if member is not None:
                if later or _begins(piece):
                    later.append(piece)
                member.add(piece)
            else:
                member = _Member(piece)
                if not member.starts_record() and (member.ended or len(piece) > CHECKED):
                    raise zlib.error("not a WARC record")
                started = True
                lost = lost and not member.size
        except zlib.error as e:
            if started or whole:
                yield from damaged(e)
            else:
                member = None
                yield "head", piece
            continue
        if member.ended:
            data, rest = b"".join(member.out), member.inflater.unused_data
            lost = False
            if data:
                yield "record", parse(data) or _broken("not a WARC record")
            member, later = None, []
            if rest.strip(b"\0"):
                yield from damaged("bytes that are no member")


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records (RECORD) of the archives under ``path``, any path that Spark reads; without ``payloads`` that column is null.

    payload_bytes and payload_digest are of the full payload, also of a revisit, whose HTTP header
    and digest field have them. Archives named ``.gz`` are split like others: a codec that Hadoop offers for other names
    keeps it from inflating them.
    """
    raw = (
        spark.read.options(**READ_RAW)
        .text(path)
        .select(
            F.col("value").cast("binary").alias("piece"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
        )
    )
    schema = T.StructType(
        [
            T.StructField("file", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("place", T.LongType()),
            T.StructField("fragment", T.BinaryType()),
            *RECORD.fields,
        ]
    )
    blank = (None,) * len(RECORD)

    def rows(found: Iterator[tuple[str, object]], file: str, start: int) -> Iterator[tuple]:
        for place, (kind, value) in enumerate(found):
            if kind == "record":
                value = value if payloads else (*value[:6], None, *value[7:])
                yield (file, start, place, None, *value)
            else:
                yield (file, start, place, value, *blank)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pieces of each byte range, which come in order."""
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), *[pa.string()] * 4, pa.int64()]
        kinds += [pa.string(), pa.binary(), pa.bool_(), pa.string()]

        def flat() -> Iterator[tuple[bytes, str, int]]:
            for batch in batches:
                yield from zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)

        def out(held: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        source = flat()
        ahead = next(source, None)
        while ahead is not None:
            file, start = ahead[1:]

            def of_range() -> Iterator[bytes]:
                nonlocal ahead
                first = start == 0
                while ahead is not None and ahead[1:] == (file, start):
                    if not first:  # before the first magic of a file there is nothing
                        yield MAGIC + ahead[0]
                    elif ahead[0]:
                        yield ahead[0]
                    first = False
                    ahead = next(source, None)

            held, size = [], 0
            for row in rows(members(of_range(), False), file, start):
                held.append(row)
                size += len(row[3] or b"") + len(row[10] or b"") + 200
                if size > 8_000_000:
                    yield out(held)
                    held, size = [], 0
            if held:
                yield out(held)

    parsed = written(raw.mapInArrow(scan, schema), "warc")

    def stitch(frame: pd.DataFrame) -> pd.DataFrame:
        """The fragments of one file, in order: each end of a range goes on in the heads after it."""
        frame = frame.sort_values(["start", "place"])
        runs: list[list[bytes]] = []
        for fragment in frame["fragment"]:
            pieces = [MAGIC + x for x in bytes(fragment).split(MAGIC)[1:]] or [bytes(fragment)]
            if not runs or _begins(pieces[0]):  # the end of a range
                runs.append([])
            runs[-1] += pieces
        found = [v for pieces in runs for _, v in members(iter(pieces), True)]
        found = [v if payloads else (*v[:6], None, *v[7:]) for v in found]
        return pd.DataFrame(found, columns=RECORD.names, dtype=object)

    fragments = parsed.filter("fragment is not null").select("file", "start", "place", "fragment")
    stitched = fragments.groupBy("file").applyInPandas(stitch, RECORD)
    return parsed.filter("fragment is null").select(*RECORD.names).unionByName(stitched)


def id_of(column: str) -> Column:
    """The id that the writer put into a record id."""
    return F.regexp_extract(column, "^" + URN + "(.*)$", 1)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    path = new_folder(spark, "archive")
    write_warc(pages, path)
    number = lambda c: F.expr(f"try_cast({c} as long)")
    read = read_warc(spark, path, payloads=False)
    read = read.withColumn("page", id_of("record_id")).withColumn("original", id_of("refers_to"))
    return read.select(
        number("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("original").alias("refers_to"), "valid", "problem",
    )
