"""WARC archives on any file system Spark writes to, and a reader that salvages damaged ones.

Records are rows of Spark's text sink, so archives are written and read in parallel without a
local file. The reader cuts archives where a record may begin (the version line, or the first
bytes of a gzip member), checks each piece, joins pieces that a payload has cut, and after a
failed check goes on at the next possible beginning. What it leaves out is logged by byte range.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.shared import broadcast_if_small

# What the version lines of all records begin with, and what may follow; the last is written.
VERSION, VERSIONS = b"WARC/1.", (b"0", b"1")
MEMBER = b"\x1f\x8b\x08"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Pages carry no date of their own.
DATE = "1970-01-01T00:00:00Z"
RECORDS_PER_BATCH = 256
# An archive holds so many bytes of pages, by their mean size, and never more records than that.
ARCHIVE_BYTES, RECORDS_PER_ARCHIVE = 64 << 20, 20_000


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str,
           length: int, refers_to: int | None, revisit: bool) -> bytes:
    """One record up to the line end that closes it; a revisit has no payload."""
    block = _HTTP + (b"" if revisit else payload)
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_uri(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {length}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # Characters that would end the header line are written as their code.
        safe = re.sub(r"[\x00-\x20]", lambda c: f"%{ord(c.group()):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    if revisit:
        lines += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    return VERSION + VERSIONS[-1] + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n"


# Ends each record of a plain archive; in a compressed one an empty member stands between records.
_PLAIN_END = "\r\n"
_EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x02\x03\x03\x00" + bytes(8)


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def with_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload (binary), revisit and refers_to.

    Of pages whose payloads are equal and have at least `min_bytes` bytes, the one with the
    largest page_id is the response; the others revisit it. Rows that share that page_id and
    payload are all responses. A NULL html is an empty payload; a NULL page_id is never the
    largest, unless the group has no other (then all its rows are responses).
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumn("__key", F.sha1("payload"))
    # Map-side combine makes a payload that many pages share one row per task.
    owners = rows.where(F.octet_length("payload") >= min_bytes).groupBy("__key").agg(
        F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("__n")
    ).where("__n > 1 and owner is not null").drop("__n")
    # Few payloads repeat as a rule; then the pages stay where they are.
    joined = rows.join(broadcast_if_small(owners), "__key", "left")
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    return joined.select(
        "page_id", "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.unhex("__key").alias("sha1"), F.octet_length("payload").cast("long").alias("length"),
        revisit.alias("revisit"), F.when(revisit, F.col("owner")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, compressed: bool = False) -> None:
    """A record per page, in archives of bounded length; `compressed` makes a gzip member of each.

    An archive is read by one task, so its length is bounded by bytes.
    """
    mean = pages.agg(F.avg(F.coalesce(F.octet_length("html"), F.lit(0))).alias("n")).first()["n"] or 0
    per_archive = max(1, min(RECORDS_PER_ARCHIVE, int(ARCHIVE_BYTES / (mean + 1024))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, RECORDS_PER_BATCH):
                made = []
                for r in whole.slice(at, RECORDS_PER_BATCH).to_pylist():
                    digest = base64.b32encode(r["sha1"]).decode()
                    data = record(r["page_id"], r["url"], r["payload"] or b"", digest, r["length"],
                                  r["refers_to"], r["revisit"])
                    made.append(_member(data + b"\r\n") if compressed else data)
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])

    rows = with_roles(pages, min_bytes).mapInArrow(run, "value binary")
    end = _EMPTY_MEMBER.decode("latin-1") if compressed else _PLAIN_END
    # The sink writes a string's bytes as they are.
    rows.select(F.col("value").cast("string")).write.option("lineSep", end).option(
        "encoding", "ISO-8859-1").option("maxRecordsPerFile", per_archive).text(path)


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]


class Salvage:
    """Records and gaps of one archive, from its pieces in order.

    The first piece lies before any mark; each other piece began with the mark (left out).
    At most the pieces of one record are held at a time.
    """

    def __init__(self, pieces: Iterator[bytes], mark: bytes, size: int):
        self.pieces, self.mark, self.size = pieces, mark, size
        self.ahead: deque[bytes] = deque()
        self.offset = 0

    def _more(self, n: int) -> bool:
        """Whether an n-th piece ahead exists."""
        while len(self.ahead) <= n:
            piece = next(self.pieces, None)
            if piece is None:
                return False
            self.ahead.append(piece)
        return True

    def _take(self, n: int) -> int:
        length = sum(len(self.mark) + len(self.ahead.popleft()) for _ in range(n))
        self.offset += length
        return length

    def __iter__(self) -> Iterator[Record | Gap]:
        head = next(self.pieces, b"")
        if head:
            yield Gap(0, len(head), "no record begins here")
            self.offset = len(head)
        one = self._member if self.mark == MEMBER else self._plain
        while self._more(0):
            begin = self.offset
            found, used, rest, why = one()
            if not found and why:
                # The next piece is looked at by itself: it may be a whole record.
                yield Gap(begin, self._take(1), why)
                continue
            self._take(used)
            yield from found
            if rest:
                yield Gap(self.offset - rest, rest, "bytes after a record")

    def _plain(self) -> tuple[list[Record], int, int, str]:
        data, used = self.ahead[0], 1
        head, end, _ = data.partition(b"\r\n\r\n")
        version, _, lines = head.partition(b"\r\n")
        if version not in VERSIONS:
            return [], 0, 0, "no version of a record"
        headers = _headers(lines) if end else None
        if headers is None:
            return [], 0, 0, "no header"
        try:
            length = int(headers.get("content-length", ""))
        except ValueError:
            return [], 0, 0, "no length"
        need = len(head) + 4 + length + 4
        if length < 0 or self.offset + len(self.mark) + need > self.size:
            return [], 0, 0, "longer than the archive"
        parts, have = [data], len(data)
        while have < need and self._more(used):
            parts += [self.mark, self.ahead[used]]
            have += len(self.mark) + len(self.ahead[used])
            used += 1
        data = b"".join(parts)
        block = data[len(head) + 4 : need - 4]
        if data[need - 4 : need] != b"\r\n\r\n":
            return [], 0, 0, "length does not meet the end"
        why = _failed(headers, block)
        return ([], 0, 0, why) if why else ([Record(self.offset, headers, block)], used, have - need, "")

    def _member(self) -> tuple[list[Record], int, int, str]:
        unpack, out, used = zlib.decompressobj(31), [], 0
        try:
            while not unpack.eof and self._more(used):
                out.append(unpack.decompress(self.mark + self.ahead[used]))
                used += 1
        except zlib.error:
            return [], 0, 0, "damaged member"
        if not unpack.eof:
            return [], 0, 0, "member without an end"
        data, rest = b"".join(out), len(unpack.unused_data)
        if not data:
            return [], used, rest, ""
        found = []
        inner = Salvage(iter(data.split(VERSION)), VERSION, len(data))
        for item in inner:
            if isinstance(item, Gap):
                return [], 0, 0, f"in a member: {item.reason}"
            found.append(Record(self.offset, item.headers, item.block))
        return found, used, rest, ""


def _headers(head: bytes) -> dict[str, str] | None:
    found = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            return None
        found[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return found


def _failed(headers: dict[str, str], block: bytes) -> str:
    """What is wrong with a record of the right length; empty if its digests hold."""
    told = headers.get("warc-block-digest", "")
    if told.startswith("sha1:") and told[5:] != sha1_base32(block):
        return "block digest differs"
    if headers.get("warc-type") == "response":
        told = headers.get("warc-payload-digest", "")
        if told.startswith("sha1:") and told[5:] != sha1_base32(block.partition(b"\r\n\r\n")[2]):
            return "payload digest differs"
    return ""


_COLUMNS = ("file string, offset long, length long, reason string, record_type string, page_id long,"
            " url string, payload_digest string, payload_bytes long, refers_to long, payload binary")


def read_archives(spark: SparkSession, path: str, compressed: bool = False,
                  with_payload: bool = True) -> DataFrame:
    """One row per record, and one per quarantined byte range (with a `reason`).

    Spark reads archives in splits, cut at every mark. The pieces of an archive then meet in one
    task, in their order, where they stream through the checks: a task holds one record's pieces.
    """
    mark = MEMBER if compressed else VERSION
    pieces = spark.read.option("lineSep", mark.decode("latin-1")).option(
        "encoding", "ISO-8859-1").text(path)
    placed = pieces.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("value"),
    )
    by_file = placed.repartition("file").sortWithinPartitions("file", "block", "at")
    return by_file.mapInArrow(lambda batches: _salvaged(batches, mark, with_payload), _COLUMNS)


def _salvaged(batches: Iterator[pa.RecordBatch], mark: bytes, with_payload: bool) -> Iterator[pa.RecordBatch]:
    rows = (r for b in batches for r in zip(
        b.column("file").to_pylist(), b.column("size").to_pylist(), b.column("value"), strict=True))
    schema = pa.schema([
        ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("reason", pa.string()),
        ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ])
    following = next(rows, None)
    while following:
        name, size = following[0], following[1]

        def of_file(name: str = name) -> Iterator[bytes]:
            nonlocal following
            while following and following[0] == name:
                value = following[2].as_py()
                following = next(rows, None)
                yield value

        made: list[dict] = []
        for item in Salvage(of_file(), mark, size):
            made.append(_gap_row(name, item) if isinstance(item, Gap) else _row(name, item, with_payload))
            if len(made) == RECORDS_PER_BATCH:
                yield pa.RecordBatch.from_pylist(made, schema)
                made = []
        if made:
            yield pa.RecordBatch.from_pylist(made, schema)


def _gap_row(name: str, gap: Gap) -> dict:
    return {"file": name, "offset": gap.offset, "length": gap.length, "reason": gap.reason}


def _row(name: str, found: Record, with_payload: bool) -> dict:
    headers, revisit = found.headers, found.headers.get("warc-type") == "revisit"
    payload = None if revisit else found.payload
    told = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    length = headers.get("warc-payload-length", "")
    return {
        "file": name, "offset": found.offset, "length": len(found.block), "reason": None,
        "record_type": headers.get("warc-type"), "page_id": _page(headers.get("warc-record-id")),
        "url": headers.get("warc-target-uri"),
        "payload_digest": told if revisit else sha1_base32(payload),
        "payload_bytes": (int(length) if length.isdigit() else None) if revisit else len(payload),
        "refers_to": _page(headers.get("warc-refers-to")),
        "payload": payload if with_payload else None,
    }


def records(archives: DataFrame) -> DataFrame:
    return archives.where("reason is null")


def gaps(archives: DataFrame) -> DataFrame:
    """The quarantined byte ranges: file, offset, length, reason."""
    return archives.where("reason is not null").select("file", "offset", "length", "reason")
