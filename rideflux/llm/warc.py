"""WARC archives: write captures, read records back, assemble transactions.

*Writing*: each row becomes a request, a response (or revisit) and a metadata
record, which name the response through ``WARC-Concurrent-To``.  Archives are
written by Spark's text writer with the record separator as line separator, so
files are committed like any other output and a lost executor's task is simply
run again; gzip files are read back by one task each, from start to end.

*Reading*: the text reader splits files at the separator; a parser in the task
puts the pieces of a record together again by its ``Content-Length``, holding
one record at a time.

*Assembly*: request, response and metadata records are joined through their
concurrent-to ids into one nested row per capture.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflux.llm.common import ship, stored, with_broadcast
from rideflux.session import run_dir

SEPARATOR = "\r\n\r\n"
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Most revisit rows that are broadcast; beyond, pages are joined by a shuffle.
MAX_BROADCAST = 500_000
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(column: str) -> str:
    """SQL: bare upper-case base32 SHA-1 of a string's UTF-8 bytes.

    Eight groups of five hex digits are twenty bits, four base32 digits each.
    """
    parts = ", ".join(f"lpad(conv(substr(h, {5 * i + 1}, 5), 16, 32), 4, '0')" for i in range(8))
    return (f"transform(array(sha1({column})), h -> translate(concat({parts}), "
            f"'0123456789ABCDEFGHIJKLMNOPQRSTUV', '{BASE32}'))[0]")


def _record_id(kind: str, page: str, digest: str) -> str:
    """SQL: a record id that depends on the row's id and payload only."""
    h = f"md5(concat_ws('|', '{kind}', coalesce(string({page}), 'null'), {digest}))"
    cuts = ", ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"concat('<urn:uuid:', concat_ws('-', {cuts}), '>')"


def _record(headers: list[tuple[str, str]], block: str) -> str:
    """SQL: a record's text; headers whose value is null are left out."""
    lines = ", ".join(f"concat('{name}: ', {value})" for name, value in headers)
    return (f"concat(concat_ws('\\r\\n', '{VERSION}', {lines}, "
            f"concat('Content-Length: ', octet_length({block}))), '\\r\\n\\r\\n', {block})")


def choose_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, payload_digest, of``: the rows to write as revisits of page
    ``of``.  Of equal payloads of at least ``min_bytes`` bytes the one with
    the largest page_id is the response; a null id counts as smallest."""
    keys = pages.select("page_id", "payload_digest", "payload_bytes")
    heads = stored(keys.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
                   .agg(F.max("page_id").alias("of"), F.count("*").alias("n")).where("n > 1 AND of IS NOT NULL"), "warc-heads")
    return (keys.where(F.col("payload_bytes") >= min_bytes).join(heads, "payload_digest")
            .where("NOT (page_id <=> of)").select("page_id", "payload_digest", "of").distinct())


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write ``pages (page_id, url, html)`` as gzip WARC files under ``path``.

    A null html is an empty payload, a null url leaves the target out; line
    breaks in a url become spaces.  Other columns are not read.
    """
    base = pages.select(
        "page_id", F.translate(F.col("url").cast("string"), "\r\n", "  ").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    base = base.withColumn("payload_digest", F.expr(base32_sha1("html"))).withColumn(
        "payload_bytes", F.octet_length("html").cast("long"))
    revisits = with_broadcast(choose_revisits(base, min_bytes), MAX_BROADCAST).select(
        F.col("page_id").alias("r_id"), F.col("payload_digest").alias("r_digest"), "of")
    rows = base.join(revisits, base.page_id.eqNullSafe(revisits.r_id)
                     & (base.payload_digest == revisits.r_digest), "left")
    own = _record_id("response", "page_id", "payload_digest")
    first = _record_id("response", "of", "payload_digest")
    target = [("WARC-Date", f"'{DATE}'"), ("WARC-Target-URI", "url")]
    http = ("concat('HTTP/1.1 200 OK\\r\\nContent-Type: text/html; charset=utf-8\\r\\nContent-Length: ', "
            "payload_bytes, '\\r\\n\\r\\n')")
    digest = ("WARC-Payload-Digest", "concat('sha1:', payload_digest)")
    request = _record(
        [("WARC-Type", "'request'"), ("WARC-Record-ID", _record_id("request", "page_id", "payload_digest")),
         ("WARC-Concurrent-To", own), *target, ("Content-Type", "'application/http;msgtype=request'")],
        "concat('GET / HTTP/1.1\\r\\nReferer: ', coalesce(url, ''), '\\r\\n\\r\\n')")
    response = _record(
        [("WARC-Type", "'response'"), ("WARC-Record-ID", own), *target, digest,
         ("Content-Type", "'application/http;msgtype=response'")], f"concat({http}, html)")
    revisit = _record(
        [("WARC-Type", "'revisit'"), ("WARC-Record-ID", own), *target, digest, ("WARC-Refers-To", first),
         ("WARC-Profile", f"'{PROFILE}'"), ("Content-Type", "'application/http;msgtype=response'")], http)
    metadata = _record(
        [("WARC-Type", "'metadata'"), ("WARC-Record-ID", _record_id("metadata", "page_id", "payload_digest")),
         ("WARC-Concurrent-To", own), *target, ("Content-Type", "'application/warc-fields'")],
        "concat('page_id: ', coalesce(string(page_id), ''), '\\r\\n')")
    text = f"concat_ws('\\r\\n\\r\\n', {request}, IF(of IS NULL, {response}, {revisit}), {metadata})"
    rows.select(F.expr(text).alias("value")).write.option("lineSep", SEPARATOR).option("compression", "gzip").text(path)


_RECORD = pa.schema([
    ("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()),
    ("target_uri", pa.string()), ("date", pa.string()), ("declared_digest", pa.string()), ("http_header", pa.string()),
    ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
RECORD = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
          "declared_digest string, http_header string, payload binary, payload_bytes long, payload_digest string")


def headers(block: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first of repeated ones."""
    out: dict[str, str] = {}
    for line in block.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out.setdefault(name.strip().lower().decode("latin-1"), value.strip().decode("utf-8", "replace"))
    return out


def _row(h: dict[str, str], block: bytes) -> tuple:
    kind = h.get("warc-type", "").lower()
    http, payload = None, block
    if h.get("content-type", "").startswith("application/http"):
        top, _, payload = block.partition(b"\r\n\r\n")
        http = top.decode("utf-8", "replace")
    declared = h.get("warc-payload-digest", "")
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    size = len(payload)
    if kind == "revisit":  # the payload is the response's; its size stands in the HTTP header
        digest = declared.removeprefix("sha1:")
        size = int(headers(block).get("content-length", 0)) if http else 0
    return (h.get("warc-record-id"), kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"),
            h.get("warc-target-uri"), h.get("warc-date"), declared or None, http, payload, size, digest)


class Stream:
    """The bytes of one file, as its pieces come; yields complete records."""

    def __init__(self):
        self.parts: list[bytes] = []
        self.size = 0
        self.head: dict[str, str] | None = None
        self.need = 0

    def add(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        sep = SEPARATOR.encode()
        self.parts += [piece, sep]
        self.size += len(piece) + len(sep)
        while self.size >= (len(sep) if self.head is None else self.need + len(sep)):
            data = b"".join(self.parts)
            cut = data.find(sep) if self.head is None else self.need
            if cut < 0:
                break
            block, tail = data[:cut], data[cut + len(sep):]
            if self.head is not None:
                if data[cut:cut + len(sep)] == sep:
                    yield self.head, block
                else:  # the length is wrong: skipped up to the next separator
                    tail = data[cut:]
                self.head = None
            elif block.startswith(b"WARC/"):
                self.head = headers(block)
                length = self.head.get("content-length", "")
                self.need = int(length) if length.isdigit() else 0
            self.parts, self.size = [tail], len(tail)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the files that a task reads one after the other."""
    source, stream = None, Stream()
    for b in batches:
        rows, held = [], 0
        for piece, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if name != source:  # a truncated last record ends with its file
                source, stream = name, Stream()
            for head, block in stream.add(piece):
                rows.append(_row(head, block))
                held += len(block)
            if held > 1 << 23:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(_RECORD.names, map(list, zip(*rows)))), schema=_RECORD)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``.

    ``payload`` is the block behind its HTTP header, ``payload_digest`` its
    bare base32 SHA-1 (of a revisit: the declared one, and the size that its
    HTTP header states).  Records cut short or of a wrong length are skipped.
    """
    ship(spark)
    pieces = spark.read.option("lineSep", SEPARATOR).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"))
    return pieces.mapInArrow(_parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, response, request, metadata,
    n_requests, n_metadata``.

    A capture is a response or revisit record; requests and metadata belong to
    it when they name it as concurrent or it names them.  Of several, the one
    with the smallest record id is nested (null: none) and all are counted.
    Records repeated with one id are one record.
    """
    captures = records.where("type IN ('response', 'revisit') AND record_id IS NOT NULL").dropDuplicates(["record_id"])
    nested = F.struct(*[F.col(c) for c in records.columns])
    others = records.where("type IN ('request', 'metadata') AND record_id IS NOT NULL").select(
        "record_id", "type", "concurrent_to", nested.alias("record"))
    named = others.where("concurrent_to IS NOT NULL").select(F.col("concurrent_to").alias("capture_id"), "type", "record")
    naming = captures.where("concurrent_to IS NOT NULL").select(
        F.col("record_id").alias("capture_id"), F.col("concurrent_to").alias("record_id"))
    joined = named.unionByName(others.join(naming, "record_id").select("capture_id", "type", "record"))
    beside = joined.groupBy("capture_id").agg(
        *[F.min(F.when(F.col("type") == t, F.col("record"))).alias(t) for t in ("request", "metadata")],
        *[F.count_distinct(F.when(F.col("type") == t, F.col("record.record_id"))).alias(n)
          for t, n in (("request", "n_requests"), ("metadata", "n_metadata"))])
    return (captures.select(F.col("record_id").alias("capture_id"), nested.alias("response"))
            .join(beside, "capture_id", "left")
            .select("capture_id", "response", "request", "metadata",
                    *[F.coalesce(n, F.lit(0)).alias(n) for n in ("n_requests", "n_metadata")]))


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archive ``pages`` and return per page what the archives hold:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    A null html is an empty payload; a null id is the smallest one, its page_id
    and what refers to it come back null.  Rows repeated with one id and payload
    are one capture.  Other columns are not read; an empty table gives no rows.
    """
    path = run_dir(pages.sparkSession, "warc")
    write_archives(pages, path, min_bytes)
    records = read_archives(pages.sparkSession, path)
    # Payloads were digested while parsing; only metadata blocks go on.  Stored,
    # so that the archives are parsed once for the joins below.
    light = stored(records.withColumn("payload", F.when(F.col("type") == "metadata", F.col("payload")))
                   .drop("http_header"), "warc-records")
    kind = dict(pages.dtypes)["page_id"]
    page = F.regexp_extract(F.col("metadata.payload").cast("string"), r"page_id: ([^\r\n]*)", 1)
    found = assemble(light).select(
        "capture_id", F.when(page != "", page).cast(kind).alias("page_id"),
        "response.payload_bytes", "response.payload_digest", F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("of"))
    found = stored(found, "warc-captures")
    origin = found.where("record_type = 'response'").select(F.col("capture_id").alias("of"),
                                                            F.col("page_id").alias("refers_to"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    # Only revisits name another capture; all other rows would meet in the null key.
    named, other = found.where("of IS NOT NULL"), found.where("of IS NULL")
    return named.join(origin, "of", "left").select(*columns).unionByName(
        other.withColumn("refers_to", F.lit(None).cast(kind)).select(*columns))
