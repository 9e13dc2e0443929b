"""WARC archives compressed with Zstandard: writer and reader.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, itself possibly Zstandard-compressed; then comes one frame a record.
The reader loads the dictionary, decodes frame after frame from a stream (one
record in memory), and validates version line, mandatory header fields,
Content-Length, both digests and, of HTTP blocks, their Content-Length.

Writing: payload digests are grouped to find each payload's smallest page id;
a page whose equal payload has at least ``min_bytes`` bytes and a smaller page
id elsewhere becomes a revisit record without payload. Grouping combines
map-side, only digests that occur twice are joined back, and adaptive execution
may split a hot one. Each task trains its dictionary on its first records (at
most ``DICT_SAMPLES`` records of at most ``DICT_SAMPLE_BYTES`` each) and starts a
new archive beyond ``ARCHIVE_BYTES``. A file's name holds the
attempt that wrote it, and only the names that successful attempts return are read, so
lost executors and repeated tasks neither lose nor double a page.

Nulls: null html is the empty payload, a null url is written as ``urn:none`` and
read back as null; a null page id never is another's response, its record is a
revisit only if a non-null page has the payload, and reads back as null. Rows
that share the smallest page id of their payload are all responses. Extra
columns are ignored. An empty table gives no archives and an empty result.
Payloads are never cut.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickworks.session import work_dir

from .common import stored
from .token_files import open_folder

DICT_MAGIC = 0x184D2A5D  # fixed value of the format
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
DICT_SAMPLES, DICT_SAMPLE_BYTES, DICT_BYTES = 256, 4_096, 16_384
ARCHIVE_BYTES = 64 << 20
LEVEL = 3
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the tables hold no capture time
MANDATORY = ("WARC-Record-ID", "Content-Length", "WARC-Date", "WARC-Type")


class WarcError(ValueError):
    pass


def sha1_base32(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


# -- records --------------------------------------------------------------
def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit keeps the HTTP header, whose Content-Length is the payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "urn:none" if url is None else " ".join(url.split())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines = b"\r\n".join(f"{k}: {v}".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers_of(raw: bytes, what: str) -> dict[str, str]:
    out = {}
    for line in raw.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"{what}: malformed header line {line[:80]!r}")
        out[name.decode("latin-1").lower()] = value.strip().decode("utf-8")
    return out


def parse_record(raw: bytes) -> dict:
    """Validated fields of one record: type, ids, url, payload (None for a revisit) and its length."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    first, _, lines = head.partition(b"\r\n")
    if not sep or not first.startswith(b"WARC/1."):
        raise WarcError(f"no WARC version line: {first[:40]!r}")
    h = headers_of(lines, "WARC header")
    if missing := [k for k in MANDATORY if k.lower() not in h]:
        raise WarcError(f"missing {', '.join(missing)}")
    if not h["content-length"].isdigit() or int(h["content-length"]) != len(rest) - 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError(f"{h['warc-record-id']}: Content-Length {h['content-length']}, {len(rest) - 4} bytes in the block")
    block = rest[:-4]
    check_digest(h, "warc-block-digest", block)
    out = {"type": h["warc-type"], "record_id": h["warc-record-id"], "url": h.get("warc-target-uri"),
           "refers_to": h.get("warc-refers-to"), "payload": block, "payload_bytes": len(block),
           "payload_digest": h.get("warc-payload-digest", "").rpartition(":")[2] or None}
    if h.get("content-type", "").startswith("application/http"):
        http, sep, payload = block.partition(b"\r\n\r\n")
        fields = headers_of(http.partition(b"\r\n")[2], "HTTP header") if sep else {}
        said = fields.get("content-length", "")
        out |= {"payload": payload, "payload_bytes": int(said) if said.isdigit() else len(payload)}
        if out["type"] == "revisit":
            if payload:
                raise WarcError(f"{out['record_id']}: a revisit holds a payload")
            out["payload"] = None
        elif said and (not said.isdigit() or int(said) != len(payload)):
            raise WarcError(f"{out['record_id']}: HTTP Content-Length {said}, payload of {len(payload)} bytes")
    if out["payload"] is not None:
        check_digest(h, "warc-payload-digest", out["payload"])
        out["payload_digest"] = out["payload_digest"] or sha1_base32(out["payload"])
    return out


def check_digest(h: dict[str, str], field: str, raw: bytes) -> None:
    kind, _, value = h.get(field, "").partition(":")
    if kind == "sha1" and value != sha1_base32(raw):
        raise WarcError(f"{h['warc-record-id']}: {field} does not match")


# -- archives -------------------------------------------------------------
def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from some records; raw content where training finds too little."""
    cut = [s[:DICT_SAMPLE_BYTES] for s in samples[:DICT_SAMPLES]]
    try:
        return zstandard.train_dictionary(DICT_BYTES, cut).as_bytes()
    except zstandard.ZstdError:
        return b"".join(cut)[:DICT_BYTES] if sum(map(len, cut)) >= 8 else b""


def archive_start(dictionary: bytes) -> bytes:
    body = zstandard.ZstdCompressor().compress(dictionary)
    return DICT_MAGIC.to_bytes(4, "little") + len(body).to_bytes(4, "little") + body


def read_archive(stream) -> Iterator[bytes]:
    """The records of an archive, one frame at a time, from a binary stream."""
    start = read_exactly(stream, 8)
    if int.from_bytes(start[:4], "little") != DICT_MAGIC:
        raise WarcError("the archive does not start with a dictionary frame")
    body = read_exactly(stream, int.from_bytes(start[4:], "little"))
    if body[:4] == ZSTD_MAGIC:
        body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
    loaded = zstandard.ZstdCompressionDict(body) if body else None
    opener = zstandard.ZstdDecompressor(dict_data=loaded) if loaded else zstandard.ZstdDecompressor()
    held = b""
    while held or (held := stream.read(1 << 20)):
        frame, parts = opener.decompressobj(), []
        while True:
            if not held and not (held := stream.read(1 << 20)):
                raise WarcError("the archive ends inside a frame")
            try:
                parts.append(frame.decompress(held))
            except zstandard.ZstdError as e:
                raise WarcError(f"broken frame: {e}") from e
            held = b""
            if frame.eof:
                held = frame.unused_data
                break
        yield b"".join(parts)


def read_exactly(stream, n: int) -> bytes:
    out = stream.read(n)
    if len(out) != n:
        raise WarcError("the archive ends inside its dictionary frame")
    return out


class ArchiveWriter:
    """Collects one archive; the dictionary comes from its first records."""

    def __init__(self) -> None:
        self.waiting: list[bytes] = []
        self.parts: list[bytes] = []
        self.size, self.packer = 0, None

    def add(self, raw: bytes) -> None:
        if self.packer:
            self.pack(raw)
            return
        self.waiting.append(raw)
        if len(self.waiting) >= DICT_SAMPLES:
            self.begin()

    def pack(self, raw: bytes) -> None:
        self.parts.append(self.packer.compress(raw))
        self.size += len(self.parts[-1])

    def begin(self) -> None:
        dictionary = train_dictionary(self.waiting)
        loaded = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=loaded) if loaded else zstandard.ZstdCompressor(level=LEVEL)
        self.parts.append(archive_start(dictionary))
        for raw in self.waiting:
            self.pack(raw)
        self.waiting = []

    def bytes(self) -> bytes:
        if not self.packer:
            self.begin()
        return b"".join(self.parts)


# -- Spark ----------------------------------------------------------------
def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record a page under ``path``; the result lists (file, records), to be run once.

    The list holds the archives of the attempts that succeeded. Those of lost or repeated
    attempts stay beside them under other names: read the listed ones only.
    """
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    keyed = rows.withColumn("sha1", F.sha1("payload"))
    again = (keyed.where(F.octet_length("payload") >= min_bytes).groupBy("sha1")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
             .select("sha1", "first"))
    full = keyed.join(again, "sha1", "left").select(
        "page_id", "url", "payload", F.when((F.col("page_id") != F.col("first")) | F.col("page_id").isNull(), F.col("first")).alias("first"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        task = TaskContext.get()
        fs, root = open_folder(path)
        writer, records, k = ArchiveWriter(), 0, 0

        def close() -> pd.DataFrame:
            # each attempt has names of its own, as another one may cut its records elsewhere
            name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{k:05d}.warc.zst"
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/{name}", compression=None) as f:
                f.write(writer.bytes())
            return pd.DataFrame({"file": [name], "records": [records]})

        for pdf in frames:
            for page_id, url, payload, first in zip(pdf["page_id"].astype("Int64"), pdf["url"], pdf["payload"], pdf["first"].astype("Int64")):
                payload = bytes(payload)
                writer.add(record(None if page_id is pd.NA else int(page_id), url, payload, sha1_base32(payload),
                                  None if first is pd.NA else int(first)))
                records += 1
                if writer.size >= ARCHIVE_BYTES:
                    yield close()
                    writer, records, k = ArchiveWriter(), 0, k + 1
        if records:
            yield close()

    return full.mapInPandas(run, "file string, records bigint")


def read_archives(spark: SparkSession, path: str, files: list[str], with_payload: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of the archives, one task a file."""
    out = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
           + ", payload binary" * with_payload)
    if not files:
        return spark.createDataFrame([], out)
    listed = spark.createDataFrame(list(enumerate(files)), "slot int, file string").repartitionById(len(files), F.col("slot"))

    def page(urn: str | None) -> int | None:
        number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number.lstrip("-").isdigit() else None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for name in pdf["file"]:
                fs, root = open_folder(path)
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    rows, held = [], 0
                    for raw in read_archive(stream):
                        r = parse_record(raw)
                        rows.append((page(r["record_id"]), None if r["url"] == "urn:none" else r["url"], r["payload_bytes"],
                                     r["payload_digest"], r["type"], page(r["refers_to"]), *[r["payload"]] * with_payload))
                        held += len(raw) if with_payload else 100
                        if held > 4 << 20:
                            yield frame(rows)
                            rows, held = [], 0
                    if rows:
                        yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * with_payload]
        return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    return listed.mapInPandas(run, out)


def archived_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write archives in the shared work folder, then read them back."""
    spark = pages.sparkSession
    folder = work_dir(spark, "warc")
    files = sorted(r.file for r in write_archives(pages, folder, min_bytes).collect())  # one row an archive
    return read_archives(spark, folder, files)


def pages_sql(min_bytes: int = 0) -> str:
    """DuckDB SQL of ``archived_pages``; base32 from the hex digest, five digits to four letters."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex FROM p),
b AS (SELECT *, array_to_string(list_transform(range(32), lambda i: substr('{letters}', 1 +
        ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest FROM d),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM b)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first OR payload_bytes < {min_bytes} THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first OR payload_bytes < {min_bytes} THEN NULL ELSE first END AS refers_to FROM f"""
