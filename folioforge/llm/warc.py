"""WARC archives as a Spark data source.

Files are WARC/1.1 with two gzip members per record: headers, then payload. The
first member's extra field (``sl``, skip lengths) tells the compressed and the
plain length of the second, so a reader can step over a payload that nobody
wants. Archives without that field, one member per record or plain text are read
as well; there unwanted payloads are passed over without being kept.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage

from folioforge.llm.common import materialize, scratch_path, ship

SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"
#: Header names of WARC/1.1 behind the columns; the last one is an extension, for the length that a revisit's payload has.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Payload-Length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Compressed bytes of the files that one partition reads, and plain bytes of the payloads in one batch.
PARTITION_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
CHUNK = 1 << 16
#: Slots of the map that tells which digests may be repeated: at most so many numbers are broadcast.
SLOTS = 1 << 20
#: Payloads of fewer bytes are never revisits.
REVISIT_BYTES = 1000


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else pafs.FileSystem.from_uri("file://" + path) if path.startswith("/") and not path.startswith("//") else pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1))


def _member(data: bytes, extra: bytes = b"") -> bytes:
    """A gzip member, with an extra field if any."""
    head = b"\x1f\x8b\x08" + (b"\x04" if extra else b"\x00") + b"\0\0\0\0\0\xff" + (struct.pack("<H", len(extra)) + extra if extra else b"")
    z = zlib.compressobj(1, zlib.DEFLATED, -15)
    return head + z.compress(data) + z.flush() + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _clean(value: str) -> str:
    """Header values stay on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_bytes(row: dict, date: str) -> bytes:
    payload = row["payload"] or b""
    lines = ["WARC/1.1", f"WARC-Date: {date}"]
    for column, header in HEADERS.items():
        if row.get(column) is not None:
            lines.append(f"{header}: {_clean(str(row[column]))}")
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
    second = _member(payload + b"\r\n\r\n")
    skip = struct.pack("<II", len(second) & 0xFFFFFFFF, (len(payload) + 4) & 0xFFFFFFFF)
    return _member("\r\n".join(lines).encode(), b"sl" + struct.pack("<H", len(skip)) + skip) + second


@dataclass
class Written(WriterCommitMessage):
    part: str
    name: str


class WarcWriter(DataSourceArrowWriter):
    """One archive per task under a name of its own; only committed tasks' files get their final names."""

    def __init__(self, path: str, date: str):
        self.path, self.date = path, date

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _fs(self.path)
        fs.create_dir(root)
        name = uuid.uuid4().hex
        part = f"{root}/_{name}.part"
        with fs.open_output_stream(part) as out:
            for batch in iterator:
                for start in range(0, batch.num_rows, 64):
                    for row in batch.slice(start, 64).to_pylist():
                        out.write(record_bytes(row, self.date))
        return Written(part, f"{root}/{name}.warc.gz")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, _ = _fs(self.path)
        for m in messages:
            if m is not None:
                fs.move(m.part, m.name)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, _ = _fs(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(m.part)


@dataclass
class Files(InputPartition):
    names: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.value = self.names


class Plain:
    """Reads an archive of gzip members or plain bytes, front to back."""

    def __init__(self, f: pa.NativeFile):
        self.f = f
        self.raw = b""  # compressed, read but not used
        self.out = b""  # plain, not used
        first = f.read(2)
        self.gzip = first == b"\x1f\x8b"
        self.raw = first
        self.z: zlib._Decompress | None = None
        self.skip: tuple[int, int] | None = None

    def _more(self) -> bool:
        """Bring in plain bytes; False at the end."""
        if not self.gzip:
            data, self.raw = self.raw + self.f.read(CHUNK), b""
            self.out += data
            return bool(data)
        while True:
            if not self.raw:
                self.raw = self.f.read(CHUNK)
                if not self.raw:
                    if self.z is not None:
                        raise EOFError("archive is cut off within a gzip member")
                    return False
            if self.z is None:
                self._open()
            data = self.z.decompress(self.raw, CHUNK * 4)
            self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if self.z.eof:
                self.z = None
            if data:
                self.out += data
                return True

    def _open(self) -> None:
        """Start a member; note its skip lengths, if it has any."""
        while len(self.raw) < 12 or (self.raw[3] & 4 and len(self.raw) < 12 + struct.unpack_from("<H", self.raw, 10)[0]):
            data = self.f.read(CHUNK)
            if not data:
                break
            self.raw += data
        self.skip = None
        if len(self.raw) >= 12 and self.raw[3] & 4:
            at, end = 12, 12 + struct.unpack_from("<H", self.raw, 10)[0]
            while at + 4 <= end:
                n = struct.unpack_from("<H", self.raw, at + 2)[0]
                if self.raw[at : at + 2] == b"sl" and n == 8:
                    self.skip = struct.unpack_from("<II", self.raw, at + 4)
                at += 4 + n
        self.z = zlib.decompressobj(31)

    def headers(self) -> dict[str, str] | None:
        while True:
            self.out = self.out.lstrip(b"\r\n")
            end = self.out.find(b"\r\n\r\n")
            if end >= 0:
                break
            if not self._more():
                if self.out:
                    raise EOFError("archive is cut off within headers")
                return None
        head, self.out = self.out[:end], self.out[end + 4 :]
        lines = head.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}

    def payload(self, n: int, wanted: bool) -> bytes | None:
        if not wanted and self.gzip and self.z is None and not self.out and self.skip and self.skip[1] == n + 4 < 1 << 32:
            ahead = self.skip[0] - len(self.raw)
            if ahead >= 0:
                self.f.seek(ahead, 1) if self.f.seekable() else self.f.read(ahead)
                self.raw = b""
            else:
                self.raw = self.raw[self.skip[0] :]
            return None
        parts, left = [], n
        while left:
            if not self.out and not self._more():
                raise EOFError("archive is cut off within a payload")
            take, self.out = self.out[:left], self.out[left:]
            left -= len(take)
            if wanted:
                parts.append(take)
        return b"".join(parts) if wanted else None


def _holds(kind: str, value: object, wanted: object) -> bool:
    """A pushed predicate as SQL's WHERE sees it: a null value never passes, except where null is asked for."""
    if kind == "null":
        return (value is None) == wanted
    if kind == "safe":
        return value == wanted
    if value is None or wanted is None:
        return False
    return {"eq": lambda: value == wanted, "in": lambda: value in wanted, "gt": lambda: value > wanted, "ge": lambda: value >= wanted, "lt": lambda: value < wanted, "le": lambda: value <= wanted, "starts": lambda: value.startswith(wanted), "ends": lambda: value.endswith(wanted), "has": lambda: wanted in value}[kind]()


KINDS = {EqualTo: "eq", In: "in", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le", StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "has", EqualNullSafe: "safe"}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, options: dict):
        self.path = path
        self.want_payload = str(options.get("payload", "true")).lower() != "false"
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, object, bool]] = []

    def pushFilters(self, filters):  # noqa: N802  (the API's name)
        """Predicates on headers are decided here, before a payload is touched; the others stay with Spark."""
        for f in filters:
            no, g = (True, f.child) if isinstance(f, Not) else (False, f)
            column = g.attribute[0] if len(getattr(g, "attribute", ())) == 1 else None
            if column not in HEADERS or no and not isinstance(g, (EqualTo, In)):
                yield f
            elif isinstance(g, (IsNull, IsNotNull)):
                self.tests.append((column, "null", isinstance(g, IsNull), False))
            elif type(g) in KINDS:
                self.tests.append((column, KINDS[type(g)], g.value, no))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """Files in order of size, largest first, each to a bin that has room."""
        fs, root = _fs(self.path)
        info = fs.get_file_info(root)
        found = [info] if info.type == pafs.FileType.File else [x for x in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if x.type == pafs.FileType.File and x.base_name.endswith((".warc", ".warc.gz")) and not x.base_name.startswith(("_", "."))]
        bins: list[Files] = []
        room = 0
        for x in sorted(found, key=lambda x: (-x.size, x.path)):
            if not bins or x.size > room:
                bins.append(Files())
                room = self.partition_bytes
            bins[-1].names.append(x.path)
            room -= x.size
        return bins

    def _passes(self, row: dict) -> bool:
        for column, kind, wanted, no in self.tests:
            value = row[column]
            if no and (value is None or _holds(kind, value, wanted)) or not no and not _holds(kind, value, wanted):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = _fs(self.path)
        schema = pa.schema([(c, pa.int64() if c == "payload_bytes" else pa.string()) for c in HEADERS] + [("payload", pa.binary())])
        rows, held = [], 0
        for name in partition.names:
            with fs.open_input_file(name) as f:
                source = Plain(f)
                while (h := source.headers()) is not None:
                    row = {c: h.get(header.lower()) for c, header in HEADERS.items()}
                    n = int(h.get("content-length", 0))
                    row["payload_bytes"] = int(row["payload_bytes"]) if row["payload_bytes"] is not None else n
                    keep = self._passes(row)
                    row["payload"] = source.payload(n, keep and self.want_payload)
                    if keep:
                        rows.append(row)
                        held += len(row["payload"] or b"")
                        if held >= BATCH_BYTES or len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(dir)`` and ``df.write.format("warc").mode("append").save(dir)``.

    Options: ``payload`` (false: headers only), ``partitionBytes``, and for
    writing ``date`` (WARC-Date of the records).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return WarcReader(self.options["path"], {k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to; use mode('append') and a path of their own")
        return WarcWriter(self.options["path"], self.options.get("date", "1970-01-01T00:00:00Z"))


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame) -> DataFrame:
    """Pages as WARC records, later copies of a payload as revisits.

    Of pages with equal payloads of at least 1000 bytes the one with the
    largest page_id is the response, and the others revisit it. Null html is an
    empty payload; shorter payloads are all responses. Rows that repeat the
    winning page_id are all responses; a null page_id revisits any other. Very
    long payloads pass through whole; an empty table gives no records. Other
    columns, whatever their names, are not read.
    """
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", html.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "n": F.octet_length("payload").cast("long")})
    long = rows.where(F.col("n") >= REVISIT_BYTES)
    # Written before it is joined: only then can Spark split the pages of a hot payload.
    winners = materialize(long.groupBy(F.col("digest").alias("same")).agg(F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"), "winners")
    # Pages whose payload nobody shares stay where they are; only the others are brought together.
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS))
    taken = F.broadcast(winners.select(slot("same").alias("slot")).distinct())
    placed = rows.withColumn("slot", F.when(F.col("n") >= REVISIT_BYTES, slot("digest")))
    alone = placed.join(taken, "slot", "left_anti").select("page_id", "url", "payload", "digest", "n", F.lit(None).cast("string").alias("same"), F.lit(None).cast(rows.schema["page_id"].dataType).alias("winner"))
    # Of those, only what may be a winner takes its payload along: revisits have none.
    first = lambda digest, page: F.pmod(F.xxhash64(digest, page), F.lit(SLOTS))
    firsts = F.broadcast(winners.select(first("same", "winner").alias("first")).distinct().withColumn("may_win", F.lit(True)))
    lighter = placed.join(taken, "slot", "left_semi").withColumn("first", first("digest", "page_id")).join(firsts, "first", "left").withColumn("payload", F.when(F.col("may_win"), F.col("payload")))
    shared = lighter.join(winners, F.col("digest") == F.col("same"), "left").select(*alone.columns)
    joined = alone.union(shared)
    revisit = F.col("same").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    return joined.select(
        urn("page_id").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(revisit, urn("winner")).alias("refers_to"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.col("n").alias("payload_bytes"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str) -> None:
    register(pages.sparkSession)
    page_records(pages).write.format("warc").mode("append").save(path)


def read_records(spark: SparkSession, path: str, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages as archives in the shared folder and read their records back.

    Digest and length of a response are those of the payload read; a revisit
    has them in its headers, so that revisits are read without payloads. Both
    reads leave the other's records to the source. Nulls, ties and repeated rows
    are as ``page_records`` says; an empty table has no rows.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_pages(pages, path)
    if not list(WarcReader(path, {}).partitions() if _exists(path) else []):
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")

    def rows(kind: str, n: Column, digest: Column, **options: str) -> DataFrame:
        records = read_records(spark, path, **options).where(F.col("record_type") == kind)
        return records.select(number("record_id").alias("page_id"), n.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"))

    responses = rows("response", F.octet_length("payload").cast("long"), F.sha1("payload"))
    return responses.union(rows("revisit", F.col("payload_bytes"), F.regexp_replace("payload_digest", "^sha1:", ""), payload="false"))


def _exists(path: str) -> bool:
    fs, root = _fs(path)
    return fs.get_file_info(root).type != pafs.FileType.NotFound
