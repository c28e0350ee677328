"""WARC archives as a PySpark Python data source, for writing and reading.

``df.write.format("warc")`` writes one archive per task (rolled at a size, plain or one gzip member per
record) and publishes a manifest on commit, so files of lost or repeated tasks are never read.
``spark.read.format("warc")`` plans partitions by size from the manifest's files, or where there is no manifest, as in
a folder of anyone else's archives, from all ``.warc`` and ``.warc.gz`` files of the folder, takes record-type and header
predicates pushed down by Spark, parses each record's header first, and skips the payload of every record that
a predicate excludes, or of all records with the option ``payload=false``: in a plain archive by a seek, in a
compressed one without keeping or decoding it.

Schema: record_id, record_type, target_uri, payload_digest (bare hexadecimal SHA-1), refers_to, payload_bytes
(of the full payload, also for revisits), payload. Paths are URIs; files are opened through ``pyarrow.fs`` so
that any store it knows will do, and they must lie in a folder all executors share.

Archives of others: a record whose block is no HTTP message (``warcinfo``, ``metadata``, ``resource``, ...) has its
whole block as payload, and an HTTP block's payload begins behind its header, or is empty where that has no end;
nothing is ever looked for beyond the block's length. Ids and digests of other forms are kept whole, without angle
brackets. A file cut off in the middle of a record ends there.

Cases: a null payload is an empty one; null ids, uris, digests and types are left out of the header and read
back as null; line ends in header values are percent-escaped; payloads may hold any bytes; an empty table
gives an archive folder without files, which reads back as no rows.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition,
                                    StringStartsWith, WriterCommitMessage)

from tickwise.llm.common import ship, written
from tickwise.operators.joins import check_size

SCHEMA = ("record_id string, record_type string, target_uri string, payload_digest string, refers_to string, "
          "payload_bytes bigint, payload binary")
ROLL_BYTES = 128 << 20
PLAN_BYTES = 64 << 20
#: Size up to which the marks of revisits are broadcast: rows, and bytes of their ids and digests.
MOST_MARKS, MOST_MARK_BYTES = 500_000, 32 << 20
GZIP_LEVEL = 4
_MANIFEST = "_manifest-"
_DATE = "2024-01-01T00:00:00Z"
_URN = "urn:x-record:"


def _store(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def _escape(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unescape(value: str | None) -> str | None:
    return value and value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _urn(value: str) -> str:
    return f"<{_URN}{_escape(value)}>"


def record_bytes(row) -> bytes:
    """One archive record. A revisit keeps the response's HTTP header but not its payload."""
    payload = bytes(row["payload"] or b"")
    kind = row["record_type"]
    size = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Date: {_DATE}", "Content-Type: application/http; msgtype=response"]
    if kind is not None:
        lines.append(f"WARC-Type: {_escape(kind)}")
    if row["record_id"] is not None:
        lines.append(f"WARC-Record-ID: {_urn(row['record_id'])}")
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {_escape(row['target_uri'])}")
    if row["payload_digest"] is not None:
        lines.append(f"WARC-Payload-Digest: sha1:{_escape(row['payload_digest'])}")
    if row["refers_to"] is not None:
        lines.append(f"WARC-Refers-To: {_urn(row['refers_to'])}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, gzip: bool, roll: int):
        self.path, self.gzip, self.roll = path.rstrip("/"), gzip, roll

    def write(self, iterator) -> _Written:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        files, out, size, name = [], None, 0, ""
        for row in iterator:
            if out is None:
                name = f"part-{uuid.uuid4().hex}.warc{'.gz' if self.gzip else ''}"
                out, size = store.open_output_stream(f"{root}/{name}", compression=None), 0
            data = record_bytes(row)
            if self.gzip:
                member = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
                data = member.compress(data) + member.flush()
            out.write(data)
            size += len(data)
            if size >= self.roll:
                out.close()
                files.append([name, size])
                out = None
        if out is not None:
            out.close()
            files.append([name, size])
        return _Written(files)

    def commit(self, messages) -> None:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{_MANIFEST}{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())

    def abort(self, messages) -> None:
        """Nothing was published: files without a manifest are not part of the archive."""


@dataclass
class _Files(InputPartition):
    names: list

    def __init__(self, names: list):
        super().__init__(names)
        self.names = names


def _field(headers: dict, column: str) -> str | None:
    """A column's value from the record's header alone."""
    if column == "record_type":
        return _unescape(headers.get("warc-type"))
    if column == "target_uri":
        return _unescape(headers.get("warc-target-uri"))
    if column == "payload_digest":
        value = headers.get("warc-payload-digest")
        return _unescape(value[5:]) if value and value.startswith("sha1:") else value
    value = headers.get("warc-record-id" if column == "record_id" else "warc-refers-to")
    if value is None:
        return None
    bare = value[1:-1] if value.startswith("<") and value.endswith(">") else value
    return _unescape(bare[len(_URN):]) if bare.startswith(_URN) else bare


_HEADER_COLUMNS = ("record_type", "target_uri", "payload_digest", "record_id", "refers_to")


class _Plain:
    """Sequential reads of a plain archive; skipping is a seek."""

    def __init__(self, store, name: str):
        self.file = store.open_input_file(name)
        self.size = self.file.size()
        self.at, self.buffer = 0, b""

    def more(self) -> bool:
        got = self.file.read(1 << 16)
        self.buffer += got
        return bool(got)

    def read(self, n: int) -> bytes:
        if len(self.buffer) < n:
            self.buffer += self.file.read(n - len(self.buffer))
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        return out

    def skip(self, n: int) -> None:
        if n <= len(self.buffer):
            self.buffer = self.buffer[n:]
        else:
            self.file.seek(self.file.tell() + n - len(self.buffer))
            self.buffer = b""

    def close(self) -> None:
        self.file.close()


class _Gzip(_Plain):
    """The same over a chain of gzip members; skipped bytes are inflated in pieces and dropped."""

    def __init__(self, store, name: str):
        super().__init__(store, name)
        self.member, self.packed = zlib.decompressobj(31), b""

    def _inflate(self) -> bytes:
        while True:
            if self.member.eof:
                self.packed = self.member.unused_data or self.packed
                if not self.packed:
                    self.packed = self.file.read(1 << 16)
                if not self.packed:
                    return b""
                self.member = zlib.decompressobj(31)
            packed = self.member.unconsumed_tail or self.packed or self.file.read(1 << 16)
            self.packed = b""
            if not packed:
                return b""
            got = self.member.decompress(packed, 1 << 18)
            if got:
                return got

    def more(self) -> bool:
        got = self._inflate()
        self.buffer += got
        return bool(got)

    def read(self, n: int) -> bytes:
        parts, size = [self.buffer], len(self.buffer)
        while size < n and (got := self._inflate()):
            parts.append(got)
            size += len(got)
        whole = b"".join(parts)
        out, self.buffer = whole[:n], whole[n:]
        return out

    def skip(self, n: int) -> None:
        while n > len(self.buffer):
            n -= len(self.buffer)
            self.buffer = self._inflate()
            if not self.buffer:
                return
        self.buffer = self.buffer[n:]


def _headers(source: _Plain) -> dict | None:
    """The next record's header fields by lower-case name; None at the end."""
    while (end := source.buffer.find(b"\r\n\r\n")) < 0:
        if not source.more():
            return None
    lines = source.read(end + 4)[:end].decode("utf-8", "surrogatepass").lstrip("\r\n").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if v}


def _is_http(headers: dict) -> bool:
    return headers.get("content-type", "").lower().startswith("application/http")


def _http_header(source: _Plain, length: int) -> bytes:
    """The block's HTTP header with its blank line; the whole block where it has none."""
    while (end := source.buffer.find(b"\r\n\r\n", 0, length)) < 0 and len(source.buffer) < length and source.more():
        pass
    return source.read(length if end < 0 else end + 4)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool, plan: int):
        self.path, self.payload, self.plan = path.rstrip("/"), payload, plan
        self.wanted: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters):
        """Takes what a record's header decides; Spark keeps the rest."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in _HEADER_COLUMNS and isinstance(f, EqualTo):
                self.wanted.append((column, "in", (f.value,)))
            elif column in _HEADER_COLUMNS and isinstance(f, In):
                self.wanted.append((column, "in", tuple(f.value)))
            elif column in _HEADER_COLUMNS and isinstance(f, StringStartsWith):
                self.wanted.append((column, "starts", (f.value,)))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        store, root = _store(self.path)
        listed = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        files, manifests = [], [i for i in listed if i.base_name.startswith(_MANIFEST)]
        for info in manifests:
            with store.open_input_stream(info.path) as f:
                files += json.loads(f.read())
        if not manifests:
            files = [[i.base_name, i.size] for i in listed if i.is_file and i.base_name.endswith((".warc", ".warc.gz"))]
        parts, names, size = [], [], 0
        for name, n in sorted(files):
            if names and size + n > self.plan:
                parts.append(_Files(names))
                names, size = [], 0
            names.append(name)
            size += n
        return parts + [_Files(names)]

    def _excluded(self, headers: dict) -> bool:
        for column, how, values in self.wanted:
            value = _field(headers, column)
            if value is None or (value not in values if how == "in" else not value.startswith(values[0])):
                return True
        return False

    def read(self, partition) -> Iterator[tuple]:
        if partition is None or not partition.names:
            return
        store, root = _store(self.path)
        for name in partition.names:
            source = (_Gzip if name.endswith(".gz") else _Plain)(store, f"{root}/{name}")
            while (headers := _headers(source)) is not None:
                length = int(headers["content-length"])
                if self._excluded(headers):
                    source.skip(length + 4)
                    continue
                http = _http_header(source, length) if _is_http(headers) else b""
                size = next((int(x[15:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
                rest = length - len(http)
                size = rest if size is None else size
                payload = None
                if self.payload and headers.get("warc-type") != "revisit":
                    payload = source.read(rest)
                    source.skip(4)
                else:
                    source.skip(rest + 4)
                yield (*(_field(headers, c) for c in ("record_id", "record_type", "target_uri", "payload_digest",
                                                      "refers_to")), size, payload)
            source.close()


class WarcDataSource(DataSource):
    """Options: path; for reading ``payload`` (true) and ``planBytes``; for writing ``gzip`` (false), ``rollBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def _flag(self, name: str, default: str) -> bool:
        return self.options.get(name, default).lower() == "true"

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self._flag("payload", "true"),
                          int(self.options.get("planBytes", PLAN_BYTES)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter(self.options["path"], self._flag("gzip", "false"),
                          int(self.options.get("rollBytes", ROLL_BYTES)))


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_archives(records: DataFrame, path: str, gzip: bool = False) -> None:
    """records: the columns of SCHEMA in any order."""
    register(records.sparkSession)
    names = [x.split(" ")[0] for x in SCHEMA.split(", ")]
    records.select(*names).write.format("warc").option("gzip", str(gzip).lower()).mode("append").save(path)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def records_of(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Archive records of (page_id, url, html): of equal payloads from ``least_bytes`` on, all but that of the
    largest page_id become revisits to it. Rows that repeat that page are responses too.

    Which pages those are is found from ids and digests alone, and written as a small table. The pages themselves are
    marked where they lie, by a broadcast of that table when its checked size allows it, otherwise by a join.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    # Equal rows get equal records; the digest tells rows of one id with different payloads apart.
    marks = pages.select("page_id", F.unhex(F.sha1(payload)).alias("digest"), F.octet_length(payload).alias("b"))
    large = marks.where(F.col("b") >= least_bytes)
    first = large.groupBy("digest", "b").agg(F.max("page_id").alias("top"), F.count("*").alias("c")).where("c > 1")
    revisits = written(large.join(first, ["digest", "b"]).where(
        F.col("page_id").isNull() & F.col("top").isNotNull() | (F.col("page_id") < F.col("top"))).select(
        F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "top").distinct(), "warc-revisits")
    if check_size(revisits, MOST_MARKS, MOST_MARK_BYTES).bounded:
        revisits = F.broadcast(revisits)
    whole = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("payload_digest"))
    joined = whole.join(revisits, whole["page_id"].eqNullSafe(F.col("r_id"))
                        & (F.unhex("payload_digest") == F.col("r_digest")), "left")
    again = F.col("r_digest").isNotNull()
    return joined.select(
        F.col("page_id").cast("string").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"), "payload_digest", F.col("top").cast("string").alias("refers_to"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.when(~again, F.col("payload")).alias("payload"))
