"""WARC records in ZIP archives whose members are stored, so that any record is one range read.

An archive holds a member with the records and a member with an index of them. Reading starts at the
end of the file: the end record (or its ZIP64 form) leads to the central directory, the
directory to the local header of a member, and that to the first byte of its data. From there the
index gives the range of every record. Nothing is unpacked to disk.

Tasks write archives of their own under names that no other attempt uses. Only the archives in the
manifest, a written table, count; what a lost attempt leaves behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import broadcast_if_small, text_or_empty, written
from punctual.session import shared_path

RECORDS, INDEX = "archive/data.warc", "indexes/index.cdxj"
#: A task begins a new archive after so many bytes of records, and reads records in groups of about this size.
ARCHIVE_BYTES, READ_BYTES = 256 << 20, 8 << 20

# Fixed values of the ZIP format: signatures, and fixed parts of the records after them.
END, END64, LOCATOR, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
END_PART, END64_PART, LOCATOR_PART = struct.Struct("<4s4H2LH"), struct.Struct("<4sQ2H2L4Q"), struct.Struct("<4sLQL")
ENTRY_PART, LOCAL_PART = struct.Struct("<4s6H3L5H2L"), struct.Struct("<4s5H3L2H")
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def classified(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, payload, digest, record_type, refers_to, copy_no of each row of ``pages``.

    Of records with equal payloads the one with the smallest id is the response, a null id coming last;
    the others revisit it. Of rows that share id and payload one is the response. A null html is the
    empty payload, and empty payloads are equal.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_or_empty(html_col).cast("binary").alias("payload")
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    order = F.struct(F.col("id").isNull().alias("no_id"), "id")
    each = rows.groupBy("digest", "id").agg(F.count("*").alias("twins"))
    groups = each.groupBy("digest").agg(F.min(F.struct(order.alias("o"), "twins")).alias("first"), F.sum("twins").alias("n"))
    groups = written(groups.where("n > 1").select("digest", F.col("first.o.id").alias("first_id"), F.col("first.twins").alias("twins")), "equal_payloads")
    met = rows.join(broadcast_if_small(groups, groups.count()), "digest", "left")
    leads = F.col("twins").isNull() | F.col("id").eqNullSafe(F.col("first_id"))
    tied = F.coalesce(leads & (F.col("twins") > 1), F.lit(False))
    kinds = ["id", "url", "payload", "digest"]
    plain = met.where(~tied).select(
        *kinds, F.when(leads, "response").otherwise("revisit").alias("record_type"),
        F.when(~leads, F.col("first_id")).alias("refers_to"), F.monotonically_increasing_id().alias("copy_no"),
    )
    # rows that share id and payload: any one of them leads, chosen by an aggregation of the others
    twins = met.where(tied).groupBy("digest", "id").agg(F.first("payload").alias("payload"), F.collect_list("url").alias("urls"), F.first("twins").alias("twins"))
    number = F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("twins")))
    twins = twins.select("*", number.alias("nth", "one")).select(
        "id", F.get("urls", F.col("nth")).alias("url"), "payload", "digest",
        F.when(F.col("nth") == 0, "response").otherwise("revisit").alias("record_type"),
        F.when(F.col("nth") > 0, F.col("id")).alias("refers_to"), F.col("nth").cast("long").alias("copy_no"),
    )
    return plain.unionByName(twins)


def record_id(page_id, copy_no: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{copy_no}')}>"


def one_line(value) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value))


def record(page_id, url, payload: bytes, digest: bytes, kind: str, refers_to, copy_no: int) -> bytes:
    """A WARC record: the HTTP head, and for a response the payload after it."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(page_id, copy_no if kind == "revisit" else 0),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": None if url is None else one_line(url),
        "WARC-Payload-Digest": f"sha1:{base64.b32encode(digest).decode()}",
        "Content-Type": "application/http; msgtype=response",
        "X-Page-ID": page_id,
        "Content-Length": len(block),
    }
    if kind == "revisit":
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["WARC-Refers-To"] = record_id(refers_to)
        fields["X-Refers-To-Page-ID"] = refers_to
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


class Archive:
    """One archive being written: records go straight to the file, the index follows at the end."""

    def __init__(self, folder: str):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.zip"
        self.path, self.size, self.index = f"{folder}/{name}", 0, io.BytesIO()
        self.out = store.open_output_stream(f"{root}/{name}")
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(RECORDS, "w", force_zip64=True)

    def add(self, data: bytes, entry: dict) -> None:
        self.member.write(data)
        self.index.write(json.dumps(entry | {"offset": self.size, "length": len(data)}).encode() + b"\n")
        self.size += len(data)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(INDEX, self.index.getvalue())
        self.zip.close()
        self.out.close()
        return self.path, self.size


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """The manifest (path, bytes) of archives with the rows of ``classified``, written below ``folder``.

    ``folder`` is one that all executors reach. A task without rows writes no archive.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive = None
        for batch in batches:
            for row in batch.itertuples(index=False):
                archive = archive or Archive(folder)
                data = record(row.id, row.url, row.payload, row.digest, row.record_type, row.refers_to, row.copy_no)
                archive.add(data, {"page_id": row.id, "type": row.record_type})
                if archive.size >= archive_bytes:
                    yield pd.DataFrame([archive.close()], columns=["path", "bytes"])
                    archive = None
        if archive:
            yield pd.DataFrame([archive.close()], columns=["path", "bytes"])

    # ids as text: pandas would make numbers with nulls floats
    named = rows.withColumns({c: F.col(c).cast("string") for c in ("id", "refers_to")})
    return written(named.mapInPandas(write, "path string, bytes bigint"), "manifest")


def read_range(file, start: int, length: int) -> bytes:
    file.seek(start)
    data = file.read(length)
    if len(data) != length:
        raise ValueError(f"{length} bytes wanted at {start}, {len(data)} there")
    return data


def directory(file, size: int) -> tuple[int, int]:
    """Offset and length of the central directory."""
    tail_at = max(0, size - END_PART.size - FULL16)
    tail = read_range(file, tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and (len(tail) - at < END_PART.size or at + END_PART.size + END_PART.unpack_from(tail, at)[7] != len(tail)):
        at = tail.rfind(END, 0, at)  # the signature may also stand in the comment
    if at < 0:
        raise ValueError("not a ZIP archive")
    _, _, _, _, count, length, offset, _ = END_PART.unpack_from(tail, at)
    if FULL16 == count or FULL32 in (length, offset):
        locator_at = tail_at + at - LOCATOR_PART.size
        if locator_at >= 0 and (locator := read_range(file, locator_at, LOCATOR_PART.size))[:4] == LOCATOR:
            end64 = END64_PART.unpack(read_range(file, LOCATOR_PART.unpack(locator)[2], END64_PART.size))
            if end64[0] != END64:
                raise ValueError("ZIP64 end record missing")
            length, offset = end64[8], end64[9]
    return offset, length


def members(file, size: int) -> dict[str, tuple[int, int]]:
    """Offset of the local header, and length of the data, of each stored member."""
    offset, length = directory(file, size)
    table, at, found = read_range(file, offset, length), 0, {}
    while at < len(table):
        part = ENTRY_PART.unpack_from(table, at)
        if part[0] != ENTRY:
            raise ValueError("central directory is damaged")
        flags, method = part[3], part[4]
        packed, plain = part[8], part[9]
        n_name, n_extra, n_comment, header = part[10], part[11], part[12], part[16]
        name_at = at + ENTRY_PART.size
        name = table[name_at : name_at + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = table[name_at + n_name : name_at + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<2H", extra)
            if kind == 1:  # ZIP64: only the values that did not fit, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                plain = next(wide) if plain == FULL32 else plain
                packed = next(wide) if packed == FULL32 else packed
                header = next(wide) if header == FULL32 else header
            extra = extra[4 + n :]
        if method == 0:
            found[name] = (header, packed)
        at = name_at + n_name + n_extra + n_comment
    return found


def data_start(file, header: int) -> int:
    part = LOCAL_PART.unpack(read_range(file, header, LOCAL_PART.size))
    if part[0] != LOCAL:
        raise ValueError("local header missing")
    return header + LOCAL_PART.size + part[9] + part[10]


def opened(path: str):
    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def locate(manifest: DataFrame) -> DataFrame:
    """(path, start, length) of each record of the archives, from their directories and indexes."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with opened(path) as file:
                    held = members(file, file.size())
                    first = data_start(file, held[RECORDS][0])
                    header, length = held[INDEX]
                    lines = read_range(file, data_start(file, header), length).splitlines()
                spans = [(first + e["offset"], e["length"]) for e in map(json.loads, lines)]
                yield pd.DataFrame(spans, columns=["start", "length"]).assign(path=path)[["path", "start", "length"]]

    return manifest.repartition("path").mapInPandas(find, "path string, start bigint, length bigint")


def parsed(data: bytes) -> dict:
    """Fields of one record, its HTTP payload (None for a revisit) and the length of the full payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    long = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        if len(payload) != long or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    else:
        payload = None
    return {"fields": fields, "payload": payload, "payload_bytes": long, "digest": digest}


def read_archives(manifest: DataFrame, id_type: str = "bigint", payloads: bool = True) -> DataFrame:
    """One row per record: id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    The payload of a revisit is null, its length is that of the HTTP head. Ranges that lie together
    are read by one task, in order.
    """
    spans = locate(manifest).withColumn("part", F.floor(F.col("start") / READ_BYTES))
    spans = spans.repartition("path", "part").sortWithinPartitions("path", "start")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, group in batch.groupby("path", sort=False):
                rows, size = [], 0
                with opened(path) as file:
                    for start, length in zip(group["start"], group["length"], strict=True):
                        x = parsed(read_range(file, int(start), int(length)))
                        f = x["fields"]
                        rows.append((
                            f.get("X-Page-ID"), f.get("WARC-Target-URI"), x["payload_bytes"], x["digest"],
                            f["WARC-Type"], f.get("X-Refers-To-Page-ID"), x["payload"] if payloads else None,
                        ))
                        size += length if payloads else 0
                        if size >= READ_BYTES:
                            yield pd.DataFrame(rows, columns=names)
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    names = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = "id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary"
    out = spans.mapInPandas(read, kinds)
    return out.withColumns({"id": F.col("id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` written to archives in the shared folder and read back, without the payloads.

    An empty table writes no archive and gives no record.
    """
    manifest = write_archives(classified(pages, id_col, url_col, html_col), shared_path(pages.sparkSession, "warc"))
    return read_archives(manifest, pages.schema[id_col].dataType.simpleString(), payloads=False).drop("payload")
