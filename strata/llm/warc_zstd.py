"""WARC archives in Zstandard with a dictionary in front.

An archive starts with a skippable frame (magic 0x184D2A5D) whose content is
the dictionary, itself compressed or not; then each record is a frame of its
own. The reader takes (path, content) rows as Spark's ``binaryFile`` source
gives them, loads the dictionary from the leading skippable frame, decodes
one frame per record and validates headers, lengths and payload digests. The
writer makes such rows from pages, at most ``archive_bytes`` of records each
(one larger record has an archive to itself).

A payload that several pages share is stored once, with the largest page_id;
the others become revisit records that refer to it.

Defined results: a NULL html is the empty payload; empty payloads are equal
to each other; a page_id that is repeated with the same payload is a response
in each of its rows when it is the largest; a NULL page_id is smaller than any
other and reads back as NULL (a payload held by NULL page_ids alone is a
response in each row). An empty table gives no archive. A broken archive (no
dictionary frame, a frame cut short, a wrong length or digest) raises.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

MAGIC = 0x184D2A5D
PLAIN = 0xFD2FB528
ARCHIVE_BYTES = 8 << 20
DICT_BYTES = 16 << 10
SAMPLES = 200  # records of the archive that its dictionary is trained on
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the first records; empty where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, [r[:4096] for r in records[:SAMPLES]])
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def record(page_id: int | None, url: str | None, html: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record. A revisit carries no payload; its length stands in
    an extension field."""
    body = b"" if revisit else html
    name = lambda x: "" if x is None else f"<urn:page:{x}>"
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(page_id)),
              ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
              ("WARC-Payload-Digest", "sha1:" + digest(html)), ("X-Payload-Length", str(len(html)))]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", name(refers_to))]
    fields += [("Content-Type", "text/html"), ("Content-Length", str(len(body)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + body + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    words = dictionary(records)
    raw = words.as_bytes()
    made = zstandard.ZstdCompressor(level=3, dict_data=words, write_content_size=True, write_checksum=True)
    return struct.pack("<II", MAGIC, len(raw)) + raw + b"".join(map(made.compress, records))


def parse(raw: bytes) -> dict:
    """A record's fields and payload; ValueError if headers or lengths are wrong."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.partition(":")
        if not colon or not key.strip():
            raise ValueError(f"broken header line: {line[:80]!r}")
        fields[key.strip().lower()] = value.strip()
    if missing := {"warc-type", "warc-record-id", "warc-payload-digest", "content-length"} - fields.keys():
        raise ValueError(f"missing header: {sorted(missing)}")
    if fields["warc-type"] not in ("response", "revisit"):
        raise ValueError(f"unexpected record type {fields['warc-type']!r}")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("the record's length isn't its Content-Length")
    body, revisit, stated = rest[:n], fields["warc-type"] == "revisit", int(fields.get("x-payload-length", n))
    if not revisit and (stated != n or "sha1:" + digest(body) != fields["warc-payload-digest"]):
        raise ValueError("the payload isn't what its digest or length says")
    page = lambda x: int(x[len("<urn:page:"):-1]) if x else None
    return {"page_id": page(fields["warc-record-id"]), "url": fields.get("warc-target-uri") or None,
            "record_type": fields["warc-type"], "refers_to": page(fields.get("warc-refers-to", "")),
            "payload_bytes": stated, "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
            "payload": None if revisit else body}


def frames(content: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive, after its dictionary."""
    if len(content) < 8:
        raise ValueError("no dictionary frame")
    magic, n = struct.unpack_from("<II", content)
    raw = content[8:8 + n]
    if magic != MAGIC or len(raw) != n:
        raise ValueError("no dictionary frame")
    if raw[:4] == struct.pack("<I", PLAIN):
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    rest = memoryview(content)[8 + n:]
    plain = zstandard.DICT_TYPE_AUTO if raw else zstandard.DICT_TYPE_RAWCONTENT
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=plain))
    while len(rest):
        one = reader.decompressobj()
        made = one.decompress(rest)
        if not one.eof:
            raise ValueError("a frame is cut short")
        rest = memoryview(one.unused_data)
        yield made


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(path, content) rows: all pages as records, equal payloads stored once."""
    p = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"),
                     F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary").alias("html"))
    p = p.withColumn("sha1", F.sha1("html"))
    shared = (p.groupBy("sha1").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("sha1", "first"))
    p = p.join(shared, "sha1", "left")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, made = [], 0, 0

        def out() -> pd.DataFrame:
            content = archive(held)
            return pd.DataFrame({"path": [hashlib.sha1(content).hexdigest() + ".warc.zst"], "content": [content]})
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                page = None if pd.isna(row.page_id) else int(row.page_id)
                first = None if pd.isna(row.first) else int(row.first)
                one = record(page, row.url, bytes(row.html), first, first is not None and page != first)
                if held and size + len(one) > archive_bytes:
                    yield out()
                    held, size, made = [], 0, made + 1
                held.append(one)
                size += len(one)
        if held:
            yield out()
    small = p.select("page_id", "url", "html", "first").withColumns(
        {c: F.col(c).cast("string") for c in ("page_id", "first")})  # exact, also next to NULLs
    return small.mapInPandas(write, "path string, content binary")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of (path, content) rows; ``payloads=False`` leaves
    the payload column NULL (headers, lengths and digests are still checked)."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                held, size = [], 0
                for one in map(parse, frames(bytes(row.content))):
                    size += len(one["payload"] or b"")
                    held.append(one if payloads else one | {"payload": None})
                    if size > ARCHIVE_BYTES:
                        yield _frame(held)
                        held, size = [], 0
                if held:
                    yield _frame(held)
    return archives.select("path", "content").mapInPandas(read, RECORD)


def _frame(records: list[dict]) -> pd.DataFrame:
    pdf = pd.DataFrame(records)
    return pdf.astype({c: "Int64" for c in ("page_id", "refers_to", "payload_bytes")})


def round_trip(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages' archives to the shared folder and read them back."""
    return read_archives(stored(write_archives(pages, archive_bytes), "warc"), payloads=False).drop("url", "payload")
