"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Archives are files that Spark itself writes and reads, so they may lie in any store that Spark
reaches, and a lost task is simply written again. A file is a sequence of frames: first a skippable
frame with the dictionary, then one frame per record. Spark's line writer puts a separator after
each frame; the separator used is an empty skippable frame, which readers of the format pass over.
"""

from __future__ import annotations

import hashlib
import struct
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import map_arrow
from windrow.operators.joins import attach

DICTIONARY_MAGIC = 0x184D2A5D          # fixed value of the format
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\0\0\0\0"        # skippable, nothing in it; all ASCII
REVISIT_FROM = 1000                    # bytes of payload from which copies become revisits
DICTIONARY_BYTES = 64 * 1024
SAMPLE_PAGES = 1_000                   # pages the dictionary is trained on, about
SAMPLE_PAGE_BYTES = 64 * 1024          # longer pages are left out of that sample
ARCHIVE_BYTES = 8 * 1024 * 1024        # payload per archive, about
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def train_dictionary(pages: DataFrame, payload_col: str = "html") -> bytes:
    """A dictionary from about ``SAMPLE_PAGES`` pages drawn by hash; empty if they are too few."""
    rows = pages.select(F.col(payload_col).cast("string").alias("payload")).filter(
        F.octet_length("payload").between(1, SAMPLE_PAGE_BYTES))
    share = SAMPLE_PAGES / max(1, rows.count())
    drawn = F.pmod(F.xxhash64("payload"), F.lit(1 << 20)) < share * (1 << 20)
    sample = [r[0].encode() for r in rows.filter(drawn).select("payload").distinct()
              .limit(2 * SAMPLE_PAGES).collect()]
    try:
        size = min(DICTIONARY_BYTES, sum(map(len, sample)) // 8)
        return zstandard.train_dictionary(size, sample).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _record(page_id, url, payload: bytes, digest: str, refers_to, is_revisit: bool) -> bytes:
    target = quote(url, safe=":/?#[]@!$&'()*+,;=%-._~") if url else "urn:page:unknown"
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n")
    block = http if is_revisit else http + payload
    fields = [("WARC-Type", "revisit" if is_revisit else "response"),
              ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
              ("WARC-Date", DATE), ("WARC-Target-URI", target),
              ("WARC-Payload-Digest", f"sha1:{digest}")]
    if is_revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", least: int = REVISIT_FROM) -> DataFrame:
    """page_id, url, payload (null as empty), digest, and refers_to for later copies.

    Only payloads that occur more than once are joined back, with the rows of a very frequent one
    spread over tasks. Of equal payloads the largest id is the response, also where it is repeated;
    a null id is below all others, and payloads with null ids only are responses.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
                        F.sha1(payload.cast("binary")).alias("digest"))
    copies = (rows.filter(F.octet_length("payload") >= least).groupBy("digest")
              .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("holder"))
              .filter((F.col("n") > 1) & F.col("holder").isNotNull()).select("digest", "holder"))
    refers: Column = F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder"))
    return attach(rows, copies, ["digest"], spread=["page_id"]).select(
        "page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(marked: DataFrame, folder: str, dictionary: bytes = b"") -> None:
    """Write rows of :func:`mark_revisits` as archives below ``folder``, one per task.

    The rows are dealt evenly, so that an archive holds about ``ARCHIVE_BYTES`` of payload.
    """
    size = marked.agg(F.coalesce(F.sum(F.octet_length("payload")), F.lit(0))).first()[0]
    parts = max(1, -(-int(size) // ARCHIVE_BYTES))

    def frames(batches):
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
        out = [_skippable(DICTIONARY_MAGIC, dictionary)] if dictionary else []
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, digest, refers = (c[i].as_py() for c in batch.columns)
                out.append(packer.compress(_record(page, url, payload.encode(), digest, refers,
                                                   refers is not None)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])
            out = []
    (marked.repartition(parts).mapInArrow(frames, "frame binary")
     .select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", EMPTY_FRAME).text(folder))


def read_frames(content: memoryview):
    """The bytes of each record of one archive; raises ``ValueError`` where it is damaged."""
    dictionary, at, first = None, 0, True
    while at < len(content):
        if len(content) - at < 8:
            raise ValueError(f"archive is cut off at byte {at}")
        magic, = struct.unpack_from("<I", content, at)
        if magic in SKIPPABLE:
            length, = struct.unpack_from("<I", content, at + 4)
            if at + 8 + length > len(content):
                raise ValueError(f"skippable frame at byte {at} is cut off")
            if first and magic == DICTIONARY_MAGIC:
                held = bytes(content[at + 8:at + 8 + length])
                if held[:4] == struct.pack("<I", FRAME_MAGIC):
                    held = zstandard.ZstdDecompressor().decompress(held)
                dictionary = zstandard.ZstdCompressionDict(held)
            at += 8 + length
        elif magic == FRAME_MAGIC:
            unpacker = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            record = unpacker.decompress(content[at:])
            if not unpacker.eof:
                raise ValueError(f"frame at byte {at} is cut off")
            at = len(content) - len(unpacker.unused_data)
            yield record
        else:
            raise ValueError(f"no frame at byte {at}")
        first = False


def _header(data: bytes) -> tuple[str, dict[str, str], int]:
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("header has no end")
    first, *lines = data[:end].decode().split("\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header line without a colon: {line!r}")
        fields[name.strip().lower()] = value.strip()
    return first, fields, end + 4


def parse_record(data: bytes) -> dict:
    """Headers and payload of a record; raises ``ValueError`` unless all lengths and the digest agree."""
    first, fields, at = _header(data)
    if not first.startswith("WARC/1."):
        raise ValueError(f"not a WARC record: {first!r}")
    length = int(fields["content-length"])
    block = data[at:at + length]
    if len(block) != length or data[at + length:] != b"\r\n\r\n":
        raise ValueError("Content-Length does not agree with the record")
    status, http, body = _header(block)
    if not status.startswith("HTTP/"):
        raise ValueError(f"not an HTTP response: {status!r}")
    payload, kind = block[body:], fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(http["content-length"])
    if kind == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("payload does not agree with its length or digest")
    elif kind != "revisit" or payload or "warc-refers-to" not in fields:
        raise ValueError(f"unexpected record of type {kind!r}")

    def page(name: str) -> int | None:
        value = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(value) if value else None
    return {"page_id": page("warc-record-id"), "url": fields["warc-target-uri"],
            "record_type": kind, "payload_bytes": size, "payload_digest": digest,
            "refers_to": page("warc-refers-to"), "payload": payload if kind == "response" else None}


RECORD = ("page_id bigint, url string, record_type string, payload_bytes bigint, "
          "payload_digest string, refers_to bigint, payload binary")


def read_archives(spark, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives below ``folder``, one row each, validated.

    An archive is read by one task. A damaged one raises, naming its file.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select(
        "path", "content")
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def records(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not content.is_valid:
                    continue
                rows, held = [], 0
                try:
                    for data in read_frames(memoryview(content.as_buffer())):
                        rows.append(parse_record(data))
                        if not with_payload:
                            rows[-1]["payload"] = None
                        held += len(rows[-1]["payload"] or b"") + 200
                        if held > 16 << 20:
                            yield _batch(rows, names, kinds)
                            rows, held = [], 0
                except (ValueError, KeyError, zstandard.ZstdError) as error:
                    raise ValueError(f"{path}: {error}") from error
                if rows:
                    yield _batch(rows, names, kinds)
    return files.mapInArrow(records, RECORD)


def _batch(rows: list[dict], names, kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)


def round_trip(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", with_payload: bool = True) -> DataFrame:
    """Write ``pages`` as archives below ``folder`` and read the records back.

    A null payload is an empty one. An empty table gives archives without records, hence no rows.
    """
    marked = mark_revisits(pages, id_col, url_col, payload_col)
    write_archives(marked, folder, train_dictionary(pages, payload_col))
    return read_archives(pages.sparkSession, folder, with_payload)
