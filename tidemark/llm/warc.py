"""Web archives of pages, compressed record by record with a dictionary that each archive carries.

An archive is a ``.warc.zst`` file. It begins with a skippable frame that holds a Zstandard
dictionary (itself compressed), built from records of this very archive; then each record is a
frame of its own, so any record can be read alone, given the dictionary. Pages with equal payloads
are stored once: the one with the largest id is the response, the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import file_system, qualified, slices, stored, table
from tidemark.session import new_folder

#: Payload bytes of an archive (a longer page stands alone), and of a batch of rows that are read.
ARCHIVE_BYTES, READ_BYTES = 16 << 20, 4 << 20
#: Bytes of a dictionary, of the records that one is built from, and of one sample.
DICT_BYTES, SAMPLE_BYTES, PIECE_BYTES = 64 << 10, 4 << 20, 8 << 10
LEVEL = 6
#: No capture time is known.
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the formats: magic number of the skippable frame, of a frame, profile of revisits.
SKIPPABLE, FRAME = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "page_id long, url string, bytes long, sha1 binary, refers boolean, grouped boolean, head_id long, head_url string, payload binary"
MANIFEST = "name string, records long, dict_bytes long, payload_bytes long, stored_bytes long"
READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def decide(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """A row for each record to be written (``RECORD``); revisits come without their payload.

    Pages are grouped by the SHA-256 of their payload. Of a group the response has the largest id
    (null is the smallest), among these the largest url; of rows that agree in both, one. Payloads
    under ``least_bytes`` bytes are all responses.
    """
    payload = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    source = source.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("key", F.unhex(F.sha2("payload", 256)))
    sha1 = F.unhex(F.sha1("payload"))
    narrow = source.filter(F.col("bytes") >= least_bytes).select("key", "page_id", "url", "bytes", sha1.alias("sha1"))
    groups = stored(narrow.groupBy("key", "page_id", "url").agg(F.count(F.lit(1)).alias("m"), F.first("bytes").alias("bytes"), F.first("sha1").alias("sha1")), "page-groups")
    heads = groups.groupBy("key").agg(F.max(F.struct("page_id", "url")).alias("head"), F.sum("m").alias("n")).filter("n > 1")
    heads = stored(heads.select(F.col("key").alias("of"), "head"), "page-heads")

    own = F.struct("page_id", "url")
    joined = source.join(heads, F.col("key") == F.col("of"), "left")
    first = F.col("head").isNull() | F.col("head").eqNullSafe(own)
    kept = F.when(first, F.col("payload"))
    record = joined.select(
        "key", "page_id", "url", "bytes", sha1.alias("sha1"), (~first).alias("refers"), F.col("head").isNotNull().alias("grouped"),
        F.col("head.page_id").alias("head_id"), F.col("head.url").alias("head_url"), kept.alias("payload"),
    )
    # Rows that repeat a head word for word: one of them is the response.
    twins = groups.filter("m > 1").join(heads, F.col("key") == F.col("of")).filter(F.col("head").eqNullSafe(own))
    twins = stored(twins.select("of", "page_id", "url", "m", "bytes", "sha1"), "page-twins")
    if not twins.isEmpty():
        keys = twins.select("of")
        at_head = F.col("refers") | ~F.col("grouped")
        others = record.join(keys, (F.col("key") == F.col("of")) & ~at_head, "left_anti")
        one = record.filter(~at_head).join(keys, F.col("key") == F.col("of"), "left_semi").groupBy("key").agg(*[F.first(c).alias(c) for c in record.columns[1:]])
        again = twins.select(
            F.col("of").alias("key"), "page_id", "url", "bytes", "sha1", F.lit(True).alias("refers"), F.lit(True).alias("grouped"),
            F.col("page_id").alias("head_id"), F.col("url").alias("head_url"), F.lit(None).cast("binary").alias("payload"), F.explode(F.sequence(F.lit(2), F.col("m"))),
        )
        record = others.unionByName(one.select(record.columns)).unionByName(again.drop("col"))
    return record.drop("key")


def _uri(url: str) -> str:
    """Control characters and blanks would end a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _response_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url}')}>"


def warc_record(row: dict, date: str = DATE) -> bytes:
    """One record; the page's id and, for a revisit, that of the response are headers of their own."""
    digest = base64.b32encode(row["sha1"]).decode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if row['refers'] else 'response'}", f"WARC-Date: {date}"]
    own = _response_id(row["page_id"], row["url"], digest) if row["grouped"] and not row["refers"] else f"<urn:uuid:{uuid.uuid4()}>"
    lines.append(f"WARC-Record-ID: {own}")
    lines += [f"WARC-Target-URI: {_uri(row['url'])}"] if row["url"] is not None else []
    lines += [f"Page-ID: {row['page_id']}"] if row["page_id"] is not None else []
    if row["refers"]:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_response_id(row['head_id'], row['head_url'], digest)}"]
        lines += [f"WARC-Refers-To-Target-URI: {_uri(row['head_url'])}"] if row["head_url"] is not None else []
        lines += [f"Refers-To-Page-ID: {row['head_id']}"] if row["head_id"] is not None else []
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    size = len(http) + (0 if row["refers"] else row["bytes"])
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {size}"]
    return b"".join([*(f"{x}\r\n".encode() for x in lines), b"\r\n", http, b"" if row["refers"] else row["payload"], b"\r\n\r\n"])


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary for an archive's records, from pieces spread evenly over all of them.

    At most ``SAMPLE_BYTES`` are used. Where they are too few to train on, the pieces themselves
    are the dictionary.
    """
    pieces = [r[i : i + PIECE_BYTES] for r in records for i in range(0, len(r), PIECE_BYTES)]
    total = sum(map(len, pieces))
    pieces = pieces[:: max(1, -(-total // SAMPLE_BYTES))]
    size = max(256, min(DICT_BYTES, total // 16))
    try:
        return zstandard.train_dictionary(size, pieces, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(pieces)[:size], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def compressed(records: list[bytes]) -> tuple[bytes, Iterator[bytes]]:
    """The leading skippable frame, and a frame for each record."""
    words = build_dictionary(records)
    frame = zstandard.ZstdCompressor(level=LEVEL).compress(words.as_bytes())
    one = zstandard.ZstdCompressor(level=LEVEL, dict_data=words)
    return struct.pack("<II", SKIPPABLE, len(frame)) + frame, map(one.compress, records)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = DATE, **columns: str) -> DataFrame:
    """Write all pages to archives in a folder; returns a row for each archive.

    Null payloads are empty, null urls and ids have no header. Each attempt of a task writes files
    of its own; the returned table names those of the attempts that counted. An empty table has no
    archive. Other columns are ignored.
    """
    folder = qualified(pages.sparkSession, folder)
    files, root = file_system(folder)
    files.create_dir(root, recursive=True)

    def save(rows: list[dict]) -> pa.RecordBatch:
        files, root = file_system(folder)
        records = [warc_record(r, date) for r in rows]
        head, frames = compressed(records)
        name, size = f"pages-{uuid.uuid4().hex}.warc.zst", len(head)
        with files.open_output_stream(f"{root}/{name}", compression=None) as f:
            f.write(head)
            for frame in frames:
                f.write(frame)
                size += len(frame)
        values = [name, len(rows), len(head), sum(0 if r["refers"] else r["bytes"] for r in rows), size]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], ["name", "records", "dict_bytes", "payload_bytes", "stored_bytes"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in slices(batches, "payload"):
            for row in batch.to_pylist():
                rows.append(row)
                size += len(row["payload"] or b"") + 512
                if size >= ARCHIVE_BYTES:
                    yield save(rows)
                    rows, size = [], 0
        if rows:
            yield save(rows)

    return stored(decide(pages, least_bytes, **columns).mapInArrow(write, MANIFEST), "archives")


def frames_of(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive, one after the other; at most one of them is in memory."""
    words, data = None, stream.read(chunk)
    while True:
        while len(data) < 8 and (more := stream.read(chunk)):
            data += more
        if not data:
            return
        if data[:4] != FRAME:
            magic, size = struct.unpack("<II", data[:8])
            if magic & 0xFFFFFFF0 != 0x184D2A50:
                raise ValueError("not a Zstandard frame")
            while len(data) < 8 + size and (more := stream.read(chunk)):
                data += more
            if magic == SKIPPABLE:
                frame = data[8 : 8 + size]
                words = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(frame) if frame[:4] == FRAME else frame)
                reader = zstandard.ZstdDecompressor(dict_data=words)
            data = data[8 + size :]
            continue
        one, out = (reader if words else zstandard.ZstdDecompressor()).decompressobj(), []
        while True:
            out.append(one.decompress(data))
            if one.eof:
                break
            data = stream.read(chunk)
            if not data:
                raise ValueError("the archive ends within a record")
        data = one.unused_data
        yield b"".join(out)


def parse_record(record: bytes) -> tuple:
    """``READ`` from a record; the payload of a response must have the digest its header names."""
    head, _, body = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = body[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return number("Page-ID"), fields.get("WARC-Target-URI"), size, digest, kind, number("Refers-To-Page-ID"), payload if kind == "response" else None


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the archives in a table of names, a file at a time: ``READ``."""
    folder = qualified(archives.sparkSession, folder)
    names = READ.split(", ")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(folder)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [n.split()[0] for n in names])

        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for record in frames_of(stream):
                        row = parse_record(record)
                        rows.append(row if payloads else (*row[:-1], None))
                        size += len(row[-1] or b"") * payloads + 512
                        if size >= READ_BYTES:
                            yield made(rows)
                            rows, size = [], 0
                if rows:
                    yield made(rows)

    count = max(1, archives.count())
    return archives.select("name").repartition(min(count, 10_000)).mapInArrow(read, READ)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written as archives and read back from them."""
    folder = new_folder(spark, "warc")
    archives = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(archives, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base 32 of the SHA-1: 32 letters for 5 bits each.
_BITS = " + ".join(f"{1 << (4 - j)} * (ascii(substr(bits, CAST(5 * i + {j + 1} AS INTEGER), 1)) - 48)" for j in range(5))
ORACLE = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS head FROM pages),
q AS (SELECT *, CAST(CAST(unhex(sha1(body)) AS BIT) AS VARCHAR) AS bits FROM p)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + {_BITS} AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> head THEN head END AS refers_to
FROM q
"""
