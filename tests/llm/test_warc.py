"""Archives: whole round trips, equal payloads, the dictionary, and what is in the files."""

import base64
import hashlib
import os
import struct

import pytest
import zstandard
from compare import duck_rows, spark_rows
from pyspark.sql import functions as F

from tidemark.llm import warc

KINDS = "page_id long, url string, html string, payload string, `key` string, head int, n int, of string"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "p", "k", 1, 2, None) for r in rows], KINDS).repartition(partitions)


def brute(rows, least=0):
    """Expected (page_id, bytes, digest, type, refers_to), repeated heads revisit the first."""
    out, groups = [], {}
    for i, url, html in rows:
        groups.setdefault(html or "", []).append((i is not None, i or 0, url is not None, url or "", i))
    for html, own in groups.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        own.sort()
        for k, row in enumerate(own):
            one = len(data) < least or k == len(own) - 1
            out.append((row[-1], len(data), digest, "response" if one else "revisit", None if one else own[-1][-1]))
    return sorted(out, key=repr)


def written(df, tmp_path, **options):
    archives = warc.write_archives(df, str(tmp_path / "out"), **options)
    read = warc.read_archives(archives, str(tmp_path / "out")).collect()
    return archives.collect(), read


def short(rows):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=repr)


ROWS = [(i, f"http://h/{i} x\r\n", f"<p>page {i} über {'text ' * (i % 40)}</p>") for i in range(120)]
ROWS += [(200 + i, None, "<b>same</b>") for i in range(30)] + [(300, "u", None), (301, "u", ""), (302, "v", "")]
ROWS += [(None, None, "<b>same</b>"), (None, "w", "only"), (400, "x", "twin"), (400, "x", "twin"), (400, "x", "twin"), (399, "y", "twin"), (400, "a", "twin")]
ROWS += [(500, "z", "<i>" + "long é \n" * 200_000)]


@pytest.mark.parametrize("archive", [1, 4000, 16 << 20])
def test_round_trip(spark, tmp_path, monkeypatch, archive):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive)
    archives, read = written(frame(spark, ROWS), tmp_path)
    assert short(read) == brute(ROWS)
    assert sum(a.records for a in archives) == len(ROWS)
    payloads = {r.payload_digest: r.payload for r in read if r.record_type == "response"}
    assert sorted(payloads.values()) == sorted({(r[2] or "").encode() for r in ROWS})
    assert all(r.payload is None for r in read if r.record_type == "revisit")
    assert {r.url for r in read if r.page_id == 5} == {"http://h/5%20x%0D%0A"}


def test_least_bytes(spark, tmp_path):
    _, read = written(frame(spark, ROWS), tmp_path, least_bytes=5)
    assert short(read) == brute(ROWS, 5)


def test_empty_table(spark, tmp_path):
    assert written(frame(spark, []), tmp_path) == ([], [])


def test_files_hold_a_dictionary_and_a_frame_for_each_record(spark, tmp_path):
    archives, read = written(frame(spark, ROWS, 1), tmp_path)
    seen = 0
    for a in archives:
        data = (tmp_path / "out" / a.name).read_bytes()
        assert len(data) == a.stored_bytes
        magic, size = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D and size + 8 == a.dict_bytes
        words = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
        at = data[8 + size :]
        while at:
            one = zstandard.ZstdDecompressor(dict_data=words).decompressobj()
            record = one.decompress(at)
            at, seen = one.unused_data, seen + 1
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    assert seen == len(ROWS) == len(read)
    assert sorted(os.listdir(tmp_path / "out")) == sorted(a.name for a in archives)


def test_revisits_name_a_record_that_exists(spark, tmp_path):
    archives, _ = written(frame(spark, ROWS), tmp_path)
    ids, refers = [], set()
    for a in archives:
        with open(tmp_path / "out" / a.name, "rb") as f:
            for record in warc.frames_of(f, chunk=7):
                for line in record.split(b"\r\n\r\n")[0].split(b"\r\n"):
                    ids += [line[16:]] if line.startswith(b"WARC-Record-ID: ") else []
                    refers |= {line[16:]} if line.startswith(b"WARC-Refers-To: ") else set()
    assert len(ids) == len(set(ids)) and refers and refers <= set(ids)


def test_dictionary_is_trained_and_helps():
    records = [f"<html><head><title>{i}</title></head><body class='main wide'><p>number {i * i}</p></body></html>".encode() for i in range(4000)]
    words = warc.build_dictionary(records)
    assert words.as_bytes()[:4] == b"\x37\xa4\x30\xec"  # a trained dictionary, not raw bytes
    head, frames = warc.compressed(records)
    plain = zstandard.ZstdCompressor(level=warc.LEVEL)
    assert len(head) + sum(map(len, frames)) < 0.8 * sum(len(plain.compress(r)) for r in records)


def test_damage_is_noticed():
    row = {"page_id": 1, "url": "u", "bytes": 3, "sha1": hashlib.sha1(b"abc").digest(), "refers": False, "grouped": False, "head_id": None, "head_url": None, "payload": b"abc"}
    record = warc.warc_record(row)
    assert warc.parse_record(record)[0] == 1
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(record.replace(b"abc\r\n", b"abd\r\n"))
    with pytest.raises(ValueError, match="ends within"):
        import io

        head, frames = warc.compressed([record] * 3)
        list(warc.frames_of(io.BytesIO((head + b"".join(frames))[:-4])))


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert spark_rows(warc.op12_warc(spark, sf)) == duck_rows(sf, warc.ORACLE)


def test_sql_groups_equal_payloads(spark, tmp_path):
    rows = [r for r in ROWS if r[0] is not None and r[0] != 400]
    frame(spark, rows).select("page_id", "url", "html").coalesce(1).write.parquet(str(tmp_path / "p"))
    part = next(p for p in os.listdir(tmp_path / "p") if p.endswith(".parquet"))
    os.makedirs(tmp_path / "sf")
    os.link(tmp_path / "p" / part, tmp_path / "sf" / "pages.parquet")
    assert spark_rows(warc.op12_warc(spark, str(tmp_path / "sf")).select(F.col("*"))) == duck_rows(tmp_path / "sf", warc.ORACLE)
