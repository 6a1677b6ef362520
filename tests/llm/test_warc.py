"""WARC writer and reader: round trip, revisits, rolling, determinism, damage."""

from __future__ import annotations

import base64
import gzip
import hashlib
import os

import pytest

from kpi_lake.llm import warc

ROWS = [
    (1, "http://a/ b\r\nX: y", "<p>é</p>"),
    (2, "http://b/", "<p>é</p>"),
    (3, None, None),
    (4, "http://d/", ""),
    (5, "http://e/", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
    (6, "http://f/", "x" * 200_000),
    (None, "http://g/", "<p>é</p>"),
    (8, "http://h/", "unique"),
    (8, "http://h/", "unique"),
    (8, "http://h/", "other"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def want(rows, least=0):
    largest = {}
    for i, _, t in rows:
        if i is not None and len((t or "").encode()) >= least:
            largest[t or ""] = max(largest.get(t or "", i), i)
    out = []
    for i, _, t in rows:
        to = largest.get(t or "")
        revisit = to is not None and i != to
        out.append((i, len((t or "").encode()), digest(t), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def pages(spark, rows, n=3):
    return spark.createDataFrame([(*r, 1, "d") for r in rows], "page_id bigint, url string, html string, kind int, digest string").repartition(n)


def read(spark, folder, **options):
    rows = warc.read_warc(spark, folder, **options).collect()
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str), rows


@pytest.mark.parametrize("least", [0, 7])
def test_round_trip_and_revisits(spark, scratch_dir, least):
    warc.write_warc(pages(spark, ROWS), scratch_dir, min_revisit_bytes=least)
    got, rows = read(spark, scratch_dir, with_payload=True)
    assert got == want(ROWS, least)
    texts = {(i, digest(t)): (t or "").encode() for i, _, t in ROWS}
    for r in rows:
        assert r.payload == (texts[r.page_id, r.payload_digest] if r.record_type == "response" else None)
        assert "\n" not in r.url and " " not in r.url


def test_bytes_depend_on_records_only_and_files_roll(spark, scratch_dir):
    rows = [(i, f"http://x/{i}", hashlib.sha256(str(i).encode()).hexdigest() * 30) for i in range(300)]
    for name, n in (("one", 1), ("two", 5)):
        warc.write_warc(pages(spark, rows, n), f"{scratch_dir}/{name}", roll_bytes=4000, range_bytes=10**9)
    first, second = (
        sorted(tuple(r) for r in warc.read_manifest(spark, f"{scratch_dir}/{name}").collect()) for name in ("one", "two")
    )
    assert first == second and len(first) > 5
    assert sum(r[2] for r in first) == 300 and all(r[1] >= 4000 for r in first[:-1])
    for name, size, *_ in first:
        path = f"{scratch_dir}/one/{name}"
        assert os.path.getsize(path) == size
        assert gzip.open(path).read().startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert os.listdir(f"{scratch_dir}/one/_temporary") == []


def test_files_outside_the_manifest_do_not_count_and_damage_is_found(spark, scratch_dir):
    warc.write_warc(pages(spark, ROWS[:2]), scratch_dir)
    name = warc.read_manifest(spark, scratch_dir).first().file
    with open(f"{scratch_dir}/{name}", "rb") as f:
        data = f.read()
    with open(f"{scratch_dir}/part-99999-00000.warc.gz", "wb") as f:
        f.write(data)
    assert len(read(spark, scratch_dir)[0]) == 2
    with open(f"{scratch_dir}/{name}", "wb") as f:
        f.write(data + data)
    with pytest.raises(Exception, match="manifest"):
        read(spark, scratch_dir)


def test_empty_table(spark, scratch_dir):
    warc.write_warc(pages(spark, ROWS).limit(0), scratch_dir)
    assert read(spark, scratch_dir)[0] == []


def test_a_read_has_a_task_a_file(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i} " * 50) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    folder = str(tmp_path / "archive")
    manifest = warc.write_warc(pages, folder, roll_bytes=2000, range_bytes=20_000)
    found = warc.read_warc(spark, folder)
    assert found.rdd.getNumPartitions() == manifest.count() > 3 and found.count() == 200
