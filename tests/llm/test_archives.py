"""WARC archives: exact round trips and damage."""

import hashlib
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from playerlens.llm import warc


def expected(rows):
    last = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None and len(data) >= 1000:
            last[data] = max(last.get(data, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = last.get(data)
        refers = to is not None and i != to
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", to if refers else None))
    return sorted(out, key=str)


def number(value):
    text = (value or "")[len("<urn:page:") : -1]
    return int(text) if text else None


def read(spark, path):
    return [
        (number(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"]))
        for r in warc.read_archives(spark, path).collect()
    ]


@pytest.fixture
def rows():
    rng = random.Random(2)
    page = lambda n: "".join(rng.choice("<p>é€😀abc \r\n\x00") for _ in range(n))
    same = page(1500)
    made = [(i, f"http://x.org/{i}", page(rng.randint(0, 3000))) for i in range(80)]
    made += [(200 + i, "http://x.org/same", same) for i in range(5)] + [(204, "http://x.org/same", same)]
    made += [(300, "u", "short"), (301, "u", "short"), (302, None, None), (None, "u", same), (303, "a\r\nb: c", "")]
    made += [(304, "u", warc.SEPARATOR * 400), (305, "u", "\r\n\r\n" * 300), (306, "u", "x" * 3_000_000)]
    return made


def test_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.withColumn("digest", F.lit("mine")).repartition(3)
    warc.write_archives(df, f"file://{tmp_path}/w")
    assert sorted(read(spark, f"file://{tmp_path}/w"), key=str) == expected(rows)
    payloads = {
        number(r["record_id"]): bytes(r["payload"]).decode()
        for r in warc.read_archives(spark, f"file://{tmp_path}/w").filter("record_type = 'response'").collect()
    }
    assert all(payloads[i] == (h or "") for i, _, h in rows if i in payloads)


def test_archives_are_ordinary_files(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, f"file://{tmp_path}/w")
    file = next((tmp_path / "w").glob("part-*"))
    data = file.read_bytes()
    (_, skippable, dictionary), *rest = warc.frames(data)
    assert skippable and data[:4] == bytes([0x5D, 0x2A, 0x4D, 0x18])
    assert sum(not s for _, s, _ in rest) == len(rows)
    known = zstandard.ZstdCompressionDict(dictionary)
    with zstandard.ZstdDecompressor(dict_data=known).stream_reader(data, read_across_frames=True) as stream:
        assert stream.read().count(b"WARC/1.1\r\n") >= len(rows)


def test_damage_is_reported(spark, tmp_path, rows):
    coder = zstandard.ZstdCompressor()
    good = [warc.record(i, u, (h or "").encode(), hashlib.sha1((h or "").encode()).hexdigest(), None) for i, u, h in rows[:6]]
    bad = [
        good[0].replace(b"WARC/1.1", b"WARC/9.9"),
        good[1].replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9", 1),
        good[2].replace(b"sha1:", b"sha1:A"),
        b"",
    ]
    data = b"".join(map(coder.compress, good + bad)) + coder.compress(good[5])[:-7]
    (tmp_path / "a.warc.zst").write_bytes(data)
    (tmp_path / "empty.warc.zst").write_bytes(b"")
    (tmp_path / "junk.warc.zst").write_bytes(b"not zstandard at all")
    found = warc.read_archives(spark, f"file://{tmp_path}").collect()
    assert sum(r["error"] is None for r in found) == 6
    assert sum(r["error"] is not None for r in found) == len(bad) + 2


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(df, f"file://{tmp_path}/w")
    assert read(spark, f"file://{tmp_path}/w") == []
