import base64
import hashlib
import io
import os
import random

import pytest
import zstandard

from snipmill.llm import warc

FIELDS = "page_id bigint, url string, html string, record_type string, bundle string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], FIELDS)


def stored(spark, rows, **more):
    df = pages(spark, rows)
    folder = warc.archive_folder(df)
    index = warc.write_bundles(df, folder, **more)
    return index, folder, warc.read_records(index, folder).collect()


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(8)
    texts = ["", "<p>a</p>", "ünï \x00\r\n\r\nWARC/1.1\r\n", "x" * 300_000]
    texts += ["".join(draw.choice("<p>ab \n") for _ in range(draw.randrange(2000))) for _ in range(20)]
    out = [(i, f"http://h/{i}", draw.choice(texts)) for i in range(120)]
    return [*out, (500, None, None), (501, "bad\r\nurl: x", "")]


def test_records_equal_brute_force(spark, rows):
    index, folder, found = stored(spark, rows)
    first = {}
    for i, _, t in sorted(rows):
        first.setdefault(t or "", i)
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    for i, url, t in rows:
        r, payload = by_id[i], (t or "").encode()
        own = first[t or ""]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), sha1(t))
        assert (r.record_type, r.refers_to) == (("response", None) if own == i else ("revisit", own))
        assert r.payload == (payload if own == i else None)
        assert r.url == " ".join((url or "").split())
    assert len({r.record_id for r in found}) == len(rows)


def test_bundles_are_ordinary_zstandard_files_and_seekable(spark, rows):
    index, folder, _ = stored(spark, rows)
    assert index.select("bundle", "frame").distinct().count() > index.select("bundle").distinct().count()
    for name in {r.bundle for r in index.collect()}:
        with open(os.path.join(folder, name), "rb") as file:
            plain = zstandard.ZstdDecompressor().stream_reader(
                io.BytesIO(file.read()), read_across_frames=True
            ).read()
        reader = warc.BundleReader(folder, name)
        assert plain == b"".join(reader.frame(i) for i in range(len(reader.frames)))
        reader.close()
        entries = [r for r in index.collect() if r.bundle == name]
        draw = random.Random(1)
        for r in draw.sample(entries, min(5, len(entries))):
            reader = warc.BundleReader(folder, name)
            found = warc.parsed(reader.frame(r.frame), r.offset)
            assert (found["record_id"], found["page_id"]) == (r.record_id, r.page_id)


def test_repeated_rows_and_missing_ids(spark):
    rows = [(1, "u", "a"), (2, "u", "a"), (2, "u", "b"), (2, "u", "b"), (5, "u", "b"),
            (None, "u", "a"), (None, "u", "z"), (None, "u", "z")]
    _, _, found = stored(spark, rows)
    kinds = sorted((r.page_id or 0, r.payload_digest, r.record_type, r.refers_to or 0) for r in found)
    a, b, z = map(sha1, "abz")
    wanted = [(1, a, "response", 0), (2, a, "revisit", 1), (2, b, "response", 0), (2, b, "revisit", 2),
              (5, b, "revisit", 2), (0, a, "revisit", 1), (0, z, "response", 0), (0, z, "response", 0)]
    assert kinds == sorted(wanted)
    assert len({r.record_id for r in found}) == len(rows)


def test_small_payloads_are_not_revisited(spark):
    rows = [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcd"), (4, "u", "abcd")]
    _, _, found = stored(spark, rows, least_bytes=4)
    assert {r.page_id: r.refers_to for r in found} == {1: None, 2: None, 3: None, 4: 3}


def test_empty_table(spark):
    assert stored(spark, [])[2] == []


def test_damage_is_noticed():
    data = warc.record({"payload": b"abc", "url": "u", "page_id": 1, "refers_to": None}, "urn:x")
    assert warc.parsed(data, 0)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parsed(data.replace(b"abc", b"abd"), 0)
    with pytest.raises(ValueError):
        warc.parsed(b"x" + data, 0)
