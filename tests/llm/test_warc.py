import base64
import hashlib
import random
from pathlib import Path

import pytest
import zstandard

from keyrill.llm import warc
from keyrill.llm.queries import op5_warc_bundles

SCHEMA = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def plain(rows, least=0):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        size = len((html or "").encode())
        head = first.get(html or "")
        revisit = page is not None and head != page and size >= least
        out.append((page, size, digest(html), "revisit" if revisit else "response", head if revisit else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(4)
    body = [("<p>é" + "".join(rng.choice("abc ") for _ in range(rng.randrange(2000))) + "</p>") for _ in range(30)]
    rows = [(i, f"http://x.example/{i}", body[i % 30]) for i in range(90)]
    rows += [(200, None, None), (201, "http://y\r\nWARC-Type: evil", ""), (None, "http://z", "lost"), (203, "http://l", "é" * 300_000)]
    rows += [(0, "http://x.example/0", body[0])]
    return rows


def as_rows(frame):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect()), key=str)


def test_query(spark, sf_dir):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert as_rows(op5_warc_bundles(spark, sf_dir)) == plain(rows)


@pytest.mark.parametrize("least", [0, 1000])
def test_edge_cases(spark, pages, tmp_path, least):
    frame = spark.createDataFrame([(*r, "x") for r in pages], SCHEMA + ", payload_digest string").repartition(3)
    folder = str(tmp_path / f"w{least}")
    places = warc.write(frame, folder, least, frame_bytes=3000, bundle_bytes=9000)
    assert as_rows(warc.read(places, folder)) == plain(pages, least)
    back = {r.page_id: bytes(r.payload) for r in warc.read(places, folder, True).collect() if r.record_type == "response"}
    texts = {p: (h or "").encode() for p, _, h in pages}
    assert all(texts[p] == payload for p, payload in back.items())

    some = places.filter("page_id % 7 = 3")
    assert sorted(r.page_id for r in warc.fetch(some, folder).collect()) == sorted(r.page_id for r in some.collect())

    for path in Path(folder).glob("*.warc.zst"):
        data = path.read_bytes()
        frames = warc.read_seek_table(data)
        assert len(frames) > 1 or len(data) < 700_000
        whole = b"".join(warc._frames(data))
        plain_reader = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True)
        assert plain_reader.read() == whole  # any reader can expand the file


def test_empty(spark):
    assert warc.warc_digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_damage_is_noticed():
    data = warc.record(1, "http://a", b"payload", None)
    with pytest.raises(ValueError, match="does not match"):
        warc.read_record(data.replace(b"payload", b"paYload", 1) if data.count(b"payload") == 1 else data[::-1].replace(b"daolyap", b"daolYap", 1)[::-1])
