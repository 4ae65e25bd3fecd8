"""WARC archives: round trip, revisits, rolling, determinism, edges."""

import base64
import gzip
import hashlib

import pytest
from corpusloom.llm import warc
from corpusloom.llm.queries import op2_warc_sharded_writer


def plain(rows, min_bytes=0):
    data = [(p, (html or "").encode()) for p, html in rows]
    first = {}
    for page, body in data:
        if page is not None and len(body) >= min_bytes:
            first[body] = min(page, first.get(body, page))
    out = []
    for page, body in data:
        low = first.get(body)
        again = page is not None and low is not None and page > low
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), sha, "revisit" if again else "response", low if again else None))
    return sorted(out, key=repr)


ROWS = [
    (5, "same"), (3, "same"), (9, "same"), (4, None), (7, ""), (1, "é\r\n\r\nWARC/1.1 \x00"), (2, "x" * 300_000), (None, "same"),
    (8, "tail\r\n"), (8, "tail\r\n"), (10, "tail\r\n"), (-6, "other"),
]
URLS = ["http://a.example/ü?q=1", "bad\r\nX-Page-Id: 99", None, "", "http://b.example/"]


@pytest.fixture
def pages(spark):
    rows = [(p, URLS[k % 5], h) for k, (p, h) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 shard", "2 sha", "3 payload")


def digest_rows(frame):
    return sorted(
        map(tuple, frame.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr
    )


def test_round_trip(pages, tmp_path):
    manifest = warc.write_archives(pages, str(tmp_path / "w"))
    back = warc.read_archives(manifest)
    assert digest_rows(back) == plain(ROWS)
    bodies = {(r.page_id, bytes(r.payload).decode()) for r in back.collect() if r.record_type == "response"}
    assert (1, ROWS[5][1]) in bodies and (4, "") in bodies and (2, "x" * 300_000) in bodies
    assert {r.url for r in back.where("page_id = 3").collect()} == {"bad%0D%0AX-Page-Id:%2099"}


def test_small_payloads_are_responses(pages, tmp_path):
    back = warc.read_archives(warc.write_archives(pages, str(tmp_path / "w"), min_bytes=5), payloads=False)
    assert digest_rows(back) == plain(ROWS, 5)


def test_rolling_and_determinism(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_ROWS", 4)
    held = []
    for k, frame in enumerate([pages, pages.orderBy("url").repartition(3)]):
        folder = tmp_path / str(k)
        manifest = warc.write_archives(frame, str(folder), roll_bytes=700).collect()
        held.append({p.name: p.read_bytes() for p in folder.iterdir()})
        assert {m.file.rsplit("/", 1)[1]: (m.bytes, m.sha) for m in manifest} == {
            n: (len(b), hashlib.sha1(b).hexdigest()) for n, b in held[-1].items()
        }
    assert held[0] == held[1] and len(held[0]) > 5
    text = b"".join(gzip.decompress(b) for _, b in sorted(held[0].items()))
    assert text.count(b"WARC-Record-ID") == len(ROWS)


def test_damage_is_found(pages, tmp_path):
    data = warc.record(1, "u", b"payload", None)
    whole = gzip.decompress(data)
    assert warc.parse(whole)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(whole.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))


def test_empty(pages, tmp_path):
    manifest = warc.write_archives(pages.limit(0), str(tmp_path / "w"))
    assert warc.read_archives(manifest).count() == 0


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect()]
    assert digest_rows(op2_warc_sharded_writer(spark, sf_dir)) == plain(rows)


def test_shards_of_ids(spark):
    from bisect import bisect_right

    for n in (0, 1, 2, 3, 10, 57):
        bounds = sorted({k * k - 5 for k in range(n)})
        rows = spark.range(-20, 3400, 7).select("id", warc._shard(warc.F.col("id"), bounds).alias("shard")).collect()
        assert all(r.shard == bisect_right(bounds, r.id) for r in rows)
