import gzip
import hashlib

from tidemark.llm import warc
from tidemark.llm.common import shared_folder


def expected(rows):
    first = {}
    for page_id, _, html in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        p = (html or "").encode()
        if len(p) >= 100 and page_id is not None:
            first.setdefault(p, page_id)
    out, given = [], set()
    for page_id, url, html in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        p = (html or "").encode()
        f = first.get(p)
        twice = sum((h or "").encode() == p for _, _, h in rows) > 1
        revisit = twice and f is not None and (f != page_id or p in given)
        if f == page_id:
            given.add(p)
        out.append((page_id, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_round_trip_and_determinism(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    base = [(r.page_id, r.url, r.html) for r in pages.collect()]
    rows = base + [(1000 + i, f"http://x/{i}", base[i % 7][2]) for i in range(20)] + [(3, "http://again/ü\n", base[3][2]), (2000, None, None), (2001, "u", ""), (None, "v", base[0][2]), (2002, "w", "a" * 99), (2003, "w", "a" * 99), (2004, "w", "é" * 50), (2005, None, "é" * 50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as shard", "'x' as digest")
    texts = []
    for parts in (3, 7):
        folder = shared_folder(spark)
        files = warc.write(df.repartition(parts), folder, shard_bytes=40_000, roll_bytes=9_000).collect()
        assert len({f.shard for f in files}) > 2 and len(files) > len({f.shard for f in files})
        assert all(f.bytes < 60_000 for f in files) and sum(f.records for f in files) == len(rows)
        texts.append({f.file: f.sha256 for f in files})
        back = warc.read(spark, folder)
        assert got(back) == expected(rows)
        by_id = {(r[0], r[2]) for r in rows}
        assert all((r.page_id, bytes(r.payload).decode() or None) in by_id or (r.page_id, "") in by_id for r in back.filter("record_type = 'response'").collect())
        with gzip.open(folder.removeprefix("file://") + "/" + sorted(f.file for f in files)[0]) as f:
            assert f.read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    assert texts[0] == texts[1]


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    folder = shared_folder(spark)
    assert warc.write(df, folder).count() == 0
    assert warc.read(spark, folder).count() == 0


def test_jobs_can_be_repeated(spark, small):
    import os

    pages = spark.read.parquet(f"{small}/pages.parquet")
    folder = shared_folder(spark)
    first = warc.write(pages, folder, shard_bytes=40_000).collect()
    root = folder.removeprefix("file://")
    with open(f"{root}/.part-000000-00000.warc.gz.9-9-9-9", "wb") as f:
        f.write(b"left by a dead attempt")
    # the second job again: all names are given already
    attempts = spark.read.parquet(f"{folder}/_attempts")
    assert sorted(map(str, attempts.mapInArrow(warc._publish(folder), warc.MANIFEST).collect())) == sorted(map(str, first))
    # both jobs again, onto the files that stand there
    assert sorted(map(str, warc.write(pages, folder, shard_bytes=40_000).collect())) == sorted(map(str, first))
    assert not [x for x in os.listdir(root) if x.startswith(".part")]
    assert warc.read(spark, folder).count() == pages.count()
    shards = {}
    for f in first:
        shards[f.shard] = shards.get(f.shard, 0) + f.bytes
    assert len(shards) > 3 and max(shards.values()) < 2.5 * sum(shards.values()) / len(shards)


def test_one_id_and_long_payloads(spark):
    rows = [(7, f"http://u/{i}", ("z" * 3_000_000 if i == 5 else f"text {i} ") + "é" * 60) for i in range(40)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as kind", "2 as first_id", "3 as n_bytes")
    folder = shared_folder(spark)
    warc.write(df, folder, shard_bytes=1000)
    assert got(warc.read(spark, folder)) == expected(rows)
