"""Event frames and listing pages of hosts as Python data sources."""

import json

import pytest

from tests.test_engine import cbor
from tidemark.operators import reconcile
from tidemark.sources import hosts

PDS = "id int, cursor long, disabled boolean"


def framed(seq):
    return bytearray(cbor({"op": 1, "t": "#commit"}) + cbor({"seq": seq}))


def run(spark, tmp_path, pds, limit=None):
    stream = hosts.frame_stream(spark, f"file://{tmp_path}/in", spark.createDataFrame(pds, PDS), f"file://{tmp_path}/at/positions.json", limit)
    q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).start(str(tmp_path / "out"))
    try:
        q.processAllAvailable()
        batches = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    finally:
        q.stop()
    return sorted((r.pds, r.cursor) for r in spark.read.parquet(str(tmp_path / "out")).collect()), batches


def test_frames_by_host_from_stored_offsets(spark, tmp_path):
    def put(host, seqs):
        rows = [(host, s, framed(s)) for s in seqs]
        return hosts.write_frames(spark.createDataFrame(rows, "pds int, seq long, bytes binary"), f"file://{tmp_path}/in", per_file=7)

    assert put(1, range(1, 31)) == 5 and put(2, range(100, 110)) == 2 and put(3, range(5)) == 1
    pds = [(1, 10, False), (2, None, None), (3, 0, True)]
    got, batches = run(spark, tmp_path, pds, limit=8)
    want = [(1, s) for s in range(11, 31)] + [(2, s) for s in range(100, 110)]
    assert got == want and len(batches) > 2 and max(batches) <= 16
    put(1, range(31, 34))
    put(2, range(110, 120))
    got, _ = run(spark, tmp_path, [(1, 0, False), (2, 0, True), (4, 0, False)])  # offsets of the checkpoint count; the second host drops out
    assert got == sorted(want + [(1, 31), (1, 32), (1, 33)])
    got, _ = run(spark, tmp_path, [(1, 0, False), (2, 0, False)])  # and comes back where it was
    assert got == sorted(want + [(1, 31), (1, 32), (1, 33)] + [(2, s) for s in range(110, 120)])


def test_frames_that_can_not_be_read_keep_their_place(spark, tmp_path):
    rows = [(1, 1, framed(1)), (1, 2, bytearray(b"\xff")), (1, 3, framed(3)), (1, 4, bytearray(b""))]
    hosts.write_frames(spark.createDataFrame(rows, "pds int, seq long, bytes binary"), f"file://{tmp_path}/in")
    assert run(spark, tmp_path, [(1, 0, False)])[0] == [(1, 1), (1, 1), (1, 3), (1, 3)]


def test_pages_follow_their_cursors(spark, tmp_path):
    rows = [(1, f"did:{i:04d}" if i % 50 else None, "3k") for i in range(450)] + [(2, "did:x", None)]
    assert hosts.write_pages(spark.createDataFrame(rows, "pds int, did string, rev string"), f"file://{tmp_path}") == 4
    pages = hosts.listing_pages(spark, f"file://{tmp_path}").cache()
    assert pages.rdd.getNumPartitions() == 2
    assert sorted((r.pds, r.did, r.rev) for r in reconcile.listing(pages).collect()) == sorted((p, d, r) for p, d, r in rows if d)
    assert pages.agg({"skipped": "sum"}).first()[0] == 9 and {r.page for r in pages.filter("pds = 1").collect()} == {1, 2, 3}


def test_broken_pages_give_an_error_row(spark, tmp_path):
    page = lambda cursor=None: json.dumps({"repos": [{"did": "did:a", "rev": "1"}, None]} | ({"cursor": cursor} if cursor else {}))
    for host, files in {"1": {"first": page("b"), "b": "{broken"}, "2": {"first": page("gone")}, "3": {"first": page("first")}, "4": {"first": '{"repos": [{"did": 7}]}'}, "5": {"first": page()}, "6": {"first": "[]"}}.items():
        (tmp_path / host).mkdir()
        for name, text in files.items():
            (tmp_path / host / f"{name}.json").write_text(text)
    found = hosts.listing_pages(spark, f"file://{tmp_path}").collect()
    assert {r.pds: r.page for r in found if r.error} == {1: 2, 2: 2, 3: 2, 4: 1, 6: 1}
    assert sorted(r.pds for r in found if r.did) == [1, 2, 3, 5] and {r.skipped for r in found if r.skipped} == {1}


def test_unknown_schemes_fail_before_a_job(spark):
    with pytest.raises(ValueError, match="can't read"):
        hosts.listing_pages(spark, "dbfs:/listing")
    with pytest.raises(ValueError, match="can't read"):
        hosts.write_pages(spark.createDataFrame([], "pds int, did string, rev string"), "dbfs:/listing")


def test_longer_runs_of_hosts_take_no_more_batches():
    from tidemark.plans import registry

    batches = lambda last: -(-last // registry.host_limit(last))
    assert [registry.host_limit(n) for n in (0, 5_000, 48_000)] == [4000] * 3
    assert all(batches(last) <= 13 for last in (50_000, 3_000_000, 18_000_000))
