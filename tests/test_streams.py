"""State variables of the streams, the throttled cursor, epochs by stretches, keys in linear time."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.test_engine import Link, car, cbor, run_stream
from tidemark.operators import archive, views
from tidemark.streaming import events as stream, stateful

COMMITS = "pds int, repo long, seq long, rev string, type string, too_big boolean"


def test_each_commit_meets_one_epoch_of_ten_thousand(spark):
    r = random.Random(1)
    rows, at, want = [], {}, {}
    for seq in range(1, 60_001):
        host = 1 if seq % 3 else 2
        place = seq * (50 if host == 1 else 900)  # the second host leaves stretches empty
        kind = "#info" if host == 1 and seq % 4 == 1 or r.random() < 0.001 else "#commit" if r.random() < 0.7 else "#account"
        rows.append((host, seq, place, str(seq), kind, False))
        if kind == "#info":
            at[host] = None
        elif kind == "#commit":
            if at.get(host) is None:
                at[host] = place
            want[host, place] = at[host]
    df = spark.createDataFrame(rows, COMMITS)
    assert sum(k == "#info" for *_, k, _ in rows) > 9_000
    pds = spark.createDataFrame([], "id int, first_cursor_since_reset long")
    epochs = stream.cursor_epochs(df, pds)
    placed = stream.with_epoch(df.filter("type = '#commit'"), epochs)
    assert {(x.pds, x.seq): x.first_cursor_since_reset for x in placed.collect()} == want
    assert placed.count() == len(want)


def test_no_join_of_commits_on_the_host_alone(spark):
    commits = spark.createDataFrame([(1, 1, 5, "a", "#commit", False)], COMMITS).union(spark.createDataFrame([], COMMITS))
    epochs = spark.createDataFrame([(1, 0, -1, 99, 5)], "pds int, epoch int, low long, high long, first_cursor_since_reset long")
    plan = stream.with_epoch(commits, epochs)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("_b#" in line and "pds#" in line for line in joins)


def replayed(spark, tmp_path, name, batches, schema, build):
    """Runs a stream over one file after the other, a new run for each, with one checkpoint."""
    path, out = str(tmp_path / name), str(tmp_path / f"{name}-out")
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        q = build(spark.readStream.schema(schema).parquet(path)).writeStream.format("parquet").option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start(out)
        q.awaitTermination(120)
        assert q.exception() is None
        yield n, [tuple(r) for r in spark.read.parquet(out).orderBy(*spark.read.parquet(out).columns).collect()]


def test_state_is_kept_over_runs_and_initial_state_is_read_once(spark, tmp_path):
    pds = spark.createDataFrame([(1, 40), (2, 0)], "id int, first_cursor_since_reset long")
    schema = "pds int, seq long, type string"
    batches = [[(1, 50, "#commit"), (2, 7, "#commit")], [(1, 51, "#commit"), (1, 50, "#commit"), (1, 60, "#info")], [(1, 61, "#account"), (1, 62, "#handle"), (3, 1, "#commit")]]
    seen = [rows for _, rows in replayed(spark, tmp_path, "hosts", batches, schema, lambda s: stateful.cursor_reset_stream(s, pds))]
    assert seen[0] == [(1, 0, 40), (2, 0, 7)] and seen[1] == seen[0]
    assert seen[2] == [(1, 0, 40), (1, 1, 62), (2, 0, 7), (3, 0, 1)]


@pytest.mark.parametrize("expire,anchors", [(None, ["a"]), ("1 millisecond", ["a", "b"])])
def test_idle_repos_expire_and_anchor_anew(spark, tmp_path, expire, anchors):
    schema = "repo long, seq long, rev string, too_big boolean, first_cursor_since_reset long"
    batches = [[(1, 1, "a", False, 9)], [(1, 2, "b", False, 9)]]
    seen = [rows for _, rows in replayed(spark, tmp_path, f"repos{bool(expire)}", batches, schema, lambda s: stateful.repo_state_stream(s, expire=expire))]
    assert [r[1] for r in seen[-1]] == anchors


def naive_cursors(rows, width, jump):
    """The rule with a clock that ticks each second."""
    out, last, saved, waits = [], None, None, False
    events = {t: s for s, t in rows}
    for now in range(max(events) + 1):
        if waits and now >= saved + width:
            out.append(last)
            saved, waits = saved + width, False
        if now in events:
            seq = events[now]
            if saved is None or abs(seq - last) >= jump or now - saved >= width:
                out.append(seq)
                saved, waits = now, False
            else:
                waits = True
            last = seq
    return out, last if waits else None


def test_throttle_equals_a_clock():
    r = random.Random(3)
    for _ in range(200):
        times = sorted(r.sample(range(400), r.randrange(1, 60)))
        seqs = sorted(r.sample(range(1000), len(times)))
        rows = list(zip(seqs, times, strict=True))
        throttle, out = stateful.Throttle(-1, None, False, 15, 100), []
        for seq, t in rows:
            out += throttle.event(seq, t)
        assert (out, throttle.last if throttle.waits else None) == naive_cursors(rows, 15, 100)


def test_host_cursor_stream_with_a_manual_clock(spark, tmp_path):
    at = lambda s: f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}"
    rows = [(1, "#commit", [(10, 0), (11, 5), (12, 14), (13, 16), (200_000, 17), (200_001, 18)]), (2, "#commit", [(5, 3), (6, 4)]), (2, "#account", [(99, 6)])]
    first = [(p, s, k, at(t)) for p, k, x in rows for s, t in x]
    later = [(1, 200_002, "#commit", at(100)), (3, 1, "#commit", at(300)), (3, 2, "#commit", at(301))]
    schema = "pds int, seq long, type string, time string"
    build = lambda s: stateful.host_cursor_stream(s.withColumn("time", F.col("time").cast("timestamp_ntz")))
    for n, seen in replayed(spark, tmp_path, "cursors", [first, later], schema, build):
        held = {tuple(r) for r in stateful.waiting_cursors(spark, f"{tmp_path}/cursors-state").collect()}
        if n == 0:  # a silent host: what waits is in the state, no cursor is lost
            assert {s for p, s in seen if p == 1} >= {10, 12, 200_000} and {max(s for p, s in [*seen, *held] if p == h) for h in (1, 2)} == {200_001, 6}
    assert [s for p, s in seen if p == 1] == [10, 12, 200_000, 200_001, 200_002] and [s for p, s in seen if p == 2] == [5, 6]
    assert {(3, 2)} <= held | set(seen)


def test_keys_of_a_large_node_take_linear_time(spark):
    def timed(n):
        tree = spark.range(1).select("id", F.expr(f"transform(sequence(0, {n - 1}), i -> struct(cast(if(i = 0, 0, 10) as int) as p, cast(if(i = 0, concat('collection/', lpad(i, 8, '0')), concat('/', lpad(i, 8, '0'))) as binary) as k, cast(i as string) as v, cast(null as string) as t))").alias("e")).checkpoint()
        began = time.time()
        keys = archive.tree_keys(tree).agg(F.countDistinct("key"), F.min("key"), F.max("key")).first()
        return time.time() - began, tuple(keys)

    timed(1000)
    assert timed(100_000)[1] == (100_000, "collection/00000000", "collection/00099999")
    assert timed(100_000)[0] < 30
    bad = spark.createDataFrame([(1, [(0, b"ab", "v", None), (3, b"c", "v", None)]), (2, []), (3, None)], "id int, e array<struct<p:int,k:binary,v:string,t:string>>")
    assert {r.id: r["keys"] for r in archive.with_keys(bad).collect()} == {1: None, 2: [], 3: None}


def test_archives_are_read_once(spark):
    count = spark.sparkContext.accumulator(0)
    one = cbor({"$type": "c.post", "text": "a"})
    tree = cbor({"l": None, "e": [{"p": 0, "k": b"c/a", "v": Link(one), "t": None}]})
    commit = cbor({"did": "did:x", "version": 3, "data": Link(tree), "rev": "3k1", "prev": None, "sig": b"s"})
    whole = bytearray(car(Link(commit), [commit, tree, one]))

    def probe(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    archives = spark.createDataFrame([(str(i), whole if i % 5 else whole[:-3]) for i in range(40)], "archive string, bytes binary").mapInArrow(probe, "archive string, bytes binary")
    records, errors = archive.archive_records(archives)
    assert (records.count(), errors.count()) == (32, 8) and count.value == 40


def test_languages_by_postgres_containment(spark):
    given = {'["uk","en"]': True, '"uk"': True, "uk": True, '{"uk":1}': True, '{"en":{"uk":1}}': False, '["en"]': False, '[["uk"]]': False, '[1,null,{"uk":2},"uk"]': True, "[]": False, "{}": False, "7": False, "": False, "[broken": False, None: False}
    df = spark.createDataFrame([(k,) for k in given], "langs string")
    assert {r.langs: r.found for r in df.select("langs", views.has_lang("uk").alias("found")).collect()} == given


def test_first_seen_keeps_a_fixed_state(spark, tmp_path):
    batches = [[(f"did:{i}",) for i in range(a, b)] for a, b in ((0, 50), (0, 50), (0, 4000), (0, 50))]
    sizes, seen = [], []
    for _, rows in replayed(spark, tmp_path, "seen", batches, "did string", lambda s: stateful.first_seen_cached(s, shards=2, places=100)):
        held = spark.read.format("statestore").option("path", f"{tmp_path}/seen-state").option("stateVarName", "seen").load()
        sizes.append(held.agg(F.sum(F.length("value.table"))).first()[0])
        seen.append([r[0] for r in rows])
    assert set(sizes) == {2 * 100 * 16}
    assert set(seen[-1]) == {f"did:{i}" for i in range(4000)}  # each at least once
    assert len(seen[1]) - len(seen[0]) < 40 and len(seen[3]) > len(seen[2])  # again only after another took the place


def test_sketches_are_within_two_percent(spark):
    from tidemark.operators import sketches, views as v

    rows = spark.range(200_000).selectExpr("id % 60000 as repo", f"'{v.LISTBLOCK}' as collection", "concat('{\"subject\":\"at://did:', id % 3, '/c/r\"}') as content", "cast(null as boolean) as deleted", "timestamp_ntz'2024-01-01 05:00:00' + make_dt_interval(cast(id % 30 as int)) as created_at")
    stored = sketches.listblock_sketches(rows)
    for since, until in ((None, None), ("2024-01-05", "2024-01-11")):
        near = rows.filter(f"created_at >= '{since or '2000-01-01'}' and created_at < '{until or '2030-01-01'}'")
        exact = {r[0]: r[1] for r in near.groupBy(F.expr("concat('did:', regexp_extract(content, 'did:([0-9])', 1))")).agg(F.countDistinct("repo")).collect()}
        got = {r.owner: r.n for r in sketches.merged_counts(stored, since, until).collect()}
        assert got.keys() == exact.keys() and all(abs(got[k] / exact[k] - 1) < 0.02 for k in exact)
    assert sketches.merged_counts(stored, owner="did:1").count() == 1


def test_streams_take_the_event_of_number_0(spark):
    from tidemark.plans import registry

    rows = [(1, 7, n, f"3k{n}", "#commit", "create", "c", f"r{n}", "{}", None) for n in range(4)]
    commits = spark.createDataFrame(rows, "pds int, repo long, seq long, rev string, type string, action string, collection string, rkey string, content string, time timestamp_ntz").withColumn("time", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, seq)"))
    assert registry.queries().keys() >= {"sink_append", "cursor_reset_stream", "host_cursor_stream"}
    assert sorted(r.rkey for r in registry.appended(commits).collect()) == ["r0", "r1", "r2", "r3"]
    none = spark.createDataFrame([], "id int, first_cursor_since_reset long")
    assert [tuple(r) for r in registry.streamed(commits.select("pds", "seq", "type"), lambda s: stateful.cursor_reset_stream(s, none)).collect()] == [(1, 0, 0)]
    stored = registry.streamed(commits.select("pds", "seq", "type", "time"), stateful.host_cursor_stream, stateful.waiting_cursors)
    assert sorted(r.cursor for r in stored.collect()) == [0, 3]


def test_events_older_than_the_watermark_count(spark, tmp_path):
    at = lambda s: f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}"
    batches = [[(1, 10, "#commit", at(600)), (1, 11, "#commit", at(601)), (2, 1, "#commit", at(900))], [(1, 12, "#commit", at(0)), (2, 2, "#commit", at(901))], [(1, 13, "#commit", at(5)), (1, 14, "#commit", at(620))]]
    path = str(tmp_path / "in")
    schema = "pds int, seq long, type string, time string"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path).withColumn("time", F.col("time").cast("timestamp_ntz"))
    q = stateful.host_cursor_stream(source).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination(120)
    seen = spark.read.parquet(str(tmp_path / "out")).unionByName(stateful.waiting_cursors(spark, str(tmp_path / "state"))).collect()
    assert sorted((r.pds, r.cursor) for r in seen) == [(1, 10), (1, 13), (1, 14), (2, 1), (2, 2)]


def test_tree_and_record_runs_decode_archives_once_in_small_pieces(spark, tmp_path):
    import pyarrow as pa

    from tidemark import archive_format as fmt
    from tidemark.plans import registry

    parts = list(fmt.slices([pa.RecordBatch.from_pydict({"a": list(range(2500))})], 1024))
    assert [p.num_rows for p in parts] == [1024, 1024, 452]
    records = spark.createDataFrame([(r, "c", f"k{i:02d}", f"3k{i}", '{"$type":"c"}') for r in (1, 2) for i in range(9)], "repo long, collection string, rkey string, at_rev string, content string")
    count = spark.sparkContext.accumulator(0)

    def probe(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    made = registry.archives
    try:
        registry.archives = lambda r: made(r).mapInArrow(probe, "archive string, bytes binary")
        assert sorted(r.key for r in registry.reached(records).collect()) == sorted(f"c/k{i:02d}" for _ in (1, 2) for i in range(9))
    finally:
        registry.archives = made
    assert count.value == 2


def test_steps_work_their_rows_out_once(spark, tmp_path):
    from tidemark.plans.registry import in_order

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    df = spark.range(5, 1005, numPartitions=4).withColumnRenamed("id", "seq").mapInArrow(count, "seq long")
    in_order(df, "seq", str(tmp_path / "in"), rows=250)
    assert made.value == 1000
    files = sorted((tmp_path / "in").glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    seqs = [[r.seq for r in spark.read.parquet(str(f)).collect()] for f in files]
    assert len(files) == 4 and [sorted(s) for s in seqs] == [list(range(5 + 250 * k, 255 + 250 * k)) for k in range(4)]
