"""Tables behind manifests: deltas and compaction, snapshots, and writers that meet or fail."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from tests.test_engine import SF
from tidemark.operators import store
from tidemark.plans.fixtures import view
from tidemark.sources import files, manifest, snapshots
from tidemark.sources.merge_table import MergeTable

OPS = "repo long, collection string, rkey string, action string, rev string, seq long, content string"


@pytest.fixture(scope="module")
def commits(spark):
    return view(spark, SF, "commits").filter("type = '#commit'").cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(spark, n, key="k", action="create"):
    return store.current_parts(spark.createDataFrame([(1, "c", key, action, f"3{n}", n, str(n))], OPS))


def test_compaction_rewrites_only_touched_buckets(spark, tmp_path, commits):
    table = MergeTable(spark, str(tmp_path), buckets=16)
    table.append(store.current_parts(commits))
    assert table.compact() == list(range(16)) and table.compact() == []
    before = manifest.current(spark, table.path)
    assert before["deltas"] == {} and len(set(before["base"].values())) == 1
    table.append(one(spark, 7, "new"))
    touched = table.compact()
    after = manifest.current(spark, table.path)
    assert len(touched) == 1 and {b for b in after["base"] if after["base"][b] != before["base"][b]} == {str(touched[0])}
    assert rows(table.rows()) == rows(store.fold_current(store.current_parts(commits).unionByName(one(spark, 7, "new"))))
    plan = table.rows()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # without deltas rows are read as they are


def test_repeated_and_shuffled_batches_change_nothing(spark, tmp_path, commits):
    table = MergeTable(spark, str(tmp_path), buckets=4, spread=2)
    parts = [store.current_parts(commits.filter(F.col("seq") % 3 == n)) for n in (2, 0, 1)]
    for n, part in enumerate([*parts, parts[0]]):
        table.append(part)
        if n == 1:
            table.compact()
    want = rows(store.fold_current(store.current_parts(commits)))
    assert rows(table.rows()) == want
    table.compact()
    assert rows(table.rows()) == want
    table.vacuum()
    assert rows(table.rows()) == want and len([d for d in os.listdir(tmp_path) if d.startswith("delta-")]) == 0


def test_empty_tables_and_batches(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path), buckets=4)
    assert table.compact() == [] and table.rows().count() == 0
    table.append(one(spark, 1).filter("false"))
    assert table.compact() == [] and table.rows().count() == 0
    table.append(one(spark, 2, action="delete"))
    assert table.rows().count() == 0  # nothing was there to delete
    table.append(one(spark, 1))
    assert [r.deleted for r in table.rows().collect()] == [True]


def test_a_delta_that_comes_while_compacting_stays(spark, tmp_path, monkeypatch):
    table = MergeTable(spark, str(tmp_path), buckets=2)
    table.append(one(spark, 1))
    write = MergeTable._write

    def slow(self, parts, buckets, kind):
        out = write(self, parts, buckets, kind)
        if kind == "base":
            monkeypatch.setattr(MergeTable, "_write", write)
            MergeTable(spark, table.path).append(one(spark, 5))
        return out

    monkeypatch.setattr(MergeTable, "_write", slow)
    table.compact()
    assert len(manifest.current(spark, table.path)["deltas"]) == 1
    assert [(r.at_rev, r.content) for r in table.rows().collect()] == [("35", "5")]


def test_two_compactions_of_a_bucket_do_not_both_count(spark, tmp_path, monkeypatch):
    table = MergeTable(spark, str(tmp_path), buckets=1)
    table.append(one(spark, 1))
    write = MergeTable._write

    def slow(self, parts, buckets, kind):
        out = write(self, parts, buckets, kind)
        monkeypatch.setattr(MergeTable, "_write", write)
        MergeTable(spark, table.path).compact()
        return out

    monkeypatch.setattr(MergeTable, "_write", slow)
    with pytest.raises(RuntimeError, match="another compaction"):
        table.compact()
    assert table.rows().count() == 1


def test_writers_that_meet_lose_no_change(spark, tmp_path):
    def add(n):
        for k in range(5):
            manifest.change(spark, str(tmp_path), lambda s: {"all": [*(s or {"all": []})["all"], (n, k)]})

    threads = [threading.Thread(target=add, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(map(tuple, manifest.current(spark, str(tmp_path))["all"])) == [(n, k) for n in range(4) for k in range(5)]
    assert files.create_text(spark, f"{tmp_path}/x", "1") and not files.create_text(spark, f"{tmp_path}/x", "2")
    assert files.read_text(spark, f"{tmp_path}/x") == "1" and files.names(spark, f"{tmp_path}/none") == []


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "view")
    with pytest.raises(FileNotFoundError):
        snapshots.snapshot(spark, path)
    snapshots.refresh(spark.range(3), path)
    reader = snapshots.snapshot(spark, path)
    broken = spark.range(4).select(F.when(F.col("id") > 2, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        snapshots.refresh(broken, path)
    assert snapshots.snapshot(spark, path).count() == 3
    snapshots.refresh(spark.range(5), path)
    assert reader.count() == 3 and snapshots.snapshot(spark, path).count() == 5
    snapshots.release_old(spark, path)
    assert snapshots.snapshot(spark, path).count() == 5
    assert len([d for d in os.listdir(path) if d.startswith("snapshot-")]) == 1
    snapshots.release(spark, path)
    assert not os.path.exists(path)


def exchanged_scans(df):
    """Scans of buckets that lie below an exchange in the plan, and how many there are."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    below = [a for n, a in enumerate(lines) if "Bucketed: true" in a for up in lines[:n] if "Exchange" in up and depth(up) < depth(a) and all(depth(x) > depth(up) for x in lines[lines.index(up) + 1 : n + 1])]
    return below, sum("Bucketed: true" in x for x in lines)


def test_buckets_are_joined_in_place(spark, tmp_path):
    from tidemark.sources import bucketed

    versions = view(spark, SF, "versions").select("repo", "collection", "rkey", "at_rev", "deleted", "content")
    bucketed.write(versions, str(tmp_path), 8)
    table = bucketed.open_table(spark, str(tmp_path))
    one_repo = versions.first().repo
    fetched = store.latest_version(versions).filter(F.col("repo") <= one_repo).withColumn("at_rev", F.concat("at_rev", F.lit("z")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        diff = store.snapshot_diff(fetched, bucketed.of_repos(table, fetched, named=0))
        assert exchanged_scans(diff) == ([], 1)
        assert rows(diff) == rows(store.snapshot_diff(fetched, versions))
        since = versions.groupBy("repo").agg(F.min("at_rev").alias("since_rev"))
        assert exchanged_scans(store.changes_since(table, since)) == ([], 1)
        assert rows(store.changes_since(table, since)) == rows(store.changes_since(versions, since))
        assert exchanged_scans(store.latest_version(table)) == ([], 1)
        few = bucketed.of_repos(table, fetched.filter(F.col("repo") == one_repo))
        assert "SelectedBucketsCount: 1 out of 8" in store.latest_version(few)._jdf.queryExecution().executedPlan().toString()
        assert rows(few) == rows(versions.filter(F.col("repo") == one_repo))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert bucketed.of_repos(table, fetched.limit(0)).count() == 0
