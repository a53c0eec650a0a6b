"""What has changed: frames by ranges, datasets by fingerprints, tables by compaction (nothing has)."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import quality as Q
from sluice.sinks.files import write_parquet
from sluice.sinks.snapshots import SnapshotTable, compact, file_sizes
from sluice.sources import changes as G
from tests.test_snapshots import rows


def some(spark, n=2000, seed=1):
    r = random.Random(seed)
    data = [(i if i % 50 else None, r.choice([0.0, -0.0, float("nan"), 1.5, None]), f"t{i % 7}") for i in range(n)]
    return spark.createDataFrame(data, "id long, v double, s string")


@pytest.mark.parametrize("fanout, levels", [(256, 2), (4, 3), (2, 1), (1, 1)])
def test_ranges_give_the_same_difference(spark, fanout, levels):
    left = some(spark)
    right = left.repartition(5).where("id is null or id % 400 <> 3").unionByName(left.where("id = 17 or id is null")).withColumn(
        "s", F.when(F.col("id") == 900, "edited").otherwise(F.col("s")))
    got = Q.frames_diff_by_ranges(left, right.select("s", "id", "v"), fanout, levels)
    want = Q.frames_diff(left, right)
    assert list(map(repr, rows(got))) == list(map(repr, rows(want))) and got.dtypes == want.dtypes and got.count() > 20
    place, unequal = Q.changed_ranges(left, right, fanout, levels)
    assert 0 < len(unequal) <= fanout ** levels
    inside = {r[0] for r in left.select(place).distinct().collect()}
    assert len(inside) > len(unequal) or fanout < 4


def test_equal_frames_exchange_no_rows(spark):
    left = some(spark)
    right = left.repartition(7, "s").withColumn("v", F.when(F.col("v") == 0, F.lit(0.0)).otherwise(F.col("v")))
    assert Q.changed_ranges(left, right)[1] == []
    out = Q.frames_diff_by_ranges(left, right)
    assert rows(out) == [] and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert rows(Q.frames_diff_by_ranges(left.limit(0), right.limit(0))) == []
    # the same rows in a narrower type are the same rows
    small = spark.range(50).select(F.col("id").cast("int").alias("id"))
    assert rows(Q.frames_diff_by_ranges(small, spark.range(50))) == []
    with pytest.raises(ValueError, match="column sets differ"):
        Q.changed_ranges(left, small)


def test_looks_classify_datasets_and_files(spark, tmp_dir):
    base, index = f"{tmp_dir}/raw", f"{tmp_dir}/index"
    assert G.look(spark, base, index) == 1 and rows(G.changes(spark, index)) == []
    data = some(spark, 300)
    for n in ("same", "cut", "edited", "gro wn+1"):
        write_parquet(data.repartition(3), f"{base}/{n}")
    G.look(spark, base, index)
    assert {r[:2] for r in rows(G.changes(spark, index))} == {(n, "new") for n in ("same", "cut", "edited", "gro wn+1")}
    write_parquet(data.repartition(5), f"{base}/cut")
    write_parquet(data.withColumn("s", F.when(F.col("id") == 7, "x").otherwise(F.col("s"))), f"{base}/edited")
    write_parquet(data.limit(10).coalesce(1), f"{base}/gro wn+1", mode="append")
    write_parquet(data.limit(1), f"{base}/more")
    G.look(spark, base, index)
    want = [("cut", "unchanged", 300, 300), ("edited", "changed", 300, 300), ("gro wn+1", "changed", 310, 300), ("more", "new", 1, None), ("same", "unchanged", 300, 300)]
    assert rows(G.changes(spark, index)) == want
    files = G.changes(spark, index, by=("dataset", "file"))
    assert {(r["dataset"], r["change"]): r["count"] for r in files.groupBy("dataset", "change").count().collect()}[("gro wn+1", "new")] == 1
    assert files.where("dataset = 'same' and change <> 'unchanged'").count() == 0
    # another folder under the same index: what isn't there is removed; the look before the last stays readable
    write_parquet(data.repartition(2), f"{tmp_dir}/other/same")
    G.look(spark, f"{tmp_dir}/other", index)
    assert {r[:2] for r in rows(G.changes(spark, index))} == {(n, "removed") for n in ("cut", "edited", "gro wn+1", "more")} | {("same", "unchanged")}
    assert rows(G.changes(spark, index, version=3, since=2)) == want


def test_only_touched_files_are_read(spark, tmp_dir, monkeypatch):
    base, index, read = f"{tmp_dir}/raw", f"{tmp_dir}/index", []
    write_parquet(some(spark, 90).repartition(3), f"{base}/a")
    real = G.file_fingerprints
    monkeypatch.setattr(G, "file_fingerprints", lambda spark, paths: read.append(len(paths)) or real(spark, paths))
    G.look(spark, base, index)
    G.look(spark, base, index)
    write_parquet(some(spark, 9).coalesce(1), f"{base}/a", mode="append")
    G.look(spark, base, index)
    assert read == [3, 1]
    assert rows(G.changes(spark, index)) == [("a", "changed", 99, 90)]


def crowded(spark, path, slots=("a", "b/ c+%", None)):
    t = SnapshotTable(spark, path, ("slot",))
    data = spark.range(6000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), (F.col("id") / 7 % 3).cast("int").alias("part"))
    for i, slot in enumerate(slots):
        part = data.where(F.col("id") % len(slots) == i).withColumn("slot", F.lit(slot).cast("string"))
        t.commit(t.stage(part.repartition(8), ("part",), rebalance=False))
    return t


def test_compaction_keeps_rows_and_bounds_files(spark, tmp_dir):
    t = crowded(spark, f"{tmp_dir}/t")
    before, sizes, target = rows(t.read()), {r["folder"].split("/attempt=")[1].split("/", 1)[1]: r for r in file_sizes(t).collect()}, 30_000
    assert len(sizes) == 9 and all(r["files"] == 8 for r in sizes.values())
    version = t.versions()[-1]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # small bins would share a task, and a file
    try:
        assert len(compact(t, target, ("part",))) == 3
    finally:
        spark.conf.set(key, "true")
    after = {r["folder"].split("/attempt=")[1].split("/", 1)[1]: r["files"] for r in file_sizes(t).collect()}
    assert after.keys() == sizes.keys() and all(n <= -(-sizes[k]["bytes"] // target) for k, n in after.items())
    assert sum(after.values()) > len(after)
    assert rows(t.read()) == before == rows(t.read(version))
    assert compact(t, 1 << 30, ("part",)) != [] and compact(t, 1 << 30, ("part",)) == []
    assert rows(t.read()) == before and set(r["files"] for r in file_sizes(t).collect()) == {1}


def test_a_load_meanwhile_wins(spark, tmp_dir, monkeypatch):
    t = crowded(spark, f"{tmp_dir}/t", ("a", "b"))
    other = SnapshotTable(spark, t.path, t.keys)
    newer = other.stage(other.read().where("slot = 'a' and id < 10"), ("part",))
    real = SnapshotTable.stage

    def overtaken(self, *args, **more):
        monkeypatch.undo()
        staged = real(self, *args, **more)
        other.commit(newer)
        return staged

    monkeypatch.setattr(SnapshotTable, "stage", overtaken)
    compact(t, 1 << 30, ("part",))
    assert t.read().where("slot = 'a'").count() == 5 and t.read().where("slot = 'b'").count() == 3000
    assert {r["slot"]: r["files"] for r in file_sizes(t).collect() if r["slot"] == "slot=b"} == {"slot=b": 1}


def test_nothing_to_compact(spark, tmp_dir):
    t = SnapshotTable(spark, f"{tmp_dir}/t", ("slot",))
    assert compact(t) == [] and rows(file_sizes(t)) == []
