from __future__ import annotations

from sluice.llm.common import bounded_sample, held_out, with_rank
from tests.llm.cases import plain


def test_ranks_within_keys_that_reach_over_partitions(spark):
    rows = [(k, i % 7 if i % 5 else None, f"v{i}") for k, n in ((1, 400), (None, 30), (2, 1), (3, 90)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, o long, v string").repartition(9)
    got = plain(with_rank(df, ["k"], ["o", "v"], "r"))
    want, seen = [], {}
    for k, o, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2])):
        seen[k] = seen.get(k, -1) + 1
        want.append((k, o, v, seen[k]))
    assert got == sorted(want, key=repr)
    assert plain(with_rank(df.limit(0), ["k"], ["o", "v"], "r")) == []


def test_held_out_fold_and_sample(spark):
    import zlib

    df = spark.range(0, 3000).withColumnRenamed("id", "doc_id").selectExpr("doc_id", "doc_id % 10 = 0 as rare")
    out = {r["doc_id"] for r in df.where(held_out()).collect()}
    assert out == {i for i in range(3000) if zlib.crc32(str(i).encode()) % 3 == 1}
    sample = bounded_sample(df, "rare", "doc_id", 500).groupBy("rare").count()
    sizes = dict(sample.collect())
    assert sizes[True] == 300 and 400 < sizes[False] < 600
