"""Bucketed table versions and numbering by one shuffle."""

from pyspark.sql import functions as F

from strandline.operators import variants
from strandline.operators._util import global_row_number
from strandline.session import scratch_dir
from strandline.sources.versions import BucketedTable


def _rows(spark, keys, tag):
    return spark.createDataFrame([(k, i, tag) for k in keys for i in range(5)], "analysis_id string, n int, tag string")


def _files(df):
    return {f for f in df.inputFiles()}


def test_one_new_analysis_leaves_the_other_buckets_alone(spark):
    path, keys = scratch_dir(spark, "load"), [f"A{i}" for i in range(200)]
    first = variants.incremental_load(spark, path, _rows(spark, keys, "v1"), "initial", buckets=32)
    before = _files(first)
    again = variants.incremental_load(spark, path, _rows(spark, ["A7"], "v2"), "default", buckets=32)
    after = _files(again)
    assert len(after) == len(before) and len(after - before) == 1  # one bucket's file is new
    got = {(r.analysis_id, r.tag): r.n for r in again.groupBy("analysis_id", "tag").agg(F.count("*").alias("n")).collect()}
    assert got == {(k, "v2" if k == "A7" else "v1"): 5 for k in keys}
    table = BucketedTable(spark, path, "analysis_id", 32)
    assert table.versions() == [1, 2] and table.read(1).where("tag = 'v2'").count() == 0


def test_versions_of_odd_keys(spark):
    path = scratch_dir(spark, "load-odd")
    variants.incremental_load(spark, path, _rows(spark, [None, "a"], "v1"), "default", buckets=4)
    variants.incremental_load(spark, path, _rows(spark, [None, "b"], "v2"), "default", buckets=4)
    variants.incremental_load(spark, path, _rows(spark, [], "v3"), "default", buckets=4)
    table = BucketedTable(spark, path, "analysis_id", 4)
    tags = {(r.analysis_id, r.tag) for r in table.read().select("analysis_id", "tag").distinct().collect()}
    assert tags == {(None, "v2"), ("a", "v1"), ("b", "v2")}
    # a version whose listing was not finished does not count
    table._fs.delete(table._path(f"{path}/_versions/3/_SUCCESS"), False)
    assert table.version() == 2
    table.vacuum(keep=1)
    assert table.versions() == [2] and table.read().count() == 15
    empty = scratch_dir(spark, "load-empty")
    assert variants.incremental_load(spark, empty, _rows(spark, [], "v1"), "initial").count() == 0


def test_numbering_has_one_exchange(spark, monkeypatch):
    from strandline.operators import _util
    plans = []
    cut = _util.cut_lineage
    monkeypatch.setattr(_util, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("_v"))
    out = global_row_number(df, ["k"], partitions=7)
    assert sorted((r.k, r.rn) for r in out.collect()) == [(i, i + 1) for i in range(1000)]
    assert plans[0].count("Exchange rangepartitioning") == plans[0].count("Exchange") == 1
    assert "Exchange hash" not in out._jdf.queryExecution().executedPlan().toString().split("HashAggregate")[0]
    assert global_row_number(df.limit(0), ["k"]).count() == 0
