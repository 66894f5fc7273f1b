import pytest
from pyspark.sql import functions as F
from test_decode_features_checks import chain

from quarrylane.operators import agree, features
from quarrylane.sources import bucketed
from quarrylane.sources.fixtures import Fixtures


@pytest.mark.parametrize("size", [8, 1024])
def test_trees_find_what_a_full_join_finds(spark, size):
    n = F.col("block_number")
    a = chain(spark, 1300)
    b = a.where(~n.isin(12, 700)).withColumn("gas_used", F.when(n.isin(20, 1299), 6).otherwise(F.col("gas_used")).cast("bigint")).withColumn("timestamp", F.when(n != 90, F.col("timestamp")))
    a, b = (x.where(~n.isin(0, 500, 501)) for x in (a, b))
    a = a.unionByName(a.where("block_number = 502"))
    columns = [c for c in a.columns if c != "block_number"]
    want = sorted(map(tuple, agree._differences(a, b, columns, "full_outer").collect())) + [(k, "missing_there") for k in (0, 500, 501)]
    found = sorted(tuple(r) for r in agree.compare_full(a, b, 0, 1299, size).collect() if not r.reason.startswith("verifier_"))
    assert found == sorted(want)


def test_only_differing_leaves_are_exchanged(spark):
    n = F.col("block_number")
    a = chain(spark, 3000)
    b = a.withColumn("tx_count", F.when(n == 1234, 77).otherwise(F.col("tx_count")).cast("bigint"))
    trees = [agree.digest_tree(x.repartition(3), 0, 2999, 10, 4) for x in (a, b)]
    assert [r.node for r in agree.differing_leaves(*trees, 4).collect()] == [123]
    assert agree.differing_leaves(trees[0], trees[0], 4).count() == 0
    root = trees[0].where(F.col("level") == trees[0].agg(F.max("level")).first()[0]).collect()
    assert len(root) == 1 and root[0]["rows"] == 3000 and root[0]["numbers"] == 3000
    assert agree.digest_tree(a.limit(0), 0, 2999).count() == 0
    assert agree.compare_full(a, a, 0, 2999).count() == 0


def test_join_of_buckets_moves_no_row(spark, tmp_path):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    blocks, _, receipts = fx.warehouse()
    tables = [bucketed.save_bucketed(x, f"bucketed_{k}", str(tmp_path / str(k)), 4) for k, x in enumerate((blocks, receipts))]
    low, high = fx.events().agg(F.min("timestamp"), F.max("timestamp")).first()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = features.receipts_of(*(bucketed.scan_days(t, low, high) for t in tables))
        rows = joined.count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for k in (0, 1):
            spark.sql(f"DROP TABLE bucketed_{k}")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "PartitionFilters: [isnotnull(day" in plan
    assert rows == features.receipts_of(blocks, receipts).count()
