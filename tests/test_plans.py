"""Physical plans: no Python workers, no nested loops, pruned scans, and hot keys that are split."""

import io
import re
from contextlib import contextmanager, redirect_stdout

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from loamwork.operators import joins, sorting, splits

FOLDER = "/root/testdata/sf0.001"
RELATIONAL = sorted(
    name for name in contract.oracle_sql()
    if name[0] in "pfjaouxwr" and not re.match(r"op\d", name) or name in ("e01_hard_label_auc", "e03_accuracy", "e04_rmse", "e05_coverage_rmse")
)
ALL_PAIRS = {"j05_all_pairs"}


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", RELATIONAL)
def test_relational_plans_stay_in_the_engine(spark, name):
    plan = plan_of(contract.queries()[name](spark, FOLDER))
    for word in ("EvalPython", "MapInPandas", "InPandas", "CartesianProduct"):
        assert word not in plan
    if name not in ALL_PAIRS:
        assert "NestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(contract.queries()["f02_open_interval"](spark, FOLDER))
    assert "GreaterThan(l_quantity,1.0)" in plan and "LessThan(l_quantity,5.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan


def test_chained_filters_are_one_filter(spark):
    chained = plan_of(contract.queries()["f06_chained_strings"](spark, FOLDER))
    assert chained.count("Filter (") == 1


def test_outer_join_becomes_inner_below_a_null_rejecting_filter(spark):
    plan = plan_of(contract.queries()["f11_null_rejecting"](spark, FOLDER))
    assert "LeftOuter" not in plan


def test_top_k_keeps_k_rows_per_partition(spark):
    assert "TakeOrderedAndProject" in plan_of(contract.queries()["o02_largest"](spark, FOLDER))


def test_numbering_within_a_key_is_trimmed_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("u"), F.col("id").alias("seq"))
    for frame in (splits.leave_range_out(df, "u", ["seq"], 2, 5), sorting.top_per_key(df, ["u"], 3, F.asc("seq"))):
        assert plan_of(frame).count("WindowGroupLimit") == 2


def test_fold_numbers_need_no_shuffle_of_rows(spark):
    df = spark.range(1000).withColumn("payload", F.lit("x"))
    assert "Exchange" not in plan_of(splits.contiguous_folds(df, ["id"], 5))


def test_large_dimensions_are_not_broadcast(spark):
    facts, names = spark.range(1000), spark.range(1000).withColumn("name", F.lit("n"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert "BroadcastHashJoin" in plan_of(joins.lookup_join(facts, names, ["id"]))
        assert "BroadcastHashJoin" not in plan_of(joins.lookup_join(facts, names, ["id"], limit=100))


def _with_hot_key(spark, rows):
    """A third of the rows share key 0."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997)
    return spark.range(0, rows, 1, 16).select(key.alias("k"), F.col("id").alias("v"))


_SPLIT_EARLY = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
}


def test_hot_key_on_either_side_of_an_outer_join_is_split(spark):
    hot = _with_hot_key(spark, 300_000)
    keys = spark.range(0, 997, 1, 4).select(F.col("id").alias("k"), F.lit("name").alias("name"))
    with settings(spark, **_SPLIT_EARLY):
        for joined in (joins.left_outer(hot, keys, ["k"]), joins.left_outer(keys, hot, ["k"]),
                       joins.right_outer(hot, keys, ["k"])):
            assert joined.count() >= 300_000
            kept = joined.select("k", "v", "name")
            kept.collect()
            assert "skew=true" in plan_of(kept)


def test_hot_group_is_counted_from_one_row_per_task(spark):
    hot = _with_hot_key(spark, 30_000)
    names = spark.createDataFrame([(0, "zero"), (1, "one")], "d bigint, name string")
    plan = plan_of(joins.counts_by_attribute(hot, "k", names, "d", "name"))
    assert plan.count("partial_count") == 1 and plan.index("partial_sum") < plan.index("partial_count")


