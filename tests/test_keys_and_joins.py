import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from cargoloom.operators.joins import fan_out_left_join, frequent_keys
from cargoloom.operators.keys import KnownKeys, dense_keys, numbered_copies, stable_keys


def by_window(df, order):
    return df.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias("k"), *df.columns)


def test_dense_keys_equal_row_number(spark, rows):
    rng = random.Random(3)
    # Value 7 holds a third of all rows; the second column tells its rows apart.
    data = [(7 if rng.random() < 0.33 else rng.choice([None, rng.randrange(500)]), i) for i in range(5000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "a int, b int").repartition(6)
    assert rows(dense_keys(df, ["a", "b"], "k")) == rows(by_window(df, ["a", "b"]))


def test_dense_keys_split_a_frequent_value(spark):
    df = spark.range(20000).select(F.lit(1).alias("a"), F.col("id").alias("b"))
    numbered = dense_keys(df, ["a", "b"], "k")
    assert numbered.agg(F.min("k"), F.max("k"), F.count_distinct("k")).first() == (1, 20000, 20000)
    assert numbered.filter(F.col("k") != F.col("b") + 1).count() == 0


def test_dense_keys_of_nothing_and_after(spark, rows):
    empty = spark.createDataFrame([], "a int")
    assert rows(dense_keys(empty, ["a"], "k")) == []
    df = spark.createDataFrame([(3,), (1,), (2,)], "a int")
    assert rows(dense_keys(df, ["a"], "k", after=10)) == [(11, 1), (12, 2), (13, 3)]


def test_dense_keys_plan_has_no_single_partition_step(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    plan = dense_keys(df, ["x", "id"], "k")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    first=st.sets(st.text("abcxyz", max_size=3), max_size=8),
    later=st.sets(st.text("abcxyz", max_size=3), max_size=8),
)
def test_stable_keys_never_move(spark, first, later):
    one = spark.createDataFrame([(v,) for v in first], "v string")
    two = spark.createDataFrame([(v,) for v in first | later], "v string")
    old = {r.v: r.k for r in dense_keys(one, ["v"], "k").collect()}
    grown = stable_keys(two, KnownKeys(dense_keys(one, ["v"], "k"), len(first)), "v", "k").collect()
    new = {r.v: r.k for r in grown}
    assert {v: new[v] for v in old} == old
    assert sorted(new.values()) == list(range(1, len(first | later) + 1))
    added = sorted(set(later) - set(first))
    assert [new[v] for v in added] == sorted(new[v] for v in added)


def test_stable_keys_keep_a_null_key(spark, rows):
    current = spark.createDataFrame([(5, None), (6, "a")], "k long, v string")
    incoming = spark.createDataFrame([(None,), ("a",), ("b",)], "v string")
    assert rows(stable_keys(incoming, KnownKeys(current, 9), "v", "k")) == [(10, "b"), (5, None), (6, "a")]


def fan_out_frames(spark):
    left = spark.createDataFrame([(i, f"o{i}") for i in range(50)] + [(None, "none")], "id int, name string")
    # Order 3 holds a third of the payments, 0..9 have none.
    pays = [(3, i) for i in range(1000)] + [(10 + i % 40, 5000 + i) for i in range(2000)] + [(None, 1), (99, 2)]
    return left, spark.createDataFrame(pays, "id int, pay int")


def test_frequent_keys_finds_only_the_hot_one(spark):
    _, right = fan_out_frames(spark)
    found = frequent_keys(right, "id", 300).collect()
    assert [tuple(r) for r in found] == [(3, 4)]
    assert frequent_keys(right.limit(0), "id").isEmpty() and frequent_keys(right, "id").isEmpty()


def test_frequent_keys_finds_a_small_share(spark):
    """A key with less than a ten-thousandth of the rows, but more than one task should hold; counted without one big task."""
    right = spark.range(200_000).select(F.when(F.col("id") < 15, 7).otherwise(F.col("id")).alias("id"))
    found = frequent_keys(right, "id", 10)
    assert [tuple(r) for r in found.collect()] == [(7, 2)]


def test_fan_out_join_equals_plain_join(spark, rows):
    left, right = fan_out_frames(spark)
    plain = left.join(right, "id", "left")
    salted = fan_out_left_join(left, right, "id", ["pay"], rows_per_task=300)
    assert rows(salted.select("id", "name", "pay")) == rows(plain.select("id", "name", "pay"))
    assert "__salt" in salted._jdf.queryExecution().optimizedPlan().toString()


def test_fan_out_join_with_many_salts_and_few_matches(spark, rows):
    """Salts without any right row must not leave unmatched copies of the left row behind."""
    left = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "id int, name string")
    right = spark.createDataFrame([(1, 0), (1, 0), (1, 0), (2, 5)], "id int, pay int")
    joined = fan_out_left_join(left, right, "id", ["pay"], rows_per_task=1)
    assert rows(joined) == rows(left.join(right, "id", "left"))


def test_fan_out_join_without_frequent_keys_is_the_plain_join(spark, rows):
    left = spark.range(100)
    right = spark.range(0, 200, 2).withColumn("v", F.col("id"))
    joined = fan_out_left_join(left, right, "id", ["v"])
    assert "__salt" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert rows(joined) == rows(left.join(right, "id", "left"))


def test_busy_key_on_the_left_is_split_by_adaptive_execution(spark):
    """The lookups rely on it: the left rows of one key go to several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        facts = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("user_id"), F.col("id").alias("order_id")
        )
        users = spark.range(60000).withColumnRenamed("id", "user_id").withColumn("user_key", F.col("user_id") + 1)
        joined = facts.join(users, "user_id", "left")
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
