import random

from pyspark.sql import functions as F

from orderloom.operators.absent import absent_rows, held_keys
from orderloom.operators.firsts import keep_first, repeated_keys, tag_first


def skewed(spark, n=3000, seed=3):
    """A third of the rows carries one key, a tenth none at all."""
    rng = random.Random(seed)
    order = list(range(n))
    rng.shuffle(order)
    rows = []
    for i in order:
        draw = rng.random()
        key = "hot" if draw < 0.33 else None if draw < 0.43 else f"k{rng.randint(0, n // 3)}"
        rows.append((key, i % 7, i, f"v{i}"))
    return rows, spark.createDataFrame(rows, "key string, part int, seq int, value string").repartition(6)


def brute_first(rows):
    first = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        first.setdefault(row[0], row)
    return set(first.values())


def test_first_copies_match_brute_force(spark):
    rows, df = skewed(spark)
    expected = brute_first(rows)
    assert {tuple(r) for r in keep_first(df, ["key"], ["part", "seq"]).collect()} == expected
    tagged = tag_first(df, ["key"], ["part", "seq"]).collect()
    assert len(tagged) == len(rows)
    assert {tuple(r)[:4] for r in tagged if r["is_first"]} == expected


def test_rows_outside_the_condition_do_not_compete(spark):
    df = spark.createDataFrame([(None, 1, False), (None, 2, True), (None, 3, True)], "key string, seq int, ok boolean")
    got = {r["seq"]: r["is_first"] for r in tag_first(df, ["key"], ["seq"], among=F.col("ok")).collect()}
    assert got == {1: False, 2: True, 3: False}


def test_copies_of_a_hot_key_spread_over_the_tasks(spark):
    _, df = skewed(spark, 4000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tagged = tag_first(df, ["key"], ["part", "seq"])
        plan = tagged._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in tagged.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" not in plan
    assert max(sizes) < 2 * 4000 / 8


def test_repeated_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "key string")
    assert {tuple(r) for r in repeated_keys(df, ["key"]).collect()} == {("a", 2), (None, 2)}


def test_absent_and_held(spark):
    incoming = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "key string, v int")
    stored = spark.createDataFrame([("b", "x"), ("z", "y")], "key string, batch string")
    assert {r["key"] for r in absent_rows(incoming, stored, ["key"]).collect()} == {"a", "c"}
    assert [tuple(r) for r in held_keys(incoming, stored, ["key"], "batch").collect()] == [("b", "x")]


def test_a_flag_that_is_there_spares_the_search(spark, event):
    from orderloom.operators.clean import tag_orders
    rows = spark.createDataFrame([{k: None if v is None else str(v) for k, v in event(order_id=i).items()} | {"at": n}
                                  for n, i in enumerate(("a", "b", "a", "b"))]).withColumn("known", F.col("at") < 2)
    assert sorted(tag_orders(rows, ["at"]).drop("ingested_at").collect()) == sorted(
        tag_orders(rows, ["at"], first="known").drop("ingested_at").collect())


def test_later_copies_are_told_by_narrow_columns(spark):
    from orderloom.operators.firsts import later_copies, tag_listed
    rows, df = skewed(spark)
    first = {row[2] for row in brute_first([(key, 0, seq, value) for key, part, seq, value in rows])}
    listed = later_copies(df, ["key"], "seq", F.col("part") < 9, "seq")
    got = tag_listed(df, listed, "seq", "later")
    assert got.columns == [*df.columns, "later"]
    assert {r["seq"] for r in got.collect() if not r["later"]} == first and got.count() == len(rows)
    among = later_copies(df, ["key"], "seq", F.col("part") == 1, "seq").collect()
    ones = [row for row in rows if row[1] == 1]
    assert {r["seq"] for r in among} == {r[2] for r in ones} - {r[2] for r in brute_first(ones)}
