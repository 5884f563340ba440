"""Batch tables with a ledger, CSV round trip, co-located tables and salted joins."""

import random
import uuid
from collections import Counter

import pytest
from conftest import plan_text
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftkit.operators.skew import hot_keys, salted_join
from siftkit.session import ensure_checkpoint_dir
from siftkit.sources.ledger import BatchLoaded, BatchTable, SchemaMismatch, conform, read_csv, write_csv
from siftkit.sources.tables import write_colocated

SCHEMA = StructType().add("day", "string").add("id", "long").add("v", "double")


def fresh(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def rows(spark, *items):
    return spark.createDataFrame(list(items), SCHEMA)


def seen(table):
    return sorted(((r["day"] or "~"), r["id"], r["load"]) for r in table.read().collect())


def test_replace_append_and_refusal(spark):
    t = BatchTable(spark, fresh(spark, "bt"), SCHEMA, "day")
    assert t.read().collect() == [] and t.ledger().collect() == []
    t.replace(rows(spark, ("a", 1, 1.0), ("b", 2, None), (None, 3, 0.5), ("", 4, 0.5)), "one")
    assert seen(t) == sorted([("a", 1, "one"), ("b", 2, "one"), ("~", 3, "one"), ("~", 4, "one")])
    t.append(rows(spark, ("c", 5, 1.0)), "two")
    for again in (("c", 6, 1.0), (None, 7, 1.0), ("", 8, 1.0)):
        with pytest.raises(BatchLoaded):
            t.append(rows(spark, ("new", 9, 1.0), again), "three")
    assert len(seen(t)) == 5                                            # nothing of a refused append is seen
    t.replace(rows(spark, ("b", 20, 1.0)), "four")
    assert seen(t) == [("b", 20, "four")]
    t.replace(rows(spark), "none")
    assert seen(t) == [("b", 20, "four")]                               # an empty load commits no batch


def test_a_load_that_dies_before_its_commit_is_not_seen(spark):
    t = BatchTable(spark, fresh(spark, "bt"), SCHEMA, "day")
    first = rows(spark, ("a", 1, 1.0), ("b", 2, 1.0))
    t.commit(t.write(first, "one"), "one", batches=first.where("day = 'a'"))
    t.write(rows(spark, ("c", 3, 1.0)), "lost")
    assert seen(t) == [("a", 1, "one")]
    whole = first.unionByName(rows(spark, ("c", 3, 1.0), ("d", 4, 1.0)))
    t.resume(whole, "two")
    t.resume(whole, "three")
    assert seen(t) == [("a", 1, "one"), ("b", 2, "two"), ("c", 3, "two"), ("d", 4, "two")]
    assert {(r["batch"], r["n_rows"]) for r in t.ledger().collect()} == {("va", 1), ("vb", 1), ("vc", 1), ("vd", 1)}


def test_schema_contract(spark):
    df = spark.createDataFrame([(1.5, 7, "x")], "v float, id int, day string")
    assert [tuple(r) for r in conform(df, SCHEMA).collect()] == [("x", 7, 1.5)] and conform(df, SCHEMA).schema == SCHEMA
    for bad in (df.drop("v"), df.withColumn("more", F.lit(1)), df.withColumn("id", F.col("id").cast("string"))):
        with pytest.raises(SchemaMismatch):
            conform(bad, SCHEMA)


HOSTILE = [None, "", " ", '"', '""', ",", "\n", 'a"b,c\nd', "\\", '\\"', "a\\", "  lead", "trail  ", "tab\there", "\r", "a\r\nb",
           "é漢", "#", "'", "null", "x" * 20000]


def test_csv_round_trip_of_hostile_values(spark):
    schema = StructType().add("id", "long").add("term", "string").add("n", "integer")
    df = spark.createDataFrame([(i, t, "x" if i % 5 == 3 else (None if i % 5 == 4 else str(i))) for i, t in enumerate(HOSTILE)],
                               "id long, term string, n string").repartition(3)
    path = fresh(spark, "csv")
    write_csv(df, path)
    got = {r["id"]: r for r in read_csv(spark, path, schema).collect()}
    assert len(got) == len(HOSTILE)
    for i, t in enumerate(HOSTILE):
        assert got[i]["term"] == t, repr(t)
        assert (got[i]["rejected"] is not None) == (i % 5 == 3)
        assert got[i]["n"] == (i if i % 5 < 3 else None)


def test_colocated_join_has_no_exchange_below_it(spark):
    a = spark.createDataFrame([("d%d" % (i % 3), "s%d" % (i % 7), "k%d" % (i % 5)) for i in range(200)], "day string, s string, k string")
    t = [write_colocated(a, f"t_{uuid.uuid4().hex}", fresh(spark, "co"), "day", ["s", "k"], 4) for _ in range(2)]
    left, right = (x.where("day = 'd1'").groupBy("s", "k").agg(F.count("*").alias(n)) for x, n in zip(t, "ab", strict=True))
    joined = left.join(right.hint("merge"), ["s", "k"])
    plan = plan_text(joined)
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "day" in plan.split("PartitionFilters")[1][:80]
    assert joined.count() == a.where("day = 'd1'").select("s", "k").distinct().count()


@pytest.mark.parametrize("hot_rows", [5, 10_000])
def test_salted_join_equals_a_plain_join(spark, hot_rows):
    rng = random.Random(3)
    left = [(rng.choice(["", "", "", "a", "b", None, "only-left"]), i) for i in range(400)]
    right = [("", 1), ("", 2), ("a", 3), (None, 4), ("only-right", 5)]
    got = salted_join(spark.createDataFrame(left, "key string, l long").repartition(5),
                      spark.createDataFrame(right, "key string, r long"), "key", F.col("l"), hot_rows)
    want = Counter((k, i, j) for k, i in left for k2, j in right if k is not None and k == k2)
    assert got.columns == ["key", "l", "r"] and Counter(map(tuple, got.collect())) == want


def test_no_task_holds_all_rows_of_a_hot_key(spark):
    left = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "").otherwise(F.col("id").cast("string")).alias("key"), "id")
    hot = hot_keys(left, "key", hot_rows=500, most=64).collect()
    assert [(r["key"], r["__salts"]) for r in hot] == [("", 14)]
    right = spark.createDataFrame([("", 1), ("7", 2)], "key string, r long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = salted_join(left, right.hint("merge"), "key", F.col("id"), 500, 64).where("key = ''")
        parts = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sum(r["count"] for r in parts) == 6667 and len(parts) > 1 and max(r["count"] for r in parts) < 6000
