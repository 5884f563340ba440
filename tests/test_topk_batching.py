"""W1/W2 top-1 per group and O4/E2 positional batches against window functions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from siftkit.operators.batching import assign_batches, global_positions
from siftkit.operators.topk import best_per_group
from siftkit.sources.tables import materialize


def _stage(df, name):
    return materialize(df, name)


def test_best_per_group_equals_row_number(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 20), rng.randint(1, 5), f"c{rng.randint(0, 9)}") for _ in range(300)]
    df = spark.createDataFrame(rows, "g int, level int, code string")
    got = {tuple(r) for r in best_per_group(df, ["g"], [-F.col("level"), F.col("code")], ["level", "code"]).collect()}
    w = Window.partitionBy("g").orderBy(F.col("level").desc(), F.col("code"))
    want = {tuple(r) for r in df.withColumn("rn", F.row_number().over(w)).where("rn = 1")
            .select("g", "level", "code").collect()}
    assert got == want


def test_global_positions_equal_row_number(spark):
    terms = spark.createDataFrame([(f"t{i:04d}",) for i in random.Random(1).sample(range(5000), 777)], "t string")
    got = {(r.t, r.position) for r in global_positions(terms.repartition(7), "t", _stage).collect()}
    w = Window.orderBy("t")
    want = {(r.t, r.p) for r in terms.select("t", (F.row_number().over(w) - 1).alias("p")).collect()}
    assert got == want


def test_assign_batches(spark):
    terms = spark.createDataFrame([(f"t{i:03d}",) for i in range(37)], "t string")
    rows = assign_batches(terms, "t", 10, _stage).collect()
    assert {r.total_batches for r in rows} == {4}
    assert sorted(r.batch_id for r in rows) == sorted([i // 10 for i in range(37)])
    last = [r for r in rows if r.batch_id == 3]
    assert {(r.batch_start, r.batch_end) for r in last} == {(30, 37)}
    hashed = assign_batches(terms, "t", 10, _stage, method="hash").collect()
    assert all(0 <= r.batch_id < 4 for r in hashed)
