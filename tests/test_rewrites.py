"""Rewrite equivalence on seeded random data (N11) and plan assertions over every query."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import plan_text
from siftkit.operators.hierarchy import unpivot_levels


def test_unpivot_join_equals_or_join(spark):
    rng = random.Random(11)
    code = lambda: rng.choice([None, "a", "b", "c", "d"])
    paths = spark.createDataFrame(
        [(i, code(), code(), code(), code()) for i in range(60)],
        "pid int, c1_code string, c2_code string, c3_code string, c4_code string")
    chosen = spark.createDataFrame([(j, rng.randint(1, 4), code()) for j in range(40)],
                                   "cid int, category_level int, category_code string")
    ors = " OR ".join(f"(c.category_level = {n} AND h.c{n}_code = c.category_code)" for n in range(1, 5))
    want = spark.sql(f"SELECT c.cid, h.pid FROM {{c}} c LEFT JOIN {{h}} h ON ({ors})", c=chosen, h=paths)
    levels = unpivot_levels(paths, 4, ["pid"])
    got = chosen.join(levels, (chosen["category_level"] == levels["level"])
                      & (chosen["category_code"] == levels["code"]), "left").select("cid", "pid")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


PLAN_QUERIES = sorted(n for n in E.queries() if n != "batch_resume")


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_no_nested_loop_or_cartesian(spark, name):
    plan = plan_text(E.queries()[name](spark, "/root/testdata/sf0.001"))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, name
