"""Semi join, null-aware anti join (T6), membership in either of two sets."""

from conftest import plan_text
import itertools

from pyspark.sql import functions as F

from siftkit.operators.membership import in_either, null_aware_anti_join, semi_join

LEFTS = [["a", "b", None], ["a"], [None], []]
SETS = [["a"], ["a", None], [None], [], ["c"]]


def _df(spark, vals, name):
    return spark.createDataFrame([(v,) for v in vals], f"{name} string")


def test_null_aware_anti_matches_sql_not_in(spark):
    for left, right in itertools.product(LEFTS, SETS):
        l_df, r_df = _df(spark, left, "k"), _df(spark, right, "s")
        got = sorted(null_aware_anti_join(l_df, r_df, F.col("k"), F.col("s")).collect(), key=repr)
        want = sorted(spark.sql("SELECT k FROM {l} WHERE k NOT IN (SELECT s FROM {r})", l=l_df, r=r_df)
                      .collect(), key=repr)
        assert got == want, (left, right)


def test_null_in_set_removes_everything(spark):
    l_df, r_df = _df(spark, ["a", "x", None], "k"), _df(spark, ["a", None], "s")
    assert null_aware_anti_join(l_df, r_df, F.col("k"), F.col("s")).count() == 0


def test_empty_set_keeps_null_key(spark):
    l_df, r_df = _df(spark, ["a", None], "k"), _df(spark, [], "s")
    got = {r.k for r in null_aware_anti_join(l_df, r_df, F.col("k"), F.col("s")).collect()}
    assert got == {"a", None}


def test_anti_join_plan_has_no_nested_loop(spark):
    l_df, r_df = _df(spark, ["a"], "k"), _df(spark, ["b"], "s")
    plan = plan_text(null_aware_anti_join(l_df, r_df, F.col("k"), F.col("s")))
    assert "NestedLoop" not in plan


def test_semi_join_ignores_nulls(spark):
    l_df, r_df = _df(spark, ["a", None, "b"], "k"), _df(spark, ["a", None], "s")
    assert {r.k for r in semi_join(l_df, r_df, F.col("k"), F.col("s")).collect()} == {"a"}


def test_in_either(spark):
    l_df = _df(spark, ["a", "b", "c", None], "k")
    a, b = _df(spark, ["a", None], "x"), _df(spark, ["c"], "y")
    got = {r.k for r in in_either(l_df, a, b, F.col("k"), F.col("x"), F.col("y")).collect()}
    assert got == {"a", "c"}
