"""Paths of any depth, lists of hot groups, counts in one pass, frames with their count."""

from pyspark.sql import functions as F

from conftest import plan_text
from siftkit.operators.hierarchy import NODE_ATTRS, level_chain, path_levels, walk_paths
from siftkit.operators.nested import collect_distinct_string
from siftkit.plans.facts import KW, distinct_counts, funnel_totals, keyword_counts
from siftkit.sources.tables import materialize, materialize_counted

NODES = ("id string, parent_category_id string, category_level int, catalog_code string, category_code string, "
         "name string, name_english string")


def _nodes(spark, links, levels=None):
    rows = [(i, p, (levels or {}).get(i, 1 if p is None else 2), "main", f"c-{i}", f"n-{i}", None) for i, p in links]
    return spark.createDataFrame(rows, NODES)


def _walk(nodes, **kw):
    paths = walk_paths(nodes, F.col("category_level") == 1, materialize, **kw)
    return sorted(("/".join(r[0]), r[1]) for r in paths.select("path.id", "cyclic").collect())


def test_chain_of_twelve_levels(spark):
    links = [("1", None)] + [(str(n), str(n - 1)) for n in range(2, 13)] + [("x", "5")]
    assert _walk(_nodes(spark, links)) == [("/".join(map(str, range(1, 13))), False), ("1/2/3/4/5/x", False)]


def test_cycles_are_closed_and_marked(spark):
    # 'b' is listed under 'a' and under 'c': a -> b -> c -> b
    links = [("a", None), ("b", "a"), ("c", "b"), ("b", "c"), ("d", "c"), ("s", None), ("t", "t")]
    assert _walk(_nodes(spark, links)) == [("a/b/c/b", True), ("a/b/c/d", False), ("s", False)]


def test_no_roots_and_null_links(spark):
    assert _walk(_nodes(spark, [("a", "z"), (None, "a")])) == []
    rows = walk_paths(_nodes(spark, [("a", None), (None, "a")]), F.col("category_level") == 1, materialize).collect()
    assert [[n["id"] for n in r["path"]] for r in rows] == [["a", None]]


def test_eight_levels_equal_the_fixed_chain(spark):
    links = [("r", None), ("r2", None)] + [(f"{n}", f"{n - 1}" if n > 2 else "r") for n in range(2, 9)] + [("y", "4"), ("z", "r")]
    levels = {"r": 1, "r2": 1, **{f"{n}": n for n in range(2, 9)}, "y": 5, "z": 3}     # z: its level is not that of its place
    nodes = _nodes(spark, links, levels)
    root = F.col("category_level") == 1
    walked = walk_paths(nodes, root, materialize, level_col="category_level").where(F.size("path") > 1)
    fixed = level_chain(nodes, root, 8)
    assert path_levels(walked, 8).columns == fixed.columns
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(path_levels(walked, 8).collect(), key=key) == sorted(fixed.collect(), key=key)
    assert len(NODE_ATTRS) * 8 == len(fixed.columns)


def test_hot_group_is_listed_without_a_set(spark):
    n = 200_000
    hot = spark.range(n).select(F.lit("hot").alias("g"), F.array(
        F.struct(F.concat(F.lit("s"), F.col("id") % (n // 2)).alias("sku")),
        F.struct(F.lit("").alias("sku")), F.struct(F.lit(None).cast("string").alias("sku"))).alias("items"))
    rest = spark.createDataFrame([("a", [("2",), ("1",), ("2",)]), ("b", [("",), (None,)]), ("c", None), (None, [("9",)])],
                                 "g string, items array<struct<sku:string>>")
    out = collect_distinct_string(hot.unionByName(rest), ["g"], "items", "sku", "skus")
    got = {r["g"]: r["skus"] for r in out.collect()}
    assert got.pop("hot") == ",".join(sorted(f"s{k}" for k in range(n // 2)))
    assert got == {"a": "1,2", None: "9"}
    assert "collect_set" not in plan_text(out)


def test_counts_of_all_sets_share_a_pass(spark):
    loads = spark.createDataFrame([("s1", "k"), ("s1", "k"), ("s2", "k"), ("s1", "q"), ("s3", None), (None, "k"), ("s1k", "")],
                                  f"session_id string, {KW} string")
    clicks = spark.createDataFrame([("s1", "k"), ("s9", "only"), (None, "q"), ("s3", None)],
                                   f"session_id string, {KW} string")
    counted = distinct_counts(loads, clicks)
    got = sorted((str(r[KW]), r["search_loads"], r["search_clicks"]) for r in keyword_counts(counted).collect())
    # 's1' + 'k' and 's1k' + '' are one pair without a separator
    assert got == [("", 1, None), ("None", 1, None), ("k", 2, 1), ("q", 1, 0)]
    assert funnel_totals(counted).first().asDict() == {"total_loads": 3, "total_clicks": 2, "total_keywords": 3}
    none = distinct_counts(loads.limit(0), clicks.limit(0))
    assert keyword_counts(none).count() == 0
    assert funnel_totals(none).first().asDict() == {"total_loads": 0, "total_clicks": 0, "total_keywords": 0}


def test_frame_and_count_by_one_job(spark):
    frame, rows = materialize_counted(spark.range(1000).where("id % 3 = 0").repartition(7), "counted")
    assert (rows, frame.count()) == (334, 334)
    empty, none = materialize_counted(spark.range(0), "counted")
    assert none == 0 and empty.count() == 0
