"""J3 category path table and J4 search category mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MISSING_CATEGORY, PATH_SEPARATOR, FactsConfig
from ..functions.channels import date_between
from ..functions.paths import split_path
from ..operators.batching import Stage, global_positions
from ..operators.hierarchy import NODE_ATTRS, deepest, level_chain, unpivot_levels, walk_paths
from ..operators.topk import best_per_group

PATH_COL = "search_internal_category_id"
NAME_COLS = ("c1_name", "c1_name_english", "c2_name", "c2_name_english", "c3_name", "c3_name_english")


def category_paths(category: DataFrame, catalog_code: str, levels: int = 8) -> DataFrame:
    """Every path from a root of the catalog, with the deepest known values (``cn_*``).

    Only the root is filtered by catalog; ``cn_*`` skips level 1 and falls
    back to a fixed marker when no deeper level has the attribute.
    """
    chain = level_chain(category, F.col("catalog_code") == F.lit(catalog_code), levels)
    cols = [F.col(f"c{n}_{a}") for n in range(1, levels + 1) for a, _ in NODE_ATTRS]
    cn = [deepest(levels, a, MISSING_CATEGORY).alias(f"cn_{a}") for a, _ in NODE_ATTRS]
    return chain.select(*cols, *cn).distinct()


def category_paths_any_depth(category: DataFrame, catalog_code: str, stage) -> DataFrame:
    """N9 without a level limit: every path from a root of the catalog by its links alone, cycles marked."""
    root = (F.col("category_level") == 1) & (F.col("catalog_code") == F.lit(catalog_code))
    paths = walk_paths(category, root, stage)
    return paths.select(
        F.array_join(F.col("path.id"), PATH_SEPARATOR).alias("path_ids"),
        F.array_join(F.col("path.code"), PATH_SEPARATOR).alias("path_codes"),
        F.size("path").alias("depth"), "cyclic").distinct()


def exploded_paths(views: DataFrame, cfg: FactsConfig) -> DataFrame:
    """N17 + A1: distinct (path string, code) pairs of impressions in the date window."""
    rows = views.where(date_between(F.col("datetime"), cfg.date_from, cfg.date_to))
    return rows.select(PATH_COL, F.explode(split_path(F.col(PATH_COL))).alias("code")).distinct()


def deepest_known_code(exploded: DataFrame, category: DataFrame, cfg: FactsConfig) -> DataFrame:
    """N10 + W1: per path string, the deepest code known in the catalog.

    Ties at the same level go to the smallest code. Path strings without a
    known code are absent.
    """
    known = (category.where(F.col("catalog_code") == F.lit(cfg.catalog_code))
             .where(F.col("category_level").isNotNull())
             .select("category_code", "category_level"))
    mapped = exploded.join(known, exploded["code"] == known["category_code"], "inner")
    return best_per_group(
        mapped, [PATH_COL],
        order=[-F.col("category_level"), F.col("category_code")],
        payload=["category_level", "category_code"],
    )


def map_search_categories(views: DataFrame, category: DataFrame, paths: DataFrame,
                          cfg: FactsConfig = FactsConfig()) -> DataFrame:
    """Path string -> deepest known category -> level 1-3 names (nulled below the match)."""
    chosen = deepest_known_code(exploded_paths(views, cfg), category, cfg)
    levels = unpivot_levels(paths, cfg.levels, NAME_COLS).withColumnsRenamed(
        {"level": "__level", "code": "__code"})
    resolved = chosen.join(
        levels,
        (chosen["category_level"] == levels["__level"]) & (chosen["category_code"] == levels["__code"]),
        "left",
    )
    lvl = F.col("category_level")
    out = resolved.select(
        PATH_COL,
        F.col("c1_name"),
        F.when(lvl >= 2, F.col("c2_name")).alias("c2_name"),
        F.when(lvl >= 3, F.col("c3_name")).alias("c3_name"),
        F.col("c1_name_english"),
        F.when(lvl >= 2, F.col("c2_name_english")).alias("c2_name_english"),
        F.when(lvl >= 3, F.col("c3_name_english")).alias("c3_name_english"),
        lvl.alias("matched_level"),
        F.col("category_code").alias("matched_category_code"),
    ).distinct()
    return out


def mapping_in_order(mapping: DataFrame, stage: Stage) -> DataFrame:
    """O1: the mapping in total order, with each row's 0-based ``position``.

    Rows are ordered by path string, those with one string by the other columns, nulls first. A
    range-partitioned sort, its partitions numbered by their row counts; no task holds all rows.
    """
    return global_positions(mapping, [PATH_COL, *[c for c in mapping.columns if c != PATH_COL]], stage)
