"""Adjacency list to paths of fixed or any depth (N9, O3, X18), and level unpivot."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# output suffix -> source column of the node table
NODE_ATTRS = (("id", "id"), ("code", "category_code"), ("name", "name"), ("name_english", "name_english"))


def level_chain(nodes: DataFrame, root_filter: Column, levels: int,
                attrs: Sequence[tuple[str, str]] = NODE_ATTRS, id_attr: str = "id",
                parent_col: str = "parent_category_id", level_col: str = "category_level") -> DataFrame:
    """One row per root-to-node path, levels 1..n as column groups ``c<L>_<attr>``.

    Level 2 is an inner join (roots without children vanish), deeper levels
    are left joins; each level is pre-filtered on its level number, so each
    join reads only that level of the table.
    """
    def level(n: int) -> DataFrame:
        return nodes.where(F.col(level_col) == n).select(
            F.col(parent_col).alias(f"__parent{n}"),
            *[F.col(src).alias(f"c{n}_{dst}") for dst, src in attrs],
        )

    paths = nodes.where((F.col(level_col) == 1) & root_filter).select(
        *[F.col(src).alias(f"c1_{dst}") for dst, src in attrs])
    for n in range(2, levels + 1):
        child = level(n)
        paths = paths.join(child, F.col(f"c{n - 1}_{id_attr}") == F.col(f"__parent{n}"),
                           "inner" if n == 2 else "left").drop(f"__parent{n}")
    return paths


OPEN, ENDED, CYCLIC = "open", "ended", "cyclic"


def walk_paths(nodes: DataFrame, root_filter: Column, stage: Callable[[DataFrame, str], DataFrame],
               attrs: Sequence[tuple[str, str]] = NODE_ATTRS, id_attr: str = "id",
               parent_col: str = "parent_category_id", level_col: str | None = None) -> DataFrame:
    """N9 at any depth: all paths from a root until they end or meet one of their own nodes again.

    The frontier (one array of nodes per open path) is joined with the
    children of its last nodes once per level; every round is written by
    ``stage``, so lineage stays one join long and the driver learns only
    whether paths are open. With ``level_col`` a child counts only if its level
    number is that of its place, as in :func:`level_chain`; without it only
    the links count, and a path that returns to one of its nodes is closed
    with that node repeated (``cyclic``). A node without children ends a
    path, a root alone included. A row that is there twice gives its
    paths twice. Null parents and null ids are nobody's children or parents.

    Returns path (array of ``attrs`` structs), cyclic.
    """
    node = F.struct(*[F.col(src).alias(dst) for dst, src in attrs])
    level = F.col(level_col) if level_col else F.lit(None).cast("int")
    tree = nodes.select(F.col(parent_col).alias("__parent"), level.alias("__level"), node.alias("__node"))
    front = stage(nodes.where(root_filter).select(F.array(node).alias("path"), F.lit(OPEN).alias("state")), "paths")
    closed: list[DataFrame] = []
    while not front.where(F.col("state") == OPEN).isEmpty():
        link = F.element_at("path", -1)[id_attr] == F.col("__parent")
        if level_col:
            link &= F.col("__level") == F.size("path") + 1
        met = F.exists("path", lambda n: n[id_attr] == F.col("__node")[id_attr])
        state = (F.when(F.col("__node").isNull(), ENDED).when(met, CYCLIC).otherwise(OPEN))
        longer = F.when(F.col("__node").isNull(), F.col("path")).otherwise(F.concat("path", F.array("__node")))
        front = stage(front.where(F.col("state") == OPEN).select("path").join(tree, link, "left")
                      .select(longer.alias("path"), state.alias("state")), "paths")
        closed.append(front.where(F.col("state") != OPEN))
    out = closed[0] if closed else front
    for part in closed[1:]:
        out = out.unionByName(part)
    return out.select("path", (F.col("state") == CYCLIC).alias("cyclic"))


def path_levels(paths: DataFrame, levels: int, attrs: Sequence[tuple[str, str]] = NODE_ATTRS) -> DataFrame:
    """The first ``levels`` places of :func:`walk_paths` as columns ``c<L>_<attr>``, null beyond a path's end."""
    return paths.select(*[F.get("path", n - 1)[dst].alias(f"c{n}_{dst}")
                          for n in range(1, levels + 1) for dst, _ in attrs])


def deepest(levels: int, attr: str, fallback: str, lowest: int = 2) -> Column:
    """O3: the value of the deepest level that has one (each attribute on its own null test)."""
    return F.coalesce(*[F.col(f"c{n}_{attr}") for n in range(levels, lowest - 1, -1)], F.lit(fallback))


def unpivot_levels(paths: DataFrame, levels: int, carry: Sequence[str],
                   code_attr: str = "code") -> DataFrame:
    """N11 rewrite: one ``(level, code)`` row per non-null level code of each path row.

    An OR of ``(level = L AND c<L>_code = code)`` terms then becomes an
    equi-join on ``(level, code)``; one pass over the path table.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("level"), F.col(f"c{n}_{code_attr}").alias("code"))
                      for n in range(1, levels + 1)])
    return (paths.select(*carry, F.inline(pairs))
            .where(F.col("code").isNotNull()))
