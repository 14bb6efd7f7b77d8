"""Parents and children: registries, ancestors, descendants, roots and their checks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import shared_folder
def _cut(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder and read again."""
    at = f"{shared_folder(df.sparkSession)}/closure-{uuid.uuid4()}"
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)


def closure(edges: DataFrame, node: str = "node", parent: str = "parent", levels: int | None = None) -> DataFrame:
    """(node, ancestor, distance) for each node and each of its ancestors, by doubling.

    Each round joins the pairs found so far with themselves, so a tree of depth d takes log2(d)
    rounds. Rounds end where they find nothing new; a node that is its own ancestor by way of others
    raises ValueError. With `levels` they also end there, which ends cycles without an error.
    """
    step = edges.filter(F.col(parent).isNotNull() & (F.col(parent) != F.col(node))).select(F.col(node).alias("node"), F.col(parent).alias("ancestor")).distinct()
    known = _cut(step.withColumn("distance", F.lit(1).cast("long")))
    reach = 1
    while levels is None or reach < levels:
        far = known.filter(F.col("distance") == reach).alias("a").join(known.alias("b"), F.col("a.ancestor") == F.col("b.node"))
        more = far.select("a.node", "b.ancestor", (F.lit(reach) + F.col("b.distance")).alias("distance"))
        more = _cut(more.distinct())  # each round reads what the last ones wrote
        if more.isEmpty():
            break
        if levels is None and not more.filter("node = ancestor").isEmpty():
            raise ValueError("a node is its own ancestor")
        known = known.unionByName(more)
        reach *= 2
    return known.groupBy("node", "ancestor").agg(F.min("distance").alias("distance"))


def roots_of(edges: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """(node, root) for every node, roots too."""
    every = edges.select(F.col(node).alias("node")).unionByName(edges.filter(F.col(parent).isNotNull()).select(F.col(parent).alias("node"))).distinct()
    top = closure(edges, node, parent).groupBy("node").agg(F.max_by("ancestor", "distance").alias("root"))
    return every.join(top, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def children(rows: DataFrame, parent: str, item: str) -> DataFrame:
    """Per parent the items in order, joined, and their number."""
    return rows.groupBy(parent).agg(F.array_join(F.array_sort(F.collect_list(item)), ",").alias("children"), F.count(item).alias("n"))


def merged(rows: DataFrame, key: str, position: str, fields: list[str]) -> DataFrame:
    """One row a key: each field's last value that is not null, by position."""
    return rows.groupBy(key).agg(*[F.max_by(f, F.when(F.col(f).isNotNull(), F.col(position))).alias(f) for f in fields])


def faults(rows: DataFrame, key: str, parent: str, enum: str, allowed: list[str]) -> DataFrame:
    """(key, fault): own parent, unknown parent, value outside the enumeration."""
    known = rows.select(F.col(key).alias("_known")).distinct()
    joined = rows.join(known, F.col(parent) == F.col("_known"), "left")
    cases = [
        F.when(F.col(parent) == F.col(key), "own parent"),
        F.when(F.col(parent).isNotNull() & F.col("_known").isNull(), "unknown parent"),
        F.when(~F.coalesce(F.col(enum).isin(*allowed), F.lit(False)), "bad value"),
    ]
    return joined.select(F.col(key), F.explode(F.filter(F.array(*cases), lambda x: x.isNotNull())).alias("fault"))


def registry(rows: DataFrame, code: str, position: str, fields: list[str], parent: str, inherited: list[str] = []) -> DataFrame:  # noqa: B006
    """One node a code, from rows in order of position with a parent struct of code and fields, or null.

    A field has its last value that is not null, given by the node's own rows or as a parent by its
    children's. The parent is that of the node's last own row: a last row without one detaches it.
    Nodes that are only named as parents are there too; until told otherwise they have their first
    child's `inherited` fields. A node that is its own parent raises.
    """
    inner = {f.name for f in rows.schema[parent].dataType.fields}
    own = rows.select(code, position, F.lit(True).alias("_own"), *fields, F.col(parent)[code].alias("_parent"), *[F.lit(None).cast(rows.schema[f].dataType).alias(f"_{f}") for f in inherited])
    given = [(F.col(parent)[f] if f in inner else F.lit(None)).cast(rows.schema[f].dataType).alias(f) for f in fields]
    stub = rows.filter(F.col(parent)[code].isNotNull()).select(F.col(parent)[code].alias(code), position, F.lit(False).alias("_own"), *given, F.lit(None).cast("string").alias("_parent"), *[F.col(f).alias(f"_{f}") for f in inherited])
    last = {f: F.max_by(f, F.when(F.col(f).isNotNull(), F.col(position))) for f in fields}
    kept = [(F.coalesce(last[f], F.min_by(f"_{f}", F.when(F.col(f"_{f}").isNotNull(), F.col(position)))) if f in inherited else last[f]).alias(f) for f in fields]
    of = F.max_by("_parent", F.when(F.col("_own"), F.col(position)))
    nodes = own.unionByName(stub).groupBy(code).agg(*kept, of.alias("_parent"), F.min(position).alias("_first"))
    checked = F.when(F.col("_parent") == F.col(code), F.raise_error(F.lit("a node is its own parent")).cast("string")).otherwise(F.col("_parent"))
    return nodes.withColumn("parent", checked).drop("_parent")


def roots(nodes: DataFrame, parent: str = "parent") -> DataFrame:
    """The nodes without a parent."""
    return nodes.filter(F.col(parent).isNull())


def linked(nodes: DataFrame, links: DataFrame, code: str) -> DataFrame:
    """The nodes with the parents that links (code, parent) give them, null for none; a link of an unknown node raises."""
    unknown = links.join(nodes.select(code), code, "left_anti").limit(1).collect()
    if unknown:
        raise KeyError(f"unknown node: {unknown[0][code]}")
    new = links.select(F.col(code).alias("_code"), F.col("parent").alias("_new"))
    joined = nodes.join(new, F.col(code) == F.col("_code"), "left")
    return joined.withColumn("parent", F.when(F.col("_code").isNotNull(), F.col("_new")).otherwise(F.col("parent"))).drop("_code", "_new")


def trees(nodes: DataFrame, code: str, shown: list[str], fields: list[str], include_tree: bool = True) -> DataFrame:
    """Each node as JSON: its fields, with its parent's and its children's `shown` ones; absent where it has none."""
    own = [F.col(f) for f in fields]
    if not include_tree:
        return nodes.select(code, F.to_json(F.struct(*own)).alias("node"))
    up = nodes.select(F.col(code).alias("_up"), F.struct(*shown).alias("_parent"))
    down = nodes.filter("parent is not null").groupBy(F.col("parent").alias("_down")).agg(F.transform(F.array_sort(F.collect_list(F.struct("_first", *shown))), lambda x: F.struct(*[x[f].alias(f) for f in shown])).alias("_children"))
    joined = nodes.join(up, F.col("parent") == F.col("_up"), "left").join(down, F.col(code) == F.col("_down"), "left")
    return joined.select(code, F.to_json(F.struct(*own, F.col("_parent").alias("parent"), F.col("_children").alias("children"))).alias("node"))


def own_or_parent(rows: DataFrame, key: Column, parent_key: Column, table: DataFrame, table_key: str) -> DataFrame:
    """Rows with the table's columns for their parent's key, or their own where there is no parent; none is tolerated."""
    look = rows.withColumn("_look", F.coalesce(parent_key, key))
    return look.join(table, F.col("_look") == F.col(table_key), "left").drop("_look", table_key)
