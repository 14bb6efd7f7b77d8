"""Catalogues: counts per theme, related items, defaults, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def theme_counts(themes: DataFrame, theme: str, items: DataFrame, item_theme: str, built: Column) -> DataFrame:
    """Per theme the items and those built; themes without any have zeros. Items are counted before the join."""
    counts = items.groupBy(F.col(item_theme).alias("_theme")).agg(F.count(F.lit(1)).alias("items"), F.count_if(built).alias("built"))
    return themes.join(counts, F.col(theme) == F.col("_theme"), "left").select(theme, F.coalesce("items", F.lit(0)).alias("items"), F.coalesce("built", F.lit(0)).alias("built"))


def related(rows: DataFrame, key: str, order: str, item: str, mark: str = ",") -> DataFrame:
    """Per key its items by order, joined."""
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, item))), lambda x: x[item].cast("string")), mark).alias("related"))


def with_default(rows: DataFrame, key: str, overrides: DataFrame, built: DataFrame) -> DataFrame:
    """status: the override if there is one, else `built` or `idea`."""
    joined = rows.join(overrides.select(F.col("id").alias("_o"), F.col("status").alias("_status")), F.col(key) == F.col("_o"), "left")
    joined = joined.join(built.select(F.col("id").alias("_b")).distinct(), F.col(key) == F.col("_b"), "left")
    return joined.withColumn("status", F.coalesce("_status", F.when(F.col("_b").isNotNull(), "built").otherwise("idea"))).drop("_o", "_b", "_status")


def numbered(rows: DataFrame, group: str, order: list[str], name: str = "id") -> DataFrame:
    """Ids `group.n`, n counting within the group in order."""
    return rows.withColumn(name, F.concat_ws(".", F.col(group).cast("string"), F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("string")))


def by_position(rows: DataFrame, position: str, groups: DataFrame, group: str, size: str, order: str) -> DataFrame:
    """The first rows go to the first group, as many as its size, the next to the second; positions beyond all sizes raise.

    groups is a small list in code or configuration: its running bounds are a window over that list only.
    """
    stop = F.sum(size).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    bounds = groups.select(F.col(group).alias("_group"), (stop - F.col(size)).alias("_from"), stop.alias("_to"))
    joined = rows.join(bounds, (F.col(position) >= F.col("_from")) & (F.col(position) < F.col("_to")), "left")
    found = F.coalesce("_group", F.raise_error(F.lit("more rows than places")).cast("string"))
    return joined.withColumn(group, found).drop("_group", "_from", "_to")
