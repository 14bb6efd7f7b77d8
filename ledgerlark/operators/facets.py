"""Dashboards: facets, totals, leaderboards, lists per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import percent

ALL = "all"


def matching(facets: dict[str, str]) -> Column:
    """Rows that agree with every facet; the choice `all` lets any through."""
    return reduce(lambda a, b: a & b, [F.col(k) == v for k, v in facets.items() if v != ALL], F.lit(True))


def totals(rows: DataFrame, total: Column, missing: Column) -> DataFrame:
    """One row: total, missing and with_tag, zeros over no rows."""
    out = rows.agg(F.coalesce(F.sum(total), F.lit(0)).alias("total"), F.coalesce(F.sum(missing), F.lit(0)).alias("missing"))
    return out.withColumn("with_tag", F.col("total") - F.col("missing"))


def liveness(rows: DataFrame, facets: dict[str, str], measure: Column) -> DataFrame:
    """facet, value, live: whether choosing the value, with the other facets kept, leaves a row with a positive measure.

    One pass over all facets: each row is looked at once per facet and counted before the shuffle.
    """
    cases = [F.struct(F.lit(k).alias("facet"), F.col(k).alias("value"), (matching({o: v for o, v in facets.items() if o != k}) & (measure > 0)).alias("live")) for k in facets]
    return rows.select(F.explode(F.array(*cases)).alias("x")).groupBy("x.facet", "x.value").agg(F.bool_or("x.live").alias("live"))


def options(rows: DataFrame, columns: list[str]) -> DataFrame:
    """facet, value: distinct values of each column."""
    return rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select("x.*").distinct()


def leaderboard(rows: DataFrame, key: str, total: Column, missing: Column, k: int = 12, order: Column | None = None) -> DataFrame:
    """The k keys with the largest positive totals, and the missing share; ties by the key's first row in `order`, if given, then by key."""
    seen = F.min(order) if order is not None else F.lit(0)
    out = rows.groupBy(key).agg(F.sum(total).alias("total"), F.sum(missing).alias("missing"), seen.alias("_seen")).filter("total > 0")
    return out.withColumn("share", percent(F.col("missing"), F.col("total"))).orderBy(F.desc("total"), "_seen", key).limit(k).drop("_seen")


def largest_total(groups: DataFrame, total: str = "total") -> DataFrame:
    """One row: the largest total, 1 at least, and the first row's fallback of 0 over no rows."""
    return groups.agg(F.greatest(F.coalesce(F.max(total), F.lit(1)), F.lit(1)).alias("top"), F.coalesce(F.max(total), F.lit(0)).alias("largest"))


def by_group(rows: DataFrame, key: str, total: Column, lists: list[str], mark: str = "/", order: Column | None = None) -> DataFrame:
    """Per key: the total, and the distinct values of each listed column, in order, joined; `first_seen`, the key's first row, if order is given."""
    seen = [F.min(order).alias("first_seen")] if order is not None else []
    return rows.groupBy(key).agg(F.sum(total).alias("total"), *[F.array_join(F.array_sort(F.collect_set(c)), mark).alias(c) for c in lists], *seen)


def sections(cards: DataFrame, section: str, facets: dict[str, str]) -> DataFrame:
    """Per section the cards that the facets show, whether the section is hidden, and whether nothing at all is shown."""
    per = cards.groupBy(section).agg(F.count_if(matching(facets)).alias("shown"))
    empty = per.agg(F.coalesce(F.max("shown"), F.lit(0)).alias("_most"))  # one row
    return per.crossJoin(F.broadcast(empty)).select(section, "shown", (F.col("shown") == 0).alias("hidden"), (F.col("_most") == 0).alias("empty"))
