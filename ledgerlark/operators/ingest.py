"""What a store takes in: insert-if-absent, upsert, prefix reads, pages."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def absent(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose key the store has not, one a key: the first by all columns."""
    fresh = new.join(stored.select(*keys).distinct(), keys, "left_anti")
    others = [c for c in new.columns if c not in keys]
    return fresh.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row")).select(*keys, "_row.*").select(*new.columns) if others else fresh.distinct()


def insert_if_absent(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    return stored.unionByName(absent(new, stored, keys))


def upsert(new: DataFrame, stored: DataFrame, keys: list[str], update: bool) -> DataFrame:
    """The store with the new rows, one a key; a key that it has is overwritten only if update."""
    if not update:
        return insert_if_absent(new, stored, keys)
    return insert_if_absent(stored, absent(new, new.limit(0), keys), keys).select(*stored.columns)


def until_seen(rows: DataFrame, key: list[str], position: str, known: str) -> DataFrame:
    """Per key, the rows before the first known one by position: all, where none is known."""
    first = rows.groupBy(*key).agg(F.min(F.when(F.col(known), F.col(position))).alias("_stop"))
    return rows.join(first, key).filter(F.col("_stop").isNull() | (F.col(position) < F.col("_stop"))).drop("_stop")


def fresh(rows: DataFrame, stored: DataFrame, key: str, scan: list[str], position: str, stop_at_seen: bool = False) -> DataFrame:
    """Rows of scans, newest first by position, whose key the store has not.

    With stop_at_seen a scan ends at its first known row, so an older row behind it is never taken;
    without it older rows that were missed come too.
    """
    known = stored.select(key).distinct().withColumn("_seen", F.lit(True))
    marked = rows.join(known, key, "left").withColumn("_seen", F.coalesce("_seen", F.lit(False)))
    taken = until_seen(marked, scan, position, "_seen") if stop_at_seen else marked.filter(~F.col("_seen"))
    return taken.select(*rows.columns)


def tally(scans: DataFrame, scan: str, position: str, size: str, total: str, limit: int) -> DataFrame:
    """Pages with the rows `retrieved` so far in their scan, and the `remaining` pages of `limit` rows as the scan's log counts them."""
    so_far = F.sum(size).over(Window.partitionBy(scan).orderBy(position))
    return scans.withColumn("retrieved", so_far).withColumn("remaining", F.floor((F.col(total) - F.col("retrieved")) / limit) + 1)


def pages(parts: list[DataFrame]) -> DataFrame:
    """All rows of all pages."""
    return reduce(DataFrame.unionByName, parts)


def last_by_id(rows: DataFrame, key: str, position: str) -> DataFrame:
    """One row a key, the last by position."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), position).alias("_row")).select(key, "_row.*")


def read_through(wanted: DataFrame, cache: DataFrame, key: str, fetch: Callable[[DataFrame], DataFrame], force: bool = False) -> DataFrame:
    """The cache with what it lacks of the wanted keys, which fetch gets and gives rows for.

    A wanted key with several cached rows raises ValueError; with force the cache is emptied then,
    and all wanted keys are fetched.
    """
    twice = cache.join(wanted.select(key).distinct(), key, "left_semi").groupBy(key).count().filter("count > 1")
    if not twice.isEmpty():
        if not force:
            raise ValueError(f"several cached rows of one {key}")
        cache = cache.limit(0)
    missing = wanted.select(key).distinct().join(cache.select(key).distinct(), key, "left_anti")
    return cache.unionByName(fetch(missing))


def details(wanted: DataFrame, stored: DataFrame, key: str, fetch: Callable[[DataFrame], DataFrame], force_fetch: bool = False) -> DataFrame:
    """The store after its wanted keys were read through: only absent ones are fetched, or all with force_fetch, which overwrites them."""
    keys = wanted.select(key).distinct()
    missing = keys if force_fetch else keys.join(stored.select(key).distinct(), key, "left_anti")
    return upsert(fetch(missing), stored, [key], force_fetch)


def answered(responses: DataFrame, key: str, order: str) -> DataFrame:
    """(key, body) of landed point lookups, rows (key, order, attempt, status, body), attempts from 1.

    An answer of 500 is taken from its second attempt, in the other format. An answer of 429 ends the
    scan: lookups from there on give nothing. Any other answer from 400 on raises when it runs.
    """
    stop = responses.agg(F.min(F.when(F.col("status") == 429, F.col(order))).alias("_stop"))  # one row
    rows = responses.crossJoin(F.broadcast(stop)).filter(F.col("_stop").isNull() | (F.col(order) < F.col("_stop")))
    last = rows.groupBy(key).agg(F.max_by(F.struct("attempt", "status", "body"), F.when((F.col("attempt") == 1) | (F.col("attempt") == 2), F.col("attempt"))).alias("_a"), F.min_by("status", "attempt").alias("_first"))
    bad = (F.col("_a.status") >= 400) | ((F.col("_a.attempt") == 2) & (F.col("_first") != 500))
    body = F.when(bad, F.raise_error(F.concat(F.lit("lookup failed: "), F.col("_a.status").cast("string"))).cast("string")).otherwise(F.col("_a.body"))
    return last.select(key, body.alias("body"))


def looked_up(rows: DataFrame, key: str, table: DataFrame, table_key: str) -> DataFrame:
    """Rows with the table's row of their key; a key that the table lacks raises when it runs."""
    marked = table.withColumn("_here", F.lit(True))
    joined = rows.join(marked, F.col(key) == F.col(table_key), "left")
    found = F.when(F.col("_here").isNull(), F.raise_error(F.concat(F.lit("no entry for "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast(rows.schema[key].dataType)).otherwise(F.col(key))
    return joined.withColumn(key, found).drop("_here", *([table_key] if table_key != key else []))
