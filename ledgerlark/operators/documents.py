"""Nested documents of the services: extracts, unwrapping, renaming, checks of rows, selection by name or place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import zulu, zulu_text

THUMB = "title:string,description:string,publishedAt:string"
CHANNEL = f"id string, snippet struct<{THUMB},customUrl:string>, contentDetails struct<relatedPlaylists:struct<likes:string,uploads:string>>"
VIDEO = f"snippet struct<{THUMB},resourceId:struct<videoId:string>>"
#: The fields of a committee's details as the service names them.
DETAILS = ("bills", "communications", "reports", "history", "isCurrent", "parent", "subcommittees", "systemCode", "type", "updateDate")


def channels(rows: DataFrame) -> DataFrame:
    """title, description, publishedAt, customUrl and uploads of channels as the service gives them."""
    return rows.select("snippet.title", "snippet.description", "snippet.publishedAt", "snippet.customUrl", "contentDetails.relatedPlaylists.uploads")


def videos(rows: DataFrame) -> DataFrame:
    """title, description, publishedAt and videoId of playlist items as the service gives them."""
    return rows.select("snippet.title", "snippet.description", "snippet.publishedAt", "snippet.resourceId.videoId")


def meeting(raw: Column, schema: str) -> Column:
    """The committee meeting in an event's JSON, under `api-root` or not; an event without one raises when it runs."""
    inner = f"committeeMeeting:struct<{schema}>"
    both = F.from_json(raw, f"struct<`api-root`:struct<{inner}>,{inner}>")
    found = F.when(both["api-root"].isNotNull(), both["api-root"]["committeeMeeting"]).otherwise(both["committeeMeeting"])
    return F.when(found.isNull(), F.raise_error(F.lit("no committeeMeeting")).cast(f"struct<{schema}>")).otherwise(found)


def from_service(rows: DataFrame) -> DataFrame:
    """Details with `ctype` for `type` and updateDate as a time, the least one for none; a field that details do not have raises TypeError."""
    if unknown := [c for c in rows.columns if c not in (*DETAILS, "ctype")]:
        raise TypeError(f"unknown fields: {unknown}")
    if "type" in rows.columns and "ctype" not in rows.columns:
        rows = rows.withColumnRenamed("type", "ctype")
    if "updateDate" in rows.columns:
        rows = rows.withColumn("updateDate", F.coalesce(zulu(F.col("updateDate")), F.lit("0001-01-01").cast("timestamp")))
    return rows


def to_service(rows: DataFrame) -> DataFrame:
    """The details as the service names them."""
    return rows.withColumn("updateDate", zulu_text(F.col("updateDate"))).withColumnRenamed("ctype", "type")


def is_url(c: Column) -> Column:
    return F.coalesce(F.try_parse_url(c, F.lit("PROTOCOL")).isNotNull() & (F.coalesce(F.try_parse_url(c, F.lit("HOST")), F.lit("")) != ""), F.lit(False))


def one_of(*values: str):
    return lambda c: F.coalesce(c.cast("string").isin(*values), F.lit(False))


def is_int(c: Column) -> Column:
    return F.coalesce((c.cast("double") == F.floor(c.cast("double"))), F.lit(False))


def given(c: Column) -> Column:
    return c.isNotNull()


def optional(rule):
    """Null passes, any other value must pass the rule."""
    return lambda c: c.isNull() | rule(c)


def violations(rows: DataFrame, key: str, rules: dict) -> DataFrame:
    """(key, field) of every field that breaks its rule, a function from column to boolean column."""
    broken = F.array(*[F.when(~rule(F.col(f)), F.lit(f)) for f, rule in rules.items()])
    return rows.select(key, F.explode(F.filter(broken, lambda x: x.isNotNull())).alias("field"))


def require(rows: DataFrame, key: str, rules: dict) -> DataFrame:
    """The rows; one that breaks a rule raises when it runs."""
    ok = reduce(lambda a, b: a & b, [rule(F.col(f)) for f, rule in rules.items()])
    return rows.withColumn(key, F.when(ok, F.col(key)).otherwise(F.raise_error(F.concat(F.lit("bad row: "), F.col(key).cast("string"))).cast(rows.schema[key].dataType)))


def selected(rows: DataFrame, name: str | None = None, index: int | None = None) -> DataFrame:
    """The rows (name, position, ...) of one name or of one position, not both; all where neither is given.

    An unknown name raises IndexError, a position out of range ValueError.
    """
    if name is not None and index is not None:
        raise ValueError("a name or an index, not both")
    if name is not None:
        found = rows.filter(F.col("name") == name).agg(F.min("position")).first()[0]
        if found is None:
            raise IndexError(f"no such name: {name}")
        index = found
    elif index is not None:
        count = rows.agg(F.coalesce(F.max("position"), F.lit(-1))).first()[0] + 1
        if not 0 <= index < count:
            raise ValueError(f"index {index} is out of range (0-{count - 1})")
    return rows if index is None else rows.filter(F.col("position") == index)
