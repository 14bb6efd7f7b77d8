"""Coverage of periods: rows are counted by the period that their time falls in, with the empty ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PERIOD = "period int, start string, end string, house string, senate string"


def periods(spark: SparkSession, rows: list[tuple], as_of: str) -> DataFrame:
    """The period dimension; an end `present` is the day as_of."""
    return spark.createDataFrame(rows, PERIOD).withColumn("end", F.when(F.col("end") == "present", as_of).otherwise(F.col("end")))


def periods_from_json(raw: DataFrame, column: str, as_of: str) -> DataFrame:
    """The dimension from one JSON object: period -> {start, end, house, senate}."""
    kind = "map<string,struct<start:string,end:string,house:string,senate:string>>"
    rows = raw.select(F.explode(F.from_json(column, kind)).alias("period", "v"))
    return rows.select(F.col("period").cast("int").alias("period"), "v.start", F.when(F.col("v.end") == "present", as_of).otherwise(F.col("v.end")).alias("end"), "v.house", "v.senate")


def in_period(rows: DataFrame, dimension: DataFrame, at: Column) -> DataFrame:
    """Rows with each period whose closed range has their time, compared as text: a time on a shared bound is in both.

    The dimension has a row per legislative period, a few dozen; Spark broadcasts it by its size, and
    the range is then a filter over one pass of the rows.
    """
    return rows.join(dimension, (at >= F.col("start")) & (at <= F.col("end")))


def coverage(rows: DataFrame, dimension: DataFrame, keys: list[str], at: Column, tagged: Column, chamber: str = "house") -> DataFrame:
    """keys x periods: total, missing (not tagged) and the party in control; empty periods have zeros.

    Rows are counted before anything is shuffled; the skeleton of keys and periods meets only counts.
    """
    counts = in_period(rows.withColumn("_at", at).withColumn("_tag", tagged), dimension.select("period", "start", "end"), F.col("_at"))
    counts = counts.groupBy(*keys, "period").agg(F.count(F.lit(1)).alias("n"), F.count_if("_tag").alias("with_tag"))
    skeleton = rows.select(*keys).distinct().crossJoin(dimension)
    joined = skeleton.join(counts, [*keys, "period"], "left")
    total, tags = F.coalesce("n", F.lit(0)), F.coalesce("with_tag", F.lit(0))
    control = F.when(F.lit(chamber) == "senate", F.col("senate")).otherwise(F.col("house"))
    return joined.select(*keys, "period", total.alias("total"), (total - tags).alias("missing"), control.alias("control"), F.lit(chamber).alias("chamber"))


def reconcile(rows: DataFrame, dimension: DataFrame, keys: list[str], at: Column) -> DataFrame:
    """Per key: all rows, rows over the periods, and rows in none; a row in two periods counts twice."""
    hits = F.aggregate(F.col("_periods"), F.lit(0), lambda n, p: n + F.when((F.col("_at") >= p["start"]) & (F.col("_at") <= p["end"]), 1).otherwise(0))
    bounds = dimension.agg(F.collect_list(F.struct("start", "end")).alias("_periods"))  # one row, of the dimension's size
    with_hits = rows.withColumn("_at", at).crossJoin(F.broadcast(bounds)).withColumn("_hits", hits)
    return with_hits.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.sum("_hits").cast("long").alias("in_periods"), F.count_if(F.col("_hits") == 0).alias("unassigned"))


def check_reconciled(reconciled: DataFrame) -> DataFrame:
    """Strict mode: raises, when it runs, on keys whose counts differ."""
    ok = F.col("total") == F.col("in_periods")
    return reconciled.withColumn("total", F.when(ok, F.col("total")).otherwise(F.raise_error(F.lit("rows outside the periods")).cast("long")))
