"""Monthly series: grids, spines, resampling, year-over-year change, alignment and blends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import MONTHS, month_number, month_start, round4


def unpivot_grid(grid: DataFrame, value: str = "level") -> DataFrame:
    """year x months to (year, month, date, value), cells without a value too."""
    long = grid.unpivot(["year"], [c for c in MONTHS if c in grid.columns], "month", value)
    return long.select("year", "month", F.make_date("year", month_number(F.col("month")), F.lit(1)).alias("date"), value)


def pivot_grid(rows: DataFrame, year: str, month: str, value: str, check: bool = True, complete: bool = False) -> DataFrame:
    """(year, month name, value) to a grid in the months' order; other names are dropped, two values of a cell raise.

    A month that no year has is a column of nulls, or raises KeyError where the grid must be `complete`.
    """
    if complete:
        have = {r[0] for r in rows.select(month).filter(F.col(month).isin(*MONTHS)).distinct().collect()}  # twelve names at most
        if missing := [m for m in MONTHS if m not in have]:
            raise KeyError(f"no values of {missing}")
    one = F.first(value)
    if check:
        one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two values of one month")).cast("double")).otherwise(one)
    return rows.filter(F.col(month).isin(*MONTHS)).groupBy(F.col(year).alias("year")).pivot(month, list(MONTHS)).agg(one)


def keep_last(parts: list[DataFrame], keys: list[str], order: str | None = None) -> DataFrame:
    """Whole rows of the last part that has a key; a row replaced loses all its cells.

    Of rows that repeat a key inside a part the last by `order` counts; without it the largest row does.
    """
    others = [c for c in parts[0].columns if c not in keys]
    place = lambda i: F.struct(F.lit(i).alias("part"), (F.col(order) if order else F.lit(0)).alias("at"), F.struct(*others).alias("row"))
    tagged = [p.select(*keys, F.struct(place(i).alias("_at"), F.struct(*others).alias("_row")).alias("_last")) for i, p in enumerate(parts)]
    last = reduce(DataFrame.unionByName, tagged).groupBy(*keys).agg(F.max_by("_last._row", "_last._at").alias("_row"))
    return last.select(*keys, "_row.*").select(*parts[0].columns)


def resample_last(rows: DataFrame, at: Column, value: str, tie: str, bucket: Column | None = None, name: str = "date") -> DataFrame:
    """The last non-null value of each month (or bucket); rows of one time go by the tie column."""
    some = rows.filter(F.col(value).isNotNull())
    return some.groupBy((month_start(at) if bucket is None else bucket).alias(name)).agg(F.max_by(value, F.struct(at, F.col(tie))).alias(value))


def spine(series: DataFrame, date: str = "date") -> DataFrame:
    """The series with every month between its first and last; those missing have nulls."""
    ends = series.agg(F.min(date).alias("lo"), F.max(date).alias("hi")).filter("lo is not null")
    return ends.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias(date)).join(series, date, "left")


def year_over_year(series: DataFrame, value: str, out: str = "yoy", date: str = "date") -> DataFrame:
    """Change in per cent against twelve months before, for months that have both; four places."""
    before = series.select(F.add_months(date, 12).alias(date), F.col(value).alias("_before"))
    change = (F.try_divide(F.col(value), F.col("_before")) - 1.0) * 100.0
    return series.join(before, date).select(date, round4(change).alias(out)).filter(F.col(out).isNotNull())


def align(series: dict[str, DataFrame], canonical: list[str], date: str = "date") -> DataFrame:
    """All series by month in one table, canonical columns first; one shuffle, whatever their number."""
    long = reduce(DataFrame.unionByName, [s.select(date, F.lit(k).alias("_of"), F.col(k).alias("_value")) for k, s in series.items()])
    columns = [c for c in canonical if c in series] + [c for c in series if c not in canonical]
    twice = F.count("_value") > 1
    one = F.when(twice, F.raise_error(F.lit("two values of one month")).cast("double")).otherwise(F.first("_value"))
    return long.groupBy(date).pivot("_of", columns).agg(one)


def parse_weights(raw: str | None) -> dict[str, float]:
    """`a=2,b=0.5`; empty parts are skipped, a part without a number raises."""
    out = {}
    for pair in filter(str.strip, (raw or "").split(",")):
        name, mark, number = pair.partition("=")
        if not mark:
            raise ValueError(f"no weight in {pair!r}")
        out[name.strip()] = float(number)
    return out


def blend(columns: list[str], weights: dict[str, float] | None = None) -> Column:
    """Mean of the columns that are not null by weight, 1 unless given; null where their weights add up to 0."""
    w = {c: float((weights or {}).get(c, 1.0)) for c in columns}
    part = reduce(lambda a, b: a + b, [F.coalesce(F.col(c) * w[c], F.lit(0.0)) for c in columns])
    whole = reduce(lambda a, b: a + b, [F.when(F.col(c).isNotNull(), w[c]).otherwise(0.0) for c in columns])
    return round4(F.try_divide(part, F.nullif(whole, F.lit(0.0))))
