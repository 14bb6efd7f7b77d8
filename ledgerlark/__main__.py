"""Command lines: thin jobs over the operators. `python -m ledgerlark <job> --help`."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark import sources
from ledgerlark.functions import has_event_id
from ledgerlark.operators import documents, ingest, periods, timeseries
from ledgerlark.session import session, shared_folder

VIDEO = "videoId string, title string, description string, publishedAt string"


def coverage(spark: SparkSession, args: argparse.Namespace) -> None:
    """Report of videos without an event id, per handle and period."""
    accounts = sources.handles_of(documents.selected(sources.read_accounts(spark, args.accounts), args.name, args.index))
    raw = spark.read.text(args.periods, wholetext=True)
    dimension = periods.periods_from_json(raw, "value", args.as_of)
    rows = spark.read.schema(f"handle string, {VIDEO}").parquet(args.videos).join(F.broadcast(accounts.select("handle", "name")), "handle")  # a row per handle, a few dozen
    out = periods.coverage(rows, dimension, ["name", "handle"], F.col("publishedAt"), has_event_id(F.col("description"), F.col("title")), args.chamber)
    if args.strict:
        periods.check_reconciled(periods.reconcile(rows, dimension, ["name", "handle"], F.col("publishedAt"))).collect()  # a row per handle
    sources.write_csv(out.orderBy("name", "handle", "period"), args.output)


def fetch(spark: SparkSession, args: argparse.Namespace) -> None:
    """Landed pages of playlist items into the store of videos."""
    new = documents.videos(spark.read.schema(documents.VIDEO).json(args.landed)).select("videoId", "title", "description", "publishedAt")
    if not args.force:
        new = ingest.absent(new, sources.stored(spark, VIDEO, args.store), ["videoId"])
    sources.store(new, args.store, args.force)


def events(spark: SparkSession, args: argparse.Namespace) -> None:
    """Events per committee from a cached map of events."""
    sources.check_chamber(args.chamber, args.congress_number)
    raw = sources.read_map(spark, args.events, "eventId")
    found = raw.select("eventId", documents.meeting(F.col("raw"), "committees:string")["committees"].alias("raw"))
    rows = found.select("eventId", F.explode(sources.committees_of(F.col("raw"))).alias("c")).select("eventId", F.col("c.systemCode").alias("code"))
    codes = sources.read_accounts(spark, args.accounts).select(F.col("code").alias("known"), "name")
    out = ingest.looked_up(rows, "code", codes, "known").groupBy("code", "name").agg(F.count(F.lit(1)).alias("events"))
    sources.write_csv(out.orderBy("code"), args.output)


def inflation(spark: SparkSession, args: argparse.Namespace) -> None:
    """Series of all sources by month, with their weighted mean."""

    def manual(key: str, path: str) -> sources.Source:
        return sources.Source(key, (key,), lambda s: sources.manual_series(s, path, key))

    pairs = [x.partition("=")[::2] for x in args.series]
    series, status = sources.gather(spark, [manual(k, p) for k, p in pairs])
    status.show(truncate=False)
    if not series:
        sys.exit("no source has data")
    wide = timeseries.align(series, [k for k, _ in pairs])
    weights = timeseries.parse_weights(args.weights)
    sources.write_csv(wide.withColumn("aggregate", timeseries.blend([k for k, _ in pairs if k in series], weights)).orderBy("date"), args.output)


def grid(spark: SparkSession, args: argparse.Namespace) -> None:
    """The yearly grid with the years of a landed answer put in, written in place."""
    schema = "year int, " + ", ".join(f"{m} double" for m in timeseries.MONTHS)
    old = sources.read_csv(spark, args.grid, schema)
    new = timeseries.pivot_grid(sources.read_series(spark, args.landed), "year", "month", "value", complete=True)
    merged: DataFrame = timeseries.keep_last([old, new], ["year"]).orderBy("year")
    sources.replace(merged, args.grid, lambda df, at: sources.write_csv(df.coalesce(1), at))


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="ledgerlark", description=__doc__)
    jobs = out.add_subparsers(dest="job", required=True)

    def job(f, *paths: str):
        one = jobs.add_parser(f.__name__, description=f.__doc__)
        for p in paths:
            one.add_argument(f"--{p}", required=True)
        one.set_defaults(run=f)
        return one

    one = job(coverage, "accounts", "periods", "videos", "output", "as-of")
    either = one.add_mutually_exclusive_group()
    either.add_argument("-n", "--name")
    either.add_argument("-i", "--index", type=int)
    one.add_argument("--chamber", choices=sources.CHAMBERS, default="house")
    one.add_argument("--strict", action="store_true")
    job(fetch, "landed", "store").add_argument("--force", action="store_true")
    one = job(events, "events", "accounts", "output")
    one.add_argument("--chamber", choices=sources.CHAMBERS, default="house")
    one.add_argument("--congress-number", type=int, choices=range(100, 120), default=119)
    one = job(inflation, "output")
    one.add_argument("--series", nargs="+", default=[], metavar="NAME=CSV")
    one.add_argument("--weights", default="")
    job(grid, "grid", "landed")
    return out


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    given = parser().parse_args(args)
    spark = spark or session()
    shared_folder(spark)
    given.run(spark, given)


if __name__ == "__main__":
    main()
