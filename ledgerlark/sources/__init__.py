"""Readers and writers of landed files, and the protocol of series sources."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from pathlib import Path

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlark.functions import BLANK, number_or_zero, to_number
from ledgerlark.operators.timeseries import resample_last
from ledgerlark.session import exists, move, remove, shared_folder

CHAMBERS = ("house", "senate", "nochamber")
EXT = "array<struct<systemCode:string>>"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and an explicit schema; quotes are doubled inside quotes, lines may end within them."""
    return spark.read.csv(path, schema=schema, header=True, quote='"', escape='"', multiLine=True, mode="DROPMALFORMED", enforceSchema=True)


def read_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed API pages, one JSON object a file: the rows of all its lists, and the `list` that each was in.

    A page's keys but `pagination` and `request` must be lists, any other raises when it runs; a page
    without `pagination` is not one of several and gives nothing.
    """
    pages = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>", {"mode": "FAILFAST"}).alias("page"))
    keys = pages.filter(F.map_contains_key("page", F.lit("pagination"))).select(F.explode("page").alias("list", "raw")).filter(~F.col("list").isin("pagination", "request"))
    raw = F.when(F.trim("raw").startswith("["), F.col("raw")).otherwise(F.raise_error(F.concat(F.lit("no list: "), F.col("list"))).cast("string"))
    return keys.select("list", F.explode(F.from_json(raw, f"array<struct<{schema}>>")).alias("x")).select("list", "x.*")


COMMITTEE = "chamber:string,committeeTypeCode:string,name:string,systemCode:string,url:string,updateDate:string,parent:struct<name:string,systemCode:string,url:string>"
MEETING = "eventId:string,chamber:string,congress:int,updateDate:string,url:string"


def read_committees(spark: SparkSession, root: str, chamber: str) -> DataFrame:
    """The committees of a chamber from the pages landed under committee/<chamber>."""
    if chamber not in ("house", "senate"):
        raise ValueError(f"no such chamber: {chamber}")
    return read_pages(spark, f"{root}/committee/{chamber}", COMMITTEE).drop("list")


def read_meetings(spark: SparkSession, root: str, congress: int, chamber: str) -> DataFrame:
    """The meetings of a congress and chamber from the pages landed under committee-meeting/<congress>/<chamber>."""
    check_chamber(chamber, congress)
    return read_pages(spark, f"{root}/committee-meeting/{congress}/{chamber}", MEETING).drop("list")


def read_json(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """JSON objects, one a file, read side by side."""
    return spark.read.schema(schema).json(paths, multiLine=True, mode="FAILFAST")


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """(year, month, value) of a landed answer of the series service: the first series' data, without values that are no number."""
    point = "array<struct<year:string,periodName:string,value:string>>"
    rows = spark.read.schema(f"Results struct<series:array<struct<data:{point}>>>").json(path, multiLine=True, mode="FAILFAST")
    rows = rows.select(F.explode(F.col("Results.series")[0]["data"]).alias("x"))
    return rows.select(F.col("x.year").cast("int").alias("year"), F.col("x.periodName").alias("month"), to_number(F.col("x.value")).alias("value")).filter("value is not null")


def read_map(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A cached JSON object as rows: each key with its value as JSON text."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})).alias(key, "raw"))


def read_store(spark: SparkSession, folder: str, index: int, table: str, schema: str, assert_exists: bool = False) -> DataFrame:
    """A table of a committee's document store, a file `youtube_<index>.json` of tables of numbered documents.

    A store that is not there has no rows, or raises ValueError with assert_exists.
    """
    try:
        rows = spark.read.text(f"{folder}/youtube_{index:02d}.json", wholetext=True)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        if assert_exists:
            raise ValueError(f"no store for index {index} in {folder}") from fault
        return spark.createDataFrame([], schema)
    rows = rows.select(F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})[table].alias("t"))
    return rows.select(F.explode(F.from_json("t", f"map<string,struct<{schema}>>")).alias("_", "x")).select("x.*")


def stored(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """The Parquet rows of a store, none while it is not there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def store(df: DataFrame, path: str, force: bool = False) -> None:
    """Append the rows to a Parquet store; with force, the store is emptied before."""
    df.write.mode("overwrite" if force else "append").parquet(path)


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """(code, position, name, handles) of the accounts' CSV; of rows that repeat a code the last counts, at the first one's position."""
    rows = read_csv(spark, path, "committee string, systemCode string, handle string, secondary string").withColumn("_line", F.monotonically_increasing_id())
    cell = lambda c: F.coalesce(F.col(c), F.lit(""))
    handles = F.concat(F.array(cell("handle")), F.when(cell("secondary") != " ", F.array(cell("secondary"))).otherwise(F.array().cast("array<string>")))
    last = rows.groupBy(F.col("systemCode").alias("code")).agg(F.max_by(F.struct("committee", handles.alias("handles")), "_line").alias("_row"), F.min("_line").alias("_first"))
    # a row per committee, a few dozen
    return last.select("code", (F.row_number().over(Window.orderBy("_first")) - 1).alias("position"), F.col("_row.committee").alias("name"), F.col("_row.handles").alias("handles"))


def handles_of(accounts: DataFrame) -> DataFrame:
    """(code, position, name, place, handle) of each handle that is not empty."""
    return accounts.select("code", "position", "name", F.posexplode("handles").alias("place", "handle")).filter("handle <> ''")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The coverage report as the dashboard takes it: numbers with 0 for empty cells, no rows without committee or congress."""
    raw = read_csv(spark, path, "committee_name string, handle string, total_videos string, missing_event_id string, congress_number string, control string, chamber string")
    text = [F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in (("committee_name", "committee"), ("handle", "handle"), ("control", "control"), ("chamber", "chamber"))]
    numbers = [number_or_zero(F.col(c)).alias(n) for c, n in (("total_videos", "total"), ("missing_event_id", "missing"), ("congress_number", "congress"))]
    return raw.select(*text, *numbers).filter("committee <> '' and congress is not null")


def report_state(spark: SparkSession, path: str) -> tuple[str, DataFrame | None]:
    """`ready` with the report, or `error` where its file is not there."""
    try:
        return "ready", read_report(spark, path)
    except AnalysisException:
        return "error", None


def credential(given: str | None, variable: str, file: str) -> str:
    """A key that was given, else that of the environment variable, else that of a file in the home folder."""
    at = Path.home() / file
    key = given or os.environ.get(variable) or (at.read_text().strip() if at.exists() else "")
    if not key:
        raise ValueError(f"no key: give one, or set {variable}, or write {at}")
    return key


def normalised(raw: Column, schema: str) -> Column:
    """A struct from JSON text, or from XML where that is no JSON: leaves trimmed, blank ones null, repeated tags lists, attributes only if the schema has them."""
    return F.when(F.try_parse_json(raw).isNotNull(), F.from_json(raw, schema)).otherwise(F.from_xml(raw, schema))


def api_document(raw: Column, schema: str) -> Column:
    """As normalised; text that is no JSON must be XML under `api-root`, any other raises when it runs."""
    root = F.regexp_like(raw, F.lit(r"\A\s*(<\?xml[^>]*>\s*)?<api-root[\s>/]"))
    xml = F.when(root, raw).otherwise(F.raise_error(F.lit("neither JSON nor XML with api-root")).cast("string"))
    return F.when(F.try_parse_json(raw).isNotNull(), F.from_json(raw, schema)).when(raw.isNotNull(), F.from_xml(xml, schema))


def committees_of(raw: Column) -> Column:
    """The list of committees, whether raw is a JSON list or an object with `item`."""
    return F.coalesce(F.when(F.trim(raw).startswith("["), F.from_json(raw, EXT)), F.from_json(raw, f"item {EXT}")["item"], F.array().cast(EXT))


def read_markdown(spark: SparkSession, glob: str) -> DataFrame:
    """id (file name without .md), front matter as a map, body."""
    rows = spark.read.text(glob, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.md$", 1).alias("id"), "value")
    head = F.regexp_extract("value", r"(?s)\A---\n(.*?)\n---", 1)
    fields = F.transform(F.filter(F.split(head, "\n"), lambda x: F.instr(x, ":") > 0), lambda x: F.struct(F.trim(F.split_part(x, F.lit(":"), F.lit(1))), F.regexp_replace(F.trim(F.regexp_extract(x, r"^[^:]*:(.*)$", 1)), r'^"(.*)"$', "$1")))
    return rows.select("id", F.map_from_entries(fields).alias("fields"), F.regexp_replace("value", r"(?s)\A---\n.*?\n---\n?", "").alias("body"))


def write_csv(df: DataFrame, path: str) -> bool:
    """The rows as CSV with a header, nulls empty; nothing is written, and False returned, where there are none."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue="", quote='"', escape='"')
    return True


def write_markdown(df: DataFrame, path: str) -> None:
    """One file `<id>.md` per id, white space at its end made one newline.

    Executors write the files, under a folder that all of them reach.
    """

    def put(rows) -> None:
        from ledgerlark.session import _files

        files, at = _files(path)
        files.create_dir(at, recursive=True)
        for r in rows:
            if "/" in r["id"] or r["id"] in ("", ".", ".."):
                raise ValueError(f"no file name: {r['id']!r}")
            with files.open_output_stream(f"{at}/{r['id']}.md") as out:
                out.write((r["value"] + "\n").encode())

    df.select("id", F.rtrim(F.col("body"), F.lit(BLANK)).alias("value")).foreachPartition(put)


def replace(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> None:
    """Put df where path is, also if df reads path: it is written beside it and takes its place when whole."""
    beside, old = (f"{path.rstrip('/')}.{kind}-{uuid.uuid4()}" for kind in ("new", "old"))
    write(df, beside)
    if exists(path):
        move(path, old)
    move(beside, path)
    remove(old)


def write_series(df: DataFrame, path: str) -> bool:
    """Monthly series as one CSV by date, dates as the month's first day, nulls empty."""
    return write_csv(df.withColumn("date", F.date_format("date", "yyyy-MM-01")).coalesce(1).sortWithinPartitions("date"), path)


class SourceUnavailable(Exception):
    """A series source that can give nothing now; the others go on."""


@dataclass(frozen=True)
class Source:
    """A named source: its columns, and a function that gives a DataFrame (date, columns)."""

    key: str
    columns: tuple[str, ...]
    fetch: Callable[[SparkSession], DataFrame]


def gather(spark: SparkSession, sources: Iterable[Source]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Series by column, and the status of each source: OK, SKIP or ERROR, months and the latest one.

    A source that is away or whose data are wrong does not stop the others; a fault of Spark itself,
    such as a lost executor, does. Each source runs once; its monthly rows are kept in the shared folder.
    """
    series: dict[str, DataFrame] = {}
    status = []
    for source in sources:
        try:
            shared_folder(spark)
            df = source.fetch(spark).checkpoint()  # runs it here, inside the guard
            months, latest = df.agg(F.count(F.lit(1)), F.max("date").cast("string")).first()
            if not months:
                raise SourceUnavailable("no rows")
            series |= {c: df.select("date", c).filter(F.col(c).isNotNull()) for c in source.columns}
            status.append((source.key, "OK", months, latest))
        except SourceUnavailable:
            status.append((source.key, "SKIP", 0, None))
        except (ValueError, LookupError, TypeError, ArithmeticError, OSError):
            status.append((source.key, "ERROR", 0, None))
        except PySparkException as fault:
            if not (isinstance(fault, AnalysisException) or (fault.getSqlState() or "").startswith("22")):
                raise
            status.append((source.key, "ERROR", 0, None))
    return series, spark.createDataFrame(status, "source string, status string, months long, latest string")


def manual_series(spark: SparkSession, path: str, column: str) -> DataFrame:
    """A dropped CSV: the date is `date` or the first column, the value `yoy`, `yoy_pct`, `value`, the series' name or the second; the last value of a month."""
    raw = spark.read.csv(path, header=True, inferSchema=False)
    names = {c.strip().lower(): c for c in raw.columns}
    date = names.get("date", raw.columns[0])
    value = next((names[c] for c in ("yoy", "yoy_pct", "value", column.lower()) if c in names), raw.columns[min(1, len(raw.columns) - 1)])
    rows = raw.select(F.to_date(F.trim(F.col(f"`{date}`"))).alias("at"), to_number(F.col(f"`{value}`")).alias(column), F.monotonically_increasing_id().alias("line"))
    return resample_last(rows, F.col("at"), column, "line")


def by_place(spark: SparkSession, path: str, column: str) -> DataFrame:
    """A CSV whose first column is the date and second the value, whatever their names."""
    raw = spark.read.csv(path, header=True, inferSchema=False)
    rows = raw.toDF("at", "v", *raw.columns[2:]).select(F.to_date("at").alias("at"), to_number(F.col("v")).alias(column), F.monotonically_increasing_id().alias("line"))
    return resample_last(rows, F.col("at"), column, "line")


def check_chamber(chamber: str, congress: int | None = None) -> None:
    if chamber not in CHAMBERS or (congress is not None and not 100 <= congress < 120):
        raise ValueError(f"no such chamber or congress: {chamber} {congress}")
