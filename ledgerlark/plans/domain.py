"""Queries over landed files and nested documents, made from the star schema's rows, and the same in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark import functions as fn
from ledgerlark import sources
from ledgerlark.operators import documents, facets, hierarchy, ingest, periods, timeseries
from ledgerlark.plans.catalogue import _LEVELS, _levels, _scratch, query, table


def _landed(spark: SparkSession, rows: DataFrame, column: str = "value") -> str:
    """A folder with the rows' text, a row a file."""
    at = f"{_scratch(spark)}/{uuid.uuid4()}"
    rows.select(column).repartition(max(1, rows.count())).write.text(at)
    return at


def _one_file(spark: SparkSession, rows: DataFrame, order: str) -> str:
    at = f"{_scratch(spark)}/{uuid.uuid4()}"
    sources.write_csv(rows.coalesce(1).sortWithinPartitions(order).drop(order), at)
    return at


def _text(c: str):
    return F.col(c).cast("string")


# accounts


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(
        F.concat(F.col("s_name"), F.lit(", the 'first'")).alias("committee"), F.concat(F.lit("s"), (key % 7).cast("string")).alias("systemCode"),
        F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("@"), _text("s_suppkey"))).alias("handle"), F.when(key % 3 == 0, F.concat(F.lit("@b"), _text("s_suppkey"))).otherwise("").alias("secondary"), "s_suppkey",
    )
    return sources.read_accounts(spark, _one_file(spark, rows, "s_suppkey"))


_ACCOUNTS = """a AS (SELECT 's' || (s_suppkey % 7) AS code, max(s_suppkey) AS k, min(s_suppkey) AS first_ FROM supplier GROUP BY 1),
c AS (SELECT a.code, cast(row_number() OVER (ORDER BY a.first_) - 1 AS INT) AS position, s.s_name || ', the ''first''' AS name, CASE WHEN a.k % 5 = 0 THEN '' ELSE '@' || a.k END AS handle, CASE WHEN a.k % 3 = 0 THEN '@b' || a.k ELSE '' END AS secondary FROM a JOIN supplier s ON s.s_suppkey = a.k)"""


@query(f"WITH {_ACCOUNTS} SELECT code, position, name, 0 AS place, handle FROM c WHERE handle <> '' UNION ALL SELECT code, position, name, 1, secondary FROM c WHERE secondary <> ''")
def account_handles(spark, sf_dir):
    return sources.handles_of(_accounts(spark, sf_dir))


@query(f"WITH {_ACCOUNTS} SELECT 'index' AS how, code, name FROM c WHERE position = 2 UNION ALL SELECT 'name', code, name FROM c WHERE position = 1 UNION ALL SELECT 'all', code, name FROM c")
def select_by_name_or_index(spark, sf_dir):
    accounts = _accounts(spark, sf_dir)
    name = documents.selected(accounts, index=1).first()["name"]
    parts = {"index": documents.selected(accounts, index=2), "name": documents.selected(accounts, name=name), "all": documents.selected(accounts)}
    return ingest.pages([p.select(F.lit(how).alias("how"), "code", "name") for how, p in parts.items()])


# landed answers


@query(f"WITH l AS ({_LEVELS}) SELECT cast(year AS INT) AS year, monthname(make_date(2000, m, 1)) AS month, level AS value FROM l WHERE m <> 5 UNION ALL SELECT cast(max(year) AS INT), 'Annual', 1.5 FROM l")
def series_answer(spark, sf_dir):
    """A landed answer of the series service, with values that are no number and a yearly one."""
    points = _levels(spark, sf_dir).select(_text("year").alias("year"), F.col("month").alias("periodName"), F.when(F.col("m") == 5, "-").otherwise(_text("level")).alias("value"))
    yearly = points.agg(F.max("year").alias("year")).select("year", F.lit("Annual").alias("periodName"), F.lit("1.5").alias("value"))
    data = points.unionByName(yearly).agg(F.collect_list(F.struct("year", "periodName", "value")).alias("data"))  # a point a month
    answer = data.select(F.to_json(F.struct(F.struct(F.array(F.struct("data")).alias("series")).alias("Results"))).alias("value"))
    return sources.read_series(spark, _landed(spark, answer))


@query("SELECT 'bills' AS list, n_nationkey AS id FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT 'events', n_nationkey FROM nation WHERE n_nationkey % 2 = 1 UNION ALL SELECT 'bills', -1 FROM region")
def api_pages(spark, sf_dir):
    """Every list of every page, a page a region; a lone object without pagination gives nothing."""
    rows = table(spark, sf_dir, "nation").withColumn("id", F.col("n_nationkey"))
    lists = [F.concat(F.array(F.struct(F.lit(-1).alias("id"))) if k == 0 else F.array().cast("array<struct<id:int>>"), F.collect_list(F.when(F.col("id") % 2 == k, F.struct("id")))).alias(n) for k, n in ((0, "bills"), (1, "events"))]
    pages = rows.groupBy("n_regionkey").agg(*lists)
    body = F.to_json(F.struct("bills", "events", F.struct(F.lit(2).alias("count")).alias("pagination"), F.struct(F.lit("json").alias("format")).alias("request")))
    alone = spark.createDataFrame([('{"committee":{"id":7}}',)], "value string")
    return sources.read_pages(spark, _landed(spark, pages.select(body.alias("value")).unionByName(alone)), "id:int")


@query("SELECT n_nationkey, n_name AS name FROM nation WHERE n_nationkey % 4 <> 3 UNION ALL SELECT n_nationkey, NULL FROM nation WHERE n_nationkey % 4 = 3")
def api_document(spark, sf_dir):
    """Documents as JSON, as XML with and without a declaration, and none."""
    name, key = F.col("n_name"), F.col("n_nationkey") % 4
    xml = F.concat(F.lit("<api-root><name>"), name, F.lit("</name></api-root>"))
    raw = F.when(key == 0, F.to_json(F.struct(name.alias("name")))).when(key == 1, xml).when(key == 2, F.concat(F.lit('<?xml version="1.0"?>\n'), xml))
    return table(spark, sf_dir, "nation").select("n_nationkey", sources.api_document(raw, "name string")["name"].alias("name"))


@query("SELECT cast(n_nationkey AS VARCHAR) AS event_id, n_name AS title, 'R' || n_regionkey AS code FROM nation")
def meeting_unwrap(spark, sf_dir):
    """A cached map of events to rows, each with its meeting, wrapped or not."""
    code = F.concat(F.lit("R"), _text("n_regionkey")).alias("systemCode")
    inner = F.struct(F.struct(F.col("n_name").alias("title"), F.array(F.struct(code)).alias("committees")).alias("committeeMeeting"))
    raw = F.when(F.col("n_nationkey") % 2 == 0, F.to_json(F.struct(inner.alias("api-root")))).otherwise(F.to_json(inner))
    rows = table(spark, sf_dir, "nation").agg(F.collect_list(F.concat(F.lit('"'), _text("n_nationkey"), F.lit('":'), raw)).alias("x"))  # the cache is one small file
    cached = rows.select(F.concat(F.lit("{"), F.array_join("x", ","), F.lit("}")).alias("value"))
    events = sources.read_map(spark, _landed(spark, cached), "event_id")
    events = events.select("event_id", documents.meeting(F.col("raw"), "title:string,committees:string").alias("m"))
    return events.select("event_id", "m.title", sources.committees_of(F.col("m.committees"))[0]["systemCode"].alias("code"))


@query("SELECT n_name AS title, 'of ' || n_regionkey AS description, '2020-01-0' || (n_regionkey + 1) || 'T00:00:00Z' AS \"publishedAt\", CASE WHEN n_nationkey % 2 = 0 THEN '@' || n_name END AS \"customUrl\", 'UU' || n_nationkey AS uploads FROM nation")
def channel_extract(spark, sf_dir):
    snippet = _snippet(F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("@"), "n_name")).alias("customUrl"))
    uploads = F.struct(F.struct(F.lit("").alias("likes"), F.concat(F.lit("UU"), _text("n_nationkey")).alias("uploads")).alias("relatedPlaylists"))
    raw = table(spark, sf_dir, "nation").select(F.to_json(F.struct(_text("n_nationkey").alias("id"), snippet.alias("snippet"), uploads.alias("contentDetails"))).alias("value"))
    return documents.channels(raw.select(F.from_json("value", documents.CHANNEL).alias("x")).select("x.*"))


def _snippet(*more):
    at = F.concat(F.lit("2020-01-0"), (F.col("n_regionkey") + 1).cast("string"), F.lit("T00:00:00Z"))
    return F.struct(F.col("n_name").alias("title"), F.concat(F.lit("of "), _text("n_regionkey")).alias("description"), at.alias("publishedAt"), *more)


@query("SELECT n_name AS title, 'of ' || n_regionkey AS description, '2020-01-0' || (n_regionkey + 1) || 'T00:00:00Z' AS \"publishedAt\", 'v' || n_nationkey AS \"videoId\" FROM nation")
def video_extract(spark, sf_dir):
    resource = F.struct(F.concat(F.lit("v"), _text("n_nationkey")).alias("videoId")).alias("resourceId")
    raw = table(spark, sf_dir, "nation").select(F.to_json(F.struct(_snippet(resource).alias("snippet"))).alias("value"))
    return documents.videos(raw.select(F.from_json("value", documents.VIDEO).alias("x")).select("x.*"))


@query("""SELECT 's' || n_nationkey AS "systemCode", n_name AS kind, CASE WHEN n_nationkey % 3 > 0 THEN year(make_date(2020 + n_regionkey, 2, 3)) ELSE 1 END AS updated,
CASE WHEN n_nationkey % 3 > 0 THEN (2020 + n_regionkey) || '-02-03T04:05:06Z' ELSE '0001-01-01T00:00:00Z' END AS text FROM nation""")
def details_renamed(spark, sf_dir):
    """Details as the service names them, read with their own names and times, and written back."""
    at = F.when(F.col("n_nationkey") % 3 > 0, F.concat((2020 + F.col("n_regionkey")).cast("string"), F.lit("-02-03T04:05:06Z")))
    rows = table(spark, sf_dir, "nation").select(F.concat(F.lit("s"), _text("n_nationkey")).alias("systemCode"), F.col("n_name").alias("type"), at.alias("updateDate"))
    inner = documents.from_service(rows)
    again = documents.to_service(inner.withColumn("isCurrent", F.lit(True))).select(F.col("systemCode").alias("_code"), F.col("type").alias("_type"), F.col("updateDate").alias("text"))
    return inner.join(again, (F.col("systemCode") == F.col("_code")) & (F.col("ctype") == F.col("_type"))).select("systemCode", F.col("ctype").alias("kind"), F.year("updateDate").cast("long").alias("updated"), "text")


# stores


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'cached' ELSE 'fetched' END AS origin FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 6 = 0")
def read_through_cache(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    cache = keys.filter("o_orderkey % 4 = 0").withColumn("origin", F.lit("cached"))
    return ingest.read_through(keys.filter("o_orderkey % 6 = 0"), cache, "o_orderkey", lambda missing: missing.withColumn("origin", F.lit("fetched")))


@query("SELECT false AS forced, o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'stored' ELSE 'fetched' END AS origin FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 6 = 0 UNION ALL SELECT true, o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'fetched' ELSE 'stored' END FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 6 = 0")
def details_store(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    stored = keys.filter("o_orderkey % 4 = 0").withColumn("origin", F.lit("stored"))
    return ingest.pages([ingest.details(keys.filter("o_orderkey % 6 = 0"), stored, "o_orderkey", lambda m: m.withColumn("origin", F.lit("fetched")), force).select(F.lit(force).alias("forced"), "o_orderkey", "origin") for force in (False, True)])


@query("""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'xml ' ELSE 'json ' END || event_type AS body FROM events
WHERE event_id < coalesce((SELECT min(event_id) FROM events WHERE event_id % 1000 = 999), 1000000000)""")
def lookup_answers(spark, sf_dir):
    """Landed point lookups: some failed and were asked again, and one ended the scan."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    bad = F.col("event_id") % 7 == 0
    status = F.when(F.col("event_id") % 1000 == 999, 429).when(bad, 500).otherwise(200)
    first = rows.select("event_id", F.col("event_id").alias("at"), F.lit(1).alias("attempt"), status.alias("status"), F.concat(F.lit("json "), "event_type").alias("body"))
    second = rows.filter(bad).select("event_id", F.col("event_id").alias("at"), F.lit(2).alias("attempt"), F.lit(200).alias("status"), F.concat(F.lit("xml "), "event_type").alias("body"))
    return ingest.answered(first.unionByName(second), "event_id", "at")


@query("SELECT 3 AS store, n_name AS title FROM nation WHERE n_regionkey = 3 UNION ALL SELECT 4, n_name FROM nation WHERE n_regionkey = 4")
def store_scan(spark, sf_dir):
    """Document stores, a file each; one that is not there has no rows."""
    at = f"{_scratch(spark)}/{uuid.uuid4()}"
    parts = []
    for i in (3, 4):
        docs = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") == i).agg(F.collect_list(F.struct(_text("n_nationkey"), F.struct(F.col("n_name").alias("title")))).alias("x"))
        docs.select(F.to_json(F.struct(F.map_from_entries("x").alias("videos"))).alias("value")).write.text(f"{at}/youtube_{i:02d}.json")
    for i in (3, 4, 5):
        parts.append(sources.read_store(spark, at, i, "videos", "title:string" if i < 5 else "title string").select(F.lit(i).alias("store"), "title"))
    return ingest.pages(parts)


@query("SELECT r_regionkey AS id FROM region WHERE r_regionkey >= 3 UNION ALL SELECT 100")
def truncate_on_force(spark, sf_dir):
    at = f"{_scratch(spark)}/{uuid.uuid4()}"
    rows = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"))
    sources.store(rows.filter("id < 3"), at)
    sources.store(rows.filter("id >= 3"), at, force=True)
    sources.store(spark.createDataFrame([(100,)], "id int"), at)
    return sources.stored(spark, "id int", at)


@query(f"WITH l AS ({_LEVELS}) SELECT cast(year AS INT) AS year, " + ", ".join(f"max(CASE WHEN m = {i + 1} THEN CASE WHEN year = 1999 THEN level / 2 WHEN year <> 2000 OR m < 7 THEN level END END) AS {m}" for i, m in enumerate(fn.MONTHS)) + " FROM l GROUP BY 1")
def grid_in_place(spark, sf_dir):
    """The grid, read and written at one place: whole years are replaced, also by years with fewer months."""
    at = f"{_scratch(spark)}/{uuid.uuid4()}"
    levels = _levels(spark, sf_dir)
    schema = "year int, " + ", ".join(f"{m} double" for m in fn.MONTHS)
    sources.write_csv(timeseries.pivot_grid(levels, "year", "month", "level"), at)
    new = levels.filter("year = 1999 or year = 2000 and m < 7").withColumn("level", F.when(F.col("year") == 1999, F.col("level") / 2).otherwise(F.col("level")))
    merged = timeseries.keep_last([sources.read_csv(spark, at, schema), timeseries.pivot_grid(new, "year", "month", "level").select("year", *fn.MONTHS)], ["year"])
    sources.replace(merged, at, sources.write_csv)
    return sources.read_csv(spark, at, schema)


@query("""SELECT 'E' || n_nationkey || '.1' AS id, '"' || n_name || ': x"' AS raw_title, n_name || ': x' AS title, 'Body of ' || n_name || chr(10) || CASE WHEN n_nationkey % 2 = 0 THEN chr(10) || 'more' || chr(10) ELSE '' END AS body FROM nation""")
def markdown_files(spark, sf_dir):
    """A file per nation, its white space at the end made one newline, read again."""
    at = f"{_scratch(spark)}/{uuid.uuid4()}"
    title = F.concat("n_name", F.lit(": x"))
    body = F.concat(fn.front_matter(title=title), F.lit("\nBody of "), "n_name", F.when(F.col("n_nationkey") % 2 == 0, "\n\nmore\n\n\n").otherwise(" \t"))
    sources.write_markdown(table(spark, sf_dir, "nation").select(F.concat(F.lit("E"), _text("n_nationkey"), F.lit(".1")).alias("id"), body.alias("body")), at)
    return sources.read_markdown(spark, f"{at}/*.md").select("id", F.concat(F.lit('"'), F.col("fields")["title"], F.lit('"')).alias("raw_title"), F.col("fields")["title"].alias("title"), "body")


# series


@query("SELECT p AS period, s AS start, e AS \"end\", h AS house, n AS senate FROM (VALUES (118, '2023-01-03', '2025-01-03', 'Red', 'Blue'), (119, '2025-01-03', '2025-06-30', 'Red', 'Red / Blue')) v(p, s, e, h, n)")
def period_dimension(spark, sf_dir):
    text = '{"118":{"start":"2023-01-03","end":"2025-01-03","house":"Red","senate":"Blue"},"119":{"start":"2025-01-03","end":"present","house":"Red","senate":"Red / Blue","sessions":[]}}'
    landed = _landed(spark, spark.createDataFrame([(text,)], "value string"))
    return periods.periods_from_json(spark.read.text(landed, wholetext=True), "value", "2025-06-30")


_DAYS = "SELECT cast(ts AS DATE) AS day, max(event_id) AS k, arg_max(value, event_id) AS v FROM events GROUP BY 1"


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.max("event_id").alias("k"), F.max_by("value", "event_id").alias("v"))


@query(f"WITH d AS ({_DAYS}) SELECT cast(date_trunc('month', day) AS DATE) AS date, arg_max(v, day) AS fred FROM d WHERE k % 3 <> 0 GROUP BY 1")
def series_by_place(spark, sf_dir):
    """A dropped CSV whose columns count by place; a lone point is no value."""
    rows = _days(spark, sf_dir).select(_text("day").alias("observation_date"), F.when(F.col("k") % 3 == 0, ".").otherwise(_text("v")).alias("A191"), F.col("k").alias("line"))
    return sources.by_place(spark, _one_file(spark, rows, "line"), "fred")


@query(f"WITH d AS ({_DAYS}) SELECT cast(date_trunc('month', day) AS DATE) AS date, arg_max(v + 1, day) AS adobe FROM d GROUP BY 1")
def series_dropped(spark, sf_dir):
    """A dropped CSV whose value column goes by its name; of lines of one day the last counts."""
    day = _days(spark, sf_dir)
    rows = day.unionByName(day.withColumn("k", F.col("k") + 1_000_000_000).withColumn("v", F.col("v") + 1))
    rows = rows.select(F.lit("x").alias("note"), F.col("k").alias("line"), _text("day").alias("Date "), _text("v").alias("YOY_PCT"))
    return sources.manual_series(spark, _one_file(spark, rows, "line"), "adobe")


@query(f"WITH l AS ({_LEVELS}) SELECT cast(row_number() OVER (ORDER BY year, m) AS INT) AS place, cast(make_date(year, m, 1) AS DATE) AS date, level FROM l")
def series_sorted(spark, sf_dir):
    from pyspark.sql import Window

    # a row a month
    rows = _levels(spark, sf_dir).select(F.make_date("year", "m", F.lit(1)).alias("date"), "level")
    return rows.withColumn("place", F.row_number().over(Window.orderBy("date"))).orderBy("date")


@query("SELECT n AS name, w AS weight FROM (VALUES ('bls', 2.0::DOUBLE), ('fred', 0.5::DOUBLE), ('adobe', 0.0::DOUBLE)) v(n, w)")
def parsed_weights(spark, sf_dir):
    return spark.createDataFrame(list(timeseries.parse_weights(" bls=2, ,fred = 0.5,,adobe=0").items()), "name string, weight double")


# dashboard and catalogue


@query("""SELECT s_name AS committee, coalesce(CASE WHEN s_suppkey % 3 > 0 THEN '@' || s_suppkey END, '') AS handle, cast(s_suppkey AS DOUBLE) AS total, CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE cast(s_nationkey AS DOUBLE) END AS missing, cast(100 + s_suppkey % 20 AS DOUBLE) AS congress, 'Democratic' AS control, 'house' AS chamber
FROM supplier WHERE s_suppkey % 6 <> 0 AND s_suppkey % 11 <> 0""")
def report_rows(spark, sf_dir):
    """The published report read back: rows without a committee or with a congress that is no number are left out."""
    key = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(
        F.when(key % 6 == 0, "").otherwise(F.col("s_name")).alias("committee_name"), F.when(key % 3 > 0, F.concat(F.lit("@"), _text("s_suppkey"))).otherwise("").alias("handle"), _text("s_suppkey").alias("total_videos"),
        F.when(key % 4 == 0, "").otherwise(_text("s_nationkey")).alias("missing_event_id"), F.when(key % 11 == 0, "none").otherwise((100 + key % 20).cast("string")).alias("congress_number"), F.lit("Democratic").alias("control"), F.lit("house").alias("chamber"), "s_suppkey",
    )
    state, report = sources.report_state(spark, _one_file(spark, rows, "s_suppkey"))
    assert state == "ready"
    return report.select("committee", "handle", "total", "missing", "congress", "control", "chamber")


@query("""WITH c AS (SELECT n_regionkey, n_nationkey % 3 AS k FROM nation), f AS (SELECT 'one' AS choice, 2 AS theme, 1 AS k UNION ALL SELECT 'none', 2, 9 UNION ALL SELECT 'all', NULL, NULL),
s AS (SELECT f.choice, c.n_regionkey, count(CASE WHEN coalesce(c.n_regionkey = f.theme, true) AND coalesce(c.k = f.k, true) THEN 1 END) AS shown FROM c CROSS JOIN f GROUP BY 1, 2)
SELECT choice, n_regionkey, shown, shown = 0 AS hidden, max(shown) OVER (PARTITION BY choice) = 0 AS empty FROM s""")
def section_visibility(spark, sf_dir):
    cards = table(spark, sf_dir, "nation").select("n_regionkey", _text("n_regionkey").alias("theme"), (F.col("n_nationkey") % 3).cast("string").alias("status"))
    choices = {"one": {"theme": "2", "status": "1"}, "none": {"theme": "2", "status": "9"}, "all": {"theme": facets.ALL, "status": facets.ALL}}
    return ingest.pages([facets.sections(cards, "n_regionkey", f).select(F.lit(c).alias("choice"), "n_regionkey", "shown", "hidden", "empty") for c, f in choices.items()])


@query("""SELECT * FROM (SELECT n_nationkey, unnest([CASE WHEN n_regionkey > 2 THEN 'theme' END, CASE WHEN n_nationkey % 4 = 1 THEN 'repo' END, CASE WHEN n_nationkey % 5 = 1 THEN 'order' END, CASE WHEN n_nationkey % 7 = 1 THEN 'title' END, CASE WHEN n_nationkey % 6 = 1 THEN 'status' END]) AS field FROM nation) WHERE field IS NOT NULL""")
def row_constraints(spark, sf_dir):
    """Fields that break the catalogue's rules: enumeration, literal, URL if given, whole number, given at all."""
    key = F.col("n_nationkey")
    rows = table(spark, sf_dir, "nation").select(
        "n_nationkey", F.get(F.array(*map(F.lit, ("I", "II", "III", "VI", ""))), F.col("n_regionkey")).alias("theme"), F.when(key % 4 == 0, "https://example.org/a").when(key % 4 == 1, "example").alias("repo"),
        F.when(key % 5 == 1, 1.5).otherwise(2.0).alias("order"), F.when(key % 7 != 1, F.col("n_name")).alias("title"), F.when(key % 6 == 1, "done").otherwise("built").alias("status"), F.lit(None).cast("string").alias("focus"),
    )
    rules = {"theme": documents.one_of("I", "II", "III", "IV", "V"), "repo": documents.optional(documents.is_url), "order": documents.is_int, "title": documents.given, "status": documents.one_of("built"), "focus": documents.optional(documents.given)}
    return documents.violations(rows, "n_nationkey", rules)


@query("SELECT c_mktsegment AS segment, CASE c_mktsegment WHEN 'BUILDING' THEN 'D/R' ELSE 'R/D' END AS letters, 'House: ' || coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN 'Democratic' END, '—') || ' · Senate: Republican' AS chambers, '2023' AS since, max(c_custkey) AS top, cast(round(avg(c_custkey) * 8) AS BIGINT) AS eighths, printf('%.1f', floor(max(c_custkey) / 4.0 * 10 + 0.5) / 10) AS one_place FROM customer GROUP BY 1")
def control_labels(spark, sf_dir):
    building = F.col("c_mktsegment") == "BUILDING"
    rows = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.max("c_custkey").alias("top"), F.avg("c_custkey").alias("mean"))
    controls = F.when(building, F.array(F.lit("Democratic"), F.lit("Red"))).otherwise(F.array(F.lit("Republican"), F.lit("Democratic")))
    chambers = fn.chamber_controls(F.array(F.lit("house"), F.lit("senate")), F.when(building, "Democratic"), F.lit("Republican"))
    return rows.select(F.col("c_mktsegment").alias("segment"), fn.parties(controls).alias("letters"), chambers.alias("chambers"), F.substr(F.lit("2023-01-03"), F.lit(1), F.lit(4)).alias("since"), "top", fn.rounded_up(F.col("mean") * 8).alias("eighths"), fn.one_place(F.col("top") / 4).alias("one_place"))


@query("SELECT 'orders' AS of, max(n) AS top, max(n) AS largest FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus) UNION ALL SELECT 'nothing', 1, 0")
def largest_total(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("total"))
    return ingest.pages([facets.largest_total(c).select(F.lit(of).alias("of"), "top", "largest") for of, c in (("orders", counts), ("nothing", counts.filter("false")))])


@query("SELECT r_regionkey, 'related:' || chr(10) || '  - title: \"' || r_name || '\"' || chr(10) || '    url: null' || chr(10) || '  - title: \"more\"' || chr(10) || '    url: \"https://example.org\"' AS head FROM region")
def front_matter_list(spark, sf_dir):
    items = F.array(F.struct(F.col("r_name").alias("title"), F.lit(None).cast("string").alias("url")), F.struct(F.lit("more").alias("title"), F.lit("https://example.org").alias("url")))
    return table(spark, sf_dir, "region").select("r_regionkey", fn.yaml_list("related", items, ["title", "url"]).alias("head"))


@query("""SELECT n_nationkey, array_to_string([n_name, 'x', 'y'], ',') AS appended, CASE WHEN n_nationkey % 2 = 0 THEN 'y' ELSE 'x,y' END AS removed, n_nationkey % 3 = 0 AS has, cast(2 + n_nationkey % 2 AS INT) AS length,
coalesce(CASE WHEN n_regionkey = 1 THEN 'one' END, 'other') AS got, 'a,b' AS keys, CASE WHEN n_regionkey = 1 THEN '7' ELSE '2' END AS merged, cast(n_nationkey * 2 AS INT) AS deep FROM nation""")
def collections(spark, sf_dir):
    """Lists, maps and paths into nested JSON."""
    key = F.col("n_nationkey")
    two = F.array(F.lit("x"), F.lit("y"))
    base, over = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("b"), F.when(F.col("n_regionkey") == 1, "7").otherwise("2"))
    merged = F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(over, k)), over)
    json = F.to_json(F.struct(F.struct(F.array(F.struct((key * 2).alias("c"))).alias("b")).alias("a")))
    return table(spark, sf_dir, "nation").select(
        "n_nationkey", F.array_join(F.concat(F.array("n_name"), two), ",").alias("appended"), F.array_join(F.when(key % 2 == 0, F.array_remove(two, "x")).otherwise(two), ",").alias("removed"), F.exists(F.array(key % 3), lambda x: x == 0).alias("has"),
        F.size(F.when(key % 2 == 1, F.array_append(two, "z")).otherwise(two)).alias("length"), F.coalesce(F.try_element_at(F.create_map(F.lit(1), F.lit("one")), F.col("n_regionkey")), F.lit("other")).alias("got"),
        F.array_join(F.array_sort(F.map_keys(merged)), ",").alias("keys"), merged["b"].alias("merged"), F.get_json_object(json, "$.a.b[0].c").cast("int").alias("deep"),
    )


# trees


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations below regions; every fourth nation's last row detaches it, and later rows have null fields."""
    nation = table(spark, sf_dir, "nation").filter("n_nationkey >= 5")
    code, up = F.concat(F.lit("n"), _text("n_nationkey")).alias("code"), F.concat(F.lit("r"), _text("n_regionkey")).alias("code")
    parent = F.struct(up, F.concat(F.lit("region "), _text("n_regionkey")).alias("name"))
    first = nation.select(code, F.col("n_nationkey").alias("at"), F.col("n_name").alias("name"), F.lit("house").alias("chamber"), parent.alias("parent"))
    kept = F.when(F.col("n_nationkey") % 4 != 0, parent).alias("parent")
    second = nation.filter("n_nationkey % 2 = 0").select(code, (F.col("n_nationkey") + 100).alias("at"), F.lit(None).cast("string").alias("name"), F.lit("senate").alias("chamber"), kept)
    return hierarchy.registry(first.unionByName(second), "code", "at", ["name", "chamber"], "parent", ["chamber"])


@query("""WITH n AS (SELECT * FROM nation WHERE n_nationkey >= 5)
SELECT 'n' || n_nationkey AS code, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'senate' ELSE 'house' END AS chamber, CASE WHEN n_nationkey % 4 <> 0 THEN 'r' || n_regionkey END AS parent FROM n
UNION ALL SELECT 'r' || n_regionkey, 'region ' || n_regionkey, 'house', NULL FROM n GROUP BY n_regionkey""")
def node_registry(spark, sf_dir):
    return _registry(spark, sf_dir).select("code", "name", "chamber", "parent")


@query("SELECT 'n' || n_nationkey AS code FROM nation WHERE n_nationkey >= 5 AND n_nationkey % 4 = 0 UNION SELECT 'r' || n_regionkey FROM nation WHERE n_nationkey >= 5 UNION SELECT 'n5'")
def root_nodes(spark, sf_dir):
    """Roots, after one more node was detached by a link."""
    nodes = _registry(spark, sf_dir)
    return hierarchy.roots(hierarchy.linked(nodes, spark.createDataFrame([("n5", None)], "code string, parent string"), "code")).select("code")


@query("""WITH n AS (SELECT 'n' || n_nationkey AS code, n_name AS name, n_nationkey AS k, CASE WHEN n_nationkey % 4 <> 0 THEN 'r' || n_regionkey END AS parent FROM nation WHERE n_nationkey >= 5),
r AS (SELECT parent, string_agg('{"code":"' || code || '","name":"' || name || '"}', ',' ORDER BY k) AS children FROM n WHERE parent IS NOT NULL GROUP BY 1)
SELECT code, '{"code":"' || code || '","name":"' || name || '"' || coalesce(',"parent":{"code":"' || parent || '","name":"region ' || substr(parent, 2) || '"}', '') || '}' AS node, '{"code":"' || code || '","name":"' || name || '"}' AS flat FROM n
UNION ALL SELECT s.code, '{"code":"' || s.code || '","name":"region ' || substr(s.code, 2) || '"' || coalesce(',"children":[' || r.children || ']', '') || '}', '{"code":"' || s.code || '","name":"region ' || substr(s.code, 2) || '"}'
FROM (SELECT DISTINCT 'r' || n_regionkey AS code FROM nation WHERE n_nationkey >= 5) s LEFT JOIN r ON r.parent = s.code""")
def node_trees(spark, sf_dir):
    nodes = _registry(spark, sf_dir)
    flat = hierarchy.trees(nodes, "code", ["code", "name"], ["code", "name"], include_tree=False).withColumnRenamed("node", "flat")
    return hierarchy.trees(nodes, "code", ["code", "name"], ["code", "name"]).join(flat, "code")


# services


@query("SELECT 'committee' AS kind, n_name AS name, 'house' AS chamber, 'r' || n_regionkey AS parent FROM nation UNION ALL SELECT 'meeting', cast(n_nationkey AS VARCHAR), 'senate', '118' FROM nation")
def service_lists(spark, sf_dir):
    """Landed lists of the two endpoints, a page a region."""
    at = f"{_scratch(spark)}/{uuid.uuid4()}"
    nation = table(spark, sf_dir, "nation")
    committee = F.struct(F.lit("house").alias("chamber"), F.col("n_name").alias("name"), F.struct(F.concat(F.lit("r"), _text("n_regionkey")).alias("systemCode")).alias("parent"))
    meeting = F.struct(_text("n_nationkey").alias("eventId"), F.lit("senate").alias("chamber"), F.lit(118).alias("congress"))
    for folder, name, item in (("committee/house", "committees", committee), ("committee-meeting/118/senate", "committeeMeetings", meeting)):
        pages = nation.groupBy("n_regionkey").agg(F.collect_list(item).alias(name))
        body = F.to_json(F.struct(name, F.struct(F.lit(25).alias("count")).alias("pagination"))).alias("value")
        pages.repartitionById(5, F.col("n_regionkey")).select(body).write.text(f"{at}/{folder}")  # a page a file
    rows = sources.read_committees(spark, at, "house").select(F.lit("committee").alias("kind"), "name", "chamber", F.col("parent.systemCode").alias("parent"))
    return rows.unionByName(sources.read_meetings(spark, at, 118, "senate").select(F.lit("meeting").alias("kind"), F.col("eventId").alias("name"), "chamber", _text("congress").alias("parent")))


@query("""WITH k AS (SELECT user_id, max(event_id) FILTER (event_id % 5 = 0) AS seen FROM events GROUP BY 1)
SELECT true AS stopped, e.user_id, e.event_id FROM events e JOIN k USING (user_id) WHERE k.seen IS NULL OR e.event_id > k.seen UNION ALL SELECT false, user_id, event_id FROM events WHERE event_id % 5 <> 0""")
def high_water_mark(spark, sf_dir):
    """Scans newest first: up to the first known row, and all that is missing."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", (-F.col("event_id")).alias("place"))
    stored = rows.filter("event_id % 5 = 0")
    return ingest.pages([ingest.fresh(rows, stored, "event_id", ["user_id"], "place", stop).select(F.lit(stop).alias("stopped"), "user_id", "event_id") for stop in (True, False)])


@query("SELECT o_orderstatus, yr, retrieved, cast(floor((total - retrieved) / cast(250 AS DOUBLE)) + 1 AS BIGINT) AS remaining FROM (SELECT o_orderstatus, yr, cast(sum(n) OVER (PARTITION BY o_orderstatus ORDER BY yr) AS BIGINT) AS retrieved, cast(sum(n) OVER (PARTITION BY o_orderstatus) AS BIGINT) AS total FROM (SELECT o_orderstatus, cast(year(o_orderdate) AS INT) AS yr, count(*) AS n FROM orders GROUP BY 1, 2))")
def page_tally(spark, sf_dir):
    pages = table(spark, sf_dir, "orders").groupBy("o_orderstatus", F.year("o_orderdate").alias("yr")).agg(F.count(F.lit(1)).alias("n"))
    totals = pages.groupBy("o_orderstatus").agg(F.sum("n").alias("total"))
    return ingest.tally(pages.join(totals, "o_orderstatus"), "o_orderstatus", "yr", "n", "total", 250).select("o_orderstatus", "yr", "retrieved", "remaining")


@query(f"WITH l AS ({_LEVELS}) SELECT strftime(make_date(year, m, 1), '%Y-%m-01') AS date, CASE WHEN m <> 2 THEN level END AS level FROM l")
def series_written(spark, sf_dir):
    at = f"{_scratch(spark)}/{uuid.uuid4()}"
    sources.write_series(_levels(spark, sf_dir).select(F.make_date("year", "m", F.lit(15)).alias("date"), F.when(F.col("m") != 2, F.col("level")).alias("level")), at)
    return sources.read_csv(spark, at, "date string, level double")


@query("SELECT n_nationkey, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'a' || n_regionkey END AS note, CASE n_nationkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS items, CASE n_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'x' ELSE 'x,y' END AS codes FROM nation")
def xml_document(spark, sf_dir):
    """Leaves are trimmed, blank ones null; a tag once or more is a list; attributes are left out."""
    key = F.col("n_nationkey")
    tags = F.when(key % 3 == 0, "").when(key % 3 == 1, "<code k='1'>x</code>").otherwise("<code>x</code><code> y </code>")
    note = F.when(key % 2 == 0, F.concat(F.lit("<note> a"), _text("n_regionkey"), F.lit(" </note>"))).otherwise("<note> </note>")
    raw = F.concat(F.lit("<api-root id='7'><name>\n "), "n_name", F.lit(" </name>"), note, tags, F.lit("</api-root>"))
    x = sources.api_document(raw, "name string, note string, code array<string>")
    rows = table(spark, sf_dir, "nation").select("n_nationkey", x.alias("x"))
    codes = F.coalesce("x.code", F.array().cast("array<string>"))
    return rows.select("n_nationkey", fn.strip(F.col("x.name")).alias("name"), F.nullif(fn.strip(F.col("x.note")), F.lit("")).alias("note"), F.size(codes).alias("items"), F.array_join(F.transform(codes, fn.strip), ",").alias("codes"))
