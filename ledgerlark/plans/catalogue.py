"""Queries over the star schema that use every operator, and the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark import functions as fn
from ledgerlark import sources, streaming
from ledgerlark.operators import catalog, facets, hierarchy, ingest, periods, timeseries
from ledgerlark.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}

PERIODS = [(104, "1995-01-01", "1997-01-01", "Red", "Blue"), (105, "1997-01-01", "1999-01-01", "Red", "Red"), (106, "1999-01-01", "2001-01-01", "Blue", "Red"), (107, "2001-01-01", "present", "Blue", "Blue"), (108, "2030-01-01", "2032-01-01", "Red", "Red")]
AS_OF = "2001-06-30"
_PERIODS_SQL = "(VALUES " + ", ".join(f"({p}, '{s}', '{AS_OF if e == 'present' else e}', '{h}', '{n}')" for p, s, e, h, n in PERIODS) + ") p(period, start_, end_, house, senate)"
THEMES = [("I", 3), ("II", 8), ("III", 2), ("IV", 12)]
LONG_NAMES = ", ".join(f"'{m}'" for m in fn.MONTHS)


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dimension(spark: SparkSession) -> DataFrame:
    return periods.periods(spark, PERIODS, AS_OF)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's segment: the videos of the star schema."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", F.col("o_orderdate").cast("string").alias("at"))
    return orders.join(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))


@query(f"""
WITH v AS (SELECT c_mktsegment, cast(o_orderdate AS VARCHAR) AS at, o_orderstatus = 'F' AS tag FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT s.c_mktsegment, p.period, count(v.at) AS total, count(v.at) - count(CASE WHEN v.tag THEN 1 END) AS missing, p.house AS control, 'house' AS chamber
FROM (SELECT DISTINCT c_mktsegment FROM v) s CROSS JOIN {_PERIODS_SQL}
LEFT JOIN v ON v.c_mktsegment = s.c_mktsegment AND v.at >= p.start_ AND v.at <= p.end_
GROUP BY s.c_mktsegment, p.period, p.house""")
def coverage_report(spark, sf_dir):
    return periods.coverage(_orders(spark, sf_dir), _dimension(spark), ["c_mktsegment"], F.col("at"), F.col("o_orderstatus") == "F")


@query(f"""
WITH v AS (SELECT o_orderkey, c_mktsegment, cast(o_orderdate AS VARCHAR) AS at FROM orders JOIN customer ON o_custkey = c_custkey),
h AS (SELECT v.o_orderkey, any_value(v.c_mktsegment) AS c_mktsegment, count(p.period) AS n FROM v LEFT JOIN {_PERIODS_SQL} ON v.at >= p.start_ AND v.at <= p.end_ GROUP BY v.o_orderkey)
SELECT c_mktsegment, count(*) AS total, cast(sum(n) AS BIGINT) AS in_periods, count(CASE WHEN n = 0 THEN 1 END) AS unassigned FROM h GROUP BY 1""")
def coverage_reconcile(spark, sf_dir):
    return periods.reconcile(_orders(spark, sf_dir), _dimension(spark), ["c_mktsegment"], F.col("at"))


@query(f"SELECT p.period, count(*) AS n, min(cast(o_orderdate AS VARCHAR)) AS first_at FROM orders JOIN {_PERIODS_SQL} ON cast(o_orderdate AS VARCHAR) >= p.start_ AND cast(o_orderdate AS VARCHAR) <= p.end_ GROUP BY 1")
def period_bucket_lexical(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("string").alias("at"))
    return periods.in_period(rows, _dimension(spark), F.col("at")).groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at"))


@query(r"""
SELECT doc_id, coalesce(regexp_matches(text, '(?i)(\p{Nd}{6}|event[iİı]d)'), false) AS tagged, coalesce(regexp_matches(CASE doc_id % 5 WHEN 0 THEN 'EVENTİD' WHEN 1 THEN 'eventıd' WHEN 2 THEN '１２３４５６' WHEN 3 THEN '１２３４５' END, '(?i)(\p{Nd}{6}|event[iİı]d)'), false) AS other FROM documents""")
def event_id_classify(spark, sf_dir):
    other = F.get(F.array(*map(F.lit, ("EVENTİD", "eventıd", "１２３４５６", "１２３４５"))), (F.col("doc_id") % 5).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", fn.has_event_id(F.col("text")).alias("tagged"), fn.has_event_id(other).alias("other"))


@query(r"SELECT page_id, coalesce(regexp_matches(url, '(?i)(\p{Nd}{6}|eventid)'), false) OR coalesce(regexp_matches(html, '(?i)(\p{Nd}{6}|eventid)'), false) AS tagged FROM pages")
def classify_two_fields(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", fn.has_event_id(F.col("url"), F.col("html")).alias("tagged"))


@query("""
SELECT 'F' AS status, count(*) AS total, count(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END) AS missing, count(*) - count(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END) AS with_tag FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'none', 0, 0, 0""")
def totals_kpi(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    missing = F.when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(0)
    parts = [facets.totals(orders.filter(facets.matching({"o_orderstatus": s})), F.lit(1), missing).select(F.lit(s).alias("status"), "total", "missing", "with_tag") for s in ("F", "none")]
    return ingest.pages(parts)


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'")
def facet_filter(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter(facets.matching({"o_orderstatus": facets.ALL, "o_orderpriority": "1-URGENT"})).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("""
SELECT 'o_orderstatus' AS facet, o_orderstatus AS value, bool_or(o_orderpriority = '1-URGENT' AND o_totalprice > 400000) AS live FROM orders GROUP BY 2
UNION ALL SELECT 'o_orderpriority', o_orderpriority, bool_or(o_orderstatus = 'P' AND o_totalprice > 400000) FROM orders GROUP BY 2""")
def facet_liveness(spark, sf_dir):
    return facets.liveness(table(spark, sf_dir, "orders"), {"o_orderstatus": "P", "o_orderpriority": "1-URGENT"}, F.col("o_totalprice") - 400000)


@query("SELECT DISTINCT 'o_orderstatus' AS facet, o_orderstatus AS value FROM orders UNION ALL SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders")
def facet_options(spark, sf_dir):
    return facets.options(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("""
SELECT l_suppkey, count(*) AS total, cast(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS missing,
sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * cast(100 AS DOUBLE) / count(*) AS share
FROM lineitem GROUP BY 1 ORDER BY total DESC, min(l_orderkey * 10 + l_linenumber), l_suppkey LIMIT 12""")
def leaderboard_top12(spark, sf_dir):
    """Ties go to the supplier whose first line comes first."""
    return facets.leaderboard(table(spark, sf_dir, "lineitem"), "l_suppkey", F.lit(1), F.when(F.col("l_returnflag") == "R", 1).otherwise(0), order=F.col("l_orderkey") * 10 + F.col("l_linenumber"))


@query("SELECT cast(year(o_orderdate) AS INT) AS yr, count(*) AS total, string_agg(DISTINCT o_orderstatus, '/' ORDER BY o_orderstatus) AS o_orderstatus, string_agg(DISTINCT o_orderpriority, '/' ORDER BY o_orderpriority) AS o_orderpriority, min(o_orderkey) AS first_seen FROM orders GROUP BY 1")
def by_period_distinct_list(spark, sf_dir):
    return facets.by_group(table(spark, sf_dir, "orders").withColumn("yr", F.year("o_orderdate")), "yr", F.lit(1), ["o_orderstatus", "o_orderpriority"], order=F.col("o_orderkey"))


@query("""
WITH g AS (SELECT o_orderstatus, count(*) AS top FROM orders GROUP BY 1), p AS (SELECT o_orderstatus, top, pow(cast(10 AS DOUBLE), floor(log10(greatest(top, 1) / cast(4 AS DOUBLE)))) AS pw FROM g UNION ALL SELECT 'zero', 0, cast(0.1 AS DOUBLE)),
s AS (SELECT o_orderstatus, top, CASE WHEN pw * 4 >= greatest(top, 1) THEN pw WHEN pw * 8 >= greatest(top, 1) THEN pw * 2 WHEN pw * 20 >= greatest(top, 1) THEN pw * 5 ELSE pw * 10 END AS step FROM p)
SELECT o_orderstatus, top, step, cast(floor(greatest(top, 1) / step) AS BIGINT) + 1 AS marks, floor(greatest(top, 1) / step) * step AS last_mark FROM s""")
def tick_step(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("top"))
    rows = rows.unionByName(spark.createDataFrame([("zero", 0)], "o_orderstatus string, top long"))
    marks = fn.ticks(F.col("top"))
    return rows.select("o_orderstatus", "top", fn.tick_step(F.col("top")).alias("step"), F.size(marks).cast("long").alias("marks"), F.element_at(marks, -1).alias("last_mark"))


@query("""
SELECT n_nationkey, n_nationkey || CASE WHEN n_nationkey % 100 BETWEEN 11 AND 13 THEN 'th' WHEN n_nationkey % 10 = 1 THEN 'st' WHEN n_nationkey % 10 = 2 THEN 'nd' WHEN n_nationkey % 10 = 3 THEN 'rd' ELSE 'th' END AS ordinal,
upper(substr(lower(n_name), 1, 1)) || substr(lower(n_name), 2) AS title, format('{:,}', n_nationkey * 12345) AS thousands, lpad(cast(n_nationkey AS VARCHAR), 2, '0') AS padded,
CASE n_regionkey WHEN 0 THEN 'first' WHEN 1 THEN 'second' ELSE 'other' END AS badge, replace(n_name, 'NATION', 'country') AS renamed, n_name LIKE 'NATION_1%' AS ones FROM nation""")
def labels(spark, sf_dir):
    key = F.col("n_nationkey")
    badge = F.coalesce(F.try_element_at(F.create_map(F.lit(0), F.lit("first"), F.lit(1), F.lit("second")), F.col("n_regionkey")), F.lit("other"))
    return table(spark, sf_dir, "nation").select("n_nationkey", fn.ordinal(key).alias("ordinal"), fn.title_case(F.lower("n_name")).alias("title"), F.format_number(key * 12345, 0).alias("thousands"), F.format_string("%02d", key).alias("padded"), badge.alias("badge"), F.replace("n_name", F.lit("NATION"), F.lit("country")).alias("renamed"), F.startswith("n_name", F.lit("NATION_1")).alias("ones"))


@query("SELECT r_regionkey, r_name || ' \"q\", x' AS r_name, CASE WHEN r_regionkey > 0 THEN 'line' || chr(10) || r_regionkey END AS note FROM region")
def csv_roundtrip(spark, sf_dir):
    rows = table(spark, sf_dir, "region").select("r_regionkey", F.concat("r_name", F.lit(' "q", x')).alias("r_name"), F.when(F.col("r_regionkey") > 0, F.concat(F.lit("line\n"), F.col("r_regionkey").cast("string"))).alias("note"))
    path = f"{_scratch(spark)}/{uuid.uuid4()}"
    sources.write_csv(rows, path)
    return sources.read_csv(spark, path, "r_regionkey int, r_name string, note string")


def _scratch(spark: SparkSession) -> str:
    return shared_folder(spark)


_LEVELS = "SELECT year(o_orderdate) AS year, month(o_orderdate) AS m, cast(sum(cast(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS level FROM orders GROUP BY 1, 2"


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("m")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("level"))
    return rows.withColumn("month", F.get(F.array(*map(F.lit, fn.MONTHS)), F.col("m") - 1))


@query(f"WITH l AS ({_LEVELS}) SELECT cast(year AS INT) AS year, " + ", ".join(f"max(CASE WHEN m = {i + 1} THEN level END) AS {m}" for i, m in enumerate(fn.MONTHS)) + " FROM l GROUP BY 1")
def pivot_month_grid(spark, sf_dir):
    return timeseries.pivot_grid(_levels(spark, sf_dir), "year", "month", "level")


@query(f"WITH l AS ({_LEVELS}), y AS (SELECT DISTINCT year FROM l), n AS (SELECT unnest(range(1, 13)) AS m) SELECT cast(y.year AS INT) AS year, ([{LONG_NAMES}])[n.m] AS month, make_date(y.year, n.m, 1) AS date, l.level FROM y CROSS JOIN n LEFT JOIN l ON l.year = y.year AND l.m = n.m")
def unpivot_grid(spark, sf_dir):
    return timeseries.unpivot_grid(timeseries.pivot_grid(_levels(spark, sf_dir), "year", "month", "level"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders""")
def keep_last_upsert(spark, sf_dir):
    old = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = old.filter("o_orderkey % 3 = 0").select("o_orderkey", F.lit(None).cast("string").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return timeseries.keep_last([old, new], ["o_orderkey"])


@query("SELECT cast(ts AS DATE) AS date, arg_max(value, (ts, event_id)) AS value FROM events WHERE value IS NOT NULL GROUP BY 1")
def resample_last_daily(spark, sf_dir):
    return timeseries.resample_last(table(spark, sf_dir, "events"), F.col("ts"), "value", "event_id", F.col("ts").cast("date"))


@query("SELECT cast(date_trunc('month', l_shipdate) AS DATE) AS date, arg_max(l_extendedprice, (l_shipdate, l_orderkey * 100000 + l_partkey * 10 + l_linenumber, l_extendedprice)) AS l_extendedprice FROM lineitem GROUP BY 1")
def resample_last_monthly(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_extendedprice", F.struct((F.col("l_orderkey") * 100000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("k"), "l_extendedprice").alias("tie"))
    return timeseries.resample_last(rows, F.col("l_shipdate"), "l_extendedprice", "tie")


_SHIPPED = "SELECT cast(date_trunc('month', l_shipdate) AS DATE) AS date, cast(sum(cast(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS level FROM lineitem GROUP BY 1"


def _shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(fn.month_start(F.col("l_shipdate")).alias("date")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("level"))


@query(f"WITH s AS (SELECT * FROM ({_SHIPPED}) WHERE month(date) % 5 <> 0), e AS (SELECT min(date) AS lo, max(date) AS hi FROM s) SELECT cast(g.d AS DATE) AS date, s.level FROM e, LATERAL (SELECT unnest(generate_series(cast(e.lo AS TIMESTAMP), cast(e.hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS d) g LEFT JOIN s ON s.date = cast(g.d AS DATE)")
def month_spine_gapfill(spark, sf_dir):
    return timeseries.spine(_shipped(spark, sf_dir).filter(F.month("date") % 5 != 0))


@query(f"WITH s AS ({_SHIPPED}) SELECT s.date, round_even((s.level / b.level - 1.0::DOUBLE) * 100.0::DOUBLE * 10000, 0) / 10000 AS yoy FROM s JOIN s b ON s.date = cast(b.date + INTERVAL 12 MONTH AS DATE) WHERE b.level <> 0")
def yoy_pct(spark, sf_dir):
    return timeseries.year_over_year(_shipped(spark, sf_dir), "level")


_TOKENS = ["12", " 3.5 ", "-", "", "1e3", "1.5d", "NaN", "inf", "+7.", ".25", "1,000"]


@query("WITH t AS (SELECT unnest([" + ", ".join(f"'{t}'" for t in _TOKENS) + r"]) AS token) SELECT r_regionkey, token, CASE WHEN regexp_full_match(trim(token), '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') THEN try_cast(trim(token) AS DOUBLE) END AS number FROM region CROSS JOIN t")
def coerce_numeric(spark, sf_dir):
    rows = table(spark, sf_dir, "region").select("r_regionkey", F.explode(F.array(*map(F.lit, _TOKENS))).alias("token"))
    return rows.withColumn("number", fn.to_number(F.col("token")))


_SERIES_SQL = f"""s AS ({_SHIPPED}),
y AS (SELECT s.date, round_even((s.level / b.level - 1.0::DOUBLE) * 100.0::DOUBLE * 10000, 0) / 10000 AS v FROM s JOIN s b ON s.date = cast(b.date + INTERVAL 12 MONTH AS DATE)),
w AS (SELECT date, max(CASE WHEN year(date) >= 1997 THEN v END) AS bls, max(CASE WHEN month(date) % 2 = 0 THEN v / 2 END) AS fred, max(CASE WHEN month(date) % 3 = 0 THEN v + 1 END) AS adobe FROM y WHERE year(date) >= 1997 OR month(date) % 2 = 0 OR month(date) % 3 = 0 GROUP BY 1)"""
CANONICAL = ["bls", "fred", "pricestats"]


def _series(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    shared_folder(spark)
    yoy = timeseries.year_over_year(_shipped(spark, sf_dir).checkpoint(), "level", "v")  # a row a month; the line items are read once

    def missing(_: SparkSession) -> DataFrame:
        raise sources.SourceUnavailable("no file")

    def broken(_: SparkSession) -> DataFrame:
        raise ValueError("bad date")

    plugins = [
        sources.Source("adobe", ("adobe",), lambda s: yoy.filter(F.month("date") % 3 == 0).select("date", (F.col("v") + 1).alias("adobe"))),
        sources.Source("bls", ("bls",), lambda s: yoy.filter(F.year("date") >= 1997).select("date", F.col("v").alias("bls"))),
        sources.Source("fred", ("fred",), lambda s: yoy.filter(F.month("date") % 2 == 0).select("date", (F.col("v") / 2).alias("fred"))),
        sources.Source("pricestats", ("pricestats",), missing),
        sources.Source("broken", ("broken",), broken),
    ]
    return sources.gather(spark, plugins)


@query(f"WITH {_SERIES_SQL} SELECT date, bls, fred, adobe FROM w")
def outer_align_sources(spark, sf_dir):
    return timeseries.align(_series(spark, sf_dir)[0], CANONICAL)


def _blend_sql(weights: dict[str, float]) -> str:
    part = " + ".join(f"coalesce({c} * cast({w} AS DOUBLE), 0)" for c, w in weights.items())
    whole = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN cast({w} AS DOUBLE) ELSE 0 END" for c, w in weights.items())
    return f"WITH {_SERIES_SQL} SELECT date, round_even(({part}) / nullif({whole}, 0) * 10000, 0) / 10000 AS aggregate FROM w"


@query(_blend_sql({"bls": 2.0, "fred": 0.5, "adobe": 0.0}))
def weighted_blend(spark, sf_dir):
    wide = timeseries.align(_series(spark, sf_dir)[0], CANONICAL)
    return wide.select("date", timeseries.blend(["bls", "fred", "adobe"], timeseries.parse_weights("bls=2, fred=0.5,adobe=0,,other=9")).alias("aggregate"))


@query(_blend_sql({"bls": 1.0, "fred": 1.0, "adobe": 1.0}))
def equal_blend(spark, sf_dir):
    wide = timeseries.align(_series(spark, sf_dir)[0], CANONICAL)
    return wide.select("date", timeseries.blend(["bls", "fred", "adobe"]).alias("aggregate"))


@query(f"WITH {_SERIES_SQL} SELECT 'adobe' AS source, 'OK' AS status, count(adobe) AS months, cast(max(CASE WHEN adobe IS NOT NULL THEN date END) AS VARCHAR) AS latest FROM w UNION ALL SELECT 'bls', 'OK', count(bls), cast(max(CASE WHEN bls IS NOT NULL THEN date END) AS VARCHAR) FROM w UNION ALL SELECT 'fred', 'OK', count(fred), cast(max(CASE WHEN fred IS NOT NULL THEN date END) AS VARCHAR) FROM w UNION ALL SELECT 'pricestats', 'SKIP', 0, NULL UNION ALL SELECT 'broken', 'ERROR', 0, NULL")
def source_status(spark, sf_dir):
    return _series(spark, sf_dir)[1]


@query(f"WITH l AS (SELECT cast(y.year AS INT) AS year, y.level FROM ({_LEVELS}) y WHERE m = 1) SELECT o.o_orderkey, o.o_totalprice * (n.level / t.level) AS adjusted, cast(make_date(year(o.o_orderdate), 1, 1) + CAST(floor(((o.o_orderkey % 8) / cast(8 AS DOUBLE)) * 365.25::DOUBLE) AS INT) AS DATE) AS as_date FROM orders o JOIN l t ON t.year = year(o.o_orderdate) JOIN l n ON n.year = 2000")
def inflation_adjust(spark, sf_dir):
    january = _levels(spark, sf_dir).filter("m = 1").select("year", "level")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    now = january.filter("year = 2000").select(F.col("level").alias("now"))
    # a row per year, and one row: dimensions of the calendar's size
    rows = rows.join(F.broadcast(january), "year").crossJoin(F.broadcast(now))
    date = fn.float_year_date(F.col("year") + (F.col("o_orderkey") % 8) / F.lit(8.0))
    return rows.select("o_orderkey", fn.inflated(F.col("o_totalprice"), F.col("level"), F.col("now")).alias("adjusted"), date.alias("as_date"))


@query(f"WITH s AS ({_SHIPPED}) SELECT strftime(date, '%Y-%m') AS month, strftime(date, '%Y-%m-01') AS day, level FROM s ORDER BY date DESC LIMIT 6")
def tail_months(spark, sf_dir):
    rows = _shipped(spark, sf_dir).orderBy(F.desc("date")).limit(6)
    return rows.select(F.date_format("date", "yyyy-MM").alias("month"), F.date_format("date", "yyyy-MM-01").alias("day"), "level")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'stored' ELSE 'new' END AS origin FROM customer")
def insert_if_absent(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select("c_custkey")
    return ingest.insert_if_absent(keys.withColumn("origin", F.lit("new")), keys.filter("c_custkey % 2 = 0").withColumn("origin", F.lit("stored")), ["c_custkey"])


@query("SELECT true AS updated, c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE 'stored' END AS origin FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0 UNION ALL SELECT false, c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'stored' ELSE 'new' END FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def upsert_flagged(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select("c_custkey")
    new, stored = keys.filter("c_custkey % 3 = 0").withColumn("origin", F.lit("new")), keys.filter("c_custkey % 2 = 0").withColumn("origin", F.lit("stored"))
    return ingest.pages([ingest.upsert(new, stored, ["c_custkey"], update).select(F.lit(update).alias("updated"), "c_custkey", "origin") for update in (True, False)])


@query("WITH k AS (SELECT user_id, max(event_id) FILTER (event_type = 'error') AS seen FROM events GROUP BY 1) SELECT e.user_id, e.event_id FROM events e JOIN k USING (user_id) WHERE k.seen IS NULL OR e.event_id > k.seen")
def take_until_seen(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", (-F.col("event_id")).alias("place"), (F.col("event_type") == "error").alias("known"))
    return ingest.until_seen(rows, ["user_id"], "place", "known").select("user_id", "event_id")


@query("SELECT event_id, event_type FROM events")
def union_pages(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return ingest.pages([rows.filter(F.col("event_id") % 4 == i) for i in range(4)])


@query("SELECT event_id, cast(json_extract_string(props, '$.k') AS INT) AS k, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS zulu, epoch(date_trunc('second', ts))::BIGINT AS seconds FROM events")
def json_path_extract(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("p", F.from_json("props", "struct<k:int>"))
    zulu = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.select("event_id", "p.k", zulu.alias("zulu"), F.unix_timestamp(F.to_timestamp(zulu, "yyyy-MM-dd'T'HH:mm:ssX")).alias("seconds"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 3 THEN '' WHEN n_nationkey % 4 = 2 THEN 'R' || n_regionkey || ',' || n_name ELSE n_name END AS codes FROM nation")
def xml_normalise(spark, sf_dir):
    """The same committees from JSON lists, JSON objects, XML with one or two items, and an empty list."""
    key, name = F.col("n_nationkey") % 4, F.col("n_name")
    item = F.concat(F.lit('{"systemCode":"'), name, F.lit('"}'))
    two = F.concat(F.lit("<c><item><systemCode>R"), F.col("n_regionkey").cast("string"), F.lit("</systemCode></item><item><systemCode>"), name, F.lit("</systemCode></item></c>"))
    raw = F.when(key == 0, F.concat(F.lit("["), item, F.lit("]"))).when(key == 1, F.concat(F.lit('{"item":['), item, F.lit("]}"))).when(key == 2, two).otherwise("[]")
    rows = table(spark, sf_dir, "nation").select("n_nationkey", raw.alias("raw"))
    from_xml = sources.normalised(F.when(F.col("raw").startswith("<"), F.col("raw")), f"item {sources.EXT}")["item"]
    codes = F.coalesce(from_xml, sources.committees_of(F.when(~F.col("raw").startswith("<"), F.col("raw"))))
    return rows.select("n_nationkey", F.array_join(F.transform(codes, lambda c: c["systemCode"]), ",").alias("codes"))


@query("SELECT c_mktsegment, count(*) AS n, count(DISTINCT code) AS customers FROM (SELECT unnest([o_custkey, o_custkey % 100 + 1]) AS code FROM orders) JOIN customer ON code = c_custkey GROUP BY 1 HAVING count(*) > 0")
def explode_join_group(spark, sf_dir):
    """Lists of codes met with their customers; a code without one would raise."""
    rows = table(spark, sf_dir, "orders").select(F.explode(F.array(F.col("o_custkey"), F.col("o_custkey") % 100 + 1)).alias("code"))
    rows = ingest.looked_up(rows, "code", table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    return rows.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("code").alias("customers")).filter("n > 0")


@query("SELECT c_custkey, n_name AS own, coalesce(CASE WHEN n_nationkey % 2 = 0 THEN r_name END, n_name) AS found FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def own_or_parent_lookup(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    codes = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("code"), F.col("r_name").alias("found")).unionByName(nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("code"), F.col("n_name").alias("found")))
    parent = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("r"), F.col("n_regionkey").cast("string")))
    own = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return hierarchy.own_or_parent(rows, own, parent, codes, "code").select("c_custkey", F.col("n_name").alias("own"), "found")


_EDGES = "e AS (SELECT 'c' || c_custkey AS node, 'n' || c_nationkey AS parent FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'r' || r_regionkey, 'world' FROM region)"


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = lambda t, a, b, x, y: table(spark, sf_dir, t).select(F.concat(F.lit(x), F.col(a).cast("string")).alias("node"), (F.concat(F.lit(y), F.col(b).cast("string")) if b else F.lit(y)).alias("parent"))
    return ingest.pages([pair("customer", "c_custkey", "c_nationkey", "c", "n"), pair("nation", "n_nationkey", "n_regionkey", "n", "r"), pair("region", "r_regionkey", None, "r", "world")])


@query(f"WITH RECURSIVE {_EDGES}, t AS (SELECT node, parent AS ancestor, 1 AS distance FROM e UNION ALL SELECT t.node, e.parent, t.distance + 1 FROM t JOIN e ON t.ancestor = e.node) SELECT node, ancestor, cast(distance AS BIGINT) AS distance FROM t")
def hierarchy_closure(spark, sf_dir):
    return hierarchy.closure(_edges(spark, sf_dir))


@query(f"WITH {_EDGES} SELECT node, 'world' AS root FROM e UNION ALL SELECT 'world', 'world'")
def hierarchy_roots(spark, sf_dir):
    return hierarchy.roots_of(_edges(spark, sf_dir))


@query("SELECT r_name AS parent, string_agg(n_name, ',' ORDER BY n_name) AS children, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1")
def children_list(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return hierarchy.children(rows.withColumnRenamed("r_name", "parent"), "parent", "n_name")


@query("SELECT user_id, arg_max(event_type, event_id) FILTER (event_type <> 'click') AS kind, arg_max(value, event_id) FILTER (value > 50) AS value FROM events GROUP BY 1")
def node_last_nonnull(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") != "click", F.col("event_type")).alias("kind"), F.when(F.col("value") > 50, F.col("value")).alias("value"))
    return hierarchy.merged(rows, "user_id", "event_id", ["kind", "value"])


@query("SELECT r_name, count(n_nationkey) AS items, count(CASE WHEN n_nationkey % 2 = 0 THEN 1 END) AS built FROM region LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 4) n ON n_regionkey = r_regionkey GROUP BY 1")
def theme_counts(spark, sf_dir):
    out = catalog.theme_counts(table(spark, sf_dir, "region"), "r_regionkey", table(spark, sf_dir, "nation").filter("n_regionkey <> 4"), "n_regionkey", F.col("n_nationkey") % 2 == 0)
    return out.join(table(spark, sf_dir, "region"), "r_regionkey").select("r_name", "items", "built")


@query("SELECT l_suppkey, string_agg(cast(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS related FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) GROUP BY 1")
def related_ordered(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct().withColumn("place", F.col("l_partkey"))
    return catalog.related(rows, "l_suppkey", "place", "l_partkey")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN 'in-progress' WHEN n_nationkey % 3 = 0 THEN 'built' ELSE 'idea' END AS status FROM nation")
def override_default(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_nationkey")
    overrides = nation.filter("n_nationkey % 5 = 0").select(F.col("n_nationkey").alias("id"), F.lit("in-progress").alias("status"))
    return catalog.with_default(nation, "n_nationkey", overrides, nation.filter("n_nationkey % 3 = 0").select(F.col("n_nationkey").alias("id")))


@query("SELECT n_name, n_regionkey || '.' || row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS id FROM nation")
def ordinal_ids(spark, sf_dir):
    return catalog.numbered(table(spark, sf_dir, "nation"), "n_regionkey", ["n_nationkey"]).select("n_name", "id")


@query("SELECT n_name, CASE WHEN n_nationkey < 3 THEN 'I' WHEN n_nationkey < 11 THEN 'II' WHEN n_nationkey < 13 THEN 'III' ELSE 'IV' END AS theme FROM nation")
def positional_groups(spark, sf_dir):
    groups = spark.createDataFrame([(i, t, n) for i, (t, n) in enumerate(THEMES)], "place int, theme string, size int")
    return catalog.by_position(table(spark, sf_dir, "nation"), "n_nationkey", groups, "theme", "size", "place").select("n_name", "theme")


@query("SELECT brand, cast(row_number() OVER (ORDER BY split_part(brand, '#', 1), cast(split_part(brand, '#', 2) AS INT)) AS INT) AS place FROM (SELECT DISTINCT p_brand AS brand FROM part)")
def natural_sort_key(spark, sf_dir):
    from pyspark.sql import Window

    # a row per brand: a few dozen, whatever the number of parts
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand")).distinct()
    return brands.withColumn("place", F.row_number().over(Window.orderBy(*fn.natural_key(F.col("brand"), "#"))))


#: The characters that functions.BLANK trims, as SQL.
_BLANK = "'" + fn.BLANK + "'"
_WS = "[" + "".join(rf"\x{{{ord(c):X}}}" for c in fn.BLANK) + "]"


@query(rf"""SELECT page_id, split_part(trim(html, {_BLANK}), chr(10), 1) AS summary, nullif(split_part(regexp_extract(url, '^https?://[^/?#]+(/[^?#]*)', 1), '/', 2), '') AS owner,
regexp_replace(replace(url, 'http://', 'https://'), '/+$', '') AS secure FROM pages""")
def text_summary(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", fn.first_line(F.col("html")).alias("summary"), fn.owner_of(F.col("url")).alias("owner"), F.regexp_replace(F.replace("url", F.lit("http://"), F.lit("https://")), "/+$", "").alias("secure"))


@query(r"""SELECT n_nationkey, CASE WHEN length(n_name) BETWEEN 3 AND 8 THEN '**' || n_name || ':** rest of it' ELSE n_name || ': rest of it' END AS text FROM nation""")
def bold_labels(spark, sf_dir):
    text = F.concat("n_name", F.when(F.length("n_name") <= 8, ": ").otherwise(":"), F.when(F.length("n_name") <= 8, "rest of it").otherwise(" rest of it"))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.length("n_name") <= 8, fn.label_prefix(text)).otherwise(text).alias("text"))


#: Lines with an introduction, labels, tabs and blanks, which the documents do not have all.
_NOTES = ["one line \u00a0", "Intro:\n\tdeep: and more\n\nMore:\nlast one\r\n", "\tIntro:\nCost: a.b: c", " \n\t", "first\n\t\ttwo deep\nLong label here: text: again", ""]


@query(rf"""WITH d AS (SELECT doc_id, 0 AS note, coalesce(text, '') AS text FROM documents UNION ALL SELECT r_regionkey, i, t FROM region, (SELECT unnest([{", ".join(chr(39) + n + chr(39) for n in _NOTES)}]) AS t, unnest(range(1, {len(_NOTES) + 1})) AS i)),
l AS (SELECT doc_id, note, rtrim(x, {_BLANK}) AS x, i FROM (SELECT doc_id, note, unnest(str_split(text, chr(10))) AS x, generate_subscripts(str_split(text, chr(10)), 1) AS i FROM d)),
b AS (SELECT doc_id, note, x, trim(x, {_BLANK}) AS t, row_number() OVER (PARTITION BY doc_id, note ORDER BY i) AS i, count(*) OVER (PARTITION BY doc_id, note) AS n FROM l WHERE trim(x, {_BLANK}) <> ''),
o AS (SELECT doc_id, note, i, CASE WHEN n = 1 THEN t WHEN i = 1 AND x NOT LIKE chr(9) || '%' AND t LIKE '%:' THEN t || chr(10)
ELSE repeat('  ', length(x) - length(ltrim(x, chr(9)))) || '- ' || regexp_replace(t, '^([^:.]{{3,60}}):{_WS}+(.+)$', '**\1:** \2', 's') END AS y FROM b),
j AS (SELECT doc_id, note, string_agg(y, chr(10) ORDER BY i) AS bullets FROM o GROUP BY 1, 2)
SELECT d.doc_id, cast(d.note AS INT) AS note, coalesce(j.bullets, '') AS bullets FROM d LEFT JOIN j USING (doc_id, note)""")
def markdown_bullets(spark, sf_dir):
    notes = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("doc_id"), F.posexplode(F.array(*map(F.lit, _NOTES))).alias("note", "text")).withColumn("note", F.col("note") + 1)
    rows = table(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("note"), "text").unionByName(notes)
    return rows.select("doc_id", "note", fn.bullets(F.coalesce("text", F.lit(""))).alias("bullets"))


@query("""SELECT r_regionkey, '---' || chr(10) || 'title: "' || r_name || '"' || chr(10) || CASE WHEN r_regionkey % 2 = 0 THEN 'order: ' || r_regionkey || chr(10) ELSE '' END || '---' AS head FROM region""")
def front_matter(spark, sf_dir):
    return table(spark, sf_dir, "region").select("r_regionkey", fn.front_matter(title=F.col("r_name"), order=F.when(F.col("r_regionkey") % 2 == 0, F.col("r_regionkey"))).alias("head"))


@query("""SELECT n_nationkey, 'own parent' AS fault FROM nation WHERE n_nationkey = n_regionkey OR n_regionkey = 0
UNION ALL SELECT n.n_nationkey, 'unknown parent' FROM nation n WHERE n.n_regionkey + n.n_nationkey NOT IN (SELECT n_nationkey FROM nation) AND n.n_nationkey <> n.n_regionkey
UNION ALL SELECT n_nationkey, 'bad value' FROM nation WHERE n_regionkey NOT IN (0, 1, 2)""")
def graph_validation(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").withColumn("parent", F.when(F.col("n_nationkey") == F.col("n_regionkey"), F.col("n_nationkey")).otherwise(F.col("n_regionkey") + F.col("n_nationkey")))
    return hierarchy.faults(rows.withColumn("kind", F.col("n_regionkey").cast("string")), "n_nationkey", "parent", "kind", ["0", "1", "2"])


@query("SELECT DISTINCT p_type AS id FROM part")
def route_ids(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_type").alias("id")).distinct()


@query("SELECT l_orderkey, l_linenumber, l_partkey, max(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2, 3")
def last_by_id(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("k"), F.col("l_extendedprice").alias("price"))
    return ingest.last_by_id(rows.withColumn("place", F.col("price")), "k", "place").select("k.*", "price")


@query("SELECT event_id, event_type FROM events")
def ingest_stream(spark, sf_dir):
    """Two overlapping drops of events, taken in by a stream one after the other: each id once."""
    at = f"{_scratch(spark)}/{uuid.uuid4()}"
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    for drop in (rows.filter("event_id % 3 <> 0"), rows.filter("event_id % 3 <> 1")):
        drop.write.mode("append").parquet(f"{at}/drops")
        streaming.ingest(spark, f"{at}/drops", "event_id long, event_type string", "event_id", f"{at}/store", f"{at}/progress")
    return spark.read.schema("event_id long, event_type string").parquet(f"{at}/store")


def queries() -> dict[str, Query]:
    from ledgerlark.plans import domain  # noqa: F401  its queries add themselves

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_sql)
