"""Edge rows of the operators' semantics."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlark import __main__ as jobs
from ledgerlark import functions as fn
from ledgerlark import sources
from ledgerlark.operators import catalog, documents, facets, hierarchy, ingest, periods, timeseries


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


PERIODS = [(118, "2023-01-03", "2025-01-03", "Red", "Blue"), (119, "2025-01-03", "present", "Red", "Red")]
VIDEOS = [
    ("v1", "2025-01-02T23:59:59Z", "Markup", "line\n\n(EventID=118543)"),
    ("v2", "2025-01-03T00:00:00Z", "Hearing", "none"),
    ("v3", "2025-01-03", "Hearing 123456", ""),
    ("v4", "2025-06-01T00:00:00Z", "EVENTID", "12345"),
    ("v5", "2025-06-01T00:00:00Z", "x", "12345"),
    ("v6", "2025-06-01T00:00:00Z", "x", "a 1234567 b"),
    ("v7", "2025-06-01T00:00:00Z", "x", "１２３４５６"),
    ("v8", "1998-01-01T00:00:00Z", "x", "y"),
    ("v9", "2025-06-01T00:00:00Z", None, None),
]


@pytest.fixture
def videos(spark):
    return spark.createDataFrame(VIDEOS, "id string, at string, title string, description string").withColumn("handle", F.lit("@a"))


def test_coverage_and_reconcile(spark, videos):
    dim = periods.periods(spark, PERIODS, "2025-12-31")
    tagged = fn.has_event_id(F.col("description"), F.col("title"))
    rows = {r.period: (r.total, r.missing, r.control) for r in periods.coverage(videos, dim, ["handle"], F.col("at"), tagged).collect()}
    assert rows == {118: (2, 0, "Red"), 119: (7, 3, "Red")}
    got = periods.reconcile(videos, dim, ["handle"], F.col("at"))
    assert got.first()[1:] == (9, 9, 1)
    with pytest.raises(Exception, match="outside"):
        periods.check_reconciled(got.withColumn("in_periods", F.lit(8).cast("long"))).collect()
    senate = periods.coverage(videos, dim, ["handle"], F.col("at"), tagged, "senate").filter("period = 118").first()
    assert senate.control == "Blue"


def test_empty_period_counts_zero(spark, videos):
    dim = periods.periods(spark, [(1, "1900-01-01", "1901-01-01", "a", "b")], "2025-12-31")
    assert periods.coverage(videos, dim, ["handle"], F.col("at"), F.lit(True)).first()[1:4] == (1, 0, 0)


def test_periods_from_json(spark):
    raw = spark.createDataFrame([('{"118":{"start":"2023-01-03","end":"present","house":"R","senate":"D"}}',)], "j string")
    assert periods.periods_from_json(raw, "j", "2024-05-05").first().end == "2024-05-05"


@pytest.mark.parametrize(("n", "want"), [(1, "1st"), (2, "2nd"), (3, "3rd"), (11, "11th"), (12, "12th"), (113, "113th"), (101, "101st"), (120, "120th")])
def test_ordinal(spark, n, want):
    assert one(spark, fn.ordinal(F.lit(n))) == want


def test_rounding_is_scaled_half_even(spark):
    assert one(spark, fn.round4(F.lit(1.00005))) == 1.0001


@pytest.mark.parametrize(("text", "want"), [("12", 12.0), (" 3.5 ", 3.5), ("-", None), ("", None), ("1.5d", None), ("NaN", None), ("inf", None), (None, None)])
def test_to_number(spark, text, want):
    assert one(spark, fn.to_number(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(("y", "want"), [(2020.5, "2020-07-01"), (1990.0, "1990-01-01"), (2021.9999, "2022-01-01"), (2024.9999, "2024-12-31")])
def test_float_year_date(spark, y, want):
    assert str(one(spark, fn.float_year_date(F.lit(y)))) == want


@pytest.mark.parametrize(("top", "want"), [(0, 0.5), (1, 0.5), (4, 1.0), (5, 2.0), (5602, 2000.0), (4000, 1000.0)])
def test_tick_step(spark, top, want):
    assert one(spark, fn.tick_step(F.lit(top))) == want
    assert one(spark, fn.ticks(F.lit(top))) == pytest.approx([i * want for i in range(int(max(top, 1) // want) + 1)])


def test_text(spark):
    assert one(spark, fn.label_prefix(F.lit("Cost: a\nb"))) == "**Cost:** a\nb"
    assert one(spark, fn.label_prefix(F.lit("a.b: c"))) == "a.b: c"
    assert one(spark, fn.bullets(F.lit("Intro:\n\tdeep \n\nlast\r\n"))) == "Intro:\n\n  - deep\n- last"
    assert one(spark, fn.bullets(F.lit(" \u00a0one line: x \n\n"))) == "one line: x"
    assert one(spark, fn.bullets(F.lit("a\nMore:\n\t\tCost: b"))) == "- a\n- More:\n    - **Cost:** b"
    assert one(spark, fn.bullets(F.lit("\tIntro:\nb"))) == "  - Intro:\n- b"
    assert one(spark, fn.bullets(F.lit("Intro:\n"))) == "Intro:" and one(spark, fn.bullets(F.lit("\n \t"))) == ""
    assert one(spark, fn.first_line(F.lit("\n first \nsecond"))) == "first "
    assert [one(spark, fn.has_event_id(F.lit(x))) for x in ("EVENTİD", "eventıd", "EventId", "１２３４５６", "12345", "event id")] == [True, True, True, True, False, False]
    assert one(spark, fn.number_or_zero(F.lit(" "))) == 0.0 and one(spark, fn.number_or_zero(F.lit("x"))) is None
    assert one(spark, fn.rounded_up(F.lit(2.5))) == 3 and one(spark, fn.rounded_up(F.lit(-2.5))) == -2
    assert one(spark, fn.parties(F.array(F.lit("Democratic"), F.lit("Republican / Democratic")))) == "D/R"
    assert one(spark, fn.title_case(F.lit("hOUSE"))) == "HOUSE"
    assert one(spark, fn.percent(F.lit(1), F.lit(0))) == 0.0
    ids = spark.createDataFrame([("IV.10",), ("IV.9",), ("I.2",)], "id string").orderBy(*fn.natural_key(F.col("id"), "."))
    assert [r.id for r in ids.collect()] == ["I.2", "IV.9", "IV.10"]


def test_blend(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 3.0), (None, 2.5, 1.25), (None, None, None), (1.00005, None, None)], "a double, b double, c double")
    assert [r.x for r in rows.select(timeseries.blend(["a", "b", "c"], {"a": 2.0}).alias("x")).collect()] == [1.75, 1.875, None, 1.0001]
    assert rows.select(timeseries.blend(["a"], {"a": 0.0}).alias("x")).first().x is None
    assert timeseries.parse_weights(" a=2,,b = 0.5") == {"a": 2.0, "b": 0.5}
    with pytest.raises(ValueError):
        timeseries.parse_weights("a")


def test_cpi_gap_gives_no_change(spark):
    # golden values: the index of January 1913 and 1914, and of 2024-10 and 2025-10, of which the last was never published
    rows = spark.createDataFrame([(dt.date(1913, 1, 1), 9.8), (dt.date(1914, 1, 1), 10.0), (dt.date(2024, 10, 1), 315.664)], "date date, level double")
    assert [(str(r.date), r.yoy) for r in timeseries.year_over_year(timeseries.spine(rows), "level").collect()] == [("1914-01-01", 2.0408)]


def test_grid(spark):
    rows = spark.createDataFrame([(2024, "January", 1.0), (2024, "Annual", 9.0), (2023, "March", 2.0)], "y int, m string, v double")
    grid = timeseries.pivot_grid(rows, "y", "m", "v")
    assert grid.columns == ["year", *fn.MONTHS]
    long = timeseries.unpivot_grid(grid)
    assert long.count() == 24 and long.filter("level is not null").count() == 2
    with pytest.raises(Exception, match="two values"):
        timeseries.pivot_grid(rows.unionAll(rows), "y", "m", "v").collect()


def test_keep_last_replaces_whole_rows(spark):
    old = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0)], "k int, a double, b double")
    new = spark.createDataFrame([(1, 9.0, None)], "k int, a double, b double")
    assert sorted(map(tuple, timeseries.keep_last([old, new], ["k"]).collect())) == [(1, 9.0, None), (2, 3.0, 4.0)]
    twice = new.unionAll(spark.createDataFrame([(1, 5.0, 1.0)], "k int, a double, b double")).withColumn("line", F.when(F.col("a") == 5, 2).otherwise(1))
    assert timeseries.keep_last([old.withColumn("line", F.lit(9)), twice], ["k"], "line").filter("k = 1").first()[:3] == (1, 5.0, 1.0)


def test_grid_may_have_to_be_complete(spark):
    rows = spark.createDataFrame([(2024, m, 1.0) for m in fn.MONTHS[:11]], "y int, m string, v double")
    assert timeseries.pivot_grid(rows, "y", "m", "v").first()["December"] is None
    with pytest.raises(KeyError, match="December"):
        timeseries.pivot_grid(rows, "y", "m", "v", complete=True)


def test_resample_takes_last_line_of_ties(spark):
    rows = spark.createDataFrame([(dt.date(2024, 1, 31), 1.0, 0), (dt.date(2024, 1, 31), 2.0, 1), (dt.date(2024, 1, 2), 3.0, 2), (dt.date(2024, 2, 1), None, 3)], "d date, v double, line int")
    assert [tuple(r) for r in timeseries.resample_last(rows, F.col("d"), "v", "line").collect()] == [(dt.date(2024, 1, 1), 2.0)]


def test_align_raises_on_two_values(spark):
    s = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0)], "date date, a double")
    assert timeseries.align({"z": s.withColumnRenamed("a", "z"), "a": s}, ["a"]).columns == ["date", "a", "z"]
    with pytest.raises(Exception, match="two values"):
        timeseries.align({"a": s.unionAll(s)}, ["a"]).collect()


def test_facets(spark):
    rows = spark.createDataFrame([("a", "x", 0), ("a", "y", 2), ("b", "x", 1)], "k string, f string, n int")
    assert facets.totals(rows.filter("false"), F.col("n"), F.col("n")).first()[:] == (0, 0, 0)
    live = {(r.facet, r.value): r.live for r in facets.liveness(rows, {"k": "a", "f": "all"}, F.col("n")).collect()}
    assert live == {("k", "a"): True, ("k", "b"): True, ("f", "x"): False, ("f", "y"): True}
    assert [r.k for r in facets.leaderboard(rows, "k", F.col("n"), F.lit(0), 1).collect()] == ["a"]


def test_ingest(spark):
    pages = spark.createDataFrame([("n3", 0, False), ("n2", 1, False), ("v1", 2, True), ("n0", 3, False)], "id string, at int, known boolean").withColumn("h", F.lit("a"))
    assert [r.id for r in ingest.until_seen(pages, ["h"], "at", "known").orderBy("at").collect()] == ["n3", "n2"]
    store = spark.createDataFrame([("v1", "old")], "id string, v string")
    new = spark.createDataFrame([("v1", "new"), ("v2", "a"), ("v2", "b")], "id string, v string")
    assert sorted(map(tuple, ingest.insert_if_absent(new, store, ["id"]).collect())) == [("v1", "old"), ("v2", "a")]
    assert sorted(map(tuple, ingest.upsert(new, store, ["id"], True).collect())) == [("v1", "new"), ("v2", "a")]


def test_lookups(spark):
    cache = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    asked = []

    def fetch(missing):
        asked.append(sorted(r.k for r in missing.collect()))
        return missing.withColumn("v", F.lit(9))

    want = spark.createDataFrame([("a",), ("c",)], "k string")
    assert sorted(map(tuple, ingest.read_through(want, cache, "k", fetch).collect())) == [("a", 1), ("b", 2), ("b", 3), ("c", 9)]
    with pytest.raises(ValueError):
        ingest.read_through(want.unionAll(spark.createDataFrame([("b",)], "k string")), cache, "k", fetch)
    ingest.read_through(spark.createDataFrame([("b",), ("a",)], "k string"), cache, "k", fetch, force=True)
    assert asked == [["c"], ["a", "b"]]
    with pytest.raises(Exception, match="no entry for z"):
        ingest.looked_up(spark.createDataFrame([("z",)], "x string"), "x", cache, "k").collect()
    answers = "id int, at int, attempt int, status int, body string"
    rows = spark.createDataFrame([(1, 1, 1, 200, "a"), (2, 2, 1, 500, "x"), (2, 2, 2, 200, "b"), (3, 3, 1, 429, None), (4, 4, 1, 200, "c")], answers)
    assert dict(map(tuple, ingest.answered(rows, "id", "at").collect())) == {1: "a", 2: "b"}
    for bad in ([(1, 1, 1, 404, "x")], [(1, 1, 1, 500, "x"), (1, 1, 2, 500, "x")]):
        with pytest.raises(Exception, match="lookup failed"):
            ingest.answered(spark.createDataFrame(bad, answers), "id", "at").collect()


def test_documents(spark):
    rows = spark.createDataFrame([(1, "II", "https://a.b/c", 2.0, "x", None), (2, "VI", "nope", 2.5, None, "y"), (3, None, None, 1.0, "x", None)], "id int, theme string, repo string, n double, title string, focus string")
    rules = {"theme": documents.one_of("I", "II"), "repo": documents.optional(documents.is_url), "n": documents.is_int, "title": documents.given}
    assert sorted(map(tuple, documents.violations(rows, "id", rules).collect())) == [(2, "n"), (2, "repo"), (2, "theme"), (2, "title"), (3, "theme")]
    assert documents.require(rows.filter("id = 1"), "id", rules).count() == 1
    with pytest.raises(Exception, match="bad row: [23]"):
        documents.require(rows, "id", rules).collect()
    names = spark.createDataFrame([("a", 0), ("b", 1)], "name string, position int")
    assert documents.selected(names, name="b").first().position == 1 and documents.selected(names).count() == 2
    for wrong, kind in (({"name": "z"}, IndexError), ({"index": 2}, ValueError), ({"index": -1}, ValueError), ({"name": "a", "index": 0}, ValueError)):
        with pytest.raises(kind):
            documents.selected(names, **wrong)
    with pytest.raises(TypeError, match="colour"):
        documents.from_service(spark.createDataFrame([("a", "b")], "systemCode string, colour string"))
    with pytest.raises(Exception, match="committeeMeeting"):
        one(spark, documents.meeting(F.lit('{"x":1}'), "a:string"))


def test_registry(spark):
    ddl = "code string, at int, name string, chamber string, parent struct<code:string,name:string>"
    rows = spark.createDataFrame([("c", 1, "child", "house", ("p", "stub")), ("p", 2, None, None, None), ("c", 3, None, "senate", None), ("d", 4, "dee", "house", ("p", "Parent"))], ddl)
    got = {r.code: (r.name, r.chamber, r.parent) for r in hierarchy.registry(rows, "code", "at", ["name", "chamber"], "parent", ["chamber"]).collect()}
    assert got == {"c": ("child", "senate", None), "p": ("Parent", "house", None), "d": ("dee", "house", "p")}
    with pytest.raises(Exception, match="own parent"):
        hierarchy.registry(spark.createDataFrame([("a", 1, "n", "h", ("a", "n"))], ddl), "code", "at", ["name"], "parent").collect()
    nodes = hierarchy.registry(rows, "code", "at", ["name", "chamber"], "parent")
    with pytest.raises(KeyError):
        hierarchy.linked(nodes, spark.createDataFrame([("zz", "p")], "code string, parent string"), "code")
    assert sorted(r.code for r in hierarchy.roots(nodes).collect()) == ["c", "p"]


def test_hierarchy(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", None), ("s", "s")], "node string, parent string")
    assert sorted(map(tuple, hierarchy.closure(edges).collect())) == [("a", "b", 1), ("a", "c", 2), ("b", "c", 1)]
    assert dict(map(tuple, hierarchy.roots_of(edges).collect())) == {"a": "c", "b": "c", "c": "c", "s": "s"}
    cycle = spark.createDataFrame([("a", "b"), ("b", "a")], "node string, parent string")
    assert hierarchy.closure(cycle, levels=4).count() == 4
    rows = spark.createDataFrame([("x", 0, "p", None), ("x", 1, None, "q")], "k string, at int, f string, g string")
    assert tuple(hierarchy.merged(rows, "k", "at", ["f", "g"]).first()) == ("x", "p", "q")


def test_hierarchy_without_a_limit(spark):
    deep = spark.createDataFrame([(i, i - 1 if i else None) for i in range(71)], "node int, parent int")
    assert hierarchy.closure(deep).count() == 71 * 70 // 2
    assert {r.root for r in hierarchy.roots_of(deep).collect()} == {0}
    for n in (2, 3, 40):
        cycle = spark.createDataFrame([(i, (i + 1) % n) for i in range(n)], "node int, parent int")
        with pytest.raises(ValueError):
            hierarchy.closure(cycle)


def test_positions_beyond_sizes_raise(spark):
    groups = spark.createDataFrame([(0, "I", 1)], "place int, theme string, size int")
    with pytest.raises(Exception, match="more rows"):
        catalog.by_position(spark.range(2).withColumnRenamed("id", "n"), "n", groups, "theme", "size", "place").collect()


def test_sources(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Date , YOY_PCT\n2024-02-20,2\n2024-01-31,1\n2024-02-20,3\n2024-03-01,-\n")
    assert sorted(map(str, (r.adobe for r in sources.manual_series(spark, str(tmp_path / "m.csv"), "adobe").collect()))) == ["1.0", "3.0"]
    (tmp_path / "f.csv").write_text("observation_date,X\n2024-01-15,.\n2024-02-01,4.5\n")
    assert [r.fred for r in sources.by_place(spark, str(tmp_path / "f.csv"), "fred").collect()] == [4.5]
    (tmp_path / "bad.csv").write_text("date,value\nnot a date,1\n")
    bad = sources.Source("bad", ("bad",), lambda s: sources.manual_series(s, str(tmp_path / "bad.csv"), "bad"))
    ok = sources.Source("ok", ("ok",), lambda s: sources.by_place(s, str(tmp_path / "f.csv"), "ok"))
    series, status = sources.gather(spark, [bad, ok])
    assert list(series) == ["ok"] and {r.source: r.status for r in status.collect()} == {"bad": "ERROR", "ok": "OK"}
    assert not sources.write_csv(spark.range(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    (tmp_path / "IV.1.md").write_text('---\ntitle: "A: b"\norder: 2\n---\nBody\n')
    row = sources.read_markdown(spark, str(tmp_path / "*.md")).first()
    assert (row.id, row.fields, row.body) == ("IV.1", {"title": "A: b", "order": "2"}, "Body\n")
    for wrong in (("lords",), ("house", 120), ("house", 99)):
        with pytest.raises(ValueError):
            sources.check_chamber(*wrong)
    sources.check_chamber("senate", 119)
    (tmp_path / "p.json").write_text('{"events":[{"id":1},{"id":2}],"bills":[{"id":3}],"pagination":{"next":null},"request":{}}')
    assert sorted(map(tuple, sources.read_pages(spark, str(tmp_path / "p.json"), "id:int").collect())) == [("bills", 3), ("events", 1), ("events", 2)]
    (tmp_path / "q.json").write_text('{"events":{"id":1},"pagination":{}}')
    with pytest.raises(Exception, match="no list: events"):
        sources.read_pages(spark, str(tmp_path / "q.json"), "id:int").collect()
    with pytest.raises(Exception, match="api-root"):
        one(spark, sources.api_document(F.lit("<html></html>"), "a string"))
    with pytest.raises(ValueError):
        sources.read_store(spark, str(tmp_path), 7, "videos", "id:string", assert_exists=True)
    assert sources.report_state(spark, str(tmp_path / "nothing.csv")) == ("error", None)
    out = tmp_path / "md"
    sources.write_markdown(spark.createDataFrame([("IV.2", "body\n\n \t"), ("V.1", "x")], "id string, body string"), str(out))
    assert {f.name: f.read_text() for f in out.iterdir()} == {"IV.2.md": "body\n", "V.1.md": "x\n"}
    with pytest.raises(ValueError):
        sources.credential(None, "NO_SUCH_KEY_HERE", ".no-such-file-here")


def test_a_fault_of_spark_is_no_fault_of_a_source(spark):
    def lost(s):
        raise PySparkException("executor lost")

    with pytest.raises(PySparkException):
        sources.gather(spark, [sources.Source("lost", ("x",), lost)])


def test_accounts(spark, tmp_path):
    (tmp_path / "a.csv").write_text('committee,systemCode,handle,secondary\nAgriculture,hsag00,@AgRepublicans,@HouseAgDems\n"Science,Space",hssy00,@housescience,\nDup,hsag00,@Dup,\n')
    got = sorted(map(tuple, sources.read_accounts(spark, str(tmp_path / "a.csv")).collect()))
    assert got == [("hsag00", 0, "Dup", ["@Dup", ""]), ("hssy00", 1, "Science,Space", ["@housescience", ""])]
    assert sorted(r.handle for r in sources.handles_of(sources.read_accounts(spark, str(tmp_path / "a.csv"))).collect()) == ["@Dup", "@housescience"]


def test_jobs(spark, tmp_path):
    """The command lines from files to files."""
    (tmp_path / "a.csv").write_text("committee,systemCode,handle,secondary\nAgriculture,hsag00,@a,@b\nScience,hssy00,@c,\n")
    (tmp_path / "p.json").write_text('{"118":{"start":"2023-01-03","end":"2025-01-03","house":"Red","senate":"Blue"}}')
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "1.json").write_text('{"snippet":{"title":"t","description":"EventID 1","publishedAt":"2024-01-01T00:00:00Z","resourceId":{"videoId":"v1"}}}\n')
    store, out = str(tmp_path / "store"), tmp_path / "out"
    for _ in range(2):
        jobs.main(["fetch", "--landed", str(landed), "--store", store], spark)
    assert spark.read.parquet(store).count() == 1
    jobs.main(["fetch", "--landed", str(landed), "--store", store, "--force"], spark)
    spark.read.parquet(store).withColumn("handle", F.lit("@b")).write.parquet(str(tmp_path / "videos"))
    jobs.main(["coverage", "--accounts", str(tmp_path / "a.csv"), "--periods", str(tmp_path / "p.json"), "--videos", str(tmp_path / "videos"), "--as-of", "2025-06-30", "--output", str(out), "-n", "Agriculture", "--strict"], spark)
    assert [tuple(r) for r in spark.read.csv(str(out), header=True).collect()] == [("Agriculture", "@b", "118", "1", "0", "Red", "house")]
    (tmp_path / "e.json").write_text('{"7":{"api-root":{"committeeMeeting":{"committees":{"item":[{"systemCode":"hsag00"}]}}}},"8":{"committeeMeeting":{"committees":[{"systemCode":"hsag00"},{"systemCode":"hssy00"}]}}}')
    jobs.main(["events", "--events", str(tmp_path / "e.json"), "--accounts", str(tmp_path / "a.csv"), "--output", str(out)], spark)
    assert [tuple(r) for r in spark.read.csv(str(out), header=True).collect()] == [("hsag00", "Agriculture", "2"), ("hssy00", "Science", "1")]
    (tmp_path / "s.csv").write_text("date,yoy\n2024-01-31,1\n2024-02-28,3\n")
    (tmp_path / "r.csv").write_text("date,yoy\n2024-02-28,1\n")
    jobs.main(["inflation", "--series", f"a={tmp_path}/s.csv", f"b={tmp_path}/r.csv", "--weights", "a=3", "--output", str(out)], spark)
    assert [tuple(r) for r in spark.read.csv(str(out), header=True).collect()] == [("2024-01-01", "1.0", None, "1.0"), ("2024-02-01", "3.0", "1.0", "2.5")]
    with pytest.raises(SystemExit):
        jobs.main(["inflation", "--output", str(out)], spark)
    grid = str(tmp_path / "grid")
    names = ", ".join(f"{m} double" for m in fn.MONTHS)
    sources.write_csv(spark.createDataFrame([(2022, *[1.0] * 12), (2023, *[2.0] * 12)], f"year int, {names}"), grid)
    points = ",".join(f'{{"year":"2023","periodName":"{m}","value":"{5 + i}"}}' for i, m in enumerate(fn.MONTHS))
    (tmp_path / "bls.json").write_text(f'{{"Results":{{"series":[{{"data":[{points},{{"year":"2023","periodName":"Annual","value":"-"}}]}}]}}}}')
    jobs.main(["grid", "--grid", grid, "--landed", str(tmp_path / "bls.json")], spark)
    assert [(r.year, r.January, r.December) for r in spark.read.csv(grid, header=True).orderBy("year").collect()] == [("2022", "1.0", "1.0"), ("2023", "5.0", "16.0")]
