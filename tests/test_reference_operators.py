"""Every query with SQL against DuckDB on the smallest tables, and cases for what SQL does not reach."""

import datetime as dt
import os
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from reportloom import queries_data
from reportloom.functions import grammar, numeric, text
from reportloom.operators import history, layout, lines, rules, structure, tables
from reportloom.plans import family_queries, history_queries, progress, text_queries
from reportloom.sources import files, seeds, sinks
from reportloom.streaming import incremental

MODULES = (queries_data, history_queries, text_queries, family_queries)
WITH_SQL = [(m, n) for m in MODULES for n in m.oracle_sql()]


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return c


def canonical(df):
    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "~"
        return f"{float(v):.8g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(one, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("module,name", WITH_SQL, ids=[n for _, n in WITH_SQL])
def test_query_equals_sql(spark, duck, sf, module, name):
    got = module.queries()[name](spark, sf).toPandas()
    want = duck.execute(module.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr.alias("r")).first()[0]


@pytest.mark.parametrize("s,want", [("82.2 %", 82.2), (" 100 ", 100.0), ("101", None), ("-1", None), ("nan", None), ("x", None), (None, None), ("", None), ("1e1", 10.0)])
def test_parse_pct(spark, s, want):
    assert one(spark, numeric.parse_pct(F.col("x")), s) == want


@pytest.mark.parametrize(
    "line,want",
    [
        ("7.3 Permit Log Status", True), ("21 CIV [Gate] Handing over", True), ("Dates 4 18 2 9", True), ("12.5 % 30 - 40", True), ("Actual Total Rest Actual Plan", True),
        ("Remark and Target List", True), ("", True), (None, True), ("Plan to pour concrete for unit three next week.", False),
        ("Casting the third gate wall on the 7th (21.Sep)", False), ("งานติดตั้ง", False), ("é è", False), ("12 é", False),
    ],
)
def test_table_text(spark, line, want):
    assert one(spark, text.looks_like_table(F.col("x")), line) is want


def test_small_text_functions(spark):
    x = F.col("x")
    assert one(spark, text.clean_line(x), " 1. Concrete works ongoing ") == "Concrete works ongoing"
    assert one(spark, text.clean_line(x), "- text with a dash") == "- text with a dash"
    assert [one(spark, text.clean_line(x), s) for s in ("12", "Page 3 of 9", "short", "", None)] == [None] * 5
    assert one(spark, text.norm_key(x), "Wind 2027-A") == "wind2027a"
    assert one(spark, text.split_items(x), "a; b\n\n c ;") == ["a", "b", "c"]
    assert [one(spark, text.split_items(x), s) for s in ("N/A", "-", None)] == [[], [], []]
    assert one(spark, text.escaped(x), "it's\na \\") == "it\\'s a \\\\"
    assert str(one(spark, text.folder_date(x), "28_260715")) == "2026-07-15"
    assert one(spark, text.folder_date(x), "28_26xx15") is None and one(spark, text.folder_date(x), "28") is None
    assert one(spark, numeric.letters_to_index(x), "AA") == 26 and one(spark, numeric.letters_to_index(x), "A1") is None
    assert [one(spark, numeric.shortest(x.cast("double")), v) for v in ("12.50", "3", "0.1", None)] == ["12.5", "3", "0.1", "null"]
    assert [one(spark, numeric.variance_band(x.cast("double")), v) for v in ("-5.01", "-5", "5.01", None)] == ["delayed", "neutral", "ahead", None]


def test_wordings(spark):
    def read(s, *names):
        df = spark.createDataFrame([(1, s)], "doc_id bigint, text string")
        return [tuple(r)[3:] for r in grammar.read_statements(df, ["doc_id"], "text", names).orderBy("grammar_no", "match_no").collect()]

    assert read("Overall progress stands at37.5% against the planned progress of 50%", "stands_at") == [(1, "overall", 50.0, 37.5)]
    assert read("Overall Progress =40% Ahead 1.5%\nConstruction progress = 10.1% delayed 0.2%", "delta") == [(1, "overall", 38.5, 40.0), (2, "construction", 10.3, 10.1)]
    assert read("Progress61.2%(Plan 61.38.77%, -0.18%)", "signed_delta") == [(1, "overall", 61.38, 61.2)]
    assert read("Plan / Actual :\n60% 31.07% / 29.5% (1.57%)", "callout") == [(1, "overall", 31.07, 29.5)]
    assert read("Plan/Actual：7.15%/6.4%", "pair") == [(1, "overall", 7.15, 6.4)]
    assert read("overall progress 150% compared to plan at 20%", "compared") == [(1, "overall", 20.0, None)]
    assert read("", "pair") == []


def doc(spark, *texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")


def test_sections_and_items(spark):
    src = lines.lines(doc(spark, "x\nArea of concern\n1. first item here\n\n\nsecond item here\n\n\n\nafter the blanks", None, ""))
    assert [r.line for r in lines.section(src, "(?i)concern").orderBy("line_no").collect()] == ["first item here", "second item here"]
    src = lines.lines(doc(spark, "lead in\n- one\nmore of one\n2) two\n\n•\ntail"))
    assert [(r.item_no, r.item) for r in lines.folded(src).orderBy("item_no").collect()] == [(0, "lead in"), (1, "one more of one"), (2, "two"), (3, " tail")]
    body = "○ Heading one\nplain text of it\n- a dash line\ncontinued after\n12 Owner Open\n○ Heading two\n- only dashes\n中文\n○ x"
    got = lines.heading_items(lines.lines(doc(spark, body)), r"^[○●]\s+(\S.*)$", close=r"^\d+\s+\w+\.?\s+\w+\.?\s*$").orderBy("ord").collect()
    assert [r.item for r in got] == ["Heading one — plain text of it", "Heading two — only dashes"]
    long = "○ Long heading\n" + "\n".join(["a line of exactly forty characters, yes."] * 9)
    item = lines.heading_items(lines.lines(doc(spark, long)), r"^[○●]\s+(\S.*)$").first().item
    assert item.count("forty") == 6  # taken while fewer than 220 characters were
    twice = lines.lines(doc(spark, "\n".join(["the same long line"] * 3 + [f"another line number {k}" for k in range(30)])))
    seen = lines.first_seen(twice.select("doc_id", "line_no", F.col("line").alias("item"))).orderBy("ord").collect()
    assert len(seen) == 20 and seen[0].item == "the same long line"


def test_layout(spark):
    words = [(1, 1, t, x, x + 5, top) for t, x, top in (("b", 20.0, 11.0), ("a", 10.0, 10.0), ("c", 30.0, 13.0), ("d", 10.0, 13.5), ("Area", 60.0, 30.0), ("x", 5.0, 41.0), ("item", 62.0, 40.0))]
    w = spark.createDataFrame(words, "doc_id bigint, page_no int, text string, x0 double, x1 double, top double")
    # d is 3.5 below the anchor, so it opens a line of its own although c is close to it
    assert [r.text for r in layout.page_lines(w).orderBy("top").collect()] == ["a b c", "d", "Area", "x item"]
    assert [r.text for r in layout.column_from(w, "Area").orderBy("top").collect()] == ["Area", "item"]
    widths = spark.createDataFrame([(1, 1, 100.0)], "doc_id bigint, page_no int, width double")
    assert [r.text for r in layout.right_column(w, widths).orderBy("top").collect()] == ["Area", "item"]

    def spaced(parts, top):
        x, out = 0.0, []
        for p in parts:
            for ch in p:
                out.append((1, 1, ch, x, x + 4, top))
                x += 4.1
            x += 30
        return out

    chars = spaced(["Engineering", "10.00", "50.00", "48.00", "2.00"], 10.0) + spaced(["Procurement", "40.00", "50.00", "48.00", "9.00"], 30.0)
    m = layout.matrix(spark.createDataFrame(chars, w.schema)).collect()
    assert [(r.discipline, r.weight, r.plan, r.actual) for r in m] == [("Engineering", 10.0, 50.0, 48.0)]


def test_seeds(spark):
    body = "seed('A_W1_2026', { plan: 12.5, actual: null, scopes: { 'x, {': { plan: 1, actual: 2, disciplines: { 'e': { plan: 1 } } } }, concerns: ['it\\'s, fine', 'b'], activities: [], });"
    got = seeds.seed_blocks(doc(spark, f"junk {body}\n{body.replace('12.5', '13')} seed('B', {{ plan: 1", None)).orderBy("block_no").collect()
    assert [(r.key, r.plan, r.actual, r.n_disc, r.n_scopes, r.n_concerns, r.n_activities) for r in got[:2]] == [("A_W1_2026", 12.5, None, 0, 1, 2, 0), ("A_W1_2026", 13.0, None, 0, 1, 2, 0)]
    assert (got[2].key, got[2].plan, got[2].n_scopes) == ("B", None, 0)
    assert seeds.history_of(doc(spark, body, body.replace("12.5", "13"))).first().plan == 12.5
    assert seeds.history_of(doc(spark, body, body.replace("12.5", "13")), first=False).first().plan == 13.0


ROW = "project_id string, year int, week int, plan double, actual double, n_disc int, n_scopes int, n_concerns int, n_activities int"


def _findings(spark, rows, kind="wind", junk=None):
    h = spark.createDataFrame([(("A", 2026, w, *r) if len(r) == 6 else ("A", 2026, w, *r, 3, 3)) for w, r in rows], ROW)
    p = spark.createDataFrame([("A", kind)], "project_id string, kind string")
    e = spark.createDataFrame([("wind", 0, 2, True), ("wte", 4, 0, True)], "kind string, min_disc int, min_scopes int, needs_pct boolean")
    none = spark.createDataFrame(junk or [], "project_id string, year int, week int, field string, n_junk int")
    f = rules.findings(rules.with_junk(rules.expected(history.with_previous(h), p, e), none, ("project_id", "year", "week"))).collect()
    return {(r.week, r.rule, r.subject) for r in f}


def test_rules(spark):
    assert _findings(spark, [(1, (50.0, 48.0, 4, 2)), (2, (51.0, 49.0, 4, 2))]) == set()
    assert _findings(spark, [(1, (None, 101.0, 4, 2))]) == {(1, "missing-pct", "plan"), (1, "pct-out-of-range", "actual")}
    assert _findings(spark, [(1, (None, None, 4, 2))], kind="other") == set()
    assert _findings(spark, [(1, (50.0, 50.0, 3, 0))], kind="wte") == {(1, "missing-disciplines", None)}
    # a value vanishes once; a null week hides the older value
    assert {x for x in _findings(spark, [(1, (50.0, 48.0, 4, 2)), (3, (None, 48.5, 4, 2)), (4, (None, 49.0, 4, 2))]) if x[1] == "value-vanished"} == {(3, "value-vanished", "plan")}
    assert (2, "actual-went-backwards", None) in _findings(spark, [(1, (50.0, 48.0, 4, 2)), (2, (50.0, 47.4, 4, 2))])
    assert (2, "actual-went-backwards", None) not in _findings(spark, [(1, (50.0, 48.0, 4, 2)), (2, (50.0, 47.5, 4, 2))])
    assert (2, "structure-shrank", "scopes") in _findings(spark, [(1, (50.0, 48.0, 4, 3)), (2, (50.0, 49.0, 4, 2))])
    # four equal weeks in a row are needed before the first finding
    frozen = [x for x in _findings(spark, [(w, (60.0, 48.0, 4, 2)) for w in range(1, 6)]) if x[1] == "value-frozen"]
    assert sorted(frozen) == [(4, "value-frozen", None), (5, "value-frozen", None)]
    assert _findings(spark, [(1, (80.0, 50.0, 4, 2, 20, 0))]) == {(1, "variance-large", None), (1, "content-truncated", "concerns")}
    # a list that holds table text is not called truncated as well
    assert _findings(spark, [(1, (50.0, 50.0, 4, 2, 20, 20))], junk=[("A", 2026, 1, "concerns", 3)]) == {(1, "content-truncated", "activities")}
    assert _findings(spark, [(1, (50.0, 50.0, 4, 2, 0, 0))]) == {(1, "content-empty", None)}


def test_lists_that_are_not_prose(spark):
    lists = [(1, "concerns", ["5.1 Root cause list", "the crane waits for parts"] + ["work goes on at the gate"] * 18), (2, "concerns", ["the crane waits for parts"]), (3, "activities", [None, "x y"]), (4, "activities", None)]
    got = rules.content_not_prose(spark.createDataFrame(lists, "snap_id int, field string, items array<string>"), ("snap_id",)).collect()
    assert {(r.snap_id, r.n_junk, r.n_items, r.sample, r.note is not None) for r in got} == {(1, 1, 20, "5.1 Root cause list", True), (3, 1, 2, None, False)}


@pytest.mark.parametrize("s,want", [(" Yes ", True), ("✓", True), ("x", True), ("y", False), ("1", True), ("0", False), ("", False), (None, False)])
def test_truthy(spark, s, want):
    assert one(spark, text.truthy(F.col("x")), s) is want


def test_upsert_is_idempotent(spark, tmp_path):
    cols = "rec_id bigint, " + ROW + ", recorded_at timestamp"
    old = spark.createDataFrame([(1, "A", 2026, 1, 1.0, 1.0, 1, 1, 1, 1, dt.datetime(2026, 1, 1)), (2, "A", 2026, 2, 2.0, float("nan"), 1, 1, 1, 1, dt.datetime(2026, 1, 8))], cols)
    new = spark.createDataFrame([(3, "A", 2026, 2, 2.5, 2.0, 1, 1, 1, 1, dt.datetime(2026, 1, 9))], cols)
    once = history.upsert(old, new)
    assert sorted(once.collect()) == sorted(history.upsert(old.unionByName(new), new).collect())
    assert {r.rec_id for r in once.collect()} == {1, 3}
    history.write_weeks(once, str(tmp_path / "h"))
    history.write_weeks(once.where("week = 2").withColumn("plan", F.lit(9.0)), str(tmp_path / "h"))
    assert {(r.week, r.plan) for r in spark.read.parquet(str(tmp_path / "h")).collect()} == {(1, 1.0), (2, 9.0)}


def test_follow(spark, sf, tmp_path):
    src, target, mark = (str(tmp_path / x) for x in ("src", "target", "mark"))
    log = spark.read.parquet(f"{sf}/history.parquet")
    log.where("week <= 26").write.parquet(src)
    incremental.follow(spark, src, log.schema, target, mark)
    log.where("week > 20").write.mode("append").parquet(src)
    incremental.follow(spark, src, log.schema, target, mark)
    got = spark.read.parquet(target).select("rec_id")
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in history.panel(log).select("rec_id").collect())
    incremental.follow_profile(spark, src, log.schema, str(tmp_path / "states"), str(tmp_path / "mark2"))
    from reportloom.operators.profile import count_states, merge_states

    twice = log.where("week <= 26").unionByName(log.where("week > 20"))
    cols = ["feed", "load_id", "column_name", "value", "n"]
    states = spark.read.parquet(str(tmp_path / "states"))
    assert set(merge_states(states.drop("batch")).select(cols).collect()) == set(count_states(twice).select(cols).collect())
    assert "window" in incremental.vanished(spark.readStream.schema(log.schema).parquet(src)).columns


def test_pages_to_frames(spark):
    p = spark.createDataFrame([(1, 1, [("a", 1.0, 2.0, 3.0)], [("b", 1.0, 2.0, 3.0), ("c", 2.0, 3.0, 3.0)], [[["x", None], ["y", "z"]]]), (2, 1, [], None, [])], "doc_id bigint, page_no int, words array<struct<text:string,x0:double,x1:double,top:double>>, chars array<struct<text:string,x0:double,x1:double,top:double>>, tables array<array<array<string>>>")
    assert [tuple(r) for r in files.placed(p).collect()] == [(1, 1, "a", 1.0, 2.0, 3.0)] and files.placed(p, "chars").count() == 2
    assert {(r.doc_id, r.tbl_no, r.row_no, tuple(r.cells)) for r in files.table_rows(p).collect()} == {(1, 0, 0, ("x", None)), (1, 0, 1, ("y", "z"))}


def test_area_table_below_its_heading(spark):
    """Only characters below the heading, and not left of it, make rows."""
    def row(text, top, x=100.0):
        out, at = [], x
        for word in text.split(" | "):
            out += [(1, 1, ch, at + 6 * k, at + 6 * k + 6, top) for k, ch in enumerate(word)]
            at += 6 * len(word) + 30
        return out
    chars = row("Engineering | 10.00 | 90.00 | 80.00 | 10.00", 50.0) + row("Procurement | 40.00 | 70.00 | 60.00 | 10.00", 120.0) + row("Construction | 40.00 | 5.00 | 5.00 | 0.00", 130.0, x=20.0)[:12]
    c = spark.createDataFrame(chars, "doc_id bigint, page_no int, text string, x0 double, x1 double, top double")
    w = spark.createDataFrame([(1, 1, "A r e a", 100.0, 130.0, 100.0), (1, 1, "D i s c", 140.0, 170.0, 100.5)], c.schema)
    assert {tuple(r) for r in layout.matrix(c, w).collect()} == {(1, 1, "Procurement", 40.0, 70.0, 60.0)}
    assert {r.discipline for r in layout.matrix(c).collect()} == {"Engineering", "Procurement"}
    assert layout.matrix(c, w.where("false")).count() == 0


def test_files(spark, tmp_path):
    root = tmp_path / "reports"
    for folder, name in (("31_260805", "Project_A_weekly.pdf"), ("32_260812", "b special a.pdf"), ("32_260812/sub", "Project_A_weekly.pdf"), ("9_260304", "old.pdf")):
        (root / folder).mkdir(parents=True, exist_ok=True)
        (root / folder / name).write_bytes(b"x")
    f = files.listing(spark, str(root))
    assert f.count() == 4 and {r.week for r in f.collect()} == {31, 32, 9}
    newest = files.latest(f)
    assert {r.week for r in newest.collect()} == {32}
    words = spark.createDataFrame([("P1", "project_a"), ("P1", "special"), ("P2", "nothing")], "project string, keyword string")
    got = files.routed(words, newest, F.upper("name").startswith("PROJECT_"))
    assert {(r.project, r.name) for r in got.collect()} == {("P1", "Project_A_weekly.pdf"), ("P2", None)}
    assert files.newest_per(f, "week").count() == 3
    (tmp_path / "s.csv").write_text('Title,,\nProject ID,Project Name,Concerns\nA,Alpha,"x\ny"\n,,\nB,Beta,-\n')
    sheet = files.sheet(spark, str(tmp_path / "s.csv"))
    assert sheet.columns == ["project id", "project name", "concerns"] and sheet.count() == 2
    assert [r.id for r in files.bound(sheet, id=("id", "project id"), kind=("type",)).orderBy("id").collect()] == ["A", "B"]
    (tmp_path / "h.json").write_text('{"PRJ-1_W2_2026": {"plan": 1.5, "actual": null, "n_disc": 4}, "odd": {"plan": 1}}')
    assert [tuple(r)[:5] for r in files.history_json(spark, str(tmp_path / "h.json")).collect()] == [("PRJ-1", 2026, 2, 1.5, None)]
    assert isinstance(files.register_pages(spark), bool)


def test_router_by_parts_of_words(spark):
    """Keywords of any length, wherever they stand in a name; an empty one is in none."""
    words = spark.createDataFrame([("P1", "a"), ("P2", "Ha"), ("P3", "lta"), ("P4", "alpha b"), ("P5", ""), ("P6", None), ("P7", "zz")], "project string, keyword string")
    names = spark.createDataFrame([("ALPHA beta",), ("delta",), ("x",), (None,)], "name string")
    got = files.routed(words, names, F.col("name") == "delta")
    assert {(r.project, r.name) for r in got.collect()} == {("P1", "delta"), ("P2", "ALPHA beta"), ("P3", "delta"), ("P4", "ALPHA beta"), ("P5", None), ("P6", None), ("P7", None)}


def test_sheet_keeps_rows_like_its_header(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Title,,\nProject ID,Project Name,Note\nA,Alpha,x\nProject ID,Project Name,Note\nTitle,,\n")
    got = files.sheet(spark, str(tmp_path / "s.csv"))
    assert [r["project id"] for r in got.collect()] == ["A", "Project ID", "Title"]


def test_report_documents_and_weeks(spark):
    r = files.report_json(spark.createDataFrame([('{"week": 3, "year": 2026, "projects": [{"id": "A", "plan": 1.5, "scopes": {"x": {"plan": 2, "actual": null}}}]}',), ('{"week": 4}',), ("no json",), (None,)], "text string")).collect()
    assert [(x.week, x.project.id, x.project.plan, x.project.scopes["x"].plan) for x in r] == [(3, "A", 1.5, 2.0)]
    rows = spark.createDataFrame([("B", 2026, 1), ("A", 2026, 1), ("A", 2026, 1), ("C", 2025, 52)], "id string, year int, week int")
    weeks = sinks.weeks_to_lists(rows, "id")
    assert weeks.first().weeks == {"1_2026": ["A", "B"], "52_2025": ["C"]}
    new = weeks.select(sinks.merged_weeks(F.col("weeks"), F.create_map(F.lit("1_2026"), F.array(F.lit("Z")))).alias("m")).first().m
    assert new == {"1_2026": ["Z"], "52_2025": ["C"]} and len(sinks.stamped(rows).first().version) == 14
    body = "{ 'it\\'s': { plan: 1.5, actual: null, disciplines: { 'E': { plan: 9, actual: 9 } } }, 'b': { plan: 2, actual: 3 } }"
    assert seeds.scope_figures(body) == {"it's": {"plan": 1.5, "actual": None}, "b": {"plan": 2.0, "actual": 3.0}} and seeds.scope_figures(None) == {}


def test_sinks(spark, tmp_path):
    r = spark.createDataFrame([("B", False, None, None, None, None), ("A", True, 1.0, 2.0, ["x", "y"], [])], "project_id string, found boolean, plan double, actual double, concerns array<string>, activities array<string>")
    assert [(x.project_id, x.found, x.concerns) for x in sinks.sheet_rows(r).collect()] == [("A", "YES", "x\ny"), ("B", "NO", "")]
    sinks.write_sheet(sinks.sheet_rows(r), str(tmp_path / "sheet"))
    sinks.dump(r, str(tmp_path / "dump"))
    assert spark.read.json(str(tmp_path / "dump")).count() == 2
    assert {x.project_id for x in sinks.merged_fixture(r, r.where("project_id = 'A'")).collect()} == {"A", "B"}
    assert files.results_json(spark, str(tmp_path / "dump"), only=("A",)).count() == 1


def test_tables(spark):
    t = doc(spark, "Topic\tPlant\tSub\nnote\nConcern\tone\tN/A 4\nConcern\ttwo\t- 3\nEngineering\t1\t2\t3\t4\nEngineering\t9\t8", "no table")
    g = tables.grid(t)
    got = tables.header_by_target(g, "plant", "concern")
    assert {(r.header, r.value) for r in got.collect()} == {("Topic", "Concern"), ("Plant", "two")}
    assert {(r.label, r.plan, r.actual) for r in tables.labelled_pairs(g).collect()} == {("engineering", 9.0, 8.0)}


def pages(spark, *rows):
    return spark.createDataFrame(rows, "doc_id bigint, page_no int, text string")


def table(spark, *rows):
    return spark.createDataFrame(rows, "doc_id bigint, page_no int, tbl_no int, row_no int, cells array<string>")


def read(df):
    return {(r.doc_id, r.scope, r.label, r.plan, r.actual) for r in df.collect()}


def test_weekly_table(spark):
    p = pages(spark, (1, 1, "Monthly progress status week 3 engineering"), (1, 2, "Weekly construction progress engineering"), (2, 1, "week 4\nEngineering 100.00 90.00\nProcurement 50 40\n"))
    wide = lambda n, a, b: [n, "w", "p", "a", "d", a, b]
    t = table(spark, *((1, 2, 0, k, wide(*x)) for k, x in enumerate((("Engineering", "100", "90"), ("Procurement", "50", "40"), ("Construction", "20.5", "10")))), (1, 1, 0, 0, wide("Engineering", "1", "1")))
    got = read(progress.weekly_table(p, t))
    assert (1, None, "overall", 42.44, 32.22) in got and (1, None, "construction", 20.5, 10.0) in got and (1, None, "engineering", 1.0, 1.0) not in got
    assert {x for x in got if x[0] == 2} == {(2, None, "engineering", 100.0, 90.0), (2, None, "procurement", 50.0, 40.0), (2, None, "overall", 60.0, 50.0)}


def test_section_curves(spark):
    p = pages(
        spark,
        (1, 1, "3.2 S-Curve\n3.2.1 Overall Progress\nPlan / Actual : 10.5% / 9%"), (1, 2, "3.2 S-Curve\n3.2.2 Engineering (E)\nPlan / Actual :\n60% 31.07% / 29.5%"), (1, 3, "3.2 S-Curve\n3.2.6 Marine Construction Area\nPlan / Actual : 1% / 2%"),
        (2, 1, "Overall progress summary engineering S-Curve\nOverall Progress 9 9 9 9 9 9 9 9 9 9 9 9 9 100%"), (2, 2, "Overall progress summary engineering\nOverall Progress 1 2 3 4 5 6 7 8 30 31 32 33 1 100%"),
    )
    got = read(progress.section_curves(p, table(spark, (9, 1, 0, 0, ["x"]))))
    assert {x for x in got if x[0] == 1} == {(1, None, "overall", 10.5, 9.0), (1, None, "engineering", 31.07, 29.5), (1, "Marine Construction Area", "overall", 1.0, 2.0)}
    over = p.unionByName(pages(spark, (2, 3, "S-Curve\nOverall progress\nPlan / Actual : 44% / 43%"), (3, 1, "s-curve overall progress\nPlan / Actual : 4% / 3%")))
    again = read(progress.section_curves(over, table(spark, (9, 1, 0, 0, ["x"]))))
    assert (2, None, "overall", 44.0, 43.0) in again and (2, None, "overall", 32.0, 33.0) not in again and (2, None, "commissioning", 7.0, 8.0) in again and (3, None, "overall", 4.0, 3.0) in again
    m = spark.createDataFrame([(1, 3, "Engineering", 10.0, 5.0, 4.0), (1, 3, "Overall", 100.0, 1.0, 2.0), (1, 1, "Engineering", 1.0, 1.0, 1.0)], "doc_id bigint, page_no int, discipline string, weight double, plan double, actual double")
    assert [tuple(r) for r in progress.area_disciplines(p, m).collect()] == [(1, "Marine Construction Area", "engineering", 5.0, 4.0, 10.0)]
    assert (2, None, "overall", 32.0, 33.0) in got and (2, None, "commissioning", 7.0, 8.0) in got


def test_scopes(spark):
    p = pages(
        spark,
        (1, 1, "plant\nOverall progress stands at 9% against the planned progress of 9%\nThis week activities\nConstruction progress stands at 5% against the planned progress of 6%"),
        (1, 2, "line\nThis week activities\nOverall progress stands at 7% against the planned progress of 8%\nOverall progress stands at 7.5% against the planned progress of 8.5%"),
    )
    scope = F.when(F.col("text").startswith("plant"), "plant").when(F.col("text").startswith("line"), "line")
    summary = spark.createDataFrame([(1, "line", "overall", 50.0, None), (1, "comms", "overall", 1.0, 1.0)], "doc_id bigint, scope string, label string, plan double, actual double")
    got = read(progress.scope_statements(p, scope, summary))
    assert got == {(1, "plant", "construction", 6.0, 5.0), (1, "plant", "overall", 6.0, 5.0), (1, None, "overall", 6.0, 5.0), (1, "line", "overall", 50.0, 7.5), (1, "comms", "overall", 1.0, 1.0)}
    curves = pages(spark, (1, 1, "Overall Progress S-Curve (PX)\nEngineering 100% 84%\nOverall 23% 16%"), (1, 2, "Overall progress s-curve (zz)"))
    t = table(spark, (1, 2, 0, 0, ["Overall", "1", "2", "3", "4"]))
    assert read(progress.scope_curves(curves, t, {"px": "plant"})) == {(1, "plant", "engineering", 100.0, 84.0), (1, "plant", "overall", 23.0, 16.0), (1, None, "overall", 23.0, 16.0), (1, "ZZ", "overall", 3.0, 4.0)}


def test_cells(spark):
    c = [
        ("a", "Construction Progress\n- Plan = 10%\n- Actual = 9%\nOverall progress = 40% ahead 2%"), ("b", "Construction Progress =5% Delayed 1%"),
        ("c", "Progress61.2%(Plan 61.38.77%, -0.18%)"), ("d", "Construction progress\n- Plan = 3%\n- Actual = 2%\nProgress 9% (plan 8%, 0%)"), ("e", "nothing"),
    ]
    df = spark.createDataFrame([(1, s, t) for s, t in c], "doc_id bigint, scope string, cell string")
    assert read(progress.cell_statements(df)) == {(1, "a", "overall", 38.0, 40.0), (1, "b", "overall", 6.0, 5.0), (1, "c", "overall", 61.38, 61.2), (1, "d", "overall", 3.0, 2.0)}
    p = pages(spark, (1, 1, "Executive Summary"), (1, 2, "Site progress"))
    t = table(spark, (1, 1, 0, 0, ["Topic", "Plant A", "Line"]), (1, 1, 0, 1, ["Site Pro gress", "5%", "6%"]), (1, 2, 0, 0, ["Topic", "Plant", "Line"]), (1, 2, 0, 1, ["site progress", "7%", "8%"]))
    scope = F.when(F.col("header").contains("plant"), "plant").when(F.col("header") == "line", "line")
    assert {(r.page_no, r.scope, r.cell) for r in progress.summary_cells(p, t, "plant", "siteprogress", scope).collect()} == {(1, "plant", "5%"), (1, "line", "6%"), (2, "plant", "7%"), (2, "line", "8%")}
    assert progress.summary_cells(p, t, "plant", "siteprogress", scope, *progress.WIND_SUMMARY).count() == 0  # both titles on a page


def test_summary_statements(spark):
    c = [
        ("a", "Overall progress is 12% vs plan 13%\nTransformer overall progress 98% vs plan 100%"), ("b", "Construction progress 5% / Plan at 6%"), ("c", "Line overall progress is 100.00%"),
        ("plant", "Overall progress stands at 8% against the planned progress of 9%\nProcurement progress 3% compared to plan at 4%"), ("d", "Civil progress 5% vs plan 6%"),
    ]
    df = spark.createDataFrame([(1, 1, 0, k, s, t) for k, (s, t) in enumerate(c)] + [(1, 2, 0, 0, "b", "Overall progress 7% vs plan 8%"), (1, 3, 0, 0, "b", "nothing said")], "doc_id bigint, page_no int, tbl_no int, col_no int, scope string, cell string")
    assert read(progress.solar_summary(df)) == {(1, "a", "overall", 13.0, 12.0), (1, "b", "overall", 8.0, 7.0), (1, "c", "overall", 100.0, 100.0), (1, "plant", "overall", 9.0, 8.0), (1, "plant", "procurement", 4.0, 3.0)}
    w = df.withColumn("cell", F.regexp_replace("cell", "(?s)^.*?([0-9]+)%.*$", "Progress$1%(Plan 50%, 0%)"))
    assert {x for x in read(progress.wind_summary(w))} == {(1, s, "overall", 50.0, v) for s, v in (("a", 12.0), ("b", 5.0), ("plant", 8.0), ("d", 5.0), ("c", 0.0))}


def test_whole_and_dispatch(spark):
    p = pages(spark, (1, 1, "Plan/Actual：7.15%/6.4%"), (2, 1, "Cum. Progress -Planned 1.00% 2.50%\nCum. Progress - Actual 2.00%"), (2, 2, "Cum. Progress -Planned 3.50%\n"), (3, 1, "Physical progress: 5% and 6%"), (4, 1, "none"))
    whole = progress.whole_document(p)
    assert read(whole) == {(1, None, "overall", 7.15, 6.4), (2, None, "overall", 3.5, 2.0)}
    drawn = doc(spark, "", "", "", "x", "Achived Progress up to now = 4 %\nAchieved progress = 5%")
    phys = progress.physical_or_drawn(p, drawn)
    assert read(phys) == {(3, None, "overall", 5.0, 6.0), (4, None, "overall", None, 5.0)}
    kinds = spark.createDataFrame([(1, "hydro"), (3, "river"), (4, "hydro"), (5, "odd")], "doc_id bigint, kind string")
    assert read(progress.dispatched(kinds, {"hydro": whole, "river": phys})) == {(1, None, "overall", 7.15, 6.4), (3, None, "overall", 5.0, 6.0), (4, None, None, None, None), (5, None, None, None, None)}


def test_content_policy(spark):
    generic = spark.createDataFrame([(k, kind, "concerns", ["g"]) for k, kind in enumerate(("wte", "wte", "solar_listed", "solar_listed", "odd", "solar", "hydro_drawn"))], "doc_id bigint, kind string, field string, items array<string>")
    own = spark.createDataFrame([(0, "concerns", [], True), (1, "concerns", None, False), (2, "concerns", [], True), (3, "concerns", ["s"], True), (4, "concerns", ["s"], True), (5, "concerns", ["s"], True), (6, "concerns", None, False)], "doc_id bigint, field string, items array<string>, found boolean")
    assert {r.doc_id: r.items for r in progress.content(generic, own).collect()} == {0: [], 1: ["g"], 2: ["g"], 3: ["s"], 4: ["g"], 5: ["g"], 6: []}


def test_structure(spark):
    d = spark.createDataFrame([(" ENGINEERING",), ("Constr.",), ("procurement ",), ("tie-in works",)], "x string")
    assert [r[0] for r in d.select(structure.discipline(F.col("x"))).collect()] == ["Engineering", "Construction", "Procurement", "Tie-in Works"]


def test_folder_of_intermediate_tables(spark, tmp_path):
    """The session's own setting counts; on a cluster without one there is nothing to choose."""
    from reportloom import session as own

    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

        def set(self, key, value):
            self[key] = value

    def fake(master, **settings):
        context = type("Context", (), {"getConf": lambda _: Conf({"spark.master": master})})()
        return type("Session", (), {"conf": Conf(settings), "sparkContext": context})()

    assert own.shared_folder(fake("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://x/shared"})) == "hdfs://x/shared"
    assert own.shared_folder(fake("local[4]")).startswith("file:///")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        own.shared_folder(fake("spark://host:7077"))
    with pytest.raises(RuntimeError, match="share"):
        own.shared_folder(fake("local-cluster[3,2,1024]"))


def test_empty_tables(spark, sf, tmp_path):
    """Every query over empty tables ends and gives no rows, or one row of counts."""
    for f in os.listdir(sf):
        spark.read.parquet(f"{sf}/{f}").limit(0).write.parquet(str(tmp_path / f))
    for m in MODULES:
        for name, q in m.queries().items():
            n = q(spark, str(tmp_path)).count()
            assert n <= (18 if name in ("status_round_trip", "p5_profile") else 1), name


def test_every_pin_is_diffed(spark, sf):
    """A plan that changes and reverts between the first and the last pin is reported at each step."""
    none = "map()"
    snap = lambda pin, plan: f"select 'A' as project_id, {pin} as pin_no, cast({plan} as double) as plan, 1D as actual, cast({none} as map<string, array<double>>) as disciplines, cast({none} as map<string, struct<plan: double, actual: double, disciplines: map<string, array<double>>>>) as scopes, 0 as n_concerns, 0 as n_activities, 'c' as first_concern, 'a' as first_activity"
    pins = spark.sql(" union all ".join(snap(*x) for x in ((4, 5), (1, 5), (2, 7), (6, 5))))
    got = {tuple(r) for r in structure.diff_successive(pins, "project_id", "pin_no").collect()}
    assert got == {("A", 1, 2, "plan", "5.00", "7.00", "changed"), ("A", 2, 4, "plan", "7.00", "5.00", "changed")}
    w = pd.read_parquet(f"{sf}/w32_2026.parquet").sort_values(["project_id", "pin_no"])
    text_ = [None if v != v or v is None else f"{v:.2f}" for v in w.plan]
    steps = zip(w.project_id, w.pin_no, text_, w.project_id[1:], w.pin_no[1:], text_[1:], strict=False)
    want = {(p, a, b, x, y) for p, a, x, q, b, y in steps if p == q and x != y}
    done = history_queries.queries()["fixture_diff"](spark, sf).where("path = 'plan'")
    assert want and {tuple(r) for r in done.select("project_id", "pin_no", "next_pin", "before", "after").collect()} == want
    for name in ("fixture_paths", "summary_rows"):
        assert history_queries.queries()[name](spark, sf).select("project_id", "pin_no").distinct().count() == len(w)


def test_figures_of_a_very_long_line(spark):
    """Figures after more than 100,000 cells count."""
    g = tables.grid(doc(spark, "Engineering" + "\t" * 100_001 + "9\t8", "\t"))
    assert {(r.label, r.plan, r.actual) for r in tables.labelled_pairs(g).collect()} == {("engineering", 9.0, 8.0)}
    assert sorted(r.n for r in g.select(F.size(progress._figures(F.col("cells"))).alias("n")).collect()) == [0, 2]


def test_history_of_every_project_is_in_order(spark, sf):
    h = pd.read_parquet(f"{sf}/history.parquet").dropna(subset=["project_id", "year", "week"])
    want = sorted({(p, int(y), int(w)) for p, y, w in zip(h.project_id, h.year, h.week, strict=True)})
    got = history_queries.queries()["history_of_project"](spark, sf).select("project_id", "year", "week").collect()
    assert [tuple(r) for r in got] == want


def test_same_figures_are_rendered_and_read_once(spark, monkeypatch, tmp_path):
    """Observations with the same figures give the same texts: these are read once and count for all."""
    rows = [(p, a) for p, a, n in ((8.35, 8.8, 50), (8.8, 8.35, 30), (100.0, 0.0, 20), (0.05, 99.99, 1)) for _ in range(n)]
    spark.createDataFrame([*rows, (101.0, 3.0), (None, 3.0), (float("nan"), 3.0)], "plan double, actual double").write.parquet(str(tmp_path / "obs_discipline.parquet"))
    read = []
    monkeypatch.setattr(text_queries, "kept", lambda df: read.append(df) or df)
    got = {r.grammar: tuple(r)[1:] for r in text_queries.queries()["status_round_trip"](spark, str(tmp_path)).collect()}
    assert [df.count() for df in read] == [4]
    plan, actual = (sum(round(r[k] * 100) for r in rows) for k in (0, 1))
    assert got == {n: (101, plan if "plan" in g.figures else 0, actual if "actual" in g.figures else 0) for n, g in grammar.GRAMMARS.items()}


def test_first_statements(spark):
    """The first statement read at once is the first of all, of each wording; odd texts too."""
    texts = [g.wording % tuple({"label": "Construction", "direction": d}.get(x, v) for x, v in zip(g.groups, vs, strict=False)) for g in grammar.GRAMMARS.values() for d in ("Delayed", "AHEAD") for vs in (("8.35", "7.8", "1.20", "3"), ("999", "120.5", "100", "0"))]
    texts = [t.replace("Plan, 8.35", "Plan, -8.35") for t in texts]
    texts += [f"{a}\n\n{b} " for a, b in zip(texts, reversed(texts), strict=True)] + ["", "progress", "Progress 5% (a, -", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    for g in grammar.GRAMMARS.values():
        first = F.get(grammar.statements(F.col("t"), g), F.lit(0))
        want = df.select("k", first["plan"].alias("plan"), first["actual"].alias("actual")).orderBy("k").collect()
        assert grammar.first_statements(df, ["k"], "t", g).orderBy("k").collect() == want, g.name
        assert sum(r.plan is not None or r.actual is not None for r in want) >= 2, g.name
    parts = {x: F.lit("5.5") for x in ("label", "direction", *grammar.NUMBERS)}
    got = spark.range(1).select(*(grammar.rendered(g, parts).alias(n) for n, g in grammar.GRAMMARS.items())).first()
    assert got.asDict() == {n: g.wording % (("5.5",) * len(g.groups)) for n, g in grammar.GRAMMARS.items()}


def test_router_ranks_names_by_keyword_first(spark):
    """Projects that share keywords share their best names: names are ranked once a keyword, at places where
    one can begin, and not once a project; the routes are those of plain search."""
    draw = random.Random(5)
    some = lambda n: "".join(draw.choice("abAB c") for _ in range(n))
    names = [some(draw.randint(0, 9)) for _ in range(60)]
    words = [(f"P{k % 40}", some(draw.choice((1, 2, 3, 4, 5)))) for k in range(120)] + [("P40", "zz")]
    got = files.routed(spark.createDataFrame(words, "project string, keyword string"), spark.createDataFrame([(n,) for n in names], "name string"), F.length("name") == 7)
    want = {p: min(((len(n) != 7, n) for n in names for q, k in words if q == p and k.upper() in n.upper()), default=(0, None))[1] for p, _ in words}
    assert None in want.values() and len(set(want.values())) > 5
    assert sorted(map(str, got.collect())) == sorted(str(Row(project=p, name=n)) for p, n in want.items())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_k#" in plan and "transform(" not in plan
