"""Queries of the family readers over report pages rendered from the observations, with their SQL.

Each report is a project's week.  Its observed figures are written into the pages, tables and cells
a family's reports have, with decoys that must not be read; the reader has to get them back, and
the SQL takes what must come out straight from the observations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.functions import numeric
from reportloom.operators import lines, structure
from reportloom.plans import content, progress

PRIMARY = "Turbine Hall"
ORDER = numeric.DISCIPLINES
SECTION = r"^Section: ([^\n]*)"
WORDINGS = 6


def _t(s: SparkSession, d: str, name: str) -> DataFrame:
    return s.read.parquet(f"{d}/{name}.parquet")


def _figures(s: SparkSession, d: str) -> DataFrame:
    """(doc_id, week, scope, discipline, plan, actual): one row per report, scope and standard discipline
    that has both figures, as text with two decimals."""
    t = structure.tidy(_t(s, d, "obs_discipline")).where(F.col("discipline").isin(*ORDER))
    doc = F.concat("project_id", F.lit("_W"), F.col("week").cast("string"), F.lit("_"), F.col("year").cast("string"))
    inside = lambda c: F.max(F.when(F.col(c).between(0.0, 100.0), numeric.exact(F.col(c)))).alias(c)
    g = t.groupBy(doc.alias("doc_id"), "week", "scope", "discipline").agg(inside("plan"), inside("actual")).where("plan is not null and actual is not null")
    return g.withColumns({c: F.col(c).cast("string") for c in ("plan", "actual")})


def _text(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _by_discipline(g: DataFrame, keys: list[str]) -> DataFrame:
    """(…keys, n, and per discipline a struct p, a or null), one row per key."""
    one = F.struct(F.col("plan").alias("p"), F.col("actual").alias("a"))
    return g.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *(F.max(F.when(F.col("discipline") == x, one)).alias(x) for x in ORDER))


def _joined(sep: str, parts: list[Column]) -> Column:
    return F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull()), sep)


def _pages(df: DataFrame, *pages: tuple[int, Column]) -> DataFrame:
    """Rows of reports to rows of pages (doc_id, page_no, text)."""
    each = F.array(*(F.struct(F.lit(n).alias("page_no"), t.alias("text")) for n, t in pages))
    return df.select("doc_id", F.explode(each).alias("x")).select("doc_id", "x.*").where("text is not null")


def _rows(df: DataFrame, *rows: tuple[int, int, int, Column]) -> DataFrame:
    """(doc_id, page_no, tbl_no, row_no, cells) of (page, table, row, cells); null cells are left out."""
    each = F.array(*(F.struct(F.lit(p).alias("page_no"), F.lit(t).alias("tbl_no"), F.lit(r).alias("row_no"), c.alias("cells")) for p, t, r, c in rows))
    return df.select("doc_id", F.explode(each).alias("x")).select("doc_id", "x.*").where("cells is not null")


def _cells(*cs: str | Column) -> Column:
    return F.array(*(F.lit(c) if isinstance(c, str) else c for c in cs))


def ext_weekly_table(s, d):
    """Weekly page of a report: a table for three disciplines or more, rows of text for fewer; the monthly
    page before it is a decoy."""
    r = _by_discipline(_figures(s, d).where("scope is null"), ["doc_id"])
    line = _joined("\n", [F.when(F.col(x).isNotNull(), _text(f"{x} ", F.col(x)["p"], " ", F.col(x)["a"])) for x in ORDER])
    few = F.when(F.col("n") < 3, line).otherwise("by discipline: engineering, procurement, construction")
    p = _pages(r, (1, F.lit("Monthly progress status\nWeekly progress\nEngineering 1.00 1.00\nProcurement 1.00 1.00")), (2, _text("Weekly construction progress, week 32\n", few)))
    decoy = [(1, 0, k, _cells(x, "", "", "", "", "1", "1")) for k, x in enumerate(ORDER)]
    rows = _rows(r, *decoy, *((2, 0, k, F.when((F.col("n") >= 3) & F.col(x).isNotNull(), _cells(x, "1", "2", "3", "4", F.concat(F.col(x)["p"], F.lit(" %")), F.col(x)["a"]))) for k, x in enumerate(ORDER)))
    return progress.weekly_table(p, rows)


def ext_overall_row(s, d):
    """Overall row of the package table, read from its end; with fewer than four disciplines a labelled table
    instead.  A curve page before is a decoy, and in every third week an overall curve has the last word."""
    r = _by_discipline(_figures(s, d).where("scope is null"), ["doc_id", "week"])
    lead = F.array_join(F.array(*(F.col(x)[k] for x in ORDER for k in ("p", "a"))), " ")
    e = F.coalesce(*(F.col(x) for x in ORDER))
    row = F.when(F.col("n") == 4, _text("Overall Progress ", lead, " 0.00 0.00 ", F.col("Construction")["p"], " ", F.col("Engineering")["a"], " 1.00 100.00%"))
    curve = F.when(F.col("week") % 3 == 0, _text("S-Curve\nOverall progress\nPlan / Actual :\n", e["a"], "% / ", e["p"], "%"))
    p = _pages(r, (1, F.lit("S-Curve by discipline: engineering\nOverall progress 1 2 3 4 5 6 7 8 9 10 11 12 13 14%")), (2, _text("Progress summary by discipline: engineering\n", F.coalesce(row, F.lit("see table")))), (3, curve))
    rows = _rows(r, *((2, 1, k, F.when((F.col("n") < 4) & F.col(x).isNotNull(), _cells(_text(f"{x} works"), "0", "0", F.col(x)["p"], F.col(x)["a"]))) for k, x in enumerate(ORDER)), *((1, 0, k, _cells(x, "1", "2")) for k, x in enumerate(ORDER)))
    return progress.section_curves(p, rows)


def ext_section_curves(s, d):
    """Curve pages with one callout each: the whole, the disciplines and the areas of a report."""
    g = _figures(s, d)
    area = g.where("scope is not null").groupBy("doc_id", "scope").agg(F.max(F.col("plan").cast("decimal(9,2)")).cast("string").alias("plan"), F.min(F.col("actual").cast("decimal(9,2)")).cast("string").alias("actual"))
    whole = g.where("scope is null").groupBy("doc_id").agg(F.max(F.col("plan").cast("decimal(9,2)")).cast("string").alias("plan"), F.min(F.col("actual").cast("decimal(9,2)")).cast("string").alias("actual"))
    part = lambda df, title, no: df.select("doc_id", no.alias("page_no"), _text("3.2 S-Curve\n3.2.", no.cast("string"), " ", title, "\nPlan / Actual :\n", F.col("plan"), "% / ", F.col("actual"), "%").alias("text"))
    no = F.array_position(F.array(*map(F.lit, ORDER)), F.col("discipline")).cast("int") + 1
    p = part(whole, F.lit("Overall Progress"), F.lit(1)).unionByName(part(g.where("scope is null"), F.concat("discipline", F.lit(" (E)")), no))
    p = p.unionByName(part(area, F.concat("scope", F.lit(" Area")), (F.abs(F.hash("scope")) % 1000 + 10).cast("int")))
    return progress.section_curves(p, _rows(whole.limit(0), (1, 0, 0, _cells("x"))))


def _scope_pages(s, d) -> DataFrame:
    """Two this-week pages for every scope below M; the earlier one, and what comes before the marker, are
    decoys.  Commissioning stands for the scope's overall figure."""
    r = _by_discipline(_figures(s, d).where("scope < 'M' or scope >= 'S'"), ["doc_id", "scope"])
    say = lambda label, x: F.when(F.col(x).isNotNull(), _text(f"{label} progress stands at ", F.col(x)["a"], "% against the planned progress of ", F.col(x)["p"], "%."))
    body = _joined("\n", [say("Overall", "Commissioning"), *(say(x, x) for x in ORDER[:3])])
    head = _text("Section: ", F.col("scope"), "\nOverall progress stands at 1% against the planned progress of 1%\nThis week activities\n")
    old = _text(head, "Overall progress stands at 2% against the planned progress of 2%")
    no = (F.abs(F.hash("scope")) % 1000).cast("int") * 2
    return r.select("doc_id", F.explode(F.array(F.struct(no.alias("page_no"), old.alias("text")), F.struct((no + 1).alias("page_no"), _text(head, body).alias("text")))).alias("x")).select("doc_id", "x.*")


def _scope_of() -> Column:
    return F.when(F.col("text").rlike(SECTION), F.regexp_extract("text", SECTION, 1))


def _summary_tables(s, d, cell: Column, header: str, title: str) -> tuple[DataFrame, DataFrame]:
    """Pages and tables of a report's summary: one column a scope from G on, on page 2."""
    r = _by_discipline(_figures(s, d).where("scope >= 'G'"), ["doc_id", "week", "scope"]).withColumn("cell", cell).where("cell is not null")
    g = r.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("scope", "cell"))).alias("c"))
    names, cells = F.transform("c", lambda x: x["scope"]), F.transform("c", lambda x: x["cell"])
    blank = F.array(F.lit("-"), F.lit("-"))
    rows = _rows(g, (2, 0, 0, F.concat(_cells(header), names, blank)), (2, 0, 1, F.concat(_cells("Site Pro gress"), F.transform("c", lambda _: F.lit("first row of the name")), blank)), (2, 0, 2, F.concat(_cells("Site progress"), cells, blank)))
    return _pages(g, (1, F.lit("Table of contents")), (2, F.lit(title))), rows


def _solar_cell() -> Column:
    """By what a scope has: a headline with a sub-item in its wording, construction only, or one figure."""
    f = F.col
    both = _text("Overall progress is ", f("Engineering")["a"], "% vs plan ", f("Engineering")["p"], "%\nProcurement progress ", f("Construction")["a"], "% / Plan at ", f("Construction")["p"], "%\nTransformer overall progress 1.00% vs plan 2.00%")
    alone = _text("Construction progress ", f("Construction")["a"], "% against plan ", f("Construction")["p"], "%")
    single = _text("Line overall progress is ", f("Procurement")["a"], "%")
    return F.when(f("Engineering").isNotNull() & f("Construction").isNotNull(), both).when(f("Construction").isNotNull(), alone).when(f("Procurement").isNotNull(), single)


def _solar_cells(s, d) -> DataFrame:
    p, rows = _summary_tables(s, d, _solar_cell(), "Topic Plant", "Executive summary")
    known = F.when(~F.col("header").isin("-", "topic plant"), F.initcap("header"))
    return progress.summary_cells(p, rows, "topic plant", "siteprogress", known, *progress.SOLAR_SUMMARY)


def ext_solar_summary(s, d):
    return progress.solar_summary(_solar_cells(s, d), PRIMARY)


def ext_scope_statements(s, d):
    """This-week pages merged with the summary: in even weeks the summary wins scope by scope, in odd ones
    it only stands in for reports without a page."""
    reports = _figures(s, d).select("doc_id", "week").distinct()
    return progress.scope_statements(_scope_pages(s, d), _scope_of(), progress.solar_summary(_solar_cells(s, d), PRIMARY), reports.where("week % 2 = 0").select("doc_id"), PRIMARY)


def _wind_cell() -> Column:
    f = F.col
    x = F.coalesce(f("Engineering"), f("Construction"))
    p, a = x["p"], x["a"]
    diff = p.cast("decimal(9,2)") - a.cast("decimal(9,2)")
    late = F.when(diff >= 0, "Delayed").otherwise("Ahead")
    said = [
        _text("Overall project progress\n- Plan = ", p, "%\n- Actual = ", a, "%"), _text("Overall progress actual = ", a, "%,\n- Overall progress plan = ", p, "%"), _text("Overall progress\nActual ", a, " %\nPlan ", p, "%"),
        _text("Overall progress = ", a, "% ", late, " ", F.abs(diff).cast("string"), "%\nConstruction progress = 1.00% ahead 0.50%"), _text("Progress ", a, "% (plan ", p, "%, 0%)"), _text("Progress", a, "%(Plan, ", (-diff).cast("string"), "%)"),
    ]
    out = said[0]
    for k in range(1, WORDINGS):
        out = F.when(f("week") % WORDINGS == k, said[k]).otherwise(out)
    return F.when(x.isNotNull(), out)


def ext_wind_summary(s, d):
    """Summary cells in six wordings, by week; both titles must be on the page."""
    p, rows = _summary_tables(s, d, _wind_cell(), "Topic Plant", "Executive summary\nSite progress")
    more = p.where("page_no = 1").select("doc_id", F.lit(3).alias("page_no"), F.lit("Site progress only").alias("text"))
    known = F.when(~F.col("header").isin("-", "topic plant"), F.initcap("header"))
    decoy = rows.withColumns({"page_no": F.lit(3), "cells": F.transform("cells", lambda c: F.when(c.contains("rogress "), "Progress 1% (plan 2%, 0%)").otherwise(c))})
    return progress.wind_summary(progress.summary_cells(p.unionByName(more), rows.unionByName(decoy), "topic plant", "siteprogress", known, *progress.WIND_SUMMARY))


def ext_scope_curves(s, d):
    """Curve pages titled with a scope; in odd weeks the figures stand in a table instead of the text."""
    r = _by_discipline(_figures(s, d).where("scope is not null"), ["doc_id", "week", "scope"]).withColumn("page_no", (F.abs(F.hash("scope")) % 100_000).cast("int"))
    body = _joined("\n", [F.when(F.col(x).isNotNull(), _text(f"{x} ", F.col(x)["p"], "% ", F.col(x)["a"], " %")) for x in ORDER])
    odd = F.col("week") % 2 == 1
    p = r.select("doc_id", "page_no", _text("Overall Progress S-Curve (", F.col("scope"), ")\n", F.when(odd, "see table").otherwise(body)).alias("text"))
    rows = r.where(odd).select("doc_id", "page_no", F.explode(F.filter(F.array(*(F.when(F.col(x).isNotNull(), _cells(_text(f"{x} total"), F.col(x)["p"], F.col(x)["a"])) for x in ORDER)), lambda c: c.isNotNull())).alias("cells"))
    rows = rows.select("doc_id", "page_no", F.lit(0).alias("tbl_no"), F.lit(0).alias("row_no"), "cells")
    return progress.scope_curves(p, rows, {PRIMARY.lower(): PRIMARY}, primary=PRIMARY)


def _hydro(s, d) -> DataFrame:
    return _by_discipline(_figures(s, d).where("scope is null"), ["doc_id", "week"]).withColumn("x", F.coalesce(*(F.col(c) for c in ORDER)))


def _printed(r: DataFrame) -> DataFrame:
    p, a = F.col("x")["p"], F.col("x")["a"]
    pair = F.when(F.col("week") % 2 == 0, _text("Plan/Actual：", p, "%/", a, "%"))
    last = F.when(F.col("week") % 2 == 1, _text("Cum. Progress - Planned 1.00% ", p, "%\nCum. Progress - Actual ", F.when(F.col("week") % 4 == 1, _text("1.00% ", a, "%")).otherwise("not stated")))
    return _pages(r, (1, F.coalesce(pair, F.lit("Cum. Progress - Planned 1.00% 3.00%"))), (2, F.coalesce(last, F.lit("Plan/Actual：1.00%/1.00%"))))


def ext_whole_document(s, d):
    """First pair of the document, or the last cumulative figure of each kind; an actual may be missing."""
    return progress.whole_document(_printed(_hydro(s, d)))


def _drawn(r: DataFrame) -> tuple[DataFrame, DataFrame]:
    p, a = F.col("x")["p"], F.col("x")["a"]
    line = F.when(F.col("week") % 2 == 0, _text("Physical Progress: Plan ", p, "% / Actual ", a, "%"))
    pages = _pages(r, (1, F.lit("Report")), (20, line), (21, F.lit("Physical progress: Plan 1.00% / Actual 2.00%")))
    drawn = r.select("doc_id", _text("Planned Progress = 1.00 %\nAccumulative Planned Progress up to date = ", p, " %\nAchived Progress ", F.when(F.col("week") % 4 == 1, _text("up to date = ", a, " %")).otherwise("unreadable")).alias("text"))
    return pages, drawn


def ext_physical(s, d):
    """The printed line of the first twenty pages, or what was read from the drawing."""
    return progress.physical_or_drawn(*_drawn(_hydro(s, d)))


def ext_dispatched(s, d):
    """Every report by its project's kind; kinds without a reader here have one row of nulls."""
    r = _hydro(s, d)
    project = F.regexp_extract("doc_id", "^(.*)_W", 1)
    kinds = r.select("doc_id", project.alias("project_id")).join(_t(s, d, "dim_project").groupBy("project_id").agg(F.min("kind").alias("kind")), "project_id", "left").select("doc_id", "kind")
    families = {"hydro": progress.whole_document(_printed(r)), "grid": progress.physical_or_drawn(*_drawn(r)), "wte": ext_weekly_table(s, d), "wind": ext_scope_curves(s, d)}
    return progress.dispatched(kinds, families)


def _documents(s, d) -> DataFrame:
    return _t(s, d, "documents").select("doc_id", F.lit(1).alias("page_no"), "text")


def ext_generic_concerns(s, d):
    """Every document as a page."""
    return content.generic_concerns(_documents(s, d))


def ext_generic_activities(s, d):
    return content.generic_activities(_documents(s, d))


def ext_numbered_concerns(s, d):
    return content.numbered_concerns(_documents(s, d), "(?i)minutes|question|finding")


def ext_numbered_first_lines(s, d):
    return content.numbered_concerns(_documents(s, d), "(?i)minutes|question|finding", folded=False)


def _orders(s, d) -> DataFrame:
    return _t(s, d, "lineitem").join(_t(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"))


def _quantity_page(df: DataFrame, title: str) -> DataFrame:
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "line"))), lambda x: x["line"]), "\n")
    return df.groupBy(F.col("l_orderkey").alias("doc_id")).agg(_text(f"{title}\n", body).alias("text")).select("doc_id", F.lit(1).alias("page_no"), "text")


def ext_planned_rows(s, d):
    """Order lines as rows of work planned, their discount as the share; a share of nothing is left out."""
    n, q = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("int").cast("string")
    line = _text("1.", n, " ", F.col("p_name"), " m3 ", q, " 0 ", q, " ", (F.col("l_discount") * 100).cast("decimal(5,2)").cast("string"), "%")
    return content.planned_rows(_quantity_page(_orders(s, d).withColumn("line", line), "Main activities in next week"), "(?i)next week")


def ext_work_rows(s, d):
    """Order lines as rows of work under their group, the return flag; quantities under ten are written as
    zero and left out, those of fifty as no number and kept."""
    n, q = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("int")
    amount = F.when(q < 10, "0").when(q == 50, ",").otherwise(q.cast("string"))
    line = _text(n, " Group ", F.col("l_returnflag"), " of works\n1.", n, " ", F.col("p_name"), " m2 9 ", amount, " 1")
    return content.work_rows(_quantity_page(_orders(s, d).withColumn("line", line), "2.3 Construction"), "(?i)construction", "(?i)look ahead")


def ext_content_policy(s, d):
    """First activity as the generic list and first concern as the family's own, by kind: who wins."""
    w = _t(s, d, "w32_2026").join(_t(s, d, "dim_project").groupBy("project_id").agg(F.min("kind").alias("kind")), "project_id", "left")
    kind = F.when((F.col("kind") == "solar") & (F.col("pin_no") == 1), "solar_listed").when((F.col("kind") == "hydro") & (F.col("pin_no") <= 2), "hydro_printed").when(F.col("kind") == "hydro", "hydro_drawn").otherwise(F.col("kind"))
    items = lambda c: F.filter(F.split(F.coalesce(F.col(c), F.lit("")), "\n"), lambda x: x != "")
    field = F.explode(F.array(F.lit("concerns"), F.lit("activities"))).alias("field")
    generic = w.select(F.col("snap_id").alias("doc_id"), kind.alias("kind"), items("first_activity").alias("items"), field)
    own = w.select(F.col("snap_id").alias("doc_id"), items("first_concern").alias("items"), F.col("first_concern").isNotNull().alias("found"), field)
    return progress.content(generic, own).select("doc_id", "field", F.size("items").alias("n"), F.md5(F.encode(F.array_join("items", "\n"), "utf-8")).alias("digest"))


def ext_header_items(s, d):
    """Summary rows of snapshots, a column for each text and one headed 'topic', folded to items."""
    w = _t(s, d, "w32_2026")
    cell = lambda n, header, c: F.struct(F.lit(n).alias("col_no"), F.lit(header).alias("header"), F.col(c).alias("value"))
    cells = F.explode(F.array(cell(0, "Topic", "first_concern"), cell(1, "Concern", "first_concern"), cell(2, "Activity", "first_activity"))).alias("x")
    return content.header_items(w.select(F.col("snap_id").alias("doc_id"), cells).select("doc_id", "x.*").where("value is not null"))


def ext_look_ahead(s, d):
    """Visual lines of a column: other fields, the look-ahead with the activity's lines as bullets, and a
    field that ends it; snapshots without an activity have no such field."""
    w = _t(s, d, "w32_2026")
    activity = F.transform(F.filter(F.split("first_activity", "\n"), lambda x: F.trim(x).rlike("^[A-Za-z][a-z]{2}")), lambda x: F.concat(F.lit("• "), x))
    body = F.when(F.col("first_activity").isNotNull(), F.concat(F.array(F.lit("Key look ahead milestones:")), activity, F.array(F.lit("Manpower 12"), F.lit("• not in the field"))))
    lines_ = F.concat(F.array(F.lit("Executive summary"), F.lit("• before the field")), F.coalesce(body, F.array().cast("array<string>")))
    column = w.select(F.col("snap_id").alias("doc_id"), F.lit(2).alias("page_no"), F.posexplode(lines_).alias("n", "text")).select("doc_id", "page_no", (F.col("n") * 10.0).alias("top"), F.lit(300.0).alias("x0"), "text")
    got = content.field(column, content.LOOK_AHEAD, content.NEXT_FIELD, least_head=10)
    return got.select("doc_id", "found", "cross_reference", F.size("items").alias("n"))


def ext_history_rows(s, d):
    """Snapshots as results, summarised to what history keeps."""
    w = _t(s, d, "w32_2026")
    items = lambda c: F.split(F.col(c), "\n").alias(c)
    r = w.select("project_id", "year", "week", (F.col("pin_no") > 1).alias("found"), "plan", "actual", "disciplines", "scopes", items("first_concern"), items("first_activity"))
    got = content.summarised(r.withColumnsRenamed({"first_concern": "concerns", "first_activity": "activities"}))
    no_nan = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return got.select("project_id", "year", "week", no_nan("plan"), no_nan("actual"), "n_disc", "n_scopes", "n_concerns", "n_activities")


def queries() -> dict:
    named = (
        ext_weekly_table, ext_overall_row, ext_section_curves, ext_solar_summary, ext_scope_statements, ext_wind_summary, ext_scope_curves, ext_whole_document, ext_physical, ext_dispatched,
        ext_generic_concerns, ext_generic_activities, ext_numbered_concerns, ext_numbered_first_lines, ext_planned_rows, ext_work_rows, ext_content_policy, ext_header_items, ext_look_ahead, ext_history_rows,
    )
    return {f.__name__: f for f in named}


_FIG = """tidy as (
  select project_id || '_W' || week || '_' || year as doc_id, week, scope, case when lower(trim(discipline)) like 'eng%' then 'Engineering' when lower(trim(discipline)) like 'proc%' then 'Procurement'
    when lower(trim(discipline)) like 'const%' then 'Construction' when lower(trim(discipline)) like 'comm%' then 'Commissioning' end as discipline,
    case when plan between 0 and 100 then cast(plan as decimal(9,2)) end as plan, case when actual between 0 and 100 then cast(actual as decimal(9,2)) end as actual
  from obs_discipline
),
fig as (
  select doc_id, week, scope, discipline, lower(discipline) as label, max(plan) as plan, max(actual) as actual from tidy where discipline is not null
  group by all having max(plan) is not null and max(actual) is not null
),
wide as (
  select doc_id, week, scope, count(*) as n, max(plan) filter (label = 'engineering') as ep, max(actual) filter (label = 'engineering') as ea, max(plan) filter (label = 'procurement') as pp, max(actual) filter (label = 'procurement') as pa,
    max(plan) filter (label = 'construction') as cp, max(actual) filter (label = 'construction') as ca, max(plan) filter (label = 'commissioning') as mp, max(actual) filter (label = 'commissioning') as ma
  from fig group by doc_id, week, scope
)"""
_OUT = "select doc_id, scope, label, cast(plan as double) as plan, cast(actual as double) as actual from"
_W = "case label when 'engineering' then 10 when 'procurement' then 40 when 'construction' then 40 else 10 end"
_MEAN = "((2 * sum(cast({0} * 100 as bigint) * %s) + sum(%s)) // (2 * sum(%s))) / 100.0" % (_W, _W, _W)  # noqa: UP031
_NO_SCOPE = "cast(null as varchar) as scope"
_WEEKLY = f"""weekly as (
  select doc_id, {_NO_SCOPE}, label, plan, actual from fig f where scope is null and (select count(*) from fig g where g.doc_id = f.doc_id and g.scope is null) >= 2
),
weekly_all as (select * from weekly union all select doc_id, {_NO_SCOPE}, 'overall', {_MEAN.format("plan")}, {_MEAN.format("actual")} from weekly group by doc_id)"""
_CURVES = f"""curve0 as (select doc_id, case when scope = '{PRIMARY}' then scope else upper(scope) end as scope, label, plan, actual from fig where scope is not null)"""
_HYDRO = """hy as (select doc_id, week, coalesce(ep, pp, cp, mp) as p, coalesce(ea, pa, ca, ma) as a from wide where scope is null)"""
_WHOLE = f"whole as (select doc_id, {_NO_SCOPE}, 'overall' as label, p as plan, case when week % 4 <> 3 then a end as actual from hy)"
_SOLAR = f"""cell as (select *, ep is not null and cp is not null as both_ from wide where scope >= 'G'),
solar as (
  select doc_id, scope, 'overall' as label, case when both_ then ep when cp is not null then cp else pa end as plan, case when both_ then ea when cp is not null then ca else pa end as actual from cell where cp is not null or pp is not null
  union all select doc_id, scope, 'construction', cp, ca from cell where not both_ and cp is not null and scope = '{PRIMARY}'
  union all select doc_id, scope, 'procurement', cp, ca from cell where both_ and scope = '{PRIMARY}'
)"""
_S = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_LINES = f"""ls as (select doc_id, text, string_split(text, chr(10)) as l from documents where text is not null and @where@),
raw as (select doc_id, text, cast(generate_subscripts(l, 1) - 1 as int) as line_no, unnest(l) as line from ls),
lines as (select *, {_S.format("line")} as s from raw)"""
_SECTION = r"""a as (select *, coalesce(bool_or(regexp_matches(line, '{header}')) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding), false) as inside from lines),
b as (select *, s = '' as blank from a where inside),
c as (select *, {stop} or (blank and coalesce(lag(blank, 1) over w, false) and coalesce(lag(blank, 2) over w, false)) as ends from b window w as (partition by doc_id order by line_no)),
d as (select *, bool_or(ends) over (partition by doc_id order by line_no) as over_ from c),
e as (select *, row_number() over (partition by doc_id order by line_no) as n from d where not over_ and not blank),
f as (select doc_id, line_no, s, {bare} as item from e where n <= 30),
g as (select doc_id, line_no, item from f where s <> '' and not regexp_matches(s, '^\d+\s*$') and not regexp_matches(s, '(?i)^(action|table of content|page|note:|concern to achieve|next milestone)') and length(s) >= 8 and item <> '')"""
_LISTED = """h as (select doc_id, item, min(line_no) as at_ from g where length(item) > {least} group by 1, 2),
i as (select doc_id, cast(row_number() over (partition by doc_id order by at_) as int) as ord, item from h)
select * from i where ord <= 20"""
_BARE = _S.format("regexp_replace(s, '^[\\-•*\\d]+[.)]\\s*', '')")
_CONCERN, _ACTIVITY = "(?i)concern|area of concern|issue|delay", "(?i)next period|next week|planned activity|activity plan|upcoming"
_PAGE = "not regexp_matches(text, '(?i)table of content')"
_NUMBERED = r"""a as (select *, regexp_matches(s, '^\d+[.)]\s*') as opens from lines where line_no > 0 and s <> '' and not regexp_matches(s, '^\d+\s*$') and upper(s) not in ('NONE', 'N/A', 'NA'))"""
_QUANTITY = "lineitem join part on l_partkey = p_partkey"


def _section_sql(where: str, header: str, stop: str) -> str:
    return f"{_LINES.replace('@where@', where)},\n{_SECTION.format(header=header, stop=stop, bare=_BARE)}"


def oracle_sql() -> dict[str, str]:
    listed = lambda least=10: _LISTED.format(least=least)
    plain = _section_sql(f"{_PAGE} and not regexp_matches(text, '(?i)concern ?\\(delay\\)') and regexp_matches(text, '{_CONCERN}') and not contains(text, '%')", _CONCERN, f"regexp_matches(line, '{_ACTIVITY}')")
    own = _section_sql(f"{_PAGE} and regexp_matches(text, '(?i)concern ?\\(delay\\)')", "(?i)concern.*delay", "regexp_matches(line, '(?i)^action')")
    strip_no = _S.format("regexp_replace(s, '^\\d+[.)]\\s*', '')")
    kind = "case when kind = 'solar' and pin_no = 1 then 'solar_listed' when kind = 'hydro' and pin_no <= 2 then 'hydro_printed' when kind = 'hydro' then 'hydro_drawn' else kind end"
    cut = "list_filter(string_split(coalesce({0}, ''), chr(10)), lambda x: x <> '')"
    return {
        "ext_weekly_table": f"with {_FIG}, {_WEEKLY} {_OUT} weekly_all",
        "ext_overall_row": f"""with {_FIG}, o as (select doc_id, week, n, coalesce(ep, pp, cp, mp) as x, coalesce(ea, pa, ca, ma) as y, cp, ea from wide where scope is null)
{_OUT} (
  select f.doc_id, {_NO_SCOPE}, f.label, f.plan, f.actual from fig f join o on f.doc_id = o.doc_id where f.scope is null and o.n >= 2
  union all select doc_id, null, 'overall', case when week % 3 = 0 then y else cp end, case when week % 3 = 0 then x else ea end from o where n = 4 or week % 3 = 0
)""",
        "ext_section_curves": f"""with {_FIG}, w as (select doc_id, max(plan) as plan, min(actual) as actual from fig where scope is null group by 1)
{_OUT} (
  select doc_id, {_NO_SCOPE}, 'overall' as label, plan, actual from w union all select doc_id, null, label, plan, actual from fig where scope is null
  union all select f.doc_id, f.scope || ' Area', 'overall', max(f.plan), min(f.actual) from fig f join w on f.doc_id = w.doc_id where f.scope is not null group by 1, 2
)""",
        "ext_solar_summary": f"with {_FIG}, {_SOLAR} {_OUT} solar",
        "ext_scope_statements": f"""with {_FIG}, {_SOLAR},
scan0 as (select doc_id, week, scope, label, plan, actual from fig where (scope < 'M' or scope >= 'S')),
scan1 as (select doc_id, scope, case label when 'commissioning' then 'overall' else label end as label, plan, actual from scan0),
scan2 as (select * from scan1 union all select doc_id, scope, 'overall', plan, actual from scan1 c where label = 'construction' and not exists (select 1 from scan1 o where o.doc_id = c.doc_id and o.scope = c.scope and o.label = 'overall')),
scan as (select * from scan2 where label = 'overall' or scope = '{PRIMARY}'),
week_of as (select distinct doc_id, week from fig),
top as (select s.* from solar s join week_of w on s.doc_id = w.doc_id where w.week % 2 = 0 or s.doc_id not in (select doc_id from scan)),
both_ as (select coalesce(t.doc_id, s.doc_id) as doc_id, coalesce(t.scope, s.scope) as scope, coalesce(t.label, s.label) as label, coalesce(t.plan, s.plan) as plan, coalesce(t.actual, s.actual) as actual
  from scan s full outer join top t on s.doc_id = t.doc_id and s.scope = t.scope and s.label = t.label)
{_OUT} (select * from both_ union all select doc_id, null, label, plan, actual from both_ where scope = '{PRIMARY}' and label = 'overall')""",
        "ext_wind_summary": f"with {_FIG} {_OUT} (select doc_id, scope, 'overall' as label, coalesce(ep, cp) as plan, coalesce(ea, ca) as actual from wide where scope >= 'G' and coalesce(ep, cp) is not null)",
        "ext_scope_curves": f"with {_FIG}, {_CURVES} {_OUT} curve0",
        "ext_whole_document": f"with {_FIG}, {_HYDRO}, {_WHOLE} {_OUT} whole",
        "ext_physical": f"with {_FIG}, {_HYDRO} {_OUT} (select doc_id, {_NO_SCOPE}, 'overall' as label, p as plan, case when week % 4 <> 3 then a end as actual from hy)",
        "ext_dispatched": f"""with {_FIG}, {_WEEKLY}, {_CURVES}, {_HYDRO}, {_WHOLE},
k as (select h.doc_id, p.kind from hy h left join (select project_id, min(kind) as kind from dim_project group by 1) p on p.project_id = regexp_extract(h.doc_id, '^(.*)_W', 1)),
got as (
  select w.* from whole w join k on w.doc_id = k.doc_id where kind in ('hydro', 'grid')
  union all select w.* from weekly_all w join k on w.doc_id = k.doc_id where kind = 'wte' union all select c.* from curve0 c join k on c.doc_id = k.doc_id where kind = 'wind'
)
{_OUT} (select * from got union all select doc_id, null, null, null, null from k where doc_id not in (select doc_id from got))""",
        "ext_generic_concerns": f"""with p as (with {plain} select * from g), o as (with {own} select * from g), g as (select * from p union all select * from o), {listed()}""",
        "ext_generic_activities": f"""with {_section_sql(f"{_PAGE} and regexp_matches(text, '{_ACTIVITY}')", _ACTIVITY, "false")}, {listed()}""",
        "ext_numbered_concerns": f"""with {_LINES.replace('@where@', "regexp_matches(text, '(?i)minutes|question|finding')")}, {_NUMBERED},
b as (select *, sum(case when opens then 1 else 0 end) over (partition by doc_id order by line_no) as k from a),
g as (select doc_id, k as line_no, string_agg(case when opens then {strip_no} else s end, ' ' order by line_no) as item from b group by 1, 2), {listed()}""",
        "ext_numbered_first_lines": f"""with {_LINES.replace('@where@', "regexp_matches(text, '(?i)minutes|question|finding')")}, {_NUMBERED},
g as (select doc_id, line_no, {strip_no} as item from a where opens), {listed(5)}""",
        "ext_planned_rows": f"""with o as (select *, cast(cast(l_quantity as int) as varchar) as q, cast(cast(l_discount * 100 as decimal(5,2)) as varchar) as share from {_QUANTITY}),
r as (select *, row_number() over (partition by l_orderkey order by l_linenumber, '1.' || l_linenumber || ' ' || p_name || ' m3 ' || q || ' 0 ' || q || ' ' || share || '%') as line_no from o),
g as (select l_orderkey as doc_id, line_no, p_name || ' — ' || q || ' m3 (' || share || '%)' as item from r where cast(share as double) > 0), {listed()}""",
        "ext_work_rows": f"""with o as (select *, case when l_quantity < 10 then '0' when l_quantity = 50 then ',' else cast(cast(l_quantity as int) as varchar) end as q from {_QUANTITY}),
r as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_linenumber || ' Group ' || l_returnflag || ' of works' || chr(10) || '1.' || l_linenumber || ' ' || p_name || ' m2 9 ' || q || ' 1') as line_no from o),
g as (select l_orderkey as doc_id, line_no, '[Group ' || l_returnflag || ' of works] ' || p_name || ' — ' || q || ' m2' as item from r where q <> '0'), {listed()}""",
        "ext_content_policy": f"""with w as (select w.*, {kind.replace("kind", "p.kind")} as k from w32_2026 w left join (select project_id, min(kind) as kind from dim_project group by 1) p on w.project_id = p.project_id),
f as (select snap_id as doc_id, k, field, {cut.format("first_activity")} as g, {cut.format("first_concern")} as o, first_concern is not null as found from w cross join (values ('concerns'), ('activities')) t(field)),
j as (select doc_id, field, list_slice(case
  when k = 'hydro_drawn' and field = 'concerns' then o when k = 'wte' or (k in ('wind', 'terminal', 'hydro_printed') and field = 'concerns') then case when found then o else g end
  when k in ('solar_listed', 'wind', 'terminal', 'hydro_printed', 'hydro_drawn') or (k = 'solar' and field = 'activities') then case when len(o) > 0 then o else g end else g end, 1, 20) as items from f)
select doc_id, field, cast(len(items) as int) as n, md5(coalesce(list_aggregate(items, 'string_agg', chr(10)), '')) as digest from j""",
        "ext_header_items": f"""with c as (select snap_id as doc_id, 1 as col_no, 'Concern' as header, first_concern as v from w32_2026 where first_concern is not null union all select snap_id, 2, 'Activity', first_activity from w32_2026 where first_activity is not null),
ls as (select *, string_split(v, chr(10)) as l from c), raw as (select doc_id, col_no, header, generate_subscripts(l, 1) as line_no, {_S.format("unnest(l)")} as s from ls),
a as (select *, regexp_matches(s, '^[•▪□❑❏➢○◦*-]\\s*') as opens from raw where s <> ''),
b as (select *, sum(case when opens then 1 else 0 end) over (partition by doc_id, col_no, header order by line_no) as item_no from a),
g as (select doc_id, col_no, header, item_no, string_agg(case when opens then {_S.format("regexp_replace(s, '^[•▪□❑❏➢○◦*-]\\s*', '')")} else s end, ' ' order by line_no) as item from b group by all),
k as (select * from g where item <> '' and upper({_S.format("regexp_replace(item, '\\s*\\d+\\s*$', '')")}) not in ('', 'N/A', 'NA', 'N.A', '-', 'NONE'))
select doc_id, cast(row_number() over (partition by doc_id order by col_no, item_no) as int) as ord, '[' || header || '] ' || item as item from k""",
        "ext_look_ahead": f"""with a as (select snap_id as doc_id, unnest(list_filter(string_split(first_activity, chr(10)), lambda x: regexp_matches(trim(x, ' '), '^[A-Za-z][a-z]{{2}}'))) as line from w32_2026 where first_activity is not null),
k as (select doc_id, {_S.format("line")} as item from a),
n as (select doc_id, count(*) as n from k where upper({_S.format("regexp_replace(item, '\\s*\\d+\\s*$', '')")}) not in ('', 'N/A', 'NA', 'N.A', '-', 'NONE') group by 1)
select snap_id as doc_id, true as found, false as cross_reference, cast(coalesce(n, 0) as int) as n from w32_2026 left join n on snap_id = n.doc_id where first_activity is not null""",
        "ext_history_rows": """select project_id, year, week, case when not isnan(plan) then plan end as plan, case when not isnan(actual) then actual end as actual, cast(coalesce(cardinality(disciplines), 0) as int) as n_disc,
  cast(coalesce(cardinality(scopes), 0) as int) as n_scopes, cast(coalesce(len(string_split(first_concern, chr(10))), 0) as int) as n_concerns, cast(coalesce(len(string_split(first_activity, chr(10))), 0) as int) as n_activities
from w32_2026 where pin_no > 1""",
    }
