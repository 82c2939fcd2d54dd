"""Progress by report family: candidates with a priority, the best of which is kept.

Inputs are pages (doc_id, page_no, text) and, where a family needs them, page tables in row form
(doc_id, page_no, tbl_no, row_no, cells) and drawn text read from images (doc_id, text).  Every
family gives (doc_id, scope, label, plan, actual): scope null for the project as a whole, label
'overall' or a discipline in lower case.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportloom.functions.grammar import GRAMMARS, read_statements, statements, winning
from reportloom.functions.numeric import four_or_two, parse_pct, pick_from_end, numbers_in, positional, weighted
from reportloom.functions.text import multi_column, strip

# What marks the pages of each family.
WEEKLY_PAGE = r"(?i)weekly construction progress|weekly.*progress.*epc|week\s+\d"
MONTHLY_PAGE = r"(?i)monthly progress status|cumulative\s+monthly"
DISCIPLINE_WORD = r"(?i)engineer|procure|construct|commission"
CURVE_HEADING = r"(?m)^[ \t]*3\.2\.\d+\s+(\S.*?)\s*$"
SCOPE_CURVE = r"(?i)overall progress s-?curve\s*\(([^)]+)\)"
THIS_WEEK = r"(?i)this week activities"
SINGLE = r"(?i)overall\s*progress\s*(?:is\s+)?(\d{1,3}(?:\.\d{1,2})?)\s*%"
STEMS = {"engineer": "engineering", "procure": "procurement", "construct": "construction", "commission": "commissioning"}
LABELS = (*STEMS.values(), "overall")
COLUMNS = ("doc_id", "scope", "label", "plan", "actual")


def _standard(label: Column) -> Column:
    out = F.lower(label)
    for stem, name in STEMS.items():
        out = F.when(F.lower(label).startswith(stem), name).otherwise(out)
    return out


def _label_of(cell: Column) -> Column:
    """Discipline or 'overall' that a table row is about, by its first cell."""
    low = F.lower(strip(cell))
    out = F.when(low.contains("overall"), "overall")
    for name in reversed(tuple(STEMS.values())):
        out = F.when(low.contains(name), name).otherwise(out)
    return out


def _entries(df: DataFrame, keys: list[str], entries: Column) -> DataFrame:
    """(…keys, label, plan, actual) of arrays of such entries."""
    return df.select(*keys, F.explode(entries).alias("_e")).select(*keys, "_e.label", "_e.plan", "_e.actual")


def _exact_label(cell: Column) -> Column:
    low = F.lower(strip(cell))
    return F.when(low.isin(*STEMS.values()), low).when(low.contains("overall"), "overall")


def _best(candidates: DataFrame, least: dict[int, int], by_page: bool = False) -> DataFrame:
    """Of each document the candidates of the first attempt (priority, attempt no.) that has enough
    disciplines; ``least`` maps a priority to that number.  ``by_page`` goes through the pages first
    and tries all priorities on each."""
    enough = reduce(lambda out, kv: F.when(F.col("priority") == kv[0], kv[1]).otherwise(out), least.items(), F.lit(1))
    order = F.struct(F.col("attempt.page_no").alias("page_no"), "priority", "attempt") if by_page else F.struct(F.lit(0).alias("page_no"), "priority", "attempt")
    c = candidates.withColumn("_o", order).withColumn("_n", F.count_if(F.col("label") != "overall").over(Window.partitionBy("doc_id", "_o"))).where(F.col("_n") >= enough)
    first = F.min("_o").over(Window.partitionBy("doc_id"))
    return c.withColumn("_first", first).where("_o = _first").drop("priority", "attempt", "_o", "_n", "_first")


def _table_candidates(rows: DataFrame, pages: DataFrame, pair, priority: int, exact: bool = False) -> DataFrame:
    """Labelled rows of tables on the given pages; of equal labels in a table the last counts.  ``exact``
    wants a discipline's name alone in the first cell."""
    r = rows.join(pages.select("doc_id", "page_no"), ["doc_id", "page_no"], "left_semi")
    r = r.withColumn("label", (_exact_label if exact else _label_of)(F.get("cells", F.lit(0)))).withColumn("p", pair(F.col("cells"))).where("label is not null and p.plan is not null and p.actual is not null")
    got = r.groupBy("doc_id", "page_no", "tbl_no", "label").agg(F.max_by("p", "row_no").alias("p"))
    attempt = F.struct("page_no", "tbl_no")
    return got.select("doc_id", F.lit(priority).alias("priority"), attempt.alias("attempt"), "label", "p.plan", "p.actual")


def _text_candidates(pages: DataFrame, grammar: str, priority: int) -> DataFrame:
    """First statement per label of each page."""
    found = winning(read_statements(pages, ["doc_id", "page_no"], "text", (grammar,)), ["doc_id", "page_no"], last=False)
    attempt = F.struct("page_no", F.lit(0).alias("tbl_no"))
    return found.select("doc_id", F.lit(priority).alias("priority"), attempt.alias("attempt"), _standard(F.col("label")).alias("label"), "plan", "actual")


def _figures(cells: Column) -> Column:
    return F.filter(F.transform(F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))), parse_pct), lambda v: v.isNotNull())


def weekly_table(pages: DataFrame, rows: DataFrame) -> DataFrame:
    """Weekly page: a table with three disciplines or more by position, else two or more in the text;
    a missing overall is the weighted mean of what is there."""
    t = F.col("text")
    on = pages.where(t.rlike(WEEKLY_PAGE) & ~t.rlike(MONTHLY_PAGE) & t.rlike(DISCIPLINE_WORD))
    got = _best(_table_candidates(rows, on, positional, 1, exact=True).unionByName(_text_candidates(on, "row_pair", 2)), {1: 3, 2: 2}, by_page=True)
    of = lambda f: weighted(F.when(F.col("label") != "overall", F.col(f)), F.initcap("label")).alias(f)
    g = got.groupBy("doc_id").agg(of("plan"), of("actual"), F.max(F.col("label") == "overall").alias("_has"), F.collect_list(F.struct("label", "plan", "actual")).alias("e"))
    mean = F.array(F.struct(F.lit("overall").alias("label"), "plan", "actual"))
    return _entries(g, ["doc_id"], F.when(F.col("_has"), F.col("e")).otherwise(F.concat("e", mean))).select("doc_id", F.lit(None).cast("string").alias("scope"), "label", "plan", "actual")


def heading_kind(title: Column) -> Column:
    """'overall', a discipline, or null for an area; brackets and punctuation aside."""
    key = strip(F.regexp_replace(F.lower(F.regexp_replace(title, r"\([^)]*\)", " ")), "[^a-z ]+", " "))
    return F.when(key.contains("overall"), "overall").when(key.isin(*STEMS.values()), key)


def _callouts(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, scope, label, plan, actual): numbered curve pages with their first callout."""
    p = pages.where(F.lower("text").contains("3.2 s-curve"))
    s = F.get(statements(F.col("text"), GRAMMARS["callout"]), F.lit(0))
    p = p.select("doc_id", "page_no", strip(F.regexp_extract("text", CURVE_HEADING, 1)).alias("title"), s.alias("s")).where("title <> '' and s.plan is not null and s.actual is not null")
    kind = heading_kind(F.col("title"))
    return p.select("doc_id", "page_no", F.when(kind.isNull(), F.col("title")).alias("scope"), F.coalesce(kind, F.lit("overall")).alias("label"), "s.plan", "s.actual")


def area_disciplines(pages: DataFrame, matrix: DataFrame) -> DataFrame:
    """(doc_id, scope, label, plan, actual, wf): the rows of the letter-spaced tables (doc_id, page_no,
    discipline, weight, plan, actual) on area pages, under their area; its overall row is left out."""
    area = _callouts(pages).where("scope is not null")
    last = area.groupBy("doc_id", "scope").agg(F.max("page_no").alias("page_no"))
    m = matrix.where("discipline <> 'Overall'").select("doc_id", "page_no", F.lower("discipline").alias("label"), "plan", "actual", F.col("weight").alias("wf"))
    return last.join(m, ["doc_id", "page_no"]).select("doc_id", "scope", "label", "plan", "actual", "wf")


def overall_curve(pages: DataFrame) -> DataFrame:
    """(doc_id, plan, actual): the callout of the first curve page for the whole project, which names no
    discipline."""
    t = F.lower("text")
    s = F.get(statements(F.col("text"), GRAMMARS["callout"]), F.lit(0))
    p = pages.where(t.contains("s-curve") & t.contains("overall progress") & ~t.contains("engineering")).select("doc_id", "page_no", s.alias("s")).where("s is not null")
    return p.groupBy("doc_id").agg(F.min_by("s", "page_no").alias("s")).select("doc_id", "s.plan", "s.actual")


def section_curves(pages: DataFrame, rows: DataFrame) -> DataFrame:
    """Numbered curve pages with one callout each, if they give the overall and at least one discipline or
    area.  Other documents: on pages that are no curve pages the overall row of the package table
    read from its end, then labelled tables, then rows of text; the overall curve's figures, where
    there is one, stand for the project's."""
    c = _callouts(pages)
    last = c.groupBy("doc_id", "scope", "label").agg(F.max_by(F.struct("plan", "actual"), "page_no").alias("s")).select("doc_id", "scope", "label", "s.plan", "s.actual")
    of_doc = Window.partitionBy("doc_id")
    is_whole = F.max((F.col("scope").isNull() & (F.col("label") == "overall")).cast("int")).over(of_doc)
    curves = last.withColumns({"_w": is_whole, "_n": F.count(F.lit(1)).over(of_doc)}).where("_w = 1 and _n > 1").drop("_w", "_n")
    whole = curves.where("scope is null and label = 'overall'").select("doc_id")
    t = F.col("text")
    rest = pages.join(whole, "doc_id", "left_anti")
    on = rest.where(t.rlike(r"(?i)overall.*progress|progress.*summary|discipline") & t.rlike(r"(?i)engineering|procurement|construction") & ~F.lower("text").contains("s-curve"))
    line = on.select("doc_id", "page_no", F.posexplode(F.split("text", "\n")).alias("n", "line")).where(strip(F.col("line")).rlike(r"(?i)^overall\s+progress\b") & F.col("line").contains("%"))
    picked = line.withColumn("p", pick_from_end(numbers_in(F.col("line")))).where("p is not null")
    first = picked.groupBy("doc_id", "page_no").agg(F.min_by("p", "n").alias("p"))
    lead = F.array(*(F.struct(F.lit(name).alias("label"), F.get("p.lead", F.lit(2 * k)).alias("plan"), F.get("p.lead", F.lit(2 * k + 1)).alias("actual")) for k, name in enumerate(STEMS.values())))
    of_row = F.filter(F.concat(F.array(F.struct(F.lit("overall").alias("label"), F.col("p.plan").alias("plan"), F.col("p.actual").alias("actual"))), lead), lambda x: x["plan"].isNotNull() & x["actual"].isNotNull())
    attempt = F.struct("page_no", F.lit(0).alias("tbl_no")).alias("attempt")
    from_row = first.select("doc_id", F.lit(1).alias("priority"), attempt, F.explode(of_row).alias("x")).select("doc_id", "priority", "attempt", "x.*")
    both = from_row.unionByName(_table_candidates(rows, on, lambda cs: four_or_two(_figures(cs)), 2)).unionByName(_text_candidates(on, "row_pair", 3))
    got = _best(both, {1: 0, 2: 2, 3: 2}, by_page=True)
    over = overall_curve(rest)
    kept = got.join(over.select("doc_id", F.lit("overall").alias("label")), ["doc_id", "label"], "left_anti").select("doc_id", "label", "plan", "actual")
    fallen = kept.unionByName(over.select("doc_id", F.lit("overall").alias("label"), "plan", "actual"))
    return curves.unionByName(fallen.select("doc_id", F.lit(None).cast("string").alias("scope"), "label", "plan", "actual"))


def _overlaid(scan: DataFrame, summary: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """Full outer by scope and label; the summary's figures win.  With ``listed`` (doc_id) they only count in
    these documents and in those where the scan has nothing."""
    a = scan.select("doc_id", "scope", "label", F.col("plan").alias("_p"), F.col("actual").alias("_a"), F.lit(True).alias("_scan"))
    b = summary.select(*COLUMNS, F.lit(True).alias("_sum"))
    j = a.join(b, ["doc_id", "scope", "label"], "full_outer")
    if listed is not None:
        scanned = F.coalesce(F.max("_scan").over(Window.partitionBy("doc_id")), F.lit(False))
        j = j.withColumn("_scanned", scanned).join(listed.select("doc_id", F.lit(True).alias("_listed")), "doc_id", "left")
        counts = F.coalesce("_listed", F.lit(False)) | ~F.col("_scanned")
        j = j.where(F.col("_scan").isNotNull() | counts).withColumns({c: F.when(counts, F.col(c)) for c in ("plan", "actual")})
    return j.select("doc_id", "scope", "label", F.coalesce("plan", "_p").alias("plan"), F.coalesce("actual", "_a").alias("actual"))


def _with_primary(scoped: DataFrame, primary: str) -> DataFrame:
    """The primary scope's overall figures stand for the project too."""
    twice = F.when((F.col("scope") == primary) & (F.col("label") == "overall"), F.array("scope", F.lit(None).cast("string"))).otherwise(F.array("scope"))
    return scoped.select("doc_id", F.explode(twice).alias("scope"), "label", "plan", "actual")


def _construction_stands_in(found: DataFrame, keys: list[str]) -> DataFrame:
    """Adds construction's figures as overall where there is no overall; labels are few and occur once."""
    g = found.groupBy(*keys).agg(F.collect_list(F.struct("label", "plan", "actual")).alias("e"))
    own = lambda name: F.filter("e", lambda x: x["label"] == name)
    proxy = F.transform(own("construction"), lambda x: x.withField("label", F.lit("overall")))
    return _entries(g, keys, F.when(F.size(own("overall")) > 0, F.col("e")).otherwise(F.concat("e", proxy)))


def scope_statements(pages: DataFrame, scope_of: Column, summary: DataFrame | None = None, listed: DataFrame | None = None, primary: str = "plant") -> DataFrame:
    """This-week pages: three wordings in order, the last match of a label wins, later pages over
    earlier ones per scope; disciplines of the primary scope only.

    ``summary`` has the figures of summary cells.  They overlay those of the ``listed`` documents (doc_id;
    all where it is not given); other documents take them only where no page gave anything."""
    t = F.col("text")
    on = pages.where(t.rlike(THIS_WEEK)).withColumn("scope", scope_of).where("scope is not null").withColumn("text", F.substring(t, F.regexp_instr(t, F.lit(THIS_WEEK)), F.length(t)))
    found = winning(read_statements(on, ["doc_id", "scope", "page_no"], "text", ("stands_at", "compared", "summary")).where("plan is not null and actual is not null"), ["doc_id", "scope", "page_no"])
    last = F.max("page_no").over(Window.partitionBy("doc_id", "scope"))
    got = _construction_stands_in(found.withColumn("_last", last).where("page_no = _last").select(*COLUMNS), ["doc_id", "scope"])
    got = got.where((F.col("label") == "overall") | (F.col("scope") == primary))
    return _with_primary(got if summary is None else _overlaid(got, summary, listed), primary)


def summary_statements(cells: DataFrame, keys: tuple[str, ...] = ("doc_id", "scope")) -> DataFrame:
    """(…keys, label, plan, actual): summary cells (…keys, cell) of solar reports.  Three wordings in order,
    the first match of a label wins, as a cell's sub-items repeat its wording; overall falls back to
    construction, then to a figure without a plan, which counts as both."""
    said = F.filter(F.concat(*(statements(F.col("cell"), GRAMMARS[g]) for g in ("summary", "stands_at", "compared"))), lambda x: x["plan"].isNotNull() & x["actual"].isNotNull())
    c = cells.select(*keys, "cell", said.alias("_s"))
    first = lambda name: F.get(F.filter("_s", lambda x: x["label"] == name), F.lit(0))
    entry = lambda name, x: F.when(x.isNotNull(), F.struct(F.lit(name).alias("label"), x["plan"].alias("plan"), x["actual"].alias("actual")))
    one = F.regexp_extract("cell", SINGLE, 1).try_cast("double")
    single = F.when(one.between(0.0, 100.0), F.struct(F.lit("overall").alias("label"), one.alias("plan"), one.alias("actual")))
    overall = F.coalesce(entry("overall", first("overall")), entry("overall", first("construction")), single)
    each = F.filter(F.array(overall, *(entry(x, first(x)) for x in ("construction", "engineering", "procurement"))), lambda x: x.isNotNull())
    return _entries(c, list(keys), F.when(overall.isNotNull(), each))


def cell_statements(cells: DataFrame, keys: tuple[str, ...] = ("doc_id", "scope")) -> DataFrame:
    """Summary cells (…keys, cell) of wind reports: wordings in order, each tried only while it is still
    needed: the second to fourth while overall is unset, the fifth and sixth while nothing is set.  A
    cell without overall falls back to construction."""
    order = ("plan_then_actual", "actual_then_plan", "newline_plan", "delta", "inline", "signed_delta")
    first_wins = ("delta",)
    found = read_statements(cells, list(keys), "cell", order)
    w = Window.partitionBy(*keys, "label", "grammar_no").orderBy(F.when(F.col("grammar").isin(*first_wins), F.col("match_no")).otherwise(-F.col("match_no")))
    one = found.withColumn("_r", F.row_number().over(w)).where("_r = 1")
    cell = Window.partitionBy(*keys).orderBy("grammar_no").rangeBetween(Window.unboundedPreceding, -1)
    had_overall = F.coalesce(F.max(F.col("label") == "overall").over(cell), F.lit(False))
    had_any = F.coalesce(F.count(F.lit(1)).over(cell), F.lit(0)) > 0
    need = (F.col("grammar_no") == 0) | (F.col("grammar_no").between(1, 3) & ~had_overall) | (F.col("grammar_no").isin(4, 5) & ~had_any)
    got = winning(one.withColumn("_need", need).where("_need"), list(keys), last=False).select(*keys, "label", "plan", "actual")
    return _construction_stands_in(got, list(keys)).where("label = 'overall' and plan is not null and actual is not null")


#: How far summary pages reach, and whether both titles must be on them.
SUMMARY_TITLES = ("executive summary", "site progress")
SOLAR_SUMMARY, WIND_SUMMARY = (10, False), (8, True)


def summary_cells(pages: DataFrame, rows: DataFrame, header: str, target: str, scope_of: Column, within: int = 10, both: bool = False) -> DataFrame:
    """(doc_id, page_no, tbl_no, col_no, scope, cell): of every table of the summary pages that has both
    rows, header cells naming a scope paired by column with the target row.  ``scope_of`` reads the
    column 'header'; ``both`` wants both titles on a page, else one will do."""
    one, two = (F.lower("text").contains(x) for x in SUMMARY_TITLES)
    on = pages.where((F.col("page_no") <= within) & ((one & two) if both else (one | two))).select("doc_id", "page_no")
    r = rows.join(on, ["doc_id", "page_no"], "left_semi").where(multi_column(F.col("cells"))).withColumn("_j", F.lower(F.array_join("cells", " ")))
    t = r.groupBy("doc_id", "page_no", "tbl_no").agg(F.min_by("cells", F.when(F.col("_j").rlike(header), F.col("row_no"))).alias("h"), F.max_by("cells", F.when(F.replace(F.col("_j"), F.lit(" "), F.lit("")).rlike(target), F.col("row_no"))).alias("t"))
    t = t.where("h is not null and t is not null")
    c = t.select("doc_id", "page_no", "tbl_no", F.posexplode(F.arrays_zip(F.col("h").alias("header"), F.col("t").alias("cell"))).alias("col_no", "x")).select("doc_id", "page_no", "tbl_no", "col_no", F.lower(F.col("x.header")).alias("header"), "x.cell")
    return c.withColumn("scope", scope_of).where("scope is not null and cell is not null and cell <> ''").drop("header")


def solar_summary(cells: DataFrame, primary: str = "plant") -> DataFrame:
    """Figures of solar summary cells, disciplines of the primary scope only; of several cells of a scope
    that say something the last counts."""
    at = F.struct("page_no", "tbl_no", "col_no").alias("at")
    got = summary_statements(cells.select("doc_id", "scope", at, "cell"), ("doc_id", "scope", "at"))
    last = F.max("at").over(Window.partitionBy("doc_id", "scope"))
    return got.withColumn("_last", last).where("at = _last").where((F.col("label") == "overall") | (F.col("scope") == primary)).select(*COLUMNS)


def wind_summary(cells: DataFrame) -> DataFrame:
    """Overall figures of wind summary cells: of the first page that gives any, the last cell of a scope."""
    keys = ("doc_id", "page_no", "tbl_no", "col_no", "scope")
    got = cell_statements(cells, keys)
    first = F.min("page_no").over(Window.partitionBy("doc_id"))
    of = got.withColumn("_first", first).where("page_no = _first").groupBy("doc_id", "scope").agg(F.max_by(F.struct("label", "plan", "actual"), F.struct("tbl_no", "col_no")).alias("s"))
    return of.select("doc_id", "scope", "s.label", "s.plan", "s.actual")


def scope_curves(pages: DataFrame, rows: DataFrame, scope_names: dict[str, str], summary: DataFrame | None = None, primary: str = "plant") -> DataFrame:
    """Curve pages titled with a scope: rows of the text, else labelled tables; a summary overlays the
    overall figures."""
    raw = F.trim(F.regexp_extract("text", SCOPE_CURVE, 1))
    scope = F.upper(raw)
    for key, name in scope_names.items():
        scope = F.when(F.lower(raw) == key, name).otherwise(scope)
    on = pages.where(F.col("text").rlike(SCOPE_CURVE) & ~strip(F.col("text")).rlike(r"(?i)^construction progress s-?curve")).withColumn("scope", scope)
    text = winning(read_statements(on, ["doc_id", "scope"], "text", ("table_row",)), ["doc_id", "scope"]).select(*COLUMNS)
    left = on.join(text, ["doc_id", "scope"], "left_anti")
    tabs = _table_candidates(rows, left, lambda cs: four_or_two(_figures(cs)), 1).select("doc_id", F.col("attempt.page_no").alias("page_no"), "label", "plan", "actual").join(left.select("doc_id", "page_no", "scope"), ["doc_id", "page_no"])
    tabs = tabs.groupBy("doc_id", "scope", "label").agg(F.max_by(F.struct("plan", "actual"), "page_no").alias("s")).select("doc_id", "scope", "label", "s.plan", "s.actual")
    got = text.unionByName(tabs.select(*COLUMNS))
    return _with_primary(got if summary is None else _overlaid(got, summary), primary)


def _whole(pages: DataFrame, within: int | None = None) -> DataFrame:
    p = pages if within is None else pages.where(F.col("page_no") <= within)
    g = p.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", "text"))).alias("p"))
    return g.select("doc_id", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))


def _pair_rows(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.lit(None).cast("string").alias("scope"), F.lit("overall").alias("label"), "plan", "actual")


def whole_document(pages: DataFrame) -> DataFrame:
    """First plan/actual pair of the document; else the last cumulative figure of each."""
    first = lambda g: F.get(statements(F.col("text"), GRAMMARS[g]), F.lit(0))
    last = lambda g: F.try_element_at(statements(F.col("text"), GRAMMARS[g]), F.lit(-1))
    d = _whole(pages).select("doc_id", first("pair").alias("a"), last("cumulative_planned").alias("p"), last("cumulative_actual").alias("q"))
    d = d.select("doc_id", F.when(F.col("a").isNotNull(), F.col("a.plan")).otherwise(F.col("p.plan")).alias("plan"), F.when(F.col("a").isNotNull(), F.col("a.actual")).otherwise(F.col("q.actual")).alias("actual"))
    return _pair_rows(d.where("plan is not null or actual is not null"))


def physical_or_drawn(pages: DataFrame, drawn: DataFrame) -> DataFrame:
    """The physical-progress line of the first twenty pages; else what was read from the drawing, the
    last match of each label, either alone being allowed."""
    one = F.get(statements(F.col("text"), GRAMMARS["physical"]), F.lit(0))
    a = _whole(pages, 20).select("doc_id", one.alias("s")).where("s is not null").select("doc_id", "s.plan", "s.actual")
    last = lambda g: F.try_element_at(statements(F.col("text"), GRAMMARS[g]), F.lit(-1))
    b = drawn.join(a, "doc_id", "left_anti").select("doc_id", last("drawn_planned")["plan"].alias("plan"), last("drawn_actual")["actual"].alias("actual"))
    return _pair_rows(a.unionByName(b.where("plan is not null or actual is not null")))


def dispatched(kinds: DataFrame, families: dict[str, DataFrame]) -> DataFrame:
    """Each document's rows from the family of its kind (doc_id, kind); a document without a family or
    without figures has one row of nulls."""
    parts = [f.join(kinds.where(F.col("kind") == k).select("doc_id"), "doc_id", "left_semi").select(*COLUMNS) for k, f in families.items()]
    got = reduce(DataFrame.unionByName, parts)
    return kinds.select("doc_id").join(got, "doc_id", "left").select(*COLUMNS)


#: When a family's own reader replaces the generic scan: 'found' even if empty, 'items' only if not
#: empty, 'always' even if the section is absent, 'never'.  (concerns, activities)
POLICY = {
    "solar_listed": ("items", "items"), "solar": ("never", "items"), "wte": ("found", "found"), "wind": ("found", "items"), "terminal": ("found", "items"),
    "hydro_printed": ("found", "items"), "hydro_drawn": ("always", "items"),
}


def content(generic: DataFrame, own: DataFrame, policy: dict[str, tuple[str, str]] = POLICY, cap: int = 20) -> DataFrame:
    """(doc_id, field, items): generic (doc_id, kind, field, items) replaced by a family's reading
    (doc_id, field, items, found) as its policy says, at most ``cap`` items."""
    j = generic.join(own.select("doc_id", "field", F.col("items").alias("_own"), "found"), ["doc_id", "field"], "left")
    mode = F.lit("never")
    for kind, (concerns, activities) in policy.items():
        mode = F.when(F.col("kind") == kind, F.when(F.col("field") == "concerns", concerns).otherwise(activities)).otherwise(mode)
    j = j.withColumn("_mode", mode)
    own_wins = (F.col("_mode") == "always") | ((F.col("_mode") == "found") & F.coalesce("found", F.lit(False))) | ((F.col("_mode") == "items") & (F.coalesce(F.size("_own"), F.lit(0)) > 0))
    items = F.when(own_wins, F.coalesce("_own", F.array().cast("array<string>"))).otherwise(F.col("items"))
    return j.select("doc_id", "field", F.slice(items, 1, cap).alias("items"))
