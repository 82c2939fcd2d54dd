"""Text, wording, table and layout queries over documents and observations, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.functions import grammar, numeric, text
from reportloom.operators import layout, lines, tables
from reportloom.plans.history_queries import table_like
from reportloom.session import kept
from reportloom.sources import files

# What marks sections, furniture and pages.
SECTION_HEADER = r"(?i)question|finding|area of concern|next week|next period|upcoming"
SECTION_STOP = r"(?i)^(answer|action)\b"
MINUTE = r"^(\d+\.\d+)\s"
MINUTE_ITEM = r"^\d+\.\d+\s+(\S.*)$"
FURNITURE = r"(?i)^(status|no\.|<\s*open|\d+\s*$|minutes of meeting)"
PAGE_IN, PAGE_OUT, PAGE_DISC = r"(?i)weekly|week\s+\d|progress", r"(?i)monthly progress status|cumulative\s+monthly", r"(?i)engineer|procure|construct|commission"
CONCERN_WORD = r"(?i)concern|issue|delay"
#: Scope of a page by its first line, in order of precedence.
SCOPES = (("substation", r"(?i)substation"), ("line", r"(?i)115\s*kv|transmission line|t/l|cable"), ("comms", r"(?i)fiber|communication"), ("plant", r"(?i)construction status|turbine|plan\s*/\s*actual|progress"))
HEADER_ROW, TARGET_ROW = "discipline|item", "duct|rack|deck|basin|root|bay|row"
READ = ("stands_at", "compared", "summary", "callout", "pair", "delta", "physical", "inline", "signed_delta", "plan_then_actual", "actual_then_plan", "newline_plan", "table_row", "row_pair", "cumulative_planned", "cumulative_actual", "drawn_planned", "drawn_actual")
LABELLED = {"engineering": "Engineering", "procurement": "Procurement", "construction": "Construction"}


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _lines(s: SparkSession, d: str, *extra: str) -> DataFrame:
    return lines.lines(_t(s, d, "documents"), *extra)


def lines_clean(s, d):
    return lines.cleaned(_lines(s, d)).select("doc_id", "line_no", "line")


def lines_table_text(s, d):
    bare = text.strip(F.col("line"))
    return _lines(s, d).where(text.looks_like_table(F.col("line"))).select("doc_id", "line_no", bare.alias("line"))


def table_text_by_type(s, d):
    return _lines(s, d, "doc_type").groupBy("doc_type").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(text.looks_like_table(F.col("line"))).alias("n_table"))


def lines_numeric_dominant(s, d):
    return _lines(s, d).where(text.numeric_dominant(F.col("line"))).select("doc_id", "line_no")


def section_collect(s, d):
    return lines.section(_lines(s, d), SECTION_HEADER, SECTION_STOP).select("doc_id", "line_no", "line")


def item_fold(s, d):
    return lines.folded(_lines(s, d))


def numbered_items(s, d):
    return lines.first_lines(_lines(s, d))


def carry_forward_heading(s, d):
    return lines.with_heading(_lines(s, d), MINUTE).select("doc_id", "line_no", "heading", text.strip(F.col("line")).alias("line"))


def heading_items(s, d):
    return lines.heading_items(_lines(s, d), MINUTE_ITEM, FURNITURE)


def first_seen_top20(s, d):
    src = _lines(s, d).select("doc_id", "line_no", text.strip(F.col("line")).alias("item"))
    return lines.first_seen(src)


def page_include_exclude(s, d):
    docs = _t(s, d, "documents")
    t = F.col("text")
    return docs.where(t.rlike(PAGE_IN) & ~t.rlike(PAGE_OUT) & t.rlike(PAGE_DISC)).select("doc_id")


def concern_pages(s, d):
    t = F.col("text")
    return _t(s, d, "documents").where(t.rlike(CONCERN_WORD) & ~t.contains("%")).select("doc_id")


def page_scope_case(s, d):
    first = F.get(F.split("text", "\n"), F.lit(0))
    out = F.lit(None).cast("string")
    for name, p in reversed(SCOPES):
        out = F.when(first.rlike(p), name).otherwise(out)
    return _t(s, d, "documents").where("text is not null").select("doc_id", out.alias("scope"))


def from_marker(s, d):
    cut = lines.from_marker(F.col("text"), "(?i)action")
    return _t(s, d, "documents").where("text is not null").select("doc_id", F.length(cut).alias("n"), F.md5(F.encode(cut, "utf-8")).alias("digest"))


def doc_concat(s, d):
    return lines.joined(_lines(s, d)).select("doc_id", F.md5(F.encode("text", "utf-8")).alias("digest"))


def split_items(s, d):
    field = lambda c: F.struct(F.lit(c).alias("field"), text.split_items(F.col(c)).alias("items"))
    w = _t(s, d, "w32_2026").select("snap_id", F.explode(F.array(field("first_concern"), field("first_activity"))).alias("x"))
    return w.select("snap_id", "x.field", F.explode("x.items").alias("item"))


def status_statements(s, d):
    return grammar.read_statements(_t(s, d, "documents"), ["doc_id"], "text", READ).select("doc_id", "grammar", "match_no", "label", "plan", "actual")


VALID = "plan between 0 and 100 and actual between 0 and 100"


def _figures(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "obs_discipline").where(VALID).select("project_id", "year", "week", "scope", "discipline", numeric.exact(F.col("plan")).alias("plan"), numeric.exact(F.col("actual")).alias("actual"))


def status_round_trip(s, d):
    """Every observation rendered in every wording and read back: figures recovered by wording.

    Observations with the same figures give the same texts; each text is written and read once and
    counts for all of them.
    """
    c = F.col
    same = _t(s, d, "obs_discipline").where(VALID).groupBy("plan", "actual").agg(F.count(F.lit(1)).alias("n"))
    same = kept(same.select(numeric.exact(c("plan")).alias("plan"), numeric.exact(c("actual")).alias("actual"), "n"))
    shown = {
        "plan": c("plan").cast("string"), "actual": c("actual").cast("string"),
        "direction": F.when(c("plan") >= c("actual"), "Delayed").otherwise("Ahead"), "delta": F.abs(c("plan") - c("actual")).cast("string"), "signed": (c("actual") - c("plan")).cast("string"),
    }

    def recovered(g: grammar.Grammar) -> DataFrame:
        parts = shown | {"label": F.lit("Overall project" if g.name == "plan_then_actual" else "Overall")}
        own = [x for x in g.groups if x != "label"]
        texts = same if len(own) > 1 else same.groupBy(*own).agg(F.sum("n").alias("n"))  # a wording of one figure has few texts
        found = grammar.first_statements(texts.select("n", grammar.rendered(g, parts).alias("text")), ["n"], "text", g)
        # printed figures have at most two decimals, so the nearest whole number of cents is theirs
        cents = lambda v: F.sum(F.floor(c(v) * 100 + 0.5) * c("n")) if v in g.figures else F.lit(0).cast("bigint")
        sums = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), cents("plan").alias("plan_cents"), cents("actual").alias("actual_cents"))
        return sums.select(F.lit(g.name).alias("grammar"), "n", "plan_cents", "actual_cents")

    return reduce(DataFrame.unionAll, map(recovered, grammar.GRAMMARS.values()))


def _wins(s, d, last: bool):
    label = F.lower("discipline")
    src = _figures(s, d).where(label.isin(*LABELLED))
    one = F.format_string(grammar.GRAMMARS["stands_at"].wording, F.initcap(label), F.col("actual").cast("string"), F.col("plan").cast("string"))
    docs = src.groupBy("project_id", "year", "week", "scope").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("plan", "actual", one.alias("t")))), lambda x: x["t"]), ".\n").alias("text"))
    keys = ["project_id", "year", "week", "scope"]
    return grammar.winning(grammar.read_statements(docs, keys, "text", ("stands_at",)), keys, last).select(*keys, "label", "plan", "actual")


def last_match_wins(s, d):
    return _wins(s, d, True)


def first_match_wins(s, d):
    return _wins(s, d, False)


def overall_or_construction(s, d):
    found = grammar.read_statements(_t(s, d, "documents"), ["doc_id"], "text", ("stands_at", "compared", "summary"))
    return grammar.overall_or(grammar.winning(found, ["doc_id"]), ["doc_id"])


def single_or_pair(s, d):
    """Numbers of every line: the first two, where there are two."""
    n = numeric.numbers_in(F.col("line"))
    return _lines(s, d).select("doc_id", "line_no", F.get(n, F.lit(0)).alias("plan"), F.get(n, F.lit(1)).alias("actual"), F.size(n).alias("k")).where("k >= 2").drop("k")


def pick_from_end(s, d):
    picked = numeric.pick_from_end(numeric.numbers_in(F.col("text")))
    return _t(s, d, "documents").select("doc_id", picked.alias("p")).where("p is not null").select("doc_id", "p.plan", "p.actual", F.size("p.lead").alias("n_lead"))


def _grid(s, d):
    return tables.grid(_t(s, d, "documents"))


def pct_parse(s, d):
    return tables.cells(_grid(s, d)).select("doc_id", "row_no", "col_no", numeric.parse_pct(F.col("cell")).alias("v"))


def positional_pick(s, d):
    return _grid(s, d).select("doc_id", "row_no", numeric.positional(F.col("cells")).alias("p")).select("doc_id", "row_no", "p.plan", "p.actual")


def multicol_rows(s, d):
    return _grid(s, d).where(text.multi_column(F.col("cells"))).select("doc_id", "row_no", F.size("cells").alias("n_cells"))


def labelled_pairs(s, d):
    return tables.labelled_pairs(_grid(s, d))


def header_target_join(s, d):
    return tables.header_by_target(_grid(s, d), HEADER_ROW, TARGET_ROW)


def variance_consistency(s, d):
    """Table rows whose printed variance agrees with their figures."""
    v = [numeric.parse_pct(F.regexp_replace(F.get("cells", F.lit(k)), r"^[+-]", "")) for k in (1, 2, 3)]
    g = _grid(s, d).select("doc_id", "row_no", *(x.alias(n) for x, n in zip(v, ("plan", "actual", "variance"), strict=True)))
    return g.where("plan is not null and actual is not null and variance is not null").select("doc_id", "row_no", numeric.consistent(F.col("plan"), F.col("actual"), F.col("variance")).alias("agrees"))


def file_router(s, d):
    """Of each part type the part whose name holds the type's word; brand 1 is canonical."""
    p = _t(s, d, "part")
    words = p.select(F.col("p_type").alias("project"), F.substring("p_type", 1, 3).alias("keyword")).distinct()
    names = p.select(F.format_string("%06d %s %s", "p_partkey", "p_name", "p_type").alias("name"), F.col("p_brand").alias("brand"))
    return files.routed(words, names, F.col("brand") == "Brand#1").select("project", "name")


def norm_key_join(s, d):
    """Scope names of observations resolved to those of snapshots, whatever the spelling."""
    a = _t(s, d, "obs_discipline").where("scope is not null").select(F.upper("scope").alias("wanted")).distinct()
    b = _t(s, d, "w32_2026").select(F.explode(F.map_keys("scopes")).alias("entry")).distinct()
    return files.resolved(a, b)


def folder_dates(s, d):
    day = F.col("o_orderdate")
    name = F.concat(F.lit("24_"), F.date_format(day, "yyMMdd"))
    return _t(s, d, "orders").select(name.alias("folder")).distinct().select("folder", text.folder_date(F.col("folder")).cast("string").alias("day"))


def source_weeks(s, d):
    """Documents by the week folder in their source, and whether it is the newest."""
    p = r"^W(\d+)_(\d+)/"
    src = _t(s, d, "documents").select(F.regexp_extract("source", p, 2).try_cast("int").alias("year"), F.regexp_extract("source", p, 1).try_cast("int").alias("week"))
    n = src.where("week is not null").groupBy("year", "week").agg(F.count(F.lit(1)).alias("n"))
    newest = n.agg(F.max(F.struct("year", "week")).alias("w")).select("w.year", "w.week", F.lit(True).alias("newest"))
    return n.join(newest, ["year", "week"], "left").withColumn("newest", F.coalesce("newest", F.lit(False)))


def column_letters(s, d):
    return _t(s, d, "nation").select("n_name", numeric.letters_to_index(F.regexp_extract("n_name", "^([A-Z]{1,2})", 1)).cast("int").alias("column_no"))


def visual_lines(s, d):
    """Words of every document laid out with jitter, gathered to visual lines again."""
    w = _lines(s, d).select(F.col("doc_id"), (F.expr("line_no div 50") + 1).cast("int").alias("page_no"), "line_no", F.posexplode(text.tokens(F.col("line"))).alias("k", "text"))
    laid = w.select("doc_id", "page_no", "text", (F.col("k") * 10.0).alias("x0"), (F.col("k") * 10.0 + 8).alias("x1"), ((F.col("line_no") % 50) * 10.0 + F.col("k") % 3).alias("top"))
    return layout.page_lines(laid).select("doc_id", "page_no", "top", "text")


def queries() -> dict:
    named = (
        lines_clean, lines_table_text, table_text_by_type, lines_numeric_dominant, section_collect, item_fold, numbered_items, carry_forward_heading, heading_items,
        first_seen_top20, page_include_exclude, concern_pages, page_scope_case, from_marker, doc_concat, split_items, status_statements, status_round_trip,
        last_match_wins, first_match_wins, overall_or_construction, single_or_pair, pick_from_end, pct_parse, positional_pick, multicol_rows, labelled_pairs,
        header_target_join, variance_consistency, file_router, norm_key_join, folder_dates, source_weeks, column_letters, visual_lines,
    )
    return {f.__name__: f for f in named}


# Fixed values, written out again: the SQL does not take the patterns of the readers it is held against.
_N = r"(\d{1,3}(?:\.\d{1,2})?)"
_SAID = {
    "row_pair": ("label plan actual", rf"(?i)(engineer|procure|construct|commission|overall)\w*\s+{_N}\s+{_N}"),
    "callout": ("plan actual", rf"(?i)plan\s*/\s*actual\s*:?[\s\S]{{0,20}}?{_N}\s*%\s*/\s*{_N}\s*%"),
    "stands_at": ("label actual plan", rf"(?i)(overall|engineering|procurement|construction)\s+(?:project\s+)?progress\s+stands\s+at\s*{_N}\s*%\s+against\s+the\s+planned\s+progress\s+of\s*{_N}\s*%"),
    "compared": ("label actual plan", rf"(?i)(overall|engineering|procurement|construction|civil|electrical)\s+(?:project\s+|pre-civil\s+|construction\s+|work\s+)?progress\s+{_N}\s*%\s+compared\s+to\s+plan\s+at\s+{_N}\s*%"),
    "summary": ("label actual plan", rf"(?i)(overall|construction|commissioning|civil|electrical|engineering|procurement)\s*progress\s*(?:is\s+)?{_N}\s*%\s*(?:/\s*plan\s*at|vs\s+plan|against\s+plan)\s*{_N}\s*%"),
    "plan_then_actual": ("label plan actual", rf"(?i)(overall\s+project|construction)\s+progress\s*[\r\n]+\s*-\s*plan\s*=\s*{_N}\s*%\s*[\r\n]+\s*-\s*actual\s*=\s*{_N}\s*%"),
    "actual_then_plan": ("actual plan", rf"(?i)overall\s+progress\s+actual\s*=\s*{_N}\s*%,?\s*[\r\n]+\s*-?\s*overall\s+progress\s+plan\s*=\s*{_N}\s*%"),
    "newline_plan": ("label actual plan", rf"(?i)(overall|construction)\s+progress\s*\n?\s*(?:actual\s*)?{_N}\s*%\s*\n\s*plan\s*{_N}\s*%"),
    "delta": ("label actual direction delta", rf"(?i)(construction|overall)\s+progress\s*=\s*{_N}\s*%\s*(delayed|ahead)\s*{_N}\s*%"),
    "inline": ("actual plan", rf"(?i)progress\s*{_N}\s*%\s*\(\s*plan\s*{_N}\s*%"),
    "signed_delta": ("actual signed", r"(?i)progress\s*(\d{1,3}(?:\.\d{1,2})?)\s*%\s*\([^,]*,\s*(-?\d{1,3}(?:\.\d{1,2})?)\s*%\)"),
    "table_row": ("label plan actual", rf"(?im)^(engineering|procurement|construction|commissioning|overall)\s+{_N}\s*%\s+{_N}\s*%"),
    "pair": ("plan actual", rf"(?i)plan/actual\s*[：:]\s*{_N}%\s*/\s*{_N}%"),
    "cumulative_planned": ("plan", r"(?im)cum\.?\s*progress\s*[-–]\s*planned[^\n]*?(\d{1,3}\.\d{2})%\s*$"),
    "cumulative_actual": ("actual", r"(?im)cum\.?\s*progress\s*[-–]\s*actual[^\n]*?(\d{1,3}\.\d{2})%\s*$"),
    "physical": ("plan actual", rf"(?i)physical\s+progress.*?{_N}%.*?{_N}%"),
    "drawn_planned": ("plan", rf"(?i)(?:accumulative\s+)?planned\s+progress\s*(?:up\s+to[^=\n]*)?=\s*{_N}\s*%"),
    "drawn_actual": ("actual", rf"(?i)(?:accumulative\s+)?achie?ved\s+progress\s*(?:up\s+to[^=\n]*)?=\s*{_N}\s*%"),
}
_LINES = """ls as (select doc_id, doc_type, string_split(text, chr(10)) as l from documents where text is not null),
raw as (select doc_id, doc_type, cast(generate_subscripts(l, 1) - 1 as int) as line_no, unnest(l) as line from ls),
lines as (select *, regexp_replace(line, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') as s from raw)"""
_STRIP = "regexp_replace({0}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"
_BARE = _STRIP.format(f"regexp_replace(s, '^[\\-•*\\d]+[.)]\\s*', '')")
_TOK = r"list_filter(string_split_regex(s, '[\s\p{Z}]+'), lambda t: t <> '')"
_NUMS = f"len(list_filter({_TOK}, lambda t: regexp_matches(t, '^[\\d.,%()+\\-]+$')))"
_GRID = r"""rows_ as (select doc_id, string_split_regex(text, '\r?\n') as l from documents where text is not null),
flat as (select doc_id, cast(generate_subscripts(l, 1) - 1 as int) as row_no, unnest(l) as line from rows_),
grid as (select doc_id, row_no, string_split(line, chr(9)) as cells from flat where contains(line, chr(9)))"""


def _pct(x: str) -> str:
    bare = r"regexp_replace(regexp_replace(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '%+$', ''), '^\s+|\s+$', '', 'g')".format(x)
    v = f"try_cast({bare} as double)"
    return f"case when {v} between 0 and 100 then {v} end"


def _numbers(x: str) -> str:
    return rf"list_filter(list_transform(regexp_extract_all({x}, '(\d{{1,3}}(?:\.\d{{1,2}})?)', 1), lambda v: cast(v as double)), lambda v: v between 0 and 100)"


def _clean_where(bare: str = _BARE) -> str:
    return f"s <> '' and not regexp_matches(s, '^\\d+\\s*$') and not regexp_matches(s, '(?i)^(action|table of content|page|note:|concern to achieve|next milestone)') and length(s) >= 8 and {bare} <> ''"


def _statements_sql(name: str) -> str:
    groups, pattern = _SAID[name][0].split(), _SAID[name][1]
    part = ", ".join(f"unnest(regexp_extract_all(text, '{pattern}', {k + 1})) as {x}_" for k, x in enumerate(groups))
    label = "regexp_replace(lower(label_), '\\s+project$', '')" if "label" in groups else "'overall'"
    dec = "cast({0} as decimal(9,2))"
    plan, actual = ("cast(plan_ as double)" if "plan" in groups else "null"), ("cast(actual_ as double)" if "actual" in groups else "null")
    if "delta" in groups:
        plan = f"cast(case when lower(direction_) = 'delayed' then {dec.format('actual_')} + {dec.format('delta_')} else {dec.format('actual_')} - {dec.format('delta_')} end as double)"
    if "signed" in groups:
        plan = f"cast({dec.format('actual_')} - {dec.format('signed_')} as double)"
    ok = lambda e: f"case when {e} between 0 and 100 then {e} end" if e != "null" else "cast(null as double)"
    return f"""select doc_id, '{name}' as grammar, cast(n as int) as match_no, {label} as label, {ok(plan)} as plan, {ok(actual)} as actual from (
  select doc_id, {part}, generate_subscripts(regexp_extract_all(text, '{pattern}', 1), 1) as n from documents where text is not null)"""


_FIG = """fig as (select project_id, year, week, scope, discipline, cast(plan as decimal(9,2)) as plan, cast(actual as decimal(9,2)) as actual
  from obs_discipline where plan between 0 and 100 and actual between 0 and 100)"""


def _wins_sql(o: str) -> str:
    return f"""with {_FIG} select project_id, year, week, scope, label, cast(plan as double) as plan, cast(actual as double) as actual from (
  select *, lower(discipline) as label, row_number() over (partition by project_id, year, week, scope, lower(discipline) order by plan {o}, actual {o}) as r
  from fig where lower(discipline) in ('engineering', 'procurement', 'construction')) where r = 1"""


def oracle_sql() -> dict[str, str]:
    has = {n: g.split() for n, (g, _) in _SAID.items()}
    start = r"^(?:\d+[.)]|[-–•▪*☐✔])\s*"
    first_line = "string_split(text, chr(10))[1]"
    scope = " ".join(f"when regexp_matches({first_line}, '{p}') then '{n}'" for n, p in SCOPES)
    cut = "coalesce(nullif(regexp_extract(text, '(?is)action.*'), ''), text)"
    joined = "lower(list_aggregate(cells, 'string_agg', ' '))"
    multi = "len(list_filter(cells, lambda c: c is not null and c <> '')) >= 3"
    empty = f"upper({_STRIP.format(chr(114) + 'egexp_replace(cell, ' + chr(39) + chr(92) + 's*' + chr(92) + 'd+' + chr(92) + 's*$' + chr(39) + ', ' + chr(39) * 2 + ')')})"
    figs = f"list_filter(list_transform(cells[2:], lambda c: {_pct('c')}), lambda v: v is not null)"
    out = {
        "lines_clean": f"with {_LINES} select doc_id, line_no, {_BARE} as line from lines where {_clean_where()}",
        "lines_table_text": f"with {_LINES} select doc_id, line_no, s as line from lines where {table_like('s')}",
        "table_text_by_type": f"with {_LINES} select doc_type, count(*) as n_lines, count(*) filter ({table_like('s')}) as n_table from lines group by doc_type",
        "lines_numeric_dominant": f"with {_LINES} select doc_id, line_no from lines where len({_TOK}) >= 4 and {_NUMS} >= 3 and {_NUMS} * 2 >= len({_TOK})",
        "section_collect": f"""with {_LINES},
a as (select *, coalesce(bool_or(regexp_matches(line, '{SECTION_HEADER}')) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding), false) as inside from lines),
b as (select *, s = '' as blank from a where inside),
c as (select *, regexp_matches(line, '{SECTION_STOP}') or (blank and coalesce(lag(blank, 1) over w, false) and coalesce(lag(blank, 2) over w, false)) as ends from b window w as (partition by doc_id order by line_no)),
d as (select *, bool_or(ends) over (partition by doc_id order by line_no) as over_ from c),
e as (select *, row_number() over (partition by doc_id order by line_no) as n from d where not over_ and not blank)
select doc_id, line_no, {_BARE} as line from e where n <= 30 and {_clean_where()}""",
        "item_fold": f"""with {_LINES},
a as (select *, regexp_matches(s, '{start}') as opens from lines where s <> ''),
b as (select *, cast(sum(case when opens then 1 else 0 end) over (partition by doc_id order by line_no) as int) as item_no from a),
c as (select doc_id, item_no, string_agg(case when opens then {_STRIP.format(f"regexp_replace(s, '{start}', '')")} else s end, ' ' order by line_no) as item from b group by 1, 2)
select * from c where item <> ''""",
        "numbered_items": f"""with {_LINES}, a as (select doc_id, line_no, {_STRIP.format(f"regexp_replace(s, '^\\d+[.)]\\s*', '')")} as item from lines where regexp_matches(s, '^\\d+[.)]\\s*'))
select * from a where length(item) > 5""",
        "carry_forward_heading": f"""with {_LINES}, a as (select *, nullif(regexp_extract(line, '{MINUTE}', 1), '') as h from lines),
b as (select *, last_value(h ignore nulls) over (partition by doc_id order by line_no) as heading from a)
select doc_id, line_no, heading, s as line from b where h is null""",
        "heading_items": f"""with {_LINES},
a as (select *, regexp_matches(s, '{MINUTE_ITEM}') as opens from lines),
b as (select *, sum(case when opens then 1 else 0 end) over (partition by doc_id order by line_no) as k from a),
c as (select * from b where k > 0 and (opens or (s <> '' and not regexp_matches(s, '[　-鿿＀-￯]') and regexp_matches(s, '[A-Za-z]{{3}}') and not regexp_matches(s, '{FURNITURE}')))),
d as (select *, not opens and regexp_matches(s, '^[-–•‑]') as dash from c),
e as (select *, bool_or(dash) over (partition by doc_id, k order by line_no) as seen from d),
f as (select *, not opens and not seen as lead_ from e),
g as (select *, coalesce(sum(case when lead_ then length(s) end) over (partition by doc_id, k order by line_no rows between unbounded preceding and 1 preceding), 0) as had from f),
h as (select doc_id, k, min(line_no) as line_no, max({_STRIP.format(f"regexp_extract(s, '{MINUTE_ITEM}', 1)")}) filter (opens) as head,
  string_agg(s, ' ' order by line_no) filter (lead_ and had < 220) as body,
  arg_min({_STRIP.format("regexp_replace(s, '^[-–• ]+', '')")}, line_no) filter (dash) as first_dash from g group by doc_id, k),
i as (select doc_id, line_no, case when coalesce(nullif(body, ''), first_dash, '') <> '' then head || ' — ' || coalesce(nullif(body, ''), first_dash) else head end as item from h where head <> ''),
j as (select doc_id, item, min(line_no) as at_ from i where length(item) > 10 group by 1, 2),
l as (select doc_id, cast(row_number() over (partition by doc_id order by at_) as int) as ord, item from j)
select * from l where ord <= 20""",
        "first_seen_top20": f"""with {_LINES}, a as (select doc_id, s as item, min(line_no) as at_ from lines where length(s) > 10 group by 1, 2),
b as (select doc_id, cast(row_number() over (partition by doc_id order by at_) as int) as ord, item from a) select * from b where ord <= 20""",
        "page_include_exclude": f"select doc_id from documents where regexp_matches(text, '{PAGE_IN}') and not regexp_matches(text, '{PAGE_OUT}') and regexp_matches(text, '{PAGE_DISC}')",
        "concern_pages": f"select doc_id from documents where regexp_matches(text, '{CONCERN_WORD}') and not contains(text, '%')",
        "page_scope_case": f"select doc_id, case {scope} end as scope from documents where text is not null",
        "from_marker": f"select doc_id, cast(length({cut}) as int) as n, md5({cut}) as digest from documents where text is not null",
        "doc_concat": "select doc_id, md5(text) as digest from documents where text is not null",
        "split_items": " union all ".join(
            f"""select snap_id, '{c}' as field, unnest(list_filter(list_transform(string_split_regex({c}, '[\\n;]+'), lambda x: {_STRIP.format("x")}), lambda x: x <> '')) as item
from w32_2026 where {c} is not null and lower({_STRIP.format(c)}) not in ('', '-', 'n/a', 'none')"""
            for c in ("first_concern", "first_activity")
        ),
        "status_statements": " union all ".join(_statements_sql(n) for n in READ),
        "status_round_trip": f"with {_FIG} "
        + " union all ".join(
            f"""select '{n}' as grammar, count(*) as n, cast({"sum(cast(plan * 100 as bigint))" if set(g) & {"plan", "delta", "signed"} else "0"} as bigint) as plan_cents,
  cast({"sum(cast(actual * 100 as bigint))" if "actual" in g else "0"} as bigint) as actual_cents from fig"""
            for n, g in has.items()
        ),
        "last_match_wins": _wins_sql("desc"),
        "first_match_wins": _wins_sql("asc"),
        "overall_or_construction": f"""with f as ({" union all ".join(f"select {k} as g, * from ({_statements_sql(n)})" for k, n in enumerate(("stands_at", "compared", "summary")))}),
w as (select * from (select *, row_number() over (partition by doc_id, label order by g desc, match_no desc) as r from f) where r = 1)
select doc_id, coalesce(max(plan) filter (label = 'overall'), max(plan) filter (label = 'construction')) as plan,
  coalesce(max(actual) filter (label = 'overall'), max(actual) filter (label = 'construction')) as actual from w group by doc_id""",
        "single_or_pair": f"with {_LINES}, n as (select doc_id, line_no, {_numbers('line')} as v from lines) select doc_id, line_no, v[1] as plan, v[2] as actual from n where len(v) >= 2",
        "pick_from_end": f"with n as (select doc_id, {_numbers('text')} as v from documents where text is not null) select doc_id, v[-4] as plan, v[-3] as actual, cast(len(v) - 6 as int) as n_lead from n where len(v) >= 6",
        "pct_parse": f"with {_GRID}, c as (select doc_id, row_no, cast(generate_subscripts(cells, 1) - 1 as int) as col_no, unnest(cells) as cell from grid) select doc_id, row_no, col_no, {_pct('cell')} as v from c",
        "positional_pick": f"""with {_GRID}, f as (select *, {figs} as v from grid)
select doc_id, row_no, case when len(cells) >= 7 then {_pct("cells[6]")} else v[1] end as plan, case when len(cells) >= 7 then {_pct("cells[7]")} else v[2] end as actual from f""",
        "multicol_rows": f"with {_GRID} select doc_id, row_no, cast(len(cells) as int) as n_cells from grid where {multi}",
        "labelled_pairs": f"""with {_GRID}, f as (select *, {figs} as v, lower({_STRIP.format("regexp_replace(cells[1], '[\\s\\p{Z}]+', ' ', 'g')")}) as label from grid),
g as (select *, row_number() over (partition by doc_id, label order by row_no desc) as r from f where len(v) >= 2 and label <> '')
select doc_id, label, case when len(v) >= 4 then v[3] else v[1] end as plan, case when len(v) >= 4 then v[4] else v[2] end as actual from g where r = 1""",
        "header_target_join": f"""with {_GRID}, m as (select *, {joined} as j from grid where {multi}),
p as (select doc_id, min(row_no) filter (regexp_matches(j, '{HEADER_ROW}')) as h, max(row_no) filter (regexp_matches(j, '{TARGET_ROW}')) as t from m group by doc_id),
c as (select m.doc_id, m.row_no, p.h, p.t, cast(generate_subscripts(cells, 1) - 1 as int) as col_no, unnest(cells) as cell from m join p on m.doc_id = p.doc_id and (m.row_no = p.h or m.row_no = p.t) where h is not null and t is not null),
q as (select doc_id, col_no, max(cell) filter (row_no = h) as hd, max(cell) filter (row_no = t) as cell from c group by doc_id, col_no)
select doc_id, col_no, {_STRIP.format("regexp_replace(hd, '[\\s\\p{Z}]+', ' ', 'g')")} as header, cell as value from q
where hd is not null and hd <> '' and cell is not null and cell <> '' and {empty} not in ('', 'N/A', 'NA', 'N.A', '-', 'NONE')""",
        "variance_consistency": f"""with {_GRID}, f as (select doc_id, row_no, {", ".join(f"{_pct(f"regexp_replace(cells[{k}], '^[+-]', '')")} as v{k}" for k in (2, 3, 4))} from grid)
select doc_id, row_no, abs(abs(v3 - v2) - v4) <= 0.06 as agrees from f where v2 is not null and v3 is not null and v4 is not null""",
        "file_router": """with k as (select distinct p_type as project, left(p_type, 3) as keyword from part),
f as (select printf('%06d %s %s', p_partkey, p_name, p_type) as name, p_brand = 'Brand#1' as canonical from part),
h as (select project, name, row_number() over (partition by project order by canonical desc, name) as r from k join f on contains(upper(name), upper(keyword)))
select k.project, h.name from (select distinct project from k) k left join h on k.project = h.project and h.r = 1""",
        "norm_key_join": """with a as (select distinct upper(scope) as wanted from obs_discipline where scope is not null),
b as (select distinct unnest(map_keys(scopes)) as entry from w32_2026),
j as (select wanted, entry, row_number() over (partition by wanted order by coalesce(wanted = entry, false) desc, entry) as r
  from a left join b on regexp_replace(lower(wanted), '[^a-z0-9]', '', 'g') = regexp_replace(lower(entry), '[^a-z0-9]', '', 'g'))
select wanted, entry from j where r = 1""",
        "folder_dates": "select distinct '24_' || strftime(o_orderdate, '%y%m%d') as folder, '20' || strftime(o_orderdate, '%y-%m-%d') as day from orders",
        "source_weeks": r"""with s as (select try_cast(regexp_extract(source, '^W(\d+)_(\d+)/', 2) as int) as year, try_cast(regexp_extract(source, '^W(\d+)_(\d+)/', 1) as int) as week from documents),
n as (select year, week, count(*) as n from s where week is not null group by 1, 2)
select year, week, n, year * 100 + week = (select max(year * 100 + week) from n) as newest from n""",
        "column_letters": r"""with a as (select n_name, regexp_extract(n_name, '^([A-Z]{1,2})', 1) as l from nation)
select n_name, cast(case when l = '' then null when length(l) = 1 then ascii(l) - 65 else (ascii(l) - 64) * 26 + ascii(substr(l, 2, 1)) - 65 end as int) as column_no from a""",
        "visual_lines": f"""with {_LINES} select doc_id, cast(line_no // 50 + 1 as int) as page_no, cast((line_no % 50) * 10.0 as double) as top, list_aggregate({_TOK}, 'string_agg', ' ') as text from lines where len({_TOK}) > 0""",
    }
    return out
