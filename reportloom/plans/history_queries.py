"""History, rules, structure and reporting queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.functions import numeric, text
from reportloom.operators import history, rules, structure
from reportloom.sources import files, seeds, sinks

NOW = (2026, 32)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _panel(s: SparkSession, d: str) -> DataFrame:
    return history.panel(_t(s, d, "history"))


WEEK = ("project_id", "year", "week")


def _newest_pins(s: SparkSession, d: str) -> DataFrame:
    """The last snapshot of every project and week."""
    w = _t(s, d, "w32_2026")
    last = w.groupBy(*WEEK).agg(F.max(F.struct("pin_no", "snap_id")).alias("l")).select(F.col("l.snap_id").alias("snap_id"))
    return w.join(last, "snap_id", "left_semi")


def _lists(w: DataFrame, *keys: str) -> DataFrame:
    """(…keys, field, items): the lines of both text fields of snapshots."""
    item = lambda f, c: F.struct(F.lit(f).alias("field"), F.split(F.col(c), "\n").alias("items"))
    return w.select(*keys, F.explode(F.array(item("concerns", "first_concern"), item("activities", "first_activity"))).alias("x")).select(*keys, "x.*")


def _ruled(s: SparkSession, d: str) -> DataFrame:
    rows = rules.expected(history.with_previous(_panel(s, d)), _t(s, d, "dim_project"), _t(s, d, "dim_expectation"))
    return rules.with_junk(rows, rules.content_not_prose(_lists(_newest_pins(s, d), *WEEK), WEEK), WEEK)


def _findings(s: SparkSession, d: str) -> DataFrame:
    """All thirteen rules: those of the panel, and of the last snapshot of each recorded week."""
    pins = _newest_pins(s, d)
    scopes = pins.select(*WEEK, F.explode("scopes").alias("scope", "v")).select(*WEEK, "scope", "v.plan", "v.actual")
    below = rules.detail_findings(rules.scope_incomplete(scopes, WEEK), rules.content_not_prose(_lists(pins, *WEEK), WEEK))
    return rules.findings(_ruled(s, d)).unionByName(below.join(_panel(s, d).select(*WEEK), list(WEEK), "left_semi"))


def rule(name: str):
    def run(s: SparkSession, d: str) -> DataFrame:
        return rules.findings(_ruled(s, d)).where(F.col("rule") == name).select("project_id", "year", "week", "subject")

    return run


PANEL_RULES = (
    "missing-pct", "pct-out-of-range", "missing-disciplines", "missing-scopes", "content-truncated", "content-empty",
    "variance-large", "value-vanished", "actual-went-backwards", "structure-shrank", "value-frozen",
)


def history_upsert(s, d):
    """A re-recorded batch (the latest load of each feed) applied twice to the log."""
    log = _t(s, d, "history")
    last = log.groupBy("feed").agg(F.max("load_id").alias("load_id"))
    batch = log.join(last, ["feed", "load_id"], "left_semi")
    return history.upsert(log, batch.unionByName(batch))


def history_first_wins(s, d):
    return history.panel(_t(s, d, "history"), last=False)


def history_summary(s, d):
    return history.recorded_summary(_panel(s, d))


def history_of_project(s, d):
    """The recorded weeks of every project, oldest first."""
    return _panel(s, d).select("project_id", "year", "week", "plan", "actual").orderBy("project_id", "year", "week")


def prev_week(s, d):
    return history.with_previous(_panel(s, d)).select("project_id", "year", "week", "plan", "actual", "prev_year", "prev_week", "prev_plan", "prev_actual", "prev_n_disc", "prev_n_scopes")


def frozen_streak(s, d):
    return history.with_previous(_panel(s, d)).select("project_id", "year", "week", F.col("prev_streak").cast("int").alias("prev_streak"))


def report_due(s, d):
    return history.due(_panel(s, d), _t(s, d, "dim_project"), _t(s, d, "dim_cadence"), *NOW)


def missing_reports(s, d):
    return history.missing_reports(_panel(s, d), _t(s, d, "dim_project"), _t(s, d, "dim_cadence"), *NOW)


def week_keys(s, d):
    key = F.concat("project_id", F.lit("_W"), F.col("week").cast("string"), F.lit("_"), F.col("year").cast("string"))
    y, w = text.week_key(F.col("key"))
    return _panel(s, d).select(key.alias("key")).select("key", y.alias("year"), w.alias("week"))


def iso_tuesdays(s, d):
    return _panel(s, d).select("year", "week").distinct().select("year", "week", text.tuesday_of(F.col("year"), F.col("week")).cast("string").alias("day"))


def findings_all(s, d):
    return _findings(s, d)


def findings_counts(s, d):
    return rules.counts(_findings(s, d))


def findings_by_project(s, d):
    return rules.by_project(_findings(s, d))


def findings_text(s, d):
    """The findings of every recorded week of every project as lines."""
    return rules.as_text(_findings(s, d))


def rule_scope_incomplete(s, d):
    return rules.scope_incomplete(structure.snapshot_scopes(_t(s, d, "w32_2026")), ("snap_id",))


def rule_content_not_prose(s, d):
    """Snapshots whose lists hold table lines: how many of how many, the first, and a note at the cap."""
    return rules.content_not_prose(_lists(_t(s, d, "w32_2026"), "snap_id"), ("snap_id",))


def discipline_rows(s, d):
    return structure.tidy(_t(s, d, "obs_discipline"))


def snapshot_discipline_rows(s, d):
    clean = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return structure.snapshot_disciplines(_t(s, d, "w32_2026")).select("snap_id", "project_id", "scope", "discipline", *map(clean, ("plan", "actual", "wf")))


def weighted_overall(s, d):
    return structure.weighted_overall(structure.tidy(_t(s, d, "obs_discipline")), ("project_id", "year", "week", "scope"))


def _ok(df: DataFrame) -> DataFrame:
    inside = lambda c: F.when(F.col(c).between(0.0, 100.0), F.col(c))
    return df.withColumns({c: inside(c) for c in ("plan", "actual")})


def summary_overlay(s, d):
    """Scopes of every week by observation, overlaid with those of each pin of the week in turn; weeks
    of a project without a pin have theirs once, with a null pin_no."""
    w, keys = _t(s, d, "w32_2026"), ["project_id", "year", "week"]
    top = _ok(w.select(*keys, "pin_no", F.explode("scopes").alias("scope", "v")).select(*keys, "pin_no", "scope", "v.plan", "v.actual"))
    base = structure.weighted_overall(structure.tidy(_t(s, d, "obs_discipline")).where("scope is not null"), (*keys, "scope"))
    return structure.overlay(base.join(w.select(*keys, "pin_no").distinct(), keys, "left"), top, [*keys, "pin_no", "scope"])


def fixture_paths(s, d):
    return structure.paths(_t(s, d, "w32_2026"), ["project_id", "pin_no"])


def fixture_diff(s, d):
    """Each pin of a project against its next one."""
    return structure.diff_successive(_t(s, d, "w32_2026"), "project_id", "pin_no")


def variance_bands(s, d):
    p = _ok(_panel(s, d))
    v = numeric.exact(F.col("actual")) - numeric.exact(F.col("plan"))
    return p.select("project_id", "year", "week", numeric.fixed2(F.col("plan")).alias("plan_text"), numeric.fixed2(F.col("actual")).alias("actual_text"), numeric.fixed2(v, signed=True).alias("variance_text"), numeric.variance_band(v).alias("band"))


def summary_rows(s, d):
    """Project rows with their scope rows below, of every pin."""
    return _summary(_t(s, d, "w32_2026"), "project_id", "pin_no")


def _summary(pin: DataFrame, *keys: str) -> DataFrame:
    own = _ok(pin).select(*keys, F.lit(0).alias("row_no"), F.lit(None).cast("string").alias("scope"), "plan", "actual", F.col("n_concerns").alias("concerns"), F.col("n_activities").alias("activities"))
    scopes = F.array_sort(F.map_keys("scopes"))
    sub = pin.select(*keys, "scopes", F.posexplode(scopes).alias("k", "scope"))
    sub = sub.select(*keys, (F.col("k") + 1).alias("row_no"), "scope", F.element_at("scopes", F.col("scope"))["plan"].alias("plan"), F.element_at("scopes", F.col("scope"))["actual"].alias("actual"), F.lit(None).cast("int").alias("concerns"), F.lit(None).cast("int").alias("activities"))
    all_ = _ok(own.unionByName(sub))
    v = numeric.exact(F.col("actual")) - numeric.exact(F.col("plan"))
    return all_.withColumn("band", numeric.variance_band(v))


def concern_section(s, d):
    """The concern and activity sections: items of every snapshot that has any, by field and position."""
    field = lambda f, c: F.struct(F.lit(f).alias("field"), text.split_items(F.col(c)).alias("items"))
    w = _t(s, d, "w32_2026").select("snap_id", "project_id", F.explode(F.array(field("concerns", "first_concern"), field("activities", "first_activity"))).alias("x"))
    return w.select("snap_id", "project_id", "x.field", F.posexplode("x.items").alias("ord", "item"))


def run_summary(s, d):
    """Found, missing and not-due projects of week 32 by kind."""
    rows, proj, cad = _panel(s, d), _t(s, d, "dim_project"), _t(s, d, "dim_cadence")
    there = rows.where((F.col("year") == NOW[0]) & (F.col("week") == NOW[1])).select("project_id", F.lit(True).alias("found"))
    j = proj.select("project_id", "kind").join(there, "project_id", "left").join(history.due(rows, proj, cad, *NOW).select("project_id", "due"), "project_id", "left")
    f = F.coalesce("found", F.lit(False))
    return j.groupBy("kind").agg(F.count_if(f).alias("found"), F.count_if(~f & F.col("due")).alias("missing"), F.count_if(~f & ~F.col("due")).alias("not_due"))


def seed_round_trip(s, d):
    """Snapshots written as seed text and read back by bracket matching."""
    pages = sinks.seed_text(_t(s, d, "w32_2026")).select(F.col("snap_id").alias("doc_id"), "text")
    return seeds.seed_blocks(pages).select(F.col("doc_id").alias("snap_id"), "key", "plan", "actual", "n_disc", "n_scopes", "n_concerns", "n_activities")


def seed_first_wins(s, d):
    pages = sinks.seed_text(_t(s, d, "w32_2026")).select(F.col("snap_id").alias("doc_id"), "text")
    return seeds.history_of(pages).select("key", F.col("doc_id").alias("snap_id"), "n_scopes")


def seed_last_report(s, d):
    """Seed blocks read as a report: the last block of a key, scopes with their own figures."""
    pages = sinks.seed_text(_t(s, d, "w32_2026")).select(F.col("snap_id").alias("doc_id"), "text")
    weeks = _t(s, d, "w32_2026").select("year", "week")
    r = seeds.report_of(pages, weeks)
    return r.select("project_id", "year", "week", "plan", "actual", F.explode_outer(F.map_entries("scopes")).alias("e")).select("project_id", "year", "week", "plan", "actual", F.col("e.key").alias("scope"), F.col("e.value.plan").alias("scope_plan"), F.col("e.value.actual").alias("scope_actual"))


def report_round_trip(s, d):
    """Snapshots written as report documents, one a pin, and read back."""
    num = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    items = lambda c, n: F.split(F.col(c), "\n").alias(n)
    project = F.struct(F.col("project_id").alias("id"), num("plan"), num("actual"), items("first_concern", "concerns"), items("first_activity", "activities"))
    docs = _t(s, d, "w32_2026").groupBy("year", "week", "pin_no").agg(F.collect_list(project).alias("projects"))
    text = F.to_json(F.struct("year", "week", F.concat(F.lit("pin "), F.col("pin_no").cast("string")).alias("date"), "projects"))
    r = files.report_json(docs.select(text.alias("text")))
    return r.select("year", "week", "date", F.col("project.id").alias("project_id"), "project.plan", "project.actual", *(F.greatest(F.size(f"project.{c}"), F.lit(0)).alias(f"n_{c}") for c in ("concerns", "activities")))


def sheet_filled(s, d):
    """Every pin as a sheet whose empty figures are filled from the project's last pin."""
    w = _t(s, d, "w32_2026")
    last = w.groupBy("project_id").agg(F.max_by(F.struct("plan", "actual", "scopes"), "pin_no").alias("l")).select("project_id", "l.*")
    got = files.filled_from(w.select("snap_id", "project_id", "plan", "actual", "scopes"), last.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("plan", "actual")}))
    return got.select("snap_id", "project_id", "plan", "actual", F.size("scopes").alias("n_scopes"))


def missing_by_week(s, d):
    """Of every recorded week the projects whose row has no figure, as the map a page keeps."""
    rows = _panel(s, d).where("plan is null and actual is null")
    return sinks.weeks_to_lists(rows, "project_id").select(F.explode("weeks").alias("week", "projects")).select("week", F.array_join("projects", ",").alias("projects"))


def cover_dates(s, d):
    return _t(s, d, "orders").select("o_orderdate").distinct().select(F.col("o_orderdate").cast("date").cast("string").alias("day"), text.cover_date(F.col("o_orderdate")).alias("cover"))


def queries() -> dict:
    named = (
        seed_last_report, report_round_trip, sheet_filled, missing_by_week, cover_dates,
        history_upsert, history_first_wins, history_summary, history_of_project, prev_week, frozen_streak, report_due, missing_reports, week_keys, iso_tuesdays,
        findings_all, findings_counts, findings_by_project, findings_text, rule_scope_incomplete, rule_content_not_prose,
        discipline_rows, snapshot_discipline_rows, weighted_overall, summary_overlay, fixture_paths, fixture_diff,
        variance_bands, summary_rows, concern_section, run_summary, seed_round_trip, seed_first_wins,
    )
    return {f.__name__: f for f in named} | {f"rule_{n.replace('-', '_')}": rule(n) for n in PANEL_RULES}


def _panel_sql(last: bool = True) -> str:
    o = "desc" if last else "asc"
    return f"""select project_id, year, week, rec_id, case when isnan(plan) then null else plan end as plan, case when isnan(actual) then null else actual end as actual,
  n_disc, n_scopes, n_concerns, n_activities
from (select *, row_number() over (partition by project_id, year, week order by recorded_at {o} nulls last, rec_id {o} nulls last) as r
      from history where project_id is not null and year is not null and week is not null) where r = 1"""


_PREV = f"""
panel as ({_panel_sql()}),
runs0 as (select *, case when row_number() over w > 1 and actual is not distinct from lag(actual) over w then 0 else 1 end as new_ from panel window w as (partition by project_id order by year, week)),
runs1 as (select *, sum(new_) over (partition by project_id order by year, week) as run from runs0),
runs as (select *, case when actual is null then 0 else row_number() over (partition by project_id, run order by year, week) - 1 end as streak from runs1),
prev as (
  select *, lag(year) over w as prev_year, lag(week) over w as prev_week, lag(plan) over w as prev_plan, lag(actual) over w as prev_actual,
    lag(n_disc) over w as prev_n_disc, lag(n_scopes) over w as prev_n_scopes, coalesce(lag(streak) over w, 0) as prev_streak
  from runs window w as (partition by project_id order by year, week)
)"""
_FINDINGS = """@PREV@,
pins as (select * from (select *, row_number() over (partition by project_id, year, week order by pin_no desc, snap_id desc) as r from w32_2026) where r = 1),
junk as (select project_id, year, week, field, count(*) as n from (
    select project_id, year, week, 'concerns' as field, unnest(string_split(first_concern, chr(10))) as line from pins
    union all select project_id, year, week, 'activities', unnest(string_split(first_activity, chr(10))) from pins) where @JUNK@ group by all),
ruled as (
  select p.*, coalesce(jc.n, 0) as junk_c, coalesce(ja.n, 0) as junk_a, coalesce(e.min_disc, 0) as min_disc, coalesce(e.min_scopes, 0) as min_scopes, coalesce(e.needs_pct, false) as needs_pct
  from prev p left join (select project_id, min(kind) as kind from dim_project group by 1) d on p.project_id = d.project_id left join dim_expectation e on d.kind = e.kind
  left join junk jc on jc.field = 'concerns' and jc.project_id = p.project_id and jc.year = p.year and jc.week = p.week
  left join junk ja on ja.field = 'activities' and ja.project_id = p.project_id and ja.year = p.year and ja.week = p.week
),
found as (
  select project_id, year, week, 1 as rule_no, 'FAIL' as severity, 'missing-pct' as rule, 'plan' as subject from ruled where needs_pct and plan is null
  union all select project_id, year, week, 1, 'FAIL', 'missing-pct', 'actual' from ruled where needs_pct and actual is null
  union all select project_id, year, week, 2, 'FAIL', 'pct-out-of-range', 'plan' from ruled where needs_pct and not (plan between 0 and 100)
  union all select project_id, year, week, 2, 'FAIL', 'pct-out-of-range', 'actual' from ruled where needs_pct and not (actual between 0 and 100)
  union all select project_id, year, week, 3, 'FAIL', 'missing-disciplines', null from ruled where coalesce(n_disc, 0) < min_disc
  union all select project_id, year, week, 4, 'FAIL', 'missing-scopes', null from ruled where coalesce(n_scopes, 0) < min_scopes
  union all select project_id, year, week, 7, 'WARN', 'content-truncated', 'concerns' from ruled where n_concerns >= 20 and junk_c = 0
  union all select project_id, year, week, 7, 'WARN', 'content-truncated', 'activities' from ruled where n_activities >= 20 and junk_a = 0
  union all select project_id, year, week, 8, 'WARN', 'content-empty', null from ruled where coalesce(n_concerns, 0) = 0 and coalesce(n_activities, 0) = 0
  union all select project_id, year, week, 9, 'WARN', 'variance-large', null from ruled where plan between 0 and 100 and actual between 0 and 100 and round(abs(actual - plan), 6) > 25
  union all select project_id, year, week, 10, 'FAIL', 'value-vanished', 'plan' from ruled where plan is null and prev_plan is not null
  union all select project_id, year, week, 10, 'FAIL', 'value-vanished', 'actual' from ruled where actual is null and prev_actual is not null
  union all select project_id, year, week, 11, 'WARN', 'actual-went-backwards', null from ruled where actual between 0 and 100 and prev_actual between 0 and 100 and round(prev_actual - actual, 6) > 0.5
  union all select project_id, year, week, 12, 'WARN', 'structure-shrank', 'disciplines' from ruled where prev_year is not null and coalesce(n_disc, 0) < coalesce(prev_n_disc, 0)
  union all select project_id, year, week, 12, 'WARN', 'structure-shrank', 'scopes' from ruled where prev_year is not null and coalesce(n_scopes, 0) < coalesce(prev_n_scopes, 0)
  union all select project_id, year, week, 13, 'WARN', 'value-frozen', null from ruled where prev_streak + 1 >= 3 and actual between 0 and 100 and actual = prev_actual
  union all select p.project_id, p.year, p.week, 5, 'WARN', 'scope-incomplete', s.key from (select project_id, year, week, unnest(map_entries(scopes)) as s from pins) p
    join panel using (project_id, year, week) where coalesce(isnan(s.value.plan), true) or coalesce(isnan(s.value.actual), true)
  union all select project_id, year, week, 6, 'WARN', 'content-not-prose', field from junk join panel using (project_id, year, week)
)"""
_DUE = f"""
panel as ({_panel_sql()}),
last_ as (select project_id, max(year * 100 + week) as yw from panel where year * 100 + week < 202632 group by 1),
elapsed as (
  select p.project_id, coalesce(p.cadence, 'weekly') as cadence, cast(yw // 100 as int) as last_year, cast(yw % 100 as int) as last_week,
    cast((2026 - yw // 100) * 52 + 32 - yw % 100 as int) as elapsed
  from dim_project p left join last_ l on p.project_id = l.project_id
),
due as (select e.*, e.cadence = 'weekly' or elapsed is null or elapsed >= coalesce(grace_weeks, 1) as due from elapsed e left join dim_cadence c on e.cadence = c.cadence)"""
_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
# Fixed values, written out again for the SQL.
LABELS = r"(?i)\b(description|remark|status|root cause|doc no|issue date|plan|actual|total|accum|discipline|week|target|action by)\b"


def table_like(line: str) -> str:
    """SQL condition: the stripped line looks like table text."""
    toks = rf"list_filter(string_split_regex({line}, '[\s\p{{Z}}]+'), lambda t: t <> '')"
    nums = rf"len(list_filter({toks}, lambda t: regexp_matches(t, '^[\d.,%()+\-]+$')))"
    labels = f"len(regexp_extract_all({line}, '{LABELS}'))"
    return rf"""({line} = '' or regexp_matches({line}, '^\d+(?:\.\d+)+\s+\S') or regexp_matches({line}, '^\d+\s+[A-Z]{{3}}\s*\[')
  or regexp_matches({line}, '^[^\p{{L}}\p{{No}}\p{{Nl}}_]+$') or (len({toks}) >= 4 and {nums} >= 3 and {nums} * 2 >= len({toks}))
  or {labels} >= 3 or ({labels} >= 2 and len({toks}) <= 6))"""


_FINDINGS = _FINDINGS.replace("@PREV@", _PREV).replace("@JUNK@", table_like(_STRIP.format("line")))


_DISC = """case when lower(trim({0})) like 'eng%' then 'Engineering' when lower(trim({0})) like 'proc%' then 'Procurement'
  when lower(trim({0})) like 'const%' then 'Construction' when lower(trim({0})) like 'comm%' then 'Commissioning' else {0} end"""
_TIDY = f"""tidy as (
  select distinct project_id, year, week, scope, {_DISC.format("discipline")} as discipline, case when not isnan(plan) then plan end as plan,
    case when not isnan(actual) then actual end as actual, case when not isnan(wf) then wf end as wf from obs_discipline
)"""


def _weighted(keys: str, src: str) -> str:
    cents = "cast(round({0} * 100) as bigint)"
    w = "case discipline when 'Engineering' then 10 when 'Procurement' then 40 when 'Construction' then 40 else 10 end"
    one = lambda f: f"""case when sum(case when {f} between 0 and 100 then {w} end) > 0 then
    ((2 * sum(case when {f} between 0 and 100 then {cents.format(f)} * {w} end) + sum(case when {f} between 0 and 100 then {w} end))
     // (2 * sum(case when {f} between 0 and 100 then {w} end))) / 100.0 end as {f}"""  # noqa: E731
    return f"""select {keys}, {one("plan")}, {one("actual")}, count(distinct discipline) as n_disc
from {src} where discipline in ('Engineering', 'Procurement', 'Construction', 'Commissioning') group by {keys}"""


_CLEAN = "case when not isnan({0}) then {0} end"
_NUM = "cast(cast(case when not isnan({0}) then {0} end as decimal(9,2)) as varchar)"


def _paths(pins: str, keys: str = "project_id") -> str:
    k3 = lambda prefix, src, e: " union all ".join(
        f"select {keys}, {prefix} || 'disciplines.' || {e}.key || '.{k}' as path, {_NUM.format(f'{e}.value[{k + 1}]')} as value from ({src})" for k in range(3)
    )
    scal = " union all ".join(f"select {keys}, '{c}' as path, {_NUM.format(c)} as value from {pins}" for c in ("plan", "actual"))
    scal += "".join(f" union all select {keys}, '{c}', cast({c} as varchar) from {pins}" for c in ("n_concerns", "n_activities", "first_concern", "first_activity"))
    own = k3("''", f"select {keys}, unnest(map_entries(disciplines)) as e from {pins}", "e")
    sc = f"select {keys}, unnest(map_entries(scopes)) as s from {pins}"
    scp = " union all ".join(f"select {keys}, 'scopes.' || s.key || '.{f}' as path, {_NUM.format(f's.value.{f}')} as value from ({sc})" for f in ("plan", "actual"))
    nested = k3("'scopes.' || s.key || '.'", f"select {keys}, s, unnest(map_entries(s.value.disciplines)) as e from ({sc})", "e")
    return f"{scal} union all {own} union all {scp} union all {nested}"


def oracle_sql() -> dict[str, str]:
    d2 = "cast({0} as decimal(9,2))"
    inside = "case when {0} between 0 and 100 then {0} end"
    var = f"{d2.format(inside.format('actual'))} - {d2.format(inside.format('plan'))}"
    band = f"case when {var} < -5 then 'delayed' when {var} > 5 then 'ahead' when ({var}) is not null then 'neutral' end"
    out = {
        "history_upsert": _panel_sql(),
        "history_first_wins": _panel_sql(last=False),
        "history_summary": f"select count(*) as n_rows, count(distinct project_id) as n_projects, count(distinct year * 100 + week) as n_weeks, min(year * 100 + week) as first_week, max(year * 100 + week) as last_week from ({_panel_sql()})",
        "history_of_project": f"select project_id, year, week, plan, actual from ({_panel_sql()})",
        "prev_week": f"with {_PREV} select project_id, year, week, plan, actual, prev_year, prev_week, prev_plan, prev_actual, prev_n_disc, prev_n_scopes from prev",
        "frozen_streak": f"with {_PREV} select project_id, year, week, cast(prev_streak as int) as prev_streak from prev",
        "report_due": f"with {_DUE} select project_id, cadence, last_year, last_week, elapsed, due from due",
        "missing_reports": f"""with {_DUE} select p.project_id, coalesce(p.name, p.project_id) as name from dim_project p join due d on p.project_id = d.project_id
where d.due and p.project_id not in (select project_id from panel where year = 2026 and week = 32)""",
        "week_keys": f"select project_id || '_W' || week || '_' || year as key, year, week from ({_panel_sql()})",
        "iso_tuesdays": f"""select year, week, strftime(make_date(year, 1, 4) - cast(isodow(make_date(year, 1, 4)) - 1 as int) + cast((week - 1) * 7 + 1 as int), '%Y-%m-%d') as day
from (select distinct year, week from ({_panel_sql()}))""",
        "findings_all": f"with {_FINDINGS} select * from found",
        "findings_counts": f"with {_FINDINGS} select count(*) filter (severity = 'FAIL') as fails, count(*) filter (severity = 'WARN') as warns, count(distinct project_id) as projects_flagged from found",
        "findings_by_project": f"""with {_FINDINGS} select project_id, count(*) filter (severity = 'FAIL') as fails, count(*) filter (severity = 'WARN') as warns,
  arg_min(rule, (case severity when 'FAIL' then 0 else 1 end) * 100 + rule_no) as worst from found group by project_id""",
        "findings_text": f"""with {_FINDINGS} select project_id, year, week, string_agg(severity || ' ' || rule || coalesce(': ' || subject, ''), chr(10)
  order by case severity when 'FAIL' then 0 else 1 end, rule_no, severity || ' ' || rule || coalesce(': ' || subject, '')) as text
from found group by project_id, year, week""",
        "rule_scope_incomplete": f"""select snap_id, s.key as scope, 'plan=' || coalesce({_NUM.format("s.value.plan")}, 'None') || ', actual=' || coalesce({_NUM.format("s.value.actual")}, 'None') as detail
from (select snap_id, unnest(map_entries(scopes)) as s from w32_2026)
where ({_CLEAN.format("s.value.plan")}) is null or ({_CLEAN.format("s.value.actual")}) is null""",
        "rule_content_not_prose": f"""with items as (
  select snap_id, 'concerns' as field, string_split(first_concern, chr(10)) as ls from w32_2026 where first_concern is not null
  union all select snap_id, 'activities', string_split(first_activity, chr(10)) from w32_2026 where first_activity is not null
),
lines as (select snap_id, field, unnest(ls) as line, generate_subscripts(ls, 1) as n from items),
bare as (select *, {_STRIP.format("line")} as s from lines),
flagged as (select *, {table_like("s")} as junk from bare)
select snap_id, field, count(*) filter (junk) as n_junk, cast(count(*) as int) as n_items, left(arg_min(line, n) filter (junk), 120) as sample,
  case when count(*) >= 20 then 'the list is at its cap of 20' end as note
from flagged group by snap_id, field having count(*) filter (junk) > 0""",
        "discipline_rows": f"with {_TIDY} select * from tidy",
        "snapshot_discipline_rows": f"""with d as (
  select snap_id, project_id, cast(null as varchar) as scope, unnest(map_entries(disciplines)) as e from w32_2026
  union all select snap_id, project_id, s.key, unnest(map_entries(s.value.disciplines)) from (select snap_id, project_id, unnest(map_entries(scopes)) as s from w32_2026)
)
select snap_id, project_id, scope, e.key as discipline, {_CLEAN.format("e.value[1]")} as plan, {_CLEAN.format("e.value[2]")} as actual, {_CLEAN.format("e.value[3]")} as wf from d""",
        "weighted_overall": f"with {_TIDY} {_weighted('project_id, year, week, scope', 'tidy')}",
        "variance_bands": f"""select project_id, year, week, coalesce(cast({d2.format(inside.format("plan"))} as varchar), '–') as plan_text,
  coalesce(cast({d2.format(inside.format("actual"))} as varchar), '–') as actual_text,
  coalesce(case when {var} >= 0 then '+' else '' end || cast({var} as varchar), '–') as variance_text, {band} as band from ({_panel_sql()})""",
        "concern_section": f"""with f as (select snap_id, project_id, 'concerns' as field, first_concern as v from w32_2026 union all select snap_id, project_id, 'activities', first_activity from w32_2026),
c as (select snap_id, project_id, field, list_filter(list_transform(string_split_regex(v, '[\\n;]+'), lambda x: {_STRIP.format("x")}), lambda x: x <> '') as items
  from f where v is not null and lower({_STRIP.format("v")}) not in ('', '-', 'n/a', 'none'))
select snap_id, project_id, field, cast(generate_subscripts(items, 1) - 1 as int) as ord, unnest(items) as item from c""",
        "run_summary": f"""with {_DUE},
j as (select p.kind, p.project_id in (select project_id from panel where year = 2026 and week = 32) as found, d.due from dim_project p join due d on p.project_id = d.project_id)
select kind, count(*) filter (found) as found, count(*) filter (not found and due) as missing, count(*) filter (not found and not due) as not_due from j group by kind""",
        "seed_round_trip": f"""select snap_id, project_id || '_W' || week || '_' || year as key,
  case when plan >= 0 then cast({d2.format("plan")} as double) end as plan, case when actual >= 0 then cast({d2.format("actual")} as double) end as actual,
  cast(coalesce(cardinality(disciplines), 0) as int) as n_disc, cast(coalesce(cardinality(scopes), 0) as int) as n_scopes,
  cast(len(list_filter(string_split_regex(coalesce(first_concern, ''), '\\r?\\n'), lambda x: trim(x, ' ') <> '')) as int) as n_concerns,
  cast(len(list_filter(string_split_regex(coalesce(first_activity, ''), '\\r?\\n'), lambda x: trim(x, ' ') <> '')) as int) as n_activities from
  (select * replace ({_CLEAN.format("plan")} as plan, {_CLEAN.format("actual")} as actual) from w32_2026)""",
        "fixture_paths": _paths("w32_2026", "project_id, pin_no"),
        "fixture_diff": f"""with p as ({_paths("w32_2026", "project_id, pin_no")}),
steps as (select project_id, pin_no, lead(pin_no) over (partition by project_id order by pin_no) as next_pin from (select distinct project_id, pin_no from w32_2026)),
a as (select p.*, s.next_pin from p join steps s on p.project_id = s.project_id and p.pin_no = s.pin_no where s.next_pin is not null),
b as (select p.project_id, p.path, p.value, s.pin_no, s.next_pin from p join steps s on p.project_id = s.project_id and p.pin_no = s.next_pin)
select * from (
  select coalesce(a.project_id, b.project_id) as project_id, coalesce(a.pin_no, b.pin_no) as pin_no, coalesce(a.next_pin, b.next_pin) as next_pin,
    coalesce(a.path, b.path) as path, a.value as before, b.value as after,
    case when b.path is null then 'absent' when a.path is null then 'new' else 'changed' end as status
  from a full outer join b on a.project_id = b.project_id and a.pin_no = b.pin_no and a.path = b.path
) where status <> 'changed' or before is distinct from after""",
        "summary_rows": f"""with r as (
  select project_id, pin_no, 0 as row_no, cast(null as varchar) as scope, plan, actual, n_concerns as concerns, n_activities as activities from w32_2026
  union all
  select project_id, pin_no, cast(row_number() over (partition by project_id, pin_no order by s.key) as int), s.key, s.value.plan, s.value.actual, null, null
  from (select project_id, pin_no, unnest(map_entries(scopes)) as s from w32_2026)
)
select project_id, pin_no, row_no, scope, {inside.format("plan")} as plan, {inside.format("actual")} as actual, concerns, activities, {band} as band from r""",
        "summary_overlay": f"""with {_TIDY},
base as (select o.project_id, o.year, o.week, k.pin_no, o.scope, o.plan, o.actual
  from ({_weighted("project_id, year, week, scope", "(select * from tidy where scope is not null)")}) o
  left join (select distinct project_id, year, week, pin_no from w32_2026) k on o.project_id = k.project_id and o.year = k.year and o.week = k.week),
top as (select project_id, year, week, pin_no, s.key as scope, {inside.format("s.value.plan")} as plan, {inside.format("s.value.actual")} as actual
  from (select project_id, year, week, pin_no, unnest(map_entries(scopes)) as s from w32_2026))
select coalesce(t.project_id, b.project_id) as project_id, coalesce(t.year, b.year) as year, coalesce(t.week, b.week) as week,
  coalesce(t.pin_no, b.pin_no) as pin_no, coalesce(t.scope, b.scope) as scope,
  coalesce(t.plan, b.plan) as plan, coalesce(t.actual, b.actual) as actual,
  case when t.scope is not null and b.scope is not null then 'both' when t.scope is not null then 'top' else 'base' end as source
from base b full outer join top t on b.project_id = t.project_id and b.year = t.year and b.week = t.week and b.pin_no = t.pin_no and b.scope = t.scope""",
        "seed_last_report": f"""with w as (select * from (select *, row_number() over (partition by project_id, year, week order by snap_id desc) as r from w32_2026) where r = 1),
e as (select project_id, year, week, plan, actual, unnest(case when coalesce(cardinality(scopes), 0) = 0 then [null] else map_entries(scopes) end) as s from w)
select project_id, year, week, case when not isnan(plan) and plan >= 0 then cast({d2.format("plan")} as double) end as plan, case when not isnan(actual) and actual >= 0 then cast({d2.format("actual")} as double) end as actual, s.key as scope,
  case when not isnan(s.value.plan) and s.value.plan >= 0 then cast({d2.format("s.value.plan")} as double) end as scope_plan, case when not isnan(s.value.actual) and s.value.actual >= 0 then cast({d2.format("s.value.actual")} as double) end as scope_actual from e""",
        "report_round_trip": """select year, week, 'pin ' || pin_no as date, project_id, case when not isnan(plan) then plan end as plan, case when not isnan(actual) then actual end as actual,
  cast(coalesce(len(string_split(first_concern, chr(10))), 0) as int) as n_concerns, cast(coalesce(len(string_split(first_activity, chr(10))), 0) as int) as n_activities from w32_2026""",
        "sheet_filled": f"""with l as (select project_id, arg_max(struct_pack(p := plan, a := actual, s := scopes), pin_no) as l from w32_2026 group by 1)
select snap_id, w.project_id, coalesce({_CLEAN.format("plan")}, {_CLEAN.format("l.p")}) as plan, coalesce({_CLEAN.format("actual")}, {_CLEAN.format("l.a")}) as actual,
  cast(case when cardinality(scopes) > 0 then cardinality(scopes) else coalesce(cardinality(l.s), -1) end as int) as n_scopes from w32_2026 w left join l on w.project_id = l.project_id""",
        "missing_by_week": f"select week || '_' || year as week, string_agg(project_id, ',' order by project_id) as projects from ({_panel_sql()}) where plan is null and actual is null group by all",
        "cover_dates": "select distinct strftime(o_orderdate, '%Y-%m-%d') as day, strftime(o_orderdate, '%-d %B %Y') as cover from orders",
        "seed_first_wins": """select project_id || '_W' || week || '_' || year as key, min(snap_id) as snap_id, cast(arg_min(coalesce(cardinality(scopes), 0), snap_id) as int) as n_scopes
from w32_2026 group by 1""",
    }
    for name in PANEL_RULES:
        out[f"rule_{name.replace('-', '_')}"] = f"with {_FINDINGS} select project_id, year, week, subject from found where rule = '{name}'"
    return out
