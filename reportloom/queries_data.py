"""Queries of the general training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.operators import impute, profile, regular, spikes


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> tuple[DataFrame, ...]:
    return tuple(spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names)


COUNTED = ("history", "dim_project", "dim_expectation")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute.filled_cells(*_tables(spark, sf_dir, *COUNTED)).select("rec_id", "field")


def p1_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All current rows, complete, with marks and the posterior of each fill."""
    return impute.fill_missing(*_tables(spark, sf_dir, *COUNTED))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regular.missing_periods(*_tables(spark, sf_dir, *COUNTED, "dim_cadence"))


def p2_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regular.regular_grid(*_tables(spark, sf_dir, *COUNTED, "dim_cadence"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spikes.implausible(*_tables(spark, sf_dir, *COUNTED))


def p4_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading, judged; distances on six decimals."""
    return spikes.judged_readings(*_tables(spark, sf_dir, *COUNTED)).withColumns({c: F.round(c, 6) for c in ("deviation", "residual", "cutoff", "usual_step")})


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.departing_columns(*_tables(spark, sf_dir, "history"))


def p5_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every load and count column with its metrics, their distances in standard deviations, and the verdict."""
    return profile.load_metrics(profile.count_states(*_tables(spark, sf_dir, "history")))


def p5_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.count_states(*_tables(spark, sf_dir, "history"))


def p5_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of every column of history, merged from the states of its feeds."""
    (history,) = _tables(spark, sf_dir, "history")
    checks = (
        profile.not_null("project_id"),
        profile.matches("project_id", r"^PRJ-\d{7}$"),
        profile.between("week", 1, 52),
        profile.between("plan", 0, 100),
        profile.between("actual", 0, 100),
        *profile.count_checks(),
    )
    states = profile.column_states(history, columns=history.columns, by=("feed",), checks=checks)
    return profile.profile(states)


def queries() -> dict:
    fs = (p1_found, p1_filled, p2_found, p2_grid, p4_found, p4_readings, p5_found, p5_loads, p5_states, p5_profile)
    return {f.__name__: f for f in fs}


_CURRENT = """
counted as (
  select p.project_id, coalesce(c.step_weeks, 1) as step
  from dim_project p
  join (select distinct kind from dim_expectation where needs_pct) k on p.kind = k.kind
  left join dim_cadence c on c.cadence = p.cadence
),
current as (
  select project_id, year * 52 + week - 1 as t, rec_id, plan, actual, step from (
    select h.*, c.step, row_number() over (partition by h.project_id, year, week order by recorded_at desc nulls last, rec_id desc) as r
    from history h join counted c on h.project_id = c.project_id
  ) where r = 1
),
cells as (
  select project_id, t, rec_id, 'plan' as field, plan as v from current
  union all select project_id, t, rec_id, 'actual', actual from current
),
odd as (
  select project_id, v from cells where v is not null and not isnan(v) and not (v between 0 and 100)
  group by project_id, v having count(distinct t) >= 2
),
judged as (
  select c.*, (c.v is null or isnan(c.v) or o.v is not null) as missing
  from cells c left join odd o on c.project_id = o.project_id and c.v = o.v
)"""


_SPIKES = """
readings as (
  select project_id, field, t, rec_id, v, row_number() over w as r,
    v = lag(v) over w as same
  from judged where not missing window w as (partition by project_id, field order by t)
),
runs as (select *, r - sum(case when same then 1 else 0 end) over (partition by project_id, field order by t) as run from readings),
stuck as (
  select rec_id, field from (
    select *, count(*) over (partition by project_id, field, run) as n, row_number() over (partition by project_id, field, run order by t) as pos from runs
  ) where n >= 4 and pos > 1 and v > 0 and v < 100
),
inner_ as (
  select project_id, field, abs(v - lag(v) over (partition by project_id, field order by t)) as step from readings where v > 0 and v < 100
),
bound as (
  select project_id, field, greatest(3.0, 8 * median(step)) as b from inner_ group by project_id, field having count(*) >= 8
),
near as (
  select r.project_id, r.field, r.rec_id, r.t, r.v as x, b.b, lag(v) over w as p1, lag(v, 2) over w as p2, lead(v) over w as n1, lead(v, 2) over w as n2
  from readings r join bound b on r.project_id = b.project_id and r.field = b.field
  where v between 0 and 100 window w as (partition by r.project_id, r.field order by r.t)
),
spike as (
  select rec_id, field from near where
    (p1 is not null and n1 is not null and round(greatest(x - greatest(p1, n1), least(p1, n1) - x) - b, 7) >= 0)
    or (p1 is not null and n2 is not null and round(greatest(least(x, n1) - greatest(p1, n2), least(p1, n2) - greatest(x, n1)) - b, 7) >= 0)
    or (p2 is not null and n1 is not null and round(greatest(least(x, p1) - greatest(p2, n1), least(p2, n1) - greatest(x, p1)) - b, 7) >= 0)
)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"with {_CURRENT} select rec_id, field from judged where missing",
        "p2_found": f"""with {_CURRENT},
spans as (select project_id, min(step) as step, min(t) as t0, max(t) as t1 from current group by project_id),
grid as (select project_id, step, t0, unnest(range(0, (t1 - t0) // step + 1)) as k from spans),
full_ as (
  select distinct j.project_id, (j.t - s.t0) // s.step as k from judged j join spans s on j.project_id = s.project_id where not j.missing
)
select g.project_id, cast((t0 + g.k * step) // 52 as int) as year, cast((t0 + g.k * step) % 52 + 1 as int) as week
from grid g left join full_ f on g.project_id = f.project_id and g.k = f.k where f.k is null""",
        "p4_found": f"""with {_CURRENT},{_SPIKES}
select rec_id, field from readings where not (v between 0 and 100)
union select rec_id, field from stuck union select rec_id, field from spike""",
        "p4_readings": f"""with {_CURRENT},{_SPIKES},
inside as (
  select project_id, field, rec_id, t, v as x, lag(v) over w as p1, lag(v, 2) over w as p2, lead(v) over w as n1, lead(v, 2) over w as n2
  from readings where v between 0 and 100 window w as (partition by project_id, field order by t)
),
mid as (select *, coalesce(x - (p1 + n1) / 2, 0.0) as d1, coalesce(x - (p1 + n2) / 2, 0.0) as d2, coalesce(x - (p2 + n1) / 2, 0.0) as d3 from inside),
far0 as (select *, case when abs(d2) > abs(d1) then d2 else d1 end as d from mid),
far as (select *, case when abs(d3) > abs(d) then d3 else d end as deviation, cast(floor((t % 52) * 4 / 52.0) as int) as season from far0),
usual as (select *, case when count(*) over s >= 8 then median(deviation) over s else 0.0 end as usual from far window s as (partition by project_id, field, season)),
steps as (select project_id, field, median(step) as usual_step, count(*) as n_inner from inner_ group by 1, 2),
res as (
  select u.*, abs(deviation - usual) as residual, usual_step, case when coalesce(n_inner, 0) >= 8 then greatest(3.0, 8 * coalesce(usual_step, 0.0)) end as bound
  from usual u left join steps s on u.project_id = s.project_id and u.field = s.field
),
high as (select *, quantile_cont(residual, 0.8) over o as u, count(*) over o as n_all from res window o as (partition by project_id, field)),
exc as (select *, case when round(residual - u, 9) > 0 then greatest(least(residual, bound / 2) - u, 0.0) end as e from high),
fit as (select *, avg(e) over o as m, var_pop(e) over o as s2, count(e) over o as nu from exc window o as (partition by project_id, field)),
shaped as (select *, 0.5 * (1 - m * m / s2) as shape, 0.5 * m * (m * m / s2 + 1) as scale, {spikes.RISK} * n_all / nu as odds from fit),
cut as (
  select *, case when bound is not null then greatest(u, case when nu = 0 or s2 <= 1e-12 then u + coalesce(m, 0.0)
    when abs(shape) < 1e-6 then u - scale * ln(odds) else u + scale / shape * (pow(odds, -shape) - 1) end) end as cutoff from shaped
),
named as (select *, coalesce(round(residual - cutoff, 6) > 0, false) as extreme, coalesce(round(residual - (bound - abs(usual)), 6) >= 0, false) as safe from cut)
select r.project_id, r.field, cast(r.t // 52 as int) as year, cast(r.t % 52 + 1 as int) as week, r.rec_id, r.v as value, round(n.deviation, 6) as deviation, round(n.residual, 6) as residual, round(q.cutoff, 6) as cutoff,
  round(s.usual_step, 6) as usual_step, not (r.v between 0 and 100) as outside, k.rec_id is not null as stuck, coalesce(n.extreme, false) as extreme, coalesce(n.extreme or n.safe, false) as candidate, p.rec_id is not null as spike
from readings r left join named n on r.rec_id = n.rec_id and r.field = n.field and r.project_id = n.project_id and r.t = n.t left join (select project_id, field, max(cutoff) as cutoff from named group by 1, 2) q on r.project_id = q.project_id and r.field = q.field left join steps s on r.project_id = s.project_id and r.field = s.field
left join (select distinct rec_id, field from stuck) k on r.rec_id = k.rec_id and r.field = k.field left join (select distinct rec_id, field from spike) p on r.rec_id = p.rec_id and r.field = p.field""",
        "p5_states": " union all ".join(
            f"""select feed, load_id, '{c}' as column_name,
  case when {c} is null then -1 when {c} between 0 and 20 then {c} else -2 end as value, count(*) as n
from history where load_id is not null group by all"""
            for c in profile.COUNTS
        ),
    }
