"""Problem 2: irregular readings onto a regular grid.

Compact-kernel weighted local linear regression.  The kernel is Epanechnikov's, so weighted
sums around a grid time are polynomials in the moments of the readings inside its reach;
those are sums over one range frame and stay inside Spark's window operator.  Each grid row
carries its effective support, and a mark where it was not observed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportloom.operators.readings import WEEKS, counted_rows

UNITS = 1 << 16  # a time is its period times UNITS and the week inside it, so step_weeks is below UNITS
REACH = 3  # periods to either side within which readings count
MIN_SUPPORT = 1.5  # effective number of readings below which no value is filled in
FIELDS = ("plan", "actual")


def stepped(rows: DataFrame, cadences: DataFrame) -> DataFrame:
    """``rows`` with ``step``, the label weeks of a period.  A null or unknown cadence is weekly,
    as is one without a step of a week or more."""
    steps = cadences.where("cadence is not null").groupBy("cadence").agg(F.max("step_weeks").alias("step"))
    joined = rows.join(steps, "cadence", "left")
    ok = F.col("step").isNotNull() & F.col("step").between(1, UNITS - 1)
    return joined.withColumn("step", F.when(ok, F.col("step")).otherwise(1))


def _moments(field: str) -> dict[str, Column]:
    """Sums over the frame of x^k and x^k v of the field's readings, x in periods."""
    v, x = F.col(field), F.col("x")
    on = v.isNotNull()
    power = lambda k: F.lit(1.0) if k == 0 else F.pow(x, k) if k > 1 else x
    return {f"_{field}_m{k}": F.when(on, power(k)) for k in range(5)} | {f"_{field}_q{k}": v * power(k) for k in range(4)}


def _local_linear(field: str) -> tuple[Column, Column]:
    """(fitted value, effective number of readings) at grid time g = x of the row."""
    m = [F.coalesce(F.col(f"_{field}_m{k}"), F.lit(0.0)) for k in range(5)]
    q = [F.coalesce(F.col(f"_{field}_q{k}"), F.lit(0.0)) for k in range(4)]
    g = F.col("x")
    binom = ((1,), (1, 1), (1, 2, 1), (1, 3, 3, 1), (1, 4, 6, 4, 1))

    def about(s: list[Column], k: int) -> Column:
        """Moment k about g from the moments about zero."""
        out = F.lit(0.0)
        for j, c in enumerate(binom[k]):
            out = out + F.lit(float(c)) * s[j] * (F.pow(-g, k - j) if k - j else F.lit(1.0))
        return out

    h2 = float(REACH * REACH)
    d, e = [about(m, k) for k in range(5)], [about(q, k) for k in range(4)]
    s0, s1, s2 = d[0] - d[2] / h2, d[1] - d[3] / h2, d[2] - d[4] / h2
    t0, t1 = e[0] - e[2] / h2, e[1] - e[3] / h2
    ww = d[0] - 2 * d[2] / h2 + d[4] / (h2 * h2)
    det = s0 * s2 - s1 * s1
    fit = F.when(s0 < 1e-6, None).when(det > 1e-6, (s2 * t0 - s1 * t1) / det).otherwise(t0 / s0)
    support = F.when(s0 < 1e-6, 0.0).otherwise(s0 * s0 / F.greatest(ww, F.lit(1e-9)))
    return fit, support


def regular_grid(history: DataFrame, projects: DataFrame, expectations: DataFrame, cadences: DataFrame) -> DataFrame:
    """One row per project that counts and reporting period, from the period of its first
    current row to that of its last: (project_id, year, week, step_weeks, n_readings, missing,
    and of plan and actual <field>, <field>_support, <field>_status).

    year and week are the period's first label week; n_readings counts cells that are not
    missing; ``missing`` says that there is none.  The value is the local fit at the period's
    first week; the status is 'observed' where the period holds a reading of the field,
    'filled' where the fit has an effective support of MIN_SUPPORT readings, else 'missing'
    with a null value.  Readings outside 0 to 100 are not fitted to.  A project with one row
    has one period; an empty table gives an empty table.
    """
    rows = stepped(counted_rows(history, projects, expectations), cadences)
    by_time = Window.partitionBy("project_id").orderBy("t")
    rows = rows.withColumn("_first", F.min("t").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
    since = F.col("t") - F.col("_first")
    rows = rows.withColumn("_k", F.floor(since / F.col("step")).cast("int")).withColumn("_next", F.lead("_k").over(by_time))
    rows = rows.withColumn("u", F.col("_k").cast("bigint") * UNITS + since % F.col("step"))
    # the last row of a period brings in the grid times from its own period up to the next row's
    grid = F.when(F.col("_next").isNull(), F.array("_k")).when(F.col("_next") > F.col("_k"), F.sequence("_k", F.col("_next") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    fit_to = lambda f: F.when(F.col(f"{f}_known").between(0.0, 100.0), F.col(f"{f}_known"))
    count = lambda f: F.when(F.col(f"{f}_known").isNotNull(), 1).otherwise(0)
    reading = F.struct(F.col("u").alias("u"), F.lit(False).alias("grid"), *(fit_to(f).alias(f) for f in FIELDS), *(count(f).alias(f"n_{f}") for f in FIELDS))
    point = F.transform(
        grid,
        lambda k: F.struct((k.cast("bigint") * UNITS).alias("u"), F.lit(True).alias("grid"), *(F.lit(None).cast("double").alias(f) for f in FIELDS), *(F.lit(0).alias(f"n_{f}") for f in FIELDS)),
    )
    events = rows.select("project_id", "step", F.col("_first").alias("first"), F.explode(F.concat(F.array(reading), point)).alias("e")).select(
        "project_id", "step", "first", "e.*"
    )
    events = events.withColumn("x", F.expr(f"u div {UNITS} + (u % {UNITS}) / cast(step as double)"))
    by_unit = Window.partitionBy("project_id").orderBy("u")
    near, inside = by_unit.rangeBetween(-REACH * UNITS, REACH * UNITS), by_unit.rangeBetween(0, UNITS - 1)
    sums = {name: F.sum(c).over(near) for f in FIELDS for name, c in _moments(f).items()}
    sums |= {f"_n_{f}": F.sum(f"n_{f}").over(inside) for f in FIELDS}
    # the reach also brings in the range of the readings: a fit does not leave it
    sums |= {f"_{a}_{f}": getattr(F, a)(f).over(near) for f in FIELDS for a in ("min", "max")}
    at = events.withColumns(sums).where("grid")
    start = F.col("first") + F.expr(f"u div {UNITS}") * F.col("step")
    out = [
        "project_id",
        F.floor(start / WEEKS).cast("int").alias("year"),
        (start % WEEKS + 1).cast("int").alias("week"),
        F.col("step").cast("int").alias("step_weeks"),
        sum((F.col(f"_n_{f}") for f in FIELDS[1:]), F.col(f"_n_{FIELDS[0]}")).alias("n_readings"),
        sum((F.col(f"_n_{f}") for f in FIELDS[1:]), F.col(f"_n_{FIELDS[0]}")).alias("_n"),
    ]
    fits = {f: _local_linear(f) for f in FIELDS}
    at = at.select(*out, *(c for f in FIELDS for c in (F.greatest(F.col(f"_min_{f}"), F.least(F.col(f"_max_{f}"), fits[f][0])).alias(f"_{f}"), F.round(fits[f][1], 4).alias(f"{f}_support"), F.col(f"_n_{f}"))))
    cols = []
    for f in FIELDS:
        status = F.when(F.col(f"_n_{f}") > 0, "observed").when((F.col(f"{f}_support") >= MIN_SUPPORT) & F.col(f"_{f}").isNotNull(), "filled").otherwise("missing")
        value = F.when((F.col(f"{f}_support") >= MIN_SUPPORT) | (F.col(f"_n_{f}") > 0), F.round(F.col(f"_{f}"), 4))
        cols += [value.alias(f), F.col(f"{f}_support"), status.alias(f"{f}_status")]
    marked = at.select("project_id", "year", "week", "step_weeks", F.col("n_readings").cast("bigint").alias("n_readings"), *cols)
    observed = (F.col("plan_status") == "observed") | (F.col("actual_status") == "observed")
    return marked.withColumn("missing", ~observed)


def missing_periods(history: DataFrame, projects: DataFrame, expectations: DataFrame, cadences: DataFrame) -> DataFrame:
    """(project_id, year, week): the periods of the grid without any reading."""
    return regular_grid(history, projects, expectations, cadences).where("missing").select("project_id", "year", "week")
