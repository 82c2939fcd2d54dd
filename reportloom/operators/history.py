"""The project-by-week panel: upsert, previous week, frozen runs, what is due and what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MEASURES = ("plan", "actual", "n_disc", "n_scopes", "n_concerns", "n_activities")
KEY = ("project_id", "year", "week")


def _rank(last: bool) -> Window:
    order = (F.desc_nulls_last, F.asc_nulls_last)[not last]
    return Window.partitionBy(*KEY).orderBy(order("recorded_at"), order("rec_id"))


def panel(history: DataFrame, last: bool = True) -> DataFrame:
    """One row per project and week: the last (or first) recorded, by recorded_at and rec_id.  NaN
    percentages come out as null; rows without a key are left out."""
    r = history.where("project_id is not null and year is not null and week is not null")
    r = r.withColumn("_r", F.row_number().over(_rank(last))).where("_r = 1")
    no_nan = lambda c: F.when(~F.isnan(c), F.col(c))
    return r.withColumns({"plan": no_nan("plan"), "actual": no_nan("actual")}).select(*KEY, "rec_id", *MEASURES)


def upsert(history: DataFrame, batch: DataFrame) -> DataFrame:
    """History with a re-recorded batch laid over it; applying a batch twice changes nothing."""
    return panel(history.unionByName(batch))


def write_weeks(rows: DataFrame, path: str) -> None:
    """Replaces only the weeks that occur in ``rows``."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "week").parquet(path)


def with_previous(rows: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """``rows`` with prev_year, prev_week and prev_<measure> of the previous recorded week (gaps are
    passed over), and prev_streak: how many weeks before that one hold the same actual as it.

    The streak counts back from the row before the previous one; a null actual has none.
    """
    w = Window.partitionBy("project_id").orderBy("year", "week")
    run = rows.withColumn("_new", F.when(F.col("actual").eqNullSafe(F.lag("actual").over(w)), 0).otherwise(1))
    run = run.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    pos = F.row_number().over(Window.partitionBy("project_id", "_run").orderBy("year", "week")) - 1
    run = run.withColumn("_streak", F.when(F.col("actual").isNotNull(), pos).otherwise(0))
    lag = lambda c: F.lag(c).over(w)
    cols = {f"prev_{c}": lag(c) for c in ("year", "week", *measures)} | {"prev_streak": F.coalesce(lag("_streak"), F.lit(0))}
    return run.withColumns(cols).drop("_new", "_run", "_streak")


def weeks_since(rows: DataFrame, projects: DataFrame, year: int, week: int) -> DataFrame:
    """(project_id, cadence, last_year, last_week, elapsed): of every project its last recorded week
    before the given one; a year counts 52 weeks.  Nulls where nothing was recorded."""
    before = rows.where((F.col("year") * 100 + F.col("week")) < year * 100 + week)
    last = before.groupBy("project_id").agg(F.max(F.struct("year", "week")).alias("w")).select("project_id", F.col("w.year").alias("last_year"), F.col("w.week").alias("last_week"))
    elapsed = (F.lit(year) - F.col("last_year")) * 52 + F.lit(week) - F.col("last_week")
    return projects.select("project_id", F.coalesce("cadence", F.lit("weekly")).alias("cadence")).join(last, "project_id", "left").withColumn("elapsed", elapsed)


def due(rows: DataFrame, projects: DataFrame, cadences: DataFrame, year: int, week: int) -> DataFrame:
    """weeks_since with ``due``: weekly projects always, others once their grace has elapsed, and
    whoever never reported."""
    s = weeks_since(rows, projects, year, week).join(cadences.select("cadence", "grace_weeks"), "cadence", "left")
    is_due: Column = (F.col("cadence") == "weekly") | F.col("elapsed").isNull() | (F.col("elapsed") >= F.coalesce("grace_weeks", F.lit(1)))
    return s.select("project_id", "cadence", "last_year", "last_week", "elapsed", is_due.alias("due"))


def missing_reports(rows: DataFrame, projects: DataFrame, cadences: DataFrame, year: int, week: int) -> DataFrame:
    """(project_id, name): projects that are due in a week and have no row in it."""
    there = rows.where((F.col("year") == year) & (F.col("week") == week)).select("project_id")
    expected = due(rows, projects, cadences, year, week).where("due").select("project_id")
    return projects.join(expected, "project_id", "left_semi").join(there, "project_id", "left_anti").select("project_id", F.coalesce("name", "project_id").alias("name"))


def recorded_summary(rows: DataFrame) -> DataFrame:
    """(n_rows, n_projects, n_weeks, first_week, last_week), weeks as year*100+week."""
    w = F.col("year") * 100 + F.col("week")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("project_id").alias("n_projects"), F.countDistinct(w).alias("n_weeks"), F.min(w).alias("first_week"), F.max(w).alias("last_week"))
