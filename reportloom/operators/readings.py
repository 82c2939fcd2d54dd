"""Current rows of the history log and which of their percentages are missing.

Shared by the filling, the regular grid and the spike operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEEKS = 52  # label weeks in every year


def label_week(year: Column, week: Column) -> Column:
    """Label weeks counted from week 1 of year 0."""
    return (year * WEEKS + week - 1).cast("int")


def current_rows(history: DataFrame) -> DataFrame:
    """(project_id, t, rec_id, plan, actual): of each project and week the row with the greatest
    recorded_at, of these the greatest rec_id; nulls come last.

    Rows without project, year or week belong to no period and are left out.  The rank limit
    is applied in the map tasks first, so a week recorded very often does not travel whole.
    """
    rows = history.where("project_id is not null and year is not null and week is not null").select(
        "project_id", label_week(F.col("year"), F.col("week")).alias("t"), "rec_id", "plan", "actual", "recorded_at"
    )
    newest = Window.partitionBy("project_id", "t").orderBy(F.desc_nulls_last("recorded_at"), F.desc_nulls_last("rec_id"))
    return rows.withColumn("_r", F.row_number().over(newest)).where("_r = 1").drop("_r", "recorded_at")


def counted_projects(projects: DataFrame, expectations: DataFrame) -> DataFrame:
    """(project_id, kind, cadence), one row per project whose kind needs percentages."""
    kinds = expectations.where("needs_pct").select("kind").distinct()
    own = projects.where("project_id is not null").groupBy("project_id").agg(F.min("kind").alias("kind"), F.min("cadence").alias("cadence"))
    return own.join(kinds, "kind", "left_semi").select("project_id", "kind", "cadence")


def _outside(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & ~v.between(0.0, 100.0)


def known_values(rows: DataFrame) -> DataFrame:
    """``rows`` with ``plan_known`` and ``actual_known``: the value, or null where it is missing.

    Missing is null, not a number, or a stand-in: a value outside 0 to 100 that the project
    holds, in either field, in at least two weeks.
    """
    project = Window.partitionBy("project_id")
    mine = F.array_distinct(F.filter(F.array("plan", "actual"), _outside))
    rows = rows.withColumn("_odd", F.flatten(F.collect_list(F.when(F.size(mine) > 0, mine)).over(project)))

    def known(field: str) -> Column:
        v = F.col(field)
        stand_in = F.size(F.filter("_odd", lambda x: x == v)) >= 2
        return F.when(v.isNull() | F.isnan(v), None).when(v.between(0.0, 100.0), v).when(~stand_in, v)

    return rows.withColumns({"plan_known": known("plan"), "actual_known": known("actual")}).drop("_odd")


def counted_rows(history: DataFrame, projects: DataFrame, expectations: DataFrame) -> DataFrame:
    """(project_id, kind, cadence, t, rec_id, plan, actual, plan_known, actual_known) of the
    current rows of projects that count, partitioned by project."""
    return known_values(current_rows(history).join(counted_projects(projects, expectations), "project_id"))
