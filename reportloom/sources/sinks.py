"""What a run writes: seed text, sheets, findings, weeks, dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.functions.numeric import shortest
from reportloom.functions.text import escaped


def quoted_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(items, lambda x: F.concat(F.lit("'"), escaped(x), F.lit("'"))), ", "), F.lit("]"))


def _no_nan(v: Column) -> Column:
    return F.when(~F.isnan(v), v)


def discipline_block(m: Column) -> Column:
    """'{ 'name': { plan: …, actual: …[, wf: …] }, … }' of a map name -> [plan, actual, weight?], by name."""
    at = lambda v, k: _no_nan(F.get(v, F.lit(k)))

    def one(e: Column) -> Column:
        v = e["value"]
        wf = F.when(at(v, 2).isNotNull(), F.concat(F.lit(", wf: "), shortest(at(v, 2)))).otherwise("")
        return F.concat(F.lit("'"), escaped(e["key"]), F.lit("': { plan: "), shortest(at(v, 0)), F.lit(", actual: "), shortest(at(v, 1)), wf, F.lit(" }"))

    return F.concat(F.lit("{ "), F.array_join(F.transform(F.array_sort(F.map_entries(m)), one), ", "), F.lit(" }"))


def scope_block(m: Column) -> Column:
    """The same of a map scope -> (plan, actual, disciplines); a scope's disciplines are nested."""

    def one(e: Column) -> Column:
        v = e["value"]
        nested = F.when(F.size(v["disciplines"]) > 0, F.concat(F.lit(", disciplines: "), discipline_block(v["disciplines"]))).otherwise("")
        return F.concat(F.lit("'"), escaped(e["key"]), F.lit("': { plan: "), shortest(_no_nan(v["plan"])), F.lit(", actual: "), shortest(_no_nan(v["actual"])), nested, F.lit(" }"))

    keys = F.array_sort(F.map_keys(m))
    entries = F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(m, k).alias("value")))
    return F.concat(F.lit("{ "), F.array_join(F.transform(entries, one), ", "), F.lit(" }"))


def seed_text(snapshots: DataFrame) -> DataFrame:
    """(snap_id, key, text): the seed block of each snapshot; scopes and disciplines only where there
    are any, concerns and activities as lists of their lines."""
    items = lambda c: F.filter(F.split(F.coalesce(F.col(c), F.lit("")), r"\r?\n"), lambda x: F.trim(x) != "")
    key = F.concat("project_id", F.lit("_W"), F.col("week").cast("string"), F.lit("_"), F.col("year").cast("string"))
    part = lambda name, m, block: F.when(F.size(m) > 0, F.concat(F.lit(f"  {name}: "), block, F.lit(",\n"))).otherwise("")
    text = F.concat(
        F.lit("seed('"), key, F.lit("', {\n  plan: "), shortest(_no_nan(F.col("plan"))), F.lit(", actual: "), shortest(_no_nan(F.col("actual"))), F.lit(",\n"),
        part("scopes", F.col("scopes"), scope_block(F.col("scopes"))),
        part("disciplines", F.col("disciplines"), discipline_block(F.col("disciplines"))),
        F.lit("  concerns: "), quoted_list(items("first_concern")), F.lit(",\n  activities: "), quoted_list(items("first_activity")), F.lit(",\n});\n"),
    )
    return snapshots.select("snap_id", key.alias("key"), text.alias("text"))


def sheet_rows(results: DataFrame) -> DataFrame:
    """Rows of the weekly sheet: (project_id, found YES/NO, plan, actual, concerns, activities), items
    one to a line, by project."""
    lines = lambda c: F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), "\n")
    return results.select("project_id", F.when(F.col("found"), "YES").otherwise("NO").alias("found"), "plan", "actual", lines("concerns").alias("concerns"), lines("activities").alias("activities")).orderBy("project_id")


def write_sheet(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", "true").option("quoteAll", "true").csv(path)


def dump(results: DataFrame, path: str) -> None:
    """Results as JSON lines, nulls written out."""
    results.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def merged_fixture(old: DataFrame, new: DataFrame) -> DataFrame:
    """A fixture with some projects recorded anew."""
    return old.join(new, "project_id", "left_anti").unionByName(new)


def weeks_to_lists(rows: DataFrame, item: str) -> DataFrame:
    """(weeks): one map of '<week>_<year>' to the ordered, distinct items of that week's rows."""
    one = rows.groupBy(F.concat_ws("_", "week", "year").alias("key")).agg(F.array_sort(F.collect_set(item)).alias("items"))
    return one.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "items")))).alias("weeks"))


def merged_weeks(old: Column, new: Column) -> Column:
    """Two maps of weeks, the new one's entries in place of the old one's."""
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    return F.map_from_entries(F.array_sort(F.concat(F.map_entries(kept), F.map_entries(new))))


def stamped(df: DataFrame) -> DataFrame:
    """``df`` with ``version``, the time it was published."""
    return df.withColumn("version", F.date_format(F.current_timestamp(), "yyyyMMddHHmmss"))
