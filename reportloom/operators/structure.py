"""Disciplines and scopes: tidy rows, roll-ups and the overlay of two readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportloom.functions.numeric import DISCIPLINES, weighted

#: Beginnings of the discipline names as reports spell them.
STEMS = {"eng": "Engineering", "proc": "Procurement", "const": "Construction", "comm": "Commissioning"}


def discipline(name: Column) -> Column:
    """The standard name of a discipline however spelt; unknown names in title case."""
    key = F.lower(F.trim(name))
    out = F.initcap(F.trim(name))
    for stem, full in STEMS.items():
        out = F.when(key.startswith(stem), full).otherwise(out)
    return out


def tidy(obs: DataFrame) -> DataFrame:
    """Observations with standard names and NaN as null, rows repeated in full once."""
    no_nan = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return obs.select("project_id", "year", "week", "scope", discipline(F.col("discipline")).alias("discipline"), *map(no_nan, ("plan", "actual", "wf"))).distinct()


def weighted_overall(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(…keys, plan, actual, n_disc): means by discipline weights over the disciplines present."""
    ok = lambda c: F.when(F.col(c).between(0.0, 100.0), F.col(c))
    return rows.where(F.col("discipline").isin(*DISCIPLINES)).groupBy(*keys).agg(
        weighted(ok("plan"), F.col("discipline")).alias("plan"), weighted(ok("actual"), F.col("discipline")).alias("actual"), F.countDistinct("discipline").alias("n_disc")
    )


def snapshot_scopes(snapshots: DataFrame) -> DataFrame:
    """(snap_id, project_id, scope, plan, actual) of the snapshots' scopes."""
    return snapshots.select("snap_id", "project_id", F.explode("scopes").alias("scope", "s")).select("snap_id", "project_id", "scope", "s.plan", "s.actual")


def snapshot_disciplines(snapshots: DataFrame) -> DataFrame:
    """(snap_id, project_id, scope, discipline, plan, actual, wf), scope null for the project's own."""
    own = snapshots.select("snap_id", "project_id", F.lit(None).cast("string").alias("scope"), F.explode("disciplines").alias("discipline", "v"))
    nested = snapshots.select("snap_id", "project_id", F.explode("scopes").alias("scope", "s")).select("snap_id", "project_id", "scope", F.explode("s.disciplines").alias("discipline", "v"))
    at = lambda k: F.get("v", F.lit(k))
    return own.unionByName(nested).select("snap_id", "project_id", "scope", "discipline", at(0).alias("plan"), at(1).alias("actual"), at(2).alias("wf"))


def overlay(base: DataFrame, top: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer overlay of (…keys, plan, actual): ``top`` wins cell by cell, and ``source`` says
    who had the row."""
    b = base.select(*keys, F.col("plan").alias("_bp"), F.col("actual").alias("_ba"), F.lit(True).alias("_b"))
    t = top.select(*keys, F.col("plan").alias("_tp"), F.col("actual").alias("_ta"), F.lit(True).alias("_t"))
    j = b.join(t, keys, "full_outer")
    source = F.when(F.col("_b") & F.col("_t"), "both").when(F.col("_t"), "top").otherwise("base")
    return j.select(*keys, F.coalesce("_tp", "_bp").alias("plan"), F.coalesce("_ta", "_ba").alias("actual"), source.alias("source"))


def paths(snapshots: DataFrame, keys: list[str]) -> DataFrame:
    """(…keys, path, value): everything a snapshot pins, as text by dotted path; NaN reads null."""
    num = lambda c: F.when(c.isNotNull() & ~F.isnan(c), c).cast("decimal(9,2)").cast("string")
    pair = lambda p, v: F.struct(p.alias("path"), v.alias("value"))
    entry = lambda prefix, m: F.flatten(
        F.transform(F.map_entries(F.coalesce(m, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<double>>")))),
            lambda e: F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda k: pair(F.concat(prefix, F.lit("disciplines."), e["key"], F.lit("."), k.cast("string")), num(F.get(e["value"], k)))))
    )
    scalar = [pair(F.lit(c), num(F.col(c))) for c in ("plan", "actual")]
    scalar += [pair(F.lit(c), F.col(c).cast("string")) for c in ("n_concerns", "n_activities", "first_concern", "first_activity")]
    own = F.concat(F.array(*scalar), entry(F.lit(""), F.col("disciplines")))
    per_scope = F.flatten(
        F.transform(F.map_entries("scopes"), lambda e: F.concat(
            F.array(pair(F.concat(F.lit("scopes."), e["key"], F.lit(".plan")), num(e["value"]["plan"])), pair(F.concat(F.lit("scopes."), e["key"], F.lit(".actual")), num(e["value"]["actual"]))),
            entry(F.concat(F.lit("scopes."), e["key"], F.lit(".")), e["value"]["disciplines"]),
        ))
    )
    all_ = F.concat(own, F.coalesce(per_scope, F.array().cast("array<struct<path:string,value:string>>")))
    return snapshots.select(*keys, F.explode(all_).alias("p")).select(*keys, "p.path", "p.value")


def diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """(…keys, path, before, after, status) where two sets of paths differ: changed, absent (only
    in old) or new."""
    a = old.select(*keys, "path", F.col("value").alias("before"), F.lit(True).alias("_a"))
    b = new.select(*keys, "path", F.col("value").alias("after"), F.lit(True).alias("_b"))
    j = a.join(b, [*keys, "path"], "full_outer")
    status = F.when(F.col("_b").isNull(), "absent").when(F.col("_a").isNull(), "new").otherwise("changed")
    return j.withColumn("status", status).where("status <> 'changed' or not (before <=> after)").select(*keys, "path", "before", "after", "status")


def diff_successive(snapshots: DataFrame, key: str, order: str) -> DataFrame:
    """(key, order, next_pin, path, before, after, status): every snapshot of a key against its next
    one by ``order``, so that a change which is later reverted shows up twice."""
    w = Window.partitionBy(key).orderBy(order)
    s = snapshots.withColumns({"_prev": F.lag(order).over(w), "_next": F.lead(order).over(w)})
    old = s.where("_next is not null").withColumn("next_pin", F.col("_next"))
    new = s.where("_prev is not null").withColumn("next_pin", F.col(order)).withColumn(order, F.col("_prev"))
    keys = [key, order, "next_pin"]
    return diff(paths(old, keys), paths(new, keys), keys)
