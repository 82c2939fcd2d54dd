"""Problem 5: column profiles from mergeable states, and loads in which a column departs.

Declared checks are compiled into one aggregate over one scan.  Per load and column the state
is a small histogram; states of further loads merge by adding up.  Metrics of a load (null
share, share that fails its check, level, spread, mix of values) are tested against control
limits: the value usual in the feed's other loads, and a number of standard deviations whose
size is learned from how loads have differed so far.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.session import kept

COUNTS = ("n_disc", "n_scopes", "n_concerns", "n_activities")
LOWEST, HIGHEST = 0, 20  # possible counts
NULL, IMPOSSIBLE = -1, -2  # codes in a histogram
MIN_ROWS = 150  # smaller loads are not judged
SIGMAS = 5.5  # a metric departs beyond so many standard deviations: four in a hundred million normal ones would
METRICS = ("nulls", "impossible", "level", "spread", "mix")
LEAST_SPREAD = 0.1  # standard deviations of counts below this read as this


@dataclass(frozen=True)
class Check:
    """A named condition every value of a column should meet; null meets every check but not_null."""

    column: str
    name: str
    holds: Column


def not_null(column: str) -> Check:
    return Check(column, "not_null", F.col(column).isNotNull())


def between(column: str, low: float, high: float) -> Check:
    return Check(column, f"between_{low}_{high}", F.col(column).between(low, high))


def matches(column: str, pattern: str) -> Check:
    return Check(column, "pattern", F.col(column).cast("string").rlike(pattern))


_BOUND = {"whole": "bigint", "number": "double", "time": "timestamp_ntz", "text": "string"}


def _bound(kind: str, v: Column) -> Column:
    """A lowest or highest value as a struct in which the field of its kind is set, so that it compares
    as that kind when states merge; null without a value."""
    return F.when(v.isNotNull(), F.struct(*((v if k == kind else F.lit(None)).cast(t).alias(k) for k, t in _BOUND.items())))


def column_states(df: DataFrame, columns: list[str] | None = None, by: tuple[str, ...] = (), checks: tuple[Check, ...] = ()) -> DataFrame:
    """One row per group of ``by`` and column: (…by, column_name, rows, nulls, total, squares, low,
    high, sketch, violations).  All of it from one aggregate over one scan; every measure merges.

    ``sketch`` is a HyperLogLog sketch of the distinct values; ``violations`` maps the names of
    the column's checks to how many values fail.  ``low``/``high`` are structs of whole, number,
    time and text, of which the one of the column's type is set; numbers also have total and
    squares.  NaN counts as a value of its own and is left out of the sums and bounds.  A column
    of ``by`` may be profiled too, by naming it in ``columns``.
    """
    columns = columns or [c for c in df.columns if c not in by]
    kinds = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for k, c in enumerate(columns):
        kind = kinds[c].split("(")[0]
        whole = kind in ("tinyint", "smallint", "int", "bigint")
        number = whole or kind in ("float", "double", "decimal")
        field = "whole" if whole else "number" if number else "time" if kind in ("date", "timestamp", "timestamp_ntz") else "text"
        v = F.col(f"`{c}`")
        x = F.when(~F.isnan(v.cast("double")), v.cast("double")) if number else F.lit(None).cast("double")
        aggs += [
            F.count(v).alias(f"_{k}_n"),
            F.sum(x).alias(f"_{k}_s"),
            F.sum(x * x).alias(f"_{k}_q"),
            _bound(field, F.min(x if field == "number" else v)).alias(f"_{k}_lo"),
            _bound(field, F.max(x if field == "number" else v)).alias(f"_{k}_hi"),
            F.hll_sketch_agg(v.cast("string")).alias(f"_{k}_h"),
        ]
        aggs += [F.count_if(~F.coalesce(q.holds, F.lit(q.name != "not_null"))).alias(f"_{k}_c{i}") for i, q in enumerate(checks) if q.column == c]
    one = df.groupBy(*by).agg(*aggs)
    each = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").alias("rows"),
            (F.col("_rows") - F.col(f"_{k}_n")).alias("nulls"),
            F.col(f"_{k}_s").alias("total"),
            F.col(f"_{k}_q").alias("squares"),
            F.col(f"_{k}_lo").alias("low"),
            F.col(f"_{k}_hi").alias("high"),
            F.col(f"_{k}_h").alias("sketch"),
            (F.create_map(*(x for i, q in enumerate(checks) if q.column == c for x in (F.lit(q.name), F.col(f"_{k}_c{i}")))) if any(q.column == c for q in checks) else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))).alias("violations"),
        )
        for k, c in enumerate(columns)
    ]
    return one.select(*by, F.explode(F.array(*each)).alias("s")).select(*by, "s.*")


def profile(states: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """States of any number of loads, merged and read: (…by, column_name, rows, nulls, null_share,
    distinct_estimate, mean, stddev, low, high, violations).  low and high are written as text
    after they were compared as what they are; violations maps each check to how many values
    fail.  Columns without a value have nulls there."""
    # each state gives a row of measures (check null) and a row per check, so checks add up by name in the same pass
    entry = lambda name, n: F.struct(name.cast("string").alias("check"), n.cast("bigint").alias("n"))
    entries = F.concat(F.array(entry(F.lit(None), F.lit(None))), F.transform(F.map_entries("violations"), lambda e: entry(e["key"], e["value"])))
    long = states.withColumn("_e", F.explode(entries))
    own = lambda c: F.when(F.col("_e.check").isNull(), F.col(c))
    added = long.groupBy(*by, "column_name", F.col("_e.check").alias("_check")).agg(
        *(F.sum(own(c)).alias(c) for c in ("rows", "nulls", "total", "squares")),
        F.min(own("low")).alias("low"),
        F.max(own("high")).alias("high"),
        F.hll_union_agg(own("sketch")).alias("sketch"),
        F.sum("_e.n").alias("_n"),
    )
    merged = added.groupBy(*by, "column_name").agg(
        *(F.max(c).alias(c) for c in ("rows", "nulls", "total", "squares", "low", "high")),  # set in one row only
        F.hll_union_agg("sketch").alias("sketch"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("_check").isNotNull(), F.struct("_check", "_n"))))).alias("violations"),
    )
    shown = lambda c: F.coalesce(*(F.col(f"{c}.{k}").cast("string") for k in _BOUND)).alias(c)
    n = F.col("rows") - F.col("nulls")
    mean = F.when(n > 0, F.col("total") / n)
    return merged.select(
        *by, "column_name", "rows", "nulls",
        (F.col("nulls") / F.greatest(F.col("rows"), F.lit(1))).alias("null_share"),
        F.hll_sketch_estimate("sketch").alias("distinct_estimate"),
        mean.alias("mean"),
        F.sqrt(F.greatest(F.col("squares") / n - mean * mean, F.lit(0.0))).alias("stddev"),
        shown("low"), shown("high"),
        "violations",
    )


def count_checks() -> tuple[Check, ...]:
    """What every count of history must meet; shared by the profile and the judgement of loads."""
    return tuple(between(c, LOWEST, HIGHEST) for c in COUNTS)


def count_states(history: DataFrame, checks: tuple[Check, ...] | None = None) -> DataFrame:
    """(feed, load_id, column_name, value, n): the histograms of the checked columns by load; value is
    the count, NULL, or IMPOSSIBLE where the column's check fails.  At most 23 rows per load and
    column leave a task."""
    code = lambda q: F.when(F.col(q.column).isNull(), NULL).when(F.coalesce(q.holds, F.lit(False)), F.col(q.column)).otherwise(IMPOSSIBLE)
    cell = lambda q: F.struct(F.lit(q.column).alias("column_name"), code(q).cast("int").alias("value"))
    long = history.where("load_id is not null").select("feed", "load_id", F.explode(F.array(*map(cell, checks or count_checks()))).alias("c"))
    return long.groupBy("feed", "load_id", "c.column_name", "c.value").agg(F.count(F.lit(1)).alias("n"))


def merge_states(*states: DataFrame) -> DataFrame:
    """Histograms of several deliveries added up."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return out.groupBy("feed", "load_id", "column_name", "value").agg(F.sum("n").alias("n"))


def _per_load(states: DataFrame) -> DataFrame:
    """(feed, load_id, column_name, rows, nulls, impossible, level, spread, hist): one row per load and
    column.  level is the mean count, spread the logarithm of its standard deviation."""
    n = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    v = F.col("value")
    per = states.groupBy("feed", "load_id", "column_name").agg(
        F.sum("n").alias("rows"), n(v == NULL).alias("_null"), n(v == IMPOSSIBLE).alias("_bad"), n(v >= LOWEST).alias("_ok"), F.sum(F.when(v >= LOWEST, v * F.col("n"))).alias("_s"), F.sum(F.when(v >= LOWEST, v * v * F.col("n"))).alias("_q"),
        F.map_from_entries(F.collect_list(F.struct("value", "n"))).alias("_h"),  # at most 23 entries
    )
    mean = F.when(F.col("_ok") > 0, F.col("_s") / F.col("_ok"))
    sd = F.sqrt(F.greatest(F.col("_q") / F.col("_ok") - mean * mean, F.lit(0.0)))
    hist = F.transform(F.sequence(F.lit(LOWEST), F.lit(HIGHEST)), lambda k: F.coalesce(F.try_element_at("_h", k), F.lit(0)).cast("double"))
    return per.select(
        "feed", "load_id", "column_name", "rows", (F.col("_null") / F.col("rows")).alias("nulls"), (F.col("_bad") / F.col("rows")).alias("impossible"),
        mean.alias("level"), F.when(F.col("_ok") > 0, F.log(F.greatest(sd, F.lit(LEAST_SPREAD)))).alias("spread"), hist.alias("hist"),
    )


def _middle(x: np.ndarray) -> float:
    x = x[~np.isnan(x)]
    return float(np.median(x)) if len(x) else np.nan


def _against_others(feed: pa.Table, earlier: bool) -> pa.Table:
    """Of every judged load and column of one feed and each metric: by how much it is off the usual of the
    feed's other loads, and the variance that sampling its rows alone would give.

    Others are the judged loads of the feed not marked as out of control (all judged ones if fewer
    than two are left), the load itself excepted; ``earlier`` leaves only those before it.
    """
    get = lambda c: feed.column(c).to_numpy(zero_copy_only=False)
    name, load, rows, out = get("column_name"), get("load_id"), get("rows").astype(float), get("out")
    value = {m: get(m).astype(float) for m in METRICS[:4]}
    hist = np.array(feed.column("hist").to_pylist(), float).reshape(-1, HIGHEST - LOWEST + 1)
    ok = hist.sum(1)
    share = hist / np.maximum(ok, 1)[:, None]
    judged = rows >= MIN_ROWS
    usual, off, sampled = (np.full((len(rows), len(METRICS)), np.nan) for _ in range(3))
    for i in np.flatnonzero(judged):
        others = judged & (name == name[i]) & (load != load[i])
        if earlier:
            others &= load < load[i]
        if np.count_nonzero(others & ~out) >= 2:
            others &= ~out
        if not others.any():
            continue
        u = hist[others].sum(0)
        u = u / max(u.sum(), 1)
        size = max(ok[i], 1)
        deviation = max(_middle(np.exp(value["spread"][others])), LEAST_SPREAD)
        for k, m in enumerate(METRICS[:4]):
            usual[i, k] = _middle(value[m][others])
        p = np.maximum(usual[i, :2], 1 / rows[i])
        off[i] = *(value[m][i] - usual[i, k] for k, m in enumerate(METRICS[:4])), np.abs(share[i] - u).sum() / 2 if ok[i] else np.nan
        off[i, 2] /= deviation
        sampled[i] = *(p * (1 - p) / rows[i]), 1 / size, 0.5 / size, (np.sqrt(u * (1 - u) * 2 / np.pi / size).sum() / 2) ** 2
    keys = {c: feed.column(c) for c in ("feed", "load_id", "column_name", "rows", "out", *METRICS[:4])}
    lists = {c: pa.array(x.tolist(), pa.list_(pa.float64())) for c, x in (("hist", hist), ("usual", usual), ("off", off), ("sampled", sampled))}
    return pa.table({**keys, "judged": pa.array(judged), **lists})


def _components(measured: DataFrame) -> DataFrame:
    """(column_name, metric_no, between, inflation): how loads differ, of each column and metric.  The
    variance of a load's metric is ``between`` (loads differ) plus ``inflation`` times the sampling
    variance (rows of a load are alike); both are solved from the median squared deviations of the
    smaller and of the larger loads that are not out of control."""
    long = measured.where("judged and not out").select("column_name", F.posexplode(F.arrays_zip("off", "sampled")).alias("metric_no", "x"))
    long = long.select("column_name", "metric_no", F.pow("x.off", 2).alias("d"), F.col("x.sampled").alias("s")).where("d is not null and not isnan(d) and not isnan(s)")
    keys = ["column_name", "metric_no"]
    split = long.groupBy(*keys).agg(F.percentile("s", F.lit(0.5)).alias("_cut"))
    half = lambda c, cond: F.percentile(F.when(cond, F.col(c)), F.lit(0.5))
    small, large = F.col("s") > F.col("_cut"), F.col("s") <= F.col("_cut")
    m = long.join(split, keys).groupBy(*keys).agg(half("d", small).alias("ds"), half("s", small).alias("ss"), half("d", large).alias("dl"), half("s", large).alias("sl"))
    per = 1 / 0.4549  # the median of a squared standard normal deviate
    slope = F.when(F.col("ss") > F.col("sl") * 1.0001, per * (F.col("ds") - F.col("dl")) / (F.col("ss") - F.col("sl")))
    m = m.withColumn("inflation", F.greatest(F.coalesce(slope, F.lit(1.0)), F.lit(1.0)))
    return m.select(*keys, F.greatest(per * F.col("dl") - F.col("inflation") * F.col("sl"), F.lit(0.0)).alias("between"), "inflation")


def _scored(measured: DataFrame) -> DataFrame:
    """``measured`` with ``sigmas``: each metric's deviation in learned standard deviations (null where not
    judged or nothing to compare with)."""
    c = _components(measured).groupBy("column_name").agg(F.map_from_entries(F.collect_list(F.struct("metric_no", F.struct("between", "inflation")))).alias("_c"))
    j = measured.join(c, "column_name", "left")

    def one(x: Column, k: Column) -> Column:
        part = F.try_element_at("_c", k)
        v = F.abs(x["off"]) / F.sqrt(part["between"] + part["inflation"] * x["sampled"])
        return F.when(~F.isnan(v), v)  # NaN where there is nothing to compare with

    return j.withColumn("sigmas", F.transform(F.arrays_zip("off", "sampled"), one)).drop("_c")


_PER_LOAD = "feed {feed}, load_id {load}, column_name string, rows bigint, out boolean, nulls double, impossible double, level double, spread double, hist array<double>"


def load_metrics(states: DataFrame, sigmas: float = SIGMAS, earlier: bool = False) -> DataFrame:
    """One row per feed, load and column: (feed, load_id, column_name, rows, judged, nulls, impossible,
    level, spread, and <metric>_sigmas of these and of mix, departs).

    mix is the total variation distance to the merged histogram of the feed's other loads.  A column
    departs if a metric is off by more than ``sigmas`` learned standard deviations.  Limits are made
    twice: loads out of control in the first pass set none in the second.  ``earlier`` compares with
    the loads before only, as when loads are judged on arrival.  Loads under MIN_ROWS rows are not
    judged and set no limits; the only load of a feed cannot depart.  Loads are matched by feed,
    null feeds among themselves.
    """
    kinds = dict(states.dtypes)
    given = _PER_LOAD.format(feed=kinds["feed"], load=kinds["load_id"])
    schema = given + ", judged boolean, " + ", ".join(f"{c} array<double>" for c in ("usual", "off", "sampled"))

    def measure(group: pa.Table) -> pa.Table:
        return _against_others(group, earlier)

    beyond = F.exists("sigmas", lambda x: F.coalesce(x > sigmas, F.lit(False)))
    loads = _per_load(states).withColumn("out", F.lit(False))
    for _ in range(2):  # rows are loads, not records: a feed's are few
        measured = kept(loads.select("feed", "load_id", "column_name", "rows", "out", *METRICS[:4], "hist").groupBy("feed").applyInArrow(measure, schema))
        loads = _scored(measured).withColumn("out", beyond)
    at = lambda k, m: F.get("sigmas", F.lit(k)).alias(f"{m}_sigmas")
    return loads.select("feed", "load_id", "column_name", "rows", "judged", *METRICS[:4], *(at(k, m) for k, m in enumerate(METRICS)), F.col("out").alias("departs"))


def departing_columns(history: DataFrame) -> DataFrame:
    """(load_id, column_name): the count columns of loads that depart from the feed's other loads.

    All rows of a load count; should one load hold rows of several feeds, they are judged
    feed by feed and the load appears once."""
    return load_metrics(count_states(history)).where("departs").select("load_id", "column_name").distinct()
