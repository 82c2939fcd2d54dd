"""The general training-data operators against brute force, on the smallest tables and on cases."""

import datetime as dt
import math

import brute
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reportloom import queries_data
from reportloom.operators import impute, profile, readings, regular, spikes

HISTORY = "rec_id bigint, project_id string, year int, week int, plan double, actual double, n_disc int, n_scopes int, n_concerns int, n_activities int, recorded_at timestamp, feed int, load_id bigint"
PROJECTS = "project_id string, name string, kind string, cadence string"
NAN = float("nan")


def history(spark, rows):
    """rows: (rec_id, project, year, week, plan, actual[, recorded day])"""
    full = [(i, p, y, w, a, b, 1, 1, 1, 1, dt.datetime(2024, 1, (rest or [1])[0]), 1, 1) for i, p, y, w, a, b, *rest in rows]
    return spark.createDataFrame(full, HISTORY)


@pytest.fixture(scope="module")
def dims(spark):
    projects = spark.createDataFrame([("A", "a", "wind", None), ("B", "b", "wind", "monthly"), ("C", "c", "manual", None), ("D", "d", "wind", "odd"), ("E", None, None, None)], PROJECTS)
    expectations = spark.createDataFrame([("wind", 0, 2, True), ("manual", 0, 0, False)], "kind string, min_disc int, min_scopes int, needs_pct boolean")
    cadences = spark.createDataFrame([("weekly", 1, 1), ("monthly", 5, 4), ("odd", 1, 3)], "cadence string, grace_weeks int, step_weeks int")
    return projects, expectations, cadences


def tables(spark, sf):
    return [spark.read.parquet(f"{sf}/{n}.parquet") for n in ("history", "dim_project", "dim_expectation", "dim_cadence")]


def frames(ts):
    return [t.toPandas() for t in ts]


def rows(df):
    return set(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def mixed(spark, dims):
    """Stand-ins, spikes, runs, late recordings, gaps, ties and repeated rows of several projects."""
    rng = np.random.default_rng(5)
    out, i = [], 0
    for p in "ABD":
        for k in range(70):
            if rng.random() < 0.15:
                continue
            for _ in range(1 + (rng.random() < 0.1)):
                i += 1
                v = [round(k * 1.3 + rng.normal() * 0.1, 2), round(k * 1.2 + rng.normal() * 0.1, 2)]
                for f in (0, 1):
                    u = rng.random()
                    if u < 0.08:
                        v[f] = [None, NAN, 999.0, -9.0][int(rng.integers(4))]
                    elif u < 0.14:
                        v[f] = round(float(rng.uniform(-20, 130)), 2)
                    elif u < 0.3 and k > 30:
                        v[f] = 55.5
                out.append((i, p, 2024 + k // 52, k % 52 + 1, *v, int(rng.integers(1, 4))))
    return history(spark, [*out, (900, "C", 2024, 1, None, 1.0), (901, "Z", 2024, 1, None, 1.0), (902, "E", 2024, 1, None, 1.0)])


@pytest.mark.parametrize("which", ["tables", "mixed"])
def test_missing_cells_are_filled(spark, sf, dims, mixed, which):
    h, p, e = tables(spark, sf)[:3] if which == "tables" else (mixed, *dims[:2])
    done = impute.fill_missing(h, p, e).toPandas()
    cells = impute.filled_cells(h, p, e)
    assert rows(cells.select("rec_id", "field")) == brute.p1(*frames((h, p, e)))
    assert done[["plan", "actual"]].notna().all().all()
    assert cells.where("value < 0 or value > 100").count() == 0
    assert len(done) == sum(len(r) for _, r in brute.counted(*frames((h, p, e))).values())


def test_fills_are_close(spark, sf):
    """Held-out accuracy: known cells are blanked and compared."""
    h, p, e = tables(spark, sf)[:3]
    rows_ = readings.counted_rows(h, p, e)
    known = rows_.where("plan_known between 1 and 99 and actual_known between 1 and 99").select("rec_id", F.col("plan_known").alias("truth")).where("rec_id % 7 = 0")
    blank = h.join(known.select("rec_id", F.lit(True).alias("b")), "rec_id", "left").withColumn("plan", F.when(F.col("b").isNull(), F.col("plan"))).drop("b")
    got = impute.filled_cells(blank, p, e).where("field = 'plan'").join(known, "rec_id").select(F.abs(F.col("value") - F.col("truth")).alias("d")).toPandas()
    assert len(got) > 50
    assert got["d"].median() < 3.0
    assert (got["d"] < 12).mean() > 0.85
    # the median of the project's kind, and of all, as what a fill without the tree would be
    k = rows_.where("plan_known between 0 and 100")
    plain = known.join(rows_.select("rec_id", "kind"), "rec_id").join(k.groupBy("kind").agg(F.median("plan_known").alias("m")), "kind").select(F.abs(F.col("m") - F.col("truth")).alias("d")).toPandas()
    assert got["d"].median() < 0.2 * plain["d"].median() and got["d"].mean() < 0.3 * plain["d"].mean()
    assert impute.features(rows_).where("phase < 0 or phase >= 208").count() == 0


def test_phases_of_very_old_projects(spark, dims):
    """Blocks grow with age and never end in one that holds all the rest."""
    h = history(spark, [(k, "A", 2024 + y, 1, 50.0, 50.0) for k, y in enumerate((0, 3, 10, 20, 100, 1000, 100_000))])
    got = [r.phase for r in impute.features(readings.counted_rows(h, *dims[:2])).orderBy("t").collect()]
    assert got[0] == 0 and all(a < b for a, b in zip(got, got[1:])) and got[-1] < impute.PHASES


def test_posteriors_equal_enumeration():
    rng = np.random.default_rng(1)
    sizes, names = [3, 2, 4], ["a", "b", "c"]
    joint = rng.random((3, 2, 4)) * 10
    joint[0] *= 3
    tabs = {(0, 1): joint.sum(2), (0, 2): joint.sum(1), (1, 2): joint.sum(0)}
    tree = impute.build_tree(names, sizes, tabs, [np.zeros(11), np.zeros(11)])
    full = np.zeros(sizes)
    for idx in np.ndindex(*sizes):
        full[idx] = math.prod(tree.cpt[k][0 if tree.parent[k] < 0 else idx[tree.parent[k]], idx[k]] for k in range(3))
    assert full.sum() == pytest.approx(1)
    for seen in ({}, {1: 1}, {2: 3}, {1: 0, 2: 2}):
        codes = [np.array([seen.get(k, -1)]) for k in range(3)]
        post = impute.posteriors(tree, codes, [0])[0][0]
        own = full.copy()
        for k, v in seen.items():
            keep = np.zeros(sizes[k])
            keep[v] = 1
            own = own * keep.reshape([-1 if j == k else 1 for j in range(3)])
        assert post == pytest.approx(own.sum((1, 2)) / own.sum())


@pytest.mark.parametrize("which", ["tables", "mixed"])
def test_missing_periods(spark, sf, dims, mixed, which):
    h, p, e, c = tables(spark, sf) if which == "tables" else (mixed, *dims)
    assert rows(regular.missing_periods(h, p, e, c)) == brute.p2(*frames((h, p, e, c)))


@pytest.mark.parametrize("step", [1, 2, 3, 4, 6, 8, 13])
def test_periods_of_any_length(spark, dims, mixed, step):
    """Periods of a step that does not divide four weeks are as long as stated, and fitted in periods."""
    p, e, _ = dims
    c = spark.createDataFrame([("weekly", 1, 1), ("monthly", 5, 4), ("odd", 1, step)], "cadence string, grace_weeks int, step_weeks int")
    assert rows(regular.missing_periods(mixed, p, e, c)) == brute.p2(*frames((mixed, p, e, c)))
    line = history(spark, [(k, "D", 2024, 1 + k * step, 10.0 + k, None) for k in (0, 1, 3)])
    got = regular.regular_grid(line, p, e, c).orderBy("year", "week").collect()
    assert [(r.week, r.step_weeks, r.plan, r.plan_status) for r in got] == [(1 + k * step, step, 10.0 + k, "filled" if k == 2 else "observed") for k in range(4)]


def test_grid_values(spark, dims):
    """The window moments give the local linear fit computed directly."""
    vals = {0: 1.0, 1: 2.5, 2: 3.0, 5: 9.0, 6: 9.5, 13: 30.0}
    h = history(spark, [(k, "A", 2024, k + 1, v, None) for k, v in vals.items()])
    got = regular.regular_grid(h, *dims).toPandas().set_index("week")
    assert len(got) == 14 and got.index.min() == 1
    for g in range(14):
        near = [(x - g, v) for x, v in vals.items() if abs(x - g) < 3]
        w = [1 - d * d / 9 for d, _ in near]
        s0, s1, s2 = (sum(a * d**k for a, (d, _) in zip(w, near, strict=True)) for k in range(3))
        t0, t1 = (sum(a * d**k * v for a, (d, v) in zip(w, near, strict=True)) for k in range(2))
        row = got.loc[g + 1]
        if not near:
            assert row["plan_status"] == "missing" and pd.isna(row["plan"])
            continue
        support = s0 * s0 / sum(a * a for a in w)
        assert row["plan_support"] == pytest.approx(support, abs=1e-3)
        det = s0 * s2 - s1 * s1
        fit = (s2 * t0 - s1 * t1) / det if det > 1e-6 else t0 / s0
        inside = [v for x, v in vals.items() if abs(x - g) <= 3]
        if support >= regular.MIN_SUPPORT or g in vals:
            assert row["plan"] == pytest.approx(min(max(fit, min(inside)), max(inside)), abs=1e-3)
    assert set(got["actual_status"]) == {"missing"} and got.loc[1, "plan_status"] == "observed"


@pytest.mark.parametrize("which", ["tables", "mixed"])
def test_implausible_readings(spark, sf, dims, mixed, which):
    h, p, e = tables(spark, sf)[:3] if which == "tables" else (mixed, *dims[:2])
    want = brute.p4(*frames((h, p, e)))
    assert want
    assert rows(spikes.implausible(h, p, e)) == want


def test_tail_leaves_few_regular_readings(spark, sf):
    """The cutoff lets through about the risk of readings that are no spikes."""
    j = spikes.judged_readings(*tables(spark, sf)[:3], risk=0.02).where("cutoff is not null and not spike")
    n, extreme = j.agg(F.count("*"), F.count_if("extreme")).first()
    assert 0 < extreme / n < 0.1


def test_risk_decides_the_candidates(spark):
    """A greater risk lets more readings through to the check, which finds the same spikes among them."""
    ts = tables(spark, "/root/testdata/sf0.01")[:3]
    seen = {}
    for risk in (0.0001, 0.02, 0.2):
        j = spikes.judged_readings(*ts, risk=risk).cache()
        assert j.where("spike and not candidate").count() == 0
        seen[risk] = [j.where(c).count() for c in ("candidate", "spike", "spike and extreme")]
        assert rows(j.where("outside or stuck or spike").select("rec_id", "field")) == rows(spikes.implausible(*ts))
        j.unpersist()
    least, middle, most = seen.values()
    assert least[0] < middle[0] < most[0] and least[1] == middle[1] == most[1] > 0.95 * least[1]
    assert all(extreme > 0.98 * spike and candidates > 2 * spike for candidates, spike, extreme in seen.values())


def test_spikes_of_every_year_are_found(spark, dims):
    """A spike that comes each year in the same season is its season's usual deviation, and a spike
    by the stated definition none the less."""
    out = []
    for year in range(2010, 2020):
        for k, week in enumerate([5, *range(20, 40)]):
            out.append((len(out), "A", year, week, 30.0 + 0.1 * (k % 3) + 10.0 * (week == 5), None))
    h = history(spark, out)
    want = brute.p4(*frames((h, *dims[:2])))
    assert want == {(i, "plan") for i, _, year, week, *_ in out if week == 5 and year > 2010}
    assert rows(spikes.implausible(h, *dims[:2])) == want


def test_rules_alone_decide_the_spikes(spark, sf):
    """Spikes do not wait for the tail, which could not change them: where only the rules' marks are
    selected none is fitted, and the ratings still have it."""
    ts = tables(spark, sf)[:3]
    fitted = lambda df: [k in df._jdf.queryExecution().optimizedPlan().toString() for k in ("var_pop", "season", "deviation")]
    assert fitted(spikes.implausible(*ts)) == [False] * 3
    assert fitted(spikes.judged_readings(*ts)) == [True] * 3


def _loads(spark, odd=None, n=200, loads=10):
    rng = np.random.default_rng(3)
    out = []
    for load in range(loads):
        for k in range(n):
            v = [int(x) for x in rng.poisson(4, 4).clip(0, 20)]
            if odd and load == 4:
                v[0] = odd(k, v[0])
            out.append((load * 1000 + k, f"P{k % 20}", 2024, 1, 1.0, 1.0, *v, dt.datetime(2024, 1, 1), 1, load))
    return spark.createDataFrame(out, HISTORY)


@pytest.mark.parametrize(
    "odd,found",
    [
        (None, False),
        (lambda k, v: None if k % 4 == 0 else v, True),
        (lambda k, v: 99 if k % 8 == 0 else v, True),
        (lambda k, v: min(20, v + 8), True),
        (lambda k, v: v if k % 50 else 77, False),
        (lambda k, v: 4, True),
        (lambda k, v: 0 if k % 2 else 9, True),
    ],
)
def test_departing_loads(spark, odd, found):
    assert rows(profile.departing_columns(_loads(spark, odd))) == ({(4, "n_disc")} if found else set())


def test_limits_come_from_the_history(spark):
    """The same null share departs in a feed whose loads are alike and not where loads differ as much."""
    rng = np.random.default_rng(8)

    def feed(shares):
        out = []
        for load, share in enumerate(shares):
            for k in range(400):
                n = [int(x) for x in rng.poisson(4, 4).clip(0, 20)]
                out.append((load * 1000 + k, f"P{k % 20}", 2024, 1, 1.0, 1.0, None if k < share * 400 else n[0], *n[1:], dt.datetime(2024, 1, 1), 1, load))
        return spark.createDataFrame(out, HISTORY)

    calm, wild = [0.02] * 9 + [0.12], [0.0, 0.1, 0.03, 0.14, 0.06, 0.01, 0.13, 0.05, 0.09, 0.12]
    assert rows(profile.departing_columns(feed(calm))) == {(9, "n_disc")}
    assert rows(profile.departing_columns(feed(wild))) == set()
    h = feed(calm)
    at = lambda n: profile.load_metrics(profile.count_states(h), sigmas=n).where("departs").count()
    assert at(50.0) == 0 < at(5.5) == 1 < at(0.5)
    # on arrival only the loads before count: the first has none to compare with
    arrived = profile.load_metrics(profile.count_states(h), earlier=True)
    assert rows(arrived.where("departs").select("load_id", "column_name")) == {(9, "n_disc")}
    assert arrived.where("load_id = 0 and nulls_sigmas is not null").count() == 0


def test_load_metrics_equal_brute_force(spark):
    """Distances in standard deviations, restated plainly."""
    h = spark.read.parquet("/root/testdata/sf0.01/history.parquet")
    got = {(r.load_id, r.column_name): r for r in profile.load_metrics(profile.count_states(h)).where("judged").collect()}
    want = brute.p5(h.toPandas())
    assert set(got) == set(want)
    for k, z in want.items():
        assert [got[k][f"{m}_sigmas"] for m in profile.METRICS] == pytest.approx(z, rel=1e-6, abs=1e-6), k
    assert {k for k, r in got.items() if r.departs} == {k for k, z in want.items() if max(z) > profile.SIGMAS}


def test_small_loads_and_single_loads_are_not_judged(spark):
    assert profile.departing_columns(_loads(spark, lambda k, v: None, n=149)).count() == 0
    assert profile.departing_columns(_loads(spark, n=200, loads=1)).count() == 0


def test_states_merge(spark):
    h = _loads(spark)
    a, b = h.where("rec_id % 2 = 0"), h.where("rec_id % 2 = 1")
    cols = ["feed", "load_id", "column_name", "value", "n"]
    assert rows(profile.merge_states(profile.count_states(a), profile.count_states(b)).select(cols)) == rows(profile.count_states(h).select(cols))
    whole = {r.column_name: r for r in profile.profile(profile.column_states(h, ["n_disc", "project_id"])).collect()}
    parts = profile.column_states(a, ["n_disc", "project_id"]).unionByName(profile.column_states(b, ["n_disc", "project_id"]))
    for r in profile.profile(parts).collect():
        w = whole[r.column_name]
        assert (r.rows, r.nulls, r.distinct_estimate) == (w.rows, w.nulls, w.distinct_estimate)
        assert r.mean == pytest.approx(w.mean) if w.mean is not None else r.mean is None


def test_checks_share_a_scan(spark):
    df = spark.createDataFrame([("PRJ-1", 5.0), ("bad", None), (None, NAN), ("PRJ-2", 101.0)], "id string, v double")
    checks = (profile.not_null("id"), profile.matches("id", r"^PRJ-\d$"), profile.between("v", 0, 100))
    got = {r.column_name: r for r in profile.column_states(df, checks=checks).collect()}
    assert got["id"].violations == {"not_null": 1, "pattern": 1}
    assert got["v"].violations == {"between_0_100": 2}  # NaN lies in no range
    assert (got["v"].rows, got["v"].nulls, got["v"].total) == (4, 1, 106.0)


def test_profile_of_every_column(spark, sf):
    """p5_profile has every column with its range and each check by itself."""
    h = pd.read_parquet(f"{sf}/history.parquet")
    got = {r.column_name: r for r in queries_data.p5_profile(spark, sf).collect()}
    assert set(got) == set(h.columns)
    for c in h.columns:
        v = h[c].dropna()
        as_ = str if c == "project_id" else pd.Timestamp if c == "recorded_at" else float
        assert (as_(got[c].low), as_(got[c].high)) == (as_(v.min()), as_(v.max())), c
    assert got["project_id"].violations == {"not_null": int(h.project_id.isna().sum()), "pattern": int((~h.project_id.dropna().str.fullmatch(r"PRJ-\d{7}")).sum())}
    assert got["n_disc"].violations == {"between_0_20": int((~h.n_disc.dropna().between(0, 20)).sum())}
    assert got["feed"].violations == {}


def test_ranges_and_checks_merge_by_kind(spark):
    """9 is below 10, whole numbers stay exact, NaN is in no range, checks of a column stay apart."""
    t = dt.datetime
    rows_ = [(1, 9, 9.0, "b", t(2024, 1, 2)), (1, 2**53, NAN, None, None), (2, 10, 10.5, "bad", t(2024, 1, 2, 0, 0, 0, 5)), (2, 2**53 + 1, None, "c", None), (3, None, None, None, None)]
    df = spark.createDataFrame(rows_, "feed int, k bigint, v double, id string, at timestamp_ntz")
    checks = (profile.not_null("id"), profile.matches("id", "^.$"))
    got = {r.column_name: r for r in profile.profile(profile.column_states(df, columns=df.columns, by=("feed",), checks=checks)).collect()}
    assert {c: (r.low, r.high) for c, r in got.items()} == {
        "feed": ("1", "3"), "k": ("9", str(2**53 + 1)), "v": ("9.0", "10.5"), "id": ("b", "c"), "at": ("2024-01-02 00:00:00", "2024-01-02 00:00:00.000005"),
    }
    assert got["id"].violations == {"not_null": 2, "pattern": 1} and got["k"].violations == {}
    assert (got["id"].rows, got["id"].nulls, got["feed"].rows) == (5, 2, 5)


def test_empty_and_odd_tables(spark, dims):
    """Empty tables give empty results; nulls in any column and extra columns do no harm."""
    none = history(spark, [])
    assert impute.filled_cells(none, *dims[:2]).count() == 0
    assert regular.regular_grid(none, *dims).count() == 0
    assert spikes.implausible(none, *dims[:2]).count() == 0
    assert profile.departing_columns(none).count() == 0
    h = history(spark, [(1, "A", 2024, 1, None, None), (2, None, 2024, 1, 1.0, 1.0), (3, "A", None, 1, 1.0, 1.0), (4, "A", 2024, None, 1.0, 1.0), (1, "A", 2024, 1, None, None)])
    h = h.withColumn("recorded_at", F.lit(None).cast("timestamp"))
    for name in ("t", "step", "kind", "_r", "x", "v", "field", "u", "_odd", "cadence", "season", "rows", "value"):
        h = h.withColumn(name, F.lit("clash"))
    p, e, c = (d.withColumn("t", F.lit(1)).withColumn("rec_id", F.lit(2)).withColumn("plan", F.lit(3)) for d in dims)
    assert rows(impute.filled_cells(h, p, e).select("rec_id", "field")) == {(1, "plan"), (1, "actual")}
    assert rows(regular.missing_periods(h, p, e, c)) == {("A", 2024, 1)}
    assert spikes.implausible(h, p, e).count() == 0
    assert profile.count_states(h).agg(F.sum("n")).first()[0] == 20


def test_a_hot_project(spark, dims):
    """One project-week recorded very often counts once, whatever the order of rows."""
    log = [(k, "A", 2024, 1, float(k % 90), None, 1 + k % 20) for k in range(3000)] + [(5000, "A", 2024, 3, 50.0, 50.0)]
    h = history(spark, log).repartition(7)
    assert impute.fill_missing(h, *dims[:2]).count() == 2
    assert rows(regular.missing_periods(h, *dims)) == {("A", 2024, 2)}
