"""Problem 1: missing plan and actual filled from similar records.

A Chow-Liu tree over discretised and categorical fields: pairwise mutual information from
mergeable contingency counts, the maximum spanning tree, and message passing from whatever
a record does hold to the posterior of what it lacks.  A fill is the median of the most
probable bin.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportloom.operators.readings import counted_rows
from reportloom.session import kept

BINS = 50  # over 0..100; the same for the field itself and its neighbours in time
PHASE_WEEKS = 4
EVEN_PHASES = 32  # blocks of PHASE_WEEKS since the first row; later ones are eighths of a doubling
PHASES = EVEN_PHASES + 8 * 22  # enough for any label week an int can hold
FINE = 10  # steps per percentage point, for bin medians
SMOOTHING = 0.1
FIELDS = ("plan", "actual")
NEIGHBOURS = ("plan_before", "plan_after", "actual_before", "actual_after")


@dataclass
class Tree:
    """Nodes in an order where parents come first; parent[0] is -1.  cpt[k] is P(k | parent),
    rows by the parent's state; of the root its prior as one row."""

    names: list[str]
    order: list[int]
    parent: list[int]
    cpt: list[np.ndarray]
    median: dict[str, np.ndarray]


def features(rows: DataFrame) -> DataFrame:
    """``rows`` (see counted_rows) with the nearest known values before and after, and the phase:
    four-week blocks since the project's first row, longer ones after the first 32."""
    by_time = Window.partitionBy("project_id").orderBy("t")
    first = by_time.rowsBetween(Window.unboundedPreceding, 0)
    over = "ignore nulls over (partition by project_id order by t)"
    cols = {}
    for f in FIELDS:
        cols[f"{f}_before"] = F.expr(f"lag({f}_known, 1) {over}")
        cols[f"{f}_after"] = F.expr(f"lead({f}_known, 1) {over}")
    block = F.floor((F.col("t") - F.min("t").over(first)) / PHASE_WEEKS)
    later = EVEN_PHASES + F.floor(8 * F.log2(block / EVEN_PHASES))
    cols["phase"] = F.when(block < EVEN_PHASES, block).otherwise(later).cast("int")
    return rows.withColumns(cols)


def _bin(v: Column) -> Column:
    """0..BINS-1, values outside the range in the outermost bins; null stays null."""
    inside = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor(v * (BINS / 100)))).cast("int")
    return F.when(v.isNotNull(), inside)


def _codes(kinds: list[str]) -> dict[str, Column]:
    """Node name -> state; -1 where the record does not hold it."""
    cols = {f: F.coalesce(_bin(F.col(f"{f}_known")), F.lit(-1)) for f in FIELDS}
    cols |= {n: F.coalesce(_bin(F.col(n)), F.lit(-1)) for n in NEIGHBOURS}
    cols["phase"] = F.coalesce(F.col("phase"), F.lit(-1))
    cols["kind"] = F.coalesce(F.array_position(F.lit(kinds) if kinds else F.array().cast("array<string>"), F.col("kind")), F.lit(0)).cast("int") - 1
    return cols


def _sizes(kinds: list[str]) -> dict[str, int]:
    return {f: BINS for f in (*FIELDS, *NEIGHBOURS)} | {"phase": PHASES, "kind": max(1, len(kinds))}


def _contingency(sizes: list[int]):
    """mapInArrow function: counts of state pairs, and of fine values for the medians, of a task."""
    pairs = list(combinations(range(len(sizes)), 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(sizes[i] * sizes[j], np.int64) for i, j in pairs]
        fine = [np.zeros(100 * FINE + 1, np.int64) for _ in FIELDS]
        for b in batches:
            codes = [b.column(k).to_numpy(zero_copy_only=False) for k in range(len(sizes))]
            for t, (i, j) in zip(tables, pairs, strict=True):
                both = (codes[i] >= 0) & (codes[j] >= 0)
                t += np.bincount(codes[i][both] * sizes[j] + codes[j][both], minlength=len(t))
            for k, t in enumerate(fine):
                v = b.column(len(sizes) + k).drop_null().to_numpy(zero_copy_only=False)
                t += np.bincount(np.rint(v[(v >= 0) & (v <= 100)] * FINE).astype(np.int64), minlength=len(t))
        for k, t in enumerate(tables + fine):
            cell = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cell), k, np.int32)), pa.array(cell.astype(np.int32)), pa.array(t[cell])], names=["tab", "cell", "n"]
            )

    return run


def mutual_information(table: np.ndarray) -> float:
    n = table.sum()
    if n == 0:
        return 0.0
    p = table / n
    expected = p.sum(1, keepdims=True) * p.sum(0, keepdims=True)
    on = p > 0
    return float((p[on] * np.log(p[on] / expected[on])).sum())


def build_tree(names: list[str], sizes: list[int], tables: dict[tuple[int, int], np.ndarray], fine: list[np.ndarray]) -> Tree:
    """Maximum spanning tree of mutual information; ties go to the pair named first."""
    edges = sorted(((-mutual_information(t), i, j) for (i, j), t in tables.items()))
    part = list(range(len(names)))
    near: dict[int, list[int]] = {k: [] for k in part}
    for _, i, j in edges:
        if part[i] != part[j]:
            near[i].append(j)
            near[j].append(i)
            part = [part[i] if p == part[j] else p for p in part]
    order, parent = [0], [-1] * len(names)
    for k in order:
        for m in near[k]:
            if m != 0 and parent[m] < 0:
                parent[m] = k
                order.append(m)
    cpt: list[np.ndarray] = [np.empty(0)] * len(names)
    for k in order:
        p = parent[k]
        if p < 0:
            joint = sum((t.sum(1) for (i, _), t in tables.items() if i == k), np.zeros(sizes[k]))[None, :].astype(float)
        else:
            joint = (tables[p, k] if p < k else tables[k, p].T).astype(float)
        # smoothing towards the field's own distribution
        own = joint.sum(0) + 1e-3
        joint = joint + SMOOTHING * own / own.sum() * sizes[k]
        cpt[k] = joint / joint.sum(1, keepdims=True)
    median = {}
    for f, t in zip(FIELDS, fine, strict=True):
        at = np.arange(len(t)) / FINE
        bins = np.minimum((at * BINS / 100).astype(int), BINS - 1)
        mid = np.empty(BINS)
        for b in range(BINS):
            own = t[bins == b]
            mid[b] = at[bins == b][np.searchsorted(np.cumsum(own), own.sum() / 2)] if own.sum() else (b + 0.5) * 100 / BINS
        median[f] = np.round(mid, 2)
    return Tree(names, order, parent, cpt, median)


def posteriors(tree: Tree, codes: list[np.ndarray], wanted: list[int]) -> dict[int, np.ndarray]:
    """Message passing: P(node | what the rows hold) for the wanted nodes, one row per record."""
    n = len(codes[0])
    up: dict[int, np.ndarray] = {}  # evidence at and below a node, by its states
    for k in reversed(tree.order):
        s = tree.cpt[k].shape[1]
        here = np.ones((n, s))
        seen = codes[k] >= 0
        here[seen] = 0
        here[np.flatnonzero(seen), codes[k][seen]] = 1
        for c in (c for c in tree.order if tree.parent[c] == k):
            here *= up[c] @ tree.cpt[c].T
        up[k] = here / here.sum(1, keepdims=True).clip(1e-300)
    down: dict[int, np.ndarray] = {tree.order[0]: np.repeat(tree.cpt[tree.order[0]], n, axis=0)}
    for k in tree.order[1:]:
        p = tree.parent[k]
        here = down[p].copy()
        seen = codes[p] >= 0
        here[seen] = 0
        here[np.flatnonzero(seen), codes[p][seen]] = 1
        for c in (c for c in tree.order if tree.parent[c] == p and c != k):
            here *= up[c] @ tree.cpt[c].T
        here /= here.sum(1, keepdims=True).clip(1e-300)
        down[k] = here @ tree.cpt[k]
    out = {}
    for k in wanted:
        post = up[k] * down[k]
        total = post.sum(1, keepdims=True)
        out[k] = np.where(total > 0, post / total.clip(1e-300), down[k])
    return out


def learn(rows: DataFrame, kinds: list[str]) -> Tree:
    """The tree of ``rows`` (see features).  Tasks send contingency counts, which are summed by
    cell; what reaches the driver is bounded by the numbers of states, not by the rows."""
    sizes = _sizes(kinds)
    names = list(sizes)
    size = list(sizes.values())
    pairs = list(combinations(range(len(size)), 2))
    src = rows.select(*(c.cast("int").alias(k) for k, c in _codes(kinds).items()), *(F.col(f"{f}_known").alias(f"{f}_value") for f in FIELDS))
    cells = src.mapInArrow(_contingency(size), "tab int, cell int, n bigint").groupBy("tab", "cell").agg(F.sum("n").alias("n")).toPandas()
    flat = [np.zeros(size[i] * size[j]) for i, j in pairs] + [np.zeros(100 * FINE + 1) for _ in FIELDS]
    for tab, own in cells.groupby("tab"):
        flat[tab][own["cell"].to_numpy()] = own["n"].to_numpy()
    tables = {(i, j): flat[k].reshape(size[i], size[j]) for k, (i, j) in enumerate(pairs)}
    return build_tree(names, size, tables, flat[len(pairs) :])


def _decode(tree: Tree):
    """mapInArrow function: rows with missing cells, completed."""
    at = {f: tree.names.index(f) for f in FIELDS}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(tree.names)
        for b in batches:
            if not b.num_rows:
                continue
            codes = [b.column(k).to_numpy(zero_copy_only=False) for k in range(width)]
            post = posteriors(tree, codes, list(at.values()))
            cols = list(b.columns[width:])
            for f in FIELDS:
                p = post[at[f]]
                best = p.argmax(1)
                missing = codes[at[f]] < 0
                given = b.column(width + b.schema.names[width:].index(f"{f}_known")).to_numpy(zero_copy_only=False)
                cols.append(pa.array(np.where(missing, tree.median[f][best], given)))
                cols.append(pa.array(missing))
                cols.append(pa.array(np.where(missing, p.max(1), 1.0)))
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names[width:], *(f"{f}_{x}" for f in FIELDS for x in ("out", "filled", "p"))])

    return run


def fill_missing(history: DataFrame, projects: DataFrame, expectations: DataFrame) -> DataFrame:
    """One row per current row of a project that counts: (project_id, year, week, rec_id, plan,
    actual, plan_filled, actual_filled, plan_p, actual_p).

    Every missing cell comes out with a value and the mark; ``_p`` is the posterior
    probability of its bin (1.0 for a reported value).  Reported values outside 0 to 100 that
    are no stand-ins are kept as they are.  With nothing reported anywhere the fill is a bin's
    centre; an empty table gives an empty table.
    """
    rows = kept(
        features(counted_rows(history, projects, expectations)).select(
            "project_id", "t", "rec_id", "kind", "phase", "plan_known", "actual_known", *NEIGHBOURS
        )
    )
    kinds = sorted(r.kind for r in expectations.select("kind").distinct().collect() if r.kind is not None)
    tree = learn(rows, kinds)
    lacking = "plan_known is null or actual_known is null"
    keep = ("project_id", "t", "rec_id", "plan_known", "actual_known")
    coded = rows.where(lacking).select(*(c.cast("int").alias(f"c_{k}") for k, c in _codes(kinds).items()), *keep)
    schema = "project_id string, t int, rec_id bigint, plan_known double, actual_known double, " + ", ".join(
        f"{f}_out double, {f}_filled boolean, {f}_p double" for f in FIELDS
    )
    filled = coded.mapInArrow(_decode(tree), schema)
    whole = rows.where(f"not ({lacking})").select(
        *keep, *(x for f in FIELDS for x in (F.col(f"{f}_known").alias(f"{f}_out"), F.lit(False).alias(f"{f}_filled"), F.lit(1.0).alias(f"{f}_p")))
    )
    return filled.unionByName(whole).select(
        "project_id",
        F.expr("cast(floor(t / 52) as int)").alias("year"),
        F.expr("cast(t % 52 + 1 as int)").alias("week"),
        "rec_id",
        F.col("plan_out").alias("plan"),
        F.col("actual_out").alias("actual"),
        "plan_filled",
        "actual_filled",
        "plan_p",
        "actual_p",
    )


def filled_cells(history: DataFrame, projects: DataFrame, expectations: DataFrame) -> DataFrame:
    """(rec_id, field, value, p): the cells that were missing, with their fills."""
    done = fill_missing(history, projects, expectations)
    cell = lambda f: F.struct(F.lit(f).alias("field"), F.col(f).alias("value"), F.col(f"{f}_filled").alias("filled"), F.col(f"{f}_p").alias("p"))
    return (
        done.where("plan_filled or actual_filled")
        .select("rec_id", F.explode(F.array(*map(cell, FIELDS))).alias("x"))
        .where("x.filled and x.value is not null")
        .select("rec_id", "x.field", "x.value", "x.p")
    )
