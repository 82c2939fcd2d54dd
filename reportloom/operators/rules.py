"""The quality rules over a panel with previous values, as one pass of array-of-struct expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.functions.text import looks_like_table

CAP = 20
TOLERANCE = 0.5
FROZEN = 3
VARIANCE = 25.0


def in_range(v: Column) -> Column:
    return F.coalesce(v.between(0.0, 100.0), F.lit(False))


def expected(rows: DataFrame, projects: DataFrame, expectations: DataFrame) -> DataFrame:
    """``rows`` with kind, min_disc, min_scopes, needs_pct; a project without an expectation has none."""
    own = projects.groupBy("project_id").agg(F.min("kind").alias("kind"))
    j = rows.join(own, "project_id", "left").join(expectations, "kind", "left")
    zero = {"min_disc": F.lit(0), "min_scopes": F.lit(0), "needs_pct": F.lit(False)}
    return j.withColumns({c: F.coalesce(c, d) for c, d in zero.items()})


def content_not_prose(items: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(…keys, field, n_junk, n_items, sample, note): lists (…keys, field, items) that hold table text: how
    many of how many, the first of it cut to 120 characters, and a note where the list is at its
    cap, so that real items may be missing as well."""
    each = items.select(*keys, "field", F.size("items").alias("n_items"), F.posexplode("items").alias("n", "item"))
    junk = looks_like_table(F.col("item"))
    found = each.groupBy(*keys, "field", "n_items").agg(F.count_if(junk).alias("n_junk"), F.substring(F.min_by(F.when(junk, F.col("item")), F.when(junk, F.col("n"))), 1, 120).alias("sample"))
    note = F.when(F.col("n_items") >= CAP, F.concat(F.lit("the list is at its cap of "), F.lit(CAP).cast("string")))
    return found.where("n_junk > 0").select(*keys, "field", "n_junk", "n_items", "sample", note.alias("note"))


def with_junk(rows: DataFrame, not_prose: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``rows`` with junk_concerns and junk_activities, the table lines of their lists (0 where nothing is
    known of them)."""
    n = lambda f: F.sum(F.when(F.col("field") == f, F.col("n_junk"))).alias(f"junk_{f}")
    j = rows.join(not_prose.groupBy(*keys).agg(*map(n, ("concerns", "activities"))), list(keys), "left")
    return j.fillna(0, [f"junk_{f}" for f in ("concerns", "activities")])


def panel_rules() -> list[tuple[int, str, str, str | None, Column]]:
    """(order, severity, rule, subject, condition) over with_previous(…) joined to expectations and
    with_junk(…): a list that holds table text is reported as such and not as truncated."""
    c = F.col
    plan, actual = c("plan"), c("actual")
    out = []
    for f in ("plan", "actual"):
        out.append((1, "FAIL", "missing-pct", f, c("needs_pct") & c(f).isNull()))
    for f in ("plan", "actual"):
        out.append((2, "FAIL", "pct-out-of-range", f, c("needs_pct") & c(f).isNotNull() & ~in_range(c(f))))
    out.append((3, "FAIL", "missing-disciplines", None, F.coalesce("n_disc", F.lit(0)) < c("min_disc")))
    out.append((4, "FAIL", "missing-scopes", None, F.coalesce("n_scopes", F.lit(0)) < c("min_scopes")))
    for f in ("concerns", "activities"):
        out.append((7, "WARN", "content-truncated", f, (c(f"n_{f}") >= CAP) & (c(f"junk_{f}") == 0)))
    out.append((8, "WARN", "content-empty", None, (F.coalesce("n_concerns", F.lit(0)) == 0) & (F.coalesce("n_activities", F.lit(0)) == 0)))
    out.append((9, "WARN", "variance-large", None, in_range(plan) & in_range(actual) & (F.round(F.abs(actual - plan), 6) > VARIANCE)))
    for f in ("plan", "actual"):
        out.append((10, "FAIL", "value-vanished", f, c(f).isNull() & c(f"prev_{f}").isNotNull()))
    out.append((11, "WARN", "actual-went-backwards", None, in_range(actual) & in_range(c("prev_actual")) & (F.round(c("prev_actual") - actual, 6) > TOLERANCE)))
    for f, n in (("disciplines", "n_disc"), ("scopes", "n_scopes")):
        out.append((12, "WARN", "structure-shrank", f, c("prev_year").isNotNull() & (F.coalesce(n, F.lit(0)) < F.coalesce(f"prev_{n}", F.lit(0)))))
    out.append((13, "WARN", "value-frozen", None, (c("prev_streak") + 1 >= FROZEN) & in_range(actual) & (actual == c("prev_actual"))))
    return out


def findings(rows: DataFrame, keys: tuple[str, ...] = ("project_id", "year", "week")) -> DataFrame:
    """(…keys, rule_no, severity, rule, subject): all findings of all rows by one scan."""
    each = [
        F.when(
            F.coalesce(cond, F.lit(False)),
            F.struct(F.lit(no).alias("rule_no"), F.lit(sev).alias("severity"), F.lit(rule).alias("rule"), F.lit(subject).cast("string").alias("subject")),
        )
        for no, sev, rule, subject, cond in panel_rules()
    ]
    hit = F.filter(F.array(*each), lambda x: x.isNotNull())
    return rows.select(*keys, F.explode(hit).alias("f")).select(*keys, "f.*")


def detail_findings(scopes: DataFrame, not_prose: DataFrame, keys: tuple[str, ...] = ("project_id", "year", "week")) -> DataFrame:
    """(…keys, rule_no, severity, rule, subject) of the two rules below the panel: scopes without a figure
    (…keys, scope) and lists that are not prose (…keys, field)."""
    found = lambda df, no, rule, subject: df.select(*keys, F.lit(no).alias("rule_no"), F.lit("WARN").alias("severity"), F.lit(rule).alias("rule"), F.col(subject).alias("subject"))
    return found(scopes, 5, "scope-incomplete", "scope").unionByName(found(not_prose, 6, "content-not-prose", "field"))


def scope_incomplete(scopes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(…keys, scope, detail) of scopes without plan or actual; NaN counts as absent."""
    have = lambda c: F.when(~F.isnan(c), F.col(c))
    show = lambda c: F.coalesce(have(c).cast("decimal(9,2)").cast("string"), F.lit("None"))
    detail = F.concat(F.lit("plan="), show("plan"), F.lit(", actual="), show("actual"))
    return scopes.where(have("plan").isNull() | have("actual").isNull()).select(*keys, "scope", detail.alias("detail"))


def counts(found: DataFrame) -> DataFrame:
    """(fails, warns, projects_flagged)."""
    return found.agg(F.count_if(F.col("severity") == "FAIL").alias("fails"), F.count_if(F.col("severity") == "WARN").alias("warns"), F.countDistinct("project_id").alias("projects_flagged"))


def by_project(found: DataFrame) -> DataFrame:
    """(project_id, fails, warns, worst): worst is the rule of least severity rank, then rule number."""
    rank = F.struct(F.when(F.col("severity") == "FAIL", 0).otherwise(1).alias("s"), "rule_no", "rule")
    return found.groupBy("project_id").agg(F.count_if(F.col("severity") == "FAIL").alias("fails"), F.count_if(F.col("severity") == "WARN").alias("warns"), F.min(rank)["rule"].alias("worst"))


def as_text(found: DataFrame) -> DataFrame:
    """(project_id, year, week, text): the findings of a row as lines, FAIL first, then by rule."""
    line = F.concat(F.col("severity"), F.lit(" "), F.col("rule"), F.coalesce(F.concat(F.lit(": "), F.col("subject")), F.lit("")))
    rank = F.when(F.col("severity") == "FAIL", 0).otherwise(1)
    parts = F.array_sort(F.collect_list(F.struct(rank.alias("s"), F.col("rule_no"), line.alias("line"))))
    return found.groupBy("project_id", "year", "week").agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("text"))
