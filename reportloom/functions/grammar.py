"""Wordings of progress statements as data, and columns that read them.

A grammar names the groups of its pattern in order: label, actual, plan, direction, delta,
signed.  Patterns are plain enough for any regular-expression engine; each was written for
one wording and is not widened for another.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.functions.numeric import PERCENT, plan_from_delta, plan_from_signed

N = f"({PERCENT})"


@dataclass(frozen=True)
class Grammar:
    name: str
    pattern: str
    groups: tuple[str, ...]
    wording: str  # printf arguments in the order of ``groups``

    @property
    def figures(self) -> set[str]:
        """Which of plan and actual it says; a delta says the plan too."""
        return {"plan" if x in ("delta", "signed") else x for x in self.groups} & {"plan", "actual"}


# The wordings that reports use.
GRAMMARS = {
    g.name: g
    for g in (
        Grammar("row_pair", rf"(?i)(engineer|procure|construct|commission|overall)\w*\s+{N}\s+{N}", ("label", "plan", "actual"), "%s %s %s"),
        Grammar("callout", rf"(?i)plan\s*/\s*actual\s*:?[\s\S]{{0,20}}?{N}\s*%\s*/\s*{N}\s*%", ("plan", "actual"), "Plan / Actual :\n%s%% / %s%%"),
        Grammar(
            "stands_at",
            rf"(?i)(overall|engineering|procurement|construction)\s+(?:project\s+)?progress\s+stands\s+at\s*{N}\s*%\s+against\s+the\s+planned\s+progress\s+of\s*{N}\s*%",
            ("label", "actual", "plan"),
            "%s progress stands at %s%% against the planned progress of %s%%",
        ),
        Grammar(
            "compared",
            rf"(?i)(overall|engineering|procurement|construction|civil|electrical)\s+(?:project\s+|pre-civil\s+|construction\s+|work\s+)?progress\s+{N}\s*%\s+compared\s+to\s+plan\s+at\s+{N}\s*%",
            ("label", "actual", "plan"),
            "%s progress %s%% compared to plan at %s%%",
        ),
        Grammar(
            "summary",
            rf"(?i)(overall|construction|commissioning|civil|electrical|engineering|procurement)\s*progress\s*(?:is\s+)?{N}\s*%\s*(?:/\s*Plan\s*at|vs\s+plan|against\s+plan)\s*{N}\s*%",
            ("label", "actual", "plan"),
            "%s progress is %s%% vs plan %s%%",
        ),
        Grammar(
            "plan_then_actual",
            rf"(?i)(overall\s+project|construction)\s+progress\s*[\r\n]+\s*-\s*plan\s*=\s*{N}\s*%\s*[\r\n]+\s*-\s*actual\s*=\s*{N}\s*%",
            ("label", "plan", "actual"),
            "%s progress\n- Plan = %s%%\n- Actual = %s%%",
        ),
        Grammar(
            "actual_then_plan",
            rf"(?i)overall\s+progress\s+actual\s*=\s*{N}\s*%,?\s*[\r\n]+\s*-?\s*overall\s+progress\s+plan\s*=\s*{N}\s*%",
            ("actual", "plan"),
            "Overall progress actual = %s%%,\n- Overall progress plan = %s%%",
        ),
        Grammar(
            "newline_plan",
            rf"(?i)(overall|construction)\s+progress\s*\n?\s*(?:actual\s*)?{N}\s*%\s*\n\s*plan\s*{N}\s*%",
            ("label", "actual", "plan"),
            "%s progress\nActual %s %%\nPlan %s%%",
        ),
        Grammar("delta", rf"(?i)(construction|overall)\s+progress\s*=\s*{N}\s*%\s*(delayed|ahead)\s*{N}\s*%", ("label", "actual", "direction", "delta"), "%s progress = %s%% %s %s%%"),
        Grammar("inline", rf"(?i)progress\s*{N}\s*%\s*\(\s*plan\s*{N}\s*%", ("actual", "plan"), "Progress%s%%(Plan %s%%, 0%%)"),
        Grammar("signed_delta", rf"(?i)progress\s*{N}\s*%\s*\([^,]*,\s*(-?{PERCENT})\s*%\)", ("actual", "signed"), "Progress%s%%(Plan, %s%%)"),
        Grammar("table_row", rf"(?im)^(engineering|procurement|construction|commissioning|overall)\s+{N}\s*%\s+{N}\s*%", ("label", "plan", "actual"), "%s %s%% %s%%"),
        Grammar("pair", rf"(?i)plan/actual\s*[：:]\s*{N}%\s*/\s*{N}%", ("plan", "actual"), "Plan/Actual：%s%%/%s%%"),
        Grammar("cumulative_planned", r"(?im)cum\.?\s*progress\s*[-–]\s*planned[^\n]*?(\d{1,3}\.\d{2})%\s*$", ("plan",), "Cum. Progress - Planned 1.00%% %s%%"),
        Grammar("cumulative_actual", r"(?im)cum\.?\s*progress\s*[-–]\s*actual[^\n]*?(\d{1,3}\.\d{2})%\s*$", ("actual",), "Cum. Progress - Actual 1.00%% %s%%"),
        Grammar("physical", rf"(?i)physical\s+progress.*?{N}%.*?{N}%", ("plan", "actual"), "Physical Progress: Plan %s%% / Actual %s%%"),
        Grammar("drawn_planned", rf"(?i)(?:accumulative\s+)?planned\s+progress\s*(?:up\s+to[^=\n]*)?=\s*{N}\s*%", ("plan",), "Accumulative Planned Progress up to date = %s %%"),
        Grammar("drawn_actual", rf"(?i)(?:accumulative\s+)?achie?ved\s+progress\s*(?:up\s+to[^=\n]*)?=\s*{N}\s*%", ("actual",), "Accumulative Achived Progress up to date = %s %%"),
    )
}


#: Words of the wordings by which texts that cannot hold one are passed over.
HINTS = {
    "callout": "plan",
    "stands_at": "stands",
    "compared": "compared",
    "summary": "progress",
    "plan_then_actual": "progress",
    "actual_then_plan": "actual",
    "newline_plan": "progress",
    "delta": "progress",
    "inline": "progress",
    "signed_delta": "progress",
    "table_row": "%",
    "pair": "plan/actual",
    "cumulative_planned": "cum",
    "cumulative_actual": "cum",
    "physical": "physical",
    "drawn_planned": "progress",
    "drawn_actual": "progress",
}


NUMBERS = ("plan", "actual", "delta", "signed")


def rendered(g: Grammar, parts: dict[str, Column]) -> Column:
    """A statement of one wording with these parts (text, by group)."""
    given = iter(g.groups)
    piece = {"%s": lambda: parts[next(given)], "%%": lambda: F.lit("%")}
    return F.concat(*(piece[x]() if x in piece else F.lit(x) for x in re.split("(%s|%%)", g.wording) if x))


def _label(said: Column | None) -> Column:
    return F.lit("overall") if said is None else F.regexp_replace(F.lower(said), r"\s+project$", "")


def _derived(num: dict[str, Column], direction: Column | None) -> tuple[Column, Column]:
    """(plan, actual) from the numbers of a statement; figures outside 0 to 100 are null."""
    plan, actual = num.get("plan"), num.get("actual")
    if "delta" in num:
        plan = plan_from_delta(actual, direction, num["delta"])
    if "signed" in num:
        plan = plan_from_signed(actual, num["signed"])
    inside = lambda v: F.lit(None).cast("double") if v is None else F.when(v.between(0.0, 100.0), v)
    return inside(plan), inside(actual)


def statements(text: Column, g: Grammar, low: Column | None = None) -> Column:
    """All statements of one wording in a text: array of (grammar, match_no, label, plan, actual).

    The label is lower case, 'overall' where the wording has none; figures outside 0 to 100
    are null; what a wording derives (a plan from a delta) is derived here.  The text is gone
    through once; groups are read from the matches.  ``low`` is the text in lower case, if at hand.
    """
    found = F.regexp_extract_all(text, F.lit(g.pattern), F.lit(0))
    if g.name in HINTS:
        has = (F.lower(text) if low is None else low).contains(HINTS[g.name])
        found = F.when(has, found).otherwise(F.array().cast("array<string>"))

    def one(m: Column, i: Column) -> Column:
        s = {name: F.regexp_extract(m, g.pattern, k + 1) for k, name in enumerate(g.groups)}
        num = {k: s[k].cast("double") for k in NUMBERS if k in g.groups}
        plan, actual = _derived(num, s.get("direction"))
        return F.struct(F.lit(g.name).alias("grammar"), (i + 1).alias("match_no"), _label(s.get("label")).alias("label"), plan.alias("plan"), actual.alias("actual"))

    return F.transform(found, one)


def first_statements(df: DataFrame, keys: list[str], text: str, g: Grammar) -> DataFrame:
    """(…keys, plan, actual): of every text the figures of the first statement of one wording, as in
    ``statements``; null where there is none.

    Each step is a projection of its own, so that no group is matched and no number cast twice, and
    all of it is compiled.
    """
    group = lambda name: F.regexp_extract(text, g.pattern, g.groups.index(name) + 1)
    numbers = [k for k in NUMBERS if k in g.groups]
    said = [group("direction").alias("_direction")] if "direction" in g.groups else []
    read = df.select(*keys, *(group(k).try_cast("double").alias(f"_{k}") for k in numbers), *said)
    plan, actual = _derived({k: F.col(f"_{k}") for k in numbers}, F.col("_direction"))
    return read.select(*keys, plan.alias("plan"), actual.alias("actual"))


def read_statements(df: DataFrame, keys: list[str], text: str, grammars: tuple[str, ...]) -> DataFrame:
    """(…keys, grammar_no, grammar, match_no, label, plan, actual): every statement in every text,
    grammars in the given order.  Null texts have none."""

    def ranked(k: int):
        return lambda s: s.withField("grammar_no", F.lit(k))

    low = F.col("_low")
    each = F.concat(*(F.transform(statements(F.col(text), GRAMMARS[name], low), ranked(k)) for k, name in enumerate(grammars)))
    return df.where(F.col(text).isNotNull()).withColumn("_low", F.lower(text)).select(*keys, F.explode(each).alias("s")).select(
        *keys, "s.grammar_no", "s.grammar", "s.match_no", "s.label", "s.plan", "s.actual"
    )


def winning(found: DataFrame, keys: list[str], last: bool = True) -> DataFrame:
    """One statement per keys and label: the last (or first) by grammar, then position."""
    order = F.struct("grammar_no", "match_no")
    pick = F.max_by if last else F.min_by
    return found.groupBy(*keys, "label").agg(pick(F.struct("grammar", "plan", "actual"), order).alias("s")).select(*keys, "label", "s.grammar", "s.plan", "s.actual")


def overall_or(found: DataFrame, keys: list[str], stand_in: str = "construction") -> DataFrame:
    """(…keys, plan, actual): the overall figures, or the stand-in's where there are none."""
    of = lambda f, label: F.max(F.when(F.col("label") == label, F.col(f)))
    return found.groupBy(*keys).agg(*(F.coalesce(of(f, "overall"), of(f, stand_in)).alias(f) for f in ("plan", "actual")))
