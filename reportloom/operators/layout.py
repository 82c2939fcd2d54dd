"""Words and characters with positions: visual lines, bands, fields.

Greedy clustering with a tolerance is sequential within a page, so it runs in Python per page;
a page holds a bounded number of words.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportloom.functions.numeric import consistent, is_number, parse_pct

LINE_TOLERANCE = 3.0
BAND_TOLERANCE = 4.0
SLACK = 1.2


def _anchors(tops: list[float], tolerance: float) -> list[float]:
    """The anchor of each top, in the given order: the first opened within the tolerance, else its own."""
    opened: list[float] = []
    out = []
    for t in tops:
        a = next((o for o in opened if abs(o - t) <= tolerance), None)
        if a is None:
            opened.append(t)
            a = t
        out.append(a)
    return out


def _clustered(df: DataFrame, by: list[str], tolerance: float) -> DataFrame:
    """``df`` (doc_id, page_no, text, x0, x1, top) with ``anchor``, the top of its line."""

    def run(page: pd.DataFrame) -> pd.DataFrame:
        page = page.sort_values(by, kind="stable").reset_index(drop=True)
        return page.assign(anchor=_anchors(page["top"].tolist(), tolerance))

    src = df.select("doc_id", "page_no", "text", "x0", "x1", "top")
    return src.groupBy("doc_id", "page_no").applyInPandas(run, "doc_id bigint, page_no int, text string, x0 double, x1 double, top double, anchor double")


def page_lines(words: DataFrame, min_x0: float | None = None) -> DataFrame:
    """(doc_id, page_no, top, x0, text): visual lines top to bottom, words left to right.  ``min_x0``
    drops words, not lines, left of a column."""
    if min_x0 is not None:
        words = words.where(F.col("x0") >= min_x0)
    c = _clustered(words, ["top", "x0"], LINE_TOLERANCE)
    g = c.groupBy("doc_id", "page_no", F.col("anchor").alias("top")).agg(F.array_sort(F.collect_list(F.struct("x0", "text"))).alias("w"))
    return g.select("doc_id", "page_no", "top", F.col("w")[0]["x0"].alias("x0"), F.array_join(F.transform("w", lambda x: x["text"]), " ").alias("text"))


def column_from(words: DataFrame, anchor: str, pages: int = 8, slack: float = 10.0) -> DataFrame:
    """Visual lines of the column that begins where a line matching ``anchor`` begins, on the first
    such page of each document among its first ``pages``."""
    all_lines = page_lines(words.where(F.col("page_no") <= pages))
    hit = all_lines.where(F.col("text").rlike(anchor))
    first = hit.groupBy("doc_id").agg(F.min(F.struct("page_no", "top", "x0")).alias("a")).select("doc_id", F.col("a.page_no").alias("page_no"), (F.col("a.x0") - slack).alias("_x"))
    return page_lines(words.join(first, ["doc_id", "page_no"]).where("x0 >= _x").drop("_x"))


def right_column(words: DataFrame, widths: DataFrame, share: float = 0.45) -> DataFrame:
    """Visual lines of the words right of ``share`` of the page width (doc_id, page_no, width)."""
    return page_lines(words.join(widths, ["doc_id", "page_no"]).where(F.col("x0") >= F.col("width") * share).drop("width"))


def bands(chars: DataFrame) -> DataFrame:
    """Characters with ``anchor``, the top of their visual row."""
    return _clustered(chars, ["top"], BAND_TOLERANCE)


def fields(banded: DataFrame) -> DataFrame:
    """(doc_id, page_no, anchor, field_no, field): characters of a row split where the gap exceeds the
    row's upper-median gap by SLACK."""
    row = Window.partitionBy("doc_id", "page_no", "anchor")
    w = row.orderBy("x0")
    g = banded.withColumn("_gap", F.col("x0") - F.lag("x1").over(w))
    gaps = F.array_sort(F.filter(F.collect_list("_gap").over(row), lambda x: x.isNotNull()))
    g = g.withColumn("_gaps", gaps)
    median = F.coalesce(F.get("_gaps", (F.size("_gaps") / 2).cast("int")), F.lit(0.0))
    g = g.withColumn("_new", F.coalesce((F.col("_gap") > median + SLACK).cast("int"), F.lit(0)))
    g = g.withColumn("field_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    f = g.groupBy("doc_id", "page_no", "anchor", "field_no").agg(F.array_sort(F.collect_list(F.struct("x0", "text"))).alias("c"))
    return f.select("doc_id", "page_no", "anchor", "field_no", F.trim(F.array_join(F.transform("c", lambda x: x["text"]), "")).alias("field"))


# The letter-spaced heading of an area table, and how far its columns reach left of it.
MATRIX_HEAD = r"(?i)A\s*r\s*e\s*a\s+D\s*i\s*s\s*c"
HEAD_SLACK, HEAD_HEIGHT = 20.0, 2.0


def below_heading(chars: DataFrame, words: DataFrame, heading: str = MATRIX_HEAD) -> DataFrame:
    """The characters below, and not left of, the first visual line of their page that matches; pages
    without such a line have none."""
    hit = page_lines(words).where(F.col("text").rlike(heading))
    head = hit.groupBy("doc_id", "page_no").agg(F.min(F.struct("top", "x0")).alias("h")).select("doc_id", "page_no", F.col("h.top").alias("_top"), F.col("h.x0").alias("_x"))
    j = chars.join(head, ["doc_id", "page_no"])
    return j.where((F.col("x0") >= F.col("_x") - HEAD_SLACK) & (F.col("top") > F.col("_top") + HEAD_HEIGHT)).drop("_top", "_x")


def matrix(chars: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(doc_id, page_no, discipline, weight, plan, actual): rows of a letter-spaced table that name a
    discipline and hold four figures whose variance agrees; the last row of a discipline wins.  With
    ``words`` only what stands below the table's heading is read."""
    f = fields(bands(chars if words is None else below_heading(chars, words)))
    n = is_number(F.col("field"))
    r = f.groupBy("doc_id", "page_no", "anchor").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~n, F.struct("field_no", "field")))), lambda x: x["field"]), " ").alias("label"),
        F.transform(F.array_sort(F.collect_list(F.when(n, F.struct("field_no", parse_pct(F.col("field")).alias("v"))))), lambda x: x["v"]).alias("v"),
    )
    name = F.regexp_extract("label", "(?i)(engineering|procurement|construction|commissioning|overall)", 1)
    r = r.withColumn("v", F.filter("v", lambda x: x.isNotNull())).where((name != "") & (F.size("v") >= 4))
    at = lambda k: F.get("v", F.lit(k))
    r = r.where(consistent(at(1), at(2), at(3))).select("doc_id", "page_no", "anchor", F.initcap(name).alias("discipline"), at(0).alias("weight"), at(1).alias("plan"), at(2).alias("actual"))
    return r.groupBy("doc_id", "page_no", "discipline").agg(F.max_by(F.struct("weight", "plan", "actual"), "anchor").alias("s")).select("doc_id", "page_no", "discipline", "s.*")
