"""Page tables in long form (doc_id, row_no, col_no, cell), and joins between their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportloom.functions.numeric import four_or_two, parse_pct
from reportloom.functions.text import collapse, is_empty_cell, multi_column


def grid(documents: DataFrame, sep: str = "\t") -> DataFrame:
    """(doc_id, row_no, cells): lines with separators as rows of cells."""
    rows = documents.where("text is not null").select("doc_id", F.posexplode(F.split("text", r"\r?\n")).alias("row_no", "line"))
    return rows.where(F.col("line").contains(sep)).select("doc_id", "row_no", F.split("line", sep).alias("cells"))


def cells(rows: DataFrame) -> DataFrame:
    """Rows in long form, col_no from 0."""
    return rows.select("doc_id", "row_no", F.posexplode("cells").alias("col_no", "cell"))


def header_by_target(rows: DataFrame, header: str, target: str) -> DataFrame:
    """(doc_id, col_no, header, value): of each table the first multi-column row matching ``header``
    and the last one matching ``target``, paired by column; empty headers and cells are left out.

    Patterns are matched against the row's cells joined by blanks, in lower case.
    """
    r = rows.where(multi_column(F.col("cells"))).withColumn("_joined", F.lower(F.array_join("cells", " ")))
    pick = r.groupBy("doc_id").agg(
        F.min(F.when(F.col("_joined").rlike(header), F.col("row_no"))).alias("_h"),
        F.max(F.when(F.col("_joined").rlike(target), F.col("row_no"))).alias("_t"),
    )
    long = r.join(pick.where("_h is not null and _t is not null"), "doc_id")
    # both rows are in the same group, so one aggregate pairs them by column
    two = long.where("row_no = _h or row_no = _t").select("doc_id", "_h", "_t", "row_no", F.posexplode("cells").alias("col_no", "cell"))
    paired = two.groupBy("doc_id", "col_no").agg(
        F.max(F.when(F.col("row_no") == F.col("_h"), F.col("cell"))).alias("h"),
        F.max(F.when(F.col("row_no") == F.col("_t"), F.col("cell"))).alias("value"),
    )
    paired = paired.where("h is not null and h <> '' and value is not null and value <> ''")
    return paired.where(~is_empty_cell(F.col("value"))).select("doc_id", "col_no", collapse(F.col("h")).alias("header"), "value")


def labelled_pairs(rows: DataFrame) -> DataFrame:
    """(doc_id, label, plan, actual): of rows whose first cell is a label with two or more figures in
    range, by the four-or-two rule; the last row of a label wins."""
    figures = F.filter(F.transform(F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(0))), parse_pct), lambda v: v.isNotNull())
    r = rows.withColumn("_p", four_or_two(figures)).where("_p is not null")
    r = r.withColumn("label", F.lower(collapse(F.get("cells", F.lit(0)))))
    w = Window.partitionBy("doc_id", "label").orderBy(F.desc("row_no"))
    return r.where("label <> ''").withColumn("_r", F.row_number().over(w)).where("_r = 1").select("doc_id", "label", "_p.plan", "_p.actual")
