"""Lines of documents: sections, items and headings as window operators.

Every operator takes lines (doc_id, line_no, line, …) and orders by line_no within doc_id.
Windows see one document at a time; a null text has no line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportloom.functions.text import clean_line, strip

# Bullets and numbers that open an item.
ITEM_START = r"^(?:\d+[.)]|[-–•▪*☐✔])\s*"
NUMBER_START = r"^\d+[.)]\s*"
CJK = "[　-鿿＀-￯]"
LEAD_LENGTH = 220
ITEM_CAP = 20
SECTION_CAP = 30


def lines(documents: DataFrame, *extra: str) -> DataFrame:
    """(doc_id, …extra, line_no, line), line_no from 0."""
    return documents.where("text is not null").select("doc_id", *extra, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _order() -> Window:
    return Window.partitionBy("doc_id").orderBy("line_no")


def _upto(w: Window, last: int = 0) -> Window:
    return w.rowsBetween(Window.unboundedPreceding, last)


def cleaned(src: DataFrame) -> DataFrame:
    """The lines that survive cleaning, cleaned."""
    return src.withColumn("line", clean_line(F.col("line"))).where("line is not null")


def section(src: DataFrame, header: str, stop: str | None = None, cap: int = SECTION_CAP) -> DataFrame:
    """The cleaned lines after the first line matching ``header``: up to a stop line, three blank
    lines in a row, or ``cap`` kept lines (counted before cleaning).  Later header lines are
    content."""
    w = _order()
    s = src.withColumn("_in", F.coalesce(F.max(F.col("line").rlike(header)).over(_upto(w, -1)), F.lit(False))).where("_in")
    blank = strip(F.col("line")) == ""
    s = s.withColumn("_blank", blank)
    three = F.col("_blank") & F.coalesce(F.lag("_blank", 1).over(w), F.lit(False)) & F.coalesce(F.lag("_blank", 2).over(w), F.lit(False))
    ends = three | (F.col("line").rlike(stop) if stop else F.lit(False))
    s = s.withColumn("_ends", ends).withColumn("_over", F.max("_ends").over(_upto(w))).where("not _over and not _blank")
    s = s.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= cap)
    return cleaned(s.drop("_in", "_blank", "_ends", "_over", "_n"))


def folded(src: DataFrame, start: str = ITEM_START, noise: str | None = None) -> DataFrame:
    """(doc_id, item_no, item): a line that opens an item starts one, others are appended to it;
    text before the first such line is an item too.  Blank and noise lines are left out."""
    s = src.withColumn("line", strip(F.col("line"))).where("line <> ''")
    if noise:
        s = s.where(~F.col("line").rlike(noise))
    s = s.withColumn("_start", F.col("line").rlike(start))
    s = s.withColumn("item_no", F.sum(F.col("_start").cast("int")).over(_upto(_order())))
    part = F.when(F.col("_start"), strip(F.regexp_replace("line", start, ""))).otherwise(F.col("line"))
    parts = s.groupBy("doc_id", "item_no").agg(F.array_sort(F.collect_list(F.struct("line_no", part.alias("t")))).alias("p"))
    items = parts.select("doc_id", F.col("item_no").cast("int").alias("item_no"), F.array_join(F.transform("p", lambda x: x["t"]), " ").alias("item"))
    return items.where("item <> ''")


def first_lines(src: DataFrame, start: str = NUMBER_START, longer_than: int = 5) -> DataFrame:
    """(doc_id, line_no, item): only the first line of each numbered item, without its number."""
    s = src.withColumn("line", strip(F.col("line")))
    item = strip(F.regexp_replace("line", start, ""))
    return s.where(F.col("line").rlike(start)).select("doc_id", "line_no", item.alias("item")).where(F.length("item") > longer_than)


def with_heading(src: DataFrame, heading: str, group: int = 1) -> DataFrame:
    """The lines that are no headings, with the latest heading above (null before the first)."""
    h = F.when(F.col("line").rlike(heading), F.regexp_extract("line", heading, group))
    s = src.withColumn("_h", h).withColumn("heading", F.last("_h", ignorenulls=True).over(_upto(_order())))
    return s.where("_h is null").drop("_h")


def heading_items(src: DataFrame, item: str, noise: str | None = None, close: str | None = None, cap: int = ITEM_CAP) -> DataFrame:
    """(doc_id, ord, item): 'heading — body'.  A line matching ``item`` opens one; its body is the
    plain lines before the first dash line, as long as fewer than LEAD_LENGTH characters were
    taken, else that dash line.  Noise, closing, CJK and letterless lines are passed over; an
    item is listed once, if longer than ten characters, at most ``cap`` a document."""
    w = _order()
    s = src.withColumn("line", strip(F.col("line")))
    s = s.withColumn("_open", F.col("line").rlike(item))
    s = s.withColumn("_k", F.sum(F.col("_open").cast("int")).over(_upto(w))).where("_k > 0")
    plain = (F.col("line") != "") & ~F.col("line").rlike(CJK) & F.col("line").rlike("[A-Za-z]{3}")
    for p in (noise, close):
        if p:
            plain = plain & ~F.col("line").rlike(p)
    s = s.where(F.col("_open") | plain)
    own = Window.partitionBy("doc_id", "_k").orderBy("line_no")
    s = s.withColumn("_dash", ~F.col("_open") & F.col("line").rlike("^[-–•‑]"))
    s = s.withColumn("_seen", F.coalesce(F.max("_dash").over(_upto(own)), F.lit(False)))
    s = s.withColumn("_lead", ~F.col("_open") & ~F.col("_seen"))
    s = s.withColumn("_had", F.coalesce(F.sum(F.when(F.col("_lead"), F.length("line"))).over(_upto(own, -1)), F.lit(0)))
    take = F.when(F.col("_lead") & (F.col("_had") < LEAD_LENGTH), F.struct("line_no", "line"))
    dash = F.when(F.col("_dash"), strip(F.regexp_replace("line", "^[-–• ]+", "")))
    g = s.groupBy("doc_id", "_k").agg(
        F.min("line_no").alias("line_no"),
        F.max(F.when(F.col("_open"), strip(F.regexp_extract("line", item, 1)))).alias("h"),
        F.array_join(F.transform(F.array_sort(F.collect_list(take)), lambda x: x["line"]), " ").alias("lead"),
        F.min_by(dash, F.when(F.col("_dash"), F.col("line_no"))).alias("dash"),
    )
    body = F.when(F.col("lead") != "", F.col("lead")).otherwise(F.coalesce("dash", F.lit("")))
    text = F.when(body != "", F.concat("h", F.lit(" — "), body)).otherwise(F.col("h"))
    return first_seen(g.where("h <> ''").select("doc_id", "line_no", text.alias("item")), cap=cap)


def first_seen(items: DataFrame, cap: int = ITEM_CAP, longer_than: int = 10) -> DataFrame:
    """(doc_id, ord, item): distinct items in the order first seen, longer than ten characters, at
    most ``cap`` a document."""
    once = items.where(F.length("item") > longer_than).groupBy("doc_id", "item").agg(F.min("line_no").alias("_at"))
    w = Window.partitionBy("doc_id").orderBy("_at")
    return once.withColumn("ord", F.row_number().over(w)).where(F.col("ord") <= cap).select("doc_id", "ord", "item")


def from_marker(text: Column, marker: str) -> Column:
    """The text from the first match of ``marker`` on; the whole text where there is none."""
    at = F.regexp_instr(text, F.lit(marker))
    return F.when(at > 0, F.substring(text, at, F.length(text))).otherwise(text)


def joined(src: DataFrame, sep: str = "\n") -> DataFrame:
    """(doc_id, text): the lines of each document joined in order."""
    g = src.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("p"))
    return g.select("doc_id", F.array_join(F.transform("p", lambda x: x["line"]), sep).alias("text"))
