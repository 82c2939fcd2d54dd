"""Concerns and activities by report family, from pages (doc_id, page_no, text) and visual lines.

Readers give (doc_id, ord, item), first-seen items in page and line order, at most CAP of them;
readers whose emptiness means something also say which documents had the section.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportloom.functions.text import is_empty_cell, prefixed, strip
from reportloom.operators import lines

CAP = 20
# Wordings that open and close sections and fields.
CONCERN = r"(?i)concern|area of concern|issue|delay"
ACTIVITY = r"(?i)next period|next week|planned activity|activity plan|upcoming"
DELAY_PAGE = r"(?i)concern ?\(delay\)"
CONTENTS = r"(?i)table of content"
NEXT_FIELD = (
    r"(?i)^(key\s+\w+|catch\s*[- ]?up|pre-?conditions|area\s+of\s+concern|issue\s+to\s+request|progress\b|construction\b|commissioning\b"
    r"|total\s+progress|manpower|organization|milestone\s+tracking)"
)
CONCERN_FIELD, CONCERN_FIELD_END = r"(?i)area\s+of\s+concern\s*:?", (
    r"(?i)^(key\s+\w+|catch\s*[- ]?up|pre-?conditions|progress\b|construction\b|commissioning\b|total\s+progress|manpower|organization|milestone)"
)
LOOK_AHEAD = r"(?i)key\s+look\s*-?\s*ahead(?:\s+milestones?)?\s*:?"
FIELD_NOISE = r"(?i)^(\(?accumulative\)?|trir\b.*|total\s+man-?hours.*|n/?a\.?|none\.?|[\d,.\s%]+)$"
SUPPORT_LABEL = r"(?i)issue\s+to\s+request\s+ho\s+support\s*:?.*$"
CROSS_REFERENCE = r"(?i)^(refer|ref\.?)\s*(to\s*)?page\s*\d+"
ITEM_START = r"^(?:\d+[.)]|[-–•▪])\s*"
UNITS = r"(m3|m2|m³|m²|m|Item|Pcs|No|set|t)"
PLANNED_ROW = rf"(?i)^(?:\d+(?:\.\d+)*\s+)?(\S.*?)\s+{UNITS}\s+([\d,.]+)\s+([\d,.]+)\s+([\d,.]+)\s+([\d,.]+)\s*%$"
WORK_ROW = rf"(?i)^(\d+(?:\.\d+)+)\s+(\S.*?)\s+{UNITS}\s+([\d,.]+)\s+([\d,.]+)\s+([\d,.]+)$"
WORK_GROUP = r"^(\d+)\s+(\D[^\d]{3,})$"


def _paged(pages: DataFrame, where: Column | None = None) -> DataFrame:
    """Lines keyed by page, so that line operators see one page at a time."""
    p = pages if where is None else pages.where(where)
    return p.where("text is not null").select(F.struct("doc_id", "page_no").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _listed(items: DataFrame, longer_than: int = 10, cap: int = CAP) -> DataFrame:
    """Items of pages as first-seen items of their documents."""
    flat = items.select(F.col("doc_id.doc_id").alias("doc_id"), F.struct(F.col("doc_id.page_no").alias("page_no"), F.col("line_no")).alias("line_no"), "item")
    return lines.first_seen(flat, cap, longer_than)


def generic_concerns(pages: DataFrame) -> DataFrame:
    """Sections under a concern header, on pages without a percentage; delay pages by their own header.
    Contents pages are passed over."""
    t = F.col("text")
    delay = t.rlike(DELAY_PAGE)
    plain = lines.section(_paged(pages, ~t.rlike(CONTENTS) & ~delay & t.rlike(CONCERN) & ~t.contains("%")), CONCERN, ACTIVITY)
    own = lines.section(_paged(pages, ~t.rlike(CONTENTS) & delay), r"(?i)concern.*delay", "(?i)^action")
    return _listed(plain.unionByName(own).withColumnRenamed("line", "item"))


def generic_activities(pages: DataFrame) -> DataFrame:
    """Sections under a header for the coming period."""
    t = F.col("text")
    return _listed(lines.section(_paged(pages, ~t.rlike(CONTENTS) & t.rlike(ACTIVITY)), ACTIVITY).withColumnRenamed("line", "item"))


def headed_concerns(pages: DataFrame, title: str, item: str, noise: str, close: str) -> tuple[DataFrame, DataFrame]:
    """(items, documents that have the section): 'heading — body' items of pages with a title."""
    on = F.col("text").rlike(title)
    src = _paged(pages, on).where(~strip(F.col("line")).rlike(title))
    got = lines.heading_items(src, item, noise, close).withColumn("line_no", F.col("ord"))
    return _listed(got), pages.where(on).select("doc_id").distinct()


def headed_activities(pages: DataFrame, title: str, sub: str, bullet: str = r"^[•▪·]\s*(\S.*)$") -> DataFrame:
    """Bullets of pages whose title names an area (group 1), as '[area] sub-heading: bullet'; a
    sub-heading holds until the next on its page."""
    on = pages.where(F.col("text").rlike(title)).withColumn("area", strip(F.regexp_extract("text", title, 1)))
    src = on.select(F.struct("doc_id", "page_no").alias("doc_id"), "area", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("line", strip(F.col("line")))
    heading = F.when(F.col("line").rlike(sub) & ~F.col("line").rlike(title) & ~F.col("line").rlike(bullet), strip(F.regexp_extract("line", sub, 1)))
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    src = src.withColumn("sub", F.last(heading, ignorenulls=True).over(w)).where(F.col("line").rlike(bullet))
    return _listed(src.select("doc_id", "line_no", prefixed(F.col("area"), F.col("sub"), strip(F.regexp_extract("line", bullet, 1))).alias("item")))


def numbered_concerns(pages: DataFrame, title: str, folded: bool = True) -> DataFrame:
    """Numbered items of pages with a title: whole items of more than ten characters, or only their
    first lines of more than five.  'None' says nothing."""
    src = _paged(pages, F.col("text").rlike(title)).where("line_no > 0").withColumn("line", strip(F.col("line")))
    src = src.where((F.col("line") != "") & ~F.col("line").rlike(r"^\d+\s*$") & ~F.upper("line").isin("NONE", "N/A", "NA"))
    if not folded:
        return _listed(lines.first_lines(src), longer_than=5)
    return _listed(lines.folded(src, lines.NUMBER_START).withColumn("line_no", F.col("item_no")))


def planned_rows(pages: DataFrame, title: str) -> DataFrame:
    """Rows of description, unit, three quantities and a share, where the share is above zero, as
    'description — planned unit (share%)'; a share that is no number drops the row."""
    src = _paged(pages, F.col("text").rlike(title)).withColumn("line", strip(F.col("line"))).where(F.col("line").rlike(PLANNED_ROW))
    part = lambda g: F.regexp_extract("line", PLANNED_ROW, g)
    share = F.replace(part(6), F.lit(",")).try_cast("double")
    item = F.concat(strip(part(1)), F.lit(" — "), part(5), F.lit(" "), part(2), F.lit(" ("), part(6), F.lit("%)"))
    return _listed(src.where(share > 0).select("doc_id", "line_no", item.alias("item")))


def work_rows(pages: DataFrame, title: str, but_not: str) -> DataFrame:
    """Rows of dotted number, description, unit and three quantities, as '[group] description — planned
    unit'; the group is the latest group line of the page.  Rows that plan zero are dropped, those
    whose quantity is no number kept."""
    on = F.col("text").rlike(title) & ~F.col("text").rlike(but_not)
    src = _paged(pages, on).withColumn("line", strip(F.col("line")))
    row = F.col("line").rlike(WORK_ROW)
    group = F.when(~row & F.col("line").rlike(WORK_GROUP), strip(F.regexp_extract("line", WORK_GROUP, 2)))
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    src = src.withColumn("group", F.last(group, ignorenulls=True).over(w)).where(row)
    part = lambda g: F.regexp_extract("line", WORK_ROW, g)
    planned = F.replace(part(5), F.lit(",")).try_cast("double")
    item = prefixed(F.col("group"), F.lit(None).cast("string"), F.concat(strip(part(2)), F.lit(" — "), part(5), F.lit(" "), part(3)))
    return _listed(src.where(planned.isNull() | (planned > 0)).select("doc_id", "line_no", item.alias("item")))


def field(column: DataFrame, anchor: str, stop: str, start: str = ITEM_START, strip_support: bool = False, least_head: int = 0) -> DataFrame:
    """(doc_id, found, cross_reference, items) of the field that a line matching ``anchor`` opens in the
    visual lines (doc_id, page_no, top, x0, text) of its column.

    What follows the anchor on its own line is the first item if it is long enough and no other
    field's name.  Lines are folded into items until one matches ``stop``; noise is passed over; a
    pointer to another page is no item but sets the flag.
    """
    text = strip(F.regexp_replace("text", SUPPORT_LABEL, "")) if strip_support else strip(F.col("text"))
    w = Window.partitionBy("doc_id").orderBy("page_no", "top")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    a = column.withColumn("line_no", F.row_number().over(w)).withColumn("_is", F.col("text").rlike(anchor))
    a = a.withColumn("_at", F.min(F.when(F.col("_is"), F.col("line_no"))).over(Window.partitionBy("doc_id"))).where("line_no >= _at")
    head = F.regexp_replace(F.regexp_extract("text", f"(?:{anchor})(.*)$", 1), SUPPORT_LABEL, "")
    head = F.regexp_replace(F.regexp_replace(head, r"^[\s:]+|[\s:]+$", ""), r"(?i)^(trir|tri)\s*[\d.]*\s*", "")
    a = a.withColumn("line", F.when(F.col("line_no") == F.col("_at"), head).otherwise(text))
    first = F.col("line_no") == F.col("_at")
    a = a.withColumn("_ref", F.col("line").rlike(CROSS_REFERENCE))
    bare = strip(F.regexp_replace("line", start, ""))
    unfit = first & ((bare == "") | (F.length(bare) < least_head) | bare.rlike(NEXT_FIELD))
    drop = (F.col("line") == "") | F.col("line").rlike(FIELD_NOISE) | unfit
    a = a.withColumn("_stop", ~first & ~drop & ~F.col("_ref") & F.col("line").rlike(stop)).withColumn("_over", F.max("_stop").over(so_far)).where("not _over")
    # the head is an item of its own: what follows opens the next
    lead = F.when(first, F.concat(F.lit("- "), bare)).otherwise(F.col("line"))
    kept = a.where(~drop & ~F.col("_ref")).select("doc_id", "line_no", "_at", lead.alias("line"))
    after = F.lag("line_no").over(Window.partitionBy("doc_id").orderBy("line_no")) == F.col("_at")
    kept = kept.withColumn("line", F.when(F.coalesce(after, F.lit(False)) & ~F.col("line").rlike(start), F.concat(F.lit("- "), F.col("line"))).otherwise(F.col("line")))
    items = lines.folded(kept.select("doc_id", "line_no", "line"), start).where(~is_empty_cell(F.col("item")))
    listed = items.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("item_no", "item"))).alias("p")).select("doc_id", F.transform("p", lambda x: x["item"]).alias("items"))
    flags = a.groupBy("doc_id").agg(F.max("_ref").alias("cross_reference"))
    none = F.array().cast("array<string>")
    return flags.join(listed, "doc_id", "left").select("doc_id", F.lit(True).alias("found"), "cross_reference", F.coalesce("items", none).alias("items"))


def followed(fields: DataFrame, section: DataFrame) -> DataFrame:
    """(doc_id, items): a field that only points elsewhere takes the items (doc_id, ord, item) of the section."""
    s = section.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("ord", "item"))).alias("p")).select("doc_id", F.transform("p", lambda x: x["item"]).alias("_s"))
    refer = F.col("cross_reference") & (F.size("items") == 0)
    return fields.join(s, "doc_id", "left").select("doc_id", F.when(refer, F.coalesce("_s", F.array().cast("array<string>"))).otherwise(F.col("items")).alias("items"))


def header_items(paired: DataFrame) -> DataFrame:
    """(doc_id, ord, item): cells (doc_id, col_no, header, value) of a summary row folded to items,
    '[header] item'; a column headed 'topic' and empty markers are left out."""
    p = paired.where(F.lower(strip(F.col("header"))) != "topic")
    src = p.select(F.struct("doc_id", "col_no", "header").alias("doc_id"), F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    items = lines.folded(src, "^[•▪□❑❏➢○◦*-]\\s*").where(~is_empty_cell(F.col("item")))
    w = Window.partitionBy("doc").orderBy("col_no", "item_no")
    flat = items.select(F.col("doc_id.doc_id").alias("doc"), F.col("doc_id.col_no").alias("col_no"), "item_no", prefixed(F.col("doc_id.header"), F.lit(None).cast("string"), F.col("item")).alias("item"))
    return flat.withColumn("ord", F.row_number().over(w)).select(F.col("doc").alias("doc_id"), "ord", "item")


def summarised(results: DataFrame) -> DataFrame:
    """Results (project_id, year, week, found, plan, actual, disciplines, scopes, concerns, activities) as
    history rows; an absent container counts zero, results without a report are left out."""
    n = lambda c: F.greatest(F.size(F.col(c)), F.lit(0)).cast("int")
    size = {"n_disc": "disciplines", "n_scopes": "scopes", "n_concerns": "concerns", "n_activities": "activities"}
    return results.where("found").select("project_id", "year", "week", "plan", "actual", *(F.coalesce(n(c), F.lit(0)).alias(k) for k, c in size.items()))


def first_keyword(header: Column, scopes: dict[str, str]) -> Column:
    """The scope of the first keyword, in the order of the dictionary, that a header contains."""
    out = F.lit(None).cast("string")
    for key, scope in reversed(scopes.items()):
        out = F.when(F.lower(header).contains(key), scope).otherwise(out)
    return out


def defaulted(df: DataFrame) -> DataFrame:
    """Sheet rows with blank ids and names filled: 'ROW-<row_no>' and 'Unnamed'."""
    fill = lambda c, d: F.when(F.coalesce(strip(F.col(c)), F.lit("")) == "", d).otherwise(strip(F.col(c)))
    return df.withColumns({"id": fill("id", F.concat(F.lit("ROW-"), F.col("row_no").cast("string"))), "name": fill("name", F.lit("Unnamed"))})
