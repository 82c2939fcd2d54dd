"""Lines of report text as column expressions: cleaning, classifying, normalising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\p{Z}]"
# Lines that are page furniture.
SKIP_LINE = r"(?i)^(action|table of content|page|note:|concern to achieve|next milestone)"
# Fixed value: numbered-type bullets (a dash without '.' or ')' stays).
NUMBERED_BULLET = r"^[\-•*\d]+[.)]\s*"
# Words that label columns of progress tables.
COLUMN_LABELS = (
    r"(?i)\b(description|remark|status|root cause|doc no|issue date|plan|actual|total|accum|discipline|week|target|action by)\b"
)
SECTION_HEADING = r"^\d+(?:\.\d+)+\s+\S"
MILESTONE_ROW = r"^\d+\s+[A-Z]{3}\s*\["
NO_LETTERS = r"^[^\p{L}\p{No}\p{Nl}_]+$"
NUMBER_TOKEN = r"^[\d.,%()+\-]+$"
# What stands in a cell with nothing to say.
EMPTY_CELL = ("N/A", "NA", "N.A", "-", "NONE")
# What a sheet says for true.
TRUE_WORDS = ("true", "yes", "1", "found", "✓", "ok", "x")


def strip(s: Column) -> Column:
    """Without blanks of any kind at either end."""
    return F.regexp_replace(s, f"^{SPACE}+|{SPACE}+$", "")


def clean_line(line: Column) -> Column:
    """The line without its numbered bullet, or null where it is empty, a page number, page
    furniture or shorter than eight characters."""
    s = strip(line)
    bare = strip(F.regexp_replace(s, NUMBERED_BULLET, ""))
    keep = (s != "") & ~s.rlike(r"^\d+\s*$") & ~s.rlike(SKIP_LINE) & (F.length(s) >= 8) & (bare != "")
    return F.when(keep, bare)


def tokens(s: Column) -> Column:
    return F.filter(F.split(s, f"{SPACE}+"), lambda t: t != "")


def numeric_dominant(s: Column) -> Column:
    """Four or more tokens of which three, and at least half, are figures."""
    t = tokens(s)
    nums = F.size(F.filter(t, lambda x: x.rlike(NUMBER_TOKEN)))
    return F.coalesce((F.size(t) >= 4) & (nums >= 3) & (nums * 2 >= F.size(t)), F.lit(False))


def looks_like_table(line: Column) -> Column:
    """A table header, numbered heading, milestone row or row of figures rather than prose;
    null and blank lines count as such."""
    s = strip(F.coalesce(line, F.lit("")))
    labels = F.regexp_count(s, F.lit(COLUMN_LABELS))
    return (
        (s == "")
        | s.rlike(SECTION_HEADING)
        | s.rlike(MILESTONE_ROW)
        | s.rlike(NO_LETTERS)
        | numeric_dominant(s)
        | (labels >= 3)
        | ((labels >= 2) & (F.size(tokens(s)) <= 6))
    )


def is_empty_cell(s: Column) -> Column:
    """Nothing but an empty marker, a trailing bare page number aside."""
    return F.coalesce(F.upper(strip(F.regexp_replace(s, r"\s*\d+\s*$", ""))).isin("", *EMPTY_CELL), F.lit(True))


def multi_column(cells: Column, least: int = 3) -> Column:
    """At least three cells that hold something."""
    return F.size(F.filter(cells, lambda c: c.isNotNull() & (c != ""))) >= least


def collapse(s: Column) -> Column:
    """Runs of blanks as one, none at the ends."""
    return strip(F.regexp_replace(s, f"{SPACE}+", " "))


def norm_key(name: Column) -> Column:
    """Lower case, a-z and 0-9 only."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def split_items(v: Column) -> Column:
    """Items of a cell, separated by line ends or semicolons; an empty marker gives none."""
    items = F.filter(F.transform(F.split(v, r"[\n;]+"), strip), lambda x: x != "")
    none = F.array().cast("array<string>")
    return F.when(v.isNull() | F.lower(strip(v)).isin("", "-", "n/a", "none"), none).otherwise(items)


def truthy(v: Column) -> Column:
    return F.coalesce(F.lower(strip(v.cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def escaped(s: Column) -> Column:
    """For a single-quoted literal: backslash and quote escaped, line ends as blanks."""
    out = F.replace(F.coalesce(s, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("'"), F.lit("\\'"))
    return F.replace(F.replace(out, F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(" "))


def prefixed(scope: Column, sub: Column, body: Column) -> Column:
    """'[scope] sub: body', parts that are null or empty left out."""
    part = lambda c, a, b: F.when(c.isNotNull() & (c != ""), F.concat(F.lit(a), c, F.lit(b))).otherwise("")
    return F.concat(part(scope, "[", "] "), part(sub, "", ": "), body)


def week_key(key: Column) -> tuple[Column, Column]:
    """(year, week) of '…_W32_2026'; zeros where the key has another form."""
    p = r"_W(\d+)_(\d+)$"
    part = lambda g: F.coalesce(F.regexp_extract(key, p, g).try_cast("int"), F.lit(0))
    return part(2), part(1)


def folder_date(name: Column) -> Column:
    """The date of '24_260617': second token, YYMMDD; null where it is none."""
    digits = F.substring(F.get(F.split(name, "_"), F.lit(1)), 1, 6)
    return F.when(digits.rlike(r"^\d{6}$"), F.try_to_date(digits, "yyMMdd"))


def tuesday_of(year: Column, week: Column) -> Column:
    """The Tuesday of an ISO week."""
    jan4 = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_sub(jan4, F.weekday(jan4))
    return F.date_add(monday, (week - 1) * 7 + 1)


def cover_date(day: Column) -> Column:
    """'5 August 2026'."""
    return F.date_format(day, "d MMMM yyyy")
