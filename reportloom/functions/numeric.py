"""Figures in text as column expressions: parsing, picking by position, deriving plan from a delta."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: a percentage as reports print it.
PERCENT = r"\d{1,3}(?:\.\d{1,2})?"
#: A discipline's share of the whole.
WEIGHTS = {"Engineering": 0.10, "Procurement": 0.40, "Construction": 0.40, "Commissioning": 0.10}
DISCIPLINES = tuple(WEIGHTS)
MATRIX_TOLERANCE = 0.06
BAND = 5


def parse_pct(s: Column) -> Column:
    """The number of a cell such as ' 82.2 % '; null unless it lies in 0 to 100 (so NaN is null)."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"^\s+|\s+$", ""), r"%+$", ""), r"^\s+|\s+$", "")
    v = bare.try_cast("double")
    return F.when(v.between(0.0, 100.0), v)


def numbers_in(line: Column) -> Column:
    """All printed percentages of a line that lie in 0 to 100, in order."""
    found = F.transform(F.regexp_extract_all(line, F.lit(f"({PERCENT})"), F.lit(1)), lambda x: x.cast("double"))
    return F.filter(found, lambda v: v.between(0.0, 100.0))


def is_number(text: Column) -> Column:
    """A bare figure such as '82.23' or '100.00 %'; signs do not count."""
    return F.coalesce(F.regexp_replace(text, r"^\s+|\s+$", "").rlike(rf"^{PERCENT}\s*%?$"), F.lit(False))


def pick_from_end(numbers: Column) -> Column:
    """Struct (plan, actual, lead): of six or more numbers the fourth and third from the end, and
    all but the last six as leading pairs; null with fewer."""
    n = F.size(numbers)
    picked = F.struct(
        F.try_element_at(numbers, F.lit(-4)).alias("plan"),
        F.try_element_at(numbers, F.lit(-3)).alias("actual"),
        F.slice(numbers, F.lit(1), F.greatest(n - 6, F.lit(0))).alias("lead"),
    )
    return F.when(n >= 6, picked)


def four_or_two(numbers: Column) -> Column:
    """Struct (plan, actual): third and fourth of four or more numbers, else first and second; null
    with fewer than two."""
    n = F.size(numbers)
    at = lambda k: F.get(numbers, F.lit(k))
    return F.when(n >= 4, F.struct(at(2).alias("plan"), at(3).alias("actual"))).when(n >= 2, F.struct(at(0).alias("plan"), at(1).alias("actual")))


def positional(cells: Column) -> Column:
    """Struct (plan, actual): cells 5 and 6 of a row of seven or more, else its first two figures."""
    figures = F.filter(F.transform(F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))), parse_pct), lambda v: v.isNotNull())
    wide = F.struct(parse_pct(F.get(cells, F.lit(5))).alias("plan"), parse_pct(F.get(cells, F.lit(6))).alias("actual"))
    narrow = F.struct(F.get(figures, F.lit(0)).alias("plan"), F.get(figures, F.lit(1)).alias("actual"))
    return F.when(F.size(cells) >= 7, wide).otherwise(narrow)


def exact(v: Column) -> Column:
    """Two decimals, exactly."""
    return v.cast("decimal(9,2)")


def plan_from_delta(actual: Column, direction: Column, delta: Column) -> Column:
    """'delayed' by delta: the plan is that much higher; 'ahead': that much lower."""
    late = F.lower(direction) == "delayed"
    return F.when(late, exact(actual) + exact(delta)).otherwise(exact(actual) - exact(delta)).cast("double")


def plan_from_signed(actual: Column, delta: Column) -> Column:
    """delta = actual - plan, with its sign."""
    return (exact(actual) - exact(delta)).cast("double")


def consistent(plan: Column, actual: Column, variance: Column) -> Column:
    """Whether a printed variance agrees with actual - plan, whatever its sign."""
    return F.abs(F.abs(actual - plan) - variance) <= MATRIX_TOLERANCE


def weight_of(discipline: Column) -> Column:
    out = F.lit(0.0)
    for name, w in WEIGHTS.items():
        out = F.when(discipline == name, w).otherwise(out)
    return out


def weighted(value: Column, discipline: Column) -> Column:
    """Aggregate: mean by discipline weights, renormalised over those present; null if none has weight."""
    w = F.when(value.isNotNull(), weight_of(discipline)).cast("decimal(4,2)")
    total = F.sum(w)
    return F.when(total > 0, F.round(F.sum(exact(value) * w) / total, 2)).cast("double")


def variance_band(variance: Column) -> Column:
    """'delayed' under -5, 'ahead' over +5, else 'neutral'; judged on two decimals; null stays null."""
    v = exact(variance)
    return F.when(v < -BAND, "delayed").when(v > BAND, "ahead").when(v.isNotNull(), "neutral")


def fixed2(v: Column, signed: bool = False) -> Column:
    """Two decimals as text, '–' for null."""
    d = exact(v)
    text = d.cast("string")
    return F.coalesce(F.when(d >= 0, F.concat(F.lit("+"), text)).otherwise(text) if signed else text, F.lit("–"))


def shortest(v: Column) -> Column:
    """A number as a literal with at most two decimals and no trailing zeros; 'null' for null."""
    text = F.regexp_replace(F.regexp_replace(exact(v).cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.coalesce(text, F.lit("null"))


def letters_to_index(letters: Column) -> Column:
    """Spreadsheet column letters to a zero-based index: A is 0, AA is 26; null unless letters only."""
    digits = F.transform(F.split(F.upper(letters), ""), lambda c: F.ascii(c) - 64)
    value = F.aggregate(F.filter(digits, lambda d: d > 0), F.lit(0), lambda a, d: a * 26 + d)
    return F.when(letters.rlike("^[A-Za-z]+$"), value - 1)
