"""Seed blocks in a page of script: key, figures and the sizes of their containers.

Bracket matching that respects quotes and escapes has no column expression, so the body is
read by one scan in Python over Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BLOCK = re.compile(r"seed\(\s*'([^']+)'\s*,\s*(?=\{)")
_NUMBER = re.compile(r"(null|[\d.]+)\s*$")
SCHEMA = "doc_id bigint, block_no int, key string, plan double, actual double, n_disc int, n_scopes int, n_concerns int, n_activities int"
_CLOSE = {"{": "}", "[": "]"}


def entries(text: str, start: int) -> tuple[list[str], int]:
    """The top-level entries of the bracketed body that opens at ``start``, and where it ends.

    One pass keeps a stack of open brackets; quoted strings are skipped whole.  An unclosed
    body has no entries.
    """
    stack, out, begin = [_CLOSE[text[start]]], [], start + 1
    quoted = False
    i = start + 1
    while i < len(text):
        ch = text[i]
        if ch == "\\":
            i += 1
        elif quoted:
            quoted = ch != "'"
        elif ch == "'":
            quoted = True
        elif ch in _CLOSE:
            stack.append(_CLOSE[ch])
        elif ch == stack[-1]:
            stack.pop()
            if not stack:
                out.append(text[begin:i])
                return [e for e in map(str.strip, out) if e], i + 1
        elif ch == "," and len(stack) == 1:
            out.append(text[begin:i])
            begin = i + 1
        i += 1
    return [], start + 1


def blocks(text: str) -> Iterator[tuple[str, dict[str, str]]]:
    """(key, top-level fields as text) of every seed block."""
    for m in _BLOCK.finditer(text):
        fields = (e.split(":", 1) for e in entries(text, m.end())[0] if ":" in e)
        yield m.group(1), {k.strip(): v.strip() for k, v in fields}


def _figure(value: str | None) -> float | None:
    m = _NUMBER.match(value or "")
    try:
        return float(m.group(1)) if m and m.group(1) != "null" else None
    except ValueError:
        return None


def _size(value: str | None, bracket: str) -> int:
    return len(entries(value, 0)[0]) if value and value.startswith(bracket) else 0


def seed_blocks(pages: DataFrame) -> DataFrame:
    """All blocks of all pages (doc_id, text), in order of appearance."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                for n, (key, f) in enumerate(blocks(text or "")):
                    sizes = (_size(f.get(k), c) for k, c in (("disciplines", "{"), ("scopes", "{"), ("concerns", "["), ("activities", "[")))
                    rows.append((doc, n, key, _figure(f.get("plan")), _figure(f.get("actual")), *sizes))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return pages.select("doc_id", "text").mapInPandas(run, SCHEMA)


def history_of(pages: DataFrame, first: bool = True) -> DataFrame:
    """One row per key: its first block (newest blocks stand first in a page), or its last."""
    order = F.asc if first else F.desc
    w = Window.partitionBy("key").orderBy(order("doc_id"), order("block_no"))
    return seed_blocks(pages).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "block_no")


def scope_figures(value: str | None) -> dict[str, dict[str, float | None]]:
    """Plan and actual of the scopes of a body, by name; what is nested deeper is not theirs."""
    out = {}
    for e in entries(value, 0)[0] if value and value.startswith("{") else []:
        name, _, body = e.partition("': ")
        fields = dict(x.split(":", 1) for x in entries(body.strip(), 0)[0] if ":" in x) if body.strip().startswith("{") else {}
        fields = {k.strip(): v.strip() for k, v in fields.items()}
        out[name.strip().lstrip("'").replace("\\'", "'").replace("\\\\", "\\")] = {f: _figure(fields.get(f)) for f in ("plan", "actual")}
    return out


REPORT = "project_id string, year int, week int, plan double, actual double, scopes map<string,struct<plan:double,actual:double>>"
_KEY = re.compile(r"^(.*)_W(\d+)_(\d+)$")


def report_of(pages: DataFrame, weeks: DataFrame | None = None) -> DataFrame:
    """(project_id, year, week, plan, actual, scopes) of the seed blocks of pages (doc_id, text), of the given
    weeks (year, week) only; the last block of a key counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                for n, (key, f) in enumerate(blocks(text or "")):
                    if m := _KEY.match(key):
                        rows.append((doc, n, m[1], int(m[3]), int(m[2]), _figure(f.get("plan")), _figure(f.get("actual")), scope_figures(f.get("scopes"))))
            yield pd.DataFrame(rows, columns=["doc_id", "block_no", *(c.split()[0] for c in REPORT.split(", ")[:5]), "scopes"])

    own = pages.select("doc_id", "text").mapInPandas(run, f"doc_id bigint, block_no int, {REPORT}")
    if weeks is not None:
        own = own.join(weeks.select("year", "week").distinct(), ["year", "week"], "left_semi")
    w = Window.partitionBy("project_id", "year", "week").orderBy(F.desc("doc_id"), F.desc("block_no"))
    return own.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("project_id", "year", "week", "plan", "actual", "scopes")
