"""Content readers by family on small pages."""

from pyspark.sql import functions as F

from reportloom.operators import layout
from reportloom.plans import content


def pages(spark, *rows):
    return spark.createDataFrame(rows, "doc_id bigint, page_no int, text string")


def items(df):
    return [r.item for r in df.orderBy("doc_id", "ord").collect()]


def test_generic(spark):
    p = pages(
        spark,
        (1, 1, "Table of contents\nArea of concern\nlisted here only"), (1, 2, "Area of concern\nthe crane is out of order\nthe crane is out of order\nshort\nNext week\nnot a concern at all"),
        (1, 3, "Issues at 5%\nnot read because of the share"), (1, 4, "Concern to achieve\nNext milestone: none\nConcern (Delay)\nsteel arrives late again\nAction\nsomething else entirely"), (1, 5, None),
    )
    assert items(content.generic_concerns(p)) == ["the crane is out of order", "steel arrives late again"]
    assert items(content.generic_activities(p)) == ["not a concern at all"]


def test_headed(spark):
    p = pages(spark, (1, 1, "KEY ISSUES AND CONCERNS\nStatus\n○ Pile rig\nstands idle for parts\n- detail\n3 Owner Open"), (2, 1, "KEY ISSUES AND CONCERNS\nNone."), (3, 1, "x"))
    got, has = content.headed_concerns(p, r"(?i)key\s+issues\s+and\s+concerns", r"^[○●]\s+(\S.*)$", "(?i)^status", r"^\d+\s+\w+\.?\s+\w+\.?\s*$")
    assert items(got) == ["Pile rig — stands idle for parts"] and {r.doc_id for r in has.collect()} == {1, 2}
    p = pages(spark, (1, 1, "6.3 Main Activities in Next Week (Tank Area)\n• before any heading\n6.3.1 Piling Work\n• Drive piles at gate"), (1, 2, "6.4 Main Activities in Next Week (Berth)\n• Drive piles at berth"), (1, 3, "5.7 Main Activities in Next Week\n• not this one at all"))
    title = r"(?i)main\s+activities\s+in\s+next\s+week\s*\(([^)]*)\)"
    assert items(content.headed_activities(p, title, r"^6\.\d+(?:\.\d+)*\s+(\S.*?)$")) == ["[Tank Area] before any heading", "[Tank Area] Piling Work: Drive piles at gate", "[Berth] Drive piles at berth"]


def test_numbered(spark):
    p = pages(spark, (1, 1, "3.1 List of issues\n1. road is blocked\nby residents\n2) None of the pumps run\n7"), (2, 1, "3.1 List of issues\nNone"))
    assert items(content.numbered_concerns(p, "(?i)list of issues")) == ["road is blocked by residents", "None of the pumps run"]
    assert items(content.numbered_concerns(p, "(?i)list of issues", folded=False)) == ["road is blocked", "None of the pumps run"]


def test_quantities(spark):
    p = pages(spark, (1, 1, "Main Activities in Next Week\n1.1 Rock excavation m3 369000 53401.00 0 0.00%\nSlope support Item 1 0.28 0.03 3.00%\nBad row m 1 1 1 ,.%"))
    assert items(content.planned_rows(p, "(?i)next week")) == ["Slope support — 0.03 Item (3.00%)"]
    p = pages(spark, (1, 1, "2.3 Construction\n1.1 Site hardening m2 5213 600 180\n1 Hub Camp\n1.2 Slope works m3 10 0 1\n1.3 Wall works m3 10 , 1"), (1, 2, "2.3 Construction\n1.4 Next page row m 1 2 3"), (1, 3, "2.3 Construction\n2.5 Weekly look ahead\n1.5 Not read row m 1 2 3"))
    assert items(content.work_rows(p, r"(?im)^\s*2\.3\s+construction", r"(?im)^\s*2\.\d+\s+weekly\s+look\s+ahead")) == ["Site hardening — 600 m2", "[Hub Camp] Wall works — , m3", "Next page row — 2 m"]


def column(spark, *docs):
    rows = [(d, 1, float(10 * k), 100.0, t) for d, ts in enumerate(docs) for k, t in enumerate(ts)]
    return spark.createDataFrame(rows, "doc_id bigint, page_no int, top double, x0 double, text string")


def test_fields(spark):
    c = column(
        spark,
        ["before", "Area of Concern: 1. permit is late", "1. crane is down", "for two days Issue to request HO support: x", "TRIR 0", "2. no steel", "Key Achievement", "not read"],
        ["Area of Concern : Refer to page 15", "Key Dates"], ["Area of Concern:", "None"], ["no such field"],
    )
    got = {r.doc_id: r for r in content.field(c, content.CONCERN_FIELD, content.CONCERN_FIELD_END, start=r"^\d+[.)]\s*|^- ", strip_support=True).collect()}
    assert got[0]["items"] == ["permit is late", "crane is down for two days", "no steel"] and not got[0].cross_reference
    assert got[1]["items"] == [] and got[1].cross_reference
    assert got[2]["items"] == [] and not got[2].cross_reference and 3 not in got
    section = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (0, 1, "z")], "doc_id bigint, ord int, item string")
    done = {r.doc_id: r["items"] for r in content.followed(content.field(c, content.CONCERN_FIELD, content.CONCERN_FIELD_END), section).collect()}
    assert done[1] == ["a", "b"] and done[2] == []
    ahead = content.field(column(spark, ["Key Look-ahead Milestones: s", "- first task", "more of it", "• second", "Manpower 12"]), content.LOOK_AHEAD, content.NEXT_FIELD, least_head=10).first()
    assert ahead["items"] == ["first task more of it", "second"]


def test_field_from_words(spark):
    words = [(1, 1, t, x, x + 5, top) for t, x, top in (("Area", 50.0, 10.0), ("of", 56.0, 10.0), ("Concern", 60.0, 10.0), ("KPI", 5.0, 20.0), ("late", 52.0, 21.0), ("steel", 58.0, 20.0))]
    w = spark.createDataFrame(words, "doc_id bigint, page_no int, text string, x0 double, x1 double, top double")
    got = content.field(layout.column_from(w, content.CONCERN_FIELD), content.CONCERN_FIELD, content.CONCERN_FIELD_END).first()
    assert got["items"] == ["late steel"]


def test_header_items(spark):
    p = spark.createDataFrame([(1, 0, "Topic", "Concern"), (1, 1, "Plant (A)", "• pump\nleaks\n• N/A 4"), (1, 2, "Line", "none"), (1, 3, "Sub", "no bullet here")], "doc_id bigint, col_no int, header string, value string")
    assert items(content.header_items(p)) == ["[Plant (A)] pump leaks", "[Sub] no bullet here"]


def test_projections(spark):
    r = spark.createDataFrame([("A", 2026, 1, True, 1.0, None, {"e": [1.0]}, None, ["a", "b"], []), ("B", 2026, 1, False, None, None, None, None, None, None)],
        "project_id string, year int, week int, found boolean, plan double, actual double, disciplines map<string,array<double>>, scopes map<string,double>, concerns array<string>, activities array<string>")
    assert [tuple(x) for x in content.summarised(r).collect()] == [("A", 2026, 1, 1.0, None, 1, 0, 2, 0)]
    h = spark.createDataFrame([("BOP(X) plant",), ("Terminal",), (None,)], "h string")
    assert [x[0] for x in h.select(content.first_keyword(F.col("h"), {"plant": "a", "bop": "b", "terminal": "c"})).collect()] == ["a", "c", None]
    s = spark.createDataFrame([(3, " ", None), (4, "x", "n")], "row_no int, id string, name string")
    assert [(x.id, x.name) for x in content.defaulted(s).collect()] == [("ROW-3", "Unnamed"), ("x", "n")]
