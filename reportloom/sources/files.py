"""Report files: listing, routing to projects, tables with inferred headers, JSON, pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reportloom.functions.text import folder_date, norm_key
from reportloom.session import kept


def listing(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, name, folder, week, report_date, modified, length) of all files below ``root``; content
    is not read.  The week is the number before '_' in the folder just below the root."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    base = root.rstrip("/").rsplit("/", 1)[-1]
    folder = F.regexp_extract("path", rf"/{base}/([^/]+)/", 1)
    return f.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        folder.alias("folder"),
        F.regexp_extract(folder, r"^(\d+)_", 1).try_cast("int").alias("week"),
        folder_date(folder).alias("report_date"),
        F.col("modificationTime").alias("modified"),
        "length",
    )


def latest(files: DataFrame) -> DataFrame:
    """The files of the newest week by report date, then week number."""
    newest = files.agg(F.max(F.struct("report_date", "week")).alias("w"))
    return files.join(newest, F.struct(files["report_date"], files["week"]) == F.col("w"), "left_semi")


def newest_per(files: DataFrame, key: str) -> DataFrame:
    """(key, path): the last modified file of each key."""
    return files.groupBy(key).agg(F.max_by("path", F.struct("modified", "path")).alias("path"))


GRAM = 3


def routed(keywords: DataFrame, files: DataFrame, canonical: Column) -> DataFrame:
    """(project, name): of each project the file whose name contains one of its keywords, whatever
    the case; canonically named files first, then by name; null where there is none.  An empty
    keyword is in no name.

    A name that contains a keyword contains its first letters, so names and keywords are joined by
    these: by every place of a name where as many letters begin as some keyword's first letters are,
    up to GRAM.  Only those pairs are compared.  Projects play no part until each keyword has its best
    name, of which the rank limit leaves one a task.  The keywords are kept, so that the planner knows
    how few they are.
    """
    words = kept(keywords.select("project", F.upper("keyword").alias("_k")).distinct())
    k = words.where("_k <> ''").select("_k", F.substring("_k", 1, GRAM).alias("_g")).distinct()
    f = files.withColumn("_canonical", canonical).where("name is not null").select("name", "_canonical", F.upper("name").alias("_up"))
    lengths = [r[0] for r in k.select(F.length("_g")).distinct().collect()]  # at most GRAM rows

    def hits(n: int) -> DataFrame:
        begins = f.where(F.length("_up") >= n).select("*", F.explode(F.sequence(F.lit(1), F.length("_up") - (n - 1))).alias("_i"))
        g = begins.select("name", "_canonical", "_up", F.substr("_up", "_i", F.lit(n)).alias("_g"))
        return g.join(k.where(F.length("_g") == n), "_g").where(F.col("_up").contains(F.col("_k"))).select("_k", "name", "_canonical")

    def best(of: DataFrame, key: str) -> DataFrame:
        w = Window.partitionBy(key).orderBy(F.desc("_canonical"), "name")
        return of.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")

    found = best(reduce(DataFrame.unionAll, map(hits, lengths or [GRAM])), "_k")
    routes = best(words.join(found, "_k").select("project", "name", "_canonical"), "project").drop("_canonical")
    return words.select("project").distinct().join(routes, "project", "left")


def resolved(wanted: DataFrame, entries: DataFrame) -> DataFrame:
    """(wanted, entry): of each wanted name the entry with the same letters and digits; an exact match
    first, then by name; null where there is none."""
    j = wanted.withColumn("_k", norm_key(F.col("wanted"))).join(entries.withColumn("_k", norm_key(F.col("entry"))), "_k", "left")
    w = Window.partitionBy("wanted").orderBy(F.desc(F.coalesce(F.col("wanted") == F.col("entry"), F.lit(False))), "entry")
    return j.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("wanted", "entry")


def sheet(spark: SparkSession, path: str, words: tuple[str, ...] = ("project", "name", "id"), within: int = 19) -> DataFrame:
    """A delimited file whose header is somewhere in its first rows: the first of them in which two of
    the words occur, else the first.  Columns are named in lower case; of equal names the last counts."""
    raw = spark.read.option("header", "false").option("multiLine", "true").csv(path)
    columns = raw.columns
    # a file of several lines to a row is one partition, so these ids follow its rows
    numbered = raw.withColumn("_row", F.monotonically_increasing_id())
    head = numbered.where(F.col("_row") < within).orderBy("_row").collect()  # at most ``within`` rows
    hits = [sum(any(w in str(v or "").lower() for v in r[:-1]) for w in words) for r in head]
    at = next((k for k, n in enumerate(hits) if n >= 2), 0)
    names: dict[str, str] = {}
    for column, v in zip(columns, head[at] if head else (), strict=False):
        if v is not None and str(v).strip():
            names[str(v).strip().lower()] = column
    blank = F.coalesce(*(F.col(c) for c in columns)).isNull()
    return numbered.where((F.col("_row") > at) & ~blank).select(*(F.col(c).alias(n) for n, c in names.items()))


def report_json(reports: DataFrame) -> DataFrame:
    """(week, year, date, project): the projects of report documents (text), one row each; a document
    without a list of projects, or that is none, has no rows."""
    schema = (
        "week int, year int, date string, projects array<struct<id:string,name:string,type:string,contract:string,pdf_found:boolean,concerns:array<string>,"
        "activities:array<string>,plan:double,actual:double,scopes:map<string,struct<plan:double,actual:double>>>>"
    )
    r = reports.select(F.from_json("text", schema).alias("r"))
    return r.select("r.week", "r.year", "r.date", F.explode("r.projects").alias("project"))


def filled_from(sheet: DataFrame, pages: DataFrame, key: str = "project_id", fields: tuple[str, ...] = ("plan", "actual", "scopes")) -> DataFrame:
    """Sheet rows whose empty fields are filled from the pages' rows of the same key; what the sheet says
    stays, and so do rows the pages do not have."""
    other = pages.select(key, *(F.col(f).alias(f"_{f}") for f in fields))
    kinds = dict(sheet.dtypes)
    given = lambda f: F.when(F.size(f) > 0, F.col(f)) if kinds[f].startswith(("map", "array")) else F.when(~F.isnan(f), F.col(f)) if kinds[f] == "double" else F.col(f)
    return sheet.join(other, key, "left").withColumns({f: F.coalesce(given(f), F.col(f"_{f}")) for f in fields}).drop(*(f"_{f}" for f in fields))


def bound(df: DataFrame, **aliases: tuple[str, ...]) -> DataFrame:
    """The first present of several column names for each target; null where none is."""
    return df.select(*(F.col(next(a for a in names if a in df.columns)).alias(to) if any(a in df.columns for a in names) else F.lit(None).cast("string").alias(to) for to, names in aliases.items()))


def history_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object of '<project>_W<week>_<year>' to measures, as rows; a corrupt file has none."""
    value = "struct<plan:double,actual:double,n_disc:int,n_scopes:int,n_concerns:int,n_activities:int>"
    text = spark.read.text(path, wholetext=True)
    e = text.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("key", "v"))
    p = r"^(.*)_W(\d+)_(\d+)$"
    part = lambda g: F.regexp_extract("key", p, g)
    return e.where(F.col("key").rlike(p)).select(part(1).alias("project_id"), part(3).cast("int").alias("year"), part(2).cast("int").alias("week"), "v.*")


def results_json(spark: SparkSession, path: str, only: tuple[str, ...] = ()) -> DataFrame:
    """Run results (project_id, week, year, found, data), found ones only."""
    r = spark.read.json(path, multiLine=True).where("found")
    return r.where(F.col("project_id").isin(*only)) if only else r


PAGE = (
    "doc string, page_no int, width double, text string, words array<struct<text:string,x0:double,x1:double,top:double>>, "
    "chars array<struct<text:string,x0:double,x1:double,top:double>>, tables array<array<array<string>>>"
)


def register_pages(spark: SparkSession) -> bool:
    """Registers the format 'report_pages' (see PAGE) if a PDF reader is installed.  The option ``paths`` has
    the files, separated by line ends; each is a partition."""
    try:
        import pdfplumber  # noqa: F401
        from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
    except ImportError:
        return False

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.paths = [p for p in options.get("paths", "").split("\n") if p]

        def partitions(self):
            return [InputPartition(p) for p in self.paths]

        def read(self, partition):
            import pdfplumber

            placed = lambda xs: [(x["text"], float(x["x0"]), float(x["x1"]), float(x["top"])) for x in xs]
            with pdfplumber.open(partition.value) as doc:
                for n, page in enumerate(doc.pages, 1):
                    yield partition.value, n, float(page.width), page.extract_text() or "", placed(page.extract_words()), placed(page.chars), page.extract_tables()

    class Pages(DataSource):
        @classmethod
        def name(cls):
            return "report_pages"

        def schema(self):
            return PAGE

        def reader(self, schema):
            return Reader(self.options)

    spark.dataSource.register(Pages)
    return True


def placed(pages: DataFrame, what: str = "words") -> DataFrame:
    """(doc_id, page_no, text, x0, x1, top): the words (or chars) of pages (doc_id, page_no, words, chars)."""
    return pages.select("doc_id", "page_no", F.explode(what).alias("w")).select("doc_id", "page_no", "w.*")


def table_rows(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, tbl_no, row_no, cells): the rows of the tables of pages."""
    t = pages.select("doc_id", "page_no", F.posexplode("tables").alias("tbl_no", "t"))
    return t.select("doc_id", "page_no", "tbl_no", F.posexplode("t").alias("row_no", "cells"))
