"""Prevertical text: <doc …> records with <p …> paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import text as T
from ..functions.url import xml_value

ATTRIBUTES = ["id", "title", "length", "crawl_date", "modified_date", "lang", "lang_diff", "ip", "url", "file_type", "enc_meta", "enc_chared"]


def _or_none(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def doc_tag(columns: dict[str, Column]) -> Column:
    """An opening tag; a null modified_date is left out, other nulls read None."""
    parts = [F.lit("<doc")]
    for name in ATTRIBUTES:
        c = columns.get(name)
        if c is None:
            continue
        attribute = F.concat(F.lit(f' {name}="'), _or_none(c), F.lit('"'))
        parts.append(F.when(c.isNotNull(), attribute).otherwise(F.lit("")) if name == "modified_date" else attribute)
    return F.concat(*parts, F.lit(">"))


def paragraph_tag(p: Column) -> Column:
    """<p …>text</p> of a classified paragraph; heading shows only where it is one."""
    return F.concat(F.lit("<p"), F.when(p["heading"], F.lit(' heading="1"')).otherwise(F.lit("")), F.lit(' class="'), p["class"], F.lit('" cfclass="'), p["cfclass"], F.lit('">'), T.escape_html(p["text"]), F.lit("</p>"))


def record(columns: dict[str, Column], body: Column) -> Column:
    return F.concat(doc_tag(columns), F.lit("\n"), body, F.lit("\n</doc>"))


def documents(df: DataFrame, paragraphs: str = "paragraphs") -> DataFrame:
    """(id, record) of classified documents."""
    body = F.array_join(F.transform(F.col(paragraphs), paragraph_tag), "\n")
    have = {c: F.col(c) for c in ATTRIBUTES if c in df.columns}
    if "title" in have:
        have["title"] = xml_value(F.coalesce(have["title"], F.lit("")))
    return df.select("id", record(have, body).alias("record"))


def write(records: DataFrame, path: str, per_file: int = 50_000) -> None:
    records.select(F.col("record").alias("value")).write.option("maxRecordsPerFile", per_file).option("compression", "gzip").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, header, body) of whole records; text outside records and a cut-off last record are left out."""
    chunks = spark.read.option("lineSep", "</doc>").text(path)
    found = chunks.select(F.regexp_extract("value", r"(?s)^\s*(<doc[ >][^\n]*)\n?(.*)$", 1).alias("header"), F.regexp_extract("value", r"(?s)^\s*<doc[ >][^\n]*\n?(.*)$", 1).alias("body"))
    return found.where("header <> ''").select(F.regexp_extract("header", r'\bid="(\d+)"', 1).try_cast("long").alias("doc_id"), "header", "body")


def good_paragraphs(body: Column) -> Column:
    """A record's lines without paragraphs of other classes than good; an unclosed one is closed."""
    lines = F.filter(F.split(body, "\n"), lambda x: ~F.startswith(x, F.lit("<p")) | x.contains(' class="good"'))
    closed = F.transform(lines, lambda x: F.when(F.startswith(x, F.lit("<p")) & ~F.endswith(x, F.lit("</p>")), F.concat(x, F.lit("</p>"))).otherwise(x))
    return F.array_join(closed, "\n")
