"""Line-based inputs: seeds, queues, domain lists, DNS tables, ids and language samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import url as U


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).select(F.trim("value").alias("value"))


def seed_edges(lines: DataFrame) -> DataFrame:
    """Edges without a source from lines (value) of URLs; '#' starts a comment line, http:// is the default."""
    v = lines.where("value <> '' and not startswith(value, '#')")
    v = v.withColumn("url", F.when(F.startswith("value", F.lit("http")) & F.col("value").contains("://"), F.col("value")).otherwise(F.concat(F.lit("http://"), F.col("value"))))
    none = F.lit(None).cast("string")
    u = F.col("url")
    return v.select(none.alias("src_scheme"), none.alias("src_host"), U.scheme_of(u).alias("scheme"), U.host_of(u).alias("host"), U.path_of(u).alias("path"))


def seed_urls(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return seed_edges(_lines(spark, paths))


def _columns(lines: DataFrame, names: list[str]) -> DataFrame:
    p = F.split("value", " ")
    return lines.where("value <> ''").select(*[F.nullif(F.get(p, F.lit(i)), F.lit("None")).alias(n) for i, n in enumerate(names)])


def seed_triples(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return _columns(_lines(spark, paths), ["scheme", "host", "path"])


def url_tuples(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Old queues: url, scheme, host, path, ip and whether it is a robots file."""
    return _columns(_lines(spark, paths), ["url", "scheme", "host", "path", "ip"]).withColumn("is_robots", F.col("path") == "/robots.txt")


def redirects(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return _columns(_lines(spark, paths), ["src_scheme", "src_host", "scheme", "host", "path"])


def dns_table(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(scheme, host, ip) of lines 'scheme host ip' or 'host ip', which means http."""
    p = F.split("value", " ")
    two = F.size(p) == 2
    at = lambda i: F.get(p, F.lit(i))
    return _lines(spark, paths).where("value <> ''").select(F.when(two, F.lit("http")).otherwise(at(0)).alias("scheme"), F.when(two, at(0)).otherwise(at(1)).alias("host"), F.when(two, at(1)).otherwise(at(2)).alias("ip"))


def domain_list(spark: SparkSession, paths: str | list[str]) -> str:
    """A regular expression for a list file: such files are short and written by hand."""
    return U.domain_list_regex(r[0] for r in _lines(spark, paths).toLocalIterator())


def duplicate_ids(spark: SparkSession, paths: str | list[str], name: str = "doc_id") -> DataFrame:
    return _lines(spark, paths).where("value <> ''").select(F.col("value").cast("long").alias(name))


def robots_messages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(scheme, host, status, file) of ROBOT_FILE, ROBOT_EMPTY and ROBOT_FAIL lines."""
    p = F.split("value", " ")
    return _lines(spark, paths).where("startswith(value, 'ROBOT_')").select(F.get(p, F.lit(1)).alias("scheme"), F.get(p, F.lit(2)).alias("host"), F.regexp_extract("value", r"^ROBOT_(\w+)", 1).alias("status"), F.get(p, F.lit(3)).alias("file"))


def language_samples(spark: SparkSession, path: str) -> DataFrame:
    """(lang, text) of a folder with one file for each language."""
    return spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("lang"), F.col("value").alias("text"))


def word_lists(spark: SparkSession, path: str) -> DataFrame:
    """(lang, word) of a folder with one list for each language."""
    lines = spark.read.text(path).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("lang"), F.trim("value").alias("word"))
    return lines.where("word <> '' and not startswith(word, '#')")


def queue_chunk(queue: DataFrame, order: str, size: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(first rows of up to ``most`` bytes, the rest) of a waiting queue."""
    from ..operators.windows import numbered

    n = numbered(queue, [order], "_at", F.col(size))
    return n.where(F.col("_at") < most).drop("_at"), n.where(F.col("_at") >= most).drop("_at")
