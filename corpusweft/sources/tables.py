"""Tables that a crawl keeps between rounds, as versioned Parquet, and text formats of old ones."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from ..functions.vectorised import vectorised


def snapshot(tables: dict[str, DataFrame], path: str, version: str) -> None:
    """Write all tables of a version; a marker file tells that it is whole."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{version}/{name}")
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/{version}/_whole")


def versions(spark: SparkSession, path: str) -> list[str]:
    """Versions that are whole, oldest first."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(root))
    return [n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_whole/_SUCCESS"))]


def restore(spark: SparkSession, path: str, names: list[str], version: str | None = None) -> dict[str, DataFrame]:
    chosen = version or versions(spark, path)[-1]
    return {n: spark.read.parquet(f"{path}/{chosen}/{n}") for n in names}


@vectorised("array<long>")
def unpack_keys(packed: pd.Series) -> pd.Series:
    """Little-endian 64-bit integers of a packed set."""
    return packed.map(lambda b: list(struct.unpack(f"<{len(b) // 8}q", bytes(b)[: len(b) // 8 * 8])), na_action="ignore")


@vectorised("binary")
def pack_keys(keys: pd.Series) -> pd.Series:
    return keys.map(lambda k: struct.pack(f"<{len(k)}q", *k), na_action="ignore")


def domain_lines(lines: DataFrame) -> DataFrame:
    """Domain rows of header lines 'scheme://host ip distance OK|BAD bytes… counts…'."""
    p = F.split("value", " ")
    at = lambda i, t="long": F.get(p, F.lit(i)).try_cast(t)
    return lines.select(
        F.regexp_extract("value", r"^(\w+)://", 1).alias("scheme"), F.regexp_extract("value", r"^\w+://(\S+)", 1).alias("host"), F.nullif(at(1, "string"), F.lit("None")).alias("ip"), at(2, "int").alias("distance"),
        (at(3, "string") == "BAD").alias("bad"), at(4).alias("bytes_downloaded"), at(5).alias("bytes_cleaned"), at(6).alias("count_downloaded"), at(7).alias("count_cleaned"),
    )


def domain_line() -> Column:
    c = F.col
    return F.concat_ws(" ", F.concat(c("scheme"), F.lit("://"), c("host")), F.coalesce(c("ip"), F.lit("None")), c("distance").cast("string"), F.when(c("bad"), "BAD").otherwise("OK"), *[c(x).cast("string") for x in ("bytes_downloaded", "bytes_cleaned", "count_downloaded", "count_cleaned")])


DOMAIN_RECORD = "scheme string, host string, ip string, distance int, bad boolean, bytes_downloaded long, bytes_cleaned long, count_downloaded long, count_cleaned long, new_paths array<string>, path_keys array<long>"


def parse_domain(data: bytes) -> dict | None:
    """One state record: the header, its new paths by line, and the packed keys of the paths met."""
    head, _, rest = data.partition(b"\n")
    f = head.decode("utf-8", "replace").split(" ")
    try:
        scheme, host = f[0].split("://", 1)
        sizes = [int(x) for x in (*f[4:8], *f[-2:])]
    except (ValueError, IndexError):
        return None
    paths, keys = rest[: sizes[4]].decode("utf-8", "replace").split("\n"), rest[sizes[4] + 1 :][: sizes[5] // 8 * 8]
    return {
        "scheme": scheme, "host": host, "ip": None if f[1] == "None" else f[1], "distance": int(f[2]), "bad": f[3] == "BAD", "bytes_downloaded": sizes[0], "bytes_cleaned": sizes[1],
        "count_downloaded": sizes[2], "count_cleaned": sizes[3], "new_paths": [p for p in paths if p], "path_keys": list(struct.unpack(f"<{len(keys) // 8}q", keys)),
    }


def domain_bytes(d: dict) -> bytes:
    paths, keys = "\n".join(d["new_paths"] or []).encode(), struct.pack(f"<{len(d['path_keys'] or [])}q", *(d["path_keys"] or []))
    head = [f"{d['scheme']}://{d['host']}", d["ip"], d["distance"], "BAD" if d["bad"] else "OK", *(d[c] for c in ("bytes_downloaded", "bytes_cleaned", "count_downloaded", "count_cleaned")), len(paths), len(keys)]
    return " ".join(map(str, head)).encode() + b"\n" + paths + b"\n" + keys + b"\n"


def domain_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Whole domain states, a file each, with new paths and path keys; files that are none are left out."""
    files = spark.read.format("binaryFile").load(path).select("content")

    @vectorised(DOMAIN_RECORD)
    def parsed(content: pd.Series) -> pd.DataFrame:
        names = [f.split()[0] for f in DOMAIN_RECORD.split(", ")]
        return pd.DataFrame([parse_domain(bytes(c)) or dict.fromkeys(names) for c in content], columns=names).astype({"distance": "Int32", **{c: "Int64" for c in names[5:9]}})

    return files.select(parsed(F.col("content")).alias("d")).where("d.host is not null").select("d.*")


def append_log(rows: DataFrame, path: str, kind: str, batch: int) -> None:
    """Rows of one kind of log (dns, redirects, robots, urls, ...) and batch; a batch that is written again replaces itself."""
    rows.write.mode("overwrite").parquet(f"{path}/{kind}/batch={batch}")


def read_log(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{kind}")


def queue_dump(queue: DataFrame) -> DataFrame:
    """Lines 'url scheme host path ip' of a queue that is left over, as ``seeds.url_tuples`` reads them."""
    url = F.concat("scheme", F.lit("://"), "host", "path")
    return queue.select(F.concat_ws(" ", url, "scheme", "host", "path", F.coalesce("ip", F.lit("None"))).alias("value"))


def rejected_log(urls: DataFrame) -> DataFrame:
    """host and reason of refused URLs, tab-separated."""
    return urls.where("reason is not null").select(F.concat_ws("\t", "host", "reason").alias("value"))


def reformat_queue(queue: DataFrame, max_host_length: int | None = None, max_host_paths: int | None = None, order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(lines 'scheme host path ip ', rejects): a waiting queue as a seed list, with optional caps."""
    from ..operators.windows import ranked

    r = ranked(queue, ["host"], [order], "_n")
    none = F.lit(None).cast("string")
    reason = F.coalesce(F.when(F.length("host") > max_host_length, F.lit("hostname-too-long")) if max_host_length else none, F.when(F.col("_n") > max_host_paths, F.lit("too-many-paths")) if max_host_paths else none)
    r = r.withColumn("reason", reason)
    line = F.concat_ws(" ", "scheme", "host", "path", F.coalesce(F.col("ip"), F.lit("")), F.lit(""))
    return r.where("reason is null").select(line.alias("value")), rejected_log(r)
