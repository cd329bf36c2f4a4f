"""HTTP responses: status, headers, bodies and what follows from them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..config import SMALL, Config
from . import url as U
from .url import resolve_link
from .vectorised import sliced

REDIRECTS = (301, 302, 303, 307)
#: file type by media type
FILE_TYPES = {
    "application/postscript": "ps",
    "application/pdf": "pdf",
    "text/plain": "txt",
    "text/html": "html",
    "application/vnd.oasis.opendocument.text": "odt",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx",
    "application/msword": "doc",
}
_MONTHS = {m: f"{i:02d}" for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}
PARSED = "code int, message string, headers map<string,string>, body binary, error string"


def parse_status(line: str) -> tuple[int, str] | None:
    """(code, message) of a status line with or without protocol and message."""
    parts = re.split(r"\s+", line.strip(), maxsplit=2)
    for at in (1, 0):
        if len(parts) > at and re.fullmatch(r"[+-]?\d+", parts[at]):
            return int(parts[at]), " ".join(parts[at + 1 :])
    return None


def unchunk(body: bytes) -> bytes | None:
    """Chunks put together up to the first odd size; null if a size is no number."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0 or end > at + 20:
            return b"".join(out)
        try:
            size = int(body[at:end], 16)
        except ValueError:
            return None
        if not 1 <= size <= 100_000_000:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def parse_response(data: bytes | None, robots: bool = False) -> dict:
    """Status, lower-case headers (the last of a name wins) and decoded body, or an error."""
    row = {"code": None, "message": None, "headers": {}, "body": b"", "error": None}
    m = re.search(rb"\r?\n\r?\n", data or b"")
    head, body = ((data[: m.start()], data[m.end() :].strip()) if m else (data or b"", b""))
    lines = re.split(r"\r?\n", head.decode("utf-8", "replace"))
    status = parse_status(lines[0])
    if status is None:
        return row | {"error": "empty-status" if not lines[0].strip() else "bad-status"}
    row["code"], row["message"] = status
    for line in lines[1:]:
        key, colon, value = line.partition(":")
        if colon:
            row["headers"][key.strip().lower()] = value.strip()
    if row["code"] in REDIRECTS:
        return row | {"error": None if "location" in row["headers"] else "no-location"}
    if row["code"] != 200:
        return row | {"error": "not-200"}
    if row["headers"].get("transfer-encoding", "").lower() == "chunked":
        body = unchunk(body)
        if body is None:
            return row | {"error": "bad-chunk"}
    if robots and re.search(rb"<html|<body", body[:200].lower()):
        return row | {"error": "robots-is-html"}
    return row | {"body": body}


@sliced(PARSED)
def response(data: list[bytes | None], robots: list[bool | None]) -> list[dict]:
    rows = (parse_response(d, bool(r)) for d, r in zip(data, robots))
    return [row | {"headers": list(row["headers"].items())} for row in rows]


def file_type(headers: Column) -> Column:
    media = F.lower(F.regexp_extract(F.element_at(headers, "content-type"), r"^\s*([^;\s]+)", 1))
    table = F.create_map(*[F.lit(x) for pair in FILE_TYPES.items() for x in pair])
    return F.element_at(table, media)


def last_modified(headers: Column) -> Column:
    """yyyy-MM-dd of a 'dd Mon 20yy' date, else null."""
    value, pattern = F.element_at(headers, "last-modified"), r"(?i)(\d\d) (jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec) (20\d\d)"
    months = F.create_map(*[F.lit(x) for pair in _MONTHS.items() for x in pair])
    day, month, year = (F.regexp_extract(value, pattern, i) for i in (1, 2, 3))
    return F.when(day != "", F.concat_ws("-", year, F.element_at(months, F.lower(month)), day))


def declared_length(headers: Column) -> Column:
    return F.regexp_extract(F.element_at(headers, "content-length"), r"^(\d{1,18})", 1).try_cast("bigint")


def parse_responses(raw: DataFrame, data: str = "response", config: Config = SMALL) -> DataFrame:
    """Adds the parsed response, file type, date, redirect target and the reason to refuse it."""
    robots = F.col("path") == "/robots.txt"
    out = raw.withColumn("r", response(F.col(data), robots)).select(*raw.columns, "r.*")
    out = out.withColumns({"file_type": file_type(F.col("headers")), "modified_date": last_modified(F.col("headers")), "declared": declared_length(F.col("headers"))})
    target = F.when(F.col("code").isin(*REDIRECTS), resolve_link(F.col("url"), F.element_at("headers", "location")))
    out = out.withColumn("redirect_url", target)
    size = F.octet_length("body")
    reason = F.coalesce(
        F.col("error"),
        F.when(F.col("redirect_url") == F.col("url"), F.lit("redirect-to-self")),
        F.when(F.col("redirect_url").isNotNull(), F.lit("redirect")),
        F.when(F.col("declared") > config.max_doc_bytes, F.lit("too-large")),
        F.when(~robots & F.col("file_type").isNull(), F.lit("content-type")),
        F.when(~robots & (size < config.min_doc_bytes), F.lit("too-small")),
        F.when(size > config.max_doc_bytes, F.lit("too-large")),
    )
    return out.withColumn("reason", reason)


def redirect_edges(parsed: DataFrame, config: Config = SMALL, **lists) -> tuple[DataFrame, DataFrame]:
    """(edges, refused) of ``parse_responses``' redirects to other pages, as a frontier takes them: src_scheme,
    src_host, scheme, host, path, distinct; and redirect URLs with the reason that they aren't followed."""
    r = parsed.where("reason = 'redirect'").select(F.col("url").alias("src"), "redirect_url")
    a = U.admit(r, "redirect_url", config, **lists)
    edges = a.where("reason is null").select(U.scheme_of(F.col("src")).alias("src_scheme"), U.host_of(F.col("src")).alias("src_host"), "scheme", "host", "path").distinct()
    return edges, a.where("reason is not null").select("redirect_url", "reason")


def robots_status(parsed: DataFrame, max_redirects: int = 2) -> DataFrame:
    """FILE, EMPTY or FAIL for each fetched robots file, from ``parse_responses`` and redir_count."""
    remote = F.col("reason").isin("not-200", "no-location", "robots-is-html")
    status = (
        F.when(F.col("reason").isNull() & (F.octet_length("body") > 0), F.lit("FILE"))
        .when(F.col("reason").isNull() | remote, F.lit("EMPTY"))
        .when((F.col("reason") == "redirect") & (F.col("redir_count") <= max_redirects), F.lit("REDIRECT"))
        .otherwise(F.lit("FAIL"))
    )
    return parsed.withColumn("status", status)


def follow_robots_redirects(sources: DataFrame, fetched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resolved, waiting): robots of hosts that redirect, taken from the target's fetched file."""
    f = fetched.select(F.col("url").alias("redirect_url"), F.col("status").alias("target_status"), F.col("body").alias("target_body"))
    j = sources.join(f, "redirect_url", "left")
    return j.where("target_status is not null"), j.where("target_status is null").select(*sources.columns)


def decode_robots(bodies: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in bodies:
        yield s.map(robots_text, na_action="ignore")


def robots_text(body: bytes) -> str:
    for name in ("utf-8", "latin-1"):
        try:
            return bytes(body).decode(name)
        except UnicodeError:
            continue
    return bytes(body).decode("utf-8", "replace")
