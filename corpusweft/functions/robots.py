"""Robots rules as a table, and paths matched against it."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .url import robots_unquote, unquote_path
from .vectorised import vectorised

RULES = "array<struct<ruleset:int,is_default:boolean,agents:array<string>,delay:double,rule:int,allow:boolean,path:string,pattern:string>>"
_FIELD = re.compile(r"(user-?agent|allow|disallow|crawl-delay|sitemap):[ \t]*(.*)", re.I)


def wildcard_regex(path: str) -> str | None:
    """A regular expression for a path with '*' or a final '$'; null for plain prefixes.

    Runs of '*' are one, since Java's expressions backtrack.
    """
    if "*" not in path and not path.endswith("$"):
        return None
    end = path.endswith("$")
    parts = re.split(r"\*+", path[:-1] if end else path)
    return "^" + ".*".join(re.escape(p) for p in parts) + ("$" if end else "")


def parse_robots(body: str | None) -> list[dict]:
    """Rules in file order; rulesets that name nobody or rule nothing are left out, '*' comes last."""
    found: list[dict] = []
    current: dict | None = None
    naming = False

    def close() -> None:
        if current and current["rules"] and current["agents"]:
            found.append(current)

    for raw in re.split(r"\r\n?|\n", body or ""):
        line = raw.strip()
        if line.startswith("#"):
            continue  # a comment alone doesn't end a ruleset
        line = line.split("#", 1)[0].strip()
        if not line:
            close()
            current, naming = None, False
            continue
        m = _FIELD.search(line)
        if not m:
            continue
        name, value = m[1].lower(), re.sub(r"[\x00-\x1f\x7f]", "", m[2]).strip()
        if name.startswith("user"):
            if not naming:
                close()
                current = {"agents": [], "rules": [], "delay": None}
            if current and value:
                current["agents"].append(value)
            naming = True
            continue
        naming = False
        if current is None or name == "sitemap":
            continue
        if name == "crawl-delay":
            try:
                current["delay"] = float(value)
            except ValueError:
                pass
        else:
            current["rules"].append((name == "allow", robots_unquote(value)))
    close()
    ordered = sorted(found, key=lambda r: "*" in r["agents"])
    return [
        {"ruleset": i, "is_default": "*" in r["agents"], "agents": r["agents"], "delay": r["delay"], "rule": j, "allow": allow, "path": path, "pattern": wildcard_regex(path)}
        for i, r in enumerate(ordered)
        for j, (allow, path) in enumerate(r["rules"])
    ]


@vectorised(RULES)
def robots_rules(bodies: pd.Series) -> pd.Series:
    return bodies.map(parse_robots)


def agent_matches(agents: Column, agent: str) -> Column:
    return F.exists(agents, lambda a: (a == "*") | F.lit(agent.lower()).contains(F.lower(a)))


def rules_table(robots: DataFrame, agent: str, keys: tuple[str, ...] = ("scheme", "host"), body: str = "body") -> DataFrame:
    """The rules that bind ``agent``: those of the first ruleset that names it."""
    r = robots.select(*keys, F.filter(robots_rules(F.col(body)), lambda x: agent_matches(x["agents"], agent)).alias("rules"))
    first = F.filter("rules", lambda x: x["ruleset"] == F.array_min(F.transform("rules", lambda y: y["ruleset"])))
    return r.select(*keys, F.explode(first).alias("r")).select(*keys, "r.*")


def crawl_delays(robots: DataFrame, agent: str, keys: tuple[str, ...] = ("scheme", "host")) -> DataFrame:
    return rules_table(robots, agent, keys).groupBy(*keys).agg(F.first("delay").alias("delay"))


def allowed_paths(paths: DataFrame, rules: DataFrame, keys: tuple[str, ...] = ("scheme", "host"), path: str = "path") -> DataFrame:
    """All rows with ``allowed``: the first rule in file order that matches decides, none allows.

    A host's rules travel as one array (a robots file is small), so each path is one row
    throughout and the rules of a host with many paths are joined once.
    """
    by_host = rules.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rule", "allow", "path", "pattern"))).alias("_rules"))
    j = paths.join(by_host, list(keys), "left").withColumn("_path", unquote_path(F.col(path)))
    hit = F.filter(F.col("_rules"), lambda r: F.when(r["pattern"].isNotNull(), F.regexp_like(F.col("_path"), r["pattern"])).otherwise(F.startswith(F.col("_path"), r["path"])))
    first = F.get(hit, F.lit(0))
    verdict = F.when(first["path"] == "", ~first["allow"]).otherwise(first["allow"])  # a blank rule means the opposite
    return j.withColumn("allowed", F.coalesce(verdict, F.lit(True))).select(*paths.columns, "allowed")


def filter_allowed(paths: DataFrame, robots: DataFrame, agent: str, ignore_failed: bool = False) -> DataFrame:
    """Paths that may be fetched, given robots rows (scheme, host, status, body).

    FILE applies the rules, EMPTY allows all, FAIL allows all only if failures are ignored.
    """
    keys = ("scheme", "host")
    status = robots.select(*keys, "status")
    ok = ("FILE", "EMPTY") + (("FAIL",) if ignore_failed else ())
    j = allowed_paths(paths, rules_table(robots.where("status = 'FILE'"), agent, keys), keys)
    return j.join(status, list(keys)).where(F.col("status").isin(*ok) & F.col("allowed")).select(*paths.columns)


def stored_body(body: Column, scheme: Column, host: Column) -> Column:
    """A robots file as it is kept: its text and a last line that names its site."""
    return F.concat(body, F.lit("\n#"), scheme, F.lit("://"), host, F.lit("\n"))
