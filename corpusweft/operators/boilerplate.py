"""Paragraph classes: good, neargood, short or bad, first by themselves and then by context."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..config import SMALL, Config
from ..functions import html as H, text as T
from ..functions.vectorised import by_slices, sliced

STOP_ROWS = 1_000_000
_SPACE = re.compile("[\t\n\x0b\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")  # Unicode white space
_SELECT, _HEADING = re.compile(r"(^|\.)select(\.|$)"), re.compile(r"(^|\.)h[1-6](\.|$)")
CLASSED = "array<struct<text:string,words:int,link_chars:int,dom_path:string,heading:boolean,cfclass:string,class:string>>"


def link_density(p: Column) -> Column:
    return F.when(F.length(p["text"]) > 0, p["link_chars"] / F.length(p["text"])).otherwise(0.0)


def is_heading(p: Column) -> Column:
    return p["dom_path"].rlike(r"(^|\.)h[1-6](\.|$)")


def context_free(p: Column, stops: Column, config: Config = SMALL) -> Column:
    """Class of one paragraph (struct of text, words, link_chars, dom_path), given its language's stop words."""
    words = T.tokens(F.lower(p["text"]))
    density = F.when(F.size(words) > 0, F.size(F.filter(words, lambda w: F.array_contains(stops, w))) / F.size(words)).otherwise(0.0)
    size = F.length(p["text"])
    return (
        F.when((link_density(p) > config.max_link_density) | p["text"].contains("©") | p["dom_path"].rlike(r"(^|\.)select(\.|$)"), F.lit("bad"))
        .when(size < config.length_low, F.when(p["link_chars"] > 0, F.lit("bad")).otherwise(F.lit("short")))
        .when(density >= config.stopwords_high, F.when(size > config.length_high, F.lit("good")).otherwise(F.lit("neargood")))
        .when(density >= config.stopwords_low, F.lit("neargood"))
        .otherwise(F.lit("bad"))
    )


def revise(paragraphs: list[dict], config: Config = SMALL) -> list[dict]:
    """Context-sensitive classes of a document's paragraphs, in order.

    Short headings before good text count as neargood; short blocks follow the nearest
    others on both sides; neargood falls between two bad ones; and headings close
    before good text are good in the end. Beyond a document's edges all is bad.
    """
    n = len(paragraphs)
    cls = [p["cfclass"] for p in paragraphs]
    size = [len(p["text"]) for p in paragraphs]

    def near_good(i: int, want: tuple[str, ...]) -> bool:
        gap, j = 0, i + 1
        while j < n and gap <= config.max_heading_distance:
            if cls[j] in want:
                return True
            gap += size[j]
            j += 1
        return False

    def side(i: int, step: int, skip: tuple[str, ...], fixed: list[str]) -> str:
        j = i + step
        while 0 <= j < n and fixed[j] in skip:
            j += step
        return fixed[j] if 0 <= j < n else "bad"

    early = [i for i in range(n) if paragraphs[i]["heading"] and cls[i] == "short" and near_good(i, ("good",))]
    for i in early:
        cls[i] = "neargood"
    fixed = cls[:]
    for i in range(n):
        if fixed[i] != "short":
            continue
        around = {side(i, -1, ("short", "neargood"), fixed), side(i, 1, ("short", "neargood"), fixed)}
        close = any(fixed[j] == "good" for j in range(max(0, i - config.max_good_distance), min(n, i + config.max_good_distance + 1)))
        if around == {"good"}:
            cls[i] = "good" if close else "bad"
        elif around == {"bad"}:
            cls[i] = "bad"
        else:
            bad_side = -1 if side(i, -1, ("short", "neargood"), fixed) == "bad" else 1
            cls[i] = "good" if close and side(i, bad_side, ("short",), fixed) == "neargood" else "bad"
    fixed = cls[:]
    for i in range(n):
        if fixed[i] == "neargood":
            around = {side(i, -1, ("neargood",), fixed), side(i, 1, ("neargood",), fixed)}
            cls[i] = "bad" if around == {"bad"} else "good"
    for i in range(n):
        if paragraphs[i]["heading"] and cls[i] == "bad" and paragraphs[i]["cfclass"] != "bad" and near_good(i, ("good",)):
            cls[i] = "good"
    return [p | {"class": c} for p, c in zip(paragraphs, cls)]


@sliced(CLASSED)
def _revised(paragraphs: list[list[dict] | None]) -> list[list[dict] | None]:
    return [revise(ps) if ps is not None else None for ps in paragraphs]


def free_class(p: dict, stops: frozenset[str], config: Config = SMALL) -> dict:
    """``context_free`` for a paragraph as a dictionary: with heading and cfclass."""
    size, links = len(p["text"]), p["link_chars"]
    if (size and links / size > config.max_link_density) or "©" in p["text"] or _SELECT.search(p["dom_path"]):
        c = "bad"
    elif size < config.length_low:
        c = "bad" if links > 0 else "short"
    else:
        words = [w for w in _SPACE.split(p["text"].lower()) if w]
        density = sum(w in stops for w in words) / len(words) if words else 0.0
        if density >= config.stopwords_high:
            c = "good" if size > config.length_high else "neargood"
        else:
            c = "neargood" if density >= config.stopwords_low else "bad"
    return p | {"heading": bool(_HEADING.search(p["dom_path"])), "cfclass": c}


def stop_sets(stops: DataFrame, most: int = STOP_ROWS) -> dict[str, frozenset[str]] | None:
    """A table (lang, word) as sets, if it has at most ``most`` rows."""
    rows = stops.where("lang is not null and word is not null").select("lang", "word").limit(most + 1).toArrow()
    if rows.num_rows > most:
        return None
    out: dict[str, set[str]] = {}
    for lang, word in zip(rows["lang"].to_pylist(), rows["word"].to_pylist()):
        out.setdefault(lang, set()).add(word)
    return {k: frozenset(v) for k, v in out.items()}


def classify(pages: DataFrame, stops: DataFrame, lang: str = "lang", paragraphs: str = "paragraphs", config: Config = SMALL, most: int = STOP_ROWS, html: str | None = None) -> DataFrame:
    """Pages with ``paragraphs`` as structs that end in heading, cfclass and class; stops: (lang, word).

    Lists of at most ``most`` words in all are looked up as sets; larger ones are joined.
    If html names a column, ``paragraphs`` are those of its pages, parsed in the same pass as the look-up.
    """
    sets = stop_sets(stops, most)
    if sets is not None:
        def run(langs: list[str | None], found: list) -> list[list[dict] | None]:
            if html:
                found = (H.parse_page(h)["paragraphs"] for h in found)
            return [None if ps is None else revise([free_class(p, sets.get(k, frozenset()), config) for p in ps], config) for k, ps in zip(langs, found)]

        return pages.withColumn(paragraphs, by_slices(run, CLASSED)(F.col(lang), F.col(html or paragraphs)))
    if html:
        pages = pages.withColumn(paragraphs, H.parsed_page(F.col(html))["paragraphs"])
    lists = stops.groupBy(F.col("lang").alias("_lang")).agg(F.collect_set("word").alias("_stops"))
    j = pages.join(lists, pages[lang] == F.col("_lang"), "left").withColumn("_stops", F.coalesce("_stops", F.array().cast("array<string>")))
    free = F.transform(F.col(paragraphs), lambda p: F.struct(p["text"], p["words"], p["link_chars"], p["dom_path"], is_heading(p).alias("heading"), context_free(p, F.col("_stops"), config).alias("cfclass")))
    return j.withColumn(paragraphs, _revised(free)).select(*pages.columns)


def in_text(p: Column, config: Config = SMALL) -> Column:
    """A paragraph is part of the plain text: good in the end, or neargood by itself if those are allowed."""
    good = p["class"] == "good"
    return good | (p["cfclass"] == "neargood") if config.allow_neargood else good


def kept(p: Column, config: Config = SMALL) -> Column:
    """A paragraph goes into the corpus."""
    return F.lit(True) if config.keep_bad else in_text(p, config)


def good_only(paragraphs: Column) -> Column:
    return F.filter(paragraphs, lambda p: p["class"] == "good")


def plain_text(paragraphs: Column, config: Config = SMALL) -> Column:
    """Text of the paragraphs that are part of it, one to a line."""
    return F.array_join(F.transform(F.filter(paragraphs, lambda p: in_text(p, config)), lambda p: p["text"]), "\n")
