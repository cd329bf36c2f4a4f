"""Archived responses to a clean corpus: the batch entry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..config import SMALL, Config
from ..functions import html as H, http, text as T
from ..functions.vectorised import by_slices
from ..lineage import cut
from ..operators import boilerplate, dedup, gramcodes, langid, stats


@dataclass
class Corpus:
    documents: DataFrame  # accepted documents with paragraphs, text, lang and status
    links: DataFrame  # all distinct links with their admission reason
    docmeta: DataFrame  # lengths, tokens and status of every page
    rejected: DataFrame  # pages that were refused, with the reason


EXTRACT = f"title string, paragraphs {boilerplate.CLASSED[:-2]},lang_diff:double>>, hrefs array<string>, base string, lang string, lang_diff double, text string"


def extract_page(html: str | None, known: gramcodes.GramModel, stops: dict[str, frozenset[str]], config: Config = SMALL) -> dict:
    """Title, classified paragraphs, links, language and text of one page.

    Paragraphs that would go into the corpus have their difference to the page's language,
    and only those within ``lang_diff_paragraph`` make up the text.
    """
    page = H.parse_page(html)
    codes, _ = gramcodes.coded(["\n".join(p["text"] for p in page["paragraphs"])], known.n)
    lang, difference = known.nearest(codes)
    own = known.names.index(lang) if lang is not None else None
    paragraphs = boilerplate.revise([boilerplate.free_class(p, stops.get(lang, frozenset()), config) for p in page["paragraphs"]], config)
    text = []
    for p in paragraphs:
        good = p["class"] == "good" or config.allow_neargood and p["cfclass"] == "neargood"
        p["lang_diff"] = None
        if own is not None and (good or config.keep_bad):
            codes, _ = gramcodes.coded([p["text"].replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")], known.n)
            p["lang_diff"] = gramcodes.rounded(float(known.differences(codes)[own]))
            if good and p["lang_diff"] <= config.lang_diff_paragraph:
                text.append(p["text"])
    return page | {"paragraphs": paragraphs, "lang": lang, "lang_diff": difference, "text": "\n".join(text)}


def extracted(pages: DataFrame, stops: DataFrame, models: DataFrame, config: Config = SMALL, page_id: str = "page_id") -> DataFrame:
    """Pages (page_id, url, html) with title, classified paragraphs, links, text, lang and lang_diff.

    One Python pass parses, detects and classifies each page. Models and stop lists beyond
    the sizes that ``small_model`` and ``stop_sets`` take are joined instead, in several passes.
    """
    known, sets = gramcodes.small_model(models), boilerplate.stop_sets(stops)
    own = [page_id, "url", F.octet_length("html").alias("html_len"), T.content_key(F.col("html")).alias("html_key"), T.is_translated(F.col("html")).alias("translated")]
    if known is not None and sets is not None:
        def run(html: list[str | None]) -> list[dict]:
            return [extract_page(h, known, sets, config) for h in html]

        return pages.select(*own, by_slices(run, EXTRACT)(F.col("html")).alias("p")).select(page_id, "url", "html_len", "html_key", "translated", "p.*")
    p = pages.select(*own, H.parsed_page(F.col("html")).alias("p")).select(page_id, "url", "html_len", "html_key", "translated", "p.*")
    whole = cut(p.withColumn("_text", F.array_join(F.transform("paragraphs", lambda x: x["text"]), "\n")))
    lang = langid.detect(whole.select(page_id, "_text"), models, page_id, "_text").withColumnRenamed("detected", "lang").withColumnRenamed("difference", "lang_diff")
    classed = boilerplate.classify(whole.drop("_text").join(lang, page_id, "left"), stops, "lang", "paragraphs", config)
    kept = classed.select(page_id, "lang", F.posexplode("paragraphs").alias("_at", "p")).where((F.col("p.class") == "good") | (F.lit(config.allow_neargood) & (F.col("p.cfclass") == "neargood")) | F.lit(config.keep_bad))
    kept = kept.withColumn("_key", F.concat_ws("#", F.col(page_id).cast("string"), F.col("_at").cast("string")))
    diff = langid.differences(kept.select("_key", T.escape_html(F.col("p.text")).alias("_text")), models, "_key", "_text")
    near = kept.where("lang is not null").select(page_id, "_key", "_at", "lang").join(diff.withColumnRenamed("model_lang", "lang"), ["_key", "lang"], "left").withColumn("difference", F.coalesce("difference", F.lit(1.0)))
    diff = near.groupBy(page_id).agg(F.map_from_entries(F.collect_list(F.struct("_at", "difference"))).alias("_diff"))  # a page's paragraphs
    j = classed.join(diff, page_id, "left")
    with_diff = F.transform("paragraphs", lambda x, i: F.struct(*[x[c].alias(c) for c in ("text", "words", "link_chars", "dom_path", "heading", "cfclass", "class")], F.try_element_at("_diff", i).alias("lang_diff")))
    return j.withColumn("paragraphs", with_diff).drop("_diff").withColumn("text", boilerplate.plain_text(F.filter("paragraphs", lambda x: x["lang_diff"] <= config.lang_diff_paragraph), config))


def reprocess(pages: DataFrame, stops: DataFrame, models: DataFrame, config: Config = SMALL, page_id: str = "page_id") -> Corpus:
    """The whole batch plan over (page_id, url, html); what is extracted is written once and then read."""
    reason = F.coalesce(
        F.when(F.col("translated"), F.lit("machine-translated")),
        F.when(F.col("lang").isNull() | ~F.col("lang").isin(*config.accepted_languages), F.lit("language")),
        F.when(F.col("text") == "", F.lit("no-text")),
    )
    e = cut(extracted(pages, stops, models, config, page_id).withColumn("reason", reason))
    good = e.where("reason is null")
    status = dedup.two_stage(good.select(page_id, "text", F.col("html_key").alias("html")), page_id)
    docs = good.join(status, page_id)
    meta = e.select(page_id, "url", "html_len", F.when(F.col("reason").isNull(), F.octet_length("text")).otherwise(0).alias("txt_len"), F.when(F.col("reason").isNull(), T.token_count(F.col("text"))).otherwise(F.lit(0)).alias("token_count")).join(status, page_id, "left")
    return Corpus(docs, H.page_links(pages), meta, e.where("reason is not null").select(page_id, "url", "reason"))


def from_archive(raw: DataFrame, config: Config = SMALL) -> tuple[DataFrame, DataFrame]:
    """(pages, refused) of archive rows (header, body): parsed, filtered and decoded."""
    data = F.concat("header", F.lit(b"\r\n\r\n"), "body")
    parsed = http.parse_responses(raw.select("wpage_id", "url", "path", data.alias("response")), config=config).withColumn("content", F.col("body"))
    kept = parsed.where("reason is null and file_type = 'html'")
    decoded = kept.withColumn("d", H.decoded_html(F.col("content"), F.lit(None).cast("string")))
    pages = decoded.where("d.text is not null").select(F.col("wpage_id").alias("page_id"), "url", F.col("d.text").alias("html"))
    return pages, parsed.where("reason is not null").select("wpage_id", "url", "reason")


def summary(docmeta: DataFrame) -> DataFrame:
    """Corpus totals in the units of the run log."""
    t = stats.totals(docmeta)
    return t.select("html_count", T.megabytes(F.col("raw_size")).alias("raw_mb"), "txt_count", T.megabytes(F.col("clean_size")).alias("clean_mb"), F.floor(F.col("token_count") / 1_000_000).alias("million_words"))
