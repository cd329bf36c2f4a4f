"""Text functions as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: traces that translation plug-ins leave in a page's source
TRANSLATION_MARKS = (
    "machine-translated-from", "delivered by GTranslate", 'id="weglot', "data-trp-gettext", 'name="translation-stats',
    "wp-translate", "wporg-translate", "mqtranslate", "qtranslate",
)
LENGTH_BUCKETS = ((1_000_000, "1M+"), (100_000, "100k-1M"), (10_000, "10k-100k"), (5_000, "5k-10k"), (1_000, "1k-5k"), (500, "500-1k"), (100, "100-500"), (0, "0-100"))


def tokens(text: Column) -> Column:
    """Pieces between Unicode white space."""
    return F.array_remove(F.split(text, r"(?U)\s+"), "")


def token_count(text: Column, spaced: bool = True) -> Column:
    return F.coalesce(F.size(tokens(F.coalesce(text, F.lit("")))), F.lit(0)).cast("long") if spaced else F.lit(0).cast("long")


def length_bucket(length: Column) -> Column:
    out = F.lit(None).cast("string")
    for least, name in reversed(LENGTH_BUCKETS):
        out = F.when(length >= least, F.lit(name)).otherwise(out)
    return out


def stamp_to_minutes(stamp: Column) -> Column:
    """yyyyMMddHHmmss as 'yyyy-MM-dd HH:mm'; other strings stay."""
    p = [F.substring(stamp, a, n) for a, n in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2))]
    return F.when(F.length(stamp) == 14, F.concat(p[0], F.lit("-"), p[1], F.lit("-"), p[2], F.lit(" "), p[3], F.lit(":"), p[4])).otherwise(stamp)


def escape_html(text: Column) -> Column:
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(mark), F.lit(entity))
    return text


def page_title(html: Column) -> Column:
    """Text of the first title that has no child, with white space collapsed, at most 300 characters."""
    found = F.regexp_extract(html, r"(?is)<title[^>]*>([^<]*)</title>", 1)
    return F.left(F.trim(F.regexp_replace(found, r"\s+", " ")), F.lit(300))


def meta_charset(html: Column) -> Column:
    """Declared encoding in lower case, from http-equiv or charset attributes in that order; null if none."""
    name = r"([a-zA-Z0-9_:.\-]+)"
    patterns = (
        rf"(?is)<meta[^>]*http-equiv=['\"]?content-type['\"]?[^>]*charset={name}",
        rf"(?is)<meta[^>]*charset={name}[^>]*http-equiv=['\"]?content-type",
        rf"(?is)<meta[^>]*http-equiv=['\"]?charset['\"]?[^>]*content=['\"]?{name}",
        rf"(?is)<meta[^>]*content=['\"]?{name}['\"]?[^>]*http-equiv=['\"]?charset",
        rf"(?is)<meta\s+charset=['\"]?{name}",
    )
    return F.coalesce(*[F.nullif(F.lower(F.regexp_extract(html, p, 1)), F.lit("")) for p in patterns])


def base_href(html: Column) -> Column:
    found = F.regexp_extract(html, r'<base [^>]*href="([^"]+?)/?"', 1)
    return F.when(found != "", F.concat(found, F.lit("/")))


def is_translated(html: Column) -> Column:
    """A page bears a trace of machine translation."""
    test = html.contains(TRANSLATION_MARKS[0])
    for mark in TRANSLATION_MARKS[1:]:
        test = test | html.contains(mark)
    return test


def without_xml_header(html: Column, whole_line: bool = False) -> Column:
    return F.regexp_replace(html, r"^\s*<\?xml.*" if whole_line else r"^\s*<\?xml[^>]*\?>", "")


def paragraphs(text: Column) -> Column:
    """Blank-line paragraphs of plain text."""
    return F.filter(F.split(text, r"\n\s*\n"), lambda p: F.trim(p) != "")


def content_key(text: Column) -> Column:
    """A stable key of a whole content."""
    return F.md5(text)


def megabytes(size: Column) -> Column:
    return F.floor(size / (1024 * 1024)).cast("long")
