"""Stored-page extraction.

The reference drives a browser; here the pages are rows of HTML and every
field is a regular expression over the whole page text, run JVM-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import strip

# --- fixed values of the page jobs ----------------------------------------------------
TITLE_SUFFIX = " - Issue Tracker"
TITLE_FALLBACK = "Title not parseable from page_title"
NOT_FOUND = "Not found"
UNKNOWN = "Unknown"
NO_COMMENTS = "No subsequent comments found."
NOTHING_FOUND = "No comments or description found."
DESCRIPTION_MISSING_PREFIX = "Description block"
COMMENT_BLOCK = "--- Comment ID: %s ---\nAuthor: %s\nTimestamp: %s\nText:\n%s\n\n"
TITLE_PATTERN = r"(?is)<title>(.*?)</title>"
PARAGRAPH_PATTERN = r"(?is)<p>(.*?)</p>"
SCRIPT_STYLE_PATTERN = r"(?is)<script.*?</script>|<style.*?</style>"
TAG_PATTERN = r"<[^>]*>"
# HTML entities decoded in text (``&amp;`` last)
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
# ------------------------------------------------------------------------------


def unescape(c):
    for a, b in ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def page_title(html_col: str = "html", suffix: str = TITLE_SUFFIX):
    """P10 + P09: title text before ' [' (when '] - suffix' follows), else before
    ' - suffix', else the whole title; a page without a title gets the fallback."""
    t = unescape(F.regexp_extract(F.col(html_col), TITLE_PATTERN, 1))
    id_suffix = "]" + suffix
    return (F.when(t.contains(" [") & t.contains(id_suffix), F.substring_index(t, " [", 1))
            .when((t != "") & t.contains(suffix), F.substring_index(t, suffix, 1))
            .when(t != "", t)
            .otherwise(F.lit(TITLE_FALLBACK)))


def _cleaned(html_col: str = "html"):
    """Per page: every paragraph's text -- scripts and styles removed first,
    tags stripped, entities decoded (blank ones still present)."""
    body = F.regexp_replace(F.col(html_col), SCRIPT_STYLE_PATTERN, "")
    raw = F.regexp_extract_all(body, F.lit(PARAGRAPH_PATTERN), 1)
    return F.transform(raw, lambda p: strip(unescape(F.regexp_replace(p, TAG_PATTERN, ""))))


def _items(cleaned_col: str = "_cleaned"):
    """(raw_pos, text) of the non-blank paragraphs.  D07: an entry is known by its
    id (its place on the page), so two entries with the same text both stay.
    Row-local: all paragraphs of a page are in its row, so no shuffle is needed."""
    indexed = F.transform(F.col(cleaned_col), lambda x, i: F.struct(i.alias("raw_pos"), x.alias("text")))
    return F.filter(indexed, lambda e: e["text"] != "")


def page_items(pages: DataFrame) -> DataFrame:
    """T07 + D07: paragraphs in document order, one row each (see ``_items``)."""
    p = pages.select("page_id", _cleaned().alias("_cleaned"))
    return p.select("page_id", F.explode(_items()).alias("e")).select("page_id", "e.raw_pos", "e.text")


def comments_concat(pages: DataFrame) -> DataFrame:
    """A21 + P11: one row per page: url, title, description (first item) and
    the formatted concatenation of the later items in order, or the
    placeholder texts when there is nothing to concatenate.  Row-local: no
    shuffle, no grouping."""
    p = pages.select("page_id", "url", page_title().alias("issue_title"), _cleaned().alias("_cleaned"))
    it = p.select("page_id", "url", "issue_title", _items().alias("_it"))
    block = lambda e: F.format_string(COMMENT_BLOCK, F.concat(F.lit("p"), e["raw_pos"].cast("string")),
                                      F.lit(UNKNOWN), F.lit(UNKNOWN), e["text"])
    later = F.slice("_it", 2, F.greatest(F.size("_it") - 1, F.lit(1)))
    described = F.size("_it") > 0
    d = F.when(described, F.get("_it", 0)["text"]).otherwise(F.lit(DESCRIPTION_MISSING_PREFIX + " not found"))
    allc = strip(F.when(F.size("_it") > 1, F.array_join(F.transform(later, block), "")).otherwise(F.lit("")))
    concat = (F.when(allc != "", allc)
              .when(~d.startswith(DESCRIPTION_MISSING_PREFIX), F.lit(NO_COMMENTS))
              .otherwise(F.lit(NOTHING_FOUND)))
    return it.select("page_id", F.coalesce("url", F.lit(NOT_FOUND)).alias("issue_url"), "issue_title",
                     d.alias("description_text"), concat.alias("all_comments_concatenated"))
