"""HTML predicates and extraction as column expressions. Null counts as empty."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import contains_any, count_of, estimated_tokens, strip

# Markers and patterns of the filters.
HTML_MARKERS = ["<!doctype", "<html", "<head", "<body", "<div", "<script", "<style"]
UNFINISHED = ["...", "TODO", "FIXME", "// rest of", "/* more */"]
PLACEHOLDERS = ["...", "// todo", "/* todo", "placeholder", "[insert", "[your", "<!-- add"]
OPEN_TAG, CLOSE_TAG, SELF_CLOSED, ELEMENT = r"<[a-zA-Z][^/>]*>", r"</[a-zA-Z]+>", r"<[a-zA-Z][^>]*/>", r"<[a-zA-Z][^>]*>"
CODE_BLOCK = r"(?is)```(?:html|svg|xml)\s*\n(.*?)\n```"
DOCTYPE_PAGE, HTML_PAGE = r"(?is)(<!DOCTYPE\s+html[^>]*>.*?</html>)", r"(?is)(<html[^>]*>.*?</html>)"
SVG_IMAGE, BODY = r"(?is)(<svg[^>]*>.*?</svg>)", r"(?is)<body[^>]*>(.*?)</body>"
SVG_BODY = '<body style="margin:0;padding:0;display:flex;justify-content:center;align-items:center;min-height:100vh;">'
PAGE_HEAD = '<!DOCTYPE html>\n<html>\n<head><meta charset="UTF-8"></head>\n'


def tag_counts(html: Column) -> dict[str, Column]:
    """Numbers of opening, closing, self-closed tags and of all elements."""
    patterns = {"open_tags": OPEN_TAG, "close_tags": CLOSE_TAG, "self_closed": SELF_CLOSED, "elements": ELEMENT}
    return {name: F.regexp_count(html, F.lit(p)).cast("long") for name, p in patterns.items()}


def rule_reason(response: Column) -> Column:
    """The first rule that a response fails, cheap ones first, or `pass`."""
    text = F.coalesce(response, F.lit(""))
    low, tags = F.lower(text), tag_counts(text)
    unbalanced = F.abs(tags["open_tags"] - tags["close_tags"] - tags["self_closed"]) > tags["open_tags"] * 0.3
    return (
        F.when(F.length(strip(text)) < 100, "too_short")
        .when(~contains_any(low, [*HTML_MARKERS, "<svg"]), "no_markup")
        .when(contains_any(text, UNFINISHED), "unfinished")
        .when(unbalanced, "unbalanced")
        .when(tags["elements"] < 3, "few_elements")
        .otherwise("pass")
    )


def passes_rules(response: Column) -> Column:
    return rule_reason(response) == "pass"


def fits_length(response: Column, most: int = 16384) -> Column:
    """At most `most` estimated tokens."""
    return estimated_tokens(F.coalesce(response, F.lit(""))) <= most


def validation_status(html: Column) -> Column:
    """The first check that a page fails, or `valid`."""
    text = F.coalesce(html, F.lit(""))
    low = F.lower(text)
    return (
        F.when(F.length(text) < 50, "too_short")
        .when(~F.contains(low, F.lit("<html")), "no_html_tag")
        .when(~F.contains(low, F.lit("<body")), "no_body_tag")
        .when(count_of(low, "<html") != count_of(low, "</html"), "unbalanced_html")
        .when(count_of(low, "<body") != count_of(low, "</body"), "unbalanced_body")
        .when(contains_any(low, PLACEHOLDERS), "has_placeholder")
        .when(F.length(text) < 200, "too_minimal")
        .otherwise("valid")
    )


def longest_match(text: Column, pattern: str) -> Column:
    """The stripped first one of the longest matches of group 1, or the empty string."""
    longest = F.aggregate(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))
    return strip(longest)


# The fenced pages that are looked for, in order.
FENCED = {
    "html_block": r"(?i)```html\s*([\s\S]*?)```",
    "doctype_block": r"(?i)```\s*(<!DOCTYPE[\s\S]*?)```",
    "html_tag_block": r"(?i)```\s*(<html[\s\S]*?</html>)[\s\S]*?```",
}


def html_block(response: Column) -> Column:
    """struct(html, status): the page in a reply's code fences and how it was found (html null if it was not)."""
    text = F.coalesce(response, F.lit(""))
    found = {name: longest_match(text, pattern) for name, pattern in FENCED.items()}
    html, status = F.lit(None).cast("string"), F.lit("no_html_block")
    for name, block in reversed(found.items()):
        html, status = F.when(block != "", block).otherwise(html), F.when(block != "", name).otherwise(status)
    return F.struct(F.when(text != "", html).alias("html"), F.when(text == "", "empty_response").otherwise(status).alias("status"))


def page(response: Column) -> Column:
    """The first page in a reply: fenced code, a document, or an svg or body wrapped into one; else empty."""
    text = F.coalesce(response, F.lit(""))
    first = lambda p: F.regexp_extract(text, p, 1)
    return (
        F.when(strip(text) == "", "")
        .when(text.rlike(CODE_BLOCK), strip(first(CODE_BLOCK)))
        .when(text.rlike(DOCTYPE_PAGE), strip(first(DOCTYPE_PAGE)))
        .when(text.rlike(HTML_PAGE), strip(first(HTML_PAGE)))
        .when(text.rlike(SVG_IMAGE), F.concat(F.lit(PAGE_HEAD + SVG_BODY + "\n"), first(SVG_IMAGE), F.lit("\n</body>\n</html>")))
        .when(text.rlike(BODY), F.concat(F.lit(PAGE_HEAD + "<body>"), strip(first(BODY)), F.lit("</body>\n</html>")))
        .otherwise("")
    )


def length_score(html: Column, low: float = 12000, high: float = 16000) -> Column:
    """1 up to `low` estimated tokens, 0 from `high`, linear between; 1 for nothing."""
    tokens = estimated_tokens(html)
    return F.when(tokens <= low, 1.0).when(tokens >= high, 0.0).otherwise((high - tokens) / (high - low))
