"""Markup to plain text, page frontmatter, XML text."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from hazardbook.functions.strings import strip

# What a Unicode-aware "white space" matches, which the default Java class does not.
WHITE_SPACE = (
    r"[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
_LINE_BREAK = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]"
_FRONTMATTER = r"(?s)\A---\s*\n(.*?)\n---\s*\n"


@F.pandas_udf(StringType())
def _decode_entities(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def unescape_html(text: Column) -> Column:
    """Decode every named and numeric character reference.

    The full HTML5 table with its prefix rules is not expressible with built-ins, so
    texts holding an ``&`` go through one Arrow batch function; others are sent as
    NULL and kept as they are.
    """
    decoded = _decode_entities(F.when(F.contains(text, F.lit("&")), text))
    return F.coalesce(decoded, text)


def collapse_white_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITE_SPACE + "+", " "))


def strip_tags(text: Column) -> Column:
    """Component placeholders and tags become one blank each."""
    no_components = F.regexp_replace(text, r"<RuleID\b[^>]*/>", " ")
    return F.regexp_replace(no_components, "<[^>]+>", " ")


def plain_text(text: Column) -> Column:
    """Tags removed, character references decoded, white space collapsed."""
    return collapse_white_space(unescape_html(strip_tags(text)))


def frontmatter_block(page: Column) -> Column:
    return F.regexp_extract(page, _FRONTMATTER, 1)


def page_body(page: Column) -> Column:
    return F.regexp_replace(page, _FRONTMATTER, "")


def frontmatter_entries(block: Column) -> Column:
    """``key: value`` lines as ``array<struct<key,value>>``; indented lines and empty
    values are left out, quotes around a value are removed."""

    def entry(line: Column) -> Column:
        value = strip(F.regexp_extract(line, "(?s)^[^:]*:(.*)$", 1))
        value = F.btrim(F.btrim(value, F.lit('"')), F.lit("'"))
        return F.struct(
            strip(F.substring_index(line, ":", 1)).alias("key"), value.alias("value")
        )

    lines = F.filter(
        F.split(block, _LINE_BREAK),
        lambda line: F.contains(line, F.lit(":")) & ~line.startswith(" "),
    )
    return F.filter(F.transform(lines, entry), lambda e: e["value"] != "")


def frontmatter_value(entries: Column, key: str) -> Column:
    """Value of a key, the last one when it is repeated."""
    hits = F.filter(entries, lambda e: e["key"] == key)
    return F.try_element_at(hits, F.lit(-1))["value"]


def html_cells(table_row: Column) -> Column:
    return F.regexp_extract_all(table_row, F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1))


def html_rows(body: Column) -> Column:
    return F.regexp_extract_all(body, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))


_TAG = r"<(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>"


def markup_kept(document: Column) -> Column:
    """An XML document in which escaped text outlives one parse as escaped text, so that it
    can still be told from markup inside an element that is read as a string. CDATA
    becomes escaped text."""

    def escaped(text: Column) -> Column:
        return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    pieces = F.split(document, r"<!\[CDATA\[|\]\]>")
    plain = F.array_join(
        F.transform(pieces, lambda p, i: F.when(i % 2 == 1, escaped(p)).otherwise(p)), ""
    )
    ampersands = F.replace(plain, F.lit("&amp;"), F.lit("&amp;amp;"))
    return F.regexp_replace(ampersands, "&(lt|#0*60|#[xX]0*3[cC]);", "&amp;lt;")


def unmarked(text: Column) -> Column:
    """Plain text of what ``markup_kept`` kept escaped."""
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def text_of_markup(inner: Column) -> Column:
    """Text of all descendants of an element read as a string from a ``markup_kept``
    document, white space collapsed, empty -> NULL."""
    text = collapse_white_space(unmarked(F.regexp_replace(inner, _TAG, "")))
    return F.when(text != "", text)
