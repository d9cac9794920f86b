"""Text and string-array clean-up shared by the feed parsers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CVE_PATTERN = "CVE-[0-9]{4}-[0-9]+"


# Everything a Unicode-aware strip removes; a plain trim removes blanks only.
_STRIPPED = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_STRIPPED))


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def blank_to_null(text: Column) -> Column:
    """Empty text becomes NULL; white space is kept."""
    return F.when(text != "", text)


def parse_int(text: Column) -> Column:
    value = strip(text)
    return F.when(value.rlike("^[+-]?[0-9]+$"), value).try_cast("int")


def is_one(text: Column) -> Column:
    """True only for the text ``1`` (surrounding blanks ignored), never NULL."""
    return F.coalesce(strip(text) == "1", F.lit(False))


def trimmed_items(items: Column) -> Column:
    """Trim every entry and drop the empty ones; a NULL array becomes empty."""
    kept = F.filter(F.transform(items, lambda x: strip(x)), lambda x: x != "")
    return F.coalesce(kept, empty_strings())


def comma_items(text: Column) -> Column:
    return trimmed_items(F.split(text, ","))


def upper_items(items: Column) -> Column:
    return F.transform(items, lambda x: F.upper(x))


def only_cve_ids(items: Column) -> Column:
    """Upper-case the entries and keep those that are a CVE id as a whole."""
    return F.filter(upper_items(items), lambda x: x.rlike(f"^{CVE_PATTERN}$"))


def find_cve_ids(text: Column) -> Column:
    """Every CVE id in the text, in order, duplicates kept; never NULL."""
    found = F.regexp_extract_all(text, F.lit(CVE_PATTERN), F.lit(0))
    return F.coalesce(found, empty_strings())


def first_with_prefix(items: Column, prefix: str) -> Column:
    return F.get(F.filter(items, lambda x: x.startswith(prefix)), F.lit(0))


def url_from(template: str, value: Column) -> Column:
    """``template`` with one ``{}`` replaced by the value."""
    head, tail = template.split("{}")
    return F.concat(F.lit(head), value.cast("string"), F.lit(tail))


def content_digest(text: Column) -> Column:
    """SHA-256 of the text without its ``# digest:`` signature lines."""
    return F.sha2(F.regexp_replace(text, "(?md)^# digest:[^\\n]*\\n?", ""), 256)
