"""Vulnerability identifiers inside free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The identifier families and the shape of each.
IDENTIFIER_SHAPES = {
    "CVE": "CVE-[0-9]{4}-[0-9]{4,}",
    "GHSA": "GHSA-[A-Z0-9]{4}-[A-Z0-9]{4}-[A-Z0-9]{4}",
    "GO": "GO-[0-9]{4}-[0-9]+",
    "PYSEC": "PYSEC-[0-9]{4}-[0-9]+",
    "RUSTSEC": "RUSTSEC-[0-9]{4}-[0-9]+",
}

# No token of one family can contain a token of another, so one alternation finds
# the same identifiers as a search per family and returns them already in order.
# Word boundaries are spelled out so that accented letters count as word characters.
# The first letters are looked at before anything else: most positions end there.
_ANY_IDENTIFIER = (
    r"(?i)(?=[CGPR])(?<![\p{L}\p{N}_])(?:"
    + "|".join(IDENTIFIER_SHAPES.values())
    + r")(?![\p{L}\p{N}_])"
)


def extract_identifiers(text: Column) -> Column:
    """Distinct identifiers in upper case, in order of first appearance."""
    found = F.regexp_extract_all(text, F.lit(_ANY_IDENTIFIER), F.lit(0))
    return F.array_distinct(F.transform(found, lambda x: F.upper(x)))


def identifier_family(identifier: Column) -> Column:
    return F.substring_index(identifier, "-", 1)


def excerpt_around(
    text: Column, identifier: Column, upper_text: Column, size: int = 120
) -> Column:
    """Text around the first occurrence (half of ``size`` on each side), or the
    first ``size`` characters when the identifier does not occur.

    ``upper_text`` is the text in upper case, taken once per text by the caller.
    """
    half = size // 2
    found_at = F.instr(upper_text, identifier)
    start = F.greatest(F.lit(1), found_at - half)
    end = F.least(F.length(text), found_at - 1 + F.length(identifier) + half)
    around = F.trim(F.substring(text, start, end - start + 1))
    return F.when(found_at > 0, around).otherwise(F.substring(text, 1, size))
