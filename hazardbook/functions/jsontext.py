"""JSON kept as text or variant, with the strict type checks the feeds need."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardbook.functions.strings import strip


def json_string(value: Column, path: str) -> Column:
    """The field as text only when it is a non-empty JSON string (numbers -> NULL)."""
    field = F.try_variant_get(value, path, "variant")
    text = F.try_variant_get(value, path, "string")
    return F.when((F.schema_of_variant(field) == "STRING") & (text != ""), text)


def with_json_strings(rows: DataFrame, value: str, paths: Mapping[str, str]) -> DataFrame:
    """``rows`` with a ``json_string`` of their ``value`` column for every name. Fields and
    texts are projected one after the other: each is read once, however often it is named."""
    fields = {name: F.try_variant_get(value, path, "variant").alias(f"__{name}") for name, path in paths.items()}
    texts = {
        name: F.when(F.schema_of_variant(f"__{name}") == "STRING", F.col(f"__{name}").cast("string"))
        for name in paths
    }
    return (
        rows.select("*", *fields.values())
        .select(*rows.columns, *[text.alias(name) for name, text in texts.items()])
        .select(*rows.columns, *[F.when(F.col(name) != "", F.col(name)).alias(name) for name in paths])
    )


_DIGITS = "[0-9](?:_?[0-9])*"
_NUMBER = (
    f"^[+-]?(?:(?:{_DIGITS}(?:[.](?:{_DIGITS})?)?|[.]{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    "|(?i:nan|inf|infinity))$"
)


def number_text(text: Column) -> Column:
    """The double that a text writes, else NULL. Java's suffixes (``9.8d``) are no numbers;
    an underscore may stand between digits."""
    value = strip(text)
    return F.when(value.rlike(_NUMBER), F.replace(value, F.lit("_"), F.lit(""))).try_cast("double")


def json_number(value: Column, path: str) -> Column:
    """Number or numeric string as double; booleans and other types -> NULL."""
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    text = F.try_variant_get(value, path, "string")
    return number_text(F.when(~kind.isin("BOOLEAN") & ~kind.rlike("^(ARRAY|OBJECT)"), text))


def json_true(value: Column, path: str) -> Column:
    """True only for the JSON literal ``true``, never NULL."""
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    flag = F.try_variant_get(value, path, "boolean")
    return F.coalesce((kind == "BOOLEAN") & flag, F.lit(False))


def json_is_object(value: Column, path: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    return F.coalesce(kind.startswith("OBJECT"), F.lit(False))


def json_items(value: Column, path: str) -> Column:
    """An array of any scalars as text, or a comma-separated string split up."""
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    listed = F.try_variant_get(value, path, "array<string>")
    split = F.split(F.try_variant_get(value, path, "string"), ",")
    return F.when(kind.startswith("ARRAY"), listed).when(kind == "STRING", split)


def canonical_json(text: Column) -> Column:
    """The same document with sorted keys and compact separators."""
    return F.to_json(F.try_parse_json(text))


def json_path(text: Column, path: str) -> Column:
    return F.get_json_object(text, path)
