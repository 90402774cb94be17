"""Decoded documents kept as VARIANT (D10-D12, X1, X2, X5): the JSON text is parsed once a row, and every field is then
read from the parsed value. Paths and casts that do not fit give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_variant(document: Column) -> Column:
    """The document as VARIANT; text that is no JSON gives null."""
    return F.try_parse_json(document)


def _quoted(name: str) -> str:
    return "['" + name.replace("'", "\\'") + "']"


def member(document: Column, name: str, kind: str = "string") -> Column:
    """A member of the document's top level."""
    return F.try_variant_get(document, f"$.{name}", kind)


def field_value(document: Column, description: str, kind: str = "string") -> Column:
    """``decoded_values[description].decoded_value`` as a type."""
    return F.try_variant_get(document, f"$.decoded_values{_quoted(description)}.decoded_value", kind)


def field_count(document: Column) -> Column:
    """How many fields the document holds; 0 without any."""
    fields = F.try_variant_get(document, "$.decoded_values", "map<string,variant>")
    return F.coalesce(F.size(F.map_keys(fields)), F.lit(0))
