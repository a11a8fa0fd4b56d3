"""JSON helpers for the event_properties string column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_valid_json(col: Column) -> Column:
    """Strict validity: the whole text is exactly one JSON value.

    ``try_parse_json`` alone accepts trailing junk (``{"a":1} x``). Wrapping the text as an
    array element and as an object member makes any junk or second value a parse error.
    NULL and empty text are invalid.
    """
    as_element = F.try_parse_json(F.concat(F.lit("["), col, F.lit("]")))
    as_member = F.try_parse_json(F.concat(F.lit('{"w":'), col, F.lit("}")))
    return F.coalesce(as_element.isNotNull() & as_member.isNotNull(), F.lit(False))


def json_path_text(col: Column, key: str) -> Column:
    """Text of a top-level member (arrays and objects as JSON text); NULL when missing."""
    return F.get_json_object(col, f"$.{key}")
