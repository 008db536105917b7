"""Values in texts of other formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_value(text: Column, path: str, kind: str) -> Column:
    """The value at a path of a JSON text, as a type; null where the text is no JSON, the path leads nowhere or the value is of another kind."""
    return F.try_variant_get(F.try_parse_json(text), path, kind)
