"""JSON document columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def with_nested(document: Column, updates: Mapping[str, Column]) -> Column:
    """Replace fields of a struct column; keys are dotted paths such as ``a.b``."""
    for path, value in updates.items():
        document = document.withField(path, value)
    return document


def checked_json(text: Column) -> Column:
    """The text itself if it parses as JSON; the job fails otherwise."""
    return F.when(F.try_parse_json(text).isNotNull() | text.isNull(), text).otherwise(
        F.raise_error(F.concat(F.lit("not a JSON document: "), F.substring(text, 1, 200)))
    )
