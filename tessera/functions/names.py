"""Feature-column names built from category values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters replaced by '_' in feature names.
ROAD_NAME_CHARS = " .-"
LAYER_NAME_CHARS = " .-/"


def feature_name(prefix: str, value: Column, chars: str = LAYER_NAME_CHARS) -> Column:
    """``prefix + value`` with each of ``chars`` replaced by '_'.

    Applied before grouping, so values whose names collide add up into one
    column.
    """
    return F.concat(F.lit(prefix), F.translate(value.cast("string"), chars, "_" * len(chars)))


def clean_name(prefix: str, value: str, chars: str = LAYER_NAME_CHARS) -> str:
    """The same rule on a Python string (for column lists)."""
    for ch in chars:
        value = value.replace(ch, "_")
    return prefix + value
