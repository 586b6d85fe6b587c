"""Identifiers, display texts and predicates of the loaded tables, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The display texts.
OBJECT_DISPLAY = "TObject(id=%d, class_id=%d, name='%s')"
PROPERTY_DISPLAY = "TProperty(id=%d, name='%s', collection_id=%d)"
# End of fixed values.


def object_identifier() -> Column:
    """The GUID where there is one, else ``class_id:object_id``."""
    pair = F.concat_ws(":", F.col("class_id").cast("string"), F.col("object_id").cast("string"))
    return F.coalesce(F.nullif(F.col("guid"), F.lit("")), pair)


def property_identifier() -> Column:
    """``property_id:collection_id`` and, where present, ``:enum_id``."""
    names = ("property_id", "collection_id", "enum_id")
    return F.concat_ws(":", *[F.col(n).cast("string") for n in names])


def object_display() -> Column:
    return F.format_string(OBJECT_DISPLAY, "object_id", "class_id", "name")


def property_display() -> Column:
    return F.format_string(PROPERTY_DISPLAY, "property_id", "name", "collection_id")


def is_enabled() -> Column:
    return F.col("show")


def has_enum() -> Column:
    return F.col("enum_id").isNotNull()


def is_time_varying() -> Column:
    return F.col("is_period")


def is_aggregable() -> Column:
    return F.col("is_summary")
