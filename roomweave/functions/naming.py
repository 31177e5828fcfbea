"""Names of files and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sanitize(c: Column) -> Column:
    """Lower-case word characters joined by single underscores; `unknown` if nothing is left."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "(?U)[^\\w\\-]", "_"), "_+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(plain, "^_+|_+$", ""), F.lit("")), F.lit("unknown"))


def pose_image(index: Column) -> Column:
    return F.format_string("pose_%04d.png", index)


def object_key(labels: Column) -> Column:
    """The sanitized labels of a pose's targets in order of name, joined."""
    return F.array_join(F.array_sort(F.transform(labels, sanitize)), "_")


def view_image(labels: Column, view: Column) -> Column:
    return F.format_string("%s_%s.png", object_key(labels), view.cast("string"))


def rotation_image(room: Column, yaw: Column) -> Column:
    return F.format_string("%s_%03ddeg.png", sanitize(room), F.pmod(F.rint(yaw).cast("int"), F.lit(360)))
