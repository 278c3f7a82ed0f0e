"""Text as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stops(route: Column) -> Column:
    return F.split(route, ";")


def round_trip(path: Column) -> Column:
    """The list with its first entry once more at the end."""
    return F.concat(path, F.slice(path, 1, 1))


def round1(value: Column) -> Column:
    """One decimal, halves to even."""
    return F.bround(value, 1)


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def extension(name: Column) -> Column:
    return F.regexp_extract(name, r"(\.[^.]*)$", 1)


def publisher(dataset_id: Column) -> Column:
    return F.get(F.split(dataset_id, "/"), 0)


def code_block(text: Column) -> Column:
    """struct<dataset_type,dataset_id> of ee.<Type>("<id>")."""
    kind = F.regexp_extract(text, r"^[^.]*\.([^.(]*)", 1)
    name = F.replace(F.regexp_extract(text, r"\(([^)]*)\)", 1), F.lit('"'), F.lit(""))
    return F.struct(kind.alias("dataset_type"), name.alias("dataset_id"))


def is_folder_link(text: Column) -> Column:
    """All capitals and no blank."""
    return (F.upper(text) == text) & ~text.contains(" ")


def is_zip_link(text: Column) -> Column:
    return text.endswith(".zip")


def poi_label(name: Column, x: Column, y: Column) -> Column:
    return F.concat(name, F.lit(" ("), y.cast("string"), F.lit(","), x.cast("string"), F.lit(")"))


def dataset_label(dataset_id: Column, kind: Column) -> Column:
    return F.concat(dataset_id, F.lit("\t ("), kind, F.lit(")"))


def unknown_if_missing(tags: Column, key: str = "name") -> Column:
    return F.coalesce(F.try_element_at(tags, F.lit(key)), F.lit("unknown"))
