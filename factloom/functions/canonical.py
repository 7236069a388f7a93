"""Canonical text and content digests.

A record is ``name=value`` parts in a fixed order joined by ``|``.  Inside a
value the back-slash and the bar are escaped, so two different records never
share a text.  A null part is either skipped or kept as its bare name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(text, F.lit("|"), F.lit("\\|"))


def record(fields: Mapping[str, Column], keep_nulls: bool = False) -> Column:
    """Canonical text of named fields."""
    parts = []
    for name, value in fields.items():
        text = F.concat(F.lit(f"{name}="), escape(value.cast("string")))
        parts.append(F.coalesce(text, F.lit(name)) if keep_nulls else text)
    return F.concat_ws("|", *parts)


def sequence(items: Column) -> Column:
    """Canonical text of an array of texts, order kept."""
    return F.array_join(F.transform(items, escape), "|")


def mapping(entries: Column) -> Column:
    """Canonical text of a string map: sorted keys, null values dropped."""
    present = F.filter(
        F.array_sort(F.map_entries(entries)), lambda item: item["value"].isNotNull()
    )
    return sequence(
        F.transform(
            present,
            lambda item: F.concat(
                escape(item["key"]), F.lit("="), escape(item["value"])
            ),
        )
    )


def digest(namespace: str, text: Column, length: int = 24) -> Column:
    """``namespace:`` and the leading hex digits of the SHA-256 of the text."""
    return F.concat(
        F.lit(f"{namespace}:"), F.substring(F.sha2(text, 256), 1, length)
    )
