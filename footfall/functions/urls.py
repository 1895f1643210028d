"""Values taken from URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _after(text: Column, marker: str) -> Column:
    """Text between the first ``marker`` and the next ``&``; NULL when the marker is absent."""
    at = F.instr(text, marker)
    value = F.substring_index(F.substr(text, at + len(marker)), "&", 1)
    return F.when(at > 0, F.replace(value, F.lit(marker)))


def traffic_source(query: Column) -> Column:
    """``source`` parameter of a URL query: the leading parameter if it has a value, else a later one.

    Case sensitive; the fragment is kept; a repeated marker inside the value is dropped. Empty when
    there is no such parameter, NULL for a NULL query.
    """
    return F.coalesce(
        F.nullif(_after(query, "?source="), F.lit("")),
        _after(query, "&source="),
        F.when(query.isNotNull(), ""),
    )


def url_host(url: Column) -> Column:
    """Host of a lower-case absolute URL; empty when there is none."""
    return F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://([^/?#:]+)", 1)
