"""Small expression helpers shared by the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters between words: blank, and tab to carriage return.
GAP = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text in order; NULL and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other letter as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def require(df, *columns: str) -> None:
    """Fail early, with the names, when a needed column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def free_name(df, wanted: str) -> str:
    """``wanted``, or with underscores added until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
