"""Labels, percentages and units for reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# A word goes on over letters, digits, underscores, apostrophes and inner dots.
_AFTER_SEPARATOR = r"(?<=[^\p{L}\p{M}\p{N}_'\u2019.:])"


def title_label(c: Column) -> Column:
    """Every word in title case; words also end at hyphens and slashes."""
    return F.array_join(F.transform(F.split(c, _AFTER_SEPARATOR, -1), lambda w: F.initcap(w)), "")


def spaced_label(c: Column) -> Column:
    """Title case with underscores as spaces."""
    return title_label(F.replace(c, F.lit("_"), F.lit(" ")))


def percent_label(ratio: Column) -> Column:
    """Whole percent, ``—`` when there is no ratio."""
    return F.coalesce(F.concat(F.round(ratio * 100).cast("int").cast("string"), F.lit("%")),
                      F.lit("—"))


def _fixed(number: Column, digits: int) -> Column:
    # format_number rounds the exact value, ties to even; its thousands separators go.
    return F.replace(F.format_number(number, digits), F.lit(","), F.lit(""))


def megabytes(n: Column) -> Column:
    """Bytes as MB with two decimals."""
    return _fixed(n / F.lit(1024 * 1024), 2)


def kilochars(n: Column) -> Column:
    """Characters in thousands with one decimal."""
    return _fixed(n / F.lit(1000), 1)
