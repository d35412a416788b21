"""Flags, bands and category rewrites."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arithmetic import ColumnLike, col


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def sign_label(c: ColumnLike, negative, zero, positive, missing=None) -> Column:
    """One value per sign of ``c``, and ``missing`` for null."""
    c = col(c)
    return F.when(c < 0, F.lit(negative)).when(c == 0, F.lit(zero)).when(c > 0, F.lit(positive)).otherwise(F.lit(missing))


def bin_right_closed(c: ColumnLike, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval ``(edge, next edge]`` holding ``c``.

    One label more than inner intervals makes the last one open-ended; values
    at or below the first edge, and nulls, get null.
    """
    c = col(c)
    uppers = list(edges[1:]) + [None] * (len(labels) - len(edges) + 1)
    out = None
    for lower, upper, label in zip(edges, uppers, labels, strict=True):
        inside = c > F.lit(lower) if upper is None else (c > F.lit(lower)) & (c <= F.lit(upper))
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def overwrite(start: ColumnLike, rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """Apply conditional assignments in order; the last matching rule wins.

    ``default`` replaces a null left over after all rules.
    """
    out = None
    for condition, value in reversed(rules):
        out = F.when(condition, F.lit(value)) if out is None else out.when(condition, F.lit(value))
    out = col(start) if out is None else out.otherwise(col(start))
    return out if default is None else F.coalesce(out, F.lit(default))


def regroup(c: ColumnLike, values: Iterable, label) -> Column:
    """Listed values are merged into one label."""
    c = col(c)
    return F.when(c.isin(list(values)), F.lit(label)).otherwise(c)


def band_between(c: ColumnLike, low, high, inside: str, outside: str) -> Column:
    """``inside`` for values in the closed range, ``outside`` for others, null for null."""
    c = col(c)
    return F.when(c.between(low, high), F.lit(inside)).when(c.isNotNull(), F.lit(outside))


def code_to_int(c: ColumnLike, zero_codes: Iterable[str]) -> Column:
    """Text code to integer: listed codes are 0, digits parse, null stays null."""
    c = col(c)
    return F.when(c.isin(list(zero_codes)), F.lit(0)).otherwise(c.try_cast("int"))
