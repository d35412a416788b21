"""Numeric column expressions with dataframe-library semantics under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

_INF = float("inf")


def quote(name: str) -> str:
    """A column name as SQL text; dots and spaces are safe."""
    return "`" + name.replace("`", "``") + "`"


def sql_literal(value) -> str:
    """A text, number or boolean as a SQL literal."""
    if isinstance(value, str):
        escaped = value.replace(chr(92), chr(92) * 2).replace("'", chr(92) + "'")
        return f"'{escaped}'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def col(c: ColumnLike) -> Column:
    """A column by name, quoted."""
    return c if isinstance(c, Column) else F.col(quote(c))


def key_digest(key: Sequence[ColumnLike], seed: int) -> Column:
    """Hex MD5 of the key's values as text, null as empty text, and the seed, joined by ``|``."""
    parts = [F.coalesce(col(k).cast("string"), F.lit("")) for k in key]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))).cast("binary"))


def safe_div(a: ColumnLike, b: ColumnLike, on_zero: str = "null") -> Column:
    """``a / b`` without the ANSI divide-by-zero error.

    ``on_zero='null'`` gives null for a zero denominator; ``'ieee'`` gives
    plus or minus infinity by the sign of the numerator and null for 0/0.
    """
    a, b = col(a).cast("double"), col(b).cast("double")
    ratio = F.try_divide(a, b)
    if on_zero == "null":
        return ratio
    if on_zero != "ieee":
        raise ValueError(f"on_zero must be 'null' or 'ieee', not {on_zero!r}")
    return F.when(b != 0, ratio).when((b == 0) & (a > 0), F.lit(_INF)).when((b == 0) & (a < 0), F.lit(-_INF))


def smoothed_ratio(a: ColumnLike, b: ColumnLike, add_top: float = 0.0, add_bottom: float = 1.0) -> Column:
    """``(a + add_top) / (b + add_bottom)``."""
    return safe_div(col(a) + F.lit(add_top), col(b) + F.lit(add_bottom))


def clip_zero(c: ColumnLike) -> Column:
    """Negative values and nulls become 0."""
    c = col(c)
    return F.when(c > 0, c).otherwise(F.lit(0))


def cap_above(c: ColumnLike, limit, value=None) -> Column:
    """Replace values above ``limit`` by ``value`` (the limit itself by default)."""
    c = col(c)
    return F.when(c > F.lit(limit), F.lit(limit if value is None else value)).otherwise(c)


def round_even(c: ColumnLike, scale: int = 0) -> Column:
    """Round half to even."""
    return F.bround(col(c), scale)


def row_mean(*cols: ColumnLike) -> Column:
    """Mean across columns of a row, nulls left out; null when all are null."""
    cols = [col(c) for c in cols]
    total = reduce(lambda x, y: x + y, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])
    present = reduce(lambda x, y: x + y, [c.isNotNull().cast("int") for c in cols])
    return safe_div(total, present)


def xor_score(*counts: ColumnLike) -> Column:
    """Bitwise score over ordered severity counts.

    The sums bind tighter than the exclusive-or, so for counts ``s1 .. sn`` this
    is ``(s1 + s2) ^ (2 + s3) ^ ... ^ (n-1 + sn) ^ n``.
    """
    counts = [col(c).cast("bigint") for c in counts]
    terms = [counts[0] + counts[1]]
    terms += [F.lit(weight) + c for weight, c in enumerate(counts[2:], start=2)]
    terms.append(F.lit(len(counts)).cast("bigint"))
    return reduce(lambda x, y: x.bitwiseXOR(y), terms)


def to_long(c: ColumnLike) -> Column:
    """Truncate toward zero to an integer; NaN, infinities and overflow give null."""
    c = col(c).cast("double")
    inside = (F.abs(c) < F.lit(9.2e18)) & ~F.isnan(c)
    return F.when(inside, F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)).cast("bigint"))
