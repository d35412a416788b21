"""Small helpers that spell oracle SQL for long feature lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..functions.arithmetic import quote
from ..operators.project import columns_by_type


def settle(df: DataFrame, keep: Sequence[str] = ("SK_ID_CURR",)) -> DataFrame:
    """Round numeric columns to float precision so that summation order cannot show.

    Sums of doubles differ in their last bits between engines and runs; a float
    keeps seven digits of any magnitude, and what is left of a difference of
    equal numbers becomes 0.  The oracle does the same.
    """
    numeric = set(columns_by_type(df, "numeric")) - set(keep)

    def rounded(c: str) -> str:
        value = f"CAST({quote(c)} AS DOUBLE)"
        return f"CASE WHEN abs({value}) < 1e-9D THEN 0D ELSE CAST(CAST({value} AS FLOAT) AS DOUBLE) END"

    return df.selectExpr(*[rounded(c) if c in numeric else quote(c) for c in df.columns]).toDF(*df.columns)


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def literal(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def settled(expr: str, name: str) -> str:
    return f"CASE WHEN abs({expr}) < 1e-9 THEN 0e0 ELSE CAST(CAST({expr} AS FLOAT) AS DOUBLE) END AS {quoted(name)}"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif({b}, 0))"


def agg(function: str, expr: str, where: str | None = None) -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    text = {
        "min": f"min({expr}){f}",
        "max": f"max({expr}){f}",
        "mean": f"avg({expr}){f}",
        "sum": f"coalesce(sum({expr}){f}, 0)",
        "var": f"var_samp({expr}){f}",
        "std": f"stddev_samp({expr}){f}",
        "median": f"median({expr}){f}",
        "skew": (
            f"CASE WHEN count({expr}){f} < 3 THEN NULL WHEN var_pop({expr}){f} * count({expr}){f} < 1e-14 THEN 0 "
            f"ELSE skewness({expr}){f} END"
        ),
        "count": f"count({expr}){f}",
        "size": f"count(*){f}",
        "nunique": f"count(DISTINCT {expr}){f}",
    }[function]
    if where and function in ("sum", "count", "size", "nunique"):
        text = f"CASE WHEN count(*){f} > 0 THEN {text} END"
    return text


def agg_list(spec: Mapping[str, Sequence[str]], prefix: str = "", where: str | None = None) -> dict[str, str]:
    return {
        f"{prefix}{c}_{f.upper()}": agg(f, quoted(c), where) for c, functions in spec.items() for f in functions
    }


def share_list(
    values: Mapping[str, Sequence], functions: Sequence[str] = ("mean",), prefix: str = ""
) -> dict[str, str]:
    out = {}
    for c, vs in values.items():
        for v in vs:
            hit = f"{quoted(c)} IS NULL" if v is None else f"{quoted(c)} = {literal(v)}"
            dummy = f"CASE WHEN {hit} THEN 1 ELSE 0 END"
            for f in functions:
                out[f"{prefix}{c}_{'nan' if v is None else v}_{f.upper()}"] = agg(f, dummy)
    return out


def dummy_list(values: Mapping[str, Sequence]) -> dict[str, str]:
    out = {}
    for c, vs in values.items():
        for v in vs:
            hit = f"{quoted(c)} IS NULL" if v is None else f"{quoted(c)} = {literal(v)}"
            out[f"{c}_{'nan' if v is None else v}"] = f"CASE WHEN {hit} THEN 1 ELSE 0 END"
    return out


def items(exprs: Mapping[str, str]) -> str:
    return ",\n".join(f"{e} AS {quoted(n)}" for n, e in exprs.items())


@dataclass
class Block:
    """A named result built from common table expressions."""

    name: str
    ctes: dict[str, str]
    columns: list[str] = field(default_factory=list)
    text_columns: tuple[str, ...] = ()

    def query(self, key: str = "SK_ID_CURR") -> str:
        chosen = [quoted(c) if c in self.text_columns else settled(quoted(c), c) for c in self.columns]
        ctes = ",\n".join(f"{n} AS ({t})" for n, t in self.ctes.items())
        return f"WITH {ctes}\nSELECT {key}, {', '.join(chosen)} FROM {self.name}"


def grouped(
    name: str, source: str, key: str, exprs: Mapping[str, str], ctes: Mapping[str, str], rename: str | None = None
) -> Block:
    """A block that aggregates ``source`` by ``key``."""
    head = f"{key} AS {rename}" if rename else key
    text = f"SELECT {head}, {items(exprs)} FROM {source} WHERE {key} IS NOT NULL GROUP BY {key}"
    return Block(name, {**ctes, name: text}, list(exprs))


def left_joined(name: str, base: Block, *others: Block, key: str = "SK_ID_CURR") -> Block:
    ctes: dict[str, str] = {}
    for b in (base, *others):
        ctes |= b.ctes
    columns = [c for b in (base, *others) for c in b.columns]
    chosen = ", ".join(f"{b.name}.{quoted(c)}" for b in (base, *others) for c in b.columns)
    joins = " ".join(f"LEFT JOIN {b.name} USING ({key})" for b in others)
    text = f"SELECT {base.name}.{key}, {chosen} FROM {base.name} {joins}"
    return Block(name, {**ctes, name: text}, columns, sum((b.text_columns for b in (base, *others)), ()))
