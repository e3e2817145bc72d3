"""Registered queries: a Spark builder, its output columns, and the oracle SQL.

A column list such as ``"brand:s n:l share:d"`` fixes names, order and types
on both sides: s text, l bigint, d double rounded to 6 places (p: 8), m money
rounded to 2 places, t date, b boolean.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.standins import VIEW_SQL, Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Plans that several oracle queries build on, beside the stand-in views.
FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = dict(VIEW_SQL)

_SPARK = {"s": "string", "l": "bigint", "t": "date", "b": "boolean"}
_DUCK = {"s": "varchar", "l": "bigint", "t": "date", "b": "boolean"}
_PLACES = {"d": 6, "p": 8, "m": 2}


def fragment(name: str, needs: Iterable[str], sql: str) -> None:
    FRAGMENTS[name] = (tuple(needs), sql)


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.rsplit(":", 1)) for part in spec.split()]


def _shape(df: DataFrame, spec: str) -> DataFrame:
    out = []
    for name, kind in _columns(spec):
        c = F.col(name)
        if kind in _PLACES:
            c = F.round(c.cast("double"), _PLACES[kind])
        else:
            c = c.cast(_SPARK[kind])
        out.append(c.alias(name))
    return df.select(*out)


def _prelude(needs: Iterable[str]) -> list[str]:
    done: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in done:
            return
        deps, text = FRAGMENTS[name]
        for d in deps:
            visit(d)
        done[name] = f"{name} as ({text})"

    for n in needs:
        visit(n)
    return list(done.values())


def _oracle(needs: Iterable[str], sql: str, spec: str) -> str:
    body = sql.strip()
    ctes = _prelude(needs)
    shaped = []
    for name, kind in _columns(spec):
        if kind in _PLACES:
            shaped.append(f"round(cast({name} as double), {_PLACES[kind]}) as {name}")
        else:
            shaped.append(f"cast({name} as {_DUCK[kind]}) as {name}")
    ctes.append(f"result_rows as ({body})")
    return "with " + ",\n".join(ctes) + f"\nselect {', '.join(shaped)} from result_rows"


def query(name: str, columns: str, needs: Iterable[str] = (), sql: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Inputs], DataFrame]):
        assert name not in QUERIES, name

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _shape(fn(Inputs(spark, sf_dir)), columns)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            _PENDING.append((name, tuple(needs), sql, columns))
        return fn

    return register


_PENDING: list[tuple[str, tuple[str, ...], str, str]] = []


def resolve() -> None:
    """Write out the oracle texts once every fragment is known."""
    while _PENDING:
        name, needs, sql, columns = _PENDING.pop()
        ORACLE[name] = _oracle(needs, sql, columns)
