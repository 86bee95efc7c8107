"""Column functions written as SQL text over one bound variable.

A step that reads its input several times, ``CASE WHEN f(v) THEN g(v) ELSE v``,
would triple the expression at every link of a chain. Here the input is bound
once, as the variable of a lambda, so a chain of any length stays linear, and
the whole chain reaches the JVM as a single expression.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, functions as F

SqlStep = Callable[[str], str]

_names = count()


def fresh(prefix: str = "v") -> str:
    """A variable name no other expression uses."""
    return f"{prefix}_{next(_names)}"


def let_sql(value: str, body: SqlStep) -> str:
    """SQL that evaluates ``value`` once and ``body`` over it."""
    name = fresh()
    return f"get(transform(array({value}), {name} -> {body(name)}), 0)"


def column_function(step: SqlStep) -> Callable[[Column], Column]:
    """Turn SQL over a variable into a ``Column -> Column`` function."""

    def apply(value: Column) -> Column:
        name = fresh()
        body = F.expr(f"{name} -> {step(name)}")
        return F.get(F.call_function("transform", F.array(value), body), F.lit(0))

    return apply


def raw(text: str) -> str:
    """A SQL string literal that keeps backslashes as they are."""
    if "'" in text:
        raise ValueError("a raw literal cannot hold a single quote")
    return f"r'{text}'"


def quoted(text: str) -> str:
    """A SQL string literal for any text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def any_of(value: str, literals: tuple[str, ...]) -> str:
    """SQL: does ``value`` hold at least one of the literals."""
    return " OR ".join(f"contains({value}, {quoted(literal)})" for literal in literals)
