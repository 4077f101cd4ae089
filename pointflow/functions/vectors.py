"""Arithmetic on `array<double>` columns."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def sqdist(p: Column, q: Column) -> Column:
    """Squared Euclidean distance, summed from the first coordinate on; NULL if the lengths differ."""
    return F.aggregate(
        F.zip_with(p, q, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v
    )


def sqdist_text(point: str, table: str, row: int, dims: int) -> str:
    """`sqdist` to row `row` of a flat table column as plain SQL arithmetic, in the same order of summation.

    A point that is too short gives NULL, so that the check of its width is what fails.
    """
    gaps = [f"(get({point}, {j}) - {table}[{row * dims + j}])" for j in range(dims)]
    return " + ".join(f"{g} * {g}" for g in gaps)


def flat_table_text(rows: list[list[float]]) -> str:
    """Fixed points as one flat `array<double>` that reaches the tasks as a value, not as program text.

    Rounds that differ only in the centers then share their compiled code.
    """
    cells = ", ".join(f"{v!r}D" for r in rows for v in r)
    return f"(SELECT c FROM VALUES (array({cells})) AS t(c))"


def table_text(rows: list[list[float]]) -> str:
    """Fixed points as one constant `array<array<double>>`, however many they are."""
    return f"from_json('{json.dumps(rows)}', 'array<array<double>>')"


def distance(p: Column, q: Column) -> Column:
    return F.sqrt(sqdist(p, q))


def zeros(dims: int) -> Column:
    return F.array_repeat(F.lit(0.0), dims)


def add(p: Column, q: Column) -> Column:
    return F.zip_with(p, q, lambda a, b: a + b)


def scale(p: Column, factor: Column) -> Column:
    return F.transform(p, lambda a: a * factor)


def blend(p: Column, q: Column, x: Column, ell: Column) -> Column:
    """The point at distance `x` from `p` on the way to `q`, where `ell` is the whole distance."""
    return F.when(ell == 0.0, p).otherwise(
        F.zip_with(p, q, lambda a, b: (ell - x) / ell * a + x / ell * b)
    )
