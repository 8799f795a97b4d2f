"""Columns of a caller's table that an operator's own columns would clash with."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clashing(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of `df` that Spark would take for one of `names`; case does not count."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() in taken]


def refuse(df: DataFrame, names: Iterable[str]) -> None:
    found = clashing(df, names)
    if found:
        raise ValueError(f"The result has columns of its own with these names: {', '.join(found)}")


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`df` with clashing columns under free names, and what gives them back their names."""
    taken = {c.lower() for c in df.columns}
    moved = {}
    for name in clashing(df, names):
        free = f"aside_{name}"
        while free.lower() in taken:
            free += "_"
        taken.add(free.lower())
        moved[name] = free
    back = {free: name for name, free in moved.items()}

    def restore(out: DataFrame) -> DataFrame:
        return out.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in out.columns]) if back else out

    return df.withColumnsRenamed(moved) if moved else df, restore
