"""Whole-row helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_stored(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The same rows, with columns (all, or the named ones) the optimizer treats like those of a stored table.

    The optimizer repeats a computed column wherever a filter names it, and turns a
    constant column used as join key into a join without a key. Going through a one-row
    ``inline`` prevents both. It stays in the same codegen stage and moves no data. Columns
    that do not go through it are still read only where they are used.
    """
    through = rows.columns if columns is None else list(columns)
    others = [F.col(f"`{c}`") for c in rows.columns if c not in through]
    stored = rows.select(*others, F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in through]))))
    return stored.select(*[F.col(f"`{c}`") for c in rows.columns])
