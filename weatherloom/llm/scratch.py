"""Stored tables that only one step needs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from weatherloom.session import remove, stored

_open: ContextVar[list[str] | None] = ContextVar("stored tables of results", default=None)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Store ``df`` and read it back, for a result that is computed from it later.

    The table stays, since only the caller knows when the result has been used, but
    goes with ``ending`` where that is around.
    """
    table, path = stored(df, name)
    paths = _open.get()
    if paths is not None:
        paths.append(path)
    return table


@contextmanager
def ending(spark: SparkSession) -> Iterator[None]:
    """Remove what ``materialise`` has stored inside, also after an error.

    Results made inside must have been written when this ends.
    """
    paths: list[str] = []
    token = _open.set(paths)
    try:
        yield
    finally:
        _open.reset(token)
        for path in paths:
            remove(spark, path)


class Scratch:
    """Tables in the shared folder that go when the step that made them is done.

    Use it as a context: what is read after its end must be stored elsewhere.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        table, path = stored(df, name)
        self.paths.append(path)
        return table

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        for path in self.paths:
            remove(self.spark, path)
