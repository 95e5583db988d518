"""Registration of queries with their SQL twin and shared rounding."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from workload.sql import statement

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    run: Run
    sql: str | None
    digits: dict[str, int]

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """The query's result in comparable form: doubles rounded, clocks without a zone."""
        df = self.run(spark, sf_dir)
        shown = []
        for name, dtype in df.dtypes:
            column = F.col(f"`{name}`")
            if name in self.digits:
                column = F.round(column, self.digits[name])
            elif dtype == "timestamp":
                column = column.cast("timestamp_ntz")
            shown.append(column.alias(name))
        return df.select(*shown)

    def oracle(self) -> str | None:
        return self.sql and statement(self.sql, self.digits)


CASES: dict[str, Case] = {}


def case(sql: str | None = None, digits: str = ""):
    """Register a function under its name.

    ``digits`` lists the double columns: names in one string are rounded to 6
    places, ``name:d`` to d.
    """
    places = {}
    for item in digits.split():
        column, _, d = item.partition(":")
        places[column] = int(d or 6)

    def register(run: Run) -> Run:
        CASES[run.__name__] = Case(run, sql, places)
        return run

    return register
