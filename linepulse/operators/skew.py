"""Joins in which few keys have most of the rows.

The hot keys are found by a sketch in one pass; only their rows are spread over salts and only their
master rows are repeated, so all other keys are joined as ever and the largest task is bounded also
without adaptive execution.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


@dataclass(frozen=True)
class Salting:
    """Hot keys and the number of parts that each one's rows are spread over."""

    keys: tuple
    parts: int

    def spread(self, rows: DataFrame, key: str) -> DataFrame:
        """Rows with their salt: any part for a hot key, 0 for others."""
        part = F.pmod(F.monotonically_increasing_id(), F.lit(self.parts)).cast("int")
        return rows.withColumn(SALT, F.when(self._hot(key), part).otherwise(0))

    def repeat(self, master: DataFrame, key: str) -> DataFrame:
        """Master rows with a copy for each part of a hot key."""
        parts = F.sequence(F.lit(0), F.lit(self.parts - 1))
        return master.withColumn(SALT, F.explode(F.when(self._hot(key), parts).otherwise(F.array(F.lit(0)))))

    def _hot(self, key: str) -> Column:
        return F.col(key).isin(*self.keys) if self.keys else F.lit(False)


def salting(rows: DataFrame, key: str, share: float = 0.01, parts: int = 16, tracked: int = 10_000) -> Salting:
    """The keys with more than `share` of the rows, at most ``1 / share`` of them.

    The sketch tracks `tracked` keys; its counts are never too low for a key it keeps, and any key
    beyond ``1 / tracked`` of the rows is kept. NULL keys never match and are not counted.
    """
    most = math.ceil(1 / share)
    found = rows.agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {max(tracked, most)})").alias("top"), F.count(key).alias("n")
    ).first()
    return Salting(tuple(t["item"] for t in found["top"] or [] if t["count"] > share * found["n"]), parts)
