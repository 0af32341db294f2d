"""Writing an expression so that it is evaluated once.

Catalyst may repeat a projected expression: a filter on a computed column is moved
below the projection together with the whole expression, and a lambda evaluates
whatever it mentions for each element.  Both matter for page parsing, where one
expression holds many regular expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value which is written, and evaluated, only once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns through a generator, below which no filter is moved."""
    packed = F.struct(*[c.alias(k) for k, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.explode(F.array(packed)).alias("_once")).select(
        *kept, *[F.col(f"_once.{k}").alias(k) for k in columns]
    )
