"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import linkweft
from linkweft.plans.session import shared_dir

SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application.

    Workers of a cluster need not have it installed; Spark hands the file out.
    """
    context = spark.sparkContext
    if context.applicationId in SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(linkweft.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="linkweft-"), "linkweft.zip")
    with zipfile.ZipFile(target, "w") as packed:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                packed.write(path, os.path.join("linkweft", os.path.relpath(path, top)))
    context.addPyFile(target)
    SHIPPED.add(context.applicationId)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of `df` written as Parquet below the shared folder, and read again.

    This cuts the lineage: a lost executor costs a re-read, not a re-run.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/linkweft-llm/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """`df` without columns whose names the caller is about to add."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def unseen(label_id: Column) -> Column:
    """True for rows that are held out: crc32 of the id as text is 0 modulo 5."""
    return F.coalesce(F.pmod(F.crc32(label_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
