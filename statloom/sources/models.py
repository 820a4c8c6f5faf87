"""Fitted models as stored tables.

A folder holds any number of stored versions. Every one is a table under a name of its own, and counts only once a row of the folder's
manifest, appended last, names it with its number of rows and a digest: a version that was half written is never read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.regression import INTERCEPT, LinearModel

MANIFEST = "version long, name string, kind string, n long, digest string"


class IncompleteModel(ValueError):
    """A folder without a whole stored version."""


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller named, in whatever store it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException:  # no such folder
        return None


def _digest(table: DataFrame) -> tuple[int, str]:
    """Rows and a digest of their values that does not depend on their order."""
    names = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in sorted(table.columns)]
    found = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*names).cast("decimal(38,0)"))).first()
    return found[0], str(found[1])


def save_table(table: DataFrame, path: str, kind: str) -> int:
    """Store the rows as a new version in the folder; returns its number. One writer at a time."""
    spark, name = table.sparkSession, f"{kind}-{uuid.uuid4().hex}"
    table.write.parquet(f"{path}/{name}")
    n, digest = _digest(spark.read.schema(table.schema).parquet(f"{path}/{name}"))
    known = _versions(spark, path)
    last = known.agg(F.max("version")).first()[0] if known is not None else None
    version = (last or 0) + 1
    spark.createDataFrame([(version, name, kind, n, digest)], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def load_table(spark: SparkSession, path: str, kind: str, schema: str, version: int | None = None) -> DataFrame:
    """Rows of the named version, by default the latest; IncompleteModel if there is none or its rows are not those that were stored."""
    known = _versions(spark, path)
    if known is None:
        raise IncompleteModel(f"no stored model in {path}")
    known = known.where(F.col("kind") == kind)
    if version is not None:
        known = known.where(F.col("version") == version)
    stated = known.orderBy(F.desc("version")).first()
    if stated is None:
        raise IncompleteModel(f"no stored {kind} in {path}")
    try:
        table = spark.read.schema(schema).parquet(f"{path}/{stated['name']}")
    except AnalysisException as e:
        raise IncompleteModel(f"{stated['name']} is gone from {path}") from e
    if _digest(table) != (stated["n"], stated["digest"]):
        raise IncompleteModel(f"{stated['name']} in {path} is not what was stored")
    return table


LINEAR = "position int, term string, coefficient double, link string, converged boolean"


def save_linear(spark: SparkSession, model: LinearModel, path: str) -> int:
    """One row per coefficient, with its position and the link function."""
    terms = [(INTERCEPT, model.intercept), *zip(model.features, model.coefficients)]
    rows = [(i, term, float(value), model.link, model.converged) for i, (term, value) in enumerate(terms)]
    return save_table(spark.createDataFrame(rows, LINEAR), path, "linear")


def load_linear(spark: SparkSession, path: str, version: int | None = None) -> LinearModel:
    rows = load_table(spark, path, "linear", LINEAR, version).orderBy("position").collect()
    return LinearModel(
        tuple(r["term"] for r in rows[1:]),
        rows[0]["coefficient"],
        tuple(r["coefficient"] for r in rows[1:]),
        rows[0]["link"],
        rows[0]["converged"],
    )
