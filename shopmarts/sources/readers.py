"""Readers for source tables: Parquet, CSV seeds and JDBC databases. Types are declared, never guessed."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmarts.schemas import TableSpec


def read_parquet(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    return spark.read.parquet(os.path.join(root, spec.name))


def read_csv(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """A seed file with a header, ``<root>/<table>.csv``. A header out of step with the schema is an error."""
    return (
        spark.read.schema(spec.schema)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(os.path.join(root, f"{spec.name}.csv"))
    )


def cut_query(spec: TableSpec, schema: str, partitions: int) -> str:
    """SQL for the smallest key of each of ``partitions`` parts of equally many rows."""
    return (
        f"select min({spec.key}) as low from (select {spec.key}, ntile({partitions}) over "
        f"(order by {spec.key}) as part from {schema}.{spec.name} where {spec.key} is not null) ranked "
        "group by part"
    )


def key_predicates(key: str, cuts: list) -> list[str]:
    """Conditions that put every row in exactly one part, each from one cut up to the next.

    Parts hold equally many rows whatever gaps the key has. The first has all below the first cut and rows
    without a key, the last all above the last, so rows that came after the cuts were taken count too.
    """
    cuts = sorted(set(cuts))[1:]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{key} >= {low} and {key} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} or {key} is null", *inner, f"{key} >= {cuts[-1]}"]


def read_jdbc(
    spark: SparkSession,
    url: str,
    spec: TableSpec,
    schema: str = "raw",
    partitions: int = 64,
    **connection: str,
) -> DataFrame:
    """A database table, read by ``partitions`` tasks of equally many rows. A cursor filter on it runs in
    the database."""
    options = {"preferTimestampNTZ": "true", "pushDownPredicate": "true", **connection}
    cuts = spark.read.format("jdbc").options(**options, url=url, query=cut_query(spec, schema, partitions))
    found = [row[0] for row in cuts.load().collect()]  # one key a task
    parts = key_predicates(spec.key, found)
    table = spark.read.jdbc(url, f"{schema}.{spec.name}", predicates=parts, properties=options)
    # Databases fold the case of names; the pipeline uses lower case.
    return table.select(*[F.col(f"`{name}`").alias(name.lower()) for name in table.columns])
