"""What a result reads, from the leaves of its analysed plan: reports may read published marts and nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopmarts.sources.folders import qualified
from shopmarts.sources.layout import EXPOSED_LAYERS, MODEL_LAYERS, Layout

FILES = "HadoopFsRelation"
CONSTANTS = {"LocalRelation", "OneRowRelation", "Range"}


class NotExposed(RuntimeError):
    """A report reads something that is not a mart of the build it reports on."""


def sources_of(frame: DataFrame) -> set[str]:
    """The folders a result reads; leaves that are no files stand with their kind instead.

    Views are seen through, and subqueries count. A checkpoint or an RDD hides what is behind it and
    stands as its own kind.
    """
    plan = frame._jdf.queryExecution().analyzed()
    plans, below = [plan], plan.subqueriesAll()
    plans += [below.apply(i) for i in range(below.size())]
    found: set[str] = set()
    for one in plans:
        leaves = one.collectLeaves()
        for leaf in (leaves.apply(i) for i in range(leaves.size())):
            kind = leaf.getClass().getSimpleName()
            if kind == "LogicalRelation":
                relation = leaf.relation()
                kind = relation.getClass().getSimpleName()
                if kind == FILES:
                    paths = relation.location().rootPaths()
                    found |= {paths.apply(i).toString() for i in range(paths.size())}
                    continue
            if kind not in CONSTANTS:
                found.add(kind)
    return found


def require_exposed(
    spark: SparkSession, layout: Layout, build: str, tables: dict[str, DataFrame]
) -> None:
    """Refuse results that read anything but the exposed models of a build, before any work is done."""
    exposed = [model for model, layer in MODEL_LAYERS.items() if layer in EXPOSED_LAYERS]
    allowed = {qualified(spark, layout.stored(model, build)) for model in exposed}
    for name, table in tables.items():
        if hidden := sorted(sources_of(table) - allowed):
            raise NotExposed(f"{name} reads {', '.join(hidden)}, which is no mart of build {build}")
