"""Where each layer lives: ``<warehouse>/<database>/<table>/<build>``, one database per target and layer.

Every build writes folders of its own. Small records name the builds that were published, each after
its checks had passed; readers open the last of them. So a build that fails, or is still being written or
checked, is never read by a report. A set of exports is published likewise, after its last part is
written. The last ``KEPT`` published builds and exports stay; what is older is removed, also what was never
published. Names rise with time, so anything newer may be at work and stays.
"""

from __future__ import annotations

import os
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from shopmarts.plans.marts import Marts
from shopmarts.sources.folders import children, put, remove, text_of

# The database prefix of each target.
TARGETS = {"dev": "shop_dev", "prod": "shop"}
LAYERS = ("staging", "intermediate", "marts")
RAW = "raw_webshop"  # landed once and shared by every target

# The layer of every model. Only marts are exposed to reports.
MODEL_LAYERS = {
    "stg_webshop__customers": "staging",
    "stg_webshop__products": "staging",
    "stg_webshop__orders": "staging",
    "stg_webshop__order_items": "staging",
    "int_orders__items_aggregated": "intermediate",
    "fct_orders": "marts",
    "fct_order_items": "marts",
    "dim_customers": "marts",
    "dim_products": "marts",
}
EXPOSED_LAYERS = {"marts"}
KEPT = 3  # published builds and exports
PUBLISHED = "_published"


@dataclass(frozen=True)
class Layout:
    warehouse: str
    target: str = "dev"

    def __post_init__(self) -> None:
        if self.target not in TARGETS:
            raise ValueError(f"unknown target {self.target!r}; expected one of {sorted(TARGETS)}")

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{TARGETS[self.target]}_{layer}"

    @property
    def raw(self) -> str:
        return os.path.join(self.warehouse, RAW)

    def path(self, model: str) -> str:
        return os.path.join(self.warehouse, self.database(MODEL_LAYERS[model]), model)

    def stored(self, model: str, build: str) -> str:
        return os.path.join(self.path(model), build)

    def view(self, model: str) -> str:
        """The session's view of an upstream model; targets do not share them."""
        return f"{self.database(MODEL_LAYERS[model])}__{model}"

    @property
    def published(self) -> str:
        return os.path.join(self.warehouse, self.database("marts"), PUBLISHED)

    def exports(self) -> str:
        return os.path.join(self.warehouse, f"{TARGETS[self.target]}_report")


def new_name() -> str:
    """For a build or a set of exports; later names are larger."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def _record(spark: SparkSession, folder: str, name: str) -> None:
    """One small record, written as a whole. Of two writers at once, one fails."""
    steps = children(spark, folder)
    put(spark, os.path.join(folder, f"{int(steps[-1]) + 1 if steps else 1:012d}"), name)


def _recorded(spark: SparkSession, folder: str, most: int) -> list[str]:
    """The names published last."""
    return [text_of(spark, os.path.join(folder, step)) for step in children(spark, folder)[-most:]]


def publish(spark: SparkSession, layout: Layout, build: str) -> None:
    """Make a checked build the one that readers open."""
    _record(spark, layout.published, build)
    kept = _recorded(spark, layout.published, KEPT)
    for model in MODEL_LAYERS:
        _retire(spark, layout.path(model), kept)


def publish_export(spark: SparkSession, layout: Layout, name: str) -> None:
    """Make a complete set of exports the one that readers open."""
    folder = os.path.join(layout.exports(), PUBLISHED)
    _record(spark, folder, name)
    _retire(spark, layout.exports(), _recorded(spark, folder, KEPT))


def _retire(spark: SparkSession, folder: str, kept: list[str]) -> None:
    names = [name for name in children(spark, folder) if name != PUBLISHED]
    remove(spark, [os.path.join(folder, name) for name in names if name < min(kept)])


def open_export(spark: SparkSession, layout: Layout) -> dict[str, str]:
    """The paths of the published extracts and reports, all from one build."""
    last = _recorded(spark, os.path.join(layout.exports(), PUBLISHED), 1)
    if not last:
        raise FileNotFoundError(f"nothing was exported to {layout.exports()}")
    root = os.path.join(layout.exports(), last[0])
    kinds = [os.path.join(root, kind) for kind in children(spark, root)]
    return {name: os.path.join(kind, name) for kind in kinds for name in children(spark, kind)}


def open_marts(spark: SparkSession, layout: Layout, build: str | None = None) -> Marts:
    """The four marts of the published build; with ``build``, of one that may not be checked yet.

    Fails before any report work when there is none.
    """
    last = [] if build else _recorded(spark, layout.published, 1)
    chosen = build or (last[0] if last else None)

    def missing(what: str) -> FileNotFoundError:
        return FileNotFoundError(
            f"no {what} in {layout.database('marts')} of {layout.warehouse}: "
            f"build target {layout.target!r} before reporting on it"
        )

    if chosen is None:
        raise missing("published build")

    def table(model: str) -> DataFrame:
        try:
            return spark.read.parquet(layout.stored(model, chosen))
        except AnalysisException as error:
            raise missing(f"{model} of build {chosen}") from error

    return Marts(
        orders=table("fct_orders"),
        order_items=table("fct_order_items"),
        customers=table("dim_customers"),
        products=table("dim_products"),
        order_key_holds=bool(last),
        build=chosen,
    )
