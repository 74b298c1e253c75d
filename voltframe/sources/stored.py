"""Sub-plans of reports stored beside the views of a saved model, each with the views it was derived from.

Every write of a view or sub-plan leaves a stamp; a sub-plan's row also holds the stamps its inputs had. It is valid
while these are still the inputs' stamps, so a view that is written again, or a write that fails half-way, takes
what depends on it out of use. Stamps are one row per view.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

from voltframe.sources.entities import EntityView

if TYPE_CHECKING:
    from voltframe.model import GridModel

STAMPS = "stamps"
STAMP_SCHEMA = "stamp string, inputs map<string, string>, view string"


@dataclass(frozen=True)
class StoredPlan:
    """A stored sub-plan and the views that it was derived from."""

    source: Callable[[], DataFrame]
    inputs: frozenset[str]


class Several(Exception):
    """A sub-plan reads a view in which some property has several values."""


def _recording(m: GridModel) -> tuple[GridModel, set[str]]:
    """The same views, and the set of those that have been asked for."""
    from voltframe.model import GridModel

    read: set[str] = set()

    def source(name: str) -> DataFrame:
        read.add(name)
        view = m[name]
        # Rows per value depend on the columns that a report uses, so one table can't serve all reports.
        if isinstance(view, EntityView):
            raise Several(name)
        return view

    return GridModel({name: (lambda n=name: source(n)) for name in m.names()}), read


def stamp(spark: SparkSession, folder: str, views: Iterable[str], inputs: Mapping[str, Mapping[str, str]] | None = None) -> None:
    """A new stamp for each view; rows of other views stay."""
    rows = [(uuid.uuid4().hex, dict((inputs or {}).get(view, {})), view) for view in views]
    if not rows:
        return
    table = spark.createDataFrame(rows, STAMP_SCHEMA).coalesce(1)
    table.write.partitionBy("view").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{folder}/{STAMPS}")


def _stamps(spark: SparkSession, folder: str) -> dict[str, tuple[str, dict[str, str]]]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{STAMPS}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return {}
    return {row.view: (row.stamp, row.inputs) for row in spark.read.schema(STAMP_SCHEMA).parquet(f"{folder}/{STAMPS}").collect()}


def derive(m: GridModel, folder: str) -> None:
    """Write every sub-plan that the model has all views for; `m` reads stored views and no stored sub-plans."""
    from voltframe.plans.shared import DERIVED

    plans: dict[str, DataFrame] = {}
    inputs: dict[str, frozenset[str]] = {}
    for name, build in DERIVED.items():
        views, read = _recording(m)
        try:
            plans[name] = build(views)
        except (KeyError, Several):
            continue
        inputs[name] = frozenset(read)
    if not plans:
        return
    spark = next(iter(plans.values())).sparkSession
    found = _stamps(spark, folder)
    with ThreadPoolExecutor(len(plans)) as pool:
        list(pool.map(lambda n: plans[n].write.mode("overwrite").parquet(f"{folder}/{n}"), plans))
    # The stamps last: a sub-plan whose write failed keeps a row that no longer fits its inputs.
    stamp(spark, folder, plans, {name: {view: found[view][0] for view in inputs[name]} for name in plans})


def valid(spark: SparkSession, folder: str, views: Iterable[str]) -> dict[str, StoredPlan]:
    """The stored sub-plans whose inputs are all among `views` and haven't been written since."""
    from voltframe.plans.shared import DERIVED

    offered, found = set(views), _stamps(spark, folder)
    result = {}
    for name in DERIVED:
        _, inputs = found.get(name, (None, {}))
        if inputs and set(inputs) <= offered and all(found[view][0] == at for view, at in inputs.items()):
            result[name] = StoredPlan(lambda n=name: spark.read.parquet(f"{folder}/{n}"), frozenset(inputs))
    return result
