"""GridModel: named entity views plus the reports computed from them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from voltframe.session import written
from voltframe.sources import stored
from voltframe.sources.entities import (
    BUCKET_KEYS,
    EDGES,
    STATE,
    STATE_VIEWS,
    VIEWS,
    EntityTable,
    EntityView,
    edge_quads,
    has_local_name,
    local_name,
    view_quads,
)

if TYPE_CHECKING:
    from voltframe.operators.validate import Schema
    from voltframe.sources.stored import StoredPlan

def _stored(view: DataFrame | EntityView) -> DataFrame:
    return view.stored() if isinstance(view, EntityView) else view


def _once(rows: DataFrame) -> DataFrame:
    """The rows written and read back; as they are where files would lose their order or can't hold a column."""
    kinds = " ".join(kind for _, kind in rows.dtypes)
    ordered = not rows._jdf.queryExecution().optimizedPlan().outputOrdering().isEmpty()
    same_names = len({c.lower() for c in rows.columns}) < len(rows.columns)
    return rows if ordered or same_names or any(k in kinds for k in ("void", "interval", "variant")) else written(rows, "rows")


ViewSource = DataFrame | Callable[[], DataFrame]
Mapper = Callable[[DataFrame], DataFrame]
CONCURRENT_WRITES = 8


class GridModel:
    """A set of entity views. Views are lazy; a report only plans the ones it reads."""

    def __init__(
        self,
        views: Mapping[str, ViewSource],
        mappers: Iterable[Mapper] = (),
        derived: Mapping[str, StoredPlan] | None = None,
        typed: Mapping[str, Callable[[], EntityView]] | None = None,
    ) -> None:
        self._sources = dict(views)
        self._views: dict[str, DataFrame] = {}
        self.mappers = tuple(mappers)
        self._derived = dict(derived or {})
        self._typed = dict(typed or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._views:
            source = self._derived[name].source if name in self._derived else self._sources[name]
            self._views[name] = source() if callable(source) else source
        return self._views[name]

    def __contains__(self, name: str) -> bool:
        return name in self._sources or name in self._derived

    def names(self) -> list[str]:
        """The views; stored sub-plans of reports are not among them."""
        return sorted(self._sources)

    def with_views(self, **views: ViewSource) -> GridModel:
        """A model with other views; what was derived from a replaced one is derived anew."""
        derived = {name: plan for name, plan in self._derived.items() if not plan.inputs & views.keys()}
        typed = {name: view for name, view in self._typed.items() if name not in views}
        return GridModel(self._sources | views, self.mappers, derived, typed)

    def typed(self, name: str) -> EntityView:
        """A view over quads whose cells keep value, datatype and kind; `query` converts the ones a user selects."""
        return self._typed[name]()

    def finish(self, report: DataFrame) -> DataFrame:
        """Apply the configured value mappers to a finished report."""
        for mapper in self.mappers:
            report = report.transform(mapper)
        return report

    def report(
        self, name: str, *, distinct: bool = False, limit: int | None = None, offset: int | None = None, **arguments: object
    ) -> DataFrame:
        """A report with its declared column types; a value that doesn't convert fails."""
        from voltframe.operators.validate import coerce, options
        from voltframe.plans import REPORTS
        from voltframe.plans.schemas import SCHEMAS

        rows = REPORTS[name](self, **arguments)
        return options(coerce(rows, SCHEMAS[name], strict=True) if name in SCHEMAS else rows, distinct, limit, offset)

    def query(self, rows: DataFrame, schema: Schema | None = None) -> DataFrame:
        """A user's rows as a finished table.

        Columns of value structs (value, datatype, kind) are converted by the datatype they hold, found in one
        aggregation; then the columns of `schema` are cast and the value mappers applied. Rows with such columns are
        written once and read by both steps, unless they stand in an order or a column can't be stored.
        """
        from voltframe.operators.validate import coerce, convert, datatypes_of

        typed = [f.name for f in rows.schema.fields if {"value", "datatype", "kind"} <= set(getattr(f.dataType, "names", ()))]
        if typed:
            rows = _once(rows)
            seen = datatypes_of(rows, typed).first().asDict()
            plain = rows.withColumns({c: F.col(f"{c}.value") for c in typed})
            rows = convert(plain, {c: kind for c, kind in seen.items() if kind is not None})
        return self.finish(coerce(rows, schema, strict=True) if schema else rows)

    def check(self, name: str, **arguments: object) -> DataFrame:
        """Violations of the declared schema of a report: rule, column, violations."""
        from voltframe.operators.validate import violations
        from voltframe.plans.schemas import SCHEMAS

        return violations(self.report(name, **arguments), SCHEMAS[name])

    def write(self, name: str, folder: str, mode: str = "errorifexists", **arguments: object) -> DataFrame:
        """Write a report as Parquet; returns the violations of its declared schema, counted while it is written."""
        from voltframe.operators.validate import write_checked
        from voltframe.plans.schemas import SCHEMAS

        return write_checked(self.report(name, **arguments), SCHEMAS[name], folder, mode)

    def __getattr__(self, name: str) -> Callable[..., DataFrame]:
        from voltframe.plans import REPORTS

        if name in REPORTS:
            return partial(self.report, name)
        raise AttributeError(name)

    @classmethod
    def from_quads(
        cls,
        quads: DataFrame,
        state: DataFrame | None = None,
        mappers: Iterable[Mapper] = (),
        materialize: bool = False,
        several: Iterable[str] = (),
    ) -> GridModel:
        """Views over one quad table, or over an equipment table plus a state table.

        With `materialize`, the grouped subjects are written once to the shared folder, which pays off as
        soon as a report reads more than a few views.

        A property with several values of one subject fails the reports that use it. Named in `several` (local
        name) it gives a row for every value in the views that have it, also to reports that don't use it.

        With two tables, state properties and state views read only the state side, as do the
        association and class quads of state objects; everything else reads the equipment side.
        """
        several = tuple(several)
        if state is None:
            main, side = EntityTable(quads, materialize, several), None
        else:
            of_state = has_local_name(F.col("predicate"), sorted(STATE))
            main = EntityTable(quads.filter(~of_state).unionByName(state.filter(of_state)), materialize, several)
            side = EntityTable(state, materialize, several)

        def table(name: str) -> EntityTable:
            return side if side is not None and name in STATE_VIEWS else main

        views: dict[str, ViewSource] = {name: (lambda n=name: table(n).view(n)) for name in VIEWS}
        views |= {name: (lambda n=name: table(n).edge(n)) for name in EDGES}
        # Class quads are left out: a class is never the target of an association, and its objects are hot keys.
        views["link"] = lambda: quads.filter("object_kind <> 'literal' AND predicate <> 'rdf:type'").select(
            "subject", "predicate", "object"
        )
        views["vocabulary"] = lambda: quads.filter(
            local_name(F.col("predicate")).isin("domain", "dataType", "stereotype", "label")
        ).select("subject", local_name(F.col("predicate")).alias("property"), "object", "lang")
        if state is not None:
            for name in ("full_model", "model_profile", "model_dependency"):
                kind = "edge" if name in EDGES else "view"
                views[f"state_{name}"] = lambda n=name, k=kind: getattr(side, k)(n)
        typed = {name: (lambda n=name: table(n).typed(n)) for name in VIEWS}
        return cls(views, mappers, typed=typed)

    def save(self, folder: str, names: Iterable[str] | None = None, derive: bool = True) -> GridModel:
        """Write views as Parquet and return a model that reads them back.

        With `derive`, sub-plans that many reports share are written as well, from the stored views. They are
        used as long as none of the views they were derived from is written again.
        """
        chosen = list(names or self.names())
        views = {name: self[name] for name in chosen}
        spark = views[chosen[0]].sparkSession
        # A new stamp before the data: whatever was derived from the old data is out of date from here on.
        stored.stamp(spark, folder, chosen)
        # The jobs are independent; submitting a few at a time keeps the cluster busy at their tails.
        with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
            list(pool.map(lambda n: _stored(views[n]).write.mode("overwrite").parquet(f"{folder}/{n}"), chosen))
        if derive:
            stored.derive(GridModel.load(spark, folder, chosen), folder)
        return GridModel.load(spark, folder, chosen, self.mappers)

    def save_buckets(
        self, folder: str, buckets: int, names: Iterable[str] | None = None, prefix: str = "default.grid_"
    ) -> GridModel:
        """Write views as tables bucketed and sorted by their join key.

        Terminals then join their flows, and equipment its status and limits, without an exchange.
        """
        chosen = list(names or self.names())
        spark = self[chosen[0]].sparkSession
        for name in chosen:
            view, key = _stored(self[name]), BUCKET_KEYS.get(name, "id")
            writer = view.write.mode("overwrite").option("path", f"{folder}/{name}")
            if key in view.columns and not isinstance(view.schema[key].dataType, ArrayType):
                writer = writer.bucketBy(buckets, key).sortBy(key)
            writer.saveAsTable(f"{prefix}{name}")
        return GridModel({name: (lambda n=name: EntityView.loaded(n, spark.table(f"{prefix}{n}"))) for name in chosen}, self.mappers)

    @classmethod
    def load(cls, spark: SparkSession, folder: str, names: Iterable[str], mappers: Iterable[Mapper] = ()) -> GridModel:
        names = list(names)
        views = {name: (lambda n=name: EntityView.loaded(n, spark.read.parquet(f"{folder}/{n}"))) for name in names}
        return cls(views, mappers, stored.valid(spark, folder, names))

    def to_quads(self, graph: str, names: Iterable[str] | None = None) -> DataFrame:
        """The views as one quad table."""
        chosen = [n for n in (names or self.names()) if n in VIEWS or n in EDGES]
        tables = [(view_quads if n in VIEWS else edge_quads)(n, self[n], graph) for n in chosen]
        # Rows that differ in one column only repeat the facts of the others.
        each = [t.distinct() if isinstance(self[n], EntityView) else t for n, t in zip(chosen, tables)]
        return reduce(DataFrame.unionByName, each)

    def register(self, prefix: str = "") -> None:
        """Expose the views to spark.sql for user-written queries."""
        for name in self.names():
            self[name].createOrReplaceTempView(f"{prefix}{name}")
