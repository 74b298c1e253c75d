"""The reports as registered queries over the star-schema grid."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.grid_sql import grid
from catalog.report_sql import REPORT_SQL
from voltframe.model import GridModel
from voltframe.session import configure
from voltframe.sources.star import star_model

Query = Callable[[SparkSession, str], DataFrame]

# Sums whose last digits depend on the order of addition are rounded on both sides.
ROUNDED = {
    "transformer_branches": {"ploss_2": 4},
    "winding_loss": {"ploss_2": 4},
    "windings": {"p": 4},
    "base_voltage": {"operating_voltage": 4},
    "sv_power_deviation": {"sum_terminal_flow": 4},
    "hvdc": {"r": 3},
}
# Columns that the reports declare as bigint.
WIDE = {
    "transformers": ["end_number"],
    "transformer_windings": ["end_number"],
    "phase_tap_changer": ["neutral_step", "high_step", "low_step"],
}
ARGUMENTS = {"exchange": {"region": "E"}}
# Direct-current equipment meets at nodes of suppliers, where parallel lines occur.
NODE_OF = {"hvdc": "'dn-' || supp"}
# A report that reads the grouped line items six times, mostly whole: they are written once, where each view would
# shuffle all line items again. Others, which use few columns of them, shuffle less without.
GROUPED_ONCE = {"transformer_branches"}


def rounded(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, digits in columns.items()}) if columns else df


def model(spark: SparkSession, folder: str, **options: str | bool) -> GridModel:
    return star_model(configure(spark), folder, **options)


def report(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        options = {"node_of": NODE_OF[name]} if name in NODE_OF else {}
        if name in GROUPED_ONCE:
            options["materialize"] = True
        df = model(spark, folder, **options).report(name, **ARGUMENTS.get(name, {}))
        return rounded(df, ROUNDED.get(name, {}))

    return run


def declared(name: str) -> str:
    """Check SQL of a report with the types it declares."""
    casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in WIDE.get(name, ()))
    return f"SELECT * REPLACE ({casts}) FROM ({REPORT_SQL[name]})" if casts else REPORT_SQL[name]


QUERIES: dict[str, Query] = {f"report_{name}": report(name) for name in REPORT_SQL}
SQL: dict[str, str] = {f"report_{name}": grid(declared(name)) for name in REPORT_SQL}
