"""A named query and, where SQL can say the same, its statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.fixtures import Inputs, oracle
from tidemark.model import Catalogue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(inputs) -> DataFrame`` under `name`."""

    def register(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(Inputs(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return build

    return register


def catalogue(inputs: Inputs) -> Catalogue:
    """The reshaped catalogue with every table the queries use."""
    views = {
        "mission": "mission",
        "satellite": "satellite",
        "instrument": "instrument",
        "product": "product_full",
        "instrumentproductlink": "instrumentproductlink",
        "process": "process_full",
        "productprocesslink": "productprocesslink",
        "file": "file",
        "code": "code_full",
        "inspector": "inspector",
        "filefilelink": "filefilelink",
        "filecodelink": "filecodelink",
        "processqueue": "processqueue",
        "release": "release",
    }
    return Catalogue(**{
        table: (lambda view=view: getattr(inputs, view)) for table, view in views.items()
    })
