"""Layer by layer: stage every model, test the staged rows, publish."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..operators.checks import Check, check_contract, run_checks
from ..schemas import CONTRACTS
from ..sinks.state import StateLog
from ..sinks.versioned import VersionedTable
from . import data_tests, gold, silver

Models = Mapping[str, DataFrame]
Model = Callable[[Models], DataFrame]

# Each layer is a list of waves; models of a wave do not depend on each other.
SILVER_WAVES: list[dict[str, Model]] = [
    {
        "silver_customers": lambda m: silver.silver_customers(m["pg_customers"]),
        "silver_sellers": lambda m: silver.silver_sellers(m["pg_sellers"]),
        "silver_products": lambda m: silver.silver_products(m["pg_products"], m["api_translations"]),
        "silver_geolocation": lambda m: silver.silver_geolocation(m["api_geolocation"]),
        "silver_orders": lambda m: silver.silver_orders(m["pg_orders"]),
        "silver_order_items": lambda m: silver.silver_order_items(m["pg_order_items"]),
        "silver_order_payments": lambda m: silver.silver_order_payments(m["stream_order_payments"]),
    },
    {
        "silver_order_reviews": lambda m: silver.silver_order_reviews(
            m["stream_order_reviews"], m["silver_orders"]),
    },
]
GOLD_WAVES: list[dict[str, Model]] = [
    {
        "dim_customers": lambda m: gold.dim_customers(m["silver_customers"], m["silver_geolocation"]),
        "dim_sellers": lambda m: gold.dim_sellers(m["silver_sellers"], m["silver_geolocation"]),
        "dim_products": lambda m: gold.dim_products(m["silver_products"]),
    },
    {
        "fact_orders": lambda m: gold.fact_orders(m["silver_orders"], m["dim_customers"]),
        "fact_order_items": lambda m: gold.fact_order_items(
            m["silver_order_items"], m["silver_orders"], m["dim_customers"],
            m["dim_products"], m["dim_sellers"]),
        "fact_payments": lambda m: gold.fact_payments(
            m["silver_order_payments"], m["silver_orders"], m["dim_customers"]),
        "fact_reviews": lambda m: gold.fact_reviews(
            m["silver_order_reviews"], m["silver_orders"], m["dim_customers"]),
    },
]
LAYERS: list[tuple[str, list[dict[str, Model]], list[Check]]] = [
    ("silver", SILVER_WAVES, data_tests.SILVER),
    ("gold", GOLD_WAVES, data_tests.GOLD),
]


def compose(inputs: Models, wanted: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """All models as one lazy plan each, nothing written."""
    models = dict(inputs)
    for _, waves, _ in LAYERS:
        for wave in waves:
            for name, model in wave.items():
                models[name] = model(models)
    names = wanted or [n for n in models if n not in inputs]
    return {n: models[n] for n in names}


@dataclass
class BuildResult:
    models: dict[str, DataFrame] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    reports: list[DataFrame] = field(default_factory=list)
    published: list[str] = field(default_factory=list)
    failed_layer: str | None = None

    @property
    def report(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.reports)


def table_of(spark: SparkSession, warehouse: str, layer: str, model: str) -> VersionedTable:
    """A model's table. All tables of a layer are published through one log."""
    folder = f"{warehouse.rstrip('/')}/{layer}"
    return VersionedTable(spark, f"{folder}/{model}", StateLog(spark, f"{folder}/published"), model)


def build(spark: SparkSession, warehouse: str, inputs: Models, parallel: int = 4) -> BuildResult:
    """Build silver, then gold, from bronze ``inputs``.

    Models are written once and read back by whatever follows, tests included.
    A layer is published as a whole, when none of its error tests fails; a
    failure also stops the layers after it. Warnings never stop anything.
    """
    result = BuildResult()
    models = dict(inputs)

    def stage(layer: str, name: str, df: DataFrame) -> tuple[str, str, int, DataFrame]:
        if name in CONTRACTS:
            check_contract(name, df, CONTRACTS[name])
        table = table_of(spark, warehouse, layer, name)
        version, rows = table.stage(df)
        return name, version, rows, table.read(version, df.schema)

    with ThreadPoolExecutor(parallel) as pool:
        for layer, waves, checks in LAYERS:
            versions: dict[str, str] = {}
            for wave in waves:
                plans = [(layer, name, model(models)) for name, model in wave.items()]
                for name, versions[name], result.rows[name], stored in pool.map(lambda p: stage(*p), plans):
                    models[name] = result.models[name] = stored

            # One row per test, so the outcome is small whatever the tables hold.
            tested = run_checks(models, checks)
            outcome = tested.collect()
            report = spark.createDataFrame(outcome, tested.schema).coalesce(1)
            _, report_version, _, stored = stage(layer, "test_report", report)
            result.reports.append(stored)
            log = table_of(spark, warehouse, layer, "test_report").published
            if any(r["status"] == "fail" for r in outcome):
                log.put("test_report", report_version)
                result.failed_layer = layer
                break
            log.put_all({**versions, "test_report": report_version})
            result.published += list(versions)
    return result
