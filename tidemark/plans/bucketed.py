"""Tables stored by order id, from which facts are built without shuffling them again.

The typed rows of orders, items and payments are appended, load by load, to catalog tables
that are bucketed on the order id. A load shuffles its own rows once. De-duplication by
order id and more, and the joins from an order's rows to its customer, then find
everything of an order in one place, so a build shuffles no history.

All rows of an order lie in one bucket, and no task can split one. Where a single order
may hold more rows than a task can take, build the facts from plain tables (``build``),
whose shuffled joins adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_per_key
from ..session import CODEC
from . import gold, silver

KEY = "order_id"
#: Rows of the largest table that a bucket takes, so that a task sorts it in memory.
BUCKET_ROWS = 1_000_000
#: What is appended: bronze table, typed form.
TYPED: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "orders_by_order": ("pg_orders", silver.typed_orders),
    "items_by_order": ("pg_order_items", silver.typed_order_items),
    "payments_by_order": ("stream_order_payments", silver.typed_order_payments),
}


def buckets_for(rows: int, least: int = 8) -> int:
    """Buckets for tables of which the largest has so many rows."""
    return max(least, -(-rows // BUCKET_ROWS))


class BucketedStore:
    """Tables of ``database``, all in as many buckets; give each a file of some hundred MB."""

    def __init__(self, spark: SparkSession, database: str, buckets: int = 200):
        self.spark, self.database, self.buckets = spark, database, buckets

    def _write(self, name: str, df: DataFrame, mode: str) -> None:
        # Dealt as the buckets are, so that a load adds one file to each of them.
        dealt = df.repartition(self.buckets, KEY)
        dealt.write.option("compression", CODEC).bucketBy(self.buckets, KEY).sortBy(KEY).mode(mode).saveAsTable(f"`{self.database}`.`{name}`")

    def read(self, name: str) -> DataFrame:
        return self.spark.table(f"`{self.database}`.`{name}`")

    def append(self, table: str, batch: DataFrame) -> None:
        """A batch of a bronze table."""
        for name, (bronze, typed) in TYPED.items():
            if bronze == table:
                self._write(name, typed(batch), "append")
                return
        raise KeyError(f"'{table}' is not stored by order")

    def orders(self) -> DataFrame:
        return silver.latest_orders(self.read("orders_by_order"))

    def items(self) -> DataFrame:
        return first_per_key(self.read("items_by_order"), [KEY, "order_item_id"])

    def payments(self) -> DataFrame:
        return first_per_key(self.read("payments_by_order"), [KEY, "payment_sequential"])

    def key_orders(self, customers: DataFrame) -> None:
        """Store the way from each order to its customer, which all facts go: one
        shuffle of a narrow table per build. Unknown customers leave a null id."""
        self._write("customer_of_order", gold.order_customers(self.orders(), customers, "left"), "overwrite")

    def fact_order_items(self, products: DataFrame, sellers: DataFrame) -> DataFrame:
        keyed = self.read("customer_of_order").where(F.col("customer_id").isNotNull()).hint("merge")
        return gold.keyed_order_items(self.items(), keyed, products, sellers)

    def fact_payments(self) -> DataFrame:
        return gold.keyed_payments(self.payments(), self.read("customer_of_order").hint("merge"))
