"""Whole jobs over a folder of entity files.

The folder holds users, categories, products and transactions as JSON or Parquet
and the sessions in a folder of their own. Each job is one or a few writes; no
rows pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopwright import sinks
from shopwright.operators import catalog, cells, customers, sales
from shopwright.operators import sessions as S
from shopwright.sources.entities import read_cells, read_entity


# Fixed value: versions that the tables keep of each cell.
KEPT_VERSIONS = 3


class EntityFolder:
    """Entities of one data folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str, fmt: str = "json"):
        self.spark, self.folder, self.fmt = spark, folder.rstrip("/"), fmt

    def _read(self, entity: str) -> DataFrame:
        name = entity if entity == "sessions" else f"{entity}.{self.fmt}"
        return read_entity(self.spark, entity, f"{self.folder}/{name}", self.fmt)

    @property
    def users(self) -> DataFrame:
        return self._read("users")

    @property
    def categories(self) -> DataFrame:
        return self._read("categories")

    @property
    def products(self) -> DataFrame:
        return self._read("products")

    @property
    def transactions(self) -> DataFrame:
        defaults = {"discount": 0.0, "session_id": "none"}
        return sales.fill_defaults(self._read("transactions"), defaults)

    @property
    def sessions(self) -> DataFrame:
        return self._read("sessions")


def load_documents(data: EntityFolder, out: str) -> None:
    """Append users with purchase summaries, products with categories, and transactions."""
    sinks.append(customers.user_summary(data.users, data.transactions), f"{out}/users")
    sinks.append(catalog.product_catalog(data.products, data.categories), f"{out}/products")
    sinks.append(data.transactions, f"{out}/transactions")


def load_session_rows(data: EntityFolder, out: str, version: Column | None = None) -> None:
    """Append all sessions to the cell table ``out``; a later load wins over an earlier one."""
    version = cells.write_time() if version is None else version
    sinks.write_cells(cells.session_cells(data.sessions, version), out)


def compact(spark: SparkSession, table: str, out: str, versions: int = KEPT_VERSIONS) -> None:
    """Write the newest versions of each cell of ``table`` to the new table ``out``."""
    sinks.write_cells(cells.retain_versions(read_cells(spark, table), versions), out, "error")


def metrics(data: EntityFolder) -> dict[str, DataFrame]:
    """The published aggregates by name, each as key and value columns."""
    items = sales.explode_items(data.transactions)
    segments = customers.purchase_segments(customers.user_summary(data.users, data.transactions))
    return {
        "products_metrics": sales.top_products(items),
        "sales_by_category": sales.revenue_by_category_order_total(items, data.products),
        "revenue_by_category": sales.revenue_by_category(items, data.products),
        "revenue_by_state": sales.revenue_by_state(data.users, data.transactions),
        "sales_over_time": sales.daily_sales(data.transactions),
        "funnel_metrics": S.conversion_funnel(data.sessions),
        "user_segmentation": segments,
    }


def publish_metrics(data: EntityFolder, out: str, version: Column | None = None) -> None:
    """Append each aggregate to its own cell table under ``out``."""
    version = cells.write_time() if version is None else version
    for name, df in metrics(data).items():
        key, value = df.columns[:2]
        family = "revenue" if value == "total_revenue" else "metrics"
        qualifier = "total" if value == "total_revenue" else value
        written = cells.metric_cells(df, key, value, family, qualifier, version)
        sinks.append(written, f"{out}/{name}")


def lifetime_values(
    data: EntityFolder, start, end, as_of, *, cell_table: str | None = None, mode: str = "current"
) -> DataFrame:
    """Ranked customers; engagement comes from the cell table if one is given."""
    people = data.users.select("user_id", "registration_date")
    if cell_table is None:
        active = customers.engagement(people, data.sessions, start, end)
    else:
        active = cells.engagement_from_cells(people, read_cells(data.spark, cell_table), start, end)
    spent = customers.purchase_totals(data.transactions)
    return customers.customer_lifetime_value(people, spent, active, as_of, mode)


def export_lifetime_values(ranked: DataFrame, out: str, single_file: bool = False) -> None:
    sinks.write_csv(ranked, out, single_file)


def top_customers(ranked: DataFrame, n: int = 10) -> DataFrame:
    return ranked.orderBy(F.desc("clv"), "user_id").limit(n)
