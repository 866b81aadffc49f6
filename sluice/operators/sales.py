"""Sales records: typed CSV rows to the relational sales table.

The table has an auto-increment ``id`` (1, 2, ... in ``order_id`` order,
assigned by the distributed dense index), the CSV columns renamed by
position, and NOT NULL checks on the columns the table declares so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluice.operators.reshape import dense_index, rename_positional
from sluice.sinks.numbered import commit_numbered
from sluice.sinks.writers import enforce_schema, write_typed_table
from sluice.sources.files import MONEY, read_sales_csv

# Column names of the sales table, in table order after ``id``.
SALES_TABLE_COLUMNS = ["region", "country", "item_type", "sales_channel", "Order Priority", "order_date",
                       "order_id", "ship_date", "units_sold", "unit_price", "unit_cost", "total_revenue",
                       "total_cost", "total_profit"]
SALES_TABLE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("item_type", T.StringType()),
    T.StructField("sales_channel", T.StringType()),
    T.StructField("Order Priority", T.StringType()),
    T.StructField("order_date", T.DateType(), False),
    T.StructField("order_id", T.LongType(), False),
    T.StructField("ship_date", T.DateType(), False),
    T.StructField("units_sold", T.IntegerType(), False),
    T.StructField("unit_price", MONEY, False),
    T.StructField("unit_cost", MONEY, False),
    T.StructField("total_revenue", MONEY, False),
    T.StructField("total_cost", MONEY, False),
    T.StructField("total_profit", MONEY, False),
])


def sales_table(csv_rows: DataFrame) -> DataFrame:
    """CSV-named rows to the typed table rows with an auto-increment id."""
    renamed = rename_positional(csv_rows, SALES_TABLE_COLUMNS)
    with_id = dense_index(renamed, ["order_id"], name="id", start=1)
    return enforce_schema(with_id, SALES_TABLE_SCHEMA)


def load_sales(spark: SparkSession, csv_path: str, table_path: str) -> DataFrame:
    """Drop and re-create the sales table from a sales CSV; returns the stored table."""
    write_typed_table(sales_table(read_sales_csv(spark, csv_path)), table_path, SALES_TABLE_SCHEMA)
    return spark.read.parquet(table_path)


def append_sales(spark: SparkSession, csv_path: str, table_path: str, run: str) -> dict:
    """Append a sales CSV to a versioned sales table as run ``run``; ids go on where the last load ended.

    A run that is loaded again keeps its rows' ids and adds none. Returns the
    run's block of ids.
    """
    renamed = rename_positional(read_sales_csv(spark, csv_path), SALES_TABLE_COLUMNS)
    return commit_numbered(renamed, table_path, ["order_id"], "id", run, finish=lambda rows: enforce_schema(rows, SALES_TABLE_SCHEMA))
