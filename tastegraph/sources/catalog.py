"""Product catalogues in CSV and the parquet tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tastegraph.session import prepare

PRODUCT_SCHEMA = StructType(
    [
        StructField("title", StringType()),
        StructField("description", StringType()),
        StructField("categories", StringType()),
    ]
)


def csv_catalog_scan(
    spark: SparkSession, path: str, schema: StructType = PRODUCT_SCHEMA, multi_line: bool = True
) -> DataFrame:
    """Read a product CSV with a header row; empty fields are NULL.

    Quotes inside a field are doubled. ``multi_line`` allows line breaks inside quoted
    fields; each file is then read by one task, so keep the catalogue in many files,
    or pass False where no field holds a break and files may be split.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", True)
        .csv(path)
    )


class Tables:
    """Attribute access to the parquet tables of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
