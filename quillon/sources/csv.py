"""CSV source and sink with an enforced schema.

``read_csv`` uses the given ``StructType`` (no inference pass over the data)
in PERMISSIVE mode: a field that does not parse becomes null, a short row gets
trailing nulls, extra fields are dropped, an empty field is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.session import staging_path


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, sep: str = ",", **options: str) -> DataFrame:
    return (
        spark.read.options(**options).option("header", header)
        .option("mode", "PERMISSIVE")
        .option("sep", sep)
        .schema(schema)
        .csv(path)
    )


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, sep: str = ",", bad: str = "bad_line") -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, quarantined lines with what could be read of them and the line in column ``bad``).

    A line is quarantined if it has fewer or more fields than the schema, or a field that
    does not parse as its type. An empty field is null and no fault. The lines are read once, with all
    fields (a scan of some fields would miss faults in the others), into a table in the shared folder.
    """
    whole = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    staged = staging_path(spark, "csv-checked")
    read_csv(spark, path, whole, header, sep, columnNameOfCorruptRecord=bad).write.parquet(staged)
    rows = spark.read.schema(whole).parquet(staged)
    return rows.where(F.col(bad).isNull()).drop(bad), rows.where(F.col(bad).isNotNull())


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    df.write.mode("overwrite").option("header", header).csv(path)
    return path
