"""Date-partitioned result tables (Parquet) and the raw-log landing area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulse.functions import on_date


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite",
                      dynamic: bool = True) -> None:
    """Write ``df`` under ``path`` partitioned by ``by``.

    With ``dynamic`` only the partitions present in ``df`` are replaced, which is
    what makes a re-run of the same batch idempotent."""
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.partitionBy(*by).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_by_date(spark: SparkSession, path: str, date_col: str, day: str | None) -> DataFrame:
    """Rows of one day; the equality is a partition filter (only that folder is listed
    and read)."""
    return on_date(read_table(spark, path), date_col, day)


def land_raw(lines: DataFrame, path: str, value: str = "value", day_col: str = "dt",
             mode: str = "append") -> None:
    """Persist stamped log lines as text, one folder per day (``dt=yyyy-MM-dd``)."""
    lines.select(value, day_col).write.mode(mode).partitionBy(day_col).text(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """(value, dt) of the landing area."""
    return spark.read.text(path)
