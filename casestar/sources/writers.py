"""Writers for tables, small results and text reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def rebalanced(df: DataFrame, columns) -> DataFrame:
    """Rows of a folder brought together, a folder that is too large for one task split."""
    return df.hint("rebalance", *columns)


def write_partitioned(df: DataFrame, path: str, columns, mode: str = "overwrite") -> None:
    """Folder-partitioned Parquet.

    The rebalance hint brings the rows of a partition together, so a task does not leave one
    small file in every folder, and still splits a partition that is too large for one task.
    """
    write_table(rebalanced(df, columns), path, mode, columns)


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write and read back: later reads see these rows, whatever happens to the executors."""
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_result_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """A result with header. One file suits an aggregate of bounded size."""
    out = df.coalesce(1) if single_file else df
    _csv_writer(out).csv(path)


def write_raw_csv(df: DataFrame, path: str) -> None:
    _csv_writer(df).csv(path)


def _csv_writer(df: DataFrame):
    # the writer would otherwise trim values
    return (df.write.mode("overwrite").option("header", "true").option("escape", '"')
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false"))


def write_text_report(df: DataFrame, path: str, line: str = "line", order=()) -> None:
    """One line per row, right-trimmed, in ``order``. Meant for small reports."""
    rows = df.orderBy(*order) if order else df
    rows.select(F.rtrim(line).alias("value")).coalesce(1).write.mode("overwrite").text(path)
