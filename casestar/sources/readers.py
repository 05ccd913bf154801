"""Readers. Schemas are declared, never inferred."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from casestar.config import RAW_TO_PUBLISHED
from casestar.schemas import RESULTS, all_strings


def read_raw_csv(spark: SparkSession, path: str, names=None, multi_line: bool = False) -> DataFrame:
    """Every column as text, named by the header. A missing path fails.

    Quoted fields follow RFC 4180: a doubled quote is a quote, a backslash is a backslash. A file
    whose header differs from the others' (or from ``names``, which saves looking it up) fails.
    Line breaks inside quotes take ``multi_line``, which reads each file in one task.
    """
    reader = (spark.read.option("header", "true").option("escape", '"')
              .option("enforceSchema", "false").option("multiLine", multi_line))
    if names is not None:
        reader = reader.schema(all_strings(names))
    return reader.csv(path)


def read_standard_csv(spark: SparkSession, path: str) -> DataFrame:
    """A file that holds exactly the columns the warehouse reads."""
    return read_raw_csv(spark, path, RAW_TO_PUBLISHED)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_result_csv(spark: SparkSession, path: str, result: str | T.StructType) -> DataFrame:
    """A published result by its name or schema; an empty frame if it was never written."""
    schema = RESULTS[result] if isinstance(result, str) else result
    try:
        return (spark.read.schema(schema).option("header", "true").option("escape", '"')
                .option("enforceSchema", "false").csv(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no result at {path}", stacklevel=2)
        return spark.createDataFrame([], schema)
