"""A Python function over the rows of a table, in parallel, whose failures are rows and not the end of the job."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

log = logging.getLogger(__name__)

#: Results that wait in a task until they are handed on.
HELD = 500


def map_rows(df: DataFrame, work: Callable[[Mapping[str, Any]], Mapping[str, Any]], schema: str | T.StructType) -> DataFrame:
    """row (a struct of the row), result (a struct of ``schema``) and error (null where ``work`` went well) of each row of ``df``.

    ``work`` gets a row as a mapping and returns one of the columns of ``schema``.  Any exception of it is told in ``error``
    with its kind; rows keep their partitions, nothing is shuffled, and at most ``HELD`` results wait in a task.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = df.select(F.struct("*").alias("row"))
    out = T.StructType([rows.schema["row"], T.StructField("result", kind), T.StructField("error", T.StringType())])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            for a in range(0, batch.num_rows, HELD):
                part, results, errors = column.slice(a, HELD), [], []
                for row in part.to_pylist():
                    try:
                        results.append(dict(work(row)))
                        errors.append(None)
                    except Exception as e:  # noqa: BLE001  (whatever the function raises is the row's own)
                        results.append(None)
                        errors.append(f"{type(e).__name__}: {e}")
                yield pa.RecordBatch.from_arrays([part.cast(arrow.field(0).type), pa.array(results, arrow.field(1).type), pa.array(errors, pa.string())], schema=arrow)

    return rows.mapInArrow(run, out)


def succeeded(mapped: DataFrame) -> DataFrame:
    """The row's columns and the result's, of the rows without an error."""
    return mapped.where("error is null").select("row.*", "result.*")


def failures(mapped: DataFrame) -> DataFrame:
    """The row's columns and the error, of the others."""
    return mapped.where("error is not null").select("row.*", "error")
