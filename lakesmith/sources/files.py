"""File sources and sinks: text-only CSV landing files and Parquet tables.

Landing CSV is read with an explicit all-string schema (the partition column included), so neither
column types nor the Hive partition value are ever inferred. Parquet sinks always overwrite a whole
directory (a rebuild is idempotent); partitioned sinks cluster rows by the partition value first so
each task writes few files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Bytes of input for a slice of a range partitioning.
SLICE_BYTES = 128 << 20
#: The same where rows are written as text, which is many times as wide as the columns that are scanned for it.
TEXT_SLICE_BYTES = 16 << 20


def input_bytes(*frames: DataFrame) -> int:
    """Bytes of the files that the frames scan, whatever is done with them afterwards."""
    total = 0
    for df in frames:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        for leaf in (leaves.apply(i) for i in range(leaves.size())):
            if leaf.getClass().getSimpleName() == "LogicalRelation":
                total += int(str(leaf.stats().sizeInBytes()))
    return total


def slice_count(*frames: DataFrame, slice_bytes: int = SLICE_BYTES) -> int:
    """Slices for an explicit range partitioning, which adaptive execution does not split: one for each ``slice_bytes``
    that the frames scan, and at least ``spark.sql.shuffle.partitions``."""
    least = int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, -(-input_bytes(*frames) // slice_bytes))


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_text_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    partition_columns: Sequence[str] = (),
    record_column: str | None = None,
    header: bool = True,
) -> DataFrame:
    """Scan a CSV directory; every column, partition columns too, is text.

    A file whose header has other names or another order raises; quotes are escaped by doubling.
    With ``header=False`` files have no header row.

    A line with too many or too few fields loses or lacks values. ``record_column`` names one more column that
    holds the whole line of such a row and is NULL for all others; lines stay rows, so none is lost. Spark does not
    scan that column alone: write the classified rows first, or read it with others.

    Leading and trailing blanks are preserved (cleansing decides what to trim); empty fields read
    as NULL.
    """
    schema = text_schema([*columns, *([record_column] if record_column else []), *partition_columns])
    reader = spark.read.schema(schema)
    if record_column:
        # the width of a line is seen only where all its fields are parsed, whatever columns are read
        reader = reader.option("columnNameOfCorruptRecord", record_column).option("columnPruning", False)
    return (
        reader.option("header", header)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _cluster(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.repartitionByRange(slice_count(df), *[F.col(c) for c in columns])


def write_text_csv(
    df: DataFrame, path: str, partition_columns: Sequence[str] = (), cluster_by: Sequence[str] = ()
) -> None:
    """Write text columns as CSV with a header, keeping outer blanks verbatim.

    A partitioned write is cut by the partition value, ``cluster_by`` and a hash of the row, so that one partition value
    is split across tasks however many rows it has; only copies of one row stay together.
    """
    if partition_columns:
        cuts = [F.col(c) for c in (*partition_columns, *cluster_by)]
        df = df.repartitionByRange(slice_count(df, slice_bytes=TEXT_SLICE_BYTES), *cuts, F.xxhash64(*[F.col(c) for c in df.columns]))
    out = (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if partition_columns:
        out = out.partitionBy(*partition_columns)
    out.csv(path)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_columns: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    metrics: Sequence[Column] = (),
) -> dict:
    """Overwrite a Parquet directory; optionally Hive-partitioned.

    ``metrics`` are named aggregates of the written rows, which the write itself observes and which are returned by
    name, so no pass over the table is needed for them. They stand above every shuffle, in the tasks that write the
    files; Spark counts each of these once, whichever attempt of it succeeds.

    For a partitioned write the rows are first *range*-partitioned on the partition value plus
    ``cluster_by`` (for example the row key) into ``slice_count`` slices: every
    task covers a contiguous slice of partition values and writes one file per value it holds,
    while a single very large partition value is still split across several tasks by the sampled
    range bounds. The slice count is explicit because adaptive coalescing would otherwise merge
    small slices into one task that then writes every partition folder serially.
    """
    if partition_columns:
        df = _cluster(df, [*partition_columns, *cluster_by])
    observation = Observation()
    out = (df.observe(observation, *metrics) if metrics else df).write.mode("overwrite")
    (out.partitionBy(*partition_columns) if partition_columns else out).parquet(path)
    return observation.get if metrics else {}


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a Parquet directory; Hive partition folders become columns (typed by ``schema``)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)
