"""Writers. Nothing overwrites a path that the same job reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.contracts import required
from fieldtally.operators.ordering import keep_one
from fieldtally.session import file_system


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """``old`` with the rows of ``new`` inserted or replaced by key.

    Among new rows of one key the last in ``seq`` wins; ``seq`` columns that
    ``old`` lacks are not part of the result. A NULL in a key of ``new`` fails
    the job.
    """
    cols = old.columns
    latest = keep_one(required(new, keys, "upsert"), keys, seq, "last").select(*cols)
    return old.join(latest.select(*keys), list(keys), "left_anti").select(*cols).unionByName(latest)


def write_table(df: DataFrame, path: str) -> None:
    """Parquet, replacing what was there."""
    df.write.mode("overwrite").parquet(path)


def write_upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], seq: Sequence[str], path: str) -> None:
    """Write the merged table to a fresh path; point readers there once it is complete."""
    upsert(old, new, keys, seq).write.mode("errorifexists").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "append") -> None:
    """Parquet split into one folder per value of ``by``.

    Rows are rebalanced by value first: small values share tasks, a huge value
    is split over several files.
    """
    df.hint("rebalance", by).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_tables_by_value(
    df: DataFrame, path: str, by: str, columns: Mapping[str, Sequence[str]], order: Sequence[Column] = ()
) -> None:
    """One CSV table per value of ``by``, each with its own columns, all in one job.

    Every row is rendered with the columns of its value that exist, and goes
    to its value's folder. A value's rows are in ``order`` over its part files
    by name; its header line is in the file ``_header`` beside them, which
    Spark's readers pass over. Rows of other values are left out.
    """
    have = set(df.columns)
    present = {value: [c for c in dict.fromkeys(cols) if c in have] for value, cols in columns.items()}
    line = F.lit(None).cast("string")
    for value, cols in present.items():
        line = F.when(F.col(by) == value, F.to_csv(F.struct(*cols), {"emptyValue": '""'})).otherwise(line)
    wanted = df.where(F.col(by).isin(*columns))
    ranged = wanted.repartitionByRange(F.col(by), *order).sortWithinPartitions(F.col(by), *order) if order else wanted.hint("rebalance", by)
    ranged.select(by, line.alias("line")).write.mode("overwrite").partitionBy(by).text(path)
    for value, cols in present.items():
        files, header = file_system(df.sparkSession, f"{path}/{by}={value}/_header")
        stream = files.create(header, True)
        stream.write(bytearray(",".join(cols) + "\n", "utf-8"))
        stream.close()


def read_table_of(spark: SparkSession, path: str, by: str, value: str, types: Mapping[str, T.DataType]) -> DataFrame:
    """One of the tables that ``write_tables_by_value`` wrote, with its header's columns; types by name."""
    folder = f"{path}/{by}={value}"
    files, header = file_system(spark, f"{folder}/_header")
    stream = files.open(header)
    names = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip().split(",")
    stream.close()
    # An empty field is NULL, a quoted empty field is empty text; that takes a NULL mark that no text equals.
    reader = spark.read.schema(T.StructType([T.StructField(n, types[n]) for n in names])).option("nullValue", "\u0001")
    return reader.csv(folder)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row."""
    df.write.mode("overwrite").json(path)


def write_models(models: Mapping[str, object], path: str) -> Mapping[str, str]:
    """Save fitted models under their names; returns {name: folder}."""
    targets = {name: f"{path}/{name}" for name in models}
    for name, model in models.items():
        model.write().overwrite().save(targets[name])
    return targets


def feature_list(names: Mapping[str, Sequence[str]], spark) -> DataFrame:
    """The feature lists of the models as a small table."""
    rows = [(part, i, c) for part, cols in names.items() for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "part string, position int, feature string").orderBy("part", F.col("position"))
