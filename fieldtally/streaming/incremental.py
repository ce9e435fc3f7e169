"""Land only the periods that are not there yet, each of them whole or not at all."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.session import file_system
from fieldtally.sources.sinks import write_partitioned

#: Written into a period's folder last; a folder without it does not count. Spark's readers pass over the name.
MARKER = "_landed"


def landed_periods(spark: SparkSession, path: str, period: str) -> list[str]:
    """Periods of a landed dataset, from the markers in its folders: no data file is opened."""
    files, markers = file_system(spark, f"{path}/{period}=*/{MARKER}")
    names = [entry.getPath().getParent().getName() for entry in files.globStatus(markers) or []]
    return sorted(unquote(name.split("=", 1)[1]) for name in names)


def new_periods(source: DataFrame, landed: list[str], period: str) -> DataFrame:
    """Source rows of periods that have not landed. Rows without a period are left out.

    A filter rather than a join, so that a source partitioned by period skips
    the folders it has already delivered.
    """
    known = source.where(F.col(period).isNotNull())
    if not landed:
        return known
    kind = source.schema[period].dataType
    return known.where(~F.col(period).isin(*[F.lit(value).cast(kind) for value in landed]))


def _publish(rows: DataFrame, path: str, period: str) -> None:
    """Write ``rows`` aside, then move one period after the other into place and mark it.

    What a run that was cut short has left, a folder without a marker or
    files aside, is replaced or removed by the next one.
    """
    spark = rows.sparkSession
    files, target = file_system(spark, path)
    files.mkdirs(target)
    for entry in files.globStatus(file_system(spark, f"{path}/_arriving-*")[1]) or []:
        files.delete(entry.getPath(), True)
    aside = f"{path}/_arriving-{uuid.uuid4().hex}"
    write_partitioned(rows, aside, period)
    for entry in files.globStatus(file_system(spark, f"{aside}/{period}=*")[1]) or []:
        place = file_system(spark, f"{path}/{entry.getPath().getName()}")[1]
        files.delete(place, True)
        if not files.rename(entry.getPath(), place):
            raise OSError(f"could not move {entry.getPath()} to {place}")
        files.create(file_system(spark, f"{place}/{MARKER}")[1], True).close()
    files.delete(file_system(spark, aside)[1], True)


def land_incremental(source: DataFrame, path: str, period: str = "season") -> None:
    """Land the missing periods, one folder each. Running it again changes nothing; one run at a time."""
    _publish(new_periods(source, landed_periods(source.sparkSession, path, period), period), path, period)


def reload_periods(source: DataFrame, path: str, period: str = "season") -> None:
    """Replace exactly the periods present in ``source``."""
    _publish(source.where(F.col(period).isNotNull()), path, period)


def read_landed(spark: SparkSession, path: str, period: str = "season", schema: str | None = None) -> DataFrame:
    """The landed periods; folders that only hold part of one are not read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    landed = landed_periods(spark, path, period)
    return reader.parquet(path).where(F.col(period).cast("string").isin(*landed))
