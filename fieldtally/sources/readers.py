"""Scans and feed parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.contracts import MARKET_CSV, MARKET_DOCUMENT, shape
from fieldtally.functions.names import join_names
from fieldtally.operators.project import select_present


def read_parquet(spark: SparkSession, path: str, wanted: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; with ``wanted`` only those columns are read, and names the files lack are skipped."""
    df = spark.read.parquet(path)
    return df if wanted is None else select_present(df, wanted)


def read_contract(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Parquet scan under a fixed schema: columns missing from some or all files read as NULL."""
    return spark.read.schema(schema).parquet(path)


def read_market_csv(spark: SparkSession, path: str, season: int) -> DataFrame:
    """Stored draft-market file, renamed to the standard columns."""
    raw = spark.read.option("header", True).option("enforceSchema", True).schema(MARKET_CSV).csv(path)
    return raw.select(
        F.col("Name").alias("player_name"), F.col("Position").alias("position"),
        F.lit(season).alias("season"), F.col("Overall").alias("adp_overall"),
    )


def read_source(spark: SparkSession, path: str, source: str) -> DataFrame:
    """All columns of a stored market table for one source."""
    return spark.read.parquet(path).where(F.col("source") == source)


def json_records(df: DataFrame, col: str, record: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """One row per object of a JSON array column, its fields as columns."""
    parsed = F.from_json(F.col(col), T.ArrayType(record))
    return df.select(*keep, F.explode(parsed).alias("_r")).select(*keep, "_r.*")


def json_field_records(df: DataFrame, col: str, field: str, record: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """As ``json_records`` for an array held in one field of a JSON object."""
    parsed = F.from_json(F.col(col), T.StructType([T.StructField(field, T.ArrayType(record))]))
    return df.select(*keep, F.explode(parsed[field]).alias("_r")).select(*keep, "_r.*")


def _script_tail(html: Column, variable: str) -> Column:
    return F.regexp_extract(html, rf"(?s)var\s+{variable}\s*=\s*(.*)", 1)


def extract_script_json(
    df: DataFrame, html: str, variable: str, schema: T.DataType, out: str = "document", strict: bool = True
) -> DataFrame:
    """Parse the object assigned to a script variable inside a page; what follows it is ignored.

    ``strict`` fails the job on a page without a readable object. Otherwise a
    missing object is NULL and a broken one has NULL fields.
    """
    mode = {"mode": "FAILFAST"} if strict else {}
    parsed = F.from_json(_script_tail(F.col(html), variable), schema, mode)
    if strict:
        error = F.raise_error(F.lit(f"no object assigned to {variable}"))
        parsed = F.coalesce(parsed, error.cast(schema))
    return df.withColumn(out, parsed)


def extract_script_text(df: DataFrame, html: str, variable: str, out: str) -> DataFrame:
    """The plain value (text or number) assigned to a script variable inside a page; NULL when there is none."""
    literal = F.regexp_extract(F.col(html), rf'var\s+{variable}\s*=\s*("[^"\\]*+(?:\\.[^"\\]*+)*+"|[^;<\s]+)', 1)
    return df.withColumn(out, F.get_json_object(F.concat(F.lit('{"v":'), literal, F.lit("}")), "$.v"))


def market_key(fmt: int | str, source: int | str, size: int | str) -> str:
    """Composite price key."""
    return f"{fmt}::{source}::{size}"


def flatten_market(df: DataFrame, key: str, positions: Sequence[str], document: str = "document",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Players of an embedded market document that have a price under ``key``.

    All of it happens inside the page's arrays: one map from team id to
    abbreviation (the last one listed), the wanted players, their four values.
    Only then does a page become rows, so nothing of it is copied per player.
    """
    teams = F.filter(F.reverse(F.col(f"{document}.teams")), lambda t: t["id"].isNotNull())
    ids = F.transform("_teams", lambda t: t["id"])
    last = F.filter("_teams", lambda t, i: F.array_position(ids, t["id"]) == i + 1)
    abbreviation = F.map_from_entries(F.transform(last, lambda t: F.struct(t["id"], t["abbr"])))
    pick = lambda p: p["adps"][key]["overall_pick_number"]
    priced = F.filter(f"{document}.projections", lambda p: p["position"].isin(*positions) & pick(p).isNotNull())
    # An id of 0 counts as missing.
    team_id = lambda p: F.coalesce(F.nullif(p["team_id"], F.lit(0)), p["team"]["id"])
    player = lambda p: F.struct(
        join_names(p["first_name"], p["last_name"]).alias("player_name"), p["position"].alias("position"),
        F.coalesce(F.element_at("_abbr", team_id(p)), F.lit("")).alias("team"), pick(p).alias("adp_overall"),
    )
    pages = df.withColumn("_teams", teams).withColumn("_abbr", abbreviation)
    return pages.select(*keep, F.explode(F.transform(priced, player)).alias("_p")).select(*keep, "_p.*")


def read_market_page(df: DataFrame, html: str, variable: str, key: str, positions: Sequence[str]) -> DataFrame:
    """Page text to player prices."""
    return flatten_market(extract_script_json(df, html, variable, shape(MARKET_DOCUMENT)), key, positions)


def with_fallback(primary: DataFrame, fallback: DataFrame, on: str) -> DataFrame:
    """All rows of ``primary``, plus the rows of ``fallback`` for periods ``primary`` has nothing for."""
    covered = primary.select(on).distinct()
    return primary.unionByName(fallback.join(covered, on, "left_anti"))
