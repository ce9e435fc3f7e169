"""Table shapes and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Names and types of the columns of the stored tables.
SEASON_STATS = """
    player_id STRING NOT NULL, season INT NOT NULL, full_name STRING NOT NULL, position STRING NOT NULL, team STRING,
    games_played INT, fantasy_points_ppr DOUBLE, completions INT, pass_attempts INT, passing_yards INT,
    passing_tds INT, interceptions INT, carries INT, rushing_yards INT, rushing_tds INT, receptions INT,
    targets INT, receiving_yards INT, receiving_tds INT"""
MARKET = """
    player_id STRING NOT NULL, season INT NOT NULL, adp_overall DOUBLE, adp_position_rank INT, source STRING"""
PLAYS = """
    season INT, week INT, season_type STRING, play_type STRING, posteam STRING, passer_player_id STRING,
    receiver_player_id STRING, rusher_player_id STRING, pass_attempt STRING, rush_attempt STRING, qb_scramble STRING,
    sack STRING, complete_pass STRING, air_yards DOUBLE, yards_after_catch DOUBLE, yardline_100 DOUBLE, cpoe DOUBLE"""
MARKET_CSV = """
    ADP DOUBLE, Overall DOUBLE, Name STRING, Position STRING, Team STRING, Times_Drafted INT, Std_Dev DOUBLE,
    High INT, Low INT, Bye INT"""
PLAY_FEATURES = """
    player_id STRING NOT NULL, season INT NOT NULL, cpoe DOUBLE, air_yards_per_attempt DOUBLE, rz_pass_attempts INT,
    targets INT, rz_targets INT, adot DOUBLE, catch_rate DOUBLE, yac_per_reception DOUBLE, target_share DOUBLE,
    air_yards_share DOUBLE, rz_target_share DOUBLE, carries INT, rz_carries INT, goalline_carries INT,
    rz_carry_share DOUBLE, opportunity_share DOUBLE"""
# One embedded market document: team list, player list, prices keyed by "format::source::size".
MARKET_DOCUMENT = """
    teams ARRAY<STRUCT<id: BIGINT, abbr: STRING>>,
    projections ARRAY<STRUCT<
        first_name: STRING, last_name: STRING, position: STRING, team_id: BIGINT, team: STRUCT<id: BIGINT>,
        adps: MAP<STRING, STRUCT<overall_pick_number: DOUBLE>>>>"""

SEASON_STATS_KEY = ("player_id", "season")
MARKET_KEY = ("player_id", "season", "source")


def shape(ddl: str) -> T.StructType:
    """One of the shapes above as Spark's own type; needs a running session."""
    return T.StructType.fromDDL(ddl)


def required(df: DataFrame, cols: Sequence[str], table: str = "table") -> DataFrame:
    """``df``, whose rows fail the job that reads them where one of ``cols`` is NULL. No job and no shuffle of its own."""
    known = {f.name: f.dataType for f in df.schema}
    checked = {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{table}: {c} is NULL")).cast(known[c])) for c in cols}
    return df.withColumns(checked)


def unique_periods(df: DataFrame, entity: str, period: str, table: str = "table") -> DataFrame:
    """``df``, whose rows fail the job that reads them where an entity has a period twice.

    The check is a window over one entity's periods; next to other windows of
    that kind it shares their shuffle and their sort.
    """
    before = F.lag(period).over(Window.partitionBy(entity).orderBy(period))
    error = F.raise_error(F.format_string(f"{table}: {entity} %s has {period} %s twice", F.col(entity).cast("string"), F.col(period).cast("string")))
    checked = F.when(F.col("_before") == F.col(period), error.cast(df.schema[period].dataType)).otherwise(F.col(period))
    return df.withColumn("_before", before).withColumn(period, checked).select(*df.columns)


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: row count, keys used more than once, surplus rows, and NULLs per key column."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
        *[F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("n"))), F.lit(0)).alias(f"null_{k}") for k in keys],
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_contract(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise unless ``keys`` are present and unique; returns ``df`` for chaining."""
    report = key_report(df, keys).first()
    broken = {c: report[c] for c in report.asDict() if c != "n_rows" and report[c]}
    if broken:
        raise ValueError(f"key {tuple(keys)} violated: {broken}")
    return df


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto a contract: cast what exists, NULL for columns the input lacks."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])
