"""One row of totals per player and season."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from fieldtally.contracts import SEASON_STATS_KEY, required
from fieldtally.functions.names import override_by_key
from fieldtally.functions.numeric import nan_to_null
from fieldtally.operators.aggregates import rollup_period
from fieldtally.operators.ordering import keep_one
from fieldtally.operators.project import conform, select_present, stack_frames
from fieldtally.plans import league
from fieldtally.sources.keyed import KeyedTable

# Columns of the stored table that must not be NULL.
REQUIRED = ("player_id", "season", "full_name", "position")


def weekly_totals(weekly: DataFrame, seasons: Sequence[int], sums: Sequence[str] = league.WEEKLY_SUMS) -> DataFrame:
    """Regular-season weeks summed to seasons."""
    regular = weekly.where((F.col("season_type") == "REG") & F.col("season").isin(*seasons))
    totals = rollup_period(regular, SEASON_STATS_KEY, "week", [c for c in sums if c in weekly.columns])
    return totals.withColumnsRenamed({"attempts": "pass_attempts"})


def season_roster(
    roster: DataFrame, order: Sequence[str], positions: Sequence[str] = league.POSITIONS,
    overrides: Mapping[str, str] = league.POSITION_OVERRIDES,
) -> DataFrame:
    """The last roster entry of each player-season. Overrides come after the position filter."""
    listed = roster.where(F.col("position").isin(*positions)).dropna(subset=["player_id"])
    fixed = listed.withColumn("position", override_by_key(F.col("player_id"), F.col("position"), overrides))
    last = keep_one(fixed, SEASON_STATS_KEY, order, "last")
    return last.select("player_id", "season", F.col("player_name").alias("full_name"), "position", "team")


def season_file(
    df: DataFrame, positions: Sequence[str] = league.POSITIONS, overrides: Mapping[str, str] = league.POSITION_OVERRIDES
) -> DataFrame:
    """Rows of the newer files, which already hold season totals for all season types listed in them."""
    listed = conform(
        df.where(F.col("position").isin(*positions)), league.SEASON_FILE_RENAMES, league.SEASON_STATS_COLUMNS
    )
    return listed.withColumn("position", override_by_key(F.col("player_id"), F.col("position"), overrides))


def season_stats(
    weekly: DataFrame | None,
    roster: DataFrame | None,
    season_files: DataFrame | None,
    roster_order: Sequence[str] = ("row",),
    seasons: Sequence[int] = league.STATS_SEASONS,
    last_weekly: int = league.LAST_WEEKLY_SEASON,
    positions: Sequence[str] = league.POSITIONS,
    overrides: Mapping[str, str] = league.POSITION_OVERRIDES,
    sums: Sequence[str] = league.WEEKLY_SUMS,
) -> DataFrame:
    """Totals of weekly seasons joined with their roster, plus the seasons of the newer files.

    A row without key, name or position fails the job.
    """
    frames = []
    if weekly is not None and roster is not None:
        old = [s for s in seasons if s <= last_weekly]
        people = season_roster(roster.where(F.col("season").isin(*old)), roster_order, positions, overrides)
        frames.append(weekly_totals(weekly, old, sums).join(people, list(SEASON_STATS_KEY), "inner"))
    if season_files is not None:
        new = [s for s in seasons if s > last_weekly]
        frames.append(season_file(season_files.where(F.col("season").isin(*new)), positions, overrides))
    rows = nan_to_null(select_present(stack_frames(frames), league.SEASON_STATS_COLUMNS))
    return required(rows, REQUIRED, "season stats")


def season_stats_table(spark: SparkSession, path: str, schema: StructType) -> KeyedTable:
    """The stored table: a folder per season, so a load writes the seasons it brings."""
    must = [StructField(f.name, f.dataType, f.name not in REQUIRED) for f in schema]
    return KeyedTable(spark, path, StructType(must), SEASON_STATS_KEY, "season")


def load_season_stats(stored: KeyedTable, fresh: DataFrame, seq: Sequence[str]) -> list[str]:
    """Upsert fresh rows, the last step of a load; returns the seasons written."""
    return stored.upsert(fresh, seq)
