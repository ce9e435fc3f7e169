"""The wide player-season table and its per-position views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.contracts import unique_periods
from fieldtally.functions.numeric import safe_ratio
from fieldtally.operators.aggregates import mean_across
from fieldtally.operators.joins import (
    join_with_clash, left_join_new_columns, prior_period, semi_relevant, shift_period,
)
from fieldtally.operators.ordering import ordinal, rank_min
from fieldtally.operators.project import select_present
from fieldtally.plans import league
from fieldtally.sources.sinks import write_tables_by_value

KEYS = ("player_id", "season")


def outcomes(stats: DataFrame, relevant: DataFrame, prior: Sequence[str] = ()) -> DataFrame:
    """Players that ever had a price, with points per game, career season, prior values and finish.

    The order matters: ranks only count relevant players, and career seasons
    count from the first stored season. Career and prior values, and the check
    that no season of a player is stored twice, share one shuffle by player,
    the one of the semi-join.
    """
    kept = unique_periods(semi_relevant(stats, relevant, "player_id"), "player_id", "season", "season stats")
    rated = kept.withColumn("ppg", safe_ratio(F.col("fantasy_points_ppr"), F.col("games_played")))
    careers = ordinal(rated, "player_id", "season", "career_season")
    timed = prior_period(careers, "player_id", "season", prior) if prior else careers
    return rank_min(timed, ["season", "position"], "fantasy_points_ppr", "finish")


def mega_table(
    stats: DataFrame,
    market: DataFrame,
    features: DataFrame | None = None,
    sources: Sequence[str] = (league.FEED_SOURCE,),
    stat_cols: Sequence[str] = league.STAT_COLUMNS,
    unpriced: Mapping[str, float] = league.UNPRICED,
    first_season: int = league.FIRST_OUTPUT_SEASON,
    on_clash: str = "drop",
) -> DataFrame:
    """One row per relevant player-season with outcome, market, current and prior-season columns.

    Prior stats present on both the stats and the feature side disappear under
    ``on_clash="drop"``; ``"left"`` keeps the stats copy. Early seasons only
    feed the prior columns and are cut at the end.
    """
    market = market.where(F.col("source").isin(*sources))
    prior_cols = ["ppg", *[c for c in stat_cols if c in stats.columns]]
    rows = outcomes(stats, market, prior_cols)
    rows = rows.join(mean_across(market, KEYS, list(league.MARKET_COLUMNS)), list(KEYS), "left")
    if features is not None:
        rows = left_join_new_columns(rows, features, KEYS)
        rows = join_with_clash(rows, shift_period(features, KEYS, "season"), KEYS, "left", on_clash)
    rows = rows.fillna(dict(unpriced))
    deltas = {"ppg_delta": ("ppg", "prev_ppg"), "pts_delta": ("fantasy_points_ppr", "prev_fantasy_points_ppr")}
    rows = rows.withColumns({out: F.col(now) - F.col(before) for out, (now, before) in deltas.items()})
    return rows.where(F.col("season") >= first_season)


def position_columns(
    position: str, stats: Mapping[str, Sequence[str]] = league.POSITION_STATS,
    features: Mapping[str, Sequence[str]] = league.POSITION_FEATURES,
) -> list[str]:
    """Ordered column list of one position's table."""
    current = [*stats[position], *features[position]]
    return [*league.POSITION_BASE, *current, *[f"prev_{c}" for c in current]]


def position_table(
    mega: DataFrame, position: str, columns: Sequence[str] | None = None, ordered: bool = True
) -> DataFrame:
    """One position's rows and columns, by season and finish (players without a finish last)."""
    wanted = columns or position_columns(position)
    rows = mega.where(F.col("position") == position)
    if ordered:
        rows = rows.orderBy("season", F.asc_nulls_last("finish"), "player_id")
    return select_present(rows, wanted)


def write_position_tables(mega: DataFrame, path: str, columns: Mapping[str, Sequence[str]] | None = None) -> None:
    """The tables of all positions as CSV, by season and finish, in one job."""
    lists = columns or {p: position_columns(p) for p in league.POSITIONS}
    write_tables_by_value(mega, path, "position", lists, [F.col("season"), F.asc_nulls_last("finish"), F.col("player_id")])
