"""Reports over the wide table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.numeric import nonzero_ratio
from fieldtally.operators.aggregates import correlation, correlations
from fieldtally.operators.ordering import rank_first
from fieldtally.operators.project import columns_with_prefix
from fieldtally.operators.reshape import over_under
from fieldtally.plans import league


def derived_columns(df: DataFrame, tie: Sequence[str] = ("player_id",)) -> DataFrame:
    """Re-derive market fill, career season by name and per-game columns for stored tables.

    Namesakes share a career count here, so a group is not bounded by one
    player's seasons and the split ranking is used.
    """
    filled = df.fillna(dict(league.UNPRICED))
    careers = rank_first(filled.drop("career_season"), ["full_name"], [F.col("season"), *map(F.col, tie)], "career_season", ["season", *tie], unique=True)
    ratio = lambda points, games: nonzero_ratio(F.col(points), F.col(games))
    per_game = careers.withColumns({
        "ppg": ratio("fantasy_points_ppr", "games_played"),
        "prev_ppg": ratio("prev_fantasy_points_ppr", "prev_games_played"),
    })
    return per_game.withColumns({
        "ppg_delta": F.col("ppg") - F.col("prev_ppg"),
        "pts_delta": F.col("fantasy_points_ppr") - F.col("prev_fantasy_points_ppr"),
    })


def market_vs_finish(df: DataFrame, by: Sequence[str] = ("position",)) -> DataFrame:
    """Correlation of the market rank with the actual finish."""
    return correlation(df, "adp_position_rank", "finish", by)


def predictor_correlations(df: DataFrame, by: Sequence[str] = ("position",), target: str = "ppg") -> DataFrame:
    """Correlation of every prior-season and market column with points per game, weakest first."""
    cols = [c for c in df.columns if c.startswith("prev_") or c in league.MARKET_COLUMNS]
    return correlations(df.dropna(subset=[target]), cols, target, by)


def steals_and_busts(
    df: DataFrame, n: int = 10, cols: Sequence[str] = league.VALUE_COLUMNS, ties: Sequence[str] = ("season", "player_id")
) -> tuple[DataFrame, DataFrame]:
    """Players that finished furthest above and below their market rank."""
    return over_under(df, "adp_position_rank", "finish", n, cols, [F.col(t) for t in ties])


def residual_features(df: DataFrame) -> list[str]:
    """Columns known before a season that the market price does not hold."""
    return columns_with_prefix(df, "prev_", ["career_season"])
