"""Draft-market prices matched to player ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.contracts import MARKET_KEY
from fieldtally.functions.names import LONG_SUFFIXES, SHORT_SUFFIXES
from fieldtally.functions.numeric import nan_to_null
from fieldtally.operators.joins import match_entities
from fieldtally.operators.ordering import rank_first
from fieldtally.plans import league
from fieldtally.sources.readers import market_key, read_market_page, with_fallback
from fieldtally.sources.sinks import upsert

# The order in which rows of one player-season are applied: a later price wins.
SEQUENCE = ("adp_overall", "adp_position_rank")
_STORED = ("player_id", "season", "adp_overall", "adp_position_rank", "source")


def position_ranks(feed: DataFrame) -> DataFrame:
    """Rank within season and position by price, ties by name. Done before matching, so unmatched rows hold a rank."""
    order = [F.col("adp_overall").asc_nulls_last(), F.col("player_name").asc()]
    return rank_first(feed, ["season", "position"], order, "adp_position_rank", ["adp_overall", "player_name"])


def market_feed(
    primary: DataFrame, fallback: DataFrame, positions: Sequence[str] = league.POSITIONS
) -> DataFrame:
    """Ranked rows of the feed; the stored file stands in for seasons the feed has no rows for at all."""
    rows = with_fallback(primary, fallback, "season")
    return position_ranks(rows.where(F.col("position").isin(*positions)))


def _stored(rows: DataFrame, source: str) -> DataFrame:
    labelled = rows.withColumn("source", F.lit(source)).select(*_STORED)
    return nan_to_null(labelled).dropna(subset=["player_id"])


def feed_prices(
    primary: DataFrame, fallback: DataFrame, season_stats: DataFrame, positions: Sequence[str] = league.POSITIONS,
    fixes: Mapping[str, str] = league.FEED_NAME_FIXES, source: str = league.FEED_SOURCE,
) -> tuple[DataFrame, DataFrame]:
    """(rows for the market table, unmatched feed rows): players without a match are dropped."""
    ranked = market_feed(primary, fallback, positions)
    matched, unmatched = match_entities(
        ranked, season_stats, "player_name", ["position"], fixes=fixes, suffixes=LONG_SUFFIXES
    )
    return _stored(matched, source), unmatched.orderBy("season", "adp_overall", "player_name")


def page_prices(
    pages: DataFrame, season_stats: DataFrame, html: str = "html", season: int = league.PAGE_MARKET_SEASON,
    positions: Sequence[str] = league.POSITIONS, fixes: Mapping[str, str] = league.PAGE_NAME_FIXES,
    source: str = league.PAGE_SOURCE, prefix: str = league.GENERATED_PREFIX,
) -> tuple[DataFrame, DataFrame]:
    """(matched rows, generated rows): players without a match stay, under an id built from their name."""
    players = read_market_page(pages, html, league.PAGE_VARIABLE, market_key(*league.PAGE_KEY), positions)
    ranked = position_ranks(players.withColumn("season", F.lit(season)))
    everyone, generated = match_entities(
        ranked, season_stats, "player_name", ["position"], fixes=fixes, suffixes=SHORT_SUFFIXES,
        unmatched="generate", prefix=prefix,
    )
    return everyone.withColumn("source", F.lit(source)), generated.withColumn("source", F.lit(source))


def load_prices(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Market table after the upsert; of several prices for one key the largest stays."""
    return upsert(stored, fresh.select(*_STORED), MARKET_KEY, SEQUENCE)
