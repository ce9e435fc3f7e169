"""Pipelines over the bound tables, shared by several queries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldtally.bindings import tables as t
from fieldtally.plans import features as feat
from fieldtally.plans.mega import mega_table
from fieldtally.plans.season_stats import season_stats as build_season_stats
from fieldtally.session import settle

ROSTER_ORDER = ("row_date", "row_id")


def season_stats(spark, folder) -> DataFrame:
    return build_season_stats(
        t.weekly(spark, folder), t.roster(spark, folder), t.season_files(spark, folder), ROSTER_ORDER,
        t.SEASONS, t.LAST_WEEKLY, t.ALL_SEGMENTS, t.OVERRIDES,
    )


def tracking_features(spark, folder) -> DataFrame:
    return feat.tracking_features(t.tracking(spark, folder), t.TRACKING)


def snap_features(spark, folder, observation=None) -> DataFrame:
    return feat.snap_features(
        t.snaps(spark, folder), t.snap_roster(spark, folder), ["player_id"], ["WR"], observation=observation
    )


def play_features(spark, folder) -> DataFrame:
    return feat.play_features(t.raw_plays(spark, folder))


def feature_table(spark, folder) -> DataFrame:
    return feat.feature_table(
        feat.seasonal_features(t.seasonal(spark, folder)), tracking_features(spark, folder),
        snap_features(spark, folder), play_features(spark, folder),
    )


def mega(spark, folder, with_features: bool = True, **options) -> DataFrame:
    """The wide table. Stats and features are stored first, as several steps read each of them."""
    features = settle(feature_table(spark, folder), "features") if with_features else None
    return mega_table(
        settle(season_stats(spark, folder), "season-stats"), t.market(spark, folder), features, (t.FEED,), t.STATS,
        first_season=t.FIRST_SEASON, **options,
    )
