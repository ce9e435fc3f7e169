"""What the physical plans may and may not contain."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from fieldtally.bindings import catalog
from fieldtally.bindings import tables as t
from fieldtally.operators import joins, ordering
from fieldtally.operators.aggregates import weighted_mean
from fieldtally.plans import features as feat

FITTED = ("m6_", "m6b_", "m7_", "m13_", "m15_", "m15b_", "q10_", "t5_", "s19_")
PLANNED = [n for n in catalog.queries() if not n.startswith(FITTED)]


@pytest.mark.parametrize("name", [
    "flagship_season_outcomes", "q1_season_stats", "q2_feed_prices", "q3_page_prices", "q7_play_features", "q8_mega_table",
    "p9a_normalize_name_long", "s8_flatten_market", "a18_exact_median", "m14_metrics_per_position"])
def test_no_python_and_no_cross_join(spark, plan, name):
    text = plan(catalog.queries()[name](spark, SMALL))
    assert not re.search(r"Python|Pandas|ArrowEval|CartesianProduct", text), text


def test_pruned_scan_reads_only_wanted_columns(spark, plan):
    text = plan(catalog.queries()["s2_pruned_scan"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in text


def test_filters_reach_the_scan(spark, plan):
    text = plan(t.table(spark, SMALL, "orders").where("o_orderstatus = 'F'").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text


def test_cutoff_limits_groups_before_the_shuffle(spark, plan):
    rows = t.weekly(spark, SMALL).dropna(subset=["targets"])
    text = plan(ordering.rank_cutoff(rows, ["season"], "targets", 12, "cut"))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_prior_values_and_careers_share_one_shuffle(spark, plan):
    rows = t.season_files(spark, SMALL).select("player_id", "season", "games")
    both = joins.prior_period(ordering.ordinal(rows, "player_id", "season", "n"), "player_id", "season", ["games"])
    alone = plan(rows).count("Exchange")
    assert plan(both).count("Exchange hashpartitioning(player_id") - plan(rows).count("Exchange hashpartitioning(player_id") <= 1
    assert plan(both).count("Exchange") - alone <= 1


def test_unique_frames_merge_without_a_second_shuffle(spark, plan):
    keys = ["player_id", "season"]
    frames = {
        label: weighted_mean(f.withColumnsRenamed({"player_gsis_id": "player_id"}), keys, t.TRACKING[label][1], t.TRACKING[label][0])
        for label, f in t.tracking(spark, SMALL).items()
    }
    text = plan(joins.outer_join_suffix(frames, keys, unique_keys=True))
    assert text.count("Exchange hashpartitioning") == 3 and "Join" not in text


def test_play_features_scan_the_plays_once(spark, tmp_path, monkeypatch):
    plays = t.raw_plays(spark, SMALL)
    path = str(tmp_path / "plays")
    plays.write.parquet(path)
    settled = []

    def record(df, *_):
        settled.append(df._jdf.queryExecution().executedPlan().toString())
        return original(df)

    original = feat.settle
    monkeypatch.setattr(feat, "settle", record)
    result = feat.play_features(spark.read.parquet(path))
    assert len(settled) == 1 and settled[0].count("FileScan") == 1
    assert path not in result._jdf.queryExecution().executedPlan().toString()


def test_name_match_can_split_both_sides(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        feed, roster = t.feed(spark, SMALL), t.parts_roster(spark, SMALL)
        matched, missing = joins.match_entities(feed, roster, "player_name", ["position"])
        assert "Inner" in plan(matched) and "LeftAnti" in plan(missing)
        assert "BroadcastHashJoin" not in plan(matched)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_the_slice_offsets_are_forced_to_broadcast(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select((F.col("id") % 5).alias("g"), F.col("id").alias("v"))
        assert plan(ordering.rank_min(df, ["g"], "v", "r")).count("BroadcastHashJoin") == 1
        for name in ("q1_season_stats", "q5_tracking_features", "j5_entity_match", "q6_snap_features"):
            assert "BroadcastHashJoin" not in plan(catalog.queries()[name](spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_market_pages_become_rows_without_their_teams(spark, plan):
    """The team list is used inside the page; what is exploded holds four values a player."""
    from fieldtally.bindings.scan_queries import full_pages

    text = plan(catalog.queries()["s8_flatten_market"](spark, SMALL))
    above = text.split("Generate")[0]
    assert "teams" not in above and "document" not in above
    assert full_pages(spark, SMALL).count() * 10 < t.table(spark, SMALL, "customer").count()


@pytest.mark.parametrize("name", ["j12_dominant_team_denominators", "j13_outer_receiver_rusher"])
def test_play_joins_scan_the_plays_once(spark, name, monkeypatch):
    settled = []
    original = feat.settle
    monkeypatch.setattr(feat, "settle", lambda df, *a: settled.append(df._jdf.queryExecution().executedPlan().toString()) or original(df, *a))
    result = catalog.queries()[name](spark, SMALL)
    assert len(settled) == 1 and settled[0].count("lineitem.parquet") == 1
    assert "lineitem.parquet" not in result._jdf.queryExecution().executedPlan().toString()
