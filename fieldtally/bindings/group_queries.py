"""Aggregates and rankings."""

from pyspark.sql import functions as F

from fieldtally.bindings import composed as c
from fieldtally.bindings import tables as t
from fieldtally.bindings.join_queries import plays
from fieldtally.bindings.registry import query
from fieldtally.bindings.scalar_queries import totals_of
from fieldtally.bindings.tables import with_views
from fieldtally.operators import aggregates as agg
from fieldtally.operators import ordering
from fieldtally.operators.joins import crosswalk, prior_period
from fieldtally.plans import explore
from fieldtally.plans import features as feat
from fieldtally.plans.market import market_feed
from fieldtally.plans.mega import outcomes
from fieldtally.session import settle

KEYS = ["player_id", "season"]


def rounded(df, *cols, places=6):
    """Even out the last digits, which depend on summation order."""
    return df.withColumns({x: F.round(x, places) for x in cols})


@query("flagship_season_outcomes", with_views("""
    SELECT o.player_id, o.season, o.full_name, o.position, o.games_played, o.fantasy_points_ppr, o.career_season,
           o.finish, o.ppg, p.ppg AS prev_ppg, o.ppg - p.ppg AS ppg_delta
    FROM outcomes o LEFT JOIN outcomes p ON o.player_id = p.player_id AND o.season = p.season + 1
    WHERE o.season >= 1996""", "outcomes"))
def _(spark, folder):
    cols = ["full_name", "position", "games_played", "fantasy_points_ppr", "career_season", "finish", "ppg", "prev_ppg"]
    return c.mega(spark, folder, False).select(*KEYS, *cols, "ppg_delta")


@query("a0_null_keys_dropped", with_views(
    "SELECT week, count(*) AS n FROM weekly WHERE week IS NOT NULL GROUP BY week", "weekly"))
def _(spark, folder):
    return agg.group_present(t.weekly(spark, folder), ["week"]).agg(F.count(F.lit(1)).alias("n"))


@query("a1_weekly_to_season", with_views("SELECT * FROM season_totals", "season_totals"))
def _(spark, folder):
    return totals_of(spark, folder)


@query("a2_volume_weighted_mean", with_views(
    "SELECT player_id, season, m1 AS time_to_throw, m2 AS intended_air_yards FROM tracking_means WHERE kind = 'A'",
    "tracking_means"))
def _(spark, folder):
    weight, values = t.TRACKING["passing"]
    rows = t.tracking(spark, folder)["passing"].where("season_type = 'REG'")
    rows = rows.withColumnsRenamed({"player_gsis_id": "player_id"})
    return agg.weighted_mean(rows, KEYS, [*values, "not_there"], weight)


@query("a2b_weighted_mean_present_weights", with_views("""
    SELECT player_id, season, sum(v1 * volume) / sum(CASE WHEN v1 IS NOT NULL THEN volume END) AS time_to_throw
    FROM tracking_rows WHERE season_type = 'REG' AND kind = 'A' GROUP BY ALL""", "tracking_rows"))
def _(spark, folder):
    weight, values = t.TRACKING["passing"]
    rows = t.tracking(spark, folder)["passing"].where("season_type = 'REG'")
    rows = rows.withColumnsRenamed({"player_gsis_id": "player_id"})
    return agg.weighted_mean(rows, KEYS, values[:1], weight, ignore_null_weight=True)


@query("a3_sum_and_mean", with_views("""
    SELECT pfr_player_id, season, coalesce(sum(offense_snaps), 0) AS offense_snaps, avg(offense_pct) AS snap_pct
    FROM snaps WHERE game_type = 'REG' GROUP BY pfr_player_id, season""", "snaps"))
def _(spark, folder):
    rows = t.snaps(spark, folder).where("game_type = 'REG'")
    return agg.sum_and_mean(rows, ["pfr_player_id", "season"], {"offense_snaps": "offense_snaps"}, {"snap_pct": "offense_pct"})


@query("a4_red_zone_targets", with_views("SELECT * FROM receiver_counts", "receiver_counts"))
def _(spark, folder):
    return feat.receiver_counts(plays(spark, folder))


@query("a5_rusher_counts", with_views("SELECT * FROM rusher_counts", "rusher_counts"))
def _(spark, folder):
    return feat.rusher_counts(plays(spark, folder))


@query("a6_team_denominators", with_views("SELECT * FROM team_rates", "team_rates"))
def _(spark, folder):
    return feat.team_rates(plays(spark, folder))


@query("a7_dominant_team", with_views("SELECT * FROM rusher_team", "rusher_team"))
def _(spark, folder):
    return feat.rusher_team(plays(spark, folder))


@query("a8_mean_across_sources", with_views("""
    SELECT player_id, season, round(avg(adp_overall), 4) AS adp_overall,
           round(avg(adp_position_rank), 6) AS adp_position_rank FROM market GROUP BY player_id, season""", "market"))
def _(spark, folder):
    cols = ["adp_overall", "adp_position_rank"]
    means = agg.mean_across(t.market(spark, folder), KEYS, cols)
    return means.select(*KEYS, F.round("adp_overall", 4).alias("adp_overall"),
                        F.round("adp_position_rank", 6).alias("adp_position_rank"))


@query("a9_keep_last", with_views("""
    SELECT player_id, season, team, row_id FROM roster
    QUALIFY row_number() OVER (PARTITION BY player_id, season ORDER BY row_date DESC, row_id DESC) = 1""", "roster"))
def _(spark, folder):
    last = ordering.keep_one(t.roster(spark, folder), KEYS, c.ROSTER_ORDER, "last")
    return last.select(*KEYS, "team", "row_id")


@query("a10_keep_first", with_views("SELECT * FROM xwalk", "xwalk"))
def _(spark, folder):
    roster = t.snap_roster(spark, folder).where("position = 'WR'")
    return crosswalk(roster, "pfr_id", "player_id", ["player_id"])


@query("a11_group_counts", with_views("SELECT season, count(*) AS n FROM season_stats GROUP BY season", "season_stats"))
def _(spark, folder):
    return agg.count_by(c.season_stats(spark, folder), ["season"])


@query("a12_table_summary", with_views("""
    SELECT position, count(*) AS n_rows, CAST(10 AS INT) AS n_columns, count(DISTINCT season) AS n_periods,
           min(season) AS first_period, max(season) AS last_period FROM season_stats GROUP BY position""", "season_stats"))
def _(spark, folder):
    return agg.table_summary(c.season_stats(spark, folder), "season", ["position"])


@query("a13_null_rates", with_views("""
    SELECT * FROM (UNPIVOT (
        SELECT round_even((count(*) - count(week)) * 100.0::DOUBLE / count(*), 1) AS week,
               round_even((count(*) - count(targets)) * 100.0::DOUBLE / count(*), 1) AS targets,
               round_even((count(*) - count(carries)) * 100.0::DOUBLE / count(*), 1) AS carries FROM weekly)
        ON week, targets, carries INTO NAME column_name VALUE null_pct) WHERE null_pct > 0""", "weekly"))
def _(spark, folder):
    return agg.null_rates(t.weekly(spark, folder))


WIDE_NULLS = r"""
    UNPIVOT (SELECT position, round_even((count(*) - count(COLUMNS(* EXCLUDE (position)))) * 100.0::DOUBLE / count(*), 1) AS "\0"
             FROM mega GROUP BY position)
    ON COLUMNS(* EXCLUDE (position)) INTO NAME column_name VALUE null_pct"""


@query("a13b_null_rates_wide_table", with_views(f"SELECT * FROM ({WIDE_NULLS}) WHERE null_pct > 0", "mega"))
def _(spark, folder):
    return agg.null_rates(c.mega(spark, folder), ["position"])


@query("a14_pearson", with_views("""
    SELECT position, round(corr(adp_overall, finish), 6) AS corr, count(*) AS n FROM mega
    WHERE adp_overall IS NOT NULL AND finish IS NOT NULL GROUP BY position""", "mega"))
def _(spark, folder):
    return rounded(agg.correlation(c.mega(spark, folder, False), "adp_overall", "finish", ["position"]), "corr")


@query("a14b_pearson_constant", """
    SELECT o_orderstatus, CAST(NULL AS DOUBLE) AS corr, count(*) AS n FROM orders GROUP BY o_orderstatus""")
def _(spark, folder):
    rows = t.table(spark, folder, "orders").withColumn("one", F.lit(1.0))
    return agg.correlation(rows, "o_totalprice", "one", ["o_orderstatus"])


CORR_COLUMNS = ("prev_ppg", "prev_games_played", "prev_fantasy_points_ppr", "prev_pass_attempts", "prev_wopr",
                "prev_air_yards", "prev_yards_after_catch", "prev_adot", "prev_time_to_throw",
                "prev_intended_air_yards", "prev_efficiency", "prev_separation", "prev_intended_air_yards_receiving",
                "prev_offense_snaps", "prev_snap_pct", "prev_rz_targets", "prev_rz_carries", "prev_goalline_carries",
                "prev_designed_rushes", "prev_scrambles", "prev_team_pass_rate", "prev_carry_share", "adp_overall",
                "adp_position_rank")
CORR_SQL = " UNION ALL ".join(f"""
    SELECT position, '{x}' AS feature, round(CASE WHEN stddev_pop({x}) FILTER (ppg IS NOT NULL) > 0
           THEN corr({x}, ppg) END, 6) AS corr FROM mega WHERE ppg IS NOT NULL GROUP BY position""" for x in CORR_COLUMNS)


@query("a15_predictor_correlations", with_views(
    f"SELECT * FROM ({CORR_SQL}) WHERE corr IS NOT NULL AND NOT isnan(corr)", "mega"))
def _(spark, folder):
    return rounded(explore.predictor_correlations(c.mega(spark, folder)), "corr")


@query("w1_market_rank_first", with_views("""
    SELECT player_name, position, adp_overall, CAST(row_number() OVER (
        PARTITION BY position ORDER BY adp_overall, player_name) AS INT) AS adp_position_rank FROM feed""", "feed"))
def _(spark, folder):
    order = [F.col("adp_overall").asc(), F.col("player_name").asc()]
    return ordering.rank_first(t.feed(spark, folder), ["position"], order, "adp_position_rank", ["adp_overall", "player_name"])


@query("w2_finish_rank", with_views("SELECT player_id, season, position, finish FROM outcomes", "outcomes"))
def _(spark, folder):
    priced = t.market(spark, folder).where(F.col("source") == t.FEED)
    return outcomes(c.season_stats(spark, folder), priced).select(*KEYS, "position", "finish")


@query("w2b_rank_with_nulls", with_views("""
    SELECT season, row_id, CASE WHEN targets IS NOT NULL THEN CAST(rank() OVER (
        PARTITION BY season ORDER BY targets DESC NULLS LAST) AS INT) END AS r FROM weekly""", "weekly"))
def _(spark, folder):
    return ordering.rank_min(t.weekly(spark, folder), ["season"], "targets", "r").select("season", "row_id", "r")


@query("w3_career_season", with_views("SELECT player_id, season, career_season FROM outcomes", "outcomes"))
def _(spark, folder):
    priced = t.market(spark, folder).where(F.col("source") == t.FEED).select("player_id").distinct()
    rows = c.season_stats(spark, folder).join(priced, "player_id", "left_semi")
    return ordering.ordinal(rows, "player_id", "season", "career_season").select(*KEYS, "career_season")


@query("w3b_career_by_name", with_views("""
    SELECT player_id, full_name, CAST(row_number() OVER (
        PARTITION BY full_name ORDER BY position, player_id) AS INT) AS career_season FROM parts_roster""",
    "parts_roster"))
def _(spark, folder):
    order = [F.col("position").asc(), F.col("player_id").asc()]
    rows = ordering.rank_first(t.parts_roster(spark, folder), ["full_name"], order, "career_season", ["position", "player_id"], unique=True)
    return rows.drop("position")


@query("w4_prior_season_window", with_views("""
    SELECT s.player_id, s.season, p.fantasy_points_ppr AS prev_fantasy_points_ppr
    FROM season_stats s LEFT JOIN season_stats p ON s.player_id = p.player_id AND s.season = p.season + 1""",
    "season_stats"))
def _(spark, folder):
    rows = c.season_stats(spark, folder).select(*KEYS, "fantasy_points_ppr")
    return prior_period(rows, "player_id", "season", ["fantasy_points_ppr"]).drop("fantasy_points_ppr")


@query("w5_average_rank", with_views("""
    SELECT season, row_id, rank() OVER w + (count(*) OVER (PARTITION BY season, targets) - 1) / 2 AS r FROM weekly
    WHERE targets IS NOT NULL WINDOW w AS (PARTITION BY season ORDER BY targets)""", "weekly"))
def _(spark, folder):
    rows = t.weekly(spark, folder).dropna(subset=["targets"])
    return ordering.rank_average(rows, ["season"], "targets", "r").select("season", "row_id", "r")


@query("w6_true_and_predicted_rank", with_views("""
    SELECT player_id, season, position, CAST(rank() OVER (PARTITION BY season, position ORDER BY ppg DESC) AS INT) AS true_rank,
           CAST(rank() OVER (PARTITION BY season, position ORDER BY prev_ppg DESC) AS INT) AS pred_rank
    FROM mega WHERE ppg IS NOT NULL AND prev_ppg IS NOT NULL""", "mega"))
def _(spark, folder):
    rows = settle(c.mega(spark, folder, False).dropna(subset=["ppg", "prev_ppg"]).select(
        *KEYS, "position", "ppg", "prev_ppg"))
    by = ["season", "position"]
    both = ordering.rank_min(ordering.rank_min(rows, by, "ppg", "true_rank"), by, "prev_ppg", "pred_rank")
    return both.select(*KEYS, "position", "true_rank", "pred_rank")


@query("w7_topk_membership", with_views("""
    SELECT season, row_id, targets, rank() OVER (PARTITION BY season ORDER BY targets DESC) <= 12 AS top
    FROM weekly WHERE targets IS NOT NULL""", "weekly"))
def _(spark, folder):
    rows = t.weekly(spark, folder).dropna(subset=["targets"])
    cut = ordering.rank_cutoff(rows, ["season"], "targets", 12, "cut")
    return rows.join(cut, "season").select("season", "row_id", "targets", (F.col("targets") >= F.col("cut")).alias("top"))
