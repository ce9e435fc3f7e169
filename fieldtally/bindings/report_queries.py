"""Sorting, top-n, set operations, reshaping and the detailed play metrics."""

from pyspark.sql import functions as F

from fieldtally.bindings import composed as c
from fieldtally.bindings import tables as t
from fieldtally.bindings.join_queries import plays
from fieldtally.bindings.registry import query
from fieldtally.bindings.scalar_queries import totals_of
from fieldtally.bindings.tables import with_views
from fieldtally.operators import ordering, reshape
from fieldtally.operators.project import stack_frames
from fieldtally.plans import explore
from fieldtally.plans import features as feat
from fieldtally.plans.mega import outcomes
from fieldtally.session import settle

KEYS = ["player_id", "season"]


@query("t1_sort_nulls_last", with_views("""
    SELECT player_id, season, finish FROM outcomes ORDER BY season, finish NULLS LAST, player_id""", "outcomes"))
def _(spark, folder):
    priced = t.market(spark, folder).where(F.col("source") == t.FEED)
    rows = outcomes(c.season_stats(spark, folder), priced)
    return rows.select(*KEYS, "finish").orderBy("season", F.asc_nulls_last("finish"), "player_id")


@query("t2_sort_one_column", with_views("SELECT player_name, position, adp_overall FROM feed", "feed"))
def _(spark, folder):
    return t.feed(spark, folder).orderBy(F.desc("adp_overall"), "player_name", "position")


@query("t3_first_rows", with_views("""
    SELECT player_id, season, fantasy_points_ppr FROM season_totals ORDER BY season, player_id LIMIT 10""", "season_totals"))
def _(spark, folder):
    rows = totals_of(spark, folder).select(*KEYS, "fantasy_points_ppr")
    return ordering.top_rows(rows, [F.col("season"), F.col("player_id")], 10)


VALUED = "SELECT player_id, full_name, season, adp_position_rank, finish, adp_position_rank - finish AS value FROM mega"


def valued(spark, folder):
    cols = ["player_id", "full_name", "season", "adp_position_rank", "finish"]
    return explore.steals_and_busts(c.mega(spark, folder, False), 10, cols)


@query("t4_top_n_by_value", with_views(
    f"{VALUED} ORDER BY value DESC NULLS LAST, season, player_id LIMIT 10", "mega"))
def _(spark, folder):
    return valued(spark, folder)[0]


@query("t4b_bottom_n_by_value", with_views(
    f"{VALUED} ORDER BY value NULLS LAST, season, player_id LIMIT 10", "mega"))
def _(spark, folder):
    return valued(spark, folder)[1]


@query("u1_bag_union", with_views("""
    SELECT player_id, season FROM season_totals UNION ALL SELECT player_id, season FROM season_files""",
    "season_totals", "season_files"))
def _(spark, folder):
    return stack_frames([totals_of(spark, folder).select(*KEYS), t.season_files(spark, folder).select("season", "player_id")])


@query("u2_distinct_keys", with_views("SELECT DISTINCT player_id FROM market WHERE source = '1-URGENT'", "market"))
def _(spark, folder):
    return t.market(spark, folder).where(F.col("source") == t.FEED).select("player_id").distinct()


@query("u3_topk_intersection", with_views("""
    SELECT season, position, player_id FROM (
        SELECT *, rank() OVER (PARTITION BY season, position ORDER BY ppg DESC) AS a,
               rank() OVER (PARTITION BY season, position ORDER BY prev_ppg DESC) AS b
        FROM mega WHERE ppg IS NOT NULL AND prev_ppg IS NOT NULL) WHERE a <= 12 AND b <= 12""", "mega"))
def _(spark, folder):
    by = ["season", "position"]
    known = c.mega(spark, folder, False).dropna(subset=["ppg", "prev_ppg"])
    rows = settle(known.select("player_id", *by, "ppg", "prev_ppg"))
    cuts = ordering.rank_cutoff(rows, by, "ppg", 12, "cut_y").join(ordering.rank_cutoff(rows, by, "prev_ppg", 12, "cut_p"), by)
    return rows.join(cuts, by).where("ppg >= cut_y and prev_ppg >= cut_p").select(*by, "player_id")


@query("r2_wide_to_long", """
    UNPIVOT (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment, c_name FROM customer)
    ON c_nationkey, c_mktsegment, c_name INTO NAME feature VALUE value""")
def _(spark, folder):
    return reshape.feature_rows(t.table(spark, folder, "customer").drop("c_acctbal"), ["c_custkey"])


def levels(spark, folder):
    return feat.play_levels(t.raw_plays(spark, folder), detail=True)


PASSER = "SELECT passer_player_id AS player_id, season, {} FROM plays WHERE pass_attempt = 1 AND passer_player_id IS NOT NULL GROUP BY ALL"


@query("d1_completion_over_expected", with_views(PASSER.format("avg(cpoe) AS cpoe"), "plays"))
def _(spark, folder):
    return feat.passing_detail(levels(spark, folder)).select(*KEYS, "cpoe")


@query("d2_air_yards_per_attempt", with_views(
    PASSER.format("sum(air_yards) / count(*) AS air_yards_per_attempt"), "plays"))
def _(spark, folder):
    return feat.passing_detail(levels(spark, folder)).select(*KEYS, "air_yards_per_attempt")


@query("d3_red_zone_pass_attempts", with_views(
    PASSER.format("CAST(count(*) FILTER (yardline_100 <= 20) AS BIGINT) AS rz_pass_attempts"), "plays"))
def _(spark, folder):
    return feat.passing_detail(levels(spark, folder)).select(*KEYS, "rz_pass_attempts")


CATCH = """SELECT player_id, season, count(*) AS targets, count(*) FILTER (yardline_100 <= 20) AS rz_targets,
    sum(air_yards) AS air, count(*) FILTER (complete_pass = '1') AS caught, sum(yards_after_catch) AS yac
    FROM throws_at GROUP BY ALL"""


@query("d4_targets", with_views("SELECT player_id, season, targets, rz_targets FROM catches", "throws_at", catches=CATCH))
def _(spark, folder):
    return feat.receiving_detail(levels(spark, folder)).select(*KEYS, "targets", "rz_targets")


@query("d5_receiving_efficiency", with_views("""
    SELECT player_id, season, air / targets AS adot, caught / targets AS catch_rate,
           CASE WHEN caught > 0 THEN yac / caught END AS yac_per_reception FROM catches""", "throws_at", catches=CATCH))
def _(spark, folder):
    return feat.receiving_detail(levels(spark, folder)).select(*KEYS, "adot", "catch_rate", "yac_per_reception")


MAIN = """SELECT player_id, season, posteam FROM {} WHERE posteam IS NOT NULL GROUP BY player_id, season, posteam
    QUALIFY row_number() OVER (PARTITION BY player_id, season ORDER BY count(*) DESC, posteam) = 1"""


@query("d6_target_shares", with_views("""
    SELECT player_id, season, targets / t_targets AS target_share,
           CASE WHEN t_air > 0 THEN air / t_air END AS air_yards_share,
           CASE WHEN t_rz > 0 THEN rz_targets / t_rz END AS rz_target_share
    FROM catches JOIN main USING (player_id, season) JOIN teams USING (posteam, season)""", "throws_at",
    catches=CATCH, main=MAIN.format("throws_at"), teams="""
    SELECT posteam, season, count(*) AS t_targets, count(*) FILTER (yardline_100 <= 20) AS t_rz, sum(air_yards) AS t_air
    FROM throws_at GROUP BY ALL"""))
def _(spark, folder):
    return feat.receiving_detail(levels(spark, folder)).select(*KEYS, "target_share", "air_yards_share", "rz_target_share")


@query("d7_carries", with_views(
    "SELECT player_id, season, carries, rz_carries, goalline_carries FROM rusher_counts", "rusher_counts"))
def _(spark, folder):
    return feat.rushing_detail(levels(spark, folder)).drop("rz_carry_share")


@query("d8_red_zone_carry_share", with_views("""
    SELECT player_id, season, CASE WHEN t_rz > 0 THEN rz_carries / t_rz END AS rz_carry_share
    FROM rusher_counts JOIN rusher_team USING (player_id, season) JOIN teams USING (posteam, season)""",
    "rusher_counts", "rusher_team", teams="""
    SELECT posteam, season, count(*) FILTER (yardline_100 <= 20) AS t_rz FROM carries_made GROUP BY ALL"""))
def _(spark, folder):
    return feat.rushing_detail(levels(spark, folder)).select(*KEYS, "rz_carry_share")


@query("d9_opportunity_share", with_views("""
    SELECT player_id, season, opportunities, opportunities / t_opportunities AS opportunity_share
    FROM (SELECT player_id, season, count(*) AS opportunities FROM chances GROUP BY ALL)
    JOIN main USING (player_id, season)
    JOIN (SELECT posteam, season, count(*) AS t_opportunities FROM chances GROUP BY ALL) USING (posteam, season)""",
    "throws_at", "carries_made", chances="""
    SELECT player_id, season, posteam FROM throws_at UNION ALL SELECT player_id, season, posteam FROM carries_made""",
    main=MAIN.format("chances")))
def _(spark, folder):
    return feat.opportunity_share(levels(spark, folder))


@query("d10_pressure_to_sack_rate", with_views("""
    SELECT passer_player_id AS player_id, season,
           CASE WHEN sum(CAST(was_pressure AS INT)) > 0 THEN sum(sack) / sum(CAST(was_pressure AS INT)) END AS pressure_to_sack_rate
    FROM plays WHERE passer_player_id IS NOT NULL GROUP BY ALL""", "plays"))
def _(spark, folder):
    return feat.pressure_to_sack_rate(plays(spark, folder))


@query("d11_play_detail", with_views("""
    SELECT player_id, season, cpoe, air_yards_per_attempt, rz_pass_attempts, targets, rz_targets, carries, rz_carries,
           goalline_carries
    FROM passers FULL JOIN catches USING (player_id, season) FULL JOIN rusher_counts USING (player_id, season)""",
    "plays", "throws_at", "rusher_counts", catches=CATCH, passers=PASSER.format(
        "avg(cpoe) AS cpoe, sum(air_yards) / count(*) AS air_yards_per_attempt, "
        "CAST(count(*) FILTER (yardline_100 <= 20) AS BIGINT) AS rz_pass_attempts")))
def _(spark, folder):
    wide = feat.play_detail(t.raw_plays(spark, folder))
    return wide.select(*KEYS, "cpoe", "air_yards_per_attempt", "rz_pass_attempts", "targets", "rz_targets", "carries",
                       "rz_carries", "goalline_carries")
