"""Join operators."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from fieldtally.bindings import composed as c
from fieldtally.bindings import tables as t
from fieldtally.bindings.registry import query
from fieldtally.bindings.scalar_queries import LONG, norm_sql, totals_of
from fieldtally.bindings.tables import with_views
from fieldtally.operators import joins
from fieldtally.operators.aggregates import mean_across, weighted_mean
from fieldtally.plans import features as feat
from fieldtally.plans.season_stats import season_roster

KEYS = ["player_id", "season"]
MATCH = {
    "people": f"SELECT player_id, {norm_sql('full_name', LONG)} AS name_norm, position FROM parts_roster",
    "named": f"SELECT *, {norm_sql('player_name', LONG)} AS name_norm FROM feed",
}


def plays(spark, folder):
    return feat.clean_plays(t.raw_plays(spark, folder))


def seasonal(spark, folder):
    return feat.seasonal_features(t.seasonal(spark, folder))


def match(spark, folder, **options):
    return joins.match_entities(t.feed(spark, folder), t.parts_roster(spark, folder), "player_name", ["position"], **options)


@query("j1_left_join_market", with_views("""
    SELECT s.player_id, s.season, games_played, adp_overall, adp_position_rank
    FROM season_totals s LEFT JOIN market_mean m ON s.player_id = m.player_id AND s.season = m.season""",
    "season_totals", "market_mean"))
def _(spark, folder):
    prices = mean_across(t.market(spark, folder).where(F.col("source") == t.FEED), KEYS, ["adp_overall", "adp_position_rank"])
    return totals_of(spark, folder).select(*KEYS, "games_played").join(prices, KEYS, "left")


@query("j2_inner_join_roster", with_views("""
    SELECT s.player_id, s.season, games_played, full_name, position, team
    FROM season_totals s JOIN last_roster r ON s.player_id = r.player_id AND s.season = r.season""",
    "season_totals", "last_roster"))
def _(spark, folder):
    people = season_roster(t.roster(spark, folder), c.ROSTER_ORDER, t.ALL_SEGMENTS, t.OVERRIDES)
    return totals_of(spark, folder).select(*KEYS, "games_played").join(people, KEYS, "inner")


@query("j3_outer_chain_first_wins", with_views("""
    SELECT player_id, season, s.wopr, s.targets, s.air_yards, s.yards_after_catch, s.adot, w.games_played,
           w.fantasy_points_ppr, w.pass_attempts, w.carries, p.rz_targets, p.rz_carries, p.goalline_carries,
           p.designed_rushes, p.scrambles, p.team_pass_rate, p.carry_share
    FROM seasonal_features s FULL JOIN season_totals w USING (player_id, season)
    FULL JOIN play_features p USING (player_id, season)""", "seasonal_features", "season_totals", "play_features"))
def _(spark, folder):
    frames = [seasonal(spark, folder), totals_of(spark, folder), None, c.play_features(spark, folder)]
    return joins.outer_join_first_wins(frames, KEYS)


@query("j3b_outer_merge_unique_keys", with_views("SELECT * FROM feature_table", "feature_table"))
def _(spark, folder):
    frames = [seasonal(spark, folder), c.tracking_features(spark, folder), c.snap_features(spark, folder),
              c.play_features(spark, folder)]
    return joins.outer_join_first_wins(frames, KEYS, unique_keys=True)


@query("j4_outer_join_suffix", with_views("SELECT * FROM tracking_features", "tracking_features"))
def _(spark, folder):
    frames = {}
    for label, frame in t.tracking(spark, folder).items():
        weight, values = t.TRACKING[label]
        rows = frame.where("season_type = 'REG'").withColumnsRenamed({"player_gsis_id": "player_id"})
        frames[label] = weighted_mean(rows, KEYS, values, weight)
    return joins.outer_join_suffix(frames, KEYS)


@query("j5_entity_match", with_views("""
    SELECT player_id, player_name, n.position, n.name_norm, adp_overall
    FROM named n JOIN people p ON n.name_norm = p.name_norm AND n.position = p.position""",
    "feed", "parts_roster", **MATCH))
def _(spark, folder):
    return match(spark, folder)[0]


@query("j5b_ambiguous_names", with_views("""
    SELECT name_norm, position, count(DISTINCT player_id) AS entities FROM people GROUP BY ALL
    HAVING count(DISTINCT player_id) > 1""", "feed", "parts_roster", **MATCH))
def _(spark, folder):
    return joins.ambiguous_names(t.parts_roster(spark, folder), ["position"])


@query("j5u_unmatched_report", with_views("""
    SELECT player_name, position, name_norm, adp_overall FROM named n
    WHERE NOT EXISTS (SELECT 1 FROM people p WHERE n.name_norm = p.name_norm AND n.position = p.position)""",
    "feed", "parts_roster", **MATCH))
def _(spark, folder):
    return match(spark, folder)[1]


@query("j6_match_or_generate_id", with_views("""
    SELECT coalesce(CAST(player_id AS VARCHAR),
                    'ds-' || replace(replace(lower(player_name), ' ', '-'), '.', '')) AS player_id,
           player_name, n.position, n.name_norm, adp_overall, player_id IS NULL AS is_generated
    FROM named n LEFT JOIN people p ON n.name_norm = p.name_norm AND n.position = p.position""",
    "feed", "parts_roster", **MATCH))
def _(spark, folder):
    return match(spark, folder, unmatched="generate")[0]


@query("j7_semi_join", with_views("""
    SELECT player_id, season, games_played FROM season_totals
    WHERE player_id IN (SELECT player_id FROM market WHERE source = '1-URGENT')""", "season_totals", "market"))
def _(spark, folder):
    priced = t.market(spark, folder).where(F.col("source") == t.FEED)
    return joins.semi_relevant(totals_of(spark, folder).select(*KEYS, "games_played"), priced, "player_id")


@query("j8_crosswalk_join", with_views("""
    SELECT player_id, pfr_player_id, season, week, offense_snaps FROM snaps JOIN xwalk ON pfr_player_id = pfr_id""",
    "snaps", "xwalk"))
def _(spark, folder):
    roster = t.snap_roster(spark, folder).where("position = 'WR'")
    ids = joins.crosswalk(roster, "pfr_id", "player_id", ["player_id"]).withColumnsRenamed({"pfr_id": "pfr_player_id"})
    joined = joins.join_crosswalk(t.snaps(spark, folder), ids, "pfr_player_id", "player_id")
    return joined.select("player_id", "pfr_player_id", "season", "week", "offense_snaps")


@query("j8b_crosswalk_unmatched_count", with_views("""
    SELECT CAST(count(*) AS BIGINT) AS unmatched_rows FROM snaps
    WHERE game_type = 'REG' AND position = 'WR' AND pfr_player_id NOT IN (SELECT pfr_id FROM xwalk)""", "snaps", "xwalk"))
def _(spark, folder):
    seen = Observation()
    c.snap_features(spark, folder, seen).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(int(seen.get["unmatched_rows"]),)], "unmatched_rows bigint")


@query("j9_prior_season", with_views("""
    SELECT s.player_id, s.season, s.games_played, p.games_played AS prev_games_played, p.carries AS prev_carries
    FROM season_totals s LEFT JOIN season_totals p ON s.player_id = p.player_id AND s.season = p.season + 1""",
    "season_totals"))
def _(spark, folder):
    rows = totals_of(spark, folder).select(*KEYS, "games_played", "carries")
    return joins.prior_period(rows, "player_id", "season", ["games_played", "carries"]).drop("carries")


@query("j10_prior_season_features", with_views("""
    SELECT s.player_id, s.season, f.wopr AS prev_wopr, f.adot AS prev_adot
    FROM season_totals s LEFT JOIN seasonal_features f ON s.player_id = f.player_id AND s.season = f.season + 1""",
    "season_totals", "seasonal_features"))
def _(spark, folder):
    prior = joins.shift_period(seasonal(spark, folder).select(*KEYS, "wopr", "adot"), KEYS, "season")
    return totals_of(spark, folder).select(*KEYS).join(prior, KEYS, "left")


@query("j11_current_features_new_columns", with_views("""
    SELECT s.*, f.wopr, f.air_yards, f.yards_after_catch, f.adot
    FROM season_totals s LEFT JOIN seasonal_features f ON s.player_id = f.player_id AND s.season = f.season""",
    "season_totals", "seasonal_features"))
def _(spark, folder):
    return joins.left_join_new_columns(totals_of(spark, folder), seasonal(spark, folder), KEYS)


@query("j12_dominant_team_denominators", with_views("""
    SELECT c.player_id, c.season, posteam, carries, team_rush_attempts, team_pass_rate
    FROM rusher_counts c LEFT JOIN rusher_team USING (player_id, season) LEFT JOIN team_rates USING (posteam, season)""",
    "rusher_counts", "rusher_team", "team_rates"))
def _(spark, folder):
    return feat.carry_context(feat.play_levels(t.raw_plays(spark, folder)))


@query("j13_outer_receiver_rusher", with_views("""
    SELECT player_id, season, rz_targets, carries, rz_carries, goalline_carries, designed_rushes, scrambles
    FROM receiver_counts FULL JOIN rusher_counts USING (player_id, season)""", "receiver_counts", "rusher_counts"))
def _(spark, folder):
    levels = feat.play_levels(t.raw_plays(spark, folder))
    return joins.outer_join_first_wins([feat.receiver_zones(levels), feat.rusher_zones(levels)], KEYS, unique_keys=True)


@query("j14_aligned_counts", with_views(
    "SELECT posteam, season, team_pass_plays, team_rush_attempts FROM team_rates", "team_rates"))
def _(spark, folder):
    return feat.team_rates(plays(spark, folder)).drop("team_pass_rate")


def clash(spark, folder, rule):
    """Stats with prior values joined to prior features that share a column with them."""
    rows = totals_of(spark, folder).select(*KEYS, "targets")
    left = joins.prior_period(rows, "player_id", "season", ["targets"])
    right = joins.shift_period(seasonal(spark, folder).select(*KEYS, "targets", "wopr"), KEYS, "season")
    return joins.join_with_clash(left, right, KEYS, "left", rule, "_feature")


def clash_sql(cols):
    return with_views(f"""
        SELECT s.player_id, s.season, s.targets, f.wopr AS prev_wopr{cols}
        FROM season_totals s LEFT JOIN season_totals p ON s.player_id = p.player_id AND s.season = p.season + 1
        LEFT JOIN seasonal_features f ON s.player_id = f.player_id AND s.season = f.season + 1""",
        "season_totals", "seasonal_features")


@query("j15_clash_drop", clash_sql(""))
def _(spark, folder):
    return clash(spark, folder, "drop")


@query("j15b_clash_left", clash_sql(", p.targets AS prev_targets"))
def _(spark, folder):
    return clash(spark, folder, "left")


@query("j15c_clash_suffix", clash_sql(", p.targets AS prev_targets, f.targets AS prev_targets_feature"))
def _(spark, folder):
    return clash(spark, folder, "suffix")
