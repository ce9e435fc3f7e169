"""Filters, projections and scalar expressions."""

from pyspark.sql import functions as F

from fieldtally.bindings import composed as c
from fieldtally.bindings import tables as t
from fieldtally.bindings.registry import query
from fieldtally.bindings.tables import with_views
from fieldtally.functions import names, numeric
from fieldtally.operators.aggregates import mean_across
from fieldtally.operators.joins import shift_period
from fieldtally.operators.ordering import rank_min
from fieldtally.operators.project import add_prefix, columns_with_prefix, conform
from fieldtally.plans import league
from fieldtally.plans.season_stats import weekly_totals


def norm_sql(col: str, suffixes: str) -> str:
    """The name rule in SQL (its regular expressions see ASCII white space only)."""
    return rf"""trim(regexp_replace(replace(replace(trim(regexp_replace(trim(lower({col})),
        '\b({suffixes})\s*$', '')), '.', ''), '''', ''), '\s+', ' ', 'g'))"""


LONG = r"jr\.?|sr\.?|viii|vii|vi|iii|ii|iv|v"
SHORT = r"jr\.?|sr\.?|iii|ii|iv"


def totals_of(spark, folder):
    """Weekly records summed to seasons."""
    return weekly_totals(t.weekly(spark, folder), t.SEASONS)


@query("p1_equality_filter", with_views("SELECT player_id, row_id FROM weekly WHERE season_type = 'REG'", "weekly"))
def _(spark, folder):
    return t.weekly(spark, folder).where("season_type = 'REG'").select("player_id", "row_id")


@query("p2_membership_filter", with_views(
    "SELECT player_id, row_id FROM weekly WHERE season IN (1995, 1997, 2001)", "weekly"))
def _(spark, folder):
    return t.weekly(spark, folder).where(F.col("season").isin(1995, 1997, 2001)).select("player_id", "row_id")


@query("p3_range_filter", with_views("""
    SELECT season, posteam, yardline_100 FROM raw_plays WHERE yardline_100 <= 5 AND season >= 1996""", "raw_plays"))
def _(spark, folder):
    return t.raw_plays(spark, folder).where("yardline_100 <= 5 and season >= 1996").select(
        "season", "posteam", "yardline_100")


@query("p4_drop_null_rows", with_views(
    "SELECT player_id, row_id, week, targets FROM weekly WHERE week IS NOT NULL AND targets IS NOT NULL", "weekly"))
def _(spark, folder):
    return t.weekly(spark, folder).dropna(subset=["week", "targets"]).select("player_id", "row_id", "week", "targets")


@query("p5_rename_columns", with_views("""
    SELECT player_id, season, recent_team AS team, games AS games_played, attempts AS pass_attempts FROM season_files""",
    "season_files"))
def _(spark, folder):
    keep = ["player_id", "season", "team", "games_played", "pass_attempts"]
    return conform(t.season_files(spark, folder), league.SEASON_FILE_RENAMES, keep)


@query("p6_constant_column", with_views(
    "SELECT player_id, season, 'ffc' AS source, CAST(2026 AS INT) AS draft FROM season_files", "season_files"))
def _(spark, folder):
    return t.season_files(spark, folder).select(
        "player_id", "season", F.lit(league.FEED_SOURCE).alias("source"), F.lit(league.PAGE_MARKET_SEASON).alias("draft"))


@query("p7_override_by_key", """
    SELECT c_custkey, CASE c_custkey WHEN 7 THEN 'FURNITURE' WHEN 11 THEN 'HOUSEHOLD' WHEN 23 THEN 'BUILDING'
           ELSE c_mktsegment END AS position
    FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""")
def _(spark, folder):
    kept = t.table(spark, folder, "customer").where(F.col("c_mktsegment").isin(*t.SEGMENTS))
    fixed = names.override_by_key(F.col("c_custkey"), F.col("c_mktsegment"), t.OVERRIDES)
    return kept.select("c_custkey", fixed.alias("position"))


@query("p8_exact_replacement", """
    SELECT p_partkey, CASE p_name WHEN 'small ring' THEN 'red widget' WHEN 'red widget' THEN 'blue bolt'
           ELSE p_name END AS name FROM part""")
def _(spark, folder):
    swaps = {"small ring": "red widget", "red widget": "blue bolt"}
    return t.table(spark, folder, "part").select("p_partkey", names.replace_exact(F.col("p_name"), swaps).alias("name"))


@query("p9a_normalize_name_long", with_views(
    f"SELECT player_name, position, {norm_sql('player_name', LONG)} AS name_norm FROM feed", "feed"))
def _(spark, folder):
    name = names.normalize_name(F.col("player_name"), names.LONG_SUFFIXES)
    return t.feed(spark, folder).select("player_name", "position", name.alias("name_norm"))


@query("p9b_normalize_name_short", with_views(
    f"SELECT player_name, position, {norm_sql('player_name', SHORT)} AS name_norm FROM feed", "feed"))
def _(spark, folder):
    name = names.normalize_name(F.col("player_name"), names.SHORT_SUFFIXES)
    return t.feed(spark, folder).select("player_name", "position", name.alias("name_norm"))


@query("p10_nan_to_null", "SELECT event_id, CASE WHEN value >= 1 THEN value END AS value FROM events")
def _(spark, folder):
    holed = F.when(F.col("value") >= 1, F.col("value")).otherwise(F.lit(float("nan")))
    return numeric.nan_to_null(t.table(spark, folder, "events").select("event_id", holed.alias("value")))


@query("p11_numeric_coercion", """
    SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN 0.0::DOUBLE
           ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k FROM events""")
def _(spark, folder):
    e = F.col("event_type")
    text = F.when(e == "error", "n/a").when(e != "view", F.get_json_object("props", "$.k"))
    return t.table(spark, folder, "events").select("event_id", numeric.to_number(text).alias("k"))


@query("p12_constant_null_fill", with_views("""
    SELECT s.player_id, s.season, coalesce(adp_overall, 300) AS adp_overall,
           coalesce(adp_position_rank, 75) AS adp_position_rank
    FROM season_totals s LEFT JOIN market_mean m ON s.player_id = m.player_id AND s.season = m.season""",
    "season_totals", "market_mean"))
def _(spark, folder):
    keys = ["player_id", "season"]
    prices = mean_across(t.market(spark, folder).where(F.col("source") == t.FEED), keys, list(league.MARKET_COLUMNS))
    rows = t.weekly(spark, folder).where("season_type = 'REG'").select(*keys).distinct()
    return rows.join(prices, keys, "left").fillna(t.UNPRICED)


@query("p13_guarded_ratio", with_views("""
    SELECT player_id, season, CASE WHEN games_played > 0 THEN fantasy_points_ppr / games_played END AS ppg
    FROM season_totals""", "season_totals"))
def _(spark, folder):
    totals = totals_of(spark, folder)
    return totals.select(
        "player_id", "season", numeric.safe_ratio(F.col("fantasy_points_ppr"), F.col("games_played")).alias("ppg"))


@query("p13b_nonzero_ratio", """
    SELECT c_custkey, round(c_acctbal * 100) / nullif(c_nationkey - 10, 0) AS ratio FROM customer""")
def _(spark, folder):
    ratio = numeric.nonzero_ratio(F.round(F.col("c_acctbal") * 100), F.col("c_nationkey") - 10)
    return t.table(spark, folder, "customer").select("c_custkey", ratio.alias("ratio"))


@query("p14_null_safe_flag", with_views("""
    SELECT season, posteam, yardline_100, CAST(coalesce(yardline_100 <= 20, false) AS INT) AS red_zone FROM raw_plays""",
    "raw_plays"))
def _(spark, folder):
    flag = numeric.flag(F.col("yardline_100") <= 20)
    return t.raw_plays(spark, folder).select("season", "posteam", "yardline_100", flag.alias("red_zone"))


@query("p15_column_difference", with_views("SELECT player_id, season, ppg_delta, pts_delta FROM mega", "mega"))
def _(spark, folder):
    return c.mega(spark, folder, False).select("player_id", "season", "ppg_delta", "pts_delta")


@query("p16_surrogate_id", with_views("""
    SELECT player_name, position, 'ds-' || replace(replace(lower(player_name), ' ', '-'), '.', '') AS player_id
    FROM feed""", "feed"))
def _(spark, folder):
    return t.feed(spark, folder).select(
        "player_name", "position", names.surrogate_id(F.col("player_name")).alias("player_id"))


@query("p17_join_names", """
    SELECT p_partkey, split_part(p_name, ' ', 1) || '   ' || split_part(p_name, ' ', 2) AS full_name FROM part""")
def _(spark, folder):
    part = F.split("p_name", " ")
    first, last = F.concat(F.lit("\t"), part[0], F.lit(" ")), F.concat(F.lit(" "), part[1], F.lit("\n"))
    return t.table(spark, folder, "part").select("p_partkey", names.join_names(first, last).alias("full_name"))


@query("p18_prefix_test", """
    SELECT c_custkey, c_name LIKE 'Customer#00000000%' AS generated, NOT c_name LIKE 'Customer#00000000%' AS veteran
    FROM customer""")
def _(spark, folder):
    early = names.has_prefix(F.col("c_name"), "Customer#00000000")
    return t.table(spark, folder, "customer").select("c_custkey", early.alias("generated"), (~early).alias("veteran"))


@query("p19_name_search", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(lower(p_name), 'red|small b')")
def _(spark, folder):
    return t.table(spark, folder, "part").where(names.name_matches(F.col("p_name"), "RED|Small b")).select(
        "p_partkey", "p_name")


@query("p20_add_prefix", with_views(
    "SELECT player_id, season, games AS prev_games, attempts AS prev_attempts FROM season_files", "season_files"))
def _(spark, folder):
    cols = ["games", "attempts"]
    return add_prefix(t.season_files(spark, folder).select("player_id", "season", *cols), cols, "prev_")


@query("p21_columns_by_prefix", with_views("""
    SELECT career_season, prev_ppg, prev_games_played, prev_fantasy_points_ppr, prev_pass_attempts, prev_wopr,
           prev_air_yards, prev_yards_after_catch, prev_adot, prev_time_to_throw, prev_intended_air_yards,
           prev_efficiency, prev_separation, prev_intended_air_yards_receiving, prev_offense_snaps, prev_snap_pct,
           prev_rz_targets, prev_rz_carries, prev_goalline_carries, prev_designed_rushes, prev_scrambles,
           prev_team_pass_rate, prev_carry_share FROM mega""", "mega"))
def _(spark, folder):
    wide = c.mega(spark, folder)
    return wide.select(*columns_with_prefix(wide, "prev_", ["career_season"]))


@query("p22_shift_season", with_views(
    "SELECT player_id, CAST(season + 1 AS INT) AS season, games AS prev_games FROM season_files", "season_files"))
def _(spark, folder):
    rows = t.season_files(spark, folder).select("player_id", "season", "games")
    return shift_period(rows, ["player_id", "season"], "season")


@query("p23_round_half_even", """
    SELECT event_id, round_even(CAST(json_extract_string(props, '$.k') AS DOUBLE) / 16, 3) AS k FROM events""")
def _(spark, folder):
    k = F.get_json_object("props", "$.k").cast("double") / 16
    return t.table(spark, folder, "events").select("event_id", numeric.half_even(k, 3).alias("k"))


@query("p24_integer_rank", """
    SELECT c_custkey, CAST(rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal) AS INT) AS r FROM customer""")
def _(spark, folder):
    people = t.table(spark, folder, "customer")
    return rank_min(people, ["c_mktsegment"], "c_acctbal", "r", descending=False).select("c_custkey", "r")
