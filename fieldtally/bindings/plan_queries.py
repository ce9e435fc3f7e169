"""The composed plans end to end."""

from pyspark.sql import functions as F

from fieldtally.bindings import composed as c
from fieldtally.bindings import tables as t
from fieldtally.bindings.group_queries import CORR_SQL, WIDE_NULLS, rounded
from fieldtally.bindings.model_queries import FEATURE_NAMES
from fieldtally.bindings.registry import query
from fieldtally.bindings.scalar_queries import LONG, SHORT, norm_sql, totals_of
from fieldtally.bindings.scan_queries import PAGE_PLAYERS, TABLE_ROWS, TABLES, full_pages
from fieldtally.bindings.tables import with_views
from fieldtally.contracts import PLAYS, shape
from fieldtally.operators.aggregates import null_rates
from fieldtally.operators.project import select_present, stack_frames
from fieldtally.operators.reshape import feature_row, profile
from fieldtally.plans import explore, league, market
from fieldtally.plans import features as feat
from fieldtally.plans.mega import position_table
from fieldtally.plans.season_stats import load_season_stats, season_stats_table
from fieldtally.session import scratch_path, settle
from fieldtally.streaming.incremental import land_incremental, read_landed

KEYS = ["player_id", "season"]


@query("q1_season_stats", with_views("SELECT * FROM season_stats", "season_stats"))
def _(spark, folder):
    """Two loads into the stored table; the second repeats a season, and its keys, with outdated rows first."""
    fresh = settle(c.season_stats(spark, folder), "season-stats")
    stored = season_stats_table(spark, scratch_path(spark, "season-stats-table"), fresh.schema)
    load_season_stats(stored, fresh.where("season <= 1998").withColumns({
        "fantasy_points_ppr": F.col("fantasy_points_ppr") + F.when(F.col("season") == 1998, 1).otherwise(0), "file": F.lit(1)}), ["file"])
    late = fresh.where("season >= 1998").withColumn("file", F.lit(2))
    load_season_stats(stored, late.withColumns({"team": F.lit("outdated"), "file": F.lit(1)}).unionByName(late), ["file"])
    return stored.read()


def price_feed(spark, folder):
    """Orders per customer, year and priority as a feed with decorated names."""
    people = t.table(spark, folder, "customer")
    prices = t.market(spark, folder).join(people, F.col("player_id") == F.col("c_custkey"))
    n, k = F.col("c_name"), F.col("c_nationkey")
    name = (
        F.when(k < 8, F.concat(F.upper(n), F.lit(" Jr."))).when(k < 16, F.concat(F.lit("  "), n, F.lit(" III")))
        .when(k == 24, F.concat(F.lit("lost "), n)).otherwise(n)
    )
    return prices.select(name.alias("player_name"), F.col("c_mktsegment").alias("position"), "season", "adp_overall", "source")


PRICE_FEED = """
    SELECT CASE WHEN c_nationkey < 8 THEN upper(c_name) || ' Jr.' WHEN c_nationkey < 16 THEN '  ' || c_name || ' III'
                WHEN c_nationkey = 24 THEN 'lost ' || c_name ELSE c_name END AS player_name,
           c_mktsegment AS position, season, adp_overall, source
    FROM market JOIN customer ON player_id = c_custkey"""
FEED_STEPS = {
    "price_feed": PRICE_FEED,
    "chosen": """
        SELECT * FROM price_feed WHERE source = '1-URGENT' AND season <= 1998
        UNION ALL SELECT * FROM price_feed WHERE source = '2-HIGH' AND season NOT IN (
            SELECT season FROM price_feed WHERE source = '1-URGENT' AND season <= 1998)""",
    "placed": f"""
        SELECT *, {norm_sql('player_name', LONG)} AS name_norm, CAST(row_number() OVER (
            PARTITION BY season, position ORDER BY adp_overall, player_name) AS INT) AS adp_position_rank
        FROM chosen WHERE position <> 'HOUSEHOLD'""",
    "people": f"SELECT DISTINCT player_id, {norm_sql('full_name', LONG)} AS name_norm, position FROM season_stats",
    "fresh": """
        SELECT player_id, season, adp_overall, adp_position_rank, 'ffc' AS source
        FROM placed f JOIN people p ON f.name_norm = p.name_norm AND f.position = p.position
        QUALIFY row_number() OVER (PARTITION BY player_id, season ORDER BY adp_overall DESC, adp_position_rank DESC) = 1""",
}


def feed_prices(spark, folder):
    rows = price_feed(spark, folder)
    first = rows.where((F.col("source") == "1-URGENT") & (F.col("season") <= 1998)).drop("source")
    second = rows.where("source = '2-HIGH'").drop("source")
    return market.feed_prices(first, second, c.season_stats(spark, folder), t.SEGMENTS)


@query("q2_feed_prices", with_views("""
    SELECT * FROM fresh UNION ALL
    SELECT player_id, season, 1.0::DOUBLE, CAST(1 AS INT), 'ffc' FROM season_totals s WHERE season <= 1996
      AND NOT EXISTS (SELECT 1 FROM fresh f WHERE f.player_id = s.player_id AND f.season = s.season)""",
    "market", "season_stats", **FEED_STEPS))
def _(spark, folder):
    fresh, _ = feed_prices(spark, folder)
    stored = totals_of(spark, folder).where("season <= 1996").select(
        *KEYS, F.lit(1.0).alias("adp_overall"), F.lit(1).alias("adp_position_rank"), F.lit("ffc").alias("source"))
    return market.load_prices(stored, fresh)


@query("q2b_feed_unmatched", with_views("""
    SELECT player_name, position, season, adp_overall, adp_position_rank, name_norm FROM placed f
    WHERE NOT EXISTS (SELECT 1 FROM people p WHERE f.name_norm = p.name_norm AND f.position = p.position)""",
    "market", "season_stats", **FEED_STEPS))
def _(spark, folder):
    return feed_prices(spark, folder)[1]


PAGE_STEPS = {
    "placed": f"""
        SELECT *, {norm_sql('player_name', SHORT)} AS name_norm, CAST(row_number() OVER (
            PARTITION BY position ORDER BY adp_overall, player_name) AS INT) AS adp_position_rank FROM ({PAGE_PLAYERS})""",
    "people": f"""
        SELECT DISTINCT player_id, {norm_sql("replace(full_name, '#', ' ')", SHORT)} AS name_norm, position FROM season_stats""",
}


@query("q3_page_prices", with_views("""
    SELECT coalesce(CAST(player_id AS VARCHAR), 'ds-' || replace(replace(lower(player_name), ' ', '-'), '.', '')) AS player_id,
           CAST(2026 AS INT) AS season, player_name, f.position, team, adp_overall, adp_position_rank,
           'draftsharks' AS source, player_id IS NULL AS is_generated
    FROM placed f LEFT JOIN people p ON f.name_norm = p.name_norm AND f.position = p.position""",
    "season_stats", **PAGE_STEPS))
def _(spark, folder):
    stats = c.season_stats(spark, folder).withColumn("full_name", F.replace("full_name", F.lit("#"), F.lit(" ")))
    everyone, _ = market.page_prices(full_pages(spark, folder), stats, positions=t.SEGMENTS)
    return everyone.drop("name_norm")


@query("q4_seasonal_features", with_views("""
    SELECT * FROM seasonal_features WHERE season <= 2000 UNION ALL
    SELECT player_id, season, wopr, targets, receiving_air_yards, receiving_yards_after_catch,
           CASE WHEN targets > 0 THEN receiving_air_yards / targets END
    FROM seasonal WHERE season > 2000 AND wopr > 100""", "seasonal_features"))
def _(spark, folder):
    rows = t.seasonal(spark, folder)
    newer = rows.where("season > 2000").withColumn("season_type", F.when(F.col("wopr") > 100, "REG").otherwise("POST"))
    return feat.seasonal_features(rows.where("season <= 2000"), newer)


@query("q5_tracking_features", with_views("SELECT * FROM tracking_features", "tracking_features"))
def _(spark, folder):
    return c.tracking_features(spark, folder)


@query("q6_snap_features", with_views("SELECT * FROM snap_features", "snap_features"))
def _(spark, folder):
    return c.snap_features(spark, folder)


@query("q7_play_features", with_views("SELECT * FROM play_features", "play_features"))
def _(spark, folder):
    return c.play_features(spark, folder)


@query("q8_mega_table", with_views("SELECT * FROM mega", "mega"))
def _(spark, folder):
    return c.mega(spark, folder)


@query("q9_position_table", with_views(TABLE_ROWS, "mega"))
def _(spark, folder):
    """The tables of all positions, each with its own columns, one below the other."""
    wide = settle(c.mega(spark, folder), "mega", "position")
    return stack_frames([position_table(wide, p, cols).withColumn("position", F.lit(p)) for p, cols in TABLES.items()])


@query("q11a_profile", with_views("""
    SELECT full_name, season, career_season, team, adp_overall, adp_position_rank, finish, fantasy_points_ppr,
           games_played, ppg, prev_fantasy_points_ppr, prev_ppg, pts_delta, ppg_delta
    FROM mega WHERE full_name ILIKE '%er#0000%1'""", "mega"))
def _(spark, folder):
    return profile(c.mega(spark, folder, False), "ER#0000.*1$", league.PROFILE_COLUMNS)


# Every column of the wide table but the ids, as text or as a number.
TEXT = ("position", "team")
NUMBERS = ("games_played", "fantasy_points_ppr", "pass_attempts", "carries", "targets", "ppg", "career_season", "finish",
           "prev_ppg", "prev_games_played", "prev_fantasy_points_ppr", "prev_pass_attempts", "adp_overall",
           "adp_position_rank", *FEATURE_NAMES, *(f"prev_{x}" for x in FEATURE_NAMES), "ppg_delta", "pts_delta")


def whole_rows(pattern, season):
    """SQL: every column of the rows whose name matches, transposed."""
    chosen = f"SELECT * FROM mega WHERE season = {season} AND regexp_matches(full_name, '{pattern}', 'i')"
    numbers = ", ".join(f"CAST({x} AS DOUBLE) AS {x}" for x in NUMBERS)
    return with_views(f"""
        SELECT player_id, feature, NULL AS text, round(value, 4) + 0 AS number FROM (
            UNPIVOT (SELECT player_id, {numbers} FROM ({chosen})) ON {", ".join(NUMBERS)} INTO NAME feature VALUE value)
        UNION ALL
        SELECT player_id, feature, value, NULL FROM (
            UNPIVOT (SELECT player_id, {", ".join(TEXT)} FROM ({chosen})) ON {", ".join(TEXT)} INTO NAME feature VALUE value)""", "mega")


def transposed(spark, folder, pattern, season):
    long = feature_row(c.mega(spark, folder), pattern, season, ["player_id", "full_name", "season"])
    number = F.expr("try_cast(value AS DOUBLE)")
    return long.where("value is not null").select(
        "player_id", "feature", F.when(number.isNull(), F.col("value")).alias("text"), (F.round(number, 4) + 0).alias("number"))


@query("q11b_feature_row", whole_rows("customer#0+[0-9]*7$", 1999))
def _(spark, folder):
    return transposed(spark, folder, "CUSTOMER#0+[0-9]*7$", 1999)


@query("r1_feature_row", whole_rows("#0*[1-9][0-9]?$", 1998))
def _(spark, folder):
    return transposed(spark, folder, "#0*[1-9][0-9]?$", 1998)


@query("q11c_null_rates", with_views(f"SELECT * FROM ({WIDE_NULLS}) WHERE null_pct > 0", "mega"))
def _(spark, folder):
    return null_rates(c.mega(spark, folder), ["position"])


@query("q11d_market_vs_finish", with_views("""
    SELECT position, round(corr(adp_position_rank, finish), 6) AS corr, count(finish) AS n FROM mega GROUP BY position""",
    "mega"))
def _(spark, folder):
    return rounded(explore.market_vs_finish(c.mega(spark, folder, False)), "corr")


@query("q11e_strongest_predictor", with_views(f"""
    SELECT position, feature, abs(corr) AS strength FROM ({CORR_SQL}) WHERE corr IS NOT NULL AND NOT isnan(corr)
    QUALIFY row_number() OVER (PARTITION BY position ORDER BY abs(corr) DESC, feature DESC) = 1""", "mega"))
def _(spark, folder):
    found = rounded(explore.predictor_correlations(c.mega(spark, folder)), "corr")
    best = F.max(F.struct(F.abs("corr").alias("strength"), "feature"))
    return found.groupBy("position").agg(best.alias("b")).select("position", "b.feature", "b.strength")


@query("q11f_steals_and_busts", with_views("""
    (SELECT 'steal' AS side, player_id, season, adp_position_rank - finish AS value FROM mega
     ORDER BY value DESC NULLS LAST, season, player_id LIMIT 10)
    UNION ALL (SELECT 'bust', player_id, season, adp_position_rank - finish AS value FROM mega
     ORDER BY value NULLS LAST, season, player_id LIMIT 10)""", "mega"))
def _(spark, folder):
    sides = explore.steals_and_busts(c.mega(spark, folder, False), 10, ["player_id", "season"])
    steals, busts = (df.select(F.lit(label).alias("side"), *KEYS, "value") for label, df in zip(("steal", "bust"), sides))
    return steals.unionByName(busts)


@query("q11g_derived_columns", with_views("""
    SELECT player_id, season, adp_overall, CAST(row_number() OVER (PARTITION BY full_name ORDER BY season, player_id) AS INT)
           AS career_season, fantasy_points_ppr / nullif(games_played, 0) AS ppg,
           prev_fantasy_points_ppr / nullif(prev_games_played, 0) AS prev_ppg
    FROM mega""", "mega"))
def _(spark, folder):
    rows = explore.derived_columns(c.mega(spark, folder, False))
    return rows.select(*KEYS, "adp_overall", "career_season", "ppg", "prev_ppg")


@query("q12_play_landing", with_views("""
    SELECT season, week, play_type, count(*) AS n, sum(yardline_100) AS yards FROM raw_plays
    WHERE season_type = 'REG' GROUP BY ALL""", "raw_plays"))
def _(spark, folder):
    path = scratch_path(spark, "landed")
    land_incremental(select_present(t.raw_plays(spark, folder).where(feat.REGULAR), shape(PLAYS).fieldNames()), path)
    landed = read_landed(spark, path, schema=PLAYS)
    return landed.groupBy("season", "week", "play_type").agg(F.count(F.lit(1)).alias("n"), F.sum("yardline_100").alias("yards"))
