"""The generated tables in the roles the plans expect, as DataFrames and as SQL views.

Each binding exists twice: a function ``(spark, folder) -> DataFrame`` and a
common table expression of the same name in ``VIEWS``. Money and rates are
held as whole numbers (cents, percent) so that sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Values of the generated tables that play a part below.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")
ALL_SEGMENTS = (*SEGMENTS, "HOUSEHOLD")
OVERRIDES = {7: "FURNITURE", 11: "HOUSEHOLD", 23: "BUILDING"}
LAST_WEEKLY = 2000
SEASONS = range(1995, 2002)
FEED = "1-URGENT"
STATS = ("games_played", "fantasy_points_ppr", "pass_attempts", "carries", "targets")
FIRST_SEASON = 1996
TRAIN, TEST = (1996, 1997, 1998, 1999), (2000, 2001)
SEGMENT_K = {"AUTOMOBILE": 8, "BUILDING": 12, "FURNITURE": 12, "MACHINERY": 8, "HOUSEHOLD": 10}
# Stat and feature columns of each segment's own table.
_CAUGHT = ("wopr", "air_yards", "yards_after_catch", "adot", "separation", "intended_air_yards_receiving", "rz_targets")
_RUSHED = ("efficiency", "rz_carries", "goalline_carries", "carry_share", "team_pass_rate")
SEGMENT_STATS = {
    "AUTOMOBILE": ("games_played", "fantasy_points_ppr", "pass_attempts", "carries"),
    "BUILDING": ("games_played", "fantasy_points_ppr", "carries", "targets"),
    "FURNITURE": ("games_played", "fantasy_points_ppr", "targets"),
    "MACHINERY": ("games_played", "fantasy_points_ppr", "targets"),
    "HOUSEHOLD": STATS,
}
SEGMENT_FEATURES = {
    "AUTOMOBILE": ("time_to_throw", "intended_air_yards", "snap_pct", "offense_snaps", "designed_rushes", "scrambles", "team_pass_rate"),
    "BUILDING": (*_CAUGHT, *_RUSHED, "snap_pct"),
    "FURNITURE": (*_CAUGHT, "snap_pct", "offense_snaps", "team_pass_rate"),
    "MACHINERY": (*_CAUGHT, "team_pass_rate"),
    "HOUSEHOLD": (*_CAUGHT, *_RUSHED),
}
UNPRICED = {"adp_overall": 300.0, "adp_position_rank": 75.0}
TRACKING = {
    "passing": ("attempts", ("time_to_throw", "intended_air_yards")),
    "rushing": ("rush_attempts", ("efficiency",)),
    "receiving": ("targets", ("separation", "intended_air_yards")),
}


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the generated tables. Its schema is read from the files once, not once per use."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _int(c) -> F.Column:
    return c.cast("int")


def _whole(name: str) -> F.Column:
    return F.round(F.col(name) * 100)


def _season(name: str) -> F.Column:
    return _int(F.year(name)).alias("season")


def weekly(spark, folder) -> DataFrame:
    """Orders as weekly records; some weeks and targets are missing."""
    d, p = F.col("o_orderdate"), F.col("o_orderpriority")
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("player_id"), _season("o_orderdate"),
        F.when(p != "4-NOT SPECIFIED", _int(F.weekofyear(d))).alias("week"),
        F.when(F.col("o_orderstatus") == "P", "POST").otherwise("REG").alias("season_type"),
        _whole("o_totalprice").alias("fantasy_points_ppr"),
        F.dayofmonth(d).cast("double").alias("attempts"),
        F.when(p != "5-LOW", F.month(d).cast("double")).alias("targets"),
        F.dayofyear(d).cast("double").alias("carries"),
        p.alias("source"), d.alias("row_date"), F.col("o_orderkey").alias("row_id"),
    )


def roster(spark, folder) -> DataFrame:
    """Customers as roster entries, one per order, so player-seasons repeat with changing teams."""
    orders = table(spark, folder, "orders")
    people = table(spark, folder, "customer")
    return orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("player_id"), _season("o_orderdate"), F.col("c_name").alias("player_name"),
        F.col("c_mktsegment").alias("position"), F.col("o_orderpriority").alias("team"),
        F.col("o_orderdate").alias("row_date"), F.col("o_orderkey").alias("row_id"),
    )


def season_files(spark, folder) -> DataFrame:
    """Orders as ready-made season totals under the newer column names."""
    d = F.col("o_orderdate")
    orders = table(spark, folder, "orders").groupBy(
        F.col("o_custkey").alias("player_id"), _season("o_orderdate")
    ).agg(
        F.max("o_orderpriority").alias("recent_team"), _int(F.count(F.lit(1))).alias("games"),
        F.sum(_whole("o_totalprice")).alias("fantasy_points_ppr"),
        F.sum(F.dayofmonth(d).cast("double")).alias("attempts"), F.sum(F.month(d).cast("double")).alias("targets"),
        F.sum(F.dayofyear(d).cast("double")).alias("carries"),
    )
    people = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("player_id"), F.col("c_name").alias("player_display_name"),
        F.col("c_mktsegment").alias("position"),
    )
    return orders.join(people, "player_id")


def market(spark, folder) -> DataFrame:
    """Orders per customer, year and priority as prices from five sources."""
    return table(spark, folder, "orders").groupBy(
        F.col("o_custkey").alias("player_id"), _season("o_orderdate"), F.col("o_orderpriority").alias("source")
    ).agg(F.avg(_whole("o_totalprice")).alias("adp_overall"), _int(F.count(F.lit(1))).alias("adp_position_rank"))


def raw_plays(spark, folder) -> DataFrame:
    """Line items as plays, the 0/1 columns still text."""
    items = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    people = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    f = F.col("l_returnflag")
    bit = lambda cond: F.when(cond, "1").otherwise("0")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        people, F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.select(
        _season("l_shipdate"), _int(F.weekofyear("l_shipdate")).alias("week"),
        F.when(F.col("o_orderstatus") == "P", "POST").otherwise("REG").alias("season_type"),
        F.when(f == "A", "pass").otherwise("run").alias("play_type"), F.col("c_nationkey").alias("posteam"),
        F.when(f == "A", F.col("o_custkey")).alias("passer_player_id"),
        F.when((f == "A") & (F.col("l_linenumber") > 1), F.col("l_partkey")).alias("receiver_player_id"),
        F.when(f != "A", F.col("l_suppkey")).alias("rusher_player_id"),
        F.when(F.col("l_linenumber") == 7, "x").otherwise(bit(f == "A")).alias("pass_attempt"),
        bit(f != "A").alias("rush_attempt"), bit(f == "N").alias("qb_scramble"),
        bit(F.col("l_linestatus") == "F").alias("sack"), bit(F.col("l_linestatus") == "O").alias("complete_pass"),
        _whole("l_discount").alias("air_yards"), _whole("l_tax").alias("yards_after_catch"),
        F.when(F.col("l_linenumber") < 7, F.col("l_quantity")).alias("yardline_100"),
        (_whole("l_discount") - _whole("l_tax")).alias("cpoe"),
        bit(F.col("l_tax") > 0.03).alias("was_pressure"),
    )


def tracking(spark, folder) -> dict[str, DataFrame]:
    """Line items as three weekly tracking frames that share one column name."""
    items = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("player_gsis_id"), _season("l_shipdate"),
        F.when(F.col("l_linestatus") == "F", "REG").otherwise("POST").alias("season_type"),
        F.col("l_returnflag").alias("kind"), F.col("l_quantity").alias("volume"),
        F.when(F.col("l_quantity") <= 45, _whole("l_discount")).alias("first"), _whole("l_tax").alias("second"),
    )
    frames = {}
    for kind, (label, (weight, values)) in zip("ARN", TRACKING.items()):
        part = items.where(F.col("kind") == kind)
        named = dict(zip(values, ("first", "second")))
        frames[label] = part.select(
            "player_gsis_id", "season", "season_type", F.col("volume").alias(weight),
            *[F.col(c).alias(out) for out, c in named.items()],
        )
    return frames


def snaps(spark, folder) -> DataFrame:
    """Events as weekly snap counts under external ids; the hour stands in for the season."""
    e = F.col("event_type")
    return table(spark, folder, "events").select(
        F.concat(F.lit("u"), F.col("user_id")).alias("pfr_player_id"),
        _int(F.lit(1995) + F.hour("ts") % 7).alias("season"),
        _int(F.weekofyear("ts")).alias("week"), F.when(e == "error", "POST").otherwise("REG").alias("game_type"),
        F.when(e == "signup", "K").otherwise("WR").alias("position"), _whole("value").alias("offense_snaps"),
        F.when(F.col("value") < 200, _whole("value")).alias("offense_pct"),
    )


def snap_roster(spark, folder) -> DataFrame:
    """Parts as roster entries: few external ids, many entries each, some without an id."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("player_id"),
        F.when(F.col("p_size") > 2, F.concat(F.lit("u"), F.col("p_size"))).alias("pfr_id"),
        F.when(F.col("p_type") == "SMALL", "K").otherwise("WR").alias("position"),
    )


def seasonal(spark, folder) -> DataFrame:
    """Orders as season-level advanced columns under the source names; shares a column with the stats."""
    d = F.col("o_orderdate")
    return table(spark, folder, "orders").groupBy(
        F.col("o_custkey").alias("player_id"), _season("o_orderdate")
    ).agg(
        F.sum(F.when(F.col("o_orderpriority") != "5-LOW", F.month(d)).cast("double")).alias("targets"),
        F.sum(_whole("o_totalprice")).alias("receiving_air_yards"),
        F.sum(F.dayofmonth(d).cast("double")).alias("receiving_yards_after_catch"),
        F.max(F.dayofyear(d).cast("double")).alias("wopr"),
    )


def feed(spark, folder) -> DataFrame:
    """Part names as a market feed: one row per name and brand, decorated, some beyond recognition."""
    grouped = table(spark, folder, "part").groupBy("p_name", "p_brand").agg(
        F.sum(_whole("p_retailprice")).alias("adp_overall"), F.max("p_size").alias("size")
    )
    n, s = F.col("p_name"), F.col("size")
    name = (
        F.when(s < 10, F.concat(F.upper(n), F.lit(" Jr.")))
        .when(s < 20, F.concat(F.lit("  "), F.replace(n, F.lit(" "), F.lit("  ")), F.lit(" III ")))
        .when(s < 30, F.concat(F.replace(n, F.lit("e"), F.lit("e.")), F.lit(" V")))
        .when(s < 40, F.concat(F.lit("lost "), n))
        .otherwise(F.initcap(n))
    )
    return grouped.select(name.alias("player_name"), F.col("p_brand").alias("position"), "adp_overall")


def parts_roster(spark, folder) -> DataFrame:
    """Parts as named entities; many namesakes."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("player_id"), F.col("p_name").alias("full_name"), F.col("p_brand").alias("position")
    )


# The same bindings in SQL: name -> (views it reads, body).
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "weekly": ((), """
        SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS INT) AS season,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(weekofyear(o_orderdate) AS INT) END AS week,
               CASE WHEN o_orderstatus = 'P' THEN 'POST' ELSE 'REG' END AS season_type,
               round(o_totalprice * 100) AS fantasy_points_ppr,
               CAST(day(o_orderdate) AS DOUBLE) AS attempts,
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(month(o_orderdate) AS DOUBLE) END AS targets,
               CAST(dayofyear(o_orderdate) AS DOUBLE) AS carries,
               o_orderpriority AS source, o_orderdate AS row_date, o_orderkey AS row_id
        FROM orders"""),
    "roster": ((), """
        SELECT c_custkey AS player_id, CAST(year(o_orderdate) AS INT) AS season, c_name AS player_name,
               c_mktsegment AS position, o_orderpriority AS team, o_orderdate AS row_date, o_orderkey AS row_id
        FROM orders JOIN customer ON o_custkey = c_custkey"""),
    "season_files": ((), """
        SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS INT) AS season, c_name AS player_display_name,
               c_mktsegment AS position, max(o_orderpriority) AS recent_team, CAST(count(*) AS INT) AS games,
               sum(round(o_totalprice * 100)) AS fantasy_points_ppr, sum(CAST(day(o_orderdate) AS DOUBLE)) AS attempts,
               sum(CAST(month(o_orderdate) AS DOUBLE)) AS targets, sum(CAST(dayofyear(o_orderdate) AS DOUBLE)) AS carries
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""),
    "market": ((), """
        SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS INT) AS season, o_orderpriority AS source,
               sum(round(o_totalprice * 100)) / count(*) AS adp_overall, CAST(count(*) AS INT) AS adp_position_rank
        FROM orders GROUP BY ALL"""),
    "raw_plays": ((), """
        SELECT CAST(year(l_shipdate) AS INT) AS season, CAST(weekofyear(l_shipdate) AS INT) AS week,
               CASE WHEN o_orderstatus = 'P' THEN 'POST' ELSE 'REG' END AS season_type,
               CASE WHEN l_returnflag = 'A' THEN 'pass' ELSE 'run' END AS play_type, c_nationkey AS posteam,
               CASE WHEN l_returnflag = 'A' THEN o_custkey END AS passer_player_id,
               CASE WHEN l_returnflag = 'A' AND l_linenumber > 1 THEN l_partkey END AS receiver_player_id,
               CASE WHEN l_returnflag <> 'A' THEN l_suppkey END AS rusher_player_id,
               CASE WHEN l_linenumber = 7 THEN 'x' WHEN l_returnflag = 'A' THEN '1' ELSE '0' END AS pass_attempt,
               CASE WHEN l_returnflag <> 'A' THEN '1' ELSE '0' END AS rush_attempt,
               CASE WHEN l_returnflag = 'N' THEN '1' ELSE '0' END AS qb_scramble,
               CASE WHEN l_linestatus = 'F' THEN '1' ELSE '0' END AS sack,
               CASE WHEN l_linestatus = 'O' THEN '1' ELSE '0' END AS complete_pass,
               round(l_discount * 100) AS air_yards, round(l_tax * 100) AS yards_after_catch,
               CASE WHEN l_linenumber < 7 THEN l_quantity END AS yardline_100,
               round(l_discount * 100) - round(l_tax * 100) AS cpoe,
               CASE WHEN l_tax > 0.03 THEN '1' ELSE '0' END AS was_pressure
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""),
    "plays": (("raw_plays",), """
        SELECT * REPLACE (coalesce(TRY_CAST(pass_attempt AS DOUBLE), 0) AS pass_attempt,
                          coalesce(TRY_CAST(rush_attempt AS DOUBLE), 0) AS rush_attempt,
                          coalesce(TRY_CAST(qb_scramble AS DOUBLE), 0) AS qb_scramble,
                          coalesce(TRY_CAST(sack AS DOUBLE), 0) AS sack)
        FROM raw_plays WHERE season_type = 'REG'"""),
    "carries_made": (("plays",), """
        SELECT rusher_player_id AS player_id, * EXCLUDE (rusher_player_id) FROM plays
        WHERE rush_attempt = 1 AND rusher_player_id IS NOT NULL"""),
    "throws_at": (("plays",), """
        SELECT receiver_player_id AS player_id, * EXCLUDE (receiver_player_id) FROM plays
        WHERE play_type = 'pass' AND receiver_player_id IS NOT NULL"""),
    "tracking_rows": ((), """
        SELECT l_suppkey AS player_id, CAST(year(l_shipdate) AS INT) AS season, l_returnflag AS kind,
               CASE WHEN l_linestatus = 'F' THEN 'REG' ELSE 'POST' END AS season_type, l_quantity AS volume,
               CASE WHEN l_quantity <= 45 THEN round(l_discount * 100) END AS v1, round(l_tax * 100) AS v2
        FROM lineitem"""),
    "snaps": ((), """
        SELECT 'u' || user_id AS pfr_player_id, CAST(1995 + hour(ts) % 7 AS INT) AS season, CAST(weekofyear(ts) AS INT) AS week,
               CASE WHEN event_type = 'error' THEN 'POST' ELSE 'REG' END AS game_type,
               CASE WHEN event_type = 'signup' THEN 'K' ELSE 'WR' END AS position,
               round(value * 100) AS offense_snaps, CASE WHEN value < 200 THEN round(value * 100) END AS offense_pct
        FROM events"""),
    "snap_roster": ((), """
        SELECT p_partkey AS player_id, CASE WHEN p_size > 2 THEN 'u' || p_size END AS pfr_id,
               CASE WHEN p_type = 'SMALL' THEN 'K' ELSE 'WR' END AS position FROM part"""),
    "xwalk": (("snap_roster",), """
        SELECT pfr_id, min(player_id) AS player_id FROM snap_roster
        WHERE pfr_id IS NOT NULL AND position = 'WR' GROUP BY pfr_id"""),
    "seasonal": ((), """
        SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS INT) AS season,
               sum(CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(month(o_orderdate) AS DOUBLE) END) AS targets,
               sum(round(o_totalprice * 100)) AS receiving_air_yards,
               sum(CAST(day(o_orderdate) AS DOUBLE)) AS receiving_yards_after_catch,
               max(CAST(dayofyear(o_orderdate) AS DOUBLE)) AS wopr
        FROM orders GROUP BY 1, 2"""),
    "feed": ((), r"""
        SELECT CASE WHEN size < 10 THEN upper(p_name) || ' Jr.'
                    WHEN size < 20 THEN '  ' || replace(p_name, ' ', '  ') || ' III '
                    WHEN size < 30 THEN replace(p_name, 'e', 'e.') || ' V'
                    WHEN size < 40 THEN 'lost ' || p_name
                    ELSE upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] || ' '
                         || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] END AS player_name,
               p_brand AS position, adp_overall
        FROM (SELECT p_name, p_brand, sum(round(p_retailprice * 100)) AS adp_overall, max(p_size) AS size
              FROM part GROUP BY 1, 2)"""),
    "parts_roster": ((), """
        SELECT p_partkey AS player_id, p_name AS full_name, p_brand AS position FROM part"""),
    # Composed views, written from the rules rather than from the DataFrame plans.
    "season_totals": (("weekly",), """
        SELECT player_id, season, CAST(count(week) AS INT) AS games_played,
               coalesce(sum(fantasy_points_ppr), 0) AS fantasy_points_ppr, coalesce(sum(attempts), 0) AS pass_attempts,
               coalesce(sum(carries), 0) AS carries, coalesce(sum(targets), 0) AS targets
        FROM weekly WHERE season_type = 'REG' GROUP BY player_id, season"""),
    "last_roster": (("roster",), """
        SELECT player_id, season, player_name AS full_name,
               CASE player_id WHEN 7 THEN 'FURNITURE' WHEN 11 THEN 'HOUSEHOLD' WHEN 23 THEN 'BUILDING'
                    ELSE position END AS position, team
        FROM roster WHERE position IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY', 'HOUSEHOLD')
        QUALIFY row_number() OVER (PARTITION BY player_id, season ORDER BY row_date DESC, row_id DESC) = 1"""),
    "season_stats": (("season_totals", "last_roster", "season_files"), """
        SELECT s.player_id, s.season, full_name, position, team, games_played, fantasy_points_ppr, pass_attempts,
               carries, targets
        FROM season_totals s JOIN last_roster r ON s.player_id = r.player_id AND s.season = r.season
        WHERE s.season <= 2000
        UNION ALL
        SELECT player_id, season, player_display_name,
               CASE player_id WHEN 7 THEN 'FURNITURE' WHEN 11 THEN 'HOUSEHOLD' WHEN 23 THEN 'BUILDING'
                    ELSE position END, recent_team, games, fantasy_points_ppr, attempts, carries, targets
        FROM season_files WHERE season > 2000"""),
    "outcomes": (("season_stats", "market"), """
        SELECT *, CASE WHEN games_played > 0 THEN fantasy_points_ppr / games_played END AS ppg,
               CAST(row_number() OVER (PARTITION BY player_id ORDER BY season) AS INT) AS career_season,
               CASE WHEN fantasy_points_ppr IS NOT NULL THEN CAST(rank() OVER (
                   PARTITION BY season, position ORDER BY fantasy_points_ppr DESC NULLS LAST) AS INT) END AS finish
        FROM season_stats WHERE player_id IN (SELECT player_id FROM market WHERE source = '1-URGENT')"""),
    "seasonal_features": (("seasonal",), """
        SELECT player_id, season, wopr, targets, receiving_air_yards AS air_yards,
               receiving_yards_after_catch AS yards_after_catch,
               CASE WHEN targets > 0 THEN receiving_air_yards / targets END AS adot FROM seasonal"""),
    "tracking_means": (("tracking_rows",), """
        SELECT player_id, season, kind,
               CASE WHEN sum(volume) > 0 THEN coalesce(sum(v1 * volume), 0) / sum(volume) END AS m1,
               CASE WHEN sum(volume) > 0 THEN coalesce(sum(v2 * volume), 0) / sum(volume) END AS m2
        FROM tracking_rows WHERE season_type = 'REG' GROUP BY ALL"""),
    "tracking_features": (("tracking_means",), """
        SELECT player_id, season, a.m1 AS time_to_throw, a.m2 AS intended_air_yards, r.m1 AS efficiency,
               n.m1 AS separation, n.m2 AS intended_air_yards_receiving
        FROM (SELECT * FROM tracking_means WHERE kind = 'A') a
        FULL JOIN (SELECT * FROM tracking_means WHERE kind = 'R') r USING (player_id, season)
        FULL JOIN (SELECT * FROM tracking_means WHERE kind = 'N') n USING (player_id, season)"""),
    "snap_features": (("snaps", "xwalk"), """
        SELECT player_id, season, coalesce(sum(offense_snaps), 0) AS offense_snaps, avg(offense_pct) AS snap_pct
        FROM snaps JOIN xwalk ON pfr_player_id = pfr_id
        WHERE game_type = 'REG' AND position = 'WR' GROUP BY player_id, season"""),
    "team_rates": (("plays",), """
        SELECT posteam, season, CAST(count(*) FILTER (pass_attempt = 1) AS BIGINT) AS team_pass_plays,
               CAST(count(*) FILTER (rush_attempt = 1) AS BIGINT) AS team_rush_attempts,
               count(*) FILTER (pass_attempt = 1) / count(*) AS team_pass_rate
        FROM (SELECT *, pass_attempt = 1 OR rush_attempt = 1 AS used FROM plays) WHERE used AND posteam IS NOT NULL
        GROUP BY posteam, season"""),
    "rusher_team": (("carries_made",), """
        SELECT player_id, season, posteam FROM carries_made WHERE posteam IS NOT NULL
        GROUP BY player_id, season, posteam
        QUALIFY row_number() OVER (PARTITION BY player_id, season ORDER BY count(*) DESC, posteam) = 1"""),
    "rusher_counts": (("carries_made",), """
        SELECT player_id, season, CAST(count(*) AS BIGINT) AS carries,
               CAST(count(*) FILTER (yardline_100 <= 20) AS BIGINT) AS rz_carries,
               CAST(count(*) FILTER (yardline_100 <= 5) AS BIGINT) AS goalline_carries,
               CAST(count(*) FILTER (qb_scramble = 0) AS BIGINT) AS designed_rushes,
               CAST(count(*) FILTER (qb_scramble = 1) AS BIGINT) AS scrambles
        FROM carries_made GROUP BY player_id, season"""),
    "receiver_counts": (("throws_at",), """
        SELECT player_id, season, CAST(count(*) FILTER (yardline_100 <= 20) AS BIGINT) AS rz_targets
        FROM throws_at GROUP BY player_id, season"""),
    "play_features": (("receiver_counts", "rusher_counts", "rusher_team", "team_rates"), """
        SELECT player_id, season, rz_targets, carries, rz_carries, goalline_carries, designed_rushes, scrambles,
               team_pass_rate, carry_share
        FROM receiver_counts FULL JOIN (
            SELECT c.*, t.team_pass_rate,
                   CASE WHEN team_rush_attempts > 0 THEN carries / team_rush_attempts END AS carry_share
            FROM rusher_counts c LEFT JOIN rusher_team USING (player_id, season)
            LEFT JOIN team_rates t USING (posteam, season)) USING (player_id, season)"""),
    "feature_table": (("seasonal_features", "tracking_features", "snap_features", "play_features"), """
        SELECT * FROM seasonal_features FULL JOIN tracking_features USING (player_id, season)
        FULL JOIN snap_features USING (player_id, season) FULL JOIN play_features USING (player_id, season)"""),
    "market_mean": (("market",), """
        SELECT player_id, season, avg(adp_overall) AS adp_overall, avg(adp_position_rank) AS adp_position_rank
        FROM market WHERE source = '1-URGENT' GROUP BY player_id, season"""),
    "mega": (("outcomes", "feature_table", "market_mean"), """
        SELECT o.player_id, o.season, o.full_name, o.position, o.team, o.games_played, o.fantasy_points_ppr,
               o.pass_attempts, o.carries, o.targets, o.ppg, o.career_season, o.finish,
               p.ppg AS prev_ppg, p.games_played AS prev_games_played, p.fantasy_points_ppr AS prev_fantasy_points_ppr,
               p.pass_attempts AS prev_pass_attempts,
               coalesce(a.adp_overall, 300) AS adp_overall, coalesce(a.adp_position_rank, 75) AS adp_position_rank,
               f.wopr, f.air_yards, f.yards_after_catch, f.adot, f.time_to_throw, f.intended_air_yards, f.efficiency,
               f.separation, f.intended_air_yards_receiving, f.offense_snaps, f.snap_pct, f.rz_targets, f.rz_carries,
               f.goalline_carries, f.designed_rushes, f.scrambles, f.team_pass_rate, f.carry_share,
               g.wopr AS prev_wopr, g.air_yards AS prev_air_yards, g.yards_after_catch AS prev_yards_after_catch,
               g.adot AS prev_adot, g.time_to_throw AS prev_time_to_throw,
               g.intended_air_yards AS prev_intended_air_yards, g.efficiency AS prev_efficiency,
               g.separation AS prev_separation, g.intended_air_yards_receiving AS prev_intended_air_yards_receiving,
               g.offense_snaps AS prev_offense_snaps, g.snap_pct AS prev_snap_pct, g.rz_targets AS prev_rz_targets,
               g.rz_carries AS prev_rz_carries, g.goalline_carries AS prev_goalline_carries,
               g.designed_rushes AS prev_designed_rushes, g.scrambles AS prev_scrambles,
               g.team_pass_rate AS prev_team_pass_rate, g.carry_share AS prev_carry_share,
               o.ppg - p.ppg AS ppg_delta, o.fantasy_points_ppr - p.fantasy_points_ppr AS pts_delta
        FROM outcomes o
        LEFT JOIN outcomes p ON o.player_id = p.player_id AND o.season = p.season + 1
        LEFT JOIN market_mean a ON o.player_id = a.player_id AND o.season = a.season
        LEFT JOIN feature_table f ON o.player_id = f.player_id AND o.season = f.season
        LEFT JOIN feature_table g ON o.player_id = g.player_id AND o.season = g.season + 1
        WHERE o.season >= 1996"""),
}


def with_views(select: str, *views: str, **extra: str) -> str:
    """``select`` preceded by the views it needs, in dependency order; ``extra`` adds local ones at the end."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in VIEWS[name][0]:
            visit(needed)
        ordered.append(name)

    for view in views:
        visit(view)
    # Several views are read more than once; without the keyword each reader would expand them again.
    parts = [f"{name} AS MATERIALIZED ({VIEWS[name][1]})" for name in ordered] + [f"{n} AS ({b})" for n, b in extra.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + select
