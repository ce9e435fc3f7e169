"""Scans, feed parsing and sinks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.bindings import composed as c
from fieldtally.bindings import tables as t
from fieldtally.bindings.registry import query
from fieldtally.bindings.tables import with_views
from fieldtally.contracts import MARKET_DOCUMENT, PLAYS, key_report, shape
from fieldtally.operators.project import select_present, stack_frames
from fieldtally.plans import league
from fieldtally.plans.features import clean_plays, team_rates
from fieldtally.plans.mega import position_columns, write_position_tables
from fieldtally.session import scratch_path
from fieldtally.sources import readers, sinks
from fieldtally.sources.keyed import KeyedTable
from fieldtally.streaming.incremental import land_incremental, read_landed

KEY = readers.market_key(*league.PAGE_KEY)


def market_pages(spark, folder):
    """Customers as pages with an embedded market document, one player each."""
    text = """format_string('<html><script>var vueAppData = {"teams":[{"id":%d,"abbr":"N%d"},{"id":99,"abbr":"ZZZ"}],
        "projections":[{"first_name":" %s","last_name":"%s ","position":"%s",%s,"adps":{"%s":
        {"overall_pick_number":%d}}}]}; var other = {"teams":[]};</script></html>',
        if(c_nationkey = 5, 98, c_nationkey), c_nationkey,
        if(c_nationkey = 3, 'New.', 'Customer'), substring(c_name, 10), c_mktsegment,
        if(c_acctbal > 0, concat('"team_id":', c_nationkey), concat('"team_id":0,"team":{"id":', c_nationkey, '}')),
        if(c_nationkey < 20, '11::107::12', '1::2::3'), cast(round(c_acctbal * 100) as bigint))"""
    return t.table(spark, folder, "customer").select("c_custkey", F.expr(text).alias("html"))


def full_pages(spark, folder):
    """The same players, some forty to a page."""
    player = """format_string('{"first_name":" %s","last_name":"%s ","position":"%s",%s,"adps":{"%s":{"overall_pick_number":%d}}}',
        if(c_nationkey = 3, 'New.', 'Customer'), substring(c_name, 10), c_mktsegment,
        if(c_acctbal > 0, concat('"team_id":', c_nationkey), concat('"team_id":0,"team":{"id":', c_nationkey, '}')),
        if(c_nationkey < 20, '11::107::12', '1::2::3'), cast(round(c_acctbal * 100) as bigint))"""
    # A team listed twice goes by its last entry; nation 5 is not listed.
    teams = ",".join(['{"id":0,"abbr":"old"}', *[f'{{"id":{n},"abbr":"N{n}"}}' for n in range(25) if n != 5], '{"id":99,"abbr":"ZZZ"}'])
    rosters = t.table(spark, folder, "customer").groupBy(F.expr("c_custkey div 40").alias("page")).agg(
        F.concat_ws(",", F.collect_list(F.expr(player))).alias("players"))
    text = F.concat(F.lit(f'<html><script>var vueAppData = {{"teams":[{teams}],"projections":['), F.col("players"),
                    F.lit(']}; var other = {"teams":[]};</script></html>'))
    return rosters.select("page", text.alias("html"))


PAGE_PLAYERS = """
    SELECT CASE WHEN c_nationkey = 3 THEN 'New. ' ELSE 'Customer ' END || c_name[10:] AS player_name, c_mktsegment AS position,
           -- Nation 5 is not in the team list. A zero team id counts as missing, a zero id of the nested team does not.
           CASE WHEN c_nationkey = 5 OR (c_nationkey = 0 AND c_acctbal > 0) THEN '' ELSE 'N' || c_nationkey END AS team,
           round(c_acctbal * 100) AS adp_overall
    FROM customer WHERE c_nationkey < 20 AND c_mktsegment <> 'HOUSEHOLD'"""


@query("s1_parquet_scan", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def _(spark, folder):
    return readers.read_parquet(spark, f"{folder}/part.parquet")


@query("s2_pruned_scan", "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def _(spark, folder):
    wanted = ["l_orderkey", "l_quantity", "not_in_file", "l_returnflag"]
    return readers.read_parquet(spark, f"{folder}/lineitem.parquet", wanted)


@query("s3_present_columns", with_views("SELECT full_name, season, finish, ppg, prev_ppg FROM mega", "mega"))
def _(spark, folder):
    return select_present(c.mega(spark, folder, False), ["full_name", "season", "no_such", "finish", "ppg", "prev_ppg"])


@query("s4_csv_scan", """
    SELECT p_name AS player_name, p_brand AS position, CAST(2025 AS INT) AS season, p_retailprice AS adp_overall
    FROM part""")
def _(spark, folder):
    path = scratch_path(spark, "csv")
    none = F.lit(None).cast("int")
    t.table(spark, folder, "part").select(
        F.lit(1.0).alias("ADP"), F.col("p_retailprice").alias("Overall"), F.col("p_name").alias("Name"),
        F.col("p_brand").alias("Position"), F.lit("T").alias("Team"), none.alias("Times Drafted"),
        F.lit(0.5).alias("Std. Dev"), none.alias("High"), none.alias("Low"), none.alias("Bye"),
    ).write.option("header", True).csv(path)
    return readers.read_market_csv(spark, path, 2025)


@query("s5_source_precedence", with_views("""
    SELECT player_id, season, source, adp_overall FROM first_choice
    UNION ALL SELECT player_id, season, source, adp_overall FROM market
    WHERE source = '2-HIGH' AND season NOT IN (SELECT season FROM first_choice)""", "market",
    first_choice="SELECT * FROM market WHERE source = '1-URGENT' AND season <= 1998"))
def _(spark, folder):
    rows = t.market(spark, folder).select("player_id", "season", "source", "adp_overall")
    first = rows.where((F.col("source") == "1-URGENT") & (F.col("season") <= 1998))
    return readers.with_fallback(first, rows.where("source = '2-HIGH'"), "season")


@query("s6_json_array_records", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
    UNION ALL SELECT event_id, event_id FROM events""")
def _(spark, folder):
    text = F.format_string('[%s,{"k":%d}]', "props", "event_id")
    events = t.table(spark, folder, "events").select("event_id", text.alias("body"))
    return readers.json_records(events, "body", T.StructType([T.StructField("k", T.LongType())]), ["event_id"])


@query("s6b_json_field_records", """
    SELECT event_id, event_type AS name, value AS adp FROM events""")
def _(spark, folder):
    text = F.format_string('{"status":"ok","players":[{"name":"%s","adp":%s}]}', "event_type", F.col("value").cast("string"))
    events = t.table(spark, folder, "events").select("event_id", text.alias("body"))
    record = T.StructType([T.StructField("name", T.StringType()), T.StructField("adp", T.DoubleType())])
    return readers.json_field_records(events, "body", "players", record, ["event_id"])


@query("s7_script_text", r"""
    SELECT page_id, regexp_extract(html, 'var\s+t\s*=\s*"([^"]*)"', 1) AS script_text FROM pages""")
def _(spark, folder):
    pages = t.table(spark, folder, "pages")
    return readers.extract_script_text(pages, "html", "t", "script_text").select("page_id", "script_text")


@query("s7b_script_object", """
    SELECT c_custkey, CAST(2 AS INT) AS n_teams, CAST(1 AS INT) AS n_players, c_mktsegment AS position FROM customer""")
def _(spark, folder):
    parsed = readers.extract_script_json(market_pages(spark, folder), "html", league.PAGE_VARIABLE, shape(MARKET_DOCUMENT))
    d = "document."
    return parsed.select("c_custkey", F.size(d + "teams").alias("n_teams"), F.size(d + "projections").alias("n_players"),
                         F.col(d + "projections")[0]["position"].alias("position"))


@query("s8_flatten_market", f"SELECT player_name, position, adp_overall FROM ({PAGE_PLAYERS})")
def _(spark, folder):
    pages = full_pages(spark, folder)
    return readers.read_market_page(pages, "html", league.PAGE_VARIABLE, KEY, t.SEGMENTS).drop("team")


@query("s9_team_lookup", f"SELECT player_name, team FROM ({PAGE_PLAYERS})")
def _(spark, folder):
    pages = full_pages(spark, folder)
    players = readers.read_market_page(pages, "html", league.PAGE_VARIABLE, KEY, t.SEGMENTS)
    return players.select("player_name", "team")


@query("s10_source_scan", with_views("SELECT * FROM market WHERE source = '2-HIGH'", "market"))
def _(spark, folder):
    path = scratch_path(spark, "market")
    sinks.write_table(t.market(spark, folder), path)
    return readers.read_source(spark, path, "2-HIGH")


@query("s11_distinct_entities", with_views("SELECT DISTINCT full_name, position FROM parts_roster", "parts_roster"))
def _(spark, folder):
    return t.parts_roster(spark, folder).select("full_name", "position").distinct()


@query("s12_schema_tolerant_concat", with_views("""
    SELECT player_id, season, week, fantasy_points_ppr, CAST(NULL AS INT) AS games FROM weekly
    UNION ALL SELECT player_id, season, NULL, fantasy_points_ppr, games FROM season_files""", "weekly", "season_files"))
def _(spark, folder):
    a = t.weekly(spark, folder).select("player_id", "season", "week", "fantasy_points_ppr")
    b = t.season_files(spark, folder).select("season", "player_id", "games", "fantasy_points_ppr")
    return stack_frames([a, b])


@query("s13_keyed_upsert", with_views("""
    SELECT * FROM fresh UNION ALL
    SELECT player_id, season, source, adp_overall, adp_position_rank FROM market m WHERE season <= 1998
      AND NOT EXISTS (SELECT 1 FROM fresh f WHERE f.player_id = m.player_id AND f.season = m.season AND f.source = m.source)
    """, "market", "weekly", fresh="""
    SELECT player_id, season, source, fantasy_points_ppr AS adp_overall, week AS adp_position_rank FROM weekly
    WHERE season >= 1998
    QUALIFY row_number() OVER (PARTITION BY player_id, season, source ORDER BY row_date DESC, row_id DESC) = 1"""))
def _(spark, folder):
    cols, keys = ["player_id", "season", "source", "adp_overall", "adp_position_rank"], ["player_id", "season", "source"]
    old = t.market(spark, folder).where("season <= 1998").select(*cols)
    new = t.weekly(spark, folder).where("season >= 1998").withColumnsRenamed(
        {"fantasy_points_ppr": "adp_overall", "week": "adp_position_rank"})
    shape_of = "player_id BIGINT, season INT, source STRING, adp_overall DOUBLE, adp_position_rank INT"
    stored = KeyedTable(spark, scratch_path(spark, "market-table"), shape_of, keys, "season")
    stored.upsert(old.withColumn("row", F.lit(1)), ["row"])
    stored.upsert(new, ["row_date", "row_id"])
    return stored.read()


@query("s13b_upsert_plan", with_views("""
    SELECT * FROM fresh UNION ALL
    SELECT player_id, season, source, adp_overall, adp_position_rank FROM market m WHERE season <= 1998
      AND NOT EXISTS (SELECT 1 FROM fresh f WHERE f.player_id = m.player_id AND f.season = m.season AND f.source = m.source)
    """, "market", "weekly", fresh="""
    SELECT player_id, season, source, fantasy_points_ppr AS adp_overall, week AS adp_position_rank FROM weekly
    WHERE season >= 1998
    QUALIFY row_number() OVER (PARTITION BY player_id, season, source ORDER BY row_date DESC, row_id DESC) = 1"""))
def _(spark, folder):
    old = t.market(spark, folder).where("season <= 1998").select(
        "player_id", "season", "source", "adp_overall", "adp_position_rank")
    new = t.weekly(spark, folder).where("season >= 1998").withColumnsRenamed(
        {"fantasy_points_ppr": "adp_overall", "week": "adp_position_rank"})
    return sinks.upsert(old, new, ["player_id", "season", "source"], ["row_date", "row_id"])


@query("s14_key_contract", """
    SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(count(*) FILTER (n > 1) AS BIGINT) AS repeated_keys,
           CAST(sum(n - 1) AS BIGINT) AS surplus_rows, CAST(0 AS BIGINT) AS null_l_orderkey,
           CAST(0 AS BIGINT) AS null_l_linenumber
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def _(spark, folder):
    return key_report(t.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("s14b_season_stats_contract", with_views("""
    SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS repeated_keys, CAST(0 AS BIGINT) AS surplus_rows,
           CAST(0 AS BIGINT) AS null_player_id, CAST(0 AS BIGINT) AS null_season FROM season_stats""", "season_stats"))
def _(spark, folder):
    return key_report(c.season_stats(spark, folder), ["player_id", "season"])


@query("s15_incremental_landing", with_views("""
    SELECT season, count(*) AS plays, sum(air_yards) AS air_yards FROM raw_plays WHERE season_type = 'REG'
    GROUP BY season""", "raw_plays"))
def _(spark, folder):
    path = scratch_path(spark, "plays")
    plays = select_present(t.raw_plays(spark, folder).where("season_type = 'REG'"), shape(PLAYS).fieldNames())
    land_incremental(plays.where("season <= 1997"), path)
    land_incremental(plays, path)
    return read_landed(spark, path).groupBy("season").agg(
        F.count(F.lit(1)).alias("plays"), F.sum("air_yards").alias("air_yards"))


@query("s16_parquet_sink", with_views("SELECT * FROM team_rates", "team_rates"))
def _(spark, folder):
    path = scratch_path(spark, "rates")
    sinks.write_table(team_rates(clean_plays(t.raw_plays(spark, folder))), path)
    return spark.read.parquet(path)


#: The ordered column list of each segment's table, and all of them in one order.
TABLES = {p: position_columns(p, t.SEGMENT_STATS, t.SEGMENT_FEATURES) for p in t.ALL_SEGMENTS}
WIDEST = sorted({x for cols in TABLES.values() for x in cols})
# prev_carries and prev_targets stand on both sides of a join and so in no table.
TABLE_ROWS = " UNION ALL ".join(
    f"SELECT '{p}' AS position, " + ", ".join(x if x in cols else f"NULL AS {x}" for x in WIDEST if x not in ("prev_carries", "prev_targets"))
    + f" FROM mega WHERE position = '{p}'" for p, cols in TABLES.items())


@query("s17_csv_sink", with_views(TABLE_ROWS, "mega"))
def _(spark, folder):
    path, wide = scratch_path(spark, "position-tables"), c.mega(spark, folder)
    write_position_tables(wide, path, TABLES)
    types = {f.name: f.dataType for f in wide.schema}
    return stack_frames([sinks.read_table_of(spark, path, "position", p, types).withColumn("position", F.lit(p)) for p in TABLES])
