"""Hand-checked cases for NULL, tie, gap and clash rules."""

import pytest
from pyspark.sql import functions as F

from fieldtally.contracts import MARKET, assert_contract, conform_to, shape
from fieldtally.functions import names, numeric
from fieldtally.operators import joins, metrics, ordering
from fieldtally.operators.aggregates import weighted_mean
from fieldtally.plans import features as feat
from fieldtally.plans.market import market_feed, page_prices
from fieldtally.plans.mega import mega_table
from fieldtally.sources import readers
from fieldtally.sources.sinks import upsert

PAGE = """<script>var vueAppData = {"teams":[{"id":1,"abbr":"AAA"},{"id":2,"abbr":"BBB"}],
"projections":[
 {"first_name":"Ann","last_name":"Lee","position":"WR","team_id":1,"adps":{"11::107::12":{"overall_pick_number":4}}},
 {"first_name":"Bo","last_name":"Ray","position":"WR","team":{"id":2},"adps":{"11::107::12":{"overall_pick_number":2}}},
 {"first_name":"Cy","last_name":"Fox","position":"RB","team_id":9,"adps":{"11::107::12":{"overall_pick_number":7}}},
 {"first_name":"Di","last_name":"Ott","position":"RB","team_id":1,"adps":{"other":{"overall_pick_number":1}}},
 {"first_name":"Ed","last_name":"Orr","position":"PK","team_id":1,"adps":{"11::107::12":{"overall_pick_number":3}}},
 {"first_name":"Flo","last_name":"Kay","position":"TE","team_id":1,"adps":{"11::107::12":{"overall_pick_number":null}}}
]}; var other = 2;</script>"""


def test_market_csv_ranks_ties_by_name(spark, tmp_path, rows):
    path = tmp_path / "feed.csv"
    path.write_text(
        "ADP,Overall,Name,Position,Team,Times Drafted,Std. Dev,High,Low,Bye\n"
        "1.01,5.0,B,WR,X,1,0.5,1,2,9\n1.01,5.0,A,WR,X,1,0.5,1,2,9\n1.01,1.0,C,RB,X,1,0.5,1,2,9\n1.01,2.0,D,PK,X,1,0.5,1,2,9\n"
    )
    feed = readers.read_market_csv(spark, str(path), 2025)
    ranked = market_feed(feed.limit(0), feed)
    assert rows(ranked.select("player_name", "position", "adp_position_rank")) == [
        ("A", "WR", 1), ("B", "WR", 2), ("C", "RB", 1)]


def test_embedded_page(spark, rows):
    pages = spark.createDataFrame([(PAGE,)], "html string")
    roster = spark.createDataFrame([("p1", "Ann Lee Jr.", "WR")], "player_id string, full_name string, position string")
    everyone, generated = page_prices(pages, roster)
    cols = ["player_name", "position", "team", "adp_overall", "adp_position_rank", "player_id"]
    assert rows(everyone.select(*cols)) == [
        ("Ann Lee", "WR", "AAA", 4.0, 2, "p1"), ("Bo Ray", "WR", "BBB", 2.0, 1, "ds-bo-ray"),
        ("Cy Fox", "RB", "", 7.0, 1, "ds-cy-fox")]
    assert generated.count() == 2


@pytest.mark.parametrize("html", ["<script>var somethingElse = {};</script>", "<script>var vueAppData = {broken"])
def test_page_without_object_fails(spark, html):
    pages = spark.createDataFrame([(html,)], "html string")
    players = readers.read_market_page(pages, "html", "vueAppData", "11::107::12", ["WR"])
    with pytest.raises(Exception):
        players.collect()


@pytest.mark.parametrize("raw,long,short", [
    ("  Robert  Griffin III ", "robert griffin", "robert griffin"),
    ("A.J. Brown", "aj brown", "aj brown"),
    ("Ja'Marr Chase", "jamarr chase", "jamarr chase"),
    ("Foo\tBar V", "foo bar", "foo bar v"),
    ("X Y Jr", "x y", "x y"),
    ("X Y Jr.", "x y", "x y"),
    (" José Ünal Sr. ", "josé ünal", "josé ünal"),
    ("v", "", "v"),
])
def test_normalize_name(spark, raw, long, short):
    name = F.lit(raw)
    got = spark.range(1).select(
        names.normalize_name(name, names.LONG_SUFFIXES), names.normalize_name(name, names.SHORT_SUFFIXES)).first()
    assert tuple(got) == (long, short)


def test_replacement_is_not_chained(spark, rows):
    df = spark.createDataFrame([("A",), ("B",)], "n string")
    assert rows(df.select(names.replace_exact(F.col("n"), {"A": "B", "B": "C"}))) == [("B",), ("C",)]


def test_surrogate_id_and_prefix(spark):
    row = spark.range(1).select(names.surrogate_id(F.lit("A.J. Brown"))).first()
    assert row[0] == "ds-aj-brown"


def test_nan_becomes_null(spark, rows):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert rows(numeric.nan_to_null(df)) == [(None,), (None,), (1.0,)]


def test_half_even(spark):
    assert spark.range(1).select(numeric.half_even(F.lit(0.5625), 3)).first()[0] == 0.562


def test_weighted_mean(spark, rows):
    data = [("p1", 2.0, 3.0), ("p1", None, 1.0), ("p2", None, 5.0), ("p3", 4.0, 0.0), (None, 9.0, 9.0)]
    df = spark.createDataFrame(data, "k string, v double, w double")
    assert rows(weighted_mean(df, ["k"], ["v", "absent"], "w")) == [("p1", 1.5), ("p2", 0.0), ("p3", None)]
    strict = weighted_mean(df, ["k"], ["v"], "w", ignore_null_weight=True)
    assert rows(strict) == [("p1", 2.0), ("p2", None), ("p3", None)]


def test_ranks_and_prior_season(spark, rows):
    stats = spark.createDataFrame([
        ("P1", 2015, "WR", 100.0, 10), ("P1", 2016, "WR", 120.0, 12), ("P1", 2018, "WR", 120.0, 0),
        ("P2", 2016, "WR", 120.0, 16), ("P3", 2016, "WR", 300.0, 16), ("P4", 2016, "WR", None, 5),
    ], "player_id string, season int, position string, fantasy_points_ppr double, games_played int")
    market = spark.createDataFrame(
        [("P1", 2018, 5.0, 1, "ffc"), ("P2", 2010, 9.0, 3, "ffc"), ("P4", 2016, 7.0, 2, "ffc"), ("P3", 2016, 1.0, 1, "x")],
        "player_id string, season int, adp_overall double, adp_position_rank int, source string")
    wide = mega_table(stats, market)
    got = rows(wide.select(
        "player_id", "season", "finish", "career_season", "ppg", "prev_ppg", "ppg_delta", "pts_delta", "adp_overall"))
    assert got == [
        ("P1", 2016, 1, 2, 10.0, 10.0, 0.0, 20.0, 300.0), ("P1", 2018, 1, 3, None, None, None, None, 5.0),
        ("P2", 2016, 1, 1, 7.5, None, None, None, 300.0), ("P4", 2016, None, 1, None, None, None, None, 7.0)]


def test_upsert_last_wins_and_repeats(spark, rows):
    schema = "player_id string, season int, source string, adp double, rank int"
    old = spark.createDataFrame([("p1", 2020, "ffc", 10.0, 1), ("p2", 2020, "ffc", 20.0, 2)], schema)
    new = spark.createDataFrame(
        [("p1", 2020, "ffc", 11.0, 1, 1), ("p3", 2020, "ffc", 30.0, 3, 2), ("p1", 2020, "ffc", 12.0, 2, 3)],
        schema + ", seq int")
    keys = ["player_id", "season", "source"]
    once = upsert(old, new, keys, ["seq"])
    expected = [("p1", 2020, "ffc", 12.0, 2), ("p2", 2020, "ffc", 20.0, 2), ("p3", 2020, "ffc", 30.0, 3)]
    assert rows(once) == expected
    assert rows(upsert(once, new, keys, ["seq"])) == expected


def test_column_clash(spark):
    stats = spark.createDataFrame([("a", 2001, 5)], "player_id string, season int, targets int")
    features = spark.createDataFrame([("a", 2000, 7, 1), ("a", 2001, 8, 2)], "player_id string, season int, targets int, x int")
    keys = ["player_id", "season"]
    current = joins.left_join_new_columns(stats, features, keys)
    assert current.columns == ["player_id", "season", "targets", "x"] and current.first()["targets"] == 5
    prior = joins.shift_period(features, keys, "season")
    with_prev = current.withColumn("prev_targets", F.lit(4))
    assert "prev_targets" not in joins.join_with_clash(with_prev, prior, keys).columns
    kept = joins.join_with_clash(with_prev, prior, keys, on_clash="left").first()
    assert (kept["prev_targets"], kept["prev_x"]) == (4, 1)
    both = joins.join_with_clash(with_prev, prior, keys, on_clash="suffix", suffix="_y").first()
    assert (both["prev_targets"], both["prev_targets_y"]) == (4, 7)
    named = joins.outer_join_suffix({"passing": stats, "receiving": features}, keys)
    assert set(named.columns) == {"player_id", "season", "targets", "targets_receiving", "x"}


def _plays(spark):
    def play(team, kind, line, rush="0", scramble="0", throw="0", rusher=None, receiver=None):
        return (2020, "REG", kind, line, team, rush, scramble, None, rusher, receiver, "0", throw)

    data = [play("A", "run", y, rush="1", rusher="R1") for y in (3.0, 15.0)]
    data += [play("A", "run", 50.0, rush="1", throw="x", rusher="R1"), play("A", "run", 40.0, rush="1", rusher="R2")]
    data += [play("A", "pass", y, throw="1", receiver="W1") for y in (18.0, 30.0, None, 20.0)]
    data += [play("B", "run", 5.0, rush="1", scramble="1", rusher="R1")]
    data += [(2020, "POST", "run", 1.0, "A", "1", "0", None, "R1", None, "0", "0")]
    return spark.createDataFrame(
        data, "season int, season_type string, play_type string, yardline_100 double, posteam string, rush_attempt string,"
        "qb_scramble string, passer_player_id string, rusher_player_id string, receiver_player_id string, sack string,"
        "pass_attempt string")


def test_play_features(spark, rows):
    cols = ["player_id", "carries", "rz_carries", "goalline_carries", "designed_rushes", "scrambles", "carry_share",
            "team_pass_rate", "rz_targets"]
    expected = [
        ("R1", 4, 3, 2, 3, 1, 1.0, 0.5, None), ("R2", 1, 0, 0, 1, 0, 0.25, 0.5, None),
        ("W1", None, None, None, None, None, None, None, 2)]
    assert rows(feat.play_features(_plays(spark)).select(*cols)) == expected
    p = feat.clean_plays(_plays(spark))
    assert rows(feat.rusher_team(p)) == [("R1", 2020, "A"), ("R2", 2020, "A")]
    assert rows(feat.team_rates(p)) == [("A", 2020, 4, 4, 0.5), ("B", 2020, 0, 1, 0.0)]


def test_detail_without_optional_column(spark):
    rate = feat.pressure_to_sack_rate(feat.clean_plays(_plays(spark).withColumn("passer_player_id", F.lit("Q"))))
    assert rate.first()["pressure_to_sack_rate"] is None


def test_ranking_metrics(spark):
    data = [(2020, 10.0, 9.0), (2020, 8.0, 5.0), (2020, 6.0, 7.0), (2020, 1.0, 2.0), (2021, 5.0, 5.0)]
    df = spark.createDataFrame(data, "season int, y double, p double")
    per = metrics.topk_by_period(df, "y", "p", "season", 2).collect()
    assert [tuple(r) for r in per] == [(2020, 0.5, 1.0, 2.0)]
    scores = {r["metric"]: r["value"] for r in metrics.evaluate(df, "y", ["p"], "season", 2).collect()}
    assert scores["mae"] == 1.2 and scores["precision_at_k"] == 0.5 and scores["mae_at_k"] == 2.0


def test_topk_ties_and_constant_spearman(spark):
    data = [(2020, 5.0, float(i)) for i in range(5)]
    df = spark.createDataFrame(data, "season int, y double, p double")
    row = metrics.topk_by_period(df, "y", "p", "season", 2).first()
    assert row["precision_at_k"] == 1.0 and row["spearman_at_k"] is None


def test_average_rank(spark, rows):
    df = spark.createDataFrame([(float(v),) for v in (3, 1, 3, 2, 3)], "v double")
    assert rows(ordering.rank_average(df, [], "v", "r")) == [(1.0, 1.0), (2.0, 2.0), (3.0, 4.0), (3.0, 4.0), (3.0, 4.0)]


def test_median_is_interpolated(spark, rows):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, 7.0), (10.0, None), (None, None)], "a double, b double")
    assert rows(ordering.exact_medians(df, ["a", "b"])) == [("a", 2.5), ("b", 7.0)]


def test_contract(spark):
    good = conform_to(spark.createDataFrame([("p", 2020, "ffc")], "player_id string, season int, source string"), shape(MARKET))
    assert [f.dataType for f in good.schema] == [f.dataType for f in shape(MARKET)]
    assert assert_contract(good, ["player_id", "season", "source"]) is good
    with pytest.raises(ValueError):
        assert_contract(good.union(good), ["player_id", "season", "source"])
