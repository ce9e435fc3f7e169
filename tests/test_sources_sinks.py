"""Landing, upserts, sinks and scratch handling."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMALL
from fieldtally.bindings import composed, tables
from fieldtally.contracts import PLAYS
from fieldtally.operators import regression
from fieldtally.operators.joins import match_entities
from fieldtally.plans import league
from fieldtally.plans.mega import position_columns, position_table, write_position_tables
from fieldtally.session import drop_scratch, scratch_path, settle, shared_dir
from fieldtally.sources import readers, sinks


def test_missing_columns_read_as_null(spark, tmp_path):
    path = str(tmp_path / "old")
    tables.raw_plays(spark, SMALL).select("season", "week", "air_yards").write.parquet(path)
    df = readers.read_contract(spark, path, PLAYS)
    assert df.where("cpoe is not null").count() == 0 and df.where("air_yards is not null").count() > 0


def test_select_present_scan(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.range(3).select(F.col("id").alias("a"), F.lit(1).alias("b")).write.parquet(path)
    assert readers.read_parquet(spark, path, ["b", "zz", "a"]).columns == ["b", "a"]


def test_write_upsert_goes_to_a_fresh_path(spark, tmp_path):
    schema = "k int, v int"
    old, new = spark.createDataFrame([(1, 1), (2, 2)], schema), spark.createDataFrame([(2, 9, 1)], schema + ", seq int")
    sinks.write_upsert(old, new, ["k"], ["seq"], str(tmp_path / "v2"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "v2")).collect()} == {(1, 1), (2, 9)}


def test_csv_tables_have_their_own_columns_and_order(spark, tmp_path):
    wide = composed.mega(spark, SMALL, False)
    cols = {"BUILDING": ["full_name", "season", "finish", "not_there", "player_id"], "MACHINERY": ["ppg", "full_name"]}
    write_position_tables(wide, str(tmp_path), cols)
    types = {f.name: f.dataType for f in wide.schema}
    for value, wanted in cols.items():
        got = sinks.read_table_of(spark, str(tmp_path), "position", value, types)
        want = position_table(wide, value, cols[value])
        assert got.columns == want.columns == [c for c in wanted if c != "not_there"]
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    folder = tmp_path / "position=BUILDING"
    lines = [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]
    assert (folder / "_header").read_text() == "full_name,season,finish,player_id\n"
    seasons = [int(line.split(",")[1]) for line in lines]
    assert seasons == sorted(seasons) and len(set(seasons)) > 2
    assert sorted(p.name for p in tmp_path.glob("position=*")) == ["position=BUILDING", "position=MACHINERY"]


def test_csv_tables_keep_odd_text(spark, tmp_path):
    rows = [("a", 'x,"y"', None, 1), ("a", "", "q", 2), ("b", "é", "z", 3), ("other", "n", "n", 4)]
    df = spark.createDataFrame(rows, "position string, t string, u string, k int")
    sinks.write_tables_by_value(df, str(tmp_path), "position", {"a": ["k", "t", "u"], "b": ["t"]})
    types = {f.name: f.dataType for f in df.schema}
    assert sorted(map(tuple, sinks.read_table_of(spark, str(tmp_path), "position", "a", types).collect())) == [(1, 'x,"y"', None), (2, "", "q")]
    assert [tuple(r) for r in sinks.read_table_of(spark, str(tmp_path), "position", "b", types).collect()] == [("é",)]


def test_position_columns_follow_the_league_lists():
    cols = position_columns("QB")
    assert cols[:3] == ["full_name", "season", "career_season"] and "prev_scrambles" in cols and "prev_carries" in cols
    assert len(cols) == len(league.POSITION_BASE) + 2 * (10 + 9)
    assert position_columns("WR") == position_columns("TE")


def test_settled_table_survives_changes_of_its_source(spark, tmp_path):
    path = str(tmp_path / "src")
    spark.range(5).write.parquet(path)
    kept = settle(spark.read.parquet(path))
    spark.range(2).write.mode("overwrite").parquet(path)
    assert kept.count() == 5


def test_scratch_is_below_the_configured_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_ridge_matches_the_closed_form(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3))
    x = (x - x.mean(0)) / x.std(0)
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=60) + 4
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    model = regression.fit_ridge(regression.assemble(df, ["a", "b", "c"]), "y", 10.0)
    want = np.linalg.solve(x.T @ x + 10 * np.eye(3), x.T @ (y - y.mean()))
    assert np.allclose(model.coefficients.toArray(), want, atol=1e-8)
    pair = regression.ridge_pair(df, ("a", "b"), "y", [], 1.0).first()
    two = x[:, :2]
    want = np.linalg.solve(two.T @ two + np.eye(2), two.T @ (y - y.mean()))
    assert np.allclose([pair["coef_a"], pair["coef_b"]], want) and abs(pair["intercept"] - y.mean()) < 1e-9


def test_impute_and_scale_by_group(spark):
    rows = [("a", 1.0, None), ("a", 3.0, None), ("a", None, None), ("b", 5.0, 1.0), ("b", 5.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, z double")
    medians = regression.median_table(df, ["x", "z"], ["g"])
    filled = regression.impute_median(df, medians, ["x", "z"], ["g"])
    got = sorted(tuple(r) for r in filled.collect())
    assert got == [("a", 1.0, 0.0), ("a", 2.0, 0.0), ("a", 3.0, 0.0), ("b", 5.0, 1.0), ("b", 5.0, 1.0)]
    scaled = regression.standardize(filled, regression.scale_table(filled, ["x", "z"], ["g"]), ["x", "z"], ["g"])
    assert {r["x"] for r in scaled.where("g = 'b'").collect()} == {0.0}
    assert max(r["x"] for r in scaled.where("g = 'a'").collect()) == 1.5 ** 0.5


def test_fallback_looks_at_raw_rows(spark):
    schema = T.StructType([T.StructField("season", T.IntegerType()), T.StructField("position", T.StringType())])
    first = spark.createDataFrame([(2020, "PK")], schema)
    second = spark.createDataFrame([(2020, "QB"), (2021, "QB")], schema)
    got = {tuple(r) for r in readers.with_fallback(first, second, "season").collect()}
    assert got == {(2020, "PK"), (2021, "QB")}


def test_feature_lists_and_scratch_cleanup(spark, tmp_path):
    lists = sinks.feature_list({"market": ["a", "b"], "residual": ["c"]}, spark)
    sinks.write_json(lists, str(tmp_path / "lists"))
    assert spark.read.json(str(tmp_path / "lists")).count() == 3
    settle(spark.range(2)).count()
    assert drop_scratch(spark) and not drop_scratch(spark)


def test_frequent_name_on_both_sides_matches_whole(spark):
    feed = [(f"Smith, J{'.' * (i % 2)} Jr.", "WR", float(i)) for i in range(30)] + [(f"Other {i}", "WR", 0.0) for i in range(60)]
    roster = [(i, "smith, j", "WR") for i in range(40)] + [(100 + i, f"OTHER {i}", "WR") for i in range(50)]
    f = spark.createDataFrame(feed, "player_name string, position string, adp double")
    r = spark.createDataFrame(roster, "player_id int, full_name string, position string")
    matched, missing = match_entities(f, r, "player_name", ["position"])
    assert matched.count() == 30 * 40 + 50 and missing.count() == 10
    everyone, generated = match_entities(f, r, "player_name", ["position"], unmatched="generate")
    frame = everyone.toPandas()
    assert len(frame) == 30 * 40 + 60 and frame["is_generated"].sum() == generated.count() == 10
    assert frame["player_id"].notna().all()
