"""Landing by period, the keyed table and the contracts that plans carry."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from fieldtally.bindings import tables
from fieldtally.contracts import required, unique_periods
from fieldtally.plans.mega import outcomes
from fieldtally.plans.season_stats import load_season_stats, season_stats, season_stats_table
from fieldtally.sources import keyed
from fieldtally.sources.keyed import KeyedTable
from fieldtally.streaming import incremental
from fieldtally.streaming.incremental import land_incremental, landed_periods, new_periods, read_landed, reload_periods


def test_landing_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "landed")
    plays = tables.raw_plays(spark, SMALL).select("season", "week", "yardline_100")
    land_incremental(plays.where("season <= 1996"), path)
    first = read_landed(spark, path).count()
    land_incremental(plays, path)
    total = read_landed(spark, path).count()
    files = sorted(str(p) for p in (tmp_path / "landed").rglob("part-*"))
    land_incremental(plays, path)
    assert first < total == read_landed(spark, path).count() == plays.count()
    assert files == sorted(str(p) for p in (tmp_path / "landed").rglob("part-*"))
    reload_periods(plays.where("season = 1996").limit(3), path)
    assert read_landed(spark, path).where("season = 1996").count() == 3
    assert read_landed(spark, path).where("season = 1997").count() == plays.where("season = 1997").count()


def test_only_marked_periods_have_landed(spark, tmp_path, plan):
    path = str(tmp_path / "landed")
    assert landed_periods(spark, path, "season") == []
    source = spark.createDataFrame([(2019, 1), (2020, 2), (2020, 5), (None, 3)], "season int, x int")
    land_incremental(source, path)
    assert landed_periods(spark, path, "season") == ["2019", "2020"]
    os.remove(f"{path}/season=2020/_landed")
    assert landed_periods(spark, path, "season") == ["2019"] and read_landed(spark, path).count() == 1
    land_incremental(source, path)
    assert sorted(map(tuple, read_landed(spark, path).collect())) == [(1, 2019), (2, 2020), (5, 2020)]
    delivered = str(tmp_path / "source")
    spark.createDataFrame([(2019, 1), (2021, 2)], "season int, x int").write.partitionBy("season").parquet(delivered)
    fresh = new_periods(spark.read.parquet(delivered), ["2019", "2020"], "season")
    assert [tuple(r) for r in fresh.collect()] == [(2, 2021)]
    assert "PartitionFilters: [isnotnull(season" in plan(fresh) and "Join" not in plan(fresh)


@pytest.mark.parametrize("step", ["write", "move", "mark"])
def test_a_killed_landing_is_repaired(spark, tmp_path, monkeypatch, step):
    """The run stops while files are written, before the second period moves, or before it is marked."""
    path = str(tmp_path / "landed")
    source = spark.createDataFrame([(y, x) for y in (2019, 2020, 2021) for x in range(4)], "season int, x int")
    if step == "write":
        real = incremental.write_partitioned

        def cut(rows, aside, period):
            real(rows.where("season = 2019"), aside, period)
            raise KeyboardInterrupt

        monkeypatch.setattr(incremental, "write_partitioned", cut)
    else:
        real_files, calls = incremental.file_system, []

        def failing(session, target):
            files, place = real_files(session, target)
            mine = target.endswith("/_landed") and "=*" not in target if step == "mark" else "_arriving" not in target and "/season=20" in target and not target.endswith("_landed")
            if mine:
                calls.append(target)
                if len(calls) == 2:
                    raise KeyboardInterrupt
            return files, place

        monkeypatch.setattr(incremental, "file_system", failing)
    with pytest.raises(KeyboardInterrupt):
        land_incremental(source, path)
    monkeypatch.undo()
    assert len(landed_periods(spark, path, "season")) < 3
    land_incremental(source, path)
    assert sorted(map(tuple, read_landed(spark, path).collect())) == sorted((x, y) for y, x in source.collect())
    assert not list((tmp_path / "landed").glob("_arriving-*"))


def stored(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "table"), "k INT, season INT, v STRING", ["k", "season"], "season")


def test_upsert_writes_only_what_it_touches(spark, tmp_path):
    table = stored(spark, tmp_path)
    assert table.read().collect() == [] and table.read().columns == ["k", "season", "v"]
    first = spark.createDataFrame([(k, y, "a", 1) for k in range(200) for y in (2019, 2020, 2021)], "k int, season int, v string, seq int")
    assert table.upsert(first, ["seq"]) == ["2019", "2020", "2021"]
    second = spark.createDataFrame([(1, 2020, "late", 2), (1, 2020, "early", 1), (999, 2020, "new", 1)], first.schema)
    assert table.upsert(second, ["seq"]) == ["2020"]
    written = {p.parent.name for p in (tmp_path / "table" / "batch=2").rglob("part-*")}
    assert written == {"season=2020"}
    got = {(r.k, r.season): r.v for r in table.read().collect()}
    assert len(got) == table.read().count() == 601
    assert got[1, 2020] == "late" and got[999, 2020] == "new" and got[1, 2019] == "a" and got[2, 2020] == "a"
    assert table.upsert(second.where("false"), ["seq"]) == [] and table.read().count() == 601
    assert table.expire() == 1 and table.read().count() == 601 and table.expire() == 0


def test_an_unpublished_batch_is_not_seen(spark, tmp_path, monkeypatch):
    table = stored(spark, tmp_path)
    rows = spark.createDataFrame([(1, 2019, "a", 1)], "k int, season int, v string, seq int")
    table.upsert(rows, ["seq"])
    changed = rows.withColumn("v", F.lit("b"))
    with monkeypatch.context() as m:
        real = keyed.write_partitioned

        def cut(*args):
            real(*args)
            raise KeyboardInterrupt

        m.setattr(keyed, "write_partitioned", cut)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(changed, ["seq"])
    assert table.read().first()["v"] == "a"
    (tmp_path / "table" / "_manifests" / "0000000007.json").write_text('{"2019": "batch')
    assert table.read().first()["v"] == "a"
    table.upsert(changed, ["seq"])
    assert table.read().first()["v"] == "b"


def test_upsert_refuses_missing_keys(spark, tmp_path):
    rows = spark.createDataFrame([(None, 2019, "a", 1)], "k int, season int, v string, seq int")
    with pytest.raises(Exception, match="k is NULL"):
        stored(spark, tmp_path).upsert(rows, ["seq"])
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path), "k INT, season INT", ["k"], "season")


def test_season_load_repeats_and_requires(spark, tmp_path):
    files = tables.season_files(spark, SMALL).where("season = 2001")
    rows = season_stats(None, None, files, seasons=tables.SEASONS, last_weekly=tables.LAST_WEEKLY, positions=tables.ALL_SEGMENTS, overrides=tables.OVERRIDES)
    table = season_stats_table(spark, str(tmp_path / "stats"), rows.schema)
    twice = rows.withColumns({"team": F.lit("old"), "seq": F.lit(1)}).union(rows.withColumn("seq", F.lit(2)))
    load_season_stats(table, twice, ["seq"])
    assert sorted(map(str, table.read().select(*sorted(rows.columns)).collect())) == sorted(map(str, rows.select(*sorted(rows.columns)).collect()))
    nameless = files.withColumn("player_display_name", F.lit(None).cast("string"))
    broken = season_stats(None, None, nameless, seasons=tables.SEASONS, last_weekly=tables.LAST_WEEKLY, positions=tables.ALL_SEGMENTS, overrides=tables.OVERRIDES)
    with pytest.raises(Exception, match="full_name is NULL"):
        broken.collect()


def test_contracts_ride_in_the_plan(spark, plan):
    files = tables.season_files(spark, SMALL)
    rows = season_stats(None, None, files, seasons=tables.SEASONS, last_weekly=1900, positions=tables.ALL_SEGMENTS, overrides=tables.OVERRIDES)
    priced = tables.market(spark, SMALL)
    with pytest.raises(Exception, match="twice"):
        outcomes(rows.union(rows), priced).collect()
    good = spark.createDataFrame([(1, 2019), (1, 2020), (2, 2019)], "player_id int, season int")
    assert unique_periods(good, "player_id", "season").count() == required(good, ["player_id"]).count() == 3
    with pytest.raises(Exception, match="player_id 1 has season 2019 twice"):
        unique_periods(good.union(good.limit(1)), "player_id", "season").collect()
    timed = lambda df: df.withColumn("n", F.row_number().over(__import__("pyspark").sql.Window.partitionBy("player_id").orderBy("season")))
    assert plan(timed(unique_periods(good, "player_id", "season"))).count("Exchange") == plan(timed(good)).count("Exchange")
