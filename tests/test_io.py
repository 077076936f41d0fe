import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from huddle import schemas
from huddle.sinks import files as sinks
from huddle.sinks.landing import land
from huddle.sources import catalog, params
from huddle.sources.files import conform, read_csv, read_plays, read_snap_counts, read_table


def season_rows(spark, season, n=3):
    rows = [(season, w, f"g{season}{w}", "A", "B", "A", "B", float(w)) for w in range(1, n + 1)]
    df = spark.createDataFrame(rows, "season int, week int, game_id string, home_team string, away_team string, "
                                     "posteam string, defteam string, epa double")
    return conform(df, schemas.PLAYS, optional=schemas.PLAYS.names)


def test_landing_is_incremental(spark, tmp_path):
    target = str(tmp_path / "plays")
    land(spark, season_rows(spark, 2022), target)
    land(spark, season_rows(spark, 2022, n=5).unionByName(season_rows(spark, 2023)), target)
    land(spark, season_rows(spark, 2023).limit(0), target)  # empty input
    got = read_plays(spark, target)
    counts = {r.season: r["count"] for r in got.groupBy("season").count().collect()}
    assert counts == {2022: 3, 2023: 3}  # 2022 already present: skipped


def test_streaming_landing(spark, tmp_path):
    from huddle.streaming.landing import season_landing_stream

    incoming, target, ckpt = (str(tmp_path / d) for d in ("in", "out", "ckpt"))
    season_rows(spark, 2021).write.parquet(os.path.join(incoming, "pbp_2021"))
    q = season_landing_stream(spark, incoming + "/*", target, ckpt)
    q.awaitTermination(120)
    season_rows(spark, 2021, n=4).write.parquet(os.path.join(incoming, "pbp_2021_again"))
    season_rows(spark, 2022).write.parquet(os.path.join(incoming, "pbp_2022"))
    q = season_landing_stream(spark, incoming + "/*", target, ckpt)
    q.awaitTermination(120)
    counts = {r.season: r["count"] for r in read_plays(spark, target).groupBy("season").count().collect()}
    assert counts == {2021: 7, 2022: 3}  # the season goes on in a second file
    q = season_landing_stream(spark, incoming + "/*", target, str(tmp_path / "ckpt2"))
    q.awaitTermination(120)
    assert read_plays(spark, target).count() == 10  # the same files again add nothing


def test_streaming_landing_does_not_depend_on_batches(spark, tmp_path):
    from huddle.streaming.landing import season_landing_stream

    incoming, target, ckpt = (str(tmp_path / d) for d in ("in", "out", "ckpt"))
    for n in (1, 2, 3):
        season_rows(spark, 2023, n=n).coalesce(1).write.mode("append").parquet(incoming)
    q = season_landing_stream(spark, incoming, target, ckpt, max_files_per_trigger=1)
    q.awaitTermination(120)
    assert read_plays(spark, target).count() == 6


def test_landing_null_keys_and_misspelt_keys(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.createDataFrame([(None, 1.0), (2020, 2.0)], "season int, epa double")
    for _ in range(3):
        land(spark, rows, target)
    assert spark.read.parquet(target).count() == 2
    with pytest.raises(AnalysisException):
        land(spark, rows.withColumnRenamed("season", "saeson"), target, keys=["saeson"])


def test_csv_is_read_by_name(spark, tmp_path):
    path = tmp_path / "games.csv"
    path.write_text("game_id,season,game_type,week,away_team,home_team,spread_line\ng1,2023,REG,1.0,ARI,WAS,7\ng2,2023,REG,2,BUF,NYJ,NA\n")
    got = read_csv(spark, str(path), schemas.GAMES).orderBy("week").collect()
    assert [(r.season, r.week, r.home_team, r.away_team, r.spread_line) for r in got] == [(2023, 1, "WAS", "ARI", 7.0), (2023, 2, "NYJ", "BUF", None)]
    path.write_text("season,week,home_team,spread_line\n2023,1,WAS,7\n")
    with pytest.raises(ValueError, match="away_team"):
        read_csv(spark, str(path), schemas.GAMES)
    path.write_text("season,week,home_team,away_team,spread_line\n2023,one,WAS,ARI,7\n")
    with pytest.raises(Exception, match="column week"):
        read_csv(spark, str(path), schemas.GAMES).collect()


def test_conform_wants_declared_columns(spark):
    with pytest.raises(ValueError, match="epa"):
        conform(spark.createDataFrame([(2020,)], "season int"), schemas.PLAYS)


def test_read_table_sees_appended_rows(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    for n in (3, 8):
        spark.range(3 if n == 3 else 5).write.mode("append").parquet(path)
        assert read_table(spark, str(tmp_path), "t").count() == n


def test_read_plays_prunes_seasons_and_columns(spark, tmp_path):
    target = str(tmp_path / "plays")
    wide = season_rows(spark, 2020).unionByName(season_rows(spark, 2021)).withColumn("unused", F.lit("x"))
    wide.write.partitionBy("season").parquet(target)
    df = read_plays(spark, target, seasons=[2021])
    plan = df.select("epa")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "unused" not in plan
    assert df.count() == 3 and df.columns == [f.name for f in schemas.PLAYS.fields]


def test_csv_round_trip_with_schema(spark, tmp_path):
    path = str(tmp_path / "games")
    games = spark.createDataFrame([(2023, 1, "WAS", "ARI", 7.0), (2023, 1, "NYJ", "BUF", None)], schemas.GAMES)
    sinks.write_csv(games, path, single_file=True)
    back = read_csv(spark, path, schemas.GAMES)
    assert back.schema == schemas.GAMES
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, games.collect()), key=repr)


def test_report_lines(spark, tmp_path):
    table = spark.createDataFrame([("lr", 1.234567, 0), ("a_very_long_regressor_name", 10.0, 1)],
                                  "regressor string, mse double, pos int")
    lines = [r.line for r in sinks.report_lines(table, "regressor", "mse", "pos").orderBy("line_no").collect()]
    assert lines[0] == f"{'Regressor':<20} {'MSE':<20}"
    assert lines[1] == "=" * 60
    assert lines[2] == f"{'lr':<20} {1.234567:<20.5f}"
    assert lines[3] == f"{'a_very_long_regressor_name':<20} {10.0:<20.5f}"
    out = str(tmp_path / "report")
    sinks.write_text_lines(sinks.report_lines(table, "regressor", "mse", "pos"), out)
    text = open([os.path.join(out, f) for f in os.listdir(out) if f.startswith("part-")][0]).read().splitlines()
    assert text == lines


def test_catalogue_and_grid(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a long, b string")
    prof = {r.name: r for r in catalog.column_profile(df).collect()}
    assert (prof["a"].ordinal, prof["a"].type, prof["a"].non_null, prof["a"].nulls) == (1, "BIGINT", 2, 0)
    assert (prof["b"].type, prof["b"].nulls) == ("VARCHAR", 1)
    assert [r.name for r in catalog.column_names(df).collect()] == ["a", "b"]
    grid = params.season_position_grid(spark, [2021, 2022]).collect()
    assert len(grid) == 8
    assert grid[0].url.endswith("/years/2021/fantasy-points-against-RB.htm")


def test_jdbc_round_trip(spark):
    from huddle.sources import jdbc

    url = "jdbc:derby:memory:huddle_test;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(i, f"p{i}", float(i)) for i in range(25)], "id int, name string, carries double")
    try:
        jdbc.write_table(df, url, "PLAYER_STATS", props, batch_size=10)
    except Exception as e:  # noqa: BLE001
        if "ClassNotFound" in str(e) or "No suitable driver" in str(e):
            pytest.skip("no embedded JDBC driver on the classpath")
        raise
    back = jdbc.read_table(spark, url, "PLAYER_STATS", props, partition_column="ID", lower_bound=0,
                           upper_bound=25, num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert back.filter(F.col("CARRIES") > 10).count() == 14

    # a replacement that fails leaves the old rows and no other table
    broken = df.withColumn("name", F.when(F.col("id") == 20, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("name")))
    with pytest.raises(Exception, match="broken"):
        jdbc.write_table(broken, url, "PLAYER_STATS", props)
    assert jdbc.read_table(spark, url, "PLAYER_STATS", props).count() == 25
    listed = jdbc.read_table(spark, url, "SYS.SYSTABLES", props).filter("TABLENAME like 'PLAYER_STATS%'")
    assert [r.TABLENAME for r in listed.select("TABLENAME").collect()] == ["PLAYER_STATS"]

    # a replacement that succeeds has the new rows alone; ranges by quantiles hold every row, nulls too
    skewed = spark.range(400).select(F.when(F.col("id") < 300, F.lit(7)).when(F.col("id") < 390, F.col("id")).cast("int").alias("id"))
    jdbc.write_table(skewed, url, "PLAYER_STATS", props)
    back = jdbc.read_table(spark, url, "PLAYER_STATS", props, partition_column="ID", num_partitions=8)
    assert 2 <= back.rdd.getNumPartitions() <= 8 and back.columns == ["id"]
    assert back.count() == 400 and back.filter("ID is null").count() == 10 and back.filter("ID = 7").count() == 300
    with pytest.raises(ValueError, match="rename"):
        jdbc.write_table(df, "jdbc:unheardof:x", "T")


def test_write_column_catalogue(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 2.0)], "season int, team string, epa double")
    out = str(tmp_path / "cols")
    catalog.write_column_catalogue(df, out)
    text = open([os.path.join(out, f) for f in os.listdir(out) if f.startswith("part-")][0]).read().splitlines()
    assert text == ["season", "team", "epa"]


def _file_batch(spark, *files):
    rows = [(2020 + i, i, f) for f in files for i in range(3 if f == "fa" else 2)]
    return spark.createDataFrame(rows, "season int, week int, _file string")


def test_landing_survives_a_crash_before_the_log(spark, tmp_path, monkeypatch):
    """Rows written but not entered come again in another batch: same folder, same rows."""
    from pyspark.sql.readwriter import DataFrameWriter

    from huddle.sinks import landing

    target, plain = str(tmp_path / "t"), DataFrameWriter.parquet

    def failing(self, path, *args, **kw):
        if "_landed" in path:
            raise OSError("lost")
        return plain(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(OSError):
        landing.land_files(_file_batch(spark, "fa"), target)
    monkeypatch.undo()
    for batch in (("fa", "fb"), ("fb",), ("fc", "fa")):
        landing.land_files(_file_batch(spark, *batch), target)
    assert spark.read.parquet(target).count() == 3 + 2 + 2 == landing.read_landed(spark, target).count()
    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(OSError):
        landing.land_files(_file_batch(spark, "fd"), target)
    monkeypatch.undo()
    assert landing.read_landed(spark, target).count() == 7  # not what an interrupted run left


def test_whole_partitions_survive_a_crash_before_the_log(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    target, plain, calls = str(tmp_path / "t"), DataFrameWriter.parquet, []
    land(spark, season_rows(spark, 2021), target)

    def failing(self, path, *args, **kw):
        calls.append(path)
        if path.endswith("_landed_keys"):
            raise OSError("lost")
        return plain(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(OSError):
        land(spark, season_rows(spark, 2022), target)
    monkeypatch.undo()
    land(spark, season_rows(spark, 2021).unionByName(season_rows(spark, 2022)), target)
    land(spark, season_rows(spark, 2022, n=9), target)
    counts = {r.season: r["count"] for r in spark.read.parquet(target).groupBy("season").count().collect()}
    n = season_rows(spark, 2021).count()
    assert calls and counts == {2021: n, 2022: n}


def test_a_target_from_before_the_log_is_adopted(spark, tmp_path):
    target = str(tmp_path / "t")
    season_rows(spark, 2021).write.partitionBy("season").parquet(target)
    land(spark, season_rows(spark, 2021, n=7).unionByName(season_rows(spark, 2022)), target)
    n = season_rows(spark, 2021).count()
    assert {r.season: r["count"] for r in spark.read.parquet(target).groupBy("season").count().collect()} == {2021: n, 2022: n}


def test_seasons_with_different_types_are_widened(spark, tmp_path):
    path, epa = str(tmp_path / "p"), []
    for season, kind in ((2020, "bigint"), (2021, "double"), (2022, "int"), (2023, "double")):
        rows = season_rows(spark, season).drop("season")
        rows = rows.withColumn("epa", F.lit(season - 2019).cast(kind))
        rows.write.parquet(f"{path}/season={season}")
        epa.append((season, float(season - 2019)))
    got = read_plays(spark, path).select("season", "epa").distinct()
    assert sorted(map(tuple, got.collect())) == epa and got.schema["epa"].dataType.typeName() == "double"
    assert {r.season for r in read_plays(spark, path, seasons=[2020, 2023]).select("season").distinct().collect()} == {2020, 2023}


def test_snap_counts_by_season(spark, tmp_path):
    row = "'g1' game_id, 2023 season, 1 week, 'A' player, 'QB' position, 'KC' team, 'DET' opponent, 60 offense_snaps, double('NaN') offense_pct, 0 defense_snaps, 0D defense_pct, 3 st_snaps, 0.1D st_pct, 'x' more"
    df = spark.sql(f"select {row}")
    df.union(df.withColumn("season", F.lit(2022))).write.parquet(str(tmp_path / "snaps"))
    found = read_snap_counts(spark, str(tmp_path / "snaps"), seasons=[2023])
    assert found.schema == schemas.SNAP_COUNTS
    assert [(r.season, r.offense_snaps, r.offense_pct, r.st_pct) for r in found.collect()] == [(2023, 60.0, None, 0.1)]
    df.coalesce(1).write.option("header", True).csv(str(tmp_path / "snaps_csv"))
    assert read_snap_counts(spark, str(tmp_path / "snaps_csv"), fmt="csv").count() == 1
    with pytest.raises(ValueError, match="st_pct"):
        read_snap_counts(spark, _without(df, "st_pct", tmp_path))


def _without(df, column, tmp_path):
    df.drop(column).write.parquet(str(tmp_path / "without"))
    return str(tmp_path / "without")
