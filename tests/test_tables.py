from pyspark.sql import functions as F

from huddle.operators import player, tables

# A few full-name -> abbreviation pairs (fixed values of the name map).
NAMES = {"Washington Commanders": "WAS", "Washington Football Team": "WAS", "Kansas City Chiefs": "KC"}


def test_map_values_keeps_unmapped(spark):
    df = spark.createDataFrame([("Washington Commanders",), ("Washington Football Team",), ("Atlantis",)], "Tm string")
    assert sorted(r.Tm for r in player.map_values(df, "Tm", NAMES).collect()) == ["Atlantis", "WAS", "WAS"]


def test_lookup_first_match_and_missing(spark):
    left = spark.createDataFrame([(1, "WAS", 2023), (2, "KC", 2023), (3, "NYJ", 2023), (4, "WAS", 2022)],
                                 "id int, opponent_team string, season int")
    right = spark.createDataFrame([("WAS", 2023, 10.0, 2), ("WAS", 2023, 5.0, 1), ("KC", 2023, 7.0, 1)],
                                  "Tm string, Season int, QB double, src_order int")
    out = player.lookup_first(left, right.withColumn("QB", F.col("QB")), ["opponent_team", "season"],
                              ["Tm", "Season"], "QB", "QB_allowed", order=["src_order"])
    got = {r.id: r.QB_allowed for r in out.collect()}
    assert got == {1: 5.0, 2: 7.0, 3: None, 4: None}
    assert out.count() == left.count()  # two matching rows never duplicate a left row


def test_pivot_and_full_outer(spark):
    rows = spark.createDataFrame(
        [("A", 2023, "RB", 1.0), ("A", 2023, "QB", 2.0), ("B", 2023, "RB", 3.0)],
        "Tm string, Season int, position string, value double")
    piv = {r.Tm: r for r in tables.pivot_positions(rows, ["Tm", "Season"], "position", "value", ["RB", "QB"]).collect()}
    assert piv["A"].QB == 2.0 and piv["B"].QB is None and piv["B"].RB == 3.0
    frames = [rows.filter(F.col("position") == p).select("Tm", "Season", F.col("value").alias(p)) for p in ("RB", "QB")]
    u = tables.full_outer_merge(frames, ["Tm", "Season"])
    j = tables.full_outer_merge(frames, ["Tm", "Season"], method="join").select(*u.columns)
    assert sorted(map(tuple, u.collect()), key=repr) == sorted(map(tuple, j.collect()), key=repr)
    assert u.count() == 2


def test_union_all_aligns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    out = tables.union_all([a, b]).orderBy("k").collect()
    assert (out[0].k, out[0].a, out[0].b) == (1, "x", None) and (out[1].k, out[1].b) == (2, "y")


def test_top_n(spark):
    df = spark.createDataFrame([("b", 0.3), ("a", 0.3), ("c", 0.0), ("d", 0.4)], "feature string, importance double")
    got = [r.feature for r in tables.top_n(df, "importance", 15, tie_break=["feature"]).collect()]
    assert got == ["d", "a", "b"]  # fewer than n; ties by name; zero dropped
    assert [r.feature for r in tables.top_n(df, "importance", 2, tie_break=["feature"]).collect()] == ["d", "a"]
    per = tables.top_n_per_group(df.withColumn("g", F.lit(1)), ["g"], "importance", 1, ["feature"]).collect()
    assert [r.feature for r in per] == ["d"]


def test_merge_pairs_repeated_keys(spark):
    a = spark.createDataFrame([("x", 2.5), ("x", 9.5), ("y", 1.0)], "k string, a double")
    b = spark.createDataFrame([("x", 4.0), ("z", 5.0)], "k string, b double")
    out = tables.full_outer_merge([a, b], ["k"], method="pair")
    assert sorted(map(tuple, out.collect()), key=repr) == [("x", 2.5, 4.0), ("x", 9.5, None), ("y", 1.0, None), ("z", None, 5.0)]
