"""Per-key operators on the hand-written edge rows."""

from pyspark.sql import functions as F

from freshet.functions.ordinal import SENSITIVITY
from freshet.operators import groups, naming

NAMES = ([(1, "A")] * 3 + [(1, "B")] + [(2, "A")] * 3 + [(2, "Unknown")] + [(3, "A")] + [(3, "Unknown")] * 2
         + [(4, "Unknown"), (4, None)] + [(5, "Unknown")] * 4)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_name_repair(spark):
    df = spark.createDataFrame(NAMES, "BLUE_LINE_KEY int, GNIS_NAME string")
    fixed = {r[0]: r[1] for r in naming.repair_names(df, "BLUE_LINE_KEY").distinct().collect()}
    assert fixed == {1: "A, B", 2: "A", 3: "A", 4: None, 5: "Unknown"}
    literal = {r[0]: r[1] for r in naming.repair_names(df, "BLUE_LINE_KEY", "literal").distinct().collect()}
    assert literal == {1: "A, B", 2: "A", 3: "NA, A", 4: "NA", 5: "Unknown"}


def test_literal_repair_clips_names_that_start_with_na(spark):
    df = spark.createDataFrame([(1, "B"), (1, "B"), (1, "NARROWS")], "BLUE_LINE_KEY int, GNIS_NAME string")
    assert naming.name_correctors(df, "BLUE_LINE_KEY", "literal").first().corrector == "BRROWS"


def test_highest_level(spark):
    rows = [(1, None), (1, "Not Sensitive"), (1, "not a level"), (2, "not a level"), (None, SENSITIVITY[2]), (None, None)]
    df = spark.createDataFrame(rows, "k int, s string")
    for heavy_rows in (10, 1):
        got = {(r.k, r.s) for r in groups.max_level(df, "k", ["s"], SENSITIVITY, heavy_rows=heavy_rows).collect()}
        assert got == {(1, "Not Sensitive"), (2, None), (None, SENSITIVITY[2])}


def test_keep_best(spark):
    df = spark.createDataFrame([(1, 3, 1), (1, 7, 2), (1, 7, 3), (1, None, 4), (2, None, 5)], "k int, score int, ord int")
    assert {(r.k, r.ord) for r in groups.keep_best(df, "k", "score", "ord").collect()} == {(1, 2), (2, 5)}


def test_first_per_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("k"), "id")
    first = groups.first_per(df, "k", "id")
    assert sorted(r.id for r in first.collect()) == [0, 1, 2, 3, 4]
    assert "WindowGroupLimit" in plan(first).split("Exchange")[-1]


def test_column_wise_duplicates(spark):
    rows = [("g1", "Y", "Y", 1, 1), ("g1", "N", "N", 2, 2), ("g2", "Y", "N", 1, 3), ("g1", "Y", "Y", 1, 4)]
    df = spark.createDataFrame(rows, "g string, s string, w string, b int, row_id int")
    for heavy_rows in (10, 1):
        flagged = groups.column_dupes(df, ["g", "s", "w", "b"], "row_id", heavy_rows=heavy_rows)
        assert {r.row_id for r in flagged.where("is_dup").collect()} == {4}


def test_text_list_keeps_order_repeats_and_nulls(spark):
    rows = [(1, "S1", 1), (1, "S1", 2), (1, None, 3), (2, "B", 5), (2, "A", 9)]
    df = spark.createDataFrame(rows, "k int, s string, ord int")
    assert {r.k: r.t for r in groups.text_list(df, "k", {"t": "s"}, "ord").collect()} == {1: "S1, S1, NA", 2: "B, A"}
    once = groups.text_list(df, "k", {"t": "s"}, "ord", distinct=True)
    assert {r.k: r.t for r in once.collect()} == {1: "S1, NA", 2: "B, A"}


def test_text_list_of_a_heavy_key(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("k"), "id")
    df = df.withColumn("s", F.col("id").cast("string")).repartition(8)
    text = groups.text_list(df, "k", {"t": "s"}, "id").where("k = 1").first().t
    assert text == ", ".join(str(i) for i in range(4000) if i % 3 > 0)


def test_counts_and_ties(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), (None, 4)], "k string, v int")
    assert [tuple(r) for r in groups.count_by(df, "k").collect()] == [("a", 3), (None, 1)]
    assert sorted((r.v, r.n) for r in groups.add_count(df, "k", heavy_rows=1).collect()) == [(1, 3), (2, 3), (2, 3), (4, 1)]
    assert sorted(r.v for r in groups.top_tied(df, "k", "v").collect()) == [2, 2, 4]
