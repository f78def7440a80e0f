"""Null, cast and text rules that differ from Spark's defaults."""

from pyspark.sql import functions as F

from freshet.functions import nulls, ordinal, text
from freshet.operators import joins


def values(df, col):
    return [r[col] for r in df.collect()]


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("OP",), ("main",), (None,)], "s string")
    assert values(df.where(nulls.not_in(F.col("s"), ["OP"])), "s") == ["main", None]


def test_joins_match_null_keys(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2), ("y", 3)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, b int")
    assert {(r.k, r.a, r.b) for r in joins.left_join(a, b, "k").collect()} == {(None, 1, 10), ("x", 2, 20), ("y", 3, None)}
    assert {r.a for r in joins.semi_join(a, b, "k").collect()} == {1, 2}
    assert {r.a for r in joins.anti_join(a, b, "k").collect()} == {3}


def test_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 2)], "k string, v int")
    got = {r.k: r.s for r in df.groupBy("k").agg(nulls.sum0(F.col("v")).alias("s")).collect()}
    assert got == {"a": 0, "b": 2}


def test_paste_spells_null(spark):
    df = spark.createDataFrame([("Y", None)], "a string, b string")
    assert values(df.select(nulls.paste(F.col("a"), F.col("b")).alias("c")), "c") == ["YNA"]


def test_flag_keeps_null(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("?",), (None,)], "f string")
    assert values(df.select(nulls.flag_to_int(F.col("f")).alias("v")), "v") == [1, 0, 0, None]


def test_text_numbers(spark):
    df = spark.createDataFrame([("1.234",), ("n/a",), (None,)], "v string")
    assert values(nulls.clean_numeric(df, ["v"]), "v") == [1.23, None, None]
    assert values(spark.createDataFrame([("12",), ("x",)], "v string").select(nulls.to_int(F.col("v")).alias("v")), "v") == [12, None]


def test_fill_missing_leaves_keys_and_dates(spark):
    df = spark.sql("SELECT CAST(NULL AS INT) k, CAST(NULL AS INT) n, CAST(NULL AS STRING) t, CAST(NULL AS DATE) d")
    row = nulls.fill_missing(df, keys=["k"]).first()
    assert (row.k, row.n, row.t, row.d) == (None, 0, "Unknown", None)


def test_unranked_levels_are_null(spark):
    df = spark.createDataFrame([("Not Sensitive",), ("else",), (None,)], "s string")
    code = ordinal.encode(F.col("s"), ordinal.SENSITIVITY)
    assert values(df.select(code.alias("c")), "c") == [0, None, None]


def test_snake_case(spark):
    assert [text.snake(n) for n in ("Max_Summer", "20% MAD", "DA km2", "MAD L/s", "EcoProvince")] == [
        "max_summer", "20_mad", "da_km_2", "mad_l_s", "eco_province"]
    df = spark.createDataFrame([("Alsek Ranges",), ("St. Elias-Mtns 2b",)], "s string")
    assert values(df.select(text.snake_value(F.col("s")).alias("v")), "v") == ["alsek_ranges", "st_elias_mtns_2_b"]


def test_heavy_keys_give_the_same_join(spark):
    rows = spark.range(5000).select((F.col("id") % 3 == 0).alias("hot"), "id").select(
        F.when(F.col("hot"), F.lit(None).cast("long")).otherwise(F.col("id") % 50).alias("k"), "id").repartition(8, "id")
    per_key = rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("total"))
    spread = joins.join_back(rows, per_key, "k", heavy_rows=90)
    plain = joins.left_join(rows, per_key.drop("n"), "k")
    assert spread.count() == 5000
    assert spread.exceptAll(plain).isEmpty()
    salted = joins.heavy_keys(per_key, "k", heavy_rows=90)
    assert 0 < salted.count() <= joins.MAX_HEAVY
