"""Scoring rules and value scales."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from freshet.functions.ordinal import FISH, HABITAT, SENSITIVITY
from freshet.operators import scales, score
from freshet.plans import explorer, species

COLUMNS = ("k int, summer_sens string, winter_sens string, stream_summer_sens string, stream_winter_sens string,"
           " fish_observed string, habitat_value string, number_distinct_SAR long")


def test_risk(spark):
    rows = [(1,) + (None,) * 7,
            (2, SENSITIVITY[2], SENSITIVITY[1], "Y", "N", "Y", HABITAT[2], 3),
            (2, SENSITIVITY[1], "odd", None, "Y", "Unknown", "Unknown", None)]
    df = spark.createDataFrame(rows, COLUMNS)
    assert {r.k: r.drought_risk for r in score.drought_risk(df, "k").collect()} == {1: 0, 2: 2 + 1 + 1 + 0 + 1 + 2 + 3 + 1 + 1}
    best = score.drought_risk(df, "k", combine="max_per_variable")
    assert {r.k: r.drought_risk for r in best.collect()} == {1: 0, 2: 2 + 1 + 1 + 1 + 1 + 2 + 3}
    again = score.drought_risk(df.repartition(3), "k")
    assert {r.k: r.drought_risk for r in again.collect()} == {1: 0, 2: 12}


def test_generic_rating_counts_from_one_except_seasons(spark):
    df = spark.createDataFrame([(1, "A", SENSITIVITY[2], "N", HABITAT[0], 5), (1, "B", None, None, None, None)],
                               "BLUE_LINE_KEY int, GNIS_NAME string, summer_sens string, fish string, habitat string, n int")
    rating = score.priority_rating(df, {"summer_sens": SENSITIVITY, "fish": FISH, "habitat": HABITAT, "n": "numeric"})
    assert {(r.GNIS_NAME, r.priority_rating) for r in rating.collect()} == {("A", 9), ("B", 9)}


def test_harmonize(spark):
    rows = [("s1", 1, "A", 3, None), ("s2", 1, "A", 5, 2), ("s1", None, "A", None, None)]
    df = spark.createDataFrame(rows, "s string, BLUE_LINE_KEY int, GNIS_NAME string, drought_risk int, number_distinct_SAR int")
    got = {(r.s, r.BLUE_LINE_KEY, r.drought_risk, r.number_distinct_SAR) for r in score.harmonize(df).collect()}
    assert got == {("s1", 1, 5, 2), ("s2", 1, 5, 2), ("s1", None, 0, 0)}


def test_species_lists_of_codes_are_split_after_counting(spark):
    df = spark.createDataFrame([("amphibians", "E1;E2")] * 3 + [("Lampreys", "E1")] * 2 + [("birds", "E1")], "TAX_CLASS string, ECOSECTION string")
    assert {r[0]: r[1] for r in species.species_by_section(df).collect()} == {"E1": 5, "E2": 3}


def test_natural_breaks_are_optimal(spark):
    values = np.random.default_rng(2).integers(0, 14, 400).tolist()
    got = scales.natural_breaks(spark.createDataFrame([(v,) for v in values], "v int"), "v", 3).orderBy("class").collect()

    def spread(groups):
        return sum(((np.array(g) - np.mean(g)) ** 2).sum() for g in groups if len(g))

    distinct = sorted(set(values))
    best = min(spread([[v for v in values if v < b], [v for v in values if b <= v < c], [v for v in values if v >= c]])
               for b, c in itertools.combinations(distinct[1:], 2))
    mine = spread([[v for v in values if r.low <= v <= r.high] for r in got])
    assert abs(mine - best) < 1e-6 and sum(r.n for r in got) == 400


def test_natural_breaks_of_many_values(spark):
    df = spark.range(20_000).select((F.col("id") / 7 + F.when(F.col("id") < 10_000, 0).otherwise(50_000)).alias("v"))
    got = scales.natural_breaks(df, "v", 2).orderBy("class").collect()
    assert [r.n for r in got] == [10_000, 10_000]


def test_histogram_and_rescale(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 5, 9, 10, None)], "v int")
    assert [r.n for r in scales.histogram(df, "v", 5).orderBy("bin").collect()] == [2, 0, 1, 0, 2]
    assert [r.scaled for r in scales.rescale(df, "v", reverse=True).collect()] == [1.0, 0.9, 0.5, 1 - 0.9, 0.0, None]


def test_pretty_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 19, 20, 55, 99)], "v double")
    got = [(r.bin, r.bin_low) for r in scales.pretty_bins(df, "v", 5).collect()]
    assert got == [(0, 0.0), (0, 0.0), (1, 20.0), (2, 40.0), (4, 80.0)]


def test_season_classes(spark):
    codes = [(a, b) for a in ("Y", "N", None) for b in ("Y", "N", None)]
    df = explorer.sens_combo(explorer.sens_labels(spark.createDataFrame(codes, "Summer_Sen string, Winter_Sen string")))
    labels = {"none": 0, "some": 1, "all": 2}

    def shown(season):
        return {r.sens_combo: r.leaf_col for r in explorer.season_class(df, season, labels).collect() if r.leaf_col is not None}

    assert shown("Summer and Winter") == {"NN": 0, "YN": 1, "NY": 1, "YY": 2}
    assert shown("Summer") == {"NN": 0, "NY": 0, "YN": 2, "YY": 2}
    assert shown("Winter") == {"NN": 0, "YN": 0, "NY": 2, "YY": 2}
    assert {r.Summer_Sen: r.sum_label for r in df.collect()} == {"Y": "Yes (<20% MAD)", "N": "No (>=20% MAD)", None: None}


def test_region_filter_and_highlight(spark):
    df = spark.createDataFrame([("Thompson-Okanagan Natural Resource Region",), ("Skeena Natural Resource Region",)], "REGION_NAME string")
    assert explorer.filter_region(df, "Thompson-Okanagan").count() == 1
    assert explorer.filter_region(df, explorer.WHOLE).count() == 2
    assert {r.leaf_colour for r in explorer.region_highlight(df, explorer.WHOLE).collect()} == {"black"}
    assert sorted(r.leaf_opac for r in explorer.region_highlight(df, "Skeena").collect()) == [0.5, 1.0]
    assert explorer.region_choices(df).first().choice == "Whole Province"


def test_data_dictionary(spark):
    rows = explorer.data_dictionary(spark).collect()
    assert len(rows) == 19 and rows[0].Variable == "STATION_NUMBER"


def test_natural_breaks_hold_every_value_beyond_the_bins(spark):
    values = [i * 0.37 + (i % 7) * 0.01 for i in range(5_000)]
    got = scales.natural_breaks(spark.createDataFrame([(v,) for v in values], "v double"), "v", 5).orderBy("class").collect()
    assert sum(r.n for r in got) == 5_000
    assert all(sum(r.low <= v <= r.high for r in got) == 1 for v in values)
    few = scales.natural_breaks(spark.createDataFrame([(v,) for v in values], "v double"), "v", 5, bins=50).collect()
    assert all(sum(r.low <= v <= r.high for r in few) == 1 for v in values)
