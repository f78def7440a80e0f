"""Lookup, reconciliation, scoring jobs and sources on small hand-written layers."""

import datetime
import os
import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from freshet.operators import geometry, spatial
from freshet.plans import explorer, lookup, reconcile, scoring, stations, variant
from freshet.sources import layers, sheets
from tests.test_geometry import layer
from tests.test_spatial import cross, inside, segment_distance2

HAND = "row_id long, BLUE_LINE_ string, StreamName string, Summer_Sen string, Winter_Sen string, Ecosection string, GNIS_NAME string, EcoProvinc string"


def hand_layer(spark, rows):
    return layer(spark, [(i, b, n, s, w, e, n, "P", g) for i, b, n, s, w, e, g in rows], HAND)


def catalogue(spark, rows):
    df = layer(spark, rows, "BLUE_LINE_KEY int, GNIS_NAME string")
    return geometry.dissolve(df, ["BLUE_LINE_KEY", "GNIS_NAME"])


def test_longer_gate_is_strict(spark):
    hand = hand_layer(spark, [(1, "1", "A", "Y", "N", "e", [[(0, 0), (10, 0)]]), (2, "2", "B", "Y", "N", "e", [[(0, 100), (10, 100)]])])
    lines = catalogue(spark, [(1, "A", [[(0, 0), (15, 0)]]), (2, "B", [[(0, 100), (16, 100)]])])
    assert [r.GNIS_NAME for r in reconcile.touching_longer(lines, hand).collect()] == ["B"]


def test_replacement_needs_one_row_or_equal_flags(spark):
    g = [[(0, 0), (1, 0)]]
    hand = hand_layer(spark, [
        (1, "1", "A", "Y", "N", "e1", g), (2, "1", "A", "Y", "N", "e2", g),
        (3, "2", "B", "Y", "N", "e1", g), (4, "2", "B", "N", "N", "e2", g),
        (5, "3", "C", None, None, "e1", g), (6, "3", "D", "Y", "Y", "e1", g)])
    updates = spark.createDataFrame([(1, "A", 1), (2, "B", 2), (3, "C", 3)], "BLUE_LINE_KEY int, GNIS_NAME string, ord int")
    got = {r.row_id: r.new_name for r in reconcile.replace_geometry(hand, updates).collect()}
    assert got == {1: "A", 2: "A", 3: None, 4: None, 5: "C", 6: None}


def test_last_update_of_a_key_wins(spark):
    hand = hand_layer(spark, [(1, "1", "1A", "Y", "N", "e", [[(0, 0), (1, 0)]])])
    updates = spark.createDataFrame([(1, "1A", 9), (11, "A", 2)], "BLUE_LINE_KEY int, GNIS_NAME string, ord int")
    assert reconcile.replace_geometry(hand, updates).first().new_key == 1


def test_reconcile_merges_sections_of_replaced_rows(spark):
    hand = hand_layer(spark, [
        (1, "7", "Fraser", "Y", "N", "North", [[(0, 0), (10, 0)]]),
        (2, "7", "Fraser", "Y", "N", "South", [[(10, 0), (20, 0)]]),
        (3, "8", "Other", "Y", "N", "North", [[(500, 0), (510, 0)]])])
    lines = catalogue(spark, [(7, "Fraser", [[(0, 0), (100, 0)]])])
    rows = {(r.StreamName, r.Ecosection, r.replaced, r.length_m) for r in reconcile.reconcile(hand, lines).collect()}
    assert rows == {("Fraser", "North, South", True, 100.0), ("Other", "North", False, 10.0)}


def test_override_unites_rows_of_a_key(spark):
    hand = hand_layer(spark, [
        (1, "9", "Cherry", "Y", "N", "a", [[(0, 0), (3, 4)]]), (2, "9", "Cherry", "Y", "N", "b", [[(3, 4), (3, 5)]]),
        (3, "0", "Z", "Y", "N", "c", [[(0, 0), (1, 0)]])])
    listed = spark.createDataFrame([("9", "a, b")], "BLUE_LINE_ string, Ecosection string")
    rows, united = reconcile.apply_overrides(hand, listed)
    assert {(r.StreamName, r.Ecosection) for r in rows.collect()} == {("Cherry", "a, b"), ("Z", "c")}
    assert rows.count() == 2
    assert geometry.dissolved_size(united, "BLUE_LINE_").first().length_m == 6.0


def test_reconcile_with_overrides(spark):
    hand = hand_layer(spark, [
        (1, "7", "Fraser", "Y", "N", "North", [[(0, 0), (10, 0)]]),
        (2, "9", "Cherry", "Y", "N", "a", [[(0, 50), (3, 54)]]), (3, "9", "Cherry", "Y", "N", "b", [[(3, 55), (3, 54)]]),
        (4, "9", "Cherry", "N", "N", "c", [[(3, 54), (3, 55)]]), (5, None, "Loose", "Y", "N", "d", [[(900, 0), (901, 0)]])])
    lines = catalogue(spark, [(7, "Fraser", [[(0, 0), (100, 0)]])])
    listed = spark.createDataFrame([("9", "a, b"), ("7", None), ("404", "x")], "BLUE_LINE_ string, Ecosection string")
    rows = [(r.StreamName, r.Ecosection, r.Summer_Sen, r.replaced, r.n_edges, r.length_m) for r in reconcile.reconcile(hand, lines, overrides=listed).collect()]
    assert sorted(rows) == [("Cherry", "a, b", "N", True, 2, 6.0), ("Cherry", "a, b", "Y", True, 2, 6.0),
                            ("Fraser", "North", "Y", True, 1, 100.0), ("Loose", "d", "Y", False, 1, 1.0)]


def test_lookup_takes_the_first_key_and_repeats_requests(spark):
    segs = layer(spark, [
        (1, 50, "A", [[(-90, 0), (-80, 0)]]), (2, 60, "A", [[(5, 5), (6, 5)]]), (3, 70, "A", [[(7, 7), (8, 7)]]),
        (4, 60, "A", [[(95, 5), (105, 5)]]), (5, None, "B", [[(1, 1), (2, 1)]]), (6, 80, "B", [[(3, 1), (4, 1)]])],
        "seg_id long, BLUE_LINE_KEY int, GNIS_NAME string")
    sections = spark.createDataFrame(
        [(1, "west", 0.0, 0.0, 100.0, 100.0), (2, "east", 100.0, 0.0, 200.0, 100.0)],
        "eco_id long, ECOSECTION_NAME string, xmin double, ymin double, xmax double, ymax double").withColumn("geom", geometry.line_geom(
            ("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"), ("xmin", "ymin")))
    asked = spark.createDataFrame([("A", "west"), ("A", "east"), ("B", "west"), ("C", "west")], "Stream string, Ecosection string")
    found = lookup.lookup_streams(asked, segs, sections, cell=50, repeats=True).collect()
    assert {(r.GNIS_NAME, r.BLUE_LINE_KEY, r.Ecosections, r.n_edges) for r in found} == {("A", 60, "west, east, west, east", 2)}
    assert len(found) == 2
    once = lookup.lookup_streams(asked, segs, sections, cell=50)
    assert {r.Ecosections for r in once.collect()} == {"west, east"}
    keys = lookup.requested_keys(asked, segs, sections, cell=50, match_section=True)
    assert {(r.Ecosection, r.BLUE_LINE_KEY) for r in keys.collect()} == {("west", 60), ("east", 60)}
    missing = lookup.unmatched_requests(asked, lookup.requested_keys(asked, segs, sections, cell=50))
    assert {r.Stream for r in missing.collect()} == {"B", "C"}


def test_repeated_lists_of_one_stream_are_written_by_several_tasks(spark, monkeypatch):
    segs = layer(spark, [(2, 60, "A", [[(5, 5), (6, 5)]])], "seg_id long, BLUE_LINE_KEY int, GNIS_NAME string")
    sections = spark.createDataFrame([(1, "west", 0.0, 0.0, 100.0, 100.0)], "eco_id long, ECOSECTION_NAME string, xmin double, ymin double, xmax double, ymax double")
    sections = sections.withColumn("geom", geometry.line_geom(("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"), ("xmin", "ymin")))
    asked = spark.createDataFrame([("A", "west")] * 23, "Stream string, Ecosection string")
    monkeypatch.setattr(lookup, "_dealt", partial(lookup._dealt, run=300, task=600))
    found = lookup.lookup_streams(asked, segs, sections, cell=50, repeats=True).withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r.request_no for r in found) == list(range(1, 24))
    assert {r.Ecosections for r in found} == {", ".join(["west"] * 23)}
    assert len({r.task for r in found}) > 1


def scoring_layers(spark):
    segs = layer(spark, [
        (1, 1, "A", "s1", "Not Sensitive", None, 3, None, [[(0, 0), (100, 0)]]),
        (2, 1, "A", "s2", "Very Sensitive--Chronic Problems", None, 3, "main", [[(100, 0), (200, 0)]]),
        (3, 1, "A", "s1", None, None, 1, "main", [[(0, 0), (0, 100)]]),
        (4, 2, "B", "s1", None, "Sensitive Proceed with caution", 4, "OP", [[(0, 0), (100, 0)]]),
        (5, None, "C", "s1", None, None, 4, "main", [[(0, 500), (100, 500)]]),
        (6, 3, "D", "s9", None, None, 4, "main", [[(0, 0), (100, 0)]])],
        "seg_id long, BLUE_LINE_KEY int, GNIS_NAME string, ECOSECTION_NAME string, summer_sens string, winter_sens string,"
        " STREAM_ORDER int, FEATURE_SOURCE string")
    sections = spark.createDataFrame([("s1",), ("s2",)], "ECOSECTION_NAME string")
    crossings = spark.createDataFrame(
        [(7, 10.0, 40.0, "Y", "High habitat value"), (5, 20.0, 50.0, "N", None), (9, 50.0, 51.0, "Y", None)],
        "assessment_id long, x double, y double, fish_observed string, habitat_value string")
    species = spark.createDataFrame(
        [(1, "S1", "e1", -5.0, -5.0, 5.0, 5.0), (2, "S1", "e1", 50.0, -5.0, 60.0, 5.0), (3, None, "e3", 50.0, -5.0, 60.0, 5.0)],
        "occ_id long, SCI_NAME string, ENG_NAME string, xmin double, ymin double, xmax double, ymax double").withColumn(
            "geom", geometry.line_geom(("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"), ("xmin", "ymin")))
    experts = layer(spark, [
        (1, "2", "N", "Y", [[(0, 0), (1, 1)]]), (2, "0", None, "Y", [[(50, -10), (50, 10)]]),
        (3, "0", "Y", None, [[(60, -10), (60, 10)]]), (4, "0", "N", "N", [[(70, -10), (70, 10)]])],
        "row_id long, BLUE_LINE_ string, Summer_Sen string, Winter_Sen string")
    return segs, sections, crossings, species, experts


def test_scored_streams(spark):
    scored = {(r.ECOSECTION_NAME, r.GNIS_NAME): r for r in scoring.score_streams(*scoring_layers(spark)).collect()}
    assert set(scored) == {("s1", "A"), ("s2", "A"), ("s1", "C")}
    a = scored[("s1", "A")]
    assert (a.summer_sens, a.fish_observed, a.habitat_value) == ("Very Sensitive--Chronic Problems", "N", "Unknown")
    assert (a.number_distinct_SAR, a.stream_summer_sens, a.stream_winter_sens, a.drought_risk) == (1, "Y", None, 2 + 0 + 1 + 1)
    c = scored[("s1", "C")]
    assert (c.number_distinct_SAR, c.fish_observed, c.drought_risk) == (None, "Unknown", 0)
    joined = scoring.harmonized_streams(scoring.score_streams(*scoring_layers(spark))).where("GNIS_NAME = 'A'")
    assert {r.drought_risk for r in joined.collect()} == {4}


def test_copies_of_a_segment_change_nothing(spark, monkeypatch):
    from freshet.operators import joins, spatial

    segs, *others = scoring_layers(spark)
    plain = scoring.score_streams(segs, *others).orderBy("ECOSECTION_NAME", "GNIS_NAME").collect()
    copies = segs.where("seg_id = 1").crossJoin(spark.range(400).select(F.col("id").alias("n")))
    many = segs.union(copies.withColumn("seg_id", F.col("n") + 100).drop("n")).repartition(6)
    monkeypatch.setattr(spatial, "MAX_PAIRS", 200)
    monkeypatch.setattr(spatial, "FEW", 0)
    monkeypatch.setattr(spatial, "LIGHT", 0)
    monkeypatch.setattr(joins, "HEAVY_ROWS", 10)
    seen = []
    monkeypatch.setattr(spatial, "dense_cells", lambda *a, _real=spatial.dense_cells, **k: seen.append(_real(*a, **k)) or seen[-1])
    assert scoring.score_streams(many, *others).orderBy("ECOSECTION_NAME", "GNIS_NAME").collect() == plain
    assert len(seen) == 1 and seen[0] is not None


def test_overlays_are_settled_in_blocks_of_any_size(spark, monkeypatch):
    segs, *others = scoring_layers(spark)
    scored = scoring.score_streams(segs, *others)
    want = scored.orderBy("ECOSECTION_NAME", "GNIS_NAME").collect()
    assert "MapInArrow" in plan(scored)
    monkeypatch.setattr(spatial, "LINE_BLOCK", 1)
    monkeypatch.setattr(spatial, "FEATURE_BLOCK", 1)
    assert scoring.score_streams(segs, *others).orderBy("ECOSECTION_NAME", "GNIS_NAME").collect() == want


def test_species_areas_with_holes_and_equal_segments(spark):
    def area(i, name, *rings):
        return (i, name, name, [[{"x": float(x), "y": float(y)} for x, y in (*r, r[0])] for r in rings])

    box = [(-10, -10), (300, -10), (300, 90), (-10, 90)]
    hole = [(-5, -5), (250, -5), (250, 50), (-5, 50)]
    concave = [(-10, -10), (300, -10), (300, -2), (10, -2), (10, 80), (-10, 80)]
    areas = spark.createDataFrame([
        area(1, "around", box), area(2, "around", box), area(3, "hole", box, hole), area(4, "concave", concave), area(5, None, box)],
        "occ_id long, SCI_NAME string, ENG_NAME string, geom array<array<struct<x:double,y:double>>>")
    segs, sections, crossings, _, experts = scoring_layers(spark)
    near = segs.where("seg_id = 1")
    for many in (near, near.union(near).union(near.withColumn("seg_id", F.lit(99).cast("long")))):
        one = scoring.score_streams(many, sections, crossings, areas, experts).first()
        assert one.number_distinct_SAR == 2  # inside the plain area and through the border of the concave one, not in the hole
        found = scoring.species_matches(many.select("seg_id", *scoring.STREAM, "geom"), areas)
        assert {(r.occ_id, r.SCI_NAME) for r in found.collect()} == {(1, "around"), (2, "around"), (4, "concave"), (5, None)}


def test_species_text_repeats_per_crossing(spark):
    segs, sections, crossings, species, _ = scoring_layers(spark)
    kept = segs.where("seg_id IN (1, 5)")
    texts = {r.GNIS_NAME: r.SCI_NAME for r in scoring.species_lists(kept, crossings, species, repeats=True).collect()}
    assert texts == {"A": "S1, S1, NA, S1, S1, NA", "C": "NA"}
    once = scoring.species_lists(kept, crossings, species)
    assert {r.GNIS_NAME: r.SCI_NAME for r in once.collect()} == {"A": "S1, S1, NA", "C": "NA"}


def species_of_streams(spark):
    """Two streams, one in several rows, and areas that lie on the first of them."""
    line = lambda x: [[{"x": float(x), "y": 0.0}, {"x": float(x + 10), "y": 5.0}]]
    segments = spark.createDataFrame(
        [("E", 1, "A", line(0)), ("E", 1, "A", line(300)), ("E", None, None, line(0)), ("E", 2, "far", line(90_000)), ("E", 3, "wide", [line(0)[0] + line(70_000)[0]])],
        "ECOSECTION_NAME string, BLUE_LINE_KEY int, GNIS_NAME string, geom array<array<struct<x:double,y:double>>>")
    ring = lambda x: [[{"x": x + u, "y": v} for u, v in ((-5.0, -5.0), (50.0, -5.0), (50.0, 50.0), (-5.0, 50.0), (-5.0, -5.0))]]
    areas = [(i, f"S{i}" if i % 3 else None, f"e{i}", ring(0.0 if i % 2 else 300.0)) for i in (5, 3, 11, 2, 4)]
    return segments, spark.createDataFrame(areas, "occ_id long, SCI_NAME string, ENG_NAME string, geom array<array<struct<x:double,y:double>>>")


@pytest.mark.parametrize("block, rows", [(256, 256), (1, 256), (2, 1)])
def test_species_texts_are_put_together_in_blocks(spark, monkeypatch, block, rows):
    monkeypatch.setattr(spatial, "POLYGON_BLOCK", block)
    monkeypatch.setattr(spatial, "LINE_ROWS", rows)
    segments, areas = species_of_streams(spark)
    crossings = spark.createDataFrame([(1, 5.0, 0.0), (2, 6.0, 0.0)], "assessment_id int, x double, y double")
    texts = {r.GNIS_NAME: (r.SCI_NAME, r.ENG_NAME) for r in scoring.species_lists(segments, crossings, areas).collect()}
    odd = ("NA, S5, S11", "e3, e5, e11")
    both = ("S2, NA, S4, S5, S11", "e2, e3, e4, e5, e11")
    assert texts == {"A": both, None: odd, "far": ("NA", "NA"), "wide": both}
    monkeypatch.setattr(scoring, "TASK_BYTES", 1)
    repeated = scoring.species_lists(segments, crossings, areas, repeats=True)
    assert {r.GNIS_NAME: r.SCI_NAME for r in repeated.collect()} == {
        "A": ", ".join([both[0]] * 2), None: ", ".join([odd[0]] * 2), "far": "NA", "wide": ", ".join([both[0]] * 2)}


def test_texts_shuffle_no_pairs(spark):
    segments, areas = species_of_streams(spark)
    crossings = spark.createDataFrame([(1, 5.0, 0.0)], "assessment_id int, x double, y double")
    narrow = segments.where("BLUE_LINE_KEY IS NULL OR BLUE_LINE_KEY < 3")
    text = scoring.species_lists(narrow, crossings, areas)._jdf.queryExecution().executedPlan().toString()
    assert "listagg" in text and "MapInArrow" in text and "rangepartitioning" not in text


def test_search_of_a_closed_line_finds_nothing(spark):
    hand = layer(spark, [(1, "Ring", [[(0, 0), (1, 0), (1, 1), (0, 0)]]), (2, "Line", [[(3, 4), (5, 6)]])], "row_id int, StreamName string")
    assert explorer.locate_stream(hand, "Ring").count() == 0
    assert tuple(explorer.locate_stream(hand, "Line").first()) == (3.0, 4.0)


def test_sheet_to_station_table(spark, folder):
    path = os.path.join(folder, "sheet.csv")
    cells = [",".join(f"h{i}" for i in range(1, 25)), ",".join(["note"] + [""] * 23),
             "Stream,WSC," + ",".join(["Eco Province", "Eco Section", "Eco Section Code", "Eco Region Code", "Order", "Years Record"])
             + ",DA km2,MAD L/s," + ",".join(f"x{i}" for i in range(11, 25))]
    cells += ["S1,w,p,s,c,r,1,10,5.126,n/a" + ",1" * 14, "S1,w,p,s,c,r,1,99,9,9" + ",2" * 14, "S9,w,p,s,c,r,1,1,1,1" + ",3" * 14]
    with open(path, "w") as out:
        out.write("\n".join(cells) + "\n")
    sheet = stations.sheet_table(sheets.read_sheet(spark, path, 24))
    assert len(sheet.columns) == 23 and {"STATION_NAME", "max_summer", "min_winter", "da_km_2", "mad_l_s"} <= set(sheet.columns)
    registry = spark.createDataFrame(
        [("08A", "S1", "BC", "PST", 49.5, -120.0), ("08B", "S2", "BC", "PST", 50.0, -121.0)],
        "STATION_NUMBER string, STATION_NAME string, PROV_TERR_STATE_LOC string, TIMEZONE string, LATITUDE double, LONGITUDE double")
    row = stations.station_table(stations.station_points(registry), sheet).collect()
    assert len(row) == 1
    assert (row[0].STATION_NUMBER, row[0].x, row[0].years_record, row[0].da_km_2, row[0].mad_l_s) == ("08A", -120.0, 10.0, 5.13, None)
    assert "wsc" not in row[0].asDict() and "TIMEZONE" not in row[0].asDict()


def test_exports(spark, folder):
    day = datetime.date(2024, 4, 8)
    assert layers.export_name("Stream", date=day) == "Stream_Drought_Sensitivity_2024-04-08"
    assert layers.export_name("WSC", "Skeena", day) == "WSC_Drought_Sensitivity_Skeena_2024-04-08"
    df = layer(spark, [(i, [[(0, 0), (1, 1)]]) for i in range(50)])
    path = layers.export_csv(df.repartition(7), folder, "Stream", order=["id"])
    rows = layers.read_csv(spark, path, "row_number long, id int").collect()
    assert sorted((r.row_number, r.id) for r in rows) == [(i + 1, i) for i in range(50)]


def test_stage_is_built_once(spark, folder):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = folder + "/stage"
    for _ in range(2):
        assert layers.stage(spark, path, build).count() == 3
    layers.stage(spark, path, build, overwrite=True)
    assert len(calls) == 2


def test_sections_are_written_and_read_together(spark, folder):
    df = spark.createDataFrame([("Alsek Ranges", 1), ("Cariboo Basin", 2)], "ECOSECTION_NAME string, v int")
    layers.write_by_section(df, folder + "/s")
    assert set(os.listdir(folder + "/s")) >= {"ecosection_slug=alsek_ranges", "ecosection_slug=cariboo_basin"}
    one = layers.read_layers(spark, folder + "/s").where(F.col("ecosection_slug") == "cariboo_basin")
    assert [r.v for r in one.collect()] == [2]
    assert "PartitionFilters: [isnotnull" in one._jdf.queryExecution().executedPlan().toString()


def test_name_filter_reaches_the_scan(spark, folder):
    path = layers.write_layer(spark.createDataFrame([("A", 1, 2), ("B", 2, 3)], "GNIS_NAME string, k int, z int"), folder + "/l")
    df = layers.read_layer(spark, path).where("GNIS_NAME = 'A'").select("k")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(GNIS_NAME,A)" in text and "z" not in text.split("ReadSchema:")[1].split(">")[0]


def test_regions_are_polygons_not_boxes(spark):
    ring = [(0, 0), (100, 0), (100, 50), (50, 50), (50, 100), (0, 100), (0, 0)]
    regions = layer(spark, [(1, "North Natural Resource Region", [ring])], "region_id long, REGION_NAME string")
    hand = hand_layer(spark, [
        (1, "1", "notch", "Y", "N", "e", [[(70, 70), (90, 90)]]), (2, "2", "inside", "Y", "N", "e", [[(10, 10), (20, 10)]]),
        (3, "3", "across", "Y", "N", "e", [[(70, 70), (40, 70)]]), (4, "4", "touching", "Y", "N", "e", [[(100, 20), (120, 20)]])])
    labels = {"none": "a", "some": "b", "all": "c"}
    shown = explorer.explorer_streams(hand, regions, "Summer", "North", labels, cell=30)
    assert {r.StreamName for r in shown.collect()} == {"inside", "across", "touching"}
    points = spark.createDataFrame(
        [("notch", 70.0, 70.0), ("inside", 20.0, 70.0), ("border", 0.0, 30.0), ("corner", 50.0, 50.0), ("right", 100.0, 10.0)],
        "STATION_NUMBER string, x double, y double")
    found = explorer.explorer_stations(points, regions, "North", cell=30)
    assert {r.STATION_NUMBER for r in found.collect()} == {"inside", "border", "corner", "right"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_species_are_counted_as_bit_sets(spark):
    segs, sections, crossings, _, experts = scoring_layers(spark)
    box = "array(array(" + ", ".join(f"struct({x}D AS x, {y}D AS y)" for x, y in ((-5, -5), (5, -5), (5, 5), (-5, 5), (-5, -5))) + "))"
    around = "array(array(" + ", ".join(f"struct({x}D AS x, {y}D AS y)" for x, y in ((-50, -50), (500, -50), (500, 90), (-50, 90), (-50, -50))) + "))"
    species = spark.range(150).selectExpr(
        "id AS occ_id", "concat('S', id % 130) AS SCI_NAME", "'e' AS ENG_NAME", f"CASE WHEN id % 130 < 70 THEN {box} ELSE {around} END AS geom")
    near = segs.where("seg_id IN (1, 2)")
    overlays = scoring.stream_overlays(near, crossings, species, experts, dense=None)
    assert {r.ECOSECTION_NAME: r.species for r in overlays.collect()} == {"s1": 130, "s2": 60}
    counts = scoring.species_richness(near, species, dense=None)
    assert {r.ECOSECTION_NAME: r.number_distinct_SAR for r in counts.collect()} == {"s1": 130, "s2": 60}
    assert "SortAggregate" not in plan(counts)  # matches are never sorted: they are united in a hash table before the shuffle


def test_best_crossing_is_taken_without_a_sort_of_the_matches(spark):
    segs, _, crossings, _, _ = scoring_layers(spark)
    scores = crossings.withColumn("final_score", F.when(F.col("assessment_id") == 7, 4).when(F.col("assessment_id") == 5, 4))
    best = variant.best_crossings(segs.where("seg_id IN (1, 5)"), scores)
    assert {(r.BLUE_LINE_KEY, r.assessment_id, r.final_score, r.habitat_value) for r in best.collect()} == {(1, 5, 4, "Unknown"), (None, 0, 0, "Unknown")}
    assert "WindowGroupLimit" not in plan(best)


@pytest.mark.parametrize("dense", [False, True])
def test_lines_of_many_edges_meet_all_overlays_in_one_join(spark, monkeypatch, dense):
    pick = random.Random(11)
    if dense:  # every cell is cut, and what is left is salted
        for name in ("FEW", "LIGHT", "MAX_PAIRS"):
            monkeypatch.setattr(spatial, name, 0)
        monkeypatch.setattr(spatial, "MAX_LEVEL", 1)
    ways = []
    for _ in range(40):
        x, y = pick.randint(-300, 300), pick.randint(-300, 300)
        way = [(x, y)]
        for _ in range(pick.randint(1, 11)):
            x, y = x + pick.randint(-70, 70), y + pick.randint(-70, 70)
            way.append((x, y))
        ways.append(way)
    segs = layer(spark, [("s", i, "n", [w]) for i, w in enumerate(ways)], "ECOSECTION_NAME string, BLUE_LINE_KEY int, GNIS_NAME string")
    spots = [(i, pick.randint(-300, 300), pick.randint(-300, 300)) for i in range(60)]
    crossings = spark.createDataFrame([(i, float(x), float(y), "Y", None) for i, x, y in spots],
                                      "assessment_id long, x double, y double, fish_observed string, habitat_value string")
    hand = [(i, "0", "Y", None, [[(x, y), (x + 80, y + 30)]]) for i, x, y in ((i, pick.randint(-300, 300), pick.randint(-300, 300)) for i in range(8))]
    experts = layer(spark, hand, "row_id long, BLUE_LINE_ string, Summer_Sen string, Winter_Sen string")
    rings = [[(x, y), (x + 300, y), (x + 250, y + 260), (x + 120, y + 90), (x, y + 200), (x, y)] for x, y in ((-320, -200), (-100, -100), (20, -300))]
    rings = [[shell, [(x + 40, y + 40), (x + 110, y + 40), (x + 70, y + 70), (x + 40, y + 40)]] for shell in rings for x, y in shell[:1]]
    species = layer(spark, [(i, f"S{i}", r) for i, r in enumerate(rings)], "occ_id long, SCI_NAME string")
    want = {}
    for k, way in enumerate(ways):
        steps = list(zip(way, way[1:], strict=False))
        near = [i for i, x, y in spots if any(segment_distance2(a, b, (x, y)) <= 2500 for a, b in steps)]
        lines = [i for i, *_, ((p, q),) in hand if any(cross(a, b, p, q) for a, b in steps)]
        areas = [r for r in rings if inside(way[0], r) or any(cross(a, b, p, q) for a, b in steps for ring in r for p, q in zip(ring, ring[1:], strict=False))]
        if near or lines or areas:
            want[k] = (min(near, default=None), len(areas), min(lines, default=None))
    for cell in (500,) if dense else (40, 500):
        overlays = scoring.stream_overlays(segs, crossings, species, experts, cell=cell)
        got = {r.BLUE_LINE_KEY: (r.crossing and r.crossing.fid, r.species, r.expert and r.expert.fid) for r in overlays.collect()}
        assert got == want
    if not dense:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        overlays = scoring.stream_overlays(segs, crossings, species, experts, dense=None)
        assert len(overlays.collect()) == len(want)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        done = plan(overlays).split("== Initial Plan ==")[0].splitlines()
        by_cell = [line for line in done if "Exchange hashpartitioning(__cx" in line and "ReusedExchange" not in line]
        assert len(by_cell) == 2  # lines and features are shuffled once each, starts not at all


def test_reconcile_meets_lines_once(spark, monkeypatch):
    hand = spark.createDataFrame([], ", ".join(f"{c} string" for c in reconcile.ALL_SEVEN)
                                 + ", row_id long, geom array<array<struct<x:double,y:double>>>")
    lines = spark.createDataFrame([], "BLUE_LINE_KEY long, GNIS_NAME string, ax double, ay double, bx double, by double")
    written, real = [], reconcile.materialise
    monkeypatch.setattr(reconcile, "materialise", lambda df, label: written.append(label) or real(df, label))
    listed = spark.createDataFrame([], "BLUE_LINE_ string, Ecosection string")
    assert reconcile.reconcile(hand, lines, overrides=listed).count() == 0
    assert written[:3] == ["updates", "replaced_rows", "hand_rows"]
