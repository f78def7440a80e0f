"""Stream, polygon, crossing, species, expert and station layers derived from the test tables.

Each definition is plain SQL that Spark and DuckDB both run; lines are kept as integer-metre vertices.
"""

from pyspark.sql import functions as F

from freshet.operators.geometry import line_geom

_CELL_X = "({k}*7919%20011)%142*7000"
_CELL_Y = "CAST(floor(({k}*7919%20011)/142) AS BIGINT)*7000"


def _xy(key):
    return {"X": _CELL_X.format(k=key), "Y": _CELL_Y.format(k=key)}


_LEVELS = "WHEN 0 THEN 'Not Sensitive' WHEN 1 THEN 'Sensitive Proceed with caution' WHEN 2 THEN 'Very Sensitive--Chronic Problems'"

SEGMENTS = """
SELECT ((l_orderkey*8+l_linenumber)*20000+l_partkey)*1000+l_suppkey AS seg_id,
 CASE WHEN l_orderkey%97=0 THEN NULL ELSE CAST(l_partkey AS INT) END AS BLUE_LINE_KEY,
 CASE WHEN l_linenumber=7 AND l_partkey%2=0 THEN 'Unknown'
      WHEN l_linenumber=6 AND l_partkey%3=0 THEN NULL
      WHEN l_suppkey%50=0 THEN concat('CREEK_',CAST(l_partkey%500 AS STRING),' NORTH')
      ELSE concat('CREEK_',CAST(l_partkey%500 AS STRING)) END AS GNIS_NAME,
 concat('Ecosection ',CAST((l_partkey+l_suppkey%2)%25 AS STRING)) AS ECOSECTION_NAME,
 CASE (l_partkey+l_suppkey)%4 {LEVELS} ELSE NULL END AS summer_sens,
 CASE (l_partkey+l_linenumber)%4 {LEVELS} ELSE NULL END AS winter_sens,
 1+CAST(l_quantity AS INT)%6 AS STREAM_ORDER,
 CASE l_suppkey%10 WHEN 0 THEN 'lake-def skelet' WHEN 1 THEN 'OP' WHEN 2 THEN NULL ELSE 'main' END AS FEATURE_SOURCE,
 {X}+l_linenumber*400 AS x0, {Y}+(l_suppkey%5)*40 AS y0,
 {X}+l_linenumber*400+200 AS x1, {Y}+(l_suppkey%5)*40+l_suppkey%90 AS y1,
 {X}+l_linenumber*400+400 AS x2, {Y}+(l_suppkey%5)*40+40 AS y2
FROM {{lineitem}}""".format(LEVELS=_LEVELS, **_xy("l_partkey"))

ECOSECTIONS = """
SELECT n_nationkey AS eco_id, concat('Ecosection ',CAST(n_nationkey AS STRING)) AS ECOSECTION_NAME,
 concat('E',CAST(n_nationkey AS STRING)) AS ECOSECTION_CODE,
 CASE n_nationkey%3 WHEN 0 THEN 'Not Sensitive' WHEN 1 THEN 'Sensitive Proceed with caution'
      ELSE 'Very Sensitive--Chronic Problems' END AS summer_sens,
 CASE n_nationkey%4 {LEVELS} ELSE NULL END AS winter_sens,
 (n_nationkey%5)*196750 AS xmin, CAST(floor(n_nationkey/5) AS INT)*196750 AS ymin,
 (n_nationkey%5)*196750+196750 AS xmax, CAST(floor(n_nationkey/5) AS INT)*196750+196750 AS ymax
FROM {{nation}}""".format(LEVELS=_LEVELS)

REGIONS = """
SELECT r_regionkey AS region_id, concat(r_name,' Natural Resource Region') AS REGION_NAME,
 r_regionkey*196750 AS xmin, 0 AS ymin, r_regionkey*196750+196750 AS xmax, 983750 AS ymax
FROM {region}"""

CROSSINGS = """
SELECT o_orderkey AS assessment_id, o_orderdate AS assessment_date,
 {X}+(o_orderkey%9)*400+o_orderkey%41-20 AS x, {Y}+o_orderkey%241-20 AS y,
 CASE o_orderkey%3 WHEN 0 THEN 'N' WHEN 1 THEN 'Y' ELSE NULL END AS fish_observed,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'High habitat value' WHEN '2-HIGH' THEN 'Medium habitat value'
      WHEN '3-MEDIUM' THEN 'Low habitat value' ELSE NULL END AS habitat_value,
 CASE o_orderstatus WHEN 'F' THEN 'Barrier' WHEN 'O' THEN 'Passable' ELSE 'Potential' END AS barrier,
 CASE WHEN o_orderkey%11=0 THEN NULL ELSE CAST(o_orderkey%40 AS INT) END AS final_score
FROM {{orders}}""".format(**_xy("o_custkey"))

SPECIES = """
SELECT c_custkey AS occ_id,
 CASE WHEN c_custkey%23=0 THEN NULL ELSE concat('Species ',CAST(c_custkey%60 AS STRING)) END AS SCI_NAME,
 concat('english ',CAST(c_custkey%60 AS STRING)) AS ENG_NAME,
 CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'amphibians' WHEN 'BUILDING' THEN 'ray-finned fishes'
      WHEN 'FURNITURE' THEN 'bivalves' WHEN 'HOUSEHOLD' THEN 'Lampreys' ELSE 'birds' END AS TAX_CLASS,
 CASE WHEN c_custkey%5=0 THEN concat('E',CAST(c_nationkey AS STRING),';E',CAST((c_nationkey+1)%25 AS STRING))
      ELSE concat('E',CAST(c_nationkey AS STRING)) END AS ECOSECTION,
 {X}-300 AS xmin, {Y}-300 AS ymin, {X}+900+c_custkey%7*300 AS xmax, {Y}+900 AS ymax
FROM {{customer}}""".format(**_xy("c_custkey"))

EXPERT_STREAMS = """
SELECT p_partkey AS row_id,
 CASE WHEN p_partkey%3=0 THEN '0' ELSE CAST(p_partkey-p_partkey%2 AS STRING) END AS BLUE_LINE_,
 concat('CREEK_',CAST(p_partkey%500 AS STRING)) AS StreamName,
 concat('CREEK_',CAST(p_partkey%500 AS STRING)) AS GNIS_NAME,
 concat('Province ',CAST(p_partkey%9 AS STRING)) AS EcoProvinc,
 concat('Ecosection ',CAST(p_size%25 AS STRING)) AS Ecosection,
 CASE p_partkey%4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'Y' ELSE NULL END AS Summer_Sen,
 CASE p_size%3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE NULL END AS Winter_Sen,
 {X}+500 AS x0, {Y} AS y0, {X}+500+(p_size%6)*500 AS x1, {Y}+200 AS y1
FROM {{part}}""".format(**_xy("p_partkey"))

HYDROMASTER = """
SELECT s_suppkey AS row_id, concat('STATION ',CAST(s_suppkey-s_suppkey%2 AS STRING)) AS stream,
 CASE WHEN s_suppkey%13=0 THEN 'n/a' ELSE CAST(s_acctbal AS STRING) END AS mad_l_s_text, s_acctbal AS mad_l_s
FROM {supplier}"""

STATIONS = """
SELECT concat('08',CAST(s_suppkey AS STRING)) AS STATION_NUMBER,
 concat('STATION ',CAST(s_suppkey AS STRING)) AS STATION_NAME, 'BC' AS PROV_TERR_STATE_LOC,
 {X} AS x, {Y} AS y
FROM {{supplier}}""".format(**_xy("s_suppkey"))

# Streams of eight members: five that follow each other, a tributary, a line across them and a closed line; vertex i of n.
RIVERS = """
SELECT *, CASE WHEN j<=5 THEN 2+(k*k*7)%38+CASE WHEN k%64=3 THEN 300 ELSE 0 END
               WHEN j=6 THEN CASE WHEN g%3=0 THEN 3 ELSE 2 END
               WHEN g%3=0 THEN 5 ELSE 2*(3+k%20)+1 END AS n,
 concat('RIVER_',CAST(g AS STRING)) AS name, concat('Ecosection ',CAST(g%25 AS STRING)) AS ECOSECTION_NAME, {X} AS ox, {Y} AS oy
FROM (SELECT CAST(p_partkey AS BIGINT) AS k, CAST(floor(p_partkey/8) AS BIGINT) AS g, p_partkey%8 AS j FROM {{part}}) t""".format(**_xy("g"))

# Tiles of a grid, 25 in a row and some of them missing; vertex i of 48, twelve on each side, is moved off a side but at corners.
TILES = """
SELECT p_partkey AS tile_id, concat('Zone ',CAST(p_partkey%9 AS STRING)) AS zone, CAST((p_partkey-1)%25 AS BIGINT)*12 AS gx,
 CAST(floor((p_partkey-1)/25) AS BIGINT)*12 AS gy
FROM {part} WHERE p_partkey%11<>5"""

_SIDE = "CASE WHEN i%48<12 THEN 0 WHEN i%48<24 THEN 1 WHEN i%48<36 THEN 2 ELSE 3 END"
_TILE_X = f"(gx+CASE {_SIDE} WHEN 0 THEN i%12 WHEN 1 THEN 12 WHEN 2 THEN 12-i%12 ELSE 0 END)"
_TILE_Y = f"(gy+CASE {_SIDE} WHEN 0 THEN 0 WHEN 1 THEN i%12 WHEN 2 THEN 12 ELSE 12-i%12 END)"
TILE_X = f"{_TILE_X}*100+CASE WHEN i%12<>0 AND {_SIDE} IN (1,3) THEN ({_TILE_X}*5+{_TILE_Y}*{_TILE_Y}*7)%60 ELSE 0 END"
TILE_Y = f"{_TILE_Y}*100+CASE WHEN i%12<>0 AND {_SIDE} IN (0,2) THEN ({_TILE_X}*{_TILE_X}*7+{_TILE_Y}*13)%60 ELSE 0 END"

_BACK = "CASE WHEN i=n-1 THEN 0 WHEN i<floor(n/2) THEN i ELSE n-2-i END"
RIVER_X = f"""CASE WHEN j<=4 THEN ox+j*1000+CAST(floor(i*1000/(n-1)) AS BIGINT)
 WHEN j=5 THEN ox+2000+(i*7*k)%50
 WHEN j=6 AND g%3=0 THEN ox+CASE WHEN i=0 THEN 0 ELSE 2000 END
 WHEN j=6 THEN ox+300+i*400
 WHEN g%3=0 THEN ox+CASE WHEN i IN (1,2) THEN 1500 ELSE 500 END
 ELSE ox+5200+({_BACK})*30 END"""
RIVER_Y = f"""CASE WHEN j<=4 THEN oy+CASE WHEN i=0 OR i=n-1 THEN 0 ELSE (i*i*13+k*29)%200 END
 WHEN j=5 THEN oy-20*i
 WHEN j=6 AND g%3=0 THEN oy-1000+CASE WHEN i=2 THEN 400 ELSE 0 END
 WHEN j=6 THEN oy-500+i*1200
 WHEN g%3=0 THEN oy-1000-CASE WHEN i IN (2,3) THEN 200 ELSE 0 END
 ELSE oy-500+CASE WHEN i<floor(n/2) OR i=n-1 THEN 0 ELSE 100 END+(({_BACK})*({_BACK})*3)%20 END"""

# Attributes of rivers as hand-digitized lines: members of a stream agree but for the winter flag of the last two.
HAND_RIVER = {
    "BLUE_LINE_": "CAST(g AS STRING)", "GNIS_NAME": "name", "StreamName": "name", "EcoProvinc": "concat('Province ',CAST(g%9 AS STRING))",
    "Ecosection": "ECOSECTION_NAME", "Summer_Sen": "CASE g%3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE NULL END",
    "Winter_Sen": "CASE WHEN j>5 THEN 'N' ELSE 'Y' END",
}

VIEWS = {
    "fx_rivers": (RIVERS, "part"),
    "fx_tiles": (TILES, "part"),
    "fx_segments": (SEGMENTS, "lineitem"),
    "fx_ecosections": (ECOSECTIONS, "nation"),
    "fx_regions": (REGIONS, "region"),
    "fx_pscis": (CROSSINGS, "orders"),
    "fx_sar": (SPECIES, "customer"),
    "fx_expert_streams": (EXPERT_STREAMS, "part"),
    "fx_hydromaster": (HYDROMASTER, "supplier"),
    "fx_stations": (STATIONS, "supplier"),
}


SPREAD = {"lineitem", "orders", "customer", "part"}
_known = {}


def view_sql(name):
    """The definition over the raw table name, for engines that have the tables as views."""
    sql, table = VIEWS[name]
    return sql.format(**{table: table}).strip()


def read_table(spark, sf_dir, table):
    """Scan a table; a scan with fewer splits than the cluster has cores is spread over all of them.

    Schema and split count of a file are looked up once.
    """
    path = f"{sf_dir}/{table}.parquet"
    cores = spark.sparkContext.defaultParallelism
    if path not in _known:
        df = spark.read.parquet(path)
        few = table in SPREAD and df.rdd.getNumPartitions() < cores
        _known[path] = df.schema, few
    schema, few = _known[path]
    df = spark.read.schema(schema).parquet(path)
    return df.repartition(cores, df.columns[0]) if few else df


def load(spark, sf_dir, name):
    """A derived layer with its integer vertices or box as plain columns."""
    sql, table = VIEWS[name]
    return spark.sql(sql, **{table: read_table(spark, sf_dir, table)})


def segments(spark, sf_dir):
    """Stream segments: three-vertex lines."""
    df = load(spark, sf_dir, "fx_segments")
    geom = line_geom(("x0", "y0"), ("x1", "y1"), ("x2", "y2"))
    return df.withColumn("geom", geom).drop("x0", "y0", "x1", "y1", "x2", "y2")


def expert_streams(spark, sf_dir):
    """Hand-digitized lines: two vertices each."""
    df = load(spark, sf_dir, "fx_expert_streams")
    return df.withColumn("geom", line_geom(("x0", "y0"), ("x1", "y1"))).drop("x0", "y0", "x1", "y1")


def rivers(spark, sf_dir, hand=False):
    """Lines of 2 to several hundred vertices that meet in nodes, cross, overlap and close to rings; with `hand` they have the
    attributes of hand-digitized lines."""
    df = load(spark, sf_dir, "fx_rivers")
    attributes = [F.expr(sql).alias(c) for c, sql in HAND_RIVER.items() if hand]
    vertex = f"named_struct('x', CAST({RIVER_X} AS DOUBLE), 'y', CAST({RIVER_Y} AS DOUBLE))"
    return df.withColumn("geom", F.expr(f"array(transform(sequence(0, n - 1), i -> {vertex}))")).select(
        F.col("k").alias("river_id"), *(attributes or ["name", "ECOSECTION_NAME"]), "geom")


def tiles(spark, sf_dir):
    """Polygons of 48 winding edges that have their sides in common; where a tile is missing, the layer has a lake."""
    vertex = f"named_struct('x', CAST({TILE_X} AS DOUBLE), 'y', CAST({TILE_Y} AS DOUBLE))"
    return load(spark, sf_dir, "fx_tiles").withColumn("geom", F.expr(f"array(transform(sequence(0, 48), i -> {vertex}))")).drop("gx", "gy")


def _boxes(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ("xmin", "ymin", "xmax", "ymax")})


def _polygons(df):
    """Boxes without their upper right quarter, each as one closed ring; the box columns stay."""
    df = _boxes(df).withColumns({"xmid": (F.col("xmin") + F.col("xmax")) / 2, "ymid": (F.col("ymin") + F.col("ymax")) / 2})
    ring = line_geom(("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymid"), ("xmid", "ymid"), ("xmid", "ymax"), ("xmin", "ymax"), ("xmin", "ymin"))
    return df.withColumn("geom", ring).drop("xmid", "ymid")


def regions(spark, sf_dir):
    """Concave polygons; their boxes have common sides."""
    return _polygons(load(spark, sf_dir, "fx_regions"))


def ecosections(spark, sf_dir):
    """Concave polygons; their boxes have common sides."""
    return _polygons(load(spark, sf_dir, "fx_ecosections"))


def species(spark, sf_dir):
    """Concave areas with a hole in their lower half."""
    df = _polygons(load(spark, sf_dir, "fx_sar"))
    x, y = F.col("xmin"), F.col("ymin")
    hole = F.array(*[F.struct((x + dx).alias("x"), (y + dy).alias("y")) for dx, dy in ((100, 100), (1100, 100), (1100, 500), (100, 500), (100, 100))])
    return df.withColumn("geom", F.concat("geom", F.array(hole)))


def _points(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ("x", "y")})


def crossings(spark, sf_dir):
    return _points(load(spark, sf_dir, "fx_pscis"))


def stations(spark, sf_dir):
    return _points(load(spark, sf_dir, "fx_stations"))


def hydromaster(spark, sf_dir):
    return load(spark, sf_dir, "fx_hydromaster")
