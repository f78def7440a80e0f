"""DuckDB SQL for the registered queries, over the raw tables.

The statements follow the definitions step by step (windows, full match tables) and share no plan with the
Spark side. Line x feature joins carry a cell prefilter; matches are made distinct afterwards.
"""

from freshet.sources.fixtures import HAND_RIVER, RIVER_X, RIVER_Y, TILE_X, TILE_Y, VIEWS, view_sql

REGION = "ASIA"

# --- building blocks --------------------------------------------------------------------------------------


def _cells(source, xmin, ymin, xmax, ymax, size, reach=0):
    def span(lo, hi):
        return (f"unnest(range(CAST(floor(({lo}-{reach})/{size}.0) AS BIGINT),"
                f" CAST(floor(({hi}+{reach})/{size}.0) AS BIGINT)+1))")

    return f"SELECT *, {span(ymin, ymax)} AS cy FROM (SELECT *, {span(xmin, xmax)} AS cx FROM {source})"


def _edge_cells(source, size):
    return _cells(source, "least(ax,bx)", "least(ay,by_)", "greatest(ax,bx)", "greatest(ay,by_)", size)


def _cr(a, b, c):
    return (f"(({b[0]}-{a[0]})*({c[1]}-{a[1]})-({b[1]}-{a[1]})*({c[0]}-{a[0]}))")


_A, _B = ("e.ax", "e.ay"), ("e.bx", "e.by_")


def _near(radius):
    def d2(u, v):
        return f"(({u[0]}-{v[0]})*({u[0]}-{v[0]})+({u[1]}-{v[1]})*({u[1]}-{v[1]}))"

    p, r2 = ("p.x", "p.y"), radius * radius
    dot = "((p.x-e.ax)*(e.bx-e.ax)+(p.y-e.ay)*(e.by_-e.ay))"
    cr = _cr(_A, _B, p)
    return (f"CASE WHEN {dot}<=0 THEN {d2(p, _A)}<={r2} WHEN {dot}>={d2(_A, _B)} THEN {d2(p, _B)}<={r2}"
            f" ELSE {cr}*{cr}<={r2}*{d2(_A, _B)} END")


def _in_box():
    corners = [_cr(_A, _B, c) for c in (("p.xmin", "p.ymin"), ("p.xmin", "p.ymax"), ("p.xmax", "p.ymin"), ("p.xmax", "p.ymax"))]
    inside = ("least(e.ax,e.bx)<=p.xmax AND greatest(e.ax,e.bx)>=p.xmin AND"
              " least(e.ay,e.by_)<=p.ymax AND greatest(e.ay,e.by_)>=p.ymin")
    return f"{inside} AND least({','.join(corners)})<=0 AND greatest({','.join(corners)})>=0"


def _on_edge():
    p, q = ("p.ax", "p.ay"), ("p.bx", "p.by_")
    boxes = ("least(e.ax,e.bx)<=greatest(p.ax,p.bx) AND greatest(e.ax,e.bx)>=least(p.ax,p.bx) AND"
             " least(e.ay,e.by_)<=greatest(p.ay,p.by_) AND greatest(e.ay,e.by_)>=least(p.ay,p.by_)")
    return (f"{boxes} AND sign({_cr(_A, _B, p)})*sign({_cr(_A, _B, q)})<=0"
            f" AND sign({_cr(p, q, _A)})*sign({_cr(p, q, _B)})<=0")


def _pairs(columns, edges, features, feature_cells, test, size):
    return (f"SELECT DISTINCT {columns} FROM ({_edge_cells(edges, size)}) e JOIN ({feature_cells}) p"
            f" ON e.cx=p.cx AND e.cy=p.cy AND {test}")


def _box_pairs(columns, edges, boxes, size):
    return _pairs(columns, edges, boxes, _cells(boxes, "xmin", "ymin", "xmax", "ymax", size), _in_box(), size)


def _point_pairs(columns, edges, radius, points="fx_pscis"):
    return _pairs(columns, edges, points, _cells(points, "x", "y", "x", "y", 1000, radius), _near(radius), 1000)


def _edge_pairs(columns, edges, others, extra="TRUE"):
    return _pairs(columns, edges, others, _edge_cells(others, 1000), f"{_on_edge()} AND {extra}", 1000)


def _code(col, base=0):
    return (f"CASE {col} WHEN 'Not Sensitive' THEN {base} WHEN 'Sensitive Proceed with caution' THEN {base + 1}"
            f" WHEN 'Very Sensitive--Chronic Problems' THEN {base + 2} END")


def _level(code):
    return (f"CASE {code} WHEN 0 THEN 'Not Sensitive' WHEN 1 THEN 'Sensitive Proceed with caution'"
            " WHEN 2 THEN 'Very Sensitive--Chronic Problems' END")


def _same(a, b, cols):
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


_K3 = ["ECOSECTION_NAME", "BLUE_LINE_KEY", "GNIS_NAME"]
_K5 = _K3 + ["summer_sens", "winter_sens"]
_SEVEN = ["BLUE_LINE_", "GNIS_NAME", "StreamName", "EcoProvinc", "Ecosection", "Summer_Sen", "Winter_Sen"]
_k3, _k5, _seven = ", ".join(_K3), ", ".join(_K5), ", ".join(_SEVEN)
_LEN = "sqrt((bx-ax)*(bx-ax)+(by_-ay)*(by_-ay))"


def _dissolved(name, source, keys):
    """Distinct edges of a key in one direction, edges without length left out; `source` has ax, ay, bx, by_."""
    return {f"{name}_edges": f"""SELECT DISTINCT {keys}, CASE WHEN (ax,ay)<(bx,by_) THEN ax ELSE bx END AS ax, CASE WHEN (ax,ay)<(bx,by_) THEN ay ELSE by_ END AS ay,
        CASE WHEN (ax,ay)<(bx,by_) THEN bx ELSE ax END AS bx, CASE WHEN (ax,ay)<(bx,by_) THEN by_ ELSE ay END AS by_
        FROM {source} WHERE ax<>bx OR ay<>by_"""}


def _walks(name, key):
    """Parts of the dissolved edges of a key, by walking: from each node to the next one, and around each ring from its
    smallest vertex. `path` lists the vertices of a part."""
    def steps(extra):
        return f"""SELECT w.key, w.sx, w.sy, w.tx, w.ty, w.hx AS px, w.hy AS py, d.vx AS hx, d.vy AS hy, list_append(w.path, [d.vx, d.vy]) AS path
            FROM {{walk}} w JOIN {name}_degrees g ON g.key=w.key AND g.x=w.hx AND g.y=w.hy AND g.n=2
            JOIN {name}_darts d ON d.key=w.key AND d.ux=w.hx AND d.uy=w.hy AND (d.vx<>w.px OR d.vy<>w.py) {extra}"""

    def first(degree):
        return f"""SELECT d.key, ux AS sx, uy AS sy, vx AS tx, vy AS ty, ux AS px, uy AS py, vx AS hx, vy AS hy, [[ux, uy], [vx, vy]] AS path
            FROM {name}_darts d JOIN {name}_degrees g ON g.key=d.key AND g.x=d.ux AND g.y=d.uy AND g.n{degree}"""

    open_steps = steps("").format(walk=f"{name}_open")
    ring_steps = steps("WHERE (w.hx,w.hy)>(w.sx,w.sy)").format(walk=f"{name}_rings")
    return {
        f"{name}_darts": f"SELECT {key} AS key, ax AS ux, ay AS uy, bx AS vx, by_ AS vy FROM {name}_edges"
                         f" UNION ALL SELECT {key}, bx, by_, ax, ay FROM {name}_edges",
        f"{name}_degrees": f"SELECT key, ux AS x, uy AS y, count(*) AS n FROM {name}_darts GROUP BY ALL",
        f"{name}_open": f"{first('<>2')} UNION ALL {open_steps}",
        f"{name}_rings": f"{first('=2')} WHERE (vx,vy)>(ux,uy) UNION ALL {ring_steps}",
        f"{name}_parts": f"""SELECT w.key, path, len(path)-1 AS n_edges, {_path_length('path')} AS length_m FROM {name}_open w
            JOIN {name}_degrees g ON g.key=w.key AND g.x=w.hx AND g.y=w.hy AND g.n<>2 WHERE [sx,sy,tx,ty]<[hx,hy,px,py]
            UNION ALL SELECT key, path, len(path)-1, {_path_length('path')} FROM {name}_rings WHERE hx=sx AND hy=sy AND (tx,ty)<(px,py)""",
    }


def _path_length(path):
    return (f"list_sum(list_transform(range(1, len({path})), lambda i: sqrt(({path}[i+1][1]-{path}[i][1])*({path}[i+1][1]-{path}[i][1])"
            f"+({path}[i+1][2]-{path}[i][2])*({path}[i+1][2]-{path}[i][2]))))")


def _areas(name, source, key):
    """Effective areas of the inner vertices of lines (`source` has the key, `rank` and `path`), one vertex dropped per step."""
    triangle = "abs((rest[p][1]-rest[p-1][1])*(rest[p+1][2]-rest[p-1][2])-(rest[p][2]-rest[p-1][2])*(rest[p+1][1]-rest[p-1][1]))/2"
    return {
        f"{name}_steps": f"""SELECT {key}, path AS rest, NULL::BIGINT AS gone, 0.0::DOUBLE AS area FROM (SELECT {key},
            list_transform(range(1, len(path)+1), lambda i: [path[i][1]::DOUBLE, path[i][2]::DOUBLE, i-1]) AS path FROM {source}) UNION ALL
            SELECT {key}, list_concat(rest[1:pos-1], rest[pos+1:len(rest)]) AS rest, CAST(rest[pos][3] AS BIGINT) AS gone, greatest(area, low) AS area FROM (
            SELECT {key}, rest, area, list_min(t) AS low, list_position(t, list_min(t))+1 AS pos FROM (
            SELECT {key}, rest, area, list_transform(range(2, len(rest)), lambda p: {triangle}) AS t FROM {name}_steps WHERE len(rest)>2))""",
        f"{name}_areas": f"SELECT {key}, gone AS i, area FROM {name}_steps WHERE gone IS NOT NULL",
    }


def _kept_vertices(areas, key, share, per="1"):
    """Vertices with the largest areas: about `share` of all, or of those of each group `per`; ties at the bound stay."""
    return f"""SELECT {key}, i FROM (SELECT *, min(CASE WHEN r<=round_even({share}::DOUBLE*n,0) THEN area END) OVER (PARTITION BY {per}) AS bound FROM (
        SELECT *, row_number() OVER (PARTITION BY {per} ORDER BY area DESC) AS r, count(*) OVER (PARTITION BY {per}) AS n FROM {areas})) WHERE area>=bound"""


def _thinned(source, key, kept):
    """Lines of `source` with their ends and the `kept` inner vertices."""
    return f"""SELECT {key}, list_filter(path, lambda v, i: i=1 OR i=len(path) OR list_contains(coalesce(kept, []), i-1)) AS path FROM {source}
        LEFT JOIN (SELECT {key}, list(i) AS kept FROM ({kept}) GROUP BY {key}) USING ({key})"""


def _coverage(name, source, key, share):
    """Arcs of the polygons in `source` (key, ax, ay, bx, by_), thinned, once for each polygon that has their first edge; rings
    without nodes that are left with two edges are gone."""
    return {
        **_dissolved(f"{name}_all", f"(SELECT *, 1 AS one FROM {source})", "one"), **_walks(f"{name}_all", "one"),
        f"{name}_arcs": f"SELECT path[1:2] AS part, path FROM {name}_all_parts", **_areas(f"{name}_arc", f"{name}_arcs", "part"),
        f"{name}_thin": _thinned(f"{name}_arcs", "part", _kept_vertices(f"{name}_arc_areas", "part", share)),
        f"{name}_owned": f"""SELECT e.{key}, path, path[1]=path[len(path)] AS closed FROM {name}_thin JOIN (SELECT {key}, ax, ay, bx, by_ FROM {source}
            UNION ALL SELECT {key}, bx, by_, ax, ay FROM {source}) e ON part[1][1]=e.ax AND part[1][2]=e.ay AND part[2][1]=e.bx AND part[2][2]=e.by_
            WHERE path[1]<>path[len(path)] OR len(path)>3""",
    }


_RING_SUMS = """CAST(sum(len(path)-1) AS INT) AS n_vertices, CAST(sum(list_sum(list_transform(path, lambda v: v[1]*62+v[2]*34))
    -(path[1][1]+path[len(path)][1])*31-(path[1][2]+path[len(path)][2])*17)/2 AS BIGINT) AS vertex_sum"""


def _pack(cols):
    return "struct_pack(" + ", ".join(f"{c} := {c}" for c in cols) + ")"


_SUM = "CAST(list_sum(list_transform(path, lambda v: v[1]*31+v[2]*17)) AS BIGINT) AS vertex_sum"
_PART = ", ".join(f"CAST(part[{i}][{j}] AS BIGINT) AS {c}" for c, i, j in (("x", 1, 1), ("y", 1, 2), ("next_x", 2, 1), ("next_y", 2, 2)))
_TOLERANCE = 40
_GAP = ("sqrt(({p}[1]-({a}[1]+t*({b}[1]-{a}[1])))*({p}[1]-({a}[1]+t*({b}[1]-{a}[1])))+({p}[2]-({a}[2]+t*({b}[2]-{a}[2])))*({p}[2]-({a}[2]+t*({b}[2]-{a}[2]))))")
_EXPERT_LEVELS = """CASE WHEN {c} IS NULL THEN NULL WHEN {c}='Y' THEN 1 ELSE 0 END"""

CTES = {
    "river_points": f"SELECT k AS river_id, name, ECOSECTION_NAME, i, {RIVER_X} AS x, {RIVER_Y} AS y FROM (SELECT *, unnest(range(0, n)) AS i FROM fx_rivers)",
    "river_edges": """SELECT * FROM (SELECT river_id, name, ECOSECTION_NAME, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_
        FROM river_points WINDOW w AS (PARTITION BY river_id ORDER BY i)) WHERE bx IS NOT NULL""",
    **_dissolved("named", "river_edges", "name"), **_walks("named", "name"),
    "met_edges": """SELECT e.*, f.ax AS px, f.ay AS py, f.bx AS qx, f.by_ AS qy, (e.ax,e.ay,e.bx,e.by_)<(f.ax,f.ay,f.bx,f.by_) AS first
        FROM named_edges e JOIN named_edges f ON e.name=f.name AND (e.ax<>f.ax OR e.ay<>f.ay OR e.bx<>f.bx OR e.by_<>f.by_)
        AND e.ax<=f.bx AND f.ax<=e.bx AND least(e.ay,e.by_)<=greatest(f.ay,f.by_) AND least(f.ay,f.by_)<=greatest(e.ay,e.by_)""",
    "cut_edges": "SELECT DISTINCT name, ax, ay, bx, by_, cx, cy FROM ("
                 + " UNION ALL ".join(f"""SELECT name, ax, ay, bx, by_, CAST({v}x AS DOUBLE) AS cx, CAST({v}y AS DOUBLE) AS cy FROM met_edges
        WHERE (bx-ax)*({v}y-ay)-(by_-ay)*({v}x-ax)=0 AND {v}x BETWEEN least(ax,bx) AND greatest(ax,bx) AND {v}y BETWEEN least(ay,by_) AND greatest(ay,by_)
        AND NOT ({v}x=ax AND {v}y=ay) AND NOT ({v}x=bx AND {v}y=by_)""" for v in "pq")
                 + """ UNION ALL SELECT name, ax, ay, bx, by_, floor((x0+s*dx)*1048576+0.5)/1048576, floor((y0+s*dy)*1048576+0.5)/1048576 FROM (
        SELECT *, CAST((x2-x0)*ey-(y2-y0)*ex AS DOUBLE)/CAST(dx*ey-dy*ex AS DOUBLE) AS s FROM (
        SELECT *, x1-x0 AS dx, y1-y0 AS dy, x3-x2 AS ex, y3-y2 AS ey FROM (SELECT name, ax, ay, bx, by_,
          CASE WHEN first THEN ax ELSE px END AS x0, CASE WHEN first THEN ay ELSE py END AS y0, CASE WHEN first THEN bx ELSE qx END AS x1,
          CASE WHEN first THEN by_ ELSE qy END AS y1, CASE WHEN first THEN px ELSE ax END AS x2, CASE WHEN first THEN py ELSE ay END AS y2,
          CASE WHEN first THEN qx ELSE bx END AS x3, CASE WHEN first THEN qy ELSE by_ END AS y3 FROM met_edges
          WHERE sign((bx-ax)*(py-ay)-(by_-ay)*(px-ax))*sign((bx-ax)*(qy-ay)-(by_-ay)*(qx-ax))<0
            AND sign((qx-px)*(ay-py)-(qy-py)*(ax-px))*sign((qx-px)*(by_-py)-(qy-py)*(bx-px))<0))))""",
    "cut_pieces": """SELECT name, cx AS ax, cy AS ay, dx AS bx, dy AS by_ FROM (SELECT *, lead(cx) OVER w AS dx, lead(cy) OVER w AS dy FROM (
        SELECT * FROM cut_edges UNION ALL SELECT name, ax, ay, bx, by_, ax, ay FROM named_edges UNION ALL SELECT name, ax, ay, bx, by_, bx, by_ FROM named_edges)
        WINDOW w AS (PARTITION BY name, ax, ay, bx, by_ ORDER BY (cx-ax)*(bx-ax)+(cy-ay)*(by_-ay))) WHERE dx IS NOT NULL""",
    **_dissolved("noded", "cut_pieces", "name"), **_walks("noded", "name"),
    **_dissolved("half", "(SELECT *, 1 AS one FROM river_edges WHERE river_id%2=0)", "one"),
    "river_lines": "SELECT river_id, list([x, y] ORDER BY i) AS path FROM river_points GROUP BY river_id",
    **_areas("river", "river_lines", "river_id"),
    "section_areas": "SELECT a.*, ECOSECTION_NAME FROM river_areas a JOIN (SELECT DISTINCT river_id, ECOSECTION_NAME FROM river_points) USING (river_id)",
    "split_steps": f"""SELECT river_id, path, 1 AS a, len(path) AS b, true AS more FROM river_lines UNION ALL
        SELECT river_id, path, unnest([a, m]) AS a, unnest([m, b]) AS b, true AS more FROM (SELECT *, a+list_position(gaps, list_max(gaps)) AS m FROM (
        SELECT river_id, path, a, b, list_transform(range(a+1, b), lambda i: list_transform([CASE WHEN l2>0 THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE,
          ((path[i][1]-path[a][1])*(path[b][1]-path[a][1])+(path[i][2]-path[a][2])*(path[b][2]-path[a][2]))/l2)) ELSE 0.0::DOUBLE END],
          lambda t: {_GAP.format(p='path[i]', a='path[a]', b='path[b]')})[1]) AS gaps FROM (SELECT river_id, path, a, b,
          CAST((path[b][1]-path[a][1])*(path[b][1]-path[a][1])+(path[b][2]-path[a][2])*(path[b][2]-path[a][2]) AS DOUBLE) AS l2
          FROM split_steps WHERE b-a>1)) WHERE list_max(gaps)>{_TOLERANCE})""",
    "tile_points": f"SELECT tile_id, i, {TILE_X} AS x, {TILE_Y} AS y FROM (SELECT *, unnest(range(0, 49)) AS i FROM fx_tiles)",
    "tile_edges": """SELECT * FROM (SELECT tile_id, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_
        FROM tile_points WINDOW w AS (PARTITION BY tile_id ORDER BY i)) WHERE bx IS NOT NULL""",
    **_coverage("tile", "tile_edges", "tile_id", 0.1),
    "aquatic": "SELECT * FROM fx_sar WHERE TAX_CLASS IN ('amphibians','ray-finned fishes','bivalves','Lampreys')",
    "area_points": """SELECT occ_id, unnest([0,0,0,0,0,0,0,1,1,1,1,1]) AS r, unnest(range(0, 12)) AS i,
        unnest([xmin,xmax,xmax,(xmin+xmax)/2,(xmin+xmax)/2,xmin,xmin,xmin+100,xmin+1100,xmin+1100,xmin+100,xmin+100]) AS x,
        unnest([ymin,ymin,(ymin+ymax)/2,(ymin+ymax)/2,ymax,ymax,ymin,ymin+100,ymin+100,ymin+500,ymin+500,ymin+100]) AS y FROM aquatic""",
    "area_edges": """SELECT * FROM (SELECT occ_id, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_
        FROM area_points WINDOW w AS (PARTITION BY occ_id, r ORDER BY i)) WHERE bx IS NOT NULL""",
    **_coverage("area", "area_edges", "occ_id", 0.05),
    "tidy_rows": f"""SELECT k.ECOSECTION_NAME, k.BLUE_LINE_KEY, CASE WHEN c.hit THEN c.corrector ELSE k.GNIS_NAME END AS GNIS_NAME, x0, y0, x1, y1, x2, y2
        FROM kept k LEFT JOIN (SELECT ECOSECTION_NAME, BLUE_LINE_KEY, TRUE AS hit, string_agg(CASE WHEN GNIS_NAME<>'Unknown' THEN GNIS_NAME END, ', '
        ORDER BY n DESC, GNIS_NAME NULLS LAST) AS corrector FROM (SELECT {_k3}, count(*) AS n FROM kept WHERE BLUE_LINE_KEY IS NOT NULL GROUP BY ALL)
        GROUP BY ECOSECTION_NAME, BLUE_LINE_KEY HAVING count(*)>1) c ON k.ECOSECTION_NAME=c.ECOSECTION_NAME AND k.BLUE_LINE_KEY=c.BLUE_LINE_KEY
        WHERE k.ECOSECTION_NAME IN (SELECT ECOSECTION_NAME FROM sar_sections)""",
    "tidy_pairs": f"SELECT {_k3}, x0 AS ax, y0 AS ay, x1 AS bx, y1 AS by_ FROM tidy_rows UNION ALL SELECT {_k3}, x1, y1, x2, y2 FROM tidy_rows",
    **_dissolved("tidy", "tidy_pairs", _k3), **_walks("tidy", _pack(_K3)),
    "tidy_lines": "SELECT key, path[1:2] AS part, path FROM tidy_parts", **_areas("tidy", "tidy_lines", "key, part"),
    "hand_river_edges": f"""SELECT {_seven}, ax, ay, bx, by_ FROM river_edges JOIN hand_river_names USING (river_id)""",
    "hand_river_names": f"SELECT k AS river_id, {', '.join(f'{sql} AS {c}' for c, sql in HAND_RIVER.items())} FROM fx_rivers",
    **_dissolved("drawn", "hand_river_edges", _seven), **_walks("drawn", _pack(_SEVEN)),
    "drawn_lines": "SELECT key, path[1:2] AS part, path FROM drawn_parts", **_areas("drawn", "drawn_lines", "key, part"),
    **_dissolved("stream", "kept_edges", _k3), **_walks("stream", _pack(_K3)),
    "stream_lines": "SELECT key, path[1:2] AS part, path FROM stream_parts", **_areas("stream", "stream_lines", "key, part"),
    "thin_lines": _thinned("stream_lines", "key, part", _kept_vertices("stream_areas", "key, part", 0.025, "key.ECOSECTION_NAME")),
    **_areas("thin", "thin_lines", "key, part"),
    "fx_edges": "SELECT seg_id, BLUE_LINE_KEY, GNIS_NAME, x0 AS ax, y0 AS ay, x1 AS bx, y1 AS by_ FROM fx_segments"
                " UNION ALL SELECT seg_id, BLUE_LINE_KEY, GNIS_NAME, x1, y1, x2, y2 FROM fx_segments",
    "hand_edges": "SELECT row_id, BLUE_LINE_, StreamName, Summer_Sen, Winter_Sen, x0 AS ax, y0 AS ay, x1 AS bx, y1 AS by_"
                  " FROM fx_expert_streams",
    "unkeyed_edges": "SELECT * FROM hand_edges WHERE BLUE_LINE_='0'",
    "levelled": f"""SELECT * REPLACE ({_level(f"max({_code('summer_sens')}) OVER (PARTITION BY BLUE_LINE_KEY)")} AS summer_sens,
        {_level(f"max({_code('winter_sens')}) OVER (PARTITION BY BLUE_LINE_KEY)")} AS winter_sens) FROM fx_segments""",
    "kept": """SELECT * FROM levelled WHERE ECOSECTION_NAME IN (SELECT ECOSECTION_NAME FROM fx_ecosections)
        AND STREAM_ORDER>2 AND (FEATURE_SOURCE IS NULL OR FEATURE_SOURCE NOT IN ('lake-def skelet','OP'))""",
    "kept_edges": f"SELECT {_k5}, x0 AS ax, y0 AS ay, x1 AS bx, y1 AS by_ FROM kept"
                  f" UNION ALL SELECT {_k5}, x1, y1, x2, y2 FROM kept",
    "streams": f"SELECT DISTINCT {_k5} FROM kept",
    "near": _point_pairs(", ".join(f"e.{c}" for c in _K5) + ", p.assessment_id, p.fish_observed, p.habitat_value,"
                         " p.final_score, p.assessment_date, p.barrier", "kept_edges", 50),
    "crossed": f"SELECT s.*, coalesce(n.assessment_id,0) AS assessment_id, coalesce(n.fish_observed,'Unknown') AS fish_observed,"
               f" coalesce(n.habitat_value,'Unknown') AS habitat_value, coalesce(n.final_score,0) AS final_score,"
               f" coalesce(n.barrier,'Unknown') AS barrier, n.assessment_date FROM streams s LEFT JOIN near n ON {_same('s', 'n', _K5)}",
    "species_hits": _box_pairs(", ".join(f"e.{c}" for c in _K5) + ", p.occ_id, p.SCI_NAME, p.ENG_NAME", "kept_edges", "species_parts", 1000),
    "matched": f"SELECT c.*, h.occ_id, h.SCI_NAME, h.ENG_NAME FROM crossed c LEFT JOIN species_hits h ON {_same('c', 'h', _K5)}",
    "richness": f"SELECT {_k5}, count(DISTINCT SCI_NAME) AS number_distinct_SAR FROM matched WHERE SCI_NAME IS NOT NULL GROUP BY {_k5}",
    "one_row": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_k5} ORDER BY assessment_id) AS rn FROM crossed) WHERE rn=1",
    "keyed": """SELECT * FROM (SELECT CAST(BLUE_LINE_ AS INT) AS BLUE_LINE_KEY, Summer_Sen, Winter_Sen,
        row_number() OVER (PARTITION BY BLUE_LINE_ ORDER BY row_id) AS rn FROM fx_expert_streams WHERE BLUE_LINE_<>'0') WHERE rn=1""",
    "placed_hits": _edge_pairs(", ".join(f"e.{c}" for c in _K5) + ", p.row_id, p.Summer_Sen, p.Winter_Sen", "kept_edges", "unkeyed_edges"),
    "placed": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ECOSECTION_NAME, BLUE_LINE_KEY
        ORDER BY GNIS_NAME NULLS LAST, row_id) AS rn FROM placed_hits WHERE Summer_Sen IS NOT NULL AND BLUE_LINE_KEY IS NOT NULL) WHERE rn=1""",
    "parts": f"""SELECT o.*, r.number_distinct_SAR, coalesce(k.Summer_Sen,g.Summer_Sen) AS stream_summer_sens,
        coalesce(k.Winter_Sen,g.Winter_Sen) AS stream_winter_sens
        FROM one_row o LEFT JOIN richness r ON {_same('o', 'r', _K5)}
        LEFT JOIN keyed k ON o.BLUE_LINE_KEY=k.BLUE_LINE_KEY
        LEFT JOIN placed g ON o.ECOSECTION_NAME=g.ECOSECTION_NAME AND o.BLUE_LINE_KEY=g.BLUE_LINE_KEY""",
    "long_parts": "SELECT ECOSECTION_NAME, BLUE_LINE_KEY, GNIS_NAME, unnest(['a','b','c','d','e','f','g']) AS variable, unnest(["
                  f"{_code('summer_sens')}, {_code('winter_sens')}, {_EXPERT_LEVELS.format(c='stream_summer_sens')},"
                  f" {_EXPERT_LEVELS.format(c='stream_winter_sens')}, CASE fish_observed WHEN 'N' THEN 0 WHEN 'Y' THEN 1 END,"
                  " CASE habitat_value WHEN 'Low habitat value' THEN 0 WHEN 'Medium habitat value' THEN 1 WHEN 'High habitat value' THEN 2 END,"
                  " number_distinct_SAR]) AS value FROM parts",
    "risk": f"SELECT {_k3}, CAST(coalesce(sum(value),0) AS BIGINT) AS drought_risk FROM long_parts GROUP BY {_k3}",
    "scored": f"SELECT p.*, r.drought_risk FROM parts p LEFT JOIN risk r ON {_same('p', 'r', _K3)}",
    "harmonized": """SELECT * REPLACE (max(coalesce(drought_risk,0)) OVER (PARTITION BY GNIS_NAME, BLUE_LINE_KEY) AS drought_risk,
        max(coalesce(number_distinct_SAR,0)) OVER (PARTITION BY GNIS_NAME, BLUE_LINE_KEY) AS number_distinct_SAR) FROM scored""",
    "texts": f"""SELECT {_k5}, string_agg(coalesce(SCI_NAME,'NA'), ', ' ORDER BY assessment_id, occ_id) AS SCI_NAME,
        string_agg(coalesce(ENG_NAME,'NA'), ', ' ORDER BY assessment_id, occ_id) AS ENG_NAME FROM matched GROUP BY {_k5}""",
    "names": "SELECT BLUE_LINE_KEY, GNIS_NAME, count(*) AS n FROM fx_segments GROUP BY ALL",
    "several": "SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY BLUE_LINE_KEY) AS nn FROM names) WHERE nn>1",
    "correctors": """SELECT BLUE_LINE_KEY, string_agg(CASE WHEN GNIS_NAME<>'Unknown' THEN GNIS_NAME END, ', '
        ORDER BY n DESC, GNIS_NAME NULLS LAST) AS corrector FROM several WHERE BLUE_LINE_KEY IS NOT NULL GROUP BY BLUE_LINE_KEY""",
    "sar_codes": """SELECT ECOSECTION_CODE, CAST(sum(n) AS BIGINT) AS number_sar FROM (
        SELECT unnest(string_split(ECOSECTION, ';')) AS ECOSECTION_CODE, n FROM (SELECT ECOSECTION, count(*) AS n FROM fx_sar
        WHERE TAX_CLASS IN ('amphibians','ray-finned fishes','bivalves','Lampreys') GROUP BY ECOSECTION)) GROUP BY ECOSECTION_CODE""",
    "sar_sections": """SELECT e.*, c.number_sar FROM fx_ecosections e LEFT JOIN sar_codes c USING (ECOSECTION_CODE)
        WHERE winter_sens IS NOT NULL""",
    "best": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ECOSECTION_NAME, BLUE_LINE_KEY
        ORDER BY final_score DESC, assessment_id) AS rn FROM (
        SELECT DISTINCT s.ECOSECTION_NAME, s.BLUE_LINE_KEY, coalesce(n.assessment_id,0) AS assessment_id,
        coalesce(n.fish_observed,'Unknown') AS fish_observed, coalesce(n.habitat_value,'Unknown') AS habitat_value,
        coalesce(n.final_score,0) AS final_score, coalesce(n.barrier,'Unknown') AS barrier, n.assessment_date
        FROM kept s LEFT JOIN near n ON {_same('s', 'n', ['ECOSECTION_NAME', 'BLUE_LINE_KEY'])})) WHERE rn=1""",
    "found_keys": "SELECT GNIS_NAME, BLUE_LINE_KEY FROM (SELECT h.*, row_number() OVER (PARTITION BY GNIS_NAME ORDER BY seg_id) AS rn"
                  " FROM (" + _box_pairs("e.seg_id, e.BLUE_LINE_KEY, e.GNIS_NAME",
                                         "(SELECT * FROM fx_edges WHERE GNIS_NAME IN (SELECT StreamName FROM fx_expert_streams))",
                                         "section_parts", 50000) + ") h) WHERE rn=1 AND BLUE_LINE_KEY IS NOT NULL",
    "found_edges": "SELECT DISTINCT e.BLUE_LINE_KEY, e.GNIS_NAME, ax, ay, bx, by_ FROM fx_edges e JOIN found_keys f"
                   " ON e.BLUE_LINE_KEY=f.BLUE_LINE_KEY AND e.GNIS_NAME=f.GNIS_NAME",
    "found_sizes": f"SELECT BLUE_LINE_KEY, GNIS_NAME, count(*) AS n_edges, sum({_LEN}) AS length_m FROM found_edges GROUP BY ALL",
    "longer": "SELECT DISTINCT z.BLUE_LINE_KEY, z.GNIS_NAME FROM (" + _edge_pairs(
        "e.BLUE_LINE_KEY, e.GNIS_NAME, p.row_id", "found_edges", "hand_edges", "e.GNIS_NAME=p.StreamName") + f""") h
        JOIN found_sizes z USING (BLUE_LINE_KEY, GNIS_NAME) JOIN (SELECT row_id, {_LEN} AS hand_m FROM hand_edges) m USING (row_id)
        WHERE z.length_m > 1.5*hand_m""",
    "hand_keys": """SELECT BLUE_LINE_||StreamName AS uniqID FROM fx_expert_streams GROUP BY 1 HAVING count(*)=1
        OR (count(DISTINCT coalesce(Summer_Sen,'NA'))=1 AND count(DISTINCT coalesce(Winter_Sen,'NA'))=1)""",
    "hand_after": f"""SELECT h.*, l.BLUE_LINE_KEY IS NOT NULL AS replaced, coalesce(z.n_edges,1) AS n_edges,
        coalesce(z.length_m, (SELECT {_LEN} FROM hand_edges x WHERE x.row_id=h.row_id)) AS length_m,
        CASE WHEN l.BLUE_LINE_KEY IS NULL THEN concat_ws(':',x0,y0,x1,y1) ELSE concat_ws('/',l.BLUE_LINE_KEY,l.GNIS_NAME) END AS gid
        FROM fx_expert_streams h
        LEFT JOIN (SELECT * FROM longer WHERE CAST(BLUE_LINE_KEY AS VARCHAR)||GNIS_NAME IN (SELECT uniqID FROM hand_keys)) l
        ON h.BLUE_LINE_||h.StreamName = CAST(l.BLUE_LINE_KEY AS VARCHAR)||l.GNIS_NAME
        LEFT JOIN found_sizes z ON l.BLUE_LINE_KEY=z.BLUE_LINE_KEY AND l.GNIS_NAME=z.GNIS_NAME""",
    "reconciled": f"""SELECT DISTINCT {', '.join('h.' + c for c in _SEVEN if c != 'Ecosection')}, coalesce(t.l, h.Ecosection) AS Ecosection,
        h.replaced, h.n_edges, CAST(round(h.length_m*1000) AS BIGINT) AS length_mm, h.gid FROM hand_after h LEFT JOIN (
        SELECT BLUE_LINE_, string_agg(Ecosection, ', ' ORDER BY row_id) AS l FROM hand_after
        WHERE BLUE_LINE_ IN (SELECT BLUE_LINE_ FROM dup_keys) GROUP BY BLUE_LINE_) t ON h.BLUE_LINE_=t.BLUE_LINE_""",
    "overridden": "SELECT DISTINCT BLUE_LINE_ FROM fx_expert_streams WHERE row_id%50=2",
    "geometry_edges": """SELECT concat_ws(':',x0,y0,x1,y1) AS gid, x0 AS ax, y0 AS ay, x1 AS bx, y1 AS by_ FROM fx_expert_streams
        UNION ALL SELECT concat_ws('/',BLUE_LINE_KEY,GNIS_NAME), ax, ay, bx, by_ FROM found_edges""",
    **_dissolved("united", "(SELECT r.BLUE_LINE_, g.ax, g.ay, g.bx, g.by_ FROM reconciled r JOIN overridden USING (BLUE_LINE_) JOIN geometry_edges g USING (gid))", "BLUE_LINE_"),
    "dup_keys": """SELECT DISTINCT BLUE_LINE_ FROM (SELECT BLUE_LINE_, row_number() OVER (PARTITION BY gid ORDER BY row_id) AS a,
        row_number() OVER (PARTITION BY Summer_Sen ORDER BY row_id) AS b, row_number() OVER (PARTITION BY Winter_Sen ORDER BY row_id) AS c,
        row_number() OVER (PARTITION BY BLUE_LINE_ ORDER BY row_id) AS d FROM hand_after) WHERE a>1 AND b>1 AND c>1 AND d>1 AND BLUE_LINE_<>'0'""",
    "shown": """SELECT *, CASE WHEN Summer_Sen='Y' THEN 'Yes (<20% MAD)' WHEN Summer_Sen IS NOT NULL THEN 'No (>=20% MAD)' END AS sum_label,
        CASE WHEN Winter_Sen='Y' THEN 'Yes (<20% MAD)' WHEN Winter_Sen IS NOT NULL THEN 'No (>=20% MAD)' END AS wint_label,
        coalesce(Summer_Sen,'NA')||coalesce(Winter_Sen,'NA') AS sens_combo FROM fx_expert_streams""",
    "rated": f"""SELECT DISTINCT ECOSECTION_NAME, BLUE_LINE_KEY, GNIS_NAME, CAST(sum(part) OVER (PARTITION BY ECOSECTION_NAME, BLUE_LINE_KEY)
        AS BIGINT) AS priority_rating FROM (SELECT s.ECOSECTION_NAME, s.BLUE_LINE_KEY, s.GNIS_NAME,
        coalesce({_code('s.summer_sens')},0)+coalesce({_code('s.winter_sens')},0)
        +coalesce(CASE b.fish_observed WHEN 'N' THEN 1 WHEN 'Y' THEN 2 END,0)
        +coalesce(CASE b.habitat_value WHEN 'Low habitat value' THEN 1 WHEN 'Medium habitat value' THEN 2 WHEN 'High habitat value' THEN 3 END,0)
        +coalesce(x.number_sar,0) AS part FROM (SELECT DISTINCT k.ECOSECTION_NAME, k.BLUE_LINE_KEY, k.summer_sens, k.winter_sens,
        CASE WHEN c.hit THEN c.corrector ELSE k.GNIS_NAME END AS GNIS_NAME FROM kept k LEFT JOIN (
          SELECT ECOSECTION_NAME, BLUE_LINE_KEY, TRUE AS hit, string_agg(CASE WHEN GNIS_NAME<>'Unknown' THEN GNIS_NAME END, ', '
          ORDER BY n DESC, GNIS_NAME NULLS LAST) AS corrector FROM (SELECT {_k3}, count(*) AS n FROM kept WHERE BLUE_LINE_KEY IS NOT NULL GROUP BY ALL)
          GROUP BY ECOSECTION_NAME, BLUE_LINE_KEY HAVING count(*)>1) c
        ON {_same('k', 'c', ['ECOSECTION_NAME', 'BLUE_LINE_KEY'])}) s JOIN sar_sections x ON s.ECOSECTION_NAME=x.ECOSECTION_NAME
        LEFT JOIN best b ON {_same('s', 'b', ['ECOSECTION_NAME', 'BLUE_LINE_KEY'])})""",
    # A concave polygon is the union of two boxes: the whole lower half and the left part of the upper half.
    **{name: f"""SELECT {cols}, xmin, ymin, xmax, CAST((ymin+ymax)/2 AS BIGINT) AS ymax FROM {source} UNION ALL
        SELECT {cols}, xmin, CAST((ymin+ymax)/2 AS BIGINT), CAST((xmin+xmax)/2 AS BIGINT), ymax FROM {source}"""
       for name, cols, source in (("region_parts", "region_id, REGION_NAME", "fx_regions"),
                                  ("section_parts", "eco_id, ECOSECTION_NAME", "fx_ecosections"))},
    # A species area is the left part of its upper half and four strips of the lower half around the hole.
    "species_parts": " UNION ALL ".join(f"SELECT occ_id, SCI_NAME, ENG_NAME, CAST({x0} AS BIGINT) AS xmin, CAST({y0} AS BIGINT) AS ymin,"
        f" CAST({x1} AS BIGINT) AS xmax, CAST({y1} AS BIGINT) AS ymax FROM fx_sar" for x0, y0, x1, y1 in (
            ("xmin", "(ymin+ymax)/2", "(xmin+xmax)/2", "ymax"), ("xmin", "ymin", "xmax", "ymin+100"), ("xmin", "ymin+500", "xmax", "(ymin+ymax)/2"),
            ("xmin", "ymin", "xmin+100", "(ymin+ymax)/2"), ("xmin+1100", "ymin", "xmax", "(ymin+ymax)/2"))),
    "texts_once": f"""SELECT {', '.join('s.' + c for c in _K5)}, coalesce(t.a,'NA') AS SCI_NAME, coalesce(t.b,'NA') AS ENG_NAME FROM streams s
        LEFT JOIN (SELECT {_k5}, string_agg(coalesce(SCI_NAME,'NA'), ', ' ORDER BY occ_id) AS a, string_agg(ENG_NAME, ', ' ORDER BY occ_id) AS b
        FROM species_hits GROUP BY {_k5}) t ON {_same('s', 't', _K5)}""",
    "hand_regions": "SELECT h.row_id, r.REGION_NAME FROM fx_expert_streams h LEFT JOIN ("
                    + _box_pairs("e.row_id, p.region_id", "hand_edges", "region_parts", 50000)
                    + ") p USING (row_id) LEFT JOIN fx_regions r USING (region_id)",
}

_SEASONS = {
    "both": "CASE WHEN sens_combo='NN' THEN 'not sensitive' WHEN sens_combo IN ('YN','NY') THEN 'one season'"
            " WHEN sens_combo='YY' THEN 'sensitive' END",
    "summer": "CASE WHEN sens_combo IN ('NN','NY') THEN 'not sensitive' WHEN sens_combo IN ('YN','YY') THEN 'sensitive' END",
    "winter": "CASE WHEN sens_combo IN ('NN','YN') THEN 'not sensitive' WHEN sens_combo IN ('NY','YY') THEN 'sensitive' END",
}
_SHORT = "regexp_replace(REGION_NAME, ' Natural.*', '')"

# The provincial Albers grid on the GRS80 ellipsoid, as in the projection helper.
_GRID = """SELECT 6378137.0 AS a, f*(2-f) AS e2, sqrt(f*(2-f)) AS e, radians(50.0) AS p1, radians(58.5) AS p2, radians(45.0) AS p0
    FROM (SELECT 1/298.257222101 AS f)"""


def _q(phi):
    return (f"((1-e2)*(sin({phi})/(1-e2*sin({phi})*sin({phi}))-ln((1-e*sin({phi}))/(1+e*sin({phi})))/(2*e)))")


def _m2(phi):
    return f"(cos({phi})*cos({phi})/(1-e2*sin({phi})*sin({phi})))"


def _improved(phi):
    return (f"({phi}+(q-{_q(phi)})/(1-e2)*(1-e2*sin({phi})*sin({phi}))*(1-e2*sin({phi})*sin({phi}))/(2*cos({phi})))")


def _lonlat(select, source, x, y):
    """Inverse Albers: the series of the authalic latitude, then two corrections."""
    return f"""WITH grid AS ({_GRID}), c1 AS (SELECT *, ({_m2('p1')}-{_m2('p2')})/({_q('p2')}-{_q('p1')}) AS n FROM grid),
    c2 AS (SELECT *, {_m2('p1')}+n*{_q('p1')} AS c, {_q('radians(90.0)')} AS qp FROM c1),
    c3 AS (SELECT *, a*sqrt(c-n*{_q('p0')})/n AS rho0 FROM c2),
    pts AS (SELECT t.*, {x}-1000000.0 AS dx, rho0-{y} AS dy, c3.* FROM ({source}) t, c3),
    beta AS (SELECT *, (c-(dx*dx+dy*dy)*n*n/(a*a))/n AS q FROM pts),
    series AS (SELECT *, b+(e2/3+31*e2*e2/180)*sin(2*b)+(23*e2*e2/360)*sin(4*b) AS phi FROM (SELECT *, asin(q/qp) AS b FROM beta)),
    better AS (SELECT *, {_improved('phi')} AS phi2 FROM series)
    SELECT {select}, round(degrees(atan2(dx,dy))/n-126.0,6) AS lon, round(degrees({_improved('phi2')}),6) AS lat FROM better"""


def _needed(sql, seen):
    import re

    order = []
    for word in re.findall(r"\b[a-z_]+\b", sql):
        body = view_sql(word) if word in VIEWS else CTES.get(word)
        if body is None or word in seen:
            continue
        seen.add(word)  # a recursive definition names itself
        order += _needed(body, seen) + [(word, body.replace("AS STRING", "AS VARCHAR"))]
    return order


def _with(sql):
    """Prefix a statement with the definitions it refers to, directly or not."""
    blocks = _needed(sql, set())
    if not blocks:
        return sql
    head = ("WITH RECURSIVE " if any(name.endswith(("_open", "_rings", "_steps")) for name, _ in blocks) else "WITH ") + ",\n".join(f"{name} AS ({body})" for name, body in blocks)
    if sql.lstrip().startswith("WITH "):
        return head + ",\n" + sql.lstrip()[5:]
    return head + "\n" + sql


SQL = {
    # segments
    "seg_max_sensitivity": "SELECT seg_id, BLUE_LINE_KEY, summer_sens, winter_sens FROM levelled",
    "seg_filter": "SELECT seg_id, ECOSECTION_NAME, STREAM_ORDER, FEATURE_SOURCE FROM kept",
    "segment_preparation": f"SELECT seg_id, {_k5} FROM kept",
    "source_not_in_list": "SELECT seg_id, FEATURE_SOURCE FROM fx_segments WHERE FEATURE_SOURCE IS NULL OR FEATURE_SOURCE NOT IN ('lake-def skelet','OP')",
    "ordinal_encode": f"SELECT seg_id, {_code('summer_sens')} AS summer_code, {_code('winter_sens', 1)} AS winter_code FROM fx_segments",
    # joins, counts, names
    "count_sorted": "SELECT BLUE_LINE_KEY, GNIS_NAME, n FROM names ORDER BY n DESC, BLUE_LINE_KEY NULLS LAST, GNIS_NAME NULLS LAST",
    "add_count": "SELECT seg_id, BLUE_LINE_KEY, count(*) OVER (PARTITION BY BLUE_LINE_KEY) AS n FROM fx_segments",
    "null_safe_left_join": f"SELECT s.{', s.'.join(_K3)}, n.n AS n_segments FROM (SELECT DISTINCT {_k3} FROM fx_segments) s"
                           f" LEFT JOIN names n ON {_same('s', 'n', ['BLUE_LINE_KEY', 'GNIS_NAME'])}",
    "first_match_join": """SELECT s.BLUE_LINE_KEY, k.Summer_Sen AS stream_summer_sens, k.Winter_Sen AS stream_winter_sens
        FROM (SELECT DISTINCT BLUE_LINE_KEY FROM fx_segments) s LEFT JOIN keyed k ON s.BLUE_LINE_KEY=k.BLUE_LINE_KEY""",
    "semi_join_stations": "SELECT STATION_NUMBER, STATION_NAME FROM fx_stations WHERE STATION_NAME IN (SELECT stream FROM fx_hydromaster)",
    "anti_join_unmatched": """SELECT seg_id, BLUE_LINE_KEY FROM fx_segments s WHERE NOT EXISTS
        (SELECT 1 FROM fx_expert_streams h WHERE s.BLUE_LINE_KEY IS NOT DISTINCT FROM CAST(h.BLUE_LINE_ AS INT))""",
    "name_repair": "SELECT BLUE_LINE_KEY, corrector FROM correctors",
    "name_repair_literal": """SELECT BLUE_LINE_KEY, replace(string_agg(CASE WHEN GNIS_NAME IS NULL OR GNIS_NAME='Unknown' THEN 'NA' ELSE GNIS_NAME END,
        ', ' ORDER BY n DESC, GNIS_NAME NULLS LAST), ', NA', '') AS corrector FROM several GROUP BY BLUE_LINE_KEY""",
    "repaired_segments": """SELECT s.seg_id, CASE WHEN s.BLUE_LINE_KEY IS NOT DISTINCT FROM c.BLUE_LINE_KEY AND c.hit THEN c.corrector
        ELSE s.GNIS_NAME END AS GNIS_NAME FROM fx_segments s LEFT JOIN (SELECT *, TRUE AS hit FROM correctors) c
        ON s.BLUE_LINE_KEY IS NOT DISTINCT FROM c.BLUE_LINE_KEY""",
    "split_keyed": "SELECT row_id, CASE WHEN BLUE_LINE_='0' THEN 'unkeyed' ELSE 'keyed' END AS part FROM fx_expert_streams",
    "union_by_name": """SELECT ECOSECTION_NAME, summer_sens, NULL AS REGION_NAME, NULL AS GNIS_NAME, NULL AS STREAM_ORDER FROM fx_ecosections
        UNION ALL SELECT NULL, NULL, REGION_NAME, NULL, NULL FROM fx_regions
        UNION ALL SELECT ECOSECTION_NAME, NULL, NULL, GNIS_NAME, STREAM_ORDER FROM fx_segments""",
    "variable_ties": """SELECT assessment_id, habitat_value, final_score FROM (SELECT *, rank() OVER (PARTITION BY habitat_value
        ORDER BY final_score DESC NULLS LAST) AS r FROM fx_pscis) WHERE r=1 AND final_score IS NOT NULL""",
    # cleaning and stations
    "fill_missing_values": """SELECT assessment_id, coalesce(fish_observed,'Unknown') AS fish_observed,
        coalesce(habitat_value,'Unknown') AS habitat_value, coalesce(final_score,0) AS final_score, assessment_date FROM fx_pscis""",
    "numeric_cleaning": "SELECT row_id, round_even(TRY_CAST(mad_l_s_text AS DOUBLE),2) AS mad_l_s FROM fx_hydromaster",
    "station_table": """SELECT s.STATION_NUMBER, s.STATION_NAME, round_even(TRY_CAST(h.mad_l_s_text AS DOUBLE),2) AS mad_l_s, s.x, s.y FROM fx_stations s
        JOIN (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY row_id) AS rn FROM fx_hydromaster) h ON s.STATION_NAME=h.stream AND h.rn=1""",
    "first_sheet_row": """SELECT row_id, stream AS STATION_NAME, mad_l_s_text AS mad_l_s FROM (SELECT *, row_number() OVER
        (PARTITION BY stream ORDER BY row_id) AS rn FROM fx_hydromaster) WHERE rn=1""",
    "sheet_promotion": "SELECT row_id+3 AS row_no, stream AS stream_name, mad_l_s_text AS max_summer FROM fx_hydromaster",
    "expert_sheet_flags": f"""SELECT row_id, StreamName AS GNIS_NAME, {_EXPERT_LEVELS.format(c='Summer_Sen')} AS summer_sens_expert_id,
        {_EXPERT_LEVELS.format(c='Winter_Sen')} AS winter_sens_expert_id FROM fx_expert_streams""",
    "expert_flag_counts": f"""SELECT EcoProvinc, CAST(sum({_EXPERT_LEVELS.format(c='Summer_Sen')}) AS BIGINT) AS summer,
        CAST(sum({_EXPERT_LEVELS.format(c='Winter_Sen')}) AS BIGINT) AS winter FROM fx_expert_streams GROUP BY EcoProvinc""",
    "crossing_projection": "SELECT assessment_date, assessment_id, fish_observed, habitat_value, barrier, final_score, x, y FROM fx_pscis",
    # spatial joins
    "crossing_within_50m": _point_pairs("e.seg_id, p.assessment_id", "fx_edges", 50),
    "crossing_on_line": _point_pairs("e.seg_id, p.assessment_id", "fx_edges", 0),
    "species_overlay": _box_pairs("e.seg_id, p.occ_id", "fx_edges", "species_parts", 1000),
    "region_overlay": _box_pairs("e.seg_id, p.region_id", "fx_edges", "fx_regions", 50000),
    "polygon_overlay": _box_pairs("e.seg_id, p.region_id", "fx_edges", "region_parts", 50000),
    "expert_overlay": _edge_pairs("e.seg_id, p.row_id", "fx_edges", "unkeyed_edges"),
    "name_matched_overlay": _edge_pairs("e.seg_id, p.row_id", "fx_edges", "hand_edges", "e.GNIS_NAME=p.StreamName"),
    "spatial_left_join": "SELECT row_id, StreamName, REGION_NAME FROM hand_regions JOIN fx_expert_streams USING (row_id)",
    "streams_by_section": "SELECT h.row_id, s.ECOSECTION_NAME AS EcoSection FROM (" + _box_pairs(
        "e.row_id, p.eco_id", "hand_edges", "section_parts", 50000) + ") h JOIN fx_ecosections s USING (eco_id)",
    # aggregates
    "species_richness": f"SELECT {_k3}, number_distinct_SAR FROM richness",
    "species_text": f"SELECT {_k3}, SCI_NAME, ENG_NAME FROM texts",
    "species_text_once": f"SELECT {_k3}, SCI_NAME, ENG_NAME FROM texts_once",
    "aquatic_species": """SELECT occ_id, SCI_NAME AS scientific_name, TAX_CLASS AS tax_class, ECOSECTION AS ecosec FROM fx_sar
        WHERE TAX_CLASS IN ('amphibians','ray-finned fishes','bivalves','Lampreys')""",
    "species_by_section": "SELECT ECOSECTION_CODE, number_sar FROM sar_codes",
    "sections_with_species": "SELECT ECOSECTION_CODE, summer_sens, winter_sens, number_sar FROM sar_sections",
    "section_text_by_key": """SELECT BLUE_LINE_, string_agg(Ecosection, ', ' ORDER BY row_id) AS Ecosections FROM fx_expert_streams
        WHERE BLUE_LINE_<>'0' GROUP BY BLUE_LINE_""",
    "section_text_distinct": """SELECT BLUE_LINE_, string_agg(Ecosection, ', ' ORDER BY first) AS Ecosections FROM (SELECT BLUE_LINE_, Ecosection,
        min(row_id) AS first FROM fx_expert_streams WHERE BLUE_LINE_<>'0' GROUP BY ALL) GROUP BY BLUE_LINE_""",
    # scoring
    "drought_risk": f"SELECT {_k3}, drought_risk, number_distinct_SAR FROM scored",
    "expert_coalesce": f"SELECT {_k3}, stream_summer_sens, stream_winter_sens FROM parts",
    "harmonized_risk": f"SELECT DISTINCT {_k3}, drought_risk, number_distinct_SAR FROM harmonized",
    "drought_risk_by_rows": "SELECT BLUE_LINE_KEY, GNIS_NAME, CAST(coalesce(sum(value),0) AS BIGINT) AS drought_risk FROM long_parts GROUP BY ALL",
    "drought_risk_max_variable": """SELECT BLUE_LINE_KEY, GNIS_NAME, CAST(coalesce(sum(value),0) AS BIGINT) AS drought_risk FROM (
        SELECT BLUE_LINE_KEY, GNIS_NAME, variable, max(value) AS value FROM long_parts GROUP BY ALL) GROUP BY ALL""",
    "top_200_risk": f"SELECT {_k3}, drought_risk FROM scored ORDER BY drought_risk DESC, BLUE_LINE_KEY NULLS LAST, GNIS_NAME NULLS LAST, ECOSECTION_NAME LIMIT 200",
    "stream_delivery": f"""SELECT h.drought_risk, h.BLUE_LINE_KEY, h.GNIS_NAME, h.number_distinct_SAR, t.SCI_NAME, t.ENG_NAME, h.stream_winter_sens,
        h.stream_summer_sens, h.summer_sens, h.winter_sens, h.fish_observed FROM harmonized h LEFT JOIN texts_once t ON {_same('h', 't', _K5)}""",
    "keep_best_crossing": "SELECT ECOSECTION_NAME, BLUE_LINE_KEY, assessment_id, fish_observed, habitat_value, final_score FROM best",
    "priority_rating": "SELECT * FROM rated",
    "rated_lines": "SELECT t.ECOSECTION_NAME, t.BLUE_LINE_KEY, t.GNIS_NAME, x, y, next_x, next_y, r.priority_rating, n_vertices, lon, lat FROM ("
        + _lonlat(f"key.ECOSECTION_NAME AS ECOSECTION_NAME, key.BLUE_LINE_KEY AS BLUE_LINE_KEY, key.GNIS_NAME AS GNIS_NAME, {_PART}, n_vertices",
                  "SELECT key, part, CAST(len(path) AS INT) AS n_vertices, path[len(path)][1] AS end_x, path[len(path)][2] AS end_y FROM ("
                  + _thinned("tidy_lines", "key, part", _kept_vertices("tidy_areas", "key, part", 0.05, "key.ECOSECTION_NAME")) + ")", "end_x", "end_y")
        + f") t LEFT JOIN rated r ON {_same('t', 'r', _K3)}",
    # lookup and reconciliation
    **{name: "SELECT f.BLUE_LINE_KEY, f.GNIS_NAME, q.request_no, z.n_edges, CAST(round(z.length_m*1000) AS BIGINT) AS length_mm,"
                      f" {text} AS Ecosections FROM found_keys f JOIN"
                      " (SELECT StreamName, CAST(row_number() OVER (PARTITION BY StreamName ORDER BY row_id) AS INT) AS request_no,"
                      " CAST(count(*) OVER (PARTITION BY StreamName) AS INT) AS times FROM fx_expert_streams) q ON f.GNIS_NAME=q.StreamName"
                      " JOIN found_sizes z ON f.BLUE_LINE_KEY=z.BLUE_LINE_KEY AND f.GNIS_NAME=z.GNIS_NAME LEFT JOIN"
                      " (SELECT BLUE_LINE_KEY, GNIS_NAME, string_agg(ECOSECTION_NAME, ', ' ORDER BY eco_id) AS l FROM ("
                      + _box_pairs("e.BLUE_LINE_KEY, e.GNIS_NAME, p.eco_id, p.ECOSECTION_NAME", "found_edges", "section_parts", 50000)
                      + ") GROUP BY ALL) t ON f.BLUE_LINE_KEY=t.BLUE_LINE_KEY AND f.GNIS_NAME=t.GNIS_NAME"
       for name, text in (("lookup_streams", "coalesce(t.l,'NA')"),
                          ("lookup_streams_repeated", "repeat(coalesce(t.l,'NA')||', ', q.times-1)||coalesce(t.l,'NA')"))},
    "lookup_in_section": "SELECT GNIS_NAME, Ecosection, BLUE_LINE_KEY FROM (SELECT h.*, r.Ecosection, row_number() OVER"
                         " (PARTITION BY GNIS_NAME, Ecosection ORDER BY seg_id) AS rn FROM ("
                         + _box_pairs("e.seg_id, e.BLUE_LINE_KEY, e.GNIS_NAME, p.ECOSECTION_NAME", "fx_edges", "section_parts", 50000)
                         + ") h JOIN (SELECT DISTINCT StreamName, Ecosection FROM fx_expert_streams) r"
                         " ON h.GNIS_NAME=r.StreamName AND h.ECOSECTION_NAME=r.Ecosection) WHERE rn=1 AND BLUE_LINE_KEY IS NOT NULL",
    "lookup_unmatched": """SELECT row_id, StreamName AS Stream, Ecosection FROM fx_expert_streams
        WHERE StreamName NOT IN (SELECT GNIS_NAME FROM found_keys)""",
    "longer_than_gate": "SELECT BLUE_LINE_KEY, GNIS_NAME FROM longer",
    "replace_geometry": """SELECT h.row_id, h.BLUE_LINE_||h.StreamName AS uniqID, u.BLUE_LINE_KEY AS new_key, u.GNIS_NAME AS new_name
        FROM fx_expert_streams h LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CAST(BLUE_LINE_KEY AS VARCHAR)||GNIS_NAME
          ORDER BY ord DESC) AS rn FROM (SELECT BLUE_LINE_KEY, GNIS_NAME, max(seg_id) AS ord FROM fx_segments
          WHERE BLUE_LINE_KEY IS NOT NULL AND GNIS_NAME IS NOT NULL GROUP BY ALL)) WHERE rn=1) u
        ON h.BLUE_LINE_||h.StreamName = CAST(u.BLUE_LINE_KEY AS VARCHAR)||u.GNIS_NAME
        AND h.BLUE_LINE_||h.StreamName IN (SELECT uniqID FROM hand_keys)""",
    "reconcile_lines": "SELECT * EXCLUDE (gid) FROM reconciled",
    "reconcile_overridden": f"""SELECT * EXCLUDE (gid) FROM reconciled WHERE BLUE_LINE_ NOT IN (SELECT BLUE_LINE_ FROM overridden) UNION ALL
        SELECT DISTINCT r.* EXCLUDE (gid) REPLACE ('Upland, Basin' AS Ecosection, true AS replaced, u.n_edges AS n_edges, u.length_mm AS length_mm)
        FROM reconciled r JOIN (SELECT BLUE_LINE_, count(*) AS n_edges, CAST(round(sum({_LEN})*1000) AS BIGINT) AS length_mm FROM united_edges
        GROUP BY BLUE_LINE_) u USING (BLUE_LINE_)""",
    "column_duplicates": """SELECT row_id, a>1 AND b>1 AND c>1 AND d>1 AS is_dup FROM (SELECT row_id,
        row_number() OVER (PARTITION BY row_id%700 ORDER BY row_id) AS a, row_number() OVER (PARTITION BY Summer_Sen ORDER BY row_id) AS b,
        row_number() OVER (PARTITION BY Winter_Sen ORDER BY row_id) AS c, row_number() OVER (PARTITION BY BLUE_LINE_ ORDER BY row_id) AS d
        FROM fx_expert_streams)""",
    "manual_override": f"""SELECT * EXCLUDE (own) FROM (SELECT DISTINCT {', '.join('h.' + c for c in _SEVEN if c != 'Ecosection')},
        CASE WHEN z.n_edges IS NULL THEN h.Ecosection ELSE 'Upland, Basin' END AS Ecosection, z.n_edges,
        CAST(round(z.length_m*1000) AS BIGINT) AS length_mm, CASE WHEN z.n_edges IS NULL THEN h.row_id END AS own FROM fx_expert_streams h
        LEFT JOIN (SELECT BLUE_LINE_, count(*) AS n_edges, sum({_LEN}) AS length_m FROM (SELECT DISTINCT BLUE_LINE_, ax, ay, bx, by_
        FROM hand_edges WHERE BLUE_LINE_ IN (SELECT BLUE_LINE_ FROM fx_expert_streams WHERE row_id%50=2)) GROUP BY BLUE_LINE_) z
        ON h.BLUE_LINE_=z.BLUE_LINE_)""",
    # geometry
    "line_length": """SELECT seg_id, CAST(round((sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0))
        +sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)))*1000) AS BIGINT) AS length_mm FROM fx_segments""",
    "dissolve_counts": f"""SELECT BLUE_LINE_KEY, GNIS_NAME, count(*) AS n_edges, CAST(round(sum({_LEN})*1000) AS BIGINT) AS length_mm
        FROM (SELECT DISTINCT BLUE_LINE_KEY, GNIS_NAME, ax, ay, bx, by_ FROM fx_edges) GROUP BY BLUE_LINE_KEY, GNIS_NAME""",
    "dissolved_lines": """SELECT key AS name, CAST(path[1][1] AS BIGINT) AS x, CAST(path[1][2] AS BIGINT) AS y, CAST(path[2][1] AS BIGINT) AS next_x,
        CAST(path[2][2] AS BIGINT) AS next_y, n_edges, CAST(round(length_m*1000) AS BIGINT) AS length_mm FROM named_parts""",
    "noded_union": f"SELECT name, count(*) AS n_edges, CAST(round(sum({_LEN})*1000) AS BIGINT) AS length_mm FROM noded_edges GROUP BY name",
    "noded_lines": "SELECT key AS name, " + ", ".join(f"CAST(round(path[{i}][{j}]*1000) AS BIGINT) AS {c}" for c, i, j in (
        ("x", 1, 1), ("y", 1, 2), ("next_x", 2, 1), ("next_y", 2, 2))) + ", n_edges, CAST(round(length_m*1000) AS BIGINT) AS length_mm FROM noded_parts",
    "expert_dissolve": f"""SELECT {_seven}, count(*) AS n_edges, CAST(round(sum(sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)))*1000) AS BIGINT) AS length_mm
        FROM (SELECT DISTINCT {_seven}, x0, y0, x1, y1 FROM fx_expert_streams) GROUP BY {_seven}""",
    "equal_geometries": "SELECT min(seg_id) AS first_seg, count(*) AS n FROM fx_segments GROUP BY x0, y0, x1, y1, x2, y2",
    "endpoint_search": """SELECT StreamName, x0 AS lng, y0 AS lat FROM (SELECT *, row_number() OVER (PARTITION BY StreamName ORDER BY row_id) AS rn
        FROM fx_expert_streams WHERE x0<>x1 OR y0<>y1) WHERE rn=1""",
    "reproject_points": _lonlat("assessment_id", "SELECT * FROM fx_pscis", "x", "y"),
    "reproject_lines": _lonlat("row_id", "SELECT * FROM fx_expert_streams", "x0", "y0"),
    "reproject_back": "SELECT STATION_NUMBER, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM fx_stations",
    "simplify_by_tolerance": """SELECT seg_id, CASE WHEN sqrt((px-t*vx)*(px-t*vx)+(py-t*vy)*(py-t*vy))>20 THEN 3 ELSE 2 END AS n_vertices FROM (
        SELECT seg_id, x2-x0 AS vx, y2-y0 AS vy, x1-x0 AS px, y1-y0 AS py,
        greatest(0.0, least(1.0, ((x1-x0)*(x2-x0)+(y1-y0)*(y2-y0))/((x2-x0)*(x2-x0)+(y2-y0)*(y2-y0)))) AS t FROM fx_segments)""",
    "simplify_by_share": """WITH areas AS (SELECT seg_id, abs((x1-x0)*(y2-y0)-(y1-y0)*(x2-x0))/2.0 AS area FROM fx_segments),
        ranked AS (SELECT area, row_number() OVER (ORDER BY area DESC) AS r, count(*) OVER () AS n FROM areas)
        SELECT seg_id, CASE WHEN area>=(SELECT min(area) FROM ranked WHERE r<=round(0.025*n)) THEN 3 ELSE 2 END AS n_vertices FROM areas""",
    "simplify_rivers": "SELECT river_id, CAST(len(path) AS INT) AS n_vertices, " + _SUM + " FROM ("
                       + _thinned("river_lines", "river_id", _kept_vertices("river_areas", "river_id", 0.1)) + ")",
    "simplify_by_section": "SELECT river_id, ECOSECTION_NAME, CAST(len(path) AS INT) AS n_vertices, " + _SUM + " FROM ("
                           + _thinned("river_lines", "river_id", _kept_vertices("section_areas", "river_id", 0.1, "ECOSECTION_NAME"))
                           + ") JOIN (SELECT DISTINCT river_id, ECOSECTION_NAME FROM river_points) USING (river_id)",
    "simplify_rivers_by_tolerance": """SELECT river_id, CAST(count(*) AS INT) AS n_vertices, CAST(sum(path[v][1]*31+path[v][2]*17) AS BIGINT) AS vertex_sum
        FROM (SELECT DISTINCT river_id, path, unnest([a, b]) AS v FROM split_steps) GROUP BY river_id""",
    "delivery_lines_simplified": "SELECT t.ECOSECTION_NAME, t.BLUE_LINE_KEY, t.GNIS_NAME, x, y, next_x, next_y, h.drought_risk, n_vertices, lon, lat FROM ("
        + _lonlat(f"key.ECOSECTION_NAME AS ECOSECTION_NAME, key.BLUE_LINE_KEY AS BLUE_LINE_KEY, key.GNIS_NAME AS GNIS_NAME, {_PART}, n_vertices",
                  "SELECT key, part, CAST(len(path) AS INT) AS n_vertices, path[len(path)][1] AS end_x, path[len(path)][2] AS end_y FROM ("
                  + _thinned("thin_lines", "key, part", _kept_vertices("thin_areas", "key, part", 0.1)) + ")", "end_x", "end_y")
        + f") t LEFT JOIN (SELECT DISTINCT {_k3}, drought_risk FROM harmonized) h ON {_same('t', 'h', _K3)}",
    "coverage_simplified": f"SELECT tile_id, zone, n_vertices, vertex_sum FROM fx_tiles JOIN (SELECT tile_id, {_RING_SUMS} FROM tile_owned GROUP BY tile_id) USING (tile_id)",
    "common_borders": f"""SELECT owners, count(*) AS n_edges, CAST(round(sum({_LEN})*1000) AS BIGINT) AS length_mm FROM (
        SELECT least(a,b)[1] AS ax, least(a,b)[2] AS ay, greatest(a,b)[1] AS bx, greatest(a,b)[2] AS by_, count(*) AS owners FROM (
        SELECT path[i] AS a, path[i+1] AS b FROM (SELECT path, unnest(range(1, len(path))) AS i FROM tile_owned)) GROUP BY ALL) GROUP BY owners""",
    "species_simplified": f"""SELECT occ_id, SCI_NAME AS scientific_name, TAX_CLASS AS tax_class, CAST(coalesce(n_rings, 0) AS INT) AS n_rings,
        coalesce(n_vertices, 0) AS n_vertices, coalesce(vertex_sum, 0) AS vertex_sum FROM aquatic LEFT JOIN (
        SELECT occ_id, count(*) AS n_rings, {_RING_SUMS} FROM area_owned GROUP BY occ_id) USING (occ_id)""",
    "region_simplified": "SELECT REGION_NAME, REGION_NAME AS ORG_UNIT_NAME, 5 AS n_vertices FROM fx_regions",
    "delivery_lines": f"""WITH areas AS (SELECT *, abs((x1-x0)*(y2-y0)-(y1-y0)*(x2-x0))/2.0 AS area FROM kept),
        ranked AS (SELECT area, row_number() OVER (ORDER BY area DESC) AS r, count(*) OVER () AS n FROM areas)
        SELECT a.seg_id, s.drought_risk, CASE WHEN area>=(SELECT min(area) FROM ranked WHERE r<=round(0.025*n)) THEN 3 ELSE 2 END AS n_vertices
        FROM areas a LEFT JOIN harmonized s ON {_same('a', 's', _K3)}""",
    # scales
    "rescale_mad": "SELECT row_id, round(1-(mad_l_s-min(mad_l_s) OVER ())/(max(mad_l_s) OVER ()-min(mad_l_s) OVER ()),9) AS scaled FROM fx_hydromaster",
    "score_histogram": """WITH lim AS (SELECT min(final_score) AS lo, max(final_score) AS hi FROM fx_pscis),
        counts AS (SELECT least(CAST(floor((final_score-lo)/((hi-lo)/30.0)) AS INT)+1,30) AS bin, count(*) AS n FROM fx_pscis, lim
          WHERE final_score IS NOT NULL GROUP BY 1)
        SELECT CAST(b AS INT) AS bin, round(lo+(b-1)*((hi-lo)/30.0),6) AS low, round(lo+b*((hi-lo)/30.0),6) AS high, coalesce(n,0) AS n
        FROM lim, range(1,31) t(b) LEFT JOIN counts ON bin=b""",
    "pretty_bins": """WITH lim AS (SELECT min(mad_l_s) AS lo, max(mad_l_s) AS hi, (max(mad_l_s)-min(mad_l_s))/5 AS cell FROM fx_hydromaster),
        base AS (SELECT *, power(10.0, floor(log10(cell))) AS p FROM lim),
        step AS (SELECT *, CASE WHEN 2*p-cell>=1.5*(cell-p) THEN p WHEN 5*p-cell>=2.75*(cell-2*p) THEN 2*p
          WHEN 10*p-cell>=1.5*(cell-5*p) THEN 5*p ELSE 10*p END AS w FROM base)
        SELECT row_id, CAST(least(floor(mad_l_s/w)-floor(lo/w+1e-7), ceil(hi/w-1e-7)-floor(lo/w+1e-7)-1) AS INT) AS bin,
        round(w*(floor(lo/w+1e-7)+least(floor(mad_l_s/w)-floor(lo/w+1e-7), ceil(hi/w-1e-7)-floor(lo/w+1e-7)-1)),6) AS bin_low
        FROM fx_hydromaster, step""",
    "natural_breaks": """WITH h AS (SELECT final_score AS v, count(*) AS n, row_number() OVER (ORDER BY final_score) AS i FROM fx_pscis
          WHERE final_score IS NOT NULL GROUP BY final_score),
        spans AS (SELECT a.i, b.i AS j, sum(x.n*x.v*x.v)-CAST(sum(x.n*x.v) AS DOUBLE)*sum(x.n*x.v)/sum(x.n) AS cost, sum(x.n) AS n,
          a.v AS lo, b.v AS hi FROM h a JOIN h b ON a.i<=b.i JOIN h x ON x.i BETWEEN a.i AND b.i GROUP BY a.i, b.i, a.v, b.v),
        pick AS (SELECT s1.j AS j1, s2.j AS j2, s3.j AS j3, s4.j AS j4 FROM spans s1 JOIN spans s2 ON s1.i=1 AND s2.i=s1.j+1
          JOIN spans s3 ON s3.i=s2.j+1 JOIN spans s4 ON s4.i=s3.j+1 JOIN spans s5 ON s5.i=s4.j+1
          WHERE s5.j=(SELECT max(i) FROM h) ORDER BY s1.cost+s2.cost+s3.cost+s4.cost+s5.cost LIMIT 1),
        cuts AS (SELECT unnest([1,2,3,4,5]) AS class, unnest([1,j1+1,j2+1,j3+1,j4+1]) AS i,
          unnest([j1,j2,j3,j4,(SELECT max(i) FROM h)]) AS j FROM pick)
        SELECT CAST(class AS INT) AS class, CAST(lo AS DOUBLE) AS low, CAST(hi AS DOUBLE) AS high, CAST(n AS BIGINT) AS n
        FROM cuts JOIN spans USING (i, j)""",
    # explorer
    **{f"season_class_{name}": f"SELECT row_id, sum_label, wint_label, sens_combo, {case} AS leaf_col FROM shown"
       for name, case in _SEASONS.items()},
    "region_filter_streams": f"""SELECT row_id, StreamName, {_SEASONS['summer']} AS leaf_col, REGION_NAME FROM shown JOIN hand_regions USING (row_id)
        WHERE {_SHORT}='{REGION}'""",
    "whole_province_streams": f"""SELECT row_id, StreamName, {_SEASONS['winter']} AS leaf_col, REGION_NAME FROM shown
        JOIN hand_regions USING (row_id) ORDER BY StreamName, row_id""",
    "region_filter_stations": f"""SELECT DISTINCT STATION_NUMBER, STATION_NAME, REGION_NAME FROM fx_stations JOIN region_parts
        ON x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax WHERE {_SHORT}='{REGION}'""",
    "region_highlight": f"""SELECT REGION_NAME, CASE WHEN {_SHORT}='{REGION}' THEN 'black' ELSE 'lightgrey' END AS leaf_colour,
        CASE WHEN {_SHORT}='{REGION}' THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS leaf_opac FROM fx_regions""",
    "stream_choices": "SELECT DISTINCT StreamName FROM fx_expert_streams ORDER BY StreamName",
    "region_choices": f"SELECT 'Whole Province' AS choice UNION ALL SELECT DISTINCT {_SHORT} FROM fx_regions",
    "stream_popup": """SELECT GNIS_NAME AS "Name", sum_label AS "Stream Summer Sensitivity", wint_label AS "Stream Winter Sensitivity" FROM shown""",
    "section_popup": """SELECT ECOSECTION_NAME AS "Name", winter_sens AS "Winter Sensitivity", summer_sens AS "Summer Sensitivity" FROM fx_ecosections""",
    "rating_popup": f"""SELECT r.GNIS_NAME AS "Name", l.summer_sens AS "Summer Sensitivity", l.winter_sens AS "Winter Sensitivity",
        b.assessment_date AS "Assessment Date", b.fish_observed AS "Fish Observed", b.barrier AS "Barrier", b.habitat_value AS "Habitat Value",
        r.priority_rating AS "Priority Rating" FROM rated r
        LEFT JOIN (SELECT DISTINCT ECOSECTION_NAME, BLUE_LINE_KEY, summer_sens, winter_sens FROM kept) l ON {_same('r', 'l', ['ECOSECTION_NAME', 'BLUE_LINE_KEY'])}
        LEFT JOIN best b ON {_same('r', 'b', ['ECOSECTION_NAME', 'BLUE_LINE_KEY'])}""",
    # sources and sinks
    "layer_roundtrip": "SELECT assessment_id, barrier, final_score FROM fx_pscis WHERE final_score>20",
    "catalogue_by_name": "SELECT seg_id, BLUE_LINE_KEY FROM fx_segments WHERE GNIS_NAME='CREEK_7'",
    "section_files": "SELECT seg_id, replace(lower(ECOSECTION_NAME),' ','_') AS ecosection_slug, summer_sens FROM kept",
    "staged_layer": "SELECT occ_id, TAX_CLASS FROM fx_sar",
    "csv_export": f"""SELECT row_number() OVER (ORDER BY StreamName, row_id) AS row_number, StreamName, row_id, {_SEASONS['summer']} AS leaf_col
        FROM shown JOIN hand_regions USING (row_id) WHERE {_SHORT}='{REGION}'""",
    "layer_export": f"""SELECT DISTINCT STATION_NUMBER, x, y FROM fx_stations JOIN region_parts
        ON x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax WHERE {_SHORT}='{REGION}'""",
    "section_export": "SELECT row_number() OVER (ORDER BY ECOSECTION_NAME) AS row_number, ECOSECTION_NAME, summer_sens, number_sar FROM sar_sections",
    "expert_layer": f"SELECT {', '.join('key.' + c + ' AS ' + c for c in _SEVEN)}, {_PART}, CAST(len(path) AS INT) AS n_vertices, {_SUM} FROM ("
                    + _thinned("drawn_lines", "key, part", _kept_vertices("drawn_areas", "key, part", 0.05)) + ")",
    "app_stream_layer": "SELECT row_id, 2 AS n_vertices, round(lon,6) AS lon, round(lat,6) AS lat FROM (" + _lonlat("row_id", "SELECT * FROM fx_expert_streams", "x0", "y0") + ")",
    "sheet_file": "SELECT row_id+3 AS row_no, stream AS stream_name, mad_l_s_text AS mad_l_s FROM fx_hydromaster",
    "station_points": "SELECT STATION_NUMBER, x, y FROM fx_stations",
    "dissolve_selection": f"SELECT count(*) AS n_edges, CAST(round(sum({_LEN})*1000) AS BIGINT) AS length_mm FROM half_edges",
    "flat_lines": f"SELECT river_id, CAST(len(path) AS INT) AS n_vertices, {_SUM} FROM river_lines",
    "dated_export": f"""SELECT 'Stream_Drought_Sensitivity_{REGION}_2024-04-08.csv' AS file, count(*) AS n FROM hand_regions WHERE {_SHORT}='{REGION}'""",
    "station_csv_export": f"""SELECT row_number() OVER (ORDER BY STATION_NUMBER) AS row_number, STATION_NUMBER, STATION_NAME FROM (
        SELECT DISTINCT STATION_NUMBER, STATION_NAME FROM fx_stations JOIN region_parts
        ON x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax WHERE {_SHORT}='{REGION}')""",
    "stream_layer_export": f"""SELECT row_id, {_SEASONS['summer']} AS leaf_col, 2 AS n_vertices, CAST((x0+x1)*31+(y0+y1)*17 AS BIGINT) AS vertex_sum
        FROM shown JOIN hand_regions USING (row_id) WHERE {_SHORT}='{REGION}'""",
    "section_layer_export": """SELECT ECOSECTION_NAME, number_sar, 7 AS n_vertices, CAST(31*(3*xmin+2*xmax+(xmin+xmax))+17*(3*ymin+2*ymax+(ymin+ymax)) AS BIGINT)
        AS vertex_sum FROM sar_sections""",
    "station_popup": f"""SELECT DISTINCT STATION_NUMBER, STATION_NAME, PROV_TERR_STATE_LOC FROM fx_stations JOIN region_parts
        ON x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax WHERE {_SHORT}='{REGION}'""",
    "legend_values": "SELECT DISTINCT final_score FROM fx_pscis WHERE final_score IS NOT NULL ORDER BY final_score DESC",
    "species_matches": f"SELECT {_k3}, occ_id, SCI_NAME, ENG_NAME FROM species_hits",
    "crossing_counts": f"SELECT {_k3}, CAST(count(DISTINCT assessment_id) AS INT) AS times FROM near GROUP BY {_k3}",
    "station_registry": "SELECT STATION_NUMBER, PROV_TERR_STATE_LOC FROM fx_stations",
}


def oracle_sql():
    return {name: _with(sql) for name, sql in SQL.items()}
