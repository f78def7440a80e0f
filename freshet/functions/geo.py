"""Exact predicates and map-projection formulas as Column expressions.

An edge is the pair of points (ax, ay)-(bx, by). Orientation products of integer-metre coordinates are
exact in doubles; every predicate first passes a bounding-box test, so the products stay small.
"""

from pyspark.sql import functions as F

# The provincial Albers grid (EPSG 3005) on the GRS80 ellipsoid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
PARALLEL_1, PARALLEL_2 = 50.0, 58.5
ORIGIN_LAT, ORIGIN_LON = 45.0, -126.0
FALSE_EASTING, FALSE_NORTHING = 1_000_000.0, 0.0


def cross(ax, ay, bx, by, px, py):
    """Twice the signed area of triangle a, b, p."""
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def edge_hits_box(a, b, box):
    """Edge a-b meets a closed axis-parallel box (bounding boxes are known to overlap)."""
    xmin, ymin, xmax, ymax = box
    corners = [cross(*a, *b, x, y) for x in (xmin, xmax) for y in (ymin, ymax)]
    return (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)


def edge_hits_edge(a, b, p, q):
    """Edges a-b and p-q share a point (bounding boxes are known to overlap)."""
    across_ab = F.signum(cross(*a, *b, *p)) * F.signum(cross(*a, *b, *q))
    across_pq = F.signum(cross(*p, *q, *a)) * F.signum(cross(*p, *q, *b))
    return (across_ab <= 0) & (across_pq <= 0)


def point_near_edge(a, b, p, radius):
    """Point p lies within `radius` of edge a-b, rim included."""
    (ax, ay), (bx, by), (px, py) = a, b, p
    r2 = float(radius) ** 2
    length2 = (bx - ax) * (bx - ax) + (by - ay) * (by - ay)
    along = (px - ax) * (bx - ax) + (py - ay) * (by - ay)
    to_a = (px - ax) * (px - ax) + (py - ay) * (py - ay)
    to_b = (px - bx) * (px - bx) + (py - by) * (py - by)
    off = cross(ax, ay, bx, by, px, py)
    return F.when(along <= 0, to_a <= r2).when(along >= length2, to_b <= r2).otherwise(off * off <= length2 * r2)


def _q(sin_phi):
    """Authalic latitude function of the sine of a latitude."""
    e2 = FLATTENING * (2 - FLATTENING)
    e = e2 ** 0.5
    log = F.log if not isinstance(sin_phi, float) else None
    if log is None:
        from math import log
    return (1 - e2) * (sin_phi / (1 - e2 * sin_phi * sin_phi) - log((1 - e * sin_phi) / (1 + e * sin_phi)) / (2 * e))


def _albers_constants():
    from math import cos, radians, sin, sqrt

    e2 = FLATTENING * (2 - FLATTENING)

    def m2(lat):
        s = sin(radians(lat))
        return cos(radians(lat)) ** 2 / (1 - e2 * s * s)

    q0, q1, q2 = (_q(sin(radians(lat))) for lat in (ORIGIN_LAT, PARALLEL_1, PARALLEL_2))
    n = (m2(PARALLEL_1) - m2(PARALLEL_2)) / (q2 - q1)
    c = m2(PARALLEL_1) + n * q1
    rho0 = SEMI_MAJOR * sqrt(c - n * q0) / n
    return e2, n, c, rho0


def lonlat_to_albers(lon, lat):
    """Grid easting and northing of a longitude and latitude in degrees."""
    _, n, c, rho0 = _albers_constants()
    rho = F.sqrt(c - n * _q(F.sin(F.radians(lat)))) * (SEMI_MAJOR / n)
    theta = F.radians(lon - ORIGIN_LON) * n
    return rho * F.sin(theta) + FALSE_EASTING, F.lit(rho0 + FALSE_NORTHING) - rho * F.cos(theta)


def albers_to_lonlat(x, y):
    """Longitude and latitude in degrees of a grid position; the latitude by Newton steps."""
    e2, n, c, rho0 = _albers_constants()
    e = e2 ** 0.5
    east, north = x - FALSE_EASTING, F.lit(rho0 + FALSE_NORTHING) - y
    lon = F.degrees(F.atan2(east, north)) / n + ORIGIN_LON
    q = (c - (east * east + north * north) * (n * n / SEMI_MAJOR**2)) / n

    def step(acc, _):
        phi, target = acc["phi"], acc["q"]
        sin_phi = F.sin(phi)
        flat = 1 - e2 * sin_phi * sin_phi
        miss = target / (1 - e2) - sin_phi / flat + F.log((1 - e * sin_phi) / (1 + e * sin_phi)) / (2 * e)
        return F.struct((phi + flat * flat / (2 * F.cos(phi)) * miss).alias("phi"), target.alias("q"))

    start = F.struct(F.asin(q / 2).alias("phi"), q.alias("q"))
    rounds = F.array(*[F.lit(i) for i in range(6)])
    lat = F.degrees(F.aggregate(rounds, start, step)["phi"])
    return lon, lat
