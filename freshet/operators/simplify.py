"""Line generalisation: by tolerance, or by the share of vertices kept in the whole layer."""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from freshet.operators.joins import _as_list, inner_join, left_join
from freshet.sources.layers import materialise

BINS = 1_024          # histogram size of one selection pass
LONG = 512            # vertices up to which lines of one size are worked on together
TOGETHER = 1 << 18    # vertices of the lines that are worked on together


def _keep_by_tolerance(x, y, starts, sizes, tolerance):
    """Mark the vertices of all lines that deviate more than the tolerance.

    All open spans of all lines are looked at together: each is split at its farthest vertex (the first one of equals) if
    that deviates, and the two halves are the spans of the next round.
    """
    keep = np.zeros(len(x), bool)
    real = sizes > 0
    first, last = starts[real], starts[real] + sizes[real] - 1
    keep[first] = keep[last] = True
    while True:
        inner = last - first - 1
        first, last, inner = first[inner > 0], last[inner > 0], inner[inner > 0]
        if not len(first):
            return keep
        begin = np.cumsum(inner) - inner
        span = np.repeat(np.arange(len(first)), inner)
        at = np.arange(len(span)) - begin[span] + first[span] + 1
        a, b = first[span], last[span]
        gap = _distance(x[a], y[a], x[b], y[b], x[at], y[at])
        most = np.maximum.reduceat(gap, begin)
        hit = np.flatnonzero(gap == most[span])
        _, place = np.unique(span[hit], return_index=True)
        far = at[hit[place]]
        split = most > tolerance
        keep[far[split]] = True
        first, last = np.concatenate([first[split], far[split]]), np.concatenate([far[split], last[split]])


def _distance(ax, ay, bx, by, px, py):
    """Distance of points p from the line pieces a-b."""
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    along = (px - ax) * dx + (py - ay) * dy
    t = np.clip(np.divide(along, length2, out=np.zeros_like(px), where=length2 > 0), 0, 1)
    ex, ey = px - (ax + t * dx), py - (ay + t * dy)
    return np.sqrt(ex * ex + ey * ey)


def _triangle(ax, ay, bx, by, cx, cy):
    return np.abs((bx - ax) * (cy - ay) - (by - ay) * (cx - ax)) / 2


def _effective_areas(x, y):
    """Area each inner vertex stands for: repeatedly drop the one spanning the smallest triangle."""
    n = len(x)
    areas = np.full(n, np.inf)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    x, y = x.tolist(), y.tolist()

    def triangle(i):
        a, c = before[i], after[i]
        return abs((x[i] - x[a]) * (y[c] - y[a]) - (y[i] - y[a]) * (x[c] - x[a])) / 2

    current = {i: triangle(i) for i in range(1, n - 1)}
    heap = [(area, i) for i, area in current.items()]
    heapq.heapify(heap)
    floor = 0.0
    while heap:
        area, i = heapq.heappop(heap)
        if current.get(i) != area:
            continue
        del current[i]
        floor = max(floor, area)
        areas[i] = floor
        left, right = before[i], after[i]
        after[left], before[right] = right, left
        for j in (left, right):
            if j in current:
                current[j] = triangle(j)
                heapq.heappush(heap, (current[j], j))
    return areas


def _effective_areas_together(x, y):
    """The same for many lines of one size, as the rows of x and y: each step drops one vertex of every line."""
    rows, n = np.arange(len(x)), x.shape[1]
    areas = np.full(x.shape, np.inf)
    before, after = np.tile(np.arange(-1, n - 1), (len(x), 1)), np.tile(np.arange(1, n + 1), (len(x), 1))

    def triangle(i):
        a, c = before[rows, i], after[rows, i]
        xa, ya = x[rows, a], y[rows, a]
        return np.abs((x[rows, i] - xa) * (y[rows, c] - ya) - (y[rows, i] - ya) * (x[rows, c] - xa)) / 2

    current = np.full(x.shape, np.inf)
    current[:, 1:-1] = _triangle(x[:, :-2], y[:, :-2], x[:, 1:-1], y[:, 1:-1], x[:, 2:], y[:, 2:])
    floor = np.zeros(len(x))
    for _ in range(n - 2):
        i = np.argmin(current, 1)
        floor = np.maximum(floor, current[rows, i])
        areas[rows, i], current[rows, i] = floor, np.inf
        left, right = before[rows, i], after[rows, i]
        after[rows, left], before[rows, right] = right, left
        for j, inside in ((left, left > 0), (right, right < n - 1)):
            current[rows, j] = np.where(inside, triangle(np.clip(j, 1, n - 2)), np.inf)
    return areas


class _Lines:
    """A batch of geometries as flat coordinates: part starts, part ends and the parts of each feature."""

    def __init__(self, geoms):
        parts = geoms.flatten()
        vertices = parts.flatten()
        self.nulls = geoms.is_null()
        self.outer = geoms.offsets.to_numpy() - geoms.offsets[0].as_py()
        self.inner = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        self.x, self.y = (c.to_numpy(zero_copy_only=False) for c in vertices.flatten())
        self.starts, self.sizes = self.inner[:-1], np.diff(self.inner)

    def by_size(self, least, most):
        """First vertices of the parts with `least` to `most` vertices, in groups of one size and of limited work."""
        sizes = self.sizes[(self.sizes >= least) & (self.sizes <= most)]
        for n in np.unique(sizes):
            first = self.starts[self.sizes == n]
            for at in range(0, len(first), max(1, TOGETHER // int(n))):
                yield int(n), first[at:at + max(1, TOGETHER // int(n))]

    def longer(self, size):
        return [slice(a, a + n) for a, n in zip(self.starts[self.sizes > size], self.sizes[self.sizes > size], strict=True)]

    def nested(self, values, inner=None):
        parts = pa.ListArray.from_arrays(pa.array(self.inner if inner is None else inner, pa.int32()), values)
        return pa.ListArray.from_arrays(pa.array(self.outer, pa.int32()), parts, mask=self.nulls)


def simplify_tolerance(df, tolerance):
    """Drop vertices that lie within `tolerance` of the line without them; ends always stay.

    Only the geometry column goes through Python, in Arrow batches.
    """
    @F.arrow_udf(df.schema["geom"].dataType)
    def simplified(geoms: pa.Array) -> pa.Array:
        lines = _Lines(geoms)
        x, y = lines.x, lines.y
        keep = _keep_by_tolerance(x, y, lines.starts, lines.sizes, tolerance)
        kept = np.concatenate([[0], np.cumsum(keep)])[lines.inner]
        return lines.nested(pa.StructArray.from_arrays([pa.array(x[keep]), pa.array(y[keep])], ["x", "y"]), kept)

    return df.withColumn("geom", simplified("geom"))


def with_areas(df):
    """Add `areas`: per part, the effective area of every vertex (infinite at the ends)."""
    @F.arrow_udf("array<array<double>>")
    def areas(geoms: pa.Array) -> pa.Array:
        lines = _Lines(geoms)
        x, y, found = lines.x, lines.y, np.full(len(lines.x), np.inf)
        for n, first in lines.by_size(3, LONG):
            at = first[:, None] + np.arange(n)
            found[at] = _effective_areas_together(x[at], y[at])
        for part in lines.longer(LONG):
            found[part] = _effective_areas(x[part], y[part])
        return lines.nested(pa.array(found))

    return df.withColumn("areas", areas("geom"))


def kth_largest(df, col, k):
    """The exact k-th largest value of a column, k counted from 1.

    Each pass counts values per equal-width bin between the current bounds and narrows the bounds to the bin
    that holds rank k; the driver sees one row per bin.
    """
    lo, hi, n = df.agg(F.min(col), F.max(col), F.count(col)).first()
    if not 1 <= k <= n:
        return None
    above = 0
    while lo < hi:
        slot = F.least(F.floor((F.col(col) - lo) / ((hi - lo) / BINS)), F.lit(BINS - 1))
        inside = df.where(F.col(col).between(lo, hi))
        bins = inside.groupBy(slot.alias("slot")).agg(F.count("*").alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi"))
        for row in sorted(bins.collect(), key=lambda r: -r["slot"]):
            if above + row["n"] >= k:
                lo, hi = row["lo"], row["hi"]
                break
            above += row["n"]
    return lo


def kth_largest_by(df, keys, col, ranks):
    """The exact k-th largest value of `col` for every key at once; `ranks` has the keys and k, counted from 1.

    In each pass every key counts its values per bin between its bounds and narrows them to the bin of its rank, so the
    passes are as many as the slowest key needs. Bins are aggregated before the shuffle, and a key's window holds one row
    per bin. Returns keys and `bound`; keys whose k is 0 or above their number of values are absent. Null keys are keys.
    """
    keys = _as_list(keys)
    spans = df.groupBy(*keys).agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("__n"))
    bounds = materialise(inner_join(spans, ranks, keys).where("k BETWEEN 1 AND __n").drop("__n"), "bounds")
    slot = F.least(F.floor((F.col(col) - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS), F.lit(BINS - 1))
    from_top = Window.partitionBy(*keys).orderBy(F.desc("__slot"))
    closed = bounds.where("lo = hi")
    while not (open_ := bounds.where("lo < hi")).isEmpty():
        inside = inner_join(df.select(*keys, col), open_, keys).where(F.col(col).between(F.col("lo"), F.col("hi")))
        bins = inside.groupBy(*keys, "k", slot.alias("__slot")).agg(
            F.count("*").alias("__n"), F.min(col).alias("lo"), F.max(col).alias("hi"))
        upto = bins.withColumn("__upto", F.sum("__n").over(from_top))
        here = upto.where("__upto >= k AND __upto - __n < k").select(*keys, "lo", "hi", (F.col("k") - F.col("__upto") + F.col("__n")).alias("k"))
        bounds = materialise(here, "bounds")
        closed = closed.unionByName(bounds.where("lo = hi"))
    return closed.select(*keys, F.col("lo").alias("bound"))


def simplify_by_section(df, section, share):
    """Keep about `share` of the inner vertices of every section, those with the largest effective areas in it.

    Each section has its own threshold; vertices that tie with it stay, and so do line ends. A section whose share rounds
    to no vertex keeps line ends only. Rows with a null section are a section.
    """
    areas = materialise(with_areas(df), "vertex_areas")
    inner = areas.select(section, F.explode(F.flatten("areas")).alias("area")).where("area < double('infinity')")
    ranks = inner.groupBy(section).agg(F.bround(F.lit(float(share)) * F.count("*")).cast("long").alias("k"))
    marked = left_join(areas, kth_largest_by(inner, section, "area", ranks), section)
    return _above(marked, F.coalesce("bound", F.lit(float("inf")))).drop("bound")


def _above(areas, threshold):
    """Lines without the vertices whose area is below the threshold."""
    kept = F.zip_with(
        "geom", "areas",
        lambda part, area: F.transform(
            F.filter(F.zip_with(part, area, lambda v, a: F.struct(v.alias("v"), a.alias("a"))), lambda p: p["a"] >= threshold),
            lambda p: p["v"],
        ),
    )
    return areas.withColumn("geom", kept).drop("areas")


def simplify_keep(df, share):
    """Keep about `share` of all inner vertices of the layer, those with the largest effective areas.

    One area threshold holds for the whole layer; vertices that tie with it stay. Ends always stay. The areas
    are computed once and written to the shared folder, as the threshold needs several passes over them.
    """
    areas = materialise(with_areas(df), "vertex_areas")
    inner = areas.select(F.explode(F.flatten("areas")).alias("area")).where("area < double('infinity')")
    wanted = int(round(share * inner.count()))
    return _above(areas, kth_largest(inner, "area", wanted) if wanted else float("inf"))
