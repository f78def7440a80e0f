"""Lines with polygons or points of a grid cell, compared block by block in Python.

A row holds a block of whole lines (`__l`: id, xs, ys, sizes) and a block of polygons (`__r`: id, e), of which it has all ring edges
that a line of the cell can touch or that a ray to the right from it can cross. The tests are those of functions.geo and
spatial.crosses_ray, in the same order of operations.
"""

from functools import partial

import numpy as np
import pyarrow as pa

TESTS = 1 << 15        # tests that are held at once
OUT_ROWS = 50_000      # pairs in a batch of results


def _cross(ax, ay, bx, by, px, py):
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def _numbers(values):
    return np.asarray(values.to_numpy(zero_copy_only=False), dtype="f8")


def _list(column):
    """The bounds and the values of a list column."""
    return np.asarray(column.offsets), column.values


def _inside(out, sx, sy, start_line, edge_poly, ring):
    """Mark the polygons with an odd number of edges on the ray to the right of a start."""
    low, high = np.minimum(ring[1], ring[3]), np.maximum(ring[1], ring[3])
    some = np.flatnonzero((low <= sy.max()) & (high > sy.min()))  # a null is no number, and meets nothing
    if not len(some):
        return
    poly = edge_poly[some]
    firsts = np.flatnonzero(np.diff(poly, prepend=-1))
    px, py, qx, qy = (c[some][:, None] for c in ring)
    dx, dy, up = qx - px, qy - py, qy > py
    step = max(1, TESTS // len(some))
    for at in range(0, len(sx), step):
        x, y = sx[at:at + step], sy[at:at + step]
        turn = dx * (y - py)
        turn -= dy * (x - px)
        crossed = np.where(up, turn > 0, turn < 0)
        crossed &= (py <= y) != (qy <= y)
        odd, place = np.nonzero(np.bitwise_xor.reduceat(crossed.view("u1"), firsts, axis=0))
        out[poly[firsts[odd]], start_line[at + place]] = True


def meet(line_parts, x, y, ring, part_size, starts=True):
    """Which polygons (rows) meet which lines (columns): an edge touches a ring, or a part starts inside.

    `line_parts` are the first parts of the lines and, last, the number of parts; `part_size` the vertices of a part; `ring` the
    first edges of the polygons, as line_parts, and px, py, qx, qy.
    """
    poly_first, ring = ring
    out = np.zeros((len(poly_first) - 1, len(line_parts) - 1), dtype=bool)
    first = np.concatenate([[0], np.cumsum(part_size)])
    part_line = np.repeat(np.arange(out.shape[1]), np.diff(line_parts))
    edge_poly, start = np.repeat(np.arange(out.shape[0]), np.diff(poly_first)), first[:-1]
    known = ~(np.isnan(x[start]) | np.isnan(y[start]))
    with np.errstate(invalid="ignore"):
        if starts and known.any():
            _inside(out, x[start][known], y[start][known], part_line[known], edge_poly, ring)
        _touch(out, *_edges(x, y, part_size, part_line), ring, edge_poly)
    return out


def _edges(x, y, part_size, part_line):
    """The edges of parts, and the lines they belong to."""
    tail = np.ones(len(x), dtype=bool)
    tail[np.cumsum(part_size) - 1] = False
    a = np.flatnonzero(tail)
    return [x[a], y[a], x[a + 1], y[a + 1]], np.repeat(part_line, part_size)[a]


def _touch(out, edges, edge_line, ring, edge_poly):
    """Mark the polygons and lines that have edges with a point in common and are not marked yet."""
    if not len(edge_line):
        return
    edge_box, ring_box = _box(edges), _box(ring)
    around = [f(c) for f, c in zip((np.fmin.reduce, np.fmin.reduce, np.fmax.reduce, np.fmax.reduce), edge_box)]
    some = np.flatnonzero(_overlap(around, ring_box) & ~out.all(axis=1)[edge_poly])
    few = np.flatnonzero(~out.all(axis=0)[edge_line])
    near_box = [c[some][:, None] for c in ring_box]
    step = max(1, TESTS // max(1, len(some)))
    for at in range(0, len(few) if len(some) else 0, step):
        these = few[at:at + step]
        e, k = np.nonzero(_overlap([c[these] for c in edge_box], near_box))
        e, k = some[e], these[k]
        new = ~out[edge_poly[e], edge_line[k]]
        e, k = e[new], k[new]
        line, other = [c[k] for c in edges], [c[e] for c in ring]
        hit = np.sign(_cross(*line, *other[:2])) * np.sign(_cross(*line, *other[2:])) <= 0
        hit &= np.sign(_cross(*other, *line[:2])) * np.sign(_cross(*other, *line[2:])) <= 0
        out[edge_poly[e[hit]], edge_line[k[hit]]] = True


def _box(edges):
    ax, ay, bx, by = edges
    return [np.minimum(ax, bx), np.minimum(ay, by), np.maximum(ax, bx), np.maximum(ay, by)]


def _overlap(a, b):
    met = a[0] <= b[2]
    met &= b[0] <= a[2]
    met &= a[1] <= b[3]
    met &= b[1] <= a[3]
    return met


def near(edge_first, edges, x, y, radius):
    """Which points (columns) lie within `radius` of an edge of which lines (rows); `edge_first` are the first edges of the lines."""
    out = np.zeros((len(edge_first) - 1, len(x)), dtype=bool)
    edge_line = np.repeat(np.arange(out.shape[0]), np.diff(edge_first))
    low_x, low_y, high_x, high_y = (c[:, None] + move for c, move in zip(_box(edges), (-radius, -radius, radius, radius)))
    step, r2 = max(1, TESTS // max(1, len(x))), radius ** 2
    with np.errstate(invalid="ignore"):
        for at in range(0, len(edge_line), step):
            some = slice(at, at + step)
            k, p = np.nonzero(_overlap((x, y, x, y), (low_x[some], low_y[some], high_x[some], high_y[some])))
            ax, ay, bx, by = (c[some][k] for c in edges)
            px, py = x[p], y[p]
            dx, dy, to_x, to_y = bx - ax, by - ay, px - ax, py - ay
            length2, along = dx * dx + dy * dy, to_x * dx + to_y * dy
            off = dx * to_y - dy * to_x
            to_b = (px - bx) * (px - bx) + (py - by) * (py - by)
            side = np.where(along >= length2, to_b <= r2, off * off <= length2 * r2)
            hit = np.where(along <= 0, to_x * to_x + to_y * to_y <= r2, side)
            out[edge_line[some][k[hit]], p[hit]] = True
    return out


def _within(bounds, low, high):
    """The bounds of the lists low to high, from 0, and where their values are."""
    some = bounds[low:high + 1]
    return some - some[0], slice(some[0], some[-1])


def _compared(batch, starts=True):
    """For each row of a batch the polygons and lines that meet, as a table of truth values, and their first numbers."""
    l_rows, lines = _list(batch.column("__l"))
    r_rows, polygons = _list(batch.column("__r"))
    parts, sizes = _list(lines.field("sizes"))
    (vertices, xs), (_, ys) = _list(lines.field("xs")), _list(lines.field("ys"))
    edges, ring = _list(polygons.field("e"))
    sizes, xs, ys = np.asarray(sizes), _numbers(xs), _numbers(ys)
    ring = [_numbers(ring.field(c)) for c in ("px", "py", "qx", "qy")]
    for row in range(batch.num_rows):
        l0, l1, r0, r1 = l_rows[row], l_rows[row + 1], r_rows[row], r_rows[row + 1]
        line_parts, of_parts = _within(parts, l0, l1)
        _, of_line = _within(vertices, l0, l1)
        poly_first, of_ring = _within(edges, r0, r1)
        met = meet(line_parts, xs[of_line], ys[of_line], (poly_first, [c[of_ring] for c in ring]), sizes[of_parts], starts)
        yield met, l0, r0


def _ids(batch, side):
    return batch.column(side).values.field("id")


def _compared_points(radius):
    """For each row of a batch the lines and points that are near each other, as a table of truth values, and their first numbers."""
    def compared(batch):
        l_rows, lines = _list(batch.column("__l"))
        r_rows, points = _list(batch.column("__r"))
        first, edges = _list(lines.field("e"))
        edges = [_numbers(edges.field(c)) for c in ("ax", "ay", "bx", "by")]
        x, y = (_numbers(points.field(c)) for c in "xy")
        for row in range(batch.num_rows):
            l0, l1, r0, r1 = l_rows[row], l_rows[row + 1], r_rows[row], r_rows[row + 1]
            edge_first, of_line = _within(first, l0, l1)
            yield near(edge_first, [c[of_line] for c in edges], x[r0:r1], y[r0:r1], radius).T, l0, r0
    return compared


def _pairs(line_id, other_id, compared):
    """A function over batches of block pairs that returns the ids that meet, each pair of a row once."""
    def taken(batch, left, right):
        columns = [_ids(batch, side).take(pa.array(np.concatenate(at))) for side, at in (("__l", left), ("__r", right))]
        return pa.RecordBatch.from_arrays(columns, names=[line_id, other_id])

    def run(batches):
        for batch in batches:
            left, right, waiting = [], [], 0
            for met, l0, r0 in compared(batch):
                other, line = np.nonzero(met)
                for at in range(0, len(line), OUT_ROWS):
                    left.append(line[at:at + OUT_ROWS] + l0)
                    right.append(other[at:at + OUT_ROWS] + r0)
                    waiting += len(left[-1])
                    if waiting >= OUT_ROWS:
                        yield taken(batch, left, right)
                        left, right, waiting = [], [], 0
            if waiting:
                yield taken(batch, left, right)
    return run


def pairs(line_id, polygon_id, starts=True):
    """The pairs of lines and polygons that meet; without `starts`, of lines that touch."""
    return _pairs(line_id, polygon_id, partial(_compared, starts=starts))


def near_pairs(line_id, point_id, radius):
    """The pairs of lines and points within `radius`."""
    return _pairs(line_id, point_id, _compared_points(radius))


def near_counts(line_id, radius):
    """The number of points of a block within `radius` of each line that is near any."""
    def run(batches):
        for batch in batches:
            lines, counts = [], []
            for met, l0, _ in _compared_points(radius)(batch):
                times = np.count_nonzero(met, axis=0)
                line = np.flatnonzero(times)
                lines.append(line + l0)
                counts.append(times[line])
            if lines:
                ids = _ids(batch, "__l").take(pa.array(np.concatenate(lines)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(counts))], names=[line_id, "times"])
    return run


def first_near(line_id, point_id, radius):
    """The first point of a block within `radius` of each line that is near any."""
    def compared(batch):
        for met, l0, r0 in _compared_points(radius)(batch):
            first = np.zeros_like(met)
            line = np.flatnonzero(met.any(axis=0))
            first[met.argmax(axis=0)[line], line] = True
            yield first, l0, r0
    return _pairs(line_id, point_id, compared)


def _first(met):
    """The lines (columns) that meet anything, and the first row that each meets."""
    line = np.flatnonzero(met.any(axis=0))
    return line, met.argmax(axis=0)[line]


def overlays(line_id, radius, crossing, species):
    """A function over batches of blocks of line pieces (id, start, flat) and of features (kind, no, bit, area, e) in their order.

    It returns a row per piece, kind and word: the smallest number `no` of the crossings within `radius`, or of the other lines that a
    piece touches; of the species areas with the number `word`, the united bits of those that it touches or starts in.
    """
    def met_by(x, y, size, start, kinds, first, ring):
        line, lines = np.arange(len(size)), len(size)
        edges, edge_line = _edges(x, y, size, line)
        for k in np.unique(kinds):
            low, high = np.searchsorted(kinds, [k, k + 1])
            of = slice(first[low], first[high])
            some = [c[of] for c in ring]
            if k == crossing:
                yield k, low, near(np.searchsorted(edge_line, np.arange(lines + 1)), edges, some[0], some[1], radius).T
                continue
            out = np.zeros((high - low, lines), dtype=bool)
            owner = np.repeat(np.arange(high - low), np.diff(first[low:high + 1]))
            with np.errstate(invalid="ignore"):
                if k == species and start.any():
                    at = (np.cumsum(size) - size)[start]
                    _inside(out, x[at], y[at], line[start], owner, some)
                _touch(out, edges, edge_line, some, owner)
            yield k, low, out

    def run(batches):
        for batch in batches:
            l_rows, lines = _list(batch.column("__l"))
            r_rows, features = _list(batch.column("__r"))
            places, flat = _list(lines.field("flat"))
            starts, flat = lines.field("start").to_numpy(zero_copy_only=False), _numbers(flat)
            first, ring = _list(features.field("e"))
            ring = [_numbers(ring.field(c)) for c in ("px", "py", "qx", "qy")]
            kind, no, bit = (features.field(c).to_numpy() for c in ("kind", "no", "bit"))
            found = []
            for row in range(batch.num_rows):
                l0, l1, r0, r1 = l_rows[row], l_rows[row + 1], r_rows[row], r_rows[row + 1]
                place, of = _within(places, l0, l1)
                edge_first, of_ring = _within(first, r0, r1)
                xy, numbers, bits = flat[of], no[r0:r1], bit[r0:r1]
                for k, low, met in met_by(xy[::2], xy[1::2], np.diff(place) // 2, starts[l0:l1].astype(bool), kind[r0:r1], edge_first, [c[of_ring] for c in ring]):
                    numbers_of, bits_of = numbers[low:low + len(met)], bits[low:low + len(met)]
                    if k != species:
                        line, at = _first(met)
                        found.append((line + l0, np.full(len(line), k), np.zeros(len(line), dtype="i8"), numbers_of[at], np.zeros(len(line), dtype="i8")))
                        continue
                    for word in np.unique(numbers_of):
                        same = numbers_of == word
                        united = np.bitwise_or.reduce(np.where(met[same], bits_of[same][:, None], 0), axis=0)
                        line = np.flatnonzero(united)
                        found.append((line + l0, np.full(len(line), k), np.full(len(line), word), np.zeros(len(line), dtype="i8"), united[line]))
            if found:
                line, *columns = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [lines.field("id").take(pa.array(line)), pa.array(columns[0].astype("i4")), *[pa.array(c.astype("i8")) for c in columns[1:]]],
                    names=[line_id, "kind", "word", "no", "bits"])
    return run


def texts(line_id, values, sep=", "):
    """A function over batches of block pairs that returns, for each line and block of polygons that it meets, the block's number
    and the texts of these polygons: name: field of the polygon's id, nulls as NA."""
    def batch_of(ids, rows):
        line, piece, *columns = zip(*rows)
        columns = [pa.array(c, pa.string()) for c in columns]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(line)), pa.array(piece, pa.int64()), *columns], names=[line_id, "__piece", *values])

    def run(batches):
        for batch in batches:
            ids, known, rows, size = _ids(batch, "__l"), _ids(batch, "__r"), [], 0
            names = [known.field(c).cast(pa.string()).fill_null("NA") for c in values.values()]
            blocks = batch.column("__rb").to_pylist()
            for block, (met, l0, r0) in zip(blocks, _compared(batch)):
                listed = [c.slice(r0, met.shape[0]).to_pylist() for c in names]
                line, poly = np.nonzero(met.T)
                firsts = np.flatnonzero(np.diff(line, prepend=-1))
                line, poly = line[firsts].tolist(), poly.tolist()
                for i, a, b in zip(line, firsts.tolist(), [*firsts[1:].tolist(), len(poly)]):
                    some = poly[a:b]
                    rows.append((i + l0, block, *[sep.join([c[k] for k in some]) for c in listed]))
                    size += len(some)
                    if size >= OUT_ROWS:
                        yield batch_of(ids, rows)
                        rows, size = [], 0
            if rows:
                yield batch_of(ids, rows)
    return run
