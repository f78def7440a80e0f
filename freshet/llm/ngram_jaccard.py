"""N-gram Jaccard join: a blocked sparse matrix product of documents by word n-grams.

Documents with equal n-gram sets are one class. Only the rarest n-grams of a class, as many as any partner must share
one of, are joined to find the blocks that can hold links; n-grams that no other document holds drop out before. Each block multiplies tiles of the incidence matrix, adds up
overlaps column block by column block and drops pairs that can no longer reach the bound of their sizes: first over
those rarest n-grams alone, then over the whole sets of the classes that still have a partner.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from freshet.llm.common import (
    BUCKET_BYTES, BUCKET_SCHEMA, LEAST_ID, Words, bucket_count, bucket_rows, components, doc_batches, expand, group_rows,
    join_places, mix, narrow, pack_places, pack_texts, read_bucket, rolling, row_key, runs, slices, squeeze,
    unpack_text,
)
from freshet.sources.layers import materialise

SKETCH_BITS = 20          # cells of the frequency sketch: its size, 1 MB, does not depend on the data
SKETCH_PARTS = 64
TILE_GRAMS, TILE_DOCS = 200_000, 512
BATCH = 2_000_000         # bytes of text whose n-grams are in memory at once
PART = 500_000            # the same where nothing is packed by batch
COLUMNS = 2_048           # columns of the incidence matrix multiplied at once


def gram_sets(texts, width):
    """Distinct hashes of the word n-grams of each text, sorted; a shorter text counts as one n-gram."""
    words = Words(texts, lower=True)
    grams, first = rolling(words.hashes, width), words.first
    for a, b in zip(first[:-1], first[1:], strict=True):
        n = b - a
        if n >= width:
            yield np.unique(grams[a:b - width + 1])
        elif n:
            yield rolling(words.hashes[a:b], int(n)) ^ mix(np.array([n]))
        else:
            yield np.empty(0, np.uint64)


def packed_sets(bodies, width, limit=PART):
    """gram_sets of packed texts, of which about `limit` bytes are unpacked at a time."""
    texts, size = [], 0
    for body in bodies:
        texts.append(unpack_text(body.as_py()))
        size += len(texts[-1])
        if size >= limit:
            yield from gram_sets(texts, width)
            texts, size = [], 0
    if texts:
        yield from gram_sets(texts, width)


def least_overlap(percent, n):
    """Smallest overlap with any partner: intersection >= percent/100 * union >= percent/100 * n."""
    return (percent * n + 99) // 100


def frequency_sketch(docs, width):
    """Counts of all n-grams in 2**SKETCH_BITS cells, added up in two steps, as eighths of their binary logarithm.

    The sketch only orders the n-grams by rarity: what shares a cell moves back in the order, no link is lost.
    """
    cells = 1 << SKETCH_BITS
    size = cells // SKETCH_PARTS

    def count(batches):
        from pyspark import TaskContext

        total = np.zeros(cells, np.int64)
        for _, texts in doc_batches(batches, PART):
            grams = np.concatenate([np.empty(0, np.uint64), *gram_sets(texts, width)])
            cell, times = np.unique((grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), return_counts=True)
            total[cell] += times
        task = TaskContext.get().partitionId() % 128
        yield pa.RecordBatch.from_arrays([
            pa.array([task] * SKETCH_PARTS, pa.int64()), pa.array(range(SKETCH_PARTS), pa.int64()),
            pa.array([squeeze(x) for x in narrow(total).reshape(SKETCH_PARTS, size)], pa.binary())], ["task", "part", "cells"])

    def add(table):
        total = sum(expand(x)[0].astype(np.int64) for x in table["cells"].to_pylist())
        return pa.table({"task": table["task"][:1], "part": table["part"][:1], "cells": pa.array([squeeze(narrow(total))], pa.binary())})

    schema = "task long, part long, cells binary"
    sums = docs.select("doc_id", "text").mapInArrow(count, schema).groupBy("task", "part").applyInArrow(add, schema)
    rows = sums.groupBy("part").applyInArrow(add, schema).collect()  # SKETCH_PARTS rows
    out = np.zeros((SKETCH_PARTS, size), np.uint8)
    for r in rows:
        out[r["part"]] = np.round(8 * np.log2(1 + expand(r["cells"])[0])).clip(0, 255)
    return out.ravel()


def _indexed(percent):
    """Hashes below this bound are counted exactly: a share that holds more n-grams than a prefix needs."""
    return np.uint64(min(1.0, 2.5 * (100 - percent) / 100 + 0.05) * ((1 << 64) - 2048))


def repeated_grams(docs, width, percent, buckets, groups):
    """Which of the counted n-grams (by their number in the sorted set) another document holds too, as (grp, places).

    An n-gram that several documents of a batch hold is settled there and sent on once, whatever its frequency.
    """
    limit = _indexed(percent)

    def count(batches):
        for ids, texts in doc_batches(batches, BATCH):
            sets = [x[: np.searchsorted(x, limit)] for x in gram_sets(texts, width)]
            lens = np.fromiter(map(len, sets), np.int64, len(sets))
            grams, doc = np.concatenate([np.empty(0, np.uint64), *sets]), np.repeat(np.array(ids, np.int64), lens)
            if not len(grams):
                continue
            place = np.concatenate([np.arange(n) for n in lens])
            by = np.argsort(grams, kind="stable")
            a, b = runs(grams[by])
            many = by[np.repeat(b - a > 1, b - a)]
            own = by[a]
            bucket = (mix(grams[own]) % np.uint64(buckets)).astype(np.int64)
            yield bucket_rows(bucket, grams[own], doc[own], place[own], tuple(x[many[np.lexsort((place[many], doc[many]))]] for x in (doc, place)))

    def meet(table):
        grams, doc, place, settled_doc, settled_place = read_bucket(table)
        by = np.argsort(grams, kind="stable")
        a, b = runs(grams[by])
        many = by[np.repeat(b - a > 1, b - a)]
        return group_rows(np.append(doc[many], settled_doc), np.append(place[many], settled_place), groups)

    packed = docs.select("doc_id", "text").mapInArrow(count, BUCKET_SCHEMA)
    return packed.groupBy("bucket").applyInArrow(meet, "grp long, places binary")


def signatures(docs, width, percent):
    """(doc_id, n, cls, prefix), written to the shared folder: set size, digest of the set (null if empty), and those
    n-grams of its prefix that another document may hold.

    All documents order their n-grams alike: counted ones that no other document holds, counted ones that repeat
    (by the sketch, rare first), then the rest, each by hash. The prefix is as long as any partner must share one of.
    """
    groups = bucket_count(docs)
    sketch = docs.sparkSession.sparkContext.broadcast(frequency_sketch(docs, width))
    limit = _indexed(percent)
    repeats = repeated_grams(docs, width, percent, groups, groups)

    def sign(left, right):
        doc, place = join_places(right["places"])
        by = np.lexsort((place, doc))
        doc, place = doc[by], place[by]
        ids = left["__id"].to_pylist()
        sizes, digests, rare = [], [], []
        for i, grams in zip(ids, packed_sets(left["__body"], width), strict=True):
            n = len(grams)
            counted = int(np.searchsorted(grams, limit))
            again = np.zeros(n, bool)
            found = place[np.searchsorted(doc, i, "left"):np.searchsorted(doc, i, "right")]
            again[found[found < counted]] = True
            keep = (n - least_overlap(percent, n) + 1 if n else 0) - (counted - int(again.sum()))
            level = sketch.value[(grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int64)
            level[counted:] = 256
            order = np.lexsort((grams, level))
            order = order[again[order] | (order >= counted)]
            sizes.append(n)
            digests.append(xxhash.xxh3_128_digest(grams.tobytes()) if n else None)
            rare.append(grams[order[:max(0, keep)]].tobytes())
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n": pa.array(sizes, pa.int64()),
                         "cls": pa.array(digests, pa.binary()), "prefix": pa.array(rare, pa.binary())})

    out = pack_texts(docs.select("doc_id", "text"), groups).groupBy("__grp").cogroup(repeats.groupBy("grp")).applyInArrow(
        sign, "doc_id long, n long, cls binary, prefix binary")
    return materialise(out, "signatures")


def _blocks(classes):
    """(pivot, doc, n): for each n-gram that several classes hold in their prefix, its holders and their smallest doc.

    Two classes that share such an n-gram are in a block together; blocks with the same pivot are one.
    """
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = classes.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0
    buckets = max(2 * parts, total // BUCKET_BYTES)

    def pack(batches):
        for batch in batches:
            doc, n = (batch[c].to_numpy(zero_copy_only=False) for c in ("doc_id", "n"))
            grams = [np.frombuffer(x, np.uint64) for x in batch["prefix"].to_pylist()]
            lens = np.fromiter(map(len, grams), np.int64, len(grams))
            grams = np.concatenate([np.empty(0, np.uint64), *grams])
            doc, n = np.repeat(doc, lens), np.repeat(n, lens)
            bucket = (mix(grams) % np.uint64(buckets)).astype(np.int64)
            by = np.lexsort((doc, bucket))
            pairs = list(zip(*runs(bucket[by]), strict=True))
            yield pa.RecordBatch.from_arrays([
                pa.array([int(bucket[by[a]]) for a, _ in pairs], pa.int64()),
                pa.array([grams[by[a:b]].tobytes() for a, b in pairs], pa.binary()),
                pa.array([pack_places(doc[by[a:b]], n[by[a:b]]) for a, b in pairs], pa.binary())], ["bucket", "grams", "holders"])

    def meet(table):
        grams = np.concatenate([np.frombuffer(x, np.uint64) for x in table["grams"].to_pylist()])
        doc, n = join_places(table["holders"])
        by = np.lexsort((doc, grams))
        a, b = runs(grams[by])
        pivot = np.repeat(doc[by[a]], b - a)
        many = np.repeat(doc[by[a]] != doc[by[b - 1]], b - a)
        rows = np.unique(np.stack([pivot[many], doc[by][many], n[by][many]], 1), axis=0)
        return pa.table({"pivot": rows[:, 0], "doc": rows[:, 1], "n": rows[:, 2]})

    packed = classes.select("doc_id", "n", "prefix").mapInArrow(pack, "bucket long, grams binary, holders binary")
    return packed.groupBy("bucket").applyInArrow(meet, "pivot long, doc long, n long").distinct()


def _cells(blocks, percent):
    """(cell, side, doc, pivot): pairs of tiles whose sizes allow links; side 0 meets side 1, side 2 meets itself.

    Classes of a block are told apart by size, so that a link joins the same or neighbouring sizes, and dealt out
    over tiles of bounded size by hash. A block of any size thus becomes many tasks of bounded memory.
    """
    step = math.log(100 / percent) + 1e-6 if percent < 100 else 1.0
    sized = blocks.withColumn("c", F.floor(F.log(F.col("n").cast("double")) / step))
    tiles = sized.groupBy("pivot", "c").agg(
        F.greatest(F.ceil(F.sum("n") / TILE_GRAMS), F.ceil(F.count("*") / TILE_DOCS)).cast("int").alias("tiles"))
    above = tiles.select("pivot", (F.col("c") - 1).alias("c"), F.col("tiles").alias("above"))
    below = tiles.select("pivot", (F.col("c") + 1).alias("c"), F.col("tiles").alias("below"))
    tiles = tiles.join(above, ["pivot", "c"], "left").join(below, ["pivot", "c"], "left")
    placed = sized.join(tiles, ["pivot", "c"]).withColumn("t", F.pmod(F.xxhash64("doc"), F.col("tiles")).cast("int"))

    def meets(count, low, high, first, second, side):
        cell = lambda j: F.struct(
            F.xxhash64("pivot", low, high, first(j), second(j)).alias("cell"), side(j).cast("int").alias("side"))
        some = F.transform(F.sequence(F.lit(0), F.coalesce(count, F.lit(1)) - 1), cell)
        return F.when(count.isNull(), F.slice(some, 1, 0)).otherwise(some)

    c, t = F.col("c"), F.col("t")
    rows = F.concat(
        meets(F.col("tiles"), c, c, lambda j: F.least(t, j), lambda j: F.greatest(t, j),
              lambda j: F.when(t == j, 2).when(t < j, 0).otherwise(1)),
        meets(F.col("above"), c, c + 1, lambda j: t, lambda j: j, lambda j: F.lit(0)),
        meets(F.col("below"), c - 1, c, lambda j: j, lambda j: t, lambda j: F.lit(1)))
    rows = placed.select("doc", "pivot", F.inline(rows)).distinct()
    open_cells = rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("side").alias("lo"), F.max("side").alias("hi"))
    open_cells = open_cells.where(((F.col("lo") == 2) & (F.col("n") > 1)) | (F.col("lo") != F.col("hi"))).select("cell")
    return rows.join(open_cells, "cell")


def link_bound(percent, a, b):
    """Overlap at which sets of sizes a and b reach the similarity."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_bound(percent, a, b):
    """Overlap of the prefixes without which sets of sizes a and b cannot link.

    Past the prefix that ends first in the common order, at most the rest of its set can still be shared.
    """
    return np.maximum(1, link_bound(percent, a, b) - np.maximum(least_overlap(percent, a), least_overlap(percent, b)) + 1)


def overlaps(left, right, need):
    """Index pairs (i, j) of two lists of sets whose overlap reaches need[i, j]: a product of tiles, added up by columns."""
    n = [np.fromiter(map(len, x), np.int64, len(x)) for x in (left, right)]
    values = [np.concatenate(x) for x in (left, right)]
    rows = [np.repeat(np.arange(len(x)), k) for x, k in zip((left, right), n, strict=True)]
    shared = np.intersect1d(np.unique(values[0]), np.unique(values[1]), assume_unique=True)
    at, own, rest = [], [], []
    for v, r, k in zip(values, rows, n, strict=True):
        col = np.searchsorted(shared, v)
        col[col == len(shared)] = 0
        hit = shared[col] == v if len(shared) else np.zeros(len(v), bool)
        by = np.argsort(col[hit], kind="stable")
        at.append(col[hit][by])
        own.append(r[hit][by])
        rest.append(np.bincount(r[hit], minlength=len(k)))
    total = np.zeros(need.shape, np.float32)
    for low in range(0, len(shared), COLUMNS):
        if not (total + np.minimum(rest[0][:, None], rest[1][None, :]) >= need).any():
            break
        dense = []
        for side in (0, 1):
            a, b = np.searchsorted(at[side], [low, low + COLUMNS])
            part = np.zeros((len(n[side]), COLUMNS), np.float32)
            part[own[side][a:b], at[side][a:b] - low] = 1
            rest[side] = rest[side] - np.bincount(own[side][a:b], minlength=len(n[side]))
            dense.append(part)
        total += dense[0] @ dense[1].T
    return np.nonzero(total >= need)


def _forest(i, j, n):
    """Numbers of the pairs that connect what the pairs before them did not."""
    root, out = list(range(n)), []

    def top(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        a, b = top(a), top(b)
        if a != b:
            root[b] = a
            out.append(k)
    return np.array(out, np.int64)


def _by_cell(percent, bound, names, forest=False):
    """Python side of a round over cells: rows (cell, side, doc, pivot, n, grams), sorted by cell, to what `names` asks for.

    ("cell", "side", "doc", "pivot"): the members that have a partner; ("a", "b"): the pairs, or a spanning forest of
    them. ("a", "b", "others"): a forest (others null), and per member a the documents of the classes it links to (b
    null). Rows then also have `copies`, the documents of their class, and `pivots`, all pivots under which the member
    has a partner: a pair belongs to the cell of the smallest pivot that its members share, and is counted there only.
    """
    counted = names == ("a", "b", "others")
    columns = ["cell", "side", "doc", "pivot", "n", "grams", *(["copies", "pivots"] if counted else [])]

    def own_pairs(rows, left, right, i, j):
        """Which of the pairs have no smaller pivot in common."""
        lists = [np.array(r[6], np.int64) for r in rows]
        lower = [x[x < r[2]] for x, r in zip(lists, rows, strict=True)]
        again = np.zeros((len(left), len(right)), bool)
        again[overlaps([lower[x] for x in left], [lower[x] for x in right], np.ones(again.shape, np.int64))] = True
        return ~again[i, j]

    def solve(cell, rows):
        side, doc, n = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 3))
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        if not len(left) or not len(right):
            return
        i, j = overlaps([rows[x][4] for x in left], [rows[x][4] for x in right], bound(percent, n[left][:, None], n[right][None, :]))
        if counted and len(i):
            own = own_pairs(rows, left, right, i, j)
            i, j = i[own], j[own]
        i, j = left[i], right[j]
        i, j = i[doc[i] != doc[j]], j[doc[i] != doc[j]]
        if counted:
            copies = np.array([r[5] for r in rows], np.int64)
            _, once = np.unique(np.stack([np.minimum(doc[i], doc[j]), np.maximum(doc[i], doc[j])], 1), axis=0, return_index=True)
            i, j = i[once], j[once]
            ends, at = np.unique(np.concatenate([doc[i], doc[j]]), return_inverse=True)
            others = np.zeros(len(ends), np.int64)
            np.add.at(others, at, np.concatenate([copies[j], copies[i]]))
            keep = _forest(i, j, len(rows))
            a, b = np.minimum(doc[i], doc[j])[keep], np.maximum(doc[i], doc[j])[keep]
            yield a, b, pa.nulls(len(a), pa.int64())
            yield ends, pa.nulls(len(ends), pa.int64()), others
        elif names == ("a", "b"):
            if forest:
                i, j = i[(keep := _forest(i, j, len(rows)))], j[keep]
            yield np.minimum(doc[i], doc[j]), np.maximum(doc[i], doc[j])
        else:
            some = np.unique(np.concatenate([i, j]))
            yield np.full(len(some), cell), side[some], doc[some], np.array([rows[x][2] for x in some], np.int64)

    def run(batches):
        now, rows = None, []
        for batch in slices(batches):
            for cell, side, doc, pivot, n, grams, *more in zip(*[batch[c].to_pylist() for c in columns], strict=True):
                if cell != now:
                    for out in solve(now, rows):
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names)
                    now, rows = cell, []
                rows.append((side, doc, pivot, n, np.frombuffer(grams, np.uint64), *more))
        for out in solve(now, rows):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names)

    return run


def _sets(docs, wanted, width):
    """(doc, n, grams) of the wanted documents, their texts read again.

    The join comes before Python, so that a stage in which the wanted ids are broadcast runs one worker a task.
    """
    def run(batches):
        for ids, texts in doc_batches(batches, PART):
            sets = list(gram_sets(texts, width))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(list(map(len, sets)), pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())],
                ["doc", "n", "grams"])

    keyed = docs.select(row_key().alias("doc_id"), "text")
    bodies = keyed.join(wanted.select(F.col("doc").alias("doc_id")), "doc_id", "left_semi")
    return bodies.mapInArrow(run, "doc long, n long, grams binary")


def _copies(signed):
    """(cls, class_id, copies): of each class the smallest document and the number of its documents."""
    once = signed.where("cls is not null").select("cls", "doc_id").distinct()
    return once.groupBy("cls").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"))


def jaccard_links(docs, width=3, percent=90, signed=None, forest=False, counted=False):
    """Links (a, b), a < b, between the smallest documents of different classes.

    With `forest`, each pair of tiles returns only as many links as connect what it links, at most its documents. With
    `counted`, rows (a, b, others): such forests, and with b null shares of the number of documents that a links to
    outside its class; every link is in one share of each of its ends.
    """
    signed = signatures(docs, width, percent) if signed is None else signed
    classes = signed.where("cls is not null").groupBy("cls").agg(F.min(F.struct("doc_id", "n", "prefix")).alias("r")).select("r.*")
    cells = _cells(materialise(_blocks(classes), "blocks"), percent)

    def round_of(members, sets, bound, names, kinds, forest=False):
        rows = members.join(sets, "doc").repartition(F.col("cell")).sortWithinPartitions("cell")
        more = ["copies", "pivots"] if "others" in names else []
        return rows.select("cell", "side", "doc", "pivot", "n", "grams", *more).mapInArrow(_by_cell(percent, bound, names, forest), kinds)

    rare = classes.select(F.col("doc_id").alias("doc"), "n", F.col("prefix").alias("grams"))
    partners = round_of(cells, rare, prefix_bound, ("cell", "side", "doc", "pivot"), "cell long, side long, doc long, pivot long")
    partners = materialise(partners, "partners")
    whole = _sets(docs, partners.select("doc").distinct(), width)
    if not counted:
        return round_of(partners, whole, link_bound, ("a", "b"), "a long, b long", forest).distinct()
    size = _copies(signed).groupBy(F.col("class_id").alias("doc")).agg(F.sum("copies").alias("copies"))
    about = partners.groupBy("doc").agg(F.collect_set("pivot").alias("pivots")).join(size, "doc")
    return round_of(partners, whole.join(about, "doc"), link_bound, ("a", "b", "others"), "a long, b long, others long")


def _joined(docs, width, percent, counted):
    """jaccard_join with the keys of rows in place of their ids."""
    signed = signatures(docs, width, percent)
    classes = _copies(signed)
    if counted:
        links = materialise(jaccard_links(docs, width, percent, signed, counted=True), "links")
        found = components(links.where("b is not null"))
        degree = links.where("b is null").groupBy(F.col("a").alias("class_id")).agg(F.sum("others").alias("others"))
        classes = classes.join(degree, "class_id", "left")
        classes = classes.withColumn("n_links", F.col("copies") - 1 + F.coalesce("others", F.lit(0)))
    else:
        found = components(jaccard_links(docs, width, percent, signed, forest=True))
    facts = classes.join(found, F.col("class_id") == F.col("node"), "left").withColumn("component_id", F.coalesce("component", "class_id"))
    links = ["n_links"] if counted else []
    out = signed.join(facts.select("cls", "class_id", "component_id", *links), "cls", "left")
    return out.select("doc_id", "n", *[F.coalesce(c, "doc_id").alias(c) for c in ("component_id", "class_id")],
                      *[F.coalesce(c, F.lit(0)).alias(c) for c in links])


def jaccard_join(docs, width=3, percent=90, counted=True):
    """Per document: doc_id, n_shingles, component_id, class_id, n_links.

    Texts are lower-cased (A-Z); a document's set holds its distinct `width`-word n-grams, or its whole word sequence
    if that is shorter. Two documents link if 100 * intersection >= percent * union. class_id is the smallest document
    with the same set, component_id the smallest reachable by links, n_links the number of other documents linked to
    (left out without `counted`). Documents without words (null or empty texts) have size 0, no links and stand alone.
    Rows without doc_id come first, each text a document of its own, and are written with null ids; repeated rows each get
    the result of their doc_id, and rows that share a doc_id count as one document.
    """
    out = _joined(docs, width, percent, counted)
    real = lambda c: F.when(F.col(c) >= LEAST_ID, F.col(c)).alias(c)
    return out.select(real("doc_id"), F.col("n").alias("n_shingles"), real("component_id"), real("class_id"), *(["n_links"] if counted else []))


def keep_one(docs, width=5, percent=80):
    """The documents without near copies: of each component the one with the smallest doc_id stays, with its columns.

    Of rows with one doc_id and text one stays; rows without doc_id are known by their text, and of those that share a
    doc_id every text stays if the id does.
    """
    kept = _joined(docs, width, percent, False).where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    keyed = docs.withColumns({"__key": row_key(), "__text": F.xxhash64("text")})
    return keyed.join(kept, F.col("__key") == F.col("__kept"), "left_semi").dropDuplicates(["__key", "__text"]).drop("__key", "__text")
