"""Best-fit packing of documents into sequences of a fixed length, under conflicts."""

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from freshet.llm.common import GAPS

CAPACITY = 2_048     # words in a bin
SHARD_ROWS = 10_000  # pieces packed together on average


def pack_shard(pieces, capacity):
    """Bins of (length, source, cluster) pieces given longest first, as a list of bin numbers.

    Open bins are kept in the order of their residual. A piece goes to the successor of its length, the bin with the
    least room that still holds it; while that bin's source or cluster bitmap has the piece's bit, the search moves on
    to the next larger residual, so the tightest compatible bin is found exactly.
    """
    counts = Counter(c for _, _, c in pieces)
    source_bit, cluster_bit = {}, {}
    order, residual, sources, clusters, out = [], [], [], [], []
    for length, source, cluster in pieces:
        s = 0 if source is None else 1 << source_bit.setdefault(source, len(source_bit))
        c = 1 << cluster_bit.setdefault(cluster, len(cluster_bit)) if cluster is not None and counts[cluster] > 1 else 0
        at = bisect_left(order, (length, -1))
        while at < len(order) and (sources[order[at][1]] & s or clusters[order[at][1]] & c):
            at += 1
        if at < len(order):
            number = order.pop(at)[1]
        else:
            number = len(residual)
            residual.append(capacity)
            sources.append(0)
            clusters.append(0)
        residual[number] -= length
        sources[number] |= s
        clusters[number] |= c
        if residual[number]:
            insort(order, (residual[number], number))
        out.append(number)
    return out


def pieces_of(docs, capacity=CAPACITY, source="source", cluster=None):
    """(doc_id, piece, start, n_words, source, cluster): whole documents, or runs of `capacity` words of longer ones."""
    words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), GAPS), "")).cast("long")
    tag = F.when(F.char_length("text") > 0, F.xxhash64("text")) if cluster is None else F.col(cluster).cast("long")
    place = F.col(source).cast("string") if source in docs.columns else F.lit(None).cast("string")
    df = docs.select("doc_id", place.alias("source"), tag.alias("cluster"), words.alias("__n"))
    last = F.greatest(F.ceil(F.col("__n") / capacity) - 1, F.lit(0))
    df = df.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * capacity
    return df.select("doc_id", "piece", start.alias("start"), F.least(F.col("__n") - start, F.lit(capacity)).alias("n_words"), "source", "cluster")


def pack(docs, capacity=CAPACITY, source="source", cluster=None):
    """Every piece with its bin: doc_id, piece, start, n_words, source, cluster, shard, bin (unique over all shards).

    A bin holds at most `capacity` words, one document of a source and one of a duplicate cluster (by default equal
    texts); a null source or cluster conflicts with nothing. Pieces are dealt out to shards by hash, so a hot source or
    cluster is spread evenly, and each shard is packed longest first, ties by doc_id. Pieces without words need no
    room and get a null bin. Repeated rows are packed each.
    """
    rows = pieces_of(docs, capacity, source, cluster)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(parts, docs.count() // SHARD_ROWS)
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(shards)))

    def solve(table):
        cols = table.to_pydict()
        key = list(zip([-n for n in cols["n_words"]], [(i is not None, i) for i in cols["doc_id"]], cols["piece"],
                       [x or "" for x in cols["source"]], [x or 0 for x in cols["cluster"]], strict=True))
        order = sorted((i for i in range(len(key)) if key[i][0]), key=key.__getitem__)
        found = pack_shard([(cols["n_words"][i], cols["source"][i], cols["cluster"][i]) for i in order], capacity)
        bins = [None] * len(key)
        for i, b in zip(order, found, strict=True):
            bins[i] = (cols["shard"][i] << 32) + b
        return table.append_column("bin", pa.array(bins, pa.int64()))

    kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    return rows.groupBy("shard").applyInArrow(solve, kinds + ", bin bigint")
