"""Shared parts of the document operators: batches, word hashes, packed exchanges, connected components."""

import numpy as np
import xxhash
import zstandard
from pyspark.sql import functions as F

from freshet.sources.layers import materialise

GAPS = "[\\x20\\x09-\\x0D]+"  # between words, as a Java pattern
BATCH_BYTES = 4_000_000   # text gathered in a task before it is hashed together
BUCKET_BYTES = 4_000_000  # text whose hashes meet in one bucket, on average
CHUNK = 1 << 17           # bytes hashed at once, a few MB of arrays a worker; only a longer word makes it longer
NULL_ID = -(1 << 63)      # a null doc_id sorts first and is written back as null
LEAST_ID = -(1 << 62)     # ids are not smaller; the keys below stand for rows without id, each text with its own


def read_documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_bytes(docs):
    """UTF-8 bytes of all texts: sizes the exchanges, so that buckets stay small whatever the input."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def bucket_count(docs, per=BUCKET_BYTES):
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * parts, text_bytes(docs) // per)


def null_key(text):
    """The key of a row without id: below all ids, and by its text, so that different texts stay different documents."""
    return NULL_ID + (xxhash.xxh64_intdigest(text, 42) >> 2)


def row_key():
    """doc_id, or the same key for rows without one, as a column."""
    by_text = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 2) + F.lit(NULL_ID)
    return F.coalesce(F.col("doc_id").cast("long"), by_text)


def slices(batches, rows=256):
    """Parts of record batches, so that only few rows are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def doc_batches(batches, limit=BATCH_BYTES):
    """Lists of doc ids (null: null_key) and texts as bytes (null: empty) of about `limit` bytes."""
    ids, texts, size = [], [], 0
    for part in slices(batches):
        for i, x in zip(part["doc_id"].to_pylist(), part["text"].cast("binary").to_pylist(), strict=True):
            texts.append(x or b"")
            ids.append(null_key(texts[-1]) if i is None else i)
            size += len(texts[-1])
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def id_of(key):
    return None if key < LEAST_ID else int(key)


# --- hashes ---------------------------------------------------------------------------------------------------

def mix(x):
    """Finalizer that spreads every input bit over 64 bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base, n):
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


BASE, BASE2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE2))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_power_cache = {}


def power_pair(base, n):
    """Powers of an odd base and of its inverse modulo 2**64, kept per worker for the usual lengths."""
    size = max(n, CHUNK + 1)
    if base not in _power_cache or len(_power_cache[base][0]) < size:
        pair = powers(base, size), powers(pow(base, -1, 1 << 64), size)
        if size > CHUNK + 1:
            return pair
        _power_cache[base] = pair
    return _power_cache[base]


def rolling(values, k, base=BASE):
    """Rabin-Karp hash of each run of k values: sum of values[i + j] * base**j modulo 2**64, by prefix sums."""
    n = len(values) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.empty(n, np.uint64)
    for at in range(0, n, CHUNK // 2):
        part = values[at:min(n, at + CHUNK // 2) + k - 1]
        up, down = power_pair(base, len(part) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[: len(part)], dtype=np.uint64)])
        m = len(part) - k + 1
        out[at:at + m] = (sums[k:] - sums[:m]) * down[:m]
    return out


class Words:
    """Words of many texts: byte offsets in one buffer, a 64-bit hash of each, and the first word of each text."""

    def __init__(self, texts, lower=False):
        buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if lower:
            buf = _LOWER[buf]
        self.buf = buf
        gap = np.concatenate([[True], SPACE[buf]]).view(np.int8)
        edge = np.diff(gap)
        self.starts, self.ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.concatenate([[0], np.cumsum(lens + 1)])
        self.first = np.searchsorted(self.starts, begins)  # of each text, and the number of all words
        self.hashes = self._hash()

    def _hash(self):
        out, s, e = np.empty(len(self.starts), np.uint64), self.starts, self.ends
        at = 0
        while at < len(s):
            to = max(at + 1, int(np.searchsorted(e, s[at] + CHUNK, "right")))
            low, high = s[at], e[to - 1]
            up, down = power_pair(BASE, high - low + 1)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[self.buf[low:high]] * up[: high - low], dtype=np.uint64)])
            out[at:to] = (sums[e[at:to] - low] - sums[s[at:to] - low]) * down[s[at:to] - low]
            at = to
        return mix(out)

    def text_of_word(self):
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def room(self):
        """Words from each word to the end of its text."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.starts))


# --- packed arrays --------------------------------------------------------------------------------------------

_KINDS = {np.dtype(t).num: np.dtype(t) for t in "bBhHiIlqLQfd"}


def squeeze(*arrays):
    """Integer arrays as one compressed value."""
    parts = [np.ascontiguousarray(a) for a in arrays]
    head = np.array([len(parts), *[x for a in parts for x in (a.dtype.num, len(a))]], np.int64)
    return zstandard.ZstdCompressor(1).compress(head.tobytes() + b"".join(a.tobytes() for a in parts))


def expand(blob):
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    out, at = [], 8 + 16 * n
    for kind, size in np.frombuffer(raw, np.int64, 2 * n, 8).reshape(n, 2).tolist():
        kind = _KINDS[kind]
        out.append(np.frombuffer(raw, kind, size, at))
        at += size * kind.itemsize
    return out


def pack_places(keys, places):
    """(key, place) pairs sorted by both: distinct keys, their counts and the places as differences."""
    if not len(keys):
        return squeeze(np.empty(0, np.int64), np.empty(0, np.uint8), np.empty(0, np.uint8))
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    step = np.diff(places, prepend=0)
    step[new] = places[new]
    own, counts = keys[new], np.diff(np.append(np.flatnonzero(new), len(keys)))
    with np.errstate(over="ignore"):
        return squeeze(np.diff(own, prepend=0).astype(np.int64), narrow(counts), narrow(step))


def narrow(counts):
    """Counts in the smallest unsigned type that holds them."""
    top = int(counts.max(initial=0))
    return counts.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))


def unpack_places(blob):
    keys, counts, step = expand(blob)
    with np.errstate(over="ignore"):
        keys = np.cumsum(keys)
    total = np.cumsum(step.astype(np.int64))
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64) if len(counts) else np.empty(0, np.int64)
    base = total[begins] - step[begins] if len(begins) else total
    return np.repeat(keys, counts), total - np.repeat(base, counts)


def runs(values):
    """First index and end of each run of equal neighbours."""
    begins = np.flatnonzero(np.concatenate([[len(values) > 0], values[1:] != values[:-1]]))
    return begins, np.append(begins[1:], len(values))[: len(begins)]


def spread(keys, n):
    """Bucket of each doc id."""
    return (mix(keys.astype(np.int64).view(np.uint64)) % np.uint64(n)).astype(np.int64)


def bucket_rows(bucket, hashes, keys, places, settled):
    """Places of hashes as one row per bucket (bucket, hashes, places, settled); places already settled ride on the first."""
    import pyarrow as pa

    by = np.lexsort((places, keys, bucket))
    rows = [(int(bucket[by[a]]), by[a:b]) for a, b in zip(*runs(bucket[by]), strict=True)]
    extra = pack_places(*settled)
    return pa.RecordBatch.from_arrays([
        pa.array([b for b, _ in rows], pa.int64()),
        pa.array([hashes[x].tobytes() for _, x in rows], pa.binary()),
        pa.array([pack_places(keys[x], places[x]) for _, x in rows], pa.binary()),
        pa.array([extra if i == 0 else None for i in range(len(rows))], pa.binary()),
    ], ["bucket", "hashes", "places", "settled"])


BUCKET_SCHEMA = "bucket long, hashes binary, places binary, settled binary"


def read_bucket(table):
    """Hashes, keys and places of a bucket, and the settled keys and places that came with it."""
    hashes = np.concatenate([np.empty(0, np.uint64), *[np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]])
    return hashes, *join_places(table["places"]), *join_places(table["settled"])


def join_places(column):
    pairs = [unpack_places(x) for x in column.to_pylist() if x is not None]
    return tuple(np.concatenate([np.empty(0, np.int64), *[p[i] for p in pairs]]) for i in (0, 1))


def group_rows(keys, places, groups):
    """Places as one row per group of documents (grp, places)."""
    import pyarrow as pa

    group = spread(keys, groups)
    by = np.lexsort((places, keys, group))
    cuts = list(zip(*runs(group[by]), strict=True))
    return pa.table({"grp": pa.array([int(group[by[a]]) for a, _ in cuts], pa.int64()),
                     "places": pa.array([pack_places(keys[by[a:b]], places[by[a:b]]) for a, b in cuts], pa.binary())})


def covered(starts, width, n):
    """Positions below n covered by runs of `width` from each start."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts[starts < n], 1)
    np.add.at(edge, np.minimum(starts[starts < n] + width, n), -1)
    return np.cumsum(edge[:-1]) > 0


def pack_texts(docs, groups):
    """Documents as (__grp, __id, __body, own columns without text): compressed texts, dealt out by doc id so that
    places found for them can join. A null text is packed as null."""
    import pyarrow as pa
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    names = [f"__c{i}" for i in range(len(docs.columns))]
    at_id, at_text = docs.columns.index("doc_id"), docs.columns.index("text")
    rest = [i for i in range(len(names)) if i != at_text]

    def pack(batches):
        press = zstandard.ZstdCompressor(3)
        for batch in slices(batches, 2_048):
            ids = batch.column(at_id).cast(pa.int64())
            texts = batch.column(at_text).cast("binary").to_pylist()
            if ids.null_count:
                ids = pa.array([null_key(x or b"") if i is None else i for i, x in zip(ids.to_pylist(), texts, strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(spread(ids.to_numpy(zero_copy_only=False), groups)), ids,
                 pa.array([None if x is None else press.compress(x) for x in texts], pa.binary()),
                 *[batch.column(i) for i in rest]],
                ["__grp", "__id", "__body", *[names[i] for i in rest]])

    own = [StructField(names[i], docs.schema[i].dataType) for i in rest]
    schema = StructType([StructField("__grp", LongType()), StructField("__id", LongType()), StructField("__body", BinaryType()), *own])
    return docs.toDF(*names).mapInArrow(pack, schema)


def unpack_text(body):
    return b"" if body is None else zstandard.ZstdDecompressor().decompress(body)


# --- components -----------------------------------------------------------------------------------------------

def components(edges):
    """Smallest member reachable from each node of an edge table (a, b), as (node, component).

    Alternating large-star and small-star rounds, each written to the shared folder, until the edges stay the same.
    A node's neighbours are only ever reduced to a minimum before the shuffle, so no task holds them.
    """
    def both(e):
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e, large):
        pairs = both(e) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        moved = pairs.join(low, "a")
        if large:
            return moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        tops = moved.select(F.col("b").alias("a"), F.col("low").alias("b"))
        return tops.unionByName(low.select("a", F.col("low").alias("b"))).where("a != b").distinct()

    current, mark = materialise(edges.where("a != b").select("a", "b").distinct(), "edges"), None
    while True:
        current = materialise(star(star(current, True), False), "edges")
        now = tuple(current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
        if now == mark:
            break
        mark = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
