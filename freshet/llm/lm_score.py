"""Cross-entropy difference: bigram models of a target and of the whole corpus over one vocabulary score each document."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from freshet.llm.common import (
    BASE, GAPS, LEAST_ID, Words, bucket_count, expand, mix, narrow, pack_texts, runs, spread, squeeze, unpack_text,
)
from freshet.sources.layers import materialise

VOCABULARY = None     # all words; a number keeps as many of the most frequent ones, and all others are one unknown word
ADD = 0.01            # added to each bigram count
START, UNKNOWN = np.uint64(0), np.uint64(1)  # in place of the 64-bit hash of a word
HISTORY = np.uint64(0xD6E8FEB86659FD93)      # tells the key of a word that others follow from keys of pairs
NANO = 1e9            # losses are added up as whole nanonats, so the order of addition cannot matter
BLOCK_BYTES = 7_000_000  # text of the documents of a block and of the pairs of a bucket, on average


def vocabulary(docs, size):
    """The `size` most frequent words of all texts, ties by word.

    The counts are written once. A histogram of their logarithms and one of the counts in the bin that holds the last
    place give the least count of the vocabulary, so only words with that count or more are sent to be ordered.
    """
    words = docs.select(F.explode(F.array_remove(F.split("text", GAPS), "")).alias("word"))
    counts = materialise(words.groupBy("word").agg(F.count("*").alias("n")), "word-counts").withColumn("bin", F.floor(F.log2("n") * 8))

    def last(rows, left):
        """The lowest key among the first `left` words from the top, and how many places it leaves to fill there."""
        rows = sorted(rows, reverse=True)
        for key, number in rows:
            if number >= left:
                return key, left
            left -= number
        return (rows[-1][0] if rows else 0), left

    low, left = last([(r["bin"], r["count"]) for r in counts.groupBy("bin").count().collect()], size)  # 512 bins at most
    # The counts within one bin, an eighth of an octave.
    least, _ = last([(r["n"], r["count"]) for r in counts.where(F.col("bin") == low).groupBy("n").count().collect()], left)
    top = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(size)
    return [r["word"].encode() for r in top.collect()]


def n_words(docs):
    """The number of distinct words of all texts."""
    return docs.select(F.explode(F.array_remove(F.split("text", GAPS), "")).alias("word")).distinct().count()


def gather_blocks(docs, target, groups):
    """Blocks of documents (grp, docs, body), written to the shared folder: docs has the keys in order, the bytes of
    their texts and whether `target` names them, body the texts. Rows of one doc_id share a block.
    """
    import zstandard

    def place(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(spread(b["doc_id"].to_numpy(zero_copy_only=False), groups)), b["doc_id"]], ["grp", "wanted"])

    def gather(left, right):
        keys = left["__id"].to_numpy()
        by = np.argsort(keys, kind="stable")
        bodies = left["__body"].to_pylist()
        texts = [unpack_text(bodies[k]) for k in by]
        hit = np.isin(keys[by], right["wanted"].to_numpy()).astype(np.uint8)
        docs = squeeze(keys[by], np.fromiter(map(len, texts), np.int64, len(texts)), hit)
        return pa.table({"grp": left["__grp"].slice(0, 1), "docs": pa.array([docs], pa.binary()),
                         "body": pa.array([zstandard.ZstdCompressor(3).compress(b"".join(texts))], pa.binary())} if len(by) else
                        {"grp": pa.array([], pa.int64()), "docs": pa.array([], pa.binary()), "body": pa.array([], pa.binary())})

    wanted = target.select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct().mapInArrow(place, "grp long, wanted long")
    packed = pack_texts(docs.select("doc_id", "text"), groups).select("__grp", "__id", "__body")
    blocks = packed.groupBy("__grp").cogroup(wanted.groupBy("grp")).applyInArrow(gather, "grp long, docs binary, body binary")
    return materialise(blocks, "word-blocks")


def _words(docs, body, known):
    """keys, numbers of words, and for each word of a block: whether its document is in the target, the word before, the word.

    Words are their 64-bit hashes; those not among `known` (sorted, None: all are) are the unknown word.
    """
    keys, lens, hit = expand(docs)
    body, ends = unpack_text(body), np.cumsum(lens)
    words = Words([body[b - n:b] for n, b in zip(lens.tolist(), ends.tolist(), strict=True)])
    ids, lens = words.hashes, np.diff(words.first)
    if known is not None:
        ids = np.where(np.isin(ids, known), ids, UNKNOWN)
    before = np.concatenate([ids[:1], ids[:-1]])
    before[(np.cumsum(lens) - lens)[lens > 0]] = START
    return keys, lens, np.repeat(hit.astype(bool), lens), before, ids


def _tally(chosen, before, ids, groups):
    """Distinct keys of a block in order of bucket, their buckets, counts and target counts, and for each word the places
    of its pair and of the word before it. Keys are 64-bit hashes of pairs and of the words that others follow.
    """
    keys = np.concatenate([mix(before * np.uint64(BASE) + ids), mix(before ^ HISTORY)])
    by = np.argsort(keys).astype(np.uint32)
    keys = keys[by]
    starts = runs(keys)[0]
    keys, number = keys[starts], np.empty(len(by), np.uint32)
    number[by] = np.repeat(np.arange(len(starts), dtype=np.uint32), np.diff(np.append(starts, len(by))))
    del by
    n = np.diff(np.append(starts, len(number)))
    t = np.bincount(number[:len(ids)][chosen], minlength=len(keys)) + np.bincount(number[len(ids):][chosen], minlength=len(keys))
    bucket = (keys % np.uint64(groups)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    rank = np.empty(len(by), np.uint32)
    rank[by] = np.arange(len(by), dtype=np.uint32)
    return keys[by], bucket[by], n[by], t[by], rank[number[:len(ids)]], rank[number[len(ids):]]


def cross_entropy_difference(docs, target, size=VOCABULARY, add=ADD):
    """Per document: doc_id, n_tokens, target_loss, background_loss, score (their difference per word; lower is closer
    to the target).

    The target model counts the bigrams of the documents named in `target` (doc_id), the background model those of all
    documents; both smooth alike, P(w|v) = (n(v, w) + add) / (n(v) + add * vocabulary). The vocabulary is every word of
    the texts, or with `size` the most frequent ones; a word is known by its 64-bit hash. Words are separated by
    whitespace; all texts count and are scored whole. A document without words (null or empty text) has null losses.
    Rows without doc_id are never in the target and are told apart by their text; rows that share a doc_id are scored
    together, once. An empty target gives a
    uniform model.

    Each block of documents sends its distinct pairs and words with their counts to buckets, and gets the counts of the
    whole corpus back in the same order, so traffic grows with the text, whatever the number of blocks.
    """
    words = None if size is None else vocabulary(docs, size)
    width = (n_words(docs) if words is None else len(words)) + 2  # the start and the unknown word
    known = docs.sparkSession.sparkContext.broadcast(None if words is None else np.sort(Words(words).hashes))
    groups = bucket_count(docs, BLOCK_BYTES)
    blocks = gather_blocks(docs, target, groups)

    def pack(batches):
        for batch in batches:
            for grp, own, body in zip(*[batch[c].to_pylist() for c in ("grp", "docs", "body")], strict=True):
                keys, bucket, n, t, _, _ = _tally(*_words(own, body, known.value)[2:], groups)
                cuts = list(zip(*runs(bucket), strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(bucket[a]) for a, _ in cuts], pa.int64()), pa.array([grp] * len(cuts), pa.int64()),
                    pa.array([squeeze(keys[a:b], narrow(n[a:b]), narrow(t[a:b])) for a, b in cuts], pa.binary()),
                ], ["bucket", "grp", "counts"])

    def add_up(table):
        parts = [expand(x) for x in table["counts"].to_pylist()]
        _, number = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n, t = (np.bincount(number, weights=np.concatenate([p[k] for p in parts])).astype(np.int64)[number] for k in (1, 2))
        ends = np.cumsum([len(p[0]) for p in parts])
        sums = [squeeze(narrow(n[b - len(p[0]):b]), narrow(t[b - len(p[0]):b])) for p, b in zip(parts, ends, strict=True)]
        return pa.table({"grp": table["grp"], "bucket": table["bucket"], "sums": pa.array(sums, pa.binary())})

    def losses(left, right):
        out = {c: [] for c in ("key", "n", "t", "b")}
        for own, body in zip(left["docs"].to_pylist(), left["body"].to_pylist(), strict=True):
            keys, lens, chosen, before, ids = _words(own, body, known.value)
            pair, history = _tally(chosen, before, ids, groups)[-2:]
            sums = [expand(x) for x in right.sort_by("bucket")["sums"].to_pylist()]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            stops = np.cumsum(lens)[np.append(first[1:], len(keys)) - 1]
            out["key"].append(keys[first])
            out["n"].append(np.diff(stops, prepend=0))
            for name, part in (("b", 0), ("t", 1)):
                n = np.concatenate([np.empty(0, np.int64), *[x[part].astype(np.int64) for x in sums]])
                loss = np.round(-NANO * np.log((n[pair] + add) / (n[history] + add * width))).astype(np.int64)
                out[name].append(np.diff(np.concatenate([[0], np.cumsum(loss)])[stops], prepend=0))
        return pa.table({c: pa.array(np.concatenate(x) if x else [], pa.int64()) for c, x in out.items()})

    counts = blocks.mapInArrow(pack, "bucket long, grp long, counts binary").groupBy("bucket").applyInArrow(add_up, "grp long, bucket long, sums binary")
    scored = blocks.groupBy("grp").cogroup(counts.groupBy("grp")).applyInArrow(losses, "key long, n long, t long, b long")
    per = lambda x: x / F.lit(NANO) / F.nullif(F.col("n"), F.lit(0))
    return scored.select(F.when(F.col("key") >= LEAST_ID, F.col("key")).alias("doc_id"), F.col("n").alias("n_tokens"), per(F.col("t")).alias("target_loss"),
                         per(F.col("b")).alias("background_loss"), per(F.col("t") - F.col("b")).alias("score"))
