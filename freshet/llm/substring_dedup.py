"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark."""

import numpy as np
from pyspark.sql import functions as F

from freshet.llm.common import (
    BASE2, BUCKET_SCHEMA, GAPS, Words, bucket_count, bucket_rows, covered, doc_batches, group_rows, join_places, mix,
    pack_texts, read_bucket, rolling, runs, unpack_text,
)

WIDTH = 20
BATCH = 2_500_000  # text whose windows are hashed together


def _windows(width, buckets):
    """Map side: the first place of each distinct window of a batch, packed by bucket of its hash.

    A window that also starts earlier in the batch is settled here and travels as a bare place, so a passage that
    every document holds crosses the network once a batch.
    """

    def run(batches):
        for ids, texts in doc_batches(batches, BATCH):
            order = np.argsort(np.array(ids, np.int64), kind="stable")
            ids, texts = np.array(ids, np.int64)[order], [texts[i] for i in order]
            words = Words(texts)
            ok = np.flatnonzero(words.room() >= width)
            if not len(ok):
                continue
            key, other = rolling(words.hashes, width)[ok], mix(rolling(words.hashes, width, BASE2)[ok])
            text = words.text_of_word()[ok]
            place, doc = ok - words.first[:-1][text], ids[text]
            by = np.lexsort((place, doc, other, key))
            same = np.concatenate([[False], (key[by][1:] == key[by][:-1]) & (other[by][1:] == other[by][:-1])])
            lead = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))]
            later = np.sort(by[same & ((doc[by] != doc[lead]) | (place[by] != place[lead]))])
            own = by[~same]
            del words, by, lead, same, text
            bucket = (other[own] % np.uint64(buckets)).astype(np.int64)
            yield bucket_rows(bucket, key[own], doc[own], place[own], (doc[later], place[later]))

    return run


def _later(groups):
    """Reduce side: places of a bucket's windows that also start earlier, packed by group of documents."""

    def run(table):
        key, doc, place, settled_doc, settled_place = read_bucket(table)
        by = np.lexsort((place, doc, key))
        same = np.concatenate([[False], key[by][1:] == key[by][:-1]])
        lead = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))]
        flag = by[same & ((doc[by] != doc[lead]) | (place[by] != place[lead]))]
        return group_rows(np.append(doc[flag], settled_doc), np.append(place[flag], settled_place), groups)

    return run


def repeated_windows(docs, width=WIDTH, buckets=None, groups=None):
    """Places (word numbers) at which a window starts that also starts earlier, packed by document group.

    A window is identified by its 64-bit Rabin-Karp hash within a bucket chosen by a second, independent one.
    Returns (grp, places).
    """
    buckets = buckets or bucket_count(docs)
    packed = docs.select("doc_id", "text").mapInArrow(
        _windows(width, buckets), BUCKET_SCHEMA)
    return packed.groupBy("bucket").applyInArrow(_later(groups or buckets), "grp long, places binary")


def _without(body, gone):
    """The text without the words marked in `gone`; the gap before a removed run stays."""
    words = Words([body])
    begins, ends = runs(gone)
    cuts = [(words.starts[a], words.starts[b] if b < len(gone) else len(body))
            for a, b in zip(begins, ends, strict=True) if gone[a]]
    out, at = [], 0
    for a, b in cuts:
        out.append(body[at:a])
        at = b
    return b"".join([*out, body[at:]])


def remove_repeats(docs, width=WIDTH):
    """The documents, all columns, without the words of windows that also start earlier; plus n_words and n_removed.

    Earlier means a smaller doc_id, or an earlier start in the same document; windows are judged on the input.
    Runs of removed words are maximal: overlapping and adjoining windows merge. Kept words keep their gaps. A null
    text has no words and stays null. Rows without doc_id come before all others, in an order by their texts, each text a
    document of its own. Rows that repeat a doc_id with the same
    text get the same result (the same place is not earlier than itself); rows that share a doc_id but differ in text
    count as one document, whose places are numbered by row. Columns named n_words or n_removed are replaced.
    """
    import pyarrow as pa
    from pyspark.sql.types import LongType, StructField, StructType

    docs = docs.drop("n_words", "n_removed")
    groups = bucket_count(docs)
    places = repeated_windows(docs, width, groups, groups)
    packed = pack_texts(docs, groups)
    at_text = docs.columns.index("text")
    names = [*docs.columns, "n_words", "n_removed"]

    def cut(left, right):
        doc, place = join_places(right["places"])
        by = np.lexsort((place, doc))
        doc, place = doc[by], place[by]
        texts, counts, removed = [], [], []
        for i, body in zip(left["__id"].to_pylist(), left["__body"].to_pylist(), strict=True):
            body = None if body is None else unpack_text(body)
            n, lost = len(body.split()) if body else 0, 0
            a, b = np.searchsorted(doc, i, "left"), np.searchsorted(doc, i, "right")
            if b > a and n:
                gone = covered(np.unique(place[a:b]), width, n)
                lost = int(gone.sum())
                body = _without(body, gone) if lost else body
            texts.append(body)
            counts.append(n)
            removed.append(lost)
        own = [left.column(i) for i in range(3, left.num_columns)]
        own.insert(at_text, pa.array(texts, pa.binary()).cast(pa.string()))
        return pa.table([*own, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], [f"__c{i}" for i in range(len(names))])

    schema = StructType([StructField(f"__c{i}", f.dataType) for i, f in enumerate(
        [*docs.schema, StructField("n_words", LongType()), StructField("n_removed", LongType())])])
    out = packed.groupBy("__grp").cogroup(places.groupBy("grp")).applyInArrow(cut, schema)
    return out.toDF(*names)


def digests(docs, width=WIDTH):
    """Per document: doc_id, n_words, n_removed and the digest of its kept words joined by one space."""
    kept = F.concat_ws(" ", F.array_remove(F.split(F.coalesce("text", F.lit("")), GAPS), ""))
    return remove_repeats(docs.select("doc_id", "text"), width).select(
        "doc_id", "n_words", "n_removed", F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))
