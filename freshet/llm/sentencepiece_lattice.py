"""SentencePiece encoding and decoding as a relational lattice.

Bounded-length substrings of each distinct word are joined to the piece table; the edges of a word are grouped and a
Viterbi pass over them is folded with higher-order functions. Every distinct word is solved once.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from freshet.llm.common import GAPS, Words, bucket_count, doc_batches, expand, id_of, narrow, runs, squeeze
from freshet.sources.layers import materialise

MARK = "▁"          # stands for the space before a word
UNKNOWN_COST = 10.0      # below the worst piece, for each character that no piece covers
PART_CHARS = 500_000     # characters of distinct words in a part


def piece_table(spark, path):
    """(piece, id, score) of a model file, without control pieces, and the id of its first byte piece.

    The table has the size of the model's vocabulary, a fixed bound whatever the documents hold.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(model.IdToPiece(i), i, float(model.GetScore(i))) for i in range(model.GetPieceSize())
            if not (model.IsControl(i) or model.IsUnknown(i) or model.IsByte(i))]
    first = next(i for i in range(model.GetPieceSize()) if model.IsByte(i))
    return spark.createDataFrame(rows, "piece string, id int, score double"), first


def distinct_words(docs):
    """(word, n): the distinct words of all texts and how often each occurs."""
    words = docs.select(F.explode(F.array_remove(F.split("text", GAPS), "")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def encode_words(words, pieces, first_byte, part_chars=PART_CHARS):
    """(word_id, word, n, ids) of a table with distinct `word`s and their `n`: `ids` is the path of highest total score.

    Ties go to the earlier start of the last piece, then to the higher id. A character without a piece becomes its
    UTF-8 bytes' pieces. The words are written once with a number each, and dealt out by number in parts of about
    `part_chars` characters, so that the edges of a part fit in memory; edges carry the number, not the word, and are
    grouped where they arise. A word is one row: its edges, up to the piece length per character, must fit in a task,
    and the fold takes time with the square of a single word's length.
    """
    bounds = pieces.agg(F.max(F.char_length("piece")).alias("len"), F.min("score").alias("score")).first()
    longest, worst = bounds["len"] or 1, bounds["score"] or 0.0
    numbered = materialise(words.select(F.monotonically_increasing_id().alias("__w"), "word", "n"), "words")
    chars = numbered.agg(F.sum(F.char_length("word"))).first()[0] or 0
    parts = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), chars // part_chars)
    dealt = numbered.repartition(parts, "__w").withColumn("__t", F.concat(F.lit(MARK), "word"))
    at = dealt.select("__w", "word", "n", "__t", F.explode(F.sequence(F.lit(0), F.char_length("__t") - 1)).alias("b"))
    ahead = at.select("__w", "b", *[F.when(F.col("b") == 0, F.col(c)).alias(c) for c in ("word", "n")],
                      F.substring("__t", F.col("b") + 1, F.lit(longest)).alias("__t"))
    spans = ahead.select("__w", "b", "word", "n", "__t", F.explode(F.sequence(F.lit(1), F.char_length("__t"))).alias("k"))
    spans = spans.select("__w", "b", "word", "n", "k", F.substring("__t", F.lit(1), F.col("k")).alias("piece"))
    # Bounded by the model's vocabulary.
    joined = spans.join(F.broadcast(pieces), "piece", "left").where("id is not null or k = 1")
    edge = F.struct((F.col("b") + F.col("k")).alias("e"), "b", F.coalesce("id", F.lit(-1)).alias("id"),
                    F.coalesce("score", F.lit(worst - UNKNOWN_COST)).alias("score"))
    lattice = joined.groupBy("__w").agg(F.max("word").alias("word"), F.max("n").alias("n"), F.sort_array(F.collect_list(edge)).alias("edges"))
    node = lambda score, back, i: F.struct(score.alias("score"), back.alias("back"), i.alias("id"))
    start = node(F.lit(0.0), F.lit(0), F.lit(-1))
    state = F.struct(F.array().cast("array<struct<score:double,back:int,id:int>>").alias("best"), start.alias("last"), F.lit(0).alias("at"))

    def forward(s, x):
        """`best` holds the nodes before the one at `at`, `last` the best way to that one so far."""
        source = F.when(x["b"] == s["at"], s["last"]).otherwise(F.get(s["best"], x["b"]))
        way = node(source["score"] + x["score"], -x["b"], x["id"])
        same = F.struct(s["best"].alias("best"), F.greatest(s["last"], way).alias("last"), s["at"].alias("at"))
        return F.when(x["e"] == s["at"], same).otherwise(
            F.struct(F.concat(s["best"], F.array(s["last"])).alias("best"), way.alias("last"), x["e"].alias("at")))

    best = lattice.select("__w", "word", "n", F.aggregate("edges", state, forward, lambda s: F.concat(s["best"], F.array(s["last"]))).alias("best"))
    byte_ids = lambda char: F.transform(
        F.sequence(F.lit(0), F.octet_length(char) - 1),
        lambda k: F.conv(F.substring(F.hex(F.encode(char, "UTF-8")), 2 * k + 1, F.lit(2)), 16, 10).cast("int") + first_byte)
    done = F.struct((F.size("best") - 1).alias("at"), F.array().cast("array<int>").alias("ids"))

    def back(s, k):
        got = F.get(F.col("best"), k)
        ids = F.when(got["id"] >= 0, F.array(got["id"])).otherwise(byte_ids(F.substring(F.concat(F.lit(MARK), "word"), k, F.lit(1))))
        return F.when(s["at"] == k, F.struct((-got["back"]).alias("at"), F.concat(ids, s["ids"]).alias("ids"))).otherwise(s)

    path = F.aggregate(F.sequence(F.size("best") - 1, F.lit(1), F.lit(-1)), done, back, lambda s: s["ids"])
    return best.select(F.col("__w").alias("word_id"), "word", "n", path.alias("ids"))


def decode_ids(df, pieces, first_byte, ids="ids", key="word"):
    """Adds `text` to a table with an id array per distinct `key`: the pieces of a row in order, byte pieces joined to
    UTF-8, marks back to spaces. Rows without ids are left out."""
    own = [c for c in df.columns if c != key]
    rows = df.select(key, *own, F.posexplode(ids).alias("k", "__id")).select(
        key, "k", "__id", *[F.when(F.col("k") == 0, F.col(c)).alias(c) for c in own])
    hexed = pieces.select(F.col("id").alias("__id"), F.hex(F.encode("piece", "UTF-8")).alias("h"))
    known = rows.join(F.broadcast(hexed), "__id", "left").withColumn(
        "h", F.coalesce("h", F.lpad(F.hex(F.col("__id") - first_byte), 2, "0")))
    text = F.decode(F.unhex(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "h"))), lambda x: x["h"]), "")), "UTF-8")
    return known.groupBy(key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in own], F.ltrim(F.translate(text, MARK, " ")).alias("text"))


def encode_documents(docs, pieces, first_byte):
    """(doc_id, ids): the ids of a whole text in order, by joining each occurrence to its word's path.

    Every occurrence is shuffled twice. Texts without words have empty ids; rows that share a doc_id are joined.
    """
    words = encode_words(distinct_words(docs), pieces, first_byte).select("word", "ids")
    at = docs.select("doc_id", F.posexplode_outer(F.array_remove(F.split("text", GAPS), "")).alias("k", "word"))
    rows = at.join(words, "word", "left").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("x"))
    return rows.select("doc_id", F.flatten(F.transform("x", lambda x: F.coalesce(x["ids"], F.array().cast("array<int>")))).alias("ids"))


def _laid_out(first, last):
    """Numbers first[k] .. last[k] - 1 of every k, one after the other."""
    n = last - first
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def round_trip(docs, pieces, first_byte):
    """Per row of documents: doc_id, n_words, n_ids, ids (of the whole text, in order) and the text decoded from them.

    Decoded words are separated by one space. Rows are gathered in blocks, written once. A block asks the buckets of
    words for its distinct words, by 64-bit hash, and gets their ids back in the same order, so what is exchanged are
    the distinct words of a block, not their occurrences. Null and empty texts have no ids and an empty decoded text.
    """
    import zstandard

    buckets = bucket_count(docs)
    table = {r["id"]: r["piece"].replace(MARK, " ").encode() for r in pieces.collect()}  # bounded by the model's vocabulary
    table.update({first_byte + k: bytes([k]) for k in range(256)})
    spelt = docs.sparkSession.sparkContext.broadcast([table.get(k, b"") for k in range(max(table) + 1)])

    def gather(batches):
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        for ids, texts in doc_batches(batches):
            lens = np.fromiter(map(len, texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([
                pa.array([at], pa.int64()), pa.array([squeeze(np.array(ids, np.int64), lens)], pa.binary()),
                pa.array([zstandard.ZstdCompressor(3).compress(b"".join(texts))], pa.binary())], ["block", "docs", "body"])
            at += 1

    def words_of(own, body):
        """doc ids, words and their distinct hashes in order of bucket and hash, the bucket of each, and the place of each word in them."""
        ids, lens = expand(own)
        body, ends = zstandard.ZstdDecompressor().decompress(body), np.cumsum(lens)
        words = Words([body[b - n:b] for n, b in zip(lens.tolist(), ends.tolist(), strict=True)])
        hashes, number = np.unique(words.hashes, return_inverse=True)
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        return ids, words.first, hashes[by], bucket[by], rank[number]

    def ask(batches):
        for batch in batches:
            for block, own, body in zip(*[batch[c].to_pylist() for c in ("block", "docs", "body")], strict=True):
                _, _, hashes, bucket, _ = words_of(own, body)
                cuts = list(zip(*runs(bucket), strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(bucket[a]) for a, _ in cuts], pa.int64()), pa.array([block] * len(cuts), pa.int64()),
                    pa.array([hashes[a:b].tobytes() for a, b in cuts], pa.binary())], ["bucket", "block", "hashes"])

    def deal(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes = Words([x.encode() for x in batch["word"].to_pylist()]).hashes
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)
            ids, ends = batch["ids"].flatten().to_numpy(), np.cumsum(batch["ids"].value_lengths().to_numpy())
            begins = np.concatenate([[0], ends[:-1]])
            by = np.argsort(bucket, kind="stable")
            cuts = [by[a:b] for a, b in zip(*runs(bucket[by]), strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array([int(bucket[x[0]]) for x in cuts], pa.int64()),
                pa.array([squeeze(hashes[x], narrow((ends - begins)[x]), narrow(ids[_laid_out(begins[x], ends[x])])) for x in cuts], pa.binary()),
            ], ["bucket", "known"])

    def answer(left, right):
        parts = [expand(x) for x in right["known"].to_pylist()]
        hashes = np.concatenate([np.empty(0, np.uint64), *[p[0] for p in parts]])
        ends = np.cumsum(np.concatenate([np.empty(0, np.int64), *[p[1].astype(np.int64) for p in parts]]))
        ids = np.concatenate([np.empty(0, np.int64), *[p[2].astype(np.int64) for p in parts]])
        begins = np.concatenate([np.zeros(1, np.int64), ends])[: len(ends)]
        by = np.argsort(hashes)
        if (hashes[by][1:] == hashes[by][:-1]).any():
            raise ValueError("two words share a hash")
        out = []
        for x in left["hashes"].to_pylist():
            asked = np.frombuffer(x, np.uint64)
            place = by[np.searchsorted(hashes, asked, sorter=by)]
            if (hashes[place] != asked).any():
                raise ValueError("a word of a block is not in the table of words")
            out.append(squeeze(narrow(ends[place] - begins[place]), narrow(ids[_laid_out(begins[place], ends[place])])))
        return pa.table({"block": left["block"], "bucket": left["bucket"], "ids": pa.array(out, pa.binary())})

    def finish(left, right):
        parts = [expand(x) for x in right.sort_by("bucket")["ids"].to_pylist()]
        lens = np.concatenate([np.empty(0, np.int64), *[p[0].astype(np.int64) for p in parts]])
        known = np.concatenate([np.empty(0, np.int64), *[p[1].astype(np.int64) for p in parts]])
        ends = np.cumsum(lens)
        letters = np.frombuffer(b"".join(spelt.value), np.uint8)
        letter_ends = np.cumsum(np.fromiter(map(len, spelt.value), np.int64, len(spelt.value)))
        letter_begins = np.concatenate([[0], letter_ends[:-1]])
        out = {c: [] for c in ("doc_id", "n_words", "n_ids", "ids", "decoded")}
        for own, body in zip(left["docs"].to_pylist(), left["body"].to_pylist(), strict=True):
            docs, first, _, _, rank = words_of(own, body)
            coded = known[_laid_out(ends[rank] - lens[rank], ends[rank])]
            stops = np.concatenate([[0], np.cumsum(lens[rank])])[first]
            text = letters[_laid_out(letter_begins[coded], letter_ends[coded])].tobytes()
            cuts = np.concatenate([[0], np.cumsum((letter_ends - letter_begins)[coded])])[stops].tolist()
            out["doc_id"] += map(id_of, docs)
            out["n_words"].append(np.diff(first))
            out["n_ids"].append(np.diff(stops))
            out["ids"].append(pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(coded, pa.int32())))
            out["decoded"] += [text[a:b].removeprefix(b" ") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        ids = pa.chunked_array(out["ids"], pa.list_(pa.int32()))
        count = lambda x: pa.array(np.concatenate([np.empty(0, np.int64), *x]), pa.int64())
        return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "n_words": count(out["n_words"]), "n_ids": count(out["n_ids"]),
                         "ids": ids, "decoded": pa.array(out["decoded"], pa.binary()).cast(pa.string())})

    blocks = materialise(docs.select("doc_id", "text").mapInArrow(gather, "block long, docs binary, body binary"), "text-blocks")
    words = encode_words(distinct_words(docs), pieces, first_byte).select("word", "ids").mapInArrow(deal, "bucket long, known binary")
    asked = blocks.mapInArrow(ask, "bucket long, block long, hashes binary")
    answers = asked.groupBy("bucket").cogroup(words.groupBy("bucket")).applyInArrow(answer, "block long, bucket long, ids binary")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        finish, "doc_id long, n_words long, n_ids long, ids array<int>, decoded string")
