"""Token ids in binary shards: one id array per shard, document boundaries in Elias-Fano code with select structures."""

import re
import struct
import zlib
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from freshet.llm.common import NULL_ID, id_of, slices
from freshet.sources.layers import materialise

END = 2
SHARD_TOKENS = 2_000_000
CACHE_PIECES = 2_000_000  # pieces whose ids a worker remembers; it starts afresh beyond that
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"  # cut off the end of a word before it is looked up
LETTERS = re.compile(" [A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")  # the pre-tokenizer leaves such a word whole
JOINED = 4_096            # words encoded together as lines of one text
MAGIC = b"EFTOK001"
SAMPLE = 256              # one select sample per so many values


class EliasFano:
    """A non-decreasing sequence in about 2 + log2(range / length) bits a value, with select.

    Low bits are packed side by side; high bits are ones in a bit vector at high value + index. Every SAMPLE-th one's
    byte is sampled, so select scans a bounded stretch of the vector and needs no 64-bit table.
    """

    def __init__(self, n, base, low_bits, low, high):
        self.n, self.base, self.low_bits, self.low, self.high = n, base, low_bits, low, high
        ones = np.cumsum(np.unpackbits(high, bitorder="little").reshape(-1, 8).sum(1)) if len(high) else np.empty(0, np.int64)
        self.before = np.concatenate([[0], ones])[:-1].astype(np.uint32) if len(ones) else np.empty(0, np.uint32)
        self.samples = np.searchsorted(ones, np.arange(0, n, SAMPLE), "right").astype(np.uint32)

    @classmethod
    def of(cls, values):
        values = np.asarray(values, np.int64)
        n, base = len(values), int(values[0]) if len(values) else 0
        gap = (values - base).astype(np.uint64) if n else np.empty(0, np.uint64)
        bits = max(0, (int(gap[-1]) // n).bit_length() - 1) if n else 0
        low = ((gap[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
        high = (gap >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        vector = np.zeros(-(-(int(high[-1]) + 1) // 8) * 8 if n else 0, np.uint8)
        vector[high] = 1
        return cls(n, base, bits, np.packbits(low, bitorder="little"), np.packbits(vector, bitorder="little"))

    def to_bytes(self):
        return struct.pack("<qqqqq", self.n, self.base, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def read(cls, blob, at):
        n, base, bits, a, b = struct.unpack_from("<qqqqq", blob, at)
        at += 40
        return cls(n, base, bits, np.frombuffer(blob, np.uint8, a, at), np.frombuffer(blob, np.uint8, b, at + a)), at + a + b

    def _low(self, i):
        bits = np.unpackbits(self.low[i * self.low_bits // 8:-(-(i + 1) * self.low_bits // 8)], bitorder="little")
        first = i * self.low_bits % 8
        return int(sum(int(x) << k for k, x in enumerate(bits[first:first + self.low_bits])))

    def select(self, i):
        """The i-th value."""
        byte = int(self.samples[i // SAMPLE])
        stop = int(self.samples[i // SAMPLE + 1]) + 1 if i // SAMPLE + 1 < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[byte:stop], bitorder="little"))
        place = byte * 8 + int(ones[i - int(self.before[byte])])
        return self.base + (((place - i) << self.low_bits) | self._low(i))

    def all(self):
        place = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        low = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits).astype(np.int64)
        low = (low << np.arange(self.low_bits)).sum(1) if self.low_bits else np.zeros(self.n, np.int64)
        return self.base + (((place - np.arange(self.n)) << self.low_bits) | low)


def write_shard(doc_ids, lens, ids):
    """Shard bytes: magic, Elias-Fano doc ids (ascending), Elias-Fano ends of the documents, then all ids in 16 or 32 bits."""
    wide = int(len(ids) > 0 and int(ids.max()) > 0xFFFF)
    body = EliasFano.of(doc_ids).to_bytes() + EliasFano.of(np.cumsum(lens)).to_bytes()
    return MAGIC + struct.pack("<q", wide) + body + ids.astype(np.uint32 if wide else np.uint16).tobytes()


def read_shard(blob):
    """(doc ids, ends, ids): two EliasFano sequences and the id array of a shard."""
    if blob[:8] != MAGIC:
        raise ValueError("not a token shard")
    wide, = struct.unpack_from("<q", blob, 8)
    docs, at = EliasFano.read(blob, 16)
    ends, at = EliasFano.read(blob, at)
    return docs, ends, np.frombuffer(blob, np.uint32 if wide else np.uint16, offset=at)


class Growing:
    """An array that is appended to; its room doubles, so that what it holds is rarely copied."""

    def __init__(self, dtype):
        self.room, self.n = np.empty(1_024, dtype), 0

    def extend(self, values):
        n = self.n + len(values)
        if n > len(self.room):
            room = np.empty(2 * n, self.room.dtype)
            room[:self.n] = self.room[:self.n]
            self.room = room
        self.room[self.n:n], self.n = values, n


class Encoder:
    """Ids of many texts; equal pieces between spaces are encoded once per worker.

    The tokenizer never joins a non-space with a space or a line end after it, so a text may be cut before each space
    and line end that follows a non-space, and a word that ends in a letter from the marks after it. Texts with longer
    runs of spaces or with a special token are encoded whole.
    """

    def __init__(self, path):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Split

        self.model = Tokenizer.from_file(path)
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()] + ["\0"]
        line, two = (self.model.encode(t, add_special_tokens=False).ids for t in ("\n", " a\n b"))
        self.line = line[0] if len(line) == 1 and two.count(line[0]) == 1 else None  # a line end before " x" is an id of its own
        alphabet = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {k: alphabet.pre_tokenize_str(chr(k))[0][0][-1] for k in range(128)}
        for c in map(chr, range(0x80, 0x250)):
            self.letters.update(zip(c.encode(), alphabet.pre_tokenize_str(c)[0][0], strict=True))
        self.by_word = Tokenizer.from_file(path)
        self.by_word.pre_tokenizer = Split(self.letters[10], "isolated")
        self.clear()

    def clear(self):
        self.place, self.flat, self.begins, self.sizes = {}, Growing(np.uint32), Growing(np.int64), Growing(np.int64)

    def _plain(self, texts, model=None):
        """Ids of texts end to end, and the number of ids of each."""
        ids = [e.ids for e in (model or self.model).encode_batch_fast(texts, add_special_tokens=False)]
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lens.sum())), lens

    def _lines(self, heads, end="\n", model=None):
        """As _plain, of heads encoded as lines and cut again at the id of the line end."""
        flat, _ = self._plain([end.join(heads[k:k + JOINED]) + end for k in range(0, len(heads), JOINED)], model)
        ends = flat == self.line
        return flat[~ends], np.diff(np.flatnonzero(ends), prepend=-1) - 1

    def _words(self, heads):
        """As _plain. Heads that are a space and a non-space on are encoded as lines; those of letters alone are one word to the
        pre-tokenizer, so they go to the model as such, spelt in its letters for bytes."""
        if self.line is None:
            return self._plain(heads)
        kind = np.array([2 if LETTERS.fullmatch(x) else int(x[:1] == " " and not x[1:2].isspace()) for x in heads], np.int8)
        own, lines, letters = ([x for x, k in zip(heads, kind.tolist(), strict=True) if k == n] for n in range(3))
        spelt = [x.encode().decode("latin-1").translate(self.letters) for x in letters]
        sizes, parts = np.empty(len(heads), np.int64), [self._plain(own), self._lines(lines), self._lines(spelt, self.letters[10], self.by_word)]
        for n, (_, lens) in enumerate(parts):
            sizes[kind == n] = lens
        out, kind = np.empty(sizes.sum(), np.uint32), np.repeat(kind, sizes)
        for n, (flat, _) in enumerate(parts):
            out[kind == n] = flat
        return out, sizes

    @staticmethod
    def _pieces(texts):
        """The pieces of every text as keys: "\\0" marks the first, a line end starts its own, all others follow a space."""
        lines = pc.replace_substring(texts, "\n", " \n")
        return pc.split_pattern(pc.binary_join_element_wise(pa.scalar("\0", texts.type), lines, pa.scalar("", texts.type)), " ")

    def _learn(self, new):
        heads, number, head, tail = {}, self.sizes.n, [], []
        number_of = heads.setdefault
        for p in new:
            first = p[:1]
            text = p[1:] if first == "\0" else p if first == "\n" else " " + p
            last = text[-1:]
            # A key that ends in a space cannot be cut after; the text that holds it is encoded whole.
            if last.isspace() or not p:
                self.place[p] = -1
                continue
            core = text.rstrip(MARKS) if last in MARKS else text
            if core != text and core[-1:].isalpha():
                head.append(number_of(core, len(heads)))
                tail.append(number_of(text[len(core):], len(heads)))
            else:
                head.append(number_of(text, len(heads)))
                tail.append(-1)
            self.place[p] = number
            number += 1
        if not head:
            return
        flat, lens = self._words(list(heads))
        parts = np.array([head, tail]).T.ravel()  # of each key: its head, then its mark
        parts = parts[parts >= 0]
        own = np.array(lens)[head] + np.where(np.array(tail) >= 0, lens[tail], 0)
        self.begins.extend(self.flat.n + np.cumsum(own) - own)
        self.sizes.extend(own)
        self.flat.extend(gather(flat, np.cumsum(lens) - lens, lens, parts))

    def encode(self, texts):
        """Ids of each text. Texts are split and equal pieces found for all of them at once, so only distinct pieces are looked up."""
        if len(self.place) > CACHE_PIECES:
            self.clear()
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        whole = reduce(np.logical_or, (pc.match_substring(texts, t).to_numpy(zero_copy_only=False) for t in self.special))
        pieces = self._pieces(texts.filter(pa.array(~whole)))
        counts, pieces = pieces.value_lengths().to_numpy(), pieces.flatten().dictionary_encode()
        keys = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()  # many times as fast as to_pylist
        found = list(map(self.place.get, keys))
        self._learn([p for p, at in zip(keys, found, strict=True) if at is None])
        found = [self.place[p] if at is None else at for p, at in zip(keys, found, strict=True)]
        at = np.array(found, np.int64)[pieces.indices.to_numpy()]
        if len(counts):  # a text has one piece at least
            begins = np.cumsum(counts) - counts
            bad = np.minimum.reduceat(at, begins) < 0
            at, counts, whole[~whole] = at[np.repeat(~bad, counts)], counts[~bad], bad
        stops = np.concatenate([[0], np.cumsum(self.sizes.room[at])])[np.cumsum(counts)]
        known = iter(np.split(gather(self.flat.room, self.begins.room, self.sizes.room, at), stops))
        flat, lens = self._plain(texts.filter(pa.array(whole)).to_pylist())
        others = iter(np.split(flat, np.cumsum(lens)))
        for own in whole.tolist():
            yield next(others if own else known)


def gather(flat, begins, lens, at):
    """The stretches `at` of an array, end to end."""
    own = lens[at]
    return flat[np.repeat(begins[at] - np.cumsum(own) + own, own) + np.arange(own.sum())]


_encoders = {}


def encoder(path):
    """One encoder per worker, so that the pieces of earlier tasks are known."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write_tokens(docs, path, end=END, shard_tokens=SHARD_TOKENS):
    """Encodes every text, ends each with `end`, and writes shards in ascending doc_id order; returns the shard table.

    Rows are dealt out by ranges of doc_id; each task writes its range as shards of about `shard_tokens` ids, one row
    each of a table in the shared folder: first, last, seq (order of the shards), n_docs, n_tokens, shard. A null text
    is empty and still gets its end id; a null doc_id comes first; repeated rows are all written, ties by text.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        model, held, size, seq = encoder(path), [], 0, 0

        def flush():
            ids = np.concatenate([x for _, x in held])
            keys = np.array([i for i, _ in held], np.int64)
            # A null id is kept beside the sequence: the code starts at the first real one.
            real = keys[keys != NULL_ID]
            shard = write_shard(real, np.fromiter((len(x) for _, x in held), np.int64, len(held)), ids)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in (
                (keys[0], pa.int64()), (keys[-1], pa.int64()), (seq, pa.int64()), (len(held), pa.int64()),
                (len(ids), pa.int64()), (shard, pa.binary()))], ["first", "last", "seq", "n_docs", "n_tokens", "shard"])

        for batch in slices(batches, 1_024):
            keys = batch["doc_id"].fill_null(NULL_ID).to_pylist()
            for i, ids in zip(keys, model.encode(batch["text"].fill_null("")), strict=True):
                held.append((i, np.append(ids, np.uint32(end))))
                size += len(ids) + 1
                if size >= shard_tokens:
                    yield flush()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield flush()

    return materialise(ordered.mapInArrow(run, "first long, last long, seq long, n_docs long, n_tokens long, shard binary"), "token-shards")


def read_tokens(shards):
    """Per document of a shard table: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    before = Window.orderBy("first", "last", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    starts = shards.select("first", "last", "seq", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))

    def run(batches):
        for batch in batches:
            for first, last, seq, n, blob in zip(*[batch[c].to_pylist() for c in ("first", "last", "seq", "n_docs", "shard")], strict=True):
                docs, ends, ids = read_shard(blob)
                keys = np.concatenate([np.full(n - docs.n, NULL_ID), docs.all() if docs.n else np.empty(0, np.int64)]).astype(np.int64)
                stop = ends.all()
                start = np.concatenate([[0], stop[:-1]])
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([first] * n, pa.int64()), pa.array([last] * n, pa.int64()), pa.array([seq] * n, pa.int64()),
                    pa.array([id_of(i) for i in keys.tolist()], pa.int64()), pa.array(start, pa.int64()),
                    pa.array(stop - start, pa.int64()), pa.array(crc, pa.int64())],
                    ["first", "last", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = shards.select("first", "last", "seq", "n_docs", "shard").mapInArrow(
        run, "first long, last long, seq long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["first", "last", "seq"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
