import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from freshet.llm import queries
from freshet.llm import token_file as tf
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
MODEL = Tokenizer.from_file(PATH)


def expected(docs):
    at, out = 0, {}
    for i, text in docs:
        ids = [*MODEL.encode(text or "", add_special_tokens=False).ids, 2]
        out[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    return out


def as_dict(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_query_equals_the_library(spark):
    assert as_dict(queries.op7_token_file(spark, FOLDER)) == expected(brute.corpus(FOLDER))


def test_edge_texts_in_many_shards(spark):
    rows = [(-5, "a  b", "x", 1), (1 << 40, " lead\n\n two <|endoftext|> x", "x", 1), *brute.edge_rows()]
    shards = tf.write_tokens(brute.edge_docs(spark, rows), PATH, shard_tokens=40)
    assert shards.count() > 3
    assert as_dict(tf.read_tokens(shards)) == expected(sorted((r[0], r[1]) for r in rows))


def test_words_encoded_as_lines_equal_words_encoded_alone():
    texts = ["", "\0", "one two, two", "a \u00a0b \u2003c  d", " x\n y\n\nz \n", "tail \u00a0", "\u0085 q", "\x1c\x1d r \x1c", "1 22 333 ab12, !? ' 's don't"]
    texts += [f" w{k} {k}\t{k},\n\u00e9{k}." for k in range(6_000)]
    for line in (True, False):
        model = tf.Encoder(PATH)
        assert model.line is not None
        model.line = model.line if line else None
        assert [x.tolist() for x in model.encode(texts)] == [MODEL.encode(t, add_special_tokens=False).ids for t in texts]


def test_null_and_repeated_ids(spark):
    rows = [(None, "one", "x", 1), (3, "two words", "x", 1), (3, "two words", "x", 1), (None, None, "x", 1)]
    got = sorted(tuple(r) for r in tf.read_tokens(tf.write_tokens(brute.edge_docs(spark, rows), PATH)).select("start", "n_tokens").collect())
    assert len(got) == 4 and got[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(got, got[1:], strict=False))
    assert tf.read_tokens(tf.write_tokens(brute.edge_docs(spark, []), PATH)).count() == 0


@pytest.mark.parametrize("values", [[], [7], [0, 0, 0], [-9, -9, 5, 1 << 40], list(range(0, 90_000, 7)), [3] * 700 + [10**9] * 700])
def test_elias_fano(values):
    code, end = tf.EliasFano.read(b"xx" + tf.EliasFano.of(values).to_bytes(), 2)
    assert code.all().tolist() == values and end == len(tf.EliasFano.of(values).to_bytes()) + 2
    for i in range(0, len(values), 97):
        assert code.select(i) == values[i]


def test_space_of_boundaries():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 1000, 50_000))
    assert 8 * len(tf.EliasFano.of(ends).to_bytes()) / len(ends) < 2.1 + np.log2(ends[-1] / len(ends))


def test_words_of_letters_and_marks_after_them_are_not_split_again():
    class Counted:
        chars = 0

        def encode_batch_fast(self, texts, **options):
            self.chars += sum(map(len, texts))
            return MODEL.encode_batch_fast(texts, **options)

    names = ["".join(chr(97 + int(d)) for d in str(k)) + "\u00e9\u0107" * (k % 2) for k in range(3_000)]
    texts = [f"x {w}%%% {w}!! {w}, {w}\n{w.upper()}." for w in names]
    model = tf.Encoder(PATH)
    model.model = Counted()
    assert [x.tolist() for x in model.encode(texts)] == [MODEL.encode(t, add_special_tokens=False).ids for t in texts]
    assert model.model.chars < 30_000  # the words after a line end alone; each form of a word as its own text has 100,000
