"""Document fingerprints: invertible Bloom lookup tables of paragraph digests, subtracted and peeled.

Only DataFrame functions are used; nothing leaves the JVM.
"""

from pyspark.sql import functions as F

from freshet.llm.common import NULL_ID
from freshet.sources.layers import number_rows

CELLS = 24                       # of the fingerprint itself
LADDER = [(16, 48), (6, 96)]     # retries: digests per table on average, cells of each table


def _zero():
    return F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("chk"))


def _check(key):
    return F.xxhash64(key, F.lit(99))


def _places(key, cells, seed):
    third = cells // 3
    return [F.pmod(F.xxhash64(key, F.lit(seed * 10 + j)), F.lit(third)) + j * third for j in range(3)]


def paragraphs(text):
    """Distinct digests of the non-empty lines of a text."""
    return F.array_distinct(F.transform(F.filter(F.split(text, "\n"), lambda x: x != ""), lambda x: F.xxhash64(x)))


def _add(cell, n, key, chk):
    return F.struct((cell["n"] + n).alias("n"), cell["key"].bitwiseXOR(key).alias("key"), cell["chk"].bitwiseXOR(chk).alias("chk"))


def sketch(keys, cells=CELLS, seed=0):
    """Table of a key array: each key is hashed into one cell of each third, which counts it and folds it in."""
    placed = F.transform(keys, lambda k: F.struct(k.alias("key"), _check(k).alias("chk"), F.array(*_places(k, cells, seed)).alias("at")))
    # Bound once by an outer one-element transform, so that the hashes are not computed again for every cell.
    table = lambda p: F.transform(F.sequence(F.lit(0), F.lit(cells - 1)), lambda c: F.aggregate(
        F.filter(p, lambda x: F.get(x["at"], F.floor(c / (cells // 3)).cast("int")) == c), _zero(), lambda a, x: _add(a, 1, x["key"], x["chk"])))
    return F.transform(F.array(placed), table)[0]


def subtract(a, b):
    return F.zip_with(a, b, lambda x, y: _add(x, -y["n"], y["key"], y["chk"]))


def peel(table, cells=CELLS, seed=0):
    """Struct (cells, found): digests recovered from a difference; all cells are empty if it succeeded."""
    pure = lambda c: (F.abs(c["n"]) == 1) & (c["chk"] == _check(c["key"]))

    def removed(s, p):
        at = F.array(*_places(p["key"], cells, seed))
        rest = lambda place: F.transform(s["cells"], lambda c, j: F.when(
            F.array_contains(place, j.cast("long")), _add(c, -p["n"], p["key"], p["chk"])).otherwise(c))
        return F.struct(F.transform(F.array(at), rest)[0].alias("cells"), F.concat(s["found"], F.array(p["key"])).alias("found"))

    def step(s, _):
        first = F.slice(F.filter(s["cells"], pure), 1, 1)
        return F.coalesce(F.get(F.transform(first, lambda p: removed(s, p)), F.lit(0)), s)

    start = F.struct(table.alias("cells"), F.array().cast("array<long>").alias("found"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(cells)), start, step)


def _difference(peeled):
    """The recovered digests, or null if a cell is left."""
    left = F.exists(peeled["cells"], lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["chk"] != 0))
    return F.when(~left, peeled["found"])


def _retry(a, b, per, cells, seed):
    """Difference of two key arrays by tables of more room: keys are dealt out by hash, a table for `per` of them."""
    tables = F.ceil((F.size(a) + F.size(b)) / per).cast("int")
    part = lambda keys, t: F.filter(keys, lambda k: F.pmod(F.xxhash64(k, F.lit(seed + 7)), tables) == t)
    each = F.transform(F.sequence(F.lit(0), F.greatest(tables, F.lit(1)) - 1), lambda t: F.transform(
        F.array(peel(subtract(sketch(part(a, t), cells, seed), sketch(part(b, t), cells, seed)), cells, seed)), _difference)[0])
    return F.transform(F.array(each), lambda e: F.when(~F.exists(e, lambda x: x.isNull()), F.flatten(e)))[0]


def differing(a, b, table_a, table_b):
    """Digests in one of two key arrays but not in the other, by peeling; larger tables are tried on failure.

    What defeats every rung is set right by the plain difference of the arrays, so the result is always whole.
    """
    found = _difference_of(table_a, table_b)
    for k, (per, cells) in enumerate(LADDER):
        found = F.coalesce(found, _retry(a, b, per, cells, k + 1))
    return F.coalesce(found, F.concat(F.array_except(a, b), F.array_except(b, a)))


def _difference_of(a, b):
    return F.transform(F.array(peel(subtract(a, b))), _difference)[0]


def likeness(a, b, different):
    """Shared share of the digests of two documents: 1 if neither has any."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise((both - F.size(different)) / (both + F.size(different)))


def as_text(table, n):
    """Fingerprint text: number of digests, then count, key and check of each cell."""
    cell = lambda c: F.concat_ws(".", F.hex(c["n"]), F.lower(F.hex(c["key"])), F.lower(F.hex(c["chk"])))
    return F.concat(n.cast("string"), F.lit(":"), F.array_join(F.transform(table, cell), ","))


def with_next(docs):
    """doc_id, text, n_chars, head, next_keys: each document with the head of the next one that replaces its second half.

    Documents are ordered by doc_id (null first), then by a hash of the text; the last is followed by the first.
    Identical rows count as one document and are all returned. Only heads, digests and keys move to the document
    before; the order is found on keys alone.
    """
    # Both joins read the same columns with the same keys, so the texts are shuffled once.
    text = F.coalesce("text", F.lit(""))
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("k"), F.xxhash64(text).alias("h"), text.alias("text"))
    rows = number_rows(base.select("k", "h", F.char_length("text").alias("n")).distinct(), ["k", "h"])
    last = rows.agg(F.max("row_number")).scalar()
    before = rows.select(F.when(F.col("row_number") == last, 1).otherwise(F.col("row_number") + 1).alias("row_number"),
                         F.col("k").alias("to_k"), F.col("h").alias("to_h"), F.floor(F.col("n") / 2).cast("int").alias("need"))
    order = rows.join(before, "row_number").select("k", "h", "to_k", "to_h", "need")
    heads = base.join(order, ["k", "h"]).select(
        F.col("to_k").alias("k"), F.col("to_h").alias("h"), F.left("text", F.col("need")).alias("head"), paragraphs(F.col("text")).alias("next_keys"))
    joined = base.join(heads.dropDuplicates(["k", "h"]), ["k", "h"])
    return joined.select(F.when(F.col("k") != NULL_ID, F.col("k")).alias("doc_id"), "text",
                         F.char_length("text").cast("long").alias("n_chars"), "head", "next_keys")


def fingerprints(docs):
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document. A fingerprint is the table of the distinct non-empty lines, of fixed size, so equal texts have equal
    ones; likeness is the share of common digests, from the digests that peeling the difference recovers. Null texts
    are empty ones. The work of a retry grows with the square of a document's lines; documents are never compared in
    pairs.
    """
    df = with_next(docs)
    kept = F.left("text", (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int"))
    df = df.select("doc_id", "n_chars", F.concat(kept, F.col("head")).alias("edited"), paragraphs(F.col("text")).alias("a"), F.col("next_keys").alias("c"))
    df = df.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "a", paragraphs(F.col("edited")).alias("b"), "c")
    df = df.select("*", sketch(F.col("a")).alias("ta"), sketch(F.col("b")).alias("tb"), sketch(F.col("c")).alias("tc"))
    a, b, c = (F.col(x) for x in "abc")
    df = df.select("*", differing(a, b, F.col("ta"), F.col("tb")).alias("db"), differing(a, c, F.col("ta"), F.col("tc")).alias("dc"))
    # Generated columns, so that a later filter on them does not repeat the work below.
    out = F.struct("edited_sha256", as_text(F.col("ta"), F.size(a)).alias("fingerprint"), as_text(F.col("tb"), F.size(b)).alias("edited_fingerprint"),
                   likeness(a, b, F.col("db")).alias("near_edited"), likeness(a, c, F.col("dc")).alias("near_next"))
    return df.select("doc_id", "n_chars", F.inline(F.array(out)))
