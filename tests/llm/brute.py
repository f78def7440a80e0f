"""Plain single-machine versions of the operators, for small tables."""

import hashlib

EDGE_TEXTS = [
    None, "", " ", "\n\n", "one", "one two", "a b c d e f g h i j k l m n o p q r s t u v w x y z",
    "a b c d e f g h i j k l m n o p q r s t u v w x y z", "x " * 60, "éè üß 中文 \U0001f600 tail\tof\x0btext",
    "A b C d e F g h i j k l m n o p q r s t u v w x y Z", "same line\nsame line\nsame line\nother", "x " * 3000,
]


def words_of(text):
    return (text or "").encode().split()


def edge_rows():
    return [(i, t, "clash", i) for i, t in enumerate(EDGE_TEXTS)]


EDGE_SCHEMA = "doc_id long, text string, grp string, n long"


def edge_docs(spark, rows=None):
    return spark.createDataFrame(edge_rows() if rows is None else rows, EDGE_SCHEMA)


def corpus(folder):
    import pyarrow.parquet as pq

    table = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return sorted(zip(table["doc_id"], table["text"], strict=True))


def substring_dedup(docs, width=20):
    seen, out = set(), {}
    for i, text in docs:
        words = words_of(text)
        gone = [False] * len(words)
        for s in range(len(words) - width + 1):
            window = tuple(words[s:s + width])
            if window in seen:
                gone[s:s + width] = [True] * width
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest(), gone)
    return out


def kept_words(text, gone):
    return [w for w, g in zip(words_of(text), gone, strict=True) if not g]
