"""Corpus pipeline: quality rules, near copies, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from pyspark.sql import functions as F

from freshet.llm import best_fit_packing, ngram_jaccard, quality_rules, secret_scan, substring_dedup
from freshet.llm.common import read_documents
from freshet.sources.layers import materialise


def _recounted(df, columns):
    """The columns of documents, with n_chars of the text as it now is."""
    size = F.char_length("text").cast("long")
    return df.select(*[size.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns])


def quality(spark, docs, sf_dir):
    """Documents that fail a rule of the policy go."""
    return quality_rules.keep_good(docs)


def near_copies(spark, docs, sf_dir):
    """Of each group of near copies (five-word n-grams, similarity 0.8) the smallest doc_id stays."""
    return ngram_jaccard.keep_one(docs, width=5, percent=80)


def repeated_passages(spark, docs, sf_dir):
    """Words inside windows of 20 that also start earlier go; a document that consists of nothing else goes with them."""
    out = substring_dedup.remove_repeats(docs)
    return _recounted(out.where("n_removed = 0 or n_removed < n_words"), docs.columns)


def secrets(spark, docs, sf_dir):
    """Findings that the forest confirms are replaced by a mark; the documents stay."""
    return _recounted(secret_scan.redact(docs, reviewed=spark.read.parquet(f"{sf_dir}/labels.parquet")), docs.columns)


def packing(spark, docs, sf_dir):
    """The texts in bins of 2,048 words, at most one document of a source in each."""
    return best_fit_packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard", near_copies),
    ("substring_dedup", repeated_passages),
    ("secret_scan", secrets),
    ("best_fit_packing", packing),
]

ORACLE_SQL = None  # a random forest has no SQL form; tests compare the stages with brute force


def run(spark, sf_dir):
    """All stages over documents, each but the last written to the shared folder and read again."""
    df = read_documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        df = stage(spark, df, sf_dir)
        if k < len(STAGES) - 1:
            df = materialise(df, name)
    return df
