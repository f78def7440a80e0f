"""Registered queries of the document operators."""

from pyspark.sql import functions as F

from freshet.llm import (
    best_fit_packing, fill_in_middle, fingerprints, license_scan, lm_score, ngram_jaccard, phrase_mining,
    quality_rules, secret_scan,
    sentencepiece_lattice, substring_dedup, suffix_dedup, token_file,
)
from freshet.llm.common import read_documents


def op1_secret_scan(spark, sf_dir):
    found = secret_scan.scan(read_documents(spark, sf_dir), reviewed=spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", "start", F.char_length("finding").cast("long").alias("n_chars"),
                        F.sha2(F.col("finding").cast("binary"), 256).alias("finding_sha256"), *secret_scan.FEATURES, "p_secret", "is_secret")


def op2_substring_dedup(spark, sf_dir):
    return substring_dedup.digests(read_documents(spark, sf_dir))


def op3_ngram_jaccard(spark, sf_dir):
    return ngram_jaccard.jaccard_join(read_documents(spark, sf_dir))


def op4_sentencepiece(spark, sf_dir):
    """Every distinct word of all texts with its ids and the text decoded from them."""
    import public_tokenizers

    pieces, first_byte = sentencepiece_lattice.piece_table(spark, str(public_tokenizers.path("piece_bpe_32k.model")))
    words = sentencepiece_lattice.distinct_words(read_documents(spark, sf_dir))
    coded = sentencepiece_lattice.encode_words(words, pieces, first_byte)
    both = sentencepiece_lattice.decode_ids(coded, pieces, first_byte, key="word_id")
    return both.select("word", F.col("n").alias("n_words"), F.size("ids").cast("long").alias("n_ids"),
                       F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"), F.col("text").alias("decoded"))


def op4_document_round_trip(spark, sf_dir):
    """Every document with the ids of its whole text and the text decoded from them."""
    import public_tokenizers

    pieces, first_byte = sentencepiece_lattice.piece_table(spark, str(public_tokenizers.path("piece_bpe_32k.model")))
    return sentencepiece_lattice.round_trip(read_documents(spark, sf_dir), pieces, first_byte)


def op5_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(read_documents(spark, sf_dir))


def op6_best_fit_packing(spark, sf_dir):
    return best_fit_packing.pack(read_documents(spark, sf_dir))


def op7_token_file(spark, sf_dir):
    import public_tokenizers

    shards = token_file.write_tokens(read_documents(spark, sf_dir), str(public_tokenizers.path("byte_bpe_50k.json")))
    return token_file.read_tokens(shards)


def op8_quality_rules(spark, sf_dir):
    entries = quality_rules.verdicts(quality_rules.ledger(read_documents(spark, sf_dir)))
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                          "failed", "n_lines", "n_capitals")


def quality_ablations(spark, sf_dir):
    """What each rule of each policy costs: one ledger over all documents, then bit operations."""
    return quality_rules.ablations(quality_rules.ledger(read_documents(spark, sf_dir)))


def op9_lm_score(spark, sf_dir):
    """Documents labelled good are the target, all documents the background."""
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    return lm_score.cross_entropy_difference(read_documents(spark, sf_dir), good)


def op10_suffix_dedup(spark, sf_dir):
    return suffix_dedup.digests(read_documents(spark, sf_dir))


def op11_phrase_mining(spark, sf_dir):
    return phrase_mining.collocations(read_documents(spark, sf_dir))


def op12_license_scan(spark, sf_dir):
    return license_scan.license_scan(read_documents(spark, sf_dir))


def op13_fill_in_middle(spark, sf_dir):
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(fill_in_middle.store_frames(read_documents(spark, sf_dir))))


def registry():
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_ngram_jaccard": op3_ngram_jaccard,
        "op4_document_round_trip": op4_document_round_trip,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_fingerprints": op5_fingerprints,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_token_file": op7_token_file,
        "op8_quality_rules": op8_quality_rules,
        "quality_ablations": quality_ablations,
        "op9_lm_score": op9_lm_score,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_phrase_mining": op11_phrase_mining,
        "op12_license_scan": op12_license_scan,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


def oracle_sql():
    return {
        "op8_quality_rules": quality_rules.ORACLE_SQL,
        "quality_ablations": quality_rules.ABLATION_SQL,
        "op12_license_scan": license_scan.oracle_sql(),
        "op13_fill_in_middle": fill_in_middle.ORACLE_SQL,
    }
