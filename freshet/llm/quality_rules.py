"""Quality rules as a bitmask ledger: each rule is evaluated once, policies and ablations are bit operations.

Only DataFrame functions are used; nothing leaves the JVM.
"""

from pyspark.sql import functions as F

from freshet.llm.common import GAPS

GAP_CHARS = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5

# bit of each rule -> its failure, on the measurements of a document
RULES = {
    "few_words": lambda c: c("n_words") < 10,
    "repeated_windows": lambda c: 100 * c("n_repeat_words") > 20 * c("n_words"),
    "symbols": lambda c: 10 * c("n_symbols") > c("n_words"),
    "repeated_lines": lambda c: 2 * c("n_dup_lines") > c("n_lines"),
    "word_length": lambda c: (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 12 * c("n_words")),
    "capitals": lambda c: 2 * c("n_capitals") > c("word_chars"),
}
BASE = ["few_words", "repeated_windows"]
POLICIES = {"base": BASE, "v1": [*BASE, "symbols", "repeated_lines"], "v2": list(RULES)}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def rule_bit(rule):
    return 1 << list(RULES).index(rule)


def policy_mask(policy):
    return sum(map(rule_bit, POLICIES[policy]))


def _count_of(text, chars):
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("long")


def measure(docs, text="text"):
    """The documents with their measurements (see MEASURES) appended.

    n_repeat_words counts words inside five-word windows that occur at least twice in the text. Windows are compared
    by a 64-bit hash within one document; the sort that finds their places runs only where hashes repeat.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.columns
    df = docs.select(*[F.col(f"`{c}`") for c in own], F.array_remove(F.split(body, GAPS), "").alias("__w"),
                     F.split(body, "\n").alias("__lines"), body.alias("__t"))
    df = df.select(
        *[F.col(f"`{c}`") for c in own], "__w", F.size("__w").cast("long").alias("n_words"),
        F.filter("__lines", lambda x: F.translate(x, GAP_CHARS, "") != "").alias("__full"),
        F.char_length(F.translate("__t", GAP_CHARS, "")).cast("long").alias("word_chars"),
        _count_of(F.col("__t"), SYMBOLS).alias("n_symbols"), _count_of(F.col("__t"), CAPITALS).alias("n_capitals"))
    last = F.size("__w") - WINDOW
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    window = lambda i: F.xxhash64(*[F.get(F.col("__w"), i + j) for j in range(WINDOW)])
    df = df.withColumn("__h", F.transform(at, window))
    repeats = F.size(F.array_distinct("__h")) < F.size("__h")
    df = df.withColumn("__s", F.when(repeats, F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = lambda x, j, step: F.coalesce(F.get(F.col("__s"), j + step)["h"] == x["h"], F.lit(False))
    df = df.withColumn("__p", F.sort_array(F.transform(
        F.filter("__s", lambda x, j: near(x, j, -1) | near(x, j, 1)), lambda x: x["i"])))
    step = F.transform("__p", lambda p, j: F.least(F.coalesce(F.get(F.col("__p"), j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(step, F.lit(0), lambda a, x: a + x)
    found = F.struct(
        "n_words", "word_chars", "n_symbols",
        (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("__full").cast("long").alias("n_lines"), "n_capitals")
    # Generated columns: a later filter on them is not pushed below, where it would repeat the array work per element.
    return df.select(*[F.col(f"`{c}`") for c in own], F.inline(F.array(found)))


def ledger(docs, key="doc_id", text="text"):
    """One row per document: key, measurements and `failed`, whose bit k is set where rule k fails.

    A null text is an empty one; repeated rows get one entry each; other columns are left out, so none can clash.
    """
    rows = measure(docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")), "__text")
    return rows.select(F.col("__key").alias(key), *MEASURES, failure_bits().alias("failed"))


def failure_bits():
    """Every rule evaluated once on the measurements of a row, as bits."""
    failed = F.lit(0)
    for rule, fails in RULES.items():
        failed = failed.bitwiseOR(F.when(fails(F.col), rule_bit(rule)).otherwise(0))
    return failed


def verdicts(entries, policy="v2"):
    """A ledger with base_failed and the policy's verdict, by bit operations only."""
    failed = F.col("failed")
    base = failed.bitwiseAND(policy_mask("base")) != 0
    return entries.withColumns({"base_failed": base, "kept": ~base & (failed.bitwiseAND(policy_mask(policy)) == 0)})


def ablations(entries):
    """For each policy and each of its rules: documents kept, kept without that rule, and rejected by it alone.

    The ledger shrinks to one row per failure pattern, at most 2**rules, before any policy is applied.
    """
    patterns = entries.groupBy("failed").agg(F.count("*").alias("n"))
    cases = [(p, r, policy_mask(p), rule_bit(r)) for p, rules in POLICIES.items() for r in rules]
    case = F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(m).alias("mask"), F.lit(b).alias("bit"))
                               for p, r, m, b in cases])).alias("c")
    rows = patterns.select("failed", "n", case).select("failed", "n", "c.*")
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias
    return rows.groupBy("policy", "rule").agg(
        total(hit == 0)("kept"), total(hit.bitwiseAND(F.bitwise_not(F.col("bit"))) == 0)("kept_without"),
        total(hit == F.col("bit"))("rejected_alone"))


def keep_good(docs, policy="v2"):
    """The documents that pass the policy, with their own columns (repeated rows kept as they are)."""
    names = [f"__c{i}" for i in range(len(docs.columns))]
    held = docs.toDF(*names)
    text = names[docs.columns.index("text")]
    entries = verdicts(measure(held, text).withColumn("failed", failure_bits()), policy)
    return entries.where("kept").select(*names).toDF(*docs.columns)


_CHARS = r"[^\x20\x09-\x0D]"

_LEDGER_SQL = rf"""
WITH read AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
  split AS (SELECT r, regexp_extract_all(t, '{_CHARS}+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_CHARS}')) AS lines FROM read),
  places AS (SELECT r, unnest(range(1, len(w) - {WINDOW - 2})) AS i,
    unnest(list_transform(range(1, len(w) - {WINDOW - 2}), lambda k: array_to_string(w[k:k + {WINDOW - 1}], ' '))) AS words FROM split),
  windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, words) AS n FROM places),
  steps AS (SELECT r, least({WINDOW}, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, {WINDOW})) AS step FROM windows WHERE n > 1),
  covered AS (SELECT r, sum(step) AS words FROM steps GROUP BY r),
  measured AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(words, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals
    FROM read JOIN split USING (r) LEFT JOIN covered USING (r)),
  ledger AS (SELECT *, CAST((CASE WHEN n_words < 10 THEN {rule_bit("few_words")} ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN {rule_bit("repeated_windows")} ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN {rule_bit("symbols")} ELSE 0 END)
    + (CASE WHEN 2 * n_dup_lines > n_lines THEN {rule_bit("repeated_lines")} ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 12 * n_words THEN {rule_bit("word_length")} ELSE 0 END)
    + (CASE WHEN 2 * n_capitals > word_chars THEN {rule_bit("capitals")} ELSE 0 END) AS INTEGER) AS failed FROM measured)
"""

ORACLE_SQL = _LEDGER_SQL + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & {policy_mask("base")} <> 0 AS base_failed,
  failed & {policy_mask("v2")} = 0 AS kept, failed, n_lines, n_capitals FROM ledger"""

ABLATION_SQL = _LEDGER_SQL + f""", cases(policy, rule, mask, bit) AS (VALUES
  {", ".join(f"('{p}', '{r}', {policy_mask(p)}, {rule_bit(r)})" for p, rules in POLICIES.items() for r in rules)})
SELECT policy, rule, count(*) FILTER (failed & mask = 0) AS kept, count(*) FILTER (failed & mask & ~bit = 0) AS kept_without,
  count(*) FILTER (failed & mask = bit) AS rejected_alone FROM ledger, cases GROUP BY policy, rule"""
