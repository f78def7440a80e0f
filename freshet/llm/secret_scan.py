"""Secret scans: a random forest over findings removes false positives.

Only DataFrame functions and Spark's own forest are used; nothing leaves the JVM.
"""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from freshet.llm.common import GAPS, row_key
from freshet.sources.layers import materialise

CHARS = "A-Za-z0-9_+/=\\-"
CANDIDATE = f"(?<![{CHARS}])(?=[{CHARS}]*[0-9])[{CHARS}]{{16,}}"
CONTEXT = 40              # characters kept on either side of a finding
TRAIN_ROWS = 20_000       # bound of the labelled sample the forest is fitted on
DICTIONARY_COUNT = 5      # a word of the dictionary occurs at least so often in the corpus
TREES, DEPTH, SEED = 30, 6, 17
KEYWORDS = "(?i)(token|secret|passw|pwd|api.?key|access.?key|private.?key|credential|auth|bearer)"
PLACEHOLDER = "(?i)(example|sample|dummy|changeme|xxxx|0000000|1234567)"
FEATURES = [
    "length", "runs", "letter_to_digit", "digit_to_letter", "case_changes", "digits", "capitals", "hex", "vowels", "variety",
    "dictionary", "path_depth", "path_test", "keyword_before", "assigned", "quoted", "address_before", "words_around",
]


def findings(docs, path="source"):
    """One row per candidate: doc_id, path, start (characters before it), finding, before, after.

    A candidate is a run of at least 16 characters of keys and encodings that holds a digit. Documents without one
    leave the plan before anything is shuffled. A null text has none; a null or absent path is an empty one.
    """
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path in docs.columns else F.lit("")
    df = docs.select(F.col("doc_id"), where.alias("path"), F.col("text")).where(F.col("text").rlike(CANDIDATE))
    df = df.select("doc_id", "path", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("hits"),
                   F.split("text", CANDIDATE, -1).alias("gaps"), F.monotonically_increasing_id().alias("__row"))
    parts = F.transform("hits", lambda h, i: F.struct(
        i.alias("at"), h.alias("finding"), F.char_length(F.get("gaps", i)).alias("gap"),
        F.right(F.get("gaps", i), F.lit(CONTEXT)).alias("before"), F.left(F.get("gaps", i + 1), F.lit(CONTEXT)).alias("after")))
    df = df.select("doc_id", "path", "__row", F.inline(parts))
    # The window holds the findings of one document.
    ahead = Window.partitionBy("__row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = F.sum(F.col("gap") + F.char_length("finding")).over(ahead)
    return df.select("doc_id", "path", (ends - F.char_length("finding")).cast("long").alias("start"), "finding", "before", "after")


def dictionary(docs, least=DICTIONARY_COUNT):
    """Words of four and more letters that occur at least `least` times in all texts, lower-cased."""
    words = docs.select(F.explode(F.split(F.lower("text"), GAPS)).alias("word"))
    words = words.select(F.regexp_extract("word", "^([a-z]{4,20})[.,;:!?]*$", 1).alias("word")).where("word != ''")
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("word")


def featurize(found, words):
    """Findings with their features: shape of the candidate, dictionary coverage, path and neighbouring words."""
    c = F.col("finding")
    size = F.char_length(c).cast("double")
    kinds = c
    for chars, sign in (("[a-z]", "l"), ("[A-Z]", "U"), ("[0-9]", "0"), ("[^lU0]", "-")):
        kinds = F.regexp_replace(kinds, chars, sign)
    share = lambda keep: (size - F.char_length(F.regexp_replace(c, keep, ""))) / size
    shaped = found.withColumn("__k", kinds).withColumn("__id", F.xxhash64("doc_id", "start", "finding"))
    turns = lambda pattern: F.regexp_count("__k", F.lit(pattern)) / size
    flag = lambda cond: cond.cast("double")
    shaped = shaped.withColumns({
        "length": size, "runs": F.char_length(F.regexp_replace("__k", "(.)\\1+", "$1")) / size,
        "letter_to_digit": turns("[lU](?=0)"), "digit_to_letter": turns("0(?=[lU])"), "case_changes": turns("l(?=U)|U(?=l)"),
        "digits": share("[0-9]"), "capitals": share("[A-Z]"), "hex": share("[0-9a-fA-F]"), "vowels": share("(?i)[aeiou]"),
        "variety": F.size(F.array_distinct(F.split(c, ""))) / size,
        "path_depth": F.regexp_count("path", F.lit("[/\\\\.]")).cast("double"),
        "path_test": flag(F.col("path").rlike("(?i)test|example|sample|doc|fixture|mock")),
        "keyword_before": flag(F.col("before").rlike(KEYWORDS)), "assigned": flag(F.col("before").rlike("[=:]\\s*[\"']?$")),
        "quoted": flag(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")),
        "address_before": flag(F.col("before").rlike("(://|@|www\\.)\\S*$")),
        "words_around": F.size(F.filter(F.split(F.concat_ws(" ", "before", "after"), GAPS), lambda w: w.rlike("^[A-Za-z]{2,}$"))).cast("double"),
    })
    runs = shaped.select("__id", F.explode(F.regexp_extract_all(F.lower("finding"), F.lit("[a-z]{4,20}"), F.lit(0))).alias("word"))
    spelt = runs.join(words, "word").groupBy("__id").agg(F.sum(F.char_length("word")).alias("spelt"))
    # Several rows share an id only if they are repeats of one finding, whose coverage is then counted once per repeat.
    repeats = shaped.groupBy("__id").agg(F.count("*").alias("times"))
    cover = spelt.join(repeats, "__id").select("__id", (F.col("spelt") / F.col("times")).alias("spelt"))
    out = shaped.join(cover, "__id", "left").withColumn("dictionary", F.coalesce("spelt", F.lit(0.0)) / F.col("length"))
    return out.select(*found.columns, *FEATURES)


def evident_labels(rows):
    """Labels from plain evidence, null where there is none.

    1: assigned to a name that says it is a credential, not spelt with words. 0: digits only, mostly words, a
    placeholder, or part of an address.
    """
    yes = (F.col("keyword_before") == 1) & (F.col("assigned") == 1) & (F.col("dictionary") < 0.5) & (F.col("digits") < 1)
    no = (F.col("digits") == 1) | (F.col("dictionary") >= 0.5) | (F.col("address_before") == 1)
    fake = F.col("finding").rlike(PLACEHOLDER)
    return F.when(fake | no, 0.0).when(yes, 1.0)


def train(labelled, rows=TRAIN_ROWS):
    """Forest fitted on labelled findings (FEATURES and `label`), or None if one of the two labels is missing.

    A finding counts once per label, however often it is copied. At most `rows` are used, taken from both labels in
    turn by the smallest hashes of their content, so the sample is the same on every run and holds both labels if there
    are both. This is the only place where rows are left out; every finding is scored.
    """
    content = F.struct(F.xxhash64("finding", "before", "after").alias("h"), *FEATURES)
    once = labelled.where("label is not null").groupBy("finding", "label").agg(F.min(content).alias("x")).select("label", "x.*")
    once = materialise(once, "secret-labels")
    first = [once.where(F.col("label") == k).orderBy("h", *FEATURES).limit(rows) for k in (0, 1)]
    # The window holds at most `rows` findings of each label.
    turn = F.row_number().over(Window.partitionBy("label").orderBy("h", *FEATURES))
    both = first[0].unionByName(first[1]).withColumn("turn", turn)
    sample = materialise(both.orderBy("turn", "label").limit(rows).select(*FEATURES, "label").coalesce(1), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="x").transform(sample))


def score(rows, model):
    """Findings with p_secret; without a model the evidence alone decides, and what has none is no secret."""
    if model is None:
        return rows.withColumn("p_secret", F.coalesce(evident_labels(rows), F.lit(0.0)))
    seen = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="x").transform(rows))
    return seen.withColumn("p_secret", vector_to_array("probability")[1]).drop("x", "rawPrediction", "probability", "prediction")


def scan(docs, labelled=None, reviewed=None, path="source", least=0.5):
    """Findings of all texts: doc_id, path, start, finding, before, after, FEATURES, p_secret, is_secret.

    `labelled` are findings with FEATURES and `label`; without them, the findings of the reviewed documents (a table
    of doc_id; all documents if None) are labelled by evident_labels. Findings are written once, so texts are read once
    for them and once for the dictionary. Texts that are null or empty have no findings; repeated rows
    repeat their findings; other columns are ignored.
    """
    found = materialise(findings(docs, path), "findings")
    rows = materialise(featurize(found, dictionary(docs)), "features")
    if labelled is None:
        known = rows if reviewed is None else rows.join(reviewed.select("doc_id").distinct(), "doc_id", "left_semi")
        labelled = known.withColumn("label", evident_labels(known))
    out = score(rows, train(labelled))
    return out.withColumn("is_secret", F.col("p_secret") >= least)


def redact(docs, mark="[SECRET]", **options):
    """The documents, all columns, with every secret replaced by `mark`; rows sharing a doc_id share their secrets, rows
    without one are known by their text."""
    found = scan(docs.withColumn("doc_id", row_key()), **options).where("is_secret").groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set("finding").alias("__s"))
    # Longest first, so that a secret inside another does not cut it.
    order = F.sort_array(F.transform("__s", lambda s: F.struct((-F.char_length(s)).alias("n"), s.alias("s"))))
    text = F.aggregate(order, F.col("text"), lambda t, s: F.replace(t, s["s"], F.lit(mark)))
    docs = docs.withColumn("__key", row_key())
    joined = docs.join(found, F.col("__key") == F.col("__id"), "left")
    return joined.select(*[(F.when(F.col("__s").isNull(), F.col("text")).otherwise(text).alias(c) if c == "text" else docs[c]) for c in docs.columns if c != "__key"])
