"""Secret scans: candidate strings, and a random forest that removes false positives.

Candidates are long runs of key-like characters with a digit, and runs of any length to which
a key-like name is assigned; a word may hold many. The forest, Spark ML's, sees
their length, entropy, character transitions, dictionary coverage, path and neighbouring
words; it is trained on labelled findings. Transitions and the dictionary come from the
words of all documents. DataFrame functions only on the way of the texts.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.words import split_words
from reelrank.sources.durable import durable

#: At least 16 key-like characters, one of them a digit.
LONG_RUN = (
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}"
    r"(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
)
#: A key-like name; the group is its telling part.
KEY_NAME = (
    r"((?i:token|secret|password|passwd|passphrase|pwd|credential|key))"
    r"(?i:s)?(?:[_.-][A-Za-z0-9_.-]{0,24})?[\"'\])]{0,3}"
)
#: What stands between a name and its value.
LINK = r"[:=]{1,2}>?[\"'(\[]{0,2}"
#: A value of any length from 4 on, with or without a digit, to which a key-like name is assigned.
NAMED_RUN = (
    rf"(?<=[:=>\"'(\[])(?<={KEY_NAME}{LINK})[A-Za-z0-9+/_.@!#$%^*~?-]{{3,}}"
    r"[A-Za-z0-9+/_@!#$%^*~-](?:={1,2}(?![A-Za-z0-9+/_=-]))?"
)
CANDIDATE = f"{NAMED_RUN}|{LONG_RUN}"
#: A text that may have a candidate.
_TEXT = rf"{LONG_RUN}|{KEY_NAME}[\x20\x09-\x0D]*[:=]"
#: Characters of a neighbour that are kept: a word may be a whole file.
NEAR_CHARS = 96
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
#: Most frequent words that make up the dictionary.
DICTIONARY_WORDS = 2000
#: Labelled findings that the forest is trained on, at most.
TRAINING_ROWS = 20_000
TREES, DEPTH, SEED = 30, 6, 17
#: Buckets of neighbouring words and of the path.
WORD_BUCKETS, PATH_BUCKETS = 32, 16
#: Least probability of a finding that is kept.
MIN_PROBABILITY = 0.5

_KEY = ("doc_id", "word_no", "match_no")
_FEATURES = (
    "f_length",
    "f_entropy",
    "f_switches",
    "f_transitions",
    "f_digits",
    "f_coverage",
    "f_path",
    "f_path_depth",
    "f_before",
    "f_before_two",
    "f_after",
    "f_assigned",
    "f_quoted",
    "f_named",
)


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """``(doc_id, path, word_no, match_no, candidate, lead, name, before, before_two, after)``.

    One row per candidate, numbered from 0 within its word as the word is within its text.
    ``lead`` is what stands before it in the word; a key-like name that the words before
    assign to it is put in front. ``name`` is the telling part of such a name, or empty.
    Neighbours that are missing are empty. Texts without any candidate are passed over before
    they are split.
    """
    at = F.col("_words")
    near = lambda i: F.coalesce(F.get(at, i), F.lit(""))
    tail = lambda c: F.substring(c, -NEAR_CHARS, NEAR_CHARS)

    def named(i: Column) -> Column:
        """The word with the name that the words before assign to it."""
        before = tail(near(i - 1))
        opens = F.rlike(near(i), F.lit("^[:=]"))
        both = F.concat(tail(near(i - 2)), F.lit(" "), before)
        name = F.when(opens, F.regexp_extract(before, f"{KEY_NAME}$", 1)).otherwise(
            F.regexp_replace(F.regexp_extract(both, f"{KEY_NAME} ?{LINK}$", 1), "$", "=")
        )
        return F.concat(F.when(name != "=", name).otherwise(F.lit("")), near(i))

    def placed(i: Column) -> Column:
        linked = F.rlike(near(i), F.lit("^[:=]")) | F.rlike(near(i - 1), F.lit(f"{LINK}$"))
        return F.rlike(near(i), F.lit(CANDIDATE)) | (
            linked & F.rlike(named(i), F.lit(CANDIDATE))
        )

    no = F.col("word_no")
    matches = F.transform(
        "_found",
        lambda found, j: F.struct(
            j.alias("match_no"),
            found.alias("candidate"),
            tail(
                F.concat(F.coalesce(F.get("_found", j - 1), F.lit("")), F.get("_between", j))
            ).alias("lead"),
            F.substring(F.get("_between", j + 1), 1, NEAR_CHARS).alias("follow"),
        ),
    )
    places = F.filter(F.sequence(F.lit(0), F.size(at) - 1), placed)
    rows = (
        docs.filter(F.rlike("text", F.lit(_TEXT)))
        .select(
            "doc_id",
            F.col(path).cast("string").alias("path"),
            split_words(F.col("text")).alias("_words"),
        )
        .select("*", F.explode(places).alias("word_no"))
        .select(
            "doc_id",
            "path",
            "word_no",
            named(no).alias("_word"),
            tail(near(no - 1)).alias("before"),
            tail(near(no - 2)).alias("before_two"),
            F.substring(near(no + 1), 1, NEAR_CHARS).alias("after"),
        )
        .withColumn("_found", F.regexp_extract_all("_word", F.lit(CANDIDATE), 0))
        .withColumn("_between", F.split("_word", CANDIDATE, -1))
        .select(
            "doc_id", "path", "word_no", "before", "before_two", "after",
            F.explode(matches).alias("m"),
        )
        .select("doc_id", "path", "word_no", "m.*", "before", "before_two", "after")
    )
    # Within a word the neighbours are what stands there.
    inner = F.rlike("lead", F.lit("[A-Za-z0-9]"))
    return rows.select(
        "doc_id",
        "path",
        "word_no",
        "match_no",
        "candidate",
        "lead",
        F.lower(F.regexp_extract("lead", f"{KEY_NAME}{LINK}$", 1)).alias("name"),
        F.when(inner, F.col("lead")).otherwise(F.col("before")).alias("before"),
        F.when(inner & (F.col("match_no") > 0), F.col("before")).otherwise(F.col("before_two")).alias("before_two"),
        F.when(F.rlike("follow", F.lit("[A-Za-z0-9]")), F.col("follow")).otherwise(F.col("after")).alias("after"),
    )


def vocabulary(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of the lowered words of all texts that are letters only."""
    rows = docs.select(F.explode(split_words(F.lower("text"))).alias("word"))
    counted = rows.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    letters = F.regexp_replace("word", "[^a-z0-9]+", "")
    return counted.select(letters.alias("word"), "n").filter(F.length("word") > 1)


def _place(char: Column) -> Column:
    return F.instr(F.lit(ALPHABET), char) - 1


def transition_table(words: DataFrame) -> DataFrame:
    """One row, ``logs array<double>``: log P(next | character), 36 x 36 in order."""
    size = len(ALPHABET)
    pair = F.explode(
        F.transform(
            F.sequence(F.lit(1), F.length("word") - 1),
            lambda i: F.substr(F.col("word"), i, F.lit(2)),
        )
    )
    code = _place(F.substring("pair", 1, 1)) * size + _place(F.substring("pair", 2, 1))
    seen = (
        words.select(pair.alias("pair"), "n")
        .groupBy(code.alias("code"))
        .agg(F.sum("n").alias("n"))
    )
    every = words.sparkSession.range(size * size).select(F.col("id").cast("int").alias("code"))
    filled = every.join(F.broadcast(seen), "code", "left").select(
        "code", (F.coalesce("n", F.lit(0)) + 1).alias("n")
    )
    first = F.floor(F.col("code") / size)
    totals = filled.groupBy(first.alias("first")).agg(F.sum("n").alias("total"))
    joined = filled.withColumn("first", first).join(totals, "first")
    rows = joined.agg(F.sort_array(F.collect_list(F.struct("code", "n", "total"))).alias("rows"))
    return rows.select(
        F.transform("rows", lambda row: F.log(row["n"] / row["total"])).alias("logs")
    )


def dictionary(words: DataFrame, limit: int = DICTIONARY_WORDS) -> DataFrame:
    """One row, ``dictionary array<string>``: the most frequent words of three letters on."""
    letters = words.filter(F.rlike("word", F.lit("^[a-z]{3,}$")))
    top = letters.groupBy("word").agg(F.sum("n").alias("n"))
    top = top.orderBy(F.desc("n"), "word").limit(limit)
    return top.agg(F.sort_array(F.collect_list("word")).alias("dictionary"))


def _kind(char: Column) -> Column:
    return (
        F.when(F.rlike(char, F.lit("[a-z]")), 1)
        .when(F.rlike(char, F.lit("[A-Z]")), 2)
        .when(F.rlike(char, F.lit("[0-9]")), 3)
        .otherwise(4)
    )


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the forest's features; ``words`` is the :func:`vocabulary`."""
    chars = F.split("candidate", "")
    length = F.length("candidate").cast("double")
    share = lambda c: F.size(F.filter("_chars", lambda x: x == c)) / length
    entropy = F.aggregate(
        F.array_distinct("_chars"),
        F.lit(0.0),
        lambda acc, c: acc - share(c) * F.log2(share(c)),
    )
    kinds = F.transform("_chars", _kind)
    pairs = F.zip_with(
        F.slice("_kinds", 1, F.size("_kinds") - 1),
        F.slice("_kinds", 2, F.size("_kinds") - 1),
        lambda a, b: (a != b).cast("int"),
    )
    low = F.transform("_chars", lambda c: _place(F.lower(c)))
    logs = F.zip_with(
        F.slice("_low", 1, F.size("_low") - 1),
        F.slice("_low", 2, F.size("_low") - 1),
        lambda a, b: F.when(
            (a >= 0) & (b >= 0), F.get(F.col("_logs"), a * len(ALPHABET) + b)
        ).otherwise(F.lit(-6.0)),
    )
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)
    runs = F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{3,}"), 0)
    known = F.filter(runs, lambda run: F.array_contains(F.col("_dictionary"), run))
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")
    bucket = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("double")
    path = F.coalesce("path", F.lit(""))
    return (
        found.withColumn("_logs", transition_table(words).scalar())
        .withColumn("_dictionary", dictionary(words).scalar())
        .withColumn("_chars", chars)
        .withColumn("_kinds", kinds)
        .withColumn("_low", low)
        .withColumn("f_length", length)
        .withColumn("f_entropy", entropy)
        .withColumn("f_switches", total(pairs) / length)
        .withColumn("f_transitions", total(logs) / length)
        .withColumn("f_digits", F.size(F.filter("_kinds", lambda k: k == 3)) / length)
        .withColumn("f_coverage", total(F.transform(known, F.length)) / length)
        .withColumn("f_path", bucket(path, PATH_BUCKETS))
        .withColumn("f_path_depth", F.size(F.split(path, "/")).cast("double"))
        .withColumn("f_before", bucket(bare(F.col("before")), WORD_BUCKETS))
        .withColumn("f_before_two", bucket(bare(F.col("before_two")), WORD_BUCKETS))
        .withColumn("f_after", bucket(bare(F.col("after")), WORD_BUCKETS))
        .withColumn("f_assigned", F.rlike("before", F.lit("^[=:]|[=:][\"'(\\[]*$")).cast("double"))
        .withColumn("f_quoted", F.rlike("lead", F.lit("[\"']$")).cast("double"))
        .withColumn("f_named", (F.col("name") != "").cast("double"))
        .drop("_logs", "_dictionary", "_chars", "_kinds", "_low")
    )


def train(labelled: DataFrame, rows: int = TRAINING_ROWS) -> PipelineModel:
    """A forest from ``labelled``: features and ``secret`` (0 or 1).

    The ``rows`` first findings in a hash order are used, in that order, so that training
    repeats itself. They must hold one finding at least.
    """
    sample = (
        labelled.select(*_KEY, *_FEATURES, F.col("secret").cast("double"))
        .orderBy(F.xxhash64(*_KEY), *_KEY)
        .limit(rows)
    )
    forest = RandomForestClassifier(
        labelCol="secret",
        featuresCol="features",
        numTrees=TREES,
        maxDepth=DEPTH,
        seed=SEED,
        cacheNodeIds=False,
    )
    assembler = VectorAssembler(inputCols=list(_FEATURES), outputCol="features")
    return Pipeline(stages=[assembler, forest]).fit(durable(sample, "findings"))


def scan(
    docs: DataFrame,
    labelled: DataFrame,
    path: str = "source",
    training_rows: int = TRAINING_ROWS,
    min_probability: float = MIN_PROBABILITY,
) -> DataFrame:
    """Findings ``(doc_id, path, word_no, match_no, candidate, probability, kept)`` of all ``docs``.

    ``labelled`` has ``doc_id, word_no, match_no, secret``: which of the findings in some documents are
    secrets. Null texts have no findings; rows that repeat give their findings again; an
    empty table gives an empty result. Without both labels there is nothing to learn, and all
    findings are kept with probability null.
    """
    features = durable(with_features(candidates(docs, path), durable(vocabulary(docs))), "found")
    known = features.join(
        labelled.select(*_KEY, "secret").distinct(), list(_KEY)
    )
    fields = ["doc_id", "path", "word_no", "match_no", "candidate"]
    if known.select("secret").distinct().limit(2).count() < 2:
        return features.select(
            *fields, F.lit(None).cast("double").alias("probability"), F.lit(True).alias("kept")
        )
    judged = train(known, training_rows).transform(features)
    probability = F.round(vector_to_array("probability")[1], 6)
    return judged.select(*fields, probability.alias("p")).select(
        *fields, F.col("p").alias("probability"), (F.col("p") >= min_probability).alias("kept")
    )


def rule_labels(found: DataFrame) -> DataFrame:
    """Labels by a rule, for want of a person's: a secret (1) is a run of 8 or more, of mixed
    letters and digits, to which a key-like name is assigned, in any spacing or quoting; no
    secret (0) is a run of digits alone without such a name. Other findings have no label."""
    named = F.col("name") != ""
    mixed = F.rlike("candidate", F.lit("[A-Za-z]")) & F.rlike("candidate", F.lit("[0-9]"))
    secret = F.when(named & mixed & (F.length("candidate") >= 8), 1).when(
        ~named & F.rlike("candidate", F.lit("^[0-9+/_=-]+$")), 0
    )
    return found.select(*_KEY, secret.alias("secret")).filter("secret is not null")
