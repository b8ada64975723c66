"""Secret scans with a random forest that removes false positives, in DataFrame functions and MLlib only.

Candidates are runs of at least ``MIN_LENGTH`` characters of keys, tokens, paths and addresses that hold a digit or mix
cases. A candidate is described by its length, the transitions between its kinds of characters, how much of it is
dictionary words (lower-case words that stand alone in ``DICTIONARY_DOCS`` documents or more), what makes it look like a
path or an address, and its neighbouring words. MLlib's forest is trained on labelled findings: given ones, or those
that known formats decide (``format_label``: a value assigned to a name for secrets, or a provider's prefix; against
them card and phone numbers, addresses, placeholders, words). Candidates no format decides get the forest's verdict too.

At most ``PER_CLASS`` findings of a label are fitted on, first in the order of a hash, from the fitting folds; counts of
the dictionary cover all documents. Without both labels every score is 0.5 and nothing is removed. Null and empty texts
have no candidates; repeated rows repeat their findings; null ids keep theirs (and are never fitted on). Other columns
are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.labelled import held_out
from ebbtide.sources.storage import scratch_path, through_table

MIN_LENGTH = 16
CONTEXT = 48
DICTIONARY_DOCS = 3
PER_CLASS = 5000
BROADCAST_ROWS = 1_000_000
TREES, DEPTH, SEED = 40, 6, 7
THRESHOLD = 0.5
WORD_SLOTS = 64
CANDIDATE = f"[A-Za-z0-9_+/.@~-]{{{MIN_LENGTH},}}={{0,2}}"
# Names that values are assigned to, and prefixes that providers publish.
SECRET_NAMES = r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|auth|bearer|credential|private[_-]?key)"
PREFIXES = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abprs]-.+|sk_(live|test)_.+|AIza[0-9A-Za-z_-]{35}|eyJ[0-9A-Za-z_-]+\..+)"
PLACEHOLDER = r"(?i)(example|sample|dummy|placeholder|changeme|your[_-]|xxxx|0000000000|1234567890)"
ADDRESS = r"(@|^[0-9./-]+$|^//|^www\.|^(\d{1,3}\.){3}\d{1,3})"
KINDS = "luds"  # lower, upper, digit, symbol


def kinds(text: Column) -> Column:
    """The kind of each character, as a string of ``KINDS``."""
    for pattern, kind in (("[a-z]", "l"), ("[A-Z]", "\u0001"), ("[0-9]", "\u0002"), ("[^l\u0001\u0002]", "s")):
        text = F.regexp_replace(text, pattern, kind)
    return F.translate(text, "\u0001\u0002", "ud")


def findings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc, ordinal, candidate, before, after) for every candidate of every text."""
    text = F.col(text_column)
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    rows = docs.select(F.col(id_column).alias("doc"), found.alias("found"), F.split(text, CANDIDATE, -1).alias("gaps"))
    rows = rows.filter(F.size("found") > 0).select(
        "doc", F.posexplode(F.arrays_zip(
            F.col("found").alias("candidate"),
            F.transform("gaps", lambda gap: F.right(gap, F.lit(CONTEXT))).alias("before"),
            F.slice(F.transform("gaps", lambda gap: F.left(gap, F.lit(CONTEXT))), F.lit(2), F.size("found")).alias("after"),
        )).alias("ordinal", "f"),
    ).select("doc", "ordinal", "f.candidate", "f.before", "f.after")
    mixed = F.col("candidate").rlike("[0-9]") | (F.col("candidate").rlike("[a-z]") & F.col("candidate").rlike("[A-Z]"))
    return rows.filter(F.col("candidate").isNotNull() & mixed)


def covered(found: DataFrame, docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(candidate, coverage): the share of its characters in dictionary words."""
    spark = found.sparkSession
    runs = found.select("candidate").distinct().select(
        "candidate", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{4,}"), F.lit(0))).alias("word")
    )
    runs = through_table(runs, scratch_path(spark, "secret-runs"))
    wanted = runs.select("word").distinct()
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    words = docs.select(
        F.xxhash64(id_column, text_column).alias("row"), F.explode(F.split(F.lower(text_column), "[^a-z]+")).alias("word")
    )
    known = (
        words.filter(F.length("word") >= 4).join(wanted, "word").distinct()
        .groupBy("word").agg(F.count("*").alias("docs")).filter(F.col("docs") >= DICTIONARY_DOCS).select("word")
    )
    return runs.join(known, "word").groupBy("candidate").agg(
        (F.sum(F.length("word")) / F.length("candidate")).alias("coverage")
    )


def described(found: DataFrame, coverage: DataFrame) -> DataFrame:
    """Findings with the forest's inputs, the columns that begin with ``f_``."""
    c, size = F.col("candidate"), F.length("candidate").cast("double")
    count = lambda pattern, text=c: F.regexp_count(text, F.lit(pattern)).cast("double")
    near = F.lower("before")
    words = F.regexp_extract_all(near, F.lit("[\\p{L}_]+"), F.lit(0))
    rows = found.withColumn("kinds", kinds(c)).join(coverage, "candidate", "left")
    moves = {
        f"f_{a}{b}": F.regexp_count("kinds", F.lit(f"{a}(?={b})")).cast("double") / F.greatest(size - 1, F.lit(1.0))
        for a in KINDS for b in KINDS
    }
    flags = {
        "f_named": near.rlike(SECRET_NAMES), "f_assigned": F.col("before").rlike("[=:]\\s*[\"'`]?$"),
        "f_quoted": F.col("before").rlike("[\"'`]$"), "f_address": c.rlike(ADDRESS),
        "f_prefix": c.rlike(PREFIXES), "f_placeholder": c.rlike(PLACEHOLDER),
        "f_hex": c.rlike("^[0-9a-fA-F]+$"), "f_digits": c.rlike("^[0-9]+$"), "f_suffix": c.rlike("\\.[a-z]{1,5}$"),
    }
    return rows.select(
        "*", F.least(size, F.lit(400.0)).alias("f_length"), F.coalesce("coverage", F.lit(0.0)).alias("f_coverage"),
        (F.size(F.array_distinct(F.split(c, ""))) / size).alias("f_distinct"),
        *((count(pattern) / size).alias(name) for name, pattern in (("f_slash", "/"), ("f_dot", "\\."), ("f_vowel", "[aeiouAEIOU]"))),
        *(value.alias(name) for name, value in moves.items()),
        *(value.cast("double").alias(name) for name, value in flags.items()),
        F.coalesce(F.try_element_at(words, F.lit(-1)), F.lit("-")).alias("w_last"),
        F.coalesce(F.try_element_at(words, F.lit(-2)), F.lit("-")).alias("w_before"),
    )


def format_label(rows: DataFrame) -> Column:
    """1 or 0 where a known format decides, null elsewhere."""
    against = (
        (F.col("f_placeholder") == 1) | (F.col("f_address") == 1) | (F.col("f_digits") == 1) | (F.col("f_coverage") > 0.6)
    )
    held = (F.col("f_named") == 1) & (F.col("f_assigned") == 1) & (F.col("f_distinct") * F.col("f_length") >= 8)
    return F.when(F.col("f_prefix") == 1, 1).when(against, 0).when(held, 1)


def fit(rows: DataFrame, per_class: int = PER_CLASS, seed: int = SEED) -> PipelineModel | None:
    """A forest on described findings with a column ``label``; None unless both labels occur."""
    spark = rows.sparkSession
    order = F.xxhash64("doc", "ordinal", "candidate")
    parts = [
        rows.filter((F.col("label") == value) & F.col("doc").isNotNull() & ~held_out(F.col("doc")))
        .orderBy(order, "doc", "ordinal").limit(per_class) for value in (0, 1)
    ]
    sample = through_table(parts[0].unionByName(parts[1]), scratch_path(spark, "secret-sample"))
    if sample.select("label").distinct().count() < 2:
        return None
    numbers = sorted(name for name in rows.columns if name.startswith("f_"))
    stages = [
        FeatureHasher(inputCols=["w_last", "w_before"], outputCol="words", numFeatures=WORD_SLOTS),
        VectorAssembler(inputCols=[*numbers, "words"], outputCol="features", handleInvalid="keep"),
        RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=seed),
    ]
    return Pipeline(stages=stages).fit(sample)


def scan(
    docs: DataFrame, labels: DataFrame | None = None, threshold: float = THRESHOLD, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per candidate: id, ``ordinal``, ``candidate_sha256``, ``length``, ``coverage``, ``score``, ``is_secret``.

    ``labels`` (candidate, label), where given, are the labelled findings; formats decide otherwise.
    """
    spark = docs.sparkSession
    found = through_table(findings(docs, id_column, text_column), scratch_path(spark, "secret-findings"))
    rows = described(found, covered(found, docs, id_column, text_column))
    if labels is None:
        rows = rows.withColumn("label", format_label(rows))
    else:
        given = labels.filter("candidate IS NOT NULL AND label IN (0, 1)").groupBy("candidate").agg(
            F.max(F.col("label").cast("int")).alias("label")
        )
        rows = rows.join(given, "candidate", "left")
    rows = through_table(rows, scratch_path(spark, "secret-rows"))
    model = fit(rows)
    score = F.lit(0.5) if model is None else vector_to_array("probability")[1]
    scored = rows if model is None else model.transform(rows)
    return scored.select(
        F.col("doc").alias(id_column), "ordinal", F.sha2("candidate", 256).alias("candidate_sha256"),
        F.length("candidate").alias("length"), F.col("f_coverage").alias("coverage"), score.alias("score"),
        (score >= threshold).alias("is_secret"),
    )
