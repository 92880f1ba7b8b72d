"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on statistics of labelled texts; every path from a root is a rule, a
conjunction of thresholds. A logistic regression with an L1 penalty weighs the rules and drops most
of them. What remains is compiled into one Spark column expression over the statistics, so scoring
needs no model object.

Statistics come from the text alone: labels, language, source and ids are never inputs. Fitting
reads rows that are not held out and have a label, ``max_rows`` of them in expectation, chosen by a
hash of the id when there are more. With no label at all every score is 0.5; with one class only it
is that class's smoothed share.

Null text counts as empty, and empty texts get a score like any other. Repeated rows each get a
row; a document with several labels counts with each. A score of 0.5 itself counts as accepted. Only ``doc_id``, ``text`` and the label are read.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import bytes_of, column, documents, per_row, stored
from tickloom.llm.language_id import held_out
from tickloom.llm.line_cleaning import ODD_WORD, SEPARATORS, SYMBOLS, repeated_words

STATISTICS = (
    "words", "word_length", "line_words", "symbol_share", "odd_word_share", "separator_share", "upper_share",
    "digit_share", "distinct_share", "repeat_share", "dup_line_share", "sentence_end_share", "comma_share",
    "longest_word",
)
UPPER, LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
ENDS = (b".", b"!", b"?", b'."', "…".encode(), "。".encode())
MAX_ROWS = 50_000


def _count(data: bytes, of: bytes) -> int:
    return len(data) - len(data.translate(None, of))


def statistics_of(data: bytes) -> tuple[float, ...]:
    """The values of ``STATISTICS`` for one text; shares of nothing are 0."""
    words = data.split()
    n = len(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    longest = max(map(len, words), default=0)
    odd = sum(1 for w in words if ODD_WORD.search(w)) if ODD_WORD.search(data) else 0
    separators = sum(1 for w in words if w in SEPARATORS)
    chars = sum(map(len, words))
    return (
        float(n),
        chars / max(1, n),
        n / max(1, len(lines)),
        _count(data, SYMBOLS) / max(1, chars),
        odd / max(1, n),
        separators / max(1, n),
        _count(data, UPPER) / max(1, _count(data, LETTERS)),
        _count(data, b"0123456789") / max(1, chars),
        len(set(words)) / max(1, n),
        repeated_words(words) / max(1, n),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(1 for x in lines if x.rstrip().endswith(ENDS)) / max(1, len(lines)),
        data.count(b",") / max(1, n),
        float(longest),
    )


def _make():
    def run(batch):
        rows = [statistics_of(x) for x in bytes_of(batch)]
        return {name: [r[i] for r in rows] for i, name in enumerate(STATISTICS)}

    return run


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``STATISTICS`` per row."""
    fields = ", ".join(f"{s} double" for s in STATISTICS)
    return per_row(docs, _make, [("doc_id", "doc_id"), ("text", "text")], fields)


Rule = tuple[tuple[str, str, float], ...]  # (statistic, "<=" or ">", threshold), all to hold

_STEP = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([-+0-9.eE]+)\)$")


def rules_of(printed: str) -> list[Rule]:
    """All paths from a root, whole or cut short, of trees as Spark prints them."""
    path: list[tuple[int, tuple[str, str, float]]] = []
    found: dict[Rule, None] = {}
    for line in printed.splitlines():
        step = _STEP.match(line)
        if step:
            depth = len(step[1])
            path = [p for p in path if p[0] < depth] + [(depth, (STATISTICS[int(step[3])], step[4], float(step[5])))]
            found[tuple(c for _, c in path)] = None
        elif line.strip().startswith("Tree"):
            path = []
    return list(found)


def holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (F.col(s) <= v if op == "<=" else F.col(s) > v for s, op, v in rule))


class RuleEnsemble:
    """Weighted rules; ``score`` compiles them into a column over ``STATISTICS``."""

    def __init__(self, weights: dict[Rule, float], intercept: float):
        self.weights, self.intercept = weights, intercept

    def score(self) -> Column:
        parts = [F.when(holds(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.weights.items()]
        total = reduce(lambda a, b: a + b, parts, F.lit(self.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


class Constant(RuleEnsemble):
    """The same score for every text, for training data without two classes."""

    def __init__(self, value: float):
        super().__init__({}, 0.0)
        self.value = value

    def score(self) -> Column:
        return F.lit(self.value)


def training_rows(stats: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """Statistics and ``label`` (0.0 or 1.0) of rows that may be learned from."""
    known = labels.select(column("doc_id").alias("id"), column(label).cast("double").alias("label")).where("label IN (0, 1)")
    known = known.where(~held_out(F.col("id")))
    share = max_rows / max(1, known.count())
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    return stats.join(known, F.col("doc_id") == F.col("id")).select("label", *STATISTICS)


def fit(rows: DataFrame, trees: int = 16, depth: int = 3, penalty: float = 0.001, seed: int = 1) -> RuleEnsemble:
    """Rules from trees, weights from an L1 logistic regression; ``rows``: label and statistics."""
    spark = rows.sparkSession
    classes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        return Constant((classes.get(1.0, 0) + 1) / (sum(classes.values()) + 2) if classes else 0.5)
    few = rows.coalesce(max(1, min(8, spark.sparkContext.defaultParallelism)))
    features = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(few)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="0.4", subsamplingRate=0.8, seed=seed)
    rules = rules_of(forest.fit(features.select("label", "features")).toDebugString)
    if not rules:
        return Constant((classes[1.0] + 1) / (sum(classes.values()) + 2))
    marked = few.select("label", *(holds(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)))
    vectors = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(marked)
    lasso = LogisticRegression(regParam=penalty, elasticNetParam=1.0, maxIter=40).fit(vectors.select("label", "features"))
    weights = {r: float(w) for r, w in zip(rules, lasso.coefficients.toArray()) if w}
    return RuleEnsemble(weights, float(lasso.intercept))


def learned(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, RuleEnsemble]:
    """The statistics of all documents, written once, and the rules learned from the labelled ones."""
    stats = stored(statistics(docs), "statistics")
    return stats, fit(stored(training_rows(stats, labels), "training"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score, predicted`` per row of ``docs``, learned from their labels."""
    stats, model = learned(docs, labels)
    scored = stats.select("doc_id", model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns.

    The verdict needs a row's text alone, so statistics are taken again on the way rather than
    joined: texts are not shuffled.
    """
    _, model = learned(docs, labels)
    names = [f"__c{i}" for i in range(len(docs.columns))]
    fields = ", ".join(f"{s} double" for s in STATISTICS)
    rows = per_row(docs, _make, [*zip(docs.columns, names), ("text", "text")], fields)
    good = rows.where(model.score() >= 0.5)
    return good.select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
