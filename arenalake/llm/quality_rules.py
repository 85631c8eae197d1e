"""Quality of documents by a sparse ensemble of rules.

1. Statistics of a text are Spark columns: sizes, shares of kinds of characters, shares of
   different words and lines.
2. A forest of shallow trees is grown on the statistics of a bounded sample of labelled
   documents. Every path from a root to a node is a rule, a conjunction of bounds on statistics;
   bounds on the same statistic are united and equal rules are one.
3. A logistic regression with a lasso penalty on the rules' truth values leaves few of
   them with a weight.
4. These rules, their weights and the constant are compiled into one Spark column, which
   scores every document without Python.

The sample is bounded: ``SAMPLE_ROWS`` labelled documents of each kind, those with the smallest
hashes of id (one text each, that of the smallest hash, if an id has several). They are weighted
so that both kinds count as in all labels. The statistics of the sample are stored in order,
so that a task that runs again sees the same rows. Everything else reads whole texts of all rows.

Null or empty text: a text without words, whose statistics are 0. Without labels of both kinds
every score is 1, 0 or, without any label, 0.5. Several labels of a document: good if one of
them says so; a null label says nothing. Each row is scored for itself, with a null or repeated id
as well. A very long text costs its list of words in one task. An empty table gives no row.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arenalake.llm.store import shared_folder, stored, texts

SAMPLE_ROWS = 4000
TREES, DEPTH = 20, 3
#: Strength of the lasso penalty.
PENALTY = 0.002
THRESHOLD = 0.5
WORD_SPACE = r"[\x20\x09-\x0D]+"


def _share(characters: str) -> Callable[[], Column]:
    """The share of code points that are in a class of characters, of those that are no small letter."""
    return lambda: _part(F.length(F.regexp_replace("rest", f"[^{characters}]+", "")), F.length("text"))


def _part(amount: Column, of: Column) -> Column:
    return F.when(of > 0, amount / of).otherwise(0.0)


#: Of the columns ``text``, ``words``, ``lines`` and ``rest`` (the text without a-z).
STATISTICS: dict[str, Callable[[], Column]] = {
    "characters": lambda: F.length("text").cast("double"),
    "word_count": lambda: F.size("words").cast("double"),
    "word_length": lambda: _part(F.length(F.array_join("words", "")), F.size("words")),
    "different_words": lambda: _part(F.size(F.array_distinct("words")), F.size("words")),
    "line_length": lambda: _part(F.length("text"), F.size("lines")),
    "different_lines": lambda: _part(F.size(F.array_distinct("lines")), F.size("lines")),
    "capitals": _share("A-Z"),
    "small_letters": lambda: _part(F.length("text") - F.length("rest"), F.length("text")),
    "digits": _share("0-9"),
    "stops": _share(".,;:"),
    "calls": _share("!?"),
    "symbols": _share(r"#$%&*+/<=>@\\^_`|~"),
    "brackets": _share(r"()\[\]{}\"'"),
    "spaces": _share(r" \t\n\r"),
}


def statistics(documents: DataFrame, *more: Column | str) -> DataFrame:
    """``doc_id``, the further columns and ``statistics``, a struct, of every document."""
    rows = texts(documents, *more)
    kept = [x for x in rows.columns if x != "text"]
    words = F.array_remove(F.split("text", WORD_SPACE), "").alias("words")
    lines = F.array_remove(F.split("text", "\n"), "").alias("lines")
    rest = F.regexp_replace("text", "[a-z]+", "").alias("rest")
    values = F.struct(*(value().cast("double").alias(name) for name, value in STATISTICS.items()))
    return rows.select("*", words, lines, rest).select(*kept, values.alias("statistics"))


@dataclass(frozen=True)
class Rule:
    """True if each statistic named in ``bounds`` lies above the first and at most at the second number."""

    bounds: tuple[tuple[str, float, float], ...]

    def holds(self) -> str:
        """The rule in SQL, on the column ``statistics``."""
        tests = [f"statistics.{name} > {low!r}D" for name, low, _ in self.bounds if low > float("-inf")]
        tests += [f"statistics.{name} <= {high!r}D" for name, _, high in self.bounds if high < float("inf")]
        return f"({' and '.join(tests)})"

    def narrowed(self, name: str, low: float = float("-inf"), high: float = float("inf")) -> "Rule":
        bounds = {x: (a, b) for x, a, b in self.bounds}
        a, b = bounds.get(name, (low, high))
        bounds[name] = (max(a, low), min(b, high))
        return Rule(tuple((x, *bounds[x]) for x in sorted(bounds)))


@dataclass(frozen=True)
class Model:
    """Rules with their weights in the log-odds of a good document."""

    constant: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """The probability of label 1, from the column ``statistics``."""
        terms = [f"{self.constant!r}D", *(f"if({rule.holds()}, {weight!r}D, 0D)" for rule, weight in self.weights)]
        return F.expr(f"1 / (1 + exp(-({' + '.join(terms)})))")


def tree_rules(forest: RandomForestClassificationModel, names: list[str], folder: str) -> list[Rule]:
    """The rules of all nodes of all trees but the roots, each once; ``folder`` takes the saved forest."""
    forest.write().save(folder)
    nodes = SparkSession.getActiveSession().read.parquet(f"{folder}/data")
    fields = {"id": "id", "left": "leftChild", "right": "rightChild"}
    rows = nodes.select(
        F.col("treeID").alias("tree"),
        *(F.col(f"nodeData.{y}").alias(x) for x, y in fields.items()),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("bound"),
    ).collect()
    by_place = {(row.tree, row.id): row for row in rows}
    out: dict[Rule, None] = {}
    open_nodes = [(row, Rule(())) for row in sorted(rows, key=lambda x: x.tree) if row.id == 0]
    while open_nodes:
        node, rule = open_nodes.pop()
        if node.left < 0:
            continue
        name = names[node.feature]
        for child, own in ((node.left, rule.narrowed(name, high=node.bound)), (node.right, rule.narrowed(name, low=node.bound))):
            out.setdefault(own)
            open_nodes.append((by_place[node.tree, child], own))
    return list(out)


def labelled_sample(documents: DataFrame, labels: DataFrame, size: int = SAMPLE_ROWS) -> DataFrame:
    """``good, weight, statistics`` of at most ``size`` labelled documents of each kind, in a fixed order."""
    kinds = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("quality") > 0).cast("int")).alias("good"))
    )
    counts = {row.good: row.n for row in kinds.groupBy("good").agg(F.count("*").alias("n")).collect()}
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = F.lit(False)
    for good, n in counts.items():  # some more than needed, so that the exact choice orders few rows
        chosen = chosen | ((F.col("good") == good) & (chance < int(min(1.0, 2 * size / n) * (1 << 30))))
    place = F.row_number().over(Window.partitionBy("good").orderBy(chance, "doc_id"))
    few = kinds.where(chosen).withColumn("place", place).where(F.col("place") <= size).select("doc_id", "good")
    rows = documents.withColumn("doc_id", F.col("doc_id").cast("long")).join(F.broadcast(few), "doc_id")
    first = F.min(F.struct(F.xxhash64("text_hash"), "statistics")).alias("first")
    known = statistics(rows, "good", F.xxhash64("text").alias("text_hash"))
    known = known.groupBy("doc_id", "good").agg(first).select("doc_id", "good", "first.statistics")
    weight = F.coalesce(*(F.when(F.col("good") == good, F.lit(n / min(n, size))) for good, n in counts.items()), F.lit(1.0))
    return stored(known.withColumn("weight", weight).coalesce(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id"))


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """The model from a bounded sample of ``labels`` (doc_id, quality) and the texts they belong to."""
    sample = labelled_sample(documents, labels)
    sizes = {row.good: row.n for row in sample.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model({0: -50.0, 1: 50.0}.get(next(iter(sizes), None), 0.0), ())
    names = list(STATISTICS)
    vector = array_to_vector(F.array(*(F.col("statistics")[x] for x in names))).alias("features")
    points = sample.select("good", "weight", vector)
    forest = RandomForestClassifier(
        labelCol="good", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=1, featureSubsetStrategy="onethird"
    ).fit(points)
    rules = tree_rules(forest, names, shared_folder(sample.sparkSession))
    truths = array_to_vector(F.expr(f"array({', '.join(f'double({rule.holds()})' for rule in rules)})")).alias("features")
    lasso = LogisticRegression(labelCol="good", weightCol="weight", elasticNetParam=1.0, regParam=PENALTY, maxIter=60)
    fitted = lasso.fit(sample.select("good", "weight", truths))
    weights = [(rule, float(w)) for rule, w in zip(rules, fitted.coefficients.toArray(), strict=True) if w]
    return Model(float(fitted.intercept), tuple(weights))


def score(documents: DataFrame, model: Model, *more: Column | str) -> DataFrame:
    """``doc_id``, the further columns and ``score`` (0 to 1) of every document."""
    rows = statistics(documents, *more)
    return rows.select(*(x for x in rows.columns if x != "statistics"), model.score().alias("score"))
