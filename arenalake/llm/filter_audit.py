"""What each of several filters removes, in every order in which they may be applied.

What an order removes depends only on the set (coalition) of filters applied so far, so
the documents are read once: each gets a mask of the filters it fails, masks are counted for
each part, and the removals of all 32 coalitions of five filters are sums of these counts.
A step removes what its coalition does beyond the one before.

A filter's share in all orders together is its Shapley value times their number. It is
the exact solution of a least squares problem: values that add up to the removal of all
filters, and whose sums over a coalition are nearest to its removal, where coalitions of ``s``
of ``n`` filters have the kernel weight ``(n - 1) / (C(n, s) s (n - s))``. The normal equations
with that constraint are solved once, in rational numbers, as a linear map of the removals.

The four tests of a text alone, with words ``[^\\x20\\x09-\\x0D]+``: few words, few different
words, many capitals, a symbol; the fifth: equal to the text of any smaller id in the whole
table. Equal texts are counted as one by SHA-256, with part and id, before anything is compared, so
a text copied a million times is no hot spot. No text is sent anywhere.

Null text: empty. Null language: the empty string, together with it. A null id comes
before all others and has no label; rows of equal ids are judged each for itself and are never
copies of each other. Several labels of a document: good (toxic) if one says so; a null label
says nothing. Empty table: no row. Other columns are ignored.
"""

from collections.abc import Callable
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenalake.llm.repeated_keys import NO_ID

#: By letter, whether a text (columns ``text`` and ``words``) fails.
TESTS: dict[str, Callable[[], Column]] = {
    "A": lambda: F.size("words") < 200,
    "B": lambda: 100 * F.size(F.array_distinct("words")) < 50 * F.size("words"),
    "C": lambda: 100 * F.length(F.regexp_replace("text", "[^A-Z]+", "")) > 3 * F.length("text"),
    "D": lambda: F.col("text").rlike("[#$%&*|]"),
}
#: The test against all other texts.
COPIED = "E"
WORD_SPACE = r"[\x20\x09-\x0D]+"
COUNTS = ("n", "good", "toxic")


def shapley_map(n: int) -> list[list[int]]:
    """For each of ``n`` players the factors of all coalition values in ``n!`` times its Shapley value.

    Minimises the kernel-weighted squares of ``v(S) - sum of S`` under the constraint that all
    players' values add up to ``v(all)``: the normal equations with one multiplier.
    """
    full = (1 << n) - 1
    proper = range(1, full)

    def kernel(coalition: int) -> Fraction:
        s = coalition.bit_count()
        return Fraction(n - 1, comb(n, s) * s * (n - s))

    def inside(player: int, coalition: int) -> int:
        return coalition >> player & 1

    # Left: players and the multiplier; right: one column for each coalition's value.
    rows = []
    for i in range(n):
        left = [sum((kernel(c) for c in proper if inside(i, c) and inside(j, c)), Fraction(0)) for j in range(n)]
        right = [kernel(c) * inside(i, c) if 0 < c < full else Fraction(0) for c in range(full + 1)]
        rows.append([*left, Fraction(1), *right])
    rows.append([*[Fraction(1)] * n, Fraction(0), *[Fraction(int(c == full)) for c in range(full + 1)]])
    for k in range(n + 1):
        pivot = next(r for r in range(k, n + 1) if rows[r][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for r in range(n + 1):
            if r != k and rows[r][k]:
                rows[r] = [x - rows[r][k] * y for x, y in zip(rows[r], rows[k], strict=True)]
    factors = [[factorial(n) * x for x in rows[i][n + 1 :]] for i in range(n)]
    assert all(x.denominator == 1 for row in factors for x in row)
    return [[int(x) for x in row] for row in factors]


def coalition_removals(documents: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part``, ``total`` and, for each mask of filters, how many rows fail one of them.

    ``n``, ``good``, ``toxic``: arrays by mask, of all rows, of those with good and with toxic labels. ``alone``: by mask,
    rows that fail exactly its filters.
    """
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        *(F.max(F.coalesce((F.col(x) == 1).cast("long"), F.lit(0))).alias(y) for x, y in (("quality", "good"), ("toxic", "toxic")))
    )
    words = F.array_remove(F.split("text", WORD_SPACE), "").alias("words")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    name = F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), name, text).select("id", "part", "text", words)
    mask = sum(F.when(fails(), 1 << k).otherwise(0) for k, fails in enumerate(TESTS.values()))
    rows = texts.select("id", "part", F.sha2("text", 256).alias("key"), mask.cast("int").alias("mask"))
    # Rows without an id have no label; joined, they would all meet in one task.
    named = rows.where("id is not null").join(marks, "id", "left")
    nameless = rows.where("id is null").select(F.lit(NO_ID).alias("id"), "part", "key", "mask")
    zeros = {"good": F.lit(0).cast("long"), "toxic": F.lit(0).cast("long")}
    rows = named.fillna(0, ["good", "toxic"]).unionByName(nameless.withColumns(zeros))
    # By text, part and id, then by text and part: how many there are, and how many have the first id.
    ids = rows.groupBy("key", "part", "mask", "id").agg(
        F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    kinds = ids.groupBy("key", "part", "mask").agg(
        F.min("id").alias("id"),
        *(F.sum(x).alias(x) for x in COUNTS),
        *(F.min_by(x, "id").alias(f"{x}_first") for x in COUNTS),
    )
    first = kinds.groupBy("key").agg(F.min("id").alias("first"))
    kinds = kinds.join(first, "key")
    held = {x: F.when(F.col("id") == F.col("first"), F.col(f"{x}_first")).otherwise(0) for x in COUNTS}
    bit = 1 << len(TESTS)
    both = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), *(held[x].alias(x) for x in COUNTS)),
            F.struct((F.col("mask") + bit).alias("mask"), *((F.col(x) - held[x]).alias(x) for x in COUNTS)),
        )
    )
    masks = kinds.select("part", both.alias("m")).groupBy("part", "m.mask").agg(*(F.sum(f"m.{x}").alias(x) for x in COUNTS))

    def removed(x: str) -> Column:
        hit = (F.sum(F.when(F.col("mask").bitwiseAND(c) != 0, F.col(x)).otherwise(0)) for c in range(2 * bit))
        return F.array(*hit).alias(x)

    alone = F.array(*(F.sum(F.when(F.col("mask") == c, F.col("n")).otherwise(0)) for c in range(2 * bit)))
    return masks.groupBy("part").agg(F.sum("n").alias("total"), *map(removed, COUNTS), alone.alias("alone"))


def audit(documents: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """A row for each value of ``part``, each order of the filters and each step in it.

    Counts of rows: ``kept`` after the step, ``removed`` in it, ``redundant`` (fail its filter, removed before),
    ``unique_fails`` (fail its filter alone), ``good_lost`` and ``toxic_lost`` (removed in it, by label), ``shapley``
    (removed by its filter in all orders together).
    """
    names = [*TESTS, COPIED]
    orders = ["".join(x) for x in permutations(names)]
    steps = F.explode(F.sequence(F.lit(1), F.lit(len(names)))).alias("step")
    rows = coalition_removals(documents, labels, part).withColumn("filter_order", F.explode(F.lit(orders)))
    rows = rows.select("*", steps)

    def places(test: Callable[[Column], Column]) -> Column:
        return sum(F.when(test(F.instr("filter_order", x)), 1 << k).otherwise(0) for k, x in enumerate(names))

    rows = rows.withColumns({
        "before": places(lambda at: at < F.col("step")),
        "own": places(lambda at: at == F.col("step")),
    })

    def value(x: str, coalition: Column) -> Column:
        return F.element_at(x, (coalition + 1).cast("int"))

    now = F.col("before") + F.col("own")

    def lost(x: str) -> Column:
        return value(x, now) - value(x, F.col("before"))

    shares = [
        sum(factor * F.element_at("n", c + 1) for c, factor in enumerate(row) if factor) for row in shapley_map(len(names))
    ]
    shapley = F.coalesce(*(F.when(F.col("own") == 1 << k, share) for k, share in enumerate(shares)))
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - value("n", now)).alias("kept"), lost("n").alias("removed"),
        (value("n", F.col("own")) - lost("n")).alias("redundant"), value("alone", F.col("own")).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), shapley.cast("long").alias("shapley"),
    )
