"""Benchmark items in documents, found by templates. DataFrame functions only.

A text becomes a sequence of template tokens: its words in lower case, except that
numbers, units after a number and names (words with a capital letter A-Z followed by a
lower one, those at the beginning of a sentence included) become the placeholders
``<num>``, ``<unit>`` and ``<name>``. Windows of eight template tokens are joined by
their hash, so a question is found again after its numbers, units and names were
changed.

Capitals decide what is a name, so a text in other case has other template tokens. Each
text therefore has a second template, in which words are lower-cased and only numbers and
units are slots; the windows of both kinds are kept apart, and an item is reported if
those of either kind reach the share (the figures are those of the first kind if it does).

Then the slots are checked. Windows of one document, item and kind with the same distance
between both places form a run; in a run each value of the item's slots must stand
for one value of the document, its most frequent counterpart in the run (at equal numbers
itself, then the greatest string). Slots that disagree do not count, nor do the windows
that cover one. An item is reported if the windows that count are at least half of its windows.

Words consist of digits, letters A-Z and all characters beyond ASCII; a point or
comma before a digit belongs to the number. Windows of which more than four tokens are placeholders match too much and are left out, on both sides alike, by leaving them
out of the benchmark. Items without any other window (fewer than eight words, lists of
figures) are searched for as they are, in any case: by their lower-cased words, or by
windows of eight of these where there are more. An item of one word is thus found in
every document that holds the word. Items without a word are not searched for. Null texts hold nothing. Every row is searched for
itself, with a null or repeated id as well; rows of the same id (or none) and the same text are one, known by
a hash of 64 bits. A text is one row of words in a task, so one of 20 MB takes some 500 MB
there. Empty tables give no row. Other columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
MOST_SLOTS = 4
LEAST_SHARE = 0.5
#: Benchmark windows up to this number, some 40 bytes each, are sent to every executor.
BROADCAST_WINDOWS = 500_000
NUM, NAME, UNIT = "<num>", "<name>", "<unit>"
SLOTS = (NUM, NAME, UNIT)
#: Kinds of template: with names as slots, without regard to case, and without slots for items that have no other window.
NAMED, ANY_CASE, LITERAL = 0, 1, 2
#: A word, and the decimal places of a number.
WORD = r"[^\x00-/:-@\[-`{-\x7f]+(?:[.,][0-9]+)*"
#: Fixed: units of measure.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml l s sec min h hr hrs ms hz khz mhz ghz w kw v a c f k b kb mb gb tb "
    "inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
    "gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres second seconds minute minutes "
    "hour hours day days week weeks month months year years dollar dollars euro euros cent cents percent degree degrees"
).split()


def _template(words: Column, word: Column, at: Column) -> Column:
    """The template token of one word. Strings compare by their bytes, so ``a`` stands before all other letters."""
    before = F.get(words, at - 1)
    number_before = F.coalesce((before >= "0") & (before < ":"), F.lit(False))
    second = F.substring(word, 2, 1)
    return (
        F.when(word >= "a", F.when(word.isin(UNITS) & number_before, F.lit(UNIT)).otherwise(F.lower(word)))
        .when(word < ":", F.lit(NUM))
        .when((second >= "a") & (second == F.lower(second)), F.lit(NAME))
        .otherwise(F.lower(word))
    )


def with_templates(rows: DataFrame, text: str = "text") -> DataFrame:
    """``tokens`` instead of the text, and ``values``: the words themselves, in lower case, place by place.

    Each step is a projection of its own, so that no array is computed twice.
    """
    kept = [x for x in rows.columns if x != text]
    words = F.regexp_extract_all(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD), F.lit(0))
    return rows.select(*kept, words.alias("words")).select(
        *kept,
        F.transform("words", lambda x, at: _template(F.col("words"), x, at)).alias("tokens"),
        F.transform("words", F.lower).alias("values"),
    )


def _case_free(values: Column, value: Column, at: Column) -> Column:
    """The template token of one lower-cased word, where names are no slots."""
    before = F.get(values, at - 1)
    number_before = F.coalesce((before >= "0") & (before < ":"), F.lit(False))
    return (
        F.when(value < ":", F.lit(NUM)).when(value.isin(UNITS) & number_before, F.lit(UNIT)).otherwise(value)
    )


def with_kinds(rows: DataFrame) -> DataFrame:
    """Each row of ``with_templates`` once for both kinds, with its ``kind``."""
    kept = [x for x in rows.columns if x != "tokens"]
    other = F.transform("values", lambda x, at: _case_free(F.col("values"), x, at))
    kinds = F.array(
        F.struct(F.lit(NAMED).alias("kind"), F.col("tokens").alias("tokens")),
        F.struct(F.lit(ANY_CASE).alias("kind"), other.alias("tokens")),
    )
    return rows.select(*kept, F.inline_outer(kinds))


def with_windows(rows: DataFrame, size: int = WINDOW) -> DataFrame:
    """``windows``: a hash of each ``size`` (a power of two) consecutive tokens, from those of half as many."""
    rows, have = rows.withColumn("windows", F.transform("tokens", lambda x: F.xxhash64(x))), 1
    while have < size:
        left = F.greatest(F.size("windows") - have, F.lit(0))
        first, second = (F.slice("windows", F.lit(at), left) for at in (1, have + 1))
        rows = rows.withColumn("windows", F.zip_with(first, second, lambda a, b: F.xxhash64(a, b)))
        have *= 2
    return rows


def _usable(tokens: Column, at: Column) -> Column:
    """Whether the window at a place has enough literal words."""
    return F.size(F.filter(F.slice(tokens, at + 1, F.lit(WINDOW)), lambda x: x.isin(*SLOTS))) <= MOST_SLOTS


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item_id, kind, item_tokens, item_values`` of the items with at least one window of the kind.

    An item without a usable window of any kind is there once, as ``LITERAL``.
    """
    rows = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    some = F.when(
        F.size("tokens") >= WINDOW,
        F.exists(F.sequence(F.lit(0), F.size("tokens") - WINDOW), lambda at: _usable(F.col("tokens"), at)),
    ).otherwise(F.lit(False))
    rows = with_kinds(with_templates(rows)).withColumn("some", some)
    literal = (
        rows.where(F.size("values") > 0)
        .groupBy("item_id", "values")
        .agg(F.max("some").alias("some"))
        .where(~F.col("some"))
        .select("item_id", F.lit(LITERAL).alias("kind"), F.col("values").alias("tokens"), "values")
    )
    return (
        rows.where("some")
        .select("item_id", "kind", "tokens", "values")
        .unionByName(literal)
        .withColumnsRenamed({"tokens": "item_tokens", "values": "item_values"})
    )


def _literal_windows(size: Column) -> Column:
    """A hash of each ``size`` consecutive ``values``, with its place."""
    return F.when(
        F.size("values") >= size,
        F.transform(
            F.sequence(F.lit(0), F.size("values") - size),
            lambda at: F.struct(at.alias("at"), F.xxhash64(F.slice("values", at + 1, size)).alias("window")),
        ),
    ).otherwise(F.array().cast("array<struct<at:int,window:bigint>>"))


def literal_windows(items: DataFrame) -> DataFrame:
    """``size, window, item_id, kind, item_at, item_windows`` of the items without another window."""
    size = F.least(F.size("values"), F.lit(WINDOW))
    return (
        items.where(F.col("kind") == LITERAL)
        .select("item_id", "kind", F.col("item_values").alias("values"))
        .select("item_id", "kind", size.alias("size"), _literal_windows(size).alias("all"))
        .select("item_id", "kind", "size", F.size("all").cast("long").alias("item_windows"), F.inline("all"))
        .withColumnRenamed("at", "item_at")
    )


def item_windows(items: DataFrame) -> DataFrame:
    """``window, item_id, kind, item_at, item_windows``: all windows with enough literal words."""
    items = items.where(F.col("kind") != LITERAL)
    rows = with_windows(items.select("item_id", "kind", F.col("item_tokens").alias("tokens"))).select(
        "item_id", "kind", "tokens", F.posexplode_outer("windows").alias("item_at", "window")
    )
    rows = rows.where(_usable(F.col("tokens"), F.col("item_at"))).select(_of_kind().alias("window"), "item_id", "kind", "item_at")
    counts = rows.groupBy("item_id", "kind").agg(F.count_distinct("item_at").alias("item_windows"))
    return rows.join(counts, ["item_id", "kind"])


def _of_kind() -> Column:
    """The hash of a window, another one for each kind."""
    return F.xxhash64("kind", "window")


def _row() -> Column:
    """What tells rows apart: a hash of id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("row")


def contaminated(documents: DataFrame, benchmark: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """``doc_id, item_id, n_windows, item_windows, n_slots, n_changed, row``: a row for each item found in a document.

    ``n_slots`` counts the slots in the windows that count, ``n_changed`` those whose value
    differs from the item's. ``row`` is the hash of id and text.
    """
    items = benchmark_items(benchmark)
    wanted = item_windows(items)
    if wanted.count() <= BROADCAST_WINDOWS:
        wanted = F.broadcast(wanted)
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _row())
    hits = (
        with_windows(with_kinds(with_templates(source)).select("row", "kind", "tokens"))
        # The inner form adds a test of the array's size, which would compute the array once more.
        .select("row", "kind", F.posexplode_outer("windows").alias("at", "window"))
        .select("row", "at", _of_kind().alias("window"))
        .join(wanted, "window")
        .select("row", "item_id", "kind", (F.col("at") - F.col("item_at")).alias("shift"), "item_at", "item_windows")
    )
    literal = literal_windows(items)
    # At most eight different lengths.
    sizes = sorted(row["size"] for row in literal.select("size").distinct().collect())
    if sizes:
        every = F.concat(*(_literal_windows(F.lit(size)) for size in sizes))
        literal_hits = (
            with_templates(source)
            .select("row", F.inline_outer(every))
            .join(literal.drop("size"), "window")
            .select("row", "item_id", "kind", (F.col("at") - F.col("item_at")).alias("shift"), "item_at", "item_windows")
        )
        hits = hits.unionByName(literal_hits)
    runs = hits.groupBy("row", "item_id", "kind", "shift", "item_windows").agg(
        F.array_sort(F.collect_set("item_at")).alias("places")
    )
    # Items of which too few windows occur at all go no further.
    found = (
        runs.groupBy("row", "item_id", "kind")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n"), F.max("item_windows").alias("of"))
        .where(F.col("n") >= F.col("of") * least_share)
        .select("row", "item_id", "kind")
    )
    runs = runs.join(found, ["row", "item_id", "kind"])
    texts = with_templates(source.join(found.select("row").distinct(), "row").dropDuplicates(["row"]))
    texts = with_kinds(texts)
    if sizes:
        plain = texts.where(F.col("kind") == NAMED).withColumn("kind", F.lit(LITERAL))
        texts = texts.unionByName(plain.withColumn("tokens", F.col("values")))
    inside = F.filter(
        F.sequence(F.lit(0), F.size("item_tokens") - 1),
        lambda i: F.get("item_tokens", i).isin(*SLOTS)
        & F.exists("places", lambda p: (p <= i) & (i < p + WINDOW))
        & (F.get("tokens", i + F.col("shift")) == F.get("item_tokens", i)),
    )
    pairs = F.transform(
        inside,
        lambda i: F.struct(
            i.alias("slot"),
            F.get("item_values", i).alias("own"),
            F.get("values", i + F.col("shift")).alias("other"),
        ),
    )
    run = ["row", "doc_id", "item_id", "kind", "shift", "item_windows"]
    votes = (
        runs.join(texts, ["row", "kind"])
        .join(items, ["item_id", "kind"])
        .select(*run, "places", pairs.alias("pairs"))
        .select(*run, "places", F.inline_outer("pairs"))
        .groupBy(*run, "own", "other")
        .agg(F.first("places").alias("places"), F.collect_list("slot").alias("slots"))
    )
    vote = F.struct(F.size("slots").alias("n"), (F.col("own") == F.col("other")).alias("same"), "other", "slots")
    checked = (
        votes.groupBy(*run, "own")
        .agg(F.first("places").alias("places"), F.max(vote).alias("most"), F.flatten(F.collect_list("slots")).alias("all"))
        .groupBy(*run)
        .agg(
            F.first("places").alias("places"),
            F.flatten(F.collect_list("most.slots")).alias("good"),
            F.flatten(F.collect_list(F.when(~F.col("most.same"), F.col("most.slots")))).alias("changed"),
            F.flatten(F.collect_list(F.array_except("all", "most.slots"))).alias("bad"),
        )
    )
    left = F.filter("places", lambda p: ~F.exists("bad", lambda i: (p <= i) & (i < p + WINDOW)))
    checked = checked.withColumn("places", left)

    def covered(slots: str) -> Column:
        return F.size(F.filter(slots, lambda i: F.exists("places", lambda p: (p <= i) & (i < p + WINDOW))))

    figures = ["n_windows", "item_windows", "n_slots", "n_changed"]
    return (
        checked.groupBy("row", "doc_id", "item_id", "kind")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("n_windows"),
            F.max("item_windows").alias("item_windows"),
            F.sum(covered("good")).alias("n_slots"),
            F.sum(covered("changed")).alias("n_changed"),
        )
        .where(F.col("n_windows") >= F.col("item_windows") * least_share)
        .groupBy("row", "doc_id", "item_id")
        .agg(F.min_by(F.struct(*figures), "kind").alias("best"))
        .select("doc_id", "item_id", *(f"best.{x}" for x in figures), "row")
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All rows and columns of ``documents`` but those with a benchmark item."""
    found = contaminated(documents, benchmark).select(F.col("row").alias("found_row")).distinct()
    return documents.join(found, _row() == found["found_row"], "left_anti")
