"""Similarity join of documents on their sets of word shingles.

Two documents are linked if the Jaccard similarity of their sets reaches a threshold.
With ``n`` shingles, a document shares at least ``ceil(t * n)`` of them with any
partner. All shingles are put into one order, rarest first. Then

* a document of which fewer than ``ceil(t * n)`` shingles occur in another document
  has no partner, and goes no further;
* any two partners share at least one shingle among their first ``p = n - ceil(t * n)
  + 1``, and at least ``l`` among their first ``p + l - 1``.

``l`` is chosen for each document by its estimated candidate cost: the postings that a
longer prefix reads, and the candidates left to verify when ``l`` common shingles are
asked for. Two documents with different ``l`` are held to the smaller one, on the
prefixes that belong to it; a pair with fewer common prefix shingles is not verified.

Groups of near copies do not cost their square. First each document is verified
against one hub only, of those it shares the most prefix shingles with. Documents that
this leaves apart, though they share a shingle, are verified against ``HUBS`` more hubs,
chosen by a hash, in rounds, as long as these find links. Then only pairs of different
components remain, of shingles that more than one component has. A pair is a candidate if a shingle of
both prefixes can be the first of enough common ones, and it is verified if the prefixes have as
many shingles in common as its ``l`` asks for. Equal sets are one node throughout.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text in lower case (A-Z only). With fewer words
than a shingle has, the sequence of all words is the one shingle. Null text, or no
word: the empty set, which is linked with nothing. A null id is no
candidate for the component's id: a document without one, linked only with such, gets
a null component. Empty table: no row. Other columns are ignored.
Shingles are compared by 64-bit hashes; verification uses 48 bits of them.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenalake.llm.components import components
from arenalake.llm.repeated_keys import NO_ID, Repeated, with_repeated
from arenalake.llm.store import stored
from arenalake.llm.windows import Sums
from arenalake.llm.words import lowered, mixed, text_slices, word_hashes, word_spans

SHINGLE = 5
#: Similarity in hundredths, so that the test is exact.
THRESHOLD = 80
LEVELS = 4
#: Cost of verifying a candidate, in postings.
VERIFY = 8.0
#: What a posting tells of its document: set, size, prefix, repeated shingles, their frequency.
OWN = ("key", "n", "level", "shared", "weight")
#: Hubs each open document is verified against in a further round.
HUBS = 4
#: Rounds go on while more than this share of the tries are links.
FRUITFUL = 0.5
TOKEN = np.uint64((1 << 48) - 1)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, _, data, offsets in text_slices(texts):
        data = lowered(data)
        starts, ends = word_spans(data, offsets)
        bounds = np.searchsorted(starts, offsets)
        sums = Sums(word_hashes(data, starts, ends))
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if low == high:
                yield np.zeros(0, np.uint64)
            else:
                length = min(size, high - low)
                begins = np.arange(low, high - length + 1)
                yield np.unique(sums.spans(begins, begins + length))


def needed(n: int, threshold: int) -> int:
    """How many shingles a set of ``n`` shares with any partner."""
    return -(-threshold * n // 100)


def prefix(times: np.ndarray, n: int, threshold: int) -> tuple[int, int]:
    """(multiplicity, length of the prefix) by least estimated cost; ``times``: ascending frequencies."""
    base = n - needed(n, threshold) + 1
    best = (np.inf, 1)
    for level in range(1, LEVELS + 1):
        if base + level - 1 > n:
            break
        postings = float((times[: base + level - 1] - 1).sum())
        best = min(best, (postings + VERIFY * postings / level, level))
    return best[1], base + best[1] - 1


def similar(documents: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_key, component, row``: the smallest id that links lead to, itself included.

    Documents of equal sets share the ``class_key``, those of a component ``component``; both are null for
    documents without any possible partner. ``row`` is the hash of id and text.
    """
    schema = pa.schema([
        ("src", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("level", pa.int32()),
        ("shared", pa.int64()), ("weight", pa.int64()),
        ("postings", pa.list_(pa.struct([("token", pa.int64()), ("place", pa.int32()), ("need", pa.int32())]))),
        ("tokens", pa.binary()),
    ])
    ddl = (
        "src long, doc long, row long, n long, key long, level int, shared long, weight long, "
        "postings array<struct<token:long,place:int,need:int>>, tokens binary"
    )

    def keys_of(table: pa.Table) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *shingle_sets(table.column("text").combine_chunks(), shingle)])

    def prefixes(table: pa.Table, repeated: Repeated) -> pa.Table:
        out = []
        docs, rows = (table.column(x).to_pylist() for x in ("doc", "row"))
        src = table.column("src")[0].as_py() if docs else 0
        sets = list(shingle_sets(table.column("text").combine_chunks(), shingle))
        all_times = repeated.times(np.concatenate([np.zeros(0, np.uint64), *sets]))
        at = 0
        for doc, name, own in zip(docs, rows, sets, strict=True):
            n = len(own)
            times = all_times[at : at + n]
            at += n
            row = {"src": src, "doc": doc, "row": name, "n": n}
            if n and int((times > 1).sum()) >= needed(n, threshold):
                order = np.lexsort((own, times))
                level, length = prefix(times[order], n, threshold)
                base = length - level + 1
                chosen = order[:length]
                # Shingles of one document only find no partner, but keep their place in the prefix.
                row |= {
                    "key": int(mixed(own).sum(dtype=np.uint64).view(np.int64)),
                    "level": level,
                    "shared": int((times > 1).sum()),
                    "weight": int(1000 * times.mean()),
                    "postings": [
                        {"token": int(own[x].view(np.int64)), "place": k + 1, "need": max(1, k - base + 2)}
                        for k, x in enumerate(chosen.tolist())
                        if times[x] > 1
                    ],
                    "tokens": np.unique(own & TOKEN).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes(),
                }
            out.append(row)
        return pa.Table.from_pylist(out, schema)

    rows = stored(with_repeated(documents, keys_of, prefixes, ddl))
    alive = rows.where("key is not null")
    classes = alive.groupBy("key").agg(F.min(F.when(F.col("doc") != NO_ID, F.col("doc"))).alias("least"))
    # One document of each set stands for it.
    own = alive.groupBy("key").agg(F.min(F.struct("doc", "src")).alias("first")).select(
        "key", F.col("first.doc").alias("doc"), F.col("first.src").alias("src")
    )
    nodes = stored(alive.join(own, ["key", "doc", "src"]).dropDuplicates(["key"]))
    entries = stored(
        nodes.select(*OWN, F.explode("postings").alias("p")).select(*OWN, "p.token", "p.place", "p.need")
    )
    sets = nodes.select("key", "n", "tokens")

    # Each node against one hub: the one with the most frequent shingles is nearest to all.
    hubs = entries.groupBy("token").agg(
        F.max(F.struct("weight", *OWN)).alias("hub"), F.min("key").alias("low"), F.max("key").alias("top")
    )
    shared = (
        entries.join(hubs.where("low <> top"), "token")
        .where(F.col("key") != F.col("hub.key"))
        .where(can_link(F.col("hub.n"), F.col("hub.shared"), threshold))
        .groupBy("key", F.col("hub.key").alias("hub"))
        .agg(F.count("*").alias("common"))
        .groupBy("key")
        .agg(F.max(F.struct("common", "hub")).alias("best"))
    )
    stars = verified(shared.select(F.col("key").alias("a"), F.col("best.hub").alias("b")), sets, threshold)
    # What is left of a family goes to other hubs, chosen anew for each number and round.
    links, rounds, going = stars, 0, True
    while going:
        spread = open_rows(entries, components(links))
        tries = stored(hub_tries(spread, rounds, threshold))
        more = verified(tries, sets, threshold)
        links, rounds = links.unionByName(more), rounds + 1
        going = more.count() > FRUITFUL * tries.count()

    # All pairs that may still link different components, then those with enough common prefix shingles.
    pairs = candidates(open_rows(entries, components(links)), threshold)
    prefixed = nodes.select("key", "level", "postings")
    first, second = (
        prefixed.select(F.col("key").alias(x), F.col("level").alias(f"level_{x}"), F.col("postings").alias(f"of_{x}"))
        for x in ("a", "b")
    )
    level = F.least("level_a", "level_b")

    def upto(postings: str) -> Column:
        return F.transform(F.filter(postings, lambda x: x["need"] <= level), lambda x: x["token"])

    pairs = (
        pairs.join(first, "a")
        .join(second, "b")
        .where((level == 1) | (F.size(F.array_intersect(upto("of_a"), upto("of_b"))) >= level))
        .select("a", "b")
    )
    links = links.unionByName(verified(pairs, sets, threshold))
    found = components(links).withColumnRenamed("node", "key")
    groups = (
        classes.join(found, "key", "left")
        .select("key", "least", F.coalesce("component", "key").alias("group"))
    )
    names = groups.groupBy("group").agg(F.min("least").alias("component_id"))
    labels = groups.join(names, "group").select("key", "component_id", "group")
    alone = rows.where("key is null").select("key", "doc", "row", "n", F.col("doc").alias("component_id"))
    alone = alone.withColumn("group", F.lit(None).cast("long"))
    back = alone.unionByName(alive.select("key", "doc", "row", "n").join(labels, "key"))
    return back.select(
        F.nullif("doc", F.lit(NO_ID)).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif("component_id", F.lit(NO_ID)).alias("component_id"),
        F.col("key").alias("class_key"),
        F.col("group").alias("component"),
        "row",
    )


def _tokens(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def can_link(n: Column, shared: Column, threshold: int) -> Column:
    """Whether the row's set can be similar to one of ``n`` shingles, ``shared`` of which occur elsewhere.

    Similar sets have ``t / (1 + t)`` of their summed sizes in common, which neither can
    hold without as many repeated shingles.
    """
    common = F.least("shared", shared) * (100 + threshold) >= (F.col("n") + n) * threshold
    return common & (n * 100 >= F.col("n") * threshold) & (F.col("n") * 100 >= n * threshold)


def open_rows(entries: DataFrame, parts: DataFrame) -> DataFrame:
    """The postings of tokens that more than one component has, with the row's component and the token's largest."""
    part = F.coalesce("component", "key").alias("part")
    placed = entries.join(parts.withColumnRenamed("node", "key"), "key", "left").select(
        *OWN, "token", "place", "need", part
    )
    counts = placed.groupBy("token", "part").agg(F.count("*").alias("rows"))
    tokens = counts.groupBy("token").agg(F.max_by("part", F.struct("rows", "part")).alias("main"), F.count("*").alias("parts"))
    spread = placed.join(tokens.where("parts > 1").drop("parts"), "token")
    return stored(spread.select(*OWN, "token", "place", "need", "part", "main"))


def hub_tries(spread: DataFrame, number: int, threshold: int) -> DataFrame:
    """Pairs (a, b) of each node with the best of ``HUBS`` hubs of its tokens, which are chosen by a hash and ``number``."""
    numbers = [number * HUBS + k for k in range(HUBS)]
    anew = [
        F.max(F.struct((F.pmod(F.xxhash64("key", F.lit(k)), F.lit(4)) == 0).alias("in"), "weight", *OWN, "part")).alias(f"h{k}")
        for k in numbers
    ]
    choice = F.explode(F.array(*(F.struct(F.lit(k).alias("number"), F.col(f"h{k}").alias("hub")) for k in numbers)))
    return (
        spread.where("part <> main")
        .join(spread.groupBy("token").agg(*anew), "token")
        .select(*OWN, "part", choice.alias("h"))
        .where(F.col("part") != F.col("h.hub.part"))
        .where(can_link(F.col("h.hub.n"), F.col("h.hub.shared"), threshold))
        .groupBy("key", "h.number", F.col("h.hub.key").alias("hub"))
        .agg(F.count("*").alias("common"))
        .groupBy("key", "number")
        .agg(F.max(F.struct("common", "hub")).alias("best"))
        .select(F.greatest("key", "best.hub").alias("a"), F.least("key", "best.hub").alias("b"))
        .distinct()
    )


def candidates(spread: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of different components that hold a token which may be their first common one.

    After the first common shingle, a pair has at most as many as follow it in the shorter rest.
    So a posting only reaches partners up to a size that its rest allows; for
    the part of a family's copies that is too far from its centre, none of that size. Postings
    meet by token and class of size, the larger set (of equal sizes the larger key) looking for the smaller. Rows
    of the component that has most of a token's postings never meet each other.
    """
    rest = F.col("n") - F.col("place")
    most = F.floor(((rest + 1) * (100 + threshold) / threshold) - F.col("n") + 1e-6).cast("long")
    least = F.ceil(F.col("n") * threshold / 100 - 1e-6).cast("long")
    names = [*OWN, "part", "rest"]
    rows = spread.select("token", *OWN, "part", "main", rest.alias("rest"), least.alias("least"), most.alias("most"))
    found = rows.where("most >= n").withColumn("class", size_class("n"))
    found = found.select("token", "class", "main", *(F.col(x).alias(f"{x}2") for x in names))
    classes = F.sequence(size_class("least"), size_class(F.least("most", "n")))
    looking = rows.where("most >= least").withColumn("class", F.explode(classes)).select("token", "class", "main", *names)
    smaller = (F.col("n2") < F.col("n")) | ((F.col("n2") == F.col("n")) & (F.col("key2") < F.col("key")))
    enough = (F.least("rest", "rest2") + 1) * (100 + threshold) >= (F.col("n") + F.col("n2")) * threshold
    keep = (F.col("part") != F.col("part2")) & smaller & enough & can_link(F.col("n2"), F.col("shared2"), threshold)
    outside = looking.where("part <> main").join(found.drop("main"), ["token", "class"]).where(keep)
    inside = looking.where("part = main").join(found.where("part2 <> main").drop("main"), ["token", "class"]).where(keep)
    both = outside.select("key", "key2").unionByName(inside.select("key", "key2"))
    return both.select(F.greatest("key", "key2").alias("a"), F.least("key", "key2").alias("b")).distinct()


def size_class(n: str | Column) -> Column:
    """Classes of sizes that grow by a twentieth."""
    return F.floor(F.log(1.05, n)).cast("int")


def verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by their whole sets."""

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(x).to_pylist() for x in ("n", "n2", "tokens", "tokens2"))
            good = []
            for n, n2, own, other in zip(*columns, strict=True):
                common = len(np.intersect1d(_tokens(own), _tokens(other), True))
                good.append(100 * common >= threshold * (n + n2 - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    first = sets.select(F.col("key").alias("a"), "n", "tokens")
    second = sets.select(F.col("key").alias("b"), F.col("n").alias("n2"), F.col("tokens").alias("tokens2"))
    sized = pairs.join(first.drop("tokens"), "a").join(second.drop("tokens2"), "b")
    sized = sized.where((F.col("n2") * 100 >= F.col("n") * threshold) & (F.col("n") * 100 >= F.col("n2") * threshold))
    whole = sized.select("a", "b").join(first, "a").join(second, "b")
    return stored(whole.mapInArrow(intersect, "a long, b long"))
