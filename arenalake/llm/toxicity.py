"""Toxic spans by a linear-chain conditional random field, and scores of documents.

Labels are known for documents, so tokens are labelled in a first step: a feature of
a token (the word, or its first 4 to 7 bytes) is suspect if it occurs in toxic
documents ``LEAST_ODDS`` times as often as in others, after at least
``LEAST_CONTEXTS`` different words (copies of one text do not count twice). A token
of a toxic document with a suspect feature is labelled toxic, every other token
clean. On these labelled tokens the field learns a weight for each suspect feature,
a bias, the transitions between clean and toxic and the first state.

Forward-backward gives each token's probability to be toxic. Tokens of at least one
half form the spans. A logistic function of the number of toxic tokens (the sum of
their probabilities) and of the highest probability, fitted on the sample's
documents, gives a document's score. Chains begin anew after ``CHAIN`` tokens.

The sample is bounded: of the labelled documents ``SAMPLE_TOXIC`` toxic and ``SAMPLE_CLEAN`` others, those
with the smallest hashes of id, one text each (the one of the smallest hash); of their chains with a suspect
feature the first ``TRAIN_CHAINS`` in that order; and at most ``FEATURES`` suspect features, those of the most
toxic documents. Scoring reads whole texts; a text takes some 100 bytes for each of its own in one task.

Null or empty text: no span, the lowest score. Without labels of both kinds every
score is 0. Several labels of a document: toxic if one of them says so; a null label
says nothing. Each row is scored for itself, with a null or repeated id as well. An
empty table gives no row.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arenalake.llm.store import stored, texts
from arenalake.llm.words import BYTE_CODES, folded, mixed, runs, span_hashes, text_slices

PREFIXES = (4, 5, 6, 7)
LEAST_ODDS = 20.0
LEAST_CONTEXTS = 5
SAMPLE_TOXIC, SAMPLE_CLEAN = 3000, 6000
FEATURES = 20_000
TRAIN_CHAINS = 12_000
CHAIN = 128
STEPS, RATE, DECAY = 60, 0.3, 1e-4
THRESHOLD = 0.7
IS_LETTER = np.zeros(256, bool)
IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass(frozen=True)
class Model:
    """Suspect features with their weights, and the parameters of chains and documents."""

    keys: np.ndarray  # sorted hashes of the suspect features
    weights: np.ndarray
    bias: float
    moves: np.ndarray  # 2 x 2: from, to
    first: float
    document: np.ndarray  # constant, toxic tokens, highest probability


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all tokens, and the hashes of their features, a row for each kind."""
    starts, ends = runs(IS_LETTER[data], offsets)
    codes = BYTE_CODES[folded(data)]
    rows = [span_hashes(codes, starts, ends)]
    for size in PREFIXES:
        hashes = span_hashes(codes, starts, np.minimum(starts + size, ends)) ^ np.uint64(size)
        rows.append(np.where(ends - starts > size, mixed(hashes), np.uint64(0)))
    return starts, ends, np.array(rows)


def _suspects(keys: np.ndarray, features: np.ndarray) -> np.ndarray:
    """For each feature the place of its key, or -1."""
    if not len(keys):
        return np.full(features.shape, -1)
    maybe = np.zeros(1 << 16, bool)
    maybe[(keys >> np.uint64(48)).astype(np.int64)] = True
    places = np.full(features.shape, -1)
    likely = maybe[(features >> np.uint64(48)).astype(np.int64)]
    at = np.minimum(np.searchsorted(keys, features[likely]), len(keys) - 1)
    places[likely] = np.where(keys[at] == features[likely], at, -1)
    return places


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and feature: in how many toxic and clean documents, and after which words (64 bits)."""
    for batch in batches:
        toxic = np.array(batch.column("toxic").to_pylist(), np.int64)
        for first, _, data, offsets in text_slices(batch.column("text")):
            starts, _, features = _tokens(data, offsets)
            if not len(starts):
                continue
            owner = np.searchsorted(offsets, starts, "right") - 1
            before = np.append(np.uint64(0), features[0][:-1])
            before[np.append(True, owner[1:] != owner[:-1])] = 0
            label = toxic[first + owner]
            bits = np.where(label == 1, np.uint64(1) << (mixed(before) & np.uint64(63)), np.uint64(0))
            kinds = len(features)
            flat, owners = features.ravel(), np.tile(owner, kinds)
            order = np.lexsort((owners, flat))
            flat, owners = flat[order], owners[order]
            new = np.append(True, flat[1:] != flat[:-1])
            once = new | np.append(True, owners[1:] != owners[:-1])
            at = np.flatnonzero(new)
            label = np.tile(label, kinds)[order]
            columns = [
                flat[at].view(np.int64),
                np.add.reduceat(once & (label == 1), at, dtype=np.int64),
                np.add.reduceat(once & (label == 0), at, dtype=np.int64),
                np.bitwise_or.reduceat(np.tile(bits, kinds)[order], at).view(np.int64),
            ]
            kept = flat[at] != 0
            names = ["feature", "in_toxic", "in_clean", "contexts"]
            yield pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in columns], names)


def _probabilities(emission: np.ndarray, lengths: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over chains (rows): P(toxic) for each token, and the expected moves, 2 x 2.

    ``emission`` holds the score of toxic against clean; places beyond a chain's length are ignored.
    """
    n, steps = emission.shape
    moves = np.exp(model.moves - model.moves.max())
    odds = np.exp(np.clip(emission, -30, 30))
    forward = np.zeros((steps, n, 2))
    backward = np.ones((steps, n, 2))
    state = np.stack([np.ones(n), np.exp(model.first) * odds[:, 0]], 1)
    forward[0] = state / state.sum(1, keepdims=True)
    for t in range(1, steps):
        state = forward[t - 1] @ moves
        state[:, 1] *= odds[:, t]
        forward[t] = state / state.sum(1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        state = backward[t + 1].copy()
        state[:, 1] *= odds[:, t + 1]
        state = state @ moves.T
        state /= state.sum(1, keepdims=True)
        backward[t] = np.where((t + 1 < lengths)[:, None], state, 1.0)
    both = forward * backward
    toxic = (both[:, :, 1] / both.sum(2)).T
    inside = np.arange(steps)[None, :] < lengths[:, None]
    expected = np.zeros((2, 2))
    if steps > 1:
        after = backward[1:].copy()
        after[:, :, 1] *= odds.T[1:]
        pairs = forward[:-1, :, :, None] * moves[None, None] * after[:, :, None, :]
        pairs /= pairs.sum((2, 3), keepdims=True)
        expected = pairs[inside.T[1:]].sum(0)
    return np.where(inside, toxic, 0.0), expected


def _chains(places: np.ndarray, owner_bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and document of all chains; ``owner_bounds``: first token of each document."""
    sizes = np.diff(owner_bounds)
    count = -(-sizes // CHAIN)
    owner = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    begins = owner_bounds[:-1][owner] + number * CHAIN
    return begins, np.minimum(owner_bounds[1:][owner] - begins, CHAIN), owner


def _emissions(places: np.ndarray, begins: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    scores = model.bias + np.where(places >= 0, model.weights[np.maximum(places, 0)], 0.0).sum(0)
    at = begins[:, None] + np.arange(int(lengths.max()))[None, :]
    return np.append(scores, 0.0)[np.minimum(at, len(scores))]


def _marginals(data: np.ndarray, offsets: np.ndarray, model: Model):
    """Starts, ends, P(toxic) and first token of each document; chains without a suspect feature count as clean."""
    starts, ends, features = _tokens(data, offsets)
    bounds = np.searchsorted(starts, offsets)
    places = _suspects(model.keys, features)
    toxic = np.zeros(len(starts))
    suspect = (places >= 0).any(0)
    if suspect.any():
        begins, lengths, _ = _chains(places, bounds)
        sums = np.append(0, np.cumsum(suspect))
        busy = sums[begins + lengths] > sums[begins]
        begins, lengths = begins[busy], lengths[busy]
        for low in range(0, len(begins), 500):
            b, n = begins[low : low + 500], lengths[low : low + 500]
            found, _ = _probabilities(_emissions(places, b, n, model), n, model)
            inside = np.arange(found.shape[1])[None, :] < n[:, None]
            toxic[(b[:, None] + np.arange(found.shape[1])[None, :])[inside]] = found[inside]
    return starts, ends, toxic, bounds


def _document_features(toxic: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row (1, log of 1 + toxic tokens, highest probability) for each document."""
    n = len(bounds) - 1
    chosen = np.where(toxic >= 0.5, toxic, 0.0)
    sums = np.append(0.0, np.cumsum(chosen))
    highest = np.zeros(n)
    filled = bounds[1:] > bounds[:-1]
    if filled.any():
        highest[filled] = np.maximum.reduceat(toxic, bounds[:-1][filled])
    return np.stack([np.ones(n), np.log1p(np.maximum(sums[bounds[1:]] - sums[bounds[:-1]], 0)), highest], 1)


def _scores(features: np.ndarray, model: Model) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ model.document, -50, 50)))


def labelled_sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``order, text, toxic`` of a bounded sample of the labelled documents; ``order`` is a hash of the id."""
    rows = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .withColumn("order", F.xxhash64("doc_id"))
    )
    counts = {row.toxic: row.n for row in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bound = {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN}
    chosen = F.lit(False)
    for label, n in counts.items():  # some more than needed, so that the exact choice orders few rows
        share = int(min(1.0, 2 * bound[label] / n) * 1_000_000)
        chosen = chosen | ((F.col("toxic") == label) & (F.pmod("order", F.lit(1_000_000)) < share))
    place = F.row_number().over(Window.partitionBy("toxic").orderBy(F.pmod("order", F.lit(1_000_000)), "order", "doc_id"))
    most = F.when(F.col("toxic") == 1, SAMPLE_TOXIC).otherwise(SAMPLE_CLEAN)
    # Rows of 24 bytes, as many as the sample has.
    few = rows.where(chosen).withColumn("place", place).where(F.col("place") <= most).drop("place")
    found = texts(documents).join(F.broadcast(few), "doc_id")
    one = found.groupBy("doc_id", "order", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first"))
    return one.select("order", F.col("first.text").alias("text"), "toxic")


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """The model from a bounded sample of ``labels`` (doc_id, toxic) and the texts they belong to."""
    return _trained(stored(labelled_sample(documents, labels)))


def _trained(sample: DataFrame) -> Model:
    sizes = {row.toxic: row.n for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), -5.0, np.zeros((2, 2)), 0.0, np.array([-50.0, 0.0, 0.0]))
    if not sizes.get(0) or not sizes.get(1):
        return nothing
    counted = sample.mapInArrow(_feature_counts, "feature long, in_toxic long, in_clean long, contexts long")
    odds = (F.col("in_toxic") / sizes[1]) / ((F.col("in_clean") + 0.5) / sizes[0])
    strong = (
        counted.groupBy("feature")
        .agg(
            F.sum("in_toxic").alias("in_toxic"),
            F.sum("in_clean").alias("in_clean"),
            F.bit_count(F.bit_or("contexts")).alias("contexts"),
        )
        .where((F.col("contexts") >= LEAST_CONTEXTS) & (odds >= LEAST_ODDS))
        .orderBy(F.desc("in_toxic"), "feature")
        .limit(FEATURES)
        .select("feature")
        .collect()
    )
    keys = np.sort(np.array([row.feature for row in strong], np.int64).view(np.uint64))
    if not len(keys):
        return nothing

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The suspect features of every chain that has one, by token."""
        for batch in batches:
            toxic, orders = batch.column("toxic").to_pylist(), batch.column("order").to_pylist()
            for first, _, data, offsets in text_slices(batch.column("text")):
                starts, _, features = _tokens(data, offsets)
                places = _suspects(keys, features)
                begins, lengths, owner = _chains(places, np.searchsorted(starts, offsets))
                hits = np.flatnonzero((places >= 0).any(0))
                low, high = np.searchsorted(hits, begins), np.searchsorted(hits, begins + lengths)
                out = []
                for k in np.flatnonzero(high > low).tolist():
                    at = hits[low[k] : high[k]]
                    pairs = [(int(t - begins[k]), int(f)) for t in at for f in places[:, t] if f >= 0]
                    tokens, found = zip(*pairs, strict=True)
                    row = first + int(owner[k])
                    of = {"order": orders[row], "place": int(begins[k]), "toxic": toxic[row]}
                    out.append({**of, "size": int(lengths[k]), "tokens": tokens, "found": found})
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("order", pa.int64()), ("place", pa.int64()), ("toxic", pa.int32()), ("size", pa.int32())])
    schema = schema.append(pa.field("tokens", pa.list_(pa.int32()))).append(pa.field("found", pa.list_(pa.int32())))
    ddl = "order long, place long, toxic int, size int, tokens array<int>, found array<int>"
    rows = sample.mapInArrow(chains, ddl).orderBy("order", "place").limit(TRAIN_CHAINS).collect()
    model = _fitted([(x.toxic, x.size, x.tokens, x.found) for x in rows], keys)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros((0, 3))]
            for _, _, data, offsets in text_slices(batch.column("text")):
                _, _, toxic, bounds = _marginals(data, offsets, model)
                found.append(_document_features(toxic, bounds))
            found = np.concatenate(found)
            columns = [batch.column("toxic"), pa.array(found[:, 1]), pa.array(found[:, 2])]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "amount", "highest"])

    measured = sample.mapInArrow(measure, "toxic int, amount double, highest double").collect()
    x = np.array([(1.0, row.amount, row.highest) for row in measured])
    y = np.array([row.toxic for row in measured], float)
    document = np.array([-3.0, 1.0, 1.0])
    for _ in range(30):  # Newton's method, with a little decay
        p = 1 / (1 + np.exp(-np.clip(x @ document, -50, 50)))
        slope = x.T @ (p - y) + 0.05 * document
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        document = document - np.linalg.solve(curve, slope)
    return Model(model.keys, model.weights, model.bias, model.moves, model.first, document)


def _fitted(chains: list[tuple], keys: np.ndarray) -> Model:
    """Gradient ascent on the field's log-likelihood; ``chains``: (toxic, size, tokens, features)."""
    sizes = np.array([x[1] for x in chains], np.int64)
    steps = int(sizes.max())
    row = np.repeat(np.arange(len(chains)), [len(x[2]) for x in chains])
    token = np.concatenate([np.array(x[2], np.int64) for x in chains])
    found = np.concatenate([np.array(x[3], np.int64) for x in chains])
    truth = np.zeros((len(chains), steps))
    toxic = np.array([x[0] for x in chains])[row] == 1
    truth[row[toxic], token[toxic]] = 1.0
    inside = np.arange(steps)[None, :] < sizes[:, None]
    seen = np.zeros((2, 2))
    both = inside[:, 1:]
    before, after = truth[:, :-1][both].astype(int), truth[:, 1:][both].astype(int)
    np.add.at(seen, (before, after), 1)
    weights, bias, moves, first = np.zeros(len(keys)), -2.0, np.zeros((2, 2)), -2.0
    model = Model(keys, weights, bias, moves, first, np.zeros(3))
    speed = [np.zeros(len(keys)), 0.0, np.zeros((2, 2)), 0.0]
    for _ in range(STEPS):
        emission = np.full((len(chains), steps), model.bias)
        np.add.at(emission, (row, token), model.weights[found])
        # Some chains at a time, which bounds the memory of all states and moves.
        parts = [_probabilities(emission[k : k + 1000], sizes[k : k + 1000], model) for k in range(0, len(chains), 1000)]
        p, expected = np.concatenate([x for x, _ in parts]), sum(x for _, x in parts)
        wrong = np.where(inside, truth - p, 0.0)
        slopes = [
            np.bincount(found, wrong[row, token], len(keys)) - DECAY * len(chains) * model.weights / len(keys),
            wrong.sum(),
            seen - expected,
            wrong[:, 0].sum(),
        ]
        speed = [0.9 * s + 0.1 * np.square(g) for s, g in zip(speed, slopes, strict=True)]
        weights, bias, moves, first = (
            x + RATE * g / (np.sqrt(s) + 1e-3)
            for x, g, s in zip((model.weights, model.bias, model.moves, model.first), slopes, speed, strict=True)
        )
        model = Model(keys, weights, float(bias), moves, float(first), np.zeros(3))
    return model


def score(documents: DataFrame, model: Model, *more: Column | str) -> DataFrame:
    """``doc_id``, the further columns, ``score`` and ``spans`` (code points and mean probability) of every document."""
    rows = texts(documents, *more)
    kept = [x for x in rows.columns if x != "text"]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, spans = [], []
            for _, _, data, offsets in text_slices(batch.column("text")):
                starts, ends, toxic, bounds = _marginals(data, offsets, model)
                scores += _scores(_document_features(toxic, bounds), model).tolist()
                own: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
                marked = np.flatnonzero(toxic >= 0.5)
                owner = np.searchsorted(bounds, marked, "right") - 1
                # Neighbouring toxic tokens of one document form one span.
                new = np.append(True, (np.diff(marked) != 1) | (np.diff(owner) != 0))[: len(marked)]
                for group in np.split(marked, np.flatnonzero(new)[1:]) if len(marked) else []:
                    k = int(np.searchsorted(bounds, group[0], "right")) - 1
                    raw = data[offsets[k] : offsets[k + 1]].tobytes()
                    low, high = int(starts[group[0]] - offsets[k]), int(ends[group[-1]] - offsets[k])
                    start = len(raw[:low].decode())
                    size = len(raw[low:high].decode())
                    own[k].append({"start": start, "end": start + size, "probability": float(toxic[group].mean())})
                spans += own
            arrays = [batch.column(x) for x in kept] + [pa.array(scores, pa.float64()), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "score", "spans"])

    schema = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in rows.schema if x.name != "text")
    ddl = "array<struct<start:long,end:long,probability:double>>"
    return rows.mapInArrow(scan, f"{schema}, score double, spans {ddl}")


def clean_documents(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of ``documents`` but those whose score reaches ``threshold``."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.zeros(0)]
            for _, _, data, offsets in text_slices(batch.column("text").fill_null("")):
                _, _, toxic, bounds = _marginals(data, offsets, model)
                scores.append(_scores(_document_features(toxic, bounds), model))
            yield batch.filter(pa.array(np.concatenate(scores) < threshold))

    return documents.mapInArrow(keep, documents.schema)
