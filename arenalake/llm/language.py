"""Language identification by cross-parsing.

For every language, a suffix automaton of a sample of its labelled texts accepts
exactly the substrings of that sample. A text is parsed from left to right into the
longest phrases the automaton accepts; a text in the sample's language needs few of
them. ``phrases * log2(sample length) / text length`` estimates the cross entropy in
bits, and the language with the least wins.

The sample is bounded: of each language's labelled texts, some ``SAMPLE_TEXTS`` rows by a
hash of id and text (equal rows count once), in the order of the hash as many as fit
into ``SAMPLE_CHARS`` code points, each of them whole; where none fits, the shortest. Prediction reads
whole texts, in blocks of ``BLOCK`` code points
that are parsed side by side; a block's end also ends a phrase, for all languages
alike. All characters of the samples are told apart: the most frequent, at most ``CLASSES - 1``, have
a column each in a table of transitions, those of all others are looked up among sorted
keys. The table has at most ``TABLE_CELLS`` cells, so with hundreds of languages it has few
columns, and most transitions are keys: slower, with the same result. A character of no sample ends a phrase in every language. Only letters and single blanks between them are parsed, in lower case.

The score is 1 - least / second least of the estimates (1 with one language).
Without a letter, or without any labelled text, the prediction is ``und`` and the
score 0. Ties go to the language first in alphabetical order. Null text: the empty
text. Null languages are not learned. Each row is predicted for itself, also with a
null or repeated id. An empty table gives no row.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arenalake.llm.store import texts

SAMPLE_TEXTS = 60
SAMPLE_CHARS = 30_000
CLASSES = 128  # columns of the table of transitions; the transitions of rarer characters are sorted keys
TABLE_CELLS = 48_000_000
BLOCK = 1024
LANES = 4096
NO_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower case, with one blank for everything that is no letter."""
    return NO_LETTERS.sub(" ", text.lower()).strip(" ")


def suffix_moves(codes: list[int]) -> list[dict[int, int]]:
    """For each state of the suffix automaton of ``codes`` its transitions; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for code in codes:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and code not in moves[at]:
            moves[at][code] = new
            at = link[at]
        if at >= 0:
            old = moves[at][code]
            if length[at] + 1 == length[old]:
                link[new] = old
            else:
                copy = len(moves)
                moves.append(dict(moves[old]))
                length.append(length[at] + 1)
                link.append(link[old])
                while at >= 0 and moves[at].get(code) == old:
                    moves[at][code] = copy
                    at = link[at]
                link[old] = link[new] = copy
        last = new
    return moves


def dense(moves: list[dict[int, int]], classes: int) -> np.ndarray:
    """The transitions by codes below ``classes``, -1 where there is none."""
    table = np.full((len(moves), classes), -1, np.int32)
    for state, out in enumerate(moves):
        for code, target in out.items():
            if code < classes:
                table[state, code] = target
    return table


def suffix_automaton(codes: list[int], classes: int) -> np.ndarray:
    """The transitions of the suffix automaton of ``codes``, -1 where there is none; state 0 is the start."""
    return dense(suffix_moves(codes), classes)


class CrossParser:
    """Counts, for many texts at once, the phrases each language's sample needs."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        everything = "".join(samples.values())
        points, times = np.unique(_points(everything), return_counts=True)
        # Codes by frequency, from 1; points are sorted.
        self.known, self.code = points, np.empty(len(points), np.int64)
        self.code[np.argsort(-times, kind="stable")] = np.arange(1, len(points) + 1)
        automata = [suffix_moves(self._classes(_points(samples[x])).tolist()) for x in self.languages]
        states = sum(map(len, automata))
        self.width = width = max(1, min(len(points) + 1, CLASSES, TABLE_CELLS // max(1, states)))
        kind = np.int32 if 2 * states * width < 1 << 31 else np.int64
        roots, at = [], 0
        keys, targets = [], []
        self.table = np.zeros(states * width, kind)
        for moves in automata:
            for state, out in enumerate(moves):
                for code, target in out.items():
                    if code >= width:
                        keys.append(self._key(at + state, code))
                        targets.append(at + target)
            table = dense(moves, width).astype(kind)  # class 0: characters of no sample
            start = table[0].copy()
            # A phrase that cannot go on ends, and the character begins the next one.
            fails = table < 0
            table = np.where(fails, np.where(start < 0, 0, start)[None, :], table)
            # The lowest bit counts the phrase; the rest is where the next state's row begins.
            self.table[at * width : (at + len(table)) * width] = ((table + at) * (width * 2) + fails).ravel()
            roots.append(at * width)
            at += len(table)
        self.roots = np.array(roots, np.int64)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.targets = np.array(keys, np.int64)[order], np.array(targets, np.int64)[order]
        self.bits = np.log2([max(2, len(samples[x])) for x in self.languages])

    def _classes(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, points), len(self.known) - 1)
        return np.where(self.known[at] == points, self.code[at], 0)

    def _key(self, state, code):
        return state * (len(self.known) + 1) + code

    def _rare(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where transitions by codes without a column lead, and whether they end a phrase; a row for each language."""
        def look(states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            wanted = self._key(states // self.width, code)
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            return self.targets[at] * self.width, self.keys[at] == wanted

        roots = np.broadcast_to(self.roots[:, None], state.shape)
        (target, goes), (first, starts) = look(state), look(roots)
        return np.where(goes, target, np.where(starts, first, roots)), ~goes

    def phrases(self, cleaned: list[str]) -> np.ndarray:
        """A row for each text, a column for each language."""
        out = np.zeros((len(cleaned), len(self.languages)), np.int64)
        sizes = np.array([len(x) for x in cleaned], np.int64)
        codes = self._classes(_points("".join(cleaned)))
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(cleaned)), blocks)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = np.repeat(np.cumsum(sizes) - sizes, blocks) + number * BLOCK
        lengths = np.minimum(np.repeat(sizes, blocks) - number * BLOCK, BLOCK)
        order = np.argsort(-lengths, kind="stable")
        for low in range(0, len(order), LANES):
            lanes = order[low : low + LANES]
            counts = self._block(codes, starts[lanes], lengths[lanes])
            np.add.at(out, owner[lanes], counts.T)
        return out

    def _block(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of blocks that are sorted by falling length, a row for each language."""
        steps = int(lengths[0])
        active = np.searchsorted(-lengths, -np.arange(steps), "left")  # blocks longer than each step
        counts = np.ones((len(self.languages), len(lengths)), np.int64)
        state = np.repeat(self.roots[:, None], len(lengths), 1)
        some_rare = bool(len(self.keys)) and bool((codes >= self.width).any())
        for step in range(steps):
            n = int(active[step])
            code = codes[starts[:n] + step]
            if some_rare:
                rare = np.flatnonzero(code >= self.width)
                if len(rare):
                    target, ends = self._rare(state[:, rare], code[rare])
                    code = np.where(code >= self.width, 0, code)
            moved = self.table[state[:, :n] + code]
            counts[:, :n] += moved & 1
            state[:, :n] = moved >> 1
            if some_rare and len(rare):
                # Code 0 has ended a phrase in every language.
                counts[:, rare] += ends.astype(np.int64) - 1
                state[:, rare] = target
        return counts

    def predict(self, documents: list[str]) -> tuple[list[str], list[float]]:
        cleaned = [letters(x) for x in documents]
        names, scores = [], []
        if not self.languages:
            return ["und"] * len(documents), [0.0] * len(documents)
        rates = self.phrases(cleaned) * self.bits / np.maximum([len(x) for x in cleaned], 1)[:, None]
        for text, row in zip(cleaned, rates, strict=True):
            if not any(map(str.isalpha, text)):
                names.append("und")
                scores.append(0.0)
                continue
            best = int(np.argmin(row))
            others = np.delete(row, best)
            names.append(self.languages[best])
            scores.append(float(1 - row[best] / others.min()) if len(others) else 1.0)
        return names, scores


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def learned(labelled: DataFrame) -> dict[str, str]:
    """A bounded sample of cleaned text for each language of ``labelled`` (columns text, lang and doc_id)."""
    rows = texts(labelled, F.col("lang").cast("string").alias("lang")).where("lang is not null and text <> ''")
    rows = rows.withColumn("order", F.xxhash64("doc_id", "text"))
    # One row for each language.
    counts = {x.lang: x.n for x in rows.groupBy("lang").agg(F.count_distinct("order").alias("n")).collect()}
    if not counts:
        return {}
    chance = F.pmod("order", F.lit(1_000_000))
    most = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, SAMPLE_TEXTS / n) * 1_000_000)))
    # Some SAMPLE_TEXTS rows of two numbers for each language.
    ranked = (
        rows.where(chance < F.element_at(most, F.col("lang")))
        .groupBy("lang", "order")
        .agg(F.min(F.length("text")).alias("size"))
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("order")))
        .where(F.col("rank") <= 4 * SAMPLE_TEXTS)
    )
    chosen = _fitting(sorted(map(tuple, ranked.select("lang", "order", "size").collect())))
    if not chosen:
        return {}
    wanted = rows.sparkSession.createDataFrame(chosen, "lang string, order long")
    found = rows.join(F.broadcast(wanted), ["lang", "order"]).groupBy("lang", "order").agg(F.min("text").alias("text"))
    parts: dict[str, list[str]] = {}
    for row in sorted(found.collect()):
        parts.setdefault(row.lang, []).append(letters(row.text))
    samples = {k: " ".join(x) for k, x in parts.items()}
    return {k: x for k, x in samples.items() if x}


def _fitting(rows: list[tuple[str, int, int]]) -> list[tuple[str, int]]:
    """Of each language, in order, the (language, order, size) that fit into ``SAMPLE_CHARS``; the shortest if none does."""
    taken: dict[str, int] = {}
    out = []
    for lang, order, size in rows:
        if taken.get(lang, 0) + size <= SAMPLE_CHARS:
            taken[lang] = taken.get(lang, 0) + size
            out.append((lang, order))
    for lang in {x[0] for x in rows} - set(taken):
        _, order = min((size, order) for name, order, size in rows if name == lang)
        out.append((lang, order))
    return out


_parsers: dict[tuple, CrossParser] = {}


def _parser(samples: tuple[tuple[str, str], ...]) -> CrossParser:
    """The worker's parser of these samples, built once."""
    if samples not in _parsers:
        _parsers.clear()
        _parsers[samples] = CrossParser(dict(samples))
    return _parsers[samples]


def identify(documents: DataFrame, samples: dict[str, str], *more: Column | str) -> DataFrame:
    """``doc_id``, the further columns, ``lang_pred`` and ``score`` of every document; only its text is used."""
    key = tuple(sorted(samples.items()))
    rows = texts(documents, *more)
    kept = [x for x in rows.columns if x != "text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(key)
        for batch in batches:
            column, names, scores, first = batch.column("text").to_pylist(), [], [], 0
            while first < len(column):  # some million code points at a time
                last, size = first, 0
                while last < len(column) and (last == first or size < 4_000_000):
                    size += len(column[last])
                    last += 1
                block = parser.predict(column[first:last])
                names += block[0]
                scores += block[1]
                first = last
            arrays = [batch.column(x) for x in kept] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "lang_pred", "score"])

    schema = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in rows.schema if x.name != "text")
    return rows.mapInArrow(scan, f"{schema}, lang_pred string, score double")
