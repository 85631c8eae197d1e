"""Secrets in texts: fixed patterns, and strings that look random.

Patterns give the base spans (kinds ``assign``, ``access``, ``hex``). Two Markov
models of characters add spans of the kind ``random``: one learned from the values
that the patterns matched in the labelled texts, one from the other identifiers
there. Runs of characters of an identifier, without what base spans cover, are scored by the
log-likelihood ratio of the models. Each character counts by how much its ratio exceeds ``MARGIN``;
segments that no longer or shorter one improves are added if they have ``LEAST`` characters and their sum
exceeds ``LEAST_GAIN``. So a key is found behind another id or at the end of a long path as well.

The models are counts of character pairs over all labelled texts; only these
counts, of a fixed size, reach the driver. Without any matched value the model of
random strings is uniform.

Null text: the empty text, without spans. Rows with null or repeated ids are
scanned one by one. Empty table: no row, and a uniform model. ``find_secrets`` ignores
other columns. A text is held in one task, with some 10 bytes for each of its bytes. Positions are code
points, ends exclusive.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.llm.store import texts
from arenalake.llm.words import runs, text_slices

#: Fixed: the patterns of the base spans and the least length of what they match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KINDS = ("assign", "access", "hex", "random")

LEAST = 20
LEARN_LEAST = 12
MARGIN = 0.7
LEAST_GAIN = 5.0
#: Share of each model that is spread evenly over all characters.
RANDOM_FLOOR, USUAL_FLOOR = 0.25, 0.01
BACK_OFF = 8.0

_ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(_ALPHABET) + 1  # and the place before the first character
CODE = np.zeros(256, np.int64)
CODE[list(_ALPHABET)] = np.arange(1, SIZE)
IS_CANDIDATE = CODE > 0
IS_HEX = np.zeros(256, bool)
IS_HEX[list(b"0123456789abcdef")] = True
IS_SIGN = np.zeros(256, bool)
IS_SIGN[list(b":=")] = True


@dataclass(frozen=True)
class Model:
    """Logarithm of the ratio of both models' probabilities, by previous and next character."""

    ratio: np.ndarray


def _pairs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """previous * SIZE + next for all characters of all spans, and where each span begins."""
    lengths = ends - starts
    begins = np.cumsum(lengths) - lengths
    places = np.repeat(starts - begins, lengths) + np.arange(int(lengths.sum()))
    codes = CODE[data[places]]
    before = np.append(0, codes[:-1])
    before[begins[lengths > 0]] = 0
    return before * SIZE + codes, begins


def _base(data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
    """For each text, (kind, start, end, start of the value) of its base spans, in bytes."""
    found: list[list] = [[] for _ in range(len(offsets) - 1)]
    starts, ends = runs(IS_HEX[data], offsets)
    long = ends - starts >= HEX_LEAST
    owner = np.searchsorted(offsets, starts[long], "right") - 1
    for k, low, high in zip(owner.tolist(), starts[long].tolist(), ends[long].tolist(), strict=True):
        low, high = low - int(offsets[k]), high - int(offsets[k])
        found[k].append((2, low, high, low))
    signs = np.flatnonzero(IS_SIGN[data])
    marked = set((np.searchsorted(offsets, signs, "right") - 1).tolist())
    raw = data.tobytes()
    at = raw.find(b"AKIA")
    keyed = set()
    while at >= 0:
        keyed.add(int(np.searchsorted(offsets, at, "right")) - 1)
        at = raw.find(b"AKIA", at + 4)
    for k in sorted(marked | keyed):
        # Both patterns hold only ASCII, so Latin-1 keeps the bytes' positions.
        text = raw[int(offsets[k]) : int(offsets[k + 1])].decode("latin-1")
        if k in marked:
            hits = [m for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
            found[k] += [(0, m.start(), m.end(), m.start(2)) for m in hits]
        if k in keyed:
            hits = [m for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
            found[k] += [(1, m.start(), m.end(), m.start()) for m in hits]
        found[k].sort(key=lambda x: (x[1], x[0]))
    return found


def _others(data: np.ndarray, offsets: np.ndarray, base: list[list], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of at least ``least`` candidate characters that no base span covers."""
    inside = IS_CANDIDATE[data]
    for k, spans in enumerate(base):
        for _, low, high, _ in spans:
            inside[int(offsets[k]) + low : int(offsets[k]) + high] = False
    starts, ends = runs(inside, offsets)
    long = ends - starts >= least
    return starts[long], ends[long]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(2 * SIZE * SIZE, np.int64)
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column("text")):
            base = _base(data, offsets)
            values = [(x[3] + int(offsets[k]), x[2] + int(offsets[k])) for k, spans in enumerate(base) for x in spans]
            lows, highs = np.array(values, np.int64).reshape(-1, 2).T
            for label, spans in ((1, (lows, highs)), (0, _others(data, offsets, base, LEARN_LEAST))):
                pairs, _ = _pairs(data, *spans)
                counts += np.bincount(pairs + label * SIZE * SIZE, minlength=2 * SIZE * SIZE)
    places = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(counts[places])], ["pair", "times"])


def train(labelled: DataFrame) -> Model:
    """Both models from all texts of ``labelled``: values the patterns match, and other identifiers."""
    pairs = texts(labelled).select("text").mapInArrow(_count, "pair long, times long")
    # At most 2 * SIZE * SIZE rows, some nine thousand, whatever the input.
    rows = pairs.groupBy("pair").agg(F.sum("times").alias("times")).collect()
    counts = np.zeros(2 * SIZE * SIZE)
    for row in rows:
        counts[row.pair] = row.times
    usual, random = counts.reshape(2, SIZE, SIZE)

    def logarithms(table: np.ndarray, floor: float) -> np.ndarray:
        seen = table.sum(1, keepdims=True)
        alone = table.sum(0) / table.sum() if table.any() else np.full(SIZE, 1 / SIZE)
        # After a character seldom seen, the next one's own frequency counts for more.
        share = (table + BACK_OFF * alone) / (seen + BACK_OFF)
        return np.log((1 - floor) * share + floor / SIZE)

    return Model(logarithms(random, RANDOM_FLOOR) - logarithms(usual, USUAL_FLOOR))


def best_segments(gain: np.ndarray, least: int, threshold: float) -> list[tuple[int, int]]:
    """Segments that no longer or shorter one improves, if their sum exceeds ``threshold`` and they have ``least`` places.

    One pass: a segment is joined with an earlier one that begins lower and ends lower than it does.
    """
    kept: list[tuple[float, float, int, int, int]] = []  # sums at its begin and end, places, the last one that begins lower
    total = 0.0
    for at, value in enumerate(gain.tolist()):
        before, total = total, total + value
        if value <= 0:
            continue
        low, begin = before, at
        while True:
            k = len(kept) - 1
            while k >= 0 and kept[k][0] >= low:
                k = kept[k][4]
            if k < 0 or kept[k][1] >= total:
                kept.append((low, total, begin, at + 1, k))
                break
            low, begin = kept[k][0], kept[k][2]
            del kept[k:]
    return [(a, b) for low, high, a, b, _ in kept if high - low > threshold and b - a >= least]


def _spans(model: Model, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """For each text, (kind, start, end) of all its spans, in bytes."""
    base = _base(data, offsets)
    found = [[x[:3] for x in spans] for spans in base]
    starts, ends = _others(data, offsets, base, LEAST)
    if len(starts):
        pairs, begins = _pairs(data, starts, ends)
        gains = np.split(model.ratio.ravel()[pairs] - MARGIN, begins[1:])
        owner = np.searchsorted(offsets, starts, "right") - 1
        for k, start, gain in zip(owner.tolist(), starts.tolist(), gains, strict=True):
            at = start - int(offsets[k])
            found[k] += [(3, at + low, at + high) for low, high in best_segments(gain, LEAST, LEAST_GAIN)]
    for spans in found:
        spans.sort(key=lambda x: (x[1], x[0]))
    return found


def _in_code_points(raw: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    places, at, count = {}, 0, 0
    for place in sorted({x for span in spans for x in span[1:]}):
        count += len(raw[at:place].decode())
        at = place
        places[place] = count
    return [(kind, places[low], places[high]) for kind, low, high in spans]


SPANS_DDL = "array<struct<kind:string,start:long,end:long>>"


def find_secrets(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, spans``: for each document its spans by start, then kind as listed in ``KINDS``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            out: list[list[dict]] = []
            for _, _, data, offsets in text_slices(batch.column("text")):
                for k, spans in enumerate(_spans(model, data, offsets)):
                    if spans:
                        spans = _in_code_points(data[offsets[k] : offsets[k + 1]].tobytes(), spans)
                    out.append([{"kind": KINDS[x[0]], "start": x[1], "end": x[2]} for x in spans])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    return texts(documents).mapInArrow(scan, f"doc_id long, spans {SPANS_DDL}")


def redact(documents: DataFrame, model: Model, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns; in ``text`` every secret is replaced by ``mark`` and ``n_chars`` follows.

    Spans that overlap or touch become one mark. Rows without secrets, null
    texts included, stay as they are.
    """
    schema = documents.schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            column = batch.column("text")
            text = column.to_pylist()
            for first, _, data, offsets in text_slices(column.fill_null("")):
                for k, spans in enumerate(_spans(model, data, offsets)):
                    if spans:
                        raw, kept, at = data[offsets[k] : offsets[k + 1]].tobytes(), [], 0
                        for _, low, high in spans:
                            if low > at or not kept:
                                kept += [raw[at:low], mark.encode()]
                            at = max(at, high)
                        text[first + k] = b"".join([*kept, raw[at:]]).decode()
            arrays = list(batch.columns)
            arrays[names.index("text")] = pa.array(text, column.type)
            if "n_chars" in names:
                at = names.index("n_chars")
                sizes = [n if new is None else len(new) for n, new in zip(arrays[at].to_pylist(), text, strict=True)]
                arrays[at] = pa.array(sizes, arrays[at].type)
            yield pa.RecordBatch.from_arrays(arrays, names)

    return documents.mapInArrow(scan, schema)
