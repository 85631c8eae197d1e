"""Fingerprints of texts from prefix polynomial hashes.

``PrefixHashes`` holds, for two bases modulo the prime 2**31 - 1, the sums of
``code * base**i`` over all prefixes. The hash of any span is a difference of two
entries, so spans are compared in constant time and the longest common extension
of two positions is found by binary search.

A fingerprint is ``length:hash of the whole text:sketch``. The sketch has the 32
smallest distinct hashes of all spans of 8 code points (of the whole text, if it
is shorter), each shortened to 32 bits. The likeness of two fingerprints is 1 if
length and hash agree, else the share of common values among the smallest of both
sketches, an estimate of the Jaccard similarity of the two sets of spans.

``neighbours`` compares each text with an edited one (its second half replaced by
the beginning of the next document) and with the next document, in ascending order
of ``doc_id``; rows with equal ids are ordered by text, rows without an id come
first. Null text: the empty text. An empty table gives no row. Other columns are
ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arenalake.llm.store import stored, texts
from arenalake.llm.words import mixed

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 1_664_525_777)
SPAN = 8
SKETCH = 32
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse, by doubling; kept for the next call."""
    have = _tables.get(base)
    if have is None or len(have[0]) < count:
        size, both = 1 << max(16, int(count).bit_length()), []
        for x in (base, pow(base, -1, PRIME)):
            out = np.ones(1, np.uint64)
            while len(out) < size:
                out = np.concatenate([out, out * np.uint64(pow(x, len(out), PRIME)) % np.uint64(PRIME)])
            both.append(out)
        have = _tables[base] = (both[0], both[1])
    return have[0][:count], have[1][:count]


class PrefixHashes:
    """Prefix sums of a sequence of code points (or of several, one after another)."""

    def __init__(self, codes: np.ndarray):
        self.codes = len(codes)
        self.sums, self.back = [], []
        for base in BASES:
            forward, backward = _powers(base, len(codes) + 1)
            terms = (codes.astype(np.uint64) + np.uint64(1)) * forward[:-1] % np.uint64(PRIME)
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])
            self.sums.append(sums)
            self.back.append(backward)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 62-bit hash for each span."""
        high, low = (
            (sums[ends] - sums[starts]) % np.uint64(PRIME) * back[starts] % np.uint64(PRIME)
            for sums, back in zip(self.sums, self.back, strict=True)
        )
        return high << np.uint64(31) | low

    def windows(self, length: int) -> np.ndarray:
        """The hash of the span of ``length`` at every position that has one."""
        if length > self.codes:
            return np.zeros(0, np.uint64)
        high, low = (
            (sums[length:] - sums[:-length]) % np.uint64(PRIME) * back[: len(sums) - length] % np.uint64(PRIME)
            for sums, back in zip(self.sums, self.back, strict=True)
        )
        return high << np.uint64(31) | low

    def common_extensions(self, left: np.ndarray, right: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """For each pair of positions, the longest length up to its limit at which both spans are equal."""
        low, high = np.zeros(len(limits), np.int64), limits.astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.spans(left, left + middle) == self.spans(right, right + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def fingerprints(hashes: PrefixHashes, offsets: np.ndarray) -> list[str]:
    """The fingerprint of each of the texts that follow one another in ``hashes``."""
    lengths = np.diff(offsets)
    whole = hashes.spans(offsets[:-1], offsets[1:])
    windows = mixed(hashes.windows(SPAN))
    counts = np.maximum(lengths - SPAN + 1, 0)
    # Some 4 * SKETCH of a text's spans lie below its bound; the rest need no sorting.
    share = np.minimum(1.0, 4 * SKETCH / np.maximum(counts, 1))
    bounds = np.where(share < 1, share * 2.0**64, 2.0**64 - 2048).astype(np.uint64)
    bounds[counts == 0] = 0
    inside = windows < np.repeat(bounds, lengths)[: len(windows)]
    inside &= np.arange(len(windows)) <= np.repeat(offsets[1:] - SPAN, lengths)[: len(windows)]
    places = np.flatnonzero(inside)
    cuts = np.searchsorted(places, offsets)
    out = []
    for k, n in enumerate(lengths.tolist()):
        if n < SPAN:
            smallest = mixed(whole[k : k + 1]) if n else whole[:0]
        else:
            smallest = np.unique(windows[places[cuts[k] : cuts[k + 1]]])[:SKETCH]
            if len(smallest) < SKETCH:
                smallest = np.unique(windows[offsets[k] : offsets[k + 1] - SPAN + 1])[:SKETCH]
        values = (smallest >> np.uint64(32)).astype(">u4").tobytes().hex()
        out.append(f"{n}:{int(whole[k]):016x}:{values}")
    return out


def likeness(left: str, right: str) -> float:
    """From two fingerprints, how alike the texts are, from 0 to 1."""
    (left_whole, left_sketch), (right_whole, right_sketch) = (x.rsplit(":", 1) for x in (left, right))
    if left_whole == right_whole:
        return 1.0
    first, second = ({s[i : i + 8] for i in range(0, len(s), 8)} for s in (left_sketch, right_sketch))
    smallest = sorted(first | second)[: max(len(first), len(second))]
    return sum(x in first and x in second for x in smallest) / len(smallest) if smallest else 0.0


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(rows: list[tuple[int | None, str, str]]) -> list[tuple]:
    """One result for each (doc_id, text, next text)."""
    out: list[tuple] = []
    first = 0
    while first < len(rows):  # some million code points at a time
        last, size = first, 0
        while last < len(rows) and (last == first or size < 600_000):
            size += 3 * len(rows[last][1])
            last += 1
        block = [x for _, text, following in rows[first:last] for x in (text, edited_text(text, following), following)]
        offsets = np.cumsum([0, *map(len, block)])
        hashes = PrefixHashes(code_points("".join(block)))
        prints = fingerprints(hashes, offsets)
        starts, sizes = offsets[:-1], np.diff(offsets)
        limits = np.minimum(sizes[0::3], sizes[1::3]), np.minimum(sizes[0::3], sizes[2::3])
        same_edited = hashes.common_extensions(starts[0::3], starts[1::3], limits[0]).tolist()
        same_next = hashes.common_extensions(starts[0::3], starts[2::3], limits[1]).tolist()
        for k, (doc, text, _) in enumerate(rows[first:last]):
            own, edited, following = prints[3 * k : 3 * k + 3]
            digest = hashlib.sha256(block[3 * k + 1].encode("utf-8", "surrogatepass")).hexdigest()
            near = likeness(own, edited), likeness(own, following)
            out.append((doc, len(text), digest, own, edited, *near, same_edited[k], same_next[k]))
        first = last
    return out


RESULT = [
    ("doc_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
    ("common_edited", pa.int64()),
    ("common_next", pa.int64()),
]
RESULT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_edited long, common_next long"
)
FULL, FIRST, LAST = 0, 1, 2


def _batch(kind: int, part: int, results: list[tuple], texts_: list[str | None]) -> pa.RecordBatch:
    columns = list(zip(*results, strict=True)) or [()] * len(RESULT)
    arrays = [pa.array([kind] * len(results), pa.int32()), pa.array([part] * len(results), pa.int64())]
    arrays += [pa.array(x, t) for x, (_, t) in zip(columns, RESULT, strict=True)]
    names = ["kind", "part", *(name for name, _ in RESULT), "text"]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(texts_, pa.string())], names)


def _within_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows but a part's last, and the part's first and last row with their texts."""
    part, before = TaskContext.get().partitionId(), None
    empty = (None,) * (len(RESULT) - 1)
    for batch in batches:
        rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True))
        if not rows:
            continue
        if before is None:
            yield _batch(FIRST, part, [(rows[0][0], *empty)], [rows[0][1]])
        else:
            rows.insert(0, before)
        before = rows[-1]
        results = compared([(*row, after[1]) for row, after in zip(rows, rows[1:], strict=False)])
        yield _batch(FULL, part, results, [None] * len(results))
    if before is not None:
        yield _batch(LAST, part, [(before[0], *empty)], [before[1]])


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "following"))
        results = compared(list(zip(*columns, strict=True)))
        yield _batch(FULL, 0, results, [None] * len(results)).select([name for name, _ in RESULT])


def neighbours(documents: DataFrame) -> DataFrame:
    """One row for each document: its fingerprint, and how it compares with the edited text and the next.

    The table is dealt out by ranges of ``doc_id``. A task compares the rows it
    has; the last row of a part meets the first row of the next part afterwards,
    which concerns one row for each task.
    """
    ordered = texts(documents).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = stored(ordered.mapInArrow(_within_parts, f"kind int, part long, {RESULT_DDL}, text string"))
    heads = rows.where(F.col("kind") == FIRST).select("part", F.col("text").alias("following"))
    parts = heads.select("part")
    after = Window.orderBy("part")
    first = F.min("part").over(after.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    links = parts.select("part", F.coalesce(F.lead("part").over(after), first).alias("next_part"))
    ends = (
        rows.where(F.col("kind") == LAST)
        .select("part", "doc_id", "text")
        .join(links, "part")
        .join(heads.withColumnRenamed("part", "next_part"), "next_part")
        .select("doc_id", "text", "following")
    )
    names = [name for name, _ in RESULT]
    return rows.where(F.col("kind") == FULL).select(names).unionByName(ends.mapInArrow(_borders, RESULT_DDL))
