"""Repeated strings of bytes, by longest-previous-factor arrays.

A byte is removed if a string of 100 bytes that covers it also starts earlier: in a
document with a smaller id, or earlier in the same document. Strings may overlap, never
cross documents, and are judged on the input.

In the order of suffixes, the nearest neighbours on both sides that stand earlier in
the text (previous and next smaller position) share the longest prefix with a suffix
among all earlier ones; the larger of both lengths is its longest previous factor. A
place is a repeat if that reaches 100. Suffixes are dealt out to tasks by a key that
equal strings of 100 bytes share, see ``window_repeats``; each task sorts the suffixes
it holds and builds the array from their order.

Null text: the empty text. A null id comes before all others. Rows with equal ids are
taken in a fixed order as earlier and later documents. Shorter texts stay whole. Empty
table: no row. Other columns are ignored.
"""

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from arenalake.llm.window_repeats import Job, Slice, without_repeats
from arenalake.llm.words import BYTE_CODES

LENGTH = 100
GRAM = 48


class Bytes(Slice):
    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.raw = data.tobytes()
        self.bounds = offsets
        self.codes = BYTE_CODES[data]

    def packed(self, start: int, end: int) -> bytes:
        return self.raw[start:end]

    def joined(self, pieces: list[bytes]) -> bytes:
        return b"".join(pieces)


def longest_previous_factors(data: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """For each of the ascending ``places``, the longest match, at most ``depth``, with an earlier one of them.

    Suffixes are sorted by their first ``depth`` bytes; beyond the end, a suffix counts
    as filled up with zeros.
    """
    if not len(places):
        return np.zeros(0, np.int64)
    padded = np.append(data, np.zeros(depth, np.uint8))
    heads = np.lib.stride_tricks.sliding_window_view(padded, depth)[places]
    order = np.argsort(heads.view(f"S{depth}").ravel(), kind="stable")  # equal ones by place
    at, heads = places[order], heads[order]
    differs = heads[1:] != heads[:-1]
    common = np.zeros(len(at), np.int64)  # with the neighbour before
    common[1:] = np.where(differs.any(1), differs.argmax(1), depth)
    # A suffix leaves the stack when the next smaller place comes; below it lies the previous
    # smaller one. With both it shares the length kept with it and the least one since.
    longest = dict.fromkeys(places.tolist(), 0)
    stack: list[tuple[int, int]] = []
    for place, shared in zip([*at.tolist(), -1], [*common.tolist(), 0], strict=True):
        while stack and place < stack[-1][0]:
            higher, kept = stack.pop()
            longest[higher] = max(kept, shared)
            shared = min(kept, shared)
        stack.append((place, shared))
    return np.array(list(longest.values()), np.int64)


def _compare(length: int) -> Callable:
    def compare(items: list[dict]) -> list[tuple[int, int, int]]:
        """Places of each string at which an earlier one begins with the same ``length`` bytes."""
        order = sorted(range(len(items)), key=lambda k: [items[k][x] for x in ("doc", "src", "row", "start")])
        strings = [items[k]["string"] for k in order]
        begins = np.cumsum([0, *map(len, strings)])
        data = np.frombuffer(b"".join(strings), np.uint8)
        counts = np.array([items[k]["count"] for k in order], np.int64)
        owner = np.repeat(np.arange(len(order)), counts)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        repeats = longest_previous_factors(data, begins[owner] + offset, length) >= length
        new = repeats.copy()
        new[1:] &= ~repeats[:-1] | (owner[1:] != owner[:-1])
        last = repeats.copy()
        last[:-1] &= ~repeats[1:] | (owner[1:] != owner[:-1])
        lows, highs = np.flatnonzero(new), np.flatnonzero(last)
        return [
            (order[owner[a]], int(offset[a]), int(offset[b])) for a, b in zip(lows.tolist(), highs.tolist(), strict=True)
        ]

    return compare


def remove_repeated_strings(
    documents: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    kept: Callable[[bytes], bytes | str] = bytes,
    kept_type: str = "binary",
) -> DataFrame:
    """``doc_id, n, spans, kept``: bytes, removed ranges of bytes, and the other bytes.

    ``kept`` is applied to the remaining bytes before they leave the task.
    """
    return without_repeats(documents, Job(length, gram, Bytes, True, _compare(length), kept, kept_type))
