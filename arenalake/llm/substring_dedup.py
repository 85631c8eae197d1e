"""Repeated passages of words, by super-k-mers.

A window is 50 consecutive words of one document. A word is removed if a window that
covers it also starts in a document with a smaller id; windows are judged on the
input. Consecutive windows that share a minimiser (the smallest hash of 10
consecutive words) form a super-k-mer, which travels as one packed string to the
bucket of its minimiser; there its windows are sorted, and equal ones have their
smallest document counted exactly. ``window_repeats`` describes the steps.

Null text: no words. A null id comes before all others. Rows with equal ids do not
remove anything from each other. A document of fewer words than a window stays
whole. Empty table: no row. Other columns are ignored.
"""

from collections.abc import Callable
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame

from arenalake.llm.window_repeats import Job, Slice, without_repeats
from arenalake.llm.words import word_hashes, word_spans

WINDOW = 50
GRAM = 10


class Words(Slice):
    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.raw = data.tobytes()
        self.starts, self.ends = word_spans(data, offsets)
        self.bounds = np.searchsorted(self.starts, offsets)
        self.codes = word_hashes(data, self.starts, self.ends)

    def packed(self, start: int, end: int) -> bytes:
        return b" ".join(self.raw[self.starts[start] : self.ends[end - 1]].split())

    def joined(self, pieces: list[bytes]) -> bytes:
        return b" ".join(pieces)


def _compare(width: int) -> Callable:
    def compare(items: list[dict]) -> list[tuple[int, int, int]]:
        """Windows of each string that another string of a smaller document holds."""
        out = []
        order = sorted(range(len(items)), key=lambda k: items[k]["least"])
        for _, group in groupby(order, key=lambda k: items[k]["least"]):
            windows = []
            for k in group:
                words = items[k]["string"].split(b" ")
                for j in range(items[k]["count"]):
                    windows.append((b" ".join(words[j : j + width]), items[k]["doc"], k, j))
            windows.sort()
            repeats = []
            for _, equal in groupby(windows, key=lambda x: x[0]):
                equal = list(equal)
                repeats += [(k, j) for _, doc, k, j in equal if doc > equal[0][1]]
            repeats.sort()
            for k, j in repeats:
                if out and out[-1][0] == k and out[-1][2] == j - 1:
                    out[-1] = (k, out[-1][1], j)
                else:
                    out.append((k, j, j))
        return out

    return compare


def remove_repeated_passages(
    documents: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    kept: Callable[[bytes], bytes | str] = bytes,
    kept_type: str = "binary",
) -> DataFrame:
    """``doc_id, n, spans, kept``: words, removed ranges of words, and the other words joined by one blank.

    ``kept`` is applied to the joined words before they leave the task.
    """
    return without_repeats(documents, Job(window, gram, Words, False, _compare(window), kept, kept_type))
