"""Super-k-mers: runs of consecutive windows that share their smallest gram hash.

A sequence of codes (bytes, or hashes of words) has a window of ``width`` at every
place, and a gram of ``gram`` codes at every place. Equal windows have equal smallest
gram hashes, so a window can only equal windows of the same bucket of that hash.

A smallest gram lies in at most ``width - gram + 1`` windows, so a longer run means that it comes
again and again (a line of blanks). Such a run is cut after that many windows; its pieces are
equal and count as one, however long the run is. Long texts are taken in blocks of windows.
"""

import numpy as np

from arenalake.llm.words import mixed, powers, BASE, BASE_INVERSE


class Sums:
    """Hashes of spans of one array of codes, from its prefix sums modulo 2**64."""

    def __init__(self, codes: np.ndarray):
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * powers(BASE, len(codes)), out=self.sums[1:])
        self.back = powers(BASE_INVERSE, len(codes) + 1)

    def grams(self, size: int) -> np.ndarray:
        return mixed((self.sums[size:] - self.sums[:-size]) * self.back[: len(self.sums) - size])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = (ends - starts).astype(np.uint64)
        hashes = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mixed(hashes + lengths * np.uint64(0xD6E8FEB86659FD93))


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` neighbours, by doubling."""
    out, have = values, 1
    while have < size:
        step = min(have, size - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


#: Windows that are handled at a time.
BLOCK = 1 << 20


def blocks(codes: np.ndarray, bounds: np.ndarray, width: int, size: int | None = None):
    """(first window, codes, bounds) of the blocks of a long array; together they hold every window once."""
    size = size or BLOCK
    for low in range(0, max(1, len(codes) - width + 1), size):
        high = min(len(codes), low + size + width - 1)
        yield low, codes[low:high], np.clip(bounds, low, high) - low


def super_kmers(codes: np.ndarray, bounds: np.ndarray, width: int, gram: int):
    """(starts, numbers of windows, smallest gram hash, hash of the whole) of all super-k-mers.

    ``bounds``: where each document begins among the codes, and the end. No window
    crosses a document's border.
    """
    found = [
        (starts + low, *more)
        for low, part, inside in blocks(codes, bounds, width)
        for starts, *more in [_super_kmers(part, inside, width, gram)]
    ]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _super_kmers(codes: np.ndarray, bounds: np.ndarray, width: int, gram: int):
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if len(codes) < width:
        return none
    sums = Sums(codes)
    least = sliding_minimum(sums.grams(gram), width - gram + 1)
    sizes = np.diff(bounds)
    owner_end = np.repeat(bounds[1:], sizes)[: len(least)]
    owner_start = np.repeat(bounds[:-1], sizes)[: len(least)]
    places = np.arange(len(least))
    whole = places + width <= owner_end
    new = whole.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~whole[:-1] | (owner_start[1:] != owner_start[:-1])
    starts = np.flatnonzero(new)
    if not len(starts):
        return none
    last = whole.copy()
    last[:-1] &= new[1:] | ~whole[1:]
    counts = np.flatnonzero(last) + 1 - starts
    most = width - gram + 1
    if (counts > most).any():
        pieces = -(-counts // most)
        number = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        ends = np.repeat(starts + counts, pieces)
        starts = np.repeat(starts, pieces) + number * most
        counts = np.minimum(ends - starts, most)
    return starts, counts, least[starts], sums.spans(starts, starts + counts + width - 1)


def united(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals, as maximal intervals in ascending order; touching ones become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]
