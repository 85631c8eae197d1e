"""Words and hashes of a whole batch of texts at once, as numpy arrays."""

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Fixed: the white space of the word pattern ``[^\x20\x09-\x0D]+``.
WORD_SPACE = b" \t\n\x0b\x0c\r"
#: An odd multiplier of the polynomials, modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)

_generator = np.random.default_rng(20240101)
BYTE_CODES = _generator.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(WORD_SPACE)] = True
IS_CAPITAL = np.zeros(256, np.uint8)
IS_CAPITAL[65:91] = 32
_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        size = 1 << max(16, int(count).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:count]


def release_memory() -> None:
    """Give back to the system what earlier work of another kind has left in this worker."""
    _powers.clear()
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``codes[start:end]`` for each span, from one array of prefix sums."""
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(BASE, len(codes)), out=sums[1:])
    back = powers(BASE_INVERSE, len(codes) + 1)[starts]
    lengths = (ends - starts).astype(np.uint64)
    return mixed((sums[ends] - sums[starts]) * back + lengths * np.uint64(0xD6E8FEB86659FD93))


#: Bytes of a text whose words are hashed at a time.
HASHED_BYTES = 1 << 20


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word ``data[start:end]``; the words are in order and do not overlap. Long data goes in blocks."""
    out = np.zeros(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + HASHED_BYTES, "right")))
        first, last = int(starts[low]), int(ends[high - 1])
        out[low:high] = span_hashes(BYTE_CODES[data[first:last]], starts[low:high] - first, ends[low:high] - first)
        low = high
    return out


def text_slices(texts: pa.Array, most_bytes: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, data, offsets) of consecutive texts, some ``most_bytes`` at a time.

    A single text may be longer; memory is bounded by the longest text.
    """
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + most_bytes, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values; a run never crosses the border of a text."""
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(inside))]
    opens[borders] |= inside[borders]
    closes[borders - 1] |= inside[borders - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words."""
    return runs(~IS_SPACE[data], offsets)


def text_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text, how many of the sorted positions lie before it; one entry more at the end."""
    return np.searchsorted(starts, offsets, "left")


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return data + IS_CAPITAL[data]


def folded(data: np.ndarray) -> np.ndarray:
    """Lower case of UTF-8 bytes for ASCII and the accented letters of Latin-1; lengths stay."""
    out = lowered(data)
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    capital = second & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    out[capital] += 0x20
    return out
