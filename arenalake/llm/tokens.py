"""Token ids of whole texts by the tokenizers library, at the cost of its distinct pieces.

A text is cut where the tokenizer's own first step cuts it in any case: before a
run of blanks that follows other text. A piece then has the same ids wherever it
stands. Distinct pieces are encoded once and kept by their hash while the Python
worker lives; texts with unusual white space are encoded whole.

Where the first step is the pattern ``CLASSES``, a match holds characters of one kind,
letters, a digit or others, or is an apostrophe with letters after it. Pieces are
then also cut where an ASCII character is of another known kind than the one
before it, unless that is an apostrophe, and end before their last blanks, which the
pattern leaves out: "word." and "word" share what is kept.
No ASCII character composes with one before it, so normalizing parts is the same
as parting the normalized text. If the tokenizer ends in lower case, pieces that differ
in A-Z only are one; a capital before a character beyond ASCII is left as it is,
since both could compose.
"""

import json
import os
import re

import numpy as np
import pyarrow as pa

from arenalake.llm.words import BYTE_CODES, lowered, release_memory, span_hashes, text_slices

PLAIN_BLANK = np.zeros(256, bool)
PLAIN_BLANK[list(b" \t\n\r")] = True
#: First bytes of white space, in UTF-8, that the libraries may class differently.
RARE_BYTE = np.zeros(256, bool)
RARE_BYTE[[0x0B, 0x0C, *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
RARE_CODES = [0x0B, 0x0C, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010)]
RARE_CODES += [0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]
RARE_BLANK = re.compile("[" + "".join(map(chr, RARE_CODES)) + "]")
#: What parts a text into words in tokenizers of this family.
CLASSES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Kinds of ASCII characters: 1 letters, 2 digits, 3 others; 0 blanks and all bytes beyond.
KIND = np.zeros(256, np.uint8)
KIND[0x21:0x7F] = 3
KIND[0x30:0x3A] = 2
KIND[0x41:0x5B] = KIND[0x61:0x7B] = 1
#: Second bytes, after 0xC3, of the letters of Latin-1.
LATIN_LETTER = np.zeros(256, np.uint8)
LATIN_LETTER[0x80:0xC0] = 1
LATIN_LETTER[[0x97, 0xB7]] = 0
APOSTROPHE = ord("'")
KEPT_IDS = 5_000_000
SPECIAL = "<|"


class PieceTokenizer:
    """``encode`` a batch of texts; keeps at most ``KEPT_IDS`` ids of pieces seen before."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.marked = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.cut, self.by_kind, self.lower = self._cut_of(config), *self._kinds_of(config)
        self.mark = "<|endoftext|>"
        self.mark_id = self.marked.token_to_id(self.mark)
        self.size = self.plain.get_vocab_size()
        self._forget()

    @staticmethod
    def _cut_of(config: dict) -> str:
        """How texts may be cut: into "pieces" with the blanks before them, into "words", or not."""
        first = config.get("pre_tokenizer") or {}
        if config.get("normalizer") is None and first.get("type") == "ByteLevel" and first.get("use_regex"):
            return "" if first.get("add_prefix_space") else "pieces"
        steps = first.get("pretokenizers") or [{}]
        drops = steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
        pattern = (steps[0].get("pattern") or {}).get("Regex", "")
        return "words" if drops and "[^\\s" in pattern and "\\s" not in pattern.replace("[^\\s", "") else ""

    @staticmethod
    def _kinds_of(config: dict) -> tuple[bool, bool]:
        """Whether pieces may be cut between kinds of characters, and whether A-Z are the same as a-z."""
        first, normal = config.get("pre_tokenizer") or {}, config.get("normalizer") or {}
        steps = first.get("pretokenizers") or [{}]
        normals = normal.get("normalizers") or ([normal] if normal else [])
        blanks = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
        others = [x for x in normals if x not in ({"type": "NFC"}, {"type": "Lowercase"}, blanks)]
        by_kind = not others and (steps[0].get("pattern") or {}).get("Regex") == CLASSES
        return by_kind, by_kind and normals[-1:] == [{"type": "Lowercase"}]

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encoded(self, pieces: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(pieces)
        usual = [k for k, p in enumerate(pieces) if SPECIAL not in p] if self.mark_id is not None else []
        for at in range(0, len(usual), 100):
            block = usual[at : at + 100]
            ids = self.marked.encode_batch_fast([self.mark.join(pieces[k] for k in block)], add_special_tokens=False)
            ids = np.array(ids[0].ids, np.uint32)
            cuts = np.flatnonzero(ids == self.mark_id)
            lows, highs = np.append(0, cuts + 1), np.append(cuts, len(ids))
            for k, low, high in zip(block, lows.tolist(), highs.tolist(), strict=True):
                out[k] = ids[low:high]
        rest = [k for k in range(len(pieces)) if out[k] is None]
        found = self.plain.encode_batch_fast([pieces[k] for k in rest], add_special_tokens=False) if rest else []
        for k, ids in zip(rest, found, strict=True):
            out[k] = np.array(ids.ids, np.uint32)
        return out

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        new = self._encoded(pieces)
        lengths = np.array([len(x) for x in new], np.int64)
        slots = np.arange(len(self.starts) - 1, len(self.starts) - 1 + len(new))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, *new])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, at, keys), np.insert(self.slots, at, slots)

    def _spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text_starts = offsets[:-1][offsets[1:] > offsets[:-1]]
        if not self.cut:
            return text_starts, offsets[1:][offsets[1:] > offsets[:-1]]
        blank = PLAIN_BLANK[data]
        opens = np.zeros(len(data), bool)
        opens[1:] = blank[1:] & ~blank[:-1] if self.cut == "pieces" else ~blank[1:] & blank[:-1]
        if self.by_kind:
            kind = KIND[data]
            kind[1:] |= LATIN_LETTER[data[1:]] * (data[:-1] == 0xC3)
            opens[1:] |= (kind[1:] != kind[:-1]) & (KIND[data[1:]] > 0) & (kind[:-1] > 0) & (data[:-1] != APOSTROPHE)
        opens[text_starts] = True
        if RARE_BYTE[data].any():
            raw = data.tobytes()
            rare = np.unique(np.searchsorted(offsets, np.flatnonzero(RARE_BYTE[data]), "right") - 1)
            for k in rare.tolist():
                low, high = int(offsets[k]), int(offsets[k + 1])
                if RARE_BLANK.search(raw[low:high].decode()):
                    opens[low + 1 : high] = False
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(data))
        if self.by_kind and blank.any():
            closes = np.flatnonzero(blank & np.append(True, ~blank[:-1]))
            ends = np.where(blank[ends - 1], closes[np.searchsorted(closes, ends) - 1], ends)
            ends = np.maximum(starts, ends)
        return starts, ends

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in the order of the texts, and for each text where its ids begin (one entry more)."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts, ends = self._spans(data, offsets)
        same = data
        if self.lower:
            same = lowered(data)
            same[:-1] = np.where(data[1:] < 0x80, same[:-1], data[:-1])
        keys, first, inverse = np.unique(
            span_hashes(BYTE_CODES[same], starts, ends), return_index=True, return_inverse=True
        )
        if len(self.ids) > KEPT_IDS:
            self._forget()
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        new = self.keys[at] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            raw = data.tobytes()
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            self._learn(keys[new], [raw[low:high].decode() for low, high in spans])
            at = np.searchsorted(self.keys, keys)
        slot = self.slots[at][inverse]
        lengths = self.starts[slot + 1] - self.starts[slot]
        after = np.cumsum(lengths)
        ids = self.ids[np.repeat(self.starts[slot] - (after - lengths), lengths) + np.arange(after[-1])]
        return ids, np.append(0, after)[np.searchsorted(starts, offsets, "left")]


_tokenizers: dict[str, PieceTokenizer] = {}


def tokenizer(path: str) -> PieceTokenizer:
    """The worker's tokenizer for this file."""
    if path not in _tokenizers:
        release_memory()
        _tokenizers[path] = PieceTokenizer(path)
    return _tokenizers[path]


def documents_ids(texts: pa.Array, path: str, end_id: int | None):
    """(row, ids) of every text, as 32-bit arrays, each with ``end_id`` after it."""
    coder = tokenizer(path)
    for first, last, data, offsets in text_slices(texts):
        ids, begins = coder.encode(data, offsets)
        if end_id is not None:
            ids = np.insert(ids, begins[1:], np.uint32(end_id))
            begins = begins + np.arange(len(begins))
        for row in range(first, last):
            yield row, ids[begins[row - first] : begins[row - first + 1]]
