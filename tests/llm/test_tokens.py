"""Tokens, packing, token files: round trips against the tokenizers library."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from arenalake.llm.packing import pack, sequences
from arenalake.llm.queries import tokenizer_path
from arenalake.llm.store import shared_folder
from arenalake.llm.token_files import read_token_files, write_token_files
from arenalake.llm.tokens import PieceTokenizer

TEXTS = [
    "Hello  world,\n\n it's  3.14\t\ttabs ", "", None, " ", "\n", "naïve café über nbsp  x", "a\x1cb c", "日本語 テキスト　全角",
    "<|endoftext|> plain <|startoftext|>", "emoji 👍🏽 ok", "é combining", "word" * 3000, "x y " * 1500, "don't DON'T we'll",
    " em space", "a​b c", "tab\tend\t", "  two leading", "ß İstanbul Σας", "a\r\nb\r\n\r\n c",
]


def ids_by_library(name, text):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path(name))
    plain.encode_special_tokens = True
    return np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


@pytest.mark.parametrize("name, cut", [("byte_bpe_50k.json", "pieces"), ("word_bpe_49k.json", "words")])
def test_pieces_give_the_library_s_ids(name, cut):
    coder = PieceTokenizer(tokenizer_path(name))
    assert coder.cut == cut
    for _ in range(2):  # the second time from what is kept
        raw = [(t or "").encode() for t in TEXTS]
        data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
        ids, begins = coder.encode(data, offsets)
        for k, t in enumerate(TEXTS):
            assert ids[begins[k] : begins[k + 1]].tolist() == ids_by_library(name, t)[:-1].tolist(), t


ODD = [*"aeJHTY 's.,-|<>19\n\t", "'t", "'ll", "'", "''", "<|", "J\u030c", "\u0308", "\u0331", "é", "É", "×", "÷", "ª", "ß", "İ", "Σ", "ﬁ"]
ODD += ["日本", "\u0345", "\u1100\u1161", "\u212a", "²", "½", "\u00a0", "\u200b", "👍", "word", "Word", "<|endoftext|>"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_of_odd_neighbours_give_the_library_s_ids(name):
    """Kinds of characters, capitals and marks next to each other in any order."""
    coder, random = PieceTokenizer(tokenizer_path(name)), np.random.default_rng(7)
    texts = ["".join(ODD[k] for k in random.integers(0, len(ODD), random.integers(0, 12))) for _ in range(4000)]
    texts += [a + b for a in ODD for b in ODD]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    ids, begins = coder.encode(data, offsets)
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path(name))
    plain.encode_special_tokens = True
    for k, want in enumerate(plain.encode_batch_fast(texts, add_special_tokens=False)):
        assert ids[begins[k] : begins[k + 1]].tolist() == want.ids, texts[k]


def test_words_share_what_is_kept():
    """A word is encoded once, whatever stands after it and in either case."""
    coder, raw = PieceTokenizer(tokenizer_path("word_bpe_49k.json")), b"word. Word word,\nWORD"
    ids, _ = coder.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert ids.tolist() == ids_by_library("word_bpe_49k.json", raw.decode())[:-1].tolist()
    assert len(coder.keys) == 3


def test_pieces_tile_documents_and_sequences(documents):
    pieces = pack(documents(TEXTS), tokenizer_path("byte_bpe_50k.json"), length=64).collect()
    whole = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        have = whole.setdefault(p.doc_id, [])
        assert p.start == len(have) and p.offset + p.length <= 64
        have += np.frombuffer(p.ids, "<u4").tolist()
        assert p.length == len(p.ids) // 4
    for k, t in enumerate(TEXTS):
        assert whole[k] == ids_by_library("byte_bpe_50k.json", t).tolist()
    at = 0
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.sequence_id * 64 + p.offset == at
        at += p.length
    assert {p.doc_id: p.doc_tokens for p in pieces} == {k: len(v) for k, v in whole.items()}


def test_sequences_are_padded_unless_a_power_of_two(documents):
    docs = documents(["a b c d e f"])  # six ids and the end
    path = tokenizer_path("byte_bpe_50k.json")
    assert [(r.n, len(r.ids) // 4) for r in sequences(pack(docs, path, 16), 16).collect()] == [(7, 16)]
    assert [(r.n, len(r.ids) // 4) for r in sequences(pack(docs, path, 4), 4).orderBy("n").collect()] == [(3, 4), (4, 4)]
    assert [(r.n, len(r.ids) // 4) for r in sequences(pack(documents(["a b c"]), path, 16), 16).collect()] == [(4, 4)]


def test_packing_of_odd_rows(documents, with_clashing_columns):
    path = tokenizer_path("byte_bpe_50k.json")
    assert pack(documents([(1, "a")]).limit(0), path).collect() == []
    rows = pack(with_clashing_columns(documents([(None, "a"), (7, "b"), (7, "b")])), path).collect()
    assert sorted((r.doc_id or 0, r.length, r.doc_tokens) for r in rows) == [(0, 2, 2), (7, 2, 2), (7, 2, 2)]


def test_files_read_back_in_order(session, documents):
    texts = [*TEXTS, *(f"document {k} of many " * (k % 7 + 1) for k in range(300))]
    folder = shared_folder(session)
    write_token_files(documents(list(enumerate(texts))), folder, tokenizer_path("word_bpe_49k.json"), block_bytes=600)
    rows = read_token_files(session, folder).orderBy("doc_id").collect()
    at = 0
    for k, (row, t) in enumerate(zip(rows, texts, strict=True)):
        ids = ids_by_library("word_bpe_49k.json", t)
        assert (row.doc_id, row.start, row.n_tokens) == (k, at, len(ids))
        assert zlib.crc32(row.ids) == zlib.crc32(ids.tobytes())
        at += len(ids)
    blocks = session.read.parquet(f"{folder}/blocks")
    assert blocks.count() > 5
    dictionary = session.read.parquet(f"{folder}/dictionary").first()
    assert len(dictionary.content) > 0
    assert blocks.select("dictionary_hash").distinct().collect() == [(dictionary.dictionary_hash,)]
    some = read_token_files(session, folder, [3, 250]).orderBy("doc_id").collect()
    assert some == [rows[3], rows[250]]


def test_a_changed_dictionary_is_an_error(session, documents):
    folder = shared_folder(session)
    write_token_files(documents(["a", "b"]), folder, tokenizer_path("word_bpe_49k.json"))
    other = session.read.parquet(f"{folder}/dictionary").withColumn("content", F.lit(bytearray(b"x")))
    other.write.parquet(f"{folder}/other")
    other = session.read.parquet(f"{folder}/other")
    other.write.mode("overwrite").parquet(f"{folder}/dictionary")
    with pytest.raises(ValueError, match="hash"):
        read_token_files(session, folder)


def test_files_of_odd_rows(session, documents, with_clashing_columns):
    path = tokenizer_path("word_bpe_49k.json")
    folder = shared_folder(session)
    write_token_files(documents([(1, "a")]).limit(0), folder, path)
    assert read_token_files(session, folder).collect() == []
    folder = shared_folder(session)
    write_token_files(with_clashing_columns(documents([(7, "b"), (None, "a"), (7, "a b c")])), folder, path)
    rows = sorted(read_token_files(session, folder).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens) for r in rows] == [(None, 0, 2), (7, 2, 4), (7, 6, 2)]
    assert [r.n_tokens for r in read_token_files(session, folder, [None]).collect()] == [2]
