"""The registered queries on a small folder of tables, against brute force; the pipeline from end to end."""

import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from test_dedup import components_by_hand, removed_bytes, removed_words
from test_texts import base_by_hand, toxic_corpus, words
from test_tokens import ids_by_library

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from arenalake.llm.queries import ORACLES, QUERIES  # noqa: E402

PLAIN = ["ba", "co", "du", "fi", "go", "ha", "ki", "lu", "me", "no"]
TOKEN = "0123456789abcdef0123456789abcdef"


def rows():
    """Documents with every planted case, and what is wrong with each."""
    docs = [(k, text, "toxic" if k % 4 == 0 else "") for k, text in toxic_corpus()]
    item = words("item", 30, PLAIN)
    at = len(docs)
    for k in range(6):
        docs.append((at, words(f"leak{k}", 40, PLAIN) + " " + item + " " + words(f"rest{k}", 20, PLAIN), "leak"))
        at += 1
    for k in range(4):
        text = words(f"copied{k}", 120, PLAIN)
        near = text.split()
        near[60] = "other"
        docs += [(at, text, ""), (at + 1, text, "copy"), (at + 2, " ".join(near), "copy")]
        at += 3
    docs += [(at, f"{words('s', 30, PLAIN)} token = {TOKEN} end", "secret"), (at + 1, None, ""), (at + 2, "", "")]
    return docs, item


@pytest.fixture(scope="session")
def folder(session, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs, item = rows()
    random.Random(1).shuffle(docs)
    full = [(i, t, ["en", "de"][i % 2], "s", None if t is None else len(t)) for i, t, _ in docs]
    session.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(
        4
    ).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(kind == "toxic")) for i, _, kind in docs if kind in ("", "toxic")]
    session.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(0, item), (1, words("unused", 30, PLAIN))]
    session.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def texts():
    return sorted((i, t or "") for i, t, _ in rows()[0])


def sha(content):
    return hashlib.sha256(content).hexdigest()


def result(session, folder, name):
    return QUERIES[name](session, folder).collect()


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "packing",
    ]


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"op11_conversation_trie"}))
def test_equals_sql(session, folder, name):
    connection = duckdb.connect()
    for table in ("documents", "labels", "benchmark"):
        connection.sql(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    wanted = connection.sql(ORACLES[name])
    got = QUERIES[name](session, folder).select(*wanted.columns).collect()
    assert sorted(map(tuple, got)) == sorted(wanted.fetchall())


def test_contaminated_documents(session, folder):
    leaks = {i for i, _, kind in rows()[0] if kind == "leak"}
    found = result(session, folder, "op1_decontaminate")
    assert {(r.doc_id, r.item_id) for r in found} == {(i, 0) for i in leaks}


def test_secrets(session, folder):
    found = {r.doc_id: r for r in result(session, folder, "op2_secrets")}
    for i, t in texts():
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base_by_hand(t))
        assert found[i].base_sha256 == sha(listed.encode())
        assert found[i].n_assign == listed.count("assign") and found[i].n_hex == listed.count("hex")
        assert found[i].n_random == 0 and found[i].spans == listed


def test_fingerprints(session, folder):
    found = {r.doc_id: r for r in result(session, folder, "op3_fingerprints")}
    plain = texts()
    for (i, t), (_, following) in zip(plain, plain[1:] + plain[:1], strict=True):
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        assert (found[i].n_chars, found[i].edited_sha256) == (len(t), sha(edited.encode()))


def test_components(session, folder):
    found = sorted(map(tuple, result(session, folder, "op4_jaccard_join")))
    assert found == components_by_hand(texts())


def test_packing(session, folder):
    pieces = result(session, folder, "op5_packing")
    for p in pieces:
        ids = ids_by_library("byte_bpe_50k.json", dict(texts())[p.doc_id])
        assert p.doc_tokens == len(ids)
        assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    order = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    ends = np.cumsum([p.length for p in order])
    assert [p.sequence_id * 2048 + p.offset for p in order] == [0, *ends[:-1].tolist()]


def test_languages(session, folder):
    found = result(session, folder, "op6_language")
    assert {r.doc_id: r.held_out for r in found} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _ in texts()}
    assert {r.doc_id for r in found if r.lang_pred == "und"} == {i for i, t in texts() if not t}


def test_toxicity(session, folder):
    found = {r.doc_id: r for r in result(session, folder, "op7_toxicity")}
    assert {i: r.held_out for i, r in found.items()} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in texts()}
    assert {i for i, r in found.items() if r.predicted} == {i for i, _, kind in rows()[0] if kind == "toxic"}


def test_repeated_strings(session, folder):
    found = sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in result(session, folder, "op8_suffix_dedup"))
    assert found == [(i, n, gone, sha(kept)) for i, n, gone, kept in removed_bytes(texts())]


def test_repeated_passages(session, folder):
    found = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in result(session, folder, "op9_substring_dedup"))
    assert found == [(i, n, gone, sha(kept)) for i, n, gone, kept in removed_words(texts())]


def test_token_files(session, folder):
    at = 0
    for r, (i, t) in zip(sorted(result(session, folder, "op10_token_files")), texts(), strict=True):
        ids = ids_by_library("word_bpe_49k.json", t)
        assert tuple(r) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_pipeline_by_brute_force(session, folder):
    """What is left are clean documents, one of each group, without secrets."""
    kept = {i: t or "" for i, t, kind in rows()[0] if kind in ("", "secret")}
    kept = {i: t.replace(f"token = {TOKEN}", "[SECRET]") for i, t in kept.items()}
    found = corpus_pipeline.run(session, folder).collect()
    assert {p.doc_id for p in found} == set(kept)
    for p in found:
        ids = ids_by_library("byte_bpe_50k.json", kept[p.doc_id])
        assert p.doc_tokens == len(ids)
        assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())


def test_stages_keep_columns_and_take_empty_tables(session, folder, with_clashing_columns):
    docs = with_clashing_columns(session.read.parquet(f"{folder}/documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(session, docs, folder)
        assert out.columns == docs.columns and out.collect() == []
    assert corpus_pipeline.STAGES[-1][1](session, docs, folder).collect() == []


def test_stages_keep_odd_rows(session, folder, documents, with_clashing_columns):
    docs = with_clashing_columns(documents([(None, "a b c"), (None, None), (5, ""), (5, "same same"), (5, "same same")]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        # Of two equal rows one stays.
        assert stage(session, docs, folder).count() == (4 if name == "ngram_jaccard_join" else 5)


def test_near_copies_are_decided_by_row(session, folder, documents):
    """Rows without an id or with one id: one of each component stays, and no text without a copy is lost."""
    base, other, third = (words(f"row{k}", 60, PLAIN) for k in range(3))
    near = base.replace(base.split()[30], "changed", 1)
    docs = documents([(7, base), (7, other), (8, near), (None, near), (None, third), (None, third), (None, words("own", 40, PLAIN))])
    kept = corpus_pipeline.without_near_copies(session, docs, folder).collect()
    wanted = [("7", base), ("7", other), ("None", third), ("None", words("own", 40, PLAIN))]
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted(wanted)


def test_contaminated_rows_without_an_id_go(session, folder, documents):
    item = words("item", 30, PLAIN)
    docs = documents([(None, f"{item} more"), (3, f"less {item}"), (3, "clean"), (None, "clean too"), (None, None)])
    kept = corpus_pipeline.without_benchmark(session, docs, folder).collect()
    assert sorted(str(r.text) for r in kept) == ["None", "clean", "clean too"]
