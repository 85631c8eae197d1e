"""Conversation trie, filter audit and quality rules: brute force, odd tables, held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction
from itertools import permutations
from math import factorial

import duckdb
import pytest
from pyspark.sql import functions as F

from arenalake.llm import conversation_trie, quality_rules
from arenalake.llm.conversation_trie import NODE_DDL, prefix_trie, turn_paths, with_openings
from arenalake.llm.filter_audit import audit, shapley_map
from arenalake.llm.queries import ORACLES, QUERIES

NODE_NAMES = [x.split()[0] for x in NODE_DDL.split(", ")]
TURN = "conv_id long, turn long, role string, text string"


def trie_by_hand(paths):
    """Rows of all nodes; ``paths``: id -> list of (role, text)."""
    members = defaultdict(list)
    for conv, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    out = []
    for node, own in members.items():
        below = [x for x in members if x[: len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(str(c) for c in sorted(own) if len(paths[c]) == len(node))
        above = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(own), len(node), above, len(own), len(kids), len(leaves), saved, digest))
    return sorted(out)


def conversations(seed=1, n=240):
    pick = random.Random(seed)
    rows = []
    for conv in range(n):
        # A third of all are copies of one conversation, and many begin alike.
        turns = ["hello", "same", "thing", "ü" * 9] if conv % 3 == 0 else [pick.choice("abc") for _ in range(pick.randrange(7))]
        rows += [(conv, k, ["user", "assistant"][k % 2], t) for k, t in enumerate(turns)]
    return rows


def by_hand(rows):
    paths = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda x: (x[0], x[1] is not None, x[1] or 0, len(x[3] or ""))):
        paths[conv].append((role or "", text or ""))
    return paths


@pytest.mark.parametrize("shard_turns", [1, 7, 40, 100_000])
def test_trie_by_brute_force_for_any_splitters(session, shard_turns, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK_IDS", 7)
    rows = conversations()
    table = session.createDataFrame(rows, TURN).repartition(5)
    found = prefix_trie(turn_paths(table), shard_turns).select(NODE_NAMES).collect()
    assert sorted(map(tuple, found)) == trie_by_hand(by_hand(rows))


def test_bounded_skeleton_gives_the_same_nodes(session, monkeypatch):
    monkeypatch.setattr(conversation_trie, "SKELETON_NODES", 5)
    rows = conversations(2)
    table = session.createDataFrame(rows, TURN)
    found = prefix_trie(turn_paths(table), 3).select(NODE_NAMES).collect()
    assert sorted(map(tuple, found)) == trie_by_hand(by_hand(rows))


def test_openings_come_from_the_first_of_a_hundred(session):
    lone = next(c for c in range(401, 499) if zlib.crc32(str(c).encode()) % 6)
    rows = conversations(3, 150) + [(lone, 0, "user", "no opening"), (-5, 0, "user", "below zero"), (500, None, None, None)]
    table = session.createDataFrame(rows, TURN)
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(6))
    found = prefix_trie(with_openings(turn_paths(table), 100, 5, taken), 5).select(NODE_NAMES).collect()
    own = by_hand(rows)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = 0 if c == -5 else c - c % 100
        rebuilt[c] = own.get(first, [])[:h] + turns[h:]
    assert sorted(map(tuple, found)) == trie_by_hand(rebuilt)
    assert any(not turns for turns in rebuilt.values())


def test_odd_turns(session, with_clashing_columns):
    rows = [(7, None, None, "first"), (7, 1, "user", None), (7, 1, "user", "longer"), (7, 1, "user", "longer"), (None, 0, "user", "x")]
    table = with_clashing_columns(session.createDataFrame(rows, TURN))
    found = prefix_trie(turn_paths(table)).select(NODE_NAMES).collect()
    assert sorted(map(tuple, found)) == trie_by_hand({7: [("", "first"), ("user", ""), ("user", "longer"), ("user", "longer")]})
    assert prefix_trie(turn_paths(table.limit(0))).collect() == []


def test_a_long_conversation_and_its_copy(session):
    rows = [(c, k, "user", f"t{k}" * (50_000 if k == 3 else 1)) for c in (1, 2) for k in range(3000)] + [(2, 3000, "user", "more")]
    found = prefix_trie(turn_paths(session.createDataFrame(rows, TURN)), 500).collect()
    depths = sorted((r.depth, r.n_convs) for r in found)
    assert depths == [(d, 2) for d in range(3001)] + [(3001, 1)]
    root = next(r for r in found if r.depth == 0)
    assert root.saved_tokens == sum(len(f"t{k}") * (50_000 if k == 3 else 1) for k in range(3000)) and root.n_leaves == 1


def failing(rows):
    """For each row whether it fails A to E; ``rows``: (id, lang, text)."""
    first = {}
    for i, _, t in rows:
        key = -(1 << 63) if i is None else i
        first[t or ""] = min(first.get(t or "", key), key)
    out = []
    for i, _, text in rows:
        t = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
        out.append((
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), any(c in "#$%&*|" for c in t),
            (-(1 << 63) if i is None else i) > first[t],
        ))
    return out


def audit_by_hand(rows, labels):
    fails, out = failing(rows), {}
    for part in {lang or "" for _, lang, _ in rows}:
        own = [(i, f) for (i, lang, _), f in zip(rows, fails, strict=True) if (lang or "") == part]
        shares = [0] * 5
        for order in permutations(range(5)):
            gone = set()
            for step, f in enumerate(order, 1):
                failed = {k for k, (_, x) in enumerate(own) if x[f]}
                new = failed - gone
                shares[f] += len(new)
                lost = [sum(own[k][0] is not None and (own[k][0], j) in labels for k in new) for j in (0, 1)]
                unique = sum(x[f] and sum(x) == 1 for _, x in own)
                gone |= new
                name = "".join("ABCDE"[k] for k in order)
                out[part, name, step] = [len(own) - len(gone), len(new), len(failed) - len(new), unique, *lost, f]
        for key in out:
            if key[0] == part:
                out[key][-1] = shares[out[key][-1]]
    return sorted((*k, *v) for k, v in out.items())


AUDITED = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited_rows():
    pick = random.Random(5)
    rows = [(k, pick.choice(["en", "de", None, ""]), " ".join(f"w{pick.randrange(400)}" for _ in range(pick.choice([5, 150, 260])))) for k in range(40)]
    rows += [(40 + k, pick.choice(["en", "fr"]), rows[k % 7][2]) for k in range(25)]
    rows += [(70, "en", "A B C # " * 90), (71, "de", "a " * 300), (72, None, None), (73, "en", ""), (74, "en", None)]
    rows += [(None, "en", rows[3][2]), (None, "en", rows[3][2]), (3, "en", rows[3][2]), (75, "en", "\t\n x\x0b"), (76, "fr", "long " * 40_000)]
    return rows


def test_audit_by_brute_force(session, with_clashing_columns):
    rows = audited_rows()
    docs = with_clashing_columns(session.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4))
    marks = [(k, int(k % 3 == 0), int(k % 5 == 0)) for k in range(60)] + [(1, 1, None), (None, 1, 1), (2, None, None)]
    labels = session.createDataFrame(marks, "doc_id long, quality int, toxic int")
    held = {(i, 0) for i, q, _ in marks if q == 1} | {(i, 1) for i, _, t in marks if t == 1}
    found = audit(docs, labels).select(AUDITED).collect()
    assert sorted(map(tuple, found)) == audit_by_hand(rows, held)


def test_audit_of_an_empty_table(session):
    docs = session.createDataFrame([], "doc_id long, lang string, text string")
    assert audit(docs, session.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []


def test_least_squares_give_shapley_values():
    for n in (2, 3, 5):
        rows = shapley_map(n)
        for i, row in enumerate(rows):
            for c in range(1 << n):
                s = c.bit_count()
                inside = c >> i & 1
                size = s - 1 if inside else s
                weight = Fraction(factorial(size) * factorial(n - size - 1)) * (1 if inside else -1)
                # The empty coalition removes nothing, so its factor is free.
                assert c == 0 or row[c] == weight


def quality_corpus():
    pick = random.Random(9)
    rows = []
    for k in range(260):
        words = [f"w{pick.randrange(300)}" for _ in range(60)]
        good = k % 3 > 0
        rows.append((k, " ".join(words) if good else " ".join(pick.choice([f"{w}###" for w in words]) for w in words), int(good)))
    return rows


@pytest.fixture(scope="module")
def quality_model(session):
    rows = quality_corpus()
    docs = session.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = session.createDataFrame([(i, g) for i, _, g in rows if i % 2], "doc_id long, quality int")
    return quality_rules.train(docs, labels)


def test_rules_tell_held_out_documents_apart(session, quality_model):
    rows = [x for x in quality_corpus() if x[0] % 2 == 0]
    docs = session.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    found = {r.doc_id: r.score for r in quality_rules.score(docs, quality_model).collect()}
    assert {i: found[i] >= 0.5 for i in found} == {i: bool(g) for i, _, g in rows}
    assert all(0 <= x <= 1 for x in found.values())


def test_rules_are_sparse_and_stay_in_the_jvm(session, quality_model, documents):
    assert 0 < len(quality_model.weights) < 2 * quality_rules.TREES * 7
    plan = quality_rules.score(documents(["a"]), quality_model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_training_twice_gives_the_same_model(session, quality_model):
    rows = quality_corpus()
    docs = session.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(8)
    labels = session.createDataFrame([(i, g) for i, _, g in rows if i % 2], "doc_id long, quality int").repartition(4)
    again = quality_rules.train(docs, labels)
    assert [r for r, _ in again.weights] == [r for r, _ in quality_model.weights]


def test_quality_of_odd_texts(session, quality_model, documents, with_clashing_columns):
    docs = with_clashing_columns(documents([(None, "a b c"), (None, None), (5, ""), (5, "x"), (5, "x"), (6, "long word " * 60_000)]))
    found = quality_rules.score(docs, quality_model).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert quality_rules.score(docs.limit(0), quality_model).collect() == []
    none = session.createDataFrame([(None, 1), (5, None)], "doc_id long, quality int")
    assert {r.score for r in quality_rules.score(docs, quality_rules.train(docs, none)).collect()} == {0.5}
    one = session.createDataFrame([(5, 1), (5, 0), (6, 1)], "doc_id long, quality int")
    assert min(r.score for r in quality_rules.score(docs, quality_rules.train(docs, one)).collect()) > 0.99


def test_one_text_of_each_labelled_id(session):
    docs = session.createDataFrame([(1, "a"), (1, "b c"), (1, "b c"), (2, "d")], "doc_id long, text string")
    labels = session.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    assert sorted(r.good for r in quality_rules.labelled_sample(docs, labels).collect()) == [0, 1]
    assert quality_rules.labelled_sample(docs, labels, 1).count() <= 2


@pytest.mark.parametrize("name", ["op11_conversation_trie", "op12_filter_audit"])
def test_registered_queries_equal_sql(session, name):
    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    for table in ("documents", "labels", "conversations"):
        connection.sql(f"create view {table} as select * from '{folder}/{table}.parquet'")
    wanted = connection.sql(ORACLES[name])
    got = QUERIES[name](session, folder).select(*wanted.columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted(wanted.fetchall(), key=str)


def test_registered_quality_query_on_held_out_labels(session):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in session.read.parquet(f"{folder}/labels.parquet").collect()}
    found = QUERIES["op13_quality_rules"](session, folder).collect()
    assert {r.doc_id: r.held_out for r in found} == {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in found}
    held = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
