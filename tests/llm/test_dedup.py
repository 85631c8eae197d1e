"""Removal of repeats and the similarity join, against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arenalake.llm import repeated_keys
from arenalake.llm.components import components
from arenalake.llm.jaccard_join import needed, prefix, similar
from arenalake.llm.substring_dedup import remove_repeated_passages
from arenalake.llm.suffix_dedup import longest_previous_factors, remove_repeated_strings
from arenalake.llm.windows import sliding_minimum, super_kmers, united


def text(seed, n, vocabulary=400):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


def corpus():
    passage, other = text("p", 70), text("q", 55)
    base = text("base", 200)
    near = [base.replace(base.split()[k], f"new{k}") for k in (3, 90, 150)]
    docs = [text(k, 120) for k in range(12)]
    docs += [text("a", 40) + " " + passage + " " + text("b", 30), passage, text("c", 10) + " " + passage + "\n" + other]
    docs += [base, base, *near, base + "  ", other + " " + other]
    docs += ["", None, "one two", "one  two", "ONE two", "x" * 3000, "ab" * 400, "é" * 300, "same line\n" * 60]
    docs += [text("long", 6000), text("long", 6000)[:20000]]
    return docs


def removed_words(rows, width=50):
    first = {}
    words = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        for j in range(len(w) - width + 1):
            k = tuple(w[j : j + width])
            first[k] = min(first.get(k, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if first[tuple(w[j : j + width])] < i:
                gone[j : j + width] = [True] * width
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out)


def removed_bytes(rows, width=100):
    seen, out = set(), []
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - width + 1):
            k = b[j : j + width]
            if k in seen:
                gone[j : j + width] = b"\1" * width
            seen.add(k)
        out.append((i, len(b), sum(gone), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def rows_of(frame):
    found = [(r.doc_id, r.n, sum(s.end - s.start for s in r.spans), bytes(r.kept)) for r in frame.collect()]
    return sorted(found, key=lambda x: (x[0] is None, x))


def components_by_hand(rows, threshold=80):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {b" ".join(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    return sorted((i, len(s), label[i]) for i, s in sets.items())


def test_passages_as_by_brute_force(documents):
    rows = list(enumerate(corpus()))
    assert rows_of(remove_repeated_passages(documents(rows))) == removed_words(rows)


def test_strings_as_by_brute_force(documents):
    rows = list(enumerate(corpus()))
    assert rows_of(remove_repeated_strings(documents(rows))) == removed_bytes(rows)


@pytest.mark.parametrize("kinds", [0, 1, 2])
def test_repeats_of_hot_grams_as_by_brute_force(documents, monkeypatch, kinds):
    monkeypatch.setattr("arenalake.llm.window_repeats.HOT_KINDS", kinds)
    rows = list(enumerate(corpus()))
    assert rows_of(remove_repeated_passages(documents(rows))) == removed_words(rows)
    assert rows_of(remove_repeated_strings(documents(rows))) == removed_bytes(rows)


def test_components_as_by_brute_force(documents):
    rows = list(enumerate(corpus()))
    found = similar(documents(rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == components_by_hand(rows)


@pytest.mark.parametrize("operator", [remove_repeated_passages, remove_repeated_strings])
def test_empty_table_and_clashing_columns(documents, with_clashing_columns, operator):
    assert operator(documents([(1, "a")]).limit(0)).collect() == []
    docs = with_clashing_columns(documents([text("z", 80), text("z", 80)]))
    assert [len(r.spans) for r in sorted(operator(docs).collect())] == [0, 1]


def test_repeated_and_null_ids(documents):
    same = text("same", 80)
    rows = [(5, same), (5, same), (None, same), (9, same)]
    words = {(r.doc_id, bool(r.spans)) for r in remove_repeated_passages(documents(rows)).collect()}
    assert words == {(None, False), (5, True), (9, True)}
    only = remove_repeated_passages(documents([(5, same), (5, same)])).collect()
    assert [r.spans for r in only] == [[], []]
    found = similar(documents(rows)).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in found) == [(-1, 5), (5, 5), (5, 5), (9, 5)]


def test_join_of_empty_table_and_clashing_columns(documents, with_clashing_columns):
    assert similar(documents([(1, "a")]).limit(0)).collect() == []
    found = similar(with_clashing_columns(documents(["a b c d e f", "a b c d e f", "", None]))).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(0, 0), (1, 0), (2, 2), (3, 3)]


def test_many_near_copies_meet_in_one_component(documents):
    base = text("family", 300, 5000).split()
    docs = [" ".join(base[:k] + [f"own{k}"] + base[k + 1 :]) for k in range(0, 240, 2)]
    passage = text("shared", 60)
    docs += [text(f"single{k}", 30, 5000) + " " + passage for k in range(40)]
    rows = list(enumerate(docs))
    found = similar(documents(rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == components_by_hand(rows)


def test_similarity_at_the_threshold(documents):
    # 9 shingles each, 8 in common: 8 / 10 is enough; 7 in common are not.
    words = [f"w{k}" for k in range(13)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:12], "x"])), (3, " ".join(["y", "z", *words[2:]]))]
    assert [(r.doc_id, r.component_id) for r in sorted(similar(documents(rows)).collect())] == [(1, 1), (2, 1), (3, 3)]


def test_prefix_grows_with_cost_and_asks_for_more():
    n = 100
    rare = np.concatenate([np.full(21, 2), np.full(79, 1000)])
    assert prefix(rare, n, 80) == (1, 21)  # the next shingle is dear
    even = np.full(n, 50)
    level, length = prefix(even, n, 80)
    assert level > 1 and length == 21 + level - 1
    assert needed(9, 80) == 8


def test_longest_previous_factors_by_hand():
    data = b"abracadabra-abracadabra"
    array = np.frombuffer(data, np.uint8)
    found = longest_previous_factors(array, np.arange(len(data)), 11)
    for i, n in enumerate(found.tolist()):
        assert n == min(11, max(k for j in range(max(i, 1)) for k in range(12) if data[j : j + k] == data[i : i + k] and j < i or not k))


def test_super_kmers_cover_every_window_once():
    codes = np.random.default_rng(1).integers(1, 1 << 60, 500).astype(np.uint64)
    bounds = np.array([0, 3, 200, 200, 500])
    starts, counts, _, _ = super_kmers(codes, bounds, 20, 5)
    windows = sorted(s + k for s, c in zip(starts.tolist(), counts.tolist(), strict=True) for k in range(c))
    assert windows == [*range(3, 181), *range(200, 481)]
    assert sliding_minimum(np.array([3, 1, 2, 5, 4]), 3).tolist() == [1, 1, 2]
    assert [x.tolist() for x in united(np.array([5, 0, 2]), np.array([6, 2, 3]))] == [[0, 5], [3, 6]]


def test_components_of_a_long_chain(session):
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 102), (102, 100)]
    found = {r.node: r.component for r in components(session.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(61)} | {100: 100, 101: 100, 102: 100}
    assert components(session.createDataFrame([], "a long, b long")).collect() == []


def test_digest_is_of_what_stays(documents):
    kept = remove_repeated_strings(documents(["abc"]), kept=lambda b: hashlib.sha256(b).hexdigest(), kept_type="string")
    assert kept.first().kept == hashlib.sha256(b"abc").hexdigest()


def test_groups_follow_bytes_and_part_equal_rows(session, documents, monkeypatch):
    long = session.range(40).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some text "), 100_000).alias("text"))
    assert repeated_keys.grouped(long, repeated_keys.extent(long)).select("src").distinct().count() > 1
    monkeypatch.setattr(repeated_keys, "GROUP_DOCUMENTS", 4)
    equal = documents([*((None, "the same text"),) * 60, (1, "own"), (1, "own"), (2, None)])
    rows = repeated_keys.grouped(equal, repeated_keys.extent(equal))
    assert rows.where(F.col("doc") == repeated_keys.NO_ID).select("src").distinct().count() > 5
    listed = [("own", 1), ("own", 1), ("", 2), *[("the same text", repeated_keys.NO_ID)] * 60]
    assert sorted((r.text, r.doc) for r in rows.collect()) == sorted(listed)


def test_results_do_not_depend_on_the_groups(session, documents, monkeypatch):
    same = " ".join(f"w{k}" for k in range(120))
    docs = documents([*((None, same),) * 6, (1, same), (2, same), (2, same), (3, "x " + same), (4, "short"), (5, None)])

    def results():
        found = similar(docs).select("doc_id", "n_shingles", "component_id")
        kept = [x(docs).drop("spans") for x in (remove_repeated_strings, remove_repeated_passages)]
        return [sorted(map(repr, x.collect())) for x in (found, *kept)]

    one = results()
    monkeypatch.setattr(repeated_keys, "DOCUMENT_BYTES", 1)
    assert repeated_keys.extent(docs).groups > 5
    assert results() == one
