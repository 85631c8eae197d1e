"""What must stay in proportion to the table or within a task's memory."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import GroupedData
from pyspark.sql import functions as F
from test_dedup import components_by_hand, removed_bytes, removed_words, rows_of, text

from arenalake.llm import jaccard_join, repeated_keys, window_repeats, windows
from arenalake.llm.jaccard_join import candidates, similar
from arenalake.llm.repeated_keys import with_repeated
from arenalake.llm.substring_dedup import Words, remove_repeated_passages
from arenalake.llm.suffix_dedup import Bytes, remove_repeated_strings
from arenalake.llm.window_repeats import Job
from arenalake.llm.windows import super_kmers
from arenalake.llm.words import span_hashes, word_hashes, BYTE_CODES, word_spans

BIG = 20_000_000


def word_keys():
    """The keys of a group's words, and what it learns of them; local functions, which travel to the workers whole."""

    def codes(table):
        found = [int(w[1:]) for t in table.column("text").to_pylist() for w in t.split()]
        return np.array(found, np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def sums(table, repeated):
        out = []
        for doc, t in zip(table.column("doc").to_pylist(), table.column("text").to_pylist(), strict=True):
            times = repeated.times(codes(pa.table({"text": [t]})))
            out.append({"doc": doc, "again": int((times > 1).sum()), "times": int(times.sum())})
        return pa.Table.from_pylist(out, pa.schema([("doc", pa.int64()), ("again", pa.int64()), ("times", pa.int64())]))

    return codes, sums, "doc long, again long, times long"


@pytest.mark.parametrize("bits, levels", [(5, 1), (5, 2), (2, 3), (1, 6)])
def test_keys_over_any_number_of_levels(documents, monkeypatch, bits, levels):
    pick = random.Random(levels)
    docs = [" ".join(f"w{pick.randrange(900)}" for _ in range(8)) for _ in range(60)]
    monkeypatch.setattr(repeated_keys, "GROUP_DOCUMENTS", 3)
    monkeypatch.setattr(repeated_keys, "BUCKET_DOCUMENTS", 60 if levels == 1 else 1)
    monkeypatch.setattr(repeated_keys, "RANGE_BITS", bits)
    monkeypatch.setattr(repeated_keys, "RANGES", 1 << bits)
    monkeypatch.setattr(repeated_keys, "HOLDERS", 4)
    assert repeated_keys.steps(60) == levels
    count = Counter(w for d in docs for w in d.split())
    wanted = sorted((k, sum(count[w] > 1 for w in d.split()), sum(count[w] for w in d.split())) for k, d in enumerate(docs))
    found = with_repeated(documents(docs), *word_keys()).collect()
    assert sorted(map(tuple, found)) == wanted


def test_rows_of_keys_grow_with_the_table(documents, monkeypatch):
    monkeypatch.setattr(repeated_keys, "GROUP_DOCUMENTS", 4)
    sent, apply = [], GroupedData.applyInArrow

    def spy(self, function, schema):
        sent.append(apply(self, function, schema))
        return sent[-1]

    monkeypatch.setattr(GroupedData, "applyInArrow", spy)
    counts = []
    for n in (80, 400):
        sent.clear()
        with_repeated(documents([text(k, 80, 10_000) for k in range(n)]), *word_keys())
        counts.append(sent[0].count())
    assert counts[0] >= 20 * repeated_keys.RANGES * 0.9
    assert counts[1] <= 6 * counts[0]


@pytest.mark.parametrize("size", [40, 997])
def test_blocks_hold_every_window_once(monkeypatch, size):
    monkeypatch.setattr(windows, "BLOCK", size)
    values = np.random.default_rng(1).integers(1, 1 << 60, 3000).astype(np.uint64)
    bounds = np.array([0, 3, 200, 200, 2500, 3000])
    starts, counts, _, _ = super_kmers(values, bounds, 20, 5)
    found = sorted(s + k for s, c in zip(starts.tolist(), counts.tolist(), strict=True) for k in range(c))
    assert found == [*range(3, 181), *range(200, 2481), *range(2500, 2981)]


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    data = np.frombuffer((text("w", 4000) + " \t" + text("v", 50)).encode(), np.uint8)
    starts, ends = word_spans(data, np.array([0, len(data)]))
    whole = span_hashes(BYTE_CODES[data], starts, ends)
    monkeypatch.setattr("arenalake.llm.words.HASHED_BYTES", 100)
    assert (word_hashes(data, starts, ends) == whole).all()


def test_runs_of_one_gram_are_cut_into_equal_pieces():
    values = np.full(1000, 7, np.uint64)
    starts, counts, _, whole = super_kmers(values, np.array([0, 1000]), 20, 5)
    assert counts.max() == 16 and counts.sum() == 981
    assert len(set(whole[:-1].tolist())) == 1 and (np.diff(starts) == 16).all()


@pytest.mark.parametrize("size", [120, 4096])
def test_periodic_texts_as_by_brute_force(documents, monkeypatch, size):
    monkeypatch.setattr(windows, "BLOCK", size)
    rows = list(enumerate([
        "=" * 700, "a" + "=" * 900 + "b", "=" * 99, "=" * 100, "xy" * 400, "yx" * 333, "same word " * 90,
        "word same " * 70, "z " * 333, "=" * 20 + text("own", 60) + "=" * 300,
    ]))
    docs = documents(rows)
    assert rows_of(remove_repeated_strings(docs)) == removed_bytes(rows)
    assert rows_of(remove_repeated_passages(docs)) == removed_words(rows)


@pytest.mark.parametrize(
    "job",
    [
        Job(100, 48, Bytes, True, None, bytes),
        Job(50, 10, Words, False, None, bytes),
    ],
)
def test_a_run_of_twenty_megabytes_stays_within_a_task(job):
    unit = b"x" if job.cut is Bytes else b"w "
    table = pa.table({"text": pa.array([(unit * (BIG // len(unit))).decode()])})
    tracemalloc.start()
    for _, _, part in window_repeats._slices(job, table):
        keys = np.unique(window_repeats._keys(job, part))
        starts, counts, least, whole = super_kmers(part.codes, part.bounds, job.width, job.gram)
        again = window_repeats._again(job, part, starts, counts, least)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000_000
    assert len(keys) <= 2 and len(np.unique(whole)) <= 2 * (BIG // windows.BLOCK + 2)
    assert again.all() == job.within and counts.max() <= job.width - job.gram + 1


def test_a_long_run_in_two_documents_has_a_closed_form(session):
    n = 2_000_000
    docs = session.range(2).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), n).alias("text"))
    found = sorted((r.doc_id, r.n, r.gone) for r in remove_repeated_strings(docs).select(
        "doc_id", "n", F.expr("aggregate(spans, 0L, (a, x) -> a + x.end - x.start)").alias("gone")
    ).collect())
    assert found == [(0, n, n - 1), (1, n, n)]
    words = session.range(2).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), n).alias("text"))
    found = sorted((r.doc_id, r.n, r.gone) for r in remove_repeated_passages(words).select(
        "doc_id", "n", F.expr("aggregate(spans, 0L, (a, x) -> a + x.end - x.start)").alias("gone")
    ).collect())
    assert found == [(0, n, 0), (1, n, n)]


def family(n, edits, seed=3):
    """Near copies of one text: some are alike, most are too far from all others, and all share most words."""
    pick = random.Random(seed)
    base = text("centre", 150, 5000).split()
    out = []
    for k in range(n):
        own = list(base)
        for at in pick.sample(range(len(base)), pick.randrange(edits)):
            own[at] = f"other{pick.randrange(3)}"
        out.append(" ".join(own))
    return out


def test_family_around_the_threshold_as_by_brute_force(documents):
    rows = list(enumerate(family(160, 16)))
    found = similar(documents(rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == components_by_hand(rows)


def test_candidates_of_a_family_are_few_of_its_pairs(documents, monkeypatch):
    """Edits coincide often here (three words only), so that many pairs lie close to the threshold."""
    made = []
    keep = candidates

    def counted(spread, threshold):
        out = keep(spread, threshold)
        made.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "candidates", counted)
    for n in (100, 400):
        similar(documents(family(n, 16))).count()
        assert made[-1] <= 0.03 * n * (n - 1) / 2


def test_held_out_toxicity(session):
    from arenalake.llm.queries import QUERIES

    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in session.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in QUERIES["op7_toxicity"](session, folder).where("held_out").collect() if r.doc_id in labels]
    toxic = [r.predicted for r in held if labels[r.doc_id]]
    clean = [r.predicted for r in held if not labels[r.doc_id]]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.01 * len(clean)
