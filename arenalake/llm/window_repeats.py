"""Removing windows that occur earlier: the steps shared by two operators.

1. Every document's windows are cut into super-k-mers. Those whose smallest gram
   hash occurs only once in the table hold no repeated window and go no further.
2. Equal super-k-mers (by hash) are counted as one, with their first holder. Every
   later holder repeats all their windows, so a text copied a thousand times costs
   a thousand short rows, not a thousand texts.
3. Different super-k-mers of one smallest gram hash may still share windows. Only
   the first holder's string of each travels to the bucket of that hash, where the
   operator compares the windows themselves.
   A hash that more than ``HOT_KINDS`` different super-k-mers share would make a hot
   bucket: their windows go as digests of 128 bits instead, whose first holder is
   found by a grouping that adds up before the shuffle.
4. All removed ranges return to their documents.

A bucket holds different strings only, at most ``HOT_KINDS`` of one hash. Intermediate tables are written to the
shared folder, and every step starts from them.
"""

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.llm.repeated_keys import NO_ID, Repeated, extent, with_repeated
from arenalake.llm.store import stored
from arenalake.llm.windows import Sums, blocks, sliding_minimum, super_kmers, united
from arenalake.llm.words import text_slices

DONE, TEXT, RUN = 0, 1, 2
#: Different super-k-mers of one smallest gram that one bucket takes; some 100 MB with the heads
#: of their suffixes.
HOT_KINDS = 20_000
#: Super-k-mers of one slice that are looked at together.
AGAIN_RUNS = 4096
#: Texts are handled some so many bytes at a time, which keeps the arrays in the processor's cache.
SLICE_BYTES = 1 << 18


class Slice:
    """Some texts as one sequence of units (bytes or words)."""

    codes: np.ndarray  # one for each unit
    bounds: np.ndarray  # where each text begins among the units, and the end

    def packed(self, start: int, end: int) -> bytes:
        """The units from ``start`` to ``end`` of one text as one string."""
        raise NotImplementedError

    def joined(self, pieces: list[bytes]) -> bytes:
        """Strings of consecutive units as one."""
        raise NotImplementedError


@dataclass(frozen=True)
class Job:
    """What the two operators do differently."""

    width: int
    gram: int
    cut: Callable[[np.ndarray, np.ndarray], Slice]  # of data and offsets
    within: bool  # whether a window may repeat an earlier one of its own document
    compare: Callable[[list[dict]], list[tuple[int, int, int]]]  # strings -> (string, first window, last window)
    kept: Callable[[bytes], bytes | str]  # what is reported of the units that stay
    kept_type: str = "binary"


def _keys(job: Job, part: Slice) -> np.ndarray:
    """A key for each place that is the smallest gram of a window, or for each such gram of a document."""
    if job.within:
        found = [_smallest(job, codes, bounds) for _, codes, bounds in blocks(part.codes, part.bounds, job.width)]
        return np.concatenate(found)
    starts, _, least, _ = super_kmers(part.codes, part.bounds, job.width, job.gram)
    owner = np.searchsorted(part.bounds, starts, "right") - 1
    order = np.lexsort((least, owner))
    owner, least = owner[order], least[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (least[1:] != least[:-1]))[: len(least)]
    return least[new]


def _smallest(job: Job, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    if len(codes) < job.width:
        return np.zeros(0, np.uint64)
    grams = Sums(codes).grams(job.gram)
    span = job.width - job.gram + 1
    least = sliding_minimum(grams, span)
    ends = np.repeat(bounds[1:], np.diff(bounds))[: len(least)]
    least[np.arange(len(least)) + job.width > ends] = 0
    # The largest minimum of all windows around a place, if the gram there is one of these minima.
    around = np.concatenate([np.full(span - 1, 0, np.uint64), least, np.full(span - 1, 0, np.uint64)])
    keys, times = np.unique(grams[grams == ~sliding_minimum(~around, span)], return_counts=True)
    # Twice says as much as a million times.
    return np.repeat(keys, np.minimum(times, 2))


def _again(job: Job, part: Slice, starts: np.ndarray, counts: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether the smallest gram of a super-k-mer occurs in it more than once."""
    out = np.zeros(len(starts), bool)
    if not job.within:
        return out
    for low in range(0, len(starts), AGAIN_RUNS):
        few = slice(low, low + AGAIN_RUNS)
        sizes = counts[few] + job.width - 1
        first, last = int(starts[few][0]), int((starts[few] + sizes).max())
        grams = Sums(part.codes[first:last]).grams(job.gram)
        sizes = sizes - job.gram + 1
        begins = np.cumsum(sizes) - sizes
        places = np.repeat(starts[few] - first - begins, sizes) + np.arange(int(sizes.sum()))
        same = grams[places] == np.repeat(least[few], sizes)
        out[few] = np.add.reduceat(same.astype(np.int64), begins) > 1
    return out


def _slices(job: Job, table: pa.Table) -> Iterator[tuple[int, int, Slice]]:
    for first, last, data, offsets in text_slices(table.column("text").combine_chunks(), SLICE_BYTES):
        yield first, last, job.cut(data, offsets)


def _row(kind: int, src: int, row: int, doc: int, **more) -> dict:
    return {"kind": kind, "src": src, "row": row, "doc": doc, **more}


def _result(job: Job, part: Slice, low: int, high: int, starts: np.ndarray, ends: np.ndarray) -> dict:
    """Numbers, removed ranges and what stays of the text of units ``low`` to ``high``."""
    starts, ends = united(starts, ends)
    borders = [low, *np.stack([starts, ends], 1).ravel().tolist(), high]
    pieces = [part.packed(a, b) for a, b in zip(borders[0::2], borders[1::2], strict=True) if b > a]
    spans = [{"start": a - low, "end": b - low} for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return {"n": high - low, "spans": spans, "kept": job.kept(part.joined(pieces))}


def without_repeats(documents: DataFrame, job: Job) -> DataFrame:
    """``doc_id, n, spans, kept``: units, removed ranges of units, and what stays."""
    kept_kind = pa.string() if job.kept_type == "string" else pa.binary()
    span_kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    numbers = ["start", "count", "least", "whole"]
    first_schema = pa.schema(
        [("kind", pa.int32()), ("src", pa.int64()), ("row", pa.int64()), ("doc", pa.int64())]
        + [("n", pa.int64()), ("spans", span_kind), ("kept", kept_kind), ("text", pa.string())]
        + [(x, pa.int64()) for x in numbers]
        + [("again", pa.bool_())]
    )
    spans_ddl = "spans array<struct<start:long,end:long>>"
    first_ddl = (
        f"kind int, src long, row long, doc long, n long, {spans_ddl}, kept {job.kept_type}, text string, "
        "start long, count long, least long, whole long, again boolean"
    )

    def keys_of(table: pa.Table) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *(_keys(job, part) for _, _, part in _slices(job, table))])

    def first_step(table: pa.Table, repeated: Repeated) -> pa.Table:
        out, batches = [], []
        src = table.column("src")[0].as_py() if len(table) else 0
        docs, texts = table.column("doc").to_pylist(), table.column("text")
        for first, last, part in _slices(job, table):
            starts, counts, least, whole = super_kmers(part.codes, part.bounds, job.width, job.gram)
            likely = repeated.times(least) > 1
            starts, counts, least, whole = (x[likely] for x in (starts, counts, least, whole))
            owner = np.searchsorted(part.bounds, starts, "right") - 1
            again = _again(job, part, starts, counts, least)
            busy = np.zeros(last - first, bool)
            busy[owner] = True
            for k in range(last - first):
                low, high = int(part.bounds[k]), int(part.bounds[k + 1])
                row = first + k
                if busy[k]:
                    out.append(_row(TEXT, src, row, docs[row], n=high - low, text=texts[row].as_py()))
                else:
                    none = np.zeros(0, np.int64)
                    out.append(_row(DONE, src, row, docs[row], **_result(job, part, low, high, none, none)))
            size = len(starts)
            columns = {
                "kind": np.full(size, RUN, np.int32),
                "src": np.full(size, src),
                "row": first + owner,
                "doc": np.array(docs, np.int64)[first + owner] if size else starts,
                "start": starts - part.bounds[owner],
                "count": counts,
                "least": least.view(np.int64),
                "whole": whole.view(np.int64),
                "again": again,
            }
            batches.append(
                pa.table([
                    pa.array(columns[x.name], x.type) if x.name in columns else pa.nulls(size, x.type)
                    for x in first_schema
                ], schema=first_schema)
            )
        return pa.concat_tables([pa.Table.from_pylist(out, first_schema), *batches])

    of = extent(documents)
    first = stored(with_repeated(documents, keys_of, first_step, first_ddl, of))
    found = first.where(F.col("kind") == RUN).select("src", "row", "doc", *numbers, "again")
    held = first.where(F.col("kind") == TEXT).select("src", "row", "doc", "text")
    holder = F.struct("doc", "src", "row", "start", "count", "again")
    kinds = stored(found.groupBy("least", "whole").agg(F.min(holder).alias("first")))

    # Super-k-mers that share their smallest gram with another one, or with themselves.
    several = kinds.groupBy("least").agg(
        F.count("*").alias("kinds"), F.max(F.col("first.again").cast("int")).alias("again")
    ).where("kinds > 1 or again = 1")
    contested = kinds.join(several.select("least", "kinds"), "least").select(
        F.col("first.src").alias("at_src"), F.col("first.row").alias("at_row"), F.col("first.doc").alias("of_doc"),
        F.col("first.start").alias("start"), F.col("first.count").alias("count"), "least", "whole",
        (F.col("kinds") > HOT_KINDS).alias("hot"),
    )
    buckets = of.groups

    def strings(key: tuple, texts: pa.Table, wanted: pa.Table) -> pa.Table:
        """The strings that a group's documents hold first, or the digests of their windows."""
        by_row: dict[int, list[dict]] = {}
        for x in wanted.to_pylist():
            place = {"src": x.pop("at_src"), "row": x.pop("at_row"), "doc": x.pop("of_doc")}
            by_row.setdefault(place["row"], []).append(x | place)
        texts = texts.filter(pa.array([x in by_row for x in texts.column("row").to_pylist()], pa.bool_()))
        rows, out = texts.column("row").to_pylist(), []
        for begin, last, part in _slices(job, texts) if rows else ():
            for k in range(last - begin):
                low = int(part.bounds[k])
                for x in by_row[rows[begin + k]]:
                    start = low + x["start"]
                    if not x["hot"]:
                        out.append(x | {"string": part.packed(start, start + x["count"] + job.width - 1)})
                        continue
                    for at in range(start, start + x["count"]):
                        digest = hashlib.blake2b(part.packed(at, at + job.width), digest_size=16).digest()
                        out.append(x | {"at": at - start, "digest": digest})
        return pa.Table.from_pylist(out, string_schema)

    string_schema = pa.schema(
        [(x, pa.int64()) for x in ("src", "row", "doc", "start", "count", "least", "whole", "at")]
        + [("string", pa.binary()), ("digest", pa.binary())]
    )
    string_ddl = (
        "src long, row long, doc long, start long, count long, least long, whole long, at long, "
        "string binary, digest binary"
    )
    sent = stored(
        held.groupBy("src")
        .cogroup(contested.groupBy("at_src"))
        .applyInArrow(strings, string_ddl)
    )

    def compare(_: tuple, table: pa.Table) -> pa.Table:
        items = table.to_pylist()
        out = []
        for k, low, high in job.compare(items):
            x = items[k]
            out.append({c: x[c] for c in ("src", "row", "doc", "least", "whole")} | {
                "start": x["start"], "low": low, "high": high
            })
        return pa.Table.from_pylist(out, ranges_schema)

    range_names = ["src", "row", "doc", "least", "whole", "start", "low", "high"]
    ranges_schema = pa.schema([(x, pa.int64()) for x in range_names])
    partly = (
        sent.where("string is not null")
        .drop("at", "digest")
        .groupBy(F.pmod("least", F.lit(buckets)).alias("bucket"))
        .applyInArrow(compare, ", ".join(f"{x} long" for x in range_names))
    )
    windows = sent.where("digest is not null")
    place = F.struct("doc", "src", "row", (F.col("start") + F.col("at")).alias("place"))
    holders = windows.groupBy("digest").agg(F.min(place).alias("holder"))
    repeats = windows.join(holders, "digest").where(
        place > F.col("holder") if job.within else F.col("doc") > F.col("holder.doc")
    )
    hot = repeats.select(*range_names[:-2], F.col("at").alias("low"), F.col("at").alias("high"))
    partly = partly.unionByName(hot)

    together = found.join(kinds, ["least", "whole"])
    own = [F.col(x) for x in ("doc", "src", "row", "start")]
    later = F.struct(*own) > F.struct(*(F.col(f"first.{x}") for x in ("doc", "src", "row", "start")))
    if not job.within:
        later = F.col("doc") > F.col("first.doc")
    wholly = together.where(later).select(
        "src", "row", "start", (F.col("start") + F.col("count") + job.width - 1).alias("end")
    )
    if job.within:
        parts = partly.select("src", "row", "start", "low", "high")
    else:
        # All places of the first document, in case it holds the super-k-mer more than once.
        parts = found.select("src", "row", "doc", "start", "least", "whole").join(
            partly.select("doc", "least", "whole", "low", "high").distinct(), ["doc", "least", "whole"]
        ).select("src", "row", "start", "low", "high")
    parts = parts.select(
        "src", "row", (F.col("start") + F.col("low")).alias("start"), (F.col("start") + F.col("high") + job.width).alias("end")
    )

    def last_step(_: tuple, texts: pa.Table, removed: pa.Table) -> pa.Table:
        order = np.argsort(removed.column("at_row").to_numpy(), kind="stable")
        row_of, starts, ends = (removed.column(x).to_numpy()[order] for x in ("at_row", "low", "high"))
        rows, docs, out = texts.column("row").to_pylist(), texts.column("doc").to_pylist(), []
        for begin, last, part in _slices(job, texts):
            for k in range(last - begin):
                low, high = int(part.bounds[k]), int(part.bounds[k + 1])
                a, b = np.searchsorted(row_of, [rows[begin + k], rows[begin + k] + 1])
                result = _result(job, part, low, high, low + starts[a:b], low + ends[a:b])
                out.append({"doc": docs[begin + k], **result})
        return pa.Table.from_pylist(out, last_schema)

    last_schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("spans", span_kind), ("kept", kept_kind)])
    finished = (
        held.groupBy("src")
        .cogroup(wholly.unionByName(parts).toDF("at_src", "at_row", "low", "high").groupBy("at_src"))
        .applyInArrow(last_step, f"doc long, n long, {spans_ddl}, kept {job.kept_type}")
    )
    untouched = first.where(F.col("kind") == DONE).select("doc", "n", "spans", "kept")
    rows = untouched.unionByName(finished)
    return rows.select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "n", "spans", "kept")
