"""Which keys of a group of documents occur again anywhere in the table.

Three operators share this step. Documents are dealt out into groups by a hash. Each
group sends the distinct keys of its texts, sorted and as differences, to buckets by
range of the key. A bucket adds up the counts and answers every group with those of
its keys that occur at least twice in all. A key travels at most once for each group,
whatever the number of its occurrences, so a frequent key is no hot spot.

The numbers of groups and buckets follow the number of documents and the bytes of their
texts: a group has some 512 documents and some 8 MB. A text is never divided, so a
longer one is a group of its own size. Equal rows (the same id, or none, and the
same text) are dealt out by a stored row number.

A group always sends ``RANGES`` rows, so their number is in proportion to the table. Where that
many buckets would be too large, ``HOLDERS`` groups' rows of one range are merged and cut into as many
ranges again, until buckets are small enough; answers go back over the same steps. Each further
step has half as many rows as the one before.

Keys are shortened to a number of bits that grows with the table, some 22 bits more
than the number of documents (of 16 KB, if they are longer) needs. Two keys that share these bits are taken
for repeated. So the answer may name a few keys too many, never one too few; what
follows must compare in full.
"""

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenalake.llm.store import stored, texts

GROUP_DOCUMENTS = 512
#: Documents whose keys one bucket may hold.
BUCKET_DOCUMENTS = 8192
RANGE_BITS = 5
RANGES = 1 << RANGE_BITS
HOLDERS = 64
#: Groups that one task handles, one after the other.
TASK_GROUPS = 8
#: A table counts as at least so many documents as its texts have multiples of this.
DOCUMENT_BYTES = 16_384
NO_ID = -(1 << 63)
BLOB = "bucket long, src long, n long, keys binary, counts binary"


def _squeezed(values: np.ndarray) -> bytes:
    """Unsigned integers, byte by byte: all first bytes, then all second bytes."""
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unsqueezed(data: bytes, n: int) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.uint64)


def _blob(keys: np.ndarray, counts: np.ndarray) -> tuple[int, bytes, bytes]:
    return len(keys), _squeezed(np.diff(keys, prepend=np.uint64(0))), _squeezed(counts)


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray]:
    keys = np.cumsum(_unsqueezed(row["keys"], row["n"]), dtype=np.uint64)
    return keys, _unsqueezed(row["counts"], row["n"])


def _rows(blobs: list[tuple[int, int, np.ndarray, np.ndarray]]) -> list[dict]:
    """(bucket, src, sorted keys, counts) as rows; those without keys are left out."""
    return [dict(zip(BLOBS.names, (a, b, *_blob(keys, counts)), strict=True)) for a, b, keys, counts in blobs if len(keys)]


def _summed(blobs: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """All keys with their summed counts; for each blob's keys the place among them, and the blobs' sizes."""
    opened = [_opened(x) for x in blobs]
    keys, inverse = np.unique(np.concatenate([x[0] for x in opened]), return_inverse=True)
    counts = np.concatenate([x[1] for x in opened]).astype(np.int64)
    total = np.bincount(inverse, counts, len(keys)).astype(np.int64)
    return keys, total, inverse, [len(x[0]) for x in opened]


class Repeated:
    """The keys of one group that occur at least twice in the table, with their numbers of occurrences."""

    def __init__(self, answers: pa.Table, bits: int):
        self.shift = np.uint64(64 - bits)
        opened = [_opened(row) for row in answers.sort_by("bucket").to_pylist()]
        self.keys = np.concatenate([np.zeros(0, np.uint64), *(x[0] for x in opened)])
        self.counts = np.concatenate([np.zeros(0, np.uint64), *(x[1] for x in opened)]).astype(np.int64)

    def times(self, keys: np.ndarray) -> np.ndarray:
        """For each key how often it occurs, 1 if it is not repeated."""
        if not len(self.keys):
            return np.ones(len(keys), np.int64)
        short = keys >> self.shift
        at = np.minimum(np.searchsorted(self.keys, short), len(self.keys) - 1)
        return np.where(self.keys[at] == short, self.counts[at], 1)


@dataclass(frozen=True)
class Extent:
    """The size of a table in documents, long texts counted as several, and whether rows are equal."""

    documents: int
    equal_rows: bool

    @property
    def groups(self) -> int:
        return max(1, self.documents // GROUP_DOCUMENTS)


def extent(documents: DataFrame) -> Extent:
    row = texts(documents).agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size"),
        F.count_distinct(row_hash()).alias("different"),
    ).first()
    return Extent(max(row["n"], -(-row["size"] // DOCUMENT_BYTES)), row["different"] < row["n"])


def row_hash() -> Column:
    """A hash of a row's id and text (null: empty), as ``grouped`` has it."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def grouped(documents: DataFrame, of: Extent) -> DataFrame:
    """``src, doc, row, text``; ``doc`` is the id, a null one comes before all, ``row`` a hash of id and text."""
    rows = texts(documents).withColumn("dealt", row_hash())
    if of.equal_rows and of.groups > 1:
        equal = stored(rows.groupBy("dealt").count().where("count > 1").select("dealt"))
        # Stored, so that a task that runs again gives a row the same number.
        numbered = stored(rows.join(equal, "dealt", "left_semi").withColumn("number", F.monotonically_increasing_id()))
        numbered = numbered.select("doc_id", "text", F.xxhash64("dealt", "number").alias("dealt"), F.col("dealt").alias("row"))
        rows = rows.withColumn("row", F.col("dealt")).join(equal, "dealt", "left_anti").unionByName(numbered)
    else:
        rows = rows.withColumn("row", F.col("dealt"))
    doc = F.coalesce("doc_id", F.lit(NO_ID)).alias("doc")
    src = F.pmod(F.col("dealt"), F.lit(of.groups)).cast("long").alias("src")
    return rows.select(src, doc, "row", "text")


def with_repeated(
    documents: DataFrame,
    keys_of: Callable[[pa.Table], np.ndarray],
    result_of: Callable[[pa.Table, Repeated], pa.Table],
    schema: str,
    of: Extent | None = None,
) -> DataFrame:
    """``result_of(group, repeated keys)`` for every group of documents.

    ``keys_of`` gives the keys of a group, one for every occurrence that counts.
    The documents are dealt out once; both steps read the same exchange.
    """
    of = of or extent(documents)
    n = of.documents
    session = documents.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-of.groups // TASK_GROUPS))
    rows = grouped(documents, of).repartition(tasks, "src")
    bits = min(64, math.ceil(math.log2(n + 2)) + 22)
    levels, single = steps(n), of.groups == 1
    down = np.uint64(64 - bits)

    def cut(src: int, range_: int, level: int, keys: np.ndarray, counts: np.ndarray) -> list[dict]:
        """The sorted keys of one range, cut into the ranges of the next level."""
        if single:
            return _rows([(0, src, keys, counts)])
        place = np.uint64(bits - RANGE_BITS * (level + 1))
        first = range_ << RANGE_BITS
        cuts = np.searchsorted(keys, np.arange(first + 1, first + RANGES, dtype=np.uint64) << place)
        parts = zip(np.split(keys, cuts), np.split(counts, cuts), strict=True)
        return _rows([(first + k, src, part, times) for k, (part, times) in enumerate(parts)])

    def send(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts = np.unique(keys_of(table) >> down, return_counts=True)
        return pa.Table.from_pylist(cut(key[0].as_py(), 0, 0, keys, counts), BLOBS)

    def merge(level: int) -> Callable:
        def merged(key: tuple, table: pa.Table) -> pa.Table:
            keys, total, _, _ = _summed(table.to_pylist())
            return pa.Table.from_pylist(cut(key[1].as_py(), key[0].as_py(), level, keys, total), BLOBS)

        return merged

    def answer(_: tuple, table: pa.Table) -> pa.Table:
        blobs = table.to_pylist()
        keys, total, inverse, sizes = _summed(blobs)
        out, at = [], 0
        for blob, size in zip(blobs, sizes, strict=True):
            own = inverse[at : at + size]
            at += size
            own = own[total[own] > 1]
            out.append((blob["bucket"], blob["src"], keys[own], total[own]))
        return pa.Table.from_pylist(_rows(out), BLOBS)

    def back(_: tuple, blobs: pa.Table, answers: pa.Table) -> pa.Table:
        known, out = Repeated(answers, 64), []
        for blob in blobs.to_pylist():
            keys, _ = _opened(blob)
            times = known.times(keys)
            out.append((blob["bucket"], blob["src"], keys[times > 1], times[times > 1]))
        return pa.Table.from_pylist(_rows(out), BLOBS)

    def finish(_: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        return result_of(table, Repeated(answers, bits))

    def held(blobs: DataFrame) -> DataFrame:
        return blobs.withColumn("holder", F.floor(F.col("src") / HOLDERS).cast("long"))

    sent = [rows.groupBy("src").applyInArrow(send, BLOB)]
    for level in range(1, levels):
        sent[-1] = stored(sent[-1])
        sent.append(held(sent[-1]).groupBy("bucket", "holder").applyInArrow(merge(level), BLOB))
    answers = sent[-1].groupBy("bucket").applyInArrow(answer, BLOB)
    for blobs in reversed(sent[:-1]):
        above = answers.select(F.shiftright("bucket", RANGE_BITS).alias("of"), F.col("src").alias("to"), *answers.columns)
        answers = held(blobs).groupBy("bucket", "holder").cogroup(above.groupBy("of", "to")).applyInArrow(back, BLOB)
    return rows.groupBy("src").cogroup(answers.groupBy("src")).applyInArrow(finish, schema)


def steps(documents: int) -> int:
    """How many times keys are cut into ranges until buckets are small enough."""
    out = 1
    while RANGES**out * BUCKET_DOCUMENTS < documents:
        out += 1
    return out


BLOBS = pa.schema(
    [("bucket", pa.int64()), ("src", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]
)
