"""Packing by concatenating and cutting.

The first pass stores every document's ids with the sum of ids before it in its
part; the sums of whole parts, added up in a second pass, turn that into global
offsets. Then windows of a fixed length are cut out of the one long sequence. A
document that crosses a window's border becomes one piece on each side.

Order of documents: that of the stored parts, fixed once the first pass is written.
No document is reordered to fill a gap, since there is none: every sequence is
full but the last, which is padded unless its length is a power of two.

Null text: the empty text, which still has its end id. Null or repeated ids
of documents: each row is packed for itself. Empty table: no piece. Other columns
of the input are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.llm.store import part_starts, stored, texts
from arenalake.llm.tokens import documents_ids

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def stored_ids(documents: DataFrame, path: str, end_id: int | None) -> DataFrame:
    """``part, part_offset, doc_id, n, ids``: ids as little-endian 32-bit integers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = [ids for _, ids in documents_ids(batch.column("text"), path, end_id)]
            lengths = np.array([len(x) for x in rows], np.int64)
            offsets = before + np.cumsum(lengths) - lengths
            before += int(lengths.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(rows), part, np.int64)),
                    pa.array(offsets),
                    batch.column("doc_id"),
                    pa.array(lengths),
                    pa.array([x.astype("<u4").tobytes() for x in rows], pa.binary()),
                ],
                ["part", "part_offset", "doc_id", "n", "ids"],
            )

    schema = "part long, part_offset long, doc_id long, n long, ids binary"
    return stored(texts(documents).mapInArrow(encode, schema))


def pack(documents: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int | None = 1) -> DataFrame:
    """All pieces: which ids of which document stand where in which sequence.

    ``start`` counts ids of the document, ``offset`` ids of the sequence; ``ids``
    holds the piece's own ids as little-endian unsigned 32-bit integers.
    """
    rows = stored_ids(documents, tokenizer_path, end_id)
    starts = part_starts(rows.select("part", "n"), "part", "n")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "place", "n"))
            for row, (doc, place, n) in enumerate(zip(*columns, strict=True)):
                ids = memoryview(batch.column("ids")[row].as_buffer())
                done = 0
                while done < n:
                    sequence, offset = divmod(place + done, length)
                    size = min(n - done, length - offset)
                    piece = (doc, done, size, n, sequence, offset, bytes(ids[4 * done : 4 * (done + size)]))
                    for column, value in zip(out, piece, strict=True):
                        column.append(value)
                    done += size
            kinds = [pa.int64()] * 6 + [pa.binary()]
            arrays = [pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    # One row of 16 bytes for each part: bounded by the number of tasks.
    placed = rows.join(F.broadcast(starts), "part")
    return placed.select(
        "doc_id", (F.col("part_start") + F.col("part_offset")).alias("place"), "n", "ids"
    ).mapInArrow(cut, PIECES)


def sequences(pieces: DataFrame, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """``sequence_id, n, ids``: the sequences themselves, padded to ``length``.

    A sequence whose length is a power of two is left unpadded. A group holds the
    pieces of one sequence, which together have ``length`` ids at most.
    """

    def build(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        ids = b"".join(table.column("ids").to_pylist())
        n = len(ids) // 4
        if n & (n - 1):
            ids += np.full(length - n, pad_id, "<u4").tobytes()
        return pa.table({"sequence_id": [key[0].as_py()], "n": [n], "ids": pa.array([ids], pa.binary())})

    return (
        pieces.select("sequence_id", "offset", "ids")
        .groupBy("sequence_id")
        .applyInArrow(build, "sequence_id long, n long, ids binary")
    )
