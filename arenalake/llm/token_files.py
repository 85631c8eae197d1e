"""Token ids as files: one zstandard frame for each document, with a shared dictionary.

A folder holds

* ``dictionary``: one row with the trained dictionary and its SHA-256;
* ``blocks``: Parquet rows of some ``block_bytes`` each, in ascending order of
  ``doc_id``. A block has the dictionary's hash, the documents' ids, their
  numbers of tokens, the ends of their frames (the offset index) and the frames,
  one after another. Parquet's own compression is off. ``first_id`` and
  ``last_id`` lead to the block of a document, the offset index to its frame, so
  a short document is read without its neighbours;
* ``parts``: the number of ids before each part.

The dictionary is trained on a bounded sample: ``sample_rows`` documents by hash
of their id on average, of each the first ``sample_bytes`` of its serialized ids.
With too few samples there is no dictionary (its bytes are empty).

Null text: the empty text. Documents without an id come first; rows with equal ids
keep an order by text. Empty table: no block. Other columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake.llm.store import part_starts, texts, write_table
from arenalake.llm.tokens import documents_ids, tokenizer

SAMPLE_ROWS = 2000
SAMPLE_BYTES = 32 << 10
DICTIONARY_BYTES = 64 << 10
BLOCK_BYTES = 256 << 10
LEVEL = 3
BLOCK = (
    "part long, part_offset long, first_id long, last_id long, width int, dictionary_hash string, "
    "doc_ids array<long>, n_tokens array<long>, ends array<long>, frames binary"
)


def serialized_as(path: str, end_id: int | None) -> np.dtype:
    """Little-endian integers of 16 bits where every id fits, else of 32."""
    return np.dtype("<u2" if max(tokenizer(path).size, (end_id or 0) + 1) <= 1 << 16 else "<u4")


def trained_dictionary(
    documents: DataFrame, path: str, end_id: int | None, sample_rows: int = SAMPLE_ROWS
) -> bytes:
    """A zstandard dictionary for serialized id arrays; empty if there are too few samples."""
    import zstandard

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = serialized_as(path, end_id)
        for batch in batches:
            rows = [x.astype(kind).tobytes()[:SAMPLE_BYTES] for _, x in documents_ids(batch.column("text"), path, end_id)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["ids"])

    every = max(1, documents.count() // sample_rows)
    chosen = texts(documents).where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    samples = sorted(row.ids for row in chosen.limit(4 * sample_rows).mapInArrow(sample, "ids binary").collect())
    if len(samples) < 100:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_token_files(
    documents: DataFrame, folder: str, tokenizer_path: str, end_id: int | None = 1, block_bytes: int = BLOCK_BYTES
) -> None:
    """Write ``documents`` to ``folder`` in ascending order of ``doc_id``."""
    spark = documents.sparkSession
    content = trained_dictionary(documents, tokenizer_path, end_id)
    digest = hashlib.sha256(content).hexdigest()
    write_table(
        spark.createDataFrame([(digest, bytearray(content))], "dictionary_hash string, content binary"),
        f"{folder}/dictionary",
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        kind = serialized_as(tokenizer_path, end_id)
        shared = zstandard.ZstdCompressionDict(content) if content else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True)
        part, before = TaskContext.get().partitionId(), 0
        docs, sizes, ends, frames, filled = [], [], [], [], 0

        def block() -> pa.RecordBatch:
            known = [x for x in docs if x is not None]
            row = {
                "part": part,
                "part_offset": before,
                "first_id": known[0] if known else None,
                "last_id": known[-1] if known else None,
                "width": kind.itemsize,
                "dictionary_hash": digest,
                "doc_ids": docs,
                "n_tokens": sizes,
                "ends": ends,
                "frames": b"".join(frames),
            }
            return pa.RecordBatch.from_pylist([row], BLOCK_SCHEMA)

        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            for row, ids in documents_ids(batch.column("text"), tokenizer_path, end_id):
                frame = press.compress(ids.astype(kind).tobytes())
                filled += len(frame)
                for column, value in ((docs, ids_of[row]), (sizes, len(ids)), (ends, filled), (frames, frame)):
                    column.append(value)
                if filled >= block_bytes:
                    yield block()
                    before += sum(sizes)
                    docs, sizes, ends, frames, filled = [], [], [], [], 0
        if docs:
            yield block()

    ordered = texts(documents).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    written = write_table(ordered.mapInArrow(blocks, BLOCK), f"{folder}/blocks", compression="none")
    amounts = written.select("part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    write_table(part_starts(amounts, "part", "n"), f"{folder}/parts")


BLOCK_SCHEMA = pa.schema(
    [("part", pa.int64()), ("part_offset", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64())]
    + [("width", pa.int32()), ("dictionary_hash", pa.string())]
    + [(x, pa.list_(pa.int64())) for x in ("doc_ids", "n_tokens", "ends")]
    + [("frames", pa.binary())]
)


def read_token_files(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: ids as little-endian 32-bit integers, of all or of some documents.

    ``start`` is the number of ids of all documents before. A block whose
    dictionary is not the stored one is an error.
    """
    dictionary = spark.read.parquet(f"{folder}/dictionary").first()
    digest, content = dictionary.dictionary_hash, bytes(dictionary.content)
    if hashlib.sha256(content).hexdigest() != digest:
        raise ValueError(f"{folder}: the dictionary does not have the hash stored with it")
    wanted = set(doc_ids) if doc_ids is not None else None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        shared = zstandard.ZstdCompressionDict(content) if content else None
        unpress = zstandard.ZstdDecompressor(dict_data=shared)
        names = ["part", "part_offset", "width", "dictionary_hash", "doc_ids", "n_tokens", "ends"]
        for batch in batches:
            for at, block in enumerate(batch.select(names).to_pylist()):
                if block["dictionary_hash"] != digest:
                    raise ValueError(f"{folder}: a block was written with another dictionary")
                frames = memoryview(batch.column("frames")[at].as_buffer())
                out: list[tuple] = []
                place, low = block["part_offset"], 0
                for doc, n, high in zip(block["doc_ids"], block["n_tokens"], block["ends"], strict=True):
                    if wanted is None or doc in wanted:
                        ids = np.frombuffer(unpress.decompress(frames[low:high]), f"<u{block['width']}")
                        if len(ids) != n:
                            raise ValueError(f"{folder}: document {doc} has {len(ids)} ids instead of {n}")
                        out.append((block["part"], doc, place, n, ids.astype("<u4").tobytes()))
                    place, low = place + n, high
                columns = list(zip(*out, strict=True)) or [()] * 5
                kinds = [pa.int64()] * 4 + [pa.binary()]
                arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "doc_id", "place", "n_tokens", "ids"])

    stored = spark.read.parquet(f"{folder}/blocks")
    if wanted is not None:
        known = [x for x in wanted if x is not None]
        near = F.lit(None in wanted)
        for doc in known:
            near = near | ((F.col("first_id") <= doc) & (F.col("last_id") >= doc))
        stored = stored.where(near)
    decoded = stored.mapInArrow(rows, "part long, doc_id long, place long, n_tokens long, ids binary")
    # One row of 16 bytes for each part: bounded by the number of tasks.
    parts = F.broadcast(spark.read.parquet(f"{folder}/parts"))
    return decoded.join(parts, "part").select(
        "doc_id", (F.col("part_start") + F.col("place")).alias("start"), "n_tokens", "ids"
    )
