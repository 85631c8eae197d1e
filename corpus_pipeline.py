"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns
of ``documents``. A stage works on all rows that the one before has kept; benchmark
items and labels come from the tables of ``sf_dir``.

Every stage decides by row, so rows without an id, or of the same id, are treated like all
others. Columns beyond those of ``documents`` pass through.
"""

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from arenalake.llm import decontaminate, secret_scan, toxicity  # noqa: E402
from arenalake.llm.jaccard_join import similar  # noqa: E402
from arenalake.llm.packing import pack  # noqa: E402
from arenalake.llm.queries import table, tokenizer_path  # noqa: E402
from arenalake.llm.repeated_keys import row_hash  # noqa: E402
from arenalake.llm.store import ship, stored  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; the model learns from the labels of ``docs``."""
    ship(spark)
    return toxicity.clean_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents one row: the smallest id, rows without an id last.

    Documents without words stay. Of rows with equal id and text one stays.
    """
    ship(spark)
    found = stored(similar(docs).where("component is not null").select("component", "doc_id", "row"))
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    first = found.groupBy("component").agg(F.min(place).alias("first"))
    copies = found.join(first, "component").where(F.col("row") != F.col("first.row")).select(F.col("row").alias("copy_row"))
    copies = stored(copies.distinct())
    kept = docs.join(copies, row_hash() == copies["copy_row"], "left_anti")
    twice = stored(found.groupBy("row").count().where("count > 1").select(F.col("row").alias("twice_row")))
    if twice.isEmpty():
        return kept
    equal = row_hash() == twice["twice_row"]
    several = kept.join(twice, equal, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(twice, equal, "left_anti").unionByName(several)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    ship(spark)
    return secret_scan.redact(docs, secret_scan.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with a checksum of their ids."""
    ship(spark)
    pieces = pack(docs, tokenizer_path("byte_bpe_50k.json"))
    checksum = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", checksum, "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scans", without_secrets),
    ("packing", packed),
]

#: The models and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, on the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
