"""From raw documents to training text in five stages.

Each stage takes (spark, docs, sf_dir) and gives the rows it keeps, with the columns of
`documents`; the last one gives piece ids. Between stages the rows are written as Parquet in the
shared folder and read again, so a lost executor costs one stage's work at most.

All stages read whole texts of any length and take null ids, repeated ids, repeated rows and further
columns as they come; a stage over an empty table gives an empty one. Columns that carry the names
used inside do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prosemill.llm.catalog import PIECE_MODEL, tokenizer_file
from prosemill.llm.decontamination import without_benchmark
from prosemill.llm.exact_dedup import without_copies
from prosemill.llm.frames import table
from prosemill.llm.jaccard_join import one_per_class
from prosemill.llm.language import with_language
from prosemill.llm.piece_codec import encode_pieces
from prosemill.llm.shared import kept


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, null and blank texts among them; those with letters stay,
    whatever language is predicted, repeated rows each."""
    return with_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays, of repeated rows with that id one; null texts
    count as empty, null ids as the smallest."""
    return without_copies(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the one with the smallest id stays, a null id only where there is
    no other; of repeated rows one. Texts without words stay, each."""
    return one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go, repeated rows each; null texts stay, and
    with an empty benchmark all do."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document's pieces, beside its id and, where there are such columns, its language and
    source; a null text has no pieces, repeated rows are encoded each."""
    beside = [name for name in ("lang", "source") if name in docs.columns]
    return encode_pieces(docs, tokenizer_file(PIECE_MODEL), *beside)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: Rank-order profiles and piece ids cannot be put in SQL; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
