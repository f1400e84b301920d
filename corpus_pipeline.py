"""The corpus pipeline: toxicity, near-duplicates, secrets, mixing, encoding.

Every stage takes the documents its predecessor kept and works on all of them; all but the last return
the columns of the documents. Between stages the rows are Parquet in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillflow.llm import minhash, mixing, pieces, secrets, toxicity
from tillflow.llm.common import staged, table

#: Words of a block of the mix: long enough to read, short against any source.
BLOCK_WORDS = 128


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8) the document of least id."""
    return minhash.one_of_each(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row per whole pass over a document, and one with its chosen blocks."""
    return mixing.mixed_documents(docs, block_words=BLOCK_WORDS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row of the mix, and whether they decode to its text."""
    carried = [name for name in docs.columns if name != "text"]
    return pieces.encode_documents(docs, pieces.Vocabulary.load(), carried)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_copies),
    ("secret scans", hide_secrets),
    ("mixing sources", mix_sources),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: A fitted model, hashed signatures and a Viterbi search: not SQL. Tested against brute force.
ORACLE_SQL = None
