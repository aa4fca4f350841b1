"""Documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns
of ``documents``. Empty inputs and nulls are handled as each operator's module says.

A stage's result may read tables that the stage has left in the shared folder, so a stage never removes
anything of another one. ``run`` owns what its stages leave: when a stage's result has been written, it removes
these tables and the result of the stage before, and keeps the last result alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jetloom.llm import line_dedup, mixing, packing, quality, simhash
from jetloom.llm.common import read_table, written
from jetloom.sources.shared import recording, remove


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``n_chars`` again after the text has changed, where there is such a column."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.quality_filter(docs)


def line_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them have."""
    out = line_dedup.line_dedup(docs)
    return _counted(out.select("row.*", F.col("kept_text").alias("text")), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: similarity of 0.8 or more on five-word shingles."""
    return simhash.one_of_each(docs, words=5, similarity=0.8)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; where it ends inside one, that one's first words."""
    return _counted(mixing.mixed(docs, ordered=False), docs.columns)  # packing decides the order


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_removal),
    ("near-dedup", near_duplicates),
    ("source mix", source_mix),
    ("best-fit packing", packed),
]

#: SQL has no XXH64 and no tokenizer; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read_table(spark, sf_dir, "documents"), []
    for name, work in STAGES:
        with recording() as made:
            docs = written(work(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        *scratch, result = made
        remove(spark, [*held, *scratch])
        held = [result]
    return docs
