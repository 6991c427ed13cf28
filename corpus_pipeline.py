"""From raw documents to packed training sequences: five stages over the documents table.

Each stage is one operator, works on all documents that its predecessor kept, and stores what it keeps, so a lost
executor costs no more than the stage it was lost in.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.llm import host_rules, mixing, near_text, packing, surrogates
from tonearm.llm.files import read_table, stored
from tonearm.llm.queries import LANGUAGES, SMOOTHING, SURROGATE_KEY, TOKENIZER, VOCABULARY
from tonearm.session import tune


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own rules and whose source is not rejected.

    A null or empty text has no words and fails; a document without a source is judged on its own only. Repeated rows
    are judged each, texts of any length whole. No documents give none; columns of any name stay.
    """
    tune(spark)
    return host_rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies: five words, 80 percent.

    Texts that are null or without words are copies of nothing and stay. Rows of one doc_id and text stay or go
    together; a row without a doc_id goes if a near copy has one. Texts are compared whole. No documents give none;
    columns of any name stay.
    """
    tune(spark)
    return near_text.keep_one(docs, near_text.Near())


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets, and n_chars of the new text.

    A null text stays null, an empty one empty. One value has one surrogate in all documents, so repeated rows stay
    equal; documents without a doc_id are treated like others, texts of any length whole. No documents give none;
    columns of any name stay.
    """
    tune(spark)
    made = surrogates.with_surrogates(docs, SURROGATE_KEY).select("doc.*")
    return made.withColumn("n_chars", F.length("text").cast("long"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn and repeated so that sources, languages and topics have their target shares.

    Null sources and languages are categories of their own. A null or empty text has no tokens and is drawn by its
    cell; rows of one doc_id, and all rows without one, share a draw. Texts of any length count whole. No documents
    give none; columns of any name stay.
    """
    tune(spark)
    return mixing.repeated(mixing.mix(docs, LANGUAGES, SMOOTHING))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed into sequences of at most 2048.

    A null or empty text is the end id alone; only texts of more tokens than a sequence are cut. A repeated row is
    packed each time, a null doc_id stays null. No documents give no pieces; further columns are not looked at.
    """
    tune(spark)
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), 0, VOCABULARY)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("sequences", sequences),
]

#: Signatures, surrogates and packing are not expressed in SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages one after the other; each reads what its predecessor stored."""
    docs = read_table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
