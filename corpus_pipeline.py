"""A training-data pipeline over ``documents``: five stages, each the next one's input through a Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import exact_dedup, langid, mixing, sentencepieces, simhash
from corpusloom.llm.queries import PIECES, tokenizer_path
from corpusloom.llm.textkit import crc_bucket, materialize, read_table, small_batches

#: Near duplicates of the pipeline: shingles of five words; 56 of 256 differing bits are candidates, which an exact check
#: of the shingles for a similarity of 0.8 joins or not.
WORDS, RADIUS = 5, 56


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those the classifier rejects go.

    Null texts and texts without a letter have no language and go; so do those too far from every centroid. Rows that repeat are judged alike
    and all stay or go, null ids and sources pass, and lang serves for training only (null: not). No rows, or none with a lang, give no rows. Columns
    keep their names, extra ones too.
    """
    small_batches(spark)
    model = langid.train(docs.select("doc_id", "text", "lang").filter(crc_bucket("doc_id", 5) != 0))
    name = "language"
    while name in docs.columns:
        name += "_"
    return langid.with_language(docs, model, name=name).filter(f"NOT `{name}`.rejected").drop(name)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id.

    Null and empty texts are one text. Of rows of one text that repeat the largest id one stays; a null id is less than any other. No rows give no
    rows. Columns keep their names, extra ones too.
    """
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Texts without words are near each other and nothing else. Rows are judged by their own text, so rows that repeat an id, or have none, go only with
    their group; a group without any id stays whole. No rows give no rows. Columns keep their names, extra ones too.
    """
    small_batches(spark)
    return simhash.drop_near_duplicates(docs, words=WORDS, radius=RADIUS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order.

    Null and wordless texts are not taken. A null source is a source of its own. Rows that repeat an id, null ones too, are planned apart and none stands for another
    text; whole copies are one row, put wherever one of them is taken. No rows give no rows. Columns keep their names, extra ones too.
    """
    return mixing.mix(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digest of ids and of the text decoded from them, for every document of the mix.

    Null and empty texts have no ids and decode to the empty text; rows that repeat give rows that repeat, null ids pass, other columns are not read, no
    rows give no rows.
    """
    small_batches(spark)
    return sentencepieces.round_trip(docs, tokenizer_path(PIECES))


STAGES = [
    ("language ID", language),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", pieces),
]

#: SQL can't express the language classifier, SimHash or the tokenizer: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
