"""From raw documents to packed sequences: five stages, each written and read again.

A stage takes the documents its predecessor kept and returns those it keeps, with the
same columns; the last returns the pieces of the packed sequences. Extra columns come
along whatever their names. Rows without doc_id cannot be referred to: the near-
duplicate and the suffix stage let them pass as they are.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.exact_dedup import exact_duplicates, text_digest
from wakeline.llm.near_dedup import near_duplicates
from wakeline.llm.packing import pack, token_pieces
from wakeline.llm.quality_rules import quality_rules, train
from wakeline.llm.queries import vocabulary
from wakeline.llm.repeats import remove_repeats
from wakeline.llm.tables import prepare, written

# Word shingles of near duplicates: this percentage of similarity or more.
NEAR_PERCENT = 80


def _rows(docs: DataFrame, *also: str) -> DataFrame:
    """The text, and all other columns as one, which clashes with no name of an operator."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("row"), "text", *also)


def _columns(docs: DataFrame, rows: DataFrame, changed: dict[str, Column]) -> DataFrame:
    """The columns of ``docs`` again, some of them changed."""
    from_row = {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"}
    values = from_row | {"text": F.col("text")} | changed
    return rows.select(*(values[c].alias(c) for c in docs.columns))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and that the classifier takes for good ones."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = quality_rules(_rows(docs), train(docs, labels), carry=["row", "text"]).where("kept")
    return _columns(docs, kept, {})


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents with equal normalised text the one with the smallest doc_id.

    Of rows repeated in full one stays.
    """
    kept = exact_duplicates(docs).where("kept").select("doc_id", "text_sha256")
    rows = docs.select(
        F.struct("*").alias("row"), "doc_id", text_digest(F.col("text")).alias("text_sha256")
    )
    same = rows["doc_id"].eqNullSafe(kept["doc_id"])
    return (
        rows.join(kept, (rows["text_sha256"] == kept["text_sha256"]) & same, "left_semi")
        .dropDuplicates(["text_sha256"])
        .select("row.*")
    )


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all without a partner."""
    prepare(spark)
    kept = near_duplicates(docs, NEAR_PERCENT).where("kept AND doc_id IS NOT NULL")
    # Neither side has a size bound.
    stay = docs.join(kept.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
    return stay.unionAll(docs.where("doc_id IS NULL"))


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without strings that start earlier; n_chars is counted anew.

    Of a text that loses bytes a character cut apart goes, and any replacement character.
    A missing text becomes empty. A document
    that loses all its text stays with an empty one.
    """
    prepare(spark)
    kept = F.col("kept").cast("string")
    text = F.when(F.col("n_removed") == 0, kept).otherwise(
        F.replace(F.make_valid_utf8(kept), F.lit("\ufffd"), F.lit(""))
    )
    left = remove_repeats(_rows(docs, "doc_id"), carry=["row"]).withColumn("text", text)
    return _columns(docs, left, {"n_chars": F.length("text").cast("long")})


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents with its place in a sequence."""
    prepare(spark)
    pieces = token_pieces(docs, vocabulary("word_bpe_49k.json"))
    return pack(
        pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    )


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("suffix-array dedup", suffix_stage),
    ("best-fit packing", packing_stage),
]

# The stages hold a trained classifier and byte spans, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
