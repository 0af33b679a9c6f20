"""A corpus pipeline of five operators: each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm import minhash, mixing, packing, suffixes, toxicity
from curata.llm.common import table
from curata.storage import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagged spans make toxic go.

    A null text counts as empty, and like every text without a toxic token it
    stays; repeated rows share their fate.  Columns of any name are kept but
    ``score``, ``predicted`` and ``spans``; an empty table stays empty.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, with_spans=False, keep="clean").select(*[f"`{c}`" for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles tie together the one with the smallest doc_id stays.

    Rows with one doc_id are one document: they stay or go together, and of
    those that also share the text one stays, the smallest by a hash of the
    other columns.  Null ids and texts without words are nobody's copies and
    stay.  Columns of any name are kept; an empty table stays empty.
    """
    kept = minhash.near_duplicates(docs, words_each=5, percent=80).where("kept and doc_id is not null")
    kept = kept.groupBy("doc_id").agg(F.count("*").alias("__rows"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    stay = docs.select(F.col("doc_id").alias("__id"), row).join(kept.withColumnRenamed("doc_id", "__id"), "__id")
    hashed = F.xxhash64(*[F.col(f"row.`{f.name}`") for f in docs.schema.fields if "map" not in f.dataType.simpleString()])
    several = stay.where("__rows > 1").groupBy("__id", F.col("row.text")).agg(F.min_by("row", hashed).alias("row"))
    rows = stay.where("__rows = 1").select("row").unionAll(several.select("row")).unionAll(docs.where("doc_id is null").select(row))
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes that a document with a smaller doc_id has are cut out, whole characters only; every row stays.

    A null text stays null, and a null doc_id neither loses nor gives anything.
    Rows with one doc_id do not cut one another.  ``n_chars`` follows the text
    where there is such a column; columns of any other name are kept.
    """
    out = suffixes.remove_repeats(docs, carry=True, characters=True)
    text = F.when(F.col("row.__had"), F.col("kept").cast("string"))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"}
    columns |= {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length(F.col("kept").cast("string")).cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return out.select(*[columns[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares, in training order; copies are rows.

    A null source is a source; documents without words, null texts among them,
    stay once; null and repeated doc_ids are ordinary.  Columns of any name are
    kept; an empty table stays empty.
    """
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences with their token ids; a null text is empty, null and repeated doc_ids are carried through."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mix_sources", mix_sources),
    ("pack", pack_windows),
]

#: The stages train models and tokenise, so SQL cannot express their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
