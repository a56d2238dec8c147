"""A training corpus from the documents table: the stages, and the run over all of them.

Every stage reads what its predecessor kept as a stored table and, but for the last, returns its columns.

Defined cases, for every stage: an empty table gives an empty one; null and empty texts are scored by the model without words, have no
copies, passages or secrets, stay as they are, and have no tokens; further columns, also null ones, keep their values,
whatever their names, but for ``n_chars``, which follows the text; repeated rows are copies, of which one stays.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmark.llm import decontaminate, ngram_join, pieces, secrets, toxicity
from haulmark.llm.common import packed, read, stage, unpacked
from haulmark.llm.queries import piece_model


def drop_toxic(spark, docs, sf_dir):
    """Documents that the toxicity model rejects go. A null text is scored as an empty one."""
    labels = read(spark, sf_dir, "labels", "doc_id", "toxic")
    return unpacked(toxicity.toxicity(packed(docs), labels).filter("predicted = 0"), docs.columns)


def drop_near_copies(spark, docs, sf_dir):
    """Of rows linked by five-word shingles with a similarity of 0.8 or more, the first by doc_id stays, rows without id
    last; of rows with one id, one. Rows without words stay."""
    numbered = stage(packed(docs).withColumn("corpus_row", F.monotonically_increasing_id()), "corpus-rows")
    rows, labels = ngram_join.join(numbered.select(F.col("corpus_row").alias("doc_id"), "text"), width=5, percent=80)
    placed = stage(rows.filter("n > 0").join(labels, "node", "left")
                   .select(F.col("doc_id").alias("corpus_row"), F.coalesce("component", "node").alias("component"))
                   .join(numbered.select("corpus_row", "doc_id"), "corpus_row"), "corpus-components")
    first = (placed.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "corpus_row")).alias("first"))
             .select("first.corpus_row"))
    copies = placed.join(first, "corpus_row", "left_anti").select("corpus_row")
    return unpacked(numbered.join(copies, "corpus_row", "left_anti"), docs.columns)


def cut_benchmark(spark, docs, sf_dir):
    """Passages of benchmark items are cut out of the texts."""
    return _counted(decontaminate.remove(docs, read(spark, sf_dir, "benchmark", "item_id", "text")))


def mask_secrets(spark, docs, sf_dir):
    """Secrets in the texts are masked."""
    return _counted(secrets.redact(docs))


def encode(spark, docs, sf_dir):
    """Token ids of each text."""
    return pieces.encode(docs.select("doc_id", "text"), piece_model()).drop("text")


def _counted(docs):
    """``n_chars``, where there is one, follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_copies), ("decontamination", cut_benchmark),
          ("secrets", mask_secrets), ("pieces", encode)]

ORACLE_SQL = None  # the model, the index and the search of the stages cannot be said in SQL


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
