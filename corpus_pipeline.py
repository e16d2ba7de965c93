"""Corpus pipeline: quality rules, exact and near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame, which ``run`` writes as Parquet and reads again for
the next one. A stage's scratch tables are dropped when the next one starts, unless its
docs still read them. All but the last return the columns of ``documents``.

Each row gets a verdict of its own: doc_id may be null or stand in several rows.
The dedup stages number the rows for it, and keep one row of each group. Null, empty and short texts
go at the first stage; very long texts are judged, compared, redacted and packed whole; an empty table
gives no pieces; further columns of documents go along, whatever their names.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

#: Near duplicates: least Jaccard similarity, in per cent, of five-word shingle sets.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base counts and the distribution rules keep."""
    from tripmart.llm.quality_rules import quality_rules as judge

    return judge(docs, carry=tuple(docs.columns)).where("kept").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row with the largest doc_id (a null doc_id is smaller than any other)."""
    from pyspark.sql import functions as F

    from tripmart.llm.exact_dedup import exact_dedup as judge

    rows, row = _numbered(docs, "exact_rows")
    stay = judge(rows, carry=(row,)).where("kept").groupBy("text_sha256").agg(F.min(row).alias(row))
    return _staying(rows, stay, row)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, one with the smallest doc_id (a null doc_id is larger than any other)."""
    from pyspark.sql import functions as F

    from tripmart.llm.minhash_dedup import near_dedup as judge

    rows, row = _numbered(docs, "near_rows")
    # documents are told apart by the row's number, so texts that share a doc_id are compared too
    judged = judge(rows.select(F.col(row).alias("doc_id"), "text"), percent=NEAR_PERCENT).select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col(row).alias(row))
    stay = judged.join(rows.select(row, "doc_id"), row).groupBy("component_id").agg(F.min(order).alias("first")).select(f"first.{row}")
    return _staying(rows, stay, row)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars counts the new text."""
    from pyspark.sql import functions as F

    from tripmart.llm.pii_crf import redact

    out = redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens."""
    import public_tokenizers

    from tripmart.llm.packing import pack

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


#: Scratch folders of the stage before: its result has been written when the next stage starts.
_LEFT: list[str] = []


def _stage(work):
    """The stage, after dropping what the stage before left in scratch tables and docs does not read."""

    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        from tripmart.llm.common import collected_scratch, drop_scratch

        _LEFT[:] = drop_scratch(spark, _LEFT, docs)
        with collected_scratch() as made:
            out = work(spark, docs, sf_dir)
        _LEFT.extend(made)
        return out

    return run_stage


STAGES = [
    ("quality_rules", _stage(quality_rules)),
    ("exact_dedup", _stage(exact_dedup)),
    ("minhash_dedup", _stage(near_dedup)),
    ("pii", _stage(redact_pii)),
    ("packing", _stage(packing)),
]

#: SQL can't express the random field, the signature join and the tokenizer; tests/llm holds brute-force versions.
ORACLE_SQL = None


def _numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """docs with a number of its own for each row, written so that it stays the same, and that column's name, which docs lacks."""
    from pyspark.sql import functions as F

    from tripmart.llm.common import stored

    row = "_row"
    while row in map(str.lower, docs.columns):
        row += "_"
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def _staying(rows: DataFrame, stay: DataFrame, row: str) -> DataFrame:
    """The numbered rows whose number is in ``stay``, without it."""
    return rows.join(stay, row, "left_semi").drop(row)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written to the shared folder."""
    from tripmart.llm.common import collected_scratch, drop_scratch, read_table, stored

    _LEFT.clear()  # what others called the stages for is theirs
    docs, before = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with collected_scratch() as written:
            docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
        before = drop_scratch(spark, before, docs) + written
    out = STAGES[-1][1](spark, docs, sf_dir)
    _LEFT.clear()  # what the result reads stays
    return out
