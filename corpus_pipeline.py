"""A training corpus from raw documents: toxic ones go, boilerplate lines go, one of each
class of near duplicates stays, repeated passages go, and what is left is packed.

Every stage works on all its predecessor kept and, but for the last, returns the columns of
documents. Rows and cases: as the operators define them. A text that a stage changes has its
`n_chars` counted anew; a document stays when nothing of its text is left. Other columns travel
as one, so that none of them meets a stage's own columns, whatever its name; they come out
unchanged. An empty table gives an empty result; documents without labels are all clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomhouse.llm.common import keyed, named, table
from loomhouse.llm.jaccard_join import similar_rows
from loomhouse.llm.line_dedup import drop_boilerplate
from loomhouse.llm.packing import pack, token_pieces
from loomhouse.llm.substring_dedup import drop_repeated_passages
from loomhouse.llm.toxicity import learn_lexicon, score_toxicity
from loomhouse.sources.staging import stage


def _packed(docs: DataFrame, *used: str) -> DataFrame:
    """The columns that a stage reads, and all others as one."""
    others = [named(c) for c in docs.columns if c not in used]
    return docs.select(*used, *([F.struct(*others).alias("others")] if others else []))


def _unpacked(done: DataFrame, docs: DataFrame, used: tuple[str, ...], changed=None) -> DataFrame:
    """The columns of documents, with the characters of changed texts counted."""
    columns = []
    for field in docs.schema.fields:
        value = F.col(field.name) if field.name in used else F.col("others").getField(field.name)
        if field.name == "n_chars" and changed is not None:
            value = F.when(changed, F.length("text").cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return done.select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    used = ("doc_id", "text")
    lexicon = learn_lexicon(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(_packed(docs, *used), lexicon)
    return _unpacked(scored.filter("predicted = 0"), docs, used)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    used = ("doc_id", "source", "text")
    return _unpacked(drop_boilerplate(_packed(docs, *used)), docs, used, F.col("n_dropped") > 0)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class stays; where doc_ids are missing or
    repeat, the one of them with the least text hash, and one of several equal ones."""
    stays = (similar_rows(docs).filter("doc = class_doc AND text_id = class_text")
             .select("doc", "text_id").distinct())
    return (keyed(docs).join(stays, ["doc", "text_id"], "left_semi")
            .dropDuplicates(["doc", "text_id"]).select("row.*"))


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    used = ("doc_id", "text")
    changed = F.col("n_removed") > 0
    cut = drop_repeated_passages(_packed(docs, *used)).withColumn(
        "text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
    return _unpacked(cut, docs, used, changed)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(token_pieces(docs))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines),
          ("ngram_jaccard_join", drop_near_copies), ("substring_dedup", drop_passages),
          ("best_fit_packing", pack_sequences)]

#: No SQL: the toxicity model, token ids and packing cannot be expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
