"""Further columns of documents, whatever their names, beside every operator and the pipeline."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from loomhouse.llm.exact_dedup import exact_groups
from loomhouse.llm.jaccard_join import similar_classes
from loomhouse.llm.line_dedup import drop_boilerplate
from loomhouse.llm.packing import pack, token_pieces
from loomhouse.llm.quality import judge_quality, learn_classifier
from loomhouse.llm.sentencepiece_codec import encode_decode
from loomhouse.llm.substring_dedup import drop_repeated_passages
from loomhouse.llm.suffix_dedup import drop_repeated_strings
from loomhouse.llm.toxicity import learn_lexicon, score_toxicity

NAMES = ["label", "labelled", "fit", "Score", "predicted", "N_LINES", "n_dropped", "N_words",
         "n_removed", "kept_text", "kept", "n_bytes", "ids", "_doc", "_text", "spans", "row", "doc",
         "text_id", "others", "path", "rep", "slice", "length", "place", "keep_id", "n", "a.b",
         "_host", "class_id"]
OPERATORS = {
    "lines": lambda d, l: drop_boilerplate(d), "exact": lambda d, l: exact_groups(d),
    "passages": lambda d, l: drop_repeated_passages(d),
    "strings": lambda d, l: drop_repeated_strings(d), "pack": lambda d, l: pack(token_pieces(d)),
    "toxicity": lambda d, l: score_toxicity(d, learn_lexicon(d, l)),
    "pieces": lambda d, l: encode_decode(d), "similar": lambda d, l: similar_classes(d),
    "quality": lambda d, l: judge_quality(d, learn_classifier(d, l))}


@pytest.fixture(scope="module")
def crowded(spark, tmp_path_factory):
    """Documents with columns named like those that the operators use inside, ties, repeated rows,
    missing and long texts; and their labels."""
    folder = str(tmp_path_factory.mktemp("crowded"))
    texts = [" ".join(f"w{(i * 31 + k * k) % 97}" for k in range(40)) for i in range(30)]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    rows += [(3, texts[3], "s"), (3, texts[3], "s"), (40, None, None), (None, "", "s"),
             (41, "long " * 40_000, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.select("*", *[F.lit(f"own {c}").alias(c) for c in NAMES])
    docs.write.parquet(f"{folder}/documents.parquet")
    (docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"),
                 (F.col("doc_id") % 3 > 0).cast("int").alias("quality"))
     .write.parquet(f"{folder}/labels.parquet"))
    return folder, len(rows)


@pytest.mark.parametrize("name", OPERATORS)
def test_operators(spark, crowded, name):
    folder, rows = crowded
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = OPERATORS[name](docs, labels)
    assert len({c.lower() for c in found.columns}) == len(found.columns)
    held = found.collect()
    assert len(held) >= rows
    if "label" in found.columns:
        assert {r["label"] for r in held} == {"own label"}
    none = OPERATORS[name](docs.limit(0), labels)
    assert none.columns == found.columns and none.count() == 0


def test_pipeline(spark, crowded):
    folder, _ = crowded
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, kept, folder)
        assert kept.schema.names == docs.schema.names, name
    held = kept.select([F.col(f"`{c}`") for c in NAMES]).collect()
    assert held and all(r[c] == f"own {c}" for r in held for c in NAMES)
    packed = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in kept.collect()}


def test_pipeline_of_nothing(spark, crowded, tmp_path):
    for t in ("documents", "labels"):
        (spark.read.parquet(f"{crowded[0]}/{t}.parquet").limit(0)
         .write.parquet(f"{tmp_path}/{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
