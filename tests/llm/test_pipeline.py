"""The whole pipeline against the operators' plain rules on small made-up documents."""

import corpus_pipeline
from loomhouse.llm.queries import QUERIES, SQL


def test_stages_on_planted_documents(spark, tmp_path):
    toxic = {i: (i % 4 == 1) for i in range(240)}
    docs = [(i, " ".join(f"w{(i * 7919 + k * k * 31) % 5003}" for k in range(30))
             + (" idiot moron" if toxic[i] else ""), "en", f"s{i % 2}", None) for i in range(240)]
    docs.append((900, docs[0][1] + " end", "en", "s0", 5))        # near copy of 0
    passage = " ".join(f"p{k}" for k in range(60))
    docs += [(i, passage + "\n" + " ".join(f"q{i}x{k}" for k in range(80)), "en", "s1", None)
             for i in (910, 911)]
    docs += [(950, None, "en", None, None)]
    frame = spark.createDataFrame(
        docs, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, int(t)) for i, t in toxic.items()],
                                   "doc_id long, quality int, toxic int")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = frame
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, kept, str(tmp_path)).cache()
        assert kept.columns == frame.columns, name
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert set(texts) == {i for i, t in toxic.items() if not t} | {910, 911, 950}
    assert texts[911] == " ".join(f"q911x{k}" for k in range(80))
    assert texts[910].startswith("p0 ")
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(texts)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "ngram_jaccard_join", "substring_dedup", "best_fit_packing"]


def test_one_of_each_class_stays_without_ids(spark):
    def text(k, last):
        return " ".join(f"{k}x{i}" for i in range(100)) + f" {last}"

    docs = [(None, text(0, "a")), (None, text(0, "b")), (None, text(0, "b")), (None, text(1, "a")),
            (5, text(1, "b")), (6, text(2, "a")), (6, text(3, "a")), (7, text(3, "b"))]
    kept = corpus_pipeline.drop_near_copies(
        spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    assert kept.columns == ["doc_id", "text"]
    found = sorted((r["doc_id"] or -1, r["text"].split()[0]) for r in kept.collect())
    assert found == [(-1, "0x0"), (-1, "1x0"), (6, "2x0"), (6, "3x0")]


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(SQL) <= set(QUERIES)
