import zlib

import __spark_entry__
import corpus_pipeline
from logloom.llm import decontam, packing, registry

from .conftest import prose


def write_tables(spark, folder):
    passage, leak = prose(470, 60), prose(471, 30)
    rows, labels = [], []
    for i in range(150):
        words = prose(i, 80).split()
        if i % 5 == 0 and i < 140:
            for k in (5, 15, 25, 35):
                words[k] = "snarfing"
        rows.append((i, " ".join(words), "en", "s", 1))
        if i < 140:
            labels.append((i, 0, int(i % 5 == 0)))
    rows += [(200, prose(1, 80), "en", "s", 1), (201, f"{prose(301, 20)} {passage}", "en", "s", 1), (202, f"{prose(302, 20)} {passage} {prose(303, 20)}", "en", "s", 1)]
    rows += [(203, f"{prose(304, 20)} {leak.upper()} {prose(305, 20)}", "en", "s", 1), (204, None, None, None, None), (205, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, leak), (2, prose(472, 30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return passage, leak


def test_stages_and_their_decisions(spark, tmp_path):
    passage, leak = write_tables(spark, str(tmp_path))
    docs = registry.table(spark, str(tmp_path), "documents")
    columns, texts = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        out = f"{tmp_path}/{name}"
        docs.write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.columns == columns
        texts[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean = {i for i in range(150) if i % 5}
    assert clean | {200, 201, 202, 203, 204, 205} <= set(texts["toxicity"]) and len([i for i in texts["toxicity"] if i < 150 and i % 5 == 0]) <= 12
    assert set(texts["toxicity"]) - set(texts["near_duplicates"]) == {200}
    assert passage in texts["substring_dedup"][201] and passage not in texts["substring_dedup"][202]
    assert leak.upper() not in texts["decontamination"][203] and decontam.normalised(leak) not in decontam.normalised(texts["decontamination"][203])
    assert clean <= set(texts["decontamination"]) and all(texts["decontamination"][i] == prose(i, 80) for i in clean)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(texts["decontamination"])
    assert {(r["doc_id"], r["ids_crc32"]) for r in packed if r["doc_id"] == 205} == {(205, zlib.crc32((packing.END_OF_DOCUMENT).to_bytes(4, "little")))}
    whole = corpus_pipeline.run(spark, str(tmp_path))
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(key).collect())) == sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packed)


def test_every_query_is_registered():
    names = set(__spark_entry__.queries())
    assert {"pipeline"} <= names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= names
