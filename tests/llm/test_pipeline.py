from __future__ import annotations

import hashlib
import random

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.edges import TEXTS, documents, no_documents
from touchline.llm import decontaminate, near_dups, pii, quality
from touchline.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labels, a benchmark and documents with planted rows."""
    random.seed(11)
    letters = lambda: "".join(random.choice("aeinrst") for _ in range(random.randint(2, 8)))
    item = " ".join(letters() + str(i) for i in range(40))
    texts, labels = list(TEXTS), []
    for i in range(100, 260):
        words = [letters() for _ in range(random.randint(30, 60))]
        bad = i % 4 == 0
        texts.append((i, " ".join(w + "###" if bad else w for w in words)))
        labels.append((i, 0 if bad else 1, 0))
    texts.append((300, dict(texts)[101]))
    texts.append((301, dict(texts)[102] + " more"))
    texts.append((302, item))
    texts.append((303, dict(texts)[103] + " Mail me.too@example.org."))
    path = str(tmp_path_factory.mktemp("tables"))
    documents(spark, texts).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = near_dups.written(stage(spark, docs, folder), name)
        assert new.columns == docs.columns, name
        kept[name] = (docs, new)
        docs = new
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}

    before, after = kept["quality"]
    model = quality.train(before, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = quality.score(before.select("doc_id", "text"), model).collect()
    assert sorted(map(str, [r["doc_id"] for r in after.collect()])) == sorted(str(r["doc_id"]) for r in scores if r["score"] >= 0.7)
    assert not {i for i in range(100, 260) if i % 4 == 0} & ids(after)
    assert {i for i in range(100, 260) if i % 4} <= ids(after)

    before, after = kept["near_dups"]
    assert ids(before) - ids(after) <= {300, 301, 303, 5, 6, 7, None, *ids(before)} and {300, 301} & ids(after) == set()
    assert len({r["class_id"] for r in near_dups.classes(before).collect()}) == after.count()

    before, after = kept["decontamination"]
    assert ids(before) - ids(after) == {302}

    before, after = kept["personal_data"]
    assert ids(before) == ids(after)
    found = {r["doc_id"]: r for r in after.collect()}
    assert all(not pii.base_spans(r["text"] or "") for r in found.values())
    assert all(r["n_chars"] == len(r["text"]) for r in found.values() if r["text"] is not None)


def test_run_gives_the_token_ids_of_what_is_left(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = near_dups.written(stage(spark, docs, folder), name)
    library = Tokenizer.from_file(VOCABULARY)
    want = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((r["doc_id"], len(ids), ids, digest(",".join(map(str, ids))), digest(r["text"] or "")))
    assert sorted(map(repr, map(tuple, corpus_pipeline.run(spark, folder).collect()))) == sorted(map(repr, want))


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path)
    no_documents(spark).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []
    assert corpus_pipeline.good_quality(spark, documents(spark), path).count() == len(TEXTS)
    assert decontaminate.report(documents(spark), spark.read.parquet(f"{path}/benchmark.parquet")).count() == len(TEXTS)
