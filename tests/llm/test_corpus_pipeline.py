"""The corpus pipeline, stage by stage, on a small corpus."""

import random

import pytest

import corpus_pipeline as C
from tests_llm_data import corpus


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("corpus"))
    docs, labels = corpus(random.Random(1))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        kept.append({r["doc_id"] for r in docs.collect()} - {None})
    toxic, quality, near, personal = kept
    assert not any(500 <= i < 600 for i in toxic) and all(i in toxic for i in range(300))
    assert 600 not in quality and 601 not in quality and 602 not in quality
    assert all(i in quality for i in range(300))
    assert {i for i in near if 700 <= i < 720} == {700} and all(i in near for i in range(300))
    assert personal == near
    text = docs.where("doc_id = 7").first()
    assert "<EMAIL>" in text["text"] and "@" not in text["text"] and text["n_chars"] == len(text["text"])


def test_run_packs_what_is_kept(spark, folder):
    rows = C.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} >= set(range(300))
    assert len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows)


def test_empty(spark, folder, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_repeated_and_missing_ids_are_judged_by_their_texts(spark, folder):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghilmnop") for _ in range(6))
    text = lambda: " ".join(word() for _ in range(80))
    a, b, c, d = text(), text(), text(), text()
    rows = [(1, a, "x"), (5, a, "x"), (5, b, "x"), (5, c, "x"), (5, c, "w"), (None, d, "x"), (None, d, "x"), (None, b + " tail", "x"), (9, text(), "x")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t), 1, 2, 3) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, _row int, tox int, _q int")
    kept = [(x["doc_id"], x["text"], x["source"]) for x in C.one_of_each_group(spark, docs, folder).collect()]
    assert sorted(t for _, t, _ in kept if t not in (b, b + " tail")) == sorted([a, c, d, rows[-1][1]])
    assert sum(t in (b, b + " tail") for _, t, _ in kept) == 1
    assert len([k for k in kept if k[1] == a]) == 1 and (5, c, "w") in kept
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_a_task_that_redacts_has_one_python_worker(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    monkeypatch.setattr(C.pii, "fit", lambda docs: None)
    new = C.redact_personal(spark, docs, folder)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # a second one is a second worker in the same task
    by_columns = docs.withColumn("red", C.pii.redacted(C.F.col("text"), C.pii.spans_column(C.F.col("text"), None)))
    want = {(r["doc_id"], r["red"]) for r in by_columns.collect()}
    assert {(r["doc_id"], r["text"]) for r in new.collect()} == want and any("<EMAIL>" in (t or "") for _, t in want)
