"""Versioned parts: replacing, repeating and interrupting batches of scores."""

import datetime as dt

import pytest

from dayguard.operators import evaluate
from dayguard.sources.parts import Store, content_digest

D = dt.date
SCHEMA = "CUSTOMER_ID long, GA_SESSIONS_DATE date, score double, label int"


def test_months_are_replaced_once(spark, tmp_path, monkeypatch):
    jan = spark.createDataFrame([(i, D(2024, 1, 1 + i % 9), float(i), 0) for i in range(40)], SCHEMA)
    feb = spark.createDataFrame([(i, D(2024, 2, 1 + i % 9), float(i), 0) for i in range(30)], SCHEMA)
    new = jan.where("CUSTOMER_ID < 25").selectExpr("CUSTOMER_ID", "GA_SESSIONS_DATE", "score + 100 AS score", "label")
    path = str(tmp_path)
    read = lambda: sorted(tuple(r) for r in Store.open(spark, path).read("scores", jan.schema).collect())
    rows = lambda *dfs: sorted(tuple(r) for d in dfs for r in d.collect())
    s = evaluate.store_scores(Store.open(spark, path), "jan", jan, "month")
    s = evaluate.store_scores(s, "feb", feb, "month")
    assert read() == rows(jan, feb) and s.version == 2
    assert evaluate.store_scores(s, "feb", feb.repartition(5), "month").version == 2  # again, dealt otherwise
    with pytest.raises(ValueError):
        evaluate.store_scores(s, "feb", new, "month")
    with monkeypatch.context() as m:
        m.setattr(Store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            evaluate.store_scores(s, "jan, corrected", new, "month")
    assert read() == rows(jan, feb)
    evaluate.store_scores(Store.open(spark, path), "jan, corrected", new, "month")
    assert read() == rows(new, feb)
    assert Store.open(spark, path).read("scores", jan.schema, ["2024-02-01"]).count() == 30


def test_digest_follows_content_only(spark):
    a = spark.createDataFrame([(1, D(2024, 1, 1), 1.0, 0), (2, None, None, 1)], SCHEMA)
    assert content_digest(a) == content_digest(a.repartition(3))
    assert content_digest(a) != content_digest(a.union(a)) != content_digest(a.limit(1))
    assert content_digest(a.where("false")) == "0-0-0"
