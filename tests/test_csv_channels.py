"""Byte-capped exports, rejected lines and spread reads."""

import os

import pytest

from dayguard.plans.pipeline import export_job, read_feature_months
from dayguard.params import Params
from dayguard.sources import csvio
from dayguard.sources.testdata import load_inputs


def _files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".csv")]


@pytest.mark.parametrize("cap", [60, 200, 5000])
def test_no_file_over_the_cap_no_row_lost(spark, tmp_path, cap):
    rows = [(i, None if i % 5 == 0 else "é" * (i % 13), 'say "x", then\\y' if i % 11 == 0 else "plain") for i in range(500)]
    df = spark.createDataFrame(rows, "id long, a string, b string").repartition(3)
    path = csvio.write_csv(df, str(tmp_path / "out"), max_bytes_per_file=cap)
    files = _files(path)
    assert all(os.path.getsize(f) <= cap for f in files) and all(open(f).readline() == "id,a,b\n" for f in files)
    # files are filled: two of one task that follow each other would not fit into one
    total = sum(os.path.getsize(f) - len("id,a,b\n") for f in files)
    assert len(files) <= 3 + 2 * total / max(1, cap - 7)
    back = csvio.read_csv(spark, path, df.schema)
    want = {(i, None if a is None or a == "" else a, b) for i, a, b in rows}
    assert {(r[0], r[1] or None, r[2]) for r in back.collect()} == want


def test_a_row_over_the_cap_is_a_file_alone(spark, tmp_path):
    df = spark.createDataFrame([(1, "x" * 300), (2, "y"), (3, "z" * 300)], "id long, a string").coalesce(1)
    files = _files(csvio.write_csv(df, str(tmp_path / "out"), max_bytes_per_file=100))
    assert sorted(len(open(f).readlines()) for f in files) == [2, 2, 2]


def test_export_job_by_month_and_bytes(spark, tmp_path):
    inp, p = load_inputs(spark, "/root/testdata/sf0.001"), Params.testdata()
    out = export_job(inp, p, str(tmp_path), max_bytes_per_file=10_000)
    files = _files(out["features"])
    assert len(files) > 1 and all(os.path.getsize(f) <= 10_000 for f in files)
    assert read_feature_months(spark, out["features"], ["2024-01"]).count() == 258


def test_rejects(spark, tmp_path):
    lines = ["order_id\tcustomer_id", "1\t10", "2", "3\t30\textra\tmore", "x\t40", "5\tNaN", "\t60", "7\t7.5", "8\t80"]
    (tmp_path / "a.tsv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.tsv").write_text("order_id\tcustomer_id\n9\t90\n10\t\n")
    rows, rejects = csvio.read_with_rejects(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")], csvio.ATO_LABEL_SCHEMA,
                                            required=("order_id",))
    kept = {tuple(r) for r in rows.collect()}
    assert kept == {(1, 10), (2, None), (3, 30), (5, None), (8, 80), (9, 90), (10, None)}
    said = {(os.path.basename(r["file"]), r["record"], r["reason"], r["action"]) for r in rejects.collect()}
    assert said == {("a.tsv", "2", "missing fields", "mended"), ("a.tsv", "3\t30\textra\tmore", "extra fields", "mended"),
                    ("a.tsv", "x\t40", "bad value", "dropped"), ("a.tsv", "7\t7.5", "bad value", "dropped"),
                    ("a.tsv", "\t60", "no order_id", "dropped")}
    dropped = sum(x[3] == "dropped" for x in said)
    assert len(kept) + dropped == 8 + 2


def test_gzip_rows_are_spread(spark, tmp_path):
    df = spark.range(0, 1000).selectExpr("id AS order_id", "id AS customer_id")
    path = csvio.write_csv(df.coalesce(1), str(tmp_path / "z"), compression="gzip")
    got = csvio.read_csv(spark, path, csvio.ATO_LABEL_SCHEMA, spread=True)
    assert got.count() == 1000
    assert "RoundRobin" in got._jdf.queryExecution().executedPlan().toString() or "REBALANCE" in got._jdf.queryExecution().executedPlan().toString()
