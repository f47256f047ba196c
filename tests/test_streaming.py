"""Row-level checks over a file stream, one result folder per micro-batch."""

import os

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException

from veritab.operators import quality as q
from veritab.sources.schemas import CALLS_SCHEMA
from veritab.streaming import read_stream, totals, watch


def test_watch_checks_each_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("id,area,calls_made,calls_successful\n1,IT,4,3\n2,IT,1,5\n")
    (src / "b.csv").write_text("id,area,calls_made,calls_successful\n3,HR,2,2\n4,,-1,0\n")
    checks = (q.calls_successful_le_made("Employee_calls")
              + q.non_negative("Employee_calls", ["calls_made"])
              + q.non_null("Employee_calls", ["area"]))
    stream = read_stream(spark, str(src), CALLS_SCHEMA, max_files_per_trigger=1)
    results = str(tmp_path / "results")
    query = watch(stream, "Employee_calls", checks, results,
                  checkpoint=str(tmp_path / "ckpt"), trigger={"availableNow": True})
    query.awaitTermination(120)
    assert len([d for d in os.listdir(results) if d.startswith("batch_id=")]) == 2
    got = {r["check_name"]: (r["total"], r["violations"], r["batches"])
           for r in totals(spark, results).collect()}
    # row 4 (0 successful of -1 made) breaks both numeric rules
    assert got == {"calls_successful_gt_made": (4, 2, 2), "col_non_negative": (4, 1, 2),
                   "col_non_null": (4, 1, 2)}


def test_watch_rejects_whole_table_checks(spark, tmp_path):
    stream = read_stream(spark, str(tmp_path), CALLS_SCHEMA)
    with pytest.raises(ValueError, match="col_unique"):
        watch(stream, "Employee_calls", q.unique("Employee_calls", ["id"]), str(tmp_path / "r"))


def test_restart_resumes_from_checkpoint(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    header = "id,area,calls_made,calls_successful\n"
    (src / "a.csv").write_text(header + "1,IT,4,3\n")
    checks = q.non_negative("Employee_calls", ["calls_made"])
    results, ckpt = str(tmp_path / "results"), str(tmp_path / "ckpt")

    def run_once():
        stream = read_stream(spark, str(src), CALLS_SCHEMA)
        watch(stream, "Employee_calls", checks, results, checkpoint=ckpt,
              trigger={"availableNow": True}).awaitTermination(120)

    run_once()
    run_once()  # nothing new: no batch re-run, nothing counted twice
    assert [r["total"] for r in totals(spark, results).collect()] == [1]
    (src / "b.csv").write_text(header + "2,HR,-1,0\n3,HR,1,1\n")
    run_once()  # only the new file is checked
    row = totals(spark, results).collect()[0]
    assert (row["total"], row["violations"], row["batches"]) == (3, 1, 2)


def test_totals_without_a_batch_and_of_a_wrong_path(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert totals(spark, str(tmp_path / "empty")).count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        totals(spark, str(tmp_path / "mistyped"))


def _run(spark, tmp_path, **files):
    src = tmp_path / "in"
    src.mkdir()
    for name, text in files.items():
        (src / f"{name}.csv").write_text(text)
    checks = q.readable("Employee_calls") + q.calls_successful_le_made("Employee_calls")
    stream = read_stream(spark, str(src), CALLS_SCHEMA, malformed=True)
    query = watch(stream, "Employee_calls", checks, str(tmp_path / "results"),
                  checkpoint=str(tmp_path / "ckpt"), trigger={"availableNow": True})
    query.awaitTermination(120)
    return {r["check_name"]: r["violations"] for r in totals(spark, str(tmp_path / "results")).collect()}


def test_stream_counts_unreadable_cells_and_takes_whole_decimals(spark, tmp_path):
    head = "id,area,calls_made,calls_successful\n"
    got = _run(spark, tmp_path, a=head + "1,Depot,3.0,2\n2,Depot,many,1\n3,Press,1,4\n")
    assert got == {"csv_malformed": 1, "calls_successful_gt_made": 1}


def test_stream_refuses_a_file_with_another_header(spark, tmp_path):
    with pytest.raises(StreamingQueryException, match="(?i)header"):
        _run(spark, tmp_path, a="id,area,calls_successful,calls_made\n1,Depot,2,9\n")
