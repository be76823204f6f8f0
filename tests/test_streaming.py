"""Raw files through the stream, one folder a batch."""

import json

import pytest

from tests.test_chain import record
from winnowkit.streaming import incremental


def drain(spark, home, **kw):
    q = incremental.start(spark, str(home / "in"), str(home / "out"), str(home / "state"), **kw)
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_batches_are_screened_and_repeated_ones_replace_themselves(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [record(1), record(1), record(2), record(3, objectID=""), record(4, objectID=None), record(5, is_expired=True)]
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n\n")
    drain(spark, tmp_path)
    (tmp_path / "in" / "b.jsonl").write_text(json.dumps(record(6)) + "\n")
    drain(spark, tmp_path)
    out = {p.name: spark.read.parquet(str(p)) for p in (tmp_path / "out").iterdir()}
    assert sorted(out) == ["epoch=0", "epoch=1"]
    assert sorted(r.object_id for r in out["epoch=0"].collect()) == ["", "", "o1", "o2", "o5"] and [r.object_id for r in out["epoch=1"].collect()] == ["o6"]
    assert {r.object_id: r.band for r in out["epoch=0"].collect()}["o5"] == "rejected"


def test_lines_that_are_no_objects_fail_or_are_set_aside(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text(json.dumps(record(1)) + "\n[1]\nnot json\n")
    with pytest.raises(Exception, match="not a JSON object"):
        drain(spark, tmp_path)
    drain(spark, tmp_path, bad=str(tmp_path / "bad"))
    assert [r.object_id for r in spark.read.parquet(str(tmp_path / "out" / "epoch=0")).collect()] == ["o1"]
    assert sorted(r.line for r in spark.read.json(str(tmp_path / "bad" / "epoch=0")).collect()) == ["[1]", "not json"]
