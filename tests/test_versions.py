import os

import pytest
from pyspark.sql import functions as F

from corpuskiln.operators import ledger
from corpuskiln.sources import versions


def batch(spark, rows):
    return spark.createDataFrame([(s, "t", d, r, i) for i, (s, d, r) in enumerate(rows)], "source string, target string, domain string, reason string, no int")


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_a_stored_ledger_equals_one_in_memory(spark, tmp_path):
    root = str(tmp_path / "ledger")
    first = [(f"w{i % 40}", "d", "r" if i % 3 else "") for i in range(100)]
    second = [("W1", "D", "new"), ("straße", "d", ""), ("STRASSE", "D", "x"), ("w2", "other", "")]
    days = [F.lit(f"2024-01-0{n}").cast("timestamp") for n in (1, 2)]
    assert ledger.upsert_stored(root, batch(spark, first), days[0], 1, 16)
    before = files(root)
    touched = ledger.upsert_stored(root, batch(spark, second), days[1], 2, 16)
    assert 0 < len(touched) < 16 and {k: v for k, v in files(root).items() if k in before} == before
    plain = ledger.upsert(ledger.upsert(spark.createDataFrame([], ledger.LEDGER), batch(spark, first), days[0]), batch(spark, second), days[1])
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(ledger.read_stored(spark, root).select(plain.columns)) == key(plain)
    seen = files(root)
    assert ledger.upsert_stored(root, batch(spark, second), days[1], 2, 16) == [] and files(root) == seen  # counted in already
    assert ledger.upsert_stored(root, batch(spark, []), days[1], 3, 16) == [] and versions.state(root)["version"] == 2


def test_a_run_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "v")
    rows = spark.range(5).selectExpr("id")
    assert versions.read(spark, root, "id long").count() == 0
    assert versions.publish(rows, root, 1) and not versions.publish(rows, root, 1) and not versions.publish(rows, root, 0)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(versions, "switch", broken)
        versions.publish(spark.range(9), root, 2)
    assert versions.read(spark, root, "id long").count() == 5 and versions.state(root)["version"] == 1
    assert versions.publish(spark.range(9), root, 2) and versions.read(spark, root, "id long").count() == 9
