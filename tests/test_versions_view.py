"""The stored versions: what is kept, what readers make of it, how it is written."""

import glob
import os
import re

from pyspark.sql import functions as F

from normalake.operators import provisions, quality
from normalake.plans import norm_versions as view
from normalake.plans import registry
from normalake.schema import VERSIONS
from normalake.sources import files, publish

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_texts_and_digests_are_made_from_the_stored_columns(spark):
    v = view.norm_versions(spark, SF)
    assert [(f.name, f.dataType) for f in v.schema] == [(f.name, f.dataType) for f in VERSIONS]
    stored = spark.read.parquet(v.inputFiles()[0].rpartition("/")[0])
    assert not {"texto", "texto_normalizado", "hash_texto", "fontes", "versao_id", "urn_dispositivo"} & set(stored.columns)
    # a norm's rows lie side by side, and a look-up by norm reaches the scan
    rows = stored.where(F.input_file_name() == v.inputFiles()[0]).select("lei_id").collect()
    changes = sum(a.lei_id != b.lei_id for a, b in zip(rows, rows[1:]))
    assert changes == len({r.lei_id for r in rows}) - 1
    assert "EqualTo(lei_id,norm-00042)" in v.where("lei_id = 'norm-00042'")._jdf.queryExecution().executedPlan().toString()


def test_versions_are_made_by_tasks_of_bounded_size(spark, monkeypatch):
    """More line items are more tasks, not larger ones that spill; one sort serves both windows."""
    few = view._kept(spark, SF)
    monkeypatch.setattr(view, "ROWS_OF_A_TASK", 500, raising=False)
    many = view._kept(spark, SF)
    rows = [r["count"] for r in many.groupBy(F.spark_partition_id()).count().collect()]
    assert len(rows) > 4 and max(rows) < 3 * 500
    assert many.count() == few.count() and many.exceptAll(few).count() == 0
    assert many._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1


def test_versions_are_shuffled_once_with_suppliers_too_large_to_broadcast(spark, monkeypatch):
    """Suppliers are joined by norm, so versions are not shuffled again and a norm's rows stay together."""
    expected = view._kept(spark, SF)
    rows = expected.count()
    monkeypatch.setattr(view, "ROWS_OF_A_TASK", 500)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "50"}
    before = {k: spark.conf.get(k) for k in settings}
    for k in settings:
        spark.conf.set(k, settings[k])
    try:
        v = view._kept(spark, SF)
        assert "Exchange" not in v._jdf.queryExecution().executedPlan().toString().split("Window [")[0]
        norms = [r.lei_id for r in v.collect()]
        found = v.count(), v.exceptAll(expected).count()
    finally:
        for k in before:
            spark.conf.set(k, before[k])
    changes = sum(a != b for a, b in zip(norms, norms[1:]))
    assert changes == len(set(norms)) - 1
    assert found == (rows, 0)


def test_versions_as_json_and_csv_are_small_files(spark, tmp_path):
    v = view.norm_versions(spark, SF)
    publish.write_json(v, str(tmp_path / "json"))
    publish.write_csv(v, str(tmp_path / "csv"), "gzip")
    assert all(glob.glob(str(tmp_path / k / "*.gz")) and not glob.glob(str(tmp_path / k / f"*.{k}")) for k in ("json", "csv"))
    back = files.versions_json(spark, str(tmp_path / "json"))
    assert back.exceptAll(v).count() == 0 and back.count() == v.count()


def test_no_fixed_number_of_files():
    """A task's share of a large table would grow with it."""
    from inspect import getsource

    assert "files=" not in getsource(registry.queries()["snk1_write_versions"])


def test_history_keeps_ids_only(spark):
    plan = provisions.history(view.norm_versions(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    collected = plan.split("collect_list(")[1].split(")", 1)[0]
    assert not re.search(r"\b(?:ate|em)#\d+ AS", collected) and not re.search(r"\bate#", collected)


def test_each_pair_of_paths_is_judged_once(spark):
    rows = [("a", "art-1", None), ("a", "zz", None), ("b", "zz", None), ("b", "zz", None), ("b", "art-2-par-1", "art-2"), ("c", "art-9-par-1", "art-2"), ("c", "tit-1", "art-2"), ("c", None, None)]
    df = spark.createDataFrame(rows, "lei_id string, dispositivo_path string, dispositivo_parent_path string")
    found = sorted((r.file, r.message or "") for r in quality.paths(df).collect())
    assert found == [("a", "zz: unknown path"), ("b", "zz: unknown path"), ("c", ""), ("c", "art-9-par-1: not under its parent"), ("c", "tit-1: organising under normative")]
