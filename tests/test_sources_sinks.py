"""Sources and sinks: round trips, the output-exists rule, CSV reading styles."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from sparkdeck.session import shared_dir
from sparkdeck.sources.csv import read_csv_inferred, read_csv_named, read_csv_strings
from sparkdeck.sources.sinks import read_kv_text, write_csv, write_kv_text, write_text_values
from sparkdeck.sources.text import read_lines


def test_value_sink_roundtrip_and_existing_output_is_an_error(spark, lines):
    path = shared_dir(spark, "t-values")
    write_text_values(lines(["a", " b\t", ""]), path)
    assert sorted(r.value for r in read_lines(spark, path).collect()) == ["", " b\t", "a"]
    with pytest.raises(AnalysisException):
        write_text_values(lines(["c"]), path)  # Hadoop default: output dir must not exist
    write_text_values(lines(["c"]), path, mode="overwrite")
    assert [r.value for r in read_lines(spark, path).collect()] == ["c"]


def test_kv_text_roundtrip(spark):
    df = spark.createDataFrame([(1, "4.0", 3), (2, "3.0", 2)], "item_id int, avg string, n int")
    path = shared_dir(spark, "t-kv")
    write_kv_text(df, path, "item_id", ["avg", "n"])
    got = {r.item_id: r.stats for r in read_kv_text(spark, path, "item_id int, stats string").collect()}
    assert got == {1: "4.0,3", 2: "3.0,2"}


def test_shared_dir_is_under_checkpoint_dir(spark):
    path = shared_dir(spark, "x")
    base = spark.sparkContext.getCheckpointDir()
    assert base and path.startswith(base.rstrip("/") + "/sparkdeck/x-")


def test_csv_styles(spark):
    df = spark.createDataFrame([(1, "x", 2.5), (2, "y", None)], "a int, b string, c double")
    p1, p2 = shared_dir(spark, "t-csv1"), shared_dir(spark, "t-csv2")
    write_csv(df, p1, header=True)
    s = read_csv_strings(spark, p1)
    assert dict(s.dtypes) == {"a": "string", "b": "string", "c": "string"}
    inferred = read_csv_inferred(spark, p1)
    assert dict(inferred.dtypes) == {"a": "int", "b": "string", "c": "double"}
    write_csv(df, p2, header=False)
    named = read_csv_named(spark, p2, ["id", "name", "score"])
    assert named.columns == ["id", "name", "score"] and named.count() == 2
    with pytest.raises(ValueError):
        read_csv_named(spark, p2, ["only", "two"])


def test_kv_read_back_fails_on_bad_numbers_or_drops_them(spark, tmp_path):
    path = str(tmp_path / "kv")
    spark.createDataFrame([("a\t1",), ("\t2",), ("b\tx",), ("c\t3\t4",)], "value string").write.text(path)
    with pytest.raises(Exception):
        read_kv_text(spark, path, "k string, v int").collect()
    kept = {tuple(r) for r in read_kv_text(spark, path, "k string, v int", on_bad="skip").collect()}
    assert kept == {("a", 1), ("", 2)}
    assert ("c", "3\t4") in {tuple(r) for r in read_kv_text(spark, path, "k string, v string").collect()}


def test_no_made_up_folder_off_a_local_master(monkeypatch):
    from types import SimpleNamespace

    from sparkdeck.session import ensure_checkpoint_dir

    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                           sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(fake)
