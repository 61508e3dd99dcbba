"""The driver may load ``__spark_entry__.py`` by path from any directory:
the package must still import, and Python workers must not need it."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

from tests.conftest import ROOT, SF0001

SCRIPT = textwrap.dedent(f"""
    import importlib.util
    from pyspark.sql import SparkSession
    spec = importlib.util.spec_from_file_location("entrymod", {os.path.join(ROOT, "__spark_entry__.py")!r})
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    print("entry", len(m.entry(spark).collect()))
    print("udf", m.queries()["ordinal_encode_udf"](spark, {SF0001!r}).count())
""")


def test_entry_loads_by_path_from_another_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "entry 5" in out.stdout, out.stderr[-2000:]
    assert "udf " in out.stdout and int(out.stdout.split("udf ")[1].split()[0]) > 0
