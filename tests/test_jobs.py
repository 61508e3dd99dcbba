"""The command-line jobs on small inputs."""

from __future__ import annotations

import pytest

from sparkdeck.jobs import GENRES, main
from tests.test_goldens import TXN
from tests.test_profile_features_models import MARKS


def _write(tmp_path, name, lines, encoding="utf-8"):
    p = tmp_path / name
    p.write_bytes(("\n".join(lines) + "\n").encode(encoding))
    return str(p)


def _run(spark, tmp_path, *argv, opts=()):
    out = str(tmp_path / f"out-{len(list(tmp_path.iterdir()))}")
    main([*argv, out, *opts], spark=spark)
    return out


def _kv(spark, out):
    return dict(tuple(r.value.split("\t", 1)) for r in spark.read.text(out).collect())


def _lines(spark, out):
    return sorted(r.value for r in spark.read.text(out).collect())


def test_transaction_jobs(spark, tmp_path):
    t = _write(tmp_path, "t.txt", TXN)
    a = _write(tmp_path, "a.txt", TXN[:3])
    b = _write(tmp_path, "b.txt", TXN[1:])
    assert _lines(spark, _run(spark, tmp_path, "filter-transactions", t)) == sorted(TXN[1:3])
    assert _lines(spark, _run(spark, tmp_path, "project-transactions", t)) == ["C2,95", "C3,1750.5", "C7,640", "C9,3120"]
    assert len(_lines(spark, _run(spark, tmp_path, "union-transactions", a, b))) == 4
    assert _lines(spark, _run(spark, tmp_path, "intersect-transactions", a, b)) == sorted(TXN[1:3])
    assert _lines(spark, _run(spark, tmp_path, "difference-transactions", a, b)) == [TXN[0]]


def test_output_must_not_exist(spark, tmp_path):
    t = _write(tmp_path, "t.txt", TXN)
    out = str(tmp_path / "o")
    main(["filter-transactions", t, out], spark=spark)
    with pytest.raises(Exception):
        main(["filter-transactions", t, out], spark=spark)
    main(["filter-transactions", t, out, "--overwrite", "--threshold", "2000"], spark=spark)
    assert _lines(spark, out) == [TXN[2]]


def test_stats_matvec_words(spark, tmp_path):
    r = _write(tmp_path, "r.txt", ["ann,P,5", "ben,P,2", "cat,Q,1", "dan,Q,4", "eve,P,4"])
    assert _kv(spark, _run(spark, tmp_path, "movie-ratings-stats", r)) == {"P": "3.7,3", "Q": "2.5,2"}
    m = _write(tmp_path, "m.txt", ["1,1,1.5", "1,3,2", "2,2,-1", "2,3,4"])
    v = _write(tmp_path, "v.txt", ["1,2", "3,5"])
    assert _kv(spark, _run(spark, tmp_path, "matrix-vector", m, v)) == {"1": "13.0", "2": "20.0"}
    s = _write(tmp_path, "s.txt", ["grey owls hunt", "by night in quiet old woods"])
    counts = _kv(spark, _run(spark, tmp_path, "word-count", s))
    assert len(counts) == 9 and set(counts.values()) == {"1"}
    lengths = _kv(spark, _run(spark, tmp_path, "word-count", s, opts=["--variant", "lengths"]))
    assert lengths["quiet"] == "5"


def _movielens(tmp_path):
    flags = ["0"] * len(GENRES)
    for g in ("Animation", "Children's", "Comedy"):
        flags[GENRES.index(g)] = "1"
    item = "|".join(["10", "Café Bleu", "02-Feb-1993", "", "http://x"] + flags)
    data = _write(tmp_path, "u.data", ["1\t10\t4.5\t7000001", "2\t10\t2\t7000002", "1\t20\t5\t7000003"])
    items = _write(tmp_path, "u.item", [item], encoding="latin-1")
    users = _write(tmp_path, "u.user", ["1|n/a|M|baker|90210", "2|53|F|pilot|00417"])
    return data, items, users


def test_rating_jobs(spark, tmp_path):
    data, items, users = _movielens(tmp_path)
    assert _kv(spark, _run(spark, tmp_path, "avg-rating-by-title", data, items)) == {"Café Bleu": "3.25"}
    assert _kv(spark, _run(spark, tmp_path, "avg-rating-by-gender", data, users)) == {"M": "4.75", "F": "2.0"}
    top = _kv(spark, _run(spark, tmp_path, "top-rated", data, items, opts=["--min-count", "1", "--k", "2"]))
    assert top == {"MovieID_20": "5.0", "Café Bleu": "3.25"}
    pref = _kv(spark, _run(spark, tmp_path, "preferred-genre", data, users, items))
    assert pref == {"baker": "Animation", "pilot": "Animation"}


def test_model_jobs(spark, tmp_path):
    p = tmp_path / "marks.csv"
    p.write_text(MARKS.replace("\n", "\r\n"))
    drop = ["--label", "exam", "--drop", "student"]
    out = _run(spark, tmp_path, "linear-regression", str(p),
               opts=[*drop, "attendance"])
    terms = {r.term: r.value for r in spark.read.option("header", True).csv(out).collect()}
    assert {"intercept", "essay", "quiz", "test_rmse", "test_r2"} <= set(terms)
    assert 50 < float(terms["intercept"]) < 80  # centred features: near the mean mark
    out = _run(spark, tmp_path, "model-compare", str(p), opts=drop)
    assert spark.read.option("header", True).csv(out).count() == 4


def test_half_points_and_short_items_keep_their_rows(spark, tmp_path):
    data = _write(tmp_path, "u.data", [f"{u}\t1\t4.5\t1" for u in range(60)] + [f"{u}\t2\t3\t1" for u in range(60)])
    items = _write(tmp_path, "u.item", ["1|First", "2|Second|only|these"], encoding="latin-1")
    assert _kv(spark, _run(spark, tmp_path, "top-rated", data, items)) == {"First": "4.5", "Second": "3.0"}


def test_lines_of_the_title_job_are_not_trimmed(spark, tmp_path):
    data = _write(tmp_path, "u.data", ["\t3\t4\t88", "5\t3\t2.5\t89"])  # an empty user field stays in place
    items = _write(tmp_path, "u.item", ["3|Third"], encoding="latin-1")
    assert _kv(spark, _run(spark, tmp_path, "avg-rating-by-title", data, items)) == {"Third": "3.25"}


def test_a_bad_rating_does_not_cost_a_preferred_genre(spark, tmp_path):
    _, items, users = _movielens(tmp_path)
    data = _write(tmp_path, "bad.data", ["1\t10\tx\t1"])
    assert _kv(spark, _run(spark, tmp_path, "preferred-genre", data, users, items)) == {"baker": "Animation"}


def test_jobs_leave_the_session_to_the_submitter(tmp_path):
    import os
    import subprocess
    import sys

    t = _write(tmp_path, "t.txt", TXN)
    code = ("import sparkdeck.jobs as j; j.main(['filter-transactions', %r, %r]); "
            "from pyspark.sql import SparkSession as S; s = S.getActiveSession(); "
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))" % (t, str(tmp_path / "o")))
    env = os.environ | {"BENCH_CPUS": "7", "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false "
                        "--conf spark.sql.shuffle.partitions=5 pyspark-shell"}
    env["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.abspath(__file__))) + os.pathsep + env.get("PYTHONPATH", "")
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180)
    assert "GOT local[2] 5" in out.stdout, out.stderr[-2000:]


def test_grid_search_job_reports_test_figures(spark, tmp_path, monkeypatch):
    from sparkdeck.operators import tuning

    monkeypatch.setattr(tuning, "FULL_GRID", {"maxDepth": [2], "maxIter": [2, 4]})
    p = tmp_path / "marks.csv"
    p.write_text(MARKS)
    out = _run(spark, tmp_path, "grid-search", str(p), opts=["--label", "exam", "--drop", "student", "--folds", "2"])
    rows = spark.read.option("header", True).csv(out).collect()
    best = [r for r in rows if r["is_best"] == "true"]
    assert len(rows) == 2 and len(best) == 1 and best[0]["test_rmse"] is not None


def test_classifier_job(spark, tmp_path):
    rows = [f"{i},{i % 17},{(i * 7) % 11},{int(i % 17 + (i * 5) % 4 > 9)}" for i in range(200)]
    p = _write(tmp_path, "c.csv", ["id,x,y,good", *rows])
    out = _run(spark, tmp_path, "logistic-regression", p, opts=["--label", "good", "--drop", "id"])
    got = {r.term: r.value for r in spark.read.option("header", True).option("inferSchema", True).csv(out).collect()}
    assert {"intercept", "x", "y", "test_accuracy", "test_auc"} <= set(got) and got["test_auc"] > 0.9
    right = got["label_0_pred_0"] + got["label_1_pred_1"]
    n = sum(v for k, v in got.items() if "_pred_" in k)
    assert got["test_accuracy"] == pytest.approx(right / n)


def test_feature_job(spark, tmp_path):
    rows = [f"{i},{'?' if i % 9 == 0 else 'red' if i % 2 else 'blue'},{['low', 'mid', 'high'][i % 3]},{'' if i % 7 == 0 else i},{'yes' if i % 4 else 'no'}"
            for i in range(60)] + ["60,red,low,300,yes"]
    p = _write(tmp_path, "f.csv", ["id,colour,level,size,kept", *rows])
    out = _run(spark, tmp_path, "prepare-features", p, opts=[
        "--nominal", "colour", "--ordinal", "level=low,mid,high", "--numeric", "size", "--target", "kept", "--iqr-col", "size",
        "--relative-error", "0"])
    got = spark.read.option("header", True).csv(out).collect()
    assert len(got) == 60 and {r.label for r in got} == {"0.0", "1.0"}  # the outlier is gone
    assert all(len(r.features.split(",")) == 3 + 1 + 1 and all(0 <= float(x) <= 1 for x in r.features.split(",")) for r in got)
