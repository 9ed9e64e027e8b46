"""Command line entry points over a replay source."""

import os

from sluice.__main__ import main
from sluice.plans.queries import _replay_files
from sluice.session import new_run_dir
from sluice.sources import testdata as td
from sluice.streaming.persist import PersistFlow

SF = "/root/testdata/sf0.001"


def test_register_ingest_persist(spark, capsys):
    assert main(["register"]) == 0
    assert "schema:order:2.0.0" in capsys.readouterr().out
    run = new_run_dir(spark, "t-cli")
    src, out, state = (os.path.join(run, p) for p in ("src", "buffer", "state"))
    recs = td.order_records(spark, SF)
    _replay_files(recs, src, 2, "offset")
    assert main(["ingest", "--replay", src, "--out", out, "--once",
                 "--checkpoint", os.path.join(run, "ck1")]) == 0
    assert main(["persist", "--buffer", out, "--state", state, "--once",
                 "--checkpoint", os.path.join(run, "ck2")]) == 0
    n_valid = spark.read.parquet(out).where("status = 'valid'").count()
    assert PersistFlow(spark, state).target_frame().count() == n_valid > 0


def test_persist_with_clean_source(spark):
    run = new_run_dir(spark, "t-cli-clean")
    src, out, state = (os.path.join(run, p) for p in ("src", "buffer", "state"))
    _replay_files(td.order_records(spark, SF), src, 2, "offset")
    assert main(["ingest", "--replay", src, "--out", out, "--once", "--max-files-per-trigger", "1",
                 "--checkpoint", os.path.join(run, "ck1")]) == 0
    n_valid = spark.read.parquet(out).where("status = 'valid'").count()
    import glob
    first = sorted(glob.glob(os.path.join(out, "run=*", "batch=0", "status=valid", "*.parquet")))
    assert first
    assert main(["persist", "--buffer", out, "--state", state, "--once", "--clean-source",
                 "--max-files-per-trigger", str(len(first)),
                 "--checkpoint", os.path.join(run, "ck2")]) == 0
    assert PersistFlow(spark, state).target_frame().count() == n_valid
    # files of the first (committed) batch are gone, reject files are kept
    assert not any(os.path.exists(f) for f in first)
    assert glob.glob(os.path.join(out, "*", "*", "status=invalid", "*.parquet"))


def test_register_refuses_a_bad_corpus(spark, tmp_path, capsys):
    d = tmp_path / "corpus"
    d.mkdir()
    (d / "good-1.0.0.json").write_text('{"$id":"http://r/schemas/good/1.0.0","type":"object"}')
    (d / "bad-1.0.0.json").write_text('{"$id":"http://r/schemas/bad/1.0.0","type":"objekt"}')
    assert main(["register", "--registry", str(d)]) == 1
    assert "bad-1.0.0.json" in capsys.readouterr().err


def test_durable_registry_log(spark, tmp_path, capsys):
    log, docs = str(tmp_path / "log"), tmp_path / "docs"
    docs.mkdir()
    (docs / "a.json").write_text('{"$id":"/schemas/lamp/1.0.0","type":"object","required":["on"]}')
    args = ["--registry", str(docs), "--base", "https://own.example.org/r", "--log", log]
    assert main(["register", *args]) == 0
    assert "https://own.example.org/r/schemas/lamp/1.0.0" in capsys.readouterr().out
    (docs / "a.json").write_text('{"$id":"/schemas/lamp/1.0.0","type":"array"}')
    assert main(["register", *args]) == 0  # a second run appends, the last writer wins
    capsys.readouterr()
    assert main(["get", "--log", log, "lamp", "1"]) == 0 and '"array"' in capsys.readouterr().out
    assert main(["delete", "--log", log, "lamp", "1.0"]) == 0
    assert main(["delete", "--log", log, "lamp", "1.0"]) == 1 and main(["get", "--log", log, "lamp", "1.0.0"]) == 1
    assert main(["register", *args]) == 0 and main(["get", "--log", log, "lamp", "1.0.0"]) == 0


def test_produce_then_ingest(spark, tmp_path):
    out, buffer = str(tmp_path / "records"), str(tmp_path / "buffer")
    assert main(["produce", "--out", out, "--rows-per-second", "40", "--seconds", "6",
                 "--checkpoint", str(tmp_path / "ck0")]) == 0
    n = spark.read.parquet(out).count()
    assert n > 9
    assert main(["ingest", "--replay", out, "--out", buffer, "--once", "--checkpoint", str(tmp_path / "ck1")]) == 0
    got = spark.read.parquet(buffer)
    assert got.count() == n and got.where("status = 'valid'").count() == n
