"""Command line: train -> recommend, stream -> report (in-process)."""

import json
import os

from ratewave import cli
from ratewave.models.versions import current_model
from ratewave.schemas import METRICS_OUT
from ratewave.sources.files import read_result_dir


def test_train_recommend_stream_report(spark, tmp_dir, capsys):
    ratings = os.path.join(tmp_dir, "ratings.csv")
    with open(ratings, "w") as fh:
        fh.write("userId,movieId,rating,timestamp\n")
        for u in range(1, 41):
            for i in range(1, 16):
                fh.write(f"{u},{i},{(u * i) % 5 + 1}.0,97830{u:04d}\n")
    model = os.path.join(tmp_dir, "model")
    assert cli.run(spark, ["train", "--ratings", ratings, "--model", model]) == 0
    out = capsys.readouterr().out
    assert "valid ratings: 600" in out and os.path.exists(model)

    assert cli.run(spark, ["recommend", "--model", model, "--users", "1", "7", "999"]) == 0
    rows = [ln for ln in capsys.readouterr().out.splitlines() if ln.startswith("|") and "user_id" not in ln]
    assert len(rows) == 2  # the unknown user 999 is absent

    files = os.path.join(tmp_dir, "events")
    os.makedirs(files)
    with open(os.path.join(files, "a.json"), "w") as fh:
        for n in range(6):
            fh.write(json.dumps({"user_id": n + 1, "item_id": 3, "rating": 4.9,
                                 "timestamp": "2026-05-12T14:30:0%d+00:00" % n}) + "\n")
        fh.write(json.dumps({"user_id": 1, "item_id": 4, "rating": 1.0,
                             "timestamp": "2026-05-12T14:45:00+00:00"}) + "\n")
    outdir = os.path.join(tmp_dir, "out")
    assert cli.run(spark, ["stream", "--files", files, "--out", outdir, "--model", model,
                           "--available-now"]) == 0
    assert cli.run(spark, ["report", "--out", outdir]) == 0
    report = capsys.readouterr().out
    assert "TRENDING" in report and "rec_rows" in report
    assert spark.read.parquet(os.path.join(outdir, "recs")).count() == 6


def test_train_with_wide_ids_keeps_map(spark, tmp_dir, capsys):
    ratings = os.path.join(tmp_dir, "wide.csv")
    base = 4_000_000_000
    with open(ratings, "w") as fh:
        fh.write("userId,movieId,rating,timestamp\n")
        for u in range(20):
            for i in range(10):
                fh.write(f"{base + u},{i},{(u + i) % 5 + 1}.0,1\n")
    model = os.path.join(tmp_dir, "model")
    assert cli.run(spark, ["train", "--ratings", ratings, "--model", model]) == 0
    assert os.path.exists(current_model(spark, model) + "/idmaps/user_id")
    capsys.readouterr()
    assert cli.run(spark, ["recommend", "--model", model, "--users", str(base + 3), "5"]) == 0
    out = capsys.readouterr().out
    assert str(base + 3) in out and "| 5 " not in out


def _write_ratings(path, first_user):
    with open(path, "w") as fh:
        fh.write("userId,movieId,rating,timestamp\n")
        for u in range(20):
            for i in range(10):
                fh.write(f"{first_user + u},{i},{(u + i) % 5 + 1}.0,1\n")


def test_stream_recommends_to_the_trained_wide_ids(spark, tmp_dir):
    base = 4_000_000_000
    ratings, model, files, out = (os.path.join(tmp_dir, n) for n in ("r.csv", "model", "events", "out"))
    _write_ratings(ratings, base)
    cli.run(spark, ["train", "--ratings", ratings, "--model", model])
    os.makedirs(files)
    with open(os.path.join(files, "a.json"), "w") as fh:
        for user in (5, base + 7, base + 900):
            fh.write(json.dumps({"user_id": user, "item_id": 3, "rating": 4.0,
                                 "timestamp": "2026-05-12T14:30:00+00:00"}) + "\n")
    cli.run(spark, ["stream", "--files", files, "--out", out, "--model", model, "--available-now"])
    recs = spark.read.parquet(os.path.join(out, "recs")).collect()
    assert [r.user_id for r in recs] == [base + 7]  # 5 is no trained user, though a dense id


def test_a_retrain_leaves_no_old_id_map(spark, tmp_dir, capsys):
    ratings, model = os.path.join(tmp_dir, "r.csv"), os.path.join(tmp_dir, "model")
    for first in (4_000_000_000, 100):
        _write_ratings(ratings, first)
        cli.run(spark, ["train", "--ratings", ratings, "--model", model])
    assert not os.path.exists(current_model(spark, model) + "/idmaps/user_id")
    capsys.readouterr()
    cli.run(spark, ["recommend", "--model", model, "--users", "105"])
    assert "|105 " in capsys.readouterr().out.replace("| 105", "|105")


def test_compact_folds_the_outputs(spark, tmp_dir, capsys):
    files, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    os.makedirs(files)
    for i in range(3):
        with open(os.path.join(files, f"{i}.json"), "w") as fh:
            fh.write(json.dumps({"user_id": 1, "item_id": i, "rating": 4.0, "timestamp": f"2026-05-12T14:{30 + i}:00+00:00"}) + "\n")
    cli.run(spark, ["stream", "--files", files, "--out", out, "--available-now", "--max-files-per-trigger", "1"])
    before = spark.read.parquet(f"{out}/metrics").count()
    capsys.readouterr()
    assert cli.run(spark, ["compact", "--out", out, "--remove-after", "3600"]) == 0
    said = capsys.readouterr().out
    assert "metrics: batches up to 1 in 1 part(s)" in said and "removed: 0" in said
    assert before == 3 and read_result_dir(spark, f"{out}/metrics", METRICS_OUT).count() == 3
