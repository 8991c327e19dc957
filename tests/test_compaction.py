"""Folding old batches: readers, replays, deletion, two compactions at a time."""

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ratewave.plans.stream import WIDE_SPEC, _in_ranges
from ratewave.schemas import ALERTS_OUT, BATCH_ID, T, WINDOWS_OUT
from ratewave.sources.files import latest_manifest, read_result_dir
from ratewave.streaming import compaction as C
from ratewave.streaming import summaries as S
from ratewave.streaming.app import start_final_windows
from ratewave.streaming.sinks import AVAILABLE_NOW, write_batch_partition

SCHEMA = T.StructType([T.StructField("x", T.LongType()), BATCH_ID])


def _write(spark, root, batch, values):
    write_batch_partition(spark.createDataFrame([(v,) for v in values], "x long"), root, batch, n_rows=len(values))


def _rows(spark, root):
    return sorted(map(tuple, read_result_dir(spark, root, SCHEMA).collect()))


def _all(batches):
    return sorted((v, b) for b, values in batches.items() for v in values)


def test_readers_see_each_batch_once(spark, tmp_dir):
    batches = {b: [b, b, 10 * b] for b in range(7) if b != 3}
    for b in (0, 1, 2, 4):
        _write(spark, tmp_dir, b, batches[b])
    before = read_result_dir(spark, tmp_dir, SCHEMA)  # planned before, read after
    m = C.compact(spark, tmp_dir, SCHEMA)
    assert (m.number, m.through, [p.n_rows for p in m.parts]) == (0, 2, [9])
    want = _all({b: batches[b] for b in (0, 1, 2, 4)})
    assert sorted(map(tuple, before.collect())) == want == _rows(spark, tmp_dir)
    assert C.compact(spark, tmp_dir, SCHEMA) is None  # the newest batch stays in its folder
    _write(spark, tmp_dir, 4, batches[4])  # a replay of the newest one
    assert _rows(spark, tmp_dir) == want
    for b in (5, 6):
        _write(spark, tmp_dir, b, batches[b])
    m = C.compact(spark, tmp_dir, SCHEMA)
    assert (m.number, m.through, [p.n_rows for p in m.parts]) == (1, 5, [9, 6])
    assert _rows(spark, tmp_dir) == _all(batches)


def test_a_folded_batch_cannot_be_written_again(spark, tmp_dir):
    for b in range(3):
        _write(spark, tmp_dir, b, [b])
    C.compact(spark, tmp_dir, SCHEMA)
    with pytest.raises(ValueError, match="folded"):
        _write(spark, tmp_dir, 1, [7])
    assert _rows(spark, tmp_dir) == [(0, 0), (1, 1), (2, 2)]


def test_a_replay_while_folding(spark, tmp_dir, monkeypatch):
    for b in range(3):
        _write(spark, tmp_dir, b, [b])
    publish = C._publish

    def replay_first(*args):
        _write(spark, tmp_dir, 2, [2, 22])  # the stream goes on between the part and its manifest
        assert _rows(spark, tmp_dir) == [(0, 0), (1, 1), (2, 2), (22, 2)]
        return publish(*args)

    monkeypatch.setattr(C, "_publish", replay_first)
    assert C.compact(spark, tmp_dir, SCHEMA).through == 1
    assert _rows(spark, tmp_dir) == [(0, 0), (1, 1), (2, 2), (22, 2)]


def test_two_at_a_time_and_a_failure(spark, tmp_dir, monkeypatch):
    for b in range(4):
        _write(spark, tmp_dir, b, [b])
    publish = C._publish

    def other_first(*args):
        monkeypatch.setattr(C, "_publish", publish)
        assert C.compact(spark, tmp_dir, SCHEMA).number == 0
        return publish(*args)

    monkeypatch.setattr(C, "_publish", other_first)
    assert C.compact(spark, tmp_dir, SCHEMA) is None
    assert len(os.listdir(f"{tmp_dir}/{C.FOLDED}")) == 1  # the slower one's part is gone
    assert _rows(spark, tmp_dir) == [(b, b) for b in range(4)]

    def dies(*args):
        raise OSError("killed")

    _write(spark, tmp_dir, 4, [4])
    _write(spark, tmp_dir, 5, [5])
    monkeypatch.setattr(C, "_publish", dies)
    with pytest.raises(OSError):
        C.compact(spark, tmp_dir, SCHEMA)
    assert _rows(spark, tmp_dir) == [(b, b) for b in range(6)]


def test_parts_stay_few(spark, tmp_dir):
    for b in range(9):
        _write(spark, tmp_dir, b, [b])
        C.compact(spark, tmp_dir, SCHEMA)
    sizes = [p.n_rows for p in latest_manifest(spark, tmp_dir).parts]
    assert sum(sizes) == 8 and all(sizes[i] > sum(sizes[i + 1:]) for i in range(len(sizes)))
    assert _rows(spark, tmp_dir) == [(b, b) for b in range(9)]


def test_removal_waits_for_readers(spark, tmp_dir):
    for b in range(5):
        _write(spark, tmp_dir, b, [b])
    C.compact(spark, tmp_dir, SCHEMA)
    assert C.remove_folded(spark, tmp_dir, 3600) == 0 and C.batch_folders(spark, tmp_dir) == [0, 1, 2, 3, 4]
    time.sleep(1.1)
    assert C.remove_folded(spark, tmp_dir, 0.5) == 4 and C.batch_folders(spark, tmp_dir) == [4]
    assert _rows(spark, tmp_dir) == [(b, b) for b in range(5)]
    for b in range(5, 12):
        _write(spark, tmp_dir, b, [b])
    assert [p.n_rows for p in C.compact(spark, tmp_dir, SCHEMA).parts] == [11]
    time.sleep(1.1)
    assert C.remove_folded(spark, tmp_dir, 0.5) == 9  # seven folders, the part taken in, the manifest before
    assert len(os.listdir(f"{tmp_dir}/{C.FOLDED}")) == 1
    assert _rows(spark, tmp_dir) == [(b, b) for b in range(12)]


def test_file_sizes(spark, tmp_dir):
    _write(spark, tmp_dir, 0, range(1000))
    _write(spark, tmp_dir, 1, [5] * 1000)
    _write(spark, tmp_dir, 2, [0])
    m = C.compact(spark, tmp_dir, SCHEMA, rows_per_file=250)
    files = spark.read.schema(SCHEMA).parquet(f"{tmp_dir}/{m.parts[0].path}").groupBy(F.input_file_name()).count().collect()
    assert 4 <= len(files) <= 8  # equal rows stay together
    assert C.compact(spark, f"{tmp_dir}/none", SCHEMA) is None
    assert C.remove_folded(spark, f"{tmp_dir}/none") == 0


def test_outputs_of_the_stream(spark):
    start = lambda ev, out: start_final_windows(ev, out, WIDE_SPEC, AVAILABLE_NOW, min_avg=4.0, min_n=2)
    out = _in_ranges(spark, SF001, "folding", start)

    def answers():
        return [sorted(map(str, df.collect())) for df in (
            S.stored_windows(spark, out), S.stored_counters(spark, out), S.stored_best(spark, out),
            read_result_dir(spark, f"{out}/alerts", ALERTS_OUT), S.latest_stored_alerts(spark, out, 20, 4.0, 2))]

    before, dates = answers(), S.stored_dates(S.stored_windows(spark, out, with_date=True))
    assert {"trending", "alerts", "window_counts", "window_items", "window_best"} <= set(C.compact_outputs(spark, out))
    time.sleep(1.1)
    for name, _, _ in C.outputs(spark, out):
        C.remove_folded(spark, f"{out}/{name}", 0.5)
    assert len(C.batch_folders(spark, f"{out}/trending")) == 1
    assert answers() == before
    assert S.stored_dates(S.stored_windows(spark, out, with_date=True)) == dates
    windows = read_result_dir(spark, f"{out}/trending", WINDOWS_OUT).where(F.col("window_date") >= F.lit(dates[0]).cast("date"))
    plan = windows._sc._jvm.PythonSQLUtils.explainString(windows._jdf.queryExecution(), "formatted")
    found = re.findall(r"PartitionFilters: \[(.*)\]", plan)
    assert len(found) == 2 and all("window_date" in f for f in found)
