from __future__ import annotations

from dataclasses import replace

import pytest

from mailloom import FetchOptions
from mailloom.operators import criteria as c
from mailloom.plans.fetch import fetch
from mailloom.plans.poll import run_step
from mailloom.sources import sinks
from mailloom.sources.sinks import (
    not_delivered,
    read_cursor_steps,
    read_mark_steps,
    step_counts,
    write_cursor_step,
    write_delivered_step,
    write_mark_step,
)
from mailloom.streaming.incremental import incremental_stream

SCHEMA = (
    "folder string, uid long, size long, subject string, message_id string, "
    "flags array<string>, from_all array<string>, to_all array<string>, cc_all array<string>, "
    "received_ts timestamp, sent_ts timestamp"
)
OPTIONS = FetchOptions(folder="*", recursive=True, fetch_mode="HEADERS_ONLY", state_folder="s",
                       max_message_size=100, incremental=True)


def batch(spark, *rows):
    return spark.createDataFrame(
        [(f, u, s, "t", "<m>", [], [], [], [], None, None) for f, u, s in rows], SCHEMA)


def delivered(spark, out):
    rows = spark.read.parquet(out).select("step", "relationship", "folder", "uid").collect()
    return sorted(map(tuple, rows))


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "out"), str(tmp_path / "cursors")


def test_steps_and_replay(spark, paths):
    out, state = paths
    steps = [
        batch(spark, ("a", 1, 10), ("a", 2, 10), ("b", 5, 500)),
        batch(spark, ("a", 2, 10), ("a", 3, 500), ("a", 4, 10), ("b", 4, 10)),
        batch(spark, ("a", 3, 10), ("b", 3, 10), ("b", 6, 10)),
    ]
    expected = [
        (0, "parse-error", "b", 5), (0, "success", "a", 1), (0, "success", "a", 2),
        (1, "parse-error", "a", 3), (1, "success", "a", 4), (1, "success", "b", 4),
        (2, "success", "b", 6),
    ]
    for step, rows in enumerate(steps):
        run_step(rows, step, out, state, OPTIONS, capped=False)
        # Running the same step again changes nothing.
        run_step(rows, step, out, state, OPTIONS, capped=False)
    assert delivered(spark, out) == expected
    assert sorted(map(tuple, read_cursor_steps(spark, state, 3).collect())) == [
        ("s", "a", 4), ("s", "b", 6)]
    assert sorted(map(tuple, read_cursor_steps(spark, state, 1).collect())) == [("s", "a", 2)]
    assert read_cursor_steps(spark, state, 0).count() == 0


def test_stream_restarts_where_it_stopped(spark, paths, tmp_path):
    out, state = paths
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    marked = []

    def run(*rows):
        batch(spark, *rows).coalesce(1).write.mode("append").parquet(source)
        incremental_stream(
            spark.readStream.schema(SCHEMA).parquet(source), out, state, checkpoint, OPTIONS,
            after_batch=lambda df, step: marked.append(step),
        ).awaitTermination()

    run(("a", 1, 1), ("b", 1, 1))
    run(("a", 1, 1), ("a", 2, 1))
    run(("b", 2, 1))
    assert delivered(spark, out) == [
        (0, "success", "a", 1), (0, "success", "b", 1), (1, "success", "a", 2),
        (2, "success", "b", 2)]
    assert marked == [0, 1, 2]


def test_rate_limit_loses_nothing(spark, paths, tmp_path):
    out, state = paths
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")

    def stream(**more):
        limited = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1")
        return incremental_stream(
            limited.parquet(source), out, state, checkpoint, OPTIONS, **more)

    def land(*uids):
        for uid in uids:
            batch(spark, ("a", uid, 1), ("b", uid, 1)).coalesce(1).write.mode("append").parquet(source)

    land(30, 10)
    with pytest.raises(ValueError, match="unordered"):
        stream()
    stream(unordered=True).awaitTermination()
    land(20, 40, 10)
    stream(unordered=True).awaitTermination()
    have = [(folder, uid) for _, _, folder, uid in delivered(spark, out)]
    assert sorted(have) == [(f, u) for f in "ab" for u in (10, 20, 30, 40)]


def test_a_stream_has_no_cap(spark, paths, tmp_path):
    source = batch(spark, ("a", 1, 1))
    with pytest.raises(ValueError, match="no cap"):
        incremental_stream(source, *paths, str(tmp_path / "c"), replace(OPTIONS, batch_size=5))


def test_old_steps_are_not_read_again(spark, paths, monkeypatch):
    _, state = paths
    monkeypatch.setattr(sinks, "SNAPSHOT_EVERY", 3)
    columns = "state_folder string, folder string, last_uid long"
    for step in range(8):
        known = read_cursor_steps(spark, state, step)
        assert len(known.inputFiles()) == 0 or all(
            int(name.split("step=")[1].split("/")[0]) >= (step - 1) // 3 * 3
            for name in known.inputFiles())
        new = spark.createDataFrame([("s", f"f{step % 4}", step + 1)], columns)
        write_cursor_step(new, known, state, step)
    assert sorted(map(tuple, read_cursor_steps(spark, state, 8).collect())) == [
        ("s", "f0", 5), ("s", "f1", 6), ("s", "f2", 7), ("s", "f3", 8)]


def test_capped_steps_work_through_a_table(spark, paths):
    out, state = paths
    table = batch(spark, *[("a", n, 10) for n in range(1, 26)], ("b", 1, 10))
    options = replace(OPTIONS, batch_size=1)
    for step in range(4):
        run_step(table, step, out, state, options)
    counts = {}
    for step, _, folder, uid in delivered(spark, out):
        counts.setdefault((step, folder), []).append(uid)
    assert counts == {(0, "a"): list(range(1, 11)), (0, "b"): [1],
                      (1, "a"): list(range(11, 21)), (2, "a"): list(range(21, 26))}


def test_steps_without_cursors_repeat_themselves(spark, paths):
    out, state = paths
    table = batch(spark, ("a", 1, 10))
    options = replace(OPTIONS, incremental=False)
    for step in range(2):
        run_step(table, step, out, state, options)
    assert delivered(spark, out) == [(0, "success", "a", 1), (1, "success", "a", 1)]


def keys(df):
    return sorted((r.folder, r.uid) for r in df.collect())


def test_delivered_uids_are_kept_as_bits(spark, paths):
    _, state = paths
    uids = [1, 2, 8, 9, 32767, 32768, 32769, 65536, 65537, 4294967295]
    box = batch(spark, *[(f, u, 1) for f in "ab" for u in uids], ("a", 0, 1), ("a", -1, 1),
                ("a", None, 1))
    assert not_delivered(box, state, 0).count() == box.count()
    write_delivered_step(box.filter("folder = 'a' and uid % 2 = 1"), state, 0)
    write_delivered_step(box.filter("folder = 'b' and uid = 32768"), state, 1)
    left = not_delivered(box, state, 2)
    assert left.columns == box.columns
    found = {(r.folder, r.uid) for r in left.collect()}
    assert found == {("a", u) for u in uids if u % 2 == 0} | {("a", 0), ("a", -1), ("a", None)} | {
        ("b", u) for u in uids if u != 32768}
    # A step does not see its own log, so that it can be run again.
    assert ("b", 32768) in {(r.folder, r.uid) for r in not_delivered(box, state, 1).collect()}


def test_unordered_steps_do_not_read_earlier_outputs(spark, tmp_path):
    state, options = str(tmp_path / "state"), replace(OPTIONS, state_folder="s")
    for step, uids in enumerate([(30, 10), (20, 10), (40, 30, 5)]):
        run_step(batch(spark, *[("a", u, 1) for u in uids]), step, str(tmp_path / f"out{step}"),
                 state, options, capped=False, unordered=True)
    assert [keys(spark.read.parquet(str(tmp_path / f"out{step}"))) for step in range(3)] == [
        [("a", 10), ("a", 30)], [("a", 20)], [("a", 5), ("a", 40)]]


@pytest.mark.parametrize("gaps", [(), (3, 6, 7)])
def test_logs_start_from_a_base(spark, paths, monkeypatch, gaps):
    _, state = paths
    monkeypatch.setattr(sinks, "SNAPSHOT_EVERY", 3)
    steps = [step for step in range(9) if step not in gaps]
    for step in steps:
        rows = batch(spark, ("a", step + 1, 1), ("a", 100, 1))
        for _ in range(2 if step == steps[-1] else 1):  # the latest step is run again
            write_mark_step(rows, state, step, True, step == 4)
            write_delivered_step(rows, state, step)
    marks = read_mark_steps(spark, state, 9)
    read = {name.split("/marks/")[1].rsplit("/", 1)[0] for name in marks.inputFiles()}
    assert read == {"base/era=2"} | {f"steps/era=2/step={n}" for n in steps if n >= 6}
    assert {(m.uid, m.deleted) for m in marks.collect()} >= {(s + 1, s == 4) for s in steps} | {(100, True)}
    box = batch(spark, *[("a", u, 1) for u in (*range(1, 12), 100)])
    assert keys(not_delivered(box, state, 9)) == [
        ("a", u) for u in range(1, 12) if u - 1 not in steps]


def test_expunge_after_a_base(spark, paths, monkeypatch):
    out, state = paths
    monkeypatch.setattr(sinks, "SNAPSHOT_EVERY", 2)
    table = batch(spark, *[("a", n, 10) for n in range(1, 61)])
    options = replace(OPTIONS, batch_size=1, incremental=False, delete_messages=True)
    for step in (0, 1, 2, 3, 3, 4):
        run_step(table, step, out, state, options)
    assert delivered(spark, out) == [((n - 1) // 10, "success", "a", n) for n in range(1, 51)]


@pytest.mark.parametrize("capped", [False, True])
def test_counts_come_with_the_step(spark, tmp_path, capped):
    rows = batch(spark, *[("a", u, 1) for u in range(1, 31)], ("b", 1, 9_999_999_999), ("b", 2, 1))
    out = str(tmp_path / "out")
    options = replace(OPTIONS, batch_size=1)
    run = run_step(rows, 0, out, str(tmp_path / "state"), options, capped=capped)
    assert capped or run.processed == 32
    want = {r.folder: r.processed for r in run.summary.collect()}
    assert want == {"a": 30, "b": 2, None: 32}
    written = {r.folder: r.processed for r in step_counts(spark, f"{out}/step=0").collect()}
    assert written == ({"a": 10, "b": 2, None: 12} if capped else want)
    empty = run_step(rows, 1, out, str(tmp_path / "state"), options, [c.subject("nowhere")], capped=capped)
    assert capped or empty.processed == 0
    left = [(r.folder, r.processed, r.had_messages) for r in step_counts(spark, f"{out}/step=1").collect()]
    assert left == [(None, 0, False)]
    with pytest.raises(ValueError):
        fetch(rows, options).processed
    with pytest.raises(ValueError):
        fetch(rows, options, observed=True)
