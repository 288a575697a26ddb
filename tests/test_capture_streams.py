"""Keyed streams over several runs: late rows, restarts, timers, nulls."""

import datetime

import pytest

from normalake.streaming import captures as streams

T = lambda day, hour=0: datetime.datetime(2024, 1, day, hour)
CAPTURE = "tipo string, numero string, rendicao string, formato string, sha256 string, source string, captured_at string, event_id long"


def capture(number, sha, at, n, source="s"):
    return ("lei", number, "", "pdf", sha, source, at, n)


def runs(spark, parts, schema, step, name="rows"):
    frames = [{name: spark.createDataFrame(p, schema)} for p in parts]
    return streams.in_runs(spark, frames, lambda s: step(s[name])).collect()


def test_the_log_takes_each_content_once_and_refuses_late_captures(spark):
    parts = [
        [capture("1", "a", "2024-01-02", 1), capture("1", "a", "2024-01-01", 2), capture("1", "b", "2024-01-02", 3), capture("", "a", "2024-01-05", 4, "x"), capture(None, "a", "2024-01-05", 5, "y")],
        [capture("1", "c", "2024-01-01", 6), capture("1", "c", "2024-01-03", 7), capture("1", "a", "2024-01-09", 8), capture("2", "a", None, 9), capture("", "a", "2024-01-07", 10, "x")],
        [capture("1", "d", "2024-01-08", 11), capture("1", "d", "2024-01-09", 12), capture("2", "b", None, 13), capture("2", "c", "2024-01-01", 14)],
        [capture("2", "d", None, 15)],
    ]
    got = runs(spark, parts, CAPTURE, streams.append_log)
    # 11 is older than 8, which came before, although 8 itself was a copy
    assert sorted(r.event_id for r in got) == [2, 3, 4, 5, 7, 9, 12, 13, 14]
    assert got[0].asDict().keys() == {f.split(" ")[0] for f in CAPTURE.split(", ")}


def test_held_rows_are_promoted_late_or_expire(spark):
    held, ids = "source string, at timestamp, note string", "source string, at timestamp, tipo string, numero string"
    day = datetime.timedelta(days=1)
    parts = [
        ([("a", T(1), "waits"), ("a", T(1, 5), "waits too"), ("b", T(1), "too long"), ("c", T(1), "never")], [("d", T(1), "lei", "4")]),
        ([("d", T(1, 3), "known"), ("d", T(1, 3), "known")], [("a", T(1, 9), "lei", "1"), ("a", T(1, 8), "lc", "2")]),
        ([("a", T(2), "later"), ("e", T(9), "moves time on")], [("b", T(4), "lei", "3"), ("z", T(9), "lei", "9")]),
        ([("e", T(9, 1), "again"), (None, T(9), "no source")], [("z", T(9), "lei", "9"), ("a", T(9), "lei", "7")]),
    ]
    frames = [{"h": spark.createDataFrame(h, held), "i": spark.createDataFrame(i, ids)} for h, i in parts]
    got = streams.in_runs(spark, frames, lambda s: streams.promoted(s["h"], s["i"], day, "1 day")).collect()
    seen = sorted((r.note, r.tipo, r.numero, r.decision) for r in got if r.decision == "promoted")
    # of one batch the earliest identity counts, a later one changes nothing
    assert seen == [("known", "lei", "4", "promoted")] * 2 + [("later", "lc", "2", "promoted"), ("waits", "lc", "2", "promoted"), ("waits too", "lc", "2", "promoted")]
    assert {r.note for r in got if r.decision == "expired"} == {"too long", "never"}
    assert all(r.tipo is None and r.numero is None for r in got if r.decision == "expired")


def test_snapshots_are_fresh_for_a_day_whatever_the_order_of_files(spark):
    schema, day = "url string, at timestamp, n long", datetime.timedelta(days=1)
    parts = [[("u", T(3), 1), ("u", T(3, 5), 2), ("u", T(4, 1), 3), ("v", T(3), 4), (None, T(3), 5)], [("u", T(2), 6), ("u", T(4, 23), 7)], [("u", T(5, 1), 8), ("u", T(5, 2), 9), ("v", T(9), 10)], [("u", T(9, 3), 11), ("w", T(1), 12)]]
    got = runs(spark, parts, schema, lambda s: streams.fresh(s, "url", day, "30 days"))
    # 6 came late but there was a newer snapshot; 8 is exactly a day after 3
    assert sorted(r.n for r in got) == [1, 3, 4, 5, 9, 10, 11, 12]
    # with a short watermark, state goes and requests behind it are dropped
    got = runs(spark, parts, schema, lambda s: streams.fresh(s, "url", day, "1 day"))
    assert {1, 3, 4, 10, 11} <= {r.n for r in got} and 12 not in {r.n for r in got}


@pytest.mark.parametrize("step", [streams.append_log])
def test_empty_runs(spark, step):
    assert runs(spark, [[], [capture("1", "a", "x", 1)], []], CAPTURE, step)[0].event_id == 1


def calls_of(monkeypatch, tmp_path, step):
    """Runs of step's stream, whose calls of Python each leave a line in a file."""
    from pyspark.sql import GroupedData

    real, where = GroupedData.applyInPandasWithState, str(tmp_path / "calls")

    def counted(self, func, *more):
        def called(key, frames, state):
            with open(where, "a") as f:
                f.write("call\n")
            yield from func(key, frames, state)

        return real(self, called, *more)

    monkeypatch.setattr(GroupedData, "applyInPandasWithState", counted)
    got = step()
    return got, len(open(where).readlines())


def test_calls_of_the_log_do_not_grow_with_the_norms(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(streams, "GROUPS", 8, raising=False)
    parts = [[capture(str(n), "a", "2024-01-02", n) for n in range(1, 301)], [capture(str(n), "b", f"2024-01-0{1 + n % 3}", n + 1000) for n in range(1, 301)]]
    got, calls = calls_of(monkeypatch, tmp_path, lambda: runs(spark, parts, CAPTURE, streams.append_log))
    assert sorted(r.event_id for r in got) == [*range(1, 301), *(n + 1000 for n in range(1, 301) if n % 3)]
    assert calls <= 16


def test_the_log_knows_each_of_many_contents(spark):
    """Also those whose name ends in a zero byte."""
    rows = [capture("1", f"content {n}", "2024-01-02", n) for n in range(2000)]
    got = runs(spark, [rows, [(*r[:6], "2024-01-03", r[7]) for r in rows]], CAPTURE, streams.append_log)
    assert len(got) == 2000


def test_of_one_time_the_log_takes_the_least_number(spark):
    parts = [[capture("1", "a", "2024-01-02", 799_999), capture("1", "a", "2024-01-02", 99_999), capture("1", "b", "2024-01-02", 5)]]
    got = runs(spark, parts, CAPTURE, lambda s: streams.append_log(s, then="event_id"))
    assert sorted(r.event_id for r in got) == [5, 99_999]


def test_calls_of_the_holding_area_do_not_grow_with_the_sources(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(streams, "GROUPS", 8, raising=False)
    held, ids = "source string, at timestamp, note string", "source string, at timestamp, tipo string, numero string"
    h = [(f"s{n}", T(1, n % 24), str(n)) for n in range(60)]
    # the identities come a run later, each third too late and each fourth never
    i = [(f"s{n}", T(9 if n % 3 == 0 else 2), "lei", str(n)) for n in range(60) if n % 4]
    frames = [{"h": spark.createDataFrame(h, held), "i": spark.createDataFrame([], ids)}, {"h": spark.createDataFrame([], held), "i": spark.createDataFrame(i, ids)}]
    step = lambda: streams.in_runs(spark, frames, lambda s: streams.promoted(s["h"], s["i"], datetime.timedelta(days=3), "20 days")).collect()
    got, calls = calls_of(monkeypatch, tmp_path, step)
    assert sorted((int(r.note), r.numero, r.decision) for r in got) == [(n, str(n) if n % 3 else None, "promoted" if n % 3 else "expired") for n in range(60) if n % 4]
    assert calls <= 8 * 4


def test_a_held_row_without_a_time_never_expires(spark):
    held, ids = "source string, at timestamp, note string", "source string, at timestamp, tipo string, numero string"
    parts = [([("a", None, "no time"), ("b", T(1), "over")], []), ([("c", T(20), "moves time on")], []), ([("c", T(20), "again")], [])]
    frames = [{"h": spark.createDataFrame(h, held), "i": spark.createDataFrame(i, ids)} for h, i in parts]
    got = streams.in_runs(spark, frames, lambda s: streams.promoted(s["h"], s["i"], datetime.timedelta(days=1), "1 day")).collect()
    # time moves on where both streams have moved
    assert {r.note for r in got} <= {"over"}
