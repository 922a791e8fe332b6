"""Stateful stream jobs: windows, sessions, running counts, dedup, interval joins and their side output."""

from __future__ import annotations

import os
import random
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kestrel import streaming as st

SCHEMA = "id long, key string, ts timestamp"
T0 = datetime(2024, 1, 1, tzinfo=UTC)


def at(minutes):
    return None if minutes is None else T0 + timedelta(minutes=minutes)


def play(spark, tmp_dir, parts, job, schema=SCHEMA):
    """One run of ``job`` per part, on one checkpoint."""
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    for part in parts:
        spark.createDataFrame([(*r[:-1], at(r[-1])) for r in part], schema).coalesce(1).write.mode("append").parquet(src)
        job(st.read_stream(spark, src, schema), out, ckpt)
    return out


def minutes(value):
    return (value.replace(tzinfo=UTC) - T0) / timedelta(minutes=1)


def simulate(parts, delay, missed):
    """(rows on time, late rows, rows without time, final watermark) in minutes, part by part."""
    mark, top, good, late, none = None, None, [], [], []
    for part in parts:
        for row in part:
            t = row[-1]
            if t is None:
                none.append(row)
            elif mark is not None and missed(t, mark):
                late.append(row)
            else:
                good.append(row)
        times = [r[-1] for r in part if r[-1] is not None]
        top = max([top, *times] if top is not None else times)
        mark = top - delay
    return good, late, none, mark


def events(seed=1, n=600):
    """Three parts of (id, key, minute): a hot key, late rows, rows without time."""
    rng = random.Random(seed)
    parts = [[], [], []]
    for i in range(n):
        p = rng.randrange(3)
        t = p * 200 + rng.randrange(200) - (rng.randrange(400) if rng.random() < 0.15 else 0)
        key = rng.choice(["hot"] * 4 + ["a", "b", None])
        parts[p].append((i, key, None if rng.random() < 0.05 else max(t, 0)))
    return parts


@pytest.mark.parametrize(("size", "slide"), [(30, None), (60, 25)])
def test_windows_and_every_row_accounted_for(spark, tmp_dir, size, slide):
    parts, delay = events(), 50
    out = play(spark, tmp_dir, parts, lambda s, out, ckpt: st.windows(
        s, "ts", ["key"], [F.count(F.lit(1)).alias("n")], timedelta(minutes=size), out, ckpt,
        slide=slide and timedelta(minutes=slide), delay=timedelta(minutes=delay), available_now=True))
    step = slide or size
    origin = T0.timestamp() / 60  # windows are aligned to the epoch

    def ends(t):
        first = t - (origin + t) % step
        return [first - k * step + size for k in range(-(-size // step)) if first - k * step + size > t]

    mark, top, want, lost = None, None, Counter(), {}
    for part in parts:
        for i, key, t in part:
            for e in ends(t) if t is not None else []:
                if mark is not None and e <= mark:
                    lost[i] = lost.get(i, 0) + 1
                else:
                    want[key, e - size] += 1
        top = max([x for x in (top, *[r[2] for r in part]) if x is not None])
        mark = top - delay
    got = {(r.key, minutes(r.window_start)): r.n for r in st.results(spark, out).collect()}
    assert got == {k: n for k, n in want.items() if k[1] + size <= mark}
    side = st.late_rows(spark, out).collect()
    assert {r.id: r.missed for r in side if r.kind == "late"} == lost and lost
    assert sorted(r.id for r in side if r.kind == "no_time") == sorted(r[0] for p in parts for r in p if r[2] is None)


def test_a_run_without_new_rows_adds_nothing_and_a_replay_replaces(spark, tmp_dir):
    parts = events(4, 120)

    def job(s, out, ckpt):
        return st.windows(s, "ts", [], [F.count(F.lit(1)).alias("n")], timedelta(minutes=30), out, ckpt, available_now=True)

    out = play(spark, tmp_dir, parts, job)
    before = sorted(map(repr, st.results(spark, out).collect())), sorted(map(repr, st.late_rows(spark, out).collect()))
    job(st.read_stream(spark, f"{tmp_dir}/in", SCHEMA), out, f"{tmp_dir}/ckpt")
    # the driver dies after writing the last batch, before the commit is logged: the batch runs again
    commits = f"{tmp_dir}/ckpt/commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    job(st.read_stream(spark, f"{tmp_dir}/in", SCHEMA), out, f"{tmp_dir}/ckpt")
    after = sorted(map(repr, st.results(spark, out).collect())), sorted(map(repr, st.late_rows(spark, out).collect()))
    assert after == before


def test_only_rows_without_time(spark, tmp_dir):
    out = play(spark, tmp_dir, [[(1, "a", None), (2, "a", None)]], lambda s, out, ckpt: st.sessions(
        s, "ts", ["key"], [F.count(F.lit(1)).alias("n")], timedelta(minutes=5), out, ckpt, available_now=True))
    assert st.results(spark, out).count() == 0 and st.late_rows(spark, out).count() == 2


def test_sessions_grow_over_parts(spark, tmp_dir):
    parts = [[(1, "a", 0), (2, "a", 9), (3, "hot", 0), *[(100 + i, "hot", i % 40) for i in range(200)]],
             [(4, "a", 18), (5, "hot", 45), (6, "a", 60)], [(7, "a", 200), (8, "a", 30)]]
    out = play(spark, tmp_dir, parts, lambda s, out, ckpt: st.sessions(
        s, "ts", ["key"], [F.count(F.lit(1)).alias("n")], timedelta(minutes=10), out, ckpt, delay=timedelta(minutes=30), available_now=True))
    got = sorted((r.key, minutes(r.window_start), minutes(r.window_end), r.n) for r in st.results(spark, out).collect())
    # row 8 (minute 30, session end 40) comes when the watermark is 30: it still counts
    assert got == [("a", 0, 28, 3), ("a", 30, 40, 1), ("a", 60, 70, 1), ("hot", 0, 55, 202)]


def test_running_counts_time_out_and_start_anew(spark, tmp_dir):
    parts = [[(1, "a", 0), (2, "a", 5), (3, "b", 5), *[(100 + i, "hot", i % 10) for i in range(500)]],
             [(4, "a", 20), (5, None, 100)], [(6, "a", 130), (7, "b", 5), (8, "b", 140)], [(9, "z", 400)]]
    out = play(spark, tmp_dir, parts, lambda s, out, ckpt: st.running_counts(
        s, "ts", "key", timedelta(minutes=60), out, ckpt, delay=timedelta(minutes=20), available_now=True))
    got = sorted(((r.key or "", r.n, minutes(r["last"]), r.closed) for r in st.results(spark, out).collect()))
    assert got == sorted([
        ("a", 2, 6, False), ("b", 1, 6, False), ("hot", 500, 10, False),  # event times count as the end of their minute
        ("a", 3, 21, False), ("", 1, 101, False), ("b", 1, 6, True), ("hot", 500, 10, True),  # watermark 81
        ("a", 4, 131, False), ("b", 1, 141, False),  # watermark 121; row 7 is late
        ("z", 1, 401, False), ("a", 4, 131, True), ("b", 1, 141, True), ("", 1, 101, True),
    ])
    assert [r.id for r in st.late_rows(spark, out).collect()] == [7]


@pytest.mark.parametrize("kind", ["string", "long", "date", "timestamp", "binary", "double"])
def test_running_counts_hold_keys_by_buckets(spark, tmp_dir, kind):
    # 2 buckets of 41 keys and null: each key times out by itself; numbers above 2^53 stay what they are
    parts = [[(i, None if i % 41 == 40 else i % 41, i % 10) for i in range(200)],
             [(300 + i, i, 100 + i) for i in range(20)], [(400, 7, 190)], [(500, 99, 600)]]
    make = {"string": lambda k: f"k{k}", "long": lambda k: 2**60 + k, "date": lambda k: (T0 + timedelta(days=k)).date(), "timestamp": lambda k: T0 + timedelta(microseconds=k),
            "binary": lambda k: bytearray([255, k]), "double": lambda k: k / 7}[kind]
    typed = [[(i, None if k is None else make(k), t) for i, k, t in part] for part in parts]
    out = play(spark, tmp_dir, typed, lambda s, out, ckpt: st.running_counts(
        s, "ts", "key", timedelta(minutes=60), out, ckpt, delay=timedelta(minutes=20), buckets=2, available_now=True), f"id long, key {kind}, ts timestamp")
    state, mark, top, due = {}, None, None, []
    for part in parts:
        seen = set()
        for _, k, t in part:
            if mark is None or t + 1 > mark:
                n, last = state.get(k, (0, 0))
                if n and k not in seen and last + 60 < mark:
                    due.append((k, n, last, True))
                    n, last = 0, 0
                state[k] = (n + 1, max(last, t + 1))
                seen.add(k)
        due += [(k, *state[k], False) for k in seen]
        top = max(t + 1 for _, _, t in part)
        mark = top - 20
        for k in [k for k, (_, last) in state.items() if last + 60 < mark]:
            due.append((k, *state.pop(k), True))
    text = lambda k: None if k is None else make(k)
    plain = lambda k: bytes(k) if isinstance(k, bytearray) else k.replace(tzinfo=UTC) if isinstance(k, datetime) else k
    got = Counter((plain(r.key), r.n, minutes(r["last"]), r.closed) for r in st.results(spark, out).collect())
    assert got == Counter((plain(text(k)), n, last, closed) for k, n, last, closed in due)


def test_distinct_counts_replays_once(spark, tmp_dir):
    parts = events(2, 300)
    parts[1] += parts[0][::3] + parts[1][::2]
    parts[2] += parts[1][::4] + [parts[2][0]] * 500
    out = play(spark, tmp_dir, parts, lambda s, out, ckpt: st.distinct(s, "ts", ["id"], out, ckpt, delay=timedelta(minutes=50), available_now=True))
    good, late, none, _ = simulate(parts, 50, lambda t, mark: t <= mark)
    assert Counter(r.id for r in st.results(spark, out).collect()) == Counter({r[0] for r in good})
    side = st.late_rows(spark, out)
    assert Counter(r.id for r in side.where("kind = 'late'").collect()) == Counter(r[0] for r in late)
    assert side.where("kind = 'no_time'").count() == len(none)


@pytest.mark.parametrize(("how", "lower", "upper"), [("inner", -20, 30), ("left_outer", 0, 45)])
def test_interval_join_over_parts(spark, tmp_dir, how, lower, upper):
    parts, delay = events(3, 400), 60

    def job(s, out, ckpt):
        left = s.where("id % 2 = 0").select("key", F.col("id").alias("l"), F.col("ts").alias("lts"))
        right = s.where("id % 2 = 1").select("key", F.col("id").alias("r"), F.col("ts").alias("rts"))
        st.interval_join(left, right, ["key"], "lts", "rts", timedelta(minutes=lower), timedelta(minutes=upper), out, ckpt,
                         how=how, delay=timedelta(minutes=delay), available_now=True)

    out = play(spark, tmp_dir, parts, job)
    mark, tops, lefts, rights, late = None, [None, None], [], [], [[], []]
    for part in parts:
        for i, key, t in part:
            if t is not None:
                (late[i % 2] if mark is not None and t <= mark else (lefts, rights)[i % 2]).append((i, key, t))
        for side in (0, 1):
            tops[side] = max(x for x in (tops[side], *[t for i, _, t in part if i % 2 == side]) if x is not None)
        mark = min(tops) - delay
    pairs = {(i, j) for i, k, t in lefts for j, m, u in rights if k is not None and k == m and t + lower <= u <= t + upper}
    got = [(r.l, r.r) for r in st.results(spark, out).collect()]
    assert len(got) == len(set(got)) and {p for p in got if p[1] is not None} == pairs and pairs
    alone = {i for i, _, t in lefts if t + upper < mark} - {i for i, _ in pairs}
    assert {i for i, j in got if j is None} == (alone if how == "left_outer" else set())
    assert sorted(r.l for r in st.late_rows(spark, out, "left").where("kind = 'late'").collect()) == sorted(r[0] for r in late[0])
    assert sorted(r.r for r in st.late_rows(spark, out, "right").where("kind = 'late'").collect()) == sorted(r[0] for r in late[1])
