import datetime as dt
import random

from cadastra.operators.snapshots import changed_records

SCHEMA = "snapshot_no int, snapshot_date timestamp, k string, vertical string, name string, size double, addr string, loaded_at timestamp"
T0 = dt.datetime(2026, 1, 1)


def row(n, k, vertical="a", name="x", size=1.0, addr=None, at=0):
    return (n, T0, k, vertical, name, size, addr, T0 + dt.timedelta(hours=at))


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return {(r.record_key, r.snapshot_no, r.change_kind) for r in changed_records(df, "k", json_columns=("addr",), **kw).collect()}


def test_absent_values_numbers_and_json_compare_by_meaning(spark):
    rows = [
        row(1, "p", name=None, size=None, addr='{"a": "1", "b": null}'), row(2, "p", name=" nan ", size=float("nan"), addr='{"a":"1"}'),
        row(1, "q", size=0.1234561, addr='{"a":"1","b":"2"}'), row(2, "q", size=0.1234564, addr='{"b": "2", "a": "1"}'),
        row(1, "r", name="x"), row(2, "r", name="x "), row(1, "s", addr="{broken"), row(2, "s", addr="{broken"),
    ]
    assert run(spark, rows) == {("r", 2, "changed")}


def test_latest_row_counts_repeats_once_and_null_keys_never(spark):
    rows = [row(1, "p", name="old", at=1), row(1, "p", name="new", at=2), row(1, "p", name="new", at=2), row(2, "p", name="new"), row(1, None), row(2, None, name="y"), row(None, "p")]
    assert run(spark, rows) == set()


def test_skipped_delivery_is_compared_with_the_last_one(spark):
    rows = [row(1, "p"), row(1, "q", vertical="b"), row(2, "q", vertical="b"), row(3, "p", name="z"), row(3, "n"), row(3, "q", vertical="b")]
    assert run(spark, rows) == {("p", 3, "changed"), ("n", 3, "added")}


def test_first_delivery_and_empty_table_yield_nothing(spark):
    assert run(spark, [row(1, "p"), row(1, "q")]) == set()
    assert run(spark, []) == set()


def test_against_brute_force_with_chunks_of_any_length(spark):
    rng = random.Random(4)
    state = {f"k{i:03}": ("a" if i % 3 else "b", rng.random()) for i in range(160)}
    rows, snaps = [], []
    for n in range(1, 5):
        for k in rng.sample(sorted(state), 12):
            state.pop(k)
        for k in rng.sample(sorted(state), 9):
            state[k] = (state[k][0], rng.random())
        state |= {f"n{n}{i}": ("a", 1.0) for i in range(5)}
        rows += [row(n, k, v, size=s) for k, (v, s) in state.items() if not (v == "b" and n == 2)]
        snaps.append({k: (v, s) for k, (v, s) in state.items() if not (v == "b" and n == 2)})
    want = set()
    for v in "ab":
        last = None
        for n, snap in enumerate(snaps, 1):
            now = {k: s for k, (g, s) in snap.items() if g == v}
            if not now:
                continue
            if last is not None:
                want |= {(k, n, "added") for k in now.keys() - last.keys()} | {(k, n, "removed") for k in last.keys() - now.keys()}
                want |= {(k, n, "changed") for k in now.keys() & last.keys() if round(now[k], 6) != round(last[k], 6)}
            last = now
    rng.shuffle(rows)
    for chunk, shards in ((1, 3), (8, 2), (1000, 1)):
        assert run(spark, rows, chunk_rows=chunk, shards=shards) == want
