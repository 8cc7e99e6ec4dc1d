"""History against a plain reading of its definition, for any split and order."""

import random

import pytest
from pyspark.sql import functions as F

from dqlake.operators import (
    END, LAST, START, late_keys, scd1, scd2, scd2_check, scd2_from_snapshots, scd2_refresh, scd2_splice, snapshot_step,
    touched_versions, with_last, without,
)
from dqlake.operators.scd import _pieces, hot_keys
from dqlake.streaming import apply_changes, read_history

SCHEMA = "k string, day int, file string, status string, note string"


def random_feed(seed, keys=5, rows=120):
    rnd = random.Random(seed)
    out = []
    for i in range(rows):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(keys)}"
        out.append((key, rnd.randrange(12), f"f{rnd.randrange(3)}", rnd.choice(["a", "b", None]), f"n{i}"))
    return out


def expected(feed):
    """One dict pass per key: collapse equal neighbours, end each at the next start."""
    best = {}
    for k, day, file, status, note in feed:
        at, row = (k, day, file), (status is not None, status or "", note)
        best[at] = max(best.get(at, row), row)
    history = set()
    for key in {k for k, *_ in feed}:
        runs = []
        for (_, day, file), (known, status, note) in sorted(x for x in best.items() if x[0][0] == key):
            state = status if known else None
            if runs and runs[-1][0] == state:
                runs[-1][2] = note
            else:
                runs.append([state, (day, file), note])
        for i, (state, start, note) in enumerate(runs):
            history.add((key, state, note, start, runs[i + 1][1] if i + 1 < len(runs) else None))
    return history


def as_set(df):
    return {(r.k, r.status, r.note, tuple(r[START]), tuple(r[END]) if r[END] else None) for r in df.collect()}


OPTIONS = dict(sequence=["day", "file"], track_except=["note"])


@pytest.mark.parametrize("hot_rows", [None, 1_000_000, 20, 0])
def test_matches_definition(rows, hot_rows):
    feed = random_feed(1)
    got = scd2(rows(SCHEMA, *feed), ["k"], hot_rows=hot_rows, **OPTIONS)
    assert got.count() == len(expected(feed))
    assert as_set(got) == expected(feed)
    check = scd2_check(got, ["k"]).first()
    assert (check.duplicate_current_keys, check.missing_current_keys, check.invalid_intervals) == (0, 0, 0)


def test_hot_split_many_feeds(rows):
    for seed in range(2, 6):
        feed = random_feed(seed, keys=2, rows=60)
        assert as_set(scd2(rows(SCHEMA, *feed), ["k"], hot_rows=0, **OPTIONS)) == expected(feed)


def test_other_chunks_give_the_same(rows):
    feed = random_feed(11)
    for chunk in (F.floor(F.col("day") / 5), F.struct("day", "file"), F.lit(0)):
        assert as_set(scd2(rows(SCHEMA, *feed), ["k"], hot_rows=0, chunk=chunk, **OPTIONS)) == expected(feed)


@pytest.mark.parametrize("fine", ["day", "file"])
def test_hot_key_is_cut_into_bounded_pieces(rows, fine):
    """Many deliveries of a row each, or one delivery of many rows: pieces stay small and few."""
    feed = [("hot", *((i, "f") if fine == "day" else (0, f"f{i:05}")), "ab"[i // 7 % 2], "n") for i in range(2000)]
    df = rows(SCHEMA, *feed)
    given = df.select("k", F.struct("day", "file").alias("__start"))
    sizes = [r["count"] for r in _pieces(given, hot_keys(df, ["k"], 400), ["k"], 400).groupBy("__chunk").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 1000 and 5 <= len(sizes) <= 60
    assert as_set(scd2(df, ["k"], hot_rows=400, **OPTIONS)) == expected(feed)


def test_unique_sequence_needs_no_dedupe(rows):
    feed = [("k", d, "f", s, f"n{d}") for d, s in enumerate("aabbca")]
    for hot_rows in (None, 0):
        got = scd2(rows(SCHEMA, *feed), ["k"], hot_rows=hot_rows, unique=True, **OPTIONS)
        assert as_set(got) == expected(feed)


def test_missing_key_is_kept(rows):
    feed = [(None, 1, "f", "a", "x"), (None, 2, "f", "b", "y"), ("k", 1, "f", "a", "z")]
    for hot_rows in (None, 0):
        assert scd2(rows(SCHEMA, *feed), ["k"], hot_rows=hot_rows, **OPTIONS).count() == 3


def test_refresh_equals_rebuild(rows):
    feed = random_feed(7)
    old, new = feed[:70], feed[70:]
    df, batch = rows(SCHEMA, *feed), rows(SCHEMA, *new)
    got = scd2_refresh(scd2(rows(SCHEMA, *old), ["k"], **OPTIONS), df, batch.select("k").distinct(), ["k"], **OPTIONS)
    assert as_set(got) == expected(feed)


def test_refresh_keeps_changes_of_a_missing_key(rows):
    feed = [(None, 1, "f", "a", "x"), ("k", 1, "f", "a", "z"), (None, 2, "f", "b", "y"), (None, 3, "f", "c", "y")]
    log, batch = rows(SCHEMA, *feed), rows(SCHEMA, *feed[2:])
    old = scd2(rows(SCHEMA, *feed[:2]), ["k"], **OPTIONS)
    got = scd2_refresh(old, log, batch.select("k").distinct(), ["k"], **OPTIONS)
    assert as_set(got) == as_set(scd2(log, ["k"], **OPTIONS)) and got.count() == 4


def test_another_number_of_buckets_is_refused(spark, rows, tmp_path):
    source, paths = str(tmp_path / "in"), [str(tmp_path / p) for p in ("log", "history", "offsets")]
    rows(SCHEMA, ("k", 1, "f", "a", "x")).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    apply_changes(spark, stream, ["k"], ["day", "file"], *paths, buckets=3)
    with pytest.raises(ValueError, match="3 buckets"):
        apply_changes(spark, stream, ["k"], ["day", "file"], *paths, buckets=5)


def test_stream_in_any_order(spark, rows, tmp_path):
    feed = random_feed(8, rows=60)
    random.Random(0).shuffle(feed)
    source, paths = str(tmp_path / "in"), [str(tmp_path / p) for p in ("log", "history", "offsets")]
    for part in (feed[:20], feed[20:25], feed[25:]):
        rows(SCHEMA, *part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        apply_changes(spark, stream, ["k"], ["day", "file"], *paths, buckets=3, track_except=["note"])
    assert as_set(read_history(spark, paths[1])) == expected(feed)


def test_replayed_batch_changes_nothing(spark, rows, tmp_path):
    """A batch that ran but was not recorded in the offsets runs again."""
    feed = random_feed(9, rows=40)
    source, log, history = (str(tmp_path / p) for p in ("in", "log", "history"))
    rows(SCHEMA, *feed).coalesce(1).write.parquet(source)
    for offsets in ("first", "lost"):
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        apply_changes(spark, stream, ["k"], ["day", "file"], log, history, str(tmp_path / offsets),
                      buckets=3, track_except=["note"])
    assert as_set(read_history(spark, history)) == expected(feed)


def test_snapshots_see_deletes(rows):
    df = rows("k string, day int, status string", ("a", 1, "x"), ("a", 2, "x"), ("a", 4, "x"),
              ("b", 1, "x"), ("b", 2, "y"), ("c", 4, "z"), ("b", 4, "y"), ("d", 3, "q"))
    got = {(r.k, r.status, r[START], r[END]) for r in scd2_from_snapshots(df, ["k"], "day").collect()}
    assert got == {("a", "x", 1, 3), ("a", "x", 4, None), ("b", "x", 1, 2), ("b", "y", 2, 3),
                   ("b", "y", 4, None), ("c", "z", 4, None), ("d", "q", 3, 4)}


def test_change_feed_as_snapshots_loses_keys(rows):
    """The hazard: read as full snapshots, a change feed deletes whoever did not change last."""
    df = rows("k string, day int, status string", ("a", 1, "x"), ("b", 1, "x"), ("a", 2, "y"))
    right = scd2(df, ["k"], ["day"])
    wrong = scd2_from_snapshots(df, ["k"], "day")
    assert right.where(F.col(END).isNull()).count() == 2
    assert wrong.where(F.col(END).isNull()).count() == 1


def test_needs_tracked_columns(rows):
    with pytest.raises(ValueError):
        scd2(rows("k string, day int", ("a", 1)), ["k"], ["day"])


LASTING = {**OPTIONS, "track_except": ["note", LAST], "hot_rows": None}


def lasting(rows, feed):
    return scd2(with_last(rows(SCHEMA, *feed), OPTIONS["sequence"]), ["k"], **LASTING)


def spliced(rows, old, new):
    """History after ``new``, formed from ``old``'s versions and no more of the log than the splice asks for."""
    history, log, batch = lasting(rows, old), rows(SCHEMA, *old, *new), rows(SCHEMA, *new)
    gone = touched_versions(history, batch, ["k"], OPTIONS["sequence"])
    formed = scd2_splice(gone, log, batch, ["k"], hot_rows=None, **OPTIONS)
    return without(history, gone, ["k"]).unionByName(formed), gone, formed


@pytest.mark.parametrize("seed", range(5))
def test_splice_equals_rebuild(rows, seed):
    """Late rows, repeats, equal sequences, new keys, missing keys, states that come to agree."""
    rnd = random.Random(seed)
    feed = [(rnd.choice(["a", "b", None]), rnd.randrange(20), f"f{rnd.randrange(2)}", rnd.choice("ab"), f"n{i}") for i in range(60)]
    cut = rnd.choice([1, 20, 45, 57])
    got, _, _ = spliced(rows, feed[:cut], feed[cut:])
    assert sorted(map(str, got.collect())) == sorted(map(str, lasting(rows, feed).collect()))


def test_splice_touches_neighbours_only(rows):
    old = [("k", d, "f", "ab"[d // 5 % 2], f"n{d}") for d in range(100)]
    late = [("k", 52, "g", "z", "late")]
    got, gone, formed = spliced(rows, old, late)
    assert {r[START].day for r in gone.collect()} == {50, 55}
    assert {(r[START].day, r[START].file, r.status) for r in formed.collect()} == {(50, "f", "a"), (52, "g", "z"), (53, "f", "a"), (55, "f", "b")}
    assert as_set(got) == expected(old + late)


def test_batch_in_order_needs_no_log(rows):
    old, new = [("k", d, "f", "a", "x") for d in range(5)], [("k", 5, "f", "a", "y"), ("k", 6, "f", "b", "z"), ("new", 1, "f", "a", "q")]
    heads = lasting(rows, old).where(F.col(END).isNull())
    assert late_keys(heads, rows(SCHEMA, *new), ["k"], ["day", "file"]).count() == 0
    gone = touched_versions(heads, rows(SCHEMA, *new), ["k"], ["day", "file"])
    formed = scd2_splice(gone, rows(SCHEMA), rows(SCHEMA, *new), ["k"], hot_rows=None, **OPTIONS)
    assert as_set(without(heads, gone, ["k"]).unionByName(formed).drop(LAST)) == expected(old + new)


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("part-*.parquet")}


def test_work_of_a_batch_grows_with_the_batch(spark, rows, tmp_path):
    """In order: only open versions of the batch's buckets are rewritten, closed ones added. Late: the
    closed versions of the late key's bucket as well."""
    source, log, history, offsets = (str(tmp_path / p) for p in ("in", "log", "history", "offsets"))

    def deliver(feed):
        rows(SCHEMA, *feed).coalesce(1).write.mode("append").parquet(source)
        before = files(tmp_path / "history")
        apply_changes(spark, spark.readStream.schema(SCHEMA).parquet(source), ["k"], ["day", "file"], log, history, offsets,
                      buckets=16, track_except=["note"], hot_rows=None)
        after = files(tmp_path / "history")
        kept = {f for f in before if after.get(f) == before[f]}
        return {f.split("/history/")[1].rsplit("/", 1)[0] for f in after if f not in kept}, {
            f.split("/history/")[1].rsplit("/", 1)[0] for f in before if f not in kept}

    first = [(f"k{i}", d, "f", "ab"[d % 2], "x") for i in range(200) for d in range(3)]
    written, _ = deliver(first)
    assert len([f for f in written if f.startswith("part=open")]) == 16
    written, gone = deliver([("k7", 3, "f", "b", "y")])
    assert len(written) == 2 and len(gone) == 1 and all(f.startswith("part=open") for f in gone)
    written, gone = deliver([("k7", 1, "g", "c", "late")])
    assert len(written) == 2 and len(gone) == 2
    feed = [*first, ("k7", 3, "f", "b", "y"), ("k7", 1, "g", "c", "late")]
    assert as_set(read_history(spark, history)) == expected(feed)


def test_a_bucket_may_lose_its_closed_versions(spark, rows, tmp_path):
    """A late row of equal key and sequence wins and makes all rows agree: nothing closed is left."""
    source, paths = str(tmp_path / "in"), [str(tmp_path / p) for p in ("log", "history", "offsets")]
    feed = [("k", 1, "f", "a", "x"), ("k", 2, "f", "b", "y"), ("k", 1, "f", "b", "z")]
    for i in (0, 2):
        rows(SCHEMA, *feed[i:i + 2]).coalesce(1).write.mode("append").parquet(source)
        apply_changes(spark, spark.readStream.schema(SCHEMA).parquet(source), ["k"], ["day", "file"], *paths, buckets=1, track_except=["note"], hot_rows=None)
    got = as_set(read_history(spark, paths[1]))
    assert got == expected(feed) and len(got) == 1


def test_stream_in_any_order_with_compaction(spark, rows, tmp_path):
    feed = random_feed(21, rows=60)
    source, paths = str(tmp_path / "in"), [str(tmp_path / p) for p in ("log", "history", "offsets")]
    for i in range(0, 60, 15):
        rows(SCHEMA, *feed[i:i + 15]).coalesce(1).write.mode("append").parquet(source)
        apply_changes(spark, spark.readStream.schema(SCHEMA).parquet(source), ["k"], ["day", "file"], *paths, buckets=3,
                      track_except=["note"], compact_every=2, hot_rows=None)
    assert as_set(read_history(spark, paths[1])) == expected(feed)


@pytest.mark.parametrize("seed", range(2))
def test_snapshot_steps_equal_the_whole(rows, seed):
    """Newest snapshots one by one against all at once; null keys and null values are values."""
    rnd = random.Random(seed)
    data = [(rnd.choice(["a", "b", "c", None]), day, rnd.choice(["x", "y", None]), f"n{day}") for day in range(4) for _ in range(3)]
    df = rows("k string, day int, status string, note string", *data)
    whole = scd2_from_snapshots(df, ["k"], "day", ["note"])
    open_ = scd2_from_snapshots(df.where("day = 0"), ["k"], "day", ["note"])
    done = open_.limit(0)
    for day in range(1, 4):
        open_, closed = snapshot_step(open_, df.where(F.col("day") == day), ["k"], F.lit(day), ["note"])
        done = done.unionByName(closed)
    want = sorted(map(str, whole.collect()))
    assert sorted(map(str, done.unionByName(open_).collect())) == want and any("k=None" in r for r in want)


def test_latest_row_of_a_missing_key_is_kept(rows):
    df = rows("k string, day int, v string", (None, 1, "a"), (None, 2, "b"), ("k", 1, "c"))
    assert {tuple(r) for r in scd1(df, ["k"], ["day"]).collect()} == {(None, 2, "b"), ("k", 1, "c")}
