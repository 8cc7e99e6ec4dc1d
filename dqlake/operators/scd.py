"""Change history: slowly changing dimensions of type 1 and 2.

Order comes from a logical delivery sequence, never from arrival, so late
files splice into closed history by themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .resolve import dedupe_latest

START = "__START_AT"
END = "__END_AT"
# Sequence of the last row that agreed with a version; only in stored histories.
LAST = "__LAST_AT"

# Keys with more change rows than this are cut into ordered chunks.
HOT_ROWS = 1_000_000


def _struct(cols: Sequence[str]) -> Column:
    return F.struct(*cols) if cols else F.struct(F.lit(None).cast("string").alias("__none"))


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = left[keys[0]].eqNullSafe(right[f"__hot_{keys[0]}"])
    for k in keys[1:]:
        cond = cond & left[k].eqNullSafe(right[f"__hot_{k}"])
    return cond


def _merge_runs(rows: DataFrame, parts: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Merge neighbouring rows of equal state into one version.

    Input columns: ``__start`` (sequence), ``__state`` (tracked), ``__tail``
    (untracked), ``__end`` (known end or NULL), ``__forced`` (a change whatever
    the state). A version keeps the first start and the last tail, and ends
    where the next version of the group starts. One sort serves every window.
    """
    w = Window.partitionBy(*parts).orderBy(*[F.col(f"__start.{s}") for s in sequence])
    before = F.lag("__state").over(w)
    marked = rows.withColumns(
        {
            "__first": before.isNull(),
            "__opens": F.col("__forced") | ~F.col("__state").eqNullSafe(before),
        }
    ).withColumns(
        {
            "__closes": F.coalesce(F.lead("__opens").over(w), F.lit(True)),
            "__until": F.coalesce(F.col("__end"), F.lead("__start").over(w)),
        }
    )
    # Only the first and last row of a version matter; after this filter the
    # last row of a version directly follows its first.
    edges = marked.where(F.col("__opens") | F.col("__closes"))
    ends = edges.withColumns(
        {
            "__tail": F.when(F.col("__closes"), F.col("__tail")).otherwise(F.lead("__tail").over(w)),
            "__end": F.when(F.col("__closes"), F.col("__until")).otherwise(
                F.lead("__until").over(w)
            ),
        }
    )
    return ends.where(F.col("__opens")).drop("__opens", "__closes", "__until")


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows: fewer than rows / hot_rows of them."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > hot_rows)
        .select(*[F.col(k).alias(f"__hot_{k}") for k in keys])
    )


def _pieces(rows: DataFrame, hot: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Rows of hot keys with ``__chunk``, the piece of the key's history they are in.

    A piece begins at each sequence whose hash falls into a fixed share, so
    pieces hold ``hot_rows`` / 4 rows on average, whatever the sequence looks
    like, and a recomputed task cuts at the same places.
    """
    share = float(1 << 32) / max(1, hot_rows // 4)
    begins = F.pmod(F.xxhash64(*keys, "__start"), F.lit(1 << 32)) < F.lit(share)
    bounds = (
        rows.where(begins).join(hot, _same_key(rows, hot, keys), "left_semi")
        .groupBy(*keys).agg(F.sort_array(F.collect_list("__start")).alias("__bounds"))
        .withColumnsRenamed({k: f"__hot_{k}" for k in keys})
    )
    busy = rows.join(hot, _same_key(rows, hot, keys), "left_semi")
    busy = busy.join(bounds, _same_key(busy, bounds, keys), "left").drop(*[f"__hot_{k}" for k in keys])
    # bounds up to the row's sequence, by halving steps
    steps = F.array(*[F.lit(1 << i) for i in range(30, -1, -1)])
    count = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at <= F.size("__bounds") - step) & (F.get("__bounds", at + step - 1) <= F.col("__start")), at + step
    ).otherwise(at))
    return busy.withColumn("__chunk", F.when(F.col("__bounds").isNull(), 0).otherwise(count)).drop("__bounds")


def scd2(
    df: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    track_except: Sequence[str] = (),
    drop: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
    unique: bool = False,
    chunk: Column | None = None,
) -> DataFrame:
    """Type 2 history of an upsert-only change feed.

    One row per version, ``__START_AT`` / ``__END_AT`` being structs of the
    ``sequence`` columns; the current version has a NULL end. A change only in
    ``track_except`` columns opens no version but updates the open one. ``drop``
    columns are used for nothing but the sequence. Rows equal in key and
    sequence count once (the greatest row wins); ``unique`` states that there
    are none and saves the shuffle that looks for them.

    Keys above ``hot_rows`` rows go through two levels: versions within each
    chunk, then across the chunks, of which only the first and last version
    take part. So no task has to sort a whole hot key. Chunks are pieces of
    about ``hot_rows`` / 4 rows, or the values of ``chunk``: any expression that
    never falls along the sequence. The input is read once to count keys and
    once or twice per branch: pass a written table, not a long plan. None skips
    the split.
    """
    fixed = {*keys, *sequence, *track_except, *drop}
    tracked = [c for c in df.columns if c not in fixed]
    untracked = [c for c in df.columns if c in track_except and c not in (*sequence, *drop)]
    if not tracked:
        raise ValueError("scd2 needs at least one tracked column")

    given = [] if chunk is None else [chunk.alias("__chunk")]
    rows = df.select(*keys, *[F.col(s).alias(f"__seq_{s}") for s in sequence], *given,
                     _struct(sequence).alias("__start"), _struct(tracked).alias("__state"),
                     _struct(untracked).alias("__tail"))
    seq_cols = [f"__seq_{s}" for s in sequence]
    if not unique:
        one = Window.partitionBy(*keys, *seq_cols).orderBy(F.desc("__state"), F.desc("__tail"))
        rows = rows.withColumn("__rn", F.row_number().over(one)).where("__rn = 1").drop("__rn")
    rows = rows.withColumns({
        "__end": F.lit(None).cast(rows.schema["__start"].dataType),
        "__forced": F.lit(False),
    }).drop(*seq_cols)

    if hot_rows is None:
        versions = _merge_runs(rows, keys, sequence)
    else:
        hot = hot_keys(df, keys, hot_rows)
        cold = rows.join(hot, _same_key(rows, hot, keys), "left_anti")
        busy = (_pieces(rows, hot, keys, hot_rows) if chunk is None
                else rows.join(hot, _same_key(rows, hot, keys), "left_semi"))
        local = _merge_runs(busy, [*keys, "__chunk"], sequence).drop("__chunk")
        outer = F.col("__first") | F.col("__end").isNull()
        # A chunk's last version, unless it is also its first, follows another
        # version of the same chunk and so is a change by itself.
        seams = local.where(outer).withColumn("__forced", ~F.col("__first") & F.col("__end").isNull())
        versions = (
            _merge_runs(cold.drop("__chunk"), keys, sequence)
            .unionByName(local.where(~outer))
            .unionByName(_merge_runs(seams, keys, sequence))
        )

    kept = [c for c in df.columns if c in keys or c in tracked or c in untracked]
    where = {**{c: f"__state.{c}" for c in tracked}, **{c: f"__tail.{c}" for c in untracked}}
    return versions.select(
        *[F.col(where.get(c, c)).alias(c) for c in kept],
        F.col("__start").alias(START),
        F.col("__end").alias(END),
    )


def current(df: DataFrame) -> DataFrame:
    """Open versions of a type 2 history."""
    return df.where(F.col(END).isNull())


def scd1(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Latest row per key by the delivery sequence; a NULL key is a key like any other, as in ``scd2``."""
    return dedupe_latest(df, keys, sequence, drop_missing=False)


def scd2_refresh(
    history: DataFrame, log: DataFrame, touched: DataFrame, keys: Sequence[str], **options
) -> DataFrame:
    """History after a batch: only the touched keys are rebuilt, from their full log.

    ``log`` holds every accepted change row including the batch, ``touched``
    the distinct keys of the batch. A NULL key is a key like any other, as in ``scd2``.
    """
    marked = touched.select(*[F.col(k).alias(f"__hot_{k}") for k in keys])
    kept = history.join(marked, _same_key(history, marked, keys), "left_anti")
    rebuilt = scd2(log.join(marked, _same_key(log, marked, keys), "left_semi"), keys, **options)
    return kept.unionByName(rebuilt)


def _keyed(df: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Keys under the names that ``_same_key`` expects on its right side."""
    return df.select(*[F.col(k).alias(f"__hot_{k}") for k in keys], *more)


def batch_span(batch: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """First and last sequence of the batch per key, as ``__low`` and ``__high``."""
    at = _struct(sequence)
    return batch.groupBy(*keys).agg(F.min(at).alias("__low"), F.max(at).alias("__high"))


def late_keys(history: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Keys of the batch with a row that does not follow the last row of their open version."""
    span = _keyed(batch_span(batch, keys, sequence), keys, F.col("__low"))
    heads = history.where(F.col(END).isNull())
    return heads.join(span, _same_key(heads, span, keys)).where(F.col("__low") <= F.col(LAST)).select(*keys)


def touched_versions(history: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Versions that the rows of a batch fall into, meet the end of or come right before.

    ``history`` must carry ``LAST`` (see ``with_last``) and hold the keys of the batch: their open
    versions where every row of the batch follows them, all versions where one is late. Added are the first
    sequence of the batch, and ``__behind``: the open version that all rows of the key follow.
    """
    span = _keyed(batch_span(batch, keys, sequence), keys, F.col("__low"), F.col("__high"))
    names = [f"__hot_{k}" for k in keys]
    own = history.join(span, _same_key(history, span, keys)).drop(*names)
    # the first version after the batch's rows may continue what they end with
    later = F.min(F.when(F.col(START) > F.col("__high"), F.col(START)))
    after = _keyed(own.groupBy(*keys).agg(later.alias("__after")), keys, F.col("__after"))
    met = own.join(after, _same_key(own, after, keys)).drop(*names)
    around = (F.col(START) <= F.col("__high")) & (F.col(END).isNull() | (F.col(END) >= F.col("__low")))
    behind = F.col(END).isNull() & (F.col(LAST) < F.col("__low"))
    near = met.where(around | F.coalesce(F.col(START) == F.col("__after"), F.lit(False)))
    return near.withColumn("__behind", behind).drop("__high", "__after")


def late_stretches(touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sequences between which the versions of late keys change: from ``__from`` up to, without,
    ``__to`` (NULL: no end)."""
    each = touched.groupBy(*keys).agg(
        F.min(F.least(START, "__low")).alias("__from"), F.max(END).alias("__to"),
        F.bool_or(F.col(END).isNull()).alias("__open"), F.bool_and("__behind").alias("__behind"))
    return each.where("not __behind").select(*keys, "__from", F.when(~F.col("__open"), F.col("__to")).alias("__to"))


def scd2_splice(
    touched: DataFrame, log: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: Sequence[str],
    track_except: Sequence[str] = (), drop: Sequence[str] = (), hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """The versions that stand in place of the ``touched_versions`` of a history; all others stay.

    A key whose rows all come after its open version is carried on from that version alone. For a late
    key the stretch is formed from ``log`` (the accepted changes, this batch included) between the version
    before its first row and the end of the one after its last: the log is read within those sequences, and
    what lies outside can't change. The result equals a rebuild from the whole log. ``touched`` is used
    several times: pass a written table.
    """
    late = late_stretches(touched, keys)
    stretch = _keyed(late, keys, F.col("__from"), F.col("__to"))
    at, cols = _struct(sequence), batch.columns
    rows = log.select(*cols)
    rows = rows.join(stretch, _same_key(rows, stretch, keys)).where(
        (at >= F.col("__from")) & (F.col("__to").isNull() | (at < F.col("__to")))).select(*cols)
    # the rows of all other keys, and the open versions they follow as a row at their start
    fresh = batch.join(stretch, _same_key(batch, stretch, keys), "left_anti")
    given = {s: F.col(f"{START}.{s}") for s in sequence}
    none = {c: F.lit(None).cast(batch.schema[c].dataType) for c in cols if c not in touched.columns}
    heads = touched.where("__behind").select(*[given.get(c, none.get(c, F.col(c))).alias(c) for c in cols], F.col(LAST))
    points = with_last(rows.unionByName(fresh), sequence).unionByName(heads)
    made = scd2(points, keys, sequence, [*track_except, LAST], drop, hot_rows)
    ends = _keyed(late, keys, F.col("__to"))
    made = made.join(ends, _same_key(made, ends, keys), "left")
    names = [c for c in touched.columns if c not in ("__low", "__behind")]
    return made.withColumn(END, F.coalesce(END, "__to")).select(*names)


def with_last(df: DataFrame, sequence: Sequence[str]) -> DataFrame:
    """Change rows with their sequence as ``LAST``: kept as an untracked column, a version then says
    which row was the last that agreed with it."""
    return df.withColumn(LAST, _struct(sequence))


def without(history: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``history`` without the versions a splice replaces."""
    names = _keyed(gone, keys, F.col(START).alias("__gone"))
    return history.join(names, _same_key(history, names, keys) & (history[START] == names["__gone"]), "left_anti")


def scd2_from_snapshots(
    df: DataFrame, keys: Sequence[str], snapshot: str, track_except: Sequence[str] = ()
) -> DataFrame:
    """Type 2 history of successive full snapshots: a missing key was deleted.

    Wrong for feeds of changes only, where every key not in the last delivery
    would count as deleted. A key has at most one row per snapshot after
    deduplication, so a group is no larger than the number of deliveries. A NULL
    key is a key like any other; rows without a snapshot date belong to no delivery.
    To take in a newest snapshot alone, see ``snapshot_step``.
    """
    tracked = [c for c in df.columns if c not in (*keys, snapshot, *track_except)]
    rows = dedupe_latest(df.where(F.col(snapshot).isNotNull()), [*keys, snapshot], [], drop_missing=False)
    # The delivery calendar is one array: a value per delivery, a few thousand at most.
    days = df.agg(F.array_sort(F.collect_set(snapshot)).alias("__days"))
    calendar = days.select(F.posexplode("__days").alias("__i", "__at"), "__days").select(
        "__at", F.get("__days", F.col("__i") + 1).alias("__next"))
    rows = (
        rows.join(calendar, rows[snapshot] == calendar["__at"])
        .withColumn("__state", _struct(tracked))
    )
    w = Window.partitionBy(*keys).orderBy("__at")
    goes_on = F.col("__state").eqNullSafe(F.lag("__state").over(w)) & (
        F.lag("__next").over(w) == F.col("__at")
    )
    marked = rows.withColumn("__opens", ~F.coalesce(goes_on, F.lit(False)))
    marked = marked.withColumn("__closes", F.coalesce(F.lead("__opens").over(w), F.lit(True)))
    edges = marked.where(F.col("__opens") | F.col("__closes"))
    end = F.when(F.col("__closes"), F.col("__next")).otherwise(F.lead("__next").over(w))
    untracked = [c for c in df.columns if c in track_except]
    last = {c: F.when(F.col("__closes"), F.col(c)).otherwise(F.lead(c).over(w)) for c in untracked}
    return (
        edges.withColumns({"__end": end, **last})
        .where(F.col("__opens"))
        .select(*keys, *tracked, *untracked, F.col("__at").alias(START), F.col("__end").alias(END))
    )


def snapshot_step(
    open_versions: DataFrame, snapshot_rows: DataFrame, keys: Sequence[str], at: Column, track_except: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(still open, closed now)`` after the newest full snapshot, delivered ``at``.

    Only open versions take part, in one join by key. Rows of equal tracked columns carry on and take
    the snapshot's untracked ones; changed keys close and open anew; keys not in the snapshot close; new
    keys open. NULL keys and NULL values compare as values. Of rows equal in key the greatest counts.
    ``open_versions`` has the columns that ``scd2_from_snapshots`` gives.
    """
    tracked = [c for c in open_versions.columns if c not in (*keys, START, END, *track_except)]
    untracked = [c for c in open_versions.columns if c in track_except]
    rows = dedupe_latest(snapshot_rows.select(*keys, *tracked, *untracked), keys, [], drop_missing=False)
    old = open_versions.select(*keys, _struct(tracked).alias("__was"), _struct(untracked).alias("__tail"), F.col(START))
    new = _keyed(rows, keys, _struct(tracked).alias("__is"), _struct(untracked).alias("__now"))
    met = old.join(new, _same_key(old, new, keys), "full_outer")
    same = F.col("__was").isNotNull() & F.col("__is").isNotNull() & F.col("__was").eqNullSafe(F.col("__is"))
    at = at.cast(open_versions.schema[START].dataType)

    def version(key: str, state: str, tail: str, start: Column, end: Column) -> list[Column]:
        return [*[F.col(f"{key}{k}").alias(k) for k in keys], *[F.col(f"{state}.{c}").alias(c) for c in tracked],
                *[F.col(f"{tail}.{c}").alias(c) for c in untracked], start.alias(START), end.alias(END)]

    none = F.lit(None).cast(open_versions.schema[END].dataType)
    here = met.where(F.col("__is").isNotNull())
    carried = here.select(*version("__hot_", "__is", "__now", F.when(same, F.col(START)).otherwise(at), none))
    closed = met.where(F.col("__was").isNotNull() & ~same).select(*version("", "__was", "__tail", F.col(START), at))
    return carried, closed


def scd2_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of integrity counts of a type 2 history; the defects must be 0."""
    is_current = F.col(END).isNull()
    bad = F.col(END).isNotNull() & (F.col(END) <= F.col(START))
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__versions"),
        F.count_if(is_current).alias("__current"),
        F.count_if(bad).alias("__bad"),
    )
    return per_key.agg(
        F.count_if(F.col("__current") > 1).alias("duplicate_current_keys"),
        F.count_if(F.col("__current") == 0).alias("missing_current_keys"),
        F.coalesce(F.sum("__bad"), F.lit(0)).alias("invalid_intervals"),
        F.coalesce(F.sum("__current"), F.lit(0)).alias("current_versions"),
        F.coalesce(F.sum(F.col("__versions") - F.col("__current")), F.lit(0)).alias(
            "historical_versions"
        ),
        F.count(F.lit(1)).alias("distinct_keys"),
    )
