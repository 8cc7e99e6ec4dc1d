import pytest
from pyspark.sql import functions as F

from dqlake import operators as o
from dqlake.functions import n, normalize_key
from dqlake.operators import rules as r
from dqlake.sources import rescue


def tuples(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


def test_rules_keep_all_failures_in_order(rows):
    df = rows("a string, b int, ref string", ("x", 5, "x"), (None, 50, None), ("y", None, None))
    checked = o.validate(df, [r.missing("no_a", "a"), r.between("b_range", "b", 0, 10), r.unknown("a_unknown", "a", "ref")])
    got = {x.a: (x._dq_failures, x._is_valid) for x in checked.collect()}
    assert got == {"x": ([], True), None: (["no_a", "b_range"], False), "y": (["b_range", "a_unknown"], False)}
    good, bad = o.route(checked, F.lit("2026-01-01"))
    assert good.columns == ["a", "b", "ref"] and good.count() + bad.count() == 3
    assert {x.dq_failure_reasons for x in bad.collect()} == {"no_a;b_range", "b_range;a_unknown"}


@pytest.mark.parametrize("make,fails", [
    (lambda: r.before("x", "a", "b"), [True, False, False, False]),
    (lambda: r.mismatch("x", "a", "b"), [True, True, False, False]),
    (lambda: r.not_in("x", "a", (1, 5)), [False, False, False, True]),
    (lambda: r.not_in("x", "a", (1,), null_fails=False), [False, True, True, False]),
    (lambda: r.between("x", "a", 0, 4, null_fails=False), [False, True, True, False]),
    (lambda: r.bad_range("x", "b", "a", "b"), [False, True, False, True]),
])
def test_rule_templates(rows, make, fails):
    df = rows("i int, a int, b int", (0, 1, 2), (1, 5, 3), (2, 5, 5), (3, None, 1))
    got = o.validate(df, [make()]).orderBy("i").collect()
    assert [not x._is_valid for x in got] == fails


def test_warnings_are_three_valued(rows):
    df = o.warn(rows("rank int, serious string", (3, "NO"), (None, "NO"), (1, None)),
                {"w": (F.col("rank") == 3) & (F.col("serious") == "NO")})
    assert [x.w for x in df.collect()] == [True, None, False]


def test_lookup_never_changes_the_grain(rows):
    facts = rows("id int, k string", (1, "a"), (2, None), (3, "zz"), (4, "a"))
    ref = o.reference(rows("k string, v string", (" a ", "1"), ("A", "2"), ("-", "9"), (None, "8")),
                      {"_k": normalize_key("k")}, {"_v": F.col("v")})
    assert tuples(ref) == [("A", "2")]
    keyed = facts.withColumn("k", normalize_key("k"))
    for spread in ((), ("id",)):
        got = o.lookup(keyed, ref, {"k": "_k"}, spread)
        assert tuples(got.select("id", "_v")) == [(1, "2"), (2, None), (3, None), (4, "2")]


def test_lookup_survives_without_broadcast(spark, rows):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(
            F.concat(F.lit("K"), F.col("id") % 10)).alias("k"))
        ref = rows("_k string, _v int", *[(f"K{i}", i) for i in range(0, 10, 2)])
        got = o.lookup(facts, ref, {"k": "_k"}, ("id",))
        assert got.count() == 1000
        assert got.where("k is null and _v is not null").count() == 0
        assert got.where("_v is not null").count() == facts.where("k in ('K0','K2','K4','K6','K8')").count()
        # Rows without a key do not meet in one partition.
        parts = (got.where("k is null").select(F.spark_partition_id().alias("p")).distinct().count())
        assert parts > 1 or got.rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_fallback(rows):
    df = rows("city string, land string", ("A", "X"), ("B", "X"), ("C", "Z"))
    geo = rows("gc string, gl string, gr string", ("A", "X", "city"))
    lands = rows("l string, lr string", ("X", "land"))
    got = o.lookup_fallback(df, [(geo, {"city": "gc", "land": "gl"}, "gr"), (lands, {"land": "l"}, "lr")], "region", "UNMAPPED")
    assert tuples(got) == [("A", "X", "city"), ("B", "X", "land"), ("C", "Z", "UNMAPPED")]


def test_dedupe_latest_is_total(rows):
    df = rows("k string, at int, v string", (" a", 1, "x"), ("A", 2, "y"), ("a", 2, "z"), ("-", 9, "q"), (None, 9, "q"))
    got = o.dedupe_latest(df, {"k": normalize_key("k")}, ["at"])
    assert tuples(got) == [("a", 2, "z")]
    assert got.count() == 1


def test_orphans_and_reissued(rows):
    child = rows("k string", ("a",), ("b",), (None,), ("b",))
    parent = rows("p string", ("a",), (None,))
    assert tuples(o.orphans(child, parent, {"k": "p"})) == [("b",), ("b",)]
    assert tuples(o.reissued_keys(child, parent.toDF("k"), "k")) == [("a", 1, True), ("b", 2, False)]


def test_rescue_loses_nothing(rows):
    df = rescue(rows("id string, a string, b string", ("1", "5", "x"), ("2", None, "1.5"), ("3", "q", "r")), {"a": "int", "b": "double"})
    assert tuples(df) == [("1", 5, None, '{"b":"x"}'), ("2", None, 1.5, None), ("3", None, None, '{"a":"q","b":"r"}')]


def test_gate_is_empty_when_all_pass(rows):
    df = rows("k string", ("a",))
    assert o.gate({"x": df.where("false"), "y": df.where("k = 'b'")}).count() == 0
    assert tuples(o.gate({"x": df, "y": df.where("false")})) == [("x", 1)]


def test_mapping_coverage(rows):
    df = rows("raw string", ("m",), ("m",), ("q",), ("u",), (None,))
    ref = rows("k string, v string", ("m", "M"), ("q", "A"), ("q", "B"))
    got = o.mapping_coverage(df, F.col("raw"), ref, "k", "v")
    assert tuples(got) == [("m", 2, "M", 1, "MAPPED"), ("q", 1, "A,B", 2, "AMBIGUOUS"), ("u", 1, "", 0, "UNMAPPED")]


def test_sum_constraint_and_conflicts(rows):
    arms = rows("study string, arm string, pct int", ("1", "A", 50), ("1", "B", 50), ("2", "A", 90))
    assert tuples(o.sum_constraint(arms, ["study"], "pct", 100, 0.0001)) == [("2", 90)]
    got = o.reference_conflicts(arms, {"study": F.col("study")}, [F.col("arm")])
    assert tuples(got) == [("1", 2)]


def test_requarantine(rows):
    def check(df):
        return o.validate(df, [r.between("range", "v", 0, 10)])
    rejected = o.quarantine(check(rows("k string, v int", ("a", 50), ("b", 5), ("c", 12))), F.lit("2026-01-01"))
    good, bad = o.requarantine(rejected, lambda d: check(d.withColumn("v", F.col("v") - 5)), F.lit("2026-01-02"))
    assert tuples(good) == [("c", 7)] and [x.k for x in bad.collect()] == ["a"]


def test_rank_within_bounds_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    ranked = o.rank_within(df, ["g"], [F.desc("v")], 2)
    assert ranked.count() == 6
    assert "WindowGroupLimit" in ranked._jdf.queryExecution().executedPlan().toString()


def test_calendar_and_running_sum(spark):
    df = spark.sql("SELECT 'a' AS g, DATE'2026-01-01' AS s, DATE'2026-04-01' AS e")
    months = o.calendar(df, "s", "e", "m").withColumn("v", F.month("m"))
    got = o.running_sum(months, ["g"], "m", {"c": "v"}).orderBy("m").collect()
    assert [x.c for x in got] == [1, 3, 6, 10]


def test_profile_top(rows):
    df = rows("k string", ("a",), ("b",), ("b",), ("c",), ("c",))
    assert tuples(o.profile_top(df, "k", 2, {"c": n()})) == [("b", 2), ("c", 2)]


def test_hot_key_is_split_in_large_lookups(spark):
    """A third of the rows share one key: the join reads their partition in pieces."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "32",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 200_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), F.col("id") % 997)).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        ref = spark.range(997).select(F.concat(F.lit("K"), "id").alias("_k"), F.col("id").alias("_v"))
        ref = ref.union(spark.createDataFrame([("HOT", -1)], "_k string, _v bigint"))
        got = o.lookup(facts, ref, {"k": "_k"})
        per_group = got.groupBy("_v").agg(n().alias("c"), F.max("payload"))
        counts = {x["_v"]: x.c for x in per_group.collect()}
        assert counts[-1] == 66_667 and sum(counts.values()) == 200_000 and None not in counts
        assert "skew=true" in per_group._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_orphan_counts_with_a_hot_key(rows):
    child = rows("k string", *[("gone",)] * 50, ("a",), (None,))
    parent = rows("p string", ("a",))
    assert tuples(o.orphan_counts({"r": (child, parent, {"k": "p"}), "s": (child, child, {"k": "k"})})) == [("r", 50), ("s", 0)]


def test_lookup_keeps_rows_without_a_key_out_of_the_join(rows):
    """All of them equal, so that no other column could spread them."""
    df = rows("k string, j string, v int", *[(None, None, None)] * 50, ("a", "x", 1), ("b", None, 2), ("c", "x", 3))
    ref = rows("rk string, rj string, name string", ("a", "x", "A"), ("c", "y", "C"))
    for on in ({"k": "rk"}, {"k": "rk", "j": "rj"}):
        split = o.lookup(df, ref, on, split_nulls=True)
        assert split.columns == [*df.columns, *ref.columns]
        assert sorted(map(str, split.collect())) == sorted(map(str, o.lookup(df, ref, on).collect()))
        joins = split._jdf.queryExecution().optimizedPlan().toString().split("Join")
        assert "isnotnull(k" in joins[1].replace("IsNotNull", "isnotnull")


LOG = [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("a", 3, "y"), ("b", 1, None), ("b", 2, "x"), (None, 1, "q")]


def kept(rows, history, log=LOG):
    df = rows("k string, day int, v string", *log)
    return o.conservation(history, df, ["k"], ["day"], hot_rows=None).first().asDict()


def test_conservation_counts_what_opened_no_version(rows):
    history = o.scd2(rows("k string, day int, v string", *LOG), ["k"], ["day"])
    assert kept(rows, history) == {"accepted_rows": 7, "repeated_rows": 1, "unchanged_rows": 1, "expected_versions": 5,
                                   "lost_keys": 0, "unknown_keys": 0, "changed_keys": 0}


def test_conservation_takes_the_winner_of_a_sequence(rows):
    # reissued under the same sequence with another state: the history keeps the greatest row
    log = [(f"k{i}", 1, v) for i in range(30) for v in ("a", None, f"z{i}")]
    history = o.scd2(rows("k string, day int, v string", *log), ["k"], ["day"])
    assert kept(rows, history, log) == {"accepted_rows": 90, "repeated_rows": 60, "unchanged_rows": 0, "expected_versions": 30,
                                        "lost_keys": 0, "unknown_keys": 0, "changed_keys": 0}


def test_conservation_sees_a_cut_history(rows):
    history = o.scd2(rows("k string, day int, v string", *LOG), ["k"], ["day"])
    assert kept(rows, history.where("NOT (k <=> 'a' AND v = 'y')"))["changed_keys"] == 1
    assert kept(rows, history.where("k IS NOT NULL"))["lost_keys"] == 1
    assert kept(rows, history, LOG[:-1])["unknown_keys"] == 1
    changed = history.withColumn("v", F.when(F.col("k") == "b", F.lit("x")).otherwise(F.col("v")))
    assert kept(rows, changed)["changed_keys"] == 1
    balance = {}
    for name, h in (("whole", history), ("cut", history.where("NOT (k <=> 'a' AND v = 'y')"))):
        df = rows("k string, day int, v string", *LOG)
        check = o.conservation(h, df, ["k"], ["day"], hot_rows=None)
        balance[name] = o.reconcile({"s": o.Layers(df, h, df.where("false"), check)}, "k").first()
    assert balance["whole"].balanced_flag and not balance["cut"].balanced_flag
    assert (balance["whole"].collapsed_records, balance["whole"].current_records, balance["whole"].distinct_keys) == (2, 3, 2)


def test_layer_changes(rows):
    def state(*keys):
        return rows("k string, f string", *keys)
    before = {"silver": state(("a", "1"), ("b", "1")), "quarantine": state(("c", "1"), ("d", "1"), ("d", "1"))}
    after = {"silver": state(("a", "1"), ("b", "1"), ("c", "1"), ("e", "2"), (None, "2")), "quarantine": state(("d", "1"), ("f", "2"))}
    got = {(r.layer, r.k): (r.rows_before, r.rows_after, r.change, r.moved_from) for r in o.layer_changes(before, after, "k", "f").collect()}
    assert got == {("silver", "c"): (0, 1, "new", "quarantine"), ("silver", "e"): (0, 1, "new", None), ("silver", None): (0, 1, "new", None),
                   ("quarantine", "c"): (1, 0, "lost", None), ("quarantine", "d"): (2, 1, "fewer", None), ("quarantine", "f"): (0, 1, "new", None)}
    assert o.layer_changes(before, before, "k").count() == 0


def test_only_rows_of_the_new_parent_are_tested(rows):
    raw = o.with_row_id(rows("id int, p string", (1, "x"), (2, "y"), (2, "y"), (3, None), (4, "z")))
    known = {"x"}

    def check(df):
        return o.validate(df, [r.Rule("unknown_p", F.col("p").isNotNull() & ~F.col("p").isin(*known)), r.missing("missing_p", "p")])
    index = o.waiting_index(o.quarantine(check(raw), F.lit("2026-01-01")), {"unknown_p": "p"})
    assert sorted(x.parent_key for x in index.collect()) == ["y", "y", "z"]
    known.add("y")
    tested = o.retest(raw, o.arrived(index, {"unknown_p": rows("k string", ("x",), ("y",), (None,))}), check)
    assert [(x.id, x._is_valid) for x in tested.collect()] == [(2, True), (2, True)]


def test_lineage_and_files_per_key(rows):
    df = rows("_source_file string, k string, f string", ("a", "1", "x"), (None, "1", "y"), (None, "1", "y"), (None, "2", "x"))
    assert tuples(o.lineage_completeness(df, ["_source_file", "k"])) == [("_source_file", 3, 4), ("k", 0, 4)]
    assert o.key_history_summary(df, "k", "f").first().max_files_per_key == 2


def test_relations_with_a_repeated_parent(rows):
    """A parent key that comes twice must not count a child twice."""
    child = rows("p string, study string", ("a", "1"), ("a", "2"), ("b", "1"), (None, "1"))
    parent = rows("k string, s string", ("a", "1"), ("a", "1"), ("c", "3"))
    got = o.relation_profile(child, [o.Relation("parent", parent, {"p": "k"}, {"study": "s"})]).first()
    assert (got.total_rows, got.parent_missing, got.parent_unknown, got.parent_study_mismatch, got.all_valid_rows) == (4, 1, 1, 1, 1)
