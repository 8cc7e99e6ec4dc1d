"""Line dedup against brute force, the perfect hash by its definition, odd input."""

from collections import defaultdict

import numpy as np
import pytest

from dqlake.llm import line_dedup
from dqlake.llm.line_dedup import PerfectHash, drop_common_lines, line_refs, line_index, probe


def brute(rows, min_docs, min_chars=1):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    docs = defaultdict(set)
    for n, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            docs[key(line)].add(n)
    common = {k for k, v in docs.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) not in common]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def got(df, *args, **options):
    return sorted([tuple(r) for r in drop_common_lines(df, *args, **options).collect()], key=str)


ROWS = ([(i, f"Shared Line \nown {i}\n\n nbsp line\nonly {i % 7}\n shared line\t") for i in range(40)]
        + [(100, None), (101, ""), (102, "\n"), (103, "SHARED LINE"), (104, "É\né\n日本"), (105, "日本"), (106, "日本\r\nx")])


@pytest.mark.parametrize("min_docs", [1, 2, 3, 6, 40, 41, 100])
def test_against_brute_force(spark, min_docs):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert got(df, min_docs) == brute(ROWS, min_docs)


def test_shards_lanes_and_short_keys(spark, monkeypatch):
    """Small shards, and every shard copied to several lanes."""
    monkeypatch.setattr(line_dedup, "SHARD", 2)
    monkeypatch.setattr(line_dedup, "LANE", 1)
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5)
    assert got(df, 3, min_chars=3) == brute(ROWS, 3, 3)


def test_odd_input(spark, odd_docs, no_docs):
    """Null and repeated ids, clashing columns: every row is a document; an empty table gives none."""
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(odd_docs, 2) == brute(rows, 2)
    assert got(no_docs) == []
    named = spark.createDataFrame([("a", "x\ny", 1), ("b", "x", 2)], "doc_id string, text string, first int")
    assert got(named, 2) == [("a", 2, 1, "y"), ("b", 1, 1, "")]
    with pytest.raises(ValueError):
        drop_common_lines(odd_docs, 2, 0)


def test_one_long_text_and_one_hot_line(spark):
    rows = [(0, "\n".join(["hot"] * 20_000 + ["cold"]))] + [(i, "hot\nwarm") for i in range(1, 300)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), 300) == brute(rows, 300)


def test_perfect_hash_is_minimal():
    r = np.random.default_rng(1)
    a, b = (r.integers(0, 1 << 63, 5000).astype(np.uint64) for _ in range(2))
    a[:100] = a[0]  # keys may share their first half
    made = PerfectHash.read(PerfectHash.build(a, b).dump())
    assert sorted(made.places(a, b)) == list(range(5000))
    assert len(PerfectHash.build(a[:0], b[:0]).levels) == 0


def test_foreign_lines_are_told_by_their_fingerprints(spark):
    own = spark.createDataFrame([(i, "one\ntwo") for i in range(5)], "rid long, text string")
    other = spark.createDataFrame([(9, "two\nthree\nfour")], "rid long, text string")
    index = line_index(line_refs(own), 2)
    assert [tuple(r) for r in probe(line_refs(other), index, 2, 5).collect()] == [(9, 0)]
