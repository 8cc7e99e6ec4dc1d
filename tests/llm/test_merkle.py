"""Manifest against trees built by hand, closed-form places, proofs that fail when rows change."""

import hashlib
import zlib

import pytest

from dqlake.llm import merkle
from dqlake.llm.merkle import Manifest, append_all, fold_path, folded, height, parent, place
from dqlake.llm.queries import op13_merkle_manifest
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))


def up(nodes, arity=3):
    """(root, siblings of every leaf, left to right and level by level)."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for x, i in enumerate(own):
            f = i // arity * arity
            paths[x].append((nodes[f:i], nodes[i + 1:f + arity]))
        nodes = [h("".join(nodes[i:i + arity])) for i in range(0, len(nodes), arity)]
        own = [i // arity for i in own]
    return nodes[0], paths


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    groups = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for g in groups:
        by[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[g] = up([leaf(r, r[1]) for r in by[g]])
    root, above = up([trees[g][0] for g in groups])
    out = []
    for k, g in enumerate(groups):
        for r, path in zip(by[g], trees[g][1]):
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node, seen = leaf(r, r[1].replace("\n", "") if even and r[1] else r[1]), ""
            for left, right in path + above[k]:
                node = h("".join(left) + node + "".join(right))
                seen += "".join(left + right)
            out.append((r[0], leaf(r, r[1]), trees[g][0], root, h(seen), node, node == root))
    return sorted(out, key=str)


def run(spark, tmp_path, rows, monkeypatch, block=None):
    if block:
        monkeypatch.setattr(merkle, "BLOCK", block)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted([tuple(r) for r in op13_merkle_manifest(spark, str(tmp_path)).collect()], key=str)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_places_are_in_closed_form(arity):
    for n in [*range(1, 30), 80, 81, 82, 125]:
        leaves = [str(i).encode() for i in range(n)]
        top = height(n, arity)
        log, level, nodes = append_all(leaves, arity, top), 0, leaves
        while True:
            for i, node in enumerate(nodes):
                assert log[place(arity, level, min((i + 1) * arity ** level, n) - 1)] == node
            if len(nodes) == 1:
                break
            nodes, level = [parent(nodes[i:i + arity]) for i in range(0, len(nodes), arity)], level + 1
        assert level == top and log[-1] == nodes[0]


@pytest.mark.parametrize("block", [None, 3, 9])
def test_against_brute_force(spark, tmp_path, monkeypatch, block):
    """Several rounds of builders, a group of most rows, lone rows, null groups, repeated rows."""
    rows = [(i, f"line {i}\nnext", "en" if i % 3 else None, "big" if i % 4 else f"s{i % 20}", i) for i in range(150)]
    rows += [(500, None, None, None, None), (501, "", "", "", 0), (502, "x", "de", "é", 1), (7, "again\n", "en", "big", 1)]
    rows += [rows[1], rows[1], (None, "no id\n", "en", "big", 2), (None, "no id\n", "en", None, 2)]
    assert run(spark, tmp_path, rows, monkeypatch, block) == brute(rows)


def test_one_row_and_no_rows(spark, tmp_path, monkeypatch):
    rows = [(3, "a\nb", "en", "s", 3)]
    assert run(spark, tmp_path / "one", rows, monkeypatch) == brute(rows)
    assert run(spark, tmp_path / "none", [], monkeypatch) == []


def test_clashing_columns_and_long_text(spark):
    df = spark.createDataFrame([(i, "word " * 50_000, "g", 1, 2) for i in range(4)], "doc_id int, text string, source string, idx int, n int")
    made = Manifest(df, ["doc_id", "text", "idx"])
    proven = folded(made.proven().select("id", "leaf", "root", "path"), "leaf").collect()
    assert len(proven) == 4 and all(r.folded_root == r.root for r in proven)
    changed = Manifest(df.withColumn("idx", F.when(F.col("doc_id") == 2, 9).otherwise(F.col("idx"))), ["doc_id", "text", "idx"])
    assert changed.root.first() != made.root.first()


def test_any_change_breaks_its_proof(spark):
    df = spark.range(60).selectExpr("id AS doc_id", "concat('t', id) AS text", "'s' AS source")
    made = Manifest(df, ["doc_id", "text"], arity=4)
    for r in made.proven().collect():
        assert fold_path(r.leaf.encode(), r.path)[0].decode() == r.root
        assert fold_path(h("other").encode(), r.path)[0].decode() != r.root
