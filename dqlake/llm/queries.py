"""Registered queries of this subpackage, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    brown_lm, decontam, hard_negatives, licenses, line_dedup, merkle, ngram_join, packing, pii, quality, repeats, topk,
    toxicity,
)

#: Only for the registered query: real surrogates need a key of one's own.
DEMO_KEY = b"a key for the registered query"
TOXIC_FROM = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(parts: int, id_col: str = "doc_id") -> Column:
    """Whether a row is in the held-out part: crc32 of its id as text leaves 2."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts)) == 2


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), DEMO_KEY).select("doc_id", "n_entities", "text")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), 4, 85)


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~fold(4))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold(4), F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= TOXIC_FROM).cast("int").alias("predicted"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_spans(table(spark, sf_dir, "documents"), 400).drop("removed")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs))


def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return brown_lm.class_scores(docs, ~fold(7)).select(
        "doc_id", fold(7).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"), 10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row is proven against the root; rows of an even crc32 are first tampered with."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = merkle.leaf_hash(*[F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in columns])
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    given = F.when(even, tampered).otherwise(merkle.leaf_hash(*[F.col(c) for c in columns]))
    made = merkle.Manifest(table(spark, sf_dir, "documents"), columns, carry={"given": given})
    return merkle.folded(made.proven().select("id", "leaf", "subroot", "root", "given", "path"), "given").select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_license_scan, op2_pii_surrogates, op3_ngram_jaccard, op4_exact_topk, op5_best_fit_packing, op6_toxicity,
    op7_suffix_array_dedup, op8_decontamination, op9_quality, op10_class_lm, op11_line_dedup, op12_hard_negatives,
    op13_merkle_manifest)}

def merkle_sql(deep: int, high: int) -> str:
    """Twin of op13: trees of at most ``deep`` levels below and ``high`` above the sources' roots, level by
    level; a tree that has reached its root stays as it is. crc32 is written out, bit by bit."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
    row = " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    bare = row.replace(" text ", " replace(text, chr(10), '') ").replace("(text AS", "(replace(text, chr(10), '') AS")
    crc = """list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
        ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END)"""
    # the last step of crc32 turns every bit round: even where the register is odd
    steps = [f"""
        a AS (SELECT *, sha256({row}) AS leaf, sha256(CASE WHEN ({crc}) & 1 = 1 THEN {bare} ELSE {row} END) AS given,
                     coalesce('=' || source, '-') AS g FROM documents),
        d0 AS (SELECT doc_id, g, leaf, given AS fold, '' AS proof, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM a),
        t0 AS (SELECT g, i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM d0)"""]
    lift = """
        {t}{l} AS MATERIALIZED (SELECT g, j AS i, CASE WHEN min(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h,
                     count(*) OVER (PARTITION BY g) AS n FROM (SELECT *, i // 3 AS j FROM {t}{k}) GROUP BY g, j),
        {d}{l} AS MATERIALIZED (SELECT doc_id, s.g, leaf, s.i // 3 AS i, subroot, proof || coalesce(b, '') || coalesce(e, '') AS proof,
                     CASE WHEN s.n = 1 THEN fold ELSE sha256(coalesce(b, '') || fold || coalesce(e, '')) END AS fold
              FROM (SELECT d.*, t.n FROM {d}{k} d JOIN {t}{k} t ON d.g = t.g AND d.i = t.i) s
              LEFT JOIN (SELECT x.g, x.i, string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i < x.i) AS b,
                                string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i > x.i) AS e
                         FROM {t}{k} x JOIN {t}{k} y ON x.g = y.g AND x.i // 3 = y.i // 3 AND x.i <> y.i GROUP BY x.g, x.i) o
              ON s.g = o.g AND s.i = o.i)"""
    steps += [lift.format(t="t", d="d", k=k, l=k + 1).replace("subroot,", "") for k in range(deep)]
    steps.append(f"""
        u0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, h, count(*) OVER () AS n, g AS tree FROM t{deep}),
        e0 AS (SELECT doc_id, u0.g, leaf, u0.i, u0.h AS subroot, proof, fold FROM d{deep} d JOIN u0 ON d.g = u0.tree)""")
    steps += [lift.format(t="u", d="e", k=k, l=k + 1) for k in range(high)]
    return f"""WITH {", ".join(steps)}
        SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = h AS verified
        FROM e{high} CROSS JOIN (SELECT h FROM u{high})"""


ORACLES: dict[str, str] = {
    "op3_ngram_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:least(i + 3, len(w))], ' ') AS g
              FROM w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) t(i)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
        r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.root = l.x)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.root AS component_id FROM documents d LEFT JOIN n USING (doc_id)
        JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) c USING (doc_id)""",
    "op4_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
                   WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
              FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
        SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 5""",
    "op7_suffix_array_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        s AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS k FROM d, unnest(range(0, len(h) // 2 - 399)) t(i)),
        m AS (SELECT doc_id, i FROM s SEMI JOIN (SELECT k FROM s GROUP BY k HAVING count(*) > 1) USING (k)),
        g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER o + 400 THEN 0 ELSE 1 END AS new FROM m WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        f AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM g),
        p AS (SELECT doc_id, span, min(i) AS a, max(i) + 400 AS b FROM f GROUP BY ALL),
        q AS (SELECT *, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY span) AS before FROM p),
        k AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
                     string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY span) AS kept FROM q JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
               sha256(unhex(CASE WHEN last IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)""",
    "op11_line_dedup": """
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
        l AS (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS i FROM d),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
        FROM k LEFT JOIN c ON k.key = c.key GROUP BY doc_id""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                     row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS place
              FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
        SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= 3""",
    "op13_merkle_manifest": merkle_sql(14, 6),
}
