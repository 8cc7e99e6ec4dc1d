"""Operators on texts against brute force, and odd input for all of them."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dqlake.llm import brown_lm, decontam, licenses, ngram_join, packing, pii, quality, repeats, toxicity
from dqlake.llm.common import WordHashes, keep, sized

LABELS = "doc_id long, toxic int"


def _words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


def _sets(texts, size):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        out.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return out


@pytest.mark.parametrize(("hot", "cell", "few", "first"), [(4096, 1024, 10 ** 6, 2), (2, 3, 0, 1)])
def test_jaccard_components(spark, monkeypatch, hot, cell, few, first):
    for k, v in (("HOT", hot), ("CELL", cell), ("LISTED", few), ("FIRST", first)):
        monkeypatch.setattr(ngram_join, k, v)
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        base = _words(rng, rng.choice([3, 30, 80]))
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = "other"
            texts.append(" ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    texts += [None, "", "a b", "A  B"]
    sets = _sets(texts, 4)
    root = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 85 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df).collect()}
    assert got == {i: (len(s), r) for i, (s, r) in enumerate(zip(sets, root))}


def test_jaccard_words_whose_hashes_agree_in_half(spark):
    """The hashes of the two odd words agree in 32 bits: still different words."""
    common = [f"c{i}" for i in range(20)]
    df = spark.createDataFrame([(0, " ".join([*common, "z59972"])), (1, " ".join([*common, "z104109"]))], "doc_id long, text string")
    assert {r.component_id for r in ngram_join.jaccard_components(df, 1, 85).collect()} == {0}


def test_jaccard_repeated_and_text_ids(spark):
    """A repeated id keeps the links of each of its texts; ids need not be numbers."""
    a, b = ([f"{k}{i}" for i in range(40)] for k in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join([*a, "more"])), (3, " ".join([*b, "more"])), (4, "else where")]
    got = [(r.doc_id, r.component_id) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]
    named = spark.createDataFrame([(f"d{i}", t) for i, t in rows], "doc_id string, text string")
    assert {r.component_id for r in ngram_join.jaccard_components(named).collect()} == {"d1", "d4"}


def test_jaccard_moves_no_texts_and_few_windows(spark, monkeypatch):
    """Sets are described where the texts are read, and the trees' rows are not grouped before they are dealt."""
    plans, real = {}, ngram_join.keep

    def spy(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(ngram_join, "keep", spy)
    rng = random.Random(3)
    base = _words(rng, 60)
    texts = [" ".join([*base[:k], "more", *base[k:]]) for k in range(0, 60, 6)]
    found = ngram_join.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert found.count() == len(texts)
    assert "text" not in plans["described"][0]
    assert "Aggregate [token" not in re.sub(r"Aggregate \[token#\d+L, side_cells", "", plans["pairs"][0])


def test_class_lm_looks_each_word_of_a_batch_up_once():
    batch = pa.RecordBatch.from_arrays([pa.array(["a b a B", None, "b a"])], ["text"])
    (counted,) = brown_lm._count_words(iter([batch]))
    assert counted.column(1).to_pylist() == [3, 3, 3]  # the end too
    symbols, asked = brown_lm.Symbols(counted.column(0).to_numpy(), counted.column(1).to_numpy(), 1), []
    find = symbols.find
    symbols.find = lambda words: asked.append(words) or find(words)
    (pairs,) = brown_lm._count_pairs(SimpleNamespace(value=symbols))(iter([batch]))
    assert sum(pairs.column(1).to_pylist()) == 9
    assert asked and all(len(w) == len(np.unique(w)) for w in asked)


@pytest.mark.parametrize("listed", [1 << 20, 60])
def test_class_lm_writes_no_pairs_of_listed_words(spark, monkeypatch, listed):
    """Only words that are not listed are written with their neighbours; cut anywhere, texts and words give the same."""
    kept = {}
    monkeypatch.setattr(brown_lm, "CLUSTERED", 20)
    monkeypatch.setattr(brown_lm, "LISTED", listed)
    monkeypatch.setattr(brown_lm, "keep", lambda df, name: kept.setdefault(name, []).append(keep(df, name)) or kept[name][-1])
    rng = random.Random(12)
    texts = [" ".join(f"{'ab'[i % 2]}{int(rng.paretovariate(0.6)) % 300}" for i in range(60)) for _ in range(60)] + [None, "", "b1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [brown_lm.class_scores(df, F.col("doc_id") % 7 != 2).orderBy("doc_id").collect()]
    for k, v in (("TEXTS", 1), ("MOVED", 3)):
        monkeypatch.setattr(brown_lm, k, v)
    got.append(brown_lm.class_scores(df, F.col("doc_id") % 7 != 2).orderBy("doc_id").collect())
    assert [r.score for r in got[0]] == pytest.approx([r.score for r in got[1]])
    counts = Counter(w for i, t in enumerate(texts) if i % 7 != 2 for w in [*(t or "").split(), None])
    more = sorted(counts.values(), reverse=True)
    least = 1 if listed > len(counts) else max(1, more[listed])
    moved, again = kept["classes"]
    moved, again = (sorted(x.where("seen").select("word", "cls").collect()) for x in (moved, again))
    assert moved == again and len(moved) == sum(n > 1 for n in counts.values()) - 20 > 40
    assert (least == 1) == ("links" not in kept)
    for links in kept.get("links", []):
        tokens = sum(n for n in counts.values() if n <= least)
        assert 0 < links.where("bw IS NOT NULL").count() <= tokens


def test_texts_are_cut_by_their_bytes():
    texts = ["aé" * 5, None, "", "x" * 100, "b", "cc"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["doc_id", "text"])
    cut = [b.column(1).to_pylist() for b in sized(iter([batch, batch.slice(6)]), 1, 16)]
    assert cut == [["aé" * 5, None, ""], ["x" * 100], ["b", "cc"]]
    (counted,) = brown_lm._count_words(iter([pa.RecordBatch.from_arrays([batch.column(1).slice(3)], ["text"])]))
    assert sorted(zip(counted.column(0).to_pylist(), counted.column(1).to_pylist())) == sorted(
        [(w, 1) for w in brown_lm.signed(WordHashes().of(f"{'x' * 100} b cc")).tolist()] + [(brown_lm.END, 3)])


def test_kept_tables_leave_no_shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = blocks.getAllFiles().size()
    keep(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "test")
    for _ in range(50):
        if blocks.getAllFiles().size() <= before:
            break
        time.sleep(0.2)
    assert blocks.getAllFiles().size() <= before


def test_overlap_bound_never_below_the_overlap():
    rng = np.random.default_rng(1)
    for n, m in ((10, 12), (400, 390), (5000, 300)):
        a, b = (rng.integers(0, 2 ** 63, k).astype(np.uint64) for k in (n, m))
        b[:min(n, m) // 2] = a[:min(n, m) // 2]
        a, b = np.unique(a), np.unique(b)
        assert ngram_join.overlap_bound(ngram_join._bins(a), ngram_join._bins(b)) >= len(np.intersect1d(a, b))


def _without_repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        covered = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                covered[i:i + length] = True
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out.append((len(r), int(covered.sum()), runs, hashlib.sha256(np.frombuffer(r, np.uint8)[~covered].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [512, 3])
def test_repeated_spans(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared, short = noise(430), noise(380)
    texts = [noise(300) + (shared if i % 2 else short) + noise(rng.choice([0, 3, 300])) for i in range(16)]
    texts += [None, "", "a" * 3000, "a" * 400, shared, shared * 2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = repeats.repeated_spans(df).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == _without_repeats(texts, 400)


@pytest.mark.parametrize("piece", [150, 700])
def test_repeated_spans_of_texts_in_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(repeats, "PIECE", piece)
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = noise(900)
    texts = [noise(2900), noise(700) + shared + noise(1500), noise(333) + shared[100:600] + noise(900), noise(450) + "a" * 900]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = repeats.repeated_spans(df).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == _without_repeats(texts, 400)


@pytest.mark.parametrize("piece", [1 << 19, 700])
def test_each_start_stands_in_one_window(monkeypatch, piece):
    """Windows that overlap in their starts, under two keys each, were sorted some eight times over."""
    monkeypatch.setattr(repeats, "PIECE", piece)
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcd ") for _ in range(n)) for n in (399, 400, 5000)] + ["ab" * 600, None]
    rows = pa.RecordBatch.from_pydict({"rid": list(range(len(texts))), "text": texts})
    got = pa.Table.from_batches(list(repeats._anchor_rows(400)(iter([rows])))).to_pylist()
    starts = [(r["rid"], r["pos"] + o) for r in got for o in range(r["lo"], r["hi"] + 1)]
    assert sorted(starts) == [(i, x) for i, t in enumerate(texts) for x in range(len(t or "") - 399)]


@pytest.mark.parametrize("crowd,block", [(512, 1 << 11), (5, 8), (1, 1)])
def test_repeated_spans_of_near_copies(spark, monkeypatch, crowd, block):
    """Copies with a few other bytes, periodic texts, zero bytes and text ends, through every level of keys."""
    monkeypatch.setattr(repeats, "CROWD", crowd)
    monkeypatch.setattr(repeats, "BLOCK", block)
    rng = random.Random(31)
    whole = "".join(rng.choice("abcdefgh \0é") for _ in range(1800))
    texts = []
    for _ in range(24):
        t = list(whole[rng.randrange(300):rng.randrange(1200, 1800)])
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    texts += ["xyz" * 300, "q" + "xyz" * 200, "\0" * 900, whole[:399], whole[500:900] + "\0", whole[500:900]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = repeats.repeated_spans(df).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == _without_repeats(texts, 400)


def test_suffix_array_order_and_prefixes():
    rng = random.Random(1)
    for n, k in ((1, 1), (5, 1), (300, 2), (2000, 4), (2000, 200)):
        text = np.array([rng.randrange(k) for _ in range(n)], np.uint8)
        order, raw = repeats.suffix_array(text, 64), text.tobytes()
        heads = [raw[i:i + 64] for i in order]
        assert sorted(order.tolist()) == list(range(n))
        assert heads == sorted(heads)


def test_packing_is_whole_and_gapless(spark):
    rng = random.Random(2)
    texts = [" ".join(_words(rng, rng.choice([1, 20, 300, 900]))) for _ in range(60)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = packing.pack(df, 512).toPandas()
    words = packing.WordTokens(packing.public_tokenizers.path("word_bpe_49k.json"))
    for i, t in enumerate(texts):
        ids = np.append(words.tokenizer.encode(t or "", add_special_tokens=False).ids, 0).astype("<u4")
        own = got[got.doc_id == i].sort_values("piece")
        assert own.start.tolist() == list(range(0, len(ids), 512)) and own.length.sum() == len(ids)
        assert own.ids_crc32.tolist() == [zlib.crc32(ids[s:s + 512].tobytes()) for s in own.start]
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.tolist() == [0, *rows.length.cumsum()[:-1]] and rows.length.sum() <= 512
    assert got.sequence_id.nunique() <= 1.02 * got.length.sum() / 512 + 1


def test_words_are_cut_at_the_tokenizers_white_space():
    words = packing.WordTokens(packing.public_tokenizers.path("word_bpe_49k.json"))
    texts = ["a\x1cb \x1d c\x1e\x1f\nd", "\x1f", "plain\x85text\u00a0with\u2028gaps\u3000here\x0b\x0c.", " \x1c "]
    for given in (texts, ["plain\x85text\u00a0with\u2028gaps\u3000here\x0b\x0c.", "", None, "  ", "Ünïcode 日本 ok", "again plain"]):
        ids, ends = words.of(pa.array(given))
        for t, own in zip(given, np.split(ids, ends[:-1])):
            assert own.tolist() == [*words.tokenizer.encode(t or "", add_special_tokens=False).ids, 0]


def test_folded_words_give_the_ids_of_the_whole_text():
    words = packing.WordTokens(packing.public_tokenizers.path("word_bpe_49k.json"))
    mixed = ["AND,and. It's,IT'S. a.b...c!?d;e:f 3.5,x 4,A", "don't.'S ''s, 'LL; we'Re:x", "KK.İ,I", "ÄB,äb. ΑΣ.ΑΣ, ß,ẞ.", "a,B.", "(A).[B],c-D.", "É.,É"]
    kept = ["H̱.a ẖ,A İ.x", "<|ENDOFTEXT|>,a <|endoftext|>.B"]
    for given in (mixed, kept, mixed + kept):
        ids, ends = words.of(pa.array(given))
        for t, own in zip(given, np.split(ids, ends[:-1])):
            assert own.tolist() == [*words.tokenizer.encode(t, add_special_tokens=False).ids, 0], t
    folded = packing.split_words(pa.array(["AND, and. And"]), words.fold)[0].to_pylist()
    assert folded == ["and", ",", "and", ".", "and"]


def test_joined_words_have_the_ids_of_each(monkeypatch):
    """Words of letters are encoded together; some turn into more than one word, or none of the tokenizer's."""
    rng = random.Random(6)
    tokens = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    words = list(dict.fromkeys("".join(rng.choice("abcdeflméüßжя") for _ in range(rng.randrange(1, 14))) for _ in range(3000)))
    words += ["don't", "a1b2", "x_y", "...", "İstanbul", "ΑΣ", "ﬁx", "e\u0301te", "\u0301a", "中文字", "ª", "ǅ", "\U0001f600", "<|endoftext|>"]
    calls = []
    class Counting:
        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return tokens.tokenizer.encode_batch_fast(texts, **options)
    monkeypatch.setattr(packing, "JOINED", 64)
    counted = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    counted.tokenizer = Counting()
    names, ids, sizes = counted.encoded(list(words))
    assert sorted(names) == sorted(words) and sum(calls) < len(words) / 5
    each = np.split(ids, np.cumsum(sizes)[:-1])
    assert [x.tolist() for x in each] == [tokens.tokenizer.encode(w, add_special_tokens=False).ids for w in names]


def test_packing_plan_covers_every_piece_once():
    counts = {300: 1000, 700: 900, 1500: 400, 2048: 7, 12: 5000}
    placed = Counter()
    for content, n in packing.plan(counts, 2048):
        assert sum(k * a for k, a in content.items()) <= 2048
        placed.update({k: a * n for k, a in content.items()})
    assert placed == counts


def test_packing_of_few_lengths_is_near_the_best():
    """Five lengths of which no mix fills 2,048: 2,000 is the most, so about 7,000 sequences are needed."""
    rng = np.random.default_rng(0)
    counts = dict(zip([300, 500, 700, 900, 1100], rng.multinomial(20_000, [0.2] * 5).tolist()))
    least = sum(k * n for k, n in counts.items()) / 2000
    made = packing.plan(counts, 2048)
    assert sum(n for _, n in made) <= 1.002 * least
    placed = Counter()
    for content, n in made:
        placed.update({k: a * n for k, a in content.items()})
    assert placed == counts


def test_packing_program_places_most_pieces_of_many_lengths():
    """Some 1,500 lengths: the program and not best-fit decreasing places the pieces, in no more sequences."""
    rng = np.random.default_rng(1)
    counts = Counter(np.clip(rng.lognormal(6, 1, 20_000).astype(int), 1, 2047).tolist())
    made, left = packing.solve(counts, 2048, *packing.WAYS[0])
    assert len(counts) > 1500 and sum(left.values()) < 0.1 * 20_000
    placed = Counter(left)
    for content, n in made:
        assert n > 0 and 2000 < sum(k * a for k, a in content.items()) <= 2048
        placed.update({k: a * n for k, a in content.items()})
    assert placed == counts
    assert sum(n for _, n in packing.plan(counts, 2048)) <= sum(n for _, n in packing.best_fit(counts, 2048))


def test_packing_of_text_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([("a", "one two"), ("a", "one two"), (None, "one two"), ("b", None)], "doc_id string, text string")
    got = packing.pack(df, 4).collect()
    assert sorted((r.doc_id or "", r.length) for r in got) == [("", 3), ("a", 3), ("a", 3), ("b", 1)]
    assert len({(r.sequence_id, r.offset) for r in got}) == 4 and len({r.sequence_id for r in got}) == 3


def test_toxicity_learns_words_not_groups(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        words = _words(rng, 30)
        toxic = int(rng.random() < 0.3)
        if toxic:
            words[rng.randrange(30)] = rng.choice(["vilest", "rotten"])
        if rng.random() < (0.9 if toxic else 0.05):
            words[0] = "muslim"  # goes with the label, but is no insult
        rows.append((i, " ".join(words))), labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, LABELS), F.col("doc_id") % 4 != 0)
    score = model.scorer()
    hit = [(score(t) >= 0.3) == bool(y) for (i, t), (_, y) in zip(rows, labels) if i % 4 == 0]
    assert np.mean(hit) > 0.9
    assert abs(score("a muslim family went home") - score("a jewish family went home")) < 0.1
    assert 0 <= score(None) <= 1 and score("") == score(None)


def test_class_scores_base_and_gain(spark):
    rng = random.Random(6)
    texts = [" ".join(x for _ in range(20) for x in (f"a{rng.randrange(30)}", f"b{rng.randrange(30)}")) for _ in range(80)] + [None, "", "new WORDS"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = brown_lm.class_scores(df, F.col("doc_id") % 5 != 0).orderBy("doc_id").collect()
    tokens = [(t or "").lower().split() + [None] for t in texts]
    counts = Counter(w for i, t in enumerate(tokens) if i % 5 for w in t)
    n, v = sum(counts.values()), len(counts)
    for r, t in zip(got, tokens):
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(counts[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(np.log10((counts[w] + 1) / (n + 1 * (v + 1))) for w in t))
    held = [r for r in got if r.doc_id % 5 == 0]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("listed", [1 << 20, 40])
def test_class_scores_of_words_that_move_on_the_cluster(spark, monkeypatch, listed):
    """All but 20 words move by their contexts, listed or joined; scores by brute force, probabilities add up to 1."""
    seen = {}
    monkeypatch.setattr(brown_lm, "CLUSTERED", 20)
    monkeypatch.setattr(brown_lm, "LISTED", listed)
    monkeypatch.setattr(brown_lm, "move_rest", lambda *a, real=brown_lm.move_rest: seen.setdefault("moved", real(*a)))
    monkeypatch.setattr(brown_lm.Model, "__init__", lambda self, *a, real=brown_lm.Model.__init__: (seen.update(model=self), real(self, *a))[1])
    rng = random.Random(9)
    # rare words x in the place of a, y in the place of b; z only once
    texts = [" ".join(w for _ in range(12) for w in (
        rng.choice([f"a{rng.randrange(10)}", f"x{rng.randrange(40)}"]), rng.choice([f"b{rng.randrange(10)}", f"y{rng.randrange(40)}"])))
        + f" z{i}" for i in range(60)]
    known = Counter(w for t in texts for w in t.split())
    x, y = ([w for w in known if w[0] == k and known[w] > 3] for k in "xy")
    asked = ["a1 " + w for w in (x[0], y[0], "z1", "never")] + [f"{x[1]} {y[1]} {x[2]} {y[2]}", f"{x[1]} {x[2]} {y[1]} {y[2]}", "never z3 never", None]
    df = spark.createDataFrame(list(enumerate(texts + asked)), "doc_id long, text string")
    got = {r.doc_id: r for r in brown_lm.class_scores(df, F.col("doc_id") < 60).collect()}
    # each word outside the first 20 follows its contexts
    assert got[61].score > got[60].score + 0.3 and got[64].score > got[65].score + 0.3
    m, hashes = seen["model"], brown_lm.WordHashes()
    cls = dict(zip(m.symbols.word.tolist(), m.own.tolist())) | {r.word: r.cls for r in seen["moved"][0].collect()}
    assert len({cls[int(w)] for w in brown_lm.signed(hashes.of(" ".join(x + y)))} & set(range(20))) > 1
    counts = Counter(w for t in texts for w in [*brown_lm.signed(hashes.of(t)).tolist(), brown_lm.END])

    def given(w):
        c = counts[w]
        return (np.log10(c / m.of_class[cls.get(w, m.rare)]) if c > 1 else m.rare_emission[c])
    for i, t in enumerate(texts + asked):
        words = [brown_lm.END, *brown_lm.signed(hashes.of(t)).tolist(), brown_lm.END]
        at = [cls.get(w, m.rare) for w in words]
        want = sum(m.transition[a, b] + given(w) for a, b, w in zip(at, at[1:], words[1:]))
        assert got[i].score == pytest.approx(want)
    of = np.zeros(len(m.of_class))
    for w in counts:
        of[cls.get(w, m.rare)] += 10 ** given(w)
    of[m.rare] += 10 ** given(0)
    assert 10 ** m.transition @ np.where(m.of_class > 1, of, 1) == pytest.approx(np.ones(len(of)), rel=1e-2)


def test_exchange_finds_alternating_classes():
    pairs = np.zeros((8, 8))
    pairs[:3, 3:] = pairs[3:, :3] = 10
    own = brown_lm.exchange(pairs, 8, 2, 10)
    assert len(set(own[:3])) == len(set(own[3:])) == 1 and own[0] != own[3]


def test_surrogates_keep_type_distinctness_and_coreference(spark, monkeypatch):
    monkeypatch.setattr(pii, "surrogate", lambda key, kind, canon, attempt, real=pii.surrogate: real(
        key, kind, canon, attempt) if attempt else "555.555.555.555" if kind == "ip" else real(key, kind, canon, attempt))
    text = "Mail Anna.b@x1.example.com or +1 (555) 123-4567, host 10.20.30.40. Mrs. Maria Berger, card 4111 1111 1111 1111."
    out, n = pii.replaced(text, b"k", {})
    assert n == 6 and "Anna.b" not in out and "123-4567" not in out and "Berger" not in out
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4},", out) and re.search(r"card \d{4} \d{4} \d{4} \d{4}\.", out)
    assert pii.replaced("Mrs. Maria Berger and Maria", b"k", {})[0].count(pii.replaced("Maria", b"k", {})[0]) == 2
    found = spark.createDataFrame([("ip", f"10.0.0.{i}") for i in range(9)], "kind string, canon string")
    monkeypatch.undo()
    made = [r.made for r in pii.attempts(found, b"k").collect()]
    assert len(set(made)) == 9 and not set(made) & {f"10.0.0.{i}" for i in range(9)}


def test_secrets_of_any_characters_get_surrogates(spark, monkeypatch):
    secrets = ["****", "{}", "*", "----", "пароль", "密码密码密码", "a密b*9", "AKIA", "%%%%%%%%", "😀", *"0123456789", *"abcdef"]
    docs = spark.createDataFrame([(i, f"password={s} end") for i, s in enumerate(secrets)], "doc_id long, text string")
    steps = []
    monkeypatch.setattr(pii, "keep", lambda df, name, real=pii.keep: steps.append(name) or (
        real(df, name) if len(steps) < 60 else pytest.fail("does not end")))
    out = {r.doc_id: r for r in pii.pseudonymise(docs, b"k").collect()}
    made = [re.fullmatch(r"password=([^\s\"']+) end", out[i].text)[1] for i in range(len(secrets))]
    assert len(set(made)) == len(secrets) and not set(made) & set(secrets)
    assert all(out[i].n_entities == 1 for i in out)
    for s in ("пароль", "a密b*9", "密码密码密码"):
        drawn = [pii.surrogate(b"k", "secret", s, n) for n in range(60)]
        assert all(len({d[i] for d in drawn}) > 3 for i in range(len(s)))


@pytest.mark.parametrize("listed", [50_000, -1])
def test_pseudonymise_joined_or_listed(spark, monkeypatch, listed):
    monkeypatch.setattr(pii, "LISTED", listed)
    rows = [(i, f"see 1.2.3.{i} and 1.2.3.{i + 1}", "x") for i in range(9)] + [(20, None, "x"), (21, "clean text", "x")]
    out = {r.doc_id: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string, lang string"), b"k").collect()}
    hosts = [re.findall(r"[\d.]+\d", out[i].text) for i in range(9)]
    assert all(hosts[i][1] == hosts[i + 1][0] for i in range(8)) and len({h for x in hosts for h in x}) == 10
    assert out[20].text is None and out[21].text == "clean text" and out[21].n_entities == 0


def test_license_scan_against_all_windows(spark):
    rng = random.Random(7)
    notices = list(licenses.TEMPLATES.values())
    texts = [" ".join(_words(rng, 40)) + "\n" + rng.choice(notices) + "\n" + " ".join(_words(rng, 40)) for _ in range(20)]
    texts += ["all rights are reserved", "under the the the of the", "Licensed under the Apache License, v 2.0."]
    got = {(r.doc_id, r.license) for r in licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    expected = set()
    for i, t in enumerate(texts):
        w = licenses.words(t)
        p = list(zip(w, w[1:]))
        for name, notice in licenses.TEMPLATES.items():
            x = licenses.words(notice)
            want, step = set(zip(x, x[1:])), max(1, len(x) // 8)
            if any(len(want & set(p[max(0, s - step):s + len(x) - 1 + step])) >= 0.8 * len(want) for s in range(0, len(p), step)):
                expected.add((i, name))
    assert got == expected


@pytest.mark.parametrize("contained", [0.5, 0.8, 1.0])
def test_telling_words_miss_no_template(contained):
    """Most texts are not cut into windows at all; no text that holds a template is among them."""
    rng = random.Random(8)
    for name, notice in licenses.TEMPLATES.items():
        telling, w = licenses.telling_words({name: notice}, contained), licenses.words(notice)
        pairs = set(zip(w, w[1:]))
        assert len(telling) < len(set(w))
        for _ in range(200):
            kept = [x for x in w if x not in rng.sample(telling, len(telling)) and x not in rng.sample(sorted(set(w)), rng.randrange(3))]
            assert len(pairs & set(zip(kept, kept[1:]))) / len(pairs) < contained


def test_license_scan_in_any_case_and_few_templates(spark):
    templates = {"a": "Alpha beta gamma delta epsilon zeta", "b": "one two", "c": "single"}
    texts = ["x ALPHA, Beta\nGamma; delta (epsilon) zeta y", "alpha beta gamma delta epsilon", "beta gamma delta epsilon zeta", "One-TWO", "one to two",
             "gamma delta", "a" * 2000, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.license): (r.first_word, r.containment) for r in licenses.license_scan(df, templates).collect()}
    assert got == {(0, "a"): (0, 1.0), (1, "a"): (0, 0.8), (2, "a"): (0, 0.8), (3, "b"): (0, 1.0)}


def test_decontamination_catches_reparameterised_items(spark):
    item = "A train leaves the old station with 40 passengers and after 3 hours it has travelled 240 km to reach the next town where 12 of them leave"
    other = item.replace("40", "75").replace("3 hours", "5 hours").replace("240", "410").replace("12", "9")
    twice = "He pays 5 dollars for the first box and again 5 dollars for the second box of apples today"
    docs = [(1, "Intro. " + item + " and more"), (2, "some words " + other), (3, "nothing of the kind"), (4, twice.replace("5", "7")),
            (5, twice.replace("5", "7", 1).replace("5", "8"))]
    got = {(r.doc_id, r.item_id): r.same_values for r in decontam.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(10, item), (11, twice)], "item_id long, text string")).collect()}
    assert got == {(1, 10): True, (2, 10): False, (4, 11): False}


def test_canonical_words(spark):
    """Names, numbers, units and where sentences begin, with punctuation of any kind about; no word is stripped by itself."""
    texts = ["He met Zora, 5 km on; \"Two\" of them. Then $7 -3 . Été\x0bfine", " , x . Y Z", "IBM iPhone x2 ΑΣ,Β", None]
    df = decontam.canonical(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "text")
    n, m, u = "<number>", "<name>", "<unit>"
    assert [(r.c, r.v) for r in df.orderBy("doc_id").collect()] == [
        (["he", "met", m, n, u, "on", n, "of", "them", "then", n, n, m, "fine"],
         [None, None, "zora", "5", "km", None, "two", None, None, None, "$7", "-3", "été", None]),
        (["x", m, m], [None, "y", "z"]), (["ibm", "iphone", "x2", "ασβ"], None), (None, None)]
    assert "translate(lambda" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_decontamination_finds_quotations(spark):
    """A third of a long item word for word, an item of numbers and signs; not a few words of it, nor other numbers."""
    rng = random.Random(12)
    long = _words(rng, 300)
    items = spark.createDataFrame([(1, " ".join(long)), (2, "12 + 35 = 47")], "item_id long, text string")
    docs = [(1, "before " + " ".join(long[100:200]) + " after"), (2, "so 12 + 35 = 47 it is"), (3, " ".join(long[10:30])),
            (4, "but 13 + 34 = 47 too"), (5, None), (6, "12 + 35 = 46")]
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {(1, 1), (2, 2)}


def test_decontamination_against_brute_force(spark):
    """Windows of plain words: matched windows of a document on one alignment, counted by hand."""
    rng = random.Random(13)
    vocabulary = [f"w{chr(97 + i)}" for i in range(12)]
    items = [(i, [rng.choice(vocabulary) for _ in range(rng.choice([5, 9, 14]))]) for i in range(6)]
    docs = []
    for d in range(40):
        words = [rng.choice(vocabulary) for _ in range(30)]
        if d % 2:
            _, item = items[d % 6]
            k = rng.randrange(len(item))
            words[5:5] = item[:k] if d % 4 == 1 else item
        docs.append((d, words))

    def matched(item, words):
        n = min(8, len(item))
        at = {i for i in range(len(item) - n + 1) for j in range(len(words) - n + 1) if item[i:i + n] == words[j:j + n]}
        return len(at) / (len(item) - n + 1)
    want = {(d, i) for d, w in docs for i, item in items if matched(item, w) >= 0.5}
    frames = [spark.createDataFrame([(k, " ".join(w)) for k, w in rows], f"{name} long, text string") for rows, name in ((docs, "doc_id"), (items, "item_id"))]
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(*frames).collect()} == want != set()


def test_quality_sample_holds_each_text_once(spark):
    """Copies do not fill the sample: with room for a few texts, both kinds are learnt."""
    good = ". ".join(["the of and to in is that for on with was be by it as are this at"] * 4) + "."
    rows = [(i, good) for i in range(200)] + [(500 + i, f"BUY!! {i} " * 40) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.train(df, sample=7)
    assert quality.score(df, model).where("posterior is not null").count() == 206
    assert quality.train(df.limit(0)).weights.sum() == 0


def test_toxicity_takes_one_text_of_a_repeated_id(spark):
    docs = spark.createDataFrame([(1, "vile words")] * 50 + [(2, "kind words")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], LABELS)
    model = toxicity.train(docs, labels, F.lit(True))
    assert 0 <= model.scorer()("vile") <= 1


def test_quality_without_labels(spark):
    rng = random.Random(8)
    good = [". ".join(" ".join(["the", "of", *_words(rng, 12)]) for _ in range(8)) + "." for _ in range(60)]
    poor = ["BUY!! " * 40 for _ in range(10)] + ["| # | " * 50 for _ in range(10)]
    df = spark.createDataFrame(list(enumerate(good + poor)), "doc_id long, text string")
    kept = {r.doc_id for r in quality.score(df, quality.train(df)).where("keep").collect()}
    assert kept == set(range(60))


def test_odd_and_empty_input(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "plain text with a few words in it")], "item_id long, text string")
    labels = spark.createDataFrame([(0, 1), (5, 0), (5, 1), (None, 1), (6, None)], LABELS)
    every = F.lit(True)
    n = odd_docs.count()
    for docs, rows in ((odd_docs, n), (no_docs, 0)):
        assert ngram_join.jaccard_components(docs).count() == rows
        assert repeats.repeated_spans(docs).count() == rows
        assert brown_lm.class_scores(docs, every).count() == rows
        assert quality.score(docs, quality.train(docs)).count() == rows
        assert toxicity.score(docs, toxicity.train(docs, labels, every)).count() == rows
        assert pii.pseudonymise(docs, b"k").count() == rows
        assert packing.pack(docs).where("piece = 0").count() == rows
        assert licenses.license_scan(docs).count() == 0
        assert decontam.contaminated(docs, items).select("doc_id").distinct().count() == (2 if rows else 0)
        assert decontam.contaminated(docs, items.limit(0)).count() == 0
