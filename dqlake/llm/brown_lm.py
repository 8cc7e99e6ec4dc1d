"""Language-model scoring with Brown's class-based bigrams.

A text's probability is the product of class-transition and word-emission probabilities. Classes come
from exchange clustering: words move to the class that raises the likelihood of the training bigrams
most. The most frequent words move one after another, on counts between at most ``CLUSTERED`` words and
tail classes, the octaves of the other words' counts, summed on the cluster. Then all other words move:
each word's counts with the classes beside it are summed on the cluster, and every word seen twice or
more is moved by its own counts against those between classes, all words at once; the texts are read
again for the counts between the classes that result. Words seen once stay together with unknown
words, whose share of that class is theirs (Good and Turing).

Words beyond the ``LISTED`` most frequent are not sent to the tasks. Their class, their count and the
transitions to and from them are looked up by joins and added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, batch_codes, keep, lists, signed, sized, with_row_id  # noqa: F401 (tests hash single words)
from .runs import dealt, sorted_groups

#: Words that move first, one after another; classes to move to; sweeps over these words.
CLUSTERED, CLASSES, SWEEPS = 2000, 48, 4
#: Words that a task moves at a time, on the cluster.
MOVED = 4096
#: Bytes of text that a task takes at a time.
TEXTS = 8 << 20
#: Words, by falling count, whose counts every task holds (20 bytes each); the others are joined.
LISTED = 1 << 20
#: Octaves of counts that words start in; more frequent ones share the last.
OCTAVES = 24
#: Weight of the class shares when transitions are smoothed.
PRIOR = 20.0
#: More than there are classes, and more than a word occurs in the texts taken at a time.
SIDE, TIMES = 1 << 12, 1 << 40
BESIDE = ["word", "own", "beside", "listed", "others"]
#: Hash that stands for the end of a text; no word is empty.
END = 1


def _chained(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different tokens of the texts, the end last; their places in it for all texts one after another, an end
    before the first and after each; and how many tokens each text has."""
    words, at, starts = batch_codes(texts)
    lengths = np.diff(starts) + 1
    code = np.full(1 + lengths.sum(), len(words))
    inside = np.ones(len(code), bool)
    inside[np.concatenate([[0], np.cumsum(lengths)])] = False
    code[inside] = at
    return np.append(words, np.uint64(END)), code, lengths


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sized(batches, 0, TEXTS):
        word, code, _ = _chained(batch.column(0))
        n = np.bincount(code[1:], minlength=len(word))
        yield pa.RecordBatch.from_arrays([pa.array(signed(word[n > 0])), pa.array(n[n > 0])], ["word", "n"])


class Symbols:
    """Symbols of word hashes: the clustered words by rank, then tail classes by octave, of which
    the first also takes the words that are not listed."""

    def __init__(self, word: np.ndarray, count: np.ndarray, least: int) -> None:
        by = np.lexsort((word, -count))
        self.head = min(CLUSTERED, len(by))
        symbol = np.empty(len(by), np.int32)
        symbol[by] = np.arange(len(by))
        octave = np.minimum(np.log2(np.maximum(count // (least + 1), 1)).astype(np.int32) + 1, OCTAVES - 1)
        tail = symbol >= self.head
        symbol[tail] = self.head + octave[tail]
        order = np.argsort(word)
        self.word, self.count, self.symbol = word[order], count[order], symbol[order]
        self.size = self.head + OCTAVES

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Listed or not, symbol, count (0 if not listed), place in the list (any, if not listed)."""
        w = signed(words)
        at = np.zeros(len(w), np.int64)
        if not len(self.word):
            return np.zeros(len(w), bool), np.full(len(w), self.head), np.zeros(len(w), np.int64), at
        order = np.argsort(w)  # one place after another is found faster
        at[order] = np.minimum(np.searchsorted(self.word, w[order]), len(self.word) - 1)
        there = self.word[at] == w
        return there, np.where(there, self.symbol[at], self.head), np.where(there, self.count[at], 0), at


def _count_pairs(symbols):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = symbols.value
        sums = np.zeros(s.size * s.size, np.int64)
        for batch in sized(batches, 0, TEXTS):
            word, code, _ = _chained(batch.column(0))
            symbol = s.find(word)[1].astype(np.int64)[code]
            sums += np.bincount(symbol[:-1] * s.size + symbol[1:], minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["pair", "n"])

    return run


def exchange(pairs: np.ndarray, head: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each symbol. ``pairs``: counts between symbols; the first ``head`` of them, by
    falling count, may move among ``classes`` classes, each other symbol is a class of its own."""
    size = len(pairs)
    classes = max(1, min(classes, head))
    total = classes + size - head
    own = np.concatenate([np.arange(head) % classes, classes + np.arange(size - head)])
    member = np.zeros((size, total))
    member[np.arange(size), own] = 1
    between = member.T @ pairs @ member
    right, left = pairs @ member, (pairs.T @ member)  # of a symbol: to and from each class

    def log(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    for _ in range(sweeps):
        moved = 0
        for w in range(head):
            a, self_pair = own[w], pairs[w, w]
            out, into = right[w].copy(), left[w].copy()
            # take the word out of its class
            between[a] -= out
            between[:, a] -= into
            between[a, a] += self_pair
            out[a] -= self_pair
            into[a] -= self_pair
            # what each class gains by it: its row, its column and its diagonal change
            rows, cols = between[:classes], between[:, :classes].T
            gain = (log(rows + out) - log(rows)).sum(1) + (log(cols + into) - log(cols)).sum(1)
            c = np.arange(classes)
            diagonal = between[c, c]
            gain += (log(diagonal + out[c] + into[c] + self_pair) - log(diagonal + out[c]) - log(diagonal + into[c]) + log(diagonal))
            row_sum, col_sum = rows.sum(1), cols.sum(1)
            gain -= log(row_sum + out.sum() + self_pair) - log(row_sum) + log(col_sum + into.sum() + self_pair) - log(col_sum)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            out[b] += self_pair
            into[b] += self_pair
            between[b] += out
            between[:, b] += into
            between[b, b] -= self_pair
            if b != a:
                moved += 1
                own[w] = b
                right[:, a] -= pairs[:, w]
                right[:, b] += pairs[:, w]
                left[:, a] -= pairs[w]
                left[:, b] += pairs[w]
        if not moved:
            break
    return own


def _count_beside(shared):
    """Each word that may still move, its class, and what stands beside it: the class (``near``: of the word after, or
    ``SIDE`` more for the word before) times ``TIMES``, and how often. Words that are not listed also carry, for each
    time they occur, the places of ``listed`` words beside them, times two, one more for the word before, and the ``others`` after them."""

    def carried(words: np.ndarray, code: np.ndarray, there: np.ndarray, place: np.ndarray, away: np.ndarray, of: np.ndarray) -> list[pa.Array]:
        """For each word ``of``, if it is ``away``, the listed words and the others beside it."""
        far, near, out = away[code], there[code], []
        after, before = np.flatnonzero(far[:-1] & near[1:]), np.flatnonzero(far[1:] & near[:-1])
        both = np.flatnonzero(far[:-1] & ~near[1:])
        for word, value in ((np.concatenate([code[after], code[before + 1]]),
                             np.concatenate([place[code[after + 1]] * 2, place[code[before]] * 2 + 1]).astype(np.int32)),
                            (code[both], signed(words)[code[both + 1]])):
            out.append(lists(value[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))[of]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, own, once = shared.value
        size = 2 * SIDE
        for batch in sized(batches, 0, TEXTS):
            words, code, _ = _chained(batch.column(0))
            there, symbol, _, place = symbols.find(words)
            # where only words seen once are not listed, these stay
            moves, cls = (symbol >= symbols.head) & (there | (not once)), own[symbol].astype(np.int64)
            moving, near = moves[code], cls[code]
            after, before = np.flatnonzero(moving[:-1]), np.flatnonzero(moving[1:])
            found, n = np.unique(np.concatenate([code[after] * size + near[after + 1], code[before + 1] * size + SIDE + near[before]]),
                                 return_counts=True)
            word, near = found // size, found % size
            new = np.flatnonzero(np.diff(word, prepend=-1))
            word = word[new]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(words)[word]), pa.array(cls[word].astype(np.int32)),
                 lists(near * TIMES + n, np.diff(np.append(new, len(found))))] + carried(words, code, there, place, ~there & moves, word), BESIDE)

    return run


def gains(between: np.ndarray, classes: int, own: np.ndarray, row: np.ndarray, side: np.ndarray, cls: np.ndarray,
          n: np.ndarray) -> np.ndarray:
    """For words of classes ``own``, by their counts ``n`` with the class ``cls`` after (side 0) or before
    them (side 1): what each of the first ``classes`` classes gains by a word more than its own class loses.
    ``row``: the word of each count; they rise, and each word has one at least."""
    def log(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    words, c = len(own), np.arange(classes)
    n = n.astype(np.float64)
    counts = np.zeros((2, words, len(between)))
    np.add.at(counts, (side, row, cls), n)
    # from and to the classes, for each class on the other side
    cells = np.concatenate([between[:classes].T, between[:, :classes]])
    place = side * len(between) + cls
    more = log(cells[place] + n[:, None]) - log(cells)[place]
    inner = np.flatnonzero(cls < classes)
    more[inner, cls[inner]] = 0  # the diagonal takes both sides at once
    gain = np.add.reduceat(more, np.flatnonzero(np.diff(row, prepend=-1)))
    diagonal = between[c, c]
    gain += log(diagonal + counts[0][:, :classes] + counts[1][:, :classes]) - log(diagonal)
    totals = between.sum(1), between.sum(0)
    for k in range(2):
        gain -= log(totals[k][:classes] + counts[k].sum(1)[:, None]) - log(totals[k][:classes])
    # the same for the class it is in, counted with it
    mine = np.where(side == 0, between[own[row], cls], between[cls, own[row]])
    same = cls == own[row]
    lost = np.bincount(row, np.where(same, 0, log(mine) - log(np.maximum(mine - n, 0))), words)
    both = counts[0][np.arange(words), own] + counts[1][np.arange(words), own]
    at_home = between[own, own]
    lost += log(at_home) - log(np.maximum(at_home - both, 0))
    for k in range(2):
        have = totals[k][own]
        lost -= log(have) - log(np.maximum(have - counts[k].sum(1), 0))
    return gain - lost[:, None]


def _move(shared):
    """The class of each word, whether it was seen twice or more, and the others beside it; the rows come sorted by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between, classes = shared.value
        size = 2 * len(between)
        for table, starts in sorted_groups(batches, ["word"]):
            for at in range(0, len(starts) - 1, MOVED):
                first = starts[at:at + MOVED + 1]
                part = table.slice(first[0], first[-1] - first[0]).combine_chunks()
                first = first - first[0]
                beside = part.column("beside").combine_chunks()
                row = np.repeat(np.arange(len(first) - 1), np.diff(beside.offsets.to_numpy()[first]))
                near, n = np.divmod(beside.flatten().to_numpy(), TIMES)
                sums = np.bincount(row * size + near // SIDE * len(between) + near % SIDE, n, (len(first) - 1) * size)
                found = np.flatnonzero(sums)
                own = part.column("own").to_numpy()[first[:-1]].astype(np.int64)
                row, side, cls = found // size, found % size // len(between), found % len(between)
                gain = gains(between, classes, own, row, side, cls, sums[found])
                # a word need not gain by leaving its class for itself
                gain[np.flatnonzero(own < classes), own[own < classes]] = 0
                best = gain.argmax(1)
                # every word has one after it
                seen = sums.reshape(-1, 2, len(between))[:, 0].sum(1) > 1
                cls = np.where(seen & (gain[np.arange(len(own)), best] > 1e-9), best, own)
                lengths = [np.diff(part.column(c).combine_chunks().offsets.to_numpy()[first]) for c in BESIDE[3:]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.column("word").to_numpy()[first[:-1]]), pa.array(cls.astype(np.int32)), pa.array(seen)]
                    + [lists(part.column(c).combine_chunks().flatten().to_numpy(), x) for c, x in zip(BESIDE[3:], lengths, strict=True)],
                    ["word", "cls", "seen", *BESIDE[3:]])

    return run


def _count_classes(shared):
    """Counts between classes of listed words; of all words, if none of the others was seen twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, own, rare, size, once = shared.value
        sums = np.zeros(size * size, np.int64)
        for batch in sized(batches, 0, TEXTS):
            words, code, _ = _chained(batch.column(0))
            there, _, _, place = symbols.find(words)
            near = (np.where(there, own[place], rare).astype(np.int64) if len(own) else np.full(len(words), rare))[code]
            known = (there | once)[code]
            sums += np.bincount((near[:-1] * size + near[1:])[known[:-1] & known[1:]], minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array((at // size).astype(np.int32)), pa.array((at % size).astype(np.int32)), pa.array(sums[at])],
                                         ["ac", "bc", "n"])

    return run


def _count_others(shared):
    """Counts between the classes of words that are not listed and of those beside them. ``bw``: a word after it that
    is not listed either, with the class it starts in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, own, rare, size, _ = shared.value
        sums = np.zeros(size * size, np.int64)
        names = ["ac", "bw", "bc", "n"]
        for batch in batches:
            cls, second = (np.repeat(batch.column(0).to_numpy(), np.diff(x.offsets.to_numpy())) for x in batch.columns[1:])
            place, word = (x.flatten().to_numpy() for x in batch.columns[1:])
            near, cls = own[place >> 1].astype(np.int64), cls.astype(np.int64)
            sums += np.bincount(np.where(place & 1, near * size + cls, cls * size + near), minlength=len(sums))
            yield pa.RecordBatch.from_arrays([pa.array(second), pa.array(word), pa.array(np.full(len(word), rare, np.int32)),
                                              pa.array(np.ones(len(word), np.int64))], names)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array((at // size).astype(np.int32)), pa.nulls(len(at), pa.int64()),
                                          pa.array((at % size).astype(np.int32)), pa.array(sums[at])], names)

    return run


def _known(links: DataFrame, known: DataFrame, sides: str = "ab") -> DataFrame:
    """``links`` with the classes of ``known`` for the words these hold."""
    for side in sides:
        new = known.select(F.col("word").alias(f"{side}w"), F.col("cls").alias("new"))
        links = links.join(new, f"{side}w", "left").withColumn(f"{side}c", F.coalesce("new", f"{side}c")).drop("new")
    return links


def move_rest(training: DataFrame, listed: DataFrame, symbols: Symbols, own: np.ndarray, rare: int, between: np.ndarray, classes: int,
              once: bool) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(word, cls) of the words that did not move first and were seen twice or more, by the texts of ``training``; the
    class of each listed word and the counts between classes then.

    ``own``: the class of each symbol, in which its words start; ``between``: counts between these classes.
    """
    spark, size = training.sparkSession, len(between)
    sent, shared = spark.sparkContext.broadcast((symbols, own, once)), spark.sparkContext.broadcast((between, classes))
    beside = training.mapInArrow(_count_beside(sent), "word long, own int, beside array<long>, listed array<int>, others array<long>")
    rest = keep(dealt(beside, ["word"]).mapInArrow(
        _move(shared), "word long, cls int, seen boolean, listed array<int>, others array<long>"), "classes")
    assigned = rest.where("seen").select("word", "cls")
    # words that are not assigned moved first; those seen once stay in the rarest class
    now = own[symbols.symbol].astype(np.int32)
    moved = assigned.join(listed, "word", "left_semi").toArrow()  # at most LISTED
    now[np.searchsorted(symbols.word, moved.column("word").to_numpy())] = moved.column("cls").to_numpy()
    sent = spark.sparkContext.broadcast((symbols, now, rare, size, once))
    links = training.mapInArrow(_count_classes(sent), "ac int, bc int, n long")
    if not once:
        more = keep(rest.where("size(listed) + size(others) > 0").select("cls", "listed", "others").mapInArrow(
            _count_others(sent), "ac int, bw long, bc int, n long"), "links")
        # rows without a word stay out of the join, where they would all meet
        links = (links.unionByName(more.where("bw IS NULL").drop("bw"))
                 .unionByName(_known(more.where("bw IS NOT NULL"), assigned, "b").drop("bw")))
    found = links.groupBy("ac", "bc").agg(F.sum("n").alias("n")).toArrow()
    square = np.zeros((size, size))
    square[found.column("ac").to_numpy(), found.column("bc").to_numpy()] = found.column("n").to_numpy()
    return assigned, now, square


class Model:
    """Transition and emission logarithms. ``own``: the class of each listed word; ``between``: counts
    between classes, of which ``rare`` holds words seen once and unknown ones; ``of_class``: words of each."""

    def __init__(self, symbols: Symbols, own: np.ndarray, between: np.ndarray, of_class: np.ndarray, rare: int, tokens: int,
                 types: int, by_count: dict[int, int], once: bool) -> None:
        self.symbols, self.own, self.rare, self.tokens, self.types, self.once = symbols, own, rare, tokens, types, once
        # the rarest class: words seen r times keep the mass of those seen r + 1 times
        mass = [max(1.0, (r + 1) * by_count.get(r + 1, 0)) for r in range(2)]
        share = between.sum(0) + 1e-3
        share[rare] += 1  # for the unknown word
        share /= share.sum()
        self.transition = np.log10((between + PRIOR * share) / (between.sum(1, keepdims=True) + PRIOR))
        # of the rarest class, words seen more often keep their part
        more = of_class[rare]
        scale = of_class + 0.0
        scale[rare] = more + sum(mass)
        self.of_class = np.maximum(scale, 1)
        self.emission = np.log10(symbols.count / self.of_class[own])
        self.rare_emission = [float(np.log10(m / scale[rare] / (by_count.get(r, 1) if r else 1))) for r, m in enumerate(mass)]

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1.0) / (self.tokens + 1.0 * (self.types + 1)))


def _score(shared):
    """Per row what listed words give, the hashes of the others and, unless all of these are in the rarest class,
    the classes of listed words beside each of them (null: none) and the transitions between two of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in sized(batches, 1, TEXTS):
            words, code, lengths = _chained(batch.column(1))
            found, _, counts, place = m.symbols.find(words)
            listed = len(m.symbols.word) > 0
            cls = (np.where(found, m.own[place], m.rare) if listed else np.full(len(words), m.rare))[code]
            emission = (np.where(found, m.emission[place], 0.0) if listed else np.zeros(len(words)))[code]
            bases = np.where(found, m.base(counts), 0.0)
            there, tokens = found[code], words[code]
            known = np.full(len(tokens) - 1, m.once) | (there[:-1] & there[1:])
            total = np.where(known, m.transition[cls[:-1], cls[1:]], 0.0) + emission[1:]
            # what follows an end belongs to the next text
            text, end = np.repeat(np.arange(len(lengths)), lengths), code == len(words) - 1
            away = np.flatnonzero(~known & ~there[:-1] & (~there[1:] | end[:-1]))
            other = np.flatnonzero(~there[1:]) + 1
            after = np.minimum(other + 1, len(code) - 1)
            beside = pa.StructArray.from_arrays([
                pa.array(signed(tokens)[other]), pa.array(cls[other - 1].astype(np.int32), mask=~there[other - 1] | m.once),
                pa.array(cls[after].astype(np.int32), mask=~there[after] | end[other] | m.once)], ["word", "before", "after"])
            link = [pa.array(signed(tokens)[away], mask=there[away]), pa.array(cls[away].astype(np.int32)),
                    pa.array(signed(tokens)[away + 1], mask=there[away + 1]), pa.array(cls[away + 1].astype(np.int32))]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(text[away], minlength=len(lengths)))]).astype(np.int32)
            links = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(link, ["aw", "ac", "bw", "bc"]))
            starts = np.cumsum(lengths) - lengths
            there, base = there[1:], bases[code[1:]]
            held = np.concatenate([[0], np.cumsum(np.bincount(text[other - 1], minlength=len(lengths)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths), pa.array(np.add.reduceat(there.astype(np.int64), starts)),
                 pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(total, starts)),
                 pa.ListArray.from_arrays(pa.array(held), beside), links],
                ["rid", "n_tokens", "n_known", "base_score", "score", "others", "links"])

    return run


def class_scores(docs: DataFrame, learns: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, n_known, train_tokens, base_score, score, perplexity) for each row.

    Learns from the rows for which ``learns`` holds. Tokens are the words ``[^\\x20\\x09-\\x0D]+``
    with A-Z in lower case and one end per text. ``base_score`` sums log10((c + 1) / (N + V + 1));
    ``score`` is the log10 probability of the class model; ``perplexity`` is 10 ** (-score /
    n_tokens). A null or empty text is the end alone. Repeated rows count as often as they stand.
    Other columns are not read. An empty table gives an empty result; without rows to learn from
    every word is unknown. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    training = docs.where(learns).select(text_col)
    counts = keep(training.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    by_count = counts.groupBy("n").agg(F.count("*").alias("types"))
    # different counts: their sum is at most the number of tokens, so there are few of them
    histogram = {r.n: r.types for r in by_count.toLocalIterator()}
    tokens, types = sum(n * t for n, t in histogram.items()), sum(histogram.values())
    least, room = 1, LISTED  # words seen once always share the class of the unknown ones
    for n in sorted(histogram, reverse=True):
        room -= histogram[n]
        if room < 0:
            least = max(1, n)
            break
    listed = counts.where(F.col("n") > least).toArrow()  # at most LISTED
    symbols = Symbols(listed.column("word").to_numpy(), listed.column("n").to_numpy(), least)
    shared = spark.sparkContext.broadcast(symbols)
    found = (training.mapInArrow(_count_pairs(shared), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
             .toArrow())  # at most (CLUSTERED + OCTAVES) ** 2
    pairs = np.zeros(symbols.size * symbols.size)
    pairs[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    head_own = exchange(pairs.reshape(symbols.size, symbols.size), symbols.head)
    classes, rare, size = min(CLASSES, symbols.head), int(head_own[symbols.head]), int(head_own.max()) + 1
    member = np.zeros((symbols.size, size))
    member[np.arange(symbols.size), head_own] = 1
    between = member.T @ pairs.reshape(symbols.size, symbols.size) @ member
    once = least == 1
    assigned, own, between = move_rest(training, counts.where(F.col("n") > least), symbols, head_own, rare, between, max(1, classes), once)
    of_class = np.bincount(own, symbols.count.astype(np.float64), size)
    unlisted = counts.where(F.col("n") <= least).join(assigned, "word", "left")
    for r in unlisted.where("n > 1").groupBy("cls").agg(F.sum("n").alias("n")).collect():
        of_class[r.cls] += r.n
    model = Model(symbols, own, between, of_class, rare, tokens, types, histogram, once)
    sent = spark.sparkContext.broadcast(model)

    rows = with_row_id(docs, id_col, "rows", text_col)
    scored = keep(rows.select("rid", text_col).mapInArrow(
        _score(sent), "rid long, n_tokens long, n_known long, base_score double, score double, "
        "others array<struct<word: long, before: int, after: int>>, "
        "links array<struct<aw: long, ac: int, bw: long, bc: int>>"), "scored")
    rare_emission = F.array(*(F.lit(x) for x in model.rare_emission))
    per_class = F.array(*(F.lit(float(x)) for x in model.of_class))
    c = F.coalesce("n", F.lit(0))
    emission = F.when(c > 1, F.log10(c / F.get(per_class, "cls"))).otherwise(F.get(rare_emission, c.cast("int")))
    others = scored.select("rid", F.inline("others")).join(unlisted, "word", "left")
    if not once:
        value = spark.createDataFrame(
            [(i, j, float(x)) for i, line in enumerate(model.transition) for j, x in enumerate(line)], "ac int, bc int, value double")
        others = others.withColumn("at", F.coalesce("cls", F.lit(rare)))
        for before, after, name in (("before", "at", "into"), ("at", "after", "out")):
            step = value.select(F.col("ac").alias(before), F.col("bc").alias(after), F.col("value").alias(name))
            others = others.join(F.broadcast(step), [before, after], "left")
        emission += F.coalesce("into", F.lit(0.0)) + F.coalesce("out", F.lit(0.0))
    others = others.groupBy("rid").agg(
        F.count_if(c > 0).alias("more_known"),
        F.sum(F.log10((c + 1.0) / (tokens + 1.0 * (types + 1)))).alias("more_base"), F.sum(emission).alias("more_score"))
    if not once:
        steps = _known(scored.select("rid", F.inline("links")), assigned).join(F.broadcast(value), ["ac", "bc"]).groupBy("rid").agg(F.sum("value").alias("steps"))
        others = others.join(steps, "rid", "full_outer").withColumn(
            "more_score", F.coalesce("more_score", F.lit(0.0)) + F.coalesce("steps", F.lit(0.0))).drop("steps")
    ids = rows.select("rid", id_col)
    out = scored.drop("others", "links").join(others, "rid", "left").join(ids, "rid")
    total = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return out.select(
        id_col, "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), total.alias("score"),
        F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"))
