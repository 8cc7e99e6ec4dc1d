"""Best-fit packing of token sequences by a configuration linear program.

Only the histogram of piece lengths (at most ``capacity`` entries) reaches the driver. The program
over configurations - multisets of lengths that fit a sequence - is solved in whole sequences by
multiplicative weights: lengths carry weights, a knapsack over the capacity prices for each length
the configuration of most weight that holds it, the fullest of these are used as often as the pieces
left allow, and the weights of what they cover fall. Rounds go on until no configuration is nearly
full; what is left then is packed best-fit by length. Pieces find their place by their rank
among those of their length, which is counted in salted groups.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from .common import keep, slices

#: Share of a configuration that may stay empty, beyond that of the fullest, in the first rounds.
SLACK = 1e-4
#: A round that places a smaller share of what is left doubles the slack.
LITTLE = 0.002
#: Ways of rounding the program: part of the sequences allowed that a round takes, how fast weights fall, last slack.
WAYS = ((1.0, 1.0, 0.02), (0.2, 300.0, 0.02), (0.5, 1.0, 0.005), (0.5, 1.0, SLACK))
#: Words whose ids a worker remembers, and words encoded at a time: what an encoding holds besides its ids is large.
KEPT_WORDS, AT_ONCE = 400_000, 4096
#: Words of letters that are encoded as one text; the encoding of a word by itself takes twice as long.
JOINED = 256
#: Words that a worker remembers from one task to the next.
IDLE_WORDS = 30_000
#: Pieces of a length that are numbered together.
GROUP = 20_000


#: U+001C to U+001F, at which white space is split though the tokenizer takes them for characters.
CONTROLS = "[\x1c-\x1f]"
#: Words between characters of Unicode's white space.
WORDS = re.compile(r"(?:\S|[\x1c-\x1f])+")


#: A tokenizer that lower-cases and cuts like this takes a word's marks for themselves.
LOWERS, CUTS = {"type": "Lowercase"}, "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: What lower case may change before the tokenizer sees it: characters that combine with letters, special tokens.
KEEPS_CASE = "[\u0300-\u036f]|<\\|"


def folds(tokenizer: Tokenizer) -> bool:
    """Whether ids stay the same if A-Z is lower-cased and marks behind a letter are cut off before."""
    made = json.loads(tokenizer.to_str())
    normal, cuts = made.get("normalizer") or {}, made.get("pre_tokenizer") or {}
    first = (cuts.get("pretokenizers") or [{}])[0]
    return (LOWERS in normal.get("normalizers", []) and first.get("type") == "Split" and first.get("pattern") == {"Regex": CUTS}
            and first.get("invert") is True and first.get("behavior") == "Removed")


def last_tokens(tokenizer: Tokenizer) -> np.ndarray | None:
    """By id, whether a token ends a word; None if tokens don't tell."""
    suffix = json.loads(tokenizer.to_str())["model"].get("end_of_word_suffix")
    if not suffix or not folds(tokenizer):
        return None
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return ends


def split_words(texts: pa.Array, fold: bool = False) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, and where each text's begin (and the end). With ``fold``
    a mark behind a letter begins a word of its own, and A-Z is lower-cased: fewer words are different."""
    texts = pc.fill_null(texts, "")
    if fold and not pc.any(pc.match_substring_regex(texts, KEEPS_CASE)).as_py():
        texts = pc.replace_substring_regex(pc.ascii_lower(texts), "([a-z])([.,!?;:])", "\\1 \\2")
    if pc.any(pc.match_substring_regex(texts, CONTROLS)).as_py():
        split = pa.array([WORDS.findall(t) for t in texts.to_pylist()], pa.list_(pa.string()))
    else:
        split = pc.utf8_split_whitespace(texts)
    starts, words = split.offsets.to_numpy().astype(np.int64), split.values
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    return words.filter(pa.array(real)), before[starts - starts[0]]


class WordTokens:
    """Token ids of texts, by a tokenizer that drops white space. The ids of each word met lie in one flat
    array and are gathered by number; a worker remembers up to ``KEPT_WORDS`` words."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.fold, self.last = folds(self.tokenizer), last_tokens(self.tokenizer)
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encoded(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The words in another order, their ids and how many each has. Words of letters are encoded many at a time
        and told apart by the tokens that end one; where the tokenizer finds more words than it was given, each by itself."""
        made, ids, sizes = [], [], []
        letters = [w for w in words if w.isalpha()] if self.last is not None else []
        alone = [w for w in words if not w.isalpha()] if letters else words
        for i in range(0, len(letters), AT_ONCE):
            parts = [letters[j:min(j + JOINED, i + AT_ONCE)] for j in range(i, min(i + AT_ONCE, len(letters)), JOINED)]
            for part, e in zip(parts, self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False), strict=True):
                got = np.array(e.ids, np.uint32)
                last = np.flatnonzero(self.last[got])
                if len(last) == len(part):
                    made += part
                    ids.append(got), sizes.append(np.diff(last, prepend=-1))
                else:
                    alone += part
        for i in range(0, len(alone), AT_ONCE):
            got = [e.ids for e in self.tokenizer.encode_batch_fast(alone[i:i + AT_ONCE], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
            ids.append(np.fromiter(chain.from_iterable(got), np.uint32, int(sizes[-1].sum())))
        return made + alone, np.concatenate(ids), np.concatenate(sizes)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, each text's followed by a 0, and where each text's end."""
        words, ends = split_words(texts, self.fold)
        coded = words.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.numbers) + len(names) > KEPT_WORDS:
            self.forget()
        new = [w for w in names if w not in self.numbers]
        if new:
            new, made, sizes = self.encoded(new)
            self.numbers.update(zip(new, range(len(self.numbers), len(self.numbers) + len(new)), strict=True))
            self.ids = np.concatenate([self.ids, made])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        number = np.fromiter(map(self.numbers.__getitem__, names), np.int64, len(names))[coded.indices.to_numpy()]
        # one more word a text, of the single id 0
        last = len(self.starts) - 1
        number = np.insert(number, ends[1:], last)
        ids, starts = np.append(self.ids, np.uint32(0)), np.append(self.starts, self.starts[-1] + 1)
        sizes = starts[number + 1] - starts[number]
        upto = np.cumsum(sizes)
        at = np.arange(int(upto[-1]) if len(upto) else 0, dtype=np.int32) + np.repeat((starts[number] - (upto - sizes)).astype(np.int32), sizes)
        return ids[at], upto[ends[1:] + np.arange(len(ends) - 1)]


@lru_cache(maxsize=1)
def _worker_tokens(path: str) -> WordTokens:
    """One for all tasks of a Python worker. Tasks run side by side, so the tokenizer needs no threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokens(path)


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _worker_tokens(path)
        for batch in slices(batches, 500):
            ids, ends = words.of(batch.column(1))
            data = memoryview(ids.astype("<u4")).cast("B")
            out, begin = [], 0
            for row, end in enumerate(ends.tolist()):
                for piece, start in enumerate(range(begin, end, capacity)):
                    stop = min(start + capacity, end)
                    out.append((row, piece, start - begin, stop - start, zlib.crc32(data[4 * start:4 * stop])))
                begin = end
            own = batch.column(0).take(pa.array([o[0] for o in out], pa.int64()))
            yield pa.RecordBatch.from_arrays([own, *(pa.array([o[i] for o in out], pa.int64()) for i in range(1, 5))],
                                             ["rid", "piece", "start", "length", "ids_crc32"])
        # an idle worker holds little
        if len(words.numbers) > IDLE_WORDS:
            words.forget()

    return run


def price(lengths: np.ndarray, weights: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The most weight that fits each room up to ``capacity``, and the index of a length (of the rising
    ``lengths``) in such a configuration, -1 if the room may be one less."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if upto[c]:
            value = best[c - lengths[:upto[c]]] + weights[:upto[c]]
            i = int(np.argmax(value))
            if value[i] > best[c]:
                best[c], choice[c] = value[i], i
    return best, choice


def solve(counts: dict[int, int], capacity: int, part: float, eta: float, widest: float) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """Whole sequences of configurations, and the pieces that none within the slack ``widest`` takes.

    A round prices all lengths left by one knapsack: the room a length leaves is filled with the most
    weight, so each has a configuration that holds it. Those within the slack of the fullest there is
    are taken, the longest length first, ``part`` of the times that the pieces left allow. Weights
    fall with what is covered by ``eta``; the slack doubles when a round places little.
    """
    left, made, slack = {n: c for n, c in counts.items() if c}, [], SLACK
    while len(left) > 1 and slack <= widest:
        lengths = np.array(sorted(left), np.int64)
        open_ = np.array([left[n] / counts[n] for n in lengths.tolist()])
        size = lengths / capacity
        fullest = price(lengths, lengths.astype(np.float64), capacity)[0][capacity]
        # a long piece weighs more than short ones of its sum: these fill what is left later
        weight = size * (1 + 0.5 * size) * np.exp(eta * slack * (open_ - open_.mean()))
        choice, names = price(lengths, weight, capacity)[1].tolist(), lengths.tolist()
        before = sum(left.values())
        for n in reversed(names):
            if not left.get(n):
                continue
            content, room = {n: 1}, capacity - n
            while room > 0:
                if choice[room] < 0:
                    room -= 1
                    continue
                m = names[choice[room]]
                content[m] = content.get(m, 0) + 1
                room -= m
            if sum(m * a for m, a in content.items()) < fullest * (1 - slack):
                continue
            most = min(left.get(m, 0) // a for m, a in content.items())
            if most:
                made.append((content, max(1, int(most * part))))
                for m, a in content.items():
                    left[m] -= a * made[-1][1]
                    if not left[m]:
                        del left[m]
        if sum(left.values()) > (1 - LITTLE) * before:
            slack *= 2
    return made, left


def plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Whole sequences: (how often each length, how many such sequences); every piece is in one.

    The program is rounded by each of ``WAYS`` until one comes within a thousandth of the lower bound;
    else the one of fewest sequences is taken. Best-fit decreasing places what the program leaves.
    """
    short = {n: c for n, c in counts.items() if n < capacity and c}
    alone = [({capacity: 1}, counts[capacity])] if counts.get(capacity) else []
    least = -(-sum(n * c for n, c in short.items()) // capacity)
    best: tuple[int, list] | None = None
    for way in WAYS:
        made, left = solve(short, capacity, *way)
        made = made + best_fit(left, capacity)
        total = sum(n for _, n in made)
        if best is None or total < best[0]:
            best = total, made
        if total <= 1.001 * least:
            break
    return alone + best[1]


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing over a histogram: alike sequences are handled together, so the work
    depends on the number of lengths and not of pieces."""
    bins: dict[int, dict[tuple, int]] = {}  # room left -> contents -> how many
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        todo = counts[length]
        while todo:
            room = min((r for r in bins if r >= length), default=None)
            if room is None:
                fit = capacity // length
                n, rest = divmod(todo, fit)
                for many, a in ((n, fit), (1 if rest else 0, rest)):
                    if many:
                        key = ((length, a),)
                        at = bins.setdefault(capacity - a * length, {})
                        at[key] = at.get(key, 0) + many
                break
            content, have = next(iter(bins[room].items()))
            fit = min(room // length, todo)
            n = min(have, todo // fit)
            bins[room][content] = have - n
            if have == n:
                del bins[room][content]
                if not bins[room]:
                    del bins[room]
            key = (*content, (length, fit))
            at = bins.setdefault(room - fit * length, {})
            at[key] = at.get(key, 0) + n
            todo -= fit * n
    out = []
    for at in bins.values():
        for content, n in at.items():
            merged: dict[int, int] = {}
            for length, a in content:
                merged[length] = merged.get(length, 0) + a
            out.append((merged, n))
    return out


def _slots(made: list[tuple[dict[int, int], int]]) -> tuple[np.ndarray, ...]:
    """By (length, first rank): copies in a sequence, first sequence, offset of the first copy."""
    rows, seen, sequence = [], {}, 0
    for content, n in made:
        offset = 0
        for length, a in sorted(content.items(), reverse=True):
            rank = seen.get(length, 0)
            rows.append((length, rank, a, sequence, offset))
            seen[length] = rank + a * n
            offset += a * length
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return tuple(table.T)


def _placed(slots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, copies, first, offset = slots.value
        key = length << np.int64(48) | rank
        for batch in batches:
            own, at = (batch.column(batch.schema.get_field_index(k)).to_numpy() for k in ("length", "rank"))
            i = np.searchsorted(key, own << np.int64(48) | at, side="right") - 1
            q = at - rank[i]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first[i] + q // copies[i]), pa.array(offset[i] + q % copies[i] * own)],
                [*batch.schema.names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row.

    A row's ids are those of its text and a final 0; only more than ``capacity`` ids are cut, into
    pieces of that many and a rest. Each piece lies whole in one sequence, without gaps. A null or
    empty text is the 0 alone. Repeated rows and equal or null ids are packed like any other row, ids of any type.
    Other columns are not read. An empty table gives an empty result. ``tokenizer``: file of a
    tokenizer that drops white space; words are cut at white space before it sees them.
    """
    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    given = docs.select(F.col(id_col).alias("rid"), F.col(text_col))
    kind = given.schema["rid"].dataType.simpleString()
    pieces = keep(given.mapInArrow(_pieces(path, capacity), f"rid {kind}, piece long, start long, length long, ids_crc32 long")
                  .withColumn("salt", F.monotonically_increasing_id()), "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(plan(counts, capacity)))

    # pieces of a length are numbered in groups, whatever ids and texts repeat
    groups = max(1, -(-sum(counts.values()) // GROUP))
    dealt = pieces.withColumn("lane", F.pmod(F.xxhash64("salt"), F.lit(groups)))
    before = (dealt.groupBy("length", "lane").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("lane")) - F.col("n")).drop("n"))
    order = Window.partitionBy("length", "lane").orderBy("salt")
    ranked = (dealt.withColumn("place", F.row_number().over(order) - 1).join(before, ["length", "lane"])
              .select("rid", "piece", "start", "length", "ids_crc32", (F.col("place") + F.col("before")).alias("rank")))
    names = f"rid {kind}, piece long, start long, length long, ids_crc32 long, rank long, sequence_id long, offset long"
    return ranked.mapInArrow(_placed(slots), names).drop("rank").withColumnRenamed("rid", id_col)
