"""N-gram Jaccard join by prefix trees.

Every text is the set of its word n-grams, kept in one global order: by how often the n-gram's
slot of a fixed-size count table is hit in the corpus, rare first, then by hash. Two sets that
reach the similarity share an n-gram among the first ``n - ceil(t * n) + 1`` of either
(the prefix), so only prefixes are shuffled. The texts that share a prefix n-gram put what
follows it into a prefix tree; a walk down the tree carries the overlap found so far for all
texts below and leaves a subtree when the lengths left cannot reach the needed overlap. A pair is
taken where its sets first meet.

A group of near copies would make a pair of any two members. The join therefore goes in
rounds. In the first, each set meets only the smallest set of its prefix n-gram and length band;
the verified pairs give provisional components. Then the trees join what shares a prefix n-gram
*across* provisional components: a row gives a few likeliest partners, more in each round, until no
candidate is left untried. So no link that could change a component is missed. N-grams shared by very many sets are split into square cells of bounded
size. A candidate pair is first held against
the sets' counts in hash bins, which bound their overlap from above, and is then verified on the
whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, flat, keep, lists, mix, shingle_sets, signed, slices, with_row_id
from .components import components
from .runs import dealt, sorted_groups

#: Slots of the table of n-gram counts that fixes the global order. Any value gives the same result.
SLOTS = 1 << 16
#: Sets sharing an n-gram above which its rows are dealt to several tasks. Any value gives the same result.
HOT = 4096
#: Side of a cell in which a tree joins sets. Any value gives the same result.
CELL = 1024
#: Bins whose counts bound the overlap of two sets where they first meet. Any value gives the same result.
COARSE = 64
#: Ids that a join may send to every task (16 bytes each); more are shuffled.
LISTED = 1_000_000
#: Candidates of other components that a row gives in a round of a cell, and how much more in the next.
FIRST, MORE = 2, 512
#: N-grams after the shared one that go into the trees. Any value gives the same result.
WINDOW = 8


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(48)).astype(np.int64)


def _signature(h: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(h.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _need(n: int, percent: int) -> int:
    """Overlap that a set of n must have with any partner."""
    return -(-percent * n // 100)


def _sets(size: int):
    """Per row its set's size and signature; at the end of the task its slot counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in slices(batches):
            n, s1, s2, hit = [], [], [], []
            for h in shingle_sets(batch.column(1), size):
                a, b = _signature(h)
                n.append(len(h)), s1.append(a), s2.append(b), hit.append(_slot(h))
            counts += np.bincount(flat(hit, np.int64), minlength=SLOTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64()), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.int64())],
                ["id", "n", "s1", "s2", "slot", "hits"])
        at = np.flatnonzero(counts)
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(at, pa.int32()), pa.array(counts[at])],
                                         ["id", "n", "s1", "s2", "slot", "hits"])

    return run


def _ordered(h: np.ndarray, hits: np.ndarray) -> np.ndarray:
    return h[np.lexsort((h, hits[_slot(h)]))]


def _prefix(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of the first n-grams of a set of ``n`` one must be shared with any partner."""
    return n - _need(n, percent) + 1


def _described(size: int, percent: int, order):
    """For each row with n-grams its set's size, its counts in bins, and its prefix with WINDOW n-grams more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = order.value
        for batch in slices(batches, 500):
            sets = shingle_sets(batch.column(1), size)
            filled = np.array([len(h) > 0 for h in sets], bool)
            sets = [h for h in sets if len(h)]
            n = np.array([len(h) for h in sets], np.int64)
            most = _prefix(n, percent) + WINDOW
            first = [_ordered(h, hits)[:m] for h, m in zip(sets, most.tolist(), strict=True)]
            coarse = [np.bincount((h & np.uint64(COARSE - 1)).astype(np.int64), minlength=COARSE) for h in sets]
            # too many to count: may be anything
            coarse = [c if c.max() < 32767 else np.full(COARSE, 32767) for c in coarse]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(filled)), pa.array(n, pa.int32()), pa.array([_bins(h) for h in sets], pa.binary()),
                 lists(flat(coarse, np.int64).astype(np.int16), [COARSE] * len(sets)),
                 lists(signed(flat(first, np.uint64)), [len(x) for x in first])],
                ["node", "n", "bins", "coarse", "prefix"])

    return run


def _prefix_rows(percent: int, order, typical: int):
    """A row for each prefix n-gram of a set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = order.value
        for batch in slices(batches):
            n, held = batch.column(1).to_numpy().astype(np.int64), np.diff(batch.column(2).offsets.to_numpy())
            lengths = _prefix(n, percent)
            at = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
            inside = at < np.repeat(lengths, held)
            t, at = batch.column(2).flatten().to_numpy()[inside], at[inside]
            node = np.repeat(batch.column(0).to_numpy(), lengths)
            parts = np.maximum(1, (hits[_slot(t.view(np.uint64))] - typical) // HOT).astype(np.uint64)
            salt = mix(node.view(np.uint64) * GOLDEN) % parts
            yield pa.RecordBatch.from_arrays(
                [pa.array(t), pa.array(salt.astype(np.int32)), pa.array((parts > 1).astype(np.int32)), pa.array(node),
                 pa.array(at.astype(np.int32))], ["token", "salt", "hot", "node", "pos"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prefix rows whose n-gram more than one set has (or that is dealt to several tasks)."""
    for table, starts in sorted_groups(batches, ["token"]):
        table = table.slice(0, starts[-1])
        sizes = np.diff(starts)
        take = np.repeat(sizes > 1, sizes) | (table.column("hot").to_numpy() == 1)
        if take.any():
            yield from table.select(["node", "pos"]).filter(pa.array(take)).to_batches()


def _bins(h: np.ndarray) -> bytes:
    """How many n-grams fall into each of about n / 2 bins, a power of two; 255 means that or more."""
    n = 1 << max(6, min(16, (len(h) // 2).bit_length()))
    return np.minimum(np.bincount((h & np.uint64(n - 1)).astype(np.int64), minlength=n), 255).astype(np.uint8).tobytes()


def overlap_bound(a: bytes, b: bytes) -> int | None:
    """No two sets with these bins share more n-grams; None: can't tell."""
    x, y = np.frombuffer(a, np.uint8).astype(np.int64), np.frombuffer(b, np.uint8).astype(np.int64)
    if (x == 255).any() or (y == 255).any():
        return None
    n = min(len(x), len(y))
    return int(np.minimum(x.reshape(-1, n).sum(0), y.reshape(-1, n).sum(0)).sum())


def _within_bound(percent: int):
    """The pairs that their bins leave possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            col = {k: batch.column(batch.schema.get_field_index(k)) for k in ("na", "nb", "bins_a", "bins_b")}
            ok = []
            for na, nb, x, y in zip(*(col[k].to_pylist() for k in ("na", "nb", "bins_a", "bins_b")), strict=True):
                most = overlap_bound(x, y)
                ok.append(most is None or (100 + percent) * most >= percent * (na + nb))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _token_lists(size: int):
    """The whole set of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            sets = shingle_sets(batch.column(1), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists(signed(flat(sets, np.uint64)), [len(x) for x in sets])], ["node", "tokens"])

    return run


def _verified(percent: int):
    """The pairs (a, b) whose whole sets ``ta`` and ``tb`` reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            ta, tb = batch.column(2), batch.column(3)
            ok = []
            for i in range(batch.num_rows):
                x, y = ta[i].values.to_numpy(), tb[i].values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


class PrefixTree:
    """Sets of a group by what follows the shared n-gram; nodes keep the bounds of what is below."""

    __slots__ = ("children", "members", "smallest", "longest")

    def __init__(self) -> None:
        self.children: dict[int, PrefixTree] = {}
        self.members: list[tuple[int, int, int, int]] = []  # row, n, left after the window, component
        self.smallest, self.longest = math.inf, 0

    def add(self, window: list[int], row: int, n: int, left: int, component: int) -> None:
        node = self
        for depth, token in enumerate([None, *window]):
            if token is not None:
                node = node.children.setdefault(token, PrefixTree())
            node.smallest, node.longest = min(node.smallest, n), max(node.longest, left - depth)
        node.members.append((row, n, left - len(window), component))

    def partners(self, window: list[int], n: int, left: int, component: int, percent: int) -> Iterator[int]:
        """Rows of other components that may reach the similarity. ``left``: n-grams of the probing
        set after the shared one. The walk holds the overlap so far and how many n-grams of the
        probe the path has passed."""
        at = {t: i for i, t in enumerate(window)}

        def reach(overlap: int, mine: int, theirs: int, other: float) -> bool:
            return (100 + percent) * (1 + overlap + min(mine, theirs)) >= percent * (n + other)

        stack = [(self, 0, 0)]
        while stack:
            node, overlap, passed = stack.pop()
            if not reach(overlap, left - passed, node.longest, node.smallest):
                continue
            for row, other, rest, comp in node.members:
                if comp != component and reach(overlap, left - passed, rest, other) \
                        and 100 * min(n, other) >= percent * max(n, other):
                    yield row
            for token, child in node.children.items():
                i = at.get(token)
                stack.append((child, overlap, passed) if i is None else (child, overlap + 1, max(passed, i + 1)))


def _tree_pairs(percent: int, most_each: int):
    """Candidate pairs of each (token, cell). Rows of ``side`` 0 are put into the tree, rows of
    side 1 only probe it; in a cell on the diagonal (side 2) every row does both. A row gives its
    likeliest partners only, ``most_each`` of them and in the first round one of a component. Where it
    has more, a row names the node with its ``token`` and ``cell`` and no partner: in the next round only
    such rows probe (``probes``)."""
    one = most_each == FIRST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in sorted_groups(batches, ["token", "cell"]):
            col = {k: table.column(k).to_numpy() for k in ("node", "component", "n", "pos", "side", "token", "cell", "probes")}
            windows, befores = (table.column(k).combine_chunks() for k in ("window", "before"))
            coarse = table.column("coarse").combine_chunks().values.to_numpy().reshape(-1, COARSE)
            a, b, more = [], [], []
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if (col["component"][lo:hi] == col["component"][lo]).all():
                    continue
                tree = PrefixTree()
                for i in range(lo, hi):
                    n, comp, side = int(col["n"][i]), int(col["component"][i]), col["side"][i]
                    left, window = n - int(col["pos"][i]) - 1, windows[i].as_py()
                    if side and col["probes"][i]:
                        found = list(tree.partners(window, n, left, comp, percent))
                        if found:
                            at = np.array(found)
                            most = np.minimum(coarse[at], coarse[i]).sum(1, dtype=np.int64)
                            earlier = set(befores[i].as_py())
                            sizes = n + col["n"][at].astype(np.int64)
                            likely = np.flatnonzero((100 + percent) * most >= percent * sizes)
                            likely = likely[np.argsort(-most[likely] / sizes[likely], kind="stable")]
                            found, met, cut = [], set(), False
                            for j in at[likely].tolist():
                                # a pair that shares an earlier n-gram was met there
                                if not earlier.isdisjoint(befores[j].as_py()):
                                    continue
                                other = int(col["component"][j])
                                if len(found) == most_each or (one and other in met):
                                    cut = True
                                    if len(found) == most_each:
                                        break
                                    continue
                                found.append(j)
                                met.add(other)
                            if cut:
                                more.append(i)
                        a += [int(col["node"][i])] * len(found)
                        b += [int(col["node"][j]) for j in found]
                    if side != 1:
                        tree.add(window, i, n, left, comp)
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            late, none = np.array(more, np.int64), pa.nulls(pairs.shape[1], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([pairs[0], col["node"][late]])),
                 pa.array([*pairs[1].tolist(), *[None] * len(late)], pa.int64()),
                 pa.concat_arrays([none, pa.array(col["token"][late], pa.int64())]),
                 pa.concat_arrays([none, pa.array(col["cell"][late], pa.int64())])], ["a", "b", "token", "cell"])

    return run


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id) for each row of ``docs``.

    Two rows link when ``100 * |x & y| >= percent * |x | y|`` over their distinct runs of ``size``
    words (a shorter text is one run). ``component_id`` is the smallest id reachable by links, the
    own included. Null or blank texts have no n-grams and link with nothing. A row without an id
    takes no part; its component is null. Rows of equal sets are one node, whatever their ids; with a
    repeated id each row gets the component of its own text. Ids may be of any type that has an order.
    Other columns of ``docs`` are not read. An empty table gives an empty result. Texts of any length are
    sets like any other. n-grams are compared by 64-bit hashes, whole sets by 128-bit ones.
    """
    spark = docs.sparkSession
    numbered = with_row_id(docs, id_col, "jaccard-docs", text_col)
    given = numbered.where(F.col(id_col).isNotNull()).select(F.col("rid").alias("id"), F.col(text_col).alias("text"))
    scanned = keep(numbered.select(F.col("rid").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _sets(size), "id long, n long, s1 long, s2 long, slot int, hits long"), "sets")
    own = scanned.where("n is not null").select("id", "n", "s1", "s2").join(numbered.select(F.col("rid").alias("id"), F.col(id_col).alias("name")), "id")
    hits = np.zeros(SLOTS, np.int64)
    for row in scanned.where("slot is not null").groupBy("slot").agg(F.sum("hits").alias("hits")).toLocalIterator():
        hits[row.slot] = row.hits
    order, typical = spark.sparkContext.broadcast(hits), int(np.median(hits))
    classes = keep(own.where("n > 0 and name is not null").groupBy("s1", "s2").agg(F.min("id").alias("node"), F.min("name").alias("name")),
                   "classes")

    # one row of each set, with all that is asked of it but the whole set
    nodes = keep(given.select("id", "text").mapInArrow(
        _described(size, percent, order), "node long, n int, bins binary, coarse array<smallint>, prefix array<long>")
        .join(classes.select("node"), "node", "left_semi"), "nodes")
    rows = nodes.select("node", "n", "prefix").mapInArrow(
        _prefix_rows(percent, order, typical), "token long, salt int, hot int, node long, pos int")
    at = (rows.repartition("token", "salt").sortWithinPartitions("token").mapInArrow(_shared, "node long, pos int")
          .groupBy("node").agg(F.collect_list("pos").alias("at")))
    described = keep(nodes.join(at, "node"), "described")

    def placed(sets: DataFrame) -> DataFrame:
        """A row for each shared n-gram of the prefixes, with those next to it."""
        return sets.withColumn("pos", F.explode("at")).withColumns({
            "token": F.get("prefix", "pos"),
            "before": F.slice("prefix", F.greatest(F.col("pos") - WINDOW, F.lit(0)) + 1, F.least("pos", F.lit(WINDOW))),
            "window": F.slice("prefix", F.col("pos") + 2, F.lit(WINDOW))}).drop("prefix", "at", "bins")

    def verified(pairs: DataFrame) -> DataFrame:
        """First by the bins, then those left by their whole sets."""
        first = pairs.join(described.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bins").alias("bins_b")), "b")
        both = first.join(described.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bins").alias("bins_a")), "a")
        likely = keep(both.select("a", "b", "na", "nb", "bins_a", "bins_b").mapInArrow(
            _within_bound(percent), "a long, b long").distinct(), "likely")
        nodes = likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id"))).distinct()
        few = nodes.limit(LISTED + 1).count() <= LISTED
        sets = keep(given.join(F.broadcast(nodes) if few else nodes, "id", "left_semi").mapInArrow(
            _token_lists(size), "node long, tokens array<long>"), "tokens")
        first = likely.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b")
        both = first.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
        return keep(both.select("a", "b", "ta", "tb").mapInArrow(_verified(percent), "a long, b long").distinct(), "links")

    band = F.floor(F.log(F.col("n").cast("double")) / -math.log(percent / 100)) if percent < 100 else F.col("n")
    banded = placed(described).select("token", "node", "n", "coarse", band.cast("long").alias("band"))
    leaders = (banded.groupBy("token", "band").agg(F.min(F.struct("n", "node")).alias("leader"), F.count("*").alias("m"))
               .where("m > 1").select(F.col("token").alias("t"), F.col("band").alias("bb"), F.col("leader.node").alias("b"),
                                      F.col("leader.n").alias("nb"))
               .join(described.select(F.col("node").alias("b"), F.col("coarse").alias("other")), "b"))
    most = F.aggregate(F.zip_with("coarse", "other", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    stars = (banded.join(leaders, (F.col("token") == F.col("t")) & (F.col("band") == F.col("bb")) & F.expr(f"node <> b and 100 * nb >= {percent} * n")
                         & ((100 + percent) * most >= percent * (F.col("n") + F.col("nb"))))
             .select(F.col("node").alias("a"), "b").distinct())
    links = verified(stars)
    first = components(links)

    # N-grams of many sets, whose rows are dealt to cells: at most a row in CELL has one.
    crowded = keep(placed(described).groupBy("token").agg(F.count("*").alias("m")).where(F.col("m") > CELL)
                   .select("token", F.ceil(F.col("m") / CELL).cast("int").alias("side_cells")), "crowded")

    def sent(few: DataFrame) -> DataFrame:
        return F.broadcast(few) if few.limit(LISTED + 1).count() <= LISTED else few

    # Each round takes a few candidates a row, and joins what they link; members of a group of near copies
    # soon share a component and are no candidates any more. The last round leaves none untried.
    joined, most_each, again = first, FIRST, None
    while True:
        now = placed(described.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")))
        if again is not None:
            now = now.join(sent(again.select("token").distinct()), "token", "left_semi")
        # rows of one component alone are left by the trees, but make no cells first
        split = (now.join(sent(crowded), "token").groupBy("token", "side_cells")
                 .agg((F.min("component") < F.max("component")).alias("across")))
        g, mine = F.col("side_cells"), F.pmod(F.xxhash64("node"), F.col("side_cells")).cast("int")
        cells = (now.join(sent(split), "token", "left").where("across IS NULL OR across")
                 .withColumn("side_cells", F.coalesce("side_cells", F.lit(1))).withColumn("mine", mine)
                 .withColumn("other", F.explode(F.sequence(F.lit(0), g - 1)))
                 .withColumn("cell", (F.least("mine", "other").cast("long") * g + F.greatest("mine", "other")))
                 .withColumn("side", F.when(F.col("mine") == F.col("other"), 2)
                             .when(F.col("mine") < F.col("other"), 0).otherwise(1)))
        if again is None:
            cells = cells.withColumn("probes", F.lit(True))
        else:
            # the number of rows of an n-gram does not change, so a cell is what it was
            cells = (cells.join(again.select("token", "cell").distinct(), ["token", "cell"], "left_semi")
                     .join(again.withColumn("probes", F.lit(True)), ["token", "cell", "node"], "left")
                     .withColumn("probes", F.coalesce("probes", F.lit(False))))
        pairs = keep(dealt(cells.select("token", "cell", "side", "node", "component", "n", "pos", "coarse", "before", "window", "probes"),
                           ["token", "cell"], ["side", "node"])
                     .mapInArrow(_tree_pairs(percent, most_each), "a long, b long, token long, cell long"), "pairs")
        more = verified(pairs.where("b is not null").select("a", "b").distinct())
        joined = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
        again = pairs.where("b is null").select("token", "cell", F.col("a").alias("node")).distinct()
        if again.isEmpty():
            break
        most_each *= MORE

    roots = classes.join(joined, "node", "left").withColumn("root", F.coalesce("component", "node"))
    smallest = roots.groupBy("root").agg(F.min("name").alias("smallest"))
    with_set = (own.where("n > 0 and name is not null")
                .join(roots.join(smallest, "root").select("s1", "s2", "smallest"), ["s1", "s2"]).select("name", "n", "smallest"))
    alone = own.where("n = 0 or name is null").select("name", "n", F.col("name").alias("smallest"))
    return with_set.unionByName(alone).select(
        F.col("name").alias(id_col), F.col("n").alias("n_shingles"), F.col("smallest").alias("component_id"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each component does: that of the smallest
    ``doc_id``; rows without an id or without words stay."""
    found = jaccard_components(docs, size, percent)
    drop = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(drop, "doc_id", "left_anti").select(*docs.columns)
