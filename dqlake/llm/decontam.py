"""Benchmark decontamination by template windows.

Everything is DataFrame expressions. Numbers, units and names become typed placeholders, so a
question with other numbers or names keeps its template. Windows of ``window`` canonical words are
hash-joined with those of the benchmark. Matches that lie on one alignment (text position less item
position) are one occurrence; it counts if its slots are consistent: each value of the item stands
for one and the same value in the text. An item is found in a text when consistent occurrences cover
the share ``covered`` of its windows, or when one of them, with the item's own values, runs over ``RUN``
windows without a gap. Windows that are mostly placeholders say nothing by their words: they match
with their values only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, with_row_id
from .pii import GIVEN

WINDOW = 8
#: Share of an item's windows that a text has to hold.
COVERED = 0.5
#: Windows in a row that prove a quotation, whatever the item's length: 32 words at windows of 8.
RUN = 25
#: Benchmark windows up to which they are sent to all tasks (under 100 bytes each); more are shuffled.
BROADCAST_WINDOWS = 500_000

# Units of measure and money.
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "feet", "foot", "yards", "mile", "miles", "metre", "metres", "meter", "meters",
    "mg", "g", "kg", "tons", "pound", "pounds", "ounces", "ml", "l", "litre", "litres", "liter", "liters", "gallons",
    "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years",
    "euro", "euros", "dollar", "dollars", "cents", "usd", "eur", "percent", "degrees", "celsius", "mph", "kmh",
)
NUMBER_WORDS = ("two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "twenty", "hundred", "thousand")
NAMES = tuple(n for names in GIVEN.values() for n in names)
PUNCTUATION = ".,;:!?\"'()[]{}<>«»„“”‘’…*_|"


def canonical(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` with the canonical words ``c`` of a text and the values ``v`` of placeholders (null
    elsewhere; null for a text without any) in place of the text. One step a projection, so that none is computed twice.
    Punctuation and capitals are taken from the text as a whole, since a call for each word costs several times more."""
    others = [c for c in rows.columns if c != text_col]
    spaced = rows.select(*others, F.regexp_replace(text_col, r"[\x20\x09-\x0D]+", " ").alias("t"))
    bare = spaced.select(*others, "t", F.translate("t", PUNCTUATION, "").alias("b"))
    # the same spaces in all three, so the same number of words
    split = bare.select(*others, F.split("t", " ").alias("x"), F.split("b", " ").alias("b"), F.split(F.lower("b"), " ").alias("w"))
    zipped = split.select(*others, F.filter(F.arrays_zip("x", "b", "w"), lambda z: z["b"] != "").alias("x"))

    def kind(z: Column, i: Column) -> Column:
        b, w = z["b"], z["w"]
        head, ends = F.substring(b, 1, 1), F.substring(F.get("x", i - 1)["x"], -1, 1).isin(".", "!", "?", ":")
        number = head.between("0", "9") | (head.isin("+", "-", "$", "€", "£", "#") & F.substring(b, 2, 1).between("0", "9"))
        # a capital at the head only, and not where a sentence begins
        capital = (i > 0) & ~ends & (head != F.substring(w, 1, 1)) & (F.substring(b, 2, 1) == F.substring(w, 2, 1))
        # most words: small letters from a on and in no list
        plain = (b == w) & b.between("a", "~") & ~w.isin(*NUMBER_WORDS, *UNITS, *NAMES)
        return F.when(~plain, F.when(number | w.isin(*NUMBER_WORDS), "<number>").when((b != w) & (b.isin(*NAMES) | capital), "<name>")
                      .when(w.isin(*UNITS), "<unit>"))

    typed = zipped.select(*others, "x", F.transform("x", kind).alias("kind"))
    told = typed.select(*others, "x", "kind", F.exists("kind", lambda k: k.isNotNull()).alias("some"))
    return told.select(*others, F.when(F.col("some"), F.zip_with("x", "kind", lambda x, k: F.coalesce(k, x["w"]))).otherwise(F.col("x.w")).alias("c"),
                       F.when(F.col("some"), F.zip_with("x", "kind", lambda x, k: F.when(k.isNotNull(), x["w"]))).alias("v"), "some")


def windows(rows: DataFrame, id_col: str, text_col: str, sizes: list[int]) -> DataFrame:
    """(id_col, pos, n, h, slots, heavy): the windows of each text; ``slots`` holds the values in
    placeholders, and where these are more than half of the window (``heavy``) they are part of ``h``."""
    parts = canonical(rows.select(id_col, text_col), text_col).select(id_col, F.transform("c", lambda x: F.xxhash64(x)).alias("c"), "v", "some")

    def of_size(n: int) -> Column:
        # by position: cutting a slice would copy the whole text's array for each window
        at = F.sequence(F.lit(0), F.size("c") - n)
        none = F.lit(None).cast("array<string>")
        plain = F.transform(at, lambda i: F.struct(F.xxhash64(*(F.get("c", i + k) for k in range(n))).alias("h"), none.alias("slots")))
        slotted = F.transform(at, lambda i: F.struct(
            F.xxhash64(*(F.get("c", i + k) for k in range(n))).alias("h"),
            F.array_compact(F.array(*(F.get("v", i + k) for k in range(n)))).alias("slots")))
        return F.when(F.size("c") >= n, F.when(F.col("some"), slotted).otherwise(plain))

    def one(n: int) -> DataFrame:
        out = parts.select(id_col, F.posexplode(of_size(n)).alias("pos", "w")).select(id_col, "pos", F.lit(n).alias("n"), "w.h", "w.slots")
        heavy = F.coalesce(F.size("slots") * 2 > n, F.lit(False))
        return out.withColumns({"heavy": heavy, "h": F.when(heavy, F.xxhash64("h", "slots")).otherwise(F.col("h"))})

    each = [one(n) for n in sizes]
    out = each[0]
    for more in each[1:]:
        out = out.unionByName(more)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, covered: float = COVERED, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id_col, item_col, n_windows, n_matched, coverage, same_values): items that rows hold.

    ``same_values`` is false where only re-parameterised copies were found. Items shorter than
    ``window`` words are one window of their own length. Windows of which more than half are placeholders
    count only for items that have no others. ``coverage`` may be below ``covered`` where a run of ``RUN``
    windows was quoted. Null or empty texts match
    nothing. Rows with a null id, repeated rows and repeated items: each row is reported under its
    id, items of one id count as one. Extra columns are not read. Empty tables give an empty result.
    """
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("item_text")).where("item is not null")
    sized = (items.join(canonical(items, "item_text").groupBy("item").agg(F.max(F.size("c")).alias("words")), "item")
             .select(F.struct("item", F.least(F.lit(window), "words").alias("size")).alias("key"), "item_text"))
    # at most ``window`` different ones
    sizes = [r.n for r in sized.select(F.col("key.size").alias("n")).distinct().collect() if r.n and r.n > 0] or [window]
    parts = windows(sized, "key", "item_text", sorted(sizes))
    all_probes = keep(parts.where("n = key.size")
                      .select(F.col("key.item").alias("item"), "n", "h", F.col("pos").alias("at"), F.col("slots").alias("item_slots"), "heavy")
                      .dropDuplicates(["item", "n", "at", "h"]), "probes")
    plain = all_probes.groupBy("item").agg(F.bool_and("heavy").alias("only_heavy"))
    probes = all_probes.join(plain, "item").withColumn("counts", ~F.col("heavy") | F.col("only_heavy")).drop("heavy", "only_heavy")
    total = probes.where("counts").groupBy("item").agg(F.count_distinct("at").alias("n_windows"))
    few = probes.count() <= BROADCAST_WINDOWS
    rows = with_row_id(docs, id_col, "rows", text_col)
    found = windows(rows.where(F.col(text_col).isNotNull()), "rid", text_col, sorted(sizes)).drop("heavy")
    met = found.join(F.broadcast(probes) if few else probes, ["n", "h"])
    pairs = F.when(F.col("item_slots").isNull() | F.col("slots").isNull(), F.array().cast("array<struct<a:string,b:string>>")).otherwise(
        F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    aligned = (met.select("rid", "item", F.struct("at", "counts").alias("at"), (F.col("pos") - F.col("at")).alias("shift"), pairs.alias("pairs"))
               .groupBy("rid", "item", "shift")
               .agg(F.array_sort(F.collect_set("at")).alias("at"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")))
    consistent = aligned.where(F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["a"]))))
    ends = F.sequence(F.lit(RUN - 1), F.size("at") - 1)
    run = F.when(F.size("at") >= RUN, F.exists(ends, lambda i: F.get("at", i)["at"] - F.get("at", i - (RUN - 1))["at"] == RUN - 1))
    held = (consistent.withColumn("same", ~F.exists("pairs", lambda p: p["a"] != p["b"]))
            .withColumn("run", F.col("same") & F.coalesce(run, F.lit(False)))
            .select("rid", "item", "same", "run", F.explode("at").alias("w"))
            .groupBy("rid", "item").agg(F.count_distinct(F.when(F.col("w.counts"), F.col("w.at"))).alias("n_matched"),
                                        F.max("same").alias("same_values"), F.max("run").alias("run")))
    out = held.join(total, "item").withColumn("coverage", F.col("n_matched") / F.col("n_windows")).where((F.col("coverage") >= covered) | F.col("run"))
    return (out.join(rows.select("rid", id_col), "rid")
            .select(id_col, F.col("item").alias(item_col), "n_windows", "n_matched", "coverage", "same_values"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no item; rows with a null id stay."""
    return docs.join(contaminated(docs, benchmark, **options).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
