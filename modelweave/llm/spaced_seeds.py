"""Benchmark decontamination with spaced seeds, in DataFrame functions only.

Words are runs of letters and digits, lower-cased, as 64-bit hashes. A mask such as ``1101011`` lays a
window over consecutive words of which the positions marked 0 are ignored; the seed of a window is the hash
of the others. Seeds of all windows of the documents are joined with those of the benchmark items. Each hit
aligns a document with an item at one offset, and there all words are compared in place: the document holds
the item if, at one alignment, at least ``SHARE`` of the item's words are equal, or of any ``WINDOW``
consecutive ones. So words may be substituted, and a short phrase both have in common does not count.

The seeds of the items are broadcast where they are at most ``BROADCAST_SEEDS``, otherwise both sides are
shuffled by seed. Documents with hits are found again by broadcast of their ids under the same bound,
otherwise by a shuffle.

Defined results: a null or empty text or item has no words and no hits. An item with fewer words than the
longest mask is compared by the masks that fit; one with fewer than ``LEAST`` is held only word for word, and
found by one seed of all its words. Rows without a document id are not judged and stay. Equal items are found each by its own id; repeated documents give
one row per id and item. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.llm.common import written

MASKS = ("11011", "1101011", "11100101", "110010011")
WINDOW = 13
SHARE = 0.8
LEAST = 7
BROADCAST_SEEDS = 1_000_000  # rows of about 24 bytes


def word_hashes(text: Column) -> Column:
    # [\x00-\x2F\x3A-\x60\x7B-\x7F] is all ASCII but digits and lower-case letters
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1)
    return F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, masks: dict[int, str]) -> DataFrame:
    """All columns but ``h`` (the word hashes), the place ``at`` and the ``seed`` of every window."""
    keep = [c for c in rows.columns if c != "h"]
    least = min(map(len, masks.values()))
    # as long as the array is empty or short there is no place
    places = F.sequence(F.lit(0), F.size("h") - least)
    placed = rows.filter(F.size("h") >= least).select(*keep, "h", F.explode(places).alias("at"))

    def seed(number: int, mask: str) -> Column:
        taken = [F.get("h", F.col("at") + i) for i, bit in enumerate(mask) if bit == "1"]
        return F.when(F.col("at") + len(mask) <= F.size("h"), F.xxhash64(F.lit(number), *taken))

    seeds = F.array(*[seed(n, m) for n, m in masks.items()])
    return placed.select(*keep, "at", F.explode(seeds).alias("seed")).filter("seed is not null")


def leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", masks=MASKS, window: int = WINDOW, share: float = SHARE,
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """(doc_id, item_id, n_item_words, n_equal, best_window): items that documents hold."""
    texts = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text")).filter("doc is not null")
    bench = written(
        items.select(items[item_col].alias("item"), word_hashes(items[item_text_col]).alias("g"))
        .filter(F.size("g") > 0).distinct(),
        "items",
    )
    masks, long = dict(enumerate(masks)), F.size("g") >= LEAST
    seeded = _seeds(bench.filter(long).withColumnRenamed("g", "h"), masks)
    short = bench.filter(~long).select(F.size("g").alias("n")).distinct().collect()  # fewer than LEAST rows
    for n in sorted(r.n for r in short):
        whole = {-n: "1" * n}
        seeded = seeded.unionByName(_seeds(bench.filter(F.size("g") == n).withColumnRenamed("g", "h"), whole))
        masks |= whole
    wanted = written(seeded.withColumnRenamed("at", "item_at").distinct(), "item-seeds")
    small = wanted.count() <= broadcast_seeds
    held = _seeds(texts.select("doc", word_hashes(F.col("text")).alias("h")), masks)
    hits = held.join(F.broadcast(wanted) if small else wanted.hint("merge"), "seed").select(
        "doc", "item", (F.col("at") - F.col("item_at")).alias("shift")
    )
    hits = written(hits.distinct().groupBy("doc").agg(F.collect_list(F.struct("item", "shift")).alias("hits")), "hits")
    # ids and hits of the documents that have any: bounded by their count and by the hits they hold
    n = hits.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size("hits")), F.lit(0))).first()[0]
    near = texts.join(F.broadcast(hits) if n <= broadcast_seeds else hits, "doc")
    aligned = near.select("doc", word_hashes(F.col("text")).alias("h"), "hits").select(
        "doc", "h", F.explode("hits").alias("hit")
    ).select("doc", "h", "hit.item", "hit.shift")
    bench = F.broadcast(bench) if small else bench  # seeds are as many as words
    m = F.size("g")
    equal = F.transform(
        "g", lambda w, j: F.when(F.get("h", F.col("shift") + j) == w, F.lit(1)).otherwise(F.lit(0))
    )
    compared = aligned.join(bench, "item").select("doc", "item", m.alias("n_item_words"), equal.alias("equal"))
    width = F.least(F.col("n_item_words"), F.lit(window))

    def total(flags: Column) -> Column:
        return F.aggregate(flags, F.lit(0), lambda a, x: a + x)

    best = F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.col("n_item_words") - width + 1), lambda s: total(F.slice("equal", s, width))
        )
    )
    found = compared.select(
        "doc", "item", "n_item_words", total(F.col("equal")).alias("n_equal"), best.alias("best_window"),
        width.alias("width"),
    ).filter(
        F.when(F.col("n_item_words") < LEAST, F.col("n_equal") == F.col("n_item_words")).otherwise(
            (F.col("n_equal") >= share * F.col("n_item_words")) | (F.col("best_window") >= share * F.col("width"))
        )
    )
    return found.groupBy(F.col("doc").alias(id_col), F.col("item").alias(item_col)).agg(
        F.max("n_item_words").alias("n_item_words"), F.max("n_equal").alias("n_equal"),
        F.max("best_window").alias("best_window"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **given) -> DataFrame:
    """The documents that hold no benchmark item."""
    held = leaks(docs, items, id_col, text_col, **given).select(F.col(id_col).alias("__leak_id")).distinct()
    held = written(held, "leaks")
    return docs.join(held, docs[id_col] == F.col("__leak_id"), "left_anti")
