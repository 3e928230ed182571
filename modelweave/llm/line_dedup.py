"""Line dedup over levelled sorted runs of line hashes.

A document is cut at newlines. The key of a line is the line without white space (blank and 09-0D) at
its ends, A-Z lower-cased, as a 128-bit hash. Batches of documents are added one after the other: a
batch's keys are merge-anti-joined with the runs so far, which tells the keys never seen before, and
become a sorted run of their own: first sights of new keys, and sights of known ones. When a level holds
``FANOUT`` runs they are compacted into one run of the next level, so a key is read in few runs however many
batches there were. At the end a key's first sight, which stands in one run only, takes up all its later ones:
in how many documents it stands and which is the last.

The lines a document loses are found again by a 64-bit hash of the line as it stands, which is compared within
the document only; a document that loses more than ``LISTED`` different lines is joined with them line by line.

Defined results: a null or empty text is one empty line and stays so. A row without id loses nothing
and counts as no document. Repeated rows of one id count as one document and are treated alike.
A line too short for a key always stays. Other columns are passed through. An empty table gives no rows.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.llm.common import written

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4  # documents enter in so many batches, dealt by a hash of their id
FANOUT = 2
LISTED = 500  # lost lines of a document that are looked through for each of its lines
WHITE = " \t\n\x0b\f\r"


def line_key(line: Column, min_chars: int = MIN_CHARS) -> Column:
    """Hash of the normal form of a line; null when that is shorter than ``min_chars`` code points."""
    bare = F.btrim(line, F.lit(WHITE))
    # lower() changes more than A-Z where there are other characters than ASCII, so the letters are named there
    named = F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    plain = F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(named)
    return F.when(F.char_length(plain) >= min_chars, F.unhex(F.md5(plain)))


class LineRuns:
    """Runs of (key, docs, last_doc, fresh) by level, each a table in the shared folder, sorted by key.

    ``fresh`` marks the first sight of a key, which the anti-join tells; over all runs a key has exactly one such
    row. Keys without one are not known.
    """

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """Rows whose key stands in no run yet, by a merge anti-join with each run."""
        for run in self.runs():
            keys = keys.join(run.filter("fresh").select("key").hint("merge"), "key", "left_anti")
        return keys

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch (id, key), of ids that no earlier batch had; returns its run."""
        own = lines.filter("id is not null and key is not null").groupBy("key").agg(
            F.count_distinct("id").alias("docs"), F.max("id").alias("last_doc")
        )
        if self.runs():
            own = written(own, "line-batch")
            fresh = written(self.unseen(own), "line-fresh")
            again = own.join(fresh.select("key").hint("merge"), "key", "left_anti")
            own = fresh.withColumn("fresh", F.lit(True)).unionByName(again.withColumn("fresh", F.lit(False)))
        else:
            own = own.withColumn("fresh", F.lit(True))
        run = self._write(own)
        self._place(run, 0)
        return run

    @staticmethod
    def _write(run: DataFrame) -> DataFrame:
        return written(run.sortWithinPartitions("key"), "line-run")

    def _place(self, run: DataFrame, level: int) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self.merged(self.levels[level])
            self.levels[level] = []
            self._place(self._write(merged), level + 1)

    @staticmethod
    def merged(runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, runs).groupBy("key").agg(
            F.sum("docs").alias("docs"), F.max("last_doc").alias("last_doc"), F.max("fresh").alias("fresh")
        )

    def totals(self) -> DataFrame | None:
        """(key, docs, last_doc) of all known keys: their first sights with the later ones of other runs."""
        if not self.runs():
            return None
        every = reduce(DataFrame.unionByName, self.runs())
        first = every.filter("fresh").select("key", "docs", "last_doc")
        later = every.filter("not fresh").groupBy("key").agg(
            F.sum("docs").alias("_docs"), F.max("last_doc").alias("_last")
        )
        return first.join(later, "key", "left").select(
            "key", (F.col("docs") + F.coalesce("_docs", F.lit(0))).alias("docs"),
            F.greatest("last_doc", "_last").alias("last_doc"),
        )


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, key, raw): the lines with a key; ``raw`` is a hash of the line as it stands."""
    line = F.explode(F.split(docs[text_col].cast("string"), "\n", -1))
    return (
        docs.filter(docs[id_col].isNotNull() & (F.char_length(docs[text_col]) >= min_chars))
        .select(docs[id_col].cast("long").alias("id"), line.alias("line"))
        .filter(F.char_length("line") >= min_chars)
        .select("id", line_key(F.col("line"), min_chars).alias("key"), F.xxhash64("line").alias("raw"))
        .filter("key is not null")
    )


def lost_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS, batches: int = BATCHES,
) -> DataFrame:
    """(id, raw): the different lines each document loses, by the hash of the line."""
    lines = written(
        _lines(docs, id_col, text_col, min_chars)
        .withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int"))
        .dropDuplicates(["id", "key", "raw"]),
        "line-keys",
    )
    runs = LineRuns()
    for batch in range(batches):
        runs.add(lines.filter(F.col("batch") == batch).select("id", "key"))
    common = runs.totals().filter(F.col("docs") >= min_docs).select("key", "last_doc")
    return lines.join(common, "key").filter(F.col("id") != F.col("last_doc")).select("id", "raw")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS, batches: int = BATCHES, counts: bool = False,
) -> DataFrame:
    """The documents with their repeated lines taken out of ``text_col``.

    With ``counts``, the columns ``n_lines`` and ``n_dropped`` follow (in place of columns of these names).
    """
    lost = written(lost_lines(docs, id_col, text_col, min_chars, min_docs, batches), "line-lost")
    sizes = lost.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    many = sizes.filter(F.col("n") > LISTED).select("id")
    given = [c for c in docs.columns if not (counts and c in ("n_lines", "n_dropped"))]
    names = [f"c{i}" for i in range(len(given))]
    rows = docs.select(*[docs[c].alias(n) for c, n in zip(given, names, strict=True)])
    at, of = names[given.index(id_col)], names[given.index(text_col)]

    listed = lost.join(many, "id", "left_anti").groupBy("id").agg(F.collect_set("raw").alias("lost"))
    listed = listed.unionByName(many.withColumn("lost", F.lit(None).cast("array<bigint>")))
    joined = rows.join(
        listed.withColumn("long", F.col("lost").isNull()).hint("shuffle_hash"), rows[at].cast("long") == F.col("id"), "left"
    )
    lines = F.split(F.coalesce(F.col(of).cast("string"), F.lit("")), "\n", -1)
    kept = F.when(F.col("lost").isNull(), lines).otherwise(
        F.filter(lines, lambda line: ~F.array_contains(F.col("lost"), F.xxhash64(line)))
    )
    short = joined.filter(~F.coalesce("long", F.lit(False))).withColumn("kept", kept)
    text = F.when(F.col("lost").isNull(), F.col(of)).otherwise(F.array_join("kept", "\n"))
    n = F.size(lines).cast("long")
    short = short.select(*[text.alias(c) if c == of else c for c in names], n.alias("n"), (n - F.size("kept")).alias("m"))

    out = short.unionByName(_line_by_line(joined.filter("long").select(*names, "id"), lost, names, of))
    picked = [F.col(n).alias(c) for n, c in zip(names, given, strict=True)]
    if counts:
        picked += [F.col("n").alias("n_lines"), F.col("m").cast("long").alias("n_dropped")]
    return out.select(*picked)


def _line_by_line(rows: DataFrame, lost: DataFrame, names: list[str], of: str) -> DataFrame:
    """The same for documents that lose many lines, by a join on (id, line)."""
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "line-long")
    cut = rows.select("row", "id", F.posexplode(F.split(F.col(of).cast("string"), "\n", -1)).alias("place", "line"))
    gone = lost.withColumn("gone", F.lit(True))
    marked = cut.withColumn("raw", F.xxhash64("line")).join(gone, ["id", "raw"], "left")
    kept = F.collect_list(F.when(F.col("gone").isNull(), F.struct("place", "line")))
    again = marked.groupBy("row").agg(
        F.array_sort(kept).alias("kept"), F.count(F.lit(1)).alias("n"), F.count("gone").alias("m")
    )
    text = F.array_join(F.transform("kept", lambda x: x["line"]), "\n")
    return rows.join(again, "row").select(*[text.alias(c) if c == of else c for c in names], "n", "m")
