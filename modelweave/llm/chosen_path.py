"""MinHash near-dedup by a chosen-path set similarity join.

The set of a document is its distinct 5-word shingles (words: runs without [\\x20\\x09-\\x0D], A-Z lower-
cased; a text of fewer words is one shingle), as 64-bit hashes. Documents with equal sets are one node,
which has a number of its own and is read from one of its rows.
``SLOTS`` minwise values sketch each set. In each of ``TREES`` independent trees all nodes stand at the root;
every tree node chooses one slot or two (1 / similarity on average) by a hash of its path, and a document goes
on to the child named by its value there. The first ``START`` branchings follow at once. Then a child with one
document ends; one with at most ``SMALL`` is compared exhaustively. A larger one is compared with one of its
documents, its centre (the nearest to the usual sketch). If most are then linked into one part, as in a group
of copies, the others are compared with all documents of the node, in blocks; otherwise it branches again. A
pair at the threshold of 0.85 stays together in a tree through two branchings with a probability of 0.77. All
trees read one sketch, so 12 of them miss such a pair with a probability of 6e-7 through two branchings, 2e-5
through three and 1e-4 through four (by the binomial of equal slots); pairs more alike are missed less.

Candidate pairs are dropped only by the exact bound on set sizes; all others are confirmed on the full sets.
Pairs already in one component are not compared, since components are the result: a link between them changes
nothing.

Defined results: null or empty texts have no set and are linked with nothing. Rows without id are no part of
any component: their component is null, and they are kept. Repeated rows of one id are one document; if such
rows have different texts, each row is in the component of its own text. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelweave.llm.common import Words, by_slices, mix, sets_of, shingles, texts_of, written

SHINGLE = 5
SIMILARITY = 85  # per cent
SLOTS = 64
TREES = 12
START = 2
SMALL = 16
VOTERS = 48
NODES = 2
BLOCK = 2048
DEPTH = 4  # branchings; nodes left then are settled like those mainly linked
FEW_LINKS = 200_000  # 16 bytes each
BROADCAST_IDS = 1_000_000  # rows of 16 bytes
_SEEDS = np.random.default_rng(20240611).integers(1, 2**63, SLOTS, dtype=np.uint64) | np.uint64(1)


def _minwise(values: np.ndarray) -> np.ndarray:
    """``SLOTS`` 32-bit minwise values of a set."""
    out = np.full(SLOTS, np.uint64(2**64 - 1))
    for start in range(0, len(values), 4096):  # a long text's set is taken in parts
        np.minimum(out, (values[start:start + 4096, None] * _SEEDS).min(axis=0), out=out)
    return (mix(out) >> np.uint64(32)).astype("<u4")


def _sets(texts: list[bytes]):
    doc, values = sets_of(*shingles(Words(texts), SHINGLE))
    return np.split(values, np.searchsorted(doc, np.arange(1, len(texts))))


def _signatures(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = _sets(texts_of(batch))
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()),
            pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
            pa.array([_minwise(s).tobytes() if len(s) else None for s in sets], pa.binary()),
        ],
        ["id", "same", "n", "digest", "sketch"],
    )


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, same, n, digest, sketch) of every document; digest and sketch are null for an empty set.

    ``same`` is a digest of the text itself.
    """
    rows = docs.select(
        docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
        _same(docs[text_col]).alias("same"),
    )
    return rows.mapInArrow(by_slices(_signatures), "id long, same string, n long, digest binary, sketch binary")


def _same(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


# ---------------------------------------------------------------- components


def _united(batches):
    """From all links (a, b) that are left: (node, part) of their nodes, by union-find."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    nodes = list(root)
    for at in range(0, len(nodes), 10_000):
        some = nodes[at:at + 10_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array([find(x) for x in some], pa.int64())], ["node", "part"]
        )


def merge_components(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, part): the component of every linked node, its smallest node, after more links (a, b).

    Every round each node points to its smallest neighbour and the links are drawn between the nodes pointed
    to; each component at least halves, and its smallest node never moves. Once at most ``FEW_LINKS`` links are
    left, one task finishes them: a bounded number, whatever the table.
    """
    edges = links.select("a", "b")
    if parts is not None:
        for side in ("a", "b"):
            to = parts.select(F.col("node").alias(side), F.col("part").alias("_to"))
            edges = edges.join(to, side, "left").withColumn(side, F.coalesce("_to", side)).drop("_to")
    mapping = None
    while True:
        edges = written(
            edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(),
            "links",
        )
        left = edges.count()  # of a written table: its file footers
        if left == 0:
            break
        if left <= FEW_LINKS:
            points = written(edges.coalesce(1).mapInArrow(_united, "node long, part long"), "points")
        else:
            ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            points = written(
                ends.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("part")), "points"
            )
        to = points.select(F.col("node").alias("part"), F.col("part").alias("_to"))
        mapping = points if mapping is None else mapping.join(to, "part", "left").select(
            "node", F.coalesce("_to", "part").alias("part")
        )
        if left <= FEW_LINKS:
            break
        for side in ("a", "b"):
            to = points.select(F.col("node").alias(side), F.col("part").alias("_to"))
            edges = edges.join(to, side).withColumn(side, F.col("_to")).drop("_to")
    if mapping is None:
        return parts
    mapping = written(mapping, "parts")
    if parts is None:
        return mapping
    to = mapping.select(F.col("node").alias("part"), F.col("part").alias("_to"))
    old = parts.join(to, "part", "left").select("node", F.coalesce("_to", "part").alias("part"))
    new = mapping.join(parts.select("node"), "node", "left_anti")
    return written(old.unionByName(new.select("node", "part")), "parts")


# ---------------------------------------------------------------- candidates


def _children(members: DataFrame, similarity: int) -> DataFrame:
    """The tree nodes one step below, as rows (path, node, sketch)."""
    one, two = (F.pmod(F.xxhash64("path", F.lit(i)), F.lit(SLOTS)) for i in (0, 1))
    second = (F.pmod(F.xxhash64("path", F.lit(2)), F.lit(similarity)) < 100 - similarity) & (one != two)
    stepped = members.select(
        "path", "node", "sketch", F.explode(F.when(second, F.array(one, two)).otherwise(F.array(one))).alias("slot")
    )
    value = F.substring("sketch", (F.col("slot") * 4 + 1).cast("int"), F.lit(4))
    return stepped.select(F.xxhash64("path", "slot", value).alias("path"), "node", "sketch")


def _with_parts(members: DataFrame, parts: DataFrame | None) -> DataFrame:
    if parts is None:
        return members.withColumn("part", F.col("node"))
    return members.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))


def _unlinked(members: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Rows (path, node, part, size, main, outside) of the tree nodes that hold more than one part.

    ``outside`` counts the documents that are not in ``main``, the node's largest part.
    """
    members = _with_parts(members, parts)
    if parts is not None:
        members = written(members, "parted")
    by_part = members.groupBy("path", "part").agg(F.count(F.lit(1)).alias("n"))
    sizes = by_part.groupBy("path").agg(
        F.sum("n").alias("size"), F.count(F.lit(1)).alias("n_parts"), F.max(F.struct("n", "part")).alias("main"),
    ).filter("n_parts > 1")
    sizes = sizes.select(
        "path", "size", F.col("main.part").alias("main"), (F.col("size") - F.col("main.n")).alias("outside")
    )
    return written(members.join(written(sizes, "sizes"), "path"), "members")


def _usual(batches):
    """From (path, sketches): the most frequent value of every slot."""
    for batch in batches:
        made = []
        for sketches in batch.column("sketches").to_pylist():
            values = np.sort(np.frombuffer(b"".join(sketches), "<u4").reshape(-1, SLOTS), axis=0)
            length = np.ones(values.shape, np.int64)  # of the run of equal values that ends here
            for i in range(1, len(values)):
                length[i] = np.where(values[i] == values[i - 1], length[i - 1] + 1, 1)
            made.append(values[length.argmax(axis=0), np.arange(SLOTS)].astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(made, pa.binary())], ["path", "usual"])


def _agreement(x: pa.Array, y: pa.Array) -> np.ndarray:
    """Number of equal slots of two columns of sketches."""
    a, b = (np.frombuffer(b"".join(c.to_pylist()), "<u4").reshape(-1, SLOTS) for c in (x, y))
    return (a == b).sum(axis=1)


def _to_centre(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each document of a large node with its centre: the one whose sketch is nearest to the usual one.

    What is usual is voted by ``VOTERS`` documents of the node; a text from which many others were made agrees
    with most of them, though they may differ more from each other.
    """
    rows = written(members.select("path", "node").join(nodes.select("node", "sketch"), "node"), "sketched")
    voters = Window.partitionBy("path").orderBy(F.xxhash64("node", "path"))
    voted = rows.withColumn("_at", F.row_number().over(voters)).filter(F.col("_at") <= VOTERS).groupBy("path").agg(
        F.collect_list("sketch").alias("sketches")
    )
    usual = written(voted.mapInArrow(_usual, "path long, usual binary"), "usual")

    def agree(batches):
        for batch in batches:
            count = pa.array(_agreement(batch.column("sketch"), batch.column("usual")).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("node"), count], ["path", "node", "agree"])

    seen = rows.join(usual, "path").select("path", "node", "sketch", "usual").mapInArrow(
        agree, "path long, node long, agree int"
    )
    centres = seen.groupBy("path").agg(F.max(F.struct("agree", (-F.col("node")).alias("low"))).alias("best")).select(
        "path", (-F.col("best.low")).alias("centre")
    )
    joined = members.join(written(centres, "centres"), "path")
    return joined.filter("node <> centre").select(*_pair("node", "centre"))


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _of_small(members: DataFrame) -> DataFrame:
    """All pairs of different parts in nodes of at most ``SMALL`` documents."""
    groups = members.groupBy("path").agg(F.sort_array(F.collect_set(F.struct("node", "part"))).alias("all"))
    first = groups.select("all", F.posexplode("all").alias("at", "x"))
    return first.select("x", F.explode(F.slice("all", F.col("at") + 2, F.lit(SMALL))).alias("y")).filter(
        "x.part <> y.part"
    ).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


class Join:
    """The similarity join of one table: its nodes, the pairs compared so far and the parts found."""

    def __init__(
        self, docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, similarity: int, rows: DataFrame | None = None
    ):
        """``rows`` (node, id, same) tells the row each node is read from; without it, a node is an id."""
        self.docs, self.nodes, self.similarity, self.rows = docs, nodes, similarity, rows
        self.id_col, self.text_col = id_col, text_col
        self.parts: DataFrame | None = None
        self.tried: DataFrame | None = None

    def compare(self, pairs: DataFrame) -> None:
        """Confirm candidate pairs (a, b) and merge their parts."""
        likely = self._likely(pairs.distinct())
        if self.tried is not None:
            likely = likely.join(self.tried, ["a", "b"], "left_anti")
        likely = written(likely, "likely")
        if likely.isEmpty():
            return
        self.tried = likely if self.tried is None else self.tried.unionByName(likely)
        self.parts = merge_components(self.parts, written(self._confirmed(likely), "confirmed"))

    def _likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sets are not too different in size to be similar enough."""
        for side in ("a", "b"):
            pairs = pairs.join(self.nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}")), side)
        return pairs.filter(
            100 * F.least("n_a", "n_b") >= self.similarity * F.greatest("n_a", "n_b")
        ).select("a", "b")

    def _sets(self, ids: DataFrame) -> DataFrame:
        """(node, set) of some nodes, made again from their texts."""
        ids = ids.distinct()
        if self.rows is None:
            ids = ids.select("node", F.col("node").alias("id"), F.lit(None).cast("string").alias("same"))
        else:
            ids = ids.join(self.rows, "node")
        ids = written(ids, "compared")
        rows = self.docs.select(
            self.docs[self.id_col].cast("long").alias("id"), F.coalesce(self.docs[self.text_col], F.lit("")).alias("text")
        )
        few = ids.count() <= BROADCAST_IDS
        rows = rows.join(F.broadcast(ids) if few else ids, "id").select("node", "same", "text")

        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch)
            # an id may have other texts; digests are made here, of the few rows asked for
            own = [s is None or hashlib.md5(t).hexdigest() == s
                   for s, t in zip(batch.column("same").to_pylist(), texts, strict=True)]
            sets = _sets([t for t, keep in zip(texts, own, strict=True) if keep]) if any(own) else []
            return pa.RecordBatch.from_arrays(
                [batch.column("node").filter(pa.array(own)), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["node", "set"],
            )

        made = rows.mapInArrow(by_slices(make), "node long, set binary")
        return written(made.groupBy("node").agg(F.first("set").alias("set")), "sets")

    def settle(self, members: DataFrame) -> None:
        """Compare each document outside a node's main part with all documents of other parts, and merge.

        A document that is outside in several nodes (much the same ones, in each tree) is compared in all of them:
        first in the ``NODES`` largest, then in the rest, without the nodes whose main part it has joined
        meanwhile, as a link there changes nothing. The sets are made once for both.
        """
        largest = Window.partitionBy("node").orderBy(F.desc("size"), "path")
        outside = written(members.filter("part <> main").withColumn("_at", F.row_number().over(largest)), "outside")
        if outside.isEmpty():
            return
        asked = members.join(outside.select("path").distinct(), "path", "left_semi")
        sets = self._sets(asked.select("node"))
        self._in_blocks(members, outside.filter(F.col("_at") <= NODES).drop("_at"), sets)
        outside = outside.filter(F.col("_at") > NODES)
        if outside.isEmpty():
            return
        if self.parts is not None:
            members = written(self._now(members), "members")
            outside = written(self._now(outside).filter("part <> main"), "outside")
        if not outside.isEmpty():
            self._in_blocks(members, outside.drop("_at"), sets)

    def _now(self, members: DataFrame) -> DataFrame:
        """The rows with the parts known by now, ``main`` being the part its documents are in."""
        for column, of in (("part", "node"), ("main", "main")):
            to = self.parts.select(F.col("node").alias(of), F.col("part").alias("_to"))
            members = members.join(to, of, "left").withColumn(column, F.coalesce("_to", of)).drop("_to")
        return members

    def _in_blocks(self, members: DataFrame, outside: DataFrame, sets: DataFrame) -> None:
        """Compare the documents ``outside`` with all of other parts in their nodes, and merge.

        Blocks of documents meet by an equi-join on (node, block, block), counted through an inverted file of the
        block's shingles; of the links of a document, one per part it is linked to is returned.
        """
        outside = written(outside, "asking")
        paths = outside.groupBy("path").agg(F.count(F.lit(1)).alias("asked"))
        inside = written(members.join(written(paths, "asked"), "path"), "inside")
        outside = outside.join(paths, "path")

        keys, similarity = ["path", "x_block", "y_block"], self.similarity

        def dealt(of: DataFrame, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
            blocks = {n: F.ceil(F.col(n) / BLOCK).cast("long") for n in (own_n, other_n)}
            zero = F.lit(0).cast("long")
            placed = of.select(
                F.col("path").alias("path"), F.col("node").alias("node"), F.col("part").alias("part"),
                F.pmod(F.xxhash64("node"), blocks[own_n]).alias(own),
                F.explode(F.sequence(zero, blocks[other_n] - 1)).alias(other),
            )
            own_sets = sets.select(F.col("node").alias("node"), F.col("set").alias("set"))  # either side its own columns
            return placed.join(own_sets, "node").select(*keys, "node", "part", "set")

        def cell(asked: pa.Table, given: pa.Table) -> pa.Table:
            links = []
            if asked.num_rows and given.num_rows:
                held = [np.frombuffer(v, np.uint64) for v in given.column("set").to_pylist()]
                sizes = np.array([len(v) for v in held])
                owner = np.repeat(np.arange(len(held)), sizes)
                values = np.concatenate(held)
                order = np.argsort(values, kind="stable")
                values, owner = values[order], owner[order]
                parts, nodes = np.asarray(given.column("part")), np.asarray(given.column("node"))
                for node, part, raw in zip(
                    asked.column("node").to_pylist(), asked.column("part").to_pylist(), asked.column("set").to_pylist(),
                    strict=True,
                ):
                    own = np.frombuffer(raw, np.uint64)
                    first, last = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
                    count = last - first
                    at = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
                    common = np.bincount(owner[at], minlength=len(held))
                    close = (100 * common >= similarity * (len(own) + sizes - common)) & (parts != part)
                    _, one = np.unique(parts[close], return_index=True)
                    links += [(node, int(other)) for other in nodes[close][one]]
            columns = list(zip(*links, strict=True)) or [(), ()]
            return pa.table([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

        found = (
            dealt(outside, "x_block", "asked", "y_block", "size").groupBy(*keys)
            .cogroup(dealt(inside, "y_block", "size", "x_block", "asked").groupBy(*keys))
            .applyInArrow(cell, "a long, b long")
        )
        self.parts = merge_components(self.parts, written(found, "settled"))

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar enough."""
        sets = self._sets(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        both = pairs
        for side in ("b", "a"):
            both = both.join(sets.select(F.col("node").alias(side), F.col("set").alias(f"set_{side}")), side)
        similarity = self.similarity

        def confirm(batches):
            for batch in batches:
                keep = []
                for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * common >= similarity * (len(x) + len(y) - common))
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])

        return both.select("a", "b", "set_a", "set_b").mapInArrow(confirm, "a long, b long")


def _judged(docs: DataFrame, id_col: str, text_col: str, similarity: int = SIMILARITY, trees: int = TREES) -> DataFrame:
    """(id, same, n, part, kept) of every document."""
    signed = written(signatures(docs, id_col, text_col), "signatures")
    # Numbered when they are written, and read from there: an id may have several texts, a digest has one number.
    nodes = written(
        signed.filter("id is not null and digest is not null").groupBy("digest").agg(
            F.min(F.struct("id", "same")).alias("row"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
        ).select(
            F.monotonically_increasing_id().alias("node"), "digest", F.col("row.id").alias("id"),
            F.col("row.same").alias("same"), "n", "sketch",
        ),
        "nodes",
    )
    join = Join(docs, nodes, id_col, text_col, similarity, nodes.select("node", "id", "same"))
    paths = F.explode(F.array(*[F.xxhash64(F.lit(t)) for t in range(trees)]))
    below = nodes.select(paths.alias("path"), "node", "sketch")
    for _ in range(START):
        below = _children(below, similarity)
    far = _unlinked(below.select("path", "node"), None)
    for depth in range(START, DEPTH + 1):
        small, large = far.filter(F.col("size") <= SMALL), far.filter(F.col("size") > SMALL)
        join.compare(_of_small(small).unionByName(_to_centre(large, nodes)))
        # The same nodes with the parts now known: linked throughout, in the main, or to branch further.
        left = _unlinked(large.select("path", "node"), join.parts)
        mainly = F.col("size") >= 2 * F.col("outside") if depth < DEPTH else F.lit(True)
        near, mixed = left.filter(mainly), left.filter(~mainly).select("path", "node")
        if not near.isEmpty():
            join.settle(near)
        if mixed.isEmpty():
            break
        below = _children(mixed.join(nodes.select("node", "sketch"), "node"), similarity)
        far = _unlinked(below.select("path", "node"), join.parts)
    named = nodes.select("node", "digest", F.col("id").alias("part"))
    if join.parts is not None:
        # a component is called by the smallest id of all its nodes
        placed = nodes.select("node", "digest", "id").join(join.parts, "node", "left")
        placed = placed.withColumn("part", F.coalesce("part", "node"))
        smallest = placed.groupBy("part").agg(F.min("id").alias("_id"))
        named = placed.join(smallest, "part").select("node", "digest", F.col("_id").alias("part"))
    rows = signed.join(named.select("digest", "part"), "digest", "left")
    part = F.when(F.col("id").isNotNull(), F.coalesce("part", "id"))
    return rows.select(
        "id", "same", "n", part.alias("part"), F.coalesce(F.col("id") == part, F.lit(True)).alias("kept")
    )


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **given) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every document."""
    return _judged(docs, id_col, text_col, **given).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("part").alias("component_id"), "kept"
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **given) -> DataFrame:
    """The documents without those that another one of their component stands for."""
    gone = _judged(docs, id_col, text_col, **given).filter("not kept").select(
        F.col("id").alias("__copy_id"), F.col("same").alias("__copy_same")
    )
    gone = written(gone.distinct(), "copies")
    copy = (docs[id_col].cast("long") == F.col("__copy_id")) & (_same(docs[text_col]) == F.col("__copy_same"))
    return docs.join(gone, copy, "left_anti")
