"""N-gram Jaccard join: a grouped prefix join on word shingles.

Two documents link when their sets of five-word shingles have a Jaccard similarity of
0.8 or more. Equal sets are one node from the start. The rest goes in three steps.

1. *Count filter.* In the order of the hashes, a set's first shingles (a fifth and a
   little more) must hold some that another set's first shingles hold too, or nothing
   can link to it. That takes one shuffle of about a quarter of all shingles and leaves
   the nodes with much shared text.
2. *Prefix join.* Among those, shingles are ordered from rare to frequent, so a passage
   that many texts share comes last. Nodes of the same size and prefix form a group.
   Groups that meet in a prefix shingle are filtered by size and position, then expanded
   to members whose sets are compared in full.
3. *Components.* What is asked for is which documents are connected. First every group
   is compared with the first group of its shingles, which connects most groups of
   copies in linear work; then only pairs from different components are compared, all of
   them, so no link between components is missed.

Sets travel as packed 64-bit hashes, a node is the 64-bit hash of its set.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthline.llm.arrow import map_batches
from hearthline.llm.tokens import LOWER, mix, pieces, shingles, span_hashes, words
from hearthline.scratch import materialize

SHINGLE = 5
FLUSH = 1 << 20  # shingles gathered in a task before they are sent on
BLOOM_FILTER = {  # whatever the size of either side
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t",
}
MANY = 8  # sets that share a shingle within a task; such a shingle is sent on once


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs that are run inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def needed(n):
    """The least overlap of a set of n with any set it links to: four fifths, rounded up."""
    return -(-4 * n // 5)


def prefix_size(n):
    return n - needed(n) + 1


def set_nodes(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set, 0 for an empty one."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values + np.uint64(1)), dtype=np.uint64)])
    nodes = mix(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64))
    nodes[np.diff(offsets) == 0] = 0
    return nodes.view(np.int64)


def text_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, sorted shingle hashes and offsets of some texts at a time."""
    for piece in pieces(texts):
        found = words(piece)
        hashes = span_hashes(LOWER[piece.data], found.begin, found.end)
        yield piece.first, *shingles(hashes, found.offsets, SHINGLE)


def document_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n and node of every row."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for first, values, offsets in text_sets(batch.column(1)):
            yield {
                "doc_id": batch.column(0).slice(first, len(offsets) - 1),
                "n": np.diff(offsets),
                "node": set_nodes(values, offsets),
            }

    return map_batches(docs, work, f"doc_id {dict(docs.dtypes)['doc_id']}, n long, node long")


# Step 1


def _extra(n):
    return -(-n // 20)


def _first_shingles(docs: DataFrame) -> DataFrame:
    """(shingle, node, credit) of every set's first shingles.

    credit 0: the node holds the shingle. A shingle of MANY nodes within a task is sent once,
    with credit -1, and its nodes get what they would earn as a positive credit right away;
    so no shingle, however common, has more rows than there are tasks and rounds in them.
    """

    def send(shingle: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((node, shingle))
        shingle, node = shingle[order], node[order]
        new = np.ones(len(shingle), bool)
        new[1:] = (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])
        shingle, node = shingle[new], node[new]
        start = np.ones(len(shingle), bool)
        start[1:] = shingle[1:] != shingle[:-1]
        which = np.cumsum(start) - 1
        common = np.bincount(which)[which] >= MANY
        earned, credit = np.unique(node[common], return_counts=True)
        once = common & start
        parts = [
            (shingle[~common], node[~common], np.zeros((~common).sum(), np.int32)),
            (shingle[once], np.zeros(once.sum(), np.int64), np.full(once.sum(), -1, np.int32)),
            (earned, earned, credit.astype(np.int32)),
        ]
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        return pa.RecordBatch.from_pydict(dict(zip(("shingle", "node", "credit"), columns, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, values, offsets in text_sets(batch.column(0)):
                n = np.diff(offsets)
                keep = np.minimum(n, prefix_size(n) + _extra(n))
                keep[n == 0] = 0
                at = np.repeat(offsets[:-1] - np.cumsum(keep) + keep, keep) + np.arange(keep.sum())
                held.append((values[at].view(np.int64), np.repeat(set_nodes(values, offsets), keep)))
                size += len(at)
                if size >= FLUSH:
                    yield send(*(np.concatenate(c) for c in zip(*held, strict=True)))
                    held, size = [], 0
        if size:
            yield send(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return docs.select("text").mapInArrow(run, "shingle long, node long, credit int")


def _earned(first: DataFrame) -> DataFrame:
    """node, shared: how many of its first shingles other nodes' first shingles hold (or more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [tuple(c.to_numpy() for c in batch.columns) for batch in batches]
        if not held:
            return
        shingle, node, credit = (np.concatenate(c) for c in zip(*held, strict=True))
        del held
        given = credit > 0
        who, gained = [node[given]], [credit[given].astype(np.int64)]
        many = np.unique(shingle[credit == -1])
        shingle, node = shingle[credit == 0], node[credit == 0]
        order = np.lexsort((node, shingle))
        shingle, node = shingle[order], node[order]
        new = np.ones(len(shingle), bool)
        new[1:] = (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])
        shingle, node = shingle[new], node[new]
        start = np.ones(len(shingle), bool)
        start[1:] = shingle[1:] != shingle[:-1]
        which = np.cumsum(start) - 1
        shared = np.bincount(which, minlength=1)[which] > 1
        shared |= np.isin(shingle, many)
        who.append(node[shared])
        gained.append(np.ones(shared.sum(), np.int64))
        nodes, back = np.unique(np.concatenate(who), return_inverse=True)
        total = np.bincount(back, np.concatenate(gained)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"node": nodes, "shared": total})

    return (
        first.repartition("shingle")
        .mapInArrow(run, "node long, shared long")
        .groupBy("node")
        .agg(F.sum("shared").alias("shared"))
    )


def candidate_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, first_id, n and packed shingles of the nodes that the count filter leaves."""
    n = F.col("n")
    # Both of a linked pair share as many first shingles as the smaller one's excess allows.
    least = 1 + F.ceil(n / 25)
    left = nodes.join(_earned(_first_shingles(docs)), "node").filter(F.col("shared") >= least)
    left = materialize(left.select("node", "first_id", "n"), "join-left")

    def pack(batch: pa.RecordBatch) -> Iterator[dict]:
        for first, values, offsets in text_sets(batch.column(3)):
            part = batch.slice(first, len(offsets) - 1)
            same = np.flatnonzero(set_nodes(values, offsets) == part.column(0).to_numpy())
            raw = values.astype("<u8").tobytes()
            part = part.take(pa.array(same))
            yield {
                "node": part.column(0),
                "first_id": part.column(1),
                "n": part.column(2),
                "shingles": pa.array([raw[8 * offsets[i] : 8 * offsets[i + 1]] for i in same], pa.binary()),
            }

    kind = dict(left.dtypes)["first_id"]
    # The filter (all sets have a shingle) marks this side as the selective one, so that Spark
    # builds its Bloom filter from it and most texts are dropped before they are shuffled.
    left = left.filter("n > 0")
    found = docs.join(left, docs.doc_id == left.first_id).select("node", "first_id", "n", "text")
    packed = map_batches(found, pack, f"node long, first_id {kind}, n long, shingles binary")
    with settings(docs.sparkSession, BLOOM_FILTER):
        return materialize(packed, "join-sets")


# Step 2


def _unpacked(sets: DataFrame) -> DataFrame:
    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for row in range(0, batch.num_rows, 512):
            part = batch.slice(row, 512)
            raw = [np.frombuffer(x.as_buffer(), "<i8") for x in part.column(1)]
            size = [len(x) for x in raw]
            yield {"node": np.repeat(part.column(0).to_numpy(), size), "shingle": np.concatenate(raw)}

    return map_batches(sets.select("node", "shingles"), work, "node long, shingle long")


def prefixes(sets: DataFrame) -> DataFrame:
    """node, first_id, n, shingle, position: prefix shingles that other sets hold too, rare ones first."""
    rows = _unpacked(sets)
    # Written, so that the join has a shuffle on either side: only then can Spark split a hot shingle.
    often = materialize(rows.groupBy("shingle").count().filter("count > 1"), "join-often")
    order = Window.partitionBy("node").orderBy("count", "shingle")
    placed = rows.join(often, "shingle").select(
        "node",
        "shingle",
        (F.row_number().over(order) - 1).alias("place"),
        F.count("*").over(Window.partitionBy("node")).alias("held"),
    )
    n = F.col("n")
    position = F.col("place") + n - F.col("held")  # what only this set holds comes first
    return (
        placed.join(sets.select("node", "first_id", "n"), "node")
        .withColumn("position", position)
        .filter(F.col("position") < n - F.ceil(n * 4 / 5) + 1)
        .select("node", "first_id", "n", "shingle", "position")
    )


def _groups(prefix: DataFrame) -> DataFrame:
    """group, node: nodes of the same size and the same prefix, named by the first of them."""
    signed = prefix.groupBy("node", "n").agg(
        F.bit_xor(F.xxhash64("shingle")).alias("x"),
        F.bit_xor(F.xxhash64("shingle", F.lit(1))).alias("y"),
        F.count("*").alias("held"),
    )
    # A prefix with a shingle of the node's own is like no other.
    n = F.col("n")
    whole = F.col("held") == n - F.ceil(n * 4 / 5) + 1
    key = ["n", "x", "y", "own"]
    signed = signed.withColumn("own", F.when(whole, F.lit(0)).otherwise(F.col("node")))
    return signed.join(signed.groupBy(key).agg(F.min("node").alias("group")), key).select("group", "node")


def _may_link(n: Column, position: Column, other_n: Column, other_position: Column) -> Column:
    """Whether both have enough shingles from here on: 9 * overlap >= 4 * (sum of the sizes)."""
    both = 4 * (n + other_n)
    return (9 * (n - position) >= both) & (9 * (other_n - other_position) >= both)


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) those whose whole sets link."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        keep = []
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 180 * common >= 80 * (len(x) + len(y)):
                keep.append(i)
        part = batch.take(pa.array(keep, pa.int64()))
        yield {"a": part.column(0), "b": part.column(1)}

    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    whole = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return map_batches(whole, work, "a long, b long")


# Step 3


def components(links: DataFrame) -> DataFrame:
    """node, component: the connected components of links (a, b), named by their smallest node.

    Every round each node takes its smallest neighbour as parent, paths are shortened, and
    the links are drawn between the parents; links within one are dropped.
    """
    links = materialize(links.select("a", "b").distinct(), "links")
    label = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("parent"))
        for _ in range(2):
            parent = materialize(parent, "parents")
            above = parent.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
            parent = parent.join(above, "parent").select("node", F.col("top").alias("parent"))
        parent = materialize(parent, "parents")
        if label is None:
            label = parent.withColumnRenamed("parent", "component")
        else:
            next_label = parent.select(F.col("node").alias("component"), "parent")
            label = label.join(next_label, "component", "left").select(
                "node", F.coalesce("parent", "component").alias("component")
            )
        label = materialize(label, "labels")
        for end in ("a", "b"):
            top = parent.select(F.col("node").alias(end), "parent")
            links = links.join(top, end).drop(end).withColumnRenamed("parent", end)
        links = materialize(links.filter("a <> b").select("a", "b").distinct(), "links")
    return label if label is not None else links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _first_pairs(rows: DataFrame) -> DataFrame:
    """Each group with the first group, by two orders, of those that it meets and may link to."""
    found = None
    for rank in (F.struct("first_id", "group"), F.struct(F.xxhash64("group"), "group")):
        first = rows.groupBy("shingle").agg(
            F.min_by(F.struct(F.col("group").alias("a"), F.col("n").alias("m"), F.col("position").alias("q"), rank.alias("rank")), rank).alias("first")
        )
        first = materialize(first, "join-first")  # as above, for the sake of hot shingles
        met = (
            rows.join(first, "shingle")
            .filter(F.col("group") != F.col("first.a"))
            .filter(_may_link(F.col("n"), F.col("position"), F.col("first.m"), F.col("first.q")))
            .groupBy("group")
            .agg(F.min_by("first.a", "first.rank").alias("a"))
            .select("a", F.col("group").alias("b"))
        )
        found = met if found is None else found.union(met)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _cross_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of groups of different components that meet in a shingle and may link.

    A shingle's largest component is only compared with the others, never with itself.
    """
    sizes = rows.groupBy("shingle", "component").count()
    main = sizes.groupBy("shingle").agg(
        F.max_by("component", F.struct("count", "component")).alias("main"), F.count("*").alias("many")
    )
    main = materialize(main.filter("many > 1").drop("many"), "join-main")
    rows = materialize(rows.join(main, "shingle"), "join-cross")
    minor = rows.filter("component <> main").select(
        "shingle",
        F.col("group").alias("a"),
        F.col("n").alias("m"),
        F.col("position").alias("q"),
        F.col("component").alias("c"),
    )
    return (
        minor.join(rows, "shingle")
        .filter((F.col("c") != F.col("component")) & ((F.col("component") == F.col("main")) | (F.col("a") < F.col("group"))))
        .filter(_may_link(F.col("n"), F.col("position"), F.col("m"), F.col("q")))
        .select(F.least("a", "group").alias("a"), F.greatest("a", "group").alias("b"))
        .distinct()
    )


def _with_component(rows: DataFrame, label: DataFrame, key: str) -> DataFrame:
    found = rows.join(label.withColumnRenamed("node", key), key, "left")
    return found.withColumn("component", F.coalesce("component", key))


def node_links(sets: DataFrame) -> DataFrame:
    """Links (a, b) of nodes: enough of them that linked nodes are connected, and none else."""
    prefix = materialize(prefixes(sets), "join-prefixes")
    groups = materialize(_groups(prefix), "join-groups")
    # Members that don't link with their group's first stand for themselves.
    inner = materialize(
        verify(groups.filter("group <> node").select(F.col("group").alias("a"), F.col("node").alias("b")), sets),
        "join-inner",
    )
    tied = inner.select(F.col("b").alias("node"), F.col("a").alias("tie"))
    members = materialize(
        groups.join(tied, "node", "left").select(
            "node", F.when(F.col("node") == F.col("group"), F.col("node")).otherwise(F.coalesce("tie", "node")).alias("group")
        ),
        "join-members",
    )
    heads = members.filter("node = group").select("group")
    rows = prefix.withColumnRenamed("node", "group").join(heads, "group", "left_semi")
    rows = materialize(rows, "join-rows")
    found = materialize(inner.union(verify(_first_pairs(rows), sets)), "join-found")
    label = components(found)
    pairs = _cross_pairs(_with_component(rows, label, "group"))
    of_a = members.select(F.col("group").alias("a"), F.col("node").alias("x"))
    of_b = members.select(F.col("group").alias("b"), F.col("node").alias("y"))
    whole = pairs.join(of_a, "a").join(of_b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    return found.union(materialize(verify(whole, sets), "join-crossed"))


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The component of every row: doc_id, n_shingles, component_id.

    A document's set is its distinct five-word shingles, A-Z lower-cased; with fewer words
    the whole sequence is one; a null, empty or blank text has none and links with nothing.
    Rows that repeat a document or its text are one node. ``component_id`` is the smallest
    id that links reach, itself included. A row without an id takes no part and has no
    component. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    own = materialize(document_sets(docs), "join-documents")
    nodes = own.filter("n > 0 AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"))
    nodes = materialize(nodes, "join-nodes")
    label = components(node_links(candidate_sets(docs, nodes)))
    placed = _with_component(nodes, label, "node")
    named = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = materialize(placed.join(named, "component").select("node", "component_id"), "join-named")
    whole = own.join(named, "node", "left")
    return whole.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when((F.col("n") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
