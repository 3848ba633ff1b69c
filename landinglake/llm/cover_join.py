"""All pairs of vectors with a cosine of at least a threshold, by dual traversal of cover trees.

Equal vectors are brought together first, with their number, so copies never meet each other. A
cover tree over a bounded sample (``SAMPLE`` vectors of at most ``SAMPLE_BYTES``) deals all others
to cells, those next to one centre; the cells' covering radii are measured over all vectors. Cells
that lie together in the tree become chunks of about ``CHUNK_BYTES``, a cell with more is dealt to
several by hash. Every chunk gets a cover tree of its own, stored with the vectors.

The sample's tree, with radii that cover whole cells, is traversed against itself: chunks of cells
that the covering radii keep apart never meet. Chunks that do are first compared by their trees'
roots, which may still part them, or prove that all their vectors are links. The others meet two by
two in a task, where their trees are traversed together: pairs of nodes are left out by covering
radii, or taken as a whole if even their furthest vectors are close enough; only single vectors
near the threshold are compared in double precision. A task returns a count per vector and one
edge per vector to a vector it is connected with, never pairs.

With vectors in clusters most pairs of nodes fall at the top. Vectors without any structure, in many
dimensions, are all about equally far from each other, where no covering radius parts them; then
chunks all meet and the time is that of the products of all vectors, in blocks.

Edge cases: vectors that are null, zero, empty, or hold null or a number that isn't finite link with
nothing; vectors of different length do not link; rows without an id link by their vector, do not
give a component its name and are not kept; rows that share an id are vectors each, and not linked
by it; scaled vectors are other texts of one direction and link; ties at the threshold link as the
cosine in double precision says; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landinglake.llm.components import connected_components
from landinglake.llm.cover_tree import CoverTree, chord, traverse, unit
from landinglake.llm.tables import free_name, parts_for, stored
from landinglake.operators.joins import skew_join

# Vectors, and bytes of them in double precision, that the tree on the driver is made of.
SAMPLE, SAMPLE_BYTES = 1024, 8_000_000
# Bytes of vectors in a chunk; larger ones meet less often.
CHUNK_BYTES = 2_000_000
# Vectors that a chunk has at least room for, and that it can number.
LEAST_CHUNK, PLACES = 64, 1 << 24
# Tasks for pairs of chunks, and vectors handled at a time.
MOST_TASKS, BATCH = 20_000, 4096

COUNTED = "node bigint, links bigint, root bigint"


def is_comparable(vector: Column) -> Column:
    """A vector that has a direction."""
    return (vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x)
                                           | (F.abs(x) == float("inf")))
            & F.exists(vector, lambda x: x != 0))


def local_components(count: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least place connected with each of ``count`` places by the edges x - y."""
    root = np.arange(count)
    while True:
        at_x, at_y = root[x], root[y]
        apart = at_x != at_y
        if not apart.any():
            return root
        x, y, at_x, at_y = x[apart], y[apart], at_x[apart], at_y[apart]
        least = np.minimum(at_x, at_y)
        np.minimum.at(root, at_x, least)
        np.minimum.at(root, at_y, least)
        while (root[root] != root).any():
            root = root[root]


class Links:
    """What the traversal of two trees finds: links per vector and who is connected."""

    def __init__(self, a: CoverTree, b: CoverTree, vectors_a: np.ndarray, vectors_b: np.ndarray,
                 weights_a: np.ndarray, weights_b: np.ndarray, cosine: float, same: bool):
        self.a, self.b, self.same, self.cosine = a, b, same, cosine
        self.vectors = vectors_a, vectors_b
        self.sums = [np.concatenate([[0], np.cumsum(w)]) for w in (weights_a, weights_b)]
        self.change = [np.zeros(len(w) + 1, np.int64) for w in (weights_a, weights_b)]
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
        traverse(a, b, self.reach, self._settle)
        self.links = [np.cumsum(c[:-1]) for c in self.change]
        if same:
            self.links[0] = self.links[0] - weights_a  # not with itself

    def _settle(self, i, j, near, far):
        a, b = self.a, self.b
        singles = a.single(i) & b.single(j)
        whole = far + a.radius[i] + b.radius[j] <= self.reach - 1e-9
        if (open_ := singles & ~whole).any():
            whole[open_] = self._exact(a.begin[i[open_]], b.begin[j[open_]])
        self._take(i[whole], j[whole])
        return ~whole & ~singles

    def _exact(self, x, y):
        found = np.empty(len(x), bool)
        for at in range(0, len(x), BATCH):
            one, other = (v[p[at:at + BATCH]].astype(np.float64) for v, p in
                          zip(self.vectors, (x, y)))
            found[at:at + BATCH] = (np.einsum("ij,ij->i", unit(one), unit(other)) >= self.cosine
                                    ) | (one == other).all(axis=1)
        return found

    def _take(self, i, j):
        """All vectors of the nodes i are links of all vectors of the nodes j."""
        if not len(i):
            return
        a, b = self.a, self.b
        weight = self.sums[1][b.end[j]] - self.sums[1][b.begin[j]]
        np.add.at(self.change[0], a.begin[i], weight)
        np.add.at(self.change[0], a.end[i], -weight)
        shift = 0 if self.same else len(self.sums[0]) - 1
        if not self.same:
            weight = self.sums[0][a.end[i]] - self.sums[0][a.begin[i]]
            np.add.at(self.change[1], b.begin[j], weight)
            np.add.at(self.change[1], b.end[j], -weight)
        self.edges.append((a.begin[i], b.begin[j] + shift))
        for tree, nodes, by in ((a, i, 0), (b, j, shift)):
            for node in np.unique(nodes[~tree.single(nodes)]).tolist():
                own = np.arange(tree.begin[node], tree.end[node]) + by
                self.edges.append((own, np.full(len(own), own[0])))

    def rows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node, links, root) of all vectors with links; ``ids`` number those of a, then b."""
        links = np.concatenate(self.links[:1] if self.same else self.links)
        x, y = (np.concatenate([e[k] for e in self.edges]) if self.edges else np.zeros(0, np.int64)
                for k in (0, 1))
        root = local_components(len(links), x, y)
        some = links > 0
        return ids[some], links[some], ids[root[some]]


def _vectors(column: pa.Array, kind: type) -> np.ndarray:
    """The rows of a column of arrays of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def _chunk_trees(cells: DataFrame, kind: type, least_type: str) -> DataFrame:
    """Per chunk: a row per vector (node, key, copies, least) and one with the tree."""
    schema = (f"chunk bigint, node bigint, key struct<a: bigint, b: bigint>, copies bigint, "
              f"least {least_type}, tree binary, centre array<double>, radius double, "
              f"weight bigint")

    def build(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        tree = CoverTree(vectors := _vectors(table.column("embedding"), kind))
        copies = table.column("copies").to_numpy()[tree.order]
        packed = tree.to_bytes(vectors=vectors[tree.order], weights=copies,
                               ids=chunk * PLACES + np.arange(len(vectors)))
        own = table.take(pa.array(tree.order))
        rows = own.select(["chunk", "key", "copies", "least"]).add_column(
            1, "node", pa.array(chunk * PLACES + np.arange(len(vectors))))
        root = pa.table({
            "chunk": pa.array([chunk], pa.int64()), "tree": pa.array([packed], pa.binary()),
            "centre": pa.array([unit(tree.points[:1])[0].tolist()], pa.list_(pa.float64())),
            "radius": pa.array([float(tree.radius[0])]),
            "weight": pa.array([int(copies.sum())], pa.int64())})
        return pa.concat_tables([rows, root], promote_options="default")

    return cells.groupBy("chunk").applyInArrow(build, schema)


def _pair_links(pairs: DataFrame, cosine: float) -> DataFrame:
    """``COUNTED`` of pairs (pair, a, tree): one row per side, one alone for a chunk with itself."""
    def join(table: pa.Table) -> pa.Table:
        trees = [CoverTree.from_bytes(t.as_py()) for t in table.column("tree")]
        (a, more_a), (b, more_b) = trees[0], trees[-1]
        same = len(trees) == 1
        found = Links(a, b, more_a["vectors"], more_b["vectors"], more_a["weights"],
                      more_b["weights"], cosine, same)
        ids = more_a["ids"] if same else np.concatenate([more_a["ids"], more_b["ids"]])
        return pa.table(dict(zip(("node", "links", "root"), map(pa.array, found.rows(ids)))))

    return pairs.groupBy("pair").applyInArrow(join, COUNTED)


def _cells(classes: DataFrame, tree: CoverTree, kind: type) -> DataFrame:
    """``classes`` with the nearest point of the tree and the distance to it."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                points = unit(_vectors(batch.column("embedding"), kind)).astype(np.float32)
                cosine = points @ tree.points.T
                cell = cosine.argmax(axis=1)
                best = cosine[np.arange(len(cell)), cell].astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell, pa.int64()),
                     pa.array(chord(best - tree.error))], names=[*batch.schema.names, "cell", "away"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(assign, f"{fields}, cell bigint, away double")


def _cell_pairs(tree: CoverTree, away: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of points of the tree whose cells can hold vectors within ``reach`` of each other."""
    tree.widen(away)
    found = []

    def settle(i, j, near, far):
        singles = tree.single(i) & tree.single(j)
        found.append((tree.begin[i[singles]], tree.begin[j[singles]]))
        return ~singles

    traverse(tree, tree, reach, settle)
    return tuple(np.concatenate(x) for x in zip(*found))


def _linked(classes: DataFrame, cosine: float, chunk_bytes: int, sample: int) -> DataFrame:
    """(key, n_links, component) of classes (key, embedding, copies, least) of one length."""
    spark = classes.sparkSession
    dims = classes.select(F.size("embedding")).first()[0]
    field = classes.schema["embedding"].dataType.elementType.simpleString()
    kind = np.float32 if field == "float" else np.float64
    least_type = classes.schema["least"].dataType.simpleString()
    drawn = classes.orderBy(F.xxhash64("key"), "key").limit(
        max(1, min(sample, SAMPLE_BYTES // (8 * dims)))).select("embedding").toArrow()
    tree = CoverTree(_vectors(drawn.column(0), kind))
    cells = stored(_cells(classes, tree, kind), "cells")
    sizes = np.zeros(len(tree.points), np.int64)
    away = np.zeros(len(tree.points))
    # A row per point of the sample.
    for row in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"),
                                         F.max("away").alias("away")).collect():
        sizes[row.cell], away[row.cell] = row.n, row.away
    per_chunk = max(LEAST_CHUNK, min(PLACES // 4, chunk_bytes // (dims * np.dtype(kind).itemsize)))
    group, pieces = pack_cells(sizes, per_chunk)
    first = np.concatenate([[0], np.cumsum(pieces)])
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    x, y = _cell_pairs(tree, away, reach)
    near = np.unique(np.stack([np.minimum(group[x], group[y]), np.maximum(group[x], group[y])]),
                     axis=1)
    # At most a row per cell, and per two groups of cells: both bounded by the sample.
    deal = spark.createDataFrame([(c, int(first[g]), int(pieces[g])) for c, g in enumerate(group)],
                                 "cell bigint, first bigint, pieces bigint")
    dealt = cells.join(F.broadcast(deal), "cell").select(
        (F.col("first") + F.pmod(F.xxhash64("key"), F.col("pieces"))).alias("chunk"),
        "key", "embedding", "copies", "least")
    chunks = stored(_chunk_trees(dealt.repartition(int(first[-1]), "chunk"), kind, least_type),
                    "chunks")
    groups = spark.createDataFrame(
        [(int(first[g]), int(first[g + 1]) - 1, int(first[h]), int(first[h + 1]) - 1)
         for g, h in near.T.tolist()], "a0 bigint, a1 bigint, b0 bigint, b1 bigint")
    pairs = (groups.withColumn("a", F.explode(F.sequence("a0", "a1")))
             .withColumn("b", F.explode(F.sequence("b0", "b1"))).filter("a <= b").select("a", "b"))
    roots = chunks.filter("tree is not null")
    ball = roots.select("chunk", "centre", "radius", "weight")
    sides = [ball.toDF(s, f"centre_{s}", f"radius_{s}", f"weight_{s}") for s in "ab"]
    met = pairs.join(sides[0], "a").join(sides[1], "b")
    product = F.aggregate(F.zip_with("centre_a", "centre_b", lambda p, q: p * q),
                          F.lit(0.0), lambda total, p: total + p)
    apart = F.when(F.col("a") == F.col("b"), F.lit(0.0)).otherwise(
        F.sqrt(F.greatest(2 - 2 * product, F.lit(0.0))))
    wide = F.col("radius_a") + F.col("radius_b")
    # Centres are stored in single precision; this is far more than their distances can be off.
    met = stored(met.withColumn("apart", apart).filter(F.col("apart") <= wide + reach + 1e-3)
                 .withColumn("whole", F.col("apart") + wide <= reach - 1e-3)
                 .select("a", "b", "weight_a", "weight_b", "whole"), "chunk-pairs")
    both = met.filter("not whole").withColumn("pair", F.struct("a", "b"))
    n_pairs = both.count()
    trees = roots.select("chunk", "tree")
    held = both.select("pair", F.explode(F.array_distinct(F.array("a", "b"))).alias("chunk")) \
        .join(trees, "chunk").select("pair", "chunk", "tree")
    counted = stored(_pair_links(held.repartition(
        max(1, min(n_pairs, MOST_TASKS)), "pair"), cosine), "links")

    # Chunks that are links as a whole: a weight per chunk, and an edge per vector.
    ends = met.filter("whole").select(F.explode(F.array(
        F.struct(F.col("a").alias("chunk"), F.col("b").alias("other"),
                 F.col("weight_b").alias("weight")),
        F.struct(F.col("b").alias("chunk"), F.col("a").alias("other"),
                 F.col("weight_a").alias("weight")))).alias("x")).select("x.*").distinct()
    weights = ends.groupBy("chunk").agg(
        F.sum("weight").alias("weight"), F.max((F.col("other") == F.col("chunk")).cast("int"))
        .alias("itself"))
    vectors = chunks.filter("node is not null").select("chunk", "node", "key", "copies", "least")
    vectors = vectors.join(weights, "chunk", "left").join(
        counted.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
    vectors = stored(vectors.select(
        "node", "key", "copies", "least", (F.col("chunk") * PLACES).alias("origin"),
        F.col("weight").isNotNull().alias("whole"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("weight", F.lit(0))
         - F.when(F.col("itself") == 1, F.col("copies")).otherwise(0) + F.col("copies") - 1)
        .alias("n_links")), "vectors")
    edges = counted.select(F.col("node").alias("a"), F.col("root").alias("b")) \
        .unionByName(vectors.filter("whole").select(F.col("node").alias("a"),
                                                    F.col("origin").alias("b"))) \
        .unionByName(ends.select((F.col("chunk") * PLACES).alias("a"),
                                 (F.col("other") * PLACES).alias("b"))).filter("a != b")
    return _components(vectors, edges)


def pack_cells(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each cell, neighbours together, and the chunks of each group: a group has at
    most ``most`` vectors, or is one larger cell dealt to several chunks."""
    group, pieces, room = np.empty(len(sizes), np.int64), [], 0
    for cell, size in enumerate(sizes.tolist()):
        if not pieces or size > room:
            pieces.append(max(1, -(-size // most)))
            # A cell of several chunks takes no neighbours, so that its radius stays its own.
            room = most if size <= most else size
        group[cell] = len(pieces) - 1
        room -= size
    return group, np.array(pieces)


def _components(vectors: DataFrame, edges: DataFrame) -> DataFrame:
    """(key, n_links, component): the least id connected with each vector by the edges."""
    roots = connected_components(edges)
    named = roots.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    members = stored(vectors.join(named, "node").select("node", "root", "least"), "members")
    names = members.groupBy("root").agg(F.min("least").alias("component"))
    found = skew_join(members.select("node", "root"), names, "root").select("node", "component")
    return vectors.join(found, "node", "left").select(
        "key", "n_links", F.coalesce("component", "least").alias("component"))


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, chunk_bytes: int = CHUNK_BYTES,
                    sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    ``n_links`` counts the other rows with a cosine of at least ``cosine``, ``component_id`` is the
    least vec_id reachable by links, and the row of that id is ``kept``.
    """
    rows = vectors.select("vec_id", F.col("embedding"))
    sound = F.coalesce(is_comparable(F.col("embedding")), F.lit(False))
    key = F.struct(F.xxhash64("embedding").alias("a"),
                   F.xxhash64(F.lit(1), "embedding").alias("b"))
    alone = rows.filter(~sound).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    classes = stored(rows.filter(sound).groupBy("embedding").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")).withColumn("key", key),
        "classes")
    # One join per length of vectors that occurs.
    lengths = [r[0] for r in classes.select(F.size("embedding")).distinct().collect()]
    found = alone
    linked = [_linked(classes.filter(F.size("embedding") == n), cosine, chunk_bytes, sample)
              for n in sorted(lengths)]
    if linked:
        every = linked[0]
        for more in linked[1:]:
            every = every.unionByName(more)
        ids = rows.filter(sound).select("vec_id", key.alias("key"))
        found = skew_join(ids, every, "key").select(
            "vec_id", "n_links", F.col("component").alias("component_id")).unionByName(alone)
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"),
                                               F.lit(False)))
