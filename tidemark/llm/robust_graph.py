"""Near copies among embeddings by a robust-pruned flat graph on overlapping shards.

Vectors of one label are dealt to shards: each goes to its nearest centres, so that
neighbours meet in some shard. Every shard builds a graph: candidates of a vector are
its nearest ones and some at random, and a candidate is dropped if one already chosen is
much nearer to it than the vector is. The adjacency lists of all shards are united, with
both directions. In each shard every member is then looked for from the shard's medoid:
greedily with a beam, and, once within range, over all vectors in range. Cosines of what
was found are worked out in double precision. Recall is audited by comparing some
vectors with all; if it is too low, shards overlap more.

A shard of many members is cut into blocks with a graph each, and every pair of blocks
is a task of its own; so no task holds more than two blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.sources.scratch import materialize


@dataclass(frozen=True)
class GraphRules:
    threshold: float = 0.98
    # Shards per vector, and members per shard that the number of centres aims at.
    overlap: int = 2
    shard_members: int = 1_000
    most_centres: int = 512
    # Vectors from which centres are made, at most about so many.
    sample: int = 8_192
    block_members: int = 2_048
    nearest: int = 48
    random: int = 16
    degree: int = 16
    slack: float = 1.2
    beam: int = 24
    # Vectors whose id is divisible by this are audited, about so many of them at most.
    audit_step: int = 100
    audit_vectors: int = 2_000
    least_recall: float = 0.9


def _usable(label: Column, vector: Column) -> Column:
    infinite = F.lit(float("inf"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(label.isNotNull() & vector.isNotNull() & ~bad & some, F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, as squares of very large or small numbers leave the range.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _centres(sample: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means over a bounded sample of unit vectors."""
    random = np.random.default_rng(0)
    centres = sample[random.choice(len(sample), min(count, len(sample)), replace=False)]
    for _ in range(8):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        used = np.linalg.norm(sums, axis=1) > 1e-9
        centres = np.where(used[:, None], sums, centres)
        centres = centres / np.linalg.norm(centres, axis=1, keepdims=True)
    return centres


def _centres_by_size(nodes: DataFrame, rules: GraphRules) -> dict[int, np.ndarray]:
    """Centres for each length of vectors, from about `sample` of them in all."""
    by_label = nodes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("rows"))
    counts = by_label.agg(F.max("rows").alias("largest"), F.sum("rows").alias("all")).first()
    if not counts["all"]:
        return {}
    share = min(1.0, rules.sample / counts["all"])
    chosen = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    wanted = min(rules.most_centres, math.ceil(counts["largest"] / rules.shard_members))
    by_size: dict[int, list] = {}
    for row in chosen.select("size", "vector").collect():
        by_size.setdefault(row["size"], []).append(row["vector"])
    return {size: _centres(_unit(np.array(vs, np.float64)), wanted) for size, vs in by_size.items()}


_MEMBERS = pa.schema(
    [("label", pa.int64()), ("shard", pa.int32()), ("node", pa.int64()), ("copies", pa.int64()),
     ("size", pa.int32()), ("vector", pa.list_(pa.float64())), ("shards", pa.list_(pa.int32()))]
)
_MEMBERS_DDL = (
    "label bigint, shard int, node bigint, copies bigint, size int, vector array<double>,"
    " shards array<int>"
)


def _members(nodes: DataFrame, centres: dict[int, np.ndarray], overlap: int) -> DataFrame:
    """A row per vector and shard; vectors of a size without centres have one shard."""
    shared = nodes.sparkSession.sparkContext.broadcast(centres)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            rows, shards = [], []
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                known = shared.value.get(int(size))
                if known is None:
                    near = np.zeros((len(own), 1), np.int64)
                else:
                    vectors = _matrix(batch.column("vector").take(pa.array(own)), size)
                    most = min(overlap, len(known))
                    near = np.argsort(-(_unit(vectors) @ known.T), axis=1, kind="stable")[:, :most]
                rows.append(np.repeat(own, near.shape[1]))
                shards += [(shard, sorted(row)) for row in near.tolist() for shard in row]
            if rows:
                taken = batch.take(pa.array(np.concatenate(rows)))
                columns = {name: taken.column(name) for name in taken.schema.names}
                columns["shard"] = pa.array([shard for shard, _ in shards], pa.int32())
                columns["shards"] = pa.array([all_of for _, all_of in shards], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([columns[n] for n in _MEMBERS.names], schema=_MEMBERS)

    return nodes.mapInArrow(deal, _MEMBERS_DDL)


def _blocked(members: DataFrame, rules: GraphRules) -> DataFrame:
    """Add blocks (how many) and block (which) to the members of each shard."""
    keys = ["label", "size", "shard"]
    sizes = members.groupBy(keys).agg(
        F.ceil(F.count(F.lit(1)) / rules.block_members).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("node", "shard"), F.col("blocks")).cast("int")
    return members.join(sizes, keys).withColumn("block", block)


def pruned_graph(unit: np.ndarray, rules: GraphRules, seed: int = 0) -> list[np.ndarray]:
    """Neighbours of each vector after robust pruning, both directions."""
    count = len(unit)
    similar = unit @ unit.T
    np.fill_diagonal(similar, -2)
    nearest = min(rules.nearest, count - 1)
    if nearest < 1:
        return [np.empty(0, np.int64)] * count
    candidates = np.argpartition(-similar, nearest - 1, axis=1)[:, :nearest]
    far = np.random.default_rng(seed).integers(0, count, (count, rules.random))
    candidates = np.hstack([candidates, far])
    own = np.take_along_axis(similar, candidates, axis=1)
    order = np.argsort(-own, axis=1, kind="stable")
    candidates, own = np.take_along_axis(candidates, order, 1), np.take_along_axis(own, order, 1)
    distance = np.sqrt(np.maximum(2 - 2 * own, 0))
    alive = own > -2
    every = np.arange(count)
    edges = []
    for _ in range(rules.degree):
        first = alive.argmax(axis=1)
        some = alive[every, first]
        if not some.any():
            break
        chosen = candidates[every, first]
        edges.append(np.stack([every[some], chosen[some]]))
        between = np.sqrt(np.maximum(2 - 2 * similar[chosen[:, None], candidates], 0))
        alive &= rules.slack * between > distance
        alive &= candidates != chosen[:, None]
    start, end = np.concatenate(edges, axis=1)
    both = np.unique(np.concatenate([start * count + end, end * count + start]))
    cuts = np.searchsorted(both // count, every[1:])
    return np.split(both % count, cuts)


def medoid(unit: np.ndarray) -> int:
    return int((unit @ unit.sum(axis=0)).argmax())


def range_search(
    queries: np.ndarray,
    graph: np.ndarray,
    neighbours: list[np.ndarray],
    entries: list[np.ndarray],
    rules: GraphRules,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector of the graph) found in range.

    `entries` holds where each query starts: the medoid, and itself if it is a member.
    In each round every query goes on from its best vector not yet gone on from, while
    that is among the `beam` best it has seen; and from all such vectors in range.
    """
    near = rules.threshold - 1e-4
    lengths = np.fromiter(map(len, neighbours), np.int64, len(neighbours))
    flat = np.concatenate([*neighbours, np.empty(0, np.int64)]).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    seen = np.full((len(queries), len(graph)), -2, np.float32)
    open_ = np.zeros(seen.shape, bool)

    def visit(query: np.ndarray, vector: np.ndarray) -> None:
        codes = np.unique(query * len(graph) + vector)
        query, vector = codes // len(graph), codes % len(graph)
        new = seen[query, vector] == -2
        query, vector = query[new], vector[new]
        for start in range(0, len(query), 1 << 17):
            q, v = query[start : start + (1 << 17)], vector[start : start + (1 << 17)]
            seen[q, v] = np.einsum("ij,ij->i", queries[q], graph[v])
            open_[q, v] = True

    visit(
        np.repeat(np.arange(len(queries)), list(map(len, entries))), np.concatenate(entries)
    )
    every = np.arange(len(queries))
    beam = min(rules.beam, len(graph))
    while open_.any():
        waiting = np.where(open_, seen, -3)
        best = waiting.argmax(axis=1)
        limit = -np.partition(-seen, beam - 1, axis=1)[:, beam - 1]
        goes = open_[every, best] & (waiting[every, best] >= limit)
        on = open_ & (seen >= near)
        on[every[goes], best[goes]] = True
        query, vector = np.nonzero(on)
        if not len(query):
            break
        open_[query, vector] = False
        many = lengths[vector]
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        visit(np.repeat(query, many), flat[np.repeat(offsets[vector], many) + place])
    return np.nonzero(seen >= near)


def _adjacency(members: DataFrame, rules: GraphRules) -> DataFrame:
    """node, neighbours over all shards: the union of the shards' lists."""
    schema = pa.schema([("node", pa.int64()), ("neighbours", pa.list_(pa.int64()))])

    def build(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        unit = _unit(_matrix(table.column("vector"), table.column("size")[0].as_py()))
        lists = [nodes[found] for found in pruned_graph(unit.astype(np.float32), rules)]
        return pa.table([pa.array(nodes), pa.array(lists, pa.list_(pa.int64()))], schema=schema)

    built = members.groupBy("label", "size", "shard", "block").applyInArrow(
        build, "node bigint, neighbours array<bigint>"
    )
    return built.groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours")
    )


def _smallest_labels(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that links reach, for each row."""
    label = np.arange(count)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            return label


_FOUND = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
_FOUND_DDL = "node bigint, links bigint, root bigint"
_QUERIES_AT_ONCE = 512


def _search_blocks(table: pa.Table, rules: GraphRules) -> pa.Table:
    """Links between two blocks of a shard (or within one): for each vector how many it
    has, copies counted, and a vector that stands for what it is connected with.

    A pair that meets in several shards counts in the lowest of them.
    """
    shard = table.column("shard")[0].as_py()
    nodes, copies = (table.column(name).to_numpy() for name in ("node", "copies"))
    vectors = _matrix(table.column("vector"), table.column("size")[0].as_py())
    exact = _unit(vectors)
    unit = exact.astype(np.float32)
    block = table.column("block").to_numpy()
    lists = table.column("neighbours").to_pylist()
    row_of = {node: row for row, node in enumerate(nodes.tolist())}
    low, high = block.min(), block.max()
    found_a, found_b = [], []
    for of_queries, of_graph in {(low, high), (high, low)}:
        queries, graph = np.flatnonzero(block == of_queries), np.flatnonzero(block == of_graph)
        local = np.full(len(nodes), -1)
        local[graph] = np.arange(len(graph))
        neighbours = []
        for row in graph:
            rows = [row_of[n] for n in lists[row] or () if n in row_of]
            places = local[np.array(rows, dtype=np.int64)]
            neighbours.append(places[places >= 0])
        start = medoid(unit[graph])
        for first in range(0, len(queries), _QUERIES_AT_ONCE):
            part = queries[first : first + _QUERIES_AT_ONCE]
            entries = [np.array([start, *([local[q]] if local[q] >= 0 else [])]) for q in part]
            q, v = range_search(unit[part], unit[graph], neighbours, entries, rules)
            found_a.append(part[q])
            found_b.append(graph[v])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    codes = np.unique(np.minimum(a, b) * len(nodes) + np.maximum(a, b))
    a, b = codes // len(nodes), codes % len(nodes)
    a, b = a[a != b], b[a != b]
    shards = table.column("shards").to_pylist()
    lowest = np.array([min(set(shards[i]) & set(shards[j])) == shard for i, j in zip(a, b)], bool)
    a, b = a[lowest], b[lowest]
    same = np.empty(len(a), bool)
    for first in range(0, len(a), 1 << 16):
        part = slice(first, first + (1 << 16))
        same[part] = np.einsum("ij,ij->i", exact[a[part]], exact[b[part]]) >= rules.threshold
    a, b = a[same], b[same]
    links = np.bincount(a, copies[b], len(nodes)) + np.bincount(b, copies[a], len(nodes))
    root = nodes[_smallest_labels(len(nodes), a, b)]
    some = links > 0
    columns = [nodes[some], links[some].astype(np.int64), root[some]]
    return pa.table([pa.array(column) for column in columns], schema=_FOUND)


def _found(members: DataFrame, rules: GraphRules) -> DataFrame:
    adjacency, _ = materialize(_adjacency(members, rules), "graph-adjacency")
    with_lists = members.join(adjacency, "node", "left")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = with_lists.withColumn("other", other).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    )
    return pairs.groupBy("label", "size", "shard", "low", "high").applyInArrow(
        lambda table: _search_blocks(table, rules), _FOUND_DDL
    )


def _audit(nodes: DataFrame, counts: DataFrame, rules: GraphRules) -> float:
    """Links found over links there are, for a bounded number of vectors against all."""
    audited = nodes.where(F.col("vec_id") % rules.audit_step == 0)
    total = audited.count()
    share = math.ceil((1 << 20) * min(1.0, rules.audit_vectors / max(total, 1)))
    chosen = audited.where(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 20)) < share)
    rows = chosen.join(counts, "node", "left").select("node", "label", "size", "vector", "links").collect()
    by_group: dict[tuple, list] = {}
    for row in rows:
        by_group.setdefault((row["label"], row["size"]), []).append((row["node"], row["vector"]))
    shared = nodes.sparkSession.sparkContext.broadcast(by_group)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, sizes, ids, copies = (
                batch.column(name).to_numpy() for name in ("label", "size", "node", "copies")
            )
            for (label, size), queries in shared.value.items():
                own = np.flatnonzero((labels == label) & (sizes == size))
                if not len(own):
                    continue
                all_of = _unit(_matrix(batch.column("vector").take(pa.array(own)), size))
                asked = np.array([node for node, _ in queries])
                cosine = _unit(np.array([v for _, v in queries], np.float64)) @ all_of.T
                there = (cosine >= rules.threshold) & (asked[:, None] != ids[own][None, :])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int((there * copies[own]).sum())])], names=["links"]
                )

    there = nodes.mapInArrow(compare, "links bigint").agg(F.sum("links").alias("links")).first()["links"]
    return sum(row["links"] or 0 for row in rows) / there if there else 1.0


def link_embeddings(
    embeddings: DataFrame,
    rules: GraphRules | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id, kept and recall for every row.

    Vectors link within a label at a cosine of `threshold` or more. A row without a
    label, without a vector, or with a null, non-finite or all-zero one links with
    nothing; vectors of different lengths do not link. Equal vectors of a label are one
    node with copies, so a large group of them costs one row; repeated rows count as
    copies. component_id is the smallest vec_id that links reach; a null vec_id takes
    part but is never the smallest. `recall` is that of the audit. Other columns are not
    read; an empty table gives an empty result. Work starts when this is called.
    """
    rules = rules or GraphRules()
    own = embeddings.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    number = F.when(_usable(F.col("label"), F.col("vector")), F.xxhash64("label", "vector"))
    numbered = own.withColumn("node", number)
    rows = numbered.select("vec_id", "node")
    nodes, _ = materialize(
        numbered.where("node is not null")
        .groupBy("node")
        .agg(
            F.min("vec_id").alias("vec_id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("label").alias("label"),
            F.first("vector").alias("vector"),
        )
        .withColumn("size", F.size("vector")),
        "graph-nodes",
    )
    centres = _centres_by_size(nodes, rules)
    most = max(map(len, centres.values()), default=1)
    overlap = min(rules.overlap, most)
    while True:
        members, _ = materialize(_blocked(_members(nodes, centres, overlap), rules), "graph-members")
        found, _ = materialize(_found(members, replace(rules, overlap=overlap)), "graph-found")
        counts = found.groupBy("node").agg(F.sum("links").alias("links"))
        recall = _audit(nodes, counts, rules)
        if recall >= rules.least_recall or overlap == most:
            break
        overlap = min(2 * overlap, most)
    links = found.select(F.col("node").alias("a"), F.col("root").alias("b"))
    classes = connected_components(links, "graph")
    named = (
        nodes.select("node", "vec_id", "copies")
        .join(counts, "node", "left")
        .join(classes, "node", "left")
        .withColumn("class", F.coalesce("component", "node"))
    )
    smallest = named.groupBy("class").agg(F.min("vec_id").alias("component_id"))
    by_node = named.join(smallest, "class").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    component = F.coalesce("component_id", "vec_id")
    return rows.join(by_node, "node", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        F.lit(float(recall)).alias("recall"),
    )
