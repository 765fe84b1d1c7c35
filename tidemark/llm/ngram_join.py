"""Exact Jaccard self-join of word n-gram sets by filters under several token orders.

Two sets that are similar enough must share a token among the first ones of each, under
any global order of the tokens. Under the first order (rare tokens first) that prefix
makes the candidates; under a second order candidates must share several tokens of a
longer prefix; what passes both is verified on the whole sets. Equal sets are one node.

Near copies would make pairs by the square of their number, but classes only need to be
connected. So first every node is only compared with one node of each of its
buckets (nodes sharing a prefix token, the token early enough in both); then, in buckets that still hold nodes of several
classes, nodes of different classes are compared. No link between two classes is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import documents_of, id_and_text, in_batches, in_parts
from tidemark.llm.components import connected_components, drop_table
from tidemark.llm.lookup import most_frequent
from tidemark.llm.shingle_sets import Shingler, mixed, set_number
from tidemark.sources.scratch import (
    materialize,
    scratch_path,
    scratch_scope,
    write_counted,
)


@dataclass(frozen=True)
class JoinRules:
    """Link when 100 * common >= percent * united, on sets of `width` words."""

    width: int = 4
    percent: int = 85
    # Tokens whose frequency every task knows; the order of the others is their hash.
    frequent_tokens: int = 500_000
    # A task reports a token that so many of its sets hold.
    reported_from: int = 3
    # Up to so many ids a list of documents is sent to all tasks, beyond it is joined.
    broadcast_ids: int = 1_000_000

    def least_common(self, size: int) -> int:
        """What a set of this size has in common with any partner."""
        return -(-self.percent * size // 100)

    def pair_common(self, size_a, size_b):
        """What two sets of these sizes have in common when they link (numbers or columns)."""
        return (self.percent * (size_a + size_b) + 99 + self.percent) // (100 + self.percent)

    def linked(self, common: int, size_a: int, size_b: int) -> bool:
        return 100 * common >= self.percent * (size_a + size_b - common)


# Tokens that a task holds together to count how many of its sets share each.
_HELD_TOKENS = 1 << 21
# Sets of which a task remembers that it has given them.
_HELD_NODES = 200_000

_SETS = pa.schema(
    [("doc_id", pa.int64()), ("node", pa.int64()), ("n_shingles", pa.int64()),
     ("key", pa.int64()), ("times", pa.int64())]
)
_SETS_DDL = "doc_id bigint, node bigint, n_shingles bigint, key bigint, times bigint"


def _read_sets(rows: DataFrame, rules: JoinRules) -> DataFrame:
    """A row per document (doc_id, node, n_shingles) and, between them, rows of tokens
    that several sets of a task share (key, times)."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rules.width)
        seen: set[int] = set()
        held: list[np.ndarray] = []
        length = 0

        def shared() -> Iterator[tuple]:
            # Sorted in place: the tokens are most of what a task holds.
            tokens = np.concatenate(held)
            held.clear()
            tokens.sort()
            ahead = rules.reported_from - 1
            often = np.unique(tokens[ahead:][tokens[ahead:] == tokens[: max(len(tokens) - ahead, 0)]])
            first, end = (np.searchsorted(tokens, often, side) for side in ("left", "right"))
            keys, times = often.view(np.int64).tolist(), (end - first).tolist()
            return ((None, None, None, k, t) for k, t in zip(keys, times))

        for ids, texts in documents_of(batches):
            rows = []
            for doc_id, text in zip(ids, texts):
                tokens = shingler.shingles(text)
                node = set_number(tokens) if len(tokens) else None
                rows.append((doc_id, node, len(tokens), None, None))
                if len(tokens) and node not in seen:
                    seen.add(node)
                    held.append(tokens)
                    length += len(tokens)
                if length >= _HELD_TOKENS:
                    yield from in_batches(_SETS, shared())
                    held.clear()
                    seen.clear()
                    length = 0
            yield from in_batches(_SETS, rows)
        if held:
            yield from in_batches(_SETS, shared())

    return rows.mapInArrow(read, _SETS_DDL)


class Orders:
    """Global orders of tokens: by known frequency, then by a hash of the order's own."""

    def __init__(self, keys: np.ndarray, times: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.times = keys[order], times[order]

    def sorted(self, tokens: np.ndarray, order: int) -> np.ndarray:
        times = np.zeros(len(tokens), np.int64)
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, tokens), len(self.keys) - 1)
            known = self.keys[place] == tokens
            times[known] = self.times[place[known]]
        return tokens[np.lexsort((mixed(tokens, order), times))]


def _extra(size: int, rules: JoinRules) -> int:
    """How many tokens of a set no partner needs to have. The first prefix is one token
    longer, the second prefix twice that and one."""
    return size - rules.least_common(size)


def _place(position: Column, size: Column) -> Column:
    """Where a token stands in its set's order, and the set's size, in one number."""
    return F.shiftleft(position.cast("long"), 32).bitwiseOR(size.cast("long"))


def _fit(rules: JoinRules, a: Column, b: Column) -> Column:
    """Whether sets can link whose first common token has these places: what follows it
    in either set must suffice. A pair that links fits at its first common token."""
    sizes = [place.bitwiseAND(F.lit(0xFFFFFFFF)) for place in (a, b)]
    least = F.floor(
        (F.lit(rules.percent) * (sizes[0] + sizes[1]) + (99 + rules.percent)) / (100 + rules.percent)
    )
    after = [size - F.shiftright(place, 32) for size, place in zip(sizes, (a, b))]
    return (after[0] >= least) & (after[1] >= least)


def _prefixes(rows: DataFrame, orders, rules: JoinRules) -> DataFrame:
    """node, n, first (tokens of the first prefix), second (of the longer second one, as
    sorted 32-bit hashes: an accidental match lets more pass, never less)."""
    schema = pa.schema(
        [("node", pa.int64()), ("n", pa.int32()), ("first", pa.list_(pa.int64())), ("second", pa.binary())]
    )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, by = Shingler(rules.width), Orders(*orders.value)
        seen: set[int] = set()

        def prefixes(texts: list[bytes]) -> Iterator[tuple]:
            for text in texts:
                tokens = shingler.shingles(text)
                node = set_number(tokens) if len(tokens) else None
                if node is None or node in seen:
                    continue
                if len(seen) >= _HELD_NODES:
                    seen.clear()
                seen.add(node)
                extra = _extra(len(tokens), rules)
                first = by.sorted(tokens, 1)[: extra + 1].view(np.int64)
                second = by.sorted(tokens, 2)[: 2 * extra + 1]
                short = np.sort((second >> np.uint64(32)).astype(np.uint32))
                yield node, len(tokens), first, short.tobytes()

        for _, texts in documents_of(batches):
            yield from in_batches(schema, prefixes(texts))

    return rows.mapInArrow(cut, "node bigint, n int, first array<bigint>, second binary")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two sorted arrays; repeated ones count as often as in both."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _may_link(rules: JoinRules) -> Callable[..., bool]:
    """Whether sizes and second prefixes allow a link."""

    def check(n_a: int, n_b: int, second_a: bytes, second_b: bytes) -> bool:
        if 100 * min(n_a, n_b) < rules.percent * max(n_a, n_b):
            return False
        # Of each prefix, all tokens but those the pair need not have in common are
        # common to both prefixes.
        longest = [min(n, 2 * _extra(n, rules) + 1) - n for n in (n_a, n_b)]
        need = min(longest) + rules.pair_common(n_a, n_b)
        return _common(np.frombuffer(second_a, np.uint32), np.frombuffer(second_b, np.uint32)) >= need

    return check


def _do_link(rules: JoinRules) -> Callable[..., bool]:
    def check(set_a: bytes, set_b: bytes) -> bool:
        a, b = np.frombuffer(set_a, np.uint64), np.frombuffer(set_b, np.uint64)
        return rules.linked(_common(a, b), len(a), len(b))

    return check


def _kept_pairs(pairs: DataFrame, columns: list[str], check: Callable[..., bool]) -> DataFrame:
    """The pairs (a, b) whose columns pass the check."""

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            values = zip(*(batch.column(name).to_pylist() for name in columns))
            kept = pa.array([check(*row) for row in values], pa.bool_())
            yield batch.select(["a", "b"]).filter(kept)

    return pairs.mapInArrow(keep, "a bigint, b bigint")


def _with_both(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Attach a node table's columns for a and for b."""
    for side in ("a", "b"):
        own = table.select(F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns))
        pairs = pairs.join(own, side)
    return pairs


def _verified(
    candidates: DataFrame, prefixes: DataFrame, rows: DataFrame, nodes: DataFrame, rules: JoinRules
) -> DataFrame:
    """Links among distinct candidate pairs (a, b): second filter, then the whole sets."""
    passed, _ = materialize(
        _kept_pairs(
            _with_both(candidates, prefixes, ["n", "second"]),
            ["n_a", "n_b", "second_a", "second_b"],
            _may_link(rules),
        ).distinct(),
        "ngram-passed",
    )
    ids, count = materialize(
        passed.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes, "node").select("doc_id"),
        "ngram-verified-ids",
    )
    few = count <= rules.broadcast_ids
    chosen = rows.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    # Nodes that only rows without an id hold are found among all of those.
    unnamed = not ids.where("doc_id is null").isEmpty()
    if unnamed:
        chosen = chosen.union(rows.where("doc_id is null"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rules.width)
        schema = pa.schema([("node", pa.int64()), ("tokens", pa.binary())])
        for _, texts in documents_of(batches):
            sets = map(shingler.shingles, texts)
            yield from in_batches(schema, ((set_number(s), s.tobytes()) for s in sets))

    sets = chosen.mapInArrow(read, "node bigint, tokens binary")
    if unnamed:
        sets = sets.dropDuplicates(["node"])
    return _kept_pairs(_with_both(passed, sets, ["tokens"]), ["tokens_a", "tokens_b"], _do_link(rules))


def similar_classes(
    docs: DataFrame, rules: JoinRules | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id for every row: the smallest doc_id that links
    reach, the row's own included.

    A text without words (or null) has no shingles and links with nothing. Rows with
    equal sets belong together, repeated rows too. A null doc_id takes part, but is
    never the smallest; a class of such rows alone has no component_id. Other columns
    are not read; an empty table gives an empty result. Work starts when this is called.
    Sets and tokens are told apart by 64-bit hashes.
    """
    sets, by_node = _classes(docs, rules or JoinRules(), id_col, text_col)
    return (
        sets.join(by_node, "node", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def _classes(
    docs: DataFrame, rules: JoinRules, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame]:
    """doc_id, node, n_shingles of every row; node, class, component_id of every node."""
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    read, _ = materialize(_read_sets(rows, rules), "ngram-sets")
    sets = read.where("n_shingles is not null")
    nodes = sets.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    shared = read.where("key is not null").groupBy("key").agg(F.sum("times").alias("times"))
    frequent = most_frequent(shared, ["times"], rules.frequent_tokens)
    orders = spark.sparkContext.broadcast(
        (
            np.array([row["key"] for row in frequent], np.int64).view(np.uint64),
            np.array([row["times"] for row in frequent], np.int64),
        )
    )
    prefixes, _ = materialize(_prefixes(rows, orders, rules), "ngram-prefixes")
    postings = prefixes.select(
        F.posexplode("first").alias("position", "token"), "node", "n"
    ).select("token", "node", _place(F.col("position"), F.col("n")).alias("place"))
    hubs = (
        postings.groupBy("token")
        .agg(
            F.min("place").alias("hub_place"),
            # Nodes of equal place are as good as one another.
            F.min_by("node", "place").alias("hub"),
            F.min("node").alias("low"),
            F.max("node").alias("high"),
            F.count(F.lit(1)).alias("rows"),
        )
        .where("low <> high")
        .drop("low", "high")
    )
    buckets, _ = materialize(postings.join(hubs, "token"), "ngram-buckets")
    to_hubs = (
        buckets.where((F.col("node") != F.col("hub")) & _fit(rules, F.col("place"), F.col("hub_place")))
        .select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
        .distinct()
    )
    links, _ = materialize(_verified(to_hubs, prefixes, rows, nodes, rules), "ngram-links")
    classes = connected_components(links, "ngram-hubs")

    # Buckets of two nodes are done; of the others those that hold several classes.
    open_rows = (
        buckets.where("rows > 2")
        .join(classes, "node", "left")
        .select("token", "node", "place", "hub", F.coalesce("component", "node").alias("class"))
    )
    several = (
        open_rows.groupBy("token")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .where("low <> high")
        .select("token")
    )
    left = open_rows.join(several, "token").distinct()
    one, other = left.alias("one"), left.alias("other")
    across = (
        one.join(other, F.col("one.token") == F.col("other.token"))
        .where("one.node < other.node and one.class <> other.class")
        .where("one.hub not in (one.node, other.node)")
        .where(_fit(rules, F.col("one.place"), F.col("other.place")))
        .select(F.col("one.node").alias("a"), F.col("other.node").alias("b"))
        .distinct()
    )
    more, _ = materialize(_verified(across, prefixes, rows, nodes, rules), "ngram-more")
    # What the rest does not read goes, so that a run needs less disk at once.
    drop_table(buckets)
    drop_table(prefixes)
    all_links = links.select("a", "b").union(more)
    final = connected_components(all_links, "ngram-all")
    named = nodes.join(final, "node", "left").withColumn("class", F.coalesce("component", "node"))
    smallest = named.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    return sets, named.join(smallest, "class").select("node", "class", "component_id")


def _fresh(name: str, taken: list[str]) -> str:
    """The name, or a longer one that no column has."""
    lower = {column.lower() for column in taken}
    while name.lower() in lower:
        name += "_"
    return name


def drop_similar(
    docs: DataFrame, rules: JoinRules | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The same table with one row of each class left: one with the smallest id (rows
    without an id come last), and of several with that id and one set any one, by the hash of
    its columns.

    Rows are judged by their text, not by their id: of two texts under one id each belongs
    to its own class, and rows without an id are copies like others. Texts without words
    and null ones are no copies of anything and all stay. Names of columns are free; an
    empty table gives an empty one. All tables made on the way are deleted when this returns,
    but for the lists of ids that go.
    """
    rules = rules or JoinRules()
    spark = docs.sparkSession
    # Outside the scope, so that they outlive it.
    lists = {name: scratch_path(spark, f"ngram-{name}") for name in ("losers", "unclear", "winners")}
    counts: dict[str, int] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        counts[name] = write_counted(df, lambda counted: counted.write.parquet(lists[name]))
        return spark.read.schema(df.schema).parquet(lists[name])

    with scratch_scope(spark):
        sets, by_node = _classes(docs, rules, id_col, text_col)
        placed, _ = materialize(
            sets.join(by_node.select("node", "class"), "node", "left").select("doc_id", "node", "class"),
            "ngram-placed",
        )
        first = (
            placed.where("class is not null")
            .groupBy("class")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("first"))
            .select("class", F.col("first.doc_id").alias("kept_id"), F.col("first.node").alias("kept_node"))
        )
        per_id = placed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
        unclear = store(
            "unclear", per_id.where("rows > 1 or doc_id is null").select(F.col("doc_id").alias("id"))
        )
        lost = placed.join(first, "class").where("not (doc_id <=> kept_id)")
        store("losers", lost.where("doc_id is not null").select(F.col("doc_id").alias("id")).distinct())
        if counts["unclear"]:
            store("winners", first.select(F.col("class").alias("of_class"), "kept_id", "kept_node"))
    losers = spark.read.schema("id bigint").parquet(lists["losers"])

    own = _fresh("own_id", docs.columns)
    keyed = docs.withColumn(own, F.col(id_col).cast("long"))

    def listed(table: DataFrame, name: str) -> DataFrame:
        named = table.select(F.col("id").alias(name))
        return F.broadcast(named) if counts["losers"] + counts["unclear"] <= rules.broadcast_ids else named

    other = _fresh("listed_id", keyed.columns)
    if not counts["unclear"]:
        gone = listed(losers, other)
        return keyed.join(gone, F.col(own) == F.col(other), "left_anti").select(*docs.columns)
    single = (
        keyed.where(F.col(own).isNotNull())
        .join(listed(unclear.where("id is not null"), other), F.col(own) == F.col(other), "left_anti")
        .join(listed(losers, other), F.col(own) == F.col(other), "left_anti")
        .select(*docs.columns)
    )
    # Rows whose id is repeated or missing are told apart by their set.
    several = keyed.join(
        listed(unclear, other), F.col(own).eqNullSafe(F.col(other)), "left_semi"
    )
    winners = spark.read.schema("of_class bigint, kept_id bigint, kept_node bigint").parquet(lists["winners"])
    return single.union(_one_of_each(several, winners, rules, own, text_col).select(*docs.columns))


def _one_of_each(
    rows: DataFrame, winners: DataFrame, rules: JoinRules, own: str, text_col: str
) -> DataFrame:
    """Rows without a set, and of each class one row with the kept id and set."""
    node = _fresh("own_node", rows.columns)
    schema = rows.select("*", F.lit(None).cast("bigint").alias(node)).schema

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rules.width)
        for batch in in_parts(batches):
            texts = batch.column(text_col).cast(pa.binary()).to_pylist()
            sets = (shingler.shingles(text or b"") for text in texts)
            nodes = [set_number(tokens) if len(tokens) else None for tokens in sets]
            yield batch.append_column(node, pa.array(nodes, pa.int64()))

    marked = rows.mapInArrow(mark, schema)
    free = {name: _fresh(name, marked.columns) for name in winners.columns}
    kept = winners.withColumnsRenamed(free)
    place = _fresh("own_place", marked.columns)
    chosen = marked.join(
        kept,
        (F.col(node) == F.col(free["kept_node"])) & F.col(own).eqNullSafe(F.col(free["kept_id"])),
    )
    # Equal rows have equal hashes, and it is one whichever of them stays.
    within = Window.partitionBy(free["of_class"]).orderBy(F.xxhash64(*[f"`{c}`" for c in rows.columns]))
    one = chosen.withColumn(place, F.row_number().over(within)).where(F.col(place) == 1)
    return marked.where(F.col(node).isNull()).select(*rows.columns).union(one.select(*rows.columns))
