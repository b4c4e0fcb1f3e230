"""Near-duplicate groups by a chosen-path set similarity join.

A text's set holds the hashes of its distinct word shingles. Texts with equal sets are one class from the start. Each class
has a sketch of `tokens` minwise tokens. Independent trees branch the classes: in every node the tree selects `branches` of
the tokens, and a class goes on to the child of each selected token's value. Nodes of up to `leaf` classes are compared
exhaustively by their sketches, larger ones branch again; a child that holds most of its parent is too dense to branch on
and is compared exhaustively in blocks. Pairs that pass the sketch and the size bound are confirmed on the full sets, within the node: only links leave it, no
more than connect its classes, so families of texts just below the threshold give no pairs either.

Groups of copies stay linear: before any comparison within nodes, each node's classes are compared with one pivot, for
`rounds` rounds, and a node whose classes are all connected by then needs no comparison at all. Later comparisons are only
between classes of different components. No pair is dropped by a cap.

A pair at the threshold is missed with probability (1 - 0.8) ** (branches * trees), about 3e-6, in nodes that are leaves,
and (1 - 0.93) ** trees, about 3e-5, however deep its nodes branch; the sketch bound misses about 2e-6.

Defined cases: texts without a word (NULL, empty) have an empty set and are linked with nothing; with fewer words than a
shingle the whole sequence is the only element; rows without a doc_id are linked with nothing, have no component and are
kept; repeated rows get equal results; an empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm import words as W
from tallywatch.llm.components import components
from tallywatch.llm.scratch import cut, gathered

FILTER_BITS = 1 << 26  # of the bitmap of wanted ids: 8 MB whatever the input
MAP_BITS = 32768  # of one bitmap built by Spark
ROWS_A_PART = 100_000  # of classes, nodes' members and pairs: some 300 bytes a row


@dataclass(frozen=True)
class Params:
    width: int = 5
    percent: int = 80
    tokens: int = 64
    trees: int = 4
    branches: int = 2
    leaf: int = 1024
    min_matches: int = 36
    rounds: int = 2
    max_depth: int = 8


def _sets(run: W.Run, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row."""
    lowered = W.LOWER[run.data]
    start, end, row = run.words(lowered)
    hashes = W.span_hashes(lowered, start, end)
    keys, at = W.windows(hashes, row, width)
    bounds = np.searchsorted(row[at], np.arange(run.n + 1))
    first = np.searchsorted(row, np.arange(run.n + 1))
    out = [np.unique(keys[bounds[i] : bounds[i + 1]]) for i in range(run.n)]
    n_words = np.diff(first)
    for i in np.flatnonzero((n_words > 0) & (n_words < width)):
        own = hashes[first[i] : first[i + 1]]
        out[i] = W.windows(own, np.zeros(len(own)), len(own), seed=len(own))[0]
    return out


def sketches(docs: DataFrame, params: Params) -> DataFrame:
    """Set size, set fingerprint and minwise tokens of every row: (doc_id, n, set_a, set_b, tokens)."""
    odd = W.mix(np.arange(1, params.tokens + 1, dtype=np.uint64)) | np.uint64(1)
    shift = W.mix(np.arange(1001, params.tokens + 1001, dtype=np.uint64))
    width = params.width

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in W.runs(batch.column("text")):
                sets = _sets(run, width)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(n)
                low = np.zeros((run.n, len(odd)), dtype=np.uint32)
                marks = np.zeros((2, run.n), dtype=np.uint64)
                if len(full):
                    every = np.concatenate(sets)
                    starts = (np.cumsum(n) - n)[full]
                    for k in range(len(odd)):
                        values = (((every ^ shift[k]) * odd[k]) >> np.uint64(32)).astype(np.uint32)
                        low[full, k] = np.minimum.reduceat(values, starts)
                    for k, salt in enumerate((11, 12)):
                        marks[k, full] = np.add.reduceat(W.mix(every + np.uint64(salt)), starts)
                raw = low.tobytes()
                size = 4 * len(odd)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(run.rows.start, run.n),
                        pa.array(n),
                        pa.array(marks[0].view(np.int64)),
                        pa.array(marks[1].view(np.int64)),
                        pa.array([raw[i * size : (i + 1) * size] for i in range(run.n)], pa.binary()),
                    ],
                    names=["doc_id", "n", "set_a", "set_b", "tokens"],
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(sketch, "doc_id long, n long, set_a long, set_b long, tokens binary")


def _wanted(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with the hash position of every id set: rows outside it are surely not wanted."""
    position = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    maps = (
        ids.select((position / MAP_BITS).cast("long").alias("part"), (position % MAP_BITS).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in maps:  # at most FILTER_BITS / MAP_BITS rows
        out[row["part"] * (MAP_BITS // 8) : (row["part"] + 1) * (MAP_BITS // 8)] = np.frombuffer(row["bits"], np.uint8)
    return out


def _full_sets(docs: DataFrame, ids: DataFrame, params: Params) -> DataFrame:
    """Full shingle sets of the rows whose doc_id is in `ids` (and of few others): (id, shingles)."""
    bits = docs.sparkSession.sparkContext.broadcast(_wanted(ids))
    width = params.width

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            batch = batch.filter(pa.array((bits.value[place >> 3] >> (place & 7)) & 1 == 1))
            for run in W.runs(batch.column("text")):
                sets = _sets(run, width)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(run.rows.start, run.n), pa.ListArray.from_arrays(ends, values)],
                    names=["id", "shingles"],
                )

    narrow = docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("id"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(FILTER_BITS)).alias("place"),
        F.col("text").cast("string").alias("text"),
    )
    return narrow.mapInArrow(build, "id long, shingles array<long>")


def confirm(docs: DataFrame, pairs: DataFrame, params: Params, pairs_at_most: int | None = None) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    pairs = gathered(pairs, ROWS_A_PART, pairs_at_most)
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = _full_sets(docs, ids, params)
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    shared = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).cast("long").alias("i"), (F.size("sa") + F.size("sb")).cast("long").alias("s"))
    return shared.filter(F.lit(100) * F.col("i") >= F.lit(params.percent) * (F.col("s") - F.col("i"))).select("a", "b")


def _tokens(column: pa.Array, count: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, count)


def _near_sizes(a, b, percent: int):
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def _passing(pairs: DataFrame, classes: DataFrame, params: Params) -> DataFrame:
    """The pairs (a, b) of class ids that the size bound and the sketches let pass."""
    one = classes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    two = classes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    sized = pairs.join(one, "a").join(two, "b").filter(_near_sizes(F.col("na"), F.col("nb"), params.percent))
    count, least = params.tokens, params.min_matches

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = _tokens(batch.column("ta"), count) == _tokens(batch.column("tb"), count)
            good = same.sum(axis=1) >= least
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return sized.select("a", "b", "ta", "tb").mapInArrow(test, "a long, b long")


_MEMBER = ["node", "i", "j", "chunk", "rep", "comp", "n", "root", "mask", "tokens"]


def _by_group(table: pa.Table) -> np.ndarray:
    return np.stack([table.column(c).to_numpy() for c in ("node", "i", "j")])


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of sorted batches, cut between groups."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        if not table.num_rows:
            continue
        group = _by_group(table)
        last = int(np.flatnonzero((group == group[:, -1:]).all(axis=0))[0])  # the last group may go on
        if last:
            yield table.slice(0, last)
        rest = table.slice(last)
    if rest is not None and rest.num_rows:
        yield rest


def _candidates(table: pa.Table, params: Params) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of the same group that size bound and sketches let pass and that no other node compares.

    Rows come sorted by group, so pairs are found by comparing each row with the next, the one after it and so on. A pair
    that also shares a root node with a lower number is left to that one, if it is compared there (`mask`).
    """
    group = _by_group(table)
    chunk, comp, n, root, mask = (table.column(c).to_numpy() for c in ("chunk", "comp", "n", "root", "mask"))
    tokens = _tokens(table.column("tokens"), params.tokens)
    roots = params.trees * params.branches
    lower = (np.arange(roots)[None, :] < root[:, None]) & ((mask[:, None] >> np.arange(roots)) & 1 == 1)
    crossing = group[1] != group[2]
    for step in range(1, len(chunk)):
        at = np.flatnonzero((group[:, step:] == group[:, :-step]).all(axis=0))
        if not len(at):
            return
        to = at + step
        fit = comp[at] != comp[to]
        fit &= 100 * np.minimum(n[at], n[to]) >= params.percent * np.maximum(n[at], n[to])
        fit &= ~crossing[at] | (chunk[at] != chunk[to])
        at, to = at[fit], to[fit]
        same = tokens[at] == tokens[to]
        good = (same.sum(axis=1) >= params.min_matches) & ~(same[:, :roots] & lower[at]).any(axis=1)
        yield at[good], to[good]


def _grouped(members: DataFrame) -> DataFrame:
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return members.repartition(tasks, "node", "i", "j").sortWithinPartitions("node", "i", "j", "rep")


def _flagged(members: DataFrame, params: Params) -> DataFrame:
    """The members that have a pair to be confirmed in their group."""

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            wanted = np.zeros(table.num_rows, dtype=bool)
            for at, to in _candidates(table, params):
                wanted[at] = wanted[to] = True
            yield from table.filter(pa.array(wanted)).to_batches()

    made = members.select(*_MEMBER)
    return _grouped(made).mapInArrow(flag, made.schema)


def _verified(flagged: DataFrame, sets: DataFrame, params: Params) -> DataFrame:
    """Links (a, b) of members of the same group whose full sets are similar enough.

    A group gives only as many links as connect its members: pairs that are connected already need no look.
    """
    percent = params.percent

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            pairs = [np.stack(p) for p in _candidates(table, params)]
            pairs = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), dtype=np.int64)
            pairs = pairs[:, np.lexsort(pairs[::-1])]
            rep = table.column("rep").to_numpy()
            column = table.column("shingles").combine_chunks()
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)  # sorted as such
            parent = np.arange(len(rep))
            links: list[tuple[int, int]] = []

            def find(x: int) -> int:
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            starts = np.flatnonzero(np.diff(pairs[0], prepend=-1))
            for begin, end in zip(starts, np.append(starts[1:], pairs.shape[1])):
                one, others = int(pairs[0, begin]), pairs[1, begin:end]
                others = others[[find(int(o)) != find(one) for o in others]]
                own = values[offsets[one] : offsets[one + 1]]
                sizes = offsets[others + 1] - offsets[others]
                every = np.concatenate([values[offsets[o] : offsets[o + 1]] for o in others] or [own[:0]])
                place = np.minimum(np.searchsorted(own, every), len(own) - 1)
                inside = np.concatenate([[0], np.cumsum(own[place] == every)])
                ends = np.cumsum(sizes)
                shared = inside[ends] - inside[ends - sizes]
                near = others[100 * shared >= percent * (len(own) + sizes - shared)]
                for other in near.tolist():
                    a, b = find(one), find(other)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        links.append((int(rep[one]), int(rep[other])))
            found = np.array(links, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    joined = flagged.join(sets.withColumnRenamed("id", "rep"), "rep").select(*_MEMBER, "shingles")
    return _grouped(joined).mapInArrow(verify, "a long, b long")


def _children(rows: DataFrame, params: Params) -> DataFrame:
    """Each row once per token that its node selects, in that token's child; `size` is the node's own."""
    def child(k: int):
        place = F.pmod(F.xxhash64("node", F.lit(k)), F.lit(params.tokens))
        return F.xxhash64("node", place, F.substring("tokens", (place * 4 + 1).cast("int"), F.lit(4)))

    split = F.explode(F.array(*[child(k) for k in range(params.branches)]))
    return rows.select(split.alias("child"), *[c for c in rows.columns if c != "node"]).withColumnRenamed("child", "node")


def _blocks(compared: DataFrame, params: Params) -> DataFrame:
    """Members of the groups (node, i, j): a node over `leaf` classes is compared chunk against chunk."""
    n_chunks = F.ceil(F.col("size") / params.leaf)
    others = F.explode(F.sequence(F.lit(0).cast("long"), n_chunks - 1))
    placed = compared.withColumn("chunk", F.pmod(F.xxhash64("rep"), n_chunks)).select("*", others.alias("other"))
    return placed.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")}).select(*_MEMBER)


def _labelled(rows: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Rows with their component, in nodes that hold more than one component, with the node's size."""
    if comps is None:
        rows = rows.withColumn("comp", F.col("rep"))
    else:
        rows = rows.drop("comp").join(comps.select(F.col("id").alias("rep"), F.col("component").alias("comp")), "rep", "left")
        rows = rows.withColumn("comp", F.coalesce("comp", "rep"))
    nodes = rows.groupBy("node").agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    return rows.drop("size").join(nodes.filter("low <> high").select("node", "size"), "node")


def links(docs: DataFrame, sketched: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """The classes (rep, n, set_a, set_b, tokens) and the component of every class that is linked (id, component)."""
    most = sketched.count()  # of classes; of a root's rows, and of the pairs of a round, there are `every` at most
    every = most * params.trees * params.branches
    classes = gathered(
        sketched.filter("n > 0 AND doc_id IS NOT NULL")
        .groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("tokens").alias("tokens")),
        ROWS_A_PART,
        most,
    )
    roots = [  # root r selects token r: tokens are independent, so any choice is as good
        F.struct(F.xxhash64(F.lit(r), F.substring("tokens", 4 * r + 1, 4)).alias("node"), F.lit(r).cast("long").alias("root"))
        for r in range(params.trees * params.branches)
    ]
    rows = gathered(_labelled(classes.select("rep", F.inline(F.array(*roots))), None), ROWS_A_PART, every)
    comps = None
    for step in range(params.rounds):
        key = F.col("rep") if step == 0 else F.xxhash64("rep", F.lit(step))
        pivots = rows.groupBy("node").agg(F.min(F.struct(key.alias("k"), "rep", "comp")).alias("p"))
        pairs = (
            rows.join(pivots, "node")
            .filter("comp <> p.comp")
            .select(F.least("rep", "p.rep").alias("a"), F.greatest("rep", "p.rep").alias("b"))
            .distinct()
        )
        found = gathered(confirm(docs, _passing(pairs, classes, params), params, every), ROWS_A_PART, every)
        edges = found if comps is None else comps.select(F.col("id").alias("a"), F.col("component").alias("b")).union(found)
        comps = cut(components(edges, most + every))
        rows = gathered(_labelled(rows.drop("size"), comps), ROWS_A_PART, every)

    def split(grown: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
        """Rows of the nodes to be compared now, and of those that go on."""
        now = F.col("size") <= params.leaf
        if depth:
            now = now | (F.col("size") * 2 > F.col("parent"))
        if depth == params.max_depth:
            now = F.lit(True)
        return grown.filter(now), grown.filter(~now)

    compared, going = split(rows, 0)
    masks = compared.groupBy("rep").agg(F.bit_or(F.expr("shiftleft(1L, CAST(root AS INT))")).alias("mask"))
    described = classes.select("rep", "n", "tokens").join(masks, "rep", "left").withColumn("mask", F.coalesce("mask", F.lit(0)).cast("long"))
    described = gathered(described.join(rows.select("rep").distinct(), "rep", "left_semi"), ROWS_A_PART, most)
    parts = [_blocks(compared.join(described, "rep"), params)]
    going = going.join(described, "rep")
    for depth in range(1, params.max_depth + 1):
        if going.isEmpty():
            break
        deeper = _children(going.withColumn("parent", F.col("size")).drop("size"), params)
        # a pair that a root node compares is left to it: deeper nodes come after all roots
        deeper = deeper.withColumn("root", F.lit(params.trees * params.branches).cast("long"))
        compared, going = split(gathered(_labelled(deeper, comps), ROWS_A_PART, every * params.branches**depth), depth)
        parts.append(_blocks(compared, params))
    flagged = _flagged(parts[0], params)
    for more in parts[1:]:
        flagged = flagged.union(_flagged(more, params))
    flagged = gathered(flagged, ROWS_A_PART)
    sets = _full_sets(docs, flagged.select(F.col("rep").alias("id")).distinct(), params)
    found = _verified(flagged, sets, params)
    edges = comps.select(F.col("id").alias("a"), F.col("component").alias("b")).union(found)
    return classes, cut(components(edges, most + flagged.count()))  # a group gives fewer links than it has members


def near_duplicates(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """Group of every row: (doc_id, n_shingles, component_id, kept); the smallest doc_id of a group stays."""
    sketched = cut(sketches(docs, params))
    classes, comps = links(docs, sketched, params)
    owner = classes.join(comps, classes["rep"] == comps["id"], "left").select(
        "set_a", "set_b", F.coalesce("component", "rep").alias("component_id")
    )
    placed = sketched.select("doc_id", F.col("n").alias("n_shingles"), "set_a", "set_b").join(owner, ["set_a", "set_b"], "left")
    return placed.select(
        "doc_id",
        "n_shingles",
        F.when((F.col("n_shingles") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
