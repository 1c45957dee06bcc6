"""Prefix trie of conversations, rolled up by centroid decomposition of its parent-edge forest.

* **Turns** are reduced to a hash, a number of code points and their place; no text is shuffled.  A conversation's turns are numbered
  in buckets of their turn number, so a conversation that holds a large share of all rows is no single task's.
* **Nodes.** A prefix is told by the sum of the hashes of its (place, role, text), two sums of 60 bits each.
  Sums run over buckets of places.  Spark groups the rows of all conversations by prefix: one row per node, with its
  smallest member and a bound on the nodes below it, the members' turns from the node on.
* **Components.** Nodes whose bounds have the same power of ``BASE`` below them and that hang together are a component; deep
  ones end at every ``STRIPE``-th turn.  Along any conversation the bound falls, so a component's top is the first
  node of its kind in the path of any member.  A component of the lowest kind has fewer than ``BASE`` nodes.
* **Rollup.** Kinds are done from the lowest up, all components of a kind at once.  A task splits its components at
  centroids, again and again: what hangs on the centroid is summed, the sum is given to the centroid and to every node on the path
  from it to its component's top, and the parts left are split in turn; every part has at most half of the nodes.
  The totals of the tops are added to their parents' own values before the next kind.
* **Conversations that end at a node** are written as strings of ranges of ids, which are hashed one after the
  other in order, so that a node in which most conversations end is not gathered anywhere.

Defined results: NULL role and text are empty; turns with one number are ordered by the md5 of role and text; repeated rows are turns
of their own; rows without conv_id are left out; an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odmeter.llm.groups import whole_groups
from odmeter.operators.position import with_position
from odmeter.session import cut_lineage, ship_package

SHARED = 6
FAMILY = 100
BASE = 1024
STRIPE = 1024
PLACES = 65_536
ENDS = 32_768
_EMPTY = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 0), turns (of the conversation), hash and chars of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("hash"),
        F.length(text).cast("bigint").alias("chars"),
    )
    # NULL comes before every number, so it gets the lowest bucket
    bucket = F.coalesce(F.expr(f"floor(turn / {PLACES})"), F.lit(-(2**62)))
    placed = with_position(slim, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("hash")], [bucket])
    return placed.select("conv_id", "position", F.col("group_rows").alias("turns"), "hash", "chars")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, length (in turns), depth, hash and chars of every rebuilt turn, and a row of depth 0 per conversation.

    The first turns come from the conversation that the hundred begins with, the others are its own.
    """
    convs = turns.groupBy("conv_id").agg(F.first("turns").alias("turns")).select(
        "conv_id", "turns", (F.crc32(F.col("conv_id").cast("string")) % SHARED).alias("head"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
    )
    bases = turns.where(F.col("conv_id") % FAMILY == 0)
    counted = bases.groupBy(F.col("conv_id").alias("base")).agg(F.first("turns").alias("base_turns"))
    convs = convs.join(counted, "base", "left")
    given = F.least("head", F.coalesce("base_turns", F.lit(0))).cast("bigint")
    convs = cut_lineage(convs.select(
        "conv_id", "base", "head", given.alias("given"), (given + F.greatest(F.col("turns") - F.col("head"), F.lit(0))).alias("length")
    ))
    heads = bases.where(F.col("position") < SHARED - 1).select(F.col("conv_id").alias("base"), "position", "hash", "chars")
    first = convs.join(heads, "base").where(F.col("position") < F.col("head")).select(
        "conv_id", "length", (F.col("position") + 1).alias("depth"), "hash", "chars"
    )
    own = turns.select("conv_id", "position", "hash", "chars").join(convs.drop("base"), "conv_id").where(F.col("position") >= F.col("head")).select(
        "conv_id", "length", (F.col("position") - F.col("head") + F.col("given") + 1).alias("depth"), "hash", "chars"
    )
    top = convs.select("conv_id", "length", F.lit(0).cast("bigint").alias("depth"), F.lit("").alias("hash"), F.lit(0).cast("bigint").alias("chars"))
    return first.unionByName(own).unionByName(top)


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, length, depth, chars) with node, the prefix's name, and parent, that of the prefix one turn shorter (NULL at the root)."""
    mixed = F.md5(F.concat_ws(":", "depth", "hash"))
    exact = "decimal(38,0)"
    parts = [F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.conv(F.substring(mixed, at, 15), 16, 10)).cast(exact) for at in (1, 16)]
    rows = turns.select("conv_id", "length", "depth", "chars", parts[0].alias("_a"), parts[1].alias("_b"), F.expr(f"depth div {PLACES}").alias("_stretch"))
    sums = rows.groupBy("conv_id", "_stretch").agg(F.sum("_a").cast(exact).alias("_all_a"), F.sum("_b").cast(exact).alias("_all_b"))
    before = Window.partitionBy("conv_id").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "_stretch", *(F.coalesce(F.sum(f"_all_{x}").over(before), F.lit(0)).cast(exact).alias(f"_before_{x}") for x in "ab"))
    inside = Window.partitionBy("conv_id", "_stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)

    def name(depth: Column, a: Column, b: Column) -> Column:
        return F.concat_ws(".", depth, *(F.pmod(x.cast(exact), F.lit(1 << 60).cast(exact)).cast("bigint") for x in (a, b)))

    rows = rows.join(sums, ["conv_id", "_stretch"])
    rows = rows.withColumns({f"_to_{x}": F.col(f"_before_{x}") + F.sum(f"_{x}").over(inside) for x in "ab"})
    above = name(F.col("depth") - 1, F.col("_to_a") - F.col("_a"), F.col("_to_b") - F.col("_b"))
    return rows.select(
        "conv_id", "length", "depth", "chars", name(F.col("depth"), F.col("_to_a"), F.col("_to_b")).alias("node"),
        F.when(F.col("depth") > 0, above).alias("parent"),
    )


def end_hashes(rows: DataFrame) -> DataFrame:
    """node and ends_sha256 of the nodes in which conversations end."""
    ends = rows.where("depth = length").select("node", "conv_id")
    written = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    ranges = ends.groupBy("node", F.expr(f"floor(conv_id / {ENDS})").alias("range")).agg(written.alias("ids"))
    ranges = ranges.withColumn("group", F.xxhash64("node"))

    def digest(batches):
        node, state = None, None
        for batch in batches:
            out = []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if name != node:
                    if node is not None:
                        out.append((node, state.hexdigest()))
                    node, state = name, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _table(out)
        yield _table([(node, state.hexdigest())] if node is not None else [])

    def _table(out):
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.string()) for c in (0, 1)], names=["node", "ends_sha256"])

    dealt = ranges.repartition("group").sortWithinPartitions("node", "range")
    return dealt.select("node", "range", "ids").mapInArrow(digest, "node string, ends_sha256 string")


def centroid_sums(parents: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (a row per node) over every node's subtree; ``parents`` has -1 for tops, and parents come first.

    A component is a list of its nodes, parents first.  Each is split at its centroid, the deepest node with half of its nodes or more below it.
    """
    n = len(parents)
    parent, totals = parents.tolist(), np.zeros_like(values)
    part, size, made = [0] * n, [0] * n, 0
    trees: dict[int, list[int]] = {}
    for v, p in enumerate(parent):
        top = v if p < 0 else part[p]
        part[v] = top
        trees.setdefault(top, []).append(v)
    todo, made = list(trees.values()), n
    while todo:
        nodes = todo.pop()
        if len(nodes) == 1:
            totals[nodes[0]] += values[nodes[0]]
            continue
        top = nodes[0]
        for v in nodes:
            size[v] = 1
        for v in reversed(nodes[1:]):
            size[parent[v]] += size[v]
        centroid = next(v for v in reversed(nodes) if 2 * size[v] >= len(nodes))
        # parts: one per child of the centroid, and what is left above
        below, above, own = defaultdict(list), [], part[top]
        part[centroid] = made
        first, made = made, made + 1
        for v in nodes:
            p = parent[v]
            if v == centroid:
                continue
            if p == centroid:
                part[v], made = made, made + 1
            elif p >= 0 and part[p] > first:
                part[v] = part[p]
            else:
                above.append(v)
                continue
            below[part[v]].append(v)
        hanging = [v for some in below.values() for v in some]
        total = values[centroid] + values[hanging].sum(axis=0)
        totals[centroid] += total
        if centroid != top:
            path, v = [], parent[centroid]
            while v != top:
                path.append(v)
                v = parent[v]
            path.append(top)
            totals[path] += total
        todo += below.values()
        if above:
            for v in above:
                part[v] = own
            todo.append(above)
    return totals


def _component_sums(nodes: DataFrame) -> DataFrame:
    """node, parent, is_top, n_leaves and saved (sums over the part of the subtree in the component) of whole components."""

    def roll(batches):
        for table, bounds in whole_groups(batches, "component"):
            # components with neighbours in one table are done as one forest
            names, above = table.column("node").to_pylist(), table.column("parent").to_pylist()
            group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)).tolist()
            place = {(g, name): k for k, (g, name) in enumerate(zip(group, names))}
            parents = np.array([place.get((g, p), -1) for g, p in zip(group, above)], np.int64)
            values = np.stack([table.column(c).to_numpy() for c in ("leaves", "saved")], axis=1)
            sums = centroid_sums(parents, values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(above, pa.string()), pa.array(parents < 0), pa.array(sums[:, 0]), pa.array(sums[:, 1])],
                names=["node", "parent", "is_top", "n_leaves", "saved_tokens"],
            )

    dealt = nodes.repartition("component").sortWithinPartitions("component", "depth")
    columns = dealt.select("component", "node", "parent", "leaves", "saved")
    return columns.mapInArrow(roll, "node string, parent string, is_top boolean, n_leaves bigint, saved_tokens bigint")


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """node, n_leaves and saved_tokens over whole subtrees; ``nodes`` has node, parent, depth, kind, stripe, component, leaves and saved."""
    kinds = sorted((r["kind"], -r["stripe"]) for r in nodes.select("kind", "stripe").distinct().collect())
    done, tops = None, None
    for kind, stripe in kinds:
        some = nodes.where((F.col("kind") == kind) & (F.col("stripe") == -stripe))
        if tops is not None:
            given = tops.groupBy(F.col("parent").alias("node")).agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
            some = some.join(given, "node", "left").withColumns({
                "leaves": F.col("leaves") + F.coalesce("_leaves", F.lit(0)), "saved": F.col("saved") + F.coalesce("_saved", F.lit(0)),
            }).drop("_leaves", "_saved")
        rolled = cut_lineage(_component_sums(some))
        done = rolled if done is None else done.unionByName(rolled)
        below = rolled.where("is_top").select("parent", "n_leaves", "saved_tokens")
        tops = below if tops is None else tops.unionByName(below)
    return done.select("node", "n_leaves", "saved_tokens")


def trie(conversations: DataFrame, base: int = BASE, stripe: int = STRIPE) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations; columns as in ``op13_prefix_trie``."""
    ship_package(conversations.sparkSession)
    rows = cut_lineage(prefixes(rebuilt(cut_lineage(numbered_turns(conversations)))))
    nodes = cut_lineage(rows.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("chars").alias("chars"),
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("first_id"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("bound"),
    ))
    if nodes.isEmpty():
        return nodes.select(
            F.col("first_id").alias("conv_id"), "depth", F.col("first_id").alias("parent_conv_id"), "n_convs", F.col("n_convs").alias("n_children"),
            F.col("n_convs").alias("n_leaves"), F.col("n_convs").alias("saved_tokens"), F.col("node").alias("ends_sha256"),
        )

    # the kind of a node is the power of ``base`` in its bound; the first node of a kind in a path is its component's top
    kind = F.lit(0)
    power = base
    while power < 2**62:
        kind, power = kind + F.when(F.col("bound") >= power, 1).otherwise(0), power * base
    path = rows.select("conv_id", "node").join(
        nodes.select("node", "depth", "first_id", kind.alias("kind"), F.expr(f"depth div {stripe}").alias("stripe")), "node"
    )
    of_kind = Window.partitionBy("conv_id", "kind", "stripe").orderBy("depth")
    path = path.withColumn("component", F.xxhash64(F.first("node").over(of_kind)))
    path = path.where(F.col("conv_id") == F.col("first_id")).select("node", "kind", "stripe", "component")

    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(path, "node").join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = cut_lineage(nodes.withColumns({
        "leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint"),
        "saved": ((F.col("n_convs") - 1) * F.col("chars")).cast("bigint"),
    }))

    above = nodes.select(F.col("node").alias("parent"), F.col("first_id").alias("parent_conv_id"))
    out = nodes.join(subtree_sums(nodes), "node").join(end_hashes(rows), "node", "left").join(above, "parent", "left")
    return out.select(
        F.col("first_id").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place,
   coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), bits AS (
  SELECT list(list_reduce([i::UBIGINT] || list_transform(range(8), lambda x: 0::UBIGINT),
    lambda a, b: xor(a >> 1, 3988292384::UBIGINT * (a & 1))) ORDER BY i) AS crcs FROM range(256) t(i)
), convs AS (
  SELECT conv_id, count(*) AS turns, conv_id - conv_id % 100 AS base FROM turns GROUP BY conv_id
), heads AS (
  SELECT conv_id, turns, base,
   xor(4294967295::UBIGINT, list_reduce([4294967295::UBIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
    lambda a, b: xor(a >> 8, crcs[(xor(a, b) & 255)::BIGINT + 1]))) % 6 AS h
  FROM convs, bits
), given AS (
  SELECT c.*, least(h::BIGINT, coalesce(b.turns, 0))::BIGINT AS given FROM heads c LEFT JOIN convs b ON b.conv_id = c.base
), built AS (
  SELECT g.conv_id, place + 1 AS depth, role, text FROM given g JOIN turns t ON t.conv_id = g.base AND place < h
  UNION ALL
  SELECT g.conv_id, place - h::BIGINT + given + 1, role, text FROM given g JOIN turns t ON t.conv_id = g.conv_id AND place >= h
), paths AS (
  SELECT conv_id, depth, length(text) AS chars, list((role, text)) OVER (PARTITION BY conv_id ORDER BY depth) AS prefix FROM built
  UNION ALL SELECT conv_id, 0, 0, [] FROM convs
), ending AS (SELECT conv_id, max(depth) AS length FROM paths GROUP BY conv_id
), nodes AS (
  SELECT depth, prefix, any_value(chars) AS chars, count(*) AS n_convs, min(conv_id) AS conv_id,
   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
  FROM paths JOIN ending USING (conv_id) GROUP BY depth, prefix
), named AS (SELECT *, row_number() OVER () AS node FROM nodes
), family AS (
  SELECT n.node AS below, m.node AS above, m.depth = n.depth - 1 AS direct, m.conv_id AS above_id
  FROM named n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth JOIN named m ON m.depth = p.depth AND m.prefix = p.prefix
), children AS (SELECT above AS node, count(*) AS n FROM family WHERE direct GROUP BY above
), sums AS (
  SELECT above AS node, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((n_convs - 1) * chars) AS saved
  FROM family f JOIN named n ON n.node = f.below LEFT JOIN children c ON c.node = f.below GROUP BY above
)
SELECT n.conv_id, n.depth::BIGINT AS depth, f.above_id AS parent_conv_id, n_convs, coalesce(c.n, 0) AS n_children, n_leaves,
 saved::BIGINT AS saved_tokens, ends_sha256
FROM named n JOIN sums USING (node) LEFT JOIN children c USING (node) LEFT JOIN family f ON f.below = n.node AND f.direct
"""


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
