"""Merkle manifest of a dataset, kept as a persistent tree whose versions copy only a path.

Every row is a leaf: the SHA-256 of its typed, length-prefixed fields. The leaves of a language, ascending by ``doc_id``,
are folded by runs of ``ARITY`` into a subroot, the subroots of the languages into the root. A tampered leaf makes a
version of the tree: it shares every node off its path with the original and copies only its ancestors, first inside the
aligned block of ``ARITY ** BLOCK_LEVELS`` leaves that holds it, then through the upper levels, whose siblings the
whole block shares. A version verifies if its copied root is the original root.

Scale: texts are hashed inside the scan and never shuffled; what moves is a row of digests per document. Positions come from a
range partitioning by (language, doc_id), so a language with most of the rows is cut into as many ranges as any other,
and from counts of each range. A task holds one block of 512 nodes; the block roots are the nodes of the next round,
so rounds fall off by a factor of 512. Once a round has at most ``TOP_NODES`` nodes in all, one task finishes the levels above
(three rounds for 10**12 leaves); more languages than that are ranked and folded in rounds like leaves. The driver sees two numbers a round.

Edge cases: a null field is hashed as ``-``, an empty text as ``0:``; long texts are hashed whole. Null ``doc_id`` and null
``lang`` come first. Rows of equal language and id are ordered by their leaf, so repeated rows are repeated leaves. A lone
leaf is its subroot, a lone subroot the root; the proof without siblings is the digest of nothing. An empty table gives no
rows. A tampered text without a letter A-Z stays as it is and verifies. Only the five columns are read; others may have any name.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prelaunch.llm.components import shared_checkpoint

ARITY = 8
BLOCK_LEVELS = 3
TOP_NODES = 1 << 14          # nodes of a round that one task folds up to the root
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_left(n: int) -> int:
    """Foldings until one of ``n`` nodes remains."""
    out = 0
    while n > 1:
        n, out = -(-n // ARITY), out + 1
    return out


def leaf_digest(fields: list[Column]) -> Column:
    part = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[part(c.cast("string")) for c in fields]), 256)


def leaves_of(docs: DataFrame, tampered: Column | None = None, text: Column | None = None) -> DataFrame:
    """(doc_id, w_tree, leaf, changed): a leaf per row, and for ``tampered`` rows the leaf with ``text`` in place of the
    original text. ``w_tree`` is the language as a key that is never null and sorts null first."""
    leaf = leaf_digest([F.col(c) for c in FIELDS])
    changed = F.lit(None).cast("string")
    if tampered is not None:
        changed = F.when(tampered, leaf_digest([*[F.col(c) for c in FIELDS[:-1]], text]))
    return docs.select("doc_id", F.coalesce(F.concat(F.lit("."), F.col("lang").cast("string")), F.lit("")).alias("w_tree"),
                       leaf.alias("leaf"), changed.alias("changed"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the row's place in its ``w_tree`` by ``order``, and ``n``, the tree's size, without a window
    over a whole tree: ranges are sorted and counted, and each starts where those before it end."""
    by = ["w_tree", *order]
    ranges = shared_checkpoint(rows.repartitionByRange(*by).sortWithinPartitions(*by))
    at = ranges.withColumn("w_id", F.monotonically_increasing_id())
    at = at.withColumns({"w_part": F.shiftright("w_id", 33), "w_at": F.col("w_id").bitwiseAND((1 << 33) - 1)}).drop("w_id")
    counts = at.groupBy("w_tree", "w_part").agg(F.min("w_at").alias("w_first"), F.count("*").alias("w_rows"))
    tree = Window.partitionBy("w_tree")
    before = F.sum("w_rows").over(tree.orderBy("w_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("w_tree", "w_part", (F.coalesce(before, F.lit(0)) - F.col("w_first")).alias("w_shift"),
                            F.sum("w_rows").over(tree).alias("n"))
    return at.join(offsets, ["w_tree", "w_part"]).withColumn("pos", F.col("w_at") + F.col("w_shift")).drop("w_part", "w_at", "w_shift")


class Block:
    """One aligned block: all nodes of its levels, and what each node's path looks like to a proof."""

    def __init__(self, nodes: list[str], n: int, levels: int):
        self.levels = [nodes]
        for _ in range(min(levels, levels_left(n))):
            last = self.levels[-1]
            self.levels.append([digest("".join(last[i: i + ARITY])) for i in range(0, len(last), ARITY)])
        # per node the (before, after) siblings of its level and of the levels above it
        above: list[list] = [[] for _ in self.levels[-1]]
        for nodes in reversed(self.levels[:-1]):
            mine = []
            for i in range(len(nodes)):
                first = i - i % ARITY
                mine.append([("".join(nodes[first: i]), "".join(nodes[i + 1: first + ARITY])), *above[i // ARITY]])
            above = mine
        self.steps = above

    @property
    def root(self) -> str:
        return self.levels[-1][0]


def copied_path(node: str, steps: list[tuple[str, str]]) -> list[str]:
    """The ancestors that a version with ``node`` in place copies, from below up; everything else is shared."""
    out = []
    for before, after in steps:
        node = digest(before + node + after)
        out.append(node)
    return out


def written(steps: list[tuple[str, str]]) -> str:
    return ";".join(f"{b}|{a}" for b, a in steps)


def read(steps: str) -> list[tuple[str, str]]:
    return [tuple(s.split("|")) for s in steps.split(";")] if steps else []


def _block(levels: int) -> Column:
    return F.floor(F.col("pos") / ARITY ** levels).alias("w_block")


def _sorted_block(table: pa.Table, column: str, levels: int) -> tuple[pa.Table, Block]:
    table = table.sort_by("pos")
    return table, Block(table.column(column).to_pylist(), table.column("n")[0].as_py(), levels)


def fold(nodes: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """(w_tree, pos, n, node): the roots of the aligned blocks of ``nodes`` (same columns), one round up."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, block = _sorted_block(table, "node", levels)
        n = -(-table.column("n")[0].as_py() // ARITY ** levels)
        return pa.table({"w_tree": [key[0].as_py()], "pos": [key[1].as_py()], "n": [n], "node": [block.root]})

    grouped = nodes.select("w_tree", "pos", "n", "node").groupBy("w_tree", _block(levels))
    return grouped.applyInArrow(run, "w_tree string, pos long, n long, node string")


def rounds(nodes: DataFrame, levels: int = BLOCK_LEVELS, top_nodes: int = 0) -> list[DataFrame]:
    """``nodes`` and the block roots of every round above, up to at most ``top_nodes`` nodes or to one node per tree."""
    out = [nodes]
    while True:
        if len(out) > 1:
            out[-1] = shared_checkpoint(out[-1])
        total, most = out[-1].agg(F.count("*"), F.max("n")).first()
        if (most or 0) <= 1 or len(out) > 1 and total <= top_nodes:
            return out
        out.append(fold(out[-1], levels))


def finished(nodes: DataFrame) -> DataFrame:
    """(w_tree, pos, steps, subroot, root) of a round of few nodes: all trees and the tree of their subroots, in one task."""

    def run(batches):
        trees: dict[str, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                trees.setdefault(r["w_tree"], []).append((r["pos"], r["node"]))
        names = sorted(trees, key=str.encode)
        blocks = {k: Block([node for _, node in sorted(trees[k])], len(trees[k]), 64) for k in names}
        forest = Block([blocks[k].root for k in names], len(names), 64)
        for k, above in zip(names, forest.steps):
            n = len(trees[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * n), pa.array(range(n), pa.int64()), pa.array([written([*s, *above]) for s in blocks[k].steps]),
                 pa.array([blocks[k].root] * n), pa.array([forest.root] * n)], ["w_tree", "pos", "steps", "subroot", "root"])

    return nodes.select("w_tree", "pos", "node").coalesce(1).mapInArrow(run, "w_tree string, pos long, steps string, subroot string, root string")


def descend(nodes: DataFrame, upper: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """(w_tree, pos, steps): the siblings on the path of every node of a round; ``upper`` has those of the round above."""

    def run(key: tuple, table: pa.Table, over: pa.Table) -> pa.Table:
        table, block = _sorted_block(table, "node", levels)
        rest = read(over.column("steps")[0].as_py())
        return pa.table({"w_tree": [key[0].as_py()] * len(table), "pos": table.column("pos").cast(pa.int64()),
                         "steps": [written([*s, *rest]) for s in block.steps]})

    left = nodes.select("w_tree", "pos", "n", "node").groupBy("w_tree", _block(levels))
    right = upper.select("w_tree", F.col("pos").alias("w_block"), "steps").groupBy("w_tree", "w_block")
    return left.cogroup(right).applyInArrow(run, "w_tree string, pos long, steps string")


@dataclass
class Manifest:
    """``leaves``: doc_id, leaf, changed, w_tree, pos, n. ``blocks``: per block of leaves the siblings on the path of its root
    (w_tree, pos, steps), subroot and root. ``nodes``: the block roots of every round that was distributed (w_tree, round, pos, node)."""
    leaves: DataFrame
    blocks: DataFrame
    nodes: DataFrame


def build(leaves: DataFrame, levels: int = BLOCK_LEVELS, top_nodes: int = TOP_NODES) -> Manifest:
    """The tree over ``leaves`` (see :func:`leaves_of`)."""
    places = shared_checkpoint(numbered(leaves, ["doc_id", "leaf"]))
    trees = rounds(places.withColumnRenamed("leaf", "node"), levels, top_nodes)
    if len(trees) == 1:
        trees.append(shared_checkpoint(fold(trees[0], levels)))       # lone leaves
    if trees[-1].count() <= top_nodes:
        down = shared_checkpoint(finished(trees[-1]))
        tops = down.where("pos = 0").select("w_tree", "subroot", "root")
        down = down.drop("subroot", "root")
    else:
        tops, down = _forest(trees[-1], levels)
    for nodes in reversed(trees[1:-1]):
        down = descend(nodes, down, levels)
    kept = trees[0].select("w_tree", F.lit(0).alias("round"), "pos", "node")
    for i, nodes in enumerate(trees[1:], 1):
        kept = kept.unionByName(nodes.select("w_tree", F.lit(i).alias("round"), "pos", "node"))
    return Manifest(places, down.join(tops, "w_tree"), kept)


def _forest(nodes: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """(tops, down) when trees of one node each are many: their subroots are ranked and folded like the leaves of one tree."""
    subroots = nodes.select(F.lit("").alias("w_tree"), F.col("w_tree").alias("w_name"), "node")
    ranked = shared_checkpoint(numbered(subroots, ["w_name", "node"]))
    forest = rounds(ranked, levels)
    steps = forest[-1].select("w_tree", "pos", F.lit("").alias("steps"))
    for nodes in reversed(forest[:-1]):
        steps = descend(nodes, steps, levels)
    root = forest[-1].select(F.col("node").alias("root"))
    named = ranked.select(F.col("w_name").alias("w_tree"), "pos", F.col("node").alias("subroot")).join(steps.drop("w_tree"), "pos")
    tops = shared_checkpoint(named.join(F.broadcast(root)))                   # the root is one row
    return tops.select("w_tree", "subroot", "root"), tops.select("w_tree", F.lit(0).cast("long").alias("pos"), "steps")


def versions(manifest: Manifest, levels: int = BLOCK_LEVELS) -> DataFrame:
    """A row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and for a changed leaf ``copied``, the
    digests of the nodes that its version of the tree copies, from its parent up to the root."""
    kind = manifest.leaves.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, copied array<string>"

    def run(key: tuple, table: pa.Table, over: pa.Table) -> pa.Table:
        table, block = _sorted_block(table, "leaf", levels)
        rest = read(over.column("steps")[0].as_py())
        root, subroot = over.column("root")[0].as_py(), over.column("subroot")[0].as_py()
        beyond = "".join(b + a for b, a in rest)
        unchanged: dict[str, str] = {}             # the upper path of an unchanged block root is folded once
        proofs, roots, copies = [], [], []
        for leaf, changed, steps in zip(block.levels[0], table.column("changed").to_pylist(), block.steps):
            proofs.append(digest("".join(b + a for b, a in steps) + beyond))
            inside = copied_path(leaf if changed is None else changed, steps)
            top = inside[-1] if inside else leaf if changed is None else changed
            if changed is None:
                if top not in unchanged:
                    unchanged[top] = (copied_path(top, rest) or [top])[-1]
                roots.append(unchanged[top])
                copies.append(None)
            else:
                copies.append(inside + copied_path(top, rest))
                roots.append(copies[-1][-1] if copies[-1] else changed)
        n = len(table)
        return pa.table({"doc_id": table.column("doc_id"), "leaf": table.column("leaf"), "subroot": [subroot] * n, "root": [root] * n,
                         "proof_sha256": proofs, "folded_root": roots, "verified": pa.array([r == root for r in roots], pa.bool_()),
                         "copied": pa.array(copies, pa.list_(pa.string()))})

    left = manifest.leaves.groupBy("w_tree", _block(levels))
    upper = manifest.blocks.select("w_tree", F.col("pos").alias("w_block"), "steps", "subroot", "root")
    return left.cogroup(upper.groupBy("w_tree", "w_block")).applyInArrow(run, columns)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`versions` of all documents; where 3 divides the id's crc32, tampering lower-cases A-Z of the text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaves = leaves_of(docs, tampered, F.translate("text", UPPER, LOWER))
    return versions(build(leaves)).drop("copied")


def _oracle(tree_levels: int = 7, forest_levels: int = 2) -> str:
    def part(c):
        return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text):
        return "sha256(" + " || ".join([*[part(c) for c in FIELDS[:-1]], part(text)]) + ")"

    def level(name, i):
        run = f"PARTITION BY k, pos // {ARITY} ORDER BY pos"
        return f"""
{name}s{i} AS (SELECT k, pos, n, h, coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
          coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {name}{i}),
{name}{i + 1} AS (SELECT k, pos // {ARITY} AS pos, CAST(ceil(max(n) / {ARITY}.0) AS BIGINT) AS n,
          CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {name}{i} GROUP BY 1, 2)"""

    def climb(name, i, k, out, last):
        return f"""
{out} AS (SELECT p.* EXCLUDE (pos, f, proof), p.pos // {ARITY} AS pos, CASE WHEN s.n > 1 THEN sha256(s.b || p.f || s.a) ELSE p.f END AS f,
          p.proof || s.b || s.a AS proof FROM {last} p JOIN {name}s{i} s ON s.k = p.{k} AND s.pos = p.pos)"""

    # crc32 by bytes of the decimal text
    bits = "list_reduce(list_concat([xor(c, CAST(x AS BIGINT))], [0, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)"
    crc = ("xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))), "
           f"lambda c, x: {bits}), 4294967295)")
    steps = [f"""
base AS (SELECT doc_id, coalesce('.' || lang, '') AS k, {leaf('text')} AS h,
          CASE WHEN {crc} % 3 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {leaf('text')} END AS f FROM documents),
t0 AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY k) AS n FROM base)"""]
    steps += [level("t", i) for i in range(tree_levels)]
    steps.append(f"""
r0 AS (SELECT 0 AS k, k AS name, h, row_number() OVER (ORDER BY encode(k)) - 1 AS pos, count(*) OVER () AS n FROM t{tree_levels})""")
    steps += [level("r", i) for i in range(forest_levels)]
    steps.append("\np0 AS (SELECT doc_id, k, h AS leaf, pos, f, '' AS proof FROM t0)")
    steps += [climb("t", i, "k", f"p{i + 1}", f"p{i}") for i in range(tree_levels)]
    steps.append(f"""
q0 AS (SELECT p.* EXCLUDE (pos), 0 AS z, r.pos, r.h AS subroot FROM p{tree_levels} p JOIN r0 r ON r.name = p.k)""")
    steps += [climb("r", i, "z", f"q{i + 1}", f"q{i}") for i in range(forest_levels)]
    return ("WITH " + ",".join(steps) + f"""
SELECT q.doc_id, q.leaf, q.subroot, r.h AS root, sha256(q.proof) AS proof_sha256, q.f AS folded_root, q.f = r.h AS verified
FROM q{forest_levels} q, r{forest_levels} r""")


ORACLE_SQL = _oracle()
