"""Merkle manifest of a dataset by cogrouped subtree exchange.

Every row is a leaf, a SHA-256 of its framed columns.  Inside a source the leaves
ascend by key; runs of ``FAN`` nodes become their hash, level by level, until one
is left (the subroot); the subroots by source likewise give the root.

Flow: leaves are hashed by SQL functions and numbered inside their source
(``positions``).  ``FAN ** LEVELS`` consecutive nodes are a superblock.  Upwards, a
superblock is reduced by one ``applyInPandas`` group to its top node, and these are
the nodes of the next, far smaller stage.  Downwards, the nodes of a superblock are
cogrouped with the outer nodes that it needs, which is one row: the siblings on the
way from its top node to the root.  The group finishes its local reduction again,
joins local and outer siblings to the proof of each node, and folds.  Sources are
the leaves of one more tree of the same kind.

Scale: no group holds more than 256 nodes; a source with a third of all rows is
many superblocks.  Texts leave the scan as digests only.  The driver sees counts.

Defined results: null columns hash as ``-``; rows that repeat a key are leaves of
their own, ordered by leaf (equal rows are interchangeable); null keys come first
and are never tampered with; null sources are a source of their own, first; an
empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caprank.llm.common import documents, written
from caprank.llm.positions import numbered

FAN = 16
#: Tree levels that one superblock finishes.
LEVELS = 2
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def leaf_hash(values: list[Column]) -> Column:
    """SHA-256 of the columns, each ``-`` if null, else its UTF-8 byte count,
    ``:`` and its value."""
    framed = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
              for v in (c.cast("string") for c in values)]
    return F.sha2(F.concat(*framed).cast("binary"), 256)


def local_levels(nodes: list[str], total: int, levels: int = LEVELS, fan: int = FAN) -> list[list[str]]:
    """The nodes of a superblock and the levels above them, up to ``levels`` or
    until the whole tree of ``total`` nodes is one node."""
    out = [nodes]
    while len(out) <= levels and total > 1:
        below = out[-1]
        out.append([digest("".join(below[i:i + fan])) for i in range(0, len(below), fan)])
        total = -(-total // fan)
    return out


def local_siblings(levels: list[list[str]], at: int, fan: int = FAN) -> list[tuple[int, list[str]]]:
    """(place in the run, siblings) of a node at each level of its superblock."""
    out = []
    for nodes in levels[:-1]:
        lo = at // fan * fan
        run = nodes[lo:lo + fan]
        out.append((at - lo, run[:at - lo] + run[at - lo + 1:]))
        at //= fan
    return out


def write_path(steps: list[tuple[int, list[str]]]) -> str:
    """A proof as text: ``place:siblings`` for each level, joined by commas."""
    return ",".join(f"{at}:{''.join(sib)}" for at, sib in steps)


def read_path(path: str) -> list[tuple[int, list[str]]]:
    steps = []
    for step in path.split(",") if path else []:
        at, sib = step.split(":")
        steps.append((int(at), [sib[i:i + 64] for i in range(0, len(sib), 64)]))
    return steps


def fold(node: str, steps: list[tuple[int, list[str]]]) -> str:
    """Root that a node and its siblings give."""
    for at, sib in steps:
        node = digest("".join(sib[:at]) + node + "".join(sib[at:]))
    return node


def proof_digest(steps: list[tuple[int, list[str]]]) -> str:
    return digest("".join("".join(sib) for _, sib in steps))


def superblocks(nodes: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {fan ** levels}"))


def reduced(nodes: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """Next stage: the top node of each superblock of (tree, pos, total, node)."""

    def top(key, pdf):
        pdf = pdf.sort_values("pos")
        total = int(pdf["total"].iloc[0])
        done = local_levels(pdf["node"].tolist(), total, levels, fan)
        for _ in range(len(done) - 1):
            total = -(-total // fan)
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "total": [total], "node": [done[-1][0]]})

    return (superblocks(nodes.select("tree", "pos", "total", "node"), fan, levels).groupBy("tree", "block")
            .applyInPandas(top, "tree string, pos long, total long, node string"))


def stages(nodes: DataFrame, name: str, fan: int = FAN, levels: int = LEVELS) -> list[DataFrame]:
    """Nodes of each stage; in the last one every tree is a single node."""
    out = [nodes]
    while not out[-1].where("total > 1").isEmpty():
        out.append(written(reduced(out[-1], fan, levels), name))
    return out


def descended(nodes: DataFrame, outer: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """(tree, pos, path): proofs of a stage's nodes up to the root, from the
    proofs ``outer`` (tree, pos = superblock, path) of its top nodes."""

    def join(left, right):
        left = left.sort_values("pos")
        done = local_levels(left["node"].tolist(), int(left["total"].iloc[0]), levels, fan)
        above = read_path(right["path"].iloc[0])
        paths = [write_path(local_siblings(done, i, fan) + above) for i in range(len(left))]
        return pd.DataFrame({"tree": left["tree"].tolist(), "pos": left["pos"].tolist(), "path": paths})

    return (superblocks(nodes.select("tree", "pos", "total", "node"), fan, levels).groupBy("tree", "block")
            .cogroup(outer.select("tree", F.col("pos").alias("block"), "path").groupBy("tree", "block"))
            .applyInPandas(join, "tree string, pos long, path string"))


def manifest(docs: DataFrame, tampered: Column | None = None, changed: dict[str, Column] | None = None,
             columns: tuple[str, ...] = COLUMNS, key: str = "doc_id", source: str = "source", paths: bool = False,
             rows_per_part: int | None = None, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """key, source, leaf, subroot, root, proof_sha256, folded_root and verified of
    every row (and ``path``, the proof itself, if ``paths``).

    Where ``tampered`` holds, the fold starts from the leaf of the row with the
    columns ``changed`` instead of its own."""
    changed = changed or {}
    leaf = leaf_hash([F.col(c) for c in columns])
    found = F.when(tampered, leaf_hash([changed.get(c, F.col(c)) for c in columns])) if tampered is not None else F.lit(None)
    tree = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))  # null first, then by bytes
    leaves = written(docs.select(F.col(key).alias("key"), tree.alias("tree"), leaf.alias("node"),
                                 found.cast("string").alias("found")), "leaves")
    own = stages(written(numbered(leaves, ["tree"], ["key", "node"], rows_per_part), "numbered"), "nodes", fan, levels)
    subroots = own[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    top = stages(written(numbered(written(subroots, "subroots"), ["tree"], ["name"], rows_per_part), "sources"),
                 "top", fan, levels)

    proofs = top[-1].select("tree", "pos", F.lit("").alias("path"))
    for nodes in reversed(top[:-1]):
        proofs = written(descended(nodes, proofs, fan, levels), "proofs")
    root = top[-1].select("tree", F.col("node").alias("root"))  # one row
    whole = top[0].join(proofs, ["tree", "pos"]).join(F.broadcast(root), "tree")
    outer = written(whole.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "path",
                                 F.col("node").alias("subroot"), "root"), "outer")
    names = outer.select("tree", "subroot", "root")
    for nodes in reversed(own[1:-1]):
        outer = written(descended(nodes, outer, fan, levels), "proofs").join(names, "tree")

    def finish(left, right):
        left = left.sort_values("pos")
        leaf = left["node"].tolist()
        done = local_levels(leaf, int(left["total"].iloc[0]), levels, fan)
        above, subroot, root = read_path(right["path"].iloc[0]), right["subroot"].iloc[0], right["root"].iloc[0]
        steps = [local_siblings(done, i, fan) + above for i in range(len(left))]
        folded = [fold(b or a, s) for a, b, s in zip(leaf, left["found"].tolist(), steps, strict=True)]
        out = {"key": left["key"], "tree": left["tree"].tolist(), "leaf": leaf, "subroot": subroot, "root": root,
               "proof_sha256": [proof_digest(s) for s in steps], "folded_root": folded}
        if paths:
            out["path"] = [write_path(s) for s in steps]
        return pd.DataFrame(out)

    # a column of integers with nulls would reach Python as floats: keys travel as text
    keyed = own[0].withColumn("key", F.col("key").cast("string"))
    schema = ("key string, tree string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
              + (", path string" if paths else ""))
    if len(own) == 1:  # every source is one leaf: its proof is the outer one
        outer = outer.select("tree", "pos", "path", "subroot", "root")
    out = (superblocks(keyed, fan, levels).groupBy("tree", "block")
           .cogroup(outer.select("tree", F.col("pos").alias("block"), "path", "subroot", "root").groupBy("tree", "block"))
           .applyInPandas(finish, schema))
    return out.select(F.col("key").cast(docs.schema[key].dataType).alias(key),
                      F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias(source),
                      *[c for c in out.columns if c not in ("key", "tree")],
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the root folded after
    the texts of every fifth (by crc32 of the id) were lower-cased."""
    docs = documents(spark, sf_dir)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    made = manifest(docs, tampered, {"text": F.translate("text", UPPER, LOWER)})
    return made.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _oracle(levels: int = 8, top_levels: int = 4) -> str:
    """DuckDB SQL of the query: levels written out, ``16 ** levels`` rows a source."""
    frame = "COALESCE(strlen({0})::VARCHAR || ':' || {0}, '-')"
    leaf = "sha256(" + " || ".join(frame.format(f"{c}::VARCHAR") for c in COLUMNS) + ")"
    low = f"translate(text, '{UPPER}', '{LOWER}')"
    bad = "sha256(" + " || ".join(frame.format(low if c == "text" else f"{c}::VARCHAR") for c in COLUMNS) + ")"
    crc = ("xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT), lambda a, c: "
           "list_reduce([0::UBIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT)), "
           "xor(a, c)), 4294967295::UBIGINT), 4294967295::UBIGINT)")
    sql = f"""WITH d AS (SELECT doc_id, source, {leaf} AS leaf,
  CASE WHEN {crc} % 5 = 0 THEN {bad} ELSE {leaf} END AS found FROM documents),
n0 AS (SELECT doc_id, COALESCE('=' || source, '') AS tree, leaf, found, leaf AS node,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, COUNT(*) OVER (PARTITION BY source) AS total FROM d),
t0 AS (SELECT tree, pos, total, node FROM n0)"""

    def rise(p: str, n: int) -> str:
        out = ""
        for k in range(n):
            out += f""",
{p}r{k} AS (SELECT tree, pos // 16 AS run, total, list(node ORDER BY pos) AS nodes FROM {p}{k} GROUP BY ALL),
{p}{k + 1} AS (SELECT tree, run AS pos, CAST((total + 15) // 16 AS BIGINT) AS total,
  CASE WHEN total = 1 THEN nodes[1] ELSE sha256(array_to_string(nodes, '')) END AS node FROM {p}r{k})"""
        return out

    def climb(p: str, first: str, n: int, keep: str) -> str:
        out = f",\n{p}c0 AS ({first})"
        for k in range(n):
            o = f"(c.pos // {16 ** k} % 16)"
            out += f""",
{p}c{k + 1} AS (SELECT {keep}, c.tree, c.pos,
  CASE WHEN r.total = 1 THEN c.proof ELSE c.proof || array_to_string(r.nodes[:{o}] || r.nodes[{o} + 2:], '') END AS proof,
  CASE WHEN r.total = 1 THEN c.fold ELSE sha256(array_to_string(r.nodes[:{o}] || [c.fold] || r.nodes[{o} + 2:], '')) END AS fold
  FROM {p}c{k} c JOIN {p}r{k} r ON c.tree = r.tree AND r.run = c.pos // {16 ** (k + 1)})"""
        return out

    sql += rise("t", levels)
    sql += f""",
s AS (SELECT tree AS name, node, row_number() OVER (ORDER BY tree) - 1 AS pos, COUNT(*) OVER () AS total FROM t{levels}),
s0 AS (SELECT '' AS tree, pos, total, node FROM s)"""
    sql += rise("s", top_levels)
    sql += climb("t", "SELECT doc_id, leaf, tree, pos, '' AS proof, found AS fold FROM n0", levels, "c.doc_id, c.leaf")
    sql += climb("s", f"""SELECT c.doc_id, c.leaf, s.node AS subroot, '' AS tree, s.pos, c.proof, c.fold
  FROM tc{levels} c JOIN s ON s.name = c.tree""", top_levels, "c.doc_id, c.leaf, c.subroot")
    return sql + f"""
SELECT c.doc_id, c.leaf, c.subroot, r.node AS root, sha256(c.proof) AS proof_sha256, c.fold AS folded_root, c.fold = r.node AS verified
FROM sc{top_levels} c CROSS JOIN s{top_levels} r"""


ORACLE_SQL = _oracle()
