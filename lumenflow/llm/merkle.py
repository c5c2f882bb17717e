"""Merkle manifest of a data set: one tree for each source, and one over the roots of these.

A parent is kept as its preimage, the concatenated digests of its children. A leaf's proof is
the list of its ancestors' preimages with its own 64-character slot in each: the slots cut out
give the siblings, and a digest put in their place, level by level, gives the root again.

Leaves are put in order by a range sort over all tasks, so a source with most of the rows is
spread like any other: places within a source are those within a task plus the sizes of the
tasks before. ``STRIDE`` levels are made in one step from blocks of ``ARITY ** STRIDE`` nodes,
each a row of its own, and every step is written to the shared folder. On the way down blocks
take the path of the block above, then leaves join the block that they are in; no task holds
more than a block and its path.

Defined cases: a null field is ``-``; a null source is a tree of its own, the first one; rows of
one source and doc_id (null first) are ordered by their digests, so repeated rows have places
next to each other and a proof each; an empty table gives no rows and has no root; texts of any
length are read once, as a whole; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.llm._common import partitions_for, store

ARITY, STRIDE = 3, 4
BLOCK = ARITY**STRIDE
#: Length of a digest in an ancestor's preimage.
SLOT = 64
RESERVED = frozenset(("k", "n", "at", "task", "shift", "same", "up", "up_preimages", "up_path", "subroot", "path"))
_STEP = "struct<preimage:string,slot:int>"
#: What one task counts up to in monotonically_increasing_id.
_TASK_BITS = 33


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value: joined values can be read in one way only."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*(encoded(v) for v in values)), 256)


def siblings(path: Column) -> Column:
    """The digests beside the path, from the leaf up and from left to right, as one text."""
    return F.array_join(F.transform(path, lambda x: F.overlay(x["preimage"], F.lit(""), x["slot"] * SLOT + 1, F.lit(SLOT))), "")


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf leads to along a path: its digest replaces its slot, the result that of the parent, and so on."""
    return F.aggregate(path, leaf, lambda digest, x: F.sha2(F.overlay(x["preimage"], digest, x["slot"] * SLOT + 1, F.lit(SLOT)), 256))


@dataclass
class Manifest:
    """``leaves``: tree, k (place), n (size of the tree), leaf, and the columns that were given with them. ``rounds``: blocks of
    the source trees from the bottom up (tree, block, n, preimages, digest); ``top``: those of the tree of roots. ``root``: None
    for an empty table."""

    leaves: DataFrame
    rounds: list[DataFrame]
    top: list[DataFrame]
    root: str | None


def _ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds k, a row's place in its tree, and n, the size of the tree."""
    keys = [F.col("tree"), *(F.col(c).asc_nulls_first() for c in order)]
    sorted_rows = nodes.repartitionByRange(partitions_for(nodes), *keys).sortWithinPartitions(*keys)
    placed = store(sorted_rows.withColumn("at", F.monotonically_increasing_id())).withColumn("task", F.shiftright("at", _TASK_BITS))
    tasks = placed.groupBy("tree", "task").agg(F.count("*").alias("m"), F.min("at").alias("first"))
    whole = Window.partitionBy("tree")
    before = F.sum("m").over(whole.orderBy("task").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("m")
    tasks = tasks.select("tree", "task", (before - F.col("first")).alias("shift"), F.sum("m").over(whole).alias("n"))
    return placed.join(tasks, ["tree", "task"]).withColumn("k", F.col("at") + F.col("shift")).drop("at", "task", "shift")


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, k, n, digest) to blocks: their preimages by level, the digest of the last level and its number of nodes."""
    child = F.struct("k", "digest")
    rows = nodes.groupBy("tree", F.expr(f"k div {BLOCK}").alias("block")).agg(F.sort_array(F.collect_list(child))["digest"].alias("h0"), F.max("n").alias("n"))
    levels = F.lit(STRIDE)
    for e in reversed(range(STRIDE)):
        levels = F.when(F.col("n") <= ARITY**e, e).otherwise(levels)
    rows = rows.withColumn("levels", levels)
    for e in range(1, STRIDE + 1):
        rows = rows.withColumn(f"p{e}", F.expr(f"transform(sequence(0, (size(h{e - 1}) - 1) div {ARITY}), i -> array_join(slice(h{e - 1}, cast({ARITY} * i + 1 as int), {ARITY}), ''))"))
        rows = rows.withColumn(f"h{e}", F.expr(f"transform(p{e}, p -> sha2(p, 256))"))
    powers = ", ".join(str(ARITY**e) for e in range(STRIDE + 1))
    preimages = F.slice(F.array(*(f"p{e}" for e in range(1, STRIDE + 1))), F.lit(1), F.col("levels"))
    digest = F.get(F.get(F.array(*(f"h{e}" for e in range(STRIDE + 1))), F.col("levels")), F.lit(0))
    return rows.select("tree", "block", F.expr(f"(n - 1) div array({powers})[levels] + 1").alias("n"), preimages.alias("preimages"), digest.alias("digest"))


def _grow(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of all trees, step by step, until each has one node left."""
    rounds = [store(_blocks(nodes))]
    while not (more := rounds[-1].where("n > 1")).isEmpty():
        rounds.append(store(_blocks(more.select("tree", F.col("block").alias("k"), "n", "digest"))))
    return rounds


def _roots(rounds: list[DataFrame]) -> DataFrame:
    """tree, digest: every tree ends in one block of one round."""
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionAll(r)
    return out.where("n = 1").select("tree", "digest")


def _steps(place: str, preimages: str) -> Column:
    """The preimage and the slot at each level of a block for the node at a place of it."""
    powers = ", ".join(str(ARITY**e) for e in range(STRIDE + 1))
    return F.expr(f"transform({preimages}, (p, j) -> named_struct('preimage', p[cast({place} div array({powers})[j + 1] as int)], 'slot', cast({place} div array({powers})[j] % {ARITY} as int)))").cast(f"array<{_STEP}>")


def _descend(nodes: DataFrame, rounds: list[DataFrame], ends: DataFrame) -> DataFrame:
    """Nodes with their path: through their blocks upwards, then that of their tree's end. ``ends``: tree, subroot, path."""
    above = rounds[-1].join(ends, "tree")
    for blocks in reversed(rounds[:-1]):
        above = _through(blocks.where("n > 1"), "block", above).unionByName(blocks.where("n = 1").join(ends, "tree"))
    return _through(nodes, "k", above)


def _through(nodes: DataFrame, place: str, above: DataFrame) -> DataFrame:
    """Nodes join the block that they are in, and get its preimages and its path."""
    up = above.select("tree", F.col("block").alias("up"), F.col("preimages").alias("up_preimages"), "subroot", F.col("path").alias("up_path"))
    joined = nodes.withColumn("up", F.expr(f"{place} div {BLOCK}")).join(up, ["tree", "up"])
    return joined.withColumn("path", F.concat(_steps(f"({place} % {BLOCK})", "up_preimages"), "up_path")).drop("up", "up_preimages", "up_path")


def manifest(leaves: DataFrame, order: list[str]) -> Manifest:
    """The trees over ``leaves``: tree (text, never null; trees are ordered by it), leaf (digest) and other columns, whose names
    can't be those of ``RESERVED``. Leaves of a tree are put in order by the columns ``order``, nulls first, then by their digest."""
    if taken := RESERVED & {c.lower() for c in leaves.columns}:
        raise ValueError(f"columns of leaves can't be named {sorted(taken)}")
    flat = store(leaves.withColumn("same", F.monotonically_increasing_id()))  # written before it is sorted, as the sort looks at it twice
    ranked = _ranked(flat, [*order, "leaf", "same"]).drop("same")
    rounds = _grow(ranked.select("tree", "k", "n", F.col("leaf").alias("digest")))
    roots = _ranked(_roots(rounds).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"])
    top = _grow(roots.select("tree", "k", "n", "digest"))
    end = _roots(top).first()
    return Manifest(ranked, rounds, top, end["digest"] if end else None)


def proofs(made: Manifest) -> DataFrame:
    """The leaves with subroot and path: an array of (preimage, slot) from the leaf up to the root."""
    spark = made.leaves.sparkSession
    nothing = F.array().cast(f"array<{_STEP}>")
    roots = _ranked(_roots(made.rounds).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("digest").alias("subroot_")), ["name"])
    over = _descend(roots, made.top, spark.range(1).select(F.lit("").alias("tree"), F.lit("").alias("subroot"), nothing.alias("path")))
    ends = over.select(F.col("name").alias("tree"), F.col("subroot_").alias("subroot"), "path")
    return _descend(made.leaves, made.rounds, ends)


def report(docs: DataFrame, changed: Column) -> DataFrame:
    """Each document's proof, and the root that its leaf leads to with the text ``changed``: doc_id, leaf, subroot, root, path,
    folded_root, verified."""
    made = documents_manifest(docs, changed)
    root = F.lit(made.root).cast("string")
    out = proofs(made).select("doc_id", "leaf", "subroot", root.alias("root"), "path", fold(F.col("path"), F.col("changed")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def documents_manifest(docs: DataFrame, text: Column | None = None) -> Manifest:
    """The manifest of a documents table, one tree for each source, leaves ascending by doc_id. ``changed`` is the digest
    that a leaf has with another ``text`` in place of its own."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tree = F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0"))
    own = F.col("text")
    changed = leaf_hash(*fields, own if text is None else text)
    return manifest(docs.select(tree.alias("tree"), "doc_id", leaf_hash(*fields, own).alias("leaf"), changed.alias("changed")), ["doc_id"])


_LEAF = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars"))
_CRC = "list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda x, y: CASE WHEN y = -1 THEN xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END) ELSE xor(x, y) END)"


def _grown(name: str, base: str) -> str:
    """A recursive table of all nodes: t, lev, k, h, pre (preimage), n."""
    return f"""{name} AS (SELECT t, 0 AS lev, k, h, CAST(NULL AS VARCHAR) AS pre, n FROM {base}
  UNION ALL SELECT t, lev + 1, k // 3, sha256(string_agg(h, '' ORDER BY k)), string_agg(h, '' ORDER BY k), any_value((n + 2) // 3) FROM {name} WHERE n > 1 GROUP BY t, lev, k // 3)"""


#: The tables in DuckDB's SQL; a node's ancestors are found level by level in a second recursion.
SQL = f"""WITH RECURSIVE raw AS (SELECT doc_id, source, {_LEAF} AS head, text, replace(text, chr(10), '') AS bare, (xor({_CRC}, 4294967295) & 1) = 0 AS hit FROM documents),
leafs AS (SELECT doc_id, coalesce('1' || source, '0') AS t, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  sha256(head || CASE WHEN hit THEN coalesce(strlen(bare) || ':' || bare, '-') ELSE coalesce(strlen(text) || ':' || text, '-') END) AS changed FROM raw),
base AS (SELECT doc_id, t, leaf, changed, leaf AS h, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, count(*) OVER (PARTITION BY t) AS n FROM leafs),
{_grown("tree", "base")},
roots AS (SELECT '' AS t, t AS name, h, row_number() OVER (ORDER BY t) - 1 AS k, count(*) OVER () AS n FROM tree WHERE n = 1),
{_grown("top", "roots")},
-- the top tree's nodes follow on those of a leaf's own tree
climb AS (SELECT doc_id, base.t AS own, base.t, k, 0 AS lev, n, leaf, k AS place, changed AS f, '' AS sib FROM base
  UNION ALL SELECT c.doc_id, c.own, c.t, c.k // 3, c.lev + 1, p.n, c.leaf, c.place,
    sha256(substr(p.pre, 1, 64 * (c.k % 3)) || c.f || substr(p.pre, 64 * (c.k % 3) + 65)), c.sib || substr(p.pre, 1, 64 * (c.k % 3)) || substr(p.pre, 64 * (c.k % 3) + 65)
  FROM climb c JOIN tree p ON p.t = c.t AND p.lev = c.lev + 1 AND p.k = c.k // 3),
over AS (SELECT c.doc_id, c.own, c.leaf, c.place, r.h AS subroot, r.k, 0 AS lev, c.f, c.sib, r.n FROM climb c JOIN roots r ON r.name = c.own WHERE c.n = 1
  UNION ALL SELECT c.doc_id, c.own, c.leaf, c.place, c.subroot, c.k // 3, c.lev + 1,
    sha256(substr(p.pre, 1, 64 * (c.k % 3)) || c.f || substr(p.pre, 64 * (c.k % 3) + 65)), c.sib || substr(p.pre, 1, 64 * (c.k % 3)) || substr(p.pre, 64 * (c.k % 3) + 65), p.n
  FROM over c JOIN top p ON p.lev = c.lev + 1 AND p.k = c.k // 3)
SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(sib) AS proof_sha256, f AS folded_root, f = (SELECT h FROM top WHERE n = 1) AS verified FROM over WHERE n = 1"""
