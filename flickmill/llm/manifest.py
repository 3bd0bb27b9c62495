"""Merkle manifest of a document table, and proofs that documents belong to it.

Every row is a leaf; the leaves of a source, by doc_id, form a tree whose runs of
three become their parent; the sources' roots, by source, form the tree above.

Proofs are octopus multiproofs: a partition of wanted leaves works out which node
coordinates it lacks (siblings of its paths that its own leaves do not give),
fetches that union once, derives the interior nodes its leaves share, and expands
each leaf's own proof from them.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flickmill.llm.scratch import written

#: Children of a node, levels that one grouping raises (a group holds FAN ** SPAN nodes at most), leaves of a
#: partition that proves together, and nodes near the roots that are broadcast at most (about 100 bytes each).
FAN, SPAN, PARTITION, UPPER = 3, 6, 19_683, 100_000

#: Tree number of the tree above the sources; a source's tree has the source's rank.
TOP = -1


class Manifest(NamedTuple):
    """``leaves``: doc_id, source, tree, idx (place in the source's tree), n (its leaves), at (place in the table's order),
    leaf, claim. ``nodes``: tree, level, idx, remaining (nodes of that level), digest. ``sources``: how many trees."""
    leaves: DataFrame
    nodes: DataFrame
    sources: int


def encoded(value: Column) -> Column:
    """A value as hashed: ``-`` if null, else its UTF-8 byte count, a colon and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def placed(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """The frame, written, with ``part`` and ``at``: the row's place in the whole table's order, from 0.

    Rows are dealt by range, so no task holds more than its share whatever key is common (rows equal in all of ``order``
    are told apart by their place in the scan). Only the parts' counts, one row for each, meet in one task.
    """
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = written(ranged.drop("_tie").withColumns({"part": F.spark_partition_id(), "_row": place}), name)
    counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("part", before.alias("_start"))
    # one row for each part: as many as the shuffle has partitions
    return rows.join(F.broadcast(starts), "part").withColumn("at", F.col("_start") + F.col("_row")).drop("_start", "_row")


def raised(level_nodes: DataFrame, level: int) -> DataFrame:
    """The nodes of the SPAN levels above (tree, idx, n, digest), n being the tree's nodes at ``level``; a tree ends
    where one node remains. Runs never cross a group, as its first idx is a multiple of FAN ** SPAN."""
    size = FAN ** SPAN
    group = level_nodes.groupBy("tree", "n", F.expr(f"idx div {size}").alias("block")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"]).alias("l0"))
    group = group.withColumn("c0", F.col("n"))
    for i in range(SPAN):
        runs = F.expr(f"transform(sequence(0, (size(l{i}) + {FAN - 1}) div {FAN} - 1), j -> sha2(array_join(slice(l{i}, cast(j as int) * {FAN} + 1, {FAN}), ''), 256))")
        group = group.withColumns({f"c{i + 1}": F.expr(f"(c{i} + {FAN - 1}) div {FAN}"),
                                   f"l{i + 1}": F.when(F.col(f"c{i}") > 1, runs).otherwise(F.array().cast("array<string>"))})
    levels = F.array(*[F.struct(F.lit(i).alias("up"), F.col(f"c{i}").alias("remaining"), F.col(f"l{i}").alias("digests")) for i in range(1, SPAN + 1)])
    made = group.select("tree", "block", F.explode(levels).alias("l")).select("tree", "block", "l.up", "l.remaining", F.posexplode("l.digests").alias("pos", "digest"))
    first = F.col("block") * F.pow(F.lit(FAN), F.lit(SPAN) - F.col("up")).cast("long")
    return made.select("tree", (F.col("up") + level).cast("int").alias("level"), (first + F.col("pos")).alias("idx"), "remaining", "digest")


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def grown(leaves: DataFrame, most: int, name: str) -> DataFrame:
    """All nodes of the trees over (tree, idx, n, digest); ``most`` is the largest n. Each round of SPAN levels is written."""
    nodes = leaves.select("tree", F.lit(0).alias("level"), "idx", F.col("n").alias("remaining"), "digest")
    current = leaves.select("tree", "idx", "n", "digest")
    for level in range(0, height(most), SPAN):
        made = written(raised(current.where("n > 1"), level), f"{name}_{level}")
        nodes = nodes.unionByName(made)
        current = made.where(F.col("level") == level + SPAN).select("tree", "idx", F.col("remaining").alias("n"), "digest")
    return nodes


def manifest(docs: DataFrame, claim: Column | None = None) -> Manifest:
    """The manifest of a document table. ``claim`` is a digest to be checked in place of a row's own (null: its own).

    Only digests are shuffled, never texts. Repeated rows are leaves of their own, in any order, as they are equal; null
    doc_ids come first, null sources form the first tree, null fields are hashed as ``-``. Other columns are not read.
    """
    leaf = digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    made = written(docs.select("doc_id", "source", leaf.alias("leaf"), (F.lit(None).cast("string") if claim is None else claim).alias("claim")), "leaves")
    rows = placed(made, ["source", "doc_id", "leaf"], "leaves_in_order")
    held = rows.groupBy("part", "source").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    each = held.groupBy("source").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    trees = placed(each, ["first"], "trees").select(F.col("source").alias("s"), "n", "first", F.col("at").alias("tree"))
    # (part, source) keys: a common source is split among its parts
    shape = held.select("part", "source").join(trees, F.col("source").eqNullSafe(F.col("s"))).select(F.col("part").alias("p"), "s", "n", "first", "tree")
    leaves = rows.join(shape, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    leaves = written(leaves.select("doc_id", "source", "tree", (F.col("at") - F.col("first")).alias("idx"), "n", "at", "leaf", "claim"), "placed_leaves")
    sources, most = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    nodes = grown(leaves.select("tree", "idx", "n", F.col("leaf").alias("digest")), most, "nodes")
    subroots = nodes.where("remaining = 1").select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(sources).cast("long").alias("n"), "digest")
    return Manifest(leaves, nodes.unionByName(grown(subroots, sources, "top_nodes")), sources)


def paths(tree: int, indices: set[int], n: int) -> list[tuple[int, set[int], set[int]]]:
    """From the leaves ``indices`` of a tree up: (level, nodes that they give, siblings that they do not give)."""
    out, level = [], 0
    while n > 1:
        runs = {i // FAN for i in indices}
        out.append((level, indices, {i for r in runs for i in range(r * FAN, min(n, r * FAN + FAN)) if i not in indices}))
        indices, n, level = runs, -(-n // FAN), level + 1
    return out


def wanted_trees(table: pa.Table) -> dict[int, tuple[int, set[int]]]:
    """Of a partition's leaves: tree -> (its leaves, those wanted here)."""
    out: dict[int, tuple[int, set[int]]] = {}
    for tree, idx, n in zip(*(table.column(c).to_pylist() for c in ("tree", "idx", "n"))):
        out.setdefault(tree, (n, set()))[1].add(idx)
    return out


def missing(table: pa.Table, sources: int) -> list[tuple[int, int, int]]:
    """The least set of (tree, level, idx) that a partition of leaves needs from elsewhere."""
    trees = wanted_trees(table)
    return [(tree, level, i) for tree, (n, indices) in [*trees.items(), (TOP, (sources, set(trees)))]
            for level, _, lacking in paths(tree, indices, n) for i in sorted(lacking)]


def h(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def expanded(table: pa.Table, fetched: dict[tuple[int, int, int], str], sources: int) -> dict[str, list]:
    """Each leaf's subroot, root, siblings and the root folded from its claim, of a partition and what it fetched."""
    columns = {c: table.column(c).to_pylist() for c in ("tree", "idx", "n", "leaf", "claim")}
    known = dict(fetched)
    known.update({(t, 0, i): d for t, i, d in zip(columns["tree"], columns["idx"], columns["leaf"])})
    trees = wanted_trees(table)

    def derive(tree: int, indices: set[int], n: int) -> str:
        count, level = n, 0
        while count > 1:
            runs = {i // FAN for i in indices}
            for r in runs:
                known[tree, level + 1, r] = h(*[known[tree, level, i] for i in range(r * FAN, min(count, r * FAN + FAN))])
            indices, count, level = runs, -(-count // FAN), level + 1
        return known[tree, level, 0]

    subroots = {tree: derive(tree, indices, n) for tree, (n, indices) in trees.items()}
    known.update({(TOP, 0, tree): d for tree, d in subroots.items()})
    root = derive(TOP, set(trees), sources)

    def climb(tree: int, idx: int, n: int, value: str, siblings: list[str]) -> str:
        level = 0
        while n > 1:
            a = idx - idx % FAN
            run = [known[tree, level, i] if i != idx else None for i in range(a, min(n, a + FAN))]
            siblings += [d for d in run if d is not None]
            value = h(*[value if d is None else d for d in run])
            idx, n, level = idx // FAN, -(-n // FAN), level + 1
        return value

    out: dict[str, list] = {"subroot": [], "root": [], "siblings": [], "folded_root": []}
    for tree, idx, n, leaf, claim in zip(*columns.values()):
        siblings: list[str] = []
        sub = climb(tree, idx, n, leaf if claim is None else claim, siblings)
        for name, value in (("subroot", subroots[tree]), ("root", root), ("folded_root", climb(TOP, tree, sources, sub, siblings)), ("siblings", siblings)):
            out[name].append(value)
    return out


def proofs(made: Manifest, wanted: Column | None = None) -> DataFrame:
    """One row for each wanted leaf (a condition on doc_id and source; all by default): doc_id, source, tree, idx, n, leaf,
    subroot, root, siblings (level by level up to the root, left to right), folded_root, verified.

    A partition is PARTITION consecutive leaves at most, of one or more sources, so a common source has many. What all
    partitions ask for stands near the roots: the top UPPER nodes are broadcast (counted before), the rest are joined.
    """
    sources = made.sources
    leaves = (made.leaves if wanted is None else made.leaves.where(wanted)).withColumn("part", F.expr(f"at div {PARTITION}"))

    def ask(table: pa.Table) -> pa.Table:
        need = missing(table, sources)
        kinds = {"tree": pa.int64(), "level": pa.int32(), "idx": pa.int64()}
        part = pa.array([table.column("part")[0].as_py()] * len(need), pa.int64())
        return pa.table({"part": part} | {c: pa.array(list(v), k) for (c, k), v in zip(kinds.items(), zip(*need) if need else [[]] * 3)})

    asked = leaves.select("part", "tree", "idx", "n").groupBy("part").applyInArrow(ask, "part long, tree long, level int, idx long")
    rank = F.when(F.col("tree") == TOP, F.col("level") + 1000).otherwise(F.col("level"))
    total, cut = 0, 10_000
    for r in made.nodes.groupBy(rank.alias("rank")).count().orderBy(F.desc("rank")).collect():  # a row for each level
        total += r["count"]
        if total > UPPER:
            break
        cut = r["rank"]
    nodes = made.nodes.select("tree", "level", "idx", "digest")
    near = asked.where(rank >= cut).join(F.broadcast(nodes.where(rank >= cut)), ["tree", "level", "idx"])
    found = near.unionByName(asked.where(rank < cut).join(nodes.where(rank < cut), ["tree", "level", "idx"]))
    kept = ["doc_id", "source", "tree", "idx", "n", "leaf"]
    schema = leaves.select(*kept).schema.simpleString()[len("struct<"):-1].replace(":", " ")

    def expand(table: pa.Table, got: pa.Table) -> pa.Table:
        columns = [got.column(c).to_pylist() for c in ("tree", "level", "idx", "digest")]
        out = expanded(table, {(t, lv, i): d for t, lv, i, d in zip(*columns)}, sources)
        return pa.table({c: table.column(c) for c in kept} | {c: pa.array(v, pa.list_(pa.string()) if c == "siblings" else pa.string()) for c, v in out.items()})

    rows = leaves.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(expand, f"{schema}, subroot string, root string, siblings array<string>, folded_root string")
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def digests(docs: DataFrame) -> DataFrame:
    """Proofs of all rows, with the line breaks deleted from the texts of every second doc_id (by its CRC-32; nulls stay)
    before they are checked: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. Empty in, empty out."""
    changed = F.col("text").contains("\n") & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)
    bare = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    claim = F.when(changed, digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), bare))
    out = proofs(manifest(docs, claim))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"), "folded_root", "verified")


#: CRC-32 of an id's decimal digits in DuckDB, one reduction step for each bit (a byte comes in with its first).
CRC32 = """xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(
  string_split(CAST({id} AS VARCHAR), ''), lambda ch: [ord(ch)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, b: xor(xor(a, b) >> 1, 3988292384::UBIGINT * (xor(a, b) & 1::UBIGINT))))"""

ENCODED = "CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen(CAST({c} AS VARCHAR)), ':', {c}) END"


def _leaf_sql(text: str) -> str:
    return "sha256(concat(" + ", ".join(ENCODED.format(c=c) for c in ("doc_id", "source", "lang", "n_chars", text)) + "))"


#: The DuckDB twin of ``digests``.
SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
    CASE WHEN {CRC32.format(id="doc_id")} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS claim
  FROM documents),
trees AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER () AS sources
  FROM (SELECT DISTINCT source FROM documents)),
placed AS (SELECT l.*, tree, sources, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves l JOIN trees t ON l.source IS NOT DISTINCT FROM t.source),
low AS (
  SELECT tree, 0 AS lvl, idx, n, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM low WHERE n > 1 GROUP BY tree, lvl, idx // 3, n),
top AS (
  SELECT 0 AS lvl, tree AS idx, (SELECT count(*) FROM trees) AS n, digest FROM low WHERE n = 1
  UNION ALL
  SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lvl, idx // 3, n),
low_runs AS (SELECT tree, lvl, idx // 3 AS run, list(digest ORDER BY idx) AS run_digests FROM low WHERE n > 1 GROUP BY ALL),
top_runs AS (SELECT lvl, idx // 3 AS run, list(digest ORDER BY idx) AS run_digests FROM top WHERE n > 1 GROUP BY ALL),
low_walk AS (
  SELECT row_number() OVER () AS k, doc_id, leaf, tree, 0 AS lvl, idx, n, claim AS folded, '' AS siblings FROM placed
  UNION ALL
  SELECT k, doc_id, leaf, w.tree, w.lvl + 1, w.idx // 3, (n + 2) // 3,
    sha256(concat(array_to_string(list_slice(run_digests, 1, w.idx % 3), ''), folded, array_to_string(list_slice(run_digests, w.idx % 3 + 2, 3), ''))),
    concat(siblings, array_to_string(list_slice(run_digests, 1, w.idx % 3), ''), array_to_string(list_slice(run_digests, w.idx % 3 + 2, 3), ''))
  FROM low_walk w JOIN low_runs r ON r.tree = w.tree AND r.lvl = w.lvl AND r.run = w.idx // 3 WHERE n > 1),
top_walk AS (
  SELECT k, doc_id, leaf, tree, 0 AS lvl, tree AS idx, (SELECT count(*) FROM trees) AS n, folded, siblings FROM low_walk WHERE n = 1
  UNION ALL
  SELECT k, doc_id, leaf, w.tree, w.lvl + 1, w.idx // 3, (n + 2) // 3,
    sha256(concat(array_to_string(list_slice(run_digests, 1, w.idx % 3), ''), folded, array_to_string(list_slice(run_digests, w.idx % 3 + 2, 3), ''))),
    concat(siblings, array_to_string(list_slice(run_digests, 1, w.idx % 3), ''), array_to_string(list_slice(run_digests, w.idx % 3 + 2, 3), ''))
  FROM top_walk w JOIN top_runs r ON r.lvl = w.lvl AND r.run = w.idx // 3 WHERE n > 1)
SELECT w.doc_id, w.leaf, s.digest AS subroot, root.digest AS root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = root.digest AS verified
FROM top_walk w JOIN low s ON s.tree = w.tree AND s.n = 1, (SELECT digest FROM top WHERE n = 1) root WHERE w.n = 1
"""
