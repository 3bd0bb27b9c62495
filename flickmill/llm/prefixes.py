"""Prefix trie of conversations: which beginnings of turns they share.

A turn is its role and text; the first d turns of a conversation are a node of
depth d. Turns stand in positional columns, and one Spark SQL ROLLUP over them,
told apart by grouping_id, aggregates the prefixes of all lengths together. A
conversation longer than the columns goes on in further column blocks, keyed by
the node that its block before ended in, so any length takes the same two jobs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flickmill.llm.scratch import written

#: Positional columns of a block.
WIDTH = 8
#: Conversation ids that are joined to one text before those of a node meet: those that agree but for their last bits.
ID_BITS = 8
#: Nodes that are broadcast at most (32 bytes each); the share of all conversations that makes a node one of these.
HEAVY, SHARE = 50_000, 500

KEY = ["depth", "p1", "p2"]
COLUMNS = [f"t{i}" for i in range(1, WIDTH + 1)]


def lanes(pos: Column, turn: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a turn at its place; a node's path is the XOR of those of its turns."""
    return F.xxhash64(F.lit(1), pos.cast("long"), turn), F.xxhash64(F.lit(2), pos.cast("long"), turn)


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), h (half of the SHA-256 of role and text), bytes (of the text's UTF-8), by turn, null first,
    then role, then hash. Null role or text counts as empty; rows without a conv_id are in no conversation.

    Only hashes are shuffled. A conversation's rows are numbered by a window over sorted rows, which spills."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    full = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), F.substring(full, 1, 32).alias("h"), F.octet_length(text).cast("long").alias("bytes"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "h")) - 1
    return rows.select("conv_id", place.cast("long").alias("pos"), "h", "bytes")


def spliced(rows: DataFrame, ids: DataFrame, group: int = 5, lead: int = 9) -> DataFrame:
    """Each conversation c with its first k turns replaced by those of conversation c - c % ``group`` (all if that has
    fewer, none if it is not there), k being the CRC-32 of c's digits modulo ``lead``."""
    k = F.crc32(F.col("conv_id").cast("string").cast("binary")) % lead
    cut = ids.select("conv_id", k.alias("k"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    own = rows.join(cut.select("conv_id", "k"), "conv_id").where("pos >= k").drop("k")
    first = rows.where(F.col("pos") < lead - 1).withColumnRenamed("conv_id", "base")
    taken = first.join(cut, "base").where("pos < k").select("conv_id", "pos", "h", "bytes")
    both = own.unionByName(taken)  # what stands behind a shorter beginning moves up
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("pos")) - 1
    return both.select("conv_id", place.cast("long").alias("pos"), "h", "bytes")


def blocks_and_ends(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row for each conversation and block (conv_id, n turns in all, block, the path p1, p2 and the bytes before it, turns
    t1 to tWIDTH, null behind the end), and for each conversation the node it ends in (conv_id, depth, p1, p2)."""
    by = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    a, b = lanes(F.col("pos"), F.col("h"))
    walk = rows.withColumns({"a": a, "b": b}).withColumns({
        "p1": F.expr("bit_xor(a)").over(by), "p2": F.expr("bit_xor(b)").over(by), "up_to": F.sum("bytes").over(by),
        "n": F.count(F.lit(1)).over(Window.partitionBy("conv_id"))})
    walk = walk.withColumns({"block": F.expr(f"pos div {WIDTH}"), "j": F.col("pos") % WIDTH})
    first = F.col("j") == 0
    # grouped as the window is dealt: no other shuffle
    wide = walk.groupBy("conv_id", "n", "block").agg(
        F.max(F.when(first, F.col("p1").bitwiseXOR(F.col("a")))).alias("p1"), F.max(F.when(first, F.col("p2").bitwiseXOR(F.col("b")))).alias("p2"),
        F.max(F.when(first, F.col("up_to") - F.col("bytes"))).alias("before"), F.max(F.when(F.col("pos") == F.col("n") - 1, F.struct("p1", "p2"))).alias("last"),
        *[F.max(F.when(F.col("j") == i, F.struct("h", "bytes"))).alias(c) for i, c in enumerate(COLUMNS)])
    zero = F.lit(0).cast("long")
    none = ids.join(rows.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", *[zero.alias(c) for c in ("n", "block", "p1", "p2", "before")], F.struct(zero.alias("p1"), zero.alias("p2")).alias("last"),
        *[F.lit(None).cast("struct<h:string,bytes:bigint>").alias(c) for c in COLUMNS])
    made = written(wide.unionByName(none), "conversation_blocks")
    return made.drop("last"), made.where("last is not null").select("conv_id", F.col("n").alias("depth"), "last.p1", "last.p2")


def rolled(blocks: DataFrame, aggregates: str) -> DataFrame:
    """A row for each node: depth, block, p1, p2 and before of its block's beginning, t1 to tWIDTH (null from its end on),
    level (its turns in the block) and the aggregates over its members."""
    sql = f"""SELECT block, p1, p2, before, {', '.join(COLUMNS)}, {WIDTH} - bit_count(grouping_id()) AS level, {aggregates}
        FROM {{blocks}} GROUP BY block, p1, p2, before, ROLLUP ({', '.join(COLUMNS)})"""
    out = blocks.sparkSession.sql(sql, blocks=blocks).withColumn("depth", F.col("block") * WIDTH + F.col("level"))
    here = F.get(F.array(*COLUMNS), F.col("level") - 1)
    # a group whose last column is null holds conversations that ended before; a later block's beginning is a node of the block before
    return out.where(here.isNotNull() | ((F.col("level") == 0) & (F.col("block") == 0)))


def with_paths(nodes: DataFrame) -> DataFrame:
    """p1 and p2 of the node itself, q1 and q2 of its parent, and the bytes of all turns but its last (parent_bytes)."""
    out = {}
    for name, at, lane in (("p1", "level", 0), ("p2", "level", 1), ("q1", "level - 1", 0), ("q2", "level - 1", 1)):
        path = F.col(f"p{lane + 1}")
        for i, c in enumerate(COLUMNS):
            turn = lanes(F.col("block") * WIDTH + i, F.col(f"{c}.h"))[lane]
            path = path.bitwiseXOR(F.when(F.expr(at) > i, turn).otherwise(F.lit(0).cast("long")))
        out[name] = path
    less = F.col("before")
    for i, c in enumerate(COLUMNS):
        less = less + F.when(F.col("level") - 1 > i, F.col(f"{c}.bytes")).otherwise(F.lit(0).cast("long"))
    return nodes.withColumns(out | {"parent_bytes": less})


def joined_ids(ends: DataFrame) -> DataFrame:
    """For each node in which conversations end: SHA-256 of their decimal ids, ascending, comma-joined (ends_sha256).

    Ids are first joined in runs of 2 ** ID_BITS neighbours at most; a node's runs are then hashed one by one as they
    stream past in order, so a node in which a third of all conversations end takes no memory."""
    runs = ends.groupBy(*KEY, F.shiftright("conv_id", ID_BITS).alias("run")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    order = runs.repartition(*KEY).sortWithinPartitions(*KEY, "run").select(*KEY, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for *k, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if k == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                state.update(ids.encode())
            yield batch_of(done)
        if key is not None:
            yield batch_of([(*key, state.hexdigest())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[*KEY, "ends_sha256"])

    return order.mapInArrow(run, "depth long, p1 long, p2 long, ends_sha256 string")


def trie(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each node over (conv_id, pos, h, bytes) rows and all conversation ids (those without rows are at the root):
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. No
    conversations, no nodes.

    The smallest member owns a node. A conversation owns the nodes on its path from some depth on (behind its first
    ``shared`` turns), so what a subtree saves and its leaves are sums over its members: of the bytes of each one's shared
    turns, less the owner's and less those above the node; and of those that own the childless node they end in. The
    second ROLLUP sums them for all prefixes.
    """
    blocks, ends = blocks_and_ends(rows, ids)
    owners = rolled(blocks, "min(conv_id) AS conv_id, max(n) AS longest").groupBy("conv_id").agg(
        (F.min("depth") - 1).alias("shared"), F.max((F.col("depth") == F.col("longest")).cast("long")).alias("leaf"))
    own = blocks.join(owners, "conv_id", "left").withColumns({"shared": F.coalesce("shared", "n"), "leaf": F.coalesce("leaf", F.lit(0).cast("long"))})
    here = F.lit(0).cast("long")
    for i, c in enumerate(COLUMNS):
        here = here + F.when(F.col("block") * WIDTH + i < F.col("shared"), F.coalesce(F.col(f"{c}.bytes"), F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long"))
    own = own.withColumn("shared_bytes", F.sum(here).over(Window.partitionBy("conv_id")))
    found = with_paths(rolled(own, """count(1) AS n_convs, min(conv_id) AS conv_id, sum(shared_bytes) AS sum_shared,
        min_by(struct(shared, shared_bytes), conv_id) AS owner, sum(leaf) AS n_leaves"""))
    saved = F.col("sum_shared") - F.col("owner.shared_bytes") - (F.col("n_convs") - 1) * F.col("parent_bytes")
    nodes = written(found.select("conv_id", *KEY, "q1", "q2", "n_convs", "n_leaves", F.col("owner.shared").alias("shared"), saved.alias("saved_tokens")), "trie_nodes")

    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), "n_convs")
    total = ids.count()
    bound = max(1_000, total // SHARE)
    while nodes.where(F.col("n_convs") >= bound).count() > HEAVY:
        bound *= 4
    heavy, light = (above.where(F.col("n_convs") >= bound).drop("n_convs"), above.where(F.col("n_convs") < bound).drop("n_convs"))
    # the owner also owns the parent unless its path branches off just there; a light parent has fewer than ``bound`` children
    branch = nodes.where("depth > 0 and shared = depth - 1")
    up = ["depth", "q1", "q2"]
    common = branch.join(F.broadcast(heavy), up)
    rest = branch.join(F.broadcast(heavy.select(*up)), up, "left_anti").join(light, up)
    straight = nodes.where("depth = 0 or shared < depth - 1").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("n_children"))
    out = straight.unionByName(common).unionByName(rest).join(children, KEY, "left").join(joined_ids(ends), KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of a table of conversations (conv_id, turn, role, text) as they are; other columns are not read."""
    rows = written(ordered(conversations), "ordered_turns")
    return trie(rows, rows.select("conv_id").distinct())


def spliced_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations with beginnings exchanged within each five ids (``spliced``)."""
    rows = written(ordered(conversations), "ordered_turns")
    ids = written(rows.select("conv_id").distinct(), "conversation_ids")
    return trie(written(spliced(rows, ids), "spliced_turns"), ids)


#: CRC-32 of an id's decimal digits in DuckDB, one reduction step for each bit (a byte comes in with its first).
CRC32 = """xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(
  string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: [ord(ch)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, b: xor(xor(a, b) >> 1, 3988292384::UBIGINT * (xor(a, b) & 1::UBIGINT))))"""

#: The DuckDB twin of ``spliced_trie``.
SQL = f"""
WITH turns AS (
  SELECT conv_id, list({{'h': sha256(concat(strlen(r), ':', r, t)), 'bytes': strlen(t)}} ORDER BY turn NULLS FIRST, r, sha256(concat(strlen(r), ':', r, t))) AS l
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
cut AS (SELECT conv_id, l, conv_id - conv_id % 5 AS base, CAST({CRC32} % 9 AS BIGINT) AS k FROM turns),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.l, 1, k), []), list_slice(c.l, k + 1, len(c.l))) AS l
  FROM cut c LEFT JOIN turns b ON b.conv_id = c.base),
prefixes AS (
  SELECT conv_id, d, len(l) AS n, sha256(array_to_string(list_transform(list_slice(l, 1, d), lambda x: x.h), ',')) AS node,
    sha256(array_to_string(list_transform(list_slice(l, 1, d - 1), lambda x: x.h), ',')) AS parent, CASE WHEN d > 0 THEN l[d].bytes ELSE 0 END AS bytes
  FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes, max(n) AS longest,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM prefixes GROUP BY d, node),
below AS (
  SELECT p.d, p.node, sum((w.n_convs - 1) * w.bytes) AS saved_tokens, count(*) FILTER (WHERE w.longest = w.d) AS n_leaves
  FROM nodes w JOIN prefixes p ON p.conv_id = w.conv_id AND p.d <= w.d GROUP BY p.d, p.node),
children AS (SELECT d - 1 AS d, parent AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY d - 1, parent)
SELECT x.conv_id, x.d AS depth, u.conv_id AS parent_conv_id, x.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves,
  CAST(b.saved_tokens AS BIGINT) AS saved_tokens, x.ends_sha256
FROM nodes x JOIN below b ON b.d = x.d AND b.node = x.node LEFT JOIN nodes u ON u.d = x.d - 1 AND u.node = x.parent AND x.d > 0
  LEFT JOIN children c ON c.d = x.d AND c.node = x.node
"""
