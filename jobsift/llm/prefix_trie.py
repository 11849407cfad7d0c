"""Conversation prefix trie by Spark SQL ``ROLLUP``.

Each turn gets an id, 16 bytes of the hash of its role and text.  Conversations
are cut into blocks of ``WIDTH`` turns, a row a block with one column a place.
``ROLLUP`` over these columns aggregates every prefix of a block at once;
``grouping_id`` tells how long it is.  The blocks of long conversations are
keyed by the node in which the block before ends, so all blocks of all
conversations take one aggregate, whatever their length.  The key of a node is
the hash of the key of its block's start and the turn ids from there.

A node belongs to its smallest member, so (``conv_id``, ``depth``) names it too,
and a conversation owns a lower stretch of its own path.  Sums over subtrees
need no walk down: a conversation carries what the nodes that it owns add up to,
and a second ``ROLLUP`` sums this over the members of each node; what an owner
holds above a node is taken off again.

Only ids, lengths and counts are shuffled, never texts.  Copies of a conversation
and turns that many share are combined before the shuffle, as ``ROLLUP`` is an
ordinary aggregate.  The list of members that end in a node can be long: it is
sorted by range over many tasks, which join neighbours to strings of up to
``CHUNK`` ids, and only these strings meet for the hash of the whole, which is
taken as they stream by.  Ids of one conversation stream through one task too,
which keeps one key.

Defined cases: null roles and texts count as empty; null turns come first; ties
of a turn stand by role, then by the hash of the turn, so repeated rows are turns
of their own; rows without a conversation id belong to none and are left out;
further columns of any name are left out; no conversations give no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

WIDTH = 8
KEY_BYTES = 16
CHUNK = 4096
#: The prepared tables: the opening of conversation ``c - c % GROUP`` stands before the turns of ``c``.
GROUP, MOST_SHARED = 5, 8
_COLUMNS = [f"t{k}" for k in range(1, WIDTH + 1)]


def _hashed(data: Column) -> Column:
    return F.unhex(F.substring(F.sha2(data, 256), 1, 2 * KEY_BYTES))


def numbered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, depth, turn_id, n_bytes)``, ``depth`` from 1; no texts."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), said[0].alias("role"), F.octet_length(said[1]).cast("long").alias("n_bytes"),
        _hashed(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said)).alias("turn_id"))
    by = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "turn_id")
    return rows.select("conv_id", F.row_number().over(by).cast("long").alias("depth"), "turn_id", "n_bytes")


def with_shared_openings(turns: DataFrame) -> DataFrame:
    """Each conversation rebuilt: the first h turns of ``c - c % 5`` (all if fewer,
    none if it is absent), then its own from the h-th on; h = crc32(c) % 9.  A
    conversation without any turn left is one row of depth 0.  Each opening has
    five takers at most, so the table grows by so much at most."""
    convs = turns.groupBy("conv_id").agg(F.max("depth").alias("n"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP)))
    there = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(there, "base", "left").withColumn("lead", F.least("h", F.coalesce("base_n", F.lit(0))))
    own = turns.join(convs.select("conv_id", "h", "lead"), "conv_id").where("depth > h").withColumn("depth", F.col("depth") - F.col("h") + F.col("lead"))
    opening = turns.where(F.col("depth") <= MOST_SHARED).withColumnRenamed("conv_id", "base")
    opening = opening.join(convs.select("conv_id", "base", "h"), "base").where("depth <= h")
    bare = convs.where((F.col("lead") == 0) & (F.col("n") <= F.col("h"))).select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("turn_id"), F.lit(0).cast("long").alias("n_bytes"))
    return own.select(turns.columns).unionByName(opening.select(turns.columns)).unionByName(bare)


_BLOCK = pa.schema([("conv_id", pa.int64()), ("prior", pa.binary()), ("block", pa.int64()), ("n", pa.int64()), ("last", pa.bool_()), *((c, pa.binary()) for c in _COLUMNS)])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns as blocks, with the key of the node where each begins."""
    conv, prior, block, ids = None, b"", 0, []

    def row(last: bool) -> tuple:
        return (conv, prior, block, len(ids), last, *ids, *[None] * (WIDTH - len(ids)))

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _BLOCK, strict=True)], schema=_BLOCK)

    for batch in batches:
        rows = []
        for c, turn in zip(batch.column("conv_id").to_pylist(), batch.column("turn_id").to_pylist(), strict=True):
            if c != conv:
                if conv is not None:
                    rows.append(row(True))
                conv, prior, block, ids = c, b"", 0, []
            elif len(ids) == WIDTH:
                rows.append(row(False))
                prior, block, ids = hashlib.sha256(prior + b"".join(ids)).digest()[:KEY_BYTES], block + 1, []
            if turn is not None:
                ids.append(turn)
        if rows:
            yield made(rows)
    if conv is not None:
        yield made([row(True)])


def blocks_of(turns: DataFrame) -> DataFrame:
    kept = turns.select("conv_id", "depth", "turn_id").repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    return kept.mapInArrow(_blocks, "conv_id long, prior binary, block long, n long, last boolean, " + ", ".join(f"{c} binary" for c in _COLUMNS))


def _node(n: Column) -> Column:
    """The key of the node that the first ``n`` turns of a block lead to."""
    none = F.lit(b"")
    ids = [F.when(n >= k, F.col(c)).otherwise(none) for k, c in enumerate(_COLUMNS, 1)]
    return F.when(n == 0, F.col("prior")).otherwise(_hashed(F.concat(F.col("prior"), *ids)))


def _rolled(blocks: DataFrame, measures: str) -> DataFrame:
    """``measures`` of every prefix: ``(id, parent_id, depth, ...)``; the root's id is empty."""
    rolled = blocks.sparkSession.sql(
        f"SELECT prior, block, {', '.join(_COLUMNS)}, {WIDTH} - bit_count(grouping_id()) AS level, {measures} FROM {{blocks}} "
        f"GROUP BY prior, block, ROLLUP({', '.join(_COLUMNS)}) HAVING max(n) >= {WIDTH} - bit_count(grouping_id())", blocks=blocks)
    rolled = rolled.where("level > 0 OR block = 0")
    level = F.col("level")
    return rolled.select(_node(level).alias("id"), F.when(level > 0, _node(level - 1)).alias("parent_id"), (F.col("block") * WIDTH + level).cast("long").alias("depth"), *rolled.columns[WIDTH + 3:])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours of one node in the sorted rows as strings of ids."""
    node, ids, rows = None, [], []

    def flush() -> None:
        if ids:
            rows.append((node, ids[0], ",".join(map(str, ids))))

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], ["id", "first", "ids"])

    for batch in batches:
        for i, c in zip(batch.column("id").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if i != node or len(ids) == CHUNK:
                flush()
                node, ids = i, []
            ids.append(c)
        yield made()
        rows.clear()
    flush()
    yield made()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the strings of each node, which come in order, joined by commas."""
    node, now, rows = None, hashlib.sha256(), []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["id", "ends_sha256"])

    for batch in batches:
        for i, ids in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if i == node:
                now.update(b",")
            else:
                if node is not None:
                    rows.append((node, now.hexdigest()))
                node, now = i, hashlib.sha256()
            now.update(ids.encode())
        yield made()
        rows.clear()
    if node is not None:
        rows.append((node, now.hexdigest()))
    yield made()


def ends_of(blocks: DataFrame) -> DataFrame:
    """``(id, ends_sha256)`` of the nodes in which conversations end."""
    ends = stored(blocks.where("last").select(_node(F.col("n")).alias("id"), "conv_id"), "trie-ends")
    strings = ends.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id").mapInArrow(_strings, "id binary, first long, ids string")
    strings = stored(strings, "trie-strings")
    return strings.repartition("id").sortWithinPartitions("id", "first").mapInArrow(_digests, "id binary, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie over ``(conv_id, depth, turn_id, n_bytes)``; a
    conversation without turns is a row of depth 0.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``
    (members), ``n_children``, ``n_leaves`` (childless nodes of the subtree),
    ``saved_tokens`` (bytes of last texts that sharing saves in the subtree),
    ``ends_sha256`` (of the members that end here).
    """
    turns = stored(turns, "trie-turns")
    blocks = stored(blocks_of(turns), "trie-blocks")
    nodes = stored(_rolled(blocks, "min(conv_id) AS conv_id, count(*) AS n_convs"), "trie-nodes")
    children = nodes.where("parent_id IS NOT NULL").groupBy(F.col("parent_id").alias("id")).agg(F.count("*").alias("n_children"))
    shared = nodes.where("n_convs > 1 AND depth > 0").select("conv_id", "depth", "n_convs")
    saves = shared.join(turns.select("conv_id", "depth", "n_bytes"), ["conv_id", "depth"]).select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saves"))
    nodes = nodes.join(children, "id", "left").join(saves, ["conv_id", "depth"], "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_children", "saves")})
    nodes = stored(nodes, "trie-nodes")
    owners = nodes.groupBy("conv_id").agg(F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"), F.sum("saves").alias("owned"))
    carried = blocks.join(owners.where("leaves > 0 OR owned > 0"), "conv_id")
    below = _rolled(carried, "sum(leaves) AS n_leaves, sum(owned) AS owned").drop("parent_id", "depth")
    above = F.coalesce(F.sum("saves").over(Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parents = nodes.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.withColumn("above", above).join(parents, "parent_id", "left").join(below, "id").join(ends_of(blocks), "id", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("owned") - F.col("above")).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
