"""The prefix trie of conversations, by truncation peeling.

Every conversation becomes its path: for each turn the digest of all turns up to it, and the size of its text.
Peeling begins at the greatest depth.  What stands there are conversations that end there and nodes that are left
of deeper ones; equal paths are one node, whose numbers are sums over both.  Stripped of its last turn a node goes
on to the next depth, where it is regrouped.  So every node is found, and its subtree summed up, as it is passed.

Depths are peeled several at a time where the conversations that share the path above them are few: these meet in
a task.  Where they are many, one depth is peeled at a time by an aggregation that combines before its shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .crc_sql import crc_cte
from .store import written

#: Bytes of a turn in a path: the digest of all turns up to it, the size of its text.
KEY, SIZE = 16, 8
STEP = KEY + SIZE
#: So many conversations and nodes may meet in a task to be peeled over several depths.
GROUP_LIMIT = 256
#: Conversation ids that are put into one row on their way to a node's digest.
IDS_PER_ROW = 10_000


def turn_digest():
    """Digest (hex) of a turn's role and text; null as empty."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def path_of(turns: list[tuple[str, int]]) -> bytes:
    """``turns``: digest and bytes of each."""
    out, key = [], b""
    for digest, size in turns:
        key = hashlib.sha256(key + bytes.fromhex(digest)).digest()[:KEY]
        out.append(key + size.to_bytes(SIZE, "big"))
    return b"".join(out)


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path, depth: first turns of conversation c - c % 5, then the own ones after as many.

    A conversation's turns (a digest and a size each) are one value.
    """
    turn = F.struct(
        F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"), turn_digest().alias("digest"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"),
    )
    turns = conversations.filter(F.col("conv_id").isNotNull()).select("conv_id", turn.alias("t"))
    own = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    own = written(own.select("conv_id", F.transform("ts", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns")), "turns")
    head = F.crc32(F.col("conv_id").cast("string")) % 9
    bases = own.filter(F.col("conv_id") % 5 == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("heads"))
    met = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(bases, "base", "left").withColumn("h", head.cast("int"))
    first = F.coalesce(F.slice("heads", F.lit(1), F.col("h")), F.array().cast(own.schema["turns"].dataType))
    whole = met.select("conv_id", F.concat(first, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))
    schema = T.StructType([own.schema["conv_id"], T.StructField("path", T.BinaryType()), T.StructField("depth", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [path_of([(t["digest"], t["size"]) for t in turns]) for turns in batch.column("turns").to_pylist()]
            depths = pa.array([len(p) // STEP for p in paths], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(paths, pa.binary()), depths], names=schema.names)

    return whole.mapInArrow(run, schema)


#: What is peeled: rows of equal path are added up.  convs: members; kids: children, found one depth below.
SUMS = ("convs", "kids", "leaves", "saved")
ENTRY = ["path", "conv_id", *SUMS]


def peel(entries: list[tuple], above: int) -> tuple[list[tuple], list[tuple]]:
    """Nodes below depth ``above`` of entries that share their path down to there, and what is left at it."""
    by_depth: dict[int, dict[bytes, list]] = {}

    def put(path: bytes, conv, *sums: int) -> None:
        level = by_depth.setdefault(len(path) // STEP, {})
        # Of equal paths only the last digest is needed to tell them apart.
        node = level.get(path[-STEP:])
        if node is None:
            level[path[-STEP:]] = [path, conv, *sums]
        else:
            node[1] = min(node[1], conv)
            node[2:] = map(sum, zip(node[2:], sums, strict=True))

    for entry in entries:
        put(*entry)
    nodes = []
    for depth in range(max(by_depth), above, -1):
        for path, conv, convs, kids, leaves, saved in by_depth.pop(depth, {}).values():
            leaves = leaves if kids else 1
            saved += (convs - 1) * int.from_bytes(path[-SIZE:], "big")
            key, parent = path[-STEP:-SIZE], path[-2 * STEP : -STEP - SIZE] if depth > 1 else b""
            nodes.append((key, parent, depth, conv, convs, kids, leaves, saved))
            put(path[:-STEP], conv, convs, 1, leaves, saved)
    return nodes, [tuple(n) for level in by_depth.values() for n in level.values()]


NODE = "key binary, parent binary, depth int, conv_id {id}, convs long, kids long, leaves long, saved long"


def _peeled_groups(entries: DataFrame, above: int, conv_type: str) -> DataFrame:
    """Nodes below ``above`` (path null) and what is left at it (key null), as one table."""
    schema = NODE.format(id=conv_type) + ", path binary"
    names = [x.split(" ")[0] for x in schema.split(", ")]
    anchor = F.substring("path", 1, STEP * above)
    dealt = entries.withColumn("anchor", anchor).repartition("anchor").sortWithinPartitions("anchor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, now, types, out = [], None, None, []

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

        def close() -> None:
            nodes, left = peel(group, above)
            out.extend((*n, None) for n in nodes)
            out.extend((None, None, above, conv, *sums, path) for path, conv, *sums in left)

        for batch in batches:
            conv = batch.schema.field("conv_id").type
            types = [pa.binary(), pa.binary(), pa.int32(), conv, *[pa.int64()] * 4, pa.binary()]
            for at, *entry in zip(*[batch.column(c).to_pylist() for c in ("anchor", *ENTRY)], strict=True):
                if at != now and group:
                    close()
                    group = []
                    if len(out) > 10_000:
                        yield table()
                        out = []
                now = at
                group.append(entry)
        if group:
            close()
        if out:
            yield table()

    return dealt.select("anchor", *ENTRY).mapInArrow(run, schema)


def _peeled_level(entries: DataFrame, depth: int) -> DataFrame:
    """The same for one depth."""
    nodes = entries.groupBy("path").agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in SUMS])
    at = (depth - 1) * STEP
    size = F.conv(F.hex(F.substring("path", max(1, depth * STEP - SIZE + 1), SIZE)), 16, 10).cast("long") if depth else F.lit(0)
    parent = F.substring("path", at - STEP + 1, KEY) if depth > 1 else F.lit(b"") if depth else F.lit(None).cast("binary")
    return nodes.select(
        (F.substring("path", at + 1, KEY) if depth else F.lit(b"")).alias("key"),
        parent.alias("parent"),
        F.lit(depth).alias("depth"),
        "conv_id",
        "convs",
        "kids",
        F.when(F.col("kids") == 0, 1).otherwise(F.col("leaves")).alias("leaves"),
        (F.col("saved") + (F.col("convs") - 1) * size).alias("saved"),
        (F.substring("path", 1, at) if depth else F.lit(None).cast("binary")).alias("path"),
    )


def trie(paths: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Nodes (NODE) of ``paths`` (conv_id, path, depth); the root's key is empty, its parent null."""
    conv_type = paths.schema["conv_id"].dataType.simpleString()
    ended = paths.groupBy("depth", "path").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("convs"))
    # Depths by powers of two: a step reads only the folders of its depths.
    ended = written(
        ended.select("depth", "path", "conv_id", "convs", *[F.lit(0).cast("long").alias(c) for c in SUMS[1:]])
        .withColumn("class", F.when(F.col("depth") > 0, F.floor(F.log2("depth"))).otherwise(-1).cast("int")),
        "ended", by="class",
    )
    deepest = ended.agg(F.max("depth")).first()[0]
    if deepest is None:
        return paths.sparkSession.createDataFrame([], NODE.format(id=conv_type))
    found, left, depth = [], None, deepest
    while depth >= 0:
        above = depth // 2

        def entries(above: int, depth: int = depth, left: DataFrame | None = left) -> DataFrame:
            classes = list(range((above + 1).bit_length() - 1, depth.bit_length())) if depth else [-1]
            own = ended.filter(F.col("class").isin(classes) & F.col("depth").between(above + 1, depth)).select(*ENTRY)
            return own if left is None else own.unionByName(left)

        if depth > 1:
            while above < depth - 1:
                most = entries(above).groupBy(F.substring("path", 1, STEP * above).alias("a")).count().agg(F.max("count")).first()[0]
                if most is None or most <= group_limit:
                    break
                above += (depth - above) // 2
        if 1 <= above < depth - 1:
            step = written(_peeled_groups(entries(above), above, conv_type), "peeled")
            left, depth = step.filter("key IS NULL").select(*ENTRY), above
        else:
            step = written(_peeled_level(entries(depth - 1), depth), "peeled")
            # A node goes on as one child of what is left of it.
            left = step.select("path", "conv_id", "convs", F.lit(1).cast("long").alias("kids"), "leaves", "saved")
            depth -= 1
        found.append(step.filter("key IS NOT NULL").drop("path"))
    return reduce(DataFrame.unionByName, found)


def end_digests(paths: DataFrame) -> DataFrame:
    """key, ends_sha256: of the ids of all conversations that end at a node, ascending.

    Ids are sorted over all tasks and put into longer rows, so a node's digest reads few rows, one at a time.
    """
    last = F.when(F.col("depth") > 0, F.expr(f"substring(path, (depth - 1) * {STEP} + 1, {KEY})")).otherwise(F.lit(b""))
    ends = written(paths.select(last.alias("key"), "conv_id"), "ends")
    ordered = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    kind = ends.schema["conv_id"].dataType.simpleString()
    schema = f"key binary, first {kind}, ids string"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids = None, []

        def row(conv: pa.DataType) -> pa.RecordBatch:
            text = ",".join(map(str, ids))
            return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array(ids[:1], conv), pa.array([text])], names=["key", "first", "ids"])

        conv = None
        for batch in batches:
            conv = batch.schema.field("conv_id").type
            done = []
            for key, conv_id in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if ids and (key != now or len(ids) == IDS_PER_ROW):
                    done.append(row(conv))
                    ids = []
                now = key
                ids.append(conv_id)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if ids:
            yield row(conv)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, keys, digests = None, None, [], []
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if key == now:
                    state.update(b"," + text.encode())
                    continue
                if state is not None:
                    keys.append(now)
                    digests.append(state.hexdigest())
                now, state = key, hashlib.sha256(text.encode())
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([*keys, now], pa.binary()), pa.array([*digests, state.hexdigest()])], names=["key", "ends_sha256"])

    packed = ordered.mapInArrow(pack, schema).repartition("key").sortWithinPartitions("key", "first")
    return packed.select("key", "ids").mapInArrow(digest, "key binary, ends_sha256 string")


def conversation_trie(conversations: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """The nodes of the rebuilt conversations' trie.

    Rows without conv_id belong to no conversation and are left out.  Turns are ordered by number, null first; turns
    that share a number are ordered by the digest of role and text, repeats stay.  Null role or text counts as empty.
    Other columns are not looked at.  No conversation gives no node, a conversation without turns is at the root.
    A node's ``conv_id`` is its smallest member; ``parent_conv_id`` is null for the root only.
    """
    paths = written(rebuilt_paths(conversations), "conversation_paths")
    nodes = written(trie(paths, group_limit), "nodes")
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    met = nodes.join(end_digests(paths), "key", "left").join(parents, "parent", "left")
    return met.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        F.col("convs").alias("n_convs"),
        F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


#: Turns are told by their place in the list of distinct (role, text); a node is a list of such numbers.
ORACLE = f"""WITH {crc_cte("conv_id", "conversations")},
rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k, dense_rank() OVER (ORDER BY role, text) AS id, octet_length(encode(text)) AS size FROM rows),
convs AS (SELECT conv_id, crc % 9 AS h FROM (SELECT DISTINCT conv_id FROM rows) LEFT JOIN crcs ON s = CAST(conv_id AS VARCHAR)),
turns AS (
  SELECT c.conv_id, o.k, o.id, o.size FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 5 AND o.k <= c.h
  UNION ALL SELECT c.conv_id, o.k + 100000, o.id, o.size FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.k > c.h
),
paths AS (SELECT c.conv_id, coalesce(list(t.id ORDER BY t.k) FILTER (WHERE t.id IS NOT NULL), []) AS p, coalesce(list(t.size ORDER BY t.k) FILTER (WHERE t.id IS NOT NULL), []) AS sizes FROM convs c LEFT JOIN turns t ON t.conv_id = c.conv_id GROUP BY 1),
prefixes AS (SELECT conv_id, unnest(range(0, len(p) + 1)) AS d, p, sizes FROM paths),
nodes AS (
  SELECT p[1:d] AS node, d, min(conv_id) AS conv_id, count(*) AS n, any_value(CASE WHEN d > 0 THEN sizes[d] ELSE 0 END) AS size,
    string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(p) = d) AS ends
  FROM prefixes GROUP BY 1, 2
),
up AS (SELECT node, n, size, d, unnest(range(0, d + 1)) AS a FROM nodes),
below AS (
  SELECT node[1:a] AS top, a, sum((n - 1) * size) AS saved, count(*) FILTER (WHERE d = a + 1) AS kids,
    count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM nodes c WHERE c.d = up.d + 1 AND c.node[1:up.d] = up.node)) AS leaves
  FROM up GROUP BY 1, 2
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, b.kids AS n_children, b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN below b ON b.a = n.d AND b.top = n.node LEFT JOIN nodes p ON p.d = n.d - 1 AND n.d > 0 AND p.node = n.node[1:n.d - 1]"""
