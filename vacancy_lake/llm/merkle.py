"""A Merkle manifest of a table: digests of its rows as leaves, a tree over each group, a tree over the groups.

Every level is one equi-join of its nodes with their siblings, whose places are computed: the other one of two by
exclusive or, the others of a larger run by offsets of the slot.  The rows of slot zero, which then know their whole
run, give the parents.  Proofs are handed down the same levels, from the root to the leaves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .crc_sql import crc_cte
from .store import written

#: Nodes of a level that are written as one file; a level has no more files than a shuffle has partitions.
NODES_PER_FILE = 200_000
#: Levels that proofs are handed down before they are written.
LEVELS_PER_STEP = 4


def sha256(*parts: Column) -> Column:
    """Digest (binary) of the concatenated parts; a digest among them counts as hex text."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """A value with its length in bytes before it, ``-`` for null: no two lists of values read alike."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(fields: Sequence[Column]) -> Column:
    return sha256(*[field(f) for f in fields])


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``idx`` (from 0, by ``order`` within ``group``, null first) and ``n`` (rows of the group).

    Rows are dealt out by ranges of group and order and sorted; a row's place in its range and the number of
    its group's rows in earlier ranges make its place in the group.  No task sees a whole group.  Rows that
    are equal in group and order are numbered in any order.
    """
    # Rows that are alike are dealt out by where they stand in the input, so many of them do not meet in one task.
    marked = written(rows.withColumn("__row", F.monotonically_increasing_id()), "rows")
    ranged = marked.repartitionByRange(group, *order, "__row").sortWithinPartitions(group, *order, "__row")
    # The upper bits of this id are the range's number, the lower ones the place in it.
    placed = written(ranged.withColumn("__at", F.monotonically_increasing_id()).drop("__row"), "ranges")
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    placed = placed.withColumn("__part", part).withColumn("__place", place)
    # A row for each range and group in it: at most as many as there are ranges and groups.
    counts = placed.groupBy(F.col(group).alias("__g"), F.col("__part").alias("__p")).agg(
        F.count("*").alias("__n"), F.min("__place").alias("__first")
    )
    before = Window.partitionBy("__g").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "__g", "__p", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy("__g")).alias("n")
    )
    met = placed.join(counts, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p")))
    return met.select(*rows.columns, (F.col("__place") - F.col("__first") + F.col("__before")).alias("idx"), "n")


def _files(df: DataFrame, nodes: int) -> DataFrame:
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(min(most, 1 + nodes // NODES_PER_FILE))


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes with ``left`` and ``right``: the digests of their siblings on either side, in order, in one value."""
    slot = F.col("idx") % arity
    at = nodes.select("tree", "idx", "n", "digest")
    if arity == 2:
        other = nodes.select(F.col("tree").alias("__t"), F.col("idx").bitwiseXOR(F.lit(1)).alias("__i"), F.col("digest").alias("__d"))
        at = at.join(other, F.col("tree").eqNullSafe(F.col("__t")) & (F.col("idx") == F.col("__i")), "left")
        sides = [(F.col("__d"), slot == 1)]
    else:
        sides = []
        for k in range(1, arity):
            # The sibling k slots on, around the run.
            other = nodes.select(
                F.col("tree").alias(f"__t{k}"), (F.col("idx") - slot + (slot + (arity - k)) % arity).alias(f"__i{k}"), F.col("digest").alias(f"__d{k}")
            )
            at = at.join(other, F.col("tree").eqNullSafe(F.col(f"__t{k}")) & (F.col("idx") == F.col(f"__i{k}")), "left")
        # On the left those of slots 0 .. slot-1, which are arity-slot .. arity-1 slots on; on the right 1 .. arity-slot-1.
        sides = [(F.col(f"__d{k}"), slot + k >= arity) for k in range(1, arity)]

    def joined(of_left: bool) -> Column:
        return F.concat(*[F.when(is_left if of_left else ~is_left, F.coalesce(d, F.lit(b""))).otherwise(F.lit(b"")) for d, is_left in sides])

    return at.select("tree", "idx", "n", "digest", joined(True).alias("left"), joined(False).alias("right"))


def grow(nodes: DataFrame, arity: int = 2) -> tuple[list[DataFrame], DataFrame]:
    """Trees over ``nodes`` (tree, idx, n, digest): the levels, each with its nodes' siblings, and the tops.

    Tops (tree, level, digest): a tree that has one node at a level ends there.  Each level is written and
    half as large as the one below.
    """
    levels, tops = [], []
    # Three numbers come to the driver: the largest tree gives the number of levels.
    most, total, trees = nodes.agg(F.max("n"), F.count("*"), F.count_if(F.col("idx") == 0)).first()
    while True:
        level = len(levels)
        tops.append(nodes.filter("n = 1").select("tree", F.lit(level).alias("level"), "digest"))
        if (most or 1) == 1:
            return levels, written(_files(reduce(DataFrame.unionByName, tops), trees), "tops")
        paired = written(_files(_with_siblings(nodes.filter("n > 1"), arity), total), "level")
        most, total = -(-most // arity), total // arity + trees
        levels.append(paired)
        parent = sha256(as_hex(F.col("left")), as_hex(F.col("digest")), as_hex(F.col("right")))
        nodes = paired.filter(F.col("idx") % arity == 0).select(
            "tree", F.floor(F.col("idx") / arity).cast("long").alias("idx"), F.ceil(F.col("n") / arity).cast("long").alias("n"), parent.alias("digest")
        )


def proofs(levels: list[DataFrame], tops: DataFrame, arity: int = 2) -> DataFrame:
    """tree, idx, top, path of every leaf, from ``tops`` (tree, level, top, path): what a proof of the top needs.

    ``path``: left and right siblings of each level from the leaf up.  A leaf that is its tree's top has the
    top's path.
    """
    tops = written(tops, "top_paths")
    known = None
    for level in range(len(levels), -1, -1):
        ended = tops.filter(F.col("level") == level).select("tree", F.lit(0).cast("long").alias("idx"), "top", "path")
        if level == len(levels):
            known = ended
            continue
        above = known.select(F.col("tree").alias("__t"), F.col("idx").alias("__i"), "top", F.col("path").alias("__path"))
        up = F.col("tree").eqNullSafe(F.col("__t")) & (F.floor(F.col("idx") / arity).cast("long") == F.col("__i"))
        step = F.array(F.struct("left", "right"))
        below = levels[level].join(above, up).select("tree", "idx", "top", F.concat(step, F.col("__path")).alias("path"))
        known = below.unionByName(ended)
        if level % LEVELS_PER_STEP == 0 and level:
            known = written(known, "paths")
    return known


NO_PATH = "array<struct<left:binary,right:binary>>"


def proof_digest(path: Column) -> Column:
    """Digest of all siblings' digests, level by level, left to right."""
    return sha256(F.array_join(F.transform(path, lambda s: F.concat(as_hex(s["left"]), as_hex(s["right"]))), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: sha256(as_hex(s["left"]), as_hex(h), as_hex(s["right"])))


def manifest(rows: DataFrame, group: str, order: str, keep: Sequence[str] = (), arity: int = 2) -> DataFrame:
    """Leaves with their proofs: ``rows`` has ``leaf`` (binary), the group's and order's columns and those to ``keep``.

    Returns the kept columns, ``leaf``, ``subroot``, ``root`` (binary) and ``path`` (siblings from the leaf to the root).
    Groups are ordered by value, null first; leaves within a group by ``order``, null first, equals by digest.  A table
    without rows gives none.
    """
    cols = list(dict.fromkeys([*keep, "leaf"]))
    leaves = written(
        numbered(rows.select(*cols, F.col(group).alias("tree"), F.col(order).alias("__order")), "tree", ["__order", "leaf"])
        .withColumnRenamed("leaf", "digest").drop("__order"),
        "leaves",
    )
    levels, subroots = grow(leaves.select("tree", "idx", "n", "digest"), arity)
    # The subroots are leaves of one more tree.
    upper = numbered(subroots.select(F.lit("").alias("all"), "tree", "level", F.col("digest").alias("leaf")), "all", ["tree"])
    upper = written(upper.select(F.col("all").alias("tree"), F.col("tree").alias("group"), "level", "idx", "n", F.col("leaf").alias("digest")), "groups")
    top_levels, root = grow(upper.select("tree", "idx", "n", "digest"), arity)
    start = root.select("tree", "level", F.col("digest").alias("top"), F.array().cast(NO_PATH).alias("path"))
    reached = proofs(top_levels, start, arity).select("idx", "top", "path")
    # subroot and root go down together with the path.
    starts = upper.join(reached, "idx").select(
        F.col("group").alias("tree"), "level", F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"), "path"
    )
    paths = proofs(levels, starts, arity).select(F.col("tree").alias("__t"), F.col("idx").alias("__i"), "top", "path")
    met = leaves.join(paths, F.col("tree").eqNullSafe(F.col("__t")) & (F.col("idx") == F.col("__i")))
    kept = [c for c in cols if c != "leaf"]
    return met.select(*kept, F.col("digest").alias("leaf"), F.col("top.subroot").alias("subroot"), F.col("top.root").alias("root"), "path")


#: A document's fields, in the order in which its leaf takes them.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 0, F.lit(False))


def dataset_manifest(docs: DataFrame, arity: int = 2) -> DataFrame:
    """A manifest of documents by language, each proof checked against a row that may have been tampered with.

    Null fields are written as ``-``; other columns are not looked at.  A row without doc_id comes first in its
    language and is never tampered with.  Rows that share a doc_id are ordered by their leaf; equal rows have a leaf
    each.  No rows give none.
    """
    one_more = F.when(tampered(F.col("doc_id")), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    changed = {"n_chars": one_more}
    rows = docs.select(
        "doc_id", "lang", leaf_of([F.col(c) for c in FIELDS]).alias("leaf"), leaf_of([changed.get(c, F.col(c)) for c in FIELDS]).alias("__now")
    )
    # Only changed rows carry a second digest.
    rows = rows.withColumn("__now", F.when(F.col("__now") != F.col("leaf"), F.col("__now")))
    found = manifest(rows, "lang", "doc_id", ["doc_id", "__now"], arity)
    folded = fold(F.coalesce("__now", "leaf"), F.col("path"))
    found = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof"), folded.alias("folded"))
    return found.select(
        "doc_id",
        *[as_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        as_hex(F.col("proof")).alias("proof_sha256"),
        as_hex(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


_LEAF = "sha256(" + " || ".join("CASE WHEN {0} IS NULL THEN '-' ELSE CAST(octet_length(encode(CAST({0} AS VARCHAR))) AS VARCHAR) || ':' || CAST({0} AS VARCHAR) END".format(c) for c in FIELDS) + ")"
ORACLE = f"""WITH RECURSIVE {crc_cte("doc_id", "documents")},
d AS (SELECT doc_id, lang, n_chars, {_LEAF} AS leaf, crc % 7 = 0 AS hit, source, text FROM documents LEFT JOIN crcs ON s = CAST(doc_id AS VARCHAR)),
changed AS (SELECT doc_id AS k, {_LEAF} AS now FROM (SELECT doc_id, source, lang, n_chars + 1 AS n_chars, text FROM d WHERE hit)),
leaves AS (SELECT doc_id, lang, leaf, coalesce(now, leaf) AS now, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM d LEFT JOIN changed ON k = doc_id),
nodes AS (
  SELECT lang, 0 AS lvl, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY lang, lvl, idx // 2, n
),
subs AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, idx, n, subroot AS h FROM subs
  UNION ALL
  SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY lvl, idx // 2, n
),
upper_path AS (
  SELECT lang, subroot, 0 AS lvl, idx, n, CAST([] AS STRUCT(l VARCHAR, r VARCHAR)[]) AS path FROM subs
  UNION ALL
  SELECT p.lang, p.subroot, p.lvl + 1, p.idx // 2, (p.n + 1) // 2, list_append(p.path, {{'l': CASE WHEN p.idx % 2 = 1 THEN t.h ELSE '' END, 'r': CASE WHEN p.idx % 2 = 0 THEN coalesce(t.h, '') ELSE '' END}})
  FROM upper_path p LEFT JOIN tops t ON t.lvl = p.lvl AND t.idx = xor(p.idx, 1) WHERE p.n > 1
),
leaf_path AS (
  SELECT doc_id, lang, leaf, now, 0 AS lvl, idx, n, CAST([] AS STRUCT(l VARCHAR, r VARCHAR)[]) AS path FROM leaves
  UNION ALL
  SELECT p.doc_id, p.lang, p.leaf, p.now, p.lvl + 1, p.idx // 2, (p.n + 1) // 2, list_append(p.path, {{'l': CASE WHEN p.idx % 2 = 1 THEN t.h ELSE '' END, 'r': CASE WHEN p.idx % 2 = 0 THEN coalesce(t.h, '') ELSE '' END}})
  FROM leaf_path p LEFT JOIN nodes t ON t.lang IS NOT DISTINCT FROM p.lang AND t.lvl = p.lvl AND t.idx = xor(p.idx, 1) WHERE p.n > 1
),
whole AS (
  SELECT doc_id, leaf, now, u.subroot, (SELECT h FROM tops WHERE n = 1) AS root, list_concat(p.path, u.path) AS path
  FROM (SELECT * FROM leaf_path WHERE n = 1) p JOIN (SELECT * FROM upper_path WHERE n = 1) u ON u.lang IS NOT DISTINCT FROM p.lang
),
folds AS (
  SELECT doc_id, leaf, subroot, root, path, 1 AS k, now AS h FROM whole
  UNION ALL
  SELECT doc_id, leaf, subroot, root, path, k + 1, sha256(path[k].l || h || path[k].r) FROM folds WHERE k <= len(path)
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256, h AS folded_root, h = root AS verified
FROM folds WHERE k = len(path) + 1"""
