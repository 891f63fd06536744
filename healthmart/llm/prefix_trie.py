"""Conversation prefix trie by union-find over the LCP edges of sorted neighbours.

Conversations are sequences of turns, a turn being 16 bytes of the SHA-256 of
its role and text. They are range-sorted by (sequence, id), so copies of one
conversation, however many, are spread over partitions. Each block of sorted
rows is solved on its own:

* every two neighbours are an edge as deep as their longest common prefix;
* edges are taken in descending depth and unite the components they join. A
  merge at a depth that neither top node has creates a branching node there;
  otherwise the lower component hangs below, or is merged with, a top node.

That gives the block's compressed trie. A node that holds neither the block's
first nor its last conversation is complete: its chain of single nodes is
written out with all figures. The rest, the paths to the first and the last
conversation, is the contracted forest: one row per place on a path, with
the sums of what hangs below it complete in the block, known by the digest of
its prefix. Across block borders the same prefix is the same node, so a
combinable aggregation by that digest merges all forests. Every open node is
then owned by one path; what lies below a place is the running sum, along
each path through it, of owned values from the leaf up, summed over paths.
There is no iteration, and nothing but counts reaches the driver.

The ids that end at an open node are hashed in a sorted stream (SHA-256 is
sequential: one task reads the ids of one node, holding a batch at a time).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from healthmart.llm.common import cut, quoted, table

DIGEST = 16
BLOCK = 8192          # conversations solved at a time
BROADCAST = 1 << 18   # open nodes up to which they are broadcast
EMPTY = hashlib.sha256(b"").hexdigest()
ROOT = bytes(DIGEST)
_FOREST = ("kind int, depth long, conv_id long, parent_conv long, parent_key binary, key binary, path long, side int, "
           "n long, kids long, leaves long, saved long, chars long, ends string")
_ARROW = pa.schema([("kind", pa.int32()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv", pa.int64()),
                    ("parent_key", pa.binary()), ("key", pa.binary()), ("path", pa.int64()), ("side", pa.int32()),
                    ("n", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()),
                    ("chars", pa.int64()), ("ends", pa.string())])
CLOSED, OPEN, END = 0, 1, 2


def sequences(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id, seq): the turns of every id as an array of (d, c), digest in
    hex and code points of the text, by turn (NULL first), equal turns by
    role and digest. NULL roles and texts are empty. Rows without an id
    belong to no conversation."""
    role = F.coalesce(F.col(quoted(role_col)).cast("string"), F.lit(""))
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * DIGEST)
    turn = F.struct(F.col(quoted(turn_col)).isNotNull().alias("has"), F.col(quoted(turn_col)).alias("turn"), role.alias("role"),
                    digest.alias("d"), F.length(text).alias("c"))
    rows = df.select(F.col(quoted(id_col)).cast("long").alias("conv_id"), turn.alias("t")).where("conv_id is not null")
    return rows.groupBy("conv_id").agg(F.expr("transform(sort_array(collect_list(t)), x -> named_struct('d', x.d, 'c', x.c))").alias("seq"))


def lcp(a: bytes, b: bytes) -> int:
    """Turns that both sequences start with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    i = 0
    while a[i:i + DIGEST] == b[i:i + DIGEST]:
        i += DIGEST
    return i // DIGEST


class Forest:
    """Compressed trie of sorted sequences. Node v: depth[v], its members
    lo[v]..hi[v], kids[v], and ends[v], the members that are no longer."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.depth = [len(k) // DIGEST for k in keys]
        self.lo, self.hi = list(range(n)), list(range(n))
        self.kids: list[list[int]] = [[] for _ in range(n)]
        self.ends: list[list[int]] = [[i] for i in range(n)]
        edge = [lcp(keys[i], keys[i + 1]) for i in range(n - 1)]
        self._up, self._top = list(range(n)), list(range(n))
        for e in sorted(range(n - 1), key=lambda i: -edge[i]):
            self._unite(e, edge[e])
        self.root = self._top[self._find(0)]
        if self.depth[self.root]:
            self.root = self._node(0, [self.root])

    def _find(self, i: int) -> int:
        up = self._up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def _node(self, depth: int, kids: list[int]) -> int:
        self.depth.append(depth)
        self.lo.append(self.lo[kids[0]])
        self.hi.append(self.hi[kids[-1]])
        self.kids.append(kids)
        self.ends.append([])
        return len(self.depth) - 1

    def _unite(self, e: int, d: int) -> None:
        """Join the components of e and e + 1 at depth d. Edges of one depth
        come from left to right, so the right component has no node at d but
        the end of a sequence equal to the left one's."""
        left, right = self._find(e), self._find(e + 1)
        a, b = self._top[left], self._top[right]
        if self.depth[a] != d:
            a = self._node(d, [a, b])
        elif self.depth[b] != d:
            self.kids[a].append(b)
        else:
            self.ends[a] += self.ends[b]
            self.kids[a] += self.kids[b]
        self.hi[a] = self.hi[b]
        self._up[right] = left
        self._top[left] = a

    def preorder(self) -> list[tuple[int, int]]:
        """(node, parent) from the root down; the root's parent is -1."""
        out, stack = [], [(self.root, -1)]
        while stack:
            v, u = stack.pop()
            out.append((v, u))
            stack.extend((k, v) for k in self.kids[v])
        return out


def path_keys(key: bytes) -> list[bytes]:
    """Digests of all prefixes of a sequence, the root's first."""
    out = [ROOT]
    for i in range(0, len(key), DIGEST):
        out.append(hashlib.sha256(out[-1] + key[i:i + DIGEST]).digest()[:DIGEST])
    return out


def ends_hash(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() if ids else EMPTY


def solve_block(ids: list[int], keys: list[bytes], chars: np.ndarray, offsets: np.ndarray) -> list[tuple]:
    """Rows of ``_FOREST`` for one block of sorted conversations; the code
    points of conversation i are ``chars[offsets[i]:offsets[i + 1]]``."""
    forest = Forest(keys)
    total = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])
    last = len(ids) - 1
    paths = {0: path_keys(keys[0]), last: path_keys(keys[last])}
    order = forest.preorder()
    m, leaves, saved = {}, {}, {}
    kept = {}  # saved by kids, without the node's own chain
    for v, u in reversed(order):
        lo, kids = forest.lo[v], forest.kids[v]
        m[v] = min([ids[i] for i in forest.ends[v]] + [m[k] for k in kids])
        leaves[v] = sum(leaves[k] for k in kids) or 1
        kept[v] = sum(saved[k] for k in kids)
        above = forest.depth[u] if u >= 0 else 0
        at = int(offsets[lo])
        saved[v] = kept[v] + (forest.hi[v] - lo) * int(total[at + forest.depth[v]] - total[at + above])

    def is_open(v: int) -> bool:
        return forest.lo[v] == 0 or forest.hi[v] == last

    out = []
    for v, u in order:
        lo, hi, d, kids = forest.lo[v], forest.hi[v], forest.depth[v], forest.kids[v]
        chain = range(forest.depth[u] + 1 if u >= 0 else 0, d + 1)
        at, ends = int(offsets[lo]), [ids[i] for i in forest.ends[v]]
        if is_open(v):
            done = [k for k in kids if not is_open(k)]
            sides = [(i, s) for i, s in ((0, 0), (last, 1)) if lo <= i <= hi and (s == 0 or last > 0)]
            for e in chain:
                full = e == d
                c = int(total[at + e] - total[at + e - 1]) if e else 0
                for first, (i, side) in enumerate(sides):
                    mine = first == 0
                    out.append((OPEN, e, m[v], None, paths[i][e - 1] if e else None, paths[i][e], ids[i], side, (hi - lo + 1) * mine,
                                len(done) * (full and mine), sum(leaves[k] for k in done) * (full and mine),
                                sum(saved[k] for k in done) * (full and mine), c, None))
            key = paths[sides[0][0]][d]
            out.extend((END, d, i, None, None, key, None, None, None, None, None, None, None, None) for i in ends)
            continue
        for e in chain:
            top = e == chain.start
            hangs = top and is_open(u)
            parent = m[v] if not top else None if hangs else m[u]
            side = 0 if forest.lo[u] == 0 else last
            out.append((CLOSED, e, m[v], parent, paths[side][e - 1] if hangs else None, None, None, None, hi - lo + 1,
                        len(kids) if e == d else 1, leaves[v], kept[v] + (hi - lo) * int(total[at + d] - total[at + e - 1]),
                        None, ends_hash(ends) if e == d else EMPTY))
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends) from (key, conv_id) rows sorted by both: one running hash."""
    key, h = None, None
    for b in batches:
        keys, hashes = [], []
        for k, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != key:
                if key is not None:
                    keys.append(key)
                    hashes.append(h.hexdigest())
                key, h = k, hashlib.sha256(str(i).encode())
            else:
                h.update(f",{i}".encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hashes, pa.string())], ["ekey", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()], pa.string())], ["ekey", "ends"])


def prefix_trie(seqs: DataFrame, block: int = BLOCK, broadcast: int = BROADCAST) -> DataFrame:
    """One row per node of the trie of ``seqs`` (conv_id, seq as made by
    ``sequences``; one row per id): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The root is a node as soon as there is any conversation; an empty table
    has none. Conversations without turns end at the root. Equal
    conversations end at one node; a conversation that others go on from
    ends at an inner one. A conversation of any length is one row of 20
    bytes a turn.
    """
    key = F.unhex(F.array_join(F.transform("seq", lambda t: t["d"]), ""))
    rows = seqs.select("conv_id", key.alias("key"), F.transform("seq", lambda t: t["c"].cast("int")).alias("chars"))
    rows = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, block):
                b = whole.slice(at, block)
                lists = b.column(2)
                off = lists.offsets.to_numpy()
                yield _batch(solve_block(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                         lists.flatten().to_numpy(zero_copy_only=False), off - off[0]))

    forest = cut(rows.mapInArrow(solve, _FOREST))
    places = forest.where(F.col("kind") == OPEN)
    merged = places.groupBy("depth", "key").agg(
        F.max("parent_key").alias("parent_key"), F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.sum("kids").alias("kids"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("chars").alias("chars"),
        F.min(F.struct("path", "side")).alias("owner"))
    merged = cut(merged)
    below = merged.groupBy(F.col("parent_key").alias("of")).agg(F.count(F.lit(1)).alias("open_kids")).where("of is not null")
    kids = F.col("kids") + F.coalesce("open_kids", F.lit(0))
    own = merged.join(below, merged["key"] == below["of"], "left").select(
        "depth", "key", "parent_key", "conv_id", "n", "owner", kids.alias("kids"),
        (F.col("leaves") + F.when(kids == 0, 1).otherwise(0)).alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * F.col("chars")).alias("saved"))
    mine = F.struct("path", "side") == F.col("owner")
    up = W.partitionBy("path", "side").orderBy(F.desc("depth")).rowsBetween(W.unboundedPreceding, 0)
    on_path = places.select("path", "side", "depth", "key").join(own.select("depth", "key", "owner", "leaves", "saved"), ["depth", "key"])
    subtree = (on_path.select("depth", "key", F.sum(F.when(mine, F.col("leaves")).otherwise(0)).over(up).alias("l"),
                              F.sum(F.when(mine, F.col("saved")).otherwise(0)).over(up).alias("s"))
               .groupBy("depth", "key").agg(F.sum("l").alias("n_leaves"), F.sum("s").alias("saved_tokens")))
    ends = (forest.where(F.col("kind") == END).select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
            .mapInArrow(_hash_ends, "ekey binary, ends string"))
    nodes = cut(own.select("depth", "key", "parent_key", "conv_id", "n", "kids").join(subtree, ["depth", "key"]))
    few = nodes.count() <= broadcast
    names = nodes.select(F.col("key").alias("pkey"), F.col("conv_id").alias("of_open"))
    names = F.broadcast(names) if few else names

    def finish(df: DataFrame, parent) -> DataFrame:
        return df.join(names, F.col("parent_key") == F.col("pkey"), "left").select(
            "conv_id", "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", "ends_sha256")

    top = nodes.join(ends, F.col("key") == F.col("ekey"), "left").withColumns(
        {"n_children": F.col("kids"), "ends_sha256": F.coalesce("ends", F.lit(EMPTY))})
    closed = forest.where(F.col("kind") == CLOSED).withColumnsRenamed(
        {"kids": "n_children", "leaves": "n_leaves", "saved": "saved_tokens", "ends": "ends_sha256"})
    return finish(closed, F.coalesce("parent_conv", "of_open")).unionByName(finish(top, F.col("of_open")))


def rebuilt(seqs: DataFrame, every: int = 100, at_most: int = 5) -> DataFrame:
    """Every conversation c with its first h = crc32(decimal c) % (at_most + 1)
    turns replaced by those of conversation c - c % every."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (at_most + 1)).cast("int")
    donor = seqs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("d_id"), F.slice("seq", 1, at_most).alias("d_seq"))
    none = F.expr("cast(array() as array<struct<d: string, c: int>>)")
    c = seqs.withColumn("h", h).join(donor, F.col("conv_id") - F.col("conv_id") % every == F.col("d_id"), "left")
    return c.select("conv_id", F.concat(F.slice(F.coalesce("d_seq", none), F.lit(1), F.col("h")),
                                        F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq"), F.lit(1)))).alias("seq"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie of the rebuilt ``conversations``."""
    return prefix_trie(rebuilt(sequences(table(spark, sf_dir, "conversations"))))


OP11_SQL = f"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
         lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS t),
conv AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295, bytes), lambda r, b: xor(r >> 8, t[(xor(r, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT conv_id AS c, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes
        FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)), crc_table),
said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
digested AS (SELECT conv_id, turn, role, sha256(length(role) || ':' || role || text) AS d, length(text) AS n FROM said),
numbered AS (
  SELECT conv_id, d, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, d) AS i FROM digested),
own AS (
  SELECT c, 0 AS part, i, d, n FROM conv JOIN numbered ON conv_id = c - c % 100 AND i <= h
  UNION ALL SELECT c, 1, i, d, n FROM conv JOIN numbered ON conv_id = c AND i > h),
placed AS (
  SELECT c, n, row_number() OVER conversation AS depth, sha256(string_agg(d, '') OVER conversation) AS k
  FROM own WINDOW conversation AS (PARTITION BY c ORDER BY part, i ROWS UNBOUNDED PRECEDING)),
prefix AS (
  SELECT c, depth, k, n, coalesce(lag(k) OVER conversation, '') AS parent, lead(k) OVER conversation IS NULL AS ends
  FROM placed WINDOW conversation AS (PARTITION BY c ORDER BY depth)
  UNION ALL SELECT c, 0, '', 0, NULL, NOT EXISTS (SELECT 1 FROM own WHERE own.c = conv.c) FROM conv),
node AS (
  SELECT k, depth, min(c) AS conv_id, count(*) AS n_convs, max(n) AS n, max(parent) AS parent,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '') AS ends FROM prefix GROUP BY k, depth),
kids AS (SELECT parent AS k, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT up.k, count(*) FILTER (kids.k IS NULL) AS n_leaves, sum((node.n_convs - 1) * node.n) AS saved_tokens
  FROM node JOIN prefix up ON up.c = node.conv_id AND up.depth <= node.depth LEFT JOIN kids ON kids.k = node.k GROUP BY up.k)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, above.conv_id AS parent_conv_id, node.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(node.ends) AS ends_sha256
FROM node LEFT JOIN node above ON above.k = node.parent LEFT JOIN kids ON kids.k = node.k JOIN below ON below.k = node.k
"""
