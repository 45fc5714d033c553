"""Prefix trie of conversations in balanced parentheses, shard by shard (operator 13).

A conversation becomes its path: 16 bytes (MD5 of role and text) for each turn, and
the byte lengths of the texts. Sorted by path, conversations stand in the depth-first
order of the trie, so a range of them holds a connected part of it. Ranges are dealt
by (path, conv_id): copies of one conversation, however many, spread over tasks.

A task cuts its range into shards of a bounded number of turns. A shard's trie is
written as balanced parentheses (``parens``): from one conversation to the next,
what they do not share is closed and opened. ``close_of`` delimits the subtree of
every node; rank counts the nodes and the pairs ``()``, that is the leaves, in it;
differences of cumulative arrays over the nodes in order give members and savings.

Nodes on the path of a shard's first or last conversation, its spines, may go on in
the shards beside it. They are merged by their identity (MD5 of the path so far).
Members, children, leaves and savings add up over shards once each border between
shards is accounted for: what the conversations on either side share was opened
twice, and a leaf that goes on was none. Such corrections are rows like the parts of
spines, so that one aggregation merges everything. All other nodes are final in
their shard and are not shuffled, but for the children of spines, which get their
parent's least member by a join.

``ends_sha256`` of a spine node reads its member ids in pieces, one for each shard,
in order and as a stream.

Bounds: a conversation is one row, as a text is (20 bytes a turn); a shard holds
``SHARD_TURNS`` turns or one conversation; per task border two paths meet in one
window.

Defined results: null role or text is empty; turns are taken by turn (null first),
equal turns by digest; repeated rows are turns of their own; rows without conv_id
belong to no conversation and are left out; an empty table has no nodes, not even
the root; other columns are ignored; c % 5 has the sign of c.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gatetally.llm.parens import Bits, Parens
from gatetally.llm.shared import ship, stored

#: Conversations are rebuilt in groups of so many ids, from up to HEAD - 1 turns of the first.
GROUP, HEAD = 5, 9
#: Turns of a shard.
SHARD_TURNS = 1 << 19
#: Rows of one batch from a shard.
BATCH = 20_000

_STEP = 16
_EMPTY = hashlib.sha256(b"").hexdigest()
_ROOT = hashlib.md5(b"").digest()

NODES = """kind int, part int, shard int, node binary, parent binary, conv_id long, depth long, parent_conv_id long,
    n_convs long, n_children long, n_leaves long, saved long, size long, ends_sha256 string, ends binary,
    path binary, sizes array<int>"""
#: Kinds of rows: nodes that are final, parts of spines (and corrections), first and last paths of a task.
FINAL, PART, FIRST, LAST = range(4)


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, path, sizes) of ``turns`` (conv_id, turn, role, text), as they are."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # The length of the role keeps (ab, c) and (a, bc) apart.
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", digest.alias("digest"), F.octet_length(text).alias("size")).alias("at"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("at")).alias("at"))
    return whole.select("conv_id", F.unhex(F.array_join("at.digest", "")).alias("path"), F.col("at.size").alias("sizes"))


def rebuilt(convs: DataFrame, group: int = GROUP, head: int = HEAD) -> DataFrame:
    """``convs`` with their first h turns taken from the first conversation of their group of ids."""
    first = convs.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"),
        F.substring("path", 1, _STEP * (head - 1)).alias("base_path"),
        F.slice("sizes", 1, head - 1).alias("base_sizes"),
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head).cast("int")
    joined = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(first, "base", "left")

    def spliced(ours: str, theirs: Column, taken) -> Column:
        return F.concat(taken(theirs, F.lit(1), h), taken(F.col(ours), h + 1, F.size("sizes")))

    path = spliced(
        "path",
        F.coalesce("base_path", F.lit(b"")),
        lambda x, at, n: F.substring(x, (at - 1) * _STEP + 1, n * _STEP),
    )
    sizes = spliced("sizes", F.coalesce("base_sizes", F.array().cast("array<int>")), F.slice)
    return joined.select("conv_id", path.alias("path"), sizes.alias("sizes"))


def shared_turns(a: bytes, b: bytes) -> int:
    """How many turns two paths have in common at their start."""
    n = min(len(a), len(b)) // _STEP
    if a[: n * _STEP] == b[: n * _STEP]:
        return n
    x, y = (np.frombuffer(p, "<u8", 2 * n) for p in (a, b))
    return int(np.argmax(x != y)) // 2


def node_names(path: bytes, upto: int) -> list[bytes]:
    """The identities of the nodes on a path, from the root to depth ``upto``."""
    names, h = [_ROOT], hashlib.md5()
    for d in range(upto):
        h.update(path[d * _STEP : (d + 1) * _STEP])
        names.append(h.copy().digest())
    return names


def border_rows(last: tuple, first: tuple) -> dict[str, list]:
    """Corrections where conversation ``last`` (path, sizes) of a shard is followed by ``first`` of the next."""
    path, sizes = last
    common = shared_turns(path, first[0])
    names = node_names(path, common)
    twice = np.array([0, *sizes[:common]], np.int64)
    goes_on = common == len(sizes)
    return {
        "node": names,
        "parent": [None, *names[:-1]],
        "depth": list(range(common + 1)),
        "size": [0, *sizes[:common]],
        "n_convs": [0] * (common + 1),
        "n_children": [-1] * common + [0],
        "n_leaves": [-1 if goes_on else 0] * (common + 1),
        # A shared text was taken off once in each shard.
        "saved": np.cumsum(twice[::-1])[::-1].tolist(),
    }


def trie(paths: list[bytes], ids: np.ndarray, sizes: list) -> dict[str, np.ndarray]:
    """The trie of conversations sorted by path, its nodes in depth-first order with the root first."""
    turns = [len(p) // _STEP for p in paths]
    common = [0, *map(shared_turns, paths, paths[1:])]
    on_path, runs, parents, depths, of, ends = [0], [1], [-1], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], []
    n, depth = 1, 0
    for length, kept, size in zip(turns, common, sizes, strict=True):
        new = length - kept
        runs += (depth - kept, new)
        if new:
            parents.append(on_path[kept])
            parents.extend(range(n, n + new - 1))
            on_path[kept + 1 :] = range(n, n + new)
            depths.append(np.arange(kept + 1, length + 1))
            of.append(np.asarray(size[kept:], np.int64))
            n += new
        else:
            del on_path[length + 1 :]
        ends.append(on_path[length])
        depth = length
    runs.append(depth + 1)
    bits = np.repeat(np.resize(np.array([1, 0], np.uint8), len(runs)), runs)
    parens, leaves = Parens(bits), Bits(bits[:-1] & ~bits[1:] & 1)

    opens = np.flatnonzero(bits)
    closes = parens.close_of(opens)
    after = parens.rank(closes)  # nodes opened before the close: the subtree is a range of nodes
    here = np.arange(n)
    own = np.asarray(ends, np.int64)
    ended = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=n))])
    members = ended[after] - ended[:-1]
    size = np.concatenate(of)
    gain = np.concatenate([[0], np.cumsum((members - 1) * size)])
    parent = np.asarray(parents, np.int64)
    # Members of a node are a range of the sorted conversations, and the last range may end with them.
    spans = np.stack([ended[:-1], ended[after]], 1).ravel()
    return {
        "depth": np.concatenate(depths),
        "parent": parent,
        "size": size,
        "n_convs": members,
        "n_children": np.bincount(parent[1:], minlength=n),
        "n_leaves": leaves.rank(closes) - leaves.rank(opens),
        "saved": gain[after] - gain[here],
        "conv_id": np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), spans)[::2],
        "ends": ended,
        "last_path": np.asarray(on_path, np.int64),
    }


_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("part", pa.int32()), ("shard", pa.int32()), ("node", pa.binary()), ("parent", pa.binary())]
    + [(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves")]
    + [("saved", pa.int64()), ("size", pa.int64()), ("ends_sha256", pa.string()), ("ends", pa.binary())]
    + [("path", pa.binary()), ("sizes", pa.list_(pa.int32()))]
)


def _batch(n: int, **columns) -> pa.RecordBatch:
    """Columns not given are null; single values go to all ``n`` rows."""
    made = []
    for field in _SCHEMA:
        value = columns.get(field.name)
        if isinstance(value, list | np.ndarray):
            made.append(pa.array(value, field.type))
        else:
            made.append(pa.repeat(pa.scalar(value, field.type), n))
    return pa.RecordBatch.from_arrays(made, schema=_SCHEMA)


def shard_rows(part: int, shard: int, paths: list[bytes], ids: np.ndarray, sizes: list) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard: final ones, and the parts on its first and last path."""
    t = trie(paths, ids, sizes)
    n = len(t["parent"])
    # Depth-first, the first path is the first nodes, down to the first conversation's end.
    spine = {v: None for v in range(len(paths[0]) // _STEP + 1)} | {v: None for v in t["last_path"].tolist()}
    names = dict(zip(spine, node_names(paths[0], len(paths[0]) // _STEP), strict=False))
    names |= zip(t["last_path"].tolist(), node_names(paths[-1], len(paths[-1]) // _STEP), strict=True)
    on_spine = np.zeros(n, bool)
    on_spine[list(spine)] = True
    ends = t["ends"]
    numbers = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved")

    def text(v: int) -> bytes:
        return b",".join(b"%d" % i for i in ids[ends[v] : ends[v + 1]].tolist()) if ends[v] < ends[v + 1] else b""

    some = np.array(sorted(spine))
    parents = t["parent"][some].tolist()
    yield _batch(
        len(some),
        kind=PART,
        part=part,
        shard=shard,
        node=[names[v] for v in some.tolist()],
        parent=[names.get(p) for p in parents],
        size=t["size"][some],
        ends=[text(v) or None for v in some.tolist()],
        **{c: t[c][some] for c in numbers},
    )
    rest = np.flatnonzero(~on_spine)
    for a in range(0, len(rest), BATCH):
        some = rest[a : a + BATCH]
        parents = t["parent"][some]
        below = on_spine[parents]
        yield _batch(
            len(some),
            kind=FINAL,
            parent=[names[p] if s else None for p, s in zip(parents.tolist(), below.tolist(), strict=True)],
            parent_conv_id=pa.array(t["conv_id"][parents], mask=below).to_pylist(),
            ends_sha256=[hashlib.sha256(x).hexdigest() if (x := text(v)) else _EMPTY for v in some.tolist()],
            **{c: t[c][some] for c in numbers},
        )


def build(shard_turns: int):
    """For ``mapInArrow`` over conversations sorted by path: rows of all kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        ids, paths, sizes, held = [], [], [], 0
        last = None

        def edge(kind: int, path: bytes, size: list) -> pa.RecordBatch:
            return _batch(1, kind=kind, part=part, path=[path], sizes=[size])

        def close() -> Iterator[pa.RecordBatch]:
            if last is None:
                yield edge(FIRST, paths[0], sizes[0])
            else:
                fixed = border_rows(last, (paths[0], sizes[0]))
                yield _batch(len(fixed["node"]), kind=PART, part=part, shard=shard, **fixed)
            yield from shard_rows(part, shard, paths, np.array(ids, np.int64), sizes)

        for batch in batches:
            for conv, path, size in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "sizes")), strict=True):
                ids.append(conv)
                paths.append(path)
                sizes.append(size)
                held += len(size) + 1
                if held >= shard_turns:
                    yield from close()
                    last, shard, held = (path, size), shard + 1, 0
                    ids, paths, sizes = [], [], []
        if ids:
            yield from close()
            last = paths[-1], sizes[-1]
        if last is not None:
            yield edge(LAST, *last)

    return run


def between_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (path, sizes, next_path, next_sizes) at the border of two tasks to corrections."""
    for batch in batches:
        for r in batch.to_pylist():
            fixed = border_rows((r["path"], r["sizes"]), (r["next_path"], r["next_sizes"]))
            yield _batch(len(fixed["node"]), kind=PART, **fixed)


def hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From pieces of member lists, sorted by node and shard, to one digest for each node."""
    node = digest = None
    for batch in batches:
        names, sums = [], []
        for name, piece in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if name == node:
                digest.update(b",")
                digest.update(piece)
                continue
            if node is not None:
                names.append(node)
                sums.append(digest.hexdigest())
            node, digest = name, hashlib.sha256(piece)
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sums)], names=["node", "sum"])
    if node is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "sum"]
        )


def nodes(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node of the trie of ``convs`` (conv_id, path, sizes)."""
    ship(convs.sparkSession)
    in_order = convs.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    rows = stored(in_order.mapInArrow(build(shard_turns), NODES), "nodes")

    parts = rows.where(F.col("kind") == PART)
    # Two rows for each task: its first and its last path, in the order of the ranges.
    edges = rows.where(F.col("kind").isin(FIRST, LAST)).select("kind", "part", "path", "sizes")
    onward = Window.orderBy("part", "kind")
    paired = edges.select(
        "*", F.lead("path").over(onward).alias("next_path"), F.lead("sizes").over(onward).alias("next_sizes")
    )
    fixed = paired.where((F.col("kind") == LAST) & F.col("next_path").isNotNull()).mapInArrow(between_tasks, NODES)
    summed = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    spine = stored(
        parts.unionByName(fixed)
        .groupBy("node")
        .agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"), *summed),
        "spine",
    )
    pieces = parts.where("ends IS NOT NULL").select("node", "part", "shard", "ends")
    sums = (
        pieces.repartition("node")
        .sortWithinPartitions("node", "part", "shard")
        .mapInArrow(hashed_ends, "node binary, sum string")
    )
    upper = spine.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    final = rows.where(F.col("kind") == FINAL)
    merged = spine.join(sums, "node", "left").withColumn("ends_sha256", F.coalesce("sum", F.lit(_EMPTY)))
    return (
        final.where("parent IS NULL")
        .select(columns)
        .unionByName(final.where("parent IS NOT NULL").drop("parent_conv_id").join(upper, "parent").select(columns))
        .unionByName(merged.join(upper, "parent", "left").select(columns))
        .withColumnRenamed("saved", "saved_tokens")
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt within their groups of ids."""
    ship(spark)
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    # Both sides of the join and the ranges read the paths: they are made once.
    return nodes(rebuilt(stored(conversations(turns), "paths")))


#: Nodes are lists of (role, text); the checksum has the reflected polynomial 0xEDB88320.
OP13_SQL = """
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), convs AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST,
      md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
  SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      range(strlen(conv_id::VARCHAR)), lambda i: ('0x' || substr(hex(encode(conv_id::VARCHAR)), 2 * i + 1, 2))::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM convs, crc_table
), paths AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:h], c.turns[h + 1:]) AS path
  FROM heads c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 5
), prefixes AS (
  SELECT conv_id, path[1:d] AS node, d AS depth, d = len(path) AS at_end,
    CASE WHEN d > 0 THEN strlen(path[d].text) ELSE 0 END AS size
  FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM paths)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (at_end), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth
), families AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
  SELECT node[1:d] AS node, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM (SELECT n.node, n_convs, size, n_children, unnest(range(depth + 1)) AS d
        FROM nodes n LEFT JOIN families f ON f.node = n.node)
  GROUP BY 1
)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id,
  n.n_convs::BIGINT AS n_convs, coalesce(f.n_children, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves,
  b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN families f ON f.node = n.node
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]
"""
