"""Join of documents with similar sets of word shingles by an R-tree of count vectors (operator 4).

Two documents link if the Jaccard index of their shingle sets is at least
``PERCENT`` / 100. All links are found; the result names each document's
component.

1. Each document becomes a set of 64-bit shingle hashes. Equal sets are one
   *node*, named by a 64-bit hash of the set; copies go no further.
2. A pair that links shares a shingle among the first ``n - ceil(0.85 n) + 1``
   of either set in any common order. The order puts frequent shingles last (by
   a fixed-size table of bucket counts over all documents), so a line or passage
   that many documents have is looked up by none of them. The rows of a shingle
   that several nodes share form a bucket.
3. The tokens of a set are dealt into ``GROUPS`` groups by hash; the counts by
   group are a point. For two points the sum of the smaller coordinates bounds
   the overlap. Each bucket is an R-tree over its points whose boxes hold the
   largest counts and the range of set sizes; a join of the tree with itself
   leaves out pairs of boxes whose bound is below the overlap that a link needs.
4. Round one takes for each node one partner in each bucket, the one of least hash
   among those in the upper half of its bounds (so that buckets agree on it), and
   bounds it again by ``FINE`` groups. It is not told where the two also meet in a bucket
   of a lesser token, by the first ``LEADS`` tokens that each shares with others: the node
   has told a partner there. Round two, over all nodes with a partner in the tree
   (whether or not the one taken passed the finer bound) and with ``FINE`` groups,
   takes for any two components of round one's links the best pair that passes in a
   bucket. Round three takes all pairs that still pass between different components.
   In a group of thousands of near copies nearly all pairs are joined before round
   three, so it is not all pairs of a group that are made, and no link is left out.
   These rounds too take a pair only in the first bucket where its leads meet, and read
   only buckets that still have different components. All are verified on their texts.
   Buckets are chosen by tokens and nodes alone; points come to the rows that are left.

Buckets of more than ``BLOCK`` rows are cut into blocks: round one looks into
each block, the later rounds into each pair of blocks, as separate rows of the
shuffle. All nodes of such a bucket enter the later rounds, as round one may not
have met their partners. So no task gathers more than two blocks. Links become components by aggregations
and joins; nothing but the order's table, of at most ``1 << SKETCH_BITS`` counts,
reaches the driver.

Defined results: null and empty texts and texts without words have the empty set,
link with nothing and are their own component (null doc_id: null); repeated rows
have the same set and component; a component's name is the least non-null doc_id;
other columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatetally.llm.bytehash import NOT_SPACE, Hashed, joined, lowered, mixed, runs
from gatetally.llm.components import components
from gatetally.llm.shared import documents, returning, stored, whole_text
from gatetally.llm.wordmemo import chunks

#: Words of a shingle, least similarity in percent.
WORDS, PERCENT = 4, 85
#: Groups of the points in the tree, and of the finer points (a multiple).
GROUPS, FINE = 64, 256
#: Rows of a bucket that may meet in one task, entries of a box, characters taken at once.
BLOCK, FAN, CHUNK = 4000, 32, 1_500_000
#: Tokens of a node, the least of those it shares, by which pairs that meet before are known.
LEADS = 4
#: Bits of the table that tells which texts may be asked for: 2 MB at most.
NAME_BITS = 24
#: Buckets of the frequency table; those above this many times the mean count of a task are frequent,
#: if it met them so often at least: few texts in a task say nothing about a shingle.
SKETCH_BITS, FREQUENT, OFTEN = 20, 4, 16

#: Stands for a null doc_id.
_LAST = (1 << 63) - 1

_U = np.uint64


class Sets:
    """Shingle sets of texts: sorted by text and hash, without repeats."""

    def __init__(self, texts: list[str], words: int = WORDS):
        data, at = joined(texts)
        data = lowered(data)
        starts, ends = runs(NOT_SPACE[data])
        word = Hashed(data).spans(starts, ends)
        text = np.searchsorted(at, starts, "right") - 1
        count = np.bincount(text, minlength=len(texts))
        # The words of a shingle are chained; a text of fewer words is one shingle of all of them.
        first = np.cumsum(count) - count
        step = np.minimum(count, words)
        full = np.flatnonzero(np.arange(len(word)) + step[text] <= (first + count)[text])
        h = mixed(step[text[full]].astype(_U))
        for i in range(words):
            more = i < step[text[full]]
            following = word[np.minimum(full + i, max(0, len(word) - 1))]
            h = np.where(more, mixed(h * _U(0x9E3779B97F4A7C15) + following), h)
        own = text[full]
        order = np.lexsort((h, own))
        h, own = h[order], own[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
        self.hashes, self.text = h[new], own[new]
        self.sizes = np.bincount(self.text, minlength=len(texts))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    def nodes(self) -> np.ndarray:
        """A hash of each set."""
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(mixed(self.hashes ^ _U(0x5851F42D4C957F2D)))])
        return mixed(sums[self.starts[1:]] - sums[self.starts[:-1]] + self.sizes.astype(_U))

    def points(self, groups: int) -> np.ndarray:
        """Counts by group of each set."""
        place = self.text * groups + (self.hashes & _U(groups - 1)).astype(np.int64)
        return np.bincount(place, minlength=len(self.sizes) * groups).reshape(-1, groups)

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.starts[i] : self.starts[i + 1]]


def packed(points: np.ndarray) -> list[bytes]:
    """Points in the least width that holds them: four bits, a byte or four for each count."""
    most = points.max(1, initial=0)
    bytes_ = points.astype(np.uint8)
    half = bytes_[:, ::2] | bytes_[:, 1::2] << 4
    return [
        (h if m < 16 else b if m < 256 else p.astype("<u4")).tobytes()
        for h, b, p, m in zip(half, bytes_, points, most.tolist(), strict=True)
    ]


def unpacked(raw: list[bytes], groups: int) -> np.ndarray:
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    out = np.empty((len(raw), groups), np.int32)
    for width in np.unique(size).tolist():
        at = np.flatnonzero(size == width)
        data = np.frombuffer(b"".join([raw[i] for i in at.tolist()]), "<u4" if width > groups else np.uint8).reshape(len(at), -1)
        if width < groups:
            out[at, ::2], out[at, 1::2] = data & 15, data >> 4
        else:
            out[at] = data
    return out


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of sets of sizes ``a`` and ``b`` that link."""
    return -(-percent * (a + b) // (100 + percent))


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can link."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


class RTree:
    """Points packed into boxes of ``FAN`` entries, level by level."""

    def __init__(self, sizes: np.ndarray, points: np.ndarray):
        self.order = np.lexsort((*points.T[:3], sizes))
        self.levels = [(sizes[self.order], sizes[self.order], points[self.order])]
        while len(self.levels[-1][0]) > FAN:
            low, high, top = self.levels[-1]
            cut = np.arange(0, len(low), FAN)
            self.levels.append(
                (np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(top, cut, axis=0))
            )

    def _passing(self, level: int, a: slice, b: slice, percent: int) -> tuple[np.ndarray, ...]:
        """Entries of ``a`` and ``b`` that may hold linked points, and the bound."""
        low, high, top = self.levels[level]
        i, j = np.nonzero(
            (100 * high[a][:, None] >= percent * low[b][None, :])
            & (100 * high[b][None, :] >= percent * low[a][:, None])
        )
        if a == b:
            i, j = i[i <= j], j[i <= j]
        bound = np.minimum(top[a][i], top[b][j]).sum(1)
        ok = bound >= needed(low[a][i], low[b][j], percent)
        return i[ok] + a.start, j[ok] + b.start, bound[ok]

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs of points that pass, a pair of boxes at a time, and their bounds."""
        top = len(self.levels) - 1
        whole = slice(0, len(self.levels[top][0]))
        open_ = [(top, whole, whole)]
        while open_:
            level, a, b = open_.pop()
            i, j, bound = self._passing(level, a, b, percent)
            if not level:
                apart = i != j
                yield self.order[i[apart]], self.order[j[apart]], bound[apart]
                continue
            n = len(self.levels[level - 1][0])
            box = lambda x: slice(x * FAN, min(n, (x + 1) * FAN))  # noqa: E731, B023
            open_ += [(level - 1, box(x), box(y)) for x, y in zip(i.tolist(), j.tolist(), strict=True)]


def _set_batches(bits: int, words: int):
    """A function for ``mapInArrow``: node, size and points of each text; at the end of a task its frequent buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in ("doc", "crc", "node", "n")])
        schema = schema.append(pa.field("point", pa.binary())).append(pa.field("fine", pa.binary()))
        counts = np.zeros(1 << bits, np.int64)
        for batch in batches:
            texts, docs, crcs = batch.column("text").to_pylist(), batch.column("doc"), batch.column("crc")
            for a, b in chunks(texts, CHUNK):
                sets = Sets(texts[a:b], words)
                counts += np.bincount((sets.hashes >> _U(64 - bits)).astype(np.int64), minlength=len(counts))
                fine = sets.points(FINE)
                point = fine.reshape(len(fine), -1, GROUPS).sum(1)
                nodes, sizes = sets.nodes().view(np.int64), sets.sizes.astype(np.int64)
                columns = [docs.slice(a, b - a), crcs.slice(a, b - a), pa.array(nodes), pa.array(sizes)]
                columns += [pa.array(packed(point), pa.binary()), pa.array(packed(fine), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        some = np.flatnonzero(counts > max(OFTEN, FREQUENT * counts.mean()))
        none = pa.nulls(len(some), pa.binary())
        absent = pa.nulls(len(some), pa.int64())
        columns = [pa.array(some), absent, absent, pa.array(counts[some]), none, none]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _prefix_batches(frequent, bits: int, percent: int, words: int):
    """A function for ``mapInArrow``: the shingles by which each set is looked up, once for each set of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = frequent.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts, CHUNK):
                sets = Sets(texts[a:b], words)
                nodes = sets.nodes()
                once = np.zeros(len(nodes), bool)
                once[np.unique(nodes, return_index=True)[1]] = True
                count = table[(sets.hashes >> _U(64 - bits)).astype(np.int64)]
                order = np.lexsort((sets.hashes, count, sets.text))
                rank = np.arange(len(order)) - sets.starts[sets.text]
                length = sets.sizes - (percent * sets.sizes + 99) // 100 + 1
                use = (rank < length[sets.text]) & once[sets.text]
                token, node = sets.hashes[order][use], nodes[sets.text][use]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token.view(np.int64)), pa.array(node.view(np.int64))], names=["token", "node"]
                )

    return run


def _shared_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token and node: distinct ones whose token has several nodes."""
    held: tuple[int, int] | None = None  # the last row
    told = False  # whether it was passed on
    for batch in batches:
        token, node = (batch.column(c).to_numpy() for c in ("token", "node"))
        if held is not None:
            token, node = np.append(held[0], token), np.append(held[1], node)
        elif not len(token):
            continue
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        token, node = token[new], node[new]
        same = token[1:] == token[:-1]
        keep = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        last = bool(keep[-1])
        if held is not None:
            last = last or (len(token) == 1 and told)
            keep[0] &= not told
        out = np.flatnonzero(keep)
        yield pa.RecordBatch.from_arrays([pa.array(token[out]), pa.array(node[out])], names=["token", "node"])
        held, told = (int(token[-1]), int(node[-1])), last


class Bucket:
    """Rows of one or many buckets, sorted by bucket."""

    def __init__(self, table: pa.Table, groups: int):
        get = lambda c: table.column(c).to_numpy()
        self.node, self.n, self.label, self.part = (get(c) for c in ("node", "n", "label", "part"))
        self.points = unpacked(table.column("point").to_pylist(), groups)
        self.lead = table.column("lead").combine_chunks().flatten().to_numpy().reshape(-1, LEADS)
        token, lo, hi = (get(c) for c in ("token", "lo", "hi"))
        self.token, self.apart = token, lo != hi
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
        self.first = np.flatnonzero(new)
        self.count = np.diff(np.append(self.first, len(token)))

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows whose points pass in some bucket, in different components and, between two blocks, one in each."""
        for i, j, bound in self._passing(percent):
            ok = (self.label[i] != self.label[j]) & (~self.apart[i] | (self.part[i] != self.part[j]))
            yield i[ok], j[ok], bound[ok]

    def met(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether rows of one bucket have a lead in common that comes before its token."""
        before = self.lead[i] < self.token[i][:, None]
        return ((self.lead[i][:, :, None] == self.lead[j][:, None, :]) & before[:, :, None]).any((1, 2))

    def _passing(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for m in range(2, 9):  # small buckets of one size together: one box each
            first = self.first[self.count == m]
            for x in range(m if len(first) else 0):
                for y in range(x):
                    i, j = first + y, first + x
                    fit = alike(self.n[i], self.n[j], percent) & (self.label[i] != self.label[j])
                    i, j = i[fit], j[fit]
                    bound = np.minimum(self.points[i], self.points[j]).sum(1)
                    ok = bound >= needed(self.n[i], self.n[j], percent)
                    yield i[ok], j[ok], bound[ok]
        for first, m in zip(self.first.tolist(), self.count.tolist(), strict=True):
            if m > 8:
                rows = slice(first, first + m)
                for i, j, bound in RTree(self.n[rows], self.points[rows]).pairs(percent):
                    yield i + first, j + first, bound


#: Which candidate pairs of a bucket go on: one for each node, the best of each two components, or all.
NODES, COMPONENTS, ALL = "nodes", "components", "all"


def _candidate_batches(pick: str, percent: int, groups: int):
    """A function for ``mapInArrow`` over rows sorted by bucket: candidate pairs of nodes."""

    def found(table: pa.Table) -> pa.RecordBatch:
        rows = Bucket(table, groups)
        parts = []
        for i, j, bound in rows.pairs(percent):
            # For NODES the choice comes first: a node's partner is left out only where it has told one before.
            new = np.ones(len(i), bool) if pick == NODES else ~rows.met(i, j)
            if new.any():
                parts.append((i[new], j[new], bound[new]))
        none = np.zeros(0, np.int64)
        i, j, bound = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (none, none, none)
        share = bound / needed(rows.n[i], rows.n[j], percent)
        if pick == COMPONENTS and len(i):
            low, high = np.minimum(rows.label[i], rows.label[j]), np.maximum(rows.label[i], rows.label[j])
            order = np.lexsort((rows.node[j], rows.node[i], -share, high, low))
            low, high = low[order], high[order]
            new = np.ones(len(i), bool)
            new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            i, j = i[order][new], j[order][new]
        if pick == NODES and len(i):
            # For each row, of the partners with the larger shares of the needed overlap, the one that is least:
            # a node of a cluster then tells the same partner in most of its buckets.
            i, j, share = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([share, share])
            best = np.zeros(len(rows.node))
            np.maximum.at(best, i, share)
            close = 2 * share >= 1 + best[i]
            i, j = i[close], j[close]
            order = np.lexsort((rows.node[j], i))
            i, j = i[order], j[order]
            new = np.ones(len(i), bool)
            new[1:] = i[1:] != i[:-1]
            i, j = i[new], j[new]
            new = ~rows.met(i, j)
            i, j = i[new], j[new]
        u, v = np.minimum(rows.node[i], rows.node[j]), np.maximum(rows.node[i], rows.node[j])
        pair = np.unique(np.stack([u, v], 1), axis=0) if len(u) else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        weight = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            weight += batch.num_rows
            if weight < 3 * BLOCK:
                continue
            table = pa.Table.from_batches(held)
            keys = [table.column(c).to_numpy() for c in ("token", "lo", "hi")]
            same = np.logical_and.reduce([k == k[-1] for k in keys])
            upto = int(np.argmax(same))
            if upto:
                yield found(table.slice(0, upto))
            held = table.slice(upto).combine_chunks().to_batches()
            weight = table.num_rows - upto
        if held:
            yield found(pa.Table.from_batches(held))

    return run


def _bound_batches(percent: int):
    """A function for ``mapInArrow``: pairs whose finer points pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (unpacked(batch.column(c).to_pylist(), FINE) for c in ("fine_u", "fine_v"))
            least = needed(*(batch.column(c).to_numpy() for c in ("n_u", "n_v")), percent)
            ok = pa.array(np.minimum(a, b).sum(1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(ok), batch.column("v").filter(ok)], names=["u", "v"])

    return run


def _verify_batches(percent: int, words: int):
    """A function for ``mapInArrow``: pairs whose texts link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [batch.column(c) for c in ("text_u", "text_v")]
            keep = []
            ends = np.cumsum([sum(x) for x in zip(*(pc.binary_length(c).to_pylist() for c in both), strict=True)])
            cuts = [*np.flatnonzero(np.diff(ends // CHUNK, prepend=-1)).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                distinct: dict[str, int] = {}
                at = [[distinct.setdefault(t, len(distinct)) for t in side.slice(a, b - a).to_pylist()] for side in both]
                sets = Sets(list(distinct), words)
                for x, y in zip(*at, strict=True):
                    p, q = sets.of(x), sets.of(y)
                    shared = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
            ok = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(ok), batch.column("v").filter(ok)], names=["u", "v"])

    return run


def _crowded(rows: DataFrame, block: int) -> DataFrame:
    """(token, m): the few tokens of more than ``block`` of the ``rows`` (token, node)."""
    return rows.groupBy("token").agg(F.count("*").alias("m")).where(F.col("m") > block)


def _told(rows: DataFrame, nodes: DataFrame, percent: int, block: int, groups: int, pick: str) -> DataFrame:
    """The pairs of :func:`_candidates` as the buckets tell them; several may tell the same."""
    parts = F.coalesce(F.ceil(F.col("m") / block), F.lit(1)).cast("int")
    dealt = rows.join(F.broadcast(_crowded(rows, block)), "token", "left").select("token", "node", parts.alias("parts"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node", "token"), "parts").cast("int"))
    # Merged by node, not broadcast: equal points lie side by side in what goes to the buckets, and pack well.
    dealt = dealt.join(nodes.hint("merge"), "node")
    if pick == NODES:
        dealt = dealt.withColumn("lo", F.col("part")).withColumn("hi", F.col("part"))
    else:
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        dealt = dealt.withColumn("other", other)
        dealt = dealt.withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other"))
    columns = ["token", "lo", "hi", "part", "node", "n", "label", "point", "lead"]
    keys = ["token", "lo", "hi"]
    in_order = dealt.select(*columns).repartition(*keys).sortWithinPartitions(*keys)
    return in_order.mapInArrow(returning(_candidate_batches(pick, percent, groups)), "u long, v long")


def _candidates(
    rows: DataFrame, nodes: DataFrame, percent: int, block: int, groups: int, pick: str
) -> DataFrame:
    """Distinct pairs (u, v) of nodes (node, n, point, lead, label) that share a token, differ in label and pass the bound.

    Those that ``pick`` names; with ``NODES`` within each block.
    """
    return _told(rows, nodes, percent, block, groups, pick).distinct()


def _mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Of ``rows`` (token, node) those of nodes with a label whose token has several labels."""
    named = rows.join(labels, "node")
    ends = named.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return named.join(ends.where("low <> high").select("token"), "token").select("token", "node")


def _bounded(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs that pass by the finer points as well."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("fine").alias(f"fine_{x}"))
    return pairs.join(side("u"), "u").join(side("v"), "v").mapInArrow(returning(_bound_batches(percent)), "u long, v long")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()


def _maybe_named(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``rows`` without nearly all that are not among ``names`` (doc, crc), by a table of ``1 << NAME_BITS`` bits.

    What is shuffled to meet the names is then of their size, not of the corpus.
    """
    place = F.pmod(F.xxhash64("doc", "crc"), F.lit(1 << NAME_BITS))
    cell, bit = F.floor(place / 32768).cast("int").alias("cell"), place % 32768
    cells = names.select(cell, bit.alias("bit")).groupBy("cell").agg(F.bitmap_construct_agg("bit").alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    asked = rows.withColumns({"cell": cell, "bit": bit}).join(F.broadcast(cells), "cell")
    return asked.where(F.getbit(byte, F.col("bit") % 8) == 1).select(*rows.columns)


def _verified(pairs: DataFrame, rows: DataFrame, members: DataFrame, percent: int, words: int) -> DataFrame:
    """Of stored ``pairs`` those whose texts, of ``rows`` (doc, crc, text), link; no other texts are moved."""
    sources = members.join(_ends(pairs), "node").groupBy("node").agg(F.min(F.struct("doc", "crc")).alias("row"))
    sources = stored(sources.select("node", "row.doc", "row.crc"), "sources")
    found = _maybe_named(rows, sources).join(sources.hint("merge"), ["doc", "crc"])
    texts = stored(found.select("node", "text").dropDuplicates(["node"]), "texts")
    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")).hint("merge")
    return pairs.join(side("u"), "u").join(side("v"), "v").mapInArrow(returning(_verify_batches(percent, words)), "u long, v long")


def row_name() -> tuple[Column, Column]:
    """A row is named by its doc_id and the checksum of its text, as doc_ids may repeat or be null."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    return doc.alias("doc"), F.crc32(whole_text().cast("binary")).alias("crc")


def similar(
    docs: DataFrame, percent: int = PERCENT, block: int = BLOCK, words: int = WORDS
) -> tuple[DataFrame, DataFrame]:
    """Documents (doc, crc, node, n), and the component's label of every node that has a candidate."""
    spark = docs.sparkSession
    rows = docs.select(*row_name(), whole_text().alias("text"))
    out = "doc long, crc long, node long, n long, point binary, fine binary"
    found = stored(rows.mapInArrow(returning(_set_batches(SKETCH_BITS, words)), out), "sets")
    members = found.where("node is not null")
    heavy = found.where("node is null").groupBy("doc").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(1 << SKETCH_BITS, np.int64)
    table[heavy["doc"].to_numpy(np.int64)] = heavy["n"].to_numpy(np.int64)
    frequent = spark.sparkContext.broadcast(table)
    prefixes = rows.mapInArrow(returning(_prefix_batches(frequent, SKETCH_BITS, percent, words)), "token long, node long")
    in_order = prefixes.repartition("token").sortWithinPartitions("token", "node")
    shared = stored(in_order.mapInArrow(returning(_shared_batches), "token long, node long"), "shared")
    points = members.groupBy("node").agg(
        F.first("n").alias("n"), F.first("point").alias("point"), F.first("fine").alias("fine")
    )
    tokens = shared.groupBy("node").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    place = F.sequence(F.lit(0), F.lit(LEADS - 1))
    lead = F.transform(place, lambda i: F.get("tokens", F.least(i, F.size("tokens") - 1)))
    nodes = stored(points.join(tokens.select("node", lead.alias("lead")), "node"), "nodes")
    alone = nodes.select("node", "n", "point", "lead", F.col("node").alias("label"))
    first = stored(_candidates(shared, alone, percent, block, GROUPS, NODES), "pairs")
    # A node with any partner in the tree is in a pair here, before the finer bound; one of a bucket in several
    # blocks may not have met its partners.
    cut = shared.join(F.broadcast(_crowded(shared, block)), "token").select("node")
    used = _ends(first).unionByName(cut).distinct()
    tried = stored(_bounded(first, nodes, percent), "tried")
    links = stored(_verified(tried, rows, members, percent, words), "links")
    labels = used.join(components(links), "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    labels = stored(labels, "labels")
    left = shared
    for pick in (COMPONENTS, ALL):
        left = stored(_mixed(left, labels), "mixed")
        fine = nodes.select("node", "n", F.col("fine").alias("point"), "lead").join(labels, "node")
        # What was tried before and has not linked will not now.
        more = _candidates(left, fine, percent, block, FINE, pick).join(tried, ["u", "v"], "left_anti")
        more = stored(more, "tried")
        tried = tried.unionByName(more)
        labels = stored(_relabelled(labels, _verified(more, rows, members, percent, words)), "labels")
    return members.select("doc", "crc", "node", "n"), labels


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after ``links`` join components of theirs; only labels go into the merging."""
    end = lambda x, name: labels.select(F.col("node").alias(x), F.col("label").alias(name))
    across = links.join(end("u", "a"), "u").join(end("v", "b"), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    merged = components(stored(across.distinct(), "across"))
    merged = merged.select(F.col("node").alias("label"), F.col("label").alias("last"))
    return labels.join(merged, "label", "left").select("node", F.coalesce("last", "label").alias("label"))


def _labelled(docs: DataFrame, percent: int, block: int, words: int = WORDS) -> DataFrame:
    """Rows (doc, crc, n, label): the label of a row's component, null for the empty set."""
    members, labels = similar(docs, percent, block, words)
    full = members.where("n > 0").join(labels, "node", "left")
    full = full.select("doc", "crc", "n", F.coalesce("label", "node").alias("label"))
    return full.unionByName(members.where("n = 0").select("doc", "crc", "n", F.lit(None).cast("long").alias("label")))


def shingle_components(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``docs`` (doc_id, text)."""
    rows = _labelled(docs, percent, block)
    rows = rows.withColumn("doc", F.expr(f"nullif(doc, {_LAST})"))
    names = rows.where("label is not null").groupBy("label").agg(F.min("doc").alias("least"))
    named = rows.join(names, "label", "left")
    component = F.when(F.col("label").isNull(), F.col("doc")).otherwise(F.col("least"))
    return named.select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` without all but the first, by doc_id, of each component; all rows without words stay."""
    rows = stored(_labelled(docs, percent, block, words), "labels")
    first = rows.where("label is not null").groupBy("label").agg(F.min(F.struct("doc", "crc")).alias("row"))
    doc, crc = row_name()
    mine = docs.withColumns({"_doc": doc, "_crc": crc})
    keys = first.select(F.col("row.doc").alias("_doc"), F.col("row.crc").alias("_crc"), F.lit(False).alias("_empty"))
    blank = rows.where("label is null").select(F.col("doc").alias("_doc"), F.col("crc").alias("_crc")).distinct()
    kept = mine.join(keys.unionByName(blank.withColumn("_empty", F.lit(True))), ["_doc", "_crc"])
    # Of rows that are equal in doc_id and text, one stays.
    turn = F.row_number().over(Window.partitionBy("_doc", "_crc").orderBy("_empty"))
    return kept.withColumn("_turn", turn).where("_empty or _turn = 1").select(*docs.columns)


def op4_count_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set sizes and components of all documents."""
    return shingle_components(documents(spark, sf_dir))
