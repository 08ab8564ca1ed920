"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its five-word shingles. Shingles have one global order, rare
ones first; a document's prefix of length n - ceil(t n) + l holds at least l of any
partner's prefix, so l is chosen per document by the estimated cost of its candidates:
a common prefix is lengthened, and asks for as many shared shingles before a pair is
verified. A pair comes from a shingle only if its places there leave room for enough
shared ones after it. Equal sets are one node. Pairs are verified in two turns: first each
bucket's rows with a few others of it; then, once these links have joined most of a group,
every pair that still lies in two components, where the first shingle it shares leaves room
for a link. So a large group of copies costs rows in proportion to its size, and no link
between different components is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, row_digest, shuffle_width
from .components import components
from .sketch import BITS, estimate, shingle_levels
from .textscan import mix64, shingle_pieces

WIDTH, THRESHOLD = 5, 80
#: Choices of l; cost of a candidate's verification in postings read.
MATCHES, VERIFY_COST = (1, 2, 3, 4, 6, 8), 20.0
#: Buckets up to this size give all pairs at once.
SMALL = 4
#: A shingle of a level from here on is dealt to parts, so that no task gets it whole.
HOT_LEVEL = 31
#: Rows of a bucket of several components that meet in one task; more are dealt to blocks.
BLOCK_ROWS = 1 << 15
#: Postings in a task, as planned.
TASK_POSTINGS = 2_000_000
NO_ID = -(1 << 63)
#: Of the filter of texts that are compared: log2 of its bits at most, tasks that build it.
MOST_BITS, BIT_TASKS = 28, 16
_U = np.uint64
#: A posting's "nl": the set's size, the shingle's place in the set's order, the side of a
#: block that it is on (0: no block), and l.
_SIZE, _PLACE_AT, _SIDE_AT, _PLACE, _ELL = 32, 6, 4, (1 << 26) - 1, 15


def _need(n: np.ndarray | int, threshold: int) -> np.ndarray | int:
    """Shingles that a set of n must share with any partner."""
    return -(-n * threshold // 100)


def _digest(u: np.ndarray) -> tuple[int, int]:
    """128 bits of a cryptographic digest of a set's sorted hashes."""
    d = hashlib.blake2b(u.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _prefix(u: np.ndarray, levels: np.ndarray, threshold: int) -> tuple[int, np.ndarray]:
    """(l, the prefix) of the sorted distinct hashes ``u``."""
    n = len(u)
    lv = levels[(u & _U(len(levels) - 1)).astype(np.int64)]
    order = np.argsort(lv, kind="stable")
    least = n - _need(n, threshold)
    top = min(n, least + MATCHES[-1])
    if lv[order[min(n, least + 1) - 1]] == 0:
        return 1, u[order[: least + 1]]
    cost = np.cumsum(estimate(lv[order[:top]]))
    best = min((m for m in MATCHES if least + m <= n), key=lambda m: cost[least + m - 1] * (1 + VERIFY_COST / m))
    return best, u[order[: least + best]]


def _sets(base: DataFrame, levels, threshold: int, width: int) -> DataFrame:
    """base (other columns, text) -> other columns, n, d1, d2 (null if empty), l, prefix."""
    carried = [f for f in base.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        for b in batches:
            n, digest, ell, prefix, at = [], [], [], [], [0]
            for _, h, offsets in shingle_pieces(b.column("text"), width):
                for i in range(len(offsets) - 1):
                    u = np.unique(h[offsets[i] : offsets[i + 1]])
                    n.append(len(u))
                    if len(u):
                        m, p = _prefix(u, table, threshold)
                        digest.append(_digest(u))
                        ell.append(m)
                        prefix.append(p.view(np.int64))
                    else:
                        digest.append((None, None))
                        ell.append(0)
                        prefix.append(np.zeros(0, np.int64))
                    at.append(at[-1] + len(prefix[-1]))
            values = np.concatenate(prefix) if prefix else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values))
            held = {f.name: b.column(f.name) for f in carried}
            held |= {"n": pa.array(n, pa.int64()), "d1": pa.array([d[0] for d in digest], pa.int64()), "d2": pa.array([d[1] for d in digest], pa.int64()), "l": pa.array(ell, pa.int32()), "prefix": lists}
            yield pa.RecordBatch.from_arrays(list(held.values()), names=list(held))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in carried)
    return base.mapInArrow(run, f"{kinds}, n bigint, d1 bigint, d2 bigint, l int, prefix array<bigint>")


def _postings(nodes: DataFrame, levels, hot_level: int, hot: bool) -> DataFrame:
    """key, node, nl, base: one row for each prefix shingle of a level under ``hot_level``, or
    for each of the others, whose key is one of a part of the nodes; base: the shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        for b in batches:
            lists = b.column("prefix")
            each = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(each)), each)
            place = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)  # in the order of shingles
            key = lists.values.to_numpy()[lists.offsets[0].as_py() : lists.offsets[-1].as_py()].view(_U)
            node, n, ell = (b.column(c).to_numpy().astype(np.int64) for c in ("node", "n", "l"))
            nl = (n[row] << _SIZE) | (np.minimum(place, _PLACE) << _PLACE_AT) | ell[row]
            lv = table[(key & _U(len(table) - 1)).astype(np.int64)].astype(np.int64)
            picks = np.flatnonzero((lv >= hot_level) == hot)
            for s in range(0, len(picks), 1 << 17):
                at = picks[s : s + (1 << 17)]
                base = k = key[at]
                if hot:
                    part = node[row[at]] % (np.int64(2) << ((lv[at] - hot_level) // 2))
                    k = mix64(base + (part.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))
                cols = [k.view(np.int64), node[row[at]], nl[at]] + [base.view(np.int64)] * hot
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "node", "nl", "base"][: len(cols)])

    return nodes.mapInArrow(run, "key bigint, node bigint, nl bigint" + ", base bigint" * hot)


def _grouped(batches: Iterator[pa.RecordBatch], cols: tuple[str, ...], by: Callable[[np.ndarray], np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """A task's rows sorted by key, ``by`` of nl and node, and where the keys of several rows
    start and end."""
    got = [[b.column(c).to_numpy() for c in cols] for b in batches if b.num_rows]
    if not got:
        return [np.zeros(0, np.int64)] * len(cols), np.zeros((0, 2), np.int64)
    full = [np.concatenate([g[i] for g in got]) for i in range(len(cols))]
    order = np.lexsort((full[1], by(full[2]), full[0]))
    full = [x[order] for x in full]
    starts = np.flatnonzero(np.concatenate(([True], full[0][1:] != full[0][:-1])))
    ends = np.append(starts[1:], len(full[0]))
    many = ends - starts > 1
    return full, np.stack([starts[many], ends[many]], 1)


def _place(nl: np.ndarray) -> np.ndarray:
    return (nl >> _PLACE_AT) & _PLACE


def _may_link(x: np.ndarray, y: np.ndarray, threshold: int, first: bool = False) -> np.ndarray:
    """Whether postings x and y of one shingle can be among the first l that a linking pair
    shares (first: the very first): by their sizes, and by how many shingles each has from
    here on in the common order, with those that may come before."""
    nx, ny = x >> _SIZE, y >> _SIZE
    left = np.minimum(nx - _place(x), ny - _place(y)) + (0 if first else np.minimum(x & _ELL, y & _ELL) - 1)
    return (100 * np.minimum(nx, ny) >= threshold * np.maximum(nx, ny)) & ((100 + threshold) * left >= threshold * (nx + ny))


def _pair_batch(a, b, nla, nlb, sure) -> pa.RecordBatch | None:
    """Pairs counted within a task: lo, hi, cnt, need, sure."""
    if not len(a):
        return None
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    need = np.minimum(nla & _ELL, nlb & _ELL)
    order = np.lexsort((hi, lo))
    lo, hi, need, sure = lo[order], hi[order], need[order], sure[order]
    first = np.flatnonzero(np.concatenate(([True], (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))))
    cnt = np.diff(np.append(first, len(lo)))
    zero = np.zeros(len(first), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (zero, lo[first], hi[first], cnt.astype(np.int64), need[first].astype(np.int64), np.maximum.reduceat(sure, first).astype(np.int64))], names=["kind", "a", "b", "cnt", "need", "sure"])


_CANDIDATES = "kind bigint, a bigint, b bigint, cnt bigint, need bigint, sure bigint"


def _first_turn(threshold: int, parted: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """kind 0: pairs to count (sure: to verify whatever the count); kind 1: rows of
        larger buckets (parted: the hubs of all), as (key, node, nl) in a, b, cnt."""
        (key, node, nl, *base), groups = _grouped(batches, ("key", "node", "nl") + ("base",) * parted, _place)
        a, b, sure = [], [], []
        size = groups[:, 1] - groups[:, 0]
        for k in range(2, SMALL + 1):
            s = groups[size == k, 0]
            for i in range(k):
                for j in range(i + 1, k):
                    a.append(s + i)
                    b.append(s + j)
                    sure.append(np.zeros(len(s), np.int64))
        large = groups[size > SMALL]
        held = np.concatenate([np.arange(s, e) for s, e in large]) if len(large) else np.zeros(0, np.int64)
        hubs = np.repeat(large[:, 0], large[:, 1] - large[:, 0]) if len(large) else held
        # a row whose place of the shingle is low has few shingles of its own: the bucket's
        # lowest is likest to all; and each row's lower neighbour
        for other in (hubs, held - 1):
            some = (held > hubs) & (other >= hubs)
            a.append(other[some])
            b.append(held[some])
            sure.append(np.ones(some.sum(), np.int64))
        a, b, sure = np.concatenate(a), np.concatenate(b), np.concatenate(sure)
        ok = _may_link(nl[a], nl[b], threshold) & (node[a] != node[b])
        if (out := _pair_batch(node[a[ok]], node[b[ok]], nl[a[ok]], nl[b[ok]], sure[ok])) is not None:
            yield out
        if parted:
            key, held = base[0], np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else held
        for s in range(0, len(held), 1 << 17):
            h = held[s : s + (1 << 17)]
            zero = np.zeros(len(h), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (zero + 1, key[h], node[h], nl[h], zero, zero)], names=["kind", "a", "b", "cnt", "need", "sure"])

    return run


def _second_turn(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of one larger bucket and two components whose first shared shingle this can be."""
        (_, node, nl, root), groups = _grouped(batches, ("key", "node", "nl", "root"), lambda nl: nl >> _SIZE)
        n, side = nl >> _SIZE, (nl >> _SIDE_AT) & 3
        a, b, held = [], [], 0

        def out() -> pa.RecordBatch | None:
            x, y = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (a, b))
            return _pair_batch(node[x], node[y], nl[x], nl[y], np.zeros(len(x), np.int64))

        for s, e in groups:
            if (root[s:e] == root[s]).all():
                continue
            for i in range(s, e - 1):
                # sizes ascend: partners end where sizes grow too far apart
                end = s + int(np.searchsorted(n[s:e], n[i] * 100 // threshold, side="right"))
                j = np.arange(i + 1, end)
                j = j[(root[j] != root[i]) & ((side[i] == 0) | (side[j] != side[i])) & _may_link(nl[i], nl[j], threshold, first=True)]
                a.append(np.full(len(j), i))
                b.append(j)
                held += len(j)
                if held > 1 << 20:
                    yield out()
                    a, b, held = [], [], 0
        if held:
            yield out()

    return run


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """rows (key, node, nl, root, m: the bucket's rows): those of buckets above ``block_rows``
    in every block of two parts that theirs is one of, with the side they are on."""
    parts = F.ceil(F.col("m") / F.lit(block_rows)).cast("bigint")
    mine = F.pmod(F.xxhash64("node"), F.col("parts"))
    many = rows.withColumn("parts", parts).withColumn("mine", mine)
    many = many.withColumn("other", F.explode(F.when(F.col("parts") > 1, F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).otherwise(F.array(F.lit(0).cast("bigint")))))
    side = F.when((F.col("parts") == 1) | (F.col("other") == F.col("mine")), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).cast("bigint")
    key = F.when(F.col("parts") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")))
    return many.select(key.alias("key"), "node", F.col("nl").bitwiseOR(F.shiftleft(side, _SIDE_AT)).alias("nl"), "root")


def _verified(pairs: DataFrame, nodes: DataFrame, base: DataFrame, threshold: int, width: int, scratch: Scratch) -> DataFrame:
    """A kept table of those of the kept table pairs (a, b) whose sets link. Only texts of nodes
    that are in a pair are shuffled: one row's for each, found by (k, t1, t2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for c in ("text_a", "text_b"):
                own = []
                for _, h, offsets in shingle_pieces(batch.column(c), width):
                    own += [np.unique(h[offsets[i] : offsets[i + 1]]) for i in range(len(offsets) - 1)]
                sets.append(own)
            ok = []
            for x, y in zip(*sets, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= threshold * (len(x) + len(y) - both))
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["a", "b"])

    heads = nodes.select("node", "k", "t1", "t2")
    named = pairs.select("a", "b")
    for x in "ab":
        named = named.join(heads.select(*[F.col(c).alias(f"{c}_{x}") for c in heads.columns]), F.col(x) == F.col(f"node_{x}")).drop(f"node_{x}")
    named = scratch.keep(named)
    bits = _bits(named.select(F.col("t1_a").alias("t1")).union(named.select(F.col("t1_b").alias("t1"))))
    texts = _maybe(base.select("k", "t1", "t2", "text"), bits).groupBy("k", "t1", "t2").agg(F.first("text").alias("text"))
    near = named
    for x in "ab":
        side = texts.select(*[F.col(c).alias(f"{c}__{x}") for c in ("k", "t1", "t2")], F.col("text").alias(f"text_{x}"))
        near = near.join(side, [F.col(f"{c}_{x}") == F.col(f"{c}__{x}") for c in ("k", "t1", "t2")])
    links = scratch.keep(near.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint"))
    scratch.drop(named)
    return links


def _bits(keys: DataFrame):
    """A broadcast table of bits that has those of all t1 of ``keys``: 16 for each, MOST_BITS
    at most. It only spares rows a shuffle; a full one lets more of them pass."""
    size = 1 << min(MOST_BITS, max(16, (16 * keys.count()).bit_length()))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, bool)
        for b in batches:
            held[b.column("t1").to_numpy() & (size - 1)] = True
        yield pa.RecordBatch.from_arrays([pa.array([zstandard.compress(np.packbits(held).tobytes())], pa.binary())], names=["bits"])

    total = np.zeros(size // 8, np.uint8)
    for r in keys.repartition(BIT_TASKS).mapInArrow(build, "bits binary").toLocalIterator():
        total |= np.frombuffer(zstandard.decompress(bytes(r["bits"])), np.uint8)
    return keys.sparkSession.sparkContext.broadcast(total.tobytes())


def _maybe(rows: DataFrame, bits) -> DataFrame:
    """Rows whose t1 may be in ``bits``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bits.value, np.uint8)
        for b in batches:
            at = b.column("t1").to_numpy() & (8 * len(held) - 1)
            yield b.filter(pa.array(((held[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)))

    return rows.mapInArrow(run, rows.schema)


def groups(
    docs: DataFrame,
    *,
    text_col: str = "text",
    id_col: str = "doc_id",
    threshold: int = THRESHOLD,
    width: int = WIDTH,
    bits: int = BITS,
    hot_level: int = HOT_LEVEL,
    block_rows: int = BLOCK_ROWS,
    scratch: Scratch | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Two kept tables: of every row id, w1, w2 (its digest), n (its set's size) and root (one
    of the nodes that its links reach; null for an empty set); and of every root the least
    id, null only if all are."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "ngramjoin")
    id_, text = F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`")
    w1, w2 = row_digest(docs)
    base = docs.select(id_.alias("id"), F.coalesce(id_, F.lit(NO_ID)).alias("k"), w1.alias("w1"), w2.alias("w2"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("text"), text).alias("t2"), text.alias("text"))
    levels = spark.sparkContext.broadcast(shingle_levels(base, "text", width, bits))
    sets = scratch.keep(_sets(base, levels, threshold, width))
    named = sets.where("d1 is not null").groupBy("d1", "d2")
    # numbers of a table that is written before they are read: a retry can't change them
    nodes = named.agg(F.min(F.struct("k", "t1", "t2")).alias("head"), F.first("n").alias("n"), F.first("l").alias("l"), F.first("prefix").alias("prefix"))
    nodes = scratch.keep(nodes.select(F.monotonically_increasing_id().alias("node"), "d1", "d2", "head.k", "head.t1", "head.t2", "n", "l", "prefix"))
    rows = scratch.keep(sets.select("id", "w1", "w2", "n", "d1", "d2"))
    scratch.drop(sets)
    total = nodes.agg(F.sum(F.size("prefix"))).first()[0] or 0
    wide = shuffle_width(spark, total, TASK_POSTINGS)
    lists = nodes.select("node", "n", "l", "prefix")
    candidates = scratch.keep(_postings(lists, levels, hot_level, False).repartition(wide, "key").mapInArrow(_first_turn(threshold), _CANDIDATES))
    hot = scratch.keep(_postings(lists, levels, hot_level, True))
    in_parts = scratch.keep(hot.repartition(wide, "key").mapInArrow(_first_turn(threshold, parted=True), _CANDIDATES))
    hubs = in_parts.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("node"), F.col("cnt").alias("nl"))
    across = hubs.repartition(wide, "key").mapInArrow(_first_turn(threshold), _CANDIDATES)
    pairs = candidates.where("kind = 0").unionByName(in_parts.where("kind = 0")).unionByName(across.where("kind = 0"))
    counted = pairs.groupBy("a", "b").agg(F.sum("cnt").alias("cnt"), F.min("need").alias("need"), F.max("sure").alias("sure"))
    counted = scratch.keep(counted.select("a", "b", "need", ((F.col("sure") == 1) | (F.col("cnt") >= F.col("need"))).alias("tried")))
    scratch.drop(in_parts)
    links = _verified(counted.where("tried"), nodes, base, threshold, width, scratch)
    roots = components(links, scratch)

    # a linking pair's first shared shingle lies in both sets' prefixes of one match
    larger = candidates.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("n_"), F.col("cnt").alias("nl"))
    larger = larger.unionByName(hot.select(F.col("base").alias("key"), F.col("node").alias("n_"), "nl"))
    size = F.shiftright("nl", _SIZE)
    least = size - F.ceil(size * threshold / F.lit(100))
    larger = larger.where(F.shiftright("nl", _PLACE_AT).bitwiseAND(F.lit(_PLACE)) <= least)
    placed = scratch.keep(larger.join(roots, F.col("n_") == F.col("node"), "left").select("key", F.col("n_").alias("node"), "nl", F.coalesce("root", "n_").alias("root")))
    scratch.drop(candidates, hot)
    mixed = placed.groupBy("key").agg(F.count("*").alias("m"), F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2")
    mixed = scratch.keep(mixed.select(F.col("key").alias("k_"), "m"))
    met = _blocks(placed.join(mixed, F.col("key") == F.col("k_")).drop("k_"), block_rows).repartition(wide, "key")
    met = met.mapInArrow(_second_turn(threshold), _CANDIDATES).select("a", "b", "need")

    def rooted(side: str) -> DataFrame:
        return roots.select(F.col("node").alias(f"n_{side}"), F.col("root").alias(f"r_{side}"))

    left = counted.where("not tried").join(rooted("a"), F.col("a") == F.col("n_a"), "left").join(rooted("b"), F.col("b") == F.col("n_b"), "left")
    left = left.where(F.coalesce("r_a", "a") != F.coalesce("r_b", "b")).select("a", "b", "need")
    crossing = met.unionByName(left).groupBy("a", "b").agg(F.min("need").alias("need"))
    # written before the prefixes are brought: few pairs are sent to them, not they to the pairs
    found = scratch.keep(crossing.join(counted.where("tried").select("a", "b"), ["a", "b"], "left_anti"))
    crossing = found
    for side in "ab":
        crossing = crossing.join(nodes.select(F.col("node").alias(f"n_{side}"), F.col("prefix").alias(f"p_{side}")), F.col(side) == F.col(f"n_{side}"))
    crossing = scratch.keep(crossing.where(F.size(F.array_intersect("p_a", "p_b")) >= F.col("need")).select("a", "b"))
    scratch.drop(placed, mixed, counted, found)
    more = _verified(crossing, nodes, base, threshold, width, scratch)
    if not more.isEmpty():
        scratch.drop(roots)
        roots = components(links.unionByName(more), scratch)
    node_of = nodes.select(F.col("node").alias("n_"), F.col("d1").alias("e1"), F.col("d2").alias("e2")).join(roots, F.col("n_") == F.col("node"), "left")
    node_of = scratch.keep(node_of.select("e1", "e2", F.coalesce("root", "n_").alias("root")))
    scratch.drop(nodes, links, crossing, more, roots)
    out = scratch.keep(rows.join(node_of, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left").select("id", "w1", "w2", "n", "root"))
    least = scratch.keep(out.where("root is not null").groupBy("root").agg(F.min("id").alias("least")).withColumnRenamed("root", "root_"))
    scratch.drop(rows, node_of)
    return out, least


def join_components(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """id, n_shingles and component_id (the least id that links reach) of each row.

    Two rows link if 100 x shared >= threshold x union of their sets of ``width``-word
    shingles; a text of fewer words has all of them as its one shingle. A null, empty or
    wordless text has an empty set and links with nothing (component_id: its own id).
    Repeated rows share a component; a null id takes part and is never a component's id
    unless it is alone with null. Shingles are told apart by 64-bit hashes, sets by 128
    bits. An empty table gives an empty result; other columns do not matter. Options are
    those of groups().
    """
    out, least = groups(docs, id_col=id_col, **options)
    return out.join(least, F.col("root") == F.col("root_"), "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id")
    )


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """w1, w2, times: of each component one row, that of the least id (null ids last, then by
    digest); all rows without a word."""
    out, _ = groups(docs, id_col=id_col, **options)
    first = out.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "w1", "w2")).alias("f"))
    alone = out.where("root is null").groupBy("w1", "w2").agg(F.count("*").alias("times"))
    return first.select("f.w1", "f.w2", F.lit(1).cast("bigint").alias("times")).unionByName(alone)
