"""Sharding by a K-d tree over document metadata.

A leaf is split at the byte-weighted median of its widest dimension, again and
again, until every leaf holds about the target bytes. Medians are exact up to a
tolerance and found without sorting: each pass histograms all open nodes at once
(map-side combined sums over a fixed number of bins) and narrows every node's
interval to the bin that holds its cut. What reaches the driver is bounded by
leaves x BINS and not by rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, free_name, row_digest, whole_rows

#: Of a dimension's value, of the tie-break behind it, and bits resolved by one pass.
VALUE_BITS, TIE_BITS, FIRST_BITS, BITS = 14, 26, 10, 14
#: A cut may miss its weight by this share of a leaf's bytes before a group of
#: equal texts is divided row by row.
TOLERANCE = 0.002
#: Rows in one slot-numbering chunk.
CHUNK_ROWS = 50_000
SIZE_OVERHEAD = 8
_TOP, _TIE = 1 << VALUE_BITS, 1 << TIE_BITS


def _of_node(values: list, node: Column, kind: str) -> Column:
    """values[node], for a small list held as a literal array."""
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), node.cast("int"))


class _Cut:
    """One node's search: rows with key < bound weigh about ``goal``."""

    def __init__(self, goal: float, shift: int, last: bool = False):
        self.last, self.goal, self.lo, self.shift, self.below, self.bound, self.stuck = last, goal, 0, shift, 0.0, None, False

    def narrow(self, bins: list[tuple[int, float, int]], width: int, slack: float) -> None:
        """bins: (number, weight, rows) of bins of 2**width keys from lo on."""
        total = self.below
        for b, w, rows in sorted(bins):
            if total + w < self.goal:
                total += w
                continue
            start, end = self.lo + (b << width), self.lo + ((b + 1) << width)
            if abs(total + w - self.goal) <= slack:
                self.bound, self.below = end, total + w
            elif abs(self.goal - total) <= slack:
                self.bound, self.below = start, total
            elif rows == 1 or width == 0 and self.last:  # one row: the nearer side
                near = total + w - self.goal < self.goal - total
                self.bound, self.below = (end, total + w) if near else (start, total)
            elif width == 0:  # one key is too heavy to cut beside it
                self.bound, self.below, self.stuck = end, total, True
            else:
                self.lo, self.below, self.shift = start, total, width
            return
        self.bound, self.below = self.lo + ((max((x[0] for x in bins), default=0) + 1) << width), total


def _finish(rows: DataFrame, node: Column, key: Column, weight: Column, cuts: dict[int, _Cut], slack: float) -> None:
    """Narrow all open cuts together, one job for each BITS bits of the key."""
    while any(c.bound is None for c in cuts.values()):
        open_ = {n: c for n, c in cuts.items() if c.bound is None}
        width = {n: max(0, c.shift - BITS) for n, c in open_.items()}
        top = range(max(open_) + 1)
        low = _of_node([open_[n].lo if n in open_ else None for n in top], node, "bigint")
        by = _of_node([width.get(n) for n in top], node, "int")
        span = _of_node([1 << (c.shift - width[n]) if (c := open_.get(n)) else None for n in top], node, "bigint")
        got = (
            rows.select(node.alias("n"), key.alias("k"), weight.alias("w"), low.alias("low"), by.alias("by_"), span.alias("span"))
            .where("k >= low")
            .select("n", F.expr("shiftright(k - low, by_)").alias("b"), "w", "span")
            .where("b < span")
            .groupBy("n", "b")
            .agg(F.sum("w").alias("w"), F.count("*").alias("m"))
            .collect()
        )
        bins: dict[int, list] = {n: [] for n in open_}
        for r in got:
            bins[r["n"]].append((r["b"], r["w"], r["m"]))
        for n, c in open_.items():
            c.narrow(bins[n], width[n], slack)


def _ordered_value(col: Column, low: str, high: str) -> Column:
    """A string's place between ``low`` and ``high``, the least and the greatest, as a whole
    number below _TOP that follows byte order: the six bytes after what the two share."""
    a, b = low.encode(), high.encode()
    lead = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))

    def number(x: bytes) -> int:
        return int.from_bytes(x[lead : lead + 6].ljust(6, b"\0"), "big")

    hexed = F.rpad(F.hex(F.substring(F.coalesce(col, F.lit("")).cast("binary"), lead + 1, 6)), 12, "0")
    first, span = number(a), max(1, number(b) - number(a))
    return F.least(F.lit(_TOP - 1), F.greatest(F.lit(0), F.floor((F.conv(hexed, 16, 10).cast("double") - F.lit(float(first))) * F.lit((_TOP - 1) / span)))).cast("bigint")


def _dimensions(docs: DataFrame, names: tuple[str, ...], size: Column) -> tuple[list[Column], int]:
    """Each dimension spread over 0 .. _TOP - 1, and their number; the last is the size, on a
    log scale. A column of one value has no width."""
    cols = {d: F.col(f"`{d}`").cast("string") for d in names if d in docs.columns}
    ends = [f(F.coalesce(c, F.lit(""))).alias(f"{n}{i}") for i, c in enumerate(cols.values()) for n, f in (("low", F.min), ("high", F.max))]
    ends += [F.min(size).alias("least"), F.max(size).alias("most")]
    got = docs.agg(*ends).first()
    dims = [_ordered_value(c, got[f"low{i}"] or "", got[f"high{i}"] or "") for i, c in enumerate(cols.values())]
    low, high = math.log2(got["least"] or 1), math.log2(got["most"] or 1)
    dims.append(F.least(F.lit(_TOP - 1), F.floor((F.log2(size.cast("double")) - F.lit(low)) * F.lit((_TOP - 1) / max(1e-9, high - low)))).cast("bigint"))
    return [x.alias(f"d{i}") for i, x in enumerate(dims)], len(dims)


def kd_shards(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """Deal ``docs`` into shards of near equal bytes by a K-d tree over metadata.

    Dimensions: each of ``dimensions`` that is present, in byte order, and the size on a
    log scale, each spread over its own extent; within one value, rows are ordered by the
    hash of their text. All of a group of equal texts have the point of the first row, so
    the group is one point and is divided (by hash of the id) only where a cut falls in a
    group too large for the tolerance. Give ``n_shards`` or ``target_bytes`` (then
    ceil(total / target) shards).

    Returns id, size (UTF-8 bytes + 8; null text: 8), text_crc32 (0 for null), law
    ('bytes'), shard, slot (0 .. n-1 in each shard) and grown_shard (null). Null and
    empty texts have size 8; a null dimension counts as empty; equal rows are dealt as
    separate rows; an empty table gives an empty result; columns beside those named are
    ignored.
    """
    placed, rows, leaves = _placed(docs, id_col=id_col, **options)
    return number_slots(placed, rows, leaves, id_col)


def _placed(
    docs: DataFrame,
    *,
    text_col: str = "text",
    id_col: str = "doc_id",
    dimensions: tuple[str, ...] = ("lang", "source"),
    n_shards: int | None = None,
    target_bytes: int | None = None,
    keys: tuple[str, ...] = (),
    scratch: Scratch | None = None,
) -> tuple[DataFrame, int, int]:
    """(id, size, crc, shard, row, keys of every row; rows; shards)."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "shard")
    text = F.col(f"`{text_col}`")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + SIZE_OVERHEAD
    dims, n_dims = _dimensions(docs, dimensions, size)
    g1, g2 = F.xxhash64(text), F.xxhash64(F.lit("text"), text)
    meta = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        size.alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("bigint").alias("crc"),
        g1.alias("g1"),
        g2.alias("g2"),
        *[F.col(f"`{c}`").alias(f"key_{i}") for i, c in enumerate(keys)],
        *dims,
    )
    meta = scratch.keep(meta.withColumn("row", F.pmod(F.xxhash64("id", "crc", F.monotonically_increasing_id()), F.lit(1 << 40))))
    # one point for a group: that of its least (id, dimensions); sizes of equal texts are equal
    d = [f"d{i}" for i in range(n_dims)]
    point = F.min(F.struct(F.col("id").isNull(), F.col("id"), *d))
    heads = meta.groupBy("g1", "g2").agg(F.count("*").alias("m"), point.alias("p")).where("m > 1")
    heads = scratch.keep(heads.select(F.col("g1").alias("h1"), F.col("g2").alias("h2"), *[F.col(f"p.{x}").alias(f"p_{x}") for x in d]))
    held = [c for c in meta.columns if c not in d]
    flat = meta.join(heads, (F.col("g1") == F.col("h1")) & (F.col("g2") == F.col("h2")), "left")
    before, meta = meta, scratch.keep(flat.select(*held, *[F.coalesce(f"p_{x}", x).alias(x) for x in d]))
    scratch.drop(before, heads)
    tie = F.pmod(F.xxhash64("g1", F.lit(1)), F.lit(_TIE))

    totals = meta.agg(F.sum("size").alias("b"), F.count("*").alias("n")).first()
    total, rows = totals["b"] or 0, totals["n"]
    leaves = n_shards or max(1, math.ceil(total / target_bytes))
    slack = TOLERANCE * total / leaves

    node = F.lit(0)
    nodes = {0: (0, leaves, float(total))}  # node: first leaf, leaves, bytes
    values = F.array(*[F.col(f"d{i}").cast("bigint") for i in range(n_dims)])
    coarse = VALUE_BITS - FIRST_BITS
    while total and any(m > 1 for _, m, _ in nodes.values()):
        # one job: every dimension's extent and its coarse histogram, in every node
        seen = (
            meta.select(node.alias("n"), "size", F.posexplode(values).alias("d", "v"))
            .groupBy("n", "d", F.shiftright("v", coarse).alias("b"))
            .agg(F.sum("size").alias("w"), F.count("*").alias("m"), F.min("v").alias("low"), F.max("v").alias("high"))
            .collect()
        )
        bins: dict[tuple, list] = {}
        extent: dict[tuple, tuple] = {}
        for r in seen:
            at = (r["n"], r["d"])
            bins.setdefault(at, []).append((r["b"], r["w"], r["m"]))
            low, high = extent.get(at, (r["low"], r["high"]))
            extent[at] = (min(low, r["low"]), max(high, r["high"]))
        cuts, widest = {}, {}
        for n, (_, m, b) in nodes.items():
            if m > 1 and (n, 0) in bins:
                widest[n] = max(range(n_dims), key=lambda i, n=n: (extent[n, i][1] - extent[n, i][0], -i))
                cuts[n] = _Cut(b * (m // 2) / m, VALUE_BITS + TIE_BITS)
                cuts[n].narrow(bins[n, widest[n]], coarse + TIE_BITS, slack)
        if not cuts:
            break
        top = range(max(nodes) + 1)
        value = F.get(values, _of_node([widest.get(n) for n in top], node, "int"))
        key = F.shiftleft(value, TIE_BITS) + tie
        _finish(meta, node, key, F.col("size"), cuts, slack)
        inner = {n: _Cut(c.goal - c.below, 40, last=True) for n, c in cuts.items() if c.stuck}
        if inner:
            heavy = _of_node([cuts[n].bound - 1 if n in inner else None for n in top], node, "bigint")
            _finish(meta.where(key == heavy), node, F.col("row"), F.col("size"), inner, 0.0)
        nexts, left, right = {}, {}, {}
        for n, (first, m, b) in nodes.items():
            left[n] = right[n] = len(nexts)
            if n not in cuts:
                nexts[left[n]] = (first, m, b)
                continue
            right[n] = left[n] + 1
            w = float(cuts[n].below + (inner[n].below if n in inner else 0))
            nexts[left[n]], nexts[right[n]] = (first, m // 2, w), (first + m // 2, m - m // 2, b - w)
        bound = _of_node([cuts[n].bound if n in cuts else None for n in top], node, "bigint")
        divided = _of_node([inner[n].bound if n in inner else None for n in top], node, "bigint")
        goes_left = (key < bound) & (divided.isNull() | (key < bound - 1) | (F.col("row") < divided))
        go = F.when(goes_left, _of_node([left.get(n) for n in top], node, "int")).otherwise(_of_node([right.get(n) for n in top], node, "int"))
        moved = meta.withColumn("next_node", go).drop("node").withColumnRenamed("next_node", "node")
        done, meta = meta, scratch.keep(moved)
        scratch.drop(done)
        node, nodes = F.col("node"), nexts
    shard = _of_node([nodes.get(n, (0, 1, 0))[0] for n in range(max(nodes) + 1)], node, "int")
    placed = meta.select("id", "size", "crc", shard.alias("shard"), "row", *[F.col(f"key_{i}").alias(c) for i, c in enumerate(keys)])
    return placed, rows, leaves


def number_slots(placed: DataFrame, rows: int, leaves: int, id_col: str) -> DataFrame:
    """Gapless slots: rows are numbered within chunks of bounded size, and chunks are offset."""
    chunks = max(1, -(-2 * rows // (leaves * CHUNK_ROWS)))
    placed = placed.withColumn("chunk", F.pmod("row", F.lit(chunks)).cast("int"))
    counts = placed.groupBy("shard", "chunk").agg(F.count("*").alias("m"))
    w = W.partitionBy("shard").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(F.col("shard").alias("s_"), F.col("chunk").alias("c_"), F.coalesce(F.sum("m").over(w), F.lit(0)).alias("start"))
    in_chunk = F.row_number().over(W.partitionBy("shard", "chunk").orderBy("id", "row")) - 1
    return (
        placed.withColumn("at", in_chunk)
        .join(starts, (F.col("shard") == F.col("s_")) & (F.col("chunk") == F.col("c_")))
        .select(
            F.col("id").alias(id_col),
            F.col("size"),
            F.col("crc").alias("text_crc32"),
            F.lit("bytes").alias("law"),
            F.col("shard"),
            (F.col("start") + F.col("at")).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def with_shards(docs: DataFrame, **options) -> DataFrame:
    """All columns of ``docs`` and the shard of each row, named so that it clashes with none."""
    w1, w2 = row_digest(docs)
    a, b = free_name(docs, "w1"), free_name(docs, "w2")
    placed, _, _ = _placed(docs.withColumns({a: w1, b: w2}), keys=(a, b), **options)
    return whole_rows(docs, placed.groupBy(F.col(a).alias("w1"), F.col(b).alias("w2"), "shard").agg(F.count("*").alias("times")))
