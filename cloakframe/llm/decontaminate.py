"""Benchmark decontamination by template canonicalisation.

Words are stripped of punctuation and lower-cased; numbers, names and units become
typed placeholders. Windows of the templates are hash-joined with those of the
benchmark; where a document covers enough of an item, the slots behind the
placeholders must be filled consistently: one value of the item, one of the document.
So a question with other numbers is caught, and a chance likeness of forms is not.
Windows equal word for word count in any case; those that are mostly placeholders count
only so, as their form alone tells nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_name
from .textscan import mix64, pieces, shingles, span_hashes, word_spans

#: Words of a window; share of an item's windows that a document must cover; share of
#: a window's words that must not be placeholders, else it is joined by its very words;
#: items of fewer words are left out.
WIDTH, COVERAGE, LITERAL, LEAST_WORDS = 8, 0.5, 0.5, 5
#: Bits of the filter of benchmark windows that every task gets: a fixed size.
FILTER_BITS = 22
_U = np.uint64

# Words that count as numbers, and units (after a number).
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million billion".split()
UNITS = (
    "mm cm m km meter meters metre metres kilometer kilometers kilometre kilometres inch inches foot feet yard yards mile miles "
    "mg g kg gram grams kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds ml l liter liters litre litres gallon gallons "
    "ms s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros percent degree degrees mph kmh watt watts volt volts"
).split()

_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:"]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_NUM, _NAME, _UNIT = (_U(x) for x in (0x1111, 0x2222, 0x3333))


def _known(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    start, end, _ = word_spans(data, np.array([0, len(data)]))
    return np.sort(span_hashes(data, start, end))


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


_NUMBER_HASHES, _UNIT_HASHES = _known(NUMBER_WORDS), _known(UNITS)


def template(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(template word hashes, slot values, first): a literal word has slot value 0."""
    start, end, first = word_spans(data, at)
    if not len(start):
        return np.zeros(0, _U), np.zeros(0, _U), np.zeros(len(at), np.int64)
    base = int(at[0])
    solid = np.flatnonzero(~_PUNCT[data[base : int(at[-1])]]) + base  # white space too, which no word holds
    after, before = np.searchsorted(solid, start), np.searchsorted(solid, end)
    s, e = start.copy(), start.copy()
    some = before > after  # a word of punctuation only has nothing left
    s[some], e[some] = solid[after[some]], solid[before[some] - 1] + 1
    keep = e > s
    low = int(at[0])
    lines = np.concatenate(([0], np.cumsum(data[low : int(at[-1])] == 10)))
    begins = np.zeros(len(start), bool)
    begins[first[:-1][first[:-1] < len(start)]] = True
    begins[1:] |= _STOP[data[end[:-1] - 1]] | (lines[start[1:] - low] > lines[end[:-1] - low])
    first = np.concatenate(([0], np.cumsum(keep)))[first]
    s, e, begins = s[keep], e[keep], begins[keep]
    h = np.zeros(len(s), _U)
    size = 1 << 20
    for a in range(0, len(s), size):  # a long text by parts
        h[a : a + size] = span_hashes(data, s[a : a + size], e[a : a + size])
    if not len(h):
        return h, h, first
    digits = np.concatenate(([0], np.cumsum(_DIGIT[data[low : int(at[-1])]])))
    number = (digits[e - low] > digits[s - low]) | _among(h, _NUMBER_HASHES)
    lead = data[s]
    capital = ((lead >= 65) & (lead <= 90)) | ((lead == 0xC3) & (data[np.minimum(s + 1, len(data) - 1)] <= 0x9E))
    name = capital & ~begins & ~number
    unit = np.zeros(len(h), bool)
    after = np.flatnonzero(number[:-1]) + 1
    unit[after] = _among(h[after], _UNIT_HASHES)
    slot = np.where(number | name | unit, h, _U(0))
    word = np.where(number, _NUM, np.where(unit, _UNIT, np.where(name, _NAME, h)))
    return word, slot, first


def _windows(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every window of ``width`` words: (text, position, hash, slots), and each text's
    number of words. The hash is the template's, or the words' where literals are too few."""
    word, slot, first = template(data, at)
    count = np.diff(first)
    h, offsets = shingles(word, first, width)
    n = np.diff(offsets)
    text = np.repeat(np.arange(len(n)), n)
    pos = np.arange(len(h)) - offsets[:-1][text]
    literal = np.concatenate(([0], np.cumsum(slot == 0)))
    begin = first[:-1][text] + pos
    exact, _ = shingles(np.where(slot == 0, word, slot), first, width)
    h = np.where(literal[np.minimum(begin + width, len(slot))] - literal[begin] >= LITERAL * width, h, mix64(exact))
    ok = count[text] >= width
    text, pos, h, begin = text[ok], pos[ok], h[ok], begin[ok]
    h = mix64(h + _U(width))
    slots = slot[begin[:, None] + np.arange(width)] if len(h) < 1 << 14 else None
    return text, pos, h, (slot, begin) if slots is None else slots, count


def _slots_of(slots, pick: np.ndarray, width: int) -> list[bytes]:
    if isinstance(slots, tuple):
        slot, begin = slots
        return [x.tobytes() for x in slot[begin[pick][:, None] + np.arange(width)]]
    return [x.tobytes() for x in slots[pick]]


def _hits(table: DataFrame, widths, bits) -> DataFrame:
    """table (id, text) -> row, id, width, pos, h, slots, n: of windows that pass the filter;
    bits None: of all windows (n: windows of the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None if bits is None else np.frombuffer(bits.value, np.uint8)
        serial = TaskContext.get().partitionId() << 40
        for b in batches:
            ids = b.column("id")
            for row0, data, at in pieces(b.column("text")):
                for text, width, pos, h, slots, n in _piece_hits(data, at, widths and widths.value, held):
                    rows = text + row0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(serial + rows), ids.take(pa.array(rows)), pa.array(width, pa.int32()), pa.array(pos), pa.array(h.view(np.int64)), pa.array(slots, pa.binary()), pa.array(n, pa.int64())],
                        names=["row", "id", "width", "pos", "h", "slots", "n"],
                    )
            serial += b.num_rows

    return table.mapInArrow(run, "row bigint, id bigint, width int, pos bigint, h bigint, slots binary, n bigint")


def _piece_hits(data: np.ndarray, at: np.ndarray, widths: tuple[int, ...] | None, held: np.ndarray | None) -> list[tuple]:
    """widths None: of each text its own, WIDTH or all its words if they are fewer."""
    out = []
    if widths is None:
        _, _, first = template(data, at)
        count = np.diff(first)
        widths = sorted({min(WIDTH, int(c)) for c in count if c >= LEAST_WORDS})
    else:
        count = None
    for width in widths:
        text, pos, h, slots, words = _windows(data, at, width)
        if count is not None:
            pick = np.flatnonzero(np.minimum(words, WIDTH)[text] == width)
        else:
            bit = (h & _U((1 << FILTER_BITS) - 1)).astype(np.int64)
            pick = np.flatnonzero((held[bit >> 3] >> (bit & 7)) & 1)
        if len(pick):
            out.append((text[pick], np.full(len(pick), width), pos[pick], h[pick], _slots_of(slots, pick, width), words[text[pick]] - width + 1))
    return out


def _judge(coverage: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Rows of one document row and item: windows equal word for word, and those on
        diagonals whose slots are filled consistently."""
        got, changed = set(), set()
        for _, d in pdf.groupby(pdf["pos"] - pdf["ipos"]):
            fill: dict[int, int] = {}
            ok, other = True, set()
            for mine, theirs, ipos in zip(d["slots"], d["islots"], d["ipos"], strict=True):
                if mine == theirs:
                    got.add(ipos)
                a, b = np.frombuffer(mine, np.uint64), np.frombuffer(theirs, np.uint64)
                for x, y in zip(a.tolist(), b.tolist(), strict=True):
                    if x or y:
                        ok &= fill.setdefault(y, x) == x
                        if x != y:
                            other.add(y)
            if ok:
                got |= set(d["ipos"])
                changed |= other
        first = pdf.iloc[0]
        share = len(got) / max(1, int(first["n"]))
        if share < coverage:
            return pd.DataFrame({"doc_id": [], "item_id": [], "matched": [], "windows": [], "coverage": [], "slots_changed": []}).astype(_KINDS)
        return pd.DataFrame({"doc_id": [first["id"]], "item_id": [first["item"]], "matched": [len(got)], "windows": [int(first["n"])], "coverage": [share], "slots_changed": [len(changed)]}).astype(_KINDS)

    return run


_KINDS = {"doc_id": "Int64", "item_id": "Int64", "matched": "int64", "windows": "int64", "coverage": "float64", "slots_changed": "int64"}


def leaks(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id", coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, matched, windows, coverage, slots_changed: each document row that
    covers ``coverage`` of an item's windows or more.

    Null and empty texts, and items of fewer than LEAST_WORDS words, match nothing; an
    item shorter than WIDTH is one window; repeated rows give a row each; null ids stay
    null; empty tables give an empty result.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    theirs = _hits(items, None, None).select(F.col("id").alias("item"), F.col("row").alias("irow"), "width", F.col("pos").alias("ipos"), "h", F.col("slots").alias("islots"), "n")
    bits = bytearray(1 << FILTER_BITS >> 3)
    widths = set()
    low = F.col("h").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).cast("int")
    for r in theirs.select("width", low.alias("b")).distinct().toLocalIterator():  # 2**FILTER_BITS of a width at most
        bits[r["b"] >> 3] |= 1 << (r["b"] & 7)
        widths.add(r["width"])
    share = spark.sparkContext.broadcast
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    mine = _hits(rows, share(tuple(sorted(widths))), share(bytes(bits))).drop("n")
    met = mine.join(theirs, ["h", "width"])
    return met.groupBy("row", "irow").applyInPandas(_judge(coverage), "doc_id bigint, item_id bigint, matched bigint, windows bigint, coverage double, slots_changed bigint")


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that leaks() names (all rows of such an id)."""
    id_col = options.get("id_col", "doc_id")
    # written first: its size is then known, and a small table is sent to the documents
    named = Scratch(docs.sparkSession, "leaks").keep(leaks(docs, benchmark, **options).select(F.col("doc_id").alias("leak_id_")).distinct())
    named = named.withColumnRenamed("leak_id_", free_name(docs, "leak_id_"))
    return docs.join(named, F.col(f"`{id_col}`").eqNullSafe(F.col(named.columns[0])), "left_anti")
