"""Language identification by compression.

Each language has a zstandard raw-content dictionary cut from its training texts. A
text goes to the language whose dictionary compresses it best; where the best two are
close, it is marked as rejected. Long texts are compressed piece by piece, so that
every piece meets the dictionary and not only the text's own past.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import free_name

UNKNOWN = "und"
#: Bounds of the fit: bytes of a language's dictionary, characters taken from one
#: text, and texts of a language that are asked for (all held-in texts can be drawn).
DICT_BYTES = 96 * 1024
SAMPLE_CHARS = 600
SAMPLE_TEXTS = 600
#: Languages that are learned, those of most texts: the model goes to every executor.
MAX_LANGS = 256
PIECE_BYTES = 1024
LEVEL = 6
#: Score (relative saving of the best over the second) under which a text is rejected; of
#: n bytes of distinct words, n / (n + SHORT) of it is asked, as little text weighs in
#: whole bytes. A tie is rejected at any length.
MIN_MARGIN, SHORT = 0.01, 64
FOLDS, HELD_OUT = 5, 0


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    dicts: tuple[bytes, ...]


def fold(id_: Column) -> Column:
    """crc32(id as text) mod 5; a null id counts as the empty string."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % FOLDS


_WORD_CHARS = re.compile(r"[^\W\d_]+")


@cache
def _other_numbers() -> dict[int, str]:
    """Characters that count as word characters but are no letters (Unicode category L)."""
    return {n: " " for n in range(sys.maxunicode + 1) if chr(n).isalnum() and not chr(n).isalpha() and not chr(n).isdecimal()}


def _letters(text: str) -> list[str]:
    """Runs of letters."""
    if not text.isascii() and not _other_numbers().keys().isdisjoint(map(ord, set(text))):
        text = text.translate(_other_numbers())
    return _WORD_CHARS.findall(text)


def plain(text: str) -> bytes:
    """What is compressed: the runs of letters in lower case, each different one once."""
    return " ".join(dict.fromkeys(_letters(text.lower()))).encode("utf-8", "surrogatepass")


def fit(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_texts: int = SAMPLE_TEXTS) -> Model:
    """Dictionaries from a bounded sample of labelled rows, drawn by a hash of id and text.

    Every row can be drawn; of each of the MAX_LANGS languages of most texts, about 1.5 x
    SAMPLE_TEXTS different ones are, and no more than SAMPLE_CHARS of one are used. Each
    dictionary has its own length, DICT_BYTES at most, whatever the others have.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    sizes = rows.groupBy(F.col(lang_col).alias("l")).agg(F.count("*").alias("m")).orderBy(F.desc("m"), "l").limit(MAX_LANGS).collect()
    if not sizes:
        return Model((), ())
    draw = F.pmod(F.xxhash64(F.lit(8), F.col(id_col), F.col(text_col)), F.lit(1 << 30))
    wanted = [F.when(F.col(lang_col) == r["l"], draw < int(min(1.0, 1.5 * sample_texts / r["m"]) * (1 << 30))) for r in sizes]
    # each text gives a window from its start; texts of one line give the same
    window = F.substring(F.col(text_col), 1, SAMPLE_CHARS)
    drawn = rows.where(F.coalesce(*wanted)).groupBy(F.col(lang_col).alias("l"), window.alias("t")).agg(F.min(draw).alias("d"))
    at = F.row_number().over(W.partitionBy("l").orderBy("d", "t"))
    picked = drawn.withColumn("at", at).where(F.col("at") <= 2 * sample_texts).orderBy("l", "at")
    texts: dict[str, list[bytes]] = {r["l"]: [] for r in sizes}
    for r in picked.collect():  # 2 x sample_texts x MAX_LANGS x SAMPLE_CHARS at most
        texts[r["l"]].append(plain(r["t"]))
    langs = [x for x in texts if texts[x]]  # most texts first
    return Model(tuple(langs), tuple(b" ".join(dict.fromkeys(texts[x]))[:DICT_BYTES] for x in langs))


class Classifier:
    """A model's compressors, made once in a worker."""

    def __init__(self, model: Model):
        self.langs = model.langs
        self.by = [self._compressor(d) for d in model.dicts]
        self.frame = len(self.by[0].compress(b"")) if model.dicts else 0

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)

    def costs(self, data: bytes) -> list[int]:
        out = [0] * len(self.by)
        for at in range(0, len(data), PIECE_BYTES):
            piece = data[at : at + PIECE_BYTES]
            for i, c in enumerate(self.by):
                out[i] += len(c.compress(piece)) - self.frame
        return out

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected): the score is the relative saving over the second
        best; ties go to the language with more training texts."""
        data = plain(text) if text else b""
        if not data or not self.langs:
            return UNKNOWN, 0.0, True
        costs = self.costs(data)
        order = sorted(range(len(costs)), key=lambda i: (costs[i], i))
        if len(order) == 1:
            return self.langs[0], 1.0, False
        best, second = costs[order[0]], costs[order[1]]
        score = min(1.0, max(0.0, 1.0 - max(best, 0) / max(second, 1)))
        return self.langs[order[0]], score, score < MIN_MARGIN * len(data) / (len(data) + SHORT)


_held: dict[int, Classifier] = {}


def _classifier(model: Model) -> Classifier:
    key = hash(model)
    if key not in _held:
        _held.clear()
        _held[key] = Classifier(model)
    return _held[key]


def predict(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected.

    lang_pred is a learned language, or 'und' for a null text or one without a letter;
    rejected: 'und', or a score under the margin for its length. Columns of the same names are
    replaced; rows, repeated ones too, stay as they are.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    kinds = {"lang_pred": pa.string(), "score": pa.float64(), "rejected": pa.bool_()}

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = _classifier(broadcast.value)
        for batch in batches:
            got = [c.judge(x.as_py()) for x in batch]
            yield pa.StructArray.from_arrays([pa.array([g[i] for g in got], t) for i, t in enumerate(kinds.values())], names=list(kinds))

    held = docs.drop("lang_pred", "score", "rejected")
    name = free_name(held, "judged")
    return held.withColumn(name, judged(F.col(f"`{text_col}`"))).select(*[F.col(f"`{c}`") for c in held.columns], *[f"{name}.{k}" for k in kinds])


def identify(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """predict() with a model fitted on the rows of ``docs`` outside the held-out fold."""
    labelled = docs.where(fold(F.col(id_col)) != HELD_OUT)
    return predict(docs, fit(labelled, text_col=text_col, lang_col=lang_col, id_col=id_col), text_col=text_col)
