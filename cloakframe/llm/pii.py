"""Personal data by patterns, and terms that give it away, in SQL expressions only.

Base spans are matches of fixed patterns; long random strings (keys, tokens) are spans of
the kind ``secret``. Beyond them, the corpus tells how strongly a term reveals a protected
entity: a value, the group of values that it belongs to (a domain, a network, an area, an
issuer), or its whole kind. With entity e, term t and different texts as events, the
pointwise mutual information log2 p(e, t) / (p(e) p(t)) over the information -log2 p(e) of
the entity is the share of it that t discloses. A share counts only if the meetings explain
more bits than it takes to name the pair among all terms and entities, so that what two
texts have in common by chance discloses nothing, however rare. Terms whose share of any
entity reaches DISCLOSURE are spans of their own wherever they stand, in every text, and
are removed.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_name

# The kinds in their order, and their patterns. \G with the lookbehind lets a
# search start at a run's head or where the last match ended, which finds what a search
# from every character would, in linear time.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for the pattern to be tried.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "secret": "[SECRET]", "term": "[TERM]"}
#: A run of letters and digits that holds 128 bits even if it is only hexadecimal; of
#: ordinary words none has so many digits.
SECRET, SECRET_DIGITS = r"(?:\G|(?<![A-Za-z0-9]))[A-Za-z0-9]{32,}+", 0.2
SECRET_HINT = "[A-Za-z0-9]{32}"

TERM = r"\p{L}[\p{L}\p{M}\p{N}_'-]{2,}"
#: The policy: a term that leaves a reader less than a twentieth of an entity's bits goes.
DISCLOSURE = 0.95
#: Matches that one array is built of by appending.
CHUNK = 256
SPANS = "array<struct<kind:string,start:int,end:int,value:bigint,group:bigint>>"


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _checker(kind: str) -> Callable[[Column], Column]:
    return lambda x: _valid(kind, x["match"])


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def places(text: Column, pattern: str, kind: str) -> Column:
    """(kind, start, end, match) of all matches: their offsets are the lengths of the pieces
    between them, summed within chunks and over chunks, so that no long array is appended to."""
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.transform(gaps, lambda g: F.length(g)).alias("g"))
    found = "array<struct<kind:string,start:int,end:int,match:string>>"

    def inside(chunk: Column, at: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["g"]
            end = start + F.length(x["m"])
            one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["m"].alias("match"))
            return F.struct(end.alias("at"), F.concat(acc["found"], F.array(one)).alias("found"))

        return F.aggregate(chunk, F.struct(at.alias("at"), F.array().cast(found).alias("found")), step, lambda acc: acc["found"])

    def whole(pairs: Column) -> Column:
        matches = F.filter(pairs, lambda x: x["m"].isNotNull())
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / CHUNK).cast("int")), lambda i: F.slice(matches, i * CHUNK + 1, F.lit(CHUNK)))
        sums = F.transform(chunks, lambda c: F.struct(c.alias("c"), F.aggregate(c, F.lit(0), lambda n, x: n + x["g"] + F.length(x["m"])).alias("n")))
        kept = "array<struct<c:array<struct<m:string,g:int>>,at:int>>"

        def step(acc: Column, x: Column) -> Column:
            return F.struct((acc["at"] + x["n"]).alias("at"), F.concat(acc["out"], F.array(F.struct(x["c"].alias("c"), acc["at"].alias("at")))).alias("out"))

        placed = F.aggregate(sums, F.struct(F.lit(0).alias("at"), F.array().cast(kept).alias("out")), step, lambda acc: acc["out"])
        return F.when(F.size(matches) > 0, F.flatten(F.transform(placed, lambda x: inside(x["c"], x["at"])))).otherwise(F.array().cast(found))

    # by way of an array of one, so that the matches are found once
    return F.element_at(F.transform(F.array(pairs), whole), 1)


def _group(kind: str, match: Column) -> Column:
    """What values of a kind have in common with others: an e-mail's domain, a network of
    2**16 addresses, a number's country and area, a card's issuer."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "email":
        return F.substring_index(F.lower(match), "@", -1)
    if kind == "ip":
        return F.substring_index(match, ".", 2)
    return F.substring(digits, 1, 4 if kind == "phone" else 6)


def _found(text: Column, kind: str, pattern: str, hint: Column, ok: Callable[[Column], Column]) -> Column:
    """Spans of one kind; value and group: hashes that tell entities apart."""

    def span(x: Column) -> Column:
        value = F.xxhash64(F.lit(kind), F.lower(x["match"]))
        group = F.xxhash64(F.lit(f"{kind} of"), _group(kind, x["match"])) if kind in KINDS else value
        return F.struct(x["kind"], x["start"], x["end"], value.alias("value"), group.alias("group"))

    return F.when(hint, F.transform(F.filter(places(text, pattern, kind), ok), span).cast(SPANS)).otherwise(F.array().cast(SPANS))


def base_spans(text: Column) -> Column:
    """Base spans in order of start, then kind."""
    found = []
    for kind in KINDS:
        hint = F.instr(text, HINTS[kind]) > 0 if len(HINTS[kind]) == 1 else text.rlike(HINTS[kind])
        found.append(_found(text, kind, PATTERNS[kind], hint, _checker(kind)))
    return ordered(F.concat(*found))


def secret_spans(text: Column) -> Column:
    def ok(x: Column) -> Column:
        return F.length(F.regexp_replace(x["match"], "[^0-9]", "")) >= F.length(x["match"]) * SECRET_DIGITS

    return _found(text, "secret", SECRET, text.rlike(SECRET_HINT), ok)


def ordered(spans: Column) -> Column:
    rank = F.array(*[F.lit(k) for k in (*KINDS, "secret", "term")])

    def key(x: Column) -> Column:
        return F.struct(x["start"].alias("start"), F.array_position(rank, x["kind"]).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"), x["value"].alias("value"), x["group"].alias("group"))

    return F.transform(F.array_sort(F.transform(spans, key)), lambda x: F.struct(x["kind"], x["start"], x["end"], x["value"], x["group"]))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _outside(text: Column, base: Column) -> Column:
    """``text`` without its base spans and without words that they cut into."""
    inner = r"[\p{L}\p{M}\p{N}_'-]"

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), x["start"] - acc["at"]))
        gap = F.when(acc["word"], F.regexp_replace(gap, f"^{inner}+", "")).otherwise(gap)
        gap = F.when(F.substring(text, x["start"] + 1, F.lit(1)).rlike(inner), F.regexp_replace(gap, f"(?<!{inner}){inner}+$", "")).otherwise(gap)
        end = F.greatest(acc["at"], x["end"])
        return F.struct(end.alias("at"), F.substring(text, end, F.lit(1)).rlike(inner).alias("word"), F.concat(acc["out"], gap, F.lit(" ")).alias("out"))

    def last(acc: Column) -> Column:
        rest = F.substring(text, acc["at"] + 1, F.length(text))
        return F.concat(acc["out"], F.when(acc["word"], F.regexp_replace(rest, f"^{inner}+", "")).otherwise(rest))

    return F.aggregate(base, F.struct(F.lit(0).alias("at"), F.lit(False).alias("word"), F.lit("").alias("out")), step, last)


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def entities(spans: Column) -> Column:
    """Hashes of what spans reveal: values, their groups and their kinds."""
    each = F.transform(spans, lambda x: F.array(x["value"], x["group"], F.xxhash64(F.lit("kind"), x["kind"])))
    return F.array_distinct(F.flatten(each))


def disclosing(meetings: DataFrame, words: DataFrame, n: int, scratch: Scratch, disclosure: float = DISCLOSURE) -> DataFrame:
    """(entity, term, both, share) of the pairs that disclose.

    meetings: entities, outside (terms), inside (terms that stand in spans only) of each
    different text with a span; words: term, anywhere (texts that hold it); n: texts. The
    price of a pair is log2 of all pairs that could be named; what it explains, both x the
    pointwise mutual information, must be more. An entity that could not pay for any term,
    and pairs that could not if the term stood nowhere else, are dropped before their terms
    are looked up.
    """
    met = meetings.select("outside", "inside", F.explode("entities").alias("entity"))
    of_entity = scratch.keep(met.groupBy("entity").agg(F.count("*").alias("of_entity")))
    price = math.log2(max(1, words.count())) + math.log2(max(1, of_entity.count()))
    bits = F.log2(F.lit(float(max(1, n))) / F.col("of_entity"))
    able = scratch.keep(of_entity.withColumn("bits", bits).where(F.col("of_entity") * F.col("bits") > price).withColumnRenamed("entity", "e_"))
    pairs = met.join(able.select("e_"), F.col("entity") == F.col("e_"), "left_semi")
    pairs = pairs.select("entity", F.explode("outside").alias("term")).groupBy("entity", "term").agg(F.count("*").alias("both"))
    pairs = pairs.join(able, F.col("entity") == F.col("e_")).where(F.col("both") * F.col("bits") > price)
    inside = meetings.select(F.explode("inside").alias("i_")).groupBy("i_").agg(F.count("*").alias("only_inside"))
    pairs = pairs.join(inside, F.col("term") == F.col("i_"), "left").join(words.withColumnRenamed("term", "t_"), F.col("term") == F.col("t_"))
    of_term = F.col("anywhere") - F.coalesce("only_inside", F.lit(0))
    shared = F.log2(F.lit(float(max(1, n))) * F.col("both") / (F.col("of_entity") * of_term))
    pairs = pairs.select("entity", "term", "both", "bits", shared.alias("shared"))
    return pairs.where((F.col("both") * F.col("shared") > price) & (F.col("shared") >= disclosure * F.col("bits"))).select("entity", "term", "both", (F.col("shared") / F.col("bits")).alias("share"))


def _texts(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """A kept table of the different texts of rows (d1, d2, text): d1, d2, text, base, secrets."""
    texts = rows.groupBy("d1", "d2").agg(F.first("text").alias("text"))
    return scratch.keep(texts.withColumn("base", base_spans(F.col("text"))).withColumn("secrets", secret_spans(F.col("text"))))


def _strong(texts: DataFrame, scratch: Scratch, disclosure: float) -> DataFrame:
    """A kept table (term) of all terms that disclose."""
    known = F.concat("base", "secrets")
    each = texts.where((F.size("base") > 0) | (F.size("secrets") > 0)).withColumn("known", ordered(known))
    each = each.withColumn("outside", _terms(_outside(F.col("text"), F.col("known"))))
    each = each.select(entities(F.col("known")).alias("entities"), "outside", F.array_except(_terms(F.col("text")), "outside").alias("inside"))
    meetings = scratch.keep(each)
    words = scratch.keep(texts.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("anywhere")))
    strong = scratch.keep(disclosing(meetings, words, texts.count(), scratch, disclosure).select("term").distinct())
    scratch.drop(meetings, words)
    return strong


def find(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", disclosure: float = DISCLOSURE, scratch: Scratch | None = None) -> DataFrame:
    """id, d1, d2 (of the text), base and spans (base, secrets and terms) of each row.

    Null texts count as empty and have no spans; repeated rows have the same; a null id
    stays null; an empty table gives an empty result; other columns do not matter.
    """
    scratch = scratch or Scratch(docs.sparkSession, "pii")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("d1"), F.xxhash64(F.lit("text"), "text").alias("d2"), "text")
    texts = _texts(rows, scratch)
    strong = _strong(texts, scratch, disclosure)
    told = texts.select("d1", "d2", F.explode(_terms(F.col("text"))).alias("term")).join(strong, "term")
    told = scratch.keep(told.groupBy(F.col("d1").alias("e1"), F.col("d2").alias("e2")).agg(F.collect_set("term").alias("told")))
    held = texts.join(told, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left")
    known = F.concat("base", F.filter("secrets", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))
    said = F.filter(places(F.col("text"), TERM, "term"), lambda x: F.array_contains("told", F.lower(x["match"])))
    term = F.transform(said, lambda x: F.struct(x["kind"], x["start"], x["end"], F.xxhash64(F.lower(x["match"])).alias("value"), F.lit(0).cast("bigint").alias("group")))
    term = F.when(F.col("told").isNotNull(), term.cast(SPANS)).otherwise(F.array().cast(SPANS))
    held = held.withColumn("known", known).withColumn("terms", term)
    clear = F.filter("terms", lambda t: ~F.exists("known", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    held = held.select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), "base", ordered(F.concat("known", clear)).alias("spans"))
    held = scratch.keep(held.where(F.size("spans") > 0))
    scratch.drop(texts, told, strong)
    both = rows.select("id", "d1", "d2").join(held, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left")
    none = F.array().cast(SPANS)
    return both.select(F.col("id").alias(id_col), "d1", "d2", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def sanitise(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind's placeholder; of spans that
    overlap, the first is replaced and the others' rest removed. Null texts stay null."""
    found = find(docs, text_col=text_col, id_col=id_col, **options).where(F.size("spans") > 0).dropDuplicates(["d1", "d2"])
    a, b, s = (free_name(docs, f"pii_{x}") for x in "abs")
    found = found.select(F.col("d1").alias(a), F.col("d2").alias(b), F.col("spans").alias(s))
    text = F.col(f"`{text_col}`")
    joined = docs.join(found, (F.xxhash64(text) == F.col(a)) & (F.xxhash64(F.lit("text"), text) == F.col(b)), "left")
    holder = F.create_map(*[F.lit(x) for kv in PLACEHOLDERS.items() for x in kv])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), x["start"] - acc["at"]))
        said = F.when(x["start"] >= acc["at"], F.element_at(holder, x["kind"])).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["out"], gap, said).alias("out"))

    clean = F.aggregate(s, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return joined.withColumn(text_col, F.when(F.col(s).isNull() | text.isNull(), text).otherwise(clean)).select(*[F.col(f"`{c}`") for c in docs.columns])
