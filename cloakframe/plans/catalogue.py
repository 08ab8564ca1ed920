"""Named queries over the test tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config
from ..functions import expr
from ..operators import columns as cols
from ..operators import groups, policies, profile, residual, scan, tokens
from ..sources import recency
from . import audit as auditing
from . import dashboard, run_table

SECRET = expr.local_secret("test-salt")
IPAD, OPAD = expr.hmac_pads(SECRET)
NOW = datetime(1999, 1, 1)
Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracle: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql is not None:
            _oracle[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hmac_sql(value: str) -> str:
    """The first 24 hex digits of the keyed digest of a VARCHAR expression."""
    return f"left(sha256(unhex('{OPAD}') || unhex(sha256(unhex('{IPAD}') || encode({value})))), 24)"


def _rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if c in names else F.col(c) for c in df.columns])


# --- pseudonyms, redaction, tokens ------------------------------------------------


@query(f"SELECT {hmac_sql('CAST(c_custkey AS VARCHAR)')} AS c_custkey, {hmac_sql('c_name')} AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer QUALIFY count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) >= 8")
def hash_kanon_customers(spark: SparkSession, d: str) -> DataFrame:
    out, _ = cols.pseudonymize(table(spark, d, "customer"), ["c_custkey", "c_name"], SECRET)
    return groups.k_anonymous(out, ["c_nationkey", "c_mktsegment"], 8)


@query(f"SELECT s_suppkey, {hmac_sql('s_name')} AS s_name, {hmac_sql('CAST(s_nationkey AS VARCHAR)')} AS s_nationkey FROM supplier")
def hash_identifiers(spark: SparkSession, d: str) -> DataFrame:
    return cols.pseudonymize(table(spark, d, "supplier").drop("s_acctbal"), ["s_name", "s_nationkey", "absent"], SECRET)[0]


@query("SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN '[REDACTED]' END AS o_orderpriority FROM orders")
def redact_column(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("o_orderpriority"))
    return cols.replaced(o, {"o_orderpriority": expr.redact(F.col("o_orderpriority"))})


_TOKEN_SQL = """
WITH v AS (SELECT c_custkey, lower(trim(c_mktsegment)) AS k FROM customer),
f AS (SELECT k, min(c_custkey) AS p FROM v GROUP BY k),
n AS (SELECT k, row_number() OVER (ORDER BY p, k) - 1 AS n FROM f)
SELECT c_custkey, 'PERSON_' || n AS c_mktsegment FROM v JOIN n USING (k)"""


@query(_TOKEN_SQL)
def tokenize_column(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return tokens.tokenize(c, {"c_mktsegment": "PERSON"}, F.col("c_custkey"))


_SHARED_SQL = """
WITH v AS (SELECT doc_id, lower(trim(source)) AS a, lower(trim(CASE WHEN doc_id % 3 = 0 THEN source ELSE lang END)) AS b FROM documents),
u AS (SELECT a AS k, 0 AS c, doc_id AS p FROM v UNION ALL SELECT b, 1, doc_id FROM v),
f AS (SELECT k, min((c, p)) AS place FROM u GROUP BY k),
n AS (SELECT k, row_number() OVER (ORDER BY place, k) - 1 AS n FROM f)
SELECT doc_id, 'LOCATION_' || x.n AS a, 'LOCATION_' || y.n AS b FROM v JOIN n x ON v.a = x.k JOIN n y ON v.b = y.k"""


@query(_SHARED_SQL)
def tokenize_shared_dictionary(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id", F.col("source").alias("a"), F.when(F.col("doc_id") % 3 == 0, F.col("source")).otherwise(F.col("lang")).alias("b"))
    return tokens.tokenize(t, {"a": "LOCATION", "b": "LOCATION"}, F.col("doc_id"))


@query("SELECT 'LOCATION' AS entity, count(DISTINCT lower(trim(source))) AS n_values FROM documents UNION ALL SELECT 'PERSON', count(DISTINCT lower(trim(lang))) FROM documents")
def token_value_counts(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents")
    return tokens.unique_counts(tokens.dictionary(t, {"source": "LOCATION", "lang": "PERSON"}, F.col("doc_id")))


@query("SELECT c_custkey, 'SEG_' || " + hmac_sql("lower(trim(c_mktsegment))").replace(", 24)", ", 16)") + " AS c_mktsegment FROM customer")
def tokenize_by_digest(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return tokens.hash_tokens(c, {"c_mktsegment": "SEG"}, SECRET)


@query(f"SELECT {hmac_sql('CAST(c_custkey AS VARCHAR)')} AS c_custkey, CASE WHEN c_name IS NOT NULL THEN '[REDACTED]' END AS c_name, c_nationkey FROM customer")
def apply_policies(spark: SparkSession, d: str) -> DataFrame:
    from ..model import Action, ColumnPolicy

    plans = {"c_custkey": ColumnPolicy("c_custkey", "IDENTIFIER", Action.HASH, "name_pattern", 1.0), "c_name": ColumnPolicy("c_name", "MUST_ANONYMIZE", Action.REDACT, "external", 1.0), "gone": ColumnPolicy("gone", "PERSON", Action.TOKENIZE, "fallback", 0.0)}
    return policies.apply(table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), plans, secret=SECRET)[0]


# --- recency ------------------------------------------------------------------------


@query("SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def recency_filter_typed(spark: SparkSession, d: str) -> DataFrame:
    return recency.recent(table(spark, d, "orders"), recency.cutoff(365, NOW))[0]


_DATED = "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS created_on FROM orders"


@query(f"SELECT * FROM ({_DATED}) WHERE TRY_CAST(created_on AS TIMESTAMP) >= TIMESTAMP '1998-01-01'")
def recency_filter_string(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 7 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return recency.recent(o.select("o_orderkey", text.alias("created_on")), recency.cutoff(365, NOW))[0]


@query("SELECT event_id, ts FROM events")
def recency_fallback(spark: SparkSession, d: str) -> DataFrame:
    return recency.recent(table(spark, d, "events").select("event_id", "ts"), datetime(2090, 1, 1))[0]


# --- k-anonymity --------------------------------------------------------------------

_KANON = "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate FROM (SELECT *, date_trunc('month', l_shipdate) AS m FROM lineitem) QUALIFY count(*) OVER (PARTITION BY m, l_quantity, l_returnflag) >= 12"


def _dated_lines(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    return li.withColumn("m", F.date_trunc("MONTH", "l_shipdate"))


@query(_KANON)
def kanon_window(spark: SparkSession, d: str) -> DataFrame:
    return groups.k_anonymous(_dated_lines(spark, d), ["m", "l_quantity", "l_returnflag"], 12, how="window").drop("m")


@query(_KANON)
def kanon_semijoin(spark: SparkSession, d: str) -> DataFrame:
    return groups.k_anonymous(_dated_lines(spark, d), ["m", "l_quantity", "l_returnflag"], 12).drop("m")


@query("SELECT o_orderkey, q, o_orderpriority FROM (SELECT o_orderkey, nullif(CAST(o_custkey % 40 AS BIGINT), 7) AS q, o_orderpriority FROM orders) QUALIFY count(*) OVER (PARTITION BY q, o_orderpriority) >= 70")
def kanon_null_group(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.nullif((F.col("o_custkey") % 40).cast("bigint"), F.lit(7)).alias("q"), "o_orderpriority")
    return groups.k_anonymous(o, ["q", "o_orderpriority"], 70)


_BINS = """
WITH e AS (SELECT list_sort(list_distinct(quantile_cont(p_size, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM part)
SELECT p_partkey, CASE WHEN p_size <= e[2] THEN e[1]::INT || '–' || e[2]::INT WHEN p_size <= e[3] THEN e[2]::INT || '–' || e[3]::INT
  WHEN p_size <= e[4] THEN e[3]::INT || '–' || e[4]::INT WHEN p_size <= e[5] THEN e[4]::INT || '–' || e[5]::INT ELSE e[5]::INT || '–' || e[6]::INT END AS p_size
FROM part, e"""


@query(_BINS)
def numeric_quantile_bins(spark: SparkSession, d: str) -> DataFrame:
    return cols.bin_numbers(table(spark, d, "part").select("p_partkey", "p_size"), ["p_size"])[0]


@query("SELECT unnest(list_sort(list_distinct(quantile_cont(c_acctbal, [0, 0.2, 0.4, 0.6, 0.8, 1.0])))).round(6) AS edge FROM customer")
def quantile_edges(spark: SparkSession, d: str) -> DataFrame:
    at = [i / 5 for i in range(6)]
    c = table(spark, d, "customer")
    return c.agg(F.percentile("c_acctbal", at).alias("e")).select(F.explode(F.array_distinct(F.array_sort("e"))).alias("edge")).select(F.round("edge", 6).alias("edge"))


@query(f"SELECT * FROM ({_BINS}) QUALIFY count(*) OVER (PARTITION BY p_size) >= 300")
def kanon_after_binning(spark: SparkSession, d: str) -> DataFrame:
    return groups.k_anonymous(numeric_quantile_bins(spark, d), ["p_size"], 300)


# --- GPS, time, trajectories --------------------------------------------------------

_PLACES = "SELECT event_id, CAST((user_id * 37 % 1800) AS DOUBLE) / 10 - 90 + 0.0123 AS lat, CAST((user_id * 91 % 3600) AS DOUBLE) / 10 - 180 + 0.0321 AS lon, ts, value AS speed FROM events"


def _places(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select("event_id", ((F.col("user_id") * 37 % 1800).cast("double") / 10 - 90 + 0.0123).alias("lat"), ((F.col("user_id") * 91 % 3600).cast("double") / 10 - 180 + 0.0321).alias("lon"), "ts", F.col("value").alias("speed"))


@query(f"SELECT event_id, round_even(lat, 1) AS lat, round_even(lon, 1) AS lon FROM ({_PLACES})")
def gps_round(spark: SparkSession, d: str) -> DataFrame:
    return cols.round_gps(_places(spark, d).select("event_id", "lat", "lon"), ["lat", "lon"], 1)


@query(f"SELECT event_id, round_even(TRY_CAST(CAST(lat AS DECIMAL(10,4)) AS DOUBLE), 2) AS latitude FROM ({_PLACES})")
def gps_round_strings(spark: SparkSession, d: str) -> DataFrame:
    t = _places(spark, d).select("event_id", F.col("lat").cast("decimal(10,4)").cast("string").alias("latitude"))
    return cols.round_gps(t, ["latitude"], 2)


@query("SELECT event_id, 'POINT (' || CAST(round_even(CAST(user_id AS DOUBLE) / 8 + 0.0625, 1) AS DOUBLE) || ' ' || CAST(round_even(-CAST(event_id AS DOUBLE) / 16 - 0.03125, 1) AS DOUBLE) || ')' AS geom FROM events")
def wkt_round(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    x, y = F.col("user_id").cast("double") / 8 + 0.0625, -F.col("event_id").cast("double") / 16 - 0.03125
    wkt = F.concat(F.lit("POINT ("), x.cast("decimal(20,6)").cast("string"), F.lit(" "), y.cast("decimal(20,6)").cast("string"), F.lit(")"))
    return cols.round_gps(e.select("event_id", wkt.alias("geom")), ["geom"], 1)


@query("SELECT o_orderkey, date_trunc('day', o_orderdate + INTERVAL 5 HOUR)::TIMESTAMP AS o_orderdate FROM orders")
def timestamp_floor(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 5 HOURS")).alias("o_orderdate"))
    return cols.floor_days(o, ["o_orderdate", "o_orderkey"])[0]


_CELLS = f"""SELECT round_even(lat / 60, 0) AS lat, round_even(lon / 90, 0) AS lon, CAST(hour(ts) AS INT) AS hour_of_day, dayname(ts) AS day_of_week, count(speed) AS ping_count,
round(avg(speed), 6) AS avg_speed_kmh, round(quantile_cont(speed, 0.5), 6) AS p50_speed_kmh, round(quantile_cont(speed, 0.85), 6) AS p85_speed_kmh, count(*) AS n FROM ({_PLACES}) GROUP BY ALL"""


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return _places(spark, d).withColumn("lat", F.bround(F.col("lat") / 60, 0)).withColumn("lon", F.bround(F.col("lon") / 90, 0))


@query(f"SELECT * EXCLUDE (n) FROM ({_CELLS}) WHERE ping_count >= 6")
def trajectory_aggregate(spark: SparkSession, d: str) -> DataFrame:
    out = groups.trajectory(_cells(spark, d), ["lat", "lon"], "speed", "ts", 6)
    return _rounded(out, "avg_speed_kmh", "p50_speed_kmh", "p85_speed_kmh")


@query(f"SELECT count(*) FILTER (ping_count >= 6) AS cells_retained, count(*) AS cells_total, CAST(sum(n) - coalesce(sum(ping_count) FILTER (ping_count >= 6), 0) AS BIGINT) AS pings_suppressed FROM ({_CELLS})")
def trajectory_stats(spark: SparkSession, d: str) -> DataFrame:
    return groups.trajectory_stats(_cells(spark, d), ["lat", "lon"], "speed", "ts", 6)


@query("SELECT round(avg(CASE WHEN value BETWEEN 0 AND 300 THEN 1.0 ELSE 0.0 END), 9) AS share FROM events WHERE value IS NOT NULL")
def speed_range_share(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").agg(F.round(profile.inside_share(F.col("value"), 0, 300), 9).alias("share"))


@query(f"SELECT min(lat) >= -180 AND max(lat) <= 180 AS lat_ok, min(lon) >= -180 AND max(lon) <= 180 AS lon_ok, min(speed) >= -180 AND max(speed) <= 180 AS speed_ok FROM ({_PLACES})")
def gps_range_profile(spark: SparkSession, d: str) -> DataFrame:
    return _places(spark, d).agg(*[profile.all_inside(F.col(c), -180.0, 180.0).alias(f"{c}_ok") for c in ("lat", "lon", "speed")])


# --- profiles -----------------------------------------------------------------------


def _per_column(df: DataFrame, names: list[str], value: Callable[[Column], Column], kind: str = "double") -> DataFrame:
    """One row for each column: column, value."""
    one = df.agg(*[value(F.col(c)).cast(kind).alias(c) for c in names])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in names])).alias("r")).select("r.*")


def _per_column_sql(source: str, names: list[str], value: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({value.format(c=c)} AS DOUBLE) AS value FROM {source}" for c in names)


_O = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]


@query(_per_column_sql("orders", _O, "round(count(DISTINCT {c}) / count({c}), 9)"))
def unique_ratio_profile(spark: SparkSession, d: str) -> DataFrame:
    return _per_column(table(spark, d, "orders"), _O, lambda c: F.round(profile.unique_share(c), 9))


_N = ["c_name", "c_mktsegment"]
_SHAPED = "round(avg(CASE WHEN regexp_full_match(trim({c}), '[A-Za-z0-9_.:@/-]{{3,128}}') AND regexp_matches({c}, '[0-9]') AND regexp_matches({c}, '[A-Za-z]') THEN 1.0 ELSE 0.0 END), 9)"


@query(_per_column_sql("customer", _N, _SHAPED))
def identifier_shape_profile(spark: SparkSession, d: str) -> DataFrame:
    return _per_column(table(spark, d, "customer"), _N, lambda c: F.round(profile.code_share(c), 9))


_Q = ["p_size", "p_retailprice", "p_partkey"]


@query(_per_column_sql("part", _Q, "CASE WHEN count(DISTINCT {c}) <= 0.4 * count({c}) AND avg(CASE WHEN {c} BETWEEN 0 AND 130 THEN 1.0 ELSE 0.0 END) >= 0.8 THEN 1 ELSE 0 END"))
def quasi_identifier_profile(spark: SparkSession, d: str) -> DataFrame:
    return _per_column(table(spark, d, "part"), _Q, lambda c: F.when(profile.quasi_number(c), 1).otherwise(0))


@query("SELECT round(-sum(p * log2(p)), 9) AS entropy FROM (SELECT count(*) / sum(count(*)) OVER () AS p FROM events GROUP BY event_type)")
def entropy_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.entropy_of(table(spark, d, "events"), "event_type").select(F.round("entropy", 9).alias("entropy"))


_FREE = "SELECT '{t}' AS tab, round(avg(length(text)), 6) AS avg_chars, round(avg(len(regexp_split_to_array(regexp_replace(text, '^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$', '', 'g'), '[ \\t\\n\\r\\f\\v]+'))), 6) AS avg_words FROM {t} WHERE text <> ''"


@query(" UNION ALL ".join(_FREE.format(t=t) for t in ("documents", "conversations")))
def free_text_profile(spark: SparkSession, d: str) -> DataFrame:
    def one(name: str) -> DataFrame:
        chars, words = profile.text_lengths(F.col("text"))
        return table(spark, d, name).where("text <> ''").agg(F.lit(name).alias("tab"), F.round(chars, 6).alias("avg_chars"), F.round(words, 6).alias("avg_words"))

    return one("documents").unionByName(one("conversations"))


@query("SELECT round(avg(CASE WHEN left(trim(props), 1) IN ('{', '[') THEN 1.0 ELSE 0.0 END), 9) AS json_share FROM events")
def json_shape_profile(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").agg(F.round(profile.document_share(F.col("props")), 9).alias("json_share"))


@query("SELECT source, lang, round(share, 9) AS share FROM (SELECT source, lang, count(*) / sum(count(*)) OVER (PARTITION BY source) AS share FROM documents GROUP BY source, lang) WHERE share >= 0.5")
def language_majority(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "documents").groupBy("source", "lang").count()
    share = F.col("count") / F.sum("count").over(W.partitionBy("source"))
    return counts.withColumn("share", share).where("share >= 0.5").select("source", "lang", F.round("share", 9).alias("share"))


# --- residual scan and detection ----------------------------------------------------

_EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"


def _counts(spark: SparkSession, d: str, entity: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", residual.scalar_count("text", entity).cast("bigint").alias("n")).where("n > 0")


@query(f"SELECT doc_id, len(regexp_extract_all(text, '\\b{_EMAIL}\\b')) AS n FROM documents WHERE regexp_matches(text, '\\b{_EMAIL}\\b')")
def residual_email_counts(spark: SparkSession, d: str) -> DataFrame:
    return _counts(spark, d, "EMAIL_ADDRESS")


@query("SELECT page_id, len(regexp_extract_all(url, '(?i)(?:https?://|www\\.)[^\\s<>''\"]+')) AS n FROM pages")
def residual_url_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", residual.scalar_count("url", "URL").cast("bigint").alias("n"))


@query("""WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]{1,9}(?:\\.[0-9]{1,9}){3}')) AS ip FROM documents)
SELECT doc_id, count(*) AS n FROM c WHERE len(list_filter(string_split(ip, '.'), lambda p: CAST(p AS BIGINT) <= 255)) = 4 GROUP BY doc_id""")
def residual_ip_v4_counts(spark: SparkSession, d: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(r"[0-9]{1,9}(?:\.[0-9]{1,9}){3}"), F.lit(0))
    ok = F.filter(found, lambda ip: F.forall(F.split(ip, r"\."), lambda p: p.cast("bigint") <= 255))
    return table(spark, d, "documents").select("doc_id", F.size(ok).cast("bigint").alias("n")).where("n > 0")


@query("""WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\+[0-9][0-9 .()/-]{6,}[0-9]')) AS p FROM documents)
SELECT doc_id, count(*) AS n FROM c WHERE length(regexp_replace(p, '[^0-9]', '', 'g')) >= 7 GROUP BY doc_id""")
def residual_phone_counts(spark: SparkSession, d: str) -> DataFrame:
    found = F.filter(F.regexp_extract_all("text", F.lit(r"\+[0-9][0-9 .()/-]{6,}[0-9]"), F.lit(0)), expr.phone_ok)
    return table(spark, d, "documents").select("doc_id", F.size(found).cast("bigint").alias("n")).where("n > 0")


@query("""WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]{13,19}')) AS x FROM documents),
l AS (SELECT doc_id, x, list_sum(list_transform(range(1, length(x) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse(x)[i] AS INT) ELSE (2 * CAST(reverse(x)[i] AS INT)) % 10 + (2 * CAST(reverse(x)[i] AS INT)) // 10 END)) AS s FROM c)
SELECT doc_id, x AS card FROM l WHERE s % 10 = 0""")
def residual_card_luhn(spark: SparkSession, d: str) -> DataFrame:
    found = F.explode(F.filter(F.regexp_extract_all("text", F.lit("[0-9]{13,19}"), F.lit(0)), expr.luhn))
    return table(spark, d, "documents").select("doc_id", found.alias("card"))


_IBAN_IN = "'GB' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || 'WEST' || lpad(CAST(c_custkey * 7919 AS VARCHAR), 14, '0')"


@query(f"""WITH v AS (SELECT c_custkey, {_IBAN_IN} AS iban FROM customer),
n AS (SELECT c_custkey, iban, list_reduce(list_transform(string_split(regexp_replace(substr(iban, 5) || left(iban, 4), '', ''), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE CAST(ascii(c) - 55 AS VARCHAR) END), lambda a, b: a || b) AS digits FROM v)
SELECT c_custkey, iban FROM n WHERE CAST(digits AS HUGEINT) % 97 = 1""")
def residual_iban_mod97(spark: SparkSession, d: str) -> DataFrame:
    iban = F.concat(F.lit("GB"), F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0"), F.lit("WEST"), F.lpad((F.col("c_custkey") * 7919).cast("string"), 14, "0"))
    return table(spark, d, "customer").select("c_custkey", iban.alias("iban")).where(expr.iban_ok(F.col("iban")))


@query(f"SELECT 'text' AS \"column\", 'EMAIL_ADDRESS' AS entity, CAST(sum(len(regexp_extract_all(text, '\\b{_EMAIL}\\b'))) AS BIGINT) AS n FROM documents")
def residual_summary(spark: SparkSession, d: str) -> DataFrame:
    found = residual.findings(table(spark, d, "documents").select("text"))
    return found.where("entity = 'EMAIL_ADDRESS'").select("column", "entity", "n")


@query(f"SELECT doc_id, regexp_replace(text, '{_EMAIL}', '[EMAIL]', 'g') AS text FROM documents WHERE regexp_matches(text, '{_EMAIL}')")
def mask_emails_in_text(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(F.col("text").rlike(_EMAIL))
    return docs.select("doc_id", F.regexp_replace("text", _EMAIL, "[EMAIL]").alias("text"))


_SEEDS = ["there", "ration", "worthless", "pathetic", "because"]


@query(f"""WITH t AS (SELECT DISTINCT lower(w) AS w FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS w FROM documents) WHERE length(w) >= 5),
s AS (SELECT unnest({_SEEDS}) AS seed) SELECT w, seed, levenshtein(w, seed) AS distance FROM t, s WHERE abs(length(w) - length(seed)) <= 2 AND levenshtein(w, seed) <= CASE WHEN length(w) >= 6 THEN 2 ELSE 1 END""")
def fuzzy_concept_tokens(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("w"))
    words = words.where(F.length("w") >= 5).select(F.lower("w").alias("w")).distinct()
    near = F.explode(F.array(*[F.lit(s) for s in _SEEDS]))  # a few seeds: no join
    most = F.when(F.length("w") >= 6, 2).otherwise(1)
    pairs = words.select("w", near.alias("seed")).where(F.abs(F.length("w") - F.length("seed")) <= 2)
    return pairs.select("w", "seed", F.levenshtein("w", "seed").alias("distance")).where(F.col("distance") <= most)


@query()
def detect_pii_spans(spark: SparkSession, d: str) -> DataFrame:
    docs = scan.spread(table(spark, d, "documents").select("doc_id", "text"))
    found = docs.select("doc_id", F.explode(scan.finder()(F.col("text"))).alias("f"))
    return found.select("doc_id", "f.entity", "f.start", "f.end", "f.score")


@query()
def anonymize_documents(spark: SparkSession, d: str) -> DataFrame:
    return scan.anonymize(table(spark, d, "documents").select("doc_id", "text"), ["text"], F.col("doc_id"))[0]


@query()
def anonymize_json_props(spark: SparkSession, d: str) -> DataFrame:
    return scan.anonymize(table(spark, d, "events").select("event_id", "props"), ["props"], F.col("event_id"))[0]


@query()
def residual_json_paths(spark: SparkSession, d: str) -> DataFrame:
    props = F.concat(F.lit('{"mail":"u'), F.col("user_id").cast("string"), F.lit('@example.org","n":1}'))
    return residual.findings(table(spark, d, "events").select(props.alias("payload")))


@query()
def run_table_customer(spark: SparkSession, d: str) -> DataFrame:
    """The stages of one table's run, without the write."""
    from contextlib import nullcontext

    from ..config import EngineConfig
    from ..model import RunRecord

    config = EngineConfig(enable_key_vault=False, k_anonymity_tables=frozenset({"customer"}), quasi_identifiers={"customer": ("c_nationkey",)})
    df = run_table.with_position(table(spark, d, "customer"))
    return run_table.transform(df, config, "customer", RunRecord("r", "customer", "a", "b"), lambda _: nullcontext(), secret=SECRET)


# --- dashboard, control tables, discovery -------------------------------------------

_RUNS = """SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failure' ELSE 'running' END AS status,
o_custkey AS total_rows, o_orderkey % 5 AS suppressed_rows, o_orderdate AS started_at FROM orders"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failure").otherwise("running")
    return table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("run_id"), status.alias("status"), F.col("o_custkey").alias("total_rows"), (F.col("o_orderkey") % 5).alias("suppressed_rows"), F.col("o_orderdate").alias("started_at"))


@query(f"""SELECT count(*) AS total_runs, count(*) FILTER (status = 'success') AS succeeded, count(*) FILTER (status = 'failure') AS failed, count(*) FILTER (status = 'running') AS running,
CAST(sum(total_rows) AS BIGINT) AS rows_processed, CAST(sum(suppressed_rows) AS BIGINT) AS rows_suppressed, max(started_at) AS last_run FROM ({_RUNS})""")
def runs_kpi(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.kpis(_runs(spark, d))


@query("SELECT count(*) AS n_alerts FROM events WHERE ts > TIMESTAMP '2024-01-15' - INTERVAL 24 HOUR")
def alerts_window(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.alerts_since(table(spark, d, "events").withColumnRenamed("ts", "created_at"), datetime(2024, 1, 15))


@query(f"SELECT * FROM ({_RUNS}) ORDER BY started_at DESC, run_id LIMIT 25 OFFSET 10")
def recent_runs_topk(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.recent_runs(_runs(spark, d), 25, 10)


@query("SELECT CAST(user_id AS VARCHAR) AS run_id, round(sum(value), 6) AS total_seconds, arg_max(event_type, (s, event_type)) AS slowest FROM (SELECT *, value AS s FROM (SELECT user_id, event_type, sum(value) AS value FROM events GROUP BY ALL)) GROUP BY user_id")
def stage_totals(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("v"))
    runs = per.groupBy(F.col("user_id").cast("string").alias("run_id")).agg(F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("stage_seconds"))
    out = dashboard.stage_totals(runs)
    return out.select("run_id", F.round("total_seconds", 6).alias("total_seconds"), F.col("stages")[0]["stage"].alias("slowest"))


@query("SELECT lower(o_orderpriority) AS t, list_sort(list_distinct(list(o_orderstatus))) AS c FROM orders GROUP BY 1")
def control_column_sets(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.col("o_orderpriority").alias("table_name"), F.col("o_orderstatus").alias("column_name"))
    return auditing.column_sets(rows)


_CONTROL = "(VALUES ('GPS_PRECISION', '2', 1), ('K_ANONYMITY_MIN', '7', 1), ('GPS_PRECISION', '1', 0), ('K_ANONYMITY_MIN', '5', 0), ('MAX_TABLE_WORKERS', '1', 0)) AS v(key, value, rank)"


@query(f"SELECT key, value FROM {_CONTROL} QUALIFY row_number() OVER (PARTITION BY key ORDER BY rank DESC) = 1")
def config_overrides_precedence(spark: SparkSession, d: str) -> DataFrame:
    env = {"GPS_PRECISION": "1", "K_ANONYMITY_MIN": "5", "MAX_TABLE_WORKERS": "1"}
    got = config.load(env, rows=lambda: {"GPS_PRECISION": "2", "K_ANONYMITY_MIN": "7"})
    rows = [("GPS_PRECISION", got.gps_precision), ("K_ANONYMITY_MIN", got.k_anonymity_min), ("MAX_TABLE_WORKERS", got.max_table_workers)]
    return spark.createDataFrame([(k, str(v)) for k, v in rows], "key string, value string")


_LISTS = """offered AS (SELECT DISTINCT 'lake/' || lower(c_mktsegment) || '_' || n_name AS t FROM customer JOIN nation ON c_nationkey = n_nationkey),
known AS (SELECT DISTINCT 'lake/' || lower(c_mktsegment) || '_' || n_name AS t FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9900)"""


@query(f"WITH {_LISTS} SELECT t FROM offered WHERE t NOT IN (SELECT t FROM known)")
def discovery_antijoin(spark: SparkSession, d: str) -> DataFrame:
    named = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    offered = named.select(F.concat(F.lit("lake/"), F.lower("c_mktsegment"), F.lit("_"), F.col("n_name")).alias("t"), "c_acctbal")
    return offered.select("t").distinct().join(offered.where("c_acctbal > 9900").select("t"), "t", "left_anti")


@query("SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) AS cosine FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 0) b")
def embedding_cosine(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    first = [float(x) for x in e.where("vec_id = 0").first()["v"]]
    return e.select("vec_id", F.round(expr.cosine(F.col("v"), F.array(*[F.lit(x) for x in first])), 5).alias("cosine"))


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracle)

