import hashlib
import hmac
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cloakframe.functions import expr
from cloakframe.operators import columns as cols
from cloakframe.operators import groups, tokens

SECRET = expr.local_secret("t")


@pytest.mark.parametrize("secret", [SECRET, b"k" * 100])
def test_pseudonym_is_hmac(spark, secret):
    values = ["a", "né", "", None, "x" * 500]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in cols.pseudonymize(df, ["v", "gone"], secret)[0].collect()]
    want = [None if v is None else hmac.new(secret, v.encode(), hashlib.sha256).hexdigest()[:24] for v in values]
    assert got == want


def test_pseudonym_of_numbers_and_nan(spark):
    df = spark.createDataFrame([(7, float("nan"), True), (None, 1.5, None)], "i int, d double, b boolean")
    out = cols.pseudonymize(df, ["i", "d", "b"], SECRET)[0].collect()
    assert out[0].d is None and out[1].i is None and out[1].b is None
    assert out[0].i == hmac.new(SECRET, b"7", hashlib.sha256).hexdigest()[:24]
    assert out[0].b == hmac.new(SECRET, b"True", hashlib.sha256).hexdigest()[:24]
    with pytest.raises(ValueError):
        cols.pseudonymize(df, ["i"], None)


def test_round_gps_numbers_strings_and_wkt(spark):
    df = spark.createDataFrame([(1.26, "2.345", "POINT (6.13 49.611)", "x 1.99 y"), (None, None, None, None)], "lat double, lon string, geom string, other string")
    r = cols.round_gps(df, ["lat", "lon", "geom", "none"], 1).collect()
    assert (r[0].lat, r[0].lon, r[0].geom, r[0].other) == (1.3, 2.3, "POINT (6.1 49.6)", "x 1.99 y")
    assert tuple(r[1]) == (None, None, None, None)
    assert cols.round_gps(df.select("geom"), ["geom"], 0).first().geom == "POINT (6.0 50.0)"


def test_floor_days_keeps_types(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 1, 13, 5), date(2024, 3, 1), "2024-03-01 13:05")], "a timestamp_ntz, d date, s string")
    out, listed = cols.floor_days(df, ["a", "d", "s"])
    assert listed == ["a", "d"] and out.schema["a"].dataType == df.schema["a"].dataType
    assert tuple(out.first()) == (datetime(2024, 3, 1), date(2024, 3, 1), "2024-03-01 13:05")


def test_bins_by_hand(spark):
    df = spark.createDataFrame([(float(v), 5.0) for v in (10, 20, 30, 40, 50, 60)] + [(None, 5.0)], "v double, same double")
    out, listed = cols.bin_numbers(df, ["v", "same"])
    assert listed == ["v"]
    assert [r.v for r in out.collect()] == ["10–20", "10–20", "20–30", "30–40", "40–50", "50–60", None]
    assert out.first().same == 5.0


@pytest.mark.parametrize("how", ["join", "window"])
def test_k_anonymity_keeps_null_groups(spark, how):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "a"), (2, None)], "q int, r string")
    out = groups.k_anonymous(df, ["q", "r", "gone"], 2, how=how)
    assert sorted(map(tuple, out.collect()), key=repr) == [(1, "a"), (1, "a"), (None, "a"), (None, "a")]
    assert groups.suppressed(df, ["q", "r"], 2) == 1
    assert groups.k_anonymous(df, ["gone"], 2).count() == 5


def test_trajectory(spark):
    rows = [(1.0, 2.0, datetime(2024, 1, 1, 8, m), s) for m, s in ((0, 30.0), (5, 45.0), (9, 50.0))] + [(1.0, 2.0, datetime(2024, 1, 2, 8), 10.0), (1.0, 2.0, datetime(2024, 1, 1, 8, 30), None)]
    df = spark.createDataFrame(rows, "lat double, lon double, ts timestamp_ntz, speed double")
    got = groups.trajectory(df, ["lat", "lon"], "speed", "ts", 2).collect()
    assert len(got) == 1 and got[0].day_of_week == "Monday" and got[0].hour_of_day == 8 and got[0].ping_count == 3
    assert got[0].p85_speed_kmh == pytest.approx(48.5) and got[0].p50_speed_kmh == 45.0
    stats = groups.trajectory_stats(df, ["lat", "lon"], "speed", "ts", 2).first()
    assert (stats.cells_retained, stats.cells_total, stats.pings_suppressed) == (1, 2, 2)


def test_tokens_by_first_appearance_whatever_the_partitions(spark):
    values = ["Bob", " alice ", "Alice", "bob", None, "Zed "]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    for n in (1, 3, 8):
        out = tokens.tokenize(df.repartition(n), {"v": "PERSON"}, F.col("i")).orderBy("i")
        assert [r.v for r in out.collect()] == ["PERSON_0", "PERSON_1", "PERSON_1", "PERSON_0", None, "PERSON_2"]


def test_tokens_number_many_keys_in_order(spark):
    df = spark.range(1000).select(F.col("id").alias("i"), F.concat(F.lit("k"), (F.col("id") % 500).cast("string")).alias("v"))
    got = {r.i: r.v for r in tokens.tokenize(df.repartition(7), {"v": "E"}, F.col("i")).collect()}
    assert got == {i: f"E_{i % 500}" for i in range(1000)}


def test_checksums(spark):
    df = spark.createDataFrame([("4111 1111 1111 1111", "GB82WEST12345698765432", "10.0.0.1"), ("4111 1111 1111 1112", "GB83WEST12345698765432", "10.0.0.256")], "c string, i string, p string")
    got = df.select(expr.luhn(F.col("c")), expr.iban_ok(F.col("i")), expr.ipv4_ok(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [(True, True, True), (False, False, False)]
