import json
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cloakframe.functions import detect, udtf
from cloakframe.model import Action, action_of, entities_of
from cloakframe.operators import profile, residual, scan, tiers


@pytest.mark.parametrize(
    ("text", "entity", "piece"),
    [
        ("write to jane.roe@corp.example today", "EMAIL_ADDRESS", "jane.roe@corp.example"),
        ("host at 2001:db8::1 is up", "IP_ADDRESS", "2001:db8::1"),
        ("she was born on 1984-03-12", "DATE_OF_BIRTH", "1984-03-12"),
        ("paid by 4111 1111 1111 1111.", "CREDIT_CARD", "4111 1111 1111 1111"),
        ("wire to GB82WEST12345698765432", "IBAN_CODE", "GB82WEST12345698765432"),
        ("VAT DE123456789", "EU_VAT", "DE123456789"),
        ("lives at 12 Rue de la Gare", "STREET_ADDRESS", "12 Rue"),
        ("her salry is EUR 55,000 annual salary", "SALARY", "EUR 55,000"),
        ("he has diabtes", "HEALTH_CONDITION", "diabtes"),
        ("case no. 2021/CV/1234", "COURT_CASE", "case no. 2021/CV/1234"),
    ],
)
def test_found(text, entity, piece):
    got = detect.resolve(detect.analyze(text))
    assert any(e == entity and piece in text[s:t] or text[s:t] in piece and e == entity for e, s, t, _ in got), got


@pytest.mark.parametrize("text", ["the meeting is at noon", "version 1984-03-12 shipped", "about 12345 items", "PERSON_12"])
def test_clean(text):
    assert detect.is_token(text) or detect.resolve(detect.analyze(text)) == []


def test_what_is_looked_for_first_changes_no_finding(monkeypatch):
    """Texts of pieces of all patterns, in both cases and beyond ASCII, against every pattern on every text."""
    rng = random.Random(3)
    bits = "POL-AB12 pol/XY99 Policy PoL\u0131cy polizza no. # BK- RSV/ABCD case FILE docket \u017fache 2021/CV/77 invoice Facture INV-20 a@b.example HTTP://x www.y http\u017f://z ::1 2001:db8::1 1:2 AB-C1/D2 ABCDEF DEUTDEFF swift booking flight born 1984 \u0663\u0664 \u00b2 diabtes Kranke \u212aranke DE123456789 court contract".split()
    texts = ["".join(rng.choice(bits) + rng.choice((" ", " ", "", "\n")) for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    quick = [detect.analyze(t) for t in texts]
    whole = [replace(r, digits=False, pieces=()) for r in detect._recognizers()]
    monkeypatch.setattr(detect, "_recognizers", lambda: whole)
    assert quick == [detect.analyze(t) for t in texts] and any(quick)


def test_spread(spark):
    one = spark.range(5).coalesce(1)
    wide = spark.range(0, 500, 1, 500)
    assert scan.spread(one).rdd.getNumPartitions() == scan.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    assert scan.spread(wide) is wide and scan.spread(one).count() == 5


def test_iban_before_words_and_beyond_ascii():
    """Words after the account number do not hide it; letters without a value are none."""
    for text, said in (("wire to GB82WEST12345698765432 now please", "GB82WEST12345698765432"), ("GB82 WEST 1234 5698 7654 32 is ours", "GB82 WEST 1234 5698 7654 32"), ("GB83WEST12345698765432 now", None), ("to \\u212aW82WEST12345698765432 now", None)):
        assert [text[s:e] for x, s, e, _ in detect.analyze(text) if x == "IBAN_CODE"] == ([said] if said else [])


def test_overlaps():
    found = [("A", 0, 5, 0.5), ("B", 3, 9, 0.9), ("C", 9, 12, 0.4), ("D", 0, 3, 0.4)]
    assert [f[0] for f in detect.resolve(found)] == ["D", "B", "C"]


def test_edits():
    assert detect.within_edits("abcd", "abxd", 1) and detect.within_edits("abcd", "acd", 1)
    assert not detect.within_edits("abcd", "badc", 1)


def test_scan_masks_text_and_documents(spark):
    rows = [(0, "mail a@b.example or a@b.example"), (1, json.dumps({"mail": "c@d.example", "n": 5, "a@b.example": [True]})), (2, None), (3, "clean"), (4, '["x", {"y": "EMAIL_ADDRESS_9"}]')]
    df = spark.createDataFrame(rows, "i int, t string")
    out, counts = scan.anonymize(df, ["t", "gone"], F.col("i"))
    got = {r.i: r.t for r in out.collect()}
    assert got[0] == "mail EMAIL_ADDRESS_0 or EMAIL_ADDRESS_0"
    assert json.loads(got[1]) == {"mail": "EMAIL_ADDRESS_1", "n": 5, "EMAIL_ADDRESS_0": [True]}
    assert (got[2], got[3], json.loads(got[4])) == (None, "clean", ["x", {"y": "EMAIL_ADDRESS_9"}])
    assert {(r.column, r.entity): r.n for r in counts.collect()} == {("t", "EMAIL_ADDRESS"): 4}


def test_residual(spark):
    df = spark.createDataFrame(
        [("a@b.example", "+352 621 123 456", "http://x.example", "paid by 4111 1111 1111 1111 today", '{"a":[{"mail":"c@d.example"}]}', "PERSON_1"), (None, None, None, None, None, None)],
        "mail string, phone string, source_file string, note string, payload string, token string",
    )
    got = {(r.column, r.path, r.entity): r.n for r in residual.findings(df).collect()}
    assert got[("mail", None, "EMAIL_ADDRESS")] == 1 and got[("phone", None, "PHONE_NUMBER")] == 1
    assert got[("payload", "$.a[0].mail", "EMAIL_ADDRESS")] == 1
    assert got[("note", None, "CREDIT_CARD")] == 1
    assert not any(c in ("source_file", "token") for c, _, _ in got)
    with pytest.raises(ValueError, match="mail.EMAIL_ADDRESS=1") as error:
        residual.validate(df)
    assert "a@b" not in str(error.value)
    assert residual.summary(df.select("token")) == (0, "")


def test_tiers(spark):
    rows = [(f"id{i}x", f"p{i}@x.example", "some longer words of a free text comment here", "blue", i) for i in range(8)]
    df = spark.createDataFrame(rows, "customer_id string, c47 string, notes string, paint string, n int")
    got = tiers.classify(df)
    assert got["customer_id"].action == Action.HASH and got["customer_id"].source == "name_pattern"
    assert got["c47"].entity == "EMAIL_ADDRESS" and got["c47"].action == Action.TOKENIZE
    assert got["notes"].action == Action.SCAN and got["paint"].action == Action.BIN and "n" not in got
    must = tiers.classify(df, labels={"paint": ["Custom.Must"], "n": ["X.PERSONAL.NAME"]}, must="custom.MUST")
    assert must["paint"].action == Action.REDACT and must["n"].entity == "PERSON"
    assert tiers.by_likeness(["emailAddress", "zzz"]).keys() == {"emailAddress"}


def test_action_map_and_regions():
    assert action_of("PERSON") == Action.TOKENIZE and action_of("POSTAL_CODE") == Action.SCAN
    assert "US_SSN" in entities_of() and "US_SSN" not in entities_of(("eu",)) and "EU_VAT" not in entities_of(("uk",))


def test_profiles(spark):
    df = spark.createDataFrame([(i, i % 3, "m" if i % 2 else "f", f"AB-{i}x", True) for i in range(20)], "n int, age int, sex string, code string, flag boolean")
    got = {p.name: {str(c) for c in p.categories} for p in profile.classify(df)}
    assert "identifier" in got["code"] and "quasi_identifier" in got["age"] and "quasi_identifier" in got["sex"]
    assert "quasi_identifier" not in got["n"] and "sensitive" not in got["flag"]


def test_gps_time_and_speed_columns(spark):
    df = spark.createDataFrame([(1.0, "2.5", 200.0, "POINT (1 2)", "2024-01-01", 50.0), (None, None, None, None, None, 400.0)] * 1 + [(1.5, "3", 10.0, "point(3 4)", "01/02/2024", 60.0)] * 9, "lat double, lon string, gps_x double, place string, created string, speed double")
    assert profile.gps_columns(df) == ["lat", "lon", "place"]
    assert profile.timestamp_columns(df) == ["created"]
    assert profile.speed_column(df) == "speed"


def test_table_function(spark):
    udtf.register(spark)
    got = spark.sql("SELECT entity FROM find_pii('mail a@b.example')").collect()
    assert [r.entity for r in got] == ["EMAIL_ADDRESS"]
