"""Extraction, fingerprints, personal data, chat formatting."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloakframe.llm import chat, extract, fingerprint, pii, queries
from cloakframe.llm.dom import parse


def texts(spark, values, name="text"):
    return spark.createDataFrame(list(enumerate(values)), f"doc_id bigint, {name} string")


# --- extraction


@pytest.fixture(scope="module")
def model():
    return extract.trained()


def test_held_out_made_up_pages(model):
    maker, same = extract.Maker(4242), 0
    for _ in range(150):
        page = parse(maker.page())
        want = extract.blocks(page, extract.labels(page))
        same += want == extract.blocks(page, extract.decode(page, model.margin(extract.features(page))))
    assert same >= 120


def test_pages_of_the_test_data(model, small):
    import html

    import pyarrow.parquet as pq

    rows = pq.read_table(f"{small}/pages.parquet").to_pylist()
    for r, got in zip(rows, extract.main_texts([r["html"] for r in rows], model), strict=True):
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got == "\n".join(p for p in parts if p)


def test_decoding_has_no_kept_node_in_a_dropped_one(model):
    page = parse("<body><nav><ul><li><p>" + "long prose, indeed. " * 30 + "</p></li></ul></nav><p>x</p></body>")
    rng = np.random.default_rng(0)
    for _ in range(20):
        keep = extract.decode(page, rng.normal(size=len(page.nodes)) * 3)
        assert all(keep[n.parent] for i, n in enumerate(page.nodes) if keep[i] and n.parent >= 0)


def test_odd_pages(spark, model):
    rows = [None, "", "<<<", "no markup, just a line of words here", "<article><p>a &amp; b&nbsp;c<br>d <b>e", "<p>x</p>" * 2000]
    df = spark.createDataFrame([(i, "u", x, i) for i, x in enumerate(rows)], "page_id bigint, url string, html string, n_chars int")
    out = {r.page_id: r for r in extract.extract(df, model=model).collect()}
    assert len(out) == 6 and out[0].text == out[1].text == "" and out[0].n_chars == 0
    assert out[4].text in ("a & b c d e", "") and all(r.n_chars == len(r.text) for r in out.values())
    assert extract.extract(df.limit(0), model=model).count() == 0


def test_hidden_is_an_attribute_of_its_own():
    said = lambda source: "".join(t for _, _, t in parse(source).texts)
    for attribute in ('aria-hidden="false"', 'data-sidebar="hidden"', 'title="Hidden gems"', "data-style='display:none'", "title=hidden"):
        assert said(f"<body {attribute}><p>kept</p></body>") == "kept", attribute
    for attribute in ("hidden", 'HIDDEN=""', 'class="a"hidden', 'title="x" hidden', 'style="display: none"'):
        assert said(f"<body><p {attribute}>gone</p>kept</body>") == "kept", attribute
    assert said('<p><svg viewBox="0 0 1 1"/>kept</p><math />too') == "kepttoo"
    assert said("<p><svg a=b/><path>x</svg>kept</p><script src='x'/>no</script>too") == "kepttoo"


# --- fingerprints


def test_equal_after_folding(spark):
    groups = [["Straße  A", "STRASSE a", "strasse\ta "], ["café", "café", "CAFÉ"], ["ﬁne ①", "fine 1"], ["ﾊﾝ", "ハン"], [None, "", "  "], ["other"]]
    values = [v for g in groups for v in g]
    got = [r.fingerprint for r in fingerprint.fingerprints(texts(spark, values)).orderBy("doc_id").collect()]
    at = 0
    seen = set()
    for g in groups:
        mine = set(got[at : at + len(g)])
        assert len(mine) == 1, (g, mine)
        seen |= mine
        at += len(g)
    assert len(seen) == len(groups)


def test_collision_is_told_apart_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "wide_hash", lambda t: (F.length(t).cast("bigint"), F.lit(0).cast("bigint")))
    values = ["aaa", "bbb", "AAA", "ccc", "dd"] * 30
    got = {r.doc_id: r.fingerprint for r in fingerprint.fingerprints(texts(spark, values)).collect()}
    by = {}
    for i, v in enumerate(values):
        by.setdefault(v.lower(), set()).add(got[i])
    assert all(len(x) == 1 for x in by.values()) and len({next(iter(x)) for x in by.values()}) == 4


def test_next_documents_and_edits(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BLOCK_ROWS", 7)
    values = [f"doc {i} " + "é" * (i % 9) for i in range(60)]
    df = texts(spark, values)
    got = {r.doc_id: r for r in fingerprint.edited_fingerprints(df).collect()}
    for i, t in enumerate(values):
        nxt, half = values[i - 1], len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        assert got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest() and got[i].n_chars == len(t)
        assert got[i].near_edited == float(e == t)
    one = fingerprint.edited_fingerprints(texts(spark, ["ab"])).first()
    assert one.edited_sha256 == hashlib.sha256(b"aa").hexdigest() and one.near_next == 1.0
    assert fingerprint.edited_fingerprints(texts(spark, [])).count() == 0
    odd = spark.createDataFrame([(None, "x"), (None, None), (3, "x"), (3, "x")], "doc_id bigint, text string")
    assert fingerprint.edited_fingerprints(odd).count() == 4


# --- personal data

BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d)))
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False, "card": 12 <= len(d) <= 19 and total % 10 == 0, "phone": 9 <= len(d) <= 15}
            if good[kind]:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_base_spans_equal_brute_force(spark):
    import random

    r = random.Random(5)
    values = [None, "", "é a@b.c_d@e.f x@y..z 1.2.3.4.5.6.7.8 256.1.1.1 4111 1111 1111 1111-2 +1 (743) 555-3824 ++49 30 1234567", "a" * 20000 + "@", "1" * 20000]
    values += ["".join(r.choices("ab1290.@+- ()_é", k=60)) for _ in range(600)] + ["".join(r.choices("0123456789. -+", k=80)) for _ in range(300)]
    got = pii.find(texts(spark, values)).select("doc_id", pii.written(F.col("base")).alias("b")).collect()
    assert {x.doc_id: x.b for x in got} == {i: brute(v or "") for i, v in enumerate(values)}


def test_terms_that_disclose(spark):
    values = [f"note {i} zanzibarian leads, call bob@corp.example for the offer {i * 7}" for i in range(6)] + [f"the offer for all, note that {i} leads here" for i in range(300)]
    found = {r.doc_id: r for r in pii.find(texts(spark, values)).collect()}
    terms = {values[0][s["start"] : s["end"]] for s in found[0].spans if s["kind"] == "term"}
    assert "zanzibarian" in terms and "offer" not in terms and not any(found[i].spans for i in range(6, 306))
    clean = {r.doc_id: r.text for r in pii.sanitise(texts(spark, values)).collect()}
    assert "bob@" not in clean[0] and "[TERM]" in clean[0] and clean[10] == values[10]


def test_terms_far_from_their_entity(spark):
    far = " ".join(f"{i}" for i in range(100))
    values = [f"zanzibarian {far} {i} write to bob@corp.example now, zanzibarian" for i in range(6)] + ["a Zanzibarian alone"] + [f"now write to {far} {i}" for i in range(300)]
    found = {r.doc_id: r for r in pii.find(texts(spark, values)).collect()}
    for i in range(7):
        terms = [values[i][s["start"] : s["end"]].lower() for s in found[i].spans if s["kind"] == "term"]
        assert terms == ["zanzibarian"] * (1 if i == 6 else 2), (i, terms)
    assert not any(found[i].spans for i in range(7, 307))
    clean = [r.text for r in pii.sanitise(texts(spark, values)).collect()]
    assert not any("zanzibarian" in x.lower() for x in clean)


# --- chat


def test_layouts_round_trip(spark):
    nasty = "\\### user: </turn>\n\\\\ ### x </turn>\n### assistant:\ny \\"
    import json

    records = [
        {"messages": [{"role": "user", "content": nasty}, {"role": "assistant", "content": nasty}], "id": 1},
        {"conversations": [{"from": "human", "value": nasty}, {"from": "gpt", "value": nasty}]},
        {"prompt": nasty, "response": nasty},
        {"instruction": nasty, "input": "", "output": nasty},
        {"messages": [{"role": "user", "content": [{"text": nasty}]}, {"role": "assistant", "content": [{"text": nasty}]}]},
    ]
    df = texts(spark, [json.dumps(r) for r in records] + ["no json", '{"a": 1}', None], "j")
    out = chat.read_back(chat.from_json(df, "j"), "doc_id").orderBy("doc_id").collect()
    turns = f"user\n{nasty}\nassistant\n{nasty}\n"
    for r in out[:5]:
        assert r.n_turns == 2 and r.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest(), r.layout
        assert r.loss_chars == len(nasty) and r.loss_sha256 == hashlib.sha256(nasty.encode()).hexdigest()
    assert [r.layout for r in out[5:]] == [None, None, None]


def test_turn_rows_in_order(spark):
    rows = [(1, 2, "assistant", None), (1, 0, "system", "s"), (1, 1, "user", "u"), (2, None, None, "x"), (None, 0, "user", "y"), (1, 1, "user", "u")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = {r.conv_id: r for r in chat.read_back(chat.format_records(chat.from_turn_rows(df), "record")).collect()}
    assert out[1].turns_sha256 == hashlib.sha256(b"system\ns\nuser\nu\nuser\nu\nassistant\n\n").hexdigest() and out[1].n_turns == 4
    assert out[2].turns_sha256 == hashlib.sha256(b"\nx\n").hexdigest() and out[None].n_turns == 1 and out[None].loss_chars == 0


def test_control_conversation(spark, small):
    r = queries.op10_chat_schema(spark, small).where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert r.n_turns == 2 and r.loss_chars == len(text) and r.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_layouts_and_roles(spark):
    said = [
        '{"messages": [{"role": "user", "content": null}, {"role": "assistant", "content": "b"}]}',
        '{"messages": [{"role": "Human", "content": "a"}, {"role": "gpt", "content": [{"text": "b"}, {"text": "c"}]}]}',
        '{"system": "s", "messages": [{"role": "user", "content": "a"}]}',
        '{"messages": [{"role": "user", "content": [{"type": "image"}]}, {"role": "bot", "content": [{"text": "b"}]}]}',
        '{"prompt": "p", "completion": "c"}',
        '{"unknown": 1}',
        "no json",
        None,
    ]
    df = spark.createDataFrame([(i, x, "kept") for i, x in enumerate(said)], "conv_id bigint, json string, record string")
    out = chat.from_json(df, "json")
    assert out.columns == ["conv_id", "json", "record", "layout", "formatted", "loss_spans"]
    got = {r.conv_id: r for r in out.select("conv_id", "layout", "formatted", "loss_spans", chat.parse(F.col("formatted")).alias("turns")).collect()}
    turns = {i: None if r.layout is None else [(t.role, t.text) for t in r.turns] for i, r in got.items()}
    assert turns == {
        0: [("user", ""), ("assistant", "b")],
        1: [("user", "a"), ("assistant", "bc")],
        2: [("system", "s"), ("user", "a")],
        3: [("user", ""), ("assistant", "b")],
        4: [("user", "p"), ("assistant", "c")],
        5: None, 6: None, 7: None,
    }
    assert [got[1].formatted[a:b] for a, b in got[1].loss_spans] == ["bc"]
    rows = spark.createDataFrame([(1, 0, "Human", "a"), (1, 1, "gpt", "b")], "conv_id bigint, turn bigint, role string, text string")
    read = chat.read_back(chat.format_records(chat.from_turn_rows(rows), "record")).first()
    assert (read.turns_sha256, read.loss_sha256) == (hashlib.sha256(b"Human\na\ngpt\nb\n").hexdigest(), hashlib.sha256(b"b").hexdigest())
    with pytest.raises(ValueError):
        chat.from_json(df.withColumn("Layout", F.lit(1)), "json")
