"""Sharding, mixing and language identification."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from cloakframe.llm import langid, mix, shard
from cloakframe.llm.common import row_digest, whole_rows

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], SCHEMA)


def check_shards(rows, n):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(n))
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    return {s: sum(r.size for r in rs) for s, rs in by.items()}


def test_shards_are_near_equal_with_a_hot_group(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i} " + "x" * (i % 37), "en", "hot" if i % 2 else f"s{i % 5}") for i in range(3000)]
    out = shard.kd_shards(docs(spark, rows), n_shards=24).collect()
    assert len(out) == 3000 and {r.law for r in out} == {"bytes"}
    sizes = check_shards(out, 24)
    mean = sum(sizes.values()) / 24
    assert max(sizes.values()) < 1.06 * mean and min(sizes.values()) > 0.94 * mean
    text = {i: t for i, t, _, _ in rows}
    assert all(r.size == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in out)


def test_shards_of_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (None, "", "en", "a"), (2, "ü" * 1000, "de", None)]
    out = shard.kd_shards(docs(spark, rows), n_shards=24).collect()
    check_shards(out, 24)
    assert sorted((r.size, r.text_crc32) for r in out) == sorted([(8, 0), (8, 0), (8, 0), (2008, zlib.crc32(("ü" * 1000).encode()))])
    assert shard.kd_shards(docs(spark, []), n_shards=24).count() == 0
    out = shard.kd_shards(docs(spark, [(i, "y" * 92, "en", "a") for i in range(64)]), target_bytes=1600)
    assert out.select("shard").distinct().count() == 4


def test_with_shards_keeps_columns_that_clash(spark):
    d = docs(spark, [(1, "a", "en", "s"), (1, "a", "en", "s")]).withColumn("shard", F.lit("mine"))
    out = shard.with_shards(d, n_shards=2)
    assert out.columns == [*d.columns, "_shard"] and [r["shard"] for r in out.collect()] == ["mine", "mine"]


def targets(words, weights=(3, 1, 2), share=1.5, cap=2):
    names = sorted((s for s in words if s is not None), key=lambda s: s) + ([None] if None in words else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    want, open_, out = share * sum(words.values()), set(names), {}
    while open_:
        level = (want - sum(out.values())) / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > cap * words[s]}
        if not over:
            return out | {s: level * w[s] for s in open_}
        for s in over:
            out[s] = cap * words[s]
        open_ -= over
    return out


def test_mix_meets_targets_and_reruns_agree(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 50)), "en", "hot" if i % 3 == 0 else [None, "a", "b", "zz"][i % 4]) for i in range(4000)]
    d = docs(spark, rows)
    out = {r.doc_id: r for r in mix.mix(d).collect()}
    words = {}
    for i, t, _, s in rows:
        assert out[i].size == len(t.split()) and out[i].taken in (0, out[i].size, 2 * out[i].size)
        words[s] = words.get(s, 0) + len(t.split())
    want = targets(words)
    for s, n in words.items():
        mine = [r for r in (out[i] for i, _, _, x in rows if x == s)]
        assert mine[0].source_size == n and mine[0].target == pytest.approx(want[s])
        assert sum(r.taken for r in mine) == pytest.approx(want[s], rel=0.01, abs=60)
    again = {r.doc_id: r.taken for r in mix.mix(d.repartition(5)).collect()}
    assert again == {i: r.taken for i, r in out.items()}


def test_mix_of_odd_rows(spark):
    rows = [(1, None, "en", None), (2, "", "en", "a"), (3, "one", "en", "b"), (3, "one", "en", "b")]
    out = mix.mix(docs(spark, rows)).collect()
    assert len(out) == 4 and all(r.taken <= 2 * r.size for r in out)
    assert mix.mix(docs(spark, [])).count() == 0
    kept = whole_rows(docs(spark, rows), mix.times(docs(spark, rows)))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert kept.count() == sum(r.copies for r in out)


def test_mix_of_one_repeated_row(spark):
    rows = [(1, "en", "a", "two words")] * 2000 + [(i, "en", "b", "of three words") for i in range(100)]
    df = spark.createDataFrame([(i, t, x, s, len(t)) for i, x, s, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = mix.mix(df).collect()
    by = {t: sum(r.taken for r in out if r.target == t) for t in {r.target for r in out}}
    assert len(out) == 2100 and all(abs(v - t) <= 0.01 * t + 10 for t, v in by.items()), by
    assert sorted(r.taken for r in mix.mix(df.repartition(7)).collect()) == sorted(r.taken for r in out)


def test_whole_rows(spark):
    rows = [(1, "a", None), (1, "a", None), (None, None, 2), (None, 2 * "b", None), (3, "c", 3)]
    df = spark.createDataFrame(rows, "w1 long, times string, shard int")
    w1, w2 = row_digest(df)
    want = df.select(w1.alias("w1"), w2.alias("w2")).distinct().withColumn("times", F.lit(70_000)).withColumn("shard", F.lit(9))
    got = whole_rows(df, want.where("w1 is not null"))
    assert got.columns == ["w1", "times", "shard", "_shard"]
    assert got.count() == 4 * 70_000 and {tuple(r) for r in got.distinct().collect()} == {(*r, 9) for r in rows}
    assert whole_rows(df.limit(0), want).count() == 0


WORDS = {"en": "the of and with from house water light".split(), "de": "der die und nicht haus wasser licht für".split(), "fr": "le la et dans maison eau lumière être".split()}


def test_language_by_compression(spark):
    import random

    r = random.Random(1)
    rows = [(i, " ".join(r.choices(WORDS[k := list(WORDS)[i % 3]], k=30 + i % 40)), k, "s") for i in range(600)]
    rows += [(1000, None, "en", "s"), (1001, "12 34 !!", "en", "s"), (1002, "THE OF AND WATER!!", None, "s"), (1003, "haus wasser licht nicht und der die für " * 5000, "de", "s")]
    out = {x.doc_id: x for x in langid.identify(docs(spark, rows)).collect()}
    assert len(out) == 604 and out[1000].lang_pred == out[1001].lang_pred == "und" and out[1000].rejected
    held = [i for i, *_ in rows[:600] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(out[i].lang_pred == rows[i][2] for i in held) >= 0.98 * len(held)
    assert (out[1002].lang_pred, out[1003].lang_pred) == ("en", "de") and all(0 <= x.score <= 1 for x in out.values())


def test_language_of_empty_tables_and_clashes(spark):
    assert langid.identify(docs(spark, [])).count() == 0
    d = docs(spark, [(1, "the house", "en", "s")]).withColumn("score", F.lit("x")).withColumn("judged", F.lit(1))
    r = langid.predict(d, langid.Model(("en",), (b"the house " * 200,))).first()
    assert r.lang_pred == "en" and r.score == 1.0 and r.judged == 1


def test_rare_label_leaves_other_dictionaries_whole(spark):
    r = random.Random(4)
    letters = {"aa": "abcdefgh", "bb": "mnopqrst"}
    rows = [(i, " ".join("".join(r.choices(letters[x], k=6)) for _ in range(30)), x) for i, x in enumerate(["aa", "bb"] * 60)]
    schema = "doc_id bigint, text string, lang string"
    plain = langid.fit(spark.createDataFrame(rows, schema))
    rare = langid.fit(spark.createDataFrame([*rows, (999, "xyz", "zz")], schema))
    assert min(map(len, plain.dicts)) > 4096
    assert dict(zip(rare.langs, rare.dicts, strict=True)) == dict(zip(plain.langs, plain.dicts, strict=True)) | {"zz": b"xyz"}
