"""Near duplicates, repeated passages, decontamination, components, the pipeline."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from cloakframe.llm import decontaminate, ngramjoin, substrings, textscan
from cloakframe.llm.common import Scratch
from cloakframe.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    at = list(range(len(rows)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                at[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least.setdefault(find(i), []).append(k)
    return sorted((rows[i][0], len(sets[i]), min(least[find(i)]) if sets[i] else rows[i][0]) for i in range(len(rows)))


def edited(r, words, share):
    return [f"n{r.randint(0, 10**6)}" if r.random() < share else w for w in words]


def family_rows(seed, n=150):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    bases = [r.choices(vocabulary, k=r.randint(1, 90)) for _ in range(6)]
    shared = r.choices(vocabulary, k=60)
    rows = []
    for i in range(n):
        words = edited(r, r.choice(bases), r.choice([0, 0, 0.01, 0.03, 0.05, 0.1]))
        if r.random() < 0.2:
            words = words + shared
        rows.append((i, r.choice([" ", "\n", "\t "]).join(words)))
    return rows


@pytest.mark.parametrize(("seed", "hot"), [(1, 31), (2, 31), (3, 1)])
def test_join_equals_brute_force(spark, seed, hot):
    rows = family_rows(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = ngramjoin.join_components(df, bits=12, hot_level=hot).collect()
    assert sorted(map(tuple, got)) == brute_components(rows)


def test_join_in_parts_and_blocks_equals_brute_force(spark):
    rows = family_rows(4, 120)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = ngramjoin.join_components(df, bits=12, hot_level=1, block_rows=8).collect()
    assert sorted(map(tuple, got)) == brute_components(rows)


def test_join_of_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(30000))
    rows = [(5, None), (6, ""), (7, " \n "), (8, "A b"), (9, "a B"), (9, "a B"), (10, "a b c"), (3, long), (4, long + " y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, ngramjoin.join_components(df).collect()))
    assert got == sorted([(5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 1, 8), (9, 1, 8), (9, 1, 8), (10, 1, 10), (3, 29996, 3), (4, 29997, 3)])
    assert ngramjoin.join_components(df.limit(0)).count() == 0
    null = spark.createDataFrame([(None, "a b c d e f"), (2, "a b c d e f"), (None, "z")], "doc_id bigint, text string")
    assert sorted(map(tuple, ngramjoin.join_components(null).collect()), key=repr) == sorted([(None, 2, 2), (2, 2, 2), (None, 1, None)], key=repr)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x0b\x1fü", max_size=40)), max_size=8))
def test_words_are_those_of_the_pattern(values):
    got = []
    for _, data, at in textscan.pieces(pa.array(values, pa.string()), size=16):
        w = textscan.words(data, at)
        for i in range(len(at) - 1):
            got.append([bytes(data[s:e]).decode() for s, e in zip(w.start[w.first[i] : w.first[i + 1]], w.end[w.first[i] : w.first[i + 1]], strict=True)])
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", v or "") for v in values]


def test_equal_words_have_equal_hashes():
    for piece in (8, 1 << 20):
        h = [x for _, data, at in textscan.pieces(pa.array(["The cat", "a THE", "the"]), size=piece) for x in textscan.words(data, at).hash.tolist()]
        assert h[0] == h[3] == h[4] and len(set(h)) == 3


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(500, 500)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.root for r in components(df, Scratch(spark, "t")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 40)}
    assert components(df.limit(0), Scratch(spark, "t")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=80), st.integers(1, 9))
def test_compact_windows_equal_definition(values, least):
    h = np.array(values, np.uint64)
    got = set(zip(*[map(int, x) for x in (lambda g: (g[2], g[3], g[4]))(substrings.compact_windows(h, np.array([0, len(h)]), 3, least))], strict=True))
    x = textscan.mix64(h ^ np.uint64((3 * 0x9E3779B97F4A7C15) & (2**64 - 1)))
    want = set()
    for c in range(len(x)):
        left = right = c
        while left > 0 and x[left - 1] > x[c]:
            left -= 1
        while right + 1 < len(x) and x[right + 1] >= x[c]:
            right += 1
        if right - left + 1 >= least:
            want.add((left, c, right))
    assert got == want


@pytest.mark.parametrize("hot", [31, 0])
def test_repeated_passages(spark, hot):
    r = random.Random(9)
    fresh = lambda n: [f"u{r.randint(0, 10**9)}" for _ in range(n)]
    passage, second = fresh(60), fresh(80)
    rows = [(i, " ".join(fresh(100) + passage + fresh(r.randint(0, 50)))) for i in range(12)]
    rows += [(20, " ".join(second + fresh(30))), (21, " ".join(fresh(30) + edited(r, second, 0.01))), (30, " ".join(fresh(200))), (31, " ".join(fresh(49))), (32, rows[3][1].split(" ", 40)[0])]
    rows += [(40, " ".join(fresh(70)))] * 2 + [(41, None), (42, "")]
    got = {x.doc_id: x for x in substrings.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string"), hot_level=hot).collect()}
    assert {*range(12), 20, 40} <= set(got) <= {*range(12), 20, 21, 40}
    text = dict(rows)
    for i in range(12):
        assert any(s.start <= 100 and s.stop >= 160 and s.stop - s.start <= 64 for s in got[i].spans), (got[i], len(text[i].split()))
    assert all(got[i].partner_id in range(12) and got[i].partner_id != i for i in range(12)) and got[40].repeated_words == 70
    assert substrings.repeated_passages(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_compact_windows_of_many_texts_take_little():
    r = np.random.default_rng(5)
    h = r.integers(0, 2**63, 260_000).astype(np.uint64)
    h[100_000:101_000] = np.tile(h[:10], 100)  # minima that come again
    offsets = np.append(np.arange(0, len(h), 650), len(h))
    begun = time.process_time()
    got = substrings.compact_windows(h, offsets, 1, 46)
    took = time.process_time() - begun
    begun = time.process_time()
    for _ in range(8):
        np.sort(h)
    assert len(got[0]) and took < time.process_time() - begun


def test_passages_that_come_again():
    word = lambda n, x: [f"{x}{i}" for i in range(n)]
    p = word(55, "p")

    def hashes(words):
        return next(textscan.shingle_pieces(pa.array([" ".join(words)])))[1]

    a, b = hashes(p), hashes(p[:25] + word(30, "o") + p)
    assert [x[:4] for x in substrings.passages(a, b)] == [(0, 55, 55, 110)]
    assert [x[:2] for x in substrings.passages(b, a)] == [(55, 110)]
    twice = hashes(word(40, "q") + p + word(60, "r") + p)
    assert {x[:2] for x in substrings.passages(twice, a)} == {(40, 95), (155, 210)}
    assert substrings.passages(hashes(word(80, "s")), a) == [] == substrings.passages(hashes([]), a)


def test_noisy_copies_of_one_passage(spark):
    r = random.Random(4)
    fresh = lambda n: [f"u{r.randint(0, 10**9)}" for _ in range(n)]
    passage = fresh(70)
    rows = [(i, " ".join(fresh(60) + edited(r, passage, 0.02) + fresh(60))) for i in range(40)] + [(100 + i, " ".join(fresh(150))) for i in range(5)]

    def hashes(t):
        return next(textscan.shingle_pieces(pa.array([t])))[1]

    h = [hashes(t) for _, t in rows]
    want = {rows[i][0] for i in range(len(rows)) if any(j != i and substrings.passages(h[i], h[j]) for j in range(len(rows)))}
    got = {x.doc_id for x in substrings.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got <= want <= set(range(40)) and len(got) >= 0.9 * len(want), (len(got), len(want))


def test_templates(spark):
    bench = spark.createDataFrame([(1, "A train leaves Boston at 5 hours with 120 passengers and Alice has 5 apples left over"), (2, "too short"), (3, "what is the capital city"), (4, None)], "item_id bigint, text string")
    rows = [
        (1, "blah blah. A train leaves Paris at 7 hours with 300 passengers and Bob has 7 apples left over indeed"),
        (2, "A train leaves Paris at 7 hours with 300 passengers and Bob has 9 apples left over"),
        (3, None), (4, ""), (None, "well: What is the capital city of x"), (5, "nothing of that sort is here at all my friend"),
        (6, "A TRAIN LEAVES BOSTON"), (7, "x " * 50000 + "a train leaves Boston at 5 hours with 120 passengers and Alice has 5 apples left over"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, item_id int")
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()), key=repr)
    assert got == sorted([(1, 1), (None, 3), (7, 1)], key=repr)
    kept = decontaminate.without_leaks(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 6]
    assert decontaminate.leaks(df, bench.limit(0)).count() == 0 and decontaminate.leaks(df.limit(0), bench).count() == 0


def test_templates_of_mostly_placeholders(spark):
    numbers = "Add 12 and 7 to 31, then 45, 9, 18, 22, 6, 14, 3 and 8"
    story = "the first of the boxes in that old room weighs 5 kg and the second of the boxes also weighs 5 kg in all"
    bench = spark.createDataFrame([(1, numbers), (2, story)], "item_id bigint, text string")
    other = "Add 1 and 2 to 3, then 4, 5, 16, 27, 38, 49, 50 and 61"
    rows = [(1, f"see here: {numbers} indeed"), (2, other), (3, story.replace("also weighs 5", "also weighs 6")), (4, f"{story} so")]
    got = {(r.doc_id, r.item_id): (r.matched, r.windows) for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()}
    assert set(got) == {(1, 1), (3, 2), (4, 2)}
    assert got[1, 1][0] == got[1, 1][1] and got[4, 2][0] == got[4, 2][1] and got[3, 2][0] < got[3, 2][1]


def test_pipeline(spark, small):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, docs.count()
    kept = [before]
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = Scratch(spark, name).keep(stage(spark, docs, small))
        assert docs.columns == columns
        kept.append(docs.count())
    assert kept[1] >= 0.97 * before and kept[1] >= kept[2] >= kept[3]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert all(c == k for k, _, c in brute_components(rows))
    out = corpus_pipeline.run(spark, small)
    assert out.columns == [*corpus_pipeline.COLUMNS, "shard"] and out.where("shard not between 0 and 23").count() == 0
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} <= {k for k, _ in rows}
