"""Leak search against a quadratic alignment and on altered passages."""

import random

import numpy as np
import pytest

from flightloom.llm import leakage as L

RNG = random.Random(11)
VOCAB = ["".join(RNG.choice("bcdfghklmnprstvw") + RNG.choice("aeiou") for _ in range(RNG.randrange(2, 5))) for _ in range(900)]


def text(n, seed):
    rng = random.Random(seed)
    return [rng.choice(VOCAB) for _ in range(n)]


ITEMS = [(i, " ".join(text(60, 100 + i)).capitalize() + ". Answer: 95,0%02d." % i) for i in range(20)]
SCHEMA = "doc_id long, text string, item_id string"


def leaks(spark, docs, items=ITEMS):
    d = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(docs)], SCHEMA)
    e = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return {tuple(r) for r in L.leaked_items(d, e).collect()}


def inside(words, seed=1):
    return " ".join(text(40, seed)) + ". " + words + " " + " ".join(text(40, seed + 1))


def slice_of(item, a, b):
    return ITEMS[item][1].split()[a:b]


def test_passages_whole_and_altered(spark):
    rng = random.Random(3)
    scattered = slice_of(4, 5, 35)
    for k in (4, 11, 19, 26):
        scattered[k] = rng.choice(VOCAB)
    dropped = [w for k, w in enumerate(slice_of(5, 0, 30)) if k not in (7, 15, 22)]
    typos = [w[:1] + w[2:3] + w[1:2] + w[3:] if k % 6 == 5 else w for k, w in enumerate(slice_of(6, 10, 40))]
    docs = [
        inside(ITEMS[0][1]), inside(" ".join(slice_of(1, 20, 35))), inside("-- ".join(slice_of(2, 3, 25)).upper()), inside("\n> ".join(slice_of(3, 3, 25)).replace("a", "ａ")),
        inside(" ".join(scattered)), inside(" ".join(dropped)), inside(" ".join(typos)), inside(" ".join(slice_of(7, 0, 10))), inside(""), inside(" ".join(slice_of(8, 40, 62)).replace("95,008", "95.008")),
        None, "", inside(" ".join(slice_of(0, 0, 20)) + " " + " ".join(text(30, 77)) + " " + " ".join(slice_of(9, 0, 20))),
    ]
    assert leaks(spark, docs) == {(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (9, 8), (12, 0), (12, 9)}


def test_ten_words_and_like_texts_are_none(spark):
    frame = "the {} office of {} counted {} travellers on the way to {} before the {} timetable and kept {} of them out of the {} list"
    fill = lambda seed: frame.format(*text(7, seed))
    items = [(i, fill(i)) for i in range(12)]
    docs = [inside(fill(500 + i)) for i in range(10)] + [inside(" ".join(fill(3).split()[:10])), inside(fill(5))]
    assert leaks(spark, docs, items) == {(11, 5)}


def test_very_long_text_and_repeats(spark):
    long = " ".join(text(60_000, 9)) + " " + ITEMS[3][1] + " " + ITEMS[3][1] + " ".join(text(20_000, 10))
    assert leaks(spark, [long]) == {(0, 3)}


def test_empty_tables(spark):
    assert leaks(spark, []) == set() and leaks(spark, [ITEMS[0][1]], []) == set() and leaks(spark, ["x"], [(1, None), (2, "too short")]) == set()


def test_portions_give_the_same(spark, monkeypatch):
    docs = [inside(t) for _, t in ITEMS[:6]]
    whole = leaks(spark, docs)
    monkeypatch.setattr(L, "BYTES_PER_PASS", 1500)
    assert leaks(spark, docs) == whole == {(i, i) for i in range(6)}


def distance(p, t):
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p, 1):
        new = [i]
        for j, b in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh", "aéß1"])
def test_myers_equals_dynamic_programming(alphabet):
    rng = random.Random(1)
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    patterns = [make(rng.randrange(1, 65)) for _ in range(60)]
    texts = [make(rng.randrange(0, 100)) for _ in patterns]
    assert L.myers(patterns, texts).tolist() == [distance(p, t) for p, t in zip(patterns, texts)]
    assert L.myers([], []).tolist() == np.zeros(0).tolist()


@pytest.mark.parametrize("a,b", [("Ab-c 1,234!", "abc1234"), ("ＡＢ­​c", "abc"), ("Élan ﬁve", "elanfive"), ("", "")])
def test_squash(a, b):
    assert L.squash(a) == b


def test_passages_of_a_single_item(spark):
    altered = slice_of(0, 5, 35)
    for k in (9, 20):
        altered[k] = "zzzz"
    docs = [inside(" ".join(slice_of(0, 20, 35))), inside(" ".join(slice_of(0, 0, 15))), inside(" ".join(altered[:18])), inside(" ".join(slice_of(0, 0, 10))), inside(" ".join(slice_of(1, 0, 30)))]
    assert leaks(spark, docs, ITEMS[:1]) == {(0, 0), (1, 0), (2, 0)}


def test_verbatim_passage_of_words_that_all_items_share(spark):
    shared = " ".join(text(16, 900))
    items = [(i, shared + " " + " ".join(text(30, 1000 + i))) for i in range(8)]
    assert leaks(spark, [inside(shared), inside(" ".join(shared.split()[:10]))], items) == {(0, i) for i in range(8)}


def altered(words, wrong, rng):
    """The words with ``wrong`` of them, none at an end, changed, dropped or misspelt."""
    out = list(words)
    for k in rng.sample(range(1, len(words) - 1), wrong):
        out[k] = rng.choice([rng.choice(VOCAB), "", out[k][:-1] + "xq"])
    return " ".join(filter(None, out))


@pytest.mark.parametrize("wrong,least", [(0, 1.0), (1, 0.99), (2, 0.98), (3, 0.95)])
def test_recall_of_short_altered_passages(wrong, least):
    rng = random.Random(60 + wrong)
    trials = []
    for k in range(300):
        item = rng.randrange(len(ITEMS))
        at = rng.randrange(0, 45)
        trials.append((inside(altered(slice_of(item, at, at + 15), wrong, rng), seed=2000 + 2 * k), item))
    found = set(L.leaks_in([t for t, _ in trials], L.build_index(ITEMS)))
    assert sum((k, item) in found for k, (_, item) in enumerate(trials)) >= least * len(trials)
    assert all(item == trials[k][1] for k, item in found)


def test_what_an_item_finds_does_not_depend_on_the_others(spark, monkeypatch):
    rng = random.Random(70)
    shared = " ".join(text(30, 901))
    items = [(i, " ".join(text(20, 1100 + i)) + " " + shared) for i in range(60)]
    docs = [inside(" ".join(shared.split()[5:25])), inside(altered(shared.split()[:15], 3, rng)), inside(altered(items[7][1].split()[:15], 2, rng))]
    every = leaks(spark, docs, items)
    assert every == {(0, i) for i in range(60)} | {(1, i) for i in range(60)} | {(2, 7)}
    assert leaks(spark, docs, items[7:8]) == {(k, i) for k, i in every if i == 7} == {(0, 7), (1, 7), (2, 7)}
    monkeypatch.setattr(L, "BYTES_PER_PASS", 3000)
    assert leaks(spark, docs, items) == every


def test_phrases_of_manner_are_counted_over_all_documents(spark, monkeypatch):
    monkeypatch.setattr(L, "MANNER_SHARE", 0.1)
    docs = ["The office counted 5 men", "the OFFICE counted many", "the office, counted", "nothing", None, ""]
    df = spark.createDataFrame([(t,) for t in docs], "text string").repartition(4)
    assert L.manner_phrases(df, "text", {"theofficecounted", "officecounted5", "absent"}) == {"theofficecounted"}
    assert L.manner_phrases(df, "text", set()) == frozenset()
