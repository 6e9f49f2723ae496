"""Problems 6, 8, 9 and 10: edge cases, brute force and held-out labels."""

import importlib.util
import itertools
import os
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brambling.llm import bpe, cooccur, mixing, subjects

HAVE = os.path.exists(f"{bpe.TOKENIZER_DIR}/byte_bpe_50k.tiktoken") and importlib.util.find_spec("tiktoken")
needs_vocabulary = pytest.mark.skipif(not HAVE, reason="no vocabulary files")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# 6


def brute(data, least, lift):
    baskets = {}
    for u, i in data:
        if u is not None:
            baskets.setdefault(u, set()).update([i] if i is not None else [])
    n, one = len(baskets), Counter(i for b in baskets.values() for i in b)
    two = Counter(p for b in baskets.values() for p in itertools.combinations(sorted(b), 2))
    return sorted((a, b, k, one[a], one[b], n) for (a, b), k in two.items() if k >= least and k * n >= lift * one[a] * one[b])


@pytest.mark.parametrize("chunk", [2, 5, 64])
def test_associations(spark, chunk):
    rnd = random.Random(chunk)
    data = [(f"u{u}", f"i{rnd.randint(0, 40)}") for u in range(60) for _ in range(rnd.randint(1, 4))]
    data += [("big", f"i{k}") for k in range(41)] + data[:30] + [("u1", None), (None, "i1"), ("only", None)]
    df = spark.createDataFrame([(*d, 1, 2) for d in data], "uid string, k string, n int, i int")
    got = sorted(tuple(r)[:6] for r in cooccur.associations(df, "uid", "k", 2, 1.5, chunk).collect())
    assert got == brute(data, 2, 1.5)
    assert cooccur.associations(df.limit(0), "uid", "k").count() == 0


# 8

TEXTS = ["", None, " ", "Hello world's 1234  \n\n x", "<|endoftext|> is text", "naïve é 患者 12 例。 🦟", "a" * 5000, "\x00​﻿", "word " * 30_000]


@needs_vocabulary
def test_ids(spark):
    import tiktoken

    ranks = bpe.load_ranks(f"{bpe.TOKENIZER_DIR}/byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=bpe.WORD, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([(i, t, [0]) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, ids array<int>")
    got = {r["doc_id"]: r["ids"] for r in bpe.with_ids(df, "text").collect()}
    assert got == {i: enc.encode_ordinary(t) if t else [] for i, t in enumerate(TEXTS)}
    assert bpe.with_ids(df.limit(0), "text").count() == 0


@needs_vocabulary
@given(st.text(st.sampled_from("abcé ß'stllve\n\t 012!?例🦟"), max_size=60))
@settings(max_examples=150, deadline=None)
def test_ids_of_any_text(text):
    import tiktoken

    global _enc
    if "_enc" not in globals():
        ranks = bpe.load_ranks(f"{bpe.TOKENIZER_DIR}/byte_bpe_50k.tiktoken")
        _enc = (bpe.Encoder(ranks, memo_size=50), tiktoken.Encoding("own", pat_str=bpe.WORD, mergeable_ranks=ranks, special_tokens={}))
    assert _enc[0].encode([text])[0] == _enc[1].encode_ordinary(text)


# 9


@needs_vocabulary
def test_mixture(spark):
    rnd = random.Random(3)
    docs = [(i, " ".join(rnd.choice("alpha beta gamma delta".split()) for _ in range(rnd.randint(5, 60))) + f" {i}", f"s{i % 3}") for i in range(900) if i % 3 < 2 or i % 30 == 2]
    docs += [(5000, None, "s0"), (5001, "", "s0"), (5002, "x y", None), (5003, "x y", "unknown"), (None, "x", "s0")]
    df = spark.createDataFrame([(*d, 1.0, 7) for d in docs], "doc_id bigint, text string, source string, w double, p int")
    t = spark.createDataFrame([("s0", 0.5, 1), ("s1", 0.3, 2), ("s2", 0.1, 5), ("none", 0.1, 3), (None, 0.2, 1)], "source string, target_share double, max_repeats int")
    copies, shares = mixing.mixture(df, t)
    got = {r["doc_id"]: r for r in copies.collect()}
    cap = {"s0": 1, "s1": 2, "s2": 5}
    assert all(1 <= r["copies"] <= cap[r["source"]] for r in got.values()) and not {5000, 5001, 5002, 5003} & got.keys()
    reached = {r["source"]: r["reached_share"] for r in shares.collect()}
    assert reached.pop("none") == 0 and abs(sum(reached.values()) - 1) < 1e-9
    for s, share in (("s0", 0.5), ("s1", 0.3), ("s2", 0.1)):
        assert abs(reached[s] - share / 0.9) < 0.01
    again = {r["doc_id"]: r["copies"] for r in mixing.mixture(df, t)[0].collect()}
    assert again == {k: r["copies"] for k, r in got.items()}
    small = mixing.mixture(df, t, total=500.0)[1].collect()
    assert abs(sum(r["mixed_tokens"] for r in small) - 500) < 200
    c, s = mixing.mixture(df.limit(0), t)
    assert c.count() == 0 and {r["reached_share"] for r in s.collect()} == {0.0}
    assert mixing.mixture(df, t.limit(0))[1].count() == 0


@needs_vocabulary
def test_repeated_texts_share_their_weight(spark):
    df = spark.createDataFrame([(i, "the very same text of a document" if i < 200 else f"some other text number {i} of its own", "s") for i in range(400)], "doc_id bigint, text string, source string")
    t = spark.createDataFrame([("s", 1.0, 1)], "source string, target_share double, max_repeats int")
    n = Counter(r["doc_id"] < 200 for r in mixing.mixture(df, t, total=1000.0)[0].collect())
    assert n[False] > 10 * max(1, n[True])


# 10

TOPICS = {
    "tb": (["sputum", "cavity", "isoniazid", "tuberculin"], ["persisted among contacts", "needed four drugs", "cleared late in winter"]),
    "law": (["statute", "court", "licence", "tribunal"], ["was amended by parliament", "required written reasons", "lapsed with its sunset"]),
    "code": (["compiler", "parser", "kernel", "debugger"], ["failed its unit tests", "was ported to rust", "leaked some memory"]),
}
FILL = ["These figures should be read with care.", "Missing answers were left out.", "We thank everyone at the site.", "A table is available on request."]


def corpus(n, seed):
    rnd = random.Random(seed)
    docs, truth = [], []
    for i in range(n):
        own = rnd.sample(list(TOPICS), rnd.choice([0, 1, 1, 2]))
        k = Counter()
        s = []
        for t in own:
            for _ in range(rnd.randint(2, 5)):
                s.append(f"The {rnd.choice(TOPICS[t][0])} {rnd.choice(TOPICS[t][1])} in {rnd.randint(1990, 2020)}.")
                k[t] += 1
        s += rnd.choices(FILL, k=rnd.randint(1, 4))
        rnd.shuffle(s)
        docs.append((i, " ".join(s), "en"))
        truth += [(i, t) for t, c in k.items() if c >= 0.25 * sum(k.values())]
    return docs, truth


def test_sentences():
    assert subjects.sentences("One two. Three four!\n- Five 6 a") == [["one", "two"], ["three", "four"], ["five"]]
    assert subjects.sentences(" \n") == []


def test_sums_are_added_in_levels(spark):
    """More tasks than fit one group: the sum is that of all, and no group holds more than `fan` sums."""
    assert [subjects.levels(n, 4) for n in (1, 4, 5, 16, 17, 64, 65)] == [1, 1, 2, 2, 3, 3, 4]
    ids = ["array(0, 1, 1) AS ids", "array(0, 1) AS terms", "array(1, 2) AS counts"]
    docs = spark.range(0, 40, 1, 23).selectExpr("id AS doc_id", "0 AS lang", "CAST(array() AS array<int>) AS labels", "array(3) AS lens", *ids)
    got = subjects._gather(docs, lambda b, s: {"n": (3, b.uterm[:2], np.tile([[1.0, s]], (2, 1)) * b.n_docs), "all": np.ones((1, 1)) * b.n_sents}, 0.5, (*subjects.SENTENCES, *subjects.TERMS), block=2, fan=4)
    assert got["n"].tolist() == [[40.0, 20.0], [40.0, 20.0], [0.0, 0.0]] and got["all"].tolist() == [[40.0]]


def test_sum_runs_against_loop():
    rng = np.random.default_rng(1)
    rows, lens = rng.random((50, 3)), np.array([0, 1, 5, 900, 0, 257, 256, 2])
    index, weight = rng.integers(0, 50, lens.sum()), rng.random(lens.sum())
    ends = np.cumsum(lens)
    for w in (None, weight):
        want = [sum((rows[index[k]] * (1 if w is None else w[k]) for k in range(e - n, e)), np.zeros(3)) for n, e in zip(lens, ends, strict=True)]
        assert np.allclose(subjects._sum_runs(rows, index, lens, w), want)
    assert subjects._sum_runs(rows, index[:0], lens[:0]).shape == (0, 3)


def test_sum_rows_against_loop():
    rng = np.random.default_rng(1)
    v, k = rng.random((50, 3)), rng.integers(0, 7, 50)
    want = np.zeros((8, 3))
    for x, i in zip(v, k, strict=True):
        want[i] += x
    assert np.allclose(subjects._sum_rows(v, k, 8), want)
    assert subjects._sum_rows(v[:0], k[:0], 2).tolist() == [[0] * 3] * 2


def test_subjects_on_held_out_labels(spark):
    docs, truth = corpus(600, 1)
    extra = [(9000, None, "en"), (9001, "", None), (9002, " \n ", "en"), (9003, "12 34", "EN"), (None, "The sputum needed four drugs.", "en")]
    df = spark.createDataFrame([(*d, "x", [1]) for d in docs + extra], "doc_id bigint, text string, lang string, s string, labels array<int>")
    known = [t for t in truth if t[0] < 60]
    ex = spark.createDataFrame([(*t, "user") for t in known + known[:5] + [(77777, "tb"), (1, "nothing"), (None, "tb")]], "doc_id bigint, subject_id string, labelled_by string")
    lst = spark.createDataFrame([("tb", "Tuberculosis", "disease of the lung"), ("law", "Law", None), ("code", None, "programs"), (None, "x", "y")], "subject_id string, label string, scope_note string")
    got = {tuple(r) for r in subjects.assign(df, ex, lst).collect()}
    held, mine = {t for t in truth if t[0] >= 60}, {t for t in got if t[0] >= 60 and t[0] < 9000}
    assert not any(d is None or d >= 9000 for d, _ in got)
    hit = len(held & mine)
    assert hit / len(mine) > 0.95 and hit / len(held) > 0.95
    assert subjects.assign(df.limit(0), ex, lst).count() == 0
    assert subjects.assign(df, ex, lst.limit(0)).count() == 0
    assert subjects.assign(df, ex.limit(0), lst).count() >= 0
