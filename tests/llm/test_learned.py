"""Language identification and the Pitman-Yor model."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlytics.llm import language, pitman_yor
from txnlytics.llm.common import WordHasher


def made(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n)).capitalize() + "."


LANGUAGES = {"aa": ["ba", "ku", "mi", "to"], "bb": ["schr", "ein", "ung", "keit"], "cc": ["é", "eau", "oi", "que"]}


def greedy(text, sample, segment):
    code = bytes(language.symbols([text])[0])
    known, n = bytes(language.symbols(sample)[0]), 0
    for at in range(0, len(code), segment):
        piece, i = code[at : at + segment], 0
        while i < len(piece):
            k = 1
            while i + k <= len(piece) and piece[i : i + k] in known:
                k += 1
            i += max(1, k - 1)
            n += 1
    return n


def test_phrase_counts_are_greedy_longest_matches():
    rng = random.Random(1)
    samples = {name: [made(rng, s, 80).encode() + b" "] for name, s in LANGUAGES.items()}
    moves, states = [], []
    for name in samples:
        m = language.suffix_automaton(language.symbols(samples[name])[0])
        steps = np.array([(a, s, b) for a, step in enumerate(m) for s, b in step.items()], dtype=np.int32).T
        moves.append((steps[0], steps[1].astype(np.uint8), steps[2]))
        states.append(len(m))
    model = language.Model(tuple(samples), tuple(moves), tuple(states), np.ones(3))
    texts = [made(rng, s, 60).encode() for s in LANGUAGES.values()] + [b"", "ÑÉ 12 zzz".encode(), b"x", b"ba" * 300]
    for segment, lanes in ((2048, 2048), (50, 3)):
        rules = language.Parsing(segment=segment, lanes=lanes)
        got = language.phrases(texts, language.Tables(model), rules)
        want = [[greedy(t, samples[name], segment) for name in samples] for t in texts]
        assert got.tolist() == want


def test_held_out_accuracy_and_awkward_rows(spark):
    rng = random.Random(2)
    rows = [(k, made(rng, LANGUAGES[name], 40), name) for k, name in enumerate(list(LANGUAGES) * 60)]
    odd = [(500, None, "aa"), (501, "", "aa"), (502, " 12 *** ", "bb"), (None, made(rng, LANGUAGES["aa"], 9), None), (0, rows[0][1], "aa"), (600, made(rng, LANGUAGES["bb"], 30_000), "bb")]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("SCORE", F.lit("clash"))
    held = language.remainder("doc_id", 3) == 1
    model = language.fit(df.filter(~held))
    assert model.languages == ("aa", "bb", "cc")
    got = language.identify(df, model)
    assert got.columns == ["doc_id", "lang", "lang_pred", "score"]
    found = {r["doc_id"]: r for r in got.filter("doc_id is not null").collect()}
    assert got.count() == len(rows) + len(odd)
    assert all(found[k]["lang_pred"] == name for k, _, name in rows)
    assert all((found[k]["lang_pred"], found[k]["score"]) == ("und", 0.0) for k in (500, 501, 502))
    assert found[600]["lang_pred"] == "bb" and all(0 <= r["score"] <= 1 for r in found.values())
    assert language.identify(df.limit(0), model).count() == 0
    nothing = language.fit(df.limit(0))
    assert {r["lang_pred"] for r in language.identify(df, nothing).collect()} == {"und"}
    one = language.fit(df.filter("lang = 'aa'"))
    assert language.identify(df.filter("doc_id = 3"), one).first()["score"] == 1.0


def test_sample_is_bounded_by_whole_texts(spark):
    long = spark.createDataFrame([(1, "ab " * 5000, "aa"), (2, "cd " * 6000, "aa")], "doc_id long, text string, lang string")
    model = language.fit(long, language.Parsing(sample_bytes=300))
    assert model.languages == ("aa",) and 2 ** model.weight[0] <= 302


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def token_list(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def test_base_scores_and_gain_over_them(spark):
    rng = random.Random(3)
    rows = [(k, made(rng, LANGUAGES[name], 30), k % 7 != 2) for k, name in enumerate(list(LANGUAGES) * 40)]
    rows += [(500, None, True), (501, "", False), (None, "ba BA\tku", False), (5, rows[5][1], True), (502, "ba " * 20_000, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean").withColumn("score", F.lit("clash"))
    count = Counter(w for _, t, train in rows if train for w in token_list(t))
    n, v = sum(count.values()), len(count)
    want = sorted(
        (k if k is not None else -1, len(token_list(t)), sum(count[w] > 0 for w in token_list(t)), round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in token_list(t)), 6))
        for k, t, _ in rows
    )
    for rules in (pitman_yor.Restaurants(), pitman_yor.Restaurants(slice_bytes=2000, bucket_bytes=4000, busy=4)):
        got = pitman_yor.score_texts(df, F.col("train"), rules).collect()
        assert {r["train_tokens"] for r in got} == {n}
        assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
        held = [r for r in got if not r["train"]]
        assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
        assert all(r["score"] < 0 for r in got)
    assert pitman_yor.score_texts(df.limit(0), F.col("train")).count() == 0
    blind = pitman_yor.score_texts(df, F.lit(False)).collect()
    assert all(abs(r["score"]) < 1e-9 and r["train_tokens"] == 0 for r in blind)


def test_every_word_before_is_a_restaurant_of_its_own(spark):
    """Scores of the first seating (one table a dish) against plain counts by the whole word before and its real ending."""
    rng = random.Random(6)
    words = [f"w{k}ba" for k in range(900)] + [f"{a}{b}" for a in "xyzé" for b in "aeiou"] + list("pqr")
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(80)] + ["", "w1ba " * 300]
    df = spark.createDataFrame([(k, t, k % 5 != 1) for k, t in enumerate(texts)], "doc_id long, text string, train boolean")
    ending = lambda w: None if w is None else w.encode()[-2:]
    pairs = lambda t: list(zip([None, *token_list(t)[:-1]], token_list(t)))
    count = Counter(p for k, t in enumerate(texts) if k % 5 != 1 for p in pairs(t))
    low, low_tables = Counter(), Counter()
    for (c, w), n in count.items():
        low[c] += n
        low_tables[c] += 1
    dish = Counter((ending(c), w) for c, w in count)
    middle, middle_tables = Counter(), Counter()
    for (e, w), n in dish.items():
        middle[e] += n
        middle_tables[e] += 1
    top = Counter(w for _, w in dish)
    v, d = len(top), pitman_yor.Restaurants().discounts

    def chance(c, w):
        p = 1 / (v + 1)
        p = (top[w] - d[0] * (w in top) + (1 + d[0] * v) * p) / (1 + sum(top.values()))
        e = ending(c)
        p = (dish[e, w] - d[1] * ((e, w) in dish) + (1 + d[1] * middle_tables[e]) * p) / (1 + middle[e])
        return (count[c, w] - d[2] * ((c, w) in count) + (1 + d[2] * low_tables[c]) * p) / (1 + low[c])

    rules = pitman_yor.Restaurants(sweeps=0, slice_bytes=2000, bucket_bytes=4000, busy=20)
    got = {r["doc_id"]: r["score"] for r in pitman_yor.score_texts(df, F.col("train"), rules).collect()}
    assert got == pytest.approx({k: sum(math.log10(chance(*p)) for p in pairs(t)) for k, t in enumerate(texts)}, abs=1e-6)


def test_predictive_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    rules = pitman_yor.Restaurants()
    words, contexts = 60, np.array([0, 1, 256, 257, 700])
    grid = np.array([(w, c) for w in range(words) for c in contexts])
    dishes = pitman_yor.Dishes(grid[:, 0], grid[:, 1].astype(np.uint16), rng.poisson(0.8, len(grid)) * (rng.random(len(grid)) < 0.6) * 1)
    known = np.bincount(dishes.word, dishes.count, words) > 0
    vocabulary, history = int(known.sum()), []
    for _ in range(3):
        *_, tables = pitman_yor.chain(dishes, history, vocabulary, rules, 0)
        history.append(pitman_yor.totals_of(dishes, tables))
    assert (tables[2] <= dishes.count).all() and ((tables[2] >= 1) == (dishes.count > 0)).all()
    p = pitman_yor.probabilities(dishes, tables, history[-1], vocabulary, rules)[2].reshape(words, -1)
    unknown = p[~known]
    assert np.allclose(p[known].sum(axis=0) + (unknown[0] if len(unknown) else 0), 1) or not len(unknown)


def test_seating_matches_the_restaurant_process():
    """Mean number of tables against its exact expectation, by dynamic programming over the seating of one dish."""
    opening, discount, base = 2.5, 0.6, 0.3
    for customers in (2, 5, 20):
        chance = {1: 1.0}
        for k in range(1, customers):
            nxt = Counter()
            for t, p in chance.items():
                q = opening * base / (opening * base + k - discount * t)
                nxt[t + 1] += p * q
                nxt[t] += p * (1 - q)
            chance = nxt
        n = 40_000
        got = pitman_yor.seat(np.full(n, customers), np.full(n, base), np.full(n, opening), discount, np.random.default_rng(1))
        assert abs(got.mean() - sum(t * p for t, p in chance.items())) < 0.03
    big = pitman_yor.seat(np.array([100_000, 0, 1]), np.full(3, base), np.full(3, opening), discount, np.random.default_rng(1))
    assert big[1] == 0 and big[2] == 1 and 1 <= big[0] < 1000


def test_words_are_told_apart_as_the_pattern_does():
    texts = ["Ab ab\x0bAB\x1c x\xa0y é É", "", " ", "a\nb\r\n\tc"]
    words, starts, ends, owner, _ = WordHasher().words([t.encode() for t in texts])
    want = [(k, w) for k, t in enumerate(texts) for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))]
    assert owner.tolist() == [k for k, _ in want]
    codes = {}
    for h, (_, w) in zip(words.tolist(), want):
        assert codes.setdefault(w, h) == h
    assert len(set(codes.values())) == len(codes)
