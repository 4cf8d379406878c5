"""Spelling variants."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from txnlytics.llm import spelling
from txnlytics.llm.spelling import Variants


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(counts, rules):
    """(word, n, n_near, form, form_n, root) by comparing all pairs."""
    counts = {w: n for w, n in counts.items() if len(w) >= rules.min_chars and n >= rules.min_count}
    around = {w: [] for w in counts}
    for a, b in combinations(counts, 2):
        if near(a, b):
            around[a].append(b)
            around[b].append(a)
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= rules.ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(around[w]), form[w], counts[form[w]] if form[w] else None, root))
    return sorted(out)


def made(seed, words, letters="abé", least=1, most=9):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randrange(least, most))): rng.choice([1, 4, 5, 6, 25, 30, 200, 999]) for _ in range(words)}


@pytest.mark.parametrize("rules", [Variants(), Variants(min_chars=2, min_count=1), Variants(group=3, bucket=40), Variants(min_chars=3, group=1, reach=2, ratio=2)])
def test_forms_equal_all_pairs(spark, rules):
    counts = made(1, 500) | made(2, 60, "aaab", 5, 14) | {"aaaaaaa": 7, "aaaaaa": 50, "aaaaaaaa": 1, "b" * 700: 9, "b" * 701: 80, "b" * 350 + "a" + "b" * 350: 6}
    df = spark.createDataFrame(list(counts.items()), "word string, n int").withColumn("state", F.lit("clash")).repartition(3)
    got = spelling.spelling_forms(df, rules)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert sorted(map(tuple, got.collect())) == expected(counts, rules)


def test_acceptor_is_minimal_and_exact():
    words = sorted(set(made(3, 300, "ab", 0, 8)))
    acceptor = spelling.Acceptor()
    start = acceptor.add(words)

    def language(q):
        return ([""] if acceptor.final[q] else []) + [c + w for c, to in acceptor.arcs[q].items() for w in language(to)]

    assert sorted(language(start)) == words
    languages = [tuple(sorted(language(q))) for q in range(len(acceptor.arcs))]
    assert len(set(languages)) == len(languages)


def test_each_pair_is_accepted_once():
    words = sorted(made(4, 200, "ab", 2, 8))
    groups = {str(m): (False, [w for w in words if len(w) == m], [w for w in words if len(w) == m + 1]) for m in range(1, 9)}
    got = [tuple(sorted(p[1:3])) for p in spelling.near_pairs(groups)]
    assert len(got) == len(set(got))
    assert set(got) == {tuple(sorted(p)) for p in combinations(words, 2) if near(*p)}


def test_nulls_empty_and_counting(spark):
    rows = [(None, 9), ("abcdef", None), ("abcdeg", 5), ("abcde", 99), ("abcdeh", 4), ("", 9)]
    df = spark.createDataFrame(rows, "word string, n int")
    assert [tuple(r) for r in spelling.spelling_forms(df).collect()] == [("abcdeg", 5, 0, None, None, "abcdeg")]
    assert spelling.spelling_forms(df.limit(0)).count() == 0
    runs = spark.createDataFrame([("abcdef",)] * 5 + [("abcde",)] * 9 + [("abcdeg",)] * 4 + [(None,)], "word string")
    assert [tuple(r) for r in spelling.count_words(runs).collect()] == [("abcdef", 5)]
    with pytest.raises(ValueError):
        Variants(min_chars=1)
