"""Periodic runs."""

import random

import pytest
from pyspark.sql import functions as F

from txnlytics.llm import runs
from txnlytics.llm.runs import Runs


def brute(words, least, exponent):
    """Every stretch that repeats with period q and can't be extended, unless a smaller period explains it."""
    out, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            part = words[start : start + length]
            if i > start and length >= max(least, exponent * q):
                if not any(all(a == b for a, b in zip(part, part[r:])) for r in range(1, q)):
                    out.append((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def made(rng, letters, most):
    n = rng.randrange(most)
    words = [rng.choice(letters) for _ in range(n)]
    if n and rng.random() < 0.5:
        a, p = rng.randrange(n), rng.randrange(1, 9)
        words = [w if i < a or a + (i - a) % p >= n else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("least,exponent", [(6, 4), (1, 2), (6, 2), (3, 3), (20, 2)])
def test_runs_equal_brute_force(least, exponent):
    rng = random.Random(7)
    texts = [made(rng, "aAbcdef"[: rng.randrange(1, 8)], 90) for _ in range(300)] + [["x"] * 400, list("ab") * 150 + list("ba") * 90]
    found, kept = runs.runs_of_texts([" ".join(t).encode() for t in texts], Runs(least, exponent))
    for words, got, rest in zip(texts, found, kept):
        want = brute(words, least, exponent)
        assert [(r["start"], r["length"], r["period"]) for r in got] == want
        assert rest.decode() == collapsed(words, want)


def test_a_fibonacci_word_has_no_run_of_four_periods_but_many_of_two():
    a, b = ["a"], ["a", "b"]
    while len(b) < 300:
        a, b = b, b + a
    found, _ = runs.runs_of_texts([" ".join(b).encode()], Runs(6, 4))
    assert found == [[]]
    found, _ = runs.runs_of_texts([" ".join(b).encode()], Runs(1, 2))
    assert [(r["start"], r["length"], r["period"]) for r in found[0]] == brute(b, 1, 2)


def test_odd_rows_and_clashing_columns(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "a"), (5, "a " * 6), (5, "a " * 6), (None, "é é " * 7), (6, "p q " * 30_000),
        (7, "a\x0ba\x0ca\ra\na\ta z"), (8, "A a " * 5),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("RUNS", F.lit("clash")).withColumn("_body", F.lit(1))
    got = runs.periodic_runs(df).orderBy(F.col("doc_id").asc_nulls_first(), "n_words").collect()
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got] == [
        (None, 7, [(0, 7, 1)], "é é"),
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 1, [], "a"),
        (5, 6, [(0, 6, 1)], "a"), (5, 6, [(0, 6, 1)], "a"),
        (6, 60_000, [(0, 60_000, 2)], "p q"),
        (7, 7, [(0, 6, 1)], "a z"), (8, 10, [(0, 10, 2)], "A a"),
    ]
    assert runs.periodic_runs(df.limit(0)).count() == 0
    assert "_body" in runs.periodic_runs(df).columns


def test_exponent_below_two_is_refused():
    with pytest.raises(ValueError):
        Runs(exponent=1)
