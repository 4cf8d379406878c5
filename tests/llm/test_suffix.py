"""Repeated strings against a count of every string."""

import hashlib
import random
from collections import Counter

import pytest

from txnlytics.llm import queries, suffix
from txnlytics.llm.suffix import Repeats


def brute(texts, length):
    """Expected (n_bytes, n_removed, n_spans, sha256) per text."""
    bodies = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if times[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def noise(rng, n):
    return "".join(rng.choice("abcdefgh é") for _ in range(n))


def corpus(seed, length):
    rng = random.Random(seed)
    passages = [noise(rng, rng.randrange(length // 2, 3 * length)) for _ in range(4)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            parts.append(noise(rng, rng.randrange(0, 2 * length)))
            p = rng.choice(passages)
            a = rng.randrange(0, len(p) // 3)
            parts.append(p[a : len(p) - rng.randrange(0, len(p) // 3)])
        texts.append("".join(parts))
    # partners that break at different places on either side of a shared middle
    middle = noise(rng, length - length // 4)
    for k in range(12):
        left, right = noise(random.Random(k % 3), length), noise(random.Random(10 + k % 4), length)
        texts.append(noise(rng, 30) + left[-rng.randrange(1, length // 2) :] + middle + right[: rng.randrange(1, length // 2)] + noise(rng, 30))
    texts += ["x" * (3 * length), "ab" * length, noise(rng, length - 1), "", None, texts[0], texts[0], " " * (length + 1)]
    return texts


@pytest.mark.parametrize("seed,length,part,slice_bytes", [(1, 100, 40_000, 4 << 20), (2, 100, 25, 3_000), (3, 70, 60, 2_000), (4, 400, 40, 5_000)])
def test_matches_every_string_counted(spark, seed, length, part, slice_bytes):
    texts = corpus(seed, length)
    rules = Repeats(length=length, gram=16 if length < 400 else 64, part_items=part, slice_bytes=slice_bytes)
    rows = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, body string").repartition(3)
    got = {r["doc_id"]: r for r in suffix.remove_repeats(rows, rules).collect()}
    want = brute(texts, length)
    assert len(got) == len(texts)
    for k, expected in enumerate(want):
        r = got[k]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == expected, k


def test_shuffled_joins_give_the_same(spark):
    texts = corpus(5, 100)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    take = lambda n: sorted(map(tuple, suffix.remove_repeats(rows, Repeats(length=100, gram=16, broadcast_places=n)).collect()))
    assert take(0) == take(1 << 30)


def test_empty_table_and_null_keys(spark):
    rows = spark.createDataFrame([], "doc_id long, text string, spans string")
    assert suffix.remove_repeats(rows).count() == 0
    rows = spark.createDataFrame([(None, "a" * 500), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, suffix.remove_repeats(rows, with_bytes=True).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()), key=repr)
    assert got == [(None, 0, 0, 0, bytearray()), (None, 500, 500, 1, bytearray())]


def test_loser_tree_merges_sorted_runs_with_their_shared_prefixes():
    rng = random.Random(3)
    for count in (1, 2, 3, 7):
        runs = [sorted("".join(rng.choice("ab") for _ in range(rng.randrange(0, 9))).encode() for _ in range(20)) for _ in range(count)]
        coded = []
        for k, run in enumerate(runs):
            n, m, joined = suffix.front_code(run)
            assert [key for key, _ in suffix.front_decode(n, m, joined)] == run
            coded.append((key, share, (bytes([k]),)) for key, share in suffix.front_decode(n, m, joined))
        merged = list(suffix.merge_runs(coded))
        keys = [key for key, _, _ in merged]
        assert keys == sorted(sum(runs, []))
        assert [share for _, share, _ in merged[1:]] == [suffix.common_prefix(a, b) for a, b in zip(keys, keys[1:])]


def test_many_near_copies_spell_no_table_of_strings(spark, monkeypatch):
    """What a few open places ask of a large group is counted by context: no table outgrows places times blocks."""
    rng = random.Random(8)
    length = 100
    middle = noise(rng, length - 20)
    left, right = noise(rng, length), noise(rng, length)
    texts = [noise(rng, 30) + left[-(k % 37) - 1 :] + middle + right[: (k * 7) % 41 + 1] + noise(rng, 30) for k in range(400)]
    sizes = {}
    write = suffix.materialise

    def measured(df, label, *rest, **named):
        stored = write(df, label, *rest, **named)
        sizes[label] = max(sizes.get(label, 0), stored.count())
        return stored

    monkeypatch.setattr(suffix, "materialise", measured)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in suffix.remove_repeats(rows, Repeats(length=length, gram=16)).collect()}
    for k, expected in enumerate(brute(texts, length)):
        assert (got[k]["n_bytes"], got[k]["n_removed"], got[k]["n_spans"], got[k]["kept_sha256"]) == expected, k
    assert sizes["open"] > 0
    blocks = (length - 16) // 16 + 1
    assert max(sizes.values()) <= blocks * sizes["items"], sizes


def test_planted_passages_show_in_n_removed_not_in_n_bytes(spark, tmp_path):
    """Through the query: passages of over 50 words go if they have 400 bytes; n_bytes is the input's size with or without one."""
    rng = random.Random(9)
    words = lambda n, size: " ".join("".join(rng.choice("abcdefghé") for _ in range(size)) for _ in range(n))
    long, short = [words(60, 8) for _ in range(6)], [words(55, 5) for _ in range(6)]
    assert all(len(p.encode()) >= 400 for p in long) and all(len(p.encode()) + 2 < 400 for p in short)
    holders = [(p, f"{words(40, 7)} {p} {words(40, 7)}") for p in (long + short) * 2]
    texts = [t for _, t in holders] + [words(140, 7) for _ in range(24)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op10_suffix_array_dedup(spark, str(tmp_path)).collect()}
    for k, expected in enumerate(brute(texts, 400)):
        r = got[k]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == expected, k
        assert r["n_bytes"] == len(texts[k].encode())
    for k, (passage, _) in enumerate(holders):
        size = len(passage.encode())
        assert got[k]["n_removed"] >= size if size >= 400 else got[k]["n_removed"] == 0, k
    assert all(got[k]["n_removed"] == 0 for k in range(len(holders), len(texts)))
