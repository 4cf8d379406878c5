"""The Jaccard join, components, packing and the pipeline."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlytics.llm import jaccard, packing
from txnlytics.llm.components import components
from txnlytics.llm.jaccard import Join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(n)]))


def linked(rows, n, percent):
    """(size, component) of each row by comparing all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    groups = defaultdict(list)
    for k, (key, _) in enumerate(rows):
        groups[find(k)].append(key)
    low = lambda keys: min((k for k in keys if k is not None), default=None)
    return sorted(((key, len(s), low(groups[find(k)]) if s else key) for k, ((key, _), s) in enumerate(zip(rows, sets))), key=repr)


def near_copies(seed, bases, copies):
    rng = random.Random(seed)
    rows = []
    for b in range(bases):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 90))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 25))):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
            rows.append((len(rows), " ".join(words)))
    return rows


ODD = [(9000, None), (9001, ""), (9002, " \t"), (9003, "a b"), (9004, "A  b"), (9005, "a b c"), (9006, "a"), (9007, "a"), (None, "lone words of a null key here"), (9007, "a"), (9010, "q " * 20_000)]


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_join_equals_all_pairs(spark, words, percent):
    rows = near_copies(1, 12, 9) + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_shingles", F.lit("clash")).repartition(5)
    got = jaccard.near_duplicates(df, Join(words=words, percent=percent, slice_bytes=4000)).collect()
    assert sorted(map(tuple, got), key=repr) == linked(rows, words, percent)


@pytest.mark.parametrize("region,depth", [(16, 3), (8, 0), (24, 1)])
def test_large_regions_are_split_and_joined_exactly(spark, region, depth):
    rows = near_copies(2, 2, 70)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.near_duplicates(df, Join(words=4, percent=85, region=region, pivots=3, depth=depth, block_grams=1000)).collect()
    assert sorted(map(tuple, got), key=repr) == linked(rows, 4, 85)


def test_empty_table_and_one_of_each(spark):
    df = spark.createDataFrame(near_copies(3, 5, 6) + ODD, "doc_id long, text string").withColumn("lang", F.lit("x"))
    assert jaccard.near_duplicates(df.limit(0)).count() == 0
    kept = jaccard.keep_one_of_each(df)
    want = linked([(r["doc_id"], r["text"]) for r in df.collect()], 5, 80)
    groups = {c if c is not None else "null" for _, n, c in want if n}
    assert kept.columns == df.columns
    assert kept.count() == len(groups) + sum(1 for _, n, _ in want if not n)


def test_partnered_equals_trying_all():
    rng = np.random.default_rng(5)
    for percent in (80, 85):
        for m in (2, 3, 7, 40):
            size = np.sort(rng.integers(5, 40, m))
            reach = jaccard._reach(size, rng.integers(0, 6, m), percent)
            want = [
                any(i != j and 100 * min(size[i], size[j]) >= percent * max(size[i], size[j]) and size[j] <= reach[i] and size[i] <= reach[j] for j in range(m))
                for i in range(m)
            ]
            got = jaccard._partnered(size, reach, percent)
            assert all(g or not w for g, w in zip(got, want))  # a bound never loses a partner


def test_components_of_paths_stars_and_circles(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {k: 0 for k in range(61)} | {k: 100 for k in range(100, 160)} | {k: 200 for k in range(200, 203)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pieces_follow_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Don't we'll É*** é&&& ΟΔΟΣ 12,3", "", None, "x\xa0y\x1c z\x85", "<|endoftext|> a", "thing " * 9000, "日本 😀", "thing " * 4095, "thing " * 4096]
    rows = list(enumerate(texts)) + [(None, "b"), (0, texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("piece", F.lit("clash"))
    pieces = packing.cut_pieces(df).collect()
    want = []
    for key, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes()
        want += [(key, at // 16384, at // 4, min(4096, (len(ids) - at) // 4), zlib.crc32(ids[at : at + 16384])) for at in range(0, len(ids), 16384)]
    got = [(p["doc_id"], p["piece"], p["start"], p["length"], zlib.crc32(p["ids"])) for p in pieces]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    packed = packing.pack_documents(df).collect()
    assert sorted(((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in packed), key=repr) == sorted(want, key=repr)
    assert packing.pack_documents(df.limit(0)).count() == 0


def check_packed(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_is_gapless_and_near_the_bound(spark):
    rng = random.Random(6)
    lengths = [rng.choice([rng.randrange(1, 60), rng.randrange(20, 101)]) for _ in range(1500)] + [100] * 20
    df = spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "doc_id long, length long").withColumn("offset", F.lit("clash"))
    rules = packing.Packing(capacity=100, deme=200)
    rows = packing.pack(df, rules).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(range(len(lengths)))
    bound = -(-sum(lengths) // 100)
    assert check_packed(rows, 100) <= bound * 1.03
    for bad in (0, 101, None):
        with pytest.raises(ValueError):
            packing.pack(spark.createDataFrame([(1, bad)], "doc_id long, length long"), rules)
    assert packing.pack(df.limit(0), rules).count() == 0


def test_crossover_keeps_every_item_once():
    rng = np.random.Generator(np.random.PCG64(1))
    size = [int(x) for x in rng.integers(1, 60, 120)]
    a = packing.best_fit(list(range(120)), size, 100, [])
    b = packing.best_fit(sorted(range(120), key=lambda i: -size[i]), size, 100, [])
    for child in (packing.crossover(a, b, size, 100, rng), packing.mutate(a, size, 100, rng), packing.evolve(size, [a], packing.Packing(capacity=100), 1)):
        assert sorted(i for bin_ in child for i in bin_) == list(range(120))
        assert all(sum(size[i] for i in bin_) <= 100 for bin_ in child)
    assert len(packing.evolve(size, [a], packing.Packing(capacity=100), 1)) <= len(b)


def test_pipeline_stages_against_plain_rules(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(7)
    clean = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(3000)}" for _ in range(90)) + "." for _ in range(12)]
    near = clean[0].split()
    near[40] = "changed"
    texts = clean + [clean[1], clean[1].replace(" ", "  "), " ".join(near), "too short", None, "*** &&& " * 60, ("la " * 80)]
    df = spark.createDataFrame([(k, t, "en", f"s{k % 2}", len(t or "")) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
        seen.append(Counter(r["doc_id"] for r in docs.collect()))
    assert set(seen[0]) == set(range(15))
    assert set(seen[1]) == set(range(15)) - {1, 12}  # the copy with more blanks has more code points
    assert set(seen[2]) == set(range(15)) - {1, 12, 14}
    assert set(seen[3]) <= set(seen[2]) and max(seen[3].values()) <= 2
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_packed(rows, 4096)
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == seen[3]


def test_pieces_hold_every_gram_once(monkeypatch):
    monkeypatch.setattr(jaccard, "_PIECE", 50)
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64)) for n in (0, 1, 7, 90, 400)]
    pieces = list(jaccard._pieces([s.view(np.int64) for s in sets]))
    assert len(pieces) > 5
    for k, s in enumerate(sets):
        assert np.concatenate([p[k] for p in pieces]).tolist() == s.tolist()
    seen = [set(np.concatenate(p).tolist()) for p in pieces]
    assert sum(map(len, seen)) == len(set().union(*seen))


def test_large_unrelated_texts_form_no_region(spark, monkeypatch):
    """Large texts that share a rare passage are no candidates; large near copies of any size still link."""
    rng = random.Random(5)
    passage = [f"p{k}" for k in range(60)]
    long = [[f"w{rng.randrange(10**9)}" for _ in range(rng.randrange(6_000, 9_000))] + passage for _ in range(14)]
    copies = [long[0][300:], long[0][:-700], long[1][: len(long[1]) // 2], long[2] + [f"n{k}" for k in range(500)], long[2][1_000:]]
    texts = [" ".join(words) for words in long + copies] + ["a few words only", "A few words only", None]
    sets = [{tuple(words[k : k + 4]) for k in range(len(words) - 3)} for words in ((t or "").lower().split() for t in texts)]
    root = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) > 0:
                    root[a] = root[b] = min(root[a], root[b])
    found = {}
    write = jaccard.materialise

    def measured(df, label, *rest, **named):
        stored = write(df, label, *rest, **named)
        if label == "edges":
            found[label] = stored.count()
        return stored

    monkeypatch.setattr(jaccard, "materialise", measured)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r for r in jaccard.near_duplicates(rows, jaccard.Join(words=4, percent=85)).collect()}
    assert [got[k]["component_id"] for k in range(len(texts))] == root
    assert [got[k]["n_shingles"] for k in range(len(texts))] == [len(s) for s in sets]
    assert 0 < found["edges"] <= len(copies) + 2


def test_class_counts_never_differ_by_more_than_the_sets():
    rng = np.random.default_rng(2)
    pool = rng.integers(1, 1 << 63, 40_000, dtype=np.uint64)
    sizes = [1, 90, 2_048, 2_049, 5_000, 9_000, 30_000]
    sets = [np.unique(rng.choice(pool, n, replace=False)) for n in sizes] + [np.unique(pool[:n]) for n in (4_000, 4_200, 8_000, 8_100)]
    size = np.array([len(s) for s in sets])
    counts = jaccard.class_counts(np.concatenate(sets), np.repeat(np.arange(len(sets)), size), size)
    profiles = jaccard.Profiles(size, counts)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    apart = profiles.apart(a, b)
    for x, y, d in zip(a, b, apart):
        assert d <= len(np.setxor1d(sets[x], sets[y])) and (d == 0 or x != y)
