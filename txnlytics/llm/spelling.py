"""Spelling variants: the minimised vocabulary acceptor composed with a one-edit transducer and the acceptor again."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txnlytics.session import materialise


@dataclass(frozen=True)
class Variants:
    """Words of at least ``min_chars`` code points and ``min_count`` occurrences; a form is ``ratio`` times as frequent.

    A start state with more than ``group`` words, or more than ``reach`` code points left to
    read, is divided; a task's acceptor holds about ``bucket`` words.
    """

    min_chars: int = 6
    min_count: int = 5
    ratio: int = 5
    group: int = 2048
    reach: int = 48
    bucket: int = 20_000

    def __post_init__(self) -> None:
        if self.min_chars < 2:
            raise ValueError("words of one code point are all near each other")


# --- the acceptor ---------------------------------------------------------------------


class Acceptor:
    """Minimal deterministic automaton of sorted words, built one word at a time; equal right languages share a state."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}

    def _state(self, arcs: dict[str, int], final: bool) -> int:
        shape = (final, tuple(arcs.items()))
        found = self._known.get(shape)
        if found is None:
            found = self._known[shape] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return found

    def add(self, words: Iterable[str]) -> int:
        """Start state of the language of ``words``, which are sorted and distinct."""
        path: list[list] = [[{}, False]]  # open states of the last word: arcs, final
        last = ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                arcs, final = path.pop()
                path[-1][0][last[len(path) - 1]] = self._state(arcs, final)

        for word in words:
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            close(shared)
            for _ in range(len(word) - shared):
                path.append([{}, False])
            path[-1][1] = True
            last = word
        close(0)
        return self._state(*path[0])


class Composition:
    """Acceptor, one-edit transducer, acceptor: composed states are built when reached and remembered.

    A composed state is a pair of acceptor states, with the edit still to come or behind. The
    transducer replaces a code point by a larger one, or deletes one; of a run of equal code
    points it deletes the last, so that each pair of words is accepted along one path.
    """

    def __init__(self, acceptor: Acceptor) -> None:
        self.arcs, self.final = acceptor.arcs, acceptor.final
        self._common: dict[tuple[int, int], list[str]] = {}
        self._replaced: dict[int, list[tuple[str, str]]] = {}
        self._deleted: dict[tuple[int, int, bool], list[tuple[str, str]]] = {}

    def common(self, p: int, r: int) -> list[str]:
        """Behind the edit: what both states accept."""
        key = (p, r) if p < r else (r, p)
        out = self._common.get(key)
        if out is None:
            a, b = self.arcs[p], self.arcs[r]
            out = [""] if self.final[p] and self.final[r] else []
            for c in a.keys() & b.keys() if len(a) > 1 or len(b) > 1 else (c for c in a if c in b):
                out += [c + rest for rest in self.common(a[c], b[c])]
            self._common[key] = out
        return out

    def replaced(self, q: int) -> list[tuple[str, str]]:
        """Pairs from one state that differ by one replaced code point, smaller one first."""
        out = self._replaced.get(q)
        if out is None:
            out, arcs = [], sorted(self.arcs[q].items())
            for k, (c, to) in enumerate(arcs):
                for d, other in arcs[k + 1 :]:
                    out += [(c + rest, d + rest) for rest in self.common(to, other)]
                out += [(c + x, c + y) for x, y in self.replaced(to)]
            self._replaced[q] = out
        return out

    def deleted(self, p: int, r: int, inner: bool) -> list[tuple[str, str]]:
        """(word of ``p``, the same without one code point, of ``r``); ``inner``: the last code point stays."""
        key = (p, r, inner)
        out = self._deleted.get(key)
        if out is None:
            out = []
            for c, to in self.arcs[p].items():
                for rest in self.common(to, r):
                    if rest[:1] != c and (rest or not inner):
                        out.append((c + rest, rest))
                if c in self.arcs[r]:
                    out += [(c + x, c + y) for x, y in self.deleted(to, self.arcs[r][c], inner)]
            self._deleted[key] = out
        return out


def near_pairs(groups: dict[str, tuple[bool, list[str], list[str]]]) -> Iterator[tuple[str, str, str, bool]]:
    """(group, middle, middle, whether the first is longer) of the pairs one edit apart within each group.

    A group is (inner, short middles, long middles): pairs of two short ones, and of a long and
    a short one. All groups share one acceptor; each has a start state of its own.
    """
    acceptor = Acceptor()
    starts = {
        name: (inner, acceptor.add(sorted(short)), acceptor.add(sorted(long)) if long else None)
        for name, (inner, short, long) in groups.items()
        if short
    }
    deepest = max((len(m) for _, short, long in groups.values() for m in (*short, *long)), default=0)
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1000 + 4 * deepest))
    machine = Composition(acceptor)
    for name, (inner, short, long) in starts.items():
        for x, y in machine.replaced(short):
            yield name, x, y, False
        if long is not None:
            for x, y in machine.deleted(long, short, inner):
                yield name, x, y, True


# --- tables -----------------------------------------------------------------------------

# --- Fixed values: what a run of letters is made of ---
LETTERS = "A-Za-z\u00C0-\u00FF"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def letter_runs(text: Column, least: int = 1) -> Column:
    """Maximal runs of at least ``least`` letters of a text, A-Z lowered; none for a null text."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))


def count_words(runs: DataFrame, word: str = "word", rules: Variants = Variants()) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; folded before the shuffle, so frequent words are cheap."""
    long = runs.filter(F.length(word) >= rules.min_chars)
    return long.groupBy(F.col(word).alias("word")).agg(F.count("*").alias("n")).filter(F.col("n") >= rules.min_count)


def _middle() -> Column:
    return F.substring("word", F.col("i") + 1, F.col("j") - F.col("i") + F.col("longer"))


def _start_state() -> Column:
    """Names what is read before and behind the middle, and where the middle lies."""
    before = F.substring("word", F.lit(1), F.col("i"))
    behind = F.substring("word", F.col("j") + F.col("longer") + 1, F.length("word"))
    return F.sha2(F.concat_ws("\n", F.concat_ws(",", "m", "i", "j"), before, behind), 256)


def _divided(rows: DataFrame) -> DataFrame:
    """Each row twice: the edit lies in the second half of the middle, or else in the first."""
    half = F.expr("i + (j - i) div 2")
    ends = F.array(F.struct(half.alias("i"), F.col("j")), F.struct(F.col("i"), half.alias("j")))
    return rows.select("word", "n", "m", "longer", F.explode(ends).alias("e")).select(
        "word", "n", "m", "longer", "e.i", "e.j"
    ).withColumn("state", _start_state())


def start_states(vocabulary: DataFrame, rules: Variants) -> DataFrame:
    """(word, n, m, longer, i, j, state): words by the start states from which pairs are sought.

    Of two words one edit apart let m be the smaller length, and let both be cut at a code
    point: either all before it agrees, or else all behind it. So a word belongs to the state
    reached over its first half and to that over its second half (read backwards), for m its
    own length and for m one less (``longer`` = 1). A state with very many words, or long
    middles, is divided again by the same argument, until the middle is one code point and the
    alphabet bounds the state; so no word weighs on one task, whatever the vocabulary.
    """
    own = F.array(F.struct(F.length("word").alias("m"), F.lit(0).alias("longer")), F.struct((F.length("word") - 1).alias("m"), F.lit(1).alias("longer")))
    whole = vocabulary.select("word", "n", F.explode(own).alias("o")).select("word", "n", "o.m", "o.longer")
    whole = whole.filter(F.col("m") >= rules.min_chars)
    rows = materialise(_divided(whole.withColumn("i", F.lit(0)).withColumn("j", F.col("m"))), "word-states")
    done = None
    while True:
        width = F.col("j") - F.col("i")
        counted = rows.groupBy("state", "i", "j").agg(F.count("*").alias("words"))
        large = ((F.col("words") > rules.group) | (width > rules.reach)) & (width >= 2)
        hot = materialise(counted.filter(large).select("state"), "hot-states")
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        rest = rows.join(hot, "state", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        rows = materialise(_divided(rows.join(hot, "state", "left_semi")), "word-states")


def _pair_up(table: pa.Table) -> pa.Table:
    """Per word of the table's groups: number of near words, and the most frequent one (smallest of equals)."""
    columns = [table.column(c).to_pylist() for c in ("state", "middle", "word", "n", "longer", "inner")]
    groups: dict[str, tuple[bool, list[str], list[str]]] = {}
    known: dict[tuple[str, bool, str], tuple[str, int]] = {}
    for state, middle, word, n, longer, inner in zip(*columns):
        groups.setdefault(state, (inner, [], []))[1 + longer].append(middle)
        known[state, bool(longer), middle] = (word, n)
    near: dict[str, list] = {}
    for state, x, y, longer in near_pairs(groups):
        one, other = known[state, longer, x], known[state, False, y]
        for (word, _), (form, n) in ((one, other), (other, one)):
            best = near.get(word)
            if best is None:
                near[word] = [1, n, form]
            else:
                best[0] += 1
                if (-n, form) < (-best[1], best[2]):
                    best[1:] = n, form
    return pa.table({
        "word": pa.array(list(near), pa.string()),
        "near": pa.array([b[0] for b in near.values()], pa.int64()),
        "form_n": pa.array([b[1] for b in near.values()], pa.int64()),
        "form": pa.array([b[2] for b in near.values()], pa.string()),
    })


def near_words(vocabulary: DataFrame, rules: Variants = Variants()) -> DataFrame:
    """(word, n_near, near_n, near_form) of the words that have near words; each pair is found from exactly one state."""
    rows = materialise(start_states(vocabulary, rules), "start-states")
    buckets = max(1, rows.count() // rules.bucket)
    dealt = rows.select(
        F.pmod(F.xxhash64("state"), F.lit(buckets)).alias("bucket"), "state", _middle().alias("middle"), "word", "n", "longer",
        (F.col("j") < F.col("m")).alias("inner"),
    )
    found = dealt.groupBy("bucket").applyInArrow(_pair_up, "word string, near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.form").alias("near_form")
    )


def spelling_forms(vocabulary: DataFrame, rules: Variants = Variants()) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each row of a vocabulary (word, n).

    Two words are near if one inserted, deleted or replaced code point makes them equal.
    ``form`` is the near word of largest n (of equals the smallest by code point) if that n is
    at least ``rules.ratio`` * n; ``root`` is reached by following forms, the word itself if it
    has none. Words are distinct; rows with a null word or n, or too short or rare, are left out;
    an empty vocabulary gives an empty table; other columns are not looked at. Counts grow
    by the ratio along forms, so chains are short: roots are found in a few doubling rounds.
    """
    usable = (F.length("word") >= rules.min_chars) & (F.col("n") >= rules.min_count)
    words = materialise(vocabulary.select("word", F.col("n").cast("long").alias("n")).filter(usable), "vocabulary")
    near = near_words(words, rules)
    enough = F.col("near_n") >= rules.ratio * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("near_form")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n"),
    )
    judged = materialise(judged, "spelling-forms")
    links = materialise(judged.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = materialise(moved, "spelling-links")
        links = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            break
    return judged.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))
