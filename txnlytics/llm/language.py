"""Language identification by cross-parsing: the language whose labelled text explains a text in the fewest phrases."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from txnlytics.llm.common import renamed_free, slices

UNDETERMINED = "und"


@dataclass(frozen=True)
class Parsing:
    """The labelled sample is bounded: per language at most ``rows`` rows and ``sample_bytes`` bytes of them.

    A text is parsed in segments of ``segment`` bytes, all of them; a phrase ends with its segment.
    """

    rows: int = 64
    sample_bytes: int = 32_768
    segment: int = 2048
    lanes: int = 2048


# --- text to symbols ----------------------------------------------------------------

_LETTER = re.compile(r"[^\W\d_]+")  # letters, and a few signs such as fractions
_SYMBOL = np.zeros(256, dtype=np.uint8)  # 0: anything between words
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[128:] = np.arange(27, 155)
ALPHABET = 155


def has_letter(text: bytes) -> bool:
    """Whether a text has a letter (Unicode category L); bytes that are no UTF-8 have none."""
    decoded = text.decode("utf-8", "replace")
    return any(any(map(str.isalpha, run.group())) for run in _LETTER.finditer(decoded))


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, end of each): Latin letters lowered, runs between words as one symbol."""
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8).copy()
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    if len(raw):
        upper = np.flatnonzero((raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97) & (raw[:-1] == 0xC3)) + 1
        raw[upper] += 0x20
    code = _SYMBOL[raw]
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    keep[ends[:-1][ends[:-1] < len(keep)]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return code[keep], kept[ends]


# --- suffix automata -----------------------------------------------------------------


def suffix_automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts exactly the substrings of ``text``; state 0 is the root."""
    moves, link, length = [{}], [-1], [0]
    last = 0
    for symbol in text.tolist():
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = new
            at = link[at]
        if at >= 0:
            to = moves[at][symbol]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and moves[at].get(symbol) == to:
                    moves[at][symbol] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return moves


@dataclass(frozen=True)
class Model:
    """Per language: its automaton's moves (from, symbol, to), its number of states, and the log of its sample's length."""

    languages: tuple[str, ...]
    moves: tuple[tuple[np.ndarray, np.ndarray, np.ndarray], ...]
    states: tuple[int, ...]
    weight: np.ndarray


class Tables:
    """The moves of all languages in one flat table: entry [state + symbol] = 2 * next state, + 1 if a phrase ends before the symbol.

    States are counted in steps of the alphabet, which has the symbols learned and one for
    all others. After the end of a phrase the symbol starts the next one at the root. A
    symbol that the text lacks is a phrase of its own: it leads to the last state, which
    ends at once.
    """

    def __init__(self, model: Model) -> None:
        seen = np.unique(np.concatenate([m[1] for m in model.moves])) if model.moves else np.zeros(0, np.uint8)
        self.symbol = np.full(ALPHABET, len(seen), dtype=np.uint8)
        self.symbol[seen] = np.arange(len(seen))
        width = len(seen) + 1
        parts, self.begin, offset = [], [], 0
        for (source, symbol, target), states in zip(model.moves, model.states):
            symbol = self.symbol[symbol]
            begin = np.full(width, states, dtype=np.int64)
            root = source == 0
            begin[symbol[root]] = target[root]
            table = np.tile(2 * (begin * width + offset) + 1, (states + 1, 1))
            table[0, begin == states] -= 1  # no phrase is open at the root
            table[source, symbol] = 2 * (target.astype(np.int64) * width + offset)
            parts.append(table.astype(np.int32).ravel())
            self.begin.append(offset)
            offset += table.size
        self.flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.root = np.array(self.begin, dtype=np.int32)[:, None]


def fit(labelled: DataFrame, rules: Parsing = Parsing(), text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Learn from rows with a text and a label.

    Rows are drawn per language by the MD5 of their key (``rows`` at most); whole texts are
    used in that order as long as they fit ``sample_bytes``, and only a language with no
    text that short uses the beginning of its shortest one. The automata are built in
    parallel; what returns to the driver is bounded by languages * sample_bytes.
    """
    body = F.col(text).cast("binary")
    order = Window.partitionBy("lang").orderBy(F.octet_length("body") > rules.sample_bytes, "draw", "body")
    rows = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), body.alias("body"), F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("draw")
    )
    rows = rows.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= rules.rows)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("k")
        texts = [bytes(t) for t in pdf["body"] if _LETTER.search(t.decode())]
        chosen, size = [], 0
        for t in texts:
            if size + len(t) + 1 <= rules.sample_bytes:
                chosen.append(t + b" ")
                size += len(t) + 1
        if not chosen and texts:
            chosen = [min(texts, key=lambda t: (len(t), t))[: rules.sample_bytes]]
        code, _ = symbols(chosen)
        moves = suffix_automaton(code)
        steps = np.array([(k, symbol, to) for k, step in enumerate(moves) for symbol, to in step.items()], dtype=np.int32).reshape(-1, 3)
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "bytes": [len(code)], "states": [len(moves)], "moves": [steps.T.tobytes()]})

    built = rows.groupBy("lang").applyInPandas(build, "lang string, bytes long, states int, moves binary")
    built = built.filter("bytes > 0").orderBy("lang").collect()
    moves = [np.frombuffer(row["moves"], dtype=np.int32).reshape(3, -1) for row in built]
    return Model(
        tuple(row["lang"] for row in built),
        tuple((m[0], m[1].astype(np.uint8), m[2]) for m in moves),
        tuple(row["states"] for row in built),
        np.log2(np.array([row["bytes"] + 1 for row in built], dtype=float)),
    )


def phrases(texts: list[bytes], tables: Tables, rules: Parsing = Parsing()) -> np.ndarray:
    """Number of phrases of each text (rows) in each language (columns): greedy longest matches, many segments in step."""
    code, ends = symbols(texts)
    code = tables.symbol[code]
    starts = np.concatenate([[0], ends[:-1]])
    pieces = -(-(ends - starts) // rules.segment)
    owner = np.repeat(np.arange(len(texts)), pieces)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = starts[owner] + inner * rules.segment
    length = np.minimum(ends[owner] - begin, rules.segment)
    order = np.argsort(-length, kind="stable")
    counts = np.zeros((len(owner), len(tables.root)), dtype=np.int64)
    for at in range(0, len(order), rules.lanes):
        lane = order[at : at + rules.lanes]
        longest = int(length[lane[0]])
        step = np.arange(longest)[:, None]
        grid = code[np.minimum(begin[lane][None, :] + step, len(code) - 1)]
        active = np.searchsorted(-length[lane], -np.arange(longest), side="left")
        state = np.repeat(tables.root, len(lane), axis=1)
        broken = np.ones((len(tables.root), len(lane)), dtype=np.int32)
        for t in range(longest):
            n = active[t]
            to = tables.flat[state[:, :n] + grid[t, :n]]
            broken[:, :n] += to & 1
            state[:, :n] = to >> 1
        counts[lane] = broken.T
    out = np.zeros((len(texts), len(tables.root)))
    np.add.at(out, owner, counts)
    return out


def identify(df: DataFrame, model: Model, rules: Parsing = Parsing(), text: str = "text") -> DataFrame:
    """Rows of ``df`` (columns other than the text) with ``lang_pred`` and ``score``.

    The language with the smallest phrases * log2(sample length) wins, the first by code
    point if several tie. ``score`` is how far the best lies below the second, from 0 to 1;
    1 if there is one language. A null text, one without a letter, or any text if nothing
    was learned is ``und`` with score 0. Repeated rows are judged alike; an empty table
    gives an empty table; columns named ``lang_pred`` or ``score`` are replaced.
    """
    out = renamed_free(df, "lang_pred", "score")
    rest = [c for c in out.columns if c != text]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        tables = Tables(known)
        for batch in batches:
            bodies = batch.column(text).to_pylist()
            for begin, end in slices(bodies, 4 << 20):
                texts = bodies[begin:end]
                clear = np.array([has_letter(t) for t in texts]) & bool(known.languages)
                name = np.full(len(texts), UNDETERMINED, dtype=object)
                score = np.zeros(len(texts))
                if clear.any():
                    cost = phrases([t for t, c in zip(texts, clear) if c], tables, rules) * known.weight
                    best = np.argmin(cost, axis=1)
                    name[clear] = np.array(known.languages, dtype=object)[best]
                    low = np.sort(cost, axis=1)
                    score[clear] = 1 - low[:, 0] / low[:, 1] if cost.shape[1] > 1 else 1.0
                columns = [batch.column(c).slice(begin, end - begin) for c in rest]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(name, pa.string()), pa.array(score)], [*rest, "lang_pred", "score"])

    body = F.coalesce(F.col(text), F.lit("")).cast("binary").alias(text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.select(*rest).schema) if rest else ""
    schema = ", ".join(x for x in (fields, "lang_pred string, score double") if x)
    return out.select(*rest, body).mapInArrow(judge, schema)


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus
