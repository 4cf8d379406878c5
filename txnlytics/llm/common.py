"""Column expressions and array helpers that the corpus operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

# --- Fixed values: the blanks that separate words -----------------------------
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WORD_RUN = r"[^\x20\x09-\x0D]+"

ROW = "_row"


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text, in order."""
    return F.array_remove(F.split(text, BLANK_RUN), "")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def renamed_free(df: DataFrame, *wanted: str) -> DataFrame:
    """``df`` without the columns whose names (in any case) an operator is about to add."""
    taken = {name.lower() for name in wanted}
    return df.drop(*[name for name in df.columns if name.lower() in taken])


def carried(df: DataFrame, *used: str) -> DataFrame:
    """The ``used`` columns of ``df``, and all others in one column ``_rest``, where their names can't clash.

    ``restored`` puts them back.
    """
    rest = [F.col(f"`{c}`").alias(c) for c in df.columns if c not in used]
    return df.select(*used, F.struct(*rest or [F.lit(None).cast("int").alias("none")]).alias("_rest"))


def restored(df: DataFrame, columns: list[str], used: tuple[str, ...], **changed: Column) -> list[Column]:
    """The original columns of a frame that ``carried`` its others; ``changed`` ones get a new value."""
    return [
        (changed[c] if c in changed else F.col(c) if c in used else F.col("_rest").getField(c)).alias(c) for c in columns
    ]


# --- words of many texts at once ----------------------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUE = np.random.Generator(np.random.PCG64(20240117)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit value."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """64-bit hashes of the blank-separated words of texts, A-Z lowered; keeps its power tables between calls."""

    def __init__(self) -> None:
        self._up = self._down = np.zeros(0, np.uint64)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first byte, end byte, text number) of each word and the joined lowered bytes."""
        raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        if len(raw) > len(self._up):
            self._up, self._down = _powers(_BASE, len(raw)), _powers(_BASE_INVERSE, len(raw))
        low = _LOWER[raw]
        inside = np.zeros(len(raw) + 1, dtype=np.int8)
        inside[1:] = ~_SPACE[raw]
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[0::2], edges[1::2]
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[low] * self._up[: len(raw)], out=total[1:])
        hashes = mix((total[ends] - total[starts]) * self._down[starts])
        first = np.cumsum([0, *[len(t) + 1 for t in texts]])
        owner = np.searchsorted(first, starts, side="right") - 1
        return hashes, starts, ends, owner, low


def slices(texts: list[bytes], most: int) -> list[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes together; a longer text is a run of its own."""
    out, begin, size = [], 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > most:
            out.append((begin, k))
            begin, size = k, 0
        size += len(text)
    if begin < len(texts):
        out.append((begin, len(texts)))
    return out
