"""Quality rules on repetition: how much of a text lies inside duplicated n-grams and lines.

Words are runs of characters other than ASCII white space. Every word has a number within its text.
The hash of an n-gram is the polynomial of its word numbers modulo 2**64, taken for all places at
once by rolling sums in numpy; a text holds at most 2**32 words, and equal hashes are confirmed by
comparing the windows themselves, so that the counts are exact. The measure for a length n is the
share of word characters that lie inside n-grams found twice or more, first ones included. A text
without a repeated 3-gram has no longer repeated n-gram either, and costs one pass.

Verdict of the method: a text goes when, for a length in LIMITS, more than that share of its word
characters is inside duplicated n-grams, or when duplicated lines hold more than LINE_LIMIT of them.

Defined results: null and empty texts have zero counts and shares and fail the base rule; repeated
rows are judged one by one; an output column replaces an input column of that name, others are kept.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillgrain.llm.common import append_columns, byte_texts

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
INNER_BYTES = bytes(range(0x80, 0xC0))
BASE_N = 3
MIN_WORDS = 50
# Share of word characters allowed inside duplicated n-grams, by n. First occurrences are counted, so
# these are twice the published shares of repeats alone; one repeated header line is within them.
LIMITS = {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}
LINE_LIMIT = 0.30
FACTOR = np.uint64(0x9E3779B97F4A7C15)

RESULT = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols")]
    + [T.StructField(c, T.LongType()) for c in ("n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    + [T.StructField("dup_line_chars", T.DoubleType())]
    + [T.StructField(f"dup_{n}gram_chars", T.DoubleType()) for n in LIMITS]
)


def rolling_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of n ids: the sum of id * FACTOR**place, with wrap-around."""
    out = np.zeros(len(ids) - n + 1, np.uint64)
    for i in range(n):
        out = out * FACTOR + ids[i : len(ids) - n + 1 + i]
    return out


def repeated(ids: np.ndarray, n: int, among: np.ndarray | None = None) -> np.ndarray:
    """Starts of the windows of n ids that occur twice or more; among: the only possible starts."""
    starts = np.arange(max(0, len(ids) - n + 1)) if among is None else among
    starts = starts[starts <= len(ids) - n]
    if len(starts) < 2:
        return starts[:0]
    keys = rolling_hashes(ids, n)[starts]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    same = keys[1:] == keys[:-1]
    if not same.any():
        return starts[:0]
    left, right = starts[order[:-1][same]], starts[order[1:][same]]
    equal = (ids[left[:, None] + np.arange(n)] == ids[right[:, None] + np.arange(n)]).all(axis=1)
    if not equal.all():  # different windows share a hash: compare the windows instead
        rows = ids[starts[:, None] + np.arange(n)]
        _, inverse, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        return starts[counts[inverse.ravel()] > 1]
    return np.unique(np.concatenate([left, right]))


def covered(starts: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of so many words lie inside a window of n words at one of the starts."""
    edges = np.zeros(length + 1, np.int64)
    edges[starts] += 1
    edges[starts + n] -= 1
    return np.cumsum(edges[:-1]) > 0


def code_points(word: bytes) -> int:
    return len(word.translate(None, INNER_BYTES))


def measure(text: bytes | None) -> tuple:
    """The columns of RESULT for one text."""
    text = text or b""
    words = text.split()
    total = len(text.translate(None, SPACES + INNER_BYTES))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    dup_lines = dup_chars = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup_lines += 1
            dup_chars += len(line.translate(None, SPACES + INNER_BYTES))
        elif line and not line.isspace():
            seen.add(line)
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.uint64) + np.uint64(1)
    starts = repeated(ids, BASE_N) if len(numbers) < len(words) else np.empty(0, np.int64)
    repeats = int(covered(starts, BASE_N, len(words)).sum()) if len(starts) else 0
    shares = dict.fromkeys(LIMITS, 0.0)
    if len(starts):
        points = np.array([code_points(w) for w in numbers], np.int64)[ids.astype(np.int64) - 1]
        for n in LIMITS:  # a repeated window starts with a repeated shorter one
            starts = repeated(ids, n, starts)
            if not len(starts):
                break
            shares[n] = float(points[covered(starts, n, len(words))].sum() / total)
    line_share = dup_chars / total if total else 0.0
    failed = len(words) < MIN_WORDS or 100 * repeats > 50 * len(words)
    over = line_share > LINE_LIMIT or any(shares[n] > LIMITS[n] for n in LIMITS)
    head = (len(words), total, symbols, dup_lines, repeats, failed, not failed and not over)
    return (*head, line_share, *shares.values())


def quality(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns RESULT for every row of docs(text): base counts, duplicated shares and the verdict."""

    def make():
        def compute(texts):
            rows = [measure(text) for text in byte_texts(texts)]
            return dict(zip(RESULT.names, map(list, zip(*rows))))

        return compute

    return append_columns(docs, make, ["text"], RESULT, keep)
