"""Language ID with language-bitmask n-gram filters.

Texts become folded bytes: ASCII letters in lower case, every run of other ASCII characters one blank
(characters beyond ASCII keep their UTF-8 bytes). n-grams are all runs of GRAM bytes.

Learning: every task counts the n-grams of its training rows by language, Spark adds the counts. An
n-gram belongs to a language when it makes up at least MIN_SHARE of the language's n-grams and at
least RELATIVE of its largest share in any language. So a language has at most 1 / MIN_SHARE n-grams,
however large the corpus is: that bounds what the driver and the tasks hold.

The filter is a bit-sliced Bloom filter: one array of language masks in place of one bit array for
each language. An n-gram sets its language's bit at HASHES positions; a query takes the masks at these
positions together with AND and has all languages containing the n-gram at once.

Prediction: per-language popcounts over all n-grams of a text. With n n-grams, and f the share of
foreign n-grams that a language's filter lets pass (its fill to the power of HASHES), a count c is
corrected to (c - n f) / (1 - f). The largest corrected count decides, ties go to the first language
in order. The score is the corrected share of the text's n-grams that the language contains, 0 to 1.

Defined results: null texts and texts without a letter are `und` with score 0, as is everything if
there is no training row; a text shorter than an n-gram is padded with blanks; rows with null lang or
text are not learned from; repeated rows count as often as they are there; an output column replaces
an input column of its name, other columns are kept. More than MAX_LANGUAGES languages raise an error.
"""

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrain.llm.common import append_columns, byte_texts
from tillgrain.session import stage

GRAM = 4
HASHES = 3
SLOTS_LOG2 = 20
MIN_SHARE = 2e-5
RELATIVE = 0.05
MAX_LANGUAGES = 64
UNKNOWN = "und"
CHUNK_BYTES = 4_000_000
HASH_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)
)
LETTER = regex.compile(r"\p{L}")
LATIN_LETTER = regex.compile(rb"[A-Za-z]")

RESULT = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)


def folded(text: bytes) -> bytes:
    """Folded bytes, framed by blanks, at least one n-gram long."""
    return (b" " + b" ".join(text.translate(FOLD).split()) + b" ").ljust(GRAM)


def grams(data: np.ndarray) -> np.ndarray:
    """The n-gram that starts at each byte but the last ones, as a number."""
    out = data[: len(data) - GRAM + 1].astype(np.uint32)
    for i in range(1, GRAM):
        out |= data[i : len(data) - GRAM + 1 + i].astype(np.uint32) << np.uint32(8 * i)
    return out


def chunks(texts: list[bytes]):
    """(first index, joined bytes, lengths) of neighbouring texts, joined up to a bounded size."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK_BYTES or i == len(texts) - 1:
            part = texts[first : i + 1]
            lengths = np.fromiter(map(len, part), np.int64, len(part))
            yield first, np.frombuffer(b"".join(part), np.uint8), lengths
            first, size = i + 1, 0


def text_grams(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams inside the joined texts and, for each text, where its first one is."""
    keys = grams(data)
    ends = np.cumsum(lengths)
    inside = np.ones(len(keys), bool)
    for i in range(1, GRAM):  # those that reach over the end of a text
        at = ends[:-1] - i
        inside[at] = False
    counts = lengths - GRAM + 1
    return keys[inside], np.cumsum(counts) - counts


def count_grams(training: DataFrame) -> DataFrame:
    """lang, gram, n over all rows of training(text, lang)."""

    def add(counts: dict, lang: str, keys: np.ndarray, n: np.ndarray) -> None:
        old = counts.get(lang)
        if old is not None:
            keys, n = np.concatenate([old[0], keys]), np.concatenate([old[1], n])
            keys, inverse = np.unique(keys, return_inverse=True)
            n = np.bincount(inverse, weights=n, minlength=len(keys)).astype(np.int64)
        counts[lang] = keys, n

    def run(batches):
        counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            texts, langs = byte_texts(batch.column(0)), batch.column(1).to_pylist()
            for lang in set(langs):
                own = [folded(t) for t, x in zip(texts, langs) if x == lang]
                for _, data, lengths in chunks(own):
                    add(counts, lang, *np.unique(text_grams(data, lengths)[0], return_counts=True))
        for lang, (keys, n) in counts.items():
            for at in range(0, len(keys), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(keys[part]), pa.string()),
                        pa.array(keys[part].astype(np.int64)),
                        pa.array(n[part].astype(np.int64)),
                    ],
                    names=["lang", "gram", "n"],
                )

    counted = training.select("text", "lang").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def chosen_grams(counts: DataFrame) -> DataFrame:
    """The (lang, gram) pairs that enter the filter."""
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals.limit(MAX_LANGUAGES + 1)), "lang").select(
        "lang", "gram", (F.col("n") / F.col("total")).alias("share")
    )
    kept = shares.where(F.col("share") >= MIN_SHARE)
    best = kept.groupBy("gram").agg(F.max("share").alias("best"))
    return kept.join(best, "gram").where(F.col("share") >= RELATIVE * F.col("best"))


def slots(keys: np.ndarray) -> list[np.ndarray]:
    """Positions of n-grams in the filter, one array for each hash function."""
    keys = keys ^ (keys >> np.uint32(15))
    return [(keys * factor) >> np.uint32(32 - SLOTS_LOG2) for factor in HASH_FACTORS[:HASHES]]


class Filter:
    """Masks of languages by position; a plain array that is sent to the tasks."""

    def __init__(self, languages: list[str], pairs: list[tuple[str, np.ndarray]]):
        self.languages = languages
        bits = max(8, 1 << max(0, len(languages) - 1).bit_length())
        self.masks = np.zeros(1 << SLOTS_LOG2, f"u{bits // 8}")
        for k, lang in enumerate(languages):
            for lang_of_keys, keys in pairs:
                if lang_of_keys == lang:
                    for at in slots(keys.astype(np.uint32)):
                        self.masks[at] |= self.masks.dtype.type(1 << k)
        fill = np.array([self.bit(self.masks, k).mean() for k in range(len(languages))])
        self.false_share = np.minimum(fill**HASHES, 0.999)

    @staticmethod
    def bit(masks: np.ndarray, k: int) -> np.ndarray:
        return (masks >> masks.dtype.type(k)) & masks.dtype.type(1)

    def counts(self, keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Corrected counts, a row for each language and a column for each text."""
        first, *others = slots(keys)
        found = self.masks[first]
        for at in others:
            found &= self.masks[at]
        n = np.diff(np.append(starts, len(keys)))
        raw = [
            np.add.reduceat(self.bit(found, k), starts, dtype=np.int64)
            for k in range(len(self.languages))
        ]
        f = self.false_share[:, None]
        return np.clip((np.array(raw) - n * f) / (1 - f), 0, n), n


def learn(training: DataFrame) -> Filter:
    """The filter of all training rows with text and lang."""
    rows = training.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    # Staged: totals and shares both read the counts, which would go through all texts twice.
    counts = stage(count_grams(rows), "gram_counts")
    table = chosen_grams(counts).select("lang", "gram").toArrow().to_pandas()
    languages = sorted(table["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; the filter has room for {MAX_LANGUAGES}")
    return Filter(languages, [(k, g["gram"].to_numpy()) for k, g in table.groupby("lang")])


def has_letter(text: bytes) -> bool:
    return bool(LATIN_LETTER.search(text)) or bool(LETTER.search(text.decode()))


def predict(docs: DataFrame, model: Filter, keep: list[str] | None = None) -> DataFrame:
    """Columns RESULT for every row of docs(text)."""

    def make():
        def compute(texts):
            raw = byte_texts(texts)
            lettered = [bool(t) and has_letter(t) for t in raw]
            langs, scores = [UNKNOWN] * len(raw), np.zeros(len(raw))
            if model.languages:
                own = [folded(t) if ok else b" " * GRAM for t, ok in zip(raw, lettered)]
                for first, data, lengths in chunks(own):
                    counts, n = model.counts(*text_grams(data, lengths))
                    best = counts.argmax(axis=0)
                    top = counts[best, np.arange(len(best))] / n
                    for i, (k, score) in enumerate(zip(best, top), first):
                        if lettered[i]:
                            langs[i], scores[i] = model.languages[k], score
            return {"lang_pred": langs, "score": scores}

        return compute

    return append_columns(docs, make, ["text"], RESULT, keep)
