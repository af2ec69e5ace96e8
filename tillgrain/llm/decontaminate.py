"""Benchmark decontamination: one Aho-Corasick automaton over normalised questions and answers.

Texts are folded to words (see common.FOLDED). A window is `width` consecutive words of an item; an
item with fewer words, but not none, is one window. The distinct windows become the patterns of one
automaton, and every document is scanned once.

Words that occur in no window cannot take part in a match, so the automaton does not read characters:
each word of the windows has a code of fixed length over small alphabets (its first letter from one
set, the rest from another, so that a match can only start at a word), and every other word is the
same number of blanks. The nodes of the automaton then have at most 64 children, there are a few for
each word instead of one for each letter, and the end of a match divided by the code length is the
place of the word. Places are mapped to offsets in the original text for the spans.

The windows are a table that Spark derives from the items. It is sent to the tasks in blocks of at
most `block_windows` windows (chosen by hash, sizes checked); with more blocks the documents are
scanned once for each, and the hits are united per document. Nothing is dropped at any size.

Defined results: a null or empty text has no words, no hits and is not contaminated; repeated rows
are answered one by one; items that are null, empty or without words have no windows; hits of an item
with null item_id count as hits, but it is not listed; empty tables give empty or all-clean results;
an output column replaces an input column of the same name, all other columns are carried along.
"""

import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrain.llm.common import FOLDED, append_columns, byte_texts, folded_words
from tillgrain.session import stage

WIDTH = 10
BLOCK_WINDOWS = 100_000
FIRST = "".join(map(chr, range(64, 128)))
REST = "".join(map(chr, range(128, 192)))
BLANK = " "

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
HITS = T.StructType(
    [
        T.StructField("places", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def windows_of(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct windows of all items: window (words joined by a space) and its item_ids as strings."""
    schema = "window binary, item string"

    def run(batches):
        for batch in batches:
            windows, owners = [], []
            for item, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
                words = folded_words(text)
                for i in range(max(1, len(words) - width + 1) if words else 0):
                    windows.append(b" ".join(words[i : i + width]))
                    owners.append(item)
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows, pa.binary()), pa.array(owners, pa.string())],
                names=["window", "item"],
            )

    read = items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return read.mapInArrow(run, schema).groupBy("window").agg(F.collect_set("item").alias("items"))


class Automaton:
    """Windows of one block, ready to scan lists of words."""

    def __init__(self, windows: list[tuple[bytes, list[str]]]):
        split = [(w.split(b" "), items) for w, items in windows]
        vocabulary = sorted({word for words, _ in split for word in words})
        self.length, room = 1, len(FIRST)
        while room < len(vocabulary):
            self.length, room = self.length + 1, room * len(REST)
        self.code = {word: self._code(i) for i, word in enumerate(vocabulary)}
        self.blank = BLANK * self.length
        self.machine = ahocorasick.Automaton()
        for words, items in split:
            self.machine.add_word("".join([self.code[w] for w in words]), (len(words), tuple(items)))
        self.machine.make_automaton()

    def _code(self, i: int) -> str:
        tail = ""
        for _ in range(self.length - 1):
            i, digit = divmod(i, len(REST))
            tail += REST[digit]
        return FIRST[i] + tail

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Places of the hit words, in order, and the items with occurring windows."""
        if not self.code:
            return np.empty(0, np.int64), set()
        known, blank = self.code.get, self.blank
        coded = "".join([known(w, blank) for w in words])
        starts, lengths, items = [], [], set()
        for end, (n, owners) in self.machine.iter(coded):
            starts.append((end + 1) // self.length - n)
            lengths.append(n)
            items.update(owners)
        if not starts:
            return np.empty(0, np.int64), items
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, starts, 1)
        np.add.at(edges, np.add(starts, lengths), -1)
        return np.flatnonzero(np.cumsum(edges[:-1]) > 0), items


def word_spans(text: bytes, places: np.ndarray) -> list[list[int]]:
    """Runs of neighbouring word places as [start, end) in code points of the original text."""
    if not len(places):
        return []
    found = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(FOLDED))]
    cuts = np.flatnonzero(np.diff(places) > 1) + 1
    points = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    offset = lambda i: int(points[i - 1]) if i else 0
    return [
        [offset(found[run[0]][0]), offset(found[run[-1]][1])] for run in np.split(places, cuts)
    ]


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _result(n_words, places, items, text) -> dict:
    return {
        "n_words": n_words,
        "n_hit": len(places),
        "n_items": len(items),
        "items_sha256": _digest(items),
        "contaminated": len(places) > 0,
        "spans": word_spans(text, places) if len(places) else [],
        "items": sorted(items),
    }


def _columns(rows: list[dict], fields: T.StructType) -> dict:
    return {f.name: [row[f.name] for row in rows] for f in fields}


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    keep: list[str] | None = None,
    width: int = WIDTH,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Columns RESULT for every row of docs(text): hit words, items, spans of hits in the text."""
    windows = stage(windows_of(items, width), "decontaminate-windows")
    blocks = max(1, -(-windows.count() // (block_windows // 2)))
    numbered = windows.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    if blocks > 1:
        return _in_blocks(docs, numbered, blocks, block_windows, keep)
    only = _block(numbered, 0, block_windows)

    def make():
        machine = Automaton(only)

        def compute(texts):
            rows = []
            for text in byte_texts(texts):
                words = folded_words(text)
                places, found = machine.scan(words)
                rows.append(_result(len(words), places, found, text))
            return _columns(rows, RESULT)

        return compute

    return append_columns(docs, make, ["text"], RESULT, keep)


def _block(windows: DataFrame, block: int, bound: int) -> list[tuple[bytes, list[str]]]:
    """The windows of one block on the driver; more than the bound is an error, not a cut."""
    rows = windows.where(F.col("block") == block).select("window", "items").limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"block {block} holds more than {bound} windows; raise block_windows")
    return [(bytes(w), [i for i in items if i is not None]) for w, items in rows]


def _in_blocks(docs: DataFrame, numbered: DataFrame, blocks: int, bound: int, keep) -> DataFrame:
    """One scan and one stored table of hits for each block, united by the digest of the text.

    The driver and the tasks hold one block at a time. Only texts with hits are stored, each once.
    """
    keyed = docs.withColumn("_text_key", F.sha2(F.col("text").cast("binary"), 256))
    hits = None
    for block in range(blocks):
        part = _block(numbered, block, bound)

        def make(part=part):
            machine = Automaton(part)

            def compute(texts):
                found = [machine.scan(folded_words(text)) for text in byte_texts(texts)]
                return {
                    "places": [places.tolist() for places, _ in found],
                    "items": [sorted(items) for _, items in found],
                }

            return compute

        scanned = append_columns(keyed, make, ["text"], HITS, ["_text_key"])
        kept = scanned.where(F.size("places") > 0).dropDuplicates(["_text_key"])
        kept = stage(kept, "decontaminate-hits")
        hits = kept if hits is None else hits.unionByName(kept)
    united = hits.groupBy("_text_key").agg(
        F.flatten(F.collect_list("places")).alias("places"),
        F.flatten(F.collect_list("items")).alias("found_items"),
    )
    joined = keyed.withColumnsRenamed({c: f"_in_{c}" for c in docs.columns if c != "text"}).join(
        united, "_text_key", "left"
    )

    def make_result():
        def compute(texts, places, found):
            rows = []
            for text, at, items in zip(byte_texts(texts), places.to_pylist(), found.to_pylist()):
                words = folded_words(text)
                at = np.unique(np.array(at or [], np.int64))
                rows.append(_result(len(words), at, set(items or []), text))
            return _columns(rows, RESULT)

        return compute

    kept = [c for c in (docs.columns if keep is None else keep)]
    inner = [c if c == "text" else f"_in_{c}" for c in kept]
    result = append_columns(joined, make_result, ["text", "places", "found_items"], RESULT, inner)
    made = {c.lower() for c in RESULT.names}
    names = {f"_in_{c}": c for c in kept if c.lower() not in made}
    return result.select(
        *(F.col(c).alias(names.get(c, c)) for c in result.columns if c in names or not c.startswith("_in_"))
    )
