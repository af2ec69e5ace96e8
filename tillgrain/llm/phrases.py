"""Phrases that stand together more often than their parts would, by Toivonen's sampling.

A sample of the texts proposes phrases: those that reach a lowered share of the minimum count in it.
One pass over all texts then counts exactly, at once, the proposed phrases and their negative border:
phrases that were not proposed although all their parts were. As every part of a frequent phrase is
frequent too, nothing is missed unless a phrase of the border turns out to be frequent. In that case
it joins the proposed ones, and another pass counts what that adds to the border, until no pass finds
such a phrase. The result does not depend on the sample; a bad one only costs more passes, at most as
many as a phrase may have words.

The border is large and nearly all of it rare, so a pass reads the texts twice: the first time numbers
are added up by the 64-bit hash of the phrase, and the second time the phrases behind the frequent
hashes are named. Two phrases with one hash are told apart by a second, independent one, and are then
counted as texts.

Proposed phrases and frequent hashes reach the tasks as Bloom filters, of which the size is bounded by
MAX_BITS whatever the corpus. A phrase that a filter holds by mistake is counted in vain. Counts are
added up in every task before they are exchanged, so a frequent phrase sends few rows a task.

Texts are cut into pieces at line breaks and . , ; : ! ?, pieces into words at blanks and tabs; A-Z
is lower-cased.

Defined results: null and empty texts have no words; rows without a group are of the group "und", as
are rows that name it; very long texts are counted in parts that overlap, so that nothing at the cuts
is lost or counted twice; repeated rows count each; an empty table gives no phrases; other columns are
not read.
"""

import functools
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.operators.joins import lookup_join
from tillgrain.session import stage

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
COVERED_PERCENT = 50  # a longer phrase with this share of the occurrences stands for the shorter one
NO_GROUP = "und"

SAMPLE_ONE_IN = 4
LOWERED = 0.8  # of the count that the sample should have of a phrase with the minimum count
BITS_PER_PHRASE = 16
MIN_BITS, MAX_BITS = 1 << 20, 1 << 29
CHUNK_BYTES = 1_000_000  # so many bytes of text are taken together; a word is at least two bytes
HELD_HASHES = 4_000_000  # occurrences that a task adds up before it hands them on
NAMED_ROWS = 50_000  # phrases that a task names at once
BUCKET_BYTES = 16_000_000  # of text for each bucket of hashes

CUT = b"\xff"  # no byte of UTF-8
BLANKS = b" \t" + CUT
IS_BLANK = np.isin(np.arange(256), list(BLANKS))
# Fixed values of the two hashes: odd bases, and a number for each byte but blanks.
BASES = (np.uint64(0x9DDFEA08EB382D69), np.uint64(0xC2B2AE3D27D4EB4F))
VALUES = [
    np.where(IS_BLANK, 0, np.array([xxhash.xxh64_intdigest(bytes([b]), kind) for b in range(256)], np.uint64))
    for kind in (11, 12)
]
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else CUT[0] if chr(b) in ".,;:!?" or 10 <= b <= 13 else b for b in range(256)
)
BREAK = re.compile(rb"[ \t\xff]")


# ---- words of a task --------------------------------------------------------------------------


def buffers(texts: Iterable[bytes], overlap: int, limit: int) -> Iterator[tuple[bytes, int]]:
    """Folded texts in buffers of bounded size, with cuts around each.

    With each buffer, how many of its first words end the one before, of the same text.
    """
    held, carried, size = [], 0, 0
    for text in texts:
        text, start = text.translate(FOLD), 0
        # A part ends behind a blank, so that no word is cut.
        while len(text) - start > limit and (cut := BREAK.search(text, start + limit)):
            held.append(text[start : cut.end()])
            yield CUT + CUT.join(held) + CUT, carried
            start, carried = before_last_words(text, cut.end(), overlap)
            held, size = [], 0
        held.append(text[start:])
        size += len(text) - start
        if size > limit:
            yield CUT + CUT.join(held) + CUT, carried
            held, carried, size = [], 0, 0
    if held:
        yield CUT + CUT.join(held) + CUT, carried


def before_last_words(text: bytes, end: int, n: int) -> tuple[int, int]:
    """Where the last n words before a place begin, and how many there are, at most n."""
    found, start = 0, end
    while found < n:
        at = start
        while at and text[at - 1] in BLANKS:
            at -= 1
        if not at:
            break
        start = 1 + max(text.rfind(blank, 0, at) for blank in (b" ", b"\t", CUT))
        found += 1
    return start, found


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def joined_hash(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of all its words but the last, and of the last."""
    return scrambled(first * np.uint64(0x9E3779B97F4A7C15) + (last ^ (last >> np.uint64(29))))


class Words:
    """The words of a buffer: where they begin and end, whether the next one is of the same piece, and
    two independent hashes."""

    def __init__(self, group: str, buffer: bytes, carried: int):
        self.group, self.buffer, self.carried = group, buffer, carried
        self._bytes = np.frombuffer(buffer, np.uint8)
        blank = IS_BLANK[self._bytes]
        self.starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
        self.ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
        piece = np.cumsum(self._bytes == CUT[0])[self.starts]
        self.joined = np.append(piece[1:] == piece[:-1], False)[: len(self.starts)]
        self.hashes = self._hashes(0)

    def __len__(self) -> int:
        return len(self.starts)

    def _hashes(self, kind: int) -> np.ndarray:
        """A polynomial of the bytes of each word, with the group as a seed."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        first, segments = self.starts[0], np.diff(self.starts, append=len(self.buffer))
        place = np.arange(len(self.buffer) - first) - np.repeat(self.starts - first, segments)
        factors = powers(kind, int((self.ends - self.starts).max()))
        np.minimum(place, len(factors) - 1, out=place)  # blanks behind a word count nothing
        terms = VALUES[kind][self._bytes[first:]] * factors[place]
        sums = np.add.reduceat(terms, self.starts - first)
        return scrambled(sums + np.uint64(xxhash.xxh64_intdigest(self.group.encode(), kind)))

    def second_hashes(self, places: np.ndarray, length: int) -> np.ndarray:
        """Another hash of the phrases at the places."""
        by_word = self._second
        out = by_word[places]
        for i in range(1, length):
            out = joined_hash(out, by_word[places + i])
        return out

    @functools.cached_property
    def _second(self) -> np.ndarray:
        return self._hashes(1)

    def phrase(self, place: int, length: int) -> bytes:
        text = self.buffer[self.starts[place] : self.ends[place + length - 1]]
        return text if length == 1 else b" ".join(text.split())


def powers(kind: int, n: int) -> np.ndarray:
    factors = np.full(max(n, 1), BASES[kind], np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def positions(hashes: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(n_bits - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def proposed(bits: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter holds the phrases; without a filter all are proposed."""
    if bits is None:
        return np.ones(len(hashes), bool)
    held = np.ones(len(hashes), bool)
    for at in positions(hashes, len(bits) * 64):
        held &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0
    return held


def places_to_count(words: Words, max_words: int, bits, before):
    """(length, places, hashes) of the phrases among some words that are to be counted.

    A phrase is counted if all its parts are proposed by bits, but not if they all were by the filter
    before, when the phrase was counted already. before is None in the first pass. Shorter phrases in
    the words that are carried over were counted there.
    """
    hashes = words.hashes
    alive, counted = np.ones(len(words), bool), np.full(len(words), before is not None)
    for length in range(1, max_words + 1):
        own = np.flatnonzero(alive & ~counted)
        own = own[own > words.carried - length]
        yield length, own, hashes[own]
        if length == max_words or len(words) <= length:
            return
        # One word longer: two phrases of this length, of which the second begins a word later.
        alive = both(held_by(bits, hashes, alive)) & words.joined
        counted = both(held_by(before, hashes, counted)) & words.joined if before is not None else counted
        longer = np.zeros_like(hashes)
        longer[:-length] = joined_hash(hashes[:-length], words.hashes[length:])
        hashes = longer


def both(at: np.ndarray) -> np.ndarray:
    """Whether it holds here and at the next place."""
    return at & np.append(at[1:], False)


def held_by(bits: np.ndarray | None, hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Of the places, those whose phrase the filter holds."""
    held = places.copy()
    held[places] = proposed(bits, hashes[places])
    return held


def grouped_words(batch: pa.RecordBatch, overlap: int, limit: int) -> Iterator[Words]:
    """The words of a batch, group by group."""
    texts = batch.column("text").cast(pa.binary())
    rows = defaultdict(list)
    for row, group in enumerate(batch.column("lang").to_pylist()):
        rows[group].append(row)
    for group, own in rows.items():
        present = (texts[row].as_py() for row in own if texts[row].is_valid)
        for buffer, carried in buffers(present, overlap, limit):
            yield Words(group, buffer, carried)


HASH_ROWS = "bucket int, once binary, more binary, counts binary"


def hash_counts(
    docs: DataFrame, max_words: int, buckets: int, bits=None, before=None, chunk=CHUNK_BYTES
) -> DataFrame:
    """Columns HASH_ROWS: occurrences of phrases of docs(text, lang), by hash, added up in part.

    A row has hashes of one bucket, which is a range of them: those that came once, and those that came
    more often with their counts. bits and before are broadcast filters or None.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, old = bits and bits.value, before and before.value
        held, size = [], 0
        for batch in batches:
            for words in grouped_words(batch, max_words - 1, chunk):
                for _, _, hashes in places_to_count(words, max_words, now, old):
                    held.append(hashes)
                    size += len(hashes)
                if size > HELD_HASHES:
                    yield hash_rows(held, buckets)
                    held, size = [], 0
        if size:
            yield hash_rows(held, buckets)

    return docs.select("text", "lang").mapInArrow(count, HASH_ROWS)


def hash_rows(held: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    hashes = np.sort(np.concatenate(held))
    starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    counts, hashes = np.diff(starts, append=len(hashes)), hashes[starts]
    firsts = np.array([(2**64 * i) // buckets for i in range(1, buckets)], np.uint64)
    borders = np.searchsorted(hashes, firsts)
    rows = []
    for bucket, (own, n) in enumerate(zip(np.split(hashes, borders), np.split(counts, borders))):
        if len(own):
            more = n > 1
            rows.append((bucket, own[~more].tobytes(), own[more].tobytes(), n[more].tobytes()))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 3))]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "once", "more", "counts"])


NAMES = "lang string, phrase string, hash long, n long"


def names_of_hashes(docs: DataFrame, max_words: int, bits, before, wanted, chunk=CHUNK_BYTES) -> DataFrame:
    """Columns NAMES: the phrases behind hashes that the broadcast filter wanted holds, of those that
    hash_counts counts, once or more, with n 0.

    Phrases with the same hash are told apart by the second one, so all of them are given. The empty
    phrase has the number of words as n; it is given when there is no filter before.
    """

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, old = bits.value, before and before.value
        seen = np.empty(0, np.uint64), np.empty(0, np.uint64)
        for batch in batches:
            rows = []
            for words in grouped_words(batch, max_words - 1, chunk):
                for length, places, hashes in places_to_count(words, max_words, now, old):
                    if length == 1 and old is None:
                        rows.append((words.group, b"", 0, len(places)))
                    found = proposed(wanted.value, hashes)
                    places, hashes = places[found], hashes[found]
                    second = words.second_hashes(places, length)
                    new, seen = unseen(seen, hashes, second)
                    for place, h in zip(places[new].tolist(), hashes[new].view(np.int64).tolist()):
                        rows.append((words.group, words.phrase(place, length), h, 0))
                if len(rows) > NAMED_ROWS:
                    yield named_batch(rows)
                    rows = []
            yield named_batch(rows)

    return docs.select("text", "lang").mapInArrow(name, NAMES)


def unseen(seen, hashes: np.ndarray, second: np.ndarray):
    """(places of the pairs of hashes that were not seen before, all that are seen now).

    A hash that was seen with another second hash is new each time it comes.
    """
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    known, known_second = seen
    at = np.minimum(np.searchsorted(known, hashes[first]), max(len(known) - 1, 0))
    is_known = known[at] == hashes[first] if len(known) else np.zeros(len(first), bool)
    expected = second[first]
    if len(known):
        expected = np.where(is_known, known_second[at], expected)
    odd = np.flatnonzero(second != expected[inverse])
    new = first[~is_known]
    known, known_second = np.append(known, hashes[new]), np.append(known_second, second[new])
    order = np.argsort(known, kind="stable")
    return np.concatenate([new, odd]), (known[order], known_second[order])


def phrase_counts(docs: DataFrame, max_words: int, bits, before, wanted, chunk=CHUNK_BYTES) -> DataFrame:
    """Columns NAMES: occurrences of phrases, each looked at as a text, whose hash the filter wanted
    holds. For the few hashes, if any, that several phrases share."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, old = bits.value, before and before.value
        for batch in batches:
            held = Counter()
            for words in grouped_words(batch, max_words - 1, chunk):
                for length, places, hashes in places_to_count(words, max_words, now, old):
                    found = proposed(wanted.value, hashes)
                    for place, h in zip(places[found].tolist(), hashes[found].view(np.int64).tolist()):
                        held[words.group, words.phrase(place, length), h] += 1
            yield named_batch([(*key, n) for key, n in held.items()])

    return docs.select("text", "lang").mapInArrow(count, NAMES)


def named_batch(rows: list[tuple]) -> pa.RecordBatch:
    groups, phrases, hashes, counts = zip(*rows) if rows else ((), (), (), ())
    arrays = [
        pa.array(groups, pa.string()),
        pa.array(phrases, pa.binary()).cast(pa.string()),
        pa.array(hashes, pa.int64()),
        pa.array(counts, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["lang", "phrase", "hash", "n"])


# ---- the filter ------------------------------------------------------------------------------


def size_for(n_phrases: int, max_bits: int) -> int:
    """Bits of a filter, a power of two; bounded, so that it may be broadcast."""
    n_bits = MIN_BITS
    while n_bits < min(BITS_PER_PHRASE * n_phrases, max_bits):
        n_bits *= 2
    return n_bits


def with_hashes(bits: np.ndarray, hashes: DataFrame) -> np.ndarray:
    """The filter with hashes(hash) added; no more rows come than it has 64-bit words."""
    n_bits = len(bits) * 64
    places = [x.bitwiseAND(F.lit(n_bits - 1)) for x in (F.col("hash"), F.shiftrightunsigned("hash", 32))]
    at = hashes.select(F.explode(F.array(*places)).alias("at"))
    one = F.expr("shiftleft(1L, cast(at & 63 AS int))")
    words = at.groupBy(F.shiftright("at", 6).alias("at")).agg(F.bit_or(one).alias("mask"))
    found = words.toArrow()
    grown = bits.copy()
    grown[found.column("at").to_numpy()] |= found.column("mask").to_numpy().view(np.uint64)
    return grown


def filter_of(hashes: DataFrame, max_bits: int) -> np.ndarray:
    return with_hashes(np.zeros(size_for(hashes.count(), max_bits) // 64, np.uint64), hashes)


# ---- mining ----------------------------------------------------------------------------------


def grouped(docs: DataFrame, group: str = "lang") -> DataFrame:
    return docs.select("text", F.coalesce(F.col(group).cast("string"), F.lit(NO_GROUP)).alias("lang"))


def mine(
    docs: DataFrame,
    group: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    sample_one_in: int = SAMPLE_ONE_IN,
    max_bits: int = MAX_BITS,
    chunk: int = CHUNK_BYTES,
) -> DataFrame:
    """Columns lang, phrase, words, f: all phrases of up to max_words with min_count occurrences or more
    in docs(text, group), with their exact number; and for every group the empty phrase with that of
    all its words."""
    context = docs.sparkSession.sparkContext
    texts = grouped(docs, group)
    # Hashes are added up in buckets, more of them for more text, so that one fits in a task.
    n_bytes = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = 1 + n_bytes // BUCKET_BYTES
    # Texts are sampled by what they hold, so that a task that is run again takes the same ones.
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(sample_one_in)) == 0)
    lowered = max(1, int(LOWERED * min_count / sample_one_in))
    proposals = at_least(lowered, hash_counts(sample, max_words - 1, buckets, chunk=chunk), "phrases_proposed")
    bits, before, passes = filter_of(proposals, max_bits), None, []
    while True:
        sent = [f if f is None else context.broadcast(f) for f in (bits, before)]
        likely = at_least(min_count, hash_counts(texts, max_words, buckets, *sent, chunk=chunk), "phrases_likely")
        found = exact_counts(texts, likely, max_words, sent, min_count, max_bits, chunk)
        found = stage(found, f"phrases_pass{len(passes)}")
        passes.append(found.drop("hash"))
        grown = with_hashes(bits, found.where((F.col("words") > 0) & (F.col("words") < max_words)))
        for f in filter(None, sent):
            f.unpersist()
        if np.array_equal(grown, bits):
            return reduce(DataFrame.unionByName, passes)
        bits, before = grown, bits


def at_least(least: int, counted: DataFrame, label: str) -> DataFrame:
    """Columns hash, f: hashes whose phrases (usually one) come so often in all, staged."""

    def add_up(rows: pa.Table) -> pa.Table:
        once, more, counts = (
            np.concatenate([np.frombuffer(x, kind) for x in rows.column(name).to_pylist()])
            for name, kind in (("once", np.uint64), ("more", np.uint64), ("counts", np.int64))
        )
        hashes = np.concatenate([once, more])
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        totals = np.add.reduceat(np.concatenate([np.ones(len(once), np.int64), counts])[order], starts)
        often = totals >= least
        return pa.table({"hash": hashes[starts][often].view(np.int64), "f": totals[often]})

    return stage(counted.groupBy("bucket").applyInArrow(add_up, "hash long, f long"), label)


def exact_counts(texts, likely: DataFrame, max_words: int, sent: list, least: int, max_bits: int, chunk: int):
    """Columns lang, phrase, hash, f, words: the phrases behind the likely hashes, and all totals.

    A hash with one phrase has its count already. Those with several are counted once more, as texts.
    """
    context = texts.sparkSession.sparkContext
    wanted = context.broadcast(filter_of(likely, max_bits))
    named = names_of_hashes(texts, max_words, *sent, wanted, chunk=chunk)
    named = stage(named.groupBy("lang", "phrase", "hash").agg(F.sum("n").alias("n")), "phrases_named")
    wanted.unpersist()
    totals = named.where("phrase = ''").withColumnRenamed("n", "f")
    phrases = named.where("phrase <> ''").drop("n").join(likely, "hash")
    shared = phrases.groupBy("hash").count().where("count > 1").select("hash")
    shared = stage(shared, "hashes_shared")
    found = phrases.select("lang", "phrase", "hash", "f")
    if not shared.isEmpty():
        wanted = context.broadcast(filter_of(shared, max_bits))
        counted = phrase_counts(texts, max_words, *sent, wanted, chunk=chunk).join(shared, "hash", "left_semi")
        again = counted.groupBy("lang", "phrase", "hash").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        found = found.join(shared, "hash", "left_anti").unionByName(stage(again, "phrases_shared"))
        wanted.unpersist()
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return found.unionByName(totals).withColumn("words", words)


# ---- scoring ---------------------------------------------------------------------------------


def _key(phrase: Column) -> Column:
    """Phrase and group as one text; no phrase holds a tab."""
    return F.concat(phrase, F.lit("\t"), F.col("lang"))


def _part(start, length) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, length), " ")


def scored(frequent: DataFrame) -> DataFrame:
    """Candidates (phrases of two words or more) with a, l, r, score of their lowest-scoring cut.

    Counts are exact up to 10^15 and so is the arithmetic.
    """
    candidates = frequent.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    left = _key(_part(F.lit(1), F.col("k")))
    right = _key(_part(F.col("k") + 1, F.col("words") - F.col("k")))
    sides = stage(cuts.withColumns({"left": left, "right": right}), "phrase_cuts")
    counts = frequent.where("words > 0").select(_key(F.col("phrase")).alias("left"), F.col("f").alias("l"))
    # Common words begin or end a large share of all candidates.
    known = stage(lookup_join(sides, counts, "left"), "phrase_lefts")
    known = lookup_join(known, counts.withColumnsRenamed({"left": "right", "l": "r"}), "right")
    a, l, r = (f"cast({c} AS decimal(15,0))" for c in "alr")
    score = F.expr(f"cast((cast(1000000 AS decimal(7,0)) * {a} * {a}) div ({l} * {r}) AS bigint)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    found = known.groupBy("lang", "phrase", "words", "a").agg(lowest)
    return found.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def uncovered(candidates: DataFrame, percent: int = COVERED_PERCENT) -> DataFrame:
    """Candidates without those that lie in a longer one with that share of their occurrences."""
    longer = candidates.where("words > 2").select("lang", "phrase", "words", F.col("a").alias("longer"))
    lengths = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    starts = lengths.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inside = starts.select("lang", _part(F.col("start"), F.col("size")).alias("phrase"), "longer")
    covers = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    stays = F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))
    return candidates.join(covers, ["lang", "phrase"], "left").where(stays).drop("longer")


def collocations(frequent: DataFrame, top: int = TOP) -> DataFrame:
    """The best candidates of every group: lang, rank, phrase, a, l, r, n, score."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = uncovered(stage(scored(frequent), "phrase_scores")).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    )
    totals = frequent.where("words = 0").select("lang", F.col("f").alias("n"))
    best = ranked.where(F.col("rank") <= top).join(totals, "lang")
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def digests(docs: DataFrame) -> DataFrame:
    """The rows of op11 from docs(text, lang)."""
    return collocations(mine(docs))
