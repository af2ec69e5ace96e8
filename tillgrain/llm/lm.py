"""LM scoring with an Elias-Fano bigram trie that Spark deals out over shards.

Model: p1(w) = (c(w) + 1) / (N + V + 1) over the training tokens, and for a word w after u

    p(w | u) = (c(u, w) + MU * p1(w)) / (c(u) + MU),

a smoothing whose probabilities add up to one and which needs no sums over a context: an n-gram can be
looked up wherever its hash sends it, so a frequent word before many others is spread over all shards.
A bigram that was not learned backs off to p1(w) * MU / (c(u) + MU). The end of a text is a token, and
also the context of the first word.

1. Texts become batches of about BATCH_TOKENS tokens: word hashes and a code for every token. They are
   stored, so a lost task repeats the same batches.
2. Word level: every batch sends its distinct words to the shards by ranges of the word's hash. A shard
   numbers its words by falling count and builds its part of the level: hashes as an Elias-Fano
   sequence, and for every word its number and its quantised count, from which p1 and the back-off
   weight follow. The batches' words are looked up there. The parts are stored with the answers, which
   are number, quantised count and the count itself: the base score is exact.
3. Bigram level: every batch sends its distinct bigrams with their counts, which documents have them how
   often, and what the word level said of their words. A shard builds its part of the trie from all
   training counts and the word level: the contexts and the pointers to their successors are monotone
   and stored as Elias-Fano sequences, probabilities as quantised logarithms. Every bigram of the
   batches is then looked up: the context, and within its pointers the successor. What is not there
   backs off to the word level. The answer is a sum of logarithms per document of the batch.
4. Sums meet per batch.

A part of a level is written to a file of its task and mapped. It is searched in the file, by selecting
in the high bits and by halving on the low bits: no sequence is unpacked.

What is sent are compressed arrays, not a row for each token. Shards grow in number with the corpus,
not in size; no table of the corpus is broadcast or brought to the driver.

Words are known by their 64-bit hash. Levels can be saved: trie_levels() and word_levels() give them as
byte strings that Level.load() and Words.load() map without copying.

Defined results: null and empty texts are one end token; without training rows every token has
p1 = 1 / 1 and score 0 for c = N = V = 0; repeated rows count and are scored as often as they are
there; rows with null doc_id train (nothing holds them out) and are scored; only doc_id and text are
read.
"""

import mmap
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.common import by_crc, byte_texts
from tillgrain.session import stage

MU = 2.0
STEP = 0.004  # no log10 probability is wrong by more than half of it
WORD_STEP = STEP / 8  # of the word level's log10(count + 1), once for the word and once for its context
PAIR_STEP = STEP / 2  # of the bigram level's log10 probabilities
BATCH_TOKENS = 1_000_000  # with SHARD_TOKENS, what bounds the memory of a task
SHARD_TOKENS = 1_000_000
HELD_OUT = (7, 2)
END = np.uint64(xxhash.xxh64_intdigest(b"\n", 1))  # no word holds a line break
MIX = np.uint64(0x9E3779B97F4A7C15)


# --- arrays as bytes ----------------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Non-negative numbers as compressed bytes in the smallest type that holds them."""
    kind = np.min_scalar_type(int(values.max())) if len(values) else np.dtype(np.uint8)
    planes = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(-1, kind.itemsize).T
    data = pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)
    return kind.itemsize.to_bytes(1) + len(values).to_bytes(8) + data


def unpacked(data: bytes) -> np.ndarray:
    size, n = data[0], int.from_bytes(data[1:9])
    if not n:
        return np.empty(0, np.uint64)
    raw = pa.decompress(data[9:], decompressed_size=size * n, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(f"u{size}").ravel().astype(np.uint64)


def packed_sorted(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=np.uint64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def packed_codes(codes: np.ndarray) -> bytes:
    """Codes of 16 bits of which neighbours are alike: their differences."""
    return packed(np.diff(codes, prepend=np.uint16(0)))


def unpacked_codes(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64).astype(np.uint16)


# --- trie levels --------------------------------------------------------------------------------


def set_bit(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit with this rank in each word of 64 bits."""
    words, rank, place = words.copy(), rank.astype(np.int64), np.zeros(len(words), np.int64)
    for half in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(words & np.uint64((1 << half) - 1)).astype(np.int64)
        up = rank >= below
        rank -= below * up
        place += half * up
        words >>= (half * up).astype(np.uint64)
    return place


def or_into(out: np.ndarray, at: np.ndarray, bits: np.ndarray) -> None:
    """Or bits into out at places that do not fall."""
    if len(at):
        first = np.flatnonzero(np.diff(at, prepend=-1))
        out[at[first]] |= np.bitwise_or.reduceat(bits, first)


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary, searched as it is stored.

    ranks are the ones and the zeros before each 64 of the high bits.
    """

    def __init__(self, n: int, width: int, last: int, low: np.ndarray, high: np.ndarray, ranks: np.ndarray):
        self.n, self.width, self.last = n, width, last
        self.low, self.high, self.ranks = low, high, ranks

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        n = len(values)
        top = int(values[-1]) if n else 0
        width = min(56, max(0, (top // max(n, 1)).bit_length() - 1))
        last = top >> width
        low = np.zeros(n * width // 64 + 2, np.uint64)
        start = np.arange(n, dtype=np.int64) * width
        word, shift = start >> 6, (start & 63).astype(np.uint64)
        bits = values & np.uint64((1 << width) - 1)
        or_into(low, word, bits << shift)
        over = (start & 63) + width > 64
        low[word[over] + 1] |= bits[over] >> (np.uint64(64) - shift[over])
        high = np.zeros((n + last) // 64 + 1, np.uint64)
        place = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        or_into(high, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        ones = np.cumsum(np.bitwise_count(high), dtype=np.int64) - np.bitwise_count(high)
        ranks = np.stack([ones, np.arange(len(high)) * 64 - ones]).astype(np.uint32)
        return cls(n, width, last, low, high, ranks)

    def select(self, bit: int, rank: np.ndarray) -> np.ndarray:
        """Places of the ones or zeros with these ranks in the high bits."""
        before = self.ranks[1 - bit]
        word = np.searchsorted(before, rank.astype(np.uint32), "right") - 1
        bits = self.high[word] if bit else ~self.high[word]
        return word * 64 + set_bit(bits, rank - before[word])

    def low_bits(self, at: np.ndarray) -> np.ndarray:
        start = at.astype(np.int64) * self.width
        word, shift = start >> 6, (start & 63).astype(np.uint64)
        bits = self.low[word] >> shift | (self.low[word + 1] << np.uint64(1)) << (np.uint64(63) - shift)
        return bits & np.uint64((1 << self.width) - 1)

    def get(self, at: np.ndarray) -> np.ndarray:
        high = (self.select(1, at) - at).astype(np.uint64)
        return high << np.uint64(self.width) | self.low_bits(at)

    def below(self, high: np.ndarray) -> np.ndarray:
        """How many elements have smaller high bits."""
        zero = np.maximum(high, 1) - 1
        return np.where(high > 0, self.select(0, zero) - zero, 0)

    def find(self, values: np.ndarray, start=0, end=None) -> tuple[np.ndarray, np.ndarray]:
        """Places of values between start and end, and whether they are there."""
        high = np.minimum(values >> np.uint64(self.width), np.uint64(self.last + 1)).astype(np.int64)
        sought = values & np.uint64((1 << self.width) - 1)
        at = np.maximum(self.below(high), start)
        to = np.minimum(self.below(np.minimum(high + 1, self.last + 1)), self.n if end is None else end)
        stop, open_ = to.copy(), np.flatnonzero(at < to)
        while len(open_):
            middle = (at[open_] + to[open_]) >> 1
            less = self.low_bits(middle) < sought[open_]
            at[open_[less]] = middle[less] + 1
            to[open_[~less]] = middle[~less]
            open_ = open_[at[open_] < to[open_]]
        found = at < stop
        found[found] = self.low_bits(at[found]) == sought[found]
        return at, found

    def values(self) -> np.ndarray:
        return self.get(np.arange(self.n))

    def save(self) -> bytes:
        head = np.array([self.n, self.width, self.last, len(self.low), len(self.high)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.low, self.high, self.ranks))

    @classmethod
    def load(cls, data: memoryview) -> tuple["EliasFano", memoryview]:
        n, width, last, low, high = np.frombuffer(data, np.int64, 5).tolist()
        words = np.frombuffer(data, np.uint64, low + 2 * high, 40)  # ranks take as much as the high bits
        ranks = words[low + high :].view(np.uint32).reshape(2, high)
        return cls(n, width, last, words[:low], words[low : low + high], ranks), data[40 + 8 * len(words) :]


def mapped(data: bytes) -> memoryview:
    """The bytes in a file of this task, which ends with the last view of it."""
    with tempfile.TemporaryFile() as file:
        file.write(data)
        file.flush()
        return memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))


class Words:
    """Words of one shard by hash, with their numbers and quantised counts."""

    def __init__(self, least: int, hashes: EliasFano, numbers: np.ndarray, codes: np.ndarray):
        self.least, self.hashes, self.numbers, self.codes = np.uint64(least), hashes, numbers, codes

    @classmethod
    def of(cls, hashes: np.ndarray, numbers: np.ndarray, counts: np.ndarray) -> "Words":
        """From sorted hashes; the sequence begins at the first one."""
        least = hashes[0] if len(hashes) else np.uint64(0)
        codes = np.round(np.log10(counts + 1.0) / WORD_STEP).astype(np.uint16)
        return cls(least, EliasFano.of(hashes - least), numbers.astype(np.uint32), codes)

    def look(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and codes of words that are there."""
        at, found = self.hashes.find(hashes - self.least)
        if not found.all():
            raise KeyError("a word that is in no batch")
        return self.numbers[at].astype(np.uint64), self.codes[at]

    def save(self) -> bytes:
        head = np.array([self.least], np.uint64).tobytes()
        return head + self.hashes.save() + self.numbers.tobytes() + self.codes.tobytes()

    @classmethod
    def load(cls, data) -> "Words":
        data = memoryview(data)
        hashes, rest = EliasFano.load(data[8:])
        numbers = np.frombuffer(rest[: 4 * hashes.n], np.uint32)
        return cls(np.frombuffer(data[:8], np.uint64)[0], hashes, numbers, np.frombuffer(rest[4 * hashes.n :], np.uint16))


class Level:
    """Bigrams of one shard: contexts, pointers to their successors, words, quantised log10 p.

    Words are made monotone by adding span for each context before their own.
    """

    def __init__(self, span: int, contexts: EliasFano, pointers: EliasFano, words: EliasFano, codes: np.ndarray):
        self.span, self.contexts, self.pointers = np.uint64(span), contexts, pointers
        self.words, self.codes = words, codes

    @classmethod
    def of(cls, keys: np.ndarray, log_p: np.ndarray) -> "Level":
        """From sorted keys, context in the upper and word in the lower half."""
        contexts, first = np.unique(keys >> np.uint64(32), return_index=True)
        pointers = np.append(first, len(keys)).astype(np.uint64)
        words = keys & np.uint64(0xFFFFFFFF)
        span = words.max(initial=np.uint64(0)) + np.uint64(1)
        place = np.repeat(np.arange(len(contexts), dtype=np.uint64), np.diff(pointers).astype(np.int64))
        codes = np.minimum(np.round(-log_p / PAIR_STEP), 65_535).astype(np.uint16)
        return cls(span, EliasFano.of(contexts), EliasFano.of(pointers), EliasFano.of(words + place * span), codes)

    def reader(self):
        """A function from keys to log10 p, nan for those without training count."""

        def look(keys: np.ndarray) -> np.ndarray:
            out = np.full(len(keys), np.nan)
            context, word = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
            first = np.append(True, context[1:] != context[:-1])[: len(keys)]
            at, found = self.contexts.find(context[first])
            at = np.where(found, at, 0)
            low, high = (self.pointers.get(at + i).astype(np.int64) for i in (0, 1)) if self.contexts.n else (at, at)
            run = np.cumsum(first) - 1
            open_ = np.flatnonzero(found[run] & (word < self.span))
            run = run[open_]
            sought = word[open_] + at[run].astype(np.uint64) * self.span
            place, there = self.words.find(sought, low[run], high[run])  # within the pointers of the context
            out[open_[there]] = self.codes[place[there]] * -PAIR_STEP
            return out

        return look

    def save(self) -> bytes:
        head = np.array([self.span], np.uint64).tobytes()
        parts = b"".join(x.save() for x in (self.contexts, self.pointers, self.words))
        return head + parts + self.codes.tobytes()

    @classmethod
    def load(cls, data) -> "Level":
        data, parts = memoryview(data), []
        span, data = np.frombuffer(data[:8], np.uint64)[0], data[8:]
        for _ in range(3):
            part, data = EliasFano.load(data)
            parts.append(part)
        return cls(span, *parts, np.frombuffer(data, np.uint16))


# --- batches ------------------------------------------------------------------------------------


def token_batches(docs: DataFrame) -> DataFrame:
    """Batches of docs(doc_id, text, train): ids, flags, lengths, word hashes and token codes."""
    schema = "batch long, tokens long, ids array<long>, train binary, sizes binary, words binary, codes binary"

    def run(rows):
        partition, serial = TaskContext.get().partitionId(), 0
        known: dict[bytes, int] = {}
        ids, train, sizes, codes = [], [], [], []

        def close():
            nonlocal serial, ids, train, sizes, codes, known
            hashed = xxhash.xxh64_intdigest
            hashes = np.fromiter((hashed(w) for w in known), np.uint64, len(known))
            hashes = np.append(hashes, END)
            order = np.argsort(hashes)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            # An end token follows every text; its code is the last one before ordering.
            flat = np.full(sum(sizes), len(known), np.int64)
            at = 0
            for own in codes:
                flat[at : at + len(own)] = own
                at += len(own) + 1
            row = [
                pa.array([(partition << 32) + serial]),
                pa.array([sum(sizes)]),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([packed(np.array(train, np.uint8))]),
                pa.array([packed(np.array(sizes, np.uint64))]),
                pa.array([packed_sorted(hashes[order])]),
                pa.array([packed(place[flat].astype(np.uint64))]),
            ]
            serial += 1
            known, ids, train, sizes, codes = {}, [], [], [], []
            return pa.RecordBatch.from_arrays(
                row, names=["batch", "tokens", "ids", "train", "sizes", "words", "codes"]
            )

        total = 0
        for batch in rows:
            columns = batch.column(0).to_pylist(), byte_texts(batch.column(1)), batch.column(2).to_pylist()
            for doc, text, learns in zip(*columns):
                words = text.lower().split() if text else []
                code = known.setdefault
                codes.append(np.array([code(w, len(known)) for w in words], np.int32))
                ids.append(doc)
                train.append(learns)
                sizes.append(len(words) + 1)
                total += len(words) + 1
                if total >= BATCH_TOKENS:
                    total = 0
                    yield close()
        if ids:
            yield close()

    return docs.select("doc_id", F.col("text").cast("string"), "train").mapInArrow(run, schema)


def in_shards(shard_of: np.ndarray, shards: int):
    """(shard, slice) of neighbouring elements; shard numbers do not fall."""
    edges = np.searchsorted(shard_of, np.arange(shards + 1))
    return [(s, slice(edges[s], edges[s + 1])) for s in range(shards) if edges[s] < edges[s + 1]]


def unigrams(batches: DataFrame, shards: int) -> DataFrame:
    """Answers batch, shard, numbers, codes, counts of each batch's words; of each shard n, v and the word level."""

    def send(rows):
        for batch in rows:
            for row in batch.to_pylist():
                words, codes = unpacked_sorted(row["words"]), unpacked(row["codes"]).astype(np.int64)
                learns = np.repeat(unpacked(row["train"]), unpacked(row["sizes"]).astype(np.int64))
                counts = np.bincount(codes, weights=learns, minlength=len(words)).astype(np.uint64)
                found = in_shards(range_shard(words, shards), shards)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([s for s, _ in found], pa.int32()),
                        pa.array([row["batch"]] * len(found), pa.int64()),
                        pa.array([packed_sorted(words[part]) for _, part in found], pa.binary()),
                        pa.array([packed(counts[part]) for _, part in found], pa.binary()),
                    ],
                    names=["shard", "batch", "words", "counts"],
                )

    def answer(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        words = [unpacked_sorted(x) for x in table.column("words").to_pylist()]
        counts = np.concatenate([unpacked(x) for x in table.column("counts").to_pylist()])
        ends = np.cumsum([len(w) for w in words])[:-1]
        words = np.concatenate(words)
        distinct, inverse = np.unique(words, return_inverse=True)
        total = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.uint64)
        order = np.lexsort((distinct, -total.astype(np.int64)))
        number = np.empty(len(order), np.uint64)
        number[order] = np.arange(len(order), dtype=np.uint64) * np.uint64(shards) + np.uint64(shard)
        if len(order) * shards >= 1 << 32:
            raise ValueError("more than 2**32 distinct words")
        saved = Words.of(distinct, number, total).save()
        numbers, codes = Words.load(mapped(saved)).look(words)
        parts = range(table.num_rows)
        return pa.table(
            {
                "batch": table.column("batch"),
                "shard": table.column("shard"),
                "numbers": pa.array([packed(x) for x in np.split(numbers, ends)], pa.binary()),
                "codes": pa.array([packed(x) for x in np.split(codes, ends)], pa.binary()),
                "counts": pa.array([packed(x) for x in np.split(total[inverse], ends)], pa.binary()),
                "n": pa.array([0 if i else int(total.sum()) for i in parts], pa.int64()),
                "v": pa.array([0 if i else int((total > 0).sum()) for i in parts], pa.int64()),
                "level": pa.array([None if i else saved for i in parts], pa.binary()),
            }
        )

    sent = batches.mapInArrow(send, "shard int, batch long, words binary, counts binary")
    schema = "batch long, shard int, numbers binary, codes binary, counts binary, n long, v long, level binary"
    return sent.groupBy("shard").applyInArrow(answer, schema)


def range_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of sorted hashes, by ranges."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def bigrams(batches: DataFrame, answers: DataFrame, shards: int, n: int, v: int) -> DataFrame:
    """Rows for the shards: bigrams of each batch, counts and documents; and the batch's own row.

    contexts and lower are the word level's codes of the distinct contexts and words of a row, by number.
    """
    schema = (
        "shard int, batch long, keys binary, counts binary, contexts binary, lower binary, "
        "times binary, places binary, ids array<long>, sizes binary, known binary, base binary, train binary"
    )
    kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 6 + [pa.list_(pa.int64())] + [pa.binary()] * 4
    names = [x.split()[0] for x in schema.split(", ")]

    def send(rows):
        for batch in rows:
            for row in batch.to_pylist():
                parts = sorted(row["answers"], key=lambda a: a["shard"])
                number = np.concatenate([unpacked(a["numbers"]) for a in parts])
                count = np.concatenate([unpacked(a["counts"]) for a in parts])
                level = np.concatenate([unpacked(a["codes"]) for a in parts]).astype(np.uint16)
                codes = unpacked(row["codes"]).astype(np.int32)
                sizes = unpacked(row["sizes"]).astype(np.int64)
                starts = np.cumsum(sizes) - sizes
                base = np.log10((count + 1.0) / (n + v + 1.0))
                doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
                before = np.append(codes[-1], codes[:-1])
                before[starts] = codes[-1]  # the last token of a batch is an end
                keys = number[before] << np.uint64(32) | number[codes]
                mixed = range_shard_of(keys, shards)
                order = np.lexsort((keys, mixed))
                keys, mixed, doc_of = keys[order], mixed[order], doc[order]
                first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                times = np.diff(np.append(first, len(keys)))
                learns = unpacked(row["train"]).astype(np.int64)[doc_of]
                counts = np.add.reduceat(learns, first)
                token = order[first]
                found = in_shards(mixed[first], shards)
                bounds = np.append(first, len(keys))
                columns = [[], [], [], [], [], [], [], []]
                for s, part in found:
                    own, (context, word) = token[part], halves(keys[first[part]])
                    by_context, by_word = (np.unique(x, return_index=True)[1] for x in (context, word))
                    values = (
                        s,
                        row["batch"],
                        packed_sorted(keys[first[part]]),
                        packed(counts[part]),
                        packed_codes(level[before[own[by_context]]]),
                        packed_codes(level[codes[own[by_word]]]),
                        packed(times[part] - 1),
                        packed(doc_of[bounds[part.start] : bounds[part.stop]]),
                    )
                    for column, value in zip(columns, values):
                        column.append(value)
                m = len(found)
                known = np.add.reduceat((count[codes] > 0).astype(np.int64), starts)
                whole = np.add.reduceat(base[codes], starts)
                rest = [row["ids"]], [row["sizes"]], [packed(known)], [whole.tobytes()], [row["train"]]
                columns += [x + [None] * (m - 1) for x in rest]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names
                )

    gathered = answers.groupBy("batch").agg(
        F.collect_list(F.struct("shard", "numbers", "codes", "counts")).alias("answers")
    )
    joined = batches.select("batch", "ids", "train", "sizes", "codes").join(gathered, "batch")
    return joined.mapInArrow(send, schema)


def range_shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    mixed = keys * MIX
    return range_shard(mixed ^ (mixed >> np.uint64(29)), shards)


def halves(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)


def log_p(counts: np.ndarray, contexts: np.ndarray, lower: np.ndarray, n: int, v: int) -> np.ndarray:
    """log10 p of bigrams from their counts and the codes of their contexts and words."""
    context, word = (10.0 ** (codes * WORD_STEP) for codes in (contexts, lower))  # counts + 1
    return np.log10((counts + MU * word / (n + v + 1.0)) / (context - 1.0 + MU))


def shard_level(table: pa.Table, n: int, v: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The saved trie level of one shard; its bigrams, their back-off, and the place there of every row's."""
    keys, contexts, lower = [], [], []
    for column in zip(*(table.column(name).to_pylist() for name in ("keys", "contexts", "lower"))):
        keys.append(unpacked_sorted(column[0]))
        for half, codes, out in zip(halves(keys[-1]), column[1:], (contexts, lower)):
            out.append(unpacked_codes(codes)[np.unique(half, return_inverse=True)[1]])
    counts = np.concatenate([unpacked(x) for x in table.column("counts").to_pylist()])
    distinct, at, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    total = np.bincount(inverse, weights=counts, minlength=len(distinct))
    codes = np.concatenate(contexts)[at], np.concatenate(lower)[at]
    learned = total > 0
    level = Level.of(distinct[learned], log_p(total, *codes, n, v)[learned])
    return level.save(), distinct, log_p(np.zeros(len(distinct)), *codes, n, v), inverse


def batch_sums(n: int, v: int):
    """Of one shard's bigrams: for each batch, the sum of log10 p for each of its documents."""

    def answer(table: pa.Table) -> pa.Table:
        saved, keys, backed_off, inverse = shard_level(table, n, v)
        p = Level.load(mapped(saved)).reader()(keys)
        p = np.where(np.isnan(p), backed_off, p)
        owners, sums, at = [], [], 0
        for often, docs in zip(table.column("times").to_pylist(), table.column("places").to_pylist()):
            often = unpacked(often).astype(np.int64) + 1
            docs = unpacked(docs).astype(np.int64)
            own, place = np.unique(docs, return_inverse=True)
            of_row = p[inverse[at : at + len(often)]]
            at += len(often)
            got = np.bincount(place, weights=np.repeat(of_row, often), minlength=len(own))
            sums.append(got.tobytes())
            owners.append(packed_sorted(own.astype(np.uint64)))
        rest = {c: table.column(c) for c in ("batch", "ids", "sizes", "known", "base", "train")}
        binary = {"docs": pa.array(owners, pa.binary()), "sums": pa.array(sums, pa.binary())}
        return pa.table({**rest, **binary})

    return answer


def per_document(table: pa.Table) -> pa.Table:
    """Documents of one batch from its own row and the sums of all shards."""
    rows = table.to_pylist()
    own = next(r for r in rows if r["ids"] is not None)
    sizes, score = unpacked(own["sizes"]).astype(np.int64), np.zeros(len(own["ids"]))
    for r in rows:
        score[unpacked_sorted(r["docs"]).astype(np.int64)] += np.frombuffer(r["sums"], np.float64)
    return pa.table(
        {
            "doc_id": pa.array(own["ids"], pa.int64()),
            "train": pa.array(unpacked(own["train"]).astype(bool)),
            "n_tokens": pa.array(sizes),
            "n_known": pa.array(unpacked(own["known"]).astype(np.int64)),
            "base_score": pa.array(np.frombuffer(own["base"], np.float64)),
            "score": pa.array(score),
        }
    )


def score(docs: DataFrame) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score of docs(doc_id, text, train)."""
    batches = stage(token_batches(docs), "lm-batches")
    tokens = batches.agg(F.sum("tokens")).first()[0] or 0
    shards = max(1, -(-tokens // SHARD_TOKENS))
    answers = stage(unigrams(batches, shards), "lm-unigrams")
    n, v = answers.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    sent = bigrams(batches, answers, shards, n, v)
    schema = (
        "batch long, ids array<long>, sizes binary, known binary, base binary, train binary, docs binary, sums binary"
    )
    sums = sent.groupBy("shard").applyInArrow(batch_sums(n, v), schema)
    schema = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"
    scored = sums.groupBy("batch").applyInArrow(per_document, schema)
    return scored.withColumn("train_tokens", F.lit(n).cast("long"))


def trie_levels(docs: DataFrame) -> DataFrame:
    """shard and level, the saved bigram level of every shard, learned from docs(doc_id, text, train)."""
    batches = stage(token_batches(docs.where("train")), "lm-batches")
    tokens = batches.agg(F.sum("tokens")).first()[0] or 0
    shards = max(1, -(-tokens // SHARD_TOKENS))
    answers = stage(unigrams(batches, shards), "lm-unigrams")
    n, v = answers.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()

    def build(table: pa.Table) -> pa.Table:
        level = shard_level(table, n, v)[0]
        return pa.table({"shard": table.column("shard")[:1], "level": pa.array([level])})

    sent = bigrams(batches, answers, shards, n, v)
    return sent.groupBy("shard").applyInArrow(build, "shard int, level binary")


def word_levels(docs: DataFrame) -> DataFrame:
    """shard and level, the saved word level of every shard, learned from docs(doc_id, text, train)."""
    batches = stage(token_batches(docs.where("train")), "lm-batches")
    tokens = batches.agg(F.sum("tokens")).first()[0] or 0
    answers = unigrams(batches, max(1, -(-tokens // SHARD_TOKENS)))
    return answers.where("level IS NOT NULL").select("shard", "level")


def digests(docs: DataFrame) -> DataFrame:
    """Scores of docs(doc_id, text), learned from the rows that the CRC of their id does not hold out."""
    divisor, rest = HELD_OUT
    held = F.coalesce(by_crc(F.col("doc_id"), divisor) == rest, F.lit(False))
    scored = score(docs.select("doc_id", "text", (~held).alias("train")))
    return scored.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )
