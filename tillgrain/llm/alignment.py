"""Two tokenizers side by side: where their tokens end together, and which tokens overlap.

A text is encoded by both. Byte offsets at which a token of A and a token of B end cut the two lists
into groups; a token of A and one of B that share bytes are a link, and the count of a pair of ids is
the number of documents that have it as a link.

A first pass over the documents gives their distinct pairs, added up in every task. A minimal perfect
hash of all distinct pairs turns the counts into dense vectors, which are summed in a tree of groups of
FAN_IN; the pairs are kept in the order of the hash and compared at each look-up. A second pass aligns
the documents again and looks their links up.

Pairs are dealt into buckets by their A id, so that a bucket has all partners of an id and knows the
highest count among them. What is broadcast is a section of at most SECTION_PAIRS pairs (about 18 bytes
each) or one bucket; with more pairs than that the second pass is made once for each section.

Both encoders work on units: a blank with what follows it up to the next blank that stands behind
another character. No token of either crosses from one unit to the next, which is checked from the
vocabularies, so a unit is encoded and aligned once in a task however often it comes. Where it does not
hold, and for texts with units that do not come back byte for byte, the whole text is the unit.

Defined results: texts that are null or empty, or whose bytes one of the tokenizers does not give back,
have no tokens, zeros, and an empty digest; memory for a text is linear in its length; repeated rows
count each; an empty table gives no rows; an output column replaces an input column of its name, other
columns are kept.
"""

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrain.llm.bpe import byte_symbols
from tillgrain.llm.common import append_columns
from tillgrain.llm.perfect import PerfectHash, mixed
from tillgrain.session import stage

BUCKETS = 64
SECTION_PAIRS = 4_000_000
FAN_IN = 32
HELD_PAIRS = 2_000_000  # a task hands on its counts when it has so many pairs
REMEMBERED = 500_000  # units that a task keeps aligned; beyond it starts anew, results are the same
CHUNK_CHARS = 2_000_000  # texts are taken together up to about so many characters
JOINED_CHARS = 200_000  # units are encoded together up to so many
MARKS = 32_000_000  # most marks of documents by pairs; beyond it the pairs of documents are sorted

# The split of byte-level BPE tokenizers into pre-tokens.
USUAL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARK = "▁"  # stands for a blank in the pieces of B
UNIT_BORDER = re.compile(rf"(?<=[^\s{MARK}])(?= )")
NO_BORDER = re.compile(rf"[\s{MARK}] ")
PAIR_BITS = 32  # a pair is A id << PAIR_BITS | B id

COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
DIGESTS = T.StructType(
    [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField("groups_sha256", T.StringType())]
)
TOKEN_GROUPS = "array<struct<a: array<int>, b: array<int>>>"


# ---- the tokenizers --------------------------------------------------------------------------


class ByteBpe:
    """A byte-level BPE file whose ids are the ranks of its merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec["pre_tokenizer"]
        if pre["type"] != "ByteLevel" or not pre["use_regex"] or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path}: not a plain byte-level tokenizer")
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        special = {x["content"] for x in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        if [vocab[m] for m in made] != sorted(vocab[m] for m in made):
            raise ValueError(f"{path}: ids are not in the order of the merges")
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        ranks = {token: i for i, token in self.bytes_of.items()}
        # Without special tokens: their strings in a text are plain text.
        coding = tiktoken.Encoding("byte_bpe", pat_str=USUAL_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.encode = coding.encode_ordinary
        self.divisible = True


class PieceBpe:
    """A sentencepiece model that puts a blank before the text."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes_of = {
            i: bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        }
        self._encode, self._blank = model.encode, model.piece_to_id(MARK)
        self.divisible = not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)

    def encode(self, text: str) -> list[int]:
        """Of a text that begins with the blank that the model adds, to a text that is not empty."""
        return self._encode(text[1:]) if text != " " else [self._blank]


def lengths_of(tokenizer) -> np.ndarray:
    lengths = np.zeros(max(tokenizer.bytes_of) + 1, np.int64)
    for i, token in tokenizer.bytes_of.items():
        lengths[i] = len(token)
    return lengths


@dataclass
class Aligned:
    """What some units hold: sums a unit (n_a, n_b, n_groups, n_links), all links, groups as text."""

    sums: np.ndarray
    links: np.ndarray
    groups: list[str]


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteBpe(a_path), PieceBpe(b_path)
        self.divisible = self.a.divisible and self.b.divisible
        self.a_lengths, self.b_lengths = lengths_of(self.a), lengths_of(self.b)
        # Ids as text, followed by what comes after them: within a group, or at the end of its side.
        self.a_texts = [np.array([f"{i}{end}" for i in range(len(self.a_lengths))], object) for end in ",|"]
        self.b_texts = [np.array([f"{i}{end}" for i in range(len(self.b_lengths))], object) for end in ",;"]

    def units(self, text: str) -> list[str]:
        if not self.divisible:
            return [" " + text]
        if text[0] == " " or NO_BORDER.search(text):
            return UNIT_BORDER.split(" " + text)
        return [" " + word for word in text.split(" ")]

    def tokens(self, unit: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids by A and by B, None where they do not give the unit back."""
        a, b, data = self.a.encode(unit), self.b.encode(unit), unit.encode()
        if b"".join(map(self.a.bytes_of.get, a)) != data or b"".join(map(self.b.bytes_of.get, b)) != data:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def align(self, units: list[str], with_groups: bool) -> list[Aligned | None]:
        """Parts of units, in their order; None stands for a unit that is not given back."""
        out, joined, size = [], [], 0
        for unit in units:
            # Behind an open end the next unit might be encoded otherwise.
            alone = unit[-1].isspace() or unit[-1] == MARK or not self.divisible
            if joined and (alone or size > JOINED_CHARS):
                out += self._joined(joined, with_groups)
                joined, size = [], 0
            if alone:
                out += self._joined([unit], with_groups)
            else:
                joined.append(unit)
                size += len(unit)
        return out + (self._joined(joined, with_groups) if joined else [])

    def _joined(self, units: list[str], with_groups: bool) -> list[Aligned | None]:
        found = self.tokens("".join(units))
        if found is not None:
            return [self._aligned(units, *found, with_groups)]
        if len(units) == 1:
            return [None]
        half = len(units) // 2
        return self._joined(units[:half], with_groups) + self._joined(units[half:], with_groups)

    def _aligned(self, units: list[str], a: np.ndarray, b: np.ndarray, with_groups: bool) -> Aligned:
        a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        unit_ends = np.cumsum([len(u.encode()) for u in units])
        # Bytes that are cut by no end of a token belong to one token of A and one of B: a link.
        ends = np.sort(np.concatenate([a_ends, b_ends]))
        is_common = ends[1:] == ends[:-1]
        group_ends, link_ends = ends[1:][is_common], ends[np.append(~is_common, True)]
        if not (group_ends[np.searchsorted(group_ends, unit_ends)] == unit_ends).all():
            raise ValueError("a token crosses the border of a unit")
        links = a[np.searchsorted(a_ends, link_ends)] << PAIR_BITS | b[np.searchsorted(b_ends, link_ends)]
        cuts = np.array([np.searchsorted(e, unit_ends, "right") for e in (a_ends, b_ends, group_ends, link_ends)])
        sums = np.diff(cuts, prepend=0, axis=1).T
        if not with_groups:
            return Aligned(sums, links, [])
        # Place of each id in the text of all groups: behind all groups before its own, A before B.
        a_upto = np.searchsorted(a_ends, group_ends, "right")
        b_upto = np.concatenate([[0], np.searchsorted(b_ends, group_ends, "right")])
        texts = np.empty(len(a) + len(b), object)
        group_of_a, group_of_b = np.searchsorted(group_ends, a_ends), np.searchsorted(group_ends, b_ends)
        a_last, b_last = group_ends[group_of_a] == a_ends, group_ends[group_of_b] == b_ends
        a_place = np.arange(len(a)) + b_upto[group_of_a]
        b_place = np.arange(len(b)) + a_upto[group_of_b]
        for place, ids, last, made in ((a_place, a, a_last, self.a_texts), (b_place, b, b_last, self.b_texts)):
            texts[place] = np.where(last, made[1][ids], made[0][ids])
        borders = np.concatenate([[0], cuts[0] + cuts[1]])
        groups = ["".join(texts[s:e])[:-1] for s, e in zip(borders, borders[1:])]
        return Aligned(sums, links, groups)


@functools.lru_cache(maxsize=2)
def aligner_of(a_path: str, b_path: str) -> Aligner:
    """One aligner for all tasks of a Python worker."""
    return Aligner(a_path, b_path)


class Memory:
    """Units of a task by number, and the pairs of their links by number.

    A unit that is not given back has the number BAD. Groups are kept as text where they are wanted,
    and sums of looked-up counts where there is a table.
    """

    BAD = -1

    def __init__(self, aligner: Aligner, table: "PairTable | None" = None, with_groups: bool = True):
        self.aligner, self.table, self.with_groups = aligner, table, with_groups
        self.pairs = np.empty(0, np.int64)  # by number
        self.order, self.ordered = np.empty(0, np.int64), self.pairs  # numbers in the order of the pairs
        self.looked_up = np.empty((0, 2), np.int64)  # by number of the pair
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.groups: list[str] = []
        self.links = np.empty(0, np.int32)  # numbers of pairs, unit by unit
        self.ends = np.zeros(1, np.int64)  # where the links of a unit begin, and end for the next
        self.sums = np.empty((0, len(COUNTS)), np.int64)

    def learn(self, units: set[str]) -> None:
        new, at, sums, links = list(units.difference(self.numbers)), 0, [], []
        known = len(self.sums)
        for part in self.aligner.align(new, self.with_groups):
            if part is None:
                self.numbers[new[at]] = self.BAD
                at += 1
                continue
            n = len(part.sums)
            self.numbers.update(zip(new[at : at + n], range(known, known + n)))
            sums.append(part.sums)
            links.append(part.links)
            self.groups += part.groups
            at, known = at + n, known + n
        if not sums:
            return
        sums, links = np.concatenate(sums), self.numbers_of(np.concatenate(links))
        ends = np.cumsum(sums[:, 3])
        found = np.zeros((len(sums), 2), np.int64)
        if self.table is not None:
            upto = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(self.looked_up[links], axis=0)])
            found = np.diff(upto[ends], prepend=np.zeros((1, 2), np.int64), axis=0)
        self.sums = np.concatenate([self.sums, np.hstack([sums, found])])
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends])
        self.links = np.concatenate([self.links, links])

    def numbers_of(self, links: np.ndarray) -> np.ndarray:
        """The numbers of the pairs of links; new pairs get the next ones and are looked up."""
        ordered = np.unique(links)
        at = np.searchsorted(self.ordered, ordered)
        new = ordered[self.ordered[np.minimum(at, len(self.ordered) - 1)] != ordered] if len(self.ordered) else ordered
        if len(new):
            self.pairs = np.concatenate([self.pairs, new])
            self.order = np.argsort(self.pairs)
            self.ordered = self.pairs[self.order]
            if self.table is not None:
                self.looked_up = np.concatenate([self.looked_up, self.table.look_up(new)])
        return self.order[np.searchsorted(self.ordered, links)].astype(np.int32)

    def links_of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pairs of all links of the units, and how many each unit has."""
        starts, sizes = self.ends[units], self.ends[units + 1] - self.ends[units]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.links[np.repeat(starts, sizes) + within], sizes

    def chunks(self, texts: pa.Array) -> Iterator[list[np.ndarray]]:
        """Numbers of the units of each text, texts of a bounded size together."""
        chunk, size = [], 0
        for text in texts.to_pylist():
            chunk.append(text)
            size += len(text or "")
            if size > CHUNK_CHARS:
                yield self._numbers(chunk)
                chunk, size = [], 0
        if chunk:
            yield self._numbers(chunk)

    def _numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.numbers) > REMEMBERED:
            self.clear()
        lists = [self.aligner.units(t) if t else [] for t in texts]
        self.learn(set().union(*lists))
        out = []
        for text, units in zip(texts, lists):
            numbers = np.fromiter(map(self.numbers.__getitem__, units), np.int64, len(units))
            if (numbers == self.BAD).any():
                # Whether a text comes back is for the whole text to say.
                self.learn({" " + text})
                number = self.numbers[" " + text]
                numbers = np.empty(0, np.int64) if number == self.BAD else np.array([number])
            out.append(numbers)
        return out


# ---- counts of pairs -------------------------------------------------------------------------


def bucket_of(pairs: np.ndarray) -> np.ndarray:
    return (mixed(pairs >> PAIR_BITS, 0) % np.uint64(BUCKETS)).astype(np.int64)


def added(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order, and their counts added up."""
    every, many = np.concatenate(pairs), np.concatenate(counts)
    unique, inverse = np.unique(every, return_inverse=True)
    total = np.zeros(len(unique), np.int64)
    np.add.at(total, inverse, many)
    return unique, total


def pairs_of_documents(memory: Memory, documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs linked in some of the documents, and in how many."""
    n_pairs = len(memory.pairs)
    links, sizes = memory.links_of(np.concatenate(documents).astype(np.int64))
    owner = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
    places = np.repeat(owner * n_pairs, sizes) + links
    if len(documents) * n_pairs <= MARKS:
        marks = np.zeros(len(documents) * n_pairs, bool)
        marks[places] = True
        total = marks.reshape(len(documents), n_pairs).sum(axis=0)
    else:
        total = np.bincount(np.unique(places) % n_pairs, minlength=n_pairs)
    held = np.flatnonzero(total)
    return memory.pairs[held], total[held]


PARTIALS = "bucket int, part long, pairs binary, counts binary"


def first_pass(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Columns PARTIALS: pairs of docs(text) with how many documents have them, by task and bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        memory = Memory(aligner_of(a_path, b_path), with_groups=False)
        pairs, counts, held = [], [], 0
        for batch in batches:
            for documents in memory.chunks(batch.column("text")):
                own = pairs_of_documents(memory, documents)
                pairs.append(own[0])
                counts.append(own[1])
                held += len(own[0])
                if held > HELD_PAIRS:
                    united = added(pairs, counts)
                    pairs, counts, held = [united[0]], [united[1]], len(united[0])
                    if held > HELD_PAIRS // 2:
                        yield in_buckets(part, *united)
                        pairs, counts, held = [], [], 0
        if held:
            yield in_buckets(part, *added(pairs, counts))

    return docs.select("text").mapInArrow(count, PARTIALS)


def in_buckets(part: int, pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    bucket, rows = bucket_of(pairs), []
    for b in np.unique(bucket).tolist():
        rows.append((b, part, pairs[bucket == b].tobytes(), counts[bucket == b].tobytes()))
    return pa.RecordBatch.from_pylist([dict(zip(("bucket", "part", "pairs", "counts"), r)) for r in rows], PARTIALS_ARROW)


PARTIALS_ARROW = pa.schema([("bucket", pa.int32()), ("part", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary())])


def arrays(table: pa.Table, name: str) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int64) for x in table.column(name).to_pylist()]


def tree(rows: DataFrame, merge, schema: str, parts: int) -> DataFrame:
    """One row a bucket: merge() takes the rows of a bucket with FAN_IN neighbouring parts, again and
    again until there is one part."""
    while True:
        parts = -(-parts // FAN_IN)
        rows = rows.withColumn("part", F.expr(f"part div {FAN_IN}"))
        rows = rows.groupBy("bucket", "part").applyInArrow(merge, schema)
        if parts <= 1:
            return rows


KEYS = "bucket int, part long, pairs binary"
HASHES = "bucket int, part long, pairs binary, sizes array<long>, bits binary"


def distinct_pairs(partials: DataFrame, parts: int) -> DataFrame:
    def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        pairs = np.unique(np.concatenate(arrays(rows, "pairs")))
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "part": [key[1].as_py()], "pairs": [pairs.tobytes()]})

    return tree(partials.select("bucket", "part", "pairs"), merge, KEYS, parts)


def hashed(keys: DataFrame) -> DataFrame:
    """Columns HASHES: the perfect hash of each bucket, its pairs in the order of their numbers."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for pairs in arrays(pa.table(batch), "pairs"):
                perfect = PerfectHash.of(pairs)
                ordered = np.empty_like(pairs)
                ordered[perfect.numbers(pairs)] = pairs
                made.append((ordered.tobytes(), perfect.sizes, perfect.bits.tobytes()))
            pairs, sizes, bits = (list(c) for c in zip(*made)) if made else ([], [], [])
            columns = [batch.column("bucket"), batch.column("part"), pa.array(pairs, pa.binary())]
            columns += [pa.array(sizes, pa.list_(pa.int64())), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "part", "pairs", "sizes", "bits"])

    return keys.mapInArrow(build, HASHES)


VECTORS = "bucket int, part long, counts binary"


def dense_counts(partials: DataFrame, hashes: DataFrame, parts: int) -> DataFrame:
    """Counts of every bucket, in the order of its hash: vectors of some parts, summed in a tree."""
    groups = -(-parts // FAN_IN)
    grouped = partials.withColumn("part", F.expr(f"part div {FAN_IN}"))
    dealt = hashes.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))

    def vector(key: tuple[pa.Scalar, ...], rows: pa.Table, table: pa.Table) -> pa.Table:
        perfect, keys = hash_of(table, 0)
        total = np.zeros(len(keys), np.int64)
        for pairs, counts in zip(arrays(rows, "pairs"), arrays(rows, "counts")):
            numbers = verified(perfect, keys, pairs)
            if (numbers < 0).any():
                raise ValueError("a pair is not among those that were hashed")
            total[numbers] += counts
        return vector_row(key, total)

    def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return vector_row(key, np.sum(arrays(rows, "counts"), axis=0))

    by = ["bucket", "part"]
    vectors = grouped.groupBy(*by).cogroup(dealt.groupBy(*by)).applyInArrow(vector, VECTORS)
    return tree(vectors, merge, VECTORS, groups) if groups > 1 else vectors


def vector_row(key, counts: np.ndarray) -> pa.Table:
    columns = {"bucket": pa.array([key[0].as_py()], pa.int32()), "part": [key[1].as_py()]}
    return pa.table(columns | {"counts": [counts.astype(np.int64).tobytes()]})


def hash_of(table: pa.Table, row: int) -> tuple[PerfectHash, np.ndarray]:
    bits = np.frombuffer(table.column("bits")[row].as_py(), np.uint8)
    return PerfectHash(table.column("sizes")[row].as_py(), bits), arrays(table, "pairs")[row]


def verified(perfect: PerfectHash, keys: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Numbers of the pairs, -1 for pairs that were not counted."""
    numbers = perfect.numbers(pairs)
    numbers[numbers >= 0] = np.where(keys[numbers] == pairs, numbers, -1)[numbers >= 0]
    return numbers


TABLE = "bucket int, pairs binary, sizes array<long>, bits binary, counts binary, best binary"


def count_table(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Columns TABLE, a row a bucket: hash, pairs, counts, and which have the highest count of their A id."""
    partials = stage(first_pass(docs, a_path, b_path), "pairs_by_task")
    parts = (partials.agg(F.max("part")).first()[0] or 0) + 1
    hashes = stage(hashed(distinct_pairs(partials, parts)), "pair_hashes")
    counts = dense_counts(partials, hashes, parts).select("bucket", "counts")

    def with_best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, best = pa.table(batch), []
            for pairs, n in zip(arrays(table, "pairs"), arrays(table, "counts")):
                _, ids = np.unique(pairs >> PAIR_BITS, return_inverse=True)
                highest = np.zeros(ids.max() + 1, np.int64)
                np.maximum.at(highest, ids, n)
                best.append((n == highest[ids]).astype(np.uint8).tobytes())
            yield batch.append_column("best", pa.array(best, pa.binary()))

    joined = hashes.drop("part").join(counts, "bucket")
    columns = ["bucket", "pairs", "sizes", "bits", "counts"]
    return stage(joined.select(*columns).mapInArrow(with_best, TABLE), "pair_table")


class PairTable:
    """Some buckets of the table of counts. Pairs of other buckets count nothing, nor do pairs that only
    occur in units of texts without tokens."""

    def __init__(self, rows: pa.Table):
        self.buckets = {}
        for i, bucket in enumerate(rows.column("bucket").to_pylist()):
            best = np.frombuffer(rows.column("best")[i].as_py(), np.uint8)
            self.buckets[bucket] = (*hash_of(rows, i), arrays(rows, "counts")[i], best)

    def look_up(self, pairs: np.ndarray) -> np.ndarray:
        """(1 if its count is the highest of its A id, count) of each pair."""
        bucket, found = bucket_of(pairs), np.zeros((len(pairs), 2), np.int64)
        for b in np.unique(bucket).tolist():
            if b in self.buckets:
                perfect, keys, counts, best = self.buckets[b]
                here = np.flatnonzero(bucket == b)
                numbers = verified(perfect, keys, pairs[here])
                here, numbers = here[numbers >= 0], numbers[numbers >= 0]
                found[here, 0], found[here, 1] = best[numbers], counts[numbers]
        return found


def sections(table: DataFrame, most: int) -> list[list[int]]:
    """Buckets to be broadcast together: of at most so many pairs, or one bucket."""
    sizes = table.select("bucket", (F.octet_length("pairs") / 8).alias("n")).orderBy("bucket").collect()
    out, room = [[]], most
    for row in sizes:
        if out[-1] and row["n"] > room:
            out.append([])
            room = most
        out[-1].append(row["bucket"])
        room -= row["n"]
    return out


# ---- results ---------------------------------------------------------------------------------


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Columns a, b, documents, best: every pair of ids that some document of docs(text) has linked."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.table(batch)
            for i, (pairs, counts) in enumerate(zip(arrays(table, "pairs"), arrays(table, "counts"))):
                best = np.frombuffer(table.column("best")[i].as_py(), np.uint8) > 0
                columns = [pairs >> PAIR_BITS, pairs & (2**PAIR_BITS - 1), counts, best]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "documents", "best"])

    return count_table(docs, a_path, b_path).mapInArrow(rows, "a long, b long, documents long, best boolean")


def token_groups(docs: DataFrame, a_path: str, b_path: str, keep: list[str] | None = None) -> DataFrame:
    """Column groups for every row of docs(text): the ids of A and of B in each group."""
    fields = T.StructType().add("groups", T._parse_datatype_string(TOKEN_GROUPS))

    def make():
        memory = Memory(aligner_of(a_path, b_path))

        def compute(texts):
            out = []
            for documents in memory.chunks(texts):
                for units in documents:
                    groups = [g.split("|") for u in units.tolist() for g in memory.groups[u].split(";")]
                    out.append([{"a": [*map(int, a.split(","))], "b": [*map(int, b.split(","))]} for a, b in groups])
            return {"groups": out}

        return compute

    return append_columns(docs, make, ["text"], fields, keep)


def digests(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    keep: list[str] | None = None,
    section_pairs: int = SECTION_PAIRS,
) -> DataFrame:
    """Columns DIGESTS for every row of docs(text)."""
    context = docs.sparkSession.sparkContext
    table = count_table(docs, a_path, b_path)
    dealt = sections(table, section_pairs)
    kept = list(docs.columns if keep is None else keep)
    made = {name.lower() for name in DIGESTS.names}
    kept = [c for c in kept if c.lower() not in made]
    rows = docs.select(*dict.fromkeys(["text", *kept]))
    for number, buckets in enumerate(dealt):
        if number:
            rows = stage(rows, "aligned")
        found = context.broadcast(table.where(F.col("bucket").isin(buckets)).toArrow())
        rows = _look_up(rows, a_path, b_path, found, number > 0)
    return rows.select(*kept, *DIGESTS.names)


def _look_up(rows: DataFrame, a_path: str, b_path: str, found, again: bool) -> DataFrame:
    def make():
        memory = Memory(aligner_of(a_path, b_path), PairTable(found.value))

        def compute(texts, *before):
            sums, shas = [], []
            for documents in memory.chunks(texts):
                for units in documents:
                    sums.append(memory.sums[units].sum(axis=0))
                    text = ";".join(map(memory.groups.__getitem__, units.tolist()))
                    shas.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
            columns = dict(zip(COUNTS, np.array(sums).reshape(-1, len(COUNTS)).T))
            for name, values in zip(("n_best", "count_sum"), before):
                columns[name] = columns[name] + values.to_numpy()
            return {c: pa.array(v) for c, v in columns.items()} | {"groups_sha256": shas}

        return compute

    inputs = ["text", "n_best", "count_sum"] if again else ["text"]
    return append_columns(rows, make, inputs, DIGESTS)
