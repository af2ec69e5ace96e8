"""SimHash near-duplicates by the generalised pigeonhole principle.

Two fingerprints of 64 bits are linked when at most DISTANCE bits differ. The bits are divided into m
parts. If every part i has a threshold t_i of -1 or more and sum(t_i + 1) = DISTANCE + 1, then linked
fingerprints differ by at most t_i bits in some part i: that part finds the link, and a part with
threshold -1 need not be looked at. So a fingerprint may choose its own thresholds, and it chooses
those with the least work:

1. Statistics over all distinct fingerprints: how often two bits are set together, and the histogram
   of every group of 8 or fewer bits. Their sizes do not depend on the input.
2. Correlated bits go to the same part, so that the other parts differ more between fingerprints.
3. From the histograms every fingerprint estimates the candidates of each part and threshold, and a
   dynamic program over the parts divides the DISTANCE + 1 units for the least cost of probes and
   candidates. A frequent value of a part is thus left to the other parts.
4. Every fingerprint is indexed once for each part under its value, and probes all values within its
   threshold. Index and probes meet in a shuffle on (part, value) and are verified in numpy. A bucket
   sends a spanning tree of its links, never all pairs. Dense buckets cost nearly linear time: what is
   linked to one member is not compared again. Buckets over BUCKET_ROWS rows are cut into blocks, and
   all pairs of blocks are checked by tasks of their own; no row is left out.
5. Links become components by alternating large and small stars, every round in a stored table.

Copies share a fingerprint, so a group of copies is one row from step 1 on. Only statistics of fixed
size reach the driver.

Defined results: null and empty texts and texts without words have fingerprint zero, linked like any
other; texts with fewer than SHINGLE words are one shingle; repeated rows are one node each; a row with
null doc_id takes part, and component_id is null only where all ids of the component are; empty tables
give empty results; only doc_id and text are read.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrain.llm.common import append_columns, byte_texts
from tillgrain.session import stage

SHINGLE = 4
SEED = 42
BITS = 64
DISTANCE = 4
MOST_UNITS = 3  # largest t_i + 1
ROW_COST, CHECK_COST = 1.0, 0.005  # microseconds for a probe through the shuffle, and for a check
BUCKET_ROWS = 65_536
SMALL_BUCKET = 48
BATCH_ROWS = 400_000
BROADCAST_ROWS = 10_000

FINGERPRINT = T.StructType([T.StructField("fp", T.LongType())])


def fingerprint(text: bytes | None) -> int:
    """Unsigned fingerprint of a UTF-8 text."""
    words = text.lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return hashed(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    spans = zip(starts[: len(words) - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist())
    hashes = np.array([hashed(joined[a:b], SEED) for a, b in spans], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        counts += as_bits(hashes[at : at + 65_536]).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def as_bits(fps: np.ndarray) -> np.ndarray:
    """A row of 64 bits for each fingerprint, the highest first."""
    return np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def fingerprints(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and fp, the fingerprint as a signed long."""

    def make():
        def compute(texts):
            found = np.array([fingerprint(t) for t in byte_texts(texts)], np.uint64)
            return {"fp": pa.array(found.view(np.int64))}

        return compute

    return append_columns(docs, make, ["text"], FINGERPRINT, keep)


# --- statistics ---------------------------------------------------------------------------------


def _summed(fps: DataFrame, size: int, count) -> np.ndarray:
    """Sums over all rows of an array that count() makes of a batch of fingerprints."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += count(batch.column(0).to_numpy().view(np.uint64))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    cells = fps.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n"))
    out = np.zeros(size, np.int64)
    for cell, n in cells.collect():  # at most size rows
        out[cell] = n
    return out


def pair_counts(fps: np.ndarray) -> np.ndarray:
    bits = as_bits(fps).astype(np.float32)
    return (bits.T @ bits).astype(np.int64).ravel()


def correlated_parts(pairs: np.ndarray, total: int, m: int) -> list[list[int]]:
    """Divide the bits into m parts of nearly equal size; correlated bits share a part."""
    share = pairs.reshape(BITS, BITS) / max(total, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    linked = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(linked, 0)
    free, parts = set(range(BITS)), []
    for i in range(m):
        size = BITS * (i + 1) // m - BITS * i // m
        rest = sorted(free)
        part = [max(rest, key=lambda b: linked[b, rest].sum())]
        free.discard(part[0])
        while len(part) < size:
            part.append(max(sorted(free), key=lambda b: linked[b, part].sum()))
            free.discard(part[-1])
        parts.append(sorted(part))
    return parts


def part_values(fps: np.ndarray, parts: list[list[int]]) -> list[np.ndarray]:
    """For each part, the number that its bits form."""
    bits = as_bits(fps)
    out = []
    for part in parts:
        value = np.zeros(len(fps), np.int64)
        for b in part:
            value = value << 1 | bits[:, b]
        out.append(value)
    return out


def chunks_of(part: list[int]) -> list[list[int]]:
    n = -(-len(part) // 8)
    return [part[len(part) * i // n : len(part) * (i + 1) // n] for i in range(n)]


def number_of_parts(total: int) -> int:
    """The m with the least expected cost for so many evenly spread fingerprints."""
    costs = {}
    for m in range(2, DISTANCE + 2):
        width, units = BITS // m, DISTANCE + 1
        rows = candidates = 0.0
        for i in range(m):
            u = units // m + (i < units % m)
            probes = len(flips(width, u))
            rows += 1 + probes
            candidates += probes * total / 2**width
        costs[m] = rows * ROW_COST + candidates * CHECK_COST
    return min(costs, key=costs.get)


def flips(width: int, units: int) -> np.ndarray:
    """All masks of fewer than `units` bits, by number of bits."""
    return np.array(
        [sum(1 << b for b in bits) for n in range(units) for bits in combinations(range(width), n)],
        np.int64,
    )


class Plan:
    """Parts and the estimates by which a fingerprint chooses its thresholds."""

    def __init__(self, parts: list[list[int]], histograms: list[np.ndarray], total: int):
        self.parts, self.total = parts, total
        self.chunks = [chunks_of(part) for part in parts]
        # near[c][v, d]: share of all fingerprints whose chunk c differs from v by d bits.
        distance = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :])
        self.near = [
            np.stack([(distance == d) @ h for d in range(MOST_UNITS)], axis=1) / max(total, 1)
            for h in histograms
        ]
        self.masks = [flips(len(part), MOST_UNITS) for part in parts]
        self.probes = [[0, *(len(flips(len(p), u)) for u in range(1, MOST_UNITS + 1))] for p in parts]

    def costs(self, fps: np.ndarray) -> np.ndarray:
        """[part, units, fingerprint]: cost of probes and of estimated candidates."""
        out = np.zeros((len(self.parts), MOST_UNITS + 1, len(fps)))
        near = iter(self.near)
        for i, chunks in enumerate(self.chunks):
            spread = np.zeros((len(fps), MOST_UNITS))
            spread[:, 0] = 1
            for values in part_values(fps, chunks):
                one, joint = next(near)[values], np.zeros_like(spread)
                for d in range(MOST_UNITS):
                    for e in range(MOST_UNITS - d):
                        joint[:, d + e] += spread[:, d] * one[:, e]
                spread = joint
            within = np.cumsum(spread, axis=1) * self.total
            for u in range(1, MOST_UNITS + 1):
                out[i, u] = self.probes[i][u] * ROW_COST + within[:, u - 1] * CHECK_COST
        return out

    def units(self, fps: np.ndarray) -> np.ndarray:
        """[part, fingerprint]: threshold + 1, summing to DISTANCE + 1, of least cost."""
        costs, whole = self.costs(fps), DISTANCE + 1
        best = np.full((whole + 1, len(fps)), np.inf)
        best[0] = 0
        taken = []
        for cost in costs:
            new, choice = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
            for s in range(whole + 1):
                for u in range(min(s, MOST_UNITS) + 1):
                    value = best[s - u] + cost[u]
                    better = value < new[s]
                    new[s][better] = value[better]
                    choice[s][better] = u
            best = new
            taken.append(choice)
        out = np.zeros((len(costs), len(fps)), np.int64)
        left, every = np.full(len(fps), whole), np.arange(len(fps))
        for i in range(len(costs) - 1, -1, -1):
            out[i] = taken[i][left, every]
            left = left - out[i]
        return out

    def rows(self, fps: np.ndarray):
        """(bucket, fp, role) of index and probes; roles are 1 index, 2 probe, 3 both."""
        units = self.units(fps)
        for i, values in enumerate(part_values(fps, self.parts)):
            base = np.int64(i) << 40
            yield base | values, fps, np.where(units[i] > 0, 3, 1)
            for u in range(2, MOST_UNITS + 1):
                own = np.flatnonzero(units[i] == u)
                masks = self.masks[i][1 : self.probes[i][u]]
                step = max(1, BATCH_ROWS // max(1, len(masks)))
                for at in range(0, len(own), step):
                    some = own[at : at + step]
                    keys = (values[some][:, None] ^ masks).ravel()
                    yield base | keys, np.repeat(fps[some], len(masks)), np.full(len(keys), 2)


def plan_for(fps: DataFrame, total: int) -> Plan:
    parts = correlated_parts(_summed(fps, BITS * BITS, pair_counts), total, number_of_parts(total))
    chunks = [c for part in parts for c in chunks_of(part)]

    def histograms(batch: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(v, minlength=256) for v in part_values(batch, chunks)])

    counted = _summed(fps, 256 * len(chunks), histograms)
    return Plan(parts, list(counted.reshape(len(chunks), 256)), total)


# --- candidates and links -----------------------------------------------------------------------


def bucket_rows(fps: DataFrame, plan: Plan) -> DataFrame:
    schema = "bucket long, fp long, role byte"

    def run(batches):
        for batch in batches:
            for bucket, fp, role in plan.rows(batch.column(0).to_numpy().view(np.uint64)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket),
                        pa.array(fp.view(np.int64)),
                        pa.array(role.astype(np.int8)),
                    ],
                    names=["bucket", "fp", "role"],
                )

    return fps.select("fp").mapInArrow(run, schema)


def in_blocks(rows: DataFrame) -> DataFrame:
    """Rows with a pair of blocks: (0) for a bucket of usual size, all its pairs for a large one."""
    counts = rows.groupBy("bucket").count().where(F.col("count") > BUCKET_ROWS)
    large = counts.select("bucket", F.ceil(F.col("count") / BUCKET_ROWS).cast("int").alias("blocks"))
    large = stage(large, "simhash-large-buckets")
    many = large.count()
    if not many:
        return rows.withColumn("pair", F.lit(0))
    joined = rows.join(F.broadcast(large) if many <= BROADCAST_ROWS else large, "bucket", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    with_others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: (F.least(own, other) * F.col("blocks") + F.greatest(own, other)).cast("int"),
    )
    pairs = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(with_others)
    return joined.select("bucket", "fp", "role", F.explode(pairs).alias("pair"))


def small_links(fps: np.ndarray, roles: np.ndarray, last: np.ndarray):
    """Index pairs of linked rows; the rows of a bucket are neighbours and end before last."""
    left, right = [], []
    rows, step = np.arange(len(fps)), 1
    while True:
        rows = rows[rows + step < last[rows]]
        if not len(rows):
            break
        other = rows + step
        near = np.bitwise_count(fps[rows] ^ fps[other]) <= DISTANCE
        met = (roles[rows] | roles[other]) == 3  # a probe meets an index entry
        near &= met
        left.append(rows[near])
        right.append(other[near])
        step += 1
    return np.concatenate(left or [rows]), np.concatenate(right or [rows])


def large_links(fps: np.ndarray, roles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, root) over one bucket: breadth first, comparing only with rows not yet reached."""
    free = {role: np.flatnonzero(roles == role) for role in (1, 2, 3)}
    meets = {1: (2, 3), 2: (1, 3), 3: (1, 2, 3)}
    rows, roots = [], []
    for root in np.flatnonzero(roles & 2):
        own = free[roles[root]]
        at = np.searchsorted(own, root)
        if at == len(own) or own[at] != root:
            continue
        free[roles[root]] = np.delete(own, at)
        frontier = [root]
        while frontier:
            row = frontier.pop()
            for role in meets[roles[row]]:
                others = free[role]
                near = np.bitwise_count(fps[others] ^ fps[row]) <= DISTANCE
                if near.any():
                    found = others[near]
                    free[role] = others[~near]
                    frontier.extend(found.tolist())
                    rows.append(found)
                    roots.append(np.full(len(found), root))
    none = np.empty(0, np.int64)
    return np.concatenate(rows or [none]), np.concatenate(roots or [none])


def spanning(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, smallest row it is connected to) of index pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rows = np.flatnonzero(label != np.arange(n))
    return rows, label[rows]


def bucket_links(bucket: np.ndarray, fps: np.ndarray, roles: np.ndarray):
    """Links (fp, fp) of whole buckets whose rows are neighbours."""
    cuts = np.append(0, np.flatnonzero(np.diff(bucket)) + 1)
    ends = np.append(cuts[1:], len(bucket))
    sizes = ends - cuts
    small = np.repeat((sizes > 1) & (sizes <= SMALL_BUCKET), sizes)
    last = np.repeat(ends, sizes)
    keep = np.flatnonzero(small)
    shift = np.cumsum(small) - 1
    a, b = small_links(fps[keep], roles[keep], shift[last[keep] - 1] + 1)
    rows, roots = spanning(a, b, len(keep))
    yield fps[keep][rows], fps[keep][roots]
    for start, end in zip(cuts[sizes > SMALL_BUCKET], ends[sizes > SMALL_BUCKET]):
        rows, roots = large_links(fps[start:end], roles[start:end])
        yield fps[start + rows], fps[start + roots]


def links(rows: DataFrame) -> DataFrame:
    """hi, lo: a spanning forest of the links within each bucket."""
    dealt = rows.repartition("bucket", "pair").sortWithinPartitions("bucket", "pair")

    def run(batches):
        held, size = [], 0

        def work(parts, whole):
            key = np.concatenate([p[0] for p in parts])
            fps = np.concatenate([p[1] for p in parts])
            roles = np.concatenate([p[2] for p in parts])
            # The last bucket may go on in the next batch.
            end = len(key) if whole else np.flatnonzero(key != key[-1])[-1:].max(initial=-1) + 1
            out = list(bucket_links(key[:end], fps[:end], roles[:end])) if end else []
            rest = (key[end:], fps[end:], roles[end:])
            a = np.concatenate([x for x, _ in out] or [fps[:0]]).view(np.int64)
            b = np.concatenate([y for _, y in out] or [fps[:0]]).view(np.int64)
            differ = a != b
            hi, lo = np.maximum(a, b)[differ], np.minimum(a, b)[differ]
            return rest, pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo)], names=["hi", "lo"])

        serial, previous = 0, None
        for batch in batches:
            bucket, fp, role, pair = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(bucket):
                continue
            # Number the groups (bucket, pair) in their order, going on from the last batch.
            new = np.append(
                (bucket[0], pair[0]) != previous,
                (bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1]),
            )
            key = serial + np.cumsum(new)
            serial, previous = int(key[-1]), (bucket[-1], pair[-1])
            held.append((key, fp.view(np.uint64), role.astype(np.int8)))
            size += len(key)
            if size >= BATCH_ROWS:
                rest, out = work(held, False)
                held, size = [rest], len(rest[0])
                yield out
        if held:
            yield work(held, True)[1]

    found = dealt.select("bucket", "fp", "role", "pair").mapInArrow(run, "hi long, lo long")
    return found.distinct()


# --- components ---------------------------------------------------------------------------------


def _smallest(edges: DataFrame, by: str, other: str) -> DataFrame:
    return edges.groupBy(by).agg(F.min(other).alias("least"))


def components(edges: DataFrame) -> DataFrame:
    """node, root from links (hi > lo): stars whose centre is the smallest node of a component."""
    edges = stage(edges, "simhash-links")
    while True:
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = _smallest(both.select(F.col("hi").alias("node"), "lo"), "node", "lo")
        least = least.select("node", F.least("node", "least").alias("least"))
        # Large star: every larger neighbour is tied to the smallest neighbour.
        large = edges.join(least, edges["lo"] == least["node"]).select("hi", F.col("least").alias("lo"))
        large = stage(large.where("hi > lo").distinct(), "simhash-large-star")
        # Small star: every smaller neighbour and the node itself are.
        least = _smallest(large, "hi", "lo")
        joined = large.join(least, "hi")
        small = joined.select(F.col("lo").alias("hi"), F.col("least").alias("lo")).where("hi > lo")
        small = small.unionByName(least.select("hi", F.col("least").alias("lo"))).distinct()
        new = stage(small, "simhash-small-star")
        if _print(new) == _print(edges):
            return new.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        edges = new


def _print(edges: DataFrame) -> tuple:
    """Count and order-free digest of a set of links."""
    h = F.xxhash64("hi", "lo")
    row = edges.agg(F.count("*"), F.sum(h.cast("decimal(20,0)")), F.bit_xor(h)).first()
    return tuple(row)


def near_duplicates(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (by default doc_id), fp, root and component_id for every row of docs(doc_id, text).

    root is the same for all rows of a component: its smallest fingerprint as a signed number.
    """
    kept = list(dict.fromkeys(["doc_id", *(keep or [])]))
    marked = stage(fingerprints(docs, kept), "simhash-fingerprints")
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    plan = plan_for(distinct, distinct.count())
    rows = stage(bucket_rows(distinct, plan), "simhash-rows")
    roots = components(links(in_blocks(rows)))
    owned = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    # Most roots have one fingerprint; the groups are as large as components of distinct fingerprints.
    smallest = owned.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = owned.join(smallest, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select(*kept, "fp", "root", "component_id")


def digests(docs: DataFrame) -> DataFrame:
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return near_duplicates(docs).select("doc_id", hexed.alias("fingerprint"), "component_id")
