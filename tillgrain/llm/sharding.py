"""Resharding by minimum-cost flow: even shards by moving as few bytes as possible.

Rows lie in old shards, and each old shard in blocks, by hashes of the row. The flow network has a
supply for every old shard (its bytes) and a capacity for every new one; a byte that goes to the shard
of the same number costs nothing, any other byte costs one. The cheapest flow (successive shortest
paths) says how many bytes go from which shard to which. Whole blocks then fill each flow, largest
first, as far as they fit; the few blocks that fit nowhere go to the shard with the most room, and
last, blocks change shard as long as this brings the fullest and the emptiest shard closer together.
Only block sizes reach the driver, at most old shards x BLOCKS rows whatever the input is.

Capacities are equal shares of all bytes. A block that is larger than a share (a very long text) has a
shard for itself, and the others share the rest.

Shards are stored as one folder each. rewrite() writes only the shards that give or take rows and
returns a manifest with the folder of every shard, so a lost job leaves the old files untouched.

Defined results: a null text has size 16 and CRC 0, as an empty one; equal texts may lie in different
shards; rows that are equal in id and text lie in the same one; a null id is placed as any other value;
empty tables give empty results; only doc_id and text are read. Slots number the rows of a shard
without gaps from 0, by block and within a block by id, size and CRC.
"""

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrain.session import stage

ROW_BYTES = 16
OLD_SHARDS, NEW_SHARDS = 32, 40
BLOCKS = 1024  # of each old shard
LEVELLING = 20_000

PLAN = T.StructType(
    [
        T.StructField("old_shard", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("first_slot", T.LongType()),
    ]
)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size and text_crc32 of docs(doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def in_old_shards(rows: DataFrame, old_shards: int = OLD_SHARDS, blocks: int = BLOCKS) -> DataFrame:
    """Adds old_shard and block, both from hashes of the row."""
    key = ("doc_id", "size", "text_crc32")
    return rows.select(
        *rows.columns,
        F.pmod(F.xxhash64(*key), F.lit(old_shards)).cast("int").alias("old_shard"),
        F.pmod(F.xxhash64(F.lit(1), *key), F.lit(blocks)).cast("int").alias("block"),
    )


def over_a_share(sizes: list[int], shards: int) -> list[int]:
    """The sizes, largest first, that leave less than themselves for each of the other shards."""
    left, out = sum(sizes), []
    for size in sorted(sizes, reverse=True)[:shards]:
        if size * (shards - len(out)) <= left:
            break
        out.append(size)
        left -= size
    return out


def capacities(sizes: dict[tuple[int, int], int], shards: int) -> list[int]:
    """Equal shares of all bytes, but for blocks over a share: their shards hold just them.

    Such a block stays where it is, unless a larger one from there does.
    """
    large = over_a_share(list(sizes.values()), shards)
    room: list[int | None] = [None] * shards
    for block in sorted(sizes, key=lambda b: (-sizes[b], b))[: len(large)]:
        home = block[0] if block[0] < shards and room[block[0]] is None else room.index(None)
        room[home] = sizes[block]
    left, n = sum(sizes.values()) - sum(large), shards - len(large)
    shares = iter([left // n + (i < left % n) for i in range(n)] if n else [])
    return [next(shares) if r is None else r for r in room]


def cheapest_flow(supplies: list[int], room: list[int], cost) -> dict[tuple[int, int], int]:
    """Amounts (from, to) that use up all supplies within the rooms at the least total cost.

    Successive shortest paths with potentials on the bipartite network; its size is that of the
    shards, not of the data.
    """
    n, m = len(supplies), len(room)
    supplies, room = list(supplies), list(room)
    flow: dict[tuple[int, int], int] = {}
    height = [0] * (n + m)
    while any(supplies):
        far, via = [float("inf")] * (n + m), [-1] * (n + m)
        queue = [(0, u) for u in range(n) if supplies[u]]
        for _, u in queue:
            far[u] = 0
        heapq.heapify(queue)
        while queue:
            d, u = heapq.heappop(queue)
            if d > far[u]:
                continue
            if u < n:
                steps = ((n + v, cost(u, v)) for v in range(m))
            else:
                steps = ((w, -cost(w, u - n)) for w in range(n) if flow.get((w, u - n)))
            for v, c in steps:
                new = d + c + height[u] - height[v]
                if new < far[v]:
                    far[v], via[v] = new, u
                    heapq.heappush(queue, (new, v))
        end = min(
            (v for v in range(n, n + m) if room[v - n]), key=lambda v: (far[v] + height[v], v)
        )
        height = [h + min(d, far[end]) for h, d in zip(height, far)]
        path, v = [], end
        while via[v] >= 0:
            path.append((via[v], v))
            v = via[v]
        amount = min(supplies[v], room[end - n])
        for a, b in path:
            if a >= n:
                amount = min(amount, flow[b, a - n])
        for a, b in path:
            edge, sign = ((a, b - n), 1) if a < n else ((b, a - n), -1)
            flow[edge] = flow.get(edge, 0) + sign * amount
        supplies[v] -= amount
        room[end - n] -= amount
    return {edge: amount for edge, amount in flow.items() if amount}


def place_blocks(sizes: dict[tuple[int, int], int], shards: int) -> dict[tuple[int, int], int]:
    """New shard of every (old shard, block) of so many bytes."""
    if not sizes:
        return {}
    old = max(o for o, _ in sizes) + 1
    room = capacities(sizes, shards)
    supplies = [0] * old
    for (o, _), size in sizes.items():
        supplies[o] += size
    whole = sorted(sizes, key=lambda b: (-sizes[b], b))
    flows = cheapest_flow(supplies, room, lambda a, b: int(a != b))
    placed, free = {}, list(room)
    for block in whole:
        size, (o, _) = sizes[block], block
        fits = [(v, amount) for (u, v), amount in flows.items() if u == o and amount >= size]
        # The shard a block is in comes first, then the smallest flow that holds it.
        if fits:
            v, amount = min(fits, key=lambda f: (f[0] != o, f[1], f[0]))
            flows[o, v] = amount - size
        else:
            v = max(range(shards), key=lambda s: (free[s], s == o, -s))
        placed[block] = v
        free[v] -= size
    return level(placed, sizes, free)


def level(placed: dict, sizes: dict, free: list[int]) -> dict:
    """Move a block from the fullest to the emptiest shard while the gap between them shrinks."""
    held: dict[int, list] = {}
    for block, v in placed.items():
        held.setdefault(v, []).append(block)
    for _ in range(LEVELLING):
        full = min(range(len(free)), key=lambda s: (free[s], s))
        empty = max(range(len(free)), key=lambda s: (free[s], -s))
        gap = free[empty] - free[full]
        fitting = [b for b in held.get(full, ()) if 0 < sizes[b] < gap]
        if not fitting:
            break
        block = min(fitting, key=lambda b: (abs(2 * sizes[b] - gap), b))
        held[full].remove(block)
        held.setdefault(empty, []).append(block)
        placed[block] = empty
        free[full] += sizes[block]
        free[empty] -= sizes[block]
    return placed


def plan(rows: DataFrame, shards: int = NEW_SHARDS) -> DataFrame:
    """PLAN: where each (old_shard, block) of rows(size, old_shard, block) goes."""
    grouped = rows.groupBy("old_shard", "block").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n")
    )
    found = grouped.collect()  # at most old shards x blocks rows
    placed = place_blocks({(r["old_shard"], r["block"]): r["bytes"] for r in found}, shards)
    next_slot, out = [0] * shards, []
    for r in sorted(found, key=lambda r: (r["old_shard"], r["block"])):
        shard = placed[r["old_shard"], r["block"]]
        out.append((r["old_shard"], r["block"], shard, next_slot[shard]))
        next_slot[shard] += r["n"]
    return rows.sparkSession.createDataFrame(out, PLAN)


def reshard(rows: DataFrame, shards: int = NEW_SHARDS) -> DataFrame:
    """rows(doc_id, size, text_crc32, old_shard, block) with shard and slot."""
    # The plan has at most old shards x blocks rows of four numbers.
    placed = rows.join(F.broadcast(plan(rows, shards)), ["old_shard", "block"])
    within = Window.partitionBy("old_shard", "block").orderBy("doc_id", "size", "text_crc32")
    slot = F.col("first_slot") + F.row_number().over(within) - 1
    return placed.withColumn("slot", slot).drop("first_slot")


def digests(docs: DataFrame) -> DataFrame:
    """The law of even bytes over all rows of docs(doc_id, text)."""
    rows = stage(in_old_shards(sized(docs)), "sharding-rows")
    return reshard(rows).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def rewrite(rows: DataFrame, placed: DataFrame, old_root: str, new_root: str) -> DataFrame:
    """Write the affected shards of a stored table anew; a manifest (shard, folder) of all shards.

    rows is the table below old_root with old_shard and block; placed has old_shard, block and shard.
    A shard is affected if a block leaves or enters it. The others keep their old folder.
    """
    spark = rows.sparkSession
    moved = placed.where("old_shard <> shard")
    affected = moved.select(F.explode(F.array("old_shard", "shard")).alias("shard")).distinct()
    affected = stage(affected, "sharding-affected")
    target = rows.join(F.broadcast(placed.select("old_shard", "block", "shard")), ["old_shard", "block"])
    # Both tables have one row for each shard or block of the plan.
    target.join(F.broadcast(affected), "shard", "left_semi").drop("old_shard").repartition(
        "shard", "block"
    ).write.partitionBy("shard").parquet(new_root)
    known = placed.select("shard").distinct()
    return known.join(affected.withColumn("new", F.lit(True)), "shard", "left").select(
        "shard",
        F.concat(
            F.when(F.col("new"), F.lit(f"{new_root}/shard=")).otherwise(F.lit(f"{old_root}/shard=")),
            F.col("shard").cast("string"),
        ).alias("folder"),
    )
