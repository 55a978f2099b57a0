"""Resharding by minimum-cost flow.

``transfers(sizes, capacities)`` solves on the driver, over shards, which bytes go from which
old shard to which new one so that the fewest bytes move. ``moves(sizes, capacities, blocks)`` gives the blocks that go and where.
``assign(docs)`` gives (doc_id, old_shard, new_shard, moved, bytes) of every row; ``rewrite(docs, assigned, path)``
writes the shards that lose rows, and the rows that others gain, and nothing else, below ``path``.

How. Sizes by shard come from one pass that keeps a few bytes a row (id, shard, bytes, hash). Each shard's rows fall into blocks by a hash, about 1/``parts`` of a
capacity each. Only the sizes of shards, and of the blocks of those that exceed their capacity, are known to the driver. Of such a shard the heaviest
choice of blocks that its capacity holds stays (a subset sum, exact to 1/STEPS of the capacity), as staying costs nothing; the others must go. Where they go is a
flow: an arc of cost 0 from each old shard to the new one of its name, and one of
cost 1 a byte to a hub from which all new shards are reached, so the network grows with the number
of shards, not its square; it is solved by the primal-dual method: a maximum flow at each
cost, lowest first. Blocks are dealt along the flow, each whole and only where it fits, so capacities hold.

Moved bytes are the least for whole blocks: no plan of whole blocks that keeps to the capacities moves fewer. Where the room left is so scattered that some block
fits nowhere, blocks are made a quarter as large, down to 1/MOST_PARTS of a capacity.

Defined cases. Null shard names count as ''. Null texts have 0 bytes and stay or move with their
block; so do empty ones. Very long texts count by their bytes; one that exceeds every capacity is an error. Repeated rows go together. Ties: of equal blocks the first by number stays. An empty table gives no rows. Capacities below the sum of sizes,
or that no whole blocks fit, are an error (ValueError). All columns are rewritten as they are; what is added to the files has names that begin with __reshard_.
"""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Hashable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import cut, ensure_checkpoint_dir, sized

SLACK, PARTS, MOST_PARTS, EXTRA = 0.10, 64, 4096, 4
FILE_BYTES, LEAST_FILE_BYTES = 256 << 20, 16 << 20
STEPS = 1 << 14


def transfers(sizes: dict[Hashable, int], capacities: dict[str, int]) -> list[tuple]:
    """(old, new, bytes), old <> new, of a flow that moves the fewest bytes."""
    if sum(sizes.values()) > sum(capacities.values()):
        raise ValueError("the new shards can't hold the old ones")
    old, new = sorted(k for k, v in sizes.items() if v), sorted(capacities)
    hub, source, sink = 0, 1, 2
    left = {k: 3 + i for i, k in enumerate(old)}
    right = {k: 3 + len(old) + i for i, k in enumerate(new)}
    head: list[list[int]] = [[] for _ in range(3 + len(old) + len(new))]
    to: list[int] = []
    room: list[int] = []
    cost: list[int] = []

    def arc(a: int, b: int, capacity: int, price: int) -> int:
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            head[x].append(len(to))
            to.append(y)
            room.append(c)
            cost.append(p)
        return len(to) - 2

    many = sum(sizes.values())
    moving = {}
    for k in old:
        arc(source, left[k], sizes[k], 0)
        if k in right:
            arc(left[k], right[k], many, 0)
        moving[k] = arc(left[k], hub, many, 1)
    gaining = {}
    for k in new:
        gaining[k] = arc(hub, right[k], many, 0)
        arc(right[k], sink, capacities[k], 0)
    sent = 0
    while sent < many:
        # shortest distances by cost, then a maximum flow over arcs that lie on shortest paths
        far = [1 << 60] * len(head)
        far[source] = 0
        queue, queued = deque([source]), {source}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for e in head[a]:
                if room[e] and far[a] + cost[e] < far[to[e]]:
                    far[to[e]] = far[a] + cost[e]
                    if to[e] not in queued:
                        queued.add(to[e])
                        queue.append(to[e])
        while True:
            came: dict[int, int] = {source: -1}
            queue = deque([source])
            while queue and sink not in came:
                a = queue.popleft()
                for e in head[a]:
                    if room[e] and to[e] not in came and far[a] + cost[e] == far[to[e]]:
                        came[to[e]] = e
                        queue.append(to[e])
            if sink not in came:
                break
            path, a = [], sink
            while a != source:
                path.append(came[a])
                a = to[came[a] ^ 1]
            push = min(room[e] for e in path)
            for e in path:
                room[e] -= push
                room[e ^ 1] += push
            sent += push
    out, targets = [], deque((k, room[gaining[k] ^ 1]) for k in new if room[gaining[k] ^ 1])
    for k in old:
        rest = room[moving[k] ^ 1]
        while rest:
            name, free = targets.popleft()
            part = min(rest, free)
            out.append((k, name, part))
            rest -= part
            if free > part:
                targets.appendleft((name, free - part))
    return out


class NoRoomError(ValueError):
    """Some block fits nowhere."""


def heaviest(sizes: list[int], capacity: int) -> list[int]:
    """Which of the sizes, by place, have the greatest sum within the capacity; exact where that is below STEPS, else to 1/STEPS of it."""
    if sum(sizes) <= capacity:
        return list(range(len(sizes)))
    unit = -(-capacity // STEPS) if capacity > STEPS else 1
    most, reach, before = capacity // unit, 1, []
    for size in sizes:
        before.append(reach)
        reach |= (reach << -(-size // unit)) & ((1 << (most + 1)) - 1)
    at, out = reach.bit_length() - 1, []
    for k in range(len(sizes) - 1, -1, -1):
        if not before[k] >> at & 1:
            out.append(k)
            at -= -(-sizes[k] // unit)
    return out[::-1]


def moves(sizes: dict[str, int], capacities: dict[str, int], blocks: dict[str, list[tuple[int, int]]]) -> list[tuple[str, int, str, int]]:
    """(old shard, block, new shard, bytes) of the blocks that go; blocks holds (number, bytes) of those of every shard that exceeds its capacity or has none."""
    if sum(sizes.values()) > sum(capacities.values()):
        raise ValueError("the new shards can't hold the old ones")
    free = {k: c - (sizes.get(k, 0) if k not in blocks else 0) for k, c in capacities.items()}
    going: dict[str, list[tuple[int, int]]] = {}
    for shard, own in sorted(blocks.items()):
        stay = set(heaviest([n for _, n in own], capacities[shard])) if shard in capacities else set()
        if shard in capacities:
            free[shard] -= sum(own[k][1] for k in stay)
        going[shard] = [b for k, b in enumerate(own) if k not in stay]
    flow: dict[str, dict[str, int]] = {}
    for (_, old), new, n in transfers({("from", k): sum(n for _, n in own) for k, own in going.items()}, free):
        flow.setdefault(old, {})[new] = n
    out = []
    for n, shard, block in sorted(((n, shard, block) for shard, own in going.items() for block, n in own), key=lambda x: (-x[0], x[1], x[2])):
        planned = flow.get(shard, {})
        fits = [k for k in free if free[k] >= n and k != shard] or [k for k in free if free[k] >= n]
        if not fits:
            raise NoRoomError("no whole blocks fit the capacities")
        new = max(fits, key=lambda k: (min(planned.get(k, 0), n), planned.get(k, 0) if planned.get(k, 0) >= n else -free[k], k))
        planned[new] = max(0, planned.get(new, 0) - n)
        free[new] -= n
        out.append((shard, block, new, n))
    return out


def even(sizes: dict[str, int], extra: int = EXTRA, slack: float = SLACK, most: int = 0) -> dict[str, int]:
    """Equal capacities for the old shards and ``extra`` new ones, with ``slack`` to spare, and room for two rows of ``most`` bytes."""
    names = [*sorted(sizes), *(f"new-{k:04d}" for k in range(extra))]
    return dict.fromkeys(names, max(2 * most, int(sum(sizes.values()) * (1 + slack) / max(1, len(names))) + 1))


def _hash(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"))


def _bytes(docs: DataFrame) -> Column:
    return F.coalesce(F.octet_length(docs["text"].cast("string")), F.lit(0)).cast("long")


def _shard(docs: DataFrame, by: str) -> Column:
    return F.coalesce(docs[by].cast("string"), F.lit(""))


class Plan:
    """rows: (doc_id, old_shard, bytes, hash) of all rows; cuts: (old_shard, blocks) and goes: (old_shard, block, new_shard) of the shards that lose rows, whose names are ``losing``; written: bytes by new shard of what is written."""

    def __init__(self, docs: DataFrame, by: str, capacities: dict[str, int] | None, parts: int):
        spark = docs.sparkSession
        self.rows = cut(docs.select(docs["doc_id"].cast("long").alias("doc_id"), _shard(docs, by).alias("old_shard"), _bytes(docs).alias("bytes"), _hash(docs).alias("hash")))
        seen = self.rows.groupBy("old_shard").agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("most")).collect()
        sizes = {r["old_shard"]: r["bytes"] for r in seen}
        capacities = even(sizes, most=max((r["most"] for r in seen), default=0)) if capacities is None else capacities
        losing = sorted(k for k, n in sizes.items() if n > capacities.get(k, -1))
        own = self.rows.where(F.col("old_shard").isin(losing)) if losing else self.rows.limit(0)
        found: list[tuple[str, int, str, int]] = []
        while True:
            block = max(1, min(capacities.values(), default=1) // parts)
            counts = [(k, max(1, -(-sizes[k] // block))) for k in losing]
            self.cuts = spark.createDataFrame(counts, "old_shard string, blocks long")
            blocks: dict[str, list[tuple[int, int]]] = {k: [] for k in losing}
            if losing:
                for r in own.join(sized(self.cuts, 64), "old_shard").groupBy("old_shard", F.pmod("hash", "blocks").alias("block")).agg(F.sum("bytes").alias("bytes")).orderBy("old_shard", "block").collect():
                    blocks[r["old_shard"]].append((r["block"], r["bytes"]))
            try:
                found = moves(sizes, capacities, blocks)
                break
            except NoRoomError:
                if parts >= MOST_PARTS:
                    raise
                parts *= 4
        self.losing = sorted({old for old, *_ in found})
        self.goes = cut(spark.createDataFrame([f[:3] for f in found], "old_shard string, block long, new_shard string"))
        self.written = {k: sizes[k] - sum(n for old, _, _, n in found if old == k) for k in self.losing}
        for _, _, new, n in found:
            self.written[new] = self.written.get(new, 0) + n

    def placed(self, rows: DataFrame) -> DataFrame:
        """rows, which hold old_shard and hash, with new_shard."""
        goes = self.goes.select(F.col("old_shard").alias("__old"), F.col("block").alias("__block"), "new_shard")
        cuts = self.cuts.select(F.col("old_shard").alias("__name"), "blocks")
        numbered = rows.join(sized(cuts, 64), F.col("old_shard") == F.col("__name"), "left")
        joined = numbered.join(sized(goes, 100), (F.col("old_shard") == F.col("__old")) & (F.pmod("hash", "blocks") == F.col("__block")), "left")
        return joined.withColumn("new_shard", F.coalesce("new_shard", "old_shard")).drop("__old", "__block", "__name", "blocks")


def assign(docs: DataFrame, by: str = "source", capacities: dict[str, int] | None = None, parts: int = PARTS) -> DataFrame:
    """(doc_id, old_shard, new_shard, moved, bytes)."""
    plan = Plan(docs, by, capacities, parts)
    return plan.placed(plan.rows).select("doc_id", "old_shard", "new_shard", (F.col("old_shard") != F.col("new_shard")).alias("moved"), "bytes")


def rewrite(docs: DataFrame, path: str, by: str = "source", capacities: dict[str, int] | None = None, parts: int = PARTS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the rows of all shards that lose any to path/__reshard_new=NAME/, in files of about ``file_bytes`` (smaller ones where there would be fewer than tasks run at once). Shards that only gain keep the files they have. Gives what ``assign`` gives, read from the new files where they were written.

    Rows of other shards are not read: the condition on the shard is the scan's. A task writes one file.
    """
    spark, plan = docs.sparkSession, Plan(docs, by, capacities, parts)
    kept = plan.rows.where(~F.col("old_shard").isin(plan.losing)) if plan.losing else plan.rows
    kept = kept.select("doc_id", "old_shard", F.col("old_shard").alias("new_shard"), F.lit(False).alias("moved"), "bytes")
    if not plan.losing:
        return kept
    name = docs[by].cast("string")
    named = name.isin([k for k in plan.losing if k])
    lost = docs.where(named | name.isNull() | (name == "") if "" in plan.losing else named)
    source = lost.select(F.struct(*[lost[c] for c in lost.columns]).alias("row"), _shard(lost, by).alias("old_shard"), _bytes(lost).alias("bytes"), _hash(lost).alias("hash"))
    each = min(file_bytes, max(min(file_bytes, LEAST_FILE_BYTES), sum(plan.written.values()) // (3 * spark.sparkContext.defaultParallelism) + 1))
    spread, files = [], 0
    for new, n in sorted(plan.written.items()):
        spread.append((new, files, max(1, -(-n // each))))
        files += spread[-1][2]
    spread = spark.createDataFrame(spread, "to_shard string, first int, files int")
    placed = plan.placed(source).join(sized(spread, 64), F.col("new_shard") == F.col("to_shard"))
    split = placed.repartitionById(files, F.col("first") + F.pmod(F.shiftright("hash", 17), F.col("files")).cast("int"))
    split.select("row.*", F.col("old_shard").alias("__reshard_old"), F.col("bytes").alias("__reshard_bytes"), F.col("new_shard").alias("__reshard_new")).write.partitionBy("__reshard_new").parquet(path)
    written = spark.read.schema("doc_id long, __reshard_old string, __reshard_bytes long, __reshard_new string").parquet(path)
    old, new = F.col("__reshard_old"), F.coalesce("__reshard_new", F.lit(""))
    return written.select("doc_id", old.alias("old_shard"), new.alias("new_shard"), (old != new).alias("moved"), F.col("__reshard_bytes").alias("bytes")).unionByName(kept)


def target(docs: DataFrame) -> str:
    """A new folder beside the shared checkpoints."""
    ensure_checkpoint_dir(docs.sparkSession)
    spark = docs.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{base}/reshard-{uuid.uuid4()}"
