"""Resharding by minimum-cost flow: the block transfers that move the fewest bytes, then a rewrite of affected files."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..sources.stores import remove_path, scratch_path
from .common import written

#: Blocks per old shard, and parts of a block that alone is large; the driver sees one row for each at most.
BLOCKS, PARTS = 1024, 128
#: Rows that get their places in one task.
SLOT_ROWS = 50_000
#: Bytes of text a rewritten file aims at.
FILE_BYTES = 128 << 20


def cheapest_flow(supply: list[int], capacity: list[float], cost) -> dict[tuple[int, int], float]:
    """Flow from sources to targets that ships all supply at least cost.

    ``cost(i, j)`` is the price of a unit, not negative. Shortest augmenting paths with potentials; the graph has a
    node per shard. Capacities must add up to the supply or more.
    """
    a, b = len(supply), len(capacity)
    left, room = [float(x) for x in supply], [float(x) for x in capacity]
    flow: dict[tuple[int, int], float] = {}
    potential = [0.0] * (a + b)
    tiny = 1e-9 * max(1.0, sum(left))
    while (starts := [i for i in range(a) if left[i] > tiny]) and any(r > tiny for r in room):
        dist, before = [float("inf")] * (a + b), [-1] * (a + b)
        queue = []
        for i in starts:
            dist[i] = -potential[i]
            heapq.heappush(queue, (dist[i], i))
        while queue:
            d, u = heapq.heappop(queue)
            if d > dist[u] + 1e-12:
                continue
            if u < a:
                edges = ((a + j, cost(u, j)) for j in range(b))
            else:
                edges = ((i, -cost(i, u - a)) for i in range(a) if flow.get((i, u - a), 0.0) > tiny)
            for v, c in edges:
                step = d + c + potential[u] - potential[v]
                if step < dist[v] - 1e-12:
                    dist[v], before[v] = step, u
                    heapq.heappush(queue, (step, v))
        real = [d + p for d, p in zip(dist, potential)]
        end = min((a + j for j in range(b) if room[j] > tiny), key=lambda v: real[v])
        path, v = [end], end
        while before[v] >= 0:
            v = before[v]
            path.append(v)
        path.reverse()
        amount = min(left[path[0]], room[end - a])
        for u, v in zip(path, path[1:]):
            if u >= a:
                amount = min(amount, flow[v, u - a])
        for u, v in zip(path, path[1:]):
            edge, sign = ((u, v - a), 1) if u < a else ((v, u - a), -1)
            flow[edge] = flow.get(edge, 0.0) + sign * amount
        left[path[0]] -= amount
        room[end - a] -= amount
        potential = [r if r < float("inf") else p for r, p in zip(real, potential)]
    return {e: f for e, f in flow.items() if f > tiny}


@dataclass(frozen=True)
class Plan:
    """Where each block goes: ``(old shard, block, part) -> new shard``; part -1 is a whole block."""

    placed: dict[tuple[int, int, int], int]
    split: list[tuple[int, int]]
    moved_bytes: int
    rows: int
    bytes: int = 0

    def affected(self) -> set[int]:
        """Shards that lose or gain a block."""
        moves = {(o, n) for (o, _, _), n in self.placed.items() if o != n}
        return {s for move in moves for s in move}


def _place(sizes: dict[tuple[int, int, int], int], flow: dict[tuple[int, int], float], capacity: list[float]) -> dict:
    """Blocks to shards along the flow: in each old shard the largest block goes where most of the flow is still open.

    Whole blocks can't meet the flow exactly; single blocks then move from the shard most above its capacity to that
    most below while that narrows their gap.
    """
    shards = len(capacity)
    placed, load = {}, [-c for c in capacity]
    by_old: dict[int, list] = {}
    for k, n in sizes.items():
        by_old.setdefault(k[0], []).append((-n, k))
    for old, own in sorted(by_old.items()):
        quota = [(-f, j != old, j) for (i, j), f in flow.items() if i == old] or [(0.0, False, old % shards)]
        heapq.heapify(quota)
        for n, k in sorted(own):
            f, moves, j = heapq.heappop(quota)
            placed[k], load[j] = j, load[j] - n
            heapq.heappush(quota, (f - n, moves, j))
    members: list[set] = [set() for _ in range(shards)]
    for k, j in placed.items():
        members[j].add(k)
    for _ in range(4 * shards):
        full, empty = max(range(shards), key=lambda j: (load[j], j)), min(range(shards), key=lambda j: (load[j], j))
        gap = load[full] - load[empty]
        fit = [k for k in members[full] if 0 < sizes[k] < gap]
        if not fit:
            break
        k = min(fit, key=lambda k: (abs(gap - 2 * sizes[k]), k))
        members[full].discard(k)
        members[empty].add(k)
        placed[k] = empty
        load[full] -= sizes[k]
        load[empty] += sizes[k]
    return placed


def plan_transfers(rows: DataFrame, shards: int, capacities: list[float] | None = None) -> Plan:
    """The plan for rows ``(old, block, part, bytes)``; equal capacities unless others are given.

    Blocks above a quarter of the mean capacity are split into parts; there are at most 4 * ``shards`` of those.
    Only block sizes reach the driver, their number is fixed by the settings.
    """
    whole = {(r["old"], r["block"]): (r["n"], r["c"]) for r in
             rows.groupBy("old", "block").agg(F.sum("bytes").alias("n"), F.count("*").alias("c")).collect()}
    total = sum(n for n, _ in whole.values())
    shares = capacities or [total / shards] * shards
    large = sorted(k for k, (n, _) in whole.items() if n > total / shards / 4)
    sizes = {(*k, -1): n for k, (n, _) in whole.items() if k not in set(large)}
    if large:
        test = F.lit(False)
        for old, block in large:
            test = test | ((F.col("old") == old) & (F.col("block") == block))
        for r in rows.where(test).groupBy("old", "block", "part").agg(F.sum("bytes").alias("n")).collect():
            sizes[r["old"], r["block"], r["part"]] = r["n"]
    olds = sorted({k[0] for k in whole})
    supply = [sum(n for k, (n, _) in whole.items() if k[0] == o) for o in olds]
    scale = total / sum(shares) if sum(shares) else 1.0
    flow = cheapest_flow(supply, [s * scale for s in shares], lambda i, j: 0.0 if olds[i] == j else 1.0)
    placed = _place(sizes, {(olds[i], j): f for (i, j), f in flow.items()}, [s * scale for s in shares])
    moved = sum(n for k, n in sizes.items() if placed[k] != k[0])
    return Plan(placed, large, moved, sum(c for _, c in whole.values()), total)


def blocked(docs: DataFrame, old: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``rs_old``, ``rs_block``, ``rs_part``, ``rs_bytes``. A NULL text has no bytes; each row counts one more.
    Columns with those names, and later ``shard`` and ``slot``, are replaced; others pass through.

    Equal texts of an old shard share a block, and so stay together unless their block has to be split.
    """
    return docs.withColumns({
        "rs_old": old.cast("int"),
        "rs_block": F.pmod(F.xxhash64(F.col(text)), F.lit(BLOCKS)).cast("int"),
        "rs_part": F.pmod(F.xxhash64(F.col(key), F.lit("part")), F.lit(PARTS)).cast("int"),
        "rs_bytes": F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1,
    })


def assigned(rows: DataFrame, plan: Plan, out: str = "shard") -> DataFrame:
    """Rows of ``blocked`` with their new shard. The plan's table is bounded by its settings, so it is broadcast."""
    spark = rows.sparkSession
    table = spark.createDataFrame([(*k, j) for k, j in plan.placed.items()],
                                  f"rs_o int, rs_b int, rs_p int, `{out}` int")
    test = F.lit(False)
    for o, b in plan.split:
        test = test | ((F.col("rs_old") == o) & (F.col("rs_block") == b))
    part = F.when(test, F.col("rs_part")).otherwise(F.lit(-1))
    joined = rows.drop(out).join(F.broadcast(table), (F.col("rs_old") == F.col("rs_o")) & (F.col("rs_block") == F.col("rs_b"))
                       & (part == F.col("rs_p")))
    return joined.drop("rs_o", "rs_b", "rs_p")


def with_slots(rows: DataFrame, n_rows: int, order: list[str], shard: str = "shard", out: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without a gap.

    Rows are dealt to parts of about ``SLOT_ROWS`` by a hash of ``order``; a part's numbers start after those of the
    parts before it. Rows equal in ``order`` are numbered in any order.
    """
    parts = max(1, n_rows // SLOT_ROWS) * 4
    dealt = rows.withColumn("rs_slot_part", F.pmod(F.xxhash64(*order, F.lit("slot")), F.lit(parts)).cast("int"))
    before = Window.partitionBy("rs_s").orderBy("rs_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(F.col(shard).alias("rs_s"), F.col("rs_slot_part").alias("rs_p")).agg(F.count("*").alias("rs_n"))
    starts = starts.select("rs_s", "rs_p", F.coalesce(F.sum("rs_n").over(before), F.lit(0)).alias("rs_start"))
    own = F.row_number().over(Window.partitionBy(shard, "rs_slot_part").orderBy(*order))
    joined = dealt.withColumn("rs_own", own).join(
        starts, (F.col(shard) == F.col("rs_s")) & (F.col("rs_slot_part") == F.col("rs_p")))
    return joined.withColumn(out, F.col("rs_start") + F.col("rs_own") - 1).drop(
        "rs_s", "rs_p", "rs_start", "rs_own", "rs_slot_part")


def write_layout(rows: DataFrame, path: str, key: str = "doc_id", text: str = "text", files: int | None = None) -> T.StructType:
    """Write rows with a column ``shard`` as a table partitioned by it, about ``files`` files a shard; its schema.

    Rows are dealt to files by key and text, so neither a NULL key nor a text with many copies fills one file. Without
    ``files`` nothing is shuffled and each task writes a file for every shard it has rows of.
    """
    columns = [c for c in rows.columns if c != "shard"]
    dealt = rows.select(*columns, F.col("shard").cast("int"))
    if files is not None:
        dealt = dealt.repartition("shard", F.pmod(F.xxhash64(key, text), F.lit(files)))
    dealt.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return dealt.schema


def rewrite(spark: SparkSession, source: str, target: str, plan: Plan, key: str = "doc_id", text: str = "text",
            schema: T.StructType | None = None) -> DataFrame:
    """Carry out a plan on a table partitioned by ``shard``: only affected shards are read and written anew, to
    ``target``. Returns ``(shard, folder)``: where each shard's files now are. Unaffected shards keep theirs.

    An empty table has no files to take its ``schema`` from; give it then.
    """
    affected = sorted(plan.affected())
    table = (spark.read.schema(schema) if schema else spark.read).parquet(source)
    rows = table.where(F.col("shard").isin(affected) if affected else F.lit(False))
    rows = blocked(rows.withColumnRenamed("shard", "rs_was"), F.col("rs_was"), key, text)
    columns = [c for c in table.columns if c != "shard"]
    files = max(4, -(-plan.bytes // (FILE_BYTES * max(1, len(affected)))))
    write_layout(assigned(rows, plan).select(*columns, "shard"), target, key, text, files)
    places = {j: target if j in affected else source for j in {*plan.placed.values()}}
    return spark.createDataFrame(sorted(places.items()), "shard int, folder string")


def read_layout(spark: SparkSession, places: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of a table whose shards lie where ``rewrite`` says; one row per shard reaches the driver."""
    folders: dict[str, list[int]] = {}
    for r in places.collect():
        folders.setdefault(r["folder"], []).append(r["shard"])
    rows = spark.createDataFrame([], schema)
    for folder, own in sorted(folders.items()):
        rows = rows.unionByName(spark.read.schema(schema).parquet(folder).where(F.col("shard").isin(own)))
    return rows


#: The layout the query starts from: so many shards by hash of the text.
OLD_SHARDS = 6


def digest(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Documents in files of 6 shards, by hash of the text, move to ``shards`` of equal bytes with the fewest bytes moved.

    The old layout is written below the checkpoint folder, planned, rewritten, and the columns are read from the new
    files; both layouts are deleted then. An empty table gives no rows.
    """
    spark = docs.sparkSession
    old = F.pmod(F.xxhash64("text", F.lit("old")), F.lit(OLD_SHARDS)).cast("int")
    source, target = scratch_path(spark, "old-shards"), scratch_path(spark, "new-shards")
    schema = write_layout(docs.select("doc_id", "text", old.alias("old_shard"), old.alias("shard")), source)
    before = blocked(spark.read.schema(schema).parquet(source), F.col("shard"))
    plan = plan_transfers(before.select(*[F.col(f"rs_{c}").alias(c) for c in ("old", "block", "part", "bytes")]), shards)
    files = read_layout(spark, rewrite(spark, source, target, plan, schema=schema), schema)
    slim = written(files.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), "shard", "old_shard"), "sharded")
    remove_path(spark, source)
    remove_path(spark, target)
    placed = with_slots(slim, plan.rows, ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "old_shard")
