"""Minimum-cost-flow resharding.

A corpus lies in old shards, each a set of block files.  Given the new shards' capacities, a minimum-cost flow from
old to new shards (staying costs nothing, a moved byte one) says how many bytes go where; no plan moves fewer.  The
flow is cut into ranges of each old shard's bytes, ranges into blocks, and only blocks that move or are cut are
rewritten: all others stay where they are and are read in place.

Rows larger than a fraction of a shard (so few that the driver holds them: HEAVY per shard) are placed one by one
first, so that what the flow cuts are small rows and new shards come out near equal.  A block holds BLOCK_BYTES or
so (more where MOST_BLOCKS of them would not do; the driver holds a number for each), its number comes from a hash of
doc_id and the text's checksum, so no shard, source, doc_id or group of copies meets in one task.

Defined results: a null text has no bytes; a row's size is its UTF-8 bytes plus 8.  Rows with one doc_id and one text
stay in one old shard and block, and go to one new shard if they are large.  Null doc_ids are one such number.  Repeated
rows each have a slot.  An empty table gives no rows.  The law is ``bytes``; slots number a shard's rows by old shard,
block, doc_id and checksum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helicase.llm.common import shared_dir

OLD_SHARDS = 16
NEW_SHARDS = 24
BLOCK_BYTES = 128 << 20
LEAST_BLOCKS = 16
MOST_BLOCKS = 4096  # of an old shard
#: Rows above 1 / HEAVY of a new shard's bytes are placed one by one; there are HEAVY per shard at most.
HEAVY = 200
FRAME_BYTES = 8


def min_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Flow from each supply to each demand (sums equal) at least cost, by successive shortest augmenting paths."""
    m, n = len(supply), len(demand)
    flow = [[0] * n for _ in supply]
    left, need = [*supply], [*demand]
    while any(left) and any(need):
        # Bellman-Ford from all supplies with something left; nodes: 0..m-1 supplies, m.. demands
        dist = [0 if x else None for x in left] + [None] * n
        back = [-1] * (m + n)
        changed = True
        while changed:
            changed = False
            for i in range(m):
                for j in range(n):
                    if dist[i] is not None and (dist[m + j] is None or dist[i] + cost[i][j] < dist[m + j]):
                        dist[m + j], back[m + j], changed = dist[i] + cost[i][j], i, True
                    if flow[i][j] and dist[m + j] is not None and (dist[i] is None or dist[m + j] - cost[i][j] < dist[i]):
                        dist[i], back[i], changed = dist[m + j] - cost[i][j], m + j, True
        _, end = min((dist[m + j], j) for j in range(n) if need[j] and dist[m + j] is not None)
        path, node = [], m + end
        while back[node] >= 0:
            path.append((back[node], node))
            node = back[node]
        amount = min([left[node], need[end], *(flow[b][a - m] for a, b in path if a >= m)])
        for a, b in path:
            if a < m:
                flow[a][b - m] += amount
            else:
                flow[b][a - m] -= amount
        left[node] -= amount
        need[end] -= amount
    return flow


def write_shards(docs: DataFrame, path: str, shards: int = OLD_SHARDS, block_bytes: int = BLOCK_BYTES) -> T.StructType:
    """Lays docs (doc_id, text, others) out as path/old_shard=/block=, with columns size and text_crc32; the layout's schema."""
    raw = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.withColumns({"size": (F.octet_length(raw) + FRAME_BYTES).cast("bigint"), "text_crc32": F.crc32(raw)})
    total = rows.agg(F.sum("size")).first()[0] or 0
    blocks = min(MOST_BLOCKS, max(LEAST_BLOCKS, -(-total // (shards * block_bytes))))
    deal = lambda salt, n: F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit(salt)), F.lit(n)).cast("int")
    rows = rows.withColumns({"old_shard": deal(0, shards), "block": deal(1, blocks)})
    tasks = min(shards * blocks, total // block_bytes)
    by = ("old_shard", "block")
    # beyond the session's number of partitions each block has a task, whatever the setting
    rows = rows.repartition(tasks, *by) if tasks > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows.repartition(*by)
    rows.write.partitionBy(*by).parquet(path)
    return rows.schema


def plan(lights: dict[tuple[int, int], int], heavies: list[tuple[int, tuple, int]], capacity: list[int]) -> tuple[dict, dict, dict]:
    """Where everything goes: shards of heavy rows by key; per old shard the ranges (from, to, shard) of its light
    bytes; per block its first byte in that order.  lights: bytes by (old shard, block); heavies: (old shard, key, size).
    """
    n, load, heavy = len(capacity), [0] * len(capacity), {}
    moving = []
    for shard, key, size in sorted(heavies, key=lambda h: (-h[2], h[0], str(h[1]))):
        if shard < n and load[shard] + size <= capacity[shard]:
            heavy[key] = shard
            load[shard] += size
        else:
            moving.append((key, size))
    for key, size in moving:
        heavy[key] = best = max(range(n), key=lambda j: (capacity[j] - load[j], -j))
        load[best] += size
    base, supply = {}, {}
    for (shard, block), size in sorted(lights.items()):
        base[shard, block] = supply.get(shard, 0)
        supply[shard] = supply.get(shard, 0) + size
    total, room = sum(supply.values()), [max(0, c - x) for c, x in zip(capacity, load, strict=True)]
    if total and not sum(room):
        room = [1] * n
    whole, demand = sum(room), []
    for j in range(n):  # room scaled to what there is, exactly
        demand.append(total * sum(room[: j + 1]) // max(1, whole) - sum(demand))
    shards = sorted(supply)
    flow = min_cost_flow([supply[s] for s in shards], demand, [[int(s != j) for j in range(n)] for s in shards])
    ranges = {}
    for s, row in zip(shards, flow, strict=True):
        at, ranges[s] = 0, []
        for j in sorted(range(n), key=lambda j: (j != s, j)):
            if row[j]:
                ranges[s].append((at, at + row[j], j))
                at += row[j]
    return heavy, ranges, base


def reshard(spark: SparkSession, old: str, new: str, shards: int = NEW_SHARDS, capacity: list[int] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Rewrites what must move from old (as write_shards left it) to new, and returns all rows with their shard.

    capacity: bytes of the new shards (equal if None); scaled if they don't sum to what there is.  schema: that of old, which
    must be given where old may be empty.
    """
    rows = (spark.read.schema(schema) if schema else spark.read).parquet(old)
    total, most = rows.agg(F.sum("size"), F.max("size")).first()
    if total is None:
        return rows.withColumn("shard", F.lit(0))
    capacity = capacity or [total * (j + 1) // shards - total * j // shards for j in range(shards)]
    limit = max(1, min(capacity) // HEAVY)
    is_heavy = F.col("size") > limit
    lights = {(r.old_shard, r.block): r.s for r in rows.where(~is_heavy).groupBy("old_shard", "block").agg(F.sum("size").alias("s")).collect()}
    found = rows.where(is_heavy).groupBy("old_shard", "block", "doc_id", "text_crc32").agg(F.sum("size").alias("s")).collect()
    heavy, ranges, base = plan(lights, [(r.old_shard, (r.doc_id, r.text_crc32), r.s) for r in found], capacity)
    disturbed = {(r.old_shard, r.block) for r in found if heavy[r.doc_id, r.text_crc32] != r.old_shard}
    whole, cut = {}, []
    everywhere = {*lights, *((r.old_shard, r.block) for r in found)}
    for key in everywhere:
        start, stop = base.get(key, 0), base.get(key, 0) + lights.get(key, 0)
        inside = [j for a, b, j in ranges.get(key[0], []) if a <= start and stop <= b] if key in lights else [key[0] if key[0] < shards else 0]
        if inside:
            whole[key] = inside[0]
        else:
            cut.append(key)
    quiet = [k for k, j in whole.items() if j == k[0] and k not in disturbed]
    where = "old_shard int, block int, base bigint, whole int"
    quiet_keys = {*quiet}
    moving_keys = sorted(k for k in everywhere if k not in quiet_keys)
    loud = spark.createDataFrame([(*k, base.get(k, 0), whole.get(k)) for k in moving_keys], where)
    placed = spark.createDataFrame([(*d, j) for d, j in heavy.items()], "heavy_id bigint, heavy_crc bigint, heavy_shard int")
    moving = spark.read.option("basePath", old).parquet(*[f"{old}/old_shard={s}/block={b}" for s, b in moving_keys]) if moving_keys else rows.limit(0)
    columns = [c for c in rows.columns if c not in ("old_shard", "block")]
    moving = moving.join(F.broadcast(loud), ["old_shard", "block"]).join(F.broadcast(placed), is_heavy & F.col("doc_id").eqNullSafe(F.col("heavy_id")) & (F.col("text_crc32") == F.col("heavy_crc")), "left")
    bounds = F.lit([[b for _, b, _ in ranges.get(s, [])] or [0] for s in range(max(s for s, _ in everywhere) + 1)])
    targets = F.lit([[j for _, _, j in ranges.get(s, [])] or [0] for s in range(max(s for s, _ in everywhere) + 1)])

    def written(part: DataFrame, light: Column, mode: str) -> None:
        part.withColumn("shard", F.when(is_heavy, F.col("heavy_shard")).otherwise(light)).select(*columns, "old_shard", "block", "shard").write.mode(mode).partitionBy("shard").parquet(new)

    written(moving.where("whole IS NOT NULL"), F.col("whole"), "append")
    if cut:
        order = Window.partitionBy("old_shard", "block").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32").rowsBetween(Window.unboundedPreceding, 0)
        own = F.when(is_heavy, 0).otherwise(F.col("size"))
        middle = F.col("base") + F.sum(own).over(order) - (own / 2)
        passed = F.size(F.filter(F.get(bounds, F.col("old_shard")), lambda b: b <= middle))
        at = F.get(F.get(targets, F.col("old_shard")), F.least(passed, F.size(F.get(bounds, F.col("old_shard"))) - 1))
        written(moving.where("whole IS NULL"), at, "append")
    parts = []
    if quiet:
        stay = spark.read.option("basePath", old).parquet(*[f"{old}/old_shard={s}/block={b}" for s, b in quiet])
        parts.append(stay.select(*columns, F.col("old_shard").cast("int"), F.col("block").cast("int"), F.col("old_shard").cast("int").alias("shard")))
    if moving_keys:
        parts.append(spark.read.schema(f"{_ddl(rows, columns)}, old_shard int, block int, shard int").parquet(new).select(*columns, "old_shard", "block", "shard"))
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1])


def _ddl(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def slots(rows: DataFrame) -> DataFrame:
    """rows with slot: their gapless number in the shard, without a window over a whole shard."""
    piece = ["shard", "old_shard", "block"]
    before = Window.partitionBy("shard").orderBy("old_shard", "block").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*piece).agg(F.count("*").alias("n")).select(*piece, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy(*piece).orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32")
    return rows.join(sums, piece).withColumn("slot", (F.col("first") + F.row_number().over(inside) - 1).cast("bigint")).drop("first")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    old, new = shared_dir(spark, "shards-old"), shared_dir(spark, "shards-new")
    schema = write_shards(docs, old)
    rows = slots(reshard(spark, old, new, schema=schema).select("doc_id", "size", "text_crc32", "shard", "old_shard", "block"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
