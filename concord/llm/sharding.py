"""Resharding by minimum-cost flow (operator 4).

Rows lie in old shards of any sizes and shall lie in ``shards`` new ones whose
row counts differ by at most one (law ``rows``), moving the fewest bytes. Old
shard k is new shard k, so rows that stay cost nothing. The flow network has
one node per old and new shard: rows stay for nothing, blocks leave an old
shard at a convex cost (its smallest rows go first), each new shard takes the
base count and at most one of the remaining rows. Only counts per shard, and
the size at which each block ends, reach the driver; the solver's work depends
on the number of shards alone.

Planning sees ids, sizes and checksums only; the rows themselves then move once to
meet their places (``filled``) and once into files of their shards (``write_shards``).

Rows of a block go to new shards in order of (old shard, id); all such flows
cost the same. Ranks are taken in two levels (ranges between approximate quantiles
of the ids, then rows inside one range), so no shard is sorted in one task.

Edge cases: a null text has size 1 and the checksum of no bytes; a null old
shard is shard 0; null ids sort first; rows with equal ids are told apart by
checksum and size, and wholly equal rows are interchangeable; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.llm.common import scratch, table, written

SHARDS = 16
OLD_SHARDS = 12
#: Rows per range in two-level ranks, and the most ranges between quantiles of a group.
ID_RANGE = 1 << 14
MOST_RANGES = 256


@dataclass
class Arc:
    to: int
    left: int
    cost: int
    back: int


class Flow:
    """Minimum-cost flow by successive shortest paths (Bellman-Ford, lowest node first)."""

    def __init__(self, nodes: int):
        self.arcs: list[list[Arc]] = [[] for _ in range(nodes)]

    def add(self, a: int, b: int, capacity: int, cost: int) -> tuple[int, int]:
        self.arcs[a].append(Arc(b, capacity, cost, len(self.arcs[b])))
        self.arcs[b].append(Arc(a, 0, -cost, len(self.arcs[a]) - 1))
        return a, len(self.arcs[a]) - 1

    def used(self, arc: tuple[int, int]) -> int:
        x = self.arcs[arc[0]][arc[1]]
        return self.arcs[x.to][x.back].left

    def solve(self, source: int, sink: int) -> int:
        total = 0
        while True:
            far: list[float] = [float("inf")] * len(self.arcs)
            via: list[tuple[int, int] | None] = [None] * len(self.arcs)
            far[source] = 0
            again = True
            while again:
                again = False
                for a, arcs in enumerate(self.arcs):
                    for k, x in enumerate(arcs):
                        if x.left and far[a] + x.cost < far[x.to]:
                            far[x.to], via[x.to], again = far[a] + x.cost, (a, k), True
            if via[sink] is None:
                return total
            path, at = [], sink
            while at != source:
                path.append(via[at])
                at = via[at][0]
            n = min(self.arcs[a][k].left for a, k in path)
            for a, k in path:
                x = self.arcs[a][k]
                x.left -= n
                self.arcs[x.to][x.back].left += n
            total += n * int(far[sink])


def plan(counts: dict[int, int], last_size: dict[int, int], shards: int) -> list[int]:
    """Rows that each new shard shall hold, so that the fewest bytes move.

    ``counts``: rows of each old shard; ``last_size``: for shards above the base
    count, the size of the row that stays if the shard gets one row more.
    """
    rows = sum(counts.values())
    base, extra = divmod(rows, shards)
    old = range(max([shards, *(k + 1 for k in counts)]))
    most = max([1, *last_size.values()]) + 1
    source, sink, spare = 0, 1, 2
    node = {k: 3 + i for i, k in enumerate(old)}
    leave = {k: 3 + len(node) + k for k in old}
    new = {k: 3 + 2 * len(node) + k for k in range(shards)}
    flow = Flow(3 + 2 * len(node) + shards)
    gains = {}
    for k in old:
        n = counts.get(k, 0)
        over = max(0, n - base) if k < shards else n
        flow.add(source, node[k], n, 0)
        if k < shards:
            flow.add(node[k], new[k], n, 0)
            if over:  # the largest row of the block; ties go to the lower shard
                flow.add(node[k], leave[k], 1, last_size.get(k, 1) * shards + shards - 1 - k)
        flow.add(node[k], leave[k], over if k >= shards else max(0, over - 1), 0)
        flow.add(node[k], leave[k], n, most * shards * 2)
        for j in range(shards):
            if j != k:
                flow.add(leave[k], new[j], n, 0)
    for j in range(shards):
        flow.add(new[j], sink, base, 0)
        gains[j] = flow.add(new[j], spare, 1, 0)
    flow.add(spare, sink, extra, 0)
    flow.solve(source, sink)
    kept = [j for j in range(shards) if flow.used(gains[j]) and counts.get(j, 0) > base]
    # what is left over costs the same anywhere: the lowest other shards take it
    rest = [j for j in range(shards) if counts.get(j, 0) <= base][:extra - len(kept)]
    return [base + (j in kept or j in rest) for j in range(shards)]


def ranged(rows: DataFrame, group: str) -> DataFrame:
    """Append _range, which ascends with (id, checksum) in each group.

    Ranges lie between approximate quantiles of the ids; null ids, and an id that is
    several quantiles, are 256 ranges by checksum.
    """
    most = rows.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    parts = min(MOST_RANGES, max(2, -(-most // ID_RANGE)))
    at = [k / parts for k in range(1, parts)]
    # written: quantiles taken again may differ
    bounds = written(rows.groupBy(group).agg(
        F.percentile_approx("doc_id", at).alias("_bounds")), "bounds")
    below = "size(filter(_bounds, b -> b < doc_id))"
    often = "size(filter(_bounds, b -> b = doc_id)) > 1"
    return rows.join(F.broadcast(bounds), group).withColumn("_range", F.expr(f"""
        cast(CASE WHEN doc_id IS NULL THEN -256 + shiftright(text_crc32, 24)
                  WHEN {often} THEN 256 * (2 * {below} + 1) + shiftright(text_crc32, 24)
                  ELSE 512 * {below} END AS bigint)""")).drop("_bounds")


def numbered(rows: DataFrame, group: str, out: str) -> DataFrame:
    """Append the rank from 0 of each row in its group, by (id, checksum, size)."""
    rows = ranged(rows, group)
    sums = rows.groupBy(group, "_range").count()
    before = (sums.withColumn("_before", F.sum("count").over(
        Window.partitionBy(group).orderBy("_range")) - F.col("count")).drop("count"))
    inside = Window.partitionBy(group, "_range").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("_in", F.row_number().over(inside) - 1)
            .join(before, [group, "_range"])
            .withColumn(out, (F.col("_in") + F.col("_before")).cast("long"))
            .drop("_in", "_before", "_range"))


def measured(docs: DataFrame, old_shard: Column, id_col: str = "doc_id",
             text_col: str = "text", kept: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, text_crc32, old) of each row, and the columns kept; all JVM-side."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.coalesce(old_shard.cast("int"), F.lit(0)).alias("old"), *kept)


def index_of(bounds: list[int], value: str) -> Column:
    """Number of bounds that are not above the value."""
    array = ", ".join(f"{b}L" for b in bounds)
    return F.expr(f"size(filter(array({array}), b -> b <= {value}))")


def reshard(measured_rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Append shard, slot and moved: the new place of every row."""
    rows = written(measured_rows, "sized")
    sizes = written(rows.groupBy("old", "size").count(), "sizes")
    counts = {r.old: r.n for r in sizes.groupBy("old").agg(F.sum("count").alias("n")).collect()}
    total = sum(counts.values())
    base = total // shards
    up_to = sizes.withColumn("n", F.sum("count").over(
        Window.partitionBy("old").orderBy("size")))  # one row per size: bounded by text lengths
    goal = F.create_map(*(F.lit(x) for k, n in sorted(counts.items())
                          for x in (k, n - base))) if counts else F.lit(None)

    def size_at(leaving: Column) -> dict[int, int]:
        return {r.old: r.size for r in up_to.filter(F.col("n") >= leaving)
                .groupBy("old").agg(F.min("size").alias("size")).collect()}

    over = {k: n - base for k, n in counts.items() if n > base and k < shards}
    last = {k: v for k, v in (size_at(goal[F.col("old")]) if over else {}).items() if k in over}
    want = plan(counts, last, shards)
    leave = {k: n - (want[k] if k < shards else 0) for k, n in counts.items()}
    leave = {k: n for k, n in leave.items() if n > 0}
    if not leave:
        placed = rows.withColumns({"shard": F.col("old"), "moved": F.lit(False)})
        return numbered(placed, "shard", "slot")
    amounts = F.create_map(*(F.lit(x) for k, n in sorted(leave.items()) for x in (k, n)))
    limit = size_at(amounts[F.col("old")])
    below = {r.old: r.n for r in up_to.groupBy("old").agg(F.lit(0).alias("n")).collect()}
    limits = F.create_map(*(F.lit(x) for k in sorted(leave) for x in (k, limit[k])))
    below |= {r.old: r.n for r in up_to.filter(F.col("size") < limits[F.col("old")])
              .groupBy("old").agg(F.max("n").alias("n")).collect()}
    need = F.create_map(*(F.lit(x) for k in sorted(leave) for x in (k, leave[k] - below[k])))
    at = rows.withColumn("_limit", limits[F.col("old")])
    equal = numbered(at.filter(F.col("size") == F.col("_limit")), "old", "_r")
    going = (at.filter(F.col("size") < F.col("_limit"))
             .unionByName(equal.filter(F.col("_r") < need[F.col("old")]).drop("_r")).drop("_limit"))
    staying = (at.filter(F.col("_limit").isNull() | (F.col("size") > F.col("_limit")))
               .unionByName(equal.filter(F.col("_r") >= need[F.col("old")]).drop("_r")).drop("_limit"))
    offset, begin = {}, 0
    for k in sorted(leave):
        offset[k], begin = begin, begin + leave[k]
    open_, bounds, sum_ = [], [], 0
    for j in range(shards):
        room = want[j] - min(counts.get(j, 0), want[j])
        if room:
            sum_ += room
            open_.append(j)
            bounds.append(sum_)
    offsets = F.create_map(*(F.lit(x) for k in sorted(offset) for x in (k, offset[k])))
    going = numbered(going, "old", "_n").withColumn("_n", F.col("_n") + offsets[F.col("old")])
    names = F.array(*(F.lit(j) for j in open_))
    going = going.withColumn("shard", F.get(names, index_of(bounds, "_n"))).drop("_n")
    placed = (staying.withColumn("shard", F.col("old")).withColumn("moved", F.lit(False))
              .unionByName(going.withColumn("moved", F.lit(True))))
    return numbered(written(placed, "placed"), "shard", "slot")


#: Setting by which a join takes rows as they are dealt by some of its keys.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def filled(docs: DataFrame, placed: DataFrame, old_shard: Column, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """The rows themselves, each with the shard and slot of its place, as a table.

    Rows and places meet by (id, checksum, size), copies in order of their old shards; the
    texts move once for it.
    """
    spark = docs.sparkSession
    keys = ["_id", "_none", "_crc", "_size"]

    def keyed(rows: DataFrame, id_: Column, crc: Column, size: Column, *order: Column) -> DataFrame:
        rows = rows.withColumns({"_id": F.coalesce(id_, F.lit(0)), "_none": id_.isNull(),
                                 "_crc": crc, "_size": size})
        return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumn("_old", F.coalesce(old_shard.cast("int"), F.lit(0)))
    rows = keyed(rows.drop("shard", "slot"), F.col(id_col).cast("long"),
                 F.crc32(text.cast("binary")), F.octet_length(text).cast("long") + 1,
                 F.col("_old"), F.xxhash64(*(c for c, t in docs.dtypes if "map<" not in t)))
    places = keyed(placed, F.col("doc_id"), F.col("text_crc32"), F.col("size"),
                   F.col("old"), F.col("shard"), F.col("slot"))
    before = spark.conf.get(ALL_KEYS, "true")
    spark.conf.set(ALL_KEYS, "false")
    try:
        return written(rows.join(places.select(*keys, "_n", "shard", "slot"), [*keys, "_n"])
                       .drop(*keys, "_n", "_old"), "filled")
    finally:
        spark.conf.set(ALL_KEYS, before)


def write_shards(rows: DataFrame, path: str) -> None:
    """Write ``path/shard=K`` for the shards of the rows, several files a shard, in order of slots."""
    (rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").partitionBy("shard").parquet(path))


def rewrite(docs: DataFrame, path: str, old_shard: Column, shards: int = SHARDS,
            id_col: str = "doc_id", text_col: str = "text") -> list[int]:
    """Write ``path/shard=K`` for the shards whose rows changed; returns their numbers.

    ``path`` may hold the old layout: folders of shards that nothing left or
    entered are not touched (dynamic partition overwrite).
    """
    placed = written(reshard(measured(docs, old_shard, id_col, text_col), shards), "plan")
    moved = placed.filter("moved")
    touched = sorted(r[0] for r in moved.select(F.col("old").alias("k"))
                     .union(moved.select("shard")).distinct().collect())
    out = filled(docs, placed, old_shard, id_col, text_col)
    write_shards(out.filter(F.col("shard").isin([k for k in touched if k < shards])), path)
    return touched


def laid_out(docs: DataFrame, old_shard: Column, shards: int = SHARDS) -> DataFrame:
    """All rows, written to their new shards and read from there, with shard and slot."""
    path = scratch(docs.sparkSession, "shards")
    placed = written(reshard(measured(docs, old_shard), shards), "plan")
    out = filled(docs, placed, old_shard)
    write_shards(out, path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


def op4_min_cost_flow_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` moved from 12 shards by source to 16 of equal row counts; places, sizes
    and checksums are those of the rows in the written shards."""
    docs = table(spark, sf_dir, "documents")
    old = F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % OLD_SHARDS
    rows = laid_out(docs, old)
    return measured(rows, F.col("shard"), kept=("slot",)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("old").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"))
