"""Sharding by balanced label propagation.

Linked documents move towards the shards of their neighbours, round by round, as
long as the target has room or can make some:

1. Start: every document picks a shard by the hash of its id.
2. Round: join each node with its neighbours' shards, count them, and propose the
   shard with most neighbours if it beats the present one.  A hash bit of the round
   halves the nodes, so that two nodes don't swap places for ever; the second half
   is tried when nothing of the first one can move.
3. Quotas: proposals are summed by target shard, gain and a hash slice (a table of
   bounded size); each target admits them from the highest gain on.  Where its
   capacity is used up, hash slices of unlinked documents leave it for the emptiest
   shard.  A slice that finds no room even so is left out.
4. Rounds end when nothing can be admitted, first by coarse and then by fine slices.
5. Gathering: a group (all that is linked, over any number of links) that is still
   in several shards goes whole to the one that holds most of it.  Groups of more
   than an eighth of a shard (at most 8 a shard) are packed there by size.
6. Evening out: sizes are summed by shard and hash slice of the unit (bounded), and
   slices go from the fullest to the emptiest shard while that narrows the gap;
   unlinked slices go first.  A group is one unit, so no link is cut.

The law is ``bytes``: sizes near equal.  Only a group heavier than the mean shard,
or one that finds no shard beside other groups of more than an eighth, is split; its
documents are units of their own.  Links of the query are equal texts, each copy
with the smallest id; rows that share an id tie their texts together.

Rows: null text has size 1 and the crc32 of nothing; null texts are not linked with
anything.  Rows of equal id and text get the same shard and neighbouring slots.
Rows with null ids are sharded by their text.  Empty tables give no rows.  Other
columns stay unread.
"""

from __future__ import annotations

from bisect import bisect_right, insort

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardmart.llm.common import Scratch
from cardmart.llm.neardup import components

SHARDS = 8
SLICES = 4096        # hash slices of the units of a shard
ADMISSION = (64, 4096)  # hash slices of the proposals of one target and gain, coarse and fine
SLACK = 0.05         # capacity above the mean size while labels move; evening out takes it back
HEAVY = 8            # groups above this part of a shard are packed one by one


def _hash(column: str | Column, salt: int, n: int) -> Column:
    return F.pmod(F.xxhash64(column if isinstance(column, Column) else F.col(column), F.lit(salt)), F.lit(n)).cast("int")


class Quotas:
    """Loads of the shards, and the slices of unlinked documents that can make room.

    ``spare``: (shard, slice, size).  ``moved``: present shard of each slice that left its own.
    """

    def __init__(self, loads: list[int], spare: list[tuple[int, int, int]], slack: float):
        self.loads, self.capacity = loads, sum(loads) / len(loads) * (1 + slack)
        self.spare: list[list] = [[] for _ in loads]
        for shard, piece, size in sorted(spare, key=lambda x: (x[2], x[1])):
            self.spare[shard].append((size, shard, piece))
        self.free = [sum(x[0] for x in have) for have in self.spare]
        self.moved: dict[tuple[int, int], int] = {}

    def _shift(self, piece: tuple[int, int, int], at: int, to: int) -> None:
        for shard, size in ((at, -piece[0]), (to, piece[0])):
            self.loads[shard] += size
            self.free[shard] += size
        self.spare[to].append(piece)
        self.moved[piece[1:]] = to

    def admit(self, size: int, at: int, to: int) -> bool:
        """Move ``size`` of linked documents, if ``to`` has room or can make some."""
        loads = self.loads
        if loads[to] + size - self.free[to] > self.capacity:
            return False
        loads[at] -= size
        loads[to] += size
        left = []
        while loads[to] > self.capacity:
            piece = self.spare[to].pop()
            low = min((s for s in range(len(loads)) if s != to), key=lambda s: (loads[s], s))
            left.append((piece, low))
            self._shift(piece, to, low)
            if loads[low] > self.capacity:
                for piece, low in reversed(left):
                    self.spare[low].pop()
                    self._shift(piece, low, to)
                loads[at] += size
                loads[to] -= size
                return False
        return True


def propagate(nodes: DataFrame, links: DataFrame, shards: int, quotas: Quotas, scratch: Scratch | None = None) -> DataFrame:
    """(node, shard) after balanced label propagation, when no admissible move is left.

    ``nodes``: (node, size, shard), only nodes with links need be there; ``links``:
    (a, b), each pair once; ``quotas``: present size of each shard over all
    documents, linked or not (changed in place).
    """
    spark = nodes.sparkSession
    scratch = scratch or Scratch(spark, "propagate")
    both = scratch.cut(links.where("a <> b").select("a", "b").unionByName(
        links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "both")
    now = scratch.cut(nodes, "labels-0")
    kept, i, fine = "labels-0", 0, 0
    while True:
        i += 1
        seen = both.join(now.select(F.col("node").alias("b"), F.col("shard").alias("theirs")), "b")
        votes = seen.groupBy("a", "theirs").agg(F.count(F.lit(1)).alias("votes"))
        best = votes.groupBy("a").agg(
            F.max(F.struct("votes", (-F.col("theirs")).alias("minus"))).alias("top"),
            F.map_from_entries(F.collect_list(F.struct("theirs", "votes"))).alias("by_shard"))  # at most ``shards`` entries
        wish = now.join(best, now["node"] == best["a"]).select(
            "node", "size", "shard", (-F.col("top.minus")).cast("int").alias("to"),
            (F.col("top.votes") - F.coalesce(F.element_at("by_shard", F.col("shard")), F.lit(0))).alias("gain"))
        wish = scratch.cut(wish.where((F.col("to") != F.col("shard")) & (F.col("gain") > 0)).withColumns({
            "level": F.floor(F.log2(F.col("gain"))).cast("int"), "half": _hash("node", 2 * i, 2),
            "fine": _hash("node", 2 * i + 1, ADMISSION[-1])}), f"wish-{i}")
        admitted = []
        for fine in range(fine, len(ADMISSION)):  # once only fine slices are admitted, coarse ones are not tried again
            piece = F.pmod(F.col("fine"), F.lit(ADMISSION[fine])).alias("slice")
            # At most shards * shards * 64 levels * ADMISSION sums for each half.
            sums = wish.groupBy("half", "to", "shard", "level", piece).agg(F.sum("size").alias("size")).collect()
            for half in (1, 0):
                ordered = sorted((r for r in sums if r["half"] == half), key=lambda r: (-r["level"], r["slice"], r["shard"], r["to"]))
                admitted = [(half, r["to"], r["shard"], r["level"], r["slice"]) for r in ordered
                            if quotas.admit(r["size"], r["shard"], r["to"])]
                if admitted:
                    break
            if admitted or not sums:
                break
        if admitted:
            keys = spark.createDataFrame(admitted, "half int, to int, shard int, level int, slice int")
            moved = wish.withColumn("slice", piece).join(F.broadcast(keys), ["half", "to", "shard", "level", "slice"], "left_semi").select(
                "node", F.col("to").alias("next"))
            now = scratch.cut(now.join(moved, "node", "left").select(
                "node", "size", F.coalesce("next", "shard").alias("shard")), f"labels-{i}")
            scratch.drop(kept)
            kept = f"labels-{i}"
        scratch.drop(f"wish-{i}")
        if not admitted:
            return now.select("node", "shard")


def pack(groups: list[tuple[str, int, int]], shards: int, room: float) -> dict[str, int]:
    """Shard of each group (name, size, shard that holds most of it) that finds one with room, from the largest on.

    First a group stays where most of it is; if that leaves one without a shard, all are packed by best fit.
    """
    plans = []
    for stay in (True, False):
        left, plan = [room] * shards, {}
        for name, size, at in sorted(groups, key=lambda g: (-g[1], g[0])):
            fit = [s for s in range(shards) if size <= left[s]]
            if fit:
                to = at if stay and at in fit else min(fit, key=lambda s: (left[s], s != at, s))
                left[to] -= size
                plan[name] = to
        plans.append(plan)
    size_of = {name: size for name, size, _ in groups}
    return max(plans, key=lambda p: sum(map(size_of.get, p)))


def even_out(sums: list[tuple[int, int, int, int]], loads: list[int]) -> list[tuple[int, int, int, int]]:
    """Moves (shard, linked, slice, new shard) that bring the loads together.

    ``sums``: (shard, linked, slice, size).  From the fullest to the emptiest shard
    goes the largest slice that does not exceed half their gap; unlinked first.
    """
    have: list[dict[int, list]] = [{0: [], 1: []} for _ in loads]
    for shard, linked, piece, size in sums:
        have[shard][linked].append((size, piece, shard))
    for h in have:
        h[0].sort()
        h[1].sort()
    moves: dict[tuple[int, int, int], int] = {}
    for _ in range(4 * len(sums)):
        order = sorted(range(len(loads)), key=lambda s: (loads[s], s))
        low, done = order[0], True
        for high in reversed(order[1:]):
            half = (loads[high] - loads[low]) / 2
            for linked in (0, 1):
                if linked and loads[high] - loads[low] <= 0.002 * sum(loads) / len(loads):
                    continue  # not worth cutting links for
                at = bisect_right(have[high][linked], (half, 1 << 60, 0))
                if at:
                    size, piece, home = have[high][linked].pop(at - 1)
                    if size <= 0:
                        continue
                    insort(have[low][linked], (size, piece, home))
                    loads[high] -= size
                    loads[low] += size
                    moves[(home, linked, piece)] = low
                    done = False
                    break
            if not done:
                break
        if done:
            break
    return [(s, k, p, t) for (s, k, p), t in moves.items() if t != s]


def shard_documents(docs: DataFrame, shards: int = SHARDS, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; links are equal texts."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "sharding")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = scratch.cut(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.when(F.col("text").isNotNull(), F.sha2(raw, 256)).alias("text_hash")), "rows")
    # A node is a document id; without one, the text.
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.coalesce("text_hash", F.lit("null"))))
    rows = rows.withColumn("node", name)
    hubs = (rows.where("text_hash is not null").groupBy("text_hash")
            .agg(F.min(F.struct("doc_id", "node")).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
            .select("text_hash", F.col("first.node").alias("hub")))
    linked = scratch.cut(rows.join(hubs, "text_hash").select("node", "hub", "size"), "linked")
    # Hubs that share a node (an id with several texts) are one group, named by the smallest.
    ties = linked.groupBy("node").agg(F.min("hub").alias("low"), F.max("hub").alias("high")).where("low <> high").select("node", "low")
    tied = components(linked.join(ties, "node").where("hub <> low").select(F.col("hub").alias("a"), F.col("low").alias("b")),
                      scratch, "ties").select(F.col("node").alias("hub"), F.col("component").alias("tied"))

    # Size and group of every node that has links; nodes of one id are one, with its unlinked rows.
    members = linked.groupBy("node").agg(F.min("hub").alias("hub")).join(tied, "hub", "left").select(
        "node", F.coalesce("tied", "hub").alias("group"))
    members = scratch.cut(rows.join(members, "node").groupBy("node", "group").agg(F.sum("size").alias("size")).withColumn(
        "shard", _hash("node", 1, shards)), "members")
    alone = (rows.join(members.select("node"), "node", "left_anti").groupBy("node").agg(F.sum("size").alias("size"))
             .withColumns({"shard": _hash("node", 1, shards), "slice": _hash("node", 2, SLICES)}))
    alone = scratch.cut(alone, "alone")
    spare = [tuple(r) for r in alone.groupBy("shard", "slice").agg(F.sum("size")).collect()]  # at most shards * SLICES rows
    loads = [0] * shards
    for shard, _, size in [*spare, *((r[0], 0, r[1]) for r in members.groupBy("shard").agg(F.sum("size")).collect())]:
        loads[shard] += size
    quotas = Quotas(loads, spare, SLACK)
    labels = propagate(members.select("node", "size", "shard"),
                       linked.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), shards, quotas, scratch)

    # Groups go whole to the shard that holds most of them.
    placed = scratch.cut(members.drop("shard").join(labels, "node"), "labelled")
    groups = placed.groupBy("group", "shard").agg(F.sum("size").alias("size")).groupBy("group").agg(
        F.sum("size").alias("group_size"), F.max(F.struct("size", (-F.col("shard")).alias("minus"))).alias("top")).select(
            "group", "group_size", (-F.col("top.minus")).alias("home"))
    groups = scratch.cut(groups, "groups")
    mean = sum(loads) / shards
    large = groups.where(F.col("group_size") > mean / HEAVY).collect()  # at most HEAVY * shards rows, by their weight
    plan = pack([tuple(r) for r in large], shards, mean)
    heavy = F.broadcast(spark.createDataFrame([(r["group"], plan.get(r["group"])) for r in large], "group string, home int"))
    # linked: 0 unlinked, 1 may be moved when sizes are evened out, 2 stays.
    parts = [
        placed.join(groups.where(F.col("group_size") <= mean / HEAVY), "group").select(
            "node", "size", F.col("home").alias("shard"), F.lit(1).alias("linked"), _hash("group", 2, SLICES).alias("slice")),
        placed.join(heavy, "group").select(
            "node", "size", F.coalesce("home", "shard").alias("shard"), F.when(F.col("home").isNull(), 1).otherwise(2).alias("linked"),
            _hash("node", 2, SLICES).alias("slice")),
        alone.select("node", "size", "shard", F.lit(0).alias("linked"), "slice")]
    if quotas.moved:
        went = spark.createDataFrame([(s, p, t) for (s, p), t in quotas.moved.items()], "shard int, slice int, next int")
        parts[2] = alone.join(F.broadcast(went), ["shard", "slice"], "left").select(
            "node", "size", F.coalesce("next", "shard").alias("shard"), F.lit(0).alias("linked"), "slice")
    placed = scratch.cut(parts[0].unionByName(parts[1]).unionByName(parts[2]), "placed")
    sums = placed.groupBy("shard", "linked", "slice").agg(F.sum("size").alias("size")).collect()  # at most 24 * SLICES rows
    loads = [sum(r["size"] for r in sums if r["shard"] == s) for s in range(shards)]
    moves = even_out([(r["shard"], r["linked"], r["slice"], r["size"]) for r in sums if r["linked"] < 2], loads)
    if moves:
        table = spark.createDataFrame(moves, "shard int, linked int, slice int, next int")
        placed = placed.join(F.broadcast(table), ["shard", "linked", "slice"], "left").withColumn(
            "shard", F.coalesce("next", "shard"))
    final = scratch.cut(rows.join(placed.select("node", "shard"), "node").select(
        "doc_id", "size", "text_crc32", "shard", _hash("node", 3, 1024).alias("bin")), "final")
    # Slots without gaps: rows are numbered in bins, and bins of a shard stand one behind the other.
    counts = final.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"))  # at most shards * 1,024 rows
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("bin")) - F.col("n"))
    number = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("doc_id", "text_crc32", "size"))
    return (final.withColumn("number", number).join(F.broadcast(before.drop("n")), ["shard", "bin"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("before") + F.col("number") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
