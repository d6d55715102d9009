"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Equal texts are one group. Groups, largest first, go to the bin with the least free place that still holds them; a balanced
search tree of the free places finds it. A fixed capacity gives as few shards as that rule needs; a fixed number of shards
is the same rule with the least capacity for which that many bins suffice, found by halving; then the last bins are levelled.

Packing is a sequence by nature, so no task gets more than a bounded number of items: while there are more, items are dealt
into cells at random (by hash), every cell packs its own into bundles of two to sixteen mean items, and the bundles are the
items of the next round, until at most four cells' worth, and at least two, is left for the last task. Places of rows in a
shard follow from counts: rows before the part of the table, before the group in its bundle, before the bundle in the next.
Style: DataFrame, pandas per cell for the tree.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from changeflow.llm.common import stage

SHARDS = 24
CELL, BUNDLE = 4096, 16
ROW_BYTES = 8


class FreePlaces:
    """Balanced search tree (AA tree) of (free place, bin)."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, level, left, right]

    @staticmethod
    def _skew(node: list) -> list:
        left = node[2]
        if left is not None and left[1] == node[1]:
            node[2], left[3] = left[3], node
            return left
        return node

    @staticmethod
    def _split(node: list) -> list:
        right = node[3]
        if right is not None and right[3] is not None and right[3][1] == node[1]:
            node[3], right[2] = right[2], node
            right[1] += 1
            return right
        return node

    def _add(self, node: list | None, key: tuple) -> list:
        if node is None:
            return [key, 1, None, None]
        side = 2 if key < node[0] else 3
        node[side] = self._add(node[side], key)
        return self._split(self._skew(node))

    def add(self, key: tuple) -> None:
        self.root = self._add(self.root, key)

    def _remove(self, node: list, key: tuple) -> list | None:
        if key == node[0]:
            if node[2] is None and node[3] is None:
                return None
            side, inner = (3, 2) if node[2] is None else (2, 3)
            near = node[side]
            while near[inner] is not None:
                near = near[inner]
            node[0] = near[0]
            node[side] = self._remove(node[side], near[0])
        else:
            side = 2 if key < node[0] else 3
            node[side] = self._remove(node[side], key)
        low = 1 + min(node[2][1] if node[2] else 0, node[3][1] if node[3] else 0)
        if low < node[1]:
            node[1] = low
            if node[3] is not None and node[3][1] > low:
                node[3][1] = low
        node = self._skew(node)
        if node[3] is not None:
            node[3] = self._skew(node[3])
            if node[3][3] is not None:
                node[3][3] = self._skew(node[3][3])
        node = self._split(node)
        if node[3] is not None:
            node[3] = self._split(node[3])
        return node

    def remove(self, key: tuple) -> None:
        self.root = self._remove(self.root, key)

    def tightest(self, size: int) -> tuple | None:
        """The smallest entry with a free place of ``size`` or more."""
        node, best = self.root, None
        while node is not None:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        return best


def best_fit_decreasing(sizes: Sequence[int], capacity: int, bins: int | None = None) -> list[int] | None:
    """The bin of each size; ``sizes`` do not increase. A size over the capacity has a bin of its own. None if more than ``bins``
    are needed."""
    free, out, n = FreePlaces(), [], 0
    for size in sizes:
        best = free.tightest(size)
        if best is None:
            if n == bins:
                return None
            best = (max(capacity, size), n)
            n += 1
        else:
            free.remove(best)
        out.append(best[1])
        if best[0] > size:
            free.add((best[0] - size, best[1]))
    return out


def even_bins(sizes: Sequence[int], bins: int) -> list[int]:
    """Bins of near equal sums: the least capacity at which best fit needs no more than ``bins``. A size of more than a fair share
    of what is left has its bin to itself."""
    total, alone = sum(sizes), 0
    while alone < bins - 1 and alone < len(sizes) and sizes[alone] * (bins - alone) > total:
        total -= sizes[alone]
        alone += 1
    rest, n = sizes[alone:], bins - alone
    if not rest:
        return list(range(alone))
    low, high, found = max(-(-total // n), rest[0]), 2 * (total // n + rest[0]), None
    while low < high:
        middle = (low + high) // 2
        tried = best_fit_decreasing(rest, middle, n)
        if tried is None:
            low = middle + 1
        else:
            high, found = middle, tried
    found = best_fit_decreasing(rest, high, n) if found is None else found
    return [*range(alone), *(alone + b for b in levelled(rest, found, n))]


def levelled(sizes: Sequence[int], found: list[int], bins: int) -> list[int]:
    """Best fit leaves the spare places in its last bins: items of about half the difference go from the fullest bin to the
    emptiest while that brings the two nearer."""
    held: list[list[tuple[int, int]]] = [[] for _ in range(bins)]
    for i, b in enumerate(found):
        held[b].append((sizes[i], i))
    sums = [sum(size for size, _ in own) for own in held]
    held = [sorted(own) for own in held]
    for _ in range(64 * bins):
        most, least = max(range(bins), key=sums.__getitem__), min(range(bins), key=sums.__getitem__)
        at = bisect_right(held[most], ((sums[most] - sums[least]) // 2, len(sizes))) - 1
        if at < 0 or held[most][at][0] == 0:
            break
        item = held[most].pop(at)
        insort(held[least], item)
        sums[most] -= item[0]
        sums[least] += item[0]
        found[item[1]] = least
    return found


def _in_cells(items: DataFrame, cells: int, seed: int, capacity: int | None, bins: int | None) -> DataFrame:
    """Packs each cell on its own: (item, bin, before), ``before`` being the rows in front of the item in its bin."""

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "item"], ascending=[False, True])
        sizes = rows["size"].tolist()
        found = even_bins(sizes, bins) if bins else best_fit_decreasing(sizes, capacity)
        rows["bin"] = [(int(c) << 32) + b for c, b in zip(rows["cell"], found, strict=True)]
        rows["before"] = rows.groupby("bin")["rows"].cumsum() - rows["rows"]
        return rows[["item", "bin", "before", "size", "rows"]]

    dealt = items.withColumn("cell", F.pmod(F.xxhash64(F.lit(seed), "item"), F.lit(cells)))
    return stage(dealt.groupBy("cell").applyInPandas(fill, "item binary, bin long, before long, size long, rows long"), "bins")


def placed(items: DataFrame, shards: int | None, capacity: int | None, cell: int = CELL, bundle: int = BUNDLE, seed: int = 7) -> DataFrame:
    """(item, shard, before) of ``items`` (item, size, rows), for ``shards`` bins or bins of ``capacity``."""
    rounds = []
    while True:
        n, total = items.agg(F.count("*"), F.sum("size")).first()
        if n <= 4 * cell:
            break
        room = total // max(n // bundle, 2 * cell)
        if capacity is not None and bundle * room > capacity:
            break
        packed = _in_cells(items, -(-n // cell), seed + len(rounds), room, None)
        rounds.append(packed)
        as_item = F.unhex(F.lpad(F.hex("bin"), 16, "0"))
        items = packed.groupBy("bin").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows")).select(as_item.alias("item"), "size", "rows")
        items = stage(items, "items")
    last = _in_cells(items, 1 if shards else max(1, -(-n // cell)), seed + len(rounds), capacity, shards)
    out = last.select("item", F.col("bin").alias("shard"), "before")
    for packed in reversed(rounds):
        above = out.select(F.conv(F.hex("item"), 16, 10).cast("long").alias("bin"), "shard", F.col("before").alias("more"))
        out = packed.join(above, "bin").select("item", "shard", (F.col("before") + F.col("more")).alias("before"))
    return out


def assign_shards(docs: DataFrame, shards: int | None = SHARDS, capacity: int | None = None, doc_id: str = "doc_id", text: str = "text", **pack: int) -> DataFrame:
    """(doc_id, size, text_crc32, digest, shard, slot), a row per row of ``docs``: ``shards`` shards of near equal bytes, or, with
    ``shards`` None, as few of ``capacity`` bytes as best fit needs (then ``shard`` is a number, not counted without gaps).

    ``size`` is the bytes of the text (null: none) plus 8. Rows of equal text (null equals empty) share a shard; a group larger
    than a shard's share has one to itself, and the others share the rest. ``slot`` counts the rows of a shard from 0 without
    gaps; rows of a group are neighbours. ``digest`` (SHA-256 of the text) names the group. Ids may be missing or repeat. An
    empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stage(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("digest"), F.monotonically_increasing_id().alias("row")), "rows")
    rows = rows.withColumn("part", F.shiftright("row", 33))
    # a group is a row for each part of the table that has it, so a hot group meets in no task
    parts = stage(rows.groupBy("digest", "part").agg(F.count("*").alias("rows"), F.sum("size").alias("size")), "parts")
    items = stage(parts.groupBy(F.col("digest").alias("item")).agg(F.sum("size").alias("size"), F.sum("rows").alias("rows")), "items")
    groups = placed(items, shards, capacity, **pack).withColumnRenamed("item", "digest")
    ahead = Window.partitionBy("digest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.select("digest", "part", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("ahead"))
    first = first.join(groups, "digest").select("digest", "part", "shard", (F.col("before") + F.col("ahead")).alias("first"))
    inside = F.row_number().over(Window.partitionBy("digest", "part").orderBy("row")) - 1
    return rows.withColumn("inside", inside).join(first, ["digest", "part"]).select(
        "doc_id", "size", "text_crc32", "digest", "shard", (F.col("first") + F.col("inside")).alias("slot"))


def write_shards(docs: DataFrame, path: str, files: int = 8, text: str = "text", **how) -> None:
    """Write the rows of ``docs``, columns unchanged, as Parquet below ``path``, one folder ``_shard=n`` a shard, about ``files`` files
    in each. Groups stay whole; a group of copies is spread over its shard's files."""
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    shards = stage(assign_shards(docs, text=text, **how).groupBy(F.col("digest").alias("_digest")).agg(F.min("shard").alias("_shard")), "shards")
    rows = docs.withColumn("_digest", digest).join(shards, "_digest").drop("_digest")
    rows.repartition("_shard", F.pmod(F.monotonically_increasing_id(), F.lit(files))).write.partitionBy("_shard").parquet(path)
