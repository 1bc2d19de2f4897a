"""Items into containers of fixed capacity, by bin completion.

A search works on sizes and how many items have each. Which sums the sizes from some place on can make is held as bits of
one integer, so the fillings of a container are listed fullest first without ever entering a branch that leads nowhere.
"""

from __future__ import annotations

import bisect
import math
import random
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintara.functions.common import checkpointed, partitions, ship

Sizes = list[tuple[int, int]]  # (size, how many), descending


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each item, largest first, into the fullest container that takes it."""
    bins, room = [], []  # room: (free, bin), ascending
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        k = bisect.bisect_left(room, (sizes[i], -1))
        if k == len(room):
            bins.append([i])
            bisect.insort(room, (capacity - sizes[i], len(bins) - 1))
        else:
            free, b = room.pop(k)
            bins[b].append(i)
            bisect.insort(room, (free - sizes[i], b))
    return bins


def lower_bound(sizes: list[int], capacity: int) -> int:
    """No packing has fewer containers. Items over half a container need one each; for each least size k, what the room
    beside them cannot take of the items from k to a half, where only those that leave k or more have room."""
    n = Counter(sizes)
    large = sorted(s for s in n if 2 * s > capacity)
    room = [0]  # beside the least large ones
    for s in large:
        room.append(room[-1] + (capacity - s) * n[s])
    alone, small, best = sum(n[s] for s in large), 0, math.ceil(sum(sizes) / capacity)
    for k in sorted((s for s in n if 2 * s <= capacity), reverse=True):
        small += k * n[k]
        best = max(best, alone + math.ceil((small - room[bisect.bisect_right(large, capacity - k)]) / capacity))
    return max(best, alone)


def reachable(counts: Sizes, room: int) -> list[int]:
    """For each place the sums up to room that the sizes from there on can make, as bits."""
    mask, out = (1 << (room + 1)) - 1, [1] * (len(counts) + 1)
    for k in range(len(counts) - 1, -1, -1):
        (size, n), sums, step = counts[k], out[k + 1], 1
        n = min(n, room // size)
        while n > 0:
            t = min(step, n)
            sums |= sums << size * t & mask
            n, step = n - t, 2 * step
        out[k] = sums
    return out


def fillings(counts: Sizes, room: int, least: int = 0) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(sum, [(place, items)]) of every choice of items with a sum of least to room: fullest first, then those of larger
    items."""
    reach = reachable(counts, room)
    for total in range(reach[0].bit_length() - 1, max(least, 0) - 1, -1):
        if not reach[0] >> total & 1:
            continue
        path: list[tuple[int, int, int]] = []  # place, items, sum still needed before them
        k, need = 0, total
        while True:
            while need:
                size, n = counts[k]
                t = min(n, need // size)
                while t and not reach[k + 1] >> (need - size * t) & 1:
                    t -= 1
                if t:
                    path.append((k, t, need))
                    need -= size * t
                k += 1
            yield total, [(p, t) for p, t, _ in path]
            while path:
                k, t, need = path.pop()
                size = counts[k][0]
                t -= 1
                while t and not reach[k + 1] >> (need - size * t) & 1:
                    t -= 1
                if t:
                    path.append((k, t, need))
                    need -= size * t
                if t or reach[k + 1] >> need & 1:
                    k += 1
                    break
            else:
                break


def undominated(counts: Sizes, way: list[tuple[int, int]], room: int) -> bool:
    """Whether no item left out could take the place of some of the filling's items, of a sum no greater than its own size,
    within the room: such an item leaves the others, or smaller ones, for where it would have gone. A filling to which an
    item can be added is dominated; one item in place of an equal one is the same filling."""
    sums, several, used = 1, 0, 0  # sums of any of its items; of two at least
    for k, t in way:
        size = counts[k][0]
        used += size * t
        for _ in range(t):
            several |= several << size | (sums & ~1) << size
            sums |= sums << size
    took, out = dict(way), 0
    for k, (size, n) in enumerate(counts):
        if n > took.get(k, 0):
            out |= 1 << size
    if several & out:
        return False
    slack = room - used
    if slack:
        wider, have = sums << 1, 1
        while have < slack:
            t = min(have, slack - have)
            wider |= wider << t
            have += t
        if wider & out:
            return False
    return True


class Search:
    """Branch and bound: the container of the largest item left is completed by undominated fillings in turn, and a branch
    ends where its waste leaves no solution better than the incumbent."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity, self.total = sizes, capacity, sum(sizes)
        self.bound = lower_bound(sizes, capacity)
        self.best = [[sizes[i] for i in b] for b in best_fit(sizes, capacity)]
        self.nodes = 0

    @property
    def done(self) -> bool:
        return len(self.best) <= self.bound

    def ways(self, left: Counter, waste: int, look: int, rng: random.Random | None) -> tuple[list[list[int]], bool]:
        """Containers of the largest item left, from the first `look` fillings, and whether those are all. The very first
        is never dominated: an item put for others would make a fuller one or an equal one of larger items."""
        first, capacity = max(left), self.capacity
        room = capacity - first
        counts = sorted(((s, n - (s == first)) for s, n in left.items() if s <= room and n > (s == first)), reverse=True)
        spare = (len(self.best) - 1) * capacity - self.total - waste  # what may still be wasted
        listed = list(islice(fillings(counts, room, room - spare), look))
        got = [(total, way) for total, way in listed if undominated(counts, way, room)]
        if rng and got:
            alike = sum(total == got[0][0] for total, _ in got)  # equally full
            got[:alike] = rng.sample(got[:alike], alike)
        return [[first, *(s for k, t in way for s in [counts[k][0]] * t)] for _, way in got], len(listed) < look

    def run(self, budget: float, look: int, rng: random.Random | None = None, exact: bool = False) -> None:
        """Depth first, for so many containers tried. exact: a node whose listed fillings failed looks at more, to the last."""
        left, boxes, waste = Counter(self.sizes), [], 0
        stack = [[*self.ways(left, 0, look, rng), look, 0]] if left else []  # containers, whether all, looked at, next
        spent = 0
        while stack and not self.done:
            node = stack[-1]
            if node[3] >= len(node[0]) and exact and not node[1]:
                node[2] *= 4
                node[0], node[1] = self.ways(left, waste, node[2], None)
            if node[3] < len(node[0]) and spent < budget:
                box = node[0][node[3]]
                node[3] += 1
                if waste + self.capacity - sum(box) > (len(self.best) - 1) * self.capacity - self.total:
                    continue
                spent += 1
                boxes.append(box)
                waste += self.capacity - sum(box)
                left.subtract(box)
                for s in box:
                    if not left[s]:
                        left.pop(s, None)
                if left:
                    stack.append([*self.ways(left, waste, look, rng), look, 0])
                    continue
                self.best = [*boxes]
                stack.append([[], True, look, 0])
                continue
            if spent >= budget:
                break
            stack.pop()
            if boxes:
                box = boxes.pop()
                waste -= self.capacity - sum(box)
                left.update(box)
        self.nodes += spent


def bin_completion(sizes: list[int], capacity: int, dives: int = 3, look: int = 64, exact: bool = False) -> list[list[int]]:
    """Containers as lists of positions; sizes from 1 to capacity.

    Best fit is the first incumbent. Each of `dives` searches may try as many containers as one and a half solutions, so
    each can reach one: the first takes the fullest filling of the largest items, the others look at more and take equally
    full ones in an order of their own (fixed seeds). The search ends at the lower bound. exact: then a search without any budget over all
    undominated fillings, which ends with a smallest packing however long it takes.
    """
    search = Search(sizes, capacity)
    for k in range(dives):
        if search.done:
            break
        search.run(1.5 * len(search.best), look if k else 1, random.Random(k) if k else None)
    if exact and not search.done:
        search.run(math.inf, look, exact=True)
    places = defaultdict(list)
    for i in range(len(sizes) - 1, -1, -1):
        places[sizes[i]].append(i)
    return [[places[s].pop() for s in box] for box in search.best]


def pack(items: DataFrame, capacity: int, key: str = "doc_id", size: str = "n_tokens", group: int = 512, rounds: int = 3, full: float = 0.99, exact: bool = False) -> DataFrame:
    """(key, part, begin, n_tokens, container): where each item goes; begin counts within the item.

    An item over the capacity is cut into parts of the capacity, each a container of its own, and a rest that is packed
    as an item; no other item is cut. An item of size 0 or null goes into a container too and takes nothing. Sums never
    exceed the capacity. Every row of items comes out, repeated and null keys as well. Capacity below 1 raises ValueError.

    Items go to groups of about `group` containers' worth by hash, so that no task sees more, whatever the input's size.
    Each group is packed alone; containers less than `full` are opened again and packed with those of other groups in
    the next round, until there is one group or after so many rounds. No row goes to the driver, only sums. exact: each
    group's packing is the smallest there is, however long the proof takes; with one group that holds for all items.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    ship(items.sparkSession)
    tasks = partitions(items)  # by number: groups are few bytes but much work, and would be merged by bytes
    kind = items.schema[key].dataType.simpleString()
    n = F.coalesce(F.col(size).cast("bigint"), F.lit(0))
    parts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(n / capacity) - 1, F.lit(0).cast("bigint")))
    cut = items.select(F.col(key).alias("key"), n.alias("n"), F.monotonically_increasing_id().alias("row"), F.explode(parts).alias("part"))
    cut = checkpointed(cut.select("row", "key", "part", (F.col("part") * capacity).alias("begin"), F.least(F.lit(capacity).cast("bigint"), F.col("n") - F.col("part") * capacity).alias("n")))
    whole = cut.where(F.col("n") == capacity).withColumn("container", F.concat(F.lit("w"), F.col("row"), F.lit("-"), F.col("part")))
    done, open_ = [whole], cut.where(F.col("n") < capacity)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "row", "part"], ascending=[False, True, True], kind="stable", ignore_index=True)
        sizes = pdf["n"].tolist()
        some = [x for x in sizes if x]
        boxes = bin_completion(some, capacity, exact=exact) or [[]]
        where, used = [0] * len(sizes), [sum(some[i] for i in b) for b in boxes]
        for b, box in enumerate(boxes):
            for i in box:
                where[i] = b
        return pdf.assign(box=where, used=[used[b] for b in where])

    for k in range(rounds):
        total, count = open_.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
        if not count:
            break
        groups = max(1, math.ceil(total / (capacity * group)), math.ceil(count / (16 * group)))
        at = F.pmod(F.xxhash64("row", "part", F.lit(k)), F.lit(groups))
        packed = open_.withColumn("grp", at).repartition(min(groups, tasks), "grp").groupBy("grp").applyInPandas(run, f"row bigint, key {kind}, part bigint, begin bigint, n bigint, grp bigint, box bigint, used bigint")
        packed = checkpointed(packed.withColumn("container", F.concat_ws("-", F.lit(f"r{k}"), "grp", "box")))
        last = groups == 1 or k == rounds - 1
        kept = packed if last else packed.where(F.col("used") >= full * capacity)
        done.append(kept.select(*whole.columns))
        if last:
            break
        open_ = packed.where(F.col("used") < full * capacity).select("row", "key", "part", "begin", "n")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(F.col("key").alias(key), "part", "begin", F.col("n").alias("n_tokens"), "container")
