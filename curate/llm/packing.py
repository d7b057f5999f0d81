"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become pieces of at most `capacity` tokens, and pieces are put into sequences of at most that
many. Full pieces fill a sequence each. The others are dealt into instances of about INSTANCE
pieces, and each instance is solved by several islands: a population of packings that changes by
crossover. A child takes whole well-filled bins of one parent into the other, drops the bins there
that hold a piece twice, and puts the displaced pieces back by best fit. Between epochs the elite
of an island moves on to the next island of its instance. An instance is bounded, so nothing here
grows with the corpus but the number of instances.
"""

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.llm.tokens import ID, encoder
from curate.operators.skew import sendable
from curate.session import written

INSTANCE = 4096
# Epochs end when every instance has as few bins as any packing can, or IDLE epochs have closed no bin, or with MOST_EPOCHS.
ISLANDS, MOST_EPOCHS, IDLE, POPULATION, CHILDREN = 2, 12, 2, 4, 6
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
STATE = "instance long, island int, bins int, least int, items array<long>, lengths array<int>, packings array<array<int>>"


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """The pieces of every document with its closing id: one, or for longer ones the rest first and
    then pieces of exactly `capacity`.

    A NULL text is empty and leaves the closing id alone; a NULL or repeated `doc_id` and repeated rows
    are cut row by row; texts of any length count whole; without rows there are no pieces; other columns are
    not looked at.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        end = np.array([end_id], ID).tobytes()
        for batch in batches:
            names, pieces, starts, lengths, crcs = [], [], [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = encode(text.as_py()) + end
                n = len(ids) // ID.itemsize
                start, stop, piece = 0, n % capacity or capacity, 0
                while start < n:
                    names.append(doc_id)
                    pieces.append(piece)
                    starts.append(start)
                    lengths.append(min(stop, n) - start)
                    crcs.append(zlib.crc32(ids[start * ID.itemsize:stop * ID.itemsize]))
                    start, stop, piece = stop, stop + capacity, piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


class Packing:
    """The pieces of an instance in bins; `where[item]` is the bin of a piece."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: dict[int, list[int]] = {}
        self.free: dict[int, int] = {}
        self.next = 0
        self.where = [-1] * len(lengths)

    @classmethod
    def of(cls, lengths: list[int], capacity: int, where: list[int]) -> "Packing":
        packing = cls(lengths, capacity)
        for item, number in enumerate(where):
            packing.bins.setdefault(number, []).append(item)
        packing.where = list(where)
        packing.next = max(where, default=-1) + 1
        for number, items in packing.bins.items():
            packing.free[number] = capacity - sum(lengths[item] for item in items)
        return packing

    def open(self, items: list[int]) -> None:
        number = self.next
        self.next += 1
        self.bins[number] = items
        self.free[number] = self.capacity - sum(self.lengths[item] for item in items)
        for item in items:
            self.where[item] = number

    def drop(self, number: int) -> list[int]:
        del self.free[number]
        return self.bins.pop(number)

    def best_fit(self, items: list[int]) -> None:
        """Put pieces, the longest first, into the fullest bin that has room, or a new one."""
        lengths, bins, free, where = self.lengths, self.bins, self.free, self.where
        rooms = sorted((room, number) for number, room in free.items() if room)
        for item in sorted(items, key=lengths.__getitem__, reverse=True):
            length = lengths[item]
            at = bisect_left(rooms, (length, -1))
            if at < len(rooms):
                room, number = rooms.pop(at)
                bins[number].append(item)
            else:
                room, number = self.capacity, self.next
                self.next += 1
                bins[number] = [item]
            where[item] = number
            free[number] = room = room - length
            if room:
                insort(rooms, (room, number))

    def fitness(self) -> tuple[int, int]:
        """Fewer bins first, then emptier last bins: uneven filling leaves room to close a bin."""
        return -len(self.bins), sum(room * room for room in self.free.values())

    def renumbered(self) -> list[int]:
        numbers = {number: place for place, number in enumerate(self.bins)}
        return [numbers[number] for number in self.where]


def crossover(receiver: Packing, giver: Packing, rng: random.Random) -> Packing:
    """A child: `receiver` with some of the best filled bins of `giver` injected whole."""
    lengths, capacity = receiver.lengths, receiver.capacity
    ranked = sorted(giver.bins, key=lambda number: (giver.free[number], number))
    good = ranked[:max(1, len(ranked) // 2)]
    chosen = rng.sample(good, max(1, len(good) // 8))
    child = Packing.of(lengths, capacity, receiver.where)
    injected = {item for number in chosen for item in giver.bins[number]}
    displaced = []
    for number in {child.where[item] for item in injected}:
        displaced.extend(item for item in child.drop(number) if item not in injected)
    for number in chosen:
        child.open(list(giver.bins[number]))
    # The emptiest bins go with them, or their pieces would never move, and a few of any filling, or parents that are
    # alike would have no other children.
    for number in sorted(child.bins, key=lambda number: -child.free[number])[:2]:
        displaced.extend(child.drop(number))
    for number in rng.sample(sorted(child.bins), len(child.bins) // 10):
        displaced.extend(child.drop(number))
    child.best_fit(displaced)
    return child


def first_packings(lengths: list[int], capacity: int, population: int, rng: random.Random) -> list[Packing]:
    """One packing by decreasing best fit, the others from lists shuffled a little."""
    packings = []
    for number in range(population):
        packing = Packing(lengths, capacity)
        items = list(range(len(lengths)))
        if number:
            cut = len(items) * number // (2 * population)
            rng.shuffle(items)
            packing.best_fit(items[:cut])
            items = items[cut:]
        packing.best_fit(items)
        packings.append(packing)
    return packings


def evolve(population: list[Packing], lower: int, children: int, rng: random.Random) -> list[Packing]:
    """Some children in place of the worst, unless a packing has no bin too many already."""
    population = sorted(population, key=Packing.fitness, reverse=True)
    for _ in range(children):
        if len(population) < 2 or len(population[0].bins) <= lower:
            break
        receiver, giver = rng.sample(population, 2)
        child = crossover(receiver, giver, rng)
        if child.fitness() > population[-1].fitness():
            population[-1] = child
            population.sort(key=Packing.fitness, reverse=True)
    return population


def _state(instance: int, island: int, items: list[int], lengths: list[int], least: int, population: list[Packing]) -> dict:
    return {
        "instance": instance, "island": island, "bins": len(population[0].bins), "least": least, "items": items,
        "lengths": lengths, "packings": [packing.renumbered() for packing in population],
    }


def _lower(lengths: list[int], capacity: int) -> int:
    """No packing has fewer bins than this: not than the total asks for, than there are pieces over half, than pieces
    over a third in twos; nor than pieces over half, and what does not fit beside them of the others of at least some
    size."""
    sizes = np.sort(np.array(lengths, np.int64))
    sums = np.concatenate([[0], np.cumsum(sizes)])
    over = len(sizes) - np.searchsorted(2 * sizes, capacity, "right")
    most = max(-(-int(sums[-1]) // capacity), over, -(-int((3 * sizes > capacity).sum()) // 2))
    half = len(sizes) - over
    for least in np.unique(sizes[:half]).tolist():
        # Pieces over half with room for one of `least`, and what pieces from `least` to half ask for beyond that room.
        first, fits = np.searchsorted(sizes, least), np.searchsorted(sizes, capacity - least, "right")
        room = (fits - half) * capacity - int(sums[fits] - sums[half])
        most = max(most, over + max(0, -(-(int(sums[half] - sums[first]) - room) // capacity)))
    return most


def islands_of(pieces: DataFrame, capacity: int, islands: int, epochs: int, population: int,
               children: int) -> DataFrame:
    """`instance`, `island`, `bins`, `least` (fewer are not possible) and the packing of the best island of every instance.

    `pieces` has `instance`, `item` (unique) and `length`. Instances that have as few bins as can be are left alone;
    the others go on, `epochs` epochs at most, until IDLE epochs have closed no bin in any of them.
    """
    def settle(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("item")
        instance, island = int(group["instance"].iloc[0]), int(group["island"].iloc[0])
        rng = random.Random(instance * 1_000_003 + island)
        lengths = group["length"].astype(int).tolist()
        lower = _lower(lengths, capacity)
        settled = evolve(first_packings(lengths, capacity, population, rng), lower, children, rng)
        return pd.DataFrame([_state(instance, island, group["item"].tolist(), lengths, lower, settled)])

    def migrate(group: pd.DataFrame) -> pd.DataFrame:
        own = group[group["elite"] == 0].iloc[0]
        instance, island = int(own["instance"]), int(own["island"])
        rng = random.Random(instance * 1_000_003 + island * 101 + int(own["epoch"]))
        lengths = [int(length) for length in own["lengths"]]
        packings = [list(map(int, where)) for where in own["packings"]]
        arrived = [list(map(int, where)) for kept in group[group["elite"] == 1]["packings"] for where in kept]
        settled = sorted(
            (Packing.of(lengths, capacity, where) for where in packings), key=Packing.fitness, reverse=True
        )
        # Elites that come in take the place of the worst.
        settled = settled[:max(1, population - len(arrived))]
        settled += [Packing.of(lengths, capacity, where) for where in arrived]
        least = int(own["least"])
        settled = evolve(settled, least, children, rng)
        return pd.DataFrame([_state(instance, island, own["items"].tolist(), lengths, least, settled)])

    state = (
        pieces.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
        .groupBy("instance", "island").applyInPandas(settle, STATE)
    )
    state = written(state, "islands")
    ended, idle, before = [], 0, None
    for epoch in range(1, epochs):
        bins = written(state.groupBy("instance").agg(F.min("bins").alias("now"), F.min("least").alias("aim")), "bins")
        going = bins.where("now > aim")
        left = going.agg(F.count("*").alias("n"), F.sum("now").alias("bins")).first()
        idle = idle + 1 if (left["n"], left["bins"]) == before else 0
        if not left["n"] or idle >= IDLE:
            break
        before = (left["n"], left["bins"])
        ended.append(state.join(sendable(bins.where("now <= aim").select("instance")), "instance"))
        own = state.join(sendable(going.select("instance")), "instance").withColumn("elite", F.lit(0))
        elite = own.withColumn("elite", F.lit(1)).withColumn("packings", F.slice("packings", 1, 1)).withColumn(
            "island", ((F.col("island") + 1) % islands).cast("int")
        )
        both = own.unionByName(elite) if islands > 1 else own
        state = written(
            both.withColumn("epoch", F.lit(epoch)).groupBy("instance", "island").applyInPandas(migrate, STATE),
            "islands",
        )
    for settled in ended:
        state = state.unionByName(settled)
    best = F.min_by(F.struct("bins", "island", "least", "items", "lengths", F.element_at("packings", 1).alias("packing")),
                    F.struct("bins", "island"))
    return state.groupBy("instance").agg(best.alias("best")).select("instance", "best.*")


def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bin and the offset of every piece of the solved instances."""
    for batch in batches:
        for row in batch.to_pylist():
            used: dict[int, int] = {}
            offsets = []
            for number, length in zip(row["packing"], row["lengths"]):
                offsets.append(used.get(number, 0))
                used[number] = offsets[-1] + length
            n = len(offsets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["items"], pa.int64()), pa.array([row["instance"]] * n, pa.int64()),
                 pa.array(row["packing"], pa.int64()), pa.array(offsets, pa.int64())],
                names=["item", "instance", "bin", "offset"],
            )


def pack(pieces: DataFrame, capacity: int, instance: int = INSTANCE, islands: int = ISLANDS, epochs: int = MOST_EPOCHS,
         population: int = POPULATION, children: int = CHILDREN) -> DataFrame:
    """`pieces`, which has a `length` from 1 to `capacity`, with `sequence_id` and `offset` for each row.

    Repeated rows are placed one by one; with no rows there are no sequences. The pieces are staged once
    under numbers of their own, so that a task that runs again sees the same. Columns of any name stay, but for a
    `sequence_id` or `offset`, which give way to those of the result.
    """
    columns = [name for name in pieces.columns if name not in ("sequence_id", "offset")]
    numbered = written(
        pieces.select(F.struct(*[F.col(f"`{name}`") for name in columns]).alias("given"),
                      F.col("length").cast("long").alias("length"), F.monotonically_increasing_id().alias("item")),
        "pieces",
    )
    full = F.col("length") >= capacity
    n = numbered.where(~full).count()
    instances = max(1, round(n / instance))
    dealt = numbered.where(~full).select(
        F.pmod(F.xxhash64("item"), F.lit(instances)).alias("instance"), "item", "length"
    )
    placed = islands_of(dealt, capacity, islands, epochs, population, children).select(
        "instance", "items", "lengths", "packing"
    ).mapInArrow(place, "item long, instance long, bin long, offset long")
    # Sequences of full pieces have odd numbers, the others even ones: an instance has at most as many
    # bins as it has pieces, so `instance` and `bin` in turn make the number unique.
    packed = numbered.where(~full).join(placed, "item").select(
        "given.*", (F.shiftleft(F.col("instance") * F.lit(1 << 24) + F.col("bin"), 1)).alias("sequence_id"), "offset"
    )
    alone = numbered.where(full).select(
        "given.*", (F.shiftleft("item", 1) + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(alone)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Cut all documents and pack the pieces; NULLs and repeats as `cut_pieces` has them."""
    return pack(cut_pieces(docs, vocabulary, capacity, end_id), capacity)
