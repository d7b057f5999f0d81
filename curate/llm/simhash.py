"""Near duplicates by 64-bit fingerprints, with candidates pruned by the pigeonring principle.

Two fingerprints are alike if at most `distance` bits differ. A fingerprint is cut into a ring of
2 * distance + 1 segments. If two are alike, there is a place on the ring from which every chain of
l consecutive segments differs in at most l * distance / (number of segments) bits: the budgets of
the pigeonring principle. While a budget is below one bit, the segments must be equal, so these
first segments of the chain are the join key; the longer chains are checked on the joined rows, and
the last one, the whole ring, is the full Hamming check.

A key that very many fingerprints share would give the square of their number in pairs. Such a bucket
is linked through common neighbours instead: two fingerprints differ in at most two bits if, and
only if, one is reached from both by changing at most one bit. Every fingerprint names those
within a bit of itself, and who names the same one is linked to the least of them: as many rows as
there are fingerprints, times the bits outside the key. The links differ, the components don't.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curate.llm.components import connected
from curate.operators.skew import sendable
from curate.session import written

BITS = 64
SHINGLE, DISTANCE, SEED = 3, 2, 42
# From this many fingerprints on, a bucket is linked through neighbours. The groups are the same.
BUCKET = 64
# Shingles that are turned into bits at once.
AT_ONCE = 1 << 15
LOWER = bytes(byte + 32 if ord("A") <= byte <= ord("Z") else byte for byte in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a text, as a signed number; zero if it has no word."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    hashes = np.array([
        xxh64_intdigest(joined[start:end], seed)
        for start, end in zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist())
    ], "<u8")
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), AT_ONCE):
        part = hashes[start:start + AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """`doc_id`, `row` and the fingerprint `fp` of every row; `row` is as given."""
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(text.as_py(), shingle, seed) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["row"], pa.array(values, pa.int64())], names=["doc_id", "row", "fp"]
            )

    return docs.select(F.col("doc_id").cast("long"), "row", "text").mapInArrow(prints, "doc_id long, row long, fp long")


class Ring:
    """The segments of a fingerprint and the budgets of chains of them."""

    def __init__(self, distance: int):
        self.distance = distance
        self.n = 2 * distance + 1
        cuts = [BITS * number // self.n for number in range(self.n + 1)]
        self.segments = [_mask(range(low, high)) for low, high in zip(cuts, cuts[1:])]
        self.budgets = [length * distance // self.n for length in range(1, self.n + 1)]
        self.equal = sum(budget == 0 for budget in self.budgets)

    def chain(self, start: int, length: int) -> int:
        """The bits of a chain of segments."""
        mask = 0
        for step in range(length):
            mask |= self.segments[(start + step) % self.n]
        return mask


def _mask(bits: range) -> int:
    return sum(1 << bit for bit in bits)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _of_place(values: list, place: str = "place") -> Column:
    """A value by the number of the place where the chain starts."""
    return F.element_at(F.array(*values), F.col(place) + 1)


def link_fingerprints(prints: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Links (`a`, `b`) between distinct fingerprints `fp` with the components of all alike pairs."""
    if not 0 <= distance <= 2:
        raise ValueError("the bits that may differ must be 0, 1 or 2")
    ring = Ring(distance)
    places = range(ring.n)
    keys = F.array(*[
        F.struct(F.lit(place).alias("place"),
                 F.col("fp").bitwiseAND(F.lit(_signed(ring.chain(place, ring.equal)))).alias("key"))
        for place in places
    ])
    keyed = prints.select("fp", F.explode(keys).alias("at")).select("fp", "at.*")
    shared = keyed.groupBy("place", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = written(keyed.join(shared, ["place", "key"]), "buckets")
    few = members.where(F.col("n") <= bucket)
    one = few.select("place", "key", F.col("fp").alias("a"))
    two = few.select("place", "key", F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    within = F.lit(True)
    for length in range(ring.equal + 1, ring.n + 1):
        chain = _of_place([F.lit(_signed(ring.chain(place, length))) for place in places])
        within = within & (F.bit_count(differ.bitwiseAND(chain)) <= ring.budgets[length - 1])
    pairs = one.join(two, ["place", "key"]).where((F.col("a") < F.col("b")) & within).select("a", "b")
    if distance == 0:
        return pairs.distinct()
    many = members.where(F.col("n") > bucket)
    free = [~ring.chain(place, ring.equal) & _mask(range(BITS)) for place in places]
    changes = [
        F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << bit)) for bit in range(BITS) if mask >> bit & 1])
        for mask in free
    ]
    around = many.select(
        "place", "fp", F.explode(F.transform(_of_place(changes), lambda bit: F.col("fp").bitwiseXOR(bit))).alias("near")
    )
    around = written(around, "neighbours")
    least = around.groupBy("place", "near").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    # At a distance of 1 only those pairs count that are so near; a common neighbour allows 2.
    stars = around.join(least, ["place", "near"]).where("fp <> a").select("a", F.col("fp").alias("b"))
    if distance == 1:
        stars = around.where("near <> fp").join(
            many.select("place", F.col("fp").alias("near")), ["place", "near"]
        ).select(F.col("fp").alias("a"), F.col("near").alias("b"))
    return pairs.union(stars).distinct()


def _rooted(prints: DataFrame, distance: int, bucket: int) -> DataFrame:
    """`fp` and the `root` of its component for every fingerprint that occurs."""
    distinct = written(prints.select("fp").distinct(), "distinct-fingerprints")
    roots = connected(link_fingerprints(distinct, distance, bucket))
    return written(
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("root")
        ),
        "rooted-fingerprints",
    )


def _first_rows(prints: DataFrame, rooted: DataFrame) -> DataFrame:
    """`fp` and the `first` row of its component: the smallest `doc_id`, NULL last, then the row number. The rows
    of a fingerprint are cut down to one before they meet those of its component."""
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    of_print = prints.groupBy("fp").agg(F.min(order).alias("first"))
    joined = written(rooted.join(of_print, "fp"), "first-rows")
    names = joined.groupBy("root").agg(F.min("first").alias("first"))
    return written(joined.drop("first").join(names, "root").select("fp", "first"), "components")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE, seed: int = SEED,
                    bucket: int = BUCKET) -> DataFrame:
    """`doc_id`, `fingerprint` and `component_id` for every row.

    A NULL text is empty; texts without a word have fingerprint zero and are linked like any other. A
    component is named by its smallest `doc_id`; a NULL `doc_id` names none, and where all are NULL the
    name is NULL. Repeated rows each have their row. Texts of any length count whole. An empty table has no rows. Other columns are not
    looked at.
    """
    rows = docs.select("doc_id", "text", F.lit(0).cast("long").alias("row"))
    prints = written(fingerprints(rows, shingle, seed), "fingerprints")
    first = _first_rows(prints, _rooted(prints, distance, bucket))
    return prints.join(first, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
    )


def one_of_each(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE, seed: int = SEED,
                bucket: int = BUCKET) -> DataFrame:
    """The rows of `docs`, all columns, that are the first of their component: the one with the smallest `doc_id`,
    NULL last, and exactly one of repeated rows. No rows give none; columns of any name stay. The rows are staged under numbers of their own, and those
    that go are sent to the others if they are few."""
    given = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("given")
    staged = written(docs.select(given, F.monotonically_increasing_id().alias("row")), "numbered")
    prints = written(fingerprints(staged.select("given.doc_id", "given.text", "row"), shingle, seed), "fingerprints")
    first = _first_rows(prints, _rooted(prints, distance, bucket))
    gone = written(
        prints.join(first, "fp").where(F.col("row") != F.col("first.row")).select("row"), "near-duplicates"
    )
    return staged.join(sendable(gone), "row", "left_anti").select("given.*")
