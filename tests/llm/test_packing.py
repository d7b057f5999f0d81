"""Packing: nothing is lost, nothing overlaps, and few sequences are used."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from curate.llm.packing import _lower, Packing, crossover, cut_pieces, first_packings, islands_of, pack, pack_documents
from tests.llm.conftest import HARD

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, capacity):
    """Sequences without gaps or overflow; their number."""
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces(hard):
    library = Tokenizer.from_file(VOCABULARY)
    expected = Counter()
    for doc_id, text in HARD:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 100 or 100
        cuts = [0, *range(first, len(ids) + 1, 100)]
        for piece, (start, stop) in enumerate(zip(cuts, cuts[1:])):
            expected[doc_id, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())] += 1
    assert Counter(map(tuple, cut_pieces(hard, VOCABULARY, 100, 2).collect())) == expected


def test_documents(hard, nothing, documents):
    for docs in (hard, documents):
        rows = pack_documents(docs, VOCABULARY, capacity=1024, end_id=2).collect()
        keys = ("doc_id", "piece", "start", "length", "ids_crc32")
        assert Counter(tuple(row[key] for key in keys) for row in rows) == Counter(
            map(tuple, cut_pieces(docs, VOCABULARY, 1024, 2).collect())
        )
        total = sum(row["length"] for row in rows)
        assert check(rows, 1024) <= max(-(-total // 1024) * 1.02 + 1, sum(2 * row["length"] > 1024 for row in rows))
    assert pack_documents(nothing, VOCABULARY).count() == 0


def test_many_instances_and_islands(spark):
    rng = random.Random(4)
    lengths = [rng.choice([1, 7, 333, 334, 335, 500, 501, 523, 700, 1024]) for _ in range(3000)]
    rows = spark.createDataFrame([(length, "clash") for length in lengths], "length long, item string")
    packed = pack(rows, 1024, instance=400, islands=3, epochs=3).collect()
    assert Counter(row["length"] for row in packed) == Counter(lengths)
    assert {row["item"] for row in packed} == {"clash"}
    # Not much worse than one list packed as a whole; eight instances have a last bin each.
    whole = Packing(lengths, 1024)
    whole.best_fit(list(range(len(lengths))))
    assert check(packed, 1024) <= len(whole.bins) + 8


def test_a_child_holds_every_piece_once_and_whole_bins_of_the_giver():
    rng = random.Random(8)
    lengths = [rng.randrange(1, 100) for _ in range(200)]
    receiver, giver = first_packings(lengths, 100, 2, rng)
    child = crossover(receiver, giver, rng)
    assert sorted(item for items in child.bins.values() for item in items) == list(range(200))
    assert all(sum(lengths[item] for item in items) <= 100 for items in child.bins.values())
    assert {tuple(sorted(items)) for items in child.bins.values()} & {
        tuple(sorted(items)) for items in giver.bins.values()
    }
    again = Packing.of(lengths, 100, child.renumbered())
    assert again.fitness() == child.fitness()


def test_crossover_finds_what_best_fit_misses():
    # Best fit by falling length needs four bins for what three hold.
    lengths = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6]
    rng = random.Random(1)
    from curate.llm.packing import evolve

    population = first_packings(lengths, 60, 4, rng)
    best = evolve(population, 3, 300, rng)[0]
    assert len(best.bins) == 3


def optimum(lengths, capacity):
    """The fewest bins, by trying each piece in every bin there is and in one of its own."""
    best = len(lengths)

    def place(number, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if number == len(lengths):
            best = len(rooms)
            return
        for at in sorted(set(rooms)):
            if at >= lengths[number]:
                left = list(rooms)
                left[left.index(at)] -= lengths[number]
                place(number + 1, left)
        place(number + 1, [*rooms, capacity - lengths[number]])

    place(0, [])
    return best


def test_no_packing_is_below_the_bound_and_islands_reach_the_optimum(spark):
    rng = random.Random(11)
    tables = [sorted((rng.randrange(15, 60) for _ in range(9)), reverse=True) for _ in range(40)]
    best = [optimum(lengths, 100) for lengths in tables]
    assert all(_lower(lengths, 100) <= fewest for lengths, fewest in zip(tables, best))
    # At least in most of them the bound is the optimum, so that islands know when to stop.
    assert sum(_lower(lengths, 100) == fewest for lengths, fewest in zip(tables, best)) >= 30
    rows = [(instance, 100 * instance + item, length) for instance, lengths in enumerate(tables) for item, length in enumerate(lengths)]
    pieces = spark.createDataFrame(rows, "instance long, item long, length long")
    found = {row["instance"]: row for row in islands_of(pieces, 100, 2, 12, 4, 6).collect()}
    assert all(found[instance]["bins"] >= fewest for instance, fewest in enumerate(best))
    assert sum(found[instance]["bins"] == fewest for instance, fewest in enumerate(best)) >= 39
    assert all(found[instance]["least"] == _lower(lengths, 100) for instance, lengths in enumerate(tables))


def test_clustered_lengths(spark):
    """Lengths that decreasing best fit packs badly: more epochs are never worse, and close to the bound."""
    rng = random.Random(3)
    lengths = [rng.randrange(180, 420) for _ in range(1200)]
    rows = spark.createDataFrame([(length, 7) for length in lengths], "length long, offset long")
    packed = pack(rows, 1024, instance=400).collect()
    assert packed[0].asDict().keys() == {"length", "sequence_id", "offset"}
    one = pack(rows, 1024, instance=400, epochs=1).collect()
    assert check(packed, 1024) <= check(one, 1024)
    assert check(packed, 1024) <= 1.03 * _lower(lengths, 1024) + 3
