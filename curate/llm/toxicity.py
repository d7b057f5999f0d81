"""Toxicity by non-negative learning from positive and unlabelled texts.

Confirmed toxic documents are the positives, the texts of the whole corpus the unlabelled ones: a
mixture that holds toxic documents at the rate of the class prior. The risk of calling unlabelled
texts clean is corrected by that prior, and kept from going negative, so that a flexible model does
not drive it there. The risk is summed over all texts; a sample only says where to begin.

Features are words, beginnings of words, and beginnings that two or three different words of a text share. Each
has a place in a space of fixed width by its hash, so counts are vectors of that width, however many words there
are. The model uses the places that positives have surprisingly more often than the corpus.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curate.llm.divergence import DIGIT, FIRST, LETTERS, word_pointers
from curate.operators.skew import sendable
from curate.session import written

# Lengths of beginnings, in bytes.
BEGINNINGS = (5, 6, 7)
# Places of features, and a hash within a text.
PLACE_BITS, HASH_BITS = 18, 40
WIDTH = 1 << PLACE_BITS
# Text that is hashed at once.
BLOCK_BYTES, BLOCK_DOCS = 1 << 21, 1 << 14
# A place is a candidate if so many of the positives have it.
LEAST_COUNT = 3
# How surprising a surplus must be (log-likelihood ratio, chi-square with one degree of freedom). The model uses
# all candidates that are.
SURPRISE = 15.0
# The bounds of what is sampled, by a hash, to begin with; steps that follow over all rows.
POSITIVES, BEGUN_WITH, STEPS = 4_000, 8_000, 24
PREDICTED = 0.7
FOLDS, HELD_OUT = 3, 1
RESULT = "doc_id long, held_out boolean, score double, predicted int"


def mixed(numbers: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers."""
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return numbers ^ (numbers >> np.uint64(32))


def _within(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A text's number before a hash."""
    return doc.astype(np.uint64) << np.uint64(HASH_BITS) | hashes >> np.uint64(64 - HASH_BITS)


def _placed(within: np.ndarray, times: int = 1) -> np.ndarray:
    """A text's number before the place of a feature; the same beginning met more often has other places."""
    low = np.uint64((1 << HASH_BITS) - 1)
    place = mixed((within & low) + np.uint64(times << HASH_BITS)) & np.uint64(WIDTH - 1)
    return within >> np.uint64(HASH_BITS) << np.uint64(PLACE_BITS) | place


def places(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The features of some texts, as the number of the text and a place; distinct, ascending.

    Words are runs of letters in lower case, characters beyond ASCII being letters. A text has each word, each
    beginning of a longer one, and beginnings again that two or three different words of it share.
    """
    data = [(text or "").lower().encode() for text in texts]
    offsets = np.cumsum([0, *map(len, data)])
    letters = LETTERS[np.frombuffer(b"".join(data), np.uint8)]
    starts, sizes = word_pointers(letters, offsets)
    doc = np.searchsorted(offsets, starts, "right") - 1
    padded = np.concatenate([letters, np.zeros(DIGIT, np.uint8)])
    digits = np.ndarray(len(letters) + 1, ">u8", padded.data, strides=(1,))
    first = digits[starts].astype(np.uint64) & FIRST[np.minimum(sizes, DIGIT)]
    hashes, depth = mixed(first), DIGIT
    longer = np.flatnonzero(sizes > depth)
    while len(longer):
        more = digits[starts[longer] + depth].astype(np.uint64) & FIRST[np.minimum(sizes[longer] - depth, DIGIT)]
        hashes[longer] = mixed(hashes[longer] * np.uint64(3) + more)
        depth += DIGIT
        longer = longer[sizes[longer] > depth]
    words, which = np.unique(_within(doc, hashes), return_index=True)
    found = [_placed(words)]
    for length in BEGINNINGS:
        begun = which[sizes[which] > length]
        shared, times = np.unique(
            _within(doc[begun], mixed((first[begun] & FIRST[length]) + np.uint64(length))), return_counts=True
        )
        found += [_placed(shared[times >= least], 1 + least) for least in (1, 2, 3)]
    every = np.unique(np.concatenate(found))
    return (every >> np.uint64(PLACE_BITS)).astype(np.int64), (every & np.uint64(WIDTH - 1)).astype(np.int64)


def _blocks(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a batch, so many at once that their words fit into memory."""
    block, size = [], 0
    for text in texts.to_pylist():
        block.append(text)
        size += len(text or "")
        if size >= BLOCK_BYTES or len(block) >= BLOCK_DOCS:
            yield block
            block, size = [], 0
    if block:
        yield block


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning. A NULL `doc_id` has no label to learn from anyway."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def known_labels(labels: DataFrame) -> DataFrame:
    """`doc_id` and `toxic` of the rows to learn from, one per document: toxic if any of its labels says so."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    return usable.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))


def place_counts(docs: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """In how many texts each place occurs, as `place` and `n`; under place -1 the number of texts. With `wanted`
    only of these places. Each task adds up what it has in one vector."""
    kept = np.ones(WIDTH, bool)
    if wanted is not None:
        kept = np.zeros(WIDTH, bool)
        kept[wanted] = True

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(WIDTH, np.int64), 0
        for batch in batches:
            for block in _blocks(batch["text"]):
                counts += np.bincount(places(block)[1], minlength=WIDTH)
            n += batch.num_rows
        met = np.flatnonzero(counts * kept)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(met, -1), pa.int64()), pa.array(np.append(counts[met], n), pa.int64())], names=["place", "n"]
        )

    counted = docs.select("text").mapInArrow(count, "place long, n long")
    return counted.groupBy("place").agg(F.sum("n").alias("n"))


def _vector(counts: DataFrame) -> tuple[np.ndarray, int]:
    """Counts by place, and the number of texts: no more than WIDTH rows are collected."""
    found = counts.toArrow()
    vector, places, n = np.zeros(WIDTH + 1, np.int64), found["place"].to_numpy(), found["n"].to_numpy()
    vector[places] = n
    return vector[:WIDTH], int(vector[-1])


def with_features(docs: DataFrame, used: np.ndarray) -> DataFrame:
    """`doc_id` and, for each text, which of the places in use it has, as numbers in `used`."""
    number = np.full(WIDTH, -1, np.int32)
    number[used] = np.arange(len(used))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for block in _blocks(batch["text"]):
                doc, place = places(block)
                kept = number[place] >= 0
                # Numbers ascend with places, so each list is in order.
                offsets = np.concatenate([[0], np.cumsum(np.bincount(doc[kept], minlength=len(block)))])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][done:done + len(block)], pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.array(number[place[kept]], pa.int32()))],
                    names=["doc_id", "found"],
                )
                done += len(block)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(look_up, "doc_id long, found array<int>")


@dataclass
class Model:
    """Weights of the features in use and a bias; scores are shifted so that the limit of PREDICTED falls where the
    labels ask for it."""

    weights: np.ndarray
    bias: float
    shift: float = 0.0

    def raw(self, found: pa.Array) -> np.ndarray:
        """The sum of weights of each row."""
        offsets = np.asarray(found.offsets)
        sums = np.concatenate([[0.0], np.cumsum(self.weights[np.asarray(found.values)])])
        return self.bias + sums[offsets[1:]] - sums[offsets[:-1]]

    def score(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(raw + self.shift, -50, 50)))


def telling(n: np.ndarray, n_positive: np.ndarray, documents: int, positives: int) -> np.ndarray:
    """Places of the features whose surplus among positives is surprising."""
    n, n_positive = n.astype(float), n_positive.astype(float)

    def part(count: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(count > 0, count * np.log(np.maximum(count, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    others, n_other = documents - positives, n - n_positive
    share = n / max(1, documents)
    ratio = 2 * (
        part(n_positive, positives * share) + part(n_other, others * share)
        + part(positives - n_positive, positives * (1 - share)) + part(others - n_other, others * (1 - share))
    )
    ratio[n_positive <= positives * share] = 0
    return np.flatnonzero(ratio >= SURPRISE)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], width: int, prior: float, steps: int = 300,
          rate: float = 0.1, penalty: float = 1e-4, slack: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model by the non-negative risk: `prior` times the risk of positives
    called positive, plus what the unlabelled risk of a negative call leaves after `prior` times that of
    the positives. While that rest is below `-slack`, the step only raises it again."""
    rows = positive + unlabelled
    columns = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(found) for found in rows])
    is_positive = np.arange(len(rows)) < len(positive)
    per_positive = is_positive / max(1, len(positive))
    per_unlabelled = ~is_positive / max(1, len(unlabelled))
    descent = Descent(np.zeros(width), float(np.log(prior / (1 - prior))), rate, penalty)
    for _ in range(steps):
        raw = descent.bias + np.bincount(row, descent.weights[columns], len(rows))
        chance = 1 / (1 + np.exp(-np.clip(raw, -50, 50)))
        called_positive = np.logaddexp(0, raw)  # the loss of a negative call
        rest = called_positive @ per_unlabelled - prior * (called_positive @ per_positive)
        slope = chance * per_unlabelled - prior * chance * per_positive
        if rest >= -slack:
            slope = slope - prior * (1 - chance) * per_positive
        else:
            slope = -slope
        descent.step(np.bincount(columns, slope[row], width), slope.sum())
    return descent.weights, descent.bias


class Descent:
    """Weights and bias on their way down the risk."""

    def __init__(self, weights: np.ndarray, bias: float, rate: float, penalty: float):
        self.weights, self.bias, self.rate, self.penalty = weights, bias, rate, penalty
        self.mean, self.square, self.steps = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1), 0

    def step(self, slope: np.ndarray, slope_of_bias: float) -> None:
        self.steps += 1
        change = np.append(slope + self.penalty * self.weights, slope_of_bias)
        self.mean = 0.9 * self.mean + 0.1 * change
        self.square = 0.999 * self.square + 0.001 * change**2
        move = self.rate * (self.mean / (1 - 0.9**self.steps)) / (np.sqrt(self.square / (1 - 0.999**self.steps)) + 1e-8)
        self.weights, self.bias = self.weights - move[:-1], self.bias - move[-1]


def risk_slopes(found: DataFrame, weights: np.ndarray, bias: float, prior: float) -> tuple[np.ndarray, float, float]:
    """The slopes of the risk over all rows of `found` (`found`, `toxic`), by weight and for the bias, and the rest that
    must not be negative. Every row is unlabelled text; those with `toxic` 1 are positives, too. Each task
    adds up its rows, and sums by weight are what is collected."""
    width = len(weights)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By weight, then for the bias, the loss of a negative call, and the number of rows.
        sums = np.zeros((3, width + 3))
        for batch in batches:
            n, lists = batch.num_rows, batch["found"]
            offsets = np.asarray(lists.offsets)
            columns = np.asarray(lists.values)[offsets[0]:offsets[-1]]
            row = np.repeat(np.arange(n), np.diff(offsets))
            raw = bias + np.bincount(row, weights[columns] if width else None, n) if len(columns) else np.full(n, bias)
            chance, loss = 1 / (1 + np.exp(-np.clip(raw, -50, 50))), np.logaddexp(0, raw)
            positive = np.asarray(batch["toxic"].fill_null(0)) == 1
            for kind, (slope, rows) in enumerate((
                (chance, np.ones(n)), (chance * positive, positive), ((1 - chance) * positive, positive),
            )):
                sums[kind, :width] += np.bincount(columns, slope[row], width)[:width] if len(columns) else 0
                sums[kind, width:] += slope.sum(), loss @ rows, rows.sum()
        place = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int64()), *(pa.array(kind[place]) for kind in sums)], names=["place", "every", "called", "missed"]
        )

    parts = found.select("found", "toxic").mapInArrow(add_up, "place long, every double, called double, missed double")
    kinds = ("every", "called", "missed")
    table = parts.groupBy("place").agg(*[F.sum(kind).alias(kind) for kind in kinds]).toArrow()
    sums = np.zeros((3, width + 3))
    sums[:, table["place"].to_numpy()] = [table[kind].to_numpy() for kind in kinds]
    every, called, missed = sums / np.maximum(sums[:, -1:], 1)
    rest = every[width + 1] - prior * called[width + 1]
    slope = every - prior * called
    slope = slope - prior * missed if rest >= 0 else -slope
    return slope[:width], float(slope[width]), float(rest)


def _sampled(rows: DataFrame, n: int, most: int) -> DataFrame:
    """About `most` of `n` rows, by a hash."""
    parts = 1 << 30
    share = min(parts, parts * most // max(1, n))
    return rows.where(F.pmod(F.xxhash64("doc_id", "found", F.lit("sample")), F.lit(parts)) < share)


def fit(found: DataFrame, width: int, steps: int = STEPS, rate: float = 0.05, penalty: float = 1e-4) -> Model | None:
    """A model from rows of `doc_id`, `found` (places of the features in use) and `toxic` (NULL where there is no label
    to learn from); None without a positive. It begins with what bounded samples say; then every step goes down the
    risk over all rows. Of single documents only the samples leave the executors."""
    totals = found.agg(
        F.count("*").alias("n"), F.count("toxic").alias("known"), F.sum("toxic").alias("toxic")
    ).first()
    n, known, toxic = totals["n"], totals["known"], totals["toxic"] or 0
    if not toxic:
        return None
    prior = min(max(toxic / known, 1e-4), 0.9)
    samples = []
    for rows, size, most in ((found.where("toxic = 1"), toxic, POSITIVES), (found, n, BEGUN_WITH)):
        taken = _sampled(rows.select("doc_id", "found"), size, most).orderBy("doc_id", "found").select("found").toArrow()
        lists = taken["found"].combine_chunks()
        offsets = np.asarray(lists.offsets)
        samples.append(np.split(np.asarray(lists.values)[offsets[0]:offsets[-1]], offsets[1:-1] - offsets[0]))
    descent = Descent(*train(*samples, width, prior), rate, penalty)
    for _ in range(steps):
        slope, slope_of_bias, _ = risk_slopes(found, descent.weights, descent.bias, prior)
        descent.step(slope, slope_of_bias)
    return Model(descent.weights if width else np.zeros(1), descent.bias)


def scored(found: DataFrame, model: Model) -> DataFrame:
    """The rows with the `raw` sum of the model in place of `found`."""
    others = [name for name in found.columns if name != "found"]
    kinds = ", ".join(f"`{name}` {found.schema[name].dataType.simpleString()}" for name in others)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(batch["found"])
            yield pa.RecordBatch.from_arrays(
                [*(batch[name] for name in others), pa.array(raw, pa.float64())], names=[*others, "raw"]
            )

    return found.mapInArrow(add_up, f"{kinds}, raw double")


def calibrated(rows: DataFrame, model: Model, bins_per_unit: int = 20) -> Model:
    """The model, shifted so that the limit gives the labelled rows their best F1. `rows` has `raw`, `toxic`."""
    binned = F.floor(F.greatest(F.least("raw", F.lit(50.0)), F.lit(-50.0)) * bins_per_unit).cast("int")
    counts = rows.where("toxic is not null").groupBy(binned.alias("bin"), "toxic").count().collect()
    toxic, clean = Counter(), Counter()
    for row in counts:
        (toxic if row["toxic"] else clean)[row["bin"]] += row["count"]
    every = sorted({*toxic, *clean}, reverse=True)
    best, limit, hits, false = -1.0, every[0] if every else 0, 0, 0
    for place, number in enumerate(every):
        hits, false = hits + toxic[number], false + clean[number]
        f1 = 2 * hits / max(1, hits + false + sum(toxic.values()))
        if f1 > best:
            # Halfway to the next lower score that occurs.
            below = every[place + 1] if place + 1 < len(every) else number
            best, limit = f1, (number + below + (place + 1 < len(every))) / 2
    shift = float(np.log(PREDICTED / (1 - PREDICTED)) - limit / bins_per_unit)
    return Model(model.weights, model.bias, shift)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted` for every row.

    `labels` has `doc_id` and `toxic` (1, 0 or NULL); only those of rows that are not held out are learnt
    from, and no column of `docs` but `text` is an input of a score. NULL texts are empty and get the score
    of a text without features; repeated rows are scored alike; without a confirmed toxic document every
    score is 0. Texts of any length count whole. Those of the positives are read once, and all twice, to count the
    candidates and to look up the features in use; labels meet the features in use, not the texts.
    """
    known = written(known_labels(labels), "known-labels")
    # No more than WIDTH numbers come to the driver, and go to the tasks.
    positives = sendable(known.where("toxic = 1").select("doc_id"))
    of_positives, n_positive = _vector(place_counts(docs.select("doc_id", "text").join(positives, "doc_id")))
    candidates = np.flatnonzero(of_positives >= LEAST_COUNT)
    n, n_docs = _vector(place_counts(docs, candidates))
    used = candidates[telling(n[candidates], of_positives[candidates], n_docs, n_positive)]
    found = written(
        with_features(docs, used).join(known, "doc_id", "left").select("doc_id", "found", "toxic"), "used-features"
    )
    model = fit(found, len(used))
    if model is None:
        rows = found.select("doc_id", F.lit(0.0).alias("score"))
    else:
        rows = written(scored(found, model), "raw-scores")
        shifted = calibrated(rows, model)
        raw = F.greatest(F.least(F.col("raw") + F.lit(shifted.shift), F.lit(50.0)), F.lit(-50.0))
        rows = rows.select("doc_id", (1 / (1 + F.exp(-raw))).alias("score"))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= PREDICTED).cast("int").alias("predicted"),
    )
