"""Quality rules by isolation forests over rule statistics.

Every document gets the counts that quality rules look at, in families that tell of one fault each.
For each family a forest of random trees, each grown on a small sample, measures how few splits part a
document from the others: the shorter the path, the odder the document. Odd need not be bad: from
which oddness on a family rejects, if at all, is set by labelled rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.session import written

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
# The rules that stand on their own: words at least, and words in repeated windows at most, in percent.
MIN_WORDS, MAX_REPEATED = 50, 50
WINDOW = 3
# The forest: trees, rows that each is grown on. Both bound what is sampled from any corpus.
TREES, SAMPLE = 64, 256
SEED = 7
# A share of the good documents rejected weighs as much as this many times that share of the bad ones kept.
GOOD_WEIGHT = 20
# The least share of the bad documents for which a family gets a threshold.
LEAST_GAIN = 0.02
BINS = 2_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATES = ("symbols", "repeated_lines", "repeated_words", "capitals", "marks", "digits", "word_length")
FAMILIES = (("symbols",), ("repeated_lines", "repeated_words"), ("capitals", "marks"), ("digits", "word_length"))
STATISTICS = ", ".join([*(f"{name} long" for name in COUNTS), *(f"{name} double" for name in RATES)])

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = bytes(range(ord("0"), ord("9") + 1))
_MARKS = b"!?;:=+~^_\\/{}[]()@\""


def _without(raw: bytes, letters: bytes) -> int:
    """How many bytes of `raw` are among `letters`."""
    return len(raw) - len(raw.translate(None, letters))


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that occur twice or more."""
    n = len(words)
    if n <= WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    windows = codes[:n - WINDOW + 1]
    for step in range(1, WINDOW):
        # Numbered anew at each step, so that the product stays small however many words there are.
        windows = windows * len(numbers) + codes[step:n - WINDOW + 1 + step]
        windows = np.unique(windows, return_inverse=True)[1]
    often = np.bincount(windows)[windows] > 1
    covered = np.zeros(n, bool)
    for step in range(WINDOW):
        covered[step:n - WINDOW + 1 + step] |= often
    return int(covered.sum())


def statistics(text: str | None) -> tuple:
    """The counts and rates of a text, in the order of STATISTICS; NULL counts as empty."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n_words = len(words)
    chars = len(text) - _without(raw, BLANKS)
    symbols = _without(raw, SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line.strip(BLANKS)]
    doubled = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    per_char, per_word = 1 / max(1, chars), 1 / max(1, n_words)
    return (
        n_words, chars, symbols, doubled, repeated,
        symbols * per_char, doubled / max(1, len(lines)), repeated * per_word,
        _without(raw, _CAPITALS) * per_char, _without(raw, _MARKS) * per_char, _without(raw, _DIGITS) * per_char,
        min(chars * per_word, 50.0),
    )


def with_statistics(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`given`, a struct of some columns of `docs`, beside the statistics of `text`."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = list(zip(*[statistics(text.as_py()) for text in batch["text"]]))
            values = values or [()] * (len(COUNTS) + len(RATES))
            arrays = [pa.array(value, pa.int64()) for value in values[:len(COUNTS)]]
            arrays += [pa.array(value, pa.float64()) for value in values[len(COUNTS):]]
            yield pa.RecordBatch.from_arrays([batch["given"], *arrays], names=["given", *COUNTS, *RATES])

    given = docs.select(F.struct(*[F.col(f"`{name}`") for name in columns]).alias("given"), F.col("text"))
    return given.mapInArrow(count, f"given {given.schema['given'].dataType.simpleString()}, {STATISTICS}")


@dataclass
class Forest:
    """Trees as arrays: `feature` (-1 at a leaf), `split`, the next node to the left (right is one on), and
    at a leaf the path length it stands for."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    length: np.ndarray
    depth: int
    usual: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the higher, the odder."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for tree in range(len(self.feature)):
            feature, split, left = self.feature[tree], self.split[tree], self.left[tree]
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                at = feature[node]
                inner = at >= 0
                if not inner.any():
                    break
                right = rows[every, np.maximum(at, 0)] >= split[node]
                node = np.where(inner, left[node] + right, node)
            total += self.length[tree][node]
        return 2.0 ** (-total / len(self.feature) / self.usual)


def _average_path(n: int) -> float:
    """The mean length of an unsuccessful search in a binary tree of n rows."""
    if n < 2:
        return 0.0
    return 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grow(rows: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> Forest:
    """A forest on sampled rows; without rows every score is the same."""
    rng = np.random.default_rng(seed)
    depth = max(1, int(np.ceil(np.log2(sample))))
    grown = []
    for _ in range(trees):
        chosen = rows[rng.choice(len(rows), min(sample, len(rows)), replace=False)] if len(rows) else rows
        nodes = [[-1, 0.0, 0, 0.0]]
        todo = [(0, chosen, 0)]
        while todo:
            number, part, level = todo.pop()
            low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (np.zeros(1), np.zeros(1))
            wide = np.flatnonzero(high > low)
            if level >= depth or not len(wide):
                nodes[number][3] = level + _average_path(len(part))
                continue
            feature = int(rng.choice(wide))
            split = float(rng.uniform(low[feature], high[feature]))
            split = split if split > low[feature] else float(high[feature])
            nodes[number][:3] = [feature, split, len(nodes)]
            right = part[:, feature] >= split
            todo += [(len(nodes), part[~right], level + 1), (len(nodes) + 1, part[right], level + 1)]
            nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
        grown.append(nodes)
    size = max(map(len, grown))
    table = np.array([nodes + [[-1, 0.0, 0, 0.0]] * (size - len(nodes)) for nodes in grown])
    return Forest(
        table[:, :, 0].astype(np.int64), table[:, :, 1], table[:, :, 2].astype(np.int64), table[:, :, 3], depth,
        max(_average_path(min(sample, max(2, len(rows)))), 1.0),
    )


def base_failed(n_words="n_words", n_repeat_words="n_repeat_words"):
    return (F.col(n_words) < MIN_WORDS) | (100 * F.col(n_repeat_words) > MAX_REPEATED * F.col(n_words))


def fit_forests(counted: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> list[Forest]:
    """A forest for each family on about `trees` * `sample` rows, chosen by a hash out of all that pass the
    base rules."""
    sound = counted.where(~base_failed())
    n = sound.count()
    parts = 1 << 30
    share = min(parts, int(np.ceil(parts * trees * sample / max(1, n))))
    mixed = F.pmod(F.xxhash64(F.col("given.doc_id"), *COUNTS, *RATES, F.lit(seed)), F.lit(parts))
    chosen = sound.where(mixed < share).select(*RATES)
    rows = np.array(sorted(tuple(row) for row in chosen.collect()), float).reshape(-1, len(RATES))
    return [grow(rows[:, _places(family)], trees, sample, seed) for family in FAMILIES]


def _places(family: tuple[str, ...]) -> list[int]:
    return [RATES.index(name) for name in family]


def _scores(rows: np.ndarray, forests: list[Forest]) -> np.ndarray:
    """The score of each row in each family."""
    return np.stack([forest.scores(rows[:, _places(family)]) for forest, family in zip(forests, FAMILIES)], axis=1)


def with_oddness(counted: DataFrame, forests: list[Forest]) -> DataFrame:
    """The rows with their score in each family, `oddness`."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.stack([np.asarray(batch[name], float) for name in RATES], axis=1)
            scores = _scores(rows, forests)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(FAMILIES)
            oddness = pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, oddness], names=[*batch.schema.names, "oddness"])

    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in counted.schema)
    return counted.mapInArrow(score, f"{kinds}, oddness array<double>")


def thresholds(scored: DataFrame, labels: DataFrame, good_weight: float = GOOD_WEIGHT) -> list[float]:
    """The oddness from which on each family rejects, 2.0 for never.

    `labels` has `doc_id` and `quality` (1 good, 0 bad, NULL ignored). Family by family, among the labelled
    rows that the families before have left, that limit is chosen where the share of the bad documents that
    goes, less `good_weight` times the share of the good ones, is largest; of a range that parts the same
    rows, its middle. Only counts by score leave the executors, at most 2 * BINS a family.
    """
    marked = labels.select("doc_id", "quality").where("quality is not null and doc_id is not null").distinct()
    rows = scored.where(~base_failed()).select(F.col("given.doc_id").alias("doc_id"), "oddness")
    left = written(rows.join(marked, "doc_id").select("quality", "oddness"), "labelled")
    limits: list[float] = []
    all_good = all_bad = 1.0
    for family in range(len(FAMILIES)):
        odd = F.get("oddness", F.lit(family))
        counts = left.groupBy(F.floor(odd * BINS).cast("int").alias("bin"), "quality").count().collect()
        good, bad = np.zeros(BINS + 2), np.zeros(BINS + 2)
        for row in counts:
            (good if row["quality"] else bad)[row["bin"]] += row["count"]
        if not family:
            all_good, all_bad = max(1.0, good.sum()), max(1.0, bad.sum())
        # What goes if everything from a bin on is rejected.
        gain = bad[::-1].cumsum()[::-1] / all_bad - good_weight * good[::-1].cumsum()[::-1] / all_good
        best = np.flatnonzero(gain >= gain.max() - 1e-12)
        # Bins in a row that part the same rows; the lowest such range.
        end = next((place for place, (one, two) in enumerate(zip(best, best[1:])) if two != one + 1), len(best) - 1)
        limits.append(float((best[0] + best[end]) / 2 / BINS) if gain.max() >= LEAST_GAIN else 2.0)
        left = left.where(odd < limits[-1])
    return limits


@dataclass
class Rules:
    """What a corpus has taught: the forests, and from which oddness on each rejects."""

    forests: list[Forest]
    limits: list[float]


def _verdict(scored: DataFrame, rules: Rules) -> DataFrame:
    failed = base_failed()
    odd = [F.get("oddness", F.lit(place)) >= limit for place, limit in enumerate(rules.limits)]
    return scored.withColumns({"base_failed": failed, "kept": ~reduce(or_, odd, failed)})


def _learn(counted: DataFrame, labels: DataFrame) -> tuple[DataFrame, Rules]:
    forests = fit_forests(counted)
    scored = written(with_oddness(counted, forests), "oddness")
    return scored, Rules(forests, thresholds(scored, labels))


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, the base counts, `base_failed`, `oddness` by family and `kept` for every row.

    NULL texts are empty and fail the base rules, as do all short texts; a NULL `doc_id` has no label;
    repeated rows are judged one by one and alike; columns other than `doc_id` and `text` are not
    looked at; texts of any length count whole. An empty table has no rows, and without labels only the base rules reject. The statistics
    are staged; texts are read once.
    """
    scored, rules = _learn(written(with_statistics(docs, ["doc_id"]), "statistics"), labels)
    return _verdict(scored, rules).select("given.doc_id", *COUNTS, "base_failed", "oddness", "kept")


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that `judge_documents` keeps. Texts are read a second time instead
    of being staged or shuffled, and each batch is cut down where it is judged. NULLs, repeated rows, long texts and empty
    tables are as `judge_documents` has them; columns of any name stay as they are."""
    _, rules = _learn(written(with_statistics(docs, ["doc_id"]), "statistics"), labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([statistics(text.as_py()) for text in batch["text"]], float)
            found = found.reshape(-1, len(COUNTS) + len(RATES))
            n_words, repeated = found[:, COUNTS.index("n_words")], found[:, COUNTS.index("n_repeat_words")]
            gone = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED * n_words)
            scores = _scores(found[:, len(COUNTS):], rules.forests)
            gone |= (scores >= np.array(rules.limits)).any(axis=1)
            yield batch.filter(pa.array(~gone))

    return docs.mapInArrow(keep, docs.schema)
