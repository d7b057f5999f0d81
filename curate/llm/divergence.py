"""How far the sources of a language differ in their words.

Words are counted by sorting pointers. A shard is a run of Arrow batches; its pointers name where words start
in the batches' text buffers. They are sorted by multikey quicksort with eight bytes for a key: all pointers by
their first eight bytes, then only runs of equal ones by the next eight, until words end. A run of
equal words then gives the documents that hold the word and its count in each source. Everything
beyond a shard is grouping and joining.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curate.llm.lexical import TERM_BYTES
from curate.operators.skew import lookup_join, sendable
from curate.session import written

# A term is kept if this many documents of its language hold it.
LEAST_DOCS = 30
# Added to every count, and what a share of one is.
PRIOR, UNIT = 5, 1_000_000_000
RANKS = 50
# Text of a shard; cells of a table of terms by sources that a task compares; sources compared to all others at once.
SHARD_BYTES, CELLS, TILE = 1 << 24, 1 << 18, 256
DIGIT = 8
# Letters of a term here have no digits among them; the byte 0 ends a word.
LETTERS = np.array([
    0 if letter == ord(" ") or ord("0") <= byte <= ord("9") else letter for byte, letter in enumerate(TERM_BYTES)
], np.uint8)
# The first n bytes of a digit.
FIRST = np.array([0] + [(1 << 64) - (1 << 8 * (DIGIT - n)) for n in range(1, DIGIT + 1)], np.uint64)
RUNS = "lang string, term string, docs long, sources array<struct<source:string,n:long>>"


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow array of texts, and where each text begins in them, with the end of the last."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_pointers(letters: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start, and how long they are; no word goes on into the next text."""
    inside = letters != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(letters)]
    begins[edges] = inside[edges]
    ends = np.zeros(len(letters) + 1, bool)
    ends[1:] = inside
    ends[:-1] &= ~inside
    ends[edges[edges > 0]] |= inside[edges[edges > 0] - 1]
    ends[len(letters)] = bool(len(letters)) and inside[-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) - starts


def sort_pointers(letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pointers in the order of their words, and the number of the run of equal words each is in."""
    padded = np.concatenate([letters, np.zeros(DIGIT, np.uint8)])
    digits = np.ndarray(len(letters) + 1, ">u8", padded.data, strides=(1,))
    order = np.arange(len(starts))
    run = np.zeros(len(starts), np.int64)
    active = order.copy()
    depth = 0
    while len(active):
        # `active` are places of the order that belong to runs still to be cut.
        which = order[active]
        left = np.clip(sizes[which] - depth, 0, DIGIT)
        at = np.minimum(starts[which] + depth, len(letters))
        keys = digits[at].astype(np.uint64) & FIRST[left]
        # A word is cut off with zeros, which no word contains: equal digits mean equal words so far.
        by = np.lexsort((keys, run[active])) if depth else np.argsort(keys, kind="quicksort")
        which, keys = which[by], keys[by]
        order[active] = which
        opens = np.empty(len(active), bool)
        opens[0] = True
        opens[1:] = (keys[1:] != keys[:-1]) | (run[active][1:] != run[active][:-1])
        # Runs are named by the place of their first member, which later levels can cut again.
        heads = np.flatnonzero(opens)
        lengths = np.diff(np.append(heads, len(active)))
        run[active] = np.repeat(active[heads], lengths)
        # A word that has ended goes on with zeros beside longer ones, and so comes before them.
        longer = np.logical_or.reduceat(sizes[which] > depth + DIGIT, heads) & (lengths > 1)
        active = active[np.repeat(longer, lengths)]
        depth += DIGIT
    return order, np.cumsum(np.diff(run, prepend=-1) != 0) - 1


def shard_runs(texts: list[pa.Array], langs: list[str], sources: list[str]) -> pa.RecordBatch | None:
    """A row for each term and language of a shard: documents, and the count in each source."""
    parts = [buffer_of(part) for part in texts]
    data = np.concatenate([part for part, _ in parts])
    if not len(data):
        return None
    bases = np.cumsum([0] + [len(part) for part, _ in parts])
    offsets = np.concatenate([part[:-1] + base for (_, part), base in zip(parts, bases)] + [bases[-1:]])
    letters = LETTERS[data]
    starts, sizes = word_pointers(letters, offsets)
    if not len(starts):
        return None
    order, run = sort_pointers(letters, starts, sizes)
    doc = np.searchsorted(offsets, starts[order], "right") - 1
    lang_names, lang = np.unique(np.array(langs, object), return_inverse=True)
    source_names, source = np.unique(np.array(sources, object), return_inverse=True)
    heads = np.flatnonzero(np.diff(run, prepend=-1))
    words = [bytes(letters[at:at + size]).decode() for at, size in zip(
        starts[order[heads]].tolist(), sizes[order[heads]].tolist()
    )]
    # Runs by language: documents, then counts by source.
    held = np.unique(run * len(langs) + doc)
    owner, docs = np.unique(held // len(langs) * len(lang_names) + lang[held % len(langs)], return_counts=True)
    cells, n = np.unique(
        (run * len(lang_names) + lang[doc]) * len(source_names) + source[doc], return_counts=True
    )
    ends = np.searchsorted(cells // len(source_names), owner, "right")
    lists = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], ends]), pa.int32()),
        pa.StructArray.from_arrays([
            pa.array(source_names, pa.string()).take(pa.array(cells % len(source_names))), pa.array(n, pa.int64()),
        ], names=["source", "n"]),
    )
    return pa.RecordBatch.from_arrays([
        pa.array(lang_names, pa.string()).take(pa.array(owner % len(lang_names))),
        pa.array(words, pa.string()).take(pa.array(owner // len(lang_names))),
        pa.array(docs, pa.int64()), lists,
    ], names=["lang", "term", "docs", "sources"])


def term_runs(docs: DataFrame) -> DataFrame:
    """The runs of all shards; `docs` has `text`, `lang` and `source` without NULLs."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, langs, sources, size = [], [], [], 0
        for batch in batches:
            # Batches are cut to the size of a shard; one long text may be more than that.
            sizes = np.cumsum(pa.compute.binary_length(batch["text"]).to_numpy(zero_copy_only=False))
            first = 0
            while first < batch.num_rows:
                done = sizes[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(sizes, done + SHARD_BYTES - size, "right")))
                part = batch.slice(first, last - first)
                texts.append(part["text"])
                langs += part["lang"].to_pylist()
                sources += part["source"].to_pylist()
                size += int(sizes[last - 1] - done)
                first = last
                if size >= SHARD_BYTES or first < batch.num_rows:
                    found = shard_runs(texts, langs, sources)
                    if found is not None:
                        yield found
                    texts, langs, sources, size = [], [], [], 0
        if texts:
            found = shard_runs(texts, langs, sources)
            if found is not None:
                yield found

    import pyarrow.compute  # noqa: F401

    return docs.select("text", "lang", "source").mapInArrow(runs, RUNS)


def share(n: Column, total: Column) -> Column:
    """1 + floor(UNIT * (n + PRIOR) / total), three digits at a time so that 64 bits suffice."""
    found, rest = F.lit(0).cast("long"), n + PRIOR
    for _ in range(3):
        rest = rest * 1000
        # Nothing to divide by, if a language keeps no term.
        found = found * 1000 + F.call_function("div", rest, F.greatest(total, F.lit(1)))
        rest = F.pmod(rest, F.greatest(total, F.lit(1)))
    return found + 1


def _shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    found, rest = np.zeros(counts.shape, np.int64), counts + PRIOR
    for _ in range(3):
        rest = rest * 1000
        found = found * 1000 + rest // totals
        rest = rest % totals
    return found + 1


def _differences(counts: pa.Table, sources: pa.Table) -> pa.Table:
    """For one slice of a language's terms: summed differences between the tile's sources and all others."""
    n = sources.num_rows
    order = np.argsort(sources["number"].to_numpy())
    totals = np.maximum(sources["total"].to_numpy()[order], 1)
    tile, lang = sources["tile"][0].as_py(), sources["lang"][0].as_py()
    rows = range(tile * TILE, min(n, (tile + 1) * TILE))
    sums = np.zeros((len(rows), n), np.int64)
    if counts.num_rows:
        names = counts["term"].combine_chunks().dictionary_encode()
        term, number = names.indices.to_numpy(), counts["number"].to_numpy()
        value, n_terms = counts["n"].to_numpy(), len(names.dictionary)
        step = max(1, CELLS // (4 * n))
        by = np.argsort(term, kind="stable")
        term, number, value = term[by], number[by], value[by]
        for first in range(0, n_terms, step):
            low, high = np.searchsorted(term, [first, first + step])
            table = np.zeros((n, min(step, n_terms - first)), np.int64)
            table[number[low:high], term[low:high] - first] = value[low:high]
            table = _shares(table, totals[:, None])
            for place, row in enumerate(rows):
                sums[place] += np.abs(table - table[row]).sum(axis=1)
    left, right = np.meshgrid(np.arange(rows.start, rows.stop), np.arange(n), indexing="ij")
    other = (left != right).ravel()
    return pa.table({
        "lang": pa.array([lang] * int(other.sum()), pa.string()),
        "number": pa.array(left.ravel()[other], pa.int64()),
        "other": pa.array(right.ravel()[other], pa.int64()),
        "value": pa.array(sums.ravel()[other], pa.int64()),
    })


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """Differences between the sources of each language: `lang`, `source`, `part`, `item`, `value`, `rank`.

    Part `pair` compares a source to every other source of its language over all kept terms, part `term`
    lists the terms it uses more than its language does, down to rank `ranks`. Terms are maximal runs of
    letters and non-ASCII characters, A-Z made small. NULL text, language and source are as empty ones; a
    group without terms takes part, with a count of 0 for every kept term; a language that keeps no term has
    pairs of value 0, and one with a single source has no pairs. Equal values go by item in UTF-8 order. Each row
    is a document of its own. Texts of any length count whole. No documents: no rows. Other columns are not
    looked at.
    """
    named = docs.select(*[F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("text", "lang", "source")])
    runs = written(term_runs(named), "term-runs")
    kept = runs.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = written(kept.select("lang", "term"), "kept-terms")
    counts = written(
        runs.select("lang", "term", "sources").join(sendable(kept), ["lang", "term"])
        .select("lang", "term", F.inline("sources"))
        .groupBy("lang", "term", "source").agg(F.sum("n").alias("n")),
        "source-terms",
    )
    # Every group of the documents, with its number within the language and what a share is divided by.
    groups = named.select("lang", "source").distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    in_lang = Window.partitionBy("lang")
    groups = written(
        groups.join(sums, ["lang", "source"], "left").join(vocabulary, "lang", "left")
        .withColumns({
            "n": F.coalesce("n", F.lit(0)), "terms": F.coalesce("terms", F.lit(0)),
            "number": (F.row_number().over(in_lang.orderBy("source")) - 1).cast("long"),
        })
        .withColumns({
            "total": F.col("n") + PRIOR * F.col("terms"), "lang_total": F.sum("n").over(in_lang) + PRIOR * F.col("terms"),
            "of": F.count("*").over(in_lang),
        })
        .withColumn("slices", F.ceil(F.greatest(F.col("terms") * F.col("of"), F.lit(1)) / CELLS).cast("long"))
        .withColumn("tiles", F.ceil(F.col("of") / TILE).cast("long")),
        "source-groups",
    )
    return _pairs(counts, groups).unionByName(_terms(counts, groups, ranks))


def _pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    def upto(column: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(column) - 1))

    placed = lookup_join(
        counts, groups.select("lang", "source", "number", "slices", "tiles"), ["lang", "source"], "inner", "term"
    )
    left = placed.select(
        "lang", "term", "number", "n", F.pmod(F.xxhash64("term"), "slices").alias("slice"), upto("tiles").alias("tile")
    )
    # Columns of their own: both sides stem from the same groups.
    right = groups.select(
        F.col("lang").alias("lang"), F.col("number").alias("number"), "total", "slices", upto("tiles").alias("tile")
    ).select("lang", "number", "total", "tile", upto("slices").alias("slice"))
    keys = ["lang", "slice", "tile"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _differences, "lang string, number long, other long, value long"
    ).groupBy("lang", "number", "other").agg(F.sum("value").alias("value"))
    named = found.join(groups.select("lang", "number", "source"), ["lang", "number"]).join(
        groups.select("lang", F.col("number").alias("other"), F.col("source").alias("item")), ["lang", "other"]
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return named.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def _terms(counts: DataFrame, groups: DataFrame, ranks: int) -> DataFrame:
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    known = lookup_join(
        counts, groups.select("lang", "source", "total", "lang_total"), ["lang", "source"], "inner", "term"
    ).join(whole, ["lang", "term"])
    value = share(F.col("n"), F.col("total")) - share(F.col("lang_n"), F.col("lang_total"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        known.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
        .where("value > 0")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    )
