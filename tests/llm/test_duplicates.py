"""Exact and near duplicates against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest
from xxhash import xxh64_intdigest

from curate.llm.components import connected
from curate.llm.queries import ORACLES
from curate.llm.simhash import fingerprint, fingerprints, link_fingerprints, near_duplicates, one_of_each
from curate.llm.stream_dedup import exact_duplicates, kept_rows
from curate.session import new_path
from tests.compare import connect, rows
from tests.llm.conftest import HARD, SF_DIR, sentence


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda found: found.group().lower(), text or ""))
    shingles = [" ".join(words[at:at + 3]) for at in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(prints, distance):
    """The root of every print, by comparing all with all."""
    root = {value: value for value in prints}

    def find(value):
        while root[value] != value:
            value = root[value]
        return value

    values = list(root)
    for place, one in enumerate(values):
        for other in values[place + 1:]:
            if (one ^ other).bit_count() <= distance:
                root[find(one)] = find(other)
    return {value: find(value) for value in values}


def test_fingerprint():
    for _, text in HARD:
        assert fingerprint(text) % 2**64 == plain_print(text)


def near_copies():
    """Texts with copies that differ in one word, a few fingerprint bits apart."""
    picked = random.Random(9)
    for number in range(12):
        words = sentence(100 + number, 400).split()
        for copy in range(8):
            changed = list(words)
            for _ in range(copy and picked.randrange(1, 3)):
                changed[picked.randrange(len(words))] = f"changed{picked.randrange(5)}"
            yield number * 100 + copy, " ".join(changed)


@pytest.mark.parametrize("bucket", [1, 4, 64])
@pytest.mark.parametrize("distance", [0, 1, 2])
def test_near_duplicates(spark, distance, bucket):
    texts = [*near_copies(), (5000, None), (5001, " "), (5002, None), (7, "short one"), (7, "SHORT one")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    root = groups([plain_print(text) for _, text in texts], distance)
    least = defaultdict(lambda: 10**9)
    for doc_id, text in texts:
        name = root[plain_print(text)]
        least[name] = min(least[name], doc_id)
    expected = Counter(
        (doc_id, f"{plain_print(text):016x}", least[root[plain_print(text)]]) for doc_id, text in texts
    )
    assert Counter(map(tuple, near_duplicates(docs, distance, bucket=bucket).collect())) == expected
    if distance == 2:
        assert len(set(root.values())) < len(root)  # there are links to be found


@pytest.mark.parametrize("bucket", [1, 64])
def test_links_of_a_dense_family_stay_few(spark, bucket):
    """All prints within two bits of a centre, and chains: the components of all pairs, without all pairs."""
    centre = 0x0123456789ABCDEF
    family = {centre ^ (1 << one) ^ (1 << two) for one in range(64) for two in range(one, 64)}
    chain = [0xFFFF0000FFFF0000 ^ ((1 << 2 * step) - 1) for step in range(32)]
    prints = [value - (1 << 64) if value >> 63 else value for value in [*family, *chain]]
    links = link_fingerprints(spark.createDataFrame([(value,) for value in prints], "fp long"), 2, bucket)
    found = links.collect()
    assert all(((row["a"] ^ row["b"]) % 2**64).bit_count() <= 2 for row in found)
    if bucket == 1:
        assert len(found) <= 65 * len(prints)
    roots = {row["node"]: row["root"] for row in connected(links).collect()}
    expected = groups([value % 2**64 for value in prints], 2)
    sizes = Counter(Counter(roots.get(value, value) for value in set(prints)).values())
    assert sizes == Counter(Counter(expected.values()).values())


def test_components(spark):
    shapes = [(number, number + 1) for number in range(0, 600)]  # a chain
    shapes += [(10_000, 10_000 + number) for number in range(1, 500)]  # a star
    shapes += [(20_000, 20_000), (30_000, 30_001), (30_001, 30_000), (30_000, 30_001)]
    found = connected(spark.createDataFrame(shapes, "a long, b long")).collect()
    parts = defaultdict(set)
    for row in found:
        parts[row["root"]].add(row["node"])
    assert sorted(map(len, parts.values())) == [2, 500, 601]
    assert len(found) == 1103
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_hard_rows(hard, nothing):
    found = near_duplicates(hard).collect()
    assert Counter((row["doc_id"], row["fingerprint"]) for row in found) == Counter(
        (doc_id, f"{plain_print(text):016x}") for doc_id, text in HARD
    )
    assert {row["component_id"] for row in found if row["fingerprint"] == "0" * 16} == {1}
    kept = one_of_each(hard)
    assert kept.columns == hard.columns
    assert kept.count() == len({row["component_id"] for row in found})
    assert near_duplicates(nothing).count() == 0
    assert one_of_each(nothing).count() == 0


def test_fingerprints_of_no_rows(nothing):
    from pyspark.sql import functions as F

    assert fingerprints(nothing.withColumn("row", F.lit(0).cast("long"))).count() == 0


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def exact(rows):
    size, keep = Counter(), {}
    for doc_id, text in rows:
        key = normal(text)
        size[key] += 1
        known = keep.setdefault(key, doc_id)
        if doc_id is not None and (known is None or doc_id < known):
            keep[key] = doc_id
    return Counter((doc_id, keep[normal(text)], size[normal(text)]) for doc_id, text in rows), len(size)


@pytest.mark.parametrize("digest_chars", [64, 1])
@pytest.mark.parametrize("options", [{}, {"maxFilesPerTrigger": "1"}])
def test_exact_duplicates(spark, hard, digest_chars, options):
    path = new_path(spark, "hard documents")
    hard.union(hard.where("doc_id > 11")).repartition(4).write.parquet(path)
    texts = HARD + [row for row in HARD if (row[0] or 0) > 11]
    found = exact_duplicates(spark, path, hard.schema, digest_chars, options).collect()
    expected, n = exact(texts)
    assert Counter((row["doc_id"], row["keep_id"], row["group_size"]) for row in found) == expected
    assert sum(row["kept"] for row in found) == n
    assert all(row["doc_id"] == row["keep_id"] for row in found if row["kept"])


def test_exact_duplicates_of_no_rows(spark, nothing):
    path = new_path(spark, "no-documents")
    nothing.write.parquet(path)
    assert exact_duplicates(spark, path, nothing.schema).count() == 0
    assert kept_rows(nothing).count() == 0


def test_kept_rows(hard):
    kept = kept_rows(hard)
    assert kept.columns == hard.columns
    texts = [row["text"] for row in kept.collect()]
    assert len(texts) == len({normal(text) for text in texts}) == exact(HARD)[1]


def test_exact_duplicates_against_sql(spark):
    from curate.llm.queries import QUERIES

    found = QUERIES["op10_stream_dedup"](spark, SF_DIR)
    wanted = connect(SF_DIR).execute(ORACLES["op10_stream_dedup"])
    names = [column[0] for column in wanted.description]
    assert rows(found.columns, map(tuple, found.collect())) == rows(names, wanted.fetchall())


def test_no_python_in_exact_duplicates(spark):
    from curate.llm.queries import QUERIES

    plan = QUERIES["op10_stream_dedup"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_state_is_kept_between_runs(spark, tmp_path):
    import os

    path, state = str(tmp_path / "docs"), str(tmp_path / "state")
    first = spark.createDataFrame([(3, "a  b"), (4, "c")], "doc_id long, text string")
    first.coalesce(1).write.parquet(path)
    # A file older than any bound on the age of files.
    found = exact_duplicates(spark, path, first.schema, digest_chars=1, state=state)
    assert sorted((row.doc_id, row.keep_id, row.kept) for row in found.collect()) == [(3, 3, True), (4, 4, True)]
    more = spark.createDataFrame([(1, "a b"), (5, "c "), (6, "d")], "doc_id long, text string")
    more.coalesce(1).write.mode("append").parquet(path)
    newest = max(tmp_path.joinpath("docs").glob("*.parquet"), key=os.path.getmtime)
    os.utime(newest, (1, 1))
    found = exact_duplicates(spark, path, first.schema, digest_chars=1, state=state)
    assert sorted((row.doc_id, row.keep_id, row.group_size, row.kept) for row in found.collect()) == [
        (1, 1, 2, True), (3, 1, 2, False), (4, 4, 1, True), (5, 5, 1, True), (6, 6, 1, True)]
    again = exact_duplicates(spark, path, first.schema, digest_chars=1, state=state)
    assert again.exceptAll(found).isEmpty() and found.exceptAll(again).isEmpty()


def test_large_groups_are_dealt_out(spark, hard, monkeypatch, tmp_path):
    monkeypatch.setattr("curate.operators.skew.BROADCAST_BYTES", 0)
    monkeypatch.setattr("curate.operators.skew.PART_ROWS", 2)
    path = str(tmp_path / "docs")
    rows = [(i, "same text" if i % 3 else f"own {i}") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(path)
    for chars in (64, 1):
        found = exact_duplicates(spark, path, spark.read.parquet(path).schema, chars).collect()
        assert sorted((row.doc_id, row.keep_id, row.group_size) for row in found) == [
            (i, 1, 40) if i % 3 else (i, i, 1) for i in range(60)]
