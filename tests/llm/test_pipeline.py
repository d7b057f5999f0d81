"""The pipeline against a plain version of each stage, and as a whole."""

import pathlib
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
from tokenizers import Tokenizer

import __spark_entry__ as entry
from curate.llm.personal_data import KINDS, find_personal_data
from curate.llm.queries import VOCABULARY
from curate.session import shared_dir, written
from tests.llm.conftest import SF_DIR
from tests.llm.test_duplicates import groups, normal, plain_print
from tests.llm.test_packing import check
from tests.llm.test_personal_data import plain
from tests.llm.test_quality import plain_counts, plain_failed


def test_stages(spark, documents, labels):
    docs, results, frames = documents, [], []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), "test-stage")
        results.append(docs.collect())
        frames.append(docs)
    rules, exact, near, clean, packed = results
    quality = {row["doc_id"]: row["quality"] for row in labels.collect()}
    given = documents.collect()

    kept = {row["doc_id"] for row in rules}
    for row in given:
        failed = plain_failed(plain_counts(row["text"]))
        assert not (failed and row["doc_id"] in kept)
        if quality.get(row["doc_id"]) == 1 and not failed:
            assert row["doc_id"] in kept
        if quality.get(row["doc_id"]) == 0:
            assert row["doc_id"] not in kept

    first: dict = {}
    for row in sorted(rules, key=lambda row: row["doc_id"]):
        first.setdefault(normal(row["text"]), row)
    assert Counter(exact) == Counter(first.values())

    roots = groups([plain_print(row["text"]) for row in exact], 2)
    first = {}
    for row in sorted(exact, key=lambda row: row["doc_id"]):
        first.setdefault(roots[plain_print(row["text"])], row)
    assert Counter(near) == Counter(first.values())

    texts = {row["doc_id"]: row["text"] for row in near}
    assert {row["doc_id"] for row in clean} == set(texts)
    found = {row["doc_id"]: row["spans"] for row in find_personal_data(frames[2]).collect()}
    for row in clean:
        text, spans = texts[row["doc_id"]], [span.split(":") for span in found[row["doc_id"]].split(",") if span]
        based = {(int(start), int(end)) for _, start, end in spans}
        assert all(tuple(span) in based for own in plain(text) for span in own)
        at, pieces = 0, []
        for start, end, kind in sorted((int(start), int(end), KINDS.index(kind)) for kind, start, end in spans):
            if start >= at:
                pieces += [text[at:start], f"<{KINDS[kind]}>"]
            at = max(at, end)
        assert row["text"] == "".join(pieces) + text[at:]
        assert row["n_chars"] == len(row["text"])

    library = Tokenizer.from_file(VOCABULARY)
    expected = Counter()
    for row in clean:
        ids = np.array([*library.encode(row["text"], add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for piece, (start, stop) in enumerate(zip(cuts, cuts[1:])):
            expected[row["doc_id"], piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())] += 1
    assert Counter(tuple(row)[:5] for row in packed) == expected
    assert check(packed, 1024) <= -(-sum(row["length"] for row in packed) // 1024) * 1.03 + 1


def test_run_is_registered_and_leaves_its_last_table_only(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    folder = pathlib.Path(shared_dir(spark)) / "curate"
    before = set(folder.glob("*"))
    found = corpus_pipeline.run(spark, SF_DIR)
    assert [path.name.rsplit("-", 1)[0] for path in set(folder.glob("*")) - before] == ["stage-best_fit_packing"]
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 100


def test_hard_rows_pass_all_stages(spark, hard, nothing):
    for docs in (hard, nothing):
        for name, stage in corpus_pipeline.STAGES:
            if name == "quality_rules":
                # It leaves few of these rows: the other stages take all of them.
                assert stage(spark, docs, SF_DIR).columns == docs.columns
                assert stage(spark, docs, SF_DIR).count() <= docs.count()
                continue
            columns = docs.columns
            docs = written(stage(spark, docs, SF_DIR), "test-stage")
            assert name == "best_fit_packing" or docs.columns == columns
        docs.count()
