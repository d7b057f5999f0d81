"""Personal data: base spans against plain patterns, and what the method adds."""

import hashlib
import random
import re
from collections import Counter

import pytest

from curate.llm.personal_data import KINDS, Votes, estimate, find_personal_data, train, without_personal_data
from curate.llm.queries import QUERIES
from tests.llm.conftest import HARD, SF_DIR

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    doubled = [int(c) * (1 + place % 2) for place, c in enumerate(reversed(number))]
    return sum(value - 9 * (value > 9) for value in doubled) % 10 == 0


def plain(text):
    """The base spans of a text by kind."""
    text = text or ""
    return [
        [m.span() for m in EMAIL.finditer(text)],
        [m.span() for m in IP.finditer(text) if all(int(part) <= 255 for part in m.group().split("."))],
        [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))],
        [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15],
    ]


def listed(spans):
    return ",".join(f"{kind}:{start}:{end}" for kind, own in zip(KINDS, spans) for start, end in own)


def expected(rows):
    return Counter(
        (doc_id, *map(len, plain(text)), hashlib.sha256(listed(plain(text)).encode()).hexdigest())
        for doc_id, text in rows
    )


NASTY = [
    (100, "a@b.c_d@e.f, a@b..c x@-.y ++1 2 34 567 890 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004"),
    (101, "1" * 20_000), (102, "a" * 20_000 + "@" + "b." * 3_000), (103, "+1" + " " * 5_000 + "2"),
    (104, "4111 1111-1111 1111 and 4111111111111112 call +49 (30) 123-4567 😀 é +1 727 555 6430)"),
    (105, "1.2.3.4 " * 500), (106, "@@@@a@@b.c@d.e"), (106, "+4912345678+4912345678912+1-"),
    (107, "0.0.0." * 3_000), (108, "-._%+" * 3_000),
]


def check(found, rows):
    texts = dict(rows)
    assert Counter(tuple(row)[:6] for row in found) == expected(rows)
    for row in found:
        own = set(filter(None, row["spans"].split(",")))
        if [doc_id for doc_id, _ in rows].count(row["doc_id"]) == 1:
            assert own >= set(filter(None, listed(plain(texts[row["doc_id"]])).split(",")))
        keys = [(KINDS.index(kind), int(start)) for kind, start, _ in (span.split(":") for span in sorted(
            own, key=lambda span: row["spans"].index(span)))]
        assert keys == sorted(keys)


def test_hard_rows(spark, hard, nothing):
    check(find_personal_data(hard).collect(), HARD)
    check(find_personal_data(spark.createDataFrame(NASTY, "doc_id long, text string")).collect(), NASTY)
    assert find_personal_data(nothing).count() == 0


def test_random_texts(spark):
    picked = random.Random(5)
    parts = ["1", "23", "4", "@", "a", "b.", ".", " ", "-", "+", "(", ")", "é", "😀", "com", "255", "0", "41111111111"]
    rows = [(number, "".join(picked.choice(parts) for _ in range(picked.randrange(1, 60)))) for number in range(2000)]
    check(find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_given_documents(spark, documents):
    check(QUERIES["op9_weak_supervision"](spark, SF_DIR).collect(), [
        (row["doc_id"], row["text"]) for row in documents.collect()
    ])


def test_added_spans(spark):
    rows = [(number, f"please email ann{number}@example.com or phone +1 415 555 26{number:02d} today") for number in range(60)]
    rows += [(60 + number, f"call me, phone (415) 555-26{number:02d} please") for number in range(40)]
    rows += [(200, "mail ann (at) example.com"), (201, "order no. 1234567890123 and part 999-99"), (202, "x 1.2.3")]
    found = {row["doc_id"]: row["spans"] for row in find_personal_data(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[60 + number] == "phone:15:29" for number in range(40))
    assert found[200] == "email:5:25"
    assert not found[201] and not found[202]


def test_no_span_is_left_in_cleaned_texts(spark, hard):
    rows = spark.createDataFrame(NASTY[:1] + NASTY[4:] + [(300, "é😀 a@b.cc +1 415 555 2671😀")], "doc_id long, text string")
    cleaned = {row["doc_id"]: row["text"] for row in without_personal_data(rows).collect()}
    assert cleaned[300] == "é😀 <email> <phone>😀"
    assert cleaned[105] == "<ip> " * 500
    kept = without_personal_data(hard)
    assert kept.columns == hard.columns
    texts = Counter(row["text"] for row in kept.collect())
    assert texts[None] == 2 and texts["word " * 30_000] == 1
    assert any("<email>" in text and "<phone>" in text and "<card>" in text and "<ip>" in text for text in texts if text)


def test_reliabilities():
    """Two labelers that agree are believed, one that votes at random is not."""
    ways = []
    for real, n in ((1, 300), (-1, 700)):
        for noise in (-1, 1):
            ways += [Votes(0, (real, real, noise, 0), 0.45 * n), Votes(0, (real, 0, noise, 0), 0.04 * n),
                     Votes(0, (-real, real, noise, 0), 0.01 * n)]
    estimate(ways)
    assert all((way.belief > 0.9) == (way.votes[1] == 1) for way in ways if way.votes[1] and way.votes[0] == way.votes[1])
    weights = train(ways)
    base = 1
    assert abs(weights[base + 6 + 2] - weights[base + 6]) < 0.5 * abs(weights[base + 2] - weights[base])


def test_native(spark):
    plan = QUERIES["op9_weak_supervision"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("text, spans", [("1234567812345670", "card:0:16"), ("1234567812345678", "")])
def test_checksum(spark, text, spans):
    found = find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (found["n_card"] == 1) == bool(spans)


def test_tens_of_thousands_of_matches_in_a_text(spark):
    """Places are running sums, and contexts come from what is between matches: this many would not end else."""
    rows = [
        (1, "ab 1234 " * 64_000), (2, "call +1 415 555 2671 or é " * 20_000 + "x"),
        (3, "".join(f"{'é' * (n % 7)}{n % 300}.2.3.4 a{n}@b.org 4111111111111111 ," for n in range(6_000))),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = find_personal_data(docs).collect()
    check(found, rows)
    assert {row["doc_id"]: row["n_phone"] for row in found} == {1: 0, 2: 20_000, 3: 0}
    cleaned = {row["doc_id"]: row["text"] for row in without_personal_data(docs).collect()}
    for row in found:
        # The text cut at the spans, one after the other.
        spans = sorted((int(start), -int(end), KINDS.index(kind)) for kind, start, end in (
            span.split(":") for span in row["spans"].split(",") if span))
        text, at, parts = dict(rows)[row["doc_id"]], 0, []
        for start, end, kind in spans:
            if start >= at:
                parts += [text[at:start], f"<{KINDS[kind]}>"]
            at = max(at, -end)
        assert cleaned[row["doc_id"]] == "".join(parts) + text[at:]


def test_recall_of_what_the_method_adds(spark, documents):
    """Personal data in forms that the base rules do not have, planted in whole documents."""
    rng = random.Random(9)
    names, hosts = ["ann.lee", "joe", "m_smith", "kim42"], ["example", "mail-hub", "corp"]
    rows = [tuple(row) for row in documents.select("doc_id", "text").orderBy("doc_id").collect()]
    planted, texts = [], []
    for number, (doc_id, text) in enumerate(rows):
        kind = ("email", "ip", "phone")[number % 3]
        value = {
            "email": f"{rng.choice(names)} (at) {rng.choice(hosts)} (dot) {rng.choice(['com', 'org', 'de'])}",
            "ip": ":".join(f"{rng.randrange(1, 65536):x}" for _ in range(8)),
            "phone": f"({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}",
        }[kind]
        lead = {"email": "Contact: ", "ip": "the server address is ", "phone": "Call "}[kind] if number % 2 else "and "
        at = (text or "").rfind(" ") + 1
        whole = f"{(text or '')[:at]}{lead}{value} {(text or '')[at:]}"
        texts.append((doc_id, whole))
        planted.append((doc_id, f"{kind}:{at + len(lead)}:{at + len(lead) + len(value)}"))
    found = find_personal_data(spark.createDataFrame(texts, "doc_id long, text string").repartition(4)).collect()
    spans = {row["doc_id"]: set(row["spans"].split(",")) for row in found}
    caught = Counter(span.split(":")[0] for doc_id, span in planted if span in spans[doc_id])
    given = Counter(span.split(":")[0] for _, span in planted)
    print(caught, given)
    assert all(caught[kind] >= 0.9 * given[kind] for kind in given)
