"""Personal data by weak supervision: labelers vote on spans, a model learns whom to trust.

Patterns propose spans: those of the base rules, and looser ones. On each span four labelers vote for,
against, or not at all: the base rule itself, a list (endings of domains, prefixes of cards, country
codes, special address ranges), the words before it, and what touches it on either side. How
reliable each labeler is for each kind comes out of expectation-maximisation over the votes of all
documents; what it believes of each span trains the final classifier, a logistic model of the
votes. Spans of the base rules always stay; others are added where the classifier is sure.

Everything that touches a text is a column expression. The votes of a span can fall in a few hundred
ways, and only how often each way occurs reaches the driver.
"""

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curate.session import written

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("rule", "known", "context", "edges")
SURE = 0.9
ROUNDS = 40
BEFORE = 32

# The base patterns, with possessive repeats and starts that spare the search inside a run that has failed as
# a whole already; what they match is the same as without.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser patterns: spelled-out addresses, the long form of internet addresses, national numbers.
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
             r"(?:\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
# What a text must hold for a pattern to match at all.
HINT = {
    ("email", True): r"@", ("email", False): r"[(\[]at[)\]]", ("ip", True): r"[0-9]\.[0-9]", ("card", True): r"[0-9]",
    ("ip", False): r":[0-9A-Fa-f]{1,4}:", ("phone", True): r"\+[0-9]", ("phone", False): r"[0-9]{3}[\x20.-][0-9]{4}",
}
# Endings of domains, prefixes of payment cards, calling codes, first parts of special addresses.
DOMAINS = ("com|org|net|edu|gov|mil|int|info|biz|io|ai|co|me|tv|app|dev|eu|us|uk|de|fr|es|it|nl|be|ch|at|pl|pt|se|no|dk|fi"
           "|ie|cz|gr|hu|ro|ru|ua|tr|in|cn|jp|kr|au|nz|ca|mx|br|ar|cl|za|il")
CARDS = r"4|5[1-5]|2[2-7]|3[0-9]|6[0-9]"
CALLING = (r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-689][0-9]|3[578][0-9]|42[0-9]|5[09][0-9]"
           r"|6[7-9][0-9]|8[05789][0-9]|9[679][0-9]")
SPECIAL = r"0|127|22[4-9]|2[3-5][0-9]"
CUES = {
    "email": "e-?mail|mail|contact|write to|address|correo|courriel",
    "ip": r"\bip\b|host|server|address|login|adresse|dirección",
    "card": "card|visa|master|amex|credit|debit|karte|carte|tarjeta|payment",
    "phone": r"phone|\btel\b|call|fax|mobile|cell|whatsapp|telefon|teléfono|téléphone|handy",
}
AGAINST = r"version|\bv\.?$|isbn|issn|\bsku\b|order|invoice|serial|part no|chapter|section|page|\bno\.? ?$|price"


def _matches(text: Column, pattern: str, hint: str) -> tuple[Column, Column]:
    """What a pattern matches in a text, and what stands between; nothing without the hint."""
    there = text.rlike(hint)
    return (
        F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")),
        F.when(there, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>")),
    )


# Elements that a running value is carried over at once, and code points of a text that are cut out of it at once.
SCANNED, CUT = 256, 1 << 14
# A context of BEFORE characters is within so many pieces before a match, matches and what is between them.
PIECES_BEFORE = 24


def _let(value: Column, use) -> Column:
    """An expression over a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _running(values: Column, start: Column, join) -> Column:
    """The running value at each element of an array of longs, the element included.

    A list that grows by one element is copied each time, so it grows within blocks of SCANNED elements; what
    each block starts with is carried over in a list of blocks.
    """
    def grown(block: Column, first: Column) -> Column:
        begin = F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("out"))

        def step(seen: Column, value: Column) -> Column:
            return _let(join(seen["at"], value), lambda at: F.struct(
                at.alias("at"), F.concat(seen["out"], F.array(at)).alias("out")
            ))

        return F.aggregate(block, begin, step, lambda seen: seen["out"])

    def of_blocks(blocks: Column) -> Column:
        lasts = F.transform(blocks, lambda block: F.aggregate(block, start, join))
        firsts = _let(grown(lasts, start), lambda ends: F.concat(F.array(start), ends))
        return F.flatten(F.zip_with(F.slice(firsts, F.lit(1), F.size(blocks)), blocks, lambda first, block: grown(block, first)))

    def whole(items: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / SCANNED).cast("int"))
        blocks = F.transform(numbers, lambda number: F.slice(items, number * SCANNED + 1, F.lit(SCANNED)))
        return F.when(F.size(items) > 0, _let(blocks, of_blocks)).otherwise(F.array().cast("array<bigint>"))

    return _let(values, whole)


def _sums(values: Column) -> Column:
    return _running(values, F.lit(0).cast("bigint"), lambda at, value: at + value)


def _highest(values: Column) -> Column:
    return _running(values, F.lit(0).cast("bigint"), lambda at, value: F.greatest(at, value))


def _places(found: str, between: str) -> Column:
    """`start`, `end` and `value` of each match, in code points, with the BEFORE characters before it and the one after.

    All of it comes from the matches and what stands between them; nothing is looked up in the text, where finding
    a place means counting from its start.
    """
    values, gaps = F.col(found), F.slice(F.col(between), F.lit(1), F.size(found))
    lengths = F.zip_with(gaps, values, lambda gap, value: (F.length(gap) + F.length(value)).cast("bigint"))

    def end_of(piece: Column) -> Column:
        return F.substring(piece, -BEFORE, BEFORE)

    pieces = F.flatten(F.zip_with(gaps, values, lambda gap, value: F.array(end_of(gap), end_of(value))))

    def placed(ends: Column, pieces: Column) -> Column:
        def place(value: Column, number: Column) -> Column:
            last = 2 * number + 1
            before = F.slice(pieces, F.greatest(last - PIECES_BEFORE + 1, F.lit(1)), F.least(last, F.lit(PIECES_BEFORE)))
            gap, follower = F.get(F.col(between), number + 1), F.get(F.col(found), number + 1)
            return F.struct(
                (F.get(ends, number) - F.length(value)).alias("start"), F.get(ends, number).alias("end"), value.alias("value"),
                F.lower(end_of(F.array_join(before, ""))).alias("before"),
                F.substring(F.concat(F.substring(gap, 1, 1), F.coalesce(F.substring(follower, 1, 1), F.lit(""))), 1, 1).alias("after"),
            )

        return F.transform(values, place)

    return _let(_sums(lengths), lambda ends: _let(pieces, lambda parts: placed(ends, parts)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def step(total: Column, place: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(place % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """Whether a match of the base pattern passes the rest of the base rule."""
    digits = _digits(value)
    if kind == "ip":
        small = r"^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
        return F.forall(F.split(value, r"\."), lambda part: part.rlike(small))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _known(kind: str, value: Column) -> Column:
    """The vote of the lists."""
    if kind == "email":
        yes = F.lower(value).rlike(rf"(\.|dot[)\]]|\x20)\x20?({DOMAINS})$")
    elif kind == "ip":
        yes = ~value.rlike(rf"^0*({SPECIAL})\.")
    elif kind == "card":
        yes = _digits(value).rlike(f"^({CARDS})")
    else:
        yes = F.when(value.startswith("+"), _digits(value).rlike(f"^({CALLING})")).otherwise(
            _digits(value).rlike("^[2-9]")
        )
    return _vote(yes, ~yes)


def _candidates(kind: str, base: bool, places: Column) -> Column:
    """Spans with the votes of the labelers."""
    def judged(place: Column) -> Column:
        value, start, end, before, after = (place[name] for name in ("value", "start", "end", "before", "after"))
        touched = before.rlike(r"[\p{L}\p{N}_@]$") | after.rlike(r"[\p{L}\p{N}_@]")
        holds = _holds(kind, value) if base else F.lit(False)
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), end.alias("end"),
            holds.alias("base"), (_vote(holds, ~holds) if base else F.lit(0)).alias("rule"),
            _known(kind, value).alias("known"),
            _vote(before.rlike(CUES[kind]), before.rlike(AGAINST)).alias("context"),
            _vote(~touched, touched).alias("edges"),
        )

    return F.transform(places, judged)


def with_candidates(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`given`, a struct of some columns of `docs`, the `text` (NULL as empty), and its candidate `spans`."""
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in columns]).alias("given"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    patterns = [(kind, True, BASE[kind]) for kind in KINDS] + [(kind, False, LOOSE[kind]) for kind in LOOSE]
    parts = {}
    for kind, base, pattern in patterns:
        name = f"{kind}_{'base' if base else 'loose'}"
        parts[f"{name}_in"], parts[f"{name}_out"] = _matches(F.col("text"), pattern, HINT[kind, base])
    rows = rows.withColumns(parts)
    spans = [
        _candidates(kind, base, _places(f"{name}_in", f"{name}_out"))
        for kind, base, _ in patterns for name in [f"{kind}_{'base' if base else 'loose'}"]
    ]
    # By kind, then start; a kind's looser spans are sorted in.
    return rows.select("given", "text", F.array_sort(F.concat(*spans)).alias("spans"))


@dataclass
class Votes:
    """How often the labelers voted so on spans of a kind."""

    kind: int
    votes: tuple[int, ...]
    n: float
    belief: float = 0.5


def estimate(ways: list[Votes], rounds: int = ROUNDS) -> None:
    """Set the belief of each way of voting, by expectation-maximisation over the kinds one by one."""
    for kind in range(len(KINDS)):
        own = [way for way in ways if way.kind == kind]
        if not own:
            continue
        # To begin with, a labeler is right four times as often as wrong.
        for way in own:
            way.belief = 1 / (1 + 4.0 ** -sum(way.votes))
        for _ in range(rounds):
            total = sum(way.n for way in own)
            real = sum(way.n * way.belief for way in own)
            prior = (real + 1) / (total + 2)
            odds = {}
            for labeler in range(len(LABELERS)):
                for vote in (-1, 0, 1):
                    so = [way for way in own if way.votes[labeler] == vote]
                    # A pseudo-count keeps a labeler that was never wrong from being certain, and the first
                    # guess where no one voted.
                    yes = sum(way.n * way.belief for way in so) + 0.5 * 2.0 ** vote
                    no = sum(way.n * (1 - way.belief) for way in so) + 0.5 * 2.0 ** -vote
                    odds[labeler, vote] = math.log((yes / (real + 2)) / (no / (total - real + 2)))
            for way in own:
                sum_odds = math.log(prior / (1 - prior)) + sum(odds[pair] for pair in enumerate(way.votes))
                way.belief = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum_odds))))


def _features(way: Votes) -> list[int]:
    """The weights that a way of voting uses: one of its kind, and one for each vote."""
    width = 1 + 3 * len(LABELERS)
    return [way.kind * width, *(way.kind * width + 1 + 3 * place + vote + 1 for place, vote in enumerate(way.votes))]


def train(ways: list[Votes], steps: int = 400, rate: float = 0.5, penalty: float = 1e-3) -> list[float]:
    """Weights of the span classifier, fitted to the beliefs."""
    weights = [0.0] * (len(KINDS) * (1 + 3 * len(LABELERS)))
    for kind in range(len(KINDS)):
        own = [(way, _features(way)) for way in ways if way.kind == kind]
        total = sum(way.n for way, _ in own)
        for _ in range(steps if own else 0):
            slope = dict.fromkeys({place for _, places in own for place in places}, 0.0)
            for way, places in own:
                guess = 1 / (1 + math.exp(-sum(weights[place] for place in places)))
                for place in places:
                    slope[place] += way.n / total * (guess - way.belief)
            for place, change in slope.items():
                weights[place] -= rate * (change + penalty * weights[place])
    return weights


def fit(candidates: DataFrame) -> list[float]:
    """The classifier, from the votes on all candidate spans."""
    span = F.explode("spans").alias("span")
    rows = candidates.select(span).groupBy("span.kind", *[f"span.{name}" for name in LABELERS]).count().collect()
    ways = [Votes(row["kind"], tuple(row[name] for name in LABELERS), row["count"]) for row in sorted(rows)]
    estimate(ways)
    return train(ways)


def _score(span: Column, weights: list[float]) -> Column:
    table = F.array(*map(F.lit, weights))
    start = span["kind"] * (1 + 3 * len(LABELERS))
    places = [start, *(start + 2 + 3 * place + span[name] for place, name in enumerate(LABELERS))]
    return reduce(Column.__add__, [F.element_at(table, place + 1) for place in places])


def with_spans(candidates: DataFrame, weights: list[float], sure: float = SURE) -> DataFrame:
    """`candidates` with `spans` cut down to those of the base rules (`base`) and those the classifier adds.

    An added span does not overlap one of the base rules.
    """
    least = math.log(sure / (1 - sure))
    far = F.lit(2**62).cast("bigint")

    # By start: the base spans before a span end at the most where the running maximum is, the ones after begin
    # at the least where the running maximum from the end is, negated.
    def chosen(spans: Column) -> Column:
        ends = _highest(F.transform(spans, lambda span: F.when(span["base"], span["end"]).otherwise(0)))
        begins = _highest(F.reverse(F.transform(spans, lambda span: F.when(span["base"], far - span["start"]).otherwise(0))))

        def stays(ends: Column, begins: Column) -> Column:
            def one(span: Column, number: Column) -> Column:
                clear = (F.get(ends, number) <= span["start"]) & (
                    far - F.get(begins, F.size(spans) - 1 - number) >= span["end"]
                )
                return F.when(span["base"] | ((_score(span, weights) >= least) & clear), span)

            return F.filter(F.transform(spans, one), lambda span: span.isNotNull())

        return _let(ends, lambda ends: _let(begins, lambda begins: stays(ends, begins)))

    by_start = F.array_sort(F.transform("spans", lambda span: F.struct(span["start"].alias("from"), span.alias("span"))))
    sorted_spans = F.transform(by_start, lambda pair: pair["span"])
    return candidates.withColumn("spans", F.array_sort(_let(sorted_spans, chosen)))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda span: F.concat_ws(
        ":", F.element_at(names, span["kind"] + 1), span["start"], span["end"]
    )), ",")


def _number(kind: int) -> Column:
    return F.size(F.filter("firm", lambda span: span["kind"] == kind)).cast("long")


def find_personal_data(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """`doc_id`, the number of base spans of each kind, the SHA-256 of their list, and all `spans`, per row.

    NULL texts are empty and have no spans. NULL or repeated `doc_id`s and repeated rows have their own row each;
    other columns are not looked at; texts of any length and with any number of matches count whole; an empty table has
    no rows. Texts are read once: the candidates,
    without texts, are staged in the shared folder, in numbers of their own.
    """
    narrow = written(with_candidates(docs, ["doc_id"]).select("given", "spans"), "spans")
    found = with_spans(narrow, fit(narrow)).withColumn("firm", F.filter("spans", lambda span: span["base"]))
    counts = [_number(kind).alias(f"n_{name}") for kind, name in enumerate(KINDS)]
    return found.select(
        "given.doc_id", *counts, F.sha2(_joined(F.col("firm")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def _parts(text: Column) -> Column:
    """A text in parts of CUT code points, the last of which may be shorter or empty."""
    numbers = F.sequence(F.lit(0), F.floor(F.length(text) / CUT).cast("int"))
    return F.transform(numbers, lambda number: F.substring(text, number * CUT + 1, F.lit(CUT)))


def _cut_out(parts: Column, start: Column, end: Column) -> Column:
    """The text from one code point to another, out of its parts; an end beyond the text is its end."""
    first, last = F.floor(start / CUT).cast("int"), F.floor(end / CUT).cast("int")
    skip, take = F.pmod(start, F.lit(CUT)).cast("int"), F.pmod(end, F.lit(CUT)).cast("int")
    inside = F.substring(F.get(parts, first), skip + 1, take - skip)
    over = F.concat(
        F.substring(F.get(parts, first), skip + 1, F.lit(CUT)),
        F.array_join(F.slice(parts, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
        F.coalesce(F.substring(F.get(parts, last), F.lit(1), take), F.lit("")),
    )
    return F.when(first == last, inside).otherwise(over)


def without_personal_data(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """The rows of `docs`, all columns, with `<kind>` in `text` for every span found. Where spans of several
    kinds overlap, the earliest names them, and they go together. A NULL text stays NULL; repeated rows are cleaned
    one by one; no rows give none."""
    narrow = written(with_candidates(docs, ["doc_id"]).select("spans"), "spans")
    found = with_spans(with_candidates(docs, docs.columns), fit(narrow))
    names = F.array(*[F.lit(f"<{name}>") for name in KINDS])
    ordered = F.array_sort(F.transform("spans", lambda span: F.struct(
        span["start"].alias("start"), span["end"].alias("end"), span["kind"].alias("kind")
    )))

    def cleaned(spans: Column, ends: Column, parts: Column) -> Column:
        """What stands between the spans, each of which names the piece that ends where it starts; a span that
        begins before those before it have ended goes with them."""
        def piece(span: Column, number: Column) -> Column:
            begun = F.when(number == 0, F.lit(0).cast("bigint")).otherwise(F.get(ends, number - 1))
            return F.when(span["start"] >= begun, F.concat(
                _cut_out(parts, begun, span["start"]), F.element_at(names, span["kind"] + 1)
            )).otherwise("")

        last = F.get(ends, F.size(spans) - 1)
        rest = _cut_out(parts, last, F.size(parts).cast("bigint") * CUT)
        return F.concat(F.array_join(F.transform(spans, piece), ""), rest)

    cleaned = _let(ordered, lambda spans: _let(
        _highest(F.transform(spans, lambda span: span["end"])),
        lambda ends: _let(_parts(F.col("text")), lambda parts: cleaned(spans, ends, parts)),
    ))
    text = F.when(F.size("spans") == 0, F.col("given.text")).otherwise(cleaned)
    return found.select(*[
        text.alias("text") if name == "text" else F.col(f"given.`{name}`").alias(name) for name in docs.columns
    ])
