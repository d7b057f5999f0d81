"""Token ids as the tokenizers library gives them, by the fastest way that gives the same.

Most texts go whole to a byte-pair merger that takes a vocabulary as ranks. It joins any two neighbours that make a
token, the library only pairs that its list of merges has. Both come to the same if every token, taken as a text,
is merged into itself: two neighbours that make a token are then a pair of the list, as they would be in
the token alone. Vocabularies are tested for that when they are loaded. Characters that releases of Unicode
could class differently, and special tokens, keep a text from this way.

Other texts are looked up once per run of text between single blanks. A byte-level tokenizer cuts a text with a fixed pattern before it merges anything. Where a single
blank or line end stands between two other characters, that pattern always cuts before the
blank, and around the line end. So the runs between such places can be encoded on their own, and a
run that occurs again is looked up. Texts with other white space take a slower way to the same
ids; a tokenizer that works differently gets whole texts.
"""

import json
import re
from functools import lru_cache

import numpy as np

ID = np.dtype("<u4")
# Of the runs that it meets, a worker keeps the last this many at least, and twice as many at most;
# longer ones than LONGEST_RUN it does not keep.
RECENT_RUNS, LONGEST_RUN = 250_000, 40
# Fixed value: the pattern by which a byte-level tokenizer cuts a text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A word of Latin letters with punctuation after it, which the pattern parts as it is parted here.
PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")
# Characters that have been letters, digits, blanks or neither since early releases of Unicode: Latin, Greek,
# Cyrillic, punctuation, kana, and the first blocks of Chinese and Korean.
SETTLED = re.compile(
    "[\t\n\x0b\x0c\r -~¡-ɏΑ-ΡΣ-ώА-яЁё‐-‧‰-⁞ぁ-んァ-ヺ一-龥가-힣]*"
)
EVEN_CUT = re.compile(r"(?<=\S)([ \n])(?=\S)")


class _Uneven(Exception):
    """White space beside a place where the text was cut."""


class _Runs(dict):
    """Runs already encoded; a missing one is encoded on its first use.

    When RECENT_RUNS are kept, they become the old ones, and the old ones before them go; an old
    run that is used again becomes recent.
    """

    def __init__(self, encoder: "Encoder", before: str):
        super().__init__()
        self.encoder, self.before, self.old, self.most = encoder, before, {}, RECENT_RUNS

    def __missing__(self, run: str) -> bytes:
        ids = self.old.get(run)
        if ids is None:
            if not run or run[0].isspace() or run[-1].isspace():
                raise _Uneven
            ids = self.encoder.run(self, run)
        self.keep(run, ids)
        return ids

    def keep(self, run: str, ids: bytes) -> None:
        if len(run) <= LONGEST_RUN:
            if len(self) >= self.most:
                self.age()
            self[run] = ids

    def age(self) -> None:
        """Make the recent runs the old ones."""
        self.old = dict(self)
        self.clear()


def byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte: printable bytes stand for
    themselves, the others get letters from 256 on, in order."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = [byte for byte in range(256) if byte not in printable]
    return [chr(byte) if byte in printable else chr(256 + others.index(byte)) for byte in range(256)]


def cuts_evenly(settings: dict) -> bool:
    """Whether a tokenizer, by its settings, cuts as the module's docstring says."""
    before = settings.get("pre_tokenizer") or {}
    return (
        settings.get("normalizer") is None
        and settings["model"]["type"] == "BPE"
        and not settings["model"].get("dropout")
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not any(
            token["lstrip"] or token["rstrip"] or token["single_word"] or re.search(r"\s", token["content"])
            for token in settings["added_tokens"]
        )
    )


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, without begin or end, truncation or padding."""

    def __init__(self, vocabulary: str, whole_texts: bool = False):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.even = cuts_evenly(json.loads(self.library.to_str()))
        self.model = self.library.model
        self.letters = dict(enumerate(byte_letters()))
        self.packed = [number.to_bytes(4, "little") for number in range(self.library.get_vocab_size())]
        self.inner, self.first = _Runs(self, " "), _Runs(self, "")
        self.line_end = self.whole("\n")
        self.specials = [token["content"] for token in json.loads(self.library.to_str())["added_tokens"]]
        self.merger = self._merger() if whole_texts and self.even else None

    def _merger(self):
        """The merger of whole texts; none for a vocabulary that it would read differently."""
        import tiktoken

        places = {letter: byte for byte, letter in self.letters.items()}
        words = {word: number for word, number in self.library.get_vocab(with_added_tokens=False).items()
                 if word not in self.specials}
        known = all(letter in places for word in words for letter in word)
        if not known or any(letter not in words for letter in places) or any(
            len(self.model.tokenize(word)) != 1 for word in words
        ):
            return None
        merges = json.loads(self.library.to_str())["model"]["merges"]
        made = [words.get("".join(pair if isinstance(pair, list) else pair.split(" "))) for pair in merges]
        if None in made or any(one >= other for one, other in zip(made, made[1:])) or max(
            words[letter] for letter in places
        ) >= min(made, default=len(words)):
            return None
        ranks = {bytes(places[letter] for letter in word): number for word, number in words.items()}
        return tiktoken.Encoding("byte level", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, ID).tobytes()

    def _merged(self, piece: str) -> bytes:
        """Ids of what the pattern leaves in one piece."""
        letters = piece.encode().decode("latin-1").translate(self.letters)
        packed = self.packed
        return b"".join([packed[token.id] for token in self.model.tokenize(letters)])

    def run(self, runs: _Runs, run: str) -> bytes:
        if run.isascii() and run.isalpha():
            return self._merged(runs.before + run)
        plain = PLAIN.fullmatch(runs.before + run)
        if not plain:
            return self.whole(runs.before + run)
        word, marks = plain.groups()
        if not marks:
            return self._merged(word)
        return runs[word[len(runs.before):]] + self._merged(marks)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.even:
            return self.whole(text)
        if self.merger and SETTLED.fullmatch(text) and not any(special in text for special in self.specials):
            return self.merger.encode_to_numpy(text, disallowed_special=()).astype(ID, copy=False).tobytes()
        ids, first, inner = [], self.first, self.inner.__getitem__
        try:
            for line in text.split("\n"):
                runs = line.split(" ")
                ids.append(first[runs[0]])
                del runs[0]
                ids.extend(map(inner, runs))
                ids.append(self.line_end)
            ids.pop()
            return b"".join(ids)
        except _Uneven:
            return b"".join(self._uneven(text))

    def _uneven(self, text: str):
        parts = EVEN_CUT.split(text)
        yield self._part("", parts[0])
        for blank, part in zip(parts[1::2], parts[2::2]):
            if blank == "\n":
                yield self.line_end
                yield self._part("", part)
            else:
                yield self._part(" ", part)

    def _part(self, before: str, part: str) -> bytes:
        runs = self.inner if before else self.first
        found = runs.get(part)
        if found is not None:
            return found
        if part and not part[0].isspace() and not part[-1].isspace():
            return runs[part]
        return self.whole(before + part)


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One encoder per worker, kept over its tasks."""
    return Encoder(vocabulary, whole_texts=True)
