"""BPE encoding by dynamic programming over prefixes, for vocabularies with word ends; decoding by a table.

A piece is a row of symbols: its bytes, the last one marked as the word's end. The encoding of each
prefix ends in exactly one token t, and without t it is the encoding of the shorter prefix: t is the one
vocabulary entry that is a suffix of the prefix and may follow the shorter prefix's last token. Two
tokens may follow each other if no merge across their border would have come before the merges that made
them. A suffix automaton of the vocabulary, read along with the piece, holds in each state the entries
that end there; the last token of each prefix is stored, and following them back from the end gives the
ids. No merge is carried out; each symbol looks at the entries that end there once.

Before that a text is cut at special tokens' strings, normalised (NFC, white space, lower case) and
split by the vocabulary's pattern. All of these work on runs without white space alone, so a worker
remembers the ids of short runs and pieces, each in a bounded number of bytes.

Cases: null text counts as empty (no ids); bytes of a text that aren't UTF-8 are taken as U+FFFD; a
special token's string inside a text is that token; rows with null doc_id and repeated rows are encoded
each for itself; an empty table gives none; other columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shopfloor.llm.remembered import Remembered
from shopfloor.llm.text import id_and_bytes
from shopfloor.llm.token_count import byte_symbols

BLOCK_RUNS = 1 << 16
MAX_TESTS, MAX_PLACES = 500_000, 200_000
ROOT = 0
END = 256  # added to a word's last byte

# What the library's Unicode tables have otherwise than Python's. Ranges are inclusive.
#: Letters and numbers of newer versions, which the pattern takes for neither.
UNKNOWN_SORT = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
#: Marks of newer versions, which its NFC leaves where they are.
UNKNOWN_MARKS = (
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C), (0xEBA, 0xEBA),
    (0x1715, 0x1715), (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27), (0x10EAB, 0x10EAC),
    (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85), (0x11070, 0x11070), (0x1133B, 0x1133B),
    (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x1193D, 0x1193E), (0x11943, 0x11943), (0x119E0, 0x119E0),
    (0x11A34, 0x11A34), (0x11A47, 0x11A47), (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45),
    (0x11D97, 0x11D97), (0x11F41, 0x11F42), (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136),
    (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF), (0x1E4EC, 0x1E4EF),
)
#: Capitals of newer versions and the distance to their small letters, which it knows.
NEW_CAPITALS = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 32),
    (0x16EA0, 0x16EB8, 27),
)


def _any_of(ranges: Iterable[tuple]) -> str:
    return "".join(f"{chr(lo)}-{chr(hi)}" for lo, hi, *_ in ranges)


_UNKNOWN_SORT = regex.compile(f"[{_any_of(UNKNOWN_SORT)}]")
_UNKNOWN_MARKS = regex.compile(f"([{_any_of(UNKNOWN_MARKS)}]+)")
_NEW_CAPITALS = regex.compile(f"[{_any_of(NEW_CAPITALS)}]")
_LOWER = {c: chr(c + up) for lo, hi, up in NEW_CAPITALS for c in range(lo, hi + 1)}
_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to str.split, but not to the library
_WHITE = regex.compile(r"\s+")


def normalised(run: str) -> str:
    """NFC and lower case of a run without white space, character by character as the library does."""
    if run.isascii():
        return run.lower()
    parts = _UNKNOWN_MARKS.split(run)
    run = "".join(p if i % 2 else unicodedata.normalize("NFC", p) for i, p in enumerate(parts))
    if _NEW_CAPITALS.search(run):
        run = run.translate(_LOWER)
    return run.replace("Σ", "σ").lower()  # no other small letter at a word's end


def runs(text: str) -> list[str]:
    """The longest runs without white space."""
    if _SEPARATORS.search(text):
        return [r for r in _WHITE.split(text) if r]
    return text.split()


class SuffixAutomaton:
    """Of several strings: a state is a set of substrings that occur at the same ends, each a suffix of the
    longest (``size`` symbols); ``link`` leads to the longest suffix that is in another state."""

    def __init__(self, strings: Iterable[tuple[int, ...]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = array("i", [-1]), array("i", [0])
        for string in strings:
            state = ROOT
            for symbol in string:
                state = self.extended(state, symbol)

    def state(self, size: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.size.append(size)
        return len(self.next) - 1

    def extended(self, last: int, symbol: int) -> int:
        """The state of the longest string of ``last`` followed by the symbol."""
        known = self.next[last].get(symbol)
        if known is not None:
            return known if self.size[known] == self.size[last] + 1 else self.divided(last, symbol, known)
        new = self.state(self.size[last] + 1, ROOT, {})
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at >= 0:
            to = self.next[at][symbol]
            self.link[new] = to if self.size[to] == self.size[at] + 1 else self.divided(at, symbol, to)
        return new

    def divided(self, at: int, symbol: int, to: int) -> int:
        """Takes the strings of ``to`` that are no longer than at's and the symbol into a state of their own."""
        own = self.state(self.size[at] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = own
        while at >= 0 and self.next[at].get(symbol) == to:
            self.next[at][symbol] = own
            at = self.link[at]
        return own

    def find(self, string: tuple[int, ...]) -> int:
        state = ROOT
        for symbol in string:
            state = self.next[state][symbol]
        return state


class PrefixEncoder:
    """``symbols``: id of each symbol (byte, or END + byte at a word's end); ``merges``: (left id, right id,
    made id) by rank."""

    def __init__(self, symbols: dict[int, int], merges: list[tuple[int, int, int]]):
        spelt = {token: (symbol,) for symbol, token in symbols.items()}
        #: by token: the two it is made of, and when (a single symbol: always there)
        self.parts: dict[int, tuple[int, int]] = {}
        self.made = dict.fromkeys(spelt, -1)
        self.rank: dict[int, int] = {}
        for rank, (left, right, token) in enumerate(merges):
            if token in spelt or left not in spelt or right not in spelt:
                raise ValueError("each merge must make a token of its own from earlier ones")
            spelt[token] = spelt[left] + spelt[right]
            self.parts[token], self.made[token] = (left, right), rank
            self.rank[left << 32 | right] = rank
        self.automaton = SuffixAutomaton(spelt.values())
        self.length = {token: len(string) for token, string in spelt.items()}
        #: by state: its entries, longest first
        self.entries: dict[int, list[int]] = {}
        for token in sorted(spelt, key=self.length.__getitem__, reverse=True):
            self.entries.setdefault(self.automaton.find(spelt[token]), []).append(token)
        self.forget()

    def forget(self) -> None:
        """Empties what is made when first needed: which tokens may follow which, and places."""
        #: by token: whether it may follow another (-1: the piece's beginning)
        self.follows: dict[int, dict[int, bool]] = {}
        self.tests = 0
        self.places: dict[tuple[int, int], tuple] = {}
        self.start = self.place(ROOT, 0)

    def place(self, state: int, matched: int) -> tuple:
        """A place while reading, where the longest suffix in the automaton has ``matched`` symbols of
        ``state``: places by next symbol, the entries that end here (length, what they may follow, token)
        with the longest first, state, matched."""
        known = self.places.get((state, matched))
        if known is None:
            ends, at = [], state
            while at > ROOT:
                for token in self.entries.get(at, ()):
                    if self.length[token] <= matched:
                        ends.append((self.length[token], self.follows.setdefault(token, {-1: True}), token))
                at = self.automaton.link[at]
            known = self.places[state, matched] = {}, tuple(ends), state, matched
        return known

    def step(self, place: tuple, symbol: int) -> tuple:
        edges, link, size = self.automaton.next, self.automaton.link, self.automaton.size
        _, _, state, matched = place
        while symbol not in edges[state]:
            state = link[state]
            matched = size[state]
        to = place[0][symbol] = self.place(edges[state][symbol], matched + 1)
        return to

    def may_follow(self, left: int, right: int) -> bool:
        """Whether both stay apart: undoes the merges that made them, the latest first, and asks of each two
        symbols that meet at the border whether they would have been merged while they stood there. Of equal
        ranks the one further left is merged first."""
        rank, made, until, until_right = self.rank, self.made, 1 << 40, False
        while True:
            across = rank.get(left << 32 | right)
            if across is not None and (across < until or across == until and until_right):
                return False
            if made[left] < 0 and made[right] < 0:
                return True
            if made[right] >= made[left]:
                until, until_right, right = made[right], True, self.parts[right][0]
            else:
                until, until_right, left = made[left], False, self.parts[left][1]

    def test(self, left: int, right: int) -> bool:
        self.tests += 1
        out = self.follows[right][left] = self.may_follow(left, right)
        return out

    def encode(self, piece: bytes) -> list[int]:
        """Ids of a piece."""
        if not piece:
            return []
        if self.tests > MAX_TESTS or len(self.places) > MAX_PLACES:
            self.forget()
        symbols = list(piece)
        symbols[-1] += END
        last, place, token = [-1], self.start, -1  # last token of each prefix
        for symbol in symbols:
            place = place[0].get(symbol) or self.step(place, symbol)
            for n, may, token in place[1]:  # one of them fits, as a single symbol is an entry
                before = last[-n]
                ok = may.get(before)
                if ok or ok is None and self.test(before, token):
                    break
            last.append(token)
        out, i = [], len(symbols)
        while i:
            out.append(last[i])
            i -= self.length[last[i]]
        out.reverse()
        return out


class Tokenizer:
    def __init__(self, file: dict):
        model, vocabulary = file["model"], file["model"]["vocab"]
        suffix, letter = model["end_of_word_suffix"], byte_symbols()
        symbols = {b: vocabulary[c] for b, c in letter.items()}
        symbols |= {END + b: vocabulary[c + suffix] for b, c in letter.items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.encoder = PrefixEncoder(symbols, [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges])
        self.token = {i: t for t, i in vocabulary.items()}
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        self.token |= {i: t for t, i in self.special.items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        split = next(p for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.pattern = regex.compile(split)
        unknown = f"[{_any_of(UNKNOWN_SORT)}]"
        known = split.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|{unknown})")
        self.exact = regex.compile(known.replace(r"[\p{L}]", rf"(?:(?!{unknown})\p{{L}})").replace(
            r"[\p{N}]", rf"(?:(?!{unknown})\p{{N}})"))
        self.decimal = {i: str(i) for i in self.token}
        self.of_piece = Remembered(lambda piece: array("I", self.encoder.encode(piece.encode())).tobytes())
        self.of_run = Remembered(lambda run: b"".join(map(self.of_piece.__getitem__, self.pieces(run))))

    def pieces(self, run: str) -> list[str]:
        run = normalised(run)
        pattern = self.pattern if run.isascii() or not _UNKNOWN_SORT.search(run) else self.exact
        return pattern.findall(run)

    def blocks(self, text: str) -> Iterator[array]:
        """Ids of a text, without added special tokens, block by block."""
        for i, part in enumerate(self.at_special.split(text) if self.at_special else [text]):
            if i % 2:
                yield array("I", [self.special[part]])
                continue
            found = runs(part)
            for at in range(0, len(found), BLOCK_RUNS):
                ids = array("I")
                ids.frombytes(b"".join(map(self.of_run.__getitem__, found[at:at + BLOCK_RUNS])))
                yield ids

    def encode(self, text: str) -> array:
        out = array("I")
        for ids in self.blocks(text):
            out.extend(ids)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by spaces, special ones too, as the library does without a decoder of its own."""
        return " ".join(map(self.token.__getitem__, ids))

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids and the digests of the ids joined by spaces and of the decoded text."""
        n, a, b = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.blocks(text):
            if ids:
                gap = " " if n else ""
                n += len(ids)
                a.update((gap + " ".join(map(self.decimal.__getitem__, ids))).encode())
                b.update((gap + self.decode(ids)).encode())
        return n, a.hexdigest(), b.hexdigest()


@lru_cache(maxsize=1)
def load(path: str) -> Tokenizer:
    """From a ``.json`` vocabulary with word ends; once a worker."""
    with open(path, encoding="utf-8") as f:
        return Tokenizer(json.load(f))


def encode_column(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every text. No shuffle."""
    def encode(batches):
        tokenizer = load(vocabulary)
        for batch in batches:
            for i, x in enumerate(batch.column("text")):
                ids = tokenizer.encode((x.as_py() or b"").decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, 1), pa.array([ids.tolist()], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return id_and_bytes(docs).mapInArrow(encode, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encodes every text and decodes the ids: doc_id, n_tokens and the digests of both. No shuffle.

    ``vocabulary``: the vocabulary file's path, the same on every executor."""
    def digests(batches):
        tokenizer = load(vocabulary)
        for batch in batches:
            rows = [tokenizer.digests((x.as_py() or b"").decode("utf-8", "replace")) for x in batch.column("text")]
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_bytes(docs).mapInArrow(
        digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
