"""Byte-level BPE as a lazily determinised transducer, and incremental UTF-8 decoding.

Encoding. The encoding of a prefix of length i ends in one token t, and without t it is the encoding
of the shorter prefix; t is the one token that ends there and may follow that prefix's last token (two
tokens may be neighbours if merging their joined bytes gives the two back). Hence the encodings of all
prefixes form a tree. A state is the part of the tree that can still matter: prefixes from which a
vocabulary entry can reach beyond the bytes read, with their last token and place in the trie of the
vocabulary, and the paths between them. What all live prefixes share has no alternative any more and
is emitted; so tokens leave after a lookahead of less than the longest token. States and transitions
are made when first needed, numbered, and kept in a table that is emptied when it has MAX_BYTES, also
within a piece.

Decoding. A state machine over bytes tells complete characters from unfinished ones; each step of
``Utf8Stream`` takes a token and returns the characters complete by then.

Cases: null text counts as empty (no ids); bytes of a text that aren't UTF-8 are taken as U+FFFD; rows
with null doc_id and repeated rows are encoded each for itself; an empty table gives none; other
columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from struct import Struct

import pyarrow as pa
from pyspark.sql import DataFrame

from shopfloor.llm.pretoken import split
from shopfloor.llm.remembered import Remembered, give_back, grows
from shopfloor.llm.text import id_and_bytes

MAX_BYTES, PIECE_BYTES = 128 << 20, 96 << 20
#: About what a state and its transitions take; each prefix in it takes its packed size more.
STATE_BYTES = 400
PREFIX = Struct("<3i")
DEAD = -1
NEVER = 1 << 60


class Transducer:
    """Ids of a piece by merge ranks (bytes -> rank; the rank is the id)."""

    def __init__(self, ranks: dict[bytes, int], max_bytes: int = MAX_BYTES):
        self.ranks, self.max_bytes = ranks, max_bytes
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.edges: tuple[dict, dict] = ({}, {})
        self.child: dict[int, int] = {}
        self.token_at: list[int] = [DEAD]
        self.inner: list[bool] = [False]
        for token, rank in ranks.items():
            if len(token) > 1 and self.merge(token) != [rank]:
                continue  # merging never makes it
            node = 0
            for b in token:
                self.inner[node] = True
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(self.token_at)
                    self.token_at.append(DEAD)
                    self.inner.append(False)
                node = self.child[key]
            self.token_at[node] = rank
        self.states, self.number = [], {}
        self.table: dict[int, tuple[int, tuple[int, ...]]] = {}  # by state << 8 | byte
        self.ends: dict[int, tuple[int, ...]] = {}
        self.clear()

    def merge(self, text: bytes) -> list[int]:
        """Merges by rank, straight from the definition; for the few bytes of one or two tokens."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank == NEVER:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def clear(self) -> None:
        """Forgets all states but the first.

        A state lists prefixes, oldest first: the place in the trie of what follows it, the last token
        and the parent's index, DEAD where there is none; packed, as tuples would take six times the bytes."""
        for known in (self.states, self.number, self.table, self.ends):
            known.clear()
        self.bytes = 0
        self.numbered([(0, DEAD, DEAD)])

    def numbered(self, prefixes: list[tuple[int, int, int]]) -> int:
        key = b"".join(PREFIX.pack(*prefix) for prefix in prefixes)
        to = self.number.setdefault(key, len(self.states))
        if to == len(self.states):
            self.states.append(key)
            self.bytes += STATE_BYTES + len(key)
        return to

    def edge(self, token: int, last: bool) -> list[tuple[int, int]]:
        """The symbols that stand at a token's end (or beginning) while it is merged from bytes, each with
        the rank of the merge that ends its time."""
        known = self.edges[last].get(token)
        if known is None:
            text = self.token_bytes[token]
            if len(text) == 1:
                known = [(token, NEVER)]
            else:
                parts = self.halves(text)
                inner = self.edge(self.ranks[parts[last]], last)
                known = [*inner[:-1], (inner[-1][0], token), (token, NEVER)]
            self.edges[last][token] = known
        return known

    def halves(self, text: bytes) -> list[bytes]:
        """The two parts of a token that its last merge joins."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 2:
            _, i = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of both gives the two back: no pair of symbols that meet
        between them, while each is being merged, is merged across. Of equal ranks the leftmost goes first."""
        if left == DEAD:
            return True
        a, b = self.edge(left, True), self.edge(right, False)
        i = j = 0
        text, ranks = self.token_bytes, self.ranks
        while True:
            (x, x_until), (y, y_until) = a[i], b[j]
            across = ranks.get(text[x] + text[y], NEVER)
            if across < x_until and across <= y_until and across != NEVER:
                return False
            if x_until == y_until == NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The transition's target and what it emits, made and put into the table."""
        child, token_at, inner = self.child.get, self.token_at, self.inner
        prefixes, newest = [], None
        for i, (node, token, parent) in enumerate(PREFIX.iter_unpack(self.states[state])):
            if node != DEAD:
                node = child(node << 8 | byte, DEAD)
                if node != DEAD:
                    if newest is None and (t := token_at[node]) != DEAD and self.may_follow(token, t):
                        newest = (0, t, i)
                    if not inner[node]:
                        node = DEAD
            prefixes.append((node, token, parent))
        prefixes.append(newest)
        children = [0] * len(prefixes)  # those that are live or have such among theirs
        for i in range(len(prefixes) - 1, 0, -1):
            if prefixes[i][0] != DEAD or children[i]:
                children[prefixes[i][2]] += 1
        place, kept, emitted = {}, [], []
        for i, (node, token, parent) in enumerate(prefixes):
            if node == DEAD and not children[i]:
                continue
            if not kept:  # the root, or the only way on from a root that has gone
                if parent != DEAD and i:
                    emitted.append(token)
                if node == DEAD and children[i] == 1:
                    continue
                kept.append((node, token if node != DEAD else DEAD, DEAD))
            else:
                kept.append((node, token, place[parent]))
            place[i] = len(kept) - 1
        if self.bytes > self.max_bytes:
            self.clear()  # also the number of the state left; the one entered gets a new one
            return self.numbered(kept), tuple(emitted)
        out = self.table[state << 8 | byte] = (self.numbered(kept), tuple(emitted))
        return out

    def end(self, state: int) -> tuple[int, ...]:
        """What is left to emit when the piece ends in this state."""
        out = self.ends.get(state)
        if out is None:
            prefixes, tokens = list(PREFIX.iter_unpack(self.states[state])), []
            _, token, parent = prefixes[-1]
            while parent != DEAD:
                tokens.append(token)
                _, token, parent = prefixes[parent]
            out = self.ends[state] = tuple(reversed(tokens))
        return out

    def encode(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        state, out, known = 0, [], self.table.get
        for b in piece:
            state, emitted = known(state << 8 | b) or self.step(state, b)
            if emitted:
                out.extend(emitted)
        out.extend(self.end(state))
        return out


class Codec:
    def __init__(self, ranks: dict[bytes, int], max_bytes: int = MAX_BYTES, piece_bytes: int = PIECE_BYTES):
        self.transducer = transducer = Transducer(ranks, max_bytes)
        self.ids = Remembered(lambda piece: array("I", transducer.encode(piece.encode())).tobytes(), piece_bytes)

    def encode(self, text: str) -> array:
        """Ids of a text: each match of the pattern by itself, without special tokens."""
        ids = array("I")
        ids.frombytes(b"".join(map(self.ids.__getitem__, split(text))))
        return ids

    def decode(self, ids: Sequence[int], block: int = 4096) -> Iterator[bytes]:
        """Parts of the text, each of complete characters."""
        stream, token_bytes = Utf8Stream(), self.transducer.token_bytes
        for i in range(0, len(ids), block):
            if part := stream.feed(b"".join(map(token_bytes.__getitem__, ids[i:i + block]))):
                yield part
        if part := stream.finish():
            yield part


#: What may follow in UTF-8, by state: (first byte, last byte, next state). Fixed values.
UTF8 = {
    0: ((0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2),
        (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7)),
    1: ((0x80, 0xBF, 0),),
    2: ((0x80, 0xBF, 1),),
    3: ((0x80, 0xBF, 2),),
    4: ((0xA0, 0xBF, 1),),
    5: ((0x80, 0x9F, 1),),
    6: ((0x90, 0xBF, 2),),
    7: ((0x80, 0x8F, 2),),
}
_NEXT = {state << 8 | b: to for state, ranges in UTF8.items() for lo, hi, to in ranges for b in range(lo, hi + 1)}
_REPLACEMENT = "\N{REPLACEMENT CHARACTER}".encode()


class Utf8Stream:
    """Takes bytes part by part; gives back whole characters. Broken ones become U+FFFD, one for each
    longest run that could have begun a character."""

    def __init__(self):
        self.held = b""

    def feed(self, part: bytes) -> bytes:
        data = self.held + part
        state, cut = self.unfinished(data)
        try:
            data[:cut].decode()
        except UnicodeDecodeError:
            return self.mend(data)
        self.held = data[cut:]
        return data[:cut]

    @staticmethod
    def unfinished(data: bytes) -> tuple[int, int]:
        """The machine's state after the last character, and where an unfinished one begins."""
        for begin in range(len(data) - 1, max(-1, len(data) - 4), -1):
            if not 0x80 <= data[begin] < 0xC0:
                state = 0
                for b in data[begin:]:
                    state = _NEXT.get(state << 8 | b, 0)
                return state, begin if state else len(data)
        return 0, len(data)

    def mend(self, data: bytes) -> bytes:
        """All of the data through the machine, byte by byte, when something is broken."""
        out, state, begun, whole, i = [], 0, 0, 0, 0
        while i < len(data):
            to = _NEXT.get(state << 8 | data[i])
            if to is None:
                i += state == 0  # else the byte may begin a character of its own
                out.append(data[begun:whole] + _REPLACEMENT)
                begun, whole, state = i, i, 0
                continue
            i, state = i + 1, to
            if state == 0:
                whole = i
        out.append(data[begun:whole])
        self.held = data[whole:]
        return b"".join(out)

    def finish(self) -> bytes:
        out = _REPLACEMENT if self.held else b""
        self.held = b""
        return out


@grows
@lru_cache(maxsize=2)
def load(path: str, max_bytes: int = MAX_BYTES, piece_bytes: int = PIECE_BYTES) -> Codec:
    """From a ``.tiktoken`` rank file; once a worker."""
    with open(path, "rb") as f:
        return Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, max_bytes, piece_bytes)


def encode_column(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every text. No shuffle."""
    def encode(batches):
        codec = load(ranks)
        for batch in batches:
            ids = [codec.encode((x.as_py() or b"").decode("utf-8", "replace")) for x in batch.column("text")]
            for i in range(len(ids)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, 1), pa.array([ids[i].tolist()], pa.list_(pa.int32()))],
                    ["doc_id", "ids"])

    return id_and_bytes(docs).mapInArrow(encode, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, ranks: str, max_bytes: int = MAX_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Encodes every text and decodes the ids: doc_id, n_tokens and the digests of both. No shuffle.

    ``ranks``: the rank file's path, the same on every executor. ``max_bytes``, ``piece_bytes``: what a worker keeps
    of states and of pieces; less costs time and changes no result."""
    def digests(batches):
        codec = load(ranks, max_bytes, piece_bytes)
        for batch in batches:
            rows = []
            for x in batch.column("text"):
                ids = codec.encode((x.as_py() or b"").decode("utf-8", "replace"))
                decoded = hashlib.sha256()
                for part in codec.decode(ids):
                    decoded.update(part)
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), decoded.hexdigest()))
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        give_back()

    return id_and_bytes(docs).mapInArrow(
        digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
