"""Byte-level BPE as a finite-state transducer, determinised while it reads.

Two facts about merges by rank make a left-to-right reading possible. An encoding is the right one
exactly if every two neighbouring tokens encode to themselves when joined, and each prefix of a text
has exactly one right encoding. The encoding of a prefix is therefore that of a shorter prefix and one
token more, the only one whose pair with the token before it holds. Which shorter prefixes can still
matter is bounded by the longest token: those from which some token may still be running.

A state holds the bytes since the first such prefix, the pending tokens up to each of them, and
the last token that was emitted. Reading a byte gives the next state and the tokens on which all
pending encodings agree: they are emitted, after a lookahead that tokens bound. States and
transitions are made when first needed and kept; when there are too many, they are dropped and made
anew, so that memory is bounded and results never depend on it.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame

from corpusprep.llm.common import cached_by, slices, text_or_empty
from corpusprep.llm.tokens import PartEncoder


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


_NOWHERE: dict = {}


class _State:
    __slots__ = ("final", "key", "next")

    def __init__(self, key):
        self.key = key
        # Most states end a word and are never left: they share one empty table.
        self.next: dict[int, tuple[_State, tuple[int, ...]]] = _NOWHERE
        self.final: tuple[int, ...] = key[1][-1]


class Transducer:
    """Encodes byte strings, each on its own."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 200_000):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.ranks, self.max_states = ranks, max_states
        self.token = {rank: token for token, rank in ranks.items()}
        self.prefixes = {token[:n] for token in ranks for n in range(1, len(token))}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._alone: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._reset()

    def _reset(self) -> None:
        self.states: dict = {}
        self._ends: dict[bytes, tuple[tuple[tuple[int, int], ...], int]] = {}
        self.start = self._state((b"", ((),), None))

    def _state(self, key) -> _State:
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = _State(key)
        return state

    def merges(self, data: bytes, down_to: int = 1) -> list[int]:
        """The definition: join the neighbouring pair of least rank, the leftmost first, until none or
        ``down_to`` tokens are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            found = [(self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of this one joins; None for a single byte."""
        if token not in self._halves:
            data = self.token[token]
            halves = self.merges(data, 2) if len(data) > 1 else []
            self._halves[token] = (halves[0], halves[1]) if len(halves) == 2 else None
        return self._halves[token]

    def _joins_hold(self, left: int, right: int) -> bool:
        """Whether no merge across the border between two tokens comes before their own merges.

        The merges are undone from the latest on. What stands at the border at some moment may merge
        there only after all merges that are still undone at that moment; at equal ranks, the left
        one comes first.
        """
        allowed = len(self.ranks) + max(left, right)  # ranks below this one would have merged earlier
        while True:
            joined = self.ranks.get(self.token[left] + self.token[right])
            if joined is not None and joined < allowed:
                return False
            in_left, in_right = self._split(left), self._split(right)
            if in_left and (left > right or not in_right):
                allowed, left = left, in_left[1]
            elif in_right:
                allowed, right = right + 1, in_right[0]
            else:
                return True

    def _holds(self, before: int | None, token: int) -> bool:
        if before is None:
            if token not in self._alone:
                self._alone[token] = self.merges(self.token[token]) == [token]
            return self._alone[token]
        pair = (before, token)
        holds = self._pairs.get(pair)
        if holds is None:
            if len(self._pairs) >= 2 * self.max_states:
                self._pairs.clear()
            holds = self._pairs[pair] = self._holds(None, token) and self._joins_hold(before, token)
        return holds

    @staticmethod
    def _common(chains: list[tuple[int, ...]]) -> int:
        """How many tokens all chains begin with."""
        least, most = min(chains), max(chains)
        agreed, shortest = 0, min(len(least), len(most))
        while agreed < shortest and least[agreed] == most[agreed]:
            agreed += 1
        return agreed

    def _step(self, state: _State, byte: int) -> tuple[_State, tuple[int, ...]]:
        seen, pending, before = state.key
        seen += bytes([byte])
        ends, keep = self._ends.get(seen) or self._window(seen)
        for k, token in ends:
            chain = pending[k]
            if self._holds(chain[-1] if chain else before, token):
                break
        else:
            raise AssertionError("no token fits: the vocabulary's ranks are no order of merges")
        chains = [*pending[keep:], (*chain, token)]
        agreed = self._common(chains)
        out = chains[0][:agreed]
        if agreed:
            before = out[-1]
            chains = [c[agreed:] for c in chains]
        # The last emitted token matters only where a token may start right after it.
        if chains[0]:
            before = None
        made = (self._state((seen[keep:], tuple(chains), before)), out)
        if state.next is _NOWHERE:
            state.next = {}
        state.next[byte] = made
        return made

    def _window(self, seen: bytes) -> tuple[tuple[tuple[int, int], ...], int]:
        """The tokens that end these bytes, with their first places, and how many bytes no token can still need."""
        ranks, prefixes = self.ranks, self.prefixes
        ends = tuple((k, ranks[seen[k:]]) for k in range(len(seen)) if seen[k:] in ranks)
        keep = 0
        while keep < len(seen) and seen[keep:] not in prefixes:
            keep += 1
        self._ends[seen] = ends, keep
        return ends, keep

    def stream(self, data: bytes, block: int = 4096) -> Iterator[list[int]]:
        """Tokens as soon as they are certain, in lists of those that one block of bytes settles."""
        state = self.start
        for start in range(0, len(data), block):
            emitted: list[int] = []
            for byte in data[start : start + block]:
                hop = state.next.get(byte) or self._step(state, byte)
                state = hop[0]
                if hop[1]:
                    emitted += hop[1]
            yield emitted
            if len(self.states) >= self.max_states:
                key = state.key
                self._reset()
                state = self._state(key)
        yield list(state.final)

    def encode(self, data: bytes) -> list[int]:
        if len(data) > 4096:
            return [token for tokens in self.stream(data) for token in tokens]
        state, emitted = self.start, []
        for byte in data:
            hop = state.next.get(byte) or self._step(state, byte)
            state = hop[0]
            if hop[1]:
                emitted += hop[1]
        emitted += state.final
        if len(self.states) >= self.max_states:
            self._reset()
        return emitted


# Bytes that follow a lead byte, and how many of them it asks for.
def _wanted(lead: int) -> int:
    return 0 if lead < 0x80 else 1 if 0xC2 <= lead < 0xE0 else 2 if 0xE0 <= lead < 0xF0 else 3 if 0xF0 <= lead < 0xF5 else 0


class Utf8Stream:
    """An incremental UTF-8 state machine over blocks of bytes.

    The state between two blocks is the beginning of a character that the next block may complete.
    What can never become a character is replaced by U+FFFD.
    """

    def __init__(self):
        self.open = b""

    def feed(self, block: bytes) -> str:
        data = self.open + block
        # Only the last lead byte, three back at most, can still wait for bytes.
        held = 0
        for back in range(1, min(4, len(data) + 1)):
            byte = data[-back]
            if byte & 0xC0 != 0x80:
                if _wanted(byte) >= back and self._may_go_on(data[-back:]):
                    held = back
                break
        self.open = data[len(data) - held :]
        return data[: len(data) - held].decode("utf-8", "replace")

    @staticmethod
    def _may_go_on(begun: bytes) -> bool:
        if len(begun) < 2:
            return True
        lead, second = begun[0], begun[1]
        low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (0x80, 0xBF))
        return low <= second <= high

    def close(self) -> str:
        rest, self.open = self.open, b""
        return rest.decode("utf-8", "replace")


def decode_stream(ids: Sequence[int], tokens: Sequence[bytes], block: int = 16_384) -> Iterator[str]:
    """Text of a sequence of ids, ``block`` ids at a time, never cut inside a character."""
    machine = Utf8Stream()
    for start in range(0, len(ids), block):
        yield machine.feed(b"".join([tokens[i] for i in ids[start : start + block]]))
    yield machine.close()


class Codec:
    """Whole texts to ids and back, with the pattern that splits a text before the merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, entries: int = 300_000):
        import regex

        self.transducer = Transducer(ranks)
        split, encode = regex.compile(pattern).findall, self.transducer.encode
        matches: dict[str, bytes] = {}

        def coded(match: str) -> bytes:
            ids = matches.get(match)
            if ids is None:
                ids = array("I", encode(match.encode())).tobytes()
                if len(match) <= 32:
                    if len(matches) >= entries:
                        matches.clear()
                    matches[match] = ids
            return ids

        def part(text: str) -> bytes:
            return b"".join(map(coded, split(text)))

        def rest(parts: list[str]) -> list[bytes]:
            # Letters alone, as most parts are, are one match with the space in front.
            return [coded(" " + p) if p.isascii() and p.isalpha() else part(" " + p) for p in parts]

        self._parts = PartEncoder(part, rest)
        self._table = [self.transducer.token.get(i, b"") for i in range(max(self.transducer.token) + 1)]

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return self._parts.all(texts)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def decode(self, ids: bytes) -> Iterator[str]:
        return decode_stream(memoryview(ids).cast("I"), self._table)


_CODECS: dict[tuple[str, str], Codec] = {}
cached_by("bpe", _CODECS.clear)


def codec(ranks_path: str, pattern: str) -> Codec:
    """One per worker process."""
    key = (ranks_path, pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(read_ranks(ranks_path), pattern)
    return _CODECS[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the ids of every whole text as little-endian unsigned 32-bit integers."""
    read = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        import pyarrow as pa

        own = codec(ranks_path, pattern)
        for batch in slices(batches, "bpe"):
            ids = list(own.encode_all(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.large_binary()).cast(pa.binary())], names=["id", "ids"])

    return read.mapInArrow(run, "id long, ids binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(id, text) from (id, ids)."""

    def run(batches):
        import pyarrow as pa

        own = codec(ranks_path, pattern)
        for batch in slices(batches, "bpe"):
            texts = ["".join(own.decode(ids)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    return encoded.mapInArrow(run, "id long, text string")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): every text encoded, and decoded from its ids.

    One pass, so that neither ids nor decoded texts leave their task. Defined results: a null text
    is empty and has no tokens; repeated rows give repeated rows, and a null id is an id like others; extra
    columns are dropped.
    """
    read = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        import pyarrow as pa

        own = codec(ranks_path, pattern)
        for batch in slices(batches, "bpe"):
            counts, coded, decoded = [], [], []
            for ids in own.encode_all(batch.column("text").to_pylist()):
                counts.append(len(ids) // 4)
                coded.append(hashlib.sha256(ids).hexdigest())
                digest = hashlib.sha256()
                for block in own.decode(ids):
                    digest.update(block.encode())
                decoded.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return read.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
