"""Token counts by a tokenizer that is compiled into finite-state transducers.

Two deterministic transducers read a text, and neither makes a list of tokens.

The *splitter* reads characters and marks where the tokenizer cuts a text into words before it merges.
It has eleven states, and a class of characters for each kind of transition; the classes are asked of the
tokenizer itself, character by character as they first occur. A block of text is dealt out into chunks
that are read side by side. What a chunk does is a map from each state at its begin to the state at its
end; the maps compose, so that a parallel prefix scan over them gives the state in which each chunk
begins, and a second reading marks the cuts. The state at the end of a block is carried into the next.

The *counter* reads the bytes of one word. Its transitions are annotated with how many tokens more, or
fewer, the word has with this byte than without it; the count of a word is the sum along its path. An
encoding is the right one exactly if every two neighbouring tokens encode to themselves when joined, so the
last token of a prefix is the only one that holds after the last token of a shorter prefix. A state keeps
those shorter prefixes from which some token may still be running: their last tokens, and how many
tokens fewer they have. States and transitions are made when first needed. When there are too many they
are dropped and made anew, so that memory is bounded and results never depend on it.

Nothing is shuffled. A task holds a batch, one block of characters, and its transducers; a text of any
length is read block by block, and a lost task is simply run again.

Defined results: a null or empty text has no bytes and no tokens. Strings of added tokens inside a text
are one token each, as the tokenizers library has it unless told otherwise. Null and repeated ids are
rows like others, counted one by one. Extra columns are dropped.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import cached_by, slices, text_or_empty

LIMIT = 1024

# --- the splitter ------------------------------------------------------------------------------

# Classes of characters. Letters that contractions are made of have classes of their own.
E, L, RV, STMD, LETTER, NUMBER, SPACE, WHITE, QUOTE, OTHER, END, UNKNOWN = range(12)
_LETTERS = (E, L, RV, STMD, LETTER)
# States: nothing read of a word; in a run of letters, numbers, others; after a quote that began a word, and
# after it and r or v, or l; after one space or other white space, and after several that end with it.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, QUOTED, QUOTED_RV, QUOTED_L, ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE = range(11)
STATES = 11
# Marks of a transition: a word begins with the character read, or with the one before it.
HERE, BEFORE = 1, 2


def _begun(kind: int) -> int:
    """The state after the first character of a word."""
    if kind in _LETTERS:
        return IN_LETTERS
    return {NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: QUOTED, SPACE: ONE_SPACE, WHITE: ONE_WHITE, END: START}[kind]


def _transition(state: int, kind: int) -> tuple[int, int]:
    """Next state and marks, for the words ``'s 't 're 've 'm 'll 'd``, runs of letters, of numbers and of
    others, each with a space in front, and runs of white space, of which the last may begin the next word."""
    run = _begun(OTHER if kind == QUOTE else kind)
    white = kind in (SPACE, WHITE)
    if state in (IN_LETTERS, IN_NUMBERS, IN_OTHERS):
        return (state, 0) if run == state else (_begun(kind), HERE)
    if state == QUOTED:
        if kind in (RV, L, STMD):
            return {RV: QUOTED_RV, L: QUOTED_L, STMD: START}[kind], 0
        return (IN_OTHERS, 0) if run == IN_OTHERS else (_begun(kind), HERE)
    if state in (QUOTED_RV, QUOTED_L):
        if kind == (E if state == QUOTED_RV else L):
            return START, 0
        # No contraction after all: the quote is a word, and the letter after it begins one.
        return (IN_LETTERS, BEFORE) if kind in _LETTERS else (_begun(kind), BEFORE | HERE)
    if state != START and white:
        return (MORE_SPACE if kind == SPACE else MORE_WHITE), 0
    if state == START or kind == END:
        return _begun(kind), HERE
    before = BEFORE if state in (MORE_SPACE, MORE_WHITE) else 0
    return (run, before) if state in (ONE_SPACE, MORE_SPACE) else (_begun(kind), before | HERE)


def _compiled() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks at ``state * 16 + class``."""
    following, marks = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
    for state in range(STATES):
        for kind in range(END + 1):
            following[state * 16 + kind], marks[state * 16 + kind] = _transition(state, kind)
    return following, marks


NEXT, MARKS = _compiled()


def chunk_maps(kinds: np.ndarray) -> np.ndarray:
    """[chunk, state at its begin] -> state at its end. ``kinds`` is [place in the chunk, chunk]."""
    width, chunks = kinds.shape
    maps = np.empty((chunks, STATES), np.uint8)
    # All states of a chunk are followed until they have met, as they do after a word or two.
    open_, states = np.arange(chunks), np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], chunks, 1)
    met, alike = np.empty(0, np.int64), np.empty(0, np.uint8)
    for at in range(width):
        if len(open_):
            states = NEXT[(states << 4) | kinds[at, open_]]
        if len(met):
            alike = NEXT[(alike << 4) | kinds[at, met]]
        if at % 16 == 15 and len(open_):
            same = (states == states[0]).all(axis=0)
            met, alike = np.concatenate([met, open_[same]]), np.concatenate([alike, states[0, same]])
            open_, states = open_[~same], states[:, ~same]
    maps[open_] = states.T
    maps[met] = alike[:, None]
    return maps


def scan(maps: np.ndarray, first: int) -> tuple[np.ndarray, int]:
    """The state at the begin of each chunk and after the last, by composing maps over doubling distances."""
    prefix, distance = maps.copy(), 1
    while distance < len(prefix):
        prefix[distance:] = np.take_along_axis(prefix[distance:], prefix[:-distance], axis=1)
        distance *= 2
    ends = prefix[:, first]
    return np.concatenate([[first], ends[:-1]]).astype(np.uint8), int(ends[-1])


def marks_of(kinds: np.ndarray, first: int, width: int = 256) -> tuple[np.ndarray, int]:
    """The marks of each transition over a block of classes, and the state after it."""
    whole = len(kinds) // width * width
    marks, state = np.empty(len(kinds), np.uint8), first
    for part, length in ((slice(0, whole), width), (slice(whole, len(kinds)), len(kinds) - whole)):
        if part.start == part.stop:
            continue
        side_by_side = np.ascontiguousarray(kinds[part].reshape(-1, length).T)
        states, state = scan(chunk_maps(side_by_side), state)
        found = np.empty_like(side_by_side)
        for at in range(length):
            hop = (states << 4) | side_by_side[at]
            found[at], states = MARKS[hop], NEXT[hop]
        marks[part] = found.T.ravel()
    return marks, state


# --- the counter -------------------------------------------------------------------------------


class _State(dict):
    """Transitions by byte: (next state, tokens more). ``key`` has an entry for each place from which a token
    may be running: its place in the tree of tokens, the token before it, and the tokens it is ahead."""

    __slots__ = ("key",)


class Counter:
    """Counts the tokens of byte strings, each on its own. ``ranks`` has the rank of each pair that merges."""

    def __init__(self, ranks: dict[tuple[bytes, bytes], int], max_states: int = 150_000):
        self.ranks, self.max_states = ranks, max_states
        self.token = sorted({bytes([b]) for b in range(256)} | {a + b for a, b in ranks})
        # The tree of all tokens: edges by (node, byte), the token that ends at a node, and whether it goes on.
        self.edges: dict[int, int] = {}
        self.ending, self.inner = [-1], [True]
        for number, token in enumerate(self.token):
            node = 0
            for byte in token:
                self.inner[node] = True
                edge = node << 8 | byte
                if edge not in self.edges:
                    self.edges[edge] = len(self.ending)
                    self.ending.append(-1)
                    self.inner.append(False)
                node = self.edges[edge]
            self.ending[node] = number
        self._held: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.states: dict = {}
        self.start = self._state(((0, -1, 0),))

    def _state(self, key) -> _State:
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = _State()
            state.key = key
        return state

    def merged(self, data: bytes) -> list[bytes]:
        """The definition: join the neighbouring pair of least rank, the leftmost first, until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while True:
            found = [(self.ranks[pair], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in self.ranks]
            if not found:
                return parts
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _holds(self, before: int, token: int) -> bool:
        pair = before << 32 | token
        held = self._held.get(pair)
        if held is None:
            if len(self._held) >= 4 * self.max_states:
                self._held.clear()
            alone = [self.token[t] for t in (before, token) if t >= 0]
            held = self._held[pair] = self.merged(b"".join(alone)) == alone
        return held

    def _step(self, state: _State, byte: int) -> tuple[_State, int]:
        found, more, still = -1, 0, []
        edges, ending, inner = self.edges, self.ending, self.inner
        for node, before, ahead in state.key:
            child = edges.get(node << 8 | byte)
            if child is None:
                continue
            token = ending[child]
            if token >= 0 and found < 0 and self._holds(before, token):
                found, more = token, ahead + 1
            if inner[child]:
                still.append((child, before, ahead))
        if found < 0:
            raise ValueError("no token fits: the merges do not make all their tokens")
        key = (*[(child, before, ahead - more) for child, before, ahead in still], (0, found, 0))
        hop = state[byte] = self._state(key), more
        return hop

    def count(self, data: bytes) -> int:
        state, n = self.start, 0
        for block in range(0, len(data), 4096):
            for byte in data[block : block + 4096]:
                hop = state.get(byte) or self._step(state, byte)
                state = hop[0]
                n += hop[1]
            if len(self.states) >= self.max_states:
                key = state.key
                self._reset()
                state = self._state(key)
        return n


# --- whole texts -------------------------------------------------------------------------------


class TokenCounter:
    """Counts the tokens of whole texts. ``kind_of`` gives the class of a character."""

    def __init__(self, counter: Counter, kind_of: Callable[[str], int], added: Iterable[str] = (), block: int = 1 << 19, words: int = 250_000):
        self.counter, self.kind_of, self.block, self.most_words = counter, kind_of, block, words
        longest_first = sorted(added, key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        self.words: dict[str, int] = {}

    def _kinds(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kinds[points]
        if (kinds == UNKNOWN).any():
            for point in np.unique(points[kinds == UNKNOWN]).tolist():
                self.kinds[point] = self.kind_of(chr(point))
            kinds = self.kinds[points]
        return kinds

    def _counted(self, words: list[str]) -> np.ndarray:
        known = self.words
        for word in set(words).difference(known):
            known[word] = self.counter.count(word.encode("utf-8", "surrogatepass"))
        counts = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        if len(known) > self.most_words:
            self.words = {}
        return counts

    def _blocks(self, texts: Iterable[str]) -> Iterator[tuple[list[str], list[int], list[int]]]:
        """Pieces that make about a block; the places in it where a part of a text ends, each with one
        character more to stand for the end; the text of each part, and that of what comes after the last end."""
        pieces, ends, owners, size = [], [], [], 0
        for number, text in enumerate(texts):
            for part in self.added.split(text) if self.added else (text,):
                for at in range(0, len(part), self.block):
                    piece = part[at : at + self.block]
                    pieces.append(piece)
                    size += len(piece)
                    if size >= self.block:
                        yield pieces, ends, [*owners, number]
                        pieces, ends, owners, size = [], [], [], 0
                pieces.append("\0")
                ends.append(size)
                owners.append(number)
                size += 1
        if pieces:
            yield pieces, ends, [*owners, owners[-1]]

    def count(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        total = np.zeros(len(texts), np.int64)
        if self.added:
            total += np.fromiter((len(self.added.findall(t)) for t in texts), np.int64, len(texts))
        state, open_ = START, ""
        for pieces, ends, owners in self._blocks(texts):
            fresh = "".join(pieces)
            kinds = self._kinds(fresh)
            kinds[ends] = END
            marks, state = marks_of(kinds, state)
            text, shift = open_ + fresh, len(open_)
            begins = np.zeros(len(text), bool)
            begins[0] = True  # a word that is open from the block before, or one that begins here
            begins[shift:] |= marks & HERE > 0
            begins[np.flatnonzero(marks & BEFORE) + shift - 1] = True
            cuts = np.flatnonzero(begins)
            places = cuts.tolist()
            counts = self._counted([text[a:b] for a, b in zip(places, places[1:])])
            # What comes after the last cut may go on in the next block; an end is no word.
            open_ = "" if ends and ends[-1] == len(fresh) - 1 else text[places[-1] :]
            ended = np.array(ends, np.int64) + shift
            part = np.searchsorted(ended, cuts[:-1])
            counts[np.isin(cuts[:-1], ended)] = 0
            np.add.at(total, np.array(owners)[part], counts)
        return total


def _bytes_of_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, and
    the characters from U+0100 on for the other bytes in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


def compiled(path: str) -> TokenCounter:
    """The transducers of a byte-level BPE file of the tokenizers library."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model, cut = described["model"], described["pre_tokenizer"] or {}
    plain = {"add_prefix_space": False, "use_regex": True, "type": "ByteLevel"}
    odd = [a for a in described["added_tokens"] if a["lstrip"] or a["rstrip"] or a["single_word"]]
    if model["type"] != "BPE" or described["normalizer"] or odd or model.get("ignore_merges") or model.get("dropout"):
        raise ValueError(f"{path} is no plain byte-level BPE")
    if any(cut.get(key, True) != value for key, value in plain.items()):
        raise ValueError(f"{path} cuts texts in another way")
    byte = _bytes_of_characters()
    ranks = {}
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        ranks[bytes(byte[c] for c in left), bytes(byte[c] for c in right)] = rank
    words = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    known = {"e": E, "l": L, "r": RV, "v": RV, "s": STMD, "t": STMD, "m": STMD, "d": STMD, " ": SPACE, "'": QUOTE}

    def kind_of(c: str) -> int:
        if c in known:
            return known[c]
        # The neighbours with which the tokenizer leaves the character in one word.
        runs = {span for _, span in words(f"a{c}1{c}!{c}a")}
        return LETTER if (0, 2) in runs else NUMBER if (1, 4) in runs else OTHER if (3, 6) in runs else WHITE

    return TokenCounter(Counter(ranks), kind_of, [a["content"] for a in described["added_tokens"]])


_COUNTERS: dict[str, TokenCounter] = {}
cached_by("token_count", _COUNTERS.clear)


def counter(path: str) -> TokenCounter:
    """One per worker process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = compiled(path)
    return _COUNTERS[path]


def count(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit): one row per row of ``docs``.

    The file of the tokenizer must be at the same path on every worker.
    """
    read = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        own = counter(tokenizer_path)
        for batch in slices(batches, "token_count"):
            n_tokens = own.count(batch.column("text").to_pylist())
            n_bytes = pc.binary_length(batch.column("text")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), n_bytes, pa.array(n_tokens, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    return read.mapInArrow(run, "id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
