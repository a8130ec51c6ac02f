"""Packing tokenized documents into sequences by bounded-space online best-fit.

Pieces go, as they come, into one of a fixed number of open bins: the one with the least free space
that still holds the piece. Open bins are kept by free space, and a bitset marks which free spaces
occur, so that finding the bin is one shift and one lowest bit, whatever the number of bins. When a
new bin is needed and all are open, the fullest closes. Each input partition is packed on its own
while it is tokenized: nothing is shuffled, the memory of a task is its batch, its token cache and the
open bins, and a lost task is simply run again. The pieces of one batch are placed from the longest
to the shortest, which wastes less than their order of arrival.

Defined results: a null or empty text is a document of the end token alone. A document longer than a
sequence is cut into whole sequences, the first piece taking what is left over. Rows with the same id,
or with none, are packed one by one. Strings of special tokens in a text are ordinary text. Extra columns are
dropped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame

from corpusprep.llm.common import cached_by, slices, text_or_empty
from corpusprep.llm.tokens import PartEncoder

END_ID = 2
SEQUENCE = 1024
OPEN_BINS = 4096


class BestFit:
    """Open bins by free space; ``place`` gives the bin and the place in it."""

    def __init__(self, size: int, open_bins: int, first_id: int = 0):
        if size < 1 or open_bins < 1:
            raise ValueError("a bin has room for a token, and one bin must be open")
        self.size, self.open_bins = size, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.present = 0  # bit f: a bin with f free is open
        self.count, self.next_id = 0, first_id

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            self.present &= ~(1 << free)
        self.count -= 1
        return taken

    def place(self, length: int) -> tuple[int, int]:
        if not 0 < length <= self.size:
            raise ValueError(f"a piece of {length} tokens does not fit a bin of {self.size}")
        fitting = self.present >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            chosen = self._take(free)
        else:
            if self.count >= self.open_bins:
                self._take((self.present & -self.present).bit_length() - 1)
            free, chosen = self.size, self.next_id
            self.next_id += 1
        left = free - length
        if left:
            self.by_free[left].append(chosen)
            self.present |= 1 << left
            self.count += 1
        return chosen, self.size - free


_ENCODERS: dict[str, PartEncoder] = {}
cached_by("packing", _ENCODERS.clear)
_JOINED = 1 << 15


def _tokenizer_parts(tokenizer) -> PartEncoder:
    """Parts go to the tokenizer many at once, as one text that it cuts where they meet."""
    import numpy as np

    # In a byte-level vocabulary each character of a token stands for one byte.
    width = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, i in tokenizer.get_vocab().items():
        width[i] = len(token)

    def ids(text: str) -> np.ndarray:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def rest(parts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        start, size = 0, 0
        for i, part in enumerate(parts):
            size += len(part) + 1
            if size < _JOINED and i < len(parts) - 1:
                continue
            own = parts[start : i + 1]
            found = ids(" " + " ".join(own))
            ends = np.searchsorted(np.cumsum(width[found]), np.cumsum([len(p.encode()) + 1 for p in own])) + 1
            data, bounds = found.tobytes(), [0, *(4 * ends).tolist()]
            out.extend(data[a:b] for a, b in zip(bounds, bounds[1:]))
            start, size = i + 1, 0
        return out

    return PartEncoder(lambda part: ids(part).tobytes(), rest)


def encoder(path: str) -> PartEncoder:
    """Encoder of a tokenizer file; one per worker process."""
    if path not in _ENCODERS:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        _ENCODERS[path] = _tokenizer_parts(tokenizer)
    return _ENCODERS[path]


def cuts(length: int, size: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the pieces of a document; all but the first are whole."""
    first = (length - 1) % size + 1
    yield 0, first
    for start in range(first, length, size):
        yield start, start + size


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE,
    open_bins: int = OPEN_BINS,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset[, ids]): one row per piece.

    ``ids`` are the piece's tokens as little-endian unsigned 32-bit integers; concatenated by offset
    they are the sequence. The file of the tokenizer must be at the same path on every worker.
    """
    read = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    schema = "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encode = encoder(tokenizer_path)
        end = end_id.to_bytes(4, "little")
        # Each partition has a range of sequence ids of its own.
        bins = BestFit(size, open_bins, TaskContext.get().partitionId() << 33)
        for batch in slices(batches, "packing", 2048):
            rows = []
            for doc, ids in zip(batch.column("id").to_pylist(), encode.all(batch.column("text").to_pylist())):
                ids += end
                for piece, (a, b) in enumerate(cuts(len(ids) // 4, size)):
                    own = ids[4 * a : 4 * b]
                    rows.append((doc, piece, a, b - a, zlib.crc32(own), own if with_ids else None))
            columns = list(zip(*rows)) or [()] * 6
            placed: list = [None] * len(rows)
            for i in sorted(range(len(rows)), key=lambda i: -rows[i][3]):
                placed[i] = bins.place(rows[i][3])
            arrays = [
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int32()),
                *(pa.array(columns[k], pa.int64()) for k in (2, 3, 4)),
                *(pa.array([p[k] for p in placed], pa.int64()) for k in (0, 1)),
            ]
            names = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            if with_ids:
                arrays.append(pa.array(columns[5], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return read.mapInArrow(run, schema + (", ids binary" if with_ids else ""))
