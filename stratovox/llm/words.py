"""Words of whole batches of texts as arrays, without a Python object a word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = 0x20


@dataclass(frozen=True)
class Words:
    """The words of some texts in order: normalised bytes, each word's place [start, end) in them, and its text's number."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    texts: int

    def per_text(self) -> np.ndarray:
        """How many words each text has."""
        return np.bincount(self.text, minlength=self.texts)

    def encoded(self) -> tuple[np.ndarray, list[bytes]]:
        """Each word's number in the list of the distinct words, and that list."""
        length = self.end - self.start
        places = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        flat = self.data[self.data != SPACE].tobytes()
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(places), pa.py_buffer(flat)]).dictionary_encode()
        return found.indices.to_numpy(), found.dictionary.to_pylist()

    def spaced(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes with exactly one space after each word, and the words' places in them."""
        length = self.end - self.start
        end = np.cumsum(length + 1) - 1
        out = np.full(int(end[-1]) + 1 if len(end) else 0, SPACE, np.uint8)
        inside = np.ones(len(out), bool)
        inside[end] = False
        out[inside] = self.data[self.data != SPACE]
        return out, end - length, end


def split_words(column: pa.Array, normal: bytes) -> Words:
    """Words of a string column; ``normal`` maps every byte, those that separate words to a space. Null texts have no words."""
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    places = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if len(texts) and places[-1] > places[0] else None
    flat = np.frombuffer(bytes(memoryview(raw)[places[0] : places[-1]]).translate(normal) if raw is not None else b"", np.uint8)
    places = places - places[0]
    inside = flat != SPACE
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = places[1:-1][(places[1:-1] > 0) & (places[1:-1] < len(flat))]  # a word ends with its text
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    start = np.flatnonzero(first)
    return Words(flat, start, np.flatnonzero(last) + 1, np.searchsorted(places[1:], start, side="right"), len(texts))


def slices(batches, column: int, limit: int):
    """The batches cut so that a part has about ``limit`` bytes of text in ``column`` at most, or a single row."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
