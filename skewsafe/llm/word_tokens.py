"""Token ids of whole batches of texts for tokenizers that drop white space.

The texts of a batch are cut into words with numpy, equal words are told apart
once by Arrow's dictionary encoding, only words that are new to the worker go
to the tokenizer, and the ids of all words are put in place with one gather.
Known words and their ids are a few flat arrays, some 30 bytes a word.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from skewsafe.llm.tokenizers_cache import give_back, held, hf_tokenizer, slices

#: Words that are kept beyond those of the slice at hand; bounds memory, never changes an id.
CACHE_UNITS = 500_000
#: Characters whose words are found at once; their arrays take some 25 bytes for each.
BATCH_CHARS = 1_000_000
#: Limits of the batches that queries send to the functions here: what two processes hold of each is small.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def flat_utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one behind the other, and where each begins (one more entry: the end). Null: empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def find_words(is_word: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of True that stays inside one text."""
    edge = np.zeros(len(is_word) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = is_word[1:] != is_word[:-1]
    edge[texts] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    inside = is_word[starts]
    return starts[inside], ends[inside]


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Each word's number among the distinct words, and these. ``keep``: the bytes of ``data`` that lie in words."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[keep]))
    encoded = words.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


# The settings under which a run of letters is one unit of the merges.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Letters that are their own composed form and have a lower-case form of one letter.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _byte_characters() -> dict[int, int]:
    """Latin-1 code to the character that stands for the byte: printable bytes themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in plain)}


class _WordIds:
    """Ids (little-endian uint32) of words without white space, remembered.

    Words of plain letters go straight to the merges where the tokenizer's
    settings allow it, other words through the whole tokenizer. The ids of
    ``words[i]`` are ``ids[first[i]:first[i + 1]]``.
    """

    def __init__(self, path: str):
        self.tokenizer = hf_tokenizer(path)
        settings = json.loads(self.tokenizer.to_str())
        normalizers = [n.get("type") for n in (settings["normalizer"] or {}).get("normalizers", [])]
        split = (settings["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.direct = (normalizers == _NORMALIZERS and [p.get("type") for p in split] == ["Split", "ByteLevel"]
                       and split[0]["pattern"] == {"Regex": _SPLIT} and not split[1]["add_prefix_space"])
        self.characters = _byte_characters()
        self.words = pa.array([], pa.large_string())
        self.ids, self.first = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _encode(self, words: list[str]) -> list[bytes]:
        plain = [self.direct and _LETTERS.fullmatch(w) is not None for w in words]
        other = [w for w, p in zip(words, plain) if not p]
        whole = iter(self.tokenizer.encode_batch_fast(other, add_special_tokens=False)) if other else iter(())
        merge, out = self.tokenizer.model.tokenize, []
        for word, direct in zip(words, plain):
            if direct:
                unit = word.lower()
                if not unit.isascii():
                    unit = unit.encode().decode("latin-1").translate(self.characters)
                out.append(array("I", [t.id for t in merge(unit)]).tobytes())
            else:
                out.append(array("I", next(whole).ids).tobytes())
        return out

    def _keep(self, some: np.ndarray) -> None:
        """Only the words of these numbers stay."""
        size = np.diff(self.first)[some]
        end = np.cumsum(size)
        self.ids = self.ids[np.repeat(self.first[some] - (end - size), size) + np.arange(end[-1] if len(end) else 0)]
        self.words, self.first = self.words.take(pa.array(some)), np.concatenate([[0], end])

    def learn(self, words: pa.Array) -> np.ndarray:
        """The numbers of these distinct ``words``, each encoded unless it is known."""
        found = pc.index_in(words, value_set=self.words)
        if len(self.words) > CACHE_UNITS:
            self._keep(np.unique(found.drop_null().to_numpy()))
            found = pc.index_in(words, value_set=self.words)
        number, new = found.fill_null(-1).to_numpy().astype(np.int64), found.is_null()
        number[number < 0] = len(self.words) + np.arange(found.null_count)
        if found.null_count:
            unknown = words.filter(new)
            parts = self._encode(unknown.to_pylist())
            size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
            self.words = pa.concat_arrays([self.words, unknown])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(parts), "<u4")])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(size)])
        return number


def _without_case_and_marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Words of plain letters in lower case, a full stop or comma behind them a word of its own.

    The tokenizer lower-cases and never joins a letter with punctuation, so the
    ids are the same and fewer words are distinct. Returns data, starts, ends.
    """
    low = data | 0x20
    letter = (low >= 0x61) & (low <= 0x7A) & (data < 0x80)
    second = (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[1:] != 0x97) & (data[1:] != 0xB7) & (data[:-1] == 0xC3)
    wide = letter.copy()
    wide[1:] |= second
    wide[:-1] |= second
    others = _before(~wide)
    last = data[ends - 1]
    body = ends - ((last == 0x2E) | (last == 0x2C))
    plain = (others[body] == others[starts]) & (body > starts)
    marked = plain & (body < ends)
    at = np.flatnonzero(marked) + 1
    new_starts, new_ends = np.insert(starts, at, body[marked]), np.insert(np.where(marked, body, ends), at, ends[marked])
    ascii_before = _before(~letter)
    fold = plain & (ascii_before[body] == ascii_before[starts])
    turns = np.zeros(len(data) + 1, np.int8)  # +1 where a word to fold begins, -1 where it ends
    turns[starts[fold]] += 1
    turns[body[fold]] -= 1
    inside = np.cumsum(turns[:-1], dtype=np.int8).view(bool)
    return np.where(inside, low, data), new_starts, new_ends


def _before(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place, and in all."""
    out = np.zeros(len(flags) + 1, np.int32 if len(flags) < 2**31 else np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _slice_ids(texts: pa.Array, memory: _WordIds) -> tuple[np.ndarray, np.ndarray]:
    data, at = flat_utf8(texts)
    is_word = (data != 0x20) & (data != 0x0A)
    starts, ends = find_words(is_word, at) if len(data) else (at[:0], at[:0])
    if not len(starts):
        return np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
    if memory.direct:
        data, starts, ends = _without_case_and_marks(data, starts, ends)
    codes, distinct = word_codes(data, starts, ends, is_word)
    number = memory.learn(distinct)
    first, size = memory.first[number], np.diff(memory.first)[number]
    # Ids of all words in order: word i takes memory.ids[first[code] : first[code] + size[code]].
    each = size[codes]
    end = np.cumsum(each)
    ids = memory.ids[np.repeat(first[codes] - (end - each), each) + np.arange(end[-1])]
    total = np.concatenate([[0], end])
    return ids, total[np.searchsorted(starts, at)]


def text_ids(texts: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of the batch: the first row, its texts' ids one behind the other, and where each text's begin.

    The tokenizer drops white space and none of its patterns crosses it, so the
    parts between spaces and line feeds are encoded once each and put together.
    """
    memory = held(("packing", path), lambda: _WordIds(path))
    for a, b in slices(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), BATCH_CHARS):
        yield a, *_slice_ids(texts.slice(a, b - a), memory)
        give_back()
