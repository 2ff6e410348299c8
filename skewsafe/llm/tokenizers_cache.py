"""Per-process tokenizers and a bounded memory of encoded text units."""

from __future__ import annotations

import base64
import ctypes
import os
from collections.abc import Callable, Iterable
from functools import lru_cache

import pyarrow as pa


@lru_cache(maxsize=4)
def hf_tokenizer(path: str):
    """The ``tokenizers`` file at ``path``; one thread, since Spark runs one task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=4)
def rank_encoding(path: str, pattern: str):
    """The ``tiktoken`` encoding of a local rank file, without special tokens."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], object]:
    """The C library's ``malloc_trim``, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: None)


def give_back() -> None:
    """Freed memory returns to the system, so that a worker is no larger than what it holds."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


_held: dict[object, object] = {}


def held(key: object, make: Callable[[], object]):
    """The one large memory that this worker process keeps: ``make()`` unless ``key`` already holds it.

    Python workers live on between stages, so without this the memories of
    several operators would add up in a pipeline.
    """
    if key not in _held:
        _held.clear()
        _held[key] = make()
        give_back()
    return _held[key]


class UnitCache:
    """Remembers what ``encode(list of units)`` returned for each unit.

    Natural text repeats its words, so most units of a batch are known already.
    At most ``bound`` units are kept beyond those of the current batch; the
    bound only limits memory and never changes a result.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable], bound: int):
        self.encode, self.bound, self.known = encode, bound, {}

    def learn(self, batch: set[str]) -> dict:
        """A dict that holds every unit of ``batch``."""
        if len(self.known) > self.bound:
            self.known = {u: self.known[u] for u in batch if u in self.known}
        new = [u for u in batch if u not in self.known]
        self.known.update(zip(new, self.encode(new)))
        return self.known


def slices(sizes: Iterable[int], bound: int) -> Iterable[tuple[int, int]]:
    """Row ranges whose sizes sum to about ``bound`` at most (single larger rows stay whole)."""
    start, total, end = 0, 0, 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= bound:
            yield start, end
            start, total = end, 0
    if start < end:
        yield start, end
