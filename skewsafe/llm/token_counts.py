"""Operator 9: token counts by overlap resynchronisation.

A document up to ``CHUNK`` characters is one chunk. A longer one is encoded in
chunks that overlap, and the encodings are spliced:

* In a chunk that starts at a true pre-token boundary, every pre-token that
  ends at least ``MARGIN`` characters before the chunk's end is the one of the
  whole text: the pattern looks at most three characters past a match, and a
  special string cut by the chunk's end reaches back by its length at most.
* The next chunk starts anywhere in that stable part. Its first pre-tokens may
  be wrong, but where one of its pre-token boundaries falls on a stable
  boundary of the chunk before, everything after it is the whole text's again,
  because matching restarts at each boundary and never looks back.
* If no boundary is common, the overlap is doubled. When it reaches back to the
  last true boundary and that does not help either (one huge pre-token), the
  chunk is taken from that boundary and doubled.

So the count equals that of one encode of the whole text, with memory bounded
by the chunk (or by the longest single pre-token).
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from skewsafe.llm.bpe_text import units
from skewsafe.llm.tokenizers_cache import UnitCache, held, hf_tokenizer, slices

CHUNK, OVERLAP = 16_384, 512
CACHE_UNITS = 1_000_000
BATCH_CHARS = 8_000_000


def _margin(tokenizer) -> int:
    special = [len(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
    return max([4, *special])


def _starts(encoding) -> dict[int, int]:
    """Character position of every pre-token's start -> index of its first token.

    Special strings have no word id of their own text; each counts as one.
    """
    out, last = {}, object()
    for i, (word, (start, end)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if word is None or word != last:
            # A byte-level token inside a character repeats that character's
            # span, so only the first token of a pre-token marks a boundary.
            out.setdefault(start, i)
        last = word
    return out


def count_spliced(text: str, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text``, never encoding much more than ``chunk`` characters at once."""
    margin = _margin(tokenizer)
    chunk, overlap = max(chunk, 4 * margin), max(1, overlap)

    def encoded(start: int, size: int):
        return tokenizer.encode(text[start:start + size], add_special_tokens=False)

    true, total = 0, 0  # every pre-token before the true boundary ``true`` is counted
    origin, size, first = 0, chunk, 0  # the chunk, and its first token after ``true``
    encoding = encoded(origin, size)
    while origin + size < len(text):
        limit = origin + size - margin
        stable = {origin + p: i for p, i in _starts(encoding).items() if true < origin + p <= limit}
        common, back = None, overlap
        while stable and common is None:
            start = max(true, max(stable) - back)
            following = encoded(start, chunk)
            there = _starts(following)
            common = max((p for p in stable if p - start in there), default=None)
            if start == true:
                break
            back *= 2
        if common is None:  # a pre-token as long as the chunk: a longer chunk from the last true boundary
            size, origin, first = 2 * size, true, 0
            encoding = encoded(origin, size)
        else:
            total += stable[common] - first
            true, origin, size, encoding, first = common, start, chunk, following, there[common - start]
    return total + len(encoding.ids) - first


def token_count(text: Column | str, tokenizer_path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """Column expression: tokens of each whole text as the file's library gives them.

    Null counts as empty text (0 tokens). No begin, end or added tokens;
    special strings inside the text are handled as the library's default does.
    """

    @arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array(_counts(texts, tokenizer_path, chunk, overlap), pa.int64())

    return count(F.col(text) if isinstance(text, str) else text)


def _counts(texts: pa.Array, path: str, chunk: int, overlap: int) -> list[int]:
    tokenizer = hf_tokenizer(path)

    def lengths(new: list[str]):
        return map(len, tokenizer.encode_batch_fast(new, add_special_tokens=False))

    memory = held(("token counts", path), lambda: UnitCache(lengths, CACHE_UNITS))
    out: list[int] = []
    for a, b in slices(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), BATCH_CHARS):
        rows = [s or "" for s in texts.slice(a, b - a).to_pylist()]
        split = [units(s) if len(s) <= chunk else None for s in rows]
        known = memory.learn(set().union(*(u for u in split if u)))
        out += [
            count_spliced(s, tokenizer, chunk, overlap) if u is None else sum(map(known.__getitem__, u))
            for s, u in zip(rows, split)
        ]
    return out


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """Every row's ``doc_id`` with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    One output row per input row: repeated rows stay repeated, a null id stays
    null, a null text is empty (0 bytes, 0 tokens, not over the limit), an empty
    table gives no rows. No shuffle: counts are computed where the text is read.
    """
    n_tokens = token_count(text, tokenizer_path).alias("n_tokens")
    counted = docs.select("doc_id", F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), n_tokens)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
