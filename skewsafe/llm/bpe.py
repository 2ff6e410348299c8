"""Operator 10: byte-level BPE encoding and decoding with a local rank file.

Each match of the split pattern is encoded on its own, as the ``tiktoken``
library does. Texts over ``CHUNK`` characters are first cut at boundaries that
are certain to be match boundaries (``bpe_text``), so a call into the library
holds one chunk and not a whole huge text; a single match longer than that
stays whole. Very long white space is matched apart. Decoding concatenates the raw bytes of the ids: bytes that split a
character, or text that is not what the tokenizer saw, come back as they are.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from skewsafe.llm.bpe_text import safe_chunks
from skewsafe.llm.tokenizers_cache import rank_encoding

CHUNK = 65_536
# The characters of the split pattern's white space.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space of this length or more is matched here, not by the library's pattern, which fails on very long runs.
LONG_SPACE = 10_000
_LONG_RUN = re.compile(f"[{_SPACE}]{{{LONG_SPACE},}}")


def encode_text(text: str, encoding, chunk: int = CHUNK) -> list[int]:
    """Ids of the whole ``text``.

    The pattern takes all of a run of white space at the end of the text, and
    all but its last character before other text, as one match.
    """
    ids: list[int] = []
    start = 0
    for run in _LONG_RUN.finditer(text):
        end = run.end() - (run.end() < len(text))
        ids += _encode_stretch(text[start:run.start()], encoding, chunk)
        ids += encoding._encode_single_piece(text[run.start():end])
        start = end
    return ids + _encode_stretch(text[start:], encoding, chunk)


def _encode_stretch(text: str, encoding, chunk: int) -> list[int]:
    """Ids of a text without very long white space."""
    if len(text) <= chunk:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    for part in safe_chunks(text, chunk):
        ids += encoding.encode_ordinary(part)
    return ids


def encode(text: Column | str, rank_path: str, pattern: str) -> Column:
    """Column expression: the ids of each whole text as ``array<int>`` (null: empty text)."""

    @arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        encoding = rank_encoding(rank_path, pattern)
        return pa.array((encode_text(t.as_py() or "", encoding) for t in texts), pa.list_(pa.int32()))

    return ids(F.col(text) if isinstance(text, str) else text)


def decode(ids: Column | str, rank_path: str, pattern: str) -> Column:
    """Column expression: the raw bytes of each id list (null list: no bytes)."""

    @arrow_udf("binary")
    def raw(lists: pa.Array) -> pa.Array:
        encoding = rank_encoding(rank_path, pattern)
        return pa.array((encoding.decode_bytes(i.as_py() or []) for i in lists), pa.binary())

    return raw(F.col(ids) if isinstance(ids, str) else ids)


def round_trip(text: Column | str, rank_path: str, pattern: str) -> Column:
    """Column expression: ``struct<n_tokens, ids_sha256, decoded_sha256>`` of encode, then decode.

    The same two steps as ``encode`` and ``decode`` in one pass, which spares
    moving the id lists to the JVM and back.
    """

    @arrow_udf("struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>")
    def digest(texts: pa.Array) -> pa.Array:
        encoding = rank_encoding(rank_path, pattern)
        counts, of_ids, of_bytes = [], [], []
        for t in texts:
            ids = encode_text(t.as_py() or "", encoding)
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest())
            of_bytes.append(hashlib.sha256(encoding.decode_bytes(ids)).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return digest(F.col(text) if isinstance(text, str) else text)


def encode_decode(docs: DataFrame, rank_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Every row's ``doc_id``, ``n_tokens`` and the digests of its ids and decoded bytes.

    One output row per input row (repeated rows stay repeated, null ids stay
    null); a null text is an empty one; an empty table gives no rows.
    """
    return docs.select("doc_id", round_trip(text, rank_path, pattern).alias("t")).select("doc_id", "t.*")
