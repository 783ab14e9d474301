"""Encoding of a corpus with a public tokenizer by forced-boundary splitting.

A pair of bytes that stands inside no vocabulary token can never be merged over, so a text may be
cut between them: the fragments are encoded independently and their ids concatenated. A cut must
also be one that the tokenizer's pre-splitting pattern can't see across, which rules out cuts after
white space (its look-ahead) and before an apostrophe (its contractions).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_AT_ONCE = 256
#: Fragments whose ids a task remembers; then it starts anew.
REMEMBERED = 200_000
TOKENIZER = "byte_bpe_50k.tiktoken"


def default_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def _vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


@lru_cache(maxsize=4)
def _encoder(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_vocabulary(path), special_tokens={})


@lru_cache(maxsize=4)
def certain_cuts(path: str):
    """256 x 256 table: may a text be cut between the two bytes?"""
    import numpy as np

    inside = np.zeros((256, 256), dtype=bool)
    for token in _vocabulary(path):
        if len(token) > 1:
            t = np.frombuffer(token, dtype=np.uint8)
            inside[t[:-1], t[1:]] = True
    cut = ~inside
    cut[:, 0x80:0xC0] = False  # within a character
    cut[:, ord("'")] = False
    # last bytes of white space: ASCII blanks, and those of U+0085, U+00A0, U+1680, U+2000-200A, U+2028-2029, U+202F, U+205F, U+3000
    for last in [*range(0x09, 0x0E), *range(0x1C, 0x21), *range(0x80, 0x8B), 0x85, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]:
        cut[last, :] = False
    return cut


def fragments(text: str, path: str) -> list[bytes]:
    """`text` in UTF-8, cut at every certain cut; joined they are the text."""
    import numpy as np

    raw = text.encode("utf-8", "replace")
    b = np.frombuffer(raw, dtype=np.uint8)
    places = (np.flatnonzero(certain_cuts(path)[b[:-1], b[1:]]) + 1).tolist()
    return [raw[i:j] for i, j in zip([0, *places], [*places, len(raw)]) if j > i]


_KNOWN: dict[tuple[str, bytes], list[int]] = {}


def encode(text: str | None, path: str) -> list[int]:
    """Ids of a text without special tokens; [] for NULL and empty ones.

    Every fragment is encoded by itself, and the ids are concatenated; most fragments recur and are remembered.
    """
    if not text:
        return []
    out: list[int] = []
    for part in fragments(text, path):
        ids = _KNOWN.get((path, part))
        if ids is None:
            if len(_KNOWN) >= REMEMBERED:
                _KNOWN.clear()
            ids = _KNOWN[path, part] = _encoder(path).encode_ordinary(part.decode("utf-8"))
        out += ids
    return out


def _map(df: DataFrame, schema: str, work) -> DataFrame:
    """mapInArrow over (id, text) in slices, so a task holds few encoded texts at a time."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                yield from work(pa, part)

    return df.mapInArrow(run, schema)


def token_ids(documents: DataFrame, *, doc: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id long, ids array<int>), one row per document; [] for NULL and empty texts.

    One pass without a shuffle: fragments keep the encoder's work in proportion to the length, so even a very long
    text stays where it was read. Blank texts have the ids of their blanks. Repeated rows are encoded each; a NULL id
    stays NULL; an empty table gives an empty result.
    """
    path = path or default_path()
    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def ids(pa, part):
        found = [encode(t, path) for t in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _map(rows, "doc_id long, ids array<int>", ids)


def token_counts(documents: DataFrame, *, doc: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id long, n_tokens long), one row per document; 0 for NULL and empty texts."""
    path = path or default_path()
    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def count(pa, part):
        found = [len(encode(t, path)) for t in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.int64())], ["doc_id", "n_tokens"])

    return _map(rows, "doc_id long, n_tokens long", count)
