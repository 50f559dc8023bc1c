"""Token counts by a public tokenizer, huge texts encoded in overlapping chunks that are spliced.

A text up to ``CHUNK`` characters is encoded whole. A longer one is cut into chunks that overlap. Each chunk is
encoded with offsets; left and right chunk are spliced at a token boundary both have, if it is *stable*: white
space follows a character that is not white space. No piece of the pre-tokenizer spans such a place and no
added token contains white space, so what comes before cannot change what comes after. Where an overlap has no
common stable boundary, it is doubled and encoded again, up to the whole rest of the text.

For a text of one chunk the same property lets words be encoded once per task: a run from one stable place to the
next always gives the same tokens.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK, OVERLAP = 32768, 256
#: Runs remembered by a task; the memory is cleared beyond them.
REMEMBERED = 200_000

_SOFT = re.compile(r"\s ")  # a space after white space is no stable place


class Encoder:
    """Token lengths in characters for any text, by the library."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.known: dict[str, tuple[int, ...] | int] = {}

    def ends(self, text: str) -> list[int]:
        """End offset of each token of ``text`` encoded on its own."""
        return [end for _, end in self.library.encode(text, add_special_tokens=False).offsets]

    def count(self, text: str) -> int:
        """Tokens of ``text``, each run between stable places encoded once."""
        runs = _runs(text)
        known = self.known
        missing = list({r for r in runs if r not in known})
        if missing:
            if len(known) > REMEMBERED:
                known.clear()
                missing = list(set(runs))
            for run, coded in zip(missing, self.library.encode_batch_fast(missing, add_special_tokens=False), strict=True):
                known[run] = len(coded.ids)
        return sum([known[r] for r in runs])


def _runs(text: str) -> list[str]:
    """``text`` cut before each single space that follows a character that is not white space."""
    if not text:
        return []
    if not _SOFT.search(text):
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + r for r in rest]
    return re.split(r"(?<=\S)(?= )", text)


def _stable(text: str, at: int) -> bool:
    return 0 < at < len(text) and text[at].isspace() and text[at] in " \t\n\r" and not text[at - 1].isspace()


def count_tokens_long(text: str, encoder: Encoder, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text of any length, by overlapping chunks spliced at stable common boundaries.

    Each chunk is encoded once, with offsets. Its tokens count from the splice with its left neighbour up to the one
    with its right neighbour. Where an overlap aligns nowhere, both chunks grow into one another and are encoded again.
    """
    total, low, start = 0, 0, 0  # the current chunk begins at ``low``; its tokens count from ``start``
    stop = min(len(text), chunk)
    left = encoder.ends(text[:stop])
    while stop < len(text):
        width = overlap
        while True:
            at, reach = max(start + 1, stop - width), min(len(text), max(stop, stop - width + chunk))
            right = [at + e for e in encoder.ends(text[at:reach])]
            edge = stop if stop == len(text) else stop - width // 4  # the last tokens of a chunk may change with what follows
            common = [i for i in sorted({at, *right}.intersection(low + e for e in left)) if start < i <= edge and _stable(text, i)]
            if common or stop == len(text):
                break
            width *= 2
            stop = min(len(text), stop + width)
            left = encoder.ends(text[low:stop])
        if not common:  # no boundary anywhere: the left chunk holds the whole rest
            break
        splice = common[len(common) // 2]
        total += bisect_right(left, splice - low) - bisect_right(left, start - low)
        low, start, stop, left = at, splice, reach, [e - at for e in right]
    return total + len(left) - bisect_right(left, start - low)


def token_counts(docs: DataFrame, path: str, text: str = "text", id: str = "doc_id", limit: int = 1024) -> DataFrame:
    """One row per document: its id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    Null text is empty: 0 bytes and tokens. Strings of special tokens inside a text are handled as the library
    does by default. Rows repeated with one id are counted one by one. An empty table gives no rows; other
    columns are ignored. ``path`` is the tokenizer's file, on every executor.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            n = [0 if not t else encoder.count(t) if len(t) <= CHUNK else count_tokens_long(t, encoder) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    source = docs.select(
        F.col(id).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.coalesce(F.col(text), F.lit("")).alias("_t")
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    counted = source.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
