"""Groups spelling variants: words one edit apart, the rarer pointing to a much more frequent one.

A word's deletions and replacements are tried against Bloom filters of the vocabulary, one shard for each word length,
in blocks of 512 bits. An edited word is never built for that: its hash follows from the word's own in one step.
Insertions need no trial, as they are the other word's deletions; of two words that differ by a replacement the one
with the smaller letter tries. Only edits that the filter lets through become strings, and are shuffled to an exact
join with the vocabulary, which removes false positives.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.shared import lower_ascii, settle
from shopfloor.llm.words import mixed

_U = np.uint64
_BASE = 0xD1342543DE82EF95
_BACK = _U(pow(_BASE, -1, 1 << 64))
#: Filter bits for each word, bits set for a word within its block, and 64-byte blocks that one round broadcasts at most (64 MB).
BITS_PER_WORD = 16
HASHES = 6
ROUND_BLOCKS = 1 << 20
#: Edits hashed at once.
TILE = 1 << 20


def word_runs(docs: DataFrame, text: str = "text", id: str = "doc_id", min_chars: int = 7) -> DataFrame:
    """Rows (id, run): the maximal runs of Latin letters of ``min_chars`` or more, A-Z in lower case."""
    runs = F.regexp_extract_all(lower_ascii(F.col(text)), F.lit(rf"[a-zÀ-ÿ]{{{min_chars},}}"), F.lit(0))
    return docs.select(F.col(id).alias("id"), F.explode(runs).alias("run"))


def count_words(words: DataFrame, min_chars: int = 7, min_count: int = 2) -> DataFrame:
    """The vocabulary: each ``word`` of ``min_chars`` code points or more with its count ``n``, ``min_count`` or more."""
    kept = words.where(F.length("word") >= min_chars)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _letter(codes: np.ndarray) -> np.ndarray:
    return mixed(codes.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(1))


def _powers(n: int) -> np.ndarray:
    p = np.full(n + 1, _U(_BASE), _U)
    p[0] = 1
    return np.cumprod(p, dtype=_U)


def _codes(words: list[str], n: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), n)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the list, matrix of code points) for the words of each length, a bounded number at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths):
        same = np.flatnonzero(lengths == n)
        step = max(1, TILE // max(1, int(n)))
        for at in (same[k : k + step] for k in range(0, len(same), step)):
            yield at, _codes([words[i] for i in at], int(n))


class Shards:
    """Where each word length has its blocks, and which of them a round covers.

    ``sizes`` maps lengths to their number of blocks; a round covers ``spans``: length to (first block, end, offset).
    """

    def __init__(self, counts: dict[int, int]):
        self.sizes = {n: 1 << max(0, math.ceil(math.log2(c * BITS_PER_WORD / 512))) for n, c in sorted(counts.items())}

    def rounds(self, room: int) -> list[dict[int, tuple[int, int, int]]]:
        """Spans of at most ``room`` blocks together; a length too large for one round is spread over several."""
        rounds: list[dict[int, tuple[int, int, int]]] = [{}]
        used = 0
        for n, size in self.sizes.items():
            first = 0
            while first < size:
                if used == room:
                    rounds.append({})
                    used = 0
                take = min(size - first, room - used)
                rounds[-1][n] = (first, first + take, used)
                used, first = used + take, first + take
        return rounds


def _bits(hashes: np.ndarray, size: int, span: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which hashes lie in the span; their block there; their scrambled value, whose low bits pick bits in the block."""
    x = mixed(hashes)
    block = (x >> _U(34)).astype(np.int64) & (size - 1)
    inside = np.flatnonzero((block >= span[0]) & (block < span[1]))
    return inside, block[inside] - span[0] + span[2], mixed(x[inside])


def _place(block: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    bit = (y >> _U(9 * k)) & _U(511)
    return block * 8 + (bit >> _U(6)).astype(np.int64), _U(1) << (bit & _U(63))


def build_filter(vocabulary: DataFrame, sizes: dict[int, int], spans: dict[int, tuple[int, int, int]]) -> np.ndarray:
    """The 64-bit words of a round's blocks: as many as the spans have room for, however many words there are."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, masks = [], []
            for _, codes in _by_length(batch.column("word").to_pylist()):
                n = codes.shape[1]
                hashes = (_letter(codes) * _powers(n)[:n]).sum(axis=1, dtype=_U)
                _, block, y = _bits(hashes, sizes[n], spans[n])
                for k in range(HASHES):
                    word, mask = _place(block, y, k)
                    at.append(word)
                    masks.append(mask)
            place, mask = (np.concatenate(x) if x else np.empty(0, _U) for x in (at, masks))
            order = np.argsort(place, kind="stable")
            place, mask = place[order].astype(np.int64), mask[order].astype(_U)
            starts = np.flatnonzero(np.diff(place, prepend=-1))
            joined = np.bitwise_or.reduceat(mask, starts) if len(starts) else mask
            yield pa.RecordBatch.from_arrays([pa.array(place[starts]), pa.array(joined.view(np.int64))], ["place", "mask"])

    parts = vocabulary.select("word").mapInArrow(fill, "place bigint, mask bigint")
    found = parts.groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(8 * sum(b - a for a, b, _ in spans.values()), _U)
    bits[found["place"].to_numpy()] = found["mask"].to_numpy().view(_U)
    return bits


def _hits(hashes: np.ndarray, size: int, span: tuple[int, int, int], bits: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter lets through."""
    inside, block, y = _bits(hashes, size, span)
    for k in range(HASHES):
        word, mask = _place(block, y, k)
        on = np.flatnonzero(bits[word] & mask)
        inside, block, y = inside[on], block[on], y[on]
    return inside


def _edits(codes: np.ndarray, letters: np.ndarray, sizes: dict, spans: dict, bits: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, place, letter) of the edits let through, letter 0 for a deletion; tile by tile of words and places."""
    m, n = codes.shape
    power, values = _powers(n), _letter(letters)
    own = _letter(codes)
    terms = own * power[:n]
    whole = terms.sum(axis=1, dtype=_U)
    if n - 1 in spans:
        upto = np.cumsum(terms, axis=1, dtype=_U)
        # What follows the deleted letter moves one place to the front.
        gone = (upto - terms) + (whole[:, None] - upto) * _BACK
        first = np.ones((m, n), bool)
        first[:, 1:] = codes[:, 1:] != codes[:, :-1]  # deleting either of two equal neighbours is one edit
        rows, places = np.nonzero(first)
        hit = _hits(gone[rows, places], sizes[n - 1], spans[n - 1], bits)
        yield rows[hit], places[hit], np.zeros(len(hit), np.uint32)
    if n not in spans:
        return
    width = max(1, TILE // len(letters) // min(m, 4096))
    for a in range(0, m, 4096):
        for p in range(0, n, width):
            part = codes[a : a + 4096, p : p + width]
            rows, places, new = np.nonzero(letters[None, None, :] > part[:, :, None])
            change = (values[new] - own[a + rows, p + places]) * power[p + places]
            hit = _hits(whole[a + rows] + change, sizes[n], spans[n], bits)
            yield a + rows[hit], p + places[hit], letters[new[hit]]


def candidate_pairs(vocabulary: DataFrame, round_blocks: int = ROUND_BLOCKS) -> DataFrame:
    """Rows (word, n, edit): the edits of each word that the filters let through.

    One round broadcasts at most ``round_blocks`` blocks of 64 bytes and reads the words of its lengths; a larger
    vocabulary takes more rounds.
    """
    spark = vocabulary.sparkSession
    counts = {r[0]: r[1] for r in vocabulary.groupBy(F.length("word")).count().collect()}  # one row a word length
    letters = sorted(r[0] for r in vocabulary.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect())
    alphabet = np.array([ord(c) for c in letters], np.uint32)  # of the letters that words are made of
    shards = Shards(counts)
    sizes = shards.sizes
    schema = "word string, n bigint, edit string"
    found = spark.createDataFrame([], schema)
    for spans in shards.rounds(round_blocks) if counts else []:
        bits = spark.sparkContext.broadcast(build_filter(vocabulary.where(F.length("word").isin(*spans)), sizes, spans))

        def probe(batches: Iterator[pa.RecordBatch], spans=spans, bits=bits) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
                for at, codes in _by_length(words):
                    for rows, places, new in _edits(codes, alphabet, sizes, spans, bits.value):
                        if not len(rows):
                            continue
                        own = [words[i] for i in at[rows]]
                        added = [chr(c) if c else "" for c in new.tolist()]
                        edits = [w[:p] + c + w[p + 1 :] for w, p, c in zip(own, places.tolist(), added)]
                        columns = [pa.array(own), pa.array(n[at[rows]]), pa.array(edits)]
                        yield pa.RecordBatch.from_arrays(columns, ["word", "n", "edit"])

        near = sorted({x for n in spans for x in (n, n + 1)} & set(counts))
        found = found.unionByName(vocabulary.where(F.length("word").isin(*near)).mapInArrow(probe, schema))
    return found


def _followed(links: DataFrame, hops: int) -> DataFrame:
    """Each word's last form: pointers double their reach until it covers ``hops``."""
    links = links.withColumnRenamed("form", "root")
    for _ in range(max(0, math.ceil(math.log2(max(1, hops))))):
        onward = links.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        links = settle(links.join(onward, F.col("root") == F.col("_from"), "left").select("word", F.coalesce("_to", "root").alias("root")))
    return links


def spelling_forms(vocabulary: DataFrame, ratio: int = 10, round_blocks: int = ROUND_BLOCKS) -> DataFrame:
    """One row per word of ``vocabulary`` (``word``, ``n``): ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    Two words are near if exactly one inserted, deleted or replaced code point makes one the other. A word's form is its
    near word with the largest count (ties: the first in code-point order) if that is at least ``ratio`` times its own
    count, else null; ``ratio`` is 2 or more. ``root`` follows forms to the last one, or is the word itself. Words are
    distinct and not null; an empty vocabulary gives no rows. A word's edits are as many as its letters times the
    alphabet, so one frequent word meets a bounded number of others.
    """
    spark = vocabulary.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    vocabulary = settle(vocabulary.select("word", "n").repartition(parts))  # lengths evenly over tasks
    known = vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    pairs = candidate_pairs(vocabulary, round_blocks).join(known, "edit")

    def side(word: str, n: str, near: str, near_n: str) -> Column:
        form = F.when(F.col(near_n) >= ratio * F.col(n), F.struct((-F.col(near_n)).alias("less"), F.col(near).alias("form")))
        return F.struct(F.col(word).alias("word"), form.alias("form"))

    both = pairs.select(F.explode(F.array(side("word", "n", "edit", "edit_n"), side("edit", "edit_n", "word", "n"))).alias("p"))
    near = both.groupBy("p.word").agg(F.count(F.lit(1)).alias("n_near"), F.min("p.form").alias("best"))
    near = settle(near.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")))
    most = vocabulary.agg(F.max("n")).first()[0] or 1
    hops = int(math.log(most, ratio)) + 1  # counts grow by ``ratio`` at every hop
    roots = _followed(near.where(F.col("form").isNotNull()).select("word", "form"), hops)
    full = vocabulary.join(near, "word", "left").join(roots, "word", "left")
    return full.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n"
    )
