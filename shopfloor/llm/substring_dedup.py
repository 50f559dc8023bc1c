"""Repeated passages removed by seed and extend, at word level.

Seeds are winnowed anchors: of the hashes of all runs of ``SEED`` words, those that are smallest in some window of
the text, chosen so that every passage of the threshold length has one of its own. Two texts sharing a passage share its
anchor. An anchor found in two texts is extended both ways, to all passages of the threshold length whose anchor it
is; these are looked up by hash, and the smallest id that has each is found.
Runs of covered words are the maximal repeats. Whole copies are recognised by their text first, so a group of
copies extends once.

Texts cross the network once, as far as they hold shared anchors; hashes otherwise. No pair of documents is made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.shared import settle, stored
from shopfloor.llm.words import run_hashes, word_hashes

SEED = 20


def own_anchors(words: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each passage of ``length`` words the position of its anchor, the first of its smallest seed hashes; all hashes."""
    hashes = run_hashes(words, seed)
    width = length - seed + 1
    if len(hashes) < width:
        return np.empty(0, np.int64), hashes
    return np.lib.stride_tricks.sliding_window_view(hashes, width).argmin(1) + np.arange(len(hashes) - width + 1), hashes


def anchors(words: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of a text, each once."""
    own, hashes = own_anchors(words, length, seed)
    places = own[np.diff(own, prepend=-1) > 0]  # never decreasing
    return places, hashes[places]


def _anchor_rows(length: int, seed: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies met by one task give the same anchors
        for batch in batches:
            hashes, keys, places, rows = [], [], [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(key)
                at, h = anchors(word_hashes(text.as_py()), length, seed)
                hashes.append(h)
                keys.append(np.full(len(at), key))
                places.append(at)
                rows += len(at)
                if rows > 400_000:
                    yield _batch(anchor=np.concatenate(hashes).view(np.int64), key=np.concatenate(keys), place=np.concatenate(places))
                    hashes, keys, places, rows = [], [], [], 0
            if rows:
                yield _batch(anchor=np.concatenate(hashes).view(np.int64), key=np.concatenate(keys), place=np.concatenate(places))

    return of


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64, copy=False)) for c in columns.values()], names=list(columns))


def _window_rows(length: int, seed: int):
    """(window, doc_id, key, start) for passages whose anchor is shared."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, key, text, shared in zip(ids, keys, batch.column(2), batch.column(3), strict=True):
                words = word_hashes(text.as_py())
                own, _ = own_anchors(words, length, seed)
                windows = run_hashes(words, length)
                clean = np.flatnonzero(np.isin(own, np.array(shared.as_py(), np.int64)))
                if len(clean):
                    yield _batch(window=windows[clean].view(np.int64), doc_id=np.full(len(clean), doc_id), key=np.full(len(clean), key), start=clean)

    return of


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _whole_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        split = [t.as_py().split() for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([len(w) for w in split], pa.int64()), pa.array([_digest(w) for w in split])],
            names=["doc_id", "key", "n_words", "sha"],
        )


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a passage that begins at one of ``starts``."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + length, minlength=n + 1)
    return np.cumsum(steps)[:n] > 0


def _cut_rows(length: int, with_text: bool):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, shas, texts = [], [], []
            for text, starts in zip(batch.column(2), batch.column(3), strict=True):
                words = text.as_py().split()
                gone = covered(np.array(starts.as_py(), np.int64), length, len(words))
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                removed.append(int(gone.sum()))
                shas.append(_digest(kept))
                texts.append(b" ".join(kept).decode() if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())],
                names=["_id", "_key", "_removed", "_sha", "_text"],
            )

    return of


def repeated_passages(docs: DataFrame, length: int = 50, text: str = "text", id: str = "doc_id", seed: int = SEED, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and ``kept_text`` with ``with_text``).

    A word is removed if a passage of ``length`` words that covers it also begins in a document with a smaller id.
    Passages are judged on the input. Null text has no words; ``kept_text`` is null where nothing is removed. Rows
    repeated with one id are compared with other ids only, each by its own text. Rows without id lose nothing and
    take nothing from others. An empty table gives no rows; other columns are ignored. Ids are integers.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # The key names a text; the exact test of copies compares a 128-bit hash besides.
    source = docs.select(F.col(id).cast("long").alias("doc_id"), F.xxhash64(body).alias("key"), body.cast("binary").alias("text"))
    whole = settle(source.mapInArrow(_whole_rows, "doc_id long, key long, n_words long, sha string"))
    firsts = settle(whole.where("doc_id is not null").groupBy("key", "sha").agg(F.min("doc_id").alias("first")))

    with stored(source.where("doc_id is not null").select("key", "text").mapInArrow(_anchor_rows(length, seed), "anchor long, key long, place long")) as found:
        twice = found.groupBy("anchor").agg(F.min("key").alias("_a"), F.max("key").alias("_b")).where("_a < _b").select("anchor")
        places = found.join(twice, "anchor").groupBy("key").agg(F.collect_set("place").alias("places"))  # as many as a text has anchors
        seeds = settle(places.join(firsts.select("key", F.col("first").alias("doc_id")), "key"))
    seeded = source.join(seeds, ["doc_id", "key"]).select("doc_id", "key", "text", "places").dropDuplicates(["doc_id", "key"])
    with stored(seeded) as texts:
        with stored(texts.mapInArrow(_window_rows(length, seed), "window long, doc_id long, key long, start long")) as windows:
            owners = windows.groupBy("window").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("_last")).where("owner < _last").drop("_last")
            later = windows.join(owners, "window").where("owner < doc_id")
            starts = settle(later.groupBy("doc_id", "key").agg(F.collect_set("start").alias("starts")))  # as many as a text has words
        cut = texts.join(starts, ["doc_id", "key"]).select("doc_id", "key", "text", "starts")
        cut = settle(cut.mapInArrow(_cut_rows(length, with_text), "_id long, _key long, _removed long, _sha string, _text string"))

    known = whole.join(firsts, ["key", "sha"], "left")
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= length)
    out = known.join(cut, (F.col("doc_id") == F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    columns = [
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("_sha", "sha")).alias("kept_sha256"),
    ]
    if with_text:
        columns.append(F.when(copy, F.lit("")).otherwise(F.col("_text")).alias("kept_text"))
    return out.select(*columns)
