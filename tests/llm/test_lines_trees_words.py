"""Line de-duplication, the Merkle manifest and spelling variants against brute force, awkward rows included."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import line_dedup, merkle_manifest, spelling_variants

CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, digest string, key string, _id int, may int, word int, n int"


def _documents(spark, rows):
    """(doc_id, source, lang, n_chars, text) rows with columns that clash with inner names."""
    full = [(i, t, g, s, n, "x", "y", "z", 1, 2, 3, 4) for i, s, g, n, t in rows]
    return spark.createDataFrame(full, CLASHING)


def _order(rows):
    return sorted(rows, key=repr)


LONG = "a line of boiler plate that is long enough to count here"
SHORT = "too short to count"


def _line_rows():
    rng = random.Random(3)
    rows = [(i, f"{i} own words of this document that nobody else has at all\n{LONG}\n{SHORT}") for i in range(8)]
    rows += [(100 + i, f"\t{LONG.upper()}  \r\n{'é' * 39}\n{'é' * 40}\n{LONG}") for i in range(4)]
    rows += [(200 + i, f"{'É' * 40}\n{'é' * 40}") for i in range(3)]  # É keeps its case
    rows += [(300, None), (301, ""), (302, "\n\n"), (303, LONG), (303, LONG), (303, f"{LONG}\nmore"), (None, LONG), (None, LONG)]
    rows += [(400, "\n".join(rng.choice([LONG, SHORT, "w" * 50_000, "x" * 60]) for _ in range(3000)))]
    rows += [(500 + i, "w" * 50_000) for i in range(4)]
    return rows


@pytest.mark.parametrize("max_bits", [line_dedup.MAX_BITS, line_dedup.BLOCK])
def test_lines_equal_brute_force(spark, monkeypatch, max_bits):
    """Also where blocks are shipped often and a filter is so small that it suspects too many lines."""
    monkeypatch.setattr(line_dedup, "FLUSH", 8)
    rows = _line_rows()
    docs = _documents(spark, [(i, None, None, None, t) for i, t in rows]).repartition(4)
    got = line_dedup.drop_repeated_lines(docs, min_chars=40, min_docs=5, max_bits=max_bits)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "text"]
    assert _order(map(tuple, got.collect())) == _order(brute.lines_left(rows, 40, 5))


def test_no_lines_of_no_documents(spark):
    assert line_dedup.drop_repeated_lines(_documents(spark, [])).collect() == []


def test_a_full_block_survives_packing():
    import numpy as np

    for n in (0, 1, 4095, 4096, 5000, line_dedup.BLOCK):
        places = np.sort(np.random.default_rng(n).permutation(line_dedup.BLOCK)[:n])
        bits = np.unpackbits(line_dedup._unpack(line_dedup._pack(places)), bitorder="little")
        assert np.array_equal(np.flatnonzero(bits), places)


def _tree_rows():
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", None]), "en", i, f"Text {i}") for i in rng.sample(range(1000), 130)]
    rows += [(i, "s", "fr", None, None) for i in range(-9, 8)] + [(7, "s", "de", 1, "one leaf")]
    rows += [(5, "s", None, 2, "nul language"), (6, None, "", 0, ""), (None, "s", "en", 1, "no id"), (None, None, None, None, None)]
    rows += [(4, "s", "es", 3, "twice")] * 2 + [(4, "s", "es", 3, "same id")] + [(8, "s", "zz", 9, "long " * 40_000)]
    return rows


def test_manifest_equals_brute_force(spark):
    rows = _tree_rows()
    docs = _documents(spark, rows).repartition(5)
    got = merkle_manifest.manifest(docs, carry={"tree": F.length("text")})
    proven = got.select(
        "doc_id", "leaf", "subroot", "root", merkle_manifest.proof_digest(F.col("path")), "path",
        merkle_manifest.fold(F.col("leaf"), F.col("path")), merkle_manifest.fold(F.sha2(F.lit("other"), 256), F.col("path")),
    ).collect()
    assert _order((*r[:5], [tuple(p) for p in r[5]]) for r in proven) == _order(brute.merkle(rows))
    assert all(r[6] == r["root"] != r[7] for r in proven)
    assert _order(r[0] or -1 for r in got.select("tree").collect()) == _order(len(r[4]) if r[4] else -1 for r in rows)


def test_manifest_of_little(spark):
    assert merkle_manifest.manifest(_documents(spark, [])).collect() == []
    one = merkle_manifest.manifest(_documents(spark, [(1, "s", "en", 1, "x")])).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["path"] == []


def _vocabulary():
    rng = random.Random(7)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(7, 9))) for _ in range(60)]
    counts = {}
    for w in base:
        counts[w] = rng.choice([2, 3, 20, 25, 300, 5000])
        for _ in range(12):
            i, c, kind = rng.randrange(len(w)), rng.choice("abcéÿ"), rng.randrange(3)
            other = w[:i] + (c if kind else "") + w[i + (kind != 1) :]
            counts.setdefault(other, rng.choice([2, 2, 30, 400]))
    return counts | {"aaaaaaaa": 2, "aaaaaaaaa": 20, "aaaaaaaaaa": 200, "aaaaaaaaaaa": 2000, "q" * 3000: 5, "q" * 2999: 50, "lonely word": 9}


@pytest.mark.parametrize("round_blocks", [spelling_variants.ROUND_BLOCKS, 5])
def test_forms_equal_brute_force(spark, monkeypatch, round_blocks):
    """Also where the filters take many rounds, and words and letters many tiles."""
    monkeypatch.setattr(spelling_variants, "TILE", 1 << 14)
    counts = _vocabulary()
    vocabulary = spark.createDataFrame([(w, n, 1) for w, n in counts.items()], "word string, n bigint, form int")
    got = spelling_variants.spelling_forms(vocabulary, round_blocks=round_blocks).collect()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == brute.spelling(counts)
    assert len(got) == len(counts)


def test_no_forms_of_no_words(spark):
    assert spelling_variants.spelling_forms(spark.createDataFrame([], "word string, n bigint")).collect() == []


def test_runs_and_counts_of_awkward_texts(spark):
    texts = [None, "", "Zürichsee zürichsee, ZÜRICHSEE!", "ab1abcdefgh_abcdefg", "x" * 200_000, "abcdefg"]
    docs = _documents(spark, [(k if k != 1 else None, None, None, None, t) for k, t in enumerate(texts)])
    runs = spelling_variants.word_runs(docs)
    got = _order((r["id"], r["run"]) for r in runs.collect())
    assert got == _order([(2, "zürichsee"), (2, "zürichsee"), (2, "zÜrichsee"), (3, "abcdefgh"), (3, "abcdefg"), (4, "x" * 200_000), (5, "abcdefg")])
    counted = spelling_variants.count_words(runs.select(F.col("run").alias("word")))
    assert _order(map(tuple, counted.collect())) == [("abcdefg", 2), ("zürichsee", 2)]
