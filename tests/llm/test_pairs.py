"""The similarity join and the removal of passages against plain Python."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import graph, ngram_join, queries, substring_dedup
from shopfloor.llm.words import shingle_set, word_hashes


def rows_of(spark, folder):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def test_ngram_join_query(spark, folder):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op5_ngram_join(spark, folder).collect()}
    assert got == brute.groups(rows_of(spark, folder), 3, 90)


def test_substring_query(spark, folder):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in queries.op8_substring_dedup(spark, folder).collect()}
    want = {i: v for (i, _), v in brute.passages(rows_of(spark, folder), 50).items()}
    assert got == want
    assert any(v[1] for v in want.values())


def near_copies(n, seed, edits):
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 4000, 160)]
    out = []
    for _ in range(n):
        w = list(base)
        for k in rng.integers(0, len(w), edits):
            w[k] = f"x{rng.integers(0, 10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("n,percent,edits", [(3, 90, 3), (5, 80, 3), (1, 50, 40)])
def test_groups_in_blocks(spark, monkeypatch, n, percent, edits):
    """Near copies that link only in part, with clusters of several blocks and clusters compared by signature."""
    rows = list(enumerate(near_copies(60, 5, edits) + near_copies(5, 6, 1) + ["one two", "One TWO", None, "", " \t", "a"]))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, sig string, key int")
    want = brute.groups(rows, n, percent)
    for blocks in (32, 0):
        monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 16)
        monkeypatch.setattr(ngram_join, "CLUSTER_BLOCKS", blocks)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_groups(docs, n, percent).collect()}
        assert got == want


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    for size in [1, 2, 3, 5, 9, 10, 11, 19, 20, 21, 40, 77, 150, 400]:
        for _ in range(20):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            drop = int(rng.integers(0, size * (100 - percent) // 100 + 1))
            b = np.concatenate([a[drop:], rng.integers(0, 2**63, int(rng.integers(0, 1 + size * (100 - percent) // 100)), dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
                assert len(np.intersect1d(ngram_join.signatures(a, percent), ngram_join.signatures(b, percent)))


def test_edges_of_similarity(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.similar_groups(docs).collect() == []
    assert substring_dedup.repeated_passages(docs).collect() == []
    docs = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (3, "a b c"), (2, "A b C")], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in ngram_join.similar_groups(docs).collect())
    assert got == [(-1, -1), (2, 2), (3, 2), (3, 2)]
    assert sorted(r["doc_id"] or -1 for r in ngram_join.drop_similar(docs).collect()) == [-1, 2]


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(60)] + [(int(a) + 100, int(b) + 100) for a, b in rng.integers(0, 80, (60, 2))] + [(500, 500)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    lone = {x for x in label if all(a == b for a, b in edges if x in (a, b))}
    assert got == {x: c for x, c in label.items() if x not in lone}


def test_passages_small(spark):
    rng = np.random.default_rng(4)
    words = [f"w{x}" for x in rng.integers(0, 50, 400)]
    rows = [(5, " ".join(words[:200])), (3, " ".join(words[90:160])), (9, " ".join(words[100:112] + words[:30] + words[150:200])),
            (7, " ".join(words[:200])), (5, "again " * 40), (4, " ".join(words[90:101])), (8, None), (1, ""), (6, "one\x85two a b " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(
        (r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])
        for r in substring_dedup.repeated_passages(docs.withColumn("key", F.lit("clash")), length=10, seed=4, with_text=True).collect()
    )
    assert got == sorted((i, *v) for (i, _), v in brute.passages(rows, 10).items())


def test_word_hashes_follow_the_words(monkeypatch):
    from shopfloor.llm import words

    text = ("Ab\tcd  ef\x85g h\x0bi " + "long" * 9 + " é\n") * 7
    n = len(brute.words(text))
    whole = word_hashes(text.encode())
    assert len(whole) == n and len(set(whole.tolist())) == len(set(brute.words(text)))
    monkeypatch.setattr(words, "SLICE", 13)
    assert (word_hashes(text.encode()) == whole).all()
    assert len(shingle_set(b" \n", 3)) == 0 and len(shingle_set(b"a b", 3)) == 1


@pytest.mark.parametrize("max_bits", [1 << 30, 256])
def test_ids_that_may_be_in_a_set(spark, max_bits):
    """All ids of the set pass, few others do where the filter has room, null does not."""
    from shopfloor.llm.id_filter import id_bits, passing

    rows = spark.range(-3000, 3000).select("id").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    ids = spark.range(-3000, 3000, 7)
    bits = id_bits(ids, max_bits)
    passed = {r[0] for r in passing(rows, "id", bits).collect()}
    others = {r[0] for r in passing(rows, "id", bits, passes=False).collect()}
    assert not passed & others and len(passed) + len(others) == rows.count() and None in others
    wanted = set(range(-3000, 3000, 7))
    assert wanted <= passed and None not in passed and (max_bits < 1024 or len(passed) < len(wanted) + 60)
    assert passing(rows, "id", id_bits(ids.limit(0))).collect() == []
