"""Quality rules, languages, mixing, segmentations and token counts against plain versions of them."""

import collections
import itertools
import math
import random
import re
import unicodedata

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from shopfloor.llm import language_id, mixing, quality_rules, segmentation, token_counts

ROW = "doc_id bigint, text string, lang string, source string, _lang int, _size int, size string, copies int"


def _awkward():
    texts = [None, "", " \t\n\v", "x" * 40_000, "ab " * 9_000, "a b c\na b c\n a b c", "É1! Ünï—ß 東京 ٣", "same text here", "same text here"]
    rows = [(900_000 + k, t, ("en", None, "")[k % 3], ("s1", None, "")[k % 3], 1, 2, "3", 4) for k, t in enumerate(texts)]
    return rows + rows[4:6] + [(None, "no id at all", None, None, 1, 2, "3", 4)]


@pytest.fixture(scope="module")
def rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source")
    return [(*r, 1, 2, "3", 4) for r in docs.where("doc_id < 400").collect()] + _awkward()


def _distance(a, b):
    n, m = sum(a), sum(b)
    if not n or not m:
        return None
    part = lambda p, q: p * math.log2(2 * p / (p + q)) if p else 0.0
    return math.sqrt(max(0.0, sum(part(x / n, y / m) + part(y / m, x / n) for x, y in zip(a, b)) / 2))


def _char_class(c):
    kind = unicodedata.category(c)
    return {"Ll": 0, "Lu": 1, "Nd": 2}.get(kind, 3 if c in ".,;:!?'\"()-" else 4)


def test_quality_rules(spark, rows):
    limits = quality_rules.Limits()
    counts = collections.defaultdict(collections.Counter)
    for _, text, lang, *_ in rows:
        short = (w.lower() for w in brute.words(text))
        counts[lang].update(w for w in short if len(w) <= limits.common_length and all(unicodedata.category(c)[0] == "L" for c in w))
    common = {g: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[: limits.common_words]] for g, c in counts.items()}
    single, sums = [], {}
    for doc_id, text, lang, *_ in rows:
        words = brute.words(text)
        chars, hits = [0] * 5, [0] * (len(common[lang]) + 1)
        for c in "".join(words):
            chars[_char_class(c)] += 1
        for w in words:
            short = w.lower() if len(w) <= limits.common_length else None
            hits[common[lang].index(short) if short in common[lang] else -1] += 1
        single.append((doc_id, text, lang, words, chars, hits))
        for at, own in enumerate((chars, hits)):
            total = sums.setdefault((lang, at), [0] * len(own))
            sums[lang, at] = [x + y for x, y in zip(total, own)]
    want = []
    for doc_id, text, lang, words, chars, hits in single:
        repeat, n_chars = brute.repeated(text), sum(chars)
        far_chars = _distance(chars, sums[lang, 0]) if n_chars >= limits.min_chars else None
        far_words = _distance(hits, sums[lang, 1]) if len(words) >= limits.min_words else None
        failed = len(words) < 50 or 100 * repeat > 50 * len(words)
        kept = not failed and (far_chars or 0) <= limits.char_distance and (far_words or 0) <= limits.word_distance
        close = lambda x: -1.0 if x is None else round(x, 6)
        symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
        want.append((doc_id, len(words), n_chars, symbols, brute.dup_lines(text), repeat, failed, kept, close(far_chars), close(far_words)))
    got = quality_rules.quality(spark.createDataFrame(rows, ROW)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *(F.coalesce(F.round(c, 6), F.lit(-1.0)) for c in ("char_distance", "word_distance")),
    )
    order = lambda r: (r[0] is None, r)
    for a, b in zip(sorted(map(tuple, got.collect()), key=order), sorted(want, key=order), strict=True):
        assert a[:8] == b[:8] and np.allclose(a[8:], b[8:], atol=2e-6)


def test_languages(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = language_id.held_out()
    net = language_id.fit(docs.where(~held))
    said = language_id.predict(docs, net).join(docs.select("doc_id", "lang", held.alias("held")), "doc_id")
    right, n = said.where("held and lang is not null and lang_pred <> 'und'").agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right / n > 0.95
    other = language_id.fit(docs.withColumn("lang", F.when(~held, F.col("lang"))).where(~held).repartition(13))
    assert other.labels == net.labels and np.array_equal(other.weight, net.weight)

    got = {r["doc_id"]: r for r in language_id.predict(spark.createDataFrame(_awkward(), ROW), net).collect()}
    assert len(got) == 10 and {got[900_000 + k]["lang_pred"] for k in (0, 1, 2)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[900_007]["score"] == got[900_008]["score"]
    assert language_id.predict(docs.limit(0), net).collect() == []
    assert {r[0] for r in language_id.predict(docs.limit(5), None).select("lang_pred").collect()} == {"und"}
    assert language_id.fit(docs.limit(0)) is None


def test_no_language_is_lost_from_the_sample(spark):
    """One row each at least, also where languages outnumber the sample; a common language stays within its share."""
    many = [(f"text of number {k % 40} {k}", f"l{k % 40:02}") for k in range(80)] + [(f"common {k}", "l00") for k in range(500)]
    net = language_id.fit(spark.createDataFrame(many, "text string, lang string"), sample_rows=15)
    assert net.labels == [f"l{k:02}" for k in range(40)]


def _targets(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    target, stopped = {}, set()
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in stopped)
        free = [s for s in order if s not in stopped]
        target = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free} | {s: most * sizes[s] for s in stopped}
        above = {s for s in free if target[s] > most * sizes[s] + 1e-9}
        if not above:
            return target
        stopped |= above


def test_mixing(spark, rows):
    docs = spark.createDataFrame(rows, ROW)
    got = mixing.mix(docs, mixing.word_count()).collect()
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((r[0] or -1, len(brute.words(r[1]))) for r in rows)
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert 0 <= r["copies"] <= 2 and (r["size"] or not r["copies"])
    want = _targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    again = mixing.mix(docs.repartition(7), mixing.word_count()).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(docs.limit(0), mixing.word_count()).collect() == []


MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _all_segmentations(model, text):
    """{ids: log weight} of every segmentation, from the model's own list of pieces."""
    n = model.get_piece_size()
    plain = {model.id_to_piece(i): i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    text = "▁" + text.replace(" ", "▁")

    def tails(at):
        if at == len(text):
            return [((), 0.0)]
        out = []
        for stop in range(at + 1, len(text) + 1):
            piece = text[at:stop]
            if piece in plain:
                own, weight = (plain[piece],), segmentation.ALPHA * max(model.get_score(plain[piece]), -n)
            elif stop == at + 1:
                own = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in piece.encode())
                weight = -segmentation.ALPHA * n * len(own)
            else:
                continue
            out += [(own + rest, weight + w) for rest, w in tails(stop)]
        return out

    return dict(tails(0))


@pytest.mark.parametrize("text", ["the", "_{ a", "a__(b", "x\n\n 12", "é😀", "   "])
def test_segmentations_are_all_that_the_model_allows(text):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    lattices = segmentation.Lattices(MODEL, segmentation.ALPHA)
    weights = _all_segmentations(model, text)
    total = np.logaddexp.reduce(list(weights.values()))
    (got,) = segmentation.sample_segmentations(lattices, [text], [5], k=len(weights) + 3)
    assert {tuple(ids.tolist()): round(log, 6) for ids, log, _, _ in got} == {i: round(w - total, 6) for i, w in weights.items()}
    values = [v for _, _, v, _ in got]
    assert len(got) == len(weights) and values == sorted(values, reverse=True) and all(i == 1 for *_, i in got)
    assert {lattices.decode(ids) for ids, *_ in got} == {text}


def test_samples_come_as_often_as_they_should():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    lattices = segmentation.Lattices(MODEL, segmentation.ALPHA)
    text, n = "at _{", 6000
    weights = _all_segmentations(model, text)
    total = np.logaddexp.reduce(list(weights.values()))
    p = {i: math.exp(w - total) for i, w in weights.items()}
    keys = [int(x) for x in np.random.Generator(np.random.Philox(1)).integers(0, 2**62, n)]
    seen, inclusion = [collections.Counter(), collections.Counter()], collections.Counter()
    for got in segmentation.sample_segmentations(lattices, [text] * n, keys, k=2):
        first, second = (tuple(ids.tolist()) for ids, *_ in got)
        assert first != second
        seen[0][first] += 1
        seen[1][second] += 1
        for ids, log, _, score in got:  # inverse inclusion weights are unbiased
            inclusion[tuple(ids.tolist())] += math.exp(log) / score
    after = collections.Counter()
    for a, b in itertools.permutations(p, 2):
        after[b] += p[a] * p[b] / (1 - p[a])
    for i in p:
        assert seen[0][i] / n == pytest.approx(p[i], abs=0.03)
        assert seen[1][i] / n == pytest.approx(after[i], abs=0.03)
        assert inclusion[i] / n == pytest.approx(p[i], abs=0.04)


def test_lattices_met_again_are_kept_and_change_no_sample(monkeypatch):
    rng = random.Random(9)
    often = ["".join(rng.choices("aehinorst", k=7)) for _ in range(30)]
    texts = [" ".join([*often, *("".join(rng.choices("aehinorst", k=9)) for _ in range(40))]) for _ in range(12)]
    alone = [segmentation.sample_segmentations(segmentation.Lattices(MODEL, segmentation.ALPHA), [t], [i])[0] for i, t in enumerate(texts)]
    monkeypatch.setattr(segmentation, "REMEMBERED", 100)
    monkeypatch.setattr(segmentation, "BUILT", 90, raising=False)
    lattices, built = segmentation.Lattices(MODEL, segmentation.ALPHA), collections.Counter()
    add = lattices._add
    monkeypatch.setattr(lattices, "_add", lambda runs: (built.update(runs), add(runs))[1])
    together = [segmentation.sample_segmentations(lattices, [t], [i])[0] for i, t in enumerate(texts)]
    as_plain = lambda got: [(ids.tolist(), *rest) for ids, *rest in got]
    assert [as_plain(g) for g in together] == [as_plain(g) for g in alone]
    assert len(lattices.first) < 250 and max(built.values()) == 1


def test_segmentations_of_awkward_texts(spark, rows):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = rows[:60] + _awkward() + [(800_000, "w" * 120_000, "en", "s", 1, 2, "3", 4), (800_001, "a ▁ b", "en", "s", 1, 2, "3", 4)]
    docs = spark.createDataFrame(rows, ROW)
    got = segmentation.segmentations(docs, MODEL).collect()
    text_of = {r[0]: r[1] or "" for r in rows}
    per_row = collections.Counter((r["doc_id"], r["sample"]) for r in got)
    for r in got:
        text = text_of[r["doc_id"]]
        assert r["n_pieces"] == len(r["ids"]) and 0 <= r["inclusion"] <= 1 and r["round_trip"] == ("▁" not in text)
        if r["round_trip"] and text:
            assert model.decode(r["ids"]) == text
    for doc_id, text in text_of.items():
        copies = sum(r[0] == doc_id for r in rows)
        most = min(3, len(_all_segmentations(model, text))) if 0 < len(text) < 6 else 3 if text else 1
        assert [per_row[doc_id, s] for s in (1, 2, 3)] == [copies * (s <= most) for s in (1, 2, 3)], doc_id
    plain = segmentation.segmentations(docs.repartition(5), MODEL, with_ids=False).collect()
    same = lambda rs: sorted((r["doc_id"] or -1, r["sample"], r["n_pieces"], round(r["log_prob"], 6)) for r in rs)
    assert same(plain) == same(got) and all(r["ids"] is None for r in plain)
    assert segmentation.segmentations(docs.limit(0), MODEL).collect() == []


BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_spliced_counts_equal_the_library():
    rng = random.Random(3)
    coder = token_counts.Encoder(BPE)
    pieces = ["a", "bc", " ", "  ", "\n", "\t", "é", "日本", "<|endoftext|>", "'s", "12", "!?", "\x1c", " ", "ß", "😀", "-", "word", " word"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 60)))
        want = len(coder.library.encode(text, add_special_tokens=False).ids)
        assert coder.count(text) == want, text
        for chunk, overlap in ((6, 2), (16, 4), (40, 10)):
            assert token_counts.count_tokens_long(text, coder, chunk, overlap) == want, text


def test_a_chunk_is_encoded_once():
    """Outside the overlaps nothing is encoded twice, and every token of the result comes from a chunk."""

    class Counting(token_counts.Encoder):
        read = 0

        def ends(self, text):
            self.read += len(text)
            return super().ends(text)

        def count(self, text):
            raise AssertionError

    coder, text = Counting(BPE), "some words of a text " * 4000
    assert token_counts.count_tokens_long(text, coder, 1000, 50) == len(coder.library.encode(text, add_special_tokens=False).ids)
    assert coder.read < 1.1 * len(text)


def test_token_counts(spark, rows):
    rows = rows + [(800_000, "w" * 90_000, "en", "s", 1, 2, "3", 4), (800_001, "one two\n" * 20_000, "en", "s", 1, 2, "3", 4)]
    docs = spark.createDataFrame(rows, ROW)
    library = token_counts.Encoder(BPE).library
    want = [(r[0] or -1, len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows]
    got = token_counts.token_counts(docs, BPE).collect()
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in got) == sorted(want)
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    assert token_counts.token_counts(docs.limit(0), BPE).collect() == []
