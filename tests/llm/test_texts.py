"""Personal data, page texts and the pipeline's stages on awkward rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopfloor.llm import exact_dedup, html_text, mixing, ngram_join, personal_data, quality_rules

FORMS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _is_card(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        total += int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10))
    return 16 <= len(digits) <= 19 and total % 10 == 0


def _plain_spans(text):
    """The patterns as they are written, and what they must satisfy."""
    found = []
    for kind, form in FORMS.items():
        for m in form.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": _is_card(digits),
                "phone": 8 <= len(digits) <= 15,
            }
            if fits[kind]:
                found.append((kind, m.start(), m.end()))
    return found


def test_base_spans_equal_the_patterns():
    rng = random.Random(11)
    pieces = ["1", "23", "255", "256", ".", ".", " ", "-", "+", "(", ")", "@", "a", "x.y", "%", "²", "é", "\n", "4111111111111111", "007", "b-c"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert personal_data.base_spans(text) == _plain_spans(text), text


def test_field_on_texts_it_has_not_seen():
    """Precision and recall of whole spans, on the labelled table of another seed."""
    field = personal_data.train(personal_data.labelled_table(seed=5))
    hits = said = wanted = 0
    for labelled in personal_data.labelled_table(copies=20, seed=77):
        text, at, gold = "", 0, []
        for word, tag in labelled:
            start = len(text) + bool(text)
            text = f"{text} {word}".lstrip() if text else word
            if tag.startswith("B-"):
                gold.append([tag[2:], start, len(text)])
            elif tag.startswith("I-"):
                gold[-1][2] = len(text)
        trim = lambda s: (s[0], text[s[1] : s[2]].strip("\"'<>,!#$|."))
        (found,) = personal_data.field_spans([text], field)
        want, got = [trim(s) for s in gold], [trim(s) for s in found]
        hits, said, wanted = hits + sum(g in want for g in got), said + len(got), wanted + len(want)
    assert hits / wanted > 0.97 and hits / said > 0.97


def test_personal_data_of_awkward_texts(spark):
    secret = "0123456789abcdef" * 2 + "01234567"
    texts = ["see 1.1.1.² now", "²²² ١٢٣ @ @@ ٣.١.١.١", None, "", f'token = "{secret}"!! Des +1 (826) 555-4081 190.137.223.20 du', "1" * 100_000, "x@" * 30_000, " " * 90_000 + "1"]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id int, text string, spans int")
    field = personal_data.train(personal_data.labelled_table())
    got = {r["doc_id"]: r for r in personal_data.find_personal_data(docs, field).collect()}
    assert len(got) == len(texts) and got[2]["spans"] == got[3]["spans"] == ""
    base = [s for s in _plain_spans(texts[4])]
    assert f"secret:9:{9 + len(secret)}" in got[4]["spans"] and "phone:57:74" in got[4]["spans"] and ("ip", 75, 89) in base
    assert personal_data.find_personal_data(docs.limit(0), field).collect() == []


def test_equal_pages_keep_their_text(spark):
    own = "one two three four five six seven eight nine ten eleven"
    bare, other = f"<p>{own}</p><p>footer that every page of this host repeats word by word</p>", "<p>Quite another text of eight words and more.</p>"
    other += "<p>footer that every page of this host repeats word by word</p>"
    rows = [(1, "http://h/a", bare), (2, "http://h/b", bare), (3, "http://h/c", other), (4, "http://h/d", f"<article><p>{own} &amp; more</p></article>"), (5, None, None)]
    got = {r["page_id"]: r["text"] for r in html_text.main_texts(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert got == {1: own, 2: own, 3: "Quite another text of eight words and more.", 4: own + " & more", 5: ""}


CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, _keep int, _id int, _size string, _n int, _copies int, k int, kept int"


def _stage_rows():
    words = " ".join(f"word{k}" for k in range(80))
    texts = [words, words, words + " end", None, "", " \t\n", "x" * 50_000, "short text", words.upper()]
    return [(k, t, ("en", None, "")[k % 3], ("s", None)[k % 2], 1, 1, 2, "s", 3, 4, 5, 6) for k, t in enumerate(texts)] + [(0, words, "en", "s", 1, 1, 2, "s", 3, 4, 5, 6)]


@pytest.mark.parametrize(
    "stage", [quality_rules.keep_good, exact_dedup.drop_exact, lambda d: ngram_join.drop_similar(d, 5, 80), mixing.mixed_documents]
)
def test_stages_with_clashing_columns(spark, stage):
    docs = spark.createDataFrame(_stage_rows(), CLASHING)
    got = stage(docs)
    assert got.columns == docs.columns
    rows = set(map(tuple, docs.collect()))
    assert all(tuple(r) in rows for r in got.collect())
    assert stage(docs.limit(0)).collect() == []


def test_exact_and_similar_stages_keep_one_of_each(spark):
    docs = spark.createDataFrame(_stage_rows(), CLASHING)
    kept = sorted(r["doc_id"] for r in exact_dedup.drop_exact(docs).collect())
    assert kept == [0, 0, 2, 3, 5, 6, 7, 8]  # rows repeated with one id and text stay together
    near = sorted(r["doc_id"] for r in ngram_join.drop_similar(docs.where("doc_id <> 0"), 5, 80).select(F.col("doc_id")).collect())
    assert near == [1, 3, 4, 5, 6, 7]


def test_pipeline_stages_keep_their_contract(spark, folder):
    """Every stage but the last returns the columns of documents, and none makes rows up."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, before, folder)
        assert after.columns == docs.columns, name
        ids = {r[0] for r in after.select("doc_id").collect()}
        assert 0 < len(ids) <= before.count() and ids <= {r[0] for r in before.select("doc_id").collect()}
        before = spark.createDataFrame(after.collect(), docs.schema)
