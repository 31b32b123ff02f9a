"""Toxicity, personal data, languages, web pages, fingerprints and the pipeline."""

from __future__ import annotations

import hashlib
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from noticeworks.llm import fingerprints, langid, pii, toxicity, webtext
from noticeworks.llm.queries import QUERIES
from tests.llm.helpers import ODD, SF, base_spans, no_documents, odd_documents

BIG = "/root/testdata/sf0.01"


def held(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# --- toxicity ---------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "symbols"),
    [
        ("you are an idiot", {"D"}),
        ("an idiot came by", {"I"}),
        ("idiot you", {"I", "g"}),
        ("he is not an idiot", {"n"}),
        ('she said that this idiot "left"', {"r"}),
        ("I will kill you", {"T"}),
        ("they kill time", set()),
        ("idiotic ideas", set()),
        ("du bist kein Trottel", {"n"}),
    ],
)
def test_clauses(text, symbols):
    scorer = toxicity.Scorer(toxicity.Model())
    got = {c for c, x in zip(scorer.order, scorer.features(text), strict=True) if x}
    assert got - {"clauses"} == symbols


def test_contexts_order_scores():
    score = toxicity.Scorer(toxicity.Model()).score
    plain = score("The house is green.")
    assert score("") == plain == score("idiomatic")
    assert plain < score("He was not an idiot.") + 1e-9 < score("An idiot!") < score("You idiot! You moron! You scum!")
    assert score("I will kill you") > 0.5 < score("You idiot.")


def test_composition_feeds_one_machine_into_the_other():
    a = toxicity._countdown("x", 2, {"y": "z"})
    b = toxicity._countdown("z", 1, {"y": "w"})
    both = toxicity.compose(a, b, {"x", "y", "o"})
    rng = random.Random(1)
    for _ in range(200):
        word = rng.choices("xyo", k=8)
        assert both.run(word) == b.run(a.run(word))


def test_scores_do_not_scan_clauses_without_cues():
    scorer = toxicity.Scorer(toxicity.Model({"blorf*": 2.0, "gnark": 1.0}))
    text = "x. " * 2000 + "the blorfing gnark. " + "y! " * 2000
    assert scorer.features(text) == scorer.features("the blorfing gnark")
    assert scorer.features("blorf gnarks ablorfing") == [0.0] * len(scorer.order)


def test_learnt_stems_and_labels_that_may_be_used(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(400):
        w = ["".join(rng.choice("aeioulmnrst") for _ in range(5)) for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                w[rng.randrange(60)] = "vork" + rng.choice(["a", "an", "el", "ish"])
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic) if not held(i) else 1 - int(toxic)))  # labels that must not be learnt are wrong
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert any(s.startswith("vork") for s in model.stems)
    got = toxicity.with_scores(docs, model).collect()
    assert sum((r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in got) >= 396


def test_toxicity_of_odd_rows(spark):
    docs = odd_documents(spark, ("score", "predicted"))
    labels = spark.createDataFrame([(None, 1, 1), (4, 1, None), (4, 1, 1), (4, 1, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        out = toxicity.with_scores(docs, toxicity.learn(docs, known))
        assert set(out.columns) == set(docs.columns)
        rows = out.collect()
        assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ODD)
        assert all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.with_scores(no_documents(spark), toxicity.Model()).count() == 0


def test_toxicity_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    rows = QUERIES["op2_toxicity"](spark, BIG).collect()
    assert all(r["held_out"] == held(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    own = [r["predicted"] == truth[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(own) >= 0.95 * len(own)


# --- personal data ----------------------------------------------------------------------------------


def spans_of(text: str) -> list[tuple[str, int, int]]:
    return [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.@+-0123456789 ()%_\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert spans_of(text) == base_spans(text)


@pytest.mark.parametrize(
    "text",
    ["4111 1111-1111 1111", "4111111111111112", "1.2.3.4.5.6.7.8", "001.2.3.0255", "1.2.3.256", "a@b@c.d", "a@b.c@d.e", "+1 (555) 010-9999)", "+1 ((((", "é@b.co x@y.z."],
)
def test_base_cases(text):
    assert spans_of(text) == base_spans(text)


def test_long_runs_take_linear_time():
    start = time.time()
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1 " * 100_000, "+1 " + "(" * 300_000):
        pii.base_spans(text)
    assert time.time() - start < 20


@pytest.fixture(scope="module")
def field():
    return pii.trained()


def test_viterbi_finds_the_best_labels(field):
    tokens = pii.tokens_of("call 555-0199")
    scores, _ = field.scores([tokens])
    best, k = None, len(pii.LABELS)
    for code in range(k ** len(tokens)) if k ** len(tokens) < 40_000 else []:
        labels = [code // k**t % k for t in range(len(tokens))]
        s = field.first[labels[0]] + sum(scores[t, 0, x] for t, x in enumerate(labels)) + sum(field.move[a, b] for a, b in zip(labels, labels[1:], strict=False))
        if best is None or s > best[0]:
            best = (s, labels)
    if best:
        assert field.decode([tokens])[0] == best[1]
    alone, together = field.decode([tokens])[0], field.decode([pii.tokens_of("x"), tokens, pii.tokens_of("a b c d e 9")])[1]
    assert alone == together


def test_field_on_fresh_examples(field):
    table = pii.labelled_table(2, 77)
    right = 0
    for (text, spans), labels in zip(table, field.decode([pii.tokens_of(t) for t, _ in table]), strict=True):
        right += pii._gold(pii.tokens_of(text), spans) == labels
    assert right >= 0.95 * len(table)


def test_field_adds_what_the_patterns_miss(field):
    text = "Write to jo.smith (at) example (dot) com or call (980) 555-6268 soon. Version 2.0 of 1999."
    (base, every), (none, quiet) = pii.all_spans([text, "In 1999 we had 12 of 30, version 2.0."], field)
    assert not base and not none and not quiet
    assert {pii.KINDS[k] for k, *_ in every} == {"email", "phone"}


def test_personal_data_of_odd_rows(spark, field):
    out = pii.find(odd_documents(spark, ("spans", "base_spans", "start"))).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in ODD)
    assert pii.find(no_documents(spark)).count() == 0


def test_personal_data_query(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for r in QUERIES["op3_personal_data"](spark, SF).collect():
        want = base_spans(texts[r["doc_id"]])
        joined = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(x[0] == k for x in want) for k in pii.BASE]
        spans = [x for x in r["spans"].split(",") if x]
        assert set(joined) <= set(spans) and (r["n_spans"], r["n_added"]) == (len(spans), len(spans) - len(joined))


# --- languages --------------------------------------------------------------------------------------


def test_vectors_do_not_depend_on_neighbours():
    texts = [b"Hello world 12", b"", b"foo!", b"12 foo", "Äh".encode()]
    together = langid.vectors(texts)
    for t, row in zip(texts, together, strict=True):
        assert np.allclose(langid.vectors([t])[0], row)
    assert np.allclose(together[2], together[3])


def test_svm_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 5)).astype(np.float32)
    sign = np.where(x @ [1, -2, 0.5, 0, 1] + 0.3 > 0, 1.0, -1.0)
    w = langid.svm(x, sign, passes=100)
    assert (np.sign(np.column_stack((x, np.ones(200))) @ w) == sign).mean() > 0.97


def test_languages_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op4_language"](spark, BIG).collect()
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    own = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(own) >= 0.97 * len(own)


def test_languages_of_odd_rows(spark):
    docs = odd_documents(spark, ("lang_pred", "score"))
    rows = langid.with_language(docs, langid.learn(docs)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ODD)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert got[1] == got[2] == got[3] == got[-8] == ("und", 0.0)
    assert {lang for lang, _ in got.values()} <= {"und", "en", "de"}
    assert langid.learn(no_documents(spark)) is None
    assert {r["lang_pred"] for r in langid.with_language(docs, None).collect()} == {"und"}


# --- web pages --------------------------------------------------------------------------------------


def text_of(html: str) -> str:
    return webtext.Page(html).main_text(None)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<body><nav>Menu</nav><article><h1>T</h1><p>One  two<b>three</b><br>four<p>five</article><footer>f</footer>", "T One twothree four five"),
        ("<body><div class='post'><p>Long enough text here</p></div><div class='comments'><p>me too, me too, me too, me too</p></div>", "Long enough text here"),
        ("<div>a &lt; b &amp;amp; c&nbsp;d &am</div>", "a < b &amp; c d &am"),
        ("<div>a < b<script>if (a</p>b)</script> c<!-- x > y --></div>", "a < b c"),
        ("<div title='a > b'>text</div>", "text"),
        ("<div><p>cut off <a hre", "cut off"),
        ("<div><ul><li>x<li>y</ul><div hidden>no</div><div style='display: none'>no</div><p role=navigation>no</p></div>", "x y"),
        ("<main><header><h1>kept</h1></header><p>text</p></main>", "kept text"),
        ("<header>gone</header><div>text<form>no</form><div id=cookie-notice>no</div></div>", "text"),
        ("plain", "plain"),
        ("", ""),
    ],
)
def test_pages(html, text):
    assert text_of(html) == text


def test_letters_that_change_length_in_lower_case():
    """Each of these letters lower-cases to two code points, which must not shift where a script ends."""
    page = f"<article><p>{'İ' * 200}</p><SCRIPT>var a;</ScRiPt><p>The rest of it.</p><style>x</style><p>End.</p></article>"
    assert text_of(page) == f"{'İ' * 200} The rest of it. End."


@pytest.mark.parametrize("name", ["share-prices", "alert-level", "legal-history", "search-for-gold", "notice-of-death", "social-studies"])
def test_names_that_articles_are_about(name):
    assert text_of(f"<article><p>Before.</p><div class='{name}'>Kept text.</div><p>After.</p></article>") == "Before. Kept text. After."


@pytest.mark.parametrize("name", ["share-buttons", "share", "related posts", "site-notice", "legal-links", "social-share-bar", "alert_box2", "skip-to-content"])
def test_names_of_what_is_no_text(name):
    assert text_of(f"<article><p>Before.</p><div class='{name}'>Gone.</div><p>After.</p></article>") == "Before. After."


def test_formulas_and_objects_are_text():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x = 1</annotation></math> hold.</p><object data=a><p>A map of it.</p></object></article>"
    assert text_of(page) == "Let x=1 hold. A map of it."


def test_pages_take_linear_time():
    start = time.time()
    for html in ("<p>" * 50_000, "<div>" * 50_000, '<a href="' * 50_000, "<li><b>" * 50_000, "</p>" * 50_000, "<" * 50_000, "<!--" * 50_000, "<script>" * 50_000):
        text_of(html + "x")
    assert time.time() - start < 20


def test_hosts_agree_on_a_path(spark):
    """One page has more text beside the article than in it; its host's other pages say where to look."""
    page = "<body><div class='story-{0}'><p>{1}</p></div><div class='extra'><p>{2}</p></div></body>"
    rows = [(i, f"https://U@Host.example:80/{i}", page.format(i, f"story {i} " * 20, "x" * 10)) for i in range(6)]
    rows.append((6, "https://host.example/6", page.format(6, "story 6 " * 20, "extra " * 60)))
    rows += [(7, None, page.format(7, "alone " * 9, "")), (8, "https://host.example/8", "<body><p>other template</p>"), (9, "no url", None), (9, "https://x.example", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [(r["page_id"], r["text"]) for r in webtext.main_texts(df.selectExpr("*", "1 AS text", "2 AS path", "3 AS host")).collect()]
    want = [(i, " ".join(f"story {i} ".split() * 20)) for i in range(7)] + [(7, " ".join(["alone"] * 9)), (8, "other template"), (9, ""), (9, "")]
    assert Counter(got) == Counter(want)
    assert webtext.main_texts(df.limit(0)).count() == 0


@pytest.mark.parametrize("opened", ["<b>", "<font>", "<div>", "<span><div>"])
def test_deeply_nested_pages(opened):
    """What stands below 150 open elements is closed and dropped as anywhere else."""
    story, more = "The story goes on for many words. " * 20, "And so it goes on further. " * 20
    page = f"<body><div class=article>{opened * 150}{story}<div>inner</div>{more}<footer>Imprint</footer><nav>Home</nav></div></body>"
    assert webtext.Page(page).text("body/div.article") == " ".join(f"{story} inner {more}".split())


def test_deep_nesting_takes_little_room():
    page = webtext.Page("<div class=wrapper>" * 20_000 + "end")
    assert len(page.paths) == 20_001 and len(set(page.paths)) == 20_001
    assert max(map(len, page.paths)) < 2 * webtext.PATH_CHARS and page.text(None) == "end"


def test_page_query(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op6_web_text"](spark, SF).collect()
    assert {r["page_id"] for r in rows} == set(pages)
    for r in rows:
        assert r["n_chars"] == len(r["text"])
        assert "<p>" not in r["text"] and "&copy;" not in r["text"]


# --- fingerprints -----------------------------------------------------------------------------------


def generalised_jaccard(a: str, b: str) -> float:
    x, y = Counter(a.lower().split()), Counter(b.lower().split())
    return (x & y).total() / max(1, (x | y).total())


def test_share_of_equal_samples_is_the_similarity():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    errors = []
    for _ in range(300):
        a = rng.choices(vocabulary[:100], k=60) + rng.choices(vocabulary, k=rng.randint(0, 60))
        b = a[: rng.randint(0, len(a))] + rng.choices(vocabulary, k=40)
        x, y = fingerprints.signatures([" ".join(a).encode(), " ".join(b).encode()])
        errors.append(fingerprints.likeness(x, y) - generalised_jaccard(" ".join(a), " ".join(b)))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.5 / math.sqrt(fingerprints.SAMPLES) * 1.1


def test_signatures_do_not_depend_on_neighbours(monkeypatch):
    texts = [b"a b c a", b"", b" \n", b"x " * 5000 + b" y", b"C B A a", "ü".encode(), " ".join(map(str, range(3000))).encode()]
    together = fingerprints.signatures(texts)
    monkeypatch.setattr(fingerprints, "ROWS", 7)
    for t, row in zip(texts, together, strict=True):
        assert (fingerprints.signatures([t])[0] == row).all()
    assert (together[0] == together[4]).all()
    assert (together[1] == together[2]).all() and (together[1] == 0xFFFF).all()


def plain_edits(rows: list[tuple]) -> list[tuple]:
    out = []
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[: len(t) - n] + following[:n]).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("size", [4000, 5])
def test_every_row_meets_its_successor(spark, monkeypatch, size):
    """Within one range of ids, and over the borders of many."""
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", size)
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("ab é\U0001f600\n") for _ in range(rng.randint(0, 30)))) for i in rng.sample(range(-50, 900), 60)]
    rows.append((2000, None))
    out = fingerprints.with_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = [(r["doc_id"], r["n_chars"], hashlib.sha256(r["edited"].encode()).hexdigest()) for r in out]
    assert sorted(got) == sorted(plain_edits(sorted(rows)))


def test_fingerprints_have_128_samples():
    assert fingerprints.signatures([b"one two", b""]).shape == (2, 128)


def test_fingerprints_of_odd_rows(spark):
    out = fingerprints.with_fingerprints(odd_documents(spark, ("fingerprint", "range", "id"))).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in ODD)
    same = [r["fingerprint"] for r in out if r["doc_id"] == 4]
    assert same[0] == same[1]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    assert fingerprints.with_fingerprints(no_documents(spark)).count() == 0


def test_fingerprint_query(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in QUERIES["op7_fingerprints"](spark, SF).collect()]
    assert sorted(got) == plain_edits(rows)


# --- pipeline ---------------------------------------------------------------------------------------


def test_stages_chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, SF), "test-" + name.replace(" ", "-"))
        assert out.columns == columns
        assert 0.5 * before < out.count() <= docs.count()
        docs = out
    ids = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: r["decoded_sha256"] for r in ids} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages_on_odd_rows(spark, rows):
    docs = odd_documents(spark, ("score", "fp", "ids", "words_removed")) if rows == "odd" else no_documents(spark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.written(stage(spark, docs, SF), f"odd-{k}")
        assert k == 4 or out.columns == docs.columns
        docs = out
    left = Counter(r["doc_id"] for r in docs.collect())
    # Blank texts all have fingerprint zero, and of the repeated rows one stays.
    assert left == (Counter([1, 4, 5, 6, 7, -8, None]) if rows == "odd" else Counter())
