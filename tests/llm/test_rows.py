"""Row-wise operators: decontamination, token counts, quality, toxicity, HTML text."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from issuelens.llm import decontaminate, html_samples, html_text, quality, token_counts, toxicity
from issuelens.llm.tokens import ByteCounter, WordEncoder, default_path, opened

from .conftest import ODD, SCHEMA, rows_of

WORDS, BYTES = default_path("word_bpe_49k.json"), default_path("byte_bpe_50k.json")
ANY_TEXT = st.text(st.one_of(st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0 　.,'sStT<|endoftext|>aÀß́Σ1½字"), st.characters(codec="utf-8")), max_size=60)


# -- tokens

@settings(max_examples=300, deadline=None)
@given(ANY_TEXT)
def test_ids_are_the_library_s(text):
    coder = opened(WordEncoder, WORDS)
    import numpy as np

    assert np.frombuffer(coder.ids(text), coder.dtype).tolist() == coder.whole.encode(text, add_special_tokens=False).ids


def test_words_of_other_white_space_shift_no_ids():
    import numpy as np

    nbsp, thin = "\u00a0", "\u2009"
    words = [f"{a}{b}" for a in ("alpha", "ten", "Five", "b2", "x.") for b in range(8)]
    for seed in range(20):  # a lone one (vanishes) and an inner one (falls apart) leave the number of pieces as it was
        rnd = random.Random(seed)
        some = rnd.sample(words, 12)
        first = " ".join(rnd.sample([*some, nbsp, f"ten{nbsp}five"], 14))
        second = " ".join([*some, thin, f"a{thin}b", "\u3000", "c\u0085d", *reversed(some)])
        coder = WordEncoder(WORDS)
        for text in (first, second, " ".join(words), f"new{seed} a\ue000{nbsp} \ue000 {nbsp}"):
            assert np.frombuffer(coder.ids(text), coder.dtype).tolist() == coder.whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(ANY_TEXT, max_size=4))
def test_counts_are_the_library_s(texts):
    counter = opened(ByteCounter, BYTES)
    assert counter.counts(texts) == [len(counter.whole.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_counts_of_odd_rows(spark, odd_docs, no_docs):
    t = Tokenizer.from_file(BYTES)
    got = Counter(map(tuple, token_counts.token_counts(odd_docs, batch_bytes=100).collect()))
    n = [len(t.encode(x or "", add_special_tokens=False).ids) for _, x in ODD]
    assert got == Counter((i, len((x or "").encode()), k, k > 1024) for (i, x), k in zip(ODD, n, strict=True))
    assert token_counts.token_counts(no_docs).count() == 0


# -- decontamination

def plain(text):
    return decontaminate.plain_words(text)


def brute_hits(text, items, size=10):
    words = plain(text)
    hit, found = set(), set()
    for item, t in items:
        ws = plain(t)
        for i in range(max(1, len(ws) - size + 1)) if ws else ():
            g = ws[i : i + size]
            for k in range(len(words) - len(g) + 1):
                if words[k : k + len(g)] == g:
                    hit.update(range(k, k + len(g)))
                    found.add(item)
    return len(words), len(hit), sorted(str(x) for x in found if x is not None)


def bench_rows():
    rnd = random.Random(3)
    items = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 16)))) for i in range(12)]
    return [*items, (100, None), (101, "..."), (5, items[5][1]), (None, "q w e r t z u i o p a"), (102, "Solo")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_contamination_equals_brute_force(spark, odd_docs, no_docs, block_bytes):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("aab,B.") + " " for _ in range(rnd.randint(0, 60))) for _ in range(25)]
    texts += ["x q w e r t z u i o p y", "solo!", "SOLO so", "a" * 500]
    docs = spark.createDataFrame(rows_of(enumerate(texts)), SCHEMA)
    items = bench_rows()
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("items", F.lit(1))
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.contamination(docs, bench, block_bytes=block_bytes).collect()}
    assert got == {i: brute_hits(t, items) for i, t in enumerate(texts)}
    odd = decontaminate.contamination(odd_docs, bench, carry=("text", "lang"), block_bytes=block_bytes)
    assert odd.columns[:3] == ["doc_id", "text", "lang"] and odd.count() == len(ODD)
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert not decontaminate.contamination(docs, bench.where("false")).where("contaminated or n_items > 0").count()


def test_a_large_benchmark_is_searched_exactly_and_built_in_seconds():
    """60,000 windows of ten words and short items, against sets of tuples."""
    import time

    rnd = random.Random(8)
    vocab = [f"v{k}" for k in range(400)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(310))) for i in range(200)] + [(500 + i, f"v{i} v{i + 1} v{i}") for i in range(300)]
    t = time.time()
    bench = decontaminate.Benchmark(items)
    assert time.time() - t < 30
    tables = bench.searches[-1][0]
    assert len(tables.windows) > 50_000 and (tables.shift == 0).mean() < 0.2  # sized with the windows
    held = {}
    for i, text in items:
        w = plain(text)
        for k in range(max(1, len(w) - 9)):
            held.setdefault(tuple(w[k : k + 10]), set()).add(i)
    for _ in range(60):
        words = [rnd.choice(vocab) for _ in range(200)]
        for _ in range(3):  # whole windows, and stretches a word too short
            source, at, n = items[rnd.randrange(200)][1].split(), rnd.randrange(280), rnd.choice([9, 10, 25])
            put = rnd.randrange(170)
            words[put : put + n] = source[at : at + n]
        want, found = set(), set()
        for m in (3, 10):
            for k in range(len(words) - m + 1):
                if (g := tuple(w.encode() for w in words[k : k + m])) in held:
                    want.update(range(k, k + m))
                    found |= held[g]
        n, hit, got = bench.search(" ".join(words))
        assert (n, set(np.flatnonzero(hit).tolist()), got) == (len(words), want, found)


# -- quality

def brute_quality(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    rep = {p for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines, dup, chars = set(), 0, 0
    for line in (text or "").split("\n"):
        n = len("".join(c for c in line if c not in " \t\n\x0b\x0c\r"))
        if line in lines and n:
            dup, chars = dup + 1, chars + n
        lines.add(line)
    total = sum(map(len, words))
    failed = len(words) < 10 or 100 * len(rep) > 20 * len(words)
    symbols = sum(c in quality.SYMBOLS for c in text or "")
    within = True
    for n in range(5, 11):
        grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        at = {p for i in range(len(words) - n + 1) if grams[tuple(words[i : i + n])] > 1 for p in range(i, i + n)}
        within &= 100 * sum(len(words[p]) for p in at) <= (25 - n) * total
    kept = not failed and within and chars <= 0.3 * total and symbols <= 0.1 * len(words)
    return len(words), total, symbols, dup, len(rep), failed, kept


def test_each_length_can_reject_a_text(spark):
    """A passage of n words met twice, of such a part of the text that only n-grams of that length are over their limit."""
    texts = []
    for n in range(5, 11):
        passage = [f"p{k:02}" for k in range(n)]
        total = 2 * n * 100 // (25 - n)  # words of three characters: the passage's two places are just over 25 - n hundredths
        for size in (total - 1, total + 2):
            rest = [f"{k:03}" for k in range(size - 2 * n)]
            texts.append(" ".join([*passage, *rest[:9], *passage, *rest[9:]]))
    docs = spark.createDataFrame(rows_of(enumerate(texts)), SCHEMA)
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    for k, text in enumerate(texts):
        assert got[k].kept == brute_quality(text)[-1]
    over = [[100 * got[k][f"chars_{n}"] > (25 - n) * got[k].word_chars for n in range(5, 11)] for k in range(0, 12, 2)]
    assert [row.index(True) for row in over[1:]] and all(row[i] for i, row in enumerate(over))
    loose = {n: 20 for n in range(5, 11)}
    changed = [k for k, r in ((r.doc_id, r) for r in quality.quality(docs, ngram_percent=loose).collect()) if r.kept and not got[k].kept]
    assert len(changed) >= 5  # texts that five words alone would keep


def test_quality_equals_brute_force(spark, odd_docs, no_docs):
    rnd = random.Random(9)
    texts = ["".join(rnd.choice(["ab", "c", "é", "#", " ", " ", "\n", "\t", "\xa0"]) for _ in range(rnd.randint(0, 400))) for _ in range(60)]
    texts += ["x y z w v\n" * 3 + " ".join(f"w{i}" for i in range(200)), "same line here\nsame line here\nother words " + " ".join(map(str, range(40)))]
    docs = spark.createDataFrame(rows_of(enumerate(texts)), SCHEMA)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = {r.doc_id: tuple(r[c] for c in names) for r in quality.quality(docs).collect()}
    assert got == {i: brute_quality(t) for i, t in enumerate(texts)}
    odd = quality.quality(odd_docs, carry=("text", "source")).collect()
    assert Counter((r.doc_id, *[r[c] for c in names]) for r in odd) == Counter((i, *brute_quality(t)) for i, t in ODD)
    assert quality.quality(no_docs).count() == 0


# -- toxicity

def toxic_table(spark):
    rnd = random.Random(1)
    vocab = [f"{a}{b}{c}" for a in "bdgklm" for b in ("ar", "el", "in") for c in ("o", "um", "est")]
    rows = []
    for i in range(900):
        y = i % 4 == 0
        words = [rnd.choice(vocab) for _ in range(rnd.randint(20, 80))]
        if y:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(["dumbhead", "fooltroll"]))
        elif i % 9 == 1:
            k = rnd.randrange(len(words))
            words[k:k] = ["the", "dumbhead", "shark"]
        rows.append((i, " ".join(words), int(y)))
    docs = spark.createDataFrame(rows_of([(i, t) for i, t, _ in rows]), SCHEMA)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 0, 1), (5000, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    return docs, labels, {i: y for i, _, y in rows}


def test_toxicity_held_out_accuracy_folding_and_exceptions(spark, odd_docs, no_docs):
    docs, labels, truth = toxic_table(spark)
    lexicon = toxicity.train(docs, labels)
    assert ("the", "dumbhead", "shark") in lexicon.exceptions
    got = toxicity.toxicity(docs, lexicon).collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out]
    assert len(held) > 200 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    m = toxicity.Matcher(lexicon)
    clean = m.score("karo belum dines")
    for t in ("a dumbhead a", "DUMBHEADS", "dumbh3ad", "dumbhеad", "ｄｕｍｂｈｅａｄ", "d.u.m.b.h.e.a.d", "fооltr0ll"):
        assert m.score(t) > clean + 0.2, t
    assert m.score("see the dumbhead shark swim") == clean
    odd = toxicity.toxicity(odd_docs, lexicon)
    assert odd.count() == len(ODD) and odd.where("score is null or held_out is null").count() == 0
    assert toxicity.toxicity(no_docs, lexicon).count() == 0
    empty = toxicity.train(docs, labels.where("false"))
    assert not empty.weights and toxicity.toxicity(docs, empty).select("score").distinct().count() == 1


# -- HTML

def test_labels_without_a_document_take_no_place_in_the_sample(spark):
    docs = spark.createDataFrame(rows_of([(i, f"text {i}") for i in range(0, 3000, 100)] * 2), SCHEMA)
    labels = spark.range(3000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    learned = [f"text {i}" for i in range(0, 3000, 100) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert sorted(r.text for r in toxicity.sample(docs, labels, len(learned)).collect()) == sorted(learned)
    assert toxicity.sample(docs, labels, 5).count() == 5


@pytest.fixture(scope="module")
def model():
    return html_text.train([])


def page(body):
    return f"<html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


ARTICLE = "<p>This is the first paragraph of the text, which has commas, and it ends here.</p><p>And a second one follows it, to say some more of the same.</p><p>Short.</p>"
TEXT = "This is the first paragraph of the text, which has commas, and it ends here.\n\nAnd a second one follows it, to say some more of the same.\n\nShort."
OTHERS = {
    "menu": '<nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>',
    "named menu": '<div class="main-menu"><ul><li><a href="/a">A</a></li><li><a href="/b">B b</a></li></ul></div>',
    "footer": "<footer>&copy; Name, and all the rights there are.</footer>",
    "header": '<header class="masthead"><div class="logo">The Site</div></header>',
    "sidebar": '<aside class="sidebar"><h3>Popular</h3><p>Some long words in a sidebar that may look like a text by themselves.</p></aside>',
    "notice": '<div class="cookie-notice"><p>This page keeps cookies, and by reading on you agree to all of that.</p></div>',
    "advert": '<div class="ad">Buy this thing now, it costs very little today.</div>',
    "form": '<form action="/s"><p>Write to us what you think of this.</p><input name="q"><textarea>x y</textarea></form>',
    "comments": '<section id="comments"><h2>2 comments</h2><div class="comment"><p>I think that this is a good text, by the way, and thanks for it.</p></div></section>',
    "script": "<script>var t = '</p><p>not a text';</script><noscript><p>Turn it on.</p></noscript><!-- <p>gone</p> -->",
}


@pytest.mark.parametrize("kind", OTHERS)
@pytest.mark.parametrize("around", ["<article>%s</article>", '<div id="content">%s</div>', "<main>%s</main>"])
def test_only_the_article_is_text(model, kind, around):
    assert html_text.main_text(page(OTHERS[kind] + around % ARTICLE), model) == TEXT
    assert html_text.main_text(page(around % ARTICLE + OTHERS[kind]), model) == TEXT


def test_blocks_references_and_broken_markup(model):
    body = "<article><h1>A&amp;B &lt;c&gt;</h1><p>One <b>two<br>three.<p>Four \n\t five &eacute; &#233; &nbsp; 1 < 2 &am</article>"
    assert html_text.main_text(page(body), model) == "A&B <c>\n\nOne two three.\n\nFour five é é 1 < 2 &am"


@pytest.mark.parametrize("tag", html_text.DROPPED)
def test_elements_without_end_tag_cost_only_their_own_text(model, tag):
    article = f"<article>{ARTICLE}</article>"
    for head in (f"<header><{tag} class=x>Menu</header>", f"<{tag}>Menu", f"<div><{tag}>Menu<{tag}>More</div>", f"<p>Menu</p><{tag}><{tag}>"):
        assert html_text.main_text(page(head + article), model).endswith(TEXT)
        assert html_text.main_text(page(head + article + f"<footer><{tag}>Go</{tag}></footer>"), model).endswith(TEXT)
        assert html_text.main_text(page(article + head), model).startswith(TEXT)
    inside = ARTICLE.replace("paragraph of", f"<{tag}>not a <b>text<p>x</p></b></{tag}>paragraph <{tag}/>of")
    assert html_text.main_text(page(f"<article>{inside}</article>"), model) == TEXT
    last = ARTICLE.replace("Short.", f"Short.<{tag}>not a text")
    assert html_text.main_text(page(f"<article>{last}</article>"), model) == TEXT


def test_inside_of_math_map_and_object_is_text(model):
    for tag in ("math", "map", "object"):
        assert html_text.main_text(page("<article>" + ARTICLE.replace("Short.", f"<{tag}>Short.</{tag}>") + "</article>"), model) == TEXT
        assert html_text.main_text(page(f"<{tag}><article>{ARTICLE}</article>"), model) == TEXT


def test_quotes_delimit_only_values(model):
    for given in ("title=don't", "title = don't", "don't", 'title=5"', "href=/a?b='c'd", "title='a > b'", 'title = "a > b"', "title=", "= '>'", 'a=b="c'):
        body = ARTICLE.replace("paragraph", f"<a {given}>paragraph</a>").replace("Short.", "It's short.")
        want = TEXT.replace("Short.", "It's short.")
        assert html_text.main_text(page(f"<article>{body}</article>"), model) == want, given


def test_broken_pages_take_linear_time(model):
    import time

    for part in ("<video>", "<video><p>", "<button>", "<svg><div>x</svg>", "<template></div><p>", "<a b='", "<a b= ", "<a =", "<select><li>"):
        start = time.process_time()
        html_text.parse(part * 20000)
        assert time.process_time() - start < 10, part


def test_marginals_are_those_of_brute_force(model):
    import itertools
    import math

    nodes, _ = html_text.parse("<article><h1>x y</h1><p>some words here</p><div class=ad>b c</div></article><nav><a>q</a></nav>")
    unary = [sum(model.weights.get(x, 0) for x in f) for f in html_text.features(nodes)]
    total, ones = 0.0, [0.0] * len(nodes)
    for ys in itertools.product((0, 1), repeat=len(nodes)):
        s = sum(u for u, y in zip(unary, ys, strict=True) if y)
        s += sum(model.ties.get(html_text._group(n.tag), [[0, 0], [0, 0]])[ys[n.parent]][ys[i]] for i, n in enumerate(nodes) if i)
        total += math.exp(s)
        for i, y in enumerate(ys):
            ones[i] += y * math.exp(s)
    assert model.marginals(nodes) == pytest.approx([x / total for x in ones], abs=1e-9)


def test_extract_odd_rows_and_tables(spark, model):
    rows = [(1, "u", None), (2, None, ""), (None, "u", page("<article>" + ARTICLE + "</article>")), (3, "v", "<p>" * 3000), (3, "v", "<p>" * 3000), (4, "w", "<!-- open"), (5, "w", "plain words only")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(0))
    got = html_text.extract(df, html_text.train_on(df)).collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter((i, u) for i, u, _ in rows)
    assert {r.page_id: r.text for r in got}[None] == TEXT and all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(df.where("false"), model).count() == 0


def test_labelled_samples_are_learned(model):
    for sample in html_samples.LABELLED:
        bare, _ = html_text.parse(sample.replace(" data-main", "").replace(" data-not", ""))
        nodes, blocks = html_text.parse(sample)
        ys, p = html_text.labels(nodes, True), model.marginals(bare)
        assert all((p[i] >= 0.5) == ys[i] for i, _ in blocks)


def test_items_digest_of_nothing(spark):
    assert spark.range(1).select(F.sha2(F.concat_ws(",", F.array().cast("array<string>")), 256)).first()[0] == hashlib.sha256(b"").hexdigest()


# -- HTML text: shapes that real pages have

_S = "Word after word makes a sentence of some length, with a comma here and there, and it ends in a full stop. " * 3


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f'<form id="aspnetForm"><div class="menu"><a href="/">Home</a></div><div id="content"><h1>T</h1><p>{_S}</p></div></form>', ["T", _S.strip()]),
        (f'<div class="review-body"><h1>T</h1><p>{_S}</p></div>', ["T", _S.strip()]),
        (f'<article class="post social thread-post"><h1>T</h1><p>{_S}</p></article>', ["T", _S.strip()]),
        (f'<article><h1>T</h1><p>{_S}</p><h2>References</h2><ol><li><a href="x">One</a></li><li><a href="y">Two</a></li></ol></article>', ["T", _S.strip(), "References", "One", "Two"]),
        (f'<article><h1>T</h1><p>{_S}</p></article><div>Copyright 2020</div>', ["T", _S.strip()]),
        (f'<article><h1>T</h1><p>{_S}</p></article><form class="login"><p>{_S}</p></form>', ["T", _S.strip()]),
    ],
)
def test_articles_that_names_and_frames_hid(page, want):
    assert html_text.main_text(page, html_text.train([])).split("\n\n") == want


def test_deep_pages_take_little_memory():
    import time
    import tracemalloc

    model = html_text.train([])
    page = "<html><body>" + "<div class=menu><div id=side>" * 32_000 + f"x</div></div>{_S}"  # 1 MB
    tracemalloc.start()
    t = time.time()
    html_text.main_text(page, model)
    assert tracemalloc.get_traced_memory()[1] < 200e6 and time.time() - t < 60
    tracemalloc.stop()


def test_articles_are_found_where_tags_and_names_say_nothing():
    """Held-out pages of the test table without names, and with div for all telling tags: precision and recall in characters."""
    import re

    import pyarrow.parquet as pq

    pages = [h for h in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist() if h]
    model = html_text.train(pages[:100])
    hide = lambda h: re.sub(r"<(/?)(article|main|section|nav|header|footer|aside)\b", r"<\1div", re.sub(r"\s(class|id|role|itemprop|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", h))
    got = want = both = 0
    for h in pages[100:]:
        g, w = (Counter(html_text.main_text(x, model).split("\n\n")) for x in (hide(h), h))
        size = lambda c: sum(len(t) * n for t, n in c.items())
        got, want, both = got + size(g), want + size(w), both + size(g & w)
    assert both / got > 0.9 and both / want > 0.9
