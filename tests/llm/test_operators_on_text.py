"""Operators that treat each row by itself, against the public libraries, held-out accuracy and hand-made pages."""

from __future__ import annotations

import html as entities
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from funnelworks.llm import html, language, packing, quality, tokens
from tests_llm_shared import SMALL, corpus, nothing, same  # noqa: F401 - fixtures

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encoded(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_counts(spark, corpus, nothing, library):
    rows, df = corpus
    want = sorted(
        (repr(d), len((t or "").encode()), len(ids), len(ids) > 512) for (d, t), ids in zip(rows, encoded(library, [t for _, t in rows]))
    )
    got = sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(df, PATH).collect())
    assert got == want
    assert tokens.count_tokens(nothing, PATH).count() == 0


def test_scanner_and_merger_on_odd_text(library):
    rng = np.random.default_rng(3)
    bits = ["'", "s", "re", "'ll", " ", "  ", "\n", "\t", " ", "a", "1", "½", "!", "é", "漢", "\U0001f642", "<|endoftext|>", "ing"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 40))) for _ in range(1500)]
    _, got = tokens.token_counts(pa.array(texts), PATH)
    assert got.tolist() == [len(x) for x in encoded(library, texts)]


def test_scan_does_not_depend_on_chunks():
    rng = np.random.default_rng(4)
    symbols = rng.integers(0, tokens.SYMBOLS, 5000).astype(np.uint8)
    symbols[0] = tokens.FIRST + symbols[0] % tokens.FIRST
    whole = tokens.scan(symbols, 8192)
    for chunk in (1, 7, 64, 256):
        assert same(tokens.scan(symbols, chunk), whole)


def test_few_states_give_the_same_counts(library):
    machine = tokens.Merger(PATH, max_states=50)
    words = [b" thinking", b"reations", b"zzzzqqq", "déjà".encode()] * 3
    raw = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    for _ in range(3):
        assert machine.counts(raw, starts, ends).tolist() == [len(library.encode(w.decode(), add_special_tokens=False).ids) for w in words]


def test_packing(spark, corpus, nothing, library):
    rows, df = corpus
    pieces = packing.pack(df, PATH, public_tokenizers.PATTERN).collect()
    want = {}
    for (d, _), ids in zip(rows, encoded(library, [t for _, t in rows])):
        ids = np.array([*ids, 0], "<u4")
        want.setdefault(d, []).append(ids)
    by_id, sequences = {}, {}
    for p in pieces:
        by_id.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append(p)
    assert set(by_id) == set(want)
    for d, found in by_id.items():
        assert sum(p.length for p in found) == sum(map(len, want[d]))
        if len(want[d]) == 1:
            at = 0
            for p in sorted(found, key=lambda p: p.start):
                assert (p.start, p.doc_tokens) == (at, len(want[d][0]))
                assert p.ids_crc32 == zlib.crc32(want[d][0][at : at + p.length].tobytes())
                at += p.length
    padding = total = 0
    for found in sequences.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.SEQUENCE
        total += at
        padding += 0 if at & (at - 1) == 0 else packing.SEQUENCE - at
    assert padding <= 0.002 * total
    assert packing.pack(nothing, PATH, public_tokenizers.PATTERN).count() == 0


def test_packing_of_a_long_run_of_blanks(spark, library):
    texts = ["a" + " " * 2_000_000 + "b", "\n" * 2_000_000, "a" + "\r\n " * 700_000 + "<|endoftext|>" + "\u3000" * 1_100_000]
    for text, want in zip(texts, encoded(library, texts)):
        assert same(packing.encode(PATH, public_tokenizers.PATTERN, text), want)
    df = spark.createDataFrame([(1, texts[0])], "doc_id long, text string")
    got = packing.pack(df, PATH, public_tokenizers.PATTERN).agg(F.sum("length"), F.max("doc_tokens")).first()
    assert got[0] == got[1] == len(library.encode(texts[0], add_special_tokens=False).ids) + 1


def test_encoding_in_parts(library):
    rng = np.random.default_rng(6)
    bits = [*" \n\t\r\x0b\x1c\x1f\x85\xa0\u2003\u2028\u200b\u3000\ufeff", "  ", "   ", "a", "1", "!", "'s", "é", "漢", "<|endoftext|>", "<|end"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 30))) for _ in range(3000)]
    for text, want in zip(texts, encoded(library, texts)):
        for least in (2, 3):
            assert packing.encode_in_parts(PATH, public_tokenizers.PATTERN, text, least) == want


def test_patterns_keep_most_documents_whole():
    rng = np.random.default_rng(5)
    lengths, demand = np.unique(rng.integers(1, 1024, 50_000), return_counts=True)
    chosen = packing.choose_patterns(lengths, demand, 1024, pivots=200)
    used = np.zeros(len(lengths), int)
    for pattern, times in chosen:
        assert sum(int(lengths[i]) * n for i, n in pattern.items()) <= 1024
        for i, n in pattern.items():
            used[i] += n * times
    assert (used <= demand).all() and used.sum() > 0.6 * demand.sum()


def test_packing_of_one_length():
    places, cuts, sequences, rest = packing.layout(np.array([700]), np.array([1000]), 1024)
    assert places == [] and sequences == 0 and rest == 700_000 and sum(c[2] for c in cuts) == 700


def test_language(spark, corpus, nothing):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(given)
    got = language.identify(given, model, ["doc_id", "lang"]).toPandas()
    out = got[got.held_out]
    assert len(out) > 100 and (out.lang == out.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all()
    assert (got.held_out == got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()
    _, df = corpus
    odd = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(df, model).collect()}
    assert len(odd) and all(odd[d] == ("und", 0.0) for d in (9000, 9001, 9002, 9004))
    assert language.identify(nothing, model).count() == 0
    assert language.fit(nothing).languages == ()
    assert {r.lang_pred for r in language.identify(df, language.Model()).collect()} == {"und"}


def test_language_without_relatives():
    model = language.train(["abc def ghi"] * 5 + ["xyz uvw rst"] * 5, ["aa"] * 5 + ["bb"] * 5)
    best, score = model.predict(language.ngrams(*language.text_bytes(pa.array(["abc ghi def", "uvw xyz"]))))
    assert [model.languages[i] for i in best] == ["aa", "bb"] and (score > 0.5).all()


def test_language_learns_from_whole_texts(spark):
    blank = "." * 5000  # beyond any prefix; signs do not count
    rows = [(i, f"a{blank} {'abc def ghi ' * 5 if i % 2 else 'xyz uvw rst ' * 5}", "aa" if i % 2 else "bb") for i in range(80)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    best, _ = model.predict(language.ngrams(*language.text_bytes(pa.array(["abc ghi def", "uvw xyz rst"]))))
    assert [model.languages[i] for i in best] == ["aa", "bb"]


def test_dictionary_pieces_come_from_all_over_the_text():
    text = "".join(f"{i:04d}" for i in range(10_000))
    chosen = [quality.pieces_of(f"{seed:04d}{text}") for seed in range(50)]
    assert all(len(p) == quality.PIECES for p in chosen)
    places = [int(piece[:4]) for pieces in chosen for piece in pieces]
    assert min(places) < 1500 and max(places) > 8500 and sum(p > 5000 for p in places) > 60
    assert quality.pieces_of("abc") == [b"abc"] and quality.pieces_of(None) == []


def test_quality(spark, corpus, nothing):
    given, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(given, labels)
    got = quality.score(given.join(labels.select("doc_id"), "doc_id", "left_semi"), model).join(labels, "doc_id").toPandas()
    out = got[got.held_out]
    assert len(out) > 300 and (out.quality == out.predicted).mean() > 0.97
    assert ((out.quality == 0) & (out.predicted == 0)).sum() > 0.9 * (out.quality == 0).sum()
    rows, df = corpus
    scored = quality.score(df, model).toPandas()
    assert len(scored) == len(rows) and scored.score.between(0, 1).all()
    assert quality.score(nothing, model).count() == 0
    assert quality.fit(given, labels.limit(0)).constant == 0.5
    assert set(quality.score(df, quality.Model(None, None, ())).toPandas().score) == {0.5}


def test_page_texts(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r for r in html.extract(pages.withColumn("text", F.lit("extra"))).collect()}
    for page in pages.collect():
        body = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)[^>]*>", " ", body))
        want = " ".join(entities.unescape(plain).split())
        assert (got[page.page_id].text, got[page.page_id].n_chars, got[page.page_id].url) == (want, len(want), page.url)
    assert html.extract(pages.limit(0)).count() == 0


ARTICLE = "<p>First paragraph of some length, with a <a href=x>link</a> in it.</p>\n<p>Be.</p><ul><li>point &amp; one<li>point two</ul>"
TEXT = "First paragraph of some length, with a link in it. Be. point & one point two"


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        (f"<html><head><title>no</title></head><body><nav><a href=/>Home</a></nav><article>{ARTICLE}</article><footer>f</footer>", TEXT),
        (f"<body><header><h2>Site</h2></header><main>{ARTICLE}</main><aside>more</aside><form>name <input><button>Go</button></form>", TEXT),
        (f"<div class='cookie-notice'>We use cookies</div><div id=content>{ARTICLE}</div><div class=comments><p>I disagree, reader.</p></div>", TEXT),
        (f"<nav><a href=/>Menu<article>{ARTICLE}</article><section id='comments'><article class='comment'>no</article></section>", TEXT),
        (f"<script>var a='<p>x</p>';</script><!-- <p>no</p> --><style>p{{}}</style><article>{ARTICLE}<div class='ad banner'>buy</div></article>", TEXT),
        ("<article><p>a&nbsp;b\n\t c</p><p>d<b>e</b>f<br>g</article>", "a b c def g"),
        ("<article></article>", ""),
        (f"<div class='site-header'>Top</div><article><div class='entry-header'><h1>Title</h1></div>{ARTICLE}</article>", f"Title {TEXT}"),
        (f"<div class='page with-sidebar'>{ARTICLE}</div>", TEXT),
    ],
)
def test_page_layouts(page, want):
    assert html.main_text(page) == want


@pytest.mark.parametrize(
    "within, want",
    [
        ('<svg class="i"/>', ""),
        ("<math/>", ""),
        ("<object data=x /><template/><noscript/>", ""),
        ("<svg><title/><path d='M0 0'/><text>label</text></svg>", ""),
        ("<svg><desc><p>label</p></desc><style/></svg>", ""),
        ("<svg class=i><path d=x>", ""),
        ("<object data=x><noscript>", ""),
        ("<noscript><img src=x>Turn scripts on</noscript><template><article>card</article></template>", ""),
        ("<title-block><p>Block</p></title-block><script_note>note</script_note><svg_icon></svg-icon><p>", "Block note"),
        ("<p>Sum<math><mi>a</mi><mo>+</mo><mi>b</mi></math>, then", "Suma+b, then"),
        ("<script>var s = '<p>x</p>';</script ><style>p{}</style\n>", ""),
    ],
)
def test_elements_that_may_lack_an_end(within, want):
    page = f"<body><article><h1>Title</h1>{within}{ARTICLE}</article><footer>f</footer>"
    assert html.main_text(page) == " ".join(f"Title {want} {TEXT}".split())


def test_raw_text_runs_to_a_missing_end():
    assert html.main_text(f"<article>{ARTICLE}<script>var a = 1; </p> b") == TEXT


FIRST, SECOND = " ".join(["first"] * 170), " ".join(["second"] * 58)
LINKS = "".join(f"<p><a href=/{i}>Source number {i}</a></p>" for i in range(4))
SOURCES = " ".join(f"Source number {i}" for i in range(4))
MENU = "".join(f"<div><a href=/{i}>Menu {i}</a></div>" for i in range(5))


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<div><p>{FIRST}</p><div class=ad><p>Buy</p><p>this</p><p>now</p></div><p>{SECOND}</p></div>", f"{FIRST} {SECOND}"),
        (f"<div><p>{FIRST}</p><div class=ad>{LINKS}</div><p>Be.</p></div>", f"{FIRST} Be."),
        (f"<div>{MENU}<p>{FIRST}</p>{LINKS}<p>{SECOND}</p>{MENU}</div>", f"{FIRST} {SOURCES} {SECOND}"),
        (f"<div><p>{FIRST}</p><p><a href=x>Only a link</a></p><p>{SECOND}</p></div>", f"{FIRST} Only a link {SECOND}"),
        (f"<div>{MENU}<p>{FIRST}</p></div><article><a href=x>Teaser</a></article>", f"{FIRST} Teaser"),
        (f"<article>Teaser</article>{MENU}<div><p>{FIRST}</p></div>{MENU}", f"Teaser {' '.join(f'Menu {i}' for i in range(5))} {FIRST}"),
        (f"<div>{MENU}<p>{SECOND}</p></div><main><p>{FIRST}</p>{LINKS}</main>", f"{FIRST} {SOURCES}"),
    ],
)
def test_text_outside_of_articles(page, want):
    assert html.main_text(f"<body><nav>{MENU}</nav>{page}<footer>f</footer>") == want


def test_very_long_page():
    page = "<body><article>" + "<p>" + "word " * 400 + "</p>" * 1 + "<p>x</p>" * 20_000 + "</article>"
    assert len(html.main_text(page)) == 400 * 5 - 1 + 20_000 * 2


def windows_by_hand(weight, main, window, surge):
    ahead = [sum(weight[i : i + window]) for i in range(len(weight))]
    most = max(ahead, default=0)
    up = [i for i, w in enumerate(weight) if w > 0 and (main[i] or ahead[i] >= min(surge, most))]
    if not up:
        return 0, 0
    down = [i for i in range(up[-1] + 1, len(weight)) if ahead[i] == 0]
    return up[0], down[0] if down else len(weight)


def test_surges_and_dives_of_random_lines():
    rng = np.random.default_rng(8)
    for _ in range(2000):
        n = int(rng.integers(0, 30))
        weight = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 60, n))
        main = rng.random(n) < rng.choice([0, 0.3])
        window, surge = int(rng.integers(1, 6)), int(rng.integers(1, 120))
        assert html.between(weight, main, window, surge) == windows_by_hand(weight.tolist(), main.tolist(), window, surge)


def test_windows_decide_every_page(spark, monkeypatch):
    """The text of each given page is what the surge and the dive leave, also where nothing marks an article."""
    calls = []
    plain = html.between
    monkeypatch.setattr(html, "between", lambda *a: calls.append(plain(*a)) or calls[-1])
    pages = [r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    for page in pages:
        body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        text = html.main_text(page)
        without = html.main_text(page.replace("<article>", "<div>").replace("</article>", "</div>"))
        assert text and (without == text or without in text and len(without) > 0.8 * len(text)), body
    assert len(calls) == 2 * len(pages) and all(a < b for a, b in calls)


@pytest.mark.parametrize(
    "page",
    [
        '<a "' * 1_250_000,
        '<a href="' * 550_000,
        "<a href='x\" " * 400_000,
        "<div>x" * 100_000 + "</span>y" * 100_000,
        "<svg><foreignobject>" + "<div><p>x" * 100_000,
        "<div>" * 50_000 + "<nav>a<article>b</article>" * 20_000,
        "<" * 3_000_000,
        "</p>" * 500_000 + "<!-- " * 300_000,
    ],
)
def test_large_broken_pages_take_seconds(page):
    import time

    start = time.perf_counter()
    html.main_text(f"<body>{page}")
    assert time.perf_counter() - start < 15


def test_quotes_in_tags():
    long = "a sentence that is long enough to be taken for text by the windows of the page"
    assert html.main_text(f"<p don't>{long}, it's true</p>") == f"{long}, it's true"
    assert html.main_text(f'<p title="a > b">{long}</p>') == long
    assert html.main_text(f"<p title = 'a \" > b'>{long}</p><p class=x\"y>{long}</p>") == f"{long} {long}"
    assert html.main_text(f'<p title="never closed>{long}</p><p>{long}</p>').endswith(long)


def test_a_hot_length_is_ranked_in_buckets(spark):
    """A third of all rows are one text without an id; lengths are ranked in buckets of a few rows."""
    df = spark.range(1500).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 > 0, F.expr("repeat('word ', cast(1 + id * 7919 % 90 as int))")).otherwise("the same text").alias("text"),
    )
    got = packing.pack(df, PATH, public_tokenizers.PATTERN, size=64, most=16).collect()
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    tokens = {r.doc_id: r.doc_tokens for r in got if r.doc_id is not None}
    assert len(tokens) == 1000 and sum(r.length for r in got) == sum(tokens.values()) + 500 * next(r.doc_tokens for r in got if r.doc_id is None)
    assert 64 * len(held) <= 1.02 * sum(r.length for r in got) + 128
