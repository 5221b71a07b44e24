import re
from html import unescape

import numpy as np

from usageledger.llm import html, ngram


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_generated_pages_give_their_articles(spark):
    rows = html.extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()
    sources = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", sources[r["page_id"]], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_furniture_goes_and_text_stays():
    text = html.main_text(page(
        '<header><a href="/">Site</a></header><nav>Menu <a>x</a></nav><div class="cookie-notice">We use cookies</div>'
        '<aside>Side</aside><form>Name <input> <button>Go</button></form><main><h1>Head &amp; line</h1><p>First\n  <i>para</i>graph&nbsp;here.'
        '<br>Next</p><script>var a="<p>no</p>";</script><div class="ad">Buy</div><ul><li>one<li>two</ul>'
        '<section id="comments"><p>I disagree</p></section></main><footer>&copy; 2020</footer>'
    ))
    assert text == "Head & line\nFirst paragraph here. Next\none\ntwo"


def test_undeclared_main_part_by_line_weights():
    long = "A sentence of the article that goes on for a while and says something. " * 3
    text = html.main_text(page(f'<div><a href="a">Home</a> <a href="b">About</a></div><div><h1>Title</h1><p>{long}</p><p>{long}</p><p>Short.</p><p>{long}</p></div><div class="related">More</div>'))
    assert text.count("A sentence") == 9 and "Short." in text and "More" not in text


def test_a_huge_block_raises_no_limit():
    blocks = [f"Paragraph {i} says a thing or two. " * 9 for i in range(8)]
    blocks[4] = "One block that goes on and on. " * 700
    gap = "".join(f"<p>{i}</p>" for i in range(6))
    text = html.main_text(page("".join(f"<p>{b}</p>" for b in blocks) + gap + "<p>A short section behind the gap, which still belongs to the text of this very page.</p>"))
    assert text.split("\n") == [b.strip() for b in blocks] + [str(i) for i in range(6)] + ["A short section behind the gap, which still belongs to the text of this very page."]


def test_cards_beside_the_story_do_not_replace_it():
    story = [f"Paragraph {i} of the story says a thing or two about it." for i in range(6)]
    told = "".join(f"<p>{p}</p>" for p in story)
    for card in ('<article class="teaser"><p>Another story.</p></article>', "<main><p>Another story.</p></main>"):
        assert html.main_text(page(f"<nav>Menu</nav><div>{told}</div>{card}")).split("\n") == [*story, "Another story."]
    # Lines far from any surge go, whether a main part is declared or not.
    far = "".join("<div>x</div>" for _ in range(9))
    for tag in ("div", "article", "main"):
        text = html.main_text(page(f"{far}<{tag}>{told}</{tag}>{far}")).split("\n")
        assert [t for t in text if t != "x"] == story and len(text) <= len(story) + 4


def test_wrappers_whose_names_speak_of_furniture():
    told = [f"Paragraph {i} of the story says a thing or two about it." for i in range(6)]
    story = "".join(f"<p>{p}</p>" for p in told)
    names = ("has-sidebar", "content no-sidebar", "post related-topics", "article-share-layout", "main search-page", "ad-free", "form-of-government", "widget")
    for name in names:
        for inner in (story, f"<article>{story}</article>"):
            text = html.main_text(page(f'<nav>Menu</nav><div class="{name}">{inner}<div class="ad">Buy this now</div></div><div class="cookie-notice">We use cookies</div>'))
            assert text.split("\n") == told, name


def test_comments_longer_than_the_story_go():
    remark = "".join(f"<p>Remark {i} that goes on for quite some time about nothing.</p>" for i in range(20))
    for name in ("comments", "disqus_thread", "comment-list"):
        for tag in ("div", "article"):
            assert html.main_text(page(f'<{tag}><p>The story is told in one line.</p></{tag}><section id="{name}"><article>{remark}</article></section>')) == "The story is told in one line."


def test_generated_pages_without_article_elements(spark):
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(100).collect():
        plain = re.sub(r"(</?)article\b", r"\1div", r["html"])
        # Short lines before the first surge are all that the declared part adds.
        with_part, without = html.main_text(r["html"]), html.main_text(plain)
        assert without in with_part and len(without) >= 0.99 * len(with_part) - 30


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", "plain & text"), (4, "u", "<div><div><p>" * 3_000 + "deep"), (5, "u", "<script>only"), (5, "u", "<!-- no end"), (6, "u", "a < b <p>c")]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = [(r["page_id"], r["text"]) for r in html.extract(frame).collect()]
    assert got == [(1, ""), (2, ""), (None, "x"), (3, "plain & text"), (4, "deep"), (5, ""), (5, ""), (6, "a < b\nc")]
    assert html.extract(frame.limit(0)).count() == 0


def test_perplexity_parts_clean_from_noise(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    out = ngram.judged(documents, labels).select("row.doc_id", "kept", "perplexity").join(labels, "doc_id").collect()
    good = [r for r in out if r["quality"] == 1 and not r["toxic"]]
    assert sum(r["kept"] for r in good) >= 0.97 * len(good)
    bad = [r for r in out if r["quality"] == 0]
    assert sum(not r["kept"] for r in bad) >= 0.85 * len(bad)


def shuffled(rng, text):
    return " ".join("".join(rng.permutation(list(w))) for w in text.split(" "))


def prose(rng, first, n, words=120):
    """Texts of words of three to seven letters, each from 60 words of 20 letters from code point `first` on."""
    known = ["".join(chr(first + c) for c in rng.integers(0, 20, rng.integers(3, 8))) for _ in range(60)]
    return [" ".join(known[i] for i in rng.integers(0, 60, words)) for _ in range(n)]


def test_shuffled_letters_beyond_latin_are_no_prose(spark):
    rng = np.random.default_rng(1)
    texts = prose(rng, 0x430, 90)
    texts[60:75] = [shuffled(rng, t) for t in texts[60:75]]
    docs = spark.createDataFrame([(i, "ru", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    kept = {r["row"]["doc_id"]: r["kept"] for r in ngram.judged(docs, labels).collect()}
    assert all(kept[i] for i in range(60)) and not any(kept[i] for i in range(60, 75)) and all(kept[i] for i in range(75, 90))


def test_every_language_has_its_model_and_threshold(spark):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for k in range(18):
        texts = prose(rng, 0x4E00 + 20 * k, 30 if k < 17 else 5, 200 - 5 * k)
        for j, t in enumerate([*texts, shuffled(rng, texts[0])]):
            rows.append((1000 * k + j, f"l{k:02}", t))
            labels += [(rows[-1][0], 1, 0)] if j < 25 else []
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    out = ngram.judged(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    by_lang = {}
    for r in out:
        by_lang.setdefault(r["row"]["lang"], []).append(r)
    assert len({r["threshold"] for r in out}) == 18
    for lang, found in by_lang.items():
        # The language with five trusted documents takes model and threshold from all of them.
        if lang != "l17":
            assert [r["row"]["doc_id"] % 1000 for r in found if not r["kept"]] == [30]


def test_raw_model_equals_plain_kneser_ney(spark):
    from collections import Counter

    texts = ["ёж ёжик жук", "жук 日本 日本語 abc", "ab ab ёж"]
    grams = Counter(f"   {t} "[i : i + 4] for t in texts for i in range(len(t) + 1))
    asked = sorted({*grams, "zzzz", "本語ёz", "本語ёж"})
    counts = spark.createDataFrame([("x", g, n) for g, n in grams.items()], "model string, gram string, n long")
    got = ngram.probabilities(counts, spark.createDataFrame([("x", g) for g in asked], "model string, gram string")).collect()
    tables = {4: grams}
    for k in (3, 2, 1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])

    def p(gram):
        if not gram:
            return 1 / 0x110000
        c = tables[len(gram)]
        n = Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2])
        off = [min(max(m - (m + 1) * y * n[m + 1] / n[m] if n[m] else 0.5 * m, 0.1 * m), 0.9 * m) for m in (1, 2, 3)]
        same = {g: v for g, v in c.items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        rest = sum(off[min(v, 3) - 1] for v in same.values())
        return (max(c[gram] - off[min(c[gram], 3) - 1], 0) if c[gram] else 0) / sum(same.values()) + rest / sum(same.values()) * p(gram[1:])

    assert len(got) == len(set(asked))
    for r in got:
        assert abs(r["logp"] - np.log2(p(r["gram"]))) < 1e-4


def test_odd_rows_are_judged(odd_docs, labels):
    for marks in (labels, labels.limit(0)):
        rows = ngram.judged(odd_docs, marks).collect()
        assert len(rows) == odd_docs.count()
        for r in rows:
            if not r["row"]["text"]:
                assert not r["kept"] and r["perplexity"] is None
    assert ngram.judged(odd_docs.limit(0), labels).count() == 0


def test_labels_with_nulls(spark):
    labels = spark.createDataFrame([(None, 1, 0), (1, 1, None), (2, 1, 1), (3, 1, 0), (3, 0, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    assert [r["doc_id"] for r in ngram.trusted_ids(labels).collect()] == [1]
