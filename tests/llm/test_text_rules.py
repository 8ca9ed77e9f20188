"""Language identification, quality rules, decontamination and HTML extraction."""

import collections
import random
import re

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millwright.llm import decontam, html_extract, language_id, quality_rules
from millwright.llm.oracles import ORACLES
from tests.llm.helpers import WORD, awkward_texts, documents, rows_of

SF = "/root/testdata/sf0.001"


def test_languages_are_told_apart(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    unseen = [r for r in got if r.held_out and r.lang]
    assert len(unseen) > 20
    assert sum(r.lang_pred == r.lang for r in unseen) / len(unseen) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_training_leaves_out_held_out_and_unlabelled_rows(spark):
    import zlib

    docs = spark.range(200).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 5 != 0, F.when(F.col("id") % 2 == 0, "aa").otherwise("bb")).alias("lang"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"),
    )
    sample = language_id.training_sample(docs, per_language=1000).collect()
    want = {f"text {i}" for i in range(200) if i % 5 and zlib.crc32(str(i).encode()) % 4 != 2}
    assert {r["text"] for r in sample} == want
    few = language_id.training_sample(docs, per_language=7).groupBy("lang").count().collect()
    assert {r["count"] for r in few} == {7}


def test_language_of_odd_texts(spark):
    model = language_id.fit([("aa", "papa papapa papa"), ("bb", "zuzu zuzuzu")] * 3)
    texts = [None, "", "12 34!", "papa", "ZUZU zuzu", "papa " * 300_000, "ЖЖЖ"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(documents(spark, texts), model).collect()}
    assert [got[i] for i in range(3)] == [("und", 0.0)] * 3
    assert [got[i][0] for i in (3, 4, 5)] == ["aa", "bb", "aa"]
    kept = language_id.supported(documents(spark, texts).select("doc_id", "text"), model)
    assert {r.doc_id for r in kept.collect()} == {3, 4, 5}
    nothing = language_id.fit([])
    assert {r.lang_pred for r in language_id.predict(documents(spark, texts), nothing).collect()} == {"und"}
    assert language_id.predict(documents(spark, texts).limit(0), model).count() == 0


def test_unlearned_languages_and_gibberish_are_not_supported(spark):
    rng = random.Random(4)
    docs = spark.read.parquet(f"{SF[:-3]}01/documents.parquet").select("doc_id", "text", "lang")
    for left_out in ("fr", "de"):
        unlabelled = F.when(F.col("lang") != left_out, F.col("lang")).alias("lang")
        model = language_id.train(docs.select("doc_id", "text", unlabelled))
        kept = {r.doc_id for r in language_id.supported(docs, model).collect()}
        rows = docs.collect()
        others = [r for r in rows if r.lang == left_out]
        learned = [r for r in rows if r.lang != left_out]
        assert sum(r.doc_id in kept for r in others) < 0.1 * len(others)
        assert sum(r.doc_id in kept for r in learned) > 0.99 * len(learned)
        consonants = [
            " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(6)) for _ in range(8)) for _ in range(50)
        ]
        assert not model.supported(consonants).any()
        short = [" ".join(r.text.split()[1:4]) for r in learned if len(r.text.split()) > 5]
        assert model.supported(short).mean() > 0.98
        halves = [learned[k].text[:900] + " " + learned[-k].text[:900] for k in range(1, 60)]
        assert model.supported(halves).mean() > 0.95


def test_all_languages_are_learned(spark):
    rng = random.Random(5)
    rows = []
    for k in range(80):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(40)]
        # The last ones are the rarest, and in a script of their own.
        words = [w.translate({c: c + 0x3D0 for c in range(97, 123)}) for w in words] if k > 76 else words
        for _ in range(12 if k < 70 else 8):
            rows.append((len(rows), f"l{k:02d}", " ".join(rng.choice(words) for _ in range(60))))
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    model = language_id.train(docs)
    assert len(model.languages) == 80
    got = {r.doc_id: r.lang_pred for r in language_id.predict(docs, model).collect()}
    assert sum(got[i] == lang for i, lang, _ in rows) > 0.98 * len(rows)
    kept = {r.doc_id for r in language_id.supported(docs, model).collect()}
    assert sum(i in kept for i, _, _ in rows) > 0.98 * len(rows)


def measures_by_brute_force(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {
        i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)
    }
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def test_quality_measures(spark):
    rng = random.Random(3)
    texts = [*awkward_texts(), *(" ".join(rng.choice("abc") for _ in range(60)) for _ in range(20))]
    texts += ["a b c d e a b c d e", "a b c d e f a b c d e", "l\nl\n m\nl", "# $ %" * 9]
    rows = quality_rules.apply_policy(quality_rules.ledger(documents(spark, texts)))
    want = []
    for i, text in enumerate(texts):
        own = measures_by_brute_force(text)
        want.append((i, *own, own[0] < 10 or 100 * own[4] > 20 * own[0]))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert rows_of(rows, "doc_id", *columns, "base_failed") == sorted(want, key=repr)
    assert rows.filter("base_failed AND kept").count() == 0
    assert quality_rules.ledger(documents(spark, texts).limit(0)).count() == 0


def test_ablations(spark):
    rows = spark.createDataFrame([(0,), (1,), (1,), (4,), (5,), (32,)], "failed bigint")
    got = {(r.version, r.rule): (r.failing, r.kept_without) for r in quality_rules.ablations(rows).collect()}
    assert got["base", "too_few_words"] == (3, 3)
    assert got["v1", "too_few_words"] == (3, 2)
    assert got["v1", "symbols"] == (2, 1)
    assert got["v2", "long_words"] == (1, 1)
    assert ("base", "symbols") not in got


def contained_by_brute_force(texts, items, size=5, threshold=0.8):
    def shingles(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}

    own = [shingles(t) for t in texts]
    return {
        (i, d, len(s), len(s & have))
        for i, s in ((i, shingles(t)) for i, t in items)
        for d, have in enumerate(own)
        if s and len(s & have) >= threshold * len(s) - 1e-9
    }


@pytest.mark.parametrize("block_bytes", [8_000_000, 900])
def test_contained_items(spark, block_bytes):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(n))) for i, n in enumerate((5, 6, 9, 14, 30, 31, 70))]
    items += [(7, None), (8, ""), (9, "too short"), (10, items[3][1])]
    texts = [*awkward_texts(n=10), "too short", *[t for _, t in items]]
    for _, item in items[:7]:
        own = item.split()
        for cut in (0, 1, 2, 4, 8):
            filler = [rng.choice(words) for _ in range(rng.choice((0, 50, 3000)))]
            texts.append(" ".join([*filler, *own[: len(own) - cut], *filler]).upper())
            changed = [*own]
            changed[len(own) // 2] = "changed"
            texts.append(" ".join([*changed, "and", "more"]))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit("x"))
    docs = documents(spark, texts)
    got = decontam.contained_items(docs, benchmark, block_bytes=block_bytes)
    want = contained_by_brute_force(texts, items)
    assert {tuple(r) for r in got.collect()} == want
    assert len(want) > 20
    kept = decontam.without_items(docs, benchmark, block_bytes=block_bytes)
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for _, d, *_ in want}
    assert decontam.contained_items(docs.limit(0), benchmark).count() == 0
    assert decontam.contained_items(docs, benchmark.limit(0)).count() == 0
    assert decontam.without_items(docs, benchmark.limit(0)).count() == len(texts)


@pytest.mark.parametrize("block_bytes", [8_000_000, 60])
def test_short_items_and_unspaced_scripts(spark, block_bytes):
    items = ["Answer", "of life", "the answer of life", "什么是人工智能的定义", "日本", "สวัสดี", "one two three four five", "!", None]
    texts = [
        "The answer: of life.", "answers of lifetime", "of the life", "x answer the of life", "问 什么是人工智能的定义呢",
        "什么是人工智能", "日・本", "日x本", "แล้ว สวัสดี ครับ", "ONE two three four five", "one two three four", "!", None,
        "word of\nlife " * 3,
    ]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    docs = documents(spark, texts)
    want = {(0, 0, 1, 1), (1, 0, 1, 1), (2, 0, 1, 1), (0, 3, 1, 1), (1, 3, 1, 1), (3, 4, 6, 6)}
    want |= {(4, 6, 1, 1), (5, 8, 1, 1), (6, 9, 1, 1), (1, 13, 1, 1)}
    got = decontam.contained_items(docs, benchmark, block_bytes=block_bytes, every_item=True)
    assert {tuple(r) for r in got.collect()} == want
    kept = decontam.without_items(docs, benchmark, block_bytes=block_bytes, every_item=True)
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for _, d, *_ in want}
    connection = duckdb.connect()
    connection.register("documents", docs.select("doc_id", "text").toArrow())
    connection.register("benchmark", benchmark.toArrow())
    assert set(connection.sql(ORACLES["op9_decontamination"]).fetchall()) == want


P = "<p>Some words here that make the story long enough to matter for all of us.</p>"
PAGE = (
    "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<header><h1>Site</h1><nav><a href=x>Home page</a></nav></header>"
    "<div class='cookie-banner'><p>We use cookies for you</p></div><!-- <p>no</p> -->"
    f"<article><h1>T &amp; x</h1>{P}<div class=\"ad-slot\">Buy now</div><p>One\n  two <b>three<br>four</p>"
    "<ul><li>first <a href=y>item</a></li><li>second</li></ul><form>Sign up <input></form>end</article>"
    "<div id='comments'><p>I am a reader and have a lot of things to say about it all</p></div>"
    "<aside><p>More of it</p></aside><footer>&copy; us</footer></body></html>"
)


def test_main_text():
    assert html_extract.main_text(PAGE).split("\n") == [
        "T & x", P[3:-4], "One two three four", "first item", "second", "end",
    ]


@pytest.mark.parametrize("size", [0, 499, 500, 5000])
def test_names_count_in_tags_of_any_size(size):
    for tag in (f"<div class='ad' style='{'x' * size}'>", f"<div style='{'x' * size}' id=comments>"):
        page = f"<article>{P}{tag}Buy now and here</div>{P}</article>"
        assert html_extract.main_text(page).split("\n") == [P[3:-4]] * 2


@pytest.mark.parametrize("wrap", ["<div>{}</div>", "<div class=post><div>{}</div></div>", "{}", "<div id=x>{}</div>"])
@pytest.mark.parametrize("advert", ["<div class=ad>{}</div>", "<div class=related><ul><li><a>{}</a></li></ul></div>"])
@pytest.mark.parametrize(("before", "after"), [(30, 300), (300, 30), (30, 30)])
def test_boilerplate_within_plain_elements_does_not_cut_the_article(wrap, advert, before, after):
    first, last = ("one " * before).strip(), ("two " * after).strip()
    inline = advert.format("buy " * 40) * 2
    page = "<html><body><nav><a href=x>Home page</a></nav>{}<footer>us</footer></body></html>"
    text = html_extract.main_text(page.format(wrap.format(f"<p>{first}</p>{inline}<p>{last}</p>")))
    assert text.split("\n") == [first, last]


def test_boilerplate_between_elements_still_ends_a_region():
    words = "of the day " * 10
    page = f"<body><div><p>short one</p></div><div class=ad>{words}</div><div>{P}{P}</div></body>"
    assert html_extract.main_text(page).split("\n") == [P[3:-4]] * 2


@pytest.mark.parametrize("page", ["", "<", "<p", "<!-- x", "<script>a b c", "&am", "<<<>>>", "</p></p>", "<div/>" * 50])
def test_broken_pages_do_not_break(page):
    assert isinstance(html_extract.main_text(page), str)


def test_cut_off_pages_keep_their_text():
    whole = html_extract.main_text(PAGE).replace("\n", " ")
    for end in range(PAGE.index("<article>") + 60, PAGE.index("<form>"), 7):
        cut = html_extract.main_text(PAGE[:end]).replace("\n", " ")
        assert whole.startswith(cut.rstrip("&amp;< ")[:40])


def test_best_run():
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.randint(-3, 3) for _ in range(rng.randint(0, 12))]
        best = max([0] + [sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)])
        start, end = html_extract.best_run(scores)
        assert sum(scores[start:end]) == best


def test_extract_in_spark(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "")], "page_id bigint, url string, html string"
    ).withColumn("text", F.lit("clash"))
    got = html_extract.extract(pages)
    text = html_extract.main_text(PAGE)
    assert rows_of(got, "page_id", "url", "text", "n_chars") == sorted(
        [(1, "u", text, len(text))] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=repr
    )
    assert html_extract.extract(pages.limit(0)).count() == 0


# --- cases of the page extraction, each with its article around it ---------------------------

PARAGRAPHS = "<p>one two three four five six seven eight nine ten</p>" * 6


def links(n):
    return "<ul>" + '<li><a href="/x">Home</a></li>' * n + "</ul>"


@pytest.mark.parametrize(
    "html",
    [
        f"<article>{PARAGRAPHS}<p>the <span>KEEPME</span> word</p>{PARAGRAPHS}</article>",
        "<article>" + "<p><span>KEEPME words of the article</span></p>" * 5 + "</article>",
        f"<body><nav>{links(5)}</nav><section><h2>KEEPME</h2>{PARAGRAPHS}</section></body>",
        f'<div class="site-content"><p>KEEPME</p>{PARAGRAPHS}</div>',
        f'<body class="site"><p>KEEPME</p>{PARAGRAPHS}</body>',
        f"<article>{PARAGRAPHS}</article><nav>{links(200)}</nav><article><p>KEEPME</p>{PARAGRAPHS}</article>",
        f"<article>{PARAGRAPHS}<p>sum <math><mi>KEEPME</mi></math></p>{PARAGRAPHS}</article>",
        f"<article>{PARAGRAPHS}<a href=/a/>KEEPME</a>{PARAGRAPHS}</article>",
        f"<article>{PARAGRAPHS}<div/><p>KEEPME</p>{PARAGRAPHS}</article>",
        *[
            f'<article>{PARAGRAPHS}<p class="{name}">KEEPME</p>{PARAGRAPHS}</article>'
            for name in (
                "share-price", "story-date", "text-widget", "article-tags", "post-meta", "author-bio",
                "social-issues", "related-work", "footer-note", "alert", "date",
            )
        ],
    ],
)
def test_what_stands_in_neutral_elements_is_kept(html):
    assert "KEEPME" in html_extract.main_text(html)


@pytest.mark.parametrize(
    "noise",
    [
        "<script src=/a/>DROPME</script>", "<script/>DROPME</script>", "<button>DROPME</button>",
        "<label>DROPME</label>", "<select><option>DROPME</select>", "<p hidden>DROPME</p>",
        '<div aria-hidden="true"><p>DROPME</p></div>', "<p style='display: none'>DROPME</p>",
        "<nav><p>DROPME</p></nav>", "<aside><p>DROPME</p></aside>", "<form><p>DROPME</p></form>",
        "<footer><p>DROPME</p></footer>",
        *[
            f'<div class="{name}">DROPME here and there</div>'
            for name in (
                "ad", "sidebar", "comments", "comment-list", "comment-section", "blog-comments",
                "cookie-notice", "related-posts", "newsletter-signup", "share-buttons", "site-footer",
                "my-ad-slot", "promo big",
            )
        ],
    ],
)
def test_boilerplate_is_dropped_inside_and_beside_the_article(noise):
    inside = html_extract.main_text(f"<article>{PARAGRAPHS}{noise}{PARAGRAPHS}</article>")
    beside = html_extract.main_text(f"<body>{noise}<div><div>{PARAGRAPHS}</div></div>{noise}</body>")
    assert "DROPME" not in inside and "DROPME" not in beside
    assert inside.count("ten") == 12 and beside.count("ten") == 6


def test_neutral_elements_have_no_weight_and_single_parts_do_not_decide():
    weights = html_extract.default_weights()
    for tag in ("div", "span", "section", "p", "ul", "li", "a"):
        assert f"{tag}@out" not in weights.words
        assert weights.element(tag, "", True)[1] is False
    for name in ("unknown", "x-share", "x-related", "x-footer", "x-story", "x-widget"):
        assert not weights.element("div", name, True)[1]


@pytest.mark.parametrize("part", ["<font>x", "<div>", "<div class=ad>y", "</p><hr>", "<li>a</b>", "<dt>a<span>"])
def test_deep_pages_take_time_in_proportion(part):
    """A hundred thousand open elements: no token looks through all of them."""
    import time

    def seconds(n):
        started = time.perf_counter()
        html_extract.main_text(part * n)
        return time.perf_counter() - started

    seconds(1000)
    small = min(seconds(10_000) for _ in range(2))
    assert seconds(100_000) < 30 * small + 1


def tried_run(scores):
    """The run with the largest sum by trying all of them; the first and shortest of equals."""
    sums = {(a, b): sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)}
    return max([(0, 0), *sums], key=lambda r: sums.get(r, 0.0))


def test_extraction_equals_the_best_of_all_runs(monkeypatch):
    """The whole operator with every run tried instead of the linear scan."""
    pages = pq.read_table(f"{SF}/pages.parquet")["html"].to_pylist()
    short = [p[:1500] for p in pages[:25]] + [p[-900:] for p in pages[:25]]
    want = [html_extract.main_text(p) for p in short]
    scored = []

    def tried(scores):
        best = html_extract_best(scores)
        run = tried_run([round(s, 9) for s in scores])
        total = sum(scores[slice(*run)])
        assert abs(sum(scores[slice(*best)]) - total) < 1e-6
        scored.append(total)
        return run

    html_extract_best = html_extract.best_run
    monkeypatch.setattr(html_extract, "best_run", tried)
    got = [html_extract.main_text(p) for p in short]
    assert len(scored) == 50
    assert sum(a == b for a, b in zip(got, want, strict=True)) == 50
