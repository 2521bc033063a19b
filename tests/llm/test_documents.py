"""Operators 1, 3, 4, 6, 8 and 9 against brute force, fixtures and held-out accuracy."""

import itertools
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from repledger.llm import extract, fingerprint, language, licences, mixing, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    seen = Counter(windows)
    gone = {k + j for k, x in enumerate(windows) if seen[x] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(gone) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(gone), failed)


def test_quality(nasty, none):
    rows = nasty.collect()
    got = quality.judge(nasty).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    key = lambda r: (str(r[0]), str(r[1]), r[2:])
    want = [(r.doc_id, r.source, *measured(r.text)) for r in rows]
    assert sorted(((r.doc_id, r.source, *(r[c] for c in names)) for r in got), key=key) == sorted(want, key=key)
    failed = defaultdict(list)
    for w in want:
        failed[w[1]].append(w[-1])
    for r in got:
        if r.source is not None:
            assert (r.host_docs, r.host_failed) == (len(failed[r.source]), sum(failed[r.source]))
        else:
            assert r.host_docs == 0 and r.kept == (not r.base_failed)
        assert r.kept == (not r.base_failed and r.host_rate <= quality.HOST_LIMIT)
    assert quality.judge(none).count() == 0


def test_host_rates_are_shrunk_by_what_the_hosts_say(spark):
    unlike = [(f"h{k}", 1000, 900 if k % 4 == 0 else 20) for k in range(40)] + [("tiny", 2, 2)]
    rates = {r.source: r.host_rate for r in quality.host_rates(
        spark.createDataFrame(unlike, "source string, n_docs long, n_failed long")).collect()}
    assert rates["h0"] > 0.85 and rates["h1"] < 0.03 and 0.3 < rates["tiny"] < 0.95
    rng = np.random.default_rng(0)
    equal = [(f"h{k}", 50, int(rng.binomial(50, 0.2))) for k in range(200)] + [("tiny", 2, 2)]
    rates = {r.source: r.host_rate for r in quality.host_rates(
        spark.createDataFrame(equal, "source string, n_docs long, n_failed long")).collect()}
    assert max(rates.values()) < 0.35 and min(rates.values()) > 0.1


def test_hosts_of_any_size(spark):
    hosts = spark.createDataFrame([("a", 2_500_000_000, 10**9), ("b", 3_000_000_000, 10**9), ("c", 9 * 10**18 // 10**6, 5)],
                                  "source string, n_docs long, n_failed long")
    assert all(0 <= r.host_rate <= 1 for r in quality.host_rates(hosts).collect())


def test_bad_host_is_turned_away(spark):
    good = " ".join(f"word{k}" for k in range(30))
    rows = [(k, good, f"good{k % 9}") for k in range(200)] + [(1000 + k, good if k % 10 == 0 else "short", "bad") for k in range(100)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(r.kept == (r.source != "bad") for r in got)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>not text</p>";</script></head><body>
<header><a href="/">Site name</a></header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><div id="sidebarLeft"><p>Popular things on this page and more of them</div>
<article class="post"><h1>A &amp; B</h1><p>First   para&shy;graph with <b>bold</b>text.<br>Next<!-- no --> line
<p>Ok.</p><aside>Aside</aside><form><input value=1>Name <button>Go</button></form><div class="ad">Buy</div>
<table><tr><td>x</td><td>y</td></tr></table><p>Last &lt;one&gt;.</article>
<section class="comments"><article><p>I think this is a long comment, and it says many things about the page.</article></section>
<footer>&copy; Us</footer></body></html>"""


def test_extract(spark, none):
    long = "".join(f"<p>Paragraph {k} has some words in it.</p>" for k in range(3000))
    rows = [(1, "u", PAGE), (2, None, None), (3, "", ""), (4, "u", "no markup at all"), (5, "u", f"<main>{long}</main><nav>x</nav>"),
            (1, "u", PAGE), (None, None, "<p>a<p>b"), (7, "u", "<div><div><ul><li><a>x</a><li><a>y</a></ul></div><div>" + "".join(
                f"<p>This paragraph, number {k}, is prose of some length and so is content.</p>" for k in range(5)) + "<p>End.</p></div></div>"),
            (8, "u", "<article>cut off <b>here &am"), (9, "u", "<nav><article><p>Unclosed menu</article>"), (10, "u", "< <>< &#0;&bogus; </")]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, blocks string")
    got = extract.extract(pages).collect()
    text = {(r.page_id, r.url): r.text for r in got}
    assert len(got) == len(rows) and sum(r.page_id == 1 for r in got) == 2
    assert text[1, "u"] == "A & B First para­graph with boldtext. Next line Ok. x y Last <one>."
    assert text[2, None] == text[3, ""] == "" and text[4, "u"] == "no markup at all"
    assert text[5, "u"].startswith("Paragraph 0 has") and text[5, "u"].endswith("Paragraph 2999 has some words in it.")
    assert text[None, None] == "a b"
    assert text[7, "u"].startswith("This paragraph, number 0") and text[7, "u"].endswith("End.")
    assert text[8, "u"].startswith("cut off here") and text[9, "u"] == "Unclosed menu"
    assert extract.extract(pages.where("false")).count() == 0


def test_extract_of_all_sample_pages(sample):
    def article(html):
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", html, re.S)[1]
        import html as h
        return " ".join(h.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|br|h1)>", " ", body))).split())

    pages = sample("pages")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in extract.extract(pages).collect()} == want


@pytest.mark.parametrize("page", [
    "<div class='layout has-sidebar'><article><p>The whole story.</p></article></div>",
    "<article class='post comments-open'><p>The whole story.</p></article>",
    "<div id='share-your-story'><p>The whole story.</p></div>",
    "<main class='site-main no-ads with-nav'><p>The whole story.</p></main>",
    "<div class='sidebarVisible'><main id='menu-free'><p>The whole story.</p></main></div>"])
def test_names_do_not_hide_the_article(page):
    around = "<html><body><nav>Menu</nav>" + page + "<div class='site-footer'>About</div><div class='ad-slot-top'>Buy</div></body></html>"
    assert extract.blocks(around) == ["The whole story."]


@pytest.mark.parametrize("name", ["sidebar", "site-header-wrapper", "post comment-list", "commentForm", "ad-slot-top", "newsletter-signup", "x related"])
def test_names_still_hide_what_is_around(name):
    assert extract.blocks(f"<body><p>Story one.</p><div class='{name}'><p>Not this.</p></div><p>Story two.</p></body>") == ["Story one.", "Story two."]


def test_ratio_and_threshold_decide_between_regions():
    """Plain containers without a telling name: the one with long lines is the content, link lists are not."""
    story = "".join(f"<p>{'A sentence of the story goes on and on, number %d. ' % k * 6}</p>" for k in range(8))
    links = lambda n: "".join(f"<li><a href='/{k}'><b>go</b> {k}</a></li>" for k in range(n))
    page = f"<body><div><ul>{links(25)}</ul></div><div><h1>Title</h1>{story}<p>End.</p></div><div><ul>{links(25)}</ul></div></body>"
    found = extract.blocks(page)
    assert found[0] == "Title" and found[-1] == "End." and len(found) == 10 and not any(x.startswith("go") for x in found)
    two = f"<body><article><p>go</p><p>on</p></article><ul>{links(9)}</ul><article>{story}</article></body>"
    assert len(extract.blocks(two)) == 8


def test_smoothing_keeps_a_level_line():
    assert np.allclose(extract.smooth(np.full(9, 4.0)), 4.0)
    assert extract.smooth(np.array([0, 0, 9.0, 0, 0])).argmax() == 2


def test_licences(spark, nasty, none):
    mit = dict(licences.TEXTS)["MIT"]
    rows = [(1, "MIT License\n" + mit, "x"), (2, "Copyright (c) 2020 Someone\nAll rights reserved.\n\n" + mit.upper().replace(",", ""), "x"),
            (3, "words\n  Released under the MIT licence  \nThis work is licensed under the GNU General Public License, version 3.\nend", "x"),
            (4, None, "x"), (5, "", "x"), (None, "Licensed under CC BY-NC 4.0.", "x"), (None, "Licensed under CC BY-NC 4.0.", "x"),
            (6, mit + " And more.", "x"), (7, "MIT", "x")]
    got = [tuple(r)[:1] + tuple(r)[2:] for r in licences.scan(
        spark.createDataFrame(rows, "doc_id long, text string, text_digest string")).collect()]
    want = {1: ("MIT", []), 2: ("MIT", []), 3: (None, ["GPL-3.0", "MIT"]), 4: (None, []), 5: (None, []), 6: (None, []), 7: (None, []),
            None: ("CC-BY-NC-4.0", ["CC-BY-NC-4.0"])}
    assert len(got) == len(rows) and all(want[r[0]] == r[1:] for r in got)
    assert licences.scan(nasty).count() == nasty.count() and licences.scan(none).count() == 0
    more = spark.createDataFrame([("own", "Do what you like,\nwith it.")], "license_id string, text string")
    own = licences.scan(spark.createDataFrame([(1, "DO WHAT YOU LIKE with it")], "doc_id long, text string"), more).first()
    assert own.text_license == "own"


def test_notices_in_padded_lines(spark):
    """A ruled or padded line is folded by the canonical form, however long it is; other words still count."""
    notice = "Licensed under the MIT License."
    rows = [(1, f"a\n{'-' * n} {notice} {'=' * n}\nb") for n in (10, 200, 400, 5000)] + [(1, "a\n" + " " * 9000 + notice)]
    rows += [(2, f"a\n{notice} {'word ' * n}\nb") for n in (1, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, tuple(r.line_licenses)) for r in licences.scan(docs).collect()} == {(1, ("MIT",)), (2, ())}


def test_licences_of_whole_files(spark):
    """Licence files with title and copyright line, and published long texts where this system has them."""
    bsd = dict(licences.BSD)
    isc, zlib = dict(licences.TEXTS)["ISC"], dict(licences.TEXTS)["Zlib"]
    rows = [("BSD-2-Clause", bsd["BSD-2-Clause"]), ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, A\n\n" + bsd["BSD-3-Clause"]),
            ("BSD-2-Clause", "  * " + bsd["BSD-2-Clause"].replace("\n\n", "\n\n  * ")), ("ISC", "ISC License\n\nCopyright 2020 A\n\n" + isc),
            ("Zlib", "zlib License\n\n(C) 2020 A\n\n" + zlib), (None, "ISC License\n\n" + zlib), (None, bsd["BSD-2-Clause"] + " More.")]
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
             "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    for name, license_id in names.items():
        file = Path("/usr/share/common-licenses") / name
        if file.exists():
            text = file.read_text(encoding="utf-8")
            rows += [(license_id, text), (license_id, re.sub(r"(?<=\S)[ \t]*\n[ \t]*(?=\S)", " ", text))]
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.text_license for r in licences.scan(docs).collect()}
    assert got == {k: i for k, (i, _) in enumerate(rows)}
    assert {len(d) for ds in licences.DIGESTS.values() for d in ds} == {64}


def test_language_of_held_out_documents(sample):
    docs = sample("documents")
    model = language.fit(docs.where(~language.held_out()))
    found = language.identify(docs, model, keep=True).where(language.held_out())
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.97


def test_letters_of_the_second_plane():
    """Gothic, Deseret, Adlam and mathematical letters are letters; emoji and the planes' last code points are none."""
    texts = ["\U00010330\U00010331", "\U00010400\U00010428 x", "\U0001E900", "\U0001D400", "\U0001F600\uFFFF\U0001FFFF", "\U00020000"]
    assert language.words_of(texts).text_of.tolist() == [0, 1, 1, 2, 3, 5]
    upper, lower = language.words_of(["\U00010400"]), language.words_of(["\U00010428"])
    assert (upper.cells == lower.cells).all()
    model = language.Model(["one two three", "un deux trois"], ["en", "fr"])
    assert [label != "und" for label, _, _ in model.label(texts)] == [True, True, True, True, False, True]


def test_language_spans_and_edges(sample, nasty, none):
    docs = sample("documents").where("lang in ('en', 'fr')")
    model = language.fit(docs)
    by = {r.lang: r.text for r in docs.orderBy(F.length("text"), "doc_id").collect()}
    mixed = by["en"][:400] + "\n" + by["fr"][:900]
    (label, score, spans), empty, none_of = model.label([mixed, "", "123 !?"])
    assert label == "fr" and 0.5 < score < 0.9 and [s["lang"] for s in spans] == ["en", "fr"]
    assert abs(spans[1]["start"] - 400) < 60 and spans[-1]["stop"] <= len(mixed)
    assert empty == none_of == ("und", 0.0, [])
    rows = language.identify(nasty, model).collect()
    texts = {r.doc_id: r.text for r in nasty.collect()}
    assert len(rows) == nasty.count()
    for r in rows:
        if r.doc_id is not None:
            letters = any(c.isalpha() for c in texts[r.doc_id] or "")
            assert (r.lang_pred != "und") == letters and 0 <= r.score <= 1
    assert language.identify(none, model).count() == 0
    blank = language.fit(none)
    assert {r.lang_pred for r in language.identify(nasty, blank).collect()} == {"und"}


def test_viterbi_is_the_best_of_all_paths(sample):
    model = language.fit(sample("documents"))
    rng = np.random.default_rng(3)
    for switch in (0.5, 4.0):
        model.switch = switch
        texts = [" ".join(rng.choice(["the", "der", "les", "que", "und", "of", "est", "ción"], n)) for n in (1, 2, 5, 6, 0, 6)]
        words = language.words_of(texts)
        score, path = model.scores(words), model.paths(words)
        for k in range(len(texts)):
            own = np.flatnonzero(words.text_of == k)

            def worth(p):
                return sum(score[w, x] for w, x in zip(own, p)) - switch * sum(a != b for a, b in zip(p, p[1:]))

            best = max(map(worth, itertools.product(range(len(model.languages)), repeat=len(own))), default=0)
            assert worth(path[own].tolist()) == pytest.approx(best, abs=1e-3)


def test_scripts_narrow_the_candidates():
    model = language.Model(["слово другое слово " * 20, "word other word " * 20], ["ru", "en"])
    (first, _, spans), = model.label(["слово word слово слово"])
    assert first == "ru" and not model.allowed[language._SCRIPT_NAMES.index("cyrillic"), model.languages.index("en")]


def test_edit_likeness(spark, nasty, none):
    rows = sorted(((r.doc_id, r.text) for r in nasty.collect()), key=lambda r: (r[1] is None, r[1] or ""))
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0)))
    rows = [(i, t or "") for i, t in rows]
    got = defaultdict(list)
    for r in fingerprint.edit_likeness(nasty.repartition(7)).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    texts = [t for _, t in rows]
    for k, (i, t) in enumerate(rows):
        following = texts[(k + 1) % len(rows)]
        changed = fingerprint.edited(t, following)
        chunks = fingerprint.chunk_set(t)
        want = (len(t), changed, fingerprint.written(chunks), fingerprint.written(fingerprint.chunk_set(changed)),
                fingerprint.containment(chunks, fingerprint.chunk_set(changed)),
                fingerprint.containment(chunks, fingerprint.chunk_set(following)))
        assert want in [tuple(r)[1:] for r in got[i]], i
    assert fingerprint.edit_likeness(none).count() == 0
    one = spark.createDataFrame([(5, "a text of one document only")], "doc_id long, text string")
    assert fingerprint.edit_likeness(one).first().near_next == 1.0
    assert {r.fingerprint for r in fingerprint.fingerprints(nasty).collect()} == {
        fingerprint.written(fingerprint.chunk_set(t)) for t in texts}


def plain_cuts(data):
    """Ends of chunks byte by byte: a gear hash of the last 32 bytes, each shifted by its distance."""
    table, out, at = [int(x) for x in fingerprint.gear()], [], 0
    for k in range(len(data)):
        h = sum(table[data[k - j]] << j for j in range(min(32, k + 1))) % (1 << 64)
        size, low = k + 1 - at, h % (1 << 37) >> 31  # bits that all of the last 32 bytes reach
        if size >= fingerprint.LEAST and low % 64 == 0 or size >= fingerprint.NORMAL and low % 16 == 0 or size == fingerprint.MOST:
            out.append(k + 1)
            at = k + 1
    return out + ([len(data)] if at < len(data) else [])


def test_chunks_byte_by_byte():
    rng = random.Random(6)
    for n in (0, 1, 8, 9, 40, 3000):
        for alphabet in ("ab", "abcdefgh ijklmnop", "\x00", "é漢字 x"):
            data = "".join(rng.choice(alphabet) for _ in range(n)).encode()
            assert fingerprint.cuts(data) == plain_cuts(data)
    assert (fingerprint.HARD, fingerprint.EASY) == (63 << 31, 15 << 31)


@pytest.mark.parametrize("kind", ["string", "short", "int", "decimal(12,0)", "date"])
def test_ids_of_any_order(spark, kind):
    base = spark.createDataFrame([(k, f"text number {k} " * (k % 7 + 3)) for k in range(90)] + [(None, "no id")], "n long, text string")
    made = F.date_add(F.lit("2020-01-01").cast("date"), F.col("n").cast("int")) if kind == "date" else (
        F.format_string("%03d", "n") if kind == "string" else F.col("n").cast(kind))
    docs = base.select(F.when(F.col("n").isNotNull(), made).alias("doc_id"), "text")
    likeness = {r.fingerprint: (r.near_edited, r.near_next) for r in fingerprint.edit_likeness(docs).collect()}
    plain = {r.fingerprint: (r.near_edited, r.near_next) for r in fingerprint.edit_likeness(base.withColumnRenamed("n", "doc_id")).collect()}
    assert likeness == plain and fingerprint.edit_likeness(docs).schema["doc_id"].dataType == docs.schema["doc_id"].dataType


def test_chunks_shift_with_the_text():
    rng = np.random.default_rng(8)
    text = "".join(rng.choice(list("abcdefghij klmnop"), 30_000))
    whole = fingerprint.chunk_set(text)
    moved = fingerprint.chunk_set("a few words before " + text[5000:])
    assert fingerprint.containment(whole, moved) > 0.97
    assert fingerprint.containment(whole, fingerprint.chunk_set(text[::-1])) < 0.05
    assert (fingerprint.read(fingerprint.written(whole)) == whole).all()
    ends = fingerprint.cuts(text.encode())
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and sizes.max() <= fingerprint.MOST and sizes[:-1].min() >= fingerprint.LEAST


def test_targets():
    weights = mixing.weights_of(["b", None, "a", "c"])
    assert weights == {"a": 5, "b": 2, "c": 1, None: 5}
    sizes = {"a": 10, "b": 1000, "c": 500, None: 5}
    targets = mixing.targets_of(sizes, weights)
    assert targets["a"] == 30 and targets[None] == 15 and sum(targets.values()) == pytest.approx(1515)
    assert targets["b"] == pytest.approx(2 * targets["c"])


def cost(used):
    """Least cost of taking `used` tokens of a pattern that holds `size`, each round dearer than the one before."""
    used, size = used
    return sum((2 * k + 1) * min(size, max(0, used - k * size)) for k in range(mixing.MOST_TIMES))


def test_flow_is_cheapest_among_all():
    rng = np.random.default_rng(6)
    for _ in range(20):
        a, b, ab = (int(x) for x in rng.integers(1, 5, 3))
        qa, qb = int(rng.integers(0, 3 * a + 2)), int(rng.integers(0, 3 * b + 2))
        flow = mixing.min_cost_flow({("a",): a, ("b",): b, ("a", "b"): ab}, {"a": qa, "b": qb})
        best = None
        for x, y in itertools.product(range(3 * ab + 1), repeat=2):  # what the shared pattern gives to a and b
            if x + y <= 3 * ab and x <= qa and y <= qb:
                ga, gb = min(3 * a, qa - x), min(3 * b, qb - y)
                now = (-(x + y + ga + gb), cost((ga, a)) + cost((gb, b)) + cost((x + y, ab)))
                best = now if best is None or now < best else best
        given = defaultdict(float)
        for (p, _), v in flow.items():
            given[p] += v
        sizes = {("a",): a, ("b",): b, ("a", "b"): ab}
        assert (-sum(given.values()), sum(cost((given[p], sizes[p])) for p in sizes)) == pytest.approx(best)


def test_mix(nasty, none):
    docs = nasty.withColumns({"sources": F.array("source"), "size": F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))})
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(3), staged=False).collect()
    key = lambda r: (str(r.doc_id), str(r.text), r.times)
    assert sorted(map(key, rows)) == sorted(map(key, again)) and len(rows) == nasty.count()
    taken, sizes, target, largest = Counter(), Counter(), {}, Counter()
    for r in rows:
        assert r.taken == r.times * r["size"] <= 3 * r["size"]
        s = r.sources[0]
        taken[s] += r.taken
        sizes[s] += r["size"]
        target[s] = r.targets[0]
        largest[s] = max(largest[s], r["size"])
    assert target == pytest.approx(mixing.targets_of(sizes, mixing.weights_of(list(sizes))))
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    assert mixing.mix(none.withColumns({"sources": F.array("source"), "size": F.lit(1)})).count() == 0


def test_mix_of_overlapping_sources(spark):
    rng = np.random.default_rng(1)
    kinds = [["a"], ["b"], ["a", "b"], ["b", "c"], ["c"]]
    rows = [(k, kinds[k % 5], int(rng.integers(1, 200))) for k in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, sources array<string>, size long")
    total = sum(r[2] for r in rows)
    quota = {"a": 0.5 * total, "b": 0.3 * total, "c": 0.2 * total}
    got = mixing.mix(docs, lambda sizes: quota).collect()
    by = Counter()
    for r in got:
        by[tuple(r.sources)] += r.taken
    assert sum(by.values()) == pytest.approx(total, abs=2000)
    assert by["a",] + by["a", "b"] >= quota["a"] - 1000 and by["c",] + by["b", "c"] >= quota["c"] - 1000
    assert max(r.times for r in got) <= 2  # the shared documents fill what single sources lack
