"""Operators that judge or change single rows."""

import hashlib
import re
from collections import Counter

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from glossweave.llm import html_main, licences, pii, quality
from glossweave.llm.common import smallest_hashes
from glossweave.llm.html_main import extract_text, main_container, main_texts, parse_page
from glossweave.llm.licences import KNOWN_TEXTS, SCAN_SQL, known_digests, licence_scan
from glossweave.llm.toxicity import best_limit, learn, score, toxicity

DOCS = "doc_id bigint, text string"
SMALL = "/root/testdata/sf0.001"
MODEL = f"{quality.TOKENIZERS}/piece_bpe_32k.model"


def small_texts():
    return pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()


def brute_quality(text):
    found = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = Counter(zip(found, found[1:], found[2:], strict=False))
    inside = {k + d for k, w in enumerate(zip(found, found[1:], found[2:], strict=False)) if windows[w] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_quality_figures_equal_brute_force(spark):
    texts = [(r["doc_id"], r["text"], r["lang"]) for r in small_texts()]
    odd = ["", None, " \t\n", "a b c a b c a b c", "x\x85y\xa0z \x1c w", "é é é é", "wörter 😀 " * 40, "#*$%&|<>", "l\nl\n l\n\n\nl", "q " * 40_000, "a " * 3 + "b"]
    rows = texts + [(10_000 + k, t, None if k % 2 else "xx") for k, t in enumerate(odd)] + [(None, texts[0][1], "en"), texts[0]]
    docs = spark.createDataFrame([(*r, "z") for r in rows], DOCS + ", lang string, kept string")
    got = quality.quality_rules(docs, prefix="q_").collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    seen = sorted(str((r["doc_id"], *[r["q_" + n] for n in names], r["q_base_failed"])) for r in got)
    want = [(i, *(f := brute_quality(t)), f[0] < 50 or 100 * f[4] > 50 * f[0]) for i, t, _ in rows]
    assert seen == sorted(map(str, want))
    assert not any(r["q_kept"] and r["q_base_failed"] for r in got)
    assert quality.quality_rules(docs.limit(0)).count() == 0


def test_word_pieces_are_those_of_the_model():
    pieces = quality.WordPieces(MODEL)
    words = [b"hello", "größe".encode(), "😀".encode(), b"hello"]
    assert [len(pieces.pieces[i]) // 4 for i in pieces.numbers(words)] == [len(pieces.processor.encode(w.decode())) for w in words]
    assert quality.script_of("привет".encode()) == "cyrillic" and quality.script_of(b"12") == "none"


def test_quality_keeps_clean_and_rejects_junk(spark):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["kept"], r["base_failed"], labels.get(r["doc_id"])) for r in quality.quality_rules(docs, columns=["doc_id"]).collect()]
    clean = [kept for kept, failed, good in rows if good == 1 and not failed]
    junk = [kept for kept, _, good in rows if good == 0]
    assert sum(clean) >= 0.98 * len(clean) and sum(junk) < 0.6 * len(junk)


def test_bands_equal_sorted_lists_and_fall_back(spark):
    import random

    import numpy as np

    rng = random.Random(3)
    rows = [(rng.choice(["en"] * 8 + ["de", "xx"]), "latin", rng.choice([6] * 9 + [12]), *[rng.uniform(0, 5) for _ in range(3)], rng.random() < 0.1) for _ in range(700)]
    rows += [("ru", "cyrillic", 6, 2.0, 0.1, 0.9, False)] * 5 + [("el", "greek", 20, 2.0, 0.1, 0.9, False)]
    frame = spark.createDataFrame(rows, "language string, script string, length_class int, chars_per_token double, byte_share double, token_entropy double, base_failed boolean")
    got = {tuple(r)[:3]: r for r in quality.class_bands(frame, 3.0).collect()}
    assert got == {tuple(r)[:3]: r for r in quality.class_bands(frame.repartition(9, "byte_share"), 3.0).collect()}
    sound = [r for r in rows if not r[6]]
    assert set(got) == {r[:3] for r in sound}
    for own, r in got.items():
        for k, name in enumerate(quality.BANDED):
            want = None
            for keys in quality.LEVELS[name]:
                places = [quality.CLASS.index(c) for c in keys]
                values = [round(x[3 + k], 4) for x in sound if all(x[p] == own[p] for p in places)]
                if len(values) >= quality.MIN_SUPPORT:
                    low, high = np.percentile(values, [25, 75])
                    reach = 3 * max(high - low, quality.LEAST_REACH[name])
                    want = (low - reach, high + reach)
                    break
            assert (r[name] is None) == (want is None) and (want is None or np.allclose(tuple(r[name]), want))
    assert got["el", "greek", 20]["token_entropy"] is None and got["el", "greek", 20]["byte_share"] is not None


def test_a_rare_language_is_judged_by_its_script(spark):
    clean = [(r["doc_id"], r["text"], "en") for r in small_texts() if r["lang"] == "en"]
    odd = [(9000, " ".join(f"q{j}x7z{j * 37}k9" for j in range(60)), "zz"), (9001, clean[0][1], "yy")]
    rows = {r["doc_id"]: r for r in quality.quality_rules(spark.createDataFrame(clean + odd, DOCS + ", lang string")).collect()}
    assert not rows[9000]["base_failed"] and not rows[9000]["kept"] and rows[9001]["kept"] == rows[clean[0][0]]["kept"]


PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and pii.luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def brute_spans(text):
    return [(kind, m.start(), m.end()) for kind, pattern, good in PATTERNS for m in re.finditer(pattern, text) if good(m[0])]


def test_base_spans_equal_the_patterns():
    import random

    rng = random.Random(0)
    texts = ["".join(rng.choice("ab@.+-1 2(9)%_\né") for _ in range(rng.randrange(70))) for _ in range(20_000)]
    texts += ["1" * 5000, "1.2.3.4.5.6.7.8", "a@b.c@d.e", "4242424242424242", "+1 (988) 555-2485 +49 30", "999.1.1.1 01.002.3.255"]
    assert all(pii.base_spans(t) == brute_spans(t) for t in texts)


def test_personal_data_adds_and_never_loses(spark):
    rows = [(r["doc_id"], r["text"]) for r in small_texts()] + [(9001, None), (9002, ""), (None, "a@b.cc"), (9003, "1 " * 30_000)]
    got = pii.personal_data(spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", spans int")).collect()
    assert len(got) == len(rows)
    want = Counter()
    for i, t in rows:
        spans = brute_spans(t or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want[i, tuple(sum(s[0] == k for s in spans) for k in pii.KINDS), hashlib.sha256(joined.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], tuple(r[f"n_{k}"] for k in pii.KINDS), r["base_sha256"]) for r in got) == want
    texts = dict(rows)
    for r in got:
        assert {f"{k}:{a}:{b}" for k, a, b in brute_spans(texts[r["doc_id"]] or "")} <= set(filter(None, r["spans"].split(",")))
    assert pii.personal_data(spark.createDataFrame([], DOCS)).count() == 0


def test_samples_do_not_depend_on_order_or_size(spark, monkeypatch):
    docs = spark.createDataFrame([(r["doc_id"], r["text"] + f" mail u{k}@h.com, u{k}@h.com") for k, r in enumerate(small_texts())], DOCS)
    turned = docs.repartition(7, F.reverse("text")).sortWithinPartitions(F.desc("doc_id"))
    monkeypatch.setattr(pii, "FIT_DOCS", 60)
    monkeypatch.setattr(pii, "FIT_TOKENS", 50)
    rows = pii.fit_rows(docs, "doc_id", "text")
    assert len(rows) == 50 and rows == pii.fit_rows(turned, "doc_id", "text")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("odd"))
    one, two = learn(docs, labels, ["odd"], bound=40), learn(turned, labels.repartition(5), ["odd"], bound=40)
    assert one.words == two.words and one.limits == two.limits and all((a[0] == b[0]).all() and a[2] == b[2] for a, b in zip(one.models, two.models, strict=True))
    for share in (20_000 / 1e11, 1e-15, 0.3, 1.0, 7.0):
        taken = spark.range(100_000).filter(smallest_hashes(share, F.col("id"))).count()
        assert abs(taken - 100_000 * min(share, 1)) < 1_000
    tiny = spark.range(5).filter(smallest_hashes(20_000 / 1e11, F.col("id")))
    assert "xxhash64" in tiny._jdf.queryExecution().optimizedPlan().toString()


def test_similar_tokens_pull_each_other():
    train = []
    for k in range(300):
        text = f"mail u{k}@h.com then n{k} x{k} and again u{k}@h.com or 10.0.{k % 256}.1"
        spans, features, chain, skip = pii.token_graph(text)
        labels = pii.token_labels(spans, pii.base_spans(text))
        beside = [[-1, -1, -1] for _ in spans]
        for a, b in chain:
            beside[b][0], beside[a][1] = labels[a], labels[b]
        for a, b in skip:
            beside[a][2], beside[b][2] = labels[b], labels[a]
        train += [(f, y, *o) for f, y, o in zip(features, labels, beside, strict=True)]
    weights = pii.fit(train)

    def chance(text):
        import numpy as np

        spans, features, chain, skip = pii.token_graph(text)
        pair = np.stack([weights.chain] * len(chain) + [weights.skip] * len(skip)) if chain or skip else np.zeros((0, 5, 5))
        node = np.array([weights.node[f].sum(axis=0) for f in features])
        return pii.marginals(node, np.array(chain + skip).reshape(-1, 2), pair)[-1, 1]

    assert chance("far u9@h.com away in words u9@h") > chance("far away in words u9@h")
    assert pii.token_graph("u9@h.com x " * 50)[3] == [(k, k + 1) for k in range(49)]


SHELL = (
    "<!DOCTYPE html><html><head><title>T</title><script>var a='</p><article>';</script></head><body><nav><a href='/'>Home</a></nav>"
    "<div class='ad'>Buy now</div>{body}<section id='comments'><article><p>reader says</p></article></section>"
    "<form><input><button>Send</button></form><aside>More</aside><footer>&copy; host</footer>"
)


def test_main_text_of_an_article(spark):
    body = "<article><h1>T &amp; U</h1><p><b>one\n two<br><p>A&nbsp;<i>B</i>&lt;p&gt; &#233;<p></p><ul><li>x<li>y</ul><div class='share'>Share</div></article>"
    rows = [(k, f"http://h{k % 2}.x/{k}", SHELL.format(body=body.replace("one", f"one{k}"))) for k in range(8)]
    rows += [(20, None, None), (21, "bad", ""), (22, "http://solo/", "<p>alone <b>text"), (20, None, None), (23, "http://h1.x/q", "plain > text & <")]
    pages = spark.createDataFrame([(*r, 7) for r in rows], "page_id bigint, url string, html string, main int")
    got = {r["page_id"]: r["text"] for r in main_texts(pages).collect()}
    for k in range(8):
        assert got[k] == f"T & U\none{k} two\nA B<p> é\nx\ny"
    assert got[20] == got[21] == "" and got[22] == "alone text" and got[23].startswith("plain > text &")
    assert main_texts(pages).count() == len(rows) and main_texts(pages.limit(0)).count() == 0


def test_template_leaves_varying_slots_only(spark):
    page = "<html><body><div id=x1>My site</div><div id=q>{a}<p>{t}</p></div><div id=r>Letters for all</div></body></html>"
    rows = [(k, f"http://h.x/{k}", page.format(a="", t=f"story {k} " * 9)) for k in range(6)]
    got = {r["page_id"]: r["text"] for r in main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {k: " ".join([f"story {k}"] * 9) for k in range(6)}


def test_template_has_its_say_on_article_pages(spark):
    boxed = "<body><article><h1>Title {k}</h1><div class='kx7'><p>Our partner offers</p></div>{more}<p>story {k} <p>goes on {k}<section>Read us daily</section></article></body>"
    beside = "<body><article><p>teaser {k}</p></article><div class='story'><h1>Head {k}</h1><p>{text}</p><div class='kx8'>Join us now</div></div></body>"
    deeper = "<body><main><article><h1>Top {k}</h1><div class='content'><p>{text}</p></div></article></main></body>"
    rows = [(100 * n + k, f"http://{n}.x/{k}", page.format(k=k, text=f"text {k} " * 30, more="<ul><li>a" if k % 2 else "")) for n, page in enumerate((boxed, beside, deeper)) for k in range(6)]
    rows += [(300 + k, f"http://same.x/{k}", boxed.format(k=1, more="")) for k in range(4)]
    got = {r["page_id"]: r["text"] for r in main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for k in range(6):
        assert got[k] == f"Title {k}\n" + "a\n" * (k % 2) + f"story {k}\ngoes on {k}"
        assert got[100 + k] == f"Head {k}\n" + " ".join([f"text {k}"] * 30)
        assert got[200 + k] == f"Top {k}\n" + " ".join([f"text {k}"] * 30)
    assert got[300].startswith("Title 1\nOur partner offers\nstory 1")


def test_everything_in_the_main_container_stays(spark):
    page = (
        "<body><div class='top'>Host name</div><main><p>lead {k}</p><article><p>first {k}</p></article><p>between {k}</p><article><p>second {k} {long}</p>"
        "</article><p>closing {k}</p><div class='kx'>Read us daily</div><div class='related-posts'>Related</div></main><div>Imprint</div></body>"
    )
    rows = [(k, f"http://h.x/{k}", page.format(k=k, long="w " * 50)) for k in range(12)] + [(99, "http://alone.x/", page.format(k=99, long="w"))]
    got = {r["page_id"]: r["text"].split("\n") for r in main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for k in range(12):
        assert got[k] == [f"lead {k}", f"first {k}", f"between {k}", f"second {k} " + "w " * 49 + "w", f"closing {k}"]
    assert got[99] == ["lead 99", "first 99", "between 99", "second 99 w", "closing 99", "Read us daily"]
    assert extract_text("<body><p>Host<article>one</article><article>two</article>", None, frozenset()) == "one\ntwo"


@pytest.mark.parametrize("name", ["social-science", "related-work", "legal-history", "share-price", "banner-story", "form-text", "cookie-recipe", "adLibitum"])
def test_a_subject_is_no_furniture(name):
    page = "<body><article><h1>T</h1><div class='{n}'><p>text of it</p></div><div id='{n}'>more <a>text</a></div>{end}</article>"
    assert extract_text(page.format(n=name, end=""), None, frozenset()) == "T\ntext of it\nmore text"
    link = f"<div class='{name}'><a href=x>all a link</a></div>"
    assert "all a link" not in extract_text(page.format(n=name, end=link), None, frozenset())


def brute_template(pages):
    parsed = [parse_page(p) for p in pages]
    vectors = {t: tuple(tokens.count(t) for _, tokens in parsed) for t in {t for _, tokens in parsed for t in tokens}}
    classes = {}
    for token, vector in vectors.items():
        if (support := sum(n > 0 for n in vector)) >= 2 and 2 * support >= len(pages):
            classes.setdefault(vector, set()).add(token)
    template = set()
    for vector, members in sorted(classes.items(), key=lambda c: -sum(n > 0 for n in c[0])):
        orders = {tuple(t for t in dict.fromkeys(tokens) if t in members) for (_, tokens), n in zip(parsed, vector, strict=True) if n}
        if len(orders) == 1 and all(t.rsplit("/", 1)[0] in template | members | {""} for t in members):
            template |= members
    said = {t: [text for blocks, _ in parsed if (text := "\n".join(b.text for b in blocks if b.path == t))] for t in template}
    constant = {t for t in template if len(said[t]) >= 3 and len(set(said[t])) == 1}
    plain = {t: sum(max(len(b.text) - b.link, 0) for blocks, _ in parsed for b in blocks if b.path == t and not b.dropped) for t in template - constant}
    plain = {t: n for t, n in plain.items() if n}
    return (main_container(plain) or None) if plain else None, sorted(constant)


@pytest.mark.parametrize("bound", [200_000, 0])
def test_templates_equal_brute_force(spark, monkeypatch, bound):
    import random

    monkeypatch.setattr(html_main, "BROADCAST_TOKENS", bound)
    rng = random.Random(5)
    hosts = {}
    for h in range(25):
        boxes = [f"<div class=b{chr(97 + k)}>{'same' if rng.random() < 0.5 else '{r}'}<p>{{r}}</p></div>" for k in range(rng.randrange(1, 6))]
        for _ in range(rng.randrange(2, 8)):
            chosen = [b for b in boxes if rng.random() < 0.9]
            if rng.random() < 0.15:
                rng.shuffle(chosen)
            body = "".join(chosen).replace("{r}", f"{rng.randrange(10**6)}" + " word" * rng.randrange(9))
            hosts.setdefault(f"{h}.x", []).append(f"<html><body><div id=top>Site</div>{body}{'<ul><li>x</ul>' * rng.randrange(2)}</body></html>")
    turned = "<body><div class=a>{k}</div><div class=b>{k}</div>", "<body><p>{k}</p><div class=b>{k}</div><div class=a>{k}</div>"
    hosts["turned.x"] = [turned[k % 2].format(k=k) for k in range(6)]
    pages = spark.createDataFrame([(h, k, p) for h, ps in hosts.items() for k, p in enumerate(ps)], "host string, page bigint, html string")
    pages = pages.unionByName(pages.filter("host = '0.x' AND page = 0"))
    got = {r["host"]: (r["main"], r["constant"]) for r in html_main.host_templates(pages.filter("host <> '0.x'")).collect()}
    assert got == {h: brute_template(ps) for h, ps in hosts.items() if h != "0.x"}
    assert html_main.host_templates(pages).count() == len(hosts)
    assert not any("div.a" in t for t in got["turned.x"][1]) and got["turned.x"][0] is None


@pytest.mark.parametrize("name", ["ad1", "sideBar", "reader-comments", "site_footer", "cookieBanner", "navMenu", "commentsection"])
def test_furniture_by_name(name):
    page = f"<body><div class='{name}'>gone</div><article><div class='article-header'><h1>T</h1></div><p>text</p><div id='{name}'>gone</div></article>"
    assert extract_text(page, None, frozenset()) == "T\ntext"
    assert extract_text(f"<body><div class='header'>gone</div><div class='{name}'>gone</div><p>some text</p>", None, frozenset()) == "some text"


def test_given_pages_give_whole_articles(spark):
    import html as entities

    for r in main_texts(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect():
        page = next(p for p in _pages() if p["page_id"] == r["page_id"])["html"]
        inner = page[page.index("<article>") + 9 : page.index("</article>")]
        parts = [" ".join(entities.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>|<br>", inner)]
        assert r["text"] == "\n".join(filter(None, parts))


def _pages(cache=[]):  # noqa: B006
    if not cache:
        cache.extend(pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist())
    return cache


def test_parser_survives_broken_markup():
    for text in ("<", "<a", "</", "<p class='x", "<!--", "<script>x", "<div><p></div></p>", "<b" * 2000, "<p x=\"" * 500, "&#xFFFFFFF;&bogus;"):
        parse_page(text)


def test_licences_in_any_spelling(spark):
    name, text = KNOWN_TEXTS[4]
    changed = "Copyright (c) 2020 A\n" + text.replace("License", "LICENCE").replace(", ", " ;\n")
    rows = [(1, changed), (2, "words\n  licensed UNDER the Apache Licence -- version 2.0\nmore"), (3, None), (4, ""), (5, "...\n---"), (None, text), (2, "All rights reserved"), (6, "a " + text), (7, "z" * 200_000)]
    got = licence_scan(spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", licence string")).collect()
    assert Counter(map(tuple, got)) == Counter([(1, name, "text", 1), (2, "Apache-2.0", "line", 1), (None, name, "text", 1), (2, "proprietary", "text", 1)])
    assert licence_scan(spark.createDataFrame([], DOCS)).count() == 0


def test_licences_inside_longer_texts(spark):
    from textwrap import fill

    known = dict((name, text) for name, text in KNOWN_TEXTS if len(text) > 300)
    mit = known["MIT"].replace("conditions: ", "conditions:\n\n").replace("Software. THE", "Software.\n\nTHE")
    wrapped = "\n\n".join(fill(p, 60) for p in mit.split("\n\n"))
    bsd = "\n".join(fill(p, 70) for p in known["BSD-3-Clause"].split("\n")).replace("\n2.", "\n\n2.")
    rows = [
        (1, f"A page of words.\n\nThe MIT License (MIT)\n\nCopyright (c) 2020 A\nAll rights reserved.\n\n{wrapped}\n\n\nMore words."),
        (2, f"BSD 3-Clause License\n\nCopyright 2020 A. All rights reserved.\n\n{bsd}"),
        (3, "All rights reserved."),
        (4, f"words\n \t\n{fill(known['Apache-2.0'], 60)}\n\nwords"),
        (5, wrapped.replace("free", "cheap")),
        (6, "word.\n\n" * 5000 + wrapped),
    ]
    want = {(1, "MIT", "paragraphs", 1), (1, "proprietary", "line", 1), (2, "BSD-3-Clause", "text", 1), (3, "proprietary", "text", 1), (4, "Apache-2.0", "paragraphs", 1), (6, "MIT", "paragraphs", 1)}
    docs = spark.createDataFrame(rows, DOCS)
    assert set(map(tuple, licence_scan(docs).collect())) == want
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert set(con.execute(SCAN_SQL).fetchall()) == want
    many = spark.createDataFrame([(f"n{k}", "word " * k) for k in range(1, 60)] + [("MIT", known["MIT"])], "licence string, text string").collect()
    monkey = pytest.MonkeyPatch()
    monkey.setattr(licences, "MAX_LENGTHS", 20)
    assert {tuple(r) for r in licence_scan(docs, known=known_digests(spark, list(map(tuple, many)))).collect()} >= {(1, "MIT", "paragraphs", 1), (6, "n8", "paragraphs", 4993)}
    monkey.undo()


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return docs, spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", (1 - F.col("quality")).alias("poor"), "toxic")


def test_chain_on_held_out_rows(labelled):
    docs, labels = labelled
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    chain = learn(docs, labels.filter(~held), ["poor", "toxic"])
    rows = score(docs.filter(held), chain).join(labels, "doc_id").collect()
    flagged = [r["p_toxic"] >= chain.limits[1] for r in rows]
    caught = [f for f, r in zip(flagged, rows, strict=True) if r["toxic"]]
    false = [f for f, r in zip(flagged, rows, strict=True) if not r["toxic"]]
    assert sum(caught) >= 0.8 * len(caught) and sum(false) <= 0.02 * len(false)


def test_toxicity_edges(spark):
    rows = [(k, f"nice words here {k}" + (" awful" if k % 2 else "")) for k in range(40)] + [(50, None), (51, ""), (None, "awful"), (1, "again awful")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", toxic int")
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(40)] + [(None, 1, 1), (3, None, 1)], "doc_id bigint, quality int, toxic int")
    got = toxicity(docs, labels).collect()
    assert len(got) == len(rows) and all(r["toxic"] == (r["doc_id"] % 2 == 1) for r in got if r["doc_id"] is not None and r["doc_id"] < 40)
    assert toxicity(docs, labels.limit(0)).count() == len(rows) and toxicity(docs.limit(0), labels).count() == 0
    import numpy as np

    assert 0.3 < best_limit(np.array([0.1, 0.9, 0.8, 0.2]), np.array([0, 1, 1, 0.0])) < 0.8
