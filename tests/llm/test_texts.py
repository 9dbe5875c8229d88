"""Decontamination, language model, HTML extraction and license scan against plain Python."""

import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recordset.llm import decontaminate, html_text, licenses, lm
from recordset.session import ensure_checkpoint_dir
from llm_helpers import LOWER, ODD_TEXTS, prose, space_words, docs  # noqa: F401

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def alnum_words(text):
    return re.findall(ALNUM, (text or "").translate(LOWER))


def brute_hits(text, items):
    words = alnum_words(text)
    hit, ids = set(), set()
    for item, t in items:
        w = alnum_words(t)
        k = min(10, len(w))
        if item is None or not k:
            continue
        for i in range(len(w) - k + 1):
            for j in range(len(words) - k + 1):
                if words[j:j + k] == w[i:i + k]:
                    hit |= set(range(j, j + k))
                    ids.add(str(item))
    return len(words), len(hit), sorted(ids)


@pytest.fixture(scope="module")
def benchmark_case(spark):
    rng = random.Random(8)
    items = [(i, prose(rng, rng.choice([3, 9, 10, 11, 30]), 50)) for i in range(12)] + [(0, "W1 w1"), (5, ""), (6, None), (None, "w2 w2 w2"), (7, "ß Ä")]
    items += items[:2]
    texts = list(ODD_TEXTS) + ["ß ä", "ß Ä! "]
    for _ in range(40):
        piece = alnum_words(rng.choice(items[:12])[1])
        a = rng.randrange(len(piece))
        texts.append(prose(rng, rng.randrange(30), 50).upper() + "--" + ", ".join(piece[a:a + rng.randrange(1, 30)]) + "; " + prose(rng, 5, 50))
    return items, texts


def test_decontamination_matches_brute_force(spark, docs, benchmark_case):
    items, texts = benchmark_case
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    ensure_checkpoint_dir(spark)
    frame = docs(texts)
    want = [brute_hits(t, items) for t in texts]
    for size in (decontaminate.AUTOMATON_BYTES, 200):  # one automaton, and as many passes as a small bound asks for
        rows = sorted(decontaminate.decontaminate(frame, bench, automaton_bytes=size).collect(), key=lambda r: r.doc_id)
        assert [(r.n_words, r.n_hit, sorted(r.item_ids)) for r in rows] == want
        assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r.item_ids) for r in rows)
    for r in rows:  # the spans cover the hit words of the original text, and no others
        assert sum(len(alnum_words(r.text[s.start:s.end])) for s in r.hit_spans) == r.n_hit
        assert all(re.fullmatch(ALNUM, r.text[i].translate(LOWER)) for s in r.hit_spans for i in (s.start, s.end - 1))


def test_windows_automaton_reads_words():
    rng = random.Random(3)
    items = [(str(i % 70), prose(rng, rng.randrange(1, 60), 3000)) for i in range(80)]
    windows = decontaminate.Windows(items, 10)
    words = [alnum_words(t) for _, t in items]
    assert windows.automaton.get_stats()["nodes_count"] <= 1 + 20 * sum(max(len(w) - 9, 1) for w in words)
    assert max(map(ord, "".join(windows.code.values()))) <= 2 * (math.isqrt(len(windows.code)) + 1)
    for _ in range(60):
        piece = alnum_words(rng.choice(items)[1])
        a = rng.randrange(len(piece))
        text = " ".join([prose(rng, 7, 9000), *piece[a:a + rng.randrange(30)], prose(rng, 7, 3000)])
        hits, ids = windows.find(decontaminate.normal_words(text.encode()))
        assert (len({j for x, y in hits for j in range(x, y)}), sorted(ids)) == brute_hits(text, items)[1:]
    assert decontaminate.Windows([("1", "")], 10).find([b"x"]) == ([], set())


def test_decontamination_in_parts_by_states_and_odd_columns(spark, docs, benchmark_case):
    items, texts = benchmark_case
    ensure_checkpoint_dir(spark)
    frame = docs(texts).selectExpr("doc_id", "text", "1 AS _item_ids", "2 AS `a.b`", "3 AS N_Hit", "4 AS _word_spans")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.decontaminate(frame, bench, automaton_states=1000)
    assert got.columns[:4] == ["doc_id", "text", "_item_ids", "a.b"] and "N_Hit" not in got.columns
    rows = sorted(got.collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.n_hit, sorted(r.item_ids)) for r in rows] == [brute_hits(t, items) for t in texts]


def test_decontamination_of_nothing(spark, docs):
    bench = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert decontaminate.decontaminate(docs([]), bench).collect() == []
    rows = decontaminate.decontaminate(docs(["a b", "a b"], ids=[3, 3]), bench.limit(0)).collect()
    assert [(r.contaminated, r.n_items) for r in rows] == [(False, 0)] * 2


def brute_language_model(train, texts, share):
    """Counts, and scores by walking the states one token at a time."""
    tokens = lambda t: [*space_words((t or "").translate(LOWER)), None]  # noqa: E731 - None is the end token
    c, pairs, starts = Counter(), Counter(), 0
    for t in train:
        w = tokens(t)
        c.update(w)
        pairs.update(zip(["<s>", *w], w))
        starts += 1
    n, v = sum(c.values()), len(c)
    least = max(2, math.ceil(share * n))
    p = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))
    follow = dict(c) | {"<s>": max(starts, 1)}
    kept = {k: x for k, x in pairs.items() if x >= least and c[k[1]] >= least and (k[0] == "<s>" or c[k[0]] >= least)}
    gone = Counter()
    for (h, _), x in kept.items():
        gone[h] += (x - lm.DISCOUNT) / follow[h]
    out = []
    for t in texts:
        state, base, score = "<s>", 0.0, 0.0
        w = tokens(t)
        for x in w:
            base += math.log10(p(x))
            fail = 1 - gone[state]
            own = (kept[state, x] - lm.DISCOUNT) / follow[state] if (state, x) in kept else 0
            score += math.log10(own + fail * p(x))
            state = x
        out.append((len(w), sum(c[x] > 0 for x in w), n, base, score))
    return out


@pytest.mark.parametrize("share", [1e-7, 0.02])  # nearly all tokens in the automaton; nearly all joined
def test_language_model_matches_brute_force(spark, docs, share):
    ensure_checkpoint_dir(spark)
    rng = random.Random(4)
    texts = list(ODD_TEXTS) + [prose(rng, rng.randrange(60), 40) + " " + prose(rng, 2, 9999).upper() for _ in range(60)]
    frame = docs(texts)
    model = lm.fit_language_model(frame.filter(F.col("doc_id") % 3 != 0), keep_share=share)
    rows = sorted(lm.score_language_model(frame, model).collect(), key=lambda r: r.doc_id)
    want = brute_language_model([t for i, t in enumerate(texts) if i % 3], texts, share)
    assert len(rows) == len(texts)
    for r, w in zip(rows, want):
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3]
        assert r.base_score == pytest.approx(w[3], abs=1e-6) and r.score == pytest.approx(w[4], rel=1e-6, abs=1e-6)
    assert rows[0].source == "s"  # other columns stay, the old score is replaced


@pytest.mark.parametrize("share", [0.003, 0.02, 1.0])  # what is broadcast: some tokens, few, none
def test_language_model_keeps_bigrams_that_are_not_broadcast(spark, docs, share):
    ensure_checkpoint_dir(spark)
    rng = random.Random(5)
    texts = list(ODD_TEXTS) + [prose(rng, rng.randrange(60), 40) + " once more " + prose(rng, 2, 9999).upper() for _ in range(60)] + ["once more"] * 3
    frame = docs(texts)
    train = [t for i, t in enumerate(texts) if i % 3]
    model = lm.fit_language_model(frame.filter(F.col("doc_id") % 3 != 0), broadcast_share=share)
    assert len(model.shared["vocabulary"]) < 60
    rows = sorted(lm.score_language_model(frame, model).collect(), key=lambda r: r.doc_id)
    want = brute_language_model(train, texts, 0)
    assert any(abs(a[4] - b[4]) > 1 for a, b in zip(want, brute_language_model(train, texts, share)))  # the cut model is another
    for r, w in zip(rows, want, strict=True):
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3]
        assert r.base_score == pytest.approx(w[3], abs=1e-6) and r.score == pytest.approx(w[4], rel=1e-6, abs=1e-6)


def test_language_model_of_nothing(spark, docs):
    ensure_checkpoint_dir(spark)
    frame = docs(["a b", None, "a b"], ids=[1, 1, 1])
    rows = lm.score_with_language_model(frame, F.lit(False)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert lm.score_with_language_model(frame.limit(0), F.lit(True)).collect() == []


LONG = "the cat of the house and the dog that is in the yard with a man who was at work " * 4
PAGES = [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>one<br>two<br><br>three", "one two\n\nthree"),
    (f"<nav><ul><li><a href=x>Menu</a></ul></nav><article><h1>Title</h1><p>{LONG}<p>short</article><footer>foot</footer>", f"Title\n\n{LONG.strip()}\n\nshort"),
    (f"<div class='cookie-notice'>{LONG}</div><div id=main><p>{LONG}</p><p>end</p></div><div class=comments><p>{LONG}</p></div>", f"{LONG.strip()}\n\nend"),
    (f"<p>{LONG}</p><ul><li><a href=1>{LONG}</a></ul>", LONG.strip()),
    ("<script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>a &lt;b&gt; &amp;&nbsp; c</p>", "a <b> & c"),
    ("<nav>menu<article><p>never closed", "never closed"), ('<p title="a>b" data=\'x>y\'>t</p><p title="open>u</p>', "t\n\nu"),
    (f"<form><label>Name</label><input></form><aside>{LONG}</aside><p>{LONG}</p>", LONG.strip()),
    ("<article>" + "<p>x</p>" * 3000 + "</article>", "\n\n".join(["x"] * 3000)),
]


RUSSIAN = "Вчера вечером городской совет принял решение о строительстве нового моста через реку. " * 4
FINNISH = "Kaupunginvaltuusto päätti eilen illalla uuden sillan rakentamisesta joen yli, kertoo paikallinen sanomalehti. " * 4
CHINESE = "昨天晚上市议会决定在河上修建一座新的大桥,工程预计明年春天开始。" * 8


@pytest.mark.parametrize("text", [RUSSIAN.strip(), FINNISH.strip(), CHINESE])
def test_main_text_of_other_languages(text):
    menu = "<nav><ul><li><a href=x>Menu</a></ul></nav>"
    assert html_text.main_text(f"{menu}<div><p>{text}</p></div><footer>foot</footer>") == text


POLISH = ("Rada miasta podjęła wczoraj wieczorem decyzję o budowie nowego mostu przez rzekę, który połączy oba brzegi. "
          "Prace rozpoczną się wiosną przyszłego roku i potrwają prawdopodobnie trzy lata, powiedział burmistrz podczas konferencji prasowej.")
LINKS = "<ul><li><a href=1>Wiadomości z kraju</a><li><a href=2>Sport i pogoda</a></ul>"
FOOT = "<p>This is the site of the city and it is not for sale, and all that you read in it was written by us.</p>"


def test_main_text_judges_the_language_block_by_block():
    # One sentence of a known language says nothing of the other blocks, and lists of links do not decide a long plain one.
    assert POLISH in html_text.main_text(f"<div>{LINKS}<p>{POLISH}</p>{LINKS}</div>{FOOT}").split("\n\n")
    short = POLISH.split(". ")[0] + "."
    got = html_text.main_text(f"<nav>{LINKS}</nav>{LINKS}<p>{short}</p><p>{POLISH}</p>{LINKS}{FOOT}").split("\n\n")
    assert got[:2] == [short, POLISH]
    assert LINKS not in got and not any("Sport" in t for t in got)
    listing = "alpha beta gamma delta " * 12  # long and plain, no sentences: what is not a list of links decides
    assert listing.strip() in html_text.main_text(f"{LINKS}<p>{LONG}</p>{LINKS}<div>{listing}</div>{LINKS}").split("\n\n")


@pytest.mark.parametrize("page", [
    "<div class='nav'>x<p>y" * 50_000, "<b>" * 40_000 + "</i>" * 300_000, "<div class=menu>" * 60_000 + "</section>" * 60_000, "<script" * 200_000,
    "<script>a</script" * 90_000, "<!-- <p>" * 180_000, "<p title='" * 150_000, "<a href=1>x<li>" * 90_000, "&amp;" * 300_000, "<" * 1_500_000])
def test_pages_of_open_tags_take_linear_time(page):
    def seconds(text):
        start = time.process_time()
        html_text.main_text(text)
        return time.process_time() - start

    assert len(page) > 600_000
    eighth = min(seconds(page[: len(page) // 8]) for _ in range(2))
    assert seconds(page) < 24 * eighth + 0.5  # 8 in proportion, 64 if it went with the square


def test_lifted_containers_of_deep_pages():
    page = "<div class=widget>" * 3000 + f"<p>{LONG}</p>" + "</div>" * 3000
    assert html_text.main_text(page) == LONG.strip()
    assert html_text.main_text(f"<nav>{page}</nav>") == ""


@pytest.mark.parametrize("part", ["div class='content no-sidebar'", "div class='post has-comments'", "div class='with-ads'", "form id='aspnetForm'", "div class='sidebar-layout'"])
def test_main_text_inside_of_what_is_named_like_chrome(part):
    page = f"<{part}><nav><a href=x>Menu</a></nav><p>{LONG}</p><div class=comments><p>{LONG}</p></div></{part.split()[0]}>"
    assert html_text.main_text(page.replace(f"<p>{LONG}</p><div", f"<p>{LONG}</p><p>{LONG}</p><div")) == f"{LONG.strip()}\n\n{LONG.strip()}"


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_extraction_keeps_rows_and_columns(spark):
    frame = spark.createDataFrame([(i, "u", h, "old") for i, (h, _) in enumerate(PAGES)] + [(0, None, None, None)], "page_id bigint, url string, html string, N_Chars string")
    rows = html_text.extract_main_text(frame).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in rows) == sorted([(i, t, len(t)) for i, (_, t) in enumerate(PAGES)] + [(0, "", 0)])
    assert html_text.extract_main_text(frame.limit(0)).columns == ["page_id", "url", "text", "n_chars"]


def brute_licenses(text, templates):
    words = re.findall("[0-9a-z]+", (text or "").lower())
    sh = [" ".join(words[i:i + 5]) for i in range(max(len(words) - 4, 1))] if words else []
    found = set()
    for name, t in templates.items():
        own = licenses.template_shingles(t)
        c = licenses.template_class(len(own))
        block, count = max(c // 2, 1), 1 if c == 1 else 3
        for k in range(0, len(sh), block):
            if len(set(own) & set(sh[k:k + block * count])) >= licenses.needed(len(own)):
                found.add(name)
    return sorted(found)


def test_license_scan_matches_brute_force(docs):
    rng = random.Random(11)
    texts = list(ODD_TEXTS) + ["licensed", "Released under the MIT", "the MIT License. " * 3]
    for name, t in licenses.TEMPLATES.items():
        texts += [t, t.upper(), prose(rng, 40) + "\n" + t + "\n" + prose(rng, 40)]
        for _ in range(6):  # broken copies on either side of the limit
            w = t.split()
            for _ in range(rng.randrange(1, 3)):
                w[rng.randrange(len(w))] = "zzz"
            texts.append(prose(rng, rng.randrange(30)) + " " + " ".join(w))
    texts.append(" ".join(licenses.TEMPLATES.values()))
    rows = sorted(licenses.scan_licenses(docs(texts)).collect(), key=lambda r: r.doc_id)
    assert [r.licenses for r in rows] == [brute_licenses(t, licenses.TEMPLATES) for t in texts]
    assert all(r.n_licenses == len(r.licenses) for r in rows)


def test_license_scan_of_nothing(docs):
    assert licenses.scan_licenses(docs([])).collect() == []
    rows = licenses.scan_licenses(docs(["Released under the MIT License."] * 2 + [None], ids=[1, 1, None])).collect()
    assert sorted(r.licenses for r in rows) == [[], ["MIT"], ["MIT"]]
    with pytest.raises(ValueError, match="anchor"):
        licenses.scan_licenses(docs(["x"]), templates={"odd": "no word of that kind in here"})
