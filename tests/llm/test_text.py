"""Quality rules, personal data, page text and language-model scores against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import documents, lower, words
from jobsignals.llm import lattice_lm, page_blocks, private, quality_rules, site_style
from jobsignals.llm.lattice import MARK, default_vocabulary

# ---- quality rules


def plain_measures(text):
    text = text or ""
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) for k in range(3)
               if grams[tuple(w[i:i + 3])] > 1}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


@settings(max_examples=150, deadline=None)
@given(st.text("ab#é \n\t\x1c|", max_size=80))
def test_measures(text):
    assert quality_rules.measure(text)[:5] == plain_measures(text)


def test_host_verdicts_decide(spark):
    good = " ".join(f"word{i} and" for i in range(60))
    junk = " ".join(f"word{i}###" for i in range(60))
    lines = "\n".join(["same line here now"] * 2 + [f"other{i} words" for i in range(28)]
                      + ["a b%d" % i for i in range(4)])
    rows = ([(i, good, "fine") for i in range(30)] + [(100, junk, "fine"), (101, None, "fine")]
            + [(200 + i, junk, "bad") for i in range(40)] + [(250, good, "bad")]
            + [(300 + i, good if i % 2 else junk, None) for i in range(20)]
            + [(400, lines, "fine")])
    docs = documents(spark, rows).withColumn("verdict", F.lit("x")).withColumn("th", F.lit("y"))
    got = {r.doc_id: r for r in quality_rules.quality_report(docs).collect()}
    assert all(got[i].kept for i in range(30)) and not got[100].kept and got[101].base_failed
    assert got[250].verdict == "condemned" and not got[250].kept
    assert got[300].verdict == "doubtful" and not got[300].kept and got[301].kept
    assert got[400].kept and got[400].n_dup_lines == 1
    assert got[0].host_rate < got[300].host_rate < got[200].host_rate
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, r in got.items() if r.kept)
    assert quality_rules.quality_report(docs.where("false")).isEmpty()
    assert quality_rules.keep_good(docs.where("false")).isEmpty()


def test_rates_of_small_hosts_shrink_more():
    a, b = quality_rules.beta_prior(0.2, 0.01)
    assert math.isclose(a / (a + b), 0.2) and math.isclose(a + b, 0.2 * 0.8 / 0.01 - 1)
    assert quality_rules.beta_prior(None, None) == (0.5, 0.5)
    assert quality_rules.beta_prior(0.3, 0.0) == pytest.approx((0.3, 0.7))


def test_labelled_quality_is_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality_rules.quality_report(docs).where("NOT base_failed").join(labels, "doc_id")
    for r in rows.collect():
        assert r.kept == bool(r.quality)


# ---- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if
                  kind == "ip" else None, "card": 12 <= len(digits) <= 19 and private.luhn(digits),
                  "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


CLEAR = ["mail a.b+c@x-y.co.uk. or b@c, c@d.e@f.gh", "1.2.3.4.5.6.7.8 and 256.1.1.1 or 0001.2.3.255",
         "4111 1111 1111 1111 and 4111-1111-1111-1112", "call +1 (988) 555-2485.", "é +49 30 1234567",
         "@@a@b.c@d.e", "x" * 50 + "@", "+1 2", "", "1" * 5000, "12345678901234567890 0000000000000000"]


@pytest.mark.parametrize("text", CLEAR)
def test_base_spans(text):
    assert private.joined(private.base_spans(text)) == plain_spans(text)


@settings(max_examples=300, deadline=None)
@given(st.text("a1.@ +-()25é", max_size=60))
def test_base_spans_of_anything(text):
    assert private.joined(private.base_spans(text)) == plain_spans(text)


def test_weak_spans_need_their_checks():
    def found(text):
        return [(k, text[a:b]) for a, b, k in private.added_spans(text, private.base_spans(text))]

    assert found("pay to DE89 3704 0044 0532 0130 00 now") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert found("pay to DE89 3704 0044 0532 0130 01 now") == []
    assert found("my SSN is 123-45-6789") == [("ssn", "123-45-6789")]
    assert found("part 123-45-6789") == found("see 123-45-6789") == []
    assert found("call 988-555-2485 now") == [("tel", "988-555-2485")]
    assert found("sum 988-555-2485 now") == []
    assert found("passport C01234567") == [("passport", "C01234567")] and not found("C01234567")


def test_private_report(spark):
    rows = [(i, t) for i, t in enumerate(CLEAR)] + [(None, "a@b.cd"), (50, None), (51, "SSN 123-45-6789")]
    docs = documents(spark, rows).withColumn("spans", F.lit("x")).withColumn("base", F.lit("y"))
    got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)
                  for r in private.private_report(docs).collect())
    want = Counter()
    for d, t in rows:
        spans = plain_spans(t or "")
        want[(d, *(spans.count(k + ":") for k in PATTERNS),
              hashlib.sha256(spans.encode()).hexdigest())] += 1
    assert got == want
    assert private.private_report(docs).where("doc_id = 51").first().spans == "ssn:4:15"
    assert private.private_report(docs.where("false")).isEmpty()


# ---- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script>
</head><body><header class=site><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></ul></nav>
<div class="cookie-notice">We use <b>cookies</b></div><!-- <p>comment</p> -->
<article><header><h1>A &amp; B</h1></header><p>One <b>two<br>three &eacute;&#x41;&nbsp; four<p>Five
six</b></p><form><p>Your mail</p><input></form><script>x</script><ul><li>i<li>j</ul>
<table><tr><td>c1<td>c2<tr><td>c3</table><div class="ad">Buy</div><blockquote>q</blockquote></article>
<aside><p>side</p></aside><section id="comments"><p>first!</p></section><footer>f</footer></body></html>"""


def texts(page, low=frozenset()):
    return [b.text for b in page_blocks.main_blocks(page, low)]


def test_an_article_is_found():
    assert texts(PAGE) == ["A & B", "One two three éA four", "Five six", "i", "j", "c1", "c2", "c3", "q"]


def test_pages_without_an_article():
    page = ("<body><div id=menu><a href=a>x</a></div><div class=text><p>Hello <a href=b>w</a></p>tail"
            "</div><div><a href=c>only a link</a></div><div role=navigation>n</div></body>")
    assert texts(page) == ["Hello w", "tail"]


@pytest.mark.parametrize("page, want", [
    ("", []), ("plain text", ["plain text"]), ("<p>a<p>b", ["a", "b"]), ("a < b <p>c", ["a < b", "c"]),
    ("<script>never closed <p>x", []), ("<!-- open <p>x", []), ("<p>a</b></i>c</p>", ["ac"]),
    ("<p title='>'>a</p>", ["a"]), ('<p title="open>a</p><p>b', ["a", "b"]), ("<P>A<BR/>B</P>", ["A B"]),
    ("<div hidden><p>no</p></div>yes", ["yes"]), ("<article></article>", []),
    ("<main>m</main>o", ["m"]), ("&lt;p&gt; &copy", ["<p> ©"]), ("<div>" * 3000 + "deep", ["deep"])])
def test_odd_markup(page, want):
    assert texts(page) == want


STORY = "<h1>Title</h1><p>The story begins here and goes on.</p><p>The story ends here.</p>"
TOLD = ["Title", "The story begins here and goes on.", "The story ends here."]


@pytest.mark.parametrize("open_tag", [
    '<div class="page has-sidebar">', '<div class="search-results">', '<div class="content menu-open">',
    '<div id="search">', '<div class="content widget">', "<form>"])
def test_a_hint_never_takes_the_story(open_tag):
    close = "</form>" if open_tag == "<form>" else "</div>"
    ad = '<div class="ad">Buy this</div>'
    assert texts(f"<nav>n</nav>{open_tag}{STORY}{ad}{close}<footer>f</footer>") == TOLD
    assert texts(f"<article>{open_tag}{STORY}{ad}{close}</article><p>{'other ' * 99}</p>") == TOLD


def test_hints_and_noise_of_small_branches():
    title = '<article><div class="entry-header"><h1>Title</h1></div><p>Story.</p></article>'
    assert texts(title) == ["Title", "Story."]
    # Each widget is small, all of them are the page.
    widgets = "".join(f'<div class="widget"><p>Part {i} of it.</p></div>' for i in range(9))
    assert len(texts(widgets + "<p>x</p>")) == 10
    # Text that is only in a header, in links or in a label is the page's text; a menu's is not.
    assert texts("<header>Only this</header><nav>n</nav>") == ["Only this"]
    assert texts("<div><a href=a>Only this</a></div><aside>s</aside>") == ["Only this"]
    assert texts("<nav>n</nav><footer>f</footer><div hidden>h</div>") == []
    assert texts('<div class="ad">' * 20000 + "deep") == ["deep"]


def test_a_hint_lowers_importance(spark):
    """Two blocks that repeat alike: only the one with a hint in its class is removed."""
    rows = [(i, "http://h.org/%d" % i, "".join(
        f'<div class="{c}"><p class="{c}">say {c} {i % 20}</p></div>' for c in ("latest-widget", "latest-news"))
        + f"<p>Story {i} is a long one that no other page of the host tells.</p>") for i in range(40)]
    got = {r.page_id: r.text for r in site_style.main_text(pages_of(spark, rows)).collect()}
    assert "latest-news" in got[0] and "Story 0" in got[0]
    rows = [(i, u, h.replace(f"{i % 20}</p>", f"{i % 8}</p>")) for i, u, h in rows]
    got = {r.page_id: r.text for r in site_style.main_text(pages_of(spark, rows)).collect()}
    assert "latest-news" in got[0] and "latest-widget" not in got[0] and "Story 0" in got[0]


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_repeated_branches_are_removed(spark):
    def page(i, tip):
        return (f"<html><body><div class=box><p>{tip}</p></div><div class=story><h1>Title {i}</h1>"
                f"<p>Story {i} begins.</p><p>Story {i} ends.</p></div></body></html>")

    rows = [(i, "http://a.org/%d" % i, page(i, f"tip {i % 3}")) for i in range(40)]
    rows += [(100, "http://b.org/1", page(100, "tip 1")), (101, None, None), (102, "odd", "<p>x")]
    rows += [(None, "http://a.org/c", page(7, "tip 1"))] * 30
    rows += [(200 + i, "http://copies.org/", page(1, "tip")) for i in range(20)]
    docs = pages_of(spark, rows).withColumn("host", F.lit("x")).withColumn("low", F.lit("y"))
    got = {r.page_id: r for r in site_style.main_text(docs).collect()}
    assert got[3].text == "Title 3\n\nStory 3 begins.\n\nStory 3 ends."
    assert got[3].n_chars == len(got[3].text) and got[None].text.startswith("Title 7\n\nStory")
    # A host with one page, or copies of one, shows nothing about what it repeats.
    assert got[100].text.startswith("tip 1\n\nTitle") and got[200].text.startswith("tip\n\nTitle")
    assert got[101].text == "" and got[102].text == "x"
    assert site_style.main_text(docs).count() == len(rows)
    assert site_style.main_text(docs.where("false")).isEmpty()


def test_rare_branches_of_a_large_host_are_removed(spark):
    """A block on 6 pages is judged alike whether its host has 30 pages or 1,000."""
    def page(i, tip):
        return (f"<div class=box><p>{tip}</p></div>" if tip else "") + (
            f"<div class=story><p>Story {i} begins.</p><p>Story {i} ends.</p></div>")

    rows = [(n * 10000 + i, f"http://h{n}.org/{i}", page(i, "Same words" if i < 6 else ""))
            for n in (30, 1000) for i in range(n)]
    rows += [(None, "http://h1000.org/copy", page(3, "Same words"))]
    got = Counter((r.page_id, r.text) for r in site_style.main_text(pages_of(spark, rows)).collect())
    assert got == Counter((p, f"Story {int(i)} begins.\n\nStory {int(i)} ends.") for p, i in [
        *((p, p % 10000) for p, _, _ in rows[:-1]), (None, 3)])


def test_pages_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in site_style.main_text(pages).collect()}
    for r in pages.collect():
        inner = re.search("<article>(.*)</article>", r.html, re.S)[1]
        parts = re.split("</?(?:p|h1)>", inner.replace("<br>", " "))
        want = [" ".join(re.sub("<[^>]*>", "", p).split()) for p in parts]
        import html
        assert got[r.page_id] == "\n\n".join(html.unescape(p) for p in want if p)


# ---- language model

SMALL = ([(i, " ".join(f"the cat sat on mat{i % 5} Ünï {'x' * (i % 4)}".split())) for i in range(60)]
         + [(100, None), (101, ""), (None, "the dog 日本"), (102, "zzz" * 30), (7, "extra the"),
            (100, "THE"), (103, "the the"), (103, "the the")])


def plain_base(rows):
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0 for d, _ in rows}
    count = Counter()
    for d, t in rows:
        if not held[d]:
            count.update(words(lower(t)) + [None])
    n, v = sum(count.values()), len(count)
    out = []
    for d, t in rows:
        tokens = words(lower(t)) + [None]
        out.append((d, held[d], len(tokens), sum(count[w] > 0 for w in tokens), n,
                    sum(math.log10((count[w] + .1) / (n + .1 * (v + 1))) for w in tokens)))
    return out, count


def plain_lattice(rows, count, rounds):
    """Two rounds of expectation-maximisation over all segmentations, piece by piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=default_vocabulary())
    ids, byte = {}, {}
    for i in range(model.get_piece_size()):
        p = model.id_to_piece(i)
        if model.is_byte(i):
            byte[int(p[3:5], 16)] = p
        elif not (model.is_control(i) or model.is_unknown(i)) and MARK not in p[1:]:
            ids[p] = model.get_score(i)
    names = list(ids) + list(byte.values())
    order = sorted(names, key=lambda p: -model.get_score(model.piece_to_id(p)))
    ends = count[None]
    start = {p: 1 / (k + 1) for k, p in enumerate(order)}
    scale = ends / sum(start.values())
    expected = {p: s * scale for p, s in start.items()}

    def weights():
        total = sum(expected.values()) + ends + .1 * (len(names) + 1)
        return {p: (expected.get(p, 0) + .1) / total for p in names}, (ends + .1) / total

    def edges(s):
        for i in range(len(s)):
            for j in range(i + 1, min(len(s), i + 16) + 1):
                if s[i:j] in ids:
                    yield i, j, [s[i:j]]
            if s[i] not in ids:
                yield i, i + 1, [byte[b] for b in s[i].encode()]

    def sums(s, w, found):
        a = [1.0] + [0.0] * len(s)
        for i, j, p in found:
            a[j] += a[i] * math.prod(w[x] for x in p)
        return a

    for _ in range(rounds):
        w, _ = weights()
        new = defaultdict(float)
        for word, c in count.items():
            if word is None:
                continue
            s = MARK + word
            found = list(edges(s))
            a, b = sums(s, w, found), [0.0] * len(s) + [1.0]
            for i, j, p in sorted(found, key=lambda e: -e[1]):
                b[i] += b[j] * math.prod(w[x] for x in p)
            for i, j, p in found:
                for x in p:
                    new[x] += c * a[i] * math.prod(w[y] for y in p) * b[j] / a[-1]
        expected = new
    w, end = weights()
    return [sum(math.log10(sums(MARK + x, w, edges(MARK + x))[-1]) for x in words(lower(t)))
            + math.log10(end) for _, t in rows]


@pytest.mark.parametrize("shared", [200_000, 3])
def test_scores(spark, monkeypatch, shared):
    monkeypatch.setattr(lattice_lm, "SHARED_WORDS", shared)
    docs = documents(spark, SMALL).withColumn("held_out", F.lit("x")).withColumn("word", F.lit("y"))
    got = lattice_lm.score_texts(docs).collect()
    base, count = plain_base(SMALL)
    want = [(*b, s) for b, s in zip(base, plain_lattice(SMALL, count, lattice_lm.ROUNDS))]

    def key(r):
        return (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-6)


def test_scores_of_nothing_and_without_training(spark):
    docs = documents(spark, SMALL)
    assert lattice_lm.score_texts(docs.where("false")).isEmpty()
    held = documents(spark, [(None, "a b"), (None, None)])
    rows = lattice_lm.score_texts(held).collect()
    assert len(rows) == 2 and all(r.held_out and r.train_tokens == 0 and r.n_known == 0
                                  and math.isfinite(r.score) for r in rows)


def test_fitting_helps_held_out_texts(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    score = F.sum("score") / F.sum("n_tokens")
    fitted = lattice_lm.score_texts(docs).where("held_out").select(score).first()[0]
    real = lattice_lm.fit_pieces
    monkeypatch.setattr(lattice_lm, "fit_pieces", lambda *a: real(*a, rounds=0))
    start = lattice_lm.score_texts(docs).where("held_out").select(score).first()[0]
    assert fitted > start + 1
