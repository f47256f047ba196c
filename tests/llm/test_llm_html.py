"""HTML extraction: the article's text against plain expressions, other layouts, broken markup."""

import html
import random
import re
import time

import numpy as np
import pytest

from veritab.llm import html_main as h
from veritab.llm.common import table

SF = "/root/testdata/sf0.01"


def brute(page):
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split())
             for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(x for x in parts if x)


@pytest.fixture(scope="module")
def trees(spark):
    return h.learn(table(spark, SF, "pages"))


def test_articles_of_all_pages(spark, trees):
    pages = table(spark, SF, "pages")
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in h.extract(pages, trees).collect()}
    want = {r["page_id"]: (r["url"], brute(r["html"]), len(brute(r["html"]))) for r in pages.collect()}
    assert len(want) > 100 and got == want


def test_furniture_and_other_elements(trees):
    rng, pull = random.Random(77), h.Extractor(trees)
    words = "lorem ipsum dolor. sit amet, elit sed do".split()
    right = total = 0
    for k in range(60):
        paras = [" ".join(rng.choice(words) for _ in range(rng.randint(12, 70))) for _ in range(rng.randint(2, 8))]
        page = f"<html><body><nav><ul><li><a href='/'>home</a></li></ul></nav><article><h1>A title</h1>" \
            + "".join(f"<p>{x}</p>" for x in paras) + "</article><footer>&copy; x</footer></body></html>"
        for text, _ in h.variants(page, rng, words)[2:3]:
            for mark in (' class="zzmain"', "zzmain ", ' class="zzleave"'):
                text = text.replace(mark, "")
            total += 1
            right += pull([text])[0] == "\n\n".join(["A title", *paras])
    assert right >= 0.9 * total


def test_best_labelling_never_goes_back():
    rng = np.random.default_rng(3)
    root, blocks, _ = h.parse("<div><section><p>a</p><div><p>b</p></div></section><p>c</p></div><p>d</p>")
    up = [blocks.index(n.parent) if n.parent else None for n in blocks]
    for _ in range(200):
        odds = rng.normal(size=len(blocks)) * 2
        chosen = [id(n) in h.decode(blocks, odds) for n in blocks]
        best = max(sum((-np.logaddexp(0, -o) if c else -np.logaddexp(0, o)) for o, c in zip(odds, pick))
                   for pick in _allowed(up))
        mine = sum((-np.logaddexp(0, -o) if c else -np.logaddexp(0, o)) for o, c in zip(odds, chosen))
        assert mine == pytest.approx(best)


def _allowed(up):
    """Labellings in which a path of the tree enters the main text once at most."""
    for bits in range(2 ** len(up)):
        pick = [bool(bits >> k & 1) for k in range(len(up))]
        state, fine = [], True
        for k, p in enumerate(up):
            above = state[p] if p is not None else "o"
            fine &= not (above == "x" and pick[k])
            state.append("m" if pick[k] else "x" if above in "mx" else "o")
        if fine:
            yield pick


@pytest.mark.parametrize("page, text", [
    ("", ""), ("no markup at all", ""), ("<p><b>x<br><p>y", ""), ("<<<>>> </p></b><div", ""),
    ("<article><p>a &amp b&nbsp; c &lt;z&gt; &am</p><form>q</form><p>d<script>x</p></script></p></article>",
     "a & b c <z> &am\n\nd"),
])
def test_broken_and_odd_markup(trees, page, text):
    assert h.Extractor(trees)([page]) == [text]


def test_odd_rows(spark, trees):
    long = "<article>" + "<p>word and more</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<article><p>one thing here, long enough</p></article>"),
            (4, "w", long), (4, "w", long)]
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, text int, n_chars int")
    got = h.extract(pages, trees).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == by[2]["text"] == "" and by[2]["url"] is None
    assert by[4]["text"] == "\n\n".join(["word and more"] * 20_000)
    assert h.extract(pages.limit(0), trees).collect() == []
    assert {r["text"] for r in h.extract(pages, h.learn(pages.where("page_id < 3"))).collect()} == {""}


def test_sample_is_full_where_marked_pages_are_rare(spark, monkeypatch):
    took = []
    monkeypatch.setattr(h, "training_rows", lambda pages: took.append(pages) or (np.zeros((0, 1)), np.zeros(0)))
    marked = spark.range(200).selectExpr("id AS page_id", "'u' AS url", "concat('<main>', id, '</main>') AS html")
    plain = spark.range(200, 200_000).selectExpr("id AS page_id", "'u' AS url", "'<p>plain' AS html")
    h.learn(marked.unionByName(plain))
    h.learn(plain)
    assert [len(x) for x in took] == [h.SAMPLE_PAGES, 0] and all("<main>" in x for x in took[0])


def test_formulas_stay_in_the_text(trees):
    page = ("<article><p>Here <math display='inline'><mrow><mi>a</mi><mo>=</mo><mspace width='1em'/>"
            "<msup><mi>b</mi><mn>2</mn></msup></mrow></math> holds.</p><p>And so on, as before.</p></article>")
    assert h.Extractor(trees)([page]) == ["Here a=b2 holds.\n\nAnd so on, as before."]


@pytest.mark.parametrize("page", [
    "<b>" * 500_000 + "</i>" * 400_000, "<b>" * 500_000 + "<p></p>" * 200_000, "<div>" * 300_000 + "<td></td>" * 150_000,
    "<a " * 1_000_000, "<!" * 1_500_000, "<ul>" + "<li>word" * 380_000, "<p>" * 1_000_000, "<a \"'>" * 500_000,
    "<!-- " * 600_000 + ">", "&amp" * 750_000], ids=lambda p: p[:4] + p[-4:])
def test_pages_of_three_million_characters_take_linear_time(page):
    assert len(page) >= 2_800_000
    began = time.perf_counter()
    root, blocks, _ = h.parse(page)
    assert len(h.features(root, blocks)) == len(blocks)
    assert time.perf_counter() - began < 60


def test_broken_markup_against_plain_rules():
    """Where elements close, against stacks that are searched element by element."""
    rng = random.Random(12)
    tags = ["b", "p", "div", "li", "ul", "td", "tr", "table", "a", "dt", "dl", "option", "select"]
    for _ in range(2000):
        marks = [rng.choice(["<%s>", "</%s>"]) % rng.choice(tags) for _ in range(rng.randint(1, 25))]
        stack, want = [], []

        def close(place):
            while len(stack) > place:
                want.append(("end", stack.pop()))

        for mark in marks:
            name = mark.strip("</>")
            if mark[1] == "/":
                if name in stack:
                    close(len(stack) - 1 - stack[::-1].index(name))
                continue
            for i in range(len(stack) - 1, -1, -1):
                if name in h.CLOSES_P:
                    if stack[i] == "p":
                        close(i)
                        break
                    if stack[i] not in h.INLINE:
                        break
                elif name in h.CLOSES:
                    if stack[i] in h.STOPS[name]:
                        break
                    if stack[i] in h.CLOSES[name]:
                        close(i)
                        break
            stack.append(name)
            want.append(("start", name))
        edges = [n.tag for n, text in h.parse("".join(marks))[2] if text is None]
        assert edges == [tag for _, tag in want if tag not in h.INLINE], marks


def test_the_text_beside_a_block_is_that_of_its_siblings_at_any_size():
    for n in (3, 2500):
        root, blocks, _ = h.parse("<ul>" + "".join(f"<li>{'x' * (k % 5)}</li>" for k in range(n)) + "</ul>")
        rows = h.features(root, blocks)
        at = len(h.TAG_GROUPS) + 2 * len(h.TOKEN_GROUPS) + len(h.UNDER_TAGS) + 8
        total = sum(k % 5 for k in range(n))
        for k in range(0, n, 7):
            assert rows[2 + k][at] == pytest.approx(np.log1p((total - k % 5) / (n - 1)))
