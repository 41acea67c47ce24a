"""Main text by wrapper induction: planted pages, the tree matching against a plain recursion, and repairs."""

import random
import time
from functools import cache

import numpy as np
import pytest

from stowage.llm import corpus_queries, wrapper

SCHEMA = "page_id bigint, url string, html string, host string, HTML int, template int"


def prose(rng, n):
    return " ".join(rng.choice("abcdefgh") + rng.choice("xyz") + str(rng.randrange(90)) for _ in range(n))


def plain_page(rng, host, k, paragraphs):
    """A layout without any telling tag or class: only other pages of the host show what is template."""
    head = f"<div class='x1'><p>Welcome to {host}, the best place on earth for all your needs</p><span>since 1999</span></div>"
    links = "<div class='x2'>" + "".join(f"<p><a href=/{i}>{prose(rng, 4)}</a></p>" for i in range(8)) + "</div>"
    body = f"<div class='x3'><h1>{paragraphs[0]}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs[1:]) + "<h6>Subscribe here to all of our news of the day</h6></div>"
    tail = f"<div class='x4'><p>All rights are reserved by the owners of {host} and their friends</p></div>"
    return f"<html><head><title>t{k}</title></head><body>{head}{links}{body}{tail}</body></html>"


def marked_page(rng, paragraphs):
    shape = rng.randrange(3)
    body = "".join(f"<p>{p}" for p in paragraphs[1:])
    inner = f"<h1>{paragraphs[0]}</h1>{body}<div class='ad-box'>Buy now</div><aside>Aside</aside><section id=comments><p>Great post</p></section>"
    box = (f"<article>{inner}</article>", f"<main><div class='sidebar'>Side</div><div class=x>{inner}</div></main>", f"<div role=main>{inner}</div>")[shape]
    return f"<!DOCTYPE html><body class='with-sidebar'><header><h2>Site</h2></header><nav><a href=/>Home</a></nav>{box}<div class='cookie-notice'>We use cookies</div><form><input>Find</form><script>if (a < b) '</p>'</script><footer>&copy; me</footer>"


def planted(seed=1):
    rng = random.Random(seed)
    rows, want = [], {}

    def add(url, html, text):
        want[len(rows)] = text
        rows.append((len(rows), url, html))

    for k in range(40):
        paragraphs = [prose(rng, rng.randrange(8, 40)) for _ in range(rng.randrange(3, 9))]
        add(f"http://plain.example/{k}", plain_page(rng, "plain.example", k, paragraphs), "\n".join(paragraphs))
    for k in range(30):
        paragraphs = [prose(rng, rng.randrange(2, 40)) for _ in range(rng.randrange(2, 9))]
        add(f"https://Marked.example:80/{k}", marked_page(rng, paragraphs), "\n".join(paragraphs))
    # near copies and exact copies of an article must not make it template
    paragraphs = [prose(rng, 20) for _ in range(5)]
    for k in range(12):
        own = [*paragraphs[:4], paragraphs[4] + f" v{k}"]
        add(f"http://copies.example/{k}", f"<nav>Menu</nav><article><h1>{own[0]}</h1>" + "".join(f"<p>{p}</p>" for p in own[1:]) + "</article>", "\n".join(own))
    for k in range(5):
        add("http://one.example/", "<div><p>Lone page</p><p>two</p></div>", "Lone page\ntwo")
    return rows, want


def test_query(spark, tmp_path):
    rows, want = planted()
    odd = [(900, None, None), (901, "", ""), (None, "x", "just text &amp; more"), (902, None, "<p>a</p>"), (902, None, "<p>a</p>"), (903, "http://one.example/x", "<br>" * 10 + "q  r s<br>t")]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        spark.createDataFrame([(*r, "h", 1, 2) for r in rows + odd], SCHEMA).repartition(5).write.parquet(str(tmp_path / "pages.parquet"))
        got = sorted((tuple(r) for r in corpus_queries.op12_html_extraction(spark, str(tmp_path)).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    texts = [(i, u, want[i]) for i, u, _ in rows] + [(900, None, ""), (901, "", ""), (None, "x", "just text & more"), (902, None, "a"), (902, None, "a"), (903, "http://one.example/x", "q r s t")]
    assert got == sorted(((i, u, t, len(t)) for i, u, t in texts), key=str)


def test_empty_table(spark):
    assert wrapper.extracted(spark.createDataFrame([], SCHEMA.replace("HTML", "x"))).collect() == []


def random_tree(rng, depth=0):
    labels = rng.sample(range(6), rng.randrange(0, 5)) if depth < 4 else []
    return [(label, random_tree(rng, depth + 1)) for label in labels]


def flat(label, children, depth=0):
    yield depth, label
    for x, below in children:
        yield from flat(x, below, depth + 1)


def as_tree(children):
    return np.array([(d, x, 0, 0, 0) for d, x in flat(99, children)], dtype=wrapper.TREE)


def frozen(children):
    return tuple((x, frozen(below)) for x, below in children)


@cache
def slow_matches(a, b):
    """Simple tree matching: the greatest number of pairs in two ordered child lists."""
    if not a or not b:
        return 0
    best = max(slow_matches(a[:-1], b), slow_matches(a, b[:-1]))
    if a[-1][0] == b[-1][0]:
        best = max(best, slow_matches(a[:-1], b[:-1]) + 1 + slow_matches(a[-1][1], b[-1][1]))
    return best


def test_alignment_is_the_largest():
    rng = random.Random(8)
    for _ in range(400):
        a, b = random_tree(rng), random_tree(rng)
        ta, tb = as_tree(a), as_tree(b)
        found = wrapper.aligned(ta, tb)
        assert len(found) == 1 + slow_matches(frozen(a), frozen(b))
        assert all(ta["label"][i] == tb["label"][j] for i, j in found.items())
        pairs = sorted(found.items())
        assert [j for _, j in pairs] == sorted({j for _, j in pairs})


REPAIRS = {
    "unclosed": ("<p><b>one.<br><p>two <i>x</i>y<div>three</div>four", "one.\ntwo xy\nthree\nfour"),
    "lists": ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"),
    "table": ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    "stray ends": ("a</div></p></span>b", "a\nb"),
    "references": ("&lt;b&gt; &#233;&eacute; &copy &amp &am &nope; &#x1F600;", "<b> éé © & &am &nope; \U0001f600"),
    "comment and cdata": ("a<!-- <p> --> b<![CDATA[c]]><!-- open", "a bc"),
    "no tags": ("1 < 2 and 3 > 2 <3", "1 < 2 and 3 > 2 <3"),
    "raw": ("<title>t</title><SCRIPT>x='</p>'</ScRiPt >a<style>b", "a"),
    "space": (" <p>\n a \t b c\r\n</p> <p> </p>", "a b c"),
    "hidden": ("<p hidden>x</p><p style='DISPLAY: none'>y</p><p aria-hidden=true>z</p><p>a</p>", "a"),
    "inline advert": ("<p>a <span class=ad>x</span>b</p>", "a b"),
    "form around": ("<form><article><p>a</p><form>x</form></article></form>", "a"),
    "header inside": ("<header>x</header><article><header><h1>t</h1></header><p>a</p><footer>f</footer></article>", "t\na"),
}


@pytest.mark.parametrize("case", REPAIRS)
def test_repairs(case):
    html, want = REPAIRS[case]
    assert wrapper.main_text(html) == want


@pytest.mark.parametrize("unit", ["<div>", "<p>", "<li>", "<ul><li>", "</div>", "<a '", '<a "', "<!--", "<", "&", "<i>", "<b><p>", "<td><tr>", "<x{}>", "<p class='{}'>a</p>", "<![CDATA["])
def test_linear(unit):
    letters = [a + b + c for a in "abcdefghij" for b in "abcdefghij" for c in "klmnopqrst"]
    page = "".join(unit.format(letters[i % 1000]) for i in range(30000))
    start = time.process_time()
    wrapper.main_text(page, wrapper.packed(wrapper.preorder(wrapper.folded(wrapper.parse(page))[0])), "0" * 40000)
    assert time.process_time() - start < 15
