from __future__ import annotations

import random
import sys

import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import with_clashes

from seqprep.llm.html_text import aligned, candidates, extract_text, from_json, main_text, match, parse, to_json

CASES = [
    (None, ""),
    ("", ""),
    ("plain text &amp; more", "plain text & more"),
    ("<p>cut off <b>in the mid", "cut off in the mid"),
    ("<article><h1>T</h1><p>a<br>b&nbsp; c<p>d</article><footer>f</footer>", "T\na b c\nd"),
    ("<nav><a href='/'>home</a></nav><main><p>text</p><aside>side</aside></main>", "text"),
    ("<article><p>one</p><div class='ad-slot'>buy</div><section id=comments><article>c</article></section><p>two</article>", "one\ntwo"),
    ("<article><script>var a='<p>no</p>'</script><style>p{}</style><p>yes</p><form><p>mail</p></form></article>", "yes"),
    ("<div class='has-sidebar'><article><p>kept</p></article><div class='sidebar'>no</div></div>", "kept"),
    ("<ul><li>a<li>b</ul><!-- <p>no</p> -->", "a\nb"),
    ("<article><p>x <i>y</i>z</p><p>&lt;b&gt; &#233;</p><table><tr><td>1<td>2</table></article>", "x yz\n<b> é\n1\n2"),
    ("<article class=teaser><p>no</p></article><article><p>a longer article text</p></article>", "a longer article text"),
    ("<p>a < b and c > d</p>", "a < b and c > d"),
    ('<p title="a>b">t</p>', "t"),
    ("<article><p class='search-strategy'>a plan</p><section id='share-prices'>rose</section><div class='share-buttons'>no</div></article>", "a plan\nrose"),
    ("<main><article><p>part one</p></article><p>between</p><article><p>the second part</p></article></main>", "part one\nthe second part"),
]


@pytest.mark.parametrize("page, want", CASES)
def test_single_pages(page, want):
    assert main_text(page, None) == want


def page(i, body):
    return (
        f"<html><head><title>t</title></head><body><div><a href='/a'>Home</a> <a href='/b'>News</a></div>"
        f"<div><p>Welcome to our site</p></div><div>{body}</div><div>All rights reserved</div></body></html>"
    )


def test_constant_nodes_are_template(spark):
    rows = [(i, f"http://user@H.org:80/{i}", page(i, f"<p>Story number {i} begins here</p><p>and ends {i * 7}</p>")) for i in range(20)]
    rows += [(100, None, None), (101, "http://one.org", "<p>alone</p>"), (5, "http://h.org/5", rows[5][2])]
    df = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string")).repartition(3)
    got = {r.page_id: r.text for r in extract_text(df).collect()}
    assert all(got[i] == f"Story number {i} begins here\nand ends {i * 7}" for i in range(20))
    assert got[100] == "" and got[101] == "alone"
    assert extract_text(df).count() == len(rows)


def test_large_templates_are_joined(spark, monkeypatch):
    from seqprep.llm import html_text

    monkeypatch.setattr(html_text, "BROADCAST_BYTES", 0)
    rows = [(i, "http://h.org", page(i, f"<p>Story number {i}</p>")) for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in extract_text(df).collect()} == {f"Story number {i}" for i in range(9)}


def test_copies_of_one_page_keep_their_article():
    copy = "<article><p>the same story</p></article><footer>x</footer>"
    assert main_text(copy, candidates([copy, copy + " ", copy + "  "])) == "the same story"


def extracted(spark, pages):
    rows = [(i, "http://h.org/" + str(i), p) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {r.page_id: r.text for r in extract_text(df).collect()}


def story(i):
    return "".join(f"<p>Paragraph {k} of the story {i} says {i * 31 + k}</p>" for k in range(1 + i % 4))


def told(i):
    return "\n".join(f"Paragraph {k} of the story {i} says {i * 31 + k}" for k in range(1 + i % 4))


def test_the_template_alone_decides_inside_the_article(spark):
    pages = [f"<article>{story(i)}<p>Read our terms</p></article>" for i in range(30)]
    assert main_text(pages[3], None) == told(3) + "\nRead our terms"
    assert extracted(spark, pages) == {i: told(i) for i in range(30)}


@pytest.mark.parametrize("depth", [10, 65, 1500])
def test_templates_at_any_depth(spark, depth):
    pages = ["<div>" * depth + f"<div>{story(i)}</div><div><p>All rights are ours</p></div>" + "</div>" * depth for i in range(12)]
    assert extracted(spark, pages) == {i: told(i) for i in range(12)}


def test_all_pages_vote(spark):
    # a text on a minority of the host's pages stays, wherever the first pages come from
    pages = [f"<article>{story(i)}{'<p>A guest wrote this</p>' if i % 3 == 0 else ''}<p>Ours</p></article>" for i in range(60)]
    got = extracted(spark, pages)
    assert all(got[i] == told(i) + ("\nA guest wrote this" if i % 3 == 0 else "") for i in range(60))


def test_copies_have_one_vote(spark):
    # 40 copies with a counter outside the article do not make their story a template
    pages = [f"<article>{story(2)}</article><footer>{i}</footer>" for i in range(40)]
    pages += [f"<article>{story(i)}</article>" for i in (5, 6, 7)]
    got = extracted(spark, pages)
    assert all(got[i] == told(2) for i in range(40)) and [got[40 + k] for k in range(3)] == [told(5), told(6), told(7)]


def test_alignment_against_all_pairings():
    rng = random.Random(5)
    for _ in range(300):
        left, right = [[rng.randrange(3) for _ in range(rng.randrange(6))] for _ in range(2)]
        worth = {(x, y): rng.randrange(4) for x in range(3) for y in range(3)}

        def best(i, j):
            if i == len(left) or j == len(right):
                return 0
            return max(best(i + 1, j), best(i, j + 1), worth[left[i], right[j]] + best(i + 1, j + 1))

        total, places = aligned(left, right, worth)
        assert total == best(0, 0) == sum(worth[left[i], right[j]] for i, j in places)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(places, places[1:]))


def test_tree_matching_against_all_matchings():
    rng = random.Random(6)

    def random_page(depth):
        text = rng.choice(["", "x", "y"])
        inner = "".join(random_page(depth - 1) for _ in range(rng.randrange(4))) if depth else ""
        tag = rng.choice(["div", "section"])
        return f"<{tag}>{text}{inner}</{tag}>"

    def worth(t, node):
        """The best matching by trying all."""
        if t[:2] != [node.tag, node.names]:
            return 0
        below = node.elements()

        def best(i, j):
            if i == len(t[3]) or j == len(below):
                return 0
            return max(best(i + 1, j), best(i, j + 1), worth(t[3][i], below[j]) + best(i + 1, j + 1))

        total = (node.own_text() in t[2]) + best(0, 0)
        return total + (total > 0)

    compared = 0
    for _ in range(800):
        pages = [random_page(3) for _ in range(2)]
        template = candidates(pages)
        if template is not None:
            assert from_json(to_json(template)) == template
            root = parse(pages[1])
            got = sum(1 + (x.own_text() in t[2]) for t, x in match(template, root))
            assert got == worth(template, root)
            compared += 1
    assert compared > 50


def test_long_tables_of_one_host(spark):
    rows = "".join(f"<tr><td>yes<td>no<td>{k % 7}" for k in range(1500))
    pages = [f"<article><p>{i} tells {i * i}</p><table>{rows}<tr><td>{i}</table></article>" for i in range(3)]
    got = extracted(spark, pages)
    assert all(got[i].startswith(f"{i} tells {i * i}\nyes\nno") and got[i].count("yes") == 1500 for i in range(3))


def test_html_is_not_shuffled(spark):
    df = spark.createDataFrame([(i, f"http://h.org/{i}", f"<p>a {i}</p><div>b</div>") for i in range(9)], "page_id long, url string, html string")
    plan = extract_text(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_deep_and_long_pages():
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000, None) == "deep"
    assert main_text("<article>" + "<p>w</p>" * 20_000 + "</article>", None).count("w") == 20_000


def test_empty_table(spark):
    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_candidates_come_from_all_pages(spark):
    # the pages that have the least hashes of a few stretches, once the sample, lack a text that the others hold
    def hashed(pages):
        df = spark.createDataFrame([(p,) for p in pages], "html string")
        return {r.html: (r.h, r.h % 6) for r in df.selectExpr("html", "xxhash64(html) AS h").collect()}

    without = hashed([f"<article><p>Story {i} says {i * i}</p></article>" for i in range(300)])
    least = [min((p for p in without if without[p][1] == k), key=lambda p: without[p][0]) for k in range(6)]
    held = hashed([f"<article><p>Story {i} says {i * i}</p><p>Ours</p></article>" for i in range(300, 900)])
    held = [p for p, (h, k) in held.items() if h > without[least[k]][0]]
    pages = least + held[:60]
    assert len(pages) == 66
    got = extracted(spark, pages)
    assert len(got) == 66 and not [t for t in got.values() if "Ours" in t or not t.startswith("Story")]
