import random
import re
from collections import Counter

import pytest

from voxweave.llm import html as H

PAGE = '<html><head><title>T {0}</title><style>p{{}}</style></head><body><nav><a href="/">home</a></nav><div class="ad">buy</div><div class="post p{0}"><h1>Head {0}</h1><p>One &amp; two<p>Three <a href=x>link</a></div><div class="comments">{1}</div></body></html>'


def test_consensus_beats_a_single_page(spark):
    rows = [(k, "https://u@Site.example:8080/a", PAGE.format(k, "short")) for k in range(9)]
    rows.append((9, "http://site.example/b", PAGE.format(9, "a comment that is much longer than the post itself, and says so at some length, again and again and again and again" * 3)))
    rows.append((10, "http://other.example/", "<p>alone</p>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    win = {r["host"]: (r["path"], r["votes"], r["pages"]) for r in H.paths(df).collect()}
    assert win["site.example"] == ("body>div.p#.post", 9, 10)
    got = {r["page_id"]: r for r in H.extract(df).collect()}
    assert got[9]["text"] == "Head 9\nOne & two\nThree link" and got[9]["used"] == "host" and got[9]["title"] == "T 9"
    assert got[10]["text"] == "alone"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("a < b and c > d", "a < b and c > d"),
        ("<p>one<p>two", "one\ntwo"),
        ("<ul><li>x<li>y</ul>z", "x\ny\nz"),
        ("</div></p>stray", "stray"),
        ("<script>var a = '<p>';</script>kept<!-- gone <p> -->", "kept"),
        ("<script>open", ""),
        ("<div>a<br>b<img src='>'>c</div>", "a\nbc"),
        ("&lt;p&gt; &nbsp;x", "<p> x"),
        ("<nav>menu</nav><footer>foot</footer>body", "body"),
        ("", ""),
    ],
)
def test_texts(source, text):
    assert H.extract_one(source, None)[3] == text


def test_deep_and_odd_pages(spark):
    deep = "<div>" * 20_000 + "core" + "</div>" * 20_000
    rows = [(1, None, None), (2, "", ""), (3, "https://h.example/", deep), (3, "https://h.example/", deep), (None, "https://h.example/", "<div>other</div>"), (4, "not a url", "x" * 500_000), (5, "https://e.example", "<p></p>")]
    df = spark.createDataFrame([(*r, "c", "c", "c") for r in rows], "page_id long, url string, html string, path string, winner string, host string")
    got = H.extract(df).collect()
    assert len(got) == 7
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] is None and by[1]["used"] is None and by[2]["text"] == "" and by[3]["text"] == "core" and len(by[4]["text"]) == 500_000 and by[5]["text"] == ""
    assert H.extract(df.limit(0)).count() == 0


def test_ties_go_to_the_lower_path(spark):
    df = spark.createDataFrame([(1, "http://h/", "<main>a</main>"), (2, "http://h/", "<article>a</article>")], "page_id long, url string, html string")
    assert H.paths(df).first()["path"] == "body>article"


def test_empty_element_at_the_winning_path():
    page = "<div class=post></div><div class=story>The article is here</div>"
    assert H.extract_one(page, "body>div.post")[1::2] == ("page", "The article is here")
    assert H.extract_one("<div class=post></div>", "body>div.post")[1::2] == ("host", "")
    assert H.extract_one("<div class=post></div><a>only a link</a>", "body>div.post")[1::2] == ("body", "only a link")


def test_forms():
    whole = "<form id=aspnet><nav>menu</nav><div class=post><p>The article is here</p></div><form><input>search</form></form>tail"
    assert H.extract_one(whole, None)[3] == "The article is here" and H.vote(whole) == "body>form>div.post"
    assert H.extract_one("<div>A text that is longer</div><form>search here</form>", None)[3] == "A text that is longer"


CONTAINERS = ("div", "section", "article", "main", "td")
OTHERS = ("p", "span", "ul", "b", "a", "nav", "h2")
BOILER = ("sidebar", "footer", "menu", "comments")


def grown(rng, depth=0):
    """A tree: (tag, class, children), children being text or trees; no p in p, no li."""
    tag = rng.choice(CONTAINERS + OTHERS if depth else ("div",))
    name = rng.choice(("", "", "post", f"post p{rng.randrange(100)}", "wide post", *BOILER))
    inner = [" ".join(rng.choice(("uno", "dos", "tres", "x&y")) for _ in range(rng.randrange(1, 9))) if rng.random() < 0.6 or depth > 4 else grown(rng, depth + 1) for _ in range(rng.randrange(0, 4))]
    if tag in ("p", "h2", "a", "b", "span"):
        inner = [x for x in inner if isinstance(x, str)]
    return tag, name, inner


def written(tree):
    if isinstance(tree, str):
        return tree.replace("&", "&amp;")
    tag, name, inner = tree
    return f"<{tag}{f' class="{name}"' if name else ''}>{''.join(map(written, inner))}</{tag}>"


def plain(trees):
    """({path: score of the best container there, in order}, {path: text}, all text) of a page, from the trees themselves."""
    found, texts, every = [["body", 0, 0, False]], {}, []

    def walk(tree, path, home, boiler, link, open_):
        if isinstance(tree, str):
            n = len(tree.replace(" ", ""))
            home[1] += n
            home[2] += n if link else 0
            for out in (*open_, every):
                out.append(tree)
            return
        tag, name, inner = tree
        if tag == "nav":
            return
        path += ">" + tag + "".join("." + c for c in sorted({re.sub(r"\d+", "#", c) for c in name.split()}))
        boiler = boiler or bool(set(name.split()) & set(BOILER))
        block = tag not in ("span", "b", "a")
        if tag in CONTAINERS:
            home = [path, 0, 0, boiler]
            found.append(home)
        own = texts.setdefault(path, []) if tag in CONTAINERS else None
        for out in (*open_, every):
            out.append("\n" if block else "")
        if own is not None and not any(own is o for o in open_):
            open_ = (*open_, own)
        for x in inner:
            walk(x, path, home, boiler, link or tag == "a", open_)
        for out in (*open_, every):
            out.append("\n" if block else "")

    body = texts.setdefault("body", [])
    for t in trees:
        walk(t, "body", found[0], False, False, (body,))
    tidy = lambda parts: "\n".join(y for x in "".join(parts).split("\n") if (y := " ".join(x.split())))
    return [(p, (n - linked) * (0.25 if b else 1.0)) for p, n, linked, b in found], {p: tidy(x) for p, x in texts.items()}, tidy(every)


def test_whole_operator_against_plain(spark):
    """Scores, votes by host and texts of random trees, against the same from the trees without any HTML."""
    rng = random.Random(3)
    pages, seen, votes = [], {}, {}
    for k in range(150):
        trees = [grown(rng) for _ in range(rng.randrange(0, 4))]
        host = f"h{k % 6}.example"
        pages.append((k, f"https://{host}/{k}", "<html><body>" + "".join(map(written, trees)) + "</body></html>"))
        seen[k] = (host, *plain(trees))
        scores = seen[k][1]
        best = max(range(len(scores)), key=lambda i: (scores[i][1], -i))
        if scores[best][1] > 0:
            seen[k] += (scores[best][0],)
            votes.setdefault(host, Counter())[scores[best][0]] += 1
    winner = {h: min(c, key=lambda p: (-c[p], p)) for h, c in votes.items()}
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r["host"]: (r["path"], r["votes"]) for r in H.paths(df).collect()} == {h: (winner[h], votes[h][winner[h]]) for h in winner}
    used = Counter()
    for r in H.extract(df).collect():
        host, _, texts, every, *own = seen[r["page_id"]]
        at = winner.get(host)
        if at in texts and (texts[at] or not every):
            want = (at, "host", texts[at])
        elif own:
            want = (own[0], "page", texts[own[0]])
        else:
            want = (None, "body", every)
        assert (r["path"], r["used"], r["text"]) == want
        used[r["used"]] += 1
    assert used["host"] > 20 and used["page"] > 20


def test_depth_makes_no_difference():
    for depth in (3, 150, 250, 2000):
        source = "<div class=a>" * depth + "<div class=post>The article</div><div class=menu>other words that are longer</div>" + "</div>" * depth
        path = "body" + ">div.a" * depth + ">div.post"
        assert H.vote(source) == path and H.extract_one(source, path)[1::2] == ("host", "The article")
