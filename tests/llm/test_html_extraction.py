import random
import re
import time
from collections import Counter

import pytest

from quizlens.llm import html_extraction as hx
from quizlens.llm.tables import table
from tests.conftest import SF_DIR

LABELLED = [
    "<html><head><title>t</title></head><body><nav><ul><li><a href=x>home</a></li></ul></nav><div class=ad>buy it now</div>"
    "<article><h1>A title here</h1><p>Some words of the text go here.</p><p>And more of them <b>bold</b> too.</p></article>"
    "<footer>the end of it</footer></body></html>"] * 30

PAGES = [
    (None, ""), ("", ""), ("plain words only", "plain words only"),
    ("<article><p>a &lt; b &amp;&nbsp;c</p>\n<p> two\n  lines<br>here</p></article>", "a < b & c\n\ntwo lines here"),
    ("<article><p>one <i>in</i>line<p>unclosed <b>bold<p>last</article><p>outside words", "one inline\n\nunclosed bold\n\nlast"),
    ("<body><header><h1>Site</h1></header><main><header><h1>Real title</h1></header><p>Text of it.</p></main></body>",
     "Real title\n\nText of it."),
    ("<article><p>Start of text.</p><aside>side</aside><div class='x advert-box'>ad</div><form><input value=a>sign</form>"
     "<script>var a='<p>no</p>';</script><style>p{}</style><p>End.</p><section id=comments><p>I agree</p></section></article>",
     "Start of text.\n\nEnd."),
    ("<div class=menu><a href=a>one</a><a href=b>two</a></div><div id=story><h2>Head line</h2><p>First words go here.</p>"
     "<p>Second words go there.</p></div><div class='cookie-notice'><p>We use cookies</p></div>",
     "Head line\n\nFirst words go here.\n\nSecond words go there."),
    ("<nav><a href=a>one</a></nav><footer>two</footer>", ""),
    ("<article><!-- <p>no</p> --><p title='a>b'>quoted</p><p hidden>no</p><p class=notice>no<p>yes</article>", "quoted\n\nyes"),
    ("<article><p>broken <em att='x>tag</p><p>next</p></article>", None),
]


@pytest.fixture(scope="module")
def weights():
    return hx.learn(LABELLED)


@pytest.mark.parametrize("page,text", PAGES)
def test_pages(weights, page, text):
    got = hx.extract(page, weights)
    assert text is None or got == text


def test_without_labelled_pages_long_text_still_wins():
    page = "<nav><a href=a>x</a></nav><div>" + "".join(f"<p>{'many words of running text ' * 5}</p>" for _ in range(5)) + "</div>"
    assert hx.extract(page, hx.learn([])).count("many words") == 25


def test_best_region_equals_all_regions():
    for scores in ([], [-1.0], [1.0], [1, -2, 3, -1, 2, -5, 4], [2, -1, 2, -3, 3], [-1, -1], [0.0, 0.0]):
        start, end = hx.best_region([float(s) for s in scores])
        every = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        assert sum(scores[start:end]) == max([0, *every])


def test_table(spark, weights):
    rows = [(i, f"u{i}", page, "x") for i, (page, _) in enumerate(PAGES)] + [(50 + i, None, p, "x") for i, p in enumerate(LABELLED)]
    got = {r.page_id: r for r in hx.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert len(got) == len(rows)
    assert all(got[i].text == text for i, (_, text) in enumerate(PAGES) if text is not None)
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert hx.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_of_known_documents(spark):
    """Pages name their document in the url; the text is its lines, after the heading."""
    got = hx.extract_pages(table(spark, SF_DIR, "pages")).collect()
    texts = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    known = [(r.text.split("\n\n", 1)[-1], texts[int(m[1])]) for r in got if (m := re.search(r"/(\d+)", r.url)) and int(m[1]) in texts]
    assert len(known) > 20
    assert all(a == "\n\n".join(filter(None, (" ".join(x.split()) for x in b.split("\n")))) for a, b in known)


BODY = "<h1>A title here</h1><p>Some words of the text go here, quite a few of them.</p><p>And more of them follow too.</p>"
TEXT = "A title here\n\nSome words of the text go here, quite a few of them.\n\nAnd more of them follow too."


@pytest.mark.parametrize("wrapped", [
    "<form method=post>{}</form>", "<div class='layout has-sidebar'>{}</div>", "<div id='search-page'>{}</div>",
    "<div class='menu-open'><form><fieldset>{}</fieldset></form></div>", "<div class='no-comments'>{}</div>"])
def test_wrappers_do_not_take_the_text_with_them(weights, wrapped):
    menu = "<nav><a href=x>home</a></nav>"
    for inner in (BODY, f"<article>{BODY}</article>", f"<main>{BODY}</main>"):
        assert hx.extract(f"<body>{menu}{wrapped.format(inner)}<footer>the end</footer></body>", weights) == TEXT
    # An article makes a wrapper of whatever holds it, but what is left out in it stays out.
    page = wrapped.format(f"<div class=ad>buy it now {'again ' * 40}</div><article>{BODY}<div class='share-buttons'>share</div></article>")
    assert hx.extract(f"<body>{menu}{page}</body>", weights) == TEXT


def test_names_inside_the_text(weights):
    page = ("<article><h2 id='privacy'>On privacy</h2><section id='related-work'><p>Work that is related.</p></section>"
            "<div class='share-prices'><p>Prices of shares.</p></div><section id=comments><p>I agree, at great length, with all of "
            "this and with more of it than anyone has written here so far.</p></section><div class='related-posts'>more</div></article>")
    assert hx.extract(page, weights) == "On privacy\n\nWork that is related.\n\nPrices of shares."


def test_marked_text_is_neither_trimmed_nor_split(weights):
    table = "<table>" + "".join(f"<tr><td>{i}</td><td>{i + 1}</td></tr>" for i in range(60)) + "</table>"
    links = "<ul>" + "".join(f"<li><a href=r{i}>[{i}]</a></li>" for i in range(80)) + "</ul>"
    hidden = "<aside>" + "<p>left out</p>" * 200 + "</aside>"
    for parts in ((table, "<p>Some words here.</p>"), ("<p>Some words here.</p>", table), ("<p>Some words here.</p>", links),
                  (links, "<p>Some words here.</p>"), ("<p>Before it all.</p>", table * 5, hidden, links, "<p>After it.</p>")):
        page = "<body><nav><a href=x>home</a></nav><article>" + "".join(parts) + "</article><footer>the end</footer></body>"
        got = hx.extract(page, weights).split()
        inner = "".join(parts).replace(hidden, "")
        assert got == re.sub("<[^>]*>", " ", inner).split()


@pytest.mark.parametrize("page", [
    "<i>x" * 100_000, "<div class=comment>" * 20_000 + "x", '<a href="' * 100_000, "<a '\"b" * 50_000, "<p>x" * 100_000,
    "<ul><li>x" * 50_000, "<!x" * 100_000, "<div>" * 50_000 + "</p>" * 50_000, "<script" * 50_000, "<" + "a" * 300_000,
    "<article><div class=ad><header>x" * 20_000, "<form><p>x y z" * 30_000])
def test_deep_and_broken_pages_take_linear_time(weights, page):
    start = time.monotonic()
    hx.extract(page, weights)
    assert time.monotonic() - start < 20


def test_tags_end_at_the_first_bracket_outside_quotes():
    """The table of ends, used after a tag without an end, agrees with reading each tag over."""
    r = random.Random(3)
    for _ in range(500):
        page = "".join(r.choice(["<b ", '"', "'", ">", "x", "<"]) for _ in range(r.randint(1, 25)))
        tokens, fresh = hx.Tokens(page), [m.end() if (m := hx.ATTRIBUTES.match(page, i)) else -1 for i in range(len(page) + 1)]
        tokens._end(len(page))      # no tag ends there, so all ends are tabled
        assert [tokens._end(i) for i in range(len(page) + 1)] == fresh


def test_an_open_quote_ends_at_the_next_bracket(weights):
    assert hx.extract("<article><p>one <a href=\"x>two</a></p><p>three</p></article>", weights) == "one two\n\nthree"
    assert hx.extract("<article><p>one <a href='x <b>two</b></p><p>3 < 4</p></article>", weights) == "one two\n\n3 < 4"


NUMBERS = "<table>" + "".join(f"<tr><td>{i}</td><td>{i + 1}</td></tr>" for i in range(90)) + "</table>"
LINKS = "<ul>" + "".join(f"<li><a href=r{i}>ref{i}</a></li>" for i in range(80)) + "</ul>"
RUNNING = "<p>Some words of running text go here for all to read.</p>"


@pytest.mark.parametrize("learned", [True, False])
@pytest.mark.parametrize("wrapped", ["<div id=story>{}</div>", "<div><div>{}</div></div>", "{}"])
def test_unmarked_text_is_neither_trimmed_nor_split(weights, learned, wrapped):
    bodies = [RUNNING * 3 + NUMBERS, RUNNING * 3 + NUMBERS + RUNNING, NUMBERS * 5 + RUNNING * 2, "<p>One two</p><p>three</p>"]
    if wrapped != "{}":      # right in the body a list of links may as well be a menu
        bodies += [RUNNING * 3 + LINKS, RUNNING * 3 + LINKS + RUNNING]
    for body in bodies:
        page = f"<body><nav><a href=x>home</a></nav>{wrapped.format(body)}<footer>the end</footer></body>"
        assert hx.extract(page, weights if learned else hx.learn([])).split() == re.sub("<[^>]*>", " ", body).split()


def test_menus_of_an_unmarked_page_stay_out(weights):
    page = f"<body><ul><li><a href=a>one</a></li><li><a href=b>two</a></li></ul><div>{RUNNING * 3}</div>{LINKS}</body>"
    assert hx.extract(page, weights).split() == re.sub("<[^>]*>", " ", RUNNING * 3).split()


def test_all_marked_articles_are_kept(weights):
    between = "<div>ten words that lie between both of the articles here</div>"
    page = f"<body><article><p>First text of two.</p></article>{between}<article>{RUNNING}</article></body>"
    assert hx.extract(page, weights) == "First text of two.\n\nSome words of running text go here for all to read."


def test_scores_decide_on_marked_pages_too(weights):
    page = f"<body><article>{RUNNING}</article><section><pre>{'code of a listing ' * 10}</pre></section></body>"
    assert hx.extract(page, weights) == "Some words of running text go here for all to read."
    other = hx.Weights(Counter({"pre": 1000}), Counter({"p": 1000, "<p>": 1000}))
    assert hx.extract(page, other) == ("code of a listing " * 10).strip()


def test_pages_without_their_marks_give_the_same_text(spark):
    pages = [r.html or "" for r in table(spark, SF_DIR, "pages").collect()]
    learned = hx.learn(pages)
    bare = [re.sub(r"(?i)<(/?)(article|main)\b", r"<\1div", page) for page in pages]
    assert [hx.extract(page, learned) for page in bare] == [hx.extract(page, learned) for page in pages]


def test_what_browsers_show_is_text(weights):
    page = ("<article><p>energy <math>E</math> is <object>m</object><svg/><svg><text>c</text></svg><template>no</template></p>"
            "<svg viewBox='0'/><p>squared</p></article>")
    assert hx.extract(page, weights) == "energy E is m\n\nsquared"
