import re

import pytest

from moodline.llm import html_blocks as hb
from moodline.llm import queries
from tests.conftest import SF_SMALL

LONG = ("This is the story of a man that was in the town and it is said that he would have been there for as long as "
        "they could see. ")

PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>no";</script></head>
<body><header><a href="/">Home</a><p>{LONG}</p></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div class="cookie-notice">We use cookies. {LONG}</div><!-- <p>hidden {LONG}</p> -->
<div id=content><h1>The  headline</h1><p>{LONG}<b>bold</b> &amp; more&nbsp;text<p>Short one.<p>{LONG}{LONG}
<div class="share-buttons"><a href=x>Share</a></div><p>{LONG}</div>
<aside><p>{LONG}</aside><form><p>{LONG}<input value=">"></form><section class="comments"><p>{LONG}</section>
<footer>&copy; {LONG}</footer></body></html>"""


def test_page_without_marked_article():
    one = " ".join(LONG.split())
    assert hb.main_text(PAGE).split("\n") == [
        "The headline", one + " bold & more text", "Short one.", one + " " + one, one]


def test_marked_article_keeps_all_its_blocks():
    page = (f"<body><p>{LONG}</p><article><h1>Hd</h1><p>Qx %% zz</p><p><b>{LONG}<br></p><div class='ad'>{LONG}</div>"
            f"<p>a<br>b<br><br>c</p><ul><li>one<li>two</ul></article><p>{LONG}</p>")
    assert hb.main_text(page).split("\n") == ["Hd", "Qx %% zz", LONG.strip(), "a b", "c", "one", "two"]


def test_short_blocks_inherit_from_neighbours():
    def labels(*kinds):
        found = [hb.Block(LONG * 2 if k == "g" else "Short.", 0, k == "b", False, False) for k in kinds]
        return hb.second_pass(found, hb.first_pass(found))
    assert labels("g", "s", "g") == [True, True, True]
    assert labels("b", "s", "b") == [False, False, False]
    assert labels("g", "s", "s", "s", "b") == [True, True, True, False, False]
    assert labels("s", "s") == [False, False]


@pytest.mark.parametrize("text", [
    "Wczoraj wieczorem mieszkańcy miasteczka zebrali się przed ratuszem, żeby obejrzeć pokaz sztucznych ogni. " * 2,
    "Вчера вечером жители городка собрались перед ратушей, чтобы посмотреть большой праздничный фейерверк.",
    "Ieri sera gli abitanti della cittadina hanno guardato i fuochi davanti al municipio con molta gioia.",
    "昨天晚上，小镇的居民聚集在市政厅前观看盛大的烟火表演，孩子们都非常高兴，大家一直待到深夜。"])
def test_unmarked_page_in_an_unlisted_language(text):
    page = (f"<body><nav><a href=/>{text}</a></nav><div><p>{text}</p><p>{text}</p></div>"
            f"<p><a href=/x>{text}</a></p><footer>{text}</footer></body>")
    assert hb.main_text(page).split("\n") == [text.strip()] * 2


def test_blocks_without_stop_words_between_main_text_stay():
    code = "x[17] = 42; y[18] = 43; z[19] = 44; print(x, y, z); " * 3
    assert hb.main_text(f"<body><p>{LONG}</p><pre>{code}</pre><p>{LONG}</p>").split("\n")[1] == code.strip()


@pytest.mark.parametrize("wrapper", ['class="layout has-sidebar"', 'class="post with-comments"', 'id="search-result-page"', 'class="widget"'])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_what_holds_the_article_is_not_out_for_its_name(wrapper, tag):
    page = (f"<body><div {wrapper}><{tag}><p>{LONG}</p><p><a href=x>{LONG}</a></p><ul><li><a href=y>one</a><li><a href=z>two</a></ul>"
            f"<div class='share-buttons'>Share</div></{tag}><div class='comment-list'><article class='comment'><p>{LONG}</p></article></div></div>")
    assert hb.main_text(page).split("\n") == [LONG.strip(), LONG.strip(), "one", "two"]


def test_names_on_unmarked_pages():
    rest = f"<div class='left-sidebar'><p>{LONG}</p></div><div id='comments'>{f'<p>{LONG}</p>' * 9}</div>"
    assert hb.main_text(f"<body><div class='social-news'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></body>").count("story") == 3
    assert hb.main_text(f"<body><div class='page no-sidebar'><p>{LONG}</p></div>{rest}") == LONG.strip()
    assert hb.main_text("<p>Hello world.</p>") == "Hello world."
    assert hb.main_text("<nav>Menu</nav><p><a href=x>Link</a></p>") == ""


@pytest.mark.parametrize("piece", ["<div></span>", '<a x="', "<div><b></i>", "<div class='a b'><i>x</u></p>", "</div>", "<b><i></b>", '<a x=">', "<!-", "<p"])
def test_long_broken_pages_take_linear_time(piece):
    import time
    start = time.process_time()
    hb.main_text(piece * (5_000_000 // len(piece)))
    assert time.process_time() - start < 60


@pytest.mark.parametrize("tag", ["svg", "math"])
def test_self_closing_foreign_elements_are_empty(tag):
    assert hb.main_text(f'<p>{LONG}</p><{tag} class="i"/><p>{LONG}</p><{tag}><p>no</p></{tag}>') == "\n".join([LONG.strip()] * 2)


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!-- x", "</p></div>", "<script>x", "&am &#x41; &"])
def test_broken_pages(page):
    hb.main_text(page)


def test_articles_of_the_table(spark):
    rows = queries.queries()["op9_extract"](spark, SF_SMALL).collect()
    html = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    assert len(rows) == len(html)
    import html as h
    for r in rows:
        body = re.search(r"<article>(.*)</article>", html[r["page_id"]], re.S).group(1)
        want = [" ".join(h.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n".join(w for w in want if w) and r["n_chars"] == len(r["text"])


def test_edges(spark):
    rows = [(1, "u", None, 1), (1, "u", None, 1), (2, None, "", 2), (3, "v", f"<p>{LONG}</p>" * 3000, 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rank int")
    got = sorted(hb.extract(pages).collect())
    assert [r["text"] for r in got[:3]] == ["", "", ""] and got[3]["n_chars"] > 300_000 and got[3]["rank"] == 3
    assert hb.extract(pages.where("false")).count() == 0
