import time

import pytest
from hypothesis import given, settings, strategies as st

from microtally.llm import html_extraction, operators  # noqa: F401
from microtally.llm.html_extraction import page_blocks, read_page
from microtally.llm.registry import QUERIES
from tests.llm.cases import SF_DIR, table


def article(page):
    return read_page(page)[0]


@pytest.mark.parametrize("page, text", [
    ("<article><h1>Title</h1><p>One <b>two</b>\n three</p></article>", "Title\nOne two three"),
    ("<body><nav><a>Home</a></nav><article><p>Kept<p>also</article><footer>gone</footer>", "Kept\nalso"),
    ("<article>a &amp; b &lt;c&gt; &#233;&nbsp;&hellip;</article>", "a & b <c> é …"),
    ("<article>x<script>if (a < b) { '</p>' }</script>y<style>p{}</style>z</article>", "xyz"),
    ("<article>x<!-- <p>no</p> -->y<!-- > --></article>", "xy"),
    ("<article><p>text</p><div class='comments'><p>first!</p></div><aside>more</aside><form><input>f</form></article>", "text"),
    ("<article><p>text</p><section id='comment-list'>reply</section><div class='ad-slot'>buy</div></article>", "text"),
    ("<article><header><h1>Head</h1></header><p>text</p></article>", "Head\ntext"),
    ("<header>site</header><main><p>a</p><div role='navigation'>menu</div><p>b</p></main>", "a\nb"),
    ("<article><p title='a > b'>quoted</p><img alt=\"x>y\">after</article>", "quoted\nafter"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
    ("<article><p>cut off", "cut off"),
    ("<article><p>a<br>b<br/>c</p></article>", "a\nb\nc"),
    ("<article><textarea><article>typed</textarea>ok</article>", "ok"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>", "one\ntwo\nx\ny"),
    ("<article></article>", ""),
    ("", ""),
    ("just < text & more", None),
])
def test_articles(page, text):
    assert article(page) == text


def test_unclosed_elements_outside_do_not_swallow_the_article():
    assert article("<div class='ad'>buy<article>no</article></div><article><p>yes</p></article>") == "yes"


def test_entities_and_space_of_the_page_tables():
    for row in table("pages"):
        text, _, _ = read_page(row["html"])
        body = row["html"].split("<article>", 1)[1].split("</article>", 1)[0]
        assert "<" not in text.replace("<", "", text.count("<")) and "&amp;" not in text
        assert text.split("\n")[0] in " ".join(page_blocks("<article>" + body)[0][0].split())


def test_whole_table(spark):
    found = {row.page_id: (row.url, row.text, row.n_chars) for row in QUERIES["op6_html_extraction"](spark, SF_DIR).collect()}
    wanted = {}
    for row in table("pages"):
        text = read_page(row["html"])[0]
        wanted[row["page_id"]] = (row["url"], text, len(text))
    assert found == wanted


def plain_boilerplate(pages, run=html_extraction.RUN):
    """Brute force over all pairs of pages of a host: places covered by a repeat of ``run`` words."""
    streams = [(html_extraction_host(url), read_page(page)[1]) for url, page in pages]
    covered = []
    for n, (host, words) in enumerate(streams):
        grams = {tuple(other[k:k + run]) for m, (h, other) in enumerate(streams) if h == host and pages[m] != pages[n] for k in range(len(other) - run + 1)}
        covered.append([k for k in range(len(words) - run + 1) if tuple(words[k:k + run]) in grams])
    return covered


def html_extraction_host(url):
    return (url or "").split("//")[-1].split("/")[0].lower()


MENU = "<div>Home News Sport Weather Travel Culture Archive</div>"
PAGES = [
    ("http://a.example/1", f"<body>{MENU}<div>The first story is about a lighthouse keeper.</div><div>All rights reserved by the paper of the town</div>"),
    ("http://a.example/2", f"<body>{MENU}<div>A second story tells of two brothers.</div><div>All rights reserved by the paper of the town</div>"),
    ("http://a.example/2", f"<body>{MENU}<div>A second story tells of two brothers.</div><div>All rights reserved by the paper of the town</div>"),
    ("http://b.example/1", f"<body>{MENU}<div>Only page of its host.</div>"),
    ("http://a.example/3", f"<body><nav>{MENU}</nav><article><p>Marked</p></article>"),
    (None, "<p>no url</p>"), ("http://a.example/4", None), (None, None), ("http://a.example/5", ""),
]


def test_repeats_of_a_host_are_boilerplate(spark):
    frame = spark.createDataFrame([(n if n else None, *page, 1) for n, page in enumerate(PAGES)], "page_id long, url string, html string, text int")
    found = {row.page_id: (row.text, row.n_chars) for row in html_extraction.main_text(frame.repartition(3)).collect()}
    wanted = {}
    for n, (page, places) in enumerate(zip(PAGES, plain_boilerplate(PAGES))):
        text, words, spans = read_page(page[1])
        text = html_extraction.unmarked_text(words, spans, places) if text is None else text
        wanted[n if n else None] = (text, len(text))
    assert found == wanted
    assert found[None][0] == "The first story is about a lighthouse keeper." and found[4][0] == "Marked"
    assert found[1] == found[2] and found[3][0].startswith("Home News")


def test_empty_table(spark):
    assert html_extraction.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_long_page_is_read_whole():
    page = "<article>" + "".join(f"<p>line {n}</p>" for n in range(50_000)) + "</article>"
    assert article(page).count("\n") == 49_999


@pytest.mark.parametrize("page, text", [
    ('<body class="single-post has-sidebar"><article><p>kept</p></article></body>', "kept"),
    ('<article class="post comments-open"><p>kept</p></article>', "kept"),
    ('<div id="content-with-sidebar"><main><p>kept</p></main></div>', "kept"),
    ('<article><section class="related-work"><p>kept</p></section></article>', "kept"),
    ('<div class="content-sidebar-wrap"><main><p>kept</p></main></div>', "kept"),
    ('<body class="search"><main id="search" class="menu"><p>kept</p></main></body>', "kept"),
    ('<article><p>kept</p><div class="post-comments">no</div><div id="siteFooter2">no</div><div class="wide related-posts">no</div></article>', "kept"),
])
def test_only_whole_names_put_an_element_outside(page, text):
    assert article(page) == text


def test_a_class_of_the_body_leaves_the_blocks_to_the_array():
    text, words, spans = read_page('<body class="page has-sidebar"><div class="comments-open">three words here</div></body>')
    assert text is None and words == ["three", "words", "here"] and spans == [(0, 3)]


def texts_of(spark, pages):
    frame = spark.createDataFrame([(n, *page) for n, page in enumerate(pages)], "page_id long, url string, html string")
    return {row.page_id: row.text for row in html_extraction.main_text(frame.repartition(3)).collect()}


def test_an_article_at_two_urls_of_a_host_keeps_its_text(spark):
    story = "<div>The same long story stands here at two addresses of the paper</div>"
    found = texts_of(spark, [("http://a.example/1", story), ("http://a.example/1?print", f"<body>{story}"), ("http://b.example/1", story)])
    assert set(found.values()) == {"The same long story stands here at two addresses of the paper"}


def test_a_phrase_of_few_pages_of_a_large_host_stays(spark):
    phrase = "as we have said more than once before"
    pages = [(f"http://a.example/{n}", f"<body>{MENU}<div>{n} {phrase if n < 3 else 'x'} end {n}</div>") for n in range(40)]
    assert texts_of(spark, pages) == {n: f"{n} {phrase if n < 3 else 'x'} end {n}" for n in range(40)}


def test_copies_with_changing_markup_leave_the_menu_boilerplate(spark):
    pages = [(f"http://a.example/{n}", f"<body>{MENU}<div>{n} ends this story</div>") for n in range(9)]
    copies = [(f"http://a.example/c{n}", f"<body><!-- token {n} -->{MENU}<div>one story of many copies</div>") for n in range(150)]
    found = texts_of(spark, pages + copies)
    assert [found[n] for n in range(9)] == [f"{n} ends this story" for n in range(9)]
    assert {found[n] for n in range(9, 159)} == {"one story of many copies"}


@pytest.mark.parametrize("part, end", [
    ('<b "', ""), ("<a ", ""), ("</p ", ""), ("<!", ""), ("<?x", ""), ("<!-- ", ""), ("<a", ' "'), ("<b '\"", ">"), ("<div>", "</x>" * 200_000),
    ("<b title='x\"y\"", ""), ("<script>", ""), ("</div>", ""), ("<p>", ""),
])
def test_malformed_pages_take_time_in_proportion(part, end):
    page = part * (1_000_000 // len(part)) + end
    before = time.process_time()
    page_blocks(page)
    assert time.process_time() - before < 4


def plain_tags(page):
    """Tags as the pattern alone finds them."""
    return [found.span() for found in html_extraction.TAG.finditer(page)]


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="<>/!-?\"' ab=", max_size=40))
def test_tags_are_those_of_the_pattern(page):
    tags, place, found = html_extraction._Tags(page), 0, []
    while (tag := tags.after(place)) is not None:
        found.append(tag.span())
        place = tag.end()
    assert found == plain_tags(page)


NOTICE = "<div>Read every story of the paper in our free app</div>"


def marked(n, notice=NOTICE, host="a.example"):
    return f"http://{host}/{n}", f"<body><nav>{MENU}</nav><article><h1>Story {n}</h1><p>{n} begins and goes on for {n * n} more words until it ends</p>{notice}</article>"


def test_a_notice_that_articles_of_a_host_repeat_is_boilerplate_of_them(spark):
    found = texts_of(spark, [marked(n) for n in range(5)] + [marked(n, host="b.example") for n in range(2)])
    wanted = {n: f"Story {n}\n{n} begins and goes on for {n * n} more words until it ends" for n in range(5)}
    assert {n: found[n] for n in range(5)} == wanted
    assert found[5].endswith("\nRead every story of the paper in our free app")


def test_repeats_that_are_an_article_s_own_stay(spark):
    passage = "<p>{} said: Read every story of the paper in our free app, friends, {}</p>"
    copies = [f"<article><p>{' '.join(f'word{k}' for k in range(60))} end {n}</p><p>{n} and out</p></article>" for n in range(4)]
    pages = [marked(n, passage.format(n, n)) for n in range(4)]
    pages += [marked(n, NOTICE if n % 2 else "", "half.example") for n in range(8)]
    pages += [(f"http://copies.example/{n}", f"{page}<aside>{n}</aside>") for n, page in enumerate(copies)]
    pages += [(f"http://only.example/{n}", f"<i>{n}</i><article>{NOTICE}</article>") for n in range(4)]
    assert texts_of(spark, pages) == {n: article(page) for n, (_, page) in enumerate(pages)}


def plain_texts(pages, run=html_extraction.RUN):
    """Brute force over the runs of words of all distinct pages of each host, as words, without hashes and groups."""
    streams, found = {}, {}
    for url, page in pages:
        words = tuple((word, in_article) for text, in_article, _ in page_blocks(page) for word in text.split(" "))
        streams.setdefault(html_extraction_host(url), set()).add(words)
    for n, (url, page) in enumerate(pages):
        host = streams[html_extraction_host(url)]
        articles = sum(any(inside for _, inside in other) for other in host)
        text, words, spans = read_page(page)
        flags = [in_article for each, in_article, _ in page_blocks(page) for _ in each.split(" ")]
        runs = lambda stream: [(tuple(word for word, _ in stream[k:k + run]), all(i for _, i in stream[k:k + run])) for k in range(len(stream) - run + 1)]
        uses = {}
        for other in host:
            for each in set(runs(other)):
                uses[each] = uses.get(each, 0) + 1
        here = [uses[each] if each[1] == (text is not None) else 0 for each in runs(list(zip(words, flags)))]
        if text is None:
            found[n] = html_extraction.unmarked_text(words, spans, [k for k, c in enumerate(here) if c >= 2 and 10 * c >= len(host)])
        else:
            found[n] = html_extraction.marked_text(words, spans, [k for k, c in enumerate(here) if c >= 3 and 2 * c > articles])
    return found


@pytest.mark.parametrize("group, size, broadcast", [(500, 8_000_000, 500_000), (500, 400, 500_000), (7, 8_000_000, 0), (500, 40, 0)])
def test_groups_of_a_host_find_what_the_whole_host_repeats(spark, monkeypatch, group, size, broadcast):
    monkeypatch.setattr(html_extraction, "GROUP_PAGES", group)
    monkeypatch.setattr(html_extraction, "GROUP_SIZE", size)
    monkeypatch.setattr(html_extraction, "BROADCAST_SUFFIXES", broadcast)
    rare = "<div>as we have said more than once before</div>"
    pages = [marked(n, NOTICE if n % 5 else "") for n in range(25)] + [marked(3)] * 20 + [marked(n, NOTICE if n % 3 == 0 else "", "c.example") for n in range(9)]
    pages += [(f"http://{host}/u{n}", f"<body>{MENU}<div>{n} stands alone here</div>{rare if n < few else ''}")
              for host, many, few in (("a.example", 12, 2), ("b.example", 30, 6)) for n in range(many)]
    pages += [(None, f"<body>{MENU}{n}") for n in range(3)]
    found = texts_of(spark, pages)
    assert found == plain_texts(pages)
    assert found[1].count("\n") == 1 and found[48].endswith("app") and found[54].endswith("\nas we have said more than once before")
    assert found[66] == "0" and found[72] == "6 stands alone here"
