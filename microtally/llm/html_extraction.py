"""Main text of web pages, from what the pages of a host repeat and from their markup.

Every page goes through the suffix array of its host: the word streams of all its pages, marked articles
included, are cut into suffixes, sorted by their first ``RUN`` words, and neighbours that agree in these
are a repeat. As every repeat of ``RUN`` words or more is covered by repeats of exactly ``RUN`` words,
suffixes need not be longer. What stands outside marked articles and on a ``SHARE_OF``-th of the distinct
pages of the host, two at least, is boilerplate of pages that mark no article; what stands inside marked
articles, in more than one of ``ARTICLES_OF`` of them and in ``MIN_ARTICLES`` at least, is boilerplate of
articles.

The markup then checks what the array found. Outside elements are no part of the text. On a page that marks
its article nothing else is, and blocks of the article go only where boilerplate covers them whole: a passage
that stands in a longer block is the article's own. If half the words of an article would go, it is
one of many near copies, and all of it stays. On other pages the words that no repeat covers are the text.

A large host is sorted in groups of its pages, of about ``GROUP_PAGES`` pages or ``GROUP_SIZE`` characters. What
stands on a part of all pages stands on that part of a group's pages in one group at least, so the groups'
repeats are all that can be boilerplate, and these alone are counted again over the whole host.

Defined results
    null and empty html, and pages without text: an empty text. Null url: a host of its own.
    Pages of a host with the same words are one page to the array, whatever their urls, so copies of a
    page do not make its text boilerplate.
    Null id: kept. Empty table: no rows. Columns other than id, url and html are ignored.
    Very long and malformed pages: read whole, in time that grows with their length; a tag that never ends
    is text, an end tag without its start is passed over.
"""

import html as references
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from microtally.llm.registry import in_batches, query, read
from microtally.session import checkpointed, scratch_path

# Words that a repeat must have at least, the part of a host's pages it must stand on (one in so many,
# and two pages at least), the part of its marked articles (more than one in so many, and so many at
# least), pages sorted together and their characters (a task gets about as many), rows handed to Python at
# once, and suffixes sent to all tasks at most (more are joined by a shuffle).
RUN = 6
SHARE_OF = 10
MIN_PAGES = 2
ARTICLES_OF = 2
MIN_ARTICLES = 3
GROUP_PAGES = 500
GROUP_SIZE = 8_000_000
BATCH_ROWS = 256
BROADCAST_SUFFIXES = 500_000

# Elements by their part in a page. Text in SKIPPED elements is not text of the page,
# OUTSIDE elements are no part of an article, BLOCKS part blocks, VOID elements have no end.
SKIPPED = frozenset("script style noscript template svg math iframe object canvas audio video head title textarea select".split())
OUTSIDE = frozenset("nav header footer aside form menu dialog button fieldset".split())
BLOCKS = frozenset((
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead "
    "tr ul").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# Words of a class, id or role that tell what an element is for.
OUTSIDE_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist contentinfo consent cookie "
    "cookies discussion disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices notification "
    "pager pagination popup promo promoted promotion related replies reply search share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar widget").split())
# Words that may stand beside them in a name: "ad-slot" and "site-header" are outside, "has-sidebar",
# "comments-open" and "related-work" say something else.
BESIDE_WORDS = frozenset((
    "area article articles bar block body bottom box btn button buttons container entry global group holder icons inner item "
    "items left link links list main outer page panel post posts primary region right secondary section site slot stories text title "
    "top unit user wrap wrapper zone").split())
ARTICLE_WORDS = frozenset("articlebody".split())
# Elements that no class, id or role puts outside.
PAGE_ELEMENTS = frozenset("html body main article".split())

TAG = re.compile(r"""<(?:!--(?:.*?-->|.*)|[!?][^>]*+>|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>)""", re.S)
# What a tag starts with, the end of its name, and what decides where it ends.
TAG_START = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
NAME_END = re.compile(r"[\s/>]")
DECISIVE = re.compile(r"""[>"']""")
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def _is_outside(words):
    """Whether a name, as its words, is that of something outside an article."""
    rest = words - OUTSIDE_WORDS
    return len(rest) < len(words) and all(word in BESIDE_WORDS or word.isdigit() for word in rest)


def _purpose(name, attributes):
    """Whether an element is outside an article, and whether it is one."""
    outside, article = name in OUTSIDE, name in ("article", "main")
    if attributes:
        for found in ATTRIBUTE.finditer(attributes):
            value = found[2] or found[3] or found[4] or ""
            kind = found[1].lower()
            if kind == "itemprop":
                article = article or value.lower() in ARTICLE_WORDS
            elif kind == "aria-hidden":
                outside = outside or value.lower() == "true"
            elif kind != "hidden":
                names = [{word.lower() for word in NAME_WORD.findall(each)} for each in value.split()]
                outside = outside or name not in PAGE_ELEMENTS and any(map(_is_outside, names))
                article = article or (kind == "role" and {"main"} in names)
    return outside, article and not outside


class _Tags:
    """Finds the tags of a page in time that grows with its length, however many of them never end.

    A tag that does not match was looked through to its last quote in vain. The first one makes a table of
    where each decisive character leads, so that no later tag is looked through without a match.
    """

    def __init__(self, page):
        self.page = page
        self.last = page.rfind(">")
        self.ends = None
        self.name_end = -1

    def after(self, place):
        """The first tag at or after ``place``, or None."""
        while True:
            start = TAG_START.search(self.page, place)
            if start is None:
                return None
            place = start.start()
            if start[0] == "<!--" or place <= self.last and self._ends(place, start[0]):
                found = TAG.match(self.page, place)
                if found:
                    return found
                self._prepare()
            place += 1

    def _ends(self, place, start):
        if self.ends is None or start in ("<!", "<?"):
            return True
        if self.name_end <= place + 1:
            found = NAME_END.search(self.page, place + 1 + start.startswith("</"))
            self.name_end = found.start() if found else len(self.page)
        at = np.searchsorted(self.places, self.name_end)
        return at < len(self.ends) and self.ends[at]

    def _prepare(self):
        """For each decisive character outside quotes: whether the tag around it ends."""
        found = [(match.start(), match[0]) for match in DECISIVE.finditer(self.page)]
        self.places = np.array([place for place, _ in found], dtype=np.int64)
        self.ends = np.zeros(len(found) + 1, dtype=bool)
        partner = {}
        for at in range(len(found) - 1, -1, -1):
            kind = found[at][1]
            self.ends[at] = kind == ">" or kind in partner and self.ends[partner[kind] + 1]
            partner[kind] = at


def page_blocks(page):
    """Blocks of a page in order: ``(text, in_article, outside)``, where outside means no part of any article."""
    blocks, parts, open_elements, open_names = [], [], [], Counter()
    inside = outside = skipped = 0
    place, size = 0, len(page)
    tags = _Tags(page)

    def finish():
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            parts.clear()
            if text:
                blocks.append((text, inside > 0 and outside == 0, outside > 0))

    def close():
        nonlocal inside, outside, skipped
        element = open_elements.pop()
        open_names[element[0]] -= 1
        inside, outside, skipped = inside - element[1], outside - element[2], skipped - element[3]
        return element[0]

    while place < size:
        found = tags.after(place)
        if not skipped:
            parts.append(page[place:found.start() if found else size])
        if not found:
            break
        place = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            if open_names[name] > 0:
                finish()
                while close() != name:
                    pass
            elif name in BLOCKS:
                finish()
            continue
        if name in BLOCKS:
            finish()
            while open_elements and open_elements[-1][0] == "p" and name != "br":
                close()
        if name in VOID or found[3].endswith("/") and name not in BLOCKS:
            continue
        if name in ("script", "style", "textarea", "title", "noscript", "template"):
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, place)
            place = end.end() if end else size
            continue
        is_outside, is_article = _purpose(name, found[3])
        if is_outside and name == "header" and inside and not outside:
            is_outside = False  # the heading of an article is part of it
        if name in BLOCKS or is_outside or name in SKIPPED:
            if is_outside or is_article:
                finish()
            element = (name, int(is_article), int(is_outside), int(name in SKIPPED))
            open_elements.append(element)
            open_names[name] += 1
            inside, outside, skipped = inside + element[1], outside + element[2], skipped + element[3]
    finish()
    return blocks


class _WordHashes(dict):
    def __missing__(self, word):
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def _suffixes(text, kinds, hashes=None, run=RUN):
    """For each suffix of a page that has them, the hash of its first ``run`` words; its lowest bit tells whether
    all of these stand in a marked article."""
    words = _stream(text)
    size = len(words) - run + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    hashes = _WordHashes() if hashes is None else hashes
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    found = np.zeros(size, np.uint64)
    for at in range(run):
        found = found * np.uint64(0x9E3779B97F4A7C15) + each[at:at + size]
    other = np.repeat([kind != "a" for kind in kinds], [block.count(" ") + 1 for block in text.split("\n")])
    before = np.concatenate([[0], np.cumsum(other)])
    return (found >> np.uint64(1) << np.uint64(1) | (before[run:] == before[:-run]).astype(np.uint64)).view(np.int64)


def _stream(text):
    """The words of a page, from its blocks."""
    return text.replace("\n", " ").split(" ") if text else []


def _parts(page):
    """``(text, kinds)``: all blocks of a page, and for each ``a`` in a marked article, ``o`` outside, ``p`` neither."""
    blocks = page_blocks(page) if page else []
    return "\n".join(text for text, _, _ in blocks), "".join("a" if article else "o" if outside else "p" for _, article, outside in blocks)


def _spans(text, kinds, wanted):
    """First and last word of the blocks of a kind."""
    edges = np.cumsum([0] + [block.count(" ") + 1 for block in text.split("\n")]).tolist() if text else [0]
    return [span for span, kind in zip(zip(edges, edges[1:]), kinds) if kind == wanted]


def read_page(page):
    """``(text, words, spans)``: what the markup alone takes for the text, or None if it marks no article; the words of the
    whole page; and the blocks that may be text, as first and last word."""
    text, kinds = _parts(page)
    wanted = "a" if "a" in kinds else "p"
    spans = _spans(text, kinds, wanted)
    return (None if spans and wanted == "p" else _of_kind(text, kinds, wanted)), _stream(text), spans


def _of_kind(text, kinds, wanted):
    return "\n".join(block for block, kind in zip(text.split("\n"), kinds) if kind == wanted)


def _covered(words, repeated, run):
    covered = np.zeros(len(words) + 1, dtype=bool)
    for start in repeated:
        covered[start:start + run] = True
    return covered


def unmarked_text(words, spans, repeated, run=RUN):
    """The unique runs of the blocks: words that no repeat covers."""
    covered = _covered(words, repeated, run)
    kept = [" ".join(word for word, gone in zip(words[a:b], covered[a:b]) if not gone) for a, b in spans]
    return "\n".join(block for block in kept if block)


def marked_text(words, spans, repeated, run=RUN):
    """The blocks of an article that repeats do not cover whole, or all blocks if half its words would go."""
    covered = _covered(words, repeated, run)
    kept = [(a, b) for a, b in spans if not covered[a:b].all()]
    if 2 * sum(b - a for a, b in kept) <= sum(b - a for a, b in spans):
        kept = spans
    return "\n".join(" ".join(words[a:b]) for a, b in kept)


def _text(text, kinds, repeats):
    """Text of a page, given the suffixes that are boilerplate of its host."""
    marked = "a" in kinds
    wanted = "a" if marked else "p"
    if repeats is None or wanted not in kinds:
        return _of_kind(text, kinds, wanted)
    repeated = np.flatnonzero(np.isin(_suffixes(text, kinds), repeats))
    return (marked_text if marked else unmarked_text)(_stream(text), _spans(text, kinds, wanted), repeated)


def _repeats(frame, whole):
    """Suffixes that stand on the part of a group of pages that boilerplate must; of a whole host, exactly its boilerplate."""
    marked = frame["kinds"].str.contains("a").to_numpy(dtype=bool)
    pages, articles = frame["page"].nunique(), frame["page"][marked].nunique()
    hashes = _WordHashes()
    found = [_suffixes(text, kinds, hashes) for text, kinds in zip(frame["text"], frame["kinds"])]
    number = np.repeat(pd.factorize(frame["page"])[0], [len(each) for each in found])
    suffix = np.concatenate([np.zeros(0, np.int64), *found])
    order = np.lexsort((number, suffix))
    number, suffix = number[order], suffix[order]
    once = np.ones(len(suffix), dtype=bool)
    once[1:] = (suffix[1:] != suffix[:-1]) | (number[1:] != number[:-1])
    suffix, uses = np.unique(suffix[once], return_counts=True)
    inside = suffix & 1 == 1
    common = np.where(inside, uses * ARTICLES_OF > articles, uses * SHARE_OF >= pages)
    if whole:
        common &= uses >= np.where(inside, MIN_ARTICLES, MIN_PAGES)
        common &= inside | (not marked.all())
    return suffix[common]


def host_of(url):
    """Host of a url in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))


def _boilerplate(page):
    """One row per host that has any: the suffixes that are boilerplate."""
    @F.pandas_udf("binary")
    def packed(text: pd.Series) -> pd.Series:
        return text.map(lambda each: zlib.compress(each.encode(), 1))

    def of_group(key, frame):
        frame = frame.drop_duplicates(["page", "kinds"])
        frame = frame.assign(text=[zlib.decompress(each).decode() for each in frame["packed"]])
        return pd.DataFrame({"suffix": _repeats(frame, whole=pd.isna(key[1]))}).assign(host=key[0])[["host", "suffix"]]

    @F.pandas_udf("array<long>")
    def of_page(text: pd.Series, kinds: pd.Series) -> pd.Series:
        hashes = _WordHashes()
        return pd.Series([np.unique(_suffixes(*row, hashes)) for row in zip(text, kinds)], dtype=object)

    once = page.groupBy("host", "page").agg(
        F.max(F.length("text")).alias("size"), F.max("marked").alias("marked"), F.min("marked").alias("always"))
    hosts = once.groupBy("host").agg(
        F.sum("size").alias("size"), F.count("*").alias("pages"), F.count_if("marked").alias("articles"), F.min("always").alias("all_marked"))
    hosts = checkpointed(hosts.withColumn("parts", F.greatest(F.ceil(F.col("size") / GROUP_SIZE), F.floor(F.col("pages") / GROUP_PAGES))))
    tasks = 1 + (hosts.agg(F.sum("size")).first()[0] or 0) // GROUP_SIZE
    large = F.broadcast(hosts.filter("parts > 1"))
    first = page.filter("first").select("host", "page", "text", "kinds")
    grouped = first.join(large, "host", "left").select("host", F.pmod("page", "parts").alias("part"), "page", packed("text").alias("packed"), "kinds")
    grouped = grouped.repartition(tasks, "host", "part").groupBy("host", "part")
    found = checkpointed(grouped.applyInPandas(of_group, "host string, suffix long").distinct())

    inside = F.col("suffix").bitwiseAND(1) == 1
    asked = found.join(large, "host").filter(inside | ~F.col("all_marked")).select("host", "suffix")
    if asked.count() <= BROADCAST_SUFFIXES:
        asked = F.broadcast(asked)
    suffixes = first.join(large, "host", "left_semi").select("host", "page", F.explode(of_page("text", "kinds")).alias("suffix"))
    uses = suffixes.join(asked, ["host", "suffix"], "left_semi").distinct().groupBy("host", "suffix").agg(F.count("*").alias("uses"))
    enough = F.when(inside, (F.col("uses") * ARTICLES_OF > F.col("articles")) & (F.col("uses") >= MIN_ARTICLES)).otherwise(
        (F.col("uses") * SHARE_OF >= F.col("pages")) & (F.col("uses") >= MIN_PAGES))
    common = uses.join(large, "host").filter(enough).select("host", "suffix")
    common = checkpointed(found.join(large, "host", "left_anti").unionAll(common))
    repeats = common.groupBy("host").agg(F.collect_list("suffix").alias("repeats"))
    return F.broadcast(repeats) if common.count() <= BROADCAST_SUFFIXES else repeats


def main_text(pages, id="page_id", url="url", html="html"):
    """One row per row of ``pages``: ``page_id, url, text, n_chars``."""
    in_batches(pages.sparkSession, BATCH_ROWS)

    @F.pandas_udf("text string, kinds string, marked boolean, page long, first boolean")
    def parsed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        met = set()
        for hosts, values in batches:
            rows = []
            for host, html in zip(hosts, values):
                text, kinds = _parts(html)
                page = xxhash.xxh64_intdigest(host + "\n" + " ".join(_stream(text))) - (1 << 63)
                copy = page, hash(kinds)
                rows.append((text, kinds, "a" in kinds, page, copy not in met))
                met.add(copy)
            yield pd.DataFrame(rows, columns=["text", "kinds", "marked", "page", "first"])

    @F.pandas_udf("string")
    def kept(text: pd.Series, kinds: pd.Series, repeats: pd.Series) -> pd.Series:
        return pd.Series([_text(*row) for row in zip(text, kinds, repeats)], dtype=object)

    page = pages.select(F.col(id).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(html).cast("string").alias("html"))
    path = scratch_path(pages.sparkSession, "parsed-pages")
    page.select("page_id", "url", "host", parsed("host", "html").alias("p")).select("page_id", "url", "host", "p.*").write.option(
        "compression", "zstd").parquet(path)
    page = pages.sparkSession.read.parquet(path)
    text = page.join(_boilerplate(page), "host", "left").select("page_id", "url", kept("text", "kinds", "repeats").alias("text"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


@query("op6_html_extraction")
def op6_html_extraction(spark, sf_dir):
    """All pages with their main text."""
    return main_text(read(spark, sf_dir, "pages"))
