"""Main text of web pages, with the help of a suffix array over the pages of a host.

A host's pages become streams of words and tags. Long runs that stand on several pages are the host's
boilerplate: a suffix array over the joined streams shows them. The pages of a large host are cut into
groups of bounded size, whose runs are counted by their hashes over the whole host. What markup names as a menu, header, footer, sidebar, notice, advert, form or
comment goes. Of the rest, text inside an article or main element stays; text of pages without one
stays where it is in no repeated run.
"""

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialize

#: Words and tags that a run must have to count as repeated.
RUN = 16
#: Pages with different contents that must hold a run, on one host.
MIN_PAGES = 3
#: A block is boilerplate if this share of its words lies in repeated runs.
COVERED = 0.5
#: Bytes of html that a group has about; a host with more has several.
GROUP_BYTES = 1 << 20
#: Bytes of html whose runs are counted in one bucket, as long as there are no more than so many buckets.
_BUCKET_BYTES, _MOST_BUCKETS = 1 << 24, 4096

_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "tfoot thead tr ul".split())
_SPACED = frozenset(("td", "th", "img", "option"))
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is no markup.
_RAW = "script|style|title|textarea|noscript|noframes|noembed|iframe|xmp|template|svg|math|object|canvas|audio|video"
_DROPPED = frozenset("nav footer aside form menu dialog button select fieldset label datalist header".split())
_MAIN = frozenset(("article", "main"))
_NEVER = frozenset(("html", "body", "article", "main"))
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of class names and ids that mark what is not the article.
_NAMES = frozenset(
    "ad adbox ads adslot adunit adv advert adverts advertisement adsense banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies copyright disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice "
    "notification pager pagination popup promo promotion related reply replies respond share sharing sidebar signup "
    "skyscraper social sponsor sponsored subscribe toolbar topbar widget".split())
#: Words that may stand beside them; a name with any other word, as related-work, marks nothing.
_BESIDE = frozenset(
    "area bar block body bottom box button buttons btn col column container content cta desktop fixed float form global google "
    "group heading hidden holder icon icons id inline inner item items js label layer left link links list logo main media "
    "message mobile module outer overlay panel placeholder policy primary right row secondary section site slot small social "
    "space sticky strip sub tab text title toggle tools top unit ul view wrap wrapper x "
    "article articles entry page post posts products reading stories story topics videos".split())
#: With one of the first, one of the second names a part of the article or a layout.
_OWN = (frozenset(("header", "banner", "sidebar")), frozenset("article content entry main page post section story".split()))
_COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CELLS, _BODIES = frozenset(("td", "th")), frozenset(("tbody", "thead", "tfoot"))
_TABLE = _CELLS | _BODIES | {"table", "tr", "caption"}
_SPECIAL = (_BLOCK | _CELLS | {"button", "select", "search"}) - _VOID
#: Elements whose start ends an open paragraph.
_ENDS_P = _BLOCK - {"body", "html", "br", "caption", "legend", "tr", "summary", "dialog"} - _BODIES | {"dialog", "summary", "search"}
#: For an element, what of its kind its start ends, and where the search for that stops.
_ENDS = {
    **{n: (frozenset((n,)), _SPECIAL - {"address", "div", "p", "li"}) for n in ("li",)},
    **{n: (frozenset(("dt", "dd")), _SPECIAL - {"address", "div", "p", "dt", "dd"}) for n in ("dt", "dd")},
    **{n: (_CELLS, frozenset(("tr", "table"))) for n in _CELLS}, **{n: (_BODIES, frozenset(("table",))) for n in _BODIES},
    "tr": (frozenset(("tr",)), frozenset(("table",))), "a": (frozenset(("a",)), _SPECIAL),
    "option": (frozenset(("option",)), _SPECIAL),
    **{n: (frozenset(("p",)), frozenset(("table", "td", "th", "caption", "button"))) for n in _ENDS_P - {"li", "dt", "dd"}},
}
_P = _ENDS["p"]
#: Where prose does not begin; an element that is never closed is dropped up to another block.
_LISTS = frozenset("ul ol li dl dt dd menu hr br fieldset legend".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

Block = tuple[list[str], bool, bool]


def _marked(value: str) -> frozenset[str]:
    """The words of a class name or id, of one of its names that marks what is not the article."""
    for name in _CAMEL.sub("-", value).lower().split():
        parts = frozenset(_PARTS.findall(name))
        names = parts & _NAMES
        if names and parts <= _NAMES | _BESIDE and not (names <= _OWN[0] and parts & _OWN[1]):
            return parts
    return frozenset()


def _unwanted(name: str, attributes: str, in_main: bool) -> int:
    """Whether an element is named as something other than the article: 0 no, 1 yes, 2 as comments."""
    if name in _NEVER:
        return 0
    found = int(name in _DROPPED and not (name == "header" and in_main))
    for kind, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        kind, value = kind.lower(), next((v for v in values if v), "")
        if kind == "hidden" or kind == "aria-hidden" and value.lower() == "true":
            found = found or 1
        if kind == "role" and value.lower() in _ROLES:
            found = found or 1
        if kind == "class" or kind == "id" and name not in _HEADINGS:
            marks = _marked(value)
            if marks:
                found = max(found, 1 if _COMMENTS.isdisjoint(marks) else 2)
    return found


def _ends(tags: list[tuple[str, bool]]) -> list[int]:
    """For each start tag the number of the tag that ends its element, -1 if none does.

    It is the end tag, the end of a parent, or a start tag that HTML lets stand for the end tag.
    """
    ends = [-1] * len(tags)
    stack: list[tuple[str, int]] = []
    count: dict[str, int] = {}

    def end(names: frozenset[str], stops: frozenset[str], i: int) -> None:
        if not any(count.get(n) for n in names):
            return
        for at in range(len(stack) - 1, -1, -1):
            name = stack[at][0]
            if name in names:
                for open_name, start in stack[at:]:
                    ends[start] = i
                    count[open_name] -= 1
                del stack[at:]
                return
            if name in stops:
                return

    for i, (name, closing) in enumerate(tags):
        if name in _VOID and not closing and name == "hr":
            end(*_P, i)
        if name in _VOID or name in ("html", "head", "body"):
            continue
        if closing:
            if name in _HEADINGS:
                end(_HEADINGS, _SPECIAL - _HEADINGS, i)
            else:
                stops = _SPECIAL if name not in _SPECIAL else frozenset(("table",)) if name in _TABLE else \
                    _CELLS | {"table", "caption"} if name != "li" else _CELLS | {"table", "caption", "ul", "ol"}
                end(frozenset((name,)), stops - {name}, i)
            continue
        if name in _ENDS:
            end(*_ENDS[name], i)
        if name in ("li", "dt", "dd"):
            end(*_P, i)
        if name in _BODIES:
            end(*_ENDS["tr"], i)
        if name in _HEADINGS and stack and stack[-1][0] in _HEADINGS:
            end(_HEADINGS, _SPECIAL - _HEADINGS, i)
        stack.append((name, i))
        count[name] = count.get(name, 0) + 1
    return ends


def blocks_of(page: str | None) -> tuple[list[Block], list[str]]:
    """The page's blocks (words, inside an article or main element, unwanted) and its tags in order.

    The tags are one for each block, the element that it begins with. An unwanted element that nothing
    ends is dropped up to the next block that is no list, footers and comments to the end of the page.
    """
    page = page or ""
    blocks: list[Block] = []
    starts: list[str] = []
    text: list[str] = []
    main, main_before, dropping, until, last, tag = 0, 0, 0, 0, 0, "<>"
    tokens = list(_TOKEN.finditer(page))
    tags = [(found["name"].lower(), bool(found["close"])) for found in tokens if found["name"]]
    ends = _ends(tags)

    def end_block() -> None:
        words = "".join(text).split()
        if words:
            blocks.append((words, main > 0, bool(dropping)))
            starts.append(tag)
        text.clear()

    def end_of(i: int, kind: int) -> int:
        if ends[i] >= 0:
            return ends[i]
        if kind < 2 and tags[i][0] != "footer":
            for j in range(i + 1, len(tags)):
                name, closing = tags[j]
                if not closing and name in _BLOCK and name not in _LISTS:
                    return j
        return len(tags)

    i = -1
    for found in tokens:
        if found.start() > last:
            text.append(html.unescape(page[last:found.start()]))
        last = found.end()
        if found["name"] is None:
            continue
        i += 1
        name, closing = tags[i]
        if dropping and i >= until:
            end_block()
            dropping, main = 0, main_before
        if name in _BLOCK:
            end_block()
            tag = f"<{name}>"
        elif name in _SPACED:
            text.append(" ")
        if name in _MAIN:
            if closing:
                main = max(0, main - 1)
            else:
                main += 1
                # Readers' comments are articles too; around another article something unwanted is a mistake.
                if not (dropping == 2 and name == "article" and until < len(tags)):
                    dropping = 0
        if not dropping and not closing and name not in _VOID:
            dropping = _unwanted(name, found["attributes"], main > 0)
            if dropping:
                if text and name not in _BLOCK:
                    dropped, dropping = dropping, 0
                    end_block()
                    dropping = dropped
                until, main_before = end_of(i, dropping), main
    text.append(html.unescape(page[last:]))
    end_block()
    return blocks, starts


def repeated(ids: np.ndarray, pages: np.ndarray, run: int = RUN, min_pages: int = MIN_PAGES,
             starts: np.ndarray | None = None) -> np.ndarray:
    """Which tokens lie in a run of ``run`` tokens that stands on ``min_pages`` different pages.

    The suffix array is sorted by the first ``run`` tokens, doubling the sorted length each time; longer
    repeats are the union of their runs. Runs do not reach from one page into the next, and begin only
    at ``starts``, if given.
    """
    n = len(ids)
    covered = np.zeros(n + 1, np.int64)
    if n < run:
        return covered[:n].astype(bool)
    rank, length = ids.astype(np.int64), 1
    while length < run:
        step = min(length, run - length)
        behind = np.full(n, -1, np.int64)
        behind[:n - step] = rank[step:]
        _, rank = np.unique(rank * (rank.max() + 2) + behind + 1, return_inverse=True)
        length += step
    whole = np.zeros(n, bool)
    whole[:n - run + 1] = pages[:n - run + 1] == pages[run - 1:]
    if starts is not None:
        whole &= starts
    suffix = np.lexsort((pages, rank))
    suffix = suffix[whole[suffix]]
    r, p = rank[suffix], pages[suffix]
    fresh = np.ones(len(r), bool)
    fresh[1:] = (r[1:] != r[:-1]) | (p[1:] != p[:-1])
    many = np.bincount(r[fresh], minlength=rank.max() + 1) >= min_pages
    at = suffix[many[r]]
    np.add.at(covered, at, 1)
    np.add.at(covered, at + run, -1)
    return np.cumsum(covered[:n]) > 0


class _Stream(NamedTuple):
    """The different contents of pages, one after the other, as numbers of tags and words."""

    ids: np.ndarray
    #: The content of each number.
    owner: np.ndarray
    #: Where runs may begin.
    starts: np.ndarray
    #: What the numbers stand for.
    words: list[str]
    #: Where each content's first block begins.
    begins: list[int]
    contents: list[str]
    #: The content of each page.
    which: list[int]


def _stream(parsed: list[tuple[list[Block], list[str]]], run: int = RUN) -> _Stream:
    """Copies of a page are one content, so that they show no repeated runs.

    Each content has ``run - 1`` marks before and behind it. A run holds some of them if whole blocks at
    the edge of the page make it up, so these may be shorter than a run.
    """
    words: dict[str, int] = {"": 0, " ": 1}
    contents: dict[str, int] = {}
    ids, lengths, begins, starts, which = [], [], [], [], []
    for blocks, tags in parsed:
        content = "\n".join([f"{tag} {' '.join(block)}" for (block, _, _), tag in zip(blocks, tags)])
        which.append(contents.setdefault(content, len(contents)))
        if which[-1] < len(begins):
            continue
        before = len(ids)
        ids.extend([0] * (run - 1))
        begins.append(len(ids))
        may = np.zeros(sum(len(block) + 1 for block, _, _ in blocks) + 2 * (run - 1), bool)
        may[run - 1:max(run - 1, len(may) - 2 * (run - 1))] = True
        for (block, _, _), tag in zip(blocks, tags):
            may[len(ids) - before] = True
            ids.append(words.setdefault(tag, len(words)))
            ids.extend([words.setdefault(w, len(words)) for w in block])
            may[max(0, len(ids) - before - run)] |= len(ids) - before < 2 * run - 1
        ids.extend([1] * (run - 1))
        lengths.append(len(ids) - before)
        starts.append(may)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return _Stream(np.array(ids, np.int64), owner, np.concatenate(starts) if starts else np.zeros(0, bool),
                   [*words], begins, [*contents], which)


def _hashes(stream: _Stream, host: str, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of ``run`` tokens begin, and 64 bits of each run and its host."""
    count = max(0, len(stream.ids) - run + 1)
    known = pd.util.hash_array(np.array([host, *stream.words], object), categorize=False)
    tokens, mixed = known[1:][stream.ids], np.full(count, known[0])
    for j in range(run):
        mixed = (mixed ^ tokens[j:j + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    owner = stream.owner
    at = np.flatnonzero((owner[:count] == owner[len(owner) - count:]) & stream.starts[:count])
    return at, mixed[at]


def _texts(parsed: list[tuple[list[Block], list[str]]], stream: _Stream, repeats: np.ndarray) -> list[str]:
    covered = np.concatenate([[0], np.cumsum(repeats)])
    texts = []
    for (blocks, _), content in zip(parsed, stream.which):
        has_main, at = _has_main(blocks), stream.begins[content]
        kept = []
        for block, in_main, unwanted in blocks:
            share = (covered[at + 1 + len(block)] - covered[at + 1]) / len(block)
            at += len(block) + 1
            if not unwanted and (in_main if has_main else share < COVERED):
                kept.append(" ".join(block))
        texts.append("\n".join(kept))
    return texts


def _has_main(blocks: list[Block]) -> bool:
    return any(in_main and not unwanted for _, in_main, unwanted in blocks)


def main_texts(pages: list[str | None], host: str = "", known: np.ndarray | None = None) -> list[str]:
    """The main text of each page of a group from one host.

    ``known`` has the hashes of the runs that are repeated on the host; without it the pages are all
    that the host has.
    """
    parsed = [blocks_of(page) for page in pages]
    stream = _stream(parsed)
    if known is None:
        return _texts(parsed, stream, repeated(stream.ids, stream.owner, starts=stream.starts))
    at, hashes = _hashes(stream, host)
    at = at[np.isin(hashes, known)]
    covered = np.zeros(len(stream.ids) + 1, np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + RUN, -1)
    return _texts(parsed, stream, np.cumsum(covered[:-1]) > 0)


def runs_of(pages: list[str | None], host: str) -> tuple[np.ndarray, np.ndarray]:
    """The group's runs by their hashes, sorted, each with the contents that hold it, ``MIN_PAGES`` at most."""
    stream = _stream([blocks_of(page) for page in pages])
    at, hashes = _hashes(stream, host)
    names = pd.util.hash_array(np.array(stream.contents, object), categorize=False)
    holders = (names >> np.uint64(32)).astype(np.uint32)[stream.owner[at]]
    order = np.lexsort((holders, hashes))
    hashes, holders = hashes[order], holders[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (holders[1:] != holders[:-1])
    hashes, holders = hashes[first], holders[first]
    few = np.ones(len(hashes), bool)
    few[MIN_PAGES:] = hashes[MIN_PAGES:] != hashes[:-MIN_PAGES]
    return hashes[few], holders[few]


def repeated_runs(groups: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Of each group's runs, as from ``runs_of``, those that ``MIN_PAGES`` contents of all groups hold."""
    hashes = np.concatenate([h for h, _ in groups])
    _, number = np.unique(hashes, return_inverse=True)
    pairs = np.unique(number.astype(np.uint64) << np.uint64(32) | np.concatenate([p for _, p in groups]))
    many = np.bincount((pairs >> np.uint64(32)).astype(np.int64))[number] >= MIN_PAGES
    ends = np.cumsum([len(h) for h, _ in groups])[:-1]
    return [np.unique(h[m]) for (h, _), m in zip(groups, np.split(many, ends))]


def _hosts(rows: DataFrame) -> DataFrame:
    """Each host's bytes of html and whether any of its pages has no article or main element."""

    def facts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"h": frame["host"], "size": [len((page or "").encode()) for page in frame["html"]],
                                "plain": [not _has_main(blocks_of(page)[0]) for page in frame["html"]]})

    return rows.select("host", "html").mapInPandas(facts, "h string, size long, plain boolean") \
        .groupBy("h").agg(F.sum("size").alias("size"), F.max("plain").alias("plain"))


def extract(pages: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row.

    A host with more than ``group_bytes`` of html has several groups. If it has a page without an
    article or main element, the groups send the hashes of all their runs to buckets, which count the
    contents of the whole host and send back the repeated ones; other hosts need no runs.

    Null and empty html give an empty text; a null url is a host of its own; null ids and repeated rows
    are pages like any other; an empty table gives no rows; extra columns are ignored. Copies, that is
    pages with the same words and tags, count as one page when repeated runs are looked for.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col("url").cast("string"), r"^[^:/?#]+://([^/?#]*)", 1), F.lit("")))
    rows = pages.select(F.col("page_id").cast("long").cast("string").alias("page_id"),
                        F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"))
    large = materialize(_hosts(rows).where(F.col("size") > group_bytes), "large-hosts")
    groups = F.coalesce(F.ceil(F.col("size") / group_bytes), F.lit(1)).cast("long")
    dealt = rows.join(large, F.col("host") == F.col("h"), "left") \
        .withColumn("part", F.pmod(F.xxhash64("page_id", "url", "html"), groups)) \
        .withColumn("shared", F.coalesce("plain", F.lit(False))).drop("h", "size", "plain")
    keys, shape = ["host", "part"], "page_id string, url string, text string"

    def texts(frame: pd.DataFrame, known: np.ndarray | None = None) -> pd.DataFrame:
        found = main_texts(list(frame["html"]), frame["host"].iloc[0] if len(frame) else "", known)
        return pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": found})

    shared_bytes = large.where("plain").agg(F.sum("size")).first()[0]
    if shared_bytes:
        # All uses of a group read the same rows of all columns, so Spark shuffles the pages once.
        buckets = min(_MOST_BUCKETS, -(-shared_bytes // _BUCKET_BYTES))

        def runs(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            out = []
            if frame["shared"].iloc[0]:
                hashes, holders = runs_of(list(frame["html"]), key[0])
                bucket = (hashes % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                ends = np.cumsum(np.bincount(bucket, minlength=buckets))[:-1]
                for b, (h, p) in enumerate(zip(np.split(hashes[order], ends), np.split(holders[order], ends))):
                    if len(h):
                        out.append((b, *key, h.tobytes(), p.tobytes()))
            return pd.DataFrame(out, columns=["bucket", *keys, "hashes", "holders"])

        def counted(frame: pd.DataFrame) -> pd.DataFrame:
            found = repeated_runs([(np.frombuffer(h, np.uint64), np.frombuffer(p, np.uint32))
                                   for h, p in zip(frame["hashes"], frame["holders"])])
            answer = frame[keys].assign(hashes=[h.tobytes() for h in found])
            return answer[[len(h) > 0 for h in found]]

        def shared_texts(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
            if len(frame) and frame["shared"].iloc[0]:
                return texts(frame, np.frombuffer(b"".join(answers["hashes"]), np.uint64))
            return texts(frame)

        sent = dealt.groupBy(*keys).applyInPandas(runs, "bucket long, host string, part long, hashes binary, holders binary")
        answers = sent.groupBy("bucket").applyInPandas(counted, "host string, part long, hashes binary")
        done = dealt.groupBy(*keys).cogroup(answers.groupBy(*keys)).applyInPandas(shared_texts, shape)
    else:
        done = dealt.groupBy(*keys).applyInPandas(lambda frame: texts(frame), shape)
    return done.select(F.col("page_id").cast("long").alias("page_id"), "url", "text",
                       F.char_length("text").cast("long").alias("n_chars"))
