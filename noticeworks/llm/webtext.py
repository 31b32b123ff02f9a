"""Main text of web pages by consensus of the pages of a host.

Each page scores its containers: a container gets the text of the blocks right in it, less what is linked,
and half of what the containers in it get. The shares are votes for the container's generalised path (tags
and classes from the body down, digits as #), summed per host in Spark. The path with the most votes is the host's, and the
text of every page is taken again from the containers on it; a page that has no such container, or next
to nothing in it, takes its own best path.

Left out everywhere: scripts, styles and other unshown elements, navigation, forms, footers, asides, page headers, and
elements whose class, id or role says menu, header, sidebar, advert, comments or the like; words that articles are about as
well (share, alert, notice, legal) say so only in a name made of such words alone.

Defined results: null and empty pages have an empty text; a null url, or one without a host, belongs to a
host of its own, which votes for nothing; unclosed tags end with their parents; a tag cut off by the
page's end is dropped; pages of one id are read one by one.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import OWN, freed, written

# Kinds of elements and words in class names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title svg annotation select".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mstyle mover munder munderover semantics".split())
CONTAINERS = set("body main article section div td".split())
DROPPED = set("nav footer aside form button menu dialog head".split())
#: An opening tag (key) ends an open one of these kinds, if nothing of the second kinds stands between.
ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
#: Words that make an element no text wherever they stand in a class or id.
JUNK = set(
    "nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar footer bottombar sidebar aside widget widgets cookie cookies consent "
    "gdpr popup modal overlay newsletter subscribe subscription signup ad ads advert adverts advertisement advertising sponsor sponsored "
    "comment comments respond replies disqus pagination pager toolbar login".split()
)
#: Words that do so only in a name made of nothing but such words and COMPANIONS: "share-buttons", not "share-prices".
AMBIGUOUS = set("notice notices alert alerts banner promo promotion related recommended recommendations share sharing social search copyright legal skip hidden".split())
COMPANIONS = set(
    "bar block box boxes button buttons btn container content inner outer item items link links list wrap wrapper panel area section group row col icon icons "
    "site page top bottom left right main global message messages info text note post posts article articles story stories more this us on to js by and the".split()
) | {""}  # a number alone
GOOD = set("article content post entry story body text main".split())
ROLES = set("navigation banner contentinfo complementary search form menu dialog alert".split())
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: In the source itself: lower-casing changes the length of some texts.
RAW_END = {tag: re.compile("</" + tag, re.IGNORECASE | re.ASCII) for tag in RAW}
#: A longer path stands as its digest in the paths below it, so that deep nesting does not make long keys.
PATH_CHARS = 2000


class Page:
    """A page's containers and the text in them, in page order."""

    def __init__(self, source: str):
        self.parents, self.paths, self.bonus = [-1], [""], [1.0]  # per container; 0 is the page
        self.pieces: list[tuple[int, str, bool]] = []  # container, text (None: block ends), linked
        self._read(source)

    def _read(self, source: str) -> None:
        n, at = len(source), 0
        stack: list[tuple[str, int, bool, int]] = [("", 0, False, 0)]  # tag, container, dropped, nearest element that is not inline
        where: dict[str, list[int]] = {}  # places in the stack, by tag
        links = 0

        def close(size: int) -> None:
            nonlocal links
            while len(stack) > size:
                tag, inside, *_ = stack.pop()
                where[tag].pop()
                links -= tag == "a"
                if tag not in INLINE:
                    self.pieces.append((inside, None, False))

        while at < n:
            start = source.find("<", at)
            start = n if start < 0 else start
            if start > at and not stack[-1][2]:
                self.pieces.append((stack[-1][1], source[at:start], links > 0))
            if start == n:
                break
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                at = n if end < 0 else end + 3
                continue
            following = source[start + 1 : start + 2]
            if following in ("!", "?"):
                end = source.find(">", start)
                at = n if end < 0 else end + 1
                continue
            ending = following == "/"
            name = NAME.match(source, start + 1 + ending)
            if not name:
                if not stack[-1][2]:
                    self.pieces.append((stack[-1][1], "<", links > 0))
                at = start + 1
                continue
            end = _tag_end(source, name.end())
            if end < 0:
                break
            tag, at = name[0].lower(), end + 1
            if ending:
                if where.get(tag):
                    close(where[tag][-1])
                elif tag == "p":
                    self.pieces.append((stack[-1][1], None, False))
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    self.pieces.append((stack[-1][1], None, False))
                continue
            if tag in RAW:
                found = RAW_END[tag].search(source, at)
                end = source.find(">", found.end()) if found else -1
                at = n if end < 0 else end + 1
                continue
            if tag not in INLINE:
                self._end_implied(tag, stack, where, close)
            if source[end - 1] == "/":
                if tag not in INLINE:
                    self.pieces.append((stack[-1][1], None, False))
                continue
            inside, dropped = stack[-1][1], stack[-1][2]
            words, role, junk = _marks(source[name.end() : end]) if end > name.end() else ((), "", False)
            if not dropped and tag != "body" and tag != "html":
                in_article = where.get("article") or where.get("main")
                dropped = tag in DROPPED or role in ROLES or role == "-hidden" or tag == "header" and not in_article
                dropped = dropped or tag not in ("article", "main") and junk
            if tag in CONTAINERS and not dropped:
                label = tag + "".join("." + w for w in words)
                above = self.paths[inside]
                if len(above) > PATH_CHARS:
                    above = "~" + hashlib.sha256(above.encode("utf-8", "surrogatepass")).hexdigest()
                self.paths.append(f"{above}/{label}" if inside else label)
                self.parents.append(inside)
                self.bonus.append({"article": 1.5, "main": 1.3}.get(tag, 1.3 if role == "main" else 1.2 if any(w in GOOD for w in words) else 1.0))
                inside = len(self.paths) - 1
            if tag not in INLINE:
                self.pieces.append((inside, None, False))
            where.setdefault(tag, []).append(len(stack))
            stack.append((tag, inside, dropped, stack[-1][3] if tag in INLINE else len(stack)))
            links += tag == "a"

    @staticmethod
    def _end_implied(tag: str, stack: list, where: dict, close) -> None:
        if where.get("p") and tag not in ("html", "body"):
            size = stack[-1][3]
            if stack[size][0] == "p":
                close(size)
        if tag in ENDS:
            ends, barriers = (max((where[t][-1] for t in kinds if where.get(t)), default=0) for kinds in ENDS[tag])
            if ends > barriers:
                close(ends)

    def votes(self) -> dict[str, float]:
        """Share of the page's text, by container path."""
        own = [0.0] * len(self.paths)
        for at, text, linked in self.pieces:
            if text:
                n = len(text.strip())
                own[at] += -2 * n if linked else n
        score = [max(0.0, x) for x in own]
        for k in range(len(score) - 1, 0, -1):  # children come after their parents
            score[self.parents[k]] += score[k] / 2
        out: dict[str, float] = {}
        for path, s, b in zip(self.paths, score, self.bonus, strict=True):
            if path and s > 0:
                out[path] = out.get(path, 0.0) + s * b
        total = sum(out.values())
        return {p: v / total for p, v in out.items()}

    def text(self, path: str | None) -> str:
        """Text of the containers on ``path``, or of the page for None."""
        inside = [path is None or p == path for p in self.paths]
        for k in range(1, len(inside)):
            inside[k] = inside[k] or inside[self.parents[k]]
        parts = [" " if t is None else entities.unescape(t) for at, t, _ in self.pieces if inside[at]]
        return " ".join("".join(parts).split())

    def main_text(self, path: str | None) -> str:
        """Text by the host's path, where this page has most of its text there as well; else by its own best."""
        votes = self.votes()
        best = max(votes, key=lambda p: (votes[p], p), default=None)
        if path in votes and votes[path] >= 0.2 * votes[best]:
            best = path
        return self.text(best)


def _tag_end(source: str, at: int) -> int:
    """Where the tag ends that has its name before ``at``; quoted signs do not end it."""
    end, checked = source.find(">", at), at
    quote = ""
    while end >= 0:
        for m in re.finditer("[\"']", source[checked:end]):
            quote = "" if quote == m[0] else quote or m[0]
        if not quote:
            return end
        checked, after = end, source.find(quote, end)
        if after < 0:
            return end
        checked, quote = after + 1, ""
        end = source.find(">", checked)
    return -1


def _marks(attributes: str) -> tuple[list[str], str, bool]:
    """Words of class and id, digits as #, the role, and whether one of the names says that this is no text."""
    words, role, junk = [], "", False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            for name in value.split():
                own = [re.sub(r"\d+", "#", w) for w in re.split(r"[_-]+", name) if w]
                junk = junk or any(w in JUNK for w in own)
                junk = junk or any(w in AMBIGUOUS for w in own) and all(w in AMBIGUOUS or w.strip("#") in COMPANIONS for w in own)
                words += own
        elif key == "role":
            role = value.strip()
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            role = "-hidden"
    return words, role, junk


def host_of(url) -> F.Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with the most votes of each host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            sums: dict[tuple[str, str], float] = {}
            for host, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for path, v in Page(source).votes().items():
                    sums[host, path] = sums.get((host, path), 0.0) + v
            keys = list(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in keys], pa.string()), pa.array([p for _, p in keys], pa.string()), pa.array(list(sums.values()), pa.float64())],
                ["host", "path", "votes"],
            )

    rows = pages.select(host_of(F.col("url")).alias("host"), "html").filter("host <> '' AND html IS NOT NULL")
    votes = rows.mapInArrow(run, "host string, path string, votes double")
    votes = votes.groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    return votes.groupBy("host").agg(F.max_by("path", F.struct("votes", "path")).alias("path"))


def main_texts(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``pages`` (with url and html) and the main text of each page."""
    winners = written(host_paths(pages), "host-paths")  # written, so that its size decides the kind of join
    winners = winners.select(F.col("host").alias(OWN + "host"), F.col("path").alias(OWN + "path"))
    rows = pages.select(*keep, F.col("html").alias(OWN + "html"), host_of(F.col("url")).alias(OWN + "of"))
    rows = rows.join(winners, F.col(OWN + "of") == F.col(OWN + "host"), "left").select(*keep, OWN + "path", OWN + "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            *_, paths, sources = batch.columns
            texts = [Page(s).main_text(p) if s else "" for p, s in zip(paths.to_pylist(), sources.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], [*keep, text])

    return rows.mapInArrow(run, pages.select(*keep).schema.add(text, "string"))
