"""Main text of web pages by tag-path ratios.

The texts of a page are grouped by their path of tags from the root. Long texts with much punctuation share few paths,
short ones without share others, so the length and the punctuation per text of a path, smoothed along the page, fused
and compared with a threshold, tell the core of the article. The article is what stands around that core: of the deepest
container that holds all of it the parts with a path above the threshold, or a heading. An article element is taken as a
whole. What reads like an article but is none (readers' comments, adverts, notices) no ratio tells apart; there the names
that a page gives to its parts are heard, and elsewhere only together with a low ratio.

A page is read in one pass, and what is asked of the ancestors or the contents of an element is summed up along the page,
so the work grows with the page, however deeply it is nested.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from surveyflow.llm.common import buffered, narrow, table, text_rows

# Fixed values of HTML: elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
SKIPPED = frozenset(
    "script style noscript template svg math iframe object canvas audio video head title nav footer aside button "
    "select option textarea label fieldset dialog menu".split()
)
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre figure figcaption address hr".split())
HEADINGS = frozenset("h1 h2".split())
ANCHORS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY_BLOCK = frozenset("p".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table body html article section main div".split())

#: Parts of class, id and role names that tell what isn't the article, without accents, in the languages of the pages.
OTHER = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay nav navbar navigation menu menubar header masthead topbar footer "
    "sidebar aside complementary contentinfo search comment comments reply replies discussion disqus form login signup "
    "subscribe subscription newsletter share sharing social related recommended breadcrumb breadcrumbs pagination pager "
    "widget toolbar feedback "
    "werbung anzeige anzeigen reklame gesponsert hinweis hinweise meldung menue kopfzeile fusszeile seitenleiste suche "
    "antwort antworten leserbriefe teilen anmelden anmeldung verwandt "
    "publicite pub annonce annonces sponsorise avis entete pied lateral laterale recherche reponse reponses partager "
    "connexion abonnement apparente "
    "publicidad anuncio anuncios patrocinado aviso avisos menus cabecera pie barra buscar busqueda respuesta respuestas "
    "compartir suscripcion relacionado relacionados".split()
)
#: How names of readers' comments, of adverts and of notices begin or read: their text may be prose like that of an article.
COMMENT_STEMS = ("comment", "komment", "coment")
APART = frozenset(
    "reply replies disqus feedback antworten leserbriefe reponses respuestas advert adverts advertisement advertising "
    "sponsored werbung anzeige anzeigen reklame gesponsert publicite annonce annonces sponsorise publicidad anuncio "
    "anuncios patrocinado cookie cookies gdpr notice hinweis avis aviso avisos".split()
)
#: Parts of names that may stand beside those.
BESIDE = frozenset("list liste lista section seccion area bereich zone thread threads wrapper box block container bar".split())
NAME_PARTS = re.compile(r"[a-z]+|[A-Z]+[a-z]*")
SPACE = re.compile(r"\s+")
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")


@dataclass(frozen=True)
class PathRule:
    #: Smoothing along the page: weights of a text and its neighbours.
    kernel: tuple[float, ...] = (0.25, 0.5, 0.25)
    #: A text belongs to the core from this part of the mean of all fused ratios on.
    threshold: float = 0.5
    #: A form, and on a page without an article element a part that its name calls something else (but no comments, adverts
    #: or notices), may hold the core if it has more than this share of the text.
    named: float = 0.5
    #: A block with a larger share of link text is no part of the core.
    links: float = 0.6


@dataclass
class Block:
    element: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return SPACE.sub(" ", "".join(self.parts)).strip()


def _plain(name: str) -> str:
    return name if name.isascii() else unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()


def _apart(name: str) -> bool:
    """Whether a name says comments, advert or notice and nothing else."""
    words = {w.lower() for w in NAME_PARTS.findall(name)}
    telling = {w for w in words if w in APART or (w.startswith(COMMENT_STEMS) and w != "commentary")}
    return bool(telling) and words - telling <= BESIDE


class PageReader(HTMLParser):
    """Elements and text blocks of a page, in page order: children come after their parents."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.paths = ["#"], [-1], [0]
        self.skip, self.other, self.apart, self.in_article = [False], [False], [False], [False]
        self.known_paths: dict[tuple[int, str], int] = {}
        self.stack, self.links = [0], 0
        self.open: Counter[str] = Counter()
        self.blocks: list[Block] = []
        self.current: Block | None = None

    def close_from(self, depth: int) -> None:
        self.open.subtract(self.tags[e] for e in self.stack[depth:])
        del self.stack[depth:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.handle_data(" ")
            return
        if tag in INLINE:
            self.links += tag == "a"
            return
        self.current = None
        if tag in VOID:
            return
        ended = SIBLINGS.get(tag, CLOSED_BY_BLOCK) | CLOSED_BY_BLOCK
        if any(self.open[name] > 0 for name in ended):
            for depth in range(len(self.stack) - 1, 0, -1):
                name = self.tags[self.stack[depth]]
                if name in ended:
                    self.close_from(depth)
                    if tag not in SIBLINGS:
                        break
                elif name in SCOPES:
                    break
        names = [_plain(v) for k, v in attrs if v and k in ("class", "id", "role", "aria-label")]
        parts = {p.lower() for v in names for p in NAME_PARTS.findall(v)}
        hidden = any(k == "hidden" or (k == "style" and v and "display:none" in v.replace(" ", "")) for k, v in attrs)
        above = self.stack[-1]
        apart = any(_apart(n) for v in names for n in v.split())
        self.tags.append(tag)
        self.parents.append(above)
        self.paths.append(self.known_paths.setdefault((self.paths[above], tag), len(self.known_paths) + 1))
        self.skip.append(self.skip[above] or tag in SKIPPED or hidden or (tag == "header" and not self.in_article[above]))
        self.other.append(apart or not parts.isdisjoint(OTHER))
        self.apart.append(apart)
        self.in_article.append(self.in_article[above] or tag in ("article", "main"))
        self.stack.append(len(self.tags) - 1)
        self.open[tag] += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in INLINE:
            self.links = max(0, self.links - (tag == "a"))
            return
        self.current = None
        if self.open[tag] > 0:
            depth = len(self.stack) - 1
            while self.tags[self.stack[depth]] != tag:
                depth -= 1
            self.close_from(depth)

    def handle_data(self, data: str) -> None:
        if self.current is None:
            self.current = Block(self.stack[-1])
            self.blocks.append(self.current)
        self.current.parts.append(data)
        if self.links:
            self.current.linked += len(data.strip())

    def sums(self, values: Iterable[tuple[int, float]]) -> list[float]:
        """For each element the total of the values at it and below."""
        total = [0] * len(self.tags)
        for element, value in values:
            total[element] += value
        for element in range(len(self.tags) - 1, 0, -1):
            total[self.parents[element]] += total[element]
        return total

    def below(self, marked: Iterable[int]) -> list[bool]:
        """Whether each element is one of ``marked`` or inside one."""
        flags = [False] * len(self.tags)
        for element in marked:
            flags[element] = True
        for element in range(1, len(self.tags)):
            flags[element] |= flags[self.parents[element]]
        return flags

    def line(self, element: int) -> list[int]:
        """From the root to the element itself."""
        out = []
        while element >= 0:
            out.append(element)
            element = self.parents[element]
        return out[::-1]


def fused_ratios(paths: list[int], texts: list[str], rule: PathRule) -> np.ndarray:
    """For each text, smoothed length per text of its path times smoothed punctuation per text of its path."""
    totals: dict[int, list[int]] = defaultdict(lambda: [0, 0, 0])
    for path, text in zip(paths, texts):
        total = totals[path]
        total[0] += 1
        total[1] += len(text)
        total[2] += len(PUNCTUATION.findall(text))
    reach = len(rule.kernel) // 2

    def smooth(values: list[float]) -> np.ndarray:
        return np.convolve(np.pad(values, reach, mode="edge"), rule.kernel, mode="valid")

    length = smooth([totals[p][1] / totals[p][0] for p in paths])
    marks = smooth([totals[p][2] / totals[p][0] for p in paths])
    return length * (1 + marks)


def container(reader: PageReader, core: list[tuple[int, int]], heads: Iterable[int]) -> int:
    """The deepest element, no leaf block, that holds all of the core (element, length); an article or else a main around
    it goes before, and a heading right beside it comes with it."""
    held, need, at = reader.sums(core), sum(n for _, n in core), 0
    for e in range(1, len(reader.tags)):  # what holds all of the core is one line of elements
        if held[e] >= need:
            if reader.tags[e] in LEAVES:
                break
            at = e
    way = reader.line(at)
    for tag in ("article", "main"):
        for e in way:
            if reader.tags[e] == tag:
                return e
    above = way[-2] if len(way) > 1 else 0
    headed = any(e != at and reader.parents[e] == above for e in heads)
    return above if headed and reader.tags[above] not in ("body", "html", "#") else at


def main_text(html: str, rule: PathRule = PathRule()) -> str:
    """The article's blocks, joined by a line feed; empty if the page has none."""
    reader = PageReader()
    reader.feed(html)
    reader.close()
    elements = range(len(reader.tags))
    found = [
        (block.element, text, block.linked / len(text))
        for block in reader.blocks if not reader.skip[block.element] and (text := block.text)
    ]

    unlinked = reader.sums((e, len(text) if linked <= rule.links else 0) for e, text, linked in found)
    asked = reader.below(e for e in elements if reader.tags[e] == "form" and unlinked[e] <= rule.named * unlinked[0])
    found = [x for x in found if not asked[x[0]]]
    share = reader.sums((e, len(text)) for e, text, _ in found)
    marked = [e for e in elements if reader.tags[e] in ("article", "main") and share[e]]
    around = set()
    for e in marked:
        while e >= 0 and e not in around:
            around.add(e)
            e = reader.parents[e]

    def elsewhere(e: int) -> bool:
        """Whether a name tells that the element is something else."""
        if e in around or not reader.other[e]:
            return False
        return bool(marked) or reader.apart[e] or share[e] <= rule.named * share[0]

    left_out = [e for e in elements if share[e] and elsewhere(e)]
    out = reader.below(left_out)
    plain = [x for x in found if not out[x[0]] and x[2] <= rule.links]
    if not plain:
        inside = reader.below(marked)
        plain = [x for x in found if inside[x[0]]]
    if not plain:
        return ""

    ratios = fused_ratios([reader.paths[e] for e, *_ in plain], [text for _, text, _ in plain], rule)
    least = rule.threshold * ratios.mean()
    core = [(e, len(text)) for (e, text, _), ratio in zip(plain, ratios) if ratio >= least]
    at = container(reader, core, (e for e, *_ in plain if reader.tags[e] in HEADINGS))
    under = reader.below([at])
    inside = [x for x in found if under[x[0]]]
    # a path's own ratio, which neighbours have no part in, selects the parts of the container
    own = fused_ratios([reader.paths[e] for e, *_ in inside], [text for _, text, _ in inside], replace(rule, kernel=(1.0,)))
    dense = reader.sums((e, int(ratio >= least and linked <= rule.links)) for (e, _, linked), ratio in zip(inside, own))
    headed = reader.sums((e, int(reader.tags[e] in ANCHORS)) for e, *_ in inside)
    above = set(reader.line(at))
    whole = reader.tags[at] == "article"

    def dropped(e: int) -> bool:
        if e in above or not under[e]:
            return False
        if reader.apart[e]:
            return out[e]
        if dense[e] or reader.tags[e] in ANCHORS:
            return False
        return out[e] if whole or reader.tags[e] in LEAVES else out[e] or not headed[e]

    gone = reader.below(e for e in elements if share[e] and dropped(e))
    return "\n".join(text for e, text, _ in inside if not gone[e])


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rule: PathRule = PathRule()
) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row.

    A null html is an empty one, and an empty one has an empty text. Null ids and urls are passed on. Broken markup is
    read as far as it goes. Repeated rows give repeated rows, an empty table none. Further columns are not returned.
    """
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches, "html"):
            keys = [batch.column(c).to_pylist() for c in ("page_id", "url")]
            rows = ((*key, text, len(text)) for key, text in zip(zip(*keys), (main_text(t, rule) for t in texts)))
            kinds = [(c, batch.schema.field(c).type) for c in ("page_id", "url")]
            yield from buffered(rows, pa.schema([*kinds, ("text", pa.string()), ("n_chars", pa.int64())]), 2048, lambda r: r[3])

    rows = narrow(pages, page_id=id_col, url=url_col, html=html_col)
    return rows.mapInArrow(work, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
