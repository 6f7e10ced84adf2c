"""Main text of web pages by rules on blocks, in two passes."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import column, map_batches, texts_of

# Elements and words of the markup
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript template iframe svg object select noembed noframes xmp canvas audio video annotation annotation-xml".split())
BOILERPLATE = frozenset("head nav footer aside form menu button dialog fieldset".split())
CONTENT = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# a start tag of one of these ends an open element of the same kind
SELF_CLOSING = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"},
}
# what keeps such an end tag from reaching further out
FENCES = frozenset("article aside body div main nav ol section table ul".split())
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disclaimer disqus footer gdpr header hidden legal login masthead "
    "menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo "
    "promotion related replies reply respond share sharing sidebar signup social sponsor sponsored "
    "subscribe toolbar topbar widget widgets".split()
)
# marked words that mean something else beside a word that does not belong to layout, as in social-science or ad-free
AMBIGUOUS = frozenset(
    "ad ads banner copyright disclaimer header hidden legal login menu modal nav navigation notice notices overlay "
    "pager popup promotion related replies reply respond share sharing social toolbar topbar widget widgets".split()
)
# words of layout that stand beside them
LAYOUT = frozenset(
    "alert area article articles aside bar block body bottom box btn button buttons card cards center col column "
    "container content contents details dropdown form global grid group head heading holder icon icons image images "
    "info entries inner item items label layout left level line link links list main media message mobile module more "
    "news outer page panel placeholder policy popular post posts primary reading recent region right row secondary section "
    "site slot sticky stories story text title toggle top unit wrap wrapper zone".split()
)
# classes of a post itself, whose further classes are topics
NAMED = frozenset("article entry entry-content hentry post post-body post-content story".split())
# marked words whose elements often hold articles that are not the page's own
CARDS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments disqus promo promotion related replies "
    "reply respond sponsor sponsored".split()
)
STRENGTH = ("", "soft", "card", "hard")  # bans: main lifts soft and card ones, article soft ones
ROLES = frozenset("banner navigation contentinfo complementary search dialog alert form menu".split())

# function words by language
STOP_WORDS = frozenset(
    (
        "a about above after again against all also am an and any are as at be because been before being below "
        "between both but by can could did do does doing down during each even few for from further had has have "
        "having he her here hers herself him himself his how however i if in into is it its itself just like many may me "
        "might more most much must my myself no nor not now of off on once one only or other our ours out over own "
        "said same say says shall she should since so some still such than that the their theirs them themselves then there "
        "these they this those through to too two under until up upon very was we were what when where whether "
        "which while who whom whose why will with within without would yet you your yours "
        "aber alle allem allen aller alles als also am an andere anderen auch auf aus bei beim bin bis bist da damit dann "
        "das dass daß dein dem den denn der des dich die dies diese diesem diesen dieser dieses doch dort du durch ein "
        "eine einem einen einer eines er es etwas euch euer für gegen hat hatte hatten habe haben hier hin hinter ich ihm "
        "ihn ihnen ihr ihre ihrem ihren ihrer im in indem ins ist ja jede jedem jeden jeder jedes jetzt kann kein keine "
        "keinen können machen man mehr mein meine mich mir mit muss nach nicht nichts noch nun nur ob oder ohne schon "
        "sehr sein seine seinem seinen seiner seit selbst sich sie sind so soll sollte sondern sowie über um und uns unser "
        "unter vom von vor war waren was weil welche welcher wenn wer werde werden wie wieder will wir wird wo wurde "
        "wurden während zu zum zur zwar zwischen "
        "ai ainsi alors après au aucun aussi autre autres aux avait avant avec avoir c car ce cela ces cet cette ceux "
        "chaque chez comme comment contre d dans de depuis des deux dit donc dont du elle elles en encore entre est et "
        "étaient était été être eu eux faire fait font ici il ils j je jusque l la le les leur leurs lors lui ma mais me "
        "même mes moi moins mon n ne ni nos notre nous on ont ou où par parce pas peu peut plus plusieurs pour pourquoi "
        "quand que quel quelle quelles quels qui quoi s sa sans se selon sera ses si son sont sous sur ta te tes toi ton "
        "tous tout toute toutes très tu un une vers vos votre vous y à "
        "al algo algunos ante antes aunque cada como con contra cual cuando cómo del desde donde durante e el ella ellas "
        "ellos era eran eres es esa esas ese eso esos esta estaba estado estas este esto estos está están fue fueron ha "
        "haber había han hasta hay la las lo los mas me mi mientras mis mucho muchos muy más nada ni nos nosotros nuestra "
        "nuestro o os otra otras otro otros para pero poco por porque que quien quienes qué se sea según ser si sido "
        "sin sino sobre solo son su sus sólo también tan tanto te tiene tienen todo todos tras tu tus un una uno unos "
        "vosotros ya yo él "
        "agli ai al alla alle allo anche ancora che chi ci come con cui da dagli dai dal dalla dalle degli dei del della "
        "delle dello di dopo dove due è e ed era essere fra gli ha hanno ho i il in io l la le lei lo loro lui ma me mi "
        "molto ne negli nei nel nella nelle nello noi non o ogni per perché però più poi quale quando quanto quella quello "
        "questa queste questi questo se sei senza si sia solo sono sta stato su sua sue sugli sui sul sulla sulle suo suoi "
        "tra tutti tutto un una uno "
        "ao aos as até com da das de depois do dos e ela elas ele eles em entre era essa esse esta este está eu foi foram "
        "há isso isto já lhe mais mas mesmo meu minha muito na nas nem no nos não nós o os ou para pela pelas pelo pelos "
        "por quando que quem são se sem ser seu seus sua suas só também tem têm uma umas você às é "
        "aan al alles als altijd bij dan dat de deze die dit doch doen door dus een en er ge geen had heb hebben heeft "
        "het hier hij hoe hun ik in is je kan kon maar me meer men met mij mijn naar niet nog nu of om omdat onder ons ook "
        "op over te tegen toch toen tot u uit van veel voor want waren wat werd wezen wie wil worden wordt zal ze zelf "
        "zich zij zijn zo zonder zou "
        "а без более бы был была были было быть в вам вас ведь весь во вот все всего всех вы где да даже для до его ее "
        "если есть еще же за здесь и из или им их к как ко когда которая которые который кто ли либо между меня мне "
        "может мы на над надо не него нее нет ни них но ну о об однако он она они оно от очень по под при с сам свой "
        "себя со так также такой там те тем то того тоже той только том ты у уже хотя чего чем что чтобы эта эти это "
        "этого этой этом этот я"
    ).split()
)

TOKEN = re.compile(
    r"<!--(?s:.*?)(?:--!?>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)"
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RIGHTS = re.compile(r"(?:\u00a9|\(c\)|copyright\b|all rights reserved)", re.I)

# thresholds of the first pass, as in the published rules for justext
MAX_LINKS = 0.2
MOST_LINKS = 0.8  # of a paragraph between good ones
SHORT = 70  # characters
LONG = 200
FEW_STOPS = 0.30
MANY_STOPS = 0.32
MARKS = ".,;:!?()[]\"'\u2018\u2019\u201c\u201d\u00ab\u00bb"


@dataclass
class Block:
    """A run of text between block elements."""

    banned: bool  # inside an element that never holds main text
    content: bool  # inside an article or main element
    heading: bool
    prose: bool  # a heading, or the text of a paragraph or quotation
    parts: list[str] = field(default_factory=list)
    linked: int = 0  # characters inside links
    label: str = ""
    text: str = ""


@dataclass
class _Open:
    name: str
    banned: str
    content: bool


def _marks(token: str) -> set[str]:
    """The marked words that a class or id holds; an ambiguous one counts among words of layout only."""
    words = {word.lower() for word in NAMES.findall(token) if len(word) > 1}
    marked = MARKED & words
    return set() if marked <= AMBIGUOUS and not words <= MARKED | LAYOUT else marked


def _banned(name: str, attributes: str, content: bool) -> str:
    """How an element bans what is inside, one of STRENGTH."""
    own = "soft" if name == "form" else ""
    if not own and (name in BOILERPLATE or (name == "header" and not content)):
        return "hard"
    if not attributes or name in ("html", "body", "article", "main"):
        return own
    for match in ATTRIBUTE.finditer(attributes):
        key, *values = match.groups()
        key, value = key.lower(), next((v for v in values if v), "")
        if key in ("class", "id"):
            named = NAMED & {token.lower() for token in value.split()}
            for token in value.split():
                if re.match(r"(?:no|has|with|without)[-_]", token):
                    continue
                marked = _marks(token)
                if named and not marked & CARDS:
                    marked -= AMBIGUOUS
                if marked and not (
                    content and token.lower() in ("header", "entry-header", "post-header", "article-header")
                ):
                    card = marked & CARDS or token.lower() in ("sidebar", "widget", "widgets")
                    own = max(own, "card" if card else "soft", key=STRENGTH.index)
        elif key == "role" and value.lower() in ROLES:
            if value.lower() != "form":
                return "hard"
            own = own or "soft"
        elif key == "hidden":
            return "hard"
        elif key == "aria-hidden" and value.lower() == "true":
            return "hard"
        elif key == "style" and re.search(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", value.lower()):
            return "hard"
    return own


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page in page order, without labels."""
    blocks: list[Block] = []
    stack = [_Open("", "", False)]
    links = 0
    current: Block | None = None
    at = 0

    def text(segment: str) -> None:
        nonlocal current
        if not segment:
            return
        if current is None:
            if not segment.strip():
                return
            top = stack[-1]
            heading = any(o.name in HEADINGS for o in stack)
            holder = next((o.name for o in reversed(stack) if o.name in BLOCKS), "")
            prose = heading or holder in ("p", "blockquote", "pre", "dd")
            current = Block(bool(top.banned), top.content, heading, prose)
            blocks.append(current)
        decoded = unescape(segment) if "&" in segment else segment
        current.parts.append(decoded)
        if links:
            current.linked += len(decoded.strip())

    def close(names: set[str] | frozenset[str], fences: frozenset[str] = frozenset()) -> None:
        """Close the innermost open element of these names, and all inside it."""
        nonlocal links
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                links -= sum(o.name == "a" for o in stack[i:])
                del stack[i:]
                return
            if stack[i].name in fences:
                return

    while True:
        match = TOKEN.search(html, at)
        if match is None:
            text(html[at:])
            break
        text(html[at : match.start()])
        at = match.end()
        end, name, attributes, plain, loose = match.groups()
        name = (name or plain or "").lower()
        attributes = attributes or loose or ""
        if end is not None:
            end = end.lower()
            if end in BLOCKS:
                current = None
            close({end})
        elif name:
            if name in BLOCKS:
                current = None
                if name not in VOID:
                    close(SELF_CLOSING.get(name, {"p"}), FENCES)
                    if name != "p" and name in SELF_CLOSING:
                        close({"p"}, FENCES | {"li", "dd", "td", "th"})
            if name in RAW:
                if not attributes.rstrip().endswith("/"):
                    found = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I).search(html, at)
                    at = found.end() if found else len(html)
                continue
            if name in VOID:
                continue
            top = stack[-1]
            inside = top.content or name in CONTENT
            outer = top.banned
            if outer == "soft" and name in CONTENT or outer == "card" and name == "main":
                outer = ""
            banned = max(outer, _banned(name, attributes, top.content), key=STRENGTH.index)
            stack.append(_Open(name, banned, inside))
            links += name == "a"
    return blocks


def _stops(text: str) -> float:
    """The share of function words; what an apostrophe joins counts as the word before or behind it."""
    words = text.split()
    return sum(_stop(w.lower().strip(MARKS)) for w in words) / len(words)


def _stop(word: str) -> bool:
    return word in STOP_WORDS or any(p in STOP_WORDS for p in re.split("['\u2019]", word) if p != word)


def _classify(block: Block) -> str:
    """First pass: good, bad, or undecided (near, long, short, linked), or a note on rights."""
    size = len(block.text)
    if block.banned:
        return "bad"
    if block.linked / size > MAX_LINKS and not (block.content and block.linked < size):
        if block.heading:
            return "short"
        # a paragraph about other pages, between others
        return "linked" if block.prose and size >= SHORT and block.linked <= MOST_LINKS * size else "bad"
    if size < SHORT:
        return "rights" if RIGHTS.match(block.text) and not block.content else "short"
    density = _stops(block.text)
    if density >= MANY_STOPS:
        return "good" if size > LONG else "near"
    # few known function words say little about a text without links: it may be in another language
    return "near" if density >= FEW_STOPS or block.content else "long"


def _inherit(blocks: list[Block]) -> None:
    """Second pass: an undecided block takes the label of its nearest decided neighbours.

    Both neighbours must be good, or one of them for a block that is nearly good or long. Headings and
    paragraphs before the first decided block, or behind the last, have one neighbour, which decides; banned blocks
    and notes on rights are such an end, too. An article is its own neighbourhood: what is undecided in it is good.
    """
    ends = [b.banned or b.label == "rights" for b in blocks]
    decided = [b.label if b.label in ("good", "bad") else None for b in blocks]
    before: list[str | None] = []
    last = None
    for label, end in zip(decided, ends):
        before.append(last)
        last = None if end else label or last
    after: list[str | None] = []
    last = None
    for label, end in zip(reversed(decided), reversed(ends)):
        after.append(last)
        last = None if end else label or last
    after.reverse()
    for block, label, left, right in zip(blocks, decided, before, after):
        if label or block.label == "rights":
            continue
        if block.content:
            block.label = "good"
            continue
        sides = [left, right] if not block.prose or block.label == "linked" else [s for s in (left, right) if s]
        one_is_enough = block.label in ("near", "long")
        block.label = "good" if sides and (any if one_is_enough else all)(s == "good" for s in sides) else "bad"


def _longest_run(blocks: list[Block]) -> list[Block]:
    """The neighbouring undecided blocks with most characters; bad blocks end a run."""
    runs: list[list[Block]] = [[]]
    for block in blocks:
        if block.label in ("bad", "linked", "rights"):
            runs.append([])
        else:
            runs[-1].append(block)
    return max(runs, key=lambda run: sum(len(block.text) for block in run))


def main_text(html: str) -> str:
    """The good blocks of a page, joined by one space."""
    blocks = blocks_of(html)
    for block in blocks:
        block.text = " ".join("".join(block.parts).split())
    blocks = [block for block in blocks if block.text]
    for block in blocks:
        block.label = _classify(block)
    if not any(b.label == "good" or (b.content and not b.banned) for b in blocks):
        # a page without a good block: what is nearly good decides, else the longest run
        decisive = [b for b in blocks if b.label == "near"] or _longest_run(blocks)
        for block in decisive:
            block.label = "good"
    _inherit(blocks)
    return " ".join(block.text for block in blocks if block.label == "good")


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of pages(page_id, url, html).

    The text of a page without main text is empty, also where html is null. One row per input row,
    also for repeated rows and rows without id; other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(html) for html in texts_of(batch, "html")]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(column(batch, "page_id"), type=pa.int64()),
                pa.array(column(batch, "url"), type=pa.string()),
                pa.array(texts, type=pa.string()),
                pa.array([len(t) for t in texts], type=pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )

    return map_batches(
        pages.select(F.col("page_id").cast("long"), "url", "html"),
        run,
        "page_id long, url string, text string, n_chars long",
    )
