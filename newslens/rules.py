"""Rule types and the default rule sets.

Rules are small, literal dictionaries: they become Spark expressions when a plan is
built, never a joined table. The three kinds of entity rules overlap but differ on
purpose (a bare surname may count in one and need a context word in another), so they
are separate arguments everywhere.

``needs`` on a rule lists lowercase substrings of which every possible match contains
at least one. It is a cheap exact pre-test, not an extra condition; leave it empty when
unsure.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class EntityPattern:
    """A sentence belongs to ``entity`` when ``pattern`` is found in it."""

    entity: str
    pattern: str
    needs: tuple[str, ...] = ()


@dataclass(frozen=True)
class CountRule:
    """Adds the number of hits of ``pattern``; with ``context``, only in texts that
    contain one of those substrings."""

    entity: str
    pattern: str
    context: tuple[str, ...] = ()
    needs: tuple[str, ...] = ()


@dataclass(frozen=True)
class Variants:
    """Literal spellings of one entity, matched as whole words."""

    entity: str
    variants: tuple[str, ...]


@dataclass(frozen=True)
class SiteRule:
    """How to read one news site: where its parts are and how its listing is walked."""

    source: str
    # article page
    title: tuple[str, ...]
    body: str
    metadata: tuple[tuple[str, ...], ...] = ()  # groups; the first element found has the value
    stamps: tuple[str, ...] = ()  # machine-written dates, read after the metadata
    long_dates: tuple[str, ...] = ()  # dates in words
    title_default: str | None = None  # None: an article without a title is dropped
    date_style: str = "cascade"  # "label" | "colon" | "cascade"
    rendered: bool = False  # text as a browser shows it, else stripped pieces glued together
    # listing page
    links: str = "a"
    links_per: str | None = None  # take the first match inside each of these
    link_from_parent: bool = False
    link_base: str | None = None  # resolve relative links against this address
    link_contains: str | None = None
    link_digits_after: str | None = None
    link_prefix: str | None = None
    # walking order
    dedupe: str = "earlier_page"  # "first" | "earlier_page"
    cutoff: str = "immediate"  # "immediate" | "page_end"
    page_cap: int | None = None
    status: int | None = 200  # article pages of another status are not read; None: all are
    keywords: tuple[str, ...] = field(default=())


# --- Fixed values: the default dictionaries. ---------------------------------------

LEADER_PATTERNS = (
    EntityPattern("KP_Oli", r"\boli\b|\bkp\b", needs=("oli", "kp")),
    EntityPattern("Balen_Shah", r"\bbalen\b|\bshah\b", needs=("balen", "shah")),
    EntityPattern("Gagan_Thapa", r"\bgagan\b|\bthapa\b", needs=("gagan", "thapa")),
)

PARTY_PATTERNS = (
    EntityPattern("CPN_UML", r"\bcpn\s?-?\s?uml\b|\buml\b", needs=("uml",)),
    EntityPattern(
        "Nepali_Congress", r"\bnepali\s?congress\b|\bnc\b", needs=("congress", "nc")
    ),
    EntityPattern(
        "RSP", r"\brastriya\s?swatantra\s?party\b|\brsp\b", needs=("swatantra", "rsp")
    ),
)

COUNT_RULES = (
    CountRule("KP_Oli", r"\bk\.?\s?p\.?\s?sharma\s?oli\b", needs=("sharma",)),
    CountRule("KP_Oli", r"\bkp\s?sharma\s?oli\b", needs=("sharma",)),
    CountRule("KP_Oli", r"\bkp\s?sharma\b", needs=("sharma",)),
    CountRule(
        "KP_Oli", r"\boli\b", context=("uml", "cpn-uml", "prime minister"), needs=("oli",)
    ),
    CountRule("Balen_Shah", r"\bbalen\s?shah\b", needs=("balen",)),
    CountRule("Balen_Shah", r"\bbalendra\s?shah\b", needs=("balendra",)),
    CountRule("Balen_Shah", r"\bbalen\b", needs=("balen",)),
    CountRule("Balen_Shah", r"\bmayor\b", context=("kathmandu", "shah"), needs=("mayor",)),
    CountRule("Gagan_Thapa", r"\bgagan\s?kumar\s?thapa\b", needs=("gagan",)),
    CountRule("Gagan_Thapa", r"\bgagan\s?thapa\b", needs=("gagan",)),
    CountRule(
        "Gagan_Thapa", r"\bthapa\b", context=("gagan", "nepali congress", "nc"), needs=("thapa",)
    ),
    CountRule("Nepali_Congress", r"\bnepali\s?congress\b", needs=("congress",)),
    CountRule("Nepali_Congress", r"\bnc\b", needs=("nc",)),
    CountRule("CPN_UML", r"\bcpn\s?-?\s?uml\b", needs=("uml",)),
    CountRule("CPN_UML", r"\buml\b", needs=("uml",)),
    CountRule("RSP", r"\brastriya\s?swatantra\s?party\b", needs=("swatantra",)),
    CountRule("RSP", r"\brsp\b", needs=("rsp",)),
)

LEADER_VARIANTS = (
    Variants("KP_Oli", ("kp oli", "kp", "kp sharma oli", "kp sharma")),
    Variants("Balen_Shah", ("balen shah", "balen", "mayor", "shah", "balendra")),
    Variants("Gagan_Thapa", ("gagan thapa", "gagan kumar thapa", "gagan", "thapa")),
)

PARTY_VARIANTS = (
    Variants("CPN_UML", ("cpn uml", "uml")),
    Variants("Nepali_Congress", ("nepali congress", "nc")),
    Variants("RSP", ("rastriya swatantra party", "rsp")),
)

PARTY_LEADERS = {
    "CPN_UML": ("KP_Oli",),
    "RSP": ("Balen_Shah",),
    "Nepali_Congress": ("Gagan_Thapa",),
}

KEYWORDS = (
    "election", "vote", "voting", "ballot", "campaign", "candidate", "poll", "parliament",
    "mayor", "ward", "constituency", "nepali congress", "congress", "nc",
    "nepali congress party", "cpn uml", "uml", "cpn-uml", "communist party of nepal uml",
    "unified marxist leninist", "cpn (uml)", "maoist centre", "cpn maoist centre", "maoist",
    "nepal communist party", "ncp", "prachanda party", "rashtriya swatantra party",
    "rstriya swatantra party", "rsp", "rastriya swatantra party",
    "national independent party", "rpp", "rashtriya prajatantra party",
    "rastriya prajatantra party", "kp sharma oli", "kp oli", "k p sharma oli",
    "khadga prasad oli", "oli", "gagan thapa", "gagan kumar thapa", "thapa", "gagan",
    "balendra shah", "balen shah", "balen", "balendra", "pushpa kamal dahal", "prachanda",
    "dahal", "rabi lamichhane", "rabi", "lamichhane", "sher bahadur deuba", "deuba",
    "rajendra lingden", "lingden", "upendra yadav", "swarnim wagle", "ck raut",
    "former prime minister", "ex prime minister", "pm candidate",
    "prime ministerial candidate", "old guard", "veteran leader", "aging elite",
    "revolving leaders", "youth leader", "younger candidate", "new faces",
    "gen z favorite", "rapper turned politician", "former mayor", "kathmandu mayor",
    "communist leader", "maoist leader", "centrist", "liberal democratic",
    "party president", "party chairperson", "party leader", "jhapa 5", "jhapa-5",
    "chitwan 2", "chitwan-2",
)

# Pages of this site's listing that the original walk opens; no rule is capped by default.
KATHMANDU_PAGES = 11

KATHMANDU_POST = SiteRule(
    source="Kathmandu Post",
    title=("div.col-sm-8 h1",),
    body="section.story-section p",
    long_dates=(".updated-time",),
    date_style="label",
    rendered=True,
    links="#news-list article.article-image h3",
    link_from_parent=True,
    link_base="https://kathmandupost.com/politics",
    dedupe="first",
    cutoff="immediate",
    status=None,
    keywords=KEYWORDS,
)

SETOPATI = SiteRule(
    source="Setopati",
    title=("span.news-big-title",),
    title_default="No Title",
    body="div.editor-box p",
    stamps=("span.pub-date",),
    date_style="colon",
    links="div.row.bishesh.news-cat-list div.items a",
    link_contains="/political/",
    link_digits_after="/political/",
    dedupe="earlier_page",
    cutoff="page_end",
)

ONLINE_KHABAR = SiteRule(
    source="OnlineKhabar",
    title=("h1.ok-single-post-title", "h1"),
    title_default="No Title",
    body="div.ok-single-post-content p",
    metadata=(
        (
            "meta[property=article:published_time]",
            "meta[name=article:published_time]",
            "[itemprop=article:published_time]",
        ),
        (
            "meta[property=datePublished]",
            "meta[name=datePublished]",
            "[itemprop=datePublished]",
        ),
    ),
    stamps=(
        "time.ok-post-published-date",
        "time[datetime]",
        "time",
        "span.ok-post-date",
        "span.date",
    ),
    long_dates=(
        "span.ok-post-date",
        "div.ok-single-post-meta span",
        "p.ok-post-meta",
        "div.post-infos span",
    ),
    date_style="cascade",
    links="a.ok-post-image",
    links_per="div.ok-news-post.ltr-post",
    link_prefix="https://english.onlinekhabar.com/",
    dedupe="earlier_page",
    cutoff="immediate",
)

SITE_RULES = (KATHMANDU_POST, SETOPATI, ONLINE_KHABAR)
