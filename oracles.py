"""The queries of ``__spark_entry__`` as SQL over the same tables.

Written from the definitions, not from the Spark code: rules are spelled out in full, walks
are ordered windows, and every pattern is tried on every text.
"""

from __future__ import annotations

from newslens import COUNT_RULES, KEYWORDS, LEADER_PATTERNS, PARTY_PATTERNS, EntityPattern

#: A party that no document names.
UNMENTIONED = EntityPattern("Janamat", r"\bjanamat\b", ("janamat",))

AS_OF = "TIMESTAMP '2025-04-01'"

NEWS = """
base AS (
  SELECT doc_id, source, text AS t FROM documents
),
news AS (
  SELECT source, substr(t, 1, 40) AS title,
    t || CASE WHEN doc_id % 3 = 0 THEN '. K.P. Sharma Oli of the UML met CPN-UML' ELSE '' END
      || CASE WHEN doc_id % 4 = 0 THEN '. Balen Shah the mayor' ELSE '' END
      || CASE WHEN doc_id % 5 = 0 THEN '. Gagan Kumar Thapa, Nepali Congress' ELSE '' END
      || CASE WHEN doc_id % 6 = 0 THEN '. RSP and NC announced' ELSE '' END
      || CASE WHEN doc_id % 7 = 0 THEN ' good win' WHEN doc_id % 11 = 0 THEN ' bad loss' ELSE '' END
      AS content,
    'doc/' || doc_id AS link, doc_id,
    TIMESTAMP '2025-01-01' + to_days(CAST(doc_id * 37 % 90 AS INTEGER)) AS published_date
  FROM base
),
full_news AS (SELECT *, lower(title || ' ' || content) AS t FROM news)
"""

PRINTED = (
    NEWS
    + """,
printed AS (
  SELECT link, source, doc_id, CASE doc_id % 7
    WHEN 0 THEN strftime(published_date, '%Y-%m-%d %H:%M:%S')
    WHEN 1 THEN strftime(published_date, '%Y-%m-%d %H:%M')
    WHEN 2 THEN strftime(published_date, '%Y-%m-%d')
    WHEN 3 THEN strftime(published_date, '%B %-d, %Y')
    WHEN 4 THEN 'Friday, ' || strftime(published_date, '%b %-d, %Y')
    WHEN 5 THEN strftime(published_date, '%Y-%m-%dT10:05:00')
    ELSE 'soon' END AS raw
  FROM news
),
read AS (
  SELECT link, source, coalesce(
    try_strptime(replace(raw, 'T', ' '), '%Y-%m-%d %H:%M:%S'), try_strptime(raw, '%Y-%m-%d %H:%M'),
    try_strptime(raw, '%Y-%m-%d'), try_strptime(raw, '%B %d, %Y'),
    try_strptime(regexp_replace(raw, '^[A-Za-z]+, ', ''), '%b %d, %Y')) AS published_date
  FROM printed
)
"""
)

LISTING = """
once AS (
  SELECT page_id, ['Kathmandu Post', 'Setopati', 'OnlineKhabar'][page_id % 3 + 1] AS source,
    CAST(page_id // 20 + 1 AS INTEGER) AS page_no, CAST(page_id % 20 AS INTEGER) AS pos, url
  FROM pages
),
listing AS (
  SELECT source, page_no, pos, url FROM once
  UNION ALL
  SELECT source, CAST(page_no + page_id % 4 AS INTEGER), pos + 20, url FROM once
)
"""

WALK = (
    LISTING
    + """,
walk AS (
  SELECT source, page_no, pos, url, CASE WHEN page_id % 13 <> 5 THEN
    TIMESTAMP '2025-01-01' + to_days(CAST(90 - (floor(page_id * 90 /
      ((SELECT max(page_id) FROM pages) + 1)) - page_id % 7) AS INTEGER)) END AS published_date
  FROM once
),
aged AS (
  SELECT *, coalesce(published_date < TIMESTAMP '2025-04-01' - to_days(60), false) AS is_old
  FROM walk
)
"""
)

PORTALS = """
base AS (
  SELECT doc_id, doc_id % 3 AS kind,
    ['Kathmandu Post', 'Setopati', 'OnlineKhabar'][doc_id % 3 + 1] AS source,
    text AS t,
    CAST(doc_id // 60 + 1 AS INTEGER) AS page_no, CAST(doc_id % 60 // 3 AS INTEGER) AS pos,
    TIMESTAMP '2025-01-01' + to_days(CAST(90 - (floor(doc_id * 90 /
      ((SELECT max(doc_id) FROM documents) + 1)) - doc_id % 7) AS INTEGER)) AS day
  FROM documents
),
portal AS (
  SELECT *, CASE kind WHEN 0 THEN 'https://kathmandupost.com/politics/' || doc_id
      WHEN 1 THEN 'https://en.setopati.com/political/' || doc_id
      ELSE 'https://english.onlinekhabar.com/' || doc_id || '.html' END AS url,
    CASE WHEN doc_id % 17 = 3 THEN 404 ELSE 200 END AS status,
    CASE WHEN doc_id % 19 <> 4 THEN day END AS published_date,
    CASE WHEN doc_id % 19 <> 4 AND kind = 1 THEN strftime(day, '%Y-%m-%d %H:%M')
      WHEN doc_id % 19 <> 4 THEN strftime(day, '%Y-%m-%d %H:%M:%S')
      WHEN kind = 1 THEN 'soon' ELSE '' END AS date_text,
    CASE kind WHEN 0 THEN trim(regexp_replace(substr(t, 1, 40), '\\s+', ' ', 'g'))
      ELSE trim(substr(t, 1, 40), E' \\n\\t\\r') END AS title,
    array_to_string(list_filter(list_transform(string_split(t, E'\\n'), lambda s:
      CASE kind WHEN 0 THEN trim(regexp_replace(s, '\\s+', ' ', 'g'))
      ELSE trim(s, E' \\n\\t\\r') END), lambda s: s <> ''), E'\\n') AS content
  FROM base
)
"""


def _stops(seen: str) -> str:
    """First page, from 1 on and one beyond the last, without a new address, by source."""
    return f"""stops AS (
  SELECT source, min(page_no) AS stop FROM (
    SELECT source, unnest(range(1, max(page_no) + 2)) AS page_no FROM {seen} GROUP BY source
  ) ANTI JOIN (SELECT source, page_no FROM {seen} WHERE page_no = p) USING (source, page_no)
  GROUP BY source
)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _quoted(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def _plain_letters(text: str) -> str:
    """For patterns only: this engine's ``\\b`` knows ASCII letters, so others become ``_``."""
    return f"regexp_replace({text}, '[^\\x00-\\x7F\\P{{L}}]', '_', 'g')"


def _found(text: str, pattern: str) -> str:
    return f"regexp_matches({_plain_letters(text)}, '{pattern}')"


def _label(text: str) -> str:
    return (
        f"CASE WHEN {_found(text, _GOOD)} THEN 'positive' "
        f"WHEN {_found(text, _BAD)} THEN 'negative' ELSE 'neutral' END"
    )


_GOOD, _BAD = r"\bgood\b", r"\bbad\b"


def _hits(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({_plain_letters(text)}, '{pattern}'))"


def _gated(rule) -> str:
    hits = _hits("t", rule.pattern)
    if not rule.context:
        return hits
    gate = " OR ".join(f"contains(t, {_quoted(w)})" for w in rule.context)
    return f"CASE WHEN {gate} THEN {hits} ELSE 0 END"


def _counts() -> str:
    entities = list(dict.fromkeys(r.entity for r in COUNT_RULES))
    sums = [
        "CAST(" + " + ".join(_gated(r) for r in COUNT_RULES if r.entity == e) + f" AS INTEGER) AS {e}"
        for e in entities
    ]
    return "tracked AS (SELECT link, t, " + ", ".join(sums) + " FROM full_news)"


LEADER_WORDS = {
    "KP_Oli": r"\b(?:kp oli|kp|kp sharma oli|kp sharma)\b",
    "Balen_Shah": r"\b(?:balen shah|balen|mayor|shah|balendra)\b",
    "Gagan_Thapa": r"\b(?:gagan thapa|gagan kumar thapa|gagan|thapa)\b",
}
PARTY_WORDS = {
    "CPN_UML": r"\b(?:cpn uml|uml)\b",
    "Nepali_Congress": r"\b(?:nepali congress|nc)\b",
    "RSP": r"\b(?:rastriya swatantra party|rsp)\b",
}


def _naming(words: dict[str, str]) -> str:
    values = ", ".join(f"('{e}', '{p}')" for e, p in words.items())
    return f"""words(entity, pattern) AS (VALUES {values}),
naming AS (
  SELECT entity, link, published_date FROM news, words
  WHERE {_found("lower(title)", "PATTERN").replace("'PATTERN'", "pattern")}
    OR {_found("lower(content)", "PATTERN").replace("'PATTERN'", "pattern")}
)"""


SENTENCES = """
split AS (SELECT link, published_date, regexp_split_to_array(t, '[.!?]') AS parts FROM full_news),
sentences AS (
  SELECT link, published_date, unnest(range(len(parts))) AS pos, unnest(parts) AS sentence
  FROM split
)
"""


def _mentions(patterns) -> str:
    values = ", ".join(f"('{p.entity}', '{p.pattern}')" for p in patterns)
    label = _label("sentence")
    return f"""{NEWS}, {SENTENCES},
patterns(entity, pattern) AS (VALUES {values}),
mentions AS (
  SELECT link, published_date, pos, sentence, entity, {label} AS label
  FROM sentences, patterns
  WHERE {_found("sentence", "PATTERN").replace("'PATTERN'", "pattern")}
),
placed AS (
  SELECT *, published_date >= m - to_days(30) AS recent,
    published_date < m - to_days(30) AND published_date >= m - to_days(60) AS previous
  FROM mentions, (SELECT max(published_date) AS m FROM news)
)"""


def _index(patterns) -> str:
    def balance(where: str) -> str:
        of = f"FILTER (WHERE {where})"
        return (
            f"coalesce((count(*) {of[:-1]} AND label = 'positive') "
            f"- count(*) {of[:-1]} AND label = 'negative'))::DOUBLE "
            f"/ nullif(count(*) {of}, 0), 0.0)"
        )

    return f"""{_mentions(patterns)},
totals AS (
  SELECT p.entity, count(link) AS n, {balance("link IS NOT NULL")} AS s,
    {balance("recent")} - {balance("previous")} AS m
  FROM patterns p LEFT JOIN placed USING (entity) GROUP BY p.entity
),
result AS (
  SELECT entity, round(s, 3) AS sentiment_score, round(v, 3) AS volume_score,
    round(m, 3) AS momentum,
    round(0.4::DOUBLE * s + 0.3::DOUBLE * v + 0.3::DOUBLE * m, 3) AS mci_v2,
    CAST(n AS BIGINT) AS total_mentions
  FROM (SELECT *, n::DOUBLE / (SELECT sum(n) FROM totals)::DOUBLE AS v FROM totals)
)"""


def _scenario(patterns) -> str:
    total = 0.5 + 0.2 + 0.6
    s, v, m = 0.5 / total, 0.2 / total, 0.6 / total
    return f"""{_index(patterns)},
scenario AS (
  SELECT *, entity AS name, round({s!r}::DOUBLE * sentiment_score + {v!r}::DOUBLE * volume_score
    + {m!r}::DOUBLE * momentum, 3) AS scenario_score FROM result
)"""


CANDIDATES = (
    NEWS
    + """,
candidates AS (
  SELECT link, doc_id % 3 AS kind, doc_id % 5 = 4 AS junk, doc_id % 2 = 0 AS even, published_date AS d
  FROM news
),
read AS (
  SELECT link, kind, junk, CASE
    WHEN kind = 0 AND junk AND even THEN NULL
    WHEN kind = 0 THEN d
    WHEN kind = 1 AND junk THEN NULL
    WHEN kind = 1 THEN d
    WHEN junk AND even THEN NULL
    ELSE d END AS published_date,
    even
  FROM candidates
)
"""
)


_TERMS = f"""{NEWS},
terms AS (SELECT DISTINCT unnest(regexp_extract_all(lower(title), '[a-z]{{8,}}')) AS entity FROM news),
tokens AS (
  SELECT link, unnest(regexp_extract_all({_plain_letters("t")}, '\\w+')) AS entity FROM full_news
)"""

def _by_day(patterns) -> str:
    """For each day with an article, the index at its newest one."""
    names = ", ".join(f"('{p.entity}')" for p in patterns)

    def balance(window: str) -> str:
        of = f"n_{window}"
        return f"coalesce((pos_{window} - neg_{window})::DOUBLE / nullif({of}, 0), 0.0)"

    windows = {
        "all": "true",
        "recent": "published_date >= m - to_days(30)",
        "previous": "published_date < m - to_days(30) AND published_date >= m - to_days(60)",
    }
    sums = ", ".join(
        f"count(link) FILTER (WHERE {w}) AS n_{k}, count(link) FILTER (WHERE label = 'positive' AND {w}) AS pos_{k}, "
        f"count(link) FILTER (WHERE label = 'negative' AND {w}) AS neg_{k}"
        for k, w in windows.items()
    )
    return _with(
        f"""{_mentions(patterns)},
names(entity) AS (VALUES {names}),
days AS (SELECT CAST(published_date AS DATE) AS d, max(published_date) AS m FROM news GROUP BY 1),
sums AS (
  SELECT d, names.entity, {sums}
  FROM days CROSS JOIN names LEFT JOIN mentions ON mentions.entity = names.entity AND published_date <= m
  GROUP BY ALL
),
parts AS (
  SELECT *, {balance("all")} AS s, {balance("recent")} - {balance("previous")} AS mo,
    coalesce(n_all::DOUBLE / nullif(sum(n_all) OVER (PARTITION BY d), 0)::DOUBLE, 0.0) AS v FROM sums
)""",
        """SELECT strftime(d, '%Y-%m-%d') AS date, entity, round(s, 3) AS sentiment_score, round(v, 3) AS volume_score,
          round(mo, 3) AS momentum, round(0.4::DOUBLE * s + 0.3::DOUBLE * v + 0.3::DOUBLE * mo, 3) AS mci_v2,
          CAST(n_all AS BIGINT) AS total_mentions FROM parts""",
    )


def _both(**sets) -> str:
    parts = [
        f"SELECT '{name}' AS \"set\", *, 0 AS new_deltas FROM ({_with(_index(patterns), 'SELECT * FROM result')})"
        for name, patterns in sets.items()
    ]
    return "\nUNION ALL ".join(parts)


#: Rules as tables find what the rules find.
_TABLES = ("keyword_filter", "mention_counts", "sentence_mentions", "articles_naming", "daily_mentions", "coverage_ratio")


def all_queries() -> dict[str, str]:
    own = _queries()
    own |= {f"{name}_table": own[name] for name in _TABLES}
    return own | {
        "titles_of_bytes": own["page_titles"],
        "url_new_on_page_salted": f"""WITH {LISTING.strip()},
hot AS (
  SELECT * FROM listing UNION ALL SELECT source, page_no, CAST(pos + 100 AS INTEGER), 'https://hot.example.org/' FROM listing
)
SELECT source, page_no, pos, url FROM hot QUALIFY page_no = min(page_no) OVER (PARTITION BY source, url)""",
        "resumed_walk": f"""WITH {LISTING.strip()},
seen AS (
  SELECT *, min(page_no) OVER (PARTITION BY source, url) AS p,
    row_number() OVER (PARTITION BY source, url ORDER BY page_no, pos) AS k FROM listing
),
{_stops("seen")}
SELECT s.source, page_no, pos, url FROM seen s LEFT JOIN stops USING (source)
WHERE CASE s.source WHEN 'Kathmandu Post' THEN k = 1 ELSE page_no = p AND page_no < stop END""",
        "articles_by_day": _with(
            NEWS,
            f"""SELECT source, title, link, content, {_stamp("published_date")} AS published_date FROM news
              WHERE published_date >= {AS_OF} - to_days(60)""",
        ),
        "article_rank": _with(
            NEWS,
            """SELECT link, length(content) AS chars,
              row_number() OVER (ORDER BY length(content) DESC, link) AS rank FROM news""",
        ),
        "article_share": _with(
            NEWS,
            """SELECT link, round(length(content)::DOUBLE / nullif(sum(length(content)) OVER (PARTITION BY source), 0)::DOUBLE, 6)
              AS share FROM news""",
        ),
        "confidence_by_day": _by_day(LEADER_PATTERNS),
        "confidence_both": _both(leaders=LEADER_PATTERNS, parties=PARTY_PATTERNS),
        "term_mentions": _with(
            _TERMS, "SELECT entity, count(*) AS mentions FROM tokens JOIN terms USING (entity) GROUP BY entity"
        ),
        "term_articles": _with(
            _TERMS,
            """SELECT entity, count(DISTINCT link) AS articles FROM terms LEFT JOIN tokens USING (entity)
              GROUP BY entity""",
        ),
    }


def _queries() -> dict[str, str]:
    gated = {r.pattern.strip("\\b"): r for r in COUNT_RULES if r.context}
    keywords = " OR ".join(f"contains(k, {_quoted(w)})" for w in KEYWORDS)
    entities = list(dict.fromkeys(r.entity for r in COUNT_RULES))
    counted = ", ".join(entities)
    walk_columns = f"source, page_no, pos, url, {_stamp('published_date')} AS published_date"
    result = (
        "entity, sentiment_score, volume_score, momentum, mci_v2, total_mentions"
    )
    full = f"{NEWS}, {_counts()}"
    def labelled(content: str) -> str:
        return _with(
            NEWS,
            f"""SELECT link, {_label(content)} AS sentiment,
              CASE WHEN {_found(content, _GOOD)} OR {_found(content, _BAD)} THEN 1.0::DOUBLE
                ELSE 0.0::DOUBLE END AS confidence FROM news""",
        )

    sentiment = labelled("lower(content)")
    stored = _with(
        NEWS,
        f"""SELECT source, title, link, content, {_stamp("published_date")} AS published_date,
          {_stamp("published_date")} AS date_text FROM news""",
    )

    def exhausted(listing: str) -> str:
        return _with(
            f"""{LISTING},
mine AS (SELECT * FROM {listing}),
seen AS (SELECT *, min(page_no) OVER (PARTITION BY source, url) AS p FROM mine),
{_stops("seen")}""",
            """SELECT m.source, page_no, pos, url FROM mine m LEFT JOIN stops USING (source)
              WHERE page_no < stop""",
        )

    leaders = _with(_index(LEADER_PATTERNS), f"SELECT {result} FROM result")

    def mention_rows(patterns) -> str:
        return _with(
            _mentions(patterns),
            f"""SELECT link, {_stamp("published_date")} AS published_date,
              CAST(pos AS INTEGER) AS pos, sentence, entity, label FROM mentions""",
        )

    def days(words: dict[str, str], where: str = "true") -> str:
        return _with(
            f"{NEWS}, {_naming(words)}",
            f"""SELECT entity, strftime(published_date, '%Y-%m-%d') AS date, count(*) AS mentions
              FROM naming WHERE {where} GROUP BY ALL""",
        )

    article = f"""list_filter(list_transform(string_split(
      regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<p>')[2:], lambda p:
      trim(array_to_string(list_transform(string_split(
        regexp_replace(p, '</p>.*', '', 's'), '<br>'), lambda s: {_plain("s")}), E'\\n'), E'\\n ')),
      lambda p: p <> '')"""
    return {
        "clean_articles": _with(
            NEWS,
            """SELECT link, coalesce(title, '') AS title,
              strftime(published_date, '%Y-%m-%d') AS date,
              lower(coalesce(title, '') || ' ' || content) AS full_text,
              lower(content || ' ' || coalesce(title, '')) AS search_text
            FROM (SELECT * REPLACE (CASE WHEN NOT link LIKE '%0' THEN title END AS title)
                  FROM news)""",
        ),
        "lenient_dates": _with(
            PRINTED, f"SELECT link, {_stamp('published_date')} AS published_date FROM read"
        ),
        "dated_articles": _with(
            PRINTED,
            f"""SELECT link, {_stamp("published_date")} AS published_date FROM read
              WHERE published_date IS NOT NULL""",
        ),
        "recent_articles": _with(
            PRINTED,
            f"""SELECT link, {_stamp("published_date")} AS published_date FROM read
              WHERE published_date IS NULL OR published_date >= {AS_OF} - to_days(60)""",
        ),
        "keyword_filter": _with(
            NEWS,
            f"""SELECT link, title FROM (SELECT *, lower(content || ' ' || title) AS k FROM news)
              WHERE {keywords}""",
        ),
        "context_gate": _with(
            NEWS,
            "SELECT link, "
            + ", ".join(f"CAST({_gated(r)} AS INTEGER) AS {w}" for w, r in gated.items())
            + " FROM full_news",
        ),
        "mention_counts": _with(full, f"SELECT link, {counted} FROM tracked"),
        "mention_totals": _with(
            full,
            "\nUNION ALL ".join(
                f"SELECT '{e}' AS entity, CAST(sum({e}) AS BIGINT) AS mentions FROM tracked"
                for e in entities
            ),
        ),
        "articles_naming": _with(
            f"{NEWS}, {_naming({**LEADER_WORDS, **PARTY_WORDS})}",
            """SELECT w.entity, count(link) AS articles
              FROM words w LEFT JOIN naming USING (entity) GROUP BY ALL""",
        ),
        "daily_mentions": days(LEADER_WORDS),
        "daily_mentions_parties": days(
            PARTY_WORDS,
            "published_date >= (SELECT max(published_date) FROM news) - to_days(60)",
        ),
        "coverage_ratio": _with(
            f"""{NEWS}, {_naming({**LEADER_WORDS, **PARTY_WORDS})},
pairs(party, leader) AS (VALUES ('CPN_UML', 'KP_Oli'), ('RSP', 'Balen_Shah'),
  ('Nepali_Congress', 'Gagan_Thapa')),
n AS (SELECT entity, count(*) AS n FROM naming GROUP BY entity)""",
            """SELECT party, leader,
              round(coalesce(l.n, 0)::DOUBLE / (coalesce(p.n, 0) + 1), 3) AS leader_to_party_ratio
            FROM pairs LEFT JOIN n p ON p.entity = party LEFT JOIN n l ON l.entity = leader""",
        ),
        "sentence_split": _with(
            f"{NEWS}, {SENTENCES}",
            "SELECT link, CAST(pos AS INTEGER) AS pos, sentence FROM sentences",
        ),
        "sentence_mentions": mention_rows(LEADER_PATTERNS),
        "sentence_mentions_model": mention_rows(PARTY_PATTERNS),
        "article_sentiment": sentiment,
        "article_sentiment_model": sentiment,
        "article_sentiment_512": labelled("substr(lower(content), 1, 512)"),
        "article_sentiment_errors": _with(
            NEWS,
            f"""SELECT link, CASE WHEN {_found("lower(content)", _BAD)} THEN 'error'
                ELSE 'neutral' END AS sentiment,
              CASE WHEN {_found("lower(content)", _BAD)} THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END
                AS confidence FROM news""",
        ),
        "label_windows": _with(
            _mentions(LEADER_PATTERNS),
            """SELECT entity, label, count(*) AS n, count(*) FILTER (WHERE recent) AS recent,
              count(*) FILTER (WHERE previous) AS previous FROM placed GROUP BY ALL""",
        ),
        "confidence_leaders": leaders,
        "confidence_parties": _with(
            _index(PARTY_PATTERNS), f"SELECT {result} FROM result WHERE total_mentions > 0"
        ),
        "confidence_model": leaders,
        "confidence_with_unmentioned": _with(
            _index((*PARTY_PATTERNS, UNMENTIONED)), f"SELECT {result} FROM result"
        ),
        "daily_mentions_of_results": days({k: v for k, v in PARTY_WORDS.items() if k != "RSP"}),
        "csv_results": leaders,
        "scenario_ranking": _with(
            _scenario(LEADER_PATTERNS),
            """SELECT name, sentiment_score, volume_score, momentum, mci_v2, total_mentions,
              scenario_score,
              CAST(row_number() OVER (ORDER BY scenario_score DESC, name) AS INTEGER) AS rank
            FROM scenario ORDER BY rank""",
        ),
        "momentum_trend": _with(
            _scenario(PARTY_PATTERNS),
            """SELECT name, momentum, CASE WHEN momentum > 0 THEN 'Rising'
              WHEN momentum < 0 THEN 'Declining' ELSE 'Stable' END AS trend FROM scenario""",
        ),
        "gauges": _with(
            _scenario(LEADER_PATTERNS),
            """SELECT name, scenario_score AS value, -0.5::DOUBLE AS axis_min,
              0.5::DOUBLE AS axis_max FROM scenario""",
        ),
        "listing_links": """
SELECT source, page_no, url, pos FROM (
  SELECT ['Kathmandu Post', 'Setopati', 'OnlineKhabar'][page_id % 3 + 1] AS source,
    CAST(page_id // 3 + 1 AS INTEGER) AS page_no,
    unnest(CASE page_id % 3
      WHEN 0 THEN ['https://kathmandupost.com/politics/' || page_id,
                   'https://kathmandupost.com/money/' || page_id]
      WHEN 1 THEN ['https://en.setopati.com/political/' || page_id || '/']
      ELSE ['https://english.onlinekhabar.com/' || page_id || '.html'] END) AS url,
    unnest(CASE page_id % 3
      WHEN 0 THEN [0, 1]
      WHEN 1 THEN [len(regexp_extract_all(html, '<a '))::INTEGER]
      ELSE [0] END) AS pos
  FROM pages)""".strip(),
        "page_titles": f"""
SELECT url AS link, {_plain("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS title
FROM pages""".strip(),
        "page_bodies": f"SELECT url AS link, array_to_string({article}, E'\\n') AS content FROM pages",
        "parse_dates": _with(
            CANDIDATES,
            f"""SELECT link, {_stamp("published_date")} AS published_date, CASE
                WHEN kind = 1 AND junk THEN 'soon'
                WHEN kind = 1 AND even THEN strftime(published_date, '%Y-%m-%d %H:%M')
                ELSE coalesce({_stamp("published_date")}, '') END AS date_text
              FROM read""",
        ),
        "url_first_seen": _with(
            LISTING,
            """SELECT source, page_no, pos, url FROM (SELECT *, row_number() OVER (
              PARTITION BY source, url ORDER BY page_no, pos) AS k FROM listing) WHERE k = 1""",
        ),
        "url_new_on_page": _with(
            LISTING,
            """SELECT source, page_no, pos, url FROM (SELECT *, min(page_no) OVER (
              PARTITION BY source, url) AS p FROM listing) WHERE page_no = p""",
        ),
        "stop_when_exhausted": exhausted("listing"),
        "stop_without_first_page": exhausted(
            "(SELECT * FROM listing WHERE NOT (source = 'Setopati' AND page_no = 1 "
            "OR source = 'OnlineKhabar' AND page_no = 3))"
        ),
        "page_cap": _with(LISTING, "SELECT source, page_no, pos, url FROM listing WHERE page_no <= 11"),
        "cutoff_immediate": _with(
            WALK,
            f"""SELECT {walk_columns} FROM (SELECT *, bool_or(is_old) OVER (
              PARTITION BY source ORDER BY page_no, pos) AS ended FROM aged) WHERE NOT ended""",
        ),
        "cutoff_page_end": _with(
            WALK,
            f"""SELECT {walk_columns} FROM (SELECT *, bool_or(is_old) OVER (
              PARTITION BY source ORDER BY page_no
              RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended FROM aged)
              WHERE NOT is_old AND NOT coalesce(ended, false)""",
        ),
        "build_articles": _with(
            f"""{PORTALS},
links AS (
  SELECT source, kind, page_no, pos, url FROM portal
  UNION ALL SELECT source, kind, page_no + CASE WHEN doc_id % 5 = 1 THEN 2 ELSE 0 END,
    pos + 20, url FROM portal
),
seen AS (
  SELECT *, min(page_no) OVER (PARTITION BY source, url) AS p,
    row_number() OVER (PARTITION BY source, url ORDER BY page_no, pos) AS k FROM links
),
"""
            + _stops("seen")
            + f""",
visits AS (
  SELECT s.* FROM seen s LEFT JOIN stops USING (source)
  WHERE CASE kind WHEN 0 THEN k = 1 ELSE page_no = p AND page_no < stop END
),
opened AS (
  SELECT v.page_no, v.pos, a.*,
    coalesce(a.published_date < {AS_OF} - to_days(60), false) AS is_old
  FROM visits v JOIN (SELECT * EXCLUDE (page_no, pos) FROM portal) a USING (source, url)
  WHERE (status = 200 OR a.kind = 0) AND (a.kind <> 0 OR a.published_date IS NOT NULL)
),
ended AS (
  SELECT *, bool_or(is_old) OVER (PARTITION BY source ORDER BY page_no, pos) AS at_once,
    bool_or(is_old) OVER (PARTITION BY source ORDER BY page_no
      RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
    lower(content || ' ' || title) AS k
  FROM opened
)""",
            f"""SELECT source, title, url AS link, content,
              {_stamp("published_date")} AS published_date, date_text
            FROM ended
            WHERE CASE kind WHEN 1 THEN NOT is_old AND NOT coalesce(before, false)
                ELSE NOT at_once END
              AND (kind <> 0 OR {keywords})""",
        ),
        "articles_from_listings": f"""
SELECT source, 'Election ' || page_id AS title, link, url AS content,
  strftime(d, '%Y-%m-%d %H:%M:%S') AS published_date,
  CASE page_id % 3 WHEN 1 THEN strftime(d, '%Y-%m-%d %H:%M')
    ELSE strftime(d, '%Y-%m-%d %H:%M:%S') END AS date_text
FROM (
  SELECT page_id, url, ['Kathmandu Post', 'Setopati', 'OnlineKhabar'][page_id % 3 + 1] AS source,
    CASE page_id % 3 WHEN 0 THEN 'https://kathmandupost.com/politics/' || page_id
      WHEN 1 THEN 'https://en.setopati.com/political/' || page_id || '/'
      ELSE 'https://english.onlinekhabar.com/' || page_id || '.html' END AS link,
    TIMESTAMP '2025-01-01' + to_days(CAST(60 + page_id % 31 AS INTEGER)) AS d
  FROM pages WHERE page_id % 2 = 0)""".strip(),
        "landed_pages": _with(PORTALS, "SELECT source, url, status FROM portal WHERE status = 200"),
        "union_sources": _with(WALK, f"SELECT {walk_columns} FROM walk"),
        "run_summary": _with(
            PRINTED,
            """SELECT count(link) AS link, count(source) AS source,
              count(published_date) AS published_date, count(*) AS total_rows FROM read""",
        ),
        "csv_articles": stored,
        "csv_by_header": stored,
        "csv_tracked": _with(full, f"SELECT link, t AS full_text, {counted} FROM tracked"),
        "csv_labelled": sentiment,
    }


def _plain(html: str) -> str:
    """Text of a piece of HTML: tags out, marks resolved, spaces collapsed."""
    tagless = f"regexp_replace({html}, '<[^>]*>', '', 'g')"
    for mark, plain in (("&quot;?", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;?", "&")):
        tagless = f"regexp_replace({tagless}, '{mark}', '{plain}', 'g')"
    return f"trim(regexp_replace({tagless}, '\\s+', ' ', 'g'))"
