import random
import re

import pytest

import newslens as nl
from newslens.operators import terms

RULE = "entity string, pattern string, context array<string>"


@pytest.mark.parametrize(
    ("pattern", "needs"),
    [
        (r"\boli\b|\bkp\b", ("kp", "oli")),
        (r"\bnepali\s?congress\b|\bnc\b", ("congress", "nc")),
        (r"\bk\.?\s?p\.?\s?sharma\s?oli\b", ("sharma",)),
        (r"(?:ab|cd)+x{2}", ("ab", "cd")),
        (r"(foo)?(bar)", ("bar",)),
        (r"a*b?", ()),
        (r"\d+", ()),
        (r"(?i)abc", ()),
        (r"(?i:abc)de", ("de",)),
        (r"ab|", ()),
        (r"\Qa.b\E", ()),
        (r"cpn \(uml\)", ("cpn (uml)",)),
        (r"(?=look)ab(?!no)", ("ab",)),
        (r"[abc]def[0-9]{3}gh", ("def",)),
    ],
)
def test_literals(pattern, needs):
    assert terms.literals(pattern) == needs


def test_every_match_holds_a_literal():
    random.seed(1)
    parts = ["a", "b", r"\b", "(?:ab|c)", "[ab]", "a?", "(bc)+", "(?:a|bb|)", "c{2}", ".", "(?:x)?"]
    for _ in range(400):
        pattern = "".join(random.choice(parts) for _ in range(random.randrange(1, 5)))
        if random.random() < 0.4:
            pattern += "|" + random.choice(parts)
        needs = terms.literals(pattern)
        for _ in range(20):
            text = "".join(random.choice("abc x") for _ in range(8))
            found = re.search(pattern, text)
            if found and needs:
                assert any(n in found[0] for n in needs), (pattern, text, needs)


def test_tables_give_what_rules_give(spark, articles, monkeypatch):
    random.seed(2)
    words = "oli kp sharma balen shah mayor kathmandu gagan thapa nc nepali congress cpn-uml uml rsp k.p. voting the x".split()
    rows = [(" ".join(random.choices(words, k=3)), " ".join(random.choices([*words, "a.", "b!"], k=12)), "2025-01-05") for _ in range(60)]
    rows += [(None, None, "2025-01-05"), ("", "", "2025-01-05"), ("OLI", "Nepali Congress  uml", "2025-01-06")]
    news = articles(*rows)
    table = spark.createDataFrame([(r.entity, r.pattern, list(r.context) or None) for r in nl.COUNT_RULES] * 2, RULE)
    names = nl.mentions.entities_of(nl.COUNT_RULES)
    want = sorted(nl.expand_counts(nl.track_mentions(news), names).select("link", *names).collect())
    assert sorted(nl.expand_counts(nl.track_mentions(news, table), names).select("link", *names).collect()) == want
    lexicon = nl.Lexicon(("voting",), ("x",))
    patterns = spark.createDataFrame([(p.entity, p.pattern) for p in nl.LEADER_PATTERNS], "entity string, pattern string")
    said = sorted(nl.sentence_mentions(news, nl.LEADER_PATTERNS, lexicon).collect())
    assert sorted(nl.sentence_mentions(news, patterns, lexicon).collect()) == said
    keywords = spark.createDataFrame([(k,) for k in nl.KEYWORDS] + [(None,)], "keyword string")
    kept = sorted(r.link for r in nl.clean.with_keywords(news, nl.KEYWORDS).collect())
    assert sorted(r.link for r in nl.clean.with_keywords(news, keywords).collect()) == kept
    # dealt into several automata
    monkeypatch.setattr(terms.with_candidates, "__defaults__", ("candidates", 300))
    monkeypatch.setattr(terms.any_keyword, "__defaults__", (300,))
    assert sorted(nl.expand_counts(nl.track_mentions(news, table), names).select("link", *names).collect()) == want
    assert sorted(nl.sentence_mentions(news, patterns, lexicon).collect()) == said
    assert sorted(r.link for r in nl.clean.with_keywords(news, keywords).collect()) == kept


def test_patterns_without_literals_and_empty_tables(spark, articles):
    news = articles(("t", "12 a 3", "2025-01-01"), ("t", "none", "2025-01-01"))
    rules = spark.createDataFrame([("number", r"\d+", None), ("a", "a", ["12"]), (None, "x", None), ("x", None, None)], RULE)
    got = {r.link: r.entity_counts for r in nl.track_mentions(news, rules).collect()}
    assert got == {"u0": {"number": 2, "a": 1}, "u1": {}}
    totals = nl.plans.tracking.mentioned_totals(nl.track_mentions(news, rules))
    assert sorted(map(tuple, totals.collect())) == [("a", 1), ("number", 2)]
    assert {r.link: r.entity_counts for r in nl.track_mentions(news, rules.limit(0)).collect()} == {"u0": {}, "u1": {}}
    assert nl.clean.with_keywords(news, spark.createDataFrame([], "keyword string")).collect() == []


def test_ten_thousand_rules(spark, articles):
    rules = spark.range(10_000).selectExpr("concat('e', id) AS entity", r"concat('\\bterm', id, '\\b') AS pattern")
    news = articles(("term7 term7", "term9999 xterm5 term10000", "2025-01-01"))
    tracked = nl.track_mentions(news, rules)
    assert [r.entity_counts for r in tracked.collect()] == [{"e7": 2, "e9999": 1}]
    plan = tracked._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoop|Exchange", plan)


def test_whole_words_are_counted_as_the_engine_counts_them(spark, articles, monkeypatch):
    random.seed(4)
    rules = [(w, rf"\b{w}\b", None) for w in ("abc", "ab", "soci", "x_1", "1")] + [("ab", r"\bab+\b", None), ("abc", r"\babc\b", ["soci"]), ("nl", "\\bab\\b\n", None)]
    odd = ["é", "́", "—", "’", "‍", "ª", "漢", "²", "­", "½", "‿", " ", ".", "_", "\U0001f600", "ⓐ", "\n"]
    texts = ["".join(random.choices(["abc", "ab", "soci", "x_1", "1", *odd, " "], k=random.randrange(1, 25))) for _ in range(300)]
    news = articles(*[("t", t, "2025-01-01") for t in texts])
    table = spark.createDataFrame(rules, RULE)
    named = nl.track_mentions(news, [nl.CountRule(e, p, context=tuple(c or ())) for e, p, c in rules])
    want = {r.link: {e: n for e, n in r.entity_counts.items() if n} for r in named.collect()}
    assert {r.link: r.entity_counts for r in nl.track_mentions(news, table).collect()} == want
    monkeypatch.setattr(terms.with_candidates, "__defaults__", ("candidates", 300))  # joined by word
    assert {r.link: r.entity_counts for r in nl.track_mentions(news, table).collect()} == want


def test_whole_words_need_no_pattern(spark, articles):
    """No pattern is tried for words whose number is known: one text of many rules was a pass for each of them."""
    rules = spark.range(3_000).selectExpr("concat('e', id % 2000) AS entity", r"concat('\\bterm', id, '\\b') AS pattern")
    news = articles(("t", " ".join(f"term{k}" for k in range(3_000)) + " term5 ", "2025-01-01"))
    rows = terms.with_candidates(news, "content", rules)
    found = [c.hits for r in rows.select("candidates").collect() for c in r.candidates]
    assert sorted(found) == [1] * 2_999 + [2]
    counts = nl.track_mentions(news, rules).collect()[0].entity_counts
    assert counts == {f"e{k}": (2 if k < 1000 else 1) + (k == 5) for k in range(2_000)}
