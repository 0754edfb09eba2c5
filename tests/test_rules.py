"""The rule sets and the promises their ``needs`` make."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

import newslens as nl
from newslens.functions import text

WORDS = sorted(
    set(
        "k p kp k. p. sharma oli balen balendra shah mayor gagan kumar thapa nepali congress nc "
        "cpn uml - rastriya swatantra party rsp prime minister kathmandu x".split()
    )
)
TEXTS = st.lists(
    st.tuples(st.sampled_from(WORDS), st.sampled_from(["", " ", "  ", "-", ". "])), max_size=8
).map(lambda parts: "".join(w + gap for w, gap in parts))

VARIANTS = nl.LEADER_VARIANTS + nl.PARTY_VARIANTS


@settings(max_examples=600, deadline=None)
@given(TEXTS)
def test_telling_spellings_decide_alike(sample):
    odd = ("kp", "kp-", "-kp", "a -kp", "kp oli", "x kp", "xkp")
    for spellings in [v.variants for v in VARIANTS] + [odd]:
        found = {s for s in spellings if re.search(text.word_pattern(s), sample)}
        assert bool(found) == bool(found & set(text.telling(spellings)))


def test_telling_spellings():
    assert text.telling(nl.LEADER_VARIANTS[0].variants) == ["kp"]
    assert text.telling(nl.LEADER_VARIANTS[1].variants) == ["balen", "mayor", "shah", "balendra"]


@settings(max_examples=600, deadline=None)
@given(TEXTS)
def test_needs_hold_for_every_match(sample):
    for rule in nl.LEADER_PATTERNS + nl.PARTY_PATTERNS + nl.COUNT_RULES:
        if re.search(rule.pattern, sample):
            assert any(word in sample for word in rule.needs), (rule, sample)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.lists(st.sampled_from(WORDS), min_size=1))
def test_shortest_words_decide_alike(sample, words):
    assert any(w in sample for w in words) == any(w in sample for w in text.shortest(words))


def test_rule_sets_stay_separate():
    by_kind = {
        "pattern": next(r for r in nl.LEADER_PATTERNS if r.entity == "KP_Oli").pattern,
        "variants": next(r for r in nl.LEADER_VARIANTS if r.entity == "KP_Oli").variants,
    }
    assert re.search(by_kind["pattern"], "oli spoke")
    assert "oli" not in by_kind["variants"]
    gated = [r for r in nl.COUNT_RULES if r.pattern == r"\boli\b"]
    assert gated[0].context


def test_eighty_seven_keywords():
    assert len(nl.KEYWORDS) == len(set(nl.KEYWORDS)) == 87


@settings(max_examples=600, deadline=None)
@given(TEXTS)
def test_word_first_matches_alike(sample):
    patterns = [r.pattern for r in nl.LEADER_PATTERNS + nl.PARTY_PATTERNS + nl.COUNT_RULES]
    patterns += [text.word_pattern(s) for v in VARIANTS for s in v.variants]
    patterns += [r"\bnc?\b", r"\bk*p", r"\bx{1}", r"p\b.\bsharma"]
    for pattern in patterns:
        spans = [m.span() for m in re.finditer(pattern, sample)]
        assert [m.span() for m in re.finditer(text.word_first(pattern), sample)] == spans


def test_word_first_leaves_the_rest():
    assert text.word_first(r"\boli\b|\bkp\b") == r"oli(?<=\boli)\b|kp(?<=\bkp)\b"
    assert text.word_first(r"\bnc?\b") == r"\bnc?\b"
    assert text.word_first(r"\\bnc") == r"\\bnc"
    assert text.word_first(r"[\bx]\bnc") == r"[\bx]\bnc"
