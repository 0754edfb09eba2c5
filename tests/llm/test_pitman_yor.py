import numpy as np
import pytest
from pyspark.sql import functions as F

from newslens.llm.pitman_yor import (
    LINE_END, Level, least, line_pairs, narrow, packed, risen, rising, score, seat, seat_alike, spelling_ngrams, top_sweep, tree_sweep,
    unpacked, wide, widened,
)


def test_packing_is_exact():
    for kind in (np.uint8, np.int32, np.int64, np.uint64, np.float64):
        x = np.arange(1000).astype(kind)
        assert (unpacked(packed(x, kind), kind) == x).all()
    assert len(unpacked(packed(np.zeros(0), np.int64), np.int64)) == 0


def test_counts_and_hashes_pack_exactly():
    for top in (0, 255, 256, 65_536, 1 << 40):
        x = np.array([0, 3, top])
        assert (widened(narrow(x)) == x).all() and (wide(least(x)) == x).all()
    for x in ([], [5], [0, 0, 1], [7, 1 << 63, (1 << 64) - 1]):
        assert risen(rising(np.array(x, dtype=np.uint64))).tolist() == x
    assert len(widened(narrow(np.zeros(0, dtype=np.int64)))) == len(wide(least(np.zeros(0, dtype=np.int64)))) == 0


def test_contexts_are_seated_alike_and_like_one_by_one():
    rng = np.random.default_rng(5)
    names = rng.integers(0, 1 << 62, 40_000).astype(np.uint64)
    for c, p in ((2, 0.25), (7, 0.4), (200, 0.05)):
        c, others, p = np.full(len(names), c), np.full(len(names), 3.0), np.full(len(names), p)
        here = seat_alike(names, c, others, p, 0.6, 1.0, 9)
        assert (here[7:50] == seat_alike(names[7:50], c[7:50], others[7:50], p[7:50], 0.6, 1.0, 9)).all()
        assert here.mean() == pytest.approx(seat(rng, c, others, p, 0.6, 1.0).mean(), rel=0.01)
        assert (here >= 1).all() and (here <= c).all() and len(np.unique(here)) > 1
    # one customer after another, in plain Python
    mean = np.mean([plain_seating(rng, 7, 3.0, 0.4, 0.6, 1.0) for _ in range(20_000)])
    seven = seat_alike(names, np.full(len(names), 7), np.full(len(names), 3.0), np.full(len(names), 0.4), 0.6, 1.0, 1)
    assert seven.mean() == pytest.approx(mean, rel=0.01)


def plain_seating(rng, customers, others, parent, discount, strength):
    tables = 1
    for done in range(1, customers):
        new = (strength + discount * (others + tables)) * parent
        tables += rng.random() < new / (new + done - discount * tables)
    return tables


def test_scores_do_not_depend_on_the_layout(spark):
    words = "the red fox runs over a green hill and a cat sleeps under it while rain falls".split()
    pick = np.random.default_rng(4)
    rows = [(i, "\n".join(" ".join(pick.choice(words, 6)) for _ in range(4)) + "\na line of all", i % 10 == 0, "") for i in range(200)]
    one = score(table(spark, rows).coalesce(1), F.col("held")).collect()
    many = score(table(spark, rows).repartition(20), F.col("held")).collect()
    by = {r.doc_id: r for r in many}
    assert len(by) == 200
    for r in one:
        assert r.score == pytest.approx(by[r.doc_id].score, rel=1e-4) and r.base_score == pytest.approx(by[r.doc_id].base_score)


def test_seating_bounds_and_mean():
    rng = np.random.default_rng(1)
    c = np.array([0, 1, 2, 50, 100_000])
    t = seat(rng, c, np.zeros(5), np.full(5, 0.5), 0.5, 1.0)
    assert (t <= c).all() and (t >= np.minimum(c, 1)).all() and t[0] == 0 and t[1] == 1
    # two customers: the second opens a table with (1 + d) * p against 1 - d
    many = seat(rng, np.full(40_000, 2), np.zeros(40_000), np.full(40_000, 0.25), 0.5, 1.0) - 1
    assert many.mean() == pytest.approx(0.375 / (0.375 + 0.5), abs=0.01)
    certain = seat(rng, np.full(10, 1000), np.zeros(10), np.zeros(10), 0.5, 1.0)
    assert (certain == 1).all()  # nothing new comes from a parent that never serves it


def test_spelling_ngrams():
    keys, owner = spelling_ngrams(np.frombuffer(b"abc", np.uint8), np.array([2, 0, 1]), order=3)
    assert [k.to_bytes(3, "big") for k in keys.tolist()] == [b"  a", b" ab", b"ab ", b"   ", b"  c", b" c "]
    assert owner.tolist() == [0, 0, 0, 1, 2, 2]


def test_a_level_is_a_distribution():
    rng = np.random.default_rng(2)
    keys = np.array([a << 8 | b for a in (7, 9) for b in range(256)], dtype=np.uint64)
    level = Level(keys)
    customers = rng.integers(0, 5, 512) * (rng.random(512) < 0.1)
    parent = np.tile(rng.dirichlet(np.ones(256)), 2)
    level.update(rng, customers, parent, 0.75, 1.0)
    found = level.predict(parent, 0.75, 1.0)
    assert found[:256].sum() == pytest.approx(1) and found[256:].sum() == pytest.approx(1)
    assert (level.tables <= customers).all()


def test_a_tree_is_a_distribution_in_every_context():
    rng = np.random.default_rng(3)
    tree = ord("a") << 8 | ord("b")  # contexts that end in ab
    contexts = [0x2020, 0x7878, 0x7978]
    keys = np.array(sorted((c << 24) | (tree << 8) | w for c in contexts for w in range(256)), dtype=np.uint64)
    customers = (rng.integers(0, 9, len(keys)) * (rng.random(len(keys)) < 0.05)).astype(np.int64)
    top = np.full((256, 256), 1 / 256.0)
    chance, byte, tables = tree_sweep(keys, customers, top, rng)
    assert chance.reshape(3, 256).sum(axis=1) == pytest.approx([1, 1, 1])
    assert len(byte) == len(tables) == 256 and tables.sum() <= customers.sum()
    probs = top_sweep(np.bincount((ord("b") << 8) + byte, weights=tables, minlength=65536).reshape(256, 256), top, rng)
    assert probs.sum(axis=1) == pytest.approx(np.ones(256))


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, held boolean, score string")


def test_odd_rows(spark):
    rows = [(i, f"the cat sat on mat {i % 7}\nand ran away", False, "own") for i in range(40)]
    rows += [
        (100, None, True, ""), (101, "", True, ""), (102, " \n\n ", True, ""), (103, "the cat", True, ""), (103, "the cat", True, ""),
        (104, "zebra " * 30_000, True, ""), (None, "mat mat", None, ""), (105, "the cat sat on mat 3\nand ran away", True, ""),
        (106, "the cat and sat on mat 3\naway ran", True, ""), (107, "ÀÉ中 THE", True, ""),
    ]
    got = score(table(spark, rows), F.col("held")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[100].n_tokens == by[101].n_tokens == by[102].n_tokens == 1
    assert by[100].score == by[101].score == by[102].score and by[104].n_tokens == 30_001
    assert len({r.score for r in got if r.doc_id == 103}) == 1
    assert by[105].score > by[106].score  # known lines, then the same words in another order
    assert by[None].held_out is False and all(r.score < 0 and r.perplexity > 1 for r in got)
    assert by[107].n_known == 1 + 1


def test_without_training_texts_and_without_rows(spark):
    got = score(table(spark, [(1, "a b", True, ""), (2, "a b", True, "")]), F.col("held")).collect()
    assert [(r.n_known, r.train_tokens) for r in got] == [(0, 0)] * 2 and got[0].score == got[1].score < 0
    assert score(table(spark, []), F.col("held")).collect() == []


def test_more_likely_words_score_higher(spark):
    rows = [(i, "common common common rare"[: 20 if i % 9 else 25], False, "") for i in range(90)]
    rows += [(200, "common", True, ""), (201, "rare", True, ""), (202, "comm0n", True, "")]
    by = {r.doc_id: r.score for r in score(table(spark, rows), F.col("held")).collect()}
    assert by[200] > by[201] > by[202]


def test_line_pairs():
    tokens, hashes = np.array([2, 3, 2, 3, 4]), np.array([0, 1, 77, 88, 99], dtype=np.uint64)
    pairs, which, before, after = line_pairs(tokens, np.array([2, 3]), hashes)
    e = LINE_END
    want = [(e, 2), (2, 3), (3, e), (e, 2), (2, 3), (3, 4), (4, e), (e, e)]
    assert [(before[k], after[k]) for k in which] == want and len(pairs) == len(set(want)) and (np.diff(pairs) > 0).all()
    pairs, which, before, after = line_pairs(tokens[:0], np.zeros(0, dtype=np.int64), hashes[:2])
    assert [(before[k], after[k]) for k in which] == [(e, e)]


def test_words_are_known_in_their_contexts(spark):
    rows = [(i, f"n{i} the red fox runs over a green hill n{i + 1}", False, "") for i in range(60)]
    # no line is a training line: a fluent one, its words in other orders, and a passage inside a longer line
    rows += [(200, "the red fox runs over a green hill", True, ""), (201, "hill a red over the green runs fox", True, "")]
    rows += [(202, "zu zu the red fox runs over a green hill zu zu", True, ""), (203, "zu zu hill a red over the green runs fox zu zu", True, "")]
    by = {r.doc_id: r.score for r in score(table(spark, rows), F.col("held")).collect()}
    assert by[200] > by[201] + 3 and by[202] > by[203] + 3
