import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from newslens.llm.fingerprints import fingerprint, likeness, with_anchors, with_next, with_sketch

MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def of_longs(values, seed=42):
    """Spark's xxhash64 over several longs: each is the seed of the next."""
    for v in values:
        seed = xxhash.xxh64((v & MASK).to_bytes(8, "little"), seed=seed & MASK).intdigest()
    return signed(seed)


def brute(text, k=5, s=2):
    words = [signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if len(words) < k:
        return None
    inner = [of_longs(words[i : i + s]) for i in range(len(words) - s + 1)]
    width, out = k - s + 1, []
    steps = [*range(0, k - s, s), k - s]
    for i in range(len(words) - k + 1):
        window = inner[i : i + width]
        if min(window) in (window[0], window[-1]):
            out.append((i, of_longs([inner[i + step] for step in steps])))
    return out


def test_anchors_against_brute_force(spark):
    random.seed(4)
    texts = [" ".join(random.choice("abcdefgh") * random.randint(1, 2) for _ in range(random.randint(5, 80))) for _ in range(40)]
    texts += ["one two three four five", " lead\tand\x0btrail \n", "a a a a a a a a", "é ü 中 文 x y z", "w " * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    for row in with_anchors(df, "text", "a").collect():
        want = brute(row.text)
        if want is not None:
            assert [(a.position, a.hash) for a in row.a] == want


def test_anchors_depend_on_nothing_around_them(spark):
    random.seed(6)
    word = lambda: "".join(random.choices("abcdefghij", k=4))
    shared = " ".join(word() for _ in range(60))
    texts = [f"{' '.join(word() for _ in range(n))} {shared} {' '.join(word() for _ in range(9))}" for n in (3, 50)]
    df = spark.createDataFrame([(1, shared), *enumerate(texts, 2)], "id int, text string")
    rows = {r.id: [(a.position, a.hash) for a in r.a] for r in with_anchors(df, "text", "a").collect()}
    for id, n in ((2, 3), (3, 50)):
        assert {(p + n, h) for p, h in rows[1]} <= set(rows[id])


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "four words are few"), (5, "four words are few"), (6, "few are words four")]
    df = spark.createDataFrame(rows, "id int, text string")
    got = {r.id: r for r in with_sketch(df).withColumn("print", fingerprint("sketch")).collect()}
    assert got[1].print == got[2].print == "" and len(got[3].print) == 16
    assert got[4].print == got[5].print != got[6].print
    pairs = with_sketch(df).crossJoin(with_sketch(df).select(F.col("id").alias("j"), F.col("sketch").alias("other")))
    near = {(r.id, r.j): r.n for r in pairs.withColumn("n", likeness("sketch", "other")).collect()}
    assert near[1, 2] == near[4, 5] == 1.0 and near[1, 4] == near[3, 4] == near[4, 6] == 0.0
    assert with_sketch(df.limit(0)).collect() == []


def test_next_row_over_uneven_ids(spark):
    random.seed(8)
    for ids in ([5], [], list(range(300)), random.sample(range(10**12), 200), [1, 1, 1, 2, 10**15, -7]):
        rows = [(i, f"t{k}") for k, i in enumerate(ids)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = with_next(df, "doc_id", "text", slice_rows=16).collect()
        order = sorted(rows, key=lambda r: (r[0], r[1]))
        want = {a: b[1] for a, b in zip(order, order[1:] + order[:1])}
        assert {(r.doc_id, r.text): r.next_text for r in got} == want and len(got) == len(rows)


def test_rows_without_id_come_first(spark):
    rows = [(None, "x"), (None, "y"), (3, "c"), (1, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    after = {r.text: r.next_text for r in with_next(df, "doc_id", "text").collect()}
    assert after["a"] == "c" and after["c"] in "xy" and {after["x"], after["y"]} in ({"y", "a"}, {"x", "a"})


def test_texts_of_few_words_and_without_spaces_have_likeness(spark):
    random.seed(9)
    han = lambda n: "".join(chr(random.randint(0x4E00, 0x9FFF)) for _ in range(n))
    old, lines = han(400), [han(30) for _ in range(12)]
    few = "internationalisation of neighbourhoods misunderstood"
    far = "".join(random.choices("abcdefghij", k=400))
    texts = {
        "few": few, "few edited": few[:-13] + "reconsidered", "few, a word more": few[:-13] + "often reconsidered again",
        "han": old, "han edited": old[:300] + han(100), "lines": "\n".join(lines),
        "lines edited": "\n".join(x[:10] + han(1) + x[11:] for x in lines),
        "thai": "ภาษาไทยเขียนโดยไม่มีช่องว่างระหว่างคำ", "thai edited": "ภาษาไทยเขียนโดยไม่มีช่องว่างเลยสักแห่ง",
        "run": far, "run edited": far[:300] + "".join(random.choices("klmnop", k=100)),
    }
    df = with_sketch(spark.createDataFrame(list(texts.items()), "id string, text string"))
    pairs = df.crossJoin(df.select(F.col("id").alias("j"), F.col("sketch").alias("other")))
    near = {(r.id, r.j): r.n for r in pairs.withColumn("n", likeness("sketch", "other")).collect()}
    for name in ("few", "han", "lines", "thai", "run"):
        assert near[name, f"{name} edited"] > 0.3, name
    assert near["few", "few, a word more"] > 0.3
    assert near["few", "run"] == near["han", "lines"] == near["thai", "han"] == 0.0


def test_unsegmented_anchors_against_brute_force(spark):
    texts = ["漢字仮名交じり文、と mixed words は two alphabets です", "a" * 40 + " bb cc", "𠀀𠀁 𠀂x𠀃𠀄", "ก ข\nคงจฉ"]
    apart = ["漢 字 仮 名 交 じ り 文 、 と mixed words は two alphabets で す", "a " * 40 + "bb cc", "𠀀 𠀁 𠀂 x 𠀃 𠀄", "ก ข ค ง จ ฉ"]
    df = spark.createDataFrame(list(zip(texts, apart)), "text string, apart string")
    for row in with_anchors(df, "text", "a").collect():
        assert [(a.position, a.hash) for a in row.a] == brute(row.apart)


def test_no_slice_is_large(spark):
    from newslens.llm.fingerprints import _sliced

    far = [*range(2000), 10**15, -(10**15), 2**62, -(2**62)]
    hot = [7] * 700 + list(range(1400))
    none = [None] * 800 + list(range(200))
    for ids in (far, hot, none, [5] * 3, random.sample(range(10**9), 900)):
        df = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "_id long, text string")
        rows = _sliced(df, "text", 64).collect()
        sizes = Counter(r._slice for r in rows)
        assert len(rows) == len(ids) and max(sizes.values()) <= 3 * 64
        key = lambda r: (r._id is not None, r._id or 0, r._tie)
        order = [r._slice for r in sorted(rows, key=key)]
        assert order == sorted(order)


def test_next_row_of_an_id_with_many_rows(spark):
    rows = [(3, f"t{k}") for k in range(90)] + [(k, f"u{k}") for k in range(40)] + [(None, f"v{k}") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_key", F.lit(1))
    got = with_next(df, "doc_id", "text", slice_rows=16)
    assert got.columns == ["doc_id", "text", "_key", "next_text"]
    after = {r.text: r.next_text for r in got.collect()}
    walk, at = [], "u39"
    for _ in rows:
        at = after[at]
        walk.append(at)
    assert sorted(walk) == sorted(t for _, t in rows)  # one ring through all rows
    of = {t: -1 if i is None else i for i, t in rows}
    assert [of[t] for t in walk] == sorted(of.values())
    with pytest.raises(ValueError, match="_slice"):
        with_next(df.withColumn("_slice", F.lit(1)), "doc_id", "text")


def test_long_texts_and_clashing_names(spark):
    text = " ".join(f"w{k % 5000}" for k in range(60_000))
    df = spark.createDataFrame([(1, text), (2, text + " end")], "doc_id long, text string").withColumn("next_text", F.lit("x"))
    got = {r.doc_id: r for r in with_sketch(df).collect()}
    assert len(got[1].sketch) == 64 and got[1].next_text == "x"
    assert len(set(got[1].sketch) & set(got[2].sketch)) >= 60
