import random
from collections import defaultdict

from newslens.llm.lines import SPACES, dropped_lines, line_dedup, one_edit


def brute(docs, least=20, repeat=1):
    """{id: text} without lines that equal, or are one edit from, an earlier one."""
    places = []
    for i, t in docs:
        for k, line in enumerate((t or "").split("\n")):
            if len(line.strip(SPACES)) >= repeat:
                places.append((i is None, i, k, line.strip(SPACES)))
    first = {}
    for none, i, k, line in sorted(places, key=lambda p: (p[0], p[1] or 0, p[2])):
        first.setdefault(line, (none, i or 0, k))
    shorter = defaultdict(set)
    long = [line for line in first if len(line) >= least]
    for line in long:
        for j in range(len(line)):
            shorter[line[:j] + line[j + 1 :]].add((j, line))

    def near(line):
        out = {x for _, x in shorter[line]}
        for j in range(len(line)):
            rest = line[:j] + line[j + 1 :]
            out |= {x for k, x in shorter[rest] if k == j} | ({rest} if rest in first and len(rest) >= least else set())
        return out - {line}

    gone = {line for line in long if any(first[x] < first[line] for x in near(line))}
    out = {}
    for i, t in docs:
        kept = []
        for k, line in enumerate((t or "").split("\n")):
            bare = line.strip(SPACES)
            if len(bare) < repeat or (bare not in gone and first[bare] == (i is None, i or 0, k)):
                kept.append(line)
        out[i] = t if t is None else "\n".join(kept)
    return out


def fixture():
    random.seed(3)
    base = [f"the quick brown fox jumps over {k} dogs" for k in range(12)]
    base += ["Überall schläft das Kind im Raum 中文 7", "short", "", "   ", "a" * 20, "a" * 21, "a" * 22, "b" * 500, "x" * 19]
    docs = []
    for i in range(80):
        lines = []
        for _ in range(random.randint(0, 9)):
            line, r = random.choice(base), random.random()
            if line and r < 0.5:
                p, c = random.randrange(len(line)), random.choice("xyé ")
                line = random.choice([line[:p] + c + line[p + 1 :], line[:p] + line[p + 1 :], line[:p] + c + line[p:]])
            lines.append(f"  {line}\t\r" if r > 0.9 else line)
        docs.append((i, "\n".join(lines) if i % 17 else None))
    return docs


def test_against_brute_force(spark):
    docs = fixture() + [(None, "the quick brown fox jumps over 1 dogs\nonly in the row without an id")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup(df).collect()} == brute(docs)


def test_a_small_bit_map_only_lets_more_through(spark, monkeypatch):
    monkeypatch.setattr("newslens.llm.lines.BITS", 8)
    docs = fixture()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup(df).collect()} == brute(docs)


def test_short_lines_that_repeat_go_and_near_ones_stay(spark):
    docs = [(1, "ok\nor\n\n"), (2, "ok \nof\n\nno"), (3, "of"), (4, "short line")]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    got = {r.doc_id: r.text for r in line_dedup(df).collect()}
    assert got == brute(docs) == {1: "ok\nor\n\n", 2: "of\n\nno", 3: "", 4: "short line"}
    kept = {r.doc_id: r.text for r in line_dedup(df, min_repeat=3).collect()}
    assert kept == brute(docs, repeat=3) == dict(docs)


def test_a_line_on_most_rows_is_dealt(spark):
    docs = [(i, f"a line that every document has\nthe own line of {i} {i * i}\nso\nso") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id int, text string").repartition(7)
    assert {r.doc_id: r.text for r in line_dedup(df).collect()} == brute(docs)
    # frequent lines meet by a salt
    assert "salt" in dropped_lines(df)._jdf.queryExecution().optimizedPlan().toString()


def test_every_single_edit_is_found(spark):
    line = "abcdefghijklmnopqrstuvwxyz äöü 12"
    edits = {line[:k] + line[k + 1 :] for k in range(len(line))} | {line[:k] + "#" + line[k:] for k in range(len(line) + 1)}
    edits |= {line[:k] + "#" + line[k + 1 :] for k in range(len(line))}
    docs = [(0, line)] + [(k, e) for k, e in enumerate(sorted(edits), 1)]
    got = line_dedup(spark.createDataFrame(docs, "doc_id int, text string")).collect()
    assert {r.doc_id: r.text for r in got} == {i: line if i == 0 else "" for i, _ in docs}


def test_one_edit():
    random.seed(7)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    for _ in range(3000):
        a, b = ("".join(random.choices("ab", k=random.randint(0, 6))) for _ in "12")
        assert one_edit(a, b) == (distance(a, b) <= 1)


def test_two_edits_are_kept(spark):
    line = "abcdefghijklmnopqrstuvwxyz 12"
    docs = [(0, line), (1, line[:3] + line[5:]), (2, "#" + line[1:-1] + "#"), (3, line[1:] + "a" + "b")]
    got = line_dedup(spark.createDataFrame(docs, "doc_id int, text string")).collect()
    assert {r.doc_id: r.text for r in got} == dict(docs)


def test_columns_repeats_and_empty_tables(spark):
    text = "a line that is long enough\nand another one that is long"
    rows = [(1, text, 99, "a", 5), (1, text, 99, "a", 5), (2, text + "\n", 99, "b", 6), (3, "", 0, "c", 7), (4, None, None, "d", 8)]
    df = spark.createDataFrame(rows, "doc_id int, text string, n_chars int, places string, n_lines int")
    out = line_dedup(df)
    assert out.columns == ["doc_id", "text", "n_chars", "places", "n_lines", "n_dropped"]
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == sorted([(1, text, 99, "a", 5, 0)] * 2 + [(2, "", 0, "b", 6, 2), (3, "", 0, "c", 7, 0), (4, None, None, "d", 8, 0)], key=repr)
    assert line_dedup(df.limit(0)).collect() == [] and dropped_lines(df.limit(0)).collect() == []


def test_a_very_long_line(spark):
    docs = [(1, "x" * 50_000 + "y" * 50_000), (2, "x" * 50_000 + "z" + "y" * 49_999), (3, "w" * 30)]
    got = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(docs, "doc_id int, text string")).collect()}
    assert got[2] == "" and got[1] == docs[0][1] and got[3] == docs[2][1]
