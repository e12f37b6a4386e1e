import random
import re

from hirelens.llm import jaccard_join as J

SCHEMA = "doc_id long, text string, n string, rep string, band int"


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] == rows[b][0] or sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                label[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top(k)] = min(least.get(top(k), i), i)
    return sorted((i, len(sets[k]), least[top(k)]) for k, (i, _) in enumerate(rows))


def run(spark, rows, size=3, percent=90):
    docs = spark.createDataFrame([(i, t, "n", "r", 1) for i, t in rows], SCHEMA)
    return sorted(tuple(r) for r in J.jaccard_components(docs, size=size, percent=percent).collect())


def texts(seed, letters, bases, copies, edits):
    pick, out = random.Random(seed), []
    for _ in range(bases):
        base = pick.choices(letters, k=pick.randrange(3, 90))
        for _ in range(copies):
            words = list(base)
            for _ in range(pick.randrange(edits)):
                at = pick.randrange(len(words))
                words[at:at + 1] = pick.choice([[], [pick.choice(letters)], [words[at], pick.choice(letters)]])
            out.append(" ".join(words))
    pick.shuffle(out)
    return [(k, t.upper() if k % 7 == 0 else t) for k, t in enumerate(out)]


def test_near_copies_against_all_pairs(spark):
    rows = texts(1, [f"w{k}" for k in range(300)], 12, 25, 5)
    want = brute(rows, 3, 90)
    assert run(spark, rows) == want
    assert 12 < len({c for _, _, c in want}) < 250


def test_small_alphabet_and_other_thresholds(spark):
    rows = texts(2, list("abcdef"), 30, 8, 4)
    for size, percent in ((3, 90), (2, 60)):
        assert run(spark, rows, size, percent) == brute(rows, size, percent)


def test_short_empty_and_repeated_rows(spark):
    rows = [(3, "a b"), (4, "A  B"), (5, "b a"), (6, ""), (7, " \t"), (8, "a"), (9, "a b c"), (9, "a b c"), (1, "a"),
            (2, "x y z"), (2, "p q r"), (10, "P q R")]
    docs = spark.createDataFrame([*((i, t, "n", "r", 1) for i, t in rows), (11, None, "n", "r", 1), (None, "a b", "n", "r", 1)], SCHEMA)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(docs).collect()), key=str)
    assert got == sorted([(3, 1, 3), (4, 1, 3), (5, 1, 5), (6, 0, 6), (7, 0, 7), (8, 1, 1), (9, 1, 9), (9, 1, 9), (1, 1, 1), (2, 1, 2),
                          (2, 1, 2), (10, 1, 2), (11, 0, 11), (None, 1, None)], key=str)
    assert J.jaccard_components(docs.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (50, 50)], "a long, b long")
    got = {r.node: r.component for r in J.components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_points_far_apart_in_a_region_do_not_meet(spark, monkeypatch):
    """Texts that share most rare shingles and are still no near copies: their pairs fall before the region joins give rows."""
    pick, met = random.Random(6), {}
    base = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(80):
        words = list(base)
        for at in pick.sample(range(400), 8 if k % 4 else 3):
            words[at] = f"v{k}.{at}"
        rows.append((k, " ".join(words)))
    stored = J.stored

    def counted(frame, name):
        out = stored(frame, name)
        met[name] = out.count()
        return out

    monkeypatch.setattr(J, "stored", counted)
    want = brute(rows, 5, 80)
    assert run(spark, rows, 5, 80) == want and 30 < len({c for _, _, c in want}) < 70
    assert met["join-loose"] + met["join-again"] < 1400, met
