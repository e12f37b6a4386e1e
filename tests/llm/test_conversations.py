import hashlib
import random
import re
from collections import defaultdict
from itertools import product

import pytest

from hirelens.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, part string, pos int, n string"


def step(ways, state, letter, cost, line, target, into):
    if state in ways:
        base, audit, out = ways[state]
        way = (base + cost, audit + letter, out if line is None else out + (line,))
        into[target] = min(into.get(target, way), way)


def repaired(rows):
    """(cost, audit, lines) of rows (role, text, fault), a row at a time from the front; states by last initial."""
    def with_inserts(ways):
        for _ in range(2):
            more = dict(ways)
            for state in list(ways):
                letter, role = ("a", "assistant") if state == "u" else ("u", "user")
                step(ways, state, "I", 3, f"{role}:", letter, more)
            ways = more
        return ways

    ways = {"": (0, "", ())}
    for role, text, fault in rows:
        ways, after = with_inserts(ways), {}
        more = 3 if fault == "truncated" else 0
        for state in ways:
            step(ways, state, "D", 4, None, state, after)
            if fault in ("blank", "duplicate"):
                continue
            wanted, name = ("a", "assistant") if state == "u" else ("u", "user")
            if role[:1] == wanted or (role[:1] == "s" and state == ""):
                step(ways, state, "K", more, f"{role}:{text}", role[0], after)
            step(ways, state, "R", 3 + more, f"{name}:{text}", wanted, after)
        ways = after
    return min(way for state, way in with_inserts(ways).items() if state in ("", "a"))


def report(rows):
    """Everything about one conversation's rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    seen, faulty = set(), []
    for _, role, text in rows:
        fault = ("blank" if not text.strip("\x20\x09\x0a\x0b\x0c\x0d") else "duplicate" if (role, text) in seen else
                 "truncated" if text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1] not in ".!?" else None)
        seen.add((role, text))
        faulty.append((role, text, fault))
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = repaired(faulty)
    counts = [sum(f == kind for *_, f in faulty) for kind in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def symbol(role, fault):
    return C.GONE if fault in ("blank", "duplicate") else 2 * {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + (fault == "truncated")


def runs_of(symbols):
    return C.runs_of([{"symbol": s, "n": 1} for s in symbols])


def test_cheapest_of_all_edits():
    pick, kinds = random.Random(2), list(product(("system", "user", "assistant", "x"), (None, "truncated", "blank")))
    gaps = ["", "u", "a", "ua", "au"]
    for _ in range(40):
        rows = [(r, "t", f) for r, f in pick.choices(kinds, k=pick.randint(0, 3))]
        found = []
        for choice in product(gaps, *[product("DKua", gaps) for _ in rows]):
            cost, audit, roles = 3 * len(choice[0]), "I" * len(choice[0]), choice[0]
            for (role, _, fault), (edit, gap) in zip(rows, choice[1:]):
                if edit == "D":
                    cost, audit = cost + 4, audit + "D"
                elif fault == "blank":
                    break
                else:
                    cost += 3 * (edit != "K") + 3 * (fault == "truncated")
                    audit, roles = audit + ("K" if edit == "K" else "R"), roles + (role[0] if edit == "K" else edit)
                cost, audit, roles = cost + 3 * len(gap), audit + "I" * len(gap), roles + gap
            else:
                if re.fullmatch("(s?(ua)+)?", roles):
                    found.append((cost, audit))
        runs = runs_of([symbol(r, f) for r, _, f in rows])
        assert min(found) == repaired(rows)[:2]
        assert (C.before(C.matrix_of(runs), C.END)[C.START], C.unroll(runs, C.START, C.END, True)[0]) == min(found)


def test_random_conversations_and_runs():
    pick, kinds = random.Random(3), list(product(("system", "user", "assistant", "x"), (None, "truncated", "blank")))
    for _ in range(300):
        rows = [(r, "t", f) for r, f in pick.choices(kinds, k=pick.randint(1, 6)) for _ in range(pick.choice((1, 1, 2, 9, 40)))]
        runs = runs_of([symbol(r, f) for r, _, f in rows])
        assert (C.before(C.matrix_of(runs), C.END)[0], C.unroll(runs, 0, C.END, True)[0]) == repaired(rows)[:2]


def test_a_million_equal_rows():
    for kind, cost in ((2, 1_500_000), (C.GONE, 4_000_000), (6, 3_000_000)):
        audit, state = C.unroll([(kind, 1_000_000)], C.START, C.END, True)
        assert C.before(C.matrix_of([(kind, 1_000_000)]), C.END)[0] == cost and state in (C.START, C.AFTER_ASSISTANT)
        assert len(audit.replace("I", "")) == 1_000_000


def test_segments_give_what_the_whole_gives():
    pick = random.Random(4)
    for _ in range(100):
        symbols = [pick.randrange(9) for _ in range(pick.randint(2, 30))]
        cuts = sorted(pick.sample(range(1, len(symbols)), min(3, len(symbols) - 1)))
        pieces = [runs_of(symbols[a:b]) for a, b in zip([0, *cuts], [*cuts, len(symbols)])]
        behind, state, audit = [C.END], C.START, ""
        for piece in reversed(pieces[1:]):
            behind.insert(0, C.before(C.matrix_of(piece), behind[0]))
        for piece, costs in zip(pieces, behind):
            letters, state = C.unroll(piece, state, costs, costs is behind[-1])
            audit += letters
        assert audit == C.unroll(runs_of(symbols), C.START, C.END, True)[0]


def texts(pick):
    return pick.choice(["Yes.", "No", " ", "", None, "What?", "So it is!\n", "\x0b", "x", "\xa0", "Ünd.", "a.b"])


ROLES = ["user", "assistant", "user", "assistant", "system", "", None, "tool", "Ümlaut"]


def rows_of(pick):
    rows = [(c, t, pick.choice(ROLES), texts(pick), "p", 1, "n") for c in range(40) for t in range(pick.randint(1, 9))
            if pick.random() < 0.9]
    rows += [(None, pick.choice([None, 1, 2, 5]), pick.choice(ROLES), texts(pick), "p", 2, "n") for _ in range(30)]
    rows += [(50, None, "user", "Null turns.", "p", 3, None)] * 3 + [(50, None, "assistant", "Yes.", None, 3, None)]
    # One conversation holds most rows, one of its rows a third.
    rows += [(77, t, pick.choice(ROLES), pick.choice([texts(pick), f"Number {t}."]), "p", 4, "n") for t in range(-200, 1200)]
    rows += [(77, 300, "user", "Again and again.", "p", 5, "n")] * 900
    return rows


@pytest.fixture
def uncoalesced(spark):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    yield
    spark.conf.unset(setting)


def test_whole_tables(spark, uncoalesced):
    rows = rows_of(random.Random(5))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    reports, fixed = C.repair(frame)
    hashes = {r.conv_id: r.repaired_sha256 for r in C.digests(fixed).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashes.get(r.conv_id, nothing))
           for r in reports.collect()}
    want = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        want[conv].append((turn, " " if role is None else role, " " if text is None else text))
    assert got == {conv: report(held) for conv, held in want.items()}
    order = sorted((r for r in fixed.collect() if r.conv_id == 77), key=lambda r: (r.part, r.at))
    assert len({r.part for r in order}) > 1
    assert re.fullmatch("s?(ua)+", "".join(r.role[0] for r in order))


def test_empty_table(spark):
    reports, fixed = C.repair(spark.createDataFrame([], SCHEMA))
    assert reports.count() == 0 and fixed.count() == 0 and C.digests(fixed).count() == 0


@pytest.mark.parametrize("seed", [1])
def test_damage(spark, seed):
    import zlib
    pick = random.Random(seed)
    rows = [(c, t, pick.choice(ROLES), texts(pick), "p", 1, "n") for c in [*range(60), None] for t in [*range(5), None]]
    want = []
    for conv, turn, role, text, *_ in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        want += [(conv, turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    got = map(tuple, C.damaged(spark.createDataFrame(rows, SCHEMA)).collect())
    assert sorted(got, key=repr) == sorted(want, key=repr)
