"""Repair of conversation structure at least cost, by a run-length dynamic programme.

A conversation must read as ``(s?(ua)+)?`` by the initials of its roles. Rows are kept, given the role
user or assistant, or deleted; empty rows of the two roles are inserted. Blank rows and repetitions
have to go, truncated rows cost extra if they stay.

Only two things of a row matter to the programme, role class and fault: its symbol. Equal rows
of one turn collapse to a count, equal consecutive symbols to a run. What a row does to the costs of
the four states (nothing yet, after system, after user, after assistant) is a 4 x 4 matrix in the
min-plus algebra; a run of k rows is its k-th power, put together from cached binary powers. The
choices are then unrolled from the front: in each state the first edit, in the order of its letter,
that leads to the least cost.

Long conversations are split. All rows are ordered by range partitions over (conversation, turn, ...),
and what one conversation has in one partition is a segment. Segments yield their matrix, the few
matrices of a conversation give the costs behind each segment, segments are unrolled from every state
they may be entered in, and the states are chained. Texts take no part in this; they are joined to
the edits at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache
from itertools import chain, repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import stored
from hirelens.sources.tables import read_parquet

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# Role classes: first letters s, u, a, and anything else (also no letter).
SYSTEM, USER, ASSISTANT, OTHER = range(4)
# Symbols: twice the role class, plus one for a truncated row; and rows that must go.
GONE = 8
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = STATES = range(4)
# The role that may follow in each state (system only at the start), and the state behind each role.
NEXT_ROLE = (USER, USER, ASSISTANT, USER)
BEHIND = (AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT)
ROLE_NAMES = ("system", "user", "assistant")
FAR = 1 << 50
Costs = tuple[int, int, int, int]
Matrix = tuple[Costs, Costs, Costs, Costs]
# Powers up to this one (2^n rows) keep their unrolled choices.
KEPT_LEVELS = 10


# --- the programme ----------------------------------------------------------------------------


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, min(row[k] + b[k][j] for k in STATES)) for j in STATES) for row in a)


def before(matrix: Matrix, costs: Costs) -> Costs:
    """Least costs to the end from in front of what the matrix stands for."""
    return tuple(min(FAR, min(row[k] + costs[k] for k in STATES)) for row in matrix)


IDENTITY: Matrix = tuple(tuple(0 if i == j else FAR for j in STATES) for i in STATES)


def edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that consume a row, in the order of their letters."""
    found = [("D", DELETE, state)]
    if symbol == GONE:
        return found
    role, extra = symbol // 2, TRUNCATED * (symbol % 2)
    if role == NEXT_ROLE[state] or (role == SYSTEM and state == START):
        found.append(("K", KEEP + extra, BEHIND[role]))
    found.append(("R", REROLE + extra, BEHIND[NEXT_ROLE[state]]))
    return found


def inserted(state: int) -> int:
    return BEHIND[NEXT_ROLE[state]]


def _inserts() -> Matrix:
    """Costs of insertions between two states; the third leads back to where one was."""
    rows = []
    for state in STATES:
        row, cost = [FAR] * 4, 0
        for _ in range(3):
            row[state] = min(row[state], cost)
            state, cost = inserted(state), cost + INSERT
        rows.append(tuple(row))
    return tuple(rows)


INSERTS = _inserts()
# Costs to the end behind the last row.
END: Costs = tuple(min(INSERTS[s][START], INSERTS[s][AFTER_ASSISTANT]) for s in STATES)


@cache
def power(symbol: int, level: int) -> Matrix:
    """What 2^level rows of a symbol do, insertions before each row included."""
    if level:
        half = power(symbol, level - 1)
        return times(half, half)
    row = [[FAR] * 4 for _ in STATES]
    for state in STATES:
        for _, cost, target in edits(symbol, state):
            row[state][target] = min(row[state][target], cost)
    return times(INSERTS, tuple(map(tuple, row)))


def blocks(runs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs (symbol, count) as (symbol, level) of binary powers."""
    return [(symbol, level) for symbol, count in runs for level in range(count.bit_length()) if count >> level & 1]


def matrix_of(runs: Sequence[tuple[int, int]]) -> Matrix:
    whole = IDENTITY
    for symbol, level in blocks(runs):
        whole = times(whole, power(symbol, level))
    return whole


def unroll_block(symbol: int, level: int, state: int, behind: Costs) -> tuple[str, int]:
    """The first of the cheapest ways through 2^level rows of a symbol, and the state it ends in."""
    least = min(behind)
    relative = tuple(min(FAR, c - least) for c in behind)
    return (_unroll_kept if level <= KEPT_LEVELS else _unroll)(symbol, level, state, relative)


def _unroll(symbol: int, level: int, state: int, behind: Costs) -> tuple[str, int]:
    if level:
        first, state = unroll_block(symbol, level - 1, state, before(power(symbol, level - 1), behind))
        second, state = unroll_block(symbol, level - 1, state, behind)
        return first + second, state
    ahead, letters = before(power(symbol, 0), behind), ""
    while True:
        for letter, cost, target in edits(symbol, state):
            if letter > "I" and INSERT + ahead[inserted(state)] == ahead[state]:
                break
            if cost + behind[target] == ahead[state]:
                return letters + letter, target
        letters, state = letters + "I", inserted(state)


_unroll_kept = lru_cache(maxsize=1 << 14)(_unroll)


def unroll(runs: Sequence[tuple[int, int]], state: int, behind: Costs, last: bool) -> tuple[str, int]:
    """Letters of the edits of a segment and the state behind it; the last segment ends the conversation."""
    steps, costs = blocks(runs), [behind]
    for symbol, level in reversed(steps):
        costs.append(before(power(symbol, level), costs[-1]))
    letters = []
    for (symbol, level), behind_it in zip(steps, reversed(costs[:-1])):
        part, state = unroll_block(symbol, level, state, behind_it)
        letters.append(part)
    while last and END[state]:
        letters.append("I")
        state = inserted(state)
    return "".join(letters), state


# --- rows and segments ------------------------------------------------------------------------


def role_class(role: Column) -> Column:
    letter = F.substring(role, 1, 1)
    return F.when(letter == "s", SYSTEM).when(letter == "u", USER).when(letter == "a", ASSISTANT).otherwise(OTHER)


LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
_ROW = "struct<pos:bigint,role:int,symbol:int,n:bigint,turn:bigint,body:binary>"
_SEGMENT = f"conv bigint, part bigint, rows array<{_ROW}>, matrix array<bigint>, illegal bigint, first int, last int"


def body_of(role: Column, text: Column) -> Column:
    """Digest that tells apart whatever differs in role or text."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Different rows of each turn with their number, in order: ``pos`` grows over all rows, ``part`` is a bounded share."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    # Without \z, $ would also match before a line end.
    cut_off = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    narrow = rows.select("conv", "turn", "role", body_of(F.col("role"), F.col("text")).alias("body"),
                         blank.alias("blank"), cut_off.alias("cut_off"))
    collapsed = narrow.groupBy("conv", "turn", "role", "body", "blank", "cut_off").agg(F.count(F.lit(1)).alias("n"))
    keys = ["conv", "turn", "role", "body"]
    dealt = collapsed.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("pos", F.monotonically_increasing_id())
    return stored(dealt.withColumn("part", F.shiftright("pos", 33)), "conversation-rows")


def flagged(ordered: DataFrame) -> DataFrame:
    """The rows with ``fresh``: no row before them in the conversation has their role and text."""
    firsts = ordered.groupBy("conv", "body").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("fresh"))
    return ordered.join(firsts, "pos", "left").withColumn("fresh", F.coalesce("fresh", F.lit(False)))


def segments(rows: DataFrame) -> DataFrame:
    """One row per conversation and part: its rows in order, its matrix, illegal neighbours inside, roles at its ends."""
    role = role_class(F.col("role"))
    symbol = F.when(F.col("blank") | ~F.col("fresh"), GONE).otherwise(2 * role + F.col("cut_off").cast("int"))
    row = F.struct("pos", role.alias("role"), symbol.alias("symbol"), "n", "turn", "body")
    # A part is one range partition's share, so the list is bounded whatever a conversation holds.
    grouped = rows.groupBy("conv", "part").agg(F.sort_array(F.collect_list(row)).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrices, illegal, first, last = [], [], [], []
            for held in batch.column("rows").to_pylist():
                roles = [r["role"] for r in held]
                matrices.append([c for line in matrix_of(runs_of(held)) for c in line])
                illegal.append(sum(pair not in LEGAL for pair in zip(roles, roles[1:])) + sum(r["n"] - 1 for r in held))
                first.append(roles[0])
                last.append(roles[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(matrices, pa.list_(pa.int64())), pa.array(illegal, pa.int64()),
                 pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                names=["conv", "part", "rows", "matrix", "illegal", "first", "last"])

    return stored(grouped.mapInArrow(run, _SEGMENT), "conversation-segments")


def runs_of(rows: Sequence[dict]) -> list[tuple[int, int]]:
    """Rows in order as runs of equal symbols; repetitions of a row must go."""
    runs: list[tuple[int, int]] = []
    for row in rows:
        for symbol, count in ((row["symbol"], 1), (GONE, row["n"] - 1)):
            if count and runs and runs[-1][0] == symbol:
                runs[-1] = symbol, runs[-1][1] + count
            elif count:
                runs.append((symbol, count))
    return runs


def outlook(parts: DataFrame) -> DataFrame:
    """(conv, part, behind, last, cost): costs to the end behind each segment, from the matrices of its conversation."""
    # A conversation has at most one matrix a range partition.
    grouped = parts.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "matrix"))).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, found in zip(batch.column("conv").to_pylist(), batch.column("m").to_pylist()):
                behind, told = END, []
                for part in reversed(found):
                    told.append([conv, part["part"], list(behind), part is found[-1]])
                    flat = part["matrix"]
                    behind = before([flat[i:i + 4] for i in range(0, 16, 4)], behind)
                out += [(*row, behind[START]) for row in told]
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["conv", "part", "behind", "ends", "cost"])

    return grouped.mapInArrow(run, "conv bigint, part bigint, behind array<bigint>, ends boolean, cost bigint")


def matched(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns that both have, where null equals null."""
    other = right.withColumnsRenamed({n: f"{n}_of_right" for n in names})
    condition = F.lit(True)
    for n in names:
        condition &= F.col(n).eqNullSafe(F.col(f"{n}_of_right"))
    return left.join(other, condition, how).drop(*(f"{n}_of_right" for n in names))


def unrolled(parts: DataFrame) -> DataFrame:
    """(conv, part, cost, audits, exits): for each state a segment may be entered in, its edits and the state behind it."""
    joined = matched(parts, outlook(parts), ["conv", "part"]).select(
        "conv", "part", F.transform("rows", lambda r: F.struct(r["symbol"], r["n"])).alias("rows"),
        "behind", "ends", "cost", "illegal", "first", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, exits = [], []
            lists = (batch.column(c).to_pylist() for c in ("rows", "behind", "ends"))
            for rows, behind, ends in zip(*lists):
                runs = runs_of(rows)
                ways = [unroll(runs, state, tuple(behind), ends) for state in STATES]
                audits.append([w[0] for w in ways])
                exits.append([w[1] for w in ways])
            kept = ["conv", "part", "cost", "illegal", "first", "last"]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), pa.array(audits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int64()))],
                names=[*kept, "audits", "exits"])

    return stored(joined.mapInArrow(
        run, "conv bigint, part bigint, cost bigint, illegal bigint, first int, last int, audits array<string>, "
             "exits array<bigint>"), "conversation-choices")


def chained(choices: DataFrame) -> DataFrame:
    """One row per conversation: cost, audit, illegal neighbours, and the state each segment is entered in."""
    nothing = F.struct(F.lit(START).cast("bigint").alias("state"), F.lit(-1).alias("role"), F.lit(0).cast("bigint").alias("illegal"),
                       F.array().cast("array<struct<part:bigint,state:bigint,audit:string>>").alias("steps"))

    def step(done: Column, part: Column) -> Column:
        legal = F.lit(False)
        for a, b in sorted(LEGAL):
            legal |= (done["role"] == a) & (part["first"] == b)
        across = ((done["role"] >= 0) & ~legal).cast("bigint")
        at = F.struct(part["part"].alias("part"), done["state"].alias("state"),
                      F.get(part["audits"], done["state"].cast("int")).alias("audit"))
        return F.struct(F.get(part["exits"], done["state"].cast("int")).alias("state"), part["last"].alias("role"),
                        (done["illegal"] + part["illegal"] + across).alias("illegal"),
                        F.concat(done["steps"], F.array(at)).alias("steps"))

    # One audit a conversation is what is asked for; here it is held once for each of the four states.
    listed = F.sort_array(F.collect_list(F.struct("part", "first", "last", "illegal", "exits", "audits")))
    folded = choices.groupBy("conv").agg(F.max("cost").alias("cost"), F.aggregate(listed, nothing, step).alias("f"))
    return folded.select("conv", "cost", F.col("f.illegal").alias("illegal"), F.col("f.steps").alias("steps"),
                         F.array_join(F.col("f.steps.audit"), "").alias("audit"))


def edit_rows(parts: DataFrame, chains: DataFrame) -> DataFrame:
    """Rows that remain, in the order (part, at): own rows by turn and body with their new role (null: the old), or inserted."""
    entered = chains.select("conv", F.explode("steps").alias("s")).select("conv", "s.*")
    joined = matched(parts, entered, ["conv", "part"]).select("conv", "part", "rows", "state", "audit")
    schema = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("at", pa.int64()), ("edit", pa.string()),
                        ("new_role", pa.string()), ("turn", pa.int64()), ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for segment in batch.to_pylist():
                left = chain.from_iterable(chain([row], repeat(None, row["n"] - 1)) for row in segment["rows"])
                state = segment["state"]
                for at, letter in enumerate(segment["audit"]):
                    role = NEXT_ROLE[state]
                    row = None if letter == "I" else next(left)
                    if letter == "D":
                        continue
                    if letter == "K":
                        role = row["role"]
                    state = BEHIND[role]
                    out.append((segment["conv"], segment["part"], at, letter, None if letter == "K" else ROLE_NAMES[role],
                                row and row["turn"], row and row["body"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(schema), schema)], schema=schema)

    return joined.mapInArrow(run, "conv bigint, part bigint, at bigint, edit string, new_role string, turn bigint, body binary")


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Reports, one row per conversation, and the repaired rows.

    Reports: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. Rows: conv_id, part and
    at (their order), turn, role, text, edit (K, R, or I with a null turn).

    Rows are ordered by turn, nulls first, then by role and a digest of the text. A null role or text
    counts as one space. A null identifier is a conversation of its own. A role without a first letter
    is no role that may be kept. Repeated rows are duplicates. An empty table gives no rows; a
    conversation in which nothing remains has an audit of deletions and no rows. Further columns are
    not read. The audit of a conversation must fit one value.
    """
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    ordered = ordered_rows(rows)
    faulty = flagged(ordered)
    parts = segments(faulty)
    chains = stored(chained(unrolled(parts)), "conversation-audits")

    good = F.col("fresh") & ~F.col("blank")
    counted = faulty.groupBy("conv").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.col("n") - F.col("fresh").cast("long")).otherwise(0)).alias("duplicate"),
        F.count_if(good & F.col("cut_off")).alias("truncated"))
    turns = ordered.groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    reports = matched(matched(chains, counted, ["conv"]), turns, ["conv"]).select(
        F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    edited = stored(edit_rows(parts, chains), "conversation-edits")
    # Equal rows of one turn are interchangeable; one of them is enough, found before the shuffle.
    texts = rows.groupBy("conv", "turn", body_of(F.col("role"), F.col("text")).alias("body")).agg(
        F.first("role").alias("role"), F.first("text").alias("text"))
    own = edited.where(F.col("edit") != "I")
    shown = ["conv_id", "part", "at", "turn", "role", "text", "edit"]
    kept = matched(own, texts, ["conv", "turn", "body"]).select(
        F.col("conv").alias("conv_id"), "part", "at", "turn", F.coalesce("new_role", "role").alias("role"), "text", "edit")
    new = edited.where(F.col("edit") == "I").select(
        F.col("conv").alias("conv_id"), "part", "at", "turn", F.col("new_role").alias("role"), F.lit("").alias("text"), "edit")
    return reports, kept.select(shown).unionByName(new.select(shown))


# --- the query --------------------------------------------------------------------------------


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of each conversation's ``role:text`` lines; lines stream through the hash, none are held."""
    lines = repaired.select("conv_id", "part", "at", F.concat("role", F.lit(":"), "text").alias("line"))
    dealt = lines.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                               pa.array([r[1] for r in rows], pa.string())], names=["conv_id", "repaired_sha256"])

        conv, digest, done = None, None, []
        for batch in batches:
            for key, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
                if digest is None or key != conv:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(line.encode())
            yield told(done)
            done = []
        if digest is not None:
            yield told([(conv, digest.hexdigest())])

    return dealt.mapInArrow(run, "conv_id bigint, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Some rows dropped, emptied, without their sentence ends, repeated, or under the role user; nulls count as one space."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    draw = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return conversations.select(
        "conv_id", "turn", draw.alias("draw"), F.when(draw == 4, "user").otherwise(role).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
    ).where(F.col("draw") != 0).select(
        "conv_id", "turn", "role", "text", F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0)))).alias("copy")).drop("copy")


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged, then repaired: what was wrong, the cheapest edits, a digest of the result."""
    table = read_parquet(spark, f"{sf_dir}/conversations.parquet")
    reports, repaired = repair(damaged(table))
    every = table.select("conv_id").distinct()
    found = matched(matched(every, reports, ["conv_id"], "left"), digests(repaired), ["conv_id"], "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        "conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def _sql_step(state: str, letter: str, cost: str, line: str | None = None) -> str:
    out = f"list_append({state}.out, {line})" if line else f"{state}.out"
    return f"{{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{letter}', 'out': {out}}}"


def _sql_conversation_repair() -> str:
    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    user, assistant = "'user:'", "'assistant:'"
    add_user = [_sql_step(s, "I", "3", user) for s in ("s0", "s1", "s3")]
    add_both = [_sql_step(f"({_sql_step(s, 'I', '3', user)})", "I", "3", assistant) for s in ("s0", "s1")]
    closed = (f"s0 AS c0, s1 AS c1, {least('s2', *add_user)} AS c2, "
              f"{least('s3', _sql_step('s2', 'I', '3', assistant), *add_both)} AS c3")
    extra = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"

    def keep(state: str, letter: str) -> str:
        barred = f"CASE WHEN fault IN ('blank', 'duplicate') OR role NOT LIKE '{letter}%' THEN 1000000000 ELSE 0 END"
        return _sql_step(state, "K", f"{barred} + {extra}", "role || ':' || text")

    def rename(state: str, role: str) -> str:
        barred = "CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 ELSE 3 END"
        return _sql_step(state, "R", f"{barred} + {extra}", f"'{role}:' || text")

    nothing = "{'cost': 1000000000::BIGINT, 'audit': '', 'out': []::VARCHAR[]}"
    drop = [_sql_step(f"c{k}", "D", "4") for k in range(4)]
    to_user = [edit for c in ("c0", "c1", "c3") for edit in (keep(c, "u"), rename(c, "user"))]
    return f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations
), drawn AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))),
    4294967295) % 20 AS draw
  FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn, (VALUES (0), (1)) AS copies(copy)
  WHERE draw <> 0 AND (draw = 3 OR copy = 0)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM damaged
), faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) || substr(role, 1, 1) AS pair
  FROM numbered
), told AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (place > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id
), walk AS (
  SELECT conv_id, 0::BIGINT AS place, {{'cost': 0::BIGINT, 'audit': '', 'out': []::VARCHAR[]}} AS s0,
         {nothing} AS s1, {nothing} AS s2, {nothing} AS s3
  FROM told
  UNION ALL
  SELECT conv_id, place, {drop[0]}, {least(drop[1], keep('c0', 's'))}, {least(drop[2], *to_user)},
         {least(drop[3], keep('c2', 'a'), rename('c2', 'assistant'))}
  FROM (SELECT f.conv_id, f.place, f.role, f.text, coalesce(f.fault, '') AS fault, {closed}
        FROM walk JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM walk.conv_id AND f.place = walk.place + 1)
), ended AS (
  SELECT walk.conv_id, {least('c0', 'c3')} AS best
  FROM (SELECT conv_id, place, {closed} FROM walk) walk
  JOIN told ON told.conv_id IS NOT DISTINCT FROM walk.conv_id AND told.n = walk.place
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM o.conv_id
"""


CONVERSATION_REPAIR_SQL = _sql_conversation_repair()
