"""Skill tagging against a taxonomy: exact names and near misses, per row, without a join.

The taxonomy is a parameter of the job (skill -> further names, order matters); it becomes
literals of the plan, so tagging needs no shuffle and no broadcast whatever the volume.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.text import bind

Taxonomy = Mapping[str, Sequence[str]]
# Without (?U) these are the same characters, which the JVM finds as one class.
_NAME_START = V.NAME_START.replace("A-Za-z0-9_", r"\w")


def taxonomy_names(taxonomy: Taxonomy) -> list[tuple[int, str]]:
    """(position of the skill, name) for every name."""
    return [
        (ord_, name)
        for ord_, (skill, aliases) in enumerate(taxonomy.items())
        for name in dict.fromkeys([skill, *aliases])
    ]


def _key(name: str) -> str:
    return " ".join(name.lower().split())


def _layers(names: list[str]) -> list[list[str]]:
    """Split names so that none begins with another of its layer.

    A zero-width search reports one name per position; "React" and "React Native", or "CI" and
    "CI/CD", begin at the same position, so they must be searched separately. White space counts
    as one blank; a name that goes on inside a word is no risk, but costs nothing either.
    """
    depth: dict[str, int] = {}
    for key in sorted({_key(name) for name in names}, key=len):
        depth[key] = max((d for other, d in depth.items() if key.startswith(other)), default=-1) + 1
    grouped = defaultdict(list)
    for name in dict.fromkeys(names):
        grouped[depth[_key(name)]].append(name)
    return [grouped[level] for level in sorted(grouped)]


def _search_pattern(names: list[str]) -> str:
    """Zero-width pattern whose group is the longest name at a position, grouped by first letter."""
    by_start: dict[str, list[str]] = defaultdict(list)
    for name in sorted(names, key=len, reverse=True):
        head, *tail = name.split()
        exact = name in V.CASE_SENSITIVE_NAMES
        spellings = [name, name.upper()] if exact else [name]
        start = re.escape(name[0]) if exact or not name[0].isalpha() else f"[{name[0].lower()}{name[0].upper()}]"
        for spelling in spellings:
            head, *tail = spelling.split()
            words = r"\s+".join(r"\Q" + w + r"\E" for w in [head[1:], *tail])
            by_start[start].append(words if exact else f"(?i:{words})")
    # A look behind by plain classes and one at the next character rule most positions out before the names are tried,
    # a few first letters at a time.
    letters = sorted(by_start, key=lambda start: start.strip("[\\")[0].lower())
    groups = [letters[i:i + 5] for i in range(0, len(letters), 5)]
    branches = [f"(?=[{''.join(c.strip('[]') for c in group)}])(?:{'|'.join(f'{c}(?:{"|".join(by_start[c])})' for c in group)})"
                for group in groups]
    initials = "".join(c.strip("[]") for c in letters)
    return rf"{_NAME_START}(?=[{initials}])(?U)(?=({'|'.join(branches)}){V.NAME_END})"


def exact_skill_positions(text: Column, taxonomy: Taxonomy) -> Column:
    """Positions (in taxonomy order numbers) of the skills named in the text, unsorted."""
    names = taxonomy_names(taxonomy)
    holders: dict[str, list[int]] = defaultdict(list)  # a name may belong to several skills
    for ord_, name in names:
        if ord_ not in holders[_key(name)]:
            holders[_key(name)].append(ord_)
    # One short map for each length of a name: a map is searched entry by entry.
    sized: dict[int, list[Column]] = defaultdict(list)
    for key, at in holders.items():
        sized[len(key)] += [F.lit(key), F.array(*map(F.lit, at))]
    none = F.lit(None).cast("map<string,array<int>>")
    lookup = F.array(*[F.create_map(*sized[n]) if n in sized else none for n in range(max(sized) + 1)])

    def holding(key: Column) -> Column:
        return F.element_at(F.get(lookup, F.length(key)), key)

    found = [
        F.regexp_extract_all(text, F.lit(_search_pattern(layer)), F.lit(1))
        for layer in _layers([name for _, name in names])
    ]
    hits = F.concat(*found) if len(found) > 1 else found[0]
    # Only names of several words can need their white space evened out.
    evened = lambda key: F.regexp_replace(key, r"(?U)\s+", " ")
    return F.array_distinct(F.flatten(F.transform(
        F.array_distinct(F.transform(hits, lambda h: F.lower(h))), lambda key: F.coalesce(holding(key), holding(evened(key))))))


# --- near misses --------------------------------------------------------------------


def fuzzy_choices(taxonomy: Taxonomy) -> dict[str, int]:
    """Lower-case single-word names of six letters or more -> position of their skill."""
    choices: dict[str, int] = {}
    for ord_, name in taxonomy_names(taxonomy):
        if re.fullmatch(r"[A-Za-z0-9]{6,}", name):
            choices[name.lower()] = ord_
    return choices


def _max_edits(length: int, threshold: int) -> int:
    """Most single-letter insertions plus deletions any token within the threshold may have."""
    slack = 100 - threshold
    edits = 0
    # a token reached by e edits is at most e letters longer: 100 * e <= slack * (2 * length + e)
    while 100 * (edits + 1) <= slack * (2 * length + edits + 1):
        edits += 1
    return edits


def _near_miss_pieces(choices: Sequence[str], threshold: int) -> tuple[set[str], set[str], set[str], int]:
    """(beginnings, endings, inner pieces, shortest token an inner piece is needed for).

    With e edits, one of e + 1 pieces of a name survives intact; an intact first piece
    stands at the start of the token and an intact last piece at its end.
    """
    starts, ends, inner, shortest = set(), set(), set(), 1_000_000
    for name in choices:
        edits = _max_edits(len(name), threshold)
        cuts = [round(i * len(name) / (edits + 1)) for i in range(edits + 2)]
        pieces = [name[a:b] for a, b in zip(cuts, cuts[1:])]
        starts.add(pieces[0])
        ends.add(pieces[-1])
        if edits > 1:
            inner.update(pieces[1:-1])
            # fewer than two edits leave the first or the last piece intact
            shortest = min(
                n for n in [shortest, *range(1, 2 * len(name))]
                if n == shortest or 200 <= (100 - threshold) * (len(name) + n)
            )
    return starts, ends, inner, shortest


def may_be_near_miss(word: Column, choices: Sequence[str], threshold: int) -> Column:
    """True for every word within the threshold of a choice, and for few others."""
    starts, ends, inner, shortest = _near_miss_pieces(choices, threshold)
    if "" in starts | ends:
        return F.lit(True)
    fits = F.lit(False)
    for pieces, side in ((starts, F.left), (ends, F.right)):
        for size in sorted({len(p) for p in pieces}):
            fits = fits | side(word, F.lit(size)).isin(*sorted(p for p in pieces if len(p) == size))
    if inner:
        fits = fits | ((F.length(word) >= shortest) & word.rlike("|".join(sorted(inner))))
    return fits


def fuzzy_tokens(text: Column, taxonomy: Taxonomy, threshold: int = V.FUZZY_THRESHOLD) -> Column:
    """Distinct lower-case words of the text that could be a misspelt name (no name itself)."""
    choices = list(fuzzy_choices(taxonomy))
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[a-z][a-z0-9]{5,}"), F.lit(0)))
    return F.filter(words, lambda w: may_be_near_miss(w, choices, threshold) & ~w.isin(*choices))


def _matching_run(a: Column, b: Column, side) -> Column:
    """Length of the longest common beginning (``side=F.left``) or ending (``F.right``)."""
    shorter = F.least(F.length(a), F.length(b))
    steps = F.sequence(F.lit(1), F.greatest(shorter, F.lit(1)))
    return F.size(F.filter(steps, lambda i: (i <= shorter) & (side(a, i) == side(b, i))))


def _common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence: one table row per letter of ``a``."""
    letters = F.split(b, "")
    first = F.transform(F.concat(F.array(F.lit("")), letters), lambda _: F.lit(0))

    def next_row(previous: Column, letter: Column) -> Column:
        def cell(row: Column, i: Column) -> Column:
            best = F.when(
                F.get(letters, i) == letter, F.get(previous, i) + 1
            ).otherwise(F.greatest(F.element_at(row, -1), F.get(previous, i + 1)))
            return F.concat(row, F.array(best))

        return F.aggregate(F.sequence(F.lit(0), F.size(letters) - 1), F.array(F.lit(0)), cell)

    table = F.element_at(F.aggregate(F.split(a, ""), first, next_row), -1)
    return F.when((a == "") | (b == ""), F.lit(0)).otherwise(table)


def _inserts_and_deletes(a: Column, b: Column, edits: Column) -> Column:
    """Fewest insertions plus deletions between two words, given their edit distance.

    With d the difference in length, d edits hold no substitution and d + 1 edits exactly
    one, which counts double. Only beyond that is the common subsequence needed, and then
    just between the common beginning and the common ending.
    """
    gap = F.abs(F.length(a) - F.length(b))

    def middle(w: Column) -> Column:
        inner = F.length(w["a"]) + F.length(w["b"]) - 2 * w["tail"]
        cut = lambda x: F.left(w[x], F.length(w[x]) - w["tail"])
        return (inner - 2 * _common_subsequence(cut("a"), cut("b"))).cast("int")

    def with_tail(w: Column) -> Column:
        return F.struct(w["a"], w["b"], _matching_run(w["a"], w["b"], F.right).alias("tail"))

    head = _matching_run(a, b, F.left)
    rest = bind(head, lambda h: F.struct(
        F.substr(a, h + 1, F.length(a)).alias("a"), F.substr(b, h + 1, F.length(b)).alias("b")
    ))
    return (
        F.when(edits == gap, gap)
        .when(edits == gap + 1, gap + 2)
        .otherwise(bind(bind(rest, with_tail), middle))
    )


def best_choice(word: Column, taxonomy: Taxonomy, threshold: int = V.FUZZY_THRESHOLD) -> Column:
    """struct(ratio, name, position) of the closest name at or above the threshold, else null.

    The ratio is the share of letters kept when only inserting and deleting, in percent;
    ties go to the earlier name.
    """
    slack = 100 - threshold
    # Word length -> the names whose length is near enough.
    reach: dict[int, list[Column]] = defaultdict(list)
    for i, (name, position) in enumerate(fuzzy_choices(taxonomy).items()):
        entry = F.struct(F.lit(i).alias("rank"), F.lit(name).alias("name"), F.lit(position).alias("position"))
        for size in range(1, len(name) + _max_edits(len(name), threshold) + 1):
            if 100 * abs(size - len(name)) <= slack * (size + len(name)):
                reach[size].append(entry)
    by_length = F.create_map(*[c for size, entries in reach.items() for c in (F.lit(size), F.array(*entries))])
    # No pair within the threshold has more edits; beyond them the distance is given as -1.
    most = max((slack * (size + len(name)) // 100 for size in reach for name in fuzzy_choices(taxonomy)), default=0)

    def total(n: Column) -> Column:
        return F.length(word) + F.length(n["name"])

    measured = F.transform(
        F.element_at(by_length, F.length(word)),
        lambda n: F.struct(
            n["rank"].alias("rank"), n["name"].alias("name"), n["position"].alias("position"),
            F.levenshtein(word, n["name"], most).alias("edits"),
        ),
    )
    # Substitutions make the edit distance a lower bound of insertions plus deletions.
    near = F.filter(measured, lambda n: (n["edits"] >= 0) & (100 * n["edits"] <= slack * total(n)))
    scored = F.transform(
        near,
        lambda n: F.struct(
            (100.0 * (total(n) - _inserts_and_deletes(word, n["name"], n["edits"])) / total(n)).alias("ratio"),
            (-n["rank"]).alias("rank"),
            n["name"].alias("name"),
            n["position"].alias("position"),
        ),
    )
    best = F.array_max(F.filter(scored, lambda s: s["ratio"] >= threshold))
    return bind(best, lambda b: F.when(b.isNotNull(), F.struct(b["ratio"], b["name"], b["position"])))


def fuzzy_skill_positions(text: Column, taxonomy: Taxonomy, threshold: int = V.FUZZY_THRESHOLD) -> Column:
    """Positions of the skills some word of the text nearly spells; duplicates and nulls possible."""
    hits = F.transform(
        fuzzy_tokens(text, taxonomy, threshold),
        lambda w: best_choice(w, taxonomy, threshold)["position"],
    )
    return hits


def skills_in_order(positions: Column, taxonomy: Taxonomy) -> Column:
    """Order numbers -> skill names, taxonomy order, no duplicates."""
    names = F.array(*[F.lit(skill) for skill in taxonomy])
    return F.transform(F.sort_array(F.array_distinct(F.array_compact(positions))), lambda p: F.get(names, p))


def extract_skills(text: Column, taxonomy: Taxonomy, fuzzy: bool = True,
                   threshold: int = V.FUZZY_THRESHOLD) -> Column:
    """Skills mentioned in the text, in taxonomy order; [] for blank text."""
    positions = exact_skill_positions(text, taxonomy)
    if fuzzy:
        positions = F.concat(positions, fuzzy_skill_positions(text, taxonomy, threshold))
    return F.coalesce(skills_in_order(positions, taxonomy), F.array().cast("array<string>"))
