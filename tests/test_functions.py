import random
from datetime import date, datetime

from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions import dates, flags, formats, salary, skills, text


def test_normalize_text(column):
    values = ["  Lead\t\n Da ta ​Engineer ", "  \n\t ", None, "ｗｉｄｅ ﬁne…", "a\x1cb\x85c", "plain words", "Ünï  çode"]
    want = ["Lead Da ta Engineer", None, None, "wide fine...", "a b c", "plain words", "Ünï çode"]
    assert column(values, text.normalize_text) == want


def test_trailing_newline_is_not_tidy(column):
    assert column(["plain words\n", "x​"], text.normalize_text) == ["plain words", "x"]


def test_normalize_location(column):
    values = ["  paris ,FR. ", "HYBRID (UK)", "Oslo, Norway", " ,;.- ", "(usa) EMEA WARSAW mcLean [rome] ÅRHUS", None]
    want = ["Paris, FR", "Hybrid (UK)", "Oslo, Norway", None, "(Usa) EMEA Warsaw mcLean [Rome] Århus", None]
    assert column(values, text.normalize_location) == want


def test_normalize_url(column):
    values = ["javascript:alert(1)", " HTTPS://a.test/x ", "http://b", "ftp://c", None]
    assert column(values, text.normalize_url) == [None, "HTTPS://a.test/x", "http://b", None, None]


def test_truncate(column):
    values = ["a" * 10, "a" * 11, "abcdefgh  xyz", None]
    assert column(values, lambda c: text.truncate(c, 10)) == ["a" * 10, "a" * 9 + "…", "abcdefgh…", None]


def test_hash_ignores_case_and_edges(column):
    import hashlib

    def build(c):
        return text.stable_hash(F.lit("S"), c, F.lit(None).cast("string"))

    want = hashlib.sha256(b"s|acme corp|").hexdigest()[:16]
    assert column(["Acme Corp", " ACME corp \n"], build) == [want, want]
    assert column(["x|y"], lambda c: text.stable_hash(c, length=64))[0] == hashlib.sha256(b"x|y").hexdigest()


def test_split_list(column):
    assert column(["a, b,, c ", "", None], text.split_list) == [["a", "b", "c"], [], None]


def test_parse_date(column):
    cases = {
        "2024-02-29": date(2024, 2, 29), "2024-02-29T23:59:59.5-08:00": date(2024, 2, 29),
        "2024-02-29 10:00": date(2024, 2, 29), "2024-2-9": date(2024, 2, 9), "2023-02-29": None,
        "2024-02": None, "2024": None, "2024-02-29x": None, "March 7, 2023": date(2023, 3, 7),
        "mar 07, 2023": date(2023, 3, 7), "7 March 2023": date(2023, 3, 7), "7 MAR 2023": date(2023, 3, 7),
        "Sept 3, 2023": None, "07/03/2023": date(2023, 3, 7), "03/27/2023": date(2023, 3, 27),
        "31/02/2023": None, "1/2/23": None, "soon": None, " 7 March  2023 ": date(2023, 3, 7),
    }
    assert column([*cases, None], dates.parse_date) == [*cases.values(), None]


def test_salary(column):
    cases = {
        "between $90k-$110k a year": (90000.0, 110000.0, "USD"),
        "£45,500 – £50,250": (45500.0, 50250.0, "GBP"),
        "€70-95k": (70000.0, 95000.0, "EUR"),
        "95k to 70k eur": (70000.0, 95000.0, "EUR"),
        "90-110k": (90000.0, 110000.0, None),
        "$30-$45 an hour": None, "$45,000/hr": None, "$25 per hour, later $80k": (80000.0, 80000.0, "USD"),
        "raised $300 million": None, "$5k-$9k bonus, base $130,000": (130000.0, 130000.0, "USD"),
        "$1,500,000": None, "$62.5k+": (62500.0, 62500.0, "USD"), "": None,
        "$100k-$120k or 90-95k": (100000.0, 120000.0, "USD"),
        "\u0001$90k\u0002-\u0001$95k": (90000.0, 90000.0, "USD"),
    }
    got = column([*cases, None], salary.extract_salary)
    assert [tuple(g) if g else None for g in got] == [*cases.values(), None]


def test_remote_and_seniority(column):
    texts = ["Fully Remote", "no remote", "remote is not possible", "non-fully remote, wfh ok", "on-site only", "", None]
    assert column(texts, flags.detect_remote) == [True, False, False, True, False, False, False]
    titles = ["Sr. Analyst", "Senior Manager", "Lead Intern", "Entry-level Dev", "Head of Data", "Developer", None]
    assert column(titles, flags.detect_seniority) == ["Senior", "Manager", "Intern", "Junior", "Lead", None, None]


def test_money_texts(spark):
    rows = spark.createDataFrame(
        [(120500.0, 150500.0, "USD"), (99500.0, 99500.0, None), (None, 1.0, "EUR")], "a double, b double, c string"
    )
    args = (F.col("a"), F.col("b"), F.col("c"))
    got = rows.select(
        formats.format_salary(*args), formats.salary_text(*args), formats.format_money(F.col("a") * 10)
    ).collect()
    assert [tuple(r) for r in got] == [
        ("USD 120k-150k", "USD 120k–150k", "$1,205k"), ("100k", "100k–100k", "$995k"), ("", "", "—"),
    ]
    shown = spark.createDataFrame([(datetime(2024, 3, 5, 4, 7),), (None,)], "t timestamp")
    assert [r[0] for r in shown.select(formats.format_update(F.col("t"))).collect()] == ["05 Mar 2024, 04:07 UTC", "—"]


def test_skill_boundaries(column):
    cases = {
        "JavaScript, Node.js and React.js": ["JavaScript", "React", "Node.js"],
        "Javas, Gitlab, SQLite3, C++11": [],
        "C++, C# or .NET; ASP.NET": ["C++", "C#", ".NET"],
        "go rust swift excel": [],
        "GO, Rust. SWIFT Excel": ["Go", "Rust", "Swift", "Excel"],
        "React  Native and ruby on rails": ["React", "Ruby on Rails", "React Native"],
        "Ruby on Rails": ["Ruby", "Ruby on Rails"],
        "k8s/postgres (aws)": ["PostgreSQL", "AWS", "Kubernetes"],
        "apache spark": ["Spark"],
        "spring\nboot": ["Spring Boot"],
        "Python. Java.": ["Python", "Java"],
        "": [],
    }
    got = column([*cases, None], lambda c: skills.extract_skills(c, V.TAXONOMY, fuzzy=False))
    assert got == [*cases.values(), []]


def _common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def _closest(word, names, threshold):
    scores = [(200 * _common(word, n) / (len(word) + len(n)), -i, n) for i, n in enumerate(names)]
    best = max(scores)
    return best[2] if best[0] >= threshold else None


def test_near_misses_equal_brute_force(spark):
    rng = random.Random(7)
    names = list(skills.fuzzy_choices(V.TAXONOMY))
    words = set()
    for name in names:
        for _ in range(25):
            w = list(name)
            for _ in range(rng.randint(1, 4)):
                i, op = rng.randrange(len(w)), rng.choice("idst")
                if op == "i":
                    w.insert(i, rng.choice("aeyz9"))
                elif op == "d" and len(w) > 4:
                    w.pop(i)
                elif op == "s":
                    w[i] = rng.choice("aeyz9")
                elif i + 1 < len(w):
                    w[i], w[i + 1] = w[i + 1], w[i]
            if len(w) > 5 and w[0].isalpha():
                words.add("".join(w))
    words = sorted(words - set(names))
    rows = spark.createDataFrame([(w,) for w in words], "w string").repartition(8)
    for threshold in (90, 80):
        tagged = rows.select(
            "w",
            skills.fuzzy_tokens(F.col("w"), V.TAXONOMY, threshold).alias("kept"),
            skills.best_choice(F.col("w"), V.TAXONOMY, threshold)["name"].alias("name"),
        ).collect()
        for r in tagged:
            want = _closest(r.w, names, threshold)
            assert r.name == want, r
            assert want is None or r.kept == [r.w], r
        assert sum(r.name is not None for r in tagged) > 100


def test_fuzzy_tagging(column):
    values = ["Kubernetess, Terraformm; kuberentes", "kubernetes", "airflows and tableua", "9kubernetess"]
    got = column(values, lambda c: skills.extract_skills(c, V.TAXONOMY))
    assert got == [["Kubernetes", "Terraform"], ["Kubernetes"], ["Airflow"], ["Kubernetes"]]


def test_nested_names_need_layers(column):
    taxonomy = {"Data": [], "Data Lake": [], "Data Lake House": ["Lake House"]}
    got = column(["data lake house", "Data Lakes"], lambda c: skills.extract_skills(c, taxonomy, fuzzy=False))
    assert got == [["Data", "Data Lake", "Data Lake House"], ["Data"]]


def test_iso_times_within_a_day(column):
    good = ["2021-04-08T10:00", "2021-04-08t10:00", "2021-04-08_23:59:59.5", "2021-04-08 10", "2021-04-08T10:00+23:59", "2021-04-08T10:00Z"]
    bad = ["2021-04-08T25:00", "2021-04-08T99:99:99", "2021-04-08T10:00+99:00", "2021-04-08T10:60", "2021-13-08T10:00", "2021-04-08T24:00"]
    assert [str(d) for d in column(good, dates.parse_date)] == ["2021-04-08"] * len(good)
    assert column(bad, dates.parse_date) == [None] * len(bad)


def test_names_shared_and_names_inside_names(column):
    taxonomy = {"CI": [], "CI/CD": ["Pipelines"], "Build": ["Pipelines"], "Data": [], "Data-Lake": [], "Data Lake House": []}
    tags = lambda c: skills.extract_skills(c, taxonomy, fuzzy=False)
    got = column(["we do CI/CD", "only CI", "Pipelines", "a Data-Lake", "the data  lake house"], tags)
    assert got == [["CI", "CI/CD"], ["CI"], ["CI/CD", "Build"], ["Data", "Data-Lake"], ["Data", "Data Lake House"]]


def test_skill_names_at_all_borders(column):
    # Every name by itself, in capitals, parted unevenly, and within other words.
    names = [name for skill, aliases in V.TAXONOMY.items() for name in (skill, *aliases)]
    parted = ["  ".join(name.split()) for name in names]
    found = column([f"{a}, ({a.upper()}) x{a} {a}x" for a in parted], lambda c: skills.extract_skills(c, V.TAXONOMY, fuzzy=False))
    holders = [{skill for skill, aliases in V.TAXONOMY.items() if name in (skill, *aliases)} for name in names]
    assert all(own <= set(f) for own, f in zip(holders, found))
    assert column(["xPython", "_Go", "#Java", "a.SQL", "Pythonx", "Java.x", "go", "ſwift"],
                  lambda c: skills.extract_skills(c, V.TAXONOMY, fuzzy=False)) == [[]] * 8
