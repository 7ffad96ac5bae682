from corpusloom.operators import graph

DOCS = [
    ("2018-EO-031", False, "", ""), ("2007-EO-102", False, "", ""), ("2022-EEO-50", True, "", ""), ("1978-EO-018", False, "", ""),
    ("2019-EO-001", False, "§ 11. Executive Order No. 31, dated March 7, 2018, is hereby REVOKED. § 12.", ""),
    ("2019-EO-002", False, "Section 8 of Executive Order 102 of 2007 is repealed.", ""),
    ("2022-EO-003", False, "Emergency Executive Order 50 of 2022 is extended for five (5) days. § 2. Executive Order No. 9 is hereby revoked.", ""),
    ("1977-EO-091", False, "Executive Order 5 of 1474 is revoked.", "XREF: AMENDED BY 'EO 18) 1978\""),
    ("2022-EO-004", False, "Emergency Executive Order 50 of 2022 is hereby revoked.", ""),
]


def test_graph(spark):
    docs = spark.createDataFrame(DOCS, "eo_id string, is_emergency boolean, full_text string, dropped_header string")
    found = {(r.actor, r.target, r.verb, r.partial, r.outcome) for r in graph.body_citations(docs).collect()}
    assert found == {
        ("2019-EO-001", "2018-EO-031", "revoked", False, "edge"), ("2019-EO-002", "2007-EO-102", "repealed", True, "edge"),
        ("2022-EO-003", "2022-EEO-50", "extended", False, "extension"), ("2022-EO-003", "EO-9", "revoked", False, "no-year"),
        ("1977-EO-091", "EO-5", "revoked", False, "implausible-year"), ("2022-EO-004", "2022-EEO-50", "revoked", False, "edge"),
    }
    notes = {r.eo_id: r for r in graph.annotate(docs, graph.edges(docs)).collect()}
    assert notes["2018-EO-031"].in_effect is False and notes["2007-EO-102"].in_effect is None and notes["2022-EEO-50"].in_effect is None
    assert notes["1977-EO-091"].superseded_by == ["1978-EO-018"]


def plain(actor, text, ids):
    """The rules one by one: verbs, what each governs, where it leads."""
    import re

    def rx(pattern):
        return re.compile(re.sub(r"^\(\?i?U\)", "", pattern), re.I if pattern.startswith("(?i") else 0)

    cite, verb, bound, scope = map(rx, (graph.CITE, graph.VERB, graph.BOUNDARY, graph.SCOPE))
    out = []
    for v in verb.finditer(text):
        low = max(0, v.start() - 400)
        ends = [b.end() for b in bound.finditer(text) if b.start() >= low and b.end() <= v.start()]
        floor = max([low, *ends])
        for c in cite.finditer(text):
            if not floor <= c.start() < v.start():
                continue
            year = c[3] or c[4]
            emergency, number = bool(c[1]), c[2]
            label = f"{'EEO' if emergency else 'EO'}-{number}"
            target = f"{year}-EEO-{int(number)}" if emergency else f"{year}-EO-{int(number):03d}"
            if v[1].lower() == "extended":
                outcome = "extension"
            elif not year:
                outcome = "no-year"
            elif not 1950 <= int(year) <= 2099:
                outcome = "implausible-year"
            else:
                outcome = "self" if target == actor else "edge" if target in ids else "not-in-corpus"
            known = year and 1950 <= int(year) <= 2099
            partial = bool(scope.search(text[max(0, c.start() - 60) : c.start()]))
            out.append((actor, target if known else label, v[1].lower(), partial, outcome))
    return out


def test_citations_equal_plain_rules(spark):
    """Random bodies of several verbs, lists of citations, clause boundaries, sections and long stretches of text."""
    import random

    r = random.Random(11)

    def cite():
        n, y = r.choice([1, 2, 31, 102]), r.choice([1990, 2007, 2018, 1474])
        return r.choice(["Emergency ", ""]) + "Executive Order " + r.choice(["No. ", "", "Number "]) + f"{n}" + r.choice([f", dated March 7, {y}", f" of {y}", ""])

    def piece():
        return r.choice([
            cite, cite, cite, lambda: " and ", lambda: ", ", lambda: r.choice([" is hereby revoked", " are amended", " is REPEALED", " hereby is extended", " is superseded"]), lambda: ". § 2. ", lambda: " Section 3. ",
            lambda: "section 8 of ", lambda: "subdivision a. of ", lambda: " word" * r.choice([1, 20, 90]), lambda: "Sections ", lambda: "\n",
        ])()

    bodies = ["".join(piece() for _ in range(r.randint(1, 25))) for _ in range(1500)]
    ids = [f"2018-EO-{n:03d}" for n in (1, 2, 31)] + ["2007-EO-102", "1990-EEO-2"]
    rows = [(ids[i] if i < len(ids) else f"x{i}", False, b, "") for i, b in enumerate(bodies)]
    docs = spark.createDataFrame(rows, "eo_id string, is_emergency boolean, full_text string, dropped_header string")
    got = sorted(map(tuple, graph.body_citations(docs).collect()))
    known = {row[0] for row in rows}
    want = sorted(x for i, _, b, _ in rows for x in plain(i, b, known))
    assert got == want and len(want) > 400 and {x[4] for x in want} >= {"edge", "extension", "no-year", "implausible-year", "not-in-corpus"}


def test_long_order_is_linear(spark):
    """One text of 10,000 clauses: every citation is found, in a time that grows as the text does."""
    import time

    def run(n):
        text = "".join(f"§ {i}. Section {i % 7} of Executive Order No. {i % 400}, dated March 7, 2018, is hereby revoked. " for i in range(n))
        docs = spark.createDataFrame([("2020-EO-001", text)], "eo_id string, full_text string")
        began = time.time()
        rows = graph.body_citations(docs).collect()
        assert len(rows) == n and all(r.partial for r in rows) and {r.outcome for r in rows} == {"not-in-corpus"}
        return time.time() - began

    run(100)
    short, long = run(1000), run(10000)
    assert long < 20 * short + 10


def test_lists_of_citations_and_repeats(spark):
    """Verbs far more and far fewer than their citations, offsets at the limits, repeated and null ids and texts."""
    cite = "Executive Order 1 of 1990"
    bodies = [
        (cite + ", ") * 40 + "are hereby revoked", cite + " is amended" * 30, cite + "x" * 375 + " is amended", cite + "x" * 374 + " is amended",
        "§" * 500 + cite + " is repealed §", cite + "§ is repealed", "section 2 of " + cite + " and of " + cite * 5 + " is amended", "é🙂 " + cite + "  hereby is extended", "",
    ]
    rows = [(i, b) for i in ("x", "y") for b in bodies] + [("x", bodies[0]), ("x", bodies[6]), (None, bodies[1]), (None, bodies[1]), ("z", None)]
    docs = spark.createDataFrame(rows, "eo_id string, full_text string")
    ids = {i for i, _ in rows}
    got = sorted(map(str, (tuple(r) for r in graph.body_citations(docs).collect())))
    assert got == sorted(str(x) for i, b in rows for x in plain(i, b or "", ids)) and len(got) > 150


def test_texts_are_matched_once(spark):
    """No filter below the explosion of the matches finds them a second time, and a text is gone over for a pattern's matches and gaps only, not for its groups."""
    d = spark.createDataFrame([("1", "Executive Order 5 of 1990 is revoked.")], "eo_id string, full_text string")
    plan = graph.governed(d)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    assert not [x for x in lines if "Filter" in x and ("split(" in x or "regexp" in x)]
    assert max(x.count("regexp_extract_all(") for x in lines) == 3


def test_matches_are_shuffled_without_their_text(spark):
    """Whether a citation is of a part is told beside its text: no window looks back over words, which would be shuffled and sorted along."""
    d = spark.createDataFrame([("1", "Section 5 of Executive Order 5 of 1990 is revoked.")], "eo_id string, full_text string")
    plan = graph.governed(d)._jdf.queryExecution().optimizedPlan().toString()
    assert "lag(" not in plan and not {"tail", "match", "near"} & {x.split("#")[0] for x in plan.split("Repartition")[0].replace(",", " ").replace(".", " ").split()}


def test_number_and_year_equal_the_groups(spark):
    """What is read from a match is what the pattern's groups hold."""
    import random
    import re

    r = random.Random(2)
    mid = lambda *x: r.choice(x)
    texts = {
        mid("Emergency ", "EMERGENCY\n", "", "") + mid("Executive Order ", "executive\norder ", "EXECUTIVE  ORDER\t") + mid("", "No. ", "Nos ", "Number ", "No.") + str(r.choice([1, 31, 1990, 12345]))
        + mid("", " of 1990", "\nof 2007", ", dated March 7, 2018", " dated May. 31st 1474", " of 19901", " of 99", ", dated 1990")
        for _ in range(600)
    }
    rx = re.compile(graph.CITE.replace("(?iU)", ""), re.I)
    rows = [(str(i), t + " is revoked") for i, t in enumerate(sorted(texts))]
    got = {(x.actor, x.emergency, x.number, x.year) for x in graph.governed(spark.createDataFrame(rows, "eo_id string, full_text string")).collect()}
    assert got == {(i, bool(m[1]), m[2], int(m[3] or m[4]) if m[3] or m[4] else None) for i, t in rows if (m := rx.search(t))} and len(got) == len(rows)
