"""The cleaning record against a plain version of its rules, row by row."""

import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import lexicon, text
from corpusloom.operators.cleaning import clean_records, clean_stage

WORDS = {*lexicon.DOMAIN, *lexicon.ABBREVIATIONS, *lexicon.FALLBACK}


def toks(line):
    return re.sub("[^A-Za-z ]+", " ", line).upper().split()


def anchor(line):
    t = toks(line)
    like = lambda a, b: SequenceMatcher(None, a, b).ratio()
    if any(len(w) >= 7 and like(w, "EXECUTIVE") >= 0.8 for w in t):
        return "executive-order"
    for name, phrase in text.ANCHORS:
        k, goal = len(phrase.split()), phrase.replace(" ", "")
        if t and max(like("".join(t[i : i + k]), goal) for i in range(max(1, len(t) - k + 1))) >= 0.72:
            return name
    return None


def starts(line):
    t = toks(line)
    return any(t[: len(s.split())] == s.split() for s in text.STARTERS)


def known(w):
    w = w.lower()
    forms = {w} | {w[: -len(s)] + r for s, r in text.STEMS if w.endswith(s) and len(w) - len(s) >= 2}
    return w.isalpha() and (bool(forms & WORDS) or bool(re.match(text.ROMAN, w)))


def plain_title(lines):
    got = []
    for line in lines:
        s, t = line.strip(), toks(line)
        if s and starts(s):
            break
        alpha = [c for c in s if c.isalpha()]
        skip = not s or re.search(r"\b\d{5}\b|N\.?\s*Y\.?", s, re.I) or (t and all(w in text.NUMBER_TOKENS for w in t)) or (0 < len(t) <= 6 and anchor(s))
        if skip or any(w.lower() in text.MONTHS for w in t) or re.search(r"\b\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}\b", s) or len(alpha) < 4:
            if got:
                break
            continue
        if sum(c.isupper() for c in alpha) < 0.8 * len(alpha):
            break
        got.append(s)
    return re.sub("^[^0-9A-Za-z]+|[^0-9A-Za-z]+$", "", " ".join(got)) or None


def plain(body, title, source):
    lines = body.split("\n")
    at = next((i for i, x in enumerate(lines) if anchor(x)), None)
    begin = next((i for i, x in enumerate(lines) if starts(x)), None)
    label, dropped, work, flags = anchor(lines[at]) if at is not None else None, "", body, []
    if source == "ocr":
        head = "\n".join(lines[:at]) if at is not None else ""
        if at is None:
            flags.append("no-anchor-found")
        elif begin is not None and begin < at:
            flags, label = ["anchor-after-body-start"], None
        elif len(head) > 900:
            flags, label = ["large-header-trim-skipped"], None
        else:
            dropped, work = head.strip(), "\n".join(lines[at:])
        kept = []
        for x in work.split("\n"):
            s = x.strip().strip("[]()").strip()
            mark = s and len(s) <= 8 and re.search(r"\d", s) and not re.match(r"(?i)^\(?[a-z0-9]{1,3}\)?[.)]?$|^§", s)
            if not (mark and re.match(r"(?i)^\d{1,3}-\d{1,3}$|^[a-z]{1,3}[ \-]\d{1,3}[ \-]?[&\w]{0,2}$", s)):
                kept.append(x)
        work = "\n".join(re.sub(r"[ \t]+", " ", x).rstrip() for x in kept)
        work = re.sub(r"\n[ \t]*\n[ \t]*(?:\n[ \t]*)+", "\n\n", work).strip()
    if not (title or "").strip():
        cand = plain_title(work.split("\n"))
        words = [w for w in re.findall("[A-Za-z]+", cand or "") if len(w) >= 2]
        ok = len(words) >= 2 and words[-1].lower() not in text.TRAILING_STOP and all(map(known, words))
        title = cand if ok else None
        flags += [] if ok else ["title-uncertain" if cand else "title-not-extracted"]
    return work, dropped, label, title, flags


BODIES = [
    "7~*j\nnl-8\nRXECUTIVE ORDER NO. 64\nJuly 25, 1974\n\nVOTER ASSISTANCE PROGRAM\n37-12\n\n\n\nBy virtue  of the power\t\nvested",
    "WHEREAS, the code of\nTHE CITY OF NEW YORK\nsays so",
    "x" * 950 + "\nEXECUTIVE ORDER NO. 9\nTHE CRAY OFFICE\n\nSection 1. Text",
    "no header at all, just text",
    "OFFICE OF THE MAYOR\nNEW YORK, N.Y. 10007\nEXECUTIVE ORDER NO. 5\nDATED JANUARY I, 1974\nESTABLISHMENT OF THE MAYOR'S MIDTOWN\nACTION OFFICE\nBy the power vested",
    "THE CITY OF NEW YORK\nOFFICE OF THE MAYOR\nCONTRACT WITH\nWHEREAS",
    "operce oF THE MAYOR\n(a)\n[ps 7-&]\n  STORM WATER PERMITS *\n3/4/1974\nIt is hereby ordered",
    "",
    "EXECUTIVE ORDER\nORDER\nNo. 10\nMARY\nPURSUANT to",
]


@pytest.fixture(scope="module")
def records(spark):
    rows = [(f"{i}-{s}-{bool(t)}", b, 1974, t, None, s) for i, b in enumerate(BODIES) for s in ("ocr", "born-digital") for t in (None, "Kept")]
    rows += [("null", None, 1974, " ", "1974-01-02", "ocr"), ("none", "_stub_", 1974, "T", None, "none")]
    return spark.createDataFrame(rows, "eo_id string, body string, year int, title string, date_signed string, text_source string")


def test_clean_records(spark, records):
    got = {r.eo_id: r.clean for r in clean_records(records, lexicon.words(spark)).collect()}
    assert len(got) == records.count()
    for r in records.collect():
        c = got[r.eo_id]
        work, dropped, label, title, flags = plain(r.body or "", r.title, r.text_source)
        assert (c.full_text, c.dropped_header, c.anchor_label, c.title, c.full_text_raw) == (work, dropped, label, title, r.body or ""), r.eo_id
        assert {f.split(":")[0] for f in c.flags} - {"date-not-extracted"} == set(flags), r.eo_id
    first = got["0-ocr-False"]
    assert (first.title, first.date_signed, first.text_quality, first.dropped_marks) == ("VOTER ASSISTANCE PROGRAM", "1974-07-25", "clean", ["37-12"])
    assert first.dropped_header == "7~*j\nnl-8" and first.metrics.leading_noise_chars == 9


def test_clean_stage(spark, records):
    got = {r.eo_id: r.out for r in clean_stage(records, lexicon.words(spark)).collect()}
    assert got["none"].text_quality == "no-text" and got["none"].body == "_stub_" and got["0-ocr-False"].title == "VOTER ASSISTANCE PROGRAM"
    assert clean_stage(records.limit(0), lexicon.words(spark)).count() == 0


def test_frozen_list(spark, tmp_path):
    (tmp_path / "words.txt").write_text("# built\nApple\n\nit's\nzebra\n")
    own = lexicon.words(spark, str(tmp_path / "words.txt"))
    assert own.filter("word IN ('apple', 'zebra', 'bronx')").count() == 3
    listed = [r.word for r in lexicon.frozen(spark.read.text(str(tmp_path / "words.txt"))).collect()]
    assert listed == sorted(listed) and "it's" not in listed and {"apple", "zebra", "hhs"} <= set(listed)
    assert lexicon.label(str(tmp_path / "words.txt"), 9) == "frozen:words.txt (9 words)"


def test_title_gate(spark):
    titles = ["VOTER ASSISTANCE PROGRAM", "MARY", "CRAY OFFICE", "OFFICE OF", "CITIES AND AGENCIES XIV", None]
    got = {r.title: r.ok for r in lexicon.trusted(spark.createDataFrame([(t,) for t in titles], "t string"), "t", lexicon.words(spark)).collect()}
    assert got == {"VOTER ASSISTANCE PROGRAM": True, "MARY": False, "CRAY OFFICE": False, "OFFICE OF": False, "CITIES AND AGENCIES XIV": True}


def test_anchor_labels_equal_plain(spark):
    import random

    r = random.Random(3)
    phrases = [p for _, p in text.ANCHORS] + ["EXECUTIVE", "RXECUTIVE ORDFR", "THE MAYOR OF NEW YORK", "voter program", ""]
    lines = {"".join(c if r.random() > 0.15 else r.choice("abXY 1.") for c in r.choice(phrases) + r.choice(["", " NO. 5", " and more words"])) for _ in range(400)}
    d = spark.createDataFrame([(x,) for x in sorted(lines)], "line string")
    got = {x.line: x.anchor for x in text.label_lines(d).collect()}
    assert got == {x: anchor(x) for x in lines}
    assert {x.l for x in d.filter(F.col("line") != "").select(text.is_starter(F.col("line")).alias("l")).collect()} <= {True, False}


def test_anchor_bound_loses_nothing(spark):
    """Labels with the bound equal those of the ratio alone, on damaged anchors and random lines."""
    import random
    import re
    from difflib import SequenceMatcher

    from pyspark.sql import functions as F

    from corpusloom.functions import text

    def plain(line):
        words = re.sub("[^A-Za-z ]+", " ", line).upper().split()
        near = lambda a, b: SequenceMatcher(None, a, b).ratio()
        if any(len(w) >= 7 and near(w, "EXECUTIVE") >= text.TOKEN_RATIO for w in words):
            return "executive-order"
        for name, phrase in text.ANCHORS:
            k, target = len(phrase.split()), phrase.replace(" ", "")
            if words and any(near("".join(words[i : i + k]), target) >= text.PHRASE_RATIO for i in range(max(1, len(words) - k + 1))):
                return name
        return None

    r = random.Random(9)
    common = "the order of this city shall be effective immediately and executive office new york mayor agencies department year thereof hereby committee".split()
    lines = {"", " ", "1234", "Exec", "EXECUTIVE", "executlve 0rder", "OFFICEOFTHEMAYOR", "the city of new york"}
    for _ in range(4000):
        base = r.choice([p for _, p in text.ANCHORS] + ["EXECUTIVE", " ".join(r.choices(common, k=r.randint(1, 9)))])
        chars = list(r.choice(["", "xx ", "No. "]) + base + r.choice(["", " yy", " 12"]))
        for _ in range(r.randint(0, 9)):
            at = r.randrange(len(chars))
            chars[at : at + r.choice([0, 1])] = r.choice(["", "O", "e", " ", "1", "C", "."])
            chars = chars or ["a"]
        lines.add("".join(chars))
    df = spark.createDataFrame([(x,) for x in lines], "line string").repartition(4)
    want = {x: plain(x) for x in lines}
    assert {x.line: x.anchor for x in text.label_lines(df).collect()} == want and len({*want.values()}) == 4
    assert {x.line: x.a for x in df.select("line", text.anchor_label("line").alias("a")).collect()} == want


def test_lines_are_labelled_without_a_shuffle(spark):
    d = spark.createDataFrame([(i, x) for i, x in enumerate(["EXECUTIVE ORDER", "By virtue of", "By virtue of", None, ""])], "i int, line string")
    out = text.label_lines(d)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r.anchor for r in out.orderBy("i").collect()] == ["executive-order", None, None, None, None]


def test_cleaning_joins_no_lines(spark, records):
    """Anchors come with the record: but for the titles' gate nothing is joined, and lines aren't exploded."""
    plan = clean_records(records, lexicon.words(spark))._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
    assert plan.count("Join ") <= 2 and "explode(split(" not in plan and "collect_set" not in plan


def test_only_named_fields_are_worked_out(spark, records):
    """Ratios of words and junk aren't found where no tier is asked for."""
    d = clean_records(records, lexicon.words(spark), fields=["flags", "dropped_header"])
    assert d.schema["clean"].dataType.names == ["flags", "dropped_header"]
    plan = d.select(F.size("clean.flags"), F.length("clean.dropped_header"))._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
    assert "Alpha}{2,}" not in plan and "{L}\\p{N}" not in plan


def test_texts_equal_plain_rules(spark):
    """White space, ratios, marks, words and titles' letters of random texts against plain versions."""
    import random

    r = random.Random(5)
    bits = ["a", "E", "xyz", "strngths", "rhythm ", "ab1", "  ", "\t", "\n", "\n \n\t\n", "\x1c", "\xa0", "  ", "é", "ß9", "§", "*", "37-12", "[nl-8]", "٤-5", "ab " * 9, "bcdfa", "queueing", "x" * 21]
    texts = sorted({"".join(r.choices(bits, k=r.randint(0, 14))) for _ in range(1500)})
    d = spark.createDataFrame([(x,) for x in texts], "x string")
    c = F.col("x")
    got = d.select(c, text.normalize_ws(c).alias("ws"), text.word_ratio(c).alias("wr"), text.junk_ratio(c).alias("jr"), text.token_text(c).alias("t"), text.strip_file_marks(c)["dropped"].alias("m")).collect()
    vowel, five = re.compile("[aeiouAEIOU]"), re.compile("[^aeiouAEIOU]{5}")
    for row in got:
        x = row.x
        ws = "\n".join(re.sub("[ \t]+", " ", y).rstrip() for y in x.split("\n"))
        assert row.ws == re.sub(r"\n[ \t]*\n[ \t]*(?:\n[ \t]*)+", "\n\n", ws).strip(), repr(x)
        words = [w for w in re.findall("[A-Za-z]+", x) if len(w) > 1]
        like = [w for w in words if len(w) <= 20 and vowel.search(w) and not five.search(w)]
        assert row.wr == (len(like) / len(words) if words else 1.0), repr(x)
        junk = [y for y in x if not (y.isalpha() or y.isnumeric() or y in " \t\n.,;:'\"()-&/$%§#’“”")]
        assert row.jr == (len(junk) / len(x) if x else 0.0) and row.t == " ".join(re.sub("[^A-Za-z]", " ", x).upper().split()), repr(x)
    assert {m for row in got for m in row.m} >= {"37-12", "[nl-8]"}
