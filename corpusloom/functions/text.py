"""Text cleaning and quality functions: native expressions, but for the fuzzy anchor (Arrow UDF)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ident import SPACES, let, strip

# Anchors, starters, months and limits of the cleaning rules.
ANCHORS = (("executive-order", "EXECUTIVE ORDER"), ("office-of-the-mayor", "OFFICE OF THE MAYOR"), ("city-of-new-york", "THE CITY OF NEW YORK"))
PHRASE_RATIO, TOKEN_RATIO = 0.72, 0.80
STARTERS = (
    "WHEREAS", "BY VIRTUE", "BY THE POWER", "PURSUANT", "NOW THEREFORE", "SECTION", "IT IS HEREBY", "IN THE EXERCISE", "BY THE AUTHORITY",
)
MONTHS = "january february march april may june july august september october november december".split()
NUMBER_TOKENS = ("EXECUTIVE", "EMERGENCY", "ORDER", "ORDERS", "NO", "NOS")
TRAILING_STOP = "which with and the to of for in on by as that from a an or at into under upon".split()
MAX_HEADER, MARK_LENGTH, DATE_LINES = 900, 8, 12
# Fixed value: characters that aren't junk.
JUNK = r"""[\p{L}\p{N} \t\n.,;:'"()\-&/$%§#’“”]"""


_BLANKS = SPACES.replace("\n", "")


def normalize_ws(c: Column) -> Column:
    c = F.regexp_replace(c, r"[ \t]{2,}|\t", " ")
    c = F.array_join(F.transform(F.split(c, "\n", -1), lambda line: F.rtrim(line, F.lit(_BLANKS))), "\n")
    return strip(F.regexp_replace(c, r"\n[ \t]*\n[ \t]*(?:\n[ \t]*)+", "\n\n"))


def clean_text(c: Column) -> Column:
    """Words broken at a line end joined, then white space normalised."""
    return normalize_ws(F.regexp_replace(c, r"(?U)(\w)-\n([a-z])", "$1$2"))


# One pattern each, so that no lambda runs for a word: ASCII runs of letters of two or more; those that are English-like. \p{Alpha} and
# classes of listed letters are looked up in a table, ranges are tried one by one.
_RUN = r"\p{Alpha}{2,}"
_CONSONANT = "[BCDFGHJKLMNPQRSTVWXYZbcdfghjklmnpqrstvwxyz]"
_LIKE = rf"(?=\p{{Alpha}}{{2,20}}+(?!\p{{Alpha}}))(?<!\p{{Alpha}}){_CONSONANT}{{0,4}}+(?:[AEIOUaeiou]++{_CONSONANT}{{0,4}}+)++(?!\p{{Alpha}})"


def word_ratio(c: Column) -> Column:
    """Share of English-like words among those of two letters or more; 1.0 if none. English-like: at most 20 letters, a
    vowel, and no five consonants in a row."""
    return let(F.regexp_count(c, F.lit(_RUN)), lambda every: F.when(every == 0, F.lit(1.0)).otherwise(F.regexp_count(c, F.lit(_LIKE)) / every))


def junk_ratio(c: Column) -> Column:
    return F.when(F.length(c) == 0, F.lit(0.0)).otherwise(F.length(F.regexp_replace(c, JUNK + "++", "")) / F.length(c))


def tier(born_digital: Column, anchored: Column, noise: Column, words: Column, junk: Column, review: Column) -> Column:
    """The quality tier; the ratios are found only where the rest leaves it open."""

    def rated(r: Column) -> Column:
        low = (r["words"] < 0.70) | (r["junk"] > 0.15)
        return F.when(low, "needs-review").when((noise <= 20) & (r["words"] >= 0.90) & (r["junk"] <= 0.05), "clean").otherwise("minor-noise")

    return F.when(review | ~(anchored | born_digital), "needs-review").otherwise(let(F.struct(words.alias("words"), junk.alias("junk")), rated))


# Marks and dates have a digit, which few lines do: looked for first.
_DIGIT = r"\p{Nd}"


def is_file_mark(line: Column) -> Column:
    def mark(s: Column) -> Column:
        listed = s.rlike(r"(?i)^\(?[a-z0-9]{1,3}\)?[.)]?$") | s.startswith("§")
        shape = s.rlike(r"^\d{1,3}-\d{1,3}$") | s.rlike(r"(?iU)^[a-z]{1,3}[ \-]\d{1,3}[ \-]?[&\w]{0,2}$")
        return (s != "") & (F.length(s) <= MARK_LENGTH) & s.rlike(r"(?U)\d") & ~listed & shape

    return line.rlike(_DIGIT) & let(strip(F.regexp_replace(strip(line), r"^[\[\]()]+|[\[\]()]+$", "")), mark)


def strip_file_marks(body: Column) -> Column:
    """struct(text, dropped): the body without its isolated marks, and the marks in order."""

    def split(told: Column) -> Column:
        line = lambda x: x["line"]
        return F.struct(
            F.array_join(F.transform(F.filter(told, lambda x: ~x["mark"]), line), "\n").alias("text"),
            F.transform(F.filter(told, lambda x: x["mark"]), lambda x: strip(x["line"])).alias("dropped"),
        )

    return let(F.transform(F.split(body, "\n", -1), lambda x: F.struct(x.alias("line"), is_file_mark(x).alias("mark"))), split)


# Date patterns.
_SEP = r"""[ .,;'"“”‘’]+"""
MONTH_DATE = rf"(?iU)\b(september|february|november|december|january|october|august|march|april|june|july|sept|jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\b{_SEP}(\d{{1,2}}){_SEP}(\d{{4}})\b"
NUMERIC_DATE = r"(?U)(?=\d)\b(\d{1,2})[/\-](\d{1,2})[/\-](\d{2,4})\b"


def _iso(year: Column, month: Column, day: Column, wanted: Column) -> Column:
    ok = (year == wanted) & month.between(1, 12) & day.between(1, 31)
    return F.when(ok, F.format_string("%04d-%02d-%02d", year, month, day))


def extract_date(lines: Column, year: Column) -> Column:
    """First date of the first lines whose year is ``year``; Feb 31 passes, as in the rules."""

    def of(line):
        month = F.substring(F.lower(F.regexp_extract(line, MONTH_DATE, 1)), 1, 3)
        number = F.array_position(F.array(*(F.lit(m[:3]) for m in MONTHS)), month).cast("int")
        part = lambda rx, k: F.regexp_extract(line, rx, k)
        named = F.when(line.rlike(MONTH_DATE), _iso(part(MONTH_DATE, 3).try_cast("int"), number, part(MONTH_DATE, 2).try_cast("int"), year))
        y = part(NUMERIC_DATE, 3)
        full = F.when(F.length(y) == 4, y.try_cast("int")).otherwise(F.floor(year / 100).cast("int") * 100 + y.try_cast("int"))
        short = F.when(line.rlike(NUMERIC_DATE), _iso(full, part(NUMERIC_DATE, 1).try_cast("int"), part(NUMERIC_DATE, 2).try_cast("int"), year))
        return F.when(line.rlike(_DIGIT), F.coalesce(named, short))

    return F.aggregate(F.slice(lines, 1, DATE_LINES), F.lit(None).cast("string"), lambda date, line: F.coalesce(date, of(line)))


def tokens(line: Column) -> Column:
    return F.filter(F.split(F.upper(F.regexp_replace(line, "[^A-Za-z ]+", " ")), " +"), lambda t: t != "")


def is_starter(line: Column) -> Column:
    head = F.concat(F.array_join(tokens(line), " "), F.lit(" "))
    out = F.lit(False)
    for s in STARTERS:
        out = out | head.startswith(s + " ")
    return out


_TARGETS = ("EXECUTIVE", *(phrase.replace(" ", "") for _, phrase in ANCHORS))
_COUNTS = {t: [(c, t.count(c)) for c in sorted(set(t))] for t in _TARGETS}


def _label(line: str) -> str | None:
    from difflib import SequenceMatcher

    words = re.sub("[^A-Za-z ]+", " ", line).upper().split()
    if not words:
        return None

    def ratio(a: str, b: str, least: float) -> float:
        need = least * (len(a) + len(b)) - 1e-9
        if not a or 2 * min(len(a), len(b)) < need or 2 * sum(min(a.count(c), n) for c, n in _COUNTS[b]) < need:
            return 0.0  # no blocks match more letters than both have
        return SequenceMatcher(None, a, b).ratio()

    if any(len(w) >= 7 and ratio(w, "EXECUTIVE", TOKEN_RATIO) >= TOKEN_RATIO for w in words):
        return "executive-order"
    for name, phrase in ANCHORS:
        k, target = len(phrase.split()), phrase.replace(" ", "")
        spans = ["".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
        if any(ratio(s, target, PHRASE_RATIO) >= PHRASE_RATIO for s in spans):
            return name
    return None


def anchor_label(line: Column | str) -> Column:
    """Header anchor of a line, tolerant of recognition errors; lines that are equal within a batch are looked at once.

    The ratio is found only where the letters that both have, counted, leave it possible: a bound that no match fails."""

    def label(lines: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in lines:
            seen = {x: _label(x) for x in s.dropna().unique()}
            yield s.map(lambda x: seen.get(x))

    # or else a filter on the label would find it twice
    return F.pandas_udf(label, "string").asNondeterministic()(line)


def label_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """``lines`` with ``anchor``, found where the lines are, once for each that differs in a batch: joined by the line, rows of a common one would all
    come to one task."""
    return lines.withColumn("anchor", anchor_label(column))


def anchors_of(words: Column) -> Column:
    """map<words, anchor> of those in an array of lines' words that have an anchor; empty without one."""

    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow.compute as pc

        for own in batches:
            lines = own.flatten().dictionary_encode()  # each different line is looked at once
            labels = [_label(x) if x else None for x in lines.dictionary.to_pylist()]
            code = lines.indices.fill_null(len(labels)).to_numpy()
            hit = np.array([x is not None for x in labels] + [False])[code]
            upto = np.cumsum(np.bincount(pc.list_parent_indices(own).to_numpy()[hit], minlength=len(own)))
            at = pa.array(code[hit])
            yield pa.MapArray.from_arrays(pa.array([0, *upto], pa.int32()), lines.dictionary.take(at), pa.array(labels, pa.string()).take(at))

    return F.arrow_udf(found, "map<string,string>").asNondeterministic()(words)


# Fixed value: address lines of the letterhead.
ZIP, STATE = r"(?U)(?=\d{5})\b\d{5}\b", r"(?U)[Nn]\.?\s*[Yy]"


def token_text(line: Column) -> Column:
    """Upper-cased words of a line, joined by one space: all that its anchor and its kind of letterhead depend on."""
    return F.trim(F.upper(F.regexp_replace(line, r"\P{Alpha}(?:\P{Alpha}+|(?<! ))", " ")))


_STARTS = "^(?:" + "|".join(STARTERS) + ")(?: |$)"
_NUMBERS = f"^(?:{'|'.join(NUMBER_TOKENS)})(?: (?:{'|'.join(NUMBER_TOKENS)}))*$"
_MONTH_WORDS = f"(?=[{''.join(sorted({m[0].upper() for m in MONTHS}))}])(?<![^ ])(?:{'|'.join(m.upper() for m in MONTHS)})(?![^ ])"


def title_line(line: Column, words: Column, anchored: Column) -> Column:
    """What a stripped line, of which ``words`` is the ``token_text``, is to the search for a title: s where the body starts, p if
    it is passed by, c for capitals, t for other text."""
    few = F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) < 6
    letters = F.length(F.regexp_replace(line, r"\P{L}++", ""))
    upper = F.length(line) - F.length(F.regexp_replace(line, r"\p{Lu}++", ""))
    return (
        F.when(line == "", "p").when(words.rlike(_STARTS), "s").when(words.rlike(_NUMBERS) | (few & (words != "") & anchored) | words.rlike(_MONTH_WORDS), "p")
        .when(line.rlike(STATE) | (line.rlike(_DIGIT) & (line.rlike(ZIP) | line.rlike(NUMERIC_DATE))), "p")
        .otherwise(let(letters, lambda n: F.when(n < 4, "p").when(upper >= 0.8 * n, "c").otherwise("t")))
    )


def title_candidate(lines: Column) -> Column:
    """All-caps subject from an array of struct(line, anchor); null if none."""
    return title_among(lines, lambda x: x["line"], lambda x, words: x["anchor"].isNotNull())


def title_among(lines: Column, text: Callable[[Column], Column], anchored: Callable[[Column, Column], Column]) -> Column:
    """All-caps subject from an array of lines; null if none. ``text`` gives a line's text, ``anchored`` whether it has an anchor, from it and its words.

    Lines that are passed by end a started title. So the title is the first run of capitals, if nothing but passed lines stands
    before it. Lines after its end aren't looked at.
    """
    state = lambda passed, many, done: F.struct(passed.alias("passed"), many.alias("many"), done.alias("done"))

    def step(at: Column, x: Column) -> Column:
        def after(kind: Column) -> Column:
            more = F.when(kind == "c", state(at["passed"], at["many"] + 1, F.lit(False)))
            return more.when((kind == "p") & (at["many"] == 0), state(at["passed"] + 1, at["many"], F.lit(False))).otherwise(state(at["passed"], at["many"], F.lit(True)))

        own = F.struct(strip(text(x)).alias("s"), token_text(text(x)).alias("w"))
        return F.when(at["done"], at).otherwise(let(let(own, lambda v: title_line(v["s"], v["w"], anchored(x, v["w"]))), after))

    def title(v: Column) -> Column:
        run = F.aggregate(v, state(F.lit(0), F.lit(0), F.lit(False)), step)
        return let(run, lambda r: F.array_join(F.transform(F.slice(v, r["passed"] + 1, r["many"]), lambda x: strip(text(x))), " "))

    bare = F.regexp_replace(let(lines, title), "^[^0-9A-Za-z]+|[^0-9A-Za-z]+$", "")
    return let(bare, lambda t: F.nullif(t, F.lit("")))


# Fixed value: Roman numerals.
ROMAN = r"^m{0,4}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$"
# Suffixes and what replaces them, in order.
STEMS = (("ies", "y"), ("es", ""), ("s", ""), ("ing", ""), ("ing", "e"), ("ed", ""), ("ed", "e"), ("ation", "ate"), ("ations", "ate"))


def word_forms(word: Column) -> Column:
    """The lower-cased word and its stems, any of which a word list may hold."""
    low = F.lower(word)
    forms = [low]
    for suffix, put in STEMS:
        n = len(suffix)
        forms.append(F.when(low.endswith(suffix) & (F.length(low) >= n + 2), F.concat(F.substring(low, F.lit(1), F.length(low) - n), F.lit(put))))
    return F.array_compact(F.array(*forms))


def recognized(words: DataFrame, column: str, lexicon: DataFrame) -> DataFrame:
    """``words`` with boolean ``known``: letters only, and a form in the lexicon (word) or a Roman numeral."""
    forms = words.select(F.col(column).alias("_w")).distinct().withColumn("_form", F.explode(word_forms(F.col("_w"))))
    hits = forms.join(lexicon, F.col("_form") == F.col("word"), "left_semi").select(F.col("_w").alias("_hit")).distinct()
    alpha = F.col(column).rlike(r"^\p{L}+$")
    out = words.join(hits, F.col(column) == F.col("_hit"), "left")
    return out.withColumn("known", F.coalesce(alpha & (F.col("_hit").isNotNull() | F.lower(column).rlike(ROMAN)), F.lit(False))).drop("_hit")
