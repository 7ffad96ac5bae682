"""Word list of the title gate: the frozen list, the domain's words and abbreviations, Roman numerals and suffix stems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import recognized

# Words of city government that general lists lack.
DOMAIN = """
citywide midtown downtown uptown manhattan brooklyn bronx queens staten harlem chinatown borough boroughs waterfront neighborhood
neighborhoods stormwater wastewater watershed brownfield brownfields resiliency sustainability cybersecurity broadband rezoning
streetscape bikeway greenway coordination implementation reorganization designation establishment administration modernization
privatization decentralization accountability transparency interagency taskforce workforce nonprofit stakeholder stakeholders
procurement oversight compliance governance preparedness modification amendment amendments continuation moratorium rulemaking
minority womenowned disadvantaged underserved immigrant immigrants tenant tenants veteran veterans homeless homelessness mayoral
commissioner commissioners deputy chancellor comptroller corporation authority commission committee council agency agencies bureau
directive covid coronavirus pandemic vaccination quarantine telework women specified theatre coordinator coordinated controlled
adjudicatory pre
""".split()
# Abbreviations that count as words.
ABBREVIATIONS = """
ceqr ulurp nyc nycha hpd dot dep dob dcas dcp hhc nypd fdny doh doe doitt oti mopd mocj mou moa eeo eo fy id it tv ems mwbe wbe mbe
lgbtq ada eas oem nycem sro sros ceta hiv aids hhs
""".split()
# Words that are there without any list.
FALLBACK = """
a an and or of the to for in on at by with from as is are be this that these those new york city order office mayor executive
emergency department board agency authority commission committee council program services service public private management
operations development planning health housing fire police human resources environmental quality review construction contracts data
information technology education finance budget establishment coordination action assistance voter matters permit permits system
systems control controls storm water sewer municipal separate electronic processing veterans veteran citywide midtown implementation
requirements requirement power virtue vested pursuant whereas section provisions charter effective date signed real subject line
pertaining
""".split()


def words(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(word) of the list at ``path`` (one a line, lines with ``#`` left out) and the fixed words; distinct, lower-cased.
    Without a path only the fixed words, which holds most titles back for review."""
    fixed = spark.createDataFrame([(w,) for w in sorted({*DOMAIN, *ABBREVIATIONS, *FALLBACK})], "word string")
    if path is None:
        return fixed
    lines = spark.read.text(path).filter(~F.col("value").startswith("#")).select(F.lower(F.trim("value")).alias("word"))
    return lines.filter("word <> ''").union(fixed).distinct()


def frozen(system: DataFrame) -> DataFrame:
    """(word), sorted, for a frozen list: the system's words (value) and the fixed ones, lower-cased, letters only."""
    spark = system.sparkSession
    own = system.select(F.lower(F.trim("value")).alias("word")).union(words(spark))
    return own.filter(F.col("word").rlike(r"^\p{L}+$")).distinct().orderBy("word")


def label(path: str | None, count: int) -> str:
    """What the metrics say about the list in use."""
    return f"frozen:{path.rstrip('/').rsplit('/', 1)[-1]} ({count} words)" if path else "bundled-fallback (no frozen list)"


def trusted(titles: DataFrame, column: str, lexicon: DataFrame) -> DataFrame:
    """(title, ok) of the distinct titles: at least two words of two letters or more, each known, the last one no
    trailing function word."""
    from .text import TRAILING_STOP

    # kept, or else the filters below are pushed into what finds the titles and each repeats that work
    distinct = titles.select(F.col(column).alias("title")).distinct().persist().filter("title IS NOT NULL")
    own = F.filter(F.regexp_extract_all("title", F.lit("[A-Za-z]+"), F.lit(0)), lambda w: F.length(w) >= 2)
    listed = distinct.withColumn("own", own)
    shaped = listed.withColumn("shaped", (F.size("own") >= 2) & ~F.lower(F.try_element_at("own", F.lit(-1))).isin(*TRAILING_STOP))
    each = shaped.filter("shaped").select("title", F.explode("own").alias("w"))
    judged = recognized(each, "w", lexicon).groupBy("title").agg(F.bool_and("known").alias("ok"))
    return shaped.select("title").join(judged, "title", "left").select("title", F.coalesce("ok", F.lit(False)).alias("ok"))
