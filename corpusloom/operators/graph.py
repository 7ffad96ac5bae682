"""Citation graph: operative citations, header stamps, dangles and what is still in force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import spans
from ..functions.ident import fold, let, mint_id, norm_entity

# Months, verbs, limits and patterns of the citation rules. Each begins with the letters that it may begin with, as most places of a text fail there.
MONTH = "January|February|March|April|May|June|July|August|September|October|November|December"
CITE = (
    r"(?iU)(?=[Ee])(Emergency\s+)?Executive\s+Order\s+(?:No\.?|Nos\.?|Number)?\s*(\d{1,4})"
    rf"(?:\s*,?\s*dated\s+(?:{MONTH})\.?\s+\d{{1,2}}(?:st|nd|rd|th)?\s*,?\s*(\d{{4}})|\s+of\s+(\d{{4}}))?"
)
VERB = r"(?iU)(?=[AHIahi\u0130\u0131])\b(?:is|are|hereby\s+is|hereby\s+are)\s+(?:hereby\s+)?(amended|extended|repealed|replaced|rescinded|revoked|superseded)\b"
BOUNDARY = r"(?U)§|(?=S)(?<![A-Za-z])Section\s"
SCOPE = r"(?iU)\b(?:section|sections|paragraph|subdivision|§)\b[^.;§\n]{0,60}\bof\s*$"
# What a citation's match holds: its number, and a year after it.
NUMBER, YEAR = r"(?U)\d{1,4}", r"(?Us)\d.*\D(\d{4})$"
SCOPE_END = r"(?U)[Oo][Ff]\s*$"
XREF = r"""(?iU)XREF\s*:?\s*(REVOKED|RESCINDED|SUPERSEDED|REPEALED|AMENDED|REPLACED)\s+BY\s+['"‘’“”]?\s*(?:E\.?E\.?O|EO)\s*(\d{1,4})[)\s,]+(\d{4})"""
LOOKBACK, SCOPE_BACK = 400, 60
REVOKES = ("revoked", "rescinded", "superseded", "repealed", "replaced")
ESTABLISH = (
    r"(?iU)there\s+is\s+hereby\s+establish(?:ed|ing)?\b(?:\s*,?\s*within\s+[^,\n]{3,80}\s*,)?\s*(an?|the)\s+([A-Z][^.;:\n]{3,90}?)"
    r"(?=\s*(?:,|\.|;|:|\bwhich\b|\bthat\b|\bto\s+be\b|\bheaded\b|\bconsisting\b|\(|\bshall\b|\bwithin\b|\bof\s+the\s+City\s+of\s+New\s+York\b|$))"
)


def governed(docs: DataFrame) -> DataFrame:
    """(actor, verb, emergency, number, year, partial) of ``docs`` (eo_id, full_text): the citations each operative verb governs.

    A verb governs the citations that start after the last clause boundary of the ``LOOKBACK`` characters before it. Matches of
    the three patterns are rows, so their offsets are running sums, a verb's boundary is a running maximum and its citations are
    those of a frame of ``LOOKBACK`` characters: linear in a text's matches. Only matches are shuffled, once, by their text, without its
    words: whether a citation is of a part is told before, from the matches beside it.
    Texts that repeat under one id are resolved once and counted.
    """
    text = F.coalesce("full_text", F.lit(""))
    kinds = {"verb": "string", "emergency": "boolean", "number": "string", "year": "int", "partial": "boolean"}

    def events(kind: str, pattern: str, own: Callable[[Column, Column, Column], dict[str, Column]]) -> Column:
        def one(found: Column) -> Column:
            def event(x: Column, i: Column) -> Column:
                told = own(found, x, i)
                rest = [told.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()]
                return F.struct(F.lit(kind).alias("kind"), F.length(x["gap"]).alias("gap"), F.length(x["match"]).alias("size"), *rest)

            return F.transform(found, event)

        return let(F.filter(spans.matches(text, pattern), lambda x: x["match"].isNotNull()), one)

    def cited(found: Column, x: Column, i: Column) -> dict[str, Column]:
        tail = lambda y: F.right(y["gap"], F.lit(SCOPE_BACK))
        # the text before a citation, from its gap and, if that is short, earlier citations and theirs, which are 16 characters long at least
        before = lambda y: F.coalesce(F.concat(tail(y), y["match"]), F.lit(""))
        earlier = [before(F.get(found, i - k)) for k in range(SCOPE_BACK // 16 + 1, 0, -1)]
        near = F.when(F.length(x["gap"]) >= SCOPE_BACK, tail(x)).otherwise(F.right(F.concat(*earlier, tail(x)), F.lit(SCOPE_BACK)))
        # the gap alone tells whether it ends so, as matches end with a digit
        partial = tail(x).rlike(SCOPE_END) & let(near, lambda s: s.rlike(SCOPE))
        # from the match, not from the text: a pass over all of it for each group costs more than all else
        number, year = F.regexp_extract(x["match"], NUMBER, 0), F.regexp_extract(x["match"], YEAR, 1).try_cast("int")
        return {"emergency": F.substring(x["match"], 2, 1).isin("m", "M"), "number": number, "year": year, "partial": partial}

    verb = lambda found, x, i: {"verb": F.regexp_extract(x["match"], VERB, 1)}
    every = F.concat(events("cite", CITE, cited), events("bound", BOUNDARY, lambda found, x, i: {}), events("verb", VERB, verb))
    # the digest first: in the select of the explosion the text would go along with each match
    rows = docs.select(F.col("eo_id").alias("actor"), F.unhex(F.sha2(text, 256)).alias("text"), every.alias("every"))
    # not the bare column, for which Spark adds a filter on its size that finds every match once more
    rows = rows.select("actor", "text", F.posexplode(F.filter("every", lambda e: e["gap"].isNotNull())).alias("at", "e"))
    key = ["actor", "text"]
    rows = rows.select(*key, "at", "e.*").repartition(*key)
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))  # a text's repeats are one, in the same partition
    rows = rows.withColumn("start", spans.start_of([*key, "kind"], "at", F.col("gap"), F.col("size")))
    end = F.col("start") + F.col("size")
    rows = rows.withColumn("place", F.when(F.col("kind") == "bound", end).otherwise(F.col("start")))
    along = Window.partitionBy(*key).orderBy("place")
    bound = F.max(F.when(F.col("kind") == "bound", F.struct(end.alias("end"), "start"))).over(along.rangeBetween(Window.unboundedPreceding, 0))
    cite = F.when(F.col("kind") == "cite", F.struct("start", "emergency", "number", "year", "partial"))
    verbs = rows.withColumn("bound", bound).withColumn("cites", F.collect_list(cite).over(along.rangeBetween(-LOOKBACK, -1))).filter("kind = 'verb'")
    low = F.greatest(F.col("start") - LOOKBACK, F.lit(0))
    floor = F.when(F.col("bound.start") >= low, F.col("bound.end")).otherwise(low)
    found = verbs.select("actor", "verb", "copies", floor.alias("floor"), F.explode("cites").alias("c")).filter("c.start >= floor")
    found = found.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return found.select("actor", F.lower("verb").alias("verb"), *(F.col(f"c.{k}").alias(k) for k in ("emergency", "number", "year", "partial")))


def body_citations(docs: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """(actor, target, verb, partial, outcome) of ``docs`` (eo_id, full_text): outcome edge, extension, self or why the
    citation dangles. ``corpus`` (eo_id) is what may be cited; by default the documents themselves."""
    known = (docs if corpus is None else corpus).select(F.col("eo_id").alias("_id")).distinct()
    rows = governed(docs)
    bare = F.regexp_replace("number", r"^0+(?=\d)", "")
    minted = mint_id(F.col("year"), bare, F.col("emergency"))
    label = F.concat(F.when(F.col("emergency"), "EEO-").otherwise("EO-"), "number")
    why = F.when(F.col("year").isNull(), "no-year").when(~F.col("year").between(1950, 2099), "implausible-year")
    rows = rows.withColumn("why", why).withColumn("target", F.when(why.isNull(), minted).otherwise(label))
    rows = rows.join(known, F.col("target") == F.col("_id"), "left")
    outcome = (
        F.when(F.col("verb") == "extended", "extension")
        .when(F.col("why").isNotNull(), F.col("why"))
        .when(F.col("target") == F.col("actor"), "self")
        .when(F.col("_id").isNull(), "not-in-corpus")
        .otherwise("edge")
    )
    return rows.select("actor", "target", "verb", "partial", outcome.alias("outcome"))


def header_citations(docs: DataFrame) -> DataFrame:
    """The same for archival stamps in ``dropped_header``: the stamped order is the target."""
    known = docs.select(F.col("eo_id").alias("_id")).distinct()
    found = F.inline(spans.matches(F.coalesce("dropped_header", F.lit("")), XREF, {"verb": 1, "num": 2, "year": 3}))
    rows = docs.select(F.col("eo_id").alias("target"), found).filter("match IS NOT NULL")
    actor = mint_id(F.col("year").try_cast("int"), F.regexp_replace("num", r"^0+(?=\d)", ""), F.lit(False))
    rows = rows.withColumn("actor", actor).filter("actor <> target").join(known, F.col("actor") == F.col("_id"), "left")
    outcome = F.when(F.col("_id").isNull(), "not-in-corpus").otherwise("edge")
    return rows.select("actor", "target", F.lower("verb").alias("verb"), F.lit(False).alias("partial"), outcome.alias("outcome"))


def edges(docs: DataFrame) -> DataFrame:
    """Distinct edges (actor, target, verb, source, partial) from bodies and headers."""
    body = body_citations(docs).filter("outcome = 'edge'").withColumn("source", F.lit("body-citation"))
    head = header_citations(docs).filter("outcome = 'edge'").withColumn("source", F.lit("header-xref"))
    return body.unionByName(head).select("actor", "target", "verb", "source", "partial").distinct()


def annotate(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` (eo_id, is_emergency, ...) with supersedes, superseded_by and in_effect, rebuilt from the edges.

    in_effect is false for a regular order that an edge revokes whole, else null; it is never true.
    """
    out = found.groupBy(F.col("actor").alias("_a")).agg(F.array_sort(F.collect_set("target")).alias("supersedes"))
    back = found.groupBy(F.col("target").alias("_t")).agg(
        F.array_sort(F.collect_set("actor")).alias("superseded_by"), F.bool_or(F.col("verb").isin(*REVOKES) & ~F.col("partial")).alias("_gone")
    )
    none = F.array().cast("array<string>")
    rows = docs.drop("supersedes", "superseded_by", "in_effect").join(out, F.col("eo_id") == F.col("_a"), "left")
    rows = rows.join(back, F.col("eo_id") == F.col("_t"), "left")
    rows = rows.withColumn("supersedes", F.coalesce("supersedes", none)).withColumn("superseded_by", F.coalesce("superseded_by", none))
    return rows.withColumn("in_effect", F.when(F.col("_gone") & ~F.col("is_emergency"), F.lit(False))).drop("_a", "_t", "_gone")


def established_entities(docs: DataFrame) -> DataFrame:
    """(eo_id, raw_name): bodies that regular orders say they establish."""
    found = spans.matches(F.coalesce("full_text", F.lit("")), ESTABLISH, {"name": 2})
    rows = docs.filter(~F.col("is_emergency")).select("eo_id", F.inline(found)).filter("match IS NOT NULL")
    name = F.trim(F.regexp_replace("name", r"(?U)\s+", " "))
    return rows.select("eo_id", F.regexp_replace(name, r"(?i)\s+(?:of|for|on|in|to|within|and|the|a|an)$", "").alias("raw_name"))


def match_entities(found: DataFrame, registry: DataFrame) -> DataFrame:
    """(eo_id, raw_name, status, registry_id) of established names against the registry (id, name): match, ambiguous or no-match.

    Names are folded once each. A key with several ids is ambiguous and never written.
    """
    keyed = lambda d, c: d.select(F.col(c).alias("_n")).distinct().withColumn("_key", norm_entity(fold(F.col("_n"))))
    listed = registry.join(keyed(registry, "name"), F.col("name") == F.col("_n")).filter("_key <> ''")
    index = listed.groupBy("_key").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    asked = keyed(found, "raw_name").join(index, "_key", "left")
    status = F.when(F.col("ids").isNull(), "no-match").when(F.size("ids") > 1, "ambiguous").otherwise("match")
    rows = found.filter("raw_name <> ''").join(asked, F.col("raw_name") == F.col("_n"))
    return rows.select("eo_id", "raw_name", status.alias("status"), F.when(status == "match", F.element_at("ids", 1)).alias("registry_id"))


def with_entity(docs: DataFrame, matches: DataFrame) -> DataFrame:
    """``docs`` with establishes_entity: the registry id where exactly one name of the order matched, else null."""
    only = matches.filter("status = 'match'").groupBy(F.col("eo_id").alias("_e")).agg(F.count("*").alias("_m"), F.min("registry_id").alias("_id"))
    rows = docs.drop("establishes_entity").join(only, F.col("eo_id") == F.col("_e"), "left")
    return rows.withColumn("establishes_entity", F.when(F.col("_m") == 1, F.col("_id"))).drop("_e", "_m", "_id")
