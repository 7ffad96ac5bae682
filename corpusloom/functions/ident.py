"""Identity and parsing functions: Column in, Column out, all native."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The public site's addresses.
ORIGIN = "https://www.nyc.gov"
ORDER_PATH = "/content/dam/nycgov/mayors-office/downloads/pdf/executive-orders/"
LEGACY_PATH = "/assets/home/downloads/pdf/executive-orders/"
OTHER_PREFIXES = ("mpo-", "election-proclamation")


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null without one."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


#: White space of Unicode, and the four separators of ASCII.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def only(c: Column, characters: str) -> Column:
    """A text that isn't empty and has no other characters."""
    return (c != "") & (F.ltrim(c, F.lit(characters)) == "")


def mint_id(year: Column, number: Column, emergency: Column) -> Column:
    """``{year}-{EO|EEO}-{label}``; regular all-digit labels are padded to at least three digits."""
    n = strip(number)
    bare = F.ltrim(n, F.lit("0"))
    padded = F.when(F.length(bare) >= 3, bare).otherwise(F.lpad(bare, 3, "0"))
    label = F.when(number.isNull(), F.lit("UNK")).when(emergency, n).when(only(n, "0123456789"), padded).otherwise(n)
    return F.concat_ws("-", year.cast("string"), F.when(emergency, F.lit("EEO")).otherwise(F.lit("EO")), label)


def is_order(title: Column) -> Column:
    return F.lower(strip(title)).contains("executive order")


def is_emergency(title: Column) -> Column:
    return F.lower(strip(title)).startswith("emergency")


def parse_number(title: Column) -> Column:
    return found(title, r"(?iU)order\s+(?:no\.?\s*)?(\d+(?:\.\d+)?)")


def parse_article_date(text: Column) -> Column:
    """``January 5, 2024`` to ISO text; null if it isn't such a date."""
    return F.date_format(F.try_to_date(strip(text), "MMMM d, yyyy"), "yyyy-MM-dd")


def absolute(href: Column) -> Column:
    kept = href.rlike("^https?://")
    return F.when(kept, href).when(href.startswith("/"), F.concat(F.lit(ORIGIN), href)).otherwise(F.concat(F.lit(ORIGIN + "/"), href))


def basename(url: Column) -> Column:
    path = F.regexp_replace(F.regexp_replace(F.regexp_replace(url, r"\?[\s\S]*", ""), "#[\\s\\S]*", ""), "/+$", "")
    return F.element_at(F.split(path, "/"), -1)


def stem(url: Column) -> Column:
    return F.regexp_replace(basename(url), r"(?i)\.pdf$", "")


def filename_identity(url: Column) -> Column:
    """struct(year, number, emergency) of an archived file's name; null if it isn't an order's."""
    rx = r"(?iU)(\d{4})[-_ ]?(EEO|EO)[-_ ]?(\d+(?:\.\d+)?)"
    s = stem(url)
    return F.when(
        s.rlike(rx),
        F.struct(
            F.regexp_extract(s, rx, 1).try_cast("int").alias("year"),
            F.regexp_extract(s, rx, 3).alias("number"),
            (F.upper(F.regexp_extract(s, rx, 2)) == "EEO").alias("emergency"),
        ),
    )


def path_year(url: Column) -> Column:
    return found(F.regexp_replace(url, r"\?[\s\S]*", ""), r"(?iU)/executive-orders/(\d{4})/").try_cast("int")


def assets_identity(url: Column) -> Column:
    """The same where the year is the folder and the name is series and number only."""
    rx = r"(?iU)^(eeo|eo)[-_]?(\d+(?:\.\d+)?)$"
    s, low = stem(url), F.lower(basename(url))
    other = low.startswith(OTHER_PREFIXES[0]) | low.startswith(OTHER_PREFIXES[1])
    return F.when(
        s.rlike(rx) & ~other & path_year(url).isNotNull(),
        F.struct(
            path_year(url).alias("year"), F.regexp_extract(s, rx, 2).alias("number"),
            (F.lower(F.regexp_extract(s, rx, 1)) == "eeo").alias("emergency"),
        ),
    )


def candidate_urls(source: Column, year: Column, number: Column, emergency: Column) -> Column:
    """[public address, legacy address] to look for, or an empty array."""
    path = F.coalesce(F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1), F.lit(""))
    series = F.when(emergency, F.lit("eeo")).otherwise(F.lit("eo"))
    built = F.concat(F.lit(ORDER_PATH), year.cast("string"), F.lit("/"), series, F.lit("-"), number, F.lit(".pdf"))
    at = F.when(F.coalesce(source, F.lit("")) != "", path).when(F.coalesce(number, F.lit("")) != "", built)

    def both(at: Column) -> Column:
        name = F.lower(F.substring_index(F.regexp_replace(at, "/+$", ""), "/", -1))
        legacy = F.concat(F.lit(ORIGIN + LEGACY_PATH), year.cast("string"), F.lit("/"), name)
        return F.when(at.isNull(), F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit(ORIGIN), at), legacy))

    return let(at, both)


def title_kind(title: Column) -> Column:
    """struct(kind, number): volume, eeo, eo or unparsed, by a fixed order of patterns."""
    # The patterns of titles.
    t = F.coalesce(title, F.lit(""))
    num = r"(\d+(?:\.\d+)?)"
    short = rf"(?iU)^\s*(E?)EO\s+(?:No\.?\s*)?{num}\b"
    long = rf"(?iU)^\s*(Emergency\s+)?Executive\s+Order[,\s]*(?:No\.?\s*)?\s*{num}\b"
    loose_e = rf"(?iU)Emergency\s+Executive\s+Order\s*(?:No\.?\s*)?{num}"
    loose = rf"(?U)\bE\.?O\.?\s*(?:No\.?\s*)?{num}\b"

    def of(kind, number):
        return F.struct(kind.alias("kind"), number.alias("number"))

    def series(rx):
        return F.when(F.trim(F.regexp_extract(t, rx, 1)) != "", F.lit("eeo")).otherwise(F.lit("eo"))

    return (
        F.when(t.rlike("(?i)executive orders and memoranda"), of(F.lit("volume"), F.lit(None).cast("string")))
        .when(t.rlike(short), of(series(short), F.regexp_extract(t, short, 2)))
        .when(t.rlike(long), of(series(long), F.regexp_extract(t, long, 2)))
        .when(t.rlike(loose_e), of(F.lit("eeo"), F.regexp_extract(t, loose_e, 1)))
        .when(t.rlike(loose), of(F.lit("eo"), F.regexp_extract(t, loose, 1)))
        .otherwise(of(F.lit("unparsed"), F.lit(None).cast("string")))
    )


def norm_number(number: Column) -> Column:
    """Match key of a label: leading zeros off, a dotted tail kept."""
    n = strip(number)
    return F.when(n.rlike(r"^\d+(\.|$)"), F.regexp_replace(n, r"^0+(?=\d)", "")).otherwise(n)


def clean_title(title: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(strip(F.coalesce(title, F.lit(""))), r"(?U)\s+", " "), r"\.+$", ""))


def year_of(date: Column) -> Column:
    return found(date, r"^(\d{4})").try_cast("int")


def fileset_ids(ids: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(ids, F.lit("")), ","), strip), lambda x: x != "")


def id_year(eo_id: Column) -> Column:
    """Year of an id; 0 if it has none."""
    return F.coalesce(found(eo_id, r"^([0-9]{4})").try_cast("int"), F.lit(0))


def url_key(url: Column) -> Column:
    """Key under which an archive files an address: host labels from the last on, ``)``, path, sorted query; all lower case, without
    scheme, user, default port, ``www`` host, fragment and closing slashes. So addresses of one page share a key, and a
    site's or folder's are neighbours (``key_range``)."""

    def of_name(name: Column) -> Column:
        name = let(name, lambda n: F.when(n.contains("@"), F.regexp_replace(n, r"^.*@", "")).otherwise(n))
        name = let(name, lambda n: F.when(n.endswith(".") | n.contains(":"), F.regexp_replace(n, r"\.*(?::(?:80|443)?)?\z", "")).otherwise(n))
        name = let(name, lambda n: F.when(n.startswith("www"), F.regexp_replace(n, r"^www\d*\.", "")).otherwise(n))
        return let(name, lambda n: F.when(only(n, "0123456789."), n).otherwise(F.array_join(F.reverse(F.split(n, r"\.")), ",")))

    def of_rest(rest: Column) -> Column:
        path = let(F.rtrim(F.substring_index(rest, "?", 1), F.lit("/")), lambda p: F.when(p == "", "/").otherwise(p))
        args = F.filter(F.split(F.regexp_extract(rest, r"^[^?]*\?([\s\S]*)\z", 1), "&"), lambda a: a != "")
        query = let(args, lambda q: F.when(F.size(q) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(q), "&"))).otherwise(""))
        return F.concat(path, F.when(rest.contains("?"), query).otherwise(""))

    def of_parts(bare: Column, host: Column) -> Column:
        return F.concat(of_name(F.lower(host)), F.lit(")"), let(F.lower(F.substring(bare, F.length(host) + 1, F.length(bare))), of_rest))

    bare = F.substring_index(F.regexp_replace(strip(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), "#", 1)
    return let(bare, lambda b: let(F.substring_index(F.substring_index(b, "/", 1), "?", 1), lambda host: of_parts(b, host)))


def key_range(prefix: str) -> tuple[str, str]:
    """(first key, key after the last) of the addresses that begin with ``prefix``, scheme and ``www`` host left out."""
    host, _, path = re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*://", "", prefix.strip()).lower().partition("/")
    host = re.sub(r"^www\d*\.", "", re.sub(r"\.*(?::(?:80|443)?)?\Z", "", host))
    low = ",".join(reversed(host.split("."))) + ")/" + path
    return low, low[:-1] + chr(ord(low[-1]) + 1)


# The second source's addresses, folders and provenance tags.
PORTAL = "https://a860-gpp.nyc.gov"
LIVE, ARCHIVE, ARCHIVE_GAP, ARCHIVE_FOLDERS, SECOND = "live-nycgov", "wayback", "wayback-gap", "wayback-deblasio", "gpp"
HISTORICAL_PREFIX = "nyc.gov/html/records/pdf/executive_orders/"
FOLDERS_PREFIX = "www.nyc.gov/assets/home/downloads/pdf/executive-orders/"
SEARCH = "/bin/nyc/articlesearch.json"


def download_url(fileset: Column) -> Column:
    return F.concat(F.lit(f"{PORTAL}/downloads/"), fileset)


def match_key(mayor: Column, emergency: Column, number: Column) -> Column:
    """struct(mayor, is_emergency, number): what a second source's order and a record share."""
    return F.struct(mayor.alias("mayor"), emergency.alias("is_emergency"), norm_number(number).alias("number"))


def mint_known_id(year: Column, number: Column, emergency: Column) -> Column:
    """``mint_id``, null where year or number are unknown."""
    return F.when(year.isNotNull() & number.isNotNull(), mint_id(year, number, emergency))


# Periods of the sample.
ERAS = (("1974-2001", 1974, 2001), ("2002-2021", 2002, 2021), ("2022-2026", 2022, 2026))


def era(year: Column) -> Column:
    out = F.lit("other")
    for name, lo, hi in reversed(ERAS):
        out = F.when(year.between(lo, hi), F.lit(name)).otherwise(out)
    return out


def pdf_dest(folder: str, year: Column, eo_id: Column) -> Column:
    """``<folder>/<year>/<eo_id>.pdf``."""
    return F.concat(F.lit(f"{folder.rstrip('/')}/"), year.cast("string"), F.lit("/"), eo_id, F.lit(".pdf"))


def dual_dest(folder: str, year: Column, eo_id: Column, fileset: Column) -> Column:
    return F.concat(F.lit(f"{folder.rstrip('/')}/"), year.cast("string"), F.lit("/"), eo_id, F.lit("--"), fileset, F.lit(".pdf"))


def volume_dest(folder: str, fileset: Column) -> Column:
    return F.concat(F.lit(f"{folder.rstrip('/')}/volumes/"), fileset, F.lit(".pdf"))


def relative(path: Column, root: str) -> Column:
    """The path from ``root`` on, or as it is."""
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substring(path, F.lit(len(base) + 1), F.length(path))).otherwise(path)


def resolved(path: Column, root: str) -> Column:
    """Absolute paths kept, others under ``root``; null or empty is null."""
    return F.when(F.coalesce(path, F.lit("")) != "", F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path)))


def search_url(from_date: Column, to_date: Column, size: Column, page: Column) -> Column:
    """Address of one page of the site's search."""
    pair = lambda k, v: F.concat(F.lit(f"{k}="), F.url_encode(v.cast("string")))
    query = F.concat_ws("&", F.lit("types=executive-orders"), pair("fromDate", from_date), pair("toDate", to_date), pair("pageSize", size), pair("currentPage", page))
    return F.concat(F.lit(f"{ORIGIN}{SEARCH}?"), query)


def first_pdf_href(html: Column) -> Column:
    """Address of the first link to an order's PDF in a page, in document order; links in comments don't count. Null without one."""
    bare = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    tag = r"""(?is)<a\s(?:[^>"']|"[^"]*"|'[^']*')*?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
    hrefs = F.transform(F.regexp_extract_all(bare, F.lit(tag), F.lit(1)), lambda h: strip(F.replace(F.regexp_replace(h, r"^[\"']|[\"']$", ""), F.lit("&amp;"), F.lit("&"))))
    wanted = F.filter(hrefs, lambda h: h.rlike(r"(?i)executive-orders/.*\.pdf(?:[?#].*)?$"))
    return absolute(F.try_element_at(wanted, F.lit(1)))


def fold(name: Column) -> Column:
    """Compatibility-decomposed text without combining marks (an Arrow UDF; give it distinct names)."""
    def run(names: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bare = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
        for s in names:
            yield s.map(lambda t: t if t is None or t.isascii() else bare(t))

    return F.pandas_udf(run, "string")(name)


def norm_entity(folded: Column) -> Column:
    """Match key of a folded name: lower case, one leading article off, anything but letters and digits one space."""
    bare = F.regexp_replace(F.lower(folded), r"^\s*(the|a|an)\s+", "")
    return F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " "))
