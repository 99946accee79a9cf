"""Name normalisation as Column functions: everything here stays inside code generation or array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Maker prefixes and generic suffixes that product lines shed (suffixes longest first).
MAKER_PREFIXES = ["sierra", "nosler", "berger", "barnes", "hornady", "speer", "lapua", "federal", "winchester", "remington", "swift", "cutting edge", "lehigh"]
LINE_SUFFIXES = ["component bullet", "soft point", "bullets", "bullet"]
#: Words that do not tell products apart.
NOISE_WORDS = [
    "gr", "grain", "grains", "cal", "caliber", "mm", "ct", "count", "bullet", "bullets", "component", "rifle", "handgun", "pistol",
    "sierra", "nosler", "berger", "barnes", "hornady", "speer", "lapua", "federal", "winchester", "remington",
]
#: Abbreviations and the words they stand for, in the order in which they are expanded.
ABBREVIATIONS = {
    "hpbt": ["hollow", "point", "boat", "tail"],
    "bthp": ["boat", "tail", "hollow", "point"],
    "hp": ["hollow", "point"],
    "bt": ["boat", "tail"],
    "sp": ["soft", "point"],
    "fmj": ["full", "metal", "jacket"],
    "otm": ["open", "tip", "match"],
    "smk": ["sierra", "matchking"],
    "tmk": ["tipped", "matchking"],
    "jhp": ["jacketed", "hollow", "point"],
    "jsp": ["jacketed", "soft", "point"],
    "rn": ["round", "nose"],
    "fn": ["flat", "nose"],
    "spbt": ["soft", "point", "boat", "tail"],
}


def lit_array(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def strip_trademarks(name: Column) -> Column:
    return F.translate(name, "®™©", "")


def plain_dashes(name: Column) -> Column:
    return F.regexp_replace(name, "[‐-―]", "-")


def collapse(name: Column) -> Column:
    return F.trim(F.regexp_replace(name, r"(?U)\s+", " "))


def _tokens(name: Column, each) -> Column:
    """A name's tokens passed through ``each``, what is left of them joined again."""
    return F.trim(F.array_join(F.transform(F.split(name, " "), each), " "))


def _no_trailing_dots(token: Column) -> Column:
    return F.when(token.startswith("."), token).otherwise(F.rtrim(token, F.lit(".")))


def normalize_lookup(name: Column) -> Column:
    """For exact lookups: lower case, punctuation but periods to blanks (hyphens too), no trailing periods."""
    s = F.regexp_replace(F.trim(F.lower(strip_trademarks(name))), r"(?U)[^\w\s.]", " ")
    return _tokens(collapse(s), _no_trailing_dots)


def normalize_match(name: Column) -> Column:
    """For scoring: as ``normalize_lookup``, but hyphens stay and Unicode dashes become hyphens."""
    s = F.regexp_replace(plain_dashes(F.trim(F.lower(strip_trademarks(name)))), r"(?U)[^\w\s.\-]", " ")
    return _tokens(collapse(s), _no_trailing_dots)


def without_leading_dots(normalized: Column) -> Column:
    """Period-insensitive form: '.308 win' and '308 win' are one."""
    return _tokens(normalized, lambda t: F.ltrim(t, F.lit(".")))


def normalize_caliber(name: Column) -> Column:
    return without_leading_dots(normalize_lookup(name))


def let(x: Column, use) -> Column:
    """use(x) with x computed once, however often it stands there."""
    return F.transform(F.array(x), use)[0]


def _strip_maker(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "^(?:" + "|".join(MAKER_PREFIXES) + ") ", ""))


def _strip_line_suffix(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<=\S)\s* (?:" + "|".join(LINE_SUFFIXES) + ")$", "")


def normalize_product_line(name: Column) -> Column:
    """A product line's short form: no maker, no generic suffix; an abbreviation in parentheses wins if it is no longer."""

    def shorter(s: Column) -> Column:
        inner = F.trim(F.regexp_extract(s, r"\(([^)]+)\)", 1))
        main = _strip_line_suffix(_strip_maker(F.trim(F.regexp_replace(s, r"\([^)]*\)", ""))))
        parts = F.struct(F.when(~inner.rlike(r"^\d+(?U)\w*$"), _strip_maker(inner)).otherwise("").alias("short"), main.alias("main"))
        return let(parts, lambda p: F.when((p["short"] != "") & (F.length(p["short"]) <= F.length(p["main"])), p["short"]).otherwise(p["main"]))

    return let(collapse(plain_dashes(F.trim(F.lower(strip_trademarks(name))))), shorter)


def meaningful_tokens(name: Column) -> Column:
    """Distinct tokens and the parts of hyphenated ones, without numbers and noise words."""
    parts = lambda w: F.flatten(F.transform(w, lambda t: F.when(t.contains("-"), F.split(t, "-")).otherwise(F.array().cast("array<string>"))))
    words = F.array_distinct(let(F.split(normalize_match(name), " "), lambda w: F.concat(w, parts(w))))
    return F.array_except(F.filter(words, lambda t: (t != "") & ~F.replace(t, F.lit("."), F.lit("")).rlike(r"^\d+$")), lit_array(NOISE_WORDS))


def expand_abbreviations(words: Column) -> Column:
    """Adds the words of every abbreviation present and every abbreviation whose words are all present, in one ordered pass."""
    table = F.array(*(F.struct(F.lit(a).alias("a"), lit_array(w).alias("w")) for a, w in ABBREVIATIONS.items()))

    def step(have: Column, entry: Column) -> Column:
        more = F.when(F.array_contains(have, entry["a"]), F.array_union(have, entry["w"])).otherwise(have)
        return let(more, lambda m: F.when(F.size(F.array_except(entry["w"], m)) == 0, F.array_union(m, F.array(entry["a"]))).otherwise(m))

    return F.aggregate(table, words, step)


def _contained(query: Column, target: Column) -> Column:
    """The share of the query's words that the target has, damped for a query of one word."""

    def share(n: Column) -> Column:
        return F.when((n["q"] > 0) & (n["hit"] > 0), n["hit"] / n["q"] * (0.5 + 0.5 * F.least(n["q"] / 2, F.lit(1.0)))).otherwise(F.lit(0.0))

    count = lambda q: F.struct(F.size(q).cast("double").alias("q"), F.size(F.array_intersect(q, target)).alias("hit"))
    return let(let(query, count), share)


def said_words(name: Column) -> Column:
    """The words of a short type name: of the whole, and of what stands before its first parenthesis, if there is one."""
    words = lambda x: expand_abbreviations(meaningful_tokens(x))
    at = F.instr(name, "(")
    head = F.trim(F.substring(name, F.lit(1), at - 1))
    return F.struct(words(name).alias("whole"), F.when(at > 1, words(head)).alias("head"))


def known_words(name: Column) -> Column:
    return expand_abbreviations(meaningful_tokens(name))


def containment_of(said: Column, known: Column) -> Column:
    """The score of words that said_words and known_words gave: for joins, whose names have their words found before."""
    whole = _contained(said["whole"], known)
    return F.when(said["head"].isNotNull(), F.greatest(whole, _contained(said["head"], known))).otherwise(whole)


def containment_score(extracted: Column, known: Column) -> Column:
    """How well a short type name is contained in a full product name: 0 to 1, the better of the whole name and what
    stands before its first parenthesis."""
    return let(F.struct(said_words(extracted).alias("s"), known_words(known).alias("k")), lambda w: containment_of(w["s"], w["k"]))


def slugify(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(F.lower(name), F.lit("™"), F.lit("")), "[^a-z0-9]+", "-"), F.lit("-"))


def report_form(text: Column) -> Column:
    return collapse(F.lower(F.replace(F.translate(text, "®™", ""), F.lit("‑"), F.lit("-"))))


def truncated(text: Column, most: int = 80) -> Column:
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most - 3)), F.lit("..."))).otherwise(text)


def url_host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("AUTHORITY")))


def url_hash(url: Column) -> Column:
    return F.left(F.sha2(url, 256), F.lit(16))


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


#: What calibre names shed, in this order, before they are compared across catalogues.
CALIBER_SUFFIXES = ["magnum", "mag", "remington", "rem", "winchester", "win", "swedish", "mauser"]


def caliber_canon(name: Column) -> Column:
    s = F.trim(F.regexp_replace(normalize_match(name), r"\.|mm", ""))
    for suffix in CALIBER_SUFFIXES:
        s = F.trim(F.replace(s, F.lit(suffix), F.lit("")))
    return s


def same_numbers(a: Column, b: Column) -> Column:
    numbers = lambda x: F.array_sort(F.array_distinct(F.regexp_extract_all(x, F.lit(r"\d+"), F.lit(0))))
    return (F.size(numbers(a)) > 0) & (numbers(a) == numbers(b))


def caliber_alike(expected: Column, known: Column, alternatives: Column | None = None) -> Column:
    """The same calibre in other words: equal in short form, one within the other, or the same numbers."""
    canon = caliber_canon(expected)
    x, y = (F.replace(normalize_match(c), F.lit("."), F.lit("")) for c in (expected, known))
    alike = (canon == caliber_canon(known)) | x.contains(y) | y.contains(x) | same_numbers(expected, known)
    return alike if alternatives is None else alike | F.coalesce(F.exists(alternatives, lambda a: caliber_canon(a) == canon), F.lit(False))


def maker_alike(a: Column, b: Column) -> Column:
    x, y = normalize_match(a), normalize_match(b)
    return (x == y) | F.arrays_overlap(F.split(x, " "), F.split(y, " "))
