"""Short display names from catalogue names: ordered chains of rewrites, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curatio.functions.text import let, lit_array

#: Casing of brand words and product lines, makers, descriptions with their short forms, bare type codes.
BRAND_CASING = {"matchking": "MatchKing", "gameking": "GameKing", "varmintking": "VarmintKing", "tippedmatchking": "Tipped MatchKing", "interlock": "InterLock", "superformance": "Superformance"}
LINE_CASING = {"v-match": "V-Match", "v-max": "V-MAX"}
MAKERS = ["sierra", "berger", "barnes", "hornady", "nosler", "swift", "speer", "lapua", "norma"]
DESCRIPTIONS = {
    "jacketed soft point": "JSP",
    "jacketed hollow point": "JHP",
    "full metal jacket boat-tail": "FMJ-BT",
    "full metal jacket": "FMJ",
    "open tip match": "OTM",
    "boat-tail hollow point": "BTHP",
    "bonded soft point": "BSP",
    "hollow point": "HP",
    "soft point": "SP",
    "copper hp": "Copper HP",
}
TYPE_CODES = ["SP", "HP", "RN", "FMJ", "FN", "BT", "FB", "BTSP"]

_MM = r"(?:mm|MM)"
_CAL = r"(?:Cal|CAL|cal|Caliber|CALIBER)"
#: Patterns and what replaces them, in the order in which they apply.
CALIBER_PATTERNS = [
    (rf"\.\d{{3}}/\d+[,.]?\d*\s*{_MM}?\b\s*", " "),
    (r"\d*\.\d{3}\"\s*", " "),
    (r"\(\.\d{2,3}\)", " "),
    (rf"\(\d+[,.]?\d*\s*{_MM}\)", " "),
    (r"(?<!\d)\.\d{2,3}\b\s*,?\s*", " "),
    (rf"\d+[,.]?\d*\s*{_MM}\b\s*", " "),
    (rf"\d+\s+{_CAL}\.?\s+\d{{3}}(?!\s*(?:gr|GR|g\b|grain|Grain))\b\s*", " "),
    (rf"\d+\s+{_CAL}\.?\b\s*", " "),
    (rf"Cal\.\s*\d+\.?\d*\s*{_MM}?\b\s*", " "),
    (r"\bCal\.\s*", " "),
    (r"\d+-\d+\s+(?:WIN|HORNET|ARC|MAG)\b\s*", " "),
    (r"\d+\s+ACC\s+BLK\b\s*", " "),
    (r"(?i)\bdiameter,?\s*", " "),
]
WEIGHT_PATTERNS = [
    (r"\d+[,.]\d+\s*g\s*/\s*", " "),
    (r"\d+[,.]\d+\s*g\b\s*", " "),
    (r"\d+\.?\d*\s*(?:gr|GR|grain|Grain|Grains|GRAIN)\b\.?\s*", " "),
]
SUFFIX_PATTERNS = [(r"(?i)\bComponent\s+Bullet\b", ""), (r"(?i)\bRifle\s+Bullets?\b", ""), (r"(?i)\bBullets?\b", "")]
PACK_PATTERNS = [(r"(?i)\(\d+\s*(?:ct|count)\)", ""), (r"(?i)-\s*\d+\s*ct\b", "")]
CODE_PATTERNS = [(r"\b[A-Z]{1,2}\d{3,4}\b", ""), (r"\([A-Z]{2,4}\)", "")]
CARTRIDGE_PATTERNS = [
    (r"(?i)\d+\.?\d*\s+(?:Creedmoor|PRC|Win(?:chester)?|WSM|Rem(?:ington)?|Wby\s+Mag(?:num)?|Lapua(?:\s+Mag)?|Blackout|Hornet|HMR|WMR|WSSM|Valkyrie|Springfield|Grendel)\b", " "),
    (r"(?i)\d+-\d+\s+(?:Win|Springfield|Rem)\b", " "),
    (r"(?i)\d+x\d+\w*\s*(?:NATO)?\b", " "),
    (r"(?i)\d+\s+(?:Win|Rem)\s+Mag\b", " "),
]
VELOCITY_PATTERNS = [(r"(?i)\d+\s*fps\b", "")]
LINE_PATTERNS = [(r"(?i)\s+(?:Rifle|TIPPED|Rimfire)$", "")]
CLEAN_PATTERNS = [(r"\(\s*\)", ""), (r"\s*[,|]\s*", " "), (r"(?U)\s+", " ")]
BRANDED_PATTERNS = [(r"(?i)\b(?:Boat-Tail Hollow Point|Soft Point|Hollow Point)\b", "")]


def rewritten(text: Column, *chains: list[tuple[str, str]]) -> Column:
    for chain in chains:
        for pattern, new in chain:
            text = F.regexp_replace(text, pattern, new)
    return text


def plain(text: Column) -> Column:
    return F.translate(text, "‑–—®™", "---")


def cleaned(text: Column) -> Column:
    return F.btrim(rewritten(text, CLEAN_PATTERNS), F.lit(" \t\n-"))


def cased(text: Column, casing: dict[str, str]) -> Column:
    for lower, proper in casing.items():
        found = r"\s+".join(proper.split()) if " " in proper else lower
        text = F.regexp_replace(text, rf"(?i)\b{found}\b", proper)
    return text


def without_maker(text: Column, maker: Column) -> Column:
    """Without the maker's name, or its first word, at the start, if anything is left."""
    return let(text, lambda t: _without_maker(t, maker))


def _without_maker(text: Column, maker: Column) -> Column:
    first = F.split(maker, " ")[0]
    rest = lambda name: F.ltrim(F.substring(text, F.length(name) + 1, F.length(text)))
    begins = lambda name: F.lower(text).startswith(F.lower(name)) & (rest(name) != "")
    named = F.coalesce(maker, F.lit("")) != ""
    return F.when(named & begins(maker), rest(maker)).when(named & maker.contains(" ") & begins(first), rest(first)).otherwise(text)


def bullet_display_name(name: Column, product_line: Column | None = None, maker: Column | None = None) -> Column:
    text = rewritten(plain(name), CALIBER_PATTERNS, WEIGHT_PATTERNS, SUFFIX_PATTERNS, PACK_PATTERNS, CODE_PATTERNS)
    text = cased(text, BRAND_CASING)
    text = cleaned(without_maker(text, maker) if maker is not None else text)
    if product_line is None:
        return text
    return let(text, lambda t: F.when((F.length(t) < 2) & (F.coalesce(product_line, F.lit("")) != ""), bullet_line(product_line)).otherwise(t))


def bullet_line(product_line: Column) -> Column:
    return cleaned(cased(plain(product_line), BRAND_CASING))


def cartridge_line(product_line: Column) -> Column:
    return cleaned(cased(rewritten(plain(product_line), LINE_PATTERNS), LINE_CASING))


def combined(cartridge: Column, bullet: Column) -> Column:
    """Both lines, what they share once; a maker's name goes if it stands between other words and the bullet's line."""

    def of(p: Column) -> Column:
        line, own, c, b = p["line"], p["own"], F.lower(p["line"]), F.lower(p["own"])
        at = F.instr(c, b)
        words = F.split(F.rtrim(F.substring(line, F.lit(1), at - 1)), r"\s+")
        drop = (at > 1) & (F.size(words) > 1) & F.lower(F.element_at(words, -1)).isin(MAKERS)
        shorter = cleaned(F.concat_ws(" ", F.array_join(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), " "), F.substring(line, at, F.length(line))))
        return F.when(c == b, line).when(c.contains(b), F.when(drop, shorter).otherwise(line)).when(b.contains(c), own).otherwise(F.concat_ws(" ", line, own))

    return let(F.struct(cartridge.alias("line"), bullet.alias("own")), of)


def _comma_form(text: Column) -> Column:
    return text.contains(", ") & (F.size(F.split(text, ",")) >= 4)


def _identity_by_comma(text: Column) -> Column:
    """The fourth of the comma-separated parts, abbreviated, or nothing if it repeats the first."""
    parts = F.split(text, ",")
    described = F.trim(parts[3])
    for maker in MAKERS:
        described = F.trim(F.regexp_replace(described, rf"(?i)\b{maker}\b", ""))
    table = F.create_map(*(F.lit(x) for pair in DESCRIPTIONS.items() for x in pair))

    def of(p: Column) -> Column:
        lower, rest = F.lower(p["d"]), cleaned(rewritten(p["d"], BRANDED_PATTERNS))
        short = F.try_element_at(table, lower)
        return F.when(short.isNotNull(), short).when(p["line"].contains(lower) | p["line"].startswith(lower), F.lit(None)).otherwise(let(rest, lambda r: F.when(F.length(r) >= 2, r)))

    return let(F.struct(F.lower(F.trim(parts[0])).alias("line"), described.alias("d")), of)


def identity_from_name(name: Column, cartridge: Column) -> Column:
    """What a cartridge's name says of its bullet, besides the cartridge's line; null if nothing."""
    text = plain(name)

    def rest_of(p: Column) -> Column:
        at = F.instr(F.lower(p["short"]), F.lower(p["line"]))
        rest = cleaned(F.concat(F.substring(p["short"], F.lit(1), at - 1), F.substring(p["short"], at + F.length(p["line"]), F.length(p["short"]))))
        return F.when(at > 0, let(rest, lambda r: F.when((F.length(r) >= 2) & ~F.array_contains(lit_array(TYPE_CODES), F.upper(r)), r)))

    short = cleaned(rewritten(text, CARTRIDGE_PATTERNS, WEIGHT_PATTERNS, VELOCITY_PATTERNS))
    by_line = let(F.struct(short.alias("short"), cartridge.alias("line")), rest_of)
    return F.when(_comma_form(text), _identity_by_comma(text)).otherwise(by_line)


def derived_from_name(name: Column) -> Column:
    text = plain(name)
    short = cleaned(cased(rewritten(text, CARTRIDGE_PATTERNS, WEIGHT_PATTERNS, VELOCITY_PATTERNS), BRAND_CASING))
    return F.when(_comma_form(text), cleaned(rewritten(F.trim(F.split(text, ",")[0]), LINE_PATTERNS))).otherwise(short)


def cartridge_display_name(name: Column, product_line: Column, bullet_product_line: Column) -> Column:
    """Four ways: from both lines, the cartridge's line and its name, the bullet's line, or the name alone."""
    line = F.when(F.coalesce(product_line, F.lit("")) != "", cartridge_line(product_line))
    bullet = F.when(F.coalesce(bullet_product_line, F.lit("")) != "", bullet_line(bullet_product_line))

    def of(p: Column) -> Column:
        identity = let(identity_from_name(p["name"], p["line"]), lambda i: F.when(i.isNotNull(), combined(p["line"], i)).otherwise(p["line"]))
        return F.when((p["line"] != "") & (p["own"] != ""), combined(p["line"], p["own"])).when(p["line"] != "", identity).when(p["own"] != "", p["own"]).otherwise(derived_from_name(p["name"]))

    return let(F.struct(name.alias("name"), F.coalesce(line, F.lit("")).alias("line"), F.coalesce(bullet, F.lit("")).alias("own")), of)
