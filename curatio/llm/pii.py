"""PII surrogates: detected entities give way to keyed ones of the same type, gender, script and format.

Detection is one pattern over whole texts: e-mail addresses, phone, card and social security numbers, IPv4
addresses, bank account numbers, access keys, long hex strings, passwords and tokens that are assigned, and
persons named after a title.  Card numbers must have a network's prefix and length and a right check digit;
they are sought among all groups of digits first, so that numbers beside them do not hide them.  A family name that
stands after a title is sought in the rest of its text too, with the given name before it unless that may only begin
a sentence.  A password needs no digit, other secrets need one.

An entity is a type and a normal form, so "(523) 555-1055", "+1 523-555-1055" and "001 523 555 1055" are one, as are a
person's family name alone and with a given name, and a given name whatever the title.  Every distinct entity draws a
candidate by an HMAC of its type, form and attempt: digits for digits, letters for letters of the same case, the same
country for a phone, a card number of the same network or a bank account of the same country with right check digits, a
given name in the script of the name, of the gender that the titles of all its places agree on.  A candidate that is
any real entity's form (of names, any real name), or that another entity has drawn, is drawn again at the next attempt,
until none clashes; so distinct entities stay distinct across the whole corpus, and each has one surrogate in all
documents.  A surrogate is then written in the format of each place where its entity stands.

All of it is DataFrame functions.  Every text is matched once, and its matches and what stands between them are kept in
a scratch table; of the texts with entities, each distinct one is looked up once.  Persons in a script other than Latin,
Greek or Cyrillic and persons never named after a title are not sought, and domains become names below example.net.

Null texts stay null, very long texts are matched whole, ties (entities that draw the same surrogate) go to the least
form, texts without entities stay as they are, repeated rows get the same text, and all other
columns are carried through, whatever their names.  An empty table gives an empty result.  The same key gives
the same surrogates for the same set of entities.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.functions.text import let
from curatio.llm.shared import partitions, salted_join, scratch, text_key

#: Titles by gender, then names by script and gender to draw from.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "Госпожа", "κυρία", "Κυρία"],
    "m": ["Mr", "Mister", "Herr", "Monsieur", "Señor", "господин", "Господин", "κύριος", "Κύριος"],
    "n": ["Dr", "Prof", "Professor"],
}
GIVEN = {
    "latin_f": "Alma Bianca Clara Dora Edith Flora Greta Helga Irma Julia Karin Linda Marta Nadia Olga Paula Rosa Silvia Tina Ursula Vera Wilma",
    "latin_m": "Albert Bruno Carl David Erik Felix Gustav Hugo Ivan Jonas Karl Leon Martin Nils Oscar Peter Robert Simon Thomas Ulrich Victor Walter",
    "latin_n": "Alex Andrea Casey Chris Dominique Eden Jamie Jordan Kim Lee Luca Maxime Morgan Nicola Noel Robin Sam Sasha Sidney Taylor",
    "cyrillic_f": "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Лидия Мария Нина Ольга Полина Раиса София Тамара",
    "cyrillic_m": "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Леонид Максим Николай Олег Павел Роман Степан",
    "cyrillic_n": "Женя Саша Валя Слава Шура Паша",
    "greek_f": "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Θάλεια Ιωάννα Κατερίνα Μαρία Νίκη Σοφία",
    "greek_m": "Αλέξης Βασίλης Γιώργος Δημήτρης Ηλίας Θανάσης Ιάσων Κώστας Λευτέρης Μάριος Νίκος Πέτρος",
    "greek_n": "Αλέξ Χάρις Φώτη",
}
FAMILY = {
    "latin": "Adler Becker Carver Dalton Ellis Fischer Garner Hale Ibsen Jensen Keller Lambert Moreau Norton Olsen Palmer Quinn Romero Sanders Thorne Unger Vidal Weber York Zeller",
    "cyrillic": "Абраменко Бондаренко Власенко Гордиенко Демченко Ерёменко Захаренко Иваненко Коваленко Лысенко Мельниченко Назаренко Павленко Романенко Савченко Тимошенко",
    "greek": "Αγγέλου Βασιλείου Γεωργίου Δημητρίου Ευθυμίου Ζήση Θεοδώρου Ιωάννου Κωνσταντίνου Λάμπρου Μιχαήλ Νικολάου",
}

_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
_NAME = r"\p{Lu}[\p{L}'’]+(?:-\p{Lu}[\p{L}'’]+)?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Type and pattern; where two could begin at one place, the first wins.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)+",
    "secret": r"(?<![\p{L}\p{N}])(?:(?i:password|passwd|pwd)[\"']?\s{0,3}[=:]\s{0,3}[\"']?[^\s\"',;]{8,}+|(?i:secret|token|api[_\-]?key|access[_\-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?(?=[^\s\"',;\d]*+\d)[^\s\"',;]{8,}+)",
    "key": r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[po]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9]{20,})(?![A-Za-z0-9])",
    "hex": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![A-Za-z0-9])",
    "phone": r"(?<![\p{L}\p{N}+])(?:(?:\+|00)1[ .\-]?\(?\d{3}\)?[ .\-]?\d{3}[ .\-]?\d{4}|(?:\+|00(?=[1-9]\d{0,2}[ .\-]))\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?!\d)",
    "card": r"(?<![\p{L}\p{N}.\-])\d(?:[ \-]?\d){12,18}(?![\p{L}\p{N}])",
    "ip": rf"(?<![\p{{L}}\p{{N}}.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[\p{{L}}\p{{N}}])",
    "ssn": r"(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}\-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "person": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? {_NAME}(?: {_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Card numbers: the prefixes and lengths of the networks; a surrogate keeps what stands for the network.
_CARD = r"^(?:4\d{12}(?:\d{3}){0,2}|(?:5[1-5]|2[2-7])\d{14}|3[47]\d{13}|3[068]\d{12}|6(?:011|5\d\d|4[4-9]\d)\d{12})$"
_NETWORK = r"^(6\d\d\d|\d\d)"
_BEFORE_SECRET = r"^.*?[=:]\s{0,3}[\"']?"


#: The types but cards, in two parts: cards, which no pattern tells, stand between them, as those of the text.
_FIRST, _LAST = ("|".join(f"(?:{PATTERNS[k]})" for k in kinds) for kinds in (list(PATTERNS)[: list(PATTERNS).index("card")], list(PATTERNS)[list(PATTERNS).index("card") + 1 :]))
#: The country codes of phone numbers, the two-digit ones and else three digits.
_COUNTRY = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: Around a card: it may stand beside other numbers, apart by a blank or a hyphen.
_BESIDE = r"(?<![\p{L}\p{N}.])(?<!(?<!\d)-)", r"(?![\p{L}\p{N}])"


def cards_of(text: Column) -> Column:
    """The card numbers of a text as they are written, the longest first, from wherever a group of digits begins to wherever one ends."""
    found = [F.regexp_extract_all(text, F.lit(rf"{_BESIDE[0]}(?=(\d(?:[ \-]?\d){{{n - 1}}}){_BESIDE[1]})"), F.lit(1)) for n in (19, 16, 15, 14, 13)]
    valid = F.filter(F.flatten(F.array(*found)), lambda c: let(digits(c), lambda d: d.rlike(_CARD) & luhn(d)))
    return F.when(text.rlike(r"\d(?:[ \-]?\d){12}"), F.array_join(F.array_distinct(valid), "|")).otherwise("")


def people_of(text: Column) -> Column:
    """The family names that stand after a title in a text, as they are written, the longest first."""
    named = F.regexp_extract_all(text, F.lit(rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? (?:{_NAME} )?({_NAME})"), F.lit(1))
    names = F.array_sort(F.filter(F.array_distinct(named), lambda n: F.length(n) > 2), lambda x, y: F.when(F.length(x) != F.length(y), F.length(y) - F.length(x)).when(x < y, -1).when(x > y, 1).otherwise(0))
    return F.when(text.rlike(_HINTS[1]), F.array_join(names, "|")).otherwise("")


def pattern_of(cards: Column, people: Column) -> Column:
    """The pattern of all entities in a text that has these cards and family names."""
    cards = F.when(cards == "", "").otherwise(F.concat(F.lit(_BESIDE[0] + "(?:"), cards, F.lit(f"){_BESIDE[1]}|")))
    given = rf"(?<![\p{{L}}\p{{N}}'’\-])(?:(?<=[\p{{Ll}}\p{{N}},;:] ){_NAME} )?(?:"
    people = F.when(people == "", "").otherwise(F.concat(F.lit("|" + given), people, F.lit(r")(?![\p{L}\p{N}])")))
    return F.concat(F.lit(_FIRST + "|"), cards, F.lit(_LAST), people)


#: Every entity has a digit, an at sign, a title before a capital in its text, or is a key, hex string or password: cheap looks before the full pattern.
_HINTS = ("[0-9@]", rf"(?=[MFHSDPгГκΚ])(?<!\p{{L}})(?:{_TITLE})\.? \p{{Lu}}", r"(?:AKIA|ASIA)[A-Z]{16}|gh[po]_[A-Za-z]{30}|(?<![A-Za-z])sk-[A-Za-z]{20}|(?<![A-Za-z])(?:[a-f]{32}|[A-F]{32})|(?i:password|passwd|pwd)[\"']?\s{0,3}[=:]")


def matches(text: Column, cards: Column | None = None, people: Column | None = None) -> Column:
    """The entities of a text; cards, people: what cards_of and people_of say of it, if that is known."""
    pattern = pattern_of(cards_of(text) if cards is None else cards, people_of(text) if people is None else people)
    return F.when(reduce(lambda a, b: a | b, map(text.rlike, _HINTS)), F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(F.array().cast("array<string>"))


def kind_of(match: Column) -> Column:
    """The type of a match; null for what only looks like one."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        told = match.rlike(rf"^(?:(?:{_TITLE})\.? )?{_NAME}(?: {_NAME})?$" if kind == "person" else f"^(?:{pattern})$")
        out = F.when(told & digits(match).rlike(_CARD) & luhn(digits(match)) if kind == "card" else told, F.lit(kind)).otherwise(out)
    return out


def digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def luhn_sum(number: Column, doubled: int) -> Column:
    """The check sum of a string of digits; doubled: whether the last digit counts once (0) or twice (1)."""

    def add(total: Column, i: Column) -> Column:
        d = F.try_element_at(F.split(number, ""), F.length(number) - i).cast("int")
        d = F.when((i + doubled) % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)
        return total + F.coalesce(d, F.lit(0))

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add)


def luhn(number: Column) -> Column:
    return (F.length(number) > 1) & (luhn_sum(number, 0) % 10 == 0)


def script_of(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def gender_of(match: Column) -> Column:
    title = F.regexp_extract(match, r"^([\p{L}]+)", 1)
    out = F.lit("n")
    for gender in ("m", "f"):
        out = F.when(title.isin(TITLES[gender]), gender).otherwise(out)
    return out


def names_of(match: Column) -> Column:
    """A person's names after the title."""
    return F.split(F.regexp_replace(match, rf"^(?:{_TITLE})\.? ", ""), " ")


def entities_of(match: Column) -> Column:
    """The (kind, norm) pairs of a match: two for a person with a given name, none for what only looks like an entity."""
    return let(kind_of(match), lambda kind: _entities(match, kind))


def _entities(match: Column, kind: Column) -> Column:
    names = names_of(match)
    number = F.regexp_replace(digits(match), "^00", "")
    number = F.when(match.rlike(r"^(?:\+|00)"), number).otherwise(F.concat(F.lit("1"), number))  # without a country: that of the only such form
    norm = (
        F.when(kind == "email", F.lower(match))
        .when(kind == "phone", number)
        .when(kind.isin("card", "ssn"), digits(match))
        .when(kind == "iban", F.regexp_replace(match, " ", ""))
        .when(kind == "secret", F.regexp_replace(match, _BEFORE_SECRET, ""))
        .otherwise(match)
    )
    pair = lambda k, n: F.struct(k.alias("kind"), n.alias("norm"))
    family = pair(F.concat(F.lit("family_"), script_of(match_name := F.element_at(names, -1))), F.lower(match_name))
    given = pair(F.concat(F.lit("given_"), script_of(F.element_at(names, 1))), F.lower(F.element_at(names, 1)))
    person = F.when(F.size(names) > 1, F.array(given, family)).otherwise(F.array(family))
    return F.when(kind.isNull(), F.expr("cast(array() as array<struct<kind:string,norm:string>>)")).when(kind == "person", person).otherwise(F.array(pair(kind, norm)))


def hmac(key: str, message: Column) -> Column:
    """HMAC-SHA-256 in hex."""
    raw = key.encode() if len(key.encode()) <= 64 else hashlib.sha256(key.encode()).digest()
    inner, outer = (bytearray(b ^ pad for b in raw.ljust(64, b"\0")) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(F.lit(outer), F.unhex(F.sha2(F.concat(F.lit(inner), F.encode(message, "UTF-8")), 256))), 256)


def candidates(entities: DataFrame, key: str) -> DataFrame:
    """entities (kind, norm, gender, attempt) with ``surrogate``, the candidate of that attempt."""

    def drawn(n: int | Column, *on: Column) -> Column:
        message = F.concat_ws("\x1f", "kind", *[x.cast("string") for x in on])
        return F.pmod(F.conv(F.substring(hmac(key, message), 1, 12), 16, 10).cast("long"), n if isinstance(n, Column) else F.lit(n)).cast("int")

    def shaped(x: Column, *on: Column, alphabet: str = "") -> Column:
        """Digits for digits and letters for letters, of the same case."""

        def one(c: Column, i: Column) -> Column:
            at = lambda letters: F.substring(F.lit(letters), drawn(len(letters), F.lit("shape"), i, *on) + 1, F.lit(1))
            if alphabet:
                return F.when(F.lit(alphabet).contains(c), at(alphabet)).otherwise(c)
            return F.when(c.rlike(r"\d"), F.when(i == 0, at("23456789")).otherwise(at("0123456789"))).when(c.rlike(r"\p{Lu}"), at("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).when(c.rlike(r"\p{L}"), at("abcdefghijklmnopqrstuvwxyz")).otherwise(c)

        return F.array_join(F.transform(F.split(x, ""), one), "")

    norm, attempt = F.col("norm"), F.col("attempt")
    own = (norm, attempt)
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    longer = F.when(attempt > 1, F.array_join(F.transform(F.sequence(F.lit(2), F.greatest(attempt, F.lit(2))), lambda i: F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), drawn(26, F.lit("longer"), i, *own) + 1, F.lit(1))), "")).otherwise("")
    email = F.concat(shaped(local, *own), longer, F.lit("@"), shaped(F.substring_index(domain, ".", 1), domain), F.lit(".example.net"))
    country = F.regexp_extract(norm, _COUNTRY, 1)
    phone = F.concat(country, shaped(F.substring(norm, F.length(country) + 1, F.length(norm)), *own))
    network = F.regexp_extract(norm, _NETWORK, 1)
    body = F.concat(network, F.substring(shaped(norm, *own), F.length(network) + 1, F.length(norm) - F.length(network) - 1))
    card = F.concat(body, F.pmod(-luhn_sum(body, 1), F.lit(10)).cast("string"))
    octet = lambda i, n, low: (drawn(n, F.lit(i), *own) + low).cast("string")
    ip = F.concat_ws(".", octet(1, 223, 1), octet(2, 256, 0), octet(3, 256, 0), octet(4, 254, 1))
    fixed = F.regexp_extract(norm, r"^(AKIA|ASIA|gh[po]_|sk-|)", 1)
    access = F.concat(fixed, F.substring(shaped(norm, *own), F.length(fixed) + 1, F.length(norm)))
    account = F.substring(shaped(norm, *own), F.lit(5), F.length(norm))
    iban = F.concat(F.substring(norm, 1, 2), F.lpad((98 - modulo_97(F.concat(account, F.substring(norm, 1, 2), F.lit("00")))).cast("string"), 2, "0"), account)

    hexed = F.when(norm == F.lower(norm), shaped(norm, *own, alphabet="0123456789abcdef")).otherwise(shaped(norm, *own, alphabet="0123456789ABCDEF"))

    def from_pool(names: str) -> Column:
        pool = F.array(*map(F.lit, names.split()))
        # every second clash adds a name by a hyphen, so the pool never runs out
        return F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.col("attempt") / 2).cast("int")), lambda i: F.element_at(pool, drawn(len(names.split()), i, *own) + 1)), "-")

    by_kind = {"email": email, "phone": phone, "card": card, "ip": ip, "key": access, "iban": iban, "hex": hexed, "ssn": shaped(norm, *own)}
    by_kind["secret"] = F.when(norm.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$"), hexed).otherwise(shaped(norm, *own))
    by_kind |= {f"family_{k}": from_pool(v) for k, v in FAMILY.items()}
    for script in FAMILY:
        by_kind[f"given_{script}"] = F.when(F.col("gender") == "f", from_pool(GIVEN[f"{script}_f"])).when(F.col("gender") == "m", from_pool(GIVEN[f"{script}_m"])).otherwise(from_pool(GIVEN[f"{script}_n"]))
    surrogate = reduce(lambda rest, k: F.when(F.col("kind") == k, by_kind[k]).otherwise(rest), by_kind, F.lit(None).cast("string"))
    return entities.withColumn("surrogate", surrogate)


def modulo_97(account: Column) -> Column:
    """What a bank account number leaves when divided by 97, its letters read as 10 to 35."""
    value = lambda c: F.ascii(c) - F.when(c.rlike("[0-9]"), 48).otherwise(55)
    return F.aggregate(F.filter(F.split(account, ""), lambda c: c != ""), F.lit(0), lambda r, c: F.pmod(r * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c), F.lit(97)))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) for distinct (kind, norm): no two share a surrogate, and none is another's norm, nor, of
    names, any real name; entities: (kind, norm, gender), a row for each place."""
    says = lambda g: F.max((F.col("gender") == g).cast("int"))
    agreed = F.when(says("f") == says("m"), "n").when(says("f") == 1, "f").otherwise("m")
    real = scratch(entities.groupBy("kind", "norm").agg(agreed.alias("gender")), "entities")
    space = F.when(F.col("kind").rlike("^(given|family)_"), "name").otherwise(F.col("kind"))
    taken = real.select(space.alias("space"), F.col("norm").alias("form")).distinct()
    done, left, first = None, real.withColumn("attempt", F.lit(0)), True
    while True:
        # the first round has all entities, in as few files as their size asks for
        drawn = scratch(candidates(left.repartition(partitions(entities.sparkSession), "kind", "norm") if first else left, key), "drawn", small=not first)
        form = F.when(space == "name", F.lower("surrogate")).otherwise(F.col("surrogate"))
        free = drawn.withColumns({"space": space, "form": form}).join(taken.hint("merge"), ["space", "form"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate").hint("merge"), ["kind", "surrogate"], "left_anti")
        won = scratch(free.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm")), "won", small=not first)
        done = won if done is None else done.unionByName(won)
        left = drawn.join(won.select("kind", "norm").hint("merge"), ["kind", "norm"], "left_anti").select("kind", "norm", "gender", (F.col("attempt") + 1).alias("attempt"))
        left, first = scratch(left, "left", small=True), False
        if not left.limit(1).count():
            return done.select("kind", "norm", "surrogate")


def written(match: Column, known: Column) -> Column:
    """A match with its surrogate in its own format; known: a map from kind and norm to surrogate."""
    surrogates_of = lambda kind: F.transform(_entities(match, kind), lambda p: F.try_element_at(known, F.concat(p["kind"], F.lit(" "), p["norm"])))
    return let(kind_of(match), lambda kind: let(surrogates_of(kind), lambda found: _written(match, kind, found)))


def _written(match: Column, kind: Column, found: Column) -> Column:
    first = F.try_element_at(found, F.lit(1))

    def poured(number: Column) -> Column:
        start = F.struct(F.lit("").alias("s"), F.lit(1).alias("i"))
        step = lambda a, c: F.when(c.rlike(r"\d"), F.struct(F.concat(a["s"], F.substring(number, a["i"], F.lit(1))).alias("s"), (a["i"] + 1).alias("i"))).otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["i"].alias("i")))
        return F.aggregate(F.split(match, ""), start, step, lambda a: a["s"])

    title = F.regexp_extract(match, rf"^((?:{_TITLE})\.? )", 1)
    names = names_of(match)
    phone = F.when(match.startswith("00"), F.concat(F.lit("00"), first)).when(match.startswith("+"), first).otherwise(F.substring(first, F.lit(2), F.length(first)))
    cased = F.transform(F.arrays_zip(names.alias("n"), found.alias("f")), lambda x: F.when(x["n"] == F.upper(x["n"]), F.upper(x["f"])).otherwise(x["f"]))
    spaced = F.aggregate(
        F.split(match, ""),
        F.struct(F.lit("").alias("s"), F.lit(1).alias("i")),
        lambda a, c: F.when(c == " ", F.struct(F.concat(a["s"], c).alias("s"), a["i"].alias("i"))).otherwise(F.struct(F.concat(a["s"], F.substring(first, a["i"], F.lit(1))).alias("s"), (a["i"] + 1).alias("i"))),
        lambda a: a["s"],
    )
    out = (
        F.when(kind.isNull() | F.exists(found, lambda f: f.isNull()), match)
        .when(kind == "email", F.when(match == F.upper(match), F.upper(first)).otherwise(first))
        .when(kind == "phone", poured(phone))
        .when(kind.isin("card", "ssn"), poured(first))
        .when(kind == "secret", F.concat(F.regexp_extract(match, f"({_BEFORE_SECRET})", 1), first))
        .when(kind == "iban", spaced)
        .when(kind == "person", F.concat(title, F.array_join(cased, " ")))
        .otherwise(first)
    )
    return out


def pseudonymised(docs: DataFrame, key: str, *, text: str = "text", count: str | None = None) -> DataFrame:
    """docs with surrogates in ``text``; count: the name of a further column with the number of places replaced."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = names[docs.columns.index(text)]
    k1, k2 = text_key(F.col(at))
    read = docs.toDF(*names).withColumns({"cards": cards_of(F.col(at)), "people": people_of(F.col(at))}).withColumn("found", matches(F.col(at), F.col("cards"), F.col("people")))
    hit = F.size("found") > 0
    read = read.withColumn("parts", F.when(hit, F.split(F.col(at), pattern_of(F.col("cards"), F.col("people")), -1)))
    # the text of a hit is in its parts
    read = scratch(read.select(*[F.when(~F.coalesce(hit, F.lit(False)), F.col(c)).alias(c) if c == at else c for c in names], "parts", F.when(hit, F.col("found")).alias("found"), F.when(hit, k1).alias("k1"), F.when(hit, k2).alias("k2")), "matched")
    rows = read.where("found is not null")
    mentions = rows.select("k1", "k2", F.explode(F.array_distinct("found")).alias("m")).select("k1", "k2", gender_of(F.col("m")).alias("gender"), F.explode(entities_of(F.col("m"))).alias("e"))
    mentions = scratch(mentions.select("k1", "k2", "e.kind", "e.norm", "gender").distinct(), "mentions")
    table = scratch(surrogates(mentions, key), "surrogates")
    asked = salted_join(mentions.select("k1", "k2", "kind", "norm").distinct(), table, ["kind", "norm"], by=["k1", "k2"])
    known = asked.groupBy("k1", "k2").agg(F.map_from_entries(F.collect_list(F.struct(F.concat("kind", F.lit(" "), "norm"), "surrogate"))).alias("known"))
    known = scratch(known, "known")
    whole = F.array_join(F.flatten(F.zip_with("parts", "new", lambda p, m: F.array(p, F.coalesce(m, F.lit(""))))), "")
    changed = F.size(F.filter(F.arrays_zip(F.col("found").alias("a"), F.col("new").alias("b")), lambda x: x["a"] != x["b"]))
    hits = salted_join(rows, known, ["k1", "k2"], how="left").withColumn("known", F.coalesce("known", F.create_map().cast("map<string,string>")))
    hits = hits.withColumn("new", F.transform("found", lambda m: written(m, F.col("known"))))
    hits = hits.select(*[whole.alias(c) if c == at else F.col(c) for c in names], changed.cast("long").alias("n"))
    clean = read.where("found is null").select(*names, F.lit(0).cast("long").alias("n"))
    out = clean.unionByName(hits)
    return out.toDF(*docs.columns, count) if count else out.drop("n").toDF(*docs.columns)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymised(docs, "curatio-demonstration-key", count="n_replaced")
