"""Reports over the catalogue: coverage by calibre, parsers against the catalogue, flags, what to verify next, numbers in notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.text import caliber_alike, maker_alike

#: Two numbers agree within the larger of the absolute and the relative tolerance.
ABSOLUTE, RELATIVE = 0.01, 0.01

#: Patterns of numbers in notes, and bores whose name is not the bullet's diameter.
WEIGHT = r"(?i)(\d+(?:\.\d+)?)\s*gr"
BC_G1 = r"(?i)G1\s*(?:BC)?\s*[=:]?\s*(0\.\d+)"
BC_G7 = r"(?i)G7\s*(?:BC)?\s*[=:]?\s*(0\.\d+)"
DIAMETER = r"""\.(2[0-9]{2}|3[0-9]{2}|4[0-9]{2}|5[0-9]{2}|6[0-9]{2})\s*["'/]"""
DIAMETER_CAL = r"(?i)^\.(\d{3})\s+(?:/|CAL)"
BORE_TO_BULLET = {0.270: 0.277, 0.303: 0.311, 0.405: 0.411, 0.500: 0.510}
DIAMETER_TOLERANCE = 0.008


def caliber_coverage(calibers: DataFrame, bullets: DataFrame, cartridges: DataFrame, rifles: DataFrame, bridge: DataFrame) -> DataFrame:
    """Bullets, cartridges and rifles of each ranked calibre: each side is counted once and joined.

    calibers: caliber_id, name, rank, diameter; bullets: diameter; cartridges: caliber_id; rifles: chamber_id; bridge:
    caliber_id, chamber_id."""
    ranked = calibers.where("rank is not null")
    of_size = bullets.groupBy("diameter").agg(F.count("*").alias("n_bullets"))
    of_caliber = cartridges.groupBy("caliber_id").agg(F.count("*").alias("n_cartridges"))
    of_chamber = rifles.groupBy("chamber_id").agg(F.count("*").alias("n"))
    taken = bridge.select("caliber_id", "chamber_id").distinct().join(of_chamber, "chamber_id").groupBy("caliber_id").agg(F.sum("n").alias("n_rifles"))
    out = ranked.join(of_size, "diameter", "left").join(of_caliber, "caliber_id", "left").join(taken, "caliber_id", "left")
    return out.select("rank", "name", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_bullets", "n_cartridges", "n_rifles")))


def numbers_agree(a: Column, b: Column) -> Column:
    """Both missing, or both there and close."""
    close = F.abs(a - b) <= F.greatest(F.lit(ABSOLUTE), RELATIVE * F.greatest(F.abs(a), F.abs(b)))
    return F.when(a.isNull() & b.isNull(), True).otherwise(F.coalesce(close, F.lit(False)))


def against_catalogue(parsed: DataFrame, known: DataFrame, fields: list[str], *, asked: list[str] = (), codes: list[str] = ()) -> DataFrame:
    """Parsed pages (url, declined, fields) with ``outcome`` and ``diffs`` against the catalogue's rows (url, is_locked, fields).

    outcome: declined, not_in_catalogue, match or diff.  Of the fields, those in ``asked`` count only where the parser gives
    a value, and those in ``codes``, which are compared as they are, only where both sides have one.  A url of several
    rows in the catalogue is compared with each."""
    mine = parsed.select("url", "declined", *(F.col(c).alias(f"p_{c}") for c in [*fields, *codes]))
    theirs = known.select("url", "is_locked", *(F.col(c).alias(f"k_{c}") for c in [*fields, *codes]), F.lit(True).alias("__known"))
    told = []
    for c in fields:
        apart = ~numbers_agree(F.col(f"p_{c}"), F.col(f"k_{c}"))
        told.append(F.when(apart & F.col(f"p_{c}").isNotNull() if c in asked else apart, F.lit(c)))
    told += [F.when(F.col(f"p_{c}") != F.col(f"k_{c}"), F.lit(c)) for c in codes]
    here = F.col("__known").isNotNull() & ~F.col("declined")
    out = mine.join(theirs, "url", "left").withColumn("diffs", F.when(here, F.array_compact(F.array(*told))).otherwise(F.array().cast("array<string>")))
    outcome = F.when(F.col("declined"), "declined").when(~here, "not_in_catalogue").when(F.size("diffs") == 0, "match").otherwise("diff")
    return out.select("url", outcome.alias("outcome"), (here & F.coalesce("is_locked", F.lit(False))).alias("locked"), "diffs")


def flag_counts(flags: DataFrame) -> DataFrame:
    """(by, value, n): flagged items by reason, 'unknown' if none is given, and by status, 'pending' if none is given."""
    told = flags.select(F.coalesce("reason", F.lit("unknown")).alias("reason"), F.coalesce("status", F.lit("pending")).alias("status"))
    both = told.groupBy("reason", "status").agg(F.count("*").alias("n"))
    pairs = F.array(F.struct(F.lit("reason").alias("by"), F.col("reason").alias("value")), F.struct(F.lit("status").alias("by"), F.col("status").alias("value")))
    return both.select(F.explode(pairs).alias("p"), "n").groupBy("p.by", "p.value").agg(F.sum("n").alias("n"))


def next_to_verify(records: DataFrame, log: DataFrame, today: Column, n: int, days: int = 30) -> DataFrame:
    """The n records (id) to verify next: none verified in the last days, first those never verified, then the longest ago.

    log: id, verified (date).  The limit is the feature: a sample for one sitting."""
    last = log.groupBy("id").agg(F.max("verified").alias("last_verified"))
    due = records.join(last, "id", "left").where(F.col("last_verified").isNull() | (F.col("last_verified") < F.date_sub(today, days)))
    return due.orderBy(F.col("last_verified").asc_nulls_first(), "id").limit(n)


def _number(text: Column, pattern: str, before: str = "") -> Column:
    hit = F.regexp_extract(text, pattern, 1)
    return F.when(hit != "", F.concat(F.lit(before), hit).cast("double"))


def note_numbers(rows: DataFrame, caliber: str = "caliber", notes: str = "notes") -> DataFrame:
    """Adds note_weight, note_g1, note_g7 and note_diameter, read from a calibre's text and notes; null where there is none."""
    c, n = F.coalesce(caliber, F.lit("")), F.coalesce(notes, F.lit(""))
    diameter = F.coalesce(_number(F.concat_ws(" ", c, n), DIAMETER, "0."), _number(F.trim(c), DIAMETER_CAL, "0."))
    return rows.withColumns({"note_weight": _number(n, WEIGHT), "note_g1": _number(n, BC_G1), "note_g7": _number(n, BC_G7), "note_diameter": diameter})


def same_diameter(named: Column, actual: Column) -> Column:
    """Whether a named diameter is the actual one; a bore whose name is not the bullet's diameter stands for that diameter."""
    meant = named
    for name, bullet in BORE_TO_BULLET.items():
        meant = F.when(F.abs(named - F.lit(name)) <= 1e-9, F.lit(bullet)).otherwise(meant)
    return F.abs(meant - actual) <= DIAMETER_TOLERANCE


#: How far a work list may be from the catalogue, and a cartridge from its bullet.
WEIGHT_GAP = 1.0
COEFFICIENT_GAP = 0.05
DIAMETER_GAP = 0.001


def crosscheck(entries: DataFrame, bullets: DataFrame, cartridges: DataFrame) -> DataFrame:
    """(url, entity, finding, expected, actual): what a work list expects of the catalogue and does not find there.

    entries: url, entity_type, expected_manufacturer, expected_caliber, brief_description, notes; bullets: url, maker, weight,
    diameter, g1, g7; cartridges: url, maker, caliber, velocity, a row for each url.  An entry that the catalogue does not have says nothing."""
    text = lambda x: x.cast("string")

    def told(finding: str, holds: Column, expected: Column, actual: Column) -> Column:
        return F.when(F.coalesce(holds, F.lit(False)), F.struct(F.lit(finding).alias("finding"), text(expected).alias("expected"), text(actual).alias("actual")))

    given = lambda c: F.coalesce(c, F.lit("")) != ""
    maker = told("MANUFACTURER", given(F.col("expected_manufacturer")) & ~maker_alike(F.col("expected_manufacturer"), F.col("maker")), F.col("expected_manufacturer"), F.col("maker"))
    noted = note_numbers(entries, "expected_caliber")
    stated = _number(F.coalesce("brief_description", F.lit("")), WEIGHT)
    weight = F.when(stated != 0, stated).otherwise(F.nullif("note_weight", F.lit(0.0)))
    checks = [
        maker,
        told("WEIGHT", (F.col("weight") != 0) & (F.abs(weight - F.col("weight")) > WEIGHT_GAP), weight, F.col("weight")),
        told("DIAMETER", (F.col("diameter") != 0) & ~same_diameter(F.col("note_diameter"), F.col("diameter")), F.col("note_diameter"), F.col("diameter")),
    ]
    for c in ("g1", "g7"):
        noted_c, actual = F.col(f"note_{c}"), F.col(c)
        checks.append(told("BC_MISSING", noted_c.isNotNull() & actual.isNull(), noted_c, actual))
        checks.append(told("BC_MISMATCH", F.try_divide(F.abs(noted_c - actual), noted_c) > COEFFICIENT_GAP, noted_c, actual))
    of_bullets = noted.where("entity_type = 'bullet'").join(bullets, "url").select("url", F.lit("bullet").alias("entity"), F.explode(F.array_compact(F.array(*checks))).alias("x"))
    checks = [
        maker,
        told("CALIBER", given(F.col("expected_caliber")) & ~caliber_alike(F.col("expected_caliber"), F.col("caliber")), F.col("expected_caliber"), F.col("caliber")),
        told("ZERO_VELOCITY", F.col("velocity") == 0, F.lit(None), F.col("velocity")),
    ]
    of_cartridges = entries.where("entity_type = 'cartridge'").join(cartridges, "url").select("url", F.lit("cartridge").alias("entity"), F.explode(F.array_compact(F.array(*checks))).alias("x"))
    return of_bullets.unionByName(of_cartridges).select("url", "entity", "x.*")


def linked_mismatches(cartridges: DataFrame, bullets: DataFrame) -> DataFrame:
    """Cartridges (bullet_id, bullet_weight, bullet_diameter) that say another weight or diameter than their bullets (id, weight, diameter)."""
    off = {"weight": F.abs(F.col("bullet_weight") - F.col("__weight")) > WEIGHT_GAP, "diameter": F.abs(F.col("bullet_diameter") - F.col("__diameter")) > DIAMETER_GAP}
    at = cartridges.join(bullets.select(F.col("id").alias("bullet_id"), F.col("weight").alias("__weight"), F.col("diameter").alias("__diameter")), "bullet_id")
    at = at.withColumns({f"{c}_off": F.coalesce(x, F.lit(False)) for c, x in off.items()})
    return at.where("weight_off or diameter_off").drop("__weight", "__diameter")


def without_coefficients(bullets: DataFrame) -> DataFrame:
    """(maker, n, without): a maker's bullets, and those of which no published or estimated coefficient is known."""
    none = F.coalesce("g1", "g7", "g1_est", "g7_est").isNull()
    return bullets.groupBy("maker").agg(F.count("*").alias("n"), F.count_if(none).alias("without"))


#: What makes a name one to tidy.
NAME_PATTERNS = {
    "pack_count": r"(?i)\(\s*\d+\s*ct\s*\)",
    "all_caps": r"^(?=.*\p{Lu})[^\p{Ll}]+$",
    "caliber_in_name": r"(?i)(?:\b\d+(?:\.\d+)?\s*cal\b|\b\d+(?:\.\d+)?\s*mm\b)",
    "metric_weight": r"(?i)\d+(?:[.,]\d+)?\s*g\s*/\s*\d+(?:\.\d+)?\s*gr\b",
    "trademark": r"[®™©]|\((?:R|TM)\)",
    "too_long": r"(?s)^.{81,}$",
}


def name_patterns(rows: DataFrame) -> DataFrame:
    """(maker, n, a count for each pattern) of rows (maker, name)."""
    return rows.groupBy("maker").agg(F.count("*").alias("n"), *(F.count_if(F.col("name").rlike(p)).alias(c) for c, p in NAME_PATTERNS.items()))
