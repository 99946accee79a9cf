"""Value rules from tables: unit repair, ranges, agreement, findings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.numbers import FPS_PER_MPS, GRAINS_PER_GRAM, MM_PER_INCH, close, lenient_float
from curatio.operators.rank import first_n

#: The valid range of each measured field, in the order in which fields are checked.
RANGES = {
    "bc_g1": (0.05, 1.2),
    "bc_g7": (0.05, 1.2),
    "bc_value": (0.05, 1.2),
    "bullet_diameter_inches": (0.172, 0.510),
    "weight_grains": (15, 750),
    "bullet_weight_grains": (15, 750),
    "muzzle_velocity_fps": (400, 4000),
    "barrel_length_inches": (10, 34),
    "test_barrel_length_inches": (10, 34),
    "sectional_density": (0.05, 0.500),
    "length_inches": (0.2, 3.0),
    "bullet_length_inches": (0.2, 3.0),
    "weight_lbs": (2, 20),
}
#: The one unit mistake that each field is checked for.
CONVERSIONS = {
    "weight_grains": (GRAINS_PER_GRAM, "grams_to_grains"),
    "bullet_weight_grains": (GRAINS_PER_GRAM, "grams_to_grains"),
    "muzzle_velocity_fps": (FPS_PER_MPS, "m/s_to_fps"),
    "bullet_diameter_inches": (1.0 / MM_PER_INCH, "mm_to_inches"),
    "length_inches": (1.0 / MM_PER_INCH, "mm_to_inches"),
    "bullet_length_inches": (1.0 / MM_PER_INCH, "mm_to_inches"),
}
CRITICAL = {"bullet": {"bullet_diameter_inches", "weight_grains"}, "cartridge": set(), "rifle": set()}


@dataclass(frozen=True)
class Rule:
    field: str
    low: float
    high: float
    factor: float | None = None
    reason: str | None = None
    critical: bool = False


def rules_for(entity_type: str, fields: list[str]) -> list[Rule]:
    return [Rule(f, *RANGES[f], *CONVERSIONS.get(f, (None, None)), f in CRITICAL.get(entity_type, set())) for f in RANGES if f in fields]


def normalized(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Each rule's field repaired: in range it stays, else the unit conversion if that is in range, else null.

    Adds events (field, original, normalized, reason), rejected (a critical field was lost) and rejection_reason (the
    last one's).  Text with a number becomes that number without an event; text without one stays null, untouched.
    """
    values, events = {}, []
    for r in rules:
        x = lenient_float(F.col(r.field))
        fits = lambda v, r=r: v.between(r.low, r.high)
        fixed = x * r.factor if r.factor else F.lit(None).cast("double")
        turned = F.coalesce(fits(fixed), F.lit(False))
        values[r.field] = F.when(fits(x), x).when(turned, fixed)
        reason = F.when(turned, r.reason).otherwise(f"nulled_out_of_range[{r.low},{r.high}]")
        event = F.struct(F.lit(r.field).alias("field"), x.alias("original_value"), F.when(turned, fixed).alias("normalized_value"), reason.alias("reason"), F.lit(r.critical).alias("critical"))
        events.append(F.when(x.isNotNull() & ~fits(x), event))
    out = rows.withColumn("events", F.array_compact(F.array(*events))).withColumns(values)
    lost = F.filter("events", lambda e: e["critical"] & e["normalized_value"].isNull())
    out = out.withColumn("rejected", F.size(lost) > 0)
    return out.withColumn("rejection_reason", F.when(F.col("rejected"), F.concat(F.lit("critical field "), F.element_at(lost, -1)["field"], F.lit(" out of range"))))


def range_warnings(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds warnings: the names of the fields whose number is out of range; what is no number is skipped."""
    out = [F.when(~lenient_float(F.col(r.field)).between(r.low, r.high), F.lit(r.field)) for r in rules]
    return rows.withColumn("warnings", F.array_compact(F.array(*out)))


def agreement(a: Column, b: Column, agree: Column) -> Column:
    """One of five classes for two sources of a field."""
    return F.when(a.isNull() & b.isNull(), "both_null").when(a.isNull(), "first_null").when(b.isNull(), "second_null").when(agree, "agree").otherwise("disagree")


def field_agreement(rows: DataFrame, pairs: dict[str, tuple[str, str]], rel: float = 0.005, absolute: float = 0.01) -> DataFrame:
    """(field, class counts, pct_agree) over numeric field pairs; the share is of rows where both have a value."""
    classes = F.array(*(F.struct(F.lit(f).alias("field"), agreement(F.col(a), F.col(b), close(F.col(a), F.col(b), rel, absolute)).alias("class")) for f, (a, b) in pairs.items()))
    counts = [F.count_if(F.col("x.class") == c).alias(c) for c in ("agree", "disagree", "first_null", "second_null", "both_null")]
    out = rows.select(F.explode(classes).alias("x")).groupBy(F.col("x.field").alias("field")).agg(*counts)
    both = F.col("agree") + F.col("disagree")
    return out.withColumn("pct_agree", F.when(both > 0, F.round(100.0 * F.col("agree") / both, 2)))


def findings(rows: DataFrame, id_column: str, checks: dict[str, Column]) -> DataFrame:
    """(id, finding): one row for each check that holds; a null check does not."""
    told = F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in checks.items())))
    return rows.select(id_column, F.explode(told).alias("finding"))


def issue_states(before: DataFrame, now: DataFrame, key: list[str]) -> DataFrame:
    """(key, state): new, known or resolved between two runs' findings."""
    a, b = before.select(*key).distinct().withColumn("was", F.lit(True)), now.select(*key).distinct().withColumn("is", F.lit(True))
    state = F.when(F.col("was").isNull(), "new").when(F.col("is").isNull(), "resolved").otherwise("known")
    return a.join(b, key, "full").select(*key, state.alias("state"))


def issue_history(found: DataFrame, key: list[str], latest: Column, run: str = "run") -> DataFrame:
    """(key, first_seen, last_seen, times_seen, state) of issues found in runs; state: new, known or resolved in the latest run."""
    out = found.select(*key, run).distinct().groupBy(*key).agg(F.min(run).alias("first_seen"), F.max(run).alias("last_seen"), F.count("*").alias("times_seen"))
    state = F.when(F.col("last_seen") < latest, "resolved").when(F.col("first_seen") == latest, "new").otherwise("known")
    return out.withColumn("state", state)


def disagreement_samples(rows: DataFrame, pairs: dict[str, tuple[str, str]], order: list[str], n: int = 5, rel: float = 0.005, absolute: float = 0.01) -> DataFrame:
    """(field, order, first, second): up to n rows of each field on which two sources differ, the first by ``order``."""
    told = F.array(*(F.struct(F.lit(f).alias("field"), F.col(a).cast("double").alias("first"), F.col(b).cast("double").alias("second"), agreement(F.col(a), F.col(b), close(F.col(a), F.col(b), rel, absolute)).alias("class")) for f, (a, b) in pairs.items()))
    apart = rows.select(*order, F.explode(told).alias("x")).where("x.class = 'disagree'").select("x.field", *order, "x.first", "x.second")
    return first_n(apart, ["field"], order, n)
