"""Data-driven predicates: rule tables of (group, style, feature, op, value, mode) over features.

A rule whose feature is missing or null, or whose op is unknown, is false.  A style matches if all of
its rules hold.  ``match_long`` joins rules as data (any number of rules, changed without a new
plan); ``match_compiled`` turns a small rule set into one predicate per style, which stays in code generation.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULE_SCHEMA = "style_group string, style string, feature string, op string, value double, mode string"
OPS = {">": lambda a, b: a > b, "<": lambda a, b: a < b, ">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, "==": lambda a, b: a == b}

_STEMS = ("drums", "bass", "other", "vocals", "guitar", "piano")
#: The style rules (group, style, feature, op, value); truth values as 1.
STYLE_RULES: list[tuple[str, str, str, str, float]] = [
    *[("pre", "silence-entry", f"mean_energy_{s}", "<", 0.01) for s in _STEMS],
    *[("pre", "ramp", f"slope_{s}", ">", 0.001) for s in _STEMS],
    ("pre", "pickup-vocal", "pickup_like", "==", 1),
    ("pre", "hard-start", "first_downbeat_s", "<", 0.5),
    ("pre", "breath-entry", "mean_energy_drums", "<", 0.01),
    ("pre", "breath-entry", "energy_jump_vocals", ">", 0.05),
    ("pre", "rubato-rise", "flatness_score_drums", ">", 0.01),
    ("pre", "rubato-rise", "flatness_score_vocals", ">", 0.01),
    ("pre", "crescendo-drop", "slope_other", ">", 0.001),
    ("pre", "crescendo-drop", "tail_energy_other", "<", 0.05),
    ("post", "full-groove", "post_mean_energy_drums", ">", 0.05),
    ("post", "full-groove", "post_mean_energy_bass", ">", 0.05),
    ("post", "full-groove", "post_mean_energy_other", ">", 0.01),
    ("post", "full-groove", "post_abs_slope_drums", "<", 0.001),
    ("post", "vocal-loop", "post_mean_energy_vocals", ">", 0.05),
    ("post", "vocal-loop", "post_spike_count_vocals", ">=", 2),
    ("post", "instrumental-loop", "post_mean_energy_vocals", "<", 0.02),
    ("post", "instrumental-loop", "post_mean_energy_drums", ">", 0.05),
    ("post", "instrumental-loop", "post_mean_energy_bass", ">", 0.05),
    ("post", "instrumental-loop", "post_mean_energy_other", ">", 0.05),
    ("post", "lowpass-loop", "post_mean_energy_bass", "<", 0.03),
    ("post", "lowpass-loop", "post_slope_other", ">", 0.001),
    ("post", "filtered-loop", "post_highpass_like", "==", 1),
    ("post", "static-loop", "post_abs_slope_drums", "<", 0.001),
    ("post", "static-loop", "post_spike_count_drums", "<=", 1),
    ("post", "syncopated-loop", "post_offgrid_like", "==", 1),
    ("crossover", "fill", "spike_count_drums", ">=", 3),
    ("crossover", "fill", "spike_density_drums", ">", 0.08),
    ("crossover", "dry-beat-entry", "mean_energy_drums", "<", 0.03),
    ("crossover", "dry-beat-entry", "energy_jump_drums", ">", 0.1),
    ("crossover", "dry-beat-entry", "mean_energy_vocals", "<", 0.05),
    ("crossover", "mid-energy-loop", "abs_slope_drums", "<", 0.001),
    ("crossover", "mid-energy-loop", "spike_count_drums", "<=", 2),
    ("crossover", "mid-energy-loop", "spike_count_vocals", "<=", 0),
    ("crossover", "lowpass-ramp", "slope_other", ">", 0.001),
    ("crossover", "lowpass-ramp", "mean_energy_bass", "<", 0.05),
    ("crossover", "highpass-ramp", "highpass_like", "==", 1),
    ("crossover", "rubato-rise", "flatness_score_drums", ">", 0.01),
    ("crossover", "rubato-rise", "flatness_score_vocals", ">", 0.01),
]

_ALL_RAMP = [("pre", "ramp", f"slope_{s}", ">", 0.001) for s in _STEMS]
#: The first edition of the style rules, where it departs from the later one.
STYLE_RULES_V1: list[tuple[str, str, str, str, float]] = [
    *[r for r in STYLE_RULES if r[:2] == ("pre", "silence-entry")],
    *_ALL_RAMP,
    ("pre", "vocal-pickup", "pickup_like", "==", 1),
    *[r for r in STYLE_RULES if r[0] == "pre" and r[1] in ("hard-start", "breath-entry", "rubato-rise", "crescendo-drop")],
    ("pre", "phrase-gap", "vocal_valley_count", ">=", 2),
    *[r for r in STYLE_RULES if r[0] == "post" and r[1] in ("vocal-loop", "instrumental-loop", "lowpass-loop", "filtered-loop", "static-loop", "syncopated-loop")],
    ("post", "full-groove", "post_mean_energy_drums", ">", 0.05),
    ("post", "full-groove", "post_mean_energy_bass", ">", 0.05),
    ("post", "full-groove", "post_mean_energy_other", ">", 0.05),
    ("post", "full-groove", "post_abs_slope_drums", "<", 0.001),
    *[r for r in STYLE_RULES if r[0] == "crossover" and r[:3] != ("crossover", "dry-beat-entry", "mean_energy_vocals")],
]


def rule_table(spark: SparkSession, rules: Iterable[tuple] = STYLE_RULES) -> DataFrame:
    return spark.createDataFrame([(*r[:4], float(r[4]), r[5] if len(r) > 5 else None) for r in rules], RULE_SCHEMA)


def holds(value: Column, op: Column, bound: Column, mode: Column | None = None) -> Column:
    """The predicate of a rule row; mode 'pct' compares hundredths."""
    v = value if mode is None else F.when(mode == "pct", value * 100).otherwise(value)
    out = F.lit(False)
    for name, compare in OPS.items():
        out = F.when(op == name, compare(v, bound)).otherwise(out)
    return F.coalesce(out, F.lit(False))


def match_long(features: DataFrame, rules: DataFrame, key: str = "track_id") -> DataFrame:
    """(key, style_group, style) that match; ``features`` has (key, feature, value).

    A style matches where as many of its rules hold as it has, so no entity meets rules of features it lacks.
    """
    r = rules.select("style_group", "style", "feature", "op", F.col("value").alias("bound"), "mode").distinct()
    need = r.groupBy("style_group", "style").agg(F.count(F.lit(1)).alias("need"))
    held = features.join(r, "feature").where(holds(F.col("value"), F.col("op"), F.col("bound"), F.col("mode")))
    got = held.groupBy(key, "style_group", "style").agg(F.count(F.lit(1)).alias("got"))
    return got.join(need, ["style_group", "style"]).where("got = need").select(key, "style_group", "style")


def match_compiled(wide: DataFrame, rules: Iterable[tuple] = STYLE_RULES, key: str = "track_id") -> DataFrame:
    """The same over wide features (a column each), by one conjunction per style."""
    styles: dict[tuple[str, str], list[Column]] = {}
    for group, style, feature, op, value, *mode in rules:
        column = F.col(feature).cast("double") if feature in wide.columns else F.lit(None).cast("double")
        column = column * 100 if mode and mode[0] == "pct" else column
        test = F.coalesce(OPS[op](column, F.lit(float(value))), F.lit(False)) if op in OPS else F.lit(False)
        styles.setdefault((group, style), []).append(test)
    found = [F.when(reduce(lambda a, b: a & b, tests), F.struct(F.lit(g).alias("style_group"), F.lit(s).alias("style"))) for (g, s), tests in styles.items()]
    return wide.select(key, F.explode(F.array_compact(F.array(*found))).alias("m")).select(key, "m.style_group", "m.style")


def features_used(rules: DataFrame) -> DataFrame:
    """Distinct features that some rule reads: what must be computed at all."""
    return rules.select("feature").distinct()


def split_feature(name: Column) -> tuple[Column, Column]:
    """(feature, stem) of a flat name; a name without stem has a null stem."""
    stem = F.element_at(F.split(name, "_"), -1)
    known = stem.isin(*_STEMS)
    return F.when(known, F.regexp_replace(name, "_[^_]*$", "")).otherwise(name), F.when(known, stem)
