"""One query text for Spark and for the oracle: the few spellings in which the two engines differ.

``@table`` names an input table, ``$name`` a shared relation (a common table expression of ``RELATIONS``), ``/~`` integer
division, ``R(x)`` a value rounded for output, ``RANGE(n, c)`` a relation of 0..n-1 in column ``c``.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: Shared relations; time is in hours from ORIGIN_US.
ORIGIN_US = 1704067200000000
RELATIONS = {
    "ev": f"ev AS (SELECT event_id, user_id AS track_id, event_type AS stem, value AS v, US(ts) AS us, (US(ts) - {ORIGIN_US}) / 3.6e9 AS t FROM @events)",
    "fr": "fr AS (SELECT *, CAST(row_number() OVER (PARTITION BY track_id, stem ORDER BY us, event_id) - 1 AS BIGINT) AS i FROM ev)",
    "mx": "mx AS (SELECT *, CAST(row_number() OVER (PARTITION BY track_id ORDER BY us, event_id) - 1 AS BIGINT) AS i FROM ev)",
    "tr": "tr AS (SELECT DISTINCT track_id, 90 + track_id % 60 AS bpm FROM ev)",
    "st": "st AS (SELECT DISTINCT track_id, CAST(least(floor(t / 11.25), 63) AS BIGINT) AS slot, CASE stem WHEN 'click' THEN 'kick' WHEN 'purchase' THEN 'snare' WHEN 'view' THEN 'hihat' WHEN 'signup' THEN 'clap' ELSE 'vocal' END AS label FROM ev)",
    "sl": "sl AS (SELECT track_id, slot, slot /~ 16 AS bar, slot % 16 AS step FROM (SELECT DISTINCT track_id FROM ev) CROSS JOIN (RANGE(64, slot)))",
    "sf": "sf AS (SELECT sl.track_id, sl.slot, sl.bar, sl.step, count_if(st.label = 'kick') AS kick, count_if(st.label = 'snare') AS snare, count_if(st.label = 'hihat') AS hat, count(st.label) AS n FROM sl LEFT JOIN st ON sl.track_id = st.track_id AND sl.slot = st.slot GROUP BY sl.track_id, sl.slot, sl.bar, sl.step)",
}
#: Relations that a relation needs before it.
NEEDS = {"fr": ["ev"], "mx": ["ev"], "tr": ["ev"], "st": ["ev"], "sl": ["ev"], "sf": ["ev", "st", "sl"]}


def _expand(text: str) -> str:
    done: list[str] = []

    def want(name: str) -> str:
        out = [x for n in [*NEEDS.get(name, []), name] if n not in done and not done.append(n) for x in [RELATIONS[n]]]
        return ", ".join(out)

    text = re.sub(r"\$(\w+)", lambda m: want(m[1]), text)
    text = re.sub(r",\s*,", ",", text)
    return re.sub(r"WITH\s*,", "WITH ", text)


def _counts(text: str) -> str:
    """count_if(x) -> count(CASE WHEN x THEN 1 END), a BIGINT in both engines."""
    while (at := text.find("count_if(")) >= 0:
        depth, k = 1, at + 9
        while depth:
            depth += {"(": 1, ")": -1}.get(text[k], 0)
            k += 1
        text = f"{text[:at]}count(CASE WHEN {text[at + 9 : k - 1]} THEN 1 END){text[k:]}"
    return text


def _common(text: str) -> str:
    text = _counts(text)
    text = re.sub(r"(?<![\w.'])(\d+\.\d+)(?![\w.'])", r"\1e0", text)  # doubles, not decimals
    return re.sub(r"\bR\(", "(0e0 + ROUND6(", text)


def _close_rounds(text: str) -> str:
    """ROUND6(x) -> round(x, 6)) with the parenthesis that ``R(`` opened; the offset takes exact halves off the edge."""
    while (at := text.find("ROUND6(")) >= 0:
        depth, k = 1, at + 7
        while depth:
            depth += {"(": 1, ")": -1}.get(text[k], 0)
            k += 1
        text = f"{text[:at]}round({text[at + 7 : k - 1]} + 1.7e-10, 6)){text[k:]}"
    return text


def oracle_text(text: str) -> str:
    text = _close_rounds(_common(_expand(text)))
    text = re.sub(r"RANGE\((\d+), (\w+)\)", r"SELECT unnest(range(\1)) AS \2", text)
    text = re.sub(r"\bUS\(", "epoch_us(", text).replace("/~", "//")
    text = re.sub(r"PCT\(", "quantile_cont(", text)
    return re.sub(r"@(\w+)", r"\1", text)


def spark_text(text: str) -> str:
    text = _close_rounds(_common(_expand(text)))
    text = re.sub(r"RANGE\((\d+), (\w+)\)", r"SELECT id AS \2 FROM range(\1)", text)
    text = re.sub(r"\bUS\((\w+)\)", r"unix_micros(CAST(\1 AS TIMESTAMP))", text).replace("/~", " div ")
    text = re.sub(r"PCT\(", "percentile(", text)
    return re.sub(r"@(\w+)", r"{\1}", text.replace("{", "{{").replace("}", "}}"))


def query(text: str, spark_only: str | None = None) -> Callable[[SparkSession, str], DataFrame]:
    body = spark_text(spark_only or text)
    tables = [t for t in TABLES if f"{{{t}}}" in body]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(body, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})

    return run
