"""Durations and run recommendations as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and German wording of the recommendations.
MANY_RETRIES = 3
EFFECTIVE_RETRIES = 2
RATIO_HIGH = 1.5
RATIO_LOW = 0.3
MANY_RESIDUES = 10
MANY_CALLS = 200
MANY_TOKENS = 500_000
SEPARATOR = " | "
WORDING = {
    "left": "%s Deutsch-Reste nach %s Retry(s) verblieben",
    "retries": "Hohe Retry-Anzahl (%s) — Prompt oder Modell pruefen",
    "ratio_high": "Output/Input-Verhaeltnis hoch (%sx) — ungewoehnlich viele Tokens in Antwort",
    "ratio_low": "Output/Input-Verhaeltnis niedrig (%sx) — moeglicherweise gekuerzte Antworten",
    "technical_none": "Keine Auffaelligkeiten",
    "many_left": "Viele Reste — Prompt-Anweisung fuer Vollstaendigkeit verstaerken",
    "no_progress": "Retries haben keine Verbesserung gebracht — Prompt oder Modell wechseln",
    "prompt_none": "Keine Anpassungen noetig",
    "calls": "%s API-Calls — Batchgroesse erhoehen fuer weniger Aufrufe",
    "effective": "Retries wirksam (%s -> %s Reste) — max_retry beibehalten",
    "pipeline_none": "Pipeline laeuft stabil",
    "rerun": "Sprache %s erneut ausfuehren oder %s Reste manuell pruefen",
    "perfect": "Perfektes Ergebnis — keine Nacharbeit noetig",
    "fine": "Ergebnis OK nach %s Retry(s) — stichprobenartig pruefen",
    "tokens": "Hoher Tokenverbrauch (%s) — ggf. guenstigeres Modell testen",
    "next_none": "Standardlauf empfohlen",
}
RECOMMENDATION_COLUMNS = (
    "Technische_Auffaelligkeiten",
    "Anpassungen_am_Prompt",
    "Anpassungen_an_Pipeline",
    "Empfehlung_naechster_Lauf",
)


def duration_text(seconds: Column) -> Column:
    """``XmYYs`` with unlimited minutes; NULL stays NULL."""
    whole = F.floor(seconds).cast("bigint")
    return F.when(seconds.isNotNull(), F.format_string("%dm%02ds", F.floor(whole / 60).cast("bigint"), whole % 60))


def one_decimal(x: Column) -> Column:
    """A non-negative double with one decimal, rounded on its exact binary value, ties to even."""
    tenths = F.floor(x * 10).cast("bigint")
    # Sign of 20x - (2*tenths + 1), that is on which side of the tie x lies; 20x is kept exact as
    # a rounded sum and its rounding error.
    total = x * 16 + x * 4
    error = x * 4 - (total - x * 16)
    side = (total - (2 * tenths + 1)) + error
    up = (side > 0) | ((side == 0) & (tenths % 2 == 1))
    rounded = tenths + up.cast("bigint")
    return F.concat(F.floor(rounded / 10).cast("string"), F.lit("."), (rounded % 10).cast("string"))


def _joined(default: str, *hints: Column) -> Column:
    text = F.concat_ws(SEPARATOR, *hints)
    return F.when(text == "", WORDING[default]).otherwise(text)


def recommendations(
    lang: Column, left: Column, first: Column, retries: Column, calls: Column, tokens_in: Column, tokens_out: Column
) -> dict[str, Column]:
    """The four recommendation texts of a run, keyed by protocol column."""
    has_ratio = (tokens_in > 0) & (tokens_out > 0)
    ratio = F.when(has_ratio, tokens_out / tokens_in)
    shown = one_decimal(ratio)
    tokens = tokens_in + tokens_out
    technical = _joined(
        "technical_none",
        F.when(left > 0, F.format_string(WORDING["left"], left, retries)),
        F.when(retries >= MANY_RETRIES, F.format_string(WORDING["retries"], retries)),
        F.when(ratio > RATIO_HIGH, F.format_string(WORDING["ratio_high"], shown)),
        F.when(ratio < RATIO_LOW, F.format_string(WORDING["ratio_low"], shown)),
    )
    prompt = _joined(
        "prompt_none",
        F.when(left > MANY_RESIDUES, F.lit(WORDING["many_left"])),
        F.when((first > 0) & (retries > 0) & (left == first), F.lit(WORDING["no_progress"])),
    )
    run = _joined(
        "pipeline_none",
        F.when(calls > MANY_CALLS, F.format_string(WORDING["calls"], calls)),
        F.when((retries >= EFFECTIVE_RETRIES) & (left < first), F.format_string(WORDING["effective"], first, left)),
    )
    following = _joined(
        "next_none",
        F.when(left > 0, F.format_string(WORDING["rerun"], lang, left)),
        F.when((left == 0) & (retries == 0), F.lit(WORDING["perfect"])).when(
            (left == 0) & (retries > 0), F.format_string(WORDING["fine"], retries)
        ),
        F.when(tokens > MANY_TOKENS, F.format_string(WORDING["tokens"], F.format_number(tokens, 0))),
    )
    return dict(zip(RECOMMENDATION_COLUMNS, (technical, prompt, run, following)))
