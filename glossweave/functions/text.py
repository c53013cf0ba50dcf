"""Column expressions on cell text: strip, classify, repair, normalise, score, key.

All of them are built-in Spark expressions. "Strip" always means the Unicode strip, not ``trim``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as white space on both ends of a cell.
WHITESPACE_POINTS = (
    [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
    + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
WHITESPACE = "".join(map(chr, WHITESPACE_POINTS))

# The same set inside a Java character class (needs the (?U) flag).
_S = r"\s\x1c-\x1f"

# The patterns of the untranslatable-cell rules, in rule order, on stripped text.
NUMERIC = rf"(?U)\A[\d{_S}.,/\-+%°]+\z"
UNIT = rf"(?U)\A[\d{_S}.,]+[{_S}]*[€$£¥₹%°²³]+\z"
CODE = r"\A[A-Za-z0-9_\-./]+\z"
LINK = rf"(?U)\A(?:https?://|www\.|[^@{_S}]+@[^@{_S}]+\.)"
PUNCTUATION = r"\A[^\p{L}\p{N}]+\z"
ABBREVIATION = rf"(?U)\A[A-Z0-9{_S}./\-&]+\z"
ABBREVIATION_MAX_POOL = 12
ABBREVIATION_MAX_ROW = 10

# Unicode blocks expected in a translation, by target language.
TARGET_SCRIPTS = {"AR": "[؀-ۿ]", "RU": "[Ѐ-ӿ]", "UK": "[Ѐ-ӿ]"}

# Text repair.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
_CURLY = "ʼ‘’‚‛“”„‟"
_STRAIGHT = "'''''\"\"\"\""
_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
# Windows-1252 characters that stand for the bytes 0x80-0x9f when UTF-8 was read with that code page.
_CP1252_BYTES = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_CP1252_CHARS = bytes(_CP1252_BYTES).decode("cp1252")
_C1_CHARS = "".join(map(chr, _CP1252_BYTES))
SINGLE_BYTE = rf"\A[\x00-\xff{_CP1252_CHARS}]*\z"
LEAD_AND_TAIL = rf"[\xc2-\xf4][\x80-\xbf{_CP1252_CHARS}]"


@dataclass(frozen=True)
class ResidueMarkers:
    """What gives a source language away: letters, whole words and word fragments."""

    letters: str
    words: tuple[str, ...]
    fragments: tuple[str, ...]
    letter_weight: float = 2.0
    word_weight: float = 1.0
    fragment_weight: float = 0.5


# The German marker lists.
GERMAN = ResidueMarkers(
    letters="äöüÄÖÜß",
    words=(
        "der", "die", "das", "und", "nicht", "mit", "ein", "eine", "werden",
        "ist", "sind", "bei", "auf", "aus", "wie", "welche", "welcher", "welches",
    ),
    fragments=("sch", "ung", "keit", "lich", "über", "für", "zum", "zur"),
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def non_blank(text: Column) -> Column:
    """True when something other than white space is left; stops at the first such character."""
    return F.coalesce(F.ltrim(text, F.lit(WHITESPACE)) != "", F.lit(False))


def rule_of_stripped(v: Column, abbr_max: int = ABBREVIATION_MAX_POOL) -> Column:
    """Name of the first rule that makes the stripped text ``v`` untranslatable, else NULL."""
    size = F.length(v)
    return (
        F.when(v.isNull() | (size == 0), "empty")
        .when(size <= 2, "len2")
        .when(v.rlike(NUMERIC), "numeric")
        .when(v.rlike(UNIT), "unit")
        .when(size <= 5, "len5")
        .when(v.rlike(CODE), "code")
        .when(v.rlike(LINK), "url")
        .when(v.rlike(PUNCTUATION), "punct")
        .when((size <= abbr_max) & v.rlike(ABBREVIATION), "abbr")
    )


def untranslatable_rule(text: Column, abbr_max: int = ABBREVIATION_MAX_POOL) -> Column:
    return rule_of_stripped(strip(text), abbr_max)


def translatable_stripped(v: Column, abbr_max: int = ABBREVIATION_MAX_POOL) -> Column:
    """Whether no rule matches the stripped text ``v``: the same rules as one pattern, read once."""
    def body(pattern: str) -> str:
        return pattern.removeprefix("(?U)").removeprefix(r"\A")

    short_caps = body(ABBREVIATION).replace("]+", f"]{{1,{abbr_max}}}")
    patterns = [*map(body, (NUMERIC, UNIT, CODE, LINK, PUNCTUATION)), short_caps]
    return (F.length(v) > 5) & ~v.rlike(rf"(?U)\A(?:{'|'.join(patterns)})")


def is_translatable(text: Column, abbr_max: int = ABBREVIATION_MAX_POOL) -> Column:
    return translatable_stripped(strip(text), abbr_max)


def undo_mojibake(text: Column) -> Column:
    """Undo UTF-8 that was read as Latin-1 or Windows-1252, when the whole text allows it."""
    as_bytes = F.encode(F.translate(text, _CP1252_CHARS, _C1_CHARS), "ISO-8859-1")
    decoded = F.try_validate_utf8(as_bytes.cast("string"))
    return F.coalesce(F.when(text.rlike(LEAD_AND_TAIL) & text.rlike(SINGLE_BYTE), decoded), text)


def repair(text: Column) -> Column:
    """Bounded text repair: mojibake, the five XML entities, curly quotes, control characters.

    Entities are decoded once, and only in texts without markup. ``text`` should be a plain column:
    it is read several times.
    """
    readable = undo_mojibake(text)
    decoded = readable
    for entity, char in _ENTITIES:
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    fixed = F.when(text.contains("&") & ~text.contains("<"), decoded).otherwise(readable)
    return F.regexp_replace(F.translate(fixed, _CURLY, _STRAIGHT), _CONTROL, "")


def _needs_work(text: Column) -> Column:
    """Cheap test for everything that ``repair`` and the white-space rules could change."""
    single = "[\\x00-\\x09\\x0b-\\x1f\\x7f&ʼ‘-‟]"
    return text.rlike(single) | text.rlike(LEAD_AND_TAIL) | text.contains("  ") | text.contains("\n\n\n")


def normalise(text: Column) -> Column:
    """The form under which a text is pooled, keyed and sent.

    Most texts are clean already; they pass two scans and a strip instead of seven replacements.
    """
    source = F.coalesce(text, F.lit(""))
    t = repair(source)
    t = F.replace(F.replace(t, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    t = F.regexp_replace(t, "[ \\t]+", " ")
    t = F.regexp_replace(t, "\\n{3,}", "\n\n")
    return strip(F.when(_needs_work(source), t).otherwise(source))


def _damping(low: Column) -> Column:
    return F.greatest(F.lit(1.0), F.least(F.lit(20.0), F.length(low) / F.lit(20.0)))


def _weighted(found: list[Column], weight: float) -> Column:
    return sum((f.cast("int") for f in found[1:]), found[0].cast("int")) * F.lit(weight)


def _letters_and_fragments(raw: Column, low: Column, markers: ResidueMarkers) -> Column:
    letters = _weighted([raw.rlike(f"[{markers.letters}]")], markers.letter_weight)
    return letters + _weighted([low.contains(part) for part in markers.fragments], markers.fragment_weight)


def _word_candidates(low: Column, markers: ResidueMarkers) -> Column:
    """Marker words that occur at all, also inside other words: never fewer than the whole words."""
    return _weighted([low.contains(word) for word in markers.words], markers.word_weight)


def residue_score(text: Column, markers: ResidueMarkers = GERMAN) -> Column:
    """How much of the source language is left: marker presence, damped by length.

    Whole words are told apart by one pattern for all of them, and only in texts that hold one of
    the words as a substring. ``text`` should be a plain column: it is read several times.
    """
    raw = F.coalesce(text, F.lit(""))
    return _score(raw, F.lower(raw), markers)


def _score(raw: Column, low: Column, markers: ResidueMarkers) -> Column:
    longest_first = "|".join(sorted(markers.words, key=len, reverse=True))
    whole_words = F.lit(rf"(?<![\p{{L}}\p{{N}}_])({longest_first})(?![\p{{L}}\p{{N}}_])")
    distinct = F.size(F.array_distinct(F.regexp_extract_all(low, whole_words, F.lit(1)))) * F.lit(markers.word_weight)
    words = F.when(_word_candidates(low, markers) > 0, distinct).otherwise(F.lit(0.0))
    return (_letters_and_fragments(raw, low, markers) + words) / _damping(low)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row also inside a filter, where Spark shares no common parts."""
    return F.transform(F.array(value), use)[0]


def residue_at_least_once(text: Column, threshold: float, markers: ResidueMarkers = GERMAN) -> Column:
    """``residue_at_least`` for a filter: ``text`` and its lower case are computed once, whatever expression it is."""
    return _once(text, lambda raw: _once(F.lower(F.coalesce(raw, F.lit(""))), lambda low: _at_least(raw, low, threshold, markers)))


def residue_at_least(text: Column, threshold: float, markers: ResidueMarkers = GERMAN) -> Column:
    """The residue score where it reaches ``threshold``, else 0.0.

    Substring searches bound the score from above; nearly all translated texts stop there.
    """
    return _at_least(text, F.lower(F.coalesce(text, F.lit(""))), threshold, markers)


def _at_least(text: Column, low: Column, threshold: float, markers: ResidueMarkers) -> Column:
    raw = F.coalesce(text, F.lit(""))
    bound = (_letters_and_fragments(raw, low, markers) + _word_candidates(low, markers)) / _damping(low)
    score = _score(raw, low, markers)
    return F.when(bound >= threshold, F.when(score >= threshold, score).otherwise(F.lit(0.0))).otherwise(F.lit(0.0))


def expected_script(lang: Column, text: Column) -> Column:
    """False when the target language needs a script of which the text has no character."""
    check = F.when(~non_blank(text), True)
    for code, block in TARGET_SCRIPTS.items():
        check = check.when(F.upper(lang) == code, text.rlike(block))
    return check.otherwise(True)


def memory_key(lang: Column, model: Column, rules_id: Column, text_norm: Column) -> Column:
    bar = F.lit("|")
    return F.sha2(F.concat(lang, bar, model, bar, rules_id, bar, text_norm), 256)


def text_key(text_norm: Column) -> Column:
    """Language-independent key of a pooled text; one lookup with it serves all languages."""
    return F.sha2(text_norm, 256)
