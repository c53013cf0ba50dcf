"""SQL fragments shared by the counterparts: the text rules restated for DuckDB."""

from __future__ import annotations

from glossweave.functions.report import WORDING
from glossweave.functions.text import GERMAN, WHITESPACE_POINTS

WHITESPACE = "(" + " || ".join(f"chr({p})" for p in WHITESPACE_POINTS) + ")"
_S = r"\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_CURLY = "(" + " || ".join(f"chr({p})" for p in (0x2BC, *range(0x2018, 0x2020))) + ")"
_STRAIGHT = "'" + "''" * 5 + '"' * 4 + "'"


def strip(x: str) -> str:
    return f"trim({x}, {WHITESPACE})"


def rule(v: str, abbr_max: int = 12) -> str:
    """First untranslatable rule of the stripped text ``v``."""
    return rf"""CASE
      WHEN {v} = '' THEN 'empty'
      WHEN length({v}) <= 2 THEN 'len2'
      WHEN regexp_full_match({v}, '[\p{{Nd}}{_S}.,/\-+%°]+') THEN 'numeric'
      WHEN regexp_full_match({v}, '[\p{{Nd}}{_S}.,]+[{_S}]*[€$£¥₹%°²³]+') THEN 'unit'
      WHEN length({v}) <= 5 THEN 'len5'
      WHEN regexp_full_match({v}, '[A-Za-z0-9_\-./]+') THEN 'code'
      WHEN regexp_matches({v}, '\A(https?://|www\.|[^@{_S}]+@[^@{_S}]+\.)') THEN 'url'
      WHEN regexp_full_match({v}, '[^\p{{L}}\p{{N}}]+') THEN 'punct'
      WHEN length({v}) <= {abbr_max} AND regexp_full_match({v}, '[A-Z0-9{_S}./\-&]+') THEN 'abbr'
    END"""


def repair(x: str) -> str:
    """Text repair without the misread-encoding part, which the tables do not need."""
    entities = x
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&amp;", "&")):
        entities = f"replace({entities}, '{entity}', '{char}')"
    plain = f"CASE WHEN contains({x}, '&') AND NOT contains({x}, '<') THEN {entities} ELSE {x} END"
    straight = f"translate({plain}, {_CURLY}, {_STRAIGHT})"
    return rf"regexp_replace({straight}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g')"


def normalise(x: str) -> str:
    lines = f"replace(replace({repair(x)}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    return strip(rf"regexp_replace(regexp_replace({lines}, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")


def residue(x: str) -> str:
    low = f"lower({x})"
    parts = [f"CASE WHEN regexp_matches({x}, '[{GERMAN.letters}]') THEN 2e0 ELSE 0e0 END"]
    parts += [
        rf"CASE WHEN regexp_matches({low}, '(^|[^\p{{L}}\p{{N}}_]){w}([^\p{{L}}\p{{N}}_]|$)') THEN 1e0 ELSE 0e0 END"
        for w in GERMAN.words
    ]
    parts += [f"CASE WHEN contains({low}, '{p}') THEN 0.5e0 ELSE 0e0 END" for p in GERMAN.fragments]
    return f"(({' + '.join(parts)}) / greatest(1e0, least(20e0, length({low}) / 20e0)))"


# Lines of documents as cells.
CELLS = """cells AS (
  SELECT doc_id * 10000000 + p - 1 AS row_id, doc_id, p - 1 AS pos, value, lang AS doc_lang
  FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS value,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS p FROM documents))"""

# Stripped cells with the rule of the pool strategy; MATERIALIZED keeps DuckDB from repeating the patterns.
RULED = f"{CELLS}, ruled AS MATERIALIZED (SELECT *, {rule('v')} AS rule FROM (SELECT *, {strip('value')} AS v FROM cells))"

POOL = f"""{RULED}, normed AS MATERIALIZED (
  SELECT row_id, doc_id, doc_lang, value, {normalise('value')} AS text_norm FROM ruled WHERE rule IS NULL),
pool AS (
  SELECT text_norm, 0 AS first_col, min(row_id) AS first_row, count(*) AS n_cells
  FROM normed WHERE text_norm <> '' GROUP BY text_norm)"""

# Texts of an earlier run: the lines of labelled documents.
EARLIER = "earlier AS (SELECT DISTINCT text_norm FROM normed WHERE text_norm <> '' AND doc_id IN (SELECT doc_id FROM labels))"


def languages(*langs: str) -> str:
    return "(VALUES " + ", ".join(f"('{x}')" for x in langs) + ") AS l(lang)"


def key(lang: str, text: str, model: str = "m1", rules_id: str = "r1") -> str:
    return f"sha256({lang} || '|{model}|{rules_id}|' || {text})"


def wording(name: str, *values: str) -> str:
    """One recommendation text with SQL values for its gaps."""
    pieces = WORDING[name].split("%s")
    quoted = [f"'{p}'" for p in pieces]
    parts = [quoted[0]]
    for value, piece in zip(values, quoted[1:]):
        parts += [f"({value})::VARCHAR", piece]
    return " || ".join(parts)
