"""I-Match document fingerprints, in DataFrame functions only.

The lexicon is the band of terms whose inverse document frequency is neither small (function words) nor large (typing
errors, names). A document's distinct terms of the lexicon are sorted, and for each of several random subsets of the
lexicon those inside it are hashed. Texts that differ in few terms agree in the subsets that hold none of these.

A subset that holds many of a text's terms changes with nearly any edit, so a long text reads thinner subsets: each
subset exists at several levels, every one half of the level below it. The level is chosen by the number of distinct
terms, and the next level is read too, so that texts of about the same number of terms share a level.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.llm.common import filled
from glossweave.operators.ordering import ordered_positions
from glossweave.session import materialise

#: Lexicon: terms with ln(documents / documents with the term) in this band, ends included. A text of d distinct terms
#: has at most d of them, so there are at most e^7 = 1,097 times the mean of d in the lexicon, whatever the table holds.
IDF_BAND = (4.0, 7.0)
#: Random subsets of the lexicon. The first eight hexadecimal digits of a term's SHA-256 decide up to which level it is
#: read; of those read, a subset holds the terms whose digit of its own is 0 or 1, an eighth.
SUBSETS = 16
#: A text of 2^(n - 1) to 2^n distinct terms is read at level n - FIRST, at 0 if that is smaller.
FIRST = 5
#: Levels end here, for texts of 2^26 distinct terms.
LAST = 20
#: Characters of a subset's hash.
DIGITS = 8
#: The lexicon is broadcast up to this many terms (below 100 bytes each) and joined by a shuffle beyond.
BROADCAST_TERMS = 200_000

_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def distinct_terms(text: Column) -> Column:
    """The different runs of letters and digits of a text, lower-cased (every code point beyond ASCII is a letter)."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), _BETWEEN)), "")


def level_of(terms: Column) -> Column:
    """The level at which a text of these distinct terms is read."""
    return F.least(F.greatest(F.length(F.bin(F.size(terms).cast("bigint"))) - FIRST, F.lit(0)), F.lit(LAST)).cast("int")


def below(level: Column) -> Column:
    """The SHA-256 of a term that is read at a level is smaller than this; at level 0 every term is read."""
    return F.when(level == 0, "g").otherwise(F.lpad(F.lower(F.hex(F.pow(F.lit(2.0), 32 - level).cast("bigint"))), 8, "0"))


def lexicon(texts: DataFrame, band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """(``term``): the terms of column ``text`` whose inverse document frequency is in the band."""
    total = texts.count()
    counted = texts.select(F.explode(distinct_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return counted.filter(F.log(F.lit(float(total)) / F.col("df")).between(*band)).select("term")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once a row, wherever ``use`` repeats it."""
    return F.transform(F.array(value), use)[0]


def read_terms(terms: Column, level: Column) -> Column:
    """The terms read at a level, as an array."""
    return _once(below(level), lambda bound: F.filter(terms, lambda t: F.sha2(t, 256) < bound))


def subset_hashes(terms: Column, level: Column) -> Column:
    """The hash of each subset of sorted lexicon terms at a level and at the next; ``-`` where it holds none of them."""
    bits = F.transform(terms, lambda t: F.struct(t.alias("term"), F.sha2(t, 256).alias("bits")))

    def subsets(some: Column) -> Column:
        return F.transform(F.array(*[F.lit(9 + n) for n in range(SUBSETS)]), lambda place: subset(some, place))

    def subset(some: Column, place: Column) -> Column:
        inside = F.filter(some, lambda t: F.substring(t["bits"], place, F.lit(1)) < "2")
        return F.array_join(F.transform(inside, lambda t: t["term"]), " ")

    def levels(bits: Column) -> Column:
        thinner = _once(below(level + 1), lambda bound: F.filter(bits, lambda t: t["bits"] < bound))
        return F.flatten(F.transform(F.array(bits, thinner), subsets))

    return F.transform(_once(bits, levels), lambda s: F.when(s == "", "-").otherwise(F.substring(F.sha2(s, 256), 1, DIGITS)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal subset hashes among those that either text has, over the levels that both texts have; 0 to 1.

    Equal fingerprints have 1; those without subsets only equal themselves.
    """

    def read(print_: Column) -> Column:
        parts = F.split(print_, ":")
        return F.struct(parts[0].try_cast("int").alias("level"), F.split(F.get(parts, F.lit(1)), ",").alias("hashes"))

    def rate(side: Column, at: Column) -> Column:
        return F.slice(side["hashes"], (at - side["level"]) * SUBSETS + 1, F.lit(SUBSETS))

    def share(both: Column) -> Column:
        x, y = both["a"], both["b"]
        low, high = F.greatest(x["level"], y["level"]), F.least(x["level"], y["level"]) + 1
        pairs = F.flatten(F.transform(F.sequence(low, high), lambda at: F.arrays_zip(rate(x, at).alias("a"), rate(y, at).alias("b"))))
        told = F.filter(pairs, lambda p: (p["a"] != "-") | (p["b"] != "-"))
        # Without a level on either side, or with rates that do not meet: nothing in common.
        apart = x["level"].isNull() | y["level"].isNull() | (low > high)
        return F.when(apart, 0.0).otherwise(_once(told, equal_share))

    def equal_share(told: Column) -> Column:
        return F.size(F.filter(told, lambda p: p["a"] == p["b"])) / F.greatest(F.size(told), F.lit(1))

    return F.when(a == b, 1.0).otherwise(_once(F.struct(read(a).alias("a"), read(b).alias("b")), share)).cast("double")


def neighbours(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's text and its edited text: ``absent``, ``key``, ``h``, ``pos``, ``copies``, ``n_chars``, ``text``, ``edited``.

    ``edited`` is the text with its last quarter replaced by the start of the next text, by ascending id, the first
    after the last. Only ids, lengths and hashes are sorted; texts move once by their key, and quarters once more.
    Rows that repeat an id and a text share a position.
    """
    rows = docs.select(F.col(f"`{ident}`").alias("id"), filled(F.col(f"`{text}`")).alias("text"))
    blank = F.lit("0").cast(rows.schema["id"].dataType)
    rows = rows.select(F.col("id").isNull().alias("absent"), F.coalesce("id", blank).alias("key"), F.xxhash64("text").alias("h"), "text")
    name = ["absent", "key", "h"]
    short = rows.select(*name, F.char_length("text").cast("bigint").alias("n_chars")).groupBy(*name, "n_chars")
    short = short.agg(F.count("*").alias("copies")).withColumn("given", ~F.col("absent"))
    placed = ordered_positions(short, [], ["given", "key", "h"]).drop("given")
    placed = materialise(placed.withColumn("pos", F.col("pos").cast("bigint")), "order")
    total = max(1, placed.count())
    before = placed.select(
        ((F.col("pos") + 1) % total).alias("pos"), F.floor(F.col("n_chars") / 4).alias("n_head"), *[F.col(c).alias(f"to_{c}") for c in name]
    )
    order = materialise(placed.join(before, "pos"), "neighbours")

    texts = rows.join(order, name)
    heads = texts.select(*[F.col(f"to_{c}").alias(c) for c in name], F.expr("substring(text, 1, n_head)").alias("head"))
    heads = heads.groupBy(*name).agg(F.max("head").alias("head"))
    own = F.expr("substring(text, 1, n_chars - floor(n_chars / 4))")
    return texts.join(heads, name).select(*name, "pos", "copies", "n_chars", "text", F.concat(own, F.col("head")).alias("edited"))


def document_fingerprints(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(``ident``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``).

    A fingerprint is ``level:hashes``; without a lexicon term in a subset it is ``*:`` and a hash of all terms, without
    any term empty. NULL texts are empty. NULL ids come first in the order, rows that repeat an id by a hash of their
    text; rows that repeat id and text have one place in it and equal results. An empty table gives no row, further
    columns are not read. The only text of a table is its own next one.
    """
    words = materialise(lexicon(docs.select(filled(F.col(f"`{text}`")).alias("text"))), "lexicon")
    words = F.broadcast(words) if words.count() <= BROADCAST_TERMS else words
    texts = neighbours(docs, ident, text)

    keys = ["absent", "key", "h", "is_edited"]
    sides = F.array(
        F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("side")), F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("side"))
    )
    both = texts.select("absent", "key", "h", "pos", "copies", "n_chars", F.inline(sides))
    both = both.select(*keys, "pos", "copies", "n_chars", F.when(F.col("is_edited"), F.sha2("side", 256)).alias("sha"), distinct_terms(F.col("side")).alias("terms"))
    plain = F.when(F.size("terms") > 0, F.concat(F.lit("*:"), F.md5(F.array_join(F.array_sort("terms"), " ")))).otherwise("")
    info = F.struct("pos", "copies", "n_chars", "sha", plain.alias("plain"), level_of(F.col("terms")).alias("level"))
    both = both.select(*keys, info.alias("info"), read_terms(F.col("terms"), level_of(F.col("terms"))).alias("terms"))
    # The terms of a text stay in its task; what is known of the text goes with the first of them only.
    named = both.select(*keys, "info", F.posexplode_outer("terms").alias("i", "term"))
    named = named.select(*keys, F.when(F.coalesce("i", F.lit(0)) == 0, F.col("info")).alias("info"), "term")
    known = words.withColumn("known", F.lit(True))
    found = named.join(known, "term", "left").groupBy(*keys).agg(
        F.first("info", ignorenulls=True).alias("info"), F.collect_set(F.when(F.col("known"), F.col("term"))).alias("terms")
    )
    found = found.select(*keys, "info.*", subset_hashes(F.array_sort("terms"), F.col("info.level")).alias("hashes"))
    made = F.concat(F.col("level").cast("string"), F.lit(":"), F.array_join("hashes", ","))
    empty = F.forall("hashes", lambda x: x == "-")
    prints = found.select("absent", "key", "h", "pos", "copies", "n_chars", "is_edited", "sha", F.when(empty, F.col("plain")).otherwise(made).alias("print"))
    rows = prints.groupBy("absent", "key", "h", "pos", "copies", "n_chars").agg(
        F.max("sha").alias("edited_sha256"),
        F.max(F.when(~F.col("is_edited"), F.col("print"))).alias("fingerprint"),
        F.max(F.when(F.col("is_edited"), F.col("print"))).alias("edited_fingerprint"),
    )
    rows = materialise(rows, "fingerprints")
    total = max(1, rows.count())
    following = rows.select(((F.col("pos") + total - 1) % total).alias("pos"), F.col("fingerprint").alias("next_print"))
    every = rows.join(following, "pos").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return every.select(
        F.when(~F.col("absent"), F.col("key")).alias(ident),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
    )


def _sql_terms(text: str) -> str:
    return f"list_filter(list_distinct(string_split_regex(lower({text}), '{_BETWEEN}')), lambda x: x <> '')"


def _sql_near(a: str, b: str) -> str:
    low, high = f"greatest({a}.level, {b}.level)", f"least({a}.level, {b}.level) + 1"
    pairs = (
        f"flatten(list_transform(range({low}, {high} + 1), lambda rate: list_zip("
        f"list_slice({a}.hashes, (rate - {a}.level) * {SUBSETS} + 1, (rate - {a}.level + 1) * {SUBSETS}), "
        f"list_slice({b}.hashes, (rate - {b}.level) * {SUBSETS} + 1, (rate - {b}.level + 1) * {SUBSETS}))))"
    )
    told = f"list_filter({pairs}, lambda p: p[1] <> '-' OR p[2] <> '-')"
    return (
        f"CAST(CASE WHEN {a}.print = {b}.print THEN 1 WHEN {a}.level IS NULL OR {b}.level IS NULL OR {low} > {high} THEN 0 "
        f"WHEN len({told}) = 0 THEN 0 ELSE len(list_filter({told}, lambda p: p[1] = p[2])) / len({told}) END AS DOUBLE)"
    )


def _sql_below(level: str) -> str:
    return f"CASE WHEN {level} = 0 THEN 'g' ELSE lpad(lower(hex(CAST(4294967296 // (1 << ({level})) AS BIGINT))), 8, '0') END"


FINGERPRINTS_SQL = f"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
placed AS (
  SELECT doc_id, text, length(text) AS n, coalesce(lead(text) OVER w, first_value(text) OVER w) AS following,
    coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id
  FROM base WINDOW w AS (ORDER BY doc_id)
), both_texts AS (
  SELECT doc_id, false AS is_edited, text FROM placed
  UNION ALL
  SELECT doc_id, true, substr(text, 1, n - n // 4) || substr(following, 1, n // 4) FROM placed
), termed AS MATERIALIZED (
  SELECT *, least(greatest(length(bin(len(terms))) - {FIRST}, 0), {LAST}) AS level
  FROM (SELECT doc_id, is_edited, {_sql_terms("text")} AS terms FROM both_texts) AS t
), lexicon AS MATERIALIZED (
  SELECT term FROM (SELECT unnest(terms) AS term FROM termed WHERE NOT is_edited) AS u GROUP BY term
  HAVING ln((SELECT count(*) FROM documents) / count(*)) BETWEEN {IDF_BAND[0]} AND {IDF_BAND[1]}
), read_terms AS (
  SELECT doc_id, is_edited, level, u.term, sha256(u.term) AS bits
  FROM (SELECT doc_id, is_edited, level, unnest(terms) AS term FROM termed) AS u JOIN lexicon AS l ON l.term = u.term
  WHERE sha256(u.term) < {_sql_below("level")}
), hashed AS (
  SELECT doc_id, is_edited, rate - level AS more, g, substr(sha256(string_agg(term, ' ' ORDER BY term)), 1, {DIGITS}) AS hash
  FROM (SELECT *, unnest(range({SUBSETS})) AS g FROM (SELECT *, unnest([level, level + 1]) AS rate FROM read_terms) AS r) AS s
  WHERE bits < {_sql_below("rate")} AND substr(bits, 9 + g, 1) < '2' GROUP BY doc_id, is_edited, more, g
), prints AS (
  SELECT t.doc_id, t.is_edited, any_value(t.level) AS level, count(h.hash) AS n, list(coalesce(h.hash, '-') ORDER BY p.more, p.g) AS hashes,
    any_value(CASE WHEN len(terms) = 0 THEN '' ELSE '*:' || md5(array_to_string(list_sort(terms), ' ')) END) AS plain
  FROM termed AS t CROSS JOIN (SELECT more, unnest(range({SUBSETS})) AS g FROM (VALUES (0), (1)) AS v(more)) AS p
  LEFT JOIN hashed AS h ON h.doc_id = t.doc_id AND h.is_edited = t.is_edited AND h.more = p.more AND h.g = p.g
  GROUP BY t.doc_id, t.is_edited
), named AS MATERIALIZED (
  SELECT doc_id, is_edited, hashes, CASE WHEN n > 0 THEN level END AS level,
    CASE WHEN n = 0 THEN plain ELSE level || ':' || array_to_string(hashes, ',') END AS print FROM prints
)
SELECT p.doc_id, p.n AS n_chars, sha256(e.text) AS edited_sha256, o.print AS fingerprint, x.print AS edited_fingerprint,
  {_sql_near("o", "x")} AS near_edited, {_sql_near("o", "f")} AS near_next
FROM placed AS p JOIN both_texts AS e ON e.doc_id = p.doc_id AND e.is_edited
JOIN named AS o ON o.doc_id = p.doc_id AND NOT o.is_edited JOIN named AS x ON x.doc_id = p.doc_id AND x.is_edited
JOIN named AS f ON f.doc_id = p.next_id AND NOT f.is_edited
"""
