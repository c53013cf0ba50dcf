"""Quality rules from the fertility of a public vocabulary.

Each text gets base counts and three figures of its tokens: characters per token, share of byte-fallback tokens and
entropy of the token distribution. Bands for these figures are taken per language and length class over the whole
table (quartiles, widened by a multiple of their distance), and a text outside a band is rejected.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.llm.common import TOKENIZERS, filled, text_bytes
from glossweave.session import materialise

MIN_WORDS = 50
MAX_REPEAT_SHARE = 50
#: Words kept by each Python worker; the table is dropped when it is full, results do not depend on it.
WORDS_KEPT = 250_000
#: Bands (about 100 bytes each) that are broadcast; more, of a table with very many languages, are joined by shuffling.
BROADCAST_BANDS = 50_000
SYMBOLS = b"#*$%&|<>"

FIELDS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("n_tokens", pa.int64()), ("byte_share", pa.float64()), ("chars_per_token", pa.float64()),
    ("token_entropy", pa.float64()), ("script", pa.string()),
]
FIELDS_DDL = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_tokens bigint, "
    "byte_share double, chars_per_token double, token_entropy double, script string"
)
#: First code point, last code point, name.
SCRIPTS = [
    (0x0041, 0x024F, "latin"), (0x0370, 0x03FF, "greek"), (0x0400, 0x052F, "cyrillic"), (0x0590, 0x05FF, "hebrew"),
    (0x0600, 0x06FF, "arabic"), (0x0900, 0x0DFF, "indic"), (0x0E00, 0x0EFF, "thai"), (0x3040, 0x30FF, "kana"),
    (0x4E00, 0x9FFF, "han"), (0xAC00, 0xD7AF, "hangul"),
]


class WordPieces:
    """Pieces of single words, remembered: words are numbered from 0 as they come."""

    def __init__(self, model: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model)
        self.is_byte = np.array([self.processor.is_byte(i) for i in range(self.processor.get_piece_size())])
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.pieces: list[bytes] = []

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word of one text."""
        if len(self.number) > WORDS_KEPT:
            self.clear()
        number = self.number
        if new := [w for w in dict.fromkeys(words) if w not in number]:
            for word, ids in zip(new, self.processor.encode([w.decode() for w in new], num_threads=1), strict=True):
                number[word] = len(self.pieces)
                self.pieces.append(np.asarray(ids, dtype="<i4").tobytes())
        return np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))


@lru_cache(maxsize=2)
def _word_pieces(model: str) -> WordPieces:
    return WordPieces(model)


def repeated_words(numbers: np.ndarray) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(numbers) < 4:
        return 0
    _, pair = np.unique(numbers[:-2] * (numbers.max() + 1) + numbers[1:-1], return_inverse=True)
    _, window, count = np.unique(pair * (numbers.max() + 1) + numbers[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    covered = np.zeros(len(numbers), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def entropy(ids: np.ndarray) -> float:
    """Bits per token of the text's own token distribution."""
    if not len(ids):
        return 0.0
    count = np.unique(ids, return_counts=True)[1]
    return float(np.log2(len(ids)) - (count * np.log2(count)).sum() / len(ids))


def script_of(data: bytes) -> str:
    """The script with most letters in a text."""
    points = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), dtype="<u4")
    count = [int(((points >= low) & (points <= high)).sum()) for low, high, _ in SCRIPTS]
    return SCRIPTS[int(np.argmax(count))][2] if any(count) else "none"


def measure(data: bytes, pieces: WordPieces) -> tuple:
    """The figures of ``FIELDS`` for one text."""
    words = data.split()
    raw = np.frombuffer(data, dtype=np.uint8)
    blank = np.count_nonzero((raw == 32) | ((raw >= 9) & (raw <= 13)))
    chars = int(np.count_nonzero((raw & 0xC0) != 0x80) - blank)
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    numbers = pieces.numbers(words)
    ids = np.frombuffer(b"".join([pieces.pieces[i] for i in numbers.tolist()]), dtype="<i4")
    share = float(pieces.is_byte[ids].mean()) if len(ids) else 0.0
    return (
        len(words), chars, sum(data.count(bytes([s])) for s in SYMBOLS), len(lines) - len(set(lines)), repeated_words(numbers),
        len(ids), share, chars / len(ids) if len(ids) else 0.0, entropy(ids), script_of(data),
    )


def text_figures(text: Column, model: str) -> Column:
    """A struct of ``FIELDS`` for a text column."""

    @F.arrow_udf(FIELDS_DDL_STRUCT)
    def figures(texts: pa.Array) -> pa.Array:
        pieces = _word_pieces(model)
        rows = [measure(data, pieces) for data in text_bytes(texts)]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in FIELDS]
        return pa.StructArray.from_arrays(
            [pa.array(c, type=t) for c, (_, t) in zip(columns, FIELDS, strict=True)], names=[n for n, _ in FIELDS]
        )

    return figures(text)


FIELDS_DDL_STRUCT = "struct<" + ", ".join(part.replace(" ", ":") for part in FIELDS_DDL.split(", ")) + ">"
BANDED = ("chars_per_token", "byte_share", "token_entropy")
#: Texts that pass the base rules which a class needs for bands of its own.
MIN_SUPPORT = 30
#: Figures are counted in steps of this many decimals, so a class has at most some 10,000 steps a unit whatever its size.
DECIMALS = 4
#: The classes that may judge a figure, the narrowest first. How much a text can repeat depends on its length, so entropy is
#: never judged by texts of other lengths; the other two depend on language and script.
LEVELS = {
    "chars_per_token": (("language", "length_class"), ("language",), ("script",), ()),
    "byte_share": (("language", "length_class"), ("language",), ("script",), ()),
    "token_entropy": (("language", "length_class"), ("script", "length_class"), ("length_class",)),
}
#: The least reach of a band around its quartiles, before widening.
LEAST_REACH = {"chars_per_token": 0.02, "byte_share": 0.005, "token_entropy": 0.01}
CLASS = ("language", "script", "length_class")


def class_bands(figures: DataFrame, width: float, support: int = MIN_SUPPORT) -> DataFrame:
    """Per language, script and length class: limits of each figure, over all texts that pass the base rules.

    Quartiles are those of ``percentile``, exact over figures rounded to ``DECIMALS``, so they do not depend on the order of
    rows. A length class holds the texts between two powers of two of tokens, since short texts scatter more and repeat less.
    A class of fewer than ``support`` texts is judged by the next of ``LEVELS`` that has as many; a figure without any has no
    limits. Entropy is compared as a share of the highest possible one.
    """
    figure = F.explode(F.array(*[F.struct(F.lit(n).alias("figure"), F.round(n, DECIMALS).alias("value")) for n in BANDED])).alias("v")
    steps = figures.filter(~F.col("base_failed")).select(*CLASS, figure).groupBy(*CLASS, "v.figure", "v.value").agg(F.count("*").alias("n"))
    steps = materialise(steps, "steps")
    wider = steps.select("figure", "value", "n", _levels()).groupBy("figure", "at", "value").agg(F.sum("n").alias("n"))
    quartiles = wider.groupBy("figure", "at").agg(F.percentile("value", [0.25, 0.75], F.col("n")).alias("q"), F.sum("n").alias("n"))
    least = F.create_map(*[F.lit(v) for pair in LEAST_REACH.items() for v in pair])[F.col("figure")]
    reach = F.greatest(F.col("q")[1] - F.col("q")[0], least) * F.lit(width)
    limit = F.struct((F.col("q")[0] - reach).alias("low"), (F.col("q")[1] + reach).alias("high")).alias("limit")
    limits = quartiles.filter(F.col("n") >= support).select("figure", "at", limit)
    wanted = steps.select(*CLASS, "figure").distinct().select(*CLASS, "figure", _levels())
    narrowest = [F.min_by("limit", F.when(F.col("figure") == n, F.col("at.level"))).alias(n) for n in BANDED]
    return wanted.join(limits, ["figure", "at"]).groupBy(*CLASS).agg(*narrowest)


def _levels() -> Column:
    """A row for each of the classes that may judge a row's ``figure``: how wide it is, and its key."""
    at = F
    for name, levels in LEVELS.items():
        keys = [F.array(*[F.col(k).cast("string") if k in own else F.lit("") for k in CLASS]) for own in levels]
        at = at.when(F.col("figure") == name, F.array(*[F.struct(F.lit(n).alias("level"), k.alias("key")) for n, k in enumerate(keys)]))
    return F.explode(at).alias("at")


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    lang: str | None = "lang",
    model: str = f"{TOKENIZERS}/piece_bpe_32k.model",
    width: float = 3.0,
    prefix: str = "",
    columns: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` (all its columns, or those named) with its figures, ``base_failed`` and ``kept``.

    Bands belong to the language column, and where it is missing or NULL to the script of the text; small classes use those of
    wider ones (``class_bands``). NULL and empty
    texts have no words and fail the base rules; repeated rows are judged alike; an empty table stays empty. ``prefix``
    goes before each new column name, for tables that already have such a column.
    """
    language = F.coalesce(F.lower(F.col(lang).cast("string")), F.col("__f.script")) if lang else F.col("__f.script")
    measured = docs.withColumn("__f", text_figures(filled(F.col(text)), model))
    share = F.when(F.col("__f.n_tokens") > 1, F.col("__f.token_entropy") / F.log2(F.col("__f.n_tokens"))).otherwise(0.0)
    length_class = F.floor(F.log2(F.greatest(F.col("__f.n_tokens"), F.lit(1)))).cast("int")
    failed = (F.col("__f.n_words") < MIN_WORDS) | (100 * F.col("__f.n_repeat_words") > MAX_REPEAT_SHARE * F.col("__f.n_words"))
    measured = measured.withColumn(
        "__f", F.col("__f").withField("language", language).withField("length_class", length_class).withField("token_entropy", share).withField("base_failed", failed)
    )
    columns = docs.columns if columns is None else columns
    measured = materialise(measured.select(*[F.col(f"`{c}`") for c in columns], "__f"), "quality")
    bands = class_bands(measured.select("__f.*"), width)
    inside = F.lit(True)
    for name in BANDED:
        inside &= F.coalesce(F.round(f"__f.{name}", DECIMALS).between(F.col(f"__b.{name}.low"), F.col(f"__b.{name}.high")), F.lit(True))
    bands = materialise(bands.select(F.struct(*CLASS).alias("__class"), F.struct(*BANDED).alias("__b")), "bands")
    same = F.struct(*[F.col(f"__f.{k}") for k in CLASS]) == F.col("__class")
    bands = F.broadcast(bands) if bands.count() <= BROADCAST_BANDS else bands
    judged = measured.join(bands, same, "left")
    names = [n for n, _ in FIELDS if n != "script"]
    return judged.select(
        *[F.col(f"`{c}`") for c in columns],
        *[F.col(f"__f.{n}").alias(prefix + n) for n in names],
        F.col("__f.base_failed").alias(prefix + "base_failed"),
        (~F.col("__f.base_failed") & inside).alias(prefix + "kept"),
    )
