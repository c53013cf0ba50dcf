"""Pool strategy: distinct texts of all columns, translation memory first, inference for the rest.

A cell's output depends on its text and language only, so everything up to the last step works on pairs of a text and a
language, weighted by the number of their cells: memory lookup, inference, scoring and the quality rounds, each of which
reads what the round before it changed. Cells are joined with the final translations once, when the output is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossweave.functions.text import normalise, repair, strip, text_key, translatable_stripped
from glossweave.operators import quality
from glossweave.operators.cells import unpivot_cells
from glossweave.operators.chunks import MAX_CHARS, MAX_ITEMS, RETRY_CHARS, RETRY_ITEMS, greedy_chunks
from glossweave.operators.inference import Translate, portions_of, raise_failed, spent, translate_items, translate_portion
from glossweave.operators.lookup import apply_translations, hot_keys, key_cells
from glossweave.operators.pool import build_pool, language_fanout
from glossweave.plans.common import (
    Run, Settings, all_failed, assemble, count_by_language, prepare_source, require_unique_rows, usage_by_language,
)
from glossweave.session import drop_stages, materialise, stage_path, stages_passing
from glossweave.sources.memory import TranslationMemory, latest_translation
from glossweave.sources.stages import RunStages


#: Items of about so many characters are sent, judged and stored at a time, or more where that would make too many portions: what
#: is on the way between two written tables is a part of the whole then, and each portion has some small jobs of its own.
PORTION_CHARS, MOST_PORTIONS = 64_000_000, 16


def chunk_misses(
    misses: DataFrame,
    max_items: int = MAX_ITEMS,
    max_chars: int = MAX_CHARS,
    keep: Sequence[str] = (),
    texts: DataFrame | None = None,
    portions: int = MOST_PORTIONS,
    path: str | None = None,
) -> DataFrame:
    """Missing texts per language in first-appearance order, packed; the position is the item id.

    Only places and lengths are sorted and packed; the texts are joined to the result once, and once for all languages if
    ``texts`` has those of ``misses`` by first appearance, each once. ``misses`` is read more than once: pass a written
    table, or what follows cheaply from one; it may have ``_h`` and ``n_chars``, hash and length, in place of its texts.
    Items have the columns ``keep`` of either as well, ``n_chars``, and their ``portion``: whole chunks that are next to
    each other, of ``PORTION_CHARS`` characters or what ``portions`` of them make necessary, in a folder of their own below
    ``path``, ``portion=`` and its number.
    """
    spark, place = misses.sparkSession, ["first_col", "first_row", "_h"]
    source, on = (misses, ["lang", *place]) if texts is None else (texts, place)
    own = [c for c in keep if c not in ("lang", "first_col", "first_row")]
    beside = [c for c in own if c in source.columns]
    ride = [c for c in own if c not in beside]
    text_hash = F.xxhash64("text_norm").alias("_h")
    marks = ["_h", "n_chars"] if "_h" in misses.columns else [text_hash, F.length("text_norm").alias("n_chars")]
    sized = misses.select("lang", *place[:2], *marks, *ride)
    target = path or stage_path(spark, "chunk-items")
    with stages_passing(spark):
        packed = greedy_chunks(sized, ["lang"], place, "n_chars", max_items, max_chars)
        packed = materialise(packed.select("lang", *place, "n_chars", "chunk_no", "item_no", F.col("pos").alias("id"), *ride), "packed")
        sizes = packed.groupBy("lang").agg(F.sum("n_chars").alias("chars"), (F.max("chunk_no") + 1).alias("chunks")).collect()
        number = max(1, min(portions, -(-sum(r["chars"] or 0 for r in sizes) // PORTION_CHARS)))
        portion = F.lit(0)
        for row in sizes:
            portion = F.when(F.col("lang").eqNullSafe(row["lang"]), F.floor(F.col("chunk_no") * number / row["chunks"]).cast("int")).otherwise(portion)
        entry = F.struct("lang", "chunk_no", "item_no", "id", *ride)
        placed = packed.withColumn("portion", portion).repartition(*on).groupBy(*on, "n_chars", "portion").agg(F.collect_list(entry).alias("_places"))
        joined = placed.join(source.select(*[c for c in on if c != "_h"], text_hash, "text_norm", *beside), on)
        columns = ["text_norm", "first_col", "first_row", *beside, "n_chars", "_places", "portion"]
        items = materialise(joined.select(*columns), "chunk-items", target, ["portion"])
    opened = items.select(*[c for c in columns if c != "_places"], F.inline("_places"))
    return opened.select("lang", "chunk_no", "item_no", "id", "text_norm", *keep, "n_chars", "portion")


def memory_rows(resolved: DataFrame, model: str, rules_id: str, attempt: int) -> DataFrame:
    """Resolved items as rows of the memory log."""
    return resolved.select(
        "lang",
        F.lit(model).alias("model"),
        F.lit(rules_id).alias("rules_id"),
        "text_norm",
        "translation",
        "is_fallback",
        F.lit(attempt).alias("attempt"),
        F.localtimestamp().alias("updated_at"),
    )


def _store(memory: TranslationMemory, rows: DataFrame, run_id: str, attempt: int, stages: RunStages | None) -> None:
    def append() -> None:
        memory.append(rows, f"{run_id}-{attempt}")

    append() if stages is None else stages.once(f"stored-{attempt}", append)


def translate_missing(
    missing: DataFrame,
    texts: Callable[[], tuple[DataFrame, str | None]],
    memory: TranslationMemory,
    translate: Translate,
    settings: Settings,
    run_id: str,
    stages: RunStages | None = None,
) -> tuple[list[DataFrame], DataFrame | None, list[DataFrame], list[DataFrame]]:
    """Send pairs without a translation and append the answers. Returns the pairs judged by their answers (see ``_looked``),
    the translations that came, usage and failed items.

    ``texts`` gives the pool with its texts, and its folder if it may go once the items are written. One portion of the
    items after the other is sent, judged and stored, and is removed with what it needed on the way. The answers stay in
    the memory, from which they are read again; a run with ``stages``, whose answers an earlier run may have stored, keeps
    them beside it as well and sends all items as one portion.
    """
    spark, spent_on, failed, judged, answered = missing.sparkSession, [], [], [], []
    if missing.isEmpty() and not (stages and stages.done("pair-items-0")):
        return [], None, [], []

    def packed() -> DataFrame:
        pool, passing = texts()
        items = chunk_misses(missing, settings.max_items, settings.max_chars, _CARRIED, pool, 1 if stages else MOST_PORTIONS, items_at)
        if passing:
            drop_stages(spark, passing)
        return items

    # Folders for a table of each portion, which outlast the block.
    judged_at, failed_at, answered_at = stage_path(spark, "judged"), stage_path(spark, "failed"), stage_path(spark, "answered")
    log = stages.answers(settings.calls_per_commit) if stages else None
    with stages_passing(spark):
        items_at = stage_path(spark, "chunk-items")
        items = packed() if stages is None else stages.get("pair-items-0", packed)
        for n, part in portions_of(items):
            with stages_passing(spark):
                done = translate_portion(part, translate, settings.max_items, parallelism=settings.parallelism, log=log)
                offered = done.resolved.withColumn("offered", repair(F.col("translation")))
                # An answer that its repair leaves alone is not written twice.
                changed = F.when(F.col("offered") != F.col("translation"), F.col("offered"))
                kept = offered.select("lang", "text_norm", *_CARRIED, "translation", "is_fallback", changed.alias("repaired"))
                resolved = materialise(kept, "answered", f"{answered_at}/{n}" if stages else None)
                lost = materialise(done.failed, "failed", f"{failed_at}/{n}")
                spent_on.append(spent(done.responses))
                _store(memory, memory_rows(resolved, settings.model, settings.rules_id, attempt=0), run_id, 0, stages)
                better = F.when(~F.col("is_fallback"), F.nullif(F.coalesce("repaired", "translation"), F.lit("")))
                pairs = resolved.select("lang", "text_norm", *_CARRIED, better.alias("translation"))
                if not lost.isEmpty():
                    silent = part.join(resolved.select("lang", "text_key"), ["lang", "text_key"], "left_anti")
                    pairs = pairs.unionByName(silent.select("lang", "text_norm", *_CARRIED, F.lit(None).cast("string").alias("translation")))
                if stages is not None:
                    # The items may be those of an earlier run, some of whose answers the memory has by now.
                    pairs = pairs.join(missing.select("lang", "text_key"), ["lang", "text_key"], "left_semi")
                    answered.append(pairs.select("text_key", "lang", "translation"))
                judged.append(materialise(_looked(pairs, settings), "judged", f"{judged_at}/{n}"))
                failed.append(lost)
            drop_stages(spark, f"{items_at}/portion={n}")
    if settings.strict:
        raise_failed(reduce(DataFrame.unionByName, failed), "translation")
    if stages is not None:
        found = reduce(DataFrame.unionByName, answered)
    else:
        stored = memory.rows(settings.langs, settings.model, settings.rules_id).where(F.col("batch_id") == f"{run_id}-0")
        found = _shown(stored)
    return judged, found.where("translation IS NOT NULL"), spent_on, failed


#: Columns of a pair, beside its language and text, that its chunk item carries.
_CARRIED = ["text_key", "first_col", "first_row", "n_cells", "tried"]


def _shown(rows: DataFrame) -> DataFrame:
    """``text_key, lang, translation`` of memory rows: what can be shown, NULL for a fallback and a blank one."""
    shown = F.when(~F.col("is_fallback"), F.nullif(repair(F.col("translation")), F.lit("")))
    return rows.select(text_key(F.col("text_norm")).alias("text_key"), "lang", shown.alias("translation"))


def _looked(pairs: DataFrame, settings: Settings) -> DataFrame:
    """The pairs, judged by their ``translation``: ``whole`` if it decides about the output of all their cells, and then
    ``score`` and ``suspect``.

    Of a pair that is whole and not suspect nothing is read again, so its texts become NULL. It is not left out here: a
    filter on the way would be pushed below the score and compute it again.
    """
    whole = F.col("translation").isNotNull()
    if settings.check_script:
        whole &= normalise(F.col("translation")) != F.col("text_norm")
    looked = pairs.withColumns({"whole": F.coalesce(whole, F.lit(False)), "_shown": strip(F.col("translation"))})
    looked = looked.withColumn("score", quality.residue_score(F.col("_shown"), settings.markers))
    wrong = F.col("whole") & F.coalesce(quality.reads_like_source(F.col("_shown"), F.col("score")), F.lit(False))
    looked = looked.withColumn("suspect", wrong).drop("_shown")
    return looked.withColumns({c: F.when(F.col("suspect") | ~F.col("whole"), F.col(c)) for c in ("text_key", "text_norm", "translation") if c in pairs.columns})


def _better(resolved: DataFrame) -> DataFrame:
    """``lang, text_norm, better``: what the answers offer, repaired, NULL for a blank one.

    Not filtered by it, since a filter would be pushed below the repair and do it again.
    """
    offered = F.nullif(repair(F.col("translation")), F.lit(""))
    return resolved.select("lang", "text_norm", F.when(~F.col("is_fallback"), offered).alias("better"))


def localize_pool(df: DataFrame, memory: TranslationMemory, translate: Translate, settings: Settings, run_id: str | None = None) -> Run:
    """Localise a wide table.

    The rounds work on suspect texts, not on cells, and a text whose retry the memory already holds is not sent for it
    again: a run over texts that stay suspect makes no call the second time. ``output``, ``cells`` and ``suspects`` of
    the result are computed when they are read, from ``df`` and the written translations; no call is made by it. A run
    without ``run_id`` gets one of its own. See ``Settings.resume_root`` for runs that may be broken off.
    """
    langs, model, rules = list(settings.langs), settings.model, settings.rules_id
    run_id = run_id or uuid.uuid4().hex
    require_unique_rows(df, settings.row_id)
    stages = settings.stages(df, "pool")
    source, columns = prepare_source(df, settings)
    cells = unpivot_cells(source, settings.row_id, columns)
    judged, found, existing = [], [], memory.exists()
    texts_at = stage_path(df.sparkSession, "pool")

    def with_texts() -> tuple[DataFrame, str | None]:
        return materialise(build_pool(cells, settings.abbr_max), "pool", texts_at), texts_at

    if stages is not None:
        pool = stages.get("pool", lambda: build_pool(cells, settings.abbr_max))
        texts = lambda: (pool, None)
    elif existing:
        # Most texts may be known, so keys are looked up first.
        pool, texts = materialise(build_pool(cells, settings.abbr_max, texts=False), "pool"), with_texts
    else:
        whole = with_texts()
        pool, texts = materialise(_marked(whole[0]), "pool"), lambda: whole
    keys = language_fanout(_marked(pool), langs)
    missing = keys.withColumn("tried", F.lit(0))
    if existing:
        # The log as it is now: what others add while this run lasts is not read.
        rows = memory.rows(langs, model, rules)
        known = [materialise(_known(keys, rows, lang, settings), "known-pairs") for lang in langs]
        missing = reduce(DataFrame.unionByName, known).where(~F.col("usable")).select(*missing.columns)
        judged += [table.where("usable").drop("usable", "_h", "n_chars") for table in known]
        own = rows.withColumn("text_key", text_key(F.col("text_norm"))).join(pool.select("text_key"), "text_key", "left_semi")
        found.append(_shown(latest_translation(own)).where("translation IS NOT NULL").withColumn("round", F.lit(0)))
    answers, answered, usage, failed = translate_missing(missing, texts, memory, translate, settings, run_id, stages)
    judged += answers
    if answered is not None:
        # Below what was known: rows that an earlier run of the same name has stored are not those of this one.
        found.append(answered.withColumn("round", F.lit(-1)))
    pending = _pending(judged, cells, settings, df.sparkSession)
    checks, resent, changes = [count_by_language(pending, langs, F.col("n_cells"))], [], []
    log = stages.answers(settings.calls_per_commit) if stages else None
    for attempt in range(1, settings.max_rounds + 1):
        if not any(checks[-1].values()):
            break
        untried = pending.where(F.col("tried") < attempt)
        renewed_at, failed_at = stage_path(df.sparkSession, "retried"), stage_path(df.sparkSession, "failed")
        with stages_passing(df.sparkSession):
            again = _retry_items(untried, settings) if stages is None else stages.get(f"items-{attempt}", lambda: _retry_items(untried, settings))
            if again.isEmpty():
                continue
            retried, answered, lost = translate_items(
                again, translate, RETRY_ITEMS, attempt, text="sent_text", parallelism=settings.parallelism, log=log
            )
            # Stored under the source text: a later run finds the better answer without a second step.
            _store(memory, memory_rows(retried, model, rules, attempt), run_id, attempt, stages)
            if settings.strict:
                raise_failed(lost, f"retry {attempt}")
            usage.append(spent(answered))
            failed.append(materialise(lost, "failed", failed_at))
            renewed = pending.drop("score").join(_better(retried), ["lang", "text_norm"], "left")
            renewed = renewed.withColumn("output", F.coalesce("better", "output"))
            renewed = materialise(_judged(renewed, settings), "retried", renewed_at)
        new = renewed.where("better IS NOT NULL").select("text_key", "lang", F.col("better").alias("translation"), F.lit(attempt).alias("round"))
        changes.append(new.distinct())
        pending = renewed.where("suspect").drop("better", "suspect")
        resent.append(checks[-1])
        checks.append(count_by_language(pending, langs, F.col("n_cells")))

    output = apply_translations(cells, _maps([*found, *changes], df.sparkSession), langs, settings.abbr_max, hot_keys(pool, "text_key", "n_cells"))
    used = usage_by_language(usage, cells, langs)
    return Run(assemble(source, output, columns, settings), output, _suspect_cells(output, pending), used, checks, resent, all_failed(failed, cells))


def _marked(pool: DataFrame) -> DataFrame:
    """The pool with hashes and lengths in place of its texts."""
    if "text_norm" not in pool.columns:
        return pool
    return pool.withColumns({"_h": F.xxhash64("text_norm"), "n_chars": F.length("text_norm")}).drop("text_norm")


def _known(keys: DataFrame, rows: DataFrame, lang: str, settings: Settings) -> DataFrame:
    """Each pooled text in a language with what the memory has: whether it need not be sent (``usable``), the last attempt
    made, and the judgement of its translation.

    Rows are judged where they are read, and texts move only if a later step reads them. Of rows of one attempt and time
    the one with the greater translation counts, as in ``latest_translation``, told by its first characters, then by a hash.
    """
    shown = F.when(~F.col("is_fallback"), F.nullif(repair(F.col("translation")), F.lit("")))
    read = rows.where(F.col("lang") == lang).select(
        "is_fallback", "attempt", "updated_at", "batch_id", "text_norm", F.unhex(text_key(F.col("text_norm"))).alias("key"), F.left("translation", F.lit(16)).alias("_start"),
        F.xxhash64("translation").alias("_hash"), shown.alias("translation"),
    )
    looked = _looked(read, settings).withColumn("text_norm", F.when(~F.col("is_fallback"), F.col("text_norm")))
    slim = looked.select(
        "key", "is_fallback", "attempt", "updated_at", "batch_id", F.struct("_start", "_hash").alias("translation"),
        F.col("translation").alias("shown"), "text_norm", "whole", "score", "suspect",
    )
    own = keys.where(F.col("lang") == lang).select(
        F.unhex("text_key").alias("key"), "lang", "first_col", "first_row", "n_cells", "_h", "n_chars"
    )
    found = latest_translation(slim.join(own.select("key"), "key", "left_semi"))
    found = found.select("key", (~F.col("is_fallback")).alias("usable"), "tried", "text_norm", F.col("shown").alias("translation"), "whole", "score", "suspect")
    send = ~F.coalesce("usable", F.lit(False))
    marked = F.when(send | F.col("suspect") | ~F.col("whole"), F.lower(F.hex("key")))
    return own.join(found, "key", "left").select(
        marked.alias("text_key"), "lang", "text_norm", "first_col", "first_row", "n_cells", F.when(send, F.col("_h")).alias("_h"), "n_chars",
        F.coalesce("tried", F.lit(0)).alias("tried"), "translation", (~send).alias("usable"), "whole", "score", "suspect",
    )


def _pending(judged: list[DataFrame], cells: DataFrame, settings: Settings, spark: SparkSession) -> DataFrame:
    """The suspect pairs with their ``output``; ``value`` is NULL where it does not matter.

    A text without a translation shows its cells' values, which may differ in form, and so does the check of the script
    for a text that came back as it was; such a pair is split by value.
    """
    columns = ["text_key", "lang", "text_norm", "first_col", "first_row", "n_cells", "tried"]
    if not judged:
        empty = "text_key string, lang string, text_norm string, first_col int, first_row bigint, n_cells bigint, tried int, value string, output string, score double"
        return spark.createDataFrame([], empty)
    every = reduce(DataFrame.unionByName, judged)
    whole = every.where("suspect").select(*columns, F.lit(None).cast("string").alias("value"), F.col("translation").alias("output"), "score")
    open_pairs = every.where(~F.col("whole"))
    if open_pairs.isEmpty():
        return whole
    # Copies collapse before anything moves, so a text with most of the cells is as cheap as any.
    forms = (
        key_cells(cells, settings.abbr_max)
        .where(F.col("text_key").isNotNull())
        .groupBy("text_key", "value")
        .agg(F.min(F.struct("col_ord", "row_id")).alias("place"), F.count(F.lit(1)).alias("n_cells"))
        .select("text_key", "value", F.col("place.col_ord").alias("first_col"), F.col("place.row_id").alias("first_row"), "n_cells")
    )
    split = open_pairs.select("text_key", "lang", "text_norm", "tried", "translation").join(forms, "text_key")
    split = split.withColumn("output", F.coalesce("translation", "value")).select(*columns, "value", "output")
    return whole.unionByName(_suspects(_judged(split, settings)).select(*whole.columns))


def _judged(forms: DataFrame, settings: Settings) -> DataFrame:
    """Add ``score`` (0.0 below the suspect mark) and ``suspect``.

    The stripped output is a column of its own: the score reads it many times.
    """
    shown = forms.withColumn("_shown", strip(F.col("output")))
    scored = shown.withColumn("score", quality.residue_score(F.col("_shown"), settings.markers))
    wrong = quality.reads_like_source(F.col("_shown"), F.col("score"))
    if settings.check_script:
        wrong |= F.coalesce(quality.lacks_script(F.col("lang"), strip(F.col("value")), F.col("_shown")), F.lit(False))
    return scored.withColumn("suspect", wrong).drop("_shown")


def _suspects(judged: DataFrame) -> DataFrame:
    """The suspect rows, written. The rest is written without its texts and left out on reading: a filter on the way would
    be pushed below the score and compute it again."""
    texts = ("text_key", "text_norm", "value", "output")
    slim = judged.withColumns({c: F.when(F.col("suspect"), F.col(c)) for c in texts})
    return materialise(slim, "judged").where("suspect").drop("suspect")


def _maps(found: list[DataFrame], spark: SparkSession) -> DataFrame:
    """``text_key, translations map<lang, text>``: the translation of the last round of each pair, one entry per language."""
    every = reduce(DataFrame.unionByName, found or [spark.createDataFrame([], "text_key string, lang string, translation string, round int")])
    last = every.groupBy("text_key", "lang").agg(F.max_by("translation", "round").alias("translation")) if len(found) > 1 else every
    return last.groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("lang", "translation"))).alias("translations"))


def _suspect_cells(output: DataFrame, pending: DataFrame) -> DataFrame:
    """The cells of the suspect pairs, with their score."""
    marked = pending.select(F.col("text_key").alias("_key"), F.col("lang").alias("_lang"), F.col("value").alias("_value"), "score")
    same = (F.col("text_key") == F.col("_key")) & (F.col("lang") == F.col("_lang"))
    same &= F.col("_value").isNull() | (F.col("_value") == F.col("value"))
    return output.join(marked, same).drop("_key", "_lang", "_value")


def _retry_items(suspects: DataFrame, settings: Settings) -> DataFrame:
    """Distinct suspect texts with what to send: the output while it shows residue, else the source."""
    sent = F.when(F.col("score") >= quality.RESEND_OUTPUT_SCORE, F.col("output")).otherwise(F.col("value"))
    texts = (
        suspects.withColumn("sent", strip(sent))
        .where(translatable_stripped(F.col("sent"), settings.abbr_max))
        .select("lang", "text_norm", normalise(F.col("sent")).alias("sent_text"), "first_col", "first_row")
    )
    sized = (
        texts.groupBy("lang", "text_norm")
        .agg(F.min(F.struct("first_col", "first_row", "sent_text")).alias("first"))
        .select("lang", "text_norm", "first.*")
        .withColumn("n_chars", F.length("sent_text"))
    )
    packed = greedy_chunks(
        sized, ["lang"], ["first_col", "first_row", "text_norm"], "n_chars", min(settings.max_items, RETRY_ITEMS), RETRY_CHARS
    )
    return materialise(
        packed.select("lang", "chunk_no", "item_no", F.col("pos").alias("id"), "text_norm", "sent_text"), "retry-items"
    )
