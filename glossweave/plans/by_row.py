"""Row strategy: columns with few values by value, the others row by row; no memory."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.functions.text import non_blank, repair, strip
from glossweave.operators.cells import unpivot_cells
from glossweave.operators.chunks import RETRY_BATCH, VALUE_BATCH, fixed_batches, row_requests, split_failed_chunks
from glossweave.operators.inference import Translate, given_up, raise_failed, run_requests, to_halve
from glossweave.operators.lookup import hot_keys, salted_left_join
from glossweave.operators.pool import column_strategy, distinct_values, language_fanout
from glossweave.plans.common import (
    Run, Settings, all_failed, assemble, count_by_language, prepare_source, require_unique_rows, usage_by_language,
)
from glossweave.operators.quality import suspect_equal
from glossweave.session import materialise
from glossweave.sources.stages import AnswerLog

CHUNK = ["lang", "chunk_no"]


def translate_fields(cells: DataFrame, translate: Translate, batch: int, attempt: int, settings: Settings, log: AnswerLog | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Translate batched cells ``(lang, chunk_no, row_id, col, value)``.

    Batches whose payload is rejected are halved by rows and sent again until single rows are left. Returns
    ``(lang, chunk_no, row_id, col, new)`` for requested columns only, with the batch's first name as ``chunk_no``,
    then the responses and what got no answer.
    """
    pending, answers, responses, failed = cells, [], [], []
    first_name = F.regexp_replace("chunk_no", "(/[01])+$", "")
    for step in range(batch.bit_length() + 1):
        sent = run_requests(row_requests(pending, CHUNK), translate, attempt, "row", parallelism=settings.parallelism, log=log)
        checked = sent.withColumn("split_round", F.lit(step))
        got = checked.where(F.col("status") == "ok").select(*CHUNK, F.explode("items").alias("_item"))
        fields = got.select(*CHUNK, F.col("_item")["id"].alias("row_id"), F.explode(F.col("_item")["fields"]).alias("col", "_new"))
        asked = pending.select(*CHUNK, "row_id", "col")
        answers.append(fields.join(asked, [*CHUNK, "row_id", "col"], "left_semi").select("lang", first_name.alias("chunk_no"), "row_id", "col", repair(F.col("_new")).alias("new")))
        responses.append(checked)
        lost = pending.where(non_blank(F.col("value"))).join(given_up(checked, CHUNK), CHUNK)
        failed.append(lost.select("lang", F.col("value").alias("text"), "reason", F.lit(attempt).alias("attempt")))
        halved = to_halve(checked, CHUNK)
        if halved.isEmpty():
            break
        again = pending.join(halved, CHUNK, "left_semi")
        halves = split_failed_chunks(again.select(*CHUNK, "row_id").distinct(), CHUNK, "row_id")
        again = again.join(halves, [*CHUNK, "row_id"]).withColumn("chunk_no", F.concat_ws("/", "chunk_no", "half")).drop("half")
        pending = materialise(again, "halves")
    lost = reduce(DataFrame.unionByName, failed)
    if settings.strict:
        raise_failed(lost, "translation by row")
    return reduce(DataFrame.unionByName, answers), reduce(DataFrame.unionByName, responses), lost


def localize_rows(df: DataFrame, translate: Translate, settings: Settings) -> Run:
    """Localise a wide table without a memory; suspects are cells that came back unchanged.

    A round reads and writes the cells that the round before it left suspect, and the answers; unchanged cells of the table
    are joined with the last answers once at the end. See ``Settings.resume_root`` for runs that may be broken off.
    """
    langs, failed = list(settings.langs), []
    require_unique_rows(df, settings.row_id)
    stages = settings.stages(df, "row")
    log = stages.answers(settings.calls_per_commit) if stages else None
    source, columns = prepare_source(df, settings, settings.forced_dedup)
    cells = unpivot_cells(source, settings.row_id, columns)
    strategy = {r["col"]: r["strategy"] for r in column_strategy(cells, settings.forced_dedup).collect()}
    by_value = [c for c in columns if strategy.get(c) == "dedup"]
    by_row = [c for c in columns if strategy.get(c) != "dedup"]
    keyed, responses = cells.withColumn("translations", F.lit(None).cast("map<string,string>")), []

    if by_value:
        values = materialise(distinct_values(cells.where(F.col("col").isin(*by_value))), "values")
        batched = fixed_batches(values, ["col"], ["first_row", "value"], VALUE_BATCH)
        named = batched.withColumns({"chunk_no": F.concat_ws("#", "col", "batch_no"), "row_id": F.col("item_no")})
        asked = materialise(language_fanout(named, langs).select(*CHUNK, "row_id", "col", "value"), "value-batches")
        answers, got, lost = translate_fields(asked, translate, VALUE_BATCH, 0, settings, log)
        found = asked.join(answers, [*CHUNK, "row_id", "col"]).groupBy(_value_key().alias("text_key"))
        mapping = found.agg(F.map_from_entries(F.collect_list(F.struct("lang", "new"))).alias("translations"))
        hot = hot_keys(values.withColumn("text_key", _value_key()), "text_key", "n_cells")
        named = cells.withColumn("text_key", F.when(F.col("col").isin(*by_value) & non_blank(F.col("value")), _value_key()))
        keyed = salted_left_join(named, mapping, "text_key", ["row_id", "col"], hot).drop("text_key")
        responses.append(got)
        failed.append(lost)

    # One entry per language in the map, so cells are multiplied by languages after the join.
    replaced = F.coalesce(F.col("translations")[F.col("lang")], F.col("value"))
    output = language_fanout(keyed, langs).withColumn("output", replaced).drop("translations")

    if by_row:
        rows = fixed_batches(source.select(F.col(settings.row_id).alias("row_id")), [], ["row_id"], settings.row_batch)
        wanted = cells.where(F.col("col").isin(*by_row) & non_blank(F.col("value")))
        named = wanted.join(rows, "row_id").withColumn("chunk_no", F.concat_ws("#", F.lit("rows"), "batch_no"))
        asked = materialise(language_fanout(named, langs).select(*CHUNK, "row_id", "col", "value"), "row-batches")
        answers, got, lost = translate_fields(asked, translate, settings.row_batch, 0, settings, log)
        output = _replace(output, answers.drop("chunk_no"), ["lang", "row_id", "col"])
        responses.append(got)
        failed.append(lost)

    base = materialise(output, "output-cells")
    pending = _unchanged(base, settings)
    checks, resent, changes, cell = [count_by_language(pending, langs)], [], [], ["lang", "row_id", "col"]
    for attempt in range(1, settings.max_rounds + 1):
        if not any(checks[-1].values()):
            break
        asked = _retry_cells(pending, base, min(settings.row_batch, RETRY_BATCH))
        answers, got, lost = translate_fields(asked, translate, RETRY_BATCH, attempt, settings, log)
        resent.append(count_by_language(asked.select("lang", "row_id").distinct(), langs))
        new = materialise(answers.select(*cell, "new", F.lit(attempt).alias("round")), "retry-answers")
        changes.append(new)
        # All suspects were asked for; those without an answer stay, and any cell that was asked for may have become one.
        answered = asked.join(new, cell).withColumn("output", F.col("new"))
        silent = pending.join(new, cell, "left_anti").select(*base.columns)
        pending = materialise(_unchanged(answered, settings).select(*base.columns).unionByName(silent), "retry-suspects")
        responses.append(got)
        failed.append(lost)
        checks.append(count_by_language(pending, langs))

    output = base
    if changes:
        last = reduce(DataFrame.unionByName, changes).groupBy(*cell).agg(F.max_by("new", "round").alias("new"))
        output = _replace(base, last, cell)
    usage = usage_by_language(responses, cells, langs)
    return Run(assemble(source, output, columns, settings), output, pending.select(*base.columns), usage, checks, resent, all_failed(failed, cells))


def _value_key():
    return F.sha2(F.concat_ws("|", F.length("col").cast("string"), "col", "value"), 256)


def _replace(output: DataFrame, answers: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Put ``new`` over ``output`` where an answer exists."""
    joined = output.join(answers.select(*keys, "new"), list(keys), "left")
    return joined.withColumn("output", F.coalesce("new", "output")).select(*output.columns)


def _unchanged(output: DataFrame, settings: Settings) -> DataFrame:
    """Cells that came back as they were sent."""
    stripped = output.withColumns({"v_in": strip(F.col("value")), "v_out": strip(F.col("output"))})
    return suspect_equal(stripped, settings.row_abbr_max)


def _retry_cells(suspects: DataFrame, base: DataFrame, batch: int) -> DataFrame:
    """Suspect rows in batches; each row of a batch sends every column that is suspect anywhere in it."""
    rows = fixed_batches(suspects.select("lang", "row_id").distinct(), ["lang"], ["row_id"], batch)
    rows = rows.withColumn("chunk_no", F.concat_ws("#", F.lit("retry"), "batch_no")).select("lang", "row_id", "chunk_no")
    rows = materialise(rows, "retry-rows")
    union = suspects.join(rows, ["lang", "row_id"]).select(*CHUNK, "col").distinct()
    cells = base.drop("output").where(non_blank(F.col("value")))
    asked = cells.join(rows, ["lang", "row_id"]).join(union, [*CHUNK, "col"], "left_semi")
    return materialise(asked.select("chunk_no", *cells.columns), "retry-cells")
