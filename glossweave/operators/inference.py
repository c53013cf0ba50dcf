"""Batch inference with a caller-supplied function, validation and halving of failed chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossweave.functions.payload import resolve_carried, validate_responses
from glossweave.operators.chunks import MAX_CHARS, request_columns, split_failed_requests, text_requests
from glossweave.session import drop_stages, materialise, shuffle_partitions, stage_path
from glossweave.sources.stages import AnswerLog, exists

# A lost task repeats the calls of its partition, so partitions stay small: so many calls, or as much text as that many
# calls of the first pass hold, but no more than MOST_CALLS. Halving leaves many calls of a few words each.
CALLS_PER_TASK, MOST_CALLS = 50, 1_000
CHARS_PER_TASK = CALLS_PER_TASK * MAX_CHARS
# Requests and answers that a task holds, in characters, before it hands them on: 16 full calls, or many small ones.
CHARS_HELD = 32 * MAX_CHARS

# (language, request JSON, attempt) -> {"raw", "prompt_tokens", "completion_tokens", "api_calls"}
Translate = Callable[[str, str, int], dict]

_USAGE = ("prompt_tokens", "completion_tokens", "api_calls")


def run_requests(
    requests: DataFrame,
    translate: Translate,
    attempt: int = 0,
    shape: str = "text",
    spread: Sequence[str] = ("lang", "chunk_no"),
    parallelism: int | None = None,
    log: AnswerLog | None = None,
) -> DataFrame:
    """Send each request once and keep validated answers, and the raw text of rejected ones, in a written table.

    The calls may be paid for and the parsing is repeated work, so the result is materialised before
    anything reads it. An exception of the function becomes a failed response, not a failed task
    that would repeat its neighbours. With a ``log`` answers are committed to it in portions, and a request that it
    holds an answer for is not sent; its usage counts as 0 then.
    """
    return materialise(_checked(requests, translate, attempt, shape, spread, parallelism, log), "responses")


def _checked(requests, translate, attempt, shape, spread, parallelism, log, dealt=False) -> DataFrame:
    """The validated answers, to be written once, since reading them makes the calls; the raw text stays where it is
    rejected, since ``items`` hold all of an accepted one."""
    if log is not None:
        answers = _logged_requests(requests, translate, attempt, shape, spread, parallelism, log)
    else:
        answers = _send(requests, translate, attempt, spread, parallelism, requests.drop("request").columns, dealt)
    return validate_responses(answers, shape).withColumn("raw", F.when(F.col("status") != "ok", F.col("raw")))


def _logged_requests(requests, translate, attempt, shape, spread, parallelism, log: AnswerLog) -> DataFrame:
    """Send what the log has no answer for, one commit after the other, then read all answers from the log."""
    name = F.sha2(F.concat_ws("|", F.lit(shape), F.lit(attempt), "lang", "request"), 256)
    named = materialise(requests.withColumn("request_id", name), "requests")
    missing = named.dropDuplicates(["request_id"]).join(log.answered(), "request_id", "left_anti")
    commits = -(-missing.count() // log.calls_per_commit)
    missing = missing.drop("sent")
    fresh = materialise(missing.withColumn("commit", F.pmod(F.xxhash64("request_id"), F.lit(max(1, commits)))), "fresh-requests")
    for commit in range(commits):
        log.append(_send(fresh.where(F.col("commit") == commit), translate, attempt, spread, parallelism, ["request_id"]))
    sent = fresh.select("request_id", F.lit(True).alias("_sent"))
    answers = named.drop("request").join(log.latest(), "request_id").join(sent, "request_id", "left")
    usage = {c: F.when(F.col("_sent"), F.col(c)).otherwise(F.lit(0)) for c in _USAGE}
    return answers.withColumns({**usage, "attempt": F.lit(attempt)}).drop("request_id", "_sent")


def _send(
    requests: DataFrame, translate: Translate, attempt: int, spread: Sequence[str], parallelism: int | None, keep: Sequence[str], dealt: bool = False
) -> DataFrame:
    """Columns ``keep`` of each request with ``attempt`` and what the call for it gave; every evaluation calls again.

    Requests that are ``dealt`` already stay where they are. What goes along with a request passes Python as Arrow columns.
    """
    schema = T.StructType(
        [
            *[requests.schema[c] for c in keep],
            T.StructField("attempt", T.IntegerType()),
            T.StructField("raw", T.StringType()),
            T.StructField("error", T.StringType()),
            *[T.StructField(c, T.LongType()) for c in _USAGE],
        ]
    )
    names = schema.fieldNames()

    def ask(lang: str, request: str) -> tuple:
        try:
            answer = translate(lang, request, attempt)
            usage = [int(answer.get(c) or 0) for c in _USAGE]
            return answer.get("raw"), None, *usage
        except Exception as problem:
            return None, f"{type(problem).__name__}: {problem}", *[0] * len(_USAGE)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), *[pa.int64()] * len(_USAGE)]
        for batch in batches:
            langs, bodies, at = batch.column("lang"), batch.column("request"), 0
            while at < batch.num_rows:
                answers, held = [], 0
                while at + len(answers) < batch.num_rows and held < CHARS_HELD:
                    row = at + len(answers)
                    body = bodies[row].as_py()
                    answers.append(ask(langs[row].as_py(), body))
                    held += len(body or "") + len(answers[-1][0] or "")
                part = batch.slice(at, len(answers))
                made = [pa.array([attempt] * len(answers), pa.int32())]
                made += [pa.array(column, kind) for column, kind in zip(zip(*answers), kinds)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *made], names)
                at += len(answers)

    if not dealt:
        wide = parallelism
        if not wide:
            total = requests.agg(F.count(F.lit(1)).alias("calls"), F.sum("n_chars").alias("chars")).first()
            wide = call_tasks(total["calls"], total["chars"] or 0, shuffle_partitions(requests.sparkSession))
        # By a hash of the names: a partitioning equal to that of the requests would be dropped, and small ones merged.
        requests = requests.repartition(wide, F.xxhash64(*spread))
    return requests.select(*dict.fromkeys([*keep, "lang", "request"])).mapInArrow(send, schema)


def call_tasks(calls: int, chars: int, least: int) -> int:
    """Tasks for so many calls with so much text: ``least``, if there are as many calls, or what bounds the loss of a task."""
    by_size = min(-(-calls // CALLS_PER_TASK), -(-chars // CHARS_PER_TASK))
    return max(min(calls, least), -(-calls // MOST_CALLS), by_size, 1)


class Translated(NamedTuple):
    """Resolved items, all validated responses, and what got no answer as ``(lang, text, reason, attempt)``."""

    resolved: DataFrame
    responses: DataFrame
    failed: DataFrame


def _to_halve() -> Column:
    return (F.col("status") != "ok") & F.col("error").isNull() & (F.col("n_items") > 1)


def _halved(checked: DataFrame) -> DataFrame:
    return checked.where(_to_halve())


def to_halve(checked: DataFrame, chunk: Sequence[str]) -> DataFrame:
    """Chunks to send again in halves: the payload was wrong and there is more than one item. A smaller chunk does not
    mend a service that is down."""
    return _halved(checked).select(*chunk)


def given_up(checked: DataFrame, chunk: Sequence[str], *keep: str) -> DataFrame:
    """Chunks that failed for good, with the reason."""
    final = (F.col("status") != "ok") & (F.col("error").isNotNull() | (F.col("n_items") <= 1))
    return checked.where(final).select(*chunk, *keep, F.coalesce("error", "status").alias("reason"))


def raise_failed(failed: DataFrame, what: str) -> None:
    """An error that names how many items have no answer, and the first reason."""
    row = failed.agg(F.count(F.lit(1)).alias("n"), F.min("reason").alias("reason")).first()
    if row["n"]:
        raise RuntimeError(f"{what}: {row['n']} items without an answer, such as: {row['reason']}")


def translate_items(
    items: DataFrame,
    translate: Translate,
    max_items: int,
    attempt: int = 0,
    text: str = "text_norm",
    parallelism: int | None = None,
    log: AnswerLog | None = None,
) -> Translated:
    """Translate chunked items ``(lang, chunk_no, item_no, id, text)``.

    Chunks whose payload is rejected are halved and sent again until single items are left, at
    most ``log2(max_items)`` times. Items of a call that raised, and items rejected alone, are the failed ones. Items with
    a ``portion`` are sent one portion after the other.
    """
    done = [translate_portion(part, translate, max_items, attempt, text, parallelism, log) for _, part in portions_of(items)]
    return Translated(*[reduce(DataFrame.unionByName, tables) for tables in zip(*done)])


def portions_of(items: DataFrame) -> list[tuple[int, DataFrame]]:
    """The portions of ``items`` with their numbers, in order; all of them as one if they are not divided."""
    if "portion" not in items.columns:
        return [(0, items)]
    numbers = sorted(row["portion"] for row in items.select("portion").distinct().collect())
    return [(n, items.where(F.col("portion") == n)) for n in numbers] or [(0, items)]


def translate_portion(
    items: DataFrame, translate: Translate, max_items: int, attempt: int = 0, text: str = "text_norm", parallelism: int | None = None, log: AnswerLog | None = None
) -> Translated:
    """``translate_items`` for items that are sent at the same time."""
    chunk, spark = ["lang", "chunk_no"], items.sparkSession
    named, least = items.drop("portion", "n_chars").withColumn("chunk_no", F.col("chunk_no").cast("string")), shuffle_partitions(spark)
    size = F.col("n_chars") if "n_chars" in items.columns else F.length(text)
    calls = items.groupBy(*chunk).agg(F.sum(size).alias("n")).agg(F.count(F.lit(1)), F.sum("n")).first()
    wide = parallelism or call_tasks(calls[0], calls[1] or 0, least)
    carry = [c for c in named.columns if c not in (*chunk, "id", text)]
    # Dealt by chunk, so that gathering and calling need no other exchange.
    requests = text_requests(named.repartition(wide, *chunk), chunk, text=text, carry=carry)
    resolved, responses, failed, before = None, None, None, None
    for step in range(max(1, max_items).bit_length() + 1):
        answers = _checked(requests, translate, attempt, "text", chunk, wide if log is None else parallelism, log, dealt=True).withColumn("split_round", F.lit(step))
        checked, pending = _answered(answers)
        if before is not None:
            drop_stages(spark, before)
        good = resolve_carried(checked, named.columns, text)
        resolved = good if resolved is None else resolved.unionByName(good)
        responses = checked.drop("sent") if responses is None else responses.unionByName(checked.drop("sent"))
        lost = given_up(checked, chunk, "sent").select("lang", F.explode("sent").alias("_item"), "reason")
        lost = lost.select("lang", F.col("_item")["text"].alias("text"), "reason", F.lit(attempt).alias("attempt"))
        failed = lost if failed is None else failed.unionByName(lost)
        again = _halved(checked).agg(F.count(F.lit(1)), F.sum("n_chars")).first()
        if not again[0]:
            break
        wide = parallelism or call_tasks(2 * again[0], again[1] or 0, least)
        halves = split_failed_requests(pending[0], chunk).withColumn("chunk_no", F.concat_ws("/", "chunk_no", "half")).drop("half")
        requests, before = halves.repartition(wide, *chunk).select(*chunk, *request_columns(F.col("sent"))), pending[1]
    return Translated(resolved, responses, failed)


def _answered(answers: DataFrame) -> tuple[DataFrame, tuple[DataFrame, str]]:
    """The written responses, and those to halve with what they were to answer, and their folder, to be dropped when the
    halves are answered: a response beside keeps its items only if it is not sent again."""
    spark, target = answers.sparkSession, stage_path(answers.sparkSession, "responses")
    twice = answers.withColumn("again", F.explode(F.when(_to_halve(), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))))
    kept = twice.withColumn("sent", F.when(F.col("again") | ~_to_halve(), F.col("sent")))
    materialise(kept, "responses", target, ["again"])

    def read(kind: str) -> DataFrame:
        folder = f"{target}/again={kind}"
        return spark.read.schema(answers.schema).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], answers.schema)

    return read("false"), (read("true"), f"{target}/again=true")


def spent(responses: DataFrame) -> DataFrame:
    """The usage of ``responses`` by language as a table of its own, which does not read them again."""
    total = usage_totals(responses)
    return responses.sparkSession.createDataFrame(total.collect(), total.schema)


def usage_totals(responses: DataFrame, keys: Sequence[str] = ("lang",)) -> DataFrame:
    """Calls and tokens per run and language."""
    return responses.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _USAGE])
