"""Response payloads: find the JSON, parse it, judge it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.functions.text import repair, strip

_STRICT = {"allowSingleQuotes": "false"}


def extract_payload(text: Column, widest_block: bool = True) -> Column:
    """Response text without code fences; with ``widest_block`` only its outermost array or object."""
    t = strip(F.coalesce(text, F.lit("")))
    opened = F.regexp_replace(t, r"(?U)\A```[a-zA-Z]*[\s\x1c-\x1f]*", "")
    unfenced = F.when(t.startswith("```"), strip(F.regexp_replace(opened, r"(?U)[\s\x1c-\x1f]*```\z", ""))).otherwise(t)
    if not widest_block:
        return unfenced
    array = F.regexp_extract(unfenced, r"(?s)\[.*\]", 0)
    block = F.regexp_extract(unfenced, r"(?s)\{.*\}", 0)
    return F.when(array != "", array).when(block != "", block).otherwise(unfenced)


def parse_array(payload: Column, element: str) -> Column:
    """Elements of a JSON array, NULL when ``payload`` is anything else.

    The payload is parsed inside another array: text behind the first array then is an error, as it
    should be, instead of being ignored, and a lone object is not taken for an array of one.
    """
    outer = F.from_json(F.concat(F.lit("["), payload, F.lit("]")), f"ARRAY<ARRAY<{element}>>", _STRICT)
    return F.when((F.size(outer) == 1) & payload.startswith("["), outer[0])


def text_items(payload: Column) -> Column:
    """``ARRAY<STRUCT<id BIGINT, translation STRING>>``; ids may arrive as numeric text."""
    parsed = parse_array(payload, "STRUCT<id: STRING, translation: STRING>")
    return F.transform(
        parsed,
        lambda x: F.struct(strip(x["id"]).try_cast("bigint").alias("id"), x["translation"].alias("translation")),
    )


def row_items(payload: Column) -> Column:
    """``ARRAY<STRUCT<id BIGINT, fields MAP<STRING, STRING>>>``."""
    parsed = parse_array(payload, "STRUCT<row_index: STRING, fields: MAP<STRING, STRING>>")
    return F.transform(
        parsed, lambda x: F.struct(strip(x["row_index"]).try_cast("bigint").alias("id"), x["fields"].alias("fields"))
    )


def response_status(payload: Column, items: Column, ids: Column) -> Column:
    """``ok`` or why a response is rejected; the ids must be those of the request, each once."""
    elements = parse_array(payload, "STRING")
    objects = F.from_json(F.concat(F.lit("["), payload, F.lit("]")), "ARRAY<MAP<STRING, STRING>>", _STRICT)
    an_object = payload.startswith("{") & (F.size(objects) == 1)
    sent = F.array_sort(ids)
    got = F.array_sort(F.transform(items, lambda x: x["id"]))
    # Answers with all ids are by far the most, and need no second parse.
    return (
        F.when(F.coalesce(got == sent, F.lit(False)), "ok")
        .when(an_object, "not_array")
        .when(elements.isNull(), "unparsable")
        .when(F.size(elements) != F.size(ids), "size_mismatch")
        .when(items.isNull(), "bad_items")
        .otherwise("id_mismatch")
    )


def validate_responses(responses: DataFrame, shape: str = "text") -> DataFrame:
    """Add ``items`` and ``status`` to ``responses(raw, ids, ...)``."""
    parse = {"text": text_items, "row": row_items}[shape]
    return (
        responses.withColumn("_payload", extract_payload(F.col("raw"), widest_block=shape == "text"))
        .withColumn("_items", parse(F.col("_payload")))
        .withColumn("status", response_status(F.col("_payload"), F.col("_items"), F.col("ids")))
        .withColumn("items", F.when(F.col("status") == "ok", F.col("_items")))
        .drop("_payload", "_items")
    )


def resolve_response(validated: DataFrame, sent: DataFrame, chunk: list[str], text: str = "text_norm") -> DataFrame:
    """Answers beside the texts they belong to; a blank answer falls back to the source and says so.

    ``sent`` holds the chunk items with their ``id``.
    """
    answers = (
        validated.where(F.col("status") == "ok")
        .select(*chunk, F.explode("items").alias("_item"))
        .select(*chunk, F.col("_item")["id"].alias("id"), strip(repair(F.col("_item")["translation"])).alias("_tr"))
    )
    blank = F.coalesce(F.col("_tr") == "", F.lit(True))
    return sent.join(answers, [*chunk, "id"]).select(
        *sent.columns, F.when(blank, F.col(text)).otherwise(F.col("_tr")).alias("translation"), blank.alias("is_fallback")
    )


def resolve_carried(validated: DataFrame, columns: list[str], text: str = "text_norm") -> DataFrame:
    """``resolve_response`` for responses whose items ``sent`` came along, by id: the same rows, and nothing is joined.

    An accepted answer has the ids of its request, each once, so sorted by id it stands beside the items. ``columns`` are
    those of the items to return; ``id`` and ``text`` are the id and the text as sent.
    """
    pairs = F.zip_with("sent", F.sort_array("items"), lambda x, y: F.struct(x.alias("sent"), y["translation"].alias("got")))
    own = [c for c in columns if c in ("lang", "chunk_no")]
    read = validated.where(F.col("status") == "ok").select(*own, F.explode(pairs).alias("_pair"))
    item = F.col("_pair")["sent"]
    read = read.select(
        *[F.col(c) if c in own else item["text" if c == text else c].alias(c) for c in columns], F.col("_pair")["got"].alias("_got")
    )
    answers = read.withColumn("_tr", strip(repair(F.col("_got"))))
    blank = F.coalesce(F.col("_tr") == "", F.lit(True))
    return answers.select(*columns, F.when(blank, F.col(text)).otherwise(F.col("_tr")).alias("translation"), blank.alias("is_fallback"))
