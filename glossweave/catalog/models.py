"""Stand-ins for a model, for queries and tests."""

from __future__ import annotations

import json


def pseudo_translate(lang: str, request: str, attempt: int) -> dict:
    """Deterministic stand-in for a model: every text prefixed with its language."""
    sent = json.loads(request)
    if sent and "fields" in sent[0]:
        got = [{"row_index": x["row_index"], "fields": {c: f"[{lang}] {v}" for c, v in x["fields"].items()}} for x in sent]
    else:
        got = [{"id": x["id"], "translation": f"[{lang}] {x['text']}"} for x in sent]
    raw = json.dumps(got, ensure_ascii=False)
    return {"raw": raw, "prompt_tokens": len(request), "completion_tokens": len(raw), "api_calls": 1}
