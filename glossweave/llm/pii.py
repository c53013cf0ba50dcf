"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans. A conditional random field labels all tokens that hold a digit or an @: neighbours in the
text share a potential, and so does a token with the last one before it that is the same or similar (same digits, same name before
an @), however far away. Weights are fitted by pseudo-likelihood on the base spans of a bounded sample; loopy messages then
make labels agree within each document, and confident labels outside the base spans are added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.llm.common import filled, smallest_hashes

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1
#: Tokens that weights are fitted on, and documents they may come from.
FIT_TOKENS = 40_000
FIT_DOCS = 8_000
ROUNDS = 15
CONFIDENT = 0.9

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]+")
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_EDGE = ".,;:()[]{}<>\"'!?|*"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; matches that fail their check are passed over."""
    out = [("email", *span) for span in _emails(text)] if "@" in text else []
    if not _HINT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def candidate_tokens(text: str) -> list[tuple[int, int]]:
    """Spans of the words that hold a digit or an @."""
    out, done = [], 0
    for m in _HINT.finditer(text):
        if m.start() < done:
            continue
        start = m.start()
        while start > done and not _BLANK.match(text[start - 1]):
            start -= 1
        after = _BLANK.search(text, m.end())
        done = after.start() if after else len(text)
        out.append((start, done))
    return out


#: Upper ends of the classes of digits, letters and dots in a token.
_STEPS = ((0, 3, 6, 9, 12, 19), (0, 3), (0, 1, 2, 3))
N_FEATURES = 1 + sum(len(s) + 1 for s in _STEPS) + 9


def shape(word: str) -> list[int]:
    """Indices of the binary features of a token."""
    bare = word.strip(_EDGE)
    digits = _digits(bare)
    counts = (len(digits), sum(c.isalpha() for c in bare), bare.count("."))
    on, base = [0], 1
    for count, steps in zip(counts, _STEPS, strict=True):
        on.append(base + sum(count > s for s in steps))
        base += len(steps) + 1
    parts = bare.split(".")
    flags = (
        "@" in bare, "@" in bare and "." in bare.rpartition("@")[2], word.startswith("+"), "(" in word, "-" in bare,
        any(c in "=:/\"_" for c in bare), len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts if p.isascii()),
        13 <= len(digits) <= 19 and luhn(digits), bare == digits,
    )
    return on + [base + k for k, flag in enumerate(flags) if flag]


def skip_keys(word: str) -> set[str]:
    """What makes two tokens the same or similar."""
    bare = word.strip(_EDGE).lower()
    keys = {bare}
    if len(digits := _digits(bare)) >= 5:
        keys.add(digits)
    if "@" in bare:
        keys.add(bare.partition("@")[0])
    return keys - {""}


def token_graph(text: str) -> tuple[list[tuple[int, int]], list[list[int]], list[tuple[int, int]], list[tuple[int, int]]]:
    """Tokens, their features, chain links and skip links; a token links to the last similar one, so links stay linear."""
    spans = candidate_tokens(text)
    chain = [(k - 1, k) for k in range(1, len(spans)) if not text[spans[k - 1][1] : spans[k][0]].strip()]
    seen: dict[str, int] = {}
    skip = set()
    for k, (a, b) in enumerate(spans):
        for key in skip_keys(text[a:b]):
            if key in seen:
                skip.add((seen[key], k))
            seen[key] = k
    return spans, [shape(text[a:b]) for a, b in spans], chain, sorted(skip - set(chain))


def token_labels(spans: list[tuple[int, int]], base: list[tuple[str, int, int]]) -> list[int]:
    """Label of each token: the kind of the first base span that meets it, 0 for none."""
    out = [0] * len(spans)
    starts = [a for a, _ in spans]
    for kind, low, high in reversed(base):
        k = int(np.searchsorted(starts, low, "right")) - 1
        for k in range(max(k, 0), len(spans)):
            if spans[k][0] >= high:
                break
            if spans[k][1] > low:
                out[k] = KINDS.index(kind) + 1
    return out


class Weights:
    """Node weights by feature and label, and symmetric-in-use weights of label pairs for chain and skip links."""

    def __init__(self, node: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.node, self.chain, self.skip = node, chain, skip


def fit(rows: list[tuple[list[int], int, int, int, int]], steps: int = 200, rate: float = 0.5, decay: float = 1e-4) -> Weights:
    """Pseudo-likelihood: each label is predicted from the token's features and the labels next to it.

    A row is (features, label, label before, label after, label of the similar token), with -1 for none.
    """
    wide = N_FEATURES + 3 * LABELS
    x = np.zeros((len(rows), wide), dtype=np.float32)
    y = np.zeros((len(rows), LABELS), dtype=np.float32)
    for k, (features, label, *beside) in enumerate(rows):
        x[k, features] = 1
        y[k, label] = 1
        for slot, other in enumerate(beside):
            if other >= 0:
                x[k, N_FEATURES + slot * LABELS + other] = 1
    w, speed = np.zeros((wide, LABELS), dtype=np.float32), np.zeros((wide, LABELS), dtype=np.float32)
    for _ in range(steps if rows else 0):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed - rate * (x.T @ (p - y) / len(rows) + decay * w)
        w += speed
    if not rows:
        w[0, 0] = 10.0
    before, after, skip = (w[N_FEATURES + s * LABELS : N_FEATURES + (s + 1) * LABELS] for s in range(3))
    return Weights(w[:N_FEATURES], (before + after.T) / 2, (skip + skip.T) / 2)


def marginals(node: np.ndarray, links: np.ndarray, pair: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities after loopy message passing.

    ``node`` holds log potentials (tokens x labels), ``links`` pairs of tokens, ``pair`` a log potential table of each link.
    """
    source, target = np.r_[links[:, 0], links[:, 1]], np.r_[links[:, 1], links[:, 0]]
    table = np.concatenate([pair, pair.transpose(0, 2, 1)])
    back = np.r_[np.arange(len(links)) + len(links), np.arange(len(links))]
    message = np.zeros((len(source), node.shape[1]))
    belief = node.astype(np.float64).copy()
    for _ in range(rounds if len(links) else 0):
        out = table + (belief[source] - message[back])[:, :, None]
        top = out.max(axis=1, keepdims=True)
        new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
        new -= new.max(axis=1, keepdims=True)
        message = 0.5 * message + 0.5 * new
        belief = node.astype(np.float64).copy()
        np.add.at(belief, target, message)
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def added_spans(texts: list[str], bases: list[list[tuple[str, int, int]]], weights: Weights) -> list[list[tuple[str, int, int]]]:
    """Confident spans outside the base spans, for a batch of texts whose graphs are solved together."""
    owner, spans, node, links, tables, covered = [], [], [], [], [], []
    for k, text in enumerate(texts):
        if not _HINT.search(text):
            continue
        own, features, chain, skip = token_graph(text)
        at = len(spans)
        covered += [label > 0 for label in token_labels(own, bases[k])]
        spans += own
        owner += [k] * len(own)
        node += [weights.node[f].sum(axis=0) for f in features]
        links += [(a + at, b + at) for a, b in chain] + [(a + at, b + at) for a, b in skip]
        tables += [0] * len(chain) + [1] * len(skip)
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if not spans or all(covered):
        return out
    pair = np.stack([weights.chain, weights.skip])[np.array(tables, dtype=np.int64)]
    p = marginals(np.array(node), np.array(links, dtype=np.int64).reshape(-1, 2), pair)
    for k in np.flatnonzero((p[:, 1:].max(axis=1) >= CONFIDENT) & ~np.array(covered)).tolist():
        a, b = spans[k]
        word = texts[owner[k]][a:b]
        a, b = a + len(word) - len(word.lstrip(_EDGE)), b - len(word) + len(word.rstrip(_EDGE))
        if a < b:
            out[owner[k]].append((KINDS[int(p[k, 1:].argmax())], a, b))
    return out


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def fit_rows(docs: DataFrame, ident: str, text: str) -> list[tuple]:
    """Rows for ``fit`` from at most ``FIT_TOKENS`` tokens of about ``FIT_DOCS`` documents.

    Documents are those with the smallest hashes of id and text, and so are the tokens, by hashes of document and place: the
    same rows in any order of the files and at every size of the table.
    """
    share = FIT_DOCS / max(docs.count(), 1)
    key = F.coalesce(F.col(ident).cast("string"), F.lit("")), filled(F.col(text))
    sample = docs.filter(smallest_hashes(share, *key)).select(filled(F.col(text)).alias("text"), F.xxhash64(*key).alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value, key in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                spans, features, chain, skip = token_graph(value)
                labels = token_labels(spans, base_spans(value))
                before, after, similar = [-1] * len(spans), [-1] * len(spans), [-1] * len(spans)
                for a, b in chain:
                    before[b], after[a] = labels[a], labels[b]
                for a, b in skip:
                    similar[a], similar[b] = labels[b], labels[a]
                rows += list(zip(features, labels, before, after, similar, [key] * len(spans), range(len(spans)), strict=True))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = (pa.list_(pa.int32()), *[pa.int32()] * 4, pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["f", "y", "a", "b", "s", "key", "at"])

    tokens = sample.mapInArrow(run, "f array<int>, y int, a int, b int, s int, key bigint, at int")
    rows = tokens.orderBy(F.xxhash64("key", "at"), "key", "at").limit(FIT_TOKENS).drop("key", "at").toPandas()
    return [(list(f), *map(int, rest)) for f, *rest in rows.itertuples(index=False)]


def personal_data(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: counts of base spans, digest of the base spans, and all spans with those added.

    NULL and empty texts have no spans. Without any token to learn from, nothing is added. Repeated rows are each
    reported; NULL ids stay NULL. Spans are code points, end exclusive.
    """
    weights = fit(fit_rows(docs, ident, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            bases = [base_spans(t) for t in texts]
            more = added_spans(texts, bases, weights)
            counts = [pa.array([sum(s[0] == kind for s in b) for b in bases], pa.int64()) for kind in KINDS]
            digests = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in bases]
            every = [_joined(b + m) for b, m in zip(bases, more, strict=True)]
            added = pa.array([len(m) for m in more], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(digests, pa.string()), pa.array(every, pa.string()), added],
                [ident, *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"],
            )

    chosen = docs.select(F.col(ident), filled(F.col(text)).alias("text"))
    kind = docs.schema[ident].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return chosen.mapInArrow(run, f"`{ident}` {kind}, {counts}, base_sha256 string, spans string, n_added bigint")
