"""Personal data: fixed patterns, and further spans by weak supervision.

The base patterns find email and IP addresses, payment cards and telephone numbers. Further
candidates are runs of letters and digits that look like keys, and numbers that no base pattern takes.
Labelers vote on each candidate by its shape, by words of a gazetteer near it and by its context;
expectation-maximisation over the counts of all vote patterns of the corpus estimates how reliable
each labeler is and how likely each pattern is personal; a logistic classifier of the candidates'
features is trained on these likelihoods and decides.

Votes and features are a few bits per candidate, so their counts are complete statistics: both fits
use every candidate of the corpus and see a table whose size does not grow with it.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listrata.llm.frames import map_batches, slices

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "number")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A match never starts inside a run of digits whose first digit fails, so only run starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_RUN = re.compile(r"[0-9A-Za-z]*")
_DIGIT = re.compile(r"[0-9]")
#: The gazetteers of words that announce personal data, and of words that announce other numbers.
ANNOUNCING = frozenset(
    "token secret password passwd pwd key apikey auth bearer credential ssn passport account iban card visa mastercard "
    "phone tel mobile call fax contact schlüssel passwort kennwort telefon konto clave contraseña teléfono tarjeta cuenta "
    "mot passe clé téléphone compte carte".split()
)
OTHERWISE = frozenset("version license licence chapter page section figure table vol isbn year article".split())
_WORDS = re.compile(r"[^\W\d_]+")
NEAR = 40
LABELERS = 5
FEATURES = 10

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    """Leftmost matches of ``local@domain.tld``, found from the ``@`` outwards in linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append((start, match.end()))
            done = match.end()
        at = text.find("@", max(at + 1, done))
    return out


def is_ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def is_card(text: str) -> bool:
    digits = text.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 8 <= len(_DIGIT.findall(text)) <= 15


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of each base kind; matches that fail their check are dropped and not tried again."""
    return {
        "email": emails(text) if "@" in text else [],
        "ip": [m.span() for m in _IP.finditer(text) if is_ip(m[0])],
        "card": [m.span() for m in _CARD.finditer(text) if is_card(m[0])],
        "phone": [m.span() for m in _PHONE.finditer(text) if is_phone(m[0])] if "+" in text else [],
    }


def candidates(text: str, base: dict[str, list[Span]]) -> list[tuple[str, Span]]:
    """Keys (16 letters and digits or more, with both) and numbers (7 digits or more) outside the base spans."""
    taken = sorted(span for spans in base.values() for span in spans)
    out, done, i = [], 0, 0
    for match in _DIGITS.finditer(text):
        if match.start() < done:
            continue
        start = match.start()
        while start > done and text[start - 1].isascii() and text[start - 1].isalnum():
            start -= 1
        end = _RUN.match(text, match.end()).end()
        kind = "secret" if end - start >= 16 and not text[start:end].isdigit() else "number"
        if kind == "number":
            start = match.start()
            end = (_CARD.match(text, start) or match).end()
            if len(_DIGIT.findall(text[start:end])) < 7:
                done = max(done, match.end())
                continue
        done = end
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if not any(a < end and start < b for a, b in taken[i:i + 8]):
            out.append((kind, (start, end)))
    return out


def described(text: str, kind: str, span: Span) -> tuple[int, int]:
    """Votes (base 3: against, none, for) and feature bits of a candidate."""
    start, end = span
    body = text[start:end]
    digits = len(_DIGIT.findall(body))
    before, after = text[max(0, start - NEAR):start], text[end:end + 4]
    near = [w.lower() for w in _WORDS.findall(before)][-4:]
    announced, other = any(w in ANNOUNCING for w in near), any(w in OTHERWISE for w in near)
    assigned = bool(re.search(r"[=:]\s*[\"'`]?$", before))
    quoted = bool(re.search(r"[\"'`]$", before)) and after[:1] in "\"'`" and after != ""
    hexed = bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", body))
    varied = len(set(body)) / min(len(body), 16)
    joined = start > 0 and (text[start - 1].isalnum() or text[start - 1] in "/._-") or after[:1].isalnum()
    votes = (
        (1 if hexed and len(body) >= 24 or kind == "number" and 13 <= digits <= 19 else -1 if digits < 9 else 0),
        (1 if announced else -1 if other else 0),
        (1 if assigned or quoted else 0),
        (1 if varied >= 0.5 else -1 if varied < 0.25 else 0),
        (-1 if joined else 0),
    )
    features = (
        kind == "secret", hexed, assigned, quoted, announced, other, digits >= 13, len(body) >= 32, varied >= 0.5, joined
    )
    return sum((v + 1) * 3**i for i, v in enumerate(votes)), sum(int(f) << i for i, f in enumerate(features))


def pattern_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """How often each pair of votes and features occurs among the candidates of all texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for piece in slices(batch):
                for body in piece.column(0).to_pylist():
                    if body:
                        total.update(described(body, *c) for c in candidates(body, base_spans(body)))
        yield pa.RecordBatch.from_pydict(
            {"votes": [v for v, _ in total], "features": [f for _, f in total], "n": list(total.values())},
            schema=pa.schema([("votes", pa.int64()), ("features", pa.int64()), ("n", pa.int64())]),
        )

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    counted = rows.mapInArrow(run, "votes bigint, features bigint, n bigint")
    return counted.groupBy("votes", "features").agg(F.sum("n").alias("n"))


def aggregate(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Likelihood that each vote pattern is personal, by expectation-maximisation.

    Given the truth, labelers vote independently; each has its own chance of voting for, against or not
    at all in either case. It starts from the majority of votes.
    """
    cast = (votes[:, None] // 3 ** np.arange(LABELERS)) % 3
    likely = 1 / (1 + np.exp(-(cast - 1).sum(axis=1)))
    for _ in range(rounds):
        logs = []
        for part in (counts * likely, counts * (1 - likely)):
            total = part.sum()
            log = np.full(len(votes), np.log((total + 1) / (counts.sum() + 2)))
            for i in range(LABELERS):
                chance = (np.bincount(cast[:, i], part, 3) + 0.1) / (total + 0.3)
                log += np.log(chance[cast[:, i]])
            logs.append(log)
        likely = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50)))
    return likely


class Classifier:
    """Logistic regression over the feature bits."""

    def __init__(self, features: np.ndarray, likely: np.ndarray, counts: np.ndarray, rounds: int = 500):
        rows = self.matrix(features)
        self.weights = np.zeros(FEATURES + 1)
        share = counts / max(counts.sum(), 1)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(rows @ self.weights, -30, 30)))
            hessian = (rows * (share * p * (1 - p))[:, None]).T @ rows + 1e-4 * np.eye(FEATURES + 1)
            step = np.linalg.solve(hessian, rows.T @ (share * (likely - p)) - 1e-4 * self.weights)
            self.weights += np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-9:
                break
        self.personal = set(np.flatnonzero(self.matrix(np.arange(1 << FEATURES)) @ self.weights >= 0).tolist())

    @staticmethod
    def matrix(features: np.ndarray) -> np.ndarray:
        bits = (features[:, None] >> np.arange(FEATURES)) & 1
        return np.concatenate([bits, np.ones((len(features), 1))], axis=1).astype(float)


def train(docs: DataFrame, text: str = "text") -> Classifier | None:
    """The classifier of all candidates of ``docs``; none if there is no candidate."""
    rows = pattern_counts(docs, text).collect()  # at most 3^labelers times 2^features rows
    if not rows:
        return None
    votes, features, counts = (np.array([r[n] for r in sorted(rows)], np.int64) for n in ("votes", "features", "n"))
    return Classifier(features, aggregate(votes, counts), counts)


def find(text: str | None, classifier: Classifier | None) -> dict[str, list[Span]]:
    """Spans of each kind in code points, the end not included."""
    text = text or ""
    found = base_spans(text) | {kind: [] for kind in ADDED}
    if classifier is not None:
        for kind, span in candidates(text, {k: found[k] for k in BASE}):
            if described(text, kind, span)[1] in classifier.personal:
                found[kind].append(span)
    return found


def _listed(found: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind in kinds for start, end in found[kind])


def spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs`` the counts of base spans, their digest, and all spans as text.

    Null texts count as empty. Repeated rows are judged each. Other columns are not looked at. An empty
    table gives an empty table. Two passes over the texts, no shuffle of them.
    """
    kind = dict(docs.dtypes)[id]
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, text))

    def judge(columns: dict[str, list]) -> dict[str, list]:
        found = [find(t, shared.value) for t in columns["text"]]
        return {
            "id": columns["id"], **{f"n_{k}": [len(f[k]) for f in found] for k in BASE},
            "base_sha256": [hashlib.sha256(_listed(f, BASE).encode()).hexdigest() for f in found],
            "spans": [_listed(f, BASE + ADDED) for f in found],
        }

    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    counts = ", ".join(f"n_{k} bigint" for k in BASE)
    return map_batches(rows, judge, f"id {kind}, {counts}, base_sha256 string, spans string").withColumnRenamed("id", id)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets; columns stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, text))

    def clean(columns: dict[str, list]) -> dict[str, list]:
        return columns | {text: [t if t is None else _redacted(t, find(t, shared.value)) for t in columns[text]]}

    return map_batches(docs, clean, docs.schema)


def _redacted(text: str, found: dict[str, list[Span]]) -> str:
    out, done = [], 0
    for start, end, kind in sorted((a, b, kind) for kind, spans in found.items() for a, b in spans):
        if end > done:
            out.append(text[done:max(start, done)] + (f"<{kind}>" if start >= done else ""))
            done = end
    return "".join(out) + text[done:]
