import hashlib
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from listrata.llm import personal_data
from listrata.llm.registry import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if valid(k, m[0])] for k, p in PATTERNS.items()}


TEXTS = [
    None, "", "a.b@c.de", "a@b", "x@y.z_d@e.ff @q.w a@@b.cc", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.2.3.255", "4111 1111 1111 1111",
    "4111-1111-1111-1112", "41111111111111111", "+49 (030) 123-4567 +1 +1234567890123456", "é 🙂 4111111111111111 é", "1" * 5000,
    "9." * 3000, "a" * 5000 + "@", "+" * 300 + "1" * 300, 'token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"',
    'token = "ab8ca1b325bc4f85aa6a79e73fc4cbfc2098878e" x', "version 3 page 12345678", "abcdefghijklmnopqrstuvwxyz", "12 34567 89",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    assert personal_data.base_spans(text or "") == brute(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1 9.@-+()_%é25", max_size=40))
def test_any_text(text):
    assert personal_data.base_spans(text) == brute(text)


def test_rows(documents):
    rows = personal_data.spans(documents(list(enumerate(TEXTS))))
    for r in rows.collect():
        found = brute(TEXTS[r["doc_id"]])
        base = ",".join(f"{k}:{a}:{b}" for k in PATTERNS for a, b in found[k])
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [len(found[k]) for k in PATTERNS]
        assert r["spans"].startswith(base)
        if "token" in (TEXTS[r["doc_id"]] or ""):
            assert "secret:9:49" in r["spans"]
    assert personal_data.spans(documents([])).count() == 0
    assert personal_data.spans(documents([(1, None), (1, None), (None, "x")])).count() == 3


def test_redaction(documents):
    docs = documents([(1, "mail a@b.cc now"), (2, None)])
    cleaned = personal_data.redact(docs)
    assert cleaned.schema == docs.schema
    assert {r["doc_id"]: r["text"] for r in cleaned.collect()} == {1: "mail <email> now", 2: None}


def test_labelers_are_weighed():
    """Three labelers that agree with the truth and two that vote at random."""
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.4
    votes = np.zeros(len(truth), np.int64)
    for i in range(personal_data.LABELERS):
        right = rng.random(len(truth)) < (0.9 if i < 3 else 0.5)
        votes += np.where(truth == right, 2, 0) * 3**i
    patterns, where, counts = np.unique(votes, return_inverse=True, return_counts=True)
    likely = personal_data.aggregate(patterns, counts)[where]
    assert ((likely >= 0.5) == truth).mean() > 0.95


def test_query_against_brute_force(spark):
    import listrata.llm.queries  # noqa: F401

    folder = "/root/testdata/sf0.001"
    docs = pd.read_parquet(f"{folder}/documents.parquet").set_index("doc_id").text
    for r in QUERIES["op7_personal_data"](spark, folder).collect():
        found = brute(docs[r["doc_id"]])
        base = ",".join(f"{k}:{a}:{b}" for k in PATTERNS for a, b in found[k])
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
