"""Personal data against the plain patterns."""

import hashlib
import random
import re

from llm_helpers import CLASHES, documents

from cellflow.llm.pii import ADDED, BASE, find_personal_data, mask
from cellflow.llm.queries import LLM_QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0,
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, kind, m.end()))
    return sorted(out)


TEXTS = [
    None, "", "none here", "a@b.c_d@e.f.g@h.i", "é a@b.co, 1.2.3.4.5.6.7.8 and 0001.002.3.255 999.1.1.1",
    "4111 1111 1111 1111 or 4111-1111-1111-1111 or 4111 1111  1111 1111", "+1 (974) 555-3436 +1(2)3 +44 20 7946 0958.",
    "x" * 9000, "1" * 9000, "a.b" * 3000 + "@", "@".join(["a.b"] * 2000), "1.2.3.4 " * 3000,
    "+4111 1111 1111 1111 123 4111111111111111", "SSN 123-45-6789, call (212) 555-0187 today. Dear Mr. John Smith, IBAN DE89 3704 0044 0532 0130 00.",
    "😀 mail 𝒳@x.org a@x.org", "a@b.co\na@b.co",
]


def rows_of(docs):
    out = {}
    for r in find_personal_data(docs).collect():
        out.setdefault(r.doc_id, []).append([(s.start, s.kind_no, s.kind, s.end) for s in r.found or []])
    return out


def test_base_spans_are_those_of_the_plain_patterns(spark):
    rng = random.Random(3)
    noise = ["".join(rng.choice("a1.@+- ()é\n259") for _ in range(rng.randint(0, 120))) for _ in range(250)]
    texts = TEXTS + noise + ["a@b.co\na@b.co"] * 3
    got = rows_of(documents(spark, texts, extra=CLASHES).repartition(3))
    for i, t in enumerate(texts):
        assert [s for s in got[i][0] if s[2] in BASE] == brute(t), t


def test_added_spans(spark):
    rng = random.Random(5)
    d = lambda n: "".join(rng.choice("23456789") for _ in range(n))
    texts = [f"my social security id {d(3)}-{d(2)}-{d(4)} and phone ({d(3)}) {d(3)}-{d(4)} as told" for _ in range(80)]
    texts += [f"order {d(3)}-{d(2)}-{d(4)}x page 111-11-1111" for _ in range(30)] + texts[:1] * 3
    found = rows_of(documents(spark, texts))
    kinds = [{s[2] for s in found[i][0]} for i in range(len(texts))]
    assert all(k <= set(BASE) | set(ADDED) for k in kinds)
    assert sum({"national_id", "phone_local"} <= k for k in kinds[:80]) >= 70
    assert not any(kinds[80:110]) and found[110] == found[0]


def test_mask(spark):
    docs = documents(spark, TEXTS + ["4111 1111 1111 1111"], ids=[*range(len(TEXTS)), 0], extra=CLASHES)
    masked = mask(docs)
    assert masked.columns == docs.columns
    got = {(r.doc_id, r.text, r.n_chars) for r in masked.collect()}
    assert (0, None, None) in got and (0, "[CARD]", 6) in got and (2, "none here", 9) in got
    assert (15, "[EMAIL]\n[EMAIL]", 15) in got
    assert all(not [s for s in brute(t) if s[2] != "card"] for _, t, _ in got if t)


def test_empty_table(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert find_personal_data(docs).count() == 0 and mask(docs).count() == 0


def test_query(spark, sf):
    rows = LLM_QUERIES["op1_personal_data"](spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        line = ",".join(f"{s[2]}:{s[0]}:{s[3]}" for s in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert r.n_email == sum(s[2] == "email" for s in want) and set(line.split(",")) <= set(r.spans.split(","))
