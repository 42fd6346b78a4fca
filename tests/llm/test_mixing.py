"""Mixing sources to target weights: against SQL, against a sort in Python, and the texts of the mix."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from llm_helpers import CLASHES, duck, same_rows

from cellflow.llm import mixing
from cellflow.llm.mixing import mix, mixed_texts, targets
from cellflow.llm.oracles import LLM_ORACLES
from cellflow.llm.queries import LLM_QUERIES


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_against_sql(spark, sf, scale):
    folder = sf.replace("0.001", scale)
    same_rows(LLM_QUERIES["op11_mixing"](spark, folder), duck(folder), LLM_ORACLES["op11_mixing"])


def shared_out(sizes, weights=(1, 2, 3), most=3):
    """Targets by sharing the excess again and again, in exact fractions."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        among = sum(weight[s] for s in names if s not in full)
        target = {s: Fraction(most * sizes[s]) if s in full else Fraction(left * weight[s], among) for s in names}
        above = {s for s in names if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows):
    """{row number: (size, target, taken)} by sorting on the hash."""
    sizes, groups = Counter(), defaultdict(lambda: defaultdict(list))
    for n, (i, text, source) in enumerate(rows):
        sizes[source] += len(words(text))
        name = hashlib.md5(f"{'' if i is None else i}\n{text or ''}".encode()).hexdigest()[:15]
        groups[source][name].append(n)
    target = shared_out(sizes)
    out = {}
    for source, places in groups.items():
        passes, budget = divmod(int(target[source] + Fraction(1, 2)), sizes[source]) if sizes[source] else (0, 0)
        for name in sorted(places):
            own = {n: len(words(rows[n][1])) for n in places[name]}
            tied, given = sum(own.values()), min(budget, sum(own.values()))
            for n, size in own.items():
                out[n] = (size, float(target[source]), passes * size + (given * size // tied if tied else 0))
            budget -= given
    return out


def frame(spark, rows, extra=()):
    schema = "doc_id bigint, text string, source string" + "".join(f", `{e}` string" for e in extra)
    return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], schema)


CASES = [
    *[(i, "word " * (i % 17), f"s{i % 4}") for i in range(200)],
    *[(1000 + i, " a b\tc \n", None) for i in range(9)],
    *[(7, "same text here", "copies") for _ in range(90)],  # equal in id and text
    *[(None, f"{i} has no id", "copies") for i in range(12)],
    (2000, None, "nothing"), (2001, "", "nothing"), (2002, " \t ", "nothing"), (2003, "x " * 30_000, "long"), (2004, "y", "long"), (2005, "é 漢字 \x85 z", ""),
]


def test_cases(spark):
    want = brute(CASES)
    got = mix(frame(spark, CASES, [*CLASHES, "size", "target", "taken", "cut", "part", "_source"]).repartition(5)).collect()
    assert sorted((r.size, r.target, r.taken) for r in got) == sorted(want.values())
    by_source = defaultdict(int)
    for r in got:
        by_source[r.source] += r.taken
        assert r.taken <= 3 * r.size
    target = {r.source: r.target for r in got}
    copies = 90  # rows of one hash each round their share down
    assert all(abs(by_source[s] - target[s]) <= (copies if s == "copies" else 0.5) for s in target)
    again = mix(frame(spark, CASES).repartition(2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_sources_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCES", 2)
    got = mix(frame(spark, CASES)).collect()
    assert sorted((r.size, r.target, r.taken) for r in got) == sorted(brute(CASES).values())


def test_texts_of_the_mix(spark):
    rows = [(i, f" a{i}  b\nc{i} d ", f"s{i % 3}") for i in range(40)] + [(99, None, "s0"), (100, "lone", "tiny")]
    taken = {r.doc_id: (r.taken, r["size"]) for r in mix(frame(spark, rows)).collect()}
    texts = {i: t for i, t, _ in rows}
    copies = defaultdict(list)
    for r in mixed_texts(frame(spark, rows)).collect():
        copies[r.doc_id].append((r.repeat, r.text))
    for i, (n, size) in taken.items():
        own = sorted(copies[i])
        assert sum(len(words(t)) for _, t in own) == n
        assert [k for k, _ in own] == list(range(-(-n // size) if n else 0))
        assert all(t == texts[i] if len(words(t)) == size else texts[i].startswith(t) for _, t in own)


def test_targets(spark):
    for sizes in ({"a": 10, "b": 1, "c": 1}, {"a": 1, "b": 1000, None: 3}, {"a": 0}, {"a": 0, "b": 5}, {f"{i:02d}": (i * 37) % 101 for i in range(50)}):
        got = {r.source: r.target for r in targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()}
        assert got == pytest.approx({s: float(t) for s, t in shared_out(sizes).items()})


def test_empty_table_and_plan(spark):
    assert mix(frame(spark, CASES).limit(0)).count() == 0
    assert mixed_texts(frame(spark, CASES).limit(0)).count() == 0
    plan = mix(frame(spark, CASES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
