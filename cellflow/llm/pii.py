"""Personal data by weak supervision, with SQL functions only.

Candidates of every kind come from one pattern each over whole texts. Positions are code points: ``split`` gives the gaps between
the matches, and a running sum of the lengths of gaps and matches gives every start. Five labelers (a strict pattern, a gazetteer
of cue words, the neighbouring characters, the shape, and contexts that speak against) vote for, against or not at all.
Expectation-maximisation over the table of vote patterns (at most 3**5 rows a kind, whatever the input) estimates how reliable
each labeler is; the posteriors are the labels on which a naive Bayes span classifier over surface features is trained.

Spans of the four base kinds are fixed by their patterns and tests and always stay, whatever their score. Spans of the
other kinds are added if both the posterior and the classifier accept them.

Spans depend on the text alone, so they are found per distinct text, keyed by its MD5; copies combine before the shuffle, and the
windows hold the matches of one text.

Defined cases: a null text is empty and has no spans; repeated rows each get their result; ids are not looked at; an empty table
gives no rows; other columns pass through ``mask`` unchanged.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellflow.llm.common import held, quoted, stored, text_of

#: Possessive loops and the looks behind make every pattern linear in the text; the matches are those of the plain patterns
#: email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, ip [0-9]+(\.[0-9]+){3}, card [0-9]([ -]?[0-9])+ of 12 digits and more,
#: phone \+[0-9][ ().0-9-]+[0-9].
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED = {
    "name": r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Mlle|Sr|Sra)\.? [A-Z][a-z]{1,30}(?: [A-Z][a-z]{1,30})?\b",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone_local": r"(?<![0-9+(.-])(?<!\+[0-9]{1,3} )(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])",
}
KINDS = [*BASE, *ADDED]
#: A text without this string has no match of the kind.
NEEDS = {"email": "@", "phone": "+"}

STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,12}$",
    "ip": r"^[1-9][0-9]{0,2}(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^[3-6](?:[0-9]{12,18}|[0-9]{3}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})$",
    "phone": r"^\+[1-9][0-9]{0,2}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){1,4}$",
    "name": r" [A-Z][a-z]+ [A-Z][a-z]+$",
    "iban": r"^(?:AT|BE|CH|DE|ES|FR|GB|IE|IT|LU|NL|PT)",
    "national_id": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "phone_local": r"^(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[.-])[2-9]",
}
GAZETTEER = {
    "email": "mail|contact|write|address|correo|courriel|kontakt",
    "ip": "ip|server|host|login|client|address|from",
    "card": "card|visa|master|credit|payment|karte|carte|tarjeta",
    "phone": "tel|phone|call|mobile|fax|cell|anruf|appel|llam",
    "name": "dear|by|from|contact|patient|signed|regards",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "national_id": "ssn|social|security|identity|id",
    "phone_local": "tel|phone|call|mobile|fax|cell",
}
AGAINST = r"(?i)(?:version|isbn|section|order|invoice|page|total|no\.|nr\.|#|v|=)\s*$"
CONTEXT = 40
LABELERS = ["strict", "gazetteer", "border", "shape", "against"]
VOTES = (-1, 0, 1)
ROUNDS = 12
ACCEPT = 0.9


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def valid(kind: Column, value: Column) -> Column:
    """The tests that a match of a base kind must pass."""
    digits = digits_of(value)
    n = F.length(digits)
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    low = F.forall(parts, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))
    return (
        F.when(kind == "ip", low).when(kind == "card", n.between(12, 19) & luhn(F.when(n.between(12, 19), digits).otherwise("0")))
        .when(kind == "phone", n.between(9, 15)).otherwise(True))


def candidates(docs: DataFrame, text: str) -> DataFrame:
    """(key, kind, start, end, value, before, after) of every valid match, once per distinct text."""
    rows = docs.select(text_of(text).alias("text"))
    patterns = {**BASE, **ADDED}

    def found(kind: str, what: Column) -> Column:
        need = NEEDS.get(kind)
        return what if need is None else F.when(F.contains("text", F.lit(need)), what).otherwise(F.array().cast("array<string>"))

    matches = {f"m_{k}": found(k, F.regexp_extract_all("text", F.lit(p), F.lit(0))) for k, p in patterns.items()}
    rows = held(rows, **matches)
    rows = rows.where(reduce(lambda a, b: a | b, [F.size(c) > 0 for c in matches]))
    gaps = {f"g_{k}": F.when(F.size(f"m_{k}") > 0, F.split("text", p, -1)) for k, p in patterns.items()}
    rows = held(rows, key=F.unhex(F.md5("text")), **gaps)

    def spans(kind: str) -> Column:
        m, g = f"m_{kind}", f"g_{kind}"
        return F.when(F.size(m) > 0, F.transform(
            F.arrays_zip(F.col(m).alias("value"), F.slice(g, 1, F.size(m)).alias("gap"), F.slice(g, 2, F.size(m)).alias("next")),
            lambda s, i: F.struct(
                F.lit(KINDS.index(kind)).alias("kind_no"), i.alias("i"), s["value"].alias("value"),
                F.length(s["gap"]).cast("bigint").alias("gap"), F.right(s["gap"], F.lit(CONTEXT)).alias("before"),
                F.left(s["next"], F.lit(CONTEXT)).alias("after"))))

    none = F.array().cast("array<struct<kind_no:int,i:int,value:string,gap:bigint,before:string,after:string>>")
    every = F.concat(*[F.coalesce(spans(k), none) for k in KINDS])
    rows = rows.select("key", F.inline(every))
    rows = rows.groupBy("key", "kind_no", "i").agg(*[F.first(c).alias(c) for c in ("value", "gap", "before", "after")])
    so_far = Window.partitionBy("key", "kind_no").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.repartition("key").withColumn("end", F.sum(F.col("gap") + F.length("value")).over(so_far))
    rows = rows.withColumn("start", F.col("end") - F.length("value"))
    kind = F.get(F.array(*map(F.lit, KINDS)), F.col("kind_no"))
    rows = rows.select("key", "kind_no", kind.alias("kind"), "start", "end", "value", "before", "after")
    return rows.where(valid(F.col("kind"), F.col("value")))


def by_kind(patterns: dict[str, str], test) -> Column:
    return reduce(lambda w, kp: w.when(F.col("kind") == kp[0], test(kp[1])), patterns.items(), F.when(F.lit(False), False))


def votes(spans: DataFrame) -> DataFrame:
    """Adds one column per labeler: 1 for, -1 against, 0 no vote."""
    before, after, value = F.lower("before"), F.col("after"), F.col("value")
    touching = F.col("before").rlike(r"[\p{L}\p{N}_]$") | after.rlike(r"^[\p{L}\p{N}_]")
    letters = F.length(F.regexp_replace(F.lower(value), "[^a-z0-9]", ""))
    kinds_of = F.size(F.array_distinct(F.split(F.regexp_replace(F.lower(value), "[^a-z0-9]", ""), "")))
    return spans.select(
        "*",
        F.when(by_kind(STRICT, value.rlike), 1).otherwise(-1).alias("strict"),
        F.when(by_kind(GAZETTEER, lambda p: before.rlike(rf"\b(?:{p})")), 1).otherwise(0).alias("gazetteer"),
        F.when(touching, -1).otherwise(1).alias("border"),
        F.when((letters >= 9) & (kinds_of <= 3), -1).when(kinds_of >= 6, 1).otherwise(0).alias("shape"),
        F.when(before.rlike(AGAINST), -1).otherwise(0).alias("against"))


def posterior(prior: dict[str, float], rates: dict) -> Column:
    """Probability that a candidate is personal data, given its votes."""
    odds = reduce(lambda w, k: w.when(F.col("kind") == k, math.log(prior[k] / (1 - prior[k]))), KINDS, F.when(F.lit(False), 0.0))
    for name in LABELERS:
        for vote in VOTES:
            odds = odds + F.when(F.col(name) == vote, math.log(rates[name, vote, 1] / rates[name, vote, 0])).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def reliabilities(patterns: DataFrame, rounds: int = ROUNDS) -> tuple[dict[str, float], dict]:
    """Expectation-maximisation over (kind, votes, n). Each round is one aggregate of a bounded table to a few dozen rows."""
    prior = dict.fromkeys(KINDS, 0.5)
    rates = {(name, vote, y): 0.6 if vote * (2 * y - 1) > 0 else 0.2 for name in LABELERS for vote in VOTES for y in (0, 1)}
    for _ in range(rounds):
        shares = patterns.withColumn("yes", F.col("n") * posterior(prior, rates))
        levels = [F.struct(F.lit("kind").alias("what"), F.col("kind").alias("level"))]
        levels += [F.struct(F.lit(name).alias("what"), F.col(name).cast("string").alias("level")) for name in LABELERS]
        sums = shares.select("n", "yes", F.inline(F.array(*levels))).groupBy("what", "level").agg(
            F.sum("yes").alias("yes"), F.sum("n").alias("n")).collect()
        seen = {(r["what"], r["level"]): (r["yes"], r["n"]) for r in sums}
        yes, every = (sum(seen.get(("kind", k), (0, 0))[i] for k in KINDS) for i in (0, 1))
        prior = {k: (seen.get(("kind", k), (0, 0))[0] + 1) / (seen.get(("kind", k), (0, 0))[1] + 2) for k in KINDS}
        for name in LABELERS:
            for vote in VOTES:
                own, both = seen.get((name, str(vote)), (0.0, 0))
                rates[name, vote, 1] = (own + 1) / (yes + 3)
                rates[name, vote, 0] = (both - own + 1) / (every - yes + 3)
    return prior, rates


def features() -> dict[str, Column]:
    """Surface features with few values each."""
    value, digits = F.col("value"), F.length(digits_of(F.col("value")))
    side = lambda c, p: (F.when(c == "", "none").when(c.rlike(p.format(r"\s")), "white").when(c.rlike(p.format(r"[\p{L}]")), "letter")
                         .when(c.rlike(p.format("[0-9]")), "digit").otherwise("other"))
    return {
        "kind": F.col("kind"),
        "length": F.least(F.floor(F.length(value) / 4), F.lit(12)).cast("string"),
        "digits": F.round(digits / F.length(value) * 4).cast("int").cast("string"),
        "before": side(F.col("before"), "{}$"), "after": side(F.col("after"), "^{}"),
        "blanks": F.least(F.length(F.regexp_replace(value, r"[^\s-]", "")), F.lit(5)).cast("string"),
    }


def classifier(labelled: DataFrame) -> Column:
    """Naive Bayes on soft labels ``p``: weights from one aggregate, a few dozen rows in all."""
    wanted = features()
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), c.alias("level")) for n, c in wanted.items()])
    sums = labelled.select(F.col("p"), F.inline(pairs)).groupBy("feature", "level").agg(
        F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    yes = sum(r["yes"] for r in sums if r["feature"] == "kind")
    no = sum(r["no"] for r in sums if r["feature"] == "kind")
    odds = F.lit(math.log((yes + 1) / (no + 1)))
    for name, column in wanted.items():
        levels = {r["level"]: r for r in sums if r["feature"] == name}
        for level, r in sorted(levels.items()):
            weight = math.log((r["yes"] + 1) / (yes + len(levels))) - math.log((r["no"] + 1) / (no + len(levels)))
            odds = odds + F.when(column == level, weight).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def spans_of_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, kind_no, kind, start, end, value, score) of the spans that stay, once per distinct text."""
    voted = stored(votes(candidates(docs, text)), "votes")
    patterns = stored(voted.groupBy("kind", *LABELERS).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    agreed = voted.withColumn("p", posterior(*reliabilities(patterns)))
    scored = agreed.withColumn("score", classifier(agreed))
    stays = F.col("kind").isin(list(BASE)) | ((F.col("p") >= ACCEPT) & (F.col("score") >= ACCEPT))
    return scored.where(stays).select("key", "kind_no", "kind", "start", "end", "value", "score")


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``found``: an array of (start, kind_no, kind, end, value, score), by start and kind.

    It replaces a column of that name.
    """
    spans = spans_of_texts(docs, text)
    lists = spans.groupBy(F.col("key").alias("_key")).agg(F.array_sort(F.collect_list(
        F.struct("start", "kind_no", "kind", "end", "value", "score"))).alias("found"))
    joined = _keyed(docs, text).join(lists, F.col("_text_key") == F.col("_key"), "left")
    return joined.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns if c != "found"], "found")


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """The rows as one value each, so that no name of theirs meets one used here, with the key of their text."""
    return docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_doc"), F.unhex(F.md5(text_of(text))).alias("_text_key"))


def mask(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in brackets, overlapping spans by the kind that starts first."""
    spans = spans_of_texts(docs, text)
    before = Window.partitionBy("key").orderBy("start", "kind_no").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("key").orderBy("start", "kind_no")
    islands = spans.withColumn("reach", F.max("end").over(before))
    new = F.col("reach").isNull() | (F.col("start") >= F.col("reach"))
    islands = islands.withColumn("island", F.sum(F.when(new, 1).otherwise(0)).over(upto))
    islands = islands.groupBy("key", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "kind_no")).alias("kind"))
    lists = islands.groupBy(F.col("key").alias("_key")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("_cuts"))
    own = F.col("_doc").getField(text)
    part = lambda s, from_: F.substring(own, (from_ + 1).cast("int"), (s["start"] - from_).cast("int"))
    pieces = F.transform("_cuts", lambda s, i: F.concat(
        part(s, F.when(i == 0, F.lit(0)).otherwise(F.get("_cuts", i - 1)["end"])), F.lit("["), F.upper(s["kind"]), F.lit("]")))
    tail = F.substring(own, (F.get("_cuts", F.size("_cuts") - 1)["end"] + 1).cast("int"), F.length(own))
    masked = F.when(F.col("_cuts").isNull(), own).otherwise(F.concat(F.array_join(pieces, ""), tail))
    joined = held(_keyed(docs, text).join(lists, F.col("_text_key") == F.col("_key"), "left"), _masked=masked)
    new = {text: F.col("_masked")}
    if length in docs.columns:
        new[length] = F.when(F.col("_cuts").isNull(), F.col("_doc").getField(length)).otherwise(
            F.length("_masked").cast(docs.schema[length].dataType))
    return joined.select(*[new.get(c, F.col("_doc").getField(c)).alias(c) for c in docs.columns])
