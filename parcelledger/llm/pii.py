"""Personal data by weak supervision (operator 4).

Candidate spans come from the base expressions and from looser ones. Labelers vote on each candidate with yes, no or
nothing: the expression itself, a validity check, a gazetteer of endings, prefixes and ranges, and the words in front.
Expectation-maximisation over the counts of vote patterns estimates, for each kind, how reliable every labeler is and how
likely a pattern is to be personal data. With these soft labels a naive Bayes classifier over the votes and the
shape of the span is trained; it decides about the loose candidates. Base spans that pass their check always stay.

The counts behind both models cover all candidates of all rows; what reaches the driver is one row per kind and vote
pattern, and one per kind and feature value, both bounded by the lists below. Null or empty texts have no spans; rows
that repeat an identifier are judged each for itself; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelledger.llm.common import stored, table, text_rows
from parcelledger.llm.spans import find_spans, joined

ROUNDS = 25
CONTEXT = 24


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    """Whether the digits pass the checksum of payment cards."""
    digits = F.reverse(F.filter(F.split(_digits(hit), ""), lambda d: d != ""))
    values = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")),
    )
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _address(hit: Column) -> Column:
    parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.char_length(p) <= 3) & (p.try_cast("int") <= 255))


def _count(low: int, high: int) -> Callable[[Column], Column]:
    return lambda hit: F.char_length(_digits(hit)).between(low, high)


def _always(hit: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    passes: Callable[[Column], Column]
    base: bool
    group: str
    gazetteer: str
    near: str
    #: Matches of fewer digits are no candidates: every number in a text would be one.
    least_digits: int = 0


# The base expressions in Java syntax. \G lets a match begin right where the one before ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
ADDRESS = r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

MAIL_ENDS = r"\.(?:com|org|net|edu|gov|info|io|de|fr|es|eu|uk|us)$"
DIAL = r"^\+?(?:1|33|34|44|49|0)"
ISSUER = r"^(?:4|5[1-5]|3[47]|6011|65|2[2-7])"
NEAR_MAIL = r"(?i)(?:e-?mail|mail|contact|correo|courriel|kontakt|write to|schreib|écri)"
NEAR_PHONE = r"(?i)(?:phone|tel|call|fax|mobile|handy|móvil|teléfono|téléphone|portable|whatsapp)"
NEAR_CARD = r"(?i)(?:card|visa|master|amex|karte|tarjeta|carte|iban|account|konto|cuenta|compte)"
NEAR_HOST = r"(?i)(?:\bip\b|host|server|address|from|client|addr|login)"
NOT_NEAR = r"(?i)(?:version|isbn|order|invoice|page|no\.|nr\.|ref|seite|artikel|v\.?\s*$)"

KINDS = (
    Kind("email", EMAIL, _always, True, "email", MAIL_ENDS, NEAR_MAIL),
    Kind("ip", ADDRESS, _address, True, "ip", r"^(?:10\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.|[1-9])", NEAR_HOST),
    Kind("card", CARD, lambda h: _count(14, 19)(h) & luhn(h), True, "card", ISSUER, NEAR_CARD, 12),
    Kind("phone", PHONE, _count(10, 15), True, "phone", DIAL, NEAR_PHONE, 7),
    Kind(
        "email_spelled",
        r"(?<![A-Za-z0-9])[A-Za-z0-9._-]{2,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{2,63}+(?:(?:\x20?[\[(](?:dot|DOT)[\])]\x20?|\.)[A-Za-z]{2,63}+)+",
        _always, False, "email", r"(?i)(?:com|org|net|edu|de|fr|es|eu)$", NEAR_MAIL,
    ),
    Kind("phone_local", r"(?<![0-9+.-])\(?0[0-9]{2,4}\)?[\x20/-][0-9]{3,4}[\x20-]?[0-9]{3,4}(?![0-9.-])", _count(9, 12), False, "phone", DIAL, NEAR_PHONE),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?![A-Za-z0-9])", _always, False, "card", r"^(?:DE|FR|ES|IT|NL|BE|AT|CH|GB|PT)", NEAR_CARD),
    Kind("id_number", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _always, False, "id", r"^(?!000|666|9)", r"(?i)(?:ssn|social|security|id)"),
)
LABELERS = ("expression", "check", "gazetteer", "context")
YES, NO, NONE = 1, 0, -1


def _candidates(text: Column, number: int, kind: Kind) -> Column:
    """Spans of one kind with votes and features: array of (start, rank, stop, kind, hit, valid, votes, features)."""

    def judged(s: Column) -> Column:
        hit = s["hit"]
        before = F.substring(text, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT)))
        valid = kind.passes(hit)
        votes = F.array(
            F.lit(YES if kind.base else NONE),
            F.when(valid, YES).otherwise(NO),
            F.when(hit.rlike(kind.gazetteer), YES).otherwise(NO),
            F.when(before.rlike(kind.near), YES).when(before.rlike(NOT_NEAR), NO).otherwise(NONE),
        )
        size = F.char_length(hit)
        digits = F.char_length(_digits(hit))
        features = F.array(
            F.concat(F.lit("votes:"), F.array_join(votes.cast("array<string>"), ",")),
            F.concat(F.lit("size:"), F.least(F.floor(size / 4), F.lit(12)).cast("string")),
            F.concat(F.lit("digits:"), F.floor(4 * digits / size).cast("string")),
            F.concat(F.lit("before:"), F.when(before.rlike(r"[:=]\s*$"), "mark").when(before.rlike(r"\s$"), "gap").when(before == "", "start").otherwise("other")),
        )
        return F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"),
            valid.alias("valid"), votes.alias("votes"), features.alias("features"),
        )

    spans = find_spans(text, kind.pattern, kind.name, number)
    if kind.least_digits:
        spans = F.filter(spans, lambda s: F.char_length(_digits(s["hit"])) >= kind.least_digits)
    return F.transform(spans, judged)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, one array of judged spans for each kind)."""
    rows = text_rows(docs)
    return rows.select("doc_id", *[_candidates(F.col("text"), n, kind).alias(kind.name) for n, kind in enumerate(KINDS)])


def _spread(found: DataFrame) -> DataFrame:
    """One row per candidate."""
    every = F.concat(*[kind.name for kind in KINDS])
    groups = F.create_map(*[x for kind in KINDS for x in (F.lit(kind.name), F.lit(kind.group))])
    one = found.select(F.explode(every).alias("s")).select("s.kind", "s.votes", "s.features")
    return one.withColumn("group", F.element_at(groups, F.col("kind")))


def estimate(patterns: list[tuple[str, tuple[int, ...], int]]) -> dict[tuple[str, tuple[int, ...]], float]:
    """P(personal | votes) for each group and vote pattern, by expectation-maximisation over their counts.

    Starts from the share of yes among the votes cast. Each labeler has a distribution over yes, no and nothing for
    either class; counts are smoothed by one.
    """
    groups: dict[str, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for group, votes, n in patterns:
        groups[group].append((votes, n))
    belief: dict[tuple[str, tuple[int, ...]], float] = {}
    for group, rows in groups.items():
        post = []
        for votes, _ in rows:
            cast = [v for v in votes if v != NONE]
            post.append((sum(cast) + 0.5) / (len(cast) + 1))
        for _ in range(ROUNDS):
            total = sum(n for _, n in rows)
            yes = sum(p * n for p, (_, n) in zip(post, rows, strict=True))
            prior = (yes + 1) / (total + 2)
            table_ = {}
            for j in range(len(LABELERS)):
                for v in (YES, NO, NONE):
                    a = sum(p * n for p, (votes, n) in zip(post, rows, strict=True) if votes[j] == v)
                    b = sum((1 - p) * n for p, (votes, n) in zip(post, rows, strict=True) if votes[j] == v)
                    table_[j, v] = ((a + 1) / (yes + 3), (b + 1) / (total - yes + 3))
            for i, (votes, _) in enumerate(rows):
                odds = math.log(prior / (1 - prior)) + sum(
                    math.log(table_[j, v][0] / table_[j, v][1]) for j, v in enumerate(votes)
                )
                post[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        belief.update({(group, votes): p for p, (votes, _) in zip(post, rows, strict=True)})
    return belief


def train(found: DataFrame) -> dict[str, float]:
    """Log odds of every "group|feature" and of every "group" alone."""
    spread = _spread(found)
    counted = spread.groupBy("group", "votes", "features").agg(F.count(F.lit(1)).alias("n"))
    counted = stored(counted, "pii-counts")
    patterns = [
        (r["group"], tuple(r["votes"]), r["n"])
        for r in counted.groupBy("group", "votes").agg(F.sum("n").alias("n")).collect()
    ]
    belief = estimate(patterns)
    if not belief:
        return {}
    # One row per group and vote pattern.
    known = found.sparkSession.createDataFrame(
        [(g, list(v), p) for (g, v), p in belief.items()], "`group` string, votes array<int>, belief double"
    )
    soft = counted.join(F.broadcast(known), ["group", "votes"]).select(
        "group", "n", "belief", F.explode(F.array_append("features", F.lit(""))).alias("feature")
    )
    sums = soft.groupBy("group", "feature").agg(
        F.sum(F.col("belief") * F.col("n")).alias("yes"), F.sum((1 - F.col("belief")) * F.col("n")).alias("no")
    )
    rows = {(r["group"], r["feature"]): (r["yes"], r["no"]) for r in sums.collect()}
    weights = {}
    for (group, feature), (yes, no) in rows.items():
        all_yes, all_no = rows[group, ""]
        if feature == "":
            weights[group] = math.log((yes + 1) / (no + 1))
        else:
            weights[f"{group}|{feature}"] = math.log((yes + 1) / (all_yes + 2)) - math.log((no + 1) / (all_no + 2))
    return weights


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added): the base spans of each row, and those that the classifier adds."""
    found = stored(candidates(docs), "pii-candidates")
    weights = train(found) or {"": 0.0}
    literal = F.from_json(
        F.lit("{" + ",".join(f'"{k}":{v:.6f}' for k, v in weights.items()) + "}"), "map<string,double>"
    )
    short = "array<struct<start:int,rank:int,stop:int,kind:string>>"

    def trim(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"))

    def score(group: str) -> Callable[[Column], Column]:
        def total(s: Column) -> Column:
            start = F.coalesce(F.element_at(literal, F.lit(group)), F.lit(0.0))
            return F.aggregate(
                s["features"],
                start,
                lambda a, f: a + F.coalesce(F.element_at(literal, F.concat(F.lit(f"{group}|"), f)), F.lit(0.0)),
            )

        return total

    def added(kind: Kind) -> Column:
        total = score(kind.group)
        return F.filter(F.col(kind.name), lambda s: s["valid"] & (total(s) >= 0))

    base = [F.filter(F.col(k.name), lambda s: s["valid"]) for k in KINDS if k.base]
    return found.select(
        "doc_id",
        F.transform(F.concat(*base), trim).cast(short).alias("base"),
        F.transform(F.concat(*[added(k) for k in KINDS if not k.base]), trim).cast(short).alias("added"),
    )


def _number_of(rank: int) -> Column:
    return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base kinds, and all spans as text."""
    counts = [_number_of(n).alias(f"n_{k.name}") for n, k in enumerate(KINDS) if k.base]
    digest = F.sha2(joined(F.col("base")), 256).alias("base_sha256")
    return detect(docs).select("doc_id", *counts, digest, joined(F.concat("base", "added")).alias("spans"))


def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    return report(table(spark, folder, "documents"))
