"""Secret scan with a trigram inverted index (operator 9).

From every rule's expression a Boolean query over trigrams is derived: an OR of ANDs of three-letter pieces that any
match must contain, in lower case. The index holds, for each trigram that some rule asks for, the documents that contain
it; postings are intersected per AND branch, and only candidates are searched with the expression itself. A rule without
mandatory trigrams (long hex runs) scans every text.

Spans are the leftmost non-overlapping matches of a rule in code points, end exclusive; a match that fails the rule's
check is dropped and not retried. Null or empty texts have no spans. Rows that repeat an identifier share candidates
but are searched each in their own text; rows without identifier work alike. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as kinds
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelledger.llm.common import table, text_rows
from parcelledger.llm.spans import SPAN, find_spans, joined

#: A branch set of more alternatives than this is not spelled out; the rule then relies on its other parts.
MOST_BRANCHES = 32


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    passes: Callable[[Column], Column] | None = None
    base: bool = False


ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
)

# The expressions and lengths of the kinds. Java syntax; possessive where nothing can follow.
RULES = (
    Rule("assign", ASSIGN, lambda hit: F.char_length(F.regexp_extract(hit, ASSIGN, 1)) >= 8, True),
    Rule("access", r"AKIA[A-Z0-9]++", lambda hit: F.char_length(hit) >= 16, True),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}+", None, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{20,}+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}+"),
    Rule("bearer", r"(?i:authorization)\x20*:\x20*(?i:bearer)\x20+[A-Za-z0-9._~+/=-]{16,}+"),
)


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The OR of AND sets of trigrams that a match contains; an empty list when none is mandatory.

    An expression is walked from left to right with the set of strings the text may hold up to here. Where that set
    ends (a class, a repetition), its trigrams are added to the branch it belongs to.
    """
    branches = _walk(list(parser.parse(pattern)), [("", frozenset())])
    sets = [found | _trigrams(text) for text, found in branches]
    if any(not s for s in sets):
        return []
    return [s for s in dict.fromkeys(sets) if not any(other < s for other in sets)]


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _closed(branches: list[tuple[str, frozenset[str]]]) -> list[tuple[str, frozenset[str]]]:
    return list(dict.fromkeys(("", found | _trigrams(text)) for text, found in branches))


def _walk(nodes: list, branches: list[tuple[str, frozenset[str]]]) -> list[tuple[str, frozenset[str]]]:
    for kind, value in nodes:
        if kind is kinds.LITERAL:
            branches = [(text + chr(value).lower(), found) for text, found in branches]
        elif kind is kinds.SUBPATTERN:
            branches = _walk(list(value[3]), branches)
        elif kind is kinds.BRANCH:
            branches = [b for option in value[1] for b in _walk(list(option), branches)]
        elif kind is kinds.IN and all(k is kinds.LITERAL for k, _ in value) and len(value) <= 8:
            branches = [(text + chr(c).lower(), found) for text, found in branches for _, c in value]
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
            least, most, inner = value
            if (least, most) == (0, 1):
                branches = branches + _walk(list(inner), branches)
            else:
                for _ in range(least if len(inner) == 1 and inner[0][0] is kinds.LITERAL else 0):
                    branches = _walk(list(inner), branches)
                branches = _closed(branches) if most != least or not _literal(inner) else branches
        elif kind in (kinds.AT, kinds.ASSERT, kinds.ASSERT_NOT):
            pass
        else:
            branches = _closed(branches)
        branches = list(dict.fromkeys(branches))
        if len(branches) > MOST_BRANCHES:
            branches = _closed(branches)
    return branches


def _literal(inner: list) -> bool:
    return len(inner) == 1 and inner[0][0] is kinds.LITERAL


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, rules): the indexed rules whose trigram query a document satisfies."""
    branches = [(r, b) for r, rule in enumerate(rules) for b in trigram_query(rule.pattern)]
    grams = sorted({g for _, branch in branches for g in branch})
    number = {g: i for i, g in enumerate(grams)}
    lower = docs.select("doc_id", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]))
    postings = lower.select("doc_id", F.explode(held).alias("gram"))

    wanted = [
        (number[g], b, r, 1 << k, (1 << len(branch)) - 1)
        for b, (r, branch) in enumerate(branches)
        for k, g in enumerate(sorted(branch))
    ]
    # As many rows as the rules have trigrams.
    asked = docs.sparkSession.createDataFrame(wanted, "gram int, branch int, rule int, bit long, full long")
    met = (
        postings.join(F.broadcast(asked), "gram")
        .groupBy("doc_id", "branch", "rule", "full")
        .agg(F.bit_or("bit").alias("seen"))
        .filter("seen = full")
    )
    return met.groupBy("doc_id").agg(F.collect_set("rule").alias("rules"))


def _passing(spans: Column, test: Callable[[Column], Column]) -> Column:
    return F.filter(spans, lambda s: test(s["hit"]))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, found): per row of ``docs`` one array of spans for every rule, in the order of the rules."""
    rows = text_rows(docs)
    may = candidates(rows, rules).withColumnRenamed("doc_id", "named")
    both = rows.join(may, rows["doc_id"].eqNullSafe(may["named"]), "left")
    indexed = [bool(trigram_query(rule.pattern)) for rule in rules]
    found = []
    for r, rule in enumerate(rules):
        spans = find_spans(F.col("text"), rule.pattern, rule.name, r)
        if rule.passes is not None:
            spans = _passing(spans, rule.passes)
        if indexed[r]:
            spans = F.when(F.array_contains("rules", F.lit(r)), spans)
        found.append(F.coalesce(spans, F.array().cast(SPAN)).alias(rule.name))
    return both.select("doc_id", *found)


def report(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and digest of the base kinds, and all spans as text."""
    base = [rule.name for rule in rules if rule.base]
    return found.select(
        "doc_id",
        *[F.size(name).cast("long").alias(f"n_{name}") for name in base],
        F.sha2(joined(F.concat(*base)), 256).alias("base_sha256"),
        joined(F.concat(*[rule.name for rule in rules])).alias("spans"),
    )


def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document."""
    return report(scan(table(spark, folder, "documents")))
