"""Urls judged by host rules and by a weighted vocabulary.

Rules name a host, a path prefix and a verdict; a rule holds for its host and all
subdomains, and the longest that fits decides. Urls no rule fits are searched for
vocabulary terms with an Aho-Corasick automaton. A term counts only with a
boundary on either side, which is any character other than an ASCII letter or
digit, or the end of the url. Every term has a weight, and each different one counts once:
where the weights add up to the limit the url is blocked. Strict terms have the limit itself
as weight, soft ones a part of it, so one strict or several different soft terms block.

A vocabulary is given as terms, with the ways to write their letters as digits, or read
from a table of terms and weights, which is bounded as every task holds it.

Defined cases: a null url, or one without ``://``, has an empty host and path, which
no rule fits; a null or empty url holds no term. Only A-Z are lower-cased. A port or a
user name is a part of the host as written. Of rules of equal length ``block``
wins. Repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import column, map_arrow

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
ALLOW, BLOCK = "allow", "block"

# Terms that settle the matter alone, and terms of which several must meet.
STRICT_TERMS = ("adult", "casino", "porn", "spam", "viagra", "xxx")
SOFT_TERMS = (
    "ads", "bet", "bets", "bonus", "cheap", "click", "deal", "deals", "farm",
    "free", "loan", "loans", "pills", "prize", "sex", "track", "win",
)
SOFT_LIMIT = 2
# Terms of which more must meet: each counts a quarter.
WEAK_TERMS = (
    "bingo", "cash", "coupon", "credit", "dating", "debt", "diet", "discount", "escort", "gamble",
    "jackpot", "lottery", "lucky", "offer", "poker", "promo", "replica", "sale", "slots", "torrent",
    "trial", "vip", "warez",
)
WEAK_WEIGHT = 0.25
LIMIT = 1.0
# Letters and the digits that stand for them.
DIGITS = {"a": "4", "e": "3", "i": "1", "o": "0", "s": "5"}
MOST_TERMS = 100_000


@dataclass(frozen=True)
class UrlRules:
    """Rules as (verdict, host + path prefix), such as ("block", "net/")."""

    rules: tuple[tuple[str, str], ...] = ()
    strict: tuple[str, ...] = STRICT_TERMS
    soft: tuple[str, ...] = SOFT_TERMS
    soft_limit: int = SOFT_LIMIT
    # Further terms with weights of their own; a term given twice has the larger weight.
    weights: tuple[tuple[str, float], ...] = ()
    limit: float = LIMIT

    def vocabulary(self) -> dict[str, float]:
        """The weight of each term."""
        out: dict[str, float] = {}
        given = [(t, self.limit / self.soft_limit) for t in self.soft]
        given += [(t, self.limit) for t in self.strict]
        for term, weight in (*given, *self.weights):
            if term:
                out[term] = max(weight, out.get(term, weight))
        return out


def with_digits(weights: Iterable[tuple[str, float]]) -> tuple[tuple[str, float], ...]:
    """The terms, and every way to write some of their letters as digits."""
    found: dict[str, float] = {}
    for term, weight in weights:
        ways = [(c, DIGITS[c]) if c in DIGITS else (c,) for c in term]
        for spelled in map("".join, product(*ways)):
            found[spelled] = max(weight, found.get(spelled, weight))
    return tuple(sorted(found.items()))


def read_vocabulary(table: DataFrame, term_column: str = "term", weight_column: str = "weight") -> tuple[tuple[str, float], ...]:
    """The terms of a table, lower-cased; those without term or weight do not count."""
    term = F.translate(column(term_column).cast("string"), UPPER, UPPER.lower()).alias("term")
    rows = table.select(term, column(weight_column).cast("double").alias("weight"))
    rows = rows.where("term <> '' AND weight IS NOT NULL AND NOT isnan(weight)")
    found = rows.groupBy("term").agg(F.max("weight")).take(MOST_TERMS + 1)
    if len(found) > MOST_TERMS:
        raise ValueError(f"a vocabulary has {MOST_TERMS} terms at most")
    return tuple(sorted((r[0], r[1]) for r in found))


class UrlJudge:
    """Verdicts of one set of rules, for use inside a task."""

    def __init__(self, spec: UrlRules):
        import ahocorasick

        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        # Longest first, block before allow: the first that fits wins.
        for verdict, rule in sorted(
            spec.rules, key=lambda r: (-len(r[1]), r[0] != BLOCK, r[1])
        ):
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))
        self.limit = spec.limit
        self.weights = spec.vocabulary()
        self.terms = ahocorasick.Automaton()
        for term in self.weights:
            self.terms.add_word(term, term)
        if self.weights:
            self.terms.make_automaton()

    def rule_of(self, host: str, path: str) -> tuple[str, str] | None:
        found: list[tuple[str, str]] = []
        suffix = host
        while suffix:
            for prefix, rule, verdict in self.by_host.get(suffix, ()):
                if path.startswith(prefix):
                    found.append((rule, verdict))
                    break
            suffix = suffix.partition(".")[2]
        return max(found, key=lambda r: (len(r[0]), r[1] == BLOCK), default=None)

    def hits(self, url: str) -> tuple[int, int, float]:
        """Numbers of different strict and soft terms in a lower-case url, and their weight."""
        found = set()
        if len(self.terms):
            for end, term in self.terms.iter(url):
                before, after = end - len(term), end + 1
                if before >= 0 and url[before] in WORD:
                    continue
                if after < len(url) and url[after] in WORD:
                    continue
                found.add(term)
        strict = sum(self.weights[t] >= self.limit for t in found)
        return strict, len(found) - strict, sum(self.weights[t] for t in found)

    def verdict_of(self, weight: float) -> str:
        # Weights such as thirds may fall short of the limit by their rounding.
        return BLOCK if weight >= self.limit - 1e-9 else ALLOW


def judge_urls(
    pages: DataFrame, spec: UrlRules, *, id_column: str = "page_id", url_column: str = "url"
) -> DataFrame:
    """id, host, path, rule, verdict and term counts of every row."""
    url = F.coalesce(column(url_column).cast("string"), F.lit(""))
    # Under names of its own, as the id may be called like any of the columns made here.
    rows = pages.select(column(id_column).alias("_id"), url.alias("_url"))
    # What follows the first "://"; nothing of it may be a host without that mark.
    rest = F.when(F.instr("_url", "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    split = rows.select(
        "_id",
        host.alias("host"),
        path.alias("path"),
        F.translate("_url", UPPER, UPPER.lower()).alias("_low"),
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judges = UrlJudge(spec)
        for batch in batches:
            ids, hosts, paths, urls = batch.columns
            out: tuple[Sequence, ...] = ([], [], [], [])
            values = zip(hosts.to_pylist(), paths.to_pylist(), urls.to_pylist())
            for host, path, url in values:
                strict, soft, weight = judges.hits(url)
                rule = judges.rule_of(host, path)
                verdict = rule[1] if rule else judges.verdict_of(weight)
                for target, value in zip(out, (rule and rule[0], verdict, strict, soft)):
                    target.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    hosts,
                    paths,
                    pa.array(out[0], pa.string()),
                    pa.array(out[1], pa.string()),
                    pa.array(out[2], pa.int32()),
                    pa.array(out[3], pa.int32()),
                ],
                ["_id", "host", "path", "rule", "verdict", "strict_terms", "soft_terms"],
            )

    kind = dict(split.dtypes)["_id"]
    names = ("host", "path", "rule", "verdict", "strict_terms", "soft_terms")
    schema = f"_id {kind}, host string, path string, rule string, verdict string, strict_terms int, soft_terms int"
    judged = map_arrow(split, judge, schema, rows=4096)
    return judged.select(F.col("_id").alias(id_column), *names)
