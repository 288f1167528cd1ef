"""URL filters: host rules first, then a weighted vocabulary that one automaton counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import DIGITS, LOWER, UPPER, columns_of, slices


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"))
# One strict term rejects a URL; soft terms also occur in ordinary URLs, so several different ones are needed.
STRICT = ("bestiality", "casino", "escorts", "jackpot", "pills", "porn", "slots", "viagra", "xxx")
SOFT = ("adult", "bet", "bonus", "cheap", "discount", "farm", "free", "hot", "loan", "lucky", "poker", "sex", "spam", "win")
MIN_SOFT = 2

_TO_LOWER = {c: c + 32 for c in UPPER}
_WORD = frozenset(map(chr, [*DIGITS, *LOWER]))


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for a null or one without ``://``."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_TO_LOWER), slash + path


class RuleBook:
    """Finds the longest rule whose host is that of a URL, or a parent domain, and whose path starts its path."""

    def __init__(self, rules: Sequence[Rule]):
        self.paths: dict[str, list[Rule]] = {}
        known: dict[tuple[str, str], str] = {}
        for rule in rules:
            if not rule.host or rule.verdict not in ("allow", "block"):
                raise ValueError(f"not a rule: {rule}")
            if known.setdefault((rule.host, rule.path), rule.verdict) != rule.verdict:
                raise ValueError(f"two verdicts for {rule.name}")
            self.paths.setdefault(rule.host, []).append(rule)
        self.longest = max(map(len, self.paths), default=0)

    def find(self, host: str, path: str) -> Rule | None:
        best, tail = None, host[-self.longest - 1:] if self.longest else ""
        # The tail starts within the host, so only what follows a dot of it, or a whole host, is a domain.
        at = 0 if len(tail) == len(host) else tail.find(".") + 1 or len(tail)
        while at < len(tail):
            for rule in self.paths.get(tail[at:], ()):
                if path.startswith(rule.path) and (best is None or len(rule.name) > len(best.name)):
                    best = rule
            at = tail.find(".", at) + 1 or len(tail)
        return best


class Vocabulary:
    """Strict and soft terms in one automaton."""

    def __init__(self, strict: Sequence[str], soft: Sequence[str]):
        self.automaton = ahocorasick.Automaton()
        kinds = {t.translate(_TO_LOWER): False for t in soft} | {t.translate(_TO_LOWER): True for t in strict}
        if "" in kinds:
            raise ValueError("an empty term")
        for term, is_strict in kinds.items():
            self.automaton.add_word(term, (term, is_strict))
        self.empty = not kinds
        if kinds:
            self.automaton.make_automaton()

    def hits(self, url: str | None) -> list[tuple[int, str, bool]]:
        """Start, term and kind of each occurrence with no letter, digit or character above ASCII beside it."""
        if self.empty or not url:
            return []
        text = url.translate(_TO_LOWER)
        found = []
        for last, (term, is_strict) in self.automaton.iter(text):
            start = last + 1 - len(term)
            if not (start and _in_word(text[start - 1])) and not (last + 1 < len(text) and _in_word(text[last + 1])):
                found.append((start, term, is_strict))
        return found


def _in_word(char: str) -> bool:
    return char in _WORD or char > "\x7f"


@lru_cache(maxsize=4)
def _judges(rules: tuple[Rule, ...], strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[RuleBook, Vocabulary]:
    """Built once per worker."""
    return RuleBook(rules), Vocabulary(strict, soft)


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT,
               min_soft: int = MIN_SOFT, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """A verdict on each URL, as ``page_id, host, path, rule, verdict, strict_terms, soft_terms, n_hits, weight``.

    The host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; the
    path follows up to ``?``, ``#`` or the end. A rule fits its host and all subdomains if the path starts with its
    path; of several the longest (host and path together) wins and gives the verdict. Without a rule the
    vocabulary decides: terms are counted in the whole URL, in either case, where no letter, digit or character
    above ASCII stands beside them. A strict term weighs ``min_soft``, each different soft term 1, and a weight of
    ``min_soft`` or more blocks. ``strict_terms`` and ``soft_terms`` are sorted, each term once; ``n_hits`` counts all occurrences.

    Every row gives one row. A null URL has an empty host and path and no hits, so it is allowed; so has one without
    ``://``, but its text is still searched. Null or repeated ids and repeated rows are kept, other columns ignored, and an
    empty table gives none. Without terms only the rules decide, without rules only the vocabulary. A term in both
    lists is strict. Rules and terms are parameters and go to the tasks as such; URLs are not shuffled.
    """
    judged_by = tuple(map(Rule._make, rules)), tuple(strict), tuple(soft)
    _judges(*judged_by)  # refuses faulty rules before the plan is built
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, vocabulary = _judges(*judged_by)
        for batch in slices(batches, "url"):
            out: list[list] = [[] for _ in range(8)]
            for address in next(columns_of(batch, "url")):
                host, path = split_url(address)
                rule, hits = book.find(host, path), vocabulary.hits(address)
                strict_terms = sorted({term for _, term, is_strict in hits if is_strict})
                soft_terms = sorted({term for _, term, is_strict in hits if not is_strict})
                weight = min_soft * len(strict_terms) + len(soft_terms)
                verdict = rule.verdict if rule else "block" if weight and weight >= min_soft else "allow"
                for column, value in zip(out, (
                        host, path, rule.name if rule else None, verdict, strict_terms, soft_terms, len(hits), weight)):
                    column.append(value)
            kinds = [pa.string()] * 4 + [pa.list_(pa.string())] * 2 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(out, kinds)]],
                names=["page_id", "host", "path", "rule", "verdict", "strict_terms", "soft_terms", "n_hits", "weight"])

    return rows.mapInArrow(
        judge, f"page_id {rows.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, "
        "verdict string, strict_terms array<string>, soft_terms array<string>, n_hits long, weight long")
