"""Secret scans: a trigram index picks the texts in which each rule is searched."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.trigrams import trigram_query
from tidewire.operators.lookup import lookup
from tidewire.session import settle

# Prefix sums over spans are taken in runs of this length.
_RUN = 128
_MASK_BITS = 62


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched from left to right; a match counts if ``group`` has ``min_length`` characters.

    ``redact`` matches the part to hide, for ``replacement``. A ``block`` is hidden before the other kinds, whose
    replacements could cut it up.
    """

    kind: str
    pattern: str
    redact: str
    group: int = 0
    min_length: int = 1
    base: bool = False
    replacement: str = "[secret]"
    block: bool = False


_KEYWORD = r"""(?i:password|passwd|secret|token|api_?key)"""
_BETWEEN = r"""["']?\x20*[:=]\x20*["']?"""
# A private key runs to its END line if no other line of dashes comes before it, or else over its headers and base64 lines: of 16
# characters, with a digit, sign or later capital, or any last one. Lines may be indented, quoted, commented, or broken by a written \n.
# Possessive repeats keep no states for long bodies.
_BEGIN = "-----BEGIN [A-Z ]*PRIVATE KEY-----"
_TO_END = "[^-]*+(?:-{1,4}+(?!-)[^-]*+)*+-----END [A-Z ]*PRIVATE KEY-----"
_BREAKS = r"""(?:[\x20\t"',;#>*|/+]*+(?:\r\n?+|\n|\\[rn]))++[\x20\t"'#>*|/+]*+"""
_LINE_END = r"""={0,3}+(?=[\x20\t"',;+]*+(?![^\r\n\\]))"""
_LONG = "[A-Za-z0-9+/]{16,}+={0,3}+"
_KEY_LINES = (
    rf"(?:{_BREAKS}(?:Proc-Type|DEK-Info|Comment|Version):[^\r\n\\]*+)*+"
    rf"(?:{_BREAKS}(?:{_LONG}|(?=[A-Za-z]*+[0-9+/=]|[A-Za-z][a-z]*+[A-Z])[A-Za-z0-9+/]++{_LINE_END})|[\x20\t]*+{_LONG})++"
    rf"(?:{_BREAKS}[A-Za-z0-9+/]++{_LINE_END})?+")
_PRIVATE_KEY = f"{_BEGIN}(?:{_TO_END}|(?:{_KEY_LINES})?+)"
# The base kinds in their order, then the kinds that the index adds.
RULES = (
    Rule("assign", f"({_KEYWORD}){_BETWEEN}([A-Za-z0-9+/_.=-]+)",
         f"({_KEYWORD}{_BETWEEN})[A-Za-z0-9+/_.=-]{{12,}}", group=2, min_length=12, base=True, replacement="$1[secret]"),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{14,}", min_length=18, base=True),
    Rule("hex", "[0-9a-f]{16,}", "[0-9a-f]{16,}", min_length=16, base=True),
    Rule("github", "gh[opsu]_[A-Za-z0-9]{36,}", "gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abps]-[A-Za-z0-9-]{10,}", "xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("pem", _PRIVATE_KEY, _PRIVATE_KEY, block=True),
)


def trigram_postings(docs: DataFrame, trigrams: Sequence[str], text: str = "text") -> DataFrame:
    """The inverted index for the given trigrams: ``trigram, text_key``, distinct, over lower-case texts.

    Trigrams that no query asks for are left out of the index. Equal texts have one key, so a group of
    copies has one entry. Two texts that share a key by chance share their entries, which only adds candidates.
    """
    lowered = docs.filter(F.col(text).isNotNull()).select(
        F.xxhash64(text).alias("text_key"), F.lower(text).alias("lowered"))
    masks = {f"__m{k}": trigrams[k:k + _MASK_BITS] for k in range(0, len(trigrams), _MASK_BITS)}
    bits = lowered.select("text_key", *[
        reduce(Column.bitwiseOR, [
            F.when(F.contains("lowered", F.lit(t)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
            for i, t in enumerate(part)]).alias(name) for name, part in masks.items()])
    some = reduce(Column.__or__, [F.col(name) != 0 for name in masks])
    one = bits.filter(some).groupBy("text_key").agg(*[F.bit_or(name).alias(name) for name in masks])
    present = F.concat(*[
        F.filter(F.array(*[F.when(F.col(name).bitwiseAND(F.lit(1 << i)) != 0, F.lit(t)) for i, t in enumerate(part)]),
                 lambda t: t.isNotNull()) for name, part in masks.items()])
    return one.select("text_key", F.explode(present).alias("trigram"))


def candidates(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """Text keys with the kinds (``kinds``) whose trigram query they satisfy; rules without a query are left out.

    Postings meet the conjunctions that ask for them, and a text passes a conjunction with all its trigrams.
    """
    asked = [(rule.kind, number, sorted(conjunction)) for rule in rules
             for number, conjunction in enumerate(sorted(trigram_query(rule.pattern) or (), key=sorted))]
    spark = docs.sparkSession
    terms = spark.createDataFrame(
        [(t, kind, number, len(ts)) for kind, number, ts in asked for t in ts],
        "trigram string, kind string, conjunction int, n_terms int")
    trigrams = sorted({t for _, _, ts in asked for t in ts})
    if not trigrams:
        return spark.createDataFrame([], "text_key long, kinds array<string>")
    # The terms come from the rules alone.
    met = trigram_postings(docs, trigrams, text).join(F.broadcast(terms), "trigram").groupBy(
        "text_key", "kind", "conjunction").agg(F.count("*").alias("n"), F.first("n_terms").alias("n_terms"))
    return met.filter("n = n_terms").groupBy("text_key").agg(F.sort_array(F.collect_set("kind")).alias("kinds"))


def _starts(gaps: Column, found: Column) -> Column:
    """Offsets of matches from the lengths of the texts between them (``gaps``) and of their own (``found``).

    Sums run over stretches of ``_RUN`` matches and then over the stretches, as arrays are copied when they grow.
    """
    size = F.size(found)
    runs = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / _RUN).cast("int")), lambda r: F.struct(
        F.slice(gaps, r * _RUN + 1, _RUN).alias("gaps"), F.slice(found, r * _RUN + 1, _RUN).alias("found")))

    def append(state: Column, item: Column) -> Column:
        starts = F.concat(state["starts"], F.array(state["at"] + item["gap"]))
        return F.struct(starts.alias("starts"), (state["at"] + item["gap"] + item["length"]).alias("at"))

    zero = F.struct(F.array().cast("array<long>").alias("starts"), F.lit(0).cast("long").alias("at"))
    inner = F.transform(runs, lambda run: F.aggregate(
        F.zip_with(F.slice(run["gaps"], 1, F.size(run["found"])), run["found"],
                   lambda g, m: F.struct(g.alias("gap"), m.alias("length"))), zero, append))

    def base(state: Column, item: Column) -> Column:
        return F.struct(
            F.concat(state["parts"], F.array(F.transform(item["starts"], lambda s: s + state["at"]))).alias("parts"),
            (state["at"] + item["at"]).alias("at"))

    first = F.struct(F.array().cast("array<array<long>>").alias("parts"), F.lit(0).cast("long").alias("at"))
    return F.flatten(F.aggregate(inner, first, base)["parts"])


def secret_spans(docs: DataFrame, rules: Sequence[Rule] = RULES, doc_id: str = "doc_id", text: str = "text",
                 keep: Sequence[str] = ()) -> DataFrame:
    """Secrets in whole texts, as ``doc_id, secrets`` and, as fields of a column ``row``, the columns named in ``keep``.

    ``secrets`` are structs ``start, rank, end, kind`` in order of start and then of the rules; offsets count
    code points, the end is exclusive. Per rule the matches are leftmost and do not overlap.

    Each rule's regular expression gives a Boolean trigram query. An inverted index over all texts holds
    the trigrams that the queries ask for; its postings are intersected per conjunction, and a rule is
    searched only in the texts that its query lets pass, or in all texts if it has no query. The candidates
    are narrow; they are broadcast up to a measured size and otherwise joined with hot keys split. Everything
    is a built-in function.

    Null and empty texts have no secrets; ids may be null or repeated; columns not named are ignored.
    """
    kept = [F.struct(*keep).alias("row")] if keep else []
    rows = docs.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"), *kept).withColumn(
        "text_key", F.xxhash64("__text"))
    found = settle(candidates(docs, rules, text))
    rows = lookup(rows, found, "text_key", "__id")
    columns = ["__id", "__text", *(["row"] if keep else [])]
    whole = {r.kind: f"__all_{r.kind}" for r in rules}
    values = {r.kind: f"__value_{r.kind}" for r in rules if r.group}
    gaps = {r.kind: f"__gaps_{r.kind}" for r in rules}

    def where(rule: Rule, value: Column, otherwise: Column) -> Column:
        """Search only candidates, unless the rule has no query."""
        if trigram_query(rule.pattern) is None:
            return value
        return F.when(F.array_contains("kinds", rule.kind), value).otherwise(otherwise)

    none = F.array().cast("array<string>")
    rows = rows.select(*columns, *[
        where(r, F.regexp_extract_all("__text", F.lit(r.pattern), F.lit(0)), none).alias(whole[r.kind]) for r in rules], *[
        where(r, F.regexp_extract_all("__text", F.lit(r.pattern), F.lit(r.group)), none).alias(values[r.kind])
        for r in rules if r.group])

    def lengths(parts: Column) -> Column:
        return F.transform(parts, lambda p: F.length(p).cast("long"))

    no_lengths = F.array().cast("array<long>")
    rows = rows.select(*columns, *[lengths(F.col(whole[r.kind])).alias(whole[r.kind]) for r in rules],
                       *[lengths(F.col(values[r.kind])).alias(values[r.kind]) for r in rules if r.group],
                       *[F.when(F.size(whole[r.kind]) > 0, lengths(F.split("__text", r.pattern, -1))).otherwise(
                           no_lengths).alias(gaps[r.kind]) for r in rules])

    kind_of = "array<struct<start: bigint, rank: int, end: bigint, kind: string>>"

    def spans(rule: Rule, rank: int) -> Column:
        own = F.col(whole[rule.kind])
        value = F.col(values.get(rule.kind, whole[rule.kind]))
        placed = F.arrays_zip(_starts(F.col(gaps[rule.kind]), own).alias("start"), own.alias("size"), value.alias("value"))
        passing = F.filter(placed, lambda p: p["value"] >= rule.min_length)
        return F.when(F.size(own) > 0, F.transform(passing, lambda p: F.struct(
            p["start"].alias("start"), F.lit(rank).alias("rank"), (p["start"] + p["size"]).alias("end"),
            F.lit(rule.kind).alias("kind")))).otherwise(F.array().cast(kind_of))

    joined = F.array_sort(F.concat(*[spans(r, k) for k, r in enumerate(rules)]))
    return rows.select(F.col("__id").alias("doc_id"), joined.alias("secrets"), *(["row"] if keep else []))


def span_text(secrets: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, doc_id: str = "doc_id", text: str = "text",
                   n_chars: str = "n_chars") -> DataFrame:
    """All rows and columns of ``docs`` with secrets replaced in the text and its length brought up to date.

    Texts without secrets stay as they are, null ones too. Of an assignment the keyword stays, of a private key nothing.
    """
    scanned = secret_spans(docs, rules, doc_id, text, keep=docs.columns)
    hidden = F.col("row")[text]
    for rule in sorted(rules, key=lambda r: not r.block):
        hidden = F.regexp_replace(hidden, rule.redact, rule.replacement)
    some = F.size("secrets") > 0
    clean = scanned.select("row", some.alias("some"), F.when(some, hidden).otherwise(F.col("row")[text]).alias("clean"))
    size = F.when(F.col("some"), F.length("clean"))
    return clean.select(*[
        F.col("clean").alias(c) if c == text
        else F.coalesce(size, F.col("row")[c]).cast(docs.schema[c].dataType).alias(c) if c == n_chars
        else F.col("row")[c].alias(c) for c in docs.columns])
