"""Infilling and URL filters against plain readings of their rules, and on edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from fixtures import documents, prose
from pyspark.sql import functions as F

from tidewire.llm.infilling import UNITS, fill_in_middle, restored
from tidewire.llm.url_filter import RULES, SOFT, STRICT, Rule, RuleBook, Vocabulary, judge_urls
from tidewire.llm.wavelet import WaveletMatrix

_UNIT = {"token": "[A-Za-z]+|[^A-Za-z]", "line": "[^\n]*\n|[^\n]+", "char": "(?s:.)"}


def _cut(doc_id, text, unit="token", plain=10, spm=20):
    text = text or ""
    units = re.findall(_UNIT[unit], text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _texts():
    rng = random.Random(5)
    odd = ["".join(rng.choice("ab Zé𝄞1\n\t.<P>SM") for _ in range(rng.randint(1, 90))) for _ in range(150)]
    return [None, "", "a", "é", "𝄞", "ab", "a b", "<P>", "x<M>y", "< P>", "<", "<S", "P>", "\n", "a\n", "a\n\nb", *odd,
            prose(3, 30_000), "x" * 200_000, "𝄞 " * 20_000, "same text here", "same text here"]


@pytest.mark.parametrize("unit", sorted(UNITS))
def test_infilling(spark, unit):
    texts = _texts()
    docs = documents(spark, [(i, t) for i, t in enumerate(texts)] + [(2, "again a"), (2, "again a")], extra="output")
    docs = docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit("no id at all")))
    rows = fill_in_middle(docs, unit).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    wanted = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    expected = sorted(((i, *_cut(i, t, unit), t or "") for i, t in wanted), key=repr)
    assert sorted((tuple(r) for r in rows), key=repr) == expected
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    assert fill_in_middle(docs.limit(0)).count() == 0


def test_infilling_never_and_always_plain(spark):
    docs = documents(spark, [(i, f"some text {i}") for i in range(50)])
    assert fill_in_middle(docs, plain_percent=100).filter("form <> 'plain' or output <> concat('some text ', doc_id)").count() == 0
    assert fill_in_middle(docs, plain_percent=0, spm_percent=100).filter("form <> 'spm'").count() == 0
    for marks in [("<P>", "<P>", "<M>"), ("<P>", "", "<M>"), ("<P<", "<S>", "<M>")]:
        with pytest.raises(ValueError):
            fill_in_middle(docs, sentinels=marks)


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 1000):
        classes = rng.integers(0, 6, size)
        matrix = WaveletMatrix(classes, 3)
        ends = np.arange(size + 1)
        for kind in range(8):
            assert matrix.rank(kind, ends).tolist() == [int((classes[:e] == kind).sum()) for e in ends]
        wanted = np.array([size + 1, 0, 1])
        found = matrix.reach((1, 4), np.zeros(3, int), np.full(3, size), wanted)
        hits = np.flatnonzero(np.isin(classes, (1, 4)))
        assert found.tolist() == [size, 0, int(hits[0]) + 1 if len(hits) else size]


def _judged(url, rules=RULES, strict=STRICT, soft=SOFT):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.name), default=None)
    low = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")

    def count(term):
        return len(re.findall(rf"(?<![a-z0-9\u0080-\U0010ffff])(?={re.escape(term)}(?![a-z0-9\u0080-\U0010ffff]))", low))

    hard, mild = sorted(t for t in strict if count(t)), sorted(t for t in soft if count(t) and t not in strict)
    verdict = rule.verdict if rule else "block" if hard or len(mild) > 1 else "allow"
    return (host, path, rule and rule.name, verdict, hard, mild, sum(count(t) for t in {*strict, *soft}), 2 * len(hard) + len(mild))


def test_urls(spark):
    urls = [
        None, "", "no scheme casino", "http://", "://net/x", "http://net/", "http://net", "http://NET/a", "http://xnet/a", "http://a.net?x=/",
        "http://a.example.net/en/1", "http://example.net/en", "http://a.notexample.net/en/1", "http://example.net./en/1", "http://b.org/fr/x?y#z",
        "http://b.org/de/", "https://M.example.COM/de/9#casino", "http://casino-win.example.com/en", "http://casinos.example.com/en",
        "http://x.org/Casino", "http://x.org/spam/spam", "http://x.org/spam-farm", "http://x.org/éspam-farm", "http://x.org/spam_farm?FREE",
        "http://a://b.net/c", "http://x.org/porn0porn.porn", "http://x.org:80/fr/", "http://u@x.org/fr/", "http://" + "a." * 5000 + "net/" + "x" * 100_000,
        "http://" + "." * 70_000, "http://x.com/a\nb?\ncasino", "HTTP://X.COM/CHEAP%20WIN", "http://x.org/cheap", "http://x.org/cheap"]
    rows = [(i % 20, u, "h", "v") for i, u in enumerate(urls)] + [(None, "http://y.net/", "h", "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string")
    got = sorted((tuple(r) for r in judge_urls(pages).collect()), key=repr)
    assert got == sorted(((i, *_judged(u)) for i, u, *_ in rows), key=repr)
    assert judge_urls(pages.limit(0)).count() == 0
    rules = [Rule("block", "com", ""), Rule("allow", "x.com", "/a"), Rule("block", "x.com", "/a/b/c")]
    strict, soft = ["spam", "ab", "b-c"], ["Farm", "b", "farm-b", "spam"]
    strange = ["http://x.com/a/b", "http://x.com/a/b/c", "http://y.com", "http://q/ab-c", "http://q/farm-b", "http://q/SPAM", "http://q/b-b", "http://q/farm"]
    pages = spark.createDataFrame(list(enumerate(strange)), "page_id long, url string")
    lowered = [t.lower() for t in soft]
    assert sorted(tuple(r) for r in judge_urls(pages, rules, strict, soft).collect()) == [
        (i, *_judged(u, rules, strict, lowered)) for i, u in enumerate(strange)]
    assert judge_urls(pages, [], [], []).filter("verdict <> 'allow' or n_hits > 0").count() == 0


def test_faulty_rules_and_terms():
    for rules in ([Rule("block", "", "/")], [Rule("drop", "a", "/")], [Rule("block", "a", "/"), Rule("allow", "a", "/")]):
        with pytest.raises(ValueError):
            RuleBook(rules)
    with pytest.raises(ValueError):
        Vocabulary(["a", ""], [])
