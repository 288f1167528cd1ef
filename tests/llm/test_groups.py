"""Near duplicates, embeddings, archives, chats, licences and components against brute force and on edge cases."""

import hashlib
import math
import random

import numpy as np
import pytest
from fixtures import documents, edited, prose
from pyspark.sql import functions as F

from tidewire.llm.chat import START, Automaton, Costs, repair_conversations
from tidewire.llm.components import connected_components
from tidewire.llm.embeddings import link_embeddings
from tidewire.llm.hashing import WordHasher
from tidewire.llm.common import words
from tidewire.llm.license_scan import license_scan
from tidewire.llm.near_duplicates import (
    ShingleVectors, WeightedSampler, distinct_documents, near_duplicates, weighted_jaccard, word_frequencies)
from tidewire.llm.warc import archive_folder, payload_digest, read_archives, write_archives


def _components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 160)] + [(5, 5), (7, None)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    whole = [(a, b) for a, b in links if b is not None and a != b]
    assert found == _components({n for link in whole for n in link}, whole)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_word_hashes():
    texts = ["One two, one", None, "", "ONE", "été two 12a"]
    hashes, borders = WordHasher()(texts)
    by_word = {}
    for text, a, b in zip(texts, borders[:-1], borders[1:]):
        own = words(text)
        assert len(own) == b - a
        for w, h in zip(own, hashes[a:b]):
            assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_sampler_estimates_similarity():
    sampler = WeightedSampler(samples=2048)
    vectors = list(ShingleVectors(np.ones(1 << 18, dtype=np.int64), 1000)([prose(1, 200), edited(edited(prose(1, 200), 50), 90)]))
    agree = (sampler(vectors[0]) == sampler(vectors[1])).mean()
    assert abs(agree - weighted_jaccard(*vectors)) < 0.04


def _near_duplicate_texts():
    texts = [None, None, "", "", "!!!", "?!", "one word", "One, WORD!", "tiny"]
    for seed in range(12):
        original = prose(seed, 150)
        texts += [original, original, edited(original, 20), edited(edited(original, 70), 100), original.upper()]
    hub = prose(99, 120)
    texts += [edited(hub, k) for k in range(0, 120, 4)]
    shared = prose(500, 40)
    return texts + [prose(600 + k, 60) + " " + shared for k in range(25)] + [prose(700, 30_000), edited(prose(700, 30_000), 9)]


def test_near_duplicates(spark):
    texts = _near_duplicate_texts()
    docs = documents(spark, list(enumerate(texts)), extra="class")
    frequencies = word_frequencies(docs.filter("text is not null").select("text"))
    vectors = list(ShingleVectors(frequencies, sum(t is not None for t in texts))(texts))
    links = []
    for i, a in enumerate(texts):
        for j in range(i):
            if a is not None and (a == texts[j] or len(vectors[i]) and len(vectors[j])
                                  and weighted_jaccard(vectors[i], vectors[j]) >= 0.8):
                links.append((i, j))
    want = _components(range(len(texts)), links)
    rows = near_duplicates(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == want
    assert {r["doc_id"] for r in rows if r["kept"]} == {i for i, c in want.items() if i == c}
    assert sum(1 for i, c in want.items() if i != c) > 70
    repeated = docs.unionByName(docs.filter("doc_id in (9, 12)")).unionByName(
        docs.filter("doc_id = 10").withColumn("doc_id", F.lit(None).cast("long")))
    kept = distinct_documents(repeated)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({i for i, c in want.items() if i == c})
    assert near_duplicates(docs.limit(0)).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    rows = []
    for group in range(30):
        centre = rng.standard_normal(16)
        rows += [((centre + 0.06 * rng.standard_normal(16)).tolist(), group % 3) for _ in range(8)]
    hot = rng.standard_normal(16)
    rows += [(hot.tolist(), 1)] * 40 + [((hot + 0.03 * rng.standard_normal(16)).tolist(), 1) for _ in range(60)]
    rows += [(hot.tolist(), None), (None, 1), ([0.0] * 16, 1), ([float("nan")] + [1.0] * 15, 1), ([None] + [1.0] * 15, 1),
             ([float("inf")] * 16, 1), ([], 1), (hot.tolist()[:8], 1), ((hot * 1e30).tolist(), 1)]
    vectors = spark.createDataFrame([(i, v, label, "x") for i, (v, label) in enumerate(rows)],
                                    "vec_id long, embedding array<float>, label int, key string")
    usable, links = {}, []
    for r in vectors.collect():
        v = r["embedding"]
        if r["label"] is not None and v and None not in v and all(map(math.isfinite, v)) and any(v):
            x = np.array(v)
            usable[r["vec_id"]] = (r["label"], x / np.linalg.norm(x / np.abs(x).max()) / np.abs(x).max())
    for i, (a, x) in usable.items():
        links += [(i, j) for j, (b, y) in usable.items() if j < i and a == b and len(x) == len(y) and x @ y >= 0.98]
    want = _components(range(len(rows)), links)
    degree = {i: sum(i in link for link in links) for i in range(len(rows))}
    for block in (512, 8):
        found = link_embeddings(vectors, block=block).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == {
            i: (degree[i], want[i], want[i] == i) for i in range(len(rows))}
    assert link_embeddings(vectors.limit(0)).count() == 0


def test_archives(spark):
    html = [("<p>é</p>", 7), ("<p>é</p>", 3), ("", 5), (None, 4), ("<p>é</p>", None), ("x" * 2_000_000, 9), ("only", 6), ("<p>é</p>", 3)]
    html += [(f"<html><body>page {k % 40} {prose(k % 40, 80)}</body></html>", 100 + k) for k in range(600)]
    pages = spark.createDataFrame([(i, f"http://a/{i}\n b", h, "x") for h, i in html], "page_id long, url string, html string, digest string")
    for least in (0, 5):
        folder = archive_folder(pages)
        manifest = write_archives(pages.repartition(2), folder, min_revisit_bytes=least, max_bytes=40_000)
        assert manifest.agg(F.sum("n_records")).first()[0] == len(html) and manifest.count() >= 2
        got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
                      None if r["payload"] is None else bytes(r["payload"])) for r in read_archives(manifest, folder).collect())
        want = []
        for h, i in html:
            payload = (h or "").encode()
            first = min((k for g, k in html if k is not None and (g or "") == (h or "")), default=None)
            revisit = len(payload) >= least and first is not None and first != i
            want.append((str(i), len(payload), payload_digest(payload), "revisit" if revisit else "response",
                         first if revisit else None, None if revisit else payload))
        assert got == sorted(want, key=lambda r: tuple(map(str, r))) or sorted(map(str, got)) == sorted(map(str, want))
    empty = archive_folder(pages)
    assert read_archives(write_archives(pages.limit(0), empty), empty).count() == 0


def _cheapest(automaton, roles):
    costs = {START: 0}
    for role in roles:
        after = {}
        for step in automaton.steps[automaton.key(role)]:
            if step.before in costs:
                after[step.after] = min(after.get(step.after, 1 << 60), costs[step.before] + step.cost)
        costs = after
    return min(c + int(automaton.closing[s]) for s, c in costs.items())


def _legal(rendered):
    roles = [part.split("|>")[0] for part in rendered.split("<|")[1:] if not part.startswith("end")]
    roles = roles[1:] if roles[0] == "system" else roles
    return roles and roles[-1] == "assistant" and all(r == ("user", "assistant")[k % 2] for k, r in enumerate(roles))


@pytest.mark.parametrize("block", [1024, 3])
def test_chats(spark, block):
    rng = random.Random(3)
    roles = ["system", "user", "assistant", None, "tool"]
    rows = [(c, k, rng.choice(roles), f"t{k} <|x|>") for c in range(40) for k in range(rng.randint(1, 6))]
    rows += [(999, k, rng.choice(roles[:3]), None if k % 9 == 0 else f"x{k}") for k in range(200)]
    rows += [(None, None, "user", "a"), (None, 1, "user", "a"), (None, 1, "user", "a"), (50, 0, "assistant", "")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, cost int")
    found = repair_conversations(turns, block=block).orderBy("position").collect()
    assert len(found) == len(rows)
    automaton = Automaton(Costs())
    for conv in {r["conv_id"] for r in found}:
        own = [r for r in found if r["conv_id"] == conv]
        assert sum(r["cost"] for r in own) == _cheapest(automaton, [r["role"] for r in own])
        assert _legal("".join(r["rendered"] for r in own))
    digest = hashlib.md5("".join(r["rendered"] for r in found).encode()).hexdigest()
    assert _RENDERED.setdefault("all", digest) == digest
    assert repair_conversations(turns.limit(0)).count() == 0


_RENDERED: dict = {}


def test_licenses(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    gpl = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public "
           "License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.")
    files = [("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", prose(1, 50)), ("a/x.py", None), ("a/b/COPYING", gpl),
             ("a/b/y.py", prose(2, 20) + "\n" + notice + "\n" + prose(3, 20)), ("z.py", ""), ("licence.txt", prose(4, 30)),
             ("a/b/c/x.py", prose(1, 50)), (None, notice), (None, "none"), ("w/LICENSE", notice), ("w/COPYING", "Licensed under CC BY-NC 4.0"),
             ("w/v/u/t.py", "nothing here")] + [(f"many/{k}.py", prose(k, 10)) for k in range(30)]
    table = spark.createDataFrame([(*f, 0.5) for f in files], "path string, text string, score double")
    rows = license_scan(table).collect()
    assert len(rows) == len(files)
    said = {(r["path"], r["origin"]): r for r in rows}
    assert said["a/LICENSE", "file"]["licence"] == "MIT" and said["a/b/COPYING", "file"]["licence"] == "GPL-3.0"
    assert said["a/b/y.py", "file"]["licence"] == "Apache-2.0" and said["a/b/y.py", "file"]["line"] == 1
    assert (said["a/b/c/x.py", "folder"]["licence"], said["a/b/c/x.py", "folder"]["folder"]) == ("GPL-3.0", "a/b")
    assert (said["a/x.py", "folder"]["licence"], said["a/x.py", "folder"]["folder"]) == ("MIT", "a")
    assert said["w/v/u/t.py", "folder"]["licence"] in ("Apache-2.0", "CC-BY-NC-4.0")
    assert said[None, "file"]["licence"] == "Apache-2.0" and ("z.py", None) in said and ("many/3.py", None) in said
    assert sum(r["path"] == "a/b/c/x.py" for r in rows) == 2
    assert license_scan(table.limit(0)).count() == 0


def test_licenses_inside_long_lines(spark):
    """Notices amid the words of one line, over a line break with words on both sides, and with words between."""
    def amid(notice: str, words: int) -> str:
        return prose(5, words) + " " + notice + " " + prose(6, words)

    files = [("p/LICENSE", amid("Licensed under the MIT License", 12)), ("p/q/x.py", prose(7, 40)),
             ("long.txt", amid("This work is licensed under the GNU General Public License, version 3", 3000)),
             ("few.txt", "see here that it is Licensed under the MIT License as ever before"),
             ("broken.txt", "first line\n" + amid("Licensed under the Apache\nLicense, Version 2.0", 200)),
             ("between.txt", amid("Licensed under the terms of the GNU General Public License, version 3", 100)),
             ("part.txt", amid("under the MIT License", 100)), ("plain.txt", amid("nothing", 3000)),
             ("list.txt", amid("license version license version", 100)), ("other.txt", amid("Licensed under the Foo Terms", 100))]
    table = spark.createDataFrame(files, "path string, text string")
    said = {r["path"]: r for r in license_scan(table).collect()}
    assert len(said) == len(files)
    for path, licence in (("p/LICENSE", "MIT"), ("long.txt", "GPL-3.0"), ("few.txt", "MIT"), ("broken.txt", "Apache-2.0")):
        assert (said[path]["licence"], said[path]["origin"], said[path]["score"]) == (licence, "file", 1.0)
    assert said["broken.txt"]["line"] == files[4][1].split("Licensed")[0].count("\n")
    assert said["between.txt"]["licence"] == "GPL-3.0" and said["part.txt"]["licence"] == "MIT"
    assert (said["p/q/x.py"]["licence"], said["p/q/x.py"]["folder"]) == ("MIT", "p")
    assert said["plain.txt"]["licence"] is None and said["list.txt"]["licence"] is None
    assert said["other.txt"]["licence"] is None
