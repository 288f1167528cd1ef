"""Alignment of two tokenizers against token by token comparison."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import sentencepiece
from fixtures import documents, prose
from tokenizers import Tokenizer

from tidewire.llm import alignment
from tidewire.llm.alignment import BYTE_VOCABULARY, PIECE_VOCABULARY, align_tokens, link_strengths, overlaps
from tidewire.llm.queries import QUERIES
from tidewire.operators import lookup

SF = "/root/testdata/sf0.001"


def _tokens():
    byte_model = Tokenizer.from_file(BYTE_VOCABULARY)
    byte_model.encode_special_tokens = True
    piece_model = sentencepiece.SentencePieceProcessor(model_file=PIECE_VOCABULARY)
    # The usual way to write bytes as characters: those that can be shown stand for themselves.
    shown = {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    for b in range(256):
        shown.setdefault(b, chr(256 + len([x for x in range(b) if not (33 <= x < 127 or 161 <= x < 173 or x >= 174)])))
    back = {c: b for b, c in shown.items()}

    def piece_bytes(i):
        piece = piece_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if piece_model.is_byte(i) else piece.replace("▁", " ").encode()

    def read(text):
        if not text:
            return [], []
        a = [(i, bytes(back[c] for c in byte_model.id_to_token(i))) for i in byte_model.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, piece_bytes(i)) for i in piece_model.encode(text)]
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    return read


def _expected(texts):
    read, rows, counts = _tokens(), [], Counter()
    for text in texts:
        sides = []
        for tokens in read(text):
            end, spans = 0, []
            for i, raw in tokens:
                spans.append((end, end + len(raw), i))
                end += len(raw)
            sides.append(spans)
        ends = {e: i for _, e, i in sides[1]}
        links = [(i, ends[e]) for _, e, i in sides[0] if e in ends]
        counts.update(links)
        groups, last = [], 0
        for cut in sorted(set(ends) & {e for _, e, _ in sides[0]}):
            groups.append("|".join(",".join(str(i) for _, e, i in side if last < e <= cut) for side in sides))
            last = cut
        rows.append((len(sides[0]), len(sides[1]), len(groups), links, ";".join(groups)))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return [(n_a, n_b, n_groups, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(groups.encode()).hexdigest() if groups else "") for n_a, n_b, n_groups, links, groups in rows]


TEXTS = [None, "", " ", "a", "\n", "▁ mark", "a▁b", "<|endoftext|> <s> </s> <unk> <0x0A>", "\x00\x01 nul", "é𝄞 漢字 кот", "  two  spaces   ",
         "x" * 3000, prose(1, 4000), "tab\tand\r\nline", "same row", "same row", "naïve café", "ａ ﬁ ½", " nbsp　wide", prose(2, 30)]


def _check(spark, texts):
    docs = documents(spark, [(i % 17, t) for i, t in enumerate(texts)], extra="pairs").repartition(3)
    rows = link_strengths(align_tokens(docs)).collect()
    ids = [i % 17 for i in range(len(texts))]
    expected = _expected(texts)
    assert sorted((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"]) for r in rows) == sorted(
        (i, *e[:-1]) for i, e in zip(ids, expected))
    groups = [(r["doc_id"], hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in align_tokens(docs).collect()]
    assert sorted(groups) == sorted((i, e[-1]) for i, e in zip(ids, expected))


def test_alignment(spark):
    _check(spark, TEXTS)


def test_pairs_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lookup.lookup, "__defaults__", (*lookup.lookup.__defaults__[:1], 0, *lookup.lookup.__defaults__[2:]))
    _check(spark, TEXTS)


def test_alignment_of_nothing(spark):
    docs = documents(spark, [(1, None), (1, "")])
    assert [tuple(r) for r in link_strengths(align_tokens(docs)).collect()] == [(1, 0, 0, 0, 0, 0, 0)] * 2
    assert link_strengths(align_tokens(docs.limit(0))).count() == 0


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op12_alignment"](spark, SF).collect()
    assert sorted(tuple(r) for r in rows) == sorted((d["doc_id"], *e) for d, e in zip(docs, _expected([d["text"] for d in docs])))


def test_overlaps():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sides = []
        for _ in range(2):
            cuts = np.sort(rng.choice(np.arange(1, 40), rng.integers(0, 20), replace=False))
            sides.append(np.unique(np.concatenate([[0, 25], cuts])))  # two texts of 25 and 15 bytes
        ends = [np.append(s[1:], 40) for s in sides]
        docs = [(s >= 25).astype(np.int64) for s in sides]
        got = overlaps(docs[0], sides[0], docs[1], sides[1])
        wanted = [(i, j) for i in range(len(sides[0])) for j in range(len(sides[1]))
                  if sides[0][i] < ends[1][j] and sides[1][j] < ends[0][i]]
        assert sorted(zip(*(g.tolist() for g in got))) == wanted
    assert alignment._shown_bytes()["Ġ"] == 32
