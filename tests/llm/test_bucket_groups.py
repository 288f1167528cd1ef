"""Buckets of vectors are read as columns: groups over the borders of batches, counts of links by first shared bucket."""

import numpy as np
import pyarrow as pa

from tidewire.llm import embeddings


def _rows(rng):
    rows = []
    for label in ("2/a", "3/b"):
        for group in range(12):
            for _ in range(int(rng.integers(1, 9))):
                rows.append({"label_key": label, "table": group // 4, "hash": group % 4, "i": 0, "j": 0, "block": 0, "key": f"k{len(rows)}",
                             "n": 1, "vector": rng.standard_normal(int(label[0])).tolist(), "hashes": [1, 2, 3]})
    return rows


def test_groups_go_over_batches():
    rows = _rows(np.random.default_rng(1))
    whole = pa.RecordBatch.from_pylist(rows)
    want = [[r["key"] for r in rows if (r["label_key"], r["table"], r["hash"]) == g]
            for g in sorted({(r["label_key"], r["table"], r["hash"]) for r in rows})]
    for size in (1, 2, 7, 1000):
        batches = [whole.slice(k, size) for k in range(0, len(rows), size)]
        got = [g.column(g.schema.get_field_index("key")).to_pylist() for g in embeddings._groups(iter([whole.slice(0, 0), *batches]))]
        assert got == want
    assert list(embeddings._groups(iter([]))) == []


def test_links_count_in_the_first_shared_bucket(monkeypatch):
    monkeypatch.setattr(embeddings, "_PAIRS", 5)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((30, 3))
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    side = (np.array([f"k{i}" for i in range(30)]), rng.integers(1, 4, 30), x, rng.integers(0, 3, (30, 6)))
    for table in range(6):
        for left, right in ((side, None), (tuple(c[:11] for c in side), tuple(c[11:] for c in side))):
            counts, _, _ = embeddings._compare(left, right, table, 0.5)
            want = [sum(side[1][b] for b in range(30) if a != b and (right is None or (a < 11) != (b < 11)) and x[a] @ x[b] >= 0.5
                        and not (side[3][a, :table] == side[3][b, :table]).any()) for a in range(30)]
            assert counts.tolist() == want
    assert embeddings._compare(side, None, 0, 1.5)[0].tolist() == [0] * 30


def test_no_link_is_left_to_chance(spark):
    """Pairs just above the threshold in labels of several cells: each of them is found, however many signs are drawn."""
    rng = np.random.default_rng(11)
    base = rng.standard_normal((1800, 24))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = rng.standard_normal(base.shape)
    aside -= (aside * base).sum(axis=1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    twin = 0.98002 * base + np.sqrt(1 - 0.98002 ** 2) * aside
    x = np.concatenate([base, twin, 3 * base[:40]])
    label = [k % 1800 % 3 for k in range(3600)] + [k % 3 for k in range(40)]
    similar = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T >= 0.98
    similar &= np.equal.outer(label, label) & ~np.eye(len(x), dtype=bool)
    want = dict(enumerate(similar.sum(axis=1).tolist()))
    assert min(want.values()) == 1 and max(want.values()) >= 2
    df = spark.createDataFrame([(i, v.tolist(), k) for i, (v, k) in enumerate(zip(x, label))], "vec_id long, embedding array<double>, label int")
    for signs, block in ((28, 512), (None, 100), (4, 16)):
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.link_embeddings(df, signs=signs, block=block).collect()}
        assert {i: n for i, (n, _) in got.items()} == want
        assert all(got[i][1] == i % 1800 for i in range(3600))
