"""Both vector searches against brute force."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from llm.edge_tables import SF

from ipcforge.llm import ann, topk
from ipcforge.llm.queries import ORACLES


def _brute(rows, is_query, k, same_row=lambda a, b: a[0] == b[0]):
    out = {}
    for q in rows:
        if is_query(q[0]):
            scored = sorted((-float(np.dot(q[1], c[1])), c[0]) for c in rows if not same_row(q, c) and len(c[1]) == len(q[1]))
            out[q[0]] = scored[:k]
    return out


def _embeddings(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet")


def test_ann_recall_and_order(spark):
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in _embeddings(spark).collect()]
    got = {}
    for r in ann.ann_digest(_embeddings(spark)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = _brute(rows, lambda i: i % 20 == 0, 20)
    hits = sum(len({v for _, v, _ in got[q]} & {v for _, v in best}) for q, best in want.items())
    assert hits / (20 * len(want)) >= 0.9
    vectors = dict(rows)
    for q, found in got.items():
        found.sort()
        assert [r for r, *_ in found] == list(range(1, 21)) and all(v != q for _, v, _ in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        assert all(abs(s - vectors[q] @ vectors[v]) < 1e-12 for _, v, s in found)


def _odd_rows():
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(70)]  # one very common vector
    rows += [(300, None), (301, []), (302, [0.0, 0.0, 0.0, 0.0]), (303, [1.0, None, 1.0, 1.0]), (304, [float("nan"), 1.0, 1.0, 1.0]),
             (305, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0, 1.0]), (400, [1.0, 2.0]), (401, [2.0, 1.0])]
    return rows


def test_ann_ties_and_unusable_vectors(spark):
    frame = spark.createDataFrame([(*r, "x") for r in _odd_rows()], "vec_id long, embedding array<float>, ids string")
    usable = [(i, np.array(v, float)) for i, v in _odd_rows() if i is not None and v and i not in (302, 303, 304, 305)]
    got = {}
    for r in ann.ann_digest(frame).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    for q, best in _brute(usable, lambda i: i % 20 == 0, 20).items():
        found = [v for _, v in sorted(got.pop(q, []))]
        if len(usable) - 1 <= 20 or q >= 100:  # ties: the smallest ids, without the query's own
            assert found == [v for _, v in best]
        assert len(found) == len(best)
    assert not got and ann.ann_digest(frame.limit(0)).count() == 0


def test_hilbert_neighbours_touch():
    """Consecutive positions of the curve differ by one step in one direction."""
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    order = np.argsort(ann.hilbert_keys(cells, 3))
    assert sorted(ann.hilbert_keys(cells, 3)) == list(range(512))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def test_topk_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = con.execute(ORACLES["op7_topk"]).fetchall()
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.topk_digest(_embeddings(spark)).collect()]
    assert sorted(got) == sorted(want) and len(got) == 50


def test_topk_edges(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    frame = spark.createDataFrame([(*r, 7) for r in _odd_rows()], "vec_id long, embedding array<float>, label int")
    usable = [(i, np.floor(256 * np.array(v, float))) for i, v in _odd_rows() if i is not None and v and i not in (303, 304, 305)]
    got = {}
    for r in topk.topk_digest(frame).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = _brute(usable, lambda i: i % 50 == 0, 5)
    assert {q: [(v, s) for _, v, s in sorted(f)] for q, f in got.items()} == {q: [(v, -s) for s, v in best] for q, best in want.items() if best}
    assert topk.topk_digest(frame.limit(0)).count() == 0


@pytest.mark.parametrize("clustered", [True, False])
def test_dual_tree_prunes_and_is_exact(clustered):
    rng = np.random.default_rng(1)
    centres = rng.integers(-3000, 3000, (6, 8)) if clustered else np.zeros((6, 8), int)
    points = centres[rng.integers(0, 6, 4000)] + rng.integers(-40, 40, (4000, 8))
    queries = points[:600]
    dual = topk.DualSearch(queries, np.arange(600), points, np.arange(4000), 5)
    dual.run()
    scores = queries @ points.T
    scores[np.arange(600), np.arange(600)] = np.iinfo(np.int64).min + 1
    for i in range(600):
        best = np.lexsort((np.arange(4000), -scores[i]))[:5]
        assert dual.found[i].tolist() == best.tolist() and dual.scores[i].tolist() == scores[i][best].tolist()
    leaves = lambda node: sum(map(leaves, node.children)) if node.children else 1
    everything = leaves(topk.Node(dual.queries, np.arange(600), 0)) * leaves(topk.Node(dual.points, np.arange(4000), 0))
    assert dual.leaf_pairs <= everything
    if clustered:
        assert dual.pruned > 0 and dual.leaf_pairs < 0.6 * everything


def test_large_integers_stay_exact():
    big = np.array([[2**30 + 1, 3], [2**30, 5], [-(2**30), 7]])
    dual = topk.DualSearch(big[:1], np.array([9]), big, np.arange(3), 2)
    dual.run()
    assert dual.scores[0].tolist() == sorted((int(big[0] @ b) for b in big), reverse=True)[:2]
