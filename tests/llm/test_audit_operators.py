"""Source divergence, whitening and language ID against plain versions."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from llm.edge_tables import SF, edge_documents

from ipcforge.llm import divergence, language_id, whitening
from ipcforge.llm.common import text_buffer
from ipcforge.llm.queries import ORACLES

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


# ---------------------------------------------------------------- divergence


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_divergence(rows, min_texts=3, top=200):
    """rows: (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    texts, count, groups = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for text, lang, source in rows:
        groups[lang].add(source)
        texts.update((lang, t) for t in set(terms_of(text)))
        count.update((lang, source, t) for t in terms_of(text))
    out = []
    for lang in groups:
        kept = [t for (x, t), n in texts.items() if x == lang and n >= min_texts]
        total = {s: sum(count[lang, s, t] for t in kept) for s in groups[lang]}
        both = {t: sum(count[lang, s, t] for s in groups[lang]) for t in kept}

        def share(n, of):
            return 1 + 10 ** 9 * (n + 1) // (of + len(kept))

        for s in groups[lang]:
            pairs = [(sum((share(count[lang, s, t], total[s]) - share(count[lang, o, t], total[o])) ** 2 // share(count[lang, o, t], total[o])
                          for t in kept), o) for o in groups[lang] if o != s]
            found = []
            for t in kept:
                p, q = share(count[lang, s, t], total[s]), share(both[t], sum(both.values()))
                if count[lang, s, t] and p > q:
                    found.append(((p - q) ** 2 // q, t))
            for part, values, most in (("pair", pairs, None), ("term", found, top)):
                ranked = sorted(values, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def _audit(df, **more):
    return sorted(tuple(r) for r in divergence.divergence_audit(df, **more).select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("seed", range(6))
def test_counts_of_a_slice(seed):
    """All length buckets, runs that meet at a text's edge, and groups."""
    rnd = random.Random(seed)
    letters = "aAbZzé日𐍈 \t.-0@[`{\x7f\x80"
    texts = ["".join(rnd.choice(letters) * rnd.choice([1, 1, 1, 9, 40, 700]) for _ in range(rnd.randint(0, 30))) for _ in range(40)]
    group = sorted(rnd.randint(0, 3) for _ in texts)
    import pyarrow as pa

    data, offsets = text_buffer(pa.array(texts))
    data = divergence._LOWER[data]
    got = collections.Counter()
    for s, n, g, c, d in zip(*divergence.count_terms(data, offsets, np.array(group))):
        key = (data[s:s + n].tobytes().decode(), int(g))
        assert key not in got
        got[key] = (int(c), int(d))
    count, seen = collections.Counter(), collections.Counter()
    for t, g in zip(texts, group):
        count.update((x, g) for x in terms_of(t))
        seen.update((x, g) for x in set(terms_of(t)))
    assert got == {k: (count[k], seen[k]) for k in count}


def test_radix_order_is_stable():
    rnd = np.random.default_rng(1)
    a, b = (rnd.integers(0, 5, 3000).astype(np.uint64) << np.uint64(s) for s in (62, 13))
    assert (divergence.radix_order([a, b]) == np.lexsort([b, a])).all()
    assert len(divergence.radix_order([np.zeros(0, np.uint64)])) == 0


def test_shares_are_exact():
    rnd = random.Random(2)
    for _ in range(2000):
        total, v = rnd.randint(0, 10 ** rnd.randint(1, 14)), rnd.randint(1, 10 ** rnd.randint(1, 8))
        n = rnd.randint(0, total)
        assert int(divergence.shares(np.array([n]), total, v)[0]) == 1 + 10 ** 9 * (n + 1) // (total + v)


def test_divergence_of_edges(spark, monkeypatch):
    docs = edge_documents(spark)
    docs = docs.unionByName(docs.withColumn("source", docs.doc_id.cast("string"))).unionByName(docs)
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    assert _audit(docs) == brute_divergence(rows)
    assert _audit(docs, min_texts=1, top_terms=3) == brute_divergence(rows, 1, 3)
    monkeypatch.setattr(divergence, "PART_ROWS", 50)  # many parts per language
    monkeypatch.setattr(divergence, "_BLOCK", 64)
    assert _audit(docs, min_texts=1) == brute_divergence(rows, 1)


def test_divergence_without_terms_or_rows(spark):
    schema = "text string, lang string, source string, term string, n long, part int, rank int"
    df = spark.createDataFrame([(None, "a", "x", "q", 1, 1, 1), ("1 2", "a", "y", "q", 1, 1, 1), ("once", "b", None, "q", 1, 1, 1)], schema)
    assert _audit(df) == [("a", "x", "pair", "y", 0, 1), ("a", "y", "pair", "x", 0, 1)]
    assert _audit(df.limit(0)) == []


def test_divergence_hot_group_equals_sql(spark):
    """Half of the rows in one group, ties, terms beyond ASCII; against the registered SQL."""
    rnd = random.Random(5)
    words = ["alpha", "Beta", "gamma-ray", "ÉCOLE", "straße", "日本語", "x" * 30, "y" * 17, "tie", "tied", "a", "b"]
    rows = [(" ".join(rnd.choices(words, k=rnd.randint(0, 12))), rnd.choice(["en", "de", None]), "hot" if i % 2 else f"s{i % 7}") for i in range(600)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    want = sorted(con.execute(ORACLES["op11_divergence"]).fetchall())
    got = _audit(spark.createDataFrame(rows, "text string, lang string, source string"))
    assert got == want == brute_divergence(rows)


# ---------------------------------------------------------------- whitening


def brute_whitening(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100000
    n = len(x)
    sums = x.sum(axis=0)
    y = x - sums / n
    cov = y.T @ y / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x]
    return n, deviation, (y @ v[:, :k]) / np.sqrt(e[:k]), e[:k] / np.trace(cov)


def _signs(got, want):
    """Both with the sign that makes the largest entry of the wanted column positive."""
    at = np.abs(want).argmax(axis=0), np.arange(want.shape[1])
    return got * np.sign(got[at]), want * np.sign(want[at])


def test_whitening_equals_the_plain_version(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = {r[0]: r[1] for r in df.select("vec_id", "embedding").collect()}
    ids = sorted(vectors)
    n, deviation, white, explained = brute_whitening([vectors[i] for i in ids])
    rows = whitening.whiten(df).collect()
    assert len(rows) == 8 * len(ids) and {r["n"] for r in rows} == {n}
    got = np.zeros_like(white)
    place = {i: j for j, i in enumerate(ids)}
    for r in rows:
        j, c = place[r["vec_id"]], r["component"] - 1
        got[j, c] = r["whitened"]
        assert r["deviation"] == deviation[j]
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        assert 0 <= r["identity_error"] < 1e-9
    a, b = _signs(got, white)
    assert np.abs(a - b).max() < 1e-7
    cov = got.T @ got / n
    assert np.abs(cov - np.eye(8)).max() < 1e-9


@pytest.mark.parametrize("gaps", [[1.0] * 12, [1e-9] * 12, [0.0] * 12, [1.0, 0, 0, 1e-12, 5.0, 1e-6, 1e-6, 0, 2.0, 1e-3, 1e-10, 3.0]])
def test_refined_vectors_have_double_precision(gaps):
    """Separate, close and multiple eigenvalues: residual and orthogonality far below single precision."""
    rnd = np.random.default_rng(3)
    q = np.linalg.qr(rnd.normal(size=(12, 12)))[0].astype(np.longdouble)
    for _ in range(4):  # orthogonal in extended precision
        q = q + q @ (np.eye(12) - q.T @ q) / 2
    true = 1.0 + np.cumsum(np.array(gaps, np.longdouble))
    a = (q * true) @ q.T
    a = (a + a.T) / 2
    values, x = whitening.refined_eigen(a)
    assert (np.diff(values) <= 0).all()
    assert np.abs(values - np.sort(true)[::-1]).max() < 1e-14 * float(true.max())
    wide = x.astype(np.longdouble)
    assert np.abs(wide.T @ wide - np.eye(12)).max() < 1e-15
    assert np.abs(a @ wide - wide * values).max() < 4e-15 * float(true.max())
    single = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    assert np.abs(single.T @ single - np.eye(12)).max() > 1e-8  # what the iteration starts from
    if min(gaps) >= 1:
        turned = np.abs((x.T @ q[:, ::-1].astype(np.float64)))
        assert np.abs(turned - np.eye(12)).max() < 1e-13


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, -1.0, 0.25]), (1, [0.5, -1.0, 0.25]), (None, [1.5, 0.0, 0.5]), (7, [-3.0, 2.0, 9.0]), (8, [0.1, 0.2, 0.3])]
    bad = [(2, None), (3, []), (4, [nan, 1.0, 1.0]), (5, [1.0, inf, 1.0]), (6, [1.0, None, 1.0]), (9, [1.0, 2.0])]
    schema = "vec_id long, embedding array<float>, n string, component string, whitened string, i int, high string"
    df = spark.createDataFrame([r + ("x", "x", "x", 1, "x") for r in good + bad], schema)
    rows = whitening.whiten(df).collect()
    n, deviation, white, explained = brute_whitening([np.float32(v).tolist() for _, v in good], 3)
    assert sorted((r["vec_id"] or -1, r["component"], r["n"], r["deviation"]) for r in rows) == sorted(
        (i or -1, c + 1, n, d) for (i, _), d in zip(good, deviation) for c in range(3))
    got = {(r["vec_id"], r["component"]): abs(r["whitened"]) for r in rows}
    for (i, _), w in zip(good, white):
        assert [got[i, c + 1] for c in range(3)] == pytest.approx(np.abs(w).tolist(), rel=1e-7)
    # no variance at all: no value, and no error
    one = whitening.whiten(df.where("vec_id = 7")).collect()
    assert len(one) == 3 and all(r["whitened"] is None and r["deviation"] == 0 and r["identity_error"] == 0 for r in one)
    assert whitening.whiten(df.where("vec_id = 2")).count() == 0
    # beyond 64 bits
    big = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])], "vec_id long, embedding array<double>")
    out = {r["vec_id"]: r["deviation"] for r in whitening.whiten(big).collect()}
    assert out[1] is None and set(out) == {1, 2, 3}


# ---------------------------------------------------------------- language


@pytest.fixture(scope="module")
def pieces():
    return language_id.load_pieces(language_id.vocabulary_path())


def _vocabulary():
    import base64

    with open(language_id.vocabulary_path(), "rb") as fh:
        return [base64.b64decode(line.split()[0]) for line in fh if line.strip()]


def _segmentations(word, index):
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        if word[:n] in index:
            for rest in _segmentations(word[n:], index):
                yield (index[word[:n]], *rest)


def test_forward_sums_all_segmentations(pieces):
    index = {p: i for i, p in enumerate(_vocabulary())}
    rnd = np.random.default_rng(0)
    model = rnd.dirichlet(np.full(pieces.size, 0.05), 2).T + 1e-9
    words = [w.encode() for w in (" the", " nation", "a", " über", "日本", " x", " reading")]
    got = language_id.log_probabilities(pieces, words, model)
    for w, row in zip(words, got):
        every = list(_segmentations(w, index))
        for j in range(2):
            assert row[j] == pytest.approx(math.log(sum(math.prod(model[i, j] for i in s) for s in every)), rel=1e-10)
    n = np.arange(1, len(words) + 1)
    counts = language_id.expected_counts(pieces, words, n, model[:, :1])
    want = np.zeros(pieces.size)
    for w, m in zip(words, n):
        every = [(math.prod(model[i, 0] for i in s), s) for s in _segmentations(w, index)]
        whole = sum(p for p, _ in every)
        for p, s in every:
            for i in s:
                want[i] += m * p / whole
    assert counts == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_long_words_stay_in_range(pieces):
    model = language_id.smoothed(np.eye(pieces.size, 2) * 1e9, pieces.single)  # nearly nothing known
    words = [w.encode() for w in language_id.words_of("𐍈" * 40 + " " + "Donaudampfschifffahrtsgesellschaft")]
    assert np.isfinite(language_id.log_probabilities(pieces, words, model)).all()
    every = "".join(map(chr, range(0x300)))
    assert language_id.words_of(every) == [w for w in language_id.words_of(every + " 日")[:-1]]
    assert "".join(language_id.words_of("Aé" * 30 + " ÜB 12x")) == " " + "aé" * 30 + " üb x"


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in language_id.language_digest(docs).collect()}
    known = {r[0]: r[1] for r in docs.select("doc_id", "lang").collect()}
    assert set(rows) == set(known)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in rows.items())
    held = [i for i, r in rows.items() if r["held_out"]]
    assert np.mean([rows[i]["lang_pred"] == known[i] for i in held]) > 0.97
    # the language of a held-out row is never read
    hidden = docs.withColumn("lang", language_id.F.when(~language_id.held_out(docs.doc_id), docs.lang))
    again = {r["doc_id"]: r["lang_pred"] for r in language_id.language_digest(hidden).collect()}
    assert again == {i: r["lang_pred"] for i, r in rows.items()}


def test_language_edges(spark):
    docs = edge_documents(spark)
    rows = language_id.language_digest(docs).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in rows) == sorted((i if i is not None else -1) for i, _ in texts)
    for r in rows:
        letters = {any(c.isalpha() for c in t or "") for i, t in texts if i == r["doc_id"]}
        assert (r["lang_pred"] == "und") == (True not in letters) and (r["score"] == 0) == (r["lang_pred"] == "und")
    assert language_id.language_digest(docs.limit(0)).count() == 0
    none = language_id.language_digest(docs.withColumn("lang", language_id.F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
