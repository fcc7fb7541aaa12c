"""Packing, near duplicates, language model, quality and the pipeline against plain versions."""

from __future__ import annotations

import collections
import math
import random
import zlib

import numpy as np
import pytest
from llm.edge_tables import SF, brute_components, edge_documents, sets_of, words

import corpus_pipeline
from ipcforge.llm import dedup, lm, packing, pii, quality


def _documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def _texts(spark):
    return {r[0]: r[1] for r in _documents(spark).select("doc_id", "text").collect()}


# ---------------------------------------------------------------- packing


@pytest.mark.parametrize("seed", range(25))
def test_plan_is_a_packing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([1, 7, 100, 2048])
    histogram = collections.Counter(rnd.randint(1, capacity) for _ in range(rnd.randint(0, 400)))
    placed, held = collections.defaultdict(list), collections.defaultdict(list)
    for length, rank, count, first, offset in packing.plan_bins(dict(histogram), capacity):
        placed[length] += range(rank, rank + count)
        for i in range(count):
            held[first + i].append((offset, length))
    assert all(sorted(placed[n]) == list(range(c)) for n, c in histogram.items())
    assert sorted(held) == list(range(len(held)))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity and sum(3 * n > capacity for _, n in pieces) <= 2 or capacity < 3
    # first fit would already stay within this bound
    assert len(held) <= 1.7 * math.ceil(sum(n * c for n, c in histogram.items()) / capacity) + 1


def _check_packing(texts, rows, capacity):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.vocabulary_path("word_bpe_49k.json"))
    want = collections.Counter()
    for key, text in texts:
        ids = np.array(coder.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want.update((key, p, c, len(ids[c:c + capacity]), zlib.crc32(ids[c:c + capacity].tobytes()))
                    for p, c in enumerate(range(0, len(ids), capacity)))
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    held = collections.defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_ids_of_every_letter_before_marks():
    """Letters that normalizing turns into letter and mark, and all others, alone and behind a word."""
    from tokenizers import Tokenizer

    path = packing.vocabulary_path("word_bpe_49k.json")
    plain, coder = Tokenizer.from_file(path), packing.WordCoder(path)
    letters = [chr(i) for i in range(0x110000) if chr(i).isalpha() and not (0x4e00 <= i < 0x9f00 or 0xac00 <= i < 0xd700 or i >= 0x20000)]
    texts = [f"HAD{c}! {c}. x{c}?!" for c in letters] + ["HADİ! \u0301x e\u0301! a\u00a0b. \u0307! İ\u0307, '. don't! <|x|>! \u2003 9! a9!",
                                                     "\u0928\u093f! \u1112\u1161\u11ab! Ǆ! ΣΑΣ! <|endoftext|>! x"]
    got = [b for i in range(0, len(texts), 1000) for b in coder.ids([t.encode() for t in texts[i:i + 1000]])]
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []


def test_pack_the_documents(spark):
    rows = packing.pack(_documents(spark)).collect()
    n = _check_packing(list(_texts(spark).items()), rows, 2048)
    assert n <= math.ceil(sum(r["length"] for r in rows) / 2048) * 1.05 + 1


def test_pack_edges(spark):
    docs = edge_documents(spark)
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(500, "a <|endoftext|> b"), (501, "H̱ É ΑΣ 'LL")]
    more = spark.createDataFrame(texts[-2:], "doc_id long, text string")
    rows = packing.pack(docs.select("doc_id", "text").unionByName(more), capacity=64, keep_ids=True).collect()
    _check_packing(texts, rows, 64)
    assert all(len(r["ids"]) == r["length"] for r in rows)
    assert packing.pack(docs.limit(0)).count() == 0 and packing.pack(docs).count() > 0


# ---------------------------------------------------------------- near duplicates


def test_components_equal_brute_force(spark):
    texts = _texts(spark)
    got = {r["doc_id"]: r for r in dedup.dedup_digest(_documents(spark)).collect()}
    want, sets = brute_components(texts, 4), sets_of(texts, 4)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (want[i] == i) for i, r in got.items())


def test_groups_of_near_copies(spark, monkeypatch):
    """Many copies of one text with growing edits: links, near misses and chains, in small blocks."""
    monkeypatch.setattr(dedup, "BLOCK", 8)
    rnd = random.Random(2)
    base = [f"w{rnd.randint(0, 900)}" for _ in range(120)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rnd.randint(0, 9)):
            own[rnd.randrange(120)] = f"x{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [(2000, None), (2001, ""), (2002, "one two"), (2003, "ONE\ttwo"), (2004, "one")]
    got = {r["doc_id"]: r["component_id"] for r in dedup.dedup_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(dict(rows), 4)
    assert got[2003] == 2002 and got[2000] == 2000 and got[2004] == 2004 and len(set(got.values())) > 5


def test_dedup_edges(spark):
    docs = edge_documents(spark)
    found = dedup.near_duplicates(docs.where("doc_id is not null"))
    assert found.count() == docs.where("doc_id is not null").count()
    kept = dedup.keep_first(docs)
    assert kept.columns == docs.columns and kept.where("doc_id is null").count() == 1
    assert kept.where("doc_id in (6, 7)").count() == 0 and kept.where("doc_id = 5").count() == 2  # a repeated row is one document
    assert dedup.dedup_digest(docs.limit(0)).count() == 0


def test_repeated_rows_cost_one_comparison_per_class(spark, monkeypatch):
    """Thousands of copies of two near texts: as many comparisons as classes, every row in the component."""
    base = [f"w{i}" for i in range(300)]
    near = base[:-3] + ["x", "y", "z"]
    rows = [(i % 1500, " ".join(base)) for i in range(2000)] + [(1500 + i % 1000, " ".join(near)) for i in range(2000)]
    rows += [(9000 + i, f"another text number {i} of its own") for i in range(4)]
    compared, similar = [], dedup._similar
    monkeypatch.setattr(dedup, "_similar", lambda pairs, *a: (compared.append(pairs.count()), similar(pairs, *a))[1])
    got = dedup.dedup_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(compared) <= 2
    assert collections.Counter((r["doc_id"], r["component_id"], r["kept"]) for r in got) == collections.Counter(
        (i, 0 if i < 9000 else i, i == 0 or i >= 9000) for i, _ in rows)


def test_keys_that_are_null_or_have_two_texts(spark):
    """Rows are documents: a key's two texts keep their own components, a row without key reaches others."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(1, a), (5, a), (5, b), (7, b), (None, a), (None, c), (None, c + " more"), (None, None), (None, ""), (8, d), (8, d + " more"), (3, d)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(1, 1, True), (5, 1, False), (5, 5, True), (7, 5, False), (None, 1, False), (None, None, True), (None, None, True),
            (None, None, True), (None, None, True), (8, 3, False), (8, 3, False), (3, 3, True)]
    for part in (df.coalesce(1), df.repartition(5)):  # the same however the rows lie
        got = [(r["doc_id"], r["component_id"], r["kept"]) for r in dedup.dedup_digest(part).collect()]
        assert collections.Counter(got) == collections.Counter(want)
    kept = collections.Counter((r["doc_id"], r["text"]) for r in dedup.keep_first(df, width=4).collect())
    assert kept == collections.Counter([(1, a), (5, b), (3, d)] + [r for r in rows if r[0] is None])


def test_odd_sketch_estimates():
    """The XOR population count separates similarities as the bounds assume."""
    rng = np.random.default_rng(1)
    for similarity, near in ((0.85, True), (0.2, False)):
        shared = int(300 * 2 * similarity / (1 + similarity))
        a = rng.integers(0, 2**63, 300).astype(np.uint64)
        b = np.concatenate([a[:shared], rng.integers(0, 2**63, 300 - shared).astype(np.uint64)])
        sketch = dedup.odd_sketches(np.stack([dedup.minhash(a), dedup.minhash(b)]))
        fine = dedup.odd_sketches(np.stack([dedup.minhash(a, dedup.FINE), dedup.minhash(b, dedup.FINE)]), dedup.FINE64)
        apart = lambda s: sum(int(x).bit_count() for x in s[0] ^ s[1])
        assert (apart(sketch) <= dedup.FAR) is near and (apart(fine) <= dedup.FINE_FAR) is near


# ---------------------------------------------------------------- language model


@pytest.mark.parametrize("short", [None, 500])
def test_scores_against_plain_counts(spark, monkeypatch, short):
    if short:
        monkeypatch.setattr(lm, "SHORT", short)  # most words go through the join
    docs = _documents(spark).select("doc_id", "text").unionByName(edge_documents(spark).where("doc_id is not null").selectExpr("doc_id + 10000 as doc_id", "text"))
    rows = lm.lm_digest(docs).collect()
    texts = collections.Counter((r["doc_id"], r["text"]) for r in docs.collect())
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    counts = collections.Counter()
    for (i, t), times in texts.items():
        if not held(i):
            for w in words(t) + [b" "]:
                counts[w] += times
    n, v = sum(counts.values()), len(counts)
    plain = {}
    for i, t in texts:
        w = words(t) + [b" "]
        plain.setdefault(i, []).append((held(i), len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)))
    assert len(rows) == sum(texts.values())
    for r in rows:
        assert r["train_tokens"] == n
        assert any(r["held_out"] == p[0] and r["n_tokens"] == p[1] and r["n_known"] == p[2] and math.isclose(r["base_score"], p[3], rel_tol=1e-9)
                   for p in plain[r["doc_id"]])
    real = [r for r in rows if r["held_out"] and r["doc_id"] < 10000]
    assert sum(r["score"] for r in real) > sum(r["base_score"] for r in real)  # context helps on unseen texts


def test_model_is_normalised():
    rng = np.random.default_rng(0)
    pairs = rng.poisson(0.02, (lm.CLASSES, lm.CLASSES)) * rng.integers(1, 50, lm.CLASSES)
    logp = lm.train_nce(pairs, steps=30)
    assert np.allclose(np.exp(logp).sum(1), 1) and np.isfinite(logp).all()
    assert np.isfinite(lm.train_nce(np.zeros((lm.CLASSES, lm.CLASSES), np.int64), steps=5)).all()


def test_lm_of_an_empty_table(spark):
    assert lm.lm_digest(_documents(spark).limit(0)).count() == 0


# ---------------------------------------------------------------- quality


def test_quality_against_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = quality.quality_table(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = found.select("quality", "keep").collect()
    right = sum((r["quality"] == 1) == r["keep"] for r in rows) / len(rows)
    clean = [r["keep"] for r in rows if r["quality"] == 1]
    assert right >= 0.97 and sum(clean) / len(clean) >= 0.98


def test_em_recovers_accuracies():
    rng = np.random.default_rng(4)
    n, m = 20000, len(quality.LABELLERS)
    low = rng.random(n) < 0.15
    hit, alarm = rng.uniform(0.3, 0.8, m), rng.uniform(0, 0.004, m)
    votes = np.where(rng.random((n, m)) < np.where(low[:, None], hit, alarm), 1, 2)
    votes[rng.random((n, m)) < 0.1] = 0
    patterns, counts = np.unique(votes @ quality._PLACES, return_counts=True)
    posterior, got_hit, got_alarm, share = quality.em(patterns, counts)
    decided = posterior[np.searchsorted(patterns, votes @ quality._PLACES)] > 0.5
    assert (decided == low).mean() > 0.97 and abs(share - 0.15) < 0.02 and np.abs(got_hit - hit).max() < 0.05


def test_quality_edges(spark):
    docs = edge_documents(spark)
    model = quality.train(_documents(spark))
    found = quality.with_quality(docs, model)
    assert found.count() == docs.count() and set(docs.columns) <= set(found.columns)
    assert found.where("doc_id in (0, 1, 2, 99)").where("not keep").count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert quality.quality_table(docs.limit(0)).count() == 0


def test_quality_sample_with_null_and_repeated_keys(spark, monkeypatch):
    """Null and repeated keys are sampled as all others are, repeated rows once; the sample's bound holds."""
    kinds = ((None, "'null key ', id"), (7, "'same key ', id"), ("id", "'own key ', id"), (None, "null"))
    docs = None
    for key, text in kinds:
        some = spark.range(2000).selectExpr(f"cast({'null' if key is None else key} as long) as doc_id", f"concat({text}) as text")
        docs = some if docs is None else docs.unionByName(some)
    sizes, fit = [], quality.fit_linear
    monkeypatch.setattr(quality, "fit_linear", lambda x, y: sizes.append(len(x)) or fit(x, y))
    quality.train(docs, sample_docs=300)
    assert 200 <= sizes[0] <= 400
    quality.train(docs.repartition(5), sample_docs=300)
    assert sizes[0] == sizes[1]


# ---------------------------------------------------------------- pipeline


def test_pipeline_against_plain_stages(spark):
    texts = _texts(spark)
    good = {r["doc_id"] for r in quality.keep_good(_documents(spark)).select("doc_id").collect()}
    groups = brute_components({i: texts[i] for i in good}, 5)
    clean = [(i, pii.redact(texts[i] or "", pii.find_pii(texts[i] or ""))) for i in good if groups[i] == i]
    rows = corpus_pipeline.run(spark, SF).collect()
    _check_packing(clean, rows, 2048)


def test_pipeline_stages_keep_the_columns(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "pii", "packing"]
    docs = edge_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() > 0
        assert stage(spark, docs.limit(0), SF).count() == 0
