"""Ranked search beside scores of all pairs."""

import math
import re
from collections import Counter

import numpy as np
from llm_tables import SF_DIR, empty, odd  # noqa: F401

from tallyguard.llm import queries, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def by_hand(docs, items, top=20):
    found = [(key, Counter(terms_of(text))) for key, text in docs]
    found = [(key, c) for key, c in found if c]
    n_docs, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms_of(text))
        rows = []
        for key, c in found:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // total
            score = 0
            for t, times in asked.items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                rows.append((-score, key is None, key or 0, key))
        rows.sort(key=lambda r: r[:3])
        out += [(item, rank, r[3], -r[0]) for rank, r in enumerate(rows[:top], 1)]
    return sorted(out, key=repr)


def rows_of(df, item="item_id", key="doc_id"):
    return sorted((tuple(r) for r in df.select(item, "rank", key, "score").collect()), key=repr)


def pairs(df, key):
    return [tuple(r) for r in df.select(key, "text").collect()]


def tables(spark):
    return (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "benchmark"))


def test_query(spark):
    docs, items = tables(spark)
    expected = by_hand(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert expected and rows_of(queries.QUERIES["op13_ranked"](spark, SF_DIR)) == expected


def test_small_shards_and_groups(spark, monkeypatch):
    """Many shards, blocks and groups of items give the same rows."""
    docs, items = tables(spark)
    items = items.limit(12)
    expected = by_hand(pairs(docs, "doc_id"), pairs(items, "item_id"), 5)
    monkeypatch.setattr(ranked, "VOCABULARY", 60)
    assert rows_of(ranked.ranked(docs, items, top=5, shard=37)) == expected


def test_odd_rows(spark, odd, empty, monkeypatch):  # noqa: F811
    asked = [(1, "PLAIN words, plain words!"), (1, "PLAIN words, plain words!"), (2, None), (3, " \t"), (None, "mail"), (5, "nowhere"), (6, "É")]
    items = spark.createDataFrame(asked, "item_id bigint, text string").selectExpr("*", "1 AS rank", "2 AS score")
    expected = by_hand(pairs(odd, "doc_id"), asked)
    assert expected and rows_of(ranked.ranked(odd, items)) == expected
    assert rows_of(ranked.ranked(empty, items)) == [] and rows_of(ranked.ranked(odd, items.limit(0))) == []
    monkeypatch.setattr(ranked, "SLICE", 7)
    for text in ("", "a", "Ab cd-ef g1 ÄÖ é\x00x", "word " * 50):
        assert [w.decode() for part in ranked.terms(text) for w in part] == terms_of(text)


def shard_of(rng, docs=3000, vocabulary=400):
    """Documents of a few subjects, each with words of its own."""
    rows = []
    for _ in range(docs):
        subject = rng.integers(8)
        own = rng.integers(0, 50, rng.integers(1, 30)) + 50 * subject
        rows.append(np.unique(np.where(rng.random(len(own)) < 0.2, rng.integers(0, vocabulary, len(own)), own)))
    sizes = np.array([len(r) for r in rows])
    term = np.concatenate(rows)
    part = rng.integers(1, 1000, len(term))
    projections = rng.choice([-1.0, 1.0], (ranked.SIGNS, vocabulary))
    return ranked.Postings(np.arange(docs), np.zeros(docs, bool), sizes, term, part, vocabulary, projections), rows


def test_bounds_and_skips():
    """No summary is below a document of its block, and most documents are skipped."""
    rng = np.random.default_rng(3)
    postings, rows = shard_of(rng)
    scored = []
    for _ in range(40):
        asked = np.unique(rng.integers(0, 50, 6) + 50 * rng.integers(8))
        times = rng.integers(1, 3, len(asked))
        counts = np.zeros(400, np.int64)
        counts[asked] = times
        every = postings.scores(np.arange(3000), counts)
        for t in asked:
            docs, bound = postings.blocks(t)[0], postings.bounds(t, asked, times)
            assert (every[docs] <= np.repeat(bound, ranked.BLOCK)[: len(docs)]).all()
        best = ranked.Best(20)
        scored.append(postings.search(asked, times, best))
        order = np.lexsort((postings.keys, -every))[:20]
        assert best.rows[0].tolist() == every[order].tolist() and best.rows[2].tolist() == postings.keys[order].tolist()
        scored[-1] /= max(1, (every > 0).sum())
    assert np.mean(scored) < 0.9
