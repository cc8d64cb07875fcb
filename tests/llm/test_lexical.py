"""Ranked search against brute force in plain Python, on tables with every oddity."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trainlake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id LONG, text STRING, item_id STRING, score STRING, n INT, block STRING, rank INT"
ITEMS = "item_id LONG, text STRING, doc_id LONG, df INT, owner STRING"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(documents, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in documents if terms(t)]
    n, words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = set()
    for item, text in items:
        asked, found = Counter(terms(text)), []
        for i, c in counts:
            m = 100 - 75 + (75 * sum(c.values()) * n) // words
            score = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, r in asked.items() if t in c)
            if score > 0 and i is not None:
                found.append((-score, i))
        out |= {(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(found)[:k], 1)}
    return out


def rows(df):
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()]
    assert len(set(got)) == len(got)
    return set(got)


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(3)
    usual = [f"w{min(int(r.paretovariate(0.6)), 400)}" for _ in range(40_000)]
    docs = []
    for i in range(900):
        at = r.randrange(39_000)
        docs.append((i, " ".join(usual[at : at + r.choice([3, 30, 200])])))
    docs += [(1000 + i, docs[4][1]) for i in range(60)]  # copies: ties go to the smaller ids
    docs += [(2000, None), (2001, ""), (2002, " .,!?\n"), (2003, "Éé é_w5 W7-w7\x7fw7 日本 w9\u0085w9"), (None, "w1 w2 w3 w4 rare"), (2004, "w300 " * 20_000), (2005, "rare RARE")]
    items = [(j, " ".join(r.choice(usual) for _ in range(r.randint(1, 25)))) for j in range(40)]
    items += [(50, None), (51, "..."), (52, "nowhere"), (53, docs[4][1]), (54, "rare w1 rare"), (55, "É_é W9 w9 日本 w7"), (56, "w1 " * 3000)]
    table = spark.createDataFrame([(*d, "x", "y", 1, "b", 2) for d in docs], DOCS).repartition(4)
    return docs, items, table, spark.createDataFrame([(*i, 5, 1, "o") for i in items] + [(54, "zzz later text", 1, 1, "o"), (None, "w1", 1, 1, "o")], ITEMS)


@pytest.mark.parametrize(("owners", "block_docs", "bundle_items"), [(4, 100, 10), (1, 5000, 1000), (7, 37, 17)])
def test_ranked_documents(corpus, owners, block_docs, bundle_items):
    docs, items, table, asked = corpus
    assert rows(lexical.ranked_documents(table, asked, 10, owners, block_docs, bundle_items)) == brute(docs, items)


def test_accumulators_stay_few(spark, corpus):
    """Before the owner of the most frequent terms, most documents have left the bundles or were never in."""
    docs, items, table, asked = corpus
    index = lexical.LexicalIndex(table, asked, 4, 300)
    volume = index.terms.groupBy("cell").agg(F.sum("df").alias("n")).collect()
    by_owner = Counter()
    for r in volume:
        by_owner[int(index._owner.value[r.cell])] += r.n
    assert sorted(by_owner) == [0, 1, 2, 3] and max(by_owner.values()) < 0.6 * sum(by_owner.values())
    most_frequent = max(volume, key=lambda r: r.n)
    assert index._owner.value[most_frequent.cell] == 3


def test_repeated_rows_and_other_sizes(spark):
    docs = [(1, "a b"), (1, "a b"), (1, "a c"), (2, "a")]
    found = lexical.ranked_documents(spark.createDataFrame(docs, "doc_id LONG, text STRING"), spark.createDataFrame([(9, "b c")], "item_id LONG, text STRING"), 2).orderBy("rank").collect()
    # the only one with "c", then one of the two equal rows with "b"
    assert [(r["rank"], r.doc_id) for r in found] == [(1, 1), (2, 1)] and found[0].score > found[1].score


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id LONG, text STRING"), spark.createDataFrame([], "item_id LONG, text STRING")
    some = spark.createDataFrame([(1, "a b")], docs.schema)
    one = spark.createDataFrame([(1, "a")], items.schema)
    for d, i in ((docs, items), (some, items), (docs, one), (spark.createDataFrame([(1, None), (2, " ")], docs.schema), one)):
        assert lexical.ranked_documents(d, i).count() == 0
    assert rows(lexical.ranked_documents(some, one)) == brute([(1, "a b")], [(1, "a")])
