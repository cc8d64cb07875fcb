"""``corpus_pipeline.run`` on a small corpus against the same five stages done by hand."""

import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F
from test_llm_operators import PASSAGE, WORD, brute_groups, labelled
from tokenizers import Tokenizer

import corpus_pipeline
from trainlake.llm import packing

MAIL = "a.b@c-d.org"


def corpus(spark):
    texts, labels = labelled(spark)
    given = {r.doc_id: r.text for r in texts.collect()}
    toxic = {i for i in given if i % 5 == 0}
    given |= {1000 + i: given[i] for i in (1, 2, 3)}
    given |= {1010: " ".join([*given[4].split()[:-1], "other"]), 1020: f"{PASSAGE} {given[6]}", 1021: f"{given[7]}\n{PASSAGE}", 1030: " ".join(reversed(given[8].split())) + f" mail {MAIL} now"}
    given |= {1040: None, 1041: "", 1050: " ".join(given[i] for i in range(11, 600) if i % 5)}
    return given, toxic, labels


def by_hand(given, toxic):
    civil = {i: t for i, t in sorted(given.items()) if i not in toxic}
    groups = brute_groups(list(civil.values()))
    kept = {i: t for k, (i, t) in enumerate(civil.items()) if groups[k][1] == k}
    seen, left = set(), {}
    for i, text in kept.items():
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            key = tuple(words[k : k + 20])
            if key in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        left[i] = " ".join(w for w, g in zip(words, gone, strict=True) if not g) if any(gone) else text
    return {i: t.replace(MAIL, "[EMAIL]") if t else t for i, t in left.items()}


def test_run_equals_the_stages_by_hand(spark, tmp_path):
    given, toxic, labels = corpus(spark)
    rows = [(i, t, "en", "s", len(t or "")) for i, t in given.items()]
    spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    wanted = by_hand(given, toxic)
    assert 1001 not in wanted and 1010 not in wanted and len(wanted[1020].split()) < 45 and "[EMAIL]" in wanted[1030] and wanted[1040] is None

    tokenizer = Tokenizer.from_file(packing.JSON_FILE)
    pieces, places = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).orderBy("doc_id", "piece").collect():
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert sorted(pieces) == sorted(wanted)
    for i, text in wanted.items():
        ids, at = tokenizer.encode(text or "", add_special_tokens=False).ids + [2], 0
        for n, r in enumerate(pieces[i]):
            own = ids[at : at + r.length]
            assert (r.piece, r.start, r.length, r.ids_crc32) == (n, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
            at += r.length
        assert at == len(ids), i
    for own in places.values():
        own.sort()
        assert [a for a, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 1024


def test_stages_stand_rows_that_repeat_or_lack_ids(spark):
    """Each stage but the last gives the columns of documents; copies without an id become one."""
    given, toxic, labels = corpus(spark)
    odd = [(None, given[1]), (None, given[1]), (2, given[2]), (2, given[2]), (2, given[9]), (None, None), (None, "")]
    rows = [(i, t, None, None, None) for i, t in [*given.items(), *odd]]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG").repartition(3)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert all(texts.count(given[i]) == 1 for i in (1, 2, 9)) and texts.count(None) == 2 and texts.count("") == 2
    assert kept.where(F.col("doc_id").isNull()).count() == 2
