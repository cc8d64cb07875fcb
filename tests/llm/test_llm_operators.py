"""The operators on small tables with every oddity: NULLs, empty and long texts, ties, copies, extra columns."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trainlake.llm import bpe, counts, jaccard, packing, pii, substring, toxicity, vectors, warc
from trainlake.llm.components import components
from trainlake.llm.sketch import counted

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(seed, n, alphabet="abcdefgh"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(2, 6))) for _ in range(n))


def edited(text, every, seed=0):
    r, out = random.Random(seed), text.split()
    for i in range(0, len(out), every):
        out[i] = f"x{r.randint(0, 9999)}"
    return " ".join(out)


BASE, PASSAGE = words(1, 120), words(2, 40)
TEXTS = [
    None, "", " \n\t ", "one two", "One TWO", "three words only", BASE, BASE, edited(BASE, 60), edited(BASE, 50, 1), edited(BASE, 9),
    words(3, 60) + " " + PASSAGE + " " + words(4, 60), PASSAGE + " " + words(5, 200), "a " * 90, "Äöü ß 日本語 🎉 ½ \u0085 \x1c x" * 30,
    words(6, 30_000), "x" * 50_000, "mail a.b@c-d.org or +49 (30) 1234-567, 192.168.0.1 and 300.1.1.1", "card 4111 1111 1111 1111 visa, 4111 1111 1111 1112",
    "IBAN DE89 3704 0044 0532 0130 00; social security 123-45-6789", "@@ a@b a@b.c@d.e 1.2.3.4.5 " + "9" * 6000 + " <|endoftext|> don't  stop", edited(BASE, 60),
]
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, score STRING, starts INT, bucket INT, row STRING"


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, None if i % 3 else "en", "s", None, "x", 1, 2, None) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    rows = df.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: r for r in rows}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- byte-pair encoding ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.RANKS), special_tokens={})


def test_round_trip(documents, reference):
    found = by_id(bpe.round_trip_digests(documents))
    assert len(found) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = reference.encode_ordinary(text or "")
        assert (found[i].n_tokens, found[i].ids_sha256, found[i].decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(text or ""))


def test_encode_then_decode_tables(documents):
    again = by_id(bpe.decode_tokens(bpe.encode_texts(documents)))
    assert {i: r.text for i, r in again.items()} == {i: t or "" for i, t in enumerate(TEXTS)}


def test_transducer_equals_merging(reference):
    r, ranks = random.Random(5), bpe.load_ranks(bpe.RANKS)
    transducer, tokens = bpe.Transducer(ranks, max_states=500), list(ranks)
    for _ in range(1500):
        data = b"".join(r.choice(tokens) for _ in range(r.randint(1, 4)))[:120]
        assert transducer.encode(data) == [ranks[p] for p in bpe.merged(data, ranks)]


def test_decoder_keeps_split_characters():
    decoder = bpe.Decoder({i: bytes([i]) for i in range(256)})
    held, out = b"", ""
    for byte in "aß日🎉".encode():
        held, text = decoder.feed(held, [byte])
        out += text
    assert (held, out) == (b"", "aß日🎉")
    for bad in (b"\xff", b"a\xe2\x82", b"\xc0\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80x", b"\xe2\x82a"):
        assert decoder.decode(bad) == bad.decode(errors="replace")


# -- counts by section -------------------------------------------------------------------------


def test_section_counts_add_up(documents, reference):
    rows, total = counts.section_counts(documents).collect(), Counter()
    for r in rows:
        total[r.doc_id] += r.n_tokens
    for i, text in enumerate(TEXTS):
        ids = Tokenizer.from_file(packing.JSON_FILE).encode(text or "", add_special_tokens=False).ids
        assert total[i] == len(ids)
        assert max(r.section for r in rows if r.doc_id == i) == (text or "").count("\n")


def test_tokens_over_borders(spark):
    text = "hello worldwide web"
    spans = list(zip(*(x.tolist() for x in counts.token_spans(text)), strict=True))
    assert spans == [tuple(o) for o in Tokenizer.from_file(packing.JSON_FILE).encode(text).offsets]
    (start, end) = next(s for s in spans if s[1] - s[0] > 4)
    df = spark.createDataFrame([(1, text, "x")], "doc_id LONG, text STRING, start STRING")
    cuts = spark.createDataFrame([(1, 0, start + 1), (1, start + 1, len(text)), (1, start + 1, len(text)), (2, 0, 1)], "doc_id LONG, start LONG, end LONG")
    most = counts.section_counts(df, cuts).orderBy("section").collect()
    first = counts.section_counts(df, cuts, rule="first").orderBy("section").collect()
    n = [sum(e <= start for _, e in spans), sum(s > start for s, _ in spans)]
    assert [r.n_tokens for r in most] == [n[0], n[1] + 1] and [r.n_crossing for r in most] == [0, 1]
    assert [r.n_tokens for r in first] == [n[0] + 1, n[1]] and [r.n_crossing for r in first] == [1, 0]
    alone = counts.section_counts(df, cuts.where("doc_id = 2")).collect()
    assert [(r.section, r.n_tokens) for r in alone] == [(counts.OUTSIDE, len(spans))]


# -- packing -----------------------------------------------------------------------------------


def test_packing(documents):
    tokenizer, rows = Tokenizer.from_file(packing.JSON_FILE), packing.pack_documents(documents).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text in enumerate(TEXTS):
        ids, at = tokenizer.encode(text or "", add_special_tokens=False).ids + [2], 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            piece = ids[at : at + r.length]
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(np.array(piece, "<u4").tobytes()))
            assert r.length == 1024 or k == 0
            at += r.length
        assert at == len(ids)
    for placed in by_sequence.values():
        placed.sort(key=lambda r: r.offset)
        assert [r.offset for r in placed] == [sum(p.length for p in placed[:k]) for k in range(len(placed))]
        assert sum(r.length for r in placed) <= 1024 and sum(3 * r.length > 1024 for r in placed) <= 2


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_length(seed):
    r = random.Random(seed)
    lengths = Counter(r.choice([r.randint(1, 40), r.randint(1, 100), 34, 100]) for _ in range(3000))
    rows = packing.plan(dict(lengths), 100)
    ranks, fill = defaultdict(list), Counter()
    spans = {}
    for n, rank, first, each, offset in sorted(rows):
        spans.setdefault(n, []).append((rank, first, each, offset))
    for n, own in spans.items():
        own.append((lengths[n], 0, 1, 0))
        for (a, first, each, offset), (b, *_) in zip(own[:-1], own[1:], strict=True):
            for k in range(b - a):
                ranks[first + k // each].append((offset + k % each * n, n))
    for placed in ranks.values():
        placed.sort()
        at = 0
        for offset, n in placed:
            assert offset == at
            at += n
        assert at <= 100
        fill[at] += 1
    assert sum(len(p) for p in ranks.values()) == 3000
    total = sum(n * c for n, c in lengths.items())
    assert len(ranks) <= -(-total // 100) * 1.05 + 1


# -- personal data -----------------------------------------------------------------------------


def test_pii(documents):
    def at(i, **parts):
        return ",".join(f"{k}:{TEXTS[i].index(p)}:{TEXTS[i].index(p) + len(p)}" for k, p in parts.items())

    found = by_id(pii.pii_digests(documents))
    assert found[17].spans == at(17, email="a.b@c-d.org", ip="192.168.0.1", phone="+49 (30) 1234-567")
    assert (found[18].n_card, found[18].spans) == (1, at(18, card="4111 1111 1111 1111"))
    assert found[19].spans == at(19, iban="DE89 3704 0044 0532 0130 00", ssn="123-45-6789")
    assert found[20].n_email == 1 and found[20].n_ip == 1
    assert found[0].base_sha256 == found[1].base_sha256 == sha("")
    for i, text in enumerate(TEXTS[:17]):
        assert found[i].spans == "", i
    masked = {r.doc_id: r for r in pii.redact(documents).collect()}
    assert masked[0].text is None and masked[18].text == "card [CARD] visa, 4111 1111 1111 1112"
    assert masked[18].n_chars == len(masked[18].text) and pii.redact(documents).columns == documents.columns


@pytest.mark.parametrize("after", ["", " BIC COBADEFF", " 2 days", " Bank", " A 1 B 2 C 3", " GB82 WEST 1234 5698 7654 32 X", ". X"])
@pytest.mark.parametrize("iban", ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "NO9386011117947"])
def test_ibans_before_other_words(iban, after):
    text = f"XX11 IBAN {iban}{after}"
    found = [text[s.start : s.end] for s in pii.find_spans(text) if s.kind == "iban"]
    assert found == [iban] + ["GB82 WEST 1234 5698 7654 32"] * ("GB82" in after)
    assert not any(s.kind == "iban" for s in pii.find_spans(f"IBAN {iban}x and {iban[:-1]}"))


@pytest.mark.parametrize("seed", range(3))
def test_emails_are_the_leftmost_matches(seed):
    r, pattern = random.Random(seed), re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for _ in range(3000):
        text = "".join(r.choice("a@.- %b") for _ in range(r.randint(0, 25)))
        assert list(pii._emails(text)) == [m.span() for m in pattern.finditer(text)], text


# -- Jaccard join ------------------------------------------------------------------------------


def shingles(text):
    w = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_groups(texts):
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * len(a | sets[j]):
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return {i: (len(s), root(i)) for i, s in enumerate(sets)}


def test_jaccard_groups(documents):
    found = by_id(jaccard.linked_groups(documents))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == brute_groups(TEXTS)
    kept = {r.doc_id for r in jaccard.keep_one_of_each(documents).collect()}
    assert kept == {i for i, (_, c) in brute_groups(TEXTS).items() if c == i}


def test_jaccard_chains_and_borders(spark):
    """A chain in which only neighbours are similar, sets at exactly 75 %, and many copies with one passage."""
    long = words(9, 300).split()
    texts = [" ".join(long[10 * k : 10 * k + 150]) for k in range(8)]
    texts += [PASSAGE + " " + words(100 + k, 20) for k in range(20)] + [PASSAGE] * 5
    alphabet = [f"w{k}" for k in range(40)]
    for n in range(6, 16):
        texts += [" ".join(alphabet[:n]), " ".join(alphabet[: n + 2]), " ".join(alphabet[1 : n + 1])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    found = by_id(jaccard.linked_groups(df))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == brute_groups(texts)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 300), (300, 250)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a LONG, b LONG")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 200: 200, 250: 200, 300: 200}
    assert components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


# -- toxicity ----------------------------------------------------------------------------------


def test_levenshtein_automaton():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    r = random.Random(3)
    lexicon = {"".join(r.choice("abc") for _ in range(r.randint(1, 6))) for _ in range(60)}
    trie = toxicity.Trie(lexicon)
    for _ in range(150):
        word, most = "".join(r.choice("abc") for _ in range(r.randint(0, 6))), r.randint(0, 2)
        assert dict(toxicity.LevenshteinAutomaton(word, most).matches(trie)) == {w: distance(word, w) for w in lexicon if distance(word, w) <= most}


def labelled(spark, n=600):
    r, bad = random.Random(4), ["grumpf", "blarghen", "snotling"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = words(1000 + i, 40, "etaoinshr").split()
        for _ in range(3 * toxic):
            text.insert(r.randint(0, len(text)), r.choice(bad) + r.choice(["", "!", "###"]))
        rows.append((i, " ".join(text)))
        labels.append((i, 0, int(toxic)))
    labels += [(None, 0, 1), (n + 50, 1, None), (0, 0, 1)]
    return spark.createDataFrame(rows, "doc_id LONG, text STRING"), spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT")


def test_toxicity(spark, documents):
    texts, labels = labelled(spark)
    found = by_id(toxicity.predictions(texts, labels))
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7)
    right = [r.predicted == int(i % 5 == 0) for i, r in found.items() if r.held_out]
    assert sum(right) / len(right) > 0.97
    odd = [(1, None), (2, ""), (3, "you blargen and gruumpf and snotlinng, grumpf"), (4, "quiet words")]
    scored = by_id(toxicity.predictions(spark.createDataFrame(odd, "doc_id LONG, text STRING"), labels))
    assert scored[1].score == scored[2].score == scored[4].score  # nothing to learn from these rows: no hits, one score
    model = toxicity.fit(texts, labels)
    abuse, quoted = model.score("you blarghen and grumpf and snotling"), model.score('he said "blarghen" and "grumpf" and wrote "snotling" there')
    assert abuse > 0.7 > model.score("quiet words") and quoted < abuse
    assert model.score("you blargen and gruumpf and snotlinng") > model.score("quiet words")


def test_toxicity_keeps_columns_and_clean_rows(spark, documents, nothing):
    none = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    kept = toxicity.keep_civil(documents, none)
    assert kept.columns == documents.columns and kept.count() == len(TEXTS)
    texts, labels = labelled(spark)
    assert sorted(r.doc_id for r in toxicity.keep_civil(texts, labels).collect() if r.doc_id % 5) == [i for i in range(600) if i % 5]


# -- substring dedup ---------------------------------------------------------------------------


def brute_removed(texts, window=20):
    seen, out = set(), {}
    for i, text in enumerate(texts):
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if key in seen:
                gone[k : k + window] = [True] * window
            seen.add(key)
        out[i] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("texts", [TEXTS, ["a b " * 12, "b a " * 15, "a " * 21 + "b " * 25, PASSAGE + " x", "y " + PASSAGE, PASSAGE[:-1]] * 2])
def test_substring_dedup(spark, texts):
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id LONG, text STRING, mark INT").repartition(4)
    found = by_id(substring.kept_digests(df))
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in found.items()} == brute_removed(texts)


def test_removed_words_leave_the_documents(documents):
    rows = {r.doc_id: r for r in substring.remove_repeats(documents).collect()}
    wanted = brute_removed(TEXTS)
    assert len(rows) == len(TEXTS) and substring.remove_repeats(documents).columns == documents.columns
    for i, text in enumerate(TEXTS):
        if wanted[i][1]:
            assert sha(rows[i].text) == wanted[i][2] and rows[i].n_chars == len(rows[i].text)
        else:
            assert rows[i].text == text


def test_repeated_rows_with_one_id_stay(spark):
    df = spark.createDataFrame([(1, BASE), (1, BASE), (None, BASE)], "doc_id LONG, text STRING")
    rows = sorted((r.doc_id or 0, r.n_removed) for r in substring.kept_digests(df).collect())
    assert rows == [(0, 0), (1, 120), (1, 120)]  # the row without an id comes first


def test_a_common_passage_does_not_fill_a_bucket(spark):
    """Neither its occurrences nor the windows over its edges go by its few anchors."""
    texts = [f"{words(5000 + i, 5)} {PASSAGE} {words(9000 + i, 5)}" for i in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").repartition(3)
    sent = substring.sent_windows(df)
    size = sum(F.length(c) for c in sent.columns if c != "bucket")
    sizes = [r.n for r in sent.groupBy("bucket").agg(F.sum(size).alias("n")).collect()]
    assert len(sizes) > 16 and max(sizes) < 0.1 * sum(sizes)
    found = by_id(substring.kept_digests(df))
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in found.items()} == brute_removed(texts)


def test_sketch_never_counts_too_few(spark):
    r = random.Random(6)
    values = [r.randint(0, 400) for _ in range(900)]
    df = spark.createDataFrame([(v,) for v in values], "v LONG").repartition(5)
    for least in (1, 2):
        sketch = counted(df, lambda b: b.column("v").to_numpy().astype(np.uint64), least, log_width=16)
        often = [v for v, n in Counter(values).items() if n >= least]
        assert sketch.holds(np.array(often, np.uint64)).all()
        assert sketch.holds(np.arange(10_000, 20_000, dtype=np.uint64)).mean() < 0.1


# -- vectors -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def points(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(900, 6)).astype(np.float32)
    x[100:260] = x[7]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    odd = [(901, None), (902, [0.0] * 6), (903, [float("nan")] * 6), (904, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (905, [float("inf")] * 6), (906, [1.0, 2.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows + [(i, v, None) for i, v in odd] + rows[:3], "vec_id LONG, embedding ARRAY<FLOAT>, rank STRING")
    return df, x.astype(np.float64)


def test_nearest_neighbours(points):
    df, x = points
    rows, hits = vectors.nearest_neighbours(df, F.col("vec_id") % 20 == 0, 10).collect(), 0
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.rank):
        found[r.query_id].append(r)
    assert sorted(found) == list(range(0, 900, 20))
    for q, own in found.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        assert all(r.vec_id != q and abs(d[r.vec_id] - r.score) < 1e-12 for r in own) and [r["rank"] for r in own] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        d[q] = np.inf
        hits += len({r.vec_id for r in own} & set(np.lexsort((np.arange(len(d)), d))[:10].tolist()))
    assert hits >= 0.9 * 10 * len(found)


def test_lone_vectors_get_all_their_neighbours(spark):
    """Clusters of copies need one leaf; an outlier in a leaf of its own needs more."""
    x = [[100.0, 0.0, 0.0]] * 200 + [[0.0, 100.0, 0.0]] * 200 + [[150.0, 0.0, 40.0]]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id LONG, embedding ARRAY<DOUBLE>")
    index = vectors.TreeIndex(vectors.usable(df, zero=False), F.col("vec_id") % 10 == 0)
    assert index.visits == 1
    found = defaultdict(list)
    for row in index.search().collect():
        found[row.query_id].append(row["rank"])
    assert sorted(found) == [*range(0, 401, 10)]
    assert all(sorted(ranks) == list(range(1, 11)) for ranks in found.values())


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_exact_products(points, lists):
    df, x = points
    x = np.vstack([x, np.zeros((2, 6))])
    ids = np.array([*range(900), 902, -1])[:901]
    whole = np.floor(256 * x[:901])
    found = defaultdict(list)
    for r in vectors.best_products(df, F.col("vec_id") % 50 == 0, 5, lists).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert sorted(found) == [i for i in ids.tolist() if i % 50 == 0]
    for q, own in found.items():
        s = whole @ whole[ids == q][0]
        order = [k for k in np.lexsort((ids, -s)).tolist() if ids[k] != q][:5]
        assert sorted(own) == [(n, int(ids[k]), int(s[k])) for n, k in enumerate(order, 1)]


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 1.0])], "vec_id LONG, embedding ARRAY<FLOAT>")
    assert {(r.query_id, r.vec_id) for r in vectors.nearest_neighbours(df, F.col("vec_id") % 50 == 0).collect()} == {(0, 50), (50, 0)}
    assert {(r.query_id, r.vec_id) for r in vectors.best_products(df, F.col("vec_id") % 50 == 0).collect()} == {(0, 50), (50, 0)}


# -- WARC --------------------------------------------------------------------------------------


def test_fixity_audit(spark):
    r = random.Random(8)
    pages = [(i, f"http://h/{i}" if i % 7 else None, words(i, r.randint(1, 900)) if i % 11 else None) for i in range(2300)] + [(None, None, None), (None, "u", "h"), (5, "http://h/5", words(5, 3))]
    bodies = warc.records(spark.createDataFrame(pages, "page_id LONG, url STRING, html STRING"))
    mine = warc.manifest(bodies)
    assert warc.audit(mine, warc.manifest(bodies.repartition(5))).count() == 0
    rotten = F.when(F.col("record_id").isin(17, 1999), F.concat(F.expr("substr(body, 1, length(body) - 1)"), F.lit("?"))).otherwise(F.col("body"))
    theirs = bodies.where("record_id IS NULL OR record_id < 2250").withColumn("body", rotten)
    found = {(x.record_id, x.state) for x in warc.audit(mine, warc.manifest(theirs)).collect()}
    assert found == {(17, "corrupt"), (1999, "corrupt")} | {(i, "missing") for i in range(2250, 2300)}
    extra = {(x.record_id, x.state) for x in warc.audit(warc.manifest(theirs), mine).collect()}
    assert extra == {(17, "corrupt"), (1999, "corrupt")} | {(i, "extra") for i in range(2250, 2300)}
    # a record lost in the middle moves those after it
    moved = warc.audit(mine, warc.manifest(bodies.where("record_id IS NULL OR record_id <> 2290"))).collect()
    assert {(x.record_id, x.state) for x in moved} == {(2290, "missing")} | {(i, "moved") for i in range(2291, 2300)}


def test_read_warc(spark, tmp_path):
    import gzip

    rows = spark.createDataFrame([(1, "http://a/ä", "<p>ß</p>"), (2, None, None)], "page_id LONG, url STRING, html STRING")
    bodies = [r.body.encode() for r in warc.records(rows).orderBy("record_id").collect()]
    (tmp_path / "a.warc").write_bytes(b"".join(bodies))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(b) for b in bodies) + gzip.compress(b"WARC/1.1\r\nContent-Length: 99\r\n\r\ntorn"))
    found = sorted((r.file[-1], r.offset, r.type, r.url, bytes(r.block).decode()) for r in warc.read_warc(spark, str(tmp_path)).collect())
    assert found == [(f, o, "response", u, b) for f in "cz" for o, u, b in ((0, "http://a/ä", "<p>ß</p>"), (len(bodies[0]), None, ""))]


# -- empty tables ------------------------------------------------------------------------------


def test_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    embeddings = spark.createDataFrame([], "vec_id LONG, embedding ARRAY<FLOAT>")
    pages = warc.manifest(warc.records(spark.createDataFrame([], "page_id LONG, url STRING, html STRING")))
    for made in (
        bpe.round_trip_digests(nothing), counts.section_counts(nothing), packing.pack_documents(nothing), pii.pii_digests(nothing), pii.redact(nothing),
        jaccard.linked_groups(nothing), jaccard.keep_one_of_each(nothing), toxicity.predictions(nothing, labels), toxicity.keep_civil(nothing, labels),
        substring.kept_digests(nothing), substring.remove_repeats(nothing), vectors.nearest_neighbours(embeddings, F.col("vec_id") > 0),
        vectors.best_products(embeddings, F.col("vec_id") > 0), warc.audit(pages, pages),
    ):
        assert made.count() == 0


def test_json_file_and_ranks_agree():
    vocabulary = json.load(open(packing.JSON_FILE))["model"]["vocab"]
    assert len(vocabulary) == len(bpe.load_ranks(bpe.RANKS))
