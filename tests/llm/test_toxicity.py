"""What the lexicon learns and what it finds: every class of misspelling, stems, all hits of a text."""

import math
import random

import pytest

from trainlake.llm import toxicity
from trainlake.llm.toxicity import BY_STEM, Lexicon

WORDS = {"scum": 5.0, "loser": 6.0, "worthless": 7.0, "blargenta": 4.0, "vequ*": 3.0, "vequaire": 3.5, "oaf": 2.0}


@pytest.mark.parametrize(
    ("token", "entry"),
    [
        ("scums", "scum"), ("scm", "scum"), ("skum", "scum"), ("sucm", "scum"), ("xscum", "scum"), ("cum", "scum"), ("csum", "scum"),  # four letters
        ("losre", "loser"), ("lsoer", "loser"), ("looser", "loser"), ("lose", "loser"), ("lozer", "loser"),
        ("worthlss", "worthless"), ("wortlhess", "worthless"), ("wrothles", "worthless"), ("w0rthl3ss", "worthless"), ("orthlessx", "worthless"), ("wwoorthless", "worthless"),
        ("vquaire", "vequaire"), ("evquaire", "vequaire"),  # a word that a stem begins
    ],
)
def test_misspellings_are_found(token, entry):
    lexicon = Lexicon(WORDS)
    assert lexicon.misspelled(token) == [entry]
    assert lexicon.weight(token) == (WORDS[entry], True)


@pytest.mark.parametrize("token", ["scam" + "s", "sc", "lsore", "losreee", "worthl", "oa", "oaff", "of", "muscle", "", "w"])
def test_others_are_not(token):
    assert Lexicon(WORDS).misspelled(token) == [] and Lexicon(WORDS).weight(token)[0] == 0.0


def test_exact_words_stems_and_words_not_sought():
    lexicon = Lexicon(WORDS)
    assert lexicon.weight("scum!?") == (5.0, False) and lexicon.weight("oaf") == (2.0, False)
    assert lexicon.weight("vequoble") == (BY_STEM * 3.0, False) and lexicon.weight("vequaire") == (3.5, False)
    assert lexicon.weight("vequ") == (0.0, False)  # a stem needs an ending
    assert Lexicon(WORDS, frozenset({"loser"})).misspelled("skum") == []


def test_swaps_are_one_edit():
    def distance(a, b):  # optimal string alignment
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    r = random.Random(8)
    lexicon = {"".join(r.choice("abc") for _ in range(r.randint(1, 7))) for _ in range(70)}
    trie = toxicity.Trie(lexicon)
    for _ in range(200):
        word, most = "".join(r.choice("abc") for _ in range(r.randint(0, 7))), r.randint(0, 2)
        found = dict(toxicity.LevenshteinAutomaton(word, most, swaps=True).matches(trie))
        assert found == {w: distance(word, w) for w in lexicon if distance(word, w) <= most}
        # the filter before the automaton loses none
        for w in found:
            size, letters, pairs = (x[0] for x in toxicity._outlines([word]))
            own_size, own_letters, own_pairs = (x[0] for x in toxicity._outlines([w]))
            assert abs(size - own_size) <= most and (letters ^ own_letters).item().bit_count() <= 2 * most
            assert (pairs & own_pairs).item().bit_count() >= own_pairs.item().bit_count() - 3 * most


def test_tokens_are_learned_in_bulk_as_one_by_one():
    r = random.Random(2)
    tokens = {"".join(r.choice("scumloserwth") for _ in range(r.randint(0, 11))) for _ in range(3000)} | set(WORDS) | {w[:i] + w[i + 1 :] for w in WORDS for i in range(len(w))} | {"a\0b", "scum\0", "é" * 9, "!!"}
    together = Lexicon(WORDS)
    together.learn(tokens)
    assert len(together.hits) > 10
    for token in tokens:
        alone = Lexicon(WORDS).weight(token) if token in together.hits or r.random() < 0.05 else (0.0, False)
        assert together.hits.get(token, (0.0, False)) == alone
        assert token in together.hits or not together.misspelled(toxicity.plain(token)) or toxicity.plain(token) in WORDS


def test_the_store_of_tokens_is_bounded(monkeypatch):
    monkeypatch.setattr(Lexicon, "MOST", 10)
    lexicon = Lexicon(WORDS)
    for i in range(50):
        assert lexicon.features(f"word{i} other{i} scum") == [5.0, 0.0, math.log1p(1), 0.0, 0.0]
    assert len(lexicon.seen) < 20


def test_every_hit_counts():
    entries = {f"term{c}{d}": 1.0 for c in "abcdefgh" for d in "abc"}
    few, all_ = (Lexicon(entries).features(" so ".join(sorted(entries)[:n])) for n in (9, 24))
    assert few[1] == 8.0 and all_[1] == 23.0 and all_[2] == math.log1p(24)


def test_nested_stems():
    single = toxicity._single_stems({"blar*": 9, "blarg*": 9, "blargh*": 9, "vequ*": 90, "veque*": 30, "vequem*": 30, "snot*": 5, "snotl*": 4, "word": 3})
    assert single == {"blargh*", "vequ*", "snot*"}


def test_a_stem_needs_several_endings(spark):
    rows = [("vequ" + end, 3, 0) for end in ("a", "be", "co")] + [("snotling", 40, 0), ("hello", 1, 9), ("helm", 0, 9), ("held", 0, 9), ("helios", 1, 0)]
    found = {r.term: (r.n, r.o) for r in toxicity._with_stems(spark.createDataFrame(rows, "term STRING, n LONG, o LONG")).collect()}
    assert {t for t in found if t.endswith("*")} == {"vequ*"} and found["vequ*"] == (9, 0)
    assert len(found) == len(rows) + 1


@pytest.mark.parametrize("times", [1, 40])
def test_one_rule_at_every_size(spark, times):
    """What counts is how improbable chance is, not how many rows there are."""
    terms = spark.createDataFrame([("sure", 12, 0), ("unsure", 3, 0), ("even", 20, 80), ("mostly", 30, 10), ("other", 0, 50)], "term STRING, n LONG, o LONG")
    kept = {r.term for r in toxicity._one_sided(terms, 1000 * times, 4000 * times).collect()}
    assert kept == {"sure", "mostly"}


def test_labels_that_differ_and_repeated_rows(spark):
    rows = [(i, f"quiet {i} words" if i % 3 else f"you grumpf {i}x there") for i in range(240)]
    texts = spark.createDataFrame(rows + rows[:30] + [(None, "you grumpf"), (500, None)], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)] + [(0, 0), (3, None), (None, 1)], "doc_id LONG, toxic INT")
    found = toxicity.predictions(texts, labels).collect()
    assert len(found) == 272 and all(0 <= r.score <= 1 for r in found)
    by_id = {}
    for r in found:
        assert by_id.setdefault(r.doc_id, r) == r  # equal rows, equal scores
    assert by_id[None].predicted == 1 and by_id[500].predicted == 0
    assert all(by_id[i].predicted == int(i % 3 == 0) for i in range(240))
