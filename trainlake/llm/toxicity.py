"""Toxicity by a learned lexicon: Levenshtein automata over its trie, context windows, a small classifier.

The lexicon (whole words, and stems ``abcd*``) is learned from one half of the training rows.
A term is counted in *different* contexts, so copies count once.  It becomes an entry if most of
its contexts are toxic, and if chance alone would hardly make them so: one rule, whatever the
number of rows.  A stem also has to be seen with several different endings; of nested stems one
is kept.  A word scores by the entry it equals, by a stem it begins with (which weighs less), or by the
heaviest entry it misspells: a Levenshtein automaton of the word, which takes swapped letters
for one edit, is intersected with the trie of the lexicon's words.  Words of 4 to 7 letters are found
with one edit, longer ones with two; a word whose neighbours are as common in clean texts is not
looked for.  Each hit is weighed by its window of neighbours: quotation marks around it, or a word that
reports speech before it, make it quotation, which counts a fraction of abuse.  A logistic
regression on five sums of these weights, fitted on the other half, gives the score.

At most ``MAX_ROWS`` labelled rows are used for fitting; all else covers all rows.  A document that is
labelled more than once counts as toxic if one label says so; NULL ids and labels are passed over.
Repeated rows are scored each on its own.
"""

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from trainlake.llm.common import cut, map_arrow, sliced, small_batches, texts

#: Most labelled rows used for fitting (drawn by a hash of the id).
MAX_ROWS = 20_000
#: Least share of toxic contexts of an entry (by equal amounts of text), and how probable chance may be.
MIN_SHARE, CHANCE = 0.8, 1e-4
#: Letters of stems, and the different words a stem has to begin.
STEMS, ENDINGS = range(4, 9), 3
#: What a stem and a misspelling count of the full weight.
BY_STEM, MISSPELLED = 0.8, 0.7
NEAR, QUOTED = 6, 0.3
THRESHOLD = 0.7
REPORTING = frozenset("said says wrote writes quoted quote called word term reported sagte schrieb zitat dit écrit mot dijo escribió palabra".split())
_MARKS = "\"'“”„«»‘’"
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


class Trie:
    __slots__ = ("next", "word")

    def __init__(self, words: Iterator[str] = ()):
        self.next: dict[str, Trie] = {}
        self.word: str | None = None
        for word in words:
            node = self
            for c in word:
                node = node.next.setdefault(c, Trie())
            node.word = word


class LevenshteinAutomaton:
    """Accepts the words within ``most`` edits of ``word``; states are made deterministic when first met.

    A state holds positions (letters of the word, edits, whether the next letter closes a swap).  With
    ``swaps``, two neighbouring letters in the other order are one edit.
    """

    def __init__(self, word: str, most: int, swaps: bool = False):
        self.word, self.most, self.swaps = word, most, swaps
        self.start = self._closed({(0, 0, False)})
        self._steps: dict[tuple, frozenset] = {}

    def _closed(self, states: set) -> frozenset:
        """With the positions that deletions lead to."""
        todo, seen = list(states), set(states)
        while todo:
            i, e, swapped = todo.pop()
            if not swapped and i < len(self.word) and e < self.most and (i + 1, e + 1, False) not in seen:
                seen.add((i + 1, e + 1, False))
                todo.append((i + 1, e + 1, False))
        return frozenset(seen)

    def step(self, states: frozenset, c: str) -> frozenset:
        if (known := self._steps.get((states, c))) is None:
            after = set()
            for i, e, swapped in states:
                if swapped:
                    if self.word[i] == c:
                        after.add((i + 2, e, False))
                    continue
                if i < len(self.word) and self.word[i] == c:
                    after.add((i + 1, e, False))
                if e < self.most:
                    after.add((i, e + 1, False))
                    if i < len(self.word):
                        after.add((i + 1, e + 1, False))
                    if self.swaps and i + 1 < len(self.word) and self.word[i + 1] == c:
                        after.add((i, e + 1, True))
            known = self._steps[states, c] = self._closed(after)
        return known

    def edits(self, states: frozenset) -> int | None:
        return min((e for i, e, swapped in states if i == len(self.word) and not swapped), default=None)

    def matches(self, trie: Trie) -> Iterator[tuple[str, int]]:
        """The words of a trie that are accepted, with their distance."""
        todo = [(trie, self.start)]
        while todo:
            node, states = todo.pop()
            if node.word is not None and (e := self.edits(states)) is not None:
                yield node.word, e
            for c, child in node.next.items():
                if after := self.step(states, c):
                    todo.append((child, after))


def plain(token: str) -> str:
    """A lower-case token without the marks at its ends."""
    return token if token[:1].isalnum() and token[-1:].isalnum() else _EDGE.sub("", token)


def edits_of(word: str) -> int:
    """How many edits a misspelling of a word may have; none for words of up to three letters."""
    return 0 if len(word) < 4 else 1 if len(word) < 8 else 2


def _less(word: str, letters: int) -> set[str]:
    """The word without any of its letters, up to so many: words within that many edits have one of these in common."""
    out = new = {word}
    for _ in range(letters):
        new = {w[:i] + w[i + 1 :] for w in new for i in range(len(w))}
        out = out | new
    return out


def _outlines(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length, and sets of (hashed) letters and of neighbouring letters as bits, of each word."""
    codes = np.frombuffer("".join(w.replace("\0", "\1") + "\0" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.flatnonzero(codes == 0)
    starts = np.r_[0, ends[:-1] + 1][: len(ends)]
    one = np.uint64(1)
    letters = np.where(codes > 0, one << (codes % np.uint64(61)), np.uint64(0))
    pairs = np.zeros(len(codes), np.uint64)
    inside = (codes[:-1] > 0) & (codes[1:] > 0)
    pairs[:-1][inside] = one << ((codes[:-1] * np.uint64(31) + codes[1:])[inside] % np.uint64(61))
    if not len(starts):
        return starts, letters, pairs
    return ends - starts, np.bitwise_or.reduceat(letters, starts), np.bitwise_or.reduceat(pairs, starts)


def _letters(words: list[str]) -> np.ndarray:
    """How often each (hashed) letter is in each word."""
    codes = np.frombuffer("".join(w.replace("\0", "\1") + "\0" for w in words).encode("utf-32-le"), np.uint32)
    row = np.cumsum(codes == 0) - (codes == 0)
    return np.bincount(row * 32 + codes % 32, codes > 0, minlength=32 * len(words)).reshape(len(words), 32).astype(np.int16)


class Lexicon:
    """Weights of entries; ``learn`` finds those of tokens, which are kept (up to a stated number).

    ``sought``: the whole words that are looked for misspelled, by default all.
    """

    MOST, CHUNK = 400_000, 4096

    def __init__(self, entries: dict[str, float], sought: frozenset[str] | None = None):
        self.entries = entries
        self.sought = frozenset(w for w in entries if not w.endswith("*") and edits_of(w)) if sought is None else sought
        self.trie = Trie(sorted(self.sought))
        by_edits = {e: own for e in (1, 2) if (own := sorted(w for w in self.sought if edits_of(w) == e))}
        self.outlines = {e: _outlines(own) for e, own in by_edits.items()}
        self.letters = {e: _letters(own) for e, own in by_edits.items()}
        self.less = {e: frozenset().union(*(_less(w, e) for w in own)) for e, own in by_edits.items()}
        self.stems = tuple(n for n in STEMS if any(e.endswith("*") and len(e) == n + 1 for e in entries))
        self.starts = {e[: STEMS[0]] for e in entries if e.endswith("*")}
        #: tokens met before, and (weight, misspelled) of those with a weight
        self.seen: set[str] = set()
        self.hits: dict[str, tuple[float, bool]] = {}

    def perhaps_misspelled(self, words: list[str]) -> list[str]:
        """Those of the words that may be within the edits of a word sought, by their outlines, then by what is left of both without a few letters.

        An edit changes the length by one, the letters by two and takes three neighbourhoods away at most.
        """
        out = []
        for first in range(0, len(words), self.CHUNK):
            chunk = words[first : first + self.CHUNK]
            size, letters, pairs = (x[:, None] for x in _outlines(chunk))
            found = set()
            for e, (sizes, own_letters, own_pairs) in self.outlines.items():
                ok = np.abs(size - sizes[None, :]) <= e
                ok &= np.bitwise_count(letters ^ own_letters[None, :]) <= 2 * e
                ok &= np.bitwise_count(pairs & own_pairs[None, :]) + np.uint8(3 * e) >= np.bitwise_count(own_pairs)[None, :]
                i, w = np.nonzero(ok)
                if len(i):
                    near, at = np.unique(i, return_inverse=True)
                    own = _letters([chunk[k] for k in near.tolist()])
                    close = i[np.abs(own[at] - self.letters[e][w]).sum(axis=1) <= 2 * e]
                    found.update(k for k in np.unique(close).tolist() if k not in found and not self.less[e].isdisjoint(_less(chunk[k], e)))
            out += [chunk[i] for i in sorted(found)]
        return out

    def misspelled(self, word: str) -> list[str]:
        """The entries of which the word is a misspelling."""
        most = max((e for e in self.outlines if len(word) + e >= 4 * e), default=0)
        if not most:
            return []
        return [w for w, e in LevenshteinAutomaton(word, most, swaps=True).matches(self.trie) if 0 < e <= edits_of(w)]

    def learn(self, tokens: set[str]) -> None:
        """See to it that the lower-case tokens are among those ``seen``."""
        new = tokens - self.seen
        if not new:
            return
        if len(self.seen) >= self.MOST:
            self.seen, self.hits, new = set(), {}, tokens
        self.seen |= new
        open_: dict[str, list[str]] = {}
        entries, stems, shortest = self.entries, self.stems, STEMS[0]
        starts = self.starts
        for token in new:
            word = plain(token)
            weight = entries.get(word, 0.0)
            if word[:shortest] in starts:
                for n in stems:
                    if n < len(word) and (by_stem := BY_STEM * entries.get(word[:n] + "*", 0.0)) > weight:
                        weight = by_stem
            if weight:
                self.hits[token] = (weight, False)
            else:
                open_.setdefault(word, []).append(token)
        for word in self.perhaps_misspelled(list(open_)):
            if found := self.misspelled(word):
                weight = max(entries[w] for w in found)
                self.hits.update((token, (weight, True)) for token in open_[word])

    def weight(self, token: str) -> tuple[float, bool]:
        """(weight, misspelled) of a lower-case token; 0 for tokens without an entry."""
        self.learn({token})
        return self.hits.get(token, (0.0, False))

    def features(self, text: str) -> list[float]:
        return self.features_of([text])[0]

    def features_of(self, texts: list[str]) -> list[list[float]]:
        split = [text.lower().split() for text in texts]
        self.learn(set().union(*split))
        return [self._features(tokens) for tokens in split]

    def _features(self, tokens: list[str]) -> list[float]:
        hits = self.hits
        if hits.keys().isdisjoint(tokens):
            return [0.0] * 5
        abuse: dict[str, float] = {}
        quoted = near = 0.0
        for i, token in enumerate(tokens):
            if token not in hits:
                continue
            w, misspelled = hits[token]
            w *= MISSPELLED if misspelled else 1.0
            if _quotation(tokens, i):
                quoted += w
                w *= QUOTED
            near += misspelled
            word = plain(token)
            abuse[word] = max(abuse.get(word, 0.0), w)
        each = sorted(abuse.values(), reverse=True)
        return [each[0], sum(each[1:]), math.log1p(len(each)), math.log1p(near), math.log1p(quoted)]


def _quotation(tokens: list[str], i: int) -> bool:
    """Whether a hit stands inside quotation marks, or soon after a word that reports speech."""
    if any(plain(t) in REPORTING for t in tokens[max(0, i - 3) : i]):
        return True
    opened = any(t[0] in _MARKS for t in tokens[max(0, i - NEAR) : i + 1])
    closed = any(t.rstrip(".,;:!?")[-1:] in _MARKS and t.rstrip(".,;:!?") for t in tokens[i : i + NEAR + 1])
    return opened and closed


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def score(self, text: str) -> float:
        return self.scores([text])[0]

    def scores(self, texts: list[str]) -> list[float]:
        z = [float(self.weights[0] + np.dot(self.weights[1:], f)) for f in self.lexicon.features_of(texts)]
        return [1 / (1 + math.exp(-max(-35.0, min(35.0, x)))) for x in z]


def _training(documents: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``text, toxic, half``: at most about ``most`` labelled rows that are not held out, drawn by a hash of the id."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    draw = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, most / max(n, 1)))
    rows = texts(documents).join(known.where(draw), F.col("doc_id") == F.col("id"))
    return rows.select("text", "toxic", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).cast("int").alias("half"))


def _around(tokens: list[str], i: int) -> int:
    """A hash of the words before and after."""
    return hash_of([*(plain(t) for t in tokens[max(0, i - 1) : i]), "", *(plain(t) for t in tokens[i + 1 : i + 2])])


def _counted(rows: DataFrame, terms_of) -> DataFrame:
    """``term, n, o``: in how many different contexts of toxic and of other texts the terms of each token stand.

    ``terms_of`` a set of tokens gives the terms of those that have any.
    """

    def step(batch: pa.RecordBatch):
        split = [text.lower().split() for text in batch.column("text").to_pylist()]
        terms = terms_of(set().union(*split))
        found: set[tuple[str, int, int]] = set()
        for tokens, toxic in zip(split, batch.column("toxic").to_pylist(), strict=True):
            for i, token in enumerate(tokens):
                if token in terms:
                    around = _around(tokens, i)
                    found.update((t, around, toxic) for t in terms[token])
        columns = list(zip(*found, strict=True)) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32()), strict=True)], ["term", "around", "toxic"])

    each = map_arrow(rows.select("text", "toxic"), step, "term STRING, around LONG, toxic INT").distinct()
    return each.groupBy("term").agg(F.sum("toxic").alias("n"), F.sum(1 - F.col("toxic")).alias("o"))


def _with_stems(words: DataFrame) -> DataFrame:
    """Words and the stems they begin with, each with ``n``, ``o`` and whether it is a word, or a stem with enough endings in toxic texts."""
    stems = F.filter(F.transform(F.array(*map(F.lit, STEMS)), lambda k: F.when(F.length("term") > k, F.substring("term", F.lit(1), k))), lambda s: s.isNotNull())
    each = words.select(F.explode(stems).alias("stem"), "term", "n", "o")
    next_letter = F.when(F.col("n") > 0, F.substring("term", F.length("stem") + 1, F.lit(1)))
    found = each.groupBy("stem").agg(F.sum("n").alias("n"), F.sum("o").alias("o"), F.sum((F.col("n") > 0).cast("int")).alias("endings"), F.count_distinct(next_letter).alias("letters"))
    wide = (F.col("endings") >= ENDINGS) & (F.col("letters") > 1)
    return words.select("term", "n", "o").union(found.where(wide).select(F.concat("stem", F.lit("*")), "n", "o"))


def _one_sided(terms: DataFrame, toxic: int, other: int) -> DataFrame:
    """The terms with enough of their contexts in toxic texts; ``toxic`` and ``other``: contexts of all words.

    Chance is bounded by Chernoff's inequality for the toxic share of ``n + o`` contexts.
    """
    expected, n, o = toxic / (toxic + other), F.col("n"), F.col("o")
    share = n / (n + o)
    apart = n * F.log(share / expected) + F.when(o > 0, o * F.log((1 - share) / (1 - expected))).otherwise(0.0)
    even = n / (n + o * (toxic / other))
    return terms.where((n > 0) & (share > expected)).where((apart >= -math.log(CHANCE)) & (even >= MIN_SHARE))


def _single_stems(counts: dict[str, int]) -> set[str]:
    """Of nested stems the shortest, but the longest of those with as many contexts."""
    kept: dict[str, int] = {}
    for stem in sorted((t[:-1] for t in counts if t.endswith("*")), key=lambda s: (len(s), s)):
        n = counts[stem + "*"]
        outer = next((stem[:k] for k in range(len(stem) - 1, 0, -1) if stem[:k] in kept), None)
        if outer is None or kept[outer] == n:
            kept.pop(outer, None)
            kept[stem] = n
    return {s + "*" for s in kept}


def hash_of(words: list[str]) -> int:
    return zlib.crc32("\x00".join(words).encode())


def fit(documents: DataFrame, labels: DataFrame, most: int = MAX_ROWS) -> Model:
    """Lexicon from one half of the training rows, classifier from the other; without both labels it scores 0."""
    rows = cut(_training(documents, labels, most))
    sizes = Counter({(r["half"], r["toxic"]): r["count"] for r in rows.groupBy("half", "toxic").count().collect()})
    if not (sizes[0, 1] and sizes[0, 0] and sizes[1, 1] and sizes[1, 0]):
        return Model(Lexicon({}), np.array([-35.0, 0, 0, 0, 0, 0]))
    first = rows.where("half = 0")
    words = cut(_counted(first, lambda tokens: {t: [word] for t in tokens if (word := plain(t))}))
    toxic, other = words.agg(F.sum("n"), F.sum("o")).first()
    if not toxic or not other:
        return Model(Lexicon({}), np.array([-35.0, 0, 0, 0, 0, 0]))
    # every entry stands in several contexts of the sampled rows: their number is bounded as these are
    found = {r["term"]: (r["n"], r["o"]) for r in _one_sided(_with_stems(words), toxic, other).collect()}
    stems = _single_stems({t: n for t, (n, _) in found.items()})
    entries = {t: math.log((n + 0.1) / (o * toxic / other + 0.1)) for t, (n, o) in sorted(found.items()) if not t.endswith("*") or t in stems}
    given = documents.sparkSession.sparkContext.broadcast(entries)

    def neighbours(tokens: set[str]) -> dict[str, list[str]]:
        own = Lexicon(given.value)
        words = {t: word for t in tokens if (word := plain(t)) not in own.entries}
        found = {word: terms for word in own.perhaps_misspelled(sorted(set(words.values()))) if (terms := own.misspelled(word))}
        return {t: found[word] for t, word in words.items() if word in found}

    doubtful = {r["term"] for r in _counted(first, neighbours).collect() if r["o"] * toxic / other >= r["n"] + 0.5}
    lexicon = Lexicon(entries, Lexicon(entries).sought - doubtful)
    learned = documents.sparkSession.sparkContext.broadcast((entries, lexicon.sought))

    def step(batch: pa.RecordBatch):
        own = Lexicon(*learned.value)
        made = np.array(own.features_of(batch.column("text").to_pylist())).reshape(batch.num_rows, 5)
        yield pa.RecordBatch.from_arrays([*(pa.array(made[:, k]) for k in range(5)), batch.column("toxic")], [*(f"f{k}" for k in range(5)), "toxic"])

    made = map_arrow(rows.where("half = 1").select("text", "toxic"), step, ", ".join(f"f{k} DOUBLE" for k in range(5)) + ", toxic INT").toArrow()
    x = np.stack([made.column(f"f{k}").to_numpy() for k in range(5)], axis=1)
    return Model(lexicon, logistic(x, made.column("toxic").to_numpy().astype(float)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton's method with a small penalty; the intercept comes first."""
    x = np.c_[np.ones(len(x)), x]
    w, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _scored(rows: DataFrame, model: Model, text_of) -> DataFrame:
    """The rows with a ``score``; ``text_of`` a batch gives the texts."""
    given = rows.sparkSession.sparkContext.broadcast((model.lexicon.entries, model.lexicon.sought, model.weights))

    def run(batches):
        entries, sought, weights = given.value
        own = Model(Lexicon(entries, sought), weights)
        for batch in batches:
            for piece in sliced(batch):
                made = pa.array(own.scores([t or "" for t in text_of(piece).to_pylist()]), pa.float64())
                yield pa.RecordBatch.from_arrays([*piece.columns, made], [*piece.schema.names, "score"])

    small_batches(rows.sparkSession)
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("score", DoubleType())]))


def scores(documents: DataFrame, labels: DataFrame, most: int = MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score`` (0 to 1) of every whole text.

    NULL text counts as empty; empty texts get the score of texts without hits.  No shuffle of the documents.
    """
    rows = texts(documents, held_out(F.col("doc_id").cast("long")).alias("held_out"))
    return _scored(rows, fit(documents, labels, most), lambda batch: batch.column("text")).drop("text")


def predictions(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return scores(documents, labels).select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_civil(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below the threshold, with all their columns; each text is sent once."""
    rows = documents.select(F.struct(*[F.col(f"`{n}`") for n in documents.columns]).alias("row"))
    place = documents.columns.index("text")
    found = _scored(rows, fit(documents, labels), lambda batch: batch.column("row").flatten()[place].cast(pa.string()))
    return found.where(F.col("score") < threshold).select("row.*")
