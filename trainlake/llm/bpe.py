"""Byte-level BPE as a lazily determinised transducer, and its streaming decoder.

Encoding reads bytes.  For a prefix ``p`` of a pre-token the merges end in one
segmentation, whose last token alone decides which tokens may follow: two tokens
can stand side by side if no merge across their border happens before both are
complete.  So the automaton only has to know, for every border from which a token
may still start (those inside the longest suffix that begins some vocabulary
token), the path to it.  What all these paths share is settled and emitted; the
lookahead is bounded by the longest token.  States and transitions are made when
first met, and kept up to a stated number.

Decoding keeps the state of a UTF-8 automaton between tokens, so characters split
over tokens, chunks or batches come out whole; transitions on whole tokens are
made when first met.
"""

import base64
import bisect
import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from trainlake.llm.common import map_arrow, texts

#: Most states of the transducer and most pre-tokens kept by a worker, before they are made anew: some 400 MB at most.
#: Rare words keep coming (85 MB of the test tables have some 800,000), and to make anew costs more than all else.
MAX_STATES, MAX_KEPT = 400_000, 1_000_000
#: Most pre-tokens kept where there is less room.
MAX_WORDS = 300_000

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(data: bytes, ranks: dict[bytes, int], below: int | None = None) -> list[bytes]:
    """The merges one by one, lowest rank first, leftmost of equals first."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best = min((r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1], 1 << 60)) is not None)
        if best[0] >= (1 << 60 if below is None else below):
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class _State:
    __slots__ = ("final", "next", "paths", "window")

    def __init__(self, window: bytes, paths: tuple):
        self.window, self.paths = window, paths
        self.final = paths[-1][1:]
        self.next: dict[int, tuple] = {}


class Transducer:
    """Bytes of one pre-token in, token ids out."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.tokens = {i: t for t, i in ranks.items()}
        self.heads = {t[:n] for t in ranks for n in range(1, len(t))}
        self.sorted = sorted(ranks)
        self._spines: dict[int, tuple[tuple, tuple]] = {}
        self._joins: dict[tuple[int, int], list[int]] = {}
        self._like: dict[tuple, int] = {}
        self._alike: dict[tuple[int, int], int] = {}
        self._fit: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.start = _State(b"", ((-1,),))
        self._states = {(b"", self.start.paths): self.start}

    def _spine(self, token: int) -> tuple[tuple, tuple]:
        """The tokens that end, and those that begin, ``token`` while it is merged, in order."""
        if (known := self._spines.get(token)) is None:
            data = self.tokens[token]
            if len(data) == 1:
                known = ((token,), (token,))
            else:
                left, *_, right = (self.ranks[p] for p in merged(data, self.ranks, token))
                known = (self._spine(right)[0] + (token,), self._spine(left)[1] + (token,))
            self._spines[token] = known
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges of both texts together leave the two tokens side by side."""
        if (known := self._fit.get((left, right))) is None:
            if len(self._fit) > 500_000:
                self._fit.clear()
            known = self._fit[left, right] = self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        ends, heads, ranks, tokens = self._spine(left)[0], self._spine(right)[1], self.ranks, self.tokens
        for x, until_x in zip(ends, (*ends[1:], 1 << 60), strict=True):
            for y, until_y in zip(heads, (*heads[1:], 1 << 60), strict=True):
                r = ranks.get(tokens[x] + tokens[y])
                if r is not None and r < until_x and r <= until_y:
                    return False
        return True

    def _joined(self, token: int, byte: int) -> list[int]:
        """The sorted ranks of all tokens that begin with ``token`` and ``byte``."""
        if (known := self._joins.get((token, byte))) is None:
            head = self.tokens[token] + bytes((byte,))
            i, known = bisect.bisect_left(self.sorted, head), []
            while i < len(self.sorted) and self.sorted[i].startswith(head):
                known.append(self.ranks[self.sorted[i]])
                i += 1
            known.sort()
            self._joins[token, byte] = known
        return known

    def _stand_in(self, token: int, byte: int) -> int:
        """One token for all that allow the same tokens after them, if these begin with ``byte``.

        What is allowed depends on the merges across the border that come before the token's own
        merges: for each token at its end on the way, how many of them are early enough.
        """
        if token < 0:
            return token
        if (known := self._alike.get((token, byte))) is None:
            ends = self._spine(token)[0]
            early = ((x, bisect.bisect_left(self._joined(x, byte), until)) for x, until in zip(ends, (*ends[1:], 1 << 60), strict=True))
            key = (byte, *(e for e in early if e[1]))
            known = self._alike[token, byte] = self._like.setdefault(key, token)
        return known

    def _make(self, state: _State, byte: int) -> tuple:
        window, paths, ranks, heads = state.window + bytes((byte,)), state.paths, self.ranks, self.heads
        for j, path in enumerate(paths):
            if path is not None and (token := ranks.get(window[j:])) is not None and (path[-1] < 0 or self.fits(path[-1], token)):
                paths = (*paths, (*path, token))
                break
        else:
            raise ValueError("ranks lack a single byte")
        alive = [window[k:] in heads for k in range(len(window))]
        drop = alive.index(True) if True in alive else len(window)
        window = window[drop:]
        open_ = [p for p, a in zip(paths[drop:], alive[drop:], strict=False) if a and p is not None] + [paths[-1]]
        shared = 1  # what all paths begin with is settled; its last token stays, as it decides what may follow
        shortest = min(map(len, open_))
        while shared < shortest and all(p[shared] == open_[0][shared] for p in open_):
            shared += 1
        emitted = open_[0][1:shared]
        paths = tuple(p[shared - 1 :] if p is not None and a else None for p, a in zip(paths[drop:-1], alive[drop:], strict=True)) + (paths[-1][shared - 1 :],)
        at = next((k for k, p in enumerate(paths) if p is not None and len(p) == 1 and k < len(window)), None)
        anchor = paths[-1][0] if len(paths[-1]) == 1 else self._stand_in(paths[at][0], window[at]) if at is not None else 0
        paths = tuple(p and (anchor, *p[1:]) for p in paths)
        key = (window, paths)
        if (after := self._states.get(key)) is None:
            after = self._states[key] = _State(window, paths)
        made = state.next[byte] = (after, emitted)
        return made

    def encode(self, data: bytes) -> list[int]:
        if len(self._states) > self.max_states:
            self._reset()
        state, out = self.start, []
        for byte in data:
            step = state.next.get(byte)
            if step is None:
                step = self._make(state, byte)
            state, emitted = step
            if emitted:
                out += emitted
        out += state.final
        return out


class _Kept(dict):
    """Pre-token → its ids, made by the transducer when first met."""

    def __init__(self, transducer: Transducer, form, most: int):
        super().__init__()
        self.transducer, self.form, self.most = transducer, form, most

    def __missing__(self, word: str):
        if len(self) >= self.most:
            self.clear()
        if len(word) > 256:  # long junk runs aren't met twice
            return self.form(self.transducer.encode(word.encode()))
        made = self[word] = self.form(self.transducer.encode(word.encode()))
        return made


#: Letters first, which changes nothing, as no other branch starts with them.  Only used on texts without
#: the characters in ``_UNSAFE``, for which the two libraries' classes differ.
_FAST = re.compile(r" ?[^\W\d_]+| ?\d+|'s|'t|'re|'ve|'m|'ll|'d| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_UNSAFE = re.compile("[\x1c-\x1f\x85\xa0\xb2\xb3\xb9\xbc-\xbeƀ-\U0010ffff]")


@functools.lru_cache(maxsize=4)
def _compiled(pattern: str):
    return regex.compile(pattern)


def pre_tokens(text: str, pattern: str = public_tokenizers.PATTERN) -> list[str]:
    if pattern == public_tokenizers.PATTERN and not _UNSAFE.search(text):
        return _FAST.findall(text)
    return _compiled(pattern).findall(text)


class Encoder:
    """Whole texts in; ids as little-endian unsigned 32-bit numbers out."""

    def __init__(self, path: str = RANKS, pattern: str = public_tokenizers.PATTERN):
        self.transducer = Transducer(load_ranks(path))
        self.pattern = pattern
        self.kept = _Kept(self.transducer, lambda ids: np.array(ids, "<u4").tobytes(), MAX_KEPT)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.kept.__getitem__, pre_tokens(text, self.pattern)))


# --- decoding ---------------------------------------------------------------------------------


def _utf8_step(state: int, byte: int) -> int:
    """State: bytes still missing, with the bounds of the next one: ``missing << 16 | low << 8 | high``; -1: broken."""
    if state == 0:
        if byte < 0x80:
            return 0
        if 0xC2 <= byte <= 0xDF:
            return 1 << 16 | 0x80BF
        if 0xE0 <= byte <= 0xEF:
            low, high = (0xA0 if byte == 0xE0 else 0x80), (0x9F if byte == 0xED else 0xBF)
            return 2 << 16 | low << 8 | high
        if 0xF0 <= byte <= 0xF4:
            low, high = (0x90 if byte == 0xF0 else 0x80), (0x8F if byte == 0xF4 else 0xBF)
            return 3 << 16 | low << 8 | high
        return -1
    if not (state >> 8 & 0xFF) <= byte <= (state & 0xFF):
        return -1
    return (state >> 16) - 1 << 16 | 0x80BF if state >> 16 > 1 else 0


class _Whole(dict):
    """Token → its text, if it leaves no character unfinished; made by the automaton when first met."""

    def __init__(self, decoder: "Decoder"):
        super().__init__()
        self.decoder = decoder

    def __missing__(self, token: int) -> str:
        held, text = self.decoder._advance(b"", self.decoder.tokens[token])
        if held:
            raise _Unfinished
        self[token] = text
        return text


class _Unfinished(Exception):
    """A token ends within a character."""


class Decoder:
    """Token ids in, text out, as soon as a character is complete.  Broken sequences give U+FFFD."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self._steps: dict[tuple[bytes, int], tuple[bytes, str]] = {}
        self._whole = _Whole(self)

    def _advance(self, held: bytes, data: bytes) -> tuple[bytes, str]:
        state, run, out = 0, bytearray(), []
        for byte in held + data:
            after = _utf8_step(state, byte)
            if after < 0:
                out.append("�" if run else "")
                run.clear()
                after = _utf8_step(0, byte)
                if after < 0:
                    out.append("�")
                    state = 0
                    continue
            run.append(byte)
            state = after
            if state == 0:
                out.append(run.decode())
                run.clear()
        return bytes(run), "".join(out)

    def feed(self, held: bytes, ids) -> tuple[bytes, str]:
        """``held``: the unfinished bytes left by the call before; gives those left now, and the text."""
        steps, out = self._steps, []
        for i in ids:
            known = steps.get((held, i))
            if known is None:
                if len(steps) > 400_000:
                    steps.clear()
                known = steps[held, i] = self._advance(held, self.tokens[i])
            held, text = known
            out.append(text)
        return held, "".join(out)

    def decode(self, ids) -> str:
        """A whole sequence; bytes left over at its end give one U+FFFD."""
        try:  # between tokens that end with a character the automaton is in its first state
            return "".join(map(self._whole.__getitem__, ids))
        except _Unfinished:
            pass
        held, text = self.feed(b"", ids)
        return text + "�" * bool(held)


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str = public_tokenizers.PATTERN) -> Encoder:
    """One a worker."""
    return Encoder(path, pattern)


@functools.lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder({i: t for t, i in load_ranks(path).items()})


@functools.lru_cache(maxsize=2)
def numerals(path: str) -> dict[int, str]:
    return {i: str(i) for i in load_ranks(path).values()}


def encode_texts(documents: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id, n_tokens, token_ids``: ids of every whole text, packed as little-endian unsigned 32-bit numbers.

    NULL and empty text give no tokens; repeated rows give repeated rows.  No shuffle; memory is
    bounded by the largest text of a slice.
    """

    def step(batch: pa.RecordBatch):
        encode = encoder(path, pattern).encode
        ids = [encode(text) for text in batch.column("text").to_pylist()]
        counts = pa.array([len(x) // 4 for x in ids], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "token_ids"])

    return map_arrow(texts(documents), step, "doc_id LONG, n_tokens LONG, token_ids BINARY")


def decode_tokens(tokens: DataFrame, path: str = RANKS) -> DataFrame:
    """``doc_id, text`` from ``doc_id, token_ids``; NULL ids give the empty text."""

    def step(batch: pa.RecordBatch):
        decode = decoder(path).decode
        out = [decode(np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column("token_ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return map_arrow(tokens.select("doc_id", "token_ids"), step, "doc_id LONG, text STRING")


def round_trip_digests(documents: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Digests of the ids of every whole text, and of what they decode to, in one pass without a shuffle.

    Ids are digested as decimal numbers joined by one space.  NULL text counts as empty.
    """

    def step(batch: pa.RecordBatch):
        encode, decode, numeral = encoder(path, pattern).encode, decoder(path).decode, numerals(path).__getitem__
        counts, of_ids, of_text = [], [], []
        for text in batch.column("text").to_pylist():
            ids = np.frombuffer(encode(text), "<u4").tolist()
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(" ".join(map(numeral, ids)).encode()).hexdigest())
            of_text.append(hashlib.sha256(decode(ids).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_arrow(texts(documents), step, "doc_id LONG, n_tokens LONG, ids_sha256 STRING, decoded_sha256 STRING")
