"""What a worker keeps of byte-pair encoding, and the short way of the decoder."""

import random

from trainlake.llm import bpe


def test_common_words_stay_while_rare_ones_keep_coming():
    encoder = bpe.Encoder()
    encoder.encode("often")
    encoder.kept.update((f" rare{i}", b"") for i in range(600_000))
    encoder.encode("a word never met before")
    assert "often" in encoder.kept


def test_whole_tokens_are_decoded_without_the_steps_between_them():
    encoder, decoder = bpe.Encoder(), bpe.Decoder({i: t for t, i in bpe.load_ranks(bpe.RANKS).items()})
    text = "Plain words, café 12 and\nmore"
    ids = [encoder.transducer.ranks[bytes([b])] for b in b"plain"]
    assert decoder.decode(ids) == "plain" and not decoder._steps
    ids = memoryview(encoder.encode(text)).cast("I").tolist()
    assert decoder.decode(ids) == text


def test_both_ways_of_the_decoder_agree():
    r = random.Random(8)
    tokens = {i: bytes([i]) for i in range(256)} | {256: "é".encode(), 257: b"a\xc3", 258: b"\xa9b", 259: b"\x80", 260: b"\xf0\x9f\x98"}
    decoder = bpe.Decoder(tokens)
    for _ in range(400):
        ids = [r.choice([*range(97, 100), *range(256, 261), r.randrange(256)]) for _ in range(r.randrange(12))]
        held, text = decoder.feed(b"", ids)
        assert decoder.decode(ids) == text + "�" * bool(held)
    assert decoder.decode([256, 97, 259, 256]) == "éa�é"
