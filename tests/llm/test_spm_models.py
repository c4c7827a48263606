"""build() and the encoder for models other than the installed one: unigram, byte fallback, white space rules; against the sentencepiece library."""

import random
import struct

import pytest
import sentencepiece

from seqloom.llm import spm

M = spm.MARK


def varint(n):
    out = b""
    while True:
        n, low = n >> 7, n & 0x7F
        out += bytes([low | (0x80 if n else 0)])
        if not n:
            return out


def field(number, value):
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def model(pieces, kind, fallback=False, extra=False, prefix=True):
    blob = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    trainer = field(3, kind) + field(35, int(fallback))
    normal = field(1, b"identity") + field(3, int(prefix)) + field(4, int(extra)) + field(5, 1)
    return blob + field(2, trainer) + field(3, normal)


BASE = [("<unk>", 0.0, spm.UNKNOWN), ("<s>", 0.0, spm.CONTROL), ("</s>", 0.0, spm.CONTROL)]
BYTES = [(f"<0x{i:02X}>", 0.0, spm.BYTE) for i in range(256)]
UNI = [(M, -3.0, 1), *[(c, -6.0 - i / 10, 1) for i, c in enumerate("abcdeé.\n")], (M + "ab", -4.1, 1), ("abc", -4.7, 1), ("cd", -5.2, 1), (M + "a", -5.03, 1), ("bcde", -6.31, 1), ("de", -5.9, 1), (M + M, -5.5, 1)]
#: The same with a piece that holds a marker inside: words are no units.
INSIDE = [*UNI, ("d" + M + "a", -4.4, 1)]
TEXTS = ["", " ", "abcde", "  ab  cd ", "abc abcde de", "x", "xx ab", "ab x y cd", "é.é", "a\nb \n", "日本 ab", " a", "a ", "d a d a", "ab" * 40]


@pytest.mark.parametrize("pieces", [UNI, INSIDE, UNI[1:-1]])
@pytest.mark.parametrize("fallback", [False, True])
@pytest.mark.parametrize("extra", [False, True])
@pytest.mark.parametrize("prefix", [True, False])
def test_unigram(pieces, fallback, extra, prefix):
    blob = model([*BASE, *(BYTES if fallback else []), *pieces], spm.UNIGRAM, fallback, extra, prefix)
    ref, coder = sentencepiece.SentencePieceProcessor(model_proto=blob), spm.Encoder(spm.parse_model(blob))
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("abcdeé.  x") for _ in range(rng.randrange(30))) for _ in range(150)]
    ids, back = coder.encode_batch(texts)
    for t, i, ok in zip(texts, ids, back):
        got = list(struct.unpack(f"<{len(i) // 4}i", i))
        assert got == ref.encode(t), t
        if fallback:
            assert ok == (ref.decode(got) == t), t
            assert ok or extra or pieces[0][0] != M  # where the marker is no piece, its bytes decode to itself
