"""SentencePiece encoding and decoding on the tokenizers backend.

The model protobuf is parsed here; normaliser, metaspace marker, vocabulary (unigram scores or
BPE ranks) and byte fallback are rebuilt for the tokenizers library, which encodes Arrow batches on
several threads. Every text is decoded again, and its ids are compared with the sentencepiece
library's own.

Defined results: a null or empty text has no ids and decodes to the empty string; rows are encoded
one by one, so ties, repeated rows and null ids do not matter; an empty table gives no row; a kept column
named like one of encode()'s own takes its place.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: integers, or bytes for the length-delimited and fixed kinds."""
    at = 0

    def varint() -> int:
        nonlocal at
        shift = value = 0
        while True:
            b = buf[at]
            at += 1
            value |= (b & 0x7F) << shift
            if b < 0x80:
                return value
            shift += 7

    while at < len(buf):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, buf[at:at + n]
        at += n


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True


def parse_model(blob: bytes) -> Model:
    m = Model()
    for number, value in _fields(blob):
        if number == 1:
            got = dict(_fields(value))
            m.pieces.append((got[1].decode(), struct.unpack("<f", got[2])[0] if 2 in got else 0.0, got.get(3, NORMAL)))
        elif number == 2:
            got = dict(_fields(value))
            m.model_type, m.byte_fallback = got.get(3, UNIGRAM), bool(got.get(35, 0))
        elif number == 3:
            got = dict(_fields(value))
            m.charsmap = got.get(2, b"")
            m.add_dummy_prefix, m.remove_extra_whitespaces, m.escape_whitespaces = (bool(got.get(k, 1)) for k in (3, 4, 5))
    return m


def merges_of(m: Model) -> list[tuple[str, str]]:
    """BPE merges implied by the pieces: every split of a piece into two pieces, best piece first."""
    score = {p: (s, i) for i, (p, s, kind) in enumerate(m.pieces) if kind in (NORMAL, USER)}
    out = []
    for p, (s, i) in score.items():
        for cut in range(1, len(p)):
            left, right = p[:cut], p[cut:]
            if left in score and right in score:
                out.append((-s, i, score[left][1], score[right][1], left, right))
    out.sort()
    return [(a, b) for *_, a, b in out]


def build(m: Model):
    """A tokenizers.Tokenizer for the model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    unk = next(i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN)
    if m.model_type == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(m.pieces)}
        core = models.BPE(vocab, merges_of(m), unk_token=m.pieces[unk][0], fuse_unk=True, byte_fallback=m.byte_fallback)
    else:
        core = models.Unigram([(p, s) for p, s, _ in m.pieces], unk_id=unk, byte_fallback=m.byte_fallback)
    t = Tokenizer(core)
    steps = []
    if m.charsmap:
        steps.append(normalizers.Precompiled(m.charsmap))
    if m.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    mark = MARK if m.escape_whitespaces else " "
    if m.add_dummy_prefix:
        steps.append(normalizers.Prepend(mark))
    if m.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    t.normalizer = normalizers.Sequence(steps)
    t.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if m.add_dummy_prefix else [])])
    return t


class Encoder:
    """Texts to ids (little-endian 32-bit) and whether the ids decode to the text; each unit is encoded and decoded once.

    If no piece holds a marker after another character and the marker is a piece, no merge, no path and
    no run of unknowns crosses the start of a marked word, so words are units and encoding or decoding
    them on their own is exact. Where the normaliser does more than mark spaces, units are those of the
    normalised text and whole texts are decoded; where words are no units, the text is its only one.
    New units go to the library many at a time, as one text of words; its ids are cut where a piece begins
    with the marker. ``max_units`` bounds the memory of units: those not met since it was last reached are
    forgotten, which changes no result.
    """

    def __init__(self, m: Model, max_units: int = 1 << 19):
        self.tok = build(m)
        self.normalizer, self.tok.normalizer = self.tok.normalizer, None
        plain = {p for p, _, kind in m.pieces if kind in (NORMAL, USER)}
        self.whole = MARK not in plain or any(MARK in p.lstrip(MARK) for p in plain)
        self.local = not self.whole and m.escape_whitespaces and m.add_dummy_prefix and not m.charsmap and not m.remove_extra_whitespaces
        self.words = {mark: re.compile(f"{mark}*[^{mark}]+|{mark}+").findall for mark in (" ", MARK)}
        self.starts = np.array([p.startswith(MARK) for p, _, _ in m.pieces])
        self.max_units, self.ids, self.old, self.bad = max_units, {}, {}, set()

    def units(self, text: str) -> list[str]:
        """Normalised units; where the normaliser is local, each without its first marker and with spaces for others."""
        if not text:
            return []
        if self.local:
            if MARK in text:
                text = text.replace(MARK, " ")
            if "  " in text or text[0] == " " or text[-1] == " ":
                return [u[1:] for u in self.words[" "](" " + text)]
            return text.split(" ")
        x = self.normalizer.normalize_str(text)
        return self.words[MARK](x) if not self.whole else [x] if x else []

    def _single(self, units: list[str]) -> None:
        """Encode units one by one."""
        marked = [MARK + u.replace(" ", MARK) for u in units] if self.local else units
        got = [e.ids for e in self.tok.encode_batch_fast(marked, add_special_tokens=False)]
        self.ids.update((u, struct.pack(f"<{len(ids)}i", *ids)) for u, ids in zip(units, got))
        if self.local:
            self.bad.update(u for u, back in zip(units, self.tok.decode_batch(got, skip_special_tokens=False)) if back != u)

    def _learn(self, texts: list[list[str]]) -> None:
        new = set().union(*texts).difference(self.ids)
        if self.old:
            known = {u: self.old[u] for u in new if u in self.old}
            self.ids |= known
            new.difference_update(known)
        alone = [u for u in new if " " in u or not u] if self.local else list(new)
        words = list(new.difference(alone))
        parts = [words[i:i + 1000] for i in range(0, len(words), 1000)]
        for part, e in zip(parts, self.tok.encode_batch_fast([MARK + MARK.join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(e.ids, "<i4")
            cut = np.flatnonzero(self.starts[ids])
            if len(cut) != len(part) or self.tok.decode(e.ids, skip_special_tokens=False) != " ".join(part):
                alone += part
                continue
            raw, ends = ids.tobytes(), [*(4 * cut[1:]).tolist(), 4 * len(ids)]
            self.ids.update((u, raw[a:z]) for u, a, z in zip(part, (4 * cut).tolist(), ends))
        if alone:
            self._single(alone)

    def encode_batch(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        if len(self.ids) > self.max_units:
            self.ids, self.old = {}, self.ids
            self.bad.intersection_update(self.old)
        units, out, later = [self.units(x) for x in texts], [], []
        for i, u in enumerate(units):
            try:
                out.append(b"".join(map(self.ids.__getitem__, u)))
            except KeyError:  # units not met before
                out.append(b"")
                later.append(i)
        if later:
            self._learn([units[i] for i in later])
            for i in later:
                out[i] = b"".join(map(self.ids.__getitem__, units[i]))
        if self.local:
            return out, [MARK not in x and self.bad.isdisjoint(u) for x, u in zip(texts, units)] if self.bad else [MARK not in x for x in texts]
        back = self.tok.decode_batch([list(struct.unpack(f"<{len(x) // 4}i", x)) for x in out], skip_special_tokens=False)
        return out, [x == y for x, y in zip(back, texts)]


@lru_cache(1)
def loaded(blob: bytes):
    """The encoder and the sentencepiece processor of a model, kept by a worker from task to task."""
    import sentencepiece

    return Encoder(parse_model(blob)), sentencepiece.SentencePieceProcessor(model_proto=blob)


def encode(docs: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and n_tokens, ids, ids_sha256 (little-endian 32-bit ids), decoded_ok, parity.

    ``model_path`` is read on the driver and shipped with the job. ``decoded_ok`` tells whether the ids
    decode to the text itself, which a normaliser that rewrites texts may prevent. ``parity`` tells
    whether the ids equal those the sentencepiece library gives the whole text.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        blob = f.read()  # bounded by the model: a fraction of a MB
    shipped = spark.sparkContext.broadcast(blob)
    own = ["n_tokens", "ids", "ids_sha256", "decoded_ok", "parity"]
    packed = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"), *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)])
    fields = [f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(packed.schema.fields[1:])]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", "2")
        coder, ref = loaded(shipped.value)
        for batch in it:
            for rows in slices(batch, 0):
                texts = rows.column(0).to_pylist()
                ids, back = coder.encode_batch(texts)
                same = [struct.pack(f"<{len(want)}i", *want) == got for want, got in zip(ref.encode(texts, num_threads=1), ids)]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], sizes.cumsum())), pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32()))
                digest = [hashlib.sha256(x).hexdigest() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[1:], pa.array(sizes), lists, pa.array(digest, pa.string()), pa.array(back, pa.bool_()), pa.array(same, pa.bool_())],
                    [*rows.schema.names[1:], *own])

    out = packed.mapInArrow(batches, ", ".join([*fields, "n_tokens long, ids array<int>, ids_sha256 string, decoded_ok boolean, parity boolean"]))
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], *[c for c in own if c not in keep])


def decode(rows: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and text of rows with ids; null ids decode to the empty string."""
    with open(model_path, "rb") as f:
        shipped = rows.sparkSession.sparkContext.broadcast(f.read())
    plain = rows.select(*[F.col(c) for c in keep], "ids")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[:-1]]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = build(parse_model(shipped.value))
        for b in it:
            texts = tok.decode_batch([x or [] for x in b.column(b.num_columns - 1).to_pylist()], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts)], [*keep, "text"])

    return plain.mapInArrow(batches, ", ".join([*fields, "text string"]))
