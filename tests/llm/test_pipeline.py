"""The pipeline against plain versions of its stages, on the smallest table with planted rows, and on an empty one."""

import hashlib
import re
import sys
from collections import Counter
from pathlib import Path

import pytest
import sentencepiece
import xxhash

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline as P  # noqa: E402
from seqloom.llm import neardup  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def kept(text):
    w = brute.WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if brute.WORD.search(x)]
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    repeated = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    symbols, chars = len(re.findall(r"[#*$%&|<>]", text or "")), sum(map(len, w))
    return not (len(w) < 10 or 100 * len(repeated) > 20 * len(w) or symbols > len(w) or 100 * (len(lines) - len(set(lines))) > 50 * len(lines) or chars < 2 * len(w) or chars > 15 * len(w))


def fingerprint(text):
    w = text.encode().lower().split()
    g = [b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))]
    out = 0
    for k, seed in enumerate((42, 43)):
        h = [xxhash.xxh64_intdigest(x, seed) for x in g]
        out |= sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) << 64 * k
    return out


def near_first(rows):
    fps = [fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    # Pairs within the radius that agree on one of the fixed keys: what the README gives the recall of.
    keys = [sum(1 << b for b in bits) for bits in neardup.wide_plan(128)]
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 24 and any((fps[a] ^ fps[b]) & k == 0 for k in keys):
                group[max(root(a), root(b))] = min(root(a), root(b))
    best = {}
    for i, r in enumerate(rows):
        key = (r[0] is None, r[0] or 0)
        best[root(i)] = min(best.get(root(i), (key, r)), (key, r), key=lambda x: x[0])
    return [r for _, r in best.values()]


def mixed(rows):
    size = lambda r: len(brute.WORD.findall(r[1]))
    total = Counter()
    for r in rows:
        total[r[3]] += size(r)
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    full = set()
    while True:
        rest, w = sum(total.values()) - sum(3 * total[s] for s in full), sum(weight[s] for s in order if s not in full)
        target = {s: 3.0 * total[s] if s in full else rest * weight[s] / w for s in order}
        over = {s for s in order if target[s] > 3 * total[s]}
        if not over:
            break
        full |= over
    out = []
    for r in rows:
        rate = min(target[r[3]] / total[r[3]], 3.0)
        draw = int(hashlib.md5(f"{'' if r[0] is None else r[0]}:17".encode()).hexdigest()[:13], 16) / 2.0**52
        out += [r] * (int(rate) + (draw < rate - int(rate)))
    return out


def test_brute_force(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    base = next(r for r in rows if kept(r[1]) and 60 < len(brute.WORD.findall(r[1])) < 400)
    words = base[1].split(" ")
    near = " ".join(["changed", *words[1:]]).replace("\n", " ")
    rows += [(9001, near, "en", "planted", 0), (9002, near + " end", "en", "planted", 0), (9003, None, "en", None, 0), (9004, "", None, None, 0), (None, near + " more words", "en", None, 0), (9001, near, "en", "planted", 0)]
    rows += [(9100 + i, f"{base[1]}\nLog entry {i} of user u{i} on this very long evening", "en", "planted", 0) for i in range(5)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    rows = [r for r in rows if kept(r[1])]
    rows = [(r[0], t, *r[2:]) for r, t in zip(rows, brute.dedup_lines(rows)) if brute.WORD.search(t)]
    lines = len(rows)
    rows = near_first(rows)
    assert len(rows) < lines
    model = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    want = Counter((r[0], r[2], r[3], tuple(model.encode(r[1]))) for r in mixed(rows))
    got = P.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.lang, r.source, tuple(r.ids)) for r in got) == want
    assert all(r.parity and r.decoded_ok and r.n_tokens == len(r.ids) for r in got)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words that are long enough to stay in here for good", "en", "s", 5, "x")], SCHEMA + ", fp string")
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns, name


@pytest.mark.parametrize("stage", [f for _, f in P.STAGES])
def test_nulls_in_every_column(spark, stage):
    rows = [(None, None, None, None, None), (1, "a few words that pass all rules of this stage quite well today", None, None, None), (None, "a few words that pass all rules of this stage quite well too", "en", "s", 3)]
    out = stage(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert out.count() <= 3 * len(rows)
