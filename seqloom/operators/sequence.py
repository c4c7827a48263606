"""Sequence operators with the contracts of the tools they stand in for; not replicas of those tools."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions.text import chars

from .components import components
from .shuffle import cut

#: The standard genetic code in TCAG order, and what other codes read otherwise (fixed values).
BASES, AMINO = "TCAG", "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
GENETIC_CODES: dict[str, dict[str, str]] = {
    "Universal": {},
    "Acetabularia": {"TAA": "Q", "TAG": "Q"},
    "Candida": {"CTG": "S"},
    "Ciliate": {"TAA": "Q", "TAG": "Q"},
    "Dasycladacean": {"TAA": "Q", "TAG": "Q"},
    "Euplotid": {"TGA": "C"},
    "Hexamita": {"TAA": "Q", "TAG": "Q"},
    "Mesodinium": {"TAA": "Y", "TAG": "Y"},
    "Mitochondrial-Ascidian": {"AGA": "G", "AGG": "G", "ATA": "M", "TGA": "W"},
    "Mitochondrial-Chlorophycean": {"TAG": "L"},
    "Mitochondrial-Echinoderm": {"AAA": "N", "AGA": "S", "AGG": "S", "TGA": "W"},
    "Mitochondrial-Flatworm": {"AAA": "N", "AGA": "S", "AGG": "S", "TAA": "Y", "TGA": "W"},
    "Mitochondrial-Invertebrates": {"AGA": "S", "AGG": "S", "ATA": "M", "TGA": "W"},
    "Mitochondrial-Protozoan": {"TGA": "W"},
    "Mitochondrial-Pterobranchia": {"AGA": "S", "AGG": "K", "TGA": "W"},
    "Mitochondrial-Scenedesmus_obliquus": {"TCA": "*", "TAG": "L"},
    "Mitochondrial-Thraustochytrium": {"TTA": "*"},
    "Mitochondrial-Trematode": {"AAA": "N", "AGA": "S", "AGG": "S", "ATA": "M", "TGA": "W"},
    "Mitochondrial-Vertebrates": {"AGA": "*", "AGG": "*", "ATA": "M", "TGA": "W"},
    "Mitochondrial-Yeast": {"ATA": "M", "CTA": "T", "CTC": "T", "CTG": "T", "CTT": "T", "TGA": "W"},
    "Pachysolen_tannophilus": {"CTG": "A"},
    "Peritrich": {"TAA": "E", "TAG": "E"},
    "SR1_Gracilibacteria": {"TGA": "G"},
    "Tetrahymena": {"TAA": "Q", "TAG": "Q"},
}


def codon_table(code: str = "Universal") -> dict[str, str]:
    if code not in GENETIC_CODES:
        raise ValueError(f"unknown genetic code {code!r}; one of {', '.join(GENETIC_CODES)}")
    return {a + b + c: AMINO[16 * i + 4 * j + k] for i, a in enumerate(BASES) for j, b in enumerate(BASES) for k, c in enumerate(BASES)} | GENETIC_CODES[code]


class Translator:
    """Six-frame translation of whole sequences by table lookup; codons with other letters than ACGT read X."""

    def __init__(self, code: str = "Universal"):
        table = codon_table(code)
        self.digit = np.full(256, 64, np.uint8)
        for i, b in enumerate(BASES):
            self.digit[ord(b)] = i
        self.amino = np.full(64 * 21 + 65, ord("X"), np.uint8)
        for codon, a in table.items():
            x, y, z = (BASES.index(c) for c in codon)
            self.amino[16 * x + 4 * y + z] = ord(a)

    def frames(self, seq: bytes) -> Iterator[tuple[int, bytes]]:
        """(frame, peptide): 1 to 3 forward, -1 to -3 of the reverse complement."""
        d = self.digit[np.frombuffer(seq, np.uint8)]
        back = np.where(d == 64, 64, d ^ 2)[::-1]  # in TCAG order the complement turns the second bit
        for strand, x in ((1, d), (-1, back)):
            for f in range(3):
                n = max(0, (len(x) - f) // 3)
                c = x[f:f + 3 * n].reshape(-1, 3).astype(np.int64)
                yield strand * (f + 1), self.amino[c @ np.array([16, 4, 1])].tobytes()


def translate(seq: str, code: str = "Universal") -> str:
    return next(Translator(code).frames(seq.encode()))[1].decode()


def orfs_of(seq: bytes, min_aa: int, coder: Translator) -> list[tuple[int, str, str]]:
    """(frame, type, peptide) of all stretches between stops on both strands, from the first M where the start is inside."""
    out = []
    for frame, pep in coder.frames(seq):
        parts = pep.split(b"*")
        for n, p in enumerate(parts):
            if len(p) < min_aa:
                continue
            open_start, open_end = n == 0, n == len(parts) - 1
            m = p.find(b"M")
            orf = p if open_start and m != 0 else p[m:] if m >= 0 else b""
            if len(orf) >= min_aa:
                kind = ("complete" if not open_end else "3prime_partial") if orf[:1] == b"M" else ("5prime_partial" if not open_end else "internal")
                out.append((frame, kind, orf.decode()))
    return out


def find_orfs(df: DataFrame, min_aa: int = 100, code: str = "Universal") -> DataFrame:
    """id, frame, orf_type, pep of every open reading frame of (id, seq), upper case; a null sequence has none."""
    codon_table(code)  # an unknown code raises here

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Translator(code)
        for b in it:
            rows = []
            for i, s in zip(b.column(0), b.column(1)):
                rows += [(i.as_py(), *o) for o in orfs_of((s.as_py() or "").encode("ascii", "replace"), min_aa, coder)]
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.string()))], ["id", "frame", "orf_type", "pep"])

    return df.select(F.col("id").cast("string"), F.upper("seq").alias("seq")).mapInArrow(run, "id string, frame int, orf_type string, pep string")


def best_orfs(orfs: DataFrame) -> DataFrame:
    """The longest reading frame of every id; ties by frame, then peptide."""
    best = F.max(F.struct(F.length("pep").alias("n"), (-F.abs("frame")).alias("f"), F.col("frame"), F.col("orf_type"), F.col("pep"))).alias("b")
    return orfs.groupBy("id").agg(best).select("id", "b.frame", "b.orf_type", "b.pep")


def profile_scan(df: DataFrame, consensus: str, match: float = 1.0, mismatch: float = -0.5) -> DataFrame:
    """id, pos, score of the best place of a consensus profile in (id, seq), by built-in expressions."""
    n = len(consensus)
    rows = df.select("id", chars(F.col("seq")).alias("c")).where(F.size("c") >= n)
    score = lambda i: sum((F.when(F.get("c", i + j) == x, match).otherwise(mismatch) for j, x in enumerate(consensus)), F.lit(0.0))
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.size("c") - n), lambda i: F.struct(score(i).alias("score"), (-i - 1).alias("back"))))
    return rows.select("id", best.alias("b")).select("id", (-F.col("b.back")).alias("pos"), F.col("b.score").alias("score"))


#: Cells of a profile table that are shipped to every task: 8 bytes each.
MOST_PROFILE_CELLS = 20_000_000


def profile_hits(df: DataFrame, profiles: DataFrame, other: float = -4.0, max_evalue: float = 1e-3) -> DataFrame:
    """query, domain, accession, evalue, score, ali_from, ali_to: the best place of every profile in every sequence.

    ``profiles(domain, accession, pos, letter, score, mu, lambda)`` holds a position weight matrix a domain,
    positions from 1, and the location and slope of its score distribution, from which the expectation over
    all sequences follows: N * (1 - exp(-exp(-lambda * (score - mu)))). Letters a position lacks score
    ``other``. The table goes to every task, so its size is checked; a larger one is to be scanned in parts.
    """
    cells = profiles.limit(MOST_PROFILE_CELLS + 1).count()
    if cells > MOST_PROFILE_CELLS:
        raise ValueError(f"more than {MOST_PROFILE_CELLS} profile cells; scan the profiles in parts")
    table: dict[tuple, list] = {}
    for r in profiles.collect():  # bounded by MOST_PROFILE_CELLS
        table.setdefault((r["domain"], r["accession"], r["mu"], r["lambda"]), []).append((r["pos"], r["letter"], r["score"]))
    total = df.count()
    built = []
    for (domain, accession, mu, slope), cell in sorted(table.items(), key=str):
        m = np.full((max(p for p, _, _ in cell), 256), other)
        for p, letter, score in cell:
            m[p - 1, ord(letter)] = score
        built.append((domain, accession, mu, slope, m))
    shipped = df.sparkSession.sparkContext.broadcast(built)
    names = ["query", "domain", "accession", "evalue", "score", "ali_from", "ali_to"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.int32()]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = []
            for i, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer((s or "").encode("latin-1", "replace"), np.uint8)
                for domain, accession, mu, slope, m in shipped.value:
                    n = len(x) - len(m) + 1
                    if n < 1:
                        continue
                    score = np.zeros(n)
                    for p, row in enumerate(m):
                        score += row[x[p:p + n]]
                    at = int(score.argmax())
                    evalue = total * -np.expm1(-np.exp(-slope * (score[at] - mu)))
                    if evalue <= max_evalue:
                        rows.append((i, domain, accession, float(evalue), float(score[at]), at + 1, at + len(m)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 7, kinds)], names)

    return df.select(F.col("id").cast("string"), F.upper("seq").alias("seq")).mapInArrow(run, "query string, domain string, accession string, evalue double, score double, ali_from int, ali_to int")


def near_groups(df: DataFrame, shingle: int = 5, rows: int = 4, bands: int = 16, least: float = 0.8) -> DataFrame:
    """(id, group_id, n_in_group, kept) of every row of (id, text): groups of texts linked by a Jaccard
    similarity of ``least`` or more between their word shingle sets; the longest text of a group is kept.

    MinHash bands give candidates; the similarity is that of the sets (of 64-bit hashes of shingles). Equal
    sets collapse first. Within a band key every set is compared with the key's least one, and only sets
    that this leaves in different components are compared with each other, so that a large group of near
    copies costs its size, not the square of it. A text with fewer words than a shingle has one, the whole
    text; texts without words are groups of their own. The group is named by its smallest id; ties in
    length go to the smaller id. Ids are unique.
    """
    words = F.array_remove(F.split(F.lower("text"), r"\s+"), "")
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - shingle + 1, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice("w", i, shingle), " ")))
    plain = df.select("id", F.length("text").alias("n"), F.when(F.size(words) > 0, words).alias("w"))
    sets = cut(plain.select("id", "n", F.when(F.col("w").isNotNull(), F.sort_array(F.array_distinct(grams))).alias("set")).withColumn("name", F.sha2(F.concat_ws(",", "set"), 256)))
    rep = cut(sets.where("set IS NOT NULL").groupBy("name").agg(F.min("id").alias("rep"), F.first("set").alias("set")))
    sig = rep.select("rep", F.explode("set").alias("g")).groupBy("rep").agg(*[F.min(F.xxhash64(F.lit(i), "g")).alias(f"h{i}") for i in range(rows * bands)])
    keyed = cut(sig.select("rep", F.posexplode(F.array(*[F.xxhash64(*[F.col(f"h{b * rows + r}") for r in range(rows)]) for b in range(bands)])).alias("band", "key")))

    def similar(pairs: DataFrame) -> DataFrame:
        side = lambda c: rep.select(F.col("rep").alias(c), F.col("set").alias(f"s{c}"))
        both = F.size(F.array_intersect("sa", "sb"))
        met = pairs.where("a <> b").distinct().join(side("a"), "a").join(side("b"), "b")
        return cut(met.where(both / (F.size("sa") + F.size("sb") - both) >= least).select("a", "b"))

    lead = keyed.groupBy("band", "key").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    links = similar(keyed.join(lead, ["band", "key"]).select("a", F.col("rep").alias("b")))
    label = components(links)
    part = keyed.join(lead.select("band", "key"), ["band", "key"], "left_semi").join(label, F.col("rep") == F.col("node"), "left").select("band", "key", "rep", F.coalesce("component", "rep").alias("comp"))
    mixed = part.groupBy("band", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("band", "key")
    part = cut(part.join(mixed, ["band", "key"], "left_semi"))
    x, y = part.alias("x"), part.alias("y")
    cross = x.join(y, F.expr("x.band = y.band AND x.key = y.key AND x.comp <> y.comp AND x.rep < y.rep")).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
    label = components(links.unionAll(similar(cross)))
    named = rep.select("name", "rep").join(label, F.col("rep") == F.col("node"), "left").select("name", F.coalesce("component", "rep").alias("group_id"))
    all_rows = sets.select("id", "n", "name", F.col("set").isNull().alias("bare")).join(named, "name", "left").select("id", "n", F.when(F.col("bare"), F.col("id")).otherwise(F.col("group_id")).alias("group_id"))
    best = all_rows.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_in_group"), F.min_by("id", F.struct(-F.coalesce("n", F.lit(0)), "id")).alias("_best"))
    return all_rows.join(best, "group_id").select("id", "group_id", "n_in_group", (F.col("id") == F.col("_best")).alias("kept"))


def species_split(df: DataFrame, k: int = 4, features: int = 1024, seed: int = 160) -> DataFrame:
    """doc_id, label, held_out, prediction of a linear SVM on hashed k-mer counts for every row of (doc_id, text, label).

    Four fifths of the labelled rows, drawn by a hash of the id and the seed, fit the model; the others are
    held out, so that accuracy() measures rows the model has not seen. A null label is unknown, a null text
    has no k-mers.
    """
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.feature import HashingTF

    from seqloom.functions.text import kmers

    grams = df.withColumn("grams", kmers(F.lower(F.coalesce("text", F.lit(""))), k))
    grams = grams.withColumn("held_out", F.col("label").isNotNull() & (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(5)) == 0))
    vec = HashingTF(numFeatures=features, inputCol="grams", outputCol="features").transform(grams)
    model = LinearSVC(maxIter=10, regParam=0.1).fit(vec.where("label IS NOT NULL AND NOT held_out").select("features", "label"))
    return model.transform(vec).select("doc_id", "label", "held_out", "prediction")


def accuracy(predicted: DataFrame) -> float:
    """Share of the held-out rows whose prediction is their label; null without any."""
    return predicted.where("held_out").agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


def partition_species(df: DataFrame, predicted: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The rows predicted 1 (host) and the others (symbiont)."""
    host = predicted.where("prediction = 1.0").select(key).distinct()
    return df.join(host, key, "left_semi"), df.join(host, key, "left_anti")
