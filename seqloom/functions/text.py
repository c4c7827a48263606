"""Column functions for multi-valued cells and scraped text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Cell format: entries, fields and the null mark of the annotation report (fixed values).
ENTRY, FIELD, MISSING = "`", "^", "."


def split_levels(cell: Column, keep: str | None = None, glue: str = ";") -> Column:
    """First field of every entry (of those that contain ``keep``), joined again."""
    entries = F.split(cell, ENTRY)
    if keep:
        entries = F.filter(entries, lambda e: e.contains(keep))
    return F.array_join(F.transform(entries, lambda e: F.substring_index(e, FIELD, 1)), glue)


def go_terms(cells: list[Column], legacy_comma_split: bool = False) -> Column:
    """Distinct GO entries of several cells; the legacy form cuts names at commas as well."""
    text = F.concat_ws(ENTRY, *cells)
    parts = F.split(text, "[`,#]" if legacy_comma_split else ENTRY)
    return F.array_distinct(F.filter(parts, lambda e: e.contains("GO:") if legacy_comma_split else e != ""))


def first_ko(cell: Column) -> Column:
    return F.regexp_extract(cell, "KO:(K[^`]*)", 1)


def upper_ascii(c: Column) -> Column:
    return F.translate(c, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def busco_percent(line: Column, letter: str) -> Column:
    return F.try_to_number(F.nullif(F.regexp_extract(line, letter + r":([0-9.]+)%", 1), F.lit("")), F.lit("999.99")).cast("double")


def key_value(line: Column) -> tuple[Column, Column]:
    """Label and trailing number of a metrics line; a '>' keeps its number."""
    return F.regexp_replace(F.regexp_extract(line, r"^(.*?)\s+[0-9.]+\s*$", 1), r">\s+", ">"), F.regexp_extract(line, r"([0-9.]+)\s*$", 1)


def hit_or_none(hit: Column) -> Column:
    """First field of a hit; 'noHit' where the cell is missing."""
    return F.coalesce(F.substring_index(F.nullif(hit, F.lit(MISSING)), FIELD, 1), F.lit("noHit"))


#: Column and name of the hit that a header shows, by database and kind of sequence (fixed values).
HEADER_HITS = {("swissprot", "nucl"): ("c3", "SwissProt_Blastx"), ("swissprot", "prot"): ("c7", "SwissProt_Blastp"), ("uniprot", "nucl"): ("c8", "UniProt_Blastx"), ("uniprot", "prot"): ("c9", "UniProt_Blastp")}


def annotation_header(*wanted: tuple[str, str], id_col: str = "c1") -> Column:
    """``>id Name:hit`` of an annotation report's row, for one (database, kind) or several in a row; 'noHit' for none."""
    for w in wanted or [()]:
        if w not in HEADER_HITS:
            raise ValueError(f"no annotation column for {w}; one of {sorted(HEADER_HITS)}")
    parts = [x for w in wanted for x in (F.lit(f" {HEADER_HITS[w][1]}:"), hit_or_none(F.col(HEADER_HITS[w][0])))]
    return F.concat(F.lit(">"), F.col(id_col), *parts)


def axis_limit(n: Column) -> Column:
    """A plot axis' end: the next hundred with room above."""
    return F.round(n + 150, -2)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def chars(seq: Column) -> Column:
    return F.array_remove(F.split(seq, ""), "")


def kmers(seq: Column, k: int) -> Column:
    """All k-mers in order; none of a sequence shorter than k. Linear: the characters are split once."""
    each = lambda c: F.when(F.size(c) >= k, F.transform(F.sequence(F.lit(1), F.size(c) - k + 1), lambda i: F.array_join(F.slice(c, i, k), ""))).otherwise(F.array().cast("array<string>"))
    return F.flatten(F.transform(F.array(chars(seq)), each))


def mean_quality(qual: Column) -> Column:
    """Mean Phred score of a FASTQ quality string."""
    codes = F.transform(chars(qual), lambda c: F.ascii(c) - 33)
    return F.aggregate(codes, F.lit(0), lambda a, x: a + x) / F.length(qual)
