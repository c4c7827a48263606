"""The run's report: small summary frames as one static HTML page."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators import relational


def render(title: str, frames: dict[str, DataFrame], max_rows: int = 10_000) -> str:
    """A page with a table for each frame, rows in the frame's order.

    Summaries only: a frame of more than ``max_rows`` rows raises, nothing is cut off.
    """
    parts = [f"<h1>{html.escape(title)}</h1>"]
    for name, frame in frames.items():
        rows = frame.limit(max_rows + 1).collect()
        if len(rows) > max_rows:
            raise ValueError(f"{name} has more than {max_rows} rows; a report takes summaries")
        cells = lambda tag, values: "<tr>" + "".join(f"<{tag}>{html.escape('' if v is None else str(v))}</{tag}>" for v in values) + "</tr>"
        body = "\n".join(cells("td", r) for r in rows) or f"<tr><td colspan={len(frame.columns)}>no rows</td></tr>"
        parts.append(f"<h2>{html.escape(name)}</h2>\n<table>\n{cells('th', frame.columns)}\n{body}\n</table>")
    style = "body{font-family:sans-serif;margin:2em}table{border-collapse:collapse}td,th{border:1px solid #999;padding:.2em .6em;text-align:left}"
    return f"<!doctype html>\n<html><head><meta charset='utf-8'><title>{html.escape(title)}</title><style>{style}</style></head>\n<body>\n" + "\n".join(parts) + "\n</body></html>\n"


#: Sections in the page's order: title and the run's frame it shows.
SECTIONS = [
    ("Read quality by position", "quality"), ("Read filter", "filter_stats"), ("rRNA", "rrna_stats"), ("Normalisation", "normalization_stats"), ("Transcripts by assembly", "counts"), ("Transcripts after reduction", "reduced_counts"),
    ("Before and after reduction", "before_after"), ("Transcript lengths", "lengths"), ("Assembly metrics", "metrics"), ("Mapping rate", "mapping"), ("Completeness", "status_shares"), ("Completeness by gene", "status_codes"),
    ("Reading frames", "orf_stats"), ("Species split", "species_accuracy"), ("KEGG ids", "kegg"), ("Run", "run_info"),
]
STATUSES = ("Complete", "Duplicated", "Fragmented", "Missing")


def status_shares(cells: DataFrame) -> DataFrame:
    """table, category, n, percent of a status table: what a stacked bar shows."""
    per = cells.groupBy("table").agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    return per.unpivot(["table", "all"], list(STATUSES), "category", "n").select("table", "category", "n", F.round(100 * F.col("n") / F.col("all"), 1).alias("percent")).orderBy("table", "category")


def status_codes(cells: DataFrame) -> DataFrame:
    """busco_id, table, value of the genes that some table lacks: what a heat map shows; 3 for Complete down to 0 for Missing."""
    lacking = cells.where("status = 'Missing'").select("busco_id").distinct()
    code = sum((F.when(F.col("status") == s, 3 - i).otherwise(0) for i, s in enumerate(STATUSES)), F.lit(0))
    return cells.join(lacking, "busco_id", "left_semi").select("busco_id", "table", code.alias("value")).orderBy("busco_id", "table")


def length_bins(contigs: DataFrame) -> DataFrame:
    """from, n of sequence lengths in hundreds, as the pages' histogram: below 200 first, 2500 and beyond last."""
    n = F.length("seq")
    low = F.when(n < 200, 0).when(n >= 2500, 2500).otherwise(F.floor(n / 100) * 100)
    return contigs.groupBy(low.cast("int").alias("from")).agg(F.count(F.lit(1)).alias("n")).orderBy("from")


def before_after(counts: DataFrame, reduced: DataFrame) -> DataFrame:
    """Counts of each assembly before and after reduction, turned: a row per state, a column per assembly."""
    both = counts.withColumnRenamed("n", "before").join(reduced.withColumnRenamed("n", "after"), "tag", "left").fillna(0, ["after"])
    tags = sorted(r[0] for r in counts.select("tag").collect())  # one per assembly
    return relational.transpose(both, "tag", ["before", "after"], tags).orderBy(F.desc("name"))


def sections(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The page's sections from a run's frames; those a run did not make are left out."""
    made = dict(frames)
    if "reduced" in frames:
        made["lengths"] = length_bins(frames["reduced"])
    if "counts" in frames and "reduced_counts" in frames:
        made["before_after"] = before_after(frames["counts"], frames["reduced_counts"])
    if "completeness" in frames:
        made["status_shares"], made["status_codes"] = status_shares(frames["completeness"]), status_codes(frames["completeness"])
    sort = {"quality": "pos", "counts": "tag", "reduced_counts": "tag", "run_info": "component", "kegg": "ko"}
    return {title: made[n].orderBy(sort[n]) if n in sort else made[n] for title, n in SECTIONS if n in made}
