"""Completeness rescue, from status tables to the sequences to add."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators import relational as R
from seqloom.operators.shuffle import cut


def tables_of(status: DataFrame) -> DataFrame:
    """The status tables(table, pos, busco_id, status, sequence, score, length), a run of lines of one id as one row
    with the first value of each column that is not null."""
    return R.islands_first(status, "busco_id", ["pos"], ["table"])


def first_rows(tables: DataFrame) -> DataFrame:
    """The first row of every id in every table."""
    place = F.struct("pos", "island")
    return tables.groupBy("table", "busco_id").agg(*[F.min_by(c, place).alias(c) for c in ("status", "sequence", "score")])


def rescue_run(status: DataFrame, fasta: DataFrame, final: str, min_share: float = 0.70) -> dict[str, DataFrame]:
    """The frames of a rescue: comparison (ids missing in some table, a column per table), missing_final (those
    that the final table lacks), rescued (their best candidate) and sequences (its FASTA records).

    ``final`` names the final set's table, which is one of the tables that support is measured against but
    never a candidate's. Candidates need a sequence and a score; ids need candidates in at least
    ``min_share`` of all tables. An id that some table does not list is not compared. ``sequences`` keeps
    every record of fasta(id, description, seq) with a rescued name and may be empty.
    """
    rows = cut(first_rows(tables_of(status)))
    names = sorted(r[0] for r in rows.select("table").distinct().collect())  # a name per assembly
    if final not in names:
        raise ValueError(f"no table named {final!r} among {names}")
    listed = rows.groupBy("busco_id").agg(F.count(F.lit(1)).alias("n"), F.max((F.col("status") == "Missing").cast("int")).alias("lost"))
    listed = listed.where(f"n = {len(names)} AND lost = 1").select("busco_id")
    cells = rows.join(listed, "busco_id", "left_semi")
    comparison = R.status_matrix(cells.select("busco_id", "table", "status"), "busco_id", "table", names)
    candidates = cells.where("sequence IS NOT NULL").select("busco_id", "table", "score", F.col("sequence").alias("tie"))
    rescued = R.rescue(cells, candidates, "busco_id", "table", final, len(names), min_share)
    rescued = rescued.select("busco_id", "table", F.col("tie").alias("sequence"), "score", "support")
    return {
        "comparison": comparison,
        "missing_final": comparison.where(F.col(f"`{final}`") == "Missing"),
        "rescued": rescued,
        "sequences": R.records_of(fasta, rescued.select(F.col("sequence").alias("id"))),
    }
