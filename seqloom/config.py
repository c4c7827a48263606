"""Run parameters and their validation. Every one of them is read by plans.runs, or rejected there."""

from __future__ import annotations

from dataclasses import dataclass, field

MODES = ("all", "only_asm", "only_evi", "only_ann")


@dataclass(frozen=True)
class EngineConfig:
    mode: str = "all"
    reads: str = ""
    k: tuple[int, ...] = field(default_factory=tuple)
    max_read_len: int = 0  # longer reads are refused: k and the insert sizes were chosen for it
    outdir: str = ""  # where run() publishes; nowhere if empty
    skip_qc: bool = False
    skip_filter: bool = False
    min_qual: int = 5
    adapter: str = ""
    rrna_filter: bool = False
    rrna_db: str = ""  # FASTA
    skip_normalization: bool = False
    norm_max_cov: int = 100
    norm_min_cov: int = 1
    min_kmer_count: int = 1  # k-mers seen less often are taken for reading errors
    save_reads: bool = False
    save_alignments: bool = False
    filter_species: bool = False
    host: str = ""  # FASTA of labelled host sequences
    symbiont: str = ""  # FASTA of labelled symbiont sequences
    species_seed: int = 160
    completeness_db: str = ""  # FASTA of marker genes
    all_buscos: bool = False  # completeness of every assembly, not of the final set alone
    busco_dist: bool = False  # rescue of genes that the final set lacks
    min_perc: float = 0.70
    short_orfs: bool = False  # reading frames as they are, without support by hits
    min_aa: int = 100
    gen_code: str = "Universal"
    with_signal: bool = False
    signal_table: str = ""
    with_membrane: bool = False
    membrane_table: str = ""
    with_rrna_table: bool = False
    rrna_table: str = ""
    add_annotation: bool = False
    with_kegg: bool = False
    skip_report: bool = False
    skip_run_info: bool = False
    resume: bool = False

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"unknown mode {self.mode}; one of {', '.join(MODES)}")
        if self.mode in ("all", "only_asm"):
            missing = [n for n in ("reads", "k", "max_read_len") if not getattr(self, n)]
            if missing:
                raise ValueError(f"{self.mode} needs {', '.join(missing)}")
        needs = [("rrna_filter", "rrna_db"), ("filter_species", "host"), ("filter_species", "symbiont"), ("all_buscos", "completeness_db"), ("busco_dist", "completeness_db"), ("busco_dist", "all_buscos"),
                 ("with_signal", "signal_table"), ("with_membrane", "membrane_table"), ("with_rrna_table", "rrna_table"), ("resume", "outdir"), ("save_reads", "outdir"), ("save_alignments", "outdir")]
        for flag, value in needs:
            if getattr(self, flag) and not getattr(self, value):
                raise ValueError(f"{flag} needs {value}")
        if not 0 <= self.min_perc <= 1:
            raise ValueError("min_perc is a share")
        if self.norm_min_cov > self.norm_max_cov:
            raise ValueError("norm_min_cov is above norm_max_cov")
        from seqloom.operators.sequence import codon_table

        codon_table(self.gen_code)

    @property
    def n_assemblies(self) -> int:
        """Four assemblers sweep the k list, one has its own k."""
        return 4 * len(self.k) + 1

    @property
    def n_tables(self) -> int:
        """Completeness tables: every assembly and the final set."""
        return self.n_assemblies + 1
