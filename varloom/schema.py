"""Key columns, table schemas and the fixed values of the variant rules."""

from __future__ import annotations

from pyspark.sql import types as T

# --- keys -----------------------------------------------------------------------------------------------------------

VARIANT_KEY = ["chrom", "pos", "ref", "alt"]
LOCUS_ALT_KEY = ["chrom", "pos", "alt"]
PARTITION_COLUMNS = ["chrom", "blk_pos"]
# Identity of a distinct variant together with its storage partition. Deduplicating and joining on the same list in
# the same order lets Spark hash the variants once for a whole chain of joins.
BLOCK_KEY = ["chrom", "blk_pos", "pos", "ref", "alt"]

BLOCK_WIDTH = 1_000_000
RANGE_BIN_WIDTH = 100_000

# --- fixed values ---------------------------------------------------------------------------------------------------
# These must equal the published rules for results to agree.

CHROMOSOMES = [str(n) for n in range(1, 23)] + ["X", "Y", "M"]
SEX_CHROMOSOMES = ["X", "Y"]

# ClinVar significance is a '|'-separated list of codes; 255 means "other" and is ignored by the patterns.
PATHOGENIC_STRICT = {"never": r"3|2[^5]|2$", "has": r"4|[^25]5|^5"}
PATHOGENIC_LOOSE = {"never": r"3|2[^5]", "has": r"4|[^25]5"}

MEMBER_SUFFIXES = {"M": "01", "F": "02", "NB": "03"}

# Predictor columns of the functional-prediction table and the letter that means "damaging".
DAMAGING_CALLS = {
    "sift_pred": "D",
    "polyphen2_hdiv_pred": "D",
    "mutation_taster_pred": "D",
    "mutation_assessor_pred": "H",
    "fathmm_pred": "D",
    "provean_pred": "D",
}

# Effect names of the protein-consequence rating. The spelling is part of the rule.
PPC_EFFECTS = {
    "equal": [
        "codings_sequence_variant",
        "chromosome",
        "missense_variant",
        "initator_codon_variant",
        "stop_retained_variant",
        "transcript_variant",
    ],
    "frameshift": "frameshift_variant",
    "deletion_inframe": "disruptive_inframe_insertion",
    "insertion_inframe": "disruptive_inframe_deletion",
}

# Allele total of the reference panel behind the adjusted allele count.
PANEL_ALLELES = 5008

# Sub-fields of one annotation entry, separated by '|', in file order.
EFFECT_FIELDS = [
    "allele",
    "effect",
    "impact",
    "gene",
    "gene_id",
    "feature",
    "feature_id",
    "biotype",
    "rank",
    "hgvs_c",
    "hgvs_p",
    "cdna_pos",
    "cds_pos",
    "aa_pos",
    "distance",
]

VCF_HEADER = ["##fileformat=VCFv4.0", "##fileDate={date}", "##reference=grch37v47"]

# --- table schemas --------------------------------------------------------------------------------------------------


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()

DISTINCT_VARIANTS = _struct(
    ("var_id", _S), ("pos", _I), ("ref", _S), ("allele", _S), ("chrom", _S), ("blk_pos", _I)
)

EFFECT_RESULTS = _struct(
    ("pos", _I), ("var_id", _S), ("ref", _S), ("alt", _S), ("gene", _S), ("gene_id", _S), ("affect", _S),
    ("impact", _S), ("feature", _S), ("feature_id", _S), ("biotype", _S), ("rank", _I), ("distance", _S),
    ("hgvs_c", _S), ("hgvs_p", _S), ("chrom", _S), ("blk_pos", _I),
)

PANEL = _struct(("sample", _S), ("pop", _S), ("super_pop", _S), ("gender", _S))

MARKER_MAP = _struct(("chrom", _S), ("id", _S), ("morgans", _D), ("pos", _I), ("a1", _S), ("a2", _S))

FAMILY_FILE = _struct(
    ("family", _S), ("subject", _S), ("paternal", _S), ("maternal", _S), ("sex", _I), ("affection", _I)
)
