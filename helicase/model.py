"""Schemas of the engine's tables, as DDL."""

VARIANTS = "chrom string, pos bigint, id string, ref string, alt string, qual double, filter string, info map<string,string>, format string, samples array<string>"
CALLS = "variant_id bigint, gene string, sample_id string, dosage int"
PEDIGREE = "family_id string, sample_id string, father_id string, mother_id string, sex string, affected_status string"
REGIONS = "chrom string, start bigint, end bigint, name string"
COHORT = "sample_id string, is_case boolean"
PM5 = "gene string, aa_pos int, ref_aa string, alt_aa string, clnsig string, review string"

# Spellings of a missing cell.
MISSING = (".", "", "NA", "./.")
# Chromosome names of X and of the mitochondrial genome.
CHROM_X = ("X", "CHRX", "23", "x", "chrX", "chrx")
CHROM_MT = ("MT", "M", "CHRM", "CHRMT", "mt", "chrM", "chrMT")
