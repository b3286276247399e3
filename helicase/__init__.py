"""Variant analytics on Spark: cohort-scale tables of genetic variants as DataFrames.

Genotypes live in one long table of calls (variant_id, gene, sample_id, dosage); per-sample columns appear only in
sinks.  Expressions (filters, presets, scores, statistics) are compiled to Columns, so Catalyst sees all of a plan.
"""
