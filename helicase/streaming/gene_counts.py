"""Burden counts of genes from a stream of calls: a gene's carriers are state until later positions have come.

A call's place on the genome is its event time, so the watermark is how far behind the furthest place calls may still
arrive.  A gene's state holds its carriers' largest dosages, a row a sample at most, and its variants; once the watermark
has passed the gene's last place the counts come out, once, and the state goes.  Calls that come later than that are
dropped by the watermark, as late rows are.  A query that starts again from its checkpoint goes on with the state it had.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

COUNTS = "gene string, case_carriers bigint, control_carriers bigint, case_alleles bigint, control_alleles bigint, n_variants bigint"
STATE = "samples array<string>, dosages array<int>, cases array<boolean>, variants array<string>, last bigint"


def at_place(chromosome: Column, pos: Column) -> Column:
    """The event time of a position: a second a base, chromosomes (numbers from 0) one after the other."""
    return F.timestamp_seconds(chromosome.cast("bigint") * F.lit(1 << 29) + pos.cast("bigint"))


def _counts(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        samples, dosages, cases, variants, _ = state.get
        state.remove()
        told = pd.DataFrame({"d": list(dosages), "case": list(cases)})
        on, off = told[told["case"]], told[~told["case"].astype(bool)]
        yield pd.DataFrame([(key[0], len(on), len(off), int(on["d"].sum()), int(off["d"].sum()), len(variants))], columns=[c.split()[0] for c in COUNTS.split(", ")])
        return
    known: dict[str, tuple[int, bool]] = {}
    variants, last = set(), 0
    if state.exists:
        samples, dosages, cases, told, last = state.get
        known = dict(zip(samples, zip(dosages, cases, strict=True), strict=True))
        variants = set(told)
    for frame in frames:
        last = max(last, int(frame["place"].max()))
        variants.update(frame["variant"])
        for sample, dosage, case in zip(frame["sample_id"], frame["dosage"], frame["is_case"], strict=True):
            if sample not in known or known[sample][0] < dosage:
                known[sample] = (int(dosage), bool(case))
    state.update((list(known), [d for d, _ in known.values()], [c for _, c in known.values()], sorted(variants), last))
    state.setTimeoutTimestamp(max(last * 1000 + 1, state.getCurrentWatermarkMs() + 1))
    yield from ()


def gene_counts(calls: DataFrame, who: DataFrame, late: int) -> DataFrame:
    """COUNTS of a stream of calls (gene, variant_id, sample_id, dosage, at) against who (sample_id, is_case); calls come
    at most so many bases behind the furthest one.  A gene whose variants lie further apart than that is told in parts."""
    rows = calls.where("dosage > 0").join(who, "sample_id").withWatermark("at", f"{late} seconds")
    rows = rows.select("gene", F.col("variant_id").cast("string").alias("variant"), "sample_id", F.col("dosage").cast("int").alias("dosage"), "is_case", F.unix_timestamp("at").alias("place"), "at")
    return rows.groupBy("gene").applyInPandasWithState(_counts, COUNTS, STATE, "append", GroupStateTimeout.EventTimeTimeout)
