"""The whole run: reads, whitelist and region layout to genotyped cells."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cellamp.config import Params, RegionConfig
from cellamp.functions.phred import unknown_symbols
from cellamp.operators import cells, combine, dedup, regions, rescue, umi_collapse
from cellamp.session import store


@dataclass
class GenotypeRun:
    """Every table of a run, each computed when first asked for.

    Tables that several others read are written to the shared folder once: the scored primed reads (so that
    the region scan runs once), the corrected reads, the merge table, the pairs, and the surviving UMIs.
    """

    reads: DataFrame
    whitelist: DataFrame
    config: RegionConfig
    params: Params = Params()
    _observed = ()

    @cached_property
    def scored(self) -> DataFrame:
        """All reads, bad ones included, not stored."""
        return regions.looked(self.reads, self.config, self.params)

    @cached_property
    def looked(self) -> DataFrame:
        return regions.looked_table(regions.good_reads(self.scored), self.config)

    @cached_property
    def bad_reads(self) -> DataFrame:
        return regions.bad_reads(self.scored)

    @cached_property
    def primed(self) -> DataFrame:
        """Primed reads with all scores. What is counted of the others is counted on the way."""
        self._observed = seen, judged = Observation("reads"), Observation("scores")
        symbols = sum(F.coalesce(unknown_symbols(F.col(c)), F.lit(0)) for c in ("qual_r1", "qual_r2"))
        unknown = F.coalesce(F.sum(symbols), F.lit(0)).alias("unknown_symbols")
        used = self.reads.select("read_id", *self.params.chunk_cols, "seq_r1", "qual_r1", "seq_r2", "qual_r2")
        reads = used.observe(seen, F.count("*").alias("reads"), unknown)
        scored = regions.looked(reads, self.config, self.params).observe(judged, F.count_if("is_bad").alias("bad_reads"))
        return store(regions.primed(regions.good_reads(scored), self.config, self.params))

    @property
    def counts(self) -> dict[str, int]:
        """reads, unknown_symbols (qualities outside Q0..Q41 in both mates) and bad_reads, from the pass that makes ``primed``."""
        _ = self.primed
        return _values(self._observed)

    @cached_property
    def changed(self) -> DataFrame:
        return rescue.changed_reads(self.primed, self.stored_whitelist, self.params)

    @cached_property
    def corrected(self) -> DataFrame:
        return rescue.corrected_reads(self.primed, self.stored_whitelist, self.params)

    @cached_property
    def winners(self) -> DataFrame:
        """Representative reads without their barcode qualities, which only the table of reads needs."""
        return dedup.group_winners(self.corrected, self.config, self.params)

    @cached_property
    def representatives(self) -> DataFrame:
        return dedup.representatives(self.corrected, self.config, self.params)

    @cached_property
    def merged(self) -> DataFrame:
        return store(dedup.merge_table(self.winners, self.config, self.params))

    @cached_property
    def cell_summary(self) -> DataFrame:
        return cells.cell_summary(self.merged, self.config, self.params)

    @cached_property
    def pairs(self) -> DataFrame:
        """Counts per barcode and UMI over all chunks.

        Representatives are not needed for these, so only counts are shuffled, unless the merge table with
        the same counts has already been made.
        """
        if "merged" in self.__dict__:
            counts = self.merged.drop("first_seen")
        else:
            counts = dedup.duplicate_counts(self.corrected, self.config, self.params)
            counts = store(counts) if self.params.dupcut > 1 else counts
        counts = cells.surviving_rows(counts, self.params)
        return store(combine.sum_pairs(counts, self.params))

    @cached_property
    def concat(self) -> DataFrame:
        return combine.concat_cells(self.pairs)

    @cached_property
    def survivors(self) -> DataFrame:
        return store(umi_collapse.collapse_umis(self.pairs, self.params))

    @cached_property
    def collapsed(self) -> DataFrame:
        return umi_collapse.collapsed_cells(self.survivors, self.params)

    @cached_property
    def genotypes(self) -> DataFrame:
        return umi_collapse.cell_genotypes(self.collapsed)

    @cached_property
    def stored_whitelist(self) -> DataFrame:
        return store(self.whitelist)


@dataclass
class CombineRun:
    """Chunk tables to pairs, with the packed rows whose lists differ in length counted in the same pass.

    ``row_order`` names the columns that order the rows of all tables.
    """

    tables: DataFrame
    row_order: list[str]
    params: Params = Params()
    _observed = ()

    @cached_property
    def pairs(self) -> DataFrame:
        self._observed = (Observation("tables"),)
        uneven = F.count_if(combine.is_uneven()).alias("uneven_rows")
        tables = self.tables.observe(self._observed[0], F.count("*").alias("packed_rows"), uneven)
        return store(combine.sum_pairs(combine.unpack(tables, self.row_order), self.params))

    @property
    def counts(self) -> dict[str, int]:
        """packed_rows and uneven_rows, from the pass that makes ``pairs``."""
        _ = self.pairs
        return _values(self._observed)


def _values(observed: tuple[Observation, ...]) -> dict[str, int]:
    """What was observed; nothing was where a table has been put in place of the one that is counted."""
    if not observed:
        raise RuntimeError("the table was not made by this run, so nothing was counted")
    return {k: v for observation in observed for k, v in observation.get.items()}
