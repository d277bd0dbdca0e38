"""The registered queries: each runs an operator over the reads derived from the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellamp.config import Params, RegionConfig
from cellamp.functions.phred import error_sum, packed_scores, score_sum
from cellamp.functions.region_scan import error_fields, mismatch_fields
from cellamp.operators import cells, chunks, combine, dedup, regions, rescue, umi_collapse, umi_graph, whitelist
from cellamp.operators.reads import cut_fields
from cellamp.plans import fixture
from cellamp.plans.genotype import GenotypeRun
from cellamp.session import store

PARAMS = Params()
CHUNK_TARGET = 3000


def _plain(df: DataFrame) -> DataFrame:
    """Integers as bigint and doubles to 9 places, so that two engines print the same."""

    def tidy(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegerType):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return F.round(column, 9).alias(field.name)
        return column

    return df.select(*[tidy(f) for f in df.schema])


def _run(spark: SparkSession, sf_dir: str, config: RegionConfig = fixture.LINEAR, params: Params = PARAMS) -> GenotypeRun:
    return GenotypeRun(fixture.reads(spark, sf_dir), fixture.whitelist(spark, sf_dir), config, params)


def read_fields(spark, sf_dir):
    return cut_fields(fixture.reads(spark, sf_dir)).select("read_id", "bc", "bc_qual", "umi")


def phred_decode(spark, sf_dir):
    fields = cut_fields(fixture.reads(spark, sf_dir))
    return _plain(
        fields.select(
            "read_id",
            packed_scores(F.col("bc_qual")).alias("bc_q"),
            score_sum(F.col("bc_qual")).alias("bc_q_sum"),
            error_sum(F.col("qual_r2")).alias("err_r2"),
        )
    )


def primer_shift(spark, sf_dir):
    return _plain(regions.mismatches(fixture.reads(spark, sf_dir), fixture.LINEAR).select("read_id", "shift", "mm_primer"))


def region_mismatch(spark, sf_dir):
    found = regions.mismatches(fixture.reads(spark, sf_dir), fixture.CIRC)
    return _plain(found.select("read_id", *mismatch_fields(fixture.CIRC)[1:]))


def region_errors(spark, sf_dir):
    return _plain(_run(spark, sf_dir, fixture.CIRC).scored.select("read_id", *error_fields(fixture.CIRC)))


def looked_linear(spark, sf_dir):
    return _plain(_run(spark, sf_dir).looked)


def looked_circ(spark, sf_dir):
    return _plain(_run(spark, sf_dir, fixture.CIRC).looked)


def _primed(spark, sf_dir, config):
    scored = regions.good_reads(regions.looked(fixture.reads(spark, sf_dir), config))
    return _plain(regions.primed(scored, config).select("read_id", "bc", "umi", *mismatch_fields(config)))


def primed_linear(spark, sf_dir):
    return _primed(spark, sf_dir, fixture.LINEAR)


def primed_circ(spark, sf_dir):
    return _primed(spark, sf_dir, fixture.CIRC)


def bad_reads(spark, sf_dir):
    scored = regions.looked(fixture.damaged_reads(spark, sf_dir), fixture.LINEAR)
    return _plain(regions.bad_reads(scored).select("read_id", "r2_len", "mm_primer", "mm_wt", "err_r2", "err_shared"))


def read_counts(spark, sf_dir):
    """Reads, bad reads and unknown symbols of a run over damaged reads, counted by the pass that scores them."""
    run = GenotypeRun(fixture.damaged_reads(spark, sf_dir), fixture.whitelist(spark, sf_dir), fixture.LINEAR)
    return spark.createDataFrame([run.counts], "reads bigint, bad_reads bigint, unknown_symbols bigint")


def whitelist_order(spark, sf_dir):
    return _plain(fixture.whitelist(spark, sf_dir).select("bc", "wl_idx"))


def whitelist_semi(spark, sf_dir):
    run = _run(spark, sf_dir)
    return whitelist.in_whitelist(run.primed.select("read_id", "bc"), run.stored_whitelist)


def whitelist_anti(spark, sf_dir):
    run = _run(spark, sf_dir)
    return whitelist.not_in_whitelist(run.primed.select("read_id", "bc"), run.stored_whitelist)


def _observed(run: GenotypeRun) -> DataFrame:
    return store(whitelist.listed_barcodes(whitelist.observed_barcodes(run.primed), run.stored_whitelist))


def hamming1_candidates(spark, sf_dir):
    run = _run(spark, sf_dir)
    unlisted = _observed(run).filter("NOT listed")
    return _plain(whitelist.hamming1_candidates(unlisted, run.stored_whitelist, PARAMS.bc_len))


def hamming_k_join(spark, sf_dir):
    run = _run(spark, sf_dir)
    return _plain(whitelist.hamming_join(_observed(run), run.stored_whitelist, 2, PARAMS.bc_len).drop("wl_idx"))


def prior_counts(spark, sf_dir):
    run = _run(spark, sf_dir)
    return rescue.prior_counts(_observed(run))


def rescue_posterior(spark, sf_dir):
    run = _run(spark, sf_dir)
    unlisted = whitelist.not_in_whitelist(run.primed, run.stored_whitelist)
    return _plain(rescue.posteriors(rescue.with_candidates(unlisted, _observed(run), run.stored_whitelist)))


def rescue_status(spark, sf_dir):
    return _run(spark, sf_dir).changed.select("read_id", "bc", "status", "replaced_bc")


def mtx_re(spark, sf_dir):
    return _plain(_run(spark, sf_dir).corrected.select("read_id", "bc", "umi", "whitelist", "part"))


def dup_counts(spark, sf_dir):
    return dedup.duplicate_counts(_run(spark, sf_dir).corrected, fixture.LINEAR)


def dedup_representative(spark, sf_dir):
    reps = _run(spark, sf_dir).representatives
    return _plain(
        reps.select(
            "barcode_umi", "read_id", "whitelist", "call", "mm_wt", "mm_mut", "err_wt", "err_mut", "n_wt", "n_mut",
            "n_amb", "total_dups",
        )
    )


def _first_seen(df: DataFrame, name: str = "first_seen") -> DataFrame:
    return df.select(
        *[c for c in df.columns if c != name],
        F.col(f"{name}.part").alias("first_part"),
        F.col(f"{name}.read_id").alias("first_read"),
    )


def merge_table(spark, sf_dir):
    run = _run(spark, sf_dir)
    return _plain(_first_seen(dedup.merge_table(run.winners, fixture.LINEAR)))


def merge_table_circ(spark, sf_dir):
    run = _run(spark, sf_dir, fixture.CIRC)
    return _plain(_first_seen(dedup.merge_table(run.winners, fixture.CIRC)))


def cell_summary(spark, sf_dir):
    summary = _run(spark, sf_dir, params=replace(PARAMS, dupcut=60)).cell_summary
    return _plain(_first_seen(summary))


def cell_summary_parts(spark, sf_dir):
    """All cells, at most four UMIs a row, as cells beyond MAX_PACKED come out."""
    run = _run(spark, sf_dir)
    return _plain(_first_seen(cells.cell_summary(run.merged, run.config, max_packed=4)))


def _summary_by_chunk(spark, sf_dir) -> tuple[DataFrame, Params]:
    params = replace(PARAMS, dupcut=2, chunk_cols=("chunk_id",))
    reads = chunks.assign_chunks(fixture.reads(spark, sf_dir), CHUNK_TARGET)
    run = GenotypeRun(reads, fixture.whitelist(spark, sf_dir), fixture.LINEAR, params)
    return run.cell_summary, params


def _packed_by_chunk(spark, sf_dir) -> tuple[DataFrame, Params]:
    summary, params = _summary_by_chunk(spark, sf_dir)
    packed = summary.select(
        "chunk_id", "first_seen", F.col("bc_list").alias("bc"), *[F.col(f"{c}_list").alias(c) for c in combine.PACKED]
    )
    return packed, params


def unpack_explode(spark, sf_dir):
    """Chunk tables packed per cell, and taken apart again."""
    packed, _ = _packed_by_chunk(spark, sf_dir)
    rows = combine.unpack(packed, ["chunk_id", "first_seen"])
    return _plain(
        rows.select(
            "bc", "umi", *combine.PACKED[1:], F.col("first_seen.chunk_id").alias("chunk_id"),
            F.col("first_seen.pos").alias("pos"),
        )
    )


def chunk_local_pairs(spark, sf_dir):
    """Priors, groups and the cell cut inside seeded chunks, then summed over the chunks."""
    packed, params = _packed_by_chunk(spark, sf_dir)
    rows = combine.unpack(packed, ["chunk_id", "first_seen"])
    return _plain(combine.sum_pairs(rows, params).drop("first_seen"))


def pair_counts(spark, sf_dir):
    return _plain(_run(spark, sf_dir).pairs)


def pair_order(spark, sf_dir):
    run = _run(spark, sf_dir)
    pairs = store(combine.sum_pairs(run.merged))
    ordered = combine.with_bc_first(pairs).drop("first_seen")
    return _plain(_first_seen(ordered, "bc_first"))


def concat_cells(spark, sf_dir):
    run = _run(spark, sf_dir)
    pairs = store(combine.sum_pairs(run.merged))
    return _plain(_first_seen(combine.concat_cells(pairs), "bc_first"))


def concat_cells_parts(spark, sf_dir):
    """Packed cells of at most four UMIs a row, as cells beyond MAX_PACKED come out."""
    run = _run(spark, sf_dir)
    pairs = store(combine.sum_pairs(run.merged))
    return _plain(_first_seen(combine.concat_cells(pairs, max_packed=4), "bc_first"))


def chunk_assign(spark, sf_dir):
    return _plain(chunks.assign_chunks(fixture.reads(spark, sf_dir), CHUNK_TARGET).select("read_id", "chunk_id"))


def umi_edges_levenshtein(spark, sf_dir):
    return umi_graph.umi_edges(_run(spark, sf_dir).pairs, replace(PARAMS, umi_metric="levenshtein"))


def umi_edges_unanchored(spark, sf_dir):
    return umi_graph.umi_edges(_run(spark, sf_dir).pairs)


def mixed_umis(pairs: DataFrame) -> DataFrame:
    """UMIs of 8 to 14 bases: a UMI and its mirror image, cut at a length that its first and last letters give."""
    length = F.lit(8) + (F.ascii(F.substring("umi", 1, 1)) + F.ascii(F.substring("umi", -1, 1))) % 7
    return pairs.select("bc", F.substring(F.concat("umi", F.reverse("umi")), F.lit(1), length).alias("umi")).distinct()


def umi_edges_mixed(spark, sf_dir):
    """UMIs of unlike lengths, all through the joins that large cells take."""
    return umi_graph.umi_edges(store(mixed_umis(_run(spark, sf_dir).pairs)), max_cell=0)


def umi_degree(spark, sf_dir):
    pairs = _run(spark, sf_dir).pairs
    return _plain(umi_graph.umi_degrees(pairs, umi_graph.umi_edges(pairs)))


def collapsed_umis(spark, sf_dir):
    return _plain(_run(spark, sf_dir).survivors)


def collapsed_umis_joins(spark, sf_dir):
    """The same as large cells and components are collapsed: by joins, a takeover per component and round."""
    return _plain(umi_collapse.collapse_umis(_run(spark, sf_dir).pairs, PARAMS, max_cell=2, max_component=8))


def collapsed_cells(spark, sf_dir):
    return _plain(_run(spark, sf_dir).collapsed)


def mutation_fraction(spark, sf_dir):
    return _run(spark, sf_dir).genotypes


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        read_fields, phred_decode, primer_shift, region_mismatch, region_errors, looked_linear, looked_circ,
        primed_linear, primed_circ, bad_reads, read_counts, whitelist_order, whitelist_semi, whitelist_anti, hamming1_candidates,
        hamming_k_join, prior_counts, rescue_posterior, rescue_status, mtx_re, dup_counts, dedup_representative,
        merge_table, merge_table_circ, cell_summary, cell_summary_parts, unpack_explode, chunk_local_pairs, pair_counts, pair_order,
        concat_cells, concat_cells_parts, chunk_assign, umi_edges_levenshtein, umi_edges_unanchored, umi_edges_mixed, umi_degree,
        collapsed_umis, collapsed_umis_joins, collapsed_cells, mutation_fraction,
    )
}
