"""Files in, files out, chunks and the incremental combine."""

import gzip
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cellamp.config import Params
from cellamp.operators import cells, chunks, combine, dedup, regions, rescue
from cellamp.plans import fixture, queries
from cellamp.session import store
from cellamp.sources import fastq, ranges, sinks, tables
from cellamp.streaming.combine_stream import _numbers, combine_stream, combined_pairs


@pytest.fixture(scope="module")
def run(spark, sf_dir, shared_runs):
    return queries._run(spark, sf_dir)


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return fixture.reads(spark, sf_dir).orderBy("read_id").limit(200).collect()


def _fastq(path, rows, mate, zipped=False):
    text = "".join(f"@r{r.read_id}/{mate}\n{r[f'seq_r{mate}']}\n+\n{r[f'qual_r{mate}']}\n" for r in rows)
    with (gzip.open(path, "wt") if zipped else open(path, "w")) as out:
        out.write(text)
    return str(path)


def _plain(df):
    return [(r.header_r1, r.header_r2, r.seq_r1, r.qual_r1, r.seq_r2, r.qual_r2) for r in df.orderBy("read_id").collect()]


def test_fastq_pairs(spark, rows, tmp_path):
    r1 = [_fastq(tmp_path / "a1.fastq.gz", rows[:150], 1, True), _fastq(tmp_path / "b1.fastq", rows[150:], 1)]
    r2 = [_fastq(tmp_path / "a2.fastq.gz", rows[:150], 2, True), _fastq(tmp_path / "b2.fastq", rows[150:], 2)]
    df = fastq.read_fastq_pairs(spark, r1, r2)
    assert df.rdd.getNumPartitions() == 2
    expected = [(f"@r{r.read_id}/1", f"@r{r.read_id}/2", r.seq_r1, r.qual_r1, r.seq_r2, r.qual_r2) for r in rows]
    assert _plain(df) == expected
    assert [r.read_id for r in df.filter("file_id = 1").orderBy("read_id").limit(2).collect()] == [1 << 40, (1 << 40) + 1]


def test_unequal_mates(spark, rows, tmp_path):
    r1, r2 = _fastq(tmp_path / "1.fastq", rows[:10], 1), _fastq(tmp_path / "2.fastq", rows[:8], 2)
    for read in (lambda u: fastq.read_fastq_pairs(spark, [r1], [r2], u), lambda u: fastq.split_fastq_pairs(spark, [r1], [r2], unequal=u)):
        with pytest.raises(Exception, match="differ in their number of reads"):
            read("error").collect()
        assert read("truncate").count() == 8


def test_split_fastq_in_blocks(spark, rows, tmp_path):
    r1, r2 = _fastq(tmp_path / "1.fastq", rows, 1), _fastq(tmp_path / "2.fastq", rows, 2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(r1).rdd.getNumPartitions() > 3
        small = [_fastq(tmp_path / f"s{m}.fastq", rows[:7], m) for m in (1, 2)]
        again = [_fastq(tmp_path / f"t {m}.fastq", rows[50:], m) for m in (1, 2)]
        files = [small[0], r1, again[0]], [small[1], r2, again[1]]
        blocks = fastq.read_fastq_pairs(spark, *files, split_bytes=5000)
        whole = fastq.read_fastq_pairs(spark, *files)
        assert _plain(blocks) == _plain(whole)
        ids = [sorted((r.read_id, r.file_id) for r in df.select("read_id", "file_id").collect()) for df in (blocks, whole)]
        assert ids[0] == ids[1] and len(ids[0]) == 357
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("unequal", ["error", "truncate"])
@pytest.mark.parametrize("split_bytes", [1, 1 << 30])
def test_ends_of_files(spark, rows, tmp_path, split_bytes, unequal):
    """Blank tails, cut records and missing mates are the same in blocks and in lockstep."""
    r1, r2 = (_fastq(tmp_path / f"{m}.fastq", rows[:9], m) for m in (1, 2))
    short = _fastq(tmp_path / "short.fastq", rows[:7], 2)

    def read(first, second):
        return _plain(fastq.read_fastq_pairs(spark, [first], [second], unequal, split_bytes))

    nine = read(r1, r2)
    with open(r2, "a") as file:
        file.write("\n\n")
    assert len(nine) == 9 and read(r1, r2) == nine
    if unequal == "truncate":
        assert len(read(r1, short)) == 7
    else:
        with pytest.raises(Exception, match="differ in their number of reads"):
            read(r1, short)
    with open(short, "a") as file:
        file.write("@cut\nACGT\n")
    with pytest.raises(Exception, match="ends inside a record"):
        read(short, short)


@pytest.mark.parametrize("step", [90, 1000, 1 << 20])
@pytest.mark.parametrize("zipped", [(False, False), (True, True), (False, True)])
def test_ranges_of_bytes(spark, rows, tmp_path, step, zipped, monkeypatch):
    """Any cut of the files gives the same reads, also inside members, with empty fields, Windows line ends and no last line end."""
    odd = [(f"@r{r.read_id}", r.seq_r1, r.qual_r1) for r in rows[:60]] + [("", "", ""), ("@é 漢", "ACGT", "FFFF"), ("@x", "A" * 500, "F" * 500)]
    paths = []
    for mate in (1, 2):
        text = "".join(f"{h}/{mate}\r\n{s}\n+\n{q}\n" for h, s, q in odd)[: -1 if mate == 1 else None]
        path = tmp_path / f"a,b {mate}.fastq"
        path.write_bytes(text.encode())
        paths.append(str(path))
    want = _plain(fastq.read_fastq_pairs(spark, [paths[0]], [paths[1]]))
    assert len(want) == 63
    monkeypatch.setattr(ranges, "_MEMBER_TEXT", 300)
    for mate, z in enumerate(zipped):
        if z:
            target = f"{tmp_path}/z,{mate}.fastq.gz"
            ranges.compress_blocks(spark, [paths[mate]], [target])
            assert ranges.kind_of(target) == "block" and gzip.open(target).read() == open(paths[mate], "rb").read()
            paths[mate] = target
    files = [(4, paths[0], ranges.kind_of(paths[0]), paths[1], ranges.kind_of(paths[1]))]
    got = ranges.read_ranges(spark, files, step=step)
    assert _plain(got) == want and sorted(r.read_id for r in got.collect()) == [(4 << 40) + k for k in range(63)]
    # Nothing is moved after the texts are read.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange")


def test_empty_files_and_plain_gzip(spark, rows, tmp_path):
    empty = [tmp_path / f"{m}.fastq" for m in (1, 2)]
    for path in empty:
        path.write_text("")
    files = [(0, str(empty[0]), "plain", str(empty[1]), "plain")]
    assert ranges.read_ranges(spark, files).count() == 0
    zipped = _fastq(tmp_path / "1.fastq.gz", rows[:5], 1, True)
    assert ranges.kind_of(zipped) == "gzip" and ranges.kind_of("nowhere://x/y") is None and ranges.kind_of(str(tmp_path / "none")) is None


def test_large_gzip_files_are_spread(spark, rows, tmp_path):
    r1, r2 = _fastq(tmp_path / "1.fastq.gz", rows, 1, True), _fastq(tmp_path / "2.fastq.gz", rows, 2, True)
    spread = fastq.read_fastq_pairs(spark, [r1], [r2], split_bytes=10)
    assert spread.rdd.getNumPartitions() >= 8
    assert _plain(spread) == _plain(fastq.read_fastq_pairs(spark, [r1], [r2]))


def test_regions_and_whitelist(spark, tmp_path):
    layout = tmp_path / "regions.config"
    layout.write_text("".join(f"{r.seq}\t{r.start}\t{r.end}\n" + ("\n" if r.name == "wt" else "") for r in fixture.CIRC.regions))
    assert tables.read_regions(spark, str(layout), "circ") == fixture.CIRC
    assert tables.read_regions(spark, str(layout)) == fixture.LINEAR
    short = tmp_path / "short.config"
    short.write_text("ACGT\t1\t4\n")
    with pytest.raises(ValueError):
        tables.read_regions(spark, str(short))
    wl = tmp_path / "whitelist.txt"
    wl.write_text("TTTT\nAAAA\n\nTTTT\nCCCC\n")
    assert {r.bc: r.wl_idx for r in tables.read_whitelist(spark, str(wl)).collect()} == {"TTTT": 0, "AAAA": 1, "CCCC": 2}


def test_looked_text_gives_the_same_groups(spark, run, tmp_path):
    path = str(tmp_path / "looked")
    sinks.write_looked(run.looked, path)
    back = tables.read_looked(spark, path)
    assert back.count() == run.looked.count()
    primed = store(tables.with_error_sums(regions.primed(back, run.config), run.config))
    corrected = rescue.corrected_reads(primed, run.stored_whitelist)
    again = dedup.representatives(corrected, run.config).select("barcode_umi", "n_wt", "n_mut", "n_amb", "call", "err_wt")
    expected = run.representatives.select(*again.columns)
    assert again.exceptAll(expected).isEmpty() and again.count() == expected.count()


def test_looked_rejects_malformed_lines(spark, tmp_path):
    path = tmp_path / "x.looked"
    good = "\t".join(["AC", "40;40;", "G", "1", "0", "2", "3", "0.1", "0.2", "0.3", "0.4", "0.5", "extra"])
    path.write_text("\n".join(["BC\t" + "x\t" * 11, "", "a\tb", good, good.replace("\t1\t0", "\tx\t0")]) + "\n")
    got = tables.read_looked(spark, str(path)).collect()
    assert [(r.bc, r.bc_qual, r.mm_mut, r.avg_err_mut) for r in got] == [("AC", "II", 3, 0.5)]


def _chunk_folder(spark, run, sf_dir, root):
    """Chunk tables as text files below four-digit folders, as separate runs leave them."""
    params = replace(run.params, dupcut=2, chunk_cols=("chunk_id",))
    reads = chunks.assign_chunks(fixture.reads(spark, sf_dir), 400)
    chunked = queries.GenotypeRun(reads, run.stored_whitelist, run.config, params)
    parts = store(chunked.cell_summary)
    for i in (r.chunk_id for r in parts.select("chunk_id").distinct().collect()):
        folder = os.path.join(root, f"{i:04d}")
        sinks.write_cell_summary(parts.filter(F.col("chunk_id") == i), folder + ".d", one_file=True)
        os.makedirs(folder)
        (written,) = [f for f in os.listdir(folder + ".d") if f.endswith(".csv")]
        with open(os.path.join(folder + ".d", written)) as src, open(f"{folder}/s.summTable.txt", "w") as dst:
            dst.write(src.read())
    return parts, chunked.pairs


def test_chunk_tables_and_stream(spark, run, sf_dir, tmp_path):
    root = str(tmp_path)
    parts, unpacked = _chunk_folder(spark, run, sf_dir, root)
    paths = tables.chunk_table_paths(spark, root, "other")
    assert len(paths) == parts.select("chunk_id").distinct().count() > 1
    pairs = combine.sum_pairs(combine.unpack(tables.read_chunk_tables(spark, paths), tables.ROW_ORDER))
    direct = combine.sum_pairs(
        combine.unpack(
            parts.select("chunk_id", "first_seen", F.col("bc_list").alias("bc"), *[F.col(f"{c}_list").alias(c) for c in combine.PACKED]),
            ["chunk_id", "first_seen"],
        )
    )
    names = ["bc", "umi", "n_wt", "n_mut", "n_amb", "call"]
    assert pairs.select(names).exceptAll(direct.select(names)).isEmpty() and pairs.count() == direct.count()
    assert unpacked.select(names).exceptAll(direct.select(names)).isEmpty() and unpacked.count() == direct.count()
    orders = [
        [r.bc for r in combine.ordered_pairs(store(p)).select("bc", "umi").collect()] for p in (pairs, direct)
    ]
    assert orders[0] == orders[1]

    with open(paths[0].removeprefix("file:")) as table:
        header = table.readline().rstrip("\n").split("\t")
    for _ in range(2):
        combine_stream(spark, root, f"{root}/sums", f"{root}/state", header, "s.summTable.txt").awaitTermination()
        streamed = combined_pairs(spark, f"{root}/sums")
        assert streamed.select(names).exceptAll(direct.select(names)).isEmpty() and streamed.count() == direct.count()


def test_late_tables_are_chosen_as_the_batch_way_does(spark, tmp_path):
    """Several tables in a folder, late and empty ones, and compacted batches."""
    header = [*tables.CHUNK_COLUMNS]
    root = tmp_path / "chunks"

    def put(name, count):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        row = {"BC": "AC;GT", "UMI": "U;V", "num.WT.in.dups": f"{count};1", "num.MUT.in.dups": "0;2", "num.amb.in.dups": "0;0"}
        path.write_text("\t".join(header) + "\n" + "\t".join(row.get(c, "WT;WT") for c in header) + "\n" if count else "")

    def both(sample, compact):
        combine_stream(spark, str(root), f"{tmp_path}/sums", f"{tmp_path}/state", header, compact=compact).awaitTermination()
        paths = tables.chunk_table_paths(spark, str(root), sample)
        batch = combine.sum_pairs(combine.unpack(tables.read_chunk_tables(spark, paths), tables.ROW_ORDER))
        names = ["bc", "umi", "n_wt", "n_mut", "n_amb", "call"]
        got = combined_pairs(spark, f"{tmp_path}/sums", sample=sample, folder=str(root))
        assert sorted(got.select(names).collect()) == sorted(batch.select(names).collect())
        return {r.umi: r.n_wt for r in got.collect()}

    put("0000/s.summTable.txt", 5)
    put("0000/other.summTable.txt", 7)
    put("0001/other.summTable.txt", 100)
    put("0001/x.concat.summTable.txt", 9)
    assert both("s", 2)["U"] == 105
    put("0001/s.summTable.txt", 1000)
    put("0002/one.summTable.txt", 20)
    put("0002/two.summTable.txt", 30)
    assert both("s", 2)["U"] == 1005
    put("0002/s.summTable.txt", 4)
    put("0003/a.summTable.txt", 6)
    put("0003/b.summTable.txt", 0)
    assert both("s", 2)["U"] == 1009
    assert both("two", 2)["U"] == 30
    assert _numbers(spark, f"{tmp_path}/sums", "upto") == [1]


def test_chunk_discovery(spark, tmp_path):
    def put(name, text="x"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)

    put("0000/s.summTable.txt")
    put("0000/a.summTable.txt")
    put("0001/a.summTable.txt")
    put("0001/a.concat.summTable.txt")
    put("0002/a.summTable.txt")
    put("0002/b.summTable.txt")
    put("0003/s.summTable.txt", "")
    put("junk/s.summTable.txt")
    found = tables.chunk_table_paths(spark, str(tmp_path), "s")
    assert ["/".join(p.split("/")[-2:]) for p in found] == ["0000/s.summTable.txt", "0001/a.summTable.txt"]


def test_paired_chunks(spark, tmp_path):
    for name, text in (("R10000.fastq", "x"), ("R20000.fastq", "x"), ("R10001.fastq.gz", "x"), ("R20001.fastq.gz", ""),
                       ("R10010.fastq", "x"), ("R20010.fastq", "x"), ("R20011.fastq", "x")):
        (tmp_path / f"shuffled.{name}").write_text(text)
    assert tables.paired_chunks(spark, str(tmp_path)) == ["0000", "0010"]


def test_text_sinks(spark, run, tmp_path):
    def lines(name):
        folder = tmp_path / name
        return [line.rstrip("\n") for f in sorted(os.listdir(folder)) if f.endswith(".csv") for line in open(folder / f)]

    sinks.write_changed(run.changed, run.config, str(tmp_path / "changed"), one_file=True)
    changed = lines("changed")
    assert changed[0].split("\t") == ["original_BC", *[f"V{i}" for i in range(2, 13)], "whitelist", "replaced_BC"]
    assert len(changed) == run.changed.count() + 1
    sinks.write_representatives(run.representatives, run.config, str(tmp_path / "reps"), one_file=True)
    assert lines("reps")[0].split("\t") == ["V1", "V2", "V3", "V4", "V5", "mismatch.WT", "mismatch.MUT", "V8", "V9", "V10",
        "BQ.in.WT", "BQ.in.MUT", "whitelist", "BARCODE_UMI", "mismatch.call", "WT.inDups", "MUT.inDups", "amb.inDups"]
    sinks.write_merge_table(run.merged, str(tmp_path / "merged"), one_file=True)
    assert len(lines("merged")) == run.merged.count() + 1 and len(lines("merged")[0].split("\t")) == 16
    empty = spark.createDataFrame([("b", "", "", "", "", "", 0, 0, 0)],
        "bc string, umi string, n_wt string, n_mut string, n_amb string, call string, wt_calls int, mut_calls int, amb_calls int")
    sinks.write_cells(empty, str(tmp_path / "cells"), one_file=True)
    assert lines("cells")[1] == "b" + "\t" * 6 + "0\t0\t0"


def test_chunk_sinks(spark, sf_dir, tmp_path):
    reads = store(fixture.reads(spark, sf_dir).filter("read_id < 100").withColumn("header_r1", F.concat(F.lit("@r"), "read_id")))
    assigned = store(chunks.assign_chunks(reads, 40))
    sinks.write_chunks(assigned, str(tmp_path / "parquet"))
    sizes = {r.chunk_id: r["count"] for r in spark.read.parquet(str(tmp_path / "parquet")).groupBy("chunk_id").count().collect()}
    assert sizes == {0: 51, 1: 49}
    sinks.write_fastq_chunks(assigned, str(tmp_path / "fastq"), 1)
    assert spark.read.text(str(tmp_path / "fastq")).count() == 400
    sinks.write_fastq_chunks(assigned.filter("chunk_id = 0"), str(tmp_path / "half"), 1)
    with pytest.raises(ValueError, match="different chunks"):
        fastq.read_fastq_chunks(spark, str(tmp_path / "fastq"), str(tmp_path / "half"))
    assert chunks.assign_chunks(reads, 40).filter("chunk_id < 1").count() == 51


def test_total_dups_as_call(run):
    merged = dedup.merge_table(run.representatives, run.config, total_dups_as_call=True)
    assert merged.filter("call <> cast(n_wt + n_mut + n_amb AS string)").isEmpty()


def test_repeated_average(spark, sf_dir):
    scored = regions.looked(fixture.reads(spark, sf_dir).limit(50), fixture.CIRC, Params())
    assert regions.looked_table(scored, fixture.CIRC, repeat_rv_wt=True).filter("avg_err_rv_mut <> avg_err_rv_wt").isEmpty()


def test_cells_of_an_empty_run(run):
    nothing = store(run.merged.filter("false"))
    assert cells.cell_summary(nothing, run.config).isEmpty()


def test_fastq_of_a_chunk_takes_millions_together(spark, tmp_path, monkeypatch):
    """Chunks of a few ids each out of many millions have one file; a large chunk has a file per million reads or so, in order."""
    monkeypatch.setattr(sinks, "FILE_READS", 10)
    rows = [(k, k % 3) for k in range(0, 300, 11)] + [(k, 7) for k in range(0, 50, 2)] + [(4, 7)]
    reads = spark.createDataFrame([(k, c, f"@r{k}/1", "ACGT", "IIII") for k, c in rows], "read_id bigint, chunk_id int, header_r1 string, seq_r1 string, qual_r1 string")
    reads = store(reads.withColumns({f"{c}_r2": F.col(f"{c}_r1") for c in ("header", "seq", "qual")}))
    for mate in (1, 2):
        sinks.write_fastq_chunks(reads, f"{tmp_path}/r{mate}", mate)
    files = fastq.chunk_files(spark, f"{tmp_path}/r1")
    assert sorted(files) == [(0, 0), (1, 0), (2, 0), (7, 0), (7, 1), (7, 2)]
    back = fastq.read_fastq_chunks(spark, f"{tmp_path}/r1", f"{tmp_path}/r2").orderBy("chunk_id", "read_id").collect()
    assert [(r.chunk_id, r.header_r1, r.header_r2) for r in back] == [(c, f"@r{k}/1", f"@r{k}/1") for c, k in sorted((c, k) for k, c in rows)]
    layout = {(r.chunk_id, r.million): (r.block, r.first) for r in sinks.fastq_layout(reads).collect()}
    assert [layout[7, m] for m in range(5)] == [(0, 0), (0, 6), (1, 0), (1, 5), (2, 0)] and layout[0, 29] == (0, 9)


def test_small_files_share_a_task(spark, rows, tmp_path):
    """Hundreds of small pairs of files are read by a few tasks, in lockstep, by ranges and when they are compressed."""
    folders = [f"{tmp_path}/r{mate}" for mate in (1, 2)]
    for folder in folders:
        for k in range(150):
            os.makedirs(f"{folder}/chunk_id={k}/block=0")
            with open(f"{folder}/chunk_id={k}/block=0/a.txt", "w") as f:
                f.write("".join(f"@r{k}_{n}\nACGT\n+\nIIII\n" for n in range(300)))
    cores = spark.sparkContext.defaultParallelism
    for split_bytes in (256 << 20, 1 << 12):
        reads = fastq.read_fastq_chunks(spark, *folders, split_bytes=split_bytes)
        assert reads.rdd.getNumPartitions() <= 6 * cores
        got = sorted((r.chunk_id, r.read_id - (r.file_id << 40), r.header_r1) for r in reads.collect())
        assert got == [(k, n, f"@r{k}_{n}") for k in range(150) for n in range(300)]
