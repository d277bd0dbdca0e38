"""The representative read by one number: plan, missing values, ties."""

import random

from pyspark.sql import functions as F

from cellamp.operators import dedup
from cellamp.plans import fixture

CONFIG = fixture.LINEAR


def _reads(spark, rows):
    numbers = ["r2_len", *(f"mm_{r.name}" for r in CONFIG.regions), "err_r2", *(f"err_{r.name}" for r in CONFIG.regions)]
    schema = "bc string, umi string, part int, read_id bigint, bc_qual string, whitelist string, " + ", ".join(
        f"{n} bigint" if n.startswith("err_") else f"{n} int" for n in numbers
    )
    return spark.createDataFrame([tuple(r.get(c) for c in [f.split()[0] for f in schema.split(", ")]) for r in rows], schema)


def _row(rng, read_id):
    row = {"bc": rng.choice("AC"), "umi": rng.choice("GT"), "part": rng.randrange(2), "read_id": read_id}
    row |= {"bc_qual": rng.choice(["II", "I5", "5I", "!!", None, ""]), "whitelist": rng.choice("YN"), "r2_len": rng.randrange(1, 300)}
    for region in CONFIG.regions:
        row[f"mm_{region.name}"] = rng.choice([0, len(region.seq)])
        row[f"err_{region.name}"] = rng.choice([0, 7, 100_000 * len(region.seq)])
    return row | {"err_wt": rng.choice([None, 0, 5, 5, 9]), "err_r2": rng.randrange(10**9)}


def _order(r):
    score = None if r["bc_qual"] is None else sum(ord(c) - 33 for c in r["bc_qual"])
    missing = -1 if r["err_wt"] is None else r["err_wt"]
    return missing, float("-inf") if score is None else -score, r["part"], r["read_id"]


def _call(r):
    wt, mut = (r[f"mm_{a}"] <= CONFIG.allowance("wt", 0.2) for a in ("wt", "mut"))
    return "WT" if wt and not mut else "MUT" if mut and not wt else "amb"


def test_winners_against_plain_loops(spark):
    rng = random.Random(9)
    # Ids up to the largest number, several groups of few and many reads, ties in all but the id.
    ids = [0, 2**63 - 1, 2**40, *rng.sample(range(10**6), 80)]
    rows = [_row(rng, i) for i in ids]
    groups = {}
    for r in rows:
        groups.setdefault((r["bc"], r["umi"]), []).append(r)
    got = dedup.representatives(_reads(spark, rows), CONFIG).collect()
    assert len(got) == len(groups)
    for g in got:
        group = groups[g.bc, g.umi]
        calls = [_call(r) for r in group]
        pool = [r for r in group if _call(r) == "MUT"] if calls.count("WT") < calls.count("MUT") else group
        best = min(pool, key=_order)
        for name in best:
            if name != "part":
                assert g[name] == best[name], name
        assert g.call == _call(best)
        first = min((r["part"], r["read_id"]) for r in group)
        assert tuple(g.first_seen) == first


def test_a_hash_aggregation_with_one_shuffle(spark, sf_dir, shared_runs):
    from cellamp.plans import queries

    run = queries._run(spark, sf_dir)
    stored = run.corrected.sparkSession.createDataFrame([], run.corrected.schema)
    plan = dedup.merge_table(dedup.group_winners(stored, CONFIG), CONFIG)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and plan.count("Exchange") == 1 and "HashAggregate" in plan


def test_no_reads(spark):
    assert dedup.representatives(_reads(spark, []).filter(F.lit(False)), CONFIG).isEmpty()
