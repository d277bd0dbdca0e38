"""The same results as plain SQL over ``events``, for a second engine to check the queries with."""

from __future__ import annotations

from cellamp.config import RegionConfig
from cellamp.functions.phred import P_ERR_1E5
from cellamp.plans.fixture import CIRC, DAMAGED_SQL, LINEAR, READS_SQL, WHITELIST_SQL
from cellamp.plans.queries import CHUNK_TARGET

_RATIO = 0.2
_P_ERR = "[" + ",".join(map(str, P_ERR_1E5)) + "]"


def _err(text: str) -> str:
    return (
        f"CAST(list_sum(list_transform(string_split({text},''), lambda c: CASE WHEN ascii(c) BETWEEN 33 AND 74 "
        f"THEN {_P_ERR}[ascii(c)-32] ELSE 0 END)) AS BIGINT)"
    )


def _mm(start: str, ref: str) -> str:
    n = len(ref)
    return f"CAST(hamming(rpad(substr(seq_r2,{start},{n}),{n},'~'),'{ref}') AS BIGINT)"


def _avg(name: str, length: str) -> str:
    return f"round(CAST({name} AS DOUBLE)/100000/{length},9)"


_Q_AT = "CASE WHEN ascii(substr(bc_qual,pos+1,1)) BETWEEN 33 AND 74 THEN ascii(substr(bc_qual,pos+1,1))-33 ELSE 0 END"
_Q_SUM = "CAST(list_sum(list_transform(string_split(bc_qual,''), lambda c: ascii(c)-33)) AS BIGINT)"
_BC_Q = "array_to_string(list_transform(string_split(bc_qual,''), lambda c: CAST(ascii(c)-33 AS VARCHAR)),';')||';'"

READS = f"reads AS ({READS_SQL})"
DAMAGED = f"intact AS ({READS_SQL}), reads AS ({DAMAGED_SQL.replace('FROM reads', 'FROM intact')})"
WL = f"wl AS (SELECT bc, row_number() OVER (ORDER BY bc)-1 AS wl_idx FROM ({WHITELIST_SQL}) y0)"


def _scan(config: RegionConfig, extra: str = "") -> str:
    """CTEs fields, tried, shifted, scan over ``reads``."""
    primer, rest = config["primer"], config.regions[1:]
    allowed = config.allowance("primer", _RATIO)
    tries = ", ".join(f"{_mm(str(primer.start + s), primer.seq)} AS m{s}" for s in range(4))
    shift = " ".join(f"WHEN m{s}<={allowed} THEN {s}" for s in range(4))
    best = " ".join(f"WHEN m{s}<={allowed} THEN m{s}" for s in range(4))
    mms = ", ".join(f"{_mm(f'{r.start}+shift', r.seq)} AS mm_{r.name}" for r in rest)
    span = "coalesce({}, 0)"
    errs = ", ".join(
        span.format(_err(f"substr(qual_r2,{r.start}+shift,{r.end - r.start + 1})")) + f" AS err_{r.name}" for r in rest
    )
    return f"""fields AS (SELECT read_id{extra}, substr(seq_r1,1,16) AS bc, substr(qual_r1,1,16) AS bc_qual, substr(seq_r1,17,12) AS umi, seq_r2, qual_r2 FROM reads),
tried AS (SELECT *, {tries} FROM fields),
shifted AS (SELECT *, CAST(CASE {shift} ELSE 0 END AS BIGINT) AS shift, CAST(CASE {best} ELSE {len(primer.seq)} END AS BIGINT) AS mm_primer FROM tried),
scan AS (SELECT read_id{extra}, bc, bc_qual, umi, shift, mm_primer, {mms}, CAST(length(seq_r2) AS BIGINT) AS r2_len, coalesce({_err('qual_r2')},0) AS err_r2,
 coalesce({_err(f'substr(qual_r2,1,{len(primer.seq)})')},0) AS err_primer, {errs} FROM shifted)"""


def _primed(config: RegionConfig, extra: str = "") -> str:
    keep = f"mm_primer<={config.allowance('primer', _RATIO)} AND mm_shared<={config.allowance('shared', _RATIO)}"
    if config.mode == "circ":
        keep += " AND (mm_fw_wt<=0 OR mm_fw_mut<=0) AND (mm_rv_wt<=0 OR mm_rv_mut<=0)"
    return f"{_scan(config, extra)},\nprimed AS (SELECT * FROM scan WHERE r2_len>0 AND err_r2>0 AND err_shared>0 AND {keep})"


_PLACE = "list_position(list_transform(range(1,17), lambda i: substr(o.bc,i,1)<>substr(w.bc,i,1)),true)-1"


def _rescue(chunk: str = "") -> str:
    """CTEs obs .. re over primed and wl; ``chunk`` is an optional key column."""
    k = f"{chunk}, " if chunk else ""
    on = f" AND prior.{chunk}=nd.{chunk}" if chunk else ""
    return f"""obs AS (SELECT DISTINCT bc FROM primed ANTI JOIN wl USING (bc)),
cand AS (SELECT o.bc AS obs, w.bc, w.wl_idx, {_PLACE} AS pos FROM obs o, wl w WHERE hamming(o.bc,w.bc)=1),
prior AS (SELECT {k}bc, count(*) AS n FROM primed SEMI JOIN wl USING (bc) GROUP BY ALL),
nd AS (SELECT * FROM primed ANTI JOIN wl USING (bc)),
sc AS (SELECT nd.read_id, nd.bc AS obs, cand.bc, wl_idx, coalesce(n,0) AS n, CASE WHEN coalesce(n,0)=0 THEN 0 ELSE least(33,{_Q_AT}) END AS qv
 FROM nd JOIN cand ON nd.bc=cand.obs LEFT JOIN prior ON prior.bc=cand.bc{on}),
pr AS (SELECT *, CASE WHEN sum(n) OVER (PARTITION BY read_id)>0 THEN CAST(n AS DOUBLE)/CAST(sum(n) OVER (PARTITION BY read_id) AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prior_p,
 pow(CAST(10 AS DOUBLE),-(CAST(qv AS DOUBLE)/10)) AS p_edit FROM sc),
li AS (SELECT *, prior_p*p_edit AS likelihood FROM pr),
po AS (SELECT *, CASE WHEN sum(likelihood) OVER (PARTITION BY read_id ORDER BY wl_idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)>0
 THEN likelihood/sum(likelihood) OVER (PARTITION BY read_id ORDER BY wl_idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) ELSE CAST(0 AS DOUBLE) END AS posterior FROM li),
mx AS (SELECT *, max(posterior) OVER (PARTITION BY read_id) AS top, sum(n) OVER (PARTITION BY read_id) AS total FROM po),
dec AS (SELECT read_id, any_value(top) AS top, any_value(total) AS total, count(*) AS ties, arg_min(bc,wl_idx) AS best FROM mx WHERE posterior=top GROUP BY read_id),
changed AS (SELECT nd.*, CASE WHEN dec.read_id IS NULL THEN 'No_Hamm_1' WHEN total=0 AND ties>=2 THEN 'NO_in_SAVED' WHEN ties=2 AND abs(top-0.5)<1e-12 THEN 'Not_Sig'
 WHEN top>=0.99 THEN 'RESCUED' ELSE 'Not_Sig' END AS status, best FROM nd LEFT JOIN dec USING (read_id)),
re AS (SELECT *, 'Y' AS whitelist, 0 AS part FROM primed SEMI JOIN wl USING (bc)
 UNION ALL BY NAME SELECT * EXCLUDE (bc, status, best), best AS bc, 'N' AS whitelist, 1 AS part FROM changed WHERE status='RESCUED')"""


_CALL = "CASE WHEN mm_wt<=2 AND mm_mut>2 THEN 'WT' WHEN mm_mut<=2 AND mm_wt>2 THEN 'MUT' ELSE 'amb' END"


def _groups(chunk: str = "") -> str:
    k = f"{chunk}, " if chunk else ""
    w = f"PARTITION BY {k}bc, umi"
    return f"""called AS (SELECT *, {_CALL} AS call, {_Q_SUM} AS q_sum FROM re),
sized AS (SELECT *, count(*) FILTER (call='WT') OVER ({w}) AS n_wt, count(*) FILTER (call='MUT') OVER ({w}) AS n_mut, count(*) FILTER (call='amb') OVER ({w}) AS n_amb,
 count(*) OVER ({w}) AS total_dups, min(part) OVER ({w}) AS first_part,
 min(CASE WHEN part=0 THEN read_id END) OVER ({w}) AS first_listed, min(read_id) OVER ({w}) AS first_any FROM called),
reps AS (SELECT *, CASE WHEN first_part=0 THEN first_listed ELSE first_any END AS first_read FROM sized QUALIFY
 row_number() OVER ({w} ORDER BY CASE WHEN n_wt<n_mut AND call<>'MUT' THEN 1 ELSE 0 END, err_wt, -q_sum, part, read_id)=1)"""


_MERGE_AVG = ", ".join(
    [_avg("err_r2", "r2_len") + " AS avg_err_r2"]
    + [f"{_avg(f'err_{n}', str(len(CIRC[n].seq)))} AS avg_err_{n}" for n in ("primer", "shared", "wt", "mut")]
)


def _looked_avg(config: RegionConfig) -> str:
    parts = [_avg("err_r2", "r2_len") + " AS avg_err_r2"]
    return ", ".join(parts + [f"{_avg(f'err_{r.name}', str(len(r.seq)))} AS avg_err_{r.name}" for r in config.regions])


def _names(config: RegionConfig, prefix: str, skip: int = 0) -> str:
    return ", ".join(f"{prefix}_{r.name}" for r in config.regions[skip:])


def _pair_call(wt: str = "n_wt", mut: str = "n_mut") -> str:
    return (
        f"CASE WHEN {wt}+{mut}=0 THEN 'AMB' WHEN CAST({wt} AS DOUBLE)/({wt}+{mut})>CAST(0.75 AS DOUBLE) THEN 'WT' "
        f"WHEN CAST({mut} AS DOUBLE)/({wt}+{mut})>CAST(0.75 AS DOUBLE) THEN 'MUT' ELSE 'AMB' END"
    )


_PAIRS = f"""counts AS (SELECT bc, umi, count(*) FILTER (call='WT') AS n_wt, count(*) FILTER (call='MUT') AS n_mut, count(*) FILTER (call='amb') AS n_amb,
 count(*) AS total_dups, min(part) AS first_part, min(CASE WHEN part=0 THEN read_id END) AS first_listed, min(read_id) AS first_any FROM (SELECT *, {_CALL} AS call FROM re) z GROUP BY bc, umi),
pairs AS (SELECT bc, umi, n_wt, n_mut, n_amb, {_pair_call()} AS call, first_part, CASE WHEN first_part=0 THEN first_listed ELSE first_any END AS first_read FROM counts)"""

_BC_FIRST = """firsts AS (SELECT bc, CAST(min(first_part) AS BIGINT) AS first_part,
 coalesce(min(CASE WHEN first_part=0 THEN first_read END), min(first_read)) AS first_read FROM pairs GROUP BY bc)"""

_TARGET = f"""sized0 AS (SELECT count(*) AS total, count(*) % {CHUNK_TARGET} AS rest FROM base),
target AS (SELECT CASE WHEN rest<>0 AND rest*10<{CHUNK_TARGET}*9 THEN CASE WHEN total<{CHUNK_TARGET} THEN total ELSE {CHUNK_TARGET}+rest//(total//{CHUNK_TARGET})+1 END
 ELSE {CHUNK_TARGET} END AS size FROM sized0)"""
_CHUNKED = f"""base AS ({READS_SQL}), {_TARGET},
reads AS (SELECT base.*, CAST((row_number() OVER (ORDER BY md5('0_'||CAST(read_id AS VARCHAR)), read_id)-1)//size AS BIGINT) AS chunk_id FROM base, target)"""

# Edit distance of src to the best substring of dst, one pattern character per step.
_EDGE_DP = """ends AS (SELECT row_number() OVER () AS id, x.bc, x.umi AS src, y.umi AS dst FROM pairs x JOIN pairs y ON x.bc=y.bc AND x.umi<>y.umi),
dp(id,a,b,i,p) AS (SELECT id, src, dst, 0, list_transform(range(0,length(dst)+1), lambda j: 0) FROM ends
 UNION ALL SELECT id, a, b, i+1, list_transform(range(0,length(b)+1), lambda j: list_min(list_transform(range(0,j+1), lambda k:
  j-k+CASE WHEN k=0 THEN i+1 ELSE least(p[k+1]+1, p[k]+CASE WHEN substr(b,k,1)<>substr(a,i+1,1) THEN 1 ELSE 0 END) END))) FROM dp WHERE i<length(a)),
edges AS (SELECT ends.bc, ends.src, ends.dst FROM dp JOIN ends USING (id) WHERE i=length(a) AND list_min(p)<=floor(length(a)*CAST(0.2 AS DOUBLE)))"""

# UMIs of 8 to 14 bases.
_MIXED = """mixed AS (SELECT DISTINCT bc, substr(umi||reverse(umi), 1, 8+(ascii(substr(umi,1,1))+ascii(substr(umi,-1,1)))%7) AS umi FROM pairs)"""

# The collapse as a recursion over one row of lists per cell.
_COLLAPSE = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY bc ORDER BY umi) AS pos FROM pairs),
links AS (SELECT bc, src AS umi, dst FROM edges UNION ALL SELECT bc, umi, umi FROM pairs),
near AS (SELECT l.bc, l.umi, list(r.pos ORDER BY r.pos) AS hits FROM links l JOIN ranked r ON r.bc=l.bc AND r.umi=l.dst GROUP BY l.bc, l.umi),
nodes AS (SELECT r.bc, list(r.umi ORDER BY pos) AS umis, list(r.call ORDER BY pos) AS calls, list(hits ORDER BY pos) AS adj, list(n_wt ORDER BY pos) AS wt, list(n_mut ORDER BY pos) AS mut,
 list(n_amb ORDER BY pos) AS amb FROM ranked r JOIN near n ON n.bc=r.bc AND n.umi=r.umi GROUP BY r.bc),
st(bc,adj,act,wt,mut,amb,merged,rep,seen,fin) AS (
 SELECT bc, adj, range(1,len(adj)+1), wt, mut, amb, list_transform(adj, lambda x: false), CAST(NULL AS BIGINT), CAST([] AS BIGINT[]), false FROM nodes
 UNION ALL
 SELECT bc, adj,
  CASE WHEN stop THEN list_filter(act, lambda i: i=rep OR NOT list_contains(seen,i)) ELSE act END,
  CASE WHEN stop THEN list_transform(range(1,len(wt)+1), lambda i: CASE WHEN i=rep THEN CAST(list_sum(list_transform(seen, lambda k: wt[k])) AS BIGINT) ELSE wt[i] END) ELSE wt END,
  CASE WHEN stop THEN list_transform(range(1,len(wt)+1), lambda i: CASE WHEN i=rep THEN CAST(list_sum(list_transform(seen, lambda k: mut[k])) AS BIGINT) ELSE mut[i] END) ELSE mut END,
  CASE WHEN stop THEN list_transform(range(1,len(wt)+1), lambda i: CASE WHEN i=rep THEN CAST(list_sum(list_transform(seen, lambda k: amb[k])) AS BIGINT) ELSE amb[i] END) ELSE amb END,
  CASE WHEN stop THEN list_transform(range(1,len(wt)+1), lambda i: merged[i] OR i=rep) ELSE merged END,
  CASE WHEN rep IS NULL THEN act[list_position(deg, list_max(deg))] WHEN stop THEN NULL ELSE rep END,
  CASE WHEN rep IS NULL THEN list_intersect(adj[act[list_position(deg, list_max(deg))]], act) WHEN stop THEN CAST([] AS BIGINT[]) ELSE nxt END,
  rep IS NULL AND list_sum(deg) <= len(act)
 FROM (SELECT *, rep IS NOT NULL AND len(nxt)=len(seen) AS stop FROM (
   SELECT *, list_transform(act, lambda i: len(list_intersect(adj[i], act))) AS deg,
     list_distinct(list_intersect(flatten(list_transform(seen, lambda i: adj[i])), act)) AS nxt
   FROM st WHERE NOT fin) q1) q2),
left_over AS (SELECT bc, wt, mut, amb, merged, unnest(act) AS pos FROM st WHERE fin),
raw AS (SELECT l.bc, umis[pos] AS umi, l.wt[pos] AS n_wt, l.mut[pos] AS n_mut, l.amb[pos] AS n_amb, pos, CASE WHEN merged[pos] THEN NULL ELSE calls[pos] END AS old FROM left_over l JOIN nodes USING (bc)),
survivors AS (SELECT bc, umi, n_wt, n_mut, n_amb, pos, coalesce(old, CASE WHEN n_wt+n_mut=0 THEN 'AMB'
 WHEN CAST(greatest(n_wt,n_mut) AS DOUBLE)/(n_wt+n_mut)>CAST(0.75 AS DOUBLE) THEN CASE WHEN n_wt>n_mut THEN 'WT' ELSE 'MUT' END ELSE 'AMB' END) AS call FROM raw)"""


def _list(column: str, order: str, where: str = "") -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(string_agg({text}, ';' ORDER BY {order}){where}, '')"


_KEPT = " FILTER (n_wt+n_mut>=2)"
_CELLS = "cells AS (SELECT bc, part, " + ", ".join(
    f"{_list(c, '-(n_wt+n_mut+n_amb), pos', _KEPT)} AS {c}" for c in ("umi", "n_wt", "n_mut", "n_amb", "call")
) + ", " + ", ".join(
    f"any_value({c}_calls) AS {c}_calls" for c in ("wt", "mut", "amb")
) + " FROM (SELECT *, (row_number() OVER (PARTITION BY bc ORDER BY -(n_wt+n_mut+n_amb), pos)-1)//100000 AS part, " + ", ".join(
    f"count(*) FILTER (n_wt+n_mut>=2 AND call='{c}') OVER (PARTITION BY bc) AS {c.lower()}_calls" for c in ("WT", "MUT", "AMB")
) + " FROM survivors) z GROUP BY bc, part)"

_SUMMARY_FIELDS = [
    "whitelist", "umi", "n_wt", "n_mut", "n_amb", "call", "avg_err_r2", "avg_err_primer", "avg_err_shared",
    "avg_err_wt", "avg_err_mut", "mm_primer", "mm_shared", "mm_wt", "mm_mut",
]
_RAW_AVG = {
    f"avg_err_{n}": f"printf('%.15f', CAST(err_{n} AS DOUBLE)/100000/{'r2_len' if n == 'r2' else len(CIRC[n].seq)})"
    for n in ("r2", "primer", "shared", "wt", "mut")
}


def _summary(key: str, cut: int, max_packed: int = 100_000) -> str:
    own = f"OVER (PARTITION BY {key})"
    lists = ", ".join(
        f"{_list(_RAW_AVG.get(f, f), 'first_part, first_read')} AS {f}_list" for f in ["bc", *_SUMMARY_FIELDS]
    )
    return f"""summary AS (SELECT {key}, piece AS part, {lists}, any_value(wt_calls) AS wt_calls, any_value(mut_calls) AS mut_calls, any_value(amb_calls) AS amb_calls,
 any_value(cell_part) AS first_part, any_value(cell_read) AS first_read
 FROM (SELECT *, (row_number() OVER (PARTITION BY {key} ORDER BY first_part, first_read)-1)//{max_packed} AS piece, sum(n_wt+n_mut+n_amb) {own} AS cell_reads,
  count(*) FILTER (mm_wt<=2 AND mm_mut>2) {own} AS wt_calls, count(*) FILTER (mm_mut<=2) {own} AS mut_calls, count(*) FILTER (mm_wt>2 AND mm_mut>2) {own} AS amb_calls,
  CAST(min(first_part) {own} AS BIGINT) AS cell_part, coalesce(min(CASE WHEN first_part=0 THEN first_read END) {own}, min(first_read) {own}) AS cell_read FROM reps) z
 WHERE cell_reads>={cut} GROUP BY {key}, piece)"""


def _concat(max_packed: int) -> str:
    lists = ", ".join(f"{_list(c, 'umi')} AS {c}" for c in ("umi", "n_wt", "n_mut", "n_amb", "call"))
    return f"""SELECT bc, part, {lists}, any_value(first_part) AS first_part, any_value(first_read) AS first_read
FROM (SELECT pairs.bc, umi, n_wt, n_mut, n_amb, call, firsts.first_part, firsts.first_read,
 (row_number() OVER (PARTITION BY pairs.bc ORDER BY umi)-1)//{max_packed} AS part FROM pairs JOIN firsts USING (bc)) z GROUP BY bc, part"""


def _with(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


def _looked_file(config: RegionConfig) -> str:
    return (
        _with(READS, _scan(config))
        + f"SELECT row_number() OVER (ORDER BY read_id)-1 AS line, bc, bc_qual, umi, {_names(config, 'mm')}, {_looked_avg(config)} FROM scan WHERE r2_len>0 AND err_r2>0 AND err_shared>0"
    )


def oracles() -> dict[str, str]:
    linear, circ = _primed(LINEAR), _primed(CIRC)
    full = (READS, WL, linear, _rescue())
    pairs = (*full, _PAIRS)
    chunked = (_CHUNKED, WL, _primed(LINEAR, ", chunk_id"), _rescue("chunk_id"), _groups("chunk_id"))
    unpacked = """alive AS (SELECT chunk_id, bc FROM reps GROUP BY ALL HAVING sum(n_wt+n_mut+n_amb)>=2),
un AS (SELECT reps.*, row_number() OVER (PARTITION BY chunk_id, bc ORDER BY first_part, first_read)-1 AS pos FROM reps SEMI JOIN alive USING (chunk_id, bc))"""
    lev = "floor(length(x.umi)*CAST(0.2 AS DOUBLE))"
    merge_columns = f"bc, whitelist, umi, n_wt, n_mut, n_amb, call, {_MERGE_AVG}"
    first = "CAST(first_part AS BIGINT) AS first_part, first_read"
    chunk_pairs = (
        _with(*chunked, unpacked)
        + f"SELECT bc, umi, n_wt, n_mut, n_amb, {_pair_call()} AS call FROM (SELECT bc, umi, CAST(sum(n_wt) AS BIGINT) AS n_wt, CAST(sum(n_mut) AS BIGINT) AS n_mut, CAST(sum(n_amb) AS BIGINT) AS n_amb FROM un GROUP BY bc, umi) z"
    )
    fastq = _with(_CHUNKED) + """SELECT chunk_id, row_number() OVER (PARTITION BY chunk_id, read_id//1000000 ORDER BY read_id)-1 AS place,
 '@r'||read_id||'/1' AS header_r1, seq_r1, qual_r1, '@r'||read_id||'/2' AS header_r2, seq_r2, qual_r2 FROM reads"""
    return {
        "read_fields": _with(READS)
        + "SELECT read_id, substr(seq_r1,1,16) AS bc, substr(qual_r1,1,16) AS bc_qual, substr(seq_r1,17,12) AS umi FROM reads",
        "phred_decode": _with(READS, _scan(LINEAR))
        + f"SELECT read_id, {_BC_Q} AS bc_q, {_Q_SUM} AS bc_q_sum, err_r2 FROM scan",
        "primer_shift": _with(READS, _scan(LINEAR)) + "SELECT read_id, shift, mm_primer FROM scan",
        "region_mismatch": _with(READS, _scan(CIRC)) + f"SELECT read_id, {_names(CIRC, 'mm', 1)} FROM scan",
        "region_errors": _with(READS, _scan(CIRC)) + f"SELECT read_id, err_r2, {_names(CIRC, 'err')} FROM scan",
        "looked_linear": _with(READS, _scan(LINEAR))
        + f"SELECT read_id, bc, {_BC_Q} AS bc_q, umi, {_names(LINEAR, 'mm')}, {_looked_avg(LINEAR)} FROM scan WHERE r2_len>0 AND err_r2>0 AND err_shared>0",
        "looked_circ": _with(READS, _scan(CIRC))
        + f"SELECT read_id, bc, {_BC_Q} AS bc_q, umi, {_names(CIRC, 'mm')}, {_looked_avg(CIRC)} FROM scan WHERE r2_len>0 AND err_r2>0 AND err_shared>0",
        "primed_linear": _with(READS, linear) + f"SELECT read_id, bc, umi, {_names(LINEAR, 'mm')} FROM primed",
        "primed_circ": _with(READS, circ) + f"SELECT read_id, bc, umi, {_names(CIRC, 'mm')} FROM primed",
        "bad_reads": _with(DAMAGED, _scan(LINEAR))
        + "SELECT read_id, r2_len, mm_primer, mm_wt, err_r2, err_shared FROM scan WHERE r2_len=0 OR err_r2=0 OR err_shared=0",
        "read_counts": _with(DAMAGED, _scan(LINEAR))
        + "SELECT count(*) AS reads, count(*) FILTER (WHERE r2_len=0 OR err_r2=0 OR err_shared=0) AS bad_reads, "
        + "(SELECT CAST(sum(length(regexp_replace(qual_r1||qual_r2,'[!-J]','','g'))) AS BIGINT) FROM reads) AS unknown_symbols FROM scan",
        "whitelist_order": _with(WL) + "SELECT bc, wl_idx FROM wl",
        "whitelist_semi": _with(READS, WL, linear) + "SELECT read_id, bc FROM primed SEMI JOIN wl USING (bc)",
        "whitelist_anti": _with(READS, WL, linear) + "SELECT read_id, bc FROM primed ANTI JOIN wl USING (bc)",
        "hamming1_candidates": _with(*full) + "SELECT obs, bc, wl_idx, CAST(pos AS BIGINT) AS pos FROM cand",
        "hamming_k_join": _with(READS, WL, linear, "o AS (SELECT DISTINCT bc FROM primed)")
        + "SELECT o.bc AS obs, w.bc, CAST(hamming(o.bc,w.bc) AS BIGINT) AS distance FROM o, wl w WHERE hamming(o.bc,w.bc)<=2",
        "prior_counts": _with(*full) + "SELECT bc, n AS n_reads FROM prior",
        "rescue_posterior": _with(*full)
        + "SELECT read_id, obs AS original_bc, bc AS candidate, n AS n_reads, round(prior_p,9) AS prior, round(p_edit,9) AS p_edit, round(likelihood,9) AS likelihood, round(posterior,9) AS posterior FROM po",
        "rescue_status": _with(*full)
        + "SELECT read_id, bc, status, CASE WHEN status='RESCUED' THEN best END AS replaced_bc FROM changed",
        "mtx_re": _with(*full) + "SELECT read_id, bc, umi, whitelist, CAST(part AS BIGINT) AS part FROM re",
        "dup_counts": _with(*pairs) + "SELECT bc, umi, n_wt, n_mut, n_amb, total_dups FROM counts",
        "dedup_representative": _with(*full, _groups())
        + "SELECT bc||'_'||umi AS barcode_umi, read_id, whitelist, call, mm_wt, mm_mut, err_wt, err_mut, n_wt, n_mut, n_amb, total_dups FROM reps",
        "merge_table": _with(*full, _groups()) + f"SELECT {merge_columns}, {_names(LINEAR, 'mm')}, {first} FROM reps",
        "merge_table_circ": _with(READS, WL, circ, _rescue(), _groups())
        + f"SELECT {merge_columns}, {_names(CIRC, 'mm')}, {first} FROM reps",
        "cell_summary": _with(*full, _groups(), _summary("bc", 60)) + "SELECT * FROM summary",
        "cell_summary_parts": _with(*full, _groups(), _summary("bc", 1, 4)) + "SELECT * FROM summary",
        "unpack_explode": _with(*chunked, unpacked) + "SELECT bc, umi, n_wt, n_mut, n_amb, chunk_id, pos FROM un",
        "chunk_local_pairs": chunk_pairs,
        "chunk_table_files": chunk_pairs,
        "chunk_table_stream": chunk_pairs,
        "fastq_lockstep": fastq,
        "fastq_blocks": fastq,
        "fastq_block_gzip": fastq,
        "looked_file_linear": _looked_file(LINEAR),
        "looked_file_circ": _looked_file(CIRC),
        "whitelist_file": _with(WL) + "SELECT bc, wl_idx FROM wl",
        "changed_file": _with(*full)
        + f"SELECT bc, {_BC_Q} AS bc_q, umi, mm_primer, mm_mut, 'N' AS whitelist, CASE WHEN status='RESCUED' THEN best ELSE status END AS outcome FROM changed",
        "merge_file": _with(*full, _groups()) + f"SELECT {merge_columns}, {_names(LINEAR, 'mm')} FROM reps",
        "cells_file": _with(*pairs, _BC_FIRST)
        + f"SELECT bc, umi, n_wt, n_mut, n_amb FROM ({_concat(100_000)}) z",
        "pair_counts": _with(*pairs) + "SELECT bc, umi, n_wt, n_mut, n_amb, call FROM pairs",
        "pair_order": _with(*pairs, _BC_FIRST)
        + "SELECT pairs.bc, umi, n_wt, n_mut, n_amb, call, firsts.first_part, firsts.first_read FROM pairs JOIN firsts USING (bc)",
        "concat_cells": _with(*pairs, _BC_FIRST) + _concat(100_000),
        "concat_cells_parts": _with(*pairs, _BC_FIRST) + _concat(4),
        "chunk_assign": _with(_CHUNKED) + "SELECT read_id, chunk_id FROM reads",
        "umi_edges_levenshtein": _with(*pairs)
        + f"SELECT x.bc, x.umi AS src, y.umi AS dst FROM pairs x JOIN pairs y ON x.bc=y.bc AND x.umi<>y.umi WHERE levenshtein(x.umi,y.umi)<={lev}",
        "umi_edges_unanchored": _with(*pairs, _EDGE_DP, recursive=True) + "SELECT bc, src, dst FROM edges",
        "umi_edges_mixed": _with(*pairs, _MIXED, _EDGE_DP.replace("pairs", "mixed"), recursive=True) + "SELECT bc, src, dst FROM edges",
        "umi_degree": _with(*pairs, _EDGE_DP, recursive=True)
        + "SELECT p.bc, p.umi, count(dst)+1 AS degree FROM pairs p LEFT JOIN edges e ON e.bc=p.bc AND e.src=p.umi GROUP BY p.bc, p.umi",
        "collapsed_umis": _with(*pairs, _EDGE_DP, _COLLAPSE, recursive=True)
        + "SELECT bc, umi, n_wt, n_mut, n_amb, call FROM survivors",
        "collapsed_umis_joins": _with(*pairs, _EDGE_DP, _COLLAPSE, recursive=True)
        + "SELECT bc, umi, n_wt, n_mut, n_amb, call FROM survivors",
        "collapsed_cells": _with(*pairs, _EDGE_DP, _COLLAPSE, _CELLS, recursive=True) + "SELECT * FROM cells",
        "mutation_fraction": _with(*pairs, _EDGE_DP, _COLLAPSE, _CELLS, recursive=True)
        + "SELECT CASE WHEN wt_calls>0 AND mut_calls>0 THEN 'mixed' WHEN wt_calls>0 THEN 'WT' WHEN mut_calls>0 THEN 'MUT' ELSE 'none' END AS genotype, count(*) AS n_cells FROM (SELECT DISTINCT bc, wt_calls, mut_calls FROM cells) z GROUP BY 1",
    }
