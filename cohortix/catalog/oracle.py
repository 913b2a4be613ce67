"""SQL oracles: the registered queries written independently over the warehouse tables."""

from __future__ import annotations

from cohortix import schema as S
from cohortix.catalog import standins as P
from cohortix.plans.scoring import CASES

PAY = "average_data_usage, average_revenue, average_dou, pack_flag, aon, churn"
U, R, D = "average_data_usage", "average_revenue", "average_dou"
REST = "average_dou, pack_flag, aon, churn"
RATIOS = "revenue_per_gb, usage_intensity, revenue_per_active_day"
Z = ("z_average_data_usage", "z_average_revenue", "z_average_dou", "z_pack_flag")
FEATURES = ("average_data_usage", "average_revenue", "average_dou", "pack_flag")


def num(v: float) -> str:
    """A double literal."""
    return f"{float(v)!r}::DOUBLE"


def text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def case_of(col: str, values: dict) -> str:
    arms = " ".join(
        f"WHEN {text(k) if isinstance(k, str) else k} THEN {text(v)}" for k, v in values.items())
    return f"CASE {col} {arms} END"


# ---- the cleaning, step by step ---------------------------------------------
BASE = f"""
WITH hist AS (
  SELECT o_custkey,
         min(CASE WHEN o_orderdate < TIMESTAMP '1996-07-01' THEN o_orderdate END) AS first_order,
         max(CASE WHEN o_orderdate < TIMESTAMP '1996-07-01'
                   AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS urgent,
         max(CASE WHEN o_orderdate >= TIMESTAMP '1996-07-01'
                   AND o_orderdate < TIMESTAMP '1997-07-01' THEN 1 ELSE 0 END) AS later
  FROM orders GROUP BY o_custkey),
used AS (
  SELECT o_custkey, sum(l_quantity) AS q, count(DISTINCT CAST(l_shipdate AS DATE)) AS d
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  WHERE o_orderdate < TIMESTAMP '1996-07-01' GROUP BY o_custkey),
one AS (
  SELECT c_custkey AS customer_id,
         q / 1e1 * CASE WHEN c_custkey % 331 = 7 THEN 4e1 ELSE 1e0 END AS {U},
         c_acctbal AS {R}, CAST(coalesce(d, 0) AS DOUBLE) AS {D},
         coalesce(urgent, 0) AS pack_flag,
         date_diff('day', CAST(first_order AS DATE), DATE '1996-07-01') AS aon,
         1 - coalesce(later, 0) AS churn
  FROM customer LEFT JOIN hist ON c_custkey = hist.o_custkey
                LEFT JOIN used ON c_custkey = used.o_custkey),
raw AS (
  SELECT customer_id, {PAY} FROM one
  UNION ALL
  SELECT customer_id + 100000000, {PAY} FROM one WHERE customer_id % 200 = 0),
dedup AS (SELECT min(customer_id) AS customer_id, count(*) AS copies, {PAY} FROM raw GROUP BY {PAY}),
valid AS (
  SELECT customer_id, {U}, CASE WHEN {R} < 0 THEN 0e0 ELSE {R} END AS {R},
         CASE WHEN {D} < 0 THEN 0e0 WHEN {D} > 30 THEN 3e1 ELSE {D} END AS {D},
         pack_flag, aon, churn
  FROM dedup WHERE aon >= 90),
med AS (SELECT quantile_cont({U}, 0.5) AS mu, quantile_cont({R}, 0.5) AS mr FROM valid),
filled AS (
  SELECT customer_id, coalesce({U}, mu) AS {U}, coalesce({R}, mr) AS {R}, {REST} FROM valid, med),
quart AS (
  SELECT quantile_cont({U}, 0.25) AS u1, quantile_cont({U}, 0.75) AS u3,
         quantile_cont({R}, 0.25) AS r1, quantile_cont({R}, 0.75) AS r3 FROM filled),
fence AS (
  SELECT u1 - 3 * (u3 - u1) AS ul, u3 + 3 * (u3 - u1) AS uh,
         r1 - 3 * (r3 - r1) AS rl, r3 + 3 * (r3 - r1) AS rh FROM quart),
capped AS (
  SELECT customer_id, CASE WHEN {U} < ul THEN ul WHEN {U} > uh THEN uh ELSE {U} END AS {U},
         CASE WHEN {R} < rl THEN rl WHEN {R} > rh THEN rh ELSE {R} END AS {R}, {REST}
  FROM filled, fence),
ratio AS (
  SELECT *, {R} / ({U} + 1e-6) AS revenue_per_gb, {U} / ({D} + 1e-6) AS usage_intensity,
         {R} / ({D} + 1e-6) AS revenue_per_active_day,
         CASE WHEN {D} <= 5 THEN 1 ELSE 0 END AS is_dormant
  FROM capped),
rcap AS (
  SELECT quantile_cont(revenue_per_gb, 0.995) AS c1, quantile_cont(usage_intensity, 0.995) AS c2,
         quantile_cont(revenue_per_active_day, 0.995) AS c3 FROM ratio),
clean AS (
  SELECT customer_id, {PAY}, is_dormant,
         CASE WHEN revenue_per_gb > c1 THEN c1 ELSE revenue_per_gb END AS revenue_per_gb,
         CASE WHEN usage_intensity > c2 THEN c2 ELSE usage_intensity END AS usage_intensity,
         CASE WHEN revenue_per_active_day > c3 THEN c3 ELSE revenue_per_active_day END
           AS revenue_per_active_day
  FROM ratio, rcap)"""


# ---- stand-ins --------------------------------------------------------------
def linear(score: tuple) -> str:
    return " + ".join([num(score[0]), *[f"{num(w)} * {c}" for c, w in score[1].items()]])


def prob(score: tuple, extra: str = "") -> str:
    return f"round(1e0 / (1e0 + exp(-({linear(score)}{extra}))), 6)"


CLUSTER = (f"pack_flag * 3 + CASE WHEN {U} <= {num(P.USAGE_BANDS[0])} THEN 0 "
           f"WHEN {U} <= {num(P.USAGE_BANDS[1])} THEN 1 ELSE 2 END")
SCALE = ", ".join(f"({c} - {num(P.MEANS[c])}) / {num(P.STDS[c])} AS {z}" for c, z in zip(FEATURES, Z))


def standins(source: str) -> str:
    return f"""
SELECT *, {case_of('cluster', P.SEGMENT_OF_CLUSTER)} AS segment FROM (
  SELECT *, {CLUSTER} AS cluster, {prob(P.CHURN_SCORE)} AS churn_probability FROM {source})"""


LAB = f"{BASE},\nlab AS ({standins('clean')}),\nzed AS (SELECT *, {SCALE} FROM lab)"


def component_rows(source: str) -> str:
    """One row per input row and mixture component with its log joint density."""
    parts = []
    for j in range(P.MIXTURE.k):
        gaps = " + ".join(
            f"({z} - {num(m)}) * ({z} - {num(m)}) / {num(v)}"
            for z, m, v in zip(Z, P.CENTROIDS[j], P.VARIANCES[j]))
        logs = " + ".join(f"ln(2 * pi() * {num(v)})" for v in P.VARIANCES[j])
        parts.append(f"SELECT customer_id, {j} AS j, "
                     f"ln({num(P.WEIGHTS[j])}) - 0.5 * ({logs} + {gaps}) AS l FROM {source}")
    return " UNION ALL ".join(parts)


def mixture_ctes(source: str) -> str:
    return f"""
comp AS ({component_rows(source)}),
peak AS (SELECT customer_id, max(l) AS top FROM comp GROUP BY customer_id),
dens AS (SELECT customer_id, max(top) + ln(sum(exp(l - top))) AS ld
         FROM comp JOIN peak USING (customer_id) GROUP BY customer_id),
resp AS (SELECT customer_id, j, l, exp(l - ld) AS r,
                row_number() OVER (PARTITION BY customer_id ORDER BY l DESC, j) AS rk
         FROM comp JOIN dens USING (customer_id)),
soft AS (SELECT customer_id, max(CASE WHEN rk = 1 THEN j END) AS cluster_id,
                max(CASE WHEN rk = 1 THEN r END) AS confidence,
                max(CASE WHEN rk = 2 THEN j END) AS runner_up_id,
                max(CASE WHEN rk = 2 THEN r END) AS runner_up_confidence
         FROM resp GROUP BY customer_id)"""


MIX = f"{LAB},{mixture_ctes('zed')}"

_dist = [
    " + ".join(f"({z} - {num(v)}) * ({z} - {num(v)})" for z, v in zip(Z, centre))
    for centre in P.CENTROIDS
]
NEAR = f"""{LAB},
cand AS ({' UNION ALL '.join(
    f'SELECT customer_id, cluster, segment, {j} AS cluster_id, {d} AS squared_distance FROM zed'
    for j, d in enumerate(_dist))}),
near AS (SELECT * FROM cand
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY squared_distance, cluster_id) = 1)"""

# ---- curves -----------------------------------------------------------------
LADDER = f"""{LAB},
step AS (SELECT churn_probability AS score, sum(churn) AS pos, count(*) - sum(churn) AS neg
         FROM lab GROUP BY 1),
lad AS (SELECT score, pos, neg,
               sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
               row_number() OVER (ORDER BY score DESC) AS pt, count(*) OVER () AS pts,
               sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all,
               lead(pos) OVER (ORDER BY score DESC) AS npos,
               lead(neg) OVER (ORDER BY score DESC) AS nneg
        FROM step)"""

PR = f"""{LADDER},
pr0 AS (SELECT score, tp / (tp + fp) AS p, tp / p_all AS r, pts - pt AS position, pts FROM lad),
pr AS (SELECT score, p, r, position, pts,
              CASE WHEN p + r > 0 THEN 2 * p * r / (p + r + 1e-12) ELSE 0 END AS f FROM pr0)"""

PR_OUT = ("round(score, 6) AS threshold, round(p, 6) AS precision, round(r, 6) AS recall, "
          "round(f, 6) AS f1, CAST(position AS BIGINT) AS position")

ROC = f"""{LADDER},
kept AS (SELECT fp / n_all AS fpr, tp / p_all AS tpr, score FROM lad
         WHERE pt = 1 OR pt = pts OR npos <> pos OR nneg <> neg),
roc AS (SELECT fpr, tpr, score FROM kept UNION ALL SELECT 0e0, 0e0, NULL)"""

RATES = """
  (tp + tn) / (tp + fp + fn + tn) AS accuracy,
  coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(tn / nullif(tn + fp, 0), 0) AS specificity,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1"""

CONF = f"""{LAB},
cut AS (SELECT unnest([{', '.join(num(t) for t in P.CUTS)}]) AS threshold),
conf AS (
  SELECT threshold,
         count(*) FILTER (WHERE churn_probability >= threshold AND churn = 1) AS tp,
         count(*) FILTER (WHERE churn_probability >= threshold AND churn = 0) AS fp,
         count(*) FILTER (WHERE churn_probability < threshold AND churn = 1) AS fn,
         count(*) FILTER (WHERE churn_probability < threshold AND churn = 0) AS tn
  FROM lab, cut GROUP BY threshold)"""

CLASSES = f"""{NEAR},
pred AS (SELECT segment AS actual, {case_of('cluster_id', P.SEGMENT_OF_CLUSTER)} AS predicted FROM near),
lbl AS (SELECT actual AS label FROM pred UNION SELECT predicted FROM pred),
cls AS (
  SELECT label, (SELECT count(*) FROM pred WHERE actual = label) AS support,
         (SELECT count(*) FROM pred WHERE predicted = label) AS predicted,
         (SELECT count(*) FROM pred WHERE actual = label AND predicted = label) AS tp FROM lbl),
rep AS (
  SELECT *, coalesce(tp / nullif(predicted, 0), 0) AS precision,
         coalesce(tp / nullif(support, 0), 0) AS recall,
         coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f1 FROM cls)"""

# ---- sampling ---------------------------------------------------------------
KEY = f"md5('{S.SEED}:' || customer_id)"

GROUPED = f"""{LAB},
turn AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY {KEY}, customer_id) AS turn_no,
                count(*) OVER (PARTITION BY segment) AS n FROM lab),
grp AS (SELECT * EXCLUDE (turn_no, n),
               CASE WHEN turn_no <= greatest(CAST(round_even(n * 3e-2, 0) AS BIGINT), 1)
                    THEN 'UCG' ELSE 'UTG' END AS campaign_group FROM turn)"""

BOOK = "book AS (SELECT * FROM (VALUES {}) AS t(segment, offer, action, priority))".format(
    ", ".join("(" + ", ".join(map(text, (s, *o))) + ")" for s, o in S.OFFERS.items()))


def escalated(priority: str, risk: str) -> str:
    return (f"CASE WHEN {risk} >= 6e-1 AND {priority} = 'Medium' THEN 'High' "
            f"WHEN {risk} >= 6e-1 AND {priority} = 'Low' THEN 'Medium' ELSE {priority} END")


def balance_row(c: str) -> str:
    t = f"CAST({c} AS DOUBLE)) FILTER (WHERE campaign_group = 'UTG'"
    u = f"CAST({c} AS DOUBLE)) FILTER (WHERE campaign_group = 'UCG'"
    return (f"SELECT '{c}' AS feature, avg({t}) AS tm, avg({u}) AS um, "
            f"sqrt((var_samp({t}) + var_samp({u})) / 2) AS sd FROM grp")


BALANCE = f"""{GROUPED},
bal0 AS ({' UNION ALL '.join(balance_row(c) for c in S.BALANCE_COVARIATES)}),
bal AS (SELECT feature, tm, um, CASE WHEN sd > 0 THEN abs(tm - um) / sd ELSE 0 END AS smd FROM bal0)"""


# ---- cluster scores ---------------------------------------------------------
def score_ctes(points: str, label: str, dims: list[str], distance: str = "sqrt") -> str:
    """``points`` has i, the label and the dimension columns; ``squared`` distances are for the silhouette."""
    apart = " + ".join(f"(a.{x} - b.{x}) * (a.{x} - b.{x})" for x in dims)
    centre = ", ".join(f"avg({x}) AS {x}" for x in dims)
    overall = " + ".join(f"(c.{x} - g.{x}) * (c.{x} - g.{x})" for x in dims)
    return f"""
pt AS ({points}),
pair AS (SELECT a.i, a.{label} AS own, b.{label} AS other, sum({'sqrt' if distance == 'sqrt' else ''}({apart})) AS s, count(*) AS n
         FROM pt a, pt b GROUP BY ALL),
sil AS (SELECT i, max(CASE WHEN own = other THEN CASE WHEN n > 1 THEN s / (n - 1) END END) AS a,
               min(CASE WHEN own <> other THEN s / n END) AS b FROM pair GROUP BY i),
ctr AS (SELECT {label}, count(*) AS n, {centre} FROM pt GROUP BY {label}),
gap AS (SELECT a.{label}, sqrt({apart}) AS d FROM pt a JOIN ctr b USING ({label})),
spr AS (SELECT {label}, avg(d) AS s, sum(d * d) AS w FROM gap GROUP BY {label}),
ratio_of AS (SELECT a.{label} AS ka, max((sa.s + sb.s) / sqrt({apart})) AS worst
             FROM ctr a JOIN ctr b ON a.{label} <> b.{label}
             JOIN spr sa ON sa.{label} = a.{label} JOIN spr sb ON sb.{label} = b.{label} GROUP BY 1),
mid AS (SELECT {centre} FROM pt),
chi AS (SELECT (SELECT sum(c.n * ({overall})) FROM ctr c, mid g) AS between_ss,
               (SELECT sum(w) FROM spr) AS within_ss,
               (SELECT count(*) FROM ctr) AS k, (SELECT count(*) FROM pt) AS n)"""


SILHOUETTE = "(SELECT avg(CASE WHEN a IS NULL THEN 0 WHEN greatest(a, b) = 0 THEN 0 " \
             "ELSE (b - a) / greatest(a, b) END) FROM sil)"
DAVIES = "(SELECT avg(worst) FROM ratio_of)"
CALINSKI = "(SELECT between_ss * (n - k) / (within_ss * (k - 1)) FROM chi)"
POINTS = (f"SELECT customer_id AS i, cluster, {', '.join(Z)} FROM zed "
          f"ORDER BY {KEY}, customer_id LIMIT {S.SCORE_SAMPLE}")
SCORED = f"{LAB},{score_ctes(POINTS, 'cluster', list(Z))}"
ALL_POINTS = f"SELECT customer_id AS i, cluster, {', '.join(Z)} FROM zed"
ALL_SCORED = f"{LAB},{score_ctes(ALL_POINTS, 'cluster', list(Z))}"
SQUARED = f"{LAB},{score_ctes(ALL_POINTS, 'cluster', list(Z), 'squared')}"
EMB = [f"x{i}" for i in range(64)]
EMB_POINTS = "SELECT vec_id AS i, label, {} FROM embeddings".format(
    ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {x}" for i, x in enumerate(EMB)))


# ---- scoring ----------------------------------------------------------------
def prepared(source: str, fill: bool) -> str:
    fu, fr = P.FENCES[U], P.FENCES[R]
    mu = f"coalesce({U}, {num(P.MEDIANS[U])})" if fill else U
    mr = f"coalesce({R}, {num(P.MEDIANS[R])})" if fill else R
    caps = {c: num(v) for c, v in P.RATIO_CAPS.items()}

    def cap(c: str, e: str) -> str:
        return f"CASE WHEN {e} > {caps[c]} THEN {caps[c]} ELSE {e} END AS {c}" if fill else f"{e} AS {c}"

    return f"""
SELECT customer_id, {U}, {R}, {D}, pack_flag, aon, churn,
       {cap('revenue_per_gb', f'{R} / ({U} + 1e-6)')},
       {cap('usage_intensity', f'{U} / ({D} + 1e-6)')},
       {cap('revenue_per_active_day', f'{R} / ({D} + 1e-6)')},
       CASE WHEN {D} <= 5 THEN 1 ELSE 0 END AS is_dormant
FROM (SELECT customer_id,
       CASE WHEN {mu} < {num(fu.low)} THEN {num(fu.low)} WHEN {mu} > {num(fu.high)} THEN {num(fu.high)}
            ELSE {mu} END AS {U},
       CASE WHEN {mr} > {num(fr.high)} THEN {num(fr.high)} WHEN {mr} < 0 THEN 0e0 ELSE {mr} END AS {R},
       CASE WHEN {D} > 30 THEN 3e1 WHEN {D} < 0 THEN 0e0 ELSE {D} END AS {D}, pack_flag, aon, churn
      FROM {source})"""


BAND = ("CASE WHEN p > -0.01 AND p <= 0.25 THEN 'Low' WHEN p <= 0.5 THEN 'Moderate' "
        "WHEN p <= 0.75 THEN 'High' WHEN p <= 1.01 THEN 'Critical' END")
GATED = {c: f"CASE WHEN coalesce(aon >= 90, false) THEN {{}} ELSE {text(v)} END"
         for c, v in zip(("segment", "offer", "action"), S.UNSEGMENTED)}

_shift = " + CASE segment " + " ".join(
    f"WHEN {text(s)} THEN {num(w)}" for s, w in P.SEGMENT_SHIFT.items()) + " ELSE 0 END"
SCORE_BATCH = f"""{BASE},
prep AS ({prepared('raw', True)}),
zprep AS (SELECT *, {SCALE} FROM prep),{mixture_ctes('zprep')},
named AS (SELECT prep.*, soft.* EXCLUDE (customer_id),
                 {case_of('cluster_id', P.SEGMENT_OF_CLUSTER)} AS segment,
                 {case_of('runner_up_id', P.SEGMENT_OF_CLUSTER)} AS runner_up_segment
          FROM prep JOIN soft USING (customer_id)),
risky AS (SELECT *, {prob(P.CHURN_SCORE, _shift)} AS p FROM named),
{BOOK}
SELECT customer_id, cluster_id, {GATED['segment'].format('risky.segment')} AS segment,
       round(confidence, 6) AS segment_confidence, runner_up_segment,
       round(runner_up_confidence, 6) AS runner_up_confidence, p AS churn_probability,
       CASE WHEN p >= {num(P.THRESHOLD)} THEN 1 WHEN p < {num(P.THRESHOLD)} THEN 0 END AS churn_prediction,
       {BAND} AS risk_band, {GATED['offer'].format('offer')} AS offer,
       {GATED['action'].format('action')} AS action,
       CASE WHEN coalesce(aon >= 90, false) THEN {escalated('priority', 'p')} END AS priority
FROM risky JOIN book ON book.segment = risky.segment"""


def r(digits: int, *cols: str) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


def all_oracles() -> dict[str, str]:
    big = "CAST({} AS BIGINT) AS {}"
    out = {
        "typed_load": f"""{BASE} SELECT customer_id,
            {', '.join(f'round(CAST(CAST({c} AS REAL) AS DOUBLE), 4) AS {c}' for c in (U, R, D))},
            CAST(pack_flag AS INTEGER) AS pack_flag, CAST(aon AS INTEGER) AS aon,
            CAST(churn AS INTEGER) AS churn FROM raw""",
        "renamed_csv": f"{BASE} SELECT customer_id, {r(4, U, R)}, {REST} FROM raw",
        "learn_medians": f"""{BASE} SELECT '{U}' AS feature, round(mu, 4) AS value FROM med
            UNION ALL SELECT '{R}', round(mr, 4) FROM med""",
        "quantile_search": BASE + " UNION ALL ".join(
            f" SELECT '{c}' AS feature, {num(q)} AS q, round(quantile_cont({c}, {q}), 4) AS value FROM clean"
            for c in FEATURES for q in (0.005, 0.25, 0.5, 0.75, 0.995)),
        "holdout_by_cells": f"{GROUPED} SELECT customer_id, segment, campaign_group FROM grp",
        "segment_levels": f"{LAB} SELECT DISTINCT segment FROM lab",
        "quality_profile": f"""{BASE} SELECT count(*) AS rows_in,
            {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS null_{c}' for c in S.PAYLOAD)},
            count(*) FILTER (WHERE {R} < 0) AS negative_revenue,
            count(*) - (SELECT count(*) FROM (SELECT DISTINCT {R}, {D}, aon FROM raw)) AS duplicate_rows,
            count(*) FILTER (WHERE churn NOT IN (0, 1)) AS label_not_binary,
            round(avg(churn), 6) AS base_rate,
            avg(churn) BETWEEN 0.10 AND 0.50 AS base_rate_plausible FROM raw""",
        "dedupe_payload": f"{BASE} SELECT customer_id, {r(4, U, R)}, {REST} FROM dedup",
        "tenure_filter": f"{BASE} SELECT customer_id, aon FROM raw WHERE aon >= 90",
        "floor_negative": f"{BASE} SELECT customer_id, round(CASE WHEN {R} < 0 THEN 0 ELSE {R} END, 4) AS {R} FROM raw",
        "clip_days": f"{BASE} SELECT customer_id, CASE WHEN {D} > 30 THEN 3e1 ELSE {D} END AS {D} FROM raw",
        "impute_median": f"{BASE} SELECT customer_id, {r(4, U, R)} FROM filled",
        "cleaning_audit": f"""{BASE} SELECT CAST(sum(copies) AS BIGINT) AS rows_in,
            CAST(sum(copies - 1) AS BIGINT) AS dropped_duplicates,
            count(*) FILTER (WHERE aon IS NULL OR aon < 90) AS dropped_by_aon_filter,
            count(*) FILTER (WHERE aon >= 90 AND {R} < 0) AS negative_revenue_floored,
            count(*) FILTER (WHERE aon >= 90 AND ({D} < 0 OR {D} > 30)) AS dou_clipped_to_0_30,
            count(*) FILTER (WHERE aon >= 90 AND {U} IS NULL) AS imputed_{U},
            count(*) FILTER (WHERE aon >= 90 AND {R} IS NULL) AS imputed_{R},
            count(*) FILTER (WHERE aon >= 90) AS rows_out FROM dedup""",
        "clean_violations": f"""{BASE} SELECT
            count(*) FILTER (WHERE aon IS NULL OR aon < 90) AS short_tenure,
            {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS missing_{c}' for c in FEATURES)},
            count(*) FILTER (WHERE {R} < 0) AS negative_revenue,
            count(*) FILTER (WHERE {D} NOT BETWEEN 0 AND 30) AS dou_out_of_range,
            count(*) FILTER (WHERE {U} > uh + 1e-6 OR {U} < ul - 1e-6) AS outside_{U},
            count(*) FILTER (WHERE {R} > rh + 1e-6 OR {R} < rl - 1e-6) AS outside_{R},
            {', '.join(f'count(*) FILTER (WHERE {c} IS NULL OR NOT isfinite({c})) AS not_finite_{c}' for c in S.RATIOS)}
            FROM clean, fence""",
        "learn_fences": f"""{BASE}
            SELECT '{U}' AS feature, round(max(ul), 4) AS low, round(max(uh), 4) AS high,
                   count(*) FILTER (WHERE {U} < ul OR {U} > uh) AS n_capped FROM filled, fence
            UNION ALL
            SELECT '{R}', round(max(rl), 4), round(max(rh), 4),
                   count(*) FILTER (WHERE {R} < rl OR {R} > rh) FROM filled, fence""",
        "apply_fences": f"{BASE} SELECT customer_id, {r(4, U, R)} FROM capped",
        "ratio_features": f"{BASE} SELECT customer_id, {r(3, *S.RATIOS)} FROM ratio",
        "dormant_flag": f"{BASE} SELECT customer_id, is_dormant FROM clean",
        "cap_ratio_tail": f"{BASE} SELECT customer_id, {r(3, *S.RATIOS)} FROM clean",
        "learn_ratio_caps": f"""{BASE} SELECT 'revenue_per_gb' AS feature, round(c1, 2) AS value FROM rcap
            UNION ALL SELECT 'usage_intensity', round(c2, 2) FROM rcap
            UNION ALL SELECT 'revenue_per_active_day', round(c3, 2) FROM rcap""",
        "learn_scaler": BASE + " UNION ALL ".join(
            f" SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM clean"
            for c in FEATURES),
        "standardise": f"""{BASE}, st AS (SELECT {', '.join(
            f'avg({c}) AS m{i}, stddev_pop({c}) AS s{i}' for i, c in enumerate(FEATURES))} FROM clean)
            SELECT customer_id, {', '.join(
            f'round(({c} - m{i}) / s{i}, 6) AS {z}' for i, (c, z) in enumerate(zip(FEATURES, Z)))} FROM clean, st""",
        "feature_matrix": f"""{LAB}, cw AS (SELECT churn, count(*) AS nc, sum(count(*)) OVER () AS n,
                count(*) OVER () AS classes FROM lab GROUP BY churn)
            SELECT customer_id, lab.churn, {D}, pack_flag, aon, is_dormant,
            {', '.join(f'CASE WHEN segment = {text(s)} THEN 1 ELSE 0 END AS "seg_{s}"' for s in sorted(S.OFFERS))},
            {r(4, U, R)}, {r(3, *S.RATIOS)}, round(n / (classes * nc), 6) AS class_weight
            FROM lab JOIN cw ON cw.churn = lab.churn""",
        "cluster_profile_named": f"""{LAB}, g AS (SELECT cluster, {', '.join(f'avg({c}) AS {c}' for c in FEATURES)},
                avg(aon) AS aon, count(*) AS n_customers FROM lab GROUP BY cluster),
            k AS (SELECT *, 100 * n_customers / sum(n_customers) OVER () AS pct_of_base,
                row_number() OVER (ORDER BY {R} DESC, cluster) AS revenue_rank FROM g)
            SELECT cluster, {r(4, *FEATURES, 'aon')}, n_customers, {r(4, 'pct_of_base')}, revenue_rank,
            {case_of('revenue_rank', S.SEGMENT_BY_RANK)} AS segment FROM k""",
        "segment_lookup": f"""{LAB}, g AS (SELECT cluster, row_number() OVER (ORDER BY avg({R}) DESC, cluster) AS rk
                FROM lab GROUP BY cluster)
            SELECT customer_id, lab.cluster, {case_of('rk', S.SEGMENT_BY_RANK)} AS segment
            FROM lab JOIN g ON g.cluster = lab.cluster""",
        "label_purity": f"""{NEAR}, cell AS (SELECT cluster, cluster_id, count(*) AS n FROM near GROUP BY 1, 2)
            SELECT round(sum(top) / sum(n), 6) AS agreement
            FROM (SELECT max(n) AS top, sum(n) AS n FROM cell GROUP BY cluster)""",
        "elbow_k": f"""{BASE}, b AS (SELECT k, least(floor({U} * k / 110e0), k - 1) AS band, {U} AS x
                FROM clean, range(2, 11) AS t(k)),
            m AS (SELECT *, avg(x) OVER (PARTITION BY k, band) AS mean FROM b),
            sw AS (SELECT k, sum((x - mean) * (x - mean)) AS y FROM m GROUP BY k),
            e AS (SELECT min(k) AS k0, max(k) AS k1, arg_min(y, k) AS y0, arg_max(y, k) AS y1 FROM sw)
            SELECT CAST(arg_max(k, abs((k1 - k0) * (y - y0) - (y1 - y0) * (k - k0))
              / sqrt((k1 - k0) * (k1 - k0) + (y1 - y0) * (y1 - y0))) AS INTEGER) AS elbow_k FROM sw, e""",
        "nearest_centroid": f"{NEAR} SELECT customer_id, cluster_id, {r(6, 'squared_distance')} FROM near",
        "mixture_assign": f"""{MIX}, wide AS (SELECT customer_id, {', '.join(
                f'max(CASE WHEN j = {j} THEN r END) AS p{j}' for j in range(P.MIXTURE.k))} FROM resp GROUP BY 1)
            SELECT customer_id, cluster_id, {r(6, 'confidence', *[f'p{j}' for j in range(P.MIXTURE.k)])}
            FROM soft JOIN wide USING (customer_id)""",
        "runner_up": f"{MIX} SELECT customer_id, runner_up_id, {r(6, 'runner_up_confidence')} FROM soft",
        "mixture_loglik_bic": f"""{MIX} SELECT round(sum(ld), 3) AS log_likelihood,
            round(-2 * sum(ld) + 53 * ln(count(*)), 3) AS bic, round(-2 * sum(ld) + 106, 3) AS aic FROM dens""",
        "em_step": f"""{MIX}, m AS (SELECT j, sum(r) AS nj, {', '.join(
                f'sum(r * {z}) AS s{i}, sum(r * {z} * {z}) AS q{i}' for i, z in enumerate(Z))}
                FROM resp JOIN zed USING (customer_id) GROUP BY j)
            SELECT j AS component, round(nj / (SELECT sum(nj) FROM m), 5) AS weight,
            {', '.join(f'round(s{i} / nj, 5) AS mean_{i}' for i in range(4))},
            {', '.join(f'round(greatest(q{i} / nj - (s{i} / nj) * (s{i} / nj), 0) + 1e-5, 5) AS var_{i}' for i in range(4))},
            round((SELECT avg(ld) FROM dens), 5) AS mean_log_density FROM m""",
        "silhouette_euclidean": f"{SCORED} SELECT round({SILHOUETTE}, 6) AS silhouette",
        "davies_bouldin": f"{ALL_SCORED} SELECT round({DAVIES}, 6) AS davies_bouldin",
        "silhouette_squared": f"{SQUARED} SELECT round({SILHOUETTE}, 6) AS silhouette",
        "calinski_harabasz": f"{ALL_SCORED} SELECT round({CALINSKI}, 4) AS calinski_harabasz",
        "embedding_cluster_scores": f"""WITH {score_ctes(EMB_POINTS, 'label', EMB, 'squared').lstrip()}
            SELECT (SELECT CAST(k AS INTEGER) FROM chi) AS n_clusters, round({SILHOUETTE}, 4) AS silhouette,
            round({DAVIES}, 4) AS davies_bouldin, round({CALINSKI}, 4) AS calinski_harabasz""",
        "confusion_at_t": f"{CONF} SELECT * FROM conf",
        "metric_suite": f"""{CONF},
            auc AS (SELECT (SELECT sum(CASE WHEN a.p > b.p THEN a.n * b.n WHEN a.p = b.p THEN a.n * b.n / 2 ELSE 0 END)
                 FROM (SELECT churn_probability AS p, count(*) AS n FROM lab WHERE churn = 1 GROUP BY 1) a,
                      (SELECT churn_probability AS p, count(*) AS n FROM lab WHERE churn = 0 GROUP BY 1) b)
               / (count(*) FILTER (WHERE churn = 1) * count(*) FILTER (WHERE churn = 0)) AS roc_auc FROM lab),
            st AS (SELECT churn_probability AS score, sum(churn) AS pos, count(*) AS n FROM lab GROUP BY 1),
            ap AS (SELECT sum(pos * tp / al) / sum(pos) AS pr_auc FROM (SELECT pos,
               sum(pos) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS al FROM st)),
            rt AS (SELECT *, {RATES} FROM conf)
            SELECT threshold, tp, fp, fn, tn, {r(6, 'accuracy', 'precision', 'recall', 'specificity', 'f1')},
            round((recall + specificity) / 2, 6) AS balanced_accuracy,
            round(coalesce((tp * tn - fp * fn) / nullif(sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0), 6) AS mcc,
            round(coalesce((accuracy - pe) / nullif(1 - pe, 0), 0), 6) AS cohen_kappa,
            tn + fp AS negatives, fn + tp AS positives, {r(6, 'roc_auc', 'pr_auc')}
            FROM (SELECT *, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / ((tp + fp + fn + tn) * (tp + fp + fn + tn)) AS pe
                  FROM rt), auc, ap""",
        "pr_curve": f"{PR} SELECT {PR_OUT} FROM pr",
        "roc_curve": f"{ROC} SELECT {r(6, 'fpr', 'tpr')}, round(score, 6) AS threshold FROM roc",
        "roc_auc": f"""{LADDER} SELECT round(sum(neg * (tp - pos / 2)) / (max(p_all) * max(n_all)), 6) AS roc_auc,
            {big.format('max(p_all)', 'positives')}, {big.format('max(n_all)', 'negatives')} FROM lad""",
        "average_precision": f"""{LADDER} SELECT round(sum(pos * tp / (tp + fp)) / max(p_all), 6) AS average_precision
            FROM lad""",
        "best_f1_threshold": f"""{PR} SELECT round(score, 6) AS best_threshold, round(f, 6) AS best_f1 FROM pr
            ORDER BY f DESC, score LIMIT 1""",
        "threshold_grid": f"""{LAB}, g AS (SELECT i, 1e-2 + (i - 1) * 1e-2 AS t FROM range(1, 100) AS x(i)),
            c AS (SELECT i, count(*) FILTER (WHERE churn_probability >= t AND churn = 1) AS tp,
                  count(*) FILTER (WHERE churn_probability >= t AND churn = 0) AS fp,
                  count(*) FILTER (WHERE churn_probability < t AND churn = 1) AS fn,
                  count(*) FILTER (WHERE churn_probability < t AND churn = 0) AS tn,
                  coalesce(sum({R}) FILTER (WHERE churn_probability >= t AND churn = 1), 0) AS rp,
                  coalesce(sum({R}) FILTER (WHERE churn_probability >= t AND churn = 0), 0) AS rn
                  FROM lab, g GROUP BY i),
            m AS (SELECT *, {RATES} FROM c)
            SELECT round(i / 1e2, 2) AS t, tp, fp, fn, tn,
            {r(4, 'precision', 'recall', 'f1', 'accuracy', 'specificity')}, tp + fp AS contacted,
            round_even(round(rp, 6), 0) AS rev_saved_ceiling, round_even(round(rn, 6), 0) AS rev_wasted FROM m""",
        "curve_decimate_pr": f"{PR} SELECT {PR_OUT} FROM pr WHERE position % greatest(pts // 100, 1) = 0",
        "curve_decimate_roc": f"""{ROC}, nr AS (SELECT *, row_number() OVER (ORDER BY score DESC NULLS FIRST) - 1 AS position,
                count(*) OVER () AS n FROM roc)
            SELECT {r(6, 'fpr', 'tpr')}, round(score, 6) AS threshold, position FROM nr
            WHERE position % greatest(n // 120, 1) = 0""",
        "multiclass_report": f"{CLASSES} SELECT label, support, predicted, tp, {r(6, 'precision', 'recall', 'f1')} FROM rep",
        "multiclass_summary": f"""{CLASSES}, t AS (SELECT sum(tp) / sum(support) AS po,
                sum(support * predicted) / (sum(support) * sum(support)) AS pe FROM rep)
            SELECT round(max(po), 6) AS accuracy, round(avg(precision), 6) AS macro_precision,
            round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
            round(sum(f1 * support) / sum(support), 6) AS weighted_f1,
            round((max(po) - max(pe)) / (1 - max(pe)), 6) AS cohen_kappa,
            {big.format('sum(support)', 'support')} FROM rep, t""",
        "confusion_matrix": f"""{CLASSES} SELECT b.s AS actual, {', '.join(
                f'count(*) FILTER (WHERE predicted = {text(s)}) AS "{s}"' for s in sorted(S.OFFERS))}
            FROM (VALUES {', '.join(f'({text(s)})' for s in sorted(S.OFFERS))}) AS b(s)
            LEFT JOIN pred ON pred.actual = b.s GROUP BY 1""",
        "best_candidate": f"""{LAB}, sc AS ({' UNION ALL '.join(
                f"SELECT '{name}' AS name, {prob(rule)} AS p, churn AS y FROM lab" for name, rule in P.SCORES.items())}),
            st AS (SELECT name, p, sum(y) AS pos, count(*) - sum(y) AS neg FROM sc GROUP BY 1, 2),
            l AS (SELECT *, sum(pos) OVER (PARTITION BY name ORDER BY p DESC) AS tp FROM st),
            a AS (SELECT name, sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) AS auc FROM l GROUP BY name),
            m AS (SELECT name, avg(CASE WHEN (p >= 5e-1) = (y = 1) THEN 1 ELSE 0 END) AS accuracy,
                  coalesce(2 * count(*) FILTER (WHERE p >= 5e-1 AND y = 1)
                    / nullif(count(*) FILTER (WHERE p >= 5e-1) + sum(y), 0), 0) AS f1 FROM sc GROUP BY name)
            SELECT name, {r(6, 'auc', 'accuracy', 'f1')} FROM a JOIN m USING (name) ORDER BY a.auc DESC, name LIMIT 1""",
        "exact_sample": f"{BASE} SELECT customer_id FROM clean ORDER BY {KEY}, customer_id LIMIT 500",
        "stratified_split": f"""{BASE}, sz AS (SELECT churn, count(*) AS n, sum(count(*)) OVER () AS total
                FROM clean GROUP BY churn),
            q AS (SELECT churn, ceil(total * 2e-1) AS want, n * ceil(total * 2e-1) / total AS share FROM sz),
            f AS (SELECT *, want - sum(floor(share)) OVER () AS short,
                  row_number() OVER (ORDER BY round(share - floor(share), 9) DESC, churn) AS turn FROM q),
            t AS (SELECT churn, floor(share) + CASE WHEN turn <= short THEN 1 ELSE 0 END AS take FROM f)
            SELECT customer_id, clean.churn, row_number() OVER (PARTITION BY clean.churn ORDER BY {KEY}, customer_id)
              <= take AS is_test FROM clean JOIN t ON t.churn = clean.churn""",
        "stratified_kfold": f"""{BASE} SELECT customer_id, churn,
            CAST(ntile(5) OVER (PARTITION BY churn ORDER BY {KEY}, customer_id) - 1 AS INTEGER) AS fold FROM clean""",
        "holdout_assign": f"{GROUPED} SELECT customer_id, segment, campaign_group FROM grp",
        "holdout_balance": f"""{BALANCE} SELECT feature, round(tm, 5) AS utg_mean, round(um, 5) AS ucg_mean,
            round(smd, 5) AS abs_smd, smd < 0.1 AS balanced FROM bal""",
        "all_balanced": f"{BALANCE} SELECT bool_and(smd < 0.1) AS all_balanced FROM bal",
        "holdout_counts": f"""{GROUPED} SELECT campaign_group, count(*) AS n,
            round(100 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM grp GROUP BY campaign_group""",
        "offer_recommend": f"""{LAB}, {BOOK} SELECT customer_id, lab.segment, offer, action,
            {escalated('priority', 'churn_probability * 2')} AS priority
            FROM lab JOIN book ON book.segment = lab.segment""",
        "holdout_suppress": f"""{GROUPED}, {BOOK} SELECT customer_id, campaign_group,
            CASE WHEN campaign_group = 'UCG' THEN {text(S.HOLDOUT_OFFER[0])} ELSE offer END AS offer,
            CASE WHEN campaign_group = 'UCG' THEN 'None' ELSE action END AS action,
            CASE WHEN campaign_group = 'UCG' THEN 'N/A' ELSE {escalated('priority', 'churn_probability')} END AS priority
            FROM grp JOIN book ON book.segment = grp.segment""",
        "segment_summary": f"""{GROUPED} SELECT segment, count(*) AS customers,
            round(100 * count(*) / sum(count(*)) OVER (), 4) AS pct_of_base, round(avg({R}), 4) AS avg_revenue,
            round(avg({U}), 4) AS avg_data_gb, round(avg({D}), 4) AS avg_dou, round(avg(aon), 4) AS avg_aon_days,
            round(100 * avg(pack_flag), 4) AS pack_penetration, round(100 * avg(churn), 4) AS actual_churn_rate,
            round(sum({R}), 4) AS monthly_revenue_inr, round(avg(churn_probability), 4) AS mean_churn_risk,
            round(sum({R} * churn_probability), 4) AS revenue_at_risk_inr,
            count(*) FILTER (WHERE campaign_group = 'UCG') AS ucg_count,
            count(*) FILTER (WHERE campaign_group = 'UTG') AS utg_count FROM grp GROUP BY segment""",
        "revenue_totals": f"""{LAB} SELECT round(sum({R}), 4) AS total_monthly_revenue,
            round(sum({R} * churn_probability), 4) AS total_revenue_at_risk,
            round(avg(churn), 4) AS churn_base_rate, count(*) AS customers FROM lab""",
        "confidence_review": f"""{MIX} SELECT customer_id, cluster_id, {r(6, 'confidence')},
            round(confidence - runner_up_confidence, 6) AS confidence_gap FROM soft WHERE confidence < 0.8""",
        "confidence_stats": f"""{MIX} SELECT round(avg(confidence), 6) AS mean_confidence,
            count(*) FILTER (WHERE confidence < 0.6) AS low_confidence_customers FROM soft""",
        "customer_export": f"""{GROUPED}, {BOOK} SELECT customer_id, grp.segment, campaign_group,
            CASE WHEN churn_probability >= {num(P.THRESHOLD)} THEN 1 ELSE 0 END AS churn_prediction,
            CASE WHEN campaign_group = 'UCG' THEN {text(S.HOLDOUT_OFFER[0])} ELSE offer END AS offer,
            CASE WHEN campaign_group = 'UCG' THEN 'N/A' ELSE {escalated('priority', 'churn_probability')} END AS priority
            FROM grp JOIN book ON book.segment = grp.segment""",
        "score_prepare": f"""{BASE}, prep AS ({prepared('raw', False)})
            SELECT customer_id, {r(3, U, R)}, {D}, {r(3, *S.RATIOS)}, is_dormant FROM prep""",
        "tenure_gate": f"""{BASE}, fl AS (SELECT customer_id, coalesce({U}, {num(P.MEDIANS[U])}) AS {U},
                coalesce({R}, {num(P.MEDIANS[R])}) AS {R}, {REST} FROM raw),
            sg AS ({standins('fl')}), {BOOK}
            SELECT customer_id, aon, {GATED['segment'].format('sg.segment')} AS segment,
            {GATED['offer'].format('offer')} AS offer, {GATED['action'].format('action')} AS action
            FROM sg JOIN book ON book.segment = sg.segment""",
        "risk_band": f"""{LAB}, w AS (SELECT customer_id, least(round(churn_probability * 3, 6), 1e0) AS p FROM lab)
            SELECT customer_id, p, {BAND} AS risk_band FROM w""",
        "score_batch": SCORE_BATCH,
        "report_sections": f"""{BALANCE},
            seg AS (SELECT segment, count(*) AS customers, count(*) FILTER (WHERE campaign_group = 'UCG') AS ucg_count,
                    count(*) FILTER (WHERE campaign_group = 'UTG') AS utg_count,
                    sum({R} * churn_probability) AS revenue_at_risk_inr FROM grp GROUP BY segment),
            grid AS (SELECT i / 1e2 AS t, count(*) FILTER (WHERE churn_probability >= 1e-2 + (i - 1) * 1e-2) AS contacted,
                    coalesce(round(2 * count(*) FILTER (WHERE churn_probability >= 1e-2 + (i - 1) * 1e-2 AND churn = 1)
                      / nullif(count(*) FILTER (WHERE churn_probability >= 1e-2 + (i - 1) * 1e-2) + sum(churn), 0), 4), 0) AS f1
                    FROM grp, range(1, 100) AS x(i) GROUP BY i),
            head AS (SELECT count(*) AS clean_rows, count(*) FILTER (WHERE campaign_group = 'UCG') AS ucg_count,
                    count(*) FILTER (WHERE campaign_group = 'UTG') AS utg_count, sum({R}) AS total_monthly_revenue,
                    sum({R} * churn_probability) AS total_revenue_at_risk FROM grp)
            SELECT 'segments' AS section, segment AS item, figure, round(value, 4) AS value FROM (
                UNPIVOT (SELECT segment, COLUMNS(* EXCLUDE segment)::DOUBLE FROM seg)
                ON COLUMNS(* EXCLUDE segment) INTO NAME figure VALUE value)
            UNION ALL SELECT 'ucg_balance', feature, 'abs_smd', round(smd, 4) FROM bal
            UNION ALL SELECT 'thresholds', CAST(round(t, 2) AS VARCHAR), figure, value FROM (
                UNPIVOT (SELECT t, contacted::DOUBLE AS contacted, f1::DOUBLE AS f1 FROM grid) ON contacted, f1 INTO NAME figure VALUE value)
            UNION ALL SELECT 'headline', 'all', figure, round(value, 4) FROM (
                UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM head) ON COLUMNS(*) INTO NAME figure VALUE value)
            UNION ALL SELECT 'order', s, 'rank', r FROM (VALUES {', '.join(f"({text(s)}, {k}e0)" for k, s in S.SEGMENT_BY_RANK.items())}) AS o(s, r)
            UNION ALL SELECT 'cases', c, 'refused', CASE WHEN a < 90 THEN 1e0 ELSE 0e0 END
                FROM (VALUES {', '.join(f"('{c[0]}', {c[5]})" for c in CASES)}) AS cs(c, a)
            UNION ALL SELECT 'missing', 'clusters', 'k_sweep', 1e0""",
        "quarantined_csv": f"""{BASE}, k AS (SELECT customer_id, round({U}, 4) AS {U},
                CASE WHEN customer_id % 97 IN (5, 6, 7) THEN 'quarantined' ELSE 'loaded' END AS kind FROM raw)
            SELECT customer_id, kind, CASE WHEN kind = 'loaded' THEN {U} END AS {U}, count(*) OVER (PARTITION BY kind) AS of_kind FROM k""",
        "resumed_stages": f"""{BASE} SELECT 'deduped' AS stage, count(*) AS rows, 1 AS runs FROM dedup
            UNION ALL SELECT 'valid', count(*), 1 FROM valid
            UNION ALL SELECT 'segments', count(DISTINCT pack_flag), 2 FROM valid""",
        # what every right fit shows
        "kmeans_fit": f"""{BASE} SELECT {S.N_CLUSTERS} AS clusters, count(*) AS n, true AS sizes_add_up,
            true AS centres_at_rest, true AS cost_recomputed, true AS beats_fixed_centres FROM clean""",
        "k_sweep": f"""SELECT CAST(unnest(range({min(S.SWEEP_K)}, {max(S.SWEEP_K) + 1})) AS INTEGER) AS k, true AS falls,
            true AS beats_bands, true AS calinski_follows, true AS silhouette_in_range, true AS davies_positive""",
        "gmm_fit": f"""{BASE} SELECT {S.N_CLUSTERS} AS components, count(*) AS n, true AS weights_add_up,
            true AS confidences_in_range, true AS density_recomputed, true AS beats_fixed_mixture FROM clean""",
        "churn_fit_select": f"""{BASE} SELECT name, true AS fitted, true AS area_recomputed, true AS best_selected,
            CAST((SELECT ceil(count(*) * 2e-1) FROM clean) AS BIGINT) AS test_rows
            FROM (VALUES ('logistic_regression'), ('random_forest'), ('hist_gradient_boosting')) AS t(name)""",
        "churn_score_base": f"{BASE} SELECT customer_id, true AS scored, true AS flag_follows FROM clean",
        "churn_cv": f"""{BASE}, cvf AS (SELECT churn, CAST(ntile(5) OVER (PARTITION BY churn ORDER BY {KEY}, customer_id) - 1
                AS INTEGER) AS fold FROM clean)
            SELECT fold, count(*) AS n, CAST(sum(churn) AS BIGINT) AS positives, true AS area_recomputed, true AS f1_recomputed,
            true AS fitted FROM cvf GROUP BY fold""",
        "boosting_rounds": "SELECT true AS lowest_chosen, true AS patience_used, true AS loss_recomputed, true AS fitted",
        "importance_topk": "SELECT 10 AS n, true AS shares_recomputed, true AS greatest_first, true AS fitted",
        "surrogate_fit": f"""{LAB} SELECT CAST(ceil(count(*) * 2e-1) AS BIGINT) AS test_rows,
            true AS beats_largest_segment FROM lab""",
        "saved_scorer": f"""{BASE} SELECT customer_id, coalesce(aon >= 90, false) AS segmented,
            NOT coalesce(aon >= 90, false) AS no_offer, NOT coalesce(aon >= 90, false) AS no_priority,
            aon IS NOT NULL AS has_probability, true AS floored, true AS flag_follows FROM raw""",
    }
    out["write_counts"] = f"""{BASE} SELECT * FROM ({out['cleaning_audit'].removeprefix(BASE)}),
        ({out['clean_violations'].removeprefix(BASE)})"""
    return out
