"""Independent SQL for the registered queries, in DuckDB's dialect.

The statements follow the definitions of the operators, not their Spark plans: labels
use the descending row index, global orders use plain window functions.
"""

from __future__ import annotations

_SERIOUS = ", ".join(f"'{months}'" for months in range(3, 25)) + ", 'RA'"

CTES = {
    "months": """
 SELECT l_partkey AS key, year(l_shipdate)*12+month(l_shipdate) AS month_idx,
   CAST(max(l_quantity) AS INTEGER) AS q, max(l_extendedprice) AS upb,
   max(l_discount) AS disc, max(l_returnflag) AS rf
 FROM lineitem GROUP BY l_partkey, year(l_shipdate)*12+month(l_shipdate)""",
    # the months of a key after the first 4 + key % 30 are those of a second loan
    "numbered": """
 SELECT months.*, CAST(key AS VARCHAR) || CASE WHEN nth > 4 + key % 30 THEN '-b' ELSE '' END AS loan
 FROM (SELECT months.*, row_number() OVER (PARTITION BY key ORDER BY month_idx) AS nth FROM months) months""",
    "history": """
 SELECT numbered.*, row_number() OVER (PARTITION BY loan ORDER BY month_idx) AS rn,
   count(*) OVER (PARTITION BY loan) AS n, min(month_idx) OVER (PARTITION BY loan) AS m0,
   CASE WHEN q<=38 THEN '0' WHEN q<=44 THEN '1' WHEN q<=47 THEN '2' WHEN q=48 AND rf='N' THEN '3'
     WHEN q=49 AND rf='R' THEN 'RA' WHEN q=50 THEN 'XX' WHEN q=49 AND rf='N' THEN '25' ELSE '0' END AS status,
   CASE WHEN rf='A' AND q%5=0 THEN 'Y' WHEN rf='A' AND q%7=0 THEN 'P' ELSE '' END AS mod_flag
 FROM numbered""",
    "zeroed": """
 SELECT history.*, CASE WHEN rn=n AND key%5=0 THEN '01' WHEN rn=n AND key%17=0 THEN '03' END AS zbc
 FROM history""",
    "svcg": """
 SELECT loan, month_idx, status,
   CASE WHEN status='RA' THEN 90.0::DOUBLE WHEN regexp_full_match(status, '[0-9]+') THEN TRY_CAST(status AS DOUBLE) END AS num,
   zbc, mod_flag, CASE WHEN mod_flag IN ('Y','P') THEN 1 ELSE 0 END AS modified,
   upb, CAST(month_idx-m0 AS DOUBLE) AS age, CAST(360-(month_idx-m0) AS DOUBLE) AS remaining,
   4.0::DOUBLE+10*disc AS rate
 FROM zeroed""",
    "flags": f"""
 SELECT svcg.*, coalesce(num, 0) AS lvl,
   CASE WHEN status IN ({_SERIOUS}) THEN 1 ELSE 0 END AS serious,
   CASE WHEN zbc IN ('02','03','09','15','16') THEN 1 ELSE 0 END AS loss,
   CASE WHEN zbc = '01' THEN 1 ELSE 0 END AS prepay,
   CASE WHEN status IN ({_SERIOUS}) OR zbc IN ('02','03','09','15','16') THEN 1 ELSE 0 END AS event
 FROM svcg""",
    "islands": """
 SELECT flags.*, row_number() OVER w AS seq,
   sum(CASE WHEN lvl > 0 THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS island,
   row_number() OVER (PARTITION BY loan ORDER BY month_idx DESC) AS rev
 FROM flags WINDOW w AS (PARTITION BY loan ORDER BY month_idx)""",
    "behaviour": """
 SELECT islands.*,
   max(lvl) OVER w3 AS max_delinq_3m, sum(lvl) OVER w3 / 3 AS mean_delinq_3m,
   CAST(count(*) FILTER (WHERE lvl > 0) OVER w3 AS BIGINT) AS n_delinq_months_3m,
   max(lvl) OVER w6 AS max_delinq_6m, sum(lvl) OVER w6 / 6 AS mean_delinq_6m,
   CAST(count(*) FILTER (WHERE lvl > 0) OVER w6 AS BIGINT) AS n_delinq_months_6m,
   CAST(sum(serious) OVER w6 AS BIGINT) AS n_serious_delinq_6m,
   max(lvl) OVER w12 AS max_delinq_12m, sum(lvl) OVER w12 / 12 AS mean_delinq_12m,
   CAST(count(*) FILTER (WHERE lvl > 0) OVER w12 AS BIGINT) AS n_delinq_months_12m,
   CAST(sum(serious) OVER w12 AS BIGINT) AS n_serious_delinq_12m,
   CAST(CASE WHEN island = 0 THEN seq
     ELSE seq - min(seq) OVER (PARTITION BY loan, island) END AS INTEGER) AS payment_streak,
   lvl - coalesce(lag(lvl, 5) OVER (PARTITION BY loan ORDER BY month_idx), 0) AS delinq_trend_6m
 FROM islands WINDOW
   w3 AS (PARTITION BY loan ORDER BY month_idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
   w6 AS (PARTITION BY loan ORDER BY month_idx ROWS BETWEEN 5 PRECEDING AND CURRENT ROW),
   w12 AS (PARTITION BY loan ORDER BY month_idx ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""",
    "labelled": """
 SELECT behaviour.*,
   CASE WHEN max(event) OVER back = 1 THEN 1
     WHEN max(prepay) OVER back = 1 AND count(*) OVER back < 12 THEN NULL ELSE 0 END AS label_back,
   CASE WHEN max(event) OVER ahead = 1 THEN 1
     WHEN max(prepay) OVER ahead = 1 AND count(*) OVER ahead < 12 THEN NULL ELSE 0 END AS label_ahead
 FROM behaviour WINDOW
   back AS (PARTITION BY loan ORDER BY rev ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING),
   ahead AS (PARTITION BY loan ORDER BY rev ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)""",
    "snap": """
 SELECT * FROM labelled WHERE rev = 1 AND seq > 6""",
    "dirty": """
 SELECT p_partkey AS key, CAST(p_partkey AS VARCHAR) || suffix AS loan,
   CAST(CASE WHEN p_partkey%41=0 THEN 9999 ELSE 290+(p_partkey*7919)%571 END AS DOUBLE) AS s_score,
   CAST(CASE WHEN p_partkey%37=0 THEN 999 ELSE (p_partkey*31)%60 END AS DOUBLE) AS s_mi,
   CAST(CASE WHEN p_partkey%43=0 THEN 999 ELSE 40+(p_partkey*13)%80 END AS DOUBLE) AS s_ltv,
   CAST(CASE WHEN p_partkey%47=0 THEN 999 ELSE 42+(p_partkey*17)%80 END AS DOUBLE) AS s_cltv,
   CAST(CASE WHEN p_partkey%29=0 THEN 999 ELSE (p_partkey*19)%70 END AS DOUBLE) AS s_dti,
   p_retailprice*100 AS orig_upb,
   CAST(CASE WHEN p_partkey%53=0 THEN 0 ELSE 3+p_partkey%5 END AS DOUBLE) AS orig_rate,
   CAST(CASE WHEN p_partkey%3=0 THEN 180 ELSE 360 END AS DOUBLE) AS term,
   CASE WHEN p_partkey%11=0 THEN 'Y' ELSE 'N' END AS ppm, upper(trim(p_brand)) AS state,
   CAST(1999+p_partkey%22 AS INTEGER) AS orig_year
 FROM part, (VALUES (''), ('-b')) loans(suffix)""",
    "orig": """
 SELECT key, loan, orig_upb, orig_rate, term, ppm, state, orig_year,
   CASE WHEN s_score BETWEEN 300 AND 850 THEN s_score END AS score,
   CASE WHEN s_mi BETWEEN 0 AND 55 THEN s_mi END AS mi,
   CASE WHEN s_cltv BETWEEN 1 AND 998 AND s_cltv <> 999 THEN s_cltv END AS cltv,
   CASE WHEN s_dti BETWEEN 0 AND 65 THEN s_dti END AS dti,
   CASE WHEN s_ltv BETWEEN 1 AND 998 THEN s_ltv END AS ltv
 FROM dirty""",
    "featured": """
 SELECT orig.*,
   CASE WHEN score >= 0 AND score < 580 THEN 'deep_subprime' WHEN score >= 580 AND score < 620 THEN 'subprime'
     WHEN score >= 620 AND score < 660 THEN 'near_prime' WHEN score >= 660 AND score < 720 THEN 'prime'
     WHEN score >= 720 AND score < 760 THEN 'prime_plus' WHEN score >= 760 AND score < 900 THEN 'super_prime'
     ELSE 'unknown' END AS credit_score_bucket,
   CASE WHEN ltv > 0 AND ltv <= 60 THEN 'lte60' WHEN ltv > 60 AND ltv <= 70 THEN '60_70'
     WHEN ltv > 70 AND ltv <= 80 THEN '70_80' WHEN ltv > 80 AND ltv <= 90 THEN '80_90'
     WHEN ltv > 90 AND ltv <= 97 THEN '90_97' WHEN ltv > 97 AND ltv <= 999 THEN 'gt97' ELSE 'unknown' END AS ltv_bucket,
   CASE WHEN dti > 0 AND dti <= 28 THEN 'conservative' WHEN dti > 28 AND dti <= 36 THEN 'moderate'
     WHEN dti > 36 AND dti <= 43 THEN 'standard' WHEN dti > 43 AND dti <= 50 THEN 'elevated'
     WHEN dti > 50 AND dti <= 100 THEN 'high' ELSE 'unknown' END AS dti_bucket,
   CAST(ltv > 80 AS DOUBLE) AS is_high_ltv, CAST(dti > 43 AS DOUBLE) AS is_high_dti,
   CASE WHEN mi > 0 THEN 1 ELSE 0 END AS has_mi, CASE WHEN ppm = 'Y' THEN 1 ELSE 0 END AS is_ppm,
   ln(1 + coalesce(orig_upb, 0)) AS log_orig_upb,
   coalesce(ltv, (SELECT quantile_cont(ltv, 0.5) FROM orig)) * coalesce(dti, (SELECT quantile_cont(dti, 0.5) FROM orig))
     AS ltv_dti_interaction,
   CASE WHEN ltv > 0 THEN score / ltv END AS credit_ltv_ratio,
   CASE WHEN orig_rate > 0 AND term > 0 THEN orig_upb * (orig_rate/1200) * pow(1+orig_rate/1200, term)
     / (pow(1+orig_rate/1200, term) - 1) END AS est_monthly_payment,
   CASE WHEN orig_year BETWEEN 1999 AND 2003 THEN 'expansion_dotcom' WHEN orig_year BETWEEN 2004 AND 2007 THEN 'bubble_peak'
     WHEN orig_year BETWEEN 2008 AND 2009 THEN 'gfc_crisis' WHEN orig_year BETWEEN 2010 AND 2012 THEN 'post_gfc'
     WHEN orig_year BETWEEN 2013 AND 2019 THEN 'recovery' ELSE 'unknown' END AS econ_regime,
   CASE WHEN orig_year BETWEEN 2004 AND 2007 THEN 1 ELSE 0 END AS is_bubble_vintage,
   CASE WHEN orig_year BETWEEN 2008 AND 2009 THEN 1 ELSE 0 END AS is_gfc_vintage,
   CASE WHEN orig_year >= 2010 THEN 1 ELSE 0 END AS is_post_gfc
 FROM orig""",
    "joined": """
 SELECT snap.*, featured.* EXCLUDE (loan),
   age / term AS loan_age_ratio, remaining / term AS pct_life_remaining,
   CASE WHEN orig_upb > 0 THEN upb / orig_upb END AS upb_pct_remaining, rate - orig_rate AS rate_spread,
   CASE WHEN age >= 0 AND age <= 12 THEN '0_12m' WHEN age > 12 AND age <= 24 THEN '12_24m'
     WHEN age > 24 AND age <= 36 THEN '24_36m' WHEN age > 36 AND age <= 60 THEN '36_60m'
     WHEN age > 60 AND age <= 120 THEN '60_120m' WHEN age > 120 THEN '120m_plus' ELSE 'unknown' END AS loan_age_bucket
 FROM snap JOIN featured ON snap.loan = featured.loan""",
    "split": """
 SELECT joined.*, label_back AS y,
   CASE WHEN bucket < 70 THEN 'train' WHEN bucket < 85 THEN 'val' ELSE 'test' END AS split_oos,
   CASE WHEN orig_year BETWEEN 1999 AND 2007 THEN 'train' WHEN orig_year BETWEEN 2008 AND 2012 THEN 'test' END AS split_oot
 FROM (SELECT *, CAST(('0x' || substr(md5(loan || '|42'), 1, 8))::BIGINT % 100 AS INTEGER) AS bucket FROM joined) joined
 WHERE label_back IS NOT NULL""",
    "logits": """
 SELECT split.*,
   -3.4::DOUBLE + 0.8::DOUBLE*ln(1+max_delinq_12m) + 0.3::DOUBLE*n_delinq_months_12m - 0.02::DOUBLE*payment_streak AS z_behaviour,
   -1.2::DOUBLE + 0.015::DOUBLE*(coalesce(ltv,80)-80) - 0.004::DOUBLE*(coalesce(score,700)-700) AS z_static
 FROM split""",
    "wide": """
 SELECT loan, orig_year, y, split_oos, split_oot,
   round(1/(1+exp(-z_behaviour)), 6) AS behaviour,
   round(1/(1+exp(-(0.5::DOUBLE*z_behaviour + 0.5::DOUBLE*z_static))), 6) AS blend,
   round(1/(1+exp(-z_static)), 6) AS static
 FROM logits""",
    "parts": """
 SELECT 'oos' AS split, wide.* FROM wide WHERE split_oos = 'test'
 UNION ALL SELECT 'oot' AS split, wide.* FROM wide WHERE split_oot = 'test'""",
    "scored": """
 SELECT split, loan, y, 'behaviour' AS model, behaviour AS p FROM parts
 UNION ALL SELECT split, loan, y, 'blend', blend FROM parts
 UNION ALL SELECT split, loan, y, 'static', static FROM parts""",
    "counts": """
 SELECT model, split, p, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1-y) AS BIGINT) AS neg
 FROM scored GROUP BY model, split, p""",
    "curve": """
 SELECT counts.*, sum(pos) OVER w AS cpos, sum(neg) OVER w AS cneg,
   sum(pos) OVER (PARTITION BY model, split) AS tpos, sum(neg) OVER (PARTITION BY model, split) AS tneg
 FROM counts WINDOW w AS (PARTITION BY model, split ORDER BY p DESC)""",
    # rank-sum AUC and distribution-function KS: other formulas than the operators use
    "ranked": """
 SELECT scored.*, rank() OVER (PARTITION BY model, split ORDER BY p)
   + (count(*) OVER (PARTITION BY model, split, p) - 1) / 2.0 AS mid_rank
 FROM scored""",
    "aucs": """
 SELECT model, split, (sum(mid_rank) FILTER (WHERE y = 1) - sum(y)*(sum(y)+1)/2.0) / (sum(y) * sum(1-y)) AS auc
 FROM ranked GROUP BY model, split""",
    "gaps": """
 SELECT model, split, max(abs(cpos/tpos - cneg/tneg)) AS ks, sum(pos*cpos/(cpos+cneg))/max(tpos) AS ap
 FROM curve GROUP BY model, split""",
    "calls": """
 SELECT model, split, count(*) AS n, sum(y) AS npos, avg((p-y)*(p-y)) AS brier,
   count(*) FILTER (WHERE p >= 0.5 AND y = 1) AS tp, count(*) FILTER (WHERE p < 0.5 AND y = 0) AS tn,
   count(*) FILTER (WHERE p >= 0.5 AND y = 0) AS fp, count(*) FILTER (WHERE p < 0.5 AND y = 1) AS fn
 FROM scored GROUP BY model, split""",
    "metrics": """
 SELECT model, split, n AS n_total, CAST(npos AS BIGINT) AS n_positive,
   round_even(100.0::DOUBLE*npos/n, 2) AS default_rate_pct,
   round_even(auc, 4) AS auc_roc, round_even(2*auc-1, 4) AS gini, round_even(ks, 4) AS ks_stat,
   round_even(ap, 4) AS auc_pr, round_even(brier, 5) AS brier_score,
   round_even(CASE WHEN tp > 0 THEN 2.0*tp/(2*tp+fp+fn) ELSE 0 END, 4) AS f1,
   round_even(CASE WHEN tp+fp > 0 THEN tp/(tp+fp) ELSE 0 END, 4) AS precision,
   round_even(CASE WHEN tp+fn > 0 THEN tp/(tp+fn) ELSE 0 END, 4) AS recall,
   tp AS TP, tn AS TN, fp AS FP, fn AS FN
 FROM calls JOIN aucs USING (model, split) JOIN gaps USING (model, split)""",
    "points": """
 SELECT scored.*, CAST(least(greatest(round_even(
     600 - 40/ln(2)*ln(19) + 40/ln(2)*ln((1-least(greatest(p, 1e-6), 1-1e-6))/least(greatest(p, 1e-6), 1-1e-6)), 0),
   300), 900) AS INTEGER) AS score
 FROM scored""",
    "bands": """
 SELECT * FROM (VALUES (1, 300, 580, '300-580', 'Very High Risk', 'Decline or high rates'),
   (2, 581, 620, '580-620', 'High Risk', 'Conditional approval'),
   (3, 621, 660, '620-660', 'Medium-High Risk', 'Enhanced scrutiny'),
   (4, 661, 720, '660-720', 'Medium Risk', 'Normal underwriting'),
   (5, 721, 760, '720-760', 'Low-Medium Risk', 'Standard approval'),
   (6, 761, 900, '760-900', 'Low Risk', 'Approve with best rates'))
 AS t(pos, lo, hi, score_bucket, risk_bucket, business_action)""",
    "raw_orig": """
 SELECT p_partkey AS key,
   CASE WHEN p_partkey%41=0 THEN '9999' WHEN p_partkey%59=0 THEN 'n/a' ELSE CAST(290+(p_partkey*7919)%571 AS VARCHAR) END AS score,
   CASE WHEN p_partkey%31=0 THEN yr WHEN p_partkey%67=0 THEN '' WHEN p_partkey%71=0 THEN yr || 'xx'
     WHEN p_partkey%13=0 THEN ' ' || yr || mo || ' ' ELSE yr || mo END AS first_pay,
   CAST(2029+p_partkey%22 AS VARCHAR) || mo AS maturity,
   CASE WHEN p_partkey%37=0 THEN '999' WHEN p_partkey%7=0 THEN '' ELSE CAST((p_partkey*31)%60 AS VARCHAR) END AS mi,
   CASE WHEN p_partkey%47=0 THEN '999' ELSE CAST(42+(p_partkey*17)%80 AS VARCHAR) END AS cltv,
   CASE WHEN p_partkey%29=0 THEN '999' WHEN p_partkey%19=0 THEN '' ELSE CAST((p_partkey*19)%70 AS VARCHAR) END AS dti,
   CAST(CAST(floor(p_retailprice*100) AS BIGINT) AS VARCHAR) AS upb,
   CASE WHEN p_partkey%43=0 THEN '999' ELSE CAST(40+(p_partkey*13)%80 AS VARCHAR) END AS ltv,
   CAST(3+p_partkey%5 AS VARCHAR) || '.25' AS rate,
   CASE WHEN p_partkey%11=0 THEN ' y ' ELSE 'n' END AS ppm,
   lower(CASE WHEN p_partkey%9=0 THEN ' ' || p_brand || ' ' ELSE p_brand END) AS state,
   CASE WHEN p_partkey%97=0 THEN '  ' WHEN p_partkey%17=0 THEN ' ' || p_partkey || suffix || ' ' ELSE p_partkey || suffix END AS loan,
   CASE WHEN p_partkey%3=0 THEN '180' ELSE '360' END AS term,
   CASE WHEN p_partkey%23=0 THEN '' ELSE ' servicer ' || CAST(p_partkey%4 AS VARCHAR) END AS servicer
 FROM (SELECT *, CAST(1999+p_partkey%22 AS VARCHAR) AS yr, lpad(CAST(1+p_partkey%12 AS VARCHAR), 2, '0') AS mo FROM part, (VALUES (''), ('-b')) loans(suffix))""",
    "raw_svcg": """
 SELECT CASE WHEN key%97=0 THEN '' WHEN key%17=0 THEN ' ' || loan || ' ' ELSE loan END AS loan,
   CASE WHEN mixed=0 THEN '' WHEN mixed=1 THEN yr WHEN mixed=2 THEN yr || 'ab'
     WHEN key%5=0 THEN ' ' || yr || mo || ' ' ELSE yr || mo END AS period,
   CASE WHEN mixed=3 THEN '' WHEN mixed=4 THEN 'unknown' ELSE CAST(CAST(floor(upb) AS BIGINT) AS VARCHAR) END AS upb,
   CASE WHEN mixed=5 THEN ' 2' WHEN mixed=6 THEN '' ELSE status END AS status,
   CASE WHEN mixed=7 THEN '' ELSE CAST(month_idx-m0 AS VARCHAR) END AS age,
   CAST(360-(month_idx-m0) AS VARCHAR) AS remaining,
   CASE WHEN mixed=8 THEN ' y' ELSE mod_flag END AS mod_flag,
   CASE WHEN mixed=9 THEN 'nan' WHEN mixed=10 THEN 'None' WHEN mixed=11 THEN ' null ' WHEN mixed=12 THEN ''
     ELSE coalesce(zbc, '') END AS zbc,
   CASE WHEN zbc IS NOT NULL THEN yr || mo ELSE '' END AS zb_date,
   CAST(3+key%5 AS VARCHAR) || '.5' AS rate
 FROM (SELECT *, (key+month_idx)%61 AS mixed, CAST((month_idx-1)//12 AS VARCHAR) AS yr,
         lpad(CAST(month_idx-((month_idx-1)//12)*12 AS VARCHAR), 2, '0') AS mo FROM zeroed)""",
}

# what every common table builds on, in order
_NEEDS = {
    "numbered": ["months"], "history": ["numbered"], "zeroed": ["history"], "svcg": ["zeroed"], "flags": ["svcg"],
    "islands": ["flags"], "behaviour": ["islands"], "labelled": ["behaviour"], "snap": ["labelled"],
    "orig": ["dirty"], "featured": ["orig"], "joined": ["snap", "featured"], "split": ["joined"],
    "logits": ["split"], "wide": ["logits"], "parts": ["wide"], "scored": ["parts"], "counts": ["scored"],
    "curve": ["counts"], "ranked": ["scored"], "aucs": ["ranked"], "gaps": ["curve"], "calls": ["scored"],
    "metrics": ["calls", "aucs", "gaps"], "points": ["scored"], "raw_svcg": ["zeroed"],
}


def sql(body: str, *tables: str, instead: dict[str, tuple[str, list[str]]] | None = None) -> str:
    """``body`` behind the common tables it names and what those need; ``instead`` puts others in the place of some."""
    ordered: list[str] = []
    needs = _NEEDS | {name: needed for name, (_, needed) in (instead or {}).items()}
    bodies = CTES | {name: text for name, (text, _) in (instead or {}).items()}

    def add(name: str) -> None:
        for needed in needs.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in tables:
        add(name)
    if not ordered:
        return body.strip()
    parts = ",\n".join(f"{name} AS ({bodies[name].strip()})" for name in ordered)
    return f"WITH {parts}\n{body.strip()}"


_K = "loan AS LOAN_SEQUENCE_NUMBER, month_idx"
_L = "loan AS LOAN_SEQUENCE_NUMBER"

_CLEAN_ORIG = """
SELECT * FROM (
 SELECT CASE WHEN TRY_CAST(score AS DOUBLE) BETWEEN 300 AND 850 THEN TRY_CAST(score AS DOUBLE) END AS CREDIT_SCORE,
  {first} AS FIRST_PAYMENT_DATE, maturity AS MATURITY_DATE,
  CASE WHEN TRY_CAST(mi AS DOUBLE) BETWEEN 0 AND 55 THEN TRY_CAST(mi AS DOUBLE) END AS MI_PCT,
  CASE WHEN TRY_CAST(cltv AS DOUBLE) BETWEEN 1 AND 998 THEN TRY_CAST(cltv AS DOUBLE) END AS ORIG_CLTV,
  CASE WHEN TRY_CAST(dti AS DOUBLE) BETWEEN 0 AND 65 THEN TRY_CAST(dti AS DOUBLE) END AS ORIG_DTI,
  TRY_CAST(upb AS DOUBLE) AS ORIG_UPB,
  CASE WHEN TRY_CAST(ltv AS DOUBLE) BETWEEN 1 AND 998 THEN TRY_CAST(ltv AS DOUBLE) END AS ORIG_LTV,
  TRY_CAST(rate AS DOUBLE) AS ORIG_INTEREST_RATE, trim(upper(ppm)) AS PPM_FLAG, trim(upper(state)) AS PROPERTY_STATE,
  trim(loan) AS LOAN_SEQUENCE_NUMBER, TRY_CAST(term AS DOUBLE) AS ORIG_LOAN_TERM, {servicer} AS SERVICER_NAME,
  CASE WHEN length(trim(first_pay)) >= 4 THEN TRY_CAST(substr(trim(first_pay),1,4) AS INTEGER) END AS orig_year,
  CASE WHEN length(trim(first_pay)) >= 6 THEN TRY_CAST(substr(trim(first_pay),5,2) AS INTEGER) END AS orig_month
 FROM raw_orig) WHERE LOAN_SEQUENCE_NUMBER <> ''"""

_CLEAN_SVCG = """
SELECT *, rpt_year*12+rpt_month AS month_idx FROM (
 SELECT trim(loan) AS LOAN_SEQUENCE_NUMBER, {period} AS MONTHLY_RPT_PRD, TRY_CAST(upb AS DOUBLE) AS CURR_ACTUAL_UPB,
  {status} AS DLQCY_STATUS, TRY_CAST(age AS DOUBLE) AS LOAN_AGE, TRY_CAST(remaining AS DOUBLE) AS REM_MONTHS_MATURITY,
  {mod} AS MOD_FLAG,
  CASE WHEN trim(zbc) NOT IN ('', 'nan', 'None', 'null') THEN trim(zbc) END AS ZERO_BAL_CD, {zb_date} AS ZERO_BAL_EFF_DATE,
  TRY_CAST(rate AS DOUBLE) AS CURR_INTEREST_RATE,
  CASE WHEN length(trim(period)) >= 4 THEN TRY_CAST(substr(trim(period),1,4) AS INTEGER) END AS rpt_year,
  CASE WHEN length(trim(period)) >= 6 THEN TRY_CAST(substr(trim(period),5,2) AS INTEGER) END AS rpt_month,
  CASE WHEN trim(status) = 'RA' THEN 90.0::DOUBLE WHEN regexp_full_match(trim(status), '[0-9]+') THEN CAST(trim(status) AS DOUBLE) END
   AS DLQCY_STATUS_NUM,
  CASE WHEN trim(upper(mod_flag)) IN ('Y','P') THEN 1 ELSE 0 END AS MODIFIED
 FROM raw_svcg) WHERE LOAN_SEQUENCE_NUMBER <> ''"""

# the common tables behind raw text instead of the typed ones
_CHAIN = {
    "raw_clean": ("SELECT * FROM clean_rows", ["clean_rows"]),
    "svcg": ("""
 SELECT LOAN_SEQUENCE_NUMBER AS loan, month_idx, DLQCY_STATUS AS status, DLQCY_STATUS_NUM AS num, ZERO_BAL_CD AS zbc,
   MODIFIED AS modified, CURR_ACTUAL_UPB AS upb, LOAN_AGE AS age, REM_MONTHS_MATURITY AS remaining, CURR_INTEREST_RATE AS rate
 FROM clean_rows WHERE month_idx IS NOT NULL""", ["clean_rows"]),
    "orig": ("""
 SELECT LOAN_SEQUENCE_NUMBER AS loan, ORIG_UPB AS orig_upb, ORIG_INTEREST_RATE AS orig_rate, ORIG_LOAN_TERM AS term,
   PPM_FLAG AS ppm, PROPERTY_STATE AS state, orig_year, CREDIT_SCORE AS score, MI_PCT AS mi, ORIG_CLTV AS cltv, ORIG_DTI AS dti,
   ORIG_LTV AS ltv FROM clean_orig""", ["clean_orig"]),
}

# the CSV reader turns empty fields into nulls
_FROM_FILE = {
    "first": "trim(nullif(first_pay, ''))", "servicer": "trim(nullif(servicer, ''))", "period": "trim(nullif(period, ''))",
    "status": "trim(nullif(status, ''))", "mod": "trim(upper(nullif(mod_flag, '')))",
    "zb_date": "nullif(zb_date, '')",
}
_FROM_TABLE = {
    "first": "trim(first_pay)", "servicer": "trim(servicer)", "period": "trim(period)", "status": "trim(status)",
    "mod": "trim(upper(mod_flag))", "zb_date": "zb_date",
}

_ROLLED = {
    "rolling_max": ["max_delinq_3m", "max_delinq_6m", "max_delinq_12m"],
    "rolling_mean": ["mean_delinq_3m", "mean_delinq_6m", "mean_delinq_12m"],
    "rolling_delinq_count": ["n_delinq_months_3m", "n_delinq_months_6m", "n_delinq_months_12m"],
    "rolling_serious_count": ["n_serious_delinq_6m", "n_serious_delinq_12m"],
}

BEHAVIOUR = [
    "max_delinq_3m", "mean_delinq_3m", "n_delinq_months_3m", "max_delinq_6m", "mean_delinq_6m", "n_delinq_months_6m",
    "n_serious_delinq_6m", "max_delinq_12m", "mean_delinq_12m", "n_delinq_months_12m", "n_serious_delinq_12m",
    "payment_streak", "delinq_trend_6m",
]


def _select_behaviour() -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c.startswith("mean") else c for c in BEHAVIOUR)


# modeling table: (column, source expression)
_MODEL_NUMBERS = [
    ("CREDIT_SCORE", "score"), ("ORIG_LTV", "ltv"), ("ORIG_CLTV", "cltv"), ("ORIG_DTI", "dti"),
    ("ORIG_INTEREST_RATE", "orig_rate"), ("ORIG_UPB", "orig_upb"), ("ORIG_LOAN_TERM", "term"), ("MI_PCT", "mi"),
    ("log_orig_upb", "log_orig_upb"), ("ltv_dti_interaction", "ltv_dti_interaction"),
    ("credit_ltv_ratio", "credit_ltv_ratio"), ("est_monthly_payment", "est_monthly_payment"),
    ("is_high_ltv", "is_high_ltv"), ("is_high_dti", "is_high_dti"), ("has_mi", "has_mi"),
    ("loan_age_months", "age"), ("loan_age_ratio", "loan_age_ratio"), ("pct_life_remaining", "pct_life_remaining"),
    ("upb_pct_remaining", "upb_pct_remaining"), ("rate_spread", "rate_spread"), ("was_modified", "modified"),
    *[(c, c) for c in BEHAVIOUR],
    ("orig_year", "orig_year"), ("is_bubble_vintage", "is_bubble_vintage"), ("is_gfc_vintage", "is_gfc_vintage"),
    ("is_post_gfc", "is_post_gfc"), ("CREDIT_SCORE_MISSING", "CAST(score IS NULL AS INTEGER)"),
    ("ORIG_DTI_MISSING", "CAST(dti IS NULL AS INTEGER)"), ("ORIG_LTV_MISSING", "CAST(ltv IS NULL AS INTEGER)"),
    ("ORIG_CLTV_MISSING", "CAST(cltv IS NULL AS INTEGER)"),
]
_MODEL_CATEGORIES = [
    ("PROPERTY_STATE", "state"), ("credit_score_bucket", "credit_score_bucket"), ("ltv_bucket", "ltv_bucket"),
    ("dti_bucket", "dti_bucket"), ("loan_age_bucket", "loan_age_bucket"), ("econ_regime", "econ_regime"),
]


def _model_number(name: str, source: str) -> str:
    return f"round(coalesce(CAST({source} AS DOUBLE), -1), 6) AS {name}"


_ENCODED = """
SELECT joined_codes.loan AS LOAN_SEQUENCE_NUMBER, coalesce(a.code, -1) AS PROPERTY_STATE, coalesce(b.code, -1) AS econ_regime
FROM split joined_codes
LEFT JOIN (SELECT state, CAST(row_number() OVER (ORDER BY state) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT state FROM split WHERE split_oot = 'train')) a ON a.state = joined_codes.state
LEFT JOIN (SELECT econ_regime, CAST(row_number() OVER (ORDER BY econ_regime) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT econ_regime FROM split WHERE split_oot = 'train')) b ON b.econ_regime = joined_codes.econ_regime"""

_ROC = """
SELECT model, split, p AS threshold, cneg/tneg AS fpr, cpos/tpos AS tpr FROM (
 SELECT curve.*, row_number() OVER w AS i, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg
 FROM curve WINDOW w AS (PARTITION BY model, split ORDER BY p DESC))
WHERE i = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT DISTINCT model, split, NULL, 0.0, 0.0 FROM curve"""

_DECILES = """
SELECT model, split, decile, n, n_default, round(n_default/n, 6) AS default_rate, min_p, max_p,
 round(100.0*cd/sum(n_default) OVER g, 6) AS cum_default_pct,
 round(100.0*(cn-cd)/sum(n-n_default) OVER g, 6) AS cum_non_default_pct,
 round(abs(cd/sum(n_default) OVER g - (cn-cd)/sum(n-n_default) OVER g), 6) AS ks
FROM (SELECT *, sum(n) OVER w AS cn, sum(n_default) OVER w AS cd FROM (
  SELECT model, split, CAST(floor(10*(rn-1)/total)+1 AS INTEGER) AS decile, count(*) AS n,
   CAST(sum(y) AS BIGINT) AS n_default, min(p) AS min_p, max(p) AS max_p
  FROM (SELECT scored.*, count(*) OVER (PARTITION BY model, split) AS total,
    row_number() OVER (PARTITION BY model, split ORDER BY p DESC, md5(loan), loan) AS rn FROM scored)
  GROUP BY model, split, CAST(floor(10*(rn-1)/total)+1 AS INTEGER))
 WINDOW w AS (PARTITION BY model, split ORDER BY decile))
WINDOW g AS (PARTITION BY model, split)"""

_PSI_BINS = """,
cuts AS (SELECT model, """ + ", ".join(f"quantile_cont(p, {i / 10}) AS q{i}" for i in range(1, 10)) + """
 FROM scored WHERE split = 'oos' GROUP BY model),
binned AS (SELECT model, split, CAST(1 + """ + " + ".join(f"CAST(p > q{i} AS INTEGER)" for i in range(1, 10)) + """ AS INTEGER) AS bin
 FROM scored JOIN cuts USING (model)),
grid AS (SELECT model, CAST(unnest(range(1, 11)) AS INTEGER) AS bin FROM (SELECT DISTINCT model FROM scored)),
filled AS (SELECT model, bin, count(split) FILTER (WHERE split = 'oos') AS n_expected,
  count(split) FILTER (WHERE split = 'oot') AS n_actual
 FROM grid LEFT JOIN binned USING (model, bin) GROUP BY model, bin),
shares AS (SELECT *, greatest(n_expected/sum(n_expected) OVER (PARTITION BY model), 1e-6) AS e,
  greatest(n_actual/sum(n_actual) OVER (PARTITION BY model), 1e-6) AS a FROM filled)
"""


def _histogram(value: str, lo: str, hi: str, bins: int, source: str, where: str, by: str = "model") -> str:
    """Per (group, y) histogram; ``lo`` and ``hi`` are expressions over the group's rows."""
    return f""",
picked AS (SELECT {by} AS g, y, CAST({value} AS DOUBLE) AS v FROM {source} WHERE {where}),
limits AS (SELECT g, y, {lo} AS lo, {hi} AS hi, count(*) AS total FROM picked GROUP BY g, y),
grid AS (SELECT limits.*, (hi-lo)/{bins} AS w, CAST(unnest(range({bins})) AS INTEGER) AS bin FROM limits),
hit AS (SELECT g, y, CAST(least(floor((v-lo)/((hi-lo)/{bins})), {bins - 1}) AS INTEGER) AS bin, count(*) AS n
 FROM picked JOIN limits USING (g, y) WHERE v BETWEEN lo AND hi GROUP BY ALL)
SELECT g AS {by}, y, bin, round(lo+bin*w, 6) AS bin_start, round(lo+(bin+1)*w, 6) AS bin_end, coalesce(n, 0) AS n,
 round(coalesce(n, 0)/(total*w), 9) AS density
FROM grid LEFT JOIN hit USING (g, y, bin)"""


def statements() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_origination"] = sql(_CLEAN_ORIG.format(**_FROM_TABLE), "raw_orig")
    q["clean_servicing"] = sql(_CLEAN_SVCG.format(**_FROM_TABLE), "raw_svcg")
    q["csv_source_origination"] = sql(_CLEAN_ORIG.format(**_FROM_FILE), "raw_orig")
    q["csv_source_servicing"] = sql(_CLEAN_SVCG.format(**_FROM_FILE), "raw_svcg")
    q["null_tokens"] = sql("""
SELECT CASE WHEN trim(zbc) NOT IN ('', 'nan', 'None', 'null') THEN trim(zbc) END AS ZERO_BAL_CD, count(*) AS n
FROM raw_svcg GROUP BY 1""", "raw_svcg")
    q["one_row_per_month"] = """
SELECT LOAN_SEQUENCE_NUMBER, month_idx, l_quantity, l_extendedprice, l_discount, l_returnflag FROM (
 SELECT CAST(l_partkey AS VARCHAR) AS LOAN_SEQUENCE_NUMBER, year(l_shipdate)*12+month(l_shipdate) AS month_idx,
  l_quantity, l_extendedprice, l_discount, l_returnflag,
  row_number() OVER (PARTITION BY l_partkey, year(l_shipdate)*12+month(l_shipdate)
   ORDER BY l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_returnflag DESC) AS rn
 FROM lineitem) WHERE rn = 1""".strip()
    chain = _CHAIN | {"clean_rows": (_CLEAN_SVCG.format(**_FROM_TABLE), ["raw_svcg"]),
                      "clean_orig": (_CLEAN_ORIG.format(**_FROM_TABLE), ["raw_orig"])}
    # the test rows repeat every row with half the balance: the whole one is greater, equal ones are one
    q["collapse_months"] = sql("""
SELECT * FROM clean_rows
UNION ALL SELECT * REPLACE (CURR_ACTUAL_UPB / 2 AS CURR_ACTUAL_UPB) FROM clean_rows WHERE month_idx IS NULL""", "clean_rows", instead=chain)
    q["flow_snapshot"] = sql(f"SELECT {_K}, {_select_behaviour()}, label_back AS TARGET_12M FROM snap", "snap", instead=chain)
    q["flow_modeling"] = sql(f"""
SELECT {_K}, y AS TARGET_12M, split_oos, split_oot, credit_score_bucket, max_delinq_12m,
 round(coalesce(loan_age_ratio, -1), 6) AS loan_age_ratio, round(coalesce(rate_spread, -1), 6) AS rate_spread FROM split""", "split", instead=chain)
    q["yearly_files"] = sql("""
SELECT CAST(year AS VARCHAR) AS SERVICER_NAME, orig_year, count(*) AS n
FROM clean_orig, (VALUES (1999), (2005)) years(year) GROUP BY ALL""", "clean_orig", instead=chain)
    q["saved_and_loaded"] = sql(f"""
SELECT sink, {_L}, orig_year, state AS PROPERTY_STATE FROM orig, (VALUES ('parquet'), ('csv'), ('report'), ('once')) sinks(sink)""", "orig")
    q["stage_counts"] = sql("""
SELECT count(*) AS n_loans, CAST(sum(y) AS BIGINT) AS n_defaults, CAST(sum(1 - y) AS BIGINT) AS n_non_defaults,
 round(100.0::DOUBLE * sum(y) / count(*), 2) AS default_rate_pct FROM split""", "split")
    q["max_ks"] = f"SELECT model, split, max(ks) AS max_ks, arg_max(decile, (ks, -decile)) AS decile FROM ({sql(_DECILES, 'scored')}) GROUP BY ALL"
    trained = """
SELECT model, split, count(*) AS n_total, CAST(sum(y) AS BIGINT) AS n_positive, round_even(100.0::DOUBLE*sum(y)/count(*), 2) AS default_rate_pct,
 CAST(0 AS BIGINT) AS n_outside, trees, 1 AS auc_above_floor FROM parts, (VALUES {learners}) learners(model, trees) GROUP BY ALL"""
    # trees are held to the floor from ten times the rows of their least leaf on
    grown = """
SELECT model, split, count(*) AS n_total, CAST(sum(y) AS BIGINT) AS n_positive, round_even(100.0::DOUBLE*sum(y)/count(*), 2) AS default_rate_pct,
 CAST(0 AS BIGINT) AS n_outside, trees, CASE WHEN n_train >= least THEN 1 END AS auc_above_floor
FROM parts, (VALUES {learners}) learners(model, least, trees), (SELECT count(*) AS n_train FROM split WHERE split_oot = 'train') trained GROUP BY ALL"""
    learners = {"boosted_a": 300, "boosted_b": 300, "random_forest": 200, "logistic_regression": 0, "ensemble": 0}
    least = {"boosted_a": 800, "random_forest": 300}
    for name in ("boosted_b", "logistic_regression"):
        q[f"train_{name}"] = sql(trained.format(learners=f"('{name}', {learners[name]})"), "parts")
    for name in least:
        q[f"train_{name}"] = sql(grown.format(learners=f"('{name}', {least[name]}, {learners[name]})"), "parts")
    q["train_ensemble"] = sql(grown.format(learners=", ".join(f"('{n}', {least.get(n, 0)}, {k})" for n, k in learners.items())), "parts")
    q["stored_models"] = sql("""
SELECT split_oos, count(*) AS n_loans, CAST(0 AS BIGINT) AS n_different FROM split GROUP BY split_oos""", "split")
    q["assembled_features"] = sql(f"""
SELECT {_L}, credit_score_bucket, CAST(dense_rank() OVER (ORDER BY credit_score_bucket) - 1 AS INTEGER) AS code FROM joined""", "joined")
    q["event_flags"] = sql(f"""
SELECT {_K}, serious AS IS_90DPD, loss AS IS_ZBC_LOSS, prepay AS IS_PREPAY, event AS IS_DEFAULT_EVENT FROM flags""", "flags")
    for name, columns in _ROLLED.items():
        chosen = ", ".join(f"round({c}, 6) AS {c}" if c.startswith("mean") else c for c in columns)
        q[name] = sql(f"SELECT {_K}, {chosen} FROM behaviour", "behaviour")
    q["rolling_calendar"] = sql(f"""
SELECT {_K}, max(lvl) OVER w AS max_delinq_6m, round(sum(lvl) OVER w / 6, 6) AS mean_delinq_6m,
 CAST(sum(CASE WHEN lvl > 0 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_delinq_months_6m,
 CAST(sum(serious) OVER w AS BIGINT) AS n_serious_delinq_6m
FROM flags WINDOW w AS (PARTITION BY loan ORDER BY month_idx RANGE BETWEEN 5 PRECEDING AND CURRENT ROW)""", "flags")
    q["payment_streak"] = sql(f"SELECT {_K}, payment_streak FROM behaviour", "behaviour")
    q["delinq_trend"] = sql(f"SELECT {_K}, delinq_trend_6m FROM behaviour", "behaviour")
    q["label_trailing"] = sql(f"SELECT {_K}, label_back AS TARGET_12M FROM labelled", "labelled")
    q["label_forward"] = sql(f"SELECT {_K}, label_ahead AS TARGET_12M FROM labelled", "labelled")
    q["snapshot_latest"] = sql(f"SELECT {_K}, {_select_behaviour()}, label_back AS TARGET_12M FROM snap", "snap")
    q["snapshot_forward"] = sql(
        f"SELECT {_K}, {_select_behaviour()}, label_ahead AS TARGET_12M FROM labelled WHERE rev = 13 AND seq > 6", "labelled")
    q["snapshot_default_rate"] = sql("""
SELECT orig_year, count(*) AS n_loans, count(*) FILTER (WHERE label_back = 1) AS n_defaults,
 count(*) - count(*) FILTER (WHERE label_back = 1) AS n_non_defaults,
 round_even(100.0::DOUBLE * count(*) FILTER (WHERE label_back = 1) / count(*), 2) AS default_rate_pct
FROM snap JOIN dirty USING (loan) GROUP BY orig_year""", "snap", "dirty")
    q["label_counts"] = sql("SELECT label_back AS TARGET_12M, count(*) AS n FROM snap GROUP BY 1", "snap")
    for name in ("credit_score_bucket", "ltv_bucket", "dti_bucket"):
        q[name] = sql(f"SELECT {_L}, {name} FROM featured", "featured")
    q["loan_age_bucket"] = sql(f"""
SELECT {_K},
 CASE WHEN age >= 0 AND age <= 12 THEN '0_12m' WHEN age <= 24 THEN '12_24m' WHEN age <= 36 THEN '24_36m'
  WHEN age <= 60 THEN '36_60m' WHEN age <= 120 THEN '60_120m' ELSE '120m_plus' END AS loan_age_bucket,
 CASE WHEN age = 0 THEN 'unknown' WHEN age <= 12 THEN '0_12m' WHEN age <= 24 THEN '12_24m' WHEN age <= 36 THEN '24_36m'
  WHEN age <= 60 THEN '36_60m' WHEN age <= 120 THEN '60_120m' ELSE '120m_plus' END AS open_zero
FROM svcg""", "svcg")
    q["high_ltv_dti_flags"] = sql(f"""
SELECT {_L}, is_high_ltv, is_high_dti, coalesce(is_high_ltv, 0) AS ltv_zero, coalesce(is_high_dti, -1) AS dti_minus_one,
 has_mi, is_ppm FROM featured""", "featured")
    q["median_interaction"] = sql(f"SELECT {_L}, ltv_dti_interaction FROM featured", "featured")
    q["log_amount"] = sql(f"SELECT {_L}, round(log_orig_upb, 6) AS log_orig_upb FROM featured", "featured")
    q["credit_ltv_ratio"] = sql(f"SELECT {_L}, round(credit_ltv_ratio, 6) AS credit_ltv_ratio FROM featured", "featured")
    q["monthly_payment"] = sql(
        f"SELECT {_L}, round(est_monthly_payment, 6) AS est_monthly_payment FROM featured", "featured")
    q["dynamic_ratios"] = sql(f"""
SELECT {_L}, age AS loan_age_months, round(loan_age_ratio, 6) AS loan_age_ratio,
 round(pct_life_remaining, 6) AS pct_life_remaining, round(upb_pct_remaining, 6) AS upb_pct_remaining,
 round(rate_spread, 6) AS rate_spread, modified AS was_modified, loan_age_bucket FROM joined""", "joined")
    q["vintage_regime"] = sql(
        f"SELECT {_L}, orig_year, econ_regime, is_bubble_vintage, is_gfc_vintage, is_post_gfc FROM featured", "featured")
    q["missing_indicators"] = sql(f"""
SELECT {_L}, CAST(score IS NULL AS INTEGER) AS CREDIT_SCORE_MISSING, CAST(dti IS NULL AS INTEGER) AS ORIG_DTI_MISSING,
 CAST(ltv IS NULL AS INTEGER) AS ORIG_LTV_MISSING, CAST(cltv IS NULL AS INTEGER) AS ORIG_CLTV_MISSING,
 CAST(mi IS NULL AS INTEGER) AS MI_PCT_MISSING FROM orig""", "orig")
    q["impute"] = sql(f"""
SELECT {_L}, coalesce(score, -1) AS CREDIT_SCORE, coalesce(ltv, -1) AS ORIG_LTV, coalesce(cltv, -1) AS ORIG_CLTV,
 coalesce(dti, -1) AS ORIG_DTI, coalesce(mi, -1) AS MI_PCT, coalesce(state, 'UNKNOWN') AS PROPERTY_STATE FROM orig""", "orig")
    numbers = ",\n ".join(_model_number(*pair) for pair in _MODEL_NUMBERS)
    categories = ", ".join(f"{source} AS {name}" for name, source in _MODEL_CATEGORIES)
    q["modeling_join"] = sql(f"SELECT {_K}, label_back AS TARGET_12M, {numbers}, {categories} FROM joined", "joined")
    q["basic_modeling"] = sql(f"""
SELECT {_L}, label_back AS TARGET_12M, age AS loan_age_months, coalesce(is_high_ltv, 0) AS is_high_ltv,
 coalesce(is_high_dti, 0) AS is_high_dti, CAST(has_mi AS DOUBLE) AS has_mi, coalesce(score, -1) AS CREDIT_SCORE,
 CAST(score IS NULL AS DOUBLE) AS CREDIT_SCORE_MISSING, CAST(mi IS NULL AS INTEGER) AS MI_PCT_MISSING,
 max_delinq_12m FROM joined""", "joined")
    q["split_oos"] = sql(f"SELECT {_L}, split_oos FROM split", "split")
    q["split_oot"] = sql(f"SELECT {_L}, orig_year, split_oot FROM split", "split")
    q["split_counts"] = sql("""
SELECT split_part, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_defaults FROM (
 SELECT 'oos_' || split_oos AS split_part, y FROM split
 UNION ALL SELECT 'oot_' || split_oot, y FROM split WHERE split_oot IS NOT NULL) GROUP BY split_part""", "split")
    q["split_fan_out"] = sql("""
SELECT split_part, loan AS LOAN_SEQUENCE_NUMBER, y FROM (
 SELECT 'oos_' || split_oos AS split_part, loan, y FROM split
 UNION ALL SELECT 'oot_' || split_oot, loan, y FROM split WHERE split_oot IS NOT NULL)""", "split")
    q["training_frame"] = sql("""
SELECT loan AS LOAN_SEQUENCE_NUMBER, split_oot IS DISTINCT FROM 'train' AS is_validation FROM split
WHERE split_oot = 'train' OR split_oos = 'val'""", "split")
    q["holdout"] = sql("""
SELECT loan AS LOAN_SEQUENCE_NUMBER, ('0x' || substr(md5(loan || '|holdout|42'), 1, 8))::BIGINT % 100 < 20 AS is_validation
FROM split WHERE split_oot = 'train'""", "split")
    q["ordinal_encode"] = sql(_ENCODED, "split")
    q["class_imbalance"] = sql("""
SELECT split_oot, count(*) FILTER (WHERE y = 0) AS n_neg, count(*) FILTER (WHERE y = 1) AS n_pos,
 round(count(*) FILTER (WHERE y = 0) / greatest(count(*) FILTER (WHERE y = 1), 1), 6) AS imbalance_ratio
FROM split GROUP BY split_oot""", "split")
    q["score_points"] = sql(f"SELECT model, split, {_L}, p, score FROM points", "points")
    q["risk_bucket"] = sql(f"""
SELECT model, split, {_L}, score, score_bucket, risk_bucket FROM points JOIN bands ON score BETWEEN lo AND hi""",
                           "points", "bands")
    q["action_lookup"] = sql("""
SELECT risk_bucket, business_action, count(*) AS n FROM points JOIN bands ON score BETWEEN lo AND hi
GROUP BY risk_bucket, business_action""", "points", "bands")
    q["score_distribution"] = sql(""",
filled AS (SELECT g.model, g.split, b.score_bucket, count(score) AS n_loans, avg(score) AS mean_score, min(score) AS min_score,
  max(score) AS max_score, round_even(100*avg(y), 2) AS default_rate_pct
 FROM (SELECT DISTINCT model, split FROM scored) g CROSS JOIN bands b
 LEFT JOIN points p ON p.model = g.model AND p.split = g.split AND p.score BETWEEN b.lo AND b.hi
 GROUP BY g.model, g.split, b.score_bucket)
SELECT model, split, score_bucket, n_loans, round(mean_score, 6) AS mean_score, min_score, max_score, default_rate_pct,
 round_even(100.0*n_loans/sum(n_loans) OVER (PARTITION BY model, split), 1) AS pct_of_total FROM filled""", "points", "bands")
    q["confusion_metrics"] = sql("SELECT model, split, TP, TN, FP, FN, precision, recall, f1 FROM metrics", "metrics")
    q["brier"] = sql("SELECT model, split, brier_score FROM metrics", "metrics")
    q["auc_gini"] = sql("SELECT model, split, round(auc, 9) AS auc_roc, round(2*auc-1, 9) AS gini FROM aucs", "aucs")
    q["ks_stat"] = sql("SELECT model, split, round(ks, 9) AS ks_stat FROM gaps", "gaps")
    q["average_precision"] = sql("SELECT model, split, round(ap, 9) AS auc_pr FROM gaps", "gaps")
    q["metric_rows"] = sql("SELECT * FROM metrics", "metrics")
    q["roc_points"] = sql(
        f"SELECT model, split, threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM ({_ROC})", "curve")
    q["pr_points"] = sql("""
SELECT model, split, p AS threshold, round(cpos/(cpos+cneg), 9) AS precision, round(cpos/tpos, 9) AS recall FROM curve
UNION ALL SELECT DISTINCT model, split, NULL, 1.0, 0.0 FROM curve""", "curve")
    q["ks_decile"] = sql(_DECILES, "scored")
    q["psi_bins"] = sql(_PSI_BINS + """
SELECT model, bin, n_expected, n_actual, round(e, 9) AS share_expected, round(a, 9) AS share_actual,
 round((a-e)*ln(a/e), 9) AS contribution FROM shares""", "scored")
    q["psi"] = sql(_PSI_BINS + """
SELECT model, round(psi, 9) AS psi, CASE WHEN psi < 0.10 THEN 'STABLE' WHEN psi < 0.25 THEN 'MODERATE SHIFT'
 ELSE 'SIGNIFICANT SHIFT' END AS status
FROM (SELECT model, sum((a-e)*ln(a/e)) AS psi FROM shares GROUP BY model)""", "scored")
    q["score_histogram"] = sql(_histogram("score", "300.0::DOUBLE", "900.0::DOUBLE", 30, "points", "split = 'oot'"), "points")
    q["probability_histogram"] = sql(_histogram(
        "p", "0.0::DOUBLE", "1.0::DOUBLE", 20, "(SELECT model, p, split AS y FROM scored)", "TRUE"), "scored").replace(
        "y, bin, round", "y AS split, bin, round")
    q["outcome_histogram"] = sql(_histogram("score", "min(v)", "max(v)", 30, "points", "split = 'oot'"), "points")
    q["exact_quantiles"] = sql("""
SELECT model, split, round(quantile_cont(p, 0.25), 9) AS q25, round(quantile_cont(p, 0.5), 9) AS q50,
 round(quantile_cont(p, 0.9), 9) AS q90 FROM scored GROUP BY model, split""", "scored")
    q["metric_pivot"] = sql("""
SELECT model, max(auc_roc) FILTER (WHERE split='oos') AS oos_auc_roc, max(ks_stat) FILTER (WHERE split='oos') AS oos_ks_stat,
 max(auc_roc) FILTER (WHERE split='oot') AS oot_auc_roc, max(ks_stat) FILTER (WHERE split='oot') AS oot_ks_stat
FROM metrics GROUP BY model""", "metrics")
    q["stability_drop"] = sql("""
SELECT model, a AS oos_auc, b AS oot_auc, round(a-b, 9) AS auc_drop, CAST(coalesce(a-b > 0.05, false) AS INTEGER) AS high_degradation
FROM (SELECT model, max(auc_roc) FILTER (WHERE split='oos') AS a, max(auc_roc) FILTER (WHERE split='oot') AS b
 FROM metrics GROUP BY model)""", "metrics")
    q["comparison_table"] = sql("""
SELECT model, split, n_total, default_rate_pct, auc_roc, gini, ks_stat, auc_pr, f1 FROM metrics
ORDER BY split, auc_roc DESC, model""", "metrics")
    q["model_ranking"] = sql("""
SELECT model, auc_roc, gini, ks_stat FROM metrics WHERE split = 'oot' ORDER BY auc_roc DESC, model""", "metrics")
    q["best_model"] = sql("""
SELECT model, split, auc_roc, gini, ks_stat FROM metrics WHERE split = 'oot' ORDER BY auc_roc DESC, model LIMIT 1""", "metrics")
    q["ensemble_weights"] = sql("""
SELECT split, model, round(auc/sum(auc) OVER (PARTITION BY split), 9) AS weight FROM aucs""", "aucs")
    q["ensemble_scores"] = sql("""
SELECT split, loan AS LOAN_SEQUENCE_NUMBER, y, round(sum(p*auc)/sum(auc), 6) AS p,
 CAST(round(sum(p*auc)/sum(auc), 6) >= 0.5 AS INTEGER) AS predicted
FROM scored JOIN aucs USING (model, split) GROUP BY split, loan, y""", "scored", "aucs")
    return q
