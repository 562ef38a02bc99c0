"""DuckDB oracles of the reports, written straight from the metric definitions in one aggregation step."""

from __future__ import annotations

from workload.views import accounts_sql, fact_sql

# Industry names of the published reports.
ALL11 = "('金融','教育','家居','房产','大交通','医药','运营商','商务服务','招商加盟','旅游','本地生活')"
SIX = "('金融','教育','家居','房产','大交通','医药')"
FOUR = "('家居','房产','大交通','医药')"
OK = "(a.no_compensation_type = 0 or a.no_compensation_type is null)"
FLAGS2 = "not a.is_rta_dpa_ad and a.is_ocpx and a.auto_acquisition_status = 0"

SUMS = """max(case when bid_strategy = 2 then 1 else 0 end) as use1,
    max(case when deep_stage_status = 2 then 1 else 0 end) as dbl,
    sum(valid_exposure_cnt) as exposure, sum(valid_click_cnt) as click, sum(real_cost_micros) as micros,
    sum(conv1) as c1, sum(conv2) as c2, sum(target1_click) as t1, sum(target2_click) as t2,
    sum(gmv) as g1, sum(second_gmv) as g2, sum(gmv_exp_d) as gexp,
    sum(pcvr1) as p1, sum(pcvr2) as p2, sum(pctr) as pctr_sum,
    sum(gsp_factor_sum) / nullif(sum(case when bid_type = 4 then valid_exposure_cnt else valid_click_cnt end), 0) as gsp,
    sum(gsp_exposure_factor) / nullif(sum(gsp_exposure_cnt), 0) as rgsp"""

FLAGS = """case when bias between -(case when use1 = 1 then 0.3 else 0.2 end)::double
      and (case when use1 = 1 then 0.3 else 0.2 end)::double then 1 else 0 end as reach,
    case when bias <= (case when use1 = 1 then 0.3 else 0.2 end)::double then 1 else 0 end as below,
    case when conv = 0 then 1 else 0 end as e0, case when conv <= 2 then 1 else 0 end as e2"""

CLASSIC = """sum(micros * reach) / nullif(sum(micros), 0) as achieve_rate,
    sum(micros * below) / nullif(sum(micros), 0) as below_rate,
    sum(micros * e0) / nullif(sum(micros), 0) as ec_rate_0,
    sum(micros * e2) / nullif(sum(micros), 0) as ec_rate_2,
    sum(micros) / 1000000 as cost, sum(gm) / {gmv_scale} as "GMV",
    cast(sum(click) as bigint) as click_num, cast(sum(conv) as bigint) as conversion_num,
    sum(pc) / 1000000 / nullif(sum(click), 0) as pcvr, sum(conv) / nullif(sum(click), 0) as cvr,
    sum(pc) / 1000000 / nullif(sum(click), 0) / nullif(sum(conv) / nullif(sum(click), 0), 0) - 1 as pcvr_bias,
    sum(pctr_sum) / 1000000 / 1000000 / nullif(sum(exposure), 0) as pctr,
    sum(click) / nullif(sum(exposure), 0) as ctr,
    sum(pctr_sum) / 1000000 / 1000000 / nullif(sum(exposure), 0)
      / nullif(sum(click) / nullif(sum(exposure), 0), 0) - 1 as pctr_bias,
    sum(cast(gsp * click as decimal(28,9)))::double / nullif(sum(click), 0) as gsp_factor,
    sum(cast(rgsp * click as decimal(28,9)))::double / nullif(sum(click), 0) as real_gsp_factor"""

RATES = ["achieve_rate", "below_rate", "ec_rate_0", "ec_rate_2", "pcvr", "cvr", "pcvr_bias", "pctr", "ctr",
         "pctr_bias", "gsp_factor", "real_gsp_factor"]
MONEY = ["cost", "GMV"]
COUNTS = ["ad_num", "click_num", "conversion_num"]


def rounded(sql: str, keep: list[str], rates: list[str], money: list[str]) -> str:
    cols = [f'"{c}"' for c in keep]
    cols += [f'floor("{c}" * 1e6 + 0.5) / 1e6 as "{c}"' for c in rates]
    cols += [f'floor("{c}" * 1e2 + 0.5) / 1e2 as "{c}"' for c in money]
    return f"select {', '.join(cols)} from (\n{sql}\n) r"


def flagged(ads: str, gen: int, extra: str = "") -> str:
    gm = "case when second_goal = 0 then g1 else g2 end" if gen == 1 else "gexp"
    return f"""select *, {FLAGS} from (
  select *, {extra} case when second_goal = 0 then c1 else c2 end as conv,
    case when second_goal = 0 then p1 else p2 end as pc, {gm} as gm,
    case when second_goal = 0
      then (micros / 10000 / nullif(c1, 0)) / nullif(t1 / nullif(click, 0), 0) - 1
      else (micros / 10000 / nullif(c2, 0)) / nullif(t2 / nullif(click, 0), 0) - 1 end as bias
  from ({ads}) s) f"""


def classic(ads: str, keys: str, gen: int, extra: str = "", spending_only: bool = False) -> str:
    ad_num = "cast(sum(case when micros > 0 then 1 else 0 end) as bigint)" if spending_only else "count(*)"
    metrics = CLASSIC.format(gmv_scale=100 if gen == 1 else 1000000)
    return f"select {keys}, {ad_num} as ad_num, {metrics} from ({flagged(ads, gen, extra)}) x group by {keys}"


VALID = "micros > 0 and click > 0 and ((dbl = 1 and t2 > 0) or t1 > 0)"


def with_base(body: str, monthly: bool = True, day: str = "partition_date") -> str:
    return f"with fact as ({fact_sql(monthly)}),\nacc as ({accounts_sql(monthly, day)})\n{body}"


def code(col: str) -> str:
    return (f"case {col} when '金融' then 'finance' when '教育' then 'education' when '房产' then 'property' "
            f"when '家居' then 'furnishing' when '医药' then 'medicine' when '大交通' then 'car' when '运营商' then 'yys' "
            f"when '商务服务' then 'zsfw' when '招商加盟' then 'zsjm' when '旅游' then 'ly' when '本地生活' then 'bdsh' end")


def gen_filter(gen: int, channel: str) -> str:
    site = "a.site_set = 21" if channel == "mp" else "a.site_set <> 21"
    base = f"{site} and {OK} and a.second_goal <> 106"
    return base if gen == 1 else f"{base} and a.first_goal > 0 and a.first_goal <> 7 and {FLAGS2}"


HISTORY = ["partition_date", "process_date", "table_id", "op_industry"]


def _same_day_body(gen: int, channel: str) -> str:
    ads = f"""select a.partition_date as run, adgroup_id, b.industry_group as ind, second_goal, {SUMS}
      from fact a join acc b on a.partition_date = b.imp_date and a.advertiser_id = b.account_id
      where b.industry_group in {ALL11} and {gen_filter(gen, channel)} group by 1, 2, 3, 4"""
    if gen == 1:
        ads = f"select * from ({ads}) v where {VALID}"
    return f"""select run as partition_date, run as process_date, 2 as table_id, {code('ind')} as op_industry, *
      exclude (run, ind) from ({classic(ads, 'run, ind', gen, spending_only=gen == 2)}) h"""


def _retro_body(gen: int, channel: str) -> str:
    pd, cd = (f"make_date(cast({c} // 10000 as int), cast({c} // 100 % 100 as int), cast({c} % 100 as int))"
              for c in ("a.partition_date", "a.process_date"))
    ads = f"""select run, adgroup_id, ind, second_goal, {SUMS} from (
        select a.*, b.industry_group as ind, {pd} as acc_day,
          {cd} + (case when b.industry_group = '金融' then 2 else 1 end) as run
        from fact a join acc b on a.process_date = b.imp_date and a.advertiser_id = b.account_id
        where b.industry_group in {ALL11} and {gen_filter(gen, channel)} and {pd} >= {cd}
      ) w where acc_day <= run group by 1, 2, 3, 4"""
    if gen == 1:
        ads = f"select * from ({ads}) v where {VALID}"
    lag = "(case when ind = '金融' then 2 else 1 end)"
    as_int = lambda d: f"cast(year({d}) * 10000 + month({d}) * 100 + day({d}) as int)"
    return f"""select {as_int('run')} as partition_date, {as_int(f'(run - {lag})')} as process_date, 1 as table_id,
      {code('ind')} as op_industry, * exclude (run, ind)
      from ({classic(ads, 'run, ind', gen, spending_only=gen == 2)}) h"""


def same_day(gen: int, channel: str, monthly: bool | str = True) -> str:
    return rounded(with_base(_same_day_body(gen, channel), monthly), HISTORY + COUNTS, RATES, MONEY)


def retro(gen: int, channel: str, monthly: bool | str = False) -> str:
    return rounded(with_base(_retro_body(gen, channel), monthly, "process_date"), HISTORY + COUNTS, RATES, MONEY)


def multi_trace() -> str:
    names = ("case op_industry when 'finance' then '金融' when 'education' then '教育' when 'property' then '房产' "
             "when 'medicine' then '医药' when 'car' then '大交通' end")
    body = f"""select * exclude (op_industry), {names} as op_industry from (
      ({_retro_body(1, 'gdt')}) union all by name ({_same_day_body(1, 'gdt')})) u"""
    return rounded(with_base(body, False, "process_date").replace(
        "acc as (", f"acc as ({accounts_sql(False)} union "), HISTORY + COUNTS, RATES, MONEY)


def active_bucket(hi: int, lo: int) -> str:
    def beyond(k: int) -> str:
        return (f"(second_goal = 0 and (c1 > {k} or micros / 10000 > {k} * t1 / nullif(click, 0))) or "
                f"(second_goal > 0 and (c2 > {k} or micros / 10000 > {k} * t2 / nullif(click, 0)))")
    return (f"case when {beyond(hi)} then '转化大于{hi}' when {beyond(lo)} then '转化大于{lo}小于等于{hi}' "
            f"else '转化小于等于{lo}' end as active_bucket,")


def sub_industry_buckets(only: str | None = None) -> str:
    ads = f"""select a.partition_date, adgroup_id, b.industry_group as op_industry,
        b.industry_team_level2 as op_industry2, second_goal, {SUMS}
      from fact a join acc b on a.partition_date = b.imp_date and a.advertiser_id = b.account_id
      where b.industry_group in {SIX} and a.site_set <> 21 and {OK} and second_goal <> 106
      group by 1, 2, 3, 4, 5"""
    keys = "partition_date, op_industry, op_industry2, active_bucket"
    body = classic(f"select * from ({ads}) v where micros > 0 and click > 0", keys, 2, active_bucket(10, 2))
    if only:
        body = f"select * from ({body}) o where op_industry = '{only}'"
    return rounded(with_base(body), keys.split(", ") + COUNTS, RATES, MONEY)


def medicine() -> str:
    ads = f"""select a.partition_date, adgroup_id, b.industry_team_level2 as op_industry2, second_goal, {SUMS}
      from fact a join acc b on a.partition_date = b.imp_date and a.advertiser_id = b.account_id
      where b.industry_group = '医药' and {gen_filter(1, 'gdt')} group by 1, 2, 3, 4"""
    keys = "partition_date, op_industry2"
    return rounded(with_base(classic(f"select * from ({ads}) v where {VALID}", keys, 1)),
                   keys.split(", ") + COUNTS, RATES, MONEY)


def bulk() -> str:
    ads = f"""select adgroup_id, b.industry_group as op_industry, b.industry_team_level2 as op_industry2,
        first_goal, second_goal, {SUMS}
      from fact a join acc b on a.partition_date = b.imp_date and a.advertiser_id = b.account_id
      where b.industry_group in {FOUR} and a.site_set <> 21 group by 1, 2, 3, 4, 5"""

    def off(limit: str) -> str:
        return (f"(second_goal = 0 and abs(p1 / 1000000 / nullif(c1, 0) - 1) > {limit}) or "
                f"(second_goal > 0 and abs(p2 / 1000000 / nullif(c2, 0) - 1) > {limit})")
    extra = f"""{active_bucket(30, 6)} case when second_goal = 0 then first_goal else second_goal end as og,
      case when (second_goal = 0 and c1 = 0) or (second_goal > 0 and c2 = 0) then '偏差大于20'
        when {off('0.2::double')} then '偏差大于20' when {off('0.1::double')} then '偏差大于10小于等于20'
        else '偏差小于等于10' end as bias_bucket,"""
    keys = "op_industry, op_industry2, active_bucket, og, bias_bucket"
    return rounded(with_base(classic(f"select * from ({ads}) v where micros > 0", keys, 1, extra)),
                   keys.split(", ") + COUNTS, RATES, MONEY)


def housing() -> str:
    ads = f"""select a.partition_date, adgroup_id, second_goal, {SUMS}
      from fact a join acc b on a.partition_date = b.imp_date and a.advertiser_id = b.account_id
      where a.site_set <> 21 and first_goal = 104 and second_goal = 106 group by 1, 2, 3"""
    extra = """case when c2 = 0 then '偏差大于20' when abs(p2 / 1000000 / nullif(c2, 0) - 1) > 0.2::double then '偏差大于20'
      when abs(p2 / 1000000 / nullif(c2, 0) - 1) > 0.1::double then '偏差大于10小于等于20'
      else '偏差小于等于10' end as bias_bucket,"""
    return rounded(with_base(classic(ads, "bias_bucket", 1, extra)), ["bias_bucket"] + COUNTS, RATES, MONEY)


def retention() -> str:
    deep = "case when action_type in (104, 105) then vt_smart_deep_pcvr else 0 end"
    pd, cd = (f"make_date(cast({c} // 10000 as int), cast({c} // 100 % 100 as int), cast({c} % 100 as int))"
              for c in ("partition_date", "process_date"))
    body = f"""select process_date, advertiser_industry, (sum(v0) + sum(v1)) / 1000000 as total_cost,
      sum(v0) / 1000000 as sum_cost_v0, sum(v1) / 1000000 as sum_cost_v1,
      cast(sum(exposure) as bigint) as exposure_cnt, cast(sum(click) as bigint) as click_cnt,
      cast(sum(c1) as bigint) as active_num, cast(sum(c1_first) as bigint) as first_day_active_num,
      cast(sum(c2) as bigint) as retain_num, sum(deep) / 1000000 as pdcvr_retain_num,
      sum(deep_first) / 1000000 as first_day_pdcvr_retain_num,
      sum(below * v0) / 1000000 as below_rate_cost, sum(below * v0) / nullif(sum(v0), 0) as below_rate,
      sum(dcvr * below * v0) / 1000000 as dcvr_reached_cost,
      sum(dcvr * below * v0) / nullif(sum(v0), 0) as dcvr_reach_rate
    from (select *,
        case when (micros / 10000 / nullif(c1, 0)) / nullif(t1 / nullif(click, 0), 0) - 1
          <= (case when use1 = 1 then 0.3 else 0.2 end)::double then 1 else 0 end as below,
        case when c2 / nullif(deep_first, 0) / 1000000
          >= tv2 / nullif(click + exposure, 0) / 100 / nullif(s2, 0) / nullif(100 * base2, 0) then 1 else 0 end as dcvr
      from (select process_date, adgroup_id, b.industry_group as advertiser_industry, b.industry_team_level2,
          advertiser_id, first_goal, second_goal, bid_strategy, auto_acquisition_status,
          max(case when bid_strategy = 2 then 1 else 0 end) as use1, sum(real_cost_micros) as micros,
          sum(case when auto_acquisition_status <> 1 then real_cost_micros else 0 end) as v0,
          sum(case when auto_acquisition_status = 1 then real_cost_micros else 0 end) as v1,
          sum(valid_exposure_cnt) as exposure, sum(valid_click_cnt) as click, sum(conv1) as c1, sum(conv2) as c2,
          sum(case when partition_date = process_date then conv1 else 0 end) as c1_first,
          sum(target1_click) as t1, sum(target_cpa_v2) as tv2, sum(ocpa_second_target_cpa) as s2,
          sum(case when bid_type = 1 then valid_click_cnt else valid_exposure_cnt end) as base2,
          sum({deep}) as deep, sum(case when partition_date = process_date then {deep} else 0 end) as deep_first
        from fact a join acc b on a.partition_date = b.imp_date and a.advertiser_id = b.account_id
        where second_goal = 106 and a.site_set <> 21 and {OK} and b.industry_group in {FOUR}
          and {pd} - {cd} between 0 and 1
        group by 1, 2, 3, 4, 5, 6, 7, 8, 9) s) f
    group by 1, 2"""
    return rounded(
        with_base(body, False),
        ["process_date", "advertiser_industry", "exposure_cnt", "click_cnt", "active_num", "first_day_active_num", "retain_num"],
        ["below_rate", "dcvr_reach_rate", "pdcvr_retain_num", "first_day_pdcvr_retain_num"],
        ["total_cost", "sum_cost_v0", "sum_cost_v1", "below_rate_cost", "dcvr_reached_cost"],
    )


def retention_detail() -> str:
    """Ad-level retention measures of a cohort day."""
    deep = "case when action_type in (104, 105) then vt_smart_deep_pcvr else 0 end"
    pd, cd = (f"make_date(cast({c} // 10000 as int), cast({c} // 100 % 100 as int), cast({c} % 100 as int))"
              for c in ("partition_date", "process_date"))
    body = f"""select process_date, industry, sub_industry, advertiser_id, adgroup_id, first_goal, second_goal, bid_strategy,
      auto_acquisition_status, micros / nullif(1000000.0 * c1, 0) as cpa1, micros / nullif(1000000.0 * traced, 0) as cpa2,
      s2 / nullif(100.0 * base2, 0) as valid_tcpa2, p1 / 1000000 as pcvr1_sum, deep / 1000000 as pdcvr_retain_num,
      c1 * p2 * 1000000.0 / nullif(p1, 0) as div_pcvr_retain_num
    from (select process_date, adgroup_id, b.industry_group as industry, b.industry_team_level2 as sub_industry,
        advertiser_id, first_goal, second_goal, bid_strategy, auto_acquisition_status,
        sum(real_cost_micros) as micros, sum(conv1) as c1, sum(case when action_type = 106 then trace_cnt else 0 end) as traced,
        sum(ocpa_second_target_cpa) as s2,
        sum(case when bid_type = 1 then valid_click_cnt else valid_exposure_cnt end) as base2,
        sum(valid_click_smart_pcvr) as p1, sum(vc_ltv_info_smart_pcvr2) as p2, sum({deep}) as deep
      from fact a join acc b on a.partition_date = b.imp_date and a.advertiser_id = b.account_id
      where second_goal = 106 and a.site_set <> 21 and {OK} and b.industry_group in {FOUR}
        and {pd} - {cd} between 0 and 1
      group by 1, 2, 3, 4, 5, 6, 7, 8, 9) s"""
    return rounded(
        with_base(body, False),
        ["process_date", "industry", "sub_industry", "advertiser_id", "adgroup_id", "first_goal", "second_goal", "bid_strategy",
         "auto_acquisition_status"],
        ["cpa1", "cpa2", "valid_tcpa2", "pcvr1_sum", "pdcvr_retain_num", "div_pcvr_retain_num"], [],
    )


# --- new definition -------------------------------------------------------------------------------

def _gen1_rows() -> str:
    return f"""select *, case when second_goal = 0 then tc1 when second_goal > 1 then tc2 else 0 end as target_cpa,
        conversions * (case when second_goal = 0 then tc1 when second_goal > 1 then tc2 else 0 end) as gmvc,
        case when second_goal = 0 then p1 when second_goal > 1 then p2 else 0 end as pcvr_m,
        case when second_goal = 0 then p1 when second_goal > 1 then p2 else 0 end / 1000000 as pcvr,
        pctr_sum / 1000000 / 1000000 as pctr, 1 as ad_cnt,
        case when second_goal = 0 then b1 else b2 end as bias
      from (select a.partition_date, b.industry_group as op_industry, b.industry_team_level2 as op_industry2,
          b.op_sub_brand as sub_brand, advertiser_id, product_id, adgroup_id, first_goal, second_goal,
          case when second_goal > 0 then second_goal else first_goal end as optimization_goal, {SUMS},
          sum(case when second_goal > 0 then conv2 else conv1 end) as conversions,
          sum(target_cpa_v2) / 100 / nullif(sum(valid_exposure_cnt + valid_click_cnt), 0) as tc1,
          sum(ocpa_second_target_cpa) / 100 / nullif(sum(case when bid_type = 1 then valid_click_cnt
            when bid_type = 4 then valid_exposure_cnt else 0 end), 0) as tc2,
          (sum(real_cost_micros) / 10000 / nullif(sum(conv1), 0))
            / nullif(sum(target1_click) / nullif(sum(valid_click_cnt), 0), 0) - 1 as b1,
          (sum(real_cost_micros) / 10000 / nullif(sum(conv2), 0))
            / nullif(sum(target2_click) / nullif(sum(valid_click_cnt), 0), 0) - 1 as b2
        from fact a join acc b on a.partition_date = b.imp_date and a.advertiser_id = b.account_id
        where a.site_set <> 21 and {OK} and first_goal > 0 and b.industry_group in {ALL11}
        group by 1, 2, 3, 4, 5, 6, 7, 8, 9, 10) s
      where optimization_goal <> 106 and micros > 0 and click > 0 and ((dbl = 1 and tc2 > 0) or tc1 > 0)"""


def _gen2_rows(channel: str) -> str:
    site = "a.site_set = 21" if channel == "mp" else "a.site_set <> 21"
    return f"""select partition_date, op_industry, op_industry2, advertiser_id, sub_brand, product_id, adgroup_id,
        use_deep, second_goal, optimization_goal, use1, sum(micros) as micros, sum(click) as click,
        sum(exposure) as exposure, sum(conversions) as conversions,
        coalesce(sum(tc) / 100 / nullif(sum(click), 0), 0) as target_cpa, sum(gexp) / 1000000 as gmvc,
        sum(pc) as pcvr_m, sum(pctr_sum) as pctr_sum, sum(pc) / 1000000 as pcvr, sum(pctr_sum) / 1000000 as pctr,
        case when sum(micros) > 0 then adgroup_id else 0 end as ad_cnt,
        case when use_deep = 0 then b1 else b2 end as bias
      from (select a.partition_date, b.industry_group as op_industry, b.industry_team_level2 as op_industry2,
          b.op_sub_brand as sub_brand, advertiser_id, product_id, adgroup_id, second_goal, bid_strategy, first_goal,
          case when second_goal > 0 then 1 else 0 end as use_deep,
          case when second_goal > 0 then second_goal else first_goal end as optimization_goal, {SUMS},
          sum(case when second_goal > 0 then conv2 else conv1 end) as conversions,
          sum(case when second_goal > 0 then target2_click else target1_click end) as tc,
          sum(case when second_goal > 0 then pcvr2 else pcvr1 end) as pc,
          (sum(real_cost_micros) / 10000 / nullif(sum(conv1), 0))
            / nullif(sum(target1_click) / nullif(sum(valid_click_cnt), 0), 0) - 1 as b1,
          (sum(real_cost_micros) / 10000 / nullif(sum(conv2), 0))
            / nullif(sum(target2_click) / nullif(sum(valid_click_cnt), 0), 0) - 1 as b2
        from fact a join acc b on a.partition_date = b.imp_date and a.advertiser_id = b.account_id
        where b.industry_group in {ALL11} and {OK} and {site} and second_goal <> 106
          and first_goal not in (0, 7) and {FLAGS2}
        group by 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12) s
      group by partition_date, op_industry, op_industry2, advertiser_id, sub_brand, product_id, adgroup_id,
        use_deep, second_goal, optimization_goal, use1, b1, b2"""


def _detail(rows: str, fill: bool) -> str:
    cov = (lambda e: f"coalesce({e}, 0)") if fill else (lambda e: e)
    return f"""raw as (select *, concat_ws('_', advertiser_id, product_id, optimization_goal) as t_advertiser,
      micros / 1000000 as costs from ({rows}) r0),
    bias_by_account as (select partition_date, t_advertiser,
        case when sum(micros) > 0 then abs(sum(gmvc) / (sum(micros) / 1000000) - 1) end as ac_cpa_bias
      from raw group by partition_date, op_industry, op_industry2, t_advertiser),
    joined as (select raw.*, {cov('ac_cpa_bias')} as ac_cpa_bias,
        {cov('case when costs > 0 then abs(gmvc / costs - 1) end')} as ad_cpa_bias,
        case when target_cpa <= 0 or click <= 0 then 0 when costs / target_cpa < 0 then 0
          when costs / target_cpa < 1 then 1 when costs / target_cpa < 3 then 2
          when costs / target_cpa < 5 then 3 when costs / target_cpa < 10 then 4 else 5 end as active_interval
      from raw left join bias_by_account using (partition_date, t_advertiser)),
    detail as (select *, s_ad * s_adv as achieve from (select *,
        case when ad_cpa_bias >= 0 and ad_cpa_bias < ad_achieve_interval then 1 else 0 end as s_ad,
        case when ac_cpa_bias >= 0 and ac_cpa_bias < ac_achieve_interval then 1 else 0 end as s_adv,
        case when ac_cpa_bias >= 0 and ac_cpa_bias < 0.1::double then 1 else 0 end as s_acc,
        case when bias between -(case when use1 = 1 then 0.3 else 0.2 end)::double
          and (case when use1 = 1 then 0.3 else 0.2 end)::double then 1 else 0 end as reach,
        case when bias <= (case when use1 = 1 then 0.3 else 0.2 end)::double then 1 else 0 end as below,
        case when conversions > 10 or costs > 10 * target_cpa then 'over_10_conv' else 'below_10_conv' end as active_bucket
      from (select *, (case active_interval when 1 then 999999.99 when 2 then 1.0 when 3 then 0.6 when 4 then 0.2
            when 5 then 0.1 else 0 end)::double as ad_achieve_interval,
          (case when active_interval between 1 and 4 then 0.1 when active_interval = 5 then 999999.99
            else 0 end)::double as ac_achieve_interval from joined) j) d)"""


ROLL = """{num} as ad_num, sum(micros * achieve) / nullif(sum(micros), 0) as achieve_rate,
    sum(micros * s_ad) / nullif(sum(micros), 0) as ad_reach_rate,
    sum(micros * s_acc) / nullif(sum(micros), 0) as ac_reach_rate,
    sum(micros * reach) / nullif(sum(micros), 0) as reach_rate,
    sum(micros * below) / nullif(sum(micros), 0) as below_rate,
    sum(micros) / 1000000 as cost, sum(gmvc) as gmv, cast(sum(click) as bigint) as click_num,
    cast(sum(conversions) as bigint) as conversion_num, sum(pcvr_m) / 1000000 / nullif(sum(click), 0) as pcvr,
    sum(conversions) / nullif(sum(click), 0) as cvr,
    sum(pcvr_m) / 1000000 / nullif(sum(conversions), 0) - 1 as pcvr_bias,
    sum(pctr_sum) / {pctr_scale} / nullif(sum(exposure), 0) as pctr,
    sum(click) / nullif(sum(exposure), 0) as ctr,
    sum(pctr_sum) / {pctr_scale} / nullif(sum(click), 0) - 1 as pctr_bias,
    sum(gmvc) / nullif(sum(micros) / 1000000, 0) as gmv_to_cost"""
NEW_RATES = ["achieve_rate", "ad_reach_rate", "ac_reach_rate", "pcvr", "cvr", "pcvr_bias", "pctr", "ctr", "pctr_bias"]
NEW_MONEY = ["cost", "gmv"]


def _rows(which: str) -> tuple[str, bool, str]:
    if which == "gen1":
        return _gen1_rows(), False, "cast(sum(ad_cnt) as bigint)"
    return _gen2_rows(which), True, "count(distinct ad_cnt)"


def new_report(which: str, keys: str, rates: list[str], source: str = "detail", where: str = "true") -> str:
    rows, fill, num = _rows(which)
    return with_base(
        f", {_detail(rows, fill)} select {keys}, {ROLL.format(num=num, pctr_scale='1000000 / 1000000' if which == 'gen1' else '1000000')} from {source} where {where} group by all"
    ).replace("\n, raw", ",\nraw")


LOAN_UNION = ("(select * from detail union all by name "
              "select * exclude (op_industry), '贷款' as op_industry from detail where op_industry2 = '贷款') u")


def industry(which: str) -> str:
    body = new_report(which, "partition_date, op_industry", NEW_RATES, LOAN_UNION)
    return rounded(body, ["partition_date", "op_industry"] + COUNTS, NEW_RATES, NEW_MONEY)


def bucket(which: str) -> str:
    body = new_report(which, "partition_date, op_industry, active_bucket", NEW_RATES, LOAN_UNION)
    body = f"select * exclude (ad_reach_rate, reach_rate), reach_rate as ad_reach_rate from ({body}) q"
    return rounded(body, ["partition_date", "op_industry", "active_bucket"] + COUNTS, NEW_RATES, NEW_MONEY)


def sub_brand(which: str, brands: list[str], by_bucket: bool = False) -> str:
    names = ", ".join(f"'{b}'" for b in brands)
    keys = ["partition_date", "op_industry2", "sub_brand"] + (["active_bucket"] if by_bucket else [])
    body = new_report(which, ", ".join(keys), NEW_RATES, where=f"sub_brand in ({names})")
    rates = NEW_RATES + ["reach_rate", "below_rate"] + (["gmv_to_cost"] if by_bucket else [])
    return rounded(body, keys + COUNTS, rates, NEW_MONEY)


DETAIL_KEEP = ["partition_date", "op_industry", "op_industry2", "advertiser_id", "sub_brand", "product_id", "adgroup_id",
               "first_goal", "second_goal", "optimization_goal", "t_advertiser", "click", "exposure", "conversions",
               "active_interval", "achieve", "active_bucket", "reach", "below"]
DETAIL_RATES = ["target_cpa", "pcvr", "pctr", "ad_cpa_bias", "ac_cpa_bias", "ad_achieve_interval", "ac_achieve_interval"]


#: An industry whose ads have thresholds of their own, if that is asked for.
EDUCATION = "教育"


def detail(education: bool = False) -> str:
    common = "(case active_interval when 1 then"
    own = f"(case when op_industry = '{EDUCATION}' and active_interval between 1 and 4 then 999999.99 else {common}"
    ads = _detail(_gen1_rows(), False)
    if education:
        ads = ads.replace(common, own).replace("else 0 end)::double as ad_achieve_interval", "else 0 end) end)::double as ad_achieve_interval")
    body = with_base(f", {ads} select * replace (cast(click as bigint) as click, "
                     "cast(exposure as bigint) as exposure, cast(conversions as bigint) as conversions) from detail"
                     ).replace("\n, raw", ",\nraw")
    return rounded(body, DETAIL_KEEP, DETAIL_RATES, ["costs", "gmvc"])


def ad_counts() -> str:
    """Distinct counts of each roll-up on its own."""
    rollups = {
        "industry": ("partition_date", "op_industry"), "industry_bucket": ("partition_date", "op_industry", "active_bucket"),
        "sub_brand": ("partition_date", "op_industry2", "sub_brand"),
        "sub_brand_bucket": ("partition_date", "op_industry2", "sub_brand", "active_bucket"),
        "industry_all_days": ("op_industry",),
    }
    parts = []
    for name, keys in rollups.items():
        texts = " || '/' || ".join(f"coalesce({k}, '-')" for k in keys if k != "partition_date")
        day = "partition_date" if "partition_date" in keys else "0"
        source = LOAN_UNION if "op_industry" in keys else "detail"
        parts.append(f"select '{name}' as report, {day} as day, {texts} as of, count(distinct ad_cnt) as ad_num from {source} group by all")
    return with_base(f", {_detail(_gen2_rows('gdt'), True)} {' union all '.join(parts)}").replace("\n, raw", ",\nraw")


def key_mapping() -> str:
    return with_base(f""", {_detail(_gen1_rows(), False)}
      select distinct 'sku' as kind, product_id || ',' || sub_brand as key, advertiser_id from detail
      union all select distinct 'sub_brand', sub_brand, advertiser_id from detail""").replace("\n, raw", ",\nraw")


def achieve_cost() -> str:
    body = with_base(f""", {_detail(_gen1_rows(), False)}
      select advertiser_id, sub_brand, product_id as sku, optimization_goal as og,
        sum(micros * achieve) / 1000000 as achieve_cost from detail group by all""").replace("\n, raw", ",\nraw")
    return rounded(body, ["advertiser_id", "sub_brand", "sku", "og"], [], ["achieve_cost"])
