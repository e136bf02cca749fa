"""SQL twins of the queries, for DuckDB over the same Parquet tables."""

from __future__ import annotations

from creditloom import constants as K
from workload import views as V

FES = [f"fe_{i}" for i in range(1, 21)]
FE_LIST = ", ".join(FES)
BASE_END = "1998-01-01"


def _k(columns: str) -> str:
    return columns.replace("price", "o_totalprice")


_CUSTOMER_MONTHS = """(select o_custkey ck, cast(date_trunc('month',o_orderdate) as date) sd, min(o_orderkey) ok
 from orders group by 1,2) k join orders o on o.o_orderkey=k.ok"""
_NT = ["_", "NA", "na", "N/A"]


def _nt(c: str, tokens=_NT) -> str:
    listed = ",".join(f"'{t}'" for t in tokens)
    return f"case when {c} in ({listed}) then null else {c} end"


def _num(c: str, decimal: bool = True, tokens=_NT) -> str:
    kept, target = ("0-9.", "double") if decimal else ("0-9", "integer")
    return f"try_cast(regexp_replace({_nt(c, tokens)},'[^{kept}]','','g') as {target})"


_PB = (
    "'High_spent_Large_value_payments','High_spent_Medium_value_payments','High_spent_Small_value_payments',"
    "'Low_spent_Large_value_payments','Low_spent_Medium_value_payments','Low_spent_Small_value_payments'"
)
FIN_DOUBLES = [
    "Annual_Income",
    "Monthly_Balance",
    "Outstanding_Debt",
    "Amount_invested_monthly",
    "Changed_Credit_Limit",
    "Total_EMI_per_month",
    "Credit_Utilization_Ratio",
]
FIN_CAPPED = [
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries",
]
FIN_STRINGS = [
    "Annual_Income", "Num_of_Loan", "Type_of_Loan", "Num_of_Delayed_Payment", "Changed_Credit_Limit",
    "Credit_Mix", "Outstanding_Debt", "Credit_Utilization_Ratio", "Credit_History_Age",
    "Payment_of_Min_Amount", "Total_EMI_per_month", "Amount_invested_monthly", "Payment_Behaviour",
    "Monthly_Balance",
]


def _j(view: str, columns: str = "f.* exclude (snapshot_date)") -> str:
    return f"""select {columns}, f.snapshot_date feature_snapshot_date,
 case when l.dpd>=30 then 1 else 0 end label, l.snapshot_date label_snapshot_date
 from {view} f join s_loans l on l.Customer_ID=f.Customer_ID and l.mob=6
 and l.snapshot_date=cast(f.snapshot_date+to_months(6) as date)"""


def _cap(c: str) -> str:
    v = f"cast({c} as double)"
    return f"case when {v}<q.{c}_lo then q.{c}_lo when {v}>q.{c}_hi then q.{c}_hi else {v} end"


def _cap_stats(cols: list[str]) -> str:
    return ", ".join(
        f"quantile_disc(cast({c} as double),0.01) {c}_lo, quantile_disc(cast({c} as double),0.95) {c}_hi"
        for c in cols
    )


_MODEL_TYPE = "case when event_type in ('click','view') then 'logistic_regression' else 'gbt' end"
DECILES = "[0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]"

VIEWS: dict[str, tuple[str, list[str]]] = {
    "fx_loans": (
        """select cast(l.l_orderkey as varchar) loan_id, cast(o.o_custkey as varchar) Customer_ID,
 cast(o.o_orderdate as date) loan_start_date, 10 tenure, l.l_linenumber installment_num,
 l.l_extendedprice*10 loan_amt, l.l_extendedprice due_amt,
 case when l.l_returnflag='R' then cast(0.0 as double) else l.l_extendedprice end paid_amt,
 case when l.l_returnflag='R' then l.l_quantity*l.l_discount*l.l_extendedprice else cast(0.0 as double) end overdue_amt,
 l.l_extendedprice*(10-l.l_linenumber) balance,
 cast(date_trunc('month',o.o_orderdate)+to_months(l.l_linenumber) as date) snapshot_date
 from lineitem l join orders o on l.l_orderkey=o.o_orderkey""",
        [],
    ),
    "fx_fin": (f"select {_k(V.FINANCIAL_COLUMNS)} from {_CUSTOMER_MONTHS}", []),
    "fx_att": (f"select {V.ATTRIBUTE_COLUMNS} from {_CUSTOMER_MONTHS} join customer on c_custkey=ck", []),
    "fx_clk": (f"select {V.CLICKSTREAM_COLUMNS} from {_CUSTOMER_MONTHS}", []),
    "fx_runs": (
        f"""select 'run_' || cast(event_id as varchar) run_id, ts start_time,
 cast(cast(ts as date) as varchar) snapshot_date, {_MODEL_TYPE} model_type, value/500 auc,
 cast(event_id%37 as double)/100 psi_max from events""",
        [],
    ),
    "fx_artifacts": (
        f"""select distinct {_MODEL_TYPE} model_type, cast(cast(ts as date) as varchar) snapshot_date
 from events where isodow(ts)<6""",
        [],
    ),
    "fx_scored": (
        """select d.doc_id, d.lang model_name, cast(d.n_chars as double) prediction, l.quality label
 from documents d join labels l on d.doc_id=l.doc_id""",
        [],
    ),
    "fx_ml": (
        "select vec_id id, case when label<5 then 1 else 0 end label, "
        + ", ".join(f"cast(embedding[{i}] as double) fe_{i}" for i in range(1, 21))
        + " from embeddings",
        [],
    ),
    "fx_metrics": (
        """select run_id, snapshot_date, 'auc' metric_name, auc as "value" from fx_runs
 union all select run_id, snapshot_date, 'psi_max', psi_max from fx_runs""",
        ["fx_runs"],
    ),
    "s_loans": (
        """select * exclude (m), installment_num mob, m installments_missed, f first_missed_date,
 cast(case when overdue_amt>0 then date_diff('day', f, snapshot_date) else 0 end as integer) dpd
 from (select *, case when m>0 then cast(snapshot_date-to_months(m) as date) end f
 from (select *, cast(ceil(overdue_amt/nullif(due_amt,0)) as integer) m from fx_loans))""".replace(
            "* exclude (m)", "* exclude (m, f)"
        ),
        ["fx_loans"],
    ),
    "s_fin": (
        "select Customer_ID, snapshot_date, Monthly_Inhand_Salary, Num_Bank_Accounts, Num_Credit_Card,"
        " Interest_Rate, Num_Credit_Inquiries, "
        + ", ".join(f"{_num(c)} {c}" for c in FIN_DOUBLES)
        + f""", {_num('Num_of_Loan', False)} Num_of_Loan, {_num('Num_of_Delayed_Payment', False)} Num_of_Delayed_Payment,
 {_nt('Type_of_Loan')} Type_of_Loan, {_nt('Credit_Mix')} Credit_Mix,
 {_nt('Credit_History_Age')} Credit_History_Age, {_nt('Payment_of_Min_Amount')} Payment_of_Min_Amount,
 case when Payment_Behaviour in ({_PB}) then Payment_Behaviour end Payment_Behaviour,
 list_transform(regexp_split_to_array({_nt('Type_of_Loan')}, ', |, and '), lambda x: lower(trim(x))) Loan_Types_Array
 from fx_fin""",
        ["fx_fin"],
    ),
    "s_att": (
        f"""select Customer_ID, snapshot_date, Name, case when a>0 and a<100 then a end Age,
 case when regexp_full_match(s,'[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}') then s end SSN, Occupation
 from (select Customer_ID, snapshot_date, Name, {_num('Age', False, _NT + ['_______'])} a,
 {_nt('SSN', _NT + ['_______'])} s, {_nt('Occupation', _NT + ['_______'])} Occupation from fx_att)""",
        ["fx_att"],
    ),
    "j_fin": (_j("s_fin"), ["s_fin", "s_loans"]),
    "j_att": (_j("s_att"), ["s_att", "s_loans"]),
    "j_clk": (_j("fx_clk"), ["fx_clk", "s_loans"]),
}


def _fin_features(source: str, columns: str) -> str:
    capped = ", ".join(f"{_cap('b.' + c).replace('q.b.', 'q.')} {c}" for c in FIN_CAPPED)
    return f"""select {columns}, Credit_Mix, Payment_Behaviour, Payment_of_Min_Amount, Annual_Income,
 Monthly_Inhand_Salary, Num_of_Loan, Type_of_Loan, array_to_string(Loan_Types_Array,'|') Loan_Types_Array,
 Monthly_Balance, Amount_invested_monthly, Changed_Credit_Limit, Total_EMI_per_month, Credit_Utilization_Ratio,
 Outstanding_Debt, {", ".join(FIN_CAPPED)},
 y*12+coalesce(m,0) credit_history_months, cast(len(Loan_Types_Array) as integer) num_loan_types,
 round(ln(1+Annual_Income),9) log_Annual_Income,
 Outstanding_Debt/(Annual_Income+1) debt_to_income,
 Total_EMI_per_month/(Monthly_Inhand_Salary+1) emi_to_salary,
 Amount_invested_monthly/(Monthly_Inhand_Salary+1) investment_rate,
 cast(Changed_Credit_Limit<>0 as integer) has_credit_limit_change,
 (Monthly_Balance+1)/(Outstanding_Debt+1) balance_to_debt,
 Num_Credit_Inquiries/(Num_of_Loan+1) inq_per_loan
 from (select b.* exclude (Credit_Mix, Payment_Behaviour, Changed_Credit_Limit, Outstanding_Debt, {", ".join(FIN_CAPPED)}),
 coalesce(b.Credit_Mix,'Unknown') Credit_Mix, coalesce(b.Payment_Behaviour,'Unknown') Payment_Behaviour,
 coalesce(b.Changed_Credit_Limit,0) Changed_Credit_Limit, coalesce(b.Outstanding_Debt,q.med) Outstanding_Debt,
 {capped}, try_cast(regexp_extract(b.Credit_History_Age,'(\\d+)\\s+Years',1) as integer) y,
 try_cast(regexp_extract(b.Credit_History_Age,'(\\d+)\\s+Months',1) as integer) m
 from (select * from {source} where Monthly_Balance is not null) b,
 (select quantile_disc(Outstanding_Debt,0.5) med, {_cap_stats(FIN_CAPPED)} from {source}
 where Monthly_Balance is not null) q)"""


def _att_features(source: str, columns: str) -> str:
    return f"""select {columns}, Name, SSN, a Age, coalesce(Occupation,'Unknown') Occupation,
 case when a<25 then '<25' when a<40 then '25–39' when a<60 then '40–59' else '60+' end Age_group
 from (select *, case when Age between 18 and 75 then Age end a from {source})"""


def _clk_features(source: str, columns: str) -> str:
    capped = ", ".join(f"{_cap(c)} {c}" for c in FES)
    return f"select {columns}, {capped} from {source}, (select {_cap_stats(FES)} from {source}) q"


_PANEL = "Customer_ID, snapshot_date"
_LABELLED = "Customer_ID, feature_snapshot_date, label, label_snapshot_date"
_LONG_BASE = f"select feature, v from (unpivot (select {FE_LIST} from base) on {FE_LIST} into name feature value v)"
_LONG_CUR = (
    f"select snapshot_date, feature, v from (unpivot (select snapshot_date, {FE_LIST} from cur)"
    f" on {FE_LIST} into name feature value v)"
)
_BASE_CUR = f"""base as (select * from fx_clk where snapshot_date<date '{BASE_END}'),
 cur as (select * from fx_clk where snapshot_date>=date '{BASE_END}'),
 lb as ({_LONG_BASE}), lc as ({_LONG_CUR}),
 edges as (select feature, quantile_cont(cast(v as double),{DECILES}) e from lb group by 1)"""
_BIN = "case when v between e[1] and e[11] then len(list_filter(e[2:10], lambda x: x<=v)) else -1 end"
_PSI = f"""{_BASE_CUR},
 hb as (select feature, {_BIN} bin, count(*) n from lb join edges using (feature) group by 1,2),
 hc as (select snapshot_date, feature, {_BIN} bin, count(*) n from lc join edges using (feature) group by 1,2,3),
 tb as (select feature, sum(n) t from hb group by 1), tc as (select snapshot_date, feature, sum(n) t from hc group by 1,2),
 psi as (select tc.snapshot_date, tc.feature, sum((b-c)*ln(b/c)) psi from (
 select tc.snapshot_date, tc.feature, coalesce(cast(hb.n as double)/tb.t, 1e-8) b, coalesce(cast(hc.n as double)/tc.t, 1e-8) c
 from tc join tb using (feature) cross join range(10) r(bin)
 left join hb on hb.feature=tc.feature and hb.bin=r.bin
 left join hc on hc.feature=tc.feature and hc.bin=r.bin and hc.snapshot_date=tc.snapshot_date) tc group by 1,2)"""
_PSI_TOTAL = _PSI.replace("select snapshot_date, feature, v from (unpivot", "select date '2000-01-01' snapshot_date, feature, v from (unpivot")
_BEST = """best as (select * exclude (rk) from (select *, row_number() over (partition by snapshot_date
 order by auc desc, start_time desc, run_id) rk from fx_runs) where rk=1),
 prev as (select *, case when cast(p as date)>=cast(snapshot_date as date)-to_years(3) then p end fallback_snapshot
 from (select *, lag(snapshot_date) over (order by snapshot_date) p from best))"""
_AUC = """select {by}, (sum(case when label=1 then r end)-count_if(label=1)*(count_if(label=1)+1)/2.0)
 /(count_if(label=1)*count_if(label=0)) auc from (
 select {by}, label, rank() over (partition by {by} order by prediction)
 +(count(*) over (partition by {by}, prediction)-1)/2.0 r from {src}) group by 1"""
_SPLIT = "case when md5('42' || cast(id as varchar))<'33333333' then 'test' else 'train' end"
_SIGMOID = "1/(1+exp(-(0.1" + "".join(f"+{0.05 * i:.2f}*fe_{i}" for i in range(1, 21)) + ")))"


_COMPONENTS = """c as (select vec_id, 'e_' || i feature, cast(v as double) v from (
 select vec_id, unnest(embedding) v, generate_subscripts(embedding, 1) - 1 i from embeddings) where v is not null)"""
_COMPONENT_PSI = f"""with {_COMPONENTS},
 e as (select feature, quantile_cont(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) q from c
 where vec_id % 2 = 0 and vec_id % 7 <> 0 group by 1),
 b as (select vec_id % 2 = 0 base, feature, case when v between q[1] and q[11] then len(list_filter(q[2:10], lambda x: v >= x)) else -1 end bin
 from c join e using (feature) where vec_id % 7 <> 0),
 t as (select base, feature, count(*) t from b group by all), h as (select base, feature, bin, count(*) n from b group by all),
 s as (select t.base, t.feature, r.bin, coalesce(h.n / cast(t.t as double), 1e-8) s from t cross join range(10) r(bin)
 left join h on h.base = t.base and h.feature = t.feature and h.bin = r.bin)
 select x.feature, round(sum((x.s - y.s) * ln(x.s / y.s)), 9) psi from s x join s y on x.feature = y.feature and x.bin = y.bin
 where x.base and not y.base group by 1"""


def _component_quantiles(where: str) -> str:
    return f"""with {_COMPONENTS} select feature, cast(p as double) prob, case p when 0.01 then a when 0.5 then b else d end as "value" from (
 select feature, quantile_disc(v, 0.01) a, quantile_disc(v, 0.5) b, quantile_disc(v, 0.95) d from c where {where} group by 1)
 cross join (values (0.01), (0.5), (0.95)) x(p)"""


def _closure(names: list[str]) -> list[str]:
    ordered: list[str] = []
    for name in names:
        for needed in [*_closure(VIEWS[name][1]), name]:
            if needed not in ordered:
                ordered.append(needed)
    return ordered


def twin(names: str, body: str, extra: str = "") -> str:
    ctes = [f"{n} as ({VIEWS[n][0]})" for n in _closure(names.split())] + ([extra] if extra else [])
    return f"with {', '.join(ctes)}\n{body}"


_FIN_NT = ", ".join(f"{_nt(c)} {c}" for c in FIN_STRINGS)
_S_FIN_OUT = "* exclude (Loan_Types_Array), array_to_string(Loan_Types_Array,'|') Loan_Types_Array"
_JOINED_STORE = f"""ff as ({_fin_features('j_fin', _LABELLED)}), fa as ({_att_features('j_att', _LABELLED)}),
 fc as ({_clk_features('j_clk', _LABELLED)})"""
_STORE_COLUMNS = f"""Customer_ID, feature_snapshot_date, Num_Bank_Accounts, Num_Credit_Card, Interest_Rate,
 Num_of_Delayed_Payment, Changed_Credit_Limit, Num_Credit_Inquiries, Credit_Utilization_Ratio, Monthly_Balance,
 credit_history_months, num_loan_types, log_Annual_Income, debt_to_income, emi_to_salary, investment_rate,
 has_credit_limit_change, balance_to_debt, inq_per_loan, Occupation, Age_group, {FE_LIST}"""
_STORE = f"""select * exclude (label, label_snapshot_date) from (select {_STORE_COLUMNS}, label, label_snapshot_date, count(*) copies
 from ff join fa using (Customer_ID, feature_snapshot_date, label_snapshot_date, label)
 join fc using (Customer_ID, feature_snapshot_date, label_snapshot_date, label) group by all)"""
_CLK_ROUND = f"select Customer_ID, snapshot_date, {FE_LIST} from fx_clk"
_CAT_INDEX = """select feature, category, n, cast(row_number() over (partition by feature order by n desc, category)-1 as integer) as "index"
 from (select feature, category, count(*) n from ({rows}) where category is not null group by 1,2)"""


def oracle_sql() -> dict[str, str]:
    windows = """cast(oot_start-interval 12 month as date) train_test_start_date,
 cast(oot_start-interval 1 day as date) train_test_end_date, oot_start oot_start_date,
 cast(t-interval 1 day as date) oot_end_date from (select t, cast(t-interval 2 month as date) oot_start
 from (select max(snapshot_date) t from fx_clk))"""
    period = f"""w as (select {windows}), rows_ as (select f.*, case when snapshot_date between oot_start_date and
 oot_end_date then 'oot' when snapshot_date between train_test_start_date and train_test_end_date then 'train_test' end period
 from fx_clk f, w)"""
    labels = "labels_ as (select Customer_ID, loan_id, case when dpd>=30 then 1 else 0 end label, snapshot_date from s_loans where mob=6)"
    return {
        # scans and snapshots
        "scan_snapshot": twin("fx_clk", f"{_CLK_ROUND} where snapshot_date=date '1997-06-01'"),
        "latest_rows": twin("fx_clk", f"{_CLK_ROUND} where snapshot_date=(select max(snapshot_date) from fx_clk)"),
        "row_count": twin("fx_loans", "select count(*) n_rows from fx_loans"),
        "snapshot_dates": twin("fx_clk", "select distinct snapshot_date from fx_clk order by 1"),
        "snapshot_counts": twin("fx_clk", "select snapshot_date, count(*) n_rows from fx_clk group by 1"),
        "latest_snapshot": twin("fx_clk", "select max(snapshot_date) snapshot_date from fx_clk"),
        "month_spine": twin(
            "fx_loans",
            """select cast(unnest(generate_series(date_trunc('month',min(snapshot_date)),
 date_trunc('month',max(snapshot_date)), interval 1 month)) as date) snapshot_date from fx_loans""",
        ),
        "backfill_range": twin(
            "fx_clk",
            """select cast(unnest(generate_series(date_trunc('month',max(snapshot_date)-interval 12 month),
 date_trunc('month',max(snapshot_date)), interval 1 month)) as date) snapshot_date from fx_clk""",
        ),
        "split_windows": twin("fx_clk", f"select {windows}"),
        "as_of": twin("fx_clk", f"{_CLK_ROUND} where snapshot_date<=date '1997-06-01'"),
        "between_dates": twin(
            "fx_clk", f"{_CLK_ROUND} where snapshot_date between date '1996-01-01' and date '1996-12-31'"
        ),
        # cleaning
        "null_tokens": twin("fx_fin", f"select Customer_ID, snapshot_date, {_FIN_NT} from fx_fin"),
        "clean_numbers": twin(
            "fx_fin",
            f"""select Customer_ID, snapshot_date, {_num('Annual_Income')} Annual_Income,
 {_num('Amount_invested_monthly')} Amount_invested_monthly, {_num('Outstanding_Debt')} Outstanding_Debt,
 {_num('Num_of_Loan', False)} Num_of_Loan, {_num('Num_of_Delayed_Payment', False)} Num_of_Delayed_Payment from fx_fin""",
        ),
        "cast_columns": twin(
            "fx_fin",
            """select Customer_ID, snapshot_date, try_cast(Annual_Income as double) Annual_Income,
 try_cast(Num_of_Loan as integer) Num_of_Loan, cast(Interest_Rate as varchar) Interest_Rate from fx_fin""",
        ),
        "whitelist_behaviour": twin(
            "fx_fin",
            f"select Customer_ID, snapshot_date, case when Payment_Behaviour in ({_PB}) then Payment_Behaviour end Payment_Behaviour from fx_fin",
        ),
        "split_loan_types": twin(
            "s_fin",
            """select Customer_ID, snapshot_date, array_to_string(Loan_Types_Array,'|') loan_types,
 cast(len(Loan_Types_Array) as integer) n_types from s_fin""",
        ),
        "history_months": twin(
            "s_fin",
            """select Customer_ID, snapshot_date, try_cast(regexp_extract(Credit_History_Age,'(\\d+)\\s+Years',1) as integer)*12
 +coalesce(try_cast(regexp_extract(Credit_History_Age,'(\\d+)\\s+Months',1) as integer),0) history_months from s_fin""",
        ),
        "fill_defaults": twin(
            "s_fin",
            """select Customer_ID, snapshot_date, coalesce(Credit_Mix,'Unknown') Credit_Mix,
 coalesce(Payment_Behaviour,'Unknown') Payment_Behaviour, coalesce(Changed_Credit_Limit,0) Changed_Credit_Limit from s_fin""",
        ),
        "ratios_flags": twin(
            "s_fin",
            """select Customer_ID, snapshot_date, round(ln(1+Annual_Income),9) log_income,
 Outstanding_Debt/(Annual_Income+1) debt_to_income, (Monthly_Balance+1)/(Outstanding_Debt+1) balance_to_debt,
 cast(Changed_Credit_Limit<>0 as integer) limit_changed from s_fin""",
        ),
        "require_keys": twin(
            "s_att", "select Customer_ID, snapshot_date, SSN from s_att where Customer_ID is not null and SSN is not null"
        ),
        "require_measure": twin(
            "s_fin", "select Customer_ID, snapshot_date, Monthly_Balance from s_fin where Monthly_Balance is not null"
        ),
        "valid_age": twin("s_att", "select Customer_ID, snapshot_date, Age from s_att"),
        "valid_ssn": twin("s_att", "select Customer_ID, snapshot_date, SSN from s_att"),
        "clean_financials": twin("s_fin", f"select {_S_FIN_OUT} from s_fin"),
        "clean_attributes": twin("s_att", "select * from s_att"),
        "clean_clickstream": twin("fx_clk", _CLK_ROUND),
        "clean_loans": twin("s_loans", "select * from s_loans"),
        # attributes
        "age_bands": twin(
            "s_att",
            """select Customer_ID, snapshot_date, a age, case when a<25 then '<25' when a<40 then '25–39'
 when a<60 then '40–59' else '60+' end age_group
 from (select *, case when Age between 18 and 75 then Age end a from s_att)""",
        ),
        "category_index": twin(
            "s_att s_fin",
            _CAT_INDEX.format(
                rows="select 'Occupation' feature, Occupation category from s_att",
            ),
        ),
        "one_hot": twin(
            "s_att",
            """select Customer_ID, snapshot_date, Occupation, i occupation_position, n occupation_size from s_att
 left join (select category, row_number() over (order by c desc, category)-1 i from (select Occupation category, count(*) c
 from s_att where Occupation is not null group by 1)) on category=Occupation,
 (select cast(count(distinct Occupation) as integer) n from s_att)""",
        ),
        "one_hot_weighted": twin(
            "s_fin",
            "select Customer_ID, snapshot_date, " + ", ".join(
                f"(select i from idx where feature='{c}' and category=f.{c}) {c.lower()}_position, "
                f"(select cast(count(*) as integer) from idx where feature='{c}') {c.lower()}_size"
                for c in K.FINANCIAL_CATEGORIES
            ) + " from s_fin f",
            "idx as (select feature, category, row_number() over (partition by feature order by n desc, category)-1 i from ("
            + " union all ".join(
                f"select '{c}' feature, {c} category, sum(1 + coalesce(len(Loan_Types_Array), 0)) n from s_fin where {c} is not null group by 2"
                for c in K.FINANCIAL_CATEGORIES
            ) + "))",
        ),
        # labels
        "label_store": twin("s_loans", "select * from labels_", labels),
        "label_store_with_def": twin("s_loans", "select *, '60dpd_3mob' label_def from (select Customer_ID, loan_id, case when dpd>=60 then 1 else 0 end label, snapshot_date from s_loans where mob=3)"),
        "bad_rate_by_mob": twin(
            "s_loans",
            "select mob, round(avg(case when dpd>=30 then 1 else 0 end),10) bad_rate from s_loans group by 1",
        ),
        "cohort_filter": twin(
            "s_loans", "select loan_id, Customer_ID, installment_num, dpd from s_loans where loan_start_date<date '1996-01-01'"
        ),
        "at_installment": twin(
            "s_loans", "select loan_id, Customer_ID, loan_start_date, dpd from s_loans where installment_num=4"
        ),
        "fill_zero": twin(
            "s_loans",
            "select loan_id, Customer_ID, snapshot_date, overdue_amt, coalesce(dpd,0) dpd, coalesce(installments_missed,0) installments_missed, first_missed_date from s_loans",
        ),
        "backfill_all_months": twin(
            "s_loans",
            "select Customer_ID, loan_id, label, snapshot_date from labels_ where snapshot_date in (select distinct cast(date_trunc('month',snapshot_date) as date) from s_loans)",
            labels,
        ),
        # joins
        "multi_snapshot_join": twin("j_fin", "select * exclude (Loan_Types_Array) from j_fin"),
        "valid_slices": twin(
            "fx_clk fx_loans",
            """select distinct snapshot_date feature_snapshot_date, cast(snapshot_date+to_months(6) as date) label_snapshot_date
 from fx_clk where cast(snapshot_date+to_months(6) as date) in (select snapshot_date from fx_loans)""",
        ),
        "union_slices": twin(
            "fx_clk",
            _CLK_ROUND,
        ),
        "with_constants": twin(
            "fx_clk",
            "select Customer_ID, snapshot_date feature_snapshot_date, 'credit_model' model_name, date '1998-01-01' scored_on from fx_clk",
        ),
        "join_sources": twin(
            "j_att j_clk",
            f"""select Customer_ID, feature_snapshot_date, label_snapshot_date, label, Name, Age, SSN, Occupation, {FE_LIST}, count(*) copies
 from j_att join j_clk using (Customer_ID, feature_snapshot_date, label_snapshot_date, label) group by all""",
        ),
        "attach_labels": twin(
            "fx_clk s_loans",
            """select f.Customer_ID, f.snapshot_date, fe_1, fe_2, l.loan_id, l.label
 from fx_clk f join labels_ l on f.Customer_ID=l.Customer_ID and f.snapshot_date=l.snapshot_date""",
            labels,
        ),
        "salted_attach_labels": twin(
            "fx_clk s_loans",
            """select f.Customer_ID, f.snapshot_date, fe_1, fe_2, l.loan_id, l.label
 from fx_clk f join labels_ l on f.Customer_ID=l.Customer_ID and f.snapshot_date=l.snapshot_date""",
            labels,
        ),
        "attach_label_counts": twin(
            "fx_clk s_loans",
            """select f.Customer_ID, f.snapshot_date, fe_1, l.label, l.weight from fx_clk f join
 (select Customer_ID, label, count(*) weight from labels_ group by 1,2) l on f.Customer_ID=l.Customer_ID""",
            labels,
        ),
        "attach_features": twin(
            "fx_clk s_loans",
            f"""select l.Customer_ID, l.snapshot_date, l.loan_id, l.label, {FE_LIST} from labels_ l
 left join fx_clk f on f.Customer_ID=l.Customer_ID and f.snapshot_date=l.snapshot_date""",
            labels,
        ),
        "time_split": twin(
            "fx_clk", "select Customer_ID, snapshot_date, period from rows_", period
        ),
        # quantiles
        "quantiles": twin(
            "fx_clk",
            "select feature, prob, v as \"value\" from (" + " union all ".join(
                f"select '{c}' feature, cast({p} as double) prob, quantile_disc(cast({c} as double),{p}) v from fx_clk"
                for c in FES
                for p in (0.01, 0.5, 0.95)
            ) + ")",
        ),
        "quantiles_real": _component_quantiles("true"),
        "quantiles_nan": _component_quantiles("vec_id % 7 <> 0"),
        "quantiles_bigint": " union all ".join(
            f"select '{k}' feature, cast({p} as double) prob, quantile_disc(cast({k} as bigint) + 9007199254740993, {p}) as \"value\" from lineitem"
            for k in ("l_orderkey", "l_partkey", "l_suppkey")
            for p in (0.1, 0.5, 0.999)
        ),
        "psi_real": _COMPONENT_PSI,
        "impute_median": twin(
            "s_fin",
            """select Customer_ID, snapshot_date, coalesce(Outstanding_Debt,(select quantile_disc(Outstanding_Debt,0.5) from s_fin)) Outstanding_Debt from s_fin""",
        ),
        "cap_by_quantile": twin("fx_clk", _clk_features("fx_clk", _PANEL)),
        # features
        "financial_features": twin("j_fin", _fin_features("j_fin", _LABELLED)),
        "attribute_features": twin("j_att", _att_features("j_att", _LABELLED)),
        "clickstream_features": twin("j_clk", _clk_features("j_clk", _LABELLED)),
        "feature_store": twin("j_fin j_att j_clk", _STORE, _JOINED_STORE),
        # drift
        "baseline_all": twin("fx_clk", f"select {FE_LIST} from fx_clk"),
        "baseline_latest": twin(
            "fx_clk", f"select {FE_LIST} from fx_clk where snapshot_date=(select max(snapshot_date) from fx_clk)"
        ),
        "decile_edges": twin(
            "fx_clk",
            "select feature, cast(unnest(range(11)) as integer) edge_no, round(unnest(e),9) edge from edges",
            _BASE_CUR,
        ),
        "histogram": twin(
            "fx_clk",
            """select hc.feature, cast(hc.bin as integer) bin, n, cast(t as bigint) total from (select feature, bin, n from (select feature, r.bin,
 coalesce(n,0) n from (select distinct feature from hc) cross join range(10) r(bin) left join hc using (feature, bin))) hc
 join tc using (feature)""",
            _PSI_TOTAL,
        ),
        "psi": twin("fx_clk", "select feature, round(psi,10) psi from psi", _PSI_TOTAL),
        "psi_by_snapshot": twin("fx_clk", "select snapshot_date, feature, round(psi,10) psi from psi", _PSI),
        "psi_summary": twin(
            "fx_clk",
            "select snapshot_date, round(avg(psi),10) psi_mean, round(max(psi),10) psi_max from psi group by 1",
            _PSI,
        ),
        "psi_global": twin("fx_clk", "select round(coalesce(max(psi),0),6) psi_max from psi", _PSI),
        "drift_decision": twin(
            "fx_clk",
            """select snapshot_date, round(avg(psi),10) psi_mean, round(max(psi),10) psi_max,
 case when max(psi)>=0.2 then 'trigger_retrain' else 'continue_pipeline' end decision from psi group by 1""",
            _PSI,
        ),
        # registry
        "best_per_snapshot": twin(
            "fx_runs", "select snapshot_date, run_id, start_time, model_type, auc from best", _BEST
        ),
        "rank_runs": twin(
            "fx_runs",
            """select run_id, start_time, snapshot_date, model_type, auc, row_number() over (partition by snapshot_date
 order by auc desc, start_time desc, run_id) as "rank" from fx_runs""",
        ),
        "latest_run": twin(
            "fx_runs",
            "select run_id, start_time, snapshot_date, model_type, auc from fx_runs order by start_time desc, run_id limit 1",
        ),
        "run_tags": twin("fx_runs", "select run_id, model_type, 'none' stage from fx_runs"),
        "artifact_semi": twin(
            "fx_runs fx_artifacts",
            "select run_id, snapshot_date, model_type from fx_runs semi join fx_artifacts using (model_type, snapshot_date)",
        ),
        "artifact_anti": twin(
            "fx_runs fx_artifacts",
            "select run_id, snapshot_date, model_type from fx_runs anti join fx_artifacts using (model_type, snapshot_date)",
        ),
        "asof_fallback": twin(
            "fx_runs fx_artifacts",
            """select snapshot_date, run_id, model_type, fallback_snapshot from prev
 anti join fx_artifacts using (model_type, snapshot_date)""",
            _BEST,
        ),
        "promotions": twin(
            "fx_runs fx_artifacts",
            """select p.snapshot_date, run_id, p.model_type, auc, fallback_snapshot,
 case when a.model_type is not null then 'promoted' when fallback_snapshot is null then 'no_fallback'
 when b.model_type is not null then 'fallback' else 'fallback_missing' end status,
 case when a.model_type is not null then p.snapshot_date when b.model_type is not null then fallback_snapshot end source_snapshot
 from prev p left join fx_artifacts a on a.model_type=p.model_type and a.snapshot_date=p.snapshot_date
 left join fx_artifacts b on b.model_type=p.model_type and b.snapshot_date=p.fallback_snapshot""",
            _BEST,
        ),
        "promotions_bad_tags": twin(
            "fx_runs fx_artifacts",
            """select p.snapshot_date, run_id, p.model_type, auc, fallback_snapshot,
 case when a.model_type is not null then 'promoted' when p.day is null then 'bad_snapshot'
 when fallback_snapshot is null then 'no_fallback' when b.model_type is not null then 'fallback' else 'fallback_missing' end status,
 case when a.model_type is not null then p.snapshot_date when b.model_type is not null then fallback_snapshot end source_snapshot
 from prev p left join fx_artifacts a on a.model_type=p.model_type and a.snapshot_date=p.snapshot_date
 left join fx_artifacts b on b.model_type=p.model_type and b.snapshot_date=p.fallback_snapshot""",
            """r as (select * replace (case when cast(substr(snapshot_date,6,2) as int) % 3 = 0 then 'latest-' || substr(snapshot_date,1,7)
 else snapshot_date end as snapshot_date) from fx_runs),
 best as (select * exclude (rk), try_cast(snapshot_date as date) as day from (select *, row_number() over (partition by snapshot_date
 order by auc desc, start_time desc, run_id) rk from r) where rk=1),
 prev as (select *, case when cast(p as date)>=day-to_years(3) then p end fallback_snapshot
 from (select *, lag(snapshot_date) over (order by snapshot_date) p from best where day is not null)
 union all select *, null, null from best where day is null)""",
        ),
        "model_for_snapshot": twin(
            "fx_artifacts",
            "select cast(snapshot_date as date) snapshot_date, min(model_type || '_' || snapshot_date || '.pkl') as \"name\" from fx_artifacts group by 1",
        ),
        "metrics_long": twin("fx_metrics", "select * from fx_metrics"),
        # report
        "auc_series": twin(
            "fx_metrics", "select snapshot_date, run_id, \"value\" from fx_metrics where metric_name='auc' order by 1,2"
        ),
        "metric_pivot": twin(
            "fx_clk",
            "select feature metric_name, cast(snapshot_date as varchar) snapshot_date, round(psi,10) as \"value\" from psi",
            _PSI,
        ),
        "null_profile": twin(
            "s_fin",
            "select snapshot_date, round(100.0*sum(" + "+".join(
                f"cast({c} is null as integer)" for c in FIN_DOUBLES
            ) + f")/(count(*)*{len(FIN_DOUBLES)}),9) null_pct from s_fin group by 1",
        ),
        "metric_prefix": twin(
            "fx_metrics",
            "select run_id, snapshot_date, replace(metric_name,'psi_','') metric_name, \"value\" from fx_metrics where starts_with(metric_name,'psi_')",
        ),
        # evaluation
        "auc_by_model": twin(
            "fx_scored", f"select model_name, round(auc,10) auc from ({_AUC.format(by='model_name', src='fx_scored')})"
        ),
        "auc_global": twin(
            "fx_scored",
            f"select round(auc,10) auc from ({_AUC.format(by='g', src='(select 1 g, * from fx_scored)')})",
        ),
        "gini": twin(
            "fx_scored",
            f"select model_name, round(auc,10) auc, round(2*auc-1,3) gini from ({_AUC.format(by='model_name', src='fx_scored')})",
        ),
        "split_stats": twin(
            "fx_ml", f"select {_SPLIT} split, count(*) n_rows, round(avg(label),2) label_mean from fx_ml group by 1"
        ),
        "prediction_stats": twin(
            "fx_scored",
            "select model_name, round(avg(prediction),8) pred_mean, round(stddev_pop(prediction),8) pred_std from fx_scored group by 1",
        ),
        "hash_split": twin("fx_ml", f"select id, label, {_SPLIT} split from fx_ml"),
        "exact_split": twin(
            "fx_ml",
            """select id, label, case when row_number() over (partition by label order by md5('42' || cast(id as varchar)))
 <= ceil(0.2*count(*) over (partition by label)) then 'test' else 'train' end split from fx_ml""",
        ),
        "label_classes": twin("fx_ml", "select count(distinct label) n_classes from fx_ml"),
        "fit_scaler": twin(
            "fx_ml",
            "select feature, round(m,10) mean, round(s,10) std from (" + " union all ".join(
                f"select '{c}' feature, avg({c}) m, case when stddev_pop({c})>0 then stddev_pop({c}) else 1 end s from fx_ml"
                for c in FES
            ) + ")",
        ),
        "apply_scaler": twin(
            "fx_ml",
            "select id, " + ", ".join(f"round(({c}-m_{c})/s_{c},8) {c}" for c in FES) + " from fx_ml, (select "
            + ", ".join(f"avg({c}) m_{c}, stddev_pop({c}) s_{c}" for c in FES) + " from fx_ml)",
        ),
        "linear_score": twin("fx_ml", f"select id, round({_SIGMOID},10) prediction from fx_ml"),
        "evaluate_splits": twin(
            "fx_ml",
            "select split, round(auc,10) auc, round(2*auc-1,3) gini from ("
            + _AUC.format(by="split", src=f"(select {_SPLIT} split, label, round({_SIGMOID},10) prediction from fx_ml)")
            + ")",
        ),
        "lr_optimum": " union all ".join(f"select '{c}' feature, true optimal" for c in FES),
        "model_roundtrip": twin("fx_ml", "select count(*) n_rows, cast(0 as double) difference from fx_ml"),
        "gbt_native": twin("fx_ml", "select count(*) n_rows, cast(0 as double) difference from fx_ml"),
        "gbt_leaves": twin(
            "fx_ml",
            f"""select cast(t as integer) tree, n_rows, true agree from range(20) r(t),
 (select count(*) n_rows from (select {_SPLIT} split from fx_ml) where split = 'train')""",
        ),
        "model_card": twin(
            "fx_ml",
            f"""select 'fixed' model_version, date '1997-11-01' oot_start, split, n_rows, label_mean, round(auc,10) auc,
 round(2*auc-1,3) gini, '0.1' intercept from a join n using (split)""",
            "a as (" + _AUC.format(by="split", src=f"(select {_SPLIT} split, label, round({_SIGMOID},10) prediction from fx_ml)")
            + f"), n as (select {_SPLIT} split, count(*) n_rows, round(avg(label),2) label_mean from fx_ml group by 1)",
        ),
        "run_log": twin(
            "fx_scored",
            "select model_name run_id, '1998-01-01' snapshot_date, 'pred_mean' metric_name, round(avg(prediction),8) as \"value\" from fx_scored group by 1",
        ),
        "alert_latest": twin(
            "fx_runs fx_metrics",
            """select run_id, m."value" psi_max, case when m."value">=0.2 then 'trigger_retrain' else 'continue_pipeline' end decision
 from (select run_id from fx_runs order by start_time desc, run_id limit 1) join fx_metrics m using (run_id) where metric_name='psi_max'""",
        ),
        "global_decision": twin(
            "fx_clk",
            """select round(max(psi),6) psi_max, case when round(max(psi),6)>=0.2 then 'trigger_retrain' else 'continue_pipeline' end decision
 from psi""",
            _PSI,
        ),
        "report_files": twin(
            "fx_runs fx_metrics",
            """select m.snapshot_date, m.run_id, round(m."value",9) as "value" from fx_metrics m join best using (run_id)
 where metric_name='auc'""",
            _BEST,
        ),
        "runs_compacted": twin(
            "fx_runs", "select cast(cast(start_time as date) as varchar) \"day\", 1 n_files, count(*) n_runs from fx_runs group by 1"
        ),
        "report_psi_file": twin(
            "fx_runs fx_metrics",
            """select metric_name, m.snapshot_date, round(m."value",9) as "value" from fx_metrics m join best using (run_id)
 where starts_with(metric_name,'psi_')""",
            _BEST,
        ),
        # round trips
        "csv_reordered": twin(
            "fx_clk",
            f"select Customer_ID, snapshot_date, "
            + ",".join("case when cast(Customer_ID as bigint)%3=2 then null else fe_7 end fe_7" if c == "fe_7" else c for c in FES)
            + " from fx_clk",
        ),
        "roundtrip_parquet": twin("fx_clk", _CLK_ROUND),
        "roundtrip_partitioned": twin("fx_clk", _CLK_ROUND),
        "roundtrip_csv": twin("fx_clk", _CLK_ROUND),
        "csv_inferred": twin(
            "fx_clk", f"select cast(Customer_ID as bigint) Customer_ID, snapshot_date, {FE_LIST} from fx_clk"
        ),
        "multi_file_scan": twin("fx_clk", _CLK_ROUND),
        "baseline_files": twin(
            "fx_clk", f"select {FE_LIST} from fx_clk union all select {FE_LIST} from fx_clk"
        ),
        "runs_scan": twin("fx_runs", "select run_id, snapshot_date, model_type, auc from fx_runs"),
        "metrics_scan": twin(
            "fx_metrics", "select run_id, snapshot_date, metric_name, round(\"value\",9) as \"value\" from fx_metrics"
        ),
        "optional_scan": twin(
            "s_fin",
            "select snapshot_date, round(100.0*sum(" + "+".join(
                f"cast({c} is null as integer)" for c in FIN_DOUBLES
            ) + f")/(count(*)*{len(FIN_DOUBLES)}),9) null_pct from s_fin group by 1",
        ),
        "predictions_sink": twin(
            "fx_clk",
            f"select Customer_ID, snapshot_date, 'fixed_weights' model_name, round({_SIGMOID},10) prediction from fx_clk",
        ),
        "etl_label_store": twin("s_loans", "select * from labels_", labels),
        "etl_feature_store": twin("j_fin j_att j_clk", _STORE, _JOINED_STORE),
    }
