"""DuckDB equivalents of the registered queries, written from the definitions.

They state the naive form: the full outer chain with all rows joined, then the statistic.
"""

from __future__ import annotations

from .. import fixtures, schemas
from ..sources import inline
from ..fixtures import FIXTURE_DOMAINS as DOMAINS

CC = ",\n".join(f"cc_{n} as (\n{fixtures.view_sql(n)}\n)" for n in fixtures.VIEWS)

CUSTOMER_REST = ", ".join(f"c.{c}" for c in schemas.CUSTOMER.names[1:])
METRICS_REST = ", ".join(f'm."{c}"' for c in schemas.CREDIT_METRICS.names[1:])
GOLD = ", ".join(f'"{c}"' for c in schemas.GOLD_COLUMNS)

JOINS = f"""
j1 as (
  select coalesce(c.customer_id, x.customer_id) customer_id, {CUSTOMER_REST},
         x.status, x.account_id
  from cc_customer c full join cc_closed x on c.customer_id is not distinct from x.customer_id
),
j2 as (
  select coalesce(c.customer_id, a.customer_id) customer_id, {CUSTOMER_REST}, c.status,
         a.account_id, a.card_category, a.credit_limit, a.account_open_date
  from j1 c full join cc_account a on c.customer_id is not distinct from a.customer_id
),
j3 as (
  select coalesce(c.customer_id, m.customer_id) customer_id, {CUSTOMER_REST}, c.status,
         c.account_id, c.card_category, c.credit_limit, c.account_open_date, {METRICS_REST}
  from j2 c full join cc_metrics m on c.customer_id is not distinct from m.customer_id
),
j4 as (
  select coalesce(c.account_id, t.account_id) account_id, c.* exclude (account_id),
         t.transaction_id, t.transaction_amount, t.transaction_date
  from j3 c full join cc_transactions t on c.account_id is not distinct from t.account_id
),
gold_raw as (select * from j4 where total_relationship_count is not null),
gold as (
  select * replace (coalesce(status, 'Existing Customer') as status) from gold_raw
)"""


def with_cc(select: str, *more: str) -> str:
    return "with " + ",\n".join([CC, *more]) + "\n" + select


def with_gold(select: str, *more: str) -> str:
    return with_cc(select, JOINS, *more)


def _list(names: list[str], table: str = "") -> str:
    return ", ".join(f'{table}"{n}"' for n in names)


FEATURES = schemas.feature_names(DOMAINS)
SUMMARY = schemas.NUMERIC_FEATURES + schemas.dummy_names(DOMAINS)
CATEGORICAL = schemas.dummy_names(DOMAINS, [c for c in DOMAINS if c != "status"])
LABEL = f'"{schemas.LABEL}"'
DUMMIES = ", ".join(
    f"cast(coalesce({c} = '{v}', false) as integer) \"{c}_{v}\""
    for c, values in DOMAINS.items()
    for v in values
)
CUSTOMER = _list(schemas.CUSTOMER.names)
ENGINEERED = _list(schemas.ENGINEERED_COLUMNS)
_ORDER = ", ".join(
    f"{c} nulls last"
    for c in ("account_id", "transaction_date", "transaction_id", "transaction_amount")
)

MONTHLY = """
monthly as (
  select customer_id, cast(year(transaction_date) as integer) "year",
         cast(month(transaction_date) as integer) "month", count(*) num_transactions
  from gold where customer_id is not null and transaction_date is not null
  group by 1, 2, 3
),
average as (
  select customer_id, avg(num_transactions) avg_trans_per_month from monthly group by 1
)"""

FEAT = f"""
wide as (
  select g.*, g.avg_utilization_ratio * g.credit_limit avg_monthly_spend, a.avg_trans_per_month
  from gold g left join average a on g.customer_id = a.customer_id
),
ranked as (
  select *, row_number() over (partition by customer_id order by {_ORDER}) rn from wide
),
feat as (
  select {_list(schemas.KEY_COLUMNS)}, {_list(schemas.NUMERIC_FEATURES)}, {DUMMIES}
  from ranked where rn = 1
)"""

CAPS = """
caps as (
  select quantile_cont(income, 0.98) income,
         quantile_cont("total_amt_chng_Q4_Q1", 0.99) amt,
         quantile_cont("total_ct_chng_Q4_Q1", 0.99) ct
  from feat
),
trimmed as (
  select f.* from feat f, caps
  where f.income < caps.income and f."total_amt_chng_Q4_Q1" < caps.amt
    and f."total_ct_chng_Q4_Q1" < caps.ct
)"""


def with_feat(select: str, *more: str) -> str:
    return with_gold(select, MONTHLY, FEAT, *more)


def _hash(key: str) -> str:
    return f"('0x' || substr(md5('42:' || {key}), 1, 13))::bigint"


def _split(source: str, columns: str = "*") -> str:
    """Parts of an exact 70 / 15 / 15 split of a table keyed by customer_id."""
    return f"""
hashed as (
  select {columns}, row_number() over (order by {_hash('customer_id')}, customer_id) - 1 pos,
         count(*) over () total from {source}
),
parts as (
  select * exclude (pos, total),
         case when pos < cast(floor(0.7 * total) as bigint) then 'train'
              when pos < cast(floor(0.85 * total) as bigint) then 'validate'
              else 'test' end part
  from hashed
)"""


_COMPLETE = " and ".join(f'"{c}" is not null' for c in schemas.ENGINEERED_COLUMNS)
MODEL = (
    f"\nmodel_rows as (select customer_id, {ENGINEERED} from feat where {_COMPLETE}),"
    + _split("model_rows")
)
_STATS = ", ".join(
    f'avg("{c}") "m_{c}", stddev_pop("{c}") "d_{c}"' for c in schemas.MODEL_FEATURES
)
_SCALED = ", ".join(
    f'("{c}" - "m_{c}") / case when "d_{c}" = 0 then 1.0 else "d_{c}" end "{c}"'
    for c in schemas.MODEL_FEATURES
)
SCALED = f"""
scaler as (select {_STATS} from parts where part = 'train'),
scaled as (select customer_id, part, {_SCALED}, {LABEL} from parts, scaler)"""


def with_model(select: str, *more: str) -> str:
    return with_feat(select, MODEL, *more)


def _union(template: str, names: list[str]) -> str:
    return "\nunion all\n".join(template.replace("@", n) for n in names)


def _rounded(names: list[str], digits: int = 6, table: str = "") -> str:
    return ", ".join(f'round({table}"{n}", {digits}) "{n}"' for n in names)


def _landed(schema) -> str:
    return ", ".join(
        f'round("{f.name}", 6) "{f.name}"' if f.dataType.typeName() == "double" else f'"{f.name}"'
        for f in schema.fields
    )


def _significant(x: str) -> str:
    return (
        f"case when {x} <> 0 then round({x} / pow(10.0, floor(log10(abs({x})))), 8)"
        f" when {x} = 0 then 0.0 end"
    )


_ANOVA = """
long as (
  @UNION
),
per_class as (
  select feature, y, cast(count(*) as double) n, avg(x) m, var_pop(x) v
  from long where x is not null group by 1, 2
),
with_grand as (
  select *, sum(n * m) over (partition by feature) / sum(n) over (partition by feature) g
  from per_class
),
scores as (
  select feature,
         (sum(n * (m - g) ** 2) / nullif(count(*) - 1, 0))
           / nullif(sum(n * v) / nullif(sum(n) - count(*), 0), 0) f_score
  from with_grand group by 1
)""".replace(
    "@UNION",
    _union(f"""select '@' feature, {LABEL} y, cast("@" as double) x from feat""", FEATURES),
)


def _contingency(names: list[str]) -> str:
    long = _union(f"""select '@' feature, {LABEL} y, cast("@" as double) "value" from feat""", names)
    return f"""
long as (
{long}
),
cells as (
  select feature, "value", count(*) filter (y = 0) o0, count(*) filter (y = 1) o1
  from long where "value" is not null group by 1, 2
),
tested as (
  select *, sum(o0) over w t0, sum(o1) over w t1, count(*) over w n_values,
         cast(o0 + o1 as double) * (sum(o0) over w) / ((sum(o0) over w) + (sum(o1) over w)) e0,
         cast(o0 + o1 as double) * (sum(o1) over w) / ((sum(o0) over w) + (sum(o1) over w)) e1
  from cells window w as (partition by feature)
)"""


_YATES = (
    "sum(case when e0 > 0 then (abs(o0 - e0) - least(0.5, abs(o0 - e0))) ** 2 / e0 else 0 end"
    " + case when e1 > 0 then (abs(o1 - e1) - least(0.5, abs(o1 - e1))) ** 2 / e1 else 0 end)"
)
_PLAIN = (
    "sum(case when e0 > 0 then (o0 - e0) ** 2 / e0 else 0 end"
    " + case when e1 > 0 then (o1 - e1) ** 2 / e1 else 0 end)"
)

_NULLS = "select '@' \"column\", count(*) filter (\"@\" is null) nulls from {}"

_CELLS = """
select count(*) filter (label = 0 and prediction = 0) tn,
       count(*) filter (label = 0 and prediction = 1) fp,
       count(*) filter (label = 1 and prediction = 0) fn,
       count(*) filter (label = 1 and prediction = 1) tp"""


def _ratio(top: str, bottom: str) -> str:
    return f"case when {bottom} > 0 then ({top}) / cast({bottom} as double) else 0.0 end"


_BALANCED = f"({_ratio('tp', '(tp + fn)')} + {_ratio('tn', '(tn + fp)')}) / 2"
METRICS = {
    "accuracy": _ratio("tp + tn", "(tp + tn + fp + fn)"),
    "precision": _ratio("tp", "(tp + fp)"),
    "recall": _ratio("tp", "(tp + fn)"),
    "f1": _ratio("2 * tp", "(2 * tp + fp + fn)"),
    "balanced_accuracy": _BALANCED,
    "roc_auc_hard": _BALANCED,
}
_METRIC_COLUMNS = ", ".join(f'round({x}, 6) "{m}"' for m, x in METRICS.items())

_MODELS = """
stacked as (
  select 'given' model, label, prediction from cc_predictions
  union all
  select 'score', label, case when score > 0.5 then 1 else 0 end from cc_predictions
  union all
  select 'majority', label, (select label from cc_predictions group by label
                             order by count(*) desc, label limit 1) from cc_predictions
),
by_model as (""" + _CELLS.replace("select", "select model,", 1) + """
  from stacked group by model
)"""


def _report() -> str:
    def one(name: str, hit: str, wrong: str, missed: str) -> str:
        return (
            f"select '{name}' class, {_ratio(hit, f'({hit} + {wrong})')} \"precision\", "
            f"{_ratio(hit, f'({hit} + {missed})')} recall, "
            f"{_ratio(f'2 * {hit}', f'(2 * {hit} + {wrong} + {missed})')} f1, "
            f"{hit} + {missed} support from cells"
        )

    names = ("precision", "recall", "f1")
    macro = ", ".join(f'avg("{m}") "{m}"' for m in names)
    weighted = ", ".join(f'sum("{m}" * support) / sum(support) "{m}"' for m in names)
    accuracy = _ratio("tp + tn", "(tp + tn + fp + fn)")
    return with_cc(
        f'select class, {_rounded(list(names))}, cast(support as bigint) support from rows',
        f"cells as ({_CELLS} from cc_predictions)",
        f"classes as ({one('0', 'tn', 'fn', 'fp')} union all {one('1', 'tp', 'fp', 'fn')})",
        "rows as (select * from classes"
        f" union all select 'accuracy', {accuracy}, {accuracy}, {accuracy}, tp + tn + fp + fn from cells"
        f" union all select 'macro avg', {macro}, sum(support) from classes"
        f" union all select 'weighted avg', {weighted}, sum(support) from classes)",
    )


_NB_STATS = ", ".join(
    f'avg("{c}") filter ({LABEL} = {y}) "m{y}_{c}", var_pop("{c}") filter ({LABEL} = {y}) "v{y}_{c}"'
    for y in (0, 1)
    for c in schemas.MODEL_FEATURES
)
_NB_LARGEST = "greatest(" + ", ".join(f'var_pop("{c}")' for c in schemas.MODEL_FEATURES) + ")"


def _log_likelihood(y: int) -> str:
    terms = "".join(
        f' - 0.5 * ln(2 * pi() * ("v{y}_{c}" + rise))'
        f' - 0.5 * ("{c}" - "m{y}_{c}") ** 2 / ("v{y}_{c}" + rise)'
        for c in schemas.MODEL_FEATURES
    )
    return f"ln(p{y}){terms}"


def _nearest(distance: str, train: str, queries: str, key: str, k: int) -> str:
    return f"""
near as (
  select q.{key}, t.label, row_number() over (partition by q.{key} order by {distance}, t.{key}) r
  from ({queries}) q, ({train}) t
),
votes as (select {key}, label, count(*) n from near where r <= {k} group by 1, 2),
voted as (
  select {key}, label prediction,
         row_number() over (partition by {key} order by n desc, label) r from votes
)"""


_SQUARES = " + ".join(f'(q."{c}" - t."{c}") ** 2' for c in schemas.MODEL_FEATURES)
_KNN_COLUMNS = f"customer_id, {_list(schemas.MODEL_FEATURES)}, {LABEL} label"

_SCORES = ", ".join(f"('{k}', {v!r}::double)" for k, v in inline.PUBLISHED_SCORES.items())


def _first_nulls(column: str) -> str:
    return with_cc(
        f"select {CUSTOMER} from cc_customer where {column} is null order by customer_id limit 10"
    )


def _mode(column: str) -> str:
    return (
        f"(select {column} from cc_customer where {column} is not null group by 1"
        f" order by count(*) desc, {column} limit 1)"
    )


_MEDIAN = "(select median(income) from cc_customer)"
_CLEAN = f"""
clean as (
  select * replace (coalesce(marital_status, {_mode('marital_status')}) as marital_status,
                    coalesce(education_level, {_mode('education_level')}) as education_level,
                    coalesce(income, {_MEDIAN}) as income)
  from cc_customer
)"""

_SILENT = with_feat(f"select customer_id, {_rounded(schemas.MODEL_FEATURES[:6])}, "
                    f"\"gender_M\", \"gender_F\", {LABEL} from feat")

ORACLE: dict[str, str] = {
    # sources and sinks
    "scan_typed_csv": with_cc("select * from cc_customer"),
    "scan_header_csv": with_cc("select * from cc_metrics"),
    "scan_infer_csv": with_cc(
        "select * replace (cast(account_id as integer) as account_id,"
        " cast(customer_id as integer) as customer_id) from cc_account"
    ),
    "scan_stage_table": with_cc("select * from cc_metrics"),
    "scan_gzip_csv": with_cc("select * from cc_transactions"),
    "sink_csv": with_cc("select * from cc_closed"),
    "sink_gzip_csv": _SILENT,
    "sink_stage_table": with_cc("select * from cc_account"),
    "list_landing": with_cc(
        " union all ".join(
            f"select '{t}' folder, 1 files, cast(sum(length(coalesce({c}, '')) + 1) as bigint) \"length\" from cc_{t}"
            for t, c in (("customer", "customer_id"), ("account", "account_id"), ("closed", "customer_id"))
        )
    ),
    "land_raw": with_cc(
        "\nunion all by name\n".join(
            f"select '{n}' \"table\", {_landed(s)} from cc_{n}" for n, s in schemas.SOURCES.items()
        )
    ),
    "inline_table": with_feat(
        "select p.variable, p.score, round(s.f_score, 6) f_score"
        f" from (values {_SCORES}) p(variable, score) left join scores s on s.feature = p.variable",
        _ANOVA,
    ),
    "preview": with_cc("select * from cc_account order by account_id limit 20"),
    # projections, filters
    "project_engineered": _SILENT,
    "drop_columns": with_feat(
        f"select customer_id, {_rounded(schemas.NUMERIC_FEATURES)}, "
        f"{_list(schemas.dummy_names(DOMAINS))} from feat"
    ),
    "drop_if_exists": with_cc("select * exclude (income) from cc_customer"),
    "rename": with_gold(
        "select customer_id, cast(sum(num_transactions) as bigint) total_transactions"
        " from monthly group by 1",
        MONTHLY,
    ),
    "insert_at": with_gold(
        f"select {GOLD}, avg_utilization_ratio * credit_limit avg_monthly_spend from gold"
    ),
    "derive_monthly_spend": with_gold(
        "select customer_id, account_id, transaction_id,"
        " avg_utilization_ratio * credit_limit avg_monthly_spend from gold"
    ),
    "engineered_rows": with_feat(
        f"select {_list(schemas.KEY_COLUMNS)}, {_rounded(schemas.NUMERIC_FEATURES)}, {DUMMIES} from wide"
    ),
    "insert_at_accounts": with_gold(
        "select customer_id, account_id, avg_utilization_ratio * credit_limit avg_monthly_spend,"
        " avg_utilization_ratio, credit_limit from j3 where total_relationship_count is not null"
    ),
    "derive_monthly_spend_accounts": with_gold(
        "select customer_id, account_id, avg_utilization_ratio * credit_limit avg_monthly_spend"
        " from j3 where total_relationship_count is not null"
    ),
    "filter_null_rows_education_level": _first_nulls("education_level"),
    "filter_null_rows_marital_status": _first_nulls("marital_status"),
    "filter_null_rows_income": _first_nulls("income"),
    "drop_null_rows": with_cc("select * from cc_metrics where total_relationship_count is not null"),
    "trim_outliers": with_feat(
        f"select customer_id, {_list(list(schemas.OUTLIER_QUANTILES))} from trimmed", CAPS
    ),
    "select_existing": with_feat(f"select {LABEL} from feat"),
    "threshold_label": with_cc(
        "select row_id, case when score > 0.5 then 1 else 0 end predicted from cc_predictions"
    ),
    "axis_projection": with_feat(f"select {LABEL} x, round(avg_trans_per_month, 6) y from feat"),
    "table_profile": with_gold(
        f'select count(*) "rows", {len(schemas.GOLD_COLUMNS)} "columns" from gold'
    ),
    "features_target": with_feat(
        f"select customer_id, {LABEL} label, "
        + ", ".join(f'round(cast("{c}" as double), 6) "{c}"' for c in schemas.MODEL_FEATURES)
        + f" from feat where {_COMPLETE}"
    ),
    # joins
    "join_customer_closed": with_gold("select * from j1"),
    "join_accounts": with_gold("select * from j2"),
    "join_metrics": with_gold("select * from j3"),
    "join_transactions": with_gold("select * from j4"),
    "build_gold": with_gold(f"select {GOLD} from gold"),
    "build_gold_drop_null_keys": with_cc(
        f"select {GOLD} from gold",
        JOINS.replace(
            "c.account_id is not distinct from t.account_id", "c.account_id = t.account_id"
        ),
    ),
    "gold_weighted": with_gold(
        "select customer_id, account_id, count(*) gold_rows,"
        " count(transaction_date) n_transaction_date from gold group by 1, 2"
    ),
    "attach_customer_agg": with_gold(
        "select g.customer_id, account_id, transaction_id,"
        " round(avg_trans_per_month, 6) avg_trans_per_month"
        " from gold g left join average a on g.customer_id = a.customer_id",
        MONTHLY,
    ),
    "attach_customer_agg_accounts": with_gold(
        "select customer_id, account_id, round(avg_trans_per_month, 6) avg_trans_per_month"
        " from (select distinct customer_id, account_id from gold) left join average"
        " using (customer_id)",
        MONTHLY,
    ),
    # aggregations
    "null_counts": with_cc(_union(_NULLS.format("cc_customer"), schemas.CUSTOMER.names)),
    "null_counts_gold": with_gold(_union(_NULLS.format("gold_raw"), schemas.GOLD_COLUMNS)),
    "null_percent": with_cc(
        _union(
            "select '@' \"column\", round(count(*) filter (\"@\" is null) * 100.0::double"
            " / count(*), 6) null_percent from cc_customer",
            schemas.CUSTOMER.names,
        )
    ),
    "value_counts": with_gold('select status "value", count(*) n from gold group by 1'),
    "mode_value": with_cc(
        f"select {_mode('marital_status')} marital_status, {_mode('education_level')} education_level"
    ),
    "median_value": with_cc("select round(median(income), 6) income from cc_customer"),
    "skew_profile": with_gold(
        _union("select '@' \"column\", round(skewness(\"@\"), 6) skew from gold", schemas.SKEW_COLUMNS)
    ),
    "skew_profile_trimmed": with_feat(
        _union(
            "select '@' \"column\", round(skewness(\"@\"), 6) skew from trimmed", schemas.SKEW_COLUMNS
        ),
        CAPS,
    ),
    "monthly_txn_counts": with_gold("select * from monthly", MONTHLY),
    "avg_txn_per_month": with_gold(
        "select customer_id, round(avg_trans_per_month, 6) avg_trans_per_month from average", MONTHLY
    ),
    "quantile_caps": with_feat(
        'select round(income, 6) income, round(amt, 6) "total_amt_chng_Q4_Q1",'
        ' round(ct, 6) "total_ct_chng_Q4_Q1" from caps',
        CAPS,
    ),
    "mean_variance_summary": with_feat(
        _union(
            "select '@' \"column\", "
            + _significant('avg("@")')
            + " mean, "
            + _significant('var_samp("@")')
            + " variance from feat",
            SUMMARY,
        )
    ),
    "mean_variance_wide": with_feat(
        "select 'mean' statistic, "
        + ", ".join(_significant(f'avg("{c}")') + f' "{c}"' for c in SUMMARY)
        + " from feat union all select 'variance', "
        + ", ".join(_significant(f'var_samp("{c}")') for c in SUMMARY)
        + " from feat"
    ),
    "kpi_means": with_gold(
        "select "
        + ", ".join(f'round(avg("{c}"), 4) "{c}"' for c in schemas.KPI_MEAN_COLUMNS)
        + " from gold"
    ),
    "kpi_avg_credit_limit": with_gold("select round(avg(credit_limit), 4) avg_credit_limit from gold"),
    "kpi_total_customers": with_gold("select count(distinct customer_id) total_customers from gold"),
    "kpi_avg_revolving_bal": with_gold(
        "select round(avg(total_revolving_bal), 4) total_revolving_bal from gold"
    ),
    "kpi_status_counts": with_feat(
        f"select case when {LABEL} = 1 then 'Attrited' else 'Active' end status,"
        " count(*) customers from feat group by 1"
    ),
    "kpi_total_transactions": with_gold("select count(transaction_date) transaction_date from gold"),
    "crosstab": with_feat(
        f'select contacts_count_12mo "value", count(*) filter ({LABEL} = 0) label_0,'
        f" count(*) filter ({LABEL} = 1) label_1 from feat"
        " where contacts_count_12mo is not null group by 1"
    ),
    "chi_square": with_feat(
        "select feature, round(case when dof = 1 then yates when dof > 0 then plain else 0.0 end, 6)"
        " statistic, dof from (select feature, cast((count(*) - 1) * ((case when max(t0) > 0 then 1"
        " else 0 end + case when max(t1) > 0 then 1 else 0 end) - 1) as bigint) dof,"
        f" {_PLAIN} plain, {_YATES} yates from tested group by 1)",
        _contingency(FEATURES),
    ),
    # With an even number of degrees of freedom the tail is a finite sum.
    "chi_square_p_even": with_feat(
        "select feature, dof, round(list_sum(list_transform(range(0, dof // 2),"
        " lambda i: exp(-plain / 2 + i * ln(plain / 2) - lgamma(i + 1)))), 6) p_value from ("
        "select feature, cast((count(*) - 1) * ((case when max(t0) > 0 then 1"
        " else 0 end + case when max(t1) > 0 then 1 else 0 end) - 1) as bigint) dof,"
        f" {_PLAIN} plain from tested group by 1) where dof % 2 = 0 and dof between 2 and 60",
        _contingency(FEATURES),
    ),
    "chi_square_expected": with_feat(
        'select feature, "value", o0 observed_0, o1 observed_1,'
        " round(e0, 6) expected_0, round(e1, 6) expected_1 from tested",
        _contingency(["contacts_count_12mo", *CATEGORICAL]),
    ),
    # The lower tail as a power series; its terms end some way beyond the statistic.
    "chi_square_test": with_feat(
        "select feature, round(s, 6) statistic, dof, round(case when dof <= 0 or s <= 0 then 1.0 else greatest(0.0,"
        " 1 - list_sum(list_transform(range(0, cast(100 + s / 2 + 12 * sqrt(s + dof) as bigint)),"
        " lambda i: exp(-s / 2 + (dof / 2.0::double + i) * ln(s / 2) - lgamma(dof / 2.0::double + i + 1))))) end, 6) p_value from ("
        "select feature, dof, case when dof = 1 then yates when dof > 0 then plain else 0.0 end s from ("
        "select feature, cast((count(*) - 1) * ((case when max(t0) > 0 then 1"
        " else 0 end + case when max(t1) > 0 then 1 else 0 end) - 1) as bigint) dof,"
        f" {_PLAIN} plain, {_YATES} yates from tested group by 1))",
        _contingency(FEATURES),
    ),
    "anova_f": with_feat("select feature, round(f_score, 6) f_score from scores", _ANOVA),
    "low_variance": with_feat(
        "select * from ("
        + _union("select '@' \"column\", round(var_pop(\"@\"), 6) variance from feat", SUMMARY)
        + ") where not variance > 0.1"
    ),
    "high_variance": with_feat(
        'select "column", ' + _significant("variance") + " variance from ("
        + _union("select '@' \"column\", var_pop(\"@\") variance from feat", SUMMARY)
        + ") where variance > 0.1"
    ),
    "first_row_per_customer": with_gold(
        f"select {GOLD} from (select *, row_number() over (partition by customer_id order by {_ORDER})"
        " rn from gold) where rn = 1"
    ),
    # sorts, limits, samples
    "sort_desc": with_feat(
        "select feature, round(f_score, 6) f_score from scores order by 2 desc, 1", _ANOVA
    ),
    "drop_tail": with_feat(
        "select feature, round(f_score, 6) f_score from scores"
        f" order by 2 desc nulls last, 1 limit {len(FEATURES) - 8}",
        _ANOVA,
    ),
    "select_k_best": with_feat(
        "select customer_id, feature, round(x, 6) \"value\" from ("
        + _union("select customer_id, '@' feature, cast(\"@\" as double) x from feat", FEATURES)
        + ") where feature in (select feature from scores order by f_score desc nulls last, feature limit 4)",
        _ANOVA,
    ),
    "head_n": with_cc(
        "select * replace (round(income, 6) as income, round(customer_age, 6) as customer_age)"
        " from clean order by customer_id limit 30",
        _CLEAN,
    ),
    "sample_n": with_cc(
        f"select * from cc_customer order by {_hash('customer_id')}, customer_id limit 10"
    ),
    "shuffle": with_cc(f"select *, {_hash('customer_id')} \"position\" from cc_customer"),
    # scalar functions
    "parse_date": with_cc(
        "select transaction_id, cast(transaction_date as varchar) \"text\","
        " transaction_date parsed from cc_transactions"
    ),
    "date_parts": with_cc(
        'select transaction_id, cast(month(transaction_date) as integer) "month",'
        ' cast(year(transaction_date) as integer) "year" from cc_transactions'
    ),
    "fill_constant": with_gold(
        "select customer_id, coalesce(status, 'Existing Customer') status from j1"
    ),
    "impute_mode": with_cc(
        f"select * replace (coalesce(marital_status, {_mode('marital_status')}) as marital_status,"
        f" coalesce(education_level, {_mode('education_level')}) as education_level) from cc_customer"
    ),
    "impute_median": with_cc(
        f"select * replace (round(coalesce(income, {_MEDIAN}), 6) as income) from cc_customer"
    ),
    "one_hot": with_gold(
        f"select customer_id, account_id, transaction_id, {DUMMIES} from gold"
    ),
    "one_hot_accounts": with_gold(
        f"select customer_id, account_id, {DUMMIES} from"
        " (select * replace (coalesce(status, 'Existing Customer') as status) from j3"
        " where total_relationship_count is not null)"
    ),
    "zscore": with_model(
        f"select customer_id, {_rounded(schemas.MODEL_FEATURES)}, {LABEL} from scaled", SCALED
    ),
    "user_prefix": (
        "select c_custkey, replace(split_part(replace(lower(c_name), '#', '.') || '@example.com',"
        " '@', 1), '.', '_') || '_' prefix from customer"
    ),
    "bool_label": with_cc(
        "select row_id, cast(score > 0.5 as integer) label from cc_predictions"
    ),
    # models and evaluation
    "split_70_15_15": with_cc("select customer_id, part from parts", _split("cc_customer")),
    "split_by_hash": with_cc(
        "select customer_id, case when u < 0.7 then 'train' when u < 0.85 then 'validate'"
        " else 'test' end part from (select customer_id,"
        f" {_hash('customer_id')} / 4503599627370496.0::double u from cc_customer)"
    ),
    "knn_classify": "with "
    + _nearest(
        "list_distance(q.v, t.v)",
        "select vec_id, label, cast(embedding as double[]) v from embeddings where vec_id % 10 <> 0",
        "select vec_id, cast(embedding as double[]) v from embeddings where vec_id % 10 = 0",
        "vec_id",
        5,
    )
    + " select vec_id, prediction from voted where r = 1",
    "knn_customers": with_model(
        "select customer_id, prediction from voted where r = 1",
        SCALED,
        _nearest(
            f"sqrt({_SQUARES})",
            f"select {_KNN_COLUMNS} from scaled where part = 'train'",
            f"select {_KNN_COLUMNS} from scaled where part = 'test'",
            "customer_id",
            265,
        ),
    ),
    "logistic_moments": with_model(
        _union(f"select '@' feature, round(sum(cast({LABEL} as double) * \"@\"), 5) moment from scaled where part = 'train'", schemas.MODEL_FEATURES)
        + f" union all select 'intercept', round(sum(cast({LABEL} as double)), 5) from scaled where part = 'train'",
        SCALED,
    ),
    "majority_baseline": with_model(
        f"select customer_id, {LABEL} label, (select {LABEL} from parts where part = 'train'"
        f" group by 1 order by count(*) desc, 1 limit 1) prediction from parts where part = 'test'"
    ),
    "gaussian_nb": with_model(
        "select customer_id, label, case when s > 0 then 1 else 0 end prediction, round(s, 6) score"
        f" from (select customer_id, {LABEL} label, ({_log_likelihood(1)}) - ({_log_likelihood(0)}) s"
        " from parts, nb where part = 'test')",
        f"nb as (select {_NB_STATS}, {_NB_LARGEST} * 1e-9 rise,"
        f" count(*) filter ({LABEL} = 0) / count(*)::double p0,"
        f" count(*) filter ({LABEL} = 1) / count(*)::double p1 from parts where part = 'train')",
    ),
    "confusion_matrix": with_cc(
        "select label, count(*) filter (prediction = 0) predicted_0,"
        " count(*) filter (prediction = 1) predicted_1 from cc_predictions group by 1"
    ),
    "classification_report": _report(),
    "binary_metrics": with_cc(
        f"select {_METRIC_COLUMNS} from cells", f"cells as ({_CELLS} from cc_predictions)"
    ),
    "roc_auc_hard": with_cc(
        f"select round({_BALANCED}, 6) roc_auc_hard from cells",
        f"cells as ({_CELLS} from cc_predictions)",
    ),
    "roc_auc_score": with_cc(
        "select round((sum(r) filter (label = 1) - p * (p + 1) / 2.0::double) / (p * n), 6) roc_auc"
        " from (select label, rank() over (order by score)"
        " + (count(*) over (partition by score) - 1) / 2.0::double r,"
        " count(*) filter (label = 1) over () p, count(*) filter (label = 0) over () n"
        " from cc_predictions) group by p, n"
    ),
    "log_loss": with_cc(
        "select round(avg(-(label * ln(score) + (1 - label) * ln(1 - score))), 6) log_loss"
        " from cc_predictions"
    ),
    "compare_models": with_cc(f"select model, {_METRIC_COLUMNS} from by_model", _MODELS),
    "run_log": with_cc(
        "select * from ("
        + "\nunion all\n".join(
            f"select model run_name, 'metric' kind, '{m}' \"key\", round({x}, 6) \"value\" from by_model"
            for m, x in METRICS.items()
        )
        + " union all select model, 'param', 'threshold', 0.5 from by_model)",
        _MODELS,
    ),
    "filter_run": with_cc(
        "select 'score' run_name, kind, \"key\", \"value\" from ("
        + "\nunion all\n".join(
            f"select 'metric' kind, '{m}' \"key\", round({x}, 6) \"value\" from by_model where model = 'score'"
            for m, x in METRICS.items()
        )
        + " union all select 'param', 'threshold', 0.5)",
        _MODELS,
    ),
    "run_search": with_cc(
        f"select model run_name, {_METRIC_COLUMNS} from by_model where model <> 'majority'", _MODELS
    ),
}
