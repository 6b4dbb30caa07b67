"""DuckDB SQL twins of the registered queries (``plans.queries``), over the
same Parquet tables. Used as the correctness oracle: each statement is
code path."""

from __future__ import annotations

from paymart.sources.adapters import ORACLE_CTES

RUN_DATE_SQL = "DATE '2024-01-05'"

_CHECKS = """
rec_json AS (
    SELECT "partition", "offset", "timestamp", value AS raw,
        CASE WHEN value IS NOT NULL AND trim(value) <> '' AND json_valid(value) THEN value END AS js
    FROM records
),
rec_fields AS (
    SELECT *, json_extract_string(js, '$.object_id') AS object_id, json_extract_string(js, '$.object_type') AS object_type,
        json_extract_string(js, '$.payload') AS payload, json_extract_string(js, '$.sent_dttm') AS sent,
        json_type(js, '$.sent_dttm') = 'VARCHAR' AS quoted
    FROM rec_json
),
decoded AS (
    SELECT "partition", "offset", "timestamp", raw, object_id, object_type,
        CASE WHEN NOT quoted AND TRY_CAST(sent AS BIGINT) < 253402300800 THEN make_timestamp(TRY_CAST(sent AS BIGINT) * 1000000)
             WHEN NOT quoted THEN NULL
             WHEN ends_with(sent, '+03:00') THEN TRY_CAST(left(sent, length(sent) - 6) AS TIMESTAMP) - INTERVAL 3 HOUR
             WHEN regexp_matches(sent, '^[0-9]{4}-') THEN TRY_CAST(sent AS TIMESTAMP) END AS sent_dttm,
        payload,
        CASE WHEN raw IS NULL OR trim(raw) = '' THEN 'empty_value'
             WHEN js IS NULL THEN 'malformed_json'
             WHEN object_id IS NULL THEN 'missing_object_id' END AS reason
    FROM rec_fields
),
landing AS (
    SELECT object_id, object_type, sent_dttm, payload
    FROM decoded WHERE reason IS NULL
    QUALIFY row_number() OVER (PARTITION BY object_id ORDER BY "partition", "offset") = 1
),
rate_json AS (
    SELECT sent_dttm, payload AS raw, payload IS NOT NULL AND json_valid(payload) AS ok
    FROM landing WHERE object_type = 'CURRENCY'
),
rate_fields AS (
    SELECT sent_dttm, raw, ok,
        CASE WHEN ok THEN json_extract_string(raw, '$.date_update') END AS date_update,
        CASE WHEN ok THEN json_extract_string(raw, '$.currency_code') END AS currency_code,
        CASE WHEN ok THEN json_extract_string(raw, '$.currency_code_with') END AS currency_code_with,
        CASE WHEN ok THEN json_extract_string(raw, '$.currency_with_div') END AS currency_with_div
    FROM rate_json
),
rates_checked AS (
    SELECT sent_dttm, raw,
        TRY_CAST(date_update AS DATE) AS date_update,
        currency_code, currency_code_with,
        TRY_CAST(currency_with_div AS DECIMAL(18,6)) AS currency_code_div,
        CASE WHEN raw IS NULL THEN 'missing_payload'
             WHEN NOT ok THEN 'malformed_payload'
             WHEN date_update IS NULL THEN 'missing_date_update'
             WHEN currency_code IS NULL THEN 'missing_currency_code'
             WHEN currency_code_with IS NULL THEN 'missing_currency_code_with'
             WHEN currency_with_div IS NULL THEN 'missing_currency_with_div'
             WHEN TRY_CAST(date_update AS DATE) IS NULL THEN 'bad_date_update'
             WHEN TRY_CAST(currency_with_div AS DECIMAL(18,6)) IS NULL THEN 'bad_currency_with_div'
        END AS reason
    FROM rate_fields
),
src_checked AS (
    SELECT operation_id, account_number_from, account_number_to, currency_code, country, status,
        transaction_type, amount, date_trunc('millisecond', transaction_dt) AS transaction_dttm,
        CASE WHEN operation_id IS NULL THEN 'missing_operation_id'
             WHEN account_number_from IS NULL THEN 'missing_account_number_from'
             WHEN account_number_to IS NULL THEN 'missing_account_number_to'
             WHEN currency_code IS NULL THEN 'missing_currency_code'
             WHEN country IS NULL THEN 'missing_country'
             WHEN status IS NULL THEN 'missing_status'
             WHEN transaction_type IS NULL THEN 'missing_transaction_type'
             WHEN amount IS NULL THEN 'missing_amount'
             WHEN transaction_dt IS NULL THEN 'missing_transaction_dt' END AS reason,
        concat_ws('|',
            coalesce(operation_id, ''), coalesce(CAST(account_number_from AS VARCHAR), ''),
            coalesce(CAST(account_number_to AS VARCHAR), ''), coalesce(currency_code, ''),
            coalesce(country, ''), coalesce(status, ''), coalesce(transaction_type, ''),
            coalesce(CAST(amount AS VARCHAR), ''),
            coalesce(strftime(transaction_dt, '%Y-%m-%d %H:%M:%S.%f'), '')) AS raw
    FROM src_tx
),
conformed AS (
    SELECT operation_id, account_number_from, account_number_to, currency_code, country, status,
        transaction_type, amount, transaction_dttm
    FROM src_checked WHERE reason IS NULL
)"""

WITH = "WITH " + ORACLE_CTES.strip() + "," + _CHECKS


def _settled(tx: str, where: str = "TRUE") -> str:
    """Settled transactions with their day: done, no authorisation, a positive account."""
    return f"""SELECT CAST(transaction_dttm AS DATE) AS date_update, currency_code, amount, operation_id,
        account_number_from
    FROM {tx}
    WHERE ({where}) AND account_number_from > 0 AND status = 'done' AND transaction_type != 'authorisation'"""


def _metrics(tx: str, rates: str, day: str | None = None, tx_where: str = "TRUE") -> str:
    """Mart rows over a transactions relation and a rates relation: what each
    account paid per day and currency, in the base currency, then summed up."""
    only = f"s.date_update = {day}" if day else "TRUE"
    return f"""(
    WITH accounts AS (
        SELECT date_update, s.currency_code, account_number_from, count(operation_id) AS n,
            sum(CAST(amount * currency_code_div AS DECIMAL(38,6))) AS paid
        FROM ({_settled(tx, tx_where)}) s
        JOIN (SELECT date_update, currency_code_with AS currency_code, currency_code_div
              FROM {rates} WHERE currency_code = '420') USING (date_update, currency_code)
        WHERE {only} GROUP BY ALL)
    SELECT date_update, currency_code AS currency_from, CAST(sum(paid) AS DECIMAL(38,6)) AS amount_total,
        CAST(sum(n) AS BIGINT) AS cnt_transactions,
        CAST(sum(n) AS DOUBLE) / count(*) AS avg_transactions_per_account,
        count(*) AS cnt_accounts_make_transactions
    FROM accounts GROUP BY date_update, currency_code
)"""


_SETTLED = f"""
settled AS (
    {_settled('stg_tx')}
)"""

_PIPE_RATES = """
p_rates AS (
    SELECT date_update, currency_code, currency_code_with, currency_code_div
    FROM rates_checked WHERE reason IS NULL {cond}
),
p_tx AS (
    SELECT * FROM conformed WHERE TRUE {tx_cond}
)"""

# what the first drain has stays; then the first message of each new key
_TWO_DRAINS = """
two_drains AS (
    SELECT object_id, object_type, sent_dttm, payload FROM decoded WHERE reason IS NULL
    QUALIFY row_number() OVER (
        PARTITION BY object_id
        ORDER BY "timestamp" >= TIMESTAMP '2024-01-16 00:00:00', "partition", "offset") = 1
)"""


# three micro-batches by time; the first one's message of a key stays
_EPOCHS = """
epochs AS (
    SELECT object_id, object_type, sent_dttm, payload FROM decoded WHERE reason IS NULL
    QUALIFY row_number() OVER (
        PARTITION BY object_id
        ORDER BY ("timestamp" >= TIMESTAMP '2024-01-11') :: INT + ("timestamp" >= TIMESTAMP '2024-01-21') :: INT,
            "partition", "offset") = 1
)"""

# what each stage's run reads, keeps and writes on two days, one after the other
_RUNS = """
run_dates AS (SELECT unnest([DATE '2024-01-05', DATE '2024-01-06']) AS run_date),
counted AS (
    SELECT 'landing' AS stage, run_date, count(*) AS "read", count(*) FILTER (WHERE reason IS NULL) AS valid,
        count(*) FILTER (WHERE reason IS NOT NULL) AS rejected,
        CASE WHEN run_date = DATE '2024-01-05' THEN count(DISTINCT object_id) FILTER (WHERE reason IS NULL) ELSE 0 END AS written
    FROM decoded, run_dates GROUP BY run_date
    UNION ALL
    SELECT 'currencies', run_date, count(reason_known), count(*) FILTER (WHERE reason_known AND reason IS NULL),
        count(*) FILTER (WHERE reason IS NOT NULL), count(*) FILTER (WHERE reason_known AND reason IS NULL)
    FROM run_dates LEFT JOIN (SELECT *, TRUE AS reason_known FROM rates_checked) r ON CAST(sent_dttm AS DATE) = run_date GROUP BY run_date
    UNION ALL
    SELECT 'transactions', run_date, count(reason_known), count(*) FILTER (WHERE reason_known AND reason IS NULL),
        count(*) FILTER (WHERE reason IS NOT NULL), count(*) FILTER (WHERE reason_known AND reason IS NULL)
    FROM run_dates LEFT JOIN (SELECT *, TRUE AS reason_known FROM src_checked) t
        ON CAST(transaction_dttm AS DATE) = run_date GROUP BY run_date
    UNION ALL
    SELECT 'mart', run_date, NULL, NULL, NULL, count(m.date_update)
    FROM run_dates LEFT JOIN {metrics} m ON m.date_update = run_date GROUP BY run_date
)"""


def _text_checked(where: str = "TRUE") -> str:
    """The all-text source, checked: a null is missing, what does not cast is bad."""
    columns = ["operation_id", "account_number_from", "account_number_to", "currency_code", "country", "status",
               "transaction_type", "amount", "transaction_dt"]
    kinds = {"account_number_from": "BIGINT", "account_number_to": "BIGINT", "amount": "BIGINT",
             "transaction_dt": "TIMESTAMP"}
    missing = " ".join(f"WHEN {c} IS NULL THEN 'missing_{c}'" for c in columns)
    bad = " ".join(f"WHEN TRY_CAST({c} AS {k}) IS NULL THEN 'bad_{c}'" for c, k in kinds.items())
    typed = ", ".join(f"TRY_CAST({c} AS {kinds[c]}) AS {c}" if c in kinds else c for c in columns[:-1])
    raw = ", ".join(f"coalesce({c}, '')" for c in columns)
    return f"""SELECT {typed}, date_trunc('millisecond', TRY_CAST(transaction_dt AS TIMESTAMP)) AS transaction_dttm,
        CASE {missing} {bad} END AS reason, concat_ws('|', {raw}) AS raw,
        CAST(TRY_CAST(transaction_dt AS TIMESTAMP) AS DATE) AS run_date
    FROM src_text WHERE {where}"""


ORACLE: dict[str, str] = {
    "envelope_decode": f"""{WITH}
SELECT object_id, object_type, sent_dttm, payload FROM decoded WHERE reason IS NULL""",

    "envelope_rejects": f"""{WITH}
SELECT 'landing' AS stage, reason, raw, CAST(NULL AS DATE) AS run_date
FROM decoded WHERE reason IS NOT NULL""",

    "landing_insert_ignore": f"""{WITH}, {_TWO_DRAINS}
SELECT * FROM two_drains""",

    "landing_stream": f"""{WITH}, {_TWO_DRAINS}
SELECT * FROM two_drains""",

    "landing_checkpoint_lost": f"""{WITH}, {_TWO_DRAINS}
SELECT * FROM two_drains""",

    "landing_key_index": f"""{WITH}
SELECT object_id, object_type, sent_dttm, payload FROM decoded
WHERE reason IS NULL AND CAST("timestamp" AS DATE) IN (DATE '2024-01-05', DATE '2024-01-20')
    AND object_id NOT IN (SELECT object_id FROM decoded
                          WHERE reason IS NULL AND "timestamp" < TIMESTAMP '2024-01-16 00:00:00')
QUALIFY row_number() OVER (PARTITION BY object_id ORDER BY "partition", "offset") = 1""",

    "landing_micro_batches": f"""{WITH}, {_EPOCHS}
SELECT * FROM epochs""",

    "currency_extract": f"""{WITH}
SELECT object_id, payload, sent_dttm FROM landing
WHERE object_type = 'CURRENCY' AND CAST(sent_dttm AS DATE) = {RUN_DATE_SQL}""",

    "currency_payload": f"""{WITH}
SELECT date_update, currency_code, currency_code_with, currency_code_div
FROM rates_checked WHERE reason IS NULL""",

    "currency_rejects": f"""{WITH}
SELECT 'currencies' AS stage, reason, raw, CAST(NULL AS DATE) AS run_date
FROM rates_checked WHERE reason IS NOT NULL""",

    "currencies_replace_by_date": f"""{WITH},
new_rates AS (
    SELECT date_update, currency_code, currency_code_with, currency_code_div
    FROM rates_checked
    WHERE reason IS NULL AND CAST(sent_dttm AS DATE) IN (DATE '2024-01-05', DATE '2024-01-06')
)
SELECT * FROM new_rates
UNION ALL
SELECT * FROM stg_rates o
WHERE NOT EXISTS (SELECT 1 FROM new_rates n WHERE n.date_update = o.date_update)""",

    "transactions_extract": f"""{WITH}
SELECT operation_id, account_number_from, account_number_to, currency_code, country, status,
    transaction_type, amount, transaction_dt
FROM src_tx WHERE CAST(transaction_dt AS DATE) = {RUN_DATE_SQL}""",

    "transactions_required": f"""{WITH}
SELECT operation_id, account_number_from, account_number_to, currency_code, country, status,
    transaction_type, amount, transaction_dt
FROM src_tx
WHERE operation_id IS NOT NULL AND account_number_from IS NOT NULL AND account_number_to IS NOT NULL
  AND currency_code IS NOT NULL AND country IS NOT NULL AND status IS NOT NULL
  AND transaction_type IS NOT NULL AND amount IS NOT NULL AND transaction_dt IS NOT NULL""",

    "transactions_conform": f"""{WITH}
SELECT * FROM conformed""",

    "transactions_rejects": f"""{WITH}
SELECT 'transactions' AS stage, reason, raw, CAST(NULL AS DATE) AS run_date
FROM src_checked WHERE reason IS NOT NULL""",

    "transactions_text_conform": f"""{WITH}
SELECT * EXCLUDE (reason, raw, run_date) FROM ({_text_checked()}) WHERE reason IS NULL""",

    "transactions_text_rejects": f"""{WITH}
SELECT 'transactions' AS stage, reason, raw, CAST(NULL AS DATE) AS run_date
FROM ({_text_checked()}) WHERE reason IS NOT NULL""",

    "transactions_upsert": f"""{WITH},
tgt AS (SELECT * FROM conformed WHERE transaction_type <> 'purchase'),
srcu AS (
    SELECT operation_id, account_number_from, account_number_to, currency_code, country, status,
        transaction_type, amount + 1 AS amount, transaction_dttm
    FROM conformed WHERE status = 'done'
)
SELECT * FROM srcu
UNION ALL
SELECT * FROM tgt t
WHERE NOT EXISTS (SELECT 1 FROM srcu s
                  WHERE s.operation_id = t.operation_id AND s.transaction_dttm = t.transaction_dttm)""",

    "settled_transactions": f"""{WITH},{_SETTLED}
SELECT * FROM settled""",

    "rate_join": f"""{WITH},{_SETTLED}
SELECT s.date_update, s.currency_code, s.amount, s.operation_id, s.account_number_from,
    c.currency_code_div, CAST(s.amount * c.currency_code_div AS DECIMAL(38,6)) AS amount_base
FROM settled s
JOIN stg_rates c ON s.date_update = c.date_update AND s.currency_code = c.currency_code_with
    AND c.currency_code = '420'""",

    "global_metrics": f"""{WITH}
SELECT * FROM {_metrics('stg_tx', 'stg_rates')}""",

    "global_metrics_day": f"""{WITH}
SELECT * FROM {_metrics('stg_tx', 'stg_rates', RUN_DATE_SQL)}""",

    "global_metrics_sql": f"""{WITH}
SELECT * FROM {_metrics('stg_tx', 'stg_rates', RUN_DATE_SQL)}""",

    "global_metrics_function": f"""{WITH}
SELECT * FROM {_metrics('stg_tx', 'stg_rates', RUN_DATE_SQL)}""",

    "global_metrics_upsert": f"""{WITH},
tgt AS (SELECT * FROM {_metrics('stg_tx', 'stg_rates', None,
                                "transaction_type <> 'purchase' AND currency_code <> '419'")}),
src AS (SELECT * FROM {_metrics('stg_tx', 'stg_rates', None, "currency_code <> '416'")})
SELECT * FROM src
UNION ALL
SELECT * FROM tgt t
WHERE NOT EXISTS (SELECT 1 FROM src s
                  WHERE s.date_update = t.date_update AND s.currency_from = t.currency_from)""",

    "mart_replace_day": f"""{WITH}
SELECT * FROM {_metrics('stg_tx', 'stg_rates')} WHERE date_update <> {RUN_DATE_SQL}
UNION ALL
SELECT * FROM {_metrics('stg_tx', 'stg_rates', RUN_DATE_SQL, "currency_code <> '416'")}""",

    "currencies_deduped": f"""{WITH}
SELECT date_update, currency_code, currency_code_with, min(currency_code_div) AS currency_code_div
FROM stg_rates_repeated GROUP BY ALL""",

    "emptiness": f"""{WITH},{_SETTLED},
asked AS (SELECT unnest([{RUN_DATE_SQL}, DATE '2031-01-01']) AS run_date)
SELECT run_date, run_date NOT IN (SELECT date_update FROM settled) AS is_empty FROM asked""",

    "load_counters": f"""{WITH}
SELECT 'landing' AS stage, CAST("timestamp" AS DATE) AS run_date, COUNT(*) AS rows_read,
    COUNT(*) FILTER (WHERE reason IS NULL) AS rows_valid,
    COUNT(*) FILTER (WHERE reason IS NOT NULL) AS rows_rejected
FROM decoded GROUP BY 1, 2
UNION ALL
SELECT 'currencies', CAST(sent_dttm AS DATE), COUNT(*),
    COUNT(*) FILTER (WHERE reason IS NULL), COUNT(*) FILTER (WHERE reason IS NOT NULL)
FROM rates_checked GROUP BY 1, 2
UNION ALL
SELECT 'transactions', CAST(transaction_dttm AS DATE), COUNT(*),
    COUNT(*) FILTER (WHERE reason IS NULL), COUNT(*) FILTER (WHERE reason IS NOT NULL)
FROM src_checked GROUP BY 1, 2""",

    "accounts_by_month": f"""{WITH},{_SETTLED}
SELECT CAST(date_trunc('month', date_update) AS DATE) AS month, currency_code AS currency_from,
    count(DISTINCT account_number_from) AS accounts
FROM settled GROUP BY 1, 2""",

    "mart_refresh": f"""{WITH},
corrected AS (
    SELECT * REPLACE (CASE WHEN CAST(transaction_dttm AS DATE) = {RUN_DATE_SQL} THEN amount + 1 ELSE amount END AS amount)
    FROM conformed)
SELECT * FROM {_metrics('corrected', 'stg_rates')}""",

    "load_totals": f"""{WITH},{_PIPE_RATES.format(
        cond="AND CAST(sent_dttm AS DATE) IN (DATE '2024-01-05', DATE '2024-01-06')", tx_cond="")},
{_RUNS.format(metrics=_metrics('p_tx', 'p_rates'))}
SELECT stage, CAST(row_number() OVER so_far AS INTEGER) AS run_no, run_date, "read", valid, rejected, written,
    CAST(sum(coalesce("read", 0)) OVER so_far AS BIGINT) AS total_read,
    CAST(sum(written) OVER so_far AS BIGINT) AS total_written
FROM counted WINDOW so_far AS (PARTITION BY stage ORDER BY run_date ROWS UNBOUNDED PRECEDING)""",

    "missing_rates": f"""{WITH},{_SETTLED}
SELECT s.* FROM settled s
WHERE NOT EXISTS (SELECT 1 FROM stg_rates r
                  WHERE r.currency_code = '420' AND r.date_update = s.date_update
                    AND r.currency_code_with = s.currency_code)""",

    "run_day": f"""{WITH},{_PIPE_RATES.format(cond=f"AND CAST(sent_dttm AS DATE) = {RUN_DATE_SQL}",
                                               tx_cond=f"AND CAST(transaction_dttm AS DATE) = {RUN_DATE_SQL}")}
SELECT * FROM {_metrics('p_tx', 'p_rates', RUN_DATE_SQL)}""",

    "run_days": f"""{WITH},{_PIPE_RATES.format(cond="", tx_cond="")}
SELECT * FROM {_metrics('p_tx', 'p_rates')}""",

    "run_days_rejects": f"""{WITH}
SELECT 'landing' AS stage, coalesce(reason, 'undated') AS reason, raw, CAST(NULL AS DATE) AS run_date
FROM decoded WHERE reason IS NOT NULL OR sent_dttm IS NULL
UNION ALL
SELECT 'currencies', reason, raw, CAST(sent_dttm AS DATE) FROM rates_checked WHERE reason IS NOT NULL
UNION ALL
SELECT 'transactions', reason, raw, run_date FROM ({_text_checked()}) WHERE reason IS NOT NULL""",
}
