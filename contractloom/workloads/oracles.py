"""The expected result of every query in SQL, from the base tables by the rules of ``fixture``.

Nothing here parses a line or a document, so a fault in parsing cannot hide.
"""

from __future__ import annotations

import textwrap

from contractloom.operators.requests import PROTOCOL
from contractloom.spec.dictionary import field_tags, request_schema
from contractloom.spec.layouts import LAYOUTS
from contractloom.workloads.fixture import RESPONSE_CODES, WITHDRAWAL_TYPES

RUN_TS = "2026-03-31 12:00:00"

# Contracts of an order: the base and its twins.
CONTRACTS = """
contracts AS (
  SELECT o.*, o.o_orderkey AS k, o.o_custkey AS c, t.twin,
         'C' || lpad(o.o_orderkey::VARCHAR, 10, '0') || t.suffix AS contract,
         'C' || lpad(o.o_orderkey::VARCHAR, 10, '0') AS base,
         'POS_' || (o.o_orderkey % 4)::VARCHAR || '_20260331.txt' AS file,
         (o.o_orderkey * 3 + t.twin) * 1048576 AS place,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'RA' WHEN '2-HIGH' THEN 'SC'
              WHEN '3-MEDIUM' THEN 'TW' ELSE 'AV' END AS qualifier,
         CASE WHEN o.o_orderkey % 17 = 0 THEN 0.0::DOUBLE ELSE o.o_totalprice END AS amount_1,
         CASE WHEN o.o_orderkey % 17 = 0 THEN '0.00'
              ELSE o.o_totalprice::DECIMAL(18,2)::VARCHAR END AS amount_1_text,
         CASE WHEN o.o_orderkey % 19 = 0 THEN (o.o_orderkey % 500 + 0.25)::DOUBLE END AS amount_3,
         CASE o.o_orderstatus WHEN 'O' THEN 'VA' WHEN 'F' THEN 'AA' ELSE 'SU' END AS status,
         CASE WHEN (o.o_custkey + CASE WHEN t.twin = 2 THEN 1 ELSE 0 END) % 2 = 0
              THEN '0015' ELSE '0255' END AS contra,
         CASE WHEN o.o_orderkey % 31 = 0 THEN '' ELSE '1' || lpad(o.o_custkey::VARCHAR, 8, '0')
         END AS owner_id,
         CASE WHEN o.o_orderkey % 12 = 0 THEN '' ELSE '2' || lpad(o.o_custkey::VARCHAR, 8, '0')
         END AS ann_id
  FROM orders o JOIN (VALUES (0, ''), (1, 'MV'), (2, 'TR')) t(twin, suffix)
    ON t.twin = 0 OR (t.twin = 1 AND o.o_orderkey % 10 = 0)
       OR (t.twin = 2 AND o.o_orderkey % 20 = 0)
)"""

FIRST_ITEMS = """
first_items AS (
  SELECT l_orderkey, l_suppkey AS s FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                 ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
    FROM lineitem) WHERE rn = 1
)"""

ITEMS = """
items AS (
  SELECT c.*, l.*, c.place + 1000 + l.l_linenumber * 100000 + l.l_partkey % 100000 AS line_no
  FROM contracts c JOIN lineitem l ON l.l_orderkey = c.k
)"""

# What is known of a contract after parsing.
FACTS = f"""{CONTRACTS}, {FIRST_ITEMS},
facts AS (
  SELECT c.*, f.s,
    CASE WHEN f.s IS NULL THEN ''
         WHEN k % 13 = 0 THEN 'NOAGENT'
         WHEN twin = 0 THEN 'N' || lpad((f.s + 1000000)::VARCHAR, 7, '0') || '   N102'
         WHEN k % 70 = 0 THEN 'LONG AGENT TEXT WITHOUT A NUMBER'
         ELSE rpad('700001', 20, ' ') || 'N' || lpad((f.s + 1000000)::VARCHAR, 7, '0') || '   N102'
    END AS agent_last_name,
    CASE WHEN f.s IS NULL THEN '' ELSE 'AGENT' || f.s::VARCHAR END AS agent_last,
    CASE WHEN f.s IS NULL THEN '' ELSE 'ALEX' END AS agent_first,
    CASE WHEN f.s IS NULL OR k % 13 = 0 OR (twin > 0 AND k % 70 = 0) THEN ''
         ELSE lpad((f.s + 1000000)::VARCHAR, 7, '0') END AS producer,
    CASE WHEN k % 50 = 0 THEN 'B' ELSE 'A' END || c.c::VARCHAR AS account,
    lpad(((CASE WHEN k % 50 = 0 THEN c.c + 1 ELSE c.c END) % 50)::VARCHAR, 2, '0') AS state,
    'CU' || lpad(c.c::VARCHAR, 7, '0') AS cusip,
    CASE WHEN qualifier = 'RA' AND amount_1 > 0 THEN amount_1 END AS ra_amount,
    greatest(CASE WHEN qualifier = 'SC' AND amount_1 > 0 THEN amount_1 END, amount_3) AS sc_amount,
    CASE WHEN qualifier = 'TW' AND amount_1 > 0 THEN amount_1 END AS tw_amount,
    greatest(amount_1, (k % 1000 + 0.5)::DOUBLE, coalesce(amount_3, 0.0)) AS total_value,
    k % 11 = 0 AS rider,
    CASE WHEN k % 7 = 0 THEN '' WHEN k % 9 = 0 AND k % 27 <> 0 THEN 'TRUST' || c.c::VARCHAR
         ELSE 'OWNER' || c.c::VARCHAR END AS owner_last,
    CASE WHEN k % 7 = 0 OR (k % 9 = 0 AND k % 27 <> 0) THEN '' ELSE 'CASEY' END AS owner_first,
    CASE WHEN k % 7 = 0 OR (k % 9 = 0 AND k % 27 <> 0) THEN '' ELSE 'M' END AS owner_middle
  FROM contracts c LEFT JOIN first_items f ON f.l_orderkey = c.k
)"""

DEDUP = f"""{FACTS},
dedup AS (
  SELECT * EXCLUDE (rn, contra, contract), base AS contract,
         max_contra AS contra FROM (
    SELECT *, row_number() OVER (PARTITION BY base ORDER BY length(agent_last_name) DESC, place) AS rn,
           last_value(contra) OVER (PARTITION BY base ORDER BY place
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS max_contra
    FROM facts) WHERE rn = 1
)"""

CLASSIFIED_BODY = """
  SELECT *,
    CASE WHEN value_type = 'Percent' THEN '10.00'
         WHEN base_amount > 0 THEN printf('%.2f', base_amount * 0.1::DOUBLE) ELSE '0.00'
    END AS withdrawal_value
  FROM (
    SELECT *,
      CASE withdrawal_type WHEN 'RMD' THEN ra_amount WHEN 'Interest Only' THEN sc_amount
           WHEN 'Surrender Free' THEN tw_amount ELSE total_value END AS base_amount,
      CASE WHEN substring(md5(contract), 1, 1) < '8' THEN 'Percent' ELSE 'Amount' END AS value_type,
      md5('{run}|' || base) AS md5_guid
    FROM (
      SELECT *, CASE WHEN ra_amount > 0 THEN 'RMD' WHEN rider THEN 'Rider Free'
                     WHEN sc_amount > 0 THEN 'Interest Only' WHEN tw_amount > 0 THEN 'Surrender Free'
                     ELSE 'Partial Withdrawal' END AS withdrawal_type
      FROM {source}))""".replace("{run}", RUN_TS)

CLASSIFIED = f"""{DEDUP},
active AS (SELECT * FROM dedup WHERE status IN ('VA', 'AA')),
classified AS ({CLASSIFIED_BODY.replace("{source}", "active")})"""

# Requests with the values that differ by contract.
REQUESTS = f"""{CLASSIFIED},
requests AS (
  SELECT *, contract AS "PolNumber", cusip AS "CusipNum", account AS "DistributorClientAcctNum",
    substring(md5_guid, 1, 8) || '-' || substring(md5_guid, 9, 4) || '-' ||
      substring(md5_guid, 13, 4) || '-' || substring(md5_guid, 17, 4) || '-' ||
      substring(md5_guid, 21, 12) AS guid,
    right(owner_id, 4) AS own_ssn,
    CASE WHEN k % 3 = 0 THEN right(ann_id, 4) WHEN k % 7 = 0 THEN '' ELSE right(owner_id, 4)
    END AS ann_ssn,
    CASE WHEN k % 3 = 0 THEN 'ROBIN' ELSE owner_first END AS ann_first,
    CASE WHEN k % 3 = 0 THEN 'ANN' || c::VARCHAR ELSE owner_last END AS ann_last,
    CASE WHEN value_type = 'Percent' THEN '6' ELSE '4' END AS sub_tc,
    CASE WHEN value_type = 'Percent' THEN 'Percentage' ELSE 'Specified Amount' END AS sub_text
  FROM classified
)"""

AUDITED = f"""{REQUESTS},
audited AS (
  SELECT *,
    concat_ws('; ',
      CASE WHEN producer = '' THEN 'Agent NPN/NIPR missing' END,
      CASE WHEN owner_first = '' THEN 'Owner first name missing' END,
      CASE WHEN owner_last = '' THEN 'Owner last name missing' END,
      CASE WHEN own_ssn = '' THEN 'Owner SSN (last 4) missing' END,
      CASE WHEN ann_ssn = '' THEN 'Annuitant SSN (last 4) missing' END,
      CASE WHEN withdrawal_value::DOUBLE <= 0 THEN 'Withdrawal value is 0 or missing' END) AS reasons,
    concat_ws('; ',
      CASE WHEN withdrawal_value::DOUBLE <= 0 THEN '1004900735-X173' END,
      CASE WHEN producer = '' OR owner_first = '' OR owner_last = '' OR own_ssn = '' OR ann_ssn = ''
           THEN '2108-C075' END) AS codes
  FROM requests
)"""

# Requests with one column broken, and the errors of their documents in rule order.
BROKEN = f"""{REQUESTS},
broken AS (
  SELECT *,
    "PolNumber" || CASE WHEN k % 23 = 0 THEN '#' ELSE '' END AS pol,
    CASE WHEN k % 43 = 0 THEN '' ELSE withdrawal_value END AS modal
  FROM requests
),
errs AS (
  SELECT *,
    CASE WHEN k % 29 = 0 THEN 'Field ''TransRefGUID'' value ''short'' does not match pattern ^[0-9a-zA-Z\\-]{{20,36}}$' END AS e_guid,
    CASE WHEN k % 41 = 0 THEN 'Field ''TransType_tc'' has invalid value ''213''; allowed: [''212'']' END AS e_type,
    CASE WHEN k % 23 = 0 THEN 'Field ''PolNumber'' value ''' || pol || ''' does not match pattern ^[A-Za-z0-9\\-]+$' END AS e_pol,
    CASE WHEN k % 31 = 0 THEN 'Required field ''ArrMode_tc'' is missing or empty' END AS e_mode_tc,
    CASE WHEN k % 37 = 0 THEN 'Field ''ArrMode_text'' exceeds max length 30 (got 39)' END AS e_mode_text,
    CASE WHEN k % 43 = 0 AND sub_tc = '4' THEN 'Conditional field ''ModalAmt'' required when ArrSubType tc=4 (Specified Amount)' END AS e_modal,
    CASE WHEN k % 53 = 0 THEN 'Required Party ''Party_Carrier'' not found' END AS e_party,
    CASE WHEN k % 59 = 0 THEN 'Required Relation ''Owner_Relation'' not found' END AS e_relation,
    CASE WHEN k % 47 = 0 THEN concat_ws('; ',
      'Required field ''TaxState_id'' is missing or empty',
      'Required field ''TaxState_AppliesToPartyID'' is missing or empty',
      'Required field ''TaxState_Place_tc'' is missing or empty',
      'Required field ''TaxState_Place_text'' is missing or empty',
      'Required field ''TaxState_Type_tc'' is missing or empty',
      'Required field ''TaxState_Type_text'' is missing or empty') END AS e_state
  FROM broken
),
documents_made AS (
  SELECT *, 'WDQuote_' || pol || '.xml' AS filename,
    concat_ws('; ', e_guid, e_type, e_pol, e_mode_tc, e_mode_text, e_state, e_modal, e_party,
              e_relation) AS errors
  FROM errs
)"""


def _responses() -> str:
    codes = "[" + ", ".join(f"'{c}'" for c in RESPONSE_CODES) + "]"
    types = "[" + ", ".join(f"'{t}'" for t in WITHDRAWAL_TYPES) + "]"
    n = len(RESPONSE_CODES)
    return f"""
answers AS (
  SELECT o_orderkey AS k, '00' || lpad(o_orderkey::VARCHAR, 10, '0') AS policy,
    {types}[(o_orderkey % 5 + 1)::INT] AS wtype, o_orderkey % 3 = 0 AS ok,
    {codes}[(o_orderkey % {n} + 1)::INT] AS code_1,
    {codes}[((o_orderkey + 3) % {n} + 1)::INT] AS code_2,
    CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 41 = 0 THEN 'none'
         WHEN o_orderkey % 37 = 0 THEN 'empty' WHEN o_orderkey % 29 = 0 THEN 'text'
         WHEN o_orderkey % 23 = 0 THEN 'object' WHEN o_orderkey % 2 = 0 THEN 'two' ELSE 'one'
    END AS shape
  FROM orders
),
pairs AS (
  SELECT k, policy, wtype, ok, 0 AS pos, code_1 AS code,
         'about ' || code_1 || ' in row ' || (k % 5)::VARCHAR AS descr
  FROM answers WHERE shape IN ('one', 'two')
  UNION ALL
  SELECT k, policy, wtype, ok, 1, code_2, 'about ' || code_2 || ' in row ' || (k % 5)::VARCHAR
  FROM answers WHERE shape = 'two'
  UNION ALL
  SELECT k, policy, wtype, ok, 0, left(t, 40), t FROM (
    SELECT *, CASE shape WHEN 'text' THEN
      '300-System is not available at this time, please try again later'
      ELSE '{{"ResultInfoCode": "2027"}}' END AS t FROM answers WHERE shape IN ('text', 'object'))
),
coded AS (
  SELECT a.k, a.policy, a.wtype, a.ok, a.shape, count(p.code) AS n_errors,
         coalesce(string_agg(p.code, '; ' ORDER BY p.pos), '') AS codes,
         min(CASE WHEN p.pos = 0 THEN p.descr END) AS first_descr
  FROM answers a LEFT JOIN pairs p ON p.k = a.k GROUP BY ALL
)"""


RESPONSES = _responses()

ORACLES: dict[str, str] = {}


def oracle(name: str, ctes: str, body: str) -> None:
    sql = textwrap.dedent(body).strip()
    ORACLES[name] = f"WITH {ctes.strip()}\n{sql}" if ctes else sql


# One row per rendered line: its type.
LINES = f"""{CONTRACTS}, {FIRST_ITEMS},
typed AS (
  SELECT file, contract, '1301' AS t FROM contracts
  UNION ALL SELECT file, contract, '1301' FROM contracts WHERE k % 50 = 0
  UNION ALL SELECT file, contract, '1302' FROM contracts
  UNION ALL SELECT file, contract, '1302' FROM contracts WHERE k % 19 = 0
  UNION ALL SELECT file, contract, '1303' FROM contracts JOIN lineitem ON l_orderkey = k
  UNION ALL SELECT file, contract, '1305' FROM contracts JOIN first_items ON l_orderkey = k
  UNION ALL SELECT file, contract, '1305' FROM contracts JOIN first_items ON l_orderkey = k
            WHERE k % 6 = 0
  UNION ALL SELECT file, contract, '1309' FROM contracts
  UNION ALL SELECT file, contract, '1309' FROM contracts WHERE k % 7 <> 0 AND k % 27 = 0
  UNION ALL SELECT file, contract, '1309' FROM contracts WHERE k % 3 = 0
  UNION ALL SELECT file, contract, '1315' FROM contracts
  UNION ALL SELECT file, contract, '1315' FROM contracts
),
frame AS (
  SELECT file, t FROM (SELECT DISTINCT file FROM contracts), (VALUES ('100'), ('120')) v(t)
),
odd AS (
  SELECT file, k, place + 90 AS line_no, 'XX9junk' || k::VARCHAR AS value FROM contracts
  WHERE twin = 0 AND k % 97 = 0
  UNION ALL SELECT file, k, place + 91, '   ' FROM contracts WHERE twin = 0 AND k % 89 = 0
)"""

oracle("render_fixed_width", LINES, """
    SELECT t AS record_type, count(*) AS n, 336 AS min_width, 336 AS max_width,
           min('P' || t || contract[1:11]) AS first_start, max('P' || t || contract[1:11]) AS last_start
    FROM typed GROUP BY t""")
oracle("detect_record_type", LINES, """
    SELECT file, t AS record_type, count(*) AS n FROM (
      SELECT file, t FROM typed UNION ALL SELECT file, t FROM frame
      UNION ALL SELECT file, NULL FROM odd
      UNION ALL SELECT file, NULL FROM (SELECT DISTINCT file FROM contracts), (VALUES (1), (2)))
    GROUP BY ALL""")
DESCRIPTIONS = """(VALUES ('100', 'File Header'), ('120', 'Firm Header'), ('1301', 'Contract Header'),
      ('1302', 'Contract Values'), ('1303', 'Fund Detail'), ('1305', 'Agent Information'),
      ('1309', 'Party Information'), ('1315', 'Service Features')) d(t, record_desc)"""
oracle("record_type_counts", LINES, f"""
    SELECT file, t AS record_type, record_desc, count(*) AS n FROM (
      SELECT file, t FROM typed UNION ALL SELECT file, t FROM frame) JOIN {DESCRIPTIONS} USING (t)
    GROUP BY ALL""")
oracle("parse_records", CONTRACTS, """
    SELECT file, place + 10 AS line_no, contract, 'Contract Values' AS record_desc,
           amount_1_text AS amount_1, qualifier AS qualifier_1,
           (k % 1000)::VARCHAR || '.50' AS amount_2, '' AS amount_3, 29 AS n_fields
    FROM contracts
    UNION ALL
    SELECT file, place + 11, contract, 'Contract Values', '', '', '',
           (k % 500)::VARCHAR || '.25', 29 FROM contracts WHERE k % 19 = 0""")
oracle("parse_rejects", LINES, """
    SELECT file, line_no, 'XX9ju' AS head,
           'Line ' || line_no::VARCHAR || ': unrecognised record type (first 5 chars: ''XX9ju'')' AS error
    FROM odd WHERE value LIKE 'XX%'""")
oracle("layout_widths", LINES, """
    SELECT t AS record_type, count(*) AS n,
      CASE t WHEN '1305' THEN 405 WHEN '1309' THEN 413 ELSE 300 END AS longest,
      (CASE t WHEN '1305' THEN 405 WHEN '1309' THEN 413 ELSE 300 END)::BIGINT AS width,
      (CASE t WHEN '100' THEN 11 WHEN '120' THEN 10 WHEN '1301' THEN 24 WHEN '1302' THEN 29
              WHEN '1303' THEN 19 WHEN '1305' THEN 19 WHEN '1309' THEN 26 ELSE 31 END)::BIGINT AS fields,
      (CASE t WHEN '100' THEN 8 WHEN '120' THEN 7 WHEN '1301' THEN 18 WHEN '1302' THEN 17
              WHEN '1303' THEN 14 WHEN '1305' THEN 14 WHEN '1309' THEN 21 ELSE 24 END)::BIGINT AS data_fields
    FROM (SELECT file, t FROM typed UNION ALL SELECT file, t FROM frame) GROUP BY t""")
oracle("occurrence_number", f"{CONTRACTS}, {ITEMS}", """
    SELECT file, contract, line_no, 'F' || lpad(l_partkey::VARCHAR, 8, '0') AS fund,
      row_number() OVER (PARTITION BY contract ORDER BY line_no, l_partkey,
        lpad(l_extendedprice::DECIMAL(18,2)::VARCHAR, 0, ' '))::INT AS occ
    FROM items""")
oracle("max_occurrences", LINES, """
    SELECT t AS record_type, max(n) AS max_occ FROM (
      SELECT contract, t, count(*) AS n FROM typed GROUP BY ALL) GROUP BY t""")
oracle("last_record_wins", FACTS, """
    SELECT file, contract, '1301' AS record_type,
           place + CASE WHEN k % 50 = 0 THEN 2 ELSE 1 END AS line_no, account, state FROM facts""")

# Fund values by occurrence; equal line numbers are ordered by the text of the line.
NUMBERED = f"""{FACTS}, {ITEMS},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY contract ORDER BY line_no,
           rpad(l_extendedprice::DECIMAL(18,2)::VARCHAR, 16, ' '),
           rpad(l_quantity::DECIMAL(18,2)::VARCHAR, 18, ' ')) AS occ
  FROM items
),
funds AS (
  SELECT contract,
    max(CASE WHEN occ = 1 THEN l_extendedprice::DECIMAL(18,2)::VARCHAR END) AS v1,
    max(CASE WHEN occ = 2 THEN l_extendedprice::DECIMAL(18,2)::VARCHAR END) AS v2,
    max(CASE WHEN occ = 3 THEN l_extendedprice::DECIMAL(18,2)::VARCHAR END) AS v3
  FROM numbered GROUP BY contract
)"""
oracle("flatten_long", LINES, """
    SELECT file, t AS record_type, occ, count(*) AS n FROM (
      SELECT file, t, row_number() OVER (PARTITION BY file, contract, t) AS occ FROM typed) GROUP BY ALL""")
# A third of the value lines without a contract, and the most that a contract still has.
STRAYS = f"""{CONTRACTS}, {ITEMS},
widest AS (
  SELECT coalesce(max(n), 1) AS most FROM (
    SELECT count(*) AS n FROM items WHERE line_no % 3 <> 0 GROUP BY file, contract)
),
strays AS (SELECT file, count(*) AS n FROM items WHERE line_no % 3 = 0 GROUP BY file)"""
oracle("unplaced", STRAYS, """
    SELECT file, '__NO_CONTRACT__' AS contract, '1303' AS record_type, n - most AS n,
      most + 1 AS first_occ, n AS last_occ
    FROM strays, widest WHERE n > most""")
oracle("reconcile_stray_report", STRAYS, """
    SELECT true AS valid, 0 AS mismatch_count, sum(greatest(n - most, 0))::BIGINT AS unplaced_records
    FROM strays, widest""")
oracle("flatten_contracts", NUMBERED, """
    SELECT file, place + 1 AS first_line, contract AS "Contract_Number",
      cusip AS "c1301_CUSIP_Number", account AS "c1301_Distributors_Account_ID",
      amount_1_text AS "c1302_Contract_Value_Amount_1_1",
      qualifier AS "c1302_Contract_Value_Qualifier_1_1",
      CASE WHEN k % 19 = 0 THEN (k % 500)::VARCHAR || '.25' ELSE '' END
        AS "c1302_Contract_Value_Amount_3_2",
      coalesce(v1, '') AS "c1303_Fund_Value_1", coalesce(v2, '') AS "c1303_Fund_Value_2",
      coalesce(v3, '') AS "c1303_Fund_Value_3", agent_last_name AS "c1305_Agent_Last_Name_1"
    FROM facts LEFT JOIN funds USING (contract)""")
oracle("flatten_all_columns", f"{FACTS}, {ITEMS}, {LINES.split(FIRST_ITEMS + ',')[1]}", """
    , cells AS (
      SELECT contract FROM contracts WHERE false
    ),
    parts AS (
      -- contract number
      SELECT count(*) AS n, sum(length(contract)) AS ch FROM contracts
      -- 1301: security, status, account, product, state
      UNION ALL SELECT 5 * count(*), sum(9 + 2 + length(account) + 3 + 2) FROM facts
      -- 1302: two pairs, and the third pair of a second record
      UNION ALL SELECT 4 * count(*), sum(length(amount_1_text) + 2 + length((k % 1000)::VARCHAR) + 3 + 3)
        FROM contracts
      UNION ALL SELECT 2 * count(*), sum(length((k % 500)::VARCHAR) + 3 + 2) FROM contracts WHERE k % 19 = 0
      -- 1303: fund, value, units
      UNION ALL SELECT 3 * count(*), sum(9 + length(l_extendedprice::DECIMAL(18,2)::VARCHAR)
        + length(l_quantity::DECIMAL(18,2)::VARCHAR)) FROM items
      -- 1305: composite name and last name
      UNION ALL SELECT 2 * count(*), sum(61 + length(agent_last_name)) FROM facts WHERE s IS NOT NULL
      UNION ALL SELECT 2 * count(*), sum(38 + 8) FROM facts WHERE s IS NOT NULL AND k % 6 = 0
      -- 1309: role and id, composite name
      UNION ALL SELECT count(*), sum(2 + length(owner_id)) FROM facts
      UNION ALL SELECT count(*), sum(CASE WHEN k % 9 = 0 THEN 5 + length(c::VARCHAR) ELSE 61 END)
        FROM facts WHERE k % 7 <> 0
      UNION ALL SELECT 2 * count(*), sum(2 + length(owner_id) + 61) FROM facts WHERE k % 7 <> 0 AND k % 27 = 0
      UNION ALL SELECT 2 * count(*), sum(2 + length(ann_id) + 40) FROM facts WHERE k % 3 = 0
      -- 1315: program, code, value
      UNION ALL SELECT 3 * count(*), sum(1 + 3 + CASE WHEN k % 11 = 0 OR k % 12 <= 1 THEN 6 ELSE 4 END)
        FROM contracts
    ),
    most AS (
      SELECT t, max(n) AS m FROM (SELECT contract, t, count(*) AS n FROM typed GROUP BY ALL) GROUP BY t
    )
    SELECT (SELECT count(*) FROM contracts) AS contracts,
      (SELECT 1 + sum(CASE t WHEN '1301' THEN 18 WHEN '1302' THEN 17 * m WHEN '1303' THEN 14 * m
                      WHEN '1305' THEN 14 * m WHEN '1309' THEN 21 * m ELSE 24 * m END)
       FROM most)::INT AS columns,
      sum(n)::BIGINT AS filled, sum(ch)::BIGINT AS characters
    FROM parts""")
ORACLES["flatten_all_columns"] = ORACLES["flatten_all_columns"].replace(
    ")\n, cells AS (\n  SELECT contract FROM contracts WHERE false\n),\nparts", "),\nparts")
oracle("union_files", FACTS, """
    SELECT file, contract AS "Contract_Number", cusip, amount_1_text AS amount, '' AS agent FROM facts
    UNION ALL SELECT file, contract, cusip, '', agent_last_name FROM facts""")

MISMATCHES = f"""{CONTRACTS},
wrong AS (
  SELECT file, contract AS contract_number, '1301' AS record_type,
         'Distributors_Account_ID' AS field_name, 'A' || c::VARCHAR AS expected,
         'B' || c::VARCHAR AS actual, NULL::VARCHAR AS occurrence, place + 1 AS line_no
  FROM contracts WHERE k % 50 = 0
  UNION ALL
  SELECT file, contract, '1301', 'Contract_State', lpad((c % 50)::VARCHAR, 2, '0'),
         lpad(((c + 1) % 50)::VARCHAR, 2, '0'), NULL, place + 1 FROM contracts WHERE k % 50 = 0
)"""
oracle("reconcile_mismatches", MISMATCHES, "SELECT * FROM wrong")
oracle("top_mismatches", MISMATCHES,
       "SELECT * EXCLUDE (occurrence) FROM wrong ORDER BY file, line_no, record_type, field_name LIMIT 50")
oracle("reconcile_report", LINES, """
    SELECT count(*) = 0 AS valid, (SELECT count(*) FROM contracts) AS expected_contracts,
      (SELECT count(*) FROM contracts) AS actual_contracts,
      (SELECT sum(CASE t WHEN '1301' THEN 18 WHEN '1302' THEN 17 WHEN '1303' THEN 14
                  WHEN '1305' THEN 14 WHEN '1309' THEN 21 ELSE 24 END) FROM typed)::BIGINT
        AS total_fields_checked,
      2 * count(*) AS mismatch_count, 0::BIGINT AS missing_record_type_count,
      0::BIGINT AS error_count, '' AS errors
    FROM contracts WHERE k % 50 = 0""")

CHECKED = """(SELECT sum(CASE t WHEN '1301' THEN 18 WHEN '1302' THEN 17 WHEN '1303' THEN 14
                  WHEN '1305' THEN 14 WHEN '1309' THEN 21 ELSE 24 END) FROM typed WHERE contract NOT LIKE '%77')::BIGINT"""
# Contracts that end with 77 have no row; the role of the first party and the value of the first feature are never empty.
oracle("reconcile_bad_header", LINES, f"""
    SELECT false AS valid, count(*) AS expected_contracts,
      count(*) FILTER (WHERE NOT gone) AS actual_contracts, {CHECKED} AS total_fields_checked,
      (sum(CASE WHEN gone THEN 0 ELSE 2 + CASE WHEN k % 50 = 0 THEN 2 ELSE 0 END
        + CASE WHEN contract LIKE '%5' THEN 1 + CASE WHEN k % 50 = 0 THEN 1 ELSE 0 END ELSE 0 END END))::BIGINT AS mismatch_count,
      (count(*) FILTER (WHERE NOT gone)
        + (SELECT count(*) FROM (SELECT DISTINCT contract, t FROM typed WHERE contract LIKE '%77')))::BIGINT AS missing_record_type_count,
      0::BIGINT AS unplaced_records,
      (2 + CASE WHEN count(*) FILTER (WHERE gone) > 0 THEN 1 ELSE 0 END + count(*) FILTER (WHERE gone))::BIGINT AS error_count,
      concat_ws('; ',
        CASE WHEN count(*) FILTER (WHERE gone) > 0 THEN 'Contract count mismatch: expected ' || count(*)::VARCHAR || ', got '
          || (count(*) FILTER (WHERE NOT gone))::VARCHAR END,
        'Missing CSV columns: [''1309_Party_Last_Name_1'', ''1315_Service_Feature_Value_1'']',
        'Extra CSV columns: [''Extra_Column'']') AS errors
    FROM (SELECT *, contract LIKE '%77' AS gone FROM contracts)""")
oracle("reconcile_missing", LINES, """
    SELECT file, contract, 'all' AS record_type FROM contracts WHERE contract LIKE '%77'
    UNION ALL SELECT DISTINCT file, contract, t FROM typed WHERE contract LIKE '%77' OR t = '1315'""")

oracle("strip_suffix", "", """
    SELECT o_orderkey, 'P' || o_orderkey::VARCHAR ||
      CASE o_orderkey % 6 WHEN 4 THEN 'MV' WHEN 5 THEN 'AB' ELSE '' END AS base FROM orders""")
oracle("extract_producer", "", """
    SELECT o_orderkey, regexp_extract('924 N' || o_orderkey::VARCHAR || '  N' ||
      (o_orderkey * 7)::VARCHAR || ' N55555', 'N([0-9]{5,10})', 1) AS producer FROM orders""")
oracle("split_name", "", """
    SELECT c_custkey, c_name AS last, c_mktsegment AS first,
           CASE WHEN c_custkey % 2 = 0 THEN 'MID' ELSE '' END AS middle FROM customer""")
oracle("last4", "", "SELECT c_custkey, right(c_custkey::VARCHAR, 4) AS last4 FROM customer")
oracle("filename_date", "", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 OR o_orderdate < TIMESTAMP '2000-01-01' THEN ''
      ELSE strftime(o_orderdate, '%Y%m%d') END AS file_date FROM orders""")
oracle("two_decimals", "", """
    SELECT printf('%.2f', l_extendedprice * 0.1::DOUBLE) AS tenth, count(*) AS n
    FROM lineitem GROUP BY 1""")
oracle("parse_errors", RESPONSES, """
    SELECT policy AS "Policy_Number", codes AS error_codes, n_errors::INT AS n_errors,
           first_descr AS first_description FROM coded""")

oracle("contra_lookup", DEDUP, "SELECT file, base, contra FROM dedup")
oracle("qualifier_amount", FACTS, """
    SELECT file, contract, ra_amount AS amount, 'RA' AS code FROM facts WHERE ra_amount IS NOT NULL
    UNION ALL SELECT file, contract, sc_amount, 'SC' FROM facts WHERE sc_amount IS NOT NULL
    UNION ALL SELECT file, contract, tw_amount, 'TW' FROM facts WHERE tw_amount IS NOT NULL""")
oracle("total_value", FACTS, "SELECT file, contract, total_value FROM facts")
oracle("active_rider", FACTS, "SELECT file, contract FROM facts WHERE rider")
oracle("party_by_role", FACTS, """
    SELECT file, contract, owner_last AS last, owner_first AS first, owner_middle AS middle,
           owner_id AS id, 'owner' AS kind FROM facts WHERE k % 7 <> 0
    UNION ALL
    SELECT file, contract, 'ANN' || c::VARCHAR, 'ROBIN', '', ann_id, 'annuitant'
    FROM facts WHERE k % 3 = 0""")
oracle("party_id_fallback", FACTS,
       "SELECT file, contract, owner_id AS id FROM facts WHERE owner_id <> ''")
oracle("dedup_contracts", DEDUP,
       "SELECT file, contract, place + 1 AS first_line, agent_last_name, contra FROM dedup")
oracle("resolve_column", DEDUP, """
    SELECT f.file, f.contract, f.cusip, f.account, f.state, f.agent_last_name, d.contra,
           f.ra_amount, f.sc_amount, f.tw_amount, f.total_value, f.rider, f.owner_last,
           f.owner_id AS owner_fallback_id
    FROM facts f JOIN dedup d ON d.base = f.base""")
oracle("filter_distributor", DEDUP,
       "SELECT file, contract, contra FROM dedup WHERE contra = '0015'")
oracle("filter_active", CLASSIFIED, "SELECT file, contract, status FROM active")
oracle("excluded_by_status", DEDUP, """
    SELECT status, count(*) AS n FROM dedup WHERE status NOT IN ('VA', 'AA') GROUP BY status""")
oracle("classify_withdrawal", CLASSIFIED, """
    SELECT file, contract, withdrawal_type, base_amount, value_type, withdrawal_value
    FROM classified""")
oracle("split_percent_amount", "", """
    SELECT CASE WHEN substring(md5(o_orderkey::VARCHAR), 1, 1) < '8' THEN 'Percent' ELSE 'Amount'
      END AS value_type, count(*) AS n FROM orders GROUP BY 1""")
oracle("withdrawal_distribution", CLASSIFIED, """
    SELECT withdrawal_type, count(*) AS n, count(*) FILTER (value_type = 'Percent') AS percent_n,
           count(*) FILTER (value_type = 'Amount') AS amount_n
    FROM classified GROUP BY withdrawal_type""")

oracle("request_rows", REQUESTS, """
    SELECT file, "PolNumber", "CusipNum", "DistributorClientAcctNum", guid AS "TransRefGUID",
      '2026-03-31' AS "TransExeDate", '12:00:00+00:00' AS "TransExeTime",
      agent_first AS "Party_Agent_FirstName", agent_last AS "Party_Agent_LastName",
      producer AS "Party_Agent_NIPRNumber", owner_first AS "Party_PrimaryOwner_FirstName",
      owner_last AS "Party_PrimaryOwner_LastName", own_ssn AS "Party_PrimaryOwner_IDPart",
      CASE WHEN owner_id = '' THEN '' ELSE 'SSN' END AS "Party_PrimaryOwner_PartialIDType_text",
      ann_first AS "Party_PrimaryAnnuitant_FirstName", ann_last AS "Party_PrimaryAnnuitant_LastName",
      ann_ssn AS "Party_PrimaryAnnuitant_IDPart",
      CASE WHEN ann_ssn = '' THEN '' ELSE '1' END AS "Party_PrimaryAnnuitant_PartialIDType_tc",
      '8' AS "Relation_Owner_RoleCode_tc", '4500' AS "Party_Carrier_CarrierCode",
      '2000.00' AS "ModalAmt"
    FROM requests""")
oracle("sync_arrangement", REQUESTS, """
    SELECT "PolNumber", withdrawal_value AS "ModalAmt", sub_tc AS "ArrSubType_tc",
           sub_text AS "ArrSubType_text", value_type AS "Withdrawal_Value_Type" FROM requests""")
oracle("arrangement_summary", REQUESTS, """
    SELECT withdrawal_type AS "Withdrawal_Type", value_type AS "Withdrawal_Value_Type",
      count(*) AS n, min(sub_tc) AS "ArrSubType_tc", min(sub_text) AS "ArrSubType_text",
      string_agg(withdrawal_value, ', ' ORDER BY file, place) FILTER (rn <= 3) AS sample_amounts
    FROM (SELECT *, row_number() OVER (PARTITION BY withdrawal_type, value_type
                                       ORDER BY file, place) AS rn FROM requests)
    GROUP BY 1, 2""")
VALIDATION = """withdrawal_type AS "Withdrawal_Type", value_type AS "Withdrawal_Value_Type",
      withdrawal_value AS "Withdrawal_Value", "PolNumber", "CusipNum", producer AS "NIPRNumber",
      agent_first AS "AgtFirstName", agent_last AS "AgtLastName", '' AS "AgtSSN",
      owner_first AS "OwnFirstName", owner_last AS "OwnLastName", own_ssn AS "OwnSSN",
      ann_ssn AS "AnnSSN", guid AS "Rguid", 'Default' AS "Federal_TaxWithholdingType",
      'Default' AS "State_TaxWithholdingType", state AS "State\""""
oracle("validation_table", REQUESTS,
       f"SELECT file, place + 1 AS first_line, {VALIDATION} FROM requests")
oracle("enrich_failures", AUDITED, """
    SELECT file, "PolNumber", reasons AS "Failure_Reasons", codes AS "Predicted_Error_Codes",
           CASE WHEN codes = '' THEN 'PASS' ELSE codes END AS "Result" FROM audited""")
oracle("failure_breakdown", AUDITED, """
    SELECT kind, item, count(*) AS n FROM (
      SELECT 'reason' AS kind, unnest(string_split(reasons, '; ')) AS item FROM audited WHERE codes <> ''
      UNION ALL SELECT 'code', unnest(string_split(codes, '; ')) FROM audited WHERE codes <> '')
    GROUP BY ALL""")
oracle("pass_fail_summary", AUDITED, """
    SELECT count(*) AS total, count(*) FILTER (codes = '') AS passed,
      count(*) FILTER (codes <> '') AS failed, count(*) FILTER (reasons LIKE '%;%') AS several_reasons
    FROM audited""")
oracle("sample_failures", AUDITED, """
    SELECT file, "PolNumber", reasons AS "Failure_Reasons" FROM audited WHERE codes <> ''
    ORDER BY file, place LIMIT 10""")
COVERED = {
    "Withdrawal_Type": "withdrawal_type", "Withdrawal_Value_Type": "value_type",
    "Withdrawal_Value": "withdrawal_value", "PolNumber": '"PolNumber"', "CusipNum": "cusip",
    "NIPRNumber": "producer", "AgtFirstName": "agent_first", "AgtLastName": "agent_last",
    "AgtSSN": "''", "OwnFirstName": "owner_first", "OwnLastName": "owner_last",
    "OwnSSN": "own_ssn", "AnnSSN": "ann_ssn", "Rguid": "guid",
    "Federal_TaxWithholdingType": "'Default'", "State_TaxWithholdingType": "'Default'",
    "State": "state", "Failure_Reasons": "reasons", "Predicted_Error_Codes": "codes",
    "Result": "'PASS'",
}
oracle("column_coverage", AUDITED, " UNION ALL ".join(
    f"SELECT '{n}' AS column_name, count(*) FILTER ({v} <> '') AS filled, count(*) AS total FROM audited"
    for n, v in COVERED.items()))
oracle("blanket_warnings", AUDITED,
       "SELECT 'AgtSSN' AS column_name, count(*) AS total FROM audited HAVING count(*) > 0")
oracle("field_preview", NUMBERED, """
    , first AS (SELECT * FROM facts ORDER BY file, place LIMIT 1),
    seconds AS (SELECT * FROM facts WHERE s IS NOT NULL AND k % 6 = 0 ORDER BY file, place LIMIT 1),
    firsts AS (SELECT * FROM facts WHERE s IS NOT NULL ORDER BY file, place LIMIT 1),
    parties AS (
      SELECT file, place, contract, 30 AS pos,
        CASE WHEN k % 7 = 0 THEN 'HA' WHEN k % 9 = 0 THEN 'HC' ELSE 'OK' END || owner_id AS v FROM facts
      UNION ALL SELECT file, place, contract, 31, 'OK' || owner_id FROM facts
        WHERE k % 7 <> 0 AND k % 27 = 0
      UNION ALL SELECT file, place, contract, 35, CASE WHEN k % 6 = 0 THEN 'G2' ELSE 'G5' END || ann_id
        FROM facts WHERE k % 3 = 0
    ),
    listed AS (
      SELECT '1309_Party_Last_Name_' ||
          row_number() OVER (PARTITION BY contract ORDER BY pos)::VARCHAR AS name,
        v, file || lpad(place::VARCHAR, 20, '0') AS o FROM parties
      UNION ALL SELECT '1303_CUSIP_Fund_ID_Sub_Fund_ID_' || occ::VARCHAR,
        'F' || lpad(l_partkey::VARCHAR, 8, '0'), file || lpad(place::VARCHAR, 20, '0') FROM numbered
    )
    SELECT 'Contract_Number' AS column_name, contract AS sample FROM first
    UNION ALL SELECT '1301_CUSIP_Number', cusip FROM first
    UNION ALL SELECT '1301_Contract_Status', status FROM first
    UNION ALL SELECT '1301_Distributors_Account_ID', account FROM first
    UNION ALL SELECT '1301_Product_Type_Code', 'ANN' FROM first
    UNION ALL SELECT '1301_Contract_State', state FROM first
    UNION ALL SELECT '1305_Agent_Last_Name_1', agent_last_name FROM firsts
    UNION ALL SELECT '1305_Agent_Last_Name_2', 'N9999999' FROM seconds
    UNION ALL SELECT name, arg_min(v, o) FROM listed GROUP BY name""")
ORACLES["field_preview"] = ORACLES["field_preview"].replace(")\n, first", "),\nfirst")
oracle("dictionary_views", REQUESTS, """
    , empty_cells AS (
      SELECT 'party_agent' AS g, sum((agent_first = '')::INT + (agent_last = '')::INT
        + (producer = '')::INT + 3) AS n FROM requests
      UNION ALL SELECT 'party_owner', sum((owner_first = '')::INT + (owner_last = '')::INT
        + (own_ssn = '')::INT + 2 * (owner_id = '')::INT) FROM requests
      UNION ALL SELECT 'party_annuitant', sum((ann_first = '')::INT + (ann_last = '')::INT
        + 3 * (ann_ssn = '')::INT) FROM requests
      UNION ALL SELECT 'metadata', count(*) FROM requests
    )
    SELECT v.g AS field_group, v.f::BIGINT AS fields, v.r::BIGINT AS required_fields,
      (v.f * (SELECT count(*) FROM requests) - coalesce(e.n, 0))::BIGINT AS filled
    FROM (VALUES ('soap', 5, 5), ('txlife_request', 10, 10), ('holding', 4, 3), ('policy', 5, 4),
      ('arrangement', 9, 8), ('tax_fed', 6, 6), ('tax_state', 6, 6), ('olife_extension', 4, 0),
      ('party_agent', 9, 8), ('party_distributor', 5, 5), ('party_carrier', 6, 6),
      ('party_owner', 8, 8), ('party_annuitant', 8, 0), ('relation_agent', 9, 9),
      ('relation_distributor', 9, 9), ('relation_carrier', 9, 9), ('relation_owner', 9, 9),
      ('relation_annuitant', 9, 0), ('metadata', 2, 0)) v(g, f, r)
    LEFT JOIN empty_cells e ON e.g = v.g""")
ORACLES["dictionary_views"] = ORACLES["dictionary_views"].replace(")\n, empty_cells", "),\nempty_cells")
oracle("missing_provenance", AUDITED, """
    , source AS (
      SELECT base, bool_or(producer <> '') AS has_producer FROM facts GROUP BY base
    ),
    missing AS (
      SELECT 'Agent NPN/NIPR' AS missing_field, has_producer AS elsewhere
      FROM audited JOIN source USING (base) WHERE producer = ''
      UNION ALL SELECT 'Owner first name', false FROM audited WHERE owner_first = ''
      UNION ALL SELECT 'Owner last name', false FROM audited WHERE owner_last = ''
      UNION ALL SELECT 'Owner SSN (last 4)', k % 7 <> 0 AND owner_id <> '' FROM audited WHERE own_ssn = ''
      UNION ALL SELECT 'Annuitant SSN (last 4)', k % 3 = 0 AND ann_id <> '' FROM audited WHERE ann_ssn = ''
    )
    SELECT missing_field, count(*) AS total_missing, count(*) FILTER (NOT elsewhere) AS absent_at_source,
           count(*) FILTER (elsewhere) AS dedup_artifact FROM missing GROUP BY missing_field""")
ORACLES["missing_provenance"] = ORACLES["missing_provenance"].replace(")\n, source", "),\nsource")
oracle("filter_expected", BROKEN,
       "SELECT pol AS \"PolNumber\", '1' AS \"ExpectedToPass\" FROM broken WHERE k % 23 <> 0")

oracle("rule_required", BROKEN, """
    SELECT pol AS "PolNumber", concat_ws('; ', e_mode_tc,
      CASE WHEN k % 53 = 0 THEN 'Required field ''Party_Carrier_id'' is missing or empty' END) AS errors
    FROM documents_made WHERE k % 31 = 0 OR k % 53 = 0""")
oracle("rule_max_length", BROKEN,
       'SELECT pol AS "PolNumber", e_mode_text AS errors FROM documents_made WHERE k % 37 = 0')
oracle("rule_allowed_values", BROKEN, """
    SELECT pol AS "PolNumber", concat_ws('; ', e_type, CASE WHEN k % 47 = 0 THEN
      'Field ''TaxState_Place_tc'' has invalid value ''3''; allowed: [''2'']' END) AS errors
    FROM documents_made WHERE k % 41 = 0 OR k % 47 = 0""")
oracle("rule_pattern", BROKEN, """
    SELECT pol AS "PolNumber", concat_ws('; ', e_guid, e_pol) AS errors
    FROM documents_made WHERE k % 29 = 0 OR k % 23 = 0""")
oracle("rule_conditional", BROKEN,
       'SELECT pol AS "PolNumber", e_modal AS errors FROM documents_made WHERE e_modal IS NOT NULL')
oracle("rule_all_fields", BROKEN, """
    SELECT n_errors, count(*) AS n FROM (
      SELECT ((k % 29 = 0)::INT + (k % 41 = 0)::INT + (k % 23 = 0)::INT + (k % 31 = 0)::INT
        + (k % 37 = 0)::INT + (k % 47 = 0)::INT + (k % 53 = 0)::INT
        + (k % 43 = 0 AND sub_tc = '4')::INT
        + 3 -- the agent has no partial id
        + CASE WHEN agent_first = '' THEN 2 ELSE 0 END
        + (owner_first = '')::INT + (owner_last = '')::INT
        + CASE WHEN own_ssn = '' THEN 1 ELSE 0 END
        + CASE WHEN owner_id = '' THEN 2 ELSE 0 END)::INT AS n_errors
      FROM broken) GROUP BY n_errors""")

oracle("render_xml", REQUESTS, """
    SELECT "PolNumber" AS pol_number, 'WDQuote_' || "PolNumber" || '.xml' AS filename,
      "PolNumber" AS policy_element, withdrawal_value AS modal_element, account AS account_element,
      nullif(owner_last, '') AS owner_element,
      -- a full document, less the lines of what is missing
      (123 - (agent_first = '')::INT - (agent_last = '')::INT - 3 * (producer = '')::INT
       - (owner_first = '')::INT - (owner_last = '')::INT - 4 * (own_ssn = '')::INT
       - (ann_first = '')::INT - (ann_last = '')::INT - 4 * (ann_ssn = '')::INT)::INT AS lines
    FROM requests""")
oracle("document_table", FACTS, """
    SELECT 'WDQuote_' || base || '.xml' AS filename, base AS pol_number,
           max(place) + 1 AS first_line FROM facts GROUP BY base""")
oracle("validate_documents", BROKEN, """
    SELECT filename, pol AS policy_number, errors = '' AS valid, errors FROM documents_made""")
oracle("validate_damaged_documents", BROKEN, """
    SELECT filename, CASE WHEN k % 9 IN (0, 5, 6) OR k % 9 = 3 THEN 'UNKNOWN' ELSE pol END AS policy_number,
      k % 9 IN (0, 5, 6) AS malformed,
      CASE WHEN k % 9 IN (0, 1, 3, 5, 6) THEN false
           WHEN k % 9 = 7 THEN errors = '' AND sub_tc <> '4' ELSE errors = '' END AS valid,
      CASE WHEN k % 9 IN (0, 5, 6) THEN 'XML parse error: document is not well-formed'
           WHEN k % 9 = 1 THEN 'SOAP Envelope element not found'
           WHEN k % 9 = 3 THEN 'Required field ''MessageType'' is missing or empty'
           WHEN k % 9 = 7 AND sub_tc = '4' THEN coalesce(e_guid, e_type, e_pol, e_mode_tc, e_mode_text, string_split(e_state, '; ')[1],
             'Conditional field ''ModalAmt'' required when ArrSubType tc=4 (Specified Amount)')
           ELSE coalesce(e_guid, e_type, e_pol, e_mode_tc, e_mode_text, string_split(e_state, '; ')[1], e_modal, e_party, e_relation) END AS first_error
    FROM documents_made""")
oracle("rule_presence", BROKEN, """
    SELECT filename, concat_ws('; ', e_party, e_relation) AS errors FROM documents_made
    WHERE e_party IS NOT NULL OR e_relation IS NOT NULL""")
oracle("rule_tax_lookup", BROKEN, """
    SELECT filename, 'ID_1' AS federal_id, CASE WHEN k % 47 <> 0 THEN 'ID_2' END AS state_id
    FROM documents_made""")
oracle("scorecard", BROKEN, f"""
    SELECT pol AS "PolNumber", filename AS "FileName",
      CASE WHEN errors = '' THEN 'PASS' ELSE 'FAIL' END AS "Status", nullif(errors, '') AS "ErrorDetails",
      CASE WHEN k % 23 = 0 THEN 'ExpectedToPass=0; Reason=bad number' ELSE 'ExpectedToPass=1' END
        AS "ExpectedResult", '{RUN_TS}' AS "Timestamp"
    FROM documents_made""")

# Tags that a document lacks: three are never elements, the others follow from missing values.
TAGGED = f"""{BROKEN},
tagged AS (
  SELECT *,
    list_sort([x FOR x IN [
      'OriginatingObjectID', 'RelatedObjectID', 'operationNs',
      CASE WHEN modal = '' THEN 'ModalAmt' END,
      CASE WHEN agent_first = '' AND owner_first = '' AND ann_first = '' THEN 'FirstName' END,
      CASE WHEN agent_last = '' AND owner_last = '' AND ann_last = '' THEN 'LastName' END,
      CASE WHEN producer = '' THEN 'NIPRNumber' END,
      CASE WHEN own_ssn = '' AND ann_ssn = '' THEN 'IdentificationPart' END,
      CASE WHEN own_ssn = '' AND ann_ssn = '' THEN 'PartialIDType' END
    ] IF x IS NOT NULL]) AS missing
  FROM documents_made
)"""
oracle("analyze_documents", TAGGED, """
    SELECT CASE WHEN errors = '' THEN 'PASS' ELSE 'FAIL' END AS status,
      array_to_string(missing, ',') AS missing, '' AS custom,
      round_even((45 - len(missing)) * 100.0::DOUBLE / 45, 1) AS conformance_pct,
      (45 - len(missing))::INT AS matched, count(*) AS n
    FROM tagged GROUP BY ALL""")
oracle("enhanced_scorecard", TAGGED, f"""
    SELECT pol AS "PolNumber", filename AS "FileName",
      CASE WHEN errors = '' THEN 'PASS' ELSE 'FAIL' END AS "Status", nullif(errors, '') AS "ErrorDetails",
      array_to_string([x FOR x IN {sorted(field_tags())} IF NOT list_contains(missing, x)], '; ') AS "MatchedFields",
      (45 - len(missing))::VARCHAR AS "MatchedCount",
      array_to_string(missing, '; ') AS "MissingFields", len(missing)::VARCHAR AS "MissingCount",
      NULL::VARCHAR AS "CustomFields", '0' AS "CustomCount",
      round_even((45 - len(missing)) * 100.0::DOUBLE / 45, 1)::FLOAT::DOUBLE AS "ConformancePct", '{RUN_TS}' AS "Timestamp"
    FROM tagged""")
_KNOWN = "['a', 'article', 'body', 'head', 'html', 'main', 'nav', 'p', 'table', 'title', 'video']"
oracle("document_tags", f"""
tagged AS (
  SELECT page_id, list_distinct(regexp_extract_all(
    regexp_replace(html, '(?s)<!--.*?-->|<!\\[CDATA\\[.*?\\]\\]>|<\\?.*?\\?>', '', 'g'),
    '<(?:[A-Za-z_][\\w.\\-]*:)?([A-Za-z_][\\w.\\-]*)', 1)) AS tags, {_KNOWN} AS known
  FROM pages
)""", """
    SELECT page_id, len(tags)::INT AS n_tags,
      array_to_string([x FOR x IN known IF list_contains(tags, x)], ',') AS matched,
      array_to_string([x FOR x IN known IF NOT list_contains(tags, x)], ',') AS missing,
      array_to_string(list_sort([x FOR x IN tags IF NOT list_contains(known, x)]), ',') AS custom,
      round_even(len([x FOR x IN known IF list_contains(tags, x)]) * 100.0::DOUBLE / 11, 1)
        AS conformance_pct
    FROM tagged""")

oracle("response_summary", RESPONSES, """
    SELECT count(*) AS total, count(*) FILTER (ok) AS success, count(*) FILTER (NOT ok) AS failure,
      round(count(*) FILTER (ok) / count(*) * 100, 1) AS success_pct,
      round(count(*) FILTER (NOT ok) / count(*) * 100, 1) AS failure_pct,
      count(*) FILTER (ok AND k % 6 = 0) AS warnings FROM answers""")
_TAG = """CASE WHEN code LIKE '%2109%' THEN '[DATA] POV contra-participant stale'
      WHEN code LIKE '%F058%' OR code LIKE '%A687%' THEN '[CARRIER] Surrender Free field validation'
      WHEN code LIKE '%X173%' THEN '[DATA] Carrier rider value = 0'
      WHEN code LIKE '%ET38%' THEN '[CODE] Owner party extraction gap'
      WHEN code LIKE '%1004903053%' THEN '[DATA] POV status lag'
      WHEN code LIKE '%300%' THEN '[TRANSIENT] System unavailable'
      WHEN code LIKE '%3013%' THEN '[TRANSIENT] Internal error'
      WHEN code LIKE '%2027%' THEN '[DATA] Contract restricted'
      WHEN code LIKE '%BA11%' THEN '[KNOWN] Agent SSN unavailable in POV'
      WHEN code LIKE '%WDS3%' THEN '[INFO] Disclosure warning'
      WHEN code LIKE '%A452%' THEN '[INVESTIGATE] Missing field A452'
      WHEN code LIKE '%E487%' THEN '[INVESTIGATE] Missing field E487' ELSE '' END"""
oracle("error_code_summary", f"""{RESPONSES},
failed AS (
  SELECT policy, wtype, pos, trim(code) AS code, left(descr, 80) AS descr FROM pairs WHERE NOT ok
  UNION ALL
  SELECT policy, wtype, 0, 'UNKNOWN', CASE WHEN shape = 'empty' THEN '[]' ELSE '' END
  FROM answers WHERE NOT ok AND shape IN ('none', 'empty')
),
kinds AS (
  SELECT code, wtype, row_number() OVER (PARTITION BY code ORDER BY count(*) DESC, wtype) AS rn
  FROM failed GROUP BY code, wtype
)""", f"""
    SELECT f.code AS error_code, count(DISTINCT policy) AS policies,
      arg_min(descr, policy || pos::VARCHAR) AS description, min(k.wtype) AS top_withdrawal_type,
      min({_TAG.replace("code LIKE", "f.code LIKE")}) AS tag
    FROM failed f JOIN kinds k ON k.code = f.code AND k.rn = 1 GROUP BY f.code""")
oracle("success_by_type", RESPONSES, """
    SELECT wtype AS "Withdrawal_Type", count(*) FILTER (ok) AS success, count(*) AS total,
      round(count(*) FILTER (ok) / count(*) * 100, 1) AS rate FROM answers GROUP BY wtype""")
oracle("failure_categories", RESPONSES, """
    SELECT count(*) FILTER (regexp_matches(codes, '2109|1004903053|2027|X173')) AS data_issues,
      count(*) FILTER (regexp_matches(codes, 'F058|A687|ET38|A452|E487|BA11')) AS carrier_validation,
      count(*) FILTER (regexp_matches(codes, '300-System|3013')) AS transient,
      count(*) FILTER (NOT regexp_matches(codes,
        '2109|1004903053|2027|X173|F058|A687|ET38|A452|E487|BA11|300-System|3013')) AS other
    FROM coded WHERE NOT ok""")
oracle("crossref_responses", f"{AUDITED}, {RESPONSES}", """
    SELECT a.policy AS "Policy_Number", CASE WHEN a.ok THEN 'Success' ELSE 'Failure' END AS "Status",
      substring(q."PolNumber", 2, 10) AS "PolNumber", q.withdrawal_type AS "Withdrawal_Type_val",
      CASE WHEN q.codes = '' THEN 'PASS' ELSE q.codes END AS "Result"
    FROM answers a LEFT JOIN audited q ON q.k = a.k""")

oracle("scan_fixed_width", LINES, """
    SELECT file[5:5] AS bucket, sum(n)::BIGINT AS lines, sum(ch)::BIGINT AS characters, true AS gapless
    FROM (SELECT file, count(*) AS n, count(*) * 336 AS ch FROM typed GROUP BY file
          UNION ALL SELECT file, count(*), sum(length(value)) FROM odd GROUP BY file)
    GROUP BY 1""")
oracle("detect_format", CONTRACTS, """
    SELECT DISTINCT e.extended, file[5:5] AS bucket,
      CASE WHEN e.extended THEN 'extended' ELSE 'standard' END AS file_format
    FROM contracts, (VALUES (true), (false)) e(extended)""")
oracle("file_metadata", LINES, """
    SELECT file[5:5] AS bucket, 'POV' AS file_type, 'extended' AS file_format,
      sum(n)::BIGINT AS total_lines, sum(n * good)::BIGINT AS parsed_lines,
      sum(n * (1 - good))::BIGINT AS skipped_lines, sum(n * bad)::BIGINT AS error_count,
      sum(n * fund)::BIGINT AS fund_records
    FROM (SELECT file, count(*) AS n, 1 AS good, 0 AS bad, (t = '1303')::INT AS fund
          FROM typed GROUP BY file, t
          UNION ALL SELECT file, count(*), 0, (value LIKE 'XX%')::INT, 0 FROM odd GROUP BY ALL)
    GROUP BY 1""")
oracle("scan_request_csv", BROKEN, """
    SELECT pol AS "PolNumber", nullif(modal, '') AS "ModalAmt",
      CASE WHEN k % 31 <> 0 THEN '9' END AS "ArrMode_tc",
      CASE WHEN k % 23 = 0 THEN 'bad number' END AS "FailureReason" FROM broken""")
oracle("register_view", BROKEN, """
    SELECT CASE WHEN k % 23 = 0 THEN '0' ELSE '1' END AS "ExpectedToPass", count(*) AS n
    FROM broken GROUP BY 1""")
oracle("create_request_table", REQUESTS, """
    SELECT sub_tc AS "ArrSubType_tc", sub_text AS "ArrSubType_text", count(*) AS n
    FROM requests GROUP BY ALL""")
oracle("sink_csv", NUMBERED, """
    SELECT contract AS "Contract_Number", cusip, v1 AS fund_value
    FROM facts LEFT JOIN funds USING (contract)""")
oracle("route_outcome", BROKEN, """
    SELECT 'r1' AS run_id, CASE WHEN errors = '' THEN 'success' ELSE 'unsuccessful' END AS outcome,
      count(*) AS n FROM documents_made GROUP BY ALL""")
oracle("scan_xml_documents", "", """
    SELECT 'page' || page_id::VARCHAR || CASE WHEN page_id % 3 = 0 THEN '.XML' ELSE '.xml' END AS filename,
      length(html)::INT AS characters, md5(html) AS digest
    FROM pages WHERE page_id % 3 <> 2""")
_COLUMNS = ", ".join(
    f"({i}, '{f.name}', '{f.metadata['comment'].replace(chr(39), chr(39) * 2)}')" for i, f in enumerate(request_schema(), 1))
oracle("request_table_columns", REQUESTS, f"""
    SELECT position, column_name, 'string' AS data_type, comment, (SELECT count(*) FROM requests) AS n_rows
    FROM (VALUES {_COLUMNS}) v(position, column_name, comment)""")
_FIELDS = ", ".join(
    f"('{t}', '{f.name}', {i}, {f.width})" for t, layout in LAYOUTS.items() for i, f in enumerate(layout.fields) if f.is_data)
oracle("parse_all_layouts", f"""
fields AS (SELECT * FROM (VALUES {_FIELDS}) v(record_type, field, i, width)),
held AS (
  SELECT record_type, field, substring(repeat(md5(record_type || '|' || p_partkey::VARCHAR), 12), 1 + i % 16, width) AS value
  FROM fields, part
)""", """
    SELECT record_type, field, count(*) AS n, count(DISTINCT value) AS different, min(value) AS first_value, max(value) AS last_value
    FROM held GROUP BY ALL""")
_TYPES = ", ".join(f"({i}, '{t}')" for i, t in enumerate(LAYOUTS, 1) if len(t) == 4)
oracle("occurrence_numbers", f"""{CONTRACTS}, {FIRST_ITEMS}, {ITEMS.strip()}, placed AS (
  SELECT file, contract, '1301' AS t, place + 1 AS line_no FROM contracts
  UNION ALL SELECT file, contract, '1301', place + 2 FROM contracts WHERE k % 50 = 0
  UNION ALL SELECT file, contract, '1302', place + 10 FROM contracts
  UNION ALL SELECT file, contract, '1302', place + 11 FROM contracts WHERE k % 19 = 0
  UNION ALL SELECT file, contract, '1303', line_no FROM items
  UNION ALL SELECT file, contract, '1305', place + 20 FROM contracts JOIN first_items ON l_orderkey = k
  UNION ALL SELECT file, contract, '1305', place + 21 FROM contracts JOIN first_items ON l_orderkey = k WHERE k % 6 = 0
  UNION ALL SELECT file, contract, '1309', place + 30 FROM contracts
  UNION ALL SELECT file, contract, '1309', place + 31 FROM contracts WHERE k % 7 <> 0 AND k % 27 = 0
  UNION ALL SELECT file, contract, '1309', place + 35 FROM contracts WHERE k % 3 = 0
  UNION ALL SELECT file, contract, '1315', place + 50 FROM contracts
  UNION ALL SELECT file, contract, '1315', place + 51 FROM contracts
  UNION ALL SELECT 'ALL.txt', 'K' || p_partkey::VARCHAR, t, p_partkey * 100 + i FROM part, (VALUES {_TYPES}) v(i, t)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY file, contract, t ORDER BY line_no) AS occ FROM placed
)""", """
    SELECT t AS record_type, occ, count(*) AS n, count(DISTINCT file || contract) AS contracts,
      sum(line_no)::BIGINT AS places FROM numbered GROUP BY ALL""")
oracle("last_header_wins", LINES, """
    SELECT file, 'FAR' AS file_type, 'standard' AS file_format, '20260415' AS valuation_date, (count(*) + 4)::BIGINT AS parsed_lines
    FROM typed GROUP BY file""")
_CONSTANTS = ", ".join(f"('{c}', '{v}')" for c, v in PROTOCOL.items())
oracle("request_constants", REQUESTS, f"""
    SELECT column_name, value, (SELECT count(*) FROM requests) AS n FROM (VALUES {_CONSTANTS}) v(column_name, value)""")
oracle("escape_text", """
raw AS (
  SELECT c_custkey, ['&', '<a>', '"', chr(39), '/', chr(92), '&amp;', chr(9) || ' ' || chr(10), ']]>', ''][(c_custkey % 10 + 1)::INT] AS sign, c_name
  FROM customer
), named AS (SELECT c_custkey, c_name || sign || ' x' || c_custkey::VARCHAR || sign || '.' AS v FROM raw)""", """
    SELECT c_custkey, replace(replace(replace(v, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS element,
      replace(replace(replace(replace(v, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS attribute,
      replace(replace(replace(v, ' ', ''), chr(9), ''), chr(10), '') AS dense,
      'WDQuote_' || replace(replace(v, '/', '_'), chr(92), '_') || '.xml' AS filename
    FROM named""")
oracle("sink_csv_order", CONTRACTS, """
    SELECT count(*) AS rows, 0 AS late, 0 AS overlapping_files FROM contracts""")
ORACLES["sink_scorecard"] = ORACLES["scorecard"]
ORACLES["sink_runs"] = f"""WITH made AS ({ORACLES["scorecard"]}), pages AS (
  SELECT CASE WHEN "Status" = 'PASS' THEN 'success' ELSE 'unsuccessful' END AS outcome, "FileName" AS filename FROM made
)
SELECT run_id, outcome, count(*) AS n FROM pages, (VALUES ('2026-03-30'), ('2026-03-31')) r(run_id)
WHERE run_id = '2026-03-30' OR outcome = 'success' GROUP BY ALL"""
oracle("sink_packed_documents", "", """
    SELECT 'page' || page_id::VARCHAR AS filename, length(html)::INT AS characters, md5(html) AS digest
    FROM pages WHERE page_id % 2 = 0""")
_ERROR = """CASE shape WHEN 'none' THEN NULL WHEN 'empty' THEN '[]'
        WHEN 'text' THEN '300-System is not available at this time, please try again later'
        WHEN 'object' THEN '{"ResultInfoCode": "2027"}'
        ELSE '[{"ResultInfoCode": "' || code_1 || '", "ResultInfoDesc": "about ' || code_1 || ' in row ' || (k % 5)::VARCHAR || '"}'
          || CASE WHEN shape = 'two' THEN ', {"ResultInfoCode": "' || code_2 || '", "ResultInfoDesc": "about ' || code_2
               || ' in row ' || (k % 5)::VARCHAR || '"}' ELSE '' END || ']' END"""
_ANSWERED = f"""{RESPONSES}, told AS (
  SELECT *, CASE WHEN ok AND k % 6 = 0 THEN '2' WHEN ok THEN '1' ELSE '5' END AS result,
    CASE WHEN ok THEN 'Success' ELSE 'Failure' END AS status, {_ERROR} AS descr FROM answers
)"""
oracle("read_responses", _ANSWERED, """
    SELECT policy AS "Policy_Number", wtype AS "Withdrawal_Type", status AS "Status", result AS "Result_code",
      descr AS "Error_Descriptions" FROM told WHERE k % 101 <> 0 AND k % 103 <> 0""")
oracle("response_rejects", _ANSWERED, """
    SELECT CASE WHEN k % 101 = 0 THEN policy || ',' || status
      ELSE '"' || policy || '","' || wtype || '","' || status || '","' || result || '",'
        || coalesce('"' || replace(descr, '"', '""') || '"', '') || ',more' END AS line
    FROM told WHERE k % 101 = 0 OR k % 103 = 0""")
oracle("read_wide_tables", FACTS, """
    SELECT file, contract AS "Contract_Number", cusip, CASE WHEN k % 4 < 2 THEN amount_1_text ELSE '' END AS amount,
      CASE WHEN k % 4 < 2 THEN '' ELSE agent_last_name END AS agent FROM facts""")
oracle("run_totals", LINES, """
    SELECT (SELECT 2 * count(DISTINCT file) FROM contracts) AS files,
      (2 * t + 2 * o + 4 * f)::BIGINT AS total_lines, (2 * t + 2 * f)::BIGINT AS parsed_lines,
      (2 * o + 2 * f)::BIGINT AS skipped_lines, (2 * junk)::BIGINT AS error_count
    FROM (SELECT (SELECT count(*) FROM typed) AS t, (SELECT count(*) FROM odd) AS o,
      (SELECT count(*) FROM odd WHERE value LIKE 'XX%') AS junk, (SELECT count(DISTINCT file) FROM contracts) AS f)""")
oracle("store_records", LINES, """
    SELECT file[5:5] AS bucket, t AS record_type, (2 * count(*))::BIGINT AS n, count(DISTINCT contract) AS contracts,
      sum(336 + CASE t WHEN '1305' THEN 405 ELSE 300 END)::BIGINT AS characters
    FROM typed WHERE t IN ('1303', '1305') GROUP BY ALL""")
oracle("store_files", LINES, """
    SELECT file[5:5] AS bucket, 'POV' AS file_type, CASE WHEN x THEN 'extended' ELSE 'standard' END AS file_format,
      (n + o + CASE WHEN x THEN 0 ELSE 4 END)::BIGINT AS total_lines, (n + CASE WHEN x THEN 0 ELSE 2 END)::BIGINT AS parsed_lines,
      (o + CASE WHEN x THEN 0 ELSE 2 END)::BIGINT AS skipped_lines, junk::BIGINT AS error_count,
      CASE WHEN x THEN '' ELSE '20260331' END AS valuation_date
    FROM (SELECT file, count(*) AS n FROM typed GROUP BY file)
    JOIN (SELECT file, count(o.k) AS o, count(o.k) FILTER (o.value LIKE 'XX%') AS junk
          FROM (SELECT DISTINCT file FROM contracts) LEFT JOIN odd o USING (file) GROUP BY file) USING (file),
      (VALUES (true), (false)) v(x)""")
oracle("store_rejects", LINES, """
    SELECT file[5:5] AS bucket, value[1:5] AS head, (2 * count(*))::BIGINT AS n FROM odd WHERE value LIKE 'XX%' GROUP BY ALL""")
oracle("file_metadata_standard", LINES, """
    SELECT file, 'POV' AS file_type, 'standard' AS file_format, '20260331' AS valuation_date,
      (n + o + 4)::BIGINT AS total_lines, (n + 2)::BIGINT AS parsed_lines, (o + 2)::BIGINT AS skipped_lines,
      junk::BIGINT AS error_count, 8 AS types
    FROM (SELECT file, count(*) AS n FROM typed GROUP BY file)
    JOIN (SELECT file, count(o.k) AS o, count(o.k) FILTER (o.value LIKE 'XX%') AS junk
          FROM (SELECT DISTINCT file FROM contracts) LEFT JOIN odd o USING (file) GROUP BY file) USING (file)""")
oracle("entry", AUDITED, f"""
    SELECT file, {VALIDATION}, reasons AS "Failure_Reasons", codes AS "Predicted_Error_Codes",
           CASE WHEN codes = '' THEN 'PASS' ELSE codes END AS "Result"
    FROM audited WHERE contra = '0015'""")
