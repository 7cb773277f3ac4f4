"""Report inputs derived from the sample tables.

Each input is one projection of a sample table, or a short list of rate-card rows, in SQL
that Spark and DuckDB read alike. Codes, names and times are arithmetic on the keys, so
every rule arm, unmatched lookup and NULL occurs, and the work grows with the tables.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from parcelledger.sources.tables import Tables

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
_TOTAL = "CAST(o_totalprice AS DECIMAL(18,2))"


def _of(base: str, share: str) -> str:
    return f"CAST({base} * {share} AS DECIMAL(18,4))"


_PARCEL_FEE = f"CAST({_PRICE} * CAST(1 - l_discount AS DECIMAL(18,2)) AS DECIMAL(18,4))"
_PARCEL_SOURCE = """CASE l_partkey % 12 WHEN 0 THEN '104' WHEN 1 THEN '114' WHEN 2 THEN '101'
    WHEN 3 THEN '756' WHEN 4 THEN '756' WHEN 5 THEN '116' WHEN 6 THEN '803' WHEN 7 THEN '00'
    WHEN 8 THEN '813' WHEN 9 THEN '835' WHEN 10 THEN '01' ELSE '829' END"""
_EXPRESS = "CASE l_linenumber % 4 WHEN 0 THEN '01' WHEN 1 THEN '02' WHEN 2 THEN '03' ELSE '06' END"
_FROM_CITY = "CASE l_suppkey % 3 WHEN 0 THEN 'SIDOARJO' WHEN 1 THEN 'BATU' ELSE 'KEDIRI' END"
_TO_CITY = "CASE l_orderkey % 3 WHEN 0 THEN 'MALANG' WHEN 1 THEN 'BLITAR' ELSE 'MADIUN' END"
_DISTRICT = "CASE l_linenumber % 2 WHEN 0 THEN 'UTARA' ELSE 'SELATAN' END"
_COD = f"CASE WHEN l_tax > 0.04 THEN {_PRICE} WHEN l_tax > 0.02 THEN CAST(0 AS DECIMAL(18,2)) END"
_DELIVERED = "CASE WHEN l_linestatus = 'F' THEN l_shipdate + l_linenumber * INTERVAL '3' HOUR END"
_RETURNED = "CASE WHEN l_returnflag = 'R' THEN l_shipdate + INTERVAL '20' HOUR END"
_RETURN_NO = "CASE WHEN l_returnflag = 'R' THEN 'R' || l_orderkey || '-' || l_linenumber END"
_BRANCH = "CASE l_suppkey % 30 WHEN 1 THEN 'HEADQUARTER' WHEN 2 THEN NULL ELSE 'TH_' || (l_suppkey % 30) END"
_CODES = """('waybillSource', '104', 'Platform'), ('waybillSource', '114', 'Crossborder'),
    ('waybillSource', '101', 'Express'), ('waybillSource', '756', 'Marketplace'),
    ('waybillSource', '116', 'partner_c_legal_entity'), ('waybillSource', '803', 'partner_d_legal_entity_1'),
    ('waybillSource', '829', 'Api Partner'), ('waybillSource', '835', 'Api Partner Two'),
    ('waybillSource', '01', 'Counter'), ('orderSource', '104', 'Platform'),
    ('orderSource', '01', 'Counter'), ('orderSource', '03', 'Agent'),
    ('serviceType', '00', 'Pick up'), ('serviceType', '01', 'Drop off'),
    ('expressType', '01', 'STD'), ('expressType', '02', 'IDlite'), ('expressType', '03', 'SMD'),
    ('expressType', '06', 'iDtruck'), ('waybillStatus', '03', 'Delivery'),
    ('returnFlag', '1', 'Return'), ('returnFlag', '0', 'No return'), ('podFlag', '1', 'POD'),
    ('voidFlag', '1', 'Void'), ('voidFlag', '0', 'Active'), ('paymentType', '00', 'Cash'),
    ('paymentType', '01', 'Monthly'), ('operationType', '0', 'Pick up scan'),
    ('operationType', '1', 'Sending scan'), ('operationType', '2', 'Arrival scan'),
    ('operationType', '3', 'Delivery scan'), ('operationType', '4', 'Collection'),
    ('operationType', '5', 'Problem scan')"""


def _codes(portal: str) -> str:
    return f"""SELECT type_option, option_value, option_name FROM (VALUES {_CODES},
        ('waybillSource', '00', '{portal}')) AS t(type_option, option_value, option_name)"""


def _mapping(portal: str) -> str:
    return f"""SELECT type_option, waybill_source, parent_shipping_cleint, finance_source_category, parent_source
    FROM (VALUES ('waybillSource', 'Platform', 'x', 'Platform', 'E-Commerce'),
        ('waybillSource', 'Crossborder', 'x', 'E-Commerce', 'E-Commerce'),
        ('waybillSource', 'Express', 'x', 'E-Commerce', 'E-Commerce'),
        ('waybillSource', 'Marketplace', 'x', 'Marketplace', 'E-Commerce'),
        ('waybillSource', 'partner_c_legal_entity', 'x', 'Partner C Legal Entity', 'Corporate'),
        ('waybillSource', 'partner_d_legal_entity_1', 'x', 'Partner D Legal Entity', 'Corporate'),
        ('waybillSource', '{portal}', 'x', 'Key Accounts', 'Corporate'),
        ('waybillSource', 'Counter', 'x', 'Retail', 'Retail'),
        ('vipSeller', 'x', 'CLIENT_1', 'Seller One', 'Seller'),
        ('vipSeller', 'x', 'CLIENT_2', 'E-Commerce', 'E-Commerce'),
        ('vipSeller', 'x', 'CLIENT_3', 'Seller Three', 'Seller'))
        AS t(type_option, waybill_source, parent_shipping_cleint, finance_source_category, parent_source)"""


def _tiers(rows: str) -> str:
    return f"""SELECT CAST(low AS DECIMAL(18,4)) AS Bottom, CAST(high AS DECIMAL(18,4)) AS Up,
        CAST(times AS DECIMAL(18,4)) AS Multiplier FROM (VALUES {rows}) AS t(low, high, times)"""


VIEWS: dict[str, str] = {
    # Parcels: one row per line item.
    "parcels": f"""SELECT 'W' || l_orderkey AS waybill_no, {_RETURN_NO} AS return_waybill_no,
        'O' || l_orderkey AS order_no, {_DELIVERED} AS pod_record_time, {_RETURNED} AS return_pod_record_time,
        l_shipdate - INTERVAL '2' DAY AS shipping_time, l_shipdate + l_linenumber * INTERVAL '1' HOUR AS update_time,
        {_PARCEL_SOURCE} AS waybill_source, {_EXPRESS} AS express_type,
        CASE l_partkey % 6 WHEN 0 THEN '03' WHEN 1 THEN '04' ELSE '05' END AS waybill_status,
        CASE WHEN l_suppkey % 9 = 0 THEN 'PartnerB_SpecialService'
             WHEN l_suppkey % 9 < 5 THEN 'ACCOUNT_' || (l_suppkey % 9) END AS key_account_name,
        'CLIENT_' || (l_suppkey % 6) AS parent_client_identifier,
        'CLIENT_' || (l_suppkey % 6) AS parent_shipping_cleint,
        'Seller ' || (l_suppkey % 7) AS vip_customer_name, l_suppkey % 40 AS vip_customer_id,
        {_COD} AS cod_amount,
        CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(CAST(l_quantity * 0.131 AS DECIMAL(18,3)) AS STRING) END
            AS item_calculated_weight,
        CAST(CAST(l_quantity * 0.25 AS DECIMAL(18,2)) AS STRING) AS item_actual_weight,
        {_PARCEL_FEE} AS total_shipping_fee,
        CASE WHEN l_linenumber <> 5 THEN CAST({_PRICE} AS DECIMAL(18,4)) END AS standard_shipping_fee,
        {_of(_PRICE, "0.9")} AS receivable_shipping_fee, {_of(_PRICE, "0.01")} AS handling_fee,
        {_of(_PRICE, "0.02")} AS other_fee,
        CASE WHEN l_tax > 0.03 THEN {_of(_PRICE, "0.005")} ELSE CAST(0 AS DECIMAL(18,4)) END AS insurance_amount,
        CASE WHEN l_discount > 0.05 THEN {_of(_PRICE, "0.3")} ELSE CAST(0 AS DECIMAL(18,4)) END AS invoice_amount,
        {_of(_PRICE, "0.5")} AS claim_value, {_of(_PRICE, "2.0")} AS item_value, 'Item ' || (l_partkey % 100) AS item_name,
        CASE WHEN l_suppkey % 5 = 0 THEN '00' ELSE '01' END AS payment_type,
        'S' || l_suppkey AS sender_name, '08' || l_suppkey AS sender_cellphone,
        'PROVINCE_' || (l_suppkey % 4) AS sender_province_name, {_FROM_CITY} AS sender_city_name,
        l_suppkey % 3 AS sender_city_id, 'PROVINCE_' || (l_orderkey % 4) AS recipient_province_name,
        {_TO_CITY} AS recipient_city_name, {_DISTRICT} AS recipient_district_name,
        l_linenumber % 2 AS recipient_district_id, 'P' || l_partkey AS recipient_name,
        '09' || l_partkey AS recipient_cellphone, 'Street ' || l_orderkey AS recipient_address,
        {_BRANCH} AS pickup_branch_name, 'VH_' || (l_partkey % 20) AS pod_branch_name,
        'Courier ' || (l_partkey % 10) AS pod_courier_name,
        CASE WHEN l_linenumber = 6 THEN '1' ELSE '0' END AS void_flag,
        CASE WHEN l_partkey % 50 = 49 THEN '1' ELSE '0' END AS deleted,
        CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS return_flag,
        CASE WHEN l_linestatus = 'F' THEN '1' ELSE '0' END AS pod_flag
        FROM {{lineitem}}""",
    "returns": f"""SELECT 'W' || l_orderkey AS waybill_no, {_RETURN_NO} AS return_waybill_no,
        {_of(_PRICE, "0.1")} AS return_shipping_fee,
        CASE l_partkey % 3 WHEN 0 THEN '00' WHEN 1 THEN '104' ELSE '803' END AS order_source,
        'CLIENT_' || (l_suppkey % 6) AS parent_client_name,
        l_shipdate + INTERVAL '10' HOUR AS return_record_time,
        l_shipdate + INTERVAL '15' HOUR AS return_confirm_record_time,
        l_partkey % 5 AS return_type_id, 'Note ' || (l_partkey % 11) AS description
        FROM {{lineitem}} WHERE l_returnflag = 'R'""",
    # Billing inputs.
    "booked_orders": """SELECT 'W' || o_orderkey AS waybill_no,
        CASE WHEN o_orderkey % 97 = 0 THEN 'EXAMPLE_ORDER_EXCLUSION' ELSE 'O' || o_orderkey END AS order_no,
        CASE WHEN o_custkey % 4 = 0 THEN '104' ELSE '756' END AS order_source,
        CASE o_custkey % 3 WHEN 0 THEN 'SIDOARJO' WHEN 1 THEN 'BATU' ELSE 'KEDIRI' END AS sender_city_name,
        CASE o_orderkey % 3 WHEN 0 THEN 'MALANG' WHEN 1 THEN 'BLITAR' ELSE 'MADIUN' END AS recipient_city_name,
        o_orderdate + INTERVAL '18' HOUR AS input_time FROM {orders}""",
    "partner_orders": """SELECT 'W' || o_orderkey AS waybill_number, 'O' || o_orderkey AS booking_code,
        CASE o_orderkey % 4 WHEN 0 THEN 'fm,mm,lm' WHEN 1 THEN 'fm' WHEN 2 THEN 'mm,lm' END AS role_miles,
        o_custkey % 2 AS is_kr_whitelist, o_orderdate AS create_time FROM {orders}""",
    "netoff": f"""SELECT 'W' || o_orderkey AS waybill_no,
        CASE WHEN o_orderkey % 7 <> 0 THEN {_of(_TOTAL, "0.08")} END AS after_discount_shipping_fee,
        CASE WHEN o_orderkey % 11 <> 0 THEN {_of(_TOTAL, "0.02")} END AS after_discount_return_shipping_fee,
        {_of(_TOTAL, "0.01")} AS cod_fee, {_of(_TOTAL, "0.0011")} AS vat_cod_fee,
        o_orderdate AS created_at FROM {{orders}} WHERE o_orderpriority = '1-URGENT'""",
    "wallet_summary": f"""SELECT 'W' || l_orderkey AS waybill_no, {_PARCEL_FEE} AS total_shipping_fee,
        {_of(_PRICE, "0.1")} AS discount_amount, {_of(_PRICE, "0.85")} AS net_shipping_fee
        FROM {{lineitem}} WHERE l_returnflag = 'N' AND l_linestatus = 'O'""",
    "waybill_fees": f"""SELECT 'W' || o_orderkey AS waybill_no, {_of(_TOTAL, "0.03")} AS net_shipping_fee,
        {_of(_TOTAL, "0.004")} AS return_shipping_fee, o_orderdate AS create_time
        FROM {{orders}} WHERE o_orderstatus <> 'P'""",
    "codes": _codes("Key Account Portal"),
    "source_mapping": _mapping("Key Account Portal"),
    "platform_rates": """SELECT * FROM (VALUES
        ('MALANGUTARA', 'SIDOARJO', 0.30, 0.25, 'Available'), ('MALANGSELATAN', 'SIDOARJO', 0.28, 0.20, 'Unavailable'),
        ('BLITARUTARA', 'BATU', 0.35, 0.22, 'Available'), ('BLITARSELATAN', 'KEDIRI', 0.31, NULL, 'Available'),
        ('MADIUNUTARA', 'KEDIRI', 0.33, 0.15, 'Available'), ('MADIUNSELATAN', 'BATU', 0.40, 0.21, 'Available'))
        AS t(Lookup, Origin, IDlite, STD, IDlite_availability)""",
    "express_rates": """SELECT * FROM (VALUES
        ('UTARA', 'MALANG', 'SIDOARJO', 'STD', 12000.5, 0.10), ('UTARA', 'MALANG', 'BATU', 'SMD', 9000, 0.12),
        ('SELATAN', 'MALANG', 'SIDOARJO', 'IDlite', 8000, 0.08), ('SELATAN', 'BLITAR', 'BATU', 'iDtruck', 20000, 0.15),
        ('UTARA', 'BLITAR', 'KEDIRI', 'STD', 15000.75, 0.05), ('SELATAN', 'MADIUN', 'KEDIRI', 'IDlite', 7500, NULL))
        AS t(kecamatan, kota_kabupaten, origin, express_type, pricing, discount)""",
    "express_tiers": _tiers("(0, 1, 1), (1.01, 3, 2), (3.25, 5, 3.5), (6, 8, 5), (8.01, 900, 7)"),
    "crossborder_rates": """SELECT * FROM (VALUES
        ('MALANGUTARA', 'SIDOARJO', 52000.25, 0.11), ('MALANGSELATAN', 'BATU', 48000, 0.09),
        ('BLITARUTARA', 'SIDOARJO', 61000, 0.10), ('MADIUNSELATAN', 'KEDIRI', 57000, 0.2))
        AS t(lookup_destination, origin, pricing, discount_rate)""",
    "crossborder_tiers": _tiers("(0, 2.5, 1), (2.5, 6, 2.25), (7, 10, 4)"),
    "marketplace_tiers": _tiers("(0, 1, 1), (1.01, 2, 2), (2.01, 4, 4), (4.01, 13, 9)"),
    "marketplace_pricing": """SELECT * FROM (VALUES
        ('SIDOARJO', 'MALANG', 'Origin KR', 'M1', 9000, 8800, 2000, 3000, 4000),
        ('SIDOARJO', 'BLITAR', 'Origin KR', 'M3', 12000, 11500, 2500, 5000, 4500),
        ('SIDOARJO', 'MADIUN', 'Origin Non KR', 'M1', 10000, 9900, 2100, 3900, 4100),
        ('BATU', 'MALANG', 'Origin KR', 'M2', 9500, 9100, 2200, 3300, 4000),
        ('BATU', 'BLITAR', 'Origin Non KR', 'M2', 9700, 9300, 2000, 3700, 4000),
        ('KEDIRI', 'MADIUN', 'Origin KR', 'M3', 13000, 12500, 2600, 5600, 4800))
        AS t(Origin_City, Dest_City, status, type_m, e2e, e2e_tts, fm, mm, lm)""",
    "special_rates": """SELECT * FROM (VALUES
        ('SIDOARJO', 'MALANG', 'UTARA', 15000, 12000), ('BATU', 'BLITAR', 'SELATAN', 18000, 15500),
        ('KEDIRI', 'MADIUN', 'UTARA', 0, 100), ('SIDOARJO', 'MADIUN', 'SELATAN', 17000, 16000))
        AS t(origin_city, dest_city, dest_district, _gross_, _nett_)""",
    "area_coverage": """SELECT * FROM (VALUES ('MALANG', 'UTARA', 'AGENT_A'), ('MALANG', 'SELATAN', 'AGENT_B'),
        ('BLITAR', 'UTARA', 'AGENT_A'), ('MADIUN', 'SELATAN', 'AGENT_C')) AS t(dest_city, dest_district, master_agent)""",
    "area_rates": """SELECT * FROM (VALUES ('AGENT_A', 'STD', 0.12), ('AGENT_A', 'SMD', 0.1),
        ('AGENT_B', 'IDlite', 0.2), ('AGENT_B', 'iDtruck', 0.05)) AS t(area, express_type, discount)""",
    "destination_rates": """SELECT * FROM (VALUES
        ('SIDOARJO', 'MALANG', 'UTARA', 'partner_d_legal_entity_1', 14000, 11000),
        ('BATU', 'MALANG', 'SELATAN', 'partner_d_legal_entity_1', 13000, 10500),
        ('KEDIRI', 'BLITAR', 'UTARA', 'partner_d_legal_entity_1', 21000, 14000))
        AS t(origin_city, dest_city, dest_district, waybill_source, gross, nett)""",
    # Standard contracts: one search code per client, route and express type, several versions each.
    "standard_rates": """SELECT CAST(FLOOR(k / 40) AS INT) % 3 AS sender_location_id,
        CAST(FLOOR(k / 120) AS INT) % 2 AS recipient_location_id,
        CASE CAST(FLOOR(k / 240) AS INT) WHEN 0 THEN '01' WHEN 1 THEN '02' WHEN 2 THEN '03' ELSE '06' END AS express_type,
        (k % 40) * 3 AS shipping_client_id,
        CASE WHEN p_size % 11 <> 0 THEN CAST(p_size * 0.5 AS DECIMAL(9,4)) END AS discount_rate, 'S' || k AS search_code,
        CAST(CASE p_size % 7 WHEN 0 THEN '2001-08-02 16:59:59' WHEN 1 THEN '2001-08-02 17:00:00'
             ELSE '2030-01-01 00:00:00' END AS TIMESTAMP) AS end_expire_time,
        CAST('2000-01-01 00:00:00' AS TIMESTAMP) + p_size * INTERVAL '1' DAY AS created_at,
        CASE WHEN p_size % 13 = 5 THEN '1' ELSE '0' END AS deleted
        FROM (SELECT p_partkey % 960 AS k, p_size FROM {part})""",
    "api_rates": """SELECT * FROM (VALUES
        ('829', 'C', '829', 'Company A', 0.10, 0.12, 0.08, 0.05, 0.015, 0.5),
        ('00', 'C', '00', 'Company B', 0.11, 0.13, NULL, 0.06, 0.012, 0.4),
        ('01', NULL, '01', 'Company C', 0.10, 0.12, 0.08, 0.05, 0.015, 0.5),
        ('803', 'C', '803', 'Company D', 0.10, 0.12, 0.08, 0.05, 0.02, 0.3),
        ('813', 'C', '813', 'Company E', 0.10, 0.12, 0.08, 0.05, 0.015, 0.5))
        AS t(option_value, shipping_client, order_source, partner_company_name, STD, iDlite, SMD, iDtruck,
             cod_fee_percentage, return_fee_percentage)""",
    # Accrual inputs.
    "crossdock_orders": """SELECT o_orderdate + INTERVAL '20' HOUR AS inbound_time,
        CASE WHEN o_orderkey % 13 <> 0 THEN 'B' || o_orderkey END AS booking_code,
        CASE o_custkey % 5 WHEN 0 THEN 'TH TESTING HQ' WHEN 1 THEN NULL ELSE 'MH_' || (o_custkey % 5) END
            AS inbound_hub_name FROM {orders}""",
    "crossdock_summary": f"""SELECT l_shipdate + INTERVAL '19' HOUR AS print_group_time,
        'B' || l_orderkey AS booking_code, {_of(_PRICE, "0.07")} AS invoice
        FROM {{lineitem}} WHERE l_linestatus = 'O'""",
    # Finance extract, region and disbursement inputs.
    "options": _codes("VIP Customer Portal"),
    "finance_mapping": _mapping("VIP Customer Portal"),
    "return_types": """SELECT * FROM (VALUES (0, 'Refused', 0), (1, 'Address unknown', 0), (2, 'Damaged', 1),
        (3, 'Late', 0)) AS t(id, return_type, deleted)""",
    "account_bills": """SELECT o_orderkey AS id, 'VA' || o_orderkey AS account_number,
        o_orderdate + INTERVAL '3' DAY AS payment_date FROM {orders}""",
    "bill_waybills": f"""SELECT l_orderkey AS branch_virtual_account_id, 'VA' || l_orderkey AS account_number,
        'W' || l_orderkey AS waybill_no, {_COD} AS cod_amount
        FROM {{lineitem}} WHERE l_returnflag = 'R' AND l_linestatus = 'F'""",
    "area_flags": """SELECT * FROM (VALUES ('SIDOARJO', 1, CAST('2000-06-01' AS DATE)), ('BATU', 1, NULL),
        ('KEDIRI', 0, NULL)) AS t(sender_city_name, dropship_flag, start_date)""",
    "origin_pricing": "SELECT * FROM (VALUES ('SIDOARJO'), ('BATU')) AS t(sender_city_name)",
    "marketplace_reported": """SELECT 'W' || o_orderkey AS waybill_no,
        CASE WHEN o_custkey % 3 <> 0 THEN 'TYPE_' || (o_custkey % 3) END AS transaction_type
        FROM {orders} WHERE o_orderpriority = '2-HIGH'""",
    "vip_customers": """SELECT c_custkey AS id, CAST(FLOOR(c_custkey / 10) AS BIGINT) AS vip_parent_id,
        CASE WHEN c_custkey % 3 <> 0 THEN 'BP' || c_custkey END AS sap_bp_code,
        CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS sap_bp_name FROM {customer}""",
    "net_fees": f"""SELECT 'W' || l_orderkey AS waybill_no, CAST({_PRICE} AS DECIMAL(18,4)) AS standard_shipping_fee,
        {_COD} AS cod_amount, {_PARCEL_FEE} AS net_shipping_fee, {_of(_PRICE, "0.1")} AS return_shipping_fee,
        {_of(_PRICE, "0.01")} AS net_cod_fee, {_of(_PRICE, "0.005")} AS handling_fee,
        {_of(_PRICE, "0.002")} AS other_fee FROM {{lineitem}} WHERE l_returnflag <> 'A'
        UNION ALL SELECT 'X' || o_orderkey, {_of(_TOTAL, "1.0")}, NULL, {_of(_TOTAL, "0.9")}, NULL, NULL, NULL, NULL
        FROM {{orders}} WHERE o_orderstatus = 'P'""",
    "settled": f"""SELECT CAST(l_shipdate AS DATE) AS pod_record_time, CAST(NULL AS DATE) AS return_pod_record_time,
        l_shipdate AS calculated_date, {_PARCEL_SOURCE} AS waybill_source, 'Parent ' || (l_suppkey % 3) AS parent_source,
        'Category ' || (l_suppkey % 2) AS source_category, 'Seller ' || (l_suppkey % 7) AS vip_customer_name,
        CASE l_returnflag WHEN 'A' THEN 'COD' WHEN 'N' THEN 'Monthly' END AS payment_type,
        l_linenumber AS count_transaction, {_PARCEL_FEE} AS net_shipping_fee FROM {{lineitem}}""",
    # Virtual-account inputs.
    "accounts": f"""SELECT o_orderkey AS id, 'VA' || o_orderkey AS account_number, o_custkey % 100 AS branch_id,
        CASE WHEN o_custkey % 4 = 0 THEN '' ELSE 'BR_' || (o_custkey % 100) END AS branch_name,
        CASE o_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'AG_' || (o_custkey % 10) END AS agent_branch_name,
        CASE WHEN o_orderkey % 101 <> 0 THEN CAST(o_orderdate AS DATE) END AS create_va_date,
        CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL '75' HOUR END AS payment_date,
        CAST(o_orderdate AS DATE) AS calculate_date,
        CASE o_orderstatus WHEN 'P' THEN '0' WHEN 'O' THEN '1' ELSE '2' END AS payment_status,
        CASE WHEN o_orderkey % 6 <> 0 THEN {_of(_TOTAL, "0.6")} END AS cod_amount,
        CASE WHEN o_orderkey % 8 <> 0 THEN {_of(_TOTAL, "0.4")} END AS cash_settlement_amount FROM {{orders}}""",
    "account_log": """SELECT 'VA' || l_orderkey AS account_number, 'BANK' || (l_partkey % 5) AS bank_code,
        CASE WHEN l_linenumber % 2 = 0 THEN 'ok' END AS status_message,
        l_shipdate + l_linenumber * INTERVAL '1' MINUTE AS created_at FROM {lineitem}""",
    "banks": """SELECT * FROM (VALUES ('BANK0', 'Bank Zero'), ('BANK1', 'Bank One'), ('BANK2', 'Bank Two'),
        ('BANK3', 'Bank Three')) AS t(bank_code, bank_name)""",
    "branches": """SELECT s_suppkey AS id, 'ID_' || s_suppkey AS branch_no, 'BR_' || s_suppkey AS branch_name,
        CAST(FLOOR(s_suppkey / 10) AS BIGINT) AS agent_branch_id FROM {supplier}""",
    "branch_areas": """SELECT 'BR_' || s_suppkey AS branch_name, 'WILAYAH_' || s_nationkey AS wilayah,
        CASE WHEN s_suppkey % 7 <> 0 THEN 'DM_' || (s_suppkey % 7) END AS dm FROM {supplier} WHERE s_acctbal > 1000""",
    "account_corrections": f"""SELECT CAST(l_shipdate AS DATE) AS correction_date, l_suppkey AS branch_id,
        {_of(_PRICE, "0.001")} AS correction_amount,
        CASE WHEN l_linenumber <> 3 THEN l_returnflag || l_linestatus END AS note FROM {{lineitem}}""",
    "account_waybills": f"""SELECT l_orderkey AS branch_virtual_account_id,
        'W' || l_orderkey || '-' || l_linenumber AS waybill_no, {_COD} AS cod_amount
        FROM {{lineitem}} WHERE l_returnflag = 'R'""",
    "cash_waybills": f"""SELECT l_orderkey AS branch_virtual_account_id,
        'W' || l_orderkey || '-' || l_linenumber AS waybill_no,
        CASE WHEN l_tax > 0.01 THEN {_PARCEL_FEE} ELSE CAST(0 AS DECIMAL(18,4)) END AS total_shipping_fee,
        {_of(_PRICE, "0.02")} AS other_fee,
        CASE WHEN l_discount > 0.05 THEN {_of(_PRICE, "0.001")} ELSE CAST(0 AS DECIMAL(18,4)) END AS insurance_amount
        FROM {{lineitem}} WHERE l_returnflag <> 'A'""",
    # Wallet inputs.
    "wallets": "SELECT c_custkey AS id, c_name AS shipping_client FROM {customer}",
    "wallet_payments": f"""SELECT o_orderkey AS id, o_custkey AS wallet_id,
        CASE WHEN o_orderkey % 50 <> 0 THEN 'TX' || o_orderkey END AS tx_no,
        CASE o_orderkey % 5 WHEN 0 THEN '03' WHEN 1 THEN '04' WHEN 2 THEN '06' WHEN 3 THEN '01' ELSE '03' END AS tx_status,
        {_of(_TOTAL, "-0.9")} AS amount,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'B' || o_custkey
             WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE '' END AS batch_id,
        o_orderstatus AS request_status, o_orderdate + INTERVAL '2' HOUR AS create_time FROM {{orders}}""",
    "wallet_states": """SELECT * FROM (VALUES ('03', 'Weight correction'), ('04', 'Void'), ('06', 'Return'))
        AS t(code, process_name)""",
    "wallet_waybills": "SELECT o_orderkey AS wallet_history_id, 'W' || o_orderkey AS waybill_no FROM {orders}",
    "batch_waybills": "SELECT 'B' || o_custkey AS batch_id, 'W' || o_orderkey AS waybill_no FROM {orders}",
    "priced_orders": f"""SELECT 'W' || o_orderkey AS waybill_no, o_orderdate AS input_time,
        o_orderdate + INTERVAL '30' HOUR AS pickup_record_time,
        CASE o_orderkey % 4 WHEN 0 THEN '01' WHEN 1 THEN '02' WHEN 2 THEN '06' ELSE '99' END AS express_type,
        {_of(_TOTAL, "0.9")} AS standard_shipping_fee, {_of(_TOTAL, "0.02")} AS insurance_amount,
        {_of(_TOTAL, "0.03")} AS other_fee, {_of(_TOTAL, "0.05")} AS handling_fee,
        {_of(_TOTAL, "1.0")} AS total_shipping_fee FROM {{orders}} WHERE o_orderkey % 41 <> 0""",
    "priced_waybills": f"""SELECT 'W' || o_orderkey AS waybill_no, 'R' || o_orderkey AS return_waybill_no,
        o_orderdate + INTERVAL '1' DAY AS shipping_time,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '100' HOUR END AS pod_record_time,
        CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL '200' HOUR END AS return_pod_record_time,
        CASE WHEN o_custkey % 2 = 0 THEN {_of(_TOTAL, "0.9")} ELSE {_of(_TOTAL, "0.95")} END AS standard_shipping_fee,
        {_of(_TOTAL, "0.021")} AS insurance_amount, {_of(_TOTAL, "0.03")} AS other_fee,
        {_of(_TOTAL, "0.06")} AS handling_fee,
        CASE WHEN o_custkey % 2 = 0 THEN {_of(_TOTAL, "1.0")} ELSE {_of(_TOTAL, "0.8")} END AS total_shipping_fee
        FROM {{orders}} WHERE o_orderkey % 31 <> 0""",
    "priced_returns": f"""SELECT 'W' || o_orderkey AS waybill_no, 'R' || o_orderkey AS return_waybill_no,
        {_of(_TOTAL, "0.5")} AS return_standard_shipping_fee, {_of(_TOTAL, "0.01")} AS insurance_amount,
        {_of(_TOTAL, "0.01")} AS other_fee, {_of(_TOTAL, "0.02")} AS return_handling_fee,
        {_of(_TOTAL, "0.55")} AS return_shipping_fee FROM {{orders}} WHERE o_orderstatus <> 'O'""",
    # Order-monitoring inputs.
    "order_states": """SELECT 'W' || o_orderkey AS waybill_no, 'O' || o_orderkey AS order_no,
        CASE WHEN o_custkey % 3 = 0 THEN 'E' || o_orderkey END AS ecommerce_order_no,
        CASE o_custkey % 4 WHEN 0 THEN '01' WHEN 1 THEN '03' WHEN 2 THEN '104' ELSE '999' END AS order_source,
        CASE o_orderkey % 3 WHEN 0 THEN '00' WHEN 1 THEN '01' END AS service_type,
        CASE o_orderkey % 4 WHEN 0 THEN '01' WHEN 1 THEN '02' WHEN 2 THEN '06' ELSE '99' END AS express_type,
        CASE o_orderstatus WHEN 'P' THEN '03' WHEN 'O' THEN '02' ELSE '04' END AS order_status,
        CASE WHEN o_orderkey % 19 <> 0 THEN o_orderdate + INTERVAL '18' HOUR END AS input_time,
        o_orderdate + INTERVAL '1' DAY AS update_time, 'Customer ' || o_custkey AS vip_customer_name,
        'PROVINCE_' || (o_custkey % 4) AS sender_province, 'CITY_' || (o_custkey % 9) AS sender_city,
        'DISTRICT_' || (o_custkey % 6) AS sender_district, 'PROVINCE_' || (o_orderkey % 4) AS recipient_province,
        'CITY_' || (o_orderkey % 9) AS recipient_city, 'Street ' || o_orderkey AS recipient_address,
        'TH_' || (o_custkey % 20) AS pickup_branch_name FROM {orders}""",
    "waybill_states": """SELECT 'W' || o_orderkey AS waybill_no, 'O' || o_orderkey AS order_no,
        CASE WHEN o_custkey % 3 = 0 THEN 'E' || o_orderkey END AS ecommerce_order_no,
        CASE o_custkey % 4 WHEN 0 THEN '01' WHEN 1 THEN '03' WHEN 2 THEN '104' ELSE '999' END AS waybill_source,
        CASE o_orderkey % 3 WHEN 0 THEN '00' WHEN 1 THEN '01' END AS service_type,
        CASE o_orderkey % 4 WHEN 0 THEN '01' WHEN 1 THEN '02' WHEN 2 THEN '06' ELSE '99' END AS express_type,
        o_orderdate + INTERVAL '19' HOUR AS create_time, o_orderdate + INTERVAL '30' HOUR AS update_time,
        CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate + INTERVAL '28' HOUR END AS shipping_time,
        'Customer ' || o_custkey AS vip_customer_name,
        CASE WHEN o_orderkey % 23 = 0 THEN '1' ELSE '0' END AS void_flag,
        CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS pod_flag,
        CASE WHEN o_orderstatus = 'F' AND o_custkey % 5 <> 0 THEN o_orderdate + INTERVAL '99' HOUR END AS pod_record_time,
        CASE WHEN o_orderpriority = '5-LOW' THEN '1' ELSE '0' END AS return_flag,
        CASE WHEN o_custkey % 2 = 0 THEN o_orderdate + INTERVAL '150' HOUR END AS return_pod_record_time,
        CASE WHEN o_orderkey % 29 = 0 THEN '1' ELSE '0' END AS deleted,
        CASE o_orderkey % 6 WHEN 0 THEN '03' WHEN 1 THEN '04' WHEN 2 THEN '05' WHEN 3 THEN '06' WHEN 4 THEN '01' END
            AS waybill_status,
        CASE WHEN o_orderkey % 10 <> 0 THEN 'MH' || (o_orderkey % 8) || '-X' || (o_orderkey % 5) END AS sorting_code,
        'PROVINCE_' || (o_custkey % 4) AS sender_province_name, 'CITY_' || (o_custkey % 9) AS sender_city_name,
        'DISTRICT_' || (o_custkey % 6) AS sender_district_name, 'PROVINCE_' || (o_orderkey % 4) AS recipient_province_name,
        'CITY_' || (o_orderkey % 9) AS recipient_city_name, 'Street ' || o_orderkey AS recipient_address,
        'TH_' || (o_custkey % 20) AS pickup_branch_name FROM {orders} WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "scans": """SELECT 'W' || l_orderkey AS waybill_no,
        CASE l_suppkey % 9 WHEN 0 THEN 'MH_' WHEN 1 THEN 'DC_' WHEN 2 THEN 'HQ_' WHEN 3 THEN 'FB_' WHEN 4 THEN 'PD_'
             WHEN 5 THEN 'VH_' WHEN 6 THEN 'VT_' WHEN 7 THEN 'XX_' ELSE 'TH_' END || (l_suppkey % 20)
            AS operation_branch_name,
        CASE l_partkey % 5 WHEN 0 THEN 'MH_' WHEN 1 THEN 'TH_' WHEN 2 THEN 'DC_' WHEN 3 THEN NULL ELSE 'VH_' END
            || (l_partkey % 20) AS origin_branch_name,
        'VH_' || (l_partkey % 20) AS destination_branch_name, CAST(l_partkey % 7 AS STRING) AS operation_type,
        'User ' || (l_suppkey % 13) AS operation_user_name,
        l_shipdate + l_linenumber * INTERVAL '2' HOUR AS record_time,
        CASE WHEN l_returnflag = 'R' THEN 'P' || (l_partkey % 4) END AS problem_code, 'BAG' || l_partkey AS bag_no
        FROM {lineitem}""",
    "scan_branches": """SELECT branch_name, branch_no FROM (VALUES ('MH_0', 'ID_MH0'), ('MH_9', 'ID_MH1'), ('MH_18', 'NOCODE'),
        ('DC_1', 'ID_MH1'), ('DC_10', 'ID_MH2'), ('DC_19', 'ID_'), ('HQ_2', 'ID_MH2_A'), ('HQ_11', 'ID_MH3'),
        ('MH_7', 'ID_MH4'), ('MH_16', 'ID_MH5'), ('DC_8', 'ID_MH6'), ('DC_17', 'ID_MH7'), ('HQ_0', 'ID_MH0'),
        ('DC_1', 'ID_MH9')) AS t(branch_name, branch_no)""",
    "areas": """SELECT * FROM (VALUES ('DISTRICT_0', 'MH0-A'), ('DISTRICT_1', 'MH1-B'), ('DISTRICT_2', '--'),
        ('DISTRICT_3', 'MH3'), ('DISTRICT_4', '-MH4')) AS t(name, sorting_code)""",
    "problems": """SELECT * FROM (VALUES ('P0', 'Alamat salah'), ('P1', 'Rusak'), ('P2', 'Ditolak'))
        AS t(code, register_reason_bahasa)""",
    # Order-journey inputs.
    "registrations": """SELECT user_id AS tracking_id, ts AS created_time,
        CASE WHEN event_id % 3 = 0 THEN 'DEFAULT' ELSE 'CARRIER_' || (event_id % 3) END AS partner_name,
        'LOC_' || (event_id % 27) AS loc_code, 'Address ' || (event_id % 27) AS loc_address,
        'Place ' || (event_id % 27) AS loc_name FROM {events}""",
    "locations": """SELECT 'LOC_' || n_nationkey AS code,
        CASE n_nationkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'A' ELSE 'D' END AS partner_type,
        n_regionkey AS region_id FROM {nation}""",
    "districts": """SELECT r_regionkey AS district_id, 'Province ' || r_name AS province, 'City ' || r_name AS city,
        'District ' || r_name AS district FROM {region}""",
    "dropoffs": """SELECT user_id AS tracking_id, 'TH' || (event_id % 7) AS source_hub, ts AS event_time
        FROM {events} WHERE event_type = 'click'""",
    "hub_events": """SELECT user_id AS tracking_id,
        CASE event_type WHEN 'purchase' THEN '61' WHEN 'click' THEN '02' WHEN 'view' THEN '04' WHEN 'signup' THEN '09'
             ELSE '99' END AS evt_type,
        CASE CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 8 WHEN 0 THEN 'MH' WHEN 1 THEN 'DC' WHEN 2 THEN 'HQ'
             WHEN 3 THEN 'TH' WHEN 4 THEN 'FB' WHEN 5 THEN 'PD' WHEN 6 THEN 'VH' ELSE 'VT' END
            || CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 3 AS source_hub,
        'N' || (event_id % 4) AS next_hub, ts AS event_time FROM {events}""",
    "journey_orders": """SELECT user_id AS tracking_id, event_id AS order_id, 'X' || event_id AS ext_order_id, ts AS order_time,
        'Sender ' || (event_id % 50) AS sender_name, '08' || event_id AS sender_contact,
        CAST(event_id % 4 AS STRING) AS channel_id, CAST(event_id % 5 AS STRING) AS service_id,
        CAST(event_id % 6 AS STRING) AS status_id,
        CASE WHEN event_id % 4 = 0 THEN '04' WHEN event_id % 9 = 0 THEN NULL ELSE '02' END AS status,
        CASE WHEN event_id % 3 = 0 THEN 'THIRDPARTY' ELSE 'OWN' END AS handled_by,
        CASE WHEN event_id % 6 = 0 THEN 'HANDLER' WHEN event_id % 6 = 3 THEN 'DEFAULT' END AS partner_handler,
        ts + INTERVAL '1' HOUR AS pickup_start, ts + INTERVAL '3' HOUR AS pickup_end,
        CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL '2' HOUR END AS pickup_time,
        'TARGET' || (event_id % 5) AS target_hub,
        CASE event_id % 3 WHEN 0 THEN 'TH0' WHEN 1 THEN 'FB1' ELSE 'MH2' END AS pickup_hub,
        CASE WHEN event_id % 7 = 0 THEN ts + INTERVAL '5' HOUR END AS failed_pickup_time,
        CASE WHEN event_id % 7 = 0 THEN CAST(event_id % 4 AS STRING) END AS failed_reason_id, ts AS updated_at
        FROM {events} WHERE event_type = 'purchase'""",
    "journey_tracking": """SELECT user_id AS tracking_id, CAST(event_id % 3 AS STRING) AS cancel_flag,
        CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL '4' HOUR END AS pickup_logged,
        CASE WHEN event_id % 3 <> 0 THEN ts + INTERVAL '40' HOUR END AS pod_time, ts AS updated_at
        FROM {events} WHERE event_type = 'signup'""",
    "journey_options": """SELECT * FROM (VALUES ('0', 'Option zero'), ('1', 'Option one'), ('2', 'Option two'),
        ('3', 'Option three'), ('4', 'Option four')) AS t(option_id, val)""",
    "journey_failures": "SELECT * FROM (VALUES ('0', 'Nobody there'), ('1', 'Closed'), ('3', 'Not ready')) AS t(id, reason)",
}

# Logical input name -> view, per group of reports.
BILLING = {
    "fact_waybill_details": "parcels",
    "fact_orders": "booked_orders",
    "fact_returns": "returns",
    "fact_partner_orders": "partner_orders",
    "agg_daily_netoff_report": "netoff",
    "agg_wallet_summary": "wallet_summary",
    "fact_waybill_fees": "waybill_fees",
    "dim_system_codes": "codes",
    "dim_source_finance_mapping": "source_mapping",
    "dim_platform_discounts": "platform_rates",
    "dim_express_discounts": "express_rates",
    "dim_express_weight_tiers": "express_tiers",
    "dim_crossborder_discounts": "crossborder_rates",
    "dim_crossborder_weight_tiers": "crossborder_tiers",
    "dim_marketplace_weight_tiers": "marketplace_tiers",
    "dim_marketplace_pricing": "marketplace_pricing",
    "dim_special_account_discounts": "special_rates",
    "dim_area_coverage": "area_coverage",
    "dim_area_discounts": "area_rates",
    "dim_destination_discounts": "destination_rates",
    "dim_standard_rates": "standard_rates",
    "dim_api_platform_discounts": "api_rates",
}
ACCRUAL = {
    **BILLING,
    "fact_waybill_base": "parcels",
    "fact_crossdock_orders": "crossdock_orders",
    "agg_crossdock_summary": "crossdock_summary",
}
FINANCE = {
    "dm_waybill_waybill": "parcels",
    "waybill_waybill": "parcels",
    "waybill_return_bill": "returns",
    "system_option": "options",
    "return_type": "return_types",
    "branch_virtual_account_detail": "bill_waybills",
    "branch_virtual_account": "account_bills",
    "marketplace_orders": "partner_orders",
    "marketplace_netoff": "marketplace_reported",
    "marketplace_area_flag": "area_flags",
    "marketplace_origin_pricing": "origin_pricing",
    "res_vip_customer": "vip_customers",
    "masterdata_mapping_source_finance_v2": "finance_mapping",
    "net_off_report_daily": "net_fees",
    "dashboard_finance_disbursement": "settled",
}
ACCOUNTS = {
    "branch_virtual_account": "accounts",
    "branch_virtual_account_detail": "account_waybills",
    "cash_settlement_detail": "cash_waybills",
    "branch_virtual_account_correction": "account_corrections",
    "virtual_account_log": "account_log",
    "vendor_bank": "banks",
    "res_branch": "branches",
    "masterdata_finance_dm_wilayah": "branch_areas",
}
WALLET = {
    "wallet": "wallets",
    "wallet_history": "wallet_payments",
    "wallet_status": "wallet_states",
    "wallet_history_detail": "wallet_waybills",
    "vip_order": "batch_waybills",
    "order_order": "priced_orders",
    "waybill_waybill": "priced_waybills",
    "waybill_return_bill": "priced_returns",
    "system_option": "options",
}
MONITORING = {
    "shipping_order_dm": "order_states",
    "shipping_waybill_dm": "waybill_states",
    "shipping_line": "scans",
    "system_option": "options",
    "res_branch": "scan_branches",
    "res_area": "areas",
    "res_problem_package": "problems",
}
JOURNEY = {
    "source_table": "registrations",
    "location_ref": "locations",
    "region_ref": "districts",
    "dropoff_table": "dropoffs",
    "event_table": "hub_events",
    "orders": "journey_orders",
    "tracking": "journey_tracking",
    "options": "journey_options",
    "failures": "journey_failures",
}


def raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One sample table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str, files: Tables | None = None) -> DataFrame:
    """One derived input."""
    text = VIEWS[name]
    files = files or sample_files(spark, folder)
    used = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{table: files[table] for table in used})


def sample_files(spark: SparkSession, folder: str) -> Tables:
    """The sample tables themselves."""
    return Tables({n: (lambda n=n: raw(spark, folder, n)) for n in RAW})


def sample_tables(spark: SparkSession, folder: str, group: Mapping[str, str]) -> Tables:
    """The inputs of a group of reports; each file is opened once for all of them."""
    files = sample_files(spark, folder)
    return Tables({n: (lambda v=v: view(spark, folder, v, files)) for n, v in group.items()})


def view_sql(name: str) -> str:
    """A derived input as SQL over the plain table names."""
    return re.sub(r"\{(\w+)\}", r"\1", VIEWS[name])
