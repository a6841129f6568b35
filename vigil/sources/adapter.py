"""Test-table adapter: the driver's TPC-H-like tables seen as the six canonical input tables.

Each entry is one SELECT that is valid, unchanged, in Spark SQL and in DuckDB (see FIXTURES.md §6),
so the Spark side and the DuckDB oracle start from the very same rows. On Spark the driver tables are
passed as DataFrame parameters, so nothing is registered globally and Catalyst still prunes columns
and pushes filters into the parquet scans.
"""

from __future__ import annotations

import re

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

ADAPTER_SQL: dict[str, str] = {
    "inspections": """
SELECT o_orderkey AS inspection_id,
       CASE WHEN l_linenumber = 2 THEN concat(' ', CAST(o_custkey AS STRING), ' ')
            ELSE CAST(o_custkey AS STRING) END AS fei_number,
       n_name AS state,
       CASE WHEN n_regionkey = 0 THEN 'Canada' ELSE 'United States' END AS country,
       CAST(o_orderdate AS DATE) AS inspection_end_date,
       CASE WHEN l_returnflag = 'A' AND l_quantity > 40 THEN 'OAI'
            WHEN l_returnflag = 'R' AND l_quantity > 30 THEN 'vai '
            WHEN l_returnflag = 'N' AND l_quantity > 49 THEN NULL
            ELSE 'NAI' END AS classification_code,
       concat('Area ', CAST(l_linenumber AS STRING)) AS project_area,
       CASE p_type WHEN 'PROMO' THEN 'Food/Cosmetics' WHEN 'ECONOMY' THEN 'Drugs'
            WHEN 'MEDIUM' THEN 'Devices' WHEN 'SMALL' THEN 'Biologics'
            WHEN 'LARGE' THEN 'Animal Drugs'
            WHEN 'STANDARD' THEN CASE p_size % 3 WHEN 1 THEN 'Tobacco'
                                                 WHEN 2 THEN 'Radiological' END
       END AS product_type,
       p_brand AS additional_details
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey
     JOIN part ON l_partkey = p_partkey""",
    "inspections_citations": """
SELECT CASE WHEN l_linenumber = 6 AND l_partkey % 5 = 0 THEN l_orderkey + 1000000000 ELSE l_orderkey END AS inspection_id,
       CAST(o_custkey AS STRING) AS fei_number,
       CAST(o_orderdate AS DATE) AS inspection_end_date,
       CASE l_linenumber % 2 WHEN 0 THEN 'Drugs' ELSE 'Devices' END AS program_area,
       CASE WHEN l_linenumber = 7 THEN '  '
            WHEN l_linenumber % 2 = 0 THEN concat(' 21 cfr ', CAST(l_partkey % 25 AS STRING))
            ELSE concat('21 CFR ', CAST(l_partkey % 25 AS STRING), ' ') END AS act_cfr_number,
       l_returnflag AS short_description
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag IN ('R', 'A')""",
    "published483": """
SELECT l_orderkey * 10 + l_linenumber AS record_id, CAST(o_custkey AS STRING) AS fei_number,
       CAST(l_shipdate AS DATE) AS record_date,
       CAST(l_shipdate AS DATE) + CAST(l_partkey % 90 AS INT) AS publish_date, '483' AS record_type
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_linestatus = 'F' AND l_quantity > 35""",
    "compliance_actions": """
SELECT CAST(o_custkey AS STRING) AS fei_number,
       CASE WHEN l_linenumber = 1 THEN ' ' ELSE CAST(l_orderkey AS STRING) END AS case_injunction_id,
       CAST(l_shipdate AS DATE) AS action_taken_date,
       CASE l_linenumber % 3 WHEN 0 THEN 'Injunction' WHEN 1 THEN 'Warning Letter' ELSE 'Seizure' END AS action_type,
       CASE l_linenumber % 2 WHEN 0 THEN 'Drugs' ELSE 'Devices' END AS product_type
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'A' AND l_quantity <= 12""",
    "recalls": """
SELECT CAST(o_custkey AS STRING) AS fei_number, l_orderkey AS event_id, l_partkey AS product_id,
       CAST(l_shipdate AS DATE) + 30 AS center_classification_date,
       CASE l_linenumber % 3 WHEN 0 THEN 'Class I' WHEN 1 THEN 'Class II' ELSE 'Class III' END AS event_classification,
       CASE l_linestatus WHEN 'F' THEN 'Terminated' ELSE 'Ongoing' END AS status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'R' AND l_quantity <= 12""",
    "raw_cells": """
SELECT l_orderkey AS k, l_linenumber AS line,
       CASE l_linenumber % 5 WHEN 0 THEN concat(CAST(l_partkey AS STRING), '.0')
            WHEN 1 THEN concat('  ', CAST(l_partkey AS STRING), ' ')
            WHEN 2 THEN concat('00', CAST(l_partkey AS STRING))
            WHEN 3 THEN concat(CAST(l_partkey AS STRING), '.50') ELSE ' ' END AS raw_id,
       CASE l_linenumber % 4 WHEN 0 THEN '-' WHEN 1 THEN '' WHEN 2 THEN concat(' ', l_returnflag, ' ') ELSE l_returnflag END AS raw_text,
       CASE l_linenumber % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN '-' WHEN 2 THEN CASE l_partkey % 13
            WHEN 0 THEN concat(' ', CAST(CAST(l_shipdate AS DATE) AS STRING))
            WHEN 1 THEN concat(CAST(year(CAST(l_shipdate AS DATE)) AS STRING), '-', CAST(month(CAST(l_shipdate AS DATE)) AS STRING), '-', CAST(day(CAST(l_shipdate AS DATE)) AS STRING))
            WHEN 2 THEN concat(CAST(CAST(l_shipdate AS DATE) AS STRING), 'T09:30:00')
            WHEN 3 THEN concat(CAST(CAST(l_shipdate AS DATE) AS STRING), ' 9:30')
            WHEN 4 THEN concat(CAST(month(CAST(l_shipdate AS DATE)) AS STRING), '/', CAST(day(CAST(l_shipdate AS DATE)) AS STRING), '/', CAST(year(CAST(l_shipdate AS DATE)) AS STRING))
            WHEN 5 THEN concat(CAST(month(CAST(l_shipdate AS DATE)) AS STRING), '/', CAST(day(CAST(l_shipdate AS DATE)) AS STRING), '/', CAST(year(CAST(l_shipdate AS DATE)) AS STRING), ' 10:00')
            WHEN 6 THEN concat(CAST(month(CAST(l_shipdate AS DATE)) AS STRING), '/', CAST(day(CAST(l_shipdate AS DATE)) AS STRING), '/', substr(CAST(year(CAST(l_shipdate AS DATE)) AS STRING), 3, 2))
            WHEN 7 THEN concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec', month(CAST(l_shipdate AS DATE)) * 3 - 2, 3), ' ', CAST(day(CAST(l_shipdate AS DATE)) AS STRING), ', ', CAST(year(CAST(l_shipdate AS DATE)) AS STRING))
            WHEN 8 THEN concat(CASE month(CAST(l_shipdate AS DATE)) WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March' WHEN 4 THEN 'April' WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'August' WHEN 9 THEN 'September' WHEN 10 THEN 'October' WHEN 11 THEN 'November' WHEN 12 THEN 'December' END, ' ', CAST(day(CAST(l_shipdate AS DATE)) AS STRING), ', ', CAST(year(CAST(l_shipdate AS DATE)) AS STRING))
            WHEN 9 THEN concat(CAST(day(CAST(l_shipdate AS DATE)) AS STRING), '-', substr('JanFebMarAprMayJunJulAugSepOctNovDec', month(CAST(l_shipdate AS DATE)) * 3 - 2, 3), '-', CAST(year(CAST(l_shipdate AS DATE)) AS STRING))
            WHEN 10 THEN concat(CAST(year(CAST(l_shipdate AS DATE)) AS STRING), '/', CAST(month(CAST(l_shipdate AS DATE)) AS STRING), '/', CAST(day(CAST(l_shipdate AS DATE)) AS STRING))
            WHEN 11 THEN concat(upper(substr('JanFebMarAprMayJunJulAugSepOctNovDec', month(CAST(l_shipdate AS DATE)) * 3 - 2, 3)), ' ', CAST(day(CAST(l_shipdate AS DATE)) AS STRING), ' ', CAST(year(CAST(l_shipdate AS DATE)) AS STRING))
            WHEN 12 THEN concat(CAST(month(CAST(l_shipdate AS DATE)) AS STRING), '/', CAST(day(CAST(l_shipdate AS DATE)) AS STRING), '/', CASE WHEN l_orderkey % 2 = 0 THEN '68' ELSE '69' END)
            END ELSE CASE l_partkey % 4 WHEN 0 THEN 'bad' WHEN 1 THEN '13/45/2020' WHEN 2 THEN '2021-02-30' ELSE 'Foo 5, 2020' END END AS raw_date,
       CASE l_linenumber % 7 WHEN 0 THEN 'Yes' WHEN 1 THEN 'n' WHEN 2 THEN ' POSTED ' WHEN 3 THEN 'Not Posted' WHEN 4 THEN '1' WHEN 5 THEN 'maybe' END AS raw_bool,
       CASE l_linenumber % 5 WHEN 0 THEN 'No Action Indicated (NAI)' WHEN 1 THEN 'vai' WHEN 2 THEN 'Official Action (OAI)' WHEN 3 THEN 'Pending' END AS raw_class
FROM lineitem""",
}

_TABLE_WORD = re.compile(r"\b(" + "|".join(DRIVER_TABLES) + r")\b")


def driver_tables_in(sql: str) -> list[str]:
    """Driver tables a SQL text reads (used to bind only those as DataFrame parameters)."""
    return sorted(set(_TABLE_WORD.findall(sql)))


def spark_template(sql: str) -> str:
    """Turn bare driver-table names into ``{name}`` placeholders for ``spark.sql(text, **dfs)``."""
    return _TABLE_WORD.sub(lambda m: "{" + m.group(1) + "}", sql)


# Raw extracts for the loaders (2.C): each canonical table shown as the untyped spreadsheet the
# loaders expect, with the reference's header names. One (header, expression) list per dataset; each
# expression is valid in Spark SQL and DuckDB. Headers the adapter has no data for get derived or
# constant cells, chosen to exercise null tokens, padded ids, ``.0`` ids and required-field errors.
RAW_EXTRACTS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "inspections": ("inspections", [
        ("Inspection ID", "CAST(inspection_id AS STRING)"),
        ("FEI Number", "fei_number"),
        ("Legal Name", "concat('Firm ', trim(fei_number))"),
        ("City", "lower(state)"),
        ("State", "CASE WHEN project_area = 'Area 3' THEN '-' ELSE state END"),
        ("Zip Code", "CASE WHEN project_area = 'Area 1' THEN concat(CAST(inspection_id % 100000 AS STRING), '.0') "
                     "ELSE concat(' ', CAST(inspection_id % 100000 AS STRING)) END"),
        ("Country", "country"),
        ("Inspection End Date", "CAST(inspection_end_date AS STRING)"),
        ("Fiscal Year", "CAST(year(inspection_end_date) AS STRING)"),
        ("Posted Citations", "CASE upper(trim(classification_code)) WHEN 'NAI' THEN 'No' WHEN 'VAI' THEN ' posted ' "
                             "WHEN 'OAI' THEN 'Yes' END"),
        ("Classification", "CASE upper(trim(classification_code)) WHEN 'NAI' THEN 'No Action Indicated (NAI)' "
                           "WHEN 'VAI' THEN 'Voluntary Action Indicated (VAI)' "
                           "WHEN 'OAI' THEN 'Official Action Indicated (OAI)' END"),
        ("Classification Code", "classification_code"),
        ("Project Area", "project_area"),
        ("Product Type", "product_type"),
        ("Additional Details", "additional_details"),
        ("FMD-145 Date", "CASE WHEN project_area = 'Area 5' THEN CAST(inspection_end_date AS STRING) ELSE 'N/A' END"),
    ]),
    "inspections_citations": ("inspections_citations", [
        ("Inspection ID", "CAST(inspection_id AS STRING)"),
        ("FEI Number", "fei_number"),
        ("Legal Name", "concat('Firm ', fei_number)"),
        ("Inspection End Date", "CAST(inspection_end_date AS STRING)"),
        ("Program Area", "program_area"),
        ("Act/CFR Number", "act_cfr_number"),
        ("Short Description", "short_description"),
        ("Long Description", "CASE WHEN short_description = 'R' THEN '-' ELSE concat('Observation ', act_cfr_number) END"),
    ]),
    "compliance_actions": ("compliance_actions", [
        ("FEI Number", "fei_number"),
        ("Legal Name", "concat('Firm ', fei_number)"),
        ("State", "'-'"),
        ("Country/Area", "'United States'"),
        ("Product Type", "product_type"),
        ("Action Taken Date", "CAST(action_taken_date AS STRING)"),
        ("Action Type", "action_type"),
        ("Case/Injunction ID", "case_injunction_id"),
    ]),
    "recalls": ("recalls", [
        ("FEI Number", "fei_number"),
        ("Recalling Firm Name", "concat('Firm ', fei_number)"),
        ("Product Type", "'Drugs'"),
        ("Product Classification", "event_classification"),
        ("Status", "status"),
        ("Distribution Pattern", "CAST(NULL AS STRING)"),
        ("Recalling Firm City", "CAST(NULL AS STRING)"),
        ("Recalling Firm State", "CAST(NULL AS STRING)"),
        ("Recalling Firm Country", "'United States'"),
        ("Center Classification Date", "CAST(center_classification_date AS STRING)"),
        ("Reason for Recall", "CAST(NULL AS STRING)"),
        ("Product Description", "concat('Product ', CAST(product_id AS STRING))"),
        ("Event ID", "concat(CAST(event_id AS STRING), '.0')"),
        ("Event Classification", "event_classification"),
        ("Product ID", "CAST(product_id AS STRING)"),
        ("Center", "'CDER'"),
        ("Recall Details", "CAST(NULL AS STRING)"),
    ]),
    "published483": ("published483", [
        ("FEI Number", "CASE WHEN record_id % 7 = 0 THEN ' ' ELSE fei_number END"),
        ("Legal Name", "concat('Firm ', fei_number)"),
        ("Record Date", "CAST(record_date AS STRING)"),
        ("Record Type", "record_type"),
        ("Publish Date", "CAST(publish_date AS STRING)"),
        ("Download", "concat('file-', CAST(record_id AS STRING), '.pdf')"),
        ("Record ID", "CAST(record_id AS STRING)"),
    ]),
}
