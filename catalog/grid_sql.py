"""SQL definitions of the grid mapping over the source tables, as named subqueries for the check queries."""

from __future__ import annotations

import re

SITES = "(SELECT count(*) FROM supplier)"
AC_LINE = "o_orderpriority = '1-URGENT'"
TRANSFORMER = "o_orderpriority = '2-HIGH'"
SWITCH = "o_orderpriority = '3-MEDIUM'"
MACHINE = "o_orderpriority = '4-NOT SPECIFIED' AND quarter(o_orderdate) = 1"
LOAD = "o_orderpriority = '4-NOT SPECIFIED' AND quarter(o_orderdate) = 2"
COMPENSATOR = "o_orderpriority = '4-NOT SPECIFIED' AND quarter(o_orderdate) = 3"
BUSBAR = "o_orderpriority = '4-NOT SPECIFIED' AND quarter(o_orderdate) = 4"
CONVERTER = "o_orderpriority = '5-LOW' AND quarter(o_orderdate) <= 2"
DC_LINE = "o_orderpriority = '5-LOW' AND quarter(o_orderdate) > 2"

SUBQUERIES: dict[str, str] = {
    # Equipment: one row per order, with its class and the attributes every class has.
    "eq": f"""
        SELECT 'eq-' || o_orderkey AS eq, o_orderkey AS o, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
          CASE WHEN {AC_LINE} THEN 'ACLineSegment'
               WHEN {TRANSFORMER} THEN 'PowerTransformer'
               WHEN {SWITCH} THEN CASE quarter(o_orderdate) WHEN 1 THEN 'Breaker' WHEN 2 THEN 'Disconnector'
                                       WHEN 3 THEN 'LoadBreakSwitch' ELSE 'GroundDisconnector' END
               WHEN {MACHINE} THEN 'SynchronousMachine'
               WHEN {LOAD} THEN CASE month(o_orderdate) WHEN 4 THEN 'ConformLoad' WHEN 5 THEN 'NonConformLoad'
                                     ELSE 'EnergyConsumer' END
               WHEN {COMPENSATOR} THEN 'SeriesCompensator'
               WHEN {BUSBAR} THEN 'BusbarSection'
               WHEN {CONVERTER} THEN 'VoltageSourceConverter'
               ELSE 'DCLineSegment' END AS cls,
          {SWITCH} AS is_switch,
          CASE WHEN month(o_orderdate) = 12 THEN 'HVDC ' ELSE '' END || o_orderpriority || ' ' || o_orderkey AS name,
          CASE WHEN o_orderstatus <> 'P' THEN 'A-' || o_custkey END AS alias_name,
          CASE WHEN {AC_LINE} THEN 'ln-' || o_custkey
               WHEN {TRANSFORMER} THEN 'ss-' || (o_custkey % {SITES})
               WHEN o_orderpriority = '5-LOW' THEN 'vl-' || (o_custkey % {SITES}) || '-1'
               ELSE 'vl-' || (o_custkey % {SITES}) || '-0' END AS container,
          CASE WHEN year(o_orderdate) = 1996 THEN NULL ELSE year(o_orderdate) <> 1997 END AS flag,
          coalesce(year(o_orderdate) <> 1997, true) AS enabled,
          CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS in_service,
          CASE WHEN year(o_orderdate) >= 1998 THEN 'Normal@20' ELSE 'Warning@20' END AS limit_name,
          quarter(o_orderdate) AS bv
        FROM orders""",
    # Terminals: one row per order and line number.
    "ends": """
        SELECT l_orderkey AS o, l_linenumber AS nr, 'eq-' || l_orderkey AS eq,
          'tm-' || l_orderkey || '-' || l_linenumber AS tm, 'te-' || l_orderkey || '-' || l_linenumber AS te,
          'T' || l_linenumber || '-' || l_orderkey AS t_name,
          min(l_partkey) AS part, min(l_suppkey) AS supp, max(l_extendedprice) AS price, min(l_tax) AS tax,
          max(l_quantity) AS qty, min(l_discount) AS disc,
          NOT bool_or(l_returnflag = 'R') AS connected, bool_or(l_returnflag = 'A') AS accepted,
          bool_and(l_linestatus = 'O') AS is_open,
          CASE WHEN min(l_discount) > 0 THEN l_linenumber END AS seq,
          CASE WHEN max(l_quantity) >= 5 THEN max(l_extendedprice) - 50000 END AS p,
          CASE WHEN max(l_quantity) >= 5 THEN min(l_tax) END AS q
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "windings": "SELECT ends.*, eq.container, eq.enabled, eq.name AS tr_name, eq.alias_name, eq.in_service AS state FROM ends JOIN eq USING (o) WHERE cls = 'PowerTransformer'",
    "site": f"""
        SELECT 'ss-' || s_suppkey AS ss, s_suppkey, s_name, 'sg-' || s_nationkey AS sg, r_name AS area,
          CASE WHEN s_acctbal >= 1000 THEN 'EIC-' || n_name END AS zone,
          CASE WHEN s_acctbal >= 1000 THEN 'mdp-' || s_suppkey END AS mdp, s_nationkey
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "volt": """
        SELECT r_regionkey AS bv, 'bv-' || r_regionkey AS bv_id,
          CAST(CASE r_regionkey WHEN 0 THEN 66 WHEN 1 THEN 132 WHEN 2 THEN 220 WHEN 3 THEN 300 ELSE 420 END AS DOUBLE) AS un
        FROM region""",
    "bands": """
        SELECT s_suppkey, CASE WHEN s_acctbal < 2000 THEN 0 WHEN s_acctbal < 4000 THEN 1 WHEN s_acctbal < 6000 THEN 2
                               WHEN s_acctbal < 8000 THEN 3 ELSE 4 END AS band
        FROM supplier""",
    "lvl": """
        SELECT 'vl-' || s_suppkey || '-0' AS vl, band AS bv, 'ss-' || s_suppkey AS ss FROM bands
        UNION ALL
        SELECT 'vl-' || s_suppkey || '-1' AS vl, 4 - band AS bv, 'ss-' || s_suppkey AS ss FROM bands""",
    "places": "SELECT lvl.vl, volt.un, volt.bv_id, site.* FROM lvl JOIN volt USING (bv) JOIN site USING (ss)",
    # Nodes of parts with what their container gives.
    "cn": f"""
        SELECT p_partkey AS part, 'cn-' || p_partkey AS cn,
          CASE WHEN p_size = 50 THEN 'ln-' || (p_partkey % {SITES})
               WHEN p_size > 25 THEN 'vl-' || (p_partkey % {SITES}) || '-1'
               ELSE 'vl-' || (p_partkey % {SITES}) || '-0' END AS container,
          CASE WHEN p_type <> 'PROMO' THEN p_partkey // 2 END AS tn
        FROM part""",
    "cn_place": "SELECT cn.part, cn.cn, cn.tn, places.* FROM cn JOIN places ON cn.container = places.vl",
    "tn": f"""
        SELECT p_partkey AS tn, 'tn-' || p_partkey AS tn_id, p_name || ' ' || p_partkey AS tn_name, (p_size - 1) // 10 AS bv,
          'vl-' || (p_partkey % {SITES}) || '-' || (CASE WHEN p_size > 25 THEN 1 ELSE 0 END) AS container,
          p_type, CASE WHEN p_type <> 'SMALL' THEN p_type END AS island,
          CASE WHEN p_brand <> 'Brand#1' THEN CASE WHEN p_size = 1 THEN 0 ELSE p_retailprice / 4 END END AS v,
          CASE WHEN p_brand <> 'Brand#1' THEN CAST(p_size - 25 AS DOUBLE) END AS angle,
          p_retailprice - 1000 AS p_inj, CASE WHEN p_type <> 'MEDIUM' THEN CAST(p_size AS DOUBLE) END AS q_inj
        FROM part""",
    "lines": f"""
        SELECT 'ln-' || c_custkey AS ln, c_name, r_name AS area,
          CASE WHEN c_acctbal >= 0 THEN 'M-' || c_nationkey END AS market_code,
          'mdp-' || (c_custkey % {SITES}) AS mdp_from, 'mdp-' || ((c_custkey + 1) % {SITES}) AS mdp_to
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    # Terminals with the topological node of their node, else their own.
    "ends_tp": """
        SELECT ends.*, cn.cn, CASE WHEN cn.tn IS NOT NULL THEN cn.tn WHEN is_open THEN ends.part END AS tn
        FROM ends JOIN cn USING (part)""",
    "res": """
        SELECT c_custkey, 'sr-' || c_custkey AS sr, c_mktsegment || ' ' || c_custkey AS sr_name,
          CASE WHEN c_acctbal > 5000 THEN c_name END AS sr_alias,
          CASE WHEN c_acctbal >= 0 THEN 'M-' || c_nationkey || '-' || c_mktsegment END AS sr_code
        FROM customer""",
    "unit": """
        SELECT eq.o, eq.o_custkey, 'gu-' || o AS gu, 'Unit ' || o AS gu_name, flag, enabled, o_orderstatus, c_mktsegment,
          CASE c_mktsegment WHEN 'MACHINERY' THEN 'HydroGeneratingUnit' WHEN 'BUILDING' THEN 'ThermalGeneratingUnit'
            WHEN 'AUTOMOBILE' THEN 'WindGeneratingUnit' WHEN 'FURNITURE' THEN 'SolarGeneratingUnit' END AS kind,
          CASE WHEN day(o_orderdate) <> 1 THEN least(c_acctbal, 0) END AS min_p, abs(c_acctbal) AS max_p,
          CASE WHEN month(o_orderdate) <> 1 THEN 'G-' || c_nationkey END AS g_code,
          CAST(day(o_orderdate) AS DOUBLE) AS weight, month(o_orderdate) = 3 AS frr,
          CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 3000 THEN 'storage'
               WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 6000 THEN 'runOfRiver' END AS storage
        FROM eq JOIN customer ON o_custkey = c_custkey WHERE cls = 'SynchronousMachine'""",
}


def _needed(sql: str, found: list[str]) -> list[str]:
    for name, body in SUBQUERIES.items():
        if name not in found and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
            _needed(body, found)
            if name not in found:
                found.append(name)
    return found


def grid(sql: str) -> str:
    """Prefix a query with the subqueries it reads."""
    names = _needed(sql, [])
    parts = [f"{name} AS ({SUBQUERIES[name].strip()})" for name in names]
    body = sql.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
