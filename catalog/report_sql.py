"""Check queries of the reports, in plain SQL over the source tables."""

from __future__ import annotations

LOSS = """CASE WHEN p1 < p2 THEN p1 + p2 WHEN p1 >= p2 THEN 0 END AS ploss_1,
          CASE WHEN p1 > p2 THEN p1 + p2 WHEN p1 <= p2 THEN 0 END AS ploss_2"""


def two_ends(number: str) -> str:
    return f"""
    g AS (SELECT eq, count(*) AS n,
            max(CASE WHEN {number} = 1 THEN p END) AS p1, max(CASE WHEN {number} = 2 THEN p END) AS p2,
            bool_or({number} = 1 AND connected) AS c1, bool_or({number} = 2 AND connected) AS c2,
            max(CASE WHEN {number} = 1 THEN cn ELSE '' END) AS n1, max(CASE WHEN {number} = 2 THEN cn ELSE '' END) AS n2
          FROM ends JOIN cn_place USING (part) WHERE {number} IS NOT NULL GROUP BY eq)"""


WINDING_LOSS = """
    loss AS (SELECT eq, sum(coalesce(p, 0)) / nullif(sum(CASE WHEN coalesce(CASE WHEN nr = 1 THEN state END, connected)
                    THEN 1 ELSE 0 END), 0) AS ploss_2
             FROM windings JOIN site ON container = ss WHERE enabled GROUP BY eq)"""

REPORT_SQL: dict[str, str] = {
    "ac_lines": f"""
        WITH {two_ends("nr")}
        SELECT eq.eq AS mrid, name, {LOSS}, o_totalprice / 1000 AS r,
          CASE WHEN limit_name = 'Normal@20' THEN CAST(o_custkey AS DOUBLE) END AS rate,
          coalesce(in_service, c1 AND c2, true) AS status, un, o_totalprice / 100 AS x, o_totalprice / 10 AS b,
          CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS g, CAST(day(o_orderdate) AS DOUBLE) AS length,
          n1 AS connectivity_node_1, n2 AS connectivity_node_2
        FROM eq JOIN g ON eq.eq = g.eq JOIN volt USING (bv)
        WHERE cls = 'ACLineSegment' AND enabled AND n > 1 AND n1 <> n2 AND n1 <> '' AND n2 <> ''""",
    "series_compensators": f"""
        WITH {two_ends("seq")}
        SELECT eq.eq AS mrid, name, {LOSS}, o_totalprice / 1000 AS r,
          CASE WHEN limit_name = 'Normal@20' THEN CAST('1.7320508075688772' AS DOUBLE) * un * o_custkey / 1000 END AS rate,
          coalesce(in_service, c1 AND c2) AS status, un, o_totalprice / 100 AS x,
          n1 AS connectivity_node_1, n2 AS connectivity_node_2
        FROM eq JOIN g ON eq.eq = g.eq JOIN volt USING (bv)
        WHERE cls = 'SeriesCompensator' AND n > 1 AND n1 <> n2""",
    "transformers": """
        SELECT 'W' || nr || '-' || o AS name, eq AS p_mrid, te AS w_mrid, nr AS end_number, qty + 60 AS un, tm AS t_mrid,
          tax * 10 AS r, price / 1000 AS x,
          CASE WHEN nr = 1 AND limit_name = 'Normal@20' THEN CAST(o_custkey AS DOUBLE) END AS rate
        FROM windings JOIN (SELECT o, limit_name, o_custkey FROM eq) USING (o) JOIN site ON container = ss
        WHERE enabled""",
    "transformer_branches": f"""
        WITH {WINDING_LOSS}
        SELECT te AS mrid, 'W' || nr || '-' || o AS name, coalesce(CASE WHEN nr = 1 THEN state END, connected) AS status, un,
          tax * 10 AS r, price / 1000 AS x, disc AS b, disc * 2 AS g,
          CASE WHEN nr = 2 AND limit_name = 'Normal@20' THEN CAST(o_custkey AS DOUBLE) END AS rate,
          CAST(CASE WHEN accepted THEN 30 * nr ELSE 0 END AS DOUBLE) AS angle,
          un * (CASE WHEN accepted THEN 1 + (CASE WHEN is_open THEN nr + 1 ELSE nr END - 4) * (disc * 10 + 0.5) / 100 ELSE 1 END)
            / (qty + 60) AS ratio,
          cn AS connectivity_node_1, windings.eq AS connectivity_node_2, CAST(0 AS DOUBLE) AS ploss_1,
          round(ploss_2, 4) AS ploss_2
        FROM windings JOIN (SELECT o, limit_name, o_custkey FROM eq) USING (o)
        JOIN site owner ON windings.container = owner.ss
        JOIN cn_place USING (part) LEFT JOIN loss ON loss.eq = windings.eq WHERE enabled""",
    "winding_loss": f"WITH {WINDING_LOSS} SELECT eq AS mrid, round(ploss_2, 4) AS ploss_2 FROM loss",
    "winding_angle": """
        SELECT te AS mrid, (CASE WHEN is_open THEN qty ELSE nr END - 3) * (tax * 10) AS angle
        FROM windings WHERE NOT accepted""",
    "windings": """
        SELECT eq AS p_transformer, count(*) AS count, max(tr_name) AS name,
          CAST(sum(CASE WHEN coalesce(CASE WHEN nr = 1 THEN state END, connected) THEN 1 ELSE 0 END) AS BIGINT) AS nr_on,
          round(sum(coalesce(p, 0)), 4) AS p
        FROM windings GROUP BY eq""",
    "transformer_windings": "SELECT eq AS mrid, nr AS end_number, te AS w_mrid FROM windings",
    "phase_tap_changer": """
        SELECT te AS mrid, tax * 10 AS phase_shift_increment, is_open AND qty > 10 AS enabled, 3 AS neutral_step,
          7 AS high_step, 0 AS low_step, 'RegulatingControlModeKind.activePower' AS mode, price AS target_value,
          te AS monitored_winding
        FROM windings WHERE NOT accepted""",
    "sv_branch": """
        WITH e AS (SELECT ends.eq, nr, p, q, v, angle FROM ends JOIN cn USING (part)
                   LEFT JOIN tn ON tn.tn = cn.tn
                   JOIN (SELECT unnest([1, 2]) AS copy) ON copy = 1 OR disc = 0
                   WHERE cn.tn IS NOT NULL)
        SELECT eq.eq AS mrid, name, o_totalprice / 1000 AS r, o_totalprice / 100 AS x, o_totalprice / 10 AS bch,
          o_totalprice AS gch, in_service AS status, CAST(NULL AS DOUBLE) AS length, un,
          a.p AS p_1, a.q AS q_1, b.p AS p_2, b.q AS q_2, a.v AS v_1, a.angle AS angle_1, b.v AS v_2, b.angle AS angle_2
        FROM eq JOIN volt USING (bv) JOIN e a ON a.eq = eq.eq AND a.nr = 1 JOIN e b ON b.eq = eq.eq AND b.nr = 2
        WHERE cls = 'ACLineSegment' AND enabled AND o_orderstatus = 'F'""",
    "transformer_center_nodes": """
        SELECT windings.eq AS node, tr_name AS busname, owner.s_name AS substation, cn_place.un, cn_place.bv_id AS base_voltage_mrid,
          owner.ss AS substation_mrid, owner.zone AS bidzone, coalesce(tn.island, 'Unknown') AS island,
          false AS is_swing_bus, cn AS connectivity_node, cn_place.un AS sv_voltage
        FROM windings JOIN site owner ON windings.container = owner.ss JOIN cn_place USING (part)
        LEFT JOIN tn ON tn.tn = cn_place.tn
        WHERE enabled AND nr = 1 AND owner.zone IS NOT NULL""",
    "topological_nodes": """
        SELECT tn_id AS node, tn_name AS busname, s_name AS substation, volt.un, volt.bv_id AS base_voltage_mrid, ss AS substation_mrid,
          zone AS bidzone, v AS sv_voltage, coalesce(island, 'Unknown') AS island, refs.ref IS NOT NULL AS is_swing_bus
        FROM tn JOIN places ON tn.container = places.vl JOIN volt ON volt.bv = tn.bv
        LEFT JOIN (SELECT min(p_partkey) AS ref FROM part WHERE p_type <> 'SMALL' GROUP BY p_type) refs ON refs.ref = tn.tn
        WHERE v IS NOT NULL""",
    "loads": """
        SELECT eq.eq AS mrid, name, ss AS substation_mrid, coalesce(in_service, connected) AS status, p, q,
          CASE WHEN cls <> 'ConformLoad' THEN sr_code END AS station_group, cn AS connectivity_node, cls AS load_type
        FROM eq JOIN places ON container = vl JOIN ends ON ends.eq = eq.eq JOIN cn USING (part)
        JOIN res ON c_custkey = o_custkey
        WHERE cls IN ('ConformLoad', 'NonConformLoad', 'EnergyConsumer') AND enabled AND p IS NOT NULL""",
    "synchronous_machines": """
        WITH u AS (SELECT *, min_p IS NOT NULL AS lim, min_p IS NOT NULL AND g_code IS NOT NULL AND sr_code IS NOT NULL AS traded
                   FROM unit JOIN res ON c_custkey = o_custkey WHERE kind IS NOT NULL AND o_orderstatus <> 'P')
        SELECT CASE WHEN lim THEN gu ELSE eq.eq END AS mrid, name, CASE WHEN traded THEN g_code END AS market_code,
          coalesce(in_service, connected) AS status, CASE WHEN traded THEN sr_code END AS station_group,
          CASE WHEN traded THEN sr_name END AS station_group_name, ss AS substation_mrid,
          CASE WHEN lim THEN max_p WHEN p >= 0 THEN p ELSE 0 END AS max_p,
          CASE WHEN lim THEN min_p WHEN p < 0 THEN p ELSE 0 END AS min_p,
          CASE WHEN traded THEN weight END AS merit_order, o_totalprice AS sn, p, q, cn AS connectivity_node,
          coalesce(kind, 'unknown') AS generator_type, storage AS storage_type, CASE WHEN traded THEN sr END AS schedule_resource,
          coalesce(frr, false) AS afrr_prequalified
        FROM eq JOIN places ON eq.container = vl JOIN ends ON ends.eq = eq.eq JOIN cn USING (part)
        LEFT JOIN u ON u.o = eq.o
        WHERE cls = 'SynchronousMachine' AND eq.enabled AND p IS NOT NULL""",
    "wind_generating_units": """
        WITH u AS (SELECT *, o_orderstatus <> 'F' AND g_code IS NOT NULL AND sr_code IS NOT NULL AS bound
                   FROM unit JOIN res ON c_custkey = o_custkey WHERE kind = 'WindGeneratingUnit' AND enabled AND min_p IS NOT NULL)
        SELECT gu AS mrid, gu_name AS name, CASE WHEN bound THEN g_code END AS market_code,
          CASE WHEN bound THEN sr_code END AS station_group, min_p, max_p, CASE WHEN bound THEN 'wp-' || o_custkey END AS plant_mrid
        FROM u""",
    "connections": """
        SELECT eq.eq AS mrid, a.tm AS t_mrid_1, b.tm AS t_mrid_2
        FROM eq JOIN ends a ON a.eq = eq.eq AND a.nr = 1 JOIN ends b ON b.eq = eq.eq AND b.nr = 2
        WHERE cls IN ('Breaker', 'Disconnector') AND enabled""",
    "switches": """
        WITH last AS (SELECT eq, max(seq) AS seq FROM ends GROUP BY eq)
        SELECT eq.eq AS mrid, CASE WHEN o_orderstatus = 'P' THEN false ELSE year(o_orderdate) >= 1999 END AS is_open,
          cls AS equipment_type, ca.cn AS connectivity_node_1, cb.cn AS connectivity_node_2, flag AS network_enabled, name
        FROM eq JOIN last ON last.eq = eq.eq JOIN ends a ON a.eq = eq.eq AND a.seq = 1
        JOIN ends b ON b.eq = eq.eq AND b.seq = last.seq JOIN cn ca ON ca.part = a.part JOIN cn cb ON cb.part = b.part
        WHERE is_switch AND flag IS NOT NULL""",
    "associated_switches": """
        WITH sw AS (SELECT ends.part, ends.eq, name FROM ends JOIN eq USING (o)
                    JOIN (SELECT o FROM ends WHERE seq = 2) two USING (o) WHERE is_switch)
        SELECT eq.eq AS mrid, eq.name AS name, string_agg(sw.eq, ',' ORDER BY sw.eq, sw.name) AS switch_mrids,
          string_agg(sw.name, ',' ORDER BY sw.eq, sw.name) AS switch_names
        FROM eq JOIN ends ON ends.eq = eq.eq JOIN sw ON sw.part = ends.part
        WHERE NOT is_switch GROUP BY eq.eq, eq.name""",
    "disconnected": """
        SELECT eq AS mrid FROM eq WHERE cls = 'Disconnector' AND o_orderstatus <> 'P' AND year(o_orderdate) >= 1999
        UNION ALL SELECT tm FROM ends WHERE NOT connected
        UNION ALL SELECT tm FROM ends WHERE NOT connected AND disc = 0""",
    "connectivity_nodes": """
        WITH active AS (SELECT DISTINCT part FROM ends JOIN eq USING (o) WHERE flag),
        touched AS (SELECT cn_place.* FROM cn_place WHERE part IN (SELECT part FROM ends))
        SELECT cn AS mrid, ss AS container, s_name AS container_name, un, bv_id AS base_voltage_mrid,
          coalesce(zone, (SELECT max(zone) FROM touched)) AS bidzone, 'Substation' AS container_type
        FROM cn_place JOIN active USING (part)
        UNION ALL
        SELECT cn, ln, c_name, (SELECT max(un) FROM touched), (SELECT max_by(bv_id, un) FROM touched), NULL, 'Line'
        FROM cn JOIN active USING (part) JOIN lines ON cn.container = lines.ln""",
    "busbar_section": """
        WITH own AS (SELECT ends.eq, part FROM ends JOIN eq USING (o) WHERE cls = 'BusbarSection'),
        met AS (SELECT own.eq, count(*) AS terminal_count FROM own JOIN ends USING (part) GROUP BY own.eq)
        SELECT 'cn-' || part AS mrid, own.eq AS busbar_mrid, terminal_count FROM own JOIN met ON met.eq = own.eq""",
    "substation_voltage_level": """
        SELECT ss AS substation, vl AS container, un AS v FROM places
        JOIN (SELECT ss, max(un) AS un FROM places GROUP BY ss) USING (ss, un)""",
    "base_voltage": """
        SELECT bv_id AS mrid, un, round(avg(v), 4) AS operating_voltage FROM tn JOIN volt USING (bv) WHERE v > 0 GROUP BY bv_id, un""",
    "coordinates": """
        WITH owners AS (SELECT s_suppkey AS loc, 'ss-' || s_suppkey AS mrid, 'Substation' AS kind FROM supplier
                        UNION ALL SELECT o_custkey, eq, 'ACLineSegment' FROM eq WHERE cls = 'ACLineSegment')
        SELECT mrid, value AS x, -value AS y, CASE WHEN n_regionkey = 4 THEN '' ELSE CAST(4326 + n_nationkey AS VARCHAR) END AS epsg,
          'http://iec.ch/TC57/2013/CIM-schema-cim16#' || kind AS rdf_type
        FROM events JOIN owners ON user_id = loc JOIN customer ON c_custkey = loc JOIN nation ON c_nationkey = n_nationkey""",
    "borders": """
        SELECT eq.eq AS mrid, name, market_code, ca.area AS area_1, cb.area AS area_2, a.tm AS t_mrid_1, b.tm AS t_mrid_2
        FROM eq JOIN ends a ON a.eq = eq.eq AND a.nr = 1 JOIN ends b ON b.eq = eq.eq AND b.nr = 2
        JOIN cn_place ca ON ca.part = a.part JOIN cn_place cb ON cb.part = b.part LEFT JOIN lines ON container = ln
        WHERE cls = 'ACLineSegment' AND enabled AND name NOT LIKE '%HVDC%' AND ca.area <> cb.area""",
    "exchange": """
        SELECT eq.eq AS mrid, name, 'tn-' || a.tn AS node, coalesce(in_service, a.connected AND b.connected) AS status, a.p,
          market_code
        FROM eq JOIN ends_tp a ON a.eq = eq.eq AND a.seq = 1 JOIN ends b ON b.eq = eq.eq AND b.seq = 2
        JOIN cn_place ca ON ca.part = a.part JOIN cn_place cb ON cb.part = b.part LEFT JOIN lines ON container = ln
        WHERE cls = 'ACLineSegment' AND enabled AND name NOT LIKE '%HVDC%' AND ca.area LIKE '%E%' AND cb.area NOT LIKE '%E%'
          AND a.p IS NOT NULL AND a.tn IS NOT NULL""",
    "branch_node_withdraw": """
        SELECT tm AS mrid, 'tn-' || ends_tp.tn AS node, p, q, cn_place.cn AS connectivity_node
        FROM ends_tp JOIN eq USING (o) JOIN cn_place ON cn_place.part = ends_tp.part
        WHERE cls IN ('ACLineSegment', 'SeriesCompensator', 'PowerTransformer') AND enabled AND connected
          AND p IS NOT NULL AND ends_tp.tn IS NOT NULL""",
    "dc_active_flow": """
        WITH f AS (SELECT ends.eq AS mrid, p, CASE WHEN nr = 1 THEN 1 ELSE -1 END AS d FROM ends JOIN eq USING (o)
                   WHERE cls IN ('ACLineSegment', 'SeriesCompensator')
                   UNION ALL SELECT te, p, 1 FROM windings),
        top AS (SELECT mrid, max(p) AS p FROM f GROUP BY mrid)
        SELECT mrid, p * max(d) AS p FROM f JOIN top USING (mrid, p) GROUP BY mrid, p""",
    "powerflow": """
        SELECT tm AS mrid, p, q, coalesce(in_service, true) AS in_service FROM ends JOIN eq USING (o)
        WHERE is_open AND p IS NOT NULL""",
    "sv_injection": "SELECT tn_id AS node, p_inj AS p, q_inj AS q FROM tn WHERE q_inj IS NOT NULL",
    "sv_power_deviation": """
        WITH f AS (SELECT ends_tp.tn, cn, t_name, coalesce(p, CASE WHEN cls = 'VoltageSourceConverter' THEN o_totalprice END) AS p
                   FROM ends_tp JOIN eq USING (o))
        SELECT tn_id AS node, round(sum(p), 4) AS sum_terminal_flow, max(p_inj) AS reported_sv_injection,
          string_agg(DISTINCT cn, ',' ORDER BY cn) AS connectivity_nodes, string_agg(t_name, ',' ORDER BY t_name) AS terminal_names
        FROM f JOIN tn USING (tn) WHERE p IS NOT NULL GROUP BY tn_id""",
    "converters": """
        WITH pole AS (SELECT o_custkey AS pole, max(CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE)) / count(*) AS factor,
                        bool_or(c_mktsegment <> 'BUILDING') AS has_voltage
                      FROM eq JOIN customer ON o_custkey = c_custkey
                      WHERE cls = 'VoltageSourceConverter' AND c_acctbal >= 0 GROUP BY o_custkey)
        SELECT eq.eq AS mrid, name, alias_name AS alias, o_totalprice AS p, -o_totalprice / 10 AS q, ss AS substation_mrid,
          coalesce(in_service, connected) AS status, cn AS connectivity_node, 'dk-' || o_custkey AS controller,
          factor AS controller_factor, CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 1000 ELSE 0 END AS pole_loss,
          CAST(CASE WHEN has_voltage AND o_orderstatus <> 'P' THEN day(o_orderdate) ELSE 0 END AS DOUBLE) AS loss0,
          CAST(CASE WHEN has_voltage AND o_orderstatus <> 'P' THEN month(o_orderdate) ELSE 0 END AS DOUBLE) AS loss1,
          CAST(CASE WHEN has_voltage AND o_orderstatus <> 'P' THEN year(o_orderdate) ELSE 0 END AS DOUBLE) AS loss2,
          CAST(CASE WHEN has_voltage AND o_orderstatus <> 'P' THEN 66 ELSE 0 END AS DOUBLE) AS vdcn, un
        FROM eq JOIN pole ON pole = o_custkey JOIN ends ON ends.eq = eq.eq AND nr = 1 JOIN cn_place USING (part)
        WHERE cls = 'VoltageSourceConverter' AND enabled""",
    "transformers_connected_to_converter": """
        SELECT DISTINCT c.eq AS mrid, t.alias_name AS name, first.tm AS t_mrid, t.eq AS p_mrid
        FROM windings t JOIN ends c ON c.part = t.part JOIN eq ON eq.eq = c.eq
        JOIN windings first ON first.eq = t.eq AND first.nr = 1 JOIN site ON t.container = ss
        WHERE cls = 'VoltageSourceConverter' AND eq.enabled AND t.enabled AND t.alias_name IS NOT NULL""",
    "hvdc": """
        WITH c AS (SELECT supp, ends.eq FROM ends JOIN eq USING (o) WHERE cls = 'VoltageSourceConverter')
        SELECT c1.eq AS converter_mrid_1, c2.eq AS converter_mrid_2, string_agg(name, '--' ORDER BY name) AS name,
          round(sum(CAST(CAST(o_totalprice / 1000 AS FLOAT) AS DOUBLE)), 3) AS r
        FROM eq JOIN ends a ON a.eq = eq.eq AND a.seq = 1 JOIN ends b ON b.eq = eq.eq AND b.seq = 2
        JOIN c c1 ON c1.supp = a.supp JOIN c c2 ON c2.supp = b.supp
        WHERE cls = 'DCLineSegment' GROUP BY c1.eq, c2.eq HAVING count(*) > 1""",
    "hvdc_converter_bidzones": """
        WITH zone AS (SELECT 'mdp-' || s_suppkey AS point, 'BZ-' || s_nationkey AS z FROM supplier)
        SELECT DISTINCT eq AS mrid, a.z AS bidzone_1, b.z AS bidzone_2
        FROM eq JOIN site ON ss = 'ss-' || (o_custkey % (SELECT count(*) FROM supplier))
        JOIN lines ON mdp_from = mdp JOIN zone a ON a.point = mdp JOIN zone b ON b.point = mdp_to
        WHERE cls = 'VoltageSourceConverter' AND a.z <> b.z""",
    "dc_controllers": """
        SELECT 'dk-' || c_custkey AS mrid, 'Corridor ' || c_custkey AS name, abs(c_acctbal) AS max_p, -(abs(c_acctbal) / 2) AS min_p
        FROM customer""",
    "ras_equipment": """
        WITH target AS (SELECT eq, cls FROM eq
                        UNION ALL SELECT eq, 'VsConverter' FROM eq WHERE cls = 'VoltageSourceConverter'
                        UNION ALL SELECT te, 'PowerTransformerEnd' FROM windings
                        UNION ALL SELECT 'dk-' || c_custkey, 'DCController' FROM customer),
        act AS (SELECT *, 'eq-' || user_id AS t FROM events WHERE event_type IN ('error', 'click', 'signup')
                UNION ALL SELECT *, 'dk-' || user_id FROM events WHERE event_type = 'view'
                UNION ALL SELECT *, 'te-' || user_id || '-1' FROM events WHERE event_type IN ('purchase', 'signup'))
        SELECT 'pa-' || event_id AS mrid, eq AS equipment_mrid, event_type || ' ' || event_id AS name,
          cls IN ('ACLineSegment', 'PowerTransformerEnd') AND (value > 40 OR value < 10) AS flip, 'pc-' || user_id AS collection
        FROM act JOIN target ON t = eq WHERE cls <> 'PowerTransformer'""",
    "regions": """
        SELECT 'sg-' || n_nationkey AS mrid, r_name AS region, CASE WHEN n_nationkey >= 10 THEN 'N' || n_nationkey END AS short_name,
          n_name AS name, CASE WHEN n_regionkey = 3 THEN lower(n_name) END AS alias_name,
          CASE WHEN r_name LIKE 'A%' THEN lower(r_name) END AS region_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "station_group_codes_and_names": """
        SELECT sr_code AS station_group, min(sr_name) AS name, arg_min_null(sr_alias, sr_name) AS alias_name
        FROM res WHERE sr_code IS NOT NULL GROUP BY sr_code""",
    "repeated_station_groups": """
        SELECT sr_code AS station_group, sr_name AS name, sr_alias AS alias_name FROM res
        WHERE sr_code IN (SELECT sr_code FROM res GROUP BY sr_code HAVING count(*) > 1)""",
    "station_group_for_power_unit": """
        SELECT 'eq-' || o AS power_system_model_mrid, gu AS market_unit_mrid, gu_name AS resource_name, sr_code AS market_code
        FROM unit JOIN res ON c_custkey = o_custkey WHERE o_orderstatus <> 'P' AND sr_code IS NOT NULL
        UNION ALL
        SELECT eq, 'lg-' || o_custkey, 'LG ' || c_name, sr_code
        FROM eq JOIN res ON res.c_custkey = o_custkey JOIN customer ON customer.c_custkey = o_custkey
        WHERE cls IN ('NonConformLoad', 'EnergyConsumer') AND sr_code IS NOT NULL""",
    "gen_unit_and_sync_machine_mrid": """
        SELECT 'gu-' || o AS gen_unit_mrid, eq AS sync_machine_mrid FROM eq WHERE cls = 'SynchronousMachine' AND o_orderstatus <> 'P'""",
    "market_dates": """
        SELECT 'ms-' || o_custkey AS mrid, 'Market ' || o_custkey AS name, min(o_orderdate) AS activation_date
        FROM orders GROUP BY o_custkey""",
    "full_model": """
        WITH made AS (SELECT doc_id, 'created ' || quality AS created FROM labels),
        dep AS (SELECT DISTINCT doc_id, unnest([doc_id - 1, doc_id // 2]) AS d FROM documents WHERE source <> 'src0'),
        whole AS (SELECT dep.doc_id FROM dep LEFT JOIN made ON made.doc_id = d GROUP BY dep.doc_id HAVING bool_and(created IS NOT NULL))
        SELECT 'md-' || doc_id AS model, 'scenario ' || source AS time, lang AS profile, CAST(n_chars AS VARCHAR) AS version,
          source AS description
        FROM documents JOIN whole USING (doc_id) WHERE lang NOT IN ('de', 'fr', 'es')
        UNION ALL
        SELECT 'md-' || doc_id, created, CASE WHEN lang = 'es' THEN 'http://entsoe.eu/CIM/EquipmentCore/3/1' ELSE lang END,
          CASE WHEN lang = 'fr' THEN '' ELSE CAST(n_chars AS VARCHAR) END, source
        FROM documents JOIN made USING (doc_id)""",
    "type_map": """
        WITH kind AS (SELECT DISTINCT p_type, p_type IN ('ECONOMY', 'SMALL', 'MEDIUM') AS composite FROM part)
        SELECT DISTINCT p_brand AS sparql_type, CASE WHEN composite THEN 'UNIT-' || p_type ELSE p_type END AS range
        FROM part JOIN kind USING (p_type) WHERE p_size <> 1""",
}

BUS_COLUMNS = "node, busname, substation, un, base_voltage_mrid, substation_mrid, bidzone, island, is_swing_bus, connectivity_node, sv_voltage"
REPORT_SQL["bus_data"] = f"""
    WITH buses AS ({REPORT_SQL["topological_nodes"]}), centres AS ({REPORT_SQL["transformer_center_nodes"]})
    SELECT {BUS_COLUMNS.replace("connectivity_node", "CAST(NULL AS VARCHAR) AS connectivity_node")} FROM buses
    UNION ALL SELECT {BUS_COLUMNS} FROM centres"""
