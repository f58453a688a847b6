"""DuckDB SQL for the operational stand-ins and the queries on them."""

from __future__ import annotations

from suturestar.gate.star_sql import CTES, _avg, _hits, _r, _ravg, with_tables
from suturestar.operators.quality import LENGTHS, UNIQUE, required_columns
from suturestar.operators.upsert import OPERATIONAL_LINKS
from suturestar.plans.dims import FACILITY_SEED

# Which rows the model checks see twice or miss.
SEEDED_SQL = {
    "surgical_robots": "(robot_model = 'Model-3')",
    "robot_maintenance_logs": "(maintenance_type = 'emergency')",
    "surgical_procedures": "(status = 'aborted')",
    "procedure_outcomes": "(success_status = 'complicated')",
}

CTES.update(
    {
        "robots": (
            (),
            """
            SELECT 'RBT-' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS robot_id, s_name AS robot_serial_number,
                   'Model-' || (s_suppkey % 7) AS robot_model, 'Maker-' || (s_suppkey % 3) AS manufacturer,
                   DATE '1994-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS installation_date,
                   'FAC-' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS facility_id, n_name AS facility_name,
                   CASE WHEN s_acctbal >= 1000 THEN 'operational' WHEN s_acctbal >= 0 THEN 'maintenance'
                        WHEN s_acctbal >= -500 THEN 'retired' ELSE 'lost' END AS status,
                   CASE WHEN s_acctbal >= 5000 THEN DATE '2000-06-30' END AS last_maintenance_date,
                   0 AS total_procedures,
                   CASE WHEN s_suppkey % 5 <> 0 THEN 'v' || (s_suppkey % 5) END AS firmware_version,
                   TIMESTAMP '2001-08-01 12:00:00' AS created_at, TIMESTAMP '2001-08-01 12:00:00' AS updated_at
            FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
        ),
        "procs": (
            ("fact_base",),
            """
            SELECT 'PROC-' || o_orderkey AS procedure_id,
                   COALESCE('RBT-' || lpad(CAST(robot AS VARCHAR), 9, '0'), 'RBT-NONE') AS robot_id,
                   COALESCE('Type-' || (p_size % 8), 'UNKNOWN') AS procedure_type,
                   o_orderpriority AS procedure_category, start_time, end_time,
                   CAST(minutes AS INTEGER) AS duration_minutes,
                   CASE WHEN o_custkey % 50 <> 0 THEN 'SURG-' || o_custkey END AS surgeon_id,
                   'Dr. ' || (o_custkey % 100) AS surgeon_name, 'PAT-' || o_custkey AS patient_id,
                   p_size * 3 AS patient_age,
                   CASE p_size % 3 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' WHEN 2 THEN 'Other' END AS patient_gender,
                   CAST(10 + (discount * 4) // lines AS BIGINT) AS complexity_tenths,
                   CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'in_progress' ELSE 'aborted' END AS status,
                   TIMESTAMP '2001-08-01 12:00:00' AS created_at
            FROM fact_base""",
        ),
        "outs": (
            ("lines",),
            """
            SELECT 'OUT-' || l_orderkey AS outcome_id, 'PROC-' || l_orderkey AS procedure_id,
                   CASE WHEN high_status = 'F' THEN 'successful' WHEN low_flag = 'R' THEN 'failed'
                        ELSE 'complicated' END AS success_status,
                   CAST(tax * 10 AS INTEGER) AS blood_loss_ml,
                   CASE WHEN high_status = 'F' THEN 'none' WHEN low_flag = 'R' THEN 'bleeding, infection, fever'
                        WHEN high_flag = 'R' AND any_n THEN 'bleeding, infection'
                        WHEN high_flag = 'R' OR any_n THEN 'bleeding' END AS complications,
                   CAST(lines AS INTEGER) AS hospital_stay_days, high_tax >= 8 AS readmission_30day,
                   CAST(high_line + 2 AS INTEGER) AS patient_satisfaction_score,
                   CAST(minutes % 120 AS INTEGER) AS recovery_score, high_flag = 'R' AS follow_up_required
            FROM (SELECT l.*, n.any_n FROM lines l JOIN
                  (SELECT l_orderkey, BOOL_OR(l_returnflag = 'N') AS any_n FROM lineitem GROUP BY 1) n
                  USING (l_orderkey))""",
        ),
        "maint": (
            (),
            """
            SELECT 'MNT-' || event_id AS maintenance_id,
                   'RBT-' || lpad(CAST(user_id * 2 AS VARCHAR), 9, '0') AS robot_id, CAST(ts AS DATE) AS maintenance_date,
                   CASE event_type WHEN 'error' THEN 'emergency' WHEN 'view' THEN 'routine' WHEN 'click' THEN 'calibration'
                        WHEN 'purchase' THEN 'upgrade' ELSE event_type END AS maintenance_type,
                   CASE WHEN k >= 50 THEN 'inspected; cleaned' ELSE 'inspected' END AS actions_taken,
                   k AS downtime_tenths, CASE WHEN k <> 7 THEN CAST(ROUND(value * 100) AS BIGINT) END AS cost_cents,
                   'TECH-' || (event_id % 9) AS technician_id, 'Technician ' || (event_id % 9) AS technician_name,
                   TIMESTAMP '2001-08-01 12:00:00' AS created_at
            FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
        ),
        # The level derived from an outcome's text, and the status as the warehouse spells it.
        "outs_normal": (
            ("outs",),
            """
            SELECT * REPLACE (upper(success_status[1]) || success_status[2:] AS success_status),
                   CASE WHEN complications IS NULL THEN NULL WHEN complications = 'none' THEN 'None'
                        WHEN success_status = 'failed' THEN 'Severe' WHEN complications LIKE '%,%' THEN 'Moderate'
                        ELSE 'Minor' END AS complication_level
            FROM outs""",
        ),
        "stage": (
            ("procs", "robots", "outs_normal"),
            """
            SELECT p.procedure_id, p.robot_id, p.surgeon_id, r.facility_id,
                   CAST(strftime(p.start_time, '%Y%m%d') AS INTEGER) AS start_date_key,
                   CAST(hour(p.start_time) * 10000 + minute(p.start_time) * 100 AS INTEGER) AS start_time_key,
                   CAST(strftime(p.end_time, '%Y%m%d') AS INTEGER) AS end_date_key,
                   CAST(hour(p.end_time) * 10000 + minute(p.end_time) * 100 AS INTEGER) AS end_time_key,
                   p.procedure_type, p.procedure_category, p.patient_id, CAST(p.patient_age AS SMALLINT) AS patient_age,
                   p.patient_gender, p.duration_minutes, CAST(p.complexity_tenths AS DOUBLE) / 10 AS complexity_score,
                   o.success_status, o.blood_loss_ml, o.complication_level, o.hospital_stay_days,
                   CAST(o.patient_satisfaction_score AS DOUBLE) AS patient_satisfaction_score, o.readmission_30day,
                   p.status, p.start_time
            FROM procs p LEFT JOIN robots r ON p.robot_id = r.robot_id
            LEFT JOIN outs_normal o ON p.procedure_id = o.procedure_id""",
        ),
        "surgeons": (
            ("procs",),
            """
            SELECT surgeon_id, surgeon_name, 'General Surgery' AS specialization,
                   CAST(date_part('year', age(TIMESTAMP '2001-08-01', CAST(CAST(MIN(start_time) AS DATE) AS TIMESTAMP)))
                        AS INTEGER) AS years_experience,
                   'Board Certified' AS certification_level, CAST(MIN(start_time) AS DATE) AS effective_date
            FROM procs WHERE surgeon_id IS NOT NULL GROUP BY surgeon_id, surgeon_name""",
        ),
        "seed": (
            (),
            f"""
            SELECT * FROM (VALUES {', '.join(str((s[0], *s[2:])) for s in FACILITY_SEED)})
                v(facility_id, city, state, country, facility_type, bed_count)""",
        ),
        # Telemetry documents: the wall clock survives, the offset is dropped, every 50th has no time.
        "docs": (
            (),
            """
            SELECT event_id, 'PROC-' || user_id AS procedure_id, k, ts, event_type,
                   CAST(ROUND(value * 100) AS BIGINT) AS cents, event_id % 50 = 49 AS unreadable
            FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
        ),
        "samples": (
            ("docs",),
            """
            SELECT event_id, procedure_id, ts AS sample_timestamp,
                   CAST(hour(ts) * 10000 + minute(ts) * 100 AS INTEGER) AS timestamp_key,
                   CAST(cents AS DOUBLE) / 100 AS arm_position_x,
                   CASE WHEN event_id % 2 = 0 THEN 1.5::DOUBLE END AS arm_position_y,
                   event_type AS tool_type, k >= 50 AS tool_active, CAST(cents AS DOUBLE) / 100 AS system_temperature,
                   CAST(k + 10 AS INTEGER) AS network_latency_ms, CAST(70 - k // 2 AS INTEGER) AS video_fps
            FROM docs WHERE NOT unreadable""",
        ),
        "fleet": (
            (),
            """
            SELECT s_suppkey, 'RBT-' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS robot_id,
                   CASE WHEN s_suppkey % 5 <> 0 THEN 'v' || (s_suppkey % 5) END AS software_version,
                   CASE WHEN s_acctbal >= 1000 THEN 'operational' ELSE 'maintenance' END AS status, s_acctbal
            FROM supplier""",
        ),
        # Both states of the fleet side by side.
        "fleet_pair": (
            ("fleet",),
            """
            SELECT *, s_acctbal < 9000 AS in_first, s_acctbal >= -500 AS in_second,
                   CASE WHEN s_acctbal BETWEEN 2000 AND 4000 THEN 'upgraded' ELSE status END AS status2,
                   CASE WHEN s_acctbal BETWEEN 3500 AND 5000 THEN NULL ELSE software_version END AS software2
            FROM fleet""",
        ),
        "fleet_versions": (
            ("fleet_pair",),
            """
            SELECT s_suppkey, robot_id, status, software_version, DATE '1994-01-01' AS effective_date,
                   CASE WHEN gone THEN DATE '1999-12-31' END AS expiration_date, NOT gone AS is_current, 0 AS n,
                   CASE WHEN in_second AND NOT gone THEN 99 ELSE 0 END AS total_procedures_count
            FROM (SELECT *, in_second AND (status <> status2 OR software_version IS DISTINCT FROM software2) AS gone
                  FROM fleet_pair WHERE in_first)
            UNION ALL
            SELECT s_suppkey, robot_id, status2, software2,
                   CASE WHEN in_first THEN DATE '2000-01-01' ELSE DATE '1994-01-01' END, NULL, TRUE, 99, 99
            FROM fleet_pair
            WHERE in_second AND (NOT in_first OR status <> status2 OR software_version IS DISTINCT FROM software2)""",
        ),
    }
)


def _page(what: str, where: str, order: str, limit: int, offset: int = 0) -> str:
    return f"SELECT {what} WHERE {where} ORDER BY {order} LIMIT {limit} OFFSET {offset}"


PROC_COLUMNS = (
    "procedure_id, robot_id, procedure_type, procedure_category, start_time, end_time, duration_minutes, surgeon_id, "
    "surgeon_name, patient_id, patient_age, patient_gender, CAST(complexity_tenths AS DOUBLE) / 10 AS complexity_score, "
    "status, created_at"
)
OUT_COLUMNS = (
    "o.outcome_id, o.procedure_id, o.success_status, o.blood_loss_ml, o.complications, o.hospital_stay_days, "
    "o.readmission_30day, o.patient_satisfaction_score, o.recovery_score, o.follow_up_required"
)
STAGE_COLUMNS = (
    "procedure_id, robot_id, surgeon_id, facility_id, start_date_key, start_time_key, end_date_key, end_time_key, "
    "procedure_type, procedure_category, patient_id, patient_age, patient_gender, duration_minutes, complexity_score, "
    "success_status, blood_loss_ml, complication_level, hospital_stay_days, patient_satisfaction_score, "
    "readmission_30day, status"
)
PROFILE = (
    f"{_avg('blood_loss_ml')} AS avg_blood_loss, {_avg('hospital_stay_days')} AS {{stay}}, "
    f"{_avg('patient_satisfaction_score')} AS avg_satisfaction"
)


def lookup_sql() -> dict[str, str]:
    out = {}
    out["op_robot_utilization"] = with_tables(
        f"""SELECT r.robot_id, r.robot_serial_number, r.robot_model, r.facility_name, r.status,
            COUNT(p.procedure_id) AS procedure_count, {_avg("p.duration_minutes")} AS avg_procedure_duration,
            MAX(p.start_time) AS last_procedure_date
        FROM robots r LEFT JOIN procs p ON r.robot_id = p.robot_id GROUP BY 1, 2, 3, 4, 5""",
        "robots", "procs",
    )
    out["op_procedure_outcomes_summary"] = with_tables(
        """SELECT p.procedure_id, p.procedure_type, p.procedure_category, p.start_time, p.duration_minutes,
            CAST(p.complexity_tenths AS DOUBLE) / 10 AS complexity_score, r.robot_model, r.facility_name,
            o.success_status, o.blood_loss_ml, o.hospital_stay_days, o.patient_satisfaction_score
        FROM procs p JOIN robots r ON p.robot_id = r.robot_id LEFT JOIN outs o ON p.procedure_id = o.procedure_id
        WHERE p.status = 'completed'""",
        "procs", "robots", "outs",
    )
    out["op_maintenance_costs"] = with_tables(
        """SELECT r.robot_id, r.robot_serial_number, r.robot_model, r.facility_name,
            COUNT(m.maintenance_id) AS maintenance_count, CAST(SUM(cost_cents) AS DOUBLE) / 100 AS total_cost,
            (CAST(SUM(cost_cents) AS DOUBLE) / 100) / NULLIF(COUNT(cost_cents), 0) AS avg_cost,
            CAST(SUM(downtime_tenths) AS DOUBLE) / 10 AS total_downtime_hours
        FROM robots r LEFT JOIN maint m ON r.robot_id = m.robot_id GROUP BY 1, 2, 3, 4""",
        "robots", "maint",
    )
    out["a1_robots"] = with_tables(
        "SELECT * FROM robots WHERE facility_id = 'FAC-003' AND status = 'operational'", "robots"
    )
    out["a2_robot_detail"] = with_tables(
        """SELECT r.*, (SELECT COUNT(*) FROM procs p WHERE p.robot_id = r.robot_id) AS procedure_count
        FROM robots r WHERE r.robot_id = 'RBT-000000003'""",
        "robots", "procs",
    )
    out["a3_procedures"] = with_tables(
        _page(
            f"{PROC_COLUMNS} FROM procs",
            "procedure_category = '1-URGENT' AND status = 'completed'",
            "start_time DESC, procedure_id", 50, 20,
        ),
        "procs",
    )
    out["a3_procedures_next"] = out["a3_procedures"]
    out["a4_procedure_detail"] = with_tables(
        """SELECT p.procedure_id, p.start_time, r.robot_model, r.facility_name, o.outcome_id, o.success_status
        FROM procs p JOIN robots r ON p.robot_id = r.robot_id LEFT JOIN outs o ON p.procedure_id = o.procedure_id
        WHERE p.procedure_id = 'PROC-7'""",
        "procs", "robots", "outs",
    )
    out["a5_outcomes"] = with_tables(
        _page(
            f"{OUT_COLUMNS}, p.procedure_type, p.start_time FROM outs o JOIN procs p ON o.procedure_id = p.procedure_id",
            "o.success_status = 'successful'", "p.start_time DESC, o.procedure_id", 100,
        ),
        "outs", "procs",
    )
    out["a6_utilization"] = out["op_robot_utilization"]
    out["a7_outcome_summary"] = with_tables(
        f"""SELECT success_status, COUNT(*) AS count, {PROFILE.format(stay="avg_stay_days")}
        FROM outs GROUP BY 1""",
        "outs",
    )
    category = (
        f"COUNT(*) AS {{n}}, {_avg('duration_minutes')} AS avg_duration, {_avg('complexity_tenths', 10)} AS avg_complexity"
    )
    out["a8_category_stats"] = with_tables(
        f"""SELECT procedure_category, {category.format(n="count")} FROM procs
        WHERE start_time >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL '30 days' GROUP BY 1""",
        "procs",
    )
    out["a9_ingest_stats"] = with_tables(
        """SELECT COUNT(*) AS total_procedures, COUNT(DISTINCT robot_id) AS unique_robots,
            MAX(start_time) AS latest_procedure FROM procs""",
        "procs",
    )
    out["c1_table_counts"] = with_tables(
        """SELECT 'surgical_robots' AS table_name, COUNT(*) AS row_count FROM robots
        UNION ALL SELECT 'robot_maintenance_logs', COUNT(*) FROM maint
        UNION ALL SELECT 'surgical_procedures', COUNT(*) FROM procs
        UNION ALL SELECT 'procedure_outcomes', COUNT(*) FROM outs""",
        "robots", "maint", "procs", "outs",
    )
    out["c2_models"] = with_tables(
        """SELECT r.robot_model, COUNT(DISTINCT r.robot_id) AS robot_count, COUNT(p.procedure_id) AS total_procedures
        FROM robots r LEFT JOIN procs p ON r.robot_id = p.robot_id GROUP BY 1""",
        "robots", "procs",
    )
    out["c3_categories"] = with_tables(
        f"""SELECT procedure_category, {category.format(n="procedure_count")} FROM procs
        WHERE status = 'completed' GROUP BY 1""",
        "procs",
    )
    out["c4_outcomes"] = with_tables(
        f"""SELECT success_status, COUNT(*) AS outcome_count, {PROFILE.format(stay="avg_stay")} FROM outs GROUP BY 1""",
        "outs",
    )
    return out


def quality_sql() -> dict[str, str]:
    out = {}
    out["val_checks"] = with_tables(
        """SELECT procedure_id AS id, 'patient_age' AS rule FROM procs WHERE NOT patient_age BETWEEN 0 AND 120
        UNION ALL SELECT outcome_id, 'recovery_score' FROM outs WHERE NOT recovery_score BETWEEN 1 AND 100
        UNION ALL SELECT robot_id, 'status' FROM robots WHERE status = 'lost'
        UNION ALL SELECT maintenance_id, 'maintenance_type' FROM maint WHERE maintenance_type = 'signup'""",
        "procs", "outs", "robots", "maint",
    )
    out["val_not_null"] = with_tables(
        """SELECT procedure_id, 'surgeon_id is null' AS rule FROM procs WHERE surgeon_id IS NULL
        UNION ALL SELECT procedure_id, 'end_time is null' FROM procs WHERE end_time IS NULL
        UNION ALL SELECT procedure_id, 'duration_minutes is null' FROM procs WHERE duration_minutes IS NULL
        UNION ALL SELECT procedure_id, 'patient_age is null' FROM procs WHERE patient_age IS NULL""",
        "procs",
    )
    ctes = {"surgical_robots": "robots", "robot_maintenance_logs": "maint", "surgical_procedures": "procs", "procedure_outcomes": "outs"}
    stamped = "(SELECT *, TIMESTAMP '2001-08-01 12:00:00' AS created_at, TIMESTAMP '2001-08-01 12:00:00' AS updated_at FROM outs)"
    nulls, longs = [], []
    for table, seed in SEEDED_SQL.items():
        head = f"SELECT '{table}' AS table_name, "
        for c in required_columns(table):
            nulls.append(f"{head}'{c} is null' AS rule, COUNT(*) FILTER (WHERE {seed} OR {c} IS NULL) AS violations FROM {stamped if ctes[table] == 'outs' else ctes[table]}")
        for c, n in LENGTHS[table].items():
            bad = f"({seed} AND {c} IS NOT NULL) OR LENGTH({c}) > {n}"
            longs.append(f"{head}'{c} longer than {n}' AS rule, COUNT(*) FILTER (WHERE {bad}) AS violations FROM {ctes[table]}")
    out["val_not_null_model"] = with_tables(" UNION ALL ".join(nulls), *ctes.values())
    out["val_lengths"] = with_tables(" UNION ALL ".join(longs), *ctes.values())
    out["val_unique"] = (
        "SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1"
    )
    out["val_foreign_keys"] = with_tables(
        """SELECT 'procedure' AS child, procedure_id AS id, robot_id FROM procs
        WHERE robot_id NOT IN (SELECT robot_id FROM robots)
        UNION ALL SELECT 'maintenance', maintenance_id, robot_id FROM maint
        WHERE robot_id NOT IN (SELECT robot_id FROM robots)""",
        "procs", "maint", "robots",
    )
    names = {"surgical_robots": "robots", "robot_maintenance_logs": "maint", "surgical_procedures": "procs", "procedure_outcomes": "outs"}
    out["val_unique_model"] = with_tables(
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, '{key}' AS key, {key} AS value, COUNT(*) AS copies FROM (SELECT {key} FROM {names[table]}"
            f" UNION ALL SELECT {key} FROM {names[table]} WHERE {SEEDED_SQL[table]}) GROUP BY {key} HAVING COUNT(*) > 1"
            for table, keys in UNIQUE.items()
            for (key,) in keys
        ),
        *names.values(),
    )
    out["val_foreign_keys_model"] = with_tables(
        " UNION ALL ".join(
            f"SELECT '{child}' AS child, '{key}' AS key, {key} AS value, COUNT(*) AS rows FROM {names[child]} WHERE {key} IS NOT NULL"
            f" AND {key} NOT IN (SELECT {key} FROM {names[parent]} WHERE {SEEDED_SQL[parent]} IS NOT TRUE) GROUP BY {key}"
            for parent, child, key in OPERATIONAL_LINKS
        ),
        *names.values(),
    )
    out["val_required_fields"] = with_tables(
        """SELECT CASE WHEN k = 13 THEN 'Missing required field: robot_id' ELSE 'accepted' END AS outcome,
            COUNT(*) AS records FROM docs GROUP BY 1""",
        "docs",
    )
    out["val_versions"] = with_tables(
        "SELECT robot_id, COUNT(*) AS versions FROM fleet_versions GROUP BY 1", "fleet_versions"
    )
    return out


def etl_sql() -> dict[str, str]:
    out = {}
    out["etl_extract_surgeons"] = with_tables("SELECT * FROM surgeons", "surgeons")
    hours = _r("COALESCE(SUM(p.duration_minutes), 0)", "60")
    out["etl_extract_robots"] = with_tables(
        f"""SELECT r.robot_id, r.robot_serial_number, r.robot_model, r.manufacturer, r.facility_id,
            r.installation_date AS install_date, r.firmware_version AS software_version,
            CAST(NULL AS VARCHAR) AS hardware_revision, r.status, r.last_maintenance_date,
            COUNT(p.procedure_id) AS total_procedures_count, {hours} AS total_operating_hours,
            r.installation_date AS effective_date
        FROM robots r LEFT JOIN procs p ON r.robot_id = p.robot_id
        GROUP BY 1, 2, 3, 4, 5, 6, 7, 9, 10, 13""",
        "robots", "procs",
    )
    out["etl_extract_facilities"] = with_tables(
        """SELECT r.facility_id, MAX(r.facility_name) AS facility_name, s.city, s.state, s.country, s.facility_type,
            s.bed_count, MIN(r.installation_date) AS effective_date
        FROM robots r LEFT JOIN seed s ON r.facility_id = s.facility_id GROUP BY 1, 3, 4, 5, 6, 7""",
        "robots", "seed",
    )
    out["etl_extract_procedures"] = with_tables(
        f"""SELECT {STAGE_COLUMNS} FROM stage
        WHERE start_time >= TIMESTAMP '1998-01-01' AND start_time < TIMESTAMP '1999-01-01'""",
        "stage",
    )
    out["etl_normalise_outcomes"] = with_tables(
        "SELECT outcome_id, success_status, complications, complication_level FROM outs_normal", "outs_normal"
    )
    keyed = """
        SELECT s.procedure_id, COALESCE(r.robot_key, -1) AS robot_key, COALESCE(g.surgeon_key, -1) AS surgeon_key,
               COALESCE(f.facility_key, -1) AS facility_key
        FROM (SELECT p.procedure_id, p.robot_id, p.surgeon_id, b.facility_id
              FROM procs p LEFT JOIN robots b ON p.robot_id = b.robot_id) s
        LEFT JOIN (SELECT * FROM dim_robots WHERE is_current) r ON s.robot_id = r.robot_id
        LEFT JOIN (SELECT surgeon_key, 'SURG-' || surgeon_key AS surgeon_id FROM dim_surgeons WHERE is_current) g
          ON s.surgeon_id = g.surgeon_id
        LEFT JOIN (SELECT * FROM dim_facilities WHERE is_current) f ON s.facility_id = f.facility_id"""
    needs = ("procs", "robots", "dim_robots", "dim_surgeons", "dim_facilities")
    out["etl_resolve_keys"] = with_tables("SELECT * FROM keyed", *needs, extra={"keyed": keyed})
    out["etl_rejects"] = with_tables(
        """SELECT CONCAT_WS(',', CASE WHEN robot_key < 0 THEN 'robot' END, CASE WHEN surgeon_key < 0 THEN 'surgeon' END,
            CASE WHEN facility_key < 0 THEN 'facility' END) AS members, COUNT(*) AS procedures
        FROM keyed WHERE robot_key < 0 OR surgeon_key < 0 OR facility_key < 0 GROUP BY 1""",
        *needs, extra={"keyed": keyed},
    )
    out["etl_only_new"] = (
        "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN "
        "(SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"
    )
    sample_columns = (
        "procedure_id, sample_timestamp, timestamp_key, arm_position_x, arm_position_y, tool_type, tool_active, "
        "system_temperature, network_latency_ms, video_fps"
    )
    out["etl_flatten_telemetry"] = with_tables(f"SELECT {sample_columns} FROM samples", "samples")
    out["etl_telemetry_rejects"] = with_tables(
        "SELECT 'unreadable timestamp' AS reason, COUNT(*) AS records FROM docs WHERE unreadable", "docs"
    )
    loaded = """
        SELECT s.*, p.procedure_key FROM samples s JOIN fact_procedures p ON s.procedure_id = p.procedure_id
        WHERE p.status = 'completed'"""
    out["etl_load_telemetry"] = with_tables(
        """SELECT procedure_key, sample_timestamp, timestamp_key, tool_type, tool_active, system_temperature,
            network_latency_ms, video_fps FROM loaded
        WHERE NOT EXISTS (SELECT 1 FROM fact_procedure_telemetry t WHERE t.tool_type = 'error'
                          AND t.procedure_key = loaded.procedure_key AND t.sample_timestamp = loaded.sample_timestamp)""",
        "samples", "fact_procedures", "fact_procedure_telemetry", extra={"loaded": loaded},
    )
    out["etl_telemetry_orphans"] = with_tables(
        """SELECT procedure_id, COUNT(*) AS samples FROM samples
        WHERE procedure_id NOT IN (SELECT procedure_id FROM fact_procedures WHERE status = 'completed') GROUP BY 1""",
        "samples", "fact_procedures",
    )
    version = "robot_id, status, software_version, effective_date, expiration_date, is_current"
    out["scd_changed"] = with_tables(
        f"SELECT {version}, total_procedures_count FROM fleet_versions", "fleet_versions"
    )
    out["scd_reference"] = with_tables(
        """SELECT robot_id, status, DATE '1994-01-01' AS effective_date,
            CASE WHEN in_second THEN DATE '1999-12-31' END AS expiration_date, NOT in_second AS is_current
        FROM fleet_pair WHERE in_first
        UNION ALL SELECT robot_id, status2, CASE WHEN in_first THEN DATE '2000-01-01' ELSE DATE '1994-01-01' END, NULL, TRUE
        FROM fleet_pair WHERE in_second""",
        "fleet_pair",
    )
    out["scd_parent_key"] = with_tables(
        """SELECT r.robot_id, r.facility_id, f.facility_key FROM robots r
        LEFT JOIN dim_facilities f ON r.facility_id = f.facility_id AND f.is_current""",
        "robots", "dim_facilities",
    )
    out["scd_keys"] = with_tables(
        """SELECT COUNT(*) AS versions, 1 AS first_key, COUNT(*) AS last_key, COUNT(*) AS distinct_keys
        FROM fleet_versions""",
        "fleet_versions",
    )
    out["scd_version_as_of"] = with_tables(
        """SELECT v.robot_id, v.status, COUNT(*) AS procedures
        FROM procs p JOIN fleet_versions v ON p.robot_id = v.robot_id AND v.effective_date <= CAST(p.start_time AS DATE)
          AND (v.expiration_date IS NULL OR CAST(p.start_time AS DATE) <= v.expiration_date)
        GROUP BY 1, 2""",
        "procs", "fleet_versions",
    )
    out["key_dense"] = (
        "SELECT COUNT(*) AS n, 101 AS first_key, 100 + COUNT(*) AS last_key, COUNT(*) AS distinct_keys, "
        "CAST(SUM(o_orderkey) AS BIGINT) AS order_sum FROM orders"
    )
    # Lines are updates of the procedure of the same number: the last line by (date, number, ...) wins.
    out["ups_procedures"] = """
        WITH base AS (SELECT o_orderkey AS id, o_orderstatus AS status, CAST(o_totalprice AS DOUBLE) AS amount,
                             o_orderpriority AS category FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
        seq AS (SELECT l_orderkey AS id, l_linestatus AS status, l_extendedprice AS amount, l_returnflag AS category,
                       ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_returnflag, l_linestatus,
                                          l_extendedprice) AS up,
                       ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linestatus DESC,
                                          l_extendedprice DESC) AS down
                FROM lineitem),
        folded AS (SELECT f.id, l.status, l.amount, f.category
                   FROM (SELECT * FROM seq WHERE up = 1) f JOIN (SELECT * FROM seq WHERE down = 1) l USING (id))
        SELECT COALESCE(b.id, f.id) AS id, COALESCE(f.status, b.status) AS status,
               COALESCE(f.amount, b.amount) AS amount, COALESCE(b.category, f.category) AS category,
               CASE WHEN f.id IS NOT NULL THEN TIMESTAMP '2001-08-01 12:00:00' END AS updated_at
        FROM base b FULL JOIN folded f ON b.id = f.id"""
    out["del_cascade"] = with_tables(
        """SELECT 'surgical_robots' AS table_name, COUNT(*) AS row_count FROM robots WHERE robot_model <> 'Model-3'
        UNION ALL SELECT 'surgical_procedures', COUNT(*) FROM keep
        UNION ALL SELECT 'procedure_outcomes', COUNT(*) FROM outs WHERE procedure_id NOT IN
          (SELECT procedure_id FROM procs WHERE robot_id IN (SELECT robot_id FROM robots WHERE robot_model = 'Model-3'))
        UNION ALL SELECT 'robot_maintenance_logs', COUNT(*) FROM maint
          WHERE robot_id NOT IN (SELECT robot_id FROM robots WHERE robot_model = 'Model-3')""",
        "robots", "procs", "outs", "maint",
        extra={
            "keep": "SELECT * FROM procs WHERE robot_id NOT IN (SELECT robot_id FROM robots WHERE robot_model = 'Model-3')"
        },
    )
    return out


def function_sql() -> dict[str, str]:
    out = {}
    out["dim_date_attributes"] = with_tables(
        """SELECT * FROM dim_date WHERE date IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)""", "dim_date"
    )
    out["dim_time_usage"] = with_tables(
        """SELECT d.*, COUNT(*) AS samples FROM dim_time d JOIN fact_procedure_telemetry t ON d.time_key = t.timestamp_key
        GROUP BY ALL""",
        "dim_time", "fact_procedure_telemetry",
    )
    out["fn_calendar"] = """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day_key, monthname(o_orderdate) AS month_name,
               dayname(o_orderdate) AS day_name, week(o_orderdate) AS iso_week, dayofweek(o_orderdate) AS dow,
               date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS age_days,
               CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH AS DATE) AS next_year,
               CAST(o_orderdate AS DATE) - 1 AS day_before,
               CAST(date_part('year', age(TIMESTAMP '2001-08-01', o_orderdate)) AS INTEGER) AS full_years
        FROM orders"""
    out["fn_wall_clock"] = with_tables(
        "SELECT event_id, sample_timestamp, timestamp_key FROM samples", "samples"
    )
    out["fn_list_items"] = with_tables(
        """SELECT item, COUNT(*) AS n FROM (
            SELECT trim(unnest(string_split(complications, ','))) AS item FROM outs WHERE complications IS NOT NULL
            UNION ALL SELECT trim(unnest(string_split(actions_taken, ';'))) FROM maint) GROUP BY 1""",
        "outs", "maint",
    )
    return out


def storage_sql() -> dict[str, str]:
    out = {}
    out["src_csv_table"] = with_tables(f"SELECT {PROC_COLUMNS} FROM procs", "procs")
    out["src_operational_parquet"] = out["src_operational_csv"] = with_tables(
        """SELECT procedure_id, start_time, robot_model, installation_date, firmware_version, success_status, follow_up_required
        FROM procs JOIN robots USING (robot_id) LEFT JOIN outs USING (procedure_id)""",
        "procs", "robots", "outs",
    )
    out["snk_staged_csv"] = with_tables(f"SELECT {STAGE_COLUMNS} FROM stage", "stage")
    out["src_telemetry_json"] = with_tables(
        "SELECT procedure_id, event_type AS tool_type, COUNT(*) AS documents FROM docs GROUP BY 1, 2", "docs"
    )
    # What the documents lack is NULL in the stage.
    lacking = ["arm_position_z", "arm_rotation_x", "arm_rotation_y", "arm_rotation_z", "force_feedback", "camera_zoom", "motor_current"]
    staged = f"""SELECT procedure_id, timestamp_key, sample_timestamp, arm_position_x, arm_position_y, tool_type, tool_active,
            system_temperature, network_latency_ms, video_fps, CAST(NULL AS INTEGER) AS lighting_level,
            {", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in lacking)} FROM samples"""
    out["snk_telemetry_stage"] = with_tables(staged, "samples")
    out["etl_raw_flatten"] = with_tables(f"{staged} WHERE event_id % 40 <> 7", "samples")
    out["src_raw_variant"] = with_tables(
        """SELECT 'landed' AS outcome, procedure_id, CASE WHEN unreadable THEN NULL ELSE CAST(ts AS DATE) END AS sample_date,
            COUNT(*) AS records, CAST(SUM(event_id) AS BIGINT) AS event_ids
        FROM docs WHERE event_id % 40 <> 7 GROUP BY 2, 3
        UNION ALL
        SELECT 'malformed document', NULL, NULL, COUNT(*), NULL FROM docs WHERE event_id % 40 = 7""",
        "docs",
    )
    out["snk_fact_append"] = with_tables(
        """SELECT CAST(start_date_key // 100 AS INTEGER) AS start_month, COUNT(*) AS procedures,
            CAST(SUM(duration_minutes) AS BIGINT) AS minutes FROM fact_procedures GROUP BY 1""",
        "fact_procedures",
    )
    out["snk_land_batch"] = """
        SELECT CASE WHEN event_type = 'error' THEN 'telemetry' ELSE event_type END AS type, COUNT(*) AS records
        FROM events GROUP BY 1"""
    out["snk_land_stream"] = with_tables(
        """SELECT CASE WHEN unreadable THEN NULL ELSE CAST(ts AS DATE) END AS sample_date, COUNT(*) AS records
        FROM docs WHERE k <> 13 GROUP BY 1""",
        "docs",
    )
    out["snk_envelope"] = with_tables(
        """SELECT COUNT(*) AS count, 25 AS "limit", 5 AS "offset", MIN_BY(procedure_id, n) AS first_id,
            MAX_BY(procedure_id, n) AS last_id
        FROM (SELECT procedure_id, ROW_NUMBER() OVER (ORDER BY start_time DESC, procedure_id) AS n
              FROM procs WHERE status = 'completed' QUALIFY n BETWEEN 6 AND 30)""",
        "procs",
    )
    loaded = """
        SELECT s.*, p.robot_id FROM samples s JOIN procs p ON s.procedure_id = p.procedure_id"""
    out["str_telemetry_intake"] = with_tables(
        """SELECT procedure_id, COUNT(*) AS samples, CAST(SUM(network_latency_ms) AS BIGINT) AS latency,
            MIN(sample_timestamp) AS first_sample, MAX(sample_timestamp) AS last_sample FROM loaded GROUP BY 1""",
        "samples", "procs", extra={"loaded": loaded},
    )
    # What the load wrote: every robot has one version, and documents carry no motor current.
    met = """docs s JOIN procs p ON s.procedure_id = p.procedure_id JOIN robots r ON p.robot_id = r.robot_id
        WHERE NOT unreadable"""
    out["star_v11"] = with_tables(
        f"""SELECT p.procedure_id, r.robot_model, r.facility_name, CAST(p.start_time AS DATE) AS date,
            COUNT(*) AS telemetry_sample_count, {_avg("cents", 100)} AS avg_temperature,
            CAST(MAX(cents) AS DOUBLE) / 100 AS max_temperature, CAST(NULL AS DOUBLE) AS avg_motor_current,
            CAST(NULL AS DOUBLE) AS max_motor_current, {_avg("(k + 10)")} AS avg_network_latency,
            CAST(MAX(k + 10) AS INTEGER) AS max_network_latency, {_avg("(70 - k // 2)")} AS avg_video_fps,
            CAST(MIN(70 - k // 2) AS INTEGER) AS min_video_fps
        FROM {met} GROUP BY 1, 2, 3, 4""",
        "docs", "procs", "robots",
    )
    out["star_q11"] = with_tables(
        f"""SELECT r.robot_id, r.robot_model, COUNT(DISTINCT p.procedure_id) AS procedure_count,
            {_ravg("cents", 100)} AS avg_temperature, CAST(MAX(cents) AS DOUBLE) / 100 AS max_temperature,
            CAST(NULL AS DOUBLE) AS avg_motor_current, {_ravg("(k + 10)")} AS avg_network_latency,
            {_ravg("(70 - k // 2)")} AS avg_video_fps,
            {_hits("cents > 7500 OR k + 10 > 100 OR 70 - k // 2 < 25")} AS warning_count
        FROM {met} GROUP BY 1, 2 HAVING COUNT(DISTINCT p.procedure_id) >= 5""",
        "docs", "procs", "robots",
    )
    out["str_deduplicated"] = with_tables(
        "SELECT procedure_id, COUNT(DISTINCT sample_timestamp) AS samples FROM samples GROUP BY 1", "samples"
    )
    out["str_valid_split"] = with_tables(
        """SELECT CASE WHEN k = 13 THEN 'rejected' ELSE 'telemetry' END AS side, COUNT(*) AS records
        FROM docs GROUP BY 1""",
        "docs",
    )
    out["str_procedure_upsert"] = """
        WITH seq AS (SELECT l_orderkey AS id, l_linestatus AS status, CAST(l_quantity AS INTEGER) AS minutes,
                            l_returnflag AS category, l_shipdate AS at,
                            ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_returnflag, l_linestatus,
                                               l_quantity) AS up,
                            ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linestatus DESC,
                                               l_quantity DESC) AS down
                     FROM lineitem)
        SELECT 'PROC-' || f.id AS procedure_id, l.status, l.minutes AS duration_minutes, f.category AS procedure_category
        FROM (SELECT * FROM seq WHERE up = 1) f JOIN (SELECT * FROM seq WHERE down = 1) l USING (id)"""
    out["full_load_report"] = with_tables(
        """SELECT 'facilities' AS stage, 'SUCCESS' AS status, COUNT(DISTINCT facility_id) AS inserted, 0 AS closed, 0 AS rejected FROM robots
        UNION ALL SELECT 'surgeons', 'SUCCESS', COUNT(DISTINCT surgeon_id), 0, 0 FROM procs
        UNION ALL SELECT 'robots', 'SUCCESS', COUNT(*), 0, 0 FROM robots
        UNION ALL SELECT 'procedures', 'SUCCESS', COUNT(*), 0,
            COUNT(*) FILTER (WHERE surgeon_id IS NULL OR robot_id = 'RBT-NONE') FROM procs
        UNION ALL SELECT 'telemetry', 'SUCCESS', COUNT(*), 0, (SELECT COUNT(*) FROM docs WHERE unreadable) FROM samples
        UNION ALL SELECT 'repeated', 'SUCCESS', 0, 0,
            (SELECT COUNT(*) FROM docs WHERE unreadable)""",
        "procs", "robots", "samples", "docs",
    )
    out["join_all_versions"] = with_tables(
        f"""SELECT v.robot_id, MAX(c.robot_serial_number) AS robot_serial_number, MAX(c.robot_model) AS robot_model,
            MAX(c.status) AS status, COUNT(*) AS total_procedures,
            CAST(SUM(p.duration_minutes) AS DOUBLE) / 60.0::DOUBLE AS total_operating_hours,
            {_avg("p.complexity_tenths", 10)} AS avg_complexity,
            COUNT(DISTINCT v.effective_date) AS version_count
        FROM fact_procedures p
        JOIN fleet_versions v ON p.robot_key = v.s_suppkey AND v.effective_date <= strptime(CAST(p.start_date_key AS VARCHAR), '%Y%m%d')
          AND (v.expiration_date IS NULL OR strptime(CAST(p.start_date_key AS VARCHAR), '%Y%m%d') <= v.expiration_date)
        JOIN (SELECT f.robot_id, f.status, r.robot_serial_number, r.robot_model FROM fleet_versions f
              JOIN robots r ON f.robot_id = r.robot_id WHERE f.is_current) c ON c.robot_id = v.robot_id
        GROUP BY 1""",
        "fact_procedures", "fleet_versions", "robots",
    )
    return out
