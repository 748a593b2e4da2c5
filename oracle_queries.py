"""DuckDB SQL for every registered query, written without the library's plans."""

from __future__ import annotations

from sectorloom import fixtures
from sectorloom.sources.schemas import SCHOOL_FACILITIES, names

# Derived relations by name: (what they read, query).
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "shaped": (
        ("lgas", "lga_shapes"),
        """SELECT l.*, s.geojson FROM lgas l
           LEFT JOIN (SELECT Authority, min(geojson) AS geojson FROM lga_shapes GROUP BY 1) s
             ON l.lganame = s.Authority""",
    ),
    "admin": (
        ("shaped", "districts", "regions"),
        """SELECT r.name AS region_name, d.districtname AS district_name, l.lganame AS lga_name,
                  r.code AS region_code, r.school_regioncode, r.household_regioncode,
                  d.districtcode AS district_code, l.lgacode AS lga_code, l.school_lgacode,
                  l.household_lgacode, l.geojson
           FROM shaped l JOIN districts d ON l.districtcode = d.districtcode
           JOIN regions r ON d.regioncode = r.code""",
    ),
    "district_labels": (
        ("admin",),
        """SELECT district_code, min(region_code) AS region_code, min(region_name) AS region_name,
                  min(district_name) AS district_name FROM admin GROUP BY 1""",
    ),
    "wp": (
        ("water_point_reports",),
        """SELECT report_datetime, region, district AS district_code, village, dpid,
                  CAST(NULL AS VARCHAR) AS dpname, CAST(NULL AS VARCHAR) AS wps,
                  CAST(NULL AS VARCHAR) AS dpcode, latitude, longitude, populationserved,
                  CAST(NULL AS VARCHAR) AS yoc, CAST(NULL AS VARCHAR) AS meternumber,
                  CAST(NULL AS VARCHAR) AS scheme, CAST(NULL AS VARCHAR) AS schemetype,
                  CAST(NULL AS VARCHAR) AS servicearea, CAST(NULL AS VARCHAR) AS paymenttype,
                  functionalitystatus, CAST(NULL AS VARCHAR) AS organisation,
                  CAST(NULL AS VARCHAR) AS totalavailablegaps, CAST(NULL AS VARCHAR) AS completeness,
                  ward, CAST(NULL AS VARCHAR) AS servedbyagency, lga,
                  CAST(NULL AS VARCHAR) AS institutioncategoryid,
                  CAST(NULL AS VARCHAR) AS institutionareaid, sysid, report_year,
                  CAST(NULL AS VARCHAR) AS quarter, CAST(NULL AS TIMESTAMP) AS createdat,
                  CAST(report_year || '-01-01 00:00:00' AS TIMESTAMP) AS year_timestamp,
                  CAST(date_trunc('month', report_datetime) AS TIMESTAMP) AS month_timestamp,
                  CAST(date_trunc('quarter', report_datetime) AS TIMESTAMP) AS quarter_timestamp,
                  CASE WHEN functionalitystatus = 'functional' THEN 1 ELSE 0 END AS wp_functional,
                  CASE WHEN functionalitystatus = 'functional_need_repair' THEN 1 ELSE 0 END
                    AS wp_functional_needs_repair,
                  CASE WHEN functionalitystatus = 'not_functional' THEN 1 ELSE 0 END
                    AS wp_non_functional,
                  CASE WHEN functionalitystatus IN ('abandoned', 'archived') THEN 1 ELSE 0 END
                    AS wp_abandoned_archived,
                  CASE WHEN functionalitystatus = 'on_construction' THEN 1 ELSE 0 END
                    AS wp_inconstruction,
                  CASE WHEN functionalitystatus IN
                    ('functional', 'functional_need_repair', 'not_functional') THEN 1 ELSE 0 END
                    AS wp_func_denominator,
                  CAST(CASE functionalitystatus WHEN 'functional' THEN 1.0
                    WHEN 'functional_need_repair' THEN 0.5 WHEN 'not_functional' THEN 0.0
                    WHEN 'abandoned' THEN 0.0 ELSE NULL END AS DOUBLE) AS wp_status_numeric
           FROM water_point_reports""",
    ),
    "wp_named": (
        ("wp", "district_labels"),
        """SELECT w.*, d.region_code, d.region_name, d.district_name
           FROM wp w LEFT JOIN district_labels d ON w.district_code = d.district_code""",
    ),
    "wp_year": (
        ("wp_named",),
        """SELECT district_code, year_timestamp, district_name, region_code, region_name,
                  avg(wp_abandoned_archived) AS avg_wp_abandoned,
                  CAST(sum(wp_functional) AS BIGINT) AS sum_wp_functional,
                  avg(wp_functional_needs_repair) AS avg_wp_functional_needs_repair,
                  avg(wp_non_functional) AS avg_wp_non_functional,
                  avg(wp_inconstruction) AS avg_in_construction,
                  avg(wp_status_numeric) AS functionality_rate,
                  CAST(sum(wp_func_denominator) AS BIGINT) AS func_denom,
                  CASE WHEN sum(wp_func_denominator) = 0 THEN NULL ELSE
                    CAST(sum(wp_functional) AS DOUBLE) / sum(wp_func_denominator) * 100 END
                    AS func_rate_new
           FROM wp_named
           GROUP BY district_code, year_timestamp, district_name, region_code, region_name""",
    ),
    "wp_quarter": (
        ("wp_named",),
        """SELECT district_code, year_timestamp, quarter_timestamp, district_name, region_code,
                  region_name, avg(wp_abandoned_archived) AS avg_wp_abandoned,
                  CAST(sum(wp_functional) AS BIGINT) AS sum_wp_functional,
                  avg(wp_functional_needs_repair) AS avg_wp_functional_needs_repair,
                  avg(wp_non_functional) AS avg_wp_non_functional,
                  avg(wp_inconstruction) AS avg_in_construction,
                  avg(wp_status_numeric) AS functionality_rate,
                  CAST(sum(wp_func_denominator) AS BIGINT) AS func_denom,
                  CASE WHEN sum(wp_func_denominator) = 0 THEN NULL ELSE
                    CAST(sum(wp_functional) AS DOUBLE) / sum(wp_func_denominator) END
                    AS func_rate_new
           FROM wp_named
           GROUP BY district_code, year_timestamp, quarter_timestamp, district_name, region_code,
                    region_name""",
    ),
    "hh_totals": (
        ("household_reports",),
        """SELECT *,
                  COALESCE(toilettypea, 0) + COALESCE(toilettypeb, 0) + COALESCE(toilettypec, 0)
                    + COALESCE(toilettyped, 0) + COALESCE(toilettypee, 0)
                    + COALESCE(toilettypef, 0) + COALESCE(toilettypex, 0) AS totalhouseholds,
                  COALESCE(toilettypeb, 0) + COALESCE(toilettypec, 0) + COALESCE(toilettyped, 0)
                    + COALESCE(toilettypee, 0) AS improved_count_hhs
           FROM household_reports""",
    ),
    "hh": (
        ("hh_totals", "regions", "shaped"),
        """SELECT h.*,
                  CASE WHEN CAST(improved_count_hhs AS DOUBLE) / NULLIF(totalhouseholds, 0) > 1
                    THEN 1 ELSE CAST(improved_count_hhs AS DOUBLE) / NULLIF(totalhouseholds, 0) END
                    AS improved_perc_hhs,
                  CASE WHEN CAST(handwashingstation AS DOUBLE) / NULLIF(totalhouseholds, 0) > 1
                    THEN 1 ELSE CAST(handwashingstation AS DOUBLE) / NULLIF(totalhouseholds, 0) END
                    AS handwashstation_perc_hhs,
                  CASE WHEN CAST(hwfsoapwater AS DOUBLE) / NULLIF(totalhouseholds, 0) > 1
                    THEN 1 ELSE CAST(hwfsoapwater AS DOUBLE) / NULLIF(totalhouseholds, 0) END
                    AS handwashsoap_perc_hhs,
                  r.name AS region_name, l.lganame AS lga_name, l.geojson
           FROM hh_totals h
           LEFT JOIN regions r ON h.regioncode = r.household_regioncode
           LEFT JOIN shaped l ON h.lgacode = l.household_lgacode""",
    ),
    "joined_schools": (
        (
            "school_services",
            "school_reports",
            "school_infrastructure",
            "school_enrollment",
            "admin",
        ),
        f"""SELECT s.schoolregnumber, s.reportdate, s.watersource, r.regioncode AS region_code,
                   r.lgacode AS lga_code, r.gpscoordinates AS gps_coordinates, r.schoolpforrprogram,
                   a.region_name, a.lga_name,
                   {", ".join("i." + c for c in names(SCHOOL_FACILITIES))},
                   CAST(e.totalpupils AS DOUBLE) AS total_pupils,
                   CAST(e.totalgirls AS DOUBLE) AS girl_pupils,
                   CAST(e.totalboys AS DOUBLE) AS boy_pupils,
                   s.haselectricity, s.handwashingfacilities, s.handwashingtype,
                   s.electricitysource, s.sanitarypadsprovided, s.menstrualcounselor,
                   s.capitationgrant, s.signedsitebook, s.completioncertificate
            FROM (SELECT * FROM school_services WHERE year(reportdate) = 2024) s
            LEFT JOIN school_reports r ON s.schoolregnumber = r.schoolregnumber
            LEFT JOIN (SELECT * FROM school_infrastructure WHERE year(reportdate) = 2024) i
              ON s.schoolregnumber = i.schoolregnumber
            LEFT JOIN school_enrollment e ON s.schoolregnumber = e.schoolregnumber
            LEFT JOIN (SELECT school_lgacode, min(region_name) AS region_name,
                              min(lga_name) AS lga_name FROM admin GROUP BY 1) a
              ON r.lgacode = a.school_lgacode""",
    ),
    "coded_schools": (
        ("joined_schools",),
        """SELECT * REPLACE (
                    (COALESCE(latrinesmaintained, FALSE) OR COALESCE(specialgirlsroom, FALSE)
                      OR schoolregnumber LIKE 'EM%' OR COALESCE(latrineslockable, FALSE))
                      AS latrineslockable,
                    COALESCE(latrinesmaintained, FALSE) AS latrinesmaintained,
                    COALESCE(specialgirlsroom, FALSE) AS specialgirlsroom),
                  CASE WHEN split_part(schoolregnumber, '.', 1) IN ('EM', 'ES')
                         THEN 'Primary/Pre-Primary'
                       WHEN split_part(schoolregnumber, '.', 1) = 'S' THEN 'Secondary'
                       ELSE 'Unknown' END AS school_category,
                  CASE WHEN watersource ILIKE '%default%' OR watersource ILIKE '%maji ya bomba%'
                         OR watersource ILIKE '%maji ya mvua%'
                         OR watersource ILIKE '%visima vifupi%'
                         OR watersource ILIKE '%visima vilivyojengwa%' THEN 1
                       WHEN watersource ILIKE '%maji ya mto%' OR watersource ILIKE '%bwawa%'
                         OR watersource ILIKE '%maji ya ziwa%' OR watersource ILIKE '%chemchem%'
                         THEN 0 ELSE NULL END AS improved_water_source,
                  CASE WHEN toilettypeftconnanotherloc OR toilettypepitlatrinewithfloor
                         OR toilettypeopenpitlatrine OR toilettypeothers THEN 0
                       WHEN toilettypeftconnmainsewerline OR toilettypeftconnseptictank
                         OR toilettypeftconnpit OR toilettypevippitlatrine THEN 1
                       ELSE NULL END AS improved_toilet_type,
                  CASE WHEN dropholesmaleteachers > 0 AND dropholesfemaleteachers > 0 THEN TRUE
                       WHEN dropholesmaleteachers IS NULL OR dropholesfemaleteachers IS NULL
                         THEN NULL ELSE FALSE END AS separate_latrines_teachers,
                  CASE WHEN dropholesgirls IS NULL OR dropholesgirls = 0 THEN NULL
                       ELSE girl_pupils / dropholesgirls END AS girls_per_drophole,
                  CASE WHEN dropholesboys IS NULL OR dropholesboys = 0 THEN NULL
                       ELSE boy_pupils / dropholesboys END AS boys_per_drophole,
                  total_pupils >= 1500 AS enrollment_over1500,
                  CAST(NULL AS BOOLEAN) AS teacher_toilet_block,
                  CASE WHEN dropholesspecialneedsboys > 0 OR dropholesspecialneedsgirls > 0
                       THEN TRUE ELSE FALSE END AS drophole_specialneeds
           FROM joined_schools""",
    ),
    "rated_schools": (
        ("coded_schools",),
        """SELECT *,
                  CASE WHEN girls_per_drophole <= 40 AND boys_per_drophole <= 50
                         AND drophole_specialneeds AND enrollment_over1500 = FALSE THEN TRUE
                       WHEN girls_per_drophole <= 50 AND boys_per_drophole <= 65
                         AND drophole_specialneeds AND enrollment_over1500 = TRUE THEN TRUE
                       ELSE FALSE END AS meet_drophole_ratio
           FROM coded_schools""",
    ),
    "schools": (
        ("rated_schools",),
        """SELECT *,
                  CASE WHEN improved_toilet_type IS NULL OR meet_drophole_ratio IS NULL
                         OR separate_latrines_teachers IS NULL THEN NULL
                       WHEN improved_toilet_type = 1 AND meet_drophole_ratio
                         AND separate_latrines_teachers THEN 1
                       ELSE 0 END AS improved_sanitation_school
           FROM rated_schools""",
    ),
    "qc_lists": (
        ("schools", "school_services", "school_reports", "school_infrastructure"),
        """SELECT 'unmatched_services_not_in_reports' AS check_name, s.schoolregnumber
           FROM school_services s LEFT JOIN school_reports r USING (schoolregnumber)
           WHERE r.regioncode IS NULL AND year(s.reportdate) = 2024
           UNION ALL
           SELECT 'unmatched_reports_not_in_services', r.schoolregnumber FROM school_reports r
           WHERE r.schoolregnumber NOT IN (SELECT schoolregnumber FROM school_services)
           UNION ALL
           SELECT 'missing_region_lga_names', schoolregnumber FROM schools
           WHERE region_name IS NULL OR lga_name IS NULL
           UNION ALL
           SELECT 'infra_not_in_combined', i.schoolregnumber FROM school_infrastructure i
           WHERE i.schoolregnumber NOT IN (SELECT schoolregnumber FROM schools)
           UNION ALL
           SELECT 'combined_not_in_infra', schoolregnumber FROM schools
           WHERE schoolregnumber NOT IN (SELECT schoolregnumber FROM school_infrastructure)
           UNION ALL
           SELECT 'enrollment_mismatches', schoolregnumber FROM schools
           WHERE boy_pupils + girl_pupils <> total_pupils""",
    ),
    "levels": (
        ("villages",),
        """SELECT lgacode, avg(infracoverage) AS lga_water_access_level_perc,
                  CAST(sum(CAST(status = 1 AND isvillage AS INT)) AS BIGINT) AS villages_in_lga,
                  CAST(sum(CAST(status = 1 AND isvillage AND servicetype <> 'no_service' AS INT))
                    AS BIGINT) AS villages_with_service,
                  CAST(sum(CAST(status = 1 AND isvillage AND servicetype = 'no_service' AS INT))
                    AS BIGINT) AS villages_no_service,
                  CAST(sum(CAST(status = 1 AND isvillage AND NOT servedbyagency AS INT))
                    AS BIGINT) AS served_by_wssa
           FROM villages GROUP BY lgacode""",
    ),
    "tables": (
        ("school_services", "school_reports", "school_infrastructure", "school_enrollment"),
        """SELECT 'school_services' AS table_name, count(*) AS row_count,
                  count(DISTINCT schoolregnumber) AS school_count FROM school_services
           UNION ALL SELECT 'school_reports', count(*), count(DISTINCT schoolregnumber)
           FROM school_reports
           UNION ALL SELECT 'school_infrastructure', count(*), count(DISTINCT schoolregnumber)
           FROM school_infrastructure
           UNION ALL SELECT 'school_enrollment', count(*), count(DISTINCT schoolregnumber)
           FROM school_enrollment""",
    ),
}

DISTRICT_MEANS = """round(avg_wp_abandoned, 6) AS avg_wp_abandoned,
    round(avg_wp_functional_needs_repair, 6) AS avg_wp_functional_needs_repair,
    round(avg_wp_non_functional, 6) AS avg_wp_non_functional,
    round(avg_in_construction, 6) AS avg_in_construction,
    round(functionality_rate, 6) AS functionality_rate, round(func_rate_new, 6) AS func_rate_new"""

def school_checks_stream() -> str:
    """The checks between the sources over all rows that have arrived by each batch."""
    number = "CAST(split_part(schoolregnumber, '.', 2) AS INT)"
    return with_parts(
        f"""SELECT batch_id, check_name, result_value FROM (
            UNPIVOT (
                SELECT batch_id,
                    CAST(count(*) FILTER (in_year > 0) AS VARCHAR) AS unique_schools_services,
                    CAST(count(*) FILTER (reports > 0) AS VARCHAR) AS unique_schools_reports,
                    CAST(count(*) FILTER (in_year > 0 AND reports > 0) AS VARCHAR) AS matched_services_reports,
                    CAST(count(*) FILTER (facilities > 0) AS VARCHAR) AS unique_schools_infrastructure,
                    CAST(count(*) FILTER (in_year > 0 AND facilities > 0) AS VARCHAR)
                        AS matched_combined_infrastructure,
                    CAST(coalesce(sum(in_year) FILTER (reports = 0), 0) AS VARCHAR)
                        AS unmatched_services_not_in_reports,
                    CAST(coalesce(sum(reports) FILTER (services = 0), 0) AS VARCHAR)
                        AS unmatched_reports_not_in_services,
                    CAST(coalesce(sum(facilities) FILTER (in_year = 0), 0) AS VARCHAR) AS infra_not_in_combined,
                    CAST(coalesce(sum(in_year) FILTER (facilities = 0), 0) AS VARCHAR) AS combined_not_in_infra
                FROM (
                    SELECT batch_id, schoolregnumber, count(*) FILTER (kind = 's') AS services,
                        count(*) FILTER (kind = 's' AND in_year) AS in_year,
                        count(*) FILTER (kind = 'r') AS reports, count(*) FILTER (kind = 'i') AS facilities
                    FROM (
                        SELECT schoolregnumber, 's' AS kind, {number} % 4 AS arrives, year(reportdate) = 2024 AS in_year
                        FROM school_services
                        UNION ALL SELECT schoolregnumber, 'r', ({number} + 1) % 4, NULL FROM school_reports
                        UNION ALL SELECT schoolregnumber, 'i', ({number} + 2) % 4, NULL FROM school_infrastructure
                    ) JOIN (SELECT CAST(unnest(range(4)) AS INT) AS batch_id) ON arrives <= batch_id
                    GROUP BY ALL
                ) GROUP BY batch_id
            ) ON COLUMNS(* EXCLUDE batch_id) INTO NAME check_name VALUE result_value
        )""",
        "school_services",
        "school_reports",
        "school_infrastructure",
    )


HOUSEHOLD_MEANS = """round(avg(improved_perc_hhs), 6) AS avg_improved_perc_hhs,
    round(avg(handwashstation_perc_hhs), 6) AS avg_handwashstation_perc_hhs,
    round(avg(handwashsoap_perc_hhs), 6) AS avg_handwashsoap_perc_hhs"""


def with_parts(query: str, *wanted: str) -> str:
    """Prefix ``query`` with the relations it names and all that these read."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        if name in PARTS:
            reads, text = PARTS[name]
            for other in reads:
                add(other)
            done[name] = text
        else:
            done[name] = fixtures.INPUTS[name].sql()

    for name in wanted:
        add(name)
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in done.items())
    return f"WITH {ctes}\n{query}"


def share(relation: str, column: str, where: str = "TRUE") -> str:
    """Counts with exact percentages, half up to two digits."""
    return f"""SELECT {column}, n AS count,
                      ((20000 * n + total) // (2 * total)) / 100.0 AS percentage
               FROM (SELECT {column}, count(*) AS n,
                            CAST(sum(count(*)) OVER () AS BIGINT) AS total
                     FROM {relation} WHERE {where} GROUP BY {column})"""


def flag_score(column: str) -> str:
    return (
        f"((2000 * sum({column}) + count({column})) // NULLIF(2 * count({column}), 0)) / 10.0"
    )


def scorecard() -> str:
    query = f"""
        SELECT l.lgacode, l.household_lgacode, l.school_lgacode, l.lganame, l.districtcode,
               d.districtname AS district_name, l.geojson, h.lga_improved_san_perc_hhs,
               h.lga_handwashstation_perc_hhs, h.lga_handwashsoap_perc_hhs, h.regioncode,
               h.region_name, s.lga_school_improved_water_perc,
               s.lga_school_improved_toilet_type_perc, round(w.func_rate_new, 6) AS func_rate_new,
               round(v.lga_water_access_level_perc, 6) AS lga_water_access_level_perc
        FROM shaped l
        LEFT JOIN (
            SELECT lgacode, min(regioncode) AS regioncode, min(region_name) AS region_name,
                   round(100.0 * sum(improved_perc_hhs) / count(improved_perc_hhs), 1)
                     AS lga_improved_san_perc_hhs,
                   round(100.0 * sum(handwashstation_perc_hhs) / count(handwashstation_perc_hhs), 1)
                     AS lga_handwashstation_perc_hhs,
                   round(100.0 * sum(handwashsoap_perc_hhs) / count(handwashsoap_perc_hhs), 1)
                     AS lga_handwashsoap_perc_hhs
            FROM hh GROUP BY lgacode) h ON h.lgacode = l.household_lgacode
        LEFT JOIN (
            SELECT lga_code, {flag_score("improved_water_source")} AS lga_school_improved_water_perc,
                   {flag_score("improved_toilet_type")} AS lga_school_improved_toilet_type_perc
            FROM schools GROUP BY lga_code) s ON s.lga_code = l.school_lgacode
        LEFT JOIN districts d ON d.districtcode = l.districtcode
        LEFT JOIN (
            SELECT DISTINCT ON (district_code) district_code, func_rate_new FROM wp_year
            ORDER BY district_code, year_timestamp DESC NULLS LAST) w
          ON w.district_code = l.districtcode
        LEFT JOIN levels v ON v.lgacode = l.lgacode"""
    return with_parts(query, "shaped", "hh", "schools", "districts", "wp_year", "levels")


def coverage_latest(stamp: str) -> str:
    return with_parts(
        f"""SELECT c.district_code, round(c.avg_infracoverage, 6) AS avg_infracoverage,
                   d.region_code, d.region_name, d.district_name
            FROM (SELECT district AS district_code, avg(infracoverage) AS avg_infracoverage
                  FROM coverage_reports
                  WHERE CAST({stamp} AS DATE) =
                        (SELECT max(CAST({stamp} AS DATE)) FROM coverage_reports)
                    AND infracoverage > 0 GROUP BY 1) c
            LEFT JOIN district_labels d ON c.district_code = d.district_code""",
        "coverage_reports",
        "district_labels",
    )


# The seconds of the run of 2024-07-01, then two digits.
RUN_NUMBER = 171979200000


def qc_log() -> str:
    counted = {
        "unique_schools_services": "SELECT count(DISTINCT schoolregnumber) FROM school_services"
        " WHERE year(reportdate) = 2024",
        "unique_schools_reports": "SELECT count(DISTINCT schoolregnumber) FROM school_reports",
        "matched_services_reports": "SELECT count(DISTINCT s.schoolregnumber)"
        " FROM school_services s JOIN school_reports r ON s.schoolregnumber = r.schoolregnumber"
        " WHERE year(s.reportdate) = 2024",
        "unmatched_services_not_in_reports": None,
        "unmatched_reports_not_in_services": None,
        "missing_region_lga_names": None,
        "unique_schools_infrastructure": "SELECT count(DISTINCT schoolregnumber)"
        " FROM school_infrastructure",
        "matched_combined_infrastructure": "SELECT count(DISTINCT s.schoolregnumber)"
        " FROM schools s JOIN school_infrastructure i ON s.schoolregnumber = i.schoolregnumber",
        "infra_not_in_combined": None,
        "combined_not_in_infra": None,
        "school_category_counts": None,
        "null_watersource_count": "SELECT count(*) FROM schools WHERE watersource IS NULL",
        "null_improved_toilet_type": "SELECT count(*) FROM schools"
        " WHERE improved_toilet_type IS NULL",
        "enrollment_totals": None,
        "enrollment_over_under_1500": None,
        "meet_drophole_ratio_count": "SELECT count(*) FROM schools WHERE meet_drophole_ratio",
        "separate_latrines_teachers_count": "SELECT count(*) FROM schools"
        " WHERE separate_latrines_teachers",
        "percent_improved_sanitation": "SELECT round(100.0 * count(*)"
        " FILTER (improved_sanitation_school = 1) / CAST(count(*) AS DOUBLE), 6) FROM schools",
        "enrollment_mismatches": None,
    }
    texts = {
        "school_category_counts": "SELECT string_agg(school_category || ':' || n, ', '"
        " ORDER BY school_category) FROM"
        " (SELECT school_category, count(*) AS n FROM schools GROUP BY 1)",
        "enrollment_totals": "SELECT 'boys:' || CAST(sum(boy_pupils) AS BIGINT) || ', girls:'"
        " || CAST(sum(girl_pupils) AS BIGINT) || ', total:'"
        " || CAST(sum(total_pupils) AS BIGINT) FROM schools",
        "enrollment_over_under_1500": "SELECT 'over_1500:' || count(*) FILTER (total_pupils >= 1500)"
        " || ', under_1500:' || count(*) FILTER (total_pupils < 1500) FROM schools",
    }
    rows = []
    for i, (name, query) in enumerate(counted.items(), start=1):
        value, details = "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"
        if query:
            value = f"CAST(({query}) AS VARCHAR)"
        elif name in texts:
            details = f"({texts[name]})"
        else:
            found = f"FROM qc_lists WHERE check_name = '{name}'"
            value = f"CAST((SELECT count(*) {found}) AS VARCHAR)"
            details = "'qc_keys'"
        rows.append(
            f"SELECT CAST({RUN_NUMBER + i} AS BIGINT) AS id, '{name}' AS check_name, {value} AS result_value,"
            f" {details} AS details, TIMESTAMP '2024-07-01 00:00:00' AS log_time"
        )
    return with_parts(
        "\nUNION ALL ".join(rows),
        "schools",
        "school_services",
        "school_reports",
        "school_infrastructure",
        "qc_lists",
    )


def hh_flags() -> str:
    checks = [
        (
            "totalhouseholds = 0",
            "unrealistic_values",
            "Rows with computed totalhouseholds = 0",
            "Review raw data for inconsistencies",
        ),
        (
            "regioncode IS NOT NULL AND region_name IS NULL",
            "missing_data",
            "Rows with non-null regioncode but null region_name",
            "Verify lookup table for regions",
        ),
        (
            "lgacode IS NOT NULL AND lga_name IS NULL",
            "missing_data",
            "Rows with non-null lgacode but null lga_name",
            "Verify lookup table for LGAs",
        ),
    ]
    rows = [
        f"""SELECT CAST({RUN_NUMBER + i} AS BIGINT) AS id, 'MOH' AS institution,
                   'householdsanitation' AS data_type, '{kind}' AS error_alert_type,
                   '{text}' AS description, DATE '2024-07-01' AS reportdate,
                   TIMESTAMP '2024-07-01 00:00:00' AS createdat, 'pending' AS status,
                   '{remark}' AS resolution_remarks,
                   TIMESTAMP '2024-07-01 00:00:00' AS lastupdatedat
            WHERE EXISTS (SELECT 1 FROM hh WHERE {test})"""
        for i, (test, kind, text, remark) in enumerate(checks, start=1)
    ]
    return "\nUNION ALL ".join(rows)


def wkt_features() -> str:
    return with_parts(
        """SELECT id, name, wkt,
                  '{"type":"Feature","properties":{"id":' || id || ',"name":'
                    || COALESCE('"' || name || '"', 'null') || '},"geometry":' ||
                  CASE id % 10
                    WHEN 0 THEN '{"type":"Point","coordinates":[' || id || ',-7.25]}'
                    WHEN 1 THEN '{"type":"LineString","coordinates":[[4,0],[' || id
                                || ',1.5],[0,0]]}'
                    WHEN 2 THEN '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,' || id
                                || '],[0,0]]]}'
                    WHEN 3 THEN '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,' || id
                                || '],[0,0]]]}'
                    WHEN 4 THEN '{"type":"Polygon","coordinates":[[[0,0],[9,0],[9,9],[0,9],[0,0]],'
                                || '[[1,1],[1,2],[2,2],[2,1],[1,1]]]}'
                    WHEN 5 THEN '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,1],[0,1],[0,0]]],'
                                || '[[[5,5],[6,5],[6,6],[5,5]]]]}'
                    WHEN 6 THEN 'null'
                    WHEN 8 THEN '{"type":"MultiPoint","coordinates":[[1,2],[3,' || id || ']]}'
                    ELSE '{"type":"MultiLineString","coordinates":[[[1,1],[0,0]],[[3,' || id
                         || '],[2,2]]]}' END || '}' AS geojson
           FROM lga_boundaries WHERE id % 10 <> 7""",
        "lga_boundaries",
    )


def oracle_sql() -> dict[str, str]:
    admin_columns = """region_name, district_name, lga_name, region_code, school_regioncode,
                       household_regioncode, district_code, lga_code, school_lgacode,
                       household_lgacode"""
    monthly = with_parts(
        """SELECT CAST(date_trunc('month', recorded_date) AS TIMESTAMP) AS month,
                  round(avg(metric), 6) AS metric_value FROM source_data GROUP BY 1""",
        "source_data",
    )
    yearly = with_parts(
        """SELECT CAST(date_trunc('year', date_recorded) AS TIMESTAMP) AS year, region,
                  round(avg(functioning_percentage), 6) AS percentage
           FROM water_data GROUP BY 1, 2""",
        "water_data",
    )
    flags = hh_flags()
    rejects = """SELECT 'school_enrollment' AS table_name, schoolregnumber, column_name, value, 'not a number' AS reason
        FROM (UNPIVOT dirty_enrollment ON totalgirls, totalboys, totalpupils INTO NAME column_name VALUE value)
        WHERE TRY_CAST(value AS DOUBLE) IS NULL"""
    return {
        "school_rejects": with_parts(rejects, "dirty_enrollment"),
        "school_reject_counts": with_parts(
            f"""SELECT table_name, column_name, reason, count(*) AS row_count,
                       count(DISTINCT schoolregnumber) AS school_count
                FROM ({rejects}) GROUP BY ALL""",
            "dirty_enrollment",
        ),
        "lga_shapes": with_parts("SELECT * FROM shaped", "shaped"),
        "unmatched_lga_names": with_parts(
            "SELECT lgacode, lganame FROM lgas"
            " WHERE lganame NOT IN (SELECT Authority FROM lga_shapes)",
            "lgas",
            "lga_shapes",
        ),
        "admin_lookup": with_parts("SELECT * FROM admin", "admin"),
        "admin_lookup_plain": with_parts(f"SELECT {admin_columns} FROM admin", "admin"),
        "admin_lookup_light": with_parts(
            f"SELECT {admin_columns.replace('lga_name', 'lga_name AS lganame')} FROM admin", "admin"
        ),
        "wp_detail": with_parts("SELECT * FROM wp_named", "wp_named"),
        "wp_status_share": with_parts(
            share("water_point_reports", "functionalitystatus"), "water_point_reports"
        ),
        "wp_district_year": with_parts(
            f"""SELECT district_code, year_timestamp, district_name, region_code, region_name,
                       sum_wp_functional, func_denom, {DISTRICT_MEANS} FROM wp_year""",
            "wp_year",
        ),
        "wp_district_quarter": with_parts(
            f"""SELECT district_code, year_timestamp, quarter_timestamp, district_name, region_code,
                       region_name, sum_wp_functional, func_denom, {DISTRICT_MEANS}
                FROM wp_quarter""",
            "wp_quarter",
        ),
        "districts_without_functional": with_parts(
            """SELECT district_code, district_name, year_timestamp, quarter_timestamp
               FROM wp_quarter WHERE func_denom = 0""",
            "wp_quarter",
        ),
        "wp_latest_located": with_parts(
            """SELECT w.dpid, r.region_name, d.district_name, l.lga_name,
                      v.villagename AS village_name, w.ward AS ward_name, w.functionalitystatus,
                      w.populationserved, w.latitude, w.longitude, w.report_datetime, l.geojson
               FROM (SELECT DISTINCT ON (dpid) * FROM wp
                     WHERE latitude IS NOT NULL AND longitude IS NOT NULL
                       AND functionalitystatus IN
                           ('functional', 'not_functional', 'functional_need_repair')
                       AND report_datetime >= TIMESTAMP '2001-05-01 00:00:00'
                       AND report_datetime < TIMESTAMP '2001-08-01 00:00:00'
                     ORDER BY dpid, report_datetime DESC, sysid) w
               LEFT JOIN (SELECT region_code, min(region_name) AS region_name FROM admin
                          GROUP BY 1) r ON w.region = r.region_code
               LEFT JOIN district_labels d ON w.district_code = d.district_code
               LEFT JOIN admin l ON w.lga = l.lga_code
               LEFT JOIN villages v ON w.village = v.villagecode""",
            "wp",
            "admin",
            "district_labels",
            "villages",
        ),
        "wp_key_violations": with_parts(
            """SELECT dpid, report_datetime, count(*) AS row_count FROM water_point_reports
               GROUP BY dpid, report_datetime
               HAVING count(*) > 1 OR dpid IS NULL OR report_datetime IS NULL""",
            "water_point_reports",
        ),
        "coverage_yearly": with_parts(
            """SELECT c.district_code, c.year, round(c.avg_infracoverage, 6) AS avg_infracoverage,
                      d.region_code, d.region_name, d.district_name,
                      CAST(c.year || '-01-01 00:00:00' AS TIMESTAMP) AS year_timestamp
               FROM (SELECT district AS district_code, CAST(year(report_datetime) AS INT) AS year,
                            avg(infracoverage) AS avg_infracoverage
                     FROM coverage_reports GROUP BY 1, 2) c
               LEFT JOIN district_labels d ON c.district_code = d.district_code""",
            "coverage_reports",
            "district_labels",
        ),
        "coverage_latest": coverage_latest("report_datetime"),
        "coverage_latest_month": coverage_latest("date_trunc('month', report_datetime)"),
        "hh_detail": with_parts("SELECT * FROM hh", "hh"),
        "hh_lga_mean": with_parts(
            f"""SELECT * FROM (
                  SELECT lgacode, lga_name, reportdate, regioncode, region_name, geojson,
                         {HOUSEHOLD_MEANS}
                  FROM hh GROUP BY lgacode, lga_name, reportdate, regioncode, region_name, geojson)
                WHERE avg_improved_perc_hhs IS NOT NULL
                  AND avg_handwashsoap_perc_hhs IS NOT NULL
                  AND avg_handwashstation_perc_hhs IS NOT NULL""",
            "hh",
        ),
        "hh_lga_by_date": with_parts(
            f"""SELECT r.lgacode, r.lga_name, r.reportdate, r.regioncode, r.region_name, r.geojson,
                       {HOUSEHOLD_MEANS}
                FROM (SELECT DISTINCT ON (lgacode, lga_name, reportdate)
                             lgacode, lga_name, reportdate, regioncode, region_name, geojson
                      FROM hh ORDER BY lgacode, lga_name, reportdate, createdat NULLS LAST,
                                       regioncode NULLS LAST) r
                JOIN hh v ON v.lgacode = r.lgacode AND v.lga_name = r.lga_name
                         AND v.reportdate = r.reportdate
                GROUP BY r.lgacode, r.lga_name, r.reportdate, r.regioncode, r.region_name,
                         r.geojson""",
            "hh",
        ),
        "hh_flags": with_parts(flags, "hh"),
        "hh_flags_stream": with_parts(
            "SELECT institution, data_type, error_alert_type, description"
            f" FROM ({flags})",
            "hh",
        ),
        "school_combined": with_parts("SELECT * FROM schools", "schools"),
        "school_qc_log": qc_log(),
        "refreshed_qc_log": qc_log(),
        "school_qc_keys": with_parts(
            """SELECT check_name, schoolregnumber, count(*) AS row_count FROM qc_lists
               GROUP BY 1, 2""",
            "qc_lists",
        ),
        "school_toilet_share": with_parts(share("schools", "improved_toilet_type"), "schools"),
        "school_water_share": with_parts(share("schools", "improved_water_source"), "schools"),
        "school_uncoded_sources": with_parts(
            share("schools", "watersource", "improved_water_source IS NULL"), "schools"
        ),
        "school_no_toilet_type": with_parts(
            """SELECT schoolregnumber FROM schools
               WHERE toilettypeftconnmainsewerline IS NULL AND toilettypeftconnseptictank IS NULL
                 AND toilettypeftconnpit IS NULL AND toilettypevippitlatrine IS NULL
                 AND toilettypeftconnanotherloc IS NULL
                 AND toilettypepitlatrinewithfloor IS NULL
                 AND toilettypeopenpitlatrine IS NULL AND toilettypeothers IS NULL""",
            "schools",
        ),
        "school_null_profile": with_parts(
            """SELECT field, null_count, school_count,
                      ((20000 * null_count + school_count) // (2 * school_count)) / 100.0
                        AS null_percentage
               FROM ("""
            + " UNION ALL ".join(
                f"SELECT '{c}' AS field, count(*) FILTER ({c} IS NULL) AS null_count"
                " FROM school_infrastructure"
                for c in names(SCHOOL_FACILITIES)
            )
            + """), (SELECT max(school_count) AS school_count FROM tables)""",
            "school_infrastructure",
            "tables",
        ),
        "school_table_counts": with_parts(
            """SELECT table_name, row_count, school_count,
                      CASE WHEN row_count < 1850 THEN 'low' WHEN row_count > 1900 THEN 'high'
                           ELSE 'ok' END AS alert FROM tables""",
            "tables",
        ),
        "service_level_lga": with_parts(
            """SELECT * REPLACE (round(lga_water_access_level_perc, 6)
                                 AS lga_water_access_level_perc) FROM levels""",
            "levels",
        ),
        "lga_scorecard": scorecard(),
        "refreshed_scorecard": scorecard(),
        "wkt_features": wkt_features(),
        "wkt_errors": with_parts(
            "SELECT id, name, wkt FROM lga_boundaries WHERE id % 10 = 7", "lga_boundaries"
        ),
        "monthly_metric": monthly,
        "monthly_metric_stream": monthly,
        "yearly_region_metric": yearly,
        "yearly_region_metric_stream": yearly,
        "yearly_region_metric_changes": """
            SELECT CAST(date_trunc('year', ts) AS TIMESTAMP) AS year,
                CASE WHEN event_id % 6 = 0 THEN 'moved' ELSE event_type END AS region,
                round(avg(CASE WHEN event_id % 3 = 0 THEN value + 10 ELSE value END), 6) AS percentage
            FROM events WHERE event_id % 5 <> 0 GROUP BY 1, 2""",
        "school_checks_stream": school_checks_stream(),
    }
