
from __future__ import annotations

import os
import sys
from collections.abc import Callable, Sequence
from functools import cached_property
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_queries  # noqa: E402
from sectorloom import fixtures  # noqa: E402
from sectorloom.fixtures import AS_OF, RUN_TS, YEAR  # noqa: E402
from sectorloom.functions.periods import period_start  # noqa: E402
from sectorloom.operators.keyed import key_violations  # noqa: E402
from sectorloom.plans import (  # noqa: E402
    coverage,
    features,
    households,
    lookups,
    periodic,
    refresh,
    school_quality,
    schools,
    scorecard,
    water_points,
)
from sectorloom.sources.shared import new_folder  # noqa: E402
from sectorloom.sources.stores import RAW, FolderStore  # noqa: E402
from sectorloom.streaming.changes import signed_rows  # noqa: E402
from sectorloom.streaming.refresh import start_quality_flags, start_refresh  # noqa: E402
from sectorloom.streaming.school_checks import start_school_checks, streamed_presence  # noqa: E402

try:
    import corpus_pipeline
    import sectorloom.llm.queries as llm_queries
except ModuleNotFoundError as error:
    # Without the operators, or without a library that only they need, the other queries still work.
    missing = error.name or ""
    if missing.split(".")[0] == "sectorloom" and not missing.startswith("sectorloom.llm"):
        raise
    llm_queries = None

LOW_ROWS, HIGH_ROWS = 1850, 1900


class Inputs:
    """The emulated raw inputs of one data folder, and marts that several queries start from."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.source = fixtures.Source(spark, sf_dir)
        self.stream = self.source.stream

    def __getattr__(self, name: str) -> DataFrame:
        if name not in fixtures.INPUTS:
            raise AttributeError(name)
        setattr(self, name, self.source[name])
        return getattr(self, name)

    @cached_property
    def shaped(self) -> DataFrame:
        return lookups.lgas_with_shape(self.lgas, self.lga_shapes)

    @cached_property
    def admin(self) -> DataFrame:
        return lookups.admin_lookup(self.lgas, self.districts, self.regions, False)

    @cached_property
    def admin_with_shape(self) -> DataFrame:
        return lookups.admin_lookup(self.shaped, self.districts, self.regions)

    def status(self) -> DataFrame:
        return water_points.status_detail(self.water_point_reports)

    def rates(self) -> DataFrame:
        return households.household_rates(self.household_reports)

    def named_households(self) -> DataFrame:
        return households.household_detail(
            self.household_reports, self.regions, self.lgas, include_geojson=False
        )

    def schools(self) -> DataFrame:
        return schools.school_combined(*self.school_tables().values(), self.admin, YEAR)

    def school_tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in refresh.SCHOOL_SOURCES}

    def presence(self) -> DataFrame:
        """The mart has the school numbers of the year's service rows, so no join is needed here."""
        return school_quality.key_presence(
            self.school_services,
            self.school_reports,
            self.school_infrastructure,
            schools.services_of_year(self.school_services, YEAR),
            YEAR,
        )


def rounded(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Six digits for means, whose last bits depend on the order of summation."""
    means = [c for c in df.columns if c.startswith("avg_")] if columns is None else columns
    return df.withColumns({c: F.round(c, 6) for c in means})


DISTRICT_MEANS = [
    "avg_wp_abandoned",
    "avg_wp_functional_needs_repair",
    "avg_wp_non_functional",
    "avg_in_construction",
    "functionality_rate",
    "func_rate_new",
]
SCORECARD_MEANS = ["func_rate_new", "lga_water_access_level_perc"]


def _lga_shapes(data: Inputs) -> DataFrame:
    return data.shaped


def _unmatched_lga_names(data: Inputs) -> DataFrame:
    return lookups.unmatched_lga_names(data.lgas, data.lga_shapes)


def _admin_lookup_light(data: Inputs) -> DataFrame:
    return lookups.admin_lookup_light(data.admin_with_shape)


def _wp_detail(data: Inputs) -> DataFrame:
    return water_points.water_point_detail(data.water_point_reports, data.admin)


def _wp_status_share(data: Inputs) -> DataFrame:
    return water_points.status_share(data.status())


def _wp_district_year(data: Inputs) -> DataFrame:
    return rounded(water_points.district_rates(data.status(), data.admin), DISTRICT_MEANS)


def _wp_district_quarter(data: Inputs) -> DataFrame:
    rates = water_points.district_rates(data.status(), data.admin, water_points.QUARTER)
    return rounded(rates, DISTRICT_MEANS)


def _districts_without_functional(data: Inputs) -> DataFrame:
    rates = water_points.district_rates(data.status(), data.admin, water_points.QUARTER)
    return water_points.without_functional(rates).select(
        "district_code", "district_name", "year_timestamp", "quarter_timestamp"
    )


def _wp_latest_located(data: Inputs) -> DataFrame:
    return water_points.latest_located(
        data.status(), data.admin_with_shape, data.villages, AS_OF
    )


def _wp_key_violations(data: Inputs) -> DataFrame:
    return key_violations(data.water_point_reports, ["dpid", "report_datetime"])


def _coverage_yearly(data: Inputs) -> DataFrame:
    return rounded(coverage.coverage_yearly(data.coverage_reports, data.admin))


def _coverage_latest(data: Inputs) -> DataFrame:
    return rounded(coverage.coverage_latest(data.coverage_reports, data.admin))


def _coverage_latest_month(data: Inputs) -> DataFrame:
    monthly = data.coverage_reports.withColumn(
        "report_datetime", period_start(F.col("report_datetime"), "month")
    )
    return rounded(coverage.coverage_latest(monthly, data.admin))


def _hh_detail(data: Inputs) -> DataFrame:
    return households.household_detail(data.household_reports, data.regions, data.shaped)


def _hh_lga_mean(data: Inputs) -> DataFrame:
    return rounded(households.lga_means(data.rates(), data.regions, data.shaped))


def _hh_lga_by_date(data: Inputs) -> DataFrame:
    return rounded(households.lga_means_by_date(data.rates(), data.regions, data.shaped))


def _hh_flags(data: Inputs) -> DataFrame:
    return households.quality_flags(data.named_households(), RUN_TS)


def _hh_flags_stream(data: Inputs) -> DataFrame:
    """Kinds of flags raised by any micro-batch."""
    folder = new_folder(data.spark, "flags")

    def check(batch: DataFrame) -> DataFrame:
        named = households.household_detail(batch, data.regions, data.lgas, False)
        return households.quality_flags(named, RUN_TS)

    query = start_quality_flags(
        data.stream("household_reports"), check, folder, new_folder(data.spark, "flags-state")
    )
    query.awaitTermination()
    flags = data.spark.read.parquet(folder)
    return flags.select("institution", "data_type", "error_alert_type", "description").distinct()


def _school_combined(data: Inputs) -> DataFrame:
    return data.schools()


def _school_qc_log(data: Inputs) -> DataFrame:
    return school_quality.qc_log(data.presence(), data.schools(), RUN_TS)


def _school_qc_keys(data: Inputs) -> DataFrame:
    return school_quality.failing_keys(data.presence(), data.schools())


def _school_rejects(data: Inputs) -> DataFrame:
    return schools.rejected_counts(data.dirty_enrollment)


def _school_reject_counts(data: Inputs) -> DataFrame:
    return schools.reject_counts(schools.rejected_counts(data.dirty_enrollment))


def _school_toilet_share(data: Inputs) -> DataFrame:
    return school_quality.toilet_share(data.schools())


def _school_water_share(data: Inputs) -> DataFrame:
    return school_quality.water_share(data.schools())


def _school_uncoded_sources(data: Inputs) -> DataFrame:
    return school_quality.uncoded_sources(data.schools())


def _school_no_toilet_type(data: Inputs) -> DataFrame:
    return school_quality.no_toilet_type(data.schools())


def _school_null_profile(data: Inputs) -> DataFrame:
    return school_quality.null_profile(data.school_infrastructure, data.school_tables())


def _school_table_counts(data: Inputs) -> DataFrame:
    return school_quality.table_counts(data.school_tables(), LOW_ROWS, HIGH_ROWS)


def _service_level_lga(data: Inputs) -> DataFrame:
    return rounded(scorecard.service_levels(data.villages), ["lga_water_access_level_perc"])


def _lga_scorecard(data: Inputs) -> DataFrame:
    card = scorecard.lga_scorecard(
        data.shaped,
        data.districts,
        scorecard.household_scores(
            households.with_region_name(data.rates(), data.regions)
        ),
        scorecard.school_scores(data.schools()),
        water_points.district_rates(data.status(), data.admin),
        scorecard.service_levels(data.villages),
    )
    return rounded(card, SCORECARD_MEANS)


def _refreshed_scorecard(data: Inputs) -> DataFrame:
    """The scorecard as published by a whole refresh into the shared folder."""
    store = FolderStore(
        data.spark,
        new_folder(data.spark, "marts"),
        inputs={name: getattr(data, name) for name in RAW},
    )
    refresh.refresh_all(store, refresh.Run(AS_OF, YEAR, RUN_TS, LOW_ROWS, HIGH_ROWS))
    return rounded(store.read("lga_scorecard"), SCORECARD_MEANS)


def _refreshed_qc_log(data: Inputs) -> DataFrame:
    """The log after the same run has refreshed the schools twice."""
    store = FolderStore(
        data.spark,
        new_folder(data.spark, "marts"),
        inputs={name: getattr(data, name) for name in RAW},
    )
    until_schools = [step for step in refresh.STEPS if step.name in ("shapes", "admin lookup", "schools")]
    for _ in range(2):
        refresh.refresh_all(
            store, refresh.Run(AS_OF, YEAR, RUN_TS, LOW_ROWS, HIGH_ROWS), until_schools
        )
    return store.read("qc_log")


def _wkt_features(data: Inputs) -> DataFrame:
    return features.to_feature(data.lga_boundaries, "wkt")


def _wkt_errors(data: Inputs) -> DataFrame:
    return features.split_features(data.lga_boundaries, "wkt")[1]


def _monthly_metric(data: Inputs) -> DataFrame:
    return rounded(periodic.monthly_metrics(data.source_data), ["metric_value"])


def _yearly_region_metric(data: Inputs) -> DataFrame:
    return rounded(periodic.functioning_by_year_region(data.water_data), ["percentage"])


def _monthly_metric_stream(data: Inputs) -> DataFrame:
    return _streamed(data, periodic.monthly_metrics(data.stream("source_data")), "metric_value")


def _yearly_region_metric_stream(data: Inputs) -> DataFrame:
    grouped = periodic.functioning_by_year_region(data.stream("water_data"))
    return _streamed(data, grouped, "percentage")


def _yearly_region_metric_changes(data: Inputs) -> DataFrame:
    """The mart after inserts, then updates that raise values and move rows to another region, then deletes."""
    number = F.col("event_id")
    row = ["date_recorded", "region", "functioning_percentage"]
    first = F.struct(*[F.expr(fixtures.INPUTS["water_data"].columns[c]).alias(c) for c in row])
    moved = F.when(number % 6 == 0, "moved").otherwise(F.col("after.region")).alias("region")
    raised = (F.col("after.functioning_percentage") + 10).alias("functioning_percentage")
    updated = F.struct(F.col("after.date_recorded").alias("date_recorded"), moved, raised)
    inserts = data.source.table("events").select("event_id", first.alias("after"))
    latest = inserts.withColumn("after", F.when(number % 3 == 0, updated).otherwise(F.col("after")))
    nothing = F.lit(None).cast(inserts.schema["after"].dataType)
    batches = [
        inserts.withColumn("before", nothing),
        inserts.where(number % 3 == 0).select(F.col("after").alias("before"), updated.alias("after")),
        latest.where(number % 5 == 0).select(F.col("after").alias("before"), nothing.alias("after")),
    ]
    feed, target, state = (new_folder(data.spark, x) for x in ("changes", "refreshed", "refresh-state"))
    for batch in batches:
        batch.select("before", "after").write.mode("append").parquet(feed)
        changes = data.spark.readStream.schema(batches[1].select("before", "after").schema).parquet(feed)
        query = start_refresh(
            periodic.functioning_of_changes(signed_rows(changes)),
            lambda mart: mart.write.mode("overwrite").parquet(target),
            state,
        )
        query.awaitTermination()
    return rounded(data.spark.read.parquet(target), ["percentage"])


# The arrival of a school's rows: their batch in each source, so partners come apart.
ARRIVALS = 4
ARRIVES = {"school_services": 0, "school_reports": 1, "school_infrastructure": 2}


def _school_checks_stream(data: Inputs) -> DataFrame:
    """The checks between the school sources after each of several arrivals of rows."""
    state, found = new_folder(data.spark, "checks-state"), new_folder(data.spark, "checks")
    folders = {name: new_folder(data.spark, name) for name in ARRIVES}
    number = F.split_part("schoolregnumber", F.lit("."), F.lit(2)).cast("int")
    for arrival in range(ARRIVALS):
        streams = []
        for name, shift in ARRIVES.items():
            rows = getattr(data, name)
            rows.where((number + shift) % ARRIVALS == arrival).write.mode("append").parquet(folders[name])
            streams.append(data.spark.readStream.schema(rows.schema).parquet(folders[name]))
        start_school_checks(streamed_presence(*streams, YEAR), RUN_TS, found, state).awaitTermination()
    return data.spark.read.parquet(found).select("batch_id", "check_name", "result_value")


def _streamed(data: Inputs, grouped: DataFrame, mean: str) -> DataFrame:
    """The mart after the stream has caught up with its source."""
    target = new_folder(data.spark, "refreshed")
    query = start_refresh(
        grouped,
        lambda mart: mart.write.mode("overwrite").parquet(target),
        new_folder(data.spark, "refresh-state"),
    )
    query.awaitTermination()
    return rounded(data.spark.read.parquet(target), [mean])


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "lga_shapes": _lga_shapes,
    "unmatched_lga_names": _unmatched_lga_names,
    "admin_lookup": lambda data: data.admin_with_shape,
    "admin_lookup_plain": lambda data: data.admin,
    "admin_lookup_light": _admin_lookup_light,
    "wp_detail": _wp_detail,
    "wp_status_share": _wp_status_share,
    "wp_district_year": _wp_district_year,
    "wp_district_quarter": _wp_district_quarter,
    "districts_without_functional": _districts_without_functional,
    "wp_latest_located": _wp_latest_located,
    "wp_key_violations": _wp_key_violations,
    "coverage_yearly": _coverage_yearly,
    "coverage_latest": _coverage_latest,
    "coverage_latest_month": _coverage_latest_month,
    "hh_detail": _hh_detail,
    "hh_lga_mean": _hh_lga_mean,
    "hh_lga_by_date": _hh_lga_by_date,
    "hh_flags": _hh_flags,
    "hh_flags_stream": _hh_flags_stream,
    "school_combined": _school_combined,
    "school_qc_log": _school_qc_log,
    "school_qc_keys": _school_qc_keys,
    "school_rejects": _school_rejects,
    "school_reject_counts": _school_reject_counts,
    "school_toilet_share": _school_toilet_share,
    "school_water_share": _school_water_share,
    "school_uncoded_sources": _school_uncoded_sources,
    "school_no_toilet_type": _school_no_toilet_type,
    "school_null_profile": _school_null_profile,
    "school_table_counts": _school_table_counts,
    "service_level_lga": _service_level_lga,
    "lga_scorecard": _lga_scorecard,
    "refreshed_scorecard": _refreshed_scorecard,
    "refreshed_qc_log": _refreshed_qc_log,
    "wkt_features": _wkt_features,
    "wkt_errors": _wkt_errors,
    "monthly_metric": _monthly_metric,
    "monthly_metric_stream": _monthly_metric_stream,
    "yearly_region_metric": _yearly_region_metric,
    "yearly_region_metric_stream": _yearly_region_metric_stream,
    "yearly_region_metric_changes": _yearly_region_metric_changes,
    "school_checks_stream": _school_checks_stream,
}


def entry(spark: SparkSession) -> DataFrame:
    """Yearly functionality rate per district."""
    return _wp_district_year(Inputs(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Inputs], DataFrame]):
        return lambda spark, sf_dir: build(Inputs(spark, sf_dir))

    bound = {name: bind(build) for name, build in QUERIES.items()}
    if llm_queries:
        more = llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
        bound |= {name: _importable(run) for name, run in more.items()}
    return bound


def _importable(run: Callable[[SparkSession, str], DataFrame]):
    """``run`` with Python workers that find this repository; a cluster gets the package as any other."""

    def with_path(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, environment = str(Path(__file__).resolve().parent), spark.sparkContext.environment
        known = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
        if root not in known:
            environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
        return run(spark, sf_dir)

    return with_path


def oracle_sql() -> dict[str, str]:
    sql = dict(oracle_queries.oracle_sql())
    if llm_queries:
        sql |= llm_queries.ORACLE
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
