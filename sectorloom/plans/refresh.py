"""Rebuild of all marts in their fixed order."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import run_number
from ..sources.stores import Store
from . import coverage, households, lookups, school_quality, schools, scorecard, water_points

log = logging.getLogger(__name__)

SCHOOL_SOURCES = (
    "school_services",
    "school_reports",
    "school_infrastructure",
    "school_enrollment",
)


# How the text of a processing error begins, by kind.
ERRORS = (
    "Table Creation Error: ",
    "Alter Table Error: ",
    "Derived Fields Computation Error: ",
    "Data Enrichment Error: ",
    "LGA Summary Table Creation Error: ",
)


@dataclass(frozen=True)
class Run:
    """Parameters of one refresh; the same run on the same inputs gives the same marts."""

    as_of: dt.date
    year: int
    run_ts: dt.datetime
    low_rows: int
    high_rows: int

    @property
    def number(self) -> int:
        """What the partitions of this run in the logs are named after."""
        return run_number(self.run_ts)


@dataclass(frozen=True)
class Step:
    name: str
    needs: tuple[str, ...]
    build: Callable[[Store, Run], None]


class MissingTables(RuntimeError):
    def __init__(self, step: str, names: Sequence[str]):
        super().__init__(f"{step}: missing dependency: {', '.join(names)}")
        self.names = list(names)


def build_shapes(store: Store, run: Run) -> None:
    lgas, shapes = store.read("lgas"), store.read("lga_shapes")
    store.replace("lga_with_shape", lookups.lgas_with_shape(lgas, shapes))
    store.replace("unmatched_lga_names", lookups.unmatched_lga_names(lgas, shapes))


def build_admin_lookup(store: Store, run: Run) -> None:
    store.replace(
        "admin_lookup",
        lookups.admin_lookup(
            store.read("lga_with_shape"), store.read("districts"), store.read("regions")
        ),
    )


def build_admin_lookup_light(store: Store, run: Run) -> None:
    store.replace(
        "admin_lookup_light", lookups.admin_lookup_light(store.read("admin_lookup"))
    )


def build_schools(store: Store, run: Run) -> None:
    sources = {name: store.read(name) for name in SCHOOL_SOURCES}
    combined = store.replace(
        "school_combined",
        schools.school_combined(*sources.values(), store.read("admin_lookup"), run.year),
    )
    presence = school_quality.key_presence(
        sources["school_services"],
        sources["school_reports"],
        sources["school_infrastructure"],
        combined,
        run.year,
    )
    store.replace(school_quality.KEY_TABLE, school_quality.failing_keys(presence, combined))
    rejects = store.replace("school_rejects", schools.rejected_counts(sources["school_enrollment"]))
    store.replace("reject_counts", schools.reject_counts(rejects))
    entries = school_quality.qc_log(presence, combined, run.run_ts)
    store.record("qc_log", entries, run.number, "schools")


def build_school_quality(store: Store, run: Run) -> None:
    sources = {name: store.read(name) for name in SCHOOL_SOURCES}
    combined = store.read("school_combined")
    store.replace(
        "table_counts", school_quality.table_counts(sources, run.low_rows, run.high_rows)
    )
    store.replace("toilet_share", school_quality.toilet_share(combined))
    store.replace("water_share", school_quality.water_share(combined))
    store.replace("uncoded_sources", school_quality.uncoded_sources(combined))
    store.replace("no_toilet_type", school_quality.no_toilet_type(combined))
    store.replace(
        "null_profile", school_quality.null_profile(sources["school_infrastructure"], sources)
    )


def build_water_points(store: Store, run: Run) -> None:
    admin = store.read("admin_lookup")
    detail = store.replace(
        "water_point_detail",
        water_points.detail_by_month(store.read("water_point_reports"), admin),
        partition_by=["month_timestamp"],
        spread=True,
    )
    store.replace("status_summary", water_points.status_share(detail))
    yearly = store.replace(
        "water_point_district_year", water_points.district_rates(detail, admin)
    )
    store.replace("districts_without_functional", water_points.without_functional(yearly))
    store.replace(
        "water_point_district_quarter",
        water_points.district_rates(detail, admin, water_points.QUARTER),
    )


def build_coverage(store: Store, run: Run) -> None:
    reports, admin = store.read("coverage_reports"), store.read("admin_lookup")
    store.replace("coverage_district_year", coverage.coverage_yearly(reports, admin))
    store.replace("coverage_district_latest", coverage.coverage_latest(reports, admin))


def build_households(store: Store, run: Run) -> None:
    """Each part of the build has its own kind of error, also where its rows fail while the mart is written.

    Reading and writing the table is the first kind.
    """
    regions, lgas = store.read("regions"), store.read("lga_with_shape")
    with error_flag(store, run, 0):
        reports = store.read("household_reports")
    with error_flag(store, run, 1):
        households.check_computed(reports)
    with error_flag(store, run, 2):
        rates = households.household_rates(reports)
    with error_flag(store, run, 3):
        named = households.with_names(rates, regions, lgas)
    with error_flag(store, run, 0, [(0, reports), (2, rates), (3, named)]):
        detail = store.replace("household_detail", named)
    flags = households.quality_flags(detail, run.run_ts)
    store.record("quality_flags", flags, run.number, "households")
    with error_flag(store, run, 4):
        store.replace("household_lga", households.lga_means(detail, regions, lgas))


def build_located_points(store: Store, run: Run) -> None:
    store.replace(
        "water_point_latest",
        water_points.latest_located(
            store.read("water_point_detail"),
            store.read("admin_lookup"),
            store.read("villages"),
            run.as_of,
        ),
    )


def build_scorecard(store: Store, run: Run) -> None:
    lgas, detail = store.read("lga_with_shape"), store.read("household_detail")
    levels = store.replace("service_level_lga", scorecard.service_levels(store.read("villages")))
    store.swap(
        "lga_scorecard",
        scorecard.lga_scorecard(
            lgas,
            store.read("districts"),
            scorecard.household_scores(detail),
            scorecard.school_scores(store.read("school_combined")),
            store.read("water_point_district_year"),
            levels,
        ),
    )
    store.replace(
        "household_lga_by_date",
        households.lga_means_by_date(detail, store.read("regions"), lgas),
    )


# In this order every step finds the marts it needs.
STEPS = (
    Step("shapes", ("lgas", "lga_shapes"), build_shapes),
    Step("admin lookup", ("districts", "regions", "lga_with_shape"), build_admin_lookup),
    Step("light lookup", ("admin_lookup",), build_admin_lookup_light),
    Step("schools", (*SCHOOL_SOURCES, "admin_lookup"), build_schools),
    Step("school quality", (*SCHOOL_SOURCES, "school_combined"), build_school_quality),
    Step("water points", ("water_point_reports", "admin_lookup"), build_water_points),
    Step("coverage", ("coverage_reports", "admin_lookup"), build_coverage),
    Step("households", ("household_reports", "regions", "lga_with_shape"), build_households),
    Step(
        "located points", ("water_point_detail", "admin_lookup", "villages"), build_located_points
    ),
    Step(
        "scorecard",
        (
            "villages",
            "districts",
            "regions",
            "lga_with_shape",
            "household_detail",
            "school_combined",
            "water_point_district_year",
        ),
        build_scorecard,
    ),
)


def refresh_all(store: Store, run: Run, steps: Sequence[Step] = STEPS) -> None:
    """Run the steps in order; each first checks that its tables exist."""
    for step in steps:
        absent = store.missing(step.needs)
        if absent:
            raise MissingTables(step.name, absent)
        step.build(store, run)
        log.info("%s: done", step.name)


def preflight(store: Store, names: Sequence[str]) -> DataFrame:
    """The names that have no table yet."""
    return store.spark.createDataFrame([(n,) for n in store.missing(names)], "table_name string")


class error_flag:
    """Record a failed build as a quality flag, then let the error go on.

    The flag is written outside the failed job and stays. Where the failed job computes several ``parts``, (kind, rows)
    in the order in which they build on each other, the kind is that of the first whose rows fail on their own; if none
    does, it is ``kind``. They are computed only after a failure, and nothing is kept of them.
    """

    def __init__(self, store: Store, run: Run, kind: int, parts: Sequence[tuple[int, DataFrame]] = ()):
        self.store, self.run, self.kind, self.parts = store, run, kind, parts

    def _failed(self) -> int:
        for kind, rows in self.parts:
            try:
                rows.write.format("noop").mode("overwrite").save()
            except Exception:  # noqa: BLE001 - the first error is the one that is raised and told
                return kind
        return self.kind

    def __enter__(self):
        return self

    def __exit__(self, kind, error, trace):
        if error is not None:
            failed = self._failed()
            number = self.run.number + 50 + failed
            flag = self.store.spark.range(1).select(
                F.lit(number).cast("bigint").alias("id"),
                F.lit("processing_error").alias("error_alert_type"),
                F.lit(ERRORS[failed] + str(error)).alias("description"),
                F.lit("").alias("resolution_remarks"),
            )
            rows = households.flag_columns(flag, self.run.run_ts)
            self.store.record("quality_flags", rows, self.run.number, f"error-{failed}")
        return False
