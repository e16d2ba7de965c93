"""The two steps as jobs: raw -> curated, curated -> marts, and both chained.

Each job scans its input once per output and counts with ``observe``
(metrics gathered while the write runs) instead of separate ``count``
actions, so no table is read again just to be counted.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import marts
from tripmart.operators.curate import curate_trips
from tripmart.operators.enrich import check_zones
from tripmart.operators.quality import all_rules, passes
from tripmart.schemas import BATCH_COLUMN, CBD_FEE, CURATED_PARTITIONS
from tripmart.session import with_job_settings, work_dir
from tripmart.sinks import write_table
from tripmart.sinks.fs import children, exists, remove
from tripmart.sinks.publish import Publication, last_record
from tripmart.sources.mixed import raw_scans
from tripmart.sources.states import STATES, UNKNOWN, Day, days_of, recorded_states, states_frame
from tripmart.sources.tables import month_target, only_month, scan_curated


# Per-day partials kept beside the marts by increments (a leading "_" hides the directory
# from readers of the marts' root).
CUBE_DIR = "_daily_partials"


class EmptyInputError(ValueError):
    pass


class TableOwnedError(RuntimeError):
    pass


def guard_layout(spark: SparkSession, out: str, incremental: bool) -> None:
    """Refuse a curated table that the other mode owns: their layouts can't be mixed."""
    names = children(spark, out)
    batches = any(n.startswith(f"{BATCH_COLUMN}=") for n in names)
    plain = any(n.startswith(f"{CURATED_PARTITIONS[0]}=") for n in names)
    if plain if incremental else batches:
        owner = "a full rebuild" if incremental else "incremental runs"
        raise TableOwnedError(f"{out} is kept by {owner}; use another output folder")


@dataclass
class StepReport:
    input_rows: int = 0
    output_rows: dict[str, int] = field(default_factory=dict)

    @property
    def rejected_rows(self) -> int:
        return self.input_rows - self.output_rows.get("curated_trips", self.input_rows)

    def pct(self, table: str) -> float | None:
        """Output rows of ``table`` as a percentage of the input (None if empty)."""
        if not self.input_rows:
            return None
        return 100.0 * self.output_rows.get(table, 0) / self.input_rows


def curate_and_validate(raw: DataFrame | list[DataFrame], obs: Observation, use_cbd_fee: bool = False,
                        keep: tuple[str, ...] = ()) -> DataFrame:
    """Curated rows that pass every rule; input and valid counts go to ``obs``.

    Scans of different types are curated each by itself and united.
    """
    scans = raw if isinstance(raw, list) else [raw]
    curated = reduce(DataFrame.unionByName, [curate_trips(r, use_cbd_fee, keep) for r in scans])
    counted = curated.observe(
        obs,
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(passes()).alias("valid_rows"),
    )
    return counted.where(all_rules())


@with_job_settings
def build_curated(
    spark: SparkSession,
    raw_root: str,
    out: str,
    use_cbd_fee: bool = False,
    raw: DataFrame | None = None,
) -> StepReport:
    """Full rebuild of the curated table (replaces it), partitioned y/m/d."""
    guard_layout(spark, out, incremental=False)
    raw = raw_scans(spark, raw_root, (CBD_FEE,) if use_cbd_fee else ()) if raw is None else [raw]
    if all(r.isEmpty() for r in raw):
        raise EmptyInputError(f"no raw trips under {raw_root}")
    obs = Observation("curate")
    valid = curate_and_validate(raw, obs, use_cbd_fee)
    write_table(valid, out, CURATED_PARTITIONS, mode="overwrite")
    m = obs.get
    return StepReport(m["input_rows"], {"curated_trips": m["valid_rows"]})


@with_job_settings
def build_aggregates(
    spark: SparkSession,
    curated_root: str,
    zones: DataFrame,
    out_root: str,
    year: int | str | None = None,
    month: int | str | None = None,
    tables: tuple[str, ...] = tuple(marts.MARTS),
    curated: DataFrame | None = None,
    shared_scan: bool = True,
    on_empty: str = "fail",
) -> StepReport:
    """Rebuild the marts from the curated table (or the given ``curated`` rows).

    With ``year`` and ``month`` (both, or neither) only that month is read
    (partition pruning) and only its partitions are replaced; every other
    month of every mart is left as it is.

    All marts are published at once: a job that fails leaves every one as it was. A month
    without trips is an error, or with ``on_empty="drop"`` leaves the marts.

    With ``shared_scan`` and more than one mart, the curated rows are read
    once: their partials at the finest common grain are written to the
    shared checkpoint folder (which also cuts the lineage, so a lost
    executor never forces a rescan of the input) and every mart is rolled
    up from them.
    """
    target = month_target(year, month)
    from_path = curated is None
    if from_path:
        guard_marts(spark, out_root, curated_root)
    curated = scan_curated(spark, curated_root) if from_path else curated
    if target is not None:
        curated = only_month(curated, *target)
    if curated.isEmpty():
        if target is None or on_empty == "fail":
            raise EmptyInputError(f"no curated trips under {curated_root} for {target or 'all months'}")
        return _drop_month(spark, out_root, tables, target)
    zone_rows = check_zones(zones)
    mode = "overwrite" if target is None else "dynamic"
    obs = Observation("marts_input")
    counted = curated.observe(obs, F.count(F.lit(1)).alias("rows"))
    report = StepReport()
    cube_path = None
    if shared_scan and len(tables) > 1:
        cube_path = work_dir(spark, "marts-cube")
        write_table(marts.partials(counted, marts.CUBE_KEYS), cube_path)
        report.input_rows = obs.get["rows"]
        built = marts.marts_from_cube(spark.read.parquet(cube_path), zones, zone_rows)
    else:
        built = {
            name: marts.MARTS[name](counted if i == 0 else curated, zones, zone_rows)
            for i, name in enumerate(tables)
        }
    try:
        with Publication(spark, out_root) as pub:
            pub.info["curated_root"] = curated_root
            for i, name in enumerate(tables):
                out_obs = Observation(name)
                table = built[name].observe(out_obs, F.count(F.lit(1)).alias("rows"))
                pub.write(table, name, marts.MART_PARTITIONS[name], mode=mode)
                report.output_rows[name] = out_obs.get["rows"]
                if cube_path is None and i == 0:
                    report.input_rows = obs.get["rows"]
                if target is not None:  # days of the month that lost all their trips since the last refresh
                    pub.drop(name, _month_partitions(spark, f"{out_root}/{name}", target))
            days = _days_made(pub, curated, tables)
            _publish_states(pub, out_root, days, target, keep=from_path)
            pub.commit()
    finally:
        if cube_path is not None:
            remove(spark, cube_path)
    return report


def guard_marts(spark: SparkSession, out_root: str, curated_root: str) -> None:
    """Refuse marts whose partials come from another curated table."""
    made = last_record(spark, out_root)
    owner = made and made.get("curated_root")
    if owner and owner.rstrip("/") != curated_root.rstrip("/") and exists(spark, f"{out_root}/{CUBE_DIR}"):
        raise TableOwnedError(f"{out_root} is kept from {owner}; use another output folder")


def _days_made(pub: Publication, curated: DataFrame, tables: tuple[str, ...]) -> set[Day]:
    by_day = [n for n in tables if marts.MART_PARTITIONS[n] == CURATED_PARTITIONS]
    if by_day:
        return days_of(pub.partitions(by_day[0]))
    return {tuple(int(x) for x in r) for r in curated.select(*CURATED_PARTITIONS).distinct().collect()}


def _publish_states(pub: Publication, out_root: str, days: set[Day], target: tuple | None, keep: bool) -> None:
    """States after marts were made without partials.

    Days that had a state keep it if the rows came from the curated table: partials made from that state are as
    good as before, and a state that differs from the table's is stale anyway. All other
    days made here, and every day of replaced rows from elsewhere, count as unknown.
    """
    known = recorded_states(pub.spark, out_root)
    hit = {d for d in known if target is None or d[:2] == tuple(target)}
    states = {**dict.fromkeys(days, UNKNOWN), **{d: s if keep or d not in hit else UNKNOWN for d, s in known.items()}}
    pub.write(states_frame(pub.spark, states), STATES)


def _month_partitions(spark: SparkSession, mart_root: str, target: tuple) -> list[str]:
    """Partition folders of the target month under a mart, zero-padded or not."""
    found = []
    for y in children(spark, mart_root):
        for m in children(spark, f"{mart_root}/{y}") if y == f"year={int(target[0])}" else []:
            if m.startswith("month=") and int(m[6:]) == int(target[1]):
                days = [d for d in children(spark, f"{mart_root}/{y}/{m}") if d.startswith("day=")]
                found += [f"{y}/{m}/{d}" for d in days] or [f"{y}/{m}"]
    return found


def _drop_month(spark: SparkSession, out_root: str, tables: tuple[str, ...], target: tuple) -> StepReport:
    """Take a month that lost all its trips out of the marts."""
    with Publication(spark, out_root) as pub:
        for name in tables:
            pub.drop(name, _month_partitions(spark, f"{out_root}/{name}", target))
        pub.commit()
    return StepReport(0, dict.fromkeys(tables, 0))


def run_all(
    spark: SparkSession,
    raw_root: str,
    zones: DataFrame,
    curated_root: str,
    marts_root: str,
    year: int | str | None = None,
    month: int | str | None = None,
) -> dict[str, StepReport]:
    """Raw -> curated -> marts; the second step runs only if the first succeeded.

    ``year`` and ``month`` limit the second step to one month of the marts.
    """
    month_target(year, month)
    first = build_curated(spark, raw_root, curated_root)
    second = build_aggregates(spark, curated_root, zones, marts_root, year, month)
    return {"curate": first, "aggregate": second}
