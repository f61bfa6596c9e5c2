"""Load raw events from an existing event table: whole ranges first, then only what changed.

The state of a source is its log: how far a range load got, and the high-water mark of ``updated``.
The mark is taken from the rows themselves, so clocks that differ between machines cannot make a
later load skip anything.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismic_lake.functions.text import to_number, to_timestamp
from seismic_lake.operators.incremental import changed_since, next_mark
from seismic_lake.plans.clean_usgs import RAW
from seismic_lake.sources.lake import Lake, MissingInput
from seismic_lake.sources.raw_events import land_raw
from seismic_lake.vocab import RAW_EVENT_COLUMNS, RAW_EVENT_SCHEMA

LOADED = "loaded"
STATE = "state/usgs"
# Fixed values.
DEFAULT_MIN_MAG = 2.0
DEFAULT_LOOKBACK_DAYS = 30
SOURCE = "usgs"


def _selected(
    source: DataFrame, mark: datetime | None, begin: datetime, end: datetime, min_mag: float
) -> DataFrame:
    """Source rows, still as text, whose typed time, update and magnitude qualify."""
    names = [c for c in RAW_EVENT_COLUMNS if c in source.columns]
    text = F.struct(*names)
    typed = source.select(
        text.alias("row"),
        to_timestamp(F.col("time")).alias("event_time"),
        to_timestamp(F.col("updated")).alias("updated_at"),
        to_number(F.col("mag")).alias("mag"),
    )
    return changed_since(typed, mark, begin, end, min_mag).select("row.*")


def _parse(text: str) -> datetime:
    return datetime.fromisoformat(text).astimezone(timezone.utc)


def state(lake: Lake) -> dict:
    """Summary of the last load, empty before the first."""
    last = lake.newest(STATE, LOADED)
    return last.summary if last else {}


def _load(lake: Lake, rows: DataFrame, run_id: str, now: datetime, known: dict, progress: dict) -> dict:
    land_raw(rows, lake.path(RAW), run_id, SOURCE)
    folder = f"{lake.path(RAW)}/run_id={run_id}"
    landed = lake.spark.read.schema(RAW_EVENT_SCHEMA).parquet(folder)
    mark = next_mark(landed.select(to_timestamp(F.col("updated")).alias("updated_at")))
    got = mark.select(F.unix_micros("max_updated").alias("mark"), "events").first()
    marks = [known["max_updated"]] if "max_updated" in known else []
    if got["mark"] is not None:
        moment = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=got["mark"])
        marks.append(moment.isoformat())
    summary = known | progress | {"last_run_id": run_id, "last_run_events": got["events"]}
    if marks:
        summary["max_updated"] = max(marks, key=_parse)
    lake.record(STATE, LOADED, run_id, now, folder, summary)
    return summary


def load_range(
    lake: Lake,
    source: DataFrame,
    start: datetime,
    end: datetime,
    run_id: str,
    now: datetime,
    min_mag: float = DEFAULT_MIN_MAG,
    restart: bool = False,
) -> dict:
    """Load every event of a range. Loading the same start again goes on where it ended.

    Another start is another job and loads its whole range; so does ``restart``. The run is
    recorded after its rows are written, so a lost run is simply loaded again.
    """
    known = state(lake)
    key = start.astimezone(timezone.utc).isoformat()
    begin = start
    if not restart and known.get("range_start") == key:
        begin = max(start, _parse(known["range_done_until"]))
    if begin >= end:
        return known
    progress = {"range_start": key, "range_done_until": end.astimezone(timezone.utc).isoformat()}
    return _load(lake, _selected(source, None, begin, end, min_mag), run_id, now, known, progress)


def load_changes(
    lake: Lake,
    source: DataFrame,
    run_id: str,
    now: datetime,
    min_mag: float = DEFAULT_MIN_MAG,
    lookback_days: int = DEFAULT_LOOKBACK_DAYS,
) -> dict:
    """Load recent events that are new or were revised since the high-water mark."""
    known = state(lake)
    if "max_updated" not in known:
        raise MissingInput("nothing was loaded yet; load a range first")
    begin = now - timedelta(days=lookback_days)
    rows = _selected(source, _parse(known["max_updated"]), begin, now, min_mag)
    return _load(lake, rows, run_id, now, known, {})
