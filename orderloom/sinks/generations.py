"""Compaction of the tables that have one folder per micro-batch.

Batches that cannot run again are folded into generations: few, large folders beside the table. A notice, which appears
whole by a rename, names the generations in force and the batches that the newest of them took over; readers leave those
batches' own folders out from then on. So at every moment, also at a crash between any two steps, a row is read once.
What a fold replaced is deleted by the next fold, so that queries already planned still find their files.

The last batch of a stream may be repeated, so it is never folded. ``FAN_IN`` generations of one level become one of the
next, so that a row is rewritten as often as the number of batches has digits to that base."""

from __future__ import annotations

import json
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

from orderloom import schemas

if TYPE_CHECKING:
    from orderloom.sinks.warehouse import Warehouse

COMPACTED = {"rejects": schemas.REJECTS, "batch_metrics": schemas.BATCH_METRICS, "touched_dates": schemas.TOUCHED_DATES}
# Batch folders from which a table is folded, and generations of a level that are merged.
BATCH_FOLDERS, FAN_IN = 64, 16
_EMPTY = {"number": 0, "generations": [], "folded": [], "merged": []}


def _place(warehouse: Warehouse, table: str, name: str = "") -> str:
    return f"{warehouse.path(table)}_generations/{name}".rstrip("/")


def notice(warehouse: Warehouse, table: str) -> dict:
    """The newest notice. A folder with one file for each of the last folds is listed."""
    numbers = [int(name[1:]) for name in warehouse.names(_place(warehouse, table)) if name[1:].isdecimal() and name[0] == "n"]
    return json.loads(warehouse.read_text(_place(warehouse, table, f"n{max(numbers)}"))) if numbers else _EMPTY


def with_generations(warehouse: Warehouse, table: str, batches: DataFrame) -> DataFrame:
    """``batches``, the rows of the batch folders, without those taken over, and the rows of the generations."""
    now = notice(warehouse, table)
    layout = list(COMPACTED[table])
    if now["folded"]:
        batches = batches.filter(~F.col("ingest_batch").isin(now["folded"]))
    return batches.select(*layout).union(_stored(warehouse, table, now["generations"])) if now["generations"] else batches


def _stored(warehouse: Warehouse, table: str, names: list[str]) -> DataFrame:
    paths = [_place(warehouse, table, name) for name in names]
    return warehouse.spark.read.schema(schemas.ddl(COMPACTED[table])).parquet(*paths).select(*COMPACTED[table])


def closed_batches(labels: list[str]) -> list[str]:
    """Those batches that a later one of the same stream has followed. Labels are ``<stream>-<number>``; others may be
    repeated at any time and stay."""
    last: dict[str, int] = {}
    numbered = [(label, *label.rpartition("-")[::2]) for label in labels]
    numbered = [(label, stream, int(number)) for label, stream, number in numbered if stream and number.isdecimal()]
    for _, stream, number in numbered:
        last[stream] = max(number, last.get(stream, number))
    return sorted(label for label, stream, number in numbered if number < last[stream])


def fold(warehouse: Warehouse, table: str, folders: int = BATCH_FOLDERS, fan_in: int = FAN_IN) -> bool:
    """Fold the closed batches of ``table`` if there are more than ``folders`` of them. One writer at a time."""
    now = notice(warehouse, table)
    present = [name.partition("=")[2] for name in warehouse.names(warehouse.path(table)) if name.startswith("ingest_batch=")]
    closed = closed_batches([label for label in present if label not in set(now["folded"])])
    if len(closed) <= folders:
        return False
    for label in now["folded"]:
        warehouse.drop_partition(table, label)
    for name in now["merged"]:
        warehouse.drop_folder(_place(warehouse, table, name))

    number = now["number"] + 1
    rows = warehouse.read_folders(table, closed).select(*COMPACTED[table])
    merged, level = [], 0
    while len(same := [name for name in now["generations"] if name.endswith(f"l{level}")]) >= fan_in - 1:
        merged += same
        level += 1
    if merged:
        rows = rows.union(_stored(warehouse, table, merged))
    name = f"g{number}l{level}"
    # A fold that was cut off before its notice left a folder of this name, which nobody reads.
    rows.hint("rebalance").write.mode("overwrite").parquet(_place(warehouse, table, name))
    kept = [other for other in now["generations"] if other not in merged]
    text = json.dumps({"number": number, "generations": [*kept, name], "folded": closed, "merged": merged})
    warehouse.write_text(_place(warehouse, table, f"n{number}"), text)
    if number > 2:
        warehouse.drop_files([_place(warehouse, table, f"n{number - 2}")])
    return True


def fold_batches(warehouse: Warehouse, folders: int = BATCH_FOLDERS) -> list[str]:
    """Fold each table that has many batch folders; names those that were."""
    return [table for table in COMPACTED if fold(warehouse, table, folders)]
