"""Deliveries in any order: a row whose parents have not come yet waits, and is tried again with every later delivery."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from statline.operators.keys import keep_last
from statline.operators.links import mark_orphans
from statline.plans.clean import Store, clean_steps, typed
from statline.schemas import DATASETS, DELIVERY, SEQ
from statline.session import stored_in, work_dir
from statline.sources.warehouse import Warehouse

_LATE, _LAST = "_late", "_last"


@dataclass(frozen=True)
class Moved:
    """What a delivery did to one dataset: cleaned rows saved, and rows that wait after it."""

    saved: int
    waiting: int


def waiting_table(dataset: str) -> str:
    return f"{DATASETS[dataset].table}_waiting"


class Intake:
    """Raw deliveries into the tables of a warehouse.

    A row with all its parents is cleaned and saved under contract. One whose parent is missing waits as it came, under
    ``<table>_waiting``; a null key waits for nothing, its row is dropped as cleaning drops it. Datasets are tried parents
    first, so a parent that gets in with a delivery takes along all that waited for it, down to the last child. A parent
    is known once it has been cleaned, be it in the table or in its quarantine, as in :func:`statline.plans.clean.clean_all`.

    The last copy of a key is the one of the latest delivery, and in it the last by ``_seq``. A waiting copy is dropped once a
    later copy of its key has got in, so it cannot come back over it; of waiting copies with the same parents only the last is
    kept. ``_seq`` must have one type in all deliveries of a dataset.

    ``as_of`` is the day ages are taken on, by default that of the delivery a row gets in with.
    """

    def __init__(self, warehouse: Warehouse, as_of: dt.date | None = None, day_first: bool = False):
        self.warehouse, self.spark = warehouse, warehouse.spark
        self.as_of, self.day_first = as_of, day_first

    def waiting(self, dataset: str) -> DataFrame | None:
        """Rows that wait for a parent, None if none ever did."""
        return self.warehouse.read(waiting_table(dataset))

    def deliver(self, raw: Mapping[str, DataFrame], number: int) -> dict[str, Moved]:
        """Take a delivery of one or more datasets.

        Numbers of deliveries of a dataset must rise; repeating the last one, whole or after it died half way, changes nothing
        that it has done already. Pass stored or cheap rows, they are read twice.
        """
        store = stored_in(self.spark, work_dir(self.spark, "intake"))
        tag = f"{'+'.join(n for n in DATASETS if n in raw)}-{number}"
        moved: dict[str, Moved] = {}
        held: dict[str, DataFrame] = {}
        for name, spec in DATASETS.items():
            # Without new rows or a new parent nothing can move.
            if name not in raw and not any(moved[p].saved for p in spec.references.values() if p in moved):
                continue
            rows = self._rows(name, raw.get(name), number)
            if rows is not None:
                moved[name], held[name] = self._take(name, rows, tag, store)
        # Children first: should the job die in between, their parents still wait, get in again and try them again.
        for name in reversed(held):
            if moved[name].waiting or self.waiting(name) is not None:
                self.warehouse.write(waiting_table(name), held[name])
        return moved

    def _rows(self, name: str, incoming: DataFrame | None, number: int) -> DataFrame | None:
        """Everything of a dataset that is to be tried now, None if there is nothing."""
        parts, waiting = [], self.waiting(name)
        if incoming is not None:
            parts.append(typed(incoming, name).withColumn(DELIVERY, F.lit(number).cast("bigint")))
            if waiting is not None:  # what this very delivery left there before it was repeated
                waiting = waiting.filter(F.col(DELIVERY) != number)
        if waiting is not None:
            parts.append(waiting)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None

    def _known(self, name: str) -> DataFrame:
        """Keys of the cleaned rows of a parent, saved or kept in quarantine."""
        spec = DATASETS[name]
        key, stored = spec.key[0], self.warehouse.read(spec.table)
        broken = self.warehouse.read(f"{spec.table}_quarantine")
        keys = [] if stored is None else [stored.select(key)]
        if broken is not None:
            keys.append(broken.select(key).distinct())
        return reduce(DataFrame.union, keys) if keys else self.spark.createDataFrame([], f"{key} string")

    def _take(self, name: str, rows: DataFrame, tag: str, store: Store) -> tuple[Moved, DataFrame]:
        """Save what has its parents; gives back what is to wait."""
        spec = DATASETS[name]
        parents = {column: (self._known(parent), DATASETS[parent].key[0]) for column, parent in spec.references.items()}
        found, got_in = Observation(), Observation()
        marked = mark_orphans(rows, parents, _LATE, lambda c, keys: store(f"{name}_without_{c}", keys))
        counts = [F.count_if(~F.col(_LATE)).alias("linked"), F.count_if(_LATE).alias("late")]
        marked = store(f"{name}_marked", marked.observe(found, *counts))
        linked, late = marked.filter(~F.col(_LATE)).drop(_LATE), marked.filter(_LATE).drop(_LATE)
        saved = waiting = 0
        if found.get["linked"]:
            step = clean_steps(self.as_of, self.day_first, (DELIVERY, SEQ))[name]
            cleaned = step(linked, *[None] * len(parents)).observe(got_in, F.count(F.lit(1)).alias("n"))
            self.warehouse.save(name, store(f"{name}_cleaned", cleaned), tag)
            saved = got_in.get["n"]
        if found.get["late"]:
            kept = Observation()
            late = store(f"{name}_held", self._held(name, linked, late).observe(kept, F.count(F.lit(1)).alias("n")))
            waiting = kept.get["n"]
        return Moved(saved, waiting), late

    def _held(self, name: str, linked: DataFrame, late: DataFrame) -> DataFrame:
        """Late rows that no later copy of their key has overtaken, one of each set of parents."""
        spec, place = DATASETS[name], F.struct(DELIVERY, SEQ)
        key = list(spec.key)
        overtaking = linked.select(*key, place.alias(_LAST)).join(late.select(*key).distinct(), key, "left_semi")
        last = overtaking.groupBy(*key).agg(F.max(_LAST).alias(_LAST))
        kept = late.join(last, key, "left").filter(F.col(_LAST).isNull() | (place > F.col(_LAST)))
        copies = list(dict.fromkeys([*key, *spec.references]))
        return keep_last(kept.select(late.columns), copies, (DELIVERY, SEQ))
