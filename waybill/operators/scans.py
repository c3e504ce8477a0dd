"""Running values per key over rows in order, without gathering a key in one task.

Rows are numbered by a range-partitioned sort on (key, order): the boundaries are sampled, so a key
with half of all rows gets half of the partitions, whatever its times are. A slice is ``SLICE``
consecutive rows of a key, so its size does not depend on the data, and all work is done a slice at
a time: ``placed`` links a slice to the last row of the one before, ``run`` drives a state machine.

A state machine's steps compose: what a slice does is a map from the state before it to the state
behind it, one number a state, and the map of many slices is the composition of theirs. So the maps
of slices are composed in groups of ``SLICE`` again, level by level, until a key is one map; then
the states come down: each group passes every member the state it begins in. Two levels carry
a key of a million rows at 1,024 a slice, three a thousand million. Keys of one slice need none of
this: ``run`` counts the rows of each key first, and only larger keys are numbered and sliced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.operators import storage

C = F.col
SLICE = 1024


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             position: str = "position") -> DataFrame:
    """Adds the row's place (from 0) within its key by ``order``, nulls first.

    Rows that agree in key and order have any order among them. The sorted rows are a table, so
    that places are the same whenever they are read. Every partition is counted once per key; the
    sums before each are over partitions, not rows.
    """
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    stored = storage.kept(
        df.repartitionByRange(*by).sortWithinPartitions(*by)
        # the number of a row in its sorted partition, and the partition
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33)), "numbered")
    parts = stored.groupBy(*keys, "_part").agg(F.min("_id").alias("_first"),
                                               F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select(*(C(k).alias(f"_k{i}") for i, k in enumerate(keys)),
                         C("_part").alias("_p"),
                         (F.coalesce(F.sum("_n").over(before), F.lit(0)) - C("_first"))
                         .alias("_shift"))
    same = [C(k).eqNullSafe(C(f"_k{i}")) for i, k in enumerate(keys)]
    return stored.join(shift, [C("_part") == C("_p"), *same]).select(
        *df.columns, (C("_id") + C("_shift")).alias(position))


def _slice(size: int, position: str = "position") -> Column:
    return F.floor(C(position) / size).cast("long")


def placed(df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str],
           size: int = SLICE, sequence: str = "sequence", previous: str = "previous") -> DataFrame:
    """Adds the row's number within its key (from 1) and a struct of the ``carry`` columns of the
    row before it."""
    rows = numbered(df, keys, order, "_pos").withColumn("_slice", _slice(size, "_pos"))
    rows = rows.withColumn("_carry", F.struct(*carry))
    inside = Window.partitionBy(*keys, "_slice").orderBy("_pos")
    last = rows.filter(C("_pos") % size == size - 1).select(
        *(C(k).alias(f"_k{i}") for i, k in enumerate(keys)), (C("_slice") + 1).alias("_next"),
        C("_carry").alias("_edge"))
    same = [C(k).eqNullSafe(C(f"_k{i}")) for i, k in enumerate(keys)]
    linked = rows.withColumn("_lag", F.lag("_carry").over(inside)).join(
        last, [C("_slice") == C("_next"), *same], "left")
    return linked.select(*df.columns, (C("_pos") + 1).alias(sequence),
                         F.coalesce("_lag", "_edge").alias(previous))


@dataclass(frozen=True)
class Machine:
    """States, and for (state, event) the state behind it; other events change nothing and are
    not allowed."""

    states: tuple[str, ...]
    events: tuple[str, ...]
    steps: Mapping[tuple[str, str], str]
    start: str

    def table(self) -> list[int]:
        """The state behind each state and event; the last event of each is any unknown one."""
        number = {s: i for i, s in enumerate(self.states)}
        return [number[self.steps.get((s, e), s)] for s in self.states for e in (*self.events, "")]

    def allows(self) -> list[bool]:
        return [(s, e) in self.steps for s in self.states for e in (*self.events, "")]

    def event(self, value: Column) -> Column:
        """The event's number; unknown ones and nulls get the last."""
        known = F.lit(len(self.events))
        for i, e in enumerate(self.events):
            known = F.when(value == e, F.lit(i)).otherwise(known)
        return known

    def name(self, state: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, self.states)), state + 1)


def run(df: DataFrame, keys: Sequence[str], order: Sequence[str], event: str, machine: Machine,
        size: int = SLICE, before: str = "state_before", allowed: str = "allowed") -> DataFrame:
    """Adds the state each row meets and whether the machine allows its event there.

    Rows travel once: a key of at most ``size`` rows is one array. Larger keys go by slices.
    """
    keys, order = list(keys), list(order)
    rows = storage.kept(df, "events")
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    large = storage.kept(counts.filter(C("_n") > size).select(
        *(C(k).alias(f"_l{i}") for i, k in enumerate(keys))), "large-keys")
    if large.isEmpty():
        return _whole(rows, keys, order, event, machine, before, allowed)
    same = [C(k).eqNullSafe(C(f"_l{i}")) for i, k in enumerate(keys)]
    return _whole(rows.join(large, same, "left_anti"), keys, order, event, machine, before,
                  allowed).unionByName(
        _sliced(rows.join(large, same, "left_semi"), keys, order, event, machine, size, before,
                allowed))


def _steps(machine: Machine):  # noqa: ANN202
    """(the state behind a state and an event, whether the event is allowed there)."""
    width = len(machine.events) + 1
    table = F.array(*map(F.lit, machine.table()))
    permits = F.array(*map(F.lit, machine.allows()))
    return (lambda state, number: F.element_at(table, state * width + number + 1),
            lambda state, number: F.element_at(permits, state * width + number + 1))


def _whole(rows: DataFrame, keys: list[str], order: list[str], event: str, machine: Machine,
           before: str, allowed: str) -> DataFrame:
    """Keys of few rows each: the rows of a key are sorted in one array."""
    then, permits = _steps(machine)
    rest = [c for c in rows.columns if c not in keys]
    # exchanged as plain rows: collecting on the map side, too, would sort all rows there
    groups = rows.repartition(*keys).groupBy(*keys).agg(F.collect_list(F.struct(
        F.struct(*order).alias("by"), machine.event(C(event)).alias("event"),
        F.struct(*rest).alias("row"))).alias("_items"))
    # sorted by place in the array, since a row may hold what has no order
    places = F.sort_array(F.transform("_items", lambda x, i: F.struct(x["by"], i.alias("i"))))
    groups = groups.select(*keys, F.transform(places, lambda p: F.get(C("_items"), p["i"]))
                           .alias("_members"))
    out = groups.select(*keys, F.explode(_states(
        C("_members"), F.lit(machine.states.index(machine.start)),
        lambda s, x: then(s, x["event"]))).alias("_m"))
    return out.select(*(C(c) if c in keys else C(f"_m.item.row.`{c}`") for c in rows.columns),
                      machine.name(C("_m.state")).alias(before),
                      permits(C("_m.state"), C("_m.item.event")).alias(allowed))


def _sliced(df: DataFrame, keys: list[str], order: list[str], event: str, machine: Machine,
            size: int, before: str, allowed: str) -> DataFrame:
    """Keys of any size, slice by slice."""
    then, permits = _steps(machine)
    names = [f"_g{i}" for i in range(len(keys))]
    rows = numbered(df.select(F.struct(*df.columns).alias("_row"),
                              *(C(k).alias(n) for k, n in zip(keys, names, strict=True)),
                              *(C(o).alias(f"_o{i}") for i, o in enumerate(order)),
                              machine.event(C(event)).alias("_event")),
                    names, [f"_o{i}" for i in range(len(order))], "_pos").select(
        *names, "_pos", "_event", "_row").withColumn("_slice", _slice(size, "_pos"))

    def members(*columns: str) -> Column:
        return F.array_sort(F.collect_list(F.struct("_pos", *columns)),
                            lambda a, b: (a["_pos"] - b["_pos"]).cast("int"))

    every = F.array(*(F.lit(i) for i in range(len(machine.states))))
    # up: a map for every slice, then for groups of slices
    levels = [storage.kept(rows.groupBy(*names, "_slice").agg(F.aggregate(
        F.transform(members("_event"), lambda x: x["_event"]), every,
        lambda m, e: F.transform(m, lambda s: then(s, e))).alias("_map")).withColumnRenamed(
        "_slice", "_pos"), "maps")]
    while (levels[-1].agg(F.max("_pos")).first()[0] or 0) > 0:
        levels.append(storage.kept(levels[-1].groupBy(*names, _slice(size, "_pos").alias("_slice"))
                                   .agg(F.aggregate(
                                       F.transform(members("_map"), lambda x: x["_map"]), every,
                                       lambda m, n: F.transform(m, lambda s: F.element_at(n, s + 1)))
                                       .alias("_map")).withColumnRenamed("_slice", "_pos"), "maps"))
    # down: the state in which every member begins
    begin = levels[-1].select(*names, "_pos", F.lit(machine.states.index(machine.start))
                              .alias("_state"))
    for level in reversed(levels[:-1]):
        groups = level.groupBy(*names, _slice(size, "_pos").alias("_slice")).agg(
            members("_map").alias("_members"))
        begin = storage.kept(_joined(groups, begin, names).select(*names, F.explode(_states(
            C("_members"), C("_state"), lambda s, x: F.element_at(x["_map"], s + 1))).alias("_m"))
            .select(*names, "_m.item._pos", "_m.state").withColumnRenamed("state", "_state"),
            "begins")
    slices = rows.groupBy(*names, "_slice").agg(members("_event", "_row").alias("_members"))
    out = _joined(slices, begin, names).select(F.explode(_states(
        C("_members"), C("_state"), lambda s, x: then(s, x["_event"]))).alias("_m"))
    state, at = C("_m.state"), C("_m.item._event")
    return out.select("_m.item._row.*", machine.name(state).alias(before),
                      permits(state, at).alias(allowed))


def _joined(groups: DataFrame, begin: DataFrame, names: list[str]) -> DataFrame:
    right = begin.select(*(C(n).alias(f"{n}r") for n in names), C("_pos").alias("_at"), "_state")
    return groups.join(right, [C("_slice") == C("_at"),
                               *(C(n).eqNullSafe(C(f"{n}r")) for n in names)])


def _states(items: Column, start: Column, then) -> Column:  # noqa: ANN001
    """(item, state before it) of the items in order."""
    def add(seen: Column, x: Column) -> Column:
        return F.struct(then(seen["state"], x).alias("state"),
                        F.concat(seen["all"], F.array(seen["state"])).alias("all"))

    nothing = F.struct(start.alias("state"), F.array().cast("array<int>").alias("all"))
    states = F.aggregate(items, nothing, add, lambda seen: seen["all"])
    return F.arrays_zip(items.alias("item"), states.alias("state"))
