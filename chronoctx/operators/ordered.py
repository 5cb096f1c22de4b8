"""Running values over ordered groups, whatever the size of a group.

A window over ``PARTITION BY key ORDER BY ...`` puts a whole key into one
task. That is right for ordinary keys, and they run that way here. Keys with
more than ``hot_rows`` rows are cut into consecutive runs with a range
partitioning on (key, order), stored once and computed run by run; what the
earlier runs add up to (one small row per run) is then joined to each run. The
results are those of the plain window.

Finding the hot keys takes one counting pass, so store rows that are expensive
to compute (``plans.session.store``) before grouping them.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from chronoctx.plans.session import store

HOT_ROWS = 4_000_000

_RUN = "_run"

_KINDS = {
    "sum": (F.sum, lambda local, carry: local + carry),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def _direction(name: str) -> Column:
    return F.col(name[1:]).desc() if name.startswith("-") else F.col(name).asc()


def _equal(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def _runs(df: DataFrame, keys: list[str], order: list[str], runs: int) -> DataFrame:
    """Rows cut into ``runs`` consecutive runs of about the same size, stored:
    the cuts are sampled, so every later use has to see the same ones."""
    ranged = df.repartitionByRange(int(runs), *[F.col(k) for k in keys], *[_direction(o) for o in order])
    return store(ranged.withColumn(_RUN, F.spark_partition_id()), "runs")


@dataclass(frozen=True)
class OrderedGroups:
    """Rows in ordered groups: ``cold`` groups whole, ``hot`` ones in runs.

    ``order`` lists column names, with a leading ``-`` for descending ones; it
    must be total within a group.
    """

    keys: list[str]
    order: list[str]
    cold: DataFrame | None
    hot: DataFrame | None = None
    helper: str | None = None

    @staticmethod
    def of(df: DataFrame, keys: list[str], order: list[str], hot_rows: int = HOT_ROWS) -> "OrderedGroups":
        """Group ``df``; with no ``keys`` all rows make one group, which is
        always cut into runs, so that no task gets all of it."""
        if not keys:
            whole = df.withColumn("_all", F.lit(0))
            cores = df.sparkSession.sparkContext.defaultParallelism
            runs = max(cores, -(-df.count() // hot_rows))
            return OrderedGroups(["_all"], order, None, _runs(whole, ["_all"], order, runs), "_all")
        counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)
        total = counts.agg(F.sum("_n")).first()[0]
        if not total:
            return OrderedGroups(keys, order, df)
        hot_keys = store(counts.select(*keys), "hot-keys")
        hot = df.join(hot_keys, _equal(df, hot_keys, keys), "left_semi")
        cold = df.join(hot_keys, _equal(df, hot_keys, keys), "left_anti")
        return OrderedGroups(keys, order, cold, _runs(hot, keys, order, -(-total // hot_rows)))

    def map(self, body) -> "OrderedGroups":
        """Apply a row-wise ``DataFrame -> DataFrame`` to all rows."""
        cold, hot = (None if part is None else body(part) for part in (self.cold, self.hot))
        return replace(self, cold=cold, hot=hot)

    def lag(self, **columns: str) -> "OrderedGroups":
        """Add the value of a column on the previous row of the group."""
        def add(df: DataFrame, window: WindowSpec) -> DataFrame:
            return df.withColumns({n: F.lag(source).over(window) for n, source in columns.items()})

        cold = None if self.cold is None else add(self.cold, self._window(self.keys))
        hot = None
        if self.hot is not None:
            window = self._window([*self.keys, _RUN])
            # the last row of a run comes before the first row of the next one
            ends = self.hot.withColumn("_is_end", F.lead(F.lit(1)).over(window).isNull()).filter("_is_end")
            carry = ends.select(*self.keys, _RUN, *[
                F.lag(source).over(Window.partitionBy(*self.keys).orderBy(_RUN)).alias(f"_carry_{n}")
                for n, source in columns.items()
            ])
            first = F.lag(F.lit(1)).over(window).isNull()
            hot = self._join_runs(add(self.hot.withColumn("_first", first), window), carry)
            hot = hot.withColumns({
                n: F.when(F.col("_first"), F.col(f"_carry_{n}")).otherwise(F.col(n)) for n in columns
            }).drop("_first", *[f"_carry_{n}" for n in columns])
        return replace(self, cold=cold, hot=hot)

    def running(self, **columns: tuple[str, Column]) -> "OrderedGroups":
        """Add running aggregates ``name=("sum" | "min" | "max", value)`` over
        the rows of the group up to and with the current one."""
        def add(df: DataFrame, keys: list[str]) -> DataFrame:
            window = self._window(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
            return df.withColumns({n: _KINDS[kind][0](value).over(window) for n, (kind, value) in columns.items()})

        cold = None if self.cold is None else add(self.cold, self.keys)
        hot = None
        if self.hot is not None:
            totals = self.hot.groupBy(*self.keys, _RUN).agg(
                *[_KINDS[kind][0](value).alias(f"_total_{n}") for n, (kind, value) in columns.items()]
            )
            before = Window.partitionBy(*self.keys).orderBy(_RUN).rowsBetween(Window.unboundedPreceding, -1)
            carry = totals.select(*self.keys, _RUN, *[
                _KINDS[kind][0](f"_total_{n}").over(before).alias(f"_carry_{n}") for n, (kind, _) in columns.items()
            ])
            hot = self._join_runs(add(self.hot, [*self.keys, _RUN]), carry)
            hot = hot.withColumns({
                n: F.coalesce(_KINDS[kind][1](F.col(n), F.col(f"_carry_{n}")), F.col(n), F.col(f"_carry_{n}"))
                for n, (kind, _) in columns.items()
            }).drop(*[f"_carry_{n}" for n in columns])
        return replace(self, cold=cold, hot=hot)

    def numbered(self, name: str, start: int = 1) -> "OrderedGroups":
        """Add consecutive numbers from ``start`` in group order.

        Whole groups get ``row_number()``, so that a filter ``name <= n`` is
        turned by Spark into a group limit in front of the shuffle.
        """
        one = F.lit(1).cast("bigint")
        hot = None if self.hot is None else replace(self, cold=None).running(**{name: ("sum", one)}).hot
        cold = self.cold
        if cold is not None:
            cold = cold.withColumn(name, F.row_number().over(self._window(self.keys)).cast("bigint"))
        numbered = replace(self, cold=cold, hot=hot)
        if start == 1:
            return numbered
        return numbered.map(lambda df: df.withColumn(name, F.col(name) + F.lit(start - 1)))

    def result(self) -> DataFrame:
        parts = [] if self.cold is None else [self.cold]
        if self.hot is not None:
            parts.append(self.hot.drop(_RUN))
        out = reduce(DataFrame.unionByName, parts)
        return out.drop(self.helper) if self.helper else out

    def _window(self, keys: list[str]) -> WindowSpec:
        return Window.partitionBy(*keys).orderBy(*[_direction(o) for o in self.order])

    def _join_runs(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        names = [*self.keys, _RUN]
        renamed = carry.withColumnsRenamed({n: f"_key_{n}" for n in names})
        same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_key_{n}")) for n in names])
        return rows.join(renamed, same, "left").drop(*[f"_key_{n}" for n in names])
