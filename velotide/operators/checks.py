"""Column and grain checks, reported as DataFrame(table, column, check, failures).

* not_null / accepted_values: all checks of one table in ONE aggregate pass
  (a row of counters, then ``inline`` into report rows); a table that is a
  filter of another one (``Derived``) is counted in that one's pass.
* unique: values that occur more than once (nulls skipped); a hash aggregate
  with map-side combine, so a hot value is counted, never gathered.  Of a stored
  table, hashes are counted first and then only values of repeated ones.
* relationships: child rows whose non-null key is missing in the parent; all
  of a child's relationships in one pass of left joins to the parents' keys.
* grain: groups of the given keys with more than one row.

The report has one row per check (bounded by the spec list), so raising on it
(``assert_checks``) collects only that."""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from velotide.operators.broadcast import counted_broadcast

REPORT_COLS = ["table", "column", "check", "failures"]


class Check(NamedTuple):
    table: str
    column: str
    check: str                  # not_null | unique | accepted_values | relationships | grain
    values: tuple = ()          # accepted values
    to: str | None = None       # parent table (relationships)
    field: str | None = None    # parent column (relationships)
    keys: tuple = ()            # grain keys


def not_null(table, column):
    return Check(table, column, "not_null")


def unique(table, column):
    return Check(table, column, "unique")


def accepted(table, column, values):
    return Check(table, column, "accepted_values", values=tuple(values))


def relationship(table, column, to, field):
    return Check(table, column, "relationships", to=to, field=field)


def grain(table, keys):
    return Check(table, ",".join(keys), "grain", keys=tuple(keys))


def _row(table: str, column: str, check: str, failures) -> DataFrame:
    return failures.select(F.lit(table).alias("table"), F.lit(column).alias("column"),
                           F.lit(check).alias("check"), F.col("failures").cast("bigint").alias("failures"))


class Derived(NamedTuple):
    """A tested table that is a filter and projection of another one: its
    row-level checks are counted in the other table's pass."""
    base: str
    where: Column
    columns: dict[str, Column] = {}


def _scan_checks(df: DataFrame, checks: Sequence[Check], derived: dict[str, Derived]) -> DataFrame:
    counters = []
    for i, c in enumerate(checks):
        d = derived.get(c.table)
        col = d.columns.get(c.column, F.col(c.column)) if d else F.col(c.column)
        bad = col.isNull() if c.check == "not_null" else (col.isNotNull() & ~col.isin(*c.values))
        counters.append(F.count_if(d.where & bad if d else bad).alias(f"c{i}"))
    sums = df.agg(*counters)
    rows = F.array(*[F.struct(F.lit(c.table).alias("table"), F.lit(c.column).alias("column"), F.lit(c.check).alias("check"),
                              F.col(f"c{i}").cast("bigint").alias("failures")) for i, c in enumerate(checks)])
    return sums.select(F.inline(rows))


def _unique(df: DataFrame, c: Check, stored: bool = False) -> DataFrame:
    rows = df.select(c.column).filter(F.col(c.column).isNotNull())
    if stored and dict(rows.dtypes)[c.column] == "string":
        # values whose 64-bit hash no other row has occur once: only the others are shuffled
        hashed = F.xxhash64(c.column)
        repeated, few = counted_broadcast(rows.groupBy(hashed.alias("__hash")).count().filter("count > 1").select("__hash"))
        if few:
            rows = rows.join(repeated, hashed == F.col("__hash"), "left_semi")
    dup = rows.groupBy(c.column).count().filter(F.col("count") > 1)
    return _row(c.table, c.column, c.check, dup.agg(F.count(F.lit(1)).alias("failures")))


def _relationships(df: DataFrame, tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """All relationships of one child table in one pass: a left join to each
    parent's keys, then one row of counters."""
    child = df.select(*dict.fromkeys(c.column for c in checks))
    for i, c in enumerate(checks):
        keys = tables[c.to].select(F.col(c.field).alias(f"k{i}")).filter(F.col(c.field).isNotNull()).distinct()
        child = child.join(keys, child[c.column] == keys[f"k{i}"], "left")
    sums = child.agg(*[F.count_if(F.col(c.column).isNotNull() & F.col(f"k{i}").isNull()).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.table).alias("table"), F.lit(c.column).alias("column"), F.lit(c.check).alias("check"),
                              F.col(f"c{i}").cast("bigint").alias("failures")) for i, c in enumerate(checks)])
    return sums.select(F.inline(rows))


def _grain(df: DataFrame, c: Check) -> DataFrame:
    dup = df.groupBy(*c.keys).count().filter(F.col("count") > 1)
    return _row(c.table, c.column, c.check, dup.agg(F.count(F.lit(1)).alias("failures")))


def run_checks(tables: dict[str, DataFrame], specs: Sequence[Check], derived: dict[str, Derived] | None = None,
               stored: bool = False) -> DataFrame:
    """``stored``: the tables are cheap to read again, and uniqueness tests read their
    column twice to shuffle less of it."""
    derived = derived or {}
    parts: list[DataFrame] = []
    scans: dict[str, list[Check]] = {}
    links: dict[str, list[Check]] = {}
    for c in specs:
        if c.check in ("not_null", "accepted_values"):
            scans.setdefault(derived[c.table].base if c.table in derived else c.table, []).append(c)
        elif c.check == "relationships":
            links.setdefault(c.table, []).append(c)
    parts += [_scan_checks(tables[t], cs, derived) for t, cs in scans.items()]
    parts += [_relationships(tables[t], tables, cs) for t, cs in links.items()]
    for c in specs:
        if c.check == "unique":
            parts.append(_unique(tables[c.table], c, stored))
        elif c.check == "grain":
            parts.append(_grain(tables[c.table], c))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observed(df: DataFrame, table: str, specs: Sequence[Check]):
    """(``df``, observation): the not-null and accepted-value tests of a table are
    counted while ``df`` is written; ``observed_report`` reads them afterwards."""
    own = [c for c in specs if c.table == table and c.check in ("not_null", "accepted_values")]
    if not own:
        return df, (None, own)
    seen = Observation()
    bad = [F.col(c.column).isNull() if c.check == "not_null" else F.col(c.column).isNotNull() & ~F.col(c.column).isin(*c.values) for c in own]
    return df.observe(seen, *[F.count_if(b).alias(f"c{i}") for i, b in enumerate(bad)]), (seen, own)


def observed_report(spark, observations) -> DataFrame:
    """Report rows of finished writes (one per test)."""
    rows = [(c.table, c.column, c.check, seen.get[f"c{i}"]) for seen, own in observations for i, c in enumerate(own)]
    return spark.createDataFrame(rows, "table string, column string, check string, failures long")


class CheckFailed(Exception):
    pass


def assert_checks(report: DataFrame, severity: str = "error") -> list:
    """Collect the (bounded) report; raise when ``severity='error'`` and any
    check failed, else return the failing rows as a warning list."""
    failing = [r for r in report.filter(F.col("failures") > 0).collect()]
    if failing and severity == "error":
        raise CheckFailed("; ".join(f"{r['table']}.{r['column']} {r['check']}: {r['failures']}" for r in failing))
    return failing
