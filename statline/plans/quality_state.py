"""Quality findings as counts that add up: a delivery is read when it comes, its counts are stored, reports come from their sums.

A state is a table ``dataset, kind, column, item, detail, n``. Per row a delivery contributes its verdict (``rows``), its key, its
foreign keys, its labels, its date texts that read two ways, its nulls, and the first failure if it has one; equal
contributions are counted before they are shuffled. States of different deliveries, or of parts of one, add up to the state of
all their rows, so duplicates and orphans across deliveries are found though no delivery is read again.

Parts of a key are parted by the sign U+001F and a null part is U+0000, so texts of keys should hold neither.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statline.functions.dates import is_ambiguous_date
from statline.plans.rulebook import rules_for
from statline.schemas import DATASETS
from statline.sources import files
from statline.sources.warehouse import Warehouse

# Columns of the players table whose labels and nulls are profiled.
LABELLED = {"players": ("position",)}
PROFILED = {"players": ("market_value", "contract_until")}
DATED = {"players": ("date_of_birth", "contract_until"), "matches": ("match_date",)}

STATE = "dataset string, kind string, column string, item string, detail string, n bigint"
GROUP = ("dataset", "kind", "column", "item", "detail")
_PART, _NULL = "\x1f", "\x00"


def _text(column: str) -> Column:
    return F.col(f"`{column}`").cast("string")


def _key(columns: Iterable[str]) -> Column:
    return F.concat_ws(_PART, *[F.coalesce(_text(c), F.lit(_NULL)) for c in columns])


def _named(rows: DataFrame, dataset: str, kind: str, column: str = "") -> DataFrame:
    """Counts by ``item`` and ``detail``, either of which may be absent, as rows of the state."""
    none = F.lit(None).cast("string")
    return rows.select(F.lit(dataset).alias("dataset"), F.lit(kind).alias("kind"), F.lit(column).alias("column"),
                       *[F.col(c) if c in rows.columns else none.alias(c) for c in ("item", "detail")], "n")


def dataset_state(name: str, df: DataFrame) -> DataFrame:
    """The state of one dataset's rows. Columns that ``df`` lacks contribute nothing.

    Each kind is counted by its own text alone, which reads the columns it needs once more but moves and holds no row of many
    columns; whatever has one count for all rows comes from one scan.
    """
    spec, rules = DATASETS[name], rules_for(name, df)
    present = lambda columns: [c for c in columns if c in df.columns]

    def counted(kind: str, column: str, rows: DataFrame, item: Column, detail: Column | None = None) -> DataFrame:
        by = [item.alias("item")] + ([] if detail is None else [detail.alias("detail")])
        return _named(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), name, kind, column)

    numbers = [("rows", "", F.lit("valid"), F.count_if(~rules.invalid)), ("rows", "", F.lit("invalid"), F.count_if(rules.invalid))]
    numbers += [("null", c, F.lit(None).cast("string"), F.count_if(F.col(c).isNull())) for c in present(PROFILED.get(name, ()))]
    whole = df.agg(*[n.alias(f"n{i}") for i, (*_, n) in enumerate(numbers)])
    tall = whole.select(F.inline(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.lit(column).alias("column"), item.alias("item"), F.col(f"n{i}").alias("n"))
        for i, (kind, column, item, _) in enumerate(numbers)])))
    parts = [tall.select(F.lit(name).alias("dataset"), "kind", "column", "item", F.lit(None).cast("string").alias("detail"), "n")]
    if len(present(spec.key)) == len(spec.key):
        parts.append(counted("key", "-".join(spec.key), df, _key(spec.key)))
        row_key = F.concat_ws("-", *[F.coalesce(_text(c), F.lit("null")) for c in spec.key])
        parts.append(counted("error", "", df.filter(rules.invalid), row_key, rules.first_failure))
    parts += [counted("foreign", c, df.filter(F.col(c).isNotNull()), _text(c)) for c in present(spec.references)]
    parts += [counted("label", c, df, _text(c)) for c in present(LABELLED.get(name, ()))]
    parts += [counted("ambiguous", c, df.filter(is_ambiguous_date(_text(c))), _text(c)) for c in present(DATED.get(name, ()))]
    return reduce(DataFrame.unionByName, parts)


# The kinds that have about as many rows as their dataset.
_LARGE = tuple(
    (name, kind, column) for name, spec in DATASETS.items()
    for kind, columns in (("key", ["-".join(spec.key)]), ("error", [""]), ("foreign", list(spec.references))) for column in columns)


def added(states: Iterable[DataFrame]) -> DataFrame:
    """The state of all rows that any of the states counts. Large kinds are summed by their own texts alone."""
    rows = reduce(DataFrame.unionByName, states)
    parts, rest = [], F.lit(True)
    for name, kind, column in _LARGE:
        one = (F.col("dataset") == name) & (F.col("kind") == kind) & (F.col("column") == column)
        by = ["item", "detail"] if kind == "error" else ["item"]
        parts.append(_named(rows.filter(one).groupBy(*by).agg(F.sum("n").alias("n")), name, kind, column))
        rest = rest & ~one
    parts.append(rows.filter(rest).groupBy(*GROUP).agg(F.sum("n").alias("n")))
    return reduce(DataFrame.unionByName, parts)


def delivery_state(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """The state of a delivery."""
    return reduce(DataFrame.unionByName, [dataset_state(n, df) for n, df in datasets.items() if n in DATASETS])


class QualityLog:
    """The states of all deliveries, one folder each. A delivery that is added again replaces what it had counted."""

    def __init__(self, warehouse: Warehouse):
        self.spark, self.path = warehouse.spark, f"{warehouse.root}/quality_state"

    def add(self, delivery: str, datasets: Mapping[str, DataFrame]) -> None:
        delivery_state(datasets).write.mode("overwrite").parquet(f"{self.path}/delivery={delivery}")

    def total(self) -> DataFrame:
        """The state of everything delivered so far."""
        if not files.exists(self.spark, self.path):
            return self.spark.createDataFrame([], STATE)
        return added([self.spark.read.schema(STATE + ", delivery string").parquet(self.path).drop("delivery")])


def _sizes(state: DataFrame) -> DataFrame:
    """``dataset, total_rows, valid_rows, invalid_rows``; every dataset has a row."""
    names = state.sparkSession.createDataFrame([(n,) for n in DATASETS], "dataset string")
    counted = state.filter("kind = 'rows'").groupBy("dataset").agg(
        F.sum("n").alias("total_rows"), F.sum(F.when(F.col("item") == "valid", F.col("n"))).alias("valid_rows"),
        F.sum(F.when(F.col("item") == "invalid", F.col("n"))).alias("invalid_rows"))
    return names.join(counted, "dataset", "left").na.fill(0)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100)


def state_summary(state: DataFrame) -> DataFrame:
    """``dataset, total_rows, valid_rows, invalid_rows, valid_percentage``"""
    valid = F.coalesce(_share(F.col("valid_rows"), F.col("total_rows")), F.lit(0.0))
    return _sizes(state).select("*", valid.alias("valid_percentage"))


def state_orphans(state: DataFrame) -> DataFrame:
    """``dataset, column, item, n``: foreign keys that no row of the parent has, and the rows that hold them."""
    pairs = [(child, column, parent) for child, spec in DATASETS.items() for column, parent in spec.references.items()]
    parents = state.sparkSession.createDataFrame(pairs, "dataset string, column string, parent string")
    used = state.filter("kind = 'foreign'").join(F.broadcast(parents), ["dataset", "column"])
    known = state.filter("kind = 'key'").select(F.col("dataset").alias("parent"), "item")
    return used.join(known, ["parent", "item"], "left_anti").select("dataset", "column", "item", "n")


def _findings(state: DataFrame) -> DataFrame:
    """``dataset, check, column, item, n``: every offending key, label and text."""
    check = (F.when((F.col("kind") == "key") & (F.col("n") > 1), "duplicate").when(F.col("kind") == "label", "labels")
             .when(F.col("kind") == "ambiguous", "ambiguous_date"))
    own = state.withColumn("check", check).filter(F.col("check").isNotNull()).select("dataset", "check", "column", "item", "n")
    return own.unionByName(state_orphans(state).withColumn("check", F.lit("orphan")))


def state_warnings(state: DataFrame) -> DataFrame:
    """``dataset, check, column, n_keys, n_rows``: what was found, nothing for what was not."""
    found = _findings(state).groupBy("dataset", "check", "column").agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_rows"))
    zero = F.lit(0).cast("bigint")
    empty = _sizes(state).filter("total_rows = 0").select(
        "dataset", F.lit("empty").alias("check"), F.lit("").alias("column"), zero.alias("n_keys"), zero.alias("n_rows"))
    return empty.unionByName(found)


def state_report(state: DataFrame) -> DataFrame:
    """The report as rows, ``dataset, section, item, detail``: rows, warnings, the keys and labels behind the warnings, the
    first failure of each invalid row, and nulls."""
    def lines(df: DataFrame, section: Column | str, item: Column, detail: Column) -> DataFrame:
        section = F.lit(section) if isinstance(section, str) else section
        return df.select("dataset", section.alias("section"), item.alias("item"), detail.alias("detail"))

    sizes = state_summary(state)
    rows = F.format_string("%d rows", "n")
    key = F.when(F.contains("item", F.lit(_NULL)), "null").otherwise(F.replace("item", F.lit(_PART), F.lit("-")))
    named = F.concat(F.col("column"), F.lit(" "), F.coalesce("item", F.lit("null")))
    behind = _findings(state).filter("check <> 'ambiguous_date'")
    section = F.when(F.col("check") == "orphan", "orphans").when(F.col("check") == "labels", "labels").otherwise("duplicates")
    errors = state.filter("kind = 'error'").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))
    nulls = state.filter("kind = 'null'").join(sizes.select("dataset", "total_rows"), "dataset")
    percent = F.format_string("%.1f%%", _share(F.col("n"), F.col("total_rows")))
    empty = F.when(F.col("total_rows") > 0, F.concat(F.col("n").cast("string"), F.lit(" ("), percent, F.lit(")")))
    return reduce(DataFrame.unionByName, [
        lines(sizes, "rows", F.col("dataset"),
              F.format_string("%d rows, %d correct (%.1f%%)", "total_rows", "valid_rows", "valid_percentage")),
        lines(state_warnings(state), "warnings", F.concat_ws(" ", "check", "column"), F.format_string("%d keys, %d rows", "n_keys", "n_rows")),
        lines(behind, section, F.when(F.col("check") == "duplicate", key).otherwise(named), rows),
        lines(errors, "errors", F.col("item"), F.col("detail")),
        lines(nulls, "nulls", F.col("column"), empty),
    ])
