"""One scan of a table from which every result of a profile is cut.

Each task reads its share once and emits long-form rows: counted values, its first, last and drawn rows, and the moments
of its numeric columns. Values are then added up per (column, value), which is all that rates, shares, quartiles, spread
and histograms need; moments are combined column by column; rows are chosen among the few that the tasks sent.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tillwork.functions.amounts import ratio
from tillwork.operators.ranking import at_ranks
from tillwork.session import stage

#: Distinct values that a task holds before it sends them on.
HELD_VALUES = 200_000
QUARTILES = (0.25, 0.5, 0.75)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


class Moments:
    """Counts, means and co-moments of every pair of columns over the rows that have both, mergeable."""

    NAMES = ("both", "x", "y", "xx", "yy", "xy")

    def __init__(self, k: int):
        self.parts = {name: np.zeros((k, k)) for name in self.NAMES}

    @classmethod
    def of(cls, values: np.ndarray) -> Moments:
        """From rows of k values, NaN where one is missing; sums are taken about each column's first value."""
        k, there = values.shape[1], ~np.isnan(values)
        firsts = np.where(there.any(axis=0), values[there.argmax(axis=0), np.arange(k)], 0.0) if len(values) else np.zeros(k)
        x, m = np.where(there, values - firsts, 0.0), there.astype(float)
        n = m.T @ m
        safe = np.maximum(n, 1)
        sx, sxx = x.T @ m, (x * x).T @ m  # of the row's column, over the rows that have both
        mean, spread = sx / safe, sxx - sx * sx / safe
        spread[spread <= 1e-12 * sxx] = 0.0  # no spread but rounding
        out = cls(0)
        out.parts = {
            "both": n, "x": mean + firsts[:, None], "y": (mean + firsts[:, None]).T,
            "xx": spread, "yy": spread.T.copy(), "xy": x.T @ x - sx * sx.T / safe,
        }
        return out

    def add(self, other: dict[str, np.ndarray]) -> None:
        a, b = self.parts, other
        n = a["both"] + b["both"]
        safe = np.maximum(n, 1)
        dx, dy, weight = b["x"] - a["x"], b["y"] - a["y"], a["both"] * b["both"] / safe
        for name, d in (("xx", dx * dx), ("yy", dy * dy), ("xy", dx * dy)):
            a[name] = a[name] + b[name] + d * weight
        a["x"], a["y"], a["both"] = a["x"] + dx * b["both"] / safe, a["y"] + dy * b["both"] / safe, n

    def correlation(self) -> np.ndarray:
        """NaN where one side has no spread over the common rows."""
        p, safe = self.parts, np.maximum(self.parts["both"], 1)
        flat = (p["xx"] <= safe * (1e-12 * p["x"]) ** 2) | (p["yy"] <= safe * (1e-12 * p["y"]) ** 2)
        with np.errstate(invalid="ignore", divide="ignore"):
            r = p["xy"] / (np.sqrt(p["xx"]) * np.sqrt(p["yy"]))
        return np.where(flat | (p["both"] < 2), np.nan, np.clip(r, -1.0, 1.0))


_MOMENT_ROWS = "i INT, " + ", ".join(f"{n} ARRAY<DOUBLE>" for n in Moments.NAMES)


def _matrix(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    columns = [batch.column(n).to_numpy(zero_copy_only=False).astype(float) for n in names]
    return np.column_stack(columns) if columns else np.empty((batch.num_rows, 0))


def _add_up(rows: DataFrame) -> DataFrame:
    """Moments per column `i` from the rows of all tasks; a task holds one column's sums at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, Moments] = {}
        for batch in batches:
            for r in batch.to_pylist():
                part = {n: np.asarray(r[n])[None, :] for n in Moments.NAMES}
                if r["i"] not in sums:
                    sums[r["i"]] = Moments(0)
                    sums[r["i"]].parts = {n: np.zeros_like(part["both"]) for n in Moments.NAMES}
                sums[r["i"]].add(part)
        for i, total in sums.items():
            r = total.correlation()[0]
            listed = [None if np.isnan(v) else float(v) for v in r]
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([listed], pa.list_(pa.float64()))], ["i", "r"])

    return rows.repartition("i").mapInArrow(run, "i INT, r ARRAY<DOUBLE>")


def correlations(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(i, r): row i of the correlation matrix of the named numeric columns, in one scan; NULL where it is undefined.

    A pair is judged over the rows where both have a value. A task keeps six k by k matrices, whatever it reads, and
    sends k rows of six arrays.
    """
    k = len(names)
    cast = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"c{i}") for i, c in enumerate(names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Moments(k)
        for batch in batches:
            total.add(Moments.of(_matrix(batch, [f"c{i}" for i in range(k)])).parts)
        yield _moment_batch(total, k)

    return _add_up(cast.mapInArrow(run, _MOMENT_ROWS))


def _moment_batch(total: Moments, k: int) -> pa.RecordBatch:
    arrays = [pa.array(range(k), pa.int32())]
    arrays += [pa.array(list(total.parts[n]), pa.list_(pa.float64())) for n in Moments.NAMES]
    return pa.RecordBatch.from_arrays(arrays, ["i", *Moments.NAMES])


class Profile:
    """Long-form rows of one scan of `df`, and the results cut from them.

    `order` are columns that order the rows; `size` is the number of rows of Head, Tail and Sample.
    """

    def __init__(self, df: DataFrame, order: Sequence[str], size: int = 100, seed: int = 42, bins: int = 10):
        self.spark, self.columns, self.schema = df.sparkSession, df.columns, df.schema
        self.order, self.size, self.bins = list(order), size, bins
        self.numbers = numeric_columns(df)
        self.scan = stage(self._long_rows(df, seed), "profile")
        self.rows_read = self.scan.filter("stat = 'rows'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        counted = self.scan.filter("stat = 'value'").groupBy("col", "value").agg(F.sum("n").alias("n"))
        self.values = stage(counted, "profile-values")
        self._quartiles = None

    def _long_rows(self, df: DataFrame, seed: int) -> DataFrame:
        names, numbers, order, size = self.columns, self.numbers, self.order, self.size
        draw = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in order], F.lit(str(seed))).cast("binary"))
        texts = [F.col(c).cast("string").alias(f"t{i}") for i, c in enumerate(names)]
        doubles = [F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"c{i}") for i, c in enumerate(numbers)]
        wide = df.select(F.struct(*names).alias("row"), draw.alias("draw"), *texts, *doubles)
        kinds = {
            "head": [(f"o{i}", "ascending", "at_start") for i in range(len(order))],
            "tail": [(f"o{i}", "descending", "at_end") for i in range(len(order))],
            "sample": [("draw", "ascending", "at_end"), *((f"o{i}", "ascending", "at_end") for i in range(len(order)))],
        }
        fields = ["stat", "col", "value", "n", "row", "i", *Moments.NAMES]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, kept, held, rows, kind = Moments(len(numbers)), {}, {}, 0, None

            def emit(size: int, **columns) -> pa.RecordBatch:
                empty = {"stat": pa.string(), "col": pa.string(), "value": pa.string(), "n": pa.int64(), "row": kind, "i": pa.int32()}
                empty |= {m: pa.list_(pa.float64()) for m in Moments.NAMES}
                return pa.RecordBatch.from_arrays([columns.get(f, pa.nulls(size, empty[f])) for f in fields], fields)

            def send_values() -> Iterator[pa.RecordBatch]:
                for col, counts in held.items():
                    if not counts:  # no value of this column so far
                        continue
                    yield emit(len(counts), stat=pa.array(["value"] * len(counts)), col=pa.array([col] * len(counts)),
                               value=pa.array(list(counts), pa.string()), n=pa.array(list(counts.values()), pa.int64()))
                held.clear()

            for batch in batches:
                kind = batch.column("row").type
                rows += batch.num_rows
                for i, col in enumerate(names):
                    counts = held.setdefault(col, {})
                    for entry in pc.value_counts(batch.column(f"t{i}").drop_null()).to_pylist():
                        counts[entry["values"]] = counts.get(entry["values"], 0) + entry["counts"]
                total.add(Moments.of(_matrix(batch, [f"c{i}" for i in range(len(numbers))])).parts)
                keys = [batch.column("row").field(names.index(c)) for c in order]
                table = pa.table([batch.column("row"), batch.column("draw"), *keys], ["row", "draw", *(f"o{i}" for i in range(len(order)))])
                for stat, by in kinds.items():
                    both = pa.concat_tables([kept[stat], table]) if stat in kept else table
                    first = pc.sort_indices(both, sort_keys=[(c, way) for c, way, _ in by], null_placement=by[-1][2])
                    kept[stat] = both.take(first[:size])
                if sum(map(len, held.values())) > HELD_VALUES:
                    yield from send_values()
            if kind is None:
                return
            yield from send_values()
            for stat, table in kept.items():
                if not table.num_rows:
                    continue
                chosen = table.column("row").combine_chunks()
                yield emit(len(chosen), stat=pa.array([stat] * len(chosen)), row=chosen)
            if numbers:
                moments = _moment_batch(total, len(numbers))
                yield emit(len(numbers), stat=pa.array(["moments"] * len(numbers)), **{f: moments.column(f) for f in ("i", *Moments.NAMES)})
            yield emit(1, stat=pa.array(["rows"]), n=pa.array([rows], pa.int64()))

        row = T.StructType(df.schema.fields)
        schema = T.StructType([
            T.StructField("stat", T.StringType()), T.StructField("col", T.StringType()), T.StructField("value", T.StringType()),
            T.StructField("n", T.LongType()), T.StructField("row", row), T.StructField("i", T.IntegerType()),
            *[T.StructField(m, T.ArrayType(T.DoubleType())) for m in Moments.NAMES],
        ])
        return wide.mapInArrow(run, schema)

    def _rows(self, stat: str) -> DataFrame:
        return self.scan.filter(F.col("stat") == stat).select("row.*")

    def head(self) -> DataFrame:
        return self._rows("head").orderBy(*self.order).limit(self.size)

    def tail(self) -> DataFrame:
        return self._rows("tail").orderBy(*[F.desc(c) for c in self.order]).limit(self.size).orderBy(*self.order)

    def sample(self, seed: int = 42) -> DataFrame:
        draw = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in self.order], F.lit(str(seed))).cast("binary"))
        drawn = self._rows("sample").withColumn("_draw", draw).orderBy("_draw", *self.order)
        return drawn.limit(self.size).drop("_draw")

    def _per_column(self) -> DataFrame:
        """(col, position, dtype, filled, unique, bytes) of every column, also of those without a value."""
        sizes = {f.name: 0 if isinstance(f.dataType, (T.StringType, T.BinaryType)) else fixed_size(f.dataType) for f in self.schema}
        names = [(c, k, kind, sizes[c]) for k, (c, kind) in enumerate((f.name, f.dataType.simpleString()) for f in self.schema)]
        listed = self.spark.createDataFrame(names, "col STRING, position INT, dtype STRING, width INT")
        length = F.sum(F.col("n") * F.octet_length("value"))
        found = self.values.groupBy("col").agg(F.sum("n").alias("filled"), F.count(F.lit(1)).alias("unique"), length.alias("text"))
        both = listed.join(found, "col", "left").na.fill(0, ["filled", "unique", "text"])
        return both.withColumn("bytes", F.when(F.col("width") > 0, F.col("filled") * F.col("width")).otherwise(F.col("text")))

    def info(self) -> DataFrame:
        """Totals, then non-null count, null count and type per column. Memory is that of the values themselves."""
        per = self._per_column()
        rows = F.lit(self.rows_read)
        size = F.concat(F.format_string("%.1f", F.sum("bytes") / 1024**2), F.lit(" MB"))
        blank = F.lit("")
        heads = [
            (-3, "Total Entries", rows.cast("string"), blank, blank),
            (-2, "Total Columns", F.lit(str(len(self.columns))), blank, blank),
            (-1, "Memory Usage", blank, blank, F.col("size")),
        ]
        names = ["position", "Column", "Non-Null Count", "Null Count", "Dtype"]
        structs = [F.struct(*[(c if isinstance(c, Column) else F.lit(c)).alias(n) for c, n in zip(h, names)]) for h in heads]
        totals = per.agg(size.alias("size")).select(F.inline(F.array(*structs)))
        columns = per.select("position", F.col("col").alias("Column"), F.col("filled").cast("string").alias("Non-Null Count"),
                             (rows - F.col("filled")).cast("string").alias("Null Count"), F.col("dtype").alias("Dtype"))
        return totals.unionByName(columns).orderBy("position").drop("position")

    def _rate(self, name: str, share) -> DataFrame:
        rate = F.round(share(ratio(F.lit(self.rows_read) - F.col("filled"), F.lit(self.rows_read))) * 100, 2)
        return self._per_column().orderBy("position").select("col", rate.alias(name))

    def missing_rates(self) -> DataFrame:
        return self._rate("null_rate", lambda missing: missing)

    def fill_rates(self) -> DataFrame:
        return self._rate("fill_rate", lambda missing: F.lit(1.0) - missing)

    def need_trim(self) -> DataFrame:
        """Strings per column that start or end with a blank."""
        texts = [f.name for f in self.schema if isinstance(f.dataType, T.StringType)]
        blank = F.col("value").startswith(" ") | F.col("value").endswith(" ")
        found = self.values.filter(F.col("col").isin(texts) & blank).groupBy("col").agg(F.sum("n").alias("needs_trim"))
        return self._per_column().join(found, "col", "left").orderBy("position").select("col", F.coalesce("needs_trim", F.lit(0)).alias("needs_trim"))

    def value_share(self, top: int = 20) -> DataFrame:
        """Share of the most frequent values per column; the rank filter is a group limit below the shuffle."""
        by = Window.partitionBy("col").orderBy(F.desc("n"), "value")
        ranked = self.values.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
        filled = self._per_column().select("col", "filled")
        return ranked.join(filled, "col").select("col", "value", (ratio(F.col("n"), F.col("filled")) * 100).alias("share"))

    def number_values(self) -> DataFrame:
        """(name, value, n) of the numeric columns, values as doubles; NaN does not count."""
        floats = [f.name for f in self.schema if isinstance(f.dataType, T.FloatType)]
        number = F.when(F.col("col").isin(floats), F.col("value").cast("float").cast("double")).otherwise(F.col("value").cast("double"))
        counted = self.values.filter(F.col("col").isin(self.numbers)).select(F.col("col").alias("name"), number.alias("value"), "n")
        return counted.filter(~F.isnan("value"))

    def _central(self) -> DataFrame:
        """(name, filled, mean, lo, hi, m2, m3) of the numeric columns, moments about the mean."""
        counted = self.number_values()
        firsts = counted.groupBy("name").agg(
            F.sum("n").alias("filled"), (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"), F.min("value").alias("lo"), F.max("value").alias("hi")
        )
        away = F.col("value") - F.col("mean")
        return counted.join(firsts, "name").groupBy("name", "filled", "mean", "lo", "hi").agg(
            F.sum(F.col("n") * away * away).alias("m2"), F.sum(F.col("n") * away * away * away).alias("m3")
        )

    def quartiles(self) -> DataFrame:
        """(name, p25, p50, p75), interpolated and exact."""
        counted = self.number_values()
        total = counted.groupBy("name").agg(F.sum("n").alias("total"))
        ends = F.inline(F.array(*[F.struct(F.lit(f"p{int(p * 100)}").alias("k"), F.lit(p).alias("p")) for p in QUARTILES]))
        asked = total.select("name", "total", ends).withColumn("at", (F.col("total") - 1) * F.col("p"))
        asked = stage(asked.select("name", "k", "at", F.floor("at").alias("low"), F.ceil("at").alias("high")), "asked")
        found = stage(at_ranks(counted, asked.select("name", F.explode(F.array("low", "high")).alias("rank")).distinct()), "ranks")
        low = found.select("name", F.col("rank").alias("low"), F.col("value").alias("a"))
        high = found.select("name", F.col("rank").alias("high"), F.col("value").alias("b"))
        both = asked.join(low, ["name", "low"]).join(high, ["name", "high"]).withColumn("value", F.expr("a + (b - a) * (at - low)"))
        return both.groupBy("name").pivot("k", ["p25", "p50", "p75"]).agg(F.max("value"))

    def describe(self) -> DataFrame:
        """Count, unique, top, freq of text columns; mean, std, min, quartiles, max of numeric ones."""
        winner = F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("value")))
        others = self.values.filter(~F.col("col").isin(self.numbers))
        tops = others.groupBy("col").agg(F.count(F.lit(1)).alias("unique"), winner.alias("w"))
        tops = tops.select("col", "unique", F.col("w.value").alias("top"), (-F.col("w.n")).alias("freq"))
        central = self._central().select(F.col("name").alias("col"), "mean", F.sqrt(ratio(F.col("m2"), F.col("filled") - 1)).alias("std"),
                                         F.col("lo").alias("min"), F.col("hi").alias("max"))
        per = self._per_column().select("col", "position", F.col("filled").alias("count"))
        joined = per.join(tops, "col", "left").join(central, "col", "left").join(self.quartiles().withColumnRenamed("name", "col"), "col", "left")
        return joined.orderBy("position").select("col", "count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max")

    def skewness(self) -> DataFrame:
        """Bias-adjusted skewness per numeric column; NULL under three values or without spread."""
        n = F.col("filled").cast("double")
        plain = F.col("m3") / n / F.pow(F.col("m2") / n, 1.5)
        value = F.when((n > 2) & (F.col("m2") > 0), plain * F.sqrt(n * (n - 1)) / (n - 2))
        found = self._central().select(F.col("name").alias("col"), value.alias("skewness"))
        return self._per_column().filter(F.col("col").isin(self.numbers)).join(found, "col", "left").orderBy("position").select("col", "skewness")

    def histogram(self) -> DataFrame:
        """Equal-width bins between the smallest and largest value of each numeric column."""
        counted = self.number_values()
        ends = counted.groupBy("name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
        place = F.floor(ratio((F.col("value") - F.col("lo")) * F.lit(self.bins), F.col("hi") - F.col("lo"))).cast("int") + 1
        binned = counted.join(ends, "name").withColumn("bin", F.least(F.coalesce(place, F.lit(1)), F.lit(self.bins)))
        return binned.groupBy(F.col("name").alias("col"), "bin").agg(F.sum("n").alias("n")).orderBy("col", "bin")

    def correlation_rows(self) -> DataFrame:
        return _add_up(self.scan.filter("stat = 'moments'").select("i", *Moments.NAMES))

    def results(self) -> dict[str, DataFrame | list[str]]:
        """All fifteen results by name."""
        from tillwork.operators.profiling import corr_matrix, corr_top, pairs_of

        rows = stage(self.correlation_rows(), "correlations") if self.numbers else self.spark.createDataFrame([], "i INT, r ARRAY<DOUBLE>")
        positive, negative = corr_top(pairs_of(rows, self.numbers))
        return {
            "Head": self.head(),
            "Tail": self.tail(),
            "Sample": self.sample(),
            "Info": self.info(),
            "Col_list": list(self.columns),
            "Describe": self.describe(),
            "Missing_rates": self.missing_rates(),
            "Fullfill_rates": self.fill_rates(),
            "Trim_me": self.need_trim(),
            "Share_value": self.value_share(),
            "Variance": self.skewness(),
            "Histogram": self.histogram(),
            "Corr_Matrix": corr_matrix(rows, self.numbers),
            "Corr_Series_Pos": positive,
            "Corr_Series_Neg": negative,
        }


def fixed_size(kind: T.DataType) -> int:
    """Bytes of one value of a type without a length of its own."""
    return {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}.get(kind.simpleString(), 8)
