"""Imputing, scaling and encoding, fitted on one frame and applied to others.

Fitted numbers and texts end up as literals in SQL projections, so applying a
preparation stays inside generated code, and a fitted ``Pipeline`` saves and
loads with Spark alone. Columns of very many texts are the exception: their codes are
a table that the preparation joins (``TableIndex``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrears.operators.joins import join_spread
from arrears.operators.quantiles import _long, approximate_medians, medians, modes
from arrears.sources.tables import stage


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _projection(columns: Mapping[str, str]) -> SQLTransformer:
    added = ", ".join(f"{sql} AS {_name(out)}" for out, sql in columns.items())
    return SQLTransformer(statement=f"SELECT *, {added} FROM __THIS__")


class _ColumnFit(Estimator):
    """Fits ``inputs`` and writes ``outputs`` by a projection."""

    def __init__(self, inputs: Sequence[str], outputs: Sequence[str]):
        super().__init__()
        self.inputs, self.outputs = list(inputs), list(outputs)

    def _sql(self, dataset: DataFrame) -> list[str]:
        raise NotImplementedError

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        return _projection(dict(zip(self.outputs, self._sql(dataset))))


class PopulationScaler(_ColumnFit):
    """``(x - mean) / std`` with the population deviation; a constant column is only centred."""

    def _sql(self, dataset: DataFrame) -> list[str]:
        row = dataset.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(self.inputs)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(self.inputs)],
        ).first()
        return [
            f"(CAST({_name(c)} AS DOUBLE) - {_number(float(row[f'm{i}'] or 0.0))}) / {_number(float(row[f's{i}'] or 1.0))}"
            for i, c in enumerate(self.inputs)
        ]


class MedianImputer(_ColumnFit):
    """Null and NaN become the median of the fitted frame."""

    def __init__(self, inputs: Sequence[str], outputs: Sequence[str], approximate: bool = False):
        super().__init__(inputs, outputs)
        self.approximate = approximate

    def _sql(self, dataset: DataFrame) -> list[str]:
        found = (approximate_medians if self.approximate else medians)(dataset, self.inputs)
        return [
            f"coalesce(nanvl(CAST({_name(c)} AS DOUBLE), CAST(NULL AS DOUBLE)), {_number(found[c])})" if c in found else f"CAST({_name(c)} AS DOUBLE)"
            for c in self.inputs
        ]


class ModeImputer(_ColumnFit):
    """Null becomes the most frequent text of the fitted frame, the smallest on a tie."""

    def _sql(self, dataset: DataFrame) -> list[str]:
        found = modes(dataset, self.inputs)
        return [f"coalesce({_name(c)}, {_text(found[c])})" if c in found else _name(c) for c in self.inputs]


class Categoriser(_ColumnFit):
    """Texts not seen in the fitted frame become null."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        indexed = [f"{c}__seen" for c in self.outputs]
        index = CategoryIndex(self.inputs, indexed).fit(dataset)
        known = {
            out: f"CASE WHEN {_name(i)} < {_size(stage)} THEN CAST({_name(c)} AS STRING) END"
            for c, out, i, stage in zip(self.inputs, self.outputs, indexed, index.stages)
        }
        return PipelineModel(stages=[index, _projection(known)])


class CategoryIndex(_ColumnFit):
    """Index 0.. in text order; unseen texts and nulls get the index after the last.

    A column with more than ``MOST_CATEGORIES`` texts is indexed by a table (``TableIndex``), others by a list. A list
    names the slots of an encoder behind it, which an empty text cannot, so a column that has one takes a table too.
    """

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        seen = _categories(dataset, self.inputs)
        # one model per column: arrays of uneven length would be padded with nulls on their way to the JVM
        return PipelineModel(
            stages=[
                StringIndexerModel.from_labels(seen[c], inputCol=c, outputCol=out, handleInvalid="keep")
                if c in seen and "" not in seen[c]
                else TableIndex.fitted(dataset, c, out)
                for c, out in zip(self.inputs, self.outputs)
            ]
        )


class OrdinalCoder(_ColumnFit):
    """Codes 0.. in text order; unseen texts and nulls become -1."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        indexed = [f"{c}__index" for c in self.outputs]
        index = CategoryIndex(self.inputs, indexed).fit(dataset)
        codes = {
            out: f"CASE WHEN {_name(i)} = {_size(stage)} THEN -1.0D ELSE {_name(i)} END"
            for out, i, stage in zip(self.outputs, indexed, index.stages)
        }
        return PipelineModel(stages=[index, _projection(codes)])


MOST_CATEGORIES = 20_000
NULL_SPLITS = 4096


def _categories(dataset: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct texts of the columns that have at most ``MOST_CATEGORIES``; the others are left out.

    The texts become parts of a fitted model, so they must fit on the driver.
    """
    distinct = _long(dataset, columns, "string").distinct()
    most = MOST_CATEGORIES * len(columns)
    rows = distinct.limit(most + 1).collect()
    counts = Counter(r["name"] for r in rows)
    narrow = [c for c in columns if counts[c] <= MOST_CATEGORIES]
    if len(rows) > most:  # some texts were not fetched: count, then fetch those of narrow columns
        sizes = {r["name"]: r["n"] for r in distinct.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
        narrow = [c for c in columns if sizes.get(c, 0) <= MOST_CATEGORIES]
        rows = distinct.filter(F.col("name").isin(narrow)).collect() if narrow else []
    seen: dict[str, list[str]] = {c: [] for c in narrow}
    for r in rows:
        if r["name"] in seen:
            seen[r["name"]].append(r["value"])
    return {c: sorted(v) for c, v in seen.items()}


def _size(index: Model) -> int:
    return index.size if isinstance(index, TableIndex) else len(index.labels)


class TableIndex(Model, MLReadable, MLWritable):
    """Index of a column with any number of texts, by a join with the table of their codes.

    The table lies below ``spark.checkpoint.dir`` until the model is saved, and beside its metadata from then on; save
    the model before ``clear_work``. Unseen texts and nulls get the index after the last. Nulls are spread over tasks;
    texts that many rows share are left to the skew join of adaptive execution, which splits them. The column says how
    many values it has, so an encoder behind it need not look. One-hot vectors get a slot for each text, and models on
    them a coefficient for each slot on the driver; ordinal codes have no such cost.
    """

    def __init__(self, column: str, out: str, codes: DataFrame, size: int):
        super().__init__()
        self.column, self.out, self.codes, self.size = column, out, codes, size

    @classmethod
    def fitted(cls, dataset: DataFrame, column: str, out: str) -> TableIndex:
        codes = stage(category_codes(dataset, _name(column)), "codes")
        return cls(column, out, codes, codes.count())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value, code, spread, own = (f"{self.out} {x}" for x in ("value", "code", "spread", "own"))
        codes = self.codes.select(
            F.col("value").alias(value), F.col("code").cast("double").alias(code), F.lit(0).cast("long").alias(spread)
        )
        text = F.col(_name(self.column)).cast("string")
        # where a null row goes makes no difference to its index, so a number that a retry draws anew is good enough
        salt = F.when(text.isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(NULL_SPLITS))).otherwise(F.lit(0))
        left = dataset.withColumns({own: text, f"{own} spread": salt.cast("long")})
        same = (F.col(_name(own)) == F.col(_name(value))) & (F.col(_name(f"{own} spread")) == F.col(_name(spread)))
        joined = left.join(codes, same, "left")
        index = F.coalesce(F.col(_name(code)), F.lit(float(self.size)))
        attribute = {"ml_attr": {"name": self.out, "type": "nominal", "num_vals": self.size + 1}}
        indexed = joined.withColumn(self.out, index).withMetadata(self.out, attribute)
        return indexed.drop(own, f"{own} spread", value, code, spread)

    def write(self) -> _TableWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> _TableReader:
        return _TableReader()


class _TableWriter(MLWriter):
    def __init__(self, model: TableIndex):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(
            m, path, self.sparkSession, extraMetadata={"column": m.column, "out": m.out, "size": m.size}
        )
        m.codes.write.parquet(f"{path}/codes")


class _TableReader(MLReader):
    def load(self, path: str) -> TableIndex:
        spark = self.sparkSession
        held = DefaultParamsReader.loadMetadata(path, spark)
        codes = spark.read.schema("value string, code long").parquet(f"{path}/codes")
        model = TableIndex(held["column"], held["out"], codes, held["size"])
        model._resetUid(held["uid"])
        return model


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): the distinct texts of a column with codes 0.. in text order, however many there are.

    Distinct texts are dealt by ranges and sorted inside; a text's code is its place in its range after the sizes of
    the ranges before. Only one count for each range meets in one place.
    """
    values = df.select(F.col(column).cast("string").alias("value")).filter("value IS NOT NULL").distinct()
    number = F.monotonically_increasing_id()  # range and place, written as they are drawn
    placed = values.repartitionByRange("value").sortWithinPartitions("value").withColumn("number", number)
    placed = stage(placed, "category-places").select(
        "value", F.shiftright("number", 33).alias("range"), F.col("number").bitwiseAND((1 << 33) - 1).alias("place")
    )
    before = W.partitionBy(F.lit(1)).orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    sizes = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "range").select("value", (F.col("start") + F.col("place")).alias("code"))


def join_codes(
    df: DataFrame, column: str, codes: DataFrame, out: str, row_key: Sequence[str], one_hot: bool = False
) -> DataFrame:
    """Add the code of each text: -1 for null and unseen ones; or a sparse vector with one slot for each code.

    Texts that many rows share are spread over tasks.
    """
    renamed = codes.select(F.col("value").alias(column), F.col("code").cast("double").alias(out))
    joined = join_spread(df, renamed, [column], row_key)
    if not one_hot:
        return joined.withColumn(out, F.coalesce(out, F.lit(-1.0)))
    width = codes.count()
    slot = f"{out}__slot"
    wide = joined.withColumn(slot, F.coalesce(out, F.lit(float(width)))).drop(out)
    sized = df.sparkSession.range(width, width + 1).select(F.col("id").cast("double").alias(slot))  # the last slot
    return OneHotEncoder(inputCol=slot, outputCol=out, dropLast=True).fit(sized).transform(wide).drop(slot)


def one_hot(columns: Sequence[str]) -> list[Estimator]:
    """One slot per seen category in text order; an unseen one sets none."""
    index = CategoryIndex(list(columns), [f"{c}__index" for c in columns])
    # the index after the last stands for the unseen; dropLast removes its slot
    encode = OneHotEncoder(
        inputCols=[f"{c}__index" for c in columns], outputCols=[f"{c}__hot" for c in columns], dropLast=True
    )
    return [index, encode]


def feature_preparation(
    numeric: Sequence[str],
    text: Sequence[str],
    impute: bool = False,
    encoding: str = "one_hot",
    approximate: bool = False,
    features: str = "features",
) -> Pipeline:
    """Scaled numbers and encoded texts in one vector; all other columns stay beside it.

    ``encoding`` is ``one_hot``, ``ordinal`` or ``categorise`` (unseen texts are
    nulled, then one-hot encoded).
    """
    stages: list = []
    numbers, texts = list(numeric), list(text)
    if impute:
        if numbers:
            stages.append(MedianImputer(numbers, [f"{c}__filled" for c in numbers], approximate))
            numbers = [f"{c}__filled" for c in numbers]
        if texts:
            stages.append(ModeImputer(texts, [f"{c}__filled" for c in texts]))
            texts = [f"{c}__filled" for c in texts]
    parts: list[str] = []
    if numbers:
        scaled = [f"{c}__scaled" for c in numeric]
        stages.append(PopulationScaler(numbers, scaled))
        parts += scaled
    if texts:
        if encoding == "ordinal":
            stages.append(OrdinalCoder(texts, [f"{c}__code" for c in text]))
            parts += [f"{c}__code" for c in text]
        elif encoding in ("one_hot", "categorise"):
            if encoding == "categorise":
                stages.append(Categoriser(texts, [f"{c}__known" for c in text]))
                texts = [f"{c}__known" for c in text]
            stages += one_hot(texts)
            parts += [f"{c}__hot" for c in texts]
        else:
            raise ValueError("encoding must be 'one_hot', 'ordinal' or 'categorise'")
    stages.append(VectorAssembler(inputCols=parts, outputCol=features, handleInvalid="keep"))
    return Pipeline(stages=stages)


def fit_preparation(train: DataFrame, numeric: Sequence[str], text: Sequence[str], **kwargs) -> PipelineModel:
    return feature_preparation(numeric, text, **kwargs).fit(train)


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Slot names from the vector's metadata, ``feature_i`` where it has none."""
    field = df.schema[features]
    meta = field.metadata.get("ml_attr", {})
    slots = {a["idx"]: a["name"] for group in meta.get("attrs", {}).values() for a in group}
    width = meta.get("num_attrs", len(slots))
    clean = {
        i: n.replace("__hot", "").replace("__filled", "").replace("__known", "").replace("__scaled", "").replace("__code", "")
        for i, n in slots.items()
    }
    return [clean.get(i, f"feature_{i}") for i in range(width)]
