"""Text lines to labelled points.

A point frame has `point array<double>` and `grp int` (0 for the label "A",
1 for any other label) next to whatever columns the caller keeps.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP_A_LABEL = "A"
GROUP_B_LABEL = "B"
ON_BAD = ("fail", "drop")
FIRST = "first"
# widths up to which each coordinate is an expression of its own
UNROLLED_DIMS = 64


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row `value` per text line below `path`."""
    return spark.read.text(path)


def load_parts(df: DataFrame, parts: int, persist: bool = False) -> DataFrame:
    """Spread rows evenly over `parts` partitions and optionally keep them.

    This shuffles everything once. It pays where the input has few or uneven
    splits; otherwise leave the scan's own partitions alone.
    """
    if parts < 1:
        raise ValueError("parts must be positive")
    spread = df.repartition(parts)
    return spread.persist(StorageLevel.MEMORY_AND_DISK) if persist else spread


def encode_group(label: Column) -> Column:
    return F.when(label == GROUP_A_LABEL, 0).otherwise(1)


def points_from_columns(df: DataFrame, coords: list[str | Column], label: str | Column, *keep) -> DataFrame:
    """A point frame straight from typed columns; no text in between."""
    cells = [F.col(c) if isinstance(c, str) else c for c in coords]
    label = F.col(label) if isinstance(label, str) else label
    return df.select(
        *keep, F.array(*[c.cast("double") for c in cells]).alias("point"), encode_group(label).alias("grp")
    )


def _check_on_bad(on_bad: str) -> None:
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {ON_BAD}")


# working columns, by names that no table has
FIELDS, POINT, ROW = "__pointflow_fields", "__pointflow_point", "__pointflow_row"


def _settle(df: DataFrame, bad: Column, value: Column, on_bad: str, outputs: dict[str, Column]) -> DataFrame:
    """Drop the bad rows, or raise on the first one that a task meets. All other columns stay."""
    carried = [f"`{c}`" for c in df.columns if c not in (FIELDS, POINT, *outputs)]
    if on_bad == "drop":
        return df.where(~bad).select(*carried, *[c.alias(n) for n, c in outputs.items()])
    row = F.struct(*[c.alias(n) for n, c in outputs.items()])
    checked = F.when(bad, F.raise_error(F.concat(F.lit("bad line: "), value))).otherwise(row)
    return df.withColumn(ROW, checked).select(*carried, *[f"{ROW}.{n}" for n in outputs])


def _fields(value: Column) -> Column:
    return F.split(F.rtrim(value, F.lit(",")), ",")


def first_width(lines: DataFrame, value: str = "value") -> int | None:
    """Coordinates of the first line that has any; None if no line has."""
    row = lines.select((F.size(_fields(F.col(value))) - 1).alias("n")).where("n > 0").first()
    return row["n"] if row else None


def _infinite(v: Column) -> Column:
    # NaN sorts above infinity, so one comparison also rejects it
    return v.isNull() | ~(F.abs(v) < F.lit(float("inf")))


def parse_points(
    lines: DataFrame, dims: int | str | None = None, on_bad: str = "fail", value: str = "value"
) -> DataFrame:
    """`x1,...,xn,label` lines to points; the last field is the label.

    Trailing commas do not count as fields. A line is bad if it has no
    coordinate, a coordinate that is not a finite number, or (with `dims`)
    another number of coordinates. `dims="first"` takes the width of the first
    line that has coordinates, which reads the head of the input once.
    """
    _check_on_bad(on_bad)
    if dims == FIRST:
        if lines.isStreaming:
            raise ValueError("a stream has no first line: state dims")
        dims = first_width(lines, value) or 1
    text = F.col(value)
    fields = F.col(FIELDS)
    df = lines.withColumn(FIELDS, _fields(text))
    if dims is None or dims > UNROLLED_DIMS:
        heads = F.slice(fields, 1, F.greatest(F.size(fields) - 1, F.lit(0)))
        df = df.withColumn(POINT, F.transform(heads, lambda s: s.try_cast("double")))
        bad = (F.size(POINT) < 1 if dims is None else F.size(fields) != dims + 1) | F.exists(POINT, _infinite)
    else:
        # a small known width needs no lambda, so the whole parse stays in generated code
        cells = [F.get(fields, F.lit(j)).try_cast("double") for j in range(dims)]
        df = df.withColumn(POINT, F.array(*cells))
        bad = F.size(fields) != dims + 1
        for j in range(dims):
            bad = bad | _infinite(F.get(POINT, F.lit(j)))
    label = F.element_at(fields, -1)
    outputs = {"point": F.col(POINT), "label": label, "grp": encode_group(label)}
    return _settle(df, F.coalesce(bad, F.lit(True)), text, on_bad, outputs).drop(value)


def parse_points_2d(lines: DataFrame, on_bad: str = "fail", value: str = "value") -> DataFrame:
    """The first two fields as the point and the third, if any, as the label; further fields are ignored."""
    _check_on_bad(on_bad)
    text = F.col(value)
    fields = F.col(FIELDS)
    df = lines.withColumn(FIELDS, _fields(text))
    df = df.withColumn(POINT, F.array(*[F.get(fields, F.lit(j)).try_cast("double") for j in range(2)]))
    bad = _infinite(F.get(POINT, F.lit(0))) | _infinite(F.get(POINT, F.lit(1)))
    label = F.get(fields, F.lit(2))
    outputs = {"point": F.col(POINT), "label": label, "grp": encode_group(label)}
    return _settle(df, bad, text, on_bad, outputs).drop(value)


def filter_suffix(lines: DataFrame, suffix: str, value: str = "value") -> DataFrame:
    return lines.where(F.col(value).endswith(suffix))


def split_groups(lines: DataFrame, on_bad: str = "fail", value: str = "value") -> DataFrame:
    """Every point once per set it belongs to: `part` is U (all), A or B (by line ending).

    One scan serves the three sets, and a line that ends in neither letter is in U only.
    """
    ends = F.col(value).endswith
    parts = F.filter(
        F.array(
            F.lit("U"),
            F.when(ends(GROUP_A_LABEL), GROUP_A_LABEL),
            F.when(ends(GROUP_B_LABEL), GROUP_B_LABEL),
        ),
        lambda p: p.isNotNull(),
    )
    tagged = parse_points_2d(lines.withColumn("parts", parts), on_bad, value)
    return tagged.select(F.explode("parts").alias("part"), "point")


def group_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row: lines, lines ending in "A", the rest, and lines whose last field equals "A"."""
    label = F.element_at(F.split(F.rtrim(F.col(value), F.lit(",")), ","), -1)
    n_suffix = F.count_if(F.col(value).endswith(GROUP_A_LABEL))
    return lines.agg(
        F.count(F.lit(1)).alias("n"),
        n_suffix.alias("n_a_suffix"),
        (F.count(F.lit(1)) - n_suffix).alias("n_b_suffix"),
        F.count_if(label == GROUP_A_LABEL).alias("n_a_label"),
    )


def sample_head(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first `n` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def write_points(
    points: DataFrame, path: str, label: str | Column = "label", digits: int = 3, dims: int | None = None
) -> None:
    """`%.3f`-style text lines with the label last, one part file per task.

    Through a decimal, so the text has a point in every locale and the rounding
    is half up. Nothing is cut or quoted: a point of another width than `dims`
    (that of the first row if not given), a missing coordinate, and a label that
    the line format cannot carry (empty, NULL, with a comma or a line end) are refused.
    """
    if dims is None:
        row = points.select(F.size("point").alias("n")).first()
        dims = row["n"] if row else 0
    text = F.transform("point", lambda v: v.cast(f"decimal(38,{digits})").cast("string"))
    whole = (F.size("point") == dims) & ~F.exists("point", lambda v: v.cast(f"decimal(38,{digits})").isNull())
    last = F.col(label) if isinstance(label, str) else label
    plain = last.rlike(r"\A[^,\r\n]+\z")
    line = F.concat(F.array_join(text, ","), F.lit(","), last)
    refuse = lambda why: F.raise_error(F.lit(why)).cast("string")
    checked = (
        F.when(~F.coalesce(whole, F.lit(False)), refuse(f"a point does not have {dims} finite coordinates"))
        .when(~F.coalesce(plain, F.lit(False)), refuse("a label is empty or has a comma or a line end"))
        .otherwise(line)
    )
    points.select(checked.alias("value")).write.mode("error").text(path)
