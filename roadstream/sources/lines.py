"""Comma-separated text lines, as a table or a stream, and their parsers."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from roadstream.schemas import LIMIT_VERSION, POLICE_ACTION, TRAFFIC, VIOLATION

TOO_SHORT = "too few fields"
BAD_NUMBER = "bad number"
BAD_SPEED = "speed out of range"
BAD_TIME = "time out of range"
# Beyond these, sums and timestamps overflow and would end the job: years 1 to 9999, and more
# than any vehicle does.
MIN_TIME, MAX_TIME = -62135596800000, 253402300799999
MAX_SPEED = 1e6


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A bounded text file or folder: one `value` per line."""
    return spark.read.text(path)


def read_lines_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A folder that text files are added to. Unlike a socket it can be read again after a
    failure, so no line is lost."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def parse_traffic(lines: DataFrame) -> DataFrame:
    """The good traffic lines as typed columns."""
    return accepted(parse(lines, TRAFFIC), TRAFFIC)


def parse_violation(lines: DataFrame) -> DataFrame:
    return accepted(parse(lines, VIOLATION), VIOLATION)


def parse_police(lines: DataFrame) -> DataFrame:
    return accepted(parse(lines, POLICE_ACTION), POLICE_ACTION)


def parse_limit_version(lines: DataFrame) -> DataFrame:
    return accepted(parse(lines, LIMIT_VERSION), LIMIT_VERSION)


def parse(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """All lines with the fields of `schema` and `reject_reason`, null where a line is good.

    Trailing empty fields count as missing, fields past the last are ignored, as in the plain
    line format. A bad line becomes a rejected row and does not stop the job.
    """
    others = [c for c in lines.columns if c != "value"]
    # A generated column is made once a line. The plain expression would be put into every use of
    # every field, also below the filters of the job, and each time split the line again.
    parts = F.split(F.regexp_replace("value", ",+$", ""), ",", -1)
    lines = lines.select(*others, "value", F.explode(F.array(parts)).alias("_parts"))
    fields = [_typed(F.get("_parts", F.lit(i)), f.dataType).alias(f.name)
              for i, f in enumerate(schema)]
    numbers = [f.name for f in schema if not isinstance(f.dataType, T.StringType)]
    bad_number, bad_speed, bad_time = F.lit(False), F.lit(False), F.lit(False)
    for f in schema:
        value = F.col(f.name)
        if f.name in numbers:
            bad_number = bad_number | value.isNull()
        if isinstance(f.dataType, T.DoubleType):  # NaN sorts above all numbers
            bad_speed = bad_speed | ~F.abs(value).between(0.0, MAX_SPEED)
        if isinstance(f.dataType, T.LongType):
            bad_time = bad_time | ~value.between(MIN_TIME, MAX_TIME)
    return lines.select(*others, "value", F.size("_parts").alias("_size"), *fields).select(
        *others, "value", *schema.fieldNames(),
        F.when(F.col("_size") < len(schema), TOO_SHORT)
        .when(bad_number, BAD_NUMBER)
        .when(bad_speed, BAD_SPEED)
        .when(bad_time, BAD_TIME)
        .alias("reject_reason"),
    )


def accepted(parsed: DataFrame, schema: T.StructType) -> DataFrame:
    others = [c for c in parsed.columns
              if c not in ("value", "reject_reason", *schema.fieldNames())]
    return parsed.where("reject_reason IS NULL").select(*others, *schema.fieldNames())


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where("reject_reason IS NOT NULL").select("value", "reject_reason")


def _typed(field: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return field
    if isinstance(dtype, T.LongType):  # the cast alone would also take blanks around
        return F.when(field.rlike("^[+-]?[0-9]+$"), field.try_cast(dtype))
    return field.try_cast(dtype)
