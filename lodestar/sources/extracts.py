"""Raw extract scans, bound by column name.

The reference reads one Excel workbook per domain with inferred types; here
extracts land as splittable files (CSV, JSON lines or Parquet). Columns are
found under their header's names, in any order; columns beyond the raw schema
are kept as text, since they count in the full-row dedup (P8). Cells that say
"missing" are missing before any rule runs. Ids and salaries must be numbers:
anything else raises instead of disappearing (D5).

The files of one landing need not agree. The columns of all of them count: the
footers of Parquet files are merged by name (in a job), JSON fields are
inferred over all files, and a column that a file lacks is missing in its
rows. Where Parquet files give one column types that do not merge, files of
one schema are bound together and the bound rows united. CSV files whose
headers differ raise.
"""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions import lenient_number, strip
from lodestar.sources.schemas import RAW

FORMATS = ("csv", "json", "parquet")

# The cell texts that spreadsheet readers take as missing.
MISSING_MARKERS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                   "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                   "nan", "null"]


# Integer digits of a plain decimal; its fraction is cut off.
WHOLE_PATTERN = r"^([+-]?[0-9]+)(?:\.[0-9]*)?$"


def _strict(text: Column, name: str, whole: bool) -> Column:
    """A number from text; blank is missing, anything else that is no finite
    number raises. Whole numbers are cut towards zero and exact; one beyond 64
    bits raises."""
    raw, text = text, F.when(strip(text) != "", strip(text))
    value = lenient_number(text)

    def stop(what: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{name} {what}: "), text))

    bad = text.isNotNull() & value.isNull()
    if not whole:
        return F.when(bad, stop("is not a number").cast("double")).otherwise(value)
    # never through double, which rounds ids of more than 53 bits
    plain = F.regexp_extract(text, WHOLE_PATTERN, 1).try_cast("bigint")
    other = F.floor(F.abs(text.try_cast("decimal(38,18)"))) * F.when(value < 0, -1).otherwise(1)
    exact = F.when(text.rlike(WHOLE_PATTERN), plain).otherwise(other.try_cast("bigint"))
    whole_number = (F.when(bad, stop("is not a number").cast("bigint"))
                    .when(value.isNotNull() & exact.isNull(), stop("is beyond 64 bits").cast("bigint"))
                    .otherwise(exact))
    # most ids are written as their number is shown; no pattern runs for those
    plainly = raw.try_cast("bigint")
    return F.when(plainly.cast("string") == raw, plainly).when(raw.isNotNull(), whole_number)


def bind(df: DataFrame, domain: str) -> DataFrame:
    """``df`` under the raw schema of ``domain``, by name, extra columns after."""
    wanted = RAW[domain]
    lacking = [f.name for f in wanted if f.name not in df.columns]
    if lacking:
        raise ValueError(f"{domain} extract lacks {', '.join(lacking)}")
    out = []
    for f in [*wanted, *(x for x in df.schema if x.name not in wanted.fieldNames())]:
        c, have = F.col(f"`{f.name}`"), df.schema[f.name].dataType
        if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
            c, have = F.to_json(c), T.StringType()
        if isinstance(have, T.StringType):
            c = F.when(~c.isin(MISSING_MARKERS), c)
        elif isinstance(have, (T.FloatType, T.DoubleType)):
            c = F.when(~F.isnan(c), c)
        kind = wanted[f.name].dataType if f.name in wanted.fieldNames() else T.StringType()
        if isinstance(kind, (T.LongType, T.DoubleType)) and isinstance(have, T.StringType):
            c = _strict(c, f.name, isinstance(kind, T.LongType))
        out.append(c.cast(kind).alias(f.name))
    return df.select(out)


def _options(reader, fmt: str, options: dict):
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    # headers are checked against each other, file by file; quoted cells keep
    # their spaces; JSON numbers stay as they were written
    preset = {"csv": {"header": "true", "enforceSchema": "false", "mode": "FAILFAST"},
              "json": {"primitivesAsString": "true"}, "parquet": {"mergeSchema": "true"}}[fmt]
    for k, v in (preset | options).items():
        reader = reader.option(k, v)
    return reader.format(fmt)


def read_extract(spark: SparkSession, path: str | list[str], domain: str, fmt: str = "csv",
                 **options) -> DataFrame:
    """Read a raw extract for ``domain`` (hr, finance, operations): the files
    under a path, or of a list of paths, as one."""
    try:
        return bind(_options(spark.read, fmt, options).load(path), domain)
    except (PySparkException, Py4JJavaError) as e:
        if fmt != "parquet" or "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
    apart = partial(_options, fmt=fmt, options=options | {"mergeSchema": "false"})
    files = apart(spark.read).load(path).inputFiles()
    with ThreadPoolExecutor(16) as pool:  # footers only
        schemas = list(pool.map(lambda f: apart(spark.read).load(f).schema.json(), files))
    alike = defaultdict(list)
    for f, schema in zip(files, schemas, strict=True):
        alike[schema].append(f)
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True),
                  [bind(apart(spark.read).load(fs), domain) for fs in alike.values()])


def stream_files(spark: SparkSession, path: str) -> DataFrame:
    """The names of the files of a landing folder as a stream; contents are
    not read. A micro-batch reads its files like any landing."""
    kind = T.StructType([T.StructField("path", T.StringType()),
                         T.StructField("modificationTime", T.TimestampType()),
                         T.StructField("length", T.LongType()),
                         T.StructField("content", T.BinaryType())])
    return spark.readStream.format("binaryFile").schema(kind).load(path).select("path")


def write_extract(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Land an extract (used to stage test inputs and by the stream tests)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", "true")
    w.format(fmt).save(path)
