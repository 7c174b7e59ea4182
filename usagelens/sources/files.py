"""Readers that produce the six inputs from files.

* relational facts and catalogues: Parquet (or any format Spark reads)
  with the declared schema, so no inference pass and full pushdown;
* document collections exported as JSON lines: explicit schema; every field
  is text, ids become numbers where they are used (``plan_catalogue``), and a
  missing field stays NULL so the fallback label applies, instead of becoming
  the text "None";
* the subscriber file: plain text lines, no header skipping — the
  parser decides what a bad line is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from usagelens.schemas import INPUTS, LOCATION, RATE_PLAN_PRODUCT
from usagelens.sources.inputs import UsageInputs

DOCUMENT_SCHEMAS = {"rate_plan_product": RATE_PLAN_PRODUCT, "location": LOCATION}


def read_input(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
               **options) -> DataFrame:
    df = spark.read.format(fmt).options(**options).load(path)
    return conform_input(df, name)


def _typed(c: Column, kind: DataType) -> Column:
    """Cast that fails on a value it cannot take, with ANSI on or off."""
    if isinstance(kind, StringType):
        return c.cast(kind)
    bad = F.raise_error(F.concat(F.lit(f"not a {kind.simpleString()}: "), c.cast("string")))
    return F.when(c.isNotNull(), F.coalesce(c.try_cast(kind), bad))


def conform_input(df: DataFrame, name: str) -> DataFrame:
    """Project and cast to the declared input schema.  A plan id that comes
    as text stays text until it is used, so that lenient mode can reject it.
    ``activity_seq``
    (arrival order) may be absent from a source: it is then NULL and the
    first plan of a subscriber falls back to the smallest plan id."""
    present = set(df.columns)
    cols = []
    for f in INPUTS[name].fields:
        if f.name == "rate_plan_product_id" and f.name in present and \
                isinstance(df.schema[f.name].dataType, StringType):
            cols.append(F.col(f.name))
        elif f.name in present:
            cols.append(_typed(F.col(f.name), f.dataType).alias(f.name))
        elif f.name == "activity_seq":
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"input {name!r} has no column {f.name!r}")
    return df.select(*cols)


def read_document_collection(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A catalogue exported as JSON documents; every field is read as text."""
    return spark.read.schema(", ".join(f"`{f.name}` STRING" for f in DOCUMENT_SCHEMAS[name].fields)).json(path)


def read_subscriber_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def load_inputs_from_paths(spark: SparkSession, paths: dict[str, str],
                           fact_format: str = "parquet", quoted_subscribers: bool = False) -> UsageInputs:
    """``paths`` maps each input name to a location: the three facts in
    ``fact_format``, the two catalogues as JSON documents, the subscriber
    file as text (with ``quoted_subscribers``, of fields that may be quoted)."""
    return UsageInputs(
        quoted_subscribers=quoted_subscribers,
        voice_call_record=read_input(spark, "voice_call_record", paths["voice_call_record"], fact_format),
        sms_record=read_input(spark, "sms_record", paths["sms_record"], fact_format),
        mobile_data_activity=read_input(spark, "mobile_data_activity",
                                        paths["mobile_data_activity"], fact_format),
        subscriber=read_subscriber_lines(spark, paths["subscriber"]),
        rate_plan_product=read_document_collection(spark, "rate_plan_product", paths["rate_plan_product"]),
        location=read_document_collection(spark, "location", paths["location"]),
    )


INPUT_FILES = {
    "voice_call_record": "voice_call_record", "sms_record": "sms_record",
    "mobile_data_activity": "mobile_data_activity", "subscriber": "subscriber",
    "rate_plan_product": "rate_plan_product", "location": "location",
}


def write_inputs(inputs: UsageInputs, root: str, mode: str = "overwrite") -> dict[str, str]:
    """Materialise the six inputs under ``root`` in the formats
    ``load_inputs_from_paths`` reads (facts Parquet, catalogues JSON lines,
    subscriber file text).  Reading them back cuts the lineage of derived
    inputs; returns the path per input."""
    root = root.rstrip("/")
    paths = {name: f"{root}/{sub}" for name, sub in INPUT_FILES.items()}
    for name in ("voice_call_record", "sms_record", "mobile_data_activity"):
        getattr(inputs, name).write.mode(mode).parquet(paths[name])
    for name in ("rate_plan_product", "location"):
        getattr(inputs, name).write.mode(mode).json(paths[name])
    inputs.subscriber.write.mode(mode).text(paths["subscriber"])
    return paths
