"""Class names, and the texts that displays and files make of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from .numbers import js_number


def class_name(class_id: Column, config: Config = DEFAULT) -> Column:
    """The label of a class id that may be any number; others become class_<id>, integral ones without a fraction."""
    names = F.array(*(F.lit(x) for x in config.class_names))
    number = class_id.cast("double")
    known = (number == F.floor(number)) & (number >= 0) & (number < len(config.class_names))
    return F.coalesce(F.get(names, F.when(known, number.cast("int"))), F.concat(F.lit("class_"), js_number(number)))


def classes(spark: SparkSession, config: Config = DEFAULT) -> DataFrame:
    return spark.createDataFrame(list(enumerate(config.class_names)), "class_id int, class_name string")


def crs_urn(epsg: Column) -> Column:
    return F.when(epsg.isNotNull(), F.concat(F.lit("urn:ogc:def:crs:EPSG::"), epsg.cast("string")))


def safe_filename(name: Column) -> Column:
    return F.regexp_replace(name, r"\s+", "_")


def palette_index(class_id: Column, colours: int = 15) -> Column:
    return class_id % colours


def label_text(name: Column, confidence: Column) -> Column:
    """E.g. "ship 83%"."""
    return F.format_string("%s %.0f%%", name, confidence * 100)


def epsg_text(epsg: Column, unknown: str = "unknown") -> Column:
    """What a status line says of a georeference."""
    return F.concat(F.lit("GeoTIFF (EPSG:"), F.coalesce(epsg.cast("string"), F.lit(unknown)), F.lit(")"))
