"""Landed API files: weather payloads of parallel arrays, pages of health records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from heatmart import schemas
from heatmart.operators.append import new_by_key
from heatmart.operators.dedup import distinct_records

LOCATION = ["nom_poi", "ville", "latitude_poi", "longitude_poi", "numero_departement"]


def opened(landed: DataFrame, body: str = "body") -> DataFrame:
    """Landed rows with ``doc``, their body as a variant; NULL where it is missing or no JSON.

    The one place where JSON is parsed; all that follows looks up paths. NaN,
    which JSON does not know, makes a body unreadable. Rows opened before stay as they are.
    """
    if "doc" in landed.columns:
        return landed
    return landed.withColumn("doc", F.try_parse_json(F.col(body)))


def parse_payloads(landed: DataFrame, body: str = "body",
                   variables: list[str] = schemas.DAILY_VARIABLES) -> DataFrame:
    """Payload texts (with ``batch_id``) to one row per location, with its position.

    A payload is a list of locations, a wrapper {"results": [...]}, or one
    bare location. Each variable is looked up by itself, as texts, so what has
    another shape than expected is NULL and costs neither its location nor the
    payload; ``source`` keeps the location as it came.
    """
    listed = F.try_variant_get("doc", "$", "array<variant>")
    wrapped = F.try_variant_get("doc", "$.results", "array<variant>")
    found = F.coalesce(listed, F.when(F.size(wrapped) > 0, wrapped), F.array("doc"))
    each = opened(landed, body).select("batch_id", F.posexplode(found).alias("pos", "source"))
    daily = F.struct(*[F.try_variant_get("source", f"$.daily.{v}", "array<string>").alias(v)
                       for v in ["time", *variables]])
    return each.select("batch_id", "pos", F.struct(daily.alias("daily")).alias("location"), "source")


def other_variables(parsed: DataFrame,
                    variables: list[str] = schemas.DAILY_VARIABLES) -> DataFrame:
    """(batch_id, pos, variable, values) of daily variables that nobody asked for, as variants."""
    daily = F.try_variant_get("source", "$.daily", "map<string, variant>")
    return (parsed.select("batch_id", "pos", F.explode(daily).alias("variable", "values"))
            .where(~F.col("variable").isin("time", *variables)))


def unreadable(landed: DataFrame, body: str = "body") -> DataFrame:
    """Landed rows whose body is missing or no JSON; parse_payloads() makes nothing of them."""
    return opened(landed, body).where("doc is null")


def unmatched(parsed: DataFrame, locations: DataFrame) -> DataFrame:
    """Payload locations that no listed location answers; daily_readings() leaves them out."""
    return parsed.join(locations, ["batch_id", "pos"], "left_anti")


def daily_readings(parsed: DataFrame, locations: DataFrame,
                   variables: list[str] = schemas.DAILY_VARIABLES) -> DataFrame:
    """One row per (location, day): i-th payload goes to the i-th location of its batch.

    Days and values pair by position; get() yields NULL past the end of a short
    array, and what is not a number becomes NULL. Locations join the payloads
    before these unfold, so a shuffle moves arrays, not days.
    """
    located = parsed.join(locations, ["batch_id", "pos"])
    days = located.select(*LOCATION, "location.daily",
                          F.posexplode("location.daily.time").alias("i", "day"))
    return days.select(
        F.to_timestamp("day").alias("time"), *LOCATION,
        *[F.get(F.col(f"daily.{v}"), F.col("i")).try_cast("double").alias(v) for v in variables])


def complete_readings(parsed: DataFrame, locations: DataFrame,
                      variables: list[str] = schemas.DAILY_VARIABLES) -> DataFrame:
    """History form: a day without mean temperature is skipped."""
    return (daily_readings(parsed, locations, variables)
            .where("temperature_2m_mean is not null"))


def parse_pages(landed: DataFrame, record: T.StructType = schemas.HEALTH_RECORD,
                body: str = "body") -> DataFrame:
    """Page texts to the records of all pages; a page that is no JSON raises an error."""
    doc = F.col("doc")
    whole = F.when(doc.isNotNull(), F.try_variant_get(doc, "$.results", "array<variant>")).otherwise(
        F.raise_error(F.concat(F.lit("unreadable page: "), F.coalesce(F.substring(F.col(body), 1, 80), F.lit("NULL")))))
    each = opened(landed, body).select(F.explode(whole).alias("record"))
    return each.select(*[F.try_variant_get("record", f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
                         for f in record.fields])


def read_pages(spark: SparkSession, folder: str,
               record: T.StructType = schemas.HEALTH_RECORD) -> DataFrame:
    """Records of a folder of landed pages, one JSON object per line."""
    lines = spark.read.text(folder).where(F.trim("value") != "")
    return parse_pages(lines, record, "value")


def heat_record(records: DataFrame) -> DataFrame:
    """Heat-wave records under warehouse names."""
    names = {"dep": "code_departement", "libgeo": "departement_nom", "reg": "region_code",
             "reglib": "region_nom", "annee": "annee", "nb_j_can": "nombre_jours"}
    return records.select(*[F.col(k).alias(v) for k, v in names.items()])


def tagged_union(feeds: dict[str, DataFrame], tag: str = "pathologie") -> DataFrame:
    """Feeds of like shape in one frame, each row labelled with its feed."""
    frames = [df.withColumn(tag, F.lit(name)) for name, df in feeds.items()]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame, allowMissingColumns=True)
    return union


def load_records(records: DataFrame, existing: DataFrame | None = None,
                 mapper: Callable[[DataFrame], DataFrame] | None = None,
                 key: list[str] | None = None) -> DataFrame:
    """Generic health load: map, then keep what is not stored yet.

    With ``key`` (names after mapping) rows meet the stored table on that key,
    without it on the hash of the whole record.
    """
    mapped = mapper(records) if mapper else records
    if key:
        return new_by_key(mapped, existing, key)
    return distinct_records(mapped, existing)
