"""Schemas of landed pages, files and tables."""

from __future__ import annotations

THING = "struct<`@iot.id`:bigint,name:string,description:string,properties:map<string,string>>"
DATASTREAM = (
    "struct<`@iot.id`:bigint,name:string,unitOfMeasurement:struct<symbol:string>,"
    "properties:struct<type:string,parameter:string,station_id:string,measurement_start:string>,"
    "phenomenonTime:string>"
)
OBSERVATION = "struct<phenomenonTime:string,result:double>"
LOCATION = "struct<name:string,location:struct<type:string,coordinates:array<double>>>"


def page_schema(entity: str, owner: str | None = None) -> str:
    """Envelope of a landed page; ``owner`` is the id of the parent entity, written by the lander."""
    head = f"{owner} bigint, " if owner else ""
    return f"{head}`@iot.count` bigint, `@iot.selfLink` string, `@iot.nextLink` string, value array<{entity}>"


THINGS_PAGE = page_schema(THING)
DATASTREAMS_PAGE = page_schema(DATASTREAM, "thing_id")
OBSERVATIONS_PAGE = page_schema(OBSERVATION, "datastream_id")
LOCATIONS_PAGE = page_schema(LOCATION, "thing_id")
EXPORT = "Datum_von string, Datum_bis string, el string, el1 string"
