"""Schemas of the inputs, as DDL. Axis order is x = longitude, y = latitude everywhere; all data is EPSG:4326."""

SRID = 4326

POINT = "struct<x:double,y:double>"
PATH = f"array<{POINT}>"
PARTS = f"array<{PATH}>"

EMPLOYEES = "Name string, ID int"
TRIPS = "ID int, Start timestamp_ntz, End timestamp_ntz, Route string"
CITIES = "NAME string, STATEABB string, x double, y double"
OSM = "elements array<struct<type:string,id:bigint,lat:double,lon:double,nodes:array<bigint>,tags:map<string,string>>>"
CATALOG = "dataset string, tags array<string>, description string, dataset_id string, dataset_type string, dataset_start string, dataset_end string"
IMAGES = (
    "features array<struct<id:string,properties:struct<`system:time_start`:bigint,`system:time_end`:bigint,"
    "`system:footprint`:struct<coordinates:array<array<double>>>>,bands:array<struct<id:string,crs:string,dimensions:array<int>>>>>"
)
