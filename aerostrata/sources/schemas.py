"""Explicit schemas of the sources."""

_PLACE = "city string, state string, zip string, latitude double, longitude double, time timestamp"
AIR_QUALITY = f"{_PLACE}, us_aqi double, pm10 double, pm2_5 double, carbon_monoxide double, nitrogen_dioxide double, sulphur_dioxide double, ozone double, uv_index_clear_sky double, uv_index double, dust double, aerosol_optical_depth double"
WEATHER = f"{_PLACE}, temperature_2m double, relative_humidity_2m double, precipitation double, wind_speed_10m double, wind_speed_100m double, wind_direction_10m double, wind_direction_100m double, wind_gusts_10m double, shortwave_radiation double, diffuse_radiation double, cloud_cover double"
ZIPS = "zip string, lat double, lng double, city string, state_id string, density double"
PLACES = "zip string, city string, county string, latitude double, longitude double, population int"
STATE = "last_ingested_date string, last_run_timestamp string, in_progress struct<start:string,end:string,started_at:string>"
RUN_LOG = "run_id string, script string, status string, started_at string, finished_at string, duration_seconds double, parameters map<string,string>, locations struct<total_zip_centroids:int,cities_found:array<string>,cities_skipped:array<string>>, outputs array<struct<type:string,file:string,row_count:bigint,size_bytes:bigint,variable_count:int,variables:array<string>,api_url:string,batch_size_used:int>>, error string"
OVERPASS = "array<struct<id:bigint,type:string,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>>"
EDGES = "zip string, u bigint, v bigint, length double"
# The yearly inventory's headers stand one column beside their data;
# these are the headers under which each wanted column is found, and the counties.
TRI_HEADERS = {
    "trifd": "8. DATE SIGNED",
    "facility": "9. TRIFD",
    "city": "11. FACILITY STREET",
    "county": "12. FACILITY CITY",
    "state": "13. FACILITY COUNTY",
    "zip": "14. FACILITY STATE",
    "latitude": "46. NAICS CODE 6",
    "longitude": "47. LATITUDE",
    "chemical": "80. TRI_CHEM_ID",
    "carcinogen": "87. CARCINOGEN",
    "hap": "86. HAZARDOUS AIR POLLUTANT - HAPS",
    "fugitive_lbs": "109. MAXIMUM AMOUNT ON SITE",
    "stack_lbs": "113. FUGITIVE AIR EMISSIONS - BASIS OF ESTIMATE",
    "total_air": "117. STACK AIR EMISSIONS - BASIS OF ESTIMATE",
}
HOUSTON_COUNTIES = ("HARRIS", "FORT BEND", "BRAZORIA", "GALVESTON", "MONTGOMERY")
